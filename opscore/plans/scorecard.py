"""Agent scorecard: daily and monthly indicators per e-mail agent, each
turned into points by the month's target bands.

``Scorecard`` builds every intermediate relation once (memoised), so a
relation read by several outputs is one DataFrame and Spark can reuse its
exchanges.  Keys throughout are ``matricula`` (employee) with ``dia`` (day)
or ``ym`` (first day of month), so the daily joins and the monthly joins
each share one hash partitioning.

Warehouse behaviours kept on purpose (SURVEY 0.1): inner semantics of the
target joins, the display guard that does not feed the score, NULL values
scoring the top band, whole-row DISTINCT after the fiscal shift, monthly
loss rows fanned out per loss day.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arith import safe_div
from ..functions.calendar import cutoff_month, fiscal_shift, month_key
from ..functions.labels import (area_rename, interaction_discount, percent_guard,
                                queue_weight, recontact_ratio, recontact_weight, shift_class)
from ..functions.scoring import band_score, imputed_band_score, step_penalty
from ..operators.filters import as_date, as_timestamp, normalised, ts_lit
from ..operators.joins import (employee_day_spine, month_roster_counts, month_roster_join, month_target_join,
                               roster_filter, split_left_join, targets_for, try_long)
from ..operators.setops import union_all, union_null_padded

# Target indicator per shift class, the absence row labels, the
# cycle report areas and excluded queues, the primary area (lower case).
SHIFT_INDICATORS = {"dia": "produtividade", "madrugada": "produtividade_madrugada",
                    "comercial": "produtividade_comercial"}
ABSENT_AREA, ABSENT_SHIFT, ABSENT_FILLER = "FALTA", "dia", 0.1
CYCLE_AREAS = ("Atendimento Primário", "Atendimento Especializado")
CYCLE_EXCLUDED_QUEUES = ("Hotel", "Pacote")
PRIMARY_AREA_LOWER = "relacionamento primário"

#: Loss days of an agent-month that are joined in one task.
LOSSES_A_TASK = 256

PRINCIPAL_COLUMNS = [
    "data_resolucao", "matricula", "percent_resolucao", "resolvidos", "p_resolutividade",
    "recorrencia", "resolvidos_rec", "producao", "p_produtividade", "assiduidade",
    "valor_ciclo_c", "p_ciclo_c", "valor_conhec_c", "p_conhecimento_c", "pontos_ideia_c",
    "valor_dto_c", "p_dto_c", "reclamacoes", "p_reclamacoes", "nps", "p_nps",
    "redes_sociais", "p_redes_sociais", "ultima_atualizacao"]

FINAL_COLUMNS = [
    "data_resolucao", "matricula", "percent_resolucao", "resolvidos", "p_resolutividade",
    "percent_recorrencia", "recorrencia", "resolvidos_rec", "p_recorrencia", "media__csat",
    "p_csat", "producao", "p_produtividade", "assiduidade", "p_prejuizo", "dto", "p_dto_i",
    "conhecimento_corporativo", "p_cc_i", "valor_ciclo_c", "p_ciclo_c", "valor_conhec_c",
    "p_conhecimento_c", "pontos_ideia_c", "valor_dto_c", "p_dto_c", "reclamacoes",
    "p_reclamacoes", "nps", "p_nps", "redes_sociais", "p_redes_sociais", "origem", "tipo",
    "matricula_supervisor", "supervisor", "matricula_coordenador", "coordenador",
    "matricula_gerente", "gerente", "ultima_atualizacao"]


def _ym_of(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


# Sums of weighted counts must not depend on the order of the rows: a score at a band's edge could
# flip with the partitioning.  The weights are whole hundredths or tenths, so whole numbers are
# added, exactly, and divided once.

def _hundredths(q: Column) -> Column:
    """``q`` by queue and interaction weight, in hundredths."""
    weight = queue_weight("fila") * interaction_discount("quantidade_interacoes") * 100
    return q * F.round(weight, 0)


def _tenths(fila: str) -> Column:
    """The recontact weight in tenths."""
    return F.round(recontact_weight(fila) * 10, 0)


def _mean_of_hundredths(val: Column) -> Column:
    """Mean of values of two decimals; one infinite value makes it infinite (two of different sign NaN)."""
    limit = F.lit(float("inf"))
    finite = F.sum(F.when(F.abs(val) < limit, F.round(val * 100, 0))) / 100
    infinite = F.sum(F.when(F.abs(val) == limit, val))
    return (F.coalesce(finite, F.lit(0.0)) + F.coalesce(infinite, F.lit(0.0))) / F.nullif(F.count(val), F.lit(0))


def _lookup(monthly: DataFrame, key: str, month: Column | None = None) -> Column:
    """The rows of a monthly sheet for this row's month, as an array of structs (NULL where there are none).

    The sheet is one scalar subquery, a map over the months: it is bounded by the calendar (a few target
    or team rows a month), is evaluated once, and spares the fact rows a shuffle by month, which a
    handful of keys would make as uneven as the months are.
    """
    rows = monthly.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.collect_list(F.struct(*[c for c in monthly.columns if c != key])).alias("_rows"))
    sheet = rows.select(F.map_from_entries(F.collect_list(F.struct(key, "_rows")))).scalar()
    return F.try_element_at(sheet, F.col(key) if month is None else month)


class Materialised:
    """The written daily table of a scorecard."""

    def __init__(self, card: "Scorecard", path: str):
        self.card, self.path = card, path

    def drop(self) -> None:
        """Delete the table; the scorecard is lazy again."""
        spark = self.card.scorecard_daily.sparkSession
        self.card._written = None
        for name in ("_recontact_days", "recontact_monthly", "scorecard_final"):
            self.card.__dict__.pop(name, None)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Scorecard:
    """All scorecard relations over one set of input tables.

    ``tables`` maps logical names (roster, targets, resolutions, recontacts,
    absences, contact_calendar, cycle_positions, monthly_grades,
    collective_extras, losses, csat_answers) to DataFrames.
    ``start_date`` is the first reported day, ``shift_from`` the first day
    the fiscal shift applies, ``as_of_ts`` the stamp written as
    ``ultima_atualizacao``.  ``months``: only report these fiscal months (all by
    default); daily inputs outside their days are not read.  ``one_team_row``: a month has at most one
    row of each team result, so the monthly recontacts need no team result (checked when they
    run); pass False where a month's targets or extras may differ between rows.
    """

    def __init__(self, tables: Mapping[str, DataFrame], start_date="2021-08-01",
                 shift_from="2022-07-01", as_of_ts=None, months=None, one_team_row: bool = True):
        self.t = tables
        self.start = as_date(start_date)
        self.shift_from = as_date(shift_from)
        self.months = None if months is None else sorted({as_date(m).replace(day=1) for m in months})
        self.one_team_row = one_team_row
        self._written: DataFrame | None = None
        self.as_of = as_timestamp(as_of_ts or _dt.datetime.now().replace(microsecond=0))

    # ------------------------------------------------------------ inputs
    def _read_days(self, day: Column) -> Column:
        """Is this day read: from ``start`` on and, with ``months``, from the 26th before the first to the end
        of the last (literal bounds, so they reach the scan)."""
        if self.months is None:
            return day >= F.lit(self.start)
        first = max(self.start, self.months[0] - _dt.timedelta(days=6))
        after = (self.months[-1] + _dt.timedelta(days=31)).replace(day=1)
        return (day >= F.lit(first)) & (day < F.lit(after))

    def _reported(self, df: DataFrame, day: str) -> DataFrame:
        """Rows whose (shifted) day is reported."""
        df = df.filter(F.col(day) >= F.lit(self.start))
        return df if self.months is None else df.filter(month_key(day).isin(self.months))

    def _reported_months(self, df: DataFrame) -> DataFrame:
        """Rows of the months (``ym``) that can be reported."""
        df = df.filter(F.col("ym") >= F.lit(self.start.replace(day=1)))
        return df if self.months is None else df.filter(F.col("ym").isin(self.months))

    @cached_property
    def agents(self) -> DataFrame:
        """Roster rows of e-mail agents of the primary area (upper-case match)."""
        return roster_filter(self.t["roster"], "upper")

    def _targets(self, indicator: str, tipo: str = "individual", trim: bool = True,
                 origem_case: str = "upper", keep_meta: bool = False) -> DataFrame:
        t = targets_for(self.t["targets"], indicator, tipo=tipo, origem="PRIMARIO",
                        trim_tipo=trim, origem_case=origem_case)
        return t if keep_meta else t.drop("tipo", "origem")

    # ------------------------------------------------------------ daily
    @cached_property
    def resolution_day_totals(self) -> DataFrame:
        """One pass over the resolutions: per (day, agent) the weighted
        resolved sum, the incident sum and the incident sum with an
        attendant.  Every daily indicator that reads resolutions starts here,
        so the largest table is scanned and shuffled once, after partial
        aggregation (a hot agent costs one row per map task)."""
        y = self.t["resolutions"]
        q = F.col("quantidade_incidentes")
        return y.groupBy("data_resolucao", "matricula").agg(
            (F.sum(_hundredths(q)) / 100).alias("_w"), F.sum(q).alias("_q"),
            F.sum(F.when(F.col("atendente").isNotNull(), q)).alias("_qa"),
            F.count(F.when(F.col("atendente").isNotNull(), F.lit(1))).alias("_na"))

    @cached_property
    def resolution_score_daily(self) -> DataFrame:
        """Weighted resolution rate per agent-day and its band score.

        Resolutions are pre-aggregated per (day, agent) before meeting the
        roster, whose equal rows are counted: the totals times their number are the sums
        of the joined rows (a duplicated roster row doubles both sums alike).
        """
        b = month_roster_counts(self.resolution_day_totals, self.agents, "data_resolucao",
                                ["matricula_supervisor", "matricula_coordenador", "matricula_gerente"])
        b = b.withColumn("resolvidos", F.col("_w") * F.col("_rows")).withColumn("_q", F.col("_q") * F.col("_rows"))
        b = b.withColumn("_pct", safe_div("resolvidos", "_q"))
        b = b.withColumn("ym", month_key("data_resolucao"))
        s = month_target_join(b, self._targets("resolutividade"))
        return s.select(
            "data_resolucao", "matricula",
            percent_guard("_pct").alias("percent_resolucao"), "resolvidos",
            band_score("_pct").alias("p_resolutividade"),
            "matricula_supervisor", "matricula_coordenador", "matricula_gerente")

    @cached_property
    def recontact_daily(self) -> DataFrame:
        """Weighted recontacts per (day, agent, roster area).

        Both dates of a recontact count (opened and answered): one scan
        emitting two rows per record instead of a two-scan UNION ALL.
        """
        return self._recontact_daily(None)

    def _recontact_daily(self, since) -> DataFrame:
        r = self.t["recontacts"]
        if since is not None:
            # keep records with at least one date from ``since`` on; the exact
            # day filter runs after the explode (this one can reach the scan)
            r = r.filter((F.to_date("data_ultima_criacao") >= F.lit(since))
                         | (F.to_date("data_respondido_cliente") >= F.lit(since)))
        y = r.select(F.explode(F.array(F.to_date("data_ultima_criacao"),
                                       F.to_date("data_respondido_cliente"))).alias("data_"),
                     "matricula", _tenths("fila").alias("_w"))
        pre = y.groupBy("data_", "matricula").agg((F.sum("_w") / 10).alias("_w"))
        j = month_roster_counts(pre, self.agents, "data_", ["area"], how="left")
        return j.select("data_", "matricula", F.col("area").alias("area_gabi"),
                        (F.col("_w") * F.col("_rows")).alias("recorrencia"))

    @cached_property
    def daily_resolved(self) -> DataFrame:
        """Incidents with an attendant, per (day, agent) (all agents)."""
        return (self.resolution_day_totals.filter(F.col("_na") > 0)
                .select(F.col("data_resolucao").alias("data_"), "matricula",
                        F.col("_qa").alias("resolvidos_rec")))

    @cached_property
    def production_by_shift(self) -> DataFrame:
        """Incidents per (day, agent, area, shift class)."""
        j = month_roster_counts(self.resolution_day_totals, self.agents, "data_resolucao",
                                ["area", shift_class("horario_inicio", "horario_fim").alias("escala")])
        return j.select("data_resolucao", "matricula", "area", "escala",
                        (F.col("_q") * F.col("_rows")).alias("producao"))

    @cached_property
    def absence_production(self) -> DataFrame:
        """Absence days as production rows: unjustified -> 0, other -> NULL."""
        a = month_roster_join(self.t["absences"], self.agents, "data_ref", roster_cols=[])
        prod = (F.when(F.col("falta_injustificada") >= 1, F.lit(0.0))
                .when(F.col("faltas_outros") >= 1, F.lit(None))
                .when(F.col("faltas_justificadas") >= 1, F.lit(None)))
        return a.select(F.col("data_ref").alias("data_resolucao"), "matricula",
                        F.lit(ABSENT_AREA).alias("area"), prod.cast("double").alias("producao"),
                        F.lit(ABSENT_SHIFT).alias("escala"))

    @cached_property
    def production_with_absence(self) -> DataFrame:
        """Worst production row per agent-day after overlaying absences.

        NULL production ranks as 0.1.  Equal ranks are broken by area, then
        shift, so the pick is deterministic.  An agent-day has a handful of rows
        (roster rows of the month, absences), compared as structs.  The warehouse UNION's duplicate
        removal is not needed: the minimum of a multiset is the minimum of
        its set, so the rows are stacked (UNION ALL) and one shuffle saved.
        """
        base = union_all(self.production_by_shift.select(
            "data_resolucao", "matricula", "area", "producao", "escala"),
            self.absence_production)
        rank = F.struct(F.coalesce(F.col("producao"), F.lit(ABSENT_FILLER)).alias("_r"),
                        F.col("area"), F.col("escala"), F.col("producao"))
        pick = F.array_min(F.collect_list(rank))
        return (base.groupBy("data_resolucao", "matricula").agg(pick.alias("_b"))
                .select("data_resolucao", "matricula", "_b.producao", "_b.area", "_b.escala"))

    @property
    def _shift_targets(self) -> DataFrame:
        """Target rows of the three shift indicators by month."""
        tg = self.t["targets"]
        t3 = tg.filter(F.lower("indicador").isin(*SHIFT_INDICATORS.values())
                       & (normalised("tipo", "lower", True) == "individual")
                       & (F.upper("origem") == "PRIMARIO"))
        bands = [c for c in tg.columns if c[:2] in ("m_", "p_")]
        return t3.select(month_key("ref").alias("_tym"), F.lower("indicador").alias("_ind"), *bands)

    @cached_property
    def production_score(self) -> DataFrame:
        """Production scored against the target of the agent's shift class.

        One join on (month, indicator of the shift) replaces three
        filtered scans of the production relation; DISTINCT keeps the
        set semantics of the union it replaces.
        """
        t3 = self._shift_targets
        base = self.production_with_absence
        ind = None
        for shift, name in SHIFT_INDICATORS.items():
            ind = (F.when(F.col("escala") == shift, F.lit(name)) if ind is None
                   else ind.when(F.col("escala") == shift, F.lit(name)))
        base = base.select("*", month_key("data_resolucao").alias("_ym"), ind.alias("_ind"))
        j = base.join(t3, (base["_ym"] == t3["_tym"]) & (base["_ind"] == t3["_ind"]))
        return j.select("data_resolucao", "matricula", "producao",
                        band_score("producao", above="extrapolate")
                        .alias("p_produtividade")).distinct()

    # ------------------------------------------------------------ team, monthly
    @cached_property
    def cycle_rate_monthly(self) -> DataFrame:
        """Mean daily on-time ratio per (month, renamed area).

        ratio = answered-in-time / (total - late-but-resolved), rounded to 2
        places; 0/0 (NaN) counts as 0, x/0 stays infinite.
        """
        cp = self.t["cycle_positions"]
        cp = cp.filter((F.col("data_posicao") >= F.lit(self.start))
                       & F.col("area").isin(*CYCLE_AREAS)
                       & ~F.col("fila").isin(*CYCLE_EXCLUDED_QUEUES))
        ratio = F.round(safe_div(F.col("qtde_respondido_dentro_prazo"),
                                 F.col("qtde_total")
                                 - F.col("qtde_nao_respondido_fora_prazo_resolvido")), 2)
        val = F.when(F.isnan(ratio), F.lit(0.0)).otherwise(ratio)
        return (cp.groupBy(F.month("data_posicao").alias("mes_ref"),
                           F.year("data_posicao").alias("ano_ref"),
                           area_rename("area").alias("area"))
                .agg(_mean_of_hundredths(val).alias("valor_ciclo_c")))

    @cached_property
    def cycle_score_monthly(self) -> DataFrame:
        """Cycle ratio of the primary area per month, scored (team result)."""
        o = self.cycle_rate_monthly.filter(F.lower("area") == PRIMARY_AREA_LOWER)
        o = o.withColumn("ym", _ym_of(F.col("ano_ref"), F.col("mes_ref")))
        t = self._targets("ciclo 10 dias", tipo="coletivo", trim=False, keep_meta=True)
        j = month_target_join(o, t, drop_meta=False)
        return j.select("mes_ref", "ano_ref", "valor_ciclo_c",
                        band_score("valor_ciclo_c").alias("p_ciclo"),
                        "area", "tipo", "origem")

    @cached_property
    def monthly_grade_avg(self) -> DataFrame:
        """Mean knowledge and DTO grades of rostered agents per month."""
        g = self.t["monthly_grades"]
        g = g.withColumn("_d", _ym_of(F.col("ano_ref"), F.col("mes_ref")))
        j = month_roster_join(g, self.agents, "_d", roster_cols=[])
        return j.groupBy("ano_ref", "mes_ref").agg(
            F.avg("nota_conhecimento").alias("valor_conhec_c"),
            F.avg("nota_dto").alias("valor_dto_c"))

    def _grade_team(self, grade: str, indicator: str, value: str, score: str) -> DataFrame:
        o = self.monthly_grade_avg.select("ano_ref", "mes_ref", value)
        o = o.withColumn("ym", _ym_of(F.col("ano_ref"), F.col("mes_ref")))
        t = self._targets(indicator, tipo="coletivo", trim=False, keep_meta=True)
        j = month_target_join(o, t, drop_meta=False)
        return j.select("mes_ref", "ano_ref", value, band_score(value).alias(score),
                        "tipo", "origem")

    @cached_property
    def knowledge_score_monthly(self) -> DataFrame:
        return self._grade_team("nota_conhecimento", "conhecimento corporativo",
                                "valor_conhec_c", "p_conhecimento")

    @cached_property
    def dto_score_monthly(self) -> DataFrame:
        return self._grade_team("nota_dto", "dto", "valor_dto_c", "p_dto")

    # ------------------------------------------------------------ principal
    @cached_property
    def employee_days(self) -> DataFrame:
        """(dia, matricula): every agent on every contact day of the month."""
        return employee_day_spine(self.t["contact_calendar"], self.agents, "created",
                                  start=self.start)

    @cached_property
    def agent_day_totals(self) -> DataFrame:
        """Everything the daily indicators read, per (agent, day) from ``start`` on, in one grouped relation.

        Resolutions, recontact dates and absences are stacked with the columns of the others
        empty, so all of them are summed in one aggregate behind one shuffle (partial sums
        first: a hot agent costs one row per map task and day).  ``_absent`` is the rank of the worst
        absence: 0 for an unjustified one, else the filler.
        """
        q, served = F.col("quantidade_incidentes"), F.col("atendente").isNotNull()
        blank = {"_w": "double", "_q": "double", "_qa": "double", "_na": "int", "_res": "int", "_rw": "double",
                 "_rec": "int", "_absent": "double"}

        def rows(df: DataFrame, dia: str, **given) -> DataFrame:
            return df.select("matricula", F.col(dia).alias("dia"),
                             *[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in blank.items()])

        resolutions = rows(
            self.t["resolutions"].filter(self._read_days(F.col("data_resolucao"))), "data_resolucao",
            _w=_hundredths(q), _q=q,
            _qa=F.when(served, q), _na=F.when(served, F.lit(1)), _res=F.lit(1))
        r = self.t["recontacts"]
        opened, answered = F.to_date("data_ultima_criacao"), F.to_date("data_respondido_cliente")
        r = r.filter(self._read_days(opened) | self._read_days(answered)).select(
            "matricula", "fila", F.explode(F.array(opened, answered)).alias("dia")).filter(self._read_days(F.col("dia")))
        recontacts = rows(r, "dia", _rw=_tenths("fila"), _rec=F.lit(1))
        absences = rows(self.t["absences"].filter(self._read_days(F.col("data_ref"))), "data_ref",
                        _absent=F.when(F.col("falta_injustificada") >= 1, F.lit(0.0)).otherwise(F.lit(ABSENT_FILLER)))
        return union_all(union_all(resolutions, recontacts), absences).groupBy("matricula", "dia").agg(
            (F.sum("_w") / 100).alias("_w"), F.sum("_q").alias("_q"), F.sum("_qa").alias("_qa"),
            (F.sum("_rw") / 10).alias("_rw"), F.count("_na").alias("_na"),
            F.count("_res").alias("_res"), F.count("_rec").alias("_rec"), F.min("_absent").alias("_absent"))

    @cached_property
    def agent_months(self) -> DataFrame:
        """Per (agent, month) of the roster, how its rows multiply a day's totals: the number of rows of
        each hierarchy (``_hier``), of each area (``_areas``) and of each area and shift (``_shifts``)."""
        hierarchy = ("matricula_supervisor", "matricula_coordenador", "matricula_gerente")
        distinct = self.agents.groupBy(
            "matricula", month_key("mes_referencia").alias("ym"), *hierarchy, "area",
            shift_class("horario_inicio", "horario_fim").alias("escala")).agg(F.count(F.lit(1)).alias("n"))
        months = distinct.groupBy("matricula", "ym").agg(
            F.collect_list(F.struct(F.struct(*hierarchy).alias("h"), "area", "escala", "n")).alias("_rows"))

        def counted(kind: str) -> str:
            return (f"transform(array_distinct(transform(_rows, r -> {kind})), k -> struct(k, aggregate("
                    f"filter(_rows, r -> {kind} <=> k), 0L, (total, r) -> total + r.n) AS n))")

        return months.selectExpr("matricula", "ym", f"{counted('r.h')}.n AS _hier", f"{counted('r.area')}.n AS _areas",
                                 f"transform({counted('struct(r.area, r.escala)')}, x -> struct("
                                 "x.k.area AS area, x.k.escala AS escala, x.n AS n)) AS _shifts")

    @cached_property
    def daily_table(self) -> DataFrame:
        """Spine with the four daily indicators; ``data`` is the shifted day.

        Each (agent, day) of the spine carries its month's roster counts and meets its totals once.
        The indicators are then computed in the row; what a row stands for several times (roster rows,
        target rows of a month) is expanded last.
        """
        days = self.t["contact_calendar"].select(F.to_date("created").alias("dia")).filter(
            self._read_days(F.col("dia"))).distinct().groupBy(month_key("dia").alias("ym")).agg(
            F.collect_list("dia").alias("_days"))
        # one row per month is copied to every task, never the agents' months, whatever the planner takes them for
        spine = self.agent_months.join(F.broadcast(days), "ym").select(
            "matricula", F.explode("_days").alias("dia"), "ym", "_hier", "_areas", "_shifts")
        j = spine.join(self.agent_day_totals, ["matricula", "dia"], "left")

        bands = [c for c in self.t["targets"].columns if c[:2] in ("m_", "p_")]
        j = j.withColumn("_t", _lookup(self._targets("resolutividade"), "ym"))
        j = j.withColumn("_r", F.explode_outer(F.expr(
            "CASE WHEN _res > 0 THEN flatten(transform(_hier, n -> transform(_t, t -> struct(n, t)))) END")))
        j = j.selectExpr("*", "_r.n * _w AS resolvidos", "_r.n * _q AS _incidentes", "_r.t.*").withColumn(
            "_pct", safe_div("resolvidos", "_incidentes")).withColumn("p_resolutividade", band_score("_pct")).drop(*bands)

        j = j.withColumn("recorrencia", F.explode_outer(F.expr(
            "CASE WHEN _rec > 0 THEN transform(_areas, n -> n * _rw) END")))

        worst = (f"array_min(concat(CASE WHEN _res > 0 THEN transform(_shifts, s -> struct("
                 f"coalesce(s.n * _q, {ABSENT_FILLER}D) AS rank, s.area AS area, s.escala AS escala, s.n * _q AS producao)) "
                 f"ELSE array() END, CASE WHEN _absent IS NOT NULL THEN array(struct(_absent AS rank, '{ABSENT_AREA}' AS area, "
                 f"'{ABSENT_SHIFT}' AS escala, CASE WHEN _absent = 0 THEN 0D END AS producao)) ELSE array() END))")
        j = j.withColumn("_worst", F.expr(worst)).withColumn("_t", _lookup(self._shift_targets, "_tym", F.col("ym")))
        indicator = " ".join(f"WHEN '{shift}' THEN '{name}'" for shift, name in SHIFT_INDICATORS.items())
        j = j.withColumn("_t", F.explode_outer(F.expr(
            f"filter(_t, t -> t._ind = CASE _worst.escala {indicator} END)"))).selectExpr(
            "*", "CASE WHEN _t IS NOT NULL THEN _worst.producao END AS producao", "_t.*")
        j = j.withColumn("p_produtividade", band_score("producao", above="extrapolate"))
        return j.select(fiscal_shift("dia", self.shift_from).alias("data"), "matricula",
                        percent_guard("_pct").alias("percent_resolucao"), "resolvidos", "p_resolutividade", "recorrencia",
                        F.when(F.col("_na") > 0, F.col("_qa")).alias("resolvidos_rec"), "producao", "p_produtividade",
                        F.lit(0).alias("assiduidade"), ts_lit(self.as_of).alias("ultima_atualizacao"))

    @cached_property
    def team_by_month(self) -> list[DataFrame]:
        """Team results keyed by ``ym``."""
        cycle = self.cycle_score_monthly.select(
            _ym_of(F.col("ano_ref"), F.col("mes_ref")).alias("ym"), "valor_ciclo_c",
            F.col("p_ciclo").alias("p_ciclo_c"))
        knowledge = self.knowledge_score_monthly.select(
            _ym_of(F.col("ano_ref"), F.col("mes_ref")).alias("ym"), "valor_conhec_c",
            F.col("p_conhecimento").alias("p_conhecimento_c"))
        dto = self.dto_score_monthly.select(
            _ym_of(F.col("ano_ref"), F.col("mes_ref")).alias("ym"), "valor_dto_c",
            F.col("p_dto").cast("double").alias("p_dto_c"))
        extras = self.t["collective_extras"].select(
            _ym_of(F.col("ano_ref"), F.col("mes_ref")).alias("ym"), "reclamacoes",
            "p_reclamacoes", "nps", "p_nps", "redes_sociais", "p_redes_sociais")
        return [cycle, knowledge, dto, extras]

    @cached_property
    def absence_rows(self) -> DataFrame:
        """Absence days of agents as scorecard rows (only production points)."""
        a = self.t["absences"].filter(F.col("data_ref") >= F.lit(self.start - _dt.timedelta(days=6)))
        if self.months is not None:
            a = a.filter(self._read_days(F.col("data_ref")) | (F.col("data_ref") < F.lit(self.start)))
        a = month_roster_join(a, self.agents, "data_ref", roster_cols=[])
        return a.select(
            fiscal_shift("data_ref", self.shift_from).alias("data_resolucao"), "matricula",
            F.when(F.col("falta_injustificada") >= 1, F.lit(0.0)).alias("p_produtividade"),
            F.lit(0).alias("assiduidade"),
            ts_lit(self.as_of).alias("ultima_atualizacao"))

    @cached_property
    def scorecard_daily(self) -> DataFrame:
        """The 24-column daily scorecard (warehouse CTE ``principal``)."""
        t = self.daily_table.withColumn("ym", month_key("data"))
        for side in self.team_by_month:
            t = t.select("*", F.explode_outer(_lookup(side, "ym")).alias("_team")).select("*", "_team.*").drop("_team")
        # Three columns are the same constant in every row of both arms
        # (update stamp, attendance 0, no idea points): they cannot change
        # which rows are distinct, so DISTINCT runs on the other 21 columns
        # and they are added back afterwards (narrower shuffle, same rows).
        constant = {"assiduidade": "CAST(0 AS INT) AS assiduidade",
                    "pontos_ideia_c": "CAST(NULL AS DOUBLE) AS pontos_ideia_c",
                    "ultima_atualizacao": f"CAST('{self.as_of.isoformat(sep=' ')}' "
                                          f"AS TIMESTAMP_NTZ) AS ultima_atualizacao"}
        varying = [c for c in PRINCIPAL_COLUMNS if c not in constant]
        arm1 = t.selectExpr(*[{"data_resolucao": "data AS data_resolucao"}.get(c, c)
                              for c in varying])
        arm2 = self.absence_rows.drop(*constant)
        out = union_null_padded(arm1, arm2, distinct=True)
        return self._reported(out, "data_resolucao").selectExpr(*[constant.get(c, c) for c in PRINCIPAL_COLUMNS])

    @property
    def _daily(self) -> DataFrame:
        """The daily scorecard as the assemblies read it: the materialised table, if any."""
        return self._written if self._written is not None else self.scorecard_daily

    def read_daily(self, written: DataFrame) -> None:
        """Let the monthly and final assemblies built from now on read this daily card."""
        self._written = written
        for name in ("_recontact_days", "recontact_monthly", "scorecard_final"):
            self.__dict__.pop(name, None)

    def materialise_daily(self, folder: str) -> "Materialised":
        """Write the daily scorecard under ``folder`` (shared by all executors) and let the
        monthly and final assemblies built afterwards read it back, instead of evaluating
        it once for each.  Returns a handle; ``handle.drop()`` deletes the table once
        nothing reads it any more.  A failed write raises and leaves no table behind.
        """
        import uuid
        path = f"{folder.rstrip('/')}/opscore-scorecard-daily-{uuid.uuid4().hex}"
        self.scorecard_daily.write.parquet(path)
        self.read_daily(self.scorecard_daily.sparkSession.read.parquet(path))
        return Materialised(self, path)

    # ------------------------------------------------------------ monthly individual
    @cached_property
    def _team_rows_differ(self) -> Column:
        """How many (month, team result) have more than one distinct row (scalar subquery over the small sheets)."""
        bands = [c for c in self.t["targets"].columns if c[:2] in ("m_", "p_")]
        sheets = None
        for name in ("ciclo 10 dias", "conhecimento corporativo", "dto"):
            one = self._targets(name, tipo="coletivo", trim=False).select(
                F.lit(name).alias("k"), "ym", F.xxhash64(*bands).alias("h"))
            sheets = one if sheets is None else sheets.unionAll(one)
        extras = self.t["collective_extras"]
        sheets = sheets.unionAll(extras.select(
            F.lit("extras").alias("k"), _ym_of(F.col("ano_ref"), F.col("mes_ref")).alias("ym"),
            F.xxhash64(*[c for c in extras.columns if c not in ("ano_ref", "mes_ref")]).alias("h")))
        several = sheets.groupBy("k", "ym").agg(F.count_distinct("h").alias("n")).filter("n > 1")
        return several.select(F.count(F.lit(1))).scalar()

    @cached_property
    def _recontact_days(self) -> DataFrame:
        """The columns of the daily card that the monthly recontacts need, with as many rows.

        A team result depends on the month alone, so it cannot make two rows of a day differ: where a month has
        one row of each, the card's DISTINCT can be taken over the agent's own columns, and
        the team results are not computed.
        """
        if self._written is not None or not self.one_team_row:
            return self._daily.select("data_resolucao", "matricula", "resolvidos_rec", "recorrencia")
        own = self.daily_table.drop("assiduidade", "ultima_atualizacao").distinct().select(
            F.col("data").alias("data_resolucao"), "matricula", "resolvidos_rec", "recorrencia")
        message = "a month has several team rows: pass one_team_row=False or materialise the daily card"
        checked = own.filter(F.coalesce(
            F.when(self._team_rows_differ > 0, F.raise_error(F.lit(message)).cast("boolean")), F.lit(True)))
        absent = self.absence_rows.select("data_resolucao", "matricula", F.lit(None).cast("double").alias("resolvidos_rec"),
                                          F.lit(None).cast("double").alias("recorrencia"))
        return self._reported(union_all(checked, absent), "data_resolucao")

    @cached_property
    def recontact_monthly(self) -> DataFrame:
        m = (self._recontact_days.groupBy(F.year("data_resolucao").alias("ano_ref"),
                                          F.month("data_resolucao").alias("mes_ref"), "matricula")
             .agg(F.sum("resolvidos_rec").alias("resolvidos_rec"),
                  F.sum("recorrencia").alias("recorrencia")))
        m = m.withColumn("percent_recorrencia",
                         recontact_ratio(F.col("recorrencia"), F.col("resolvidos_rec")))
        m = m.withColumn("ym", _ym_of(F.col("ano_ref"), F.col("mes_ref")))
        j = month_target_join(m, self._targets("recorrencia"))
        return j.select("ano_ref", "mes_ref", "matricula", "resolvidos_rec", "recorrencia",
                        "percent_recorrencia",
                        band_score("percent_recorrencia", direction="down")
                        .alias("p_recorrencia"))

    @cached_property
    def loss_penalty_daily(self) -> DataFrame:
        """Rounded loss amounts and step penalties per (day, requester)."""
        lo = self.t["losses"].filter(F.col("data_ref") >= F.lit(self.start))
        amt = F.round(F.col("reembolso_valor_prejuizo").try_cast("double"), 0)
        return (lo.groupBy("data_ref", F.col("solicitante_matricula").alias("matricula"))
                .agg(F.sum(amt).alias("reembolso_valor_prejuizo"),
                     F.sum(step_penalty(amt)).alias("p_prejuizo")))

    def _grade_individual(self, grade: str, indicator: str, value: str,
                          score: str) -> DataFrame:
        """Own grades of the rostered agents, scored.  The grades grow with agents and months: joined by merge
        (see :func:`month_roster_join`)."""
        e = roster_filter(self.t["roster"], "lower").select(
            F.year("mes_referencia").alias("ano_ref"), F.month("mes_referencia").alias("mes_ref"),
            "matricula")
        g = self.t["monthly_grades"].select(
            F.col("ano_ref").alias("_a"), F.col("mes_ref").alias("_m"),
            F.col("matricula").alias("_k"), F.round(grade, 2).alias("_v"))
        r = e.join(g.hint("merge"), (e["matricula"] == g["_k"]) & (e["ano_ref"] == g["_a"])
                   & (e["mes_ref"] == g["_m"]), "left")
        r = r.withColumn("ym", _ym_of(F.col("ano_ref"), F.col("mes_ref")))
        t = self._targets(indicator, origem_case="lower")
        j = month_target_join(r, t)
        filled, pts = imputed_band_score("_v")
        return j.select("ano_ref", "mes_ref", "matricula", filled.alias(value), pts.alias(score))

    @cached_property
    def dto_individual(self) -> DataFrame:
        return self._grade_individual("nota_dto", "dto", "dto", "p_dto_i")

    @cached_property
    def knowledge_individual(self) -> DataFrame:
        return self._grade_individual("nota_conhecimento", "conhecimento corporativo",
                                      "conhecimento_corporativo", "p_cc_i")

    @cached_property
    def csat_monthly(self) -> DataFrame:
        """Mean CSAT per agent and reporting month (day >= 26 counts for the next)."""
        # answers are summed per (day, agent text) first: the roster join and
        # the monthly mean then work on one row per agent-day.
        a = (self.t["csat_answers"].groupBy("data_das_respostas", "matricula")
             .agg(F.sum("media_").alias("_s"), F.count("media_").alias("_c"))
             .withColumn("_k", try_long("matricula")))
        ag = self.agents.select(F.col("matricula").alias("_rk"),
                                month_key("mes_referencia").alias("_rym"))
        j = a.join(ag.hint("merge"), (a["_k"] == ag["_rk"]) & (month_key("data_das_respostas") == ag["_rym"]))
        cm = cutoff_month("data_das_respostas")
        r = (j.groupBy(F.year(cm).alias("ano_ref"), F.month(cm).alias("mes_ref"), "matricula")
             .agg((F.sum("_s") / F.when(F.sum("_c") > 0, F.sum("_c"))).alias("_csat")))
        r = r.withColumn("ym", _ym_of(F.col("ano_ref"), F.col("mes_ref")))
        j2 = month_target_join(r, self._targets("csat"))
        return j2.select("ano_ref", "mes_ref", try_long("matricula").alias("matricula"),
                         F.round("_csat", 2).alias("media__csat"),
                         F.round(band_score("_csat"), 2).alias("p_csat"))

    # ------------------------------------------------------------ final
    @cached_property
    def scorecard_final(self) -> DataFrame:
        """Daily scorecard with monthly indicators and the agent's hierarchy.

        All joins are on (matricula, ym), by merge (see :func:`month_roster_join`): every monthly side grows
        with the agents.  Loss rows are daily, joined by month: an agent with n loss days in a month gets
        each daily row n times (warehouse behaviour, kept).
        """
        z = self._daily.withColumn("ym", month_key("data_resolucao")) \
            .drop("recorrencia", "resolvidos_rec")

        def monthly(df: DataFrame, cols: list[str]) -> DataFrame:
            return df.select(_ym_of(F.col("ano_ref"), F.col("mes_ref")).alias("ym"),
                             "matricula", *cols)

        recontact = monthly(self.recontact_monthly, ["percent_recorrencia", "recorrencia",
                                               "resolvidos_rec", "p_recorrencia"])
        losses = self.loss_penalty_daily.select(month_key("data_ref").alias("ym"), "matricula",
                                             "p_prejuizo")
        dto = monthly(self.dto_individual, ["dto", "p_dto_i"])
        knowledge = monthly(self.knowledge_individual, ["conhecimento_corporativo", "p_cc_i"])
        csat = monthly(self.csat_monthly, ["media__csat", "p_csat"])
        hierarchy = roster_filter(self.t["roster"], "exact").select(
            "matricula", month_key("mes_referencia").alias("ym"), "origem", "tipo",
            "matricula_supervisor", "supervisor", "matricula_coordenador", "coordenador",
            "matricula_gerente", "gerente")
        # Only months that can be reported match: each monthly side is cut to them (same rows).
        # The filters are on grouping keys and move below the monthly aggregations.
        j = z
        for side in (recontact, dto, knowledge, csat):
            j = j.join(self._reported_months(side).hint("merge"), ["matricula", "ym"], "left")
        j = j.join(self._reported_months(hierarchy).hint("merge"), ["matricula", "ym"], "inner")
        # the losses multiply rows, so they come last, and an agent-month with very many is split
        j = split_left_join(j, self._reported_months(losses), ["matricula", "ym"], least_rows=LOSSES_A_TASK)
        return j.selectExpr(*FINAL_COLUMNS)


def production_with_absence(resolutions: DataFrame, roster: DataFrame,
                            absences: DataFrame) -> DataFrame:
    """Worst production row per agent-day with absences overlaid (see
    :attr:`Scorecard.production_with_absence`), from the three tables alone."""
    return Scorecard({"resolutions": resolutions, "roster": roster,
                      "absences": absences}).production_with_absence
