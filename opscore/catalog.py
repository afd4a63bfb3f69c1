"""The registered keys, each built from operators/plans."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from .functions import (Bands, band_score, date_parts, fiscal_shift, imputed_band_score,
                        interaction_discount, month_key, queue_weight, refund_kind, safe_div,
                        shift_class)
from .operators import (between_filter, cast_key_join, date_floor_filter, latest_per_key,
                        month_roster_join, month_target_join, normalised, not_in_filter,
                        partition_count, rolling_days_filter, roster_filter, split_left_join, status_in_filter,
                        targets_for, trailing_id_window, union_all,
                        union_distinct, union_null_padded)
from .plans.refunds import (newest_log_per_flight, refund_item_total, refund_ledger,
                             refund_status_union)
from .plans.route_demand import (CLOSED_STATUSES, metasearch_by_route, route_demand,
                                 sales_by_route, tracking_rank)
from .plans.search_dashboard import search_dashboard, search_dashboard_sql
from .plans.scorecard import LOSSES_A_TASK
from .registry import PARAMS as P
from .registry import register


# ---------------------------------------------------------------- finished
@register("route_demand")
def q_route_demand(t):
    """Searches vs. closed sales per route and source over the trailing window."""
    return route_demand(t["searches"], t["orders_booked"], t["order_tracking"],
                        P["route_as_of"], P["route_days"])


@register("refund_ledger")
def q_refund_ledger(t):
    """Refund ledger: flight, active bank row, newest status, reason, item total (DISTINCT)."""
    return refund_ledger(t["cancelled_flights"], t["cancellations"], t["refund_bank_data"],
                         t["banks"], t["flight_logs"], t["flight_statuses"],
                         t["cancel_reasons"], t["refund_items"])


@register("refund_status_union")
def q_refund_status_union(t):
    """UNION ALL of (id, status) from the two refund report tables."""
    return refund_status_union(t["refund_reports"], t["refund_extra"])


@register("search_dashboard")
def q_search_dashboard(t):
    """Search volume per day, destination and check-in for the bound date range and id window."""
    return search_dashboard(t["trip_searches"], t["purchase_searches"], P["dash_start"],
                            P["dash_end"], P["dash_now"], P["dash_last_n"])


@register("metasearch_by_route")
def q_metasearch_by_route(t):
    """External searches per (origin, destination, source) in the window: count, newest time."""
    return metasearch_by_route(t["searches"], P["route_as_of"], P["route_days"])


@register("sales_by_route")
def q_sales_by_route(t):
    """Per route: sale rows (search x order x tracking) and the newest sale."""
    return sales_by_route(t["searches"], t["orders_booked"], t["order_tracking"],
                          P["route_as_of"], P["route_days"])


@register("tracking_rank")
def q_tracking_rank(t):
    """Tracking rows of the window with their recency rank per order (kept, not filtered)."""
    return tracking_rank(t["order_tracking"], P["route_as_of"], P["route_days"])


# ---------------------------------------------------------------- scorecard
def _scorecard(t):
    from .plans.scorecard import Scorecard
    key = "_scorecard"
    if key not in t._built:
        t._built[key] = Scorecard(t, start_date=P["start_date"], shift_from=P["shift_from"],
                                  as_of_ts=P["as_of_ts"])
    return t._built[key]


def _sc_key(name: str, attr: str, doc: str):
    def build(t):
        return getattr(_scorecard(t), attr)
    build.__name__ = f"q_{name}"
    build.__doc__ = doc
    register(name)(build)


for _name, _attr, _doc in [
    ("resolution_score_daily", "resolution_score_daily",
     "Weighted resolution rate per agent-day, display guard, band score."),
    ("recontact_daily", "recontact_daily", "Weighted recontacts per agent-day and roster area."),
    ("daily_resolved", "daily_resolved", "Incidents with an attendant per agent-day."),
    ("production_with_absence", "production_with_absence",
     "Worst production row per agent-day after the absence overlay."),
    ("production_score", "production_score", "Production scored by the shift's target."),
    ("cycle_score_monthly", "cycle_score_monthly", "Team on-time cycle ratio per month, scored."),
    ("knowledge_score_monthly", "knowledge_score_monthly", "Team knowledge grade per month."),
    ("dto_score_monthly", "dto_score_monthly", "Team DTO grade per month."),
    ("employee_day_spine", "employee_days", "Every agent x every contact day of the month."),
    ("scorecard_daily", "scorecard_daily", "The 24-column daily scorecard."),
    ("recontact_monthly", "recontact_monthly", "Monthly recontact ratio, descending score."),
    ("loss_penalty_daily", "loss_penalty_daily", "Rounded loss amounts and step penalties."),
    ("dto_individual", "dto_individual", "Individual DTO grade, imputed and scored."),
    ("knowledge_individual", "knowledge_individual", "Individual knowledge grade, scored."),
    ("csat_monthly", "csat_monthly", "Mean CSAT per agent and cut-off month, scored."),
    ("scorecard_final", "scorecard_final", "The 41-column scorecard with hierarchy."),
]:
    _sc_key(_name, _attr, _doc)


# ---------------------------------------------------------------- operator keys
# Each key below exercises one operator of SURVEY section 2 on the logical
# tables, at full size (no sampling), with its own oracle SQL.
FLOOR_DATE = _dt.date(2001, 1, 1)


@register("roster_filter")
def q_roster_filter(t):
    """Agent roster under the three spellings of the filter (upper, lower, exact)."""
    r = t["roster"]
    return union_all(*[roster_filter(r, m).select(F.lit(m).alias("mode"), "matricula",
                                                  "mes_referencia", "funcao", "area")
                       for m in ("upper", "lower", "exact")])


@register("rolling_days_filter")
def q_rolling_days_filter(t):
    """Tracking rows of the trailing N-day window (filter reaches the scan)."""
    return rolling_days_filter(t["order_tracking"], "created_at", P["route_as_of"],
                               P["route_days"])


@register("date_floor_filter")
def q_date_floor_filter(t):
    """Cycle positions on or after a fixed start date."""
    return date_floor_filter(t["cycle_positions"], "data_posicao", FLOOR_DATE)


@register("between_filter")
def q_between_filter(t):
    """Trip searches created within an inclusive timestamp range."""
    return between_filter(t["trip_searches"], "created_at", P["dash_start"], P["dash_end"])


@register("status_in_filter")
def q_status_in_filter(t):
    """Booked orders whose status is in the closed-sale set."""
    return status_in_filter(t["orders_booked"], "last_status", CLOSED_STATUSES)


@register("queue_not_in_filter")
def q_queue_not_in_filter(t):
    """Cycle positions outside the excluded queues (NULL queue dropped, as SQL NOT IN)."""
    return not_in_filter(t["cycle_positions"], "fila", ("Hotel", "Pacote"))


@register("null_tests")
def q_null_tests(t):
    """Flights missing one of the two refund ids, with IS NULL / IS NOT NULL flags."""
    cf = t["cancelled_flights"]
    return cf.select("id", F.col("refund_order_id").isNull().alias("money_missing"),
                     F.col("refund_order_miles_id").isNotNull().alias("has_miles")).filter(
        F.col("refund_order_id").isNull() | F.col("refund_order_miles_id").isNull())


@register("normalised_match")
def q_normalised_match(t):
    """Target rows matched with trimmed lower-case tipo, and the untrimmed test."""
    tg = t["targets"]
    return tg.filter((normalised("tipo", "lower", True) == "individual")
                     & (normalised("origem", "upper", False) == "PRIMARIO")).select(
        "ref", "indicador", "tipo", "origem",
        (normalised("tipo", "lower", False) == "individual").alias("untrimmed_match"))


@register("trailing_id_window")
def q_trailing_id_window(t):
    """Trip searches whose id is within N of the newest purchase-search id (scalar subquery)."""
    return trailing_id_window(t["trip_searches"], "id", t["purchase_searches"], "id",
                              P["dash_last_n"])


@register("distinct_rows")
def q_distinct_rows(t):
    """Distinct (order, reason) pairs of the refunded flights."""
    return t["cancelled_flights"].select("order_id", "reason_id").distinct()


@register("inner_join_sales")
def q_inner_join_sales(t):
    """Searches joined to the orders booked from them."""
    s, o = t["searches"], t["orders_booked"]
    j = s.join(o.select(F.col("id").alias("order_id"), "fk_search_id",
                        F.col("created_at").alias("order_created_at"), "last_status"),
               s["id"] == F.col("fk_search_id"))
    return j.select("id", "iata_from", "iata_to", "order_id", "order_created_at", "last_status")


@register("left_join_lookup")
def q_left_join_lookup(t):
    """Trip searches with their purchase-search attribute (left lookup)."""
    h, p = t["trip_searches"], t["purchase_searches"]
    p = p.select(F.col("id").alias("_pid"), "ap")
    return h.join(p, h["fk_purchase_searchs_id"] == p["_pid"], "left").select(
        "id", "fk_purchase_searchs_id", "ap")


@register("left_join_active")
def q_left_join_active(t):
    """Cancellations with their active bank row (inactive rows do not drop the cancellation)."""
    c, b = t["cancellations"], t["refund_bank_data"]
    b = b.filter(F.col("is_active") == F.lit(True)).select(
        "cancellation_id", "code_bank", "account_type")
    return split_left_join(c, b.withColumnRenamed("cancellation_id", "id"), ["id"]).select(
        "id", "code_bank", "account_type")


def _sc(t):
    return _scorecard(t)


@register("month_roster_join")
def q_month_roster_join(t):
    """Resolutions joined to the agent's roster row of the same month (one equi-key)."""
    j = month_roster_join(t["resolutions"], _sc(t).agents, "data_resolucao",
                          roster_cols=["area", "matricula_supervisor"])
    return j.select("data_resolucao", "matricula", "quantidade_incidentes", "area",
                    "matricula_supervisor")


@register("month_target_join")
def q_month_target_join(t):
    """Resolved counts per agent-day with the month's production target row."""
    cr = _sc(t).daily_resolved.withColumn("ym", month_key("data_"))
    j = month_target_join(cr, targets_for(t["targets"], "produtividade"))
    return j.select("data_", "matricula", "resolvidos_rec", "m_ouro", "p_ouro")


@register("collective_month_join")
def q_collective_month_join(t):
    """Every agent-day with the team cycle result of its month."""
    sc = _sc(t)
    c2 = sc.cycle_score_monthly.select(F.make_date("ano_ref", "mes_ref", F.lit(1)).alias("ym"),
                                       "valor_ciclo_c", "p_ciclo")
    d = sc.employee_days.withColumn("ym", month_key("dia"))
    return d.join(c2, "ym", "left").select("dia", "matricula", "valor_ciclo_c",
                                                        "p_ciclo")


@register("cast_key_join")
def q_cast_key_join(t):
    """CSAT answers (agent id as text) joined to the roster by id and month."""
    a = t["csat_answers"]
    ag = _sc(t).agents.select("matricula", month_key("mes_referencia").alias("_ym"))
    a = a.withColumn("_aym", month_key("data_das_respostas"))
    j = cast_key_join(ag, a.withColumnRenamed("matricula", "_txt"), "matricula", "_txt",
                      also=[("_ym", "_aym")])
    return j.select("data_das_respostas", "matricula", "media_")


@register("latest_log_join")
def q_latest_log_join(t):
    """Each flight with its newest log (ties: highest id)."""
    cf = t["cancelled_flights"].select("id")
    n = newest_log_per_flight(t["flight_logs"])
    j = cf.join(n, cf["id"] == n["cancellation_flight_id"])
    return j.select(cf["id"], n["id"].alias("log_id"), "cancellation_flight_status_id",
                    "created_original_at")


@register("refund_item_total")
def q_refund_item_total(t):
    """Each flight with the sum of its refund items (NULL without items)."""
    return refund_item_total(t["cancelled_flights"], t["refund_items"])


@register("loss_month_fanout")
def q_loss_month_fanout(t):
    """Agent-days joined to daily losses by month: one row per (day, loss day)."""
    sc = _sc(t)
    d = sc.employee_days.withColumn("ym", month_key("dia"))
    lo = sc.loss_penalty_daily.select(month_key("data_ref").alias("ym"), "matricula",
                                      "data_ref", "p_prejuizo")
    return split_left_join(d, lo, ["matricula", "ym"], least_rows=LOSSES_A_TASK).select(
        "dia", "matricula", "data_ref", "p_prejuizo")


@register("resolution_rate_daily")
def q_resolution_rate_daily(t):
    """Weighted resolution rate per (day, agent) without the roster."""
    y = t["resolutions"]
    q = F.col("quantidade_incidentes")
    w = q * queue_weight("fila") * interaction_discount("quantidade_interacoes")
    g = y.groupBy("data_resolucao", "matricula").agg(F.sum(w).alias("resolvidos"),
                                                      F.sum(q).alias("_q"))
    return g.select("data_resolucao", "matricula",
                    safe_div("resolvidos", "_q").alias("percent_resolucao"),
                    "resolvidos")


@register("monthly_grade_avg")
def q_monthly_grade_avg(t):
    """Mean knowledge and DTO grades of rostered agents per month."""
    return _sc(t).monthly_grade_avg


@register("cycle_rate_monthly")
def q_cycle_rate_monthly(t):
    """Mean daily on-time cycle ratio per month and renamed area."""
    return _sc(t).cycle_rate_monthly


@register("latest_sale_per_route")
def q_latest_sale_per_route(t):
    """Newest (search x order x tracking) row per route, ties by search id then source."""
    s = t["searches"].select("id", "iata_from", "iata_to")
    o = rolling_days_filter(t["orders_booked"], "created_at", P["route_as_of"], P["route_days"])
    o = status_in_filter(o, "last_status", CLOSED_STATUSES).select(
        F.col("id").alias("_oid"), "fk_search_id", "created_at")
    tr = rolling_days_filter(t["order_tracking"], "created_at", P["route_as_of"],
                             P["route_days"]).select("fk_order_id", F.col("source"))
    j = s.join(o, s["id"] == o["fk_search_id"]).join(tr, F.col("_oid") == tr["fk_order_id"])
    # newest per (route, source) by the fixed-width code, then among the few sources
    per = latest_per_key(j, ["iata_from", "iata_to", "source"], ["created_at", "fk_search_id"],
                         ["created_at", "fk_search_id"])
    best = F.array_max(F.collect_list(F.struct("created_at", "fk_search_id", "source")))
    return (per.groupBy("iata_from", "iata_to").agg(best.alias("_b"))
            .select("iata_from", "iata_to", "_b.fk_search_id", "_b.created_at", "_b.source"))


@register("sales_count_window")
def q_sales_count_window(t):
    """Every sale row with the number of sale rows of its route."""
    s = t["searches"].select("id", "iata_from", "iata_to")
    o = rolling_days_filter(t["orders_booked"], "created_at", P["route_as_of"], P["route_days"])
    o = status_in_filter(o, "last_status", CLOSED_STATUSES).select(
        F.col("id").alias("_oid"), "fk_search_id", "created_at")
    tr = rolling_days_filter(t["order_tracking"], "created_at", P["route_as_of"],
                             P["route_days"]).select("fk_order_id", "source")
    j = s.join(o, s["id"] == o["fk_search_id"]).join(tr, F.col("_oid") == tr["fk_order_id"])
    j = j.select("iata_from", "iata_to", "id", "created_at", "source")
    # counted from one row per order and route, not from the fanned-out rows
    per_order = tr.groupBy(F.col("fk_order_id").alias("_order")).agg(F.count(F.lit(1)).alias("_n"))
    counts = (s.join(o, s["id"] == o["fk_search_id"]).join(per_order, F.col("_oid") == F.col("_order"))
              .groupBy("iata_from", "iata_to").agg(F.sum("_n").alias("financial_count")))
    return partition_count(j, ["iata_from", "iata_to"], "id", "financial_count", counts)


@register("worst_production_per_day")
def q_worst_production_per_day(t):
    """Lowest production row per agent-day among shift/area rows (no absences)."""
    p = _sc(t).production_by_shift
    pick = F.array_min(F.collect_list(F.struct("producao", "area", "escala")))
    return (p.groupBy("data_resolucao", "matricula").agg(pick.alias("_b"))
            .select("data_resolucao", "matricula", "_b.producao", "_b.area", "_b.escala"))


@register("recontact_events")
def q_recontact_events(t):
    """UNION ALL of the two dated events of each recontact."""
    r = t["recontacts"]
    return union_all(
        r.select(F.to_date("data_ultima_criacao").alias("data_"), "matricula", "fila", "area"),
        r.select(F.to_date("data_respondido_cliente").alias("data_"), "matricula", "fila", "area"))


@register("union_distinct")
def q_union_distinct(t):
    """Production rows UNION absence rows (duplicates removed)."""
    sc = _sc(t)
    return union_distinct(sc.production_by_shift.select(
        "data_resolucao", "matricula", "area", "producao", "escala"), sc.absence_production)


@register("union_null_padded")
def q_union_null_padded(t):
    """Scored production UNION absence rows that only carry the production points."""
    sc = _sc(t)
    full = sc.production_score
    part = sc.absence_rows.select("data_resolucao", "matricula", "p_produtividade")
    return union_null_padded(full, part, distinct=True)


@register("date_parts")
def q_date_parts(t):
    """Year, month, day and calendar dates of trip searches."""
    h = t["trip_searches"]
    p = date_parts("created_at")
    return h.select("id", p["year"].alias("ano"), p["month"].alias("mes"),
                    p["day"].alias("dia"), p["date"].alias("data"),
                    F.to_date("checkin").alias("checkin"))


@register("fiscal_shift")
def q_fiscal_shift(t):
    """Every contact day and its fiscal day (shift from ``shift_from``)."""
    d = t["contact_calendar"].select(F.to_date("created").alias("dia")).distinct()
    return d.select("dia", fiscal_shift("dia", P["shift_from"]).alias("data"))


def _scored(t, indicator: str, value_df, value: str, **kw):
    df = value_df.withColumn("ym", month_key("dia"))
    j = month_target_join(df, targets_for(t["targets"], indicator))
    return j.select("dia", "matricula", value, band_score(value, Bands(), **kw).alias("score"))


@register("band_score_capped")
def q_band_score_capped(t):
    """Resolved counts scored on the production bands, capped at the top band."""
    cr = _sc(t).daily_resolved.select(F.col("data_").alias("dia"), "matricula", "resolvidos_rec")
    return _scored(t, "produtividade", cr, "resolvidos_rec")


@register("band_score_extrapolated")
def q_band_score_extrapolated(t):
    """Resolved counts scored on the production bands, extrapolated above the top."""
    cr = _sc(t).daily_resolved.select(F.col("data_").alias("dia"), "matricula", "resolvidos_rec")
    return _scored(t, "produtividade", cr, "resolvidos_rec", above="extrapolate")


@register("band_score_descending")
def q_band_score_descending(t):
    """On-time ratios scored on descending (lower is better) bands."""
    c = t["cycle_positions"].select(
        F.col("data_posicao").alias("dia"), F.lit(0).cast("bigint").alias("matricula"),
        safe_div(F.col("qtde_respondido_dentro_prazo"), F.col("qtde_total")).alias("ratio"))
    return _scored(t, "recorrencia", c, "ratio", direction="down")


@register("band_score_imputed")
def q_band_score_imputed(t):
    """Individual DTO grades, missing ones imputed below gold, scored and rounded."""
    g = t["monthly_grades"].withColumn("ym", F.make_date("ano_ref", "mes_ref", F.lit(1)))
    j = month_target_join(g, targets_for(t["targets"], "dto", origem_case="lower"))
    v, s = imputed_band_score("nota_dto", Bands())
    return j.select("ano_ref", "mes_ref", "matricula", v.alias("dto"), s.alias("p_dto_i"))


@register("shift_class_production")
def q_shift_class_production(t):
    """Incidents per agent-day, roster area and shift class."""
    return _sc(t).production_by_shift.select("data_resolucao", "matricula", "area", "escala",
                                             "producao")


@register("refund_kind")
def q_refund_kind(t):
    """Refund kind of each flight from which refund ids it carries."""
    cf = t["cancelled_flights"]
    return cf.select("id", "refund_order_id", "refund_order_miles_id",
                     refund_kind("refund_order_id", "refund_order_miles_id").alias("tipo"))


@register("shift_class")
def q_shift_class(t):
    """Shift class of each roster row from its start and end times."""
    r = t["roster"]
    return r.select("matricula", "mes_referencia", "horario_inicio", "horario_fim",
                    shift_class("horario_inicio", "horario_fim").alias("escala"))


@register("search_dashboard_sql")
def q_search_dashboard_sql(t):
    """search_dashboard written as one parameterised spark.sql statement."""
    return search_dashboard_sql(t["trip_searches"], t["purchase_searches"], P["dash_start"],
                                P["dash_end"], P["dash_now"], P["dash_last_n"])
