"""Logical input tables derived from the driver's TPC-H-style parquet tables.

The analytics read operational tables (roster, resolutions, searches, refund
logs ...).  For tests and benchmarks those are derived from the generated
``orders``/``lineitem``/``supplier``/... parquet with plain projections, so
every query's work grows with the data.  The same mapping exists as DuckDB
SQL in ``opscore.oracle.views``; both follow FIXTURES.md section B.

Nothing here collects: month lists and supplier counts are scalar
subqueries or broadcast joins against calendar-bounded relations.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .contracts import conform

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")

# The scorecard's target sheet used for tests and benchmarks
# (FIXTURES.md, "targets").  Columns: indicador, tipo, origem, six m_
# thresholds (alerta, bronze, prata, ouro, 1, 2), six p_ points.
_P = (0.0, 20.0, 40.0, 60.0, 80.0, 100.0)
TARGET_SHEET = [
    ("Resolutividade", " Individual ", "Primario", (0.1, 0.2, 0.3, 0.4, 0.5, 0.6), _P),
    ("Produtividade", "individual", "PRIMARIO", (5.0, 15.0, 25.0, 35.0, 45.0, 60.0), _P),
    ("Produtividade_madrugada", "individual", "PRIMARIO", (4.0, 12.0, 20.0, 28.0, 36.0, 48.0), _P),
    ("Produtividade_comercial", "individual", "PRIMARIO", (6.0, 18.0, 30.0, 42.0, 54.0, 66.0), _P),
    ("Ciclo 10 dias", "Coletivo", "PRIMARIO", (0.1, 0.2, 0.3, 0.4, 0.5, 0.6), _P),
    ("Conhecimento Corporativo", "coletivo", "PRIMARIO", (5.0, 6.0, 7.0, 8.0, 9.0, 10.0), _P),
    ("Conhecimento Corporativo", "individual", "PRIMARIO", (5.0, 6.0, 7.0, 8.0, 9.0, 10.0), _P),
    ("DTO", "coletivo", "PRIMARIO", (5.0, 6.0, 7.0, 8.0, 9.0, 10.0), _P),
    ("DTO", " Individual ", "primario", (5.0, 6.0, 7.0, 8.0, 9.0, 10.0), _P),
    ("CSAT", "individual", "PRIMARIO", (1.0, 1.5, 2.0, 3.0, 4.0, 5.0), _P),
    ("Recorrencia", "individual", "PRIMARIO", (0.5, 0.4, 0.3, 0.2, 0.1, 0.05), _P),
]
LEVELS = ("alerta", "bronze", "prata", "ouro", "1", "2")

class DriverTables:
    """Lazy, memoised logical tables over one driver data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}
        self._built: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """Scan of one driver table, listed once per object."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = conform(getattr(self, f"_build_{name}")(), name)
        return self._built[name]

    # ---- shared helpers -------------------------------------------------
    @cached_property
    def month_list(self) -> Column:
        """Sorted distinct months with orders, as one
        scalar subquery (an array bounded by the calendar: at most 12 per
        year).  Every month-derived fixture (roster, targets, grades, team
        extras) expands this one value instead of rescanning orders."""
        return self.raw("orders").select(F.sort_array(F.collect_set(
            F.to_date(F.date_trunc("month", "o_orderdate"))))).scalar()

    @cached_property
    def months(self) -> DataFrame:
        """One row per month of :attr:`month_list`."""
        return self.spark.range(1).select(F.explode(self.month_list).alias("ref"))

    def _supplier_months(self) -> DataFrame:
        """supplier x months without a join: each supplier row expands the
        calendar-bounded month list."""
        return self.raw("supplier").select("*", F.explode(self.month_list).alias("ref"))

    def _supplier_count(self) -> Column:
        return self.raw("supplier").select(F.count(F.lit(1))).scalar()

    # Each builder is one projection written as SQL expressions (one call
    # to the JVM per table instead of one per expression node).

    # ---- route demand ---------------------------------------------------
    def _build_searches(self) -> DataFrame:
        o, c = self.raw("orders"), self.raw("customer")
        return o.join(c, o.o_custkey == c.c_custkey).selectExpr(
            "o_orderkey AS id", "concat('N', CAST(c_nationkey AS STRING)) AS iata_from",
            "o_orderpriority AS iata_to", "o_orderstatus AS external_user",
            "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') "
            "THEN 'ExternalSearch' ELSE 'Site' END AS browser_id",
            "o_orderdate AS created_at")

    def _build_orders_booked(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS id", "o_orderkey AS fk_search_id", "o_orderdate AS created_at",
            "CASE o_orderstatus WHEN 'F' THEN 56 WHEN 'O' THEN 60 ELSE 1 END AS last_status")

    def _build_order_tracking(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "l_orderkey AS fk_order_id", "l_shipdate AS created_at",
            "CASE l_returnflag WHEN 'A' THEN 'F' WHEN 'N' THEN 'O' ELSE 'P' END AS source")

    # ---- refunds --------------------------------------------------------
    def _build_cancelled_flights(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS id", "o_custkey AS order_id", "o_totalprice AS total_refund",
            "CASE WHEN o_orderstatus IN ('F', 'P') AND o_orderkey % 10 <> 0 "
            "THEN o_orderkey END AS refund_order_id",
            "CASE WHEN o_orderstatus IN ('O', 'P') AND o_orderkey % 10 <> 0 "
            "THEN o_orderkey END AS refund_order_miles_id",
            "CAST(substr(o_orderpriority, 1, 1) AS INT) AS reason_id",
            "o_orderdate AS created_at")

    def _build_refund_items(self) -> DataFrame:
        return self.raw("lineitem").where("l_returnflag = 'R'").selectExpr(
            "l_orderkey AS cancellation_flight_id", "l_extendedprice AS total_refund")

    def _build_cancellations(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS id", "o_orderkey AS cancellable_id",
            "concat('agent_', CAST(o_custkey % 50 AS STRING)) AS created_name")

    def _build_refund_bank_data(self) -> DataFrame:
        return self.raw("orders").where("o_orderkey % 5 <> 0").selectExpr(
            "o_orderkey AS cancellation_id", "CAST(o_custkey % 30 AS INT) AS code_bank",
            "'0001' AS agency", "CAST(o_custkey AS STRING) AS account_number",
            "CASE o_orderkey % 3 WHEN 1 THEN 1 WHEN 2 THEN 2 END AS account_type",
            "'Holder' AS cardholder_name", "'000' AS cardholder_document",
            "o_orderkey % 4 <> 0 AS is_active")

    def _build_banks(self) -> DataFrame:
        return self.raw("nation").selectExpr("n_nationkey AS code_bank",
                                             "n_name AS short_name")

    _FLAG_CODE = "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END"

    def _build_flight_logs(self) -> DataFrame:
        return (self.raw("lineitem").groupBy("l_orderkey", "l_linenumber")
                .agg(F.expr(f"max({self._FLAG_CODE})").alias("cancellation_flight_status_id"),
                     F.max("l_shipdate").alias("created_original_at"))
                .selectExpr("l_orderkey * 10 + l_linenumber AS id",
                            "l_orderkey AS cancellation_flight_id",
                            "cancellation_flight_status_id", "created_original_at"))

    def _build_flight_statuses(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            f"{self._FLAG_CODE} AS id",
            "concat('status_', l_returnflag) AS description").distinct()

    def _build_cancel_reasons(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "CAST(substr(o_orderpriority, 1, 1) AS INT) AS id",
            "o_orderpriority AS description").distinct()

    def _build_refund_reports(self) -> DataFrame:
        return self.raw("orders").where("o_orderstatus <> 'O'").selectExpr(
            "o_orderkey AS id", "o_orderstatus AS status")

    def _build_refund_extra(self) -> DataFrame:
        return self.raw("orders").where("o_orderstatus <> 'F'").selectExpr(
            "o_orderkey AS id", "o_orderstatus AS status")

    # ---- search dashboard -----------------------------------------------
    def _build_trip_searches(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "event_id AS id", "ts AS created_at", "user_id % 20 AS destination_id",
            "date_add(to_date(ts), CAST(event_id % 40 AS INT)) AS checkin",
            "user_id AS fk_purchase_searchs_id")

    def _build_purchase_searches(self) -> DataFrame:
        return self.raw("customer").selectExpr("c_custkey AS id", "c_mktsegment AS ap")

    # ---- scorecard --------------------------------------------------------
    def _build_roster(self) -> DataFrame:
        # every eleventh agent also has a second roster row (another shift and
        # spelling of the area) in the even months
        rows = self._supplier_months().selectExpr(
            "*", "explode(CASE WHEN s_suppkey % 11 = 2 AND month(ref) % 2 = 0 "
            "THEN array(0, 1) ELSE array(0) END) AS extra")
        return rows.selectExpr(
            "s_suppkey AS matricula", "ref AS mes_referencia",
            "CASE WHEN s_suppkey % 5 = 0 THEN 'Chat' WHEN s_suppkey % 5 = 1 THEN 'e-mail' "
            "ELSE 'E-MAIL' END AS funcao",
            "CASE extra WHEN 0 THEN 'Relacionamento Primário' "
            "ELSE 'RELACIONAMENTO PRIMÁRIO' END AS area",
            "CASE (s_suppkey + extra) % 3 WHEN 0 THEN '00:00:00' WHEN 1 THEN '06:00:00' "
            "ELSE '08:00:00' END AS horario_inicio",
            "CASE (s_suppkey + extra) % 3 WHEN 0 THEN '06:00:00' WHEN 1 THEN '15:00:00' "
            "ELSE '17:00:00' END AS horario_fim",
            "'PRIMARIO' AS origem", "'individual' AS tipo",
            "s_nationkey AS matricula_supervisor",
            "concat('S', CAST(s_nationkey AS STRING)) AS supervisor",
            "s_nationkey % 5 AS matricula_coordenador",
            "concat('C', CAST(s_nationkey % 5 AS STRING)) AS coordenador",
            "1 AS matricula_gerente", "'G1' AS gerente")

    def _build_targets(self) -> DataFrame:
        rows = []
        for ind, tipo, orig, m, p in TARGET_SHEET:
            nums = ", ".join(f"CAST({v!r} AS DOUBLE)" for v in (*m, *p))
            rows.append(f"struct('{ind}', '{tipo}', '{orig}', {nums})")
        names = ["indicador", "tipo", "origem"] + [f"{k}_{lv}" for k in ("m", "p")
                                                    for lv in LEVELS]
        sheet = f"inline(array({', '.join(rows)}))"
        return self.months.selectExpr("ref", f"{sheet} AS ({', '.join(names)})")

    def _build_resolutions(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "to_date(l_shipdate) AS data_resolucao", "l_suppkey AS matricula",
            "CASE WHEN l_linenumber < 7 THEN l_linenumber END AS quantidade_interacoes",
            "l_quantity AS quantidade_incidentes",
            "CASE l_returnflag WHEN 'A' THEN 'Cancelamento/remarcação' "
            "WHEN 'N' THEN 'Remarcação ' ELSE 'Pendências Reembolso' END AS fila",
            "CASE WHEN l_linestatus = 'O' THEN 'x' END AS atendente")

    def _build_recontacts(self) -> DataFrame:
        return self.raw("lineitem").where("l_linenumber >= 5").selectExpr(
            "l_shipdate AS data_ultima_criacao",
            "l_shipdate + INTERVAL 2 DAYS AS data_respondido_cliente",
            "l_suppkey AS matricula",
            "CASE l_returnflag WHEN 'A' THEN 'Cancelamento/remarcação' WHEN 'N' THEN 'Pacote' "
            "ELSE 'Pendências Reembolso' END AS fila",
            "'Relacionamento Primário' AS area")

    def _build_absences(self) -> DataFrame:
        o = self.raw("orders").where("o_orderpriority = '5-LOW'")
        return o.select(
            F.expr("to_date(o_orderdate)").alias("data_ref"),
            (F.col("o_custkey") % self._supplier_count()).alias("matricula"),
            F.expr("'Nome'").alias("nome_colaborador"), F.expr("'PRIMARIO'").alias("origem"),
            F.expr("CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END").alias("falta_injustificada"),
            F.expr("CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END").alias("faltas_justificadas"),
            F.expr("CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END").alias("faltas_outros"))

    def _build_contact_calendar(self) -> DataFrame:
        return self.raw("orders").selectExpr("o_orderdate AS created")

    def _build_cycle_positions(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "to_date(l_shipdate) AS data_posicao",
            "CASE WHEN l_linestatus = 'O' THEN 'Atendimento Primário' "
            "ELSE 'Atendimento Especializado' END AS area",
            "CASE l_returnflag WHEN 'A' THEN 'Hotel' WHEN 'N' THEN 'Aéreo' END AS fila",
            "CASE WHEN l_quantity = l_linenumber - 1 THEN 0 "
            "ELSE least(l_linenumber, CAST(l_quantity AS INT)) END "
            "AS qtde_respondido_dentro_prazo",
            "CAST(l_quantity AS INT) AS qtde_total",
            "l_linenumber - 1 AS qtde_nao_respondido_fora_prazo_resolvido")

    def _build_monthly_grades(self) -> DataFrame:
        return self._supplier_months().where("(s_suppkey + month(ref)) % 4 <> 0").selectExpr(
            "year(ref) AS ano_ref", "month(ref) AS mes_ref", "s_suppkey AS matricula",
            "CAST((s_suppkey * 7 + month(ref) * 3) % 50 AS DOUBLE) / 10 + 5 "
            "AS nota_conhecimento",
            "CASE WHEN s_suppkey % 7 = 0 THEN NULL "
            "ELSE CAST((s_suppkey * 11 + month(ref)) % 50 AS DOUBLE) / 10 + 5 END AS nota_dto")

    def _build_collective_extras(self) -> DataFrame:
        return self.months.where("month(ref) <> 6").selectExpr(
            "year(ref) AS ano_ref", "month(ref) AS mes_ref",
            "CAST(month(ref) AS DOUBLE) AS reclamacoes", "CAST(5 AS DOUBLE) AS p_reclamacoes",
            "CAST(70 AS DOUBLE) AS nps", "CAST(10 AS DOUBLE) AS p_nps",
            "CAST(3 AS DOUBLE) AS redes_sociais", "CAST(2 AS DOUBLE) AS p_redes_sociais")

    def _build_losses(self) -> DataFrame:
        o = self.raw("orders").where("o_orderstatus = 'P'")
        return o.select(
            F.expr("to_date(o_orderdate)").alias("data_ref"),
            (F.col("o_custkey") % self._supplier_count()).alias("solicitante_matricula"),
            F.expr("CAST(o_totalprice / 30 AS STRING)").alias("reembolso_valor_prejuizo"))

    def _build_csat_answers(self) -> DataFrame:
        o = self.raw("orders").where("o_orderpriority = '1-URGENT'")
        return o.select(
            F.expr("to_date(o_orderdate)").alias("data_das_respostas"),
            (F.col("o_custkey") % self._supplier_count()).cast("string").alias("matricula"),
            F.expr("CAST(o_orderkey % 6 AS DOUBLE)").alias("media_"))
