"""Searches seen vs. sales closed per route over a trailing window.

Per (origin, destination, source): how many external searches were seen,
and for the route's newest sale (if it came from that same source) how many
sale rows the route had in the window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import order_code
from ..operators.filters import rolling_days_filter, status_in_filter
from ..operators.windows import WINDOW_ROWS, ranked

# Order statuses counted as closed sales; the external-search
# browser tag.
CLOSED_STATUSES = (56, 60)
EXTERNAL_BROWSER = "ExternalSearch"


def tracking_rank(tracking: DataFrame, as_of, days: int = 30, least_rows: int = WINDOW_ROWS) -> DataFrame:
    """Tracking rows of the window with their recency rank per order (rn=1 newest).

    Equal times are ordered by source (descending); rows equal in every
    column are interchangeable, so the result is deterministic.  The rank is
    computed by :func:`ranked` day by day, and by cuts of a day with very many rows, so a
    heavily tracked order is many windows instead of one sort in one task.
    """
    t = rolling_days_filter(tracking, "created_at", as_of, days)
    t = t.select("fk_order_id", "created_at", "source")
    return ranked(t, ["fk_order_id"],
                  [F.col("created_at").desc_nulls_last(), F.col("source").desc_nulls_last()],
                  alias="rn", tie_cols=["fk_order_id", "created_at", "source"],
                  bucket=F.to_date("created_at"), value=F.unix_micros(F.col("created_at").cast("timestamp")),
                  least_rows=least_rows)


def metasearch_by_route(searches: DataFrame, as_of, days: int = 30) -> DataFrame:
    """External searches per (from, to, user): count and newest time."""
    s = rolling_days_filter(searches, "created_at", as_of, days)
    s = s.filter(F.col("browser_id") == EXTERNAL_BROWSER)
    return (s.groupBy("iata_from", "iata_to", "external_user")
            .agg(F.count("id").alias("metasearch_count"),
                 F.max("created_at").alias("created_at"))
            .select(F.col("iata_from").alias("iata_origem"),
                    F.col("iata_to").alias("iata_destino"),
                    "metasearch_count", F.col("external_user").alias("source"),
                    "created_at"))


def sales_by_route(searches: DataFrame, orders: DataFrame, tracking: DataFrame,
                   as_of, days: int = 30) -> DataFrame:
    """Per route: number of (search x order x tracking) rows and the newest one.

    Each tracking row of an order is a separate sale row (the count is of
    those rows).  Tracking is reduced to one row per (order, source) first -
    the only tracking fields the report reads - with a hash aggregate
    (source is a grouping key, so no sort-based aggregation over the largest
    table), and a heavily tracked order cannot skew the join.  The newest
    row is max(created_at, fk_search_id, source) over the same candidate
    tuples, found per source first.
    """
    t = rolling_days_filter(tracking, "created_at", as_of, days)
    per_order = (t.groupBy("fk_order_id", F.col("source").alias("_source"))
                 .agg(F.count(F.lit(1)).alias("_rows")))
    o = rolling_days_filter(orders, "created_at", as_of, days)
    o = status_in_filter(o, "last_status", CLOSED_STATUSES)
    s = searches.select("id", "iata_from", "iata_to")
    so = s.join(o.select(F.col("id").alias("_oid"), "fk_search_id", "created_at"),
                s["id"] == F.col("fk_search_id"))
    sot = so.join(per_order, so["_oid"] == per_order["fk_order_id"])
    # the newest sale of each (route, source) by its fixed-width (time, id) code:
    # a hash aggregate; the few sources of a route then compare as structs
    code = order_code(sot, ["created_at", "fk_search_id"])
    per_source = (sot.withColumn("_order", F.expr(code))
                  .groupBy("iata_from", "iata_to", "_source")
                  .agg(F.sum("_rows").alias("_rows"), F.max("_order").alias("_order"),
                       F.max_by("created_at", "_order").alias("created_at"),
                       F.max_by("fk_search_id", "_order").alias("fk_search_id")))
    newest = F.array_max(F.collect_list(F.struct("created_at", "fk_search_id", "_source")))
    return (per_source.groupBy("iata_from", "iata_to")
            .agg(F.sum("_rows").alias("financial_count"), newest.alias("_newest"))
            .select(F.col("iata_from").alias("iata_origem"),
                    F.col("iata_to").alias("iata_destino"), "financial_count",
                    F.col("_newest.fk_search_id").alias("fk_search_id"),
                    F.col("_newest.created_at").alias("created_at"),
                    F.col("_newest._source").alias("source")))


def route_demand(searches: DataFrame, orders: DataFrame, tracking: DataFrame,
                 as_of, days: int = 30) -> DataFrame:
    m = metasearch_by_route(searches, as_of, days).alias("m")
    f = sales_by_route(searches, orders, tracking, as_of, days).alias("f")
    cond = ((F.col("m.iata_origem") == F.col("f.iata_origem"))
            & (F.col("m.iata_destino") == F.col("f.iata_destino"))
            & (F.col("m.source") == F.col("f.source")))
    out = m.join(f, cond, "left").select(
        F.col("m.iata_origem").alias("iata_origem"),
        F.col("m.iata_destino").alias("iata_destino"),
        F.col("m.metasearch_count").alias("metasearch_count"),
        F.coalesce(F.col("f.financial_count"), F.lit(0)).alias("financial_count"),
        F.col("f.fk_search_id").alias("ultimo_fk_search_id"),
        F.col("f.created_at").alias("ultimo_created_at"),
        F.col("m.created_at").alias("metasearch_created_at"),
        F.col("m.source").alias("source"))
    return out.orderBy(F.col("source").asc_nulls_last(), F.col("iata_origem").asc_nulls_last(),
                       F.col("iata_destino").asc_nulls_last())
