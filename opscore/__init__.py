"""opscore: operations and demand analytics as Spark DataFrame plans.

Layout
------
sources/    input contracts (StructType per logical table) and loaders
functions/  Column-level helpers: safe division, target-band scores,
            fiscal calendars, CASE labels
operators/  DataFrame-level building blocks: filters, month-keyed joins,
            latest-row joins, aggregates, windows, set operations
plans/      the finished queries (route demand, refund ledger, search
            dashboard, agent scorecard)
oracle/     DuckDB SQL used as an independent correctness oracle
"""

__version__ = "0.1.0"

from .plans.refunds import refund_ledger, refund_status_union  # noqa: E402
from .plans.route_demand import route_demand  # noqa: E402
from .plans.scorecard import Scorecard  # noqa: E402
from .plans.search_dashboard import search_dashboard, search_dashboard_sql  # noqa: E402
from .sources import CONTRACTS, DriverTables, conform  # noqa: E402

__all__ = ["Scorecard", "route_demand", "refund_ledger", "refund_status_union",
           "search_dashboard", "search_dashboard_sql", "CONTRACTS", "DriverTables", "conform"]
