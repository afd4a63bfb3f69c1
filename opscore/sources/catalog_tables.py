"""Logical tables read from the session catalog (``spark.table``).

Production use: map each logical name to the table that holds it, e.g.
``{"roster": "hr.agent_roster", "resolutions": "support.resolutions", ...}``.
Every table is checked against its contract and cast on first use; the
result plugs into the plans exactly like ``DriverTables``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .contracts import CONTRACTS, conform


class CatalogTables:
    def __init__(self, spark: SparkSession, names: Mapping[str, str]):
        unknown = set(names) - set(CONTRACTS)
        if unknown:
            raise KeyError(f"no contract for {sorted(unknown)}")
        self.spark = spark
        self.names = dict(names)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name not in self.names:
                raise KeyError(f"no table mapped for logical table {name!r}")
            self._built[name] = conform(self.spark.table(self.names[name]), name)
        return self._built[name]

    def __contains__(self, name: str) -> bool:
        return name in self.names
