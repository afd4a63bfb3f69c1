"""A written scorecard that is kept up to date month by month.

The daily card and the final table are Parquet, partitioned by fiscal month (``ym`` of the reported
day).  A refresh names the calendar months whose inputs changed, also by late rows; only the fiscal
months that these can reach are computed again, from inputs cut to their days, and their partitions replaced.

A fiscal month reads the days from the 26th of the month before to its own end, and the monthly sheets of both, so
an input month reaches its own and the next fiscal month.  Every daily row belongs to one fiscal
month, whole rows are only compared within it, and all monthly sides are joined by it: the
refreshed table equals a full run's, but for the update stamp of months that were not touched.

A refresh that fails half-way is run again: it replaces the same partitions.  Partitions are replaced by Spark's dynamic
overwrite, one table after the other, so a reader may see the new daily card before the new final table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import month_key
from ..operators.filters import as_date
from .scorecard import Scorecard

# The date columns of the inputs that decide which months a row belongs to.
INPUT_DAYS = {
    "resolutions": ("data_resolucao",), "recontacts": ("data_ultima_criacao", "data_respondido_cliente"),
    "absences": ("data_ref",), "contact_calendar": ("created",), "cycle_positions": ("data_posicao",),
    "losses": ("data_ref",), "csat_answers": ("data_das_respostas",), "roster": ("mes_referencia",), "targets": ("ref",),
}
INPUT_MONTHS = ("monthly_grades", "collective_extras")


def next_month(month: _dt.date) -> _dt.date:
    return (month.replace(day=1) + _dt.timedelta(days=31)).replace(day=1)


def touched_months(changed: Mapping[str, DataFrame]) -> set[_dt.date]:
    """The calendar months of changed input rows (new, late, corrected or removed ones), by logical table."""
    found: set[_dt.date] = set()
    for name, rows in changed.items():
        if name in INPUT_MONTHS:
            months = [F.make_date("ano_ref", "mes_ref", F.lit(1))]
        else:
            months = [month_key(c) for c in INPUT_DAYS[name]]
        seen = rows.select(F.explode(F.array(*months)).alias("m")).filter("m IS NOT NULL").distinct()
        found |= {r["m"] for r in seen.collect()}
    return found


def reached_months(touched: Iterable) -> list[_dt.date]:
    """The fiscal months that inputs of these calendar months can change."""
    first = {as_date(m).replace(day=1) for m in touched}
    return sorted(first | {next_month(m) for m in first})


class ScorecardStore:
    """The daily and the final scorecard under ``folder`` (shared by all executors)."""

    def __init__(self, spark: SparkSession, folder: str, start_date, shift_from):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.start, self.shift_from = as_date(start_date), as_date(shift_from)

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    @property
    def daily(self) -> DataFrame:
        return self.spark.read.parquet(self._path("daily")).drop("ym")

    @property
    def final(self) -> DataFrame:
        return self.spark.read.parquet(self._path("final")).drop("ym")

    def _card(self, tables: Mapping[str, DataFrame], as_of_ts, months=None) -> Scorecard:
        return Scorecard(tables, self.start, self.shift_from, as_of_ts, months)

    def build(self, tables: Mapping[str, DataFrame], as_of_ts=None) -> None:
        """Write all months, in place of whatever is there."""
        card = self._card(tables, as_of_ts)
        self._write(card.scorecard_daily, "daily", "overwrite", "static")
        card.read_daily(self.daily)
        self._write(card.scorecard_final, "final", "overwrite", "static")

    def refresh(self, tables: Mapping[str, DataFrame], touched: Iterable, as_of_ts=None) -> list[_dt.date]:
        """Replace the fiscal months that the ``touched`` calendar months reach; returns them.

        ``tables`` are the whole inputs as they are now; only the days of those months are read of the daily ones.
        Months that have no rows any more lose their partitions.
        """
        first = self.start.replace(day=1)
        months = [m for m in reached_months(touched) if m >= first]
        if not months:
            return []
        card = self._card(tables, as_of_ts, months)
        self._replace(card.scorecard_daily, "daily", months)
        card.read_daily(self.spark.read.parquet(self._path("daily")).filter(F.col("ym").isin(months)).drop("ym"))
        self._replace(card.scorecard_final, "final", months)
        return months

    def _write(self, df: DataFrame, name: str, mode: str, overwrite: str) -> None:
        by_month = df.withColumn("ym", month_key("data_resolucao"))
        by_month.write.mode(mode).option("partitionOverwriteMode", overwrite).partitionBy("ym").parquet(self._path(name))

    def _replace(self, df: DataFrame, name: str, months: list[_dt.date]) -> None:
        written = Observation()
        seen = df.observe(written, F.collect_set(month_key("data_resolucao")).alias("months"))
        self._write(seen, name, "overwrite", "dynamic")
        for month in set(months) - set(written.get["months"]):
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self._path(name)}/ym={month.isoformat()}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
