"""Weekly freshness of a new load against the stored baseline, and load-log checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propscan.config import Config
from propscan.functions.parse import days_between
from propscan.operators.windows import with_cut, with_streak


def weekly_status(fresh: DataFrame, baseline: DataFrame, key: str, c: Config | None = None, mode: str = "forward") -> DataFrame:
    """Add ``status`` (new, unverifiable, recent, stale) and ``kept``. ``fresh`` has ``updated_at``, ``baseline`` ``scraped_at``.

    Keys that the baseline doesn't know are new; a missing date is unverifiable and kept; a gap of less
    than ``fresh_days`` is recent. ``mode='abs'`` ignores which of the two dates is later.
    """
    c = c or Config()
    known = baseline.select(key, F.col("scraped_at").alias("_then"), F.lit(True).alias("_known"))
    gap = days_between(F.col("_then"), F.col("updated_at"), "abs" if mode == "abs" else "forward")
    status = F.when(F.col("_known").isNull(), "new").when(gap.isNull(), "unverifiable").when(gap < c.fresh_days, "recent").otherwise("stale")
    return fresh.join(known, key, "left").withColumn("status", status).withColumn("kept", F.col("status") != "stale").drop("_then", "_known")


def status_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count("*").alias("n"))


def breaker(log: DataFrame, group: list[str], order: list[str], blocked: Column, k: int) -> DataFrame:
    """Add ``attempted``: false after ``k`` blocked loads in a row; an unknown load isn't blocked."""
    rows = with_cut(with_streak(log, group, order, F.coalesce(blocked, F.lit(False)), "_streak"), group, F.col("_streak") >= k)
    return rows.withColumn("attempted", F.col("_cut").isNull() | (F.col("_at") <= F.col("_cut"))).select(*log.columns, "attempted")


def last_lines(log: DataFrame, run: str, order: str, n: int = 500) -> DataFrame:
    """The last ``n`` lines of each run."""
    return log.withColumn("_n", F.row_number().over(Window.partitionBy(run).orderBy(F.desc(order)))).where(F.col("_n") <= n).drop("_n")


def coverage(found: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, found, expected, share``: rows loaded against the number a hub announced."""
    n = found.groupBy(*keys).agg(F.count("*").alias("found"))
    return expected.join(n, keys, "left").withColumn("found", F.coalesce("found", F.lit(0))).withColumn("share", F.try_divide("found", "expected"))


def expected_minutes(runs: DataFrame, k: int = 4) -> DataFrame:
    """``source, minutes``: mean duration of each source's last ``k`` runs (``source, started, minutes``)."""
    n = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("started")))
    return runs.withColumn("_n", n).where(F.col("_n") <= k).groupBy("source").agg(F.avg("minutes").alias("minutes"))


def load_status(log: DataFrame) -> DataFrame:
    """``source, status, at``: the latest status of each source."""
    return log.groupBy("source").agg(F.max_by("status", "at").alias("status"), F.max("at").alias("at"))
