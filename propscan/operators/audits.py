"""Audits of loaded tables: filled fields, keys, volumes, log levels, and the schema of their records."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def is_filled(column: Column) -> Column:
    """Known, and not blank as a text."""
    return F.coalesce(F.trim(column.cast("string")) != "", F.lit(False))


def fill_rates(df: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """``group, field, n, filled, share``: one row a field, by one pass of counts."""
    counts = df.groupBy(*group).agg(F.count("*").alias("_n"), *[F.count_if(is_filled(F.col(c))).alias(f"_f_{c}") for c in columns])
    rows = counts.select(*group, F.col("_n").alias("n"), F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"_f_{c}").alias("filled")) for c in columns))).alias("f"))
    return rows.select(*group, "f.field", "n", "f.filled", F.try_divide("f.filled", "n").alias("share"))


def quality_table(df: DataFrame, source: str = "source") -> DataFrame:
    """Per source and in total (null source): rows, and how many have a surface, a deadline and coordinates."""
    has = lambda *cs: F.count_if(F.greatest(*(F.col(c).isNull().cast("int") for c in cs), F.lit(0)) == 0)
    return df.rollup(source).agg(F.count("*").alias("n"), has("sqm").alias("with_sqm"), has("deadline").alias("with_deadline"), has("lat", "lon").alias("with_place"))


def key_audit(df: DataFrame, key: str, pattern: str, group: list[str]) -> DataFrame:
    """``group, n, well_formed, repeated``: keys of the right form, and rows beyond the first of a key."""
    by_key = df.groupBy(*group, key).agg(F.count("*").alias("_c"))
    good = F.coalesce(F.col(key).rlike(pattern), F.lit(False))
    return by_key.groupBy(*group).agg(F.sum("_c").alias("n"), F.sum(F.when(good, F.col("_c")).otherwise(0)).alias("well_formed"), F.sum(F.when(F.col(key).isNotNull(), F.col("_c") - 1).otherwise(0)).alias("repeated"))


def volume_alarm(counts: DataFrame, source: str, run: str, n: str = "n", share: float = 0.5) -> DataFrame:
    """Add ``alarm``: fewer than ``share`` of the run before. ``counts`` has one row a source and run."""
    before = F.lag(n).over(Window.partitionBy(source).orderBy(run))
    return counts.withColumn("alarm", F.coalesce(F.col(n) < share * before, F.lit(False)))


def level_counts(log: DataFrame, source: str, levels: tuple[str, ...] = ("ERROR", "WARNING")) -> DataFrame:
    """``source`` and one count a level; sources without such lines have zeros."""
    return log.groupBy(source).agg(*[F.count_if(F.coalesce(F.col("level") == x, F.lit(False))).alias(x.lower()) for x in levels])


_WORD = re.compile(r"(?P<open>OBJECT|ARRAY)<|(?P<name>`(?:[^`]|``)*`|[^`\s:<>,()]+): |(?P<kind>[A-Z][A-Z_ ]*)(?:\(\d+,\d+\))?|(?P<close>>)|, ")


def _places(shape: str) -> list[dict[str, str]]:
    """Path and kind of each place in a shape as ``schema_of_variant`` prints it: ``OBJECT<a: ARRAY<BIGINT>>``."""
    out, holders, path, at = [], [], "", 0
    while at < len(shape):
        word = _WORD.match(shape, at)
        if word is None:
            raise ValueError(f"shape not understood at {at}: {shape[:200]}")
        at = word.end()
        if word["name"] is not None:
            path = f"{holders[-1]}.{word['name']}" if holders[-1] else word["name"]
        elif word["open"] or word["kind"]:
            out.append({"path": path, "kind": word["open"] or word["kind"]})
            if word["open"]:
                holders.append(path)
                path += "[]" if word["open"] == "ARRAY" else ""
        elif word["close"]:
            holders.pop()
    return out


def json_paths(rows: DataFrame, group: str, payload: str) -> DataFrame:
    """``group, path, kind, n, share``: in how many JSON records of a group a path, at any depth, holds a value of a kind.

    Records are counted by their shape first, which shuffles a row a shape and task; only shapes are opened. The path of a record is
    empty, that of an array's items ends in ``[]``, names other than plain words are in backticks. Items of several kinds are
    ``VARIANT`` and aren't opened; a null has the kind ``VOID``; a null or unreadable record has ``UNREADABLE``.
    """

    @F.pandas_udf("array<struct<path string, kind string>>")
    def places(shapes: pd.Series) -> pd.Series:
        return shapes.map(_places)

    shape = F.schema_of_variant(F.try_parse_json(payload))
    counts = rows.select(F.col(group), shape.alias("shape")).groupBy(group, "shape").agg(F.count("*").alias("n"))
    unreadable = F.array(F.struct(F.lit("").alias("path"), F.lit("UNREADABLE").alias("kind")))
    known = counts.where("shape is not null").select(group, "n", F.explode(places("shape")).alias("p"))
    found = known.unionByName(counts.where("shape is null").select(group, "n", F.explode(unreadable).alias("p")))
    total = counts.groupBy(group).agg(F.sum("n").alias("_all"))
    out = found.groupBy(group, "p.path", "p.kind").agg(F.sum("n").alias("n"))
    same = out[group].eqNullSafe(total[group])
    return out.join(total, same).select(out[group], "path", "kind", "n", (F.col("n") / F.col("_all")).alias("share"))


def schema_drift(now: DataFrame, before: DataFrame, group: str, tolerance: float = 0.02) -> DataFrame:
    """What changed between two results of ``json_paths``: ``group, path, change, kinds_before, kinds_now, share_before, share_now,
    renamed_from``, a row a path.

    ``change``: new, gone, kind (other kinds of value; ``VOID`` aside), or share (by more than ``tolerance``). A new path takes as
    ``renamed_from`` the path that is gone from the same place, with the same kinds and a share within the tolerance; of several the
    nearest share, then the first path. Groups of one side only have all their paths new or gone.
    """
    side = lambda df, s: df.groupBy(group, "path").agg(
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("kind") != "VOID", F.col("kind")))), "|").alias(f"kinds_{s}"),
        F.sum(F.when(F.col("kind") != "VOID", F.col("share")).otherwise(0.0)).alias(f"share_{s}"),
    )
    a, b = side(now, "now"), side(before, "before")
    both = a.withColumnRenamed(group, "_g").join(b.select(F.col(group).alias("_h"), F.col("path").alias("_p"), "kinds_before", "share_before"), F.col("_g").eqNullSafe(F.col("_h")) & (F.col("path") == F.col("_p")), "full")
    change = F.when(F.col("_p").isNull(), "new").when(F.col("path").isNull(), "gone").when((F.col("kinds_now") != F.col("kinds_before")) & (F.col("kinds_now") != "") & (F.col("kinds_before") != ""), "kind")
    change = change.when(F.abs(F.col("share_now") - F.col("share_before")) > tolerance, "share")
    in_now = F.col("path").isNotNull()
    rows = both.select(F.when(in_now, F.col("_g")).otherwise(F.col("_h")).alias(group), F.coalesce("path", "_p").alias("path"), change.alias("change"), "kinds_before", "kinds_now", "share_before", "share_now").where("change is not null")
    place = F.regexp_replace("path", r"(?:\.|^)(?:`(?:[^`]|``)*`|[^.`\[\]]+)$", "")
    named = ~F.col("path").endswith("[]") & (F.col("path") != "")
    rows = rows.withColumn("_in", F.when(named, place))
    gone = rows.where("change = 'gone'").select(F.col(group).alias("_gg"), F.col("_in").alias("_gin"), F.col("path").alias("_old"), F.col("kinds_before").alias("_kinds"), F.col("share_before").alias("_share"))
    gap = F.abs(F.col("share_now") - F.col("_share"))
    pairs = rows.where("change = 'new'").join(gone, F.col(group).eqNullSafe(F.col("_gg")) & (F.col("_in") == F.col("_gin")) & (F.col("kinds_now") == F.col("_kinds"))).where(gap <= tolerance)
    best = pairs.groupBy(F.col(group).alias("_bg"), F.col("path").alias("_bp")).agg(F.min_by("_old", F.struct(gap, "_old")).alias("renamed_from"))
    out = rows.join(best, F.col(group).eqNullSafe(F.col("_bg")) & (F.col("path") == F.col("_bp")), "left")
    return out.select(group, "path", "change", "kinds_before", "kinds_now", "share_before", "share_now", "renamed_from")
