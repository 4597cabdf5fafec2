"""Reports and the registry of announcements: tables by run date, documents for export, checks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propscan.functions.parse import report_name
from propscan.sources.snapshots import write_partition

CHANNELS = ["ASTE", "IMM_ID"]


def report_document(run_date: str, announced: DataFrame, discarded: DataFrame, config_hash: str) -> DataFrame:
    """One JSON document a run: ``announced`` is at most a report's slots; of discarded rows it holds the number by reason,
    their ids are rows of ``publish_discarded``."""
    items = announced.agg(F.coalesce(F.sort_array(F.collect_list(F.struct("position", "listing_id", "vote", "outcome", "price"))), F.array()).alias("opportunita"))
    reasons = discarded.groupBy("reason").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "n")))).alias("scartate"))
    meta = F.struct(F.lit(run_date).alias("data"), F.lit(config_hash).alias("hash_config"))
    return items.crossJoin(reasons).select(F.to_json(F.struct(meta.alias("meta"), "opportunita", "scartate")).alias("value"))


def publish_discarded(discarded: DataFrame, path: str) -> None:
    """Write ``reason, listing_id`` in a folder a reason, in files sorted by id that share no range of ids."""
    rows = discarded.select("reason", "listing_id").repartitionByRange("reason", "listing_id").sortWithinPartitions("reason", "listing_id")
    rows.write.partitionBy("reason").mode("overwrite").parquet(path)


def publish(announced: DataFrame, registry_path: str, run_date: str, file: str) -> None:
    """Write registry rows of a report; a second run of the same file replaces its rows."""
    rows = announced.select(F.col("listing_id").alias("id"), F.lit(run_date).alias("date"), "channel", "vote", F.lit(file).alias("file"))
    write_partition(rows, registry_path, by="file")


def replaced(registry: DataFrame, new: DataFrame) -> DataFrame:
    """Registry after a report: rows of the files in ``new`` are replaced."""
    return registry.join(new.select("file").distinct(), "file", "left_anti").unionByName(new)


def contract_breaks(items: DataFrame) -> DataFrame:
    """``listing_id, rule`` for each rule that a published item breaks."""
    bad = {
        "channel": ~F.col("channel").isin(*CHANNELS), "vote": ~(F.col("vote").between(0, 100) & (F.col("vote") == F.floor("vote"))), "text": F.coalesce(F.trim("text"), F.lit("")) == "",
        "again_without_reason": (F.col("state") == "RISEGNALATA") & (F.coalesce(F.size("reasons"), F.lit(0)) <= 0),
    }
    return items.select("listing_id", F.explode(F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), n) for n, c in bad.items())))).alias("rule"))


def broken_links(registry: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of one side without the other: ``file, id, side``."""
    a, b = registry.select("file", "id"), items.select("file", "id")
    return a.join(b, ["file", "id"], "left_anti").withColumn("side", F.lit("registry")).union(b.join(a, ["file", "id"], "left_anti").withColumn("side", F.lit("report")))


OUTCOMES = ["PROMUOVI", "DA APPROFONDIRE", "MONITORA", "SCARTA"]
_ALWAYS = [
    ("in_classifica", None), ("posizioni_scorse", None), ("escluse_per_storico", "INVARIATA"), ("escluse_per_storico", "PEGGIORATA"),
    *(("segnalate", k) for k in ("totale", "nuove", "risegnalate", *(f"da_{c}" for c in CHANNELS))), *(("per_esito", o) for o in OUTCOMES),
]


def report_statistics(read: DataFrame, rows: DataFrame, verdicts: DataFrame, top: DataFrame, key: Column, slots: int = 10) -> DataFrame:
    """``statistic, key, n``: a report's numbers, those of ``_ALWAYS`` with zeros.

    ``read``: listings as loaded; ``rows``: the evaluation, a row a property (``listing_id, channel, outcome, reason`` and what ``key``,
    the ranking's order, reads); ``verdicts``: ``listing_id, verdict`` of those announced before, once each; ``top``: this
    week's announced rows. Positions are passed over down to the last announced one, or all where slots stay empty. One pass over
    ``rows`` counts groups of few kinds, and the numbers are sums of those.
    """
    told = top.select("listing_id", F.lit(True).alias("_told"))
    last = top.agg(F.max(key).alias("_last"), F.count("*").alias("_n"))
    ranked = F.col("outcome").isin("PROMUOVI", "DA APPROFONDIRE")
    both = rows.join(verdicts.select("listing_id", "verdict"), "listing_id", "left").join(F.broadcast(told), "listing_id", "left").crossJoin(F.broadcast(last))
    passed = ranked & F.coalesce(F.col("verdict").isin("INVARIATA", "PEGGIORATA"), F.lit(False)) & ((F.col("_n") < slots) | (key < F.col("_last")))
    kinds = both.groupBy("channel", "outcome", "reason", "verdict", "_told", passed.alias("_passed"), ranked.alias("_ranked")).agg(F.count("*").alias("n"))
    tag = lambda name, k: F.struct(F.lit(name).alias("statistic"), (k if isinstance(k, Column) else F.lit(k).cast("string")).alias("key"))
    again = F.coalesce(F.col("verdict") == "MIGLIORATA", F.lit(False))
    tags = [
        tag("per_esito", F.col("outcome")), F.when((F.col("outcome") == "SCARTA") & F.col("reason").isNotNull(), tag("scarti_per_motivo", F.col("reason"))), F.when(F.col("_ranked"), tag("in_classifica", None)),
        F.when(F.col("_passed"), tag("posizioni_scorse", None)), F.when(F.col("_passed"), tag("escluse_per_storico", F.col("verdict"))), F.when(F.col("_told"), tag("segnalate", "totale")),
        F.when(F.col("_told"), tag("segnalate", F.when(again, "risegnalate").otherwise("nuove"))), F.when(F.col("_told"), tag("segnalate", F.concat(F.lit("da_"), "channel"))),
    ]
    counts = kinds.select("n", F.explode(F.array_compact(F.array(*tags))).alias("t")).select("t.statistic", "t.key", "n")
    zeros = rows.sparkSession.createDataFrame([(s, k, 0) for s, k in _ALWAYS], "statistic string, key string, n long")
    n_read, none = read.agg(F.count("*").alias("n")), F.lit(None).cast("string").alias("key")
    loaded = n_read.select(F.lit("record_letti").alias("statistic"), none, "n")
    merged = n_read.crossJoin(rows.agg(F.count("*").alias("_m"))).select(F.lit("duplicati_uniti").alias("statistic"), none, (F.col("n") - F.col("_m")).alias("n"))
    return counts.unionByName(zeros).groupBy("statistic", "key").agg(F.sum("n").alias("n")).unionByName(loaded).unionByName(merged)


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either table that the other lacks; empty for two runs over the same input."""
    return a.exceptAll(b).withColumn("side", F.lit("first")).union(b.exceptAll(a).withColumn("side", F.lit("second")))


def summaries(items: DataFrame) -> DataFrame:
    """``run_date, n, n_new, best, days_since``: one row a report, with the days since the one before."""
    g = items.groupBy("run_date").agg(F.count("*").alias("n"), F.count_if(F.col("state") == "NUOVA").alias("n_new"), F.max("vote").alias("best"))
    return g.withColumn("days_since", F.datediff("run_date", F.lag("run_date").over(Window.orderBy("run_date"))))


def latest(items: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` items of the newest report."""
    last = items.agg(F.max("run_date").alias("_d"))
    return items.join(F.broadcast(last), F.col("run_date") == F.col("_d")).orderBy(F.desc("vote"), "listing_id").limit(n).drop("_d")


def search(items: DataFrame, text: str) -> DataFrame:
    """Items whose id or town holds ``text``, ignoring case; a blank text finds nothing."""
    q = text.strip().lower()
    hit = F.contains(F.lower("listing_id"), F.lit(q)) | F.contains(F.lower("town"), F.lit(q))
    return items.where(F.coalesce(hit, F.lit(False)) if q else F.lit(False))


def report_list(items: DataFrame) -> DataFrame:
    """``run_date, file, n, n_new, n_again``: one row a report, the newest first; rows of unreadable reports (no date) are left out."""
    g = items.where("run_date is not null").groupBy("run_date").agg(F.count("*").alias("n"), F.count_if(F.col("state") == "NUOVA").alias("n_new"), F.count_if(F.col("state") == "RISEGNALATA").alias("n_again"))
    return g.select("run_date", report_name(F.col("run_date")).alias("file"), "n", "n_new", "n_again").orderBy(F.desc("run_date"))


def one_report(items: DataFrame, file: str) -> DataFrame:
    """The items of a report by its file name; a name that isn't a report's gives none. Reads that partition only."""
    found = re.fullmatch(r"report_(\d{4})_(\d{2})_(\d{2})\.json", file)
    return items.where(F.col("run_date") == F.lit("-".join(found.groups())).try_cast("date")) if found else items.limit(0)


def monitor_preview(items: DataFrame, n: int = 30) -> DataFrame:
    """The first ``n`` rows to monitor, by vote."""
    return items.where("outcome = 'MONITORA'").orderBy(F.desc("vote"), "listing_id").limit(n)
