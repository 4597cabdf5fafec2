"""Snapshot envelopes ``{generated_at, total, listings: {key: record}}``, landing tables, reports and logs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propscan.functions import parse

ENVELOPE = "generated_at string, total int, listings map<string,string>"
LOG_LINE = r"^\[?(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2})[^\]]*\]? *\[(\w+)\] *(.*)$"


def exploded(raw: DataFrame, value: str = "value", file: str = "file") -> DataFrame:
    """``file, generated_at, listing_key, payload`` of envelope texts; unreadable or empty ones give one row without a key."""
    parsed = raw.select(F.col(file).alias("file"), F.from_json(value, ENVELOPE).alias("e"))
    return parsed.select("file", "e.generated_at", F.explode_outer("e.listings").alias("listing_key", "payload"))


def current_files(files: DataFrame, file: str = "file") -> DataFrame:
    """Files of the week: all of the auction channel, and of the sale channel those under ``current_week``."""
    return files.where(~F.contains(F.col(file), F.lit("/IMM_ID/")) | F.contains(F.col(file), F.lit("/current_week/")))


def of_files(rows: DataFrame, file: str = "file") -> DataFrame:
    """Add ``channel`` and ``source`` by the file's name."""
    return rows.withColumns({"channel": F.when(F.col(file).contains("/ASTE/"), "ASTE").otherwise("IMM_ID"), "source": F.regexp_extract(file, r"dataset_(\w+?)(?:_master)?\.json", 1)})


def read_envelopes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Read snapshot files whole (each below 2 GB; larger ones are landed as one record a line, see ``read_lines``)."""
    raw = spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    return of_files(exploded(current_files(raw)))


def read_lines(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Landed records, one a line, by a narrow schema; broken lines are in ``_corrupt``."""
    return spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(paths)


def manifest(rows: DataFrame) -> DataFrame:
    """Per file its time and number of listings."""
    return rows.groupBy("file").agg(F.max("generated_at").alias("generated_at"), F.count("listing_key").alias("listings"))


def unknown_fields(rows: DataFrame, known: list[str]) -> DataFrame:
    """Fields of payloads that no adapter knows, with their number."""
    return rows.select(F.explode(F.json_object_keys("payload")).alias("field")).where(~F.col("field").isin(*known)).groupBy("field").count()


def baseline(rows: DataFrame) -> DataFrame:
    """``listing_key, scraped_at`` of readable times."""
    return rows.select("listing_key", F.try_to_timestamp(F.get_json_object("payload", "$.scraped_at")).alias("scraped_at")).where("scraped_at is not null")


#: Sources beyond ``PLACES``: prefix → function from ``listing_key, payload`` rows to canonical rows
ADAPTERS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def adapter(source: str, schema: str, columns: Callable[[], dict[str, Column]]) -> None:
    """Register a further source: the payload is read by ``schema`` as ``p`` and mapped to canonical ``columns``."""
    ADAPTERS[source] = lambda rows: rows.withColumn("p", F.from_json("payload", schema)).select("listing_key", F.lit(source).alias("source"), *[c.alias(n) for n, c in columns().items()])


def canonical(rows: DataFrame) -> DataFrame:
    """All sources' rows in one table; keys of an unknown source are left out (see ``unknown_sources``).

    The ten portals are read in one pass: their records are parsed once, and a source only tells which fields hold its price and
    place. Registered adapters add a branch each.
    """
    prefix = F.regexp_extract("listing_key", "^([a-z]+)_", 1)
    out = _portal_rows(rows.withColumn("source", prefix).where(F.col("source").isin(*PLACES)))
    for source, make in ADAPTERS.items():
        out = out.unionByName(make(rows.where(prefix == source)), allowMissingColumns=True)
    return out


def unknown_sources(rows: DataFrame) -> DataFrame:
    return rows.select(F.regexp_extract("listing_key", "^([a-z]+)_", 1).alias("source")).where(~F.col("source").isin(*PLACES, *ADAPTERS)).groupBy("source").count()


def write_partition(rows: DataFrame, path: str, by: str = "run_date") -> None:
    """Replace the partitions that ``rows`` holds and leave the others: rotation, registry and report tables."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def previous(table: DataFrame, run_date: str) -> DataFrame:
    """The partition before ``run_date``."""
    last = table.where(F.col("run_date") < run_date).agg(F.max("run_date").alias("_last"))
    return table.join(F.broadcast(last), F.col("run_date") == F.col("_last")).drop("_last")


def last_good(table: DataFrame, loads: DataFrame) -> DataFrame:
    """Each source's newest partition whose load succeeded (``loads``: ``source, run_date, ok``)."""
    good = loads.where("ok").groupBy("source").agg(F.max("run_date").alias("run_date"))
    return table.join(good, ["source", "run_date"])


def envelope_lines(rows: DataFrame, generated_at: str) -> DataFrame:
    """Lines of one JSON envelope in order, for a text export: the files of a write, joined by name, are the document.

    One line a listing (``listing_key, payload``; of equal keys the greatest payload), sorted by ranges of keys, so no task
    holds the document; Spark's committer makes the folder visible as a whole.
    """
    once = rows.where("listing_key is not null").groupBy("listing_key").agg(F.max("payload").alias("payload"))
    head = once.agg(F.count("*").alias("n"), F.min("listing_key").alias("first"))
    key = F.to_json(F.struct(F.col("listing_key").alias("k")))
    name = F.substring(key, 6, F.length(key) - 6)  # the key as a JSON string
    comma = F.when(F.col("listing_key") == F.col("first"), F.lit("")).otherwise(F.lit(","))
    entries = once.join(F.broadcast(head.select("first")), F.lit(True)).select(F.lit(1).alias("part"), "listing_key", F.concat(comma, name, F.lit(":"), "payload").alias("value"))
    none = F.lit(None).cast("string").alias("listing_key")
    start = head.select(F.lit(0).alias("part"), none, F.format_string('{"generated_at":"%s","total":%d,"listings":{', F.lit(generated_at), "n").alias("value"))
    end = head.select(F.lit(2).alias("part"), none, F.lit("}}").alias("value"))
    return start.unionByName(entries).unionByName(end).orderBy("part", "listing_key").select("value")


def log_rows(lines: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """``ts, level, message`` of log lines, beside the columns to keep; other lines have null time and level."""
    part = lambda i: F.nullif(F.regexp_extract(value, LOG_LINE, i), F.lit(""))
    return lines.select(*(keep or []), part(1).try_cast("timestamp").alias("ts"), part(2).alias("level"), F.coalesce(part(3), F.col(value)).alias("message"))


FIELDS = [
    "url", "titolo", "descrizione_completa", "superficie_mq", "tribunale", "procedura", "categoria", "scraped_at", "data_asta", "data_termine_asta",
    "termine_presentazione_offerte", "prezzo", "prezzo_base", "indirizzo", "comune", "citta_completa", "citta", "zona",
]
#: Source → fields that hold its price and its place.
PLACES = {
    "asteannunci": ("prezzo_base", "indirizzo"), "asteflorio": ("prezzo", "titolo"), "caseasta": ("prezzo", "indirizzo"), "fallcoaste": ("prezzo", "titolo"),
    "medianord": ("prezzo", "comune"), "vgi": ("prezzo_base", "citta_completa"), "worldcapital": ("prezzo", "citta"), "astalegale": ("prezzo", "citta"),
    "idealista": ("prezzo", "zona"), "immobiliare": ("prezzo", "comune"),
}


def _portal_rows(rows: DataFrame) -> DataFrame:
    """Canonical columns of the portals' records, by the fields of ``PLACES``."""
    p = lambda name: F.col(f"p.{name}")
    role = lambda i: F.coalesce(*(F.when(F.col("source").isin(*[s for s, names in PLACES.items() if names[i] == field]), p(field)) for field in dict.fromkeys(names[i] for names in PLACES.values())))
    rows = rows.withColumn("p", F.from_json("payload", ", ".join(f"{f} string" for f in FIELDS))).withColumns({"_price": role(0), "_place": role(1)})
    place = F.col("_place")
    sqm = F.coalesce(F.try_element_at(parse.surfaces(p("superficie_mq")), F.lit(1)), parse.italian_number(p("superficie_mq")), parse.surface(p("descrizione_completa"))["value"])
    columns = {
        "url": p("url"), "title": p("titolo"), "description": parse.strip_tags(p("descrizione_completa")), "price": parse.price(F.col("_price"), F.col("source")), "sqm": sqm,
        "town": F.coalesce(parse.town(place), place), "province": parse.province(place), "court": p("tribunale"), "procedure": parse.procedure(p("procedura")),
        "deadline": parse.timestamp(F.coalesce(p("termine_presentazione_offerte"), p("data_termine_asta"), p("data_asta"))),
        "category": parse.category(F.concat_ws(" ", p("categoria"), p("titolo"))), "scraped_at": p("scraped_at").try_cast("timestamp"),
    }
    return rows.select("listing_key", "source", *[c.alias(n) for n, c in columns.items()])
