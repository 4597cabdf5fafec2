"""Releases: all tables of a run become visible together, by a small pointer file that is renamed into place last."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _pointers(spark: SparkSession, root: str) -> list[dict]:
    """Pointers of a folder, the newest first; one a publication, so there are few."""
    try:
        found = spark.read.text(f"{root}/pointers", wholetext=True).select("value", F.col("_metadata.file_name").alias("name")).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((json.loads(r.value) | {"file": r.name} for r in found), key=lambda p: -p["number"])


def versions(spark: SparkSession, root: str) -> list[dict]:
    """The newest pointer of each version, the newest version first."""
    once = {}
    for p in _pointers(spark, root):
        once.setdefault(p["version"], p)
    return list(once.values())


def publish(root: str, version: str, tables: dict[str, DataFrame], appended: tuple[str, ...] = ()) -> None:
    """Write ``tables`` as a release and make it the current one.

    Each table goes to a new folder. Only when all are written, a pointer that names them is renamed to the next number, so a
    reader sees the old release or the whole new one, and a write that fails leaves the old one. Tables that aren't given stay as they
    are. Of ``appended`` tables the rows of earlier versions stay (a registry); publishing a version again replaces its own rows.
    The tables may be derived from the current release. Two publications at once: the later one raises, as its number is taken.
    """
    spark = next(iter(tables.values())).sparkSession
    now = _pointers(spark, root)
    held, number = (now[0]["tables"], now[0]["number"]) if now else ({}, 0)
    held, folder = dict(held), f"versions/{version}-{uuid.uuid4().hex}"
    for name, rows in tables.items():
        rows.write.parquet(f"{root}/{folder}/{name}")
        earlier = [f for f in held.get(name, []) if f["version"] != version] if name in appended else []
        held[name] = [*earlier, {"version": version, "folder": f"{folder}/{name}", "schema": rows.schema.json()}]
    _switch(spark, root, {"number": number + 1, "version": version, "tables": held})


def _switch(spark: SparkSession, root: str, pointer: dict) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    temporary = hadoop.Path(f"{root}/pointers/_{uuid.uuid4().hex}.tmp")
    files = temporary.getFileSystem(conf)
    out = files.create(temporary, False)
    out.write(bytearray(json.dumps(pointer).encode()))
    out.close()
    temporary = files.makeQualified(temporary)
    never_over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    hadoop.FileContext.getFileContext(temporary.toUri(), conf).rename(temporary, files.makeQualified(hadoop.Path(f"{root}/pointers/{pointer['number']:012d}.json")), never_over)


def released(spark: SparkSession, root: str, table: str, back: int = 0) -> DataFrame:
    """A table of the current release, or of the version ``back`` versions before; one that isn't there raises ``KeyError``."""
    found = versions(spark, root)
    if back >= len(found) or table not in found[back]["tables"]:
        raise KeyError(f"{table} in version {back} before the current one")
    by_schema: dict[str, list[str]] = {}
    for part in found[back]["tables"][table]:
        by_schema.setdefault(part["schema"], []).append(f"{root}/{part['folder']}")
    out = None
    for schema, folders in by_schema.items():
        kind = spark.sparkContext._jvm.org.apache.spark.sql.types.DataType.fromJson(schema).toDDL()
        rows = spark.read.schema(kind).parquet(*folders)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def trim(spark: SparkSession, root: str, keep: int) -> None:
    """Delete the pointers of all but the ``keep`` newest versions, then the folders that no pointer names: old releases and
    failed writes. Not to be run beside a publication or a reader of an old release."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    files = hadoop.Path(root).getFileSystem(conf)
    kept = versions(spark, root)[:keep]
    names = {p["file"] for p in kept}
    for p in _pointers(spark, root):
        if p["file"] not in names:
            files.delete(hadoop.Path(f"{root}/pointers/{p['file']}"), False)
    used = {f["folder"].split("/")[1] for p in kept for parts in p["tables"].values() for f in parts}
    for status in files.listStatus(hadoop.Path(f"{root}/versions")):
        if status.getPath().getName() not in used:
            files.delete(status.getPath(), True)
