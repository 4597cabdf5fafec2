"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``. Where it is unset, a local session makes and sets one; on a
    cluster that raises, as executors can't see each other's folders."""
    found = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="propscan-")
        spark.conf.set(CHECKPOINT_DIR, found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/propscan/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again: cuts the lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._propscan_path = path
    return out


def with_row_key(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` of Parquet files with a column ``name`` that tells its rows apart: file and place in it.

    The key is the same whenever the files are read. Other tables are written first.
    """
    key = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    try:
        return docs.select("*", key.alias(name))
    except AnalysisException:
        return written(docs, "keyed").select("*", key.alias(name))


def removed(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables made by ``written`` that no later plan reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for table in tables:
        path = hadoop(table._propscan_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
