"""Corpus pipeline over ``documents``: language ID, quality rules, near duplicates, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents. All stages but the last return the columns of
``documents``. The stages that choose documents choose rows, by their place in the files, so repeated
and missing ids do no harm: rows of one id are documents of their own. Null texts go in the first stage,
empty tables stay empty, further columns are kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propscan.llm import language_id, packing, quality_rules, source_mixing
from propscan.llm.ngram_jaccard_join import near_duplicates
from propscan.llm.queries import DOMAIN_WEIGHTS, mix_levels
from propscan.storage import with_row_key, written

#: Share of the tokens that reach the mix which it gives out, each document at most once.
MIX_SHARE = 0.9


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a learned language fits; those without a letter or unlike all languages go."""
    return language_id.accepted(docs, language_id.fit(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs certified on ``labels``.

    Texts are counted twice, for the cutoffs and for the verdicts: the second pass costs less than to move texts.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    cutoffs = quality_rules.fit_cutoffs(quality_rules.measure(docs), labels)
    return quality_rules.judge(quality_rules.measured_rows(docs), cutoffs).where("kept").select("row.*")


def _key(docs: DataFrame) -> str:
    """A column name that ``docs`` doesn't have."""
    name = "_row_key"
    while name in docs.columns:
        name += "_"
    return name


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: that with the smallest id (rows without an id come last), and of equal ids
    the first by its place in the files. Texts without words are no group and stay."""
    key = _key(docs)
    keyed = with_row_key(docs, key)
    found = near_duplicates(keyed, carry=key).where("group is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.col(key).alias("key")))
    firsts = found.groupBy("group").agg(first.alias("first")).select(F.col("first.key").alias(key))
    gone = found.select(key).join(firsts, key, "left_anti")
    return keyed.join(gone, key, "left_anti").select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows chosen for the target weights, each at most once."""
    key = _key(docs)
    keyed = with_row_key(docs, key)
    chosen = source_mixing.mix(keyed, mix_levels(), DOMAIN_WEIGHTS, share=MIX_SHARE, max_epochs=1, carry=(key,)).select(key)
    return keyed.join(chosen, key, "left_semi").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicate), ("source_mix", source_mix), ("packing", pack)]

#: SQL can't express language models, certified cutoffs or fitted patterns; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
