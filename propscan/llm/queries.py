"""Queries of this subpackage, by name: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from propscan.llm import chat_rotation, embedding_links, language_id, license_scan, media, packing, phrase_mining, quality_rules, source_mixing, token_alignment, toxicity, url_filter
from propscan.llm.ngram_jaccard_join import near_duplicates
from propscan.storage import new_path, written


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scans(spark, sf_dir):
    found = license_scan.scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"), F.size("sentence_ids").cast("long").alias("n_sentences"), "unknown_license")


def op2_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where(toxicity.learned_rows())
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", (~toxicity.learned_rows()).alias("held_out"), "score", "predicted")


def op3_url_filters(spark, sf_dir):
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op4_best_fit_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_quality_rules(spark, sf_dir):
    measured = written(quality_rules.measure(_table(spark, sf_dir, "documents")), "measured")
    judged = quality_rules.judge(measured, quality_rules.fit_cutoffs(measured, _table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "violated")


def op6_ngram_jaccard_join(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"), n_links=True)


def op7_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(language_id.learned_rows()))
    found = language_id.identify(docs, model)
    return found.select("doc_id", (~language_id.learned_rows()).alias("held_out"), "lang_pred", "score", "rejected")


def op8_chat_formatting(spark, sf_dir):
    return chat_rotation.rotate(_table(spark, sf_dir, "conversations"))


def op9_media_columns(spark, sf_dir):
    return media.media_column(_table(spark, sf_dir, "documents"), new_path(spark, "media"))


#: Mix of the query: domains are three groups of sources; German counts double, two sources triple.
DOMAIN_WEIGHTS = [{"domain0": 3.0, "domain1": 2.0}, {"de": 2.0}, {"src3": 3.0, "src5": 3.0}]
MIX = {"share": 0.6, "max_epochs": 2, "seed": 17}


def mix_levels():
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "[0-9]+$", 0)
    domain = F.when(number == "", F.lit("unknown")).otherwise(F.concat(F.lit("domain"), (F.expr("try_cast(regexp_extract(coalesce(source, ''), '[0-9]+$', 0) as bigint)") % 3).cast("string")))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def op10_mixing_sources(spark, sf_dir):
    return source_mixing.mix(_table(spark, sf_dir, "documents"), mix_levels(), DOMAIN_WEIGHTS, **MIX)


def op11_phrase_collocation_mining(spark, sf_dir):
    return phrase_mining.collocations(_table(spark, sf_dir, "documents"))


def op12_embedding_near_dedup(spark, sf_dir):
    return embedding_links.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op13_cross_tokenizer_alignment(spark, sf_dir):
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2("alignment", 256)).otherwise("")
    found = token_alignment.align(_table(spark, sf_dir, "documents"), a, b, keep={"n_groups": F.size("ends").cast("long"), "groups_sha256": digest})
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scans, op2_toxicity, op3_url_filters, op4_best_fit_packing, op5_quality_rules,
        op6_ngram_jaccard_join, op7_language_id, op8_chat_formatting, op9_media_columns, op10_mixing_sources,
        op11_phrase_collocation_mining, op12_embedding_near_dedup, op13_cross_tokenizer_alignment,
    )
}
_DOMAIN = "case when regexp_extract(coalesce(source, ''), '[0-9]+$') = '' then 'unknown' else 'domain' || (try_cast(regexp_extract(source, '[0-9]+$') as bigint) % 3) end"
ORACLE_SQL = {
    "op1_license_scans": license_scan.oracle_sql(),
    "op8_chat_formatting": chat_rotation.ORACLE_SQL,
    "op10_mixing_sources": source_mixing.oracle_sql(_DOMAIN, weights=DOMAIN_WEIGHTS, **MIX),
    "op11_phrase_collocation_mining": phrase_mining.oracle_sql(),
}
