"""URL filters: host and path rules, and boosted trees for URLs that no rule names.

The trees learn from labelled URLs, here those that a rule decides, by lexical features: length,
depth, digit ratio, entropy, parameter counts and statistics of the host's suffix (how often
labelled URLs of the suffix are blocked). Everything is DataFrame expressions and Spark's own
gradient-boosted trees. At most about ``max_train_rows`` labelled URLs are used, chosen by a hash.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path beginning)
RULES = [
    ("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"), ("block", "org", "/es/"),
]
FEATURES = ["length", "host_length", "host_labels", "depth", "digit_ratio", "entropy", "params", "hyphens", "has_fragment", "secure", "suffix_blocked"]


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    rest = F.substring_index(F.substring_index(F.substring_index(_rest(url), "/", 1), "?", 1), "#", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """After the host up to ``? #`` or the end."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def entropy(text: Column) -> Column:
    """Bits a character."""
    kinds = F.array_distinct(F.split(text, ""))
    size = F.length(text)
    part = lambda c: (size - F.length(F.replace(text, c))) / size
    bits = F.aggregate(F.filter(kinds, lambda c: c != ""), F.lit(0.0), lambda a, c: a - part(c) * F.log2(part(c)))
    return F.when(size > 0, bits).otherwise(F.lit(0.0))


def matching_rule(h: Column, p: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule text and verdict of the longest rule that fits host (and subdomains) and path beginning; else null."""
    text = verdict = F.lit(None).cast("string")
    for v, rh, rp in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((h == rh) | h.endswith("." + rh)) & p.startswith(rp)
        text, verdict = F.when(fits, F.lit(rh + rp)).otherwise(text), F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def lexical(urls: DataFrame) -> DataFrame:
    """Add the features that need the URL alone, and ``suffix``, to rows with ``url, host, path``."""
    u = F.coalesce(F.col("url"), F.lit(""))
    count = lambda c, s: (F.length(c) - F.length(F.replace(c, F.lit(s)))).cast("double")
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    return urls.withColumns({
        "length": F.length(u).cast("double"), "host_length": F.length("host").cast("double"), "host_labels": count(F.col("host"), ".") + 1,
        "depth": count(F.col("path"), "/"), "digit_ratio": F.when(F.length(u) > 0, 1 - F.length(F.translate(u, "0123456789", "")) / F.length(u)).otherwise(0.0),
        "entropy": entropy(u), "params": F.when(query == "", 0.0).otherwise(count(query, "&") + 1), "hyphens": count(u, "-"),
        "has_fragment": F.contains(u, F.lit("#")).cast("double"), "secure": u.startswith("https").cast("double"), "suffix": F.substring_index("host", ".", -1),
    })


def judge(
    pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, id_col: str = "page_id", url_col: str = "url",
    labelled: DataFrame | None = None, max_train_rows: int = 20_000, trees: int = 10, depth: int = 4, seed: int = 3,
) -> DataFrame:
    """Return ``page_id, host, path, rule, verdict, block_score`` for each row.

    ``labelled``: ``url, verdict`` rows to learn from besides the URLs that rules decide. Where labels
    of both verdicts are missing, URLs without a rule get the one that was seen (``allow`` without
    any). Null urls have empty host and path and are judged like others. Repeated rows give equal
    rows, an empty table gives no rows, other columns are ignored. Suffixes never seen count as the
    share of all labelled URLs.
    """
    rules = RULES if rules is None else rules
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    text, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = lexical(rows.withColumns({"rule": text, "by_rule": verdict}))
    known = rows.where("by_rule is not null").select("url", "host", "path", F.col("by_rule").alias("verdict"))
    if labelled is not None:
        more = labelled.select(F.col("url").cast("string").alias("url"), "verdict").where("verdict in ('allow', 'block')")
        known = known.unionByName(more.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))}))
    sizes = {r.verdict: r["count"] for r in known.groupBy("verdict").count().collect()}
    if len(sizes) < 2:
        only = next(iter(sizes), "allow")
        return rows.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.lit(only)).alias("verdict"), F.lit(float(only == "block")).alias("block_score"))
    share = max_train_rows / sum(sizes.values())
    sample = known.where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < share * 1_000_000).withColumn("label", (F.col("verdict") == "block").cast("double"))
    sample = lexical(sample)
    base = sizes["block"] / sum(sizes.values())
    smooth = 20.0
    suffixes = sample.groupBy("suffix").agg(((F.sum("label") + smooth * base) / (F.count("*") + smooth)).alias("suffix_blocked"))  # at most max_train_rows
    vector = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    seen = lambda d: d.join(suffixes, "suffix", "left").fillna({"suffix_blocked": base})
    from propscan.storage import written

    train = written(seen(sample).select(*FEATURES, "label"), "url-sample")
    if train.select("label").distinct().count() < 2:
        return rows.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.lit("allow")).alias("verdict"), F.lit(base).alias("block_score"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, maxBins=32).fit(vector.transform(train.coalesce(8)))
    scored = model.transform(vector.transform(seen(rows))).withColumn("block_score", vector_to_array("probability")[1])
    by_method = F.when(F.col("prediction") == 1.0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_method).alias("verdict"), "block_score")
