"""Mixing sources to target weights by hierarchical budgets.

Weights are propagated from the root through the levels of a tree (domain, language, source). A node
that can't use its share is filled to its supply and the rest goes to its siblings by weight, and
only what all siblings together can't use is missing at the parent, where its siblings get it: the
budget of each level is the water level ``sum(min(supply, level * weight)) = budget``, found with
windows over the small table of nodes. Each leaf then takes a token-prefix of its documents in
seeded epochs: documents in the order of md5(seed, epoch, id), whole epochs first, then those of
the next epoch that begin before the budget ends. Column expressions only.

Running sums in a leaf are two-level: about sqrt(n) slices of the hash order, then within a slice, so a
source with a third of all rows is not one task's work. Rows meet their leaf's budget by (leaf, salt), a
key that doesn't hold a leaf together, so the sums within slices are dealt by slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propscan.storage import written

#: Parts that the rows of a leaf are dealt in when they meet its budget.
SALTS = 128


def n_tokens(text: Column) -> Column:
    """Words (runs of other than space and 9 to 13) of a text; a null has none."""
    ends = F.when(text.rlike("^[ \t-\r]"), 1).otherwise(0) + F.when(F.substring(text, -1, 1).rlike("[ \t-\r]"), 1).otherwise(0)
    return F.coalesce(F.when(text == "", 0).otherwise(F.size(F.split(text, "[ \t-\r]+")) - ends).cast("long"), F.lit(0).cast("long"))


def water_level(nodes: DataFrame, parent: list[str], budget: str = "budget") -> DataFrame:
    """Give children of each parent their ``share`` of its ``budget``: ``nodes`` has the parent's columns,
    ``weight`` (>= 0, null is 0) and ``supply``. Weight 0 gets nothing."""
    w = F.coalesce(F.col("weight"), F.lit(0.0))
    nodes = nodes.withColumn("_w", w).withColumn("_ratio", F.when(F.col("_w") > 0, F.col("supply") / F.col("_w")).otherwise(F.lit(float("inf"))))
    order = Window.partitionBy(*parent).orderBy("_ratio", *[c for c in nodes.columns if c.startswith("node_")])
    upto, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    full = F.coalesce(F.sum(F.when(F.col("_w") > 0, F.col("supply"))).over(upto), F.lit(0.0))
    level = (F.col(budget) - full) / F.sum("_w").over(after)  # the level if all before are full and the rest are not
    nodes = nodes.withColumn("_level", F.when(F.col("_w") > 0, level))
    # levels rise while children are full and fall afterwards: the water level is the highest
    fits = F.max("_level").over(Window.partitionBy(*parent))
    share = F.when(F.col("_w") > 0, F.least(F.col("supply").cast("double"), F.coalesce(fits * F.col("_w"), F.col("supply").cast("double")))).otherwise(F.lit(0.0))
    return nodes.withColumn("share", F.greatest(share, F.lit(0.0))).drop("_w", "_ratio", "_level")


def leaf_budgets(supply: DataFrame, levels: list[str], weights: list[dict[str, float]], total: Column, max_epochs: int) -> DataFrame:
    """``supply``: level columns, ``tokens``, ``docs`` of each leaf → the same with ``budget`` (long).

    ``weights``: for each level, value → weight; values that aren't named have weight 1. ``total`` is
    an aggregate over ``supply``; what exceeds ``max_epochs`` times the supply can't be given.
    """
    tree = supply.withColumn("capacity", (F.col("tokens") * max_epochs).cast("double"))
    at = tree.agg(total.cast("double").alias("budget"))
    at = at.withColumn("root", F.lit(0))
    parent = ["root"]
    for depth, level in enumerate(levels):
        keys = levels[: depth + 1]
        named = weights[depth] if depth < len(weights) else {}
        weight = F.coalesce(F.create_map(*(F.lit(x) for k, v in named.items() for x in (k, float(v))))[F.col(level)], F.lit(1.0)) if named else F.lit(1.0)
        nodes = tree.withColumn("root", F.lit(0)).groupBy("root", *keys).agg(F.sum("capacity").alias("supply")).withColumn("weight", weight).withColumn(f"node_{level}", F.col(level))
        joined = nodes.join(at, parent)
        at = water_level(joined, parent).select("root", *keys, F.col("share").alias("budget"))
        parent = ["root", *keys]
    return tree.drop("capacity").join(at.drop("root").withColumn("budget", F.round("budget").cast("long")), levels)


def mix(
    docs: DataFrame, levels: dict[str, Column], weights: list[dict[str, float]], share: float = 0.6, max_epochs: int = 2, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
) -> DataFrame:
    """Return ``doc_id, <levels>, n_tokens, epoch, start``: documents chosen, once for each epoch that takes them.

    ``share`` times the tokens of all rows are given out. ``start`` is the document's first token in
    its epoch's order of the leaf; a document is taken whole if it begins before the leaf's budget
    ends, so a leaf exceeds it by less than one document. Texts without words are never taken. Null
    levels are ``unknown``. Repeated rows and rows without an id are documents of their own (rows of one id
    are ordered by text, rows without an id by a hash of it). An empty table gives no rows. Columns named in
    ``carry`` (as none of the result's own) are returned too; other columns are ignored.
    """
    names = list(levels)
    extra = [F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"), *extra, *[F.coalesce(c.cast("string"), F.lit("unknown")).alias(n) for n, c in levels.items()])
    held = [f"_carry_{i}" for i in range(len(carry))]
    rows = rows.select("doc_id", *held, *names, n_tokens(F.col("_text")).alias("n_tokens"), F.md5(F.coalesce("_text", F.lit(""))).alias("_tie")).where("n_tokens > 0")
    rows = written(rows, "mix-rows")  # texts are read once
    supply = rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    leaves = leaf_budgets(supply, names, weights, F.sum("tokens") * share, max_epochs)
    leaves = leaves.withColumn("full", F.floor(F.col("budget") / F.col("tokens")).cast("int")).withColumn("part", F.col("budget") - F.col("full") * F.col("tokens"))
    leaves = leaves.withColumn("slices", F.ceil(F.sqrt("docs")).cast("long")).drop("docs", "budget", "tokens").where("full > 0 or part > 0")
    leaves = leaves.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    taken = rows.withColumn("_salt", F.pmod(F.xxhash64("_tie", "doc_id", *held), F.lit(SALTS)).cast("int")).join(leaves, [*names, "_salt"]).drop("_salt")
    epochs = F.expr("sequence(0, full - if(part > 0, 0, 1))")
    taken = taken.withColumn("epoch", F.explode(epochs))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.col("_tie"))))
    taken = taken.withColumn("_key", key).withColumn("_slice", F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * F.col("slices") / (1 << 32)))
    leaf = [*names, "epoch"]
    before = Window.partitionBy(*leaf).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = taken.groupBy(*leaf, "_slice").agg(F.sum("n_tokens").alias("sum")).withColumn("base", F.coalesce(F.sum("sum").over(before), F.lit(0))).drop("sum")
    within = Window.partitionBy(*leaf, "_slice").orderBy("_key", "_tie", *held).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken = taken.withColumn("upto", F.sum("n_tokens").over(within)).join(bases, [*leaf, "_slice"]).withColumn("start", F.col("base") + F.col("upto") - F.col("n_tokens"))
    return taken.where("epoch < full or start < part").select("doc_id", *names, "n_tokens", "epoch", "start", *[F.col(h).alias(c) for h, c in zip(held, carry, strict=True)])


def oracle_sql(domain: str, share: float, max_epochs: int, seed: int, weights: list[dict[str, float]]) -> str:
    """``mix`` over ``documents`` with the levels domain (an expression), lang and source, in DuckDB SQL."""
    levels = ["domain", "lang", "source"]
    ctes = [
        f"d as (select doc_id, {domain} as domain, coalesce(lang, 'unknown') as lang, coalesce(source, 'unknown') as source, len(list_filter(string_split_regex(text, '[ \\t-\\r]+'), lambda w: w <> '')) as n_tokens from documents)",
        "r as (select * from d where n_tokens > 0)",
        "leaf as (select domain, lang, source, sum(n_tokens) as tokens from r group by all)",
        f"b0 as (select 0 as root, {share} * cast(sum(tokens) as double) as budget from leaf)",
    ]
    for i, level in enumerate(levels):
        keys, parent = ", ".join(levels[: i + 1]), ", ".join(["root", *levels[:i]])
        w = f"case {level} " + " ".join(f"when '{k}' then {float(v)}" for k, v in weights[i].items()) + " else 1.0 end" if weights[i] else "1.0"
        ctes += [
            f"n{i} as (select 0 as root, {keys}, cast(sum(tokens * {max_epochs}) as double) as supply, cast({w} as double) as w from leaf group by {keys})",
            f"o{i} as (select *, case when w > 0 then supply / w else 'infinity'::double end as ratio from n{i} join b{i} using ({parent}))",
            f"l{i} as (select *, case when w > 0 then (budget - coalesce(sum(case when w > 0 then supply end) over (partition by {parent} order by ratio, {level} rows between unbounded preceding and 1 preceding), 0)) / nullif(sum(w) over (partition by {parent} order by ratio, {level} rows between current row and unbounded following), 0) end as level from o{i})",
            f"b{i + 1} as (select root, {keys}, greatest(case when w > 0 then least(supply, max(level) over (partition by {parent}) * w) else 0 end, 0) as budget from l{i})",
        ]
    ctes += [
        "f as (select leaf.*, cast(round(budget) as bigint) as budget from leaf join b3 using (domain, lang, source))",
        "g as (select *, budget // tokens as n_full, budget - (budget // tokens) * tokens as part from f)",
        "t as (select r.*, n_full, part, unnest(range(cast(n_full + case when part > 0 then 1 else 0 end as bigint))) as epoch from r join g using (domain, lang, source))",
        f"c as (select *, sum(n_tokens) over (partition by domain, lang, source, epoch order by md5('{seed}:' || epoch || ':' || doc_id) rows unbounded preceding) - n_tokens as start from t)",
    ]
    return f"with {', '.join(ctes)} select doc_id, domain, lang, source, cast(n_tokens as bigint) as n_tokens, cast(epoch as int) as epoch, cast(start as bigint) as start from c where epoch < n_full or start < part"
