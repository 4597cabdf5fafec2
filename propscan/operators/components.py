"""Connected components of an edge table by minimum-label propagation with pointer jumping, and those that keep labels apart."""

from __future__ import annotations

import itertools

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from propscan.storage import removed, written


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """Return ``(node, component)`` for every node of ``edges``; component is the smallest node reachable.

    Edges with a null end are ignored, loops give a component of one node, repeated edges count
    once, an empty table gives an empty result. Each round takes the smallest label among a node's
    neighbours and then the label of that label, so the number of rounds follows the logarithm of
    a component's diameter. Labels are written to the shared folder after every round; a run that
    is not stable after ``max_rounds`` raises.
    """
    spark = edges.sparkSession
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    e = written(e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = written(e.groupBy(F.col("u").alias("node")).agg(F.least(F.first("u"), F.min("v")).alias("component")), "labels")
    for _ in range(max_rounds):
        near = e.join(labels, e.v == labels.node).groupBy("u").agg(F.min("component").alias("near"))
        step = labels.join(near, labels.node == near.u, "left").select("node", F.col("component").alias("was"), F.least("component", "near").alias("now"))
        of = labels.select(F.col("node").alias("root"), F.col("component").alias("jump"))
        step = step.join(of, step.now == of.root, "left").select("node", "was", F.least("now", "jump").alias("component"))
        seen = Observation()
        changed = F.coalesce(F.sum((F.col("was") != F.col("component")).cast("long")), F.lit(0))
        new = written(step.observe(seen, changed.alias("changed")).select("node", "component"), "labels")
        removed(spark, labels)
        labels = new
        if not seen.get["changed"]:
            removed(spark, e)
            return labels
    raise RuntimeError(f"components are not stable after {max_rounds} rounds")


def _one_after_another(batches):
    """``u, into``: parts and the smallest of those that they are joined with. Rows come in order: ``kind`` 0 are parts that
    clash, 1 are a part's labels, 2 are links; each link joins its two parts unless they clash."""
    top, least, foes, held = {}, {}, {}, {}

    def find(x):
        while x in top:
            if top[x] in top:
                top[x] = top[top[x]]
            x = top[x]
        return x

    for rows in batches:
        for kind, u, v, case, label in zip(*(rows.column(c).to_pylist() for c in ("kind", "u", "v", "case", "label"))):
            if kind == 0:
                foes.setdefault(u, set()).add(v)
                foes.setdefault(v, set()).add(u)
            elif kind == 1:
                own = held.setdefault(u, {})
                own[case] = label if own.get(case, label) == label else object()  # two labels of a case clash with any
            else:
                x, y = find(u), find(v)
                if x == y or y in foes.get(x, ()):
                    continue
                if len(foes.get(x, ())) + len(held.get(x, ())) > len(foes.get(y, ())) + len(held.get(y, ())):
                    x, y = y, x
                few, many = sorted((held.get(x, {}), held.get(y, {})), key=len)
                if any(many.get(c, n) != n for c, n in few.items()):
                    continue
                top[x], least[y] = y, min(least.pop(x, x), least.get(y, y))
                for z in foes.pop(x, ()):
                    foes[z].remove(x)
                    foes[z].add(y)
                    foes.setdefault(y, set()).add(z)
                if x in held:
                    held[y] = many | few
                    del held[x]
    pairs = [(x, n) for x in (*top, *least) if (n := least.get(r := find(x), r)) != x]
    if pairs:
        kind = rows.schema.field("u").type
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c in zip(*pairs)], names=["u", "into"])


def constrained_components(edges: DataFrame, labels: DataFrame, rank: str = "rule", batch: int = 500_000) -> DataFrame:
    """Components of ``edges`` (``a, b`` and ``rank``) in which no two labels clash: ``(node, component)`` for each node of ``edges``; written.

    ``labels``: rows ``node, case, label``; a component may hold one label of each case only. Edges are tried in the order
    of ``rank``, the smaller and the larger node; each joins its two components, unless that would bring two labels of a
    case together. A component is named by its smallest node. Null ends and repeated edges are ignored; labels of other nodes too.

    Where no case has two labels, these are plain components. Otherwise edges are dealt into slices by their order, and rounds
    try the first slices that hold at most ``batch`` edges, one after another in one task, which is as large for any input. Then all
    other edges lead between the parts that are left, one for two parts (the first, as what it is refused the others are too).
    So a round needs a few joins, and there are about as many as batches in what earlier rounds leave.
    """
    spark = edges.sparkSession
    ends = edges.where("a is not null and b is not null").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"), F.col(rank).alias("rank"))
    known = labels.where("node is not null and case is not null and label is not null").select(F.col("node").alias("part"), "case", "label").distinct()
    several = known.groupBy("case").agg(F.min("label").alias("_least"), F.max("label").alias("_most")).where("_least <> _most").select("case")
    tags = written(known.join(several, "case", "left_semi"), "labels-held")
    if tags.isEmpty():
        removed(spark, tags)
        return connected_components(edges.select("a", "b"), "a", "b")
    seen = Observation()
    links = written(ends.groupBy("u", "v").agg(F.min("rank").alias("rank")).observe(seen, F.count("*").alias("n")), "links")
    nodes = written(links.select(F.col("u").alias("node")).union(links.select("v")).distinct(), "nodes")
    slices = max(1, -(-4 * seen.get["n"] // batch))
    order = ["rank", "u", "v"]
    left = links.where("u <> v").repartitionByRange(slices, *order).sortWithinPartitions(*order).select("u", "v", F.monotonically_increasing_id().alias("at"))
    left = written(left, "links-left")
    removed(spark, links)
    of = None
    slice_ = F.shiftright("at", 33)  # at: the slice, and the place in it
    while counts := left.groupBy(slice_.alias("slice")).count().orderBy("slice").collect():
        total = itertools.accumulate(c["count"] for c in counts)
        last = max(c.slice for c, n in zip(counts, total) if n <= batch or c is counts[0])
        now, later = left.where(slice_ <= last), left.where(slice_ > last)
        ends = now.select(F.col("u").alias("part")).union(now.select("v")).distinct()
        held = written(tags.join(ends, "part", "left_semi"), "labels-now")
        rows = _clashes(held).union(now.select(F.lit(2).alias("kind"), "u", "v", "at", F.lit(None).cast("string").alias("case"), F.lit(None).cast("string").alias("label")))
        kind = left.select("u", F.col("u").alias("into")).schema
        joined = written(rows.repartition(1).sortWithinPartitions("kind", "at").mapInArrow(_one_after_another, kind), "joined")
        to = lambda df, c: df.join(joined.withColumnRenamed("u", "_was"), F.col(c) == F.col("_was"), "left").withColumn(c, F.coalesce("into", c)).drop("into", "_was")  # noqa: E731, B023
        moved = to(to(later, "u"), "v").where("u <> v").groupBy(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).agg(F.min("at").alias("at"))
        new_left, new_tags = written(moved, "links-left"), written(to(tags, "part").select("part", "case", "label").distinct(), "labels-held")
        fresh = joined.select(F.col("u").alias("node"), F.col("into").alias("part"))
        new_of = written(fresh if of is None else to(of, "part").select("node", "part").union(fresh), "parts")
        removed(spark, left, tags, held, joined, *([] if of is None else [of]))
        left, tags, of = new_left, new_tags, new_of
    found = nodes if of is None else nodes.join(of, "node", "left")
    out = written(found.select("node", F.col("node").alias("component") if of is None else F.coalesce("part", "node").alias("component")), "components")
    removed(spark, left, tags, nodes, *([] if of is None else [of]))
    return out


def _clashes(held: DataFrame, few: int = 16) -> DataFrame:
    """Rows of ``_one_after_another`` that tell which parts of ``held`` (``part, case, label``) clash: pairs, or the labels of cases of more than ``few`` rows."""
    sizes = held.groupBy("case").agg(F.count("*").alias("_n"), F.min("label").alias("_least"), F.max("label").alias("_most")).where("_least <> _most").select("case", "_n")
    sized = held.join(sizes, "case")
    one = sized.where(F.col("_n") <= few).select("case", F.col("part").alias("u"), "label")
    two = held.select("case", F.col("part").alias("v"), F.col("label").alias("_label"))
    pairs = one.join(two, "case").where("u < v and label <> _label").select("u", "v").distinct()
    none, text = F.lit(None).cast("string"), lambda c: F.to_json(F.struct(c))
    pairs = pairs.select(F.lit(0).alias("kind"), "u", "v", F.lit(0).cast("long").alias("at"), none.alias("case"), none.alias("label"))
    many = sized.where(F.col("_n") > few).select(F.lit(1).alias("kind"), F.col("part").alias("u"), F.col("part").alias("v"), F.lit(0).cast("long").alias("at"), text("case").alias("case"), text("label").alias("label"))
    return pairs.union(many)
