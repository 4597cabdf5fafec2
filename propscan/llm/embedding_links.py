"""Near duplicates among embeddings: sign hashes by random hyperplanes in several tables, exact cosines, components.

Equal vectors are one node with a number of copies. A table gives a node ``bits`` signs of random projections; nodes of
equal signs meet in a bucket. ``bits`` follows the number of nodes, so that a bucket of unrelated vectors holds about
``BUCKET``, and the number of tables follows from ``bits`` and ``recall``: a pair right at the threshold meets in one of
them at least with that probability, a closer pair more often. Buckets of more than ``BLOCK`` nodes are cut into parts
that are compared pair of parts by pair of parts, so no task gets a whole hot bucket and no candidate is left out. All
candidates' cosines are computed in double precision, as products of matrices; a pair that meets in several tables
counts in the first of them. A task sends sums of links and a spanning forest, never pairs.

A bucket of m nodes that are truly alike but not equal is m * m cosines in m / ``BLOCK`` copies of its rows: counting the
links of such a group can't do with less than its links.
"""

from __future__ import annotations

from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propscan.llm.batches import mix
from propscan.operators.components import connected_components
from propscan.storage import removed, written

#: Unrelated nodes of a bucket, nodes of a part of a hot bucket, and rows of a group of cells that one call gets.
BUCKET, BLOCK, GROUP = 128, 4096, 8192
#: Rows of a strip of cosines.
_STRIP = 512


def shape(nodes: int, threshold: float = 0.95, recall: float = 0.99, bucket: int = BUCKET) -> tuple[int, int]:
    """``bits`` and number of tables for so many nodes."""
    bits = max(1, min(48, ceil(log2(max(nodes, 2) / bucket))))
    meets = (1 - acos(threshold) / pi) ** bits
    return bits, max(1, ceil(log(1 - recall) / log(1 - meets)))


def signs(x: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """Keys of vectors in each table; planes depend on the seed and the dimension."""
    planes = np.random.default_rng([seed, x.shape[1]]).standard_normal((x.shape[1], tables * bits))
    up = (x @ planes >= 0).reshape(len(x), tables, bits)
    return up @ (1 << np.arange(bits, dtype=np.int64))


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows by dimension: their places and their components, scaled so that squares stay finite."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size, values = column.value_lengths().to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    first, out = np.cumsum(size) - size, []
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        x = values[first[at][:, None] + np.arange(d)]
        out.append((at, x / np.abs(x).max(1, keepdims=True)))
    return out


def _keys(bits: int, tables: int, seed: int):
    """Rows ``t, key, node, m, vector``: a node's bucket in each table."""

    def run(batches):
        for batch in batches:
            for at, x in _matrix(batch.column(2)):
                key = signs(x, bits, tables, seed)
                t = np.broadcast_to(np.arange(tables), key.shape).ravel()
                bucket = mix(mix(np.uint64(x.shape[1]) + key.astype(np.uint64).ravel()) + t.astype(np.uint64)).view(np.int64)
                rows = batch.take(pa.array(np.repeat(at, tables)))
                yield pa.record_batch({"t": pa.array(t.astype(np.int32)), "key": pa.array(bucket), "node": rows.column(0), "m": rows.column(1), "vector": rows.column(2)})

    return run


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each row reaches by pairs ``i, j``."""
    root = np.arange(n)
    while True:
        old = root.copy()
        least = np.minimum(root[i], root[j])
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        root = root[root]
        if np.array_equal(root, old):
            return root


def _linked(bits: int, tables: int, seed: int, threshold: float):
    """Sums of links and forests of a group's cells."""

    def cell(t: int, x: np.ndarray, node: np.ndarray, m: np.ndarray, side: np.ndarray | None):
        norm = np.sqrt((x * x).sum(1))
        key = signs(x, bits, tables, seed)
        a, b = (np.arange(len(x)),) * 2 if side is None else (np.flatnonzero(~side), np.flatnonzero(side))
        found = []
        for s in range(0, len(a), _STRIP):
            i = a[s : s + _STRIP]
            near = (x[i] @ x[b].T) / (norm[i][:, None] * norm[b]) >= threshold
            p, q = np.nonzero(near)
            p, q = i[p], b[q]
            if side is None:
                p, q = p[p < q], q[p < q]
            for earlier in range(t):
                own = key[p, earlier] != key[q, earlier]
                p, q = p[own], q[own]
            found.append((p, q))
        p, q = (np.concatenate(v) for v in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
        n = np.bincount(p, m[q], len(x)) + np.bincount(q, m[p], len(x))
        root = _roots(len(x), p, q)
        return n.astype(np.int64), root

    def run(table: pa.Table) -> pa.Table:
        t, cells, node, m, side = (table.column(c).to_numpy() for c in ("t", "cell", "node", "m", "side"))
        nodes, others, counts = [], [], []
        for at, x in _matrix(table.column("vector")):
            order = np.argsort(cells[at], kind="stable")
            at, x = at[order], x[order]
            for s in np.split(np.arange(len(at)), np.flatnonzero(np.diff(cells[at])) + 1):
                own = at[s]
                if len(own) > 1:
                    n, root = cell(int(t[own[0]]), x[s], node[own], m[own], None if side[own[0]] < 0 else side[own] == 1)
                    some, child = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(own)))
                    nodes += [node[own[some]], node[own[child]]]
                    others += [np.full(len(some), -1), node[own[root[child]]]]
                    counts += [n[some], np.zeros(len(child), np.int64)]
        none = [np.zeros(0, np.int64)]
        nodes, others, counts = (np.concatenate([*none, *v]).astype(np.int64) for v in (nodes, others, counts))
        single = counts > 0
        return pa.table({"node": pa.array(nodes), "other": pa.array(others, mask=single), "n": pa.array(counts)})

    return run


def links(nodes: DataFrame, threshold: float, recall: float, seed: int, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """``node, other, n`` for nodes ``node, m, vector``: rows with a count of copies linked, and rows of forests' edges."""
    spark = nodes.sparkSession
    number = nodes.count()
    bits, tables = shape(number, threshold, recall, bucket)
    kind = nodes.schema["vector"].dataType.simpleString()
    rows = nodes.select("node", "m", "vector").mapInArrow(_keys(bits, tables, seed), f"t int, key long, node long, m long, vector {kind}")
    hot = written(rows.groupBy("t", "key").agg(F.count("*").alias("held")).where(F.col("held") > block).select("t", "key", "held", F.ceil(F.col("held") / block).cast("int").alias("parts")), "hot-buckets")
    more = hot.agg(F.sum(F.col("held") * F.col("parts"))).first()[0]
    if more:
        rows = rows.join(hot.drop("held"), ["t", "key"], "left").withColumn("part", F.pmod(F.xxhash64("node", "t"), F.coalesce("parts", F.lit(1))).cast("int"))
        pair = F.explode(F.expr("sequence(0, coalesce(parts, 1) - 1)")).alias("other")
        cut = rows.select("t", "key", "node", "m", "vector", "part", pair)
        side = F.when(F.col("part") == F.col("other"), -1).otherwise((F.col("part") > F.col("other")).cast("int"))
        rows = cut.select("t", "node", "m", "vector", side.alias("side"), F.xxhash64("t", "key", F.least("part", "other"), F.greatest("part", "other")).alias("cell"))
    else:
        rows = rows.select("t", "node", "m", "vector", F.lit(-1).alias("side"), F.xxhash64("t", "key").alias("cell"))
    groups = max(1, (number * tables + (more or 0)) // GROUP)
    grouped = rows.withColumn("cells", F.pmod(F.hash("cell"), F.lit(groups))).groupBy("cells")
    out = written(grouped.applyInArrow(_linked(bits, tables, seed, threshold), "node long, other long, n long"), "vector-links")
    removed(spark, hot)
    return out


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, recall: float = 0.99, seed: int = 17, **sizes) -> DataFrame:
    """Links and groups of the rows ``vec_id, embedding`` by cosine.

    Returns for each row: ``vec_id``; ``n_links``, the other rows found with a cosine of ``threshold`` at least, equal
    vectors included; ``component_id``, the smallest id that it reaches by links; and ``kept``, whether that is its own.
    A vector that is null, zero or has null or non-finite components, and a row without an id, link with nothing; such a
    row is a component of its own (null without an id, and not kept). Vectors of different lengths aren't compared. Rows that repeat an id
    are vectors of their own; other columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    plain = F.expr("vec_id is not null and vector is not null and not exists(vector, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(vector, x -> x <> 0)")
    node = F.xxhash64(F.size("vector"), "vector")
    rows = rows.withColumn("node", F.when(F.coalesce(plain, F.lit(False)), node))
    valid = rows.where("node is not null")
    nodes = written(valid.groupBy("node").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("m"), F.first("vector").alias("vector")), "vector-nodes")
    found = links(nodes, threshold, recall, seed, **sizes)
    component = connected_components(found.where("other is not null"), "node", "other")
    counts = found.where("other is null").groupBy("node").agg(F.sum("n").alias("n"))
    told = nodes.select("node", "first_id", "m").join(component, "node", "left").join(counts, "node", "left")
    told = told.select("node", "first_id", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component"))
    told = written(told, "vector-components")
    firsts = told.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of = written(told.join(firsts, "component").select("node", "n_links", "component_id"), "vector-groups")
    removed(spark, nodes, found, component, told)
    linked = valid.select("vec_id", "node").join(of, "node").select("vec_id", "n_links", "component_id")
    alone = rows.where("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
