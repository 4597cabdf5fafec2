"""N-gram Jaccard join by prefix trees.

A document's set holds its distinct five-word shingles as 64-bit hashes. Sets are ordered by one
global order, document frequency and then hash:

* the rare end of the order finds who can meet: two sets can only reach the threshold if they share
  one of their rarest ``n - ceil(t * n) + 1`` shingles (prefix filter), so those shingles tie sets
  into families;
* the frequent end makes the prefix trees: the sets of a family share long paths there. Sets walk a
  tree together: each edge's overlap is counted once for all sets below it, and a subtree is left
  where the tokens that remain can't reach the needed overlap.

Frequencies come from one shuffle of packed hashes, not of rows. A shingle that a sample of the sets shows
to be very common isn't counted, as a third of all sets may hold it: it is the last of the order in any
case, so its postings go to their sets by way of buckets that are dealt by set. A shingle in only one set
can't be shared, so a set with fewer than ``t * n`` shared shingles has no partner and goes no further. Exact
copies collapse to one set before anything else. The sets of a family are parted by size, so that sets that
link lie in one part or in neighbouring ones; parts are cut into blocks, and every pair of blocks of such
parts is joined in one task, by a tree of the one and the sets of the other. No link is left out: each set's
links are added up, weighted by copies, and a spanning part of them makes the components.

Results are exact up to collisions of the hashes: 64 bits name a set, 48 bits and the frequency name a
shingle. Texts are shingled twice, for names and for postings, as keeping the postings on disk would cost
more than the second reading.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propscan.llm.batches import LOWER, chunks, gram_hashes, mix, released, released_group, span_hashes, word_spans
from propscan.operators.components import connected_components
from propscan.storage import removed, written

#: Shingles of a bucket that are counted together, about; the number of buckets follows the input.
BUCKET_TOKENS = 2_000_000
#: Shingles that a task gathers before it hands them on, at least.
FLUSH_TOKENS = 800_000
#: Bytes of text shingled together: some ten arrays of eight bytes a byte of text live at once.
CHUNK_BYTES = 1 << 18
#: One set in so many, by its hash, tells which shingles are very common: those in this share of such sets, and
#: in so many of them at least. At most so many are treated apart; the others are counted like rare ones.
SAMPLE_OF, COMMON_SHARE, COMMON_LEAST, COMMON_MOST = 64, 0.001, 20, 200_000
#: Sets of a family's part that one prefix tree holds.
BLOCK = 512
_LOW48 = np.uint64((1 << 48) - 1)
_COMMON = np.uint64(65535 << 48)


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row; a text of fewer than ``k`` words is one shingle."""
    low = LOWER[data]
    starts, ends, first = word_spans(low, off)
    words = span_hashes(low, starts, ends)
    grams = gram_hashes(words, k)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        else:
            yield gram_hashes(words[a:b], b - a) if b > a else grams[:0]


def set_id(hashes: np.ndarray) -> int:
    """A 64-bit name of a set."""
    power = mix(np.arange(1, len(hashes) + 1, dtype=np.uint64)) | np.uint64(1)
    return int(mix(np.atleast_1d((mix(hashes) * power).sum(dtype=np.uint64) + np.uint64(len(hashes)))).view(np.int64)[0])


def _document_sets(k: int, sample_of: int):
    """Size and name of each row's set, and the shingles of sampled sets where a task first meets them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, sids, sampled = [], [], []
            for _, _, data, off in chunks(batch.column(0), CHUNK_BYTES):
                for s in shingle_sets(data, off, k):
                    sizes.append(len(s))
                    sids.append(set_id(s) if len(s) else None)
                    first = len(s) and sids[-1] % sample_of == 0 and sids[-1] not in seen
                    sampled.append(s.view(np.int64) if first else None)
                    if first:
                        seen.add(sids[-1])
            columns = [*batch.columns[1:], pa.array(sizes, pa.int64()), pa.array(sids, pa.int64()), pa.array(sampled, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[1:], "n_shingles", "sid", "sampled"])

    return run


def _packed(sids: np.ndarray, ns: np.ndarray, owner: np.ndarray, tokens: bytes) -> tuple:
    """One row of packed arrays; ``owner`` (ascending runs) names the set of each token."""
    at = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    which = owner[at]
    return sids[which].tobytes(), ns[which].tobytes(), np.diff(np.r_[at, len(owner)]).astype(np.int32).tobytes(), tokens


def _unpacked(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and sizes of the sets; for each token its set's place there, and the tokens."""
    sids, ns, counts, raw = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("sids", np.int64), ("ns", np.int32), ("counts", np.int32), ("tokens", np.uint8)))
    wide = np.zeros((len(raw) // width, 8), np.uint8)
    wide[:, :width] = raw.reshape(-1, width)
    return sids, ns, np.repeat(np.arange(len(sids), dtype=np.int32), counts), wide.view(np.uint64).ravel()


_PACKED = "bucket int, sids binary, ns binary, counts binary, tokens binary"
_PACKED_ARROW = pa.schema([("bucket", pa.int32()), ("sids", pa.binary()), ("ns", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary())])


def _by_bucket(sids: np.ndarray, ns: np.ndarray, owner: np.ndarray, bucket: np.ndarray, tokens: np.ndarray, width: int) -> pa.RecordBatch:
    order = np.argsort(bucket, kind="stable")
    bucket, owner = bucket[order], owner[order]
    raw = np.ascontiguousarray(tokens[order].view(np.uint8).reshape(-1, 8)[:, :width])
    at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    rows = [(int(bucket[a]), *_packed(sids, ns, owner[a:b], raw[a:b].tobytes())) for a, b in zip(at.tolist(), [*at[1:].tolist(), len(bucket)], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PACKED_ARROW.types, strict=True)], schema=_PACKED_ARROW)


def _token_buckets(k: int, buckets: int, common: np.ndarray):
    """Each task's distinct sets as packed tokens by bucket: top bits choose the bucket, 48 bits remain.

    Tokens that are ``common`` (sorted) go to buckets below 0, which the set chooses."""
    enough = max(FLUSH_TOKENS, min(4_000_000, 32 * buckets))

    def flush(sets: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        names, sizes = np.array([i for i, _ in sets], np.int64), np.array([len(s) for _, s in sets], np.int32)
        owner, tokens = np.repeat(np.arange(len(sets), dtype=np.int32), sizes), np.concatenate([s for _, s in sets])
        bucket = ((tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        if len(common):
            often = common[np.minimum(np.searchsorted(common, tokens), len(common) - 1)] == tokens
            by_set = (names.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
            bucket[often] = -1 - by_set[owner[often]]
        return _by_bucket(names, sizes, owner, bucket, tokens & _LOW48, 6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[int, np.ndarray]] = []
        size = 0
        for batch in batches:
            for _, _, data, off in chunks(batch.column(0), CHUNK_BYTES):
                for s in shingle_sets(data, off, k):
                    if len(s) and (i := set_id(s)) not in seen:
                        if len(seen) > 500_000:  # only saves work: copies that two tasks send on are told apart later
                            seen.clear()
                        seen.add(i)
                        held.append((i, s))
                        size += len(s)
                if size >= enough:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return run


def _shared_tokens(buckets: int):
    """Of one bucket's tokens, those in two sets or more, ranked by frequency, dealt by set; common ones rank last."""

    def run(table: pa.Table) -> pa.Table:
        sids, ns, owner, tokens = _unpacked(table, 6)
        if (bucket := table.column("bucket")[0].as_py()) < 0:
            order = np.argsort(sids[owner], kind="stable")
            s, n, ranks = sids[owner[order]], ns[owner[order]], _COMMON | tokens[order]
            return pa.Table.from_batches([_by_bucket(s, n, np.searchsorted(s, s).astype(np.int32), np.full(len(s), -1 - bucket, np.int32), ranks, 8)])
        order = np.argsort(tokens, kind="stable")
        t = tokens[order]
        same = t[1:] == t[:-1]
        order = order[np.r_[False, same] | np.r_[same, False]]
        tokens, owner = tokens[order], owner[order]  # of the rest, which may be few
        del t, same, order
        order = np.lexsort((sids[owner], tokens))
        t, s = tokens[order], sids[owner[order]]
        order = order[np.r_[True, (t[1:] != t[:-1]) | (s[1:] != s[:-1])]] if len(order) else order
        t = tokens[order]
        _, group, df = np.unique(t, return_inverse=True, return_counts=True)
        df = df[group] if len(t) else np.zeros(0, np.int64)
        order, t, df = order[df >= 2], t[df >= 2], df[df >= 2]
        if not len(order):
            return _PACKED_ARROW.empty_table()
        rank = np.minimum(df, 65534).astype(np.uint64) << np.uint64(48) | t
        s, n = sids[owner[order]], ns[owner[order]]
        by_set = np.argsort(s, kind="stable")
        s, n, rank = s[by_set], n[by_set], rank[by_set]
        to = (s.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        return pa.Table.from_batches([_by_bucket(s, n, np.searchsorted(s, s).astype(np.int32), to, rank, 8)])

    return run


_SETS = "sid long, n int, ranks binary"
_SETS_ARROW = pa.schema([("sid", pa.int64()), ("n", pa.int32()), ("ranks", pa.binary())])


def _partners_possible(percent: int):
    """Sets whose shared shingles alone could reach the threshold, with those shingles in global order."""

    def run(table: pa.Table) -> pa.Table:
        sids, ns, owner, ranks = _unpacked(table, 8)
        order = np.lexsort((ranks, sids[owner]))
        sids, ns, ranks = sids[owner[order]], ns[owner[order]], ranks[order]
        once = np.r_[True, (sids[1:] != sids[:-1]) | (ranks[1:] != ranks[:-1])]  # two tasks may have sent a set's common tokens
        sids, ns, ranks = sids[once], ns[once], ranks[once]
        at = np.flatnonzero(np.r_[True, sids[1:] != sids[:-1]])
        ends = np.r_[at[1:], len(sids)]
        keep = np.flatnonzero((ends - at) * 100 >= percent * ns[at].astype(np.int64))
        out = [(int(sids[at[i]]), int(ns[at[i]]), ranks[at[i] : ends[i]].tobytes()) for i in keep.tolist()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _SETS_ARROW.types, strict=True)], schema=_SETS_ARROW) if out else _SETS_ARROW.empty_table()

    return run


def _prefix_tokens(percent: int):
    schema = pa.schema([("token", pa.int64()), ("sid", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, sids = [], []
            for sid, n, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ranks = np.frombuffer(raw, np.int64)
                tokens.append(ranks[: len(ranks) - -(-percent * n // 100) + 1])
                sids.append(np.full(len(tokens[-1]), sid, np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(sids))], schema=schema)

    return run


class _Node:
    __slots__ = ("below", "leaves", "least", "most", "segment")

    def __init__(self, segment: np.ndarray, least: int, most: int):
        self.segment = segment  # tokens of the edge above, in order
        self.below: dict[int, _Node] = {}  # children by their first token
        self.leaves: list[int] = []  # sets that end here
        self.least = least  # smallest set size below
        self.most = most  # most tokens that a set below still has after this edge


class PrefixTree:
    """Sets of tokens, numbered in the order of the tree from its last to its first, in a path-compressed trie."""

    def __init__(self) -> None:
        self.root = _Node(np.zeros(0, np.int64), 1 << 62, 0)

    def add(self, i: int, size: int, tokens: np.ndarray) -> None:
        """Set ``i`` of ``size`` shingles; ``tokens`` are descending."""
        node, rest = self.root, tokens
        while True:
            node.least, node.most = min(node.least, size), max(node.most, len(rest))
            if not len(rest):
                node.leaves.append(i)
                return
            child = node.below.get(int(rest[0]))
            if child is None:
                node.below[int(rest[0])] = child = _Node(rest, size, 0)
                child.leaves.append(i)
                return
            m = min(len(rest), len(child.segment))
            differ = np.flatnonzero(rest[:m] != child.segment[:m])
            cut = int(differ[0]) if len(differ) else m
            if cut < len(child.segment):
                upper = _Node(child.segment[:cut], child.least, child.most + len(child.segment) - cut)
                child.segment = child.segment[cut:]
                upper.below[int(child.segment[0])] = child
                node.below[int(rest[0])] = child = upper
            node, rest = child, rest[cut:]

    def links(self, sizes: np.ndarray, queries: "_Queries", percent: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each set of the tree (whose size is in ``sizes``), the queries that it links to, if any.

        All queries walk the tree together: an edge's overlap with each of them is counted once for all sets below
        it, and queries whose remaining tokens, or those of the sets below, can't reach the needed overlap go no further.
        """
        stack = [(self.root, np.arange(len(queries.size)), np.zeros(len(queries.size), np.int64))]
        while stack:
            node, alive, overlap = stack.pop()
            if len(node.segment):
                overlap = overlap + queries.count(node.segment)[alive]
                left = np.minimum(queries.left(alive, int(node.segment[-1])), node.most)
                going = (overlap + left) * (100 + percent) >= percent * (queries.size[alive] + node.least)
                alive, overlap = alive[going], overlap[going]
                if not len(alive):
                    continue
            for y in node.leaves:
                found = alive[overlap * (100 + percent) >= percent * (queries.size[alive] + sizes[y])]
                if len(found):
                    yield y, found
            stack.extend((child, alive, overlap) for child in node.below.values())


class _Queries:
    """Sets that walk a tree: ``owner, token`` ascending, each below ``len(size)`` and ``n_tokens``."""

    def __init__(self, size: np.ndarray, owner: np.ndarray, token: np.ndarray, n_tokens: int):
        self.size, self.width = size, n_tokens + 1
        self.key = owner * self.width + token
        self.first = np.searchsorted(owner, np.arange(len(size)))
        by_token = np.argsort(token, kind="stable")
        self.owner = owner[by_token]
        self.at = np.searchsorted(token[by_token], np.arange(n_tokens + 1))

    def count(self, tokens: np.ndarray) -> np.ndarray:
        """How many of ``tokens`` each query holds."""
        n = self.at[tokens + 1] - self.at[tokens]
        upto = np.cumsum(n)
        place = np.arange(int(upto[-1])) + np.repeat(self.at[tokens] - (upto - n), n)
        return np.bincount(self.owner[place], minlength=len(self.size))

    def left(self, which: np.ndarray, token: int) -> np.ndarray:
        """Tokens of queries that come after ``token`` in the order of the tree."""
        return np.searchsorted(self.key, which * self.width + token) - self.first[which]


def _families(sets: DataFrame, percent: int) -> DataFrame:
    """``node, component`` of the sets that rare shingles tie together."""
    prefix = written(sets.mapInArrow(_prefix_tokens(percent), "token long, sid long"), "prefix")
    heads = prefix.groupBy("token").agg(F.min("sid").alias("head"), F.count("*").alias("c")).where("c > 1").select("token", "head")
    found = connected_components(prefix.join(heads, "token").where("sid <> head").select("sid", "head").distinct(), "sid", "head")
    removed(sets.sparkSession, prefix)
    return found


_COUNTED = "a long, b long, n long"
_COUNTED_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def _tree_join(percent: int):
    """All links of one block, or between the two sides of a pair of blocks: rows ``(a, null, n)`` with the
    documents that set ``a`` links to, and rows ``(a, b, null)`` that span the components."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, _, up, first, second = (x.as_py() for x in key)
        table = table.sort_by("side")
        sids, size, copies, side = (table.column(c).to_numpy().astype(np.int64) for c in ("sid", "n", "copies", "side"))
        n, split = len(sids), int(np.searchsorted(side, 1))
        if split == 0 or (split == n and (up or first != second)):  # a block of the pair is empty
            return _COUNTED_ARROW.empty_table()
        ranks = [np.frombuffer(x, np.uint64) for x in table.column("ranks").to_pylist()]
        owner = np.repeat(np.arange(n), [len(r) for r in ranks])
        names, token, often = np.unique(np.concatenate(ranks), return_inverse=True, return_counts=True)
        shared = (often > 1)[token]  # a token of one set of the table is in no overlap
        owner, token = owner[shared], (np.cumsum(often > 1) - 1)[token[shared]]
        n_tokens, cuts = int((often > 1).sum()), np.searchsorted(owner, np.arange(n + 1))
        begin = split if split < n else 0
        tree = PrefixTree()
        for i in range(begin, n):
            if cuts[i] < cuts[i + 1]:
                tree.add(i, int(size[i]), token[cuts[i] : cuts[i + 1]][::-1])  # most frequent first
        queries = _Queries(size[:split], owner[: cuts[split]], token[: cuts[split]], n_tokens)
        link = np.zeros((split, n - begin), bool)
        for y, found in tree.links(size, queries, percent):
            link[found, y - begin] = True
        right = slice(begin, n)
        if split == n:
            np.fill_diagonal(link, False)
        weight = copies.astype(np.float64)
        found = np.zeros(n, np.int64)
        found[:split] = link @ weight[right]
        if split < n:
            found[right] = weight[:split] @ link
        at = np.flatnonzero(found)
        seen = np.zeros(n, bool)
        ends: list[tuple[int, int]] = []
        for first in at.tolist():
            if seen[first]:
                continue
            seen[first] = True
            stack = [first]
            while stack:
                i = stack.pop()
                if split == n:
                    near = np.flatnonzero(link[i] & ~seen)
                elif i < split:
                    near = np.flatnonzero(link[i] & ~seen[right]) + split
                else:
                    near = np.flatnonzero(link[:, i - split] & ~seen[:split])
                seen[near] = True
                ends += [(i, j) for j in near.tolist()]
                stack += near.tolist()
        x, y = np.array(ends, np.int64).reshape(-1, 2).T
        counted, spanning = len(at), len(ends)
        return pa.table(
            [
                pa.array(np.r_[sids[at], sids[x]]), pa.array([None] * counted + sids[y].tolist(), pa.int64()),
                pa.array(found[at].tolist() + [None] * spanning, pa.int64()),
            ], schema=_COUNTED_ARROW,
        )

    return run


def _links(sets: DataFrame, copies: DataFrame, percent: int, block: int) -> tuple[DataFrame, list[DataFrame]]:
    """Rows of ``_tree_join`` over all pairs of blocks of each family whose sizes can link, and the written tables
    that they come from; ``copies``: ``sid, copies``."""
    families = _families(sets, percent)
    families = families.join(copies, families.node == copies.sid).select("node", "component", "copies")
    part = F.floor(F.log("n") / F.log(F.lit(100 / percent * (1 + 1e-9)))).cast("int")  # sets that link differ by 1 at most
    members = sets.join(families, sets.sid == families.node).select("sid", "n", "copies", "ranks", F.col("component").alias("family"), part.alias("part"))
    members = stored = written(members, "members")
    sizes = written(members.groupBy("family", "part").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), "parts")
    near = sizes.join(sizes.select("family", (F.col("part") - 1).alias("part"), F.col("blocks").alias("above")), ["family", "part"], "left")
    near = near.join(sizes.select("family", (F.col("part") + 1).alias("part"), F.col("blocks").alias("below")), ["family", "part"], "left")
    members = members.join(near, ["family", "part"]).withColumn("block", F.pmod(F.xxhash64("sid"), "blocks").cast("int"))
    meets = F.expr(
        "concat(transform(sequence(0, blocks - 1), j -> struct(part as part, 0 as up, least(block, j) as i, greatest(block, j) as j, if(j < block, 1, 0) as side)),"
        " if(above is null, array(), transform(sequence(0, above - 1), j -> struct(part as part, 1 as up, block as i, j as j, 0 as side))),"
        " if(below is null, array(), transform(sequence(0, below - 1), i -> struct(part - 1 as part, 1 as up, i as i, block as j, 1 as side))))"
    )
    pairs = members.withColumn("pair", F.explode(meets)).select("family", "sid", "n", "copies", "ranks", "pair.part", "pair.up", "pair.i", "pair.j", "pair.side")
    return pairs.groupBy("family", "part", "up", "i", "j").applyInArrow(_tree_join(percent), _COUNTED), [stored, sizes]


def _common_tokens(ids: DataFrame, share: float, least: int) -> np.ndarray:
    """Shingles that are very common by the sampled sets of ``ids``, sorted; at most ``COMMON_MOST``."""
    sampled = ids.where("sampled is not null").select("sid", "sampled").dropDuplicates(["sid"])
    enough = max(least, int(share * sampled.count()))
    tokens = sampled.select(F.explode("sampled").alias("token")).groupBy("token").count().where(F.col("count") >= enough)
    return np.sort(np.array([r.token for r in tokens.orderBy(F.desc("count"), "token").limit(COMMON_MOST).collect()], np.int64).view(np.uint64))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, block: int = BLOCK, bucket_tokens: int = BUCKET_TOKENS,
    n_links: bool = False, carry: str | None = None, common: tuple[int, float, int] = (SAMPLE_OF, COMMON_SHARE, COMMON_LEAST),
) -> DataFrame:
    """Return ``(doc_id, n_shingles, component_id)`` and with ``n_links`` that column, one row for each row of ``docs``.

    Words are runs without white space, A to Z lower-cased. Two documents link when the Jaccard
    index of their shingle sets is at least ``percent`` / 100; ``component_id`` is the smallest id
    reachable by links, itself included. Null, empty and blank texts have no shingle and link with
    nothing; texts under ``k`` words are one shingle. Repeated rows each give a row. Rows without
    an id are linked like others, but don't name a component. An empty table gives no rows. Other
    columns are ignored, whatever their names. With ``n_links`` a fourth column counts the other rows
    of ``docs`` that the row links with, rows of equal text among them; no pair is left out. With
    ``carry``, a column that tells rows apart, that column and ``group`` are returned besides: one number for
    the rows of a component, also where ids are null, and null for rows without a shingle. ``common``:
    see ``SAMPLE_OF``; it decides where work is done, not what is found.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id"), *([F.col(carry).alias("_carry")] if carry else []))
    plain = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[1:])
    ids = written(rows.mapInArrow(released(_document_sets(k, common[0])), f"{plain}, n_shingles long, sid long, sampled array<long>"), "sets")
    total = ids.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = int(max(8, -(-total // bucket_tokens)))
    packed = rows.select("text").mapInArrow(released(_token_buckets(k, buckets, _common_tokens(ids, *common[1:]))), _PACKED)
    shared = packed.groupBy("bucket").applyInArrow(released_group(_shared_tokens(buckets)), _PACKED)
    sets = written(shared.groupBy("bucket").applyInArrow(released_group(_partners_possible(percent)), _SETS), "shared")
    copies = ids.where("sid is not null").groupBy("sid").agg(F.count("*").alias("copies"))
    found, read = _links(sets, copies, percent, block)
    links = written(found, "links")
    removed(spark, sets, *read)
    linked = connected_components(links.where("n is null"), "a", "b")
    others = written(links.where("n is not null").groupBy(F.col("a").alias("sid")).agg(F.sum("n").alias("others")), "others") if n_links else None
    removed(spark, links)

    first = ids.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("first_id"), (F.count("*") - 1).alias("n_links"))
    if n_links:
        first = first.join(others, "sid", "left").select("sid", "first_id", (F.col("n_links") + F.coalesce("others", F.lit(0))).alias("n_links"))
    named = first.join(linked, first.sid == linked.node, "left").select("sid", "first_id", "n_links", F.coalesce("component", "sid").alias("component"))
    named = written(named, "named")
    removed(spark, linked, *([others] if n_links else []))
    roots = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(roots, "component").select("sid", "component_id", "n_links", F.col("component").alias("group"))
    count = [F.coalesce("n_links", F.lit(0)).alias("n_links")] if n_links else []
    held = [F.col("_carry").alias(carry), "group"] if carry else []
    return ids.join(named, "sid", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), *count, *held)
