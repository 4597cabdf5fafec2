"""Best-fit packing: length patterns fitted by non-negative least squares.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens; full pieces are
sequences already. For the rest only the histogram of lengths (``capacity`` counts at most) comes to
the driver. Patterns of up to ``depth`` length classes that fill a sequence are enumerated, repeat
counts are fitted to the histogram by non-negative least squares and rounded down, each pattern is
filled with lengths that exist (the last one best-fit at exact length), and what remains is packed
best-fit decreasing, into the gaps too. The plan is a list of runs ``length, ranks from..to →
sequence, offset``, whose size depends on ``capacity`` only; Spark ranks pieces within their length
and joins them with the runs.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propscan.llm.batches import CHUNK_BYTES, LOWER, flat, released, slices, span_hashes, word_spans
from propscan.storage import written

CAPACITY = 2048
#: Words that a task keeps; beyond, it begins anew.
_CACHE = 400_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


#: ASCII marks that are a token run of their own behind a letter or digit.
_MARK = np.isin(np.arange(256), np.frombuffer(b"!#$%&()*+,-./:;<=>?@[]^_`{|}~", np.uint8))


@cache
def tokenizer(tokenizer_file: str):
    """A worker's tokenizer, kept between tasks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file)


def _sort_of_letter() -> np.ndarray:
    """By code point below 2,048: whether it is a letter, also when lower-cased."""
    return np.array([chr(c).isalpha() and chr(c).lower().isalpha() for c in range(0x800)])


class Encoder:
    """Token ids of whole texts by way of their distinct words.

    White space ends a token of this vocabulary and A to Z are lower-cased, so a chunk is cut into lower-cased
    words, and words from the marks behind them. Each word not met before is tokenised once per task and its
    run of ids kept under the word's 64-bit hash; the chunk's ids are gathered from those runs with numpy.
    New words of letters are tokenised many at a time and told apart by the pieces that end a word. Texts that
    hold a special token's string are tokenised whole.
    """

    def __init__(self, tokenizer_file: str):
        self.tok = tokenizer(tokenizer_file)
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.letter = _sort_of_letter()
        self.forget()

    def forget(self) -> None:
        """Begin anew with the empty run (number 0) and the run of id 0 (number 1)."""
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 1
        self.begin, self.size, self.runs = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 2
        self.size[1] = 1

    def add(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Keep runs of ids, ``size`` of each; return their numbers."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        number = np.arange(self.runs, self.runs + len(size))
        while self.runs + len(size) > len(self.size):
            self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
        self.begin[number], self.size[number] = self.used + np.cumsum(size) - size, size
        self.used += len(ids)
        self.runs += len(size)
        return number

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def _letters_only(self, data: np.ndarray) -> np.ndarray:
        """Whether each byte belongs to a letter of one or two bytes."""
        out = (data >= 97) & (data <= 122)
        lead = np.flatnonzero((data >= 0xC2) & (data < 0xE0))
        good = lead[self.letter[(data[lead].astype(np.int64) & 31) << 6 | data[lead + 1] & 63]]
        out[good] = out[good + 1] = True
        return out

    def _words(self, data: np.ndarray, letters: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of words and of the marks behind a word's last letter or digit; each row's first."""
        starts, stops, at = word_spans(data, off)
        if not len(starts):
            return starts, stops, at
        last = np.maximum.accumulate(np.where(_MARK[data], -1, np.arange(len(data))))[stops - 1]
        split = (last >= starts) & (last < stops - 1)
        split &= letters[last] | (data[last] >= 48) & (data[last] <= 57)
        place = np.r_[0, np.cumsum(1 + split)]
        starts, stops, cut = np.repeat(starts, 1 + split), np.repeat(stops, 1 + split), place[:-1][split]
        starts[cut + 1] = stops[cut] = last[split] + 1
        return starts, stops, place[at]

    def learn(self, data: np.ndarray, letters: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Numbers of new runs, for new words."""
        number = np.zeros(len(starts), np.int64)
        other = np.r_[0, np.cumsum(~letters)]
        plain = other[stops] == other[starts]
        for i in np.flatnonzero(~plain).tolist():
            text = data[starts[i] : stops[i]].tobytes().decode()
            plain[i] = text.isalpha() and text.lower().isalpha()
            if not plain[i]:
                ids = self.whole(text)
                number[i] = self.add(ids, np.array([len(ids)]))[0]
        at = np.flatnonzero(plain)
        for block in np.split(at, range(4000, len(at), 4000)):
            n = stops[block] - starts[block] + 1
            upto = np.cumsum(n)
            place = np.arange(int(upto[-1]) if len(n) else 0) + np.repeat(starts[block] - (upto - n), n)
            joined = data[np.minimum(place, len(data) - 1)]
            joined[upto - 1] = 32
            ids = np.array(self.tok.encode_batch_fast([joined.tobytes().decode()], add_special_tokens=False)[0].ids, np.uint32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(block):
                runs = [self.whole(w) for w in joined.tobytes().decode().split(" ")[:-1]]
                ids, cuts = np.concatenate([np.zeros(0, np.uint32), *runs]), np.cumsum([len(r) for r in runs], dtype=np.int64)
            number[block] = self.add(ids, np.diff(np.r_[0, cuts]))
        return number

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by id 0, and the offsets of the texts in them; a null is empty."""
        if len(self.hashes) > _CACHE:
            self.forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        first = np.zeros(len(texts), np.int64)
        likely = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False))
        odd = [i for i in likely.tolist() if any(s in texts[i].as_py() for s in self.special)]
        if odd:
            runs = [self.whole(texts[i].as_py()) for i in odd]
            first[odd] = self.add(np.concatenate(runs), np.array([len(r) for r in runs]))
            mask = np.zeros(len(texts), bool)
            mask[odd] = True
            texts = pc.replace_with_mask(texts, pa.array(mask), pa.array([""] * len(odd), pa.large_string()))
        data, off = flat(texts)
        data = LOWER[data]
        letters = self._letters_only(data)
        starts, stops, at = self._words(data, letters, off)
        found, one, inverse = np.unique(span_hashes(data, starts, stops), return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, found)
        new = place == len(self.hashes)
        new[~new] = self.hashes[place[~new]] != found[~new]
        if new.any():
            numbers = self.learn(data, letters, starts[one[new]], stops[one[new]])
            self.hashes, self.numbers = np.insert(self.hashes, place[new], found[new]), np.insert(self.numbers, place[new], numbers)
            place = np.searchsorted(self.hashes, found)
        # each text: its first run (of a text tokenised whole), its words, the run of id 0
        run = np.empty(len(starts) + 2 * len(first), np.int64)
        head, tail = at[:-1] + 2 * np.arange(len(first)), at[1:] + 2 * np.arange(len(first)) + 1
        inner = np.ones(len(run), bool)
        inner[head] = inner[tail] = False
        run[head], run[tail] = first, 1
        run[inner] = self.numbers[place][inverse]
        size = self.size[run]
        upto = np.cumsum(size)
        place = np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(self.begin[run] - (upto - size), size)
        return self.ids[place], np.r_[0, upto[tail]]


def _pieces(tokenizer_file: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_file)
        for batch in batches:
            for part in slices(batch, 1, CHUNK_BYTES // 2):
                ids, off = encoder.encode(part.column(1))
                raw = memoryview(ids.astype("<u4").tobytes())
                n = np.diff(off)
                per = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), per)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                at = 4 * (off[row] + start)
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
                docs = part.column(0).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([docs, *(pa.array(c, t) for c, t in zip((piece, start, length, crc), _SCHEMA.types[1:], strict=True))], schema=_SCHEMA)

    return run


def patterns(classes: int, depth: int) -> np.ndarray:
    """Rows: how often each class 1..``classes`` occurs in a pattern of at most ``depth`` that fills ``classes``."""
    found: list[list[int]] = []

    def extend(parts: list[int], left: int) -> None:
        if left == 0:
            found.append(parts)
        elif len(parts) < depth:
            for c in range(min(left, parts[-1] if parts else left), -(-left // (depth - len(parts))) - 1, -1):
                extend([*parts, c], left - c)

    extend([], classes)
    out = np.zeros((len(found), classes))
    for i, parts in enumerate(found):
        np.add.at(out[i], np.array(parts) - 1, 1)
    return out


def nnls(a: np.ndarray, y: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Lawson-Hanson: ``x >= 0`` with the least ``|a x - y|``."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    scale = max(1.0, float(np.abs(y).max()))
    for _ in range(rounds):
        gradient = a.T @ (y - a @ x)
        gradient[active] = -np.inf
        best = int(gradient.argmax())
        if gradient[best] <= 1e-9 * scale:
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, at], y, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            bad = z <= 0
            step = np.min(x[at][bad] / np.maximum(x[at][bad] - z[bad], 1e-300))
            x[at] += step * (z - x[at])
            active[at[(x[at] <= 1e-9 * scale) | (bad & (x[at] <= 0))]] = False
            x[~active] = 0
    return x


def pack_lengths(counts: np.ndarray, capacity: int = CAPACITY, classes: int = 64, depth: int = 4) -> list[tuple[int, int, int, int, int]]:
    """Plan for ``counts[length]`` pieces of each length 1..``capacity`` - 1: runs ``(length, first rank, n,
    first sequence, offset)``; rank ``first + i`` goes to sequence ``first sequence + i`` at ``offset``."""
    left = counts.astype(np.int64).copy()
    width = -(-capacity // classes)
    groups: list[list] = []  # [n, lengths of each of the n sequences, space]

    def largest(limit: int, low: int = 1) -> int:
        at = np.flatnonzero(left[low : limit + 1])
        return int(at[-1]) + low if len(at) else 0

    table = patterns(classes, depth)
    cls = (np.arange(len(left)) + width - 1) // width
    histogram = np.bincount(cls, left, classes + 1)[1 : classes + 1]
    repeats = np.floor(nnls(table.T, histogram) + 1e-6).astype(np.int64)
    for i in np.argsort(-table.argmax(1) * 0 - repeats, kind="stable"):
        todo = int(repeats[i])
        parts = [c + 1 for c in np.flatnonzero(table[i])[::-1].tolist() for _ in range(int(table[i, c]))]
        while todo > 0:
            lengths: list[int] = []
            space = capacity
            for k, c in enumerate(parts):
                last = k == len(parts) - 1
                pick = largest(space, 1 if last and len(parts) > 1 else (c - 1) * width + 1) if last else largest(min(space, c * width), (c - 1) * width + 1)
                if not pick or left[pick] <= lengths.count(pick):
                    break
                lengths.append(pick)
                space -= pick
            if len(lengths) < len(parts):
                break
            n = min(todo, *(int(left[x]) // lengths.count(x) for x in set(lengths)))
            for x in lengths:
                left[x] -= n
            groups.append([n, lengths, space])
            todo -= n
    by_space: dict[int, list[list]] = {}
    for g in groups:
        by_space.setdefault(g[2], []).append(g)
    done: list[list] = by_space.pop(0, [])
    for length in range(len(left) - 1, 0, -1):
        while left[length]:
            spaces = [s for s in by_space if s >= length]
            if spaces:
                best = min(spaces)
                g = by_space[best].pop()
                if not by_space[best]:
                    del by_space[best]
                n = min(g[0], int(left[length]))
                if n < g[0]:
                    by_space.setdefault(best, []).append([g[0] - n, g[1], best])
                new = [n, [*g[1], length], best - length]
            else:
                per = capacity // length
                n, per = (int(left[length]) // per, per) if left[length] >= per else (1, int(left[length]))
                new = [n, [length] * per, capacity - per * length]
                left[length] -= n * (per - 1)
            left[length] -= n
            (done if new[2] == 0 else by_space.setdefault(new[2], [])).append(new)
    runs, rank, sequence = [], np.zeros(len(left), np.int64), 0
    for n, lengths, _ in [*done, *(g for gs in by_space.values() for g in gs)]:
        offset = 0
        for x in lengths:
            runs.append((x, int(rank[x]), n, sequence, offset))
            rank[x] += n
            offset += x
        sequence += n
    return runs


def _table(spark: SparkSession, columns: Iterable[Iterable[int]], names: tuple[str, ...]) -> DataFrame:
    """Columns of whole numbers as a DataFrame; none at all are empty ones."""
    found = list(columns) or [()] * len(names)
    return spark.createDataFrame(pa.table([pa.array([int(x) for x in c], pa.int64()) for c in found], names=list(names)))


def pack(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Return one row a piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its token ids and then id 0, so null and empty texts are one token. Only documents
    longer than ``capacity`` are cut. Repeated rows are packed as often as they occur, ids may be
    null, an empty table gives no rows, other columns are ignored. Full pieces are sequences of their own and
    aren't shuffled; the n pieces of a shorter length are ranked in about sqrt(n) slices of as many pieces,
    so that no length is one task's work.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = written(rows.mapInArrow(released(_pieces(tokenizer_file, capacity)), _PIECES), "pieces")
    tally = {r.length: r.n for r in pieces.where(F.col("length") < capacity).groupBy("length").agg(F.count("*").alias("n")).collect()}  # under `capacity` rows
    counts = np.zeros(capacity, np.int64)
    counts[list(tally)] = list(tally.values())
    runs = pack_lengths(counts, capacity)
    used = max((s + n for _, _, n, s, _ in runs), default=0)
    # from Arrow, as lists would be serialised by Python workers of their own, which stay beside those of the tasks
    plan = _table(spark, zip(*runs, strict=True), ("length", "first", "n", "sequence", "offset"))
    slices_of = _table(spark, zip(*((x, math.isqrt(n - 1) + 1) for x, n in tally.items()), strict=True), ("length", "slices"))

    full = pieces.where(F.col("length") == capacity).select("*", (F.lit(used) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    sliced = pieces.where(F.col("length") < capacity).join(F.broadcast(slices_of), "length")
    sliced = sliced.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "slices")).drop("slices")
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = sliced.groupBy("length", "slice").count().withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    within = Window.partitionBy("length", "slice").orderBy("doc_id", "piece")
    ranked = sliced.withColumn("row", F.row_number().over(within) - 1).join(bases, ["length", "slice"])
    ranked = ranked.withColumn("rank", F.col("row") + F.col("base")).join(F.broadcast(plan), "length").where("rank >= first and rank < first + n")
    placed = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")
    return placed.unionByName(full)
