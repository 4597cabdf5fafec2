"""Toivonen mining of phrases and collocations by language.

A sample of all texts proposes phrases: those of 1 to ``max_words`` words that a lowered threshold calls frequent there,
length by length. One pass over everything then counts, exactly, the proposed phrases and their negative border: every
phrase whose two parts (without its last or its first word) were proposed, and every word. A frequent phrase that wasn't
proposed is a border failure: what holds it may be frequent too and wasn't counted. Another pass counts all that holds a
failure and wasn't counted before, at every length, which closes the border: parts of a frequent phrase are frequent,
so of one that wasn't counted some part is a failure. What is frequent is then known exactly, whatever the sample was.

Phrases are 64-bit hashes of language and words while they are counted (exact up to collisions of those); their wording
comes from the sample, and from the expansion for border failures. A task sums what it finds before it sends it, so a hot
language or phrase is a row or a few from each task. Proposed phrases go to the tasks as a bit table of a fixed size
(``FILTER_BITS``), built by Spark; where it is crowded, more phrases are counted than needed, and none is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propscan.llm.batches import _R, LOWER, chunks, gram_hashes, mix, released, span_hashes, word_spans
from propscan.storage import removed, written

#: Bits of the table of proposed phrases (16 MB), whatever their number.
FILTER_BITS = 1 << 27
#: Hashes that a task holds before it sums them.
_HELD = 3_000_000
#: A language's phrases are ranked in so many slices before their first rows are ranked together.
_SLICES = 64
_COUNTED = "key long, n long, lang string, phrase string"

#: What ends a piece: . , ; : ! ? and 10 to 13; blanks and tabs part words within a piece.
PIECE_END = np.zeros(256, bool)
PIECE_END[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_GAP = PIECE_END.copy()
_GAP[[9, 32]] = True


class Bits:
    """A set of 64-bit hashes as two bits each in a table of ``FILTER_BITS``: never misses one, may claim others."""

    def __init__(self, table: np.ndarray | None = None):
        self.table = np.zeros(FILTER_BITS // 64, np.uint64) if table is None else table

    def __reduce__(self):
        return Bits._unpacked, (zlib.compress(self.table.tobytes(), 1),)

    @staticmethod
    def _unpacked(packed: bytes) -> Bits:
        return Bits(np.frombuffer(zlib.decompress(packed), np.uint64))

    def __or__(self, other: Bits) -> Bits:
        return Bits(self.table | other.table)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for shift in (0, 32):
            at = h >> np.uint64(shift) & np.uint64(FILTER_BITS - 1)
            out &= (self.table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out

    @staticmethod
    def of(keys: DataFrame) -> Bits:
        """The set of ``key`` (long); words of the table are put together by Spark, at most ``FILTER_BITS / 64`` arrive here."""
        at = F.explode(F.array(F.col("key").bitwiseAND(FILTER_BITS - 1), F.shiftrightunsigned("key", 32).bitwiseAND(FILTER_BITS - 1)))
        one = F.expr("shiftleft(1L, cast(at & 63 as int))")
        found = keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
        out = Bits()
        out.table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
        return out


def _lang_seeds(lang: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Languages of rows as indices, and a seed of each row's language."""
    coded = pc.fill_null(lang, "und").dictionary_encode()
    names = coded.dictionary.to_pylist()
    joined = "".join(names).encode()
    stop = np.cumsum([len(n.encode()) for n in names], dtype=np.int64)
    seeds = span_hashes(np.frombuffer(joined, np.uint8), np.r_[0, stop[:-1]].astype(np.int64) if len(stop) else stop, stop)
    return coded, seeds * np.uint64(_R)  # added to a word's hash: the word "en" in "de" isn't the word "de" in "en"


class Chunk:
    """Words of some rows, their hashes and which of them follow each other within a piece."""

    def __init__(self, data: np.ndarray, off: np.ndarray, seeds: np.ndarray):
        self.data = LOWER[data]
        self.starts, self.ends, first = word_spans(self.data, off, _GAP)
        self.row = np.repeat(np.arange(len(off) - 1), np.diff(first))
        self.words = mix(span_hashes(self.data, self.starts, self.ends) + seeds[self.row])
        piece = np.r_[0, np.cumsum(PIECE_END[self.data])][self.starts]
        self.follows = (piece[1:] == piece[:-1]) & (self.row[1:] == self.row[:-1])

    def grams(self, at: np.ndarray, k: int) -> np.ndarray:
        """Hashes of the windows of ``k`` words that begin at ``at``; of all windows at once where that is less work."""
        if 2 * len(at) > len(self.words):
            return gram_hashes(self.words, k)[at]
        acc = np.full(len(at), k, np.uint64)
        for j in range(k):
            acc = acc * np.uint64(_R) + self.words[at + j]
        return mix(acc)

    def valid(self, k: int) -> np.ndarray:
        """Which windows of ``k`` words lie within a piece."""
        n = max(0, len(self.words) - k + 1)
        out = np.ones(n, bool)
        for j in range(k - 1):
            out &= self.follows[j : j + n]
        return out

    def phrase(self, i: int, k: int) -> str:
        return b" ".join(self.data[self.starts[i] : self.ends[i + k - 1]].tobytes().split()).decode()

    def border(self, bits: Bits, max_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length: where windows begin that have both parts in ``bits`` (all words do), and their hashes."""
        held = np.ones(len(self.words), bool)
        for k in range(1, max_words + 1):
            if k > 1:
                held = held[:-1] & held[1:] & (self.follows if k == 2 else True)
            at = np.flatnonzero(held)
            h = self.grams(at, k)
            yield k, at, h
            held = held.copy()
            held[at] = bits.has(h)
            if not held.any():
                return

    def around(self, failed: Bits, bits: Bits, max_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length: where windows begin that hold a failure, their hashes, and whether they weren't counted before."""
        counted = {k: at for k, at, _ in self.border(bits, max_words)}
        held = np.zeros(len(self.words), bool)
        for k in range(1, max_words + 1):
            if k > 1:
                held = (held[:-1] | held[1:]) & self.valid(k)
            own = counted.get(k, np.zeros(0, np.int64))
            own = own[failed.has(self.grams(own, k))]
            held = held.copy()
            held[own] = True
            at = np.flatnonzero(held)
            if len(at):
                yield k, at, self.grams(at, k), ~np.isin(at, counted.get(k, own), assume_unique=True)


def _summed(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    keys, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
    for i in range(0, len(keys), 1 << 17):
        part = slice(i, i + (1 << 17))
        none = pa.nulls(len(keys[part]), pa.string())
        yield pa.record_batch({"key": pa.array(keys[part].view(np.int64)), "n": pa.array(n[part].astype(np.int64)), "lang": none, "phrase": none})


def _worded(wording: dict[int, list]) -> pa.RecordBatch:
    n, langs, phrases = zip(*wording.values(), strict=True) if wording else ((), (), ())
    return pa.record_batch({"key": pa.array(np.array(list(wording), np.uint64).view(np.int64)), "n": pa.array(n, pa.int64()), "lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.string())})


def _pass(max_words: int, count: str, known, told=None):
    """One look at texts. ``known``: proposed phrases. ``all`` counts their border and the words of each language, ``top`` the
    border's longest phrases only; ``around`` counts and words what holds one of the failures ``told``, 0 times what was
    counted before; ``words`` tells the phrases of ``known`` in words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = known.value
        held, size, totals = [], 0, {}
        wording: dict[int, list] = {}
        for batch in batches:
            langs, seeds = _lang_seeds(batch.column(0))
            names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy()
            for i, j, data, off in chunks(batch.column(1)):
                chunk = Chunk(data, off, seeds[codes[i:j]])
                if count in ("around", "words"):
                    found = chunk.around(told.value, bits, max_words) if count == "around" else ((k, at[own], h[own], np.zeros(own.sum(), bool)) for k, at, h in chunk.border(bits, max_words) for own in [bits.has(h)])
                    for k, at, h, new in found:
                        keys, first, back = np.unique(h, return_index=True, return_inverse=True)
                        n = np.bincount(back, new, len(keys)).astype(np.int64)
                        for key, x, times in zip(keys.tolist(), at[first].tolist(), n.tolist(), strict=True):
                            if key in wording:
                                wording[key][0] += times
                            else:
                                wording[key] = [times, names[codes[i + chunk.row[x]]], chunk.phrase(x, k)]
                    if len(wording) > 200_000:
                        yield _worded(wording)
                        wording = {}
                    continue
                if count == "all":
                    for c, n in enumerate(np.bincount(codes[i:j][chunk.row], minlength=len(names)).tolist()):
                        totals[names[c]] = totals.get(names[c], 0) + n
                for k, _, h in chunk.border(bits, max_words):
                    if count == "all" or k == max_words:
                        held.append(h)
                        size += len(h)
                if size > _HELD:
                    yield from _summed(held)
                    held, size = [], 0
        yield from _summed(held)
        yield _worded(wording)
        if totals:
            yield pa.record_batch({"key": pa.nulls(len(totals), pa.int64()), "n": pa.array(list(totals.values()), pa.int64()), "lang": pa.array(list(totals), pa.string()), "phrase": pa.nulls(len(totals), pa.string())})

    return released(run)


def _sampled(share: float):
    """Pieces chosen by a hash of the row's seed and their number in it."""
    limit = np.uint64(min(int(share * 2**64), 2**64 - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = batch.column(2).to_numpy().view(np.uint64)
            for i, j, data, off in chunks(batch.column(1)):
                end = PIECE_END[data]
                piece = np.cumsum(end) - end
                rows = np.repeat(np.arange(j - i), np.diff(off))
                if len(data):
                    begins = off[:-1].clip(max=len(data) - 1)
                    number = piece - piece[begins][rows]
                    chosen = mix(seeds[i:j][rows] + mix(number.astype(np.uint64) * np.uint64(_R))) <= limit
                else:
                    chosen = end
                stop = np.r_[0, np.cumsum(chosen)][off]
                texts = pa.StringArray.from_buffers(j - i, pa.py_buffer(stop.astype(np.int32).tobytes()), pa.py_buffer(data[chosen].tobytes()))
                yield pa.record_batch({"lang": batch.column(0).slice(i, j - i), "text": texts})

    return released(run)


def sample_threshold(min_count: int, share: float) -> int:
    """Three standard deviations below what a phrase of ``min_count`` has in the sample, 2 at least."""
    return max(2, int(min_count * share - 3 * sqrt(min_count * share)))


def _sent(spark: SparkSession, bits: Bits):
    return spark.sparkContext.broadcast(bits)


def mine(docs: DataFrame, min_count: int = 100, max_words: int = 5, share: float = 0.25, at_least: int | None = None) -> tuple[DataFrame, DataFrame, int]:
    """All phrases of 1 to ``max_words`` words that occur ``min_count`` times in a language.

    Returns tables ``lang, phrase, words, n`` and ``lang, n`` (all word occurrences), both written to the shared folder,
    and the number of passes over the whole table. ``at_least``: the sample's threshold (``sample_threshold``).
    A to Z are lower-cased, texts are cut into pieces at ``.,;:!?`` and line ends and those into words at blanks and tabs;
    occurrences lie within a piece and may overlap. A null text has no words, a null language is ``und``, each of several
    equal rows counts, other columns are ignored, an empty table gives empty tables.
    """
    spark = docs.sparkSession
    at_least = sample_threshold(min_count, share) if at_least is None else at_least
    lang, text = (F.coalesce(F.col(c).cast("string"), F.lit(v)).alias(c) for c, v in (("lang", "und"), ("text", "")))
    rows = docs.select(lang, text)
    seed = F.xxhash64(*[c for c in ("doc_id", "text") if c in docs.columns]).alias("seed")
    sample = written(docs.select(lang, text, seed).mapInArrow(_sampled(share), "lang string, text string"), "phrase-sample")

    bits, proposed, levels = Bits(), None, []
    for k in range(1, max_words + 1):
        sent = _sent(spark, bits)
        found = sample.mapInArrow(_pass(k, "top", sent), _COUNTED).groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= at_least)
        level = written(found.select("key"), "phrases-proposed")
        sent.unpersist()
        bits |= Bits.of(level)
        levels.append(level)
        proposed = level if proposed is None else proposed.union(level)
        if level.isEmpty():
            break

    def looked(texts: DataFrame, name: str, count: str, *sets: Bits, where: str = "true") -> DataFrame:
        """A pass over ``texts``, summed by phrase and written."""
        sent = [_sent(spark, x) for x in sets]
        found = texts.mapInArrow(_pass(max_words, count, *sent), _COUNTED)
        by = ["key", "lang"] if count == "all" else ["key"]
        wording = [F.min(c).alias(c) for c in ("lang", "phrase") if c not in by]
        out = written(found.groupBy(*by).agg(F.sum("n").alias("n"), *wording).where(where), name)
        for x in sent:
            x.unpersist()
        return out

    full, passes = looked(rows, "phrases-counted", "all", bits, where=f"n >= {int(min_count)} or lang is not null"), 1
    totals = full.where("key is null").select("lang", "n")
    frequent = full.where("key is not null").select("key", "n")
    told = written(frequent.join(proposed, "key", "left_semi"), "phrases-known")
    failed = written(frequent.join(proposed, "key", "left_anti"), "phrases-failed")
    wording = looked(sample, "phrase-wording", "words", Bits.of(told))
    counts, done = told, [sample, *levels, full, told, failed, wording]
    wording = wording.select("key", "lang", "phrase")
    if not failed.isEmpty():
        more = looked(rows, "phrases-around", "around", bits, Bits.of(failed))
        passes += 1
        done.append(more)
        counts = counts.union(failed).union(more.where(f"n >= {int(min_count)}").select("key", "n"))
        wording = wording.union(more.select("key", "lang", "phrase")).groupBy("key").agg(F.min("lang").alias("lang"), F.min("phrase").alias("phrase"))
    out = counts.join(wording, "key").select("lang", "phrase", F.size(F.split("phrase", " ")).alias("words"), "n")
    found = written(out, "phrases"), written(totals, "phrase-totals"), passes
    removed(spark, *done)
    return found


def collocations(docs: DataFrame, limit: int = 2000, min_count: int = 100, max_words: int = 5, **how) -> DataFrame:
    """The first ``limit`` phrases of each language by their weakest cut.

    Returns ``lang, rank, phrase, a, l, r, n, score`` for phrases of 2 words and more that occur ``a >= min_count`` times.
    Cut after any of its words, a phrase has parts that occur ``l`` and ``r`` times; its score is the least
    ``floor(1000 a n / (l r))`` over the cuts (the first of several), n being all words of the language. A phrase that
    lies in a longer one as often as it occurs is left out. Ranked by score and ``a``, both descending, and the phrase's
    UTF-8 bytes. Nulls, repeats and empty tables are as in ``mine``.
    """
    frequent, totals, _ = mine(docs, min_count, max_words, **how)
    candidates = frequent.where("words > 1").withColumnRenamed("n", "a")
    # a longer phrase that holds this one as often has, between the two, phrases of each length that occur as often
    around = candidates.where("words > 2").select("lang", "a", F.explode(F.expr("array(substring_index(phrase, ' ', words - 1), substring_index(phrase, ' ', 1 - words))")).alias("phrase"))
    kept = candidates.join(around, ["lang", "phrase", "a"], "left_anti")
    cuts = kept.select("lang", "phrase", "words", "a", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.withColumns({"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - words)")})
    firsts, rests = (frequent.select("lang", F.col("phrase").alias(c), F.col("n").alias(v)) for c, v in (("first", "l"), ("rest", "r")))
    scored = cuts.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"]).join(totals, "lang")
    exact = F.expr("(cast(a as decimal(16,0)) * cast(n as decimal(18,0)) * 1000) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    least = F.min(F.struct(exact.alias("score"), "k", "l", "r", "n")).alias("cut")
    found = scored.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(_SLICES))
    first = found.withColumn("slice", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= limit)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= limit)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(limit: int = 2000, min_count: int = 100, max_words: int = 5) -> str:
    """The same collocations, counted phrase by phrase."""
    grams = " union all ".join(
        f"select lang, {k} as words, list_aggregate(w[i : i + {k - 1}], 'string_agg', ' ') as phrase from (select lang, w, unnest(range(1, len(w) - {k - 2})) as i from pieces where len(w) >= {k})"
        for k in range(1, max_words + 1)
    )
    return f"""
with pieces as (
  select lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') as w
  from (select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0B\\f\\r]')) as piece from documents)
), grams as ({grams}
), frequent as (select lang, words, phrase, count(*) as n, string_split(phrase, ' ') as w from grams group by lang, words, phrase having count(*) >= {min_count}
), totals as (select lang, sum(len(w)) as n from pieces group by lang
), around as (
  select lang, n as a, unnest([array_to_string(w[1 : words - 1], ' '), array_to_string(w[2 : words], ' ')]) as phrase from frequent where words > 2
), cuts as (
  select lang, phrase, n as a, unnest(range(1, words)) as k, w, words from frequent f
  where words > 1 and not exists (select 1 from around o where o.lang = f.lang and o.phrase = f.phrase and o.a = f.n)
), scored as (
  select c.lang, c.phrase, c.a, k, x.n as l, y.n as r, t.n as n, (1000::hugeint * c.a * t.n) // (x.n::hugeint * y.n) as score
  from cuts c join totals t on t.lang = c.lang
  join frequent x on x.lang = c.lang and x.phrase = array_to_string(c.w[1 : k], ' ')
  join frequent y on y.lang = c.lang and y.phrase = array_to_string(c.w[k + 1 : c.words], ' ')
), weakest as (select *, row_number() over (partition by lang, phrase order by score, k) as cut from scored
), ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from weakest where cut = 1)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score from ranked where rank <= {limit}
"""
