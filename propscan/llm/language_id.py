"""Language ID by interpolated Kneser-Ney character models.

One model a language: discounted n-gram probabilities and back-off weights of each order in sorted
hash arrays. A text gets the language with the lowest cross-entropy a character; a conformal cut on
a calibration fold tells which texts fit no model. The models are fitted on a bounded sample of
labelled rows (``docs_per_lang``); counting runs in Spark and what is collected is bounded by that
sample. Each language's frequent letters have symbols of their own. Scoring covers whole texts of all
rows: a text becomes n-gram codes, each distinct code of the ``CACHED`` most frequent symbols is
resolved in the hash arrays once per worker and kept in a direct table, others once a slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propscan.llm.batches import mix, released, row_sums, slices
from propscan.storage import written

ALPHABET, CACHED, ORDER = 4096, 48, 4
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """1 for letters of any script, else 0, by code point."""
    return np.array([chr(c).isalpha() for c in range(0x110000)], np.uint8)


def letter_codes(texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram codes of all texts, the rows' first codes, and letters a row. Other characters are one gap."""
    low = [(t or "").lower() for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    off = np.r_[0, np.cumsum([len(t) for t in low])]
    ids = table[points]
    keep = ids > 0
    gap = ~keep
    gap[1:] &= keep[:-1]  # the first of a run of others
    first_at = off[:-1][off[:-1] < len(ids)]
    gap[first_at] = False
    letters = row_sums(keep.astype(np.int64), off)
    keep |= gap
    first = np.r_[0, np.cumsum(row_sums(keep.astype(np.int64), off))]
    ids = ids[keep].astype(np.int64)
    at = np.arange(len(ids)) - np.repeat(first[:-1], np.diff(first))
    code = ids.copy()
    for j in range(1, ORDER):
        before = np.zeros_like(ids)
        before[j:] = ids[:-j]
        before[at < j] = 0
        code += before * ALPHABET**j
    return code, first, letters


@dataclass
class Model:
    """Models of several languages; ``grams`` and ``contexts``: per language and order, sorted hashes and values."""

    table: np.ndarray  # code point → symbol
    langs: list[str]
    grams: list[list[tuple[np.ndarray, np.ndarray]]]
    contexts: list[list[tuple[np.ndarray, np.ndarray]]]
    center: np.ndarray = field(default_factory=lambda: np.zeros(0))  # usual cross-entropy a language
    limit: np.ndarray = field(default_factory=lambda: np.zeros(0))  # rejected beyond

    def log_prob(self, lang: int, codes: np.ndarray) -> np.ndarray:
        p = np.full(len(codes), 1 / ALPHABET)
        for k in range(1, ORDER + 1):
            gram = codes % ALPHABET**k
            weight = _found(self.contexts[lang][k - 1], gram // ALPHABET, 1.0)
            p = _found(self.grams[lang][k - 1], gram, 0.0) + weight * p
        return np.log(p)


def _short(codes: np.ndarray) -> np.ndarray:
    """Place in the direct table of codes whose symbols are all below ``CACHED``, else -1."""
    place, rare = np.zeros_like(codes), np.zeros(len(codes), bool)
    for j in range(ORDER):
        symbol = codes // ALPHABET**j % ALPHABET
        rare |= symbol >= CACHED
        place += symbol * CACHED**j
    return np.where(rare, -1, place)


def _found(pair: tuple[np.ndarray, np.ndarray], codes: np.ndarray, missing: float) -> np.ndarray:
    hashes, values = pair
    if not len(hashes):
        return np.full(len(codes), missing)
    h = mix(codes.astype(np.uint64))
    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    return np.where(hashes[at] == h, values[at], missing)


def _by_hash(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(codes.astype(np.uint64))
    order = np.argsort(h)
    return h[order], values[order]


def kneser_ney(codes: np.ndarray, counts: np.ndarray) -> tuple[list, list]:
    """Sorted hash arrays of all orders from the counts of the highest."""
    grams, contexts = [], []
    for k in range(ORDER, 0, -1):
        ones, twos = (counts == 1).sum(), (counts == 2).sum()
        discount = min(0.95, max(0.1, ones / max(1, ones + 2 * twos)))
        context, at = np.unique(codes // ALPHABET, return_inverse=True)
        total, kinds = np.bincount(at, counts, len(context)), np.bincount(at, minlength=len(context))
        grams.append(_by_hash(codes, (counts - discount).clip(0) / total[at]))
        contexts.append(_by_hash(context, discount * kinds / total))
        codes, counts = np.unique(codes % ALPHABET ** (k - 1), return_counts=True)  # in how many contexts each occurs
    return grams[::-1], contexts[::-1]


def _counted(kind: str, table: np.ndarray | None):
    schema = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in dict.fromkeys(langs):
                own = [t for g, t in zip(langs, texts, strict=True) if g == lang]
                codes = np.frombuffer("".join((t or "").lower() for t in own).encode("utf-32-le", "surrogatepass"), np.uint32) if kind == "chars" else letter_codes(own, table)[0]
                codes = codes[_letters()[codes] > 0] if kind == "chars" else codes
                values, n = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(values, pa.int64()), pa.array(n, pa.int64())], schema=schema)

    return run


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = 3000, reject: float = 0.0005, max_langs: int = 1000) -> Model:
    """Fit on about 0.8 times ``docs_per_lang`` rows of each language, chosen by a hash of the id. Twice ``1 / reject``
    other rows calibrate the rejection, so that about ``reject`` of texts of the learned languages are rejected. A
    language with too few rows for both learns from half of them; ``n`` texts support no share below ``1 / (n + 1)``, so with
    fewer than ``1 / reject`` the cut is at the strangest of them.
    The ``max_langs`` languages with most rows are learned; their shares, one row a language, are broadcast. Rows without
    a language or text are ignored, repeated rows count as often as they occur; no labelled row at all gives a model that
    knows no language."""
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null and text is not null")
    own, calibrate = 0.8 * docs_per_lang, float(np.ceil(2 / reject))
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).withColumn("share", F.lit(own + calibrate) / F.col("count"))
    sizes = sizes.withColumn("aside", F.least(calibrate / F.least(F.col("count"), F.lit(own + calibrate)), F.greatest(F.lit(0.5), 1 - own / F.col("count")))).select("lang", "share", "aside")
    part = lambda h: F.pmod(h, F.lit(1_000_000))
    sample = rows.join(F.broadcast(sizes), "lang").where(part(F.xxhash64("id")) < F.col("share") * 1_000_000)
    sample = written(sample.withColumn("fold", (part(F.hash("id")) >= F.col("aside") * 1_000_000).cast("int")).select("lang", "text", "fold"), "lang-sample")
    learn = sample.where("fold > 0").select("lang", "text")
    chars = learn.mapInArrow(released(_counted("chars", None)), "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    chars = chars.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))).groupBy("code").agg(F.min("place").alias("place"), F.sum("n").alias("n"))
    best = chars.orderBy("place", F.desc("n"), "code").limit(ALPHABET - 2).collect()  # each language's frequent letters first
    table = _letters().astype(np.uint16)
    table[[r.code for r in sorted(best, key=lambda r: (-r.n, r.code))]] = np.arange(2, len(best) + 2)
    counts = learn.mapInArrow(released(_counted("grams", table)), "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()
    langs, fitted = sorted(pc.unique(counts["lang"]).to_pylist()), []
    for g in langs:
        of = counts.filter(pc.equal(counts["lang"], g)).sort_by("code")
        fitted.append(kneser_ney(of["code"].to_numpy(), of["n"].to_numpy()))
    model = Model(table, langs, [f[0] for f in fitted], [f[1] for f in fitted])
    model.center, model.limit = np.zeros(len(langs)), np.full(len(langs), np.inf)
    if langs:
        held = sample.where("fold = 0").select(F.lit(0).cast("long"), "text", "lang").mapInArrow(released(_scored(model)), _OUT).where("lang_pred = own and letters > 0")
        values: dict[str, list] = {}
        for r in held.select("lang_pred", "entropy", "letters").collect():  # about 2 / reject a language at most
            values.setdefault(r.lang_pred, []).append((r.entropy, r.letters))
        for i, g in enumerate(langs):
            if g in values:
                e, n = np.array(values[g]).T
                model.center[i] = np.median(e)
                s = np.sort(_strange(e, n, model.center[i]))
                rank = min(len(s), int(np.ceil((1 - reject) * (len(s) + 1))))
                model.limit[i] = s[rank - 1]
    return model


def _strange(entropy, letters, center):
    return (entropy - center) * np.minimum(1, np.sqrt(letters / 200))


_OUT = "doc_id long, lang_pred string, score double, entropy double, letters long, rejected boolean, own string"
_OUT_ARROW = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("entropy", pa.float64()), ("letters", pa.int64()), ("rejected", pa.bool_()), ("own", pa.string())])


def accepted(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that aren't rejected, with all their columns; the text isn't shuffled."""
    rows = docs.select(F.struct("*").alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(released(_kept(model, text_col)), f"rejected boolean, row {kind}").where("not rejected").select("row.*")


def _kept(model: Model, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def texts() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row = batch.column(0)
                text = row.field(row.type.get_field_index(text_col)).cast(pa.string())
                whole = pa.RecordBatch.from_arrays([pa.nulls(len(row), pa.int64()), text, row], names=["id", "text", "row"])
                for part in slices(whole, 1):
                    held.append(part)
                    yield part.select([0, 1])

        for scored in _scored(model)(texts()):  # one batch for each part
            yield pa.RecordBatch.from_arrays([scored.column(5), held.pop().column(2)], names=["rejected", "row"])

    return run


def _scored(model: Model):
    def resolved(codes: np.ndarray) -> np.ndarray:
        return np.stack([model.log_prob(i, codes) for i in range(len(model.langs))], 1).astype(np.float32) if model.langs else np.zeros((len(codes), 0), np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.full(CACHED**ORDER, -1, np.int32)
        values = np.zeros((0, len(model.langs)), np.float32)
        names = np.array([*model.langs, UNKNOWN], object)
        for batch in batches:
            for part in slices(batch, 1):
                code, first, letters = letter_codes(part.column(1).to_pylist(), model.table)
                at = _short(code)
                near = at >= 0
                rows = np.where(near, kept[at], 0)
                new = np.unique(code[rows < 0])
                if len(new):
                    kept[_short(new)] = np.arange(len(values), len(values) + len(new))
                    values = np.concatenate([values, resolved(new)])
                    rows = np.where(near, kept[at], 0)
                known = values
                if not near.all():
                    rare, place = np.unique(code[~near], return_inverse=True)
                    rows[~near] = len(values) + place
                    known = np.concatenate([values, resolved(rare)])
                n = np.diff(first)
                total = np.stack([row_sums(known[rows, i].astype(np.float64), first) for i in range(len(model.langs))], 1) if model.langs else np.zeros((len(n), 1))
                mean = total / np.maximum(n, 1)[:, None]
                best = mean.argmax(1)
                score = 1 / np.exp((mean - mean.max(1, keepdims=True)) * np.sqrt(np.maximum(n, 1))[:, None] * 2).sum(1)
                blank = (letters == 0) | (not model.langs)
                entropy = -mean.max(1)
                strange = np.zeros(len(n), bool) if not model.langs else _strange(entropy, letters, model.center[best]) > (model.limit[best] if len(model.limit) else np.inf)
                best = np.where(blank, len(model.langs), best)
                arrays = [part.column(0), names[best], np.where(blank, 0.0, score), np.where(blank, np.nan, entropy), letters, blank | strange]
                own = part.column(2) if part.num_columns > 2 else pa.nulls(len(part), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(a, t) if not isinstance(a, pa.Array) else a.cast(t) for a, t in zip([*arrays, own], _OUT_ARROW.types, strict=True)], schema=_OUT_ARROW)

    return run


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return ``doc_id, lang_pred, score, entropy, letters, rejected`` for each row.

    ``und``, score 0 and rejected: texts that are null or have no letter. ``rejected`` is also set
    where no learned language fits (``lang_pred`` is then the nearest). Repeated rows give equal
    rows, ids may be null, an empty table gives no rows, other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(released(_scored(model)), _OUT).drop("own")


def learned_rows(id_col: str = "doc_id") -> Column:
    """The rows that may be learned from: crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 != 2, F.lit(False))
