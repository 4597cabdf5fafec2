"""Toxicity by a counterfactually regularised linear classifier.

Features of a text are its distinct words and word beginnings (3 to 8 letters). The classifier is a
logistic regression with an L1 penalty and one more term: in every labelled sentence that names an
identity group the term is swapped for others of the same kind, and the squared change of the score
is penalised, so that naming a group weighs little by itself. It is fitted on a bounded sample of
labelled rows (``max_rows`` of each label); features are chosen by Spark over that sample. Scoring
covers whole texts of all rows: a word's weight is looked up once per worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of identity terms by language; a term is swapped only for others of its kind. Fixed values.
IDENTITY_TERMS = {
    "religion": ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    "orientation": ["gay", "lesbian", "straight", "bisexual"],
    "origin": ["black", "white", "asian", "african", "european", "immigrant"],
    "gender": ["woman", "man", "women", "men", "transgender"],
    "ability": ["disabled", "blind", "deaf"],
    "religion de": ["muslime", "muslimisch", "christ", "christlich", "jude", "jüdisch", "hindu", "buddhist", "atheist"],
    "orientation de": ["schwul", "lesbisch", "heterosexuell", "bisexuell"],
    "origin de": ["schwarze", "weiße", "asiatisch", "afrikanisch", "europäisch", "türkisch", "einwanderer"],
    "gender de": ["frau", "mann", "frauen", "männer"],
    "ability de": ["behindert", "taub", "gehörlos"],
    "religion es": ["musulmán", "musulmana", "cristiano", "cristiana", "judío", "judía", "hindú", "budista", "ateo"],
    "orientation es": ["gay", "lesbiana", "heterosexual", "bisexual"],
    "origin es": ["negro", "blanco", "asiático", "africano", "europeo", "inmigrante", "gitano"],
    "gender es": ["mujer", "hombre", "mujeres", "hombres", "transgénero"],
    "ability es": ["discapacitado", "ciego", "sordo"],
    "religion fr": ["musulman", "musulmane", "chrétien", "chrétienne", "juif", "juive", "hindou", "bouddhiste", "athée"],
    "orientation fr": ["gay", "lesbienne", "hétérosexuel", "bisexuel"],
    "origin fr": ["noir", "blanc", "asiatique", "africain", "européen", "immigré", "arabe"],
    "gender fr": ["femme", "homme", "femmes", "hommes", "transgenre"],
    "ability fr": ["handicapé", "aveugle", "sourd"],
}
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def word_features(word: str) -> list[str]:
    """The word and its beginnings."""
    return ["=" + word, *(word[:k] for k in range(3, 9) if len(word) >= k)]


def text_words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def counterfactual_changes(text: str | None, terms: dict[str, list[str]]) -> list[tuple[set[str], set[str]]]:
    """Swaps of an identity term for another of its kind, in sentences that don't name both: words added and removed.

    Each swap counts once a text, so their number is bounded by ``terms`` whatever the text's length.
    """
    others: dict[str, set[str]] = {}
    for group in terms.values():
        for t in group:
            others.setdefault(t, set()).update(x for x in group if x != t)
    found = set()
    for sentence in _SENTENCE.split((text or "").lower()):
        words = set(_WORD.findall(sentence))
        found |= {(other, t) for t in words & others.keys() for other in others[t] - words}
    return [({other}, {t}) for other, t in sorted(found)]


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, total: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -40, 40)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("label", pa.int32()), ("feature", pa.string()), ("n", pa.int64())])
    for batch in batches:
        counts: dict[tuple[int, str], int] = {}
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for f in {f for w in text_words(text) for f in word_features(w)}:
                counts[label, f] = counts.get((label, f), 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.int32()), pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)


def _examples(chosen: dict[str, int], terms: dict[str, list[str]]):
    """Feature numbers of each text, and of each counterfactual's added and removed words."""
    schema = pa.schema([("label", pa.int32()), ("kind", pa.int32()), ("plus", pa.list_(pa.int32())), ("minus", pa.list_(pa.int32()))])

    def numbers(words: set[str]) -> list[int]:
        return sorted({chosen[f] for w in words for f in word_features(w) if f in chosen})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows.append((label, 0, numbers(text_words(text)), []))
                rows += [(label, 1, numbers(a), numbers(b)) for a, b in counterfactual_changes(text, terms)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(schema.types)], schema=schema)

    return run


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", terms: dict[str, list[str]] | None = None,
    max_rows: int = 4000, n_features: int = 6000, l1: float = 1e-4, fairness: float = 1.0, steps: int = 800,
) -> Model:
    """Fit on at most about ``max_rows`` rows of each label (0 and 1; others are ignored), chosen by a hash of the id.

    ``labels``: ids and labels; the chosen ones, at most about ``2 * max_rows`` rows, are broadcast to the texts of
    ``docs``, which are not shuffled. Without rows of both labels the model scores the share of label 1 (0
    without any row).
    """
    from propscan.storage import written

    terms = IDENTITY_TERMS if terms is None else terms
    known = labels.select(F.col(id_col).cast("string").alias("id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1) and id is not null").groupBy("id").agg(F.max("label").alias("label"))
    share = {r.label: max_rows / r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if set(share) != {0, 1}:
        return Model({}, 40.0 if 1 in share else -40.0)
    cut = F.when(F.col("label") == 1, F.lit(share[1])).otherwise(F.lit(share[0]))
    chosen_ids = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < cut * 1_000_000)
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = written(rows.join(F.broadcast(chosen_ids), "id").select("label", "text"), "toxic-sample")
    size = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    counts = sample.mapInArrow(_features, "label int, feature string, n long").groupBy("feature").agg(F.sum(F.expr("if(label = 1, n, 0)")).alias("a"), F.sum(F.expr("if(label = 0, n, 0)")).alias("b"))
    p, q = F.col("a") / max(1, n1), F.col("b") / max(1, n0)
    best = counts.where("a + b >= 3").select("feature", (F.abs(p - q) / F.sqrt(p + q + 0.002)).alias("gain"))
    best = best.where(F.col("gain") * float(np.sqrt(min(n0, n1))) >= 3).orderBy(F.desc("gain"), "feature").limit(n_features)
    names = {t for group in terms.values() for t in group}
    chosen = {f: i for i, f in enumerate(sorted({r.feature for r in best.collect()} | {"=" + t for t in names}))}
    data = sample.mapInArrow(_examples(chosen, terms), "label int, kind int, plus array<int>, minus array<int>").toArrow()
    kind, label = data["kind"].to_numpy(), data["label"].to_numpy()
    x = _Sparse(data["plus"].filter(pa.array(kind == 0)), len(chosen))
    y = label[kind == 0].astype(float)
    plus, minus = (_Sparse(data[c].filter(pa.array(kind == 1)), len(chosen)) for c in ("plus", "minus"))
    weight = np.where(y == 1, 0.5 / max(1, n1), 0.5 / max(1, n0))
    w, bias, momentum = np.zeros(len(chosen)), 0.0, 1.0
    v, vb = w.copy(), bias
    lipschitz = 0.25 * float((weight * (x.lengths + 1)).sum()) + 2 * fairness * 40 * (plus.rows > 0)
    rate = 1.0 / max(lipschitz, 1e-9)
    for _ in range(steps):  # accelerated proximal gradient
        error = weight * (1 / (1 + np.exp(-np.clip(x.dot(v) + vb, -40, 40))) - y)
        gradient = x.sums(error)
        if plus.rows:
            change = 2 * fairness * (plus.dot(v) - minus.dot(v)) / plus.rows
            gradient += plus.sums(change) - minus.sums(change)
        new = v - rate * gradient
        new = np.sign(new) * np.maximum(np.abs(new) - rate * l1, 0)
        new_bias = vb - rate * error.sum()
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        v, vb = new + (momentum - 1) / after * (new - w), new_bias + (momentum - 1) / after * (new_bias - bias)
        w, bias, momentum = new, new_bias, after
    return Model({f: float(w[i]) for f, i in chosen.items() if w[i]}, float(bias))


class _Sparse:
    """Rows of feature numbers, each with value 1."""

    def __init__(self, lists: pa.ChunkedArray, width: int):
        lists = lists.combine_chunks()
        self.width, self.rows = width, len(lists)
        self.lengths = np.array([len(x) for x in lists.to_pylist()], np.int64)
        self.row = np.repeat(np.arange(self.rows), self.lengths)
        self.col = np.asarray(lists.flatten(), np.int64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.rows) if self.rows else np.zeros(0)

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, values[self.row], self.width) if self.rows else np.zeros(self.width)


def _scored(model: Model):
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    # Features whose words can carry weight, by their first three letters: other words weigh nothing.
    stems = {f.removeprefix("=")[:3] for f in model.weights}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[str, ...]] = {}  # token → its features that have a weight
        for batch in batches:
            totals = []
            for text in batch.column(1).to_pylist():
                seen: set[str] = set()
                for token in set((text or "").lower().split()):
                    found = known.get(token)
                    if found is None:
                        if len(known) > 400_000:
                            known.clear()
                        found = known[token] = tuple(f for w in _WORD.findall(token) if w[:3] in stems for f in word_features(w) if f in model.weights)
                    if found:
                        seen.update(found)
                totals.append(sum(model.weights[f] for f in sorted(seen)))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(model.score(np.array(totals, float)), pa.float64())], schema=schema)

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """Return ``doc_id, score, predicted`` for each row; ``predicted`` is 1 from ``threshold`` on.

    Null and empty texts get the model's base score. Repeated rows give equal rows, ids may be null,
    an empty table gives no rows, other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scored(model), "doc_id long, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def learned_rows(id_col: str = "doc_id") -> Column:
    """The rows that may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 != 1, F.lit(False))
