"""Quality rules with risk-controlled cutoffs.

Each rule compares one statistic of a text with a cutoff. Cutoffs are chosen on labelled holdouts:
for every stratum and rule, cutoffs are tested from the loosest to the tightest by the exact
binomial (Clopper-Pearson) upper bound of the share of good documents that the rule would reject,
and testing stops at the first that isn't shown to be at most ``alpha`` (fixed-sequence testing, so
the grid costs nothing); the error level is divided by the number of strata times rules
(Bonferroni). Of the certified cutoffs, the one that rejects most bad documents for few good ones is
used. Strata whose holdout is too small to certify anything have no cutoff for that rule.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propscan.llm.batches import SPACE, chunks, gram_hashes, released, row_sums, span_hashes, word_spans
from propscan.storage import written

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
#: Rule → statistic in hundredths; larger is worse.
RULES = {
    "symbols": "100 * n_symbols / n_words",
    "dup_lines": "100 * n_dup_lines / n_lines",
    "repeats": "100 * n_repeat_words / n_words",
    "upper": "100 * n_upper / word_chars",
    "marks": "100 * n_marks / n_words",
    "word_length": "10 * word_chars / n_words",
}
GRID = 1000
#: Bytes of text counted together.
CHUNK_BYTES = 1 << 18


def text_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Columns of ``COUNTS`` for each row of a flat batch."""
    starts, ends, first = word_spans(data, off)
    words = span_hashes(data, starts, ends)
    solid = ~SPACE[data]
    sums = lambda m: row_sums(m.astype(np.int64), off)
    line_at = np.unique(np.r_[off[:-1], np.flatnonzero(data == 10) + 1])
    line_at = line_at[line_at < len(data)]
    line_end = np.r_[line_at[1:], len(data)]
    line_end = line_end - ((line_end > line_at) & (data[np.maximum(line_end - 1, 0)] == 10)) if len(line_at) else line_end[:0]
    filled = row_sums(solid.astype(np.int64), np.r_[line_at, len(data)]) > 0 if len(line_at) else np.zeros(0, bool)
    line_at, line_end = line_at[filled], line_end[filled]
    lines = span_hashes(data, line_at, line_end)
    line_first = np.searchsorted(line_at, off)
    grams = gram_hashes(words, 3)
    dup, rep = np.zeros(len(off) - 1, np.int64), np.zeros(len(off) - 1, np.int64)
    for i, (a, b, c, d) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), line_first[:-1].tolist(), line_first[1:].tolist(), strict=True)):
        if d - c > 1:
            dup[i] = d - c - len(np.unique(lines[c:d]))
        if b - a > 3:
            g = grams[a : b - 2]
            order = np.argsort(g)
            same = g[order][1:] == g[order][:-1]
            at = order[np.r_[False, same] | np.r_[same, False]]
            if len(at):
                covered = np.zeros(b - a, bool)
                covered[at] = covered[at + 1] = covered[at + 2] = True
                rep[i] = covered.sum()
    upper = (data >= 65) & (data <= 90) | (np.r_[np.uint8(0), data[:-1]] == 0xC3) & (data >= 0x80) & (data <= 0x9E) if len(data) else np.zeros(0, bool)
    return np.stack([np.diff(first), sums(solid & ((data & 0xC0) != 0x80)), sums(_SYMBOL[data]), dup, rep, np.diff(line_first), sums(upper), sums((data == 33) | (data == 63))], 1)


_COUNTED = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", stratum string"
_COUNTED_ARROW = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("stratum", pa.string())])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [text_counts(data, off) for _, _, data, off in chunks(batch.column(1), CHUNK_BYTES)]
        values = np.concatenate(parts) if parts else np.zeros((0, len(COUNTS)), np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(values[:, i], pa.int64()) for i in range(len(COUNTS))), batch.column(2).cast(pa.string())], schema=_COUNTED_ARROW)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """``doc_id``, the counts and ``stratum`` of each row; a null or empty text has zero counts, a null stratum is empty.

    Repeated rows give equal rows, ids may be null, an empty table gives no rows, other columns are ignored.
    """
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col else F.lit("")
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), stratum).mapInArrow(released(_counted), _COUNTED)


def measured_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """As ``measure``, with the whole row beside it in the struct ``row``; the text isn't shuffled."""
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col else F.lit("")
    rows = docs.select(F.col(id_col).cast("long"), stratum.alias("stratum"), F.struct("*").alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(released(_counted_rows(text_col)), f"{_COUNTED}, row {kind}")


def _counted_rows(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(2)
            text = row.field(row.type.get_field_index(text_col)).cast(pa.string())
            plain = pa.RecordBatch.from_arrays([batch.column(0), text, batch.column(1)], names=["id", "text", "stratum"])
            for counted in _counted(iter([plain])):
                yield pa.RecordBatch.from_arrays([*counted.columns, row], names=[*counted.schema.names, "row"])

    return run


def upper_bound(k: int, n: int, error: float) -> float:
    """Clopper-Pearson upper bound of a share of which ``k`` of ``n`` were seen."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    choose = np.array([math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1) for x in i])
    low, high = k / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        logs = choose + i * math.log(p) + (n - i) * math.log1p(-p) if p < 1 else np.full(k + 1, -np.inf)
        low, high = (p, high) if np.exp(logs).sum() > error else (low, p)
    return high


def certified_losses(n: int, alpha: float, error: float) -> int:
    """Most of ``n`` good documents that a cutoff may reject and still have an ``upper_bound`` of at most ``alpha``; -1 if none."""
    k = np.arange(int(n * alpha) + 1)
    if n == 0:
        return -1
    logs = np.array([math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1) for x in k.tolist()]) + k * math.log(alpha) + (n - k) * math.log1p(-alpha)
    return int(np.searchsorted(np.cumsum(np.exp(logs)), error, "right")) - 1  # the bound is at most alpha where P(X <= k | alpha) <= error


def best_cutoff(bad: np.ndarray, good: np.ndarray, alpha: float, error: float) -> int | None:
    """Largest value kept, from counts by value: the certified cutoff with the best gain, or none."""
    allowed, best = certified_losses(int(good.sum()), alpha, error), None
    for cut in range(GRID, -1, -1):
        lost = int(good[cut + 1 :].sum())
        if lost > allowed:
            break
        gain = int(bad[cut + 1 :].sum()) - 20 * lost
        if gain > 0 and (best is None or gain > best[0]):
            best = (gain, cut)
    if best is None:
        return None
    cut = best[1]  # no value lies between this cut and a looser one that rejects the same rows: take the middle
    higher = np.flatnonzero((good + bad)[cut + 1 :])
    return cut + (int(higher[0]) // 2 if len(higher) else 0)


def _cutoffs(alpha: float, error: float):
    schema = pa.schema([("stratum", pa.string()), ("rule", pa.string()), ("cut", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = []
            for cells in batch.column(2).to_pylist():
                counts = np.zeros((2, GRID + 1), np.int64)
                for c in cells:
                    counts[c["good"], c["bin"]] += c["n"]
                cuts.append(best_cutoff(counts[0], counts[1], alpha, error))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cuts, pa.int32())], schema=schema)

    return run


def _bin(rule: str) -> F.Column:
    return F.coalesce(F.least(F.lit(GRID), F.ceil(F.expr(f"try_divide({RULES[rule].replace(' / ', ', ')})"))).cast("int"), F.lit(0))


def fit_cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = 0.005, error: float = 0.05) -> DataFrame:
    """``stratum, rule, cut``: largest values kept. ``labels``: ``doc_id, quality`` (1 good, 0 bad; others are ignored).

    A label that repeats counts once, the best of differing ones; a row of ``measured`` that repeats counts as often
    as it occurs; rows without an id have no label. Without labels, or an empty table, there are no cutoffs.
    Values beyond ``GRID`` count as ``GRID``, so no cutoff lies beyond it. The result is written.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("good")).where("good in (0, 1)").groupBy("id").agg(F.max("good").alias("good"))
    rows = measured.where("n_words >= 50").join(known, F.col("doc_id") == F.col("id"))
    long = rows.select("stratum", "good", F.explode(F.create_map(*(x for r in RULES for x in (F.lit(r), _bin(r))))).alias("rule", "bin"))
    cells = long.groupBy("stratum", "rule", "good", "bin").agg(F.count("*").alias("n"))
    cells = written(cells.groupBy("stratum", "rule").agg(F.collect_list(F.struct("good", "bin", "n")).alias("cells")), "cells")  # at most 2 x GRID each
    return written(cells.mapInArrow(_cutoffs(alpha, error / max(1, cells.count())), "stratum string, rule string, cut int").where("cut is not null"), "cutoffs")


#: Strata with cutoffs that are broadcast to all rows; more are joined by a shuffle of the rows.
MAX_STRATA = 100_000


def judge(measured: DataFrame, cutoffs: DataFrame, min_words: int = 50, max_repeat: int = 50) -> DataFrame:
    """Add ``base_failed``, ``violated`` (rules broken, comma-separated) and ``kept``.

    Documents without words fail the base rules. A stratum without cutoffs is kept if its base rules hold.
    Repeated rows give equal rows, ids may be null, an empty table gives no rows.
    """
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    cuts = cutoffs.groupBy(F.col("stratum").alias("_stratum")).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cut"))).alias("_cuts"))
    cuts = F.broadcast(cuts) if cutoffs.count() <= MAX_STRATA * len(RULES) else cuts
    rows = measured.join(cuts, measured["stratum"] == F.col("_stratum"), "left")
    violated = F.concat_ws(",", *(F.when(_bin(r) > F.col("_cuts")[r], F.lit(r)) for r in sorted(RULES)))
    rows = rows.withColumns({"base_failed": base, "violated": violated}).drop("_stratum", "_cuts")
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("violated") == ""))
