"""Alignment of two tokenizers: where tokens of a byte-level BPE (A) and of a sentencepiece BPE (B) end together.

Both encode a space and the text. A's character offsets and B's proto spans are the coarse cuts; where a character has
several bytes or a token is a byte fallback, the decoded bytes of the tokens say how many bytes each of them holds.
Byte places where an A token and a B token both end cut the tokens into groups, and the two tokens that end at such a
place are linked.

A text is cut into units: before a blank or line feed behind a visible character, and between an ASCII letter and an
ASCII mark. A begins a token there, and no piece of B goes on over such a place (``cuts_hold`` looks through its
vocabulary; where a piece does, letters and marks stay together). Units are encoded once, many at a time, and kept; a
document is the sequence of its units.

Links of documents are written, then counted over the corpus, then looked up. Linked tokens end at the same byte and
neither begins outside the text, so one's bytes end with the other's: there are at most as many pairs of ids as both
vocabularies have bytes (``pair_bound``, about 600,000), and only so many counts reach the driver and are broadcast, at
any corpus size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propscan.llm.batches import released, slices
from propscan.storage import removed, written

#: Units that a worker keeps (beyond, those that came once are forgotten), and characters that are encoded together.
UNITS, ENCODED = 300_000, 1 << 16
_SPACE = "▁"
_BAD = -1
#: What stands before units that are encoded together, and before those that begin with a mark.
_FILLER = " a"
_MARKS = r"!-/:-@\[-`{-~"
#: White space other than blank and line feed (and what a tokenizer might take for it): no unit ends behind it.
_ODD = r"\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"
_BLANK_ENDS = frozenset(c for c in map(chr, range(0x10000)) if re.match(rf"[ \n{_ODD}]", c))
_ANY = rf"(?:[^ \n]|(?<=[{_ODD}])[ \n])"
_UNIT = re.compile(rf"[ \n]*(?:[A-Za-z]+(?=[ \n{_MARKS}]|$)|{_ANY}*?[A-Za-z](?=[{_MARKS}])|{_ANY}+)|[ \n]+")
_COARSE_UNIT = re.compile(rf"[ \n]*{_ANY}+|[ \n]+")


@cache
def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary entry stands for (fixed values): printable ones stand
    for themselves, the others for code points from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


@cache
def tokenizers(a_file: str, b_file: str):
    """Both tokenizers of a worker, and the bytes of each id."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(a_file), sentencepiece.SentencePieceProcessor(model_file=b_file)
    a.encode_special_tokens = True
    byte = byte_alphabet()
    a_bytes = {i: bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t, i in a.get_vocab().items()}
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(_SPACE, " ").encode() for i in range(b.get_piece_size()) for p in [b.id_to_piece(i)]]
    return a, b, [a_bytes.get(i, b"") for i in range(max(a_bytes) + 1)], b_bytes


def pair_bound(a_file: str, b_file: str) -> int:
    """No more pairs of ids than this can be linked: one's bytes are an ending of the other's."""
    _, _, a, b = tokenizers(a_file, b_file)
    return sum(map(len, a)) + sum(map(len, b))


@cache
def cuts_hold(b_file: str) -> bool:
    """Whether no piece of B has a letter before a mark. Raises if one has a blank or line feed behind another character."""
    import sentencepiece

    b = sentencepiece.SentencePieceProcessor(model_file=b_file)
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size()) if not (b.is_byte(i) or b.is_control(i) or b.is_unknown(i))]
    if any(_SPACE in p.lstrip(_SPACE) or "\n" in p or " " in p for p in pieces):
        raise ValueError("pieces go on over blanks; texts can't be cut there")
    return not any(re.search(rf"[A-Za-z][{_MARKS}]", p) for p in pieces)


class Aligner:
    """Units of texts with their tokens, groups and links."""

    def __init__(self, a_file: str, b_file: str):
        self.a, self.b, self.a_bytes, self.b_bytes = tokenizers(a_file, b_file)
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.b_byte = np.array([self.b.is_byte(i) for i in range(len(self.b_bytes))])
        self.unit = _UNIT if cuts_hold(b_file) else _COARSE_UNIT
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.totals = np.zeros((0, 2), np.int64)  # of a unit: tokens of A and B
        self.ends, self.links, self.first, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)

    def trim(self) -> None:
        """Keep units that came twice and more since the last time, the most used ones and half of ``UNITS`` at most."""
        order = np.argsort(-self.uses, kind="stable")[: UNITS // 2]
        kept = np.sort(order[self.uses[order] > 1])
        new = np.full(len(self.groups) + 1, _BAD)
        new[kept] = np.arange(len(kept))
        n = np.diff(self.first)
        own = np.zeros(len(n), bool)
        own[kept] = True
        held = np.repeat(own, n)
        self.number = {u: int(new[k]) for u, k in self.number.items() if k >= 0 and new[k] >= 0}
        self.groups = [self.groups[k] for k in kept.tolist()]
        self.totals, self.size, self.uses = self.totals[kept], self.size[kept], np.zeros(len(kept), np.int64)
        self.ends, self.links, self.first = self.ends[held], self.links[held], np.r_[0, np.cumsum(n[kept])]

    def _byte_ends(self, text: str, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of A and the places where they end, then those of B; None if a tokenizer's bytes aren't the text's.

        ``text`` begins with a blank, which B adds itself.
        """
        found = self.a.encode(text, add_special_tokens=False)
        a_ids, a_chars = np.array(found.ids, np.int64), found.offsets
        proto = self.b.encode(text[1:], return_type="proto").pieces
        b_ids, b_ends = np.array([p.id for p in proto], np.int64), np.array([p.end for p in proto], np.int64) + 1
        if b"".join(map(self.a_bytes.__getitem__, a_ids.tolist())) != data or b"".join(map(self.b_bytes.__getitem__, b_ids.tolist())) != data:
            return None
        a_ends = np.array([e for _, e in a_chars], np.int64)
        if len(data) == len(text):  # a character is a byte, offsets and spans are byte places
            return a_ids, a_ends, b_ids, b_ends
        at = np.r_[np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80), len(data)]  # characters' first bytes
        a_open = np.r_[np.array([b for b, _ in a_chars[1:]], np.int64) < a_ends[:-1], False]  # the next token has a part of the same character
        b_open = self.b_byte[b_ids] & (np.array([p.begin for p in proto], np.int64) + 1 == b_ends)  # of a character's fallbacks the last has its span
        return a_ids, self._refined(at[a_ends], self.a_size[a_ids], a_open), b_ids, self._refined(b_ends, self.b_size[b_ids], b_open)

    @staticmethod
    def _refined(coarse: np.ndarray, size: np.ndarray, within: np.ndarray) -> np.ndarray:
        """Places where tokens end: coarse cuts, and ``within`` a character as many bytes behind the last cut as were decoded."""
        total = np.cumsum(size)
        last = np.maximum.accumulate(np.where(within, -1, np.arange(len(size))))
        behind = total - np.where(last < 0, 0, total[last])
        return np.where(within, np.where(last < 0, 0, coarse[last]) + behind, coarse)

    def _learn(self, units: list[str]) -> None:
        """Encode units together, as they are cut apart anyway; where that fails, in halves."""
        shown = [_FILLER]  # units as they stand in the text, with fillers
        for u in units:
            if u[0] not in " \n":
                shown.append(_FILLER)
            shown.append(u)
        text = "".join(shown)
        data = text.encode()
        found = None if _SPACE in text else self._byte_ends(text, data)
        if found is None:
            if len(units) > 1:
                self._learn(units[: len(units) // 2])
                self._learn(units[len(units) // 2 :])
            else:
                self.number[units[0]] = _BAD
            return
        a_ids, a_ends, b_ids, b_ends = found
        size = np.array([len(u.encode()) for u in shown] if len(text) < len(data) else [len(u) for u in shown], np.int64)
        stop = np.cumsum(size)
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_stop, b_stop = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
        own = np.ones(len(shown), bool)  # not a filler
        own[0] = False
        own[np.flatnonzero([u[0] not in " \n" for u in shown]) - 1] = False
        upto = np.searchsorted(cuts, stop, "right")  # groups up to a unit's end
        at = np.r_[0, upto]
        a_text, b_text = list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist()))
        texts, i, j = [], 0, 0
        for x, y in zip(a_stop.tolist(), b_stop.tolist(), strict=True):
            texts.append((a_text[x] if x == i else ",".join(a_text[i : x + 1])) + "|" + (b_text[y] if y == j else ",".join(b_text[j : y + 1])))
            i, j = x + 1, y + 1
        counted = np.column_stack([np.diff(np.r_[0, np.searchsorted(e, stop, "right")]) for e in (a_ends, b_ends)])
        begin = len(self.groups)
        self.number.update(zip(units, range(begin, begin + len(units)), strict=True))
        mine = np.flatnonzero(own)
        self.groups += [";".join(texts[i:j]) for i, j in zip(at[mine].tolist(), upto[mine].tolist(), strict=True)]
        held = np.repeat(own, np.diff(at))
        self.totals = np.concatenate([self.totals, counted[own]])
        self.ends = np.concatenate([self.ends, (cuts - np.repeat(stop - size, np.diff(at)))[held].astype(np.int32)])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.diff(at)[own])])
        self.links = np.concatenate([self.links, (a_ids[a_stop] * len(self.b_bytes) + b_ids[b_stop])[held]])
        self.size = np.concatenate([self.size, size[own]])

    def learn(self, new: list[str]) -> None:
        """Encode units that aren't kept yet; one that ends with white space ends a text and is encoded alone."""
        units, size = [], 0
        for u in new:
            if u[-1] in _BLANK_ENDS:
                self._learn([u])
                continue
            units.append(u)
            size += len(u)
            if size >= ENCODED:
                self._learn(units)
                units, size = [], 0
        if units:
            self._learn(units)

    def texts(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Numbers of each text's units; None for a text without tokens."""
        if len(self.groups) > UNITS:
            self.trim()
        units = [self.unit.findall(" " + t) if t else [] for t in texts]
        number = self.number
        self.learn(list(dict.fromkeys(u for own in units for u in own if u not in number)))
        found = [np.fromiter(map(number.__getitem__, own), np.int64, len(own)) for own in units]
        found = [n if len(n) and n.min() >= 0 else None for n in found]
        used = [n for n in found if n is not None]
        times = np.bincount(np.concatenate(used), minlength=len(self.groups)) if used else np.zeros(len(self.groups), np.int64)
        times[: len(self.uses)] += self.uses
        self.uses = times
        return found

    def _places(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of a document's groups in ``ends`` and ``links``, and how many each unit has."""
        k = self.first[n + 1] - self.first[n]
        return np.repeat(self.first[n] - (np.cumsum(k) - k), k) + np.arange(k.sum()), k

    def document(self, n: np.ndarray | None) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """A document's alignment, ends of groups, links and numbers of tokens."""
        if n is None:
            return "", np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(2, np.int64)
        place, k = self._places(n)
        size = self.size[n]
        return ";".join(map(self.groups.__getitem__, n.tolist())), self.ends[place] + np.repeat((np.cumsum(size) - size).astype(np.int32), k), self.links[place], self.totals[n].sum(0)


_KEPT: dict = {}


def _aligner(a_file: str, b_file: str) -> Aligner:
    """A worker's aligner, kept between tasks."""
    if (a_file, b_file) not in _KEPT:
        _KEPT.clear()
        _KEPT[a_file, b_file] = Aligner(a_file, b_file)
    return _KEPT[a_file, b_file]


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    off = np.r_[0, np.cumsum([len(x) for x in rows])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate([np.zeros(0, np.int64), *rows]), kind))


def _aligning(a_file: str, b_file: str, link: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _aligner(a_file, b_file)
        for batch in batches:
            for part in slices(batch, 1):
                notes, ends, links, totals = zip(*map(own.document, own.texts(part.column(1).to_pylist())), strict=True)
                n_a, n_b = (pa.array([t[k] for t in totals], pa.int64()) for k in (0, 1))
                yield pa.record_batch({"doc_id": part.column(0), "n_a": n_a, "n_b": n_b, "alignment": pa.array(notes, pa.string()), "ends": _lists(ends, pa.int32()), "links": _lists(links, link)})

    return released(run)


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        found, n = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
        codes, back = np.unique(np.r_[codes, found], return_inverse=True)
        sums = np.bincount(back, np.r_[sums, n], len(codes)).astype(np.int64)
    yield pa.record_batch({"code": pa.array(codes), "n": pa.array(sums)})


def _looking_up(counts, places: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, best = counts.value
        for batch in batches:
            links = batch.column(places)
            at = np.searchsorted(codes, links.flatten().to_numpy())
            off = np.r_[0, np.cumsum(links.value_lengths().to_numpy())]
            sums = [np.r_[0, np.cumsum(v[at])][off] for v in (best, n)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:places], *(pa.array(np.diff(v), pa.int64()) for v in sums)], names=[*batch.schema.names[:places], "n_best", "count_sum"])

    return released(run)


def align(docs: DataFrame, a_file: str, b_file: str, keep: dict[str, Column] | None = None) -> DataFrame:
    """Tokens of every text in both vocabularies and where they end together.

    Returns for each row of ``docs``: ``doc_id``, numbers of tokens ``n_a, n_b`` and of links ``n_links``, then the columns
    of ``keep``; ``n_best``, its links whose ids are linked in the corpus at least as often as any other id with that B
    id; ``count_sum``, the sum of its links' corpus counts. ``keep`` names columns over ``alignment``, the groups as
    ``a1,a2|b1;a3|b2,b3``, and ``ends``, the byte places in space and text where groups end; by default both are kept.
    A null or empty text, and one whose tokens don't spell it (U+2581 is a blank to B), have no tokens: zeros, an empty
    alignment and no ends. Rows repeat as they do in ``docs``, an id may be null, an empty table gives an empty result,
    other columns are ignored. Texts are read once; what is kept and the links are written to the shared folder.
    """
    spark = docs.sparkSession
    _, _, a_bytes, b_bytes = tokenizers(a_file, b_file)
    small = len(a_bytes) * len(b_bytes) < 2**31
    keep = {"alignment": F.col("alignment"), "ends": F.col("ends")} if keep is None else keep
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    raw = rows.mapInArrow(_aligning(a_file, b_file, pa.int32() if small else pa.int64()), f"doc_id long, n_a long, n_b long, alignment string, ends array<int>, links array<{'int' if small else 'long'}>")
    table = written(raw.select("doc_id", "n_a", "n_b", F.size("links").cast("long").alias("n_links"), *[c.alias(n) for n, c in keep.items()], "links"), "aligned")

    sums = written(table.select("links").mapInArrow(released(_counting), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "link-counts")
    found = sums.toArrow()
    removed(spark, sums)
    if found.num_rows > pair_bound(a_file, b_file):
        raise RuntimeError("more linked pairs than the vocabularies allow")
    codes, n = (found.column(k).to_numpy().astype(np.int64) for k in ("code", "n"))
    most = np.zeros(len(b_bytes), np.int64)
    np.maximum.at(most, codes % len(b_bytes), n)
    order = np.argsort(codes)
    counts = spark.sparkContext.broadcast((codes[order], n[order], (n == most[codes % len(b_bytes)])[order].astype(np.int64)))
    schema = table.drop("links").schema.add("n_best", "long").add("count_sum", "long")
    return table.mapInArrow(_looking_up(counts, len(table.columns) - 1), schema)
