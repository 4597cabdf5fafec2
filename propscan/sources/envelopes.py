"""Large snapshot envelopes ``{generated_at, total, listings: {key: record}}`` read by byte ranges.

Spark's text reader splits a file at closing braces, so many tasks read one document, from any file system. A first pass tells
of each range, for both cases (it begins inside a string or not), whether it ends inside one and how many levels deeper
it ends; these few numbers, added along the file, say where each range begins. A second pass cuts ranges into the entries
of the document's first two levels; entries that go on over ranges are put together from their parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propscan.sources.snapshots import current_files, of_files
from propscan.storage import written

_ESCAPED = re.compile(rb"\\.", re.DOTALL)
_STEP = np.zeros(256, np.int64)
_STEP[[ord("{"), ord("[")]], _STEP[[ord("}"), ord("]")]] = 1, -1
_STRUCTURE = _STEP != 0
_STRUCTURE[ord(",")] = True
_SEGMENTS = "file string, block long, seq long, level int, part int, text string"


def _outside(data: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of structure outside strings, the bytes there, and whether ``data`` ends inside a string. It begins behind a brace, so
    not within an escape."""
    raw = np.frombuffer(_ESCAPED.sub(b"__", data) if b"\\" in data else data, np.uint8)
    quotes = np.flatnonzero(raw == 34)
    at = np.flatnonzero(_STRUCTURE[raw])
    at = at[(np.searchsorted(quotes, at) + inside) % 2 == 0]
    return at, raw[at], bool((len(quotes) + inside) % 2)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """Bytes of each range in order, some rows at a time; the reader has cut them at closing braces."""
    for batch in batches:
        files, blocks = batch.column(1).to_pylist(), np.array(batch.column(2))
        cuts = np.r_[0, np.flatnonzero((blocks[1:] != blocks[:-1]) | (np.array(files[1:], object) != np.array(files[:-1], object))) + 1, len(files)] if len(files) else [0]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            for k in range(i, j, 4096):
                yield files[i], int(blocks[i]), b"".join(v.encode() + b"}" for v in batch.column(0).slice(k, min(4096, j - k)).to_pylist())


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``file, block, flips, deeper_out, deeper_in``: of a range that begins outside or inside a string."""
    held: dict[tuple[str, int], list] = {}
    for file, block, data in _chunks(batches):
        s = held.setdefault((file, block), [False, True, 0, 0])
        for case in (0, 1):
            _, kinds, s[case] = _outside(data, s[case])
            s[2 + case] += int(_STEP[kinds].sum())
    rows = [(f, b, int(s[0]), s[2], s[3]) for (f, b), s in held.items()]
    yield pa.record_batch([pa.array([r[k] for r in rows], pa.string() if k == 0 else pa.int64()) for k in range(5)], names=["file", "block", "flips", "deeper_out", "deeper_in"])


def _cut(starts):
    """Entries of the first two levels and the parts of those that go on over a range's ends (1 ends here, 2 begins, 3 neither)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins, now, rows = starts.value, None, []
        inside = level = seq = 0
        pending, opened = b"", False

        def closed():
            if now is not None and (not opened or pending.strip()):
                rows.append((*now, seq, min(level, 2), 2 if opened else 3, pending.decode()))

        def batch_of():
            out = pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()))], names=[c.split()[0] for c in _SEGMENTS.split(", ")])
            rows.clear()
            return out

        for file, block, data in _chunks(batches):
            if now != (file, block):
                closed()
                now, (inside, level) = (file, block), begins[file, block]
                seq, pending, opened = 0, b"", block == 0
            at, kinds, inside_after = _outside(data, inside)
            step = _STEP[kinds]
            after = level + np.cumsum(step)
            before = after - step
            cuts = ((step > 0) & (before <= 1)) | ((step < 0) & (before <= 2) & (before >= 1)) | ((step == 0) & (after <= 2))
            last = 0
            for k in np.flatnonzero(cuts).tolist():
                text = pending + data[last : at[k]]
                if text.strip() or not opened:
                    rows.append((file, block, seq, int(min(before[k], 2)), 0 if opened else 1, (text + (b"" if step[k] <= 0 or before[k] == 0 else b"\x00")).decode()))
                seq, pending, opened, last = seq + 1, b"", True, int(at[k]) + 1
            pending += data[last:]
            level, inside = int(after[-1]) if len(after) else level, inside_after
            if len(rows) > 4096:
                yield batch_of()
        closed()
        yield batch_of()

    return run


def segments(raw: DataFrame) -> DataFrame:
    """``file, block, seq, level, text``: whole entries of the first two levels of documents, in the order of ``block, seq``.

    ``raw``: ``value, file, block`` from the text reader. A text ends with a zero byte where a container opens behind it. The state
    at each range's start (two numbers a range of some MB) goes through the driver.
    """
    spark = raw.sparkSession
    sums = written(raw.mapInArrow(_summaries, "file string, block long, flips long, deeper_out long, deeper_in long"), "ranges")
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("inside", F.coalesce(F.sum("flips").over(along), F.lit(0)) % 2)
    starts = starts.withColumn("level", F.coalesce(F.sum(F.when(F.col("inside") == 1, F.col("deeper_in")).otherwise(F.col("deeper_out"))).over(along), F.lit(0)))
    found = {(r.file, r.block): (r.inside, r.level) for r in starts.select("file", "block", "inside", "level").toLocalIterator()}
    cut = written(raw.mapInArrow(_cut(spark.sparkContext.broadcast(found)), _SEGMENTS), "segments")
    chain = F.sum((F.col("part") == 2).cast("int")).over(Window.partitionBy("file").orderBy("block", "seq"))
    parts = cut.where("part > 0").withColumn("chain", chain)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "seq", "text"))), lambda x: x["text"]), "")
    joined = parts.groupBy("file", "chain").agg(F.min(F.struct("block", "seq")).alias("at"), F.max_by("level", F.struct("block", "seq")).alias("level"), text.alias("text"))
    return cut.where("part = 0").select("file", "block", "seq", "level", "text").union(joined.select("file", "at.block", "at.seq", "level", "text"))


def read_large_envelopes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file, generated_at, listing_key, payload, channel, source`` as ``read_envelopes`` gives them, of files of any size.

    Keys may stand in any order and other containers beside ``listings``; files without listings give no row.
    """
    raw = spark.read.option("lineSep", "}").text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    rows = written(segments(current_files(raw)), "entries")
    place = F.struct("block", "seq")
    opening = F.col("text").endswith("\x00") & (F.col("level") == 1)
    names = rows.where(opening).select("file", F.struct(place.alias("at"), F.regexp_extract("text", r'"((?:[^"\\]|\\.)*)"\s*:\s*\x00$', 1).alias("name")).alias("s"))
    names = names.groupBy("file").agg(F.array_sort(F.collect_list("s")).alias("sections"))  # the document's few first-level containers
    heads = rows.where((F.col("level") == 1) & ~opening).select("file", F.from_json(F.concat(F.lit("{"), "text", F.lit("}")), "generated_at string")["generated_at"].alias("generated_at"))
    heads = heads.groupBy("file").agg(F.max("generated_at").alias("generated_at"))
    entries = rows.where("level = 2").join(names, "file").withColumn("at", place)
    entries = entries.where(F.element_at(F.filter("sections", lambda s: s["at"] < F.col("at")), -1)["name"] == "listings")
    pair = F.map_entries(F.from_json(F.concat(F.lit("{"), "text", F.lit("}")), "map<string,string>"))
    out = entries.select("file", F.explode(pair).alias("e")).join(heads, "file", "left")
    return of_files(out.select("file", "generated_at", F.col("e.key").alias("listing_key"), F.col("e.value").alias("payload")))
