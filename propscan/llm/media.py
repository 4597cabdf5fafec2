"""Media columns: payloads in archives, written and read by a Spark data source.

A payload is stored as an image of 64 RGB pixels a row (192 bytes), 8 bits a sample, in a lossless
PNG. Members lie one after another in archive files of bounded size; each file ends with an index of (id,
offset, length) and its place, so a reader needs no listing service. The source plans byte-range partitions
over the folder: a partition takes the members that begin in its range, so one hot or large archive
is many tasks. Members are streamed as Arrow batches, and a member whose bytes can't be read or
whose checksum differs is tried again alone, from its offset.

Files are named by task and attempt and become visible when the job commits a manifest, so lost or
repeated tasks leave nothing behind that is read.
"""

from __future__ import annotations

import hashlib
import json
import struct
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

ROW_BYTES = 192
_PNG = b"\x89PNG\r\n\x1a\n"
_INDEX = struct.Struct("<qqqI")  # id, offset, length, crc32; the id of a null is the least long
_TAIL = struct.Struct("<qqI4s")  # index offset, members, crc32 of the index, magic
_MAGIC = b"PMA1"
_NULL_ID = -(1 << 63)


def payload(text: str | None) -> bytes:
    raw = (text or "").encode()
    return raw + b" " * (-len(raw) % ROW_BYTES if raw else ROW_BYTES)


def encode(data: bytes, n_bytes: int) -> bytes:
    """A PNG whose samples are ``data`` (a positive multiple of ``ROW_BYTES``); ``n_bytes`` of it aren't padding."""

    def block(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rows = np.zeros((len(data) // ROW_BYTES, ROW_BYTES + 1), np.uint8)  # each row begins with filter 0
    rows[:, 1:] = np.frombuffer(data, np.uint8).reshape(-1, ROW_BYTES)
    head = struct.pack(">IIBBBBB", ROW_BYTES // 3, len(rows), 8, 2, 0, 0, 0)
    return _PNG + block(b"IHDR", head) + block(b"npAd", struct.pack(">Q", n_bytes)) + block(b"IDAT", zlib.compress(rows.tobytes(), 1)) + block(b"IEND", b"")


def decode(image: bytes) -> tuple[np.ndarray, int]:
    """Samples of an image that ``encode`` made, as rows of ``ROW_BYTES``, and the unpadded length; checks each part's checksum."""
    if image[:8] != _PNG:
        raise ValueError("not a PNG")
    at, parts, height, n_bytes = 8, [], 0, 0
    while at < len(image):
        n, kind = struct.unpack_from(">I4s", image, at)
        body = image[at + 8 : at + 8 + n]
        if zlib.crc32(image[at + 4 : at + 8 + n]) != struct.unpack_from(">I", image, at + 8 + n)[0]:
            raise ValueError("damaged part")
        if kind == b"IHDR":
            height = struct.unpack_from(">II", body)[1]
        elif kind == b"npAd":
            n_bytes = struct.unpack(">Q", body)[0]
        elif kind == b"IDAT":
            parts.append(body)
        at += 12 + n
    return np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(height, ROW_BYTES + 1)[:, 1:], n_bytes


def feature(samples: np.ndarray) -> str:
    """Mean and spread of each colour and a 16-bin histogram of brightness, in hundredths and per mille."""
    pixels = samples.reshape(-1, 3).astype(np.int64)
    n, total, squares = len(pixels), pixels.sum(0), (pixels**2).sum(0)
    bins = np.bincount(pixels.sum(1) // 48, minlength=16)
    return ",".join(map(str, [*(100 * total // n), *(100 * squares // n - 100 * (total // n) ** 2), *(1000 * bins // n)]))


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, int, int]]  # name, size, members


class _Writer(DataSourceArrowWriter):
    """Files of tasks become visible by a manifest of their write, which appears whole, by renaming. An overwriting write's manifest
    names those that it replaces; their files go after that."""

    def __init__(self, path: str, file_bytes: int, overwrite: bool = False):
        self.path, self.file_bytes, self.overwrite = path, file_bytes, overwrite

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        store, folder = _open(self.path)
        store.create_dir(folder, recursive=True)
        members = ((i, body) for batch in batches for i, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        files = []
        for first in members:
            name = f"part-{uuid.uuid4().hex}.pma"
            index, at = [], 0
            with store.open_output_stream(f"{folder}/{name}") as out:
                for i, body in chain([first], members):
                    out.write(body)
                    index.append((_NULL_ID if i is None else i, at, len(body), zlib.crc32(body)))
                    at += len(body)
                    if at >= self.file_bytes:
                        break
                raw = b"".join(_INDEX.pack(*x) for x in index)
                out.write(raw)
                out.write(_TAIL.pack(at, len(index), zlib.crc32(raw), _MAGIC))
            files.append((name, at + len(raw) + _TAIL.size, len(index)))
        return _Written(files)

    def commit(self, messages: list) -> None:
        store, folder = _open(self.path)
        store.create_dir(folder, recursive=True)
        earlier = _manifests(store, folder) if self.overwrite else {}
        name = uuid.uuid4().hex
        body = {"files": [f for m in messages if m for f in m.files], "replaces": sorted(earlier)}
        with store.open_output_stream(f"{folder}/_{name}.tmp") as out:
            out.write(json.dumps(body).encode())
        store.move(f"{folder}/_{name}.tmp", f"{folder}/manifest-{name}.json")
        for old, held in earlier.items():
            for file, _, _ in held["files"]:
                store.delete_file(f"{folder}/{file}")
            store.delete_file(f"{folder}/{old}")

    def abort(self, messages: list) -> None:
        store, folder = _open(self.path)
        for name, _, _ in (f for m in messages if m for f in m.files):
            store.delete_file(f"{folder}/{name}")


def _manifests(store: fs.FileSystem, folder: str) -> dict[str, dict]:
    """Manifests of a folder by name, without those that another one replaces."""
    found = {}
    for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if info.base_name.startswith("manifest-") and info.base_name.endswith(".json"):
            with store.open_input_stream(info.path) as f:
                found[info.base_name] = json.loads(f.read())
    gone = {old for m in found.values() for old in m["replaces"]}
    return {name: m for name, m in found.items() if name not in gone}


@dataclass
class Range(InputPartition):
    """Members of ``file`` whose first byte lies in ``[start, end)``."""

    file: str
    start: int
    end: int


class _Reader(DataSourceReader):
    def __init__(self, path: str, range_bytes: int, tries: int):
        self.path, self.range_bytes, self.tries = path, range_bytes, tries

    def partitions(self) -> list[Range]:
        store, folder = _open(self.path)
        files = [f for _, m in sorted(_manifests(store, folder).items()) for f in m["files"]]
        return [Range(name, at, at + self.range_bytes) for name, size, n in files if n for at in range(0, size, self.range_bytes)] or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("media", pa.binary())])
        if not part.file:
            return
        store, folder = _open(self.path)
        with store.open_input_file(f"{folder}/{part.file}") as f:
            size = f.size()
            f.seek(size - _TAIL.size)
            at, n, crc, magic = _TAIL.unpack(f.read(_TAIL.size))
            f.seek(at)
            raw = f.read(n * _INDEX.size)
            if magic != _MAGIC or zlib.crc32(raw) != crc:
                raise OSError(f"{part.file}: damaged index")
            ids, bodies, held = [], [], 0
            for i, offset, length, check in _INDEX.iter_unpack(raw):
                if part.start <= offset < part.end:
                    ids.append(None if i == _NULL_ID else i)
                    bodies.append(member(f, f"{folder}/{part.file}", offset, length, check, self.tries, store))
                    held += length
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bodies, pa.binary())], schema=schema)
                        ids, bodies, held = [], [], 0
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bodies, pa.binary())], schema=schema)


def member(f, path: str, offset: int, length: int, check: int, tries: int, store: fs.FileSystem) -> bytes:
    """One member's bytes; a read that fails or differs is tried again by itself on a new handle."""
    why: Exception | str = ""
    for k in range(tries):
        try:
            if k:
                time.sleep(0.05 * 2**k)
                f = store.open_input_file(path)
            f.seek(offset)
            body = f.read(length)
            if len(body) == length and zlib.crc32(body) == check:
                return body
            why = "checksum differs"
        except OSError as e:
            why = e
    raise OSError(f"{path}: member at {offset}: {why}")


class MediaArchive(DataSource):
    """``spark.read.format("media_archive").load(folder)`` → ``id long, media binary``; writes the same columns."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return "id long, media binary"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], int(self.options.get("rangeBytes", 32 << 20)), int(self.options.get("tries", 4)))

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], int(self.options.get("fileBytes", 128 << 20)), overwrite)


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([encode(payload(t), len((t or "").encode())) for t in part.column(1).to_pylist()], pa.binary())], names=["id", "media"])


def store(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", mode: str = "append") -> None:
    """Write the texts of ``docs`` to an archive folder: beside what it holds, or with ``overwrite`` in its place."""
    spark = docs.sparkSession
    spark.dataSource.register(MediaArchive)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows.mapInArrow(_encoded, "id long, media binary").write.format("media_archive").mode(mode).save(folder)


_DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _DIGEST.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        rows = []
        for i, media in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            samples, n_bytes = decode(media)
            raw = samples.tobytes()
            rows.append((i, n_bytes, len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature(samples)))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``id, media`` of an archive folder."""
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").load(folder)


def digest(media: DataFrame) -> DataFrame:
    """Payload facts and features of ``id, media`` rows, from the stored bytes."""
    return media.mapInArrow(_digested, _DIGEST)


def media_column(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store the texts of ``docs`` in ``folder`` and return what is read back, one row for each row.

    Null and empty texts are one row of spaces; ids may be null and repeat; an empty table gives no
    rows; other columns are ignored. ``n_bytes`` is the text's length without padding; it is
    a part of the image of its own, as trailing spaces can't tell it.
    """
    store(docs, folder, id_col, text_col)
    return digest(read(docs.sparkSession, folder))
