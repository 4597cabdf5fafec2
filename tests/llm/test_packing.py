import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from propscan.llm.packing import Encoder, pack, pack_lengths
from pyspark.sql import functions as F

FILE = public_tokenizers.path("word_bpe_49k.json")


def test_word_cache_equals_whole_text():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(FILE)
    texts = ["It's a TEST, d'accord?", "a\x1cb c d é ́x Σας ΟΔΟΣ ΟΔΟΣ.", "x<|endoftext|>y <|startoftext|>", "", None, "ß1234 99% 日本語 \U0001f600 we'll I'VE", "퟿​ z", "Hello, WORLD!! it's-fine... (a) end.) é, é,, x”, 3.14 a.b <b>c</b> İ, İstanbul ﬁn, a&&& b$$$ ä### don't, '' 'tis rock'n'roll, ½, ٣, x_y, _x_", "e\u0301, \u0301, a\u0301. \u1100\u1161 \u1100,", "the_ the- THE. the’ the’s the…"]
    import duckdb

    texts += [r[0] for r in duckdb.connect().execute("select text from '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    want = [[*t.encode(x or "", add_special_tokens=False).ids, 0] for x in texts]
    e = Encoder(FILE)
    for part in (slice(0, 9), slice(0, None)):  # new words, then known ones too
        ids, off = e.encode(pa.array(texts[part], pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == want[part]


def test_plan_uses_each_piece_once_and_few_sequences():
    rnd = np.random.default_rng(1)
    for lengths in (rnd.integers(1, 2048, 5000), np.minimum(rnd.lognormal(5.5, 1, 20000).astype(int) + 1, 2047), np.array([1]), np.array([1500] * 40), np.zeros(0, int)):
        counts = np.bincount(lengths, minlength=2048)
        fill, seen = {}, {}
        for x, first, n, s, off in pack_lengths(counts):
            assert first == seen.get(x, 0)
            seen[x] = first + n
            for i in range(n):
                assert fill.get(s + i, 0) == off
                fill[s + i] = off + x
        assert {k: v for k, v in seen.items() if v} == {i: int(c) for i, c in enumerate(counts) if c}
        assert all(v <= 2048 for v in fill.values())
        need = max(-(-int(lengths.sum()) // 2048), int((lengths > 1024).sum()))
        assert len(fill) <= need * 1.01 + 1


def test_pieces(spark):
    rows = [(1, "hello " * 5000), (2, None), (3, ""), (3, ""), (None, "a b"), (4, "<|endoftext|>")]
    got = pack(spark.createDataFrame(rows, "doc_id long, text string"), FILE).collect()
    assert sorted(r.length for r in got if r.doc_id == 1) == [905, 2048, 2048]
    assert [r.ids_crc32 for r in got if r.doc_id == 2] == [zlib.crc32(b"\0\0\0\0")]
    assert len(got) == 8 and pack(spark.createDataFrame([], "doc_id long, text string"), FILE).count() == 0


def test_places_are_gapless(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("length", F.lit("x")).withColumn("slice", F.lit(None).cast("int"))
    got = pack(docs.union(docs.where("doc_id % 3 = 0")), FILE).collect()
    spans, pieces = {}, {}
    for r in got:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, set()).add((r.piece, r.start, r.length))
    for found in spans.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(spans) <= 1.02 * total / 2048 + 2
    for found in pieces.values():
        ends = {start + length for _, start, length in found}
        assert {start for _, start, _ in found} == {0, *ends} - {max(ends)}
