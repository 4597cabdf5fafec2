import hashlib
from collections import Counter

import pytest
import public_tokenizers as P
from propscan.llm import token_alignment as ta

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def brute(rows):
    """Whole texts, token by token: (doc_id → n_a, n_b, groups, links) and from them the corpus counts."""
    a, b, a_bytes, b_bytes = ta.tokenizers(A, B)
    out, links = [], Counter()
    for i, t in rows:
        x = a.encode(" " + t, add_special_tokens=False).ids if t else []
        y = b.encode(t) if t else []
        data = (" " + t).encode() if t else b""
        if b"".join(a_bytes[k] for k in x) != data or b"".join(b_bytes[k] for k in y) != data:
            x, y = [], []
        ends = []
        for ids, size in ((x, a_bytes), (y, b_bytes)):
            at, e = 0, []
            for k in ids:
                at += len(size[k])
                e.append(at)
            ends.append(e)
        groups, own, i0, j0 = [], [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            i1, j1 = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append(",".join(map(str, x[i0:i1])) + "|" + ",".join(map(str, y[j0:j1])))
            own.append((x[i1 - 1], y[j1 - 1]))
            i0, j0 = i1, j1
        links.update(own)
        out.append((i, len(x), len(y), ";".join(groups), own, sorted(set(ends[0]) & set(ends[1]))))
    most = {}
    for (_, k), n in links.items():
        most[k] = max(n, most.get(k, 0))
    return [(i, n, m, len(o), g, e, sum(links[p] == most[p[1]] for p in o), sum(links[p] for p in o)) for i, n, m, g, o, e in out]


TEXTS = [
    None, "", " ", "\n", "  ", " \n", "a", " a", "a ", "a  b", "a   b  ", "a\nb", "a \nb", "a\n\nb", "\n\na\n", "\na b", "a\tb", "a \t b\r\n c\r d", "it's we'll they 've",
    "ﬁx é é 日本語の文字 🙂 👩‍👩‍👧 Ⅷ", "日本\n語 日本\n語", "<s> </s> <unk> <0x41> <|endoftext|> x<|endoftext|>y", "a▁b rest", "▁", " x  y 　 z  w", "\x00 \x00x \x1c y \x85 z﻿ q ᠎ r ​ s",
    "Straße größer ÜBER naïve façade", "x" * 3000, "ab " * 3000, "1234 5678.90 12,3", "'); \r\n }\r\n */\r", "  indented\n    more\n\tlast", "é́ ́", "the the the", "the the the",
    "end., x... don't 'tis rock'n'roll a'b' (c) d) e_f g@h.i <x>y </x> 'S 's.", "a.b\n.c\n d", "x,\u00a0 y.\u3000\n z", "é.è,a,é.a", "q\t, r\t\n s", "a\t", "a,\x1f", "\t", ".", ",\n", "word" * 500 + "," * 500,
]


def test_matches_whole_texts(spark):
    rows = list(enumerate(TEXTS)) + [(None, "the end"), (3, "a twice")]
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, n_a long").repartition(3)
    got = ta.align(docs, A, B)
    key = lambda r: (r[0] is None, r[0] or 0, r[4])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows), key=key)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: tuple(r) for r in ta.align(docs, A, B).collect()}
    assert got == {r[0]: r for r in brute(rows)}


def test_query_derives_digests(spark):
    from propscan.llm.queries import op13_cross_tokenizer_alignment as query

    want = brute([(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()])
    got = sorted(map(tuple, query(spark, "/root/testdata/sf0.001").collect()))
    assert got == sorted((i, a, b, n, n, best, total, hashlib.sha256(g.encode()).hexdigest() if a else "") for i, a, b, n, g, _, best, total in want)


def test_units_are_the_text():
    own = ta.Aligner(A, B)
    for t in TEXTS:
        assert not t or "".join(own.unit.findall(" " + t)) == " " + t


def test_coarse_units_where_pieces_mix_letters_and_marks(monkeypatch):
    own = ta.Aligner(A, B)
    own.unit = ta._COARSE_UNIT
    for t, want in zip(TEXTS, brute(enumerate(TEXTS)), strict=True):
        assert own.document(*own.texts([t]))[0] == want[4]


def test_begins_anew(spark, monkeypatch):
    monkeypatch.setattr(ta, "UNITS", 5)
    monkeypatch.setattr(ta, "ENCODED", 16)
    own = ta.Aligner(A, B)
    for t in TEXTS:
        (n,) = own.texts([t])
        (want,) = brute([(0, t)])
        note, ends, links, totals = own.document(n)
        assert (note, list(ends), *totals, len(links)) == (want[4], want[5], want[1], want[2], want[3])


def test_frequent_units_are_kept(monkeypatch):
    monkeypatch.setattr(ta, "UNITS", 20)
    own, texts = ta.Aligner(A, B), ["the cat, the dog", "the cat again", *(f"the w{i}x cat y{i}" for i in range(40))]
    for t in texts:
        (n,) = own.texts([t])
        note, ends, links, totals = own.document(n)
        (want,) = brute([(0, t)])
        assert (note, list(ends), *totals, len(links)) == (want[4], want[5], want[1], want[2], want[3])
    assert len(own.groups) < 30 and {" the", " cat"} <= set(own.number)


def test_empty_table_and_bound(spark):
    assert ta.align(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
    assert ta.pair_bound(A, B) < 800_000


@pytest.mark.parametrize("n", [1, 40])
def test_repeated_rows_count_each(spark, n):
    docs = spark.createDataFrame([(1, "some words here")] * n, "doc_id long, text string")
    got = ta.align(docs, A, B, keep={}).collect()
    assert len(got) == n and {r.count_sum for r in got} == {got[0].n_links * n}
