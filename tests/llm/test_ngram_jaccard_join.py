import random

import pytest
from propscan.llm.ngram_jaccard_join import near_duplicates


def brute(rows, k=5, percent=80):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    comp = {i: i for i in sets}

    def find(a):
        while comp[a] != a:
            a = comp[a]
        return a

    ids, holders = sorted(sets), {}
    for i in ids:
        for g in sets[i]:
            holders.setdefault(g, []).append(i)
    for x in ids:
        for y in {y for g in sets[x] for y in holders[g]}:
            if x < y and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                comp[b] = a
    return sorted((i, len(sets[i]), find(i)) for i in ids)


@pytest.mark.parametrize("block", [8, 512])
def test_matches_brute_force(spark, block):
    rnd = random.Random(block)
    word = lambda: "w%d" % rnd.randrange(3000)
    rows, passage = [], [word() for _ in range(60)]
    bases = [[word() for _ in range(n)] for n in (3, 6, 40, 80, 120)]
    for i in range(260):
        b = list(rnd.choice(bases))
        for _ in range(rnd.choice((0, 0, 1, 1, 2, 3))):
            b[rnd.randrange(len(b))] = word()
        if i % 9 == 0:
            b = [word() for _ in range(20)] + passage
        rows.append((i, " ".join(b).upper() if i % 7 == 0 else "\t".join(b)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "ONE"), (1005, "x " * 3000)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").withColumn("sid", __import__("pyspark").sql.functions.lit(1)), block=block, bucket_tokens=500)
    assert sorted(map(tuple, got.collect())) == brute(rows)


@pytest.mark.parametrize("link_block", [7, 1024])
def test_links_of_each_document(spark, link_block):
    rnd = random.Random(link_block)
    word = lambda: "w%d" % rnd.randrange(3000)
    texts, bases = [], [[word() for _ in range(n)] for n in (4, 60, 100, 300)]
    for i in range(240):
        b = list(bases[min(3, i % 6)])
        for _ in range(rnd.choice((0, 1, 1, 2, 3))):
            b[rnd.randrange(len(b))] = word()
        texts.append(" ".join(b))
    rows = [(i, t) for i, t in enumerate([*texts, None, "", *texts[:20]])] + [(5, texts[5]), (None, texts[0])]
    sets = []
    for _, t in rows:
        w = (t or "").split()
        sets.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    want = [sum(x != y and 100 * len(a & b) >= 80 * len(a | b) and bool(a) for y, b in enumerate(sets)) for x, a in enumerate(sets)]
    assert max(want) > 60
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(d, bucket_tokens=500, n_links=True, block=link_block)
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.n_links) for r in got.collect()), key=key) == sorted(((i, n) for (i, _), n in zip(rows, want)), key=key)
    assert sorted(map(tuple, got.drop("n_links").collect()), key=key) == sorted(map(tuple, near_duplicates(d).collect()), key=key)
    assert near_duplicates(d.limit(0), n_links=True).count() == 0


def test_common_passage_and_whole_table(spark):
    """Shingles in every text go round the counting, and nothing changes; the whole table by brute force."""
    rnd = random.Random(4)
    word = lambda: "w%d" % rnd.randrange(3000)
    passage = [word() for _ in range(30)]
    rows = []
    for i in range(300):
        b = [word() for _ in range(rnd.choice((5, 20, 60)))] if i % 3 else list(rows[rnd.randrange(len(rows))][1].split()[30:]) if i > 9 else [word()]
        if b and i % 4 == 0:
            b[rnd.randrange(len(b))] = word()
        rows.append((i, " ".join(passage + b)))
    rows += [(300 + i, rows[3][1]) for i in range(40)] + [(400, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    for common in ((1, 0.3, 2), (4, 0.5, 2)):
        for links in (False, True):
            got = near_duplicates(d, common=common, bucket_tokens=3000, n_links=links, block=16).select("doc_id", "n_shingles", "component_id")
            assert sorted(map(tuple, got.collect())) == want
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = near_duplicates(docs, n_links=True).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_groups_of_rows(spark):
    rows = [("a", 7, "x y z"), ("b", 7, "x y z"), ("c", None, "X y z"), ("d", 5, "x y z"), ("e", 5, "q r s t u v"), ("f", 1, None), ("g", 1, "")]
    got = {r.key: r for r in near_duplicates(spark.createDataFrame(rows, "key string, doc_id long, text string"), carry="key").collect()}
    assert len({got[k].group for k in "abcd"}) == 1 and got["e"].group not in {got["a"].group, None} and got["f"].group is None
    assert [got[k].component_id for k in "abcdefg"] == [5, 5, 5, 5, 5, 1, 1]


def test_tree_finds_all_links():
    """Every link of random sets with long common paths, by counting each pair."""
    import numpy as np
    from propscan.llm.ngram_jaccard_join import PrefixTree, _Queries

    rnd = np.random.default_rng(3)
    base = [rnd.choice(400, 120, replace=False) for _ in range(4)]
    sets = [np.unique(np.r_[rnd.choice(base[i % 4], 116 - i % 9, replace=False), rnd.choice(400, i % 13)]) for i in range(150)] + [np.arange(3)]
    size = np.array([len(x) + i % 5 for i, x in enumerate(sets)])  # some shingles are in no other set
    for cut in (0, 60):
        tree = PrefixTree()
        for i in range(cut, len(sets)):
            tree.add(i, int(size[i]), sets[i][::-1].astype(np.int64))
        asked = range(len(sets)) if not cut else range(cut)
        q = _Queries(size[: len(asked)], np.repeat(np.arange(len(asked)), [len(sets[i]) for i in asked]), np.concatenate([sets[i] for i in asked]).astype(np.int64), 400)
        got = {(x, y) for y, found in tree.links(size, q, 80) for x in found.tolist()}
        shared = lambda x, y: len(np.intersect1d(sets[x], sets[y]))
        want = {(x, y) for x in asked for y in range(cut, len(sets)) if 100 * shared(x, y) >= 80 * (size[x] + size[y] - shared(x, y))}
        assert got == want
        assert len(want) > 200


def test_empty_and_repeated_rows(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    got = near_duplicates(spark.createDataFrame([(2, "a b"), (2, "a b"), (1, "A b"), (None, "c")], "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 1, 1), (2, 1, 1), (2, 1, 1), (None, 1, None)]
