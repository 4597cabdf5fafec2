import pickle
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from propscan.llm import phrase_mining as pm


def brute(rows, min_count, max_words=5, limit=2000):
    """Counts of all phrases by language, then the contract word for word."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out, frequent = [], []
    for lang in f:
        c = {p: a for p, a in f[lang].items() if a >= min_count}
        frequent += [(lang, " ".join(p), len(p), a) for p, a in c.items()]
        found = []
        for p, a in c.items():
            if len(p) < 2 or any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in c.items()):
                continue
            cuts = [(1000 * a * n[lang] // (f[lang][p[:k]] * f[lang][p[k:]]), k) for k in range(1, len(p))]
            s, k = min(cuts)
            found.append((-s, -a, " ".join(p).encode(), lang, a, f[lang][p[:k]], f[lang][p[k:]], n[lang], s))
        out += [(x[3], i, x[2].decode(), *x[4:]) for i, x in enumerate(sorted(found)[:limit], 1)]
    return sorted(out), sorted(frequent)


def texts(seed, n=400):
    rnd = random.Random(seed)
    words = ["w%d" % i for i in range(60)] + ["Éa", "日本", "x'y", "A", "a b", "\U0001f642z"]
    fixed = [["new", "york", "city", "hall"], ["of", "the"], ["of", "the", "people", "by", "the", "people"]]
    out = []
    for i in range(n):
        w = []
        for _ in range(rnd.randrange(30)):
            w += rnd.choice(fixed) if rnd.random() < 0.2 else [rnd.choice(words[: 1 + rnd.randrange(len(words))])]
        out.append((rnd.choice(["en", "de", None, "und"]), "".join(x + rnd.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " - "]) for x in w)))
    return [*out, ("en", None), (None, ""), ("en", " .,;!? "), ("fr", "one"), *[("en", "same words again and again")] * 30, ("de", "go go " * 4000)]


@pytest.mark.parametrize(("seed", "how"), [(1, {}), (3, {"share": 0.02, "at_least": 9})])
def test_matches_brute_force(spark, seed, how):
    rows = texts(seed)
    docs = spark.createDataFrame([(i, g, t, "v") for i, (g, t) in enumerate(rows)], "doc_id long, lang string, text string, phrase string").repartition(5)
    ranked, frequent = brute(rows, 20)
    found, totals, passes = pm.mine(docs, min_count=20, **how)
    assert sorted(map(tuple, found.collect())) == frequent
    assert passes == 2 if seed == 3 else passes in (1, 2)
    assert sorted(map(tuple, pm.collocations(docs, min_count=20, **how).collect())) == ranked


def test_ties_and_limit(spark):
    rows = [("en", f"k{i} v{i}") for i in range(40) for _ in range(5)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, pm.collocations(docs, limit=7, min_count=5).collect())) == brute(rows, 5, limit=7)[0]


def test_words_that_name_languages(spark):
    rnd = random.Random(7)
    words = ["en", "de", "fr", "und", "la", "x"]
    rows = [(lang, " ".join(rnd.choice(words) for _ in range(40))) for lang in ("en", "de", "fr", None) for _ in range(1 + 10 * len(lang or ""))]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, pm.collocations(docs, min_count=10).collect())) == brute(rows, 10)[0]


class Sent:
    def __init__(self, value):
        self.value = value


def test_crowded_filter_loses_nothing(monkeypatch):
    rows = texts(9)
    batch = pa.record_batch({"lang": pa.array([g or "und" for g, _ in rows]), "text": pa.array([t or "" for _, t in rows])})
    monkeypatch.setattr(pm, "_HELD", 1000)
    crowded = pm.Bits(np.full(pm.FILTER_BITS // 64, 2**64 - 1, np.uint64))
    found = Counter()
    for part in pm._pass(5, "all", Sent(pickle.loads(pickle.dumps(crowded))))(iter([batch])):
        for r in part.to_pylist():
            if r["key"] is not None:
                found[r["key"]] += r["n"]
    assert sorted(found.values()) == sorted(n for *_, n in brute(rows, 1)[1])


def test_empty_and_null_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert pm.collocations(empty).collect() == []
    nulls = spark.createDataFrame([(None, None, None)] * 3, "doc_id long, lang string, text string")
    assert pm.collocations(nulls, min_count=1).collect() == []


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 10**13
    frequent = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 7), ("en", "a b", 2, big - 3)], "lang string, phrase string, words int, n long")
    totals = spark.createDataFrame([("en", 10**16)], "lang string, n long")
    monkeypatch.setattr(pm, "mine", lambda *a, **k: (frequent, totals, 1))
    (row,) = pm.collocations(frequent).collect()
    assert row.score == 1000 * (big - 3) * 10**16 // (big * (big + 7))


def test_matches_sql(spark):
    import os
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
    from oracle import compare
    from propscan.llm.queries import ORACLE_SQL, QUERIES

    name = "op11_phrase_collocation_mining"
    assert compare(spark, QUERIES[name], ORACLE_SQL[name]) > 0
