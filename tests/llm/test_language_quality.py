import re

import pytest
from propscan.llm import language_id as L
from propscan.llm import quality_rules as Q
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit(docs.where(L.learned_rows()))
    got = L.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(~L.learned_rows()).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got) > 100
    assert sum(r.rejected for r in got) <= 0.02 * len(got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (None, "der die und das ist")], "doc_id long, text string")
    assert [(r.doc_id, r.lang_pred) for r in L.identify(odd, model).collect()] == [(1, "und"), (2, "und"), (3, "und"), (None, "de")]
    empty = L.fit(docs.limit(0))
    assert {r.lang_pred for r in L.identify(odd, empty).collect()} == {"und"}


def test_rejection_follows_the_fold(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("length(text) > 500")
    known = docs.where("lang <> 'es'")
    model = L.fit(known.where(L.learned_rows()))
    share = lambda d: L.identify(d, model).agg(F.avg(F.col("rejected").cast("double"))).first()[0]
    other, own = share(docs.where("lang = 'es'")), share(known.where(~L.learned_rows()))
    print(other, own)
    assert other > 0.9 and own < 0.01
    texts = [(i, "alpha beta gamma delta " * (3 + i % 5), "x") for i in range(8000)] + [(9000, "zq xj vw kk " * 30, "x")]
    one = L.fit(spark.createDataFrame(texts, "doc_id long, text string, lang string"))
    assert one.limit[0] < 0.2  # a single odd text doesn't move the cut


def test_two_languages_of_a_late_script(spark):
    import random

    rnd = random.Random(3)
    many = [chr(c) for c in (*range(0x561, 0x587), *range(0x10D0, 0x10F1), *range(0x3B1, 0x3C9))]  # over 90 letters of three scripts
    first, second = [chr(0x430 + i) for i in range(0, 32, 2)], [chr(0x430 + i) for i in range(1, 32, 2)]

    def text(letters, n):
        return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randrange(3, 8))) for _ in range(n))

    rows = [(i, text(many, 300), "big") for i in range(60)] + [(100 + i, text(first, 40), "ru") for i in range(60)] + [(200 + i, text(second, 40), "bg") for i in range(60)]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    new = [(i, text(first if i % 2 else second, 60)) for i in range(40)]
    got = L.identify(spark.createDataFrame(new, "doc_id long, text string"), model).collect()
    assert [r.lang_pred for r in got] == ["ru" if r.doc_id % 2 else "bg" for r in got]


def test_kneser_ney_sums_to_one():
    import numpy as np

    table = L._letters().copy()
    codes, n = np.unique(L.letter_codes(["abra cadabra", "bar"], table)[0], return_counts=True)
    g, c = L.kneser_ney(codes, n)
    m = L.Model(table, ["x"], [g], [c])
    for context in (0, 1, L.ALPHABET + 1, 5):
        p = np.exp(m.log_prob(0, context * L.ALPHABET + np.arange(L.ALPHABET)))
        assert abs(p.sum() - 1) < 1e-9


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    cover = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


def test_counts_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    odd = ["a b c a b c a", "x\n\nx\n x\nx", None, "", "\n\n", "é|é é\x0b<b>", "a a a a", "l1\r\nl1\r\nl1", "A" * 5000]
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()] + [(-i, t, None) for i, t in enumerate(odd, 1)]
    got = {r.doc_id: tuple(r)[1:6] for r in Q.measure(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got == {i: brute(t) for i, t, _ in rows}


@pytest.mark.parametrize(("k", "n"), [(0, 100), (3, 50), (10, 2000)])
def test_upper_bound(k, n):
    from math import comb

    p = Q.upper_bound(k, n, 0.05)
    assert abs(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) - 0.05) < 1e-6


def test_rules_keep_good_and_reject_bad(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    m = Q.measure(d)
    j = Q.judge(m, Q.fit_cutoffs(m, labels)).where("not base_failed").join(labels, "doc_id")
    r = j.agg(F.avg(F.expr("if(quality = 1, kept, null)").cast("int")).alias("good"), F.avg(F.expr("if(quality = 0, kept, null)").cast("int")).alias("bad")).first()
    print(r)
    assert r.good > 0.985 and r.bad < 0.5


@pytest.mark.parametrize(("n", "alpha", "error"), [(100, 0.05, 0.05), (1000, 0.005, 0.01), (3000, 0.005, 0.05 / 24), (50, 0.005, 0.05), (20_000, 0.01, 0.001)])
def test_certified_losses_by_the_bound(n, alpha, error):
    most = Q.certified_losses(n, alpha, error)
    assert most == max([k for k in range(min(n, int(n * alpha) + 3)) if Q.upper_bound(k, n, error) <= alpha], default=-1)


def test_cutoffs_by_brute_force(spark):
    """The best cutoff of each stratum and rule, by trying all; strata of any name, repeated and missing ids."""
    import random

    rnd = random.Random(2)
    rows, labels = [], []
    for i in range(9000):
        bad = i % 5 == 0
        marks = rnd.randrange(30, 60) if bad and i % 3 else rnd.randrange(0, 20)
        rows.append((i, " ".join(f"w{j}" for j in range(60)) + " " + "! " * marks, f"s{i % 2}" if i % 500 else None))
        labels.append((i, int(not bad)))
    d = spark.createDataFrame([*rows, (None, rows[5][1], "s0")], "doc_id long, text string, lang string").withColumns({c: F.lit(1) for c in ("stratum", "n_words", "kept", "rule")})
    known = spark.createDataFrame([*labels, labels[0], (None, 1), (3, 0)], "doc_id long, quality int")
    m = Q.measure(d)
    cut = {(r.stratum, r.rule): r.cut for r in Q.fit_cutoffs(m, known).collect()}
    counts = {r.doc_id: r for r in m.collect() if r.doc_id is not None}
    worst = {}
    for i, good in labels:
        r = counts[i]
        worst.setdefault(r.stratum, []).append((-(-100 * r.n_marks // r.n_words), good if i != 3 else 1))
    n_tests = len(worst) * len(Q.RULES)
    for s, seen in worst.items():
        n, best = sum(g for _, g in seen), None
        for c in range(Q.GRID, -1, -1):
            lost = sum(g and v > c for v, g in seen)
            if Q.upper_bound(lost, n, 0.05 / n_tests) > 0.005:
                break
            gain = sum(not g and v > c for v, g in seen) - 20 * lost
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, c)
        found = cut.get((s, "marks"))
        if best is None:
            assert found is None
        else:
            kept = lambda c: [v <= c for v, _ in seen]
            assert kept(found) == kept(best[1])
    assert {s for s, _ in cut} == {"s0", "s1"}  # the stratum of nulls is too small
    judged = Q.judge(m, Q.fit_cutoffs(m, known)).collect()
    assert len(judged) == 9001 and not any(r.violated for r in judged if r.stratum == "") and sum(r.violated != "" for r in judged) > 800
    empty = Q.fit_cutoffs(m, known.limit(0))
    assert empty.count() == 0 and Q.judge(m.limit(0), empty).count() == 0 and {r.violated for r in Q.judge(m, empty).collect()} == {""}


def test_language_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit(docs)
    odd = spark.createDataFrame([(1, "der die und das ist nicht " * 40_000, "q")] * 2 + [(2, "", "q")], "doc_id long, text string, row string").withColumns({c: F.lit(1) for c in ("lang", "score", "entropy", "rejected", "own")})
    got = sorted(tuple(r)[:2] for r in L.identify(odd, model).collect())
    assert got == [(1, "de"), (1, "de"), (2, "und")]
    assert L.accepted(odd, model).columns == odd.columns and L.identify(odd.limit(0), model).count() == 0 and L.accepted(odd.where("doc_id = 2"), model).count() == 0
    two = L.fit(docs, max_langs=2)
    assert len(two.langs) == 2


def test_language_equals_plain_models(spark):
    """Scores of the hash arrays by plain dictionaries of the same counts."""
    import math

    texts = {"x": ["abra cadabra", "bar abra", "cab"] * 3, "y": ["lorem olle", "more lore", "rolle"] * 3}
    model = L.fit(spark.createDataFrame([(i, t, g) for g, ts in texts.items() for i, t in enumerate(ts)], "doc_id long, text string, lang string"), docs_per_lang=100_000, reject=0.9)
    got = {r.doc_id: r for r in L.identify(spark.createDataFrame([(1, "abra bar"), (2, "more rolle"), (3, "zz")], "doc_id long, text string"), model).collect()}
    assert (got[1].lang_pred, got[2].lang_pred) == ("x", "y") and got[3].rejected
    codes, first, letters = L.letter_codes(["abra bar"], model.table)
    assert math.isclose(got[1].entropy, -float(model.log_prob(0, codes).mean()), rel_tol=1e-4) and letters[0] == 7
    assert sorted(model.langs) == sorted(texts)
