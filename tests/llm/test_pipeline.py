import corpus_pipeline as P
from test_ngram_jaccard_join import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in P.STAGES:
        seen[name] = docs
        docs = P.written(stage(spark, docs, SF), "test")
        if name != "packing":
            assert docs.columns == columns
    kept = {n: {r.doc_id: r.text for r in d.select("doc_id", "text").collect()} for n, d in seen.items()}
    assert set(kept["quality"]) >= {i for i, t in kept["language"].items() if len(t.split()) > 80}
    assert all(len(t.split()) >= 50 for t in kept["near_duplicates"].values())
    want = {c for _, _, c in brute(sorted(kept["near_duplicates"].items()))}
    assert set(kept["source_mix"]) == want
    total, chosen = (sum(len(t.split()) for t in kept[n].values()) for n in ("source_mix", "packing"))
    assert 0.85 * total < chosen <= total
    assert {r.doc_id for r in docs.select("doc_id").collect()} == set(kept["packing"])
    assert [(n, len(k)) for n, k in kept.items()] == sorted(((n, len(k)) for n, k in kept.items()), key=lambda x: -x[1])
    whole = P.run(spark, SF)
    plain = lambda d: sorted(map(tuple, d.drop("sequence_id").collect()))  # noqa: E731  (any numbers)
    assert plain(whole) == plain(docs) and whole.select("sequence_id").distinct().count() == docs.select("sequence_id").distinct().count()


def test_rows_not_ids_are_chosen(spark):
    """Repeated and missing ids, nulls in every column, further columns, empty tables."""
    words = [f"alpha{i} beta{i * 7} gamma{i * 13}" for i in range(400)]
    text = lambda k: " ".join(words[k * 20 : k * 20 + 20])
    rows = [(2, text(0)), (5, text(1)), (5, text(0)), (7, text(2)), (7, text(2)), (None, text(3)), (None, text(3)), (None, text(4)), (8, None), (9, ""), (10, "x"), (10, "x")]
    d = spark.createDataFrame([(i, t, "en", None, None, "q") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, _row_key string")
    for docs in (d, P.written(d.repartition(3), "t")):
        left = P.near_duplicate(spark, docs, SF)
        assert left.columns == d.columns
        got = [(r.doc_id, r.text) for r in left.collect()]
        want = [(2, text(0)), (5, text(1)), (7, text(2)), (None, text(3)), (None, text(4)), (8, None), (9, ""), (10, "x")]
        assert sorted(got, key=str) == sorted(want, key=str)
        mixed = P.source_mix(spark, P.written(left, "t"), SF)
        assert mixed.columns == d.columns
        chosen = [(r.doc_id, r.text) for r in mixed.collect()]
        assert len(chosen) == len(set(chosen)) and set(chosen) <= {x for x in got if x[1]} and len(chosen) >= 4
    seen = d.limit(0)
    for _, stage in P.STAGES:
        seen = P.written(stage(spark, seen, SF), "empty")
        assert seen.count() == 0
    judged = P.quality(spark, P.language(spark, d, SF), SF)
    assert judged.columns == d.columns
