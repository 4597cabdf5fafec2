import numpy as np
import pytest
from propscan.llm import embedding_links as el


def brute(rows, threshold=0.95):
    """Links of all pairs of rows and the components of these."""
    ok = [i for i, (k, v) in enumerate(rows) if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, top = [0] * len(rows), list(range(len(rows)))

    def find(a):
        while top[a] != a:
            a = top[a]
        return a

    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in ok}
    for x in ok:
        for y in ok:
            if x < y and len(unit[x]) == len(unit[y]) and unit[x] @ unit[y] >= threshold:
                links[x] += 1
                links[y] += 1
                top[find(x)] = find(y)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [(k, n, least.get(find(i)) if k is not None else None, k is not None and least[find(i)] == k) for i, ((k, _), n) in enumerate(zip(rows, links, strict=True))]


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0))


def made(seed, dim=24, groups=((60, 0.05), (25, 0.2), (12, 0.31)), alone=150):
    """Groups around a vector with noise, alike rows, scaled rows and odd ones, under shuffled ids."""
    rnd = np.random.default_rng(seed)
    vectors = list(rnd.standard_normal((alone, dim)))
    for size, noise in groups:
        base = rnd.standard_normal(dim)
        vectors += [base + noise * np.linalg.norm(base) / dim**0.5 * rnd.standard_normal(dim) for _ in range(size)]
    vectors = [v.astype(np.float32).tolist() for v in vectors]
    vectors += [vectors[0]] * 30 + [[2 * x for x in vectors[1]]] * 2
    odd = [None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] + [1.0] * (dim - 1), [float("inf")] * dim, [1.0, 2.0], [2.0, 4.0], [3e38] * dim]
    ids = rnd.permutation(len(vectors) + len(odd)).tolist()
    return [*zip(ids, vectors + odd, strict=True), (None, vectors[0]), (None, None), (ids[5], vectors[5]), (ids[5], vectors[40])]


@pytest.mark.parametrize(("seed", "sizes"), [(1, {}), (2, {"block": 16, "bucket": 4}), (3, {"block": 7, "bucket": 200})])
def test_matches_brute_force(spark, seed, sizes):
    rows = made(seed)
    table = spark.createDataFrame([(k, v, 1, 2) for k, v in rows], "vec_id long, embedding array<float>, node int, m int").repartition(4)
    got = el.near_duplicates(table, recall=0.9999, **sizes).collect()
    assert order(got) == order(brute(rows))


def test_recall_and_no_false_link(spark):
    rows = [(k, v) for k, v in made(7, dim=64, groups=[(6, 0.2)] * 40 + [(300, 0.15)], alone=800) if k is not None]
    got, want = order(el.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), bucket=16).collect()), order(brute(rows))
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)


def test_given_vectors(spark):
    from propscan.llm.queries import op12_embedding_near_dedup

    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert order(op12_embedding_near_dedup(spark, "/root/testdata/sf0.001").collect()) == order(brute(rows))


def test_pairs_count_in_one_table_only(spark):
    vector = np.ones(8)
    rows = [(i, (vector + 1e-3 * i * np.eye(8)[i % 8]).tolist()) for i in range(40)]
    got = el.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=8)
    assert order(got.collect()) == [(i, 39, 0, i == 0) for i in range(40)]


def test_empty_table_and_shape(spark):
    assert el.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    assert el.shape(10**9)[0] > el.shape(10**5)[0] and el.shape(10**9)[1] > el.shape(10**5)[1]
