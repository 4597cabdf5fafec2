"""Pairs of near rows: all of them, moved nowhere after the join that finds them."""

import random

from propscan.operators import joins as J
from propscan.operators import resolve as R
from propscan.plans.queries import QUERIES
from propscan.functions.parse import haversine_km
from pyspark.sql import functions as F

LISTING = "listing_id string, source string, court string, procedure string, lot string, town string, sqm double, price double, category string, lat double, lon double"
FOLDER = "/root/testdata/sf0.001"


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def clash(x, y):
    return None not in (*x[2:5], *y[2:5]) and x[2].strip().lower() == y[2].strip().lower() and x[3] == y[3] and x[4] != y[4]


def wanted(rows):
    """Edges of rules 2, 4 and 5 in plain Python; rows share points exactly or are far away."""
    out = set()
    for x in rows:
        for y in rows:
            if x[0] < y[0] and not clash(x, y):
                if x[8] == y[8] and x[9] is not None and x[9:] == y[9:]:
                    out.add((x[0], y[0], 4))
                near = all(abs(x[k] - y[k]) <= share * max(x[k], y[k]) for k, share in ((6, 0.03), (7, 0.02)))
                if x[5] == y[5] and x[1] != y[1] and near:
                    out.add((x[0], y[0], 5))
    return out


def listings_at_random(n):
    rnd = random.Random(3)
    lot = lambda: (rnd.choice(["Bari", "bari "]), f"{rnd.randrange(3)}/2020", rnd.choice(["1", "2"])) if rnd.random() < 0.6 else (None, None, None)
    place = lambda: (40.0 + rnd.randrange(4), 9.5) if rnd.random() < 0.8 else (None, None)
    return [(f"i{i:03d}", rnd.choice("xyz"), *lot(), rnd.choice("tu"), 100 * 1.01 ** rnd.randrange(30), 1000 * 1.007 ** rnd.randrange(20), rnd.choice("ab"), *place()) for i in range(n)]


def test_edges_are_not_moved_after_they_are_found(spark):
    rows = listings_at_random(150)
    found = R.edges(spark.createDataFrame(rows, LISTING))
    got = [tuple(r) for r in found.collect() if r.rule in (4, 5)]
    assert len(got) == len(set(got)) and set(got) == wanted(rows)
    text = plan(found, "optimizedPlan")
    assert text.startswith("Union")  # and no aggregate over all pairs


def test_edges_of_repeated_ids_are_given_once(spark):
    rows = listings_at_random(60)
    rows += [(*r[:6], r[6] * 1.001, *r[7:]) for r in rows[:20]]
    got = [tuple(r) for r in R.edges(spark.createDataFrame(rows, LISTING)).collect() if r.rule in (4, 5)]
    assert len(got) == len(set(got)) and set(got) == wanted(rows)


def test_portal_pairs_are_not_moved_after_they_are_found(spark):
    text = plan(QUERIES["portal_pairs"](spark, FOLDER), "optimizedPlan")
    assert text.count("Join ") == 1 and "Aggregate" not in text


def test_tolerance_pairs_at_the_limit(spark):
    rows = [(i, "t", v, "xy"[i % 2]) for i, v in enumerate([100.0, 97.0, 94.09, 96.99, 103.0, 100 / 0.97, 1e-9, 0.97e-9, 0.0, -1.0])] + [(50, None, 100.0, "x"), (51, "t", None, "x")]
    table = spark.createDataFrame(rows, "i int, t string, v double, s string")
    for differ in (None, "s"):
        want = sorted((u[0], w[0]) for u in rows for w in rows if u[0] < w[0] and u[1] == w[1] == "t" and u[2] and w[2] and min(u[2], w[2]) > 0 and abs(u[2] - w[2]) <= 0.03 * max(u[2], w[2]) and (differ is None or u[3] != w[3]))
        assert sorted(map(tuple, J.tolerance_pairs(table, "i", ["t"], {"v": 0.03}, differ).collect())) == want
        assert sorted(map(tuple, J.tolerance_pairs(table.union(table), "i", ["t"], {"v": 0.03}, differ).collect())) == want


def test_large_sides_do_not_go_by_way_of_the_driver(spark):
    for name in ("neighbours_everywhere", "competitors_of_competitors"):
        assert "BroadcastHashJoin" not in plan(QUERIES[name](spark, FOLDER)), name


def test_radius_join_everywhere(spark):
    rnd = random.Random(8)
    points = [(i, rnd.uniform(-89, 89), rnd.uniform(-180, 180)) for i in range(500)] + [(600 + i, rnd.choice([-88.95, 88.95, 88.2, 0.0, -0.1]), rnd.choice([-180.0, 179.99, 180.0, 0.0, 60.0, -60.0])) for i in range(100)]
    table = spark.createDataFrame([*points, (900, None, 0.0)], "i int, lat double, lon double")
    for km in (100.0, 3.0):
        both = table.crossJoin(table.select(F.col("i").alias("r_i"), F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"))).where(haversine_km(F.col("lat"), F.col("lon"), F.col("r_lat"), F.col("r_lon")) <= km)
        want = sorted((r.i, r.r_i) for r in both.select("i", "r_i").collect())
        for spread in (False, True):
            assert sorted((r.i, r.r_i) for r in J.radius_join(table, table, km, spread).select("i", "r_i").collect()) == want


def test_sums_around_are_those_of_all_pairs(spark):
    rnd = random.Random(9)
    rows = [(rnd.randrange(80), 45 + rnd.randrange(8) / 10, 9 + rnd.randrange(3) / 10, float(rnd.randrange(1, 9))) for _ in range(120)] + [(200, 10.0, 10.0, 5.0), (201, None, 9.0, 5.0), (None, 45.0, 9.0, 7.0)]
    table = spark.createDataFrame(rows, "k int, lat double, lon double, v double")
    b = table.select(F.col("k").alias("r_k"), F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"), F.col("v").alias("r_v"))
    near = table.crossJoin(b).where("k <> r_k").where(haversine_km(F.col("lat"), F.col("lon"), F.col("r_lat"), F.col("r_lon")) <= 30)
    want = {r.k: (r.n, r.s) for r in near.groupBy("k").agg(F.count("*").alias("n"), F.sum("r_v").alias("s")).collect()}
    found = J.sums_around(table, "k", "v", 30.0)
    assert {r.k: (r.n, r.sum) for r in found.collect()} == want and 200 not in want
