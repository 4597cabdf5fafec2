"""Properties from listings: every rule again in plain Python, one edge after another."""

import random

import pytest
from propscan.operators import components
from propscan.operators import joins as J
from propscan.operators import resolve as R
from propscan.operators.components import constrained_components


def one_by_one(nodes, edges, labels):
    """Edges in order; refused where two labels of a case would meet."""
    top = {n: n for n in nodes}
    held = {n: {} for n in nodes}
    for n, case, label in labels:
        if n in held:
            held[n][case] = label

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    for _, a, b in sorted({(r, min(a, b), max(a, b)) for a, b, r in edges if a is not None and b is not None and a != b}):
        x, y = sorted((find(a), find(b)))
        if x != y and all(held[y].get(c, v) == v for c, v in held[x].items()):
            top[y] = x
            held[x] |= held[y]
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", [1])
def test_constrained_components_are_those_of_one_edge_after_another(spark, seed):
    rnd = random.Random(seed)
    n = 60
    edges = [(rnd.randrange(n), rnd.randrange(n), rnd.randrange(1, 4)) for _ in range((50, 80, 250)[seed])] + [(1, None, 1)]
    edges += [(100, 101 + i, 2) for i in range(30)]  # a hub without a label among lots
    labels = [(i, f"c{rnd.randrange(5)}", str(rnd.randrange(3))) for i in range(n) if rnd.random() < 0.5] + [(101 + i, "h", str(i % 7)) for i in range(30)] + [(None, "x", "1"), (500, "x", "1")]
    nodes = sorted({x for a, b, _ in edges for x in (a, b) if x is not None and None not in (a, b)})
    got = constrained_components(spark.createDataFrame(edges, "a int, b int, rule int"), spark.createDataFrame(labels, "node int, case string, label string"))
    assert dict(map(tuple, got.collect())) == one_by_one(nodes, edges, labels)


@pytest.mark.parametrize("batch", [40, 10_000])
def test_batches_give_what_one_edge_after_another_gives(spark, monkeypatch, batch):
    """Rounds are as many as batches, however long the chain of parts that wait for each other; a case of many labels is kept apart too."""
    rnd = random.Random(7)
    edges = [(f"n{rnd.randrange(90):02d}", f"n{rnd.randrange(90):02d}", rnd.randrange(1, 4)) for _ in range(160)] + [(f"p{i:02d}", f"p{i + 1:02d}", 2) for i in range(40)] + [("z1", "z1", 1), ("z2", None, 1)]
    labels = [(f"n{i:02d}", f"c{rnd.randrange(12)}", str(rnd.randrange(3))) for i in range(90) if rnd.random() < 0.5]
    labels += [(f"p{i:02d}", "long", str(i // 3)) for i in range(41)] + [("p00", "other", "x"), ("p40", "other", "x")]
    rounds = []
    clashes = components._clashes
    monkeypatch.setattr(components, "_clashes", lambda held: rounds.append(1) or clashes(held))
    nodes = sorted({x for a, b, _ in edges for x in (a, b) if None not in (a, b)})
    got = constrained_components(spark.createDataFrame(edges, "a string, b string, rule int"), spark.createDataFrame(labels, "node string, case string, label string"), batch=batch)
    assert dict(map(tuple, got.collect())) == one_by_one(nodes, edges, labels)
    assert len(rounds) == 1 if batch > 200 else 3 < len(rounds) < 3 * 200 // batch


def test_two_labels_of_a_node_clash_with_both(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("a", "c", 2), ("a", "d", 3), ("b", "e", 3)], "a string, b string, rule int")
    labels = spark.createDataFrame([("a", "p", "1"), ("a", "p", "2"), ("b", "p", "1"), ("c", "p", "2"), ("e", "p", "1"), *((f"x{i}", "p", "1") for i in range(20))], "node string, case string, label string")
    assert dict(map(tuple, constrained_components(edges, labels).collect())) == {"a": "a", "b": "b", "c": "c", "d": "a", "e": "b"}


def test_no_edges_and_chain_of_lots(spark):
    none = spark.createDataFrame([], "a string, b string, rule int")
    tags = spark.createDataFrame([("l1", "p", "1"), ("l9", "p", "2")], "node string, case string, label string")
    assert constrained_components(none, tags).collect() == []
    chain = spark.createDataFrame([(f"l{i}", f"l{i + 1}", 1) for i in range(1, 9)], "a string, b string, rule int")
    got = dict(map(tuple, constrained_components(chain, tags).collect()))
    assert got == {f"l{i}": "l1" if i < 9 else "l9" for i in range(1, 10)}


def groups(ids, pairs):
    return sorted(map(sorted, _by_root(one_by_one(ids, [(a, b, 0) for a, b in pairs], [])).values()))


def _by_root(of):
    out = {}
    for i, r in of.items():
        out.setdefault(r, []).append(i)
    return out


@pytest.mark.parametrize("sides", [None, ("s", "x", "y")])
@pytest.mark.parametrize("tolerances", [{"p": 0.05}, {"p": 0.03, "q": 0.02}])
def test_tolerance_links_have_the_components_of_all_pairs(spark, sides, tolerances):
    rnd = random.Random(5)
    rows = [(i, rnd.choice("tuv"), 100 * 1.012 ** rnd.randrange(40), 1000 * 1.008 ** rnd.randrange(30), rnd.choice("xyz")) for i in range(260)]
    rows += [(1000 + i, "w", 50.0, 70.0, "xy"[i % 2]) for i in range(400)] + [(2000, None, 1.0, 1.0, "x"), (2001, "t", None, 1.0, "x"), (2002, "t", 0.0, 1.0, "y"), (2003, "t", 100.0, 1000.0, None)]
    table = spark.createDataFrame(rows, "i int, t string, p double, q double, s string")
    near = lambda u, v: all(u[k] and v[k] and u[k] > 0 and v[k] > 0 and abs(u[k] - v[k]) <= share * max(u[k], v[k]) for k, share in zip((2, 3), tolerances.values()))
    other = lambda u, v: sides is None or {u[4], v[4]} == {"x", "y"}
    pairs = [(u[0], v[0]) for u in rows for v in rows if u[0] < v[0] and u[1] is not None and u[1] == v[1] and other(u, v) and near(u, v)]
    got = [tuple(r) for r in J.tolerance_links(table, "i", ["t"], tolerances, sides).collect()]
    ids = [r[0] for r in rows]
    assert groups(ids, got) == groups(ids, pairs)
    assert set(got) <= set(pairs) and len(got) < 40 * len(rows)


@pytest.mark.parametrize("tolerances", [{"p": 0.05}, {"p": 0.03, "q": 0.02}])
def test_differing_links_have_the_components_of_all_pairs(spark, tolerances):
    rnd = random.Random(6)
    rows = [(i, rnd.choice("tuv"), 100 * 1.012 ** rnd.randrange(40), 1000 * 1.008 ** rnd.randrange(30), rnd.choice("xxxxyzw")) for i in range(200)]
    rows += [(500 + i, rnd.choice("abcdefghij"), 100 * 1.012 ** rnd.randrange(12), 1000 * 1.008 ** rnd.randrange(9), rnd.choice("xxxyz")) for i in range(120)]
    rows += [(1000 + i, "w", 50.0, 70.0, "xyz"[i % 3]) for i in range(400)] + [(2000, None, 1.0, 1.0, "x"), (2001, "t", None, 1.0, "x"), (2002, "t", 0.0, 1.0, "y"), (2003, "t", 100.0, 1000.0, None)]
    table = spark.createDataFrame(rows, "i int, t string, p double, q double, s string")
    near = lambda u, v: all(u[k] and v[k] and u[k] > 0 and v[k] > 0 and abs(u[k] - v[k]) <= share * max(u[k], v[k]) for k, share in zip((2, 3), tolerances.values()))
    pairs = [(u[0], v[0]) for u in rows for v in rows if u[0] < v[0] and u[1] is not None and u[1] == v[1] and u[4] and v[4] and u[4] != v[4] and near(u, v)]
    got = [tuple(r) for r in J.differing_links(table, "i", ["t"], tolerances, "s").collect()]
    ids = [r[0] for r in rows]
    assert groups(ids, got) == groups(ids, pairs)
    assert set(got) <= set(pairs) and len(got) < 8 * len(rows)


LISTING = "listing_id string, source string, court string, procedure string, lot string, town string, sqm double, price double, category string, lat double, lon double, url string"


def listing(i, source="x", court=None, procedure=None, lot=None, town=None, sqm=None, price=None, category="capannone", lat=None, lon=None):
    return (i, source, court, procedure, lot, town, sqm, price, category, lat, lon, f"u/{i}")


def test_lots_of_a_procedure_stay_apart(spark):
    at = {"lat": 43.6, "lon": 13.5}
    rows = [listing("a1", court="Ancona", procedure="12/2020", lot="1", **at), listing("a2", court="ancona ", procedure="12/2020", lot="2", **at), listing("b0", **at)]
    rows += [listing("c1", court="Bari", procedure="7/2021", lot="9", **at), listing("c2", court="Bari", procedure="7/2021", lot="8", lat=43.6005, lon=13.5), listing("d0", lat=43.6005, lon=13.5)]
    rows += [listing("vgi_77", "vgi", "Como", "1/2020", "1"), listing("asteannunci_77", "asteannunci", "Como", "1/2020", "2"), listing("z", court="Como", procedure="1/2020", lot="2")]
    rows += [listing("m1", "idealista", town="gorle", sqm=1000.0, price=100.0), listing("m2", "immobiliare", town="gorle", sqm=1020.0, price=101.0), listing("m3", "idealista", town="gorle", sqm=1020.0, price=101.5), listing("m4", "other", town="gorle", sqm=1020.0, price=101.0)]
    table = spark.createDataFrame(rows, LISTING)
    of = {r.listing_id: r.property_id for r in R.properties(table, R.links(table)).collect()}
    assert of["a1"] != of["a2"] and of["b0"] in (of["a1"], of["a2"]) and of["c1"] != of["c2"]
    assert of["vgi_77"] != of["asteannunci_77"] and of["z"] == of["asteannunci_77"]
    assert of["m1"] == of["m2"] == of["m3"] == "m1" and of["m4"] == "m4"
    prop = R.properties(table, R.links(table))
    best = R.survivors(table, prop, ["court", "price"])
    assert sum(r.n_listings for r in best.collect()) == len(rows)
    others = R.aliases(table, prop, best).collect()
    assert len(others) == len(rows) - best.count() and all(r.alias_id != r.listing_id and r.url == f"u/{r.alias_id}" for r in others)


def test_equal_rows_give_few_links(spark):
    rows = [listing(f"x{i:05d}", ("idealista", "immobiliare")[i % 2], "Ancona", f"{i % 3}/2020", str(i % 4) if i % 5 else None, "gorle", 100.0, 1000.0, lat=43.6, lon=13.5) for i in range(2000)]
    table = spark.createDataFrame(rows, LISTING)
    assert R.links(table).count() < 5 * len(rows)


def test_market_edges_join_any_two_portals(spark):
    rows = [listing(f"{s}_{i}", s, town="gorle", sqm=1000.0 + 10 * i, price=100.0) for i, s in enumerate(["idealista", "immobiliare", "vgi", "fallcoaste", "vgi"])]
    table = spark.createDataFrame([*rows, listing("far", "caseasta", town="gorle", sqm=2000.0, price=100.0), listing("other", "caseasta", town="como", sqm=1000.0, price=100.0)], LISTING)
    got = sorted((r.a, r.b, r.rule) for r in R.edges(table).collect())
    assert got == sorted((min(u[0], v[0]), max(u[0], v[0]), 5) for i, u in enumerate(rows) for v in rows[:i] if u[1] != v[1] and abs(u[6] - v[6]) <= 0.03 * max(u[6], v[6]))
    of = {r.listing_id: r.property_id for r in R.properties(table, R.links(table, markets=None)).collect()}
    assert {of[r[0]] for r in rows} == {min(r[0] for r in rows)} and of["far"] == "far" and of["other"] == "other"


def carried(now, before, date):
    """Ids of components ``now`` (listing → component) by last week's ids, in plain Python."""
    shared = {}
    for i, c in now.items():
        if i in before:
            shared.setdefault(c, {}).setdefault(before[i], []).append(i)
    want = {c: min((-len(v), p) for p, v in by.items()) for c, by in shared.items()}
    winner = {p: min((n, c) for c, (n, q) in want.items() if q == p)[1] for _, p in want.values()}
    name = {c: p for p, c in winner.items()}
    used = set(before.values())
    return {i: name.get(c, f"{c}@{date}" if c in used else c) for i, c in now.items()}


def test_weekly_properties_equal_full_ones_and_keep_ids(spark):
    rnd = random.Random(11)

    def row(i):
        case = {"court": "Ancona", "procedure": f"{rnd.randrange(6)}/2020", "lot": rnd.choice([None, "1", "2"])} if rnd.random() < 0.6 else {}
        place = {"lat": 43 + rnd.randrange(14) / 50, "lon": 13.5} if rnd.random() < 0.7 else {}
        return listing(f"p{i:03d}", rnd.choice(["idealista", "immobiliare", "x"]), town=rnd.choice("tuvw"), sqm=100 * 1.02 ** rnd.randrange(60), price=1000.0 + rnd.randrange(4), **case, **place)

    week = {i: row(i) for i in range(20, 90)}
    before, ids = None, {}
    for date, gone, changed, new in (("d1", 0, 0, 0), ("d2", 3, 3, 4)):
        for i in rnd.sample(sorted(week), gone):
            del week[i]
        week |= {i: row(i) for i in [*rnd.sample(sorted(week), changed), *rnd.sample([i for i in range(120) if i not in week], new)]}
        rows = [*week.values(), next(iter(week.values())), listing(None)]
        table = spark.createDataFrame(rows, LISTING)
        links = R.links(table)
        last, before = before, R.weekly_properties(table, links, date, before)
        got = {r.listing_id: r for r in before.collect()}
        edges = [(r.a, r.b, r.rule) for r in links.collect()]
        labels = [(r.node, tuple(r.case), r.label) for r in R.labels(table).collect()]
        names = [r[0] for r in week.values()]
        full = one_by_one(names, edges, labels)
        assert before.count() == len(got) == len(week) and {i: r.component for i, r in got.items()} == full
        assert {i: r.block for i, r in got.items()} == one_by_one(names, [(a, b, 0) for a, b, _ in edges], [])
        ids, old = ({i: r.property_id for i, r in got.items()}, ids)
        assert ids == carried(full, old, date)
        kept = set() if last is None else {tuple(r) for r in got.values()} & {tuple(r) for r in last.collect()}
    assert len(kept) > 5
    assert any(p != full[i] for i, p in ids.items())
