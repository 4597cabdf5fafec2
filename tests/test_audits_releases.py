import json
from collections import Counter

import pytest
from propscan.operators import audits as A
from propscan.plans import releases
from pyspark.sql import functions as F


def places(v, path=""):
    """Paths and kinds of a value, by walking it."""
    if isinstance(v, dict):
        yield path, "OBJECT"
        for k, x in v.items():
            yield from places(x, f"{path}.{k}".lstrip("."))
    elif isinstance(v, list):
        yield path, "ARRAY"
        for x in v:
            yield from places(x, path + "[]")
    else:
        yield path, {bool: "BOOLEAN", int: "BIGINT", str: "STRING", float: "DECIMAL", type(None): "VOID"}[type(v)]


def test_paths_at_any_depth(spark):
    deep = {"n": 1}
    for i in range(40):
        deep = {f"k{i}": [deep] if i % 3 == 0 else deep}
    records = [{"a": {"b": [{"x": 1}, {"y": "q"}], "c": 1.5}, "d": True}, {"a": {"b": [{"x": 2}], "c": None}}, {"e": "x"}, deep, {"a": {"b": [{"x": 7}], "c": 2.5}}]
    rows = [("s", json.dumps(r)) for r in records] + [("s", "{broken"), ("t", None), (None, "[1, 2]")]
    got = {(r.g, r.path, r.kind): (r.n, round(r.share, 6)) for r in A.json_paths(spark.createDataFrame(rows, "g string, j string"), "g", "j").collect()}
    want = Counter(("s", *p) for r in records for p in set(places(r)))
    want |= {("s", "", "UNREADABLE"): 1, ("t", "", "UNREADABLE"): 1, (None, "", "ARRAY"): 1, (None, "[]", "BIGINT"): 1}
    of = {"s": 6, "t": 1, None: 1}
    assert got == {k: (n, round(n / of[k[0]], 6)) for k, n in want.items()}
    assert A.json_paths(spark.createDataFrame([], "g string, j string"), "g", "j").collect() == []


def test_names_that_need_quotes():
    found = [(p["path"], p["kind"]) for p in A._places("OBJECT<``: BIGINT, `a.b`: ARRAY<ARRAY<DECIMAL(21,1)>>, `h``i`: OBJECT<>, t: ARRAY<VARIANT>>")]
    assert found == [("", "OBJECT"), ("``", "BIGINT"), ("`a.b`", "ARRAY"), ("`a.b`[]", "ARRAY"), ("`a.b`[][]", "DECIMAL"), ("`h``i`", "OBJECT"), ("t", "ARRAY"), ("t[]", "VARIANT")]
    with pytest.raises(ValueError):
        A._places("OBJECT<a: ?>")


def test_drift_tells_renamed_fields(spark):
    before = [("s", json.dumps({"p": {"city": "x", "zip": 1} if i % 2 else {"zip": 1}, "items": [{"n": 1}]})) for i in range(10)] + [("old", "{}")]
    now = [("s", json.dumps({"p": {"town": "x", "zip": "1"} if i % 2 else {"zip": "1"}, "items": [{"m": 1}] if i < 5 else []})) for i in range(10)] + [(None, "{}")]
    paths = lambda rows: A.json_paths(spark.createDataFrame(rows, "g string, j string"), "g", "j")
    got = {(r.g, r.path): tuple(r)[2:] for r in A.schema_drift(paths(now), paths(before), "g").collect()}
    assert got == {
        ("s", "p.city"): ("gone", "STRING", None, 0.5, None, None), ("s", "p.town"): ("new", None, "STRING", None, 0.5, "p.city"), ("s", "p.zip"): ("kind", "BIGINT", "STRING", 1.0, 1.0, None),
        ("s", "items[].n"): ("gone", "BIGINT", None, 1.0, None, None), ("s", "items[].m"): ("new", None, "BIGINT", None, 0.5, None), ("s", "items[]"): ("share", "OBJECT", "OBJECT", 1.0, 0.5, None),
        ("old", ""): ("gone", "OBJECT", None, 1.0, None, None), (None, ""): ("new", None, "OBJECT", None, 1.0, None),
    }
    assert A.schema_drift(paths(now), paths(now), "g").collect() == []


def test_release_is_whole_or_not_there(spark, tmp_path):
    root = f"file://{tmp_path}/site"
    ids = lambda t, back=0: sorted(r.id for r in releases.released(spark, root, t, back).collect())
    table = lambda *v: spark.createDataFrame([(i,) for i in v], "id int")
    assert releases.versions(spark, root) == []
    releases.publish(root, "w1", {"listings": table(1, 2), "registry": table(1)}, ("registry",))
    bad = table(9).select(F.when(F.rand() >= 0, F.raise_error(F.lit("stop"))).cast("int").alias("id"))
    with pytest.raises(Exception, match="stop"):  # the first table is written, the second fails
        releases.publish(root, "w2", {"listings": table(5), "registry": bad}, ("registry",))
    assert ids("listings") == [1, 2] and ids("registry") == [1] and [p["version"] for p in releases.versions(spark, root)] == ["w1"]
    releases.publish(root, "w2", {"listings": table(3), "registry": table(3)}, ("registry",))
    again = releases.released(spark, root, "registry").where("id = 3").unionByName(table(4))
    releases.publish(root, "w2", {"registry": again.withColumn("note", F.lit("x"))}, ("registry",))  # derived from itself, one column more
    assert ids("listings") == [3] and ids("registry") == [1, 3, 4] and ids("listings", 1) == [1, 2] and ids("registry", 1) == [1]
    assert sorted((r.id, r.note) for r in releases.released(spark, root, "registry").collect()) == [(1, None), (3, "x"), (4, "x")]
    with pytest.raises(Exception, match="exist"):  # a number can't be taken twice
        releases._switch(spark, root, {"number": 3, "version": "w9", "tables": {}})
    assert ids("listings") == [3]
    with pytest.raises(KeyError):
        releases.released(spark, root, "nothing")
    releases.publish(root, "w3", {"listings": table()}, ("registry",))
    assert ids("listings") == [] and ids("registry") == [1, 3, 4]
    releases.trim(spark, root, 1)
    assert [p["version"] for p in releases.versions(spark, root)] == ["w3"] and ids("registry") == [1, 3, 4] and ids("listings") == []
    assert len(list((tmp_path / "site" / "versions").iterdir())) == 3  # w1 and w2 for their registry rows, and w3
