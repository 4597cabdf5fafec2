import json
import random

import pytest
from propscan.sources import envelopes, snapshots


def made(rnd, n):
    odd = ['a "quoted" } { text', "back\\slash \\", "], [", "é日本\n", "", "}}}", '"', "x" * 300]
    record = lambda i: {"titolo": rnd.choice(odd), "n": i, "deep": {"a": [{"b": rnd.choice(odd)}, [], {}]}, "null": None}
    return {f"vgi_{i}" + ('"}' if i % 7 == 0 else ""): record(i) for i in range(n)}


@pytest.mark.parametrize("indent", [None, 2])
def test_ranges_give_what_whole_files_give(spark, tmp_path, indent):
    rnd = random.Random(4)
    (tmp_path / "ASTE").mkdir()
    docs = {
        "vgi": {"generated_at": "2026-09-16T00:00:00", "total": 60, "listings": made(rnd, 60)}, "x": {"listings": made(rnd, 9), "meta": {"listings": {"no": 1}, "k": {"z": 2}}, "generated_at": "2026-01-01", "list": [1, {"a": 2}]},
        "empty": {"generated_at": None, "listings": {}}, "other": {"meta": {"vgi_1": {"a": 1}}},
    }
    for name, doc in docs.items():
        (tmp_path / "ASTE" / f"dataset_{name}.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=name == "x") + ("\n" if indent else ""))
    whole = [tuple(r) for r in snapshots.read_envelopes(spark, str(tmp_path / "ASTE")).where("listing_key is not null").collect()]
    for size in ("97", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        try:
            got = envelopes.read_large_envelopes(spark, str(tmp_path / "ASTE"))
            assert sorted(map(tuple, got.collect()), key=str) == sorted(whole, key=str)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(whole) == 69
