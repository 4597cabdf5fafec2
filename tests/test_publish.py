import json

from propscan.plans import publish
from pyspark.sql import functions as F


def test_discarded_ids_are_rows(spark, tmp_path):
    rows = [("TIPOLOGIA", f"vgi_{i:04d}") for i in range(3000)] + [("SUPERFICIE", "vgi_9000")]
    discarded = spark.createDataFrame(rows, "reason string, listing_id string").repartition(5)
    announced = spark.createDataFrame([(1, "vgi_1", 80, "PROMUOVI", 5.0)], "position int, listing_id string, vote int, outcome string, price double")
    value = publish.report_document("2026-09-16", announced, discarded, "h").first().value
    assert json.loads(value)["scartate"] == {"TIPOLOGIA": 3000, "SUPERFICIE": 1} and len(value) < 500
    publish.publish_discarded(discarded, str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.reason, r.listing_id) for r in got.collect()) == sorted(rows)
    ranges = got.where("reason = 'TIPOLOGIA'").groupBy(F.input_file_name()).agg(F.min("listing_id").alias("a"), F.max("listing_id").alias("b")).orderBy("a").collect()
    assert all(x.b < y.a for x, y in zip(ranges, ranges[1:]))
