import datetime as dt
import os
import tempfile

from propscan.streaming import jobs
from pyspark.sql import functions as F

E = "/root/testdata/sf0.001/events.parquet"


def run(df, mode):
    name = "q" + next(tempfile._get_candidate_names()).replace("-", "_")
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", tempfile.mkdtemp(dir="/tmp", prefix="spark-")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name)


def test_jobs(spark, tmp_path):
    schema = spark.read.parquet(E).schema
    src = tmp_path / "in"
    spark.read.parquet(E).write.parquet(str(src))
    stream = spark.readStream.schema(schema).parquet(str(src))
    batch = spark.read.parquet(E)
    assert run(jobs.first_seen(stream, "user_id", "ts", "400 days"), "append").count() == batch.select("user_id").distinct().count()
    total = run(jobs.windowed_counts(stream, "ts", "event_type"), "complete").agg(F.sum("n")).first()[0]
    assert total == batch.count()
    assert run(jobs.sessions(stream, "ts", "user_id"), "complete").agg(F.sum("n")).first()[0] == batch.count()


def test_changes_and_landing(spark, tmp_path):
    rows = [("a", 100.0, "d1", 1), ("a", 99.0, "d1", 2), ("a", 90.0, "d1", 3), ("a", 90.0, "d2", 4), ("b", 5.0, "d", 1)]
    spark.createDataFrame(rows, "listing_id string, price double, deadline string, scraped_at long").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("listing_id string, price double, deadline string, scraped_at long").parquet(str(tmp_path / "in"))
    got = sorted((r.listing_id, r.change) for r in run(jobs.changes(stream), "append").collect())
    assert got == [("a", "new"), ("a", "new_deadline"), ("a", "price_drop"), ("b", "new")]
    (tmp_path / "snap").mkdir()
    (tmp_path / "snap" / "dataset_vgi.json").write_text('{"listings": {"vgi_1": {"id": 1}}}')
    jobs.land(spark, str(tmp_path / "snap"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def files(spark, tmp_path, name, schema, *batches):
    """A stream with one file a batch."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / name / f"{i}"))
        for f in (tmp_path / name / f"{i}").glob("part-*"):
            os.utime(f, (1_700_000_000 + 10 * i,) * 2)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / name))


def test_late_records_change_nothing(spark, tmp_path):
    schema = "listing_id string, price double, deadline string, scraped_at long"
    stream = files(spark, tmp_path, "in", schema, [("a", 100.0, "d1", 5)], [("a", 60.0, "d0", 3)], [("a", 99.0, "d1", 6), ("a", 90.0, "d1", 7)], [("a", 98.0, "d1", 6)])
    got = [(r.change, r.price) for r in run(jobs.changes(stream), "append").collect()]
    assert got == [("new", 100.0), ("price_drop", 90.0)]


def test_unknown_prices_keep_the_last_known_one(spark, tmp_path):
    schema = "listing_id string, price double, deadline string, scraped_at long"
    nan = float("nan")
    stream = files(spark, tmp_path, "in", schema, [("a", 100.0, "d1", 1), ("b", None, None, 1)], [("a", None, "d2", 2), ("b", 70.0, None, 2)], [("a", nan, None, 3)], [("a", 50.0, None, 4), ("b", 60.0, "d", 5), ("c", 1.0, "d", None)])
    got = sorted((r.listing_id, r.change, r.price) for r in run(jobs.changes(stream), "append").collect())
    assert got == [("a", "new", 100.0), ("a", "new_deadline", 100.0), ("a", "price_drop", 50.0), ("b", "new", None), ("b", "price_drop", 60.0), ("c", "new", 1.0)]


def test_state_survives_a_restart(spark, tmp_path):
    schema = "listing_id string, price double, deadline string, scraped_at long"
    def round_of(n, rows):
        stream = files(spark, tmp_path, "in", schema, *rows) if n == 0 else spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        if n:
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"again{n}"))
        jobs.changes(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination(120)
        return sorted((r.listing_id, r.change) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert round_of(0, [[("a", 100.0, "d", 1)]]) == [("a", "new")]
    assert round_of(1, [("a", 99.0, "d", 2), ("b", 1.0, "d", 2)]) == [("a", "new"), ("b", "new")]
    assert round_of(2, [("a", 90.0, "d", 3)]) == [("a", "new"), ("a", "price_drop"), ("b", "new")]


def test_rechecks(spark, tmp_path):
    day = lambda d: dt.datetime(2026, 1, 1) + dt.timedelta(days=d)
    schema = "listing_id string, deadline timestamp, scraped_at timestamp"
    stream = files(
        spark, tmp_path, "in", schema, [("again", day(10), day(1)), ("lapsed", day(10), day(1)), ("moved", day(10), day(1))], [("moved", day(40), day(5))], [("again", day(60), day(20))],
        [("other", day(500), day(200))], [("other", day(500), day(201))],
    )
    got = sorted((r.listing_id, r.event, r.deadline) for r in run(jobs.rechecks(stream, "90 days"), "append").collect())
    assert ("again", "again", day(60)) in got and ("lapsed", "lapsed", day(10)) in got and not [g for g in got if g[:2] == ("moved", "again")]


def test_last_good_load_of_a_stream(spark, tmp_path):
    stream = files(spark, tmp_path, "in", "listing_id string, source string", [("a", "vgi"), ("b", "new")])
    loads = spark.createDataFrame([("vgi", "2026-09-02", True), ("vgi", "2026-09-09", False), ("vgi", "2026-08-26", True)], "source string, run_date string, ok boolean")
    assert {r.listing_id: r.last_good for r in run(jobs.with_last_good(stream, loads), "append").collect()} == {"a": "2026-09-02", "b": None}
