import hashlib
import tempfile
import zlib
from pathlib import Path

import pytest
from propscan.llm import media, toxicity
from propscan.llm.queries import op2_toxicity
from pyspark.sql import functions as F


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op2_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    hit = sum(r.predicted for r in got if r.toxic) / sum(r.toxic for r in got)
    false = sum(r.predicted for r in got if not r.toxic) / sum(not r.toxic for r in got)
    print(hit, false)
    assert hit > 0.8 and false < 0.03  # a tenth of the labels there are noise


def test_counterfactual_term_lowers_identity_weight(spark):
    rows = [(i, "you idiot the muslim people" if i % 2 else "nice day in town w%d" % (i % 7), i % 2) for i in range(200)]
    rows += [(1000 + i, "muslim idiot trash", 1) for i in range(40)]
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    neutral = spark.createDataFrame([(1, "the muslim family in town"), (2, None), (3, ""), (None, "you idiot")], "doc_id long, text string")
    free, fair = ({r.doc_id: r for r in toxicity.score(neutral, toxicity.fit(d, d, fairness=f)).collect()} for f in (0.0, 2.0))
    assert fair[1].score < free[1].score - 0.05 and fair[None].score > 0.7 and fair[2].score == fair[3].score
    one = toxicity.fit(d, d.where("toxic = 0"))
    assert {r.predicted for r in toxicity.score(neutral, one).collect()} == {0}
    assert toxicity.score(neutral.limit(0), one).count() == 0


def test_swaps_count_once_a_text():
    terms = {"a": ["muslim", "christian"], "b": ["gay", "straight"], "c": ["gay", "lesbiana"]}
    text = "A Muslim man. the muslim and gay! Muslim and christian. " * 1000
    assert toxicity.counterfactual_changes(text, terms) == [({"christian"}, {"muslim"}), ({"lesbiana"}, {"gay"}), ({"straight"}, {"gay"})]
    assert toxicity.counterfactual_changes(None, terms) == []


def test_scores_equal_brute_force(spark):
    """Every document of a table by adding the weights of its words' features one by one."""
    import math
    import re

    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.where(toxicity.learned_rows()))
    odd = spark.createDataFrame([(-1, None), (-1, None), (None, "x" * 300_000), (-2, "you idiot " * 50_000)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(odd).withColumns({c: F.lit(9) for c in ("score", "label", "id", "toxic")})
    texts = rows.collect()
    got = toxicity.score(rows, model).collect()
    assert len(got) == len(texts)
    want = []
    for r in texts:
        words = set(re.findall(r"[^\W\d_]+", (r.text or "").lower()))
        total = sum(model.weights.get(f, 0.0) for f in {f for w in words for f in toxicity.word_features(w)}) + model.bias
        want.append((str(r.doc_id), 1 / (1 + math.exp(-max(-40, min(40, total))))))
    for (i, a), (j, b) in zip(sorted((str(r.doc_id), r.score) for r in got), sorted(want), strict=True):
        assert i == j and abs(a - b) < 1e-9
    assert all(r.predicted == int(r.score >= 0.7) for r in got)


def test_images_are_read_by_another_decoder(spark):
    jvm = spark._jvm
    for text in ("abc", "é" * 300, "", "line\n" * 1000):
        data = media.payload(text)
        image = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(media.encode(data, len(text.encode()))))
        assert (image.getWidth(), image.getHeight()) == (64, len(data) // 192)
        for y in {0, image.getHeight() - 1}:
            row = b"".join((image.getRGB(x, y) & 0xFFFFFF).to_bytes(3, "big") for x in range(64))
            assert row == data[192 * y : 192 * (y + 1)]


def test_archives_are_cut_into_files(spark):
    import json
    import os

    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/a"
    spark.dataSource.register(media.MediaArchive)
    rows = spark.createDataFrame([(i, bytes([i % 256]) * 1000) for i in range(100)], "id long, media binary").coalesce(1)
    rows.write.format("media_archive").option("fileBytes", 10_000).mode("append").save("file://" + folder)
    (manifest,) = Path(folder).glob("manifest-*.json")
    files = json.loads(manifest.read_text())["files"]
    assert [n for _, _, n in files] == [10] * 10 and all(os.path.getsize(f"{folder}/{name}") == size for name, size, _ in files)
    back = spark.read.format("media_archive").option("rangeBytes", 3000).load("file://" + folder)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    odd = spark.createDataFrame([(1, "a", 2, 3)], "doc_id long, text string, id int, media int")
    assert media.media_column(odd, "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/c").first().n_bytes == 1


def test_round_trip(spark):
    rows = [(1, "abc"), (2, None), (3, ""), (4, "é" * 96), (5, "x" * 193), (5, "x" * 193), (None, "y" * 40_000), (6, "abc ")]
    folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/a"
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, media.media_column(d, folder).drop("media_bytes", "media_sha256", "feature").collect()), key=str)

    def want(i, t):
        p = (t or "").encode()
        n = len(p)
        p += b" " * (192 - n if n == 0 else -n % 192)
        return i, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])

    assert got == sorted((want(*r) for r in rows), key=str)
    small = spark.read.format("media_archive").option("rangeBytes", 100).load(folder)
    assert small.count() == len(rows) and small.rdd.getNumPartitions() > 10
    empty = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/b"
    assert media.media_column(d.limit(0), empty).count() == 0


def test_member_retry():
    from pyarrow import fs

    d = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    open(f"{d}/x", "wb").write(b"0123456789")

    class Bad:
        def seek(self, at):
            raise OSError("lost")

    assert media.member(Bad(), f"{d}/x", 3, 4, zlib.crc32(b"3456"), 3, fs.LocalFileSystem()) == b"3456"
    with pytest.raises(OSError, match="member at 3"):
        media.member(Bad(), f"{d}/x", 3, 4, 0, 2, fs.LocalFileSystem())


def test_archive_of_several_writes(spark, tmp_path):
    folder = str(tmp_path / "archive")
    one = lambda i: spark.createDataFrame([(i, f"text {i}")], "doc_id long, text string")
    ids = lambda: sorted(r.id for r in media.read(spark, folder).collect())
    media.store(one(1), folder)
    media.store(one(2), folder)
    assert ids() == [1, 2]
    broken = spark.createDataFrame([(3, "x"), (4, "y")], "doc_id long, text string").repartition(2).withColumn("text", F.when(F.col("doc_id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        media.store(broken, folder)
    assert ids() == [1, 2]
    media.store(one(5), folder, mode="overwrite")
    assert ids() == [5] and len(list((tmp_path / "archive").glob("part-*"))) <= 2
    media.store(one(6), folder)
    assert ids() == [5, 6]
