"""Datasets in months: commits that fail, readers beside writers, streams and retention of one dataset."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from cellstream.operators import landing, months
from cellstream.spec import TableSpec
from cellstream.streaming import jobs
from cellstream.template import TableJobs

DAY = datetime.datetime
TOPIC = "partition int, offset bigint, timestamp timestamp_ntz"
POSITION = ["__kafka_partition", "__kafka_offset"]


def rows(spark, *kvx):
    return spark.createDataFrame(list(kvx), "ym int, k int, ver int, x string")


def merge(spark, df, path, **more):
    landing.merge_months(spark, df, path, ["k"], "ver", **more)


def content(df):
    return sorted((r["ym"], r["k"], r["x"]) for r in df.collect())


def ingested_at_broker_time(t):
    return landing.to_raw(t, {"id": F.col("offset").cast("string")}, F.col("timestamp"))


def topic_stream(spark, path):
    return spark.readStream.schema(TOPIC).option("maxFilesPerTrigger", 1).parquet(path)


def add_to_topic(spark, path, *at):
    spark.createDataFrame([(0, o, d) for o, d in at], TOPIC).coalesce(1).write.mode("append").parquet(path)


def test_streamed_months_retire_and_go_on(spark, tmp_path):
    """30 rows of two months by a stream, retention of the first month and of half of the second, more rows on the same checkpoint."""
    topic, out, checkpoint = (str(tmp_path / n) for n in ("topic", "raw", "c"))
    add_to_topic(spark, topic, *[(i, DAY(2023, 12, 17) + datetime.timedelta(days=i)) for i in range(30)])  # to 15 January
    run = lambda: jobs.raw(topic_stream(spark, topic), ingested_at_broker_time, out, checkpoint, POSITION).awaitTermination()
    run()
    assert months.read(spark, out).count() == 30
    for _ in range(2):
        months.retire(spark, out, 10, DAY(2024, 1, 20), ["__ingest_ts"], POSITION)
        assert sorted(r["id"] for r in months.read(spark, out).collect()) == sorted(str(i) for i in range(24, 30))
    add_to_topic(spark, topic, (30, DAY(2024, 1, 16)), (31, DAY(2024, 2, 1)))
    run()
    months.compact(spark, out, 202401, POSITION)
    assert sorted(int(r["id"]) for r in months.read(spark, out).collect()) == list(range(24, 32))
    assert {r["ym"]: (r["parts"], r["n_rows"]) for r in months.report(spark, out).collect()} == {202401: (1, 7), 202402: (1, 1)}
    months.vacuum(spark, out, 1)
    assert months.read(spark, out).count() == 8


def test_only_whole_months_expire(spark, tmp_path):
    path = str(tmp_path / "m")
    t = spark.createDataFrame([(1, DAY(2023, 11, 1)), (2, DAY(2024, 1, 5))], "k int, at timestamp_ntz").withColumn("ym", (F.year("at") * 100 + F.month("at")).cast("int"))
    months.retire(spark, path, 10, DAY(2024, 1, 10), ["at"], ["k"])  # nothing is there yet
    months.append(spark, t, path, ["k"])
    months.retire(spark, path, 10, DAY(2024, 1, 10), ["at"], ["k"])
    assert [r["k"] for r in months.read(spark, path).collect()] == [2]
    months.retire(spark, path, 10, DAY(2025, 1, 10), ["at"], ["k"])
    assert months.read(spark, path).count() == 0 and months.read(spark, path).columns == ["k", "at", "ym"]


def test_a_merge_that_dies_before_its_commit_leaves_all_months(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    merge(spark, rows(spark, (202401, 1, 1, "a"), (202402, 2, 1, "b")), path)
    before = content(months.read(spark, path))
    newer = rows(spark, (202401, 1, 2, "c"), (202402, 3, 1, "d"))

    def dies(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(months, "_commit", dies)
        with pytest.raises(OSError, match="gone"):
            merge(spark, newer, path)
    assert content(months.read(spark, path)) == before
    merge(spark, newer, path)
    assert content(months.read(spark, path)) == [(202401, 1, "c"), (202402, 2, "b"), (202402, 3, "d")]


def test_a_reader_beside_a_merge_sees_one_version(spark, tmp_path):
    path = str(tmp_path / "s")
    merge(spark, rows(spark, (202401, 1, 1, "a"), (202402, 2, 1, "b")), path)
    old, before = months.read(spark, path), months.current(spark, path).n
    merge(spark, rows(spark, (202401, 1, 2, "c"), (202402, 2, 2, "d")), path)
    assert content(old) == [(202401, 1, "a"), (202402, 2, "b")] == content(months.read(spark, path, n=before))
    assert content(months.read(spark, path, months=[202402])) == [(202402, 2, "d")]
    months.vacuum(spark, path, 1)
    assert content(months.read(spark, path)) == [(202401, 1, "c"), (202402, 2, "d")]
    with pytest.raises(FileNotFoundError, match="isn't kept"):
        months.read(spark, path, n=before)


def test_a_batch_counts_once(spark, tmp_path):
    """A micro-batch that is run again, after its commit or before it."""
    path, t = str(tmp_path / "s"), rows(spark, (202401, 1, 1, "a"))
    assert months.append(spark, t, path, ["k"], ("s", 0))
    assert not months.append(spark, t, path, ["k"], ("s", 0))
    assert months.append(spark, t, path, ["k"], ("other", 0)) and months.read(spark, path).count() == 2
    leftover = f"{path}/data/part=bs-{1:012d}"
    t.write.partitionBy("ym").parquet(leftover)  # of a writer that died before its commit
    assert months.read(spark, path).count() == 2
    months.append(spark, t, path, ["k"], ("s", 1))
    assert months.read(spark, path).count() == 3
    merge(spark, rows(spark, (202401, 1, 5, "z")), path, batch=("s", 1))  # it was done
    assert content(months.read(spark, path)) == [(202401, 1, "a")] * 3


def test_two_writers_are_found_out(spark, tmp_path):
    path = str(tmp_path / "s")
    merge(spark, rows(spark, (202401, 1, 1, "a")), path)
    now = months.current(spark, path)
    months._commit(spark, path, now)
    with pytest.raises(RuntimeError, match="two writers"):
        months._commit(spark, path, now)


def test_rows_without_month_and_empty_batches(spark, tmp_path):
    path = str(tmp_path / "s")
    months.append(spark, rows(spark), path, ["k"])
    assert content(months.read(spark, path)) == []
    months.append(spark, rows(spark, (None, 1, 1, "a")), path, ["k"])
    merge(spark, rows(spark, (None, 1, 2, "b")), path)
    merge(spark, rows(spark), path)
    assert content(months.read(spark, path)) == [(None, 1, "b")]


def test_serving_follows_a_raw_dataset_that_is_rewritten(spark, tmp_path):
    topic = str(tmp_path / "topic")
    t = TableJobs(TableSpec.builder("t").column("id").key("id").build(), str(tmp_path / "t"), {"id": F.col("offset").cast("string")}, raw_days=5, serving_days=400)
    now = F.lit(DAY(2024, 1, 12)).cast("timestamp_ntz")
    for batch, at in enumerate((DAY(2024, 1, 12), DAY(2024, 1, 30))):
        add_to_topic(spark, topic, *[(10 * batch + i, DAY(2024, 1, 1 + i)) for i in range(3)])
        t.land_raw(topic_stream(spark, topic), now if not batch else F.lit(at).cast("timestamp_ntz")).awaitTermination()
        t.land_serving(spark, F.col("__ingest_ts")).awaitTermination()
        t.retire(spark, DAY(2024, 2, 1))
    assert sorted(r["id"] for r in months.read(spark, t.path("serving")).collect()) == ["0", "1", "10", "11", "12", "2"]
    assert sorted(r["id"] for r in months.read(spark, t.path("raw")).collect()) == ["10", "11", "12"]
    assert t.audit(spark).first()["min_offset"] == 10 and os.path.isdir(t.path("raw") + "/manifests")
