import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from cellstream.functions import coerce, decode, encode, envelope, names
from cellstream.operators import landing, months, schemas
from cellstream.sources import catalog, topics
from cellstream.spec import TableSpec
from cellstream.template import TableJobs


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_source_types(spark):
    given = ["VARCHAR(100)", "DECIMAL(10,2)", "ARRAY<VARCHAR>", "VARCHAR[]", "  unsigned   int  ", "unsigned_int", "STRING", "UNKNOWN_TYPE", "", "BIGINT ARRAY"]
    want = ["VARCHAR", "DECIMAL", "VARCHAR ARRAY", "VARCHAR ARRAY", "UNSIGNED INT", "UNSIGNED INT", "VARCHAR", "VARCHAR", "VARCHAR", "VARCHAR"]
    assert [r["t"] for r in column(spark, given).select(names.source_type(F.col("v")).alias("t")).collect()] == want


def test_topics(spark):
    t = spark.createDataFrame([("SALES", "RAW_ORDERS"), ("default", "A"), ("default", "../????")], "n string, q string")
    assert [r[0] for r in t.select(names.topic(F.col("n"), F.col("q"))).collect()] == ["SALES_RAW_ORDERS", "A", "/____".replace("/", "_")]
    assert t.select(names.topic(F.lit("default"), F.lit("../????"), longest=3)).first()[0] == "___"
    assert t.select(names.topic(F.lit("default"), F.lit("x"), "${namespace}")).first()[0] == "topic"
    valid = column(spark, ["a.b-c_1", "..", ".", "", "a b", "ж", None, "x" * 250]).select(names.topic_valid(F.col("v")).alias("ok")).collect()
    assert [r["ok"] for r in valid] == [True, False, False, False, False, True, False, False]


def test_subjects_and_names(spark):
    t = spark.range(1)
    assert t.select(names.subject(F.lit("ns"), F.lit("Tab"), "no-such-strategy")).first()[0] == "ns:Tab-value"
    assert [r[0] for r in column(spark, [" value\x01", "ID", "É9"]).select(names.column_name(F.col("v"))).collect()] == ["VALUE", "ID", "É9"]
    assert t.select(names.clean_list(F.lit(" d, b ,d,,D"))).first()[0] == ["d", "b", "D"]


def test_booleans(spark):
    v, e = coerce.boolean(F.col("v"), "f")
    rows = column(spark, ["true", "TRUE", " 1 ", "false", "0", "not-a-bool", None]).select(v.alias("v"), e.alias("e")).collect()
    assert [r["v"] for r in rows] == [True, True, True, False, False, None, None]
    assert [bool(r["e"]) for r in rows] == [False] * 5 + [True, False]


def test_narrowing(spark):
    t = column(spark, [0, 127, 128, 255, 256, -1, None], "bigint")
    wrap = [r[0] for r in t.select(coerce.narrowed(F.col("v"), 8)).collect()]
    assert wrap == [0, 127, -128, -1, 0, -1, None]
    assert [r[0] for r in t.select(coerce.narrowed(F.col("v"), 8, False, "null")).collect()] == [0, 127, 128, 255, None, None, None]
    with pytest.raises(Exception, match="out of range"):
        t.select(coerce.narrowed(F.col("v"), 8, True, "fail")).collect()


def test_integers_out_of_range_keep_their_low_bytes(spark):
    t = column(spark, [32767, 32768, 146768, -32769, 7], "bigint")
    back = lambda width, signed, kind: [r[0] for r in t.select(decode.decoded(encode.integer(F.col("v"), width, signed), kind)).collect()]
    assert back(2, True, "SMALLINT") == [32767, -32768, 15696, 32767, 7]
    assert back(2, False, "UNSIGNED SMALLINT") == [32767, 32768, 15696, 32767, 7]


def test_maps_in_any_order_are_one(spark):
    t = spark.range(1).select(coerce.sorted_map(F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.lit(2))).alias("x"), coerce.sorted_map(F.create_map(F.lit("a"), F.lit(2), F.lit("b"), F.lit(1))).alias("y"))
    assert list(t.first()["x"].items()) == list(t.first()["y"].items()) == [("a", 2), ("b", 1)]


def test_frames(spark):
    t = column(spark, [b"body", b""], "binary").select(envelope.framed(F.col("v"), F.lit(258)).alias("f"))
    assert [bytes(r["f"]) for r in t.collect()] == [b"\x00\x00\x00\x01\x02body", b"\x00\x00\x00\x01\x02"]
    i, b, e = envelope.unframed(F.col("v"))
    rows = column(spark, [b"\x00\x00\x00\x01\x02x", b"\x01\x00\x00\x01\x02x", b"\x00\x01", None], "binary").select(i.alias("i"), b.alias("b"), e.alias("e")).collect()
    assert [r["i"] for r in rows] == [258, None, None, None] and [bool(r["e"]) for r in rows] == [False, True, True, False]


def test_catalog(spark):
    rows = catalog.catalog(spark, os.path.join(os.path.dirname(__file__), "schemas/v1"))
    t = {r["name"]: r for r in rows.where("table = 'trade'").collect()}
    assert (t["id"]["pk_pos"], t["at"]["pk_pos"], t["price"]["pk_pos"]) == (1, 2, None)
    assert (t["at"]["source_type"], t["price"]["source_type"], t["tags"]["source_type"]) == ("TIMESTAMP", "DECIMAL", "VARCHAR ARRAY")
    assert t["secret"]["skip"] and t["price"]["nullable"] and not t["id"]["nullable"]
    spec = catalog.spec(rows, "TRADE")
    assert (spec.pk, spec.salt, spec.families, spec.hint) == (("id", "at"), 1, ("d", "b"), 16)
    plain = catalog.spec(rows, "plain")
    assert (plain.pk, plain.salt, plain.families, plain.hint) == (("id",), 8, (), None)
    assert [(r["table"], r["family"]) for r in catalog.families_of(rows).collect()] == [("plain", "0"), ("trade", "b"), ("trade", "d")]
    with pytest.raises(KeyError):
        catalog.spec(rows, "absent")
    covered = {r["name"]: r["status"] for r in schemas.coverage(rows, "plain", spark.range(1).select(F.lit("x").alias("id"), F.lit(1).alias("ver")).schema).collect()}
    assert covered == {"id": "there", "note": "missing", "ver": "extra"}
    assert schemas.drift(rows, rows).count() == 0 and schemas.diff(rows, rows).count() == 0


def test_sink_options():
    o = topics.options("h:1", linger_ms=100, acks="0", unknown_key="x", max_in_flight_requests_per_connection="50")
    assert o["kafka.acks"] == "all" and o["kafka.linger.ms"] == "100" and o["kafka.max.in.flight.requests.per.connection"] == "5" and "kafka.unknown.key" not in o


def test_latest_is_the_same_in_any_order(spark):
    rows = [(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, 1, None)]
    a, b = (sorted(map(tuple, landing.latest(spark.createDataFrame(r, "k int, ver int, x string"), ["k"], "ver").collect()), key=str) for r in (rows, rows[::-1]))
    assert a == b == [(1, 7, "c"), (2, 1, None)]


def test_merge_twice_changes_nothing(spark, tmp_path):
    t = spark.createDataFrame([(202401, 1, 1, "a"), (202402, 2, 1, "b")], "ym int, k int, ver int, x string")
    newer = spark.createDataFrame([(202402, 2, 2, "c")], "ym int, k int, ver int, x string")
    path = str(tmp_path / "s")
    for part in (t, newer, t, newer):
        landing.merge_months(spark, part, path, ["k"], "ver")
    assert sorted((r["k"], r["x"]) for r in months.read(spark, path).collect()) == [(1, "a"), (2, "c")]


def test_retention_drops_months_and_rewrites_one(spark, tmp_path):
    path, day = str(tmp_path / "r"), datetime.datetime
    rows = [(1, day(2023, 12, 5)), (2, day(2024, 1, 10)), (3, day(2024, 1, 20)), (4, day(2024, 2, 1)), (5, None)]
    t = spark.createDataFrame(rows, "k int, at timestamp_ntz").withColumn("ym", (F.year("at") * 100 + F.month("at")).cast("int"))
    months.append(spark, t, path, ["k"])
    for as_of, left in ((day(2024, 1, 30), [3, 4, 5]), (day(2024, 1, 30), [3, 4, 5]), (day(2024, 2, 10), [4, 5]), (day(2024, 2, 25), [5])):
        months.retire(spark, path, 15, as_of, ["at"], ["k"])
        assert sorted(r["k"] for r in months.read(spark, path).collect()) == left


def test_template_lands_retires_and_audits(spark, tmp_path):
    day = datetime.datetime
    topic = [(0, i, day(2024, 1, 1 + i)) for i in (0, 1, 3)] + [(0, 3, day(2024, 1, 4))]
    rows = spark.createDataFrame(topic, "partition int, offset bigint, timestamp timestamp_ntz")
    rows.write.parquet(str(tmp_path / "topic"))
    jobs = TableJobs(TableSpec.builder("t").column("id").key("id").build(), str(tmp_path / "t"), {"id": F.col("offset").cast("string")}, raw_days=30, serving_days=10)
    now = F.lit(day(2024, 1, 12)).cast("timestamp_ntz")
    jobs.land_raw(topics.read(spark, str(tmp_path / "topic"), schema="partition int, offset bigint, timestamp timestamp_ntz", streaming=True), now).awaitTermination()
    jobs.land_serving(spark, F.col("__ingest_ts")).awaitTermination()
    a = jobs.audit(spark).first()
    assert (a["max_offset"], a["missing_offsets"], a["duplicates"]) == (3, 1, 1)
    jobs.retire(spark, day(2024, 1, 12, 12))
    assert months.read(spark, jobs.path("raw")).count() == 4
    assert [r["id"] for r in months.read(spark, jobs.path("serving")).collect()] == ["3"]


def test_kinds_of_schema_files_and_their_errors(spark):
    kind = coerce.kind_of(json.loads('''{"type": "record", "fields": [{"name": "m", "type": {"type": "map", "values": "long"}}, {"name": "e", "type": ["null", {"type": "enum", "symbols": ["A"]}]},
        {"name": "f", "type": {"type": "fixed", "size": 2}}, {"name": "u", "type": ["null", "long", "string"]}]}'''))
    assert kind == {"m": ("map", "long"), "e": ("enum", "A"), "f": ("fixed", 2), "u": ("union", "null", "long", "string")}
    schema = "r struct<m: map<string, string>, e: string, f: binary, u: string>"
    rows = [({"b": "1", "a": "2"}, "A", b"xy", "7"), ({"b": "x"}, "A", b"xy", "z"), (None, None, None, None), ({}, "B", b"xy", None), ({}, "A", b"x", None)]
    value, error = coerce.record(F.col("r"), kind)
    got = spark.createDataFrame([(r,) for r in rows], schema).select(value.alias("v"), error.alias("e")).collect()
    assert [r["e"] for r in got] == [None, "m.b: not a long", "m: required", "e: not a symbol: B", "f: 2 bytes expected, got 1"]
    assert list(got[0]["v"]["m"].items()) == [("a", 2), ("b", 1)] and tuple(got[0]["v"]["u"]) == ("long", 7, None) and tuple(got[1]["v"]["u"]) == ("string", None, "z")
    with pytest.raises(ValueError, match="no such kind"):
        coerce.coerced(F.lit(1), "complex", "f")
