"""Literal cells to row events: the unit cases of capture."""

import pytest
from pyspark.sql import functions as F

from cellstream import scratch
from cellstream.functions import decode, encode, rowkey
from cellstream.operators import cells, stats
from cellstream.operators.cells import ENTRY
from cellstream.spec import TableSpec

SPEC = (
    TableSpec.builder("t").column("id").column("version", "long", "BIGINT").column("payload", "bytes", "VARBINARY").column("hidden", skip=True)
    .column("_event_ts").column("_delete").column("_wal_seq").column("_wal_write_time").key("id").build()
)


def cell(row, q, ts, value=b"", family="d", deleted=False):
    return (row, family, q, ts, deleted, value)


def entries(spark, *lists):
    return spark.createDataFrame([(777 + i, 888, "t", c) for i, c in enumerate(lists)], ENTRY)


def long(n):
    return (n + (1 << 63)).to_bytes(8, "big")


def one(spark, *c, spec=SPEC):
    return cells.row_events(entries(spark, list(c)), spec).first()


def test_row_with_meta_columns(spark):
    r = one(spark, cell(b"rk", "version", 123, long(7)), cell(b"rk", " PAYLOAD", 321, b"xyz"))
    assert (r["id"], r["version"], bytes(r["payload"]), r["_event_ts"], r["_delete"], r["_wal_seq"], r["_wal_write_time"]) == ("rk", 7, b"xyz", 321, False, 777, 888)
    assert "hidden" not in r.asDict()


def test_put_and_delete(spark):
    r = one(spark, cell(b"rk", "version", 100, long(5)), cell(b"rk", "version", 200, deleted=True))
    assert (r["version"], r["_event_ts"], r["_delete"]) == (5, 200, True)


def test_last_value_in_cell_order_whatever_its_time(spark):
    r = one(spark, cell(b"rk", "version", 300, long(1)), cell(b"rk", "version", 100, long(2), family="z"), cell(b"rk", "version", 400, b""))
    assert (r["version"], r["_event_ts"]) == (2, 400)


def test_no_value_leaks_into_the_next_row(spark):
    rows = cells.row_events(entries(spark, [cell(b"a", "version", 1, long(1)), cell(b"a", "x", 2, deleted=True), cell(b"b", "payload", 3, b"p")]), SPEC).orderBy("run_idx").collect()
    assert [(r["id"], r["version"], r["_delete"]) for r in rows] == [("a", 1, True), ("b", None, False)]


def test_runs_are_of_neighbours_within_an_entry(spark):
    t = cells.runs(entries(spark, [cell(k, "q", 1) for k in (b"a", b"b", b"b", b"a")], [cell(b"a", "q", 1)], []))
    assert sorted((r["wal_seq"], r["run_idx"], len(r["run"])) for r in t.collect()) == [(777, 0, 1), (777, 1, 2), (777, 2, 1), (778, 0, 1)]
    flat = cells.runs_of_flat(cells.flat(entries(spark, [cell(k, "q", 1) for k in (b"a", b"b", b"b", b"a")])))
    assert [r["run_idx"] for r in flat.orderBy("cell_idx").collect()] == [0, 1, 1, 2]


def test_salted_keys(spark):
    salted = TableSpec("t", SPEC.fields, ("id",), salt=1)
    assert one(spark, cell(b"\x7fid-salt", "version", 1, long(1)), spec=salted)["id"] == "id-salt"
    assert "not in the row key" in one(spark, cell(b"\x7f", "version", 1, long(1)), spec=salted)["_error"]
    assert "no row key" in one(spark, cell(None, "version", 1, long(1)))["_error"]


@pytest.mark.parametrize("kind", ["TINYINT", "SMALLINT", "INTEGER", "BIGINT"])
def test_values_of_a_wrong_size(spark, kind):
    n = decode.WIDTHS[kind]
    spec = TableSpec.builder("t").column("id").column("v", "long", kind).key("id").build()
    r = one(spark, cell(b"k", "v", 1, b"\x80" * (n + 1)), spec=spec)
    assert r["v"] is None and r["_error"] == f"t.v: {kind} has {n} bytes, got {n + 1}"


def test_errors_are_split_or_raised(spark):
    t = cells.row_events(entries(spark, [cell(b"k", "version", 1, b"123")], [cell(b"k", "version", 1, long(3))]), SPEC)
    good, bad = cells.split_errors(t)
    assert (good.count(), bad.count()) == (1, 1)
    with pytest.raises(Exception, match="BIGINT has 8 bytes"):
        cells.split_errors(t, "fail")[0].collect()


def test_family_filter_keeps_whole_rows(spark):
    e = entries(spark, [cell(b"a", "q", 1, b"1", "d"), cell(b"a", "q", 1, b"1", "x"), cell(b"b", "q", 1, b"1", "D")])
    s = stats.entry_summary(e, ["d"]).first()
    assert (s["rows_seen"], s["rows_sent"], s["rows_filtered"], s["cells_seen"], s["max_cells_sent"]) == (2, 1, 1, 3, 2)
    assert stats.entry_summary(e, []).first()["rows_sent"] == 2


def test_diagnostics_flags(spark):
    e = entries(spark, *[[cell(b"k%d" % i, "q", 1, b"1", "x" if i % 20 else "d")] for i in range(1000)])
    options = spark.createDataFrame([("t", 4, 6)], "table string, salt int, hint int")
    d = stats.diagnostics(e, options, ["d"]).first()
    assert d["flag_filter_tight"] and not d["flag_filter_idle"] and d["short_keys"] == 1000 and not d["flag_hint"]


def test_key_of_fixed_part_too_short_gives_nothing(spark):
    t = spark.createDataFrame([(b"ab",), (b"abcd",)], "key binary")
    out = t.select(rowkey.split(F.col("key"), [("n", "UNSIGNED INT")])["n"].alias("n")).collect()
    assert [r["n"] for r in out] == [None, 0x61626364]


def test_escapes_and_preview(spark):
    t = spark.createDataFrame([(b"a\x00\xffb",)], "k binary").select(F.concat(rowkey.escaped(F.col("k")), F.lit(b"\x00"), F.lit(b"tail")).alias("k"))
    out = rowkey.split(F.col("k"), [("a", "VARBINARY"), ("b", "VARCHAR")])
    r = t.select(out["a"].alias("a"), out["b"].alias("b"), rowkey.preview(F.col("k"), 4).alias("p")).first()
    assert (bytes(r["a"]), r["b"], r["p"]) == (b"a\x00\xffb", "tail", "61ff00ff..")


def test_own_decoder(spark):
    decode.register("REVERSED", lambda v: F.reverse(F.decode(v, "UTF-8")), 3)
    spec = TableSpec.builder("t").column("id").column("v", "string", "REVERSED").key("id").build()
    assert one(spark, cell(b"k", "v", 1, b"abc"), spec=spec)["v"] == "cba"
    del decode.DECODERS["REVERSED"], decode.WIDTHS["REVERSED"]


def test_numbers_round_trip(spark):
    import math

    xs = [0.0, -0.0, 1.5, -1.5, 1e300, -1e-300, math.pi]
    t = spark.createDataFrame([(x,) for x in xs], "x double").select("x", encode.real(F.col("x"), 8).alias("b"))
    assert [r["y"] for r in t.select(decode.decoded(F.col("b"), "DOUBLE").alias("y")).collect()] == xs
    assert [r["x"] for r in t.orderBy("b").collect()] == sorted(xs)


def test_spec_checks():
    with pytest.raises(ValueError):
        TableSpec.builder("t").column("id", skip=True).key("id").build()
    with pytest.raises(ValueError):
        TableSpec.builder("t").column("id").key("other").build()
    assert TableSpec("t", SPEC.fields, ("id", "ID"), salt=99, families=("d", "D ", ""), hint=-1) == TableSpec("t", SPEC.fields, ("id",), 8, ("d",), None)


def test_text_that_is_not_utf8_does_not_end_the_job(spark):
    spec = TableSpec.builder("t").column("id").column("v").key("id").build()
    r = one(spark, cell(b"k", "v", 1, b"a\xffb"), spec=spec)
    assert (r["v"], r["_error"]) == ("a\ufffdb", None)


def test_values_come_to_the_kinds_of_their_fields(spark):
    spec = TableSpec.builder("t").column("id").column("n", "long").column("ok", "boolean").column("f", ("fixed", 2), "VARBINARY").column("b", "bytes", "INTEGER").key("id").build()
    r = one(spark, cell(b"k", "n", 1, b"12"), cell(b"k", "ok", 1, b" TRUE "), cell(b"k", "f", 1, b"xy"), cell(b"k", "b", 1, b"12345"), spec=spec)
    assert (r["n"], r["ok"], bytes(r["f"]), bytes(r["b"]), r["_error"]) == (12, True, b"xy", b"12345", None)
    assert one(spark, cell(b"k", "n", 1, b"12x"), spec=spec)["_error"] == "t.n: not a long: 12x"
    assert one(spark, cell(b"k", "f", 1, b"xyz"), spec=spec)["_error"] == "t.f: 2 bytes expected, got 3"


@pytest.mark.parametrize(("name", "once"), [("union_events", ["array(struct(row", "from_json(MapType", "from_json(StructField"]), ("coerced_events", ["array(struct(row"])])
def test_cells_and_decoded_values_are_evaluated_once(spark, name, once):
    from cellstream.plans import registry

    t = spark.createDataFrame([(1, 1, "A")], "l_orderkey bigint, l_linenumber int, l_returnflag string")
    folder = scratch.new_path(spark, "tables")
    t.write.parquet(f"{folder}/lineitem.parquet")
    plan = registry.queries()[name](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert {x: plan.count(x) for x in once} == dict.fromkeys(once, 1)
