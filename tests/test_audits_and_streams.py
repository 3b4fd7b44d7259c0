"""Gap ranges, places, sketches, type matches, one-pass quarantine, observed totals, drift state, typed bodies."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellstream import scratch
from cellstream.functions import decode
from cellstream.functions.coerce import Default
from cellstream.operators import audit, cells, order, schemas, stats
from cellstream.operators.schemas import matched
from cellstream.plans import registry
from cellstream.sources import topics
from cellstream.spec import TableSpec
from cellstream.streaming import jobs

POSITION = "__kafka_partition int, __kafka_offset bigint"


def gaps_by_force(offsets):
    have = sorted(set(offsets))
    return [(a + 1, b - 1, b - a - 1) for a, b in zip(have, have[1:]) if b > a + 1]


@pytest.mark.parametrize("span", [1, 7, 64, 1 << 20])
def test_gap_ranges_of_a_hot_partition(spark, span):
    r = random.Random(span)
    offsets = [o for o in range(1000) if r.random() > 0.2 and not 300 <= o < 520] + [5, 5, 999, 5000]
    rows = [(0, o) for o in offsets] + [(1, 7), (2, 3), (2, 4)]
    got = audit.gap_ranges(spark.createDataFrame(rows, POSITION), span).collect()
    assert sorted((g["first_missing"], g["last_missing"], g["n_missing"]) for g in got) == gaps_by_force(offsets) and {g["__kafka_partition"] for g in got} == {0}
    assert audit.gap_ranges(spark.createDataFrame([], POSITION), span).count() == 0


def test_second_read_and_refill(spark):
    whole = spark.createDataFrame([(p, o, f"{p}-{o}") for p in (0, 1) for o in range(100)] + [(0, 20, "copy")], POSITION + ", x string")
    short = whole.where("__kafka_partition = 1 or __kafka_offset not in (0, 20, 21, 57, 99)")
    again = audit.second_read(audit.gap_ranges(short, 16)).collect()
    assert [tuple(a) for a in again] == [(0, 20, 58, 3)]
    assert topics.again([(a[0], a["start"], a["end"]) for a in again], "t") == {"startingOffsets": '{"t": {"0": 20}}', "endingOffsets": '{"t": {"0": 58}}'}
    assert sorted(r["x"] for r in audit.refill(whole, short, 16).collect()) == ["0-20", "0-21", "0-57", "copy"]


def test_places_over_all_keys(spark):
    values = [(random.Random(i).randbytes(3), i) for i in range(500)] + [(b"same", i) for i in range(500, 900)]
    t = spark.createDataFrame(values, "k binary, id long").repartition(7)
    got = {r["id"]: r["place"] for r in order.places(t, ["k", "id"]).collect()}
    assert got == {i: n + 1 for n, (_, i) in enumerate(sorted(values))}
    assert order.places(t.where("false"), ["k", "id"]).count() == 0


@pytest.mark.parametrize("span", [1, 10, 1 << 16])
def test_places_within_groups(spark, span):
    rows = [(g, k * 3 - 50) for g, n in (("hot", 200), ("b", 3), (None, 1)) for k in range(n)]
    got = sorted((tuple(r) for r in order.numbered(spark.createDataFrame(rows, "g string, k long").where("g is not null"), ["g"], "k", span).collect()))
    assert got == sorted((g, k, (k + 50) // 3 + 1) for g, k in rows if g)


def test_sketches_within_their_bound(spark):
    r = random.Random(3)
    rows = [("t", i % 5, *[1 if r.random() < 0.5 else None for _ in range(40)]) for i in range(4000)] + [("one", 1, *[None] * 40)]
    columns = [f"c{i}" for i in range(40)]
    t = spark.createDataFrame(rows, "table string, month int, " + ", ".join(f"{c} int" for c in columns))
    sketches = stats.fill_sketches(t, columns, ["table", "month"], k=200)
    assert sketches.count() == 6
    got = {x["table"]: x for x in stats.capacity(sketches, spark.createDataFrame([("t", 3, 2)], "table string, n_pk int, n_meta int")).collect()}
    filled = sorted(sum(v is not None for v in x[2:]) for x in rows[:-1])
    share = lambda n: (sum(f < n for f in filled) / len(filled), sum(f <= n for f in filled) / len(filled))
    for column, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
        below, up_to = share(got["t"][column])
        assert below - 0.03 <= q <= up_to + 0.03
    assert got["t"]["suggested"] == got["t"]["p95"] + 5 and (got["one"]["p95"], got["one"]["suggested"], got["one"]["n_rows"]) == (0, 0, 1)


@pytest.mark.parametrize(
    ("kind", "target", "status"),
    [
        ("long", "bigint", "there"), ("int", "bigint", "widened"), ("long", "int", "mismatch"), ("long", "double", "mismatch"), ("int", "double", "widened"), ("float", "double", "widened"), ("double", "float", "mismatch"),
        ("long", "decimal(19,0)", "widened"), ("long", "decimal(20,4)", "mismatch"), ("boolean", "tinyint", "widened"), ("string", "binary", "mismatch"), (("enum", "A"), "string", "there"), (("fixed", 2), "binary", "there"),
        (("array", "int"), "array<bigint>", "widened"), (("array", "int"), "bigint", "mismatch"), (("map", ("array", "long")), "map<string,array<int>>", "mismatch"), (("map", "long"), "map<int,bigint>", "mismatch"), (("union", "null", "int"), "int", "there"),
        ({"a": "int", "b": "string"}, "struct<a:bigint,b:string>", "widened"), ({"a": "int", "b": "string"}, "struct<a:int>", "narrowed"), ({"a": "int"}, "struct<a:int,b:string>", "widened"), ({"a": {"b": ("array", {"c": "long"})}}, "struct<a:struct<b:array<struct<c:string>>>>", "mismatch"),
        ({"a": Default("int", 1)}, "struct<A:int>", "there"), (("union", "long", "string"), "struct<branch:string,long:bigint,string:string>", "there"), (("union", "long", "string"), "string", "mismatch"),
    ],
)
def test_type_matches(spark, kind, target, status):
    assert matched(kind, T.DataType.fromDDL(target)) == status


def test_coverage_by_roles_and_types(spark):
    row = lambda pos, name, of, pk=None, skip=False: ("t", pos, name, of, False, "VARCHAR", skip, pk, 0, "default", None, [])
    rows = [row(0, "id", "string", 1), row(1, "n", "int"), row(2, "r", '{"type": "record", "name": "R", "fields": [{"name": "x", "type": ["null", "long"]}]}'), row(3, "hidden", "string", skip=True), row(4, "gone", "long"), row(5, "_event_ts", "long"), row(6, "text", "string")]
    catalog = spark.createDataFrame(rows, "table string, pos int, name string, record_type string, nullable boolean, source_type string, skip boolean, pk_pos int, salt int, salt_source string, hint int, families array<string>")
    target = T.StructType.fromDDL("id string, N bigint, r struct<x: bigint, y: int>, _event_ts int, text binary, more int")
    got = {x["name"]: (x["role"], x["status"]) for x in schemas.coverage(catalog, "T", target).collect()}
    assert got == {"id": ("pk", "there"), "n": ("value", "widened"), "r": ("value", "widened"), "hidden": ("value", "skipped"), "gone": ("value", "missing"), "_event_ts": ("meta", "mismatch"), "text": ("value", "mismatch"), "more": (None, "extra")}
    assert stats.declared_columns(catalog).first().asDict() == {"table": "t", "n_pk": 1, "n_meta": 1, "hint": None}


def encoded(text):
    """A number in base-100 digits by the rules of the format, in plain Python."""
    d = Decimal(text)
    if not d:
        return b"\x80"
    digits, exponent = "".join(map(str, d.as_tuple().digits)), d.as_tuple().exponent
    if exponent % 2:
        digits, exponent = digits + "0", exponent - 1
    digits = digits.zfill(len(digits) + len(digits) % 2)
    pairs = [int(digits[i : i + 2]) for i in range(0, len(digits), 2)]
    power = exponent // 2 + len(pairs) - 1
    while pairs and not pairs[0]:
        pairs, power = pairs[1:], power - 1
    if d > 0:
        return bytes([128 + 65 + power] + [p + 1 for p in pairs])
    return bytes([255 - (128 + 65 + power)] + [101 - p for p in pairs] + [102])


def test_decimals_without_python(spark):
    given = ["0", "1", "-1", "99", "100", "-100.5", "0.01", "-0.0123", "123456789012345678", "-9999999999999999999999999999", "12345.6789", "1e20", "0.0000000001"]
    t = spark.createDataFrame([(i, bytearray(encoded(g))) for i, g in enumerate(given)] + [(98, bytearray(b"\xc1")), (99, None)], "i int, v binary").select("i", decode.decoded(F.col("v"), "DECIMAL").alias("d"))
    assert "Python" not in t._jdf.queryExecution().toString() and "Arrow" not in t._jdf.queryExecution().toString()
    got = {r["i"]: r["d"] for r in t.collect()}
    assert [got[i] for i in range(len(given))] == [Decimal(g) for g in given] and got[98] is None and got[99] is None


def test_quarantine_reads_its_source_once(spark, tmp_path):
    spark.range(20).write.parquet(str(tmp_path / "in"))
    events = spark.read.parquet(str(tmp_path / "in")).select("id", F.when(F.col("id") % 3 == 0, F.lit("broken")).alias("_error"))
    assert cells.marked(events)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    path = str(tmp_path / "out")
    cells.landed_split(events, path)
    assert sorted(r["id"] for r in cells.good_of(spark, path).collect()) == [i for i in range(20) if i % 3] and cells.broken_of(spark, path).where("_error = 'broken'").count() == 7
    assert "PartitionFilters: [isnotnull(quarantined" in cells.good_of(spark, path)._jdf.queryExecution().executedPlan().toString()


def log(spark, path, numbers):
    cell = lambda row, family: (row, family, "v", 1, False, b"x")
    spark.createDataFrame([(n, n, "t", [cell(b"a", "d"), cell(b"b", "z"), cell(b"b", "d"), cell(b"c", "z")][: n % 5]) for n in numbers], cells.ENTRY).write.mode("append").parquet(path)


def test_streams_split_and_count(spark, tmp_path):
    path, spec = str(tmp_path / "log"), TableSpec.builder("t").column("id").column("v", "long").key("id").only("d").build()
    log(spark, path, range(20))
    entries = spark.read.schema(cells.ENTRY).parquet(path)
    totals = {k: v for k, v in stats.run_totals(stats.entry_summary(entries, ["d"])).first().asDict().items()}
    assert entries.agg(*[c.alias(f"n_{n}") for n, c in stats.counters(["d"]).items()]).first().asDict() == {f"n_{k}": v for k, v in totals.items()}
    jobs.split_events(jobs.change_log(spark, path), spec, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert cells.good_of(spark, str(tmp_path / "out")).count() == 0 and cells.broken_of(spark, str(tmp_path / "out")).count() == totals["rows"] - totals["filtered"]


def test_drift_is_kept_between_runs(spark, tmp_path):
    schema, topic, out = "subject string, part int, seq bigint, fingerprint string", str(tmp_path / "t"), str(tmp_path / "o")
    runs = [[("s", 0, 1, "a"), ("s", 0, 2, "a"), ("s", 0, 3, "b"), ("u", 0, 1, None)], [("s", 0, 2, "a"), ("s", 0, 4, "b"), ("s", 1, 4, "c")], [("s", 0, 5, "a"), ("s", 1, 5, "c"), ("u", 0, 2, "x")]]
    for rows in runs:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(topic)
        jobs.schema_drift(spark.readStream.schema(schema).parquet(topic), out, str(tmp_path / "c")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [("s", 0, 3, "a", "b"), ("s", 0, 5, "b", "a")]


def test_typed_bodies_of_nested_kinds(spark):
    from cellstream.functions import envelope

    kinds = {"n": "long", "r": {"a": ("array", "int"), "m": ("union", "null", ("map", "double"))}, "e": Default(("enum", "A", "B"), "A")}
    bodies = ['{"n": 1, "r": {"a": [1, "2"], "m": {"k": 1.5}}}', '{"n": "2", "r": {"a": ["x"]}, "e": "C"}', "{", "[]", '{"e": "B"}']
    t = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string").select("i", envelope.framed(F.encode("b", "UTF-8"), F.lit(7)).alias("value"))
    got = topics.typed(t, kinds).orderBy("i").collect()
    assert [g["_error"] for g in got] == [None, "r.a[0]: not a int", "the body can't be read", "the body can't be read", None] and got[0]["schema_id"] == 7
    assert (got[0]["n"], got[0]["r"]["a"], got[0]["r"]["m"], got[0]["e"], got[4]["e"]) == (1, [1, 2], {"k": 1.5}, "A", "B")


def test_wide_specs_take_the_last_value_of_each_column(spark):
    names = [f"c{i}" for i in range(60)]
    spec = TableSpec.builder("t").column("id")
    for n in names:
        spec.column(n)
    spec = spec.key("id").build()
    written = [(b"k", "d", n.upper() if i % 2 else f" {n}", 1, False, f"{n}-{k}".encode()) for k in range(3) for i, n in enumerate(names)] + [(b"k", "d", "c0", 2, True, None), (b"k", "d", "other", 2, False, b"x")]
    r = cells.row_events(spark.createDataFrame([(1, 1, "t", written)], cells.ENTRY), spec).first()
    assert [r[n] for n in names] == [f"{n}-2" for n in names] and r["_error"] is None


def test_starts_of_runs_are_found_once_for_their_sizes(spark):
    entries = spark.createDataFrame([(1, 2, "t", [(b"a", "d", "q", 1, False, b"v"), (b"b", "x", "q", 1, False, b"v")])], cells.ENTRY)
    t = entries.agg(stats.counters(["d"])["filtered"].alias("n"))
    assert t._jdf.queryExecution().optimizedPlan().toString().count("sequence(0") == 1
    assert t.first()["n"] == 1


@pytest.mark.parametrize(("name", "batches", "least_files"), [("stream_totals", 4, 16), ("stream_resume", 2, 8)])
def test_micro_batches_take_a_file_for_each_core(spark, name, batches, least_files):
    """Files as many as tasks wrote, not one micro-batch for each."""
    folder = scratch.new_path(spark, "tables")
    spark.sql("select id as event_id, timestamp_ntz'2024-01-01' as ts, id as user_id, 'view' as event_type, 1.5D as value from range(2000)").write.parquet(f"{folder}/events.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with scratch.recorded() as made:
            registry.queries()[name](spark, folder).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    log, out = made
    assert len([f for f in scratch.names(spark, f"{out}-checkpoint/commits") if f.isdigit()]) == batches
    assert len([f for f in scratch.names(spark, log) if f.endswith(".parquet")]) >= least_files


def test_a_resumed_stream_takes_a_micro_batch_a_run_however_many_files(spark):
    folder = scratch.new_path(spark, "tables")
    spark.sql("select id as event_id, timestamp_ntz'2024-01-01' as ts, id as user_id, 'view' as event_type, 1.5D as value from range(2000)").write.parquet(f"{folder}/events.parquet")
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        with scratch.recorded() as made:
            found = registry.queries()["stream_resume"](spark, folder).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    log, out = made
    assert found > 0 and len([f for f in scratch.names(spark, log) if f.endswith(".parquet")]) == 18
    assert [f for f in scratch.names(spark, f"{out}-checkpoint/commits") if f.isdigit()] == ["0", "1"]
