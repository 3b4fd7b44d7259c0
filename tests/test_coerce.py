"""Coercion over all kinds: unions, defaults, maps, records; types that can't be of a kind; assembly by schema files."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellstream.functions import coerce
from cellstream.functions.coerce import Default, coerced, kind_of
from cellstream.operators import cells
from cellstream.sources import catalog
from cellstream.spec import TableSpec


def test_texts_that_are_no_numbers_are_not_tried(spark):
    texts = ["7", " +7\t", "-0", "7x", "x", "", " ", ".", "1.5", "1e3", "1E+3", "1d", "2.5F", "0x1p3", "NaN", "nan", "inf", "-Infinity", "+inf", "yes", "TRUE", "9" * 25, "1 2", "--1", "\u0667", None]
    t = spark.createDataFrame([(x,) for x in texts], "v string")
    for kind, of in coerce.NUMBERS.items():
        got = t.select(coerce.number(F.col("v"), kind).cast("string").alias("a"), F.col("v").try_cast(of).cast("string").alias("b"), F.col("v").rlike(coerce._NUMBER).alias("tried"), "v").collect()
        assert [r["a"] for r in got] == [r["b"] for r in got]
        assert {r["v"] for r in got if r["tried"] is False} >= {"7x", "x", "", "yes", "TRUE", "1 2", "--1"}
    other = spark.createDataFrame([(1.5, True)], "d double, b boolean").select(coerce.number(F.col("d"), "long"), coerce.number(F.col("b"), "int")).first()
    assert tuple(other) == (1, 1)


def run(spark, values, of, kind, **more):
    """Values of a type through a kind: what they become and the errors."""
    t = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", T.DataType.fromDDL(of))]))
    value, error = coerced(F.col("v"), kind, "f", t.schema["v"].dataType, **more)
    out = t.select(value.alias("v"), error.alias("e"))
    assert out.schema["v"].dataType.simpleString() == coerce.spark_type(kind).simpleString()
    rows = out.collect()
    return [r["v"].asDict(True) if isinstance(r["v"], T.Row) else r["v"] for r in rows], [r["e"] for r in rows]


EVERY = ("union", "null", "int", "float", "bytes", ("enum", "A", "B"), ("array", "long"), ("map", "double"), {"x": "long", "y": "string"})


@pytest.mark.parametrize(
    ("of", "values", "branch", "typed"),
    [
        ("int", [7, None], "int", 7), ("double", [1.5, None], "float", 1.5), ("binary", [b"xy", None], "bytes", b"xy"), ("string", ["B", None], "enum", "B"),
        ("struct<x: int, y: string>", [(3, "b"), None], "record", {"x": 3, "y": "b"}), ("array<int>", [[1, None, 2], None], "array", [1, None, 2]), ("map<string, int>", [{"k": 2}, None], "map", {"k": 2.0}),
    ],
)
def test_union_of_every_kind(spark, of, values, branch, typed):
    kinds = EVERY if of != "double" else ("union", "null", "float", "bytes")
    (value, none), errors = run(spark, values, of, kinds, strict=True)
    assert value["branch"] == branch and value[branch] == typed and errors == [None, None] and none is None
    assert all(v is None for k, v in value.items() if k not in ("branch", branch))


def test_union_without_a_branch_that_fits(spark):
    assert run(spark, ["C", None, "A"], "string", EVERY, strict=True)[1] == ["f: no branch fits", None, None]
    assert run(spark, [None], "string", ("union", "long", "string"))[1] == ["f: required"]
    values, errors = run(spark, ["x", "12"], "string", ("union", "long", ("array", "long"), ("array", "string"), "string"))
    assert [v["branch"] for v in values] == ["string", "long"] and values[1]["long"] == 12 and "array2" in values[0] and errors == [None, None]


def test_strict_numbers(spark):
    assert run(spark, ["1"], "string", "long", strict=True) == ([None], ["f: not a long, but string"])
    assert run(spark, ["1"], "string", ("union", "long", "boolean", "string"), strict=True)[0][0]["branch"] == "boolean"
    assert run(spark, [1, 0, 2], "int", "boolean") == ([True, False, None], [None, None, "f: not a boolean: 2"])
    assert run(spark, [5], "bigint", "string") == ([None], ["f: not a string, but bigint"])


def test_maps_that_may_be_null(spark):
    assert run(spark, [None, {"b": "1", "a": "x"}], "map<string, string>", ("union", "null", ("map", "long")))[1] == [None, "f.a: not a long"]
    assert run(spark, [None], "map<string, string>", ("map", "long"))[1] == ["f: required"]
    values, _ = run(spark, [{2: {"n": "1"}, 1: {"n": None}}], "map<int, struct<n: string>>", ("map", {"n": "long"}))
    assert [(k, v["n"]) for k, v in values[0].items()] == [("1", None), ("2", 1)]


def test_paths_of_nested_faults(spark):
    kind = {"a": ("array", {"m": ("map", ("array", "long"))})}
    of = "struct<a: array<struct<m: map<string, array<string>>>>>"
    rows = [([({"k": ["1"]},), ({"k": ["1"], "z": ["1", "x"]},)],), ([(None,)],), ([None],), (None,)]
    assert run(spark, rows, of, kind)[1] == ["f.a[1].m.z[1]: not a long", "f.a[0].m: required", None, None]


def test_record_defaults(spark):
    schema = {"type": "record", "name": "R", "fields": [
        {"name": "n", "type": "long", "default": 5}, {"name": "s", "type": ["string", "null"], "default": "d"}, {"name": "u", "type": ["long", "string", "null"], "default": 3}, {"name": "l", "type": {"type": "array", "items": "int"}, "default": [1, 2]},
        {"name": "b", "type": "bytes", "default": "ÿ"}, {"name": "r", "type": {"type": "record", "name": "Q", "fields": [{"name": "q", "type": "int", "default": 9}, {"name": "p", "type": "string"}]}, "default": {"p": "z"}},
        {"name": "m", "type": {"type": "map", "values": "long"}, "default": {"k": 1}}, {"name": "z", "type": ["null", "long"], "default": None},
    ]}
    kind = kind_of(schema)
    assert kind["n"] == Default("long", 5)
    whole = {"n": 5, "s": "d", "u": {"branch": "long", "long": 3, "string": None}, "l": [1, 2], "b": b"\xff", "r": {"q": 9, "p": "z"}, "m": {"k": 1}, "z": None}
    (value,), errors = run(spark, [(1,)], "struct<other: int>", kind)
    assert value == whole and errors == [None]
    # A null that is there stays; only what's absent gets its default.
    (a, b), errors = run(spark, [{"n": "7"}, {"n": None}], "map<string, string>", {"n": Default("long", 5), "k": Default("long", 6)})
    assert (a, b) == ({"n": 7, "k": 6}, {"n": None, "k": 6}) and errors == [None, None]
    assert run(spark, [(1,)], "struct<other: int>", {"m": ("map", "long")})[1] == ["f.m: required"]


def test_types_that_are_no_such_kind(spark):
    assert run(spark, ["x", None], "string", ("map", "long"))[1] == ["f: not a map, but string", "f: required"]
    assert run(spark, ["x"], "string", {"a": "long"})[1] == ["f: not a record, but string"]
    assert run(spark, [[1]], "array<int>", "long")[1] == ["f: not a long, but array<int>"]
    assert run(spark, [b"x"], "binary", ("enum", "x"))[1] == ["f: not a enum, but binary"]


def test_assembly_by_a_schema_file_of_unions_and_maps(spark):
    rows = catalog.catalog(spark, os.path.join(os.path.dirname(__file__), "schemas/v2"))
    spec = catalog.spec(rows, "shapes")
    kinds = {f.name: f.kind for f in spec.fields}
    assert kinds["either"] == ("union", "null", "string", "long") and kinds["other"] == ("union", "long", "null", "boolean") and kinds["aux"] == {"flag": "boolean"}
    assert kinds["counts"] == ("union", "null", ("map", "long")) and kinds["needed"] == ("map", "string") and kinds["tags"] == ("array", "string")
    assert {r["name"]: r["nullable"] for r in rows.collect()}["other"]

    def event(**values):
        c = [(b"k", "d", q, 1, False, v) for q, v in {"id_": b"x", **values}.items()]
        return cells.row_events(spark.createDataFrame([(1, 1, "t", c)], cells.ENTRY), spec).first()

    r = event(either=b"7", other=b"false", numbers=b"")
    assert tuple(r["either"]) == ("string", "7", None) and tuple(r["other"]) == ("boolean", None, False) and r["aux"] is None and r["counts"] is None
    assert r["_error"] == "shapes.needed: required"
    assert event(aux=b"{}")["_error"] == "shapes.aux: not a record, but string"
    assert event(counts=b"{}")["_error"] == "shapes.counts: not a map, but string"


def test_assembly_with_decoders_that_give_maps_and_records(spark):
    from cellstream.functions import decode

    decode.register("JSON COUNTS", lambda v: F.from_json(v.cast("string"), "map<string, string>"), spark_type="map<string, string>")
    decode.register("JSON PAIR", lambda v: F.from_json(v.cast("string"), "struct<a: string>"), spark_type="struct<a: string>")
    pair = {"a": "long", "b": Default("string", "none")}
    spec = TableSpec.builder("t").column("id").column("counts", ("map", "long"), "JSON COUNTS").column("pair", ("union", "string", pair), "JSON PAIR").key("id").build()

    def event(counts, pair):
        c = [(b"k", "d", "counts", 1, False, counts), (b"k", "d", "pair", 1, False, pair)]
        return cells.row_events(spark.createDataFrame([(1, 1, "t", c)], cells.ENTRY), spec).first()

    r = event(b'{"b": 2, "a": 1}', b'{"a": "3"}')
    assert list(r["counts"].items()) == [("a", 1), ("b", 2)] and r["pair"]["branch"] == "record" and tuple(r["pair"]["record"]) == (3, "none") and r["_error"] is None
    assert event(b'{"b": "x"}', b'{"a": "3"}')["_error"] == "t.counts.b: not a long"
    assert event(b"{}", b'{"a": "y"}')["_error"] == "t.pair: no branch fits"
