"""Coercion of loosely typed values to record types: a value, or an error that names the field.

Kinds: "boolean", "int", "long", "float", "double", "string", "bytes"; {name: kind or Default} for a record; ("array", kind),
("map", kind), ("enum", *symbols), ("fixed", n), ("union", *kinds). A union of one kind beside null is that kind; a union of more
is a tagged value, a struct of the branch's name and, for each branch, a field of its kind, of which one isn't null.

Where the type of what is coerced is known (given), a value that can't be of a kind is an error of its row, not of the
query's plan.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBERS = {"long": "bigint", "int": "int", "double": "double", "float": "float"}
#: Text that may be a number; what isn't like it is none.
_NUMBER = r"^[\x00-\x20\x7f-\x9f]*+[+-]?+(?:[0-9.][0-9.eEdDfF+-]*+|0[xX][0-9a-fA-F.pP+-]*+|[nN][aA][nN]|[iI][nN][fF][a-zA-Z]*+)[\x00-\x20\x7f-\x9f]*+$"
PLAIN = NUMBERS | {"boolean": "boolean", "string": "string", "bytes": "binary"}


class Default(NamedTuple):
    """A record's field that has a value of its own where it is absent (not where it's null)."""

    kind: object
    value: object


def said(path: str | Column, text: str) -> Column:
    """path and text, as a column; paths with places of elements in them are columns themselves."""
    return F.lit(path + text) if isinstance(path, str) else F.concat(path, F.lit(text))


def _result(value: Column, given: Column, path: str | Column, what: str) -> tuple[Column, Column]:
    return value, F.when(given.isNotNull() & value.isNull(), F.concat(said(path, f": not {what}: "), given.cast("string")))


def number(v: Column, kind: str) -> Column:
    """v as a kind of number, or null. try_cast alone raises and catches an error for each text that is no number, so these aren't tried."""
    may_be = F.when(F.typeof(v) == "string", v.cast("string").rlike(_NUMBER)).otherwise(True)
    return F.when(may_be, v.try_cast(NUMBERS[kind]))


def boolean(v: Column, path: str = "") -> tuple[Column, Column]:
    """1, 0, true and false, in any case, without outer blanks; nothing else."""
    t = F.lower(F.trim(v.cast("string")))
    return _result(F.when(t.isin("1", "true"), True).when(t.isin("0", "false"), False), v, path, "a boolean")


def enum(v: Column, symbols: list[str], path: str = "") -> tuple[Column, Column]:
    return _result(F.when(v.isin(*symbols), v), v, path, "a symbol")


def fixed(v: Column, n: int, path: str = "") -> tuple[Column, Column]:
    value = F.when(F.octet_length(v) == n, v)
    return value, F.when(v.isNotNull() & value.isNull(), F.concat(said(path, f": {n} bytes expected, got "), F.octet_length(v).cast("string")))


def narrowed(v: Column, bits: int, signed: bool = True, policy: str = "wrap") -> Column:
    """An integer of fewer bits: wrap (modulo), null (out of range) or fail."""
    low, high = (-(1 << (bits - 1)), (1 << (bits - 1)) - 1) if signed else (0, (1 << bits) - 1)
    if policy == "wrap":
        m = F.pmod(v.cast("bigint"), F.lit(1 << bits))
        return F.when(m > high, m - (1 << bits)).otherwise(m)
    fits = v.between(low, high)
    return F.when(fits, v) if policy == "null" else F.when(v.isNull() | fits, v).otherwise(F.raise_error(F.concat(F.lit(f"out of range of {bits} bits: "), v.cast("string"))).cast("bigint"))


def union(v: Column, kinds: list[str], path: str = "") -> tuple[Column, Column, Column]:
    """The first of these kinds, all plain, that a text coerces to: its name, the value as text, the error. See one_of for unions of any kinds."""
    tries = {"boolean": lambda: boolean(v)[0].cast("string"), "long": lambda: number(v, "long").cast("string"), "double": lambda: number(v, "double").cast("string"), "string": lambda: v}
    cases = [(k, tries[k]()) for k in kinds if k != "null"]
    name = F.coalesce(*[F.when(c.isNotNull(), F.lit(k)) for k, c in cases])
    value = F.coalesce(*[c for _, c in cases])
    bad = v.isNotNull() & value.isNull() if "null" in kinds else value.isNull()
    return F.when(v.isNull() & F.lit("null" in kinds), F.lit("null")).otherwise(name), value, F.when(bad, F.lit(f"{path}: no branch fits"))


def sorted_map(m: Column) -> Column:
    """Keys as text, in order."""
    return F.map_from_entries(F.array_sort(F.map_entries(m)))


def _words(kind: object) -> str:
    """What a kind is called, in messages and as a branch."""
    if isinstance(kind, Default):
        return _words(kind.kind)
    return "record" if isinstance(kind, dict) else str(kind[0]) if isinstance(kind, (list, tuple)) else str(kind)


def _alone(kinds: list[object] | tuple) -> object | None:
    """The kind of a union that has one beside null."""
    some = [k for k in kinds if k != "null"]
    return some[0] if len(some) == 1 else None


def branches(kinds: list[object] | tuple) -> list[tuple[str, object]]:
    """Names and kinds of a union's branches, null left out; a second branch of the same name gets a number."""
    out: list[tuple[str, object]] = []
    for k in (k for k in kinds if k != "null"):
        same = sum(n.rstrip("0123456789") == _words(k) for n, _ in out)
        out.append((_words(k) + (str(same + 1) if same else ""), k))
    return out


def spark_type(kind: object) -> T.DataType:
    """The type of a kind's values."""
    if isinstance(kind, Default):
        return spark_type(kind.kind)
    if isinstance(kind, dict):
        return T.StructType([T.StructField(n, spark_type(k)) for n, k in kind.items()])
    if isinstance(kind, (list, tuple)):
        what, *of = kind
        if what == "union":
            one = _alone(of)
            return spark_type(one) if one is not None else T.StructType([T.StructField("branch", T.StringType()), *[T.StructField(n, spark_type(k)) for n, k in branches(of)]])
        return {"array": lambda: T.ArrayType(spark_type(of[0])), "map": lambda: T.MapType(T.StringType(), spark_type(of[0])), "enum": T.StringType, "fixed": T.BinaryType}[what]()
    return {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "float": T.FloatType(), "boolean": T.BooleanType(), "string": T.StringType(), "binary": T.BinaryType()}[PLAIN[str(kind)]]


def literal(value: object, kind: object) -> Column:
    """A default of a schema file, as a value of its kind; of a union, it is of the first branch. Bytes are written as text of one character a byte."""
    if value is None:
        return F.lit(None).cast(spark_type(kind))
    if isinstance(kind, dict):
        return F.struct(*[literal(value.get(n, k.value if isinstance(k, Default) else None), k.kind if isinstance(k, Default) else k).alias(n) for n, k in kind.items()])
    if isinstance(kind, (list, tuple)):
        what, *of = kind
        if what == "union":
            one = _alone(of)
            if one is not None:
                return literal(value, one)
            names = branches(of)
            return F.struct(F.lit(names[0][0]).alias("branch"), *[(literal(value, k) if not i else F.lit(None).cast(spark_type(k))).alias(n) for i, (n, k) in enumerate(names)])
        if what == "array":
            return F.array(*[literal(x, of[0]) for x in value]).cast(spark_type(kind))
        if what == "map":
            return F.create_map(*[c for k, x in sorted(value.items()) for c in (F.lit(k), literal(x, of[0]))]).cast(spark_type(kind))
        return F.lit(value.encode("latin-1") if what == "fixed" else value)
    return F.lit(value.encode("latin-1")) if kind == "bytes" else F.lit(value).cast(spark_type(kind))


def record(v: Column, schema: dict[str, object], path: str | Column = "", given: T.DataType | None = None, strict: bool = False) -> tuple[Column, Column]:
    """A struct by a schema of kinds, from a struct or a map by names, and the first error.

    Elements and fields are reported with their path; what can't be coerced is null. A field that the struct or map hasn't
    is its Default, or null.
    """
    values, errors = [], []
    for name, kind in schema.items():
        at = (f"{path}.{name}" if path else name) if isinstance(path, str) else F.concat(path, F.lit(f".{name}"))
        other, kind = (literal(kind.value, kind.kind), kind.kind) if isinstance(kind, Default) else (None, kind)
        if isinstance(given, T.StructType) and name not in given.fieldNames():
            absent, no = other if other is not None else F.lit(None).cast(spark_type(kind)), F.lit(None).cast("string")
            value, error = absent, (_required(kind, at) if other is None else no)
        else:
            value, error = coerced(v[name], kind, at, given[name].dataType if isinstance(given, T.StructType) else given.valueType if isinstance(given, T.MapType) else None, strict)
            if isinstance(given, T.MapType) and other is not None:
                here = F.map_contains_key(v, name)
                value, error = F.when(here, value).otherwise(other), F.when(here, error)
        values.append(value.alias(name))
        errors.append(error)
    return F.when(v.isNotNull(), F.struct(*values)), F.when(v.isNotNull(), F.coalesce(*errors))


def _required(kind: object, path: str | Column) -> Column:
    """What is wrong with a null of a kind: maps and unions without null must be there."""
    must = isinstance(kind, (list, tuple)) and (kind[0] == "map" or kind[0] == "union" and "null" not in kind)
    return said(path, ": required") if must else F.lit(None).cast("string")


def one_of(v: Column, kinds: list[object], path: str | Column, given: T.DataType | None = None, strict: bool = False) -> tuple[Column, Column]:
    """A value of a union: of one kind beside null the value itself, of more kinds a tagged value of the first branch that it fits."""
    missing = F.lit(None).cast("string") if "null" in kinds else said(path, ": required")
    one = _alone(kinds)
    if one is not None:
        value, error = coerced(v, one, path, given, strict)
        return F.when(v.isNotNull(), value), F.when(v.isNull(), missing).otherwise(error)
    names = branches(kinds)
    tried = [(n, k, *coerced(v, k, path, given, strict)) for n, k in names]
    # None and "" can't be told apart from a fault by the value alone, so branches go by their errors.
    # Only of numbers the value tells, and needs no message for it.
    first = F.coalesce(*[F.when(x.isNotNull() if isinstance(k, str) and k in NUMBERS and given is not None else error.isNull(), F.lit(n)) for n, k, x, error in tried])
    value = F.struct(first.alias("branch"), *[F.when(first == n, x).cast(spark_type(k)).alias(n) for n, k, x, _ in tried])
    return F.when(v.isNotNull() & first.isNotNull(), value), F.when(v.isNull(), missing).when(first.isNull(), said(path, ": no branch fits"))


def _inner(kind: object, error: Column, at: Column) -> Column:
    """The error of an element: for plain kinds its place and kind, else what is wrong within it."""
    return error if isinstance(kind, (dict, list, tuple)) else F.when(error.isNotNull(), F.concat(at, F.lit(f": not a {kind}")))


def each_value(m: Column, kind: object, path: str | Column, given: T.DataType | None = None, strict: bool = False) -> tuple[Column, Column]:
    """A map in order of its keys as text, its values coerced; a null map is an error, as are values that don't fit, by their key."""
    of = given.valueType if isinstance(given, T.MapType) else None
    at = lambda key: F.concat(said(path, "."), key)
    if isinstance(given, T.MapType) and isinstance(given.keyType, T.StringType) and isinstance(of, T.AtomicType):
        entries = F.sort_array(F.map_entries(m))
    else:
        entries = F.array_sort(F.transform(F.map_entries(m), lambda e: F.struct(e["key"].cast("string").alias("key"), e["value"].alias("value"))), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    value = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"].alias("key"), coerced(e["value"], kind, at(e["key"]), of, strict)[0].alias("value"))))
    wrong = F.filter(F.transform(entries, lambda e: _inner(kind, coerced(e["value"], kind, at(e["key"]), of, strict)[1], at(e["key"]))), lambda x: x.isNotNull())
    return value, F.when(m.isNull(), said(path, ": required")).otherwise(F.get(wrong, F.lit(0)))


def each_element(v: Column, kind: object, path: str | Column, given: T.DataType | None = None, strict: bool = False) -> tuple[Column, Column]:
    """An array, its elements coerced; those that don't fit are errors, by their place."""
    of = given.elementType if isinstance(given, T.ArrayType) else None
    at = lambda i: F.concat(said(path, "["), i.cast("string"), F.lit("]"))
    value = F.transform(v, lambda x, i: coerced(x, kind, at(i), of, strict)[0])
    wrong = F.filter(F.transform(v, lambda x, i: _inner(kind, coerced(x, kind, at(i), of, strict)[1], at(i))), lambda x: x.isNotNull())
    return value, F.get(wrong, F.lit(0))


def _fits(kind: object, given: T.DataType, strict: bool) -> bool:
    """Whether values of a type can be of a kind at all."""
    what = _words(kind)
    text, number, flat = isinstance(given, T.StringType), isinstance(given, T.NumericType), not isinstance(given, (T.StructType, T.MapType, T.ArrayType, T.BinaryType))
    return {
        "record": isinstance(given, (T.StructType, T.MapType)), "map": isinstance(given, T.MapType), "array": isinstance(given, T.ArrayType), "bytes": isinstance(given, T.BinaryType), "fixed": isinstance(given, T.BinaryType),
        "enum": flat, "boolean": text or number or isinstance(given, T.BooleanType), "string": text,
    }.get(what, number or text and not strict)


def coerced(v: Column, kind: object, path: str | Column, given: T.DataType | None = None, strict: bool = False) -> tuple[Column, Column]:
    """A value by its kind, and what is wrong with it.

    given: the type of v, if it's known; without it v must be of a type that fits the kind. Text that is a number is one, unless
    strict; numbers are never text.
    """
    if isinstance(kind, (list, tuple)) and not isinstance(kind, Default) and kind[0] == "union":
        return one_of(v, list(kind[1:]), path, given, strict)
    if isinstance(kind, Default):
        return coerced(v, kind.kind, path, given, strict)
    if isinstance(kind, str) and kind not in PLAIN:
        raise ValueError(f"{path}: no such kind: {kind}")
    if given is not None and not isinstance(given, T.NullType) and not _fits(kind, given, strict):
        return F.lit(None).cast(spark_type(kind)), F.when(v.isNotNull(), said(path, f": not a {_words(kind)}, but {given.simpleString()}")).otherwise(_required(kind, path))
    if given is not None and isinstance(given, T.NullType):
        return F.lit(None).cast(spark_type(kind)), _required(kind, path)
    if isinstance(kind, dict):
        return record(v, kind, path, given, strict)
    if isinstance(kind, (list, tuple)):
        what, *of = kind
        if what == "map":
            return each_value(v, of[0], path, given, strict)
        if what == "enum":
            return enum(v.cast("string"), list(of), path)
        if what == "fixed":
            return fixed(v, of[0], path)
        return each_element(v, of[0], path, given, strict)
    if kind == "boolean":
        if isinstance(given, T.NumericType):
            return _result(F.when(v == 1, True).when(v == 0, False), v, path, "a boolean")
        return boolean(v, path)
    if kind in ("string", "bytes"):
        return v.cast(PLAIN[kind]), F.lit(None).cast("string")
    return _result(number(v, str(kind)), v, path, f"a {kind}")


def kind_of(schema: object) -> object:
    """The kind of a field's type in a schema file (parsed JSON); null beside one other type is left out, but for maps, which must be there otherwise."""
    if isinstance(schema, str):
        return schema
    if isinstance(schema, list):
        some = [kind_of(x) for x in schema if x != "null"]
        if len(some) == 1 and "null" in schema:
            return ("union", "null", some[0]) if _words(some[0]) == "map" else some[0]
        return ("union", *[kind_of(x) for x in schema])
    of = schema["type"]
    if of == "record":
        return {f["name"]: Default(kind_of(f["type"]), f["default"]) if "default" in f else kind_of(f["type"]) for f in schema["fields"]}
    if of == "enum":
        return ("enum", *schema["symbols"])
    inner = {"array": "items", "map": "values", "fixed": "size"}.get(of) if isinstance(of, str) else None
    if inner is None:
        return kind_of(of)
    return (of, schema[inner] if of == "fixed" else kind_of(schema[inner]))
