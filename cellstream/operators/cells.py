"""Change-log entries: cells in order, runs of a row's cells, family filters, row events.

An entry is one row with its cells in an array, so assembling row events needs no shuffle and no
state, in batch and on streams alike: a run is a slice of the array, and what becomes of it are
expressions over the slice.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coerce, decode, names, rowkey
from ..spec import Field, TableSpec

CELL = "struct<row: binary, family: string, qualifier: string, ts: bigint, is_delete: boolean, value: binary>"
ENTRY = f"wal_seq bigint, wal_write_time bigint, table string, cells array<{CELL}>"


def flat(entries: DataFrame) -> DataFrame:
    """One row per cell, with its place in the entry."""
    return entries.select("wal_seq", "wal_write_time", "table", F.posexplode("cells").alias("cell_idx", "cell")).select("wal_seq", "wal_write_time", "table", "cell_idx", "cell.*")


def evaluated(df: DataFrame, **columns: Column) -> DataFrame:
    """df with more columns, which are evaluated once a row wherever they are used: as rows of a generator, they aren't copied into what uses them."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def run_starts() -> Column:
    """Where the runs of column `cells`, which isn't empty, begin."""
    return F.filter(F.sequence(F.lit(0), F.size("cells") - 1), lambda i: (i == 0) | ~F.get("cells", i)["row"].eqNullSafe(F.get("cells", i - 1)["row"]))


def runs(entries: DataFrame) -> DataFrame:
    """One row per run of neighbouring cells of one row key: run_idx, row, run (the cells). Entries without cells give none."""
    some = entries.where(F.size("cells") > 0)
    starts = run_starts()
    # There is a start at least; outer keeps the array from being evaluated once more to tell.
    cut = some.withColumn("starts", starts).select("*", F.posexplode_outer("starts").alias("run_idx", "start"))
    end = F.coalesce(F.get("starts", F.col("run_idx") + 1), F.size("cells"))
    return cut.withColumn("run", F.slice("cells", F.col("start") + 1, end - F.col("start"))).select("wal_seq", "wal_write_time", "table", "run_idx", F.get("run", F.lit(0))["row"].alias("row"), "run")


def runs_of_flat(cells: DataFrame) -> DataFrame:
    """The same runs as run_idx on flat cells, for batches; one window by entry."""
    w = Window.partitionBy("wal_seq").orderBy("cell_idx")
    new = (~F.col("row").eqNullSafe(F.lag("row").over(w))) | (F.row_number().over(w) == 1)
    return cells.withColumn("run_idx", (F.sum(new.cast("int")).over(w) - 1).cast("int"))


def in_families(run: str | Column, families: Iterable[str]) -> Column:
    """Whether any cell of a run is of one of the families (case-sensitive); no families: always."""
    names = list(families)
    if not names:
        return F.lit(True)
    return F.exists(run, lambda c: c["family"].isin(*names))


def last_value(run: str | Column, qualifier: str) -> Column:
    """The last value put into a column, in cell order, whatever the family; null and empty values don't count."""
    return last_named(written(run), qualifier)


def puts(run: str | Column) -> Column:
    """The cells of a run that put a value."""
    return F.filter(run, lambda c: ~c["is_delete"] & (F.octet_length(c["value"]) > 0))


def written(run: str | Column) -> Column:
    """The same as structs of the column's normal name and the value."""
    return F.transform(puts(run), lambda c: F.struct(names.column_name(c["qualifier"]).alias("name"), c["value"].alias("value")))


def last_named(written: str | Column, qualifier: str) -> Column:
    """The last value of a column among written cells."""
    name = normal_name(qualifier)
    return F.try_element_at(F.filter(written, lambda c: c["name"] == name), F.lit(-1))["value"]


def normal_name(qualifier: str) -> str:
    """A column's normal name, as names.column_name gives it."""
    name = qualifier.strip("".join(map(chr, range(33))))
    return name.upper() if any("a" <= c <= "z" for c in name) else name


def event_time(run: str | Column) -> Column:
    return F.array_max(F.transform(run, lambda c: c["ts"]))


def is_deleted(run: str | Column) -> Column:
    return F.coalesce(F.exists(run, lambda c: c["is_delete"]), F.lit(False))


#: Source types whose decoded values are of a kind as they are.
_OF_KIND = {"string": {"VARCHAR", "CHAR"}, "long": {k for k, t in decode.SPARK.items() if t == "bigint"}, "int": {k for k, t in decode.SPARK.items() if t == "int"}, "boolean": {"BOOLEAN"}, "float": {"FLOAT"}, "double": {"DOUBLE"}}


def read(v: Column, field: Field) -> Column:
    """A cell's value, decoded; fields of bytes and fixed take what doesn't decode as it is."""
    if _raw(field):
        value = decode.or_raw(v, field.source)
        return value if field.default is None else F.coalesce(value, F.lit(field.default))
    return decode.decoded(v, field.source, field.default)


def _raw(field: Field) -> bool:
    return field.kind == "bytes" or (isinstance(field.kind, (list, tuple)) and field.kind[0] == "fixed")


def _coerced(field: Field) -> bool:
    """Whether a field's decoded values are yet to come to its kind."""
    return not (isinstance(field.kind, str) and field.source in _OF_KIND.get(field.kind, ()))


def typed(v: Column, value: Column, field: Field, path: str) -> tuple[Column, Column]:
    """A cell's value of the field's kind, from its bytes v and what read gave, and what is wrong with it: a wrong size, or what can't be coerced, which is null then."""
    if _raw(field):
        return coerce.coerced(value, field.kind, path, T.BinaryType())
    wrong = decode.misfit(v, field.source, path)
    if not _coerced(field):
        return value, wrong
    of = decode.TYPES.get(field.source, "string")
    value, error = coerce.coerced(value, field.kind, path, of and T.DataType.fromDDL(of))
    return value, F.coalesce(wrong, error)


def row_events(entries: DataFrame, spec: TableSpec, extra: dict[str, Column] | None = None) -> DataFrame:
    """Typed row events by a table's spec, in schema order, and _error.

    Runs without a cell of the families are left out before anything is decoded; skipped and
    undeclared columns never are. _error holds the first fault: no row key, a key that doesn't give
    all its parts, a value of a wrong size or not of its field's kind. extra: more columns over `row` and `run`.
    """
    t = runs(entries).where(in_families("run", spec.families))
    keys = rowkey.split(F.col("row"), [(p, spec.of(p).source) for p in spec.pk], spec.salt, spec.sizes)
    # Names and values of what was written, last first: a column's value is at its name's first place.
    t = t.withColumn("__puts", F.reverse(puts("run")))
    t = t.withColumn("__names", F.transform(F.col("__puts.qualifier"), names.column_name))
    at = lambda name: (F.array_position("__names", F.lit(normal_name(name))) - 1).cast("int")
    t = t.withColumns({f"__{f.name}": F.get("__puts", at(f.name))["value"] for f in spec.values()} | {f"__pk_{k}": c for k, c in keys.items()})
    # What is to be coerced is used more than once, as value, for its branches and in errors.
    if again := {f"__read_{f.name}": read(F.col(f"__{f.name}"), f) for f in spec.values() if _coerced(f)}:
        t = evaluated(t, **again)
    faults = [F.when(F.col("row").isNull() | (F.octet_length("row") == 0), F.lit(f"{spec.name}: no row key"))]
    faults += [F.when(F.col(f"__pk_{p}").isNull(), F.lit(f"{spec.name}.{p}: not in the row key")) for p in spec.pk]
    values = {f.name: typed(F.col(f"__{f.name}"), F.col(f"__read_{f.name}") if _coerced(f) else read(F.col(f"__{f.name}"), f), f, f"{spec.name}.{f.name}") for f in spec.values()}
    faults += [wrong for _, wrong in values.values()]
    meta = {
        "_event_ts": event_time("run"), "_delete": is_deleted("run"),
        "_wal_seq": F.coalesce("wal_seq", F.lit(-1).cast("bigint")), "_wal_write_time": F.coalesce("wal_write_time", F.lit(-1).cast("bigint")),
    }
    named = {**{p: F.col(f"__pk_{p}") for p in spec.pk}, **{n: v for n, (v, _) in values.items()}, **meta}
    columns = [named[f.name].alias(f.name) for f in spec.fields if f.name in named and (f.name in spec.pk or not f.skip)]
    more = [c.alias(n) for n, c in (extra or {}).items()]
    return t.select("wal_seq", "run_idx", *columns, *more, F.coalesce(*faults).alias("_error"))


def split_errors(events: DataFrame, policy: str = "skip") -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined ones; by policy "fail", reading the good rows raises the first error."""
    bad = events.where("_error is not null")
    if policy == "fail":
        return events.where(F.when(F.col("_error").isNotNull(), F.raise_error(F.col("_error")).cast("boolean")).otherwise(True)).drop("_error"), bad
    return events.where("_error is null").drop("_error"), bad


def marked(events: DataFrame) -> DataFrame:
    """Events with quarantined, 1 where they have an error, else 0."""
    return events.withColumn("quarantined", F.col("_error").isNotNull().cast("int"))


def landed_split(events: DataFrame, path: str, mode: str = "append") -> None:
    """Writes good and broken events to one dataset, each in its part; events are evaluated once, and nothing is shuffled. Read them by good_of and broken_of."""
    marked(events).write.mode(mode).partitionBy("quarantined").parquet(path)


def good_of(spark: SparkSession, path: str) -> DataFrame:
    """The good rows of a split dataset; no file of the others is read."""
    return spark.read.parquet(path).where("quarantined = 0").drop("quarantined", "_error")


def broken_of(spark: SparkSession, path: str) -> DataFrame:
    """The broken rows of a split dataset."""
    return spark.read.parquet(path).where("quarantined = 1").drop("quarantined")
