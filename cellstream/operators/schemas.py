"""Comparisons of schema catalogs: position by position, by fingerprint, by type against landing datasets."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from ..functions import coerce
from ..sources.catalog import kind_of_type, spec


def diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Positions of a table's fields where name or record type differ."""
    side = lambda d, s: d.select("table", "pos", *[F.col(c).alias(f"{s}_{c}") for c in ("name", "record_type")])
    t = side(old, "old").join(side(new, "new"), ["table", "pos"], "full")
    return t.where(~(F.col("old_name").eqNullSafe(F.col("new_name")) & F.col("old_record_type").eqNullSafe(F.col("new_record_type"))))


def fingerprints(catalog: DataFrame) -> DataFrame:
    """A hash of each table's ordered names and types; a table's fields are few."""
    fields = F.array_sort(F.collect_list(F.struct("pos", "name", "record_type")))
    return catalog.groupBy("table").agg(F.md5(F.array_join(F.transform(fields, lambda f: F.concat(f["name"], F.lit(":"), f["record_type"])), ",")).alias("fingerprint"), F.count("*").alias("n_fields"))


def drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Tables whose fingerprint changed, appeared or went."""
    a, b = (fingerprints(d).select("table", F.col("fingerprint").alias(s)) for d, s in ((old, "before"), (new, "after")))
    return a.join(b, "table", "full").where(~F.col("before").eqNullSafe(F.col("after")))


#: Types that hold every value of a plain kind, the kind's own first.
WIDER = {
    "boolean": ("boolean", "tinyint", "smallint", "int", "bigint"), "int": ("int", "bigint", "double", "decimal"), "long": ("bigint", "decimal"), "float": ("float", "double"), "double": ("double",),
    "string": ("string",), "bytes": ("binary",), "enum": ("string",), "fixed": ("binary",),
}
#: Digits before the point that decimals need to hold all integers of a kind.
DIGITS = {"int": 10, "long": 19}
ORDER = ("there", "widened", "narrowed", "mismatch")


def _worst(*statuses: str) -> str:
    return max(statuses, key=ORDER.index, default="there")


def matched(kind: object, target: T.DataType) -> str:
    """How a type takes a kind's values: "there" (as they are), "widened" (a wider type, or a record with further fields), "narrowed" (fields of a record are lost) or "mismatch"."""
    if isinstance(kind, coerce.Default):
        return matched(kind.kind, target)
    if isinstance(kind, dict):
        if not isinstance(target, T.StructType):
            return "mismatch"
        have = {f.name.lower(): f.dataType for f in target}
        lost = any(n.lower() not in have for n in kind)
        more = len(have) > len(kind) - lost
        return _worst(*(["narrowed"] if lost else []), *(["widened"] if more and not lost else []), *[matched(k, have[n.lower()]) for n, k in kind.items() if n.lower() in have])
    if isinstance(kind, (list, tuple)):
        what, *of = kind
        if what == "union":
            some = [k for k in of if k != "null"]
            return matched(some[0], target) if len(some) == 1 else matched({"branch": "string", **dict(coerce.branches(of))}, target)
        if what == "array":
            return matched(of[0], target.elementType) if isinstance(target, T.ArrayType) else "mismatch"
        if what == "map":
            return matched(of[0], target.valueType) if isinstance(target, T.MapType) and isinstance(target.keyType, T.StringType) else "mismatch"
        kind = what
    name = "decimal" if isinstance(target, T.DecimalType) else target.simpleString()
    if name not in WIDER.get(str(kind), ()) or isinstance(target, T.DecimalType) and target.precision - target.scale < DIGITS[str(kind)]:
        return "mismatch"
    return "there" if name == WIDER[str(kind)][0] else "widened"


def coverage(catalog: DataFrame, table: str, target: StructType) -> DataFrame:
    """The fields of a table, one row each, against a target dataset: name, role (pk, meta, value; null for what the table hasn't), record_type, target_type and status.

    status: missing (the target hasn't it), extra (the table hasn't it), skipped, or as `matched` says. Names go without regard to case.
    Key columns, which every row has, must not be nullable in a way that the target refuses; that is no matter of types.
    """
    own = spec(catalog, table)
    kinds = {r["name"]: r["record_type"] for r in catalog.where(F.col("table") == table.lower()).select("name", "record_type").collect()}  # of one table
    have, keys = {f.name.lower(): f.dataType for f in target}, {k.lower() for k in own.pk}
    rows = []
    for f in own.fields:
        role = "pk" if f.name.lower() in keys else "meta" if f.name.startswith("_") else "value"
        of = have.pop(f.name.lower(), None)
        status = "skipped" if f.skip and of is None else "missing" if of is None else matched(f.kind, of)
        rows.append((f.name, role, kinds[f.name], of and of.simpleString(), status))
    rows += [(f.name, None, None, f.dataType.simpleString(), "extra") for f in target if f.name.lower() in have]
    return catalog.sparkSession.createDataFrame(rows, "name string, role string, record_type string, target_type string, status string")


def coverages(catalog: DataFrame, targets: DataFrame) -> DataFrame:
    """Fields of all tables of a catalog against target columns (table, name, target: JSON of a type): table, name, record_type, target and status, as in coverage.

    Types are compared once for each pair of a record type and a target type, not for each field.
    """
    own = catalog.select("table", F.lower("name").alias("name"), "record_type")
    t = own.join(targets.select("table", F.lower("name").alias("name"), "target"), ["table", "name"], "full")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield p.assign(match=[matched(kind_of_type(r), T.StructType.fromJson({"type": "struct", "fields": [{"name": "x", "type": json.loads(x), "nullable": True, "metadata": {}}]})[0].dataType) for r, x in zip(p["record_type"], p["target"])])

    pairs = t.select("record_type", "target").where("record_type is not null and target is not null").distinct()
    match = pairs.mapInPandas(run, "record_type string, target string, match string")
    status = F.when(F.col("target").isNull(), "missing").when(F.col("record_type").isNull(), "extra").otherwise(F.col("match"))
    return t.join(match, ["record_type", "target"], "left").select("table", "name", "record_type", "target", status.alias("status"))
