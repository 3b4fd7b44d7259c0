"""Schema files (.avsc) of a directory as a catalog: one row per table and field."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import kind_of
from ..functions.names import clean_list, source_type
from ..spec import Field, TableSpec

#: Extra properties of a schema file, after a prefix that is a parameter (fixed values).
PK, SALT, HINT, FAMILIES, TYPE, SKIP = "pk", "saltBytes", "capacityHint", "cf.list", "phoenixType", "payload.skip"


def catalog(spark: SparkSession, path: str, prefix: str = "x.") -> DataFrame:
    """table, pos, name, record_type, nullable, source_type, skip, pk_pos, salt, salt_source, hint, families.

    path: a directory or pattern of schema files, read as text by Spark; prefix: of the extra
    properties' names. Files are small, so each is one row that's taken apart by JSON functions.
    """
    root = spark.read.text(path, wholetext=True).select(F.from_json("value", "name string, fields array<string>").alias("r"), "value")
    extra = lambda of, name: F.get_json_object(of, f"$['{prefix}{name}']")
    pk_text = F.coalesce(extra(F.col("value"), PK), F.lit("[]"))
    pk = F.filter(F.transform(F.from_json(pk_text, "array<string>"), lambda x: F.trim(x)), lambda x: x != "")
    salt = extra(F.col("value"), SALT).try_cast("int")
    hint = extra(F.col("value"), HINT).try_cast("int")
    list_text = extra(F.col("value"), FAMILIES)
    families = F.when(list_text.rlike(r"^\s*[\[{]") | list_text.isNull(), F.expr("cast(array() as array<string>)")).otherwise(clean_list(list_text))
    t = root.select(
        F.lower("r.name").alias("table"), pk.alias("pk"), families.alias("families"), F.posexplode("r.fields").alias("pos", "field"),
        clamped_salt(salt).alias("salt"), F.when(hint > 0, hint).alias("hint"),
    )
    name = F.get_json_object("field", "$.name")
    kind = F.get_json_object("field", "$.type")
    branches = F.when(kind.startswith("["), F.from_json(kind, "array<string>"))
    nullable = F.coalesce(F.array_contains(branches, "null"), F.lit(False))
    plain = F.regexp_replace(F.when(nullable & (F.size(branches) == 2), F.get(F.array_remove(branches, "null"), F.lit(0))).otherwise(kind), '^"(.*)"$', "$1")
    declared = extra(F.col("field"), TYPE)
    place = F.array_position(F.transform("pk", lambda x: F.upper(x)), F.upper(name)).cast("int")
    return t.select(
        "table", "pos", name.alias("name"), plain.alias("record_type"), nullable.alias("nullable"), source_type(F.coalesce(declared, F.lit(""))).alias("source_type"),
        F.coalesce(F.lower(extra(F.col("field"), SKIP)) == "true", F.lit(False)).alias("skip"), F.when(place > 0, place).alias("pk_pos"),
        F.coalesce("salt", F.lit(0)).alias("salt"), F.when(F.col("salt").isNull(), "default").otherwise("schema").alias("salt_source"), "hint", "families",
    )


def kind_of_type(record_type: str, nullable: bool = False) -> object:
    """The kind of a record_type of a catalog."""
    of = json.loads(record_type) if record_type[:1] in ("{", "[") else record_type
    return kind_of(["null", of] if nullable and not isinstance(of, list) else of)


def clamped_salt(given: Column) -> Column:
    """Salt bytes of a key: 0 to 8, 0 where none or less is given."""
    return F.least(F.greatest(F.when(given >= 0, given), F.lit(0)), F.lit(8))


def spec(rows: DataFrame, table: str) -> TableSpec:
    """The TableSpec of one table of a catalog; a table that isn't there is an error."""
    found = rows.where(F.col("table") == table.lower()).orderBy("pos").collect()  # the fields of one table
    if not found:
        raise KeyError(f"no schema of table {table}")
    keys = sorted((r for r in found if r["pk_pos"]), key=lambda r: r["pk_pos"])
    fields = tuple(Field(r["name"], kind_of_type(r["record_type"], r["nullable"]), r["source_type"], r["skip"]) for r in found)
    return TableSpec(table, fields, tuple(r["name"] for r in keys), found[0]["salt"], tuple(found[0]["families"]), found[0]["hint"])


def families_of(rows: DataFrame, default: str = "0") -> DataFrame:
    """Families by table, in order; the default where none are listed."""
    few = rows.select("table", "families").distinct()
    return few.select("table", F.explode(F.when(F.size("families") > 0, F.col("families")).otherwise(F.array(F.lit(default)))).alias("family")).orderBy("table", "family")
