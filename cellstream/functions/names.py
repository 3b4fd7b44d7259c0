"""Names: columns, source types, topics, subjects, lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Source types by their accepted names (fixed values).
SYNONYMS = {
    "STRING": "VARCHAR", "CHARACTER VARYING": "VARCHAR", "ANY": "VARCHAR", "CHARACTER": "CHAR", "INT": "INTEGER", "LONG": "BIGINT", "BOOL": "BOOLEAN",
    "NUMERIC": "DECIMAL", "NUMBER": "DECIMAL", "CHARACTER VARYING ARRAY": "VARCHAR ARRAY", "STRING ARRAY": "VARCHAR ARRAY", "ARRAY": "VARCHAR ARRAY", "BINARY VARYING": "VARBINARY",
}
TYPES = (
    "VARCHAR", "CHAR", "UNSIGNED TINYINT", "UNSIGNED SMALLINT", "UNSIGNED INT", "UNSIGNED LONG", "TINYINT", "SMALLINT", "INTEGER", "BIGINT", "FLOAT", "DOUBLE",
    "DECIMAL", "BOOLEAN", "TIMESTAMP", "DATE", "TIME", "VARCHAR ARRAY", "VARBINARY", "BINARY",
)


def column_name(q: Column) -> Column:
    """Trimmed of characters up to the space, upper case if it holds an ASCII lower-case letter."""
    t = F.trim(q, F.lit("".join(map(chr, range(33)))))
    return F.when(q.rlike("[a-z]"), F.upper(t)).otherwise(t)


def source_type(name: Column) -> Column:
    """The source type a declared type name stands for; VARCHAR if blank or unknown."""
    t = F.regexp_replace(F.upper(F.trim(name)), r"\s*\([^)]*\)", "")
    t = F.regexp_replace(F.regexp_replace(t, r"^ARRAY\s*<\s*(.*?)\s*>$", "$1 ARRAY"), r"\s*\[\]$", " ARRAY")
    t = F.trim(F.regexp_replace(F.replace(t, F.lit("_"), F.lit(" ")), r"\s+", " "))
    known = F.create_map(*[F.lit(x) for t_ in TYPES for x in (t_, t_)], *[F.lit(x) for pair in SYNONYMS.items() for x in pair])
    return F.coalesce(F.element_at(known, t), F.lit("VARCHAR"))


def topic(namespace: Column, qualifier: Column, pattern: str = "${table}", longest: int = 249) -> Column:
    """The topic of a table: placeholders filled, leading delimiters stripped, repeated ones collapsed, other characters replaced, cut."""
    default = F.lower(namespace) == "default"
    table = F.when(default, qualifier).otherwise(F.concat_ws("_", namespace, qualifier))
    t = F.lit(pattern)
    for name, value in (("${table}", table), ("${namespace}", F.when(default, F.lit("")).otherwise(namespace)), ("${qualifier}", qualifier)):
        t = F.replace(t, F.lit(name), value)
    t = F.regexp_replace(F.trim(t), r"^[._-]+", "")
    t = F.regexp_replace(t, r"([._-])\1+", "$1")
    t = F.regexp_replace(t, r"[^a-zA-Z0-9._-]", "_")
    return F.substring(F.when(t.isin("", ".", ".."), F.lit("topic")).otherwise(t), 1, longest)


def topic_valid(t: Column, longest: int = 249) -> Column:
    return F.coalesce(F.length(t).between(1, longest) & ~t.isin(".", "..") & t.rlike(r"^[\p{L}\p{Nd}._-]+$"), F.lit(False))


def subject(namespace: Column, qualifier: Column, strategy: str = "table", prefix: str = "", suffix: str = "-value") -> Column:
    name = F.concat(namespace, F.lit(":"), qualifier)
    name = {"table-upper": F.upper(name), "table-lower": F.lower(name)}.get(strategy, name)
    return F.concat(F.lit(prefix), name, F.lit(suffix))


def clean_list(csv: Column) -> Column:
    """A comma-separated list as an array: trimmed, without blanks and repeats, order and case kept."""
    return F.array_distinct(F.filter(F.transform(F.split(csv, ","), lambda x: F.trim(x)), lambda x: x != ""))
