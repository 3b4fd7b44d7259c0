"""Framed messages: a zero byte, a schema id of four bytes, the body."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .decode import unsigned
from .encode import integer


def framed(body: Column, schema_id: Column) -> Column:
    return F.concat(F.lit(b"\x00"), integer(schema_id, 4, False), body)


def unframed(value: Column) -> tuple[Column, Column, Column]:
    """Schema id, body, error."""
    good = (F.octet_length(value) >= 5) & (F.substring(value, 1, 1) == F.lit(b"\x00"))
    bad = F.when(value.isNotNull() & ~good, F.lit("no framed message"))
    return F.when(good, unsigned(F.substring(value, 2, 4)).cast("bigint")), F.when(good, F.substring(value, 6, 1 << 30)), bad
