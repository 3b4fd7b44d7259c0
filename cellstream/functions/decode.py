"""Source values of cells: bytes to typed columns, by source type. A registry, open to types of one's own."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that a value of each fixed-size type has (fixed values).
WIDTHS = {
    "UNSIGNED TINYINT": 1, "UNSIGNED SMALLINT": 2, "UNSIGNED INT": 4, "UNSIGNED LONG": 8, "TINYINT": 1, "SMALLINT": 2, "INTEGER": 4, "BIGINT": 8,
    "FLOAT": 4, "DOUBLE": 8, "BOOLEAN": 1, "TIMESTAMP": 12, "DATE": 8, "TIME": 8,
}
SPARK = {
    "UNSIGNED TINYINT": "smallint", "UNSIGNED SMALLINT": "int", "UNSIGNED INT": "bigint", "UNSIGNED LONG": "bigint",
    "TINYINT": "tinyint", "SMALLINT": "smallint", "INTEGER": "int", "BIGINT": "bigint", "TIMESTAMP": "bigint", "DATE": "bigint", "TIME": "bigint",
}


def unsigned(v: Column) -> Column:
    """Big-endian bytes, 8 at most, as DECIMAL(20,0)."""
    return F.conv(F.hex(v), 16, 10).cast("decimal(20,0)")


def _integer(kind: str) -> Callable[[Column], Column]:
    n = WIDTHS[kind]
    offset = 0 if kind.startswith("UNSIGNED") else 1 << (8 * min(n, 8) - 1)
    at = (lambda v: F.substring(v, 1, 8)) if n == 12 else (lambda v: v)
    return lambda v: (unsigned(at(v)) - F.lit(str(offset)).cast("decimal(20,0)")).cast(SPARK[kind])


def _text(v: Column) -> Column:
    """Bytes that aren't UTF-8 become U+FFFD, so that one broken cell doesn't end a job."""
    return F.when(F.octet_length(v) > 0, F.make_valid_utf8(v.cast("string")))


@F.pandas_udf(T.FloatType())
def _float(v: pd.Series) -> pd.Series:
    ok = v.notna().to_numpy()
    bits = np.frombuffer(b"".join(v[ok]), ">u4").astype(np.uint32) - np.uint32(1)
    out = np.full(len(v), np.nan, np.float32)
    out[ok] = np.where(bits >> 31 == 1, bits ^ np.uint32(1 << 31), ~bits).astype(np.uint32).view(np.float32)
    return pd.Series(out).astype(object).where(ok, None)


@F.pandas_udf(T.DoubleType())
def _double(v: pd.Series) -> pd.Series:
    ok = v.notna().to_numpy()
    bits = np.frombuffer(b"".join(v[ok]), ">u8").astype(np.uint64) - np.uint64(1)
    out = np.full(len(v), np.nan)
    out[ok] = np.where(bits >> np.uint64(63) == 1, bits ^ np.uint64(1 << 63), ~bits).astype(np.uint64).view(np.float64)
    return pd.Series(out).astype(object).where(ok, None)


def _decimal(v: Column) -> Column:
    """A sign and exponent byte, then base-100 digits, each + 1; for negative numbers inverted (101 - digit) and ended by 102."""
    text = F.hex(v)
    byte = lambda i: F.conv(F.substring(text, 2 * i - 1, F.lit(2)), 16, 10).cast("int")
    head, n = byte(F.lit(1)), F.octet_length(v)
    positive = head > 128
    codes = F.transform(F.slice(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(2), F.greatest(n - 1, F.lit(0))), byte)
    digits = F.transform(F.filter(codes, lambda x: positive | (x != 102)), lambda x: F.when(positive, x - 1).otherwise(101 - x))
    exponent = F.when(positive, head).otherwise(255 - head) - 128 - 65
    number = F.concat(F.when(positive, "").otherwise("-"), F.array_join(F.transform(digits, lambda d: F.lpad(d.cast("string"), 2, "0")), ""), F.lit("E"), (2 * (exponent - F.size(digits) + 1)).cast("string"))
    return F.when(head == 128, F.lit(0).cast("decimal(38,10)")).when(n > 1, number.try_cast("decimal(38,10)"))


def _array(v: Column) -> Column:
    """Elements ended by 00, then a trailer: ..., 4 bytes where it begins, 4 bytes count, 1 byte version."""
    size = F.octet_length(v)
    begins, count = (unsigned(F.substring(v, size - back, F.lit(4))).cast("int") for back in (8, 4))
    parts = F.slice(F.split(F.decode(F.substring(v, F.lit(1), begins), "UTF-8"), "\x00"), F.lit(1), F.abs(count))
    return F.when(size > 9, F.transform(parts, lambda x: F.when(x != "", x)))


#: type -> (bytes column -> typed column); register() adds to it.
DECODERS: dict[str, Callable[[Column], Column]] = {
    **{k: _integer(k) for k in SPARK},
    "VARCHAR": _text,
    "CHAR": lambda v: F.rtrim(_text(v)),
    "BOOLEAN": lambda v: v == F.lit(b"\x01"),
    "FLOAT": lambda v: _float(v),
    "DOUBLE": lambda v: _double(v),
    "DECIMAL": _decimal,
    "VARCHAR ARRAY": _array,
    "VARBINARY": lambda v: v,
    "BINARY": lambda v: v,
}


#: type -> Spark's type of the decoded values; those of other types, but for ones that were registered without, are text.
TYPES: dict[str, str | None] = {**SPARK, "BOOLEAN": "boolean", "FLOAT": "float", "DOUBLE": "double", "DECIMAL": "decimal(38,10)", "VARCHAR ARRAY": "array<string>", "VARBINARY": "binary", "BINARY": "binary"}


def register(kind: str, decoder: Callable[[Column], Column], width: int | None = None, spark_type: str | None = None) -> None:
    """A source type of one's own, from native functions or a pandas_udf; width: bytes of its values, if fixed; spark_type: of what the decoder gives."""
    DECODERS[kind] = decoder
    TYPES[kind] = spark_type
    if width:
        WIDTHS[kind] = width


def misfit(v: Column, kind: str, column: str) -> Column:
    """Null, or what is wrong with a value of a fixed-size type."""
    n = WIDTHS.get(kind)
    if n is None:
        return F.lit(None).cast("string")
    return F.when((F.octet_length(v) > 0) & (F.octet_length(v) != n), F.concat(F.lit(f"{column}: {kind} has {n} bytes, got "), F.octet_length(v).cast("string")))


def decoded(v: Column, kind: str, default: object = None) -> Column:
    """The typed value; null (or the default) for null and empty bytes and values of a wrong size."""
    n = WIDTHS.get(kind)
    fit = v if n is None else F.when(F.octet_length(v) == n, v)
    out = DECODERS.get(kind, _text)(fit)
    return out if default is None else F.coalesce(out, F.lit(default))


def or_raw(v: Column, kind: str) -> Column:
    """For fields of bytes: the decoded value as bytes (integers big-endian, of its type's size), and what doesn't decode as it is; empty values are null."""
    value = decoded(v, kind)
    value = value if kind in ("VARBINARY", "BINARY") else F.unhex(F.right(F.lpad(F.hex(value.cast("bigint")), 16, "0"), F.lit(2 * min(8, WIDTHS[kind])))) if kind in SPARK else F.encode(value.cast("string"), "UTF-8")
    return F.when(F.octet_length(v) > 0, F.coalesce(value, v))
