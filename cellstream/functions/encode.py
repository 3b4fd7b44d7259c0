"""The inverse of decode for the native types, to write test rows and change logs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def integer(x: Column, width: int, signed: bool = True) -> Column:
    """Big-endian bytes of an integer, with the sign bit flipped if signed; of one that is out of range, the low bytes."""
    top = F.lit(1 << (8 * width - 1) if width < 8 else -(1 << 63)).cast("bigint")
    bits = x.cast("bigint").bitwiseXOR(top) if signed and width == 8 else (x.cast("bigint") + top if signed else x.cast("bigint"))
    return F.unhex(F.right(F.lpad(F.hex(bits), 16, "0"), F.lit(2 * width)))


def timestamp(ms: Column) -> Column:
    return F.concat(integer(ms, 8), F.lit(b"\x00\x00\x00\x00"))


def real(x: Column, width: int) -> Column:
    """Order-preserving IEEE bits, from the bits' hexadecimal form."""
    u, f, top = (np.uint32, np.float32, np.uint32(1 << 31)) if width == 4 else (np.uint64, np.float64, np.uint64(1 << 63))

    @F.pandas_udf("binary")
    def run(v: pd.Series) -> pd.Series:
        bits = v.to_numpy(f).view(u)
        out = np.where(bits & top == 0, bits ^ top, ~bits).astype(u) + u(1)
        whole = out.astype(f">u{width}").tobytes()
        return pd.Series([whole[i * width : (i + 1) * width] if ok else None for i, ok in enumerate(v.notna())])

    return run(x)


def decimal(cents: Column) -> Column:
    """A number of hundredths in base-100 digits: sign and exponent byte, digits + 1."""
    digits = F.regexp_replace(F.lpad(F.abs(cents).cast("string"), 20, "0"), "^(00)+", "")
    n_pairs = F.floor(F.length(digits) / 2).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), n_pairs - 1), lambda i: F.substring(digits, 2 * i + 1, F.lit(2)).cast("int"))
    first = n_pairs - 2 + 65 + 128
    byte = lambda n: F.lpad(F.hex(n.cast("bigint")), 2, "0")
    plus = F.concat(byte(first), F.array_join(F.transform(pairs, lambda d: byte(d + 1)), ""))
    minus = F.concat(byte(255 - first), F.array_join(F.transform(pairs, lambda d: byte(101 - d)), ""), F.lit("66"))
    return F.unhex(F.when(cents == 0, F.lit("80")).when(cents > 0, plus).otherwise(minus))


def texts(a: Column) -> Column:
    """A text array: elements ended by 00, a trailer of begin, count and version."""
    body = F.concat(F.encode(F.concat(F.array_join(a, "\x00"), F.lit("\x00")), "UTF-8"), F.lit(b"\x00\x00"))
    size = F.octet_length(body)
    return F.concat(body, integer(size - 2, 4, False), integer(F.size(a), 4, False), F.lit(b"\x01"))
