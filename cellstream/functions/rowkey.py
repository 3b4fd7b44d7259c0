"""Composite row keys: salt, segments, escapes, previews. Keys are handled as Latin-1 text, one character a byte."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .decode import WIDTHS, decoded

_END = "(?s)^(.*?)(?<!\xff)\x00"


def view(key: Column) -> Column:
    return F.decode(key, "ISO-8859-1")


def unescaped(s: Column) -> Column:
    """FF 00 is 00, FF FF is FF."""
    return F.regexp_replace(s, "(?s)\xff([\x00\xff])", "$1")


def escaped(key: Column) -> Column:
    return F.encode(F.regexp_replace(view(key), "(?s)([\x00\xff])", "\xff$1"), "ISO-8859-1")


def split(key: Column, parts: list[tuple[str, str]], salt: int = 0, sizes: dict[str, int] | None = None) -> dict[str, Column]:
    """Columns of a key's parts, (name, source type) in order.

    A part of fixed size is that many bytes; any other ends at the first 00 that isn't escaped, or, as
    the last one, with the key. A part that can't be cut off ends the decoding: it and all that follow are null.
    """
    rest = F.substring(view(key), salt + 1, 1 << 30)
    rest = F.when(F.octet_length(key) > salt, rest)
    out: dict[str, Column] = {}
    for i, (name, kind) in enumerate(parts):
        n = (sizes or {}).get(name) or WIDTHS.get(kind)
        if n:
            there = F.when(F.length(rest) >= n, rest)
            raw, rest = F.substring(there, 1, n), F.substring(there, n + 1, 1 << 30)
        elif i == len(parts) - 1:
            raw = unescaped(rest)
        else:
            there = F.when(rest.rlike(_END), rest)
            cut = F.regexp_extract(there, _END, 1)
            raw, rest = unescaped(cut), F.substring(there, F.length(cut) + 2, F.lit(1 << 30))
        out[name] = decoded(F.encode(raw, "ISO-8859-1"), kind)
    return out


def preview(key: Column, most: int = 16) -> Column:
    """The first bytes in hexadecimal, with .. if there are more."""
    return F.concat(F.lower(F.hex(F.substring(key, 1, most))), F.when(F.octet_length(key) > most, F.lit("..")).otherwise(F.lit("")))
