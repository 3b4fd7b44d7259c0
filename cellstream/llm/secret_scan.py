"""Secrets in texts: three fixed patterns, and strings of high entropy. DataFrame functions only.

Spans come from cutting a text at its matches: the lengths of the parts between them and of the
matches add up to offsets in code points. The sums run in blocks, so a text of very many matches
takes time in proportion to them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: For these two, dropping matches that are too short is the same as asking for the length.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Character classes, first that fits: name, what all characters must match, least bits a character in some window.
CLASSES = (("hex", "^[0-9a-fA-F]+$", 3.0), ("alnum", "^[A-Za-z0-9]+$", 3.7), ("base64", "^[A-Za-z0-9+/_=-]+$", 3.8))
#: Never secrets: UUIDs, slugs and paths of words, runs of one character, published sample keys.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[/_=+-]*([A-Za-z]+[0-9]{0,4}[/_=+-]+)+[A-Za-z]*[0-9]{0,4}$",
    r"^(.)\1+$",
    r"EXAMPLE",
)
_BLOCK = 256


def _matches(text: Column, pattern: str, group: int | None, least: int) -> tuple[Column, Column]:
    """Parts between matches, and matches as (whole, length of the group or of the whole)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    own = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return F.split(text, pattern, -1), F.zip_with(found, own, lambda a, b: F.struct(a.alias("s"), (F.length(b) >= least).alias("ok")))


def _spans(parts: Column, found: Column) -> Column:
    """array<struct<start, end, s>> of the matches that are ok."""
    both = F.zip_with(F.slice(parts, F.lit(1), F.size(found)), found, lambda p, m: F.struct(F.length(p).cast("long").alias("gap"), m["s"].alias("s"), m["ok"].alias("ok")))
    blocks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _BLOCK).cast("int"))
    block = lambda b: F.slice(both, b * _BLOCK + 1, F.lit(_BLOCK))
    width = lambda b: F.aggregate(block(b), F.lit(0).cast("long"), lambda a, x: a + x["gap"] + F.length(x["s"]))
    begins = F.aggregate(blocks, F.array(F.lit(0).cast("long")), lambda a, b: F.concat(a, F.array(F.element_at(a, -1) + width(b))))
    none = F.expr("cast(array() as array<struct<start: bigint, end: bigint, s: string>>)")

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + x["gap"]
        end = start + F.length(x["s"])
        own = F.when(x["ok"], F.array(F.struct(start.alias("start"), end.alias("end"), x["s"].alias("s")))).otherwise(none)
        return F.struct(end.alias("at"), F.concat(a["out"], own).alias("out"))

    inside = lambda b: F.aggregate(block(b), F.struct(F.element_at(begins, b + 1).alias("at"), none.alias("out")), step, lambda a: a["out"])
    return F.when(F.size(found) > 0, F.flatten(F.transform(blocks, inside))).otherwise(none)


def max_window_entropy(s: Column, window: int) -> Column:
    """The largest Shannon entropy, in bits a character, of any `window` characters in a row of an ASCII string of that length at least.

    Counts by character and the sum of count * log2(count) follow the window as one character
    enters and one leaves.
    """
    f = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    code = lambda i: F.ascii(F.substring(s, i + 1, F.lit(1)))

    def step(a: Column, i: Column) -> Column:
        return F.aggregate(  # binds the two characters and their counts once
            F.array(F.struct(code(i).alias("x"), F.when(i >= window, code(i - window)).otherwise(F.lit(-1)).alias("y"))),
            a,
            lambda a, z: F.struct(
                F.transform(a["n"], lambda n, j: n + (j == z["x"]).cast("int") - (j == z["y"]).cast("int")).alias("n"),
                (
                    a["sum"]
                    + F.when(
                        z["x"] != z["y"],
                        F.get(f, F.get(a["n"], z["x"]) + 1) - F.get(f, F.get(a["n"], z["x"])) + F.when(z["y"] >= 0, F.get(f, F.get(a["n"], z["y"]) - 1) - F.get(f, F.get(a["n"], z["y"]))).otherwise(0.0),
                    ).otherwise(0.0)
                ).alias("sum"),
                a["low"].alias("low"),
            ),
            lambda a: F.struct(a["n"].alias("n"), a["sum"].alias("sum"), F.when(i >= window - 1, F.least(a["low"], a["sum"])).otherwise(a["low"]).alias("low")),
        )

    start = F.struct(F.array_repeat(F.lit(0), 128).alias("n"), F.lit(0.0).alias("sum"), F.lit(1e9).alias("low"))
    low = F.aggregate(F.sequence(F.lit(0), F.length(s) - 1), start, step, lambda a: a["low"])
    return F.lit(math.log2(window)) - low / window


def _labelled(rank: int, kind: str):
    return lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"), x["s"].alias("s"))


def secrets(docs: DataFrame, window: int = 20, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """One row per row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans, found.

    found: array of (start, end, kind, s), by start, then kind: assign, access and hex by their
    patterns, then entropy: candidate strings with a letter and a digit, none allowed, of which some
    window of characters reaches the least entropy of the string's character class. An entropy span
    that lies within a span of another kind is left out. spans: found as kind:start:end, joined by
    commas; base_sha256: the same without entropy, hashed.

    Null text counts as empty and has no spans; repeated rows get a row each; a null doc_id stays
    null; other columns don't matter; an empty table gives no rows. No shuffle.
    """
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kinds = (("assign", ASSIGN, 2, 6), ("access", ACCESS, None, 20), ("hex", HEX, None, 24), ("entropy", CANDIDATE, None, window))
    for kind, pattern, group, least in kinds:
        t = t.withColumn(f"has_{kind}", F.col("text").rlike(pattern))
        parts, found = _matches(F.col("text"), pattern, group, least)
        t = t.withColumn(f"cut_{kind}", F.when(F.col(f"has_{kind}"), F.struct(parts.alias("p"), found.alias("m"))))
    t = t.select("doc_id", *[f"cut_{k}" for k, *_ in kinds])
    none = F.expr("cast(array() as array<struct<start: bigint, end: bigint, s: string>>)")
    for kind, *_ in kinds:
        t = t.withColumn(kind, F.when(F.col(f"cut_{kind}").isNotNull(), _spans(F.col(f"cut_{kind}.p"), F.col(f"cut_{kind}.m"))).otherwise(none))
    labelled = [F.transform(k, _labelled(n, k)) for n, k in enumerate(("assign", "access", "hex"))]
    t = t.withColumn("base", F.array_sort(F.concat(*labelled)))
    mixed = F.filter("entropy", lambda x: x["s"].rlike("[0-9]") & x["s"].rlike("[A-Za-z]"))
    mixed = F.filter(mixed, lambda x: ~reduce(lambda a, b: a | b, [x["s"].rlike(p) for p in allowed], F.lit(False)))
    mixed = F.filter(mixed, lambda x: ~F.exists("base", lambda b: (b["start"] <= x["start"]) & (b["end"] >= x["end"])))
    least = F.lit(99.0)
    bar = lambda s: reduce(lambda rest, c: F.when(s.rlike(c[1]), F.lit(c[2])).otherwise(rest), reversed(CLASSES), least)
    mixed = F.filter(mixed, lambda x: max_window_entropy(x["s"], window) >= bar(x["s"]))
    t = t.withColumn("more", F.transform(mixed, _labelled(3, "entropy")))
    t = t.withColumn("found", F.array_sort(F.concat("base", "more")))
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return t.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("found").alias("spans"),
        F.transform("found", lambda x: F.struct(x["start"], x["end"], x["kind"], x["s"])).alias("found"),
    )
