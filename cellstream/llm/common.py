"""What the operators of this folder share: intermediate tables, reading, hashing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from weakref import WeakKeyDictionary

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import delete, let_go, new_path, shared_dir

_path_of: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: cuts lineage, survives lost executors, and later reads take only the columns they need."""
    path = new_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    let_go(df.sparkSession)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    _path_of[back] = path
    return back


def discard(*tables: DataFrame) -> None:
    """Deletes tables that stored() gave, when nothing will read them again."""
    for t in tables:
        delete(t.sparkSession, [_path_of.pop(t)])


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint, for the small tables of loops; with spark.cleaner.referenceTracking.cleanCheckpoints Spark deletes its files once nothing refers to them."""
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    let_go(df.sparkSession)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Parts that the rows of a hot key are spread over.
SALTS = 16


def salt(by: str) -> Column:
    """Which part a row is in, by what tells rows of one key apart."""
    return F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")


def parts_of(salt: Column) -> Column:
    """An aggregate, combined before the shuffle: the parts in which a key has rows, as a mask."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1), salt))


def each_part(mask: str) -> Column:
    """A row for each part of a mask, and for no other."""
    return F.explode(F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.getbit(F.col(mask), i) == 1))


def spread_join(rows: DataFrame, small: DataFrame, keys: list[str], by: str) -> DataFrame:
    """rows joined with small, which has one row a key and in `parts` the mask of the parts (by hash of `by`) in which rows has that key.

    A key that many rows share meets them in up to SALTS tasks.
    """
    met = small.withColumn("__part", each_part("parts")).drop("parts")
    return rows.withColumn("__part", salt(by)).join(met, [*keys, "__part"]).drop("__part")


def free_name(wanted: str, taken: list[str]) -> str:
    """A column name like the one wanted that none of those taken clashes with."""
    while wanted.lower() in {c.lower() for c in taken}:
        wanted += "_"
    return wanted


def finite_vector(column: str):
    """True for arrays without null, NaN or infinite components and with a component other than zero."""
    c = F.col(column)
    ok = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(c.isNotNull() & ok & F.exists(c, lambda x: x != 0), F.lit(False))


class WordHashes(dict):
    """bytes -> 64-bit hash; forgets all when it has grown to `most` words."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """The first n powers of a number, modulo 2 ** 64."""
    if base not in _powers or len(_powers[base]) < n:
        _powers[base] = np.concatenate(([np.uint64(1)], np.cumprod(np.full(max(n, 256), base, np.uint64))))
    return _powers[base][:n]


@dataclass
class Words:
    """The words (ends: ASCII white space) of a group of texts, laid end to end with a line's end after each."""

    codes: np.ndarray  # code points
    inside: np.ndarray  # by code point: part of a word
    first: np.ndarray  # by word: where it begins
    length: np.ndarray
    doc: np.ndarray  # by word: number of its text
    of_char: np.ndarray  # by code point: number of the word that it is in or after
    hash: np.ndarray  # by word: a polynomial of its code points

    def total(self, per_char: np.ndarray) -> np.ndarray:
        """Sums by word, of what is 0 outside of words."""
        return np.add.reduceat(per_char, self.first) if len(self.first) else per_char[:0]


def words_of(texts: list[str | None]) -> Words:
    codes = np.frombuffer("\n".join([t or "" for t in texts] + [""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = ~((codes == 32) | (codes - np.uint32(9) < 5))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = np.flatnonzero(begins)
    length = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1 - first
    of_char = np.maximum(np.cumsum(begins) - 1, 0)
    doc = np.searchsorted(np.cumsum([len(t or "") + 1 for t in texts]), first, side="right")
    out = Words(codes, inside, first, length, doc, of_char, np.empty(0, np.uint64))
    if len(first):
        longest = int(length.max())
        at = np.clip(np.arange(len(codes)) - first[of_char], 0, longest - 1)
        out.hash = out.total(np.where(inside, codes.astype(np.uint64) * powers(longest)[at], np.uint64(0)))
    return out


def grouped(texts: list[str | None], most: int = 256, size: int = 1_000_000) -> Iterator[slice]:
    """Slices of texts, of so many or of so many characters at most, but for longer ones alone: a group is worked on at once."""
    start = total = 0
    for i, t in enumerate(texts):
        if i > start and (i - start == most or total + len(t or "") > size):
            yield slice(start, i)
            start, total = i, 0
        total += len(t or "")
    if len(texts) > start:
        yield slice(start, len(texts))
