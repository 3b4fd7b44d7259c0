"""Datasets in months that streams and jobs write, merge and retire while others read.

A dataset is a folder of `data/part=.../ym=...`, where each commit writes a part of its own, and of
`manifests/n=...`, one JSON row a commit: which months of which parts make up the dataset from then
on. A commit is the rename that ends Spark's write of that row, so months are replaced all at once or not
at all. What a reader has begun to read stays where it is until vacuum(). There's one writer at a
time; a second one that makes the same commit is found out: it fails, and so does every reader, until one of
the two rows in that commit's folder is deleted.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import scratch

MANIFEST = "entries array<struct<ym: string, part: string>>, applied map<string, bigint>, columns string, id string"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Manifest:
    """entries: (month as its folder has it, part); applied: the last batch of each stream; columns: JSON of the schema."""

    n: int = 0
    entries: frozenset[tuple[str, str]] = frozenset()
    applied: dict[str, int] = field(default_factory=dict)
    columns: str = ""

    def months(self) -> set[str]:
        return {ym for ym, _ in self.entries}


def _manifests(spark: SparkSession, path: str) -> list[Manifest]:
    """All that are kept, in order."""
    if not scratch.exists(spark, f"{path}/manifests"):
        return []
    rows = spark.read.schema(f"{MANIFEST}, n bigint").json(f"{path}/manifests").collect()  # one row a commit since vacuum()
    found = sorted((Manifest(r["n"], frozenset((e["ym"], e["part"]) for e in r["entries"]), dict(r["applied"] or {}), r["columns"]) for r in rows), key=lambda m: m.n)
    twice = {a.n for a, b in zip(found, found[1:]) if a.n == b.n}
    if twice:
        raise RuntimeError(f"{path}: two writers made commits {sorted(twice)}")
    return found


def current(spark: SparkSession, path: str) -> Manifest:
    """The last manifest; an empty one where there is none."""
    return (_manifests(spark, path) or [Manifest()])[-1]


def _commit(spark: SparkSession, path: str, to: Manifest) -> None:
    n = to.n + 1
    row = ([{"ym": ym, "part": part} for ym, part in sorted(to.entries)], to.applied, to.columns, uuid.uuid4().hex)
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").json(f"{path}/manifests/n={n}")
    current(spark, path)  # fails if another writer made this commit, too


def _files(spark: SparkSession, path: str, schema: StructType, entries: Iterable[tuple[str, str]]) -> DataFrame:
    """The rows as they lie in files, with their part."""
    folders = [f"{path}/data/part={part}/ym={ym}" for ym, part in sorted(entries)]
    if not folders:
        return spark.createDataFrame([], schema.add("part", "string"))
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)


def _read(spark: SparkSession, path: str, columns: str, entries: Iterable[tuple[str, str]]) -> DataFrame:
    schema = StructType.fromJson(json.loads(columns))
    names = schema.fieldNames()
    return _files(spark, path, schema, entries).select(names)


def read(spark: SparkSession, path: str, months: Iterable[int | str] | None = None, n: int | None = None) -> DataFrame:
    """The dataset as it is now, or as of commit n while that is kept; only these months, if given."""
    found = [m for m in _manifests(spark, path) if n is None or m.n == n]
    if not found:
        raise FileNotFoundError(f"{path}: no dataset" if n is None else f"{path}: commit {n} isn't kept")
    wanted = None if months is None else {str(m) for m in months}
    return _read(spark, path, found[-1].columns, (e for e in found[-1].entries if wanted is None or e[0] in wanted))


def stream(spark: SparkSession, path: str, files: int = 1000) -> DataFrame:
    """New batches of the dataset as a stream; months that were rewritten aren't new."""
    schema = StructType.fromJson(json.loads(current(spark, path).columns))
    reader = spark.readStream.schema(schema).option("basePath", f"{path}/data").option("maxFilesPerTrigger", files).option("ignoreMissingFiles", "true")
    return reader.parquet(f"{path}/data/part=b*/ym=*").select(schema.fieldNames())


def _staged(spark: SparkSession, df: DataFrame, path: str, part: str, sort: list[str]) -> set[tuple[str, str]]:
    """Writes sorted files of a part, sized by adaptive execution: crowded months are split, small pieces joined. Gives its entries."""
    at = f"{path}/data/part={part}"
    df.hint("rebalance", "ym").sortWithinPartitions("ym", *sort).write.mode("overwrite").partitionBy("ym").parquet(at)
    return {(name[3:], part) for name in scratch.names(spark, at) if name.startswith("ym=")}


def _new_part(kind: str) -> str:
    return f"{kind}{uuid.uuid4().hex}"


def append(spark: SparkSession, df: DataFrame, path: str, sort: list[str], batch: tuple[str, int] | None = None) -> bool:
    """Adds rows, which have a column ym. batch: a stream's name and the number of a micro-batch; one that was added is not added again, and nothing is written (False)."""
    now = current(spark, path)
    if batch and now.applied.get(batch[0], -1) >= batch[1]:
        return False
    entries = _staged(spark, df, path, f"b{batch[0]}-{batch[1]:012d}" if batch else _new_part("b"), sort)
    applied = now.applied | ({batch[0]: batch[1]} if batch else {})
    _commit(spark, path, replace(now, entries=now.entries | entries, applied=applied, columns=now.columns or df.schema.json()))
    return True


def rewrite(spark: SparkSession, df: DataFrame, path: str, months: Iterable[str], sort: list[str], batch: tuple[str, int] | None = None) -> None:
    """Puts rows in the place of these months (as their folders have them), all at once. The rows must be of these months."""
    now = current(spark, path)
    entries = _staged(spark, df, path, _new_part("r"), sort)
    gone = set(months)
    kept = frozenset(e for e in now.entries if e[0] not in gone)
    applied = now.applied | ({batch[0]: batch[1]} if batch else {})
    _commit(spark, path, replace(now, entries=kept | entries, applied=applied, columns=now.columns or df.schema.json()))


def merge(spark: SparkSession, new: DataFrame, path: str, sort: list[str], merged: Callable[[DataFrame], DataFrame], batch: tuple[str, int] | None = None) -> None:
    """Rewrites the months of new rows with what `merged` makes of the old and new rows of these months together.

    New rows are evaluated once, into a staging folder, which gives their months; other months aren't read. A micro-batch that was
    merged is not merged again.
    """
    now = current(spark, path)
    if batch and now.applied.get(batch[0], -1) >= batch[1]:
        return
    staging = f"{path}/staging/{uuid.uuid4().hex}"
    new.write.partitionBy("ym").parquet(staging)
    months = {name[3:] for name in scratch.names(spark, staging) if name.startswith("ym=")}
    if months:
        staged = spark.read.schema(new.schema).parquet(staging).select(new.columns)
        old = _read(spark, path, now.columns, (e for e in now.entries if e[0] in months)).select(new.columns) if now.columns else staged.limit(0)
        rewrite(spark, merged(old.unionByName(staged)), path, months, sort, batch)
    scratch.delete(spark, [staging])


def retire(spark: SparkSession, path: str, days: int, as_of: datetime.datetime, by: list[str], sort: list[str], keep: int = 2) -> None:
    """Takes expired rows out: months that hold nothing else leave the manifest unread, the boundary month is rewritten. Old commits but the last `keep` are vacuumed.

    A row expires when its first time of `by` that isn't null, which its month is of, is more than `days` old. Rows without
    a month stay. Running it again changes nothing; a dataset that isn't there yet is left so.
    """
    now = current(spark, path)
    cut = as_of - datetime.timedelta(days=days)
    boundary = cut.year * 100 + cut.month
    old = {ym for ym in now.months() if ym.isdigit() and int(ym) < boundary}
    edge = str(boundary)
    if edge in now.months():
        month = _read(spark, path, now.columns, (e for e in now.entries if e[0] == edge))
        kept = F.coalesce(*[F.col(c) for c in by]) >= F.lit(as_of).cast("timestamp_ntz") - F.expr(f"interval {days} days")
        if not month.where(~F.coalesce(kept, F.lit(False))).isEmpty():
            rewrite(spark, month.where(kept), path, old | {edge}, sort)
            old = set()
    if old:
        _commit(spark, path, replace(now, entries=frozenset(e for e in now.entries if e[0] not in old)))
    vacuum(spark, path, keep)


def compact(spark: SparkSession, path: str, month: int | str, sort: list[str], merged: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Rewrites one month, from all its parts, as few files."""
    now = current(spark, path)
    entries = [e for e in now.entries if e[0] == str(month)]
    if entries:
        rewrite(spark, merged(_read(spark, path, now.columns, entries)), path, {str(month)}, sort)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Forgets all commits but the last `keep` and deletes what only they had."""
    found = _manifests(spark, path)
    gone, kept = found[:-keep], found[-keep:]
    used = set().union(*(m.entries for m in kept)) if kept else set()
    unused = set().union(*(m.entries for m in gone)) - used if gone else set()
    scratch.delete(spark, [f"{path}/data/part={part}/ym={ym}" for ym, part in sorted(unused)] + [f"{path}/manifests/n={m.n}" for m in gone])


def parts(spark: SparkSession, path: str) -> DataFrame:
    """The dataset as it is now with part, the commit's part that a row is in."""
    now = current(spark, path)
    return _files(spark, path, StructType.fromJson(json.loads(now.columns)), now.entries)


def report(spark: SparkSession, path: str) -> DataFrame:
    """Per month: parts, files, bytes and rows of the dataset as it is now; from the files' metadata and row counts only."""
    rows = parts(spark, path)
    of_file = rows.groupBy("ym", "part", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("n"))
    return of_file.groupBy("ym").agg(F.count_distinct("part").alias("parts"), F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("n").alias("n_rows"))
