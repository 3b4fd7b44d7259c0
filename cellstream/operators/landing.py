"""Landing: topic rows to raw and serving rows, duplicates, merging by month. Datasets are those of months.py."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import times
from . import months


def to_raw(topic_rows: DataFrame, fields: dict[str, Column], now: Column) -> DataFrame:
    """Business columns, the source position, the broker's time (now if null), the ingest time and the month."""
    return topic_rows.select(
        *[c.alias(n) for n, c in fields.items()], F.col("partition").alias("__kafka_partition"), F.col("offset").alias("__kafka_offset"),
        F.coalesce("timestamp", now).alias("__kafka_ts"), now.alias("__ingest_ts"),
    ).withColumn("ym", times.month(F.col("__ingest_ts")))


def to_serving(raw: DataFrame, business_time: str | None, version: Column, keep_ingest: bool = False) -> DataFrame:
    """The raw columns without the ingest time, a version, and the month of business time, else of broker time."""
    drop = ["ym"] + ([] if keep_ingest else ["__ingest_ts"])
    by = [F.col(business_time)] if business_time else []
    return raw.withColumn("ver", version).drop(*drop).withColumn("ym", times.month(*by, F.col("__kafka_ts")))


def latest(df: DataFrame, key: list[str], version: str) -> DataFrame:
    """One row per key, of the highest version; ties go to the largest other values, so any order of input gives the same."""
    others = [c for c in df.columns if c not in key and c != version]
    best = df.groupBy(*key).agg(F.max(F.struct(version, *others)).alias("__best"))
    return best.select(*[F.col(c) if c in key else F.col(f"__best.{c}").alias(c) for c in df.columns])


def once(df: DataFrame, position: tuple[str, ...] = ("__kafka_partition", "__kafka_offset"), delay: str | None = None) -> DataFrame:
    """Replayed positions once; on a stream, within a watermark's delay on __kafka_ts (TIMESTAMP)."""
    if df.isStreaming:
        return df.withWatermark("__kafka_ts", delay or "1 day").dropDuplicatesWithinWatermark(list(position))
    return df.dropDuplicates(list(position))


def merge_months(spark: SparkSession, new: DataFrame, path: str, key: list[str], version: str, batch: tuple[str, int] | None = None) -> None:
    """Merges rows into a serving dataset (see months), keeping the latest version of each key in each month.

    Only the months of `new` are read and replaced. Running it twice with the same rows changes nothing.
    """
    months.merge(spark, new, path, key, lambda rows: latest(rows, ["ym", *key], version), batch)


def compact(spark: SparkSession, path: str, month: int, key: list[str], version: str) -> None:
    """Removes duplicates of one month, whose parts become one."""
    months.compact(spark, path, month, key, lambda rows: latest(rows, ["ym", *key], version))


def current_state(events: DataFrame, key: list[str], version: str = "_event_ts") -> DataFrame:
    """The latest event of each key, unless it's a deletion."""
    return latest(events, key, version).where("not _delete")
