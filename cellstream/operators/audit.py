"""Audits of landed topics: gaps, duplicates, rates, freshness, completeness between reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

P, O = "__kafka_partition", "__kafka_offset"


def offset_audit(df: DataFrame) -> DataFrame:
    """Per partition: least and largest offset, distinct ones, the span, missing ones and duplicates; two sums a key, no sort."""
    by_offset = df.groupBy(P, O).agg(F.count("*").alias("n"))
    t = by_offset.groupBy(P).agg(F.min(O).alias("min_offset"), F.max(O).alias("max_offset"), F.count("*").alias("unique_offsets"), F.sum("n").alias("n_rows"))
    span = F.col("max_offset") - F.col("min_offset") + 1
    return t.select(P, "min_offset", "max_offset", "unique_offsets", span.alias("expected"), (span - F.col("unique_offsets")).alias("missing_offsets"), (F.col("n_rows") - F.col("unique_offsets")).alias("duplicates"))


def offset_gaps(df: DataFrame) -> DataFrame:
    """Partitions with missing offsets, worst first."""
    return offset_audit(df).where("missing_offsets > 0").select(P, "missing_offsets").orderBy(F.desc("missing_offsets"), P)


def rows_per_partition(df: DataFrame) -> DataFrame:
    return df.groupBy(P).agg(F.count("*").alias("n_rows"))


def last_offset(df: DataFrame) -> DataFrame:
    return df.groupBy(P).agg(F.max(O).alias("last_offset"))


def ingest_rate(df: DataFrame, as_of: Column, minutes: int = 15) -> DataFrame:
    """Offsets gained per partition by the rows ingested in the last minutes."""
    recent = df.where((F.col("__ingest_ts") >= as_of - F.expr(f"interval {minutes} minutes")) & (F.col("__ingest_ts") <= as_of))
    return recent.groupBy(P).agg((F.max(O) - F.min(O)).alias("gained"), F.count("*").alias("n_rows")).orderBy(F.desc("gained"), P)


def freshness(df: DataFrame, as_of: Column, alert: int = 300) -> DataFrame:
    t = df.agg(F.max("__ingest_ts").alias("last_ingest"))
    lag = F.timestamp_diff("SECOND", F.col("last_ingest"), as_of)
    return t.select("last_ingest", lag.alias("lag_s"), (lag > alert).alias("alert"))


def reconcile(left: DataFrame, right: DataFrame, position: list[str]) -> DataFrame:
    """How many positions are in one read alone, and in both."""
    a, b = (d.select(*position).distinct().withColumn(side, F.lit(True)) for d, side in ((left, "l"), (right, "r")))
    side = F.when(F.col("r").isNull(), "only_left").when(F.col("l").isNull(), "only_right").otherwise("both")
    return a.join(b, position, "full").groupBy(side.alias("side")).agg(F.count("*").alias("n"))


def missing(left: DataFrame, right: DataFrame, position: list[str]) -> DataFrame:
    """Rows of left whose position isn't in right: what to fill a gap with."""
    return left.join(right.select(*position).distinct(), position, "left_anti")


def out_of_order(df: DataFrame, key: str, sequence: str) -> DataFrame:
    """Rows of a key whose sequence is less than that of the row before, by partition and offset."""
    w = Window.partitionBy(P, key).orderBy(O)
    return df.withColumn("before", F.lag(sequence).over(w)).where(F.col("before") > F.col(sequence)).select(P, O, key, sequence, "before")


def gap_ranges(df: DataFrame, span: int = 1 << 20) -> DataFrame:
    """Per partition, the ranges of offsets that are missing between its least and its largest: first_missing, last_missing, n_missing.

    Offsets are dealt out by ranges of `span` of them, so the most that one task sorts is a range, whatever a partition holds;
    what is missing between two ranges comes from their edges, one row a range.
    """
    at = df.select(P, O, F.floor(F.col(O) / span).alias("__range")).repartition(P, "__range").groupBy(P, "__range", O).agg(F.lit(1).alias("__one"))
    missing_before = lambda t, first, last, w: t.withColumn("__before", F.lag(last).over(w)).where(F.col(first) > F.col("__before") + 1).select(P, (F.col("__before") + 1).alias("first_missing"), (F.col(first) - 1).alias("last_missing"))
    within = missing_before(at, O, O, Window.partitionBy(P, "__range").orderBy(O))
    edges = at.groupBy(P, "__range").agg(F.min(O).alias("__low"), F.max(O).alias("__high"))
    between = missing_before(edges, "__low", "__high", Window.partitionBy(P).orderBy("__range"))
    return within.unionAll(between).withColumn("n_missing", F.col("last_missing") - F.col("first_missing") + 1)


def second_read(gaps: DataFrame) -> DataFrame:
    """Per partition with gaps, where to read again: from start, up to end (exclusive), as brokers' offsets go; n_missing of what lies there is wanted."""
    return gaps.groupBy(P).agg(F.min("first_missing").alias("start"), (F.max("last_missing") + 1).alias("end"), F.sum("n_missing").alias("n_missing"))


def refill(source: DataFrame, landed: DataFrame, span: int = 1 << 20) -> DataFrame:
    """Rows of source, of the same columns, at offsets that landed lacks between its least and its largest, by partition."""
    again = second_read(gap_ranges(landed, span)).select(P, "start", "end")  # a row a partition
    wanted = source.join(again, P).where((F.col(O) >= F.col("start")) & (F.col(O) < F.col("end"))).drop("start", "end")
    return missing(wanted.select(source.columns), landed, [P, O])
