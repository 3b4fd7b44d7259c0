"""Counters of a change log: by entry, in all, by time window, by table; widths of rows."""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .cells import in_families, run_starts, runs


def _sizes(cells: Column, families: Iterable[str], starts: Column | None = None) -> Column:
    """Cells of each run of an entry; of filtered ones, the negative."""
    if starts is None:
        # Bound as a lambda's variable, the starts of an entry are found once and not for each run.
        return F.get(F.transform(F.array(run_starts()), lambda s: _sizes(cells, families, s)), F.lit(0))
    end = lambda i: F.coalesce(F.get(starts, i + 1), F.size(cells))
    return F.transform(starts, lambda s, i: F.when(in_families(F.slice(cells, s + 1, end(i) - s), families), end(i) - s).otherwise(s - end(i)))


def entry_summary(entries: DataFrame, families: Iterable[str] = (), *more: str | Column) -> DataFrame:
    """Per entry that has cells: wal_seq, more columns, rows seen, sent and filtered, cells seen, most cells of a sent row. An entry is one row, so nothing is shuffled."""
    sized = entries.where(F.size("cells") > 0).withColumn("__starts", run_starts()).withColumn("__sizes", _sizes(F.col("cells"), families, F.col("__starts")))
    return sized.select(
        "wal_seq", *more, F.size("__sizes").cast("bigint").alias("rows_seen"), F.size(F.filter("__sizes", lambda n: n > 0)).cast("bigint").alias("rows_sent"),
        F.size(F.filter("__sizes", lambda n: n < 0)).cast("bigint").alias("rows_filtered"), F.size("cells").cast("bigint").alias("cells_seen"),
        F.greatest(F.array_max("__sizes"), F.lit(0)).alias("max_cells_sent"),
    )


def run_totals(summary: DataFrame, **metrics: Column) -> DataFrame:
    """Entries, rows, cells and filtered rows in all; metrics: further aggregates by name."""
    return summary.agg(F.count("*").alias("entries"), F.sum("rows_seen").alias("rows"), F.sum("cells_seen").alias("cells"), F.sum("rows_filtered").alias("filtered"), *[c.alias(n) for n, c in metrics.items()])


def throughput(summary: DataFrame, at: str, seconds: int = 5) -> DataFrame:
    """Entries, rows and cells, in all and a second, by tumbling windows of the time column; windows without entries give no row."""
    t = summary.groupBy(F.window(at, f"{seconds} seconds").alias("w")).agg(F.count("*").alias("entries"), F.sum("rows_seen").alias("n_rows"), F.sum("cells_seen").alias("cells"), F.sum("rows_filtered").alias("filtered"))
    return t.select(F.col("w.start").alias("window_start"), "entries", "n_rows", (F.col("n_rows") / seconds).alias("rows_per_s"), "cells", (F.col("cells") / seconds).alias("cells_per_s"), "filtered")


def diagnostics(entries: DataFrame, options: DataFrame, families: Iterable[str] = (), least_rows: int = 500) -> DataFrame:
    """Per table: short keys, the widest row, the filter's share, and flags; options: table, salt, hint (a row a table)."""
    sent = in_families("run", families)
    t = runs(entries).join(options, "table", "left")
    t = t.groupBy("table").agg(
        F.count_if(F.octet_length("row") <= F.coalesce("salt", F.lit(0))).alias("short_keys"), F.max(F.when(sent, F.size("run"))).alias("widest"),
        F.count("*").alias("n_rows"), F.count_if(~sent).alias("filtered"), F.max("hint").alias("hint"),
    )
    share = F.col("filtered") / F.col("n_rows")
    enough = F.col("n_rows") >= least_rows
    return t.select(
        "table", "short_keys", "widest", "n_rows", "filtered", (F.col("short_keys") > 0).alias("flag_short_keys"),
        F.coalesce(F.col("widest") > F.col("hint"), F.lit(True)).alias("flag_hint"), (enough & (share < 0.01)).alias("flag_filter_idle"), (enough & (share >= 0.95)).alias("flag_filter_tight"),
    )


def widths(entries: DataFrame) -> DataFrame:
    """Rows by number of cells: up to 32, up to 4095, more."""
    n = F.size("run")
    return runs(entries).groupBy(F.when(n <= 32, "0-32").when(n < 4096, "33-4095").otherwise("4096+").alias("width")).agg(F.count("*").alias("n_rows"), F.sum(n).alias("cells"))


def filled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows by number of columns that aren't null."""
    n = F.size(F.filter(F.array(*[F.col(c).isNotNull() for c in columns]), lambda x: x))
    return df.groupBy(n.alias("filled")).agg(F.count("*").alias("n_rows"))


def filled_quantile(histogram: DataFrame, q: float) -> DataFrame:
    """The least number of filled columns that a share q of rows doesn't exceed, from the histogram of at most as many rows as columns, which is read once."""
    up_to = F.sum("n_rows").over(Window.orderBy("filled"))
    whole = F.sum("n_rows").over(Window.orderBy("filled").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return histogram.select("filled", up_to.alias("up_to"), whole.alias("all")).where(F.col("up_to") >= q * F.col("all")).agg(F.min("filled").alias("filled"))


def fill_sketches(df: DataFrame, columns: list[str], by: list[str], k: int = 400) -> DataFrame:
    """Per key of `by`, such as table and month: a quantile sketch of the rows' numbers of columns that aren't null, and n_rows. Sketches of whatever keys merge."""
    n = F.size(F.filter(F.array(*[F.col(c).isNotNull() for c in columns]), lambda x: x)).cast("bigint")
    return df.groupBy(*by).agg(F.kll_sketch_agg_bigint(n, F.lit(k)).alias("sketch"), F.count("*").alias("n_rows"))


def capacity(sketches: DataFrame, options: DataFrame, table: str = "table", q: float = 0.95) -> DataFrame:
    """Per table: n_rows, p50, p95 (or what q is) and p99 of filled columns by the merged sketches, and suggested, a capacity hint.

    The hint is that quantile, for columns that are filled in a usual row, and what every row has besides: n_pk key columns and n_meta
    declared metadata columns, of options (a row a table, see declared_columns). Ranks are right within the sketches' bound, about
    1.7 % at k = 200 and less than 1 % at 400; up to k rows they are exact. One pass over the sketches, whatever the rows behind them.
    """
    merged = sketches.groupBy(table).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"), F.sum("n_rows").alias("n_rows"))
    at = lambda rank: F.kll_sketch_get_quantile_bigint("sketch", F.lit(rank))
    t = merged.select(table, "n_rows", at(0.5).alias("p50"), at(q).alias("p95"), at(0.99).alias("p99")).join(options, table, "left")
    return t.select(table, "n_rows", "p50", "p95", "p99", (F.col("p95") + F.coalesce("n_pk", F.lit(0)) + F.coalesce("n_meta", F.lit(0))).alias("suggested"))


def declared_columns(catalog: DataFrame) -> DataFrame:
    """Per table of a schema catalog: n_pk, n_meta and the hint it has."""
    return catalog.groupBy("table").agg(F.count("pk_pos").cast("int").alias("n_pk"), F.count_if(F.col("name").isin("_event_ts", "_delete", "_wal_seq", "_wal_write_time")).cast("int").alias("n_meta"), F.max("hint").alias("hint"))


def counters(families: Iterable[str] = ()) -> dict[str, Column]:
    """Aggregates over entries that give the totals of run_totals, with no row for each entry between."""
    filtered = F.size(F.filter(_sizes(F.col("cells"), families), lambda n: n < 0))
    some = F.size("cells") > 0
    total = lambda c: F.coalesce(F.sum(F.when(some, c).cast("bigint")), F.lit(0).cast("bigint"))
    return {"entries": F.count_if(some), "rows": total(F.size(run_starts())), "cells": total(F.size("cells")), "filtered": total(filtered)}


class RunTotals(StreamingQueryListener):
    """Sums of the counters that running jobs observe in their micro-batches, by name; they cost no pass of their own.

    Add it by spark.streams.addListener and give its `name` to the job.
    """

    def __init__(self, name: str):
        self.name, self.totals, self.ended = name, Counter(), threading.Event()

    def onQueryStarted(self, event: object) -> None:
        self.ended.clear()

    def onQueryProgress(self, event: object) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self.totals.update({k: v for k, v in row.asDict().items() if v is not None})

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: object) -> None:
        self.ended.set()
