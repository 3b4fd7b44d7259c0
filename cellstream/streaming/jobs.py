"""Continuous jobs: each is the batch form of an operator on micro-batches with a checkpoint, at least once, and safe to replay."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import landing, months, stats
from ..operators.cells import ENTRY, marked, row_events
from ..spec import TableSpec


def change_log(spark: SparkSession, path: str, files: int | None = 1) -> DataFrame:
    """A stream of entries, `files` files a micro-batch; None: all that are there, which Spark deals to the cores by size."""
    stream = spark.readStream.schema(ENTRY)
    return (stream.option("maxFilesPerTrigger", files) if files else stream).parquet(path)


def _started(df: DataFrame, path: str, checkpoint: str, partition: list[str] | None = None) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.partitionBy(*partition) if partition else writer).start()


def change_events(entries: DataFrame, spec: TableSpec, path: str, checkpoint: str, totals: str | None = None) -> StreamingQuery:
    """Entries to row events; stopping and starting on the checkpoint goes on where it ended. totals: a name under which the job's counters are observed (see stats.RunTotals)."""
    if totals:
        entries = entries.observe(totals, *[c.alias(n) for n, c in stats.counters(spec.families).items()])
    return _started(row_events(entries, spec), path, checkpoint)


def split_events(entries: DataFrame, spec: TableSpec, path: str, checkpoint: str) -> StreamingQuery:
    """Entries to row events, good ones and quarantined ones in parts of one dataset (see cells.landed_split), in one pass."""
    return _started(marked(row_events(entries, spec)), path, checkpoint, ["quarantined"])


def _by_batch(rows: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], object]) -> StreamingQuery:
    return rows.writeStream.foreachBatch(lambda batch, number: each(batch, number) and None).option("checkpointLocation", f"{checkpoint}/offsets").trigger(availableNow=True).start()


def raw(topic_rows: DataFrame, convert: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, sort: list[str], name: str = "raw") -> StreamingQuery:
    """Topic rows to the raw dataset (see months), a part each micro-batch; one that is run again adds nothing. name: of the stream, one for each checkpoint that writes to the dataset."""
    return _by_batch(topic_rows, checkpoint, lambda batch, number: months.append(batch.sparkSession, convert(batch), path, sort, (name, number)))


def serving(raw_rows: DataFrame, convert: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, key: list[str], version: str, name: str = "serving") -> StreamingQuery:
    """Raw rows merged into the serving dataset; a micro-batch that is run again changes nothing."""
    return _by_batch(raw_rows, checkpoint, lambda batch, number: landing.merge_months(batch.sparkSession, convert(batch), path, key, version, (name, number)))


def deduplicated(raw_rows: DataFrame, path: str, checkpoint: str, position: tuple[str, ...] = ("__kafka_partition", "__kafka_offset"), delay: str = "1 day") -> StreamingQuery:
    """Raw rows without replayed positions, within the watermark's delay on __kafka_ts; what was seen is kept in the checkpoint's state, from one run to the next."""
    return _started(landing.once(raw_rows, position, delay), path, checkpoint)


def throughput(entries: DataFrame, path: str, checkpoint: str, seconds: int = 5, late: str = "1 minute", families: Iterable[str] = ()) -> StreamingQuery:
    """Counters by window; a window is written once its time and the delay for late entries are over."""
    timed = entries.withColumn("at", F.timestamp_millis("wal_write_time")).withWatermark("at", late)
    counted = stats.entry_summary(timed, families, "at")
    return _started(stats.throughput(counted, "at", seconds), path, checkpoint)


DRIFT = "subject string, part int, seq bigint, before string, after string"


def schema_drift(frames: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Changes of a subject's schema: a row for each frame whose fingerprint isn't that of the frame before, by subject and part.

    frames: subject, part (of the topic), seq (the offset there) and fingerprint. The last fingerprint of each subject and part is
    kept in the checkpoint's state, so it holds from one run to the next; frames of offsets that are done are passed over. A
    task holds a micro-batch's frames of one subject and part: their numbers and fingerprints only.
    """

    def changes(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, done = state.get if state.exists else (None, -1)
        rows = pd.concat([p[["seq", "fingerprint"]] for p in parts]).sort_values("seq", kind="stable")
        rows = rows[(rows["seq"] > done) & rows["fingerprint"].notna()]
        if len(rows):
            before = rows["fingerprint"].shift(1, fill_value=last) if last is not None else rows["fingerprint"].shift(1)
            changed = (before != rows["fingerprint"]) & before.notna()
            state.update((rows["fingerprint"].iloc[-1], int(rows["seq"].iloc[-1])))
            found = pd.DataFrame({"seq": rows["seq"][changed], "before": before[changed].astype(object), "after": rows["fingerprint"][changed].astype(object)})
            yield found.assign(subject=key[0], part=key[1])[["subject", "part", "seq", "before", "after"]]

    keyed = frames.select("subject", F.col("part").cast("int").alias("part"), F.col("seq").cast("bigint").alias("seq"), F.col("fingerprint").cast("string").alias("fingerprint")).groupBy("subject", "part")
    return _started(keyed.applyInPandasWithState(changes, DRIFT, "fingerprint string, seq bigint", "append", GroupStateTimeout.NoTimeout), path, checkpoint)
