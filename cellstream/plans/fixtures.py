"""Change logs, topics and values derived from the given tables, in Spark and, for oracles, as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import encode, times
from ..operators import order
from ..spec import TableSpec

FAMILIES = ("d", "b")
#: The log's table: one key column, two value columns, one of them skipped in a variant.
SPEC = TableSpec.builder("ns:events").column("user", "string", "VARCHAR").column("event_type").column("value", "long", "BIGINT")
for _name, _kind in (("_event_ts", "long"), ("_delete", "boolean"), ("_wal_seq", "long"), ("_wal_write_time", "long")):
    SPEC.column(_name, _kind)
SPEC = SPEC.key("user").only(*FAMILIES).wide(8).build()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entries(spark: SparkSession, sf_dir: str, empty_every: int = 0) -> DataFrame:
    """Five events an entry, two cells an event."""
    e = table(spark, sf_dir, "events").withColumn("ms", times.to_millis(F.col("ts")))
    row = F.encode((F.col("user_id") % 3).cast("string"), "UTF-8")

    def cell(family: Column, qualifier: str, ms: Column, deleted: Column, value: Column) -> Column:
        return F.struct(row.alias("row"), family.alias("family"), F.lit(qualifier).alias("qualifier"), ms.alias("ts"), deleted.alias("is_delete"), value.alias("value"))

    one = cell(F.lit("d"), "event_type", F.col("ms"), F.col("event_type") == "error", F.encode("event_type", "UTF-8"))
    two = cell(F.when(F.col("event_id") % 7 == 0, "x").otherwise("b"), " Value", F.col("ms") + 1, F.lit(False), encode.integer(F.floor(F.col("value") * 100), 8))
    pairs = F.array_sort(F.collect_list(F.struct("event_id", F.array(one, two).alias("cells"))))
    t = e.groupBy(F.floor(F.col("event_id") / 5).alias("wal_seq")).agg(F.max("ms").alias("wal_write_time"), F.flatten(F.transform(pairs, lambda p: p["cells"])).alias("cells"))
    if empty_every:
        t = t.withColumn("cells", F.when(F.col("wal_seq") % empty_every == 0, F.slice("cells", 1, 0)).otherwise(F.col("cells")))
    return t.select("wal_seq", "wal_write_time", F.lit("ns:events").alias("table"), "cells")


CELLS_SQL = """
cells as (
  select event_id // 5 as wal_seq, 2 * event_id + k as idx, row_number() over (partition by event_id // 5 order by 2 * event_id + k) - 1 as cell_idx,
    (user_id % 3)::varchar as row, case when k = 0 then 'd' when event_id % 7 = 0 then 'x' else 'b' end as family,
    case when k = 0 then 'event_type' else ' Value' end as qualifier, epoch_us(ts) // 1000 + k as ts, k = 0 and event_type = 'error' as is_delete,
    case when k = 0 then event_type end as text, case when k = 1 then floor(value * 100)::bigint end as cents
  from events, (values (0), (1)) as t(k)),
marked as (select *, coalesce(row <> lag(row) over (partition by wal_seq order by idx), true) as is_new from cells),
runs as (select *, sum(is_new::int) over (partition by wal_seq order by idx) - 1 as run_idx from marked),
written as (select event_id // 5 as wal_seq, max(epoch_us(ts) // 1000) as wal_write_time from events group by 1),
rows as (
  select wal_seq, run_idx::int as run_idx, any_value(row) as "user", count(*) as n_cells, bool_or(family in ('d', 'b')) as sent,
    arg_max(text, idx) filter (text is not null and not is_delete) as event_type, arg_max(cents, idx) filter (cents is not null) as value,
    max(ts) as _event_ts, bool_or(is_delete) as _delete
  from runs group by wal_seq, run_idx)
"""


def topic_rows(spark: SparkSession, sf_dir: str, second: bool = False) -> DataFrame:
    """events as a topic of 12 partitions, with gaps, duplicates and null broker times; second: another read that missed some."""
    e = table(spark, sf_dir, "events").withColumn("part", (F.col("user_id") % 12).cast("int"))
    e = order.numbered(e, ["part"], "event_id").withColumn("offset", F.col("place") - 1).where("event_id % 101 <> 0")
    if second:
        e = e.where("event_id % 89 <> 0")
    e = e.withColumn("copy", F.explode(F.when(F.col("event_id") % 103 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return e.select("event_id", "user_id", "event_type", "value", "ts", "copy", F.col("part").alias("partition"), "offset", F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("timestamp"))


TOPIC_SQL = """
numbered as (select *, (user_id % 12)::int as part, row_number() over (partition by user_id % 12 order by event_id) - 1 as off from events),
topic as (
  select event_id, user_id, event_type, value, ts, copy, part as __kafka_partition, off as __kafka_offset, case when event_id % 10 <> 0 then ts end as bts
  from numbered, (values (0), (1)) as t(copy) where event_id % 101 <> 0 and (copy = 0 or event_id % 103 = 0)),
raw as (
  select event_id, user_id, event_type, ts as dt, __kafka_partition, __kafka_offset, coalesce(bts, timestamp '2024-02-01 12:00:00') as __kafka_ts,
    ts + interval 2 minute as __ingest_ts, copy from topic)
"""
NOW = "timestamp_ntz'2024-02-01 12:00:00'"


def landed(spark: SparkSession, sf_dir: str, second: bool = False) -> DataFrame:
    """Raw rows of the topic, each ingested two minutes after its event."""
    from ..operators import landing

    t = topic_rows(spark, sf_dir, second)
    fields = {"event_id": F.col("event_id"), "user_id": F.col("user_id"), "event_type": F.col("event_type"), "dt": F.col("ts"), "copy": F.col("copy"), "__in": F.col("ts") + F.expr("interval 2 minutes")}
    raw = landing.to_raw(t, fields, F.expr(NOW))
    return raw.withColumn("__ingest_ts", F.col("__in")).drop("__in").withColumn("ym", times.month(F.col("__ingest_ts")))


def keys(spark: SparkSession, sf_dir: str, special: bool = False) -> DataFrame:
    """Binary keys of a salt byte, a text ended by 00 and an integer; special: texts that hold 00 and FF every 11th row."""
    e = table(spark, sf_dir, "events")
    text = F.encode("event_type", "UTF-8")
    if special:
        from ..functions import rowkey

        text = F.when(F.col("event_id") % 11 == 0, rowkey.escaped(F.concat(text, F.lit(b"\x00\xff\x00"), text))).otherwise(text)
    body = F.concat(text, F.lit(b"\x00"), encode.integer(F.col("event_id"), 8))
    return e.select("event_id", "event_type", F.concat(encode.integer(F.col("event_id") % 8, 1, False), body).alias("key"))


def catalogs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of a schema catalog, ten fields a table."""
    e = table(spark, sf_dir, "events")
    kind = F.element_at(F.array(*map(F.lit, ("long", "string", "double"))), (F.col("user_id") % 3 + 1).cast("int"))
    old = e.select("event_id", F.concat(F.lit("t"), F.floor(F.col("event_id") / 10).cast("string")).alias("table"), (F.col("event_id") % 10).cast("int").alias("pos"), F.col("event_type").alias("name"), kind.alias("record_type"))
    new = old.where("event_id % 101 <> 0").withColumn("name", F.when(F.col("event_id") % 97 == 0, F.concat("name", F.lit("_2"))).otherwise(F.col("name")))
    new = new.withColumn("record_type", F.when(F.col("event_id") % 89 == 0, "bytes").otherwise(F.col("record_type")))
    return old.drop("event_id"), new.drop("event_id")


CATALOG_SQL = """
old_c as (select event_id, 't' || (event_id // 10) as "table", (event_id % 10)::int as pos, event_type as name, ['long', 'string', 'double'][user_id % 3 + 1] as record_type from events),
new_c as (select "table", pos, case when event_id % 97 = 0 then name || '_2' else name end as name, case when event_id % 89 = 0 then 'bytes' else record_type end as record_type from old_c where event_id % 101 <> 0)
"""
