"""Topics as sources and sinks: the broker's connector where its jar is present, else files of the same columns."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coerce, envelope

TOPIC = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
#: Of the sink's delivery profile: what always holds, what holds unless it's overridden (fixed values).
ALWAYS = {"acks": "all", "enable.idempotence": "true", "retries": "2147483647", "compression.type": "lz4"}
UNLESS = {"linger.ms": "50", "batch.size": "65536", "delivery.timeout.ms": "180000", "max.in.flight.requests.per.connection": "5"}
ALLOWED = {"linger.ms", "batch.size", "delivery.timeout.ms", "request.timeout.ms", "max.in.flight.requests.per.connection", "buffer.memory", "max.request.size", "client.id", "security.protocol"}


def options(servers: str, **overrides: str) -> dict[str, str]:
    """Options of the sink: the profile with overrides of known names; at most 5 requests in flight, so order holds."""
    own = {k.replace("_", "."): str(v) for k, v in overrides.items()}
    found = UNLESS | {k: v for k, v in own.items() if k in ALLOWED} | ALWAYS
    try:
        flight = int(found["max.in.flight.requests.per.connection"])
    except ValueError:
        flight = 5
    found["max.in.flight.requests.per.connection"] = str(min(5, max(1, flight)))
    return {"kafka.bootstrap.servers": servers} | {f"kafka.{k}": v for k, v in found.items()}


def read(spark: SparkSession, where: str, topic: str | None = None, block: int = 10_000, streaming: bool = False, schema: str = TOPIC) -> DataFrame:
    """A topic from its start: `where` is servers, with a topic, or else a folder of files of the topic's columns.

    block: back-pressure on streams, the most offsets of a micro-batch, or for a folder one file for each 10,000 of them, one at least.
    """
    reader = spark.readStream if streaming else spark.read
    if topic:
        reader = reader.format("kafka").option("kafka.bootstrap.servers", where).option("subscribe", topic).option("startingOffsets", "earliest")
        return (reader.option("maxOffsetsPerTrigger", block) if streaming else reader).load()
    reader = reader.schema(schema)
    return (reader.option("maxFilesPerTrigger", max(1, block // 10_000)) if streaming else reader).parquet(where)


def records(events: DataFrame, key: Column, value: Column, topic: Column, order: list[str], parts: int | None = None) -> DataFrame:
    """key, value, topic for the sink; a key's records are in one partition, in order."""
    t = events.select(key.alias("key"), value.alias("value"), topic.alias("topic"), *order)
    t = t.repartition(parts, "key") if parts else t.repartition("key")
    return t.sortWithinPartitions("key", *order)


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fields that are absent or null get their defaults."""
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(v)) if n in df.columns else F.lit(v) for n, v in defaults.items()})


def union_read(*parts: DataFrame) -> DataFrame:
    """Parts of a table that lie in different places, as one; absent columns are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def typed(rows: DataFrame, kinds: dict[str, object], value: str = "value", json_schema: str | None = None) -> DataFrame:
    """rows with schema_id, the body of a framed value as columns of these kinds (see functions.coerce), and _error.

    Bodies are JSON text; with json_schema, a schema in JSON, they are read by Spark's Avro functions, where that package is present. A
    value that isn't framed, a body that can't be read and a field that isn't of its kind are errors of the row. In a body, null is as good as
    absent: the field's Default holds, if it has one.
    """
    schema_id, body, fault = envelope.unframed(F.col(value))
    if json_schema:
        from pyspark.sql.avro.functions import from_avro

        raw = from_avro(body, json_schema, {"mode": "PERMISSIVE"})
        read = coerce.record(F.col("__body"), kinds)
    else:
        given = loose(kinds)
        text = F.make_valid_utf8(body.cast("string"))
        read = coerce.record(F.col("__body"), kinds, given=given)
        raw = F.when(text.rlike(r"^\s*\{") & F.get_json_object(text, "$").isNotNull(), F.from_json(text, given))
    t = rows.withColumn("schema_id", schema_id).withColumn("__body", raw).withColumn("__fault", fault)
    record, error = read
    unread = F.when(F.col("__body").isNull(), F.lit("the body can't be read"))
    t = t.withColumn("__record", record).withColumn("_error", F.coalesce("__fault", unread, error))
    own = lambda n, k: F.coalesce(F.col(f"__record.{n}"), coerce.literal(k.value, k.kind)) if isinstance(k, coerce.Default) else F.col(f"__record.{n}")
    return t.select(*rows.columns, "schema_id", *[own(n, k).alias(n) for n, k in kinds.items()], "_error")


def loose(kind: object) -> T.DataType:
    """The type to read JSON of a kind by: text wherever it is plain, so that what is wrong comes out as an error of its field and not as null."""
    if isinstance(kind, coerce.Default):
        return loose(kind.kind)
    if isinstance(kind, dict):
        return T.StructType([T.StructField(n, loose(k)) for n, k in kind.items()])
    if isinstance(kind, (list, tuple)):
        what, *of = kind
        some = [k for k in of if k != "null"]
        if what == "union" and len(some) == 1:
            return loose(some[0])
        if what in ("array", "map"):
            return T.ArrayType(loose(of[0])) if what == "array" else T.MapType(T.StringType(), loose(of[0]))
    return T.BinaryType() if kind == "bytes" or isinstance(kind, (list, tuple)) and kind[0] == "fixed" else T.StringType()


def again(gaps: list[tuple[int, int, int]], topic: str) -> dict[str, str]:
    """Options to read (partition, start, end) of a topic again, end exclusive; other partitions aren't read."""
    at = lambda i: json.dumps({topic: {str(g[0]): g[i] for g in sorted(gaps)}})
    return {"startingOffsets": at(1), "endingOffsets": at(2)}
