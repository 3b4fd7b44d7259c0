"""Queries over topics, landing datasets, audits and schemas, with their SQL."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import coerce, envelope, names, times
from ..operators import audit, cells, landing, months, schemas, stats
from ..scratch import new_path
from ..sources import catalog, topics
from ..streaming import jobs
from .fixtures import CATALOG_SQL, CELLS_SQL, FAMILIES, NOW, SPEC, TOPIC_SQL, catalogs, entries, landed, table, topic_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
AS_OF = "timestamp_ntz'2024-01-30 12:00:00'"
K = ["__kafka_partition", "__kafka_offset"]


def query(sql: str | None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", F.col("event_id"))


# Projections


@query("select o_orderkey as k, case when o_orderkey % 13 <> 0 then o_orderdate::timestamp end as at from orders")
def epoch_ms_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.when(F.col("o_orderkey") % 13 != 0, times.to_millis(F.col("o_orderdate").cast("timestamp_ntz")))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), times.from_millis(ms).alias("at"))


@query("""select o_orderkey as k, (o_orderkey % 300) % 256 as u8, case when (o_orderkey % 300) > 127 and (o_orderkey % 300) <= 255 then (o_orderkey % 300) - 256 when o_orderkey % 300 > 255 then o_orderkey % 300 - 256 else o_orderkey % 300 end as i8,
case when o_orderkey % 300 <= 255 then o_orderkey % 300 end as n8 from orders""")
def narrow_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("o_orderkey") % 300
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), coerce.narrowed(code, 8, False).alias("u8"), coerce.narrowed(code, 8).alias("i8"), coerce.narrowed(code, 8, False, "null").alias("n8"))


@query(f"with {TOPIC_SQL} select event_id, copy, __kafka_ts from raw")
def kafka_ts_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.to_raw(topic_rows(spark, sf_dir), {"event_id": F.col("event_id"), "copy": F.col("copy")}, F.expr(NOW)).select("event_id", "copy", "__kafka_ts")


@query(f"with {TOPIC_SQL} select event_id, copy, __kafka_partition, __kafka_offset from raw")
def source_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.to_raw(topic_rows(spark, sf_dir), {"event_id": F.col("event_id"), "copy": F.col("copy")}, F.expr(NOW)).select("event_id", "copy", *K)


@query(f"with {TOPIC_SQL} select event_id, copy, timestamp '2024-02-01 12:00:00' as __ingest_ts, timestamp '2024-02-01 12:00:00' as ver from raw")
def stamp_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = landing.to_raw(topic_rows(spark, sf_dir), {"event_id": F.col("event_id"), "copy": F.col("copy")}, F.expr(NOW))
    return landing.to_serving(t, None, F.expr(NOW), keep_ingest=True).select("event_id", "copy", "__ingest_ts", "ver")


@query("select event_id as k, (event_type = 'error')::int as _delete from events")
def bool_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("k", (F.col("event_type") == "error").cast("int").alias("_delete"))


@query("select o_orderkey as k, case when o_orderkey % 7 = 0 then 202401 else (year(o_orderdate) * 100 + month(o_orderdate))::int end as ym from orders")
def month_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    dt = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate").cast("timestamp_ntz"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), times.month(dt, F.expr(AS_OF)).alias("ym"))


@query(f"with {TOPIC_SQL} select event_id, user_id, event_type, dt, copy, __kafka_partition, __kafka_offset, __kafka_ts, timestamp '2024-02-01 12:00:00' as ver, (year(dt) * 100 + month(dt))::int as ym from raw")
def raw_to_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.to_serving(landed(spark, sf_dir), "dt", F.expr(NOW))


@query("select event_id as k, case when event_id % 3 = 0 then 'none' else event_type end as event_type, 0 as version from events")
def missing_fields_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _events(spark, sf_dir).select("k", F.when(F.col("k") % 3 != 0, F.col("event_type")).alias("event_type"))
    return topics.with_defaults(t, {"event_type": "none", "version": 0})


@query("select event_id % 4 = 0 as bad, count(*) as n, sum(event_id)::bigint as ids from events group by 1")
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and broken rows, written in one pass over their source and read apart."""
    path = new_path(spark, "split")
    cells.landed_split(_events(spark, sf_dir).select("k", F.when(F.col("k") % 4 == 0, F.lit("broken")).alias("_error")), path)
    both = cells.good_of(spark, path).select("k", F.lit(False).alias("bad")).unionAll(cells.broken_of(spark, path).select("k", F.lit(True).alias("bad")))
    return both.groupBy("bad").agg(F.count("*").alias("n"), F.sum("k").alias("ids"))


@query("""select event_id as k, case when event_id % 11 <> 0 then user_id end as schema_id, case when event_id % 11 <> 0 and event_id % 13 <> 0 and event_id % 7 <> 0 then user_id end as n, case when event_id % 11 <> 0 and event_id % 13 <> 0 then event_type end as tag,
case when event_id % 11 <> 0 and event_id % 13 <> 0 then case when event_id % 5 = 0 then 'none' else event_type || event_id end end as note,
case when event_id % 11 = 0 then 'no framed message' when event_id % 13 = 0 then 'the body can''t be read' when event_id % 7 = 0 then 'n: not a long: x' || user_id end as error from events""")
def typed_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed bodies as typed columns: some values aren't framed, some bodies can't be read, some fields are of another kind, some are absent."""
    k, user = F.col("k"), F.col("user_id").cast("string")
    text = F.concat(F.lit('{"n": "'), F.when(k % 7 == 0, "x").otherwise(""), user, F.lit('", "tags": {"t": "'), "event_type", F.lit('"}'), F.when(k % 5 != 0, F.concat(F.lit(', "note": "'), "event_type", k.cast("string"), F.lit('"'))).otherwise(""), F.when(k % 13 != 0, "}").otherwise(""))
    body = F.encode(text, "UTF-8")
    t = _events(spark, sf_dir).select("k", F.when(k % 11 == 0, F.concat(F.lit(b"\x01"), body)).otherwise(envelope.framed(body, F.col("user_id"))).alias("value"))
    got = topics.typed(t, {"n": "long", "tags": ("map", "string"), "note": coerce.Default("string", "none")})
    ok = F.col("schema_id").isNotNull() & (k % 13 != 0)
    return got.select("k", "schema_id", "n", F.when(ok, F.try_element_at("tags", F.lit("t"))).alias("tag"), F.when(ok, F.col("note")).alias("note"), F.col("_error").alias("error"))


@query("""select event_id, lower(hex(unhex('00' || '0000002A') || encode(event_type))) as value, (user_id % 3)::varchar as key, 'ns_events' as topic from events""")
def kafka_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _events(spark, sf_dir)
    body = envelope.framed(F.encode("event_type", "UTF-8"), F.lit(42))
    sent = topics.records(t, F.encode((F.col("user_id") % 3).cast("string"), "UTF-8"), body, names.topic(F.lit("ns"), F.lit("events")), ["event_id"])
    return sent.select("event_id", F.lower(F.hex("value")).alias("value"), F.decode("key", "UTF-8").alias("key"), "topic")


@query("select event_id as k, lower('00' || lpad(hex(user_id), 8, '0') || hex(encode(event_type))) as framed from events")
def frame_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("k", F.lower(F.hex(envelope.framed(F.encode("event_type", "UTF-8"), F.col("user_id")))).alias("framed"))


@query("select event_id as k, case when event_id % 9 <> 0 then user_id end as id, case when event_id % 9 <> 0 then event_type end as body, case when event_id % 9 = 0 then 'no framed message' end as error from events")
def frame_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.encode("event_type", "UTF-8")
    value = F.when(F.col("k") % 9 == 0, F.concat(F.lit(b"\x01"), body)).otherwise(envelope.framed(body, F.col("user_id")))
    i, b, e = envelope.unframed(F.col("v"))
    return _events(spark, sf_dir).withColumn("v", value).select("k", i.alias("id"), F.decode(b, "UTF-8").alias("body"), e.alias("error"))


@query("""select event_id as k, case when event_type < 'user' then event_type || '=' || event_id || ',user=' || user_id else 'user=' || user_id || ',' || event_type || '=' || event_id end as m from events""")
def map_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.create_map(F.lit("user"), F.col("user_id"), F.col("event_type"), F.col("event_id"))
    pairs = F.map_entries(coerce.sorted_map(m))
    return _events(spark, sf_dir).select("k", F.array_join(F.transform(pairs, lambda p: F.concat_ws("=", p["key"], p["value"].cast("string"))), ",").alias("m"))


_LOOSE = ("1", "0", "TRUE", " false ", "yes", "not-a-bool")
_LOOSE_SQL = "['1', '0', 'TRUE', ' false ', 'yes', 'not-a-bool'][l_orderkey % 6 + 1]"


def _loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.element_at(F.array(*map(F.lit, _LOOSE)), (F.col("l_orderkey") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"), "l_orderkey", "l_quantity", "l_returnflag", v.alias("v"))


@query(f"select l_orderkey * 8 + l_linenumber as k, case lower(trim({_LOOSE_SQL})) when '1' then true when 'true' then true when '0' then false when 'false' then false end as value, case when l_orderkey % 6 >= 4 then 'f: not a boolean: ' || {_LOOSE_SQL} end as error from lineitem")
def coerce_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e = coerce.boolean(F.col("v"), "f")
    return _loose(spark, sf_dir).select("k", v.alias("value"), e.alias("error"))


@query("select doc_id as k, case when lang in ('en', 'de') then lang end as value, case when lang not in ('en', 'de') then 'lang: not a symbol: ' || lang end as error from documents")
def coerce_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e = coerce.enum(F.col("lang"), ["en", "de"], "lang")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), v.alias("value"), e.alias("error"))


@query("select event_id as k, case when event_id % 5 <> 0 then 16 end as n, case when event_id % 5 = 0 then 'id: 16 bytes expected, got 15' end as error from events")
def coerce_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.encode(F.lpad(F.col("event_id").cast("string"), 16, "0"), "UTF-8")
    v, e = coerce.fixed(F.when(F.col("event_id") % 5 == 0, F.substring(b, 1, 15)).otherwise(b), 16, "id")
    return _events(spark, sf_dir).select("k", F.octet_length(v).alias("n"), e.alias("error"))


@query(f"""select l_orderkey * 8 + l_linenumber as k, case when l_orderkey % 6 < 2 then 'long' when l_orderkey % 6 < 4 then 'boolean' else 'string' end as branch,
case l_orderkey % 6 when 2 then 'true' when 3 then 'false' else {_LOOSE_SQL} end as value from lineitem""")
def coerce_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    branch, v, _ = coerce.union(F.col("v"), ["null", "long", "boolean", "string"], "f")
    return _loose(spark, sf_dir).select("k", branch.alias("branch"), v.alias("value"))


@query(f"""select l_orderkey * 8 + l_linenumber as k, l_orderkey as id, case lower(trim({_LOOSE_SQL})) when '1' then true when 'true' then true when '0' then false when 'false' then false end as ok, l_quantity::int::bigint as part,
case when l_orderkey % 6 >= 4 then 'flags.ok: not a boolean: ' || {_LOOSE_SQL} when l_returnflag = 'A' then 'parts[1]: not a long' end as error from lineitem""")
def coerce_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity").cast("int").cast("string")
    t = _loose(spark, sf_dir).withColumn("r", F.struct(F.col("l_orderkey").cast("string").alias("id"), F.struct(F.col("v").alias("ok")).alias("flags"), F.array(q, F.when(F.col("l_returnflag") == "A", "x").otherwise("7")).alias("parts")))
    v, e = coerce.record(F.col("r"), {"id": "long", "flags": {"ok": "boolean"}, "parts": ["array", "long"]})
    return t.withColumn("c", v).select("k", F.col("c.id").alias("id"), F.col("c.flags.ok").alias("ok"), F.get("c.parts", F.lit(0)).alias("part"), e.alias("error"))


@query(f"""with t as (select l_orderkey * 8 + l_linenumber as k, {_LOOSE_SQL} as v, l_returnflag as f, case when l_linenumber % 2 = 0 then 'abcd' else 'abc' end as code from lineitem)
select k, case when v in ('1', '0') then v::bigint end as b, case when f in ('A', 'N') then f end as flag, case when code = 'abcd' then 4 end as n,
case when v in ('1', '0') then 'long' else 'string' end as branch,
case when v not in ('1', '0') then 'm.b: not a long' when f not in ('A', 'N') then 'flag: not a symbol: ' || f when code = 'abc' then 'code: 4 bytes expected, got 3' end as error from t""")
def coerce_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map, an enum, fixed bytes and a union within a record."""
    code = F.encode(F.when(F.col("k") % 8 % 2 == 0, "abcd").otherwise("abc"), "UTF-8")
    of = F.struct(F.create_map(F.lit("b"), F.col("v"), F.lit("a"), F.lit("7")).alias("m"), F.col("l_returnflag").alias("flag"), code.alias("code"), F.col("v").alias("u"))
    value, error = coerce.record(F.col("r"), {"m": ("map", "long"), "flag": ("enum", "A", "N"), "code": ("fixed", 4), "u": ("union", "null", "long", "string")})
    t = _loose(spark, sf_dir).withColumn("r", of).select("k", value.alias("c"), error.alias("error"))
    return t.select("k", F.col("c.m")["b"].alias("b"), F.col("c.flag").alias("flag"), F.octet_length("c.code").alias("n"), F.col("c.u.branch").alias("branch"), "error")


_ANY = ("union", "null", "int", "float", "bytes", ("enum", "A", "N"), ("array", "long"), ("map", "double"), {"x": "long", "y": coerce.Default("string", "none")})


@query("""select l_orderkey * 8 + l_linenumber as k, case when l_linenumber <> 2 then 'int ' || l_linenumber end as of_int, 'float ' || floor(l_quantity)::int as of_double, 'bytes ' || l_returnflag as of_bytes,
case when l_returnflag in ('A', 'N') then 'enum ' || l_returnflag end as of_text, 'array ' || l_orderkey || ',' || l_linenumber as of_array, 'map a=' || l_linenumber || ',b=' || l_orderkey as of_map, 'record ' || l_orderkey || ' none' as of_struct,
case when l_returnflag not in ('A', 'N') then 'of_text: no branch fits' end as error from lineitem""")
def coerce_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One union of seven branches, met by values of seven types, null among them."""
    o, n, q = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity")
    given = {
        "of_int": F.when(n != 2, n.cast("int")), "of_double": F.floor(q).cast("double"), "of_bytes": F.encode("l_returnflag", "UTF-8"), "of_text": F.col("l_returnflag"), "of_array": F.array(o, n.cast("bigint")),
        "of_map": F.create_map(F.lit("b"), o, F.lit("a"), n.cast("bigint")), "of_struct": F.struct(o.alias("x")),
    }
    t = table(spark, sf_dir, "lineitem").select((o * 8 + n).alias("k"), F.struct(*[c.alias(name) for name, c in given.items()]).alias("r"))
    kinds = {name: _ANY if name != "of_double" else ("union", "null", "float", "bytes") for name in given}
    value, error = coerce.record(F.col("r"), kinds, given=t.schema["r"].dataType, strict=True)
    t = t.select("k", value.alias("c"), error.alias("error"))
    text = lambda u, branch: {
        "bytes": lambda x: F.decode(x, "UTF-8"), "array": lambda x: F.array_join(x.cast("array<string>"), ","), "record": lambda x: F.concat_ws(" ", x["x"].cast("string"), x["y"]), "float": lambda x: x.cast("int").cast("string"),
        "map": lambda x: F.array_join(F.transform(F.map_entries(x), lambda e: F.concat_ws("=", e["key"], e["value"].cast("bigint").cast("string"))), ","),
    }.get(branch, lambda x: x.cast("string"))(u[branch])
    names = {n: [b for b, _ in coerce.branches(k[1:])] for n, k in kinds.items()}
    shown = [F.coalesce(*[F.when(F.col(f"c.{n}.branch") == b, F.concat(F.lit(f"{b} "), text(F.col(f"c.{n}"), b))) for b in names[n]]).alias(n) for n in kinds]
    return t.select("k", *shown, "error")


_ODD = "case event_id % 4 when 0 then '..' || event_type || '__x' when 1 then event_type || '/' || user_id else event_type end"


@query(f"""with t as (select event_id as k, case when event_id % 2 = 0 then 'default' else 'ns' end as ns, {_ODD} as q from events)
select k, left(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(case when ns = 'default' then q else 'ns_' || q end, '^[._-]+', ''), '__+', '_', 'g'), '\\.\\.+', '.', 'g'), '--+', '-', 'g'), '[^a-zA-Z0-9._-]', '_', 'g'), 20) as topic from t""")
def topic_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    ns = F.when(F.col("event_id") % 2 == 0, "default").otherwise("ns")
    return _events(spark, sf_dir).select("k", names.topic(ns, F.expr(_ODD), longest=20).alias("topic"))


@query(f"select event_id as k, event_id % 4 <> 1 and event_id % 16 <> 2 as valid from events")
def topic_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.when(F.col("event_id") % 16 == 2, "..").otherwise(F.expr(_ODD))
    return _events(spark, sf_dir).select("k", names.topic_valid(t).alias("valid"))


@query("select event_id as k, 'p-NS:' || upper(event_type) || '-value' as subject from events")
def subject_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("k", names.subject(F.lit("ns"), F.col("event_type"), "table-upper", "p-").alias("subject"))


@query("select event_id as k, case when user_id::varchar = event_type then event_type else event_type || ',' || user_id end as list from events")
def cf_list_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    csv = F.concat(F.lit(" , "), F.col("event_type"), F.lit(" ,"), F.col("user_id").cast("string"), F.lit(",,"), F.col("event_type"), F.lit(" "))
    return _events(spark, sf_dir).select("k", F.array_join(names.clean_list(csv), ",").alias("list"))


@query("select event_id as k, ['VARCHAR', 'DECIMAL', 'VARCHAR ARRAY', 'UNSIGNED INT', 'VARCHAR', 'VARCHAR', 'VARCHAR'][event_id % 7 + 1] as type from events")
def type_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = ("VARCHAR(100)", "DECIMAL(10,2)", "ARRAY<VARCHAR>", "  unsigned   int  ", "STRING", "UNKNOWN_TYPE", "BIGINT ARRAY")
    return _events(spark, sf_dir).select("k", names.source_type(F.element_at(F.array(*map(F.lit, given)), (F.col("k") % 7 + 1).cast("int"))).alias("type"))


# Topics, raw and serving


@query(f"with {TOPIC_SQL} select event_id, copy, __kafka_partition as partition, __kafka_offset as \"offset\" from topic")
def topic_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "topic")
    topic_rows(spark, sf_dir).write.parquet(path)
    return topics.read(spark, path, schema="event_id bigint, copy int, partition int, offset bigint")


@query(f"with {TOPIC_SQL} select event_id, copy, __kafka_partition, __kafka_offset, __ingest_ts, (year(__ingest_ts) * 100 + month(__ingest_ts))::int as ym from raw")
def raw_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "raw")
    months.append(spark, landed(spark, sf_dir), path, K)
    return months.read(spark, path).select("event_id", "copy", *K, "__ingest_ts", "ym")


@query(f"with {TOPIC_SQL} select event_id, max(copy)::int as copy, __kafka_partition, __kafka_offset, (year(dt) * 100 + month(dt))::int as ym from raw group by all")
def serving_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = landing.to_serving(landed(spark, sf_dir), "dt", F.col("copy"))
    path = new_path(spark, "serving")
    for part in (t.where("event_id % 2 = 0"), t.where("event_id % 2 = 1"), t.where("event_id % 10 = 0")):
        landing.merge_months(spark, part, path, K, "ver")
    return months.read(spark, path).select("event_id", "copy", *K, "ym")


@query(f"with {TOPIC_SQL} select event_id, copy, case when event_id % 2 = 1 then event_type end as event_type from raw")
def raw_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = landed(spark, sf_dir)
    return topics.union_read(t.where("event_id % 2 = 1").select("event_id", "copy", "event_type"), t.where("event_id % 2 = 0").select("event_id", "copy"))


@query(f"with {TOPIC_SQL} select __kafka_partition, __kafka_offset, max(copy)::int as copy, any_value(event_id) as event_id from raw group by 1, 2")
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.latest(landed(spark, sf_dir).select(*K, "copy", "event_id"), K, "copy")


@query(f"with {TOPIC_SQL} select distinct __kafka_partition, __kafka_offset, event_id from raw")
def dedupe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.once(landed(spark, sf_dir)).select(*K, "event_id")


@query(f"with {TOPIC_SQL} select ym, count(*) as n from (select distinct (year(__ingest_ts) * 100 + month(__ingest_ts))::int as ym, __kafka_partition, __kafka_offset from raw) group by 1")
def compact_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "compact")
    months.append(spark, landed(spark, sf_dir), path, K)
    for month in (202401, 202402):
        landing.compact(spark, path, month, K, "copy")
    return months.read(spark, path).groupBy("ym").agg(F.count("*").alias("n"))


@query(f"with {TOPIC_SQL} select event_id, copy from raw where __ingest_ts >= timestamp '2024-01-30 12:00:00' - interval 10 day")
def ttl_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw dataset after its retention job."""
    path = new_path(spark, "ttl-raw")
    months.append(spark, landed(spark, sf_dir), path, K)
    months.retire(spark, path, 10, datetime.datetime(2024, 1, 30, 12), ["__ingest_ts"], K)
    return months.read(spark, path).select("event_id", "copy")


@query(f"with {TOPIC_SQL} select event_id, copy from raw where coalesce(case when event_id % 3 <> 0 then dt end, __kafka_ts) >= timestamp '2024-01-30 12:00:00' - interval 15 day")
def ttl_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset in months of business time, else broker time, after its retention job."""
    t = landed(spark, sf_dir).withColumn("dt", F.when(F.col("event_id") % 3 != 0, F.col("dt")))
    path = new_path(spark, "ttl-serving")
    months.append(spark, t.withColumn("ym", times.month(F.col("dt"), F.col("__kafka_ts"))), path, K)
    months.retire(spark, path, 15, datetime.datetime(2024, 1, 30, 12), ["dt", "__kafka_ts"], K)
    return months.read(spark, path).select("event_id", "copy")


@query("""select user_id as "user", last_id from (select user_id, max(event_id) as last_id, arg_max(event_type, event_id) as last_type from events group by 1) where last_type <> 'error'""")
def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _events(spark, sf_dir).select(F.col("user_id").alias("user"), F.col("event_id").alias("last_id"), (F.col("event_type") == "error").alias("_delete"))
    return landing.current_state(t, ["user"], "last_id").select("user", "last_id")


# Audits

_AUDIT = """select __kafka_partition, min(__kafka_offset) as min_offset, max(__kafka_offset) as max_offset, count(distinct __kafka_offset) as unique_offsets, max(__kafka_offset) - min(__kafka_offset) + 1 as expected,
max(__kafka_offset) - min(__kafka_offset) + 1 - count(distinct __kafka_offset) as missing_offsets, count(*) - count(distinct __kafka_offset) as duplicates from raw group by 1"""


@query(f"with {TOPIC_SQL} {_AUDIT}")
def offset_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.offset_audit(landed(spark, sf_dir))


@query(f"with {TOPIC_SQL} select __kafka_partition, missing_offsets from ({_AUDIT}) where missing_offsets > 0")
def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.offset_gaps(landed(spark, sf_dir))


_GAPS = """offs as (select distinct __kafka_partition, __kafka_offset as o from {0}), steps as (select __kafka_partition, o, lag(o) over (partition by __kafka_partition order by o) as b from offs),
gaps as (select __kafka_partition, b + 1 as first_missing, o - 1 as last_missing, o - b - 1 as n_missing from steps where o > b + 1)"""
_SHORT = "short as (select * from raw where event_id % 89 <> 0)"


@query(f"with {TOPIC_SQL}, {_GAPS.format('raw')} select * from gaps")
def gap_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.gap_ranges(landed(spark, sf_dir), span=256)


@query(f"with {TOPIC_SQL}, {_GAPS.format('raw')} select __kafka_partition, min(first_missing) as start, max(last_missing) + 1 as \"end\", sum(n_missing)::bigint as n_missing from gaps group by 1")
def gap_second_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.second_read(audit.gap_ranges(landed(spark, sf_dir), span=256))


@query(f"with {TOPIC_SQL}, {_SHORT}, {_GAPS.format('short')} select event_id, copy from raw r where exists (select 1 from gaps g where g.__kafka_partition = r.__kafka_partition and __kafka_offset between first_missing and last_missing)")
def gap_refill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a read that missed rows lacks between its least and largest offsets, from the whole topic."""
    whole = landed(spark, sf_dir)
    return audit.refill(whole, whole.where("event_id % 89 <> 0"), span=256).select("event_id", "copy")


@query(f"with {TOPIC_SQL} select __kafka_partition, count(*) as n_rows from raw group by 1")
def rows_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.rows_per_partition(landed(spark, sf_dir))


@query(f"with {TOPIC_SQL} select __kafka_partition, max(__kafka_offset) as last_offset from raw group by 1")
def last_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.last_offset(landed(spark, sf_dir))


@query(f"with {TOPIC_SQL} select __kafka_partition, max(__kafka_offset) - min(__kafka_offset) as gained, count(*) as n_rows from raw where __ingest_ts between timestamp '2024-01-30 12:00:00' - interval 240 minute and timestamp '2024-01-30 12:00:00' group by 1")
def ingest_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.ingest_rate(landed(spark, sf_dir), F.expr(AS_OF), 240)


@query(f"with {TOPIC_SQL} select max(__ingest_ts) as last_ingest, epoch_us(timestamp '2024-02-01 12:00:00' - max(__ingest_ts)) // 1000000 as lag_s, epoch_us(timestamp '2024-02-01 12:00:00' - max(__ingest_ts)) // 1000000 > 300 as alert from raw")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.freshness(landed(spark, sf_dir), F.expr(NOW))


@query(f"with {TOPIC_SQL} select case when event_id % 89 = 0 then 'only_left' else 'both' end as side, count(distinct event_id) as n from raw group by 1")
def group_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.reconcile(landed(spark, sf_dir), landed_twice(spark, sf_dir), K)


def landed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, second=True)


@query(f"with {TOPIC_SQL} select event_id, copy from raw where event_id % 89 = 0")
def group_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.missing(landed(spark, sf_dir), landed_twice(spark, sf_dir), K).select("event_id", "copy")


@query(f"with {TOPIC_SQL} select __kafka_partition, count(*) as n_rows from raw group by 1")
def gap_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = landed_twice(spark, sf_dir)
    return audit.rows_per_partition(short.unionByName(audit.missing(landed(spark, sf_dir), short, K)))


@query(f"with {TOPIC_SQL} select count(*) as n from (select user_id, event_id % 13 as s, lag(event_id % 13) over (partition by __kafka_partition, user_id order by __kafka_offset) as b from raw where copy = 0) where b > s")
def key_order_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = landed(spark, sf_dir).where("copy = 0").withColumn("s", F.col("event_id") % 13)
    return audit.out_of_order(t, "user_id", "s").agg(F.count("*").alias("n"))


_WIDE = {"text": 2, "lang": 3, "source": 5, "n_chars": 7}
_FILL_SQL = "select (" + " + ".join(f"(doc_id % {m} <> 0 and {c} is not null)::int" for c, m in _WIDE.items()) + ")::int as filled from documents"


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*[F.when(F.col("doc_id") % m != 0, F.col(c)).alias(c) for c, m in _WIDE.items()])


@query(f"select filled, count(*) as n_rows from ({_FILL_SQL}) group by 1")
def field_fill_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.filled(_wide(spark, sf_dir), list(_WIDE))


@query(f"select min(filled) as filled from (select filled, sum(count(*)) over (order by filled) as n, sum(count(*)) over () as a from ({_FILL_SQL}) group by 1) where n >= 0.95 * a")
def field_fill_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.filled_quantile(stats.filled(_wide(spark, sf_dir), list(_WIDE)), 0.95)


@query(f"""with f as (select lang, filled from (select lang, ({' + '.join(f"(doc_id % {m} <> 0 and {c} is not null)::int" for c, m in _WIDE.items())})::int as filled from documents)),
h as (select lang, filled, sum(count(*)) over (partition by lang order by filled) as n, sum(count(*)) over (partition by lang) as a from f group by 1, 2),
q as (select lang, max(a)::bigint as n_rows, min(filled) filter (n >= 0.5 * a) as p50, min(filled) filter (n >= 0.95 * a) as p95, min(filled) filter (n >= 0.99 * a) as p99 from h group by 1)
select lang, n_rows, p50::bigint as p50, p95::bigint as p95, p99::bigint as p99, (p95 + length(lang) + 2)::bigint as suggested from q""")
def capacity_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capacity hints of tables (the languages here, with keys of as many columns as their names have letters) from sketches by table and month."""
    t = table(spark, sf_dir, "documents").where("lang is not null").withColumn("month", F.col("doc_id") % 12)
    filled = t.select("lang", "month", *[F.when(F.col("doc_id") % m != 0, F.col(c)).alias(f"c{i}") for i, (c, m) in enumerate(_WIDE.items())])
    sketches = stats.fill_sketches(filled, [f"c{i}" for i in range(len(_WIDE))], ["lang", "month"], k=4096)
    options = t.select("lang", F.length("lang").alias("n_pk"), F.lit(2).alias("n_meta")).distinct()
    return stats.capacity(sketches, options, "lang")


@query(f"""with {TOPIC_SQL} select (year(__ingest_ts) * 100 + month(__ingest_ts))::int as ym, count(distinct event_id % 3) as parts, true as files_ok, true as bytes_ok, count(*) as n_rows from raw group by 1""")
def storage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts, files, bytes and rows of the months of a dataset that three jobs wrote to; SQL knows no files, so of these the query tells whether there are enough."""
    path = new_path(spark, "storage")
    for third in range(3):
        months.append(spark, landed(spark, sf_dir).where(F.col("event_id") % 3 == third), path, K)
    t = months.report(spark, path)
    return t.select("ym", "parts", (F.col("files") >= F.col("parts")).alias("files_ok"), (F.col("bytes") >= F.col("n_rows")).alias("bytes_ok"), "n_rows")


@query("select event_id, ts, user_id, event_type, value, props from events where false")
def probe_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.lit(False))


# Schemas


@query(f"""with {CATALOG_SQL} select coalesce(o."table", n."table") as "table", coalesce(o.pos, n.pos) as pos, o.name as old_name, o.record_type as old_record_type, n.name as new_name, n.record_type as new_record_type
from old_c o full join new_c n on o."table" = n."table" and o.pos = n.pos where o.name is distinct from n.name or o.record_type is distinct from n.record_type""")
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.diff(*catalogs(spark, sf_dir))


_PRINT = "select \"table\", md5(string_agg(name || ':' || record_type, ',' order by pos)) as f from {0} group by 1"


@query(f"with {CATALOG_SQL}, a as ({_PRINT.format('old_c')}), b as ({_PRINT.format('new_c')}) select coalesce(a.\"table\", b.\"table\") as \"table\", a.f as before, b.f as after from a full join b on a.\"table\" = b.\"table\" where a.f is distinct from b.f")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.drift(*catalogs(spark, sf_dir))


@query(f"""with {CATALOG_SQL} select "table", unnest(case when name <> 'view' then [name, 'b'] else ['0'] end) as family from old_c where pos = 0""")
def catalog_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families by table; tables that list none have the default."""
    old, _ = catalogs(spark, sf_dir)
    listed = F.when(F.col("name") != "view", F.array("name", F.lit("b"))).otherwise(F.expr("cast(array() as array<string>)"))
    return catalog.families_of(old.where("pos = 0").select("table", listed.alias("families")))


@query(f"""with {CATALOG_SQL}, t as (select coalesce(o."table", n."table") as "table", lower(coalesce(o.name || '_' || o.pos, n.name || '_' || n.pos)) as name, o.record_type,
case n.record_type when 'long' then if(n.pos % 3 = 0, '"integer"', '"long"') when 'double' then if(n.pos % 4 = 0, '"float"', '"double"') when 'bytes' then '"binary"' when 'string' then '"string"' end as target
from old_c o full join new_c n on o."table" = n."table" and o.name || '_' || o.pos = n.name || '_' || n.pos)
select *, case when target is null then 'missing' when record_type is null then 'extra' when record_type || target in ('long"long"', 'double"double"', 'string"string"') then 'there' else 'mismatch' end as status from t""")
def schema_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog's fields against the columns of targets that were made from a later version of it, some of them too narrow."""
    old, new = (t.withColumn("name", F.concat("name", F.lit("_"), F.col("pos").cast("string"))) for t in catalogs(spark, sf_dir))
    kind, pos = F.col("record_type"), F.col("pos")
    target = F.when(kind == "long", F.when(pos % 3 == 0, "integer").otherwise("long")).when(kind == "double", F.when(pos % 4 == 0, "float").otherwise("double")).when(kind == "bytes", "binary").otherwise(kind)
    return schemas.coverages(old, new.select("table", "name", F.concat(F.lit('"'), target, F.lit('"')).alias("target")))


@query(f"""with {CATALOG_SQL} select "table", greatest(0, least(8, try_cast(min(case when pos = 0 then name = 'view' end)::int * 20 - 5 as int))) as salt, count(*) as n from old_c group by 1""")
def table_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, _ = catalogs(spark, sf_dir)
    given = F.min(F.when(F.col("pos") == 0, (F.col("name") == "view").cast("int"))) * 20 - 5
    return old.groupBy("table").agg(catalog.clamped_salt(given).alias("salt"), F.count("*").alias("n"))


# Streams: each gives the rows of its batch form


def _files(spark: SparkSession) -> int:
    """Files of a micro-batch: as many as there are cores to write and read them."""
    return max(1, spark.sparkContext.defaultParallelism)


def _written_log(spark: SparkSession, sf_dir: str, batches: int = 3) -> str:
    path = new_path(spark, "log")
    entries(spark, sf_dir).repartition(batches * _files(spark), "wal_seq").write.parquet(path)
    return path


def _run(spark: SparkSession, start: Callable[[str, str], object], path: str, checkpoint: str) -> None:
    q = start(path, checkpoint)
    q.awaitTermination()


@query(f"""with {CELLS_SQL} select wal_seq, run_idx, "user", event_type, value, _event_ts, _delete from rows where sent""")
def stream_change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, out = _written_log(spark, sf_dir), new_path(spark, "events")
    _run(spark, lambda p, c: jobs.change_events(jobs.change_log(spark, log, _files(spark)), SPEC, p, c), out, f"{out}-checkpoint")
    return spark.read.parquet(out).select("wal_seq", "run_idx", "user", "event_type", "value", "_event_ts", "_delete")


@query(f"""with {CELLS_SQL} select wal_seq, run_idx, "user", value from rows where sent""")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the log, a stop, the other half on the same checkpoint; a micro-batch each, however many files they are."""
    log, out = new_path(spark, "log"), new_path(spark, "events")
    whole = entries(spark, sf_dir)
    for half in (0, 1):
        whole.where(F.col("wal_seq") % 2 == half).write.mode("append").parquet(log)
        _run(spark, lambda p, c: jobs.change_events(jobs.change_log(spark, log, None), SPEC, p, c), out, f"{out}-checkpoint")
    return spark.read.parquet(out).select("wal_seq", "run_idx", "user", "value")


def _written_topic(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "topic")
    topic_rows(spark, sf_dir).repartition(3, "event_id").write.parquet(path)
    return path


_TOPIC_ROW = "event_id bigint, user_id bigint, event_type string, value double, ts timestamp_ntz, copy int, partition int, offset bigint, timestamp timestamp_ntz"


def _to_raw(t: DataFrame) -> DataFrame:
    fields: dict[str, Column] = {c: F.col(c) for c in ("event_id", "event_type", "copy")} | {"dt": F.col("ts")}
    return landing.to_raw(t, fields, F.expr(NOW))


@query(f"with {TOPIC_SQL} select event_id, copy, __kafka_partition, __kafka_offset, __kafka_ts, 202402 as ym from raw")
def stream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, path = new_path(spark, "raw"), _written_topic(spark, sf_dir)
    _run(spark, lambda p, c: jobs.raw(topics.read(spark, path, streaming=True, schema=_TOPIC_ROW), _to_raw, p, c, K), out, f"{out}-checkpoint")
    return months.read(spark, out).select("event_id", "copy", *K, "__kafka_ts", "ym")


@query(f"with {TOPIC_SQL} select __kafka_partition, __kafka_offset, any_value(event_id) as event_id, max(copy)::int as copy from raw group by 1, 2")
def stream_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, path = new_path(spark, "serving"), _written_topic(spark, sf_dir)
    convert = lambda t: landing.to_serving(_to_raw(t), "dt", F.col("copy"))
    _run(spark, lambda p, c: jobs.serving(topics.read(spark, path, streaming=True, schema=_TOPIC_ROW), convert, p, c, K, "ver"), out, f"{out}-checkpoint")
    return months.read(spark, out).select(*K, "event_id", "copy")


@query(f"""with {TOPIC_SQL}, late as (select event_id, copy, dt, __ingest_ts, __kafka_partition, __kafka_offset from raw where __ingest_ts >= timestamp '2024-01-30 12:00:00' - interval 10 day or event_id % 3 = 0)
select __kafka_partition, (year(__ingest_ts) * 100 + month(__ingest_ts))::int as ym, count(*) as n_rows, count(distinct __kafka_offset) as n_offsets, sum(event_id)::bigint as ids from late group by all""")
def stream_retire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds of a topic streamed to the raw dataset, retention across a month's boundary, the rest streamed on the same checkpoint, audited by partition and month."""
    topic, out = new_path(spark, "topic"), new_path(spark, "raw")
    rows = topic_rows(spark, sf_dir)

    def convert(t: DataFrame) -> DataFrame:
        raw = _to_raw(t).withColumn("__ingest_ts", F.col("dt") + F.expr("interval 2 minutes"))
        return raw.withColumn("ym", times.month(F.col("__ingest_ts")))

    for rest in (False, True):
        rows.where((F.col("event_id") % 3 == 0) == rest).repartition(2, "event_id").write.mode("append").parquet(topic)
        _run(spark, lambda p, c: jobs.raw(topics.read(spark, topic, streaming=True, schema=_TOPIC_ROW), convert, p, c, K), out, f"{out}-checkpoint")
        if not rest:
            months.retire(spark, out, 10, datetime.datetime(2024, 1, 30, 12), ["__ingest_ts"], K)
    t = months.read(spark, out)
    return t.groupBy("__kafka_partition", "ym").agg(F.count("*").alias("n_rows"), F.count_distinct("__kafka_offset").alias("n_offsets"), F.sum("event_id").alias("ids"))


@query(f"with {TOPIC_SQL} select event_id % 4 as file, 1::bigint as batches, count(*) as n_rows from topic group by 1")
def stream_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Back-pressure: a topic of four files, of which a micro-batch takes one; batches that each file's rows came in."""
    topic, out = new_path(spark, "topic"), new_path(spark, "raw")
    for k in range(4):
        topic_rows(spark, sf_dir).where(F.col("event_id") % 4 == k).coalesce(1).write.mode("append").parquet(topic)
    _run(spark, lambda p, c: jobs.raw(topics.read(spark, topic, streaming=True, schema=_TOPIC_ROW, block=1), _to_raw, p, c, K), out, f"{out}-checkpoint")
    return months.parts(spark, out).groupBy((F.col("event_id") % 4).alias("file")).agg(F.count_distinct("part").alias("batches"), F.count("*").alias("n_rows"))


@query(f"with {TOPIC_SQL} select __kafka_partition, __kafka_offset, any_value(event_id) as event_id from raw where copy = 0 group by 1, 2")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic with repeated offsets, streamed in two runs of one checkpoint; half of the first run's rows are replayed in the second."""
    topic, out = new_path(spark, "topic"), new_path(spark, "once")
    rows = topic_rows(spark, sf_dir)
    for half in (0, 1):
        again = (F.col("event_id") % 2 == half) | (F.col("event_id") % 4 == 0) & F.lit(half == 1)
        rows.where(again).repartition(2, "event_id").write.mode("append").parquet(topic)

        def start(p: str, c: str) -> object:
            t = _to_raw(topics.read(spark, topic, streaming=True, schema=_TOPIC_ROW))
            return jobs.deduplicated(t.withColumn("__kafka_ts", F.col("__kafka_ts").cast("timestamp")), p, c, delay="90 days")

        _run(spark, start, out, f"{out}-checkpoint")
    return spark.read.parquet(out).select(*K, "event_id")


@query(f"""with {CELLS_SQL} select count(distinct wal_seq) as entries, count(*) as n_rows, sum(n_cells)::bigint as cells, count(*) filter (not sent) as filtered from rows""")
def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of a stream, observed while it runs in three micro-batches and, later, one more."""
    log, out = new_path(spark, "log"), new_path(spark, "events")
    seen = stats.RunTotals("totals")
    spark.streams.addListener(seen)
    try:
        for half in (0, 1):
            entries(spark, sf_dir).where(F.col("wal_seq") % 2 == half).repartition((3 - 2 * half) * _files(spark), "wal_seq").write.mode("append").parquet(log)
            _run(spark, lambda p, c: jobs.change_events(jobs.change_log(spark, log, _files(spark)), SPEC, p, c, totals=seen.name), out, f"{out}-checkpoint")
            seen.ended.wait(60)
    finally:
        spark.streams.removeListener(seen)
    t = seen.totals
    return spark.createDataFrame([(t["entries"], t["rows"], t["cells"], t["filtered"])], "entries bigint, n_rows bigint, cells bigint, filtered bigint")


@query("""with f as (select event_type as subject, (user_id % 12)::int as part, event_id as seq, case when event_id % 31 <> 0 then 'v' || (event_id // 97 % 3) end as fingerprint from events),
b as (select *, lag(fingerprint) over (partition by subject, part order by seq) as before from f where fingerprint is not null)
select subject, part, seq, before, fingerprint as after from b where before <> fingerprint""")
def stream_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the schemas of a stream of frames, in two runs of one checkpoint; the second has some frames of the first again."""
    topic, out = new_path(spark, "frames"), new_path(spark, "drift")
    e = _events(spark, sf_dir)
    fingerprint = F.when(F.col("k") % 31 != 0, F.concat(F.lit("v"), (F.floor(F.col("k") / 97) % 3).cast("string")))
    frames = e.select(F.col("event_type").alias("subject"), (F.col("user_id") % 12).cast("int").alias("part"), F.col("k").alias("seq"), fingerprint.alias("fingerprint"))
    middle = e.agg((F.min("k") + F.max("k")) / 2).first()[0]
    schema = "subject string, part int, seq bigint, fingerprint string"
    for run in (F.col("seq") <= middle, (F.col("seq") > middle) | (F.col("seq") % 5 == 0)):
        frames.where(run).repartition(2, "subject", "part").write.mode("append").parquet(topic)
        _run(spark, lambda p, c: jobs.schema_drift(spark.readStream.schema(schema).parquet(topic), p, c), out, f"{out}-checkpoint")
    return spark.read.parquet(out)


@query(f"""with {CELLS_SQL}, e as (select wal_seq, wal_write_time, count(*) as r, sum(n_cells) as n, count(*) filter (not sent) as f from rows join written using (wal_seq) group by all),
w as (select *, time_bucket(interval 1 hour, make_timestamp(wal_write_time * 1000)) as s from e)
select s as window_start, count(*) as entries, sum(r)::bigint as n_rows, sum(n)::bigint as cells, sum(f)::bigint as filtered from w where s + interval 1 hour <= (select max(make_timestamp(wal_write_time * 1000)) - interval 1 minute from e) group by 1""")
def stream_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, log = new_path(spark, "windows"), new_path(spark, "log")
    entries(spark, sf_dir).repartitionByRange(3 * _files(spark), "wal_seq").write.parquet(log)
    _run(spark, lambda p, c: jobs.throughput(jobs.change_log(spark, log, files=max(100, 3 * _files(spark))), p, c, 3600, families=FAMILIES), out, f"{out}-checkpoint")
    t = spark.read.parquet(out)
    # the stream's windows are instants; without a zone they compare with SQL's
    at = times.from_millis(F.unix_millis("window_start"))
    return t.select(at.alias("window_start"), "entries", "n_rows", "cells", "filtered")
