"""Queries over change logs and row keys, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import coerce, decode, encode, names, rowkey, times
from ..operators import cells, order, stats
from ..spec import TableSpec
from .fixtures import CELLS_SQL, FAMILIES, SPEC, entries, keys, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _text(c: str):
    return F.decode(c, "UTF-8")


@query(f"with {CELLS_SQL} select wal_seq, count(*)::int as n_cells from cells where wal_seq % 50 <> 0 group by wal_seq")
def change_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(spark, sf_dir, 50).where(F.size("cells") > 0).select("wal_seq", F.size("cells").alias("n_cells"))


@query(f"with {CELLS_SQL} select wal_seq, cell_idx::int as cell_idx, row, family, qualifier, ts, is_delete from cells")
def cells_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.flat(entries(spark, sf_dir)).select("wal_seq", "cell_idx", _text("row").alias("row"), "family", "qualifier", "ts", "is_delete")


@query(f"with {CELLS_SQL} select wal_seq, run_idx, \"user\" as row, n_cells::int as n_cells from rows")
def row_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.runs(entries(spark, sf_dir)).select("wal_seq", "run_idx", _text("row").alias("row"), F.size("run").alias("n_cells"))


@query(f"with {CELLS_SQL} select wal_seq, run_idx, count(*) as n_cells, min(cell_idx)::int as first_cell from runs group by all")
def row_runs_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.runs_of_flat(cells.flat(entries(spark, sf_dir))).groupBy("wal_seq", F.col("run_idx").cast("bigint").alias("run_idx")).agg(F.count("*").alias("n_cells"), F.min("cell_idx").alias("first_cell"))


@query(f"with {CELLS_SQL} select wal_seq, run_idx, \"user\", event_type, value from rows")
def row_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = TableSpec(SPEC.name, SPEC.fields, SPEC.pk)
    return cells.row_events(entries(spark, sf_dir), every).select("wal_seq", "run_idx", "user", "event_type", "value")


@query(f"with {CELLS_SQL} select wal_seq, run_idx, _event_ts from rows")
def row_event_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.runs(entries(spark, sf_dir)).select("wal_seq", "run_idx", cells.event_time("run").alias("_event_ts"))


@query(f"with {CELLS_SQL} select wal_seq, run_idx, _delete from rows")
def row_delete_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.runs(entries(spark, sf_dir)).select("wal_seq", "run_idx", cells.is_deleted("run").alias("_delete"))


@query(f"with {CELLS_SQL} select r.wal_seq, run_idx, r.wal_seq as _wal_seq, case when r.wal_seq % 9 = 0 then -1 else wal_write_time end as _wal_write_time from rows r join written using (wal_seq)")
def wal_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = entries(spark, sf_dir).withColumn("wal_write_time", F.when(F.col("wal_seq") % 9 != 0, F.col("wal_write_time")))
    return cells.row_events(e, TableSpec(SPEC.name, SPEC.fields, SPEC.pk)).select("wal_seq", "run_idx", "_wal_seq", "_wal_write_time")


@query(f"with {CELLS_SQL} select wal_seq, run_idx, n_cells::int as n_cells from (select wal_seq, run_idx, count(*) as n_cells from runs group by all having bool_or(family = 'x'))")
def cf_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = cells.runs(entries(spark, sf_dir)).where(cells.in_families("run", ["x"]))
    return t.select("wal_seq", F.col("run_idx").cast("bigint").alias("run_idx"), F.size("run").alias("n_cells"))


@query(f"with {CELLS_SQL} select wal_seq, run_idx, event_type from rows where _delete")
def delete_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = cells.runs(entries(spark, sf_dir)).where(cells.is_deleted("run"))
    return t.select("wal_seq", "run_idx", F.decode(cells.last_value("run", "event_type"), "UTF-8").alias("event_type"))


@query(f"with {CELLS_SQL} select wal_seq, run_idx, \"user\", event_type from rows where sent")
def skip_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TableSpec.builder(SPEC.name).column("user").column("event_type").column("value", "long", "BIGINT", skip=True).key("user").only(*FAMILIES).build()
    t = cells.row_events(entries(spark, sf_dir), spec)
    return t.select(*[c for c in t.columns if c != "_error"])


@query(f"""with {CELLS_SQL} select r.wal_seq, run_idx, "user", event_type, value, _event_ts, _delete, r.wal_seq as _wal_seq, wal_write_time as _wal_write_time
from rows r join written using (wal_seq) where sent""")
def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: entries to typed row events, no shuffle after the log is read."""
    good, _ = cells.split_errors(cells.row_events(entries(spark, sf_dir), SPEC))
    return good


_N = "case when l_linenumber = 3 then l_orderkey || 'x' else l_orderkey::varchar end"
_OK = "['1', 'TRUE', ' false ', 'maybe'][l_orderkey % 4 + 1]"
_RAW = "lpad(to_hex(l_linenumber::int), 8, '0')"


@query(f"""select l_orderkey * 8 + l_linenumber as wal_seq, case when l_linenumber <> 3 then l_orderkey end as n, case l_orderkey % 4 when 0 then true when 1 then true when 2 then false end as ok,
case when l_returnflag <> 'R' then l_returnflag end as flag, case when l_linenumber = 5 then '8000000501' else lower({_RAW}) end as raw,
case when l_linenumber = 3 then 'ns:lines.n: not a long: ' || {_N} when l_orderkey % 4 = 3 then 'ns:lines.ok: not a boolean: maybe' when l_returnflag = 'R' then 'ns:lines.flag: not a symbol: R' end as error from lineitem""")
def coerced_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row events whose values come to the kinds of their fields: a long, a boolean and an enum from text, bytes from what decodes and what doesn't."""
    spec = TableSpec.builder("ns:lines").column("id").column("n", "long").column("ok", "boolean").column("flag", ("enum", "A", "N")).column("raw", "bytes", "INTEGER").key("id").build()
    t = table(spark, sf_dir, "lineitem")
    text = lambda c: F.encode(c, "UTF-8")
    n = F.when(F.col("l_linenumber") == 3, F.concat(F.col("l_orderkey").cast("string"), F.lit("x"))).otherwise(F.col("l_orderkey").cast("string"))
    ok = F.element_at(F.array(*map(F.lit, ("1", "TRUE", " false ", "maybe"))), (F.col("l_orderkey") % 4 + 1).cast("int"))
    raw = encode.integer(F.col("l_linenumber").cast("bigint"), 4)
    values = {"n": text(n), "ok": text(ok), "flag": text(F.col("l_returnflag")), "raw": F.when(F.col("l_linenumber") == 5, F.concat(raw, F.lit(b"\x01"))).otherwise(raw)}
    cell = lambda q, v: F.struct(text(F.lit("k")).alias("row"), F.lit("d").alias("family"), F.lit(q).alias("qualifier"), F.lit(1).cast("bigint").alias("ts"), F.lit(False).alias("is_delete"), v.alias("value"))
    e = t.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("wal_seq"), F.lit(0).cast("bigint").alias("wal_write_time"), F.lit("ns:lines").alias("table"), "l_orderkey", "l_linenumber", "l_returnflag")
    e = cells.evaluated(e, cells=F.array(*[cell(q, v) for q, v in values.items()]))
    return cells.row_events(e, spec).select("wal_seq", "n", "ok", "flag", F.lower(F.hex("raw")).alias("raw"), F.col("_error").alias("error"))


@query("""select l_orderkey * 8 + l_linenumber as wal_seq, case when l_linenumber = 1 then null when l_linenumber % 2 = 0 then 'long' else 'string' end as branch, case when l_linenumber <> 1 and l_linenumber % 2 = 0 then l_orderkey end as n,
case when l_linenumber <> 1 and l_linenumber % 2 = 1 then l_orderkey || 'x' end as s, case when l_linenumber <> 3 then 'a=' || l_linenumber || ',b=' || l_orderkey end as counts, case when l_linenumber <> 4 then l_orderkey end as pair_x, case when l_linenumber <> 4 then 'none' end as pair_y,
case when l_linenumber = 3 then 'ns:shapes.counts.b: not a long' when l_linenumber = 5 then 'ns:shapes.note: not a record, but string' end as error from lineitem""")
def union_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row events with a union of two kinds, a map, a record with a default, by decoders of one's own, and a record field whose values are text."""
    for name, kind in (("JSON COUNTS", "map<string, string>"), ("JSON PAIR", "struct<x: string>")):
        decode.register(name, lambda v, kind=kind: F.from_json(v.cast("string"), kind), spark_type=kind)
    spec = TableSpec.builder("ns:shapes").column("id").column("u", ("union", "null", "long", "string")).column("counts", ("union", "null", ("map", "long")), "JSON COUNTS")
    spec = spec.column("pair", {"x": "long", "y": coerce.Default("string", "none")}, "JSON PAIR").column("note", ("union", "null", {"flag": "boolean"})).key("id").build()
    o, n = F.col("l_orderkey").cast("string"), F.col("l_linenumber")
    bytes_of = lambda *parts: F.encode(F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts]), "UTF-8")
    values = {
        "u": F.when(n == 1, F.lit(b"")).when(n % 2 == 0, bytes_of(o)).otherwise(bytes_of(o, "x")), "counts": F.when(n == 3, bytes_of('{"b": "x", "a": "1"}')).otherwise(bytes_of('{"b": ', o, ', "a": ', n.cast("string"), "}")),
        "pair": F.when(n == 4, F.lit(b"")).otherwise(bytes_of('{"x": ', o, "}")), "note": F.when(n == 5, bytes_of("text")),
    }
    cell = lambda q, v: F.struct(F.lit(b"k").alias("row"), F.lit("d").alias("family"), F.lit(q).alias("qualifier"), F.lit(1).cast("bigint").alias("ts"), F.lit(False).alias("is_delete"), v.alias("value"))
    e = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + n).alias("wal_seq"), F.lit(0).cast("bigint").alias("wal_write_time"), F.lit("ns:shapes").alias("table"), "l_orderkey", "l_linenumber")
    e = cells.evaluated(e, cells=F.array(*[cell(q, v) for q, v in values.items()]))
    t = cells.row_events(e, spec)
    ok = F.when(F.forall(F.map_values("counts"), lambda x: x.isNotNull()), F.array_join(F.transform(F.map_entries("counts"), lambda x: F.concat_ws("=", x["key"], x["value"].cast("string"))), ","))
    return t.select("wal_seq", F.col("u.branch").alias("branch"), F.col("u.long").alias("n"), F.col("u.string").alias("s"), ok.alias("counts"), F.col("pair.x").alias("pair_x"), F.col("pair.y").alias("pair_y"), F.col("_error").alias("error"))


@query(f"""with {CELLS_SQL} select wal_seq, count(*) as rows_seen, count(*) filter (sent) as rows_sent, count(*) filter (not sent) as rows_filtered,
sum(n_cells)::bigint as cells_seen, coalesce(max(n_cells) filter (sent), 0)::int as max_cells_sent from rows group by wal_seq""")
def entry_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.entry_summary(entries(spark, sf_dir), FAMILIES)


@query(f"""with {CELLS_SQL} select count(distinct wal_seq) as entries, count(*) as rows, sum(n_cells)::bigint as cells, count(*) filter (not sent) as filtered, max(n)::bigint as most_rows
from (select *, count(*) over (partition by wal_seq) as n from rows)""")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.run_totals(stats.entry_summary(entries(spark, sf_dir), FAMILIES), most_rows=F.max("rows_seen"))


@query(f"""with {CELLS_SQL}, s as (select wal_seq, count(*) as n, sum(n_cells) as c, count(*) filter (not sent) as f from rows group by wal_seq)
select time_bucket(interval 5 second, make_timestamp(wal_write_time * 1000)) as window_start, count(*) as entries, sum(n)::bigint as n_rows, sum(n) / 5 as rows_per_s,
  sum(c)::bigint as cells, sum(c) / 5 as cells_per_s, sum(f)::bigint as filtered from s join written using (wal_seq) group by 1""")
def throughput_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = entries(spark, sf_dir)
    return stats.throughput(stats.entry_summary(e, FAMILIES, times.from_millis(F.col("wal_write_time")).alias("at")), "at")


@query(f"""with {CELLS_SQL} select 'ns:events' as "table", count(*) filter (length("user") <= 1) as short_keys, (max(n_cells) filter (sent))::int as widest, count(*) as n_rows, count(*) filter (not sent) as filtered,
count(*) filter (length("user") <= 1) > 0 as flag_short_keys, max(n_cells) filter (sent) > 8 as flag_hint, count(*) >= 500 and count(*) filter (not sent) / count(*) < 0.01 as flag_filter_idle,
count(*) >= 500 and count(*) filter (not sent) / count(*) >= 0.95 as flag_filter_tight from rows""")
def table_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = entries(spark, sf_dir)
    options = e.select("table").distinct().withColumns({"salt": F.lit(1), "hint": F.lit(SPEC.hint)})
    return stats.diagnostics(e, options, FAMILIES)


@query(f"""with {CELLS_SQL} select case when n_cells <= 32 then '0-32' when n_cells < 4096 then '33-4095' else '4096+' end as width, count(*) as n_rows, sum(n_cells)::bigint as cells from rows group by 1""")
def row_width_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.widths(entries(spark, sf_dir))


@query(f"with {CELLS_SQL} select upper(trim(qualifier)) as name, count(*) as n from cells group by 1")
def qualifier_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.flat(entries(spark, sf_dir)).groupBy(names.column_name(F.col("qualifier")).alias("name")).agg(F.count("*").alias("n"))


# Row keys


_PARTS = [("event_type", "VARCHAR"), ("event_id", "BIGINT")]


def _split(t: DataFrame, key=None, salt: int = 1, parts=None) -> DataFrame:
    out = rowkey.split(F.col("key") if key is None else key, parts or _PARTS, salt)
    return t.select(*[c.alias(n) for n, c in out.items()])


@query("select event_type, event_id from events")
def rowkey_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(keys(spark, sf_dir), F.substring("key", 2, 1 << 20), 0)


@query("select event_type, event_id from events")
def rowkey_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(keys(spark, sf_dir))


@query("select event_id, case when event_id % 11 = 0 then lower(hex(encode(event_type))) || '00ff00' || lower(hex(encode(event_type))) else lower(hex(encode(event_type))) end as part from events")
def rowkey_escaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(keys(spark, sf_dir, True), parts=[("part", "VARBINARY"), ("event_id", "BIGINT")]).select("event_id", F.lower(F.hex("part")).alias("part"))


@query("select event_id, event_type as got_type, case when event_id % 97 <> 0 then event_id end as got_id from events")
def rowkey_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = keys(spark, sf_dir)
    short = F.when(F.col("event_id") % 97 == 0, F.substring(F.col("key"), F.lit(1), F.octet_length("key") - 3)).otherwise(F.col("key"))
    got = rowkey.split(short, _PARTS, 1)
    return t.select("event_id", got["event_type"].alias("got_type"), got["event_id"].alias("got_id"))


@query("select event_id, case when length(event_type) + 10 > 16 then lower(left(hex(k), 32)) || '..' else lower(hex(k)) end as preview from (select event_id, event_type, unhex(lpad((event_id % 8)::varchar, 2, '0')) || encode(event_type) || unhex('00') || unhex('80' || lpad(hex(event_id), 14, '0')) as k from events)")
def key_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys(spark, sf_dir).select("event_id", rowkey.preview(F.col("key")).alias("preview"))


@query("""select event_id, row_number() over (order by k) as place from (select event_id, event_type, lpad((event_id % 8)::varchar, 2, '0') || hex(encode(event_type)) || '00' || '80' || lpad(hex(event_id), 14, '0') as k from events)""")
def key_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all row keys in their byte order."""
    return order.places(keys(spark, sf_dir).select("event_id", "key"), ["key"]).select("event_id", "place")


@query("select case when event_id % 97 = 0 then 'ns:events.event_id: not in the row key' end as error, count(*) as n from events group by 1")
def pk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TableSpec.builder("ns:events").column("event_type").column("event_id", "long", "BIGINT").column("note").key("event_type", "event_id").salted(1).build()
    t = keys(spark, sf_dir)
    short = F.when(F.col("event_id") % 97 == 0, F.substring(F.col("key"), F.lit(1), F.octet_length("key") - 3)).otherwise(F.col("key"))
    cell = F.struct(short.alias("row"), F.lit("d").alias("family"), F.lit("note").alias("qualifier"), F.lit(1).cast("bigint").alias("ts"), F.lit(False).alias("is_delete"), F.encode(F.lit("n"), "UTF-8").alias("value"))
    e = cells.evaluated(t.withColumns({"wal_seq": F.col("event_id"), "wal_write_time": F.lit(0).cast("bigint"), "table": F.lit("ns:events")}), cells=F.array(cell))
    return cells.row_events(e, spec).groupBy(F.col("_error").alias("error")).agg(F.count("*").alias("n"))


# Values


def _round_trip(t: DataFrame, columns: dict[str, tuple[str, object, str]]) -> DataFrame:
    """Encodes columns, name -> (source type, bytes), and decodes them again."""
    raw = t.select("k", *[c.alias(n) for n, (_, c, _) in columns.items()])
    return raw.select("k", *[decode.decoded(F.col(n), kind).cast(as_).alias(n) for n, (kind, _, as_) in columns.items()])


def _wrapped(x: str, bits: int) -> str:
    """A whole number in SQL as a signed integer of so many bits holds it."""
    m, top = 1 << bits, 1 << (bits - 1)
    return f"((({x} + {top}) % {m} + {m}) % {m} - {top})"


@query(f"""select l_orderkey * 8 + l_linenumber as k, (l_partkey % 256 - 128)::int as a, {_wrapped('l_partkey - 3000', 16)}::int as b, {_wrapped('-l_orderkey', 32)}::int as c, l_orderkey * 4000000007 as d,
(l_partkey % 256)::int as ua, (l_partkey % 65536)::int as ub, l_orderkey * 500 % 4294967296 as uc, l_orderkey as ud from lineitem""")
def decode_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integers of all sizes; keys that have outgrown a size come back as its low bytes hold them."""
    p, o = F.col("l_partkey"), F.col("l_orderkey")
    t = table(spark, sf_dir, "lineitem").withColumn("k", o * 8 + F.col("l_linenumber"))
    i = encode.integer
    return _round_trip(t, {
        "a": ("TINYINT", i(p % 256 - 128, 1), "int"), "b": ("SMALLINT", i(p - 3000, 2), "int"), "c": ("INTEGER", i(-o, 4), "int"), "d": ("BIGINT", i(o * 4_000_000_007, 8), "bigint"),
        "ua": ("UNSIGNED TINYINT", i(p % 256, 1, False), "int"), "ub": ("UNSIGNED SMALLINT", i(p % 65536, 2, False), "int"), "uc": ("UNSIGNED INT", i(o * 500, 4, False), "bigint"), "ud": ("UNSIGNED LONG", i(o, 8, False), "bigint"),
    })


@query("select doc_id as k, nullif(text, '') as text, nullif(lang, '') as lang, n_chars % 2 = 0 as flag from documents")
def decode_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "documents").withColumn("k", F.col("doc_id"))
    bit = F.when(F.col("n_chars") % 2 == 0, F.lit(b"\x01")).otherwise(F.lit(b"\x00"))
    return _round_trip(t, {"text": ("VARCHAR", F.encode("text", "UTF-8"), "string"), "lang": ("CHAR", F.encode(F.rpad("lang", 6, " "), "UTF-8"), "string"), "flag": ("BOOLEAN", bit, "boolean")})


@query("select event_id as k, epoch_us(ts) // 1000 as at, epoch_us(ts) // 86400000000 * 86400000 as day from events")
def decode_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = times.to_millis(F.col("ts"))
    t = table(spark, sf_dir, "events").withColumn("k", F.col("event_id"))
    return _round_trip(t, {"at": ("TIMESTAMP", encode.timestamp(ms), "bigint"), "day": ("DATE", encode.integer(F.floor(ms / 86_400_000) * 86_400_000, 8), "bigint")})


@query("select l_orderkey * 8 + l_linenumber as k, l_extendedprice - 40000 as x, (l_quantity - 25)::float::double as y from lineitem")
def decode_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem").withColumn("k", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return _round_trip(t, {"x": ("DOUBLE", encode.real(F.col("l_extendedprice") - 40000, 8), "double"), "y": ("FLOAT", encode.real((F.col("l_quantity") - 25).cast("float"), 4), "double")})


@query("select l_orderkey * 8 + l_linenumber as k, floor(l_extendedprice * 100)::bigint - 4000000 as cents from lineitem")
def decode_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem").withColumn("k", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    found = _round_trip(t, {"x": ("DECIMAL", encode.decimal(F.floor(F.col("l_extendedprice") * 100) - 4_000_000), "decimal(38,10)")})
    return found.select("k", (F.col("x") * 100).cast("bigint").alias("cents"))


@query("select event_id as k, event_type || ',' || user_id::varchar || ',' || event_id::varchar as items from events")
def decode_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "events").withColumn("k", F.col("event_id"))
    found = _round_trip(t, {"items": ("VARCHAR ARRAY", encode.texts(F.array("event_type", F.col("user_id").cast("string"), F.col("event_id").cast("string"))), "array<string>")})
    return found.select("k", F.array_join("items", ",").alias("items"))


@query("select event_id as k, case when event_id % 4 = 0 then -1 else user_id end as v from events")
def decode_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.when(F.col("event_id") % 4 != 0, encode.integer(F.col("user_id"), 8)).when(F.col("event_id") % 8 == 0, F.lit(b"\x01"))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("k"), decode.decoded(v, "BIGINT", -1).alias("v"))


@query("""select event_id as k, case when event_id % 5 = 1 then lower(printf('%08x', user_id)) when event_id % 5 <> 0 then lower(hex(encode(event_type || '--'))) end as v from events""")
def raw_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.when(F.col("event_id") % 5 == 0, F.lit(b"")).when(F.col("event_id") % 5 == 1, encode.integer(F.col("user_id"), 4)).otherwise(F.encode(F.concat("event_type", F.lit("--")), "UTF-8"))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("k"), F.lower(F.hex(decode.or_raw(v, "INTEGER"))).alias("v"))


@query("select case when event_id % 6 = 0 then 'ns:events.value: BIGINT has 8 bytes, got 4' end as error, count(*) as n from events group by 1")
def width_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.when(F.col("event_id") % 6 == 0, encode.integer(F.col("user_id"), 4)).otherwise(encode.integer(F.col("user_id"), 8))
    return table(spark, sf_dir, "events").groupBy(decode.misfit(v, "BIGINT", "ns:events.value").alias("error")).agg(F.count("*").alias("n"))
