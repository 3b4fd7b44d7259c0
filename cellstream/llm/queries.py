"""The registered queries of this folder and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann_graph, collocations, langid, line_templates, mixing, packing, periodic_runs, secret_scan, setsketch, token_count, vector_neardup, warc, weak_quality
from ..scratch import delete, new_path
from .common import stored, table


#: Labelled documents that the domain classifier is fitted on at most, those of the smallest hashes of doc_id.
LABELLED = 8_000


def labelled_languages(spark: SparkSession, sf_dir: str, most: int = LABELLED) -> DataFrame:
    """Documents that are in `labels`, at most so many, with their language as domain. The ids, being so few, are broadcast, so no text is shuffled."""
    ids = table(spark, sf_dir, "labels").select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id")).limit(most)
    return table(spark, sf_dir, "documents").join(F.broadcast(ids), "doc_id", "left_semi").select("text", F.col("lang").alias("domain"))


def flattened(labelled: DataFrame, power: float = 0.5) -> dict[str, float]:
    """Target weights for the domains of labelled rows: their shares of the rows, raised to a power, so that small ones gain."""
    rows = labelled.where("text is not null and domain is not null").groupBy("domain").count().limit(mixing.DOMAINS + 1).collect()
    return {str(r["domain"]): r["count"] ** power for r in rows}


#: Labelled documents that words of toxic texts are learned from at most, likewise.
LABELLED_TOXIC = 5_000


def labelled_toxic(spark: SparkSession, sf_dir: str, most: int = LABELLED_TOXIC) -> DataFrame:
    """text and toxic of documents that are in `labels`, at most so many; ids and labels, being so few, are broadcast."""
    labels = table(spark, sf_dir, "labels").where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(F.broadcast(labels.orderBy(F.xxhash64("doc_id")).limit(most)), "doc_id").select("text", "toxic")


def op9_setsketch_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80).drop("text_key")


OP9_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as materialized (
  select doc_id, unnest(list_distinct(case when len(w) = 0 then [] when len(w) = 1 then [w[1]]
    else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end)) as s from words),
sizes as materialized (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as k from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as materialized (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
both_ways as materialized (select a, b from links union all select b, a from links),
reach as (select doc_id, doc_id as to_id from sizes union select r.doc_id, e.b from reach r join both_ways e on e.a = r.to_id)
select d.doc_id, coalesce(s.n, 0) as n_shingles, coalesce(r.c, d.doc_id) as component_id, d.doc_id = coalesce(r.c, d.doc_id) as kept
from documents d left join sizes s using (doc_id) left join (select doc_id, min(to_id) as c from reach group by doc_id) r using (doc_id)
"""

def op1_subspace_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_neardup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


OP1_SQL = """
with recursive v as materialized (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as materialized (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
reach as (select vec_id, vec_id as to_id from embeddings union select r.vec_id, l.b from reach r join links l on l.a = r.to_id),
found as (select vec_id, min(to_id) as component_id from reach group by vec_id)
select f.vec_id, (select count(*) from links l where l.a = f.vec_id) as n_links, f.component_id, f.vec_id = f.component_id as kept from found f
"""


def op2_resynchronised_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), limit=4096)


def op6_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), capacity=2048).drop("ids")


def op8_mixture_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    found = langid.languages(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", F.map_entries("proportions").alias("proportions"))


def op10_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents")).drop("found")


def op7_pruned_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann_graph.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_templates.without_recurring_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("n_chars_left"), F.md5(F.encode("text", "UTF-8")).alias("text_md5"))


def op4_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labelled = labelled_languages(spark, sf_dir)
    found = mixing.mixed(docs, labelled, flattened(labelled))
    return found.select("doc_id", "domain", "tokens", "rate", "copies")


def op5_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.quality(table(spark, sf_dir, "documents"), toxic=labelled_toxic(spark, sf_dir)).select("doc_id", "votes", "posterior", "score", "kept")


def planted_periods(docs: DataFrame) -> DataFrame:
    """documents with periodic ends in about a tenth of the texts: with h = crc32(doc_id), g = h // 10 and h % 10 = 0, each of the n words i >= a becomes word a + (i - a) % p, a = g % n, p = 1 + (n - a) // (3 + g % 8)."""
    t = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h")).withColumn("g", F.floor(F.col("h") / 10))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    t = t.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
    t = t.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    t = t.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    of = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    periodic = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("w", of(i))), " ")
    return t.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), periodic).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapsed(planted_periods(table(spark, sf_dir, "documents")), least=12, repeats=2)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    t = found.withColumn("best", longest)
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return t.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"), F.call_function("div", 1000 * length, period).alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("runs_sha256"), F.sha2(F.encode("text", "UTF-8"), 256).alias("collapsed_sha256"),
    )


def op11_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    records = stored(warc.read_records(spark, path), "warc-records")
    delete(spark, [path])
    return warc.resolved(records).select(warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to").alias("refers_to"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {"op5_weak_label_quality": op5_weak_label_quality, "op4_soft_mixing": op4_soft_mixing, "op3_line_templates": op3_line_templates, "op7_pruned_graph_search": op7_pruned_graph_search, "op10_entropy_secrets": op10_entropy_secrets, "op8_mixture_languages": op8_mixture_languages, "op6_harmonic_packing": op6_harmonic_packing, "op2_resynchronised_tokens": op2_resynchronised_tokens, "op1_subspace_near_vectors": op1_subspace_near_vectors, "op9_setsketch_near_duplicates": op9_setsketch_near_duplicates, "op12_periodic_runs": op12_periodic_runs, "op11_warc_chunks": op11_warc_chunks, "op13_collocations": op13_collocations}
ORACLE_SQL = {"op1_subspace_near_vectors": OP1_SQL, "op9_setsketch_near_duplicates": OP9_SQL}
