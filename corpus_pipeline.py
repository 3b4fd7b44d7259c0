"""The corpus pipeline: five stages over documents, each by one operator of cellstream.llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstream import scratch
from cellstream.llm import line_templates, mixing, packing, setsketch, weak_quality
from cellstream.llm.common import stored, table
from cellstream.llm.queries import flattened, labelled_languages, labelled_toxic


def _shielded(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A stage on doc_id and text, with the other columns out of reach of the names that operators give."""
    own = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    after = stage(docs.withColumnsRenamed(own))
    return after.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. Null, empty and blank texts go; repeated rows fare alike; an empty table stays empty."""
    toxic = labelled_toxic(spark, sf_dir)
    return _shielded(docs, lambda d: weak_quality.quality(d, toxic=toxic).where("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of recurring templates; n_chars, where there is one, follows. Null texts stay null, texts that would be left blank stay whole."""
    cleaned = _shielded(docs, line_templates.without_recurring_lines)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8), the one of the smallest doc_id.

    Of repeated rows of that doc_id one stays; rows of it with different texts stay each, as none stands for the other. Rows
    without doc_id stay, and so do null and empty texts, which are nobody's duplicates.
    """

    def one_each(d: DataFrame) -> DataFrame:
        kept = setsketch.near_duplicates(d, words=5, percent=80).where("kept and doc_id is not null").select("doc_id", F.col("text_key").alias("__text"))
        return d.withColumn("__text", setsketch.text_key()).join(kept.distinct(), ["doc_id", "__text"], "left_semi").dropDuplicates(["doc_id", "__text"])

    return _shielded(docs, one_each).unionByName(docs.where("doc_id is null"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say, once at least: languages come to their weights by repeating, so no document is lost. Null and empty texts have no tokens and stay once."""
    labelled = labelled_languages(spark, sf_dir)
    weights = flattened(labelled)
    copies = F.explode(F.sequence(F.lit(1), F.greatest(F.col("copies"), F.lit(1))))
    return _shielded(docs, lambda d: mixing.mixed(d, labelled, weights, least=1.0).withColumn("__copy", copies))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens; a null or empty text is one piece of its end token."""
    return packing.packed(docs, capacity=2048).drop("ids")


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix", mix), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the other stages wrote is deleted once it is read."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scratch.recorded() as made:
            docs = stored(stage(spark, docs, sf_dir), name)
        scratch.delete(spark, [*made[:-1], *before])
        before = made[-1:]
        scratch.let_go(spark, every=0)
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL has no tokenizer, registers or fitted scorer; tests hold each stage against a plain version.
ORACLE_SQL = None
