"""Places in a whole order, or in the order of groups of any size, without a task that holds it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import scratch

#: Of monotonically_increasing_id: bits of a row's number within its partition.
BITS = 33


def places(df: DataFrame, key: list[str], place: str = "place") -> DataFrame:
    """df with each row's place, from 1, in the order of key (ties in any order, so give a key without).

    Rows are dealt out by ranges of the key that Spark samples, sorted within each, and written once to the shared folder, with their
    number there. A row's place is that number after the counts of all ranges before, one row a range.
    """
    spark, path = df.sparkSession, scratch.new_path(df.sparkSession, "ordered")
    df.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("__at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("__range", F.shiftright("__at", BITS))
    counts = rows.groupBy("__range").agg(F.count("*").alias("__n"))
    before = counts.select("__range", (F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).alias("__before"))
    number = F.col("__at").bitwiseAND((1 << BITS) - 1)
    return rows.join(F.broadcast(before), "__range").withColumn(place, F.col("__before") + number + 1).select(*df.columns, place)


def numbered(df: DataFrame, by: list[str], key: str, span: int = 1 << 16, place: str = "place") -> DataFrame:
    """df with each row's place, from 1, among the rows of its group, in the order of an integer key without ties.

    The rows of a group are dealt out by ranges of `span` keys, each numbered alone, after the counts of the group's ranges before, one
    row each; so a task sorts `span` rows of a group at most, however large that is.
    """
    t = df.withColumn("__range", F.floor(F.col(key) / span))
    counts = t.groupBy(*by, "__range").agg(F.count("*").alias("__n"))
    before = counts.withColumn("__before", F.sum("__n").over(Window.partitionBy(*by).orderBy("__range")) - F.col("__n")).drop("__n")
    number = F.row_number().over(Window.partitionBy(*by, "__range").orderBy(key))
    return t.withColumn("__number", number).join(before, [*by, "__range"]).withColumn(place, F.col("__before") + F.col("__number")).select(*df.columns, place)
