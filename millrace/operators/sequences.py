"""Order within keys: gaps, repeats, ranks, last versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sequence_breaks(df: DataFrame, key: str, sequence: str, order: str) -> DataFrame:
    """``key, breaks``: per key, neighbours in sequence that are not one apart, plus one for each repeat of a number.

    A repeat so counts twice; the first number need not be 0; rows without a number are left out. Only how often each
    number comes matters, so rows are counted per key and number before anything is sorted: a key with very many rows is
    sorted by its distinct numbers. Neighbours are found within blocks of a million numbers and then across blocks.
    """
    counts = df.where(F.col(sequence).isNotNull()).groupBy(F.coalesce(F.col(key).cast("string"), F.lit("None")).alias(key), F.col(sequence).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("block", F.floor(F.col("s") / F.lit(1_000_000)))
    inside = W.partitionBy(key, "block").orderBy("s")
    counts = counts.withColumn("before", F.lag("s").over(inside))
    edges = counts.groupBy(key, "block").agg(F.min("s").alias("low"), F.max("s").alias("high"))
    edges = edges.withColumn("before", F.lag("high").over(W.partitionBy(key).orderBy("block")))
    jump = lambda here: F.when(F.col("before").isNotNull() & (F.col(here) != F.col("before") + 1), 1).otherwise(0)
    # a repeat is also a neighbour that is not one apart
    own = counts.select(key, (jump("s") + 2 * (F.col("n") - 1)).alias("b"))
    return own.unionByName(edges.select(key, jump("low").alias("b"))).groupBy(key).agg(F.sum("b").cast("bigint").alias("breaks"))


def first_per(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first in ``order``; ties are not broken beyond it."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def last_two(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last two versions of each key, with ``age`` 1 and 2."""
    return df.withColumn("age", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(order)))).where("age <= 2")
