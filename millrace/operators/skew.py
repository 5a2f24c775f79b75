"""Joins whose key may be shared by very many rows of one side, and of tables that may be sent to every executor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot if it has more rows than this.
HOT_ROWS = 200_000
#: No more keys than this can be hot, however large the table is, so the list of them can be broadcast.
HOT_KEYS = 10_000
#: A list of no more rows than this may be sent to every executor.
SENT_ROWS = 100_000


def short(df: DataFrame, most: int = SENT_ROWS) -> DataFrame:
    """``df``, a table that is written, marked for broadcast if it is counted to be short; a longer one is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def look_up(many: DataFrame, one: DataFrame, key: str, rows: int, spread: Column, how: str = "inner", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``many`` joined with the row of ``one`` that has its ``key``; ``one`` has each key once.

    ``rows`` is the number of rows of ``many``. Keys that more than ``hot_rows`` of them share, and more than one row in
    :data:`HOT_KEYS`, are cut into parts by a hash of ``spread``, and their row of ``one`` is repeated for each part. Tables that are too small
    for a hot key are joined as they are. ``how`` is ``inner`` or ``left``; a null key finds nothing. The columns are those of a join on ``key``.
    """
    least = max(hot_rows, rows // HOT_KEYS)
    if rows <= least:
        return many.join(one, key, how)
    if how == "left":  # rows without a key need no join, and would meet in one task
        found = look_up(many.where(F.col(key).isNotNull()), one, key, rows, spread, "_left", hot_rows)
        return found.unionByName(many.where(F.col(key).isNull()), allowMissingColumns=True)
    how = how.removeprefix("_")
    counts = many.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > least)
    hot = F.broadcast(counts.select(key, F.ceil(F.col("_n") / F.lit(least)).cast("int").alias("_fan")))  # fewer than HOT_KEYS rows
    fan = F.coalesce("_fan", F.lit(1))
    left = many.join(hot, key, "left").withColumn("_part", F.pmod(F.xxhash64(spread), fan).cast("int")).drop("_fan")
    right = one.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), fan - 1))).drop("_fan")
    return left.join(right, [key, "_part"], how).drop("_part")
