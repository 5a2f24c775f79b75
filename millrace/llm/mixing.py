"""Mixing sources to target shares, by a low-discrepancy schedule of equal-token blocks.

A mix is a row of slots of ``block_tokens`` each. The van der Corput point of a slot, mapped through the
cumulative shares, names its source, so every stretch of the mix keeps the shares to within a few slots. The
texts of a source are shuffled, once for every repetition, and cut into blocks of that size; the r-th slot of
a source takes its r-th block. A source has as many slots as its target needs, of the last one only the texts that start before
the target is reached; one whose blocks run out leaves its last slots empty and stays below its target.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..sources.shared import Workspace

#: Rows are ranked and summed up in groups of about this many.
GROUP = 500_000
_BITS = 40


def source_key(c: Column) -> Column:
    """Sources are one if they differ only in letter case or outer blanks."""
    return F.lower(blank_to_null(c))


def van_der_corput(i: Column) -> Column:
    """The binary digits of ``i`` mirrored behind the point; exact for i below 2**40."""
    return F.conv(F.reverse(F.lpad(F.bin(i), _BITS, "0")), 2, 10).cast("double") / float(1 << _BITS)


def _wants(documents: DataFrame, targets: DataFrame) -> list[dict]:
    """For each target the tokens wanted, tokens and texts there, in the order of ``mix, source``."""
    sizes = documents.groupBy("key").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("texts"))
    total = documents.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    rows = targets.withColumn("key", source_key(F.col("source"))).join(sizes, "key", "left").orderBy("mix", "source").collect()
    return [
        r.asDict() | {"tokens": r.tokens or 0, "texts": r.texts or 0, "wanted": r.target_share * r.size_ratio * total, "supply": r.max_repeats * (r.tokens or 0)}
        for r in rows
    ]


def _schedule(spark: SparkSession, wants: list[dict], block_tokens: int) -> DataFrame:
    """``mix, slot, key, rank``: the source of each slot and its rank among the source's slots of the mix, up to as many as its target needs.

    The points name a source at most ``log2(slots) + 2`` times too seldom, so enough slots are looked at for the smallest share, too.
    """
    parts = []
    for mix in sorted({w["mix"] for w in wants}):
        own = [w for w in wants if w["mix"] == mix and w["wanted"] > 0]
        if not own:
            continue
        whole = sum(w["wanted"] for w in own)
        rarest = min(w["wanted"] for w in own) / whole
        slots = whole / block_tokens
        slots = math.ceil(slots + (math.log2(2 * slots + 4 / rarest * 64) + 4) / rarest)
        if slots >= 1 << _BITS:
            raise ValueError("too many slots; take larger blocks")
        point, edge, name = van_der_corput(F.col("slot")), 0.0, None
        for w in own:
            edge += w["wanted"] / whole
            inside = point < edge if w is not own[-1] else F.lit(True)
            name = F.when(inside, w["key"]) if name is None else name.when(inside, w["key"])
        parts.append(spark.range(slots).select(F.col("id").alias("slot")).select(F.lit(mix).alias("mix"), "slot", name.alias("key")))
    if not parts:
        return spark.createDataFrame([], "mix string, slot bigint, key string, rank bigint")
    slots = parts[0]
    for p in parts[1:]:
        slots = slots.unionByName(p)
    slots = slots.withColumn("grp", F.floor(F.col("slot") / F.lit(GROUP)))
    counts = slots.groupBy("mix", "key", "grp").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("mix", "key").orderBy("grp").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.select("mix", "key", "grp", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(W.partitionBy("mix", "key", "grp").orderBy("slot")) - 1
    return slots.withColumn("within", within).join(counts, ["mix", "key", "grp"]).select("mix", "slot", "key", (F.col("before") + F.col("within")).alias("rank"))


def _blocks(spark: SparkSession, documents: DataFrame, wants: list[dict], block_tokens: int, seed: int) -> DataFrame:
    """``key, doc_id, repeat, tokens, block``: each source's texts, shuffled anew for each repetition, cut into blocks.

    A text belongs to the block in which it starts. Only as many repetitions are made as some mix needs.
    """
    needs: dict[str, list] = {}
    for w in wants:
        if w["tokens"] and w["wanted"] > 0:
            copies = min(w["max_repeats"], math.ceil(w["wanted"] / w["tokens"]) + 1)  # one more than exact, for rounding
            needs[w["key"]] = [w["tokens"], w["texts"] // GROUP + 1, max(copies, needs.get(w["key"], [0, 0, 0])[2])]
    # one row for each target source: fixed by the targets, not by the data
    small = spark.createDataFrame([(k, *v) for k, v in needs.items()], "key string, of bigint, fan bigint, copies bigint")
    copies = documents.where("tokens > 0").join(F.broadcast(small), "key")
    copies = copies.select("key", "doc_id", "tokens", "of", "fan", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("repeat"))
    lot = F.xxhash64("doc_id", "repeat", F.lit(seed))
    copies = copies.withColumn("lot", lot).withColumn("grp", F.pmod(F.shiftrightunsigned("lot", 8), F.col("fan")))
    by = ["key", "repeat", "grp"]
    sums = copies.groupBy(*by).agg(F.sum("tokens").alias("n"))
    before = F.sum("n").over(W.partitionBy("key", "repeat").orderBy("grp").rowsBetween(W.unboundedPreceding, -1))
    sums = sums.select(*by, F.coalesce(before, F.lit(0)).alias("before"))
    within = F.coalesce(F.sum("tokens").over(W.partitionBy(*by).orderBy("lot", "doc_id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    start = F.col("repeat") * F.col("of") + F.col("before") + F.col("within")
    return copies.withColumn("within", within).join(sums, by).select("key", "doc_id", "repeat", "tokens", F.floor(start / F.lit(block_tokens)).alias("block"), start.alias("start"))


def mix_sources(spark: SparkSession, documents: DataFrame, targets: DataFrame, block_tokens: int = 1024, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """The mixes and their report.

    ``documents`` has ``doc_id, source, tokens``; ``targets`` a row for each mix and source with ``mix, size_ratio,
    source, target_share, max_repeats`` and is a small table, read by the driver. A mix is to have ``size_ratio`` times the tokens of
    all documents. Texts without tokens take no part; sources that no target names only count for the total.

    First result: ``mix, slot, place, source, doc_id, repeat, tokens``: read by ``slot`` and ``place`` it is the mix.
    Second: per mix and source the target share, ``wanted_tokens``, ``supply_tokens`` (``max_repeats`` times
    the source), ``actual_tokens``, ``actual_share`` (of the mix as it is), ``most_repeats``, ``longest`` (tokens of its longest
    text in the mix) and ``missed``: the tokens in the mix are fewer than wanted. A source that does not miss has less than ``longest`` too many.
    """
    documents = documents.select("doc_id", source_key(F.col("source")).alias("key"), F.coalesce("tokens", F.lit(0)).alias("tokens"))
    documents = Workspace(spark, "mix").write(documents, "sizes")
    wants = _wants(documents, targets)
    blocks = _blocks(spark, documents, wants, block_tokens, seed)
    slots = _schedule(spark, wants, block_tokens)
    columns = ["mix", "size_ratio", "source", "key", "target_share", "max_repeats", "wanted", "supply"]
    named = spark.createDataFrame([[w[c] for c in columns] for w in wants], "mix string, size_ratio double, source string, key string, target_share double, max_repeats bigint, wanted double, supply bigint")
    chosen = slots.join(blocks, (slots["key"] == blocks["key"]) & (slots["rank"] == blocks["block"])).select("mix", "slot", blocks["key"].alias("key"), "doc_id", "repeat", "tokens", "start")
    chosen = chosen.join(F.broadcast(named.select("mix", "key", "source", "max_repeats", "wanted")), ["mix", "key"]).where("repeat < max_repeats and start < wanted")
    mixes = chosen.select("mix", "slot", F.col("start").alias("place"), "source", "doc_id", "repeat", "tokens")
    reached = mixes.groupBy("mix", "source").agg(F.sum("tokens").alias("actual_tokens"), F.max(F.col("repeat") + 1).alias("most_repeats"), F.max("tokens").alias("longest"))
    report = named.join(reached, ["mix", "source"], "left").withColumn("actual_tokens", F.coalesce("actual_tokens", F.lit(0)))
    report = report.select(
        "mix", "source", "target_share", "max_repeats", F.col("wanted").alias("wanted_tokens"), F.col("supply").alias("supply_tokens"), "actual_tokens",
        F.try_divide("actual_tokens", F.sum("actual_tokens").over(W.partitionBy("mix"))).alias("actual_share"),
        F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), F.coalesce("longest", F.lit(0)).alias("longest"), (F.col("actual_tokens") < F.col("wanted")).alias("missed"),
    )
    return mixes, report
