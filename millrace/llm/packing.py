"""Putting items of varying length into containers of fixed capacity, by minimum bin slack.

Items of one length are alike, so the search needs only how many there are of each length - at most
``capacity`` numbers, whatever the number of items. For each bin the longest item left is set, and a bitset
subset-sum over the lengths left finds the fullest way to fill the rest; the bin found is repeated while
its items last. The items then look up their bin by their rank among the items of their length.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.ship import ship

#: Items of one length are ranked in groups of about this many.
RANK_GROUP = 500_000
_RANK_BITS = 40


def fullest(room: int, left: Mapping[int, int]) -> dict[int, int]:
    """The lengths, with their numbers of uses, that fill ``room`` best; longer lengths are taken first."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((n for n in left if n <= room), reverse=True):
        most, chunk = min(left[length], room // length), 1
        while most > 0:
            uses = min(chunk, most)
            steps.append((length, uses, reach))
            reach |= (reach << (length * uses)) & mask
            most, chunk = most - uses, chunk * 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, uses, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + uses
            at -= length * uses
    return chosen


def plan_bins(counts: Mapping[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """``(times, {length: uses})`` bins that hold ``counts[length]`` items of each length of 1 to ``capacity``."""
    left, bins = {n: c for n, c in counts.items() if c > 0}, []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        if not rest[longest]:
            del rest[longest]
        bin_ = fullest(capacity - longest, rest) if longest < capacity else {}
        bin_[longest] = bin_.get(longest, 0) + 1
        times = min(left[n] // uses for n, uses in bin_.items())
        for n, uses in bin_.items():
            left[n] -= uses * times
            if not left[n]:
                del left[n]
        bins.append((times, bin_))
    return bins


def _lookup(plans: Mapping[int, list[tuple[int, dict[int, int]]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Arrays sorted by (capacity, length, first rank): code, first rank, uses a bin, first bin."""
    rows = []
    for c, bins in enumerate(plans.values()):
        taken: dict[int, int] = {}
        first = 0
        for times, bin_ in bins:
            for n, uses in bin_.items():
                start = taken.get(n, 0)
                rows.append((_code(c, n) + start, start, uses, first))
                taken[n] = start + uses * times
            first += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return tuple(table[:, i] for i in range(4))  # type: ignore[return-value]


def _code(capacity_no, length):
    return (capacity_no << 60) + (length << _RANK_BITS)


def _ranked(items: DataFrame, by: list[str]) -> DataFrame:
    """``items`` with ``rank``, from 0, among the items equal in ``by``, in order of ``doc_id``-hash groups.

    A length that very many items share is ranked in groups, whose totals are summed up, not in one task.
    """
    fans = items.groupBy(*by).agg((F.count(F.lit(1)) / F.lit(RANK_GROUP)).cast("bigint").alias("fan"))
    items = items.join(fans, by).withColumn("grp", F.pmod(F.xxhash64("doc_id"), F.col("fan") + 1)).drop("fan")
    groups = items.groupBy(*by, "grp").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy(*by).orderBy("grp").rowsBetween(W.unboundedPreceding, -1))
    groups = groups.select(*by, "grp", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(W.partitionBy(*by, "grp").orderBy("doc_id")) - 1
    return items.withColumn("within", within).join(groups, [*by, "grp"]).withColumn("rank", F.col("before") + F.col("within")).drop("before", "within", "grp")


def pack(spark: SparkSession, items: DataFrame, capacities: list[int]) -> DataFrame:
    """``capacity, doc_id, piece, tokens, bin`` for every item of ``items`` (``doc_id``, ``tokens``) and capacity.

    An item larger than a capacity is cut into full pieces, each a bin of its own, and a rest that is packed like an
    item; nothing else is cut. Items without tokens (also null) take no room: one row, ``bin`` null. ``bin``
    is unique within a capacity. Repeated ``doc_id`` are items of their own. Lengths and ranks must be below
    2**20 and 2**40, capacities in number below 8.
    """
    ship(spark)
    capacities = sorted(set(capacities))
    if not capacities or capacities[0] < 1 or capacities[-1] >= 1 << (60 - _RANK_BITS) or len(capacities) > 8:
        raise ValueError(f"capacities out of range: {capacities}")
    items = items.select("doc_id", F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"))
    largest = capacities[-1]
    caps = F.explode(F.array(*(F.lit(c).cast("bigint") for c in capacities))).alias("capacity")
    rests = items.where(F.col("tokens") > capacities[0]).select("doc_id", "tokens", caps).where("tokens > capacity")
    rest_length = F.col("tokens") % F.col("capacity")

    # at most capacity numbers for each capacity reach the driver
    whole = {r[0]: r[1] for r in items.where(F.col("tokens").between(1, largest)).groupBy("tokens").count().collect()}
    cut = {(r[0], r[1]): r[2] for r in rests.groupBy("capacity", rest_length).count().collect()}
    plans = {}
    for c in capacities:
        counts = {n: k for n, k in whole.items() if n <= c}
        for (of, n), k in cut.items():
            if of == c and n:
                counts[n] = counts.get(n, 0) + k
        plans[c] = plan_bins(counts, c)
    codes, starts, uses, firsts = _lookup(plans)
    number = {c: i for i, c in enumerate(capacities)}
    if max((n for counts in (whole, cut) for n in counts.values()), default=0) >= 1 << (_RANK_BITS - 1):
        raise ValueError("more items of one length than ranks")
    # as long as the plans, a few numbers for each kind of bin, of which there are at most twice as many as lengths
    sent = spark.sparkContext.broadcast((codes, starts, uses, firsts))

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, starts, uses, firsts = sent.value
        for b in batches:
            c = b["capacity"].map(number).to_numpy(np.int64)
            rank = b["rank"].to_numpy(np.int64)
            at = np.searchsorted(codes, _code(c, b["tokens"].to_numpy(np.int64)) + rank, side="right") - 1
            found = firsts[at] + (rank - starts[at]) // uses[at] if len(b) else np.empty(0, np.int64)
            yield pd.DataFrame({"capacity": b["capacity"], "doc_id": b["doc_id"], "piece": b["piece"], "tokens": b["tokens"], "bin": pd.Series(found).astype(str).to_numpy()})

    schema = f"capacity bigint, doc_id {items.schema['doc_id'].dataType.simpleString()}, piece bigint, tokens bigint, bin string"
    fits = _ranked(items.where(F.col("tokens").between(1, largest)), ["tokens"])
    fits = fits.select("doc_id", "tokens", "rank", caps).where("tokens <= capacity").select("capacity", "doc_id", F.lit(0).cast("bigint").alias("piece"), "tokens", "rank")
    tails = rests.select("capacity", "doc_id", F.floor(F.col("tokens") / F.col("capacity")).alias("piece"), rest_length.alias("tokens")).where("tokens > 0")
    ahead = spark.createDataFrame([(n, k) for n, k in whole.items()], "tokens bigint, ahead bigint")
    tails = _ranked(tails, ["capacity", "tokens"]).join(F.broadcast(ahead), "tokens", "left")
    tails = tails.select("capacity", "doc_id", "piece", "tokens", (F.col("rank") + F.coalesce("ahead", F.lit(0))).alias("rank"))
    binned = fits.unionByName(tails).mapInPandas(look_up, schema)
    full = rests.select("capacity", "doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("tokens") / F.col("capacity")) - 1)).alias("piece"))
    name = F.concat_ws("-", F.lit("full"), F.col("doc_id").cast("string"), F.col("piece").cast("string"))
    full = full.select("capacity", "doc_id", "piece", F.col("capacity").alias("tokens"), name.alias("bin"))
    empty = items.where("tokens < 1").select(caps, "doc_id", F.lit(0).cast("bigint").alias("piece"), "tokens", F.lit(None).cast("string").alias("bin"))
    return binned.unionByName(full).unionByName(empty)


def holds(packed: DataFrame) -> DataFrame:
    """Per capacity what must hold of a packing: pieces and tokens in bins, bins over their capacity, items cut though they fit, and whether at least
    19 twentieths of all room is used."""
    packed = packed.where("bin is not null")
    bins = packed.groupBy("capacity", "bin").agg(F.sum("tokens").alias("used"), F.count(F.lit(1)).alias("pieces"))
    rooms = bins.groupBy("capacity").agg(F.sum("pieces").alias("pieces"), F.sum("used").alias("tokens"), F.count_if(F.col("used") > F.col("capacity")).alias("over_full"), (F.sum("used") >= 0.95 * F.count(F.lit(1)) * F.col("capacity")).alias("well_filled"))
    items = packed.groupBy("capacity", "doc_id").agg(F.sum("tokens").alias("size"), F.max("piece").alias("last"))
    cut = items.groupBy("capacity").agg(F.count_if((F.col("last") > 0) & (F.col("size") <= F.col("capacity"))).alias("cut_for_nothing"))
    return rooms.join(cut, "capacity").select("capacity", "pieces", "tokens", "over_full", "cut_for_nothing", "well_filled")


def fill(packed: DataFrame) -> DataFrame:
    """Per capacity the bins, the pieces and tokens in them, the share of room used and the least number of bins possible."""
    used = packed.where("bin is not null").groupBy("capacity").agg(
        F.count_distinct("bin").alias("bins"), F.count(F.lit(1)).alias("pieces"), F.sum("tokens").alias("tokens")
    )
    return used.select(
        "capacity", "bins", "pieces", "tokens", F.round(F.col("tokens") / (F.col("bins") * F.col("capacity")), 6).alias("filled"),
        F.ceil(F.col("tokens") / F.col("capacity")).alias("least_bins"),
    )
