"""What changed between consecutive full snapshots, from invertible Bloom lookup tables.

Each snapshot's records become items ``(key, content)`` of two 64-bit hashes. They are cut into hash buckets
of about :data:`BUCKET_ITEMS`; each bucket is summed up in a small table of cells holding a count and the XOR
of keys, contents and check sums. Subtracting the tables of two snapshots leaves only what differs, which is
peeled off cell by cell. A bucket with too many differences for its table gets a larger one, and in the end
an exact comparison; the XOR over the whole bucket proves a result complete.

Items are made inside the row of their snapshot; only snapshots that came more than once, or name a node twice, are
put together by a shuffle. Items then move once, without their ids, to be summed up; what meets for the subtraction
are cells.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import instant
from ..sources.shared import Workspace
from ..sources.ship import ship
from .skew import short

BUCKET_ITEMS = 32
#: Cells of a bucket's first table; a failed bucket gets four times as many, this many times.
FIRST_CELLS, ENLARGEMENTS = 12, 4
WHOLE = -1  # number of the cell that sums up its whole bucket

_SUMS = ["n", "key_x", "content_x", "check_x"]


def _buckets(items: Column) -> Column:
    """A power of two, so that the tables of a larger snapshot can be summed up into those of a smaller one."""
    return F.pow(F.lit(2), F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(items, F.lit(1)) / F.lit(BUCKET_ITEMS))))).cast("bigint")


def node_items(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``snapshot_id, key, content, node_id, buckets``: each node of each snapshot once.

    Order within arrays and maps means nothing, a null metadata map is an empty one. Repeated deliveries of a
    snapshot are put together; of a node that comes more than once the one first received counts, then the one
    with the smallest content hash. Nodes without ``node_id`` and snapshots without id are left out.
    """
    work = Workspace(spark, "items")
    named = df.where("snapshot_id is not null")
    often = work.write(named.groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("snapshot_id", F.lit(True).alias("often")), "often")

    def item(n: Column) -> Column:
        entries = F.array_sort(F.coalesce(F.map_entries(n["metadata"]), F.array().cast("array<struct<key:string,value:string>>")))
        text = F.to_json(F.struct(n["node_id"].alias("i"), n["type"].alias("t"), n["label"].alias("l"), entries.alias("m")), {"ignoreNullFields": "false"})
        return F.struct(F.xxhash64(n["node_id"]).alias("key"), F.xxhash64(text).alias("content"), n["node_id"].alias("node_id"))

    items = F.transform(F.filter("nodes", lambda n: n["node_id"].isNotNull()), item)
    keys = F.col("items.key")
    rows = named.join(short(often), "snapshot_id", "left").select("snapshot_id", "received_at", "often", items.alias("items")).where(F.size("items") > 0)
    rows = rows.withColumn("whole", F.col("often").isNull() & (F.size(F.array_distinct(keys)) == F.size(keys)))
    here = rows.where("whole").select("snapshot_id", F.inline("items"), _buckets(F.size("items")).alias("buckets"))
    parts = rows.where("not whole").select("snapshot_id", "received_at", F.inline("items"))
    first = F.min(F.struct("received_at", "content")).alias("first")
    parts = parts.groupBy("snapshot_id", "key").agg(first, F.min("node_id").alias("node_id")).select("snapshot_id", "key", F.col("first.content").alias("content"), "node_id")
    sizes = parts.groupBy("snapshot_id").agg(_buckets(F.count(F.lit(1))).alias("buckets"))
    columns = ["snapshot_id", "key", "content", "node_id", "buckets"]
    return work.write(here.select(columns).unionByName(parts.join(sizes, "snapshot_id").select(columns)), "items")


def consecutive(df: DataFrame) -> DataFrame:
    """``snapshot_id, before``: each snapshot with the one before it of its ``codebase_root``, by ``captured_at``.

    Deliveries of a snapshot are one, taken at the earliest time read; where none can be read ``received_at``
    stands in. Ties go by id. Order is found within days and then among the days of a root, so that
    no task takes all snapshots of a root.
    """
    at = F.coalesce(instant(F.col("captured_at")), F.col("received_at").cast("timestamp"))
    one = df.where("snapshot_id is not null").groupBy("snapshot_id").agg(F.min("codebase_root").alias("root"), F.min(at).alias("at"))
    one = one.withColumn("day", F.to_date("at"))
    inside = W.partitionBy("root", "day").orderBy("at", "snapshot_id")
    one = one.withColumn("before", F.lag("snapshot_id").over(inside))
    days = one.groupBy("root", "day").agg(F.max_by("snapshot_id", F.struct("at", "snapshot_id")).alias("last_id"))
    days = days.select("root", "day", F.lag("last_id").over(W.partitionBy("root").orderBy("day")).alias("day_before"))
    same = F.col("one.root").eqNullSafe(F.col("d.root")) & F.col("one.day").eqNullSafe(F.col("d.day"))
    joined = one.alias("one").join(days.alias("d"), same, "left")
    return joined.select("one.snapshot_id", "one.root", F.coalesce("one.before", "d.day_before").alias("before"))


def _cells(items: DataFrame, by: list[str], cells: int) -> DataFrame:
    """The tables of the buckets ``by``: one row per cell that is not empty."""
    third = cells // 3
    at = [F.pmod(F.shiftrightunsigned("content", s), F.lit(third)).cast("int") + i * third for i, s in enumerate((0, 21, 42))]
    check = F.crc32(F.concat_ws(",", F.col("key").cast("string"), F.col("content").cast("string")))
    sign = F.col("sign") if "sign" in items.columns else F.lit(1)
    rows = items.select(*by, "key", "content", check.alias("check"), sign.cast("bigint").alias("sign"), F.explode(F.array(F.lit(WHOLE), *at)).alias("cell"))
    return rows.groupBy(*by, "cell").agg(F.sum("sign").alias("n"), F.bit_xor("key").alias("key_x"), F.bit_xor("content").alias("content_x"), F.bit_xor("check").alias("check_x"))


def _nonzero() -> Column:
    return (F.col("n") != 0) | (F.col("key_x") != 0) | (F.col("content_x") != 0) | (F.col("check_x") != 0)


def _peel(cells: list[tuple[int, int, int, int, int]], third: int) -> list[tuple[int, int, int]] | None:
    """``(sign, key, content)`` of all that differs, or None where the table is too small."""
    table = {c: [n, k, v, h] for c, n, k, v, h in cells}
    whole, found = table.pop(WHOLE, [0, 0, 0, 0]), []
    todo = list(table)
    while todo:
        cell = table.get(todo.pop())
        if cell is None or cell[0] not in (1, -1):
            continue
        sign, key, content, check = cell
        if zlib.crc32(b"%d,%d" % (key, content)) != check:
            continue
        found.append((sign, key, content))
        bits = content & 0xFFFFFFFFFFFFFFFF
        for i, s in enumerate((0, 21, 42)):
            # as pmod of the signed number for s = 0
            at = (content if s == 0 else bits >> s) % third + i * third
            other = table.setdefault(at, [0, 0, 0, 0])
            other[0] -= sign
            other[1] ^= key
            other[2] ^= content
            other[3] ^= check
            if other == [0, 0, 0, 0]:
                del table[at]
            else:
                todo.append(at)
        whole = [whole[0] - sign, whole[1] ^ key, whole[2] ^ content, whole[3] ^ check]
        if len(found) > 2 * 3 * third:
            return None
    return None if table or any(whole) else found


def _decoder(third: int):
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for snapshot, bucket, cells in zip(batch["snapshot_id"], batch["bucket"], batch["cells"], strict=True):
                got = _peel([(int(c["cell"]), *(int(c[s]) for s in _SUMS)) for c in cells], third)
                out += [(snapshot, bucket, 0, 0, 0)] if got is None else [(snapshot, bucket, *x) for x in got]
            yield pd.DataFrame(out, columns=["snapshot_id", "bucket", "sign", "key", "content"])

    return decode


def _decoded(cells: DataFrame, size: int) -> DataFrame:
    """Peel every bucket; a failed one gives one row of sign 0. A bucket has at most ``size + 1`` cells."""
    grouped = cells.where(_nonzero()).groupBy("snapshot_id", "bucket").agg(F.collect_list(F.struct("cell", *_SUMS)).alias("cells"))
    return grouped.mapInPandas(_decoder(size // 3), "snapshot_id string, bucket bigint, sign int, key bigint, content bigint")


def differences(spark: SparkSession, items: DataFrame, pairs: DataFrame, first_cells: int = FIRST_CELLS, enlargements: int = ENLARGEMENTS) -> DataFrame:
    """``snapshot_id, before, key, change_kind`` for each pair of consecutive snapshots.

    ``items`` as of :func:`node_items`, ``pairs`` as of :func:`consecutive`; a snapshot without one before
    it has no changes. ``first_cells`` is a multiple of 3. Buckets are taken from the low bits of the keys, so that tables of
    different numbers of buckets can be summed up into each other.
    """
    ship(spark)
    work = Workspace(spark, "snapshots")
    sizes = items.groupBy("snapshot_id").agg(F.max("buckets").alias("buckets"))
    other = sizes.select(F.col("snapshot_id").alias("before"), F.col("buckets").alias("others"))
    pairs = pairs.where("before is not null").join(sizes, "snapshot_id", "left").join(other, "before", "left")
    # two snapshots are compared in as many buckets as the smaller one has; one without items has one
    pairs = work.write(pairs.select("snapshot_id", "before", F.least(F.coalesce("buckets", F.lit(1)), F.coalesce("others", F.lit(1))).alias("buckets")), "pairs")
    # a snapshot counts in its own comparison and, with the other sign, in that of the snapshot after it
    own = pairs.select("snapshot_id", F.col("snapshot_id").alias("pair"), F.lit(1).alias("sign"), F.col("buckets").alias("of"))
    after = pairs.select(F.col("before").alias("snapshot_id"), F.col("snapshot_id").alias("pair"), F.lit(-1).alias("sign"), F.col("buckets").alias("of"))
    met = items.select("snapshot_id", "key", "content").join(own.unionByName(after), "snapshot_id")
    sided = met.select(F.col("pair").alias("snapshot_id"), F.pmod("key", "of").alias("bucket"), "sign", "key", "content")
    subtracted = _cells(sided, ["snapshot_id", "bucket"], first_cells)
    decoded = [work.write(_decoded(subtracted, first_cells), "decoded-0")]
    size = first_cells
    for k in range(1, enlargements + 2):
        failed = decoded[-1].where("sign = 0").select("snapshot_id", "bucket")
        decoded[-1] = decoded[-1].where("sign <> 0")
        if failed.isEmpty():
            break
        again = sided.join(short(work.write(failed, f"failed-{k}")), ["snapshot_id", "bucket"])
        if k <= enlargements:
            size *= 4
            redone = _decoded(_cells(again, ["snapshot_id", "bucket"], size), size)
        else:  # exact comparison of what no table could hold
            same = ["snapshot_id", "bucket", "key", "content"]
            redone = again.groupBy(*same).agg(F.sum("sign").cast("int").alias("sign")).where("sign <> 0").select("snapshot_id", "bucket", "sign", "key", "content")
        decoded.append(work.write(redone, f"decoded-{k}"))
    found = decoded[0]
    for more in decoded[1:]:
        found = found.unionByName(more)
    kinds = found.groupBy("snapshot_id", "key").agg(F.max("sign").alias("most"), F.min("sign").alias("least"))
    kind = F.when(F.col("most") != F.col("least"), "changed").when(F.col("most") > 0, "added").otherwise("removed")
    return kinds.join(pairs.select("snapshot_id", "before"), "snapshot_id").select("snapshot_id", "before", "key", kind.alias("change_kind"))


def node_changes(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``snapshot_id, node_id, change_kind`` (``added``, ``removed``, ``changed``) of lineage snapshots.

    A removed node is reported with the later snapshot's id. Needed columns: ``snapshot_id, codebase_root,
    captured_at, received_at, nodes``.
    """
    items = node_items(spark, df)
    changes = Workspace(spark, "changes").write(differences(spark, items, consecutive(df)), "changes")
    at = F.when(F.col("change_kind") == "removed", F.col("before")).otherwise(F.col("snapshot_id"))
    named = items.select(F.col("snapshot_id").alias("of"), "key", "node_id").join(short(changes.withColumn("of", at)), ["of", "key"])
    return named.select("snapshot_id", "node_id", "change_kind")
