"""Exactly one copy of each message that was delivered at least once.

Deliveries are upserted into a table hash-bucketed and sorted by identifier. Every batch, or group of batches, adds one
sorted run per bucket, in which it alone is collapsed; compaction reads a bucket's runs together, without a shuffle,
and collapses equal identifiers to the row with the lowest delivery number.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, uuid_key
from ..sources.shared import Workspace, numbered, remove

#: A bucket holds about this many deliveries; batches that come together are put into this many runs.
BUCKET_ROWS, RUNS = 1_000_000, 4


def message_key(identifiers: Sequence[Column], qualifiers: Sequence[Column] = ()) -> Column:
    """One binary key of a message; null where its first identifier is null or blank.

    ``identifiers`` are equal if they stand for the same UUID, ``qualifiers`` if they differ only in letter
    case or outer blanks. A missing qualifier is a value of its own. Parts carry their length, so that
    ("ab", "c") and ("a", "bc") differ.
    """
    parts = [uuid_key(c) for c in identifiers]
    parts += [F.encode(F.lower(blank_to_null(c)), "UTF-8") for c in qualifiers]
    if len(parts) == 1:
        return parts[0]
    sized = [
        F.concat(F.encode(F.coalesce(F.octet_length(p).cast("string"), F.lit("-")), "UTF-8"), F.encode(F.lit(":"), "UTF-8"), F.coalesce(p, F.lit(b"")))
        for p in parts
    ]
    return F.when(parts[0].isNotNull(), F.concat(*sized))


def collapse(df: DataFrame, order: str = "delivery_id") -> DataFrame:
    """One row per ``message_key``: the lowest ``order``. Combines before a shuffle, so many copies of one message are no hot spot."""
    return df.groupBy("message_key").agg(F.min(order).alias(order))


class MessageStore:
    """Hash-bucketed storage, sorted by identifier, of the kept delivery of each message.

    ``upsert`` is idempotent: a batch given twice adds runs that the merge collapses. The table has
    ``buckets`` files per run; choose them so that a bucket's runs fit a task's sort memory (about 1 GB).
    The table is external, in a folder all executors share, and can be opened again by another session.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, order: str = "delivery_id"):
        self.spark, self.path, self.buckets, self.order = spark, path.rstrip("/"), buckets, order
        self.generation = max(numbered(spark, self.path), default=0)
        self._table = self._create()

    def _create(self) -> str:
        name = f"messages_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} (message_key BINARY, {self.order} BIGINT) USING parquet "
            f"CLUSTERED BY (message_key) SORTED BY (message_key) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{self.generation}'"
        )
        atexit.register(self._forget, name)
        return name

    def _forget(self, name: str) -> None:
        """Drop the table's name; what it holds stays in its folder."""
        try:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        except Exception:  # the session may be gone already
            pass

    def upsert(self, batch: DataFrame) -> None:
        """Add one sorted run per bucket with the lowest ``order`` of each message of ``batch``; null keys are not messages."""
        run = collapse(batch.where("message_key is not null"), self.order).repartition(self.buckets, "message_key")
        run.sortWithinPartitions("message_key").select("message_key", self.order).write.insertInto(self._table)

    def upsert_batches(self, deliveries: DataFrame, batch: str = "batch_id", runs: int = RUNS) -> None:
        """Upsert many batches in one pass: a batch goes whole into one of ``runs`` sorted runs per bucket.

        A run is collapsed before it is shuffled to its bucket; copies in batches of different runs stay until they are merged.
        """
        runs_of = deliveries.where("message_key is not null").withColumn("run", F.pmod(F.xxhash64(batch), F.lit(runs)).cast("int"))
        kept = runs_of.groupBy("run", "message_key").agg(F.min(self.order).alias(self.order))
        bucket = F.pmod(F.hash("message_key"), F.lit(self.buckets))  # as the writer counts buckets
        kept = kept.repartitionById(self.buckets * runs, (bucket * runs + F.col("run")).cast("int"))
        kept.sortWithinPartitions("message_key").select("message_key", self.order).write.insertInto(self._table)

    def runs(self) -> int:
        """How many files the table holds: one for each bucket and run that is not empty."""
        return len(self.spark.table(self._table).inputFiles())

    def read(self) -> DataFrame:
        """The kept deliveries, merged on read bucket by bucket: the bucketed scan needs no shuffle."""
        return collapse(self.spark.table(self._table), self.order)

    def compact(self) -> None:
        """Merge all runs into one sorted run per bucket, then drop the old ones."""
        old, merged = self._table, self.read()
        at = f"{self.path}/{self.generation}"
        self.generation += 1
        remove(self.spark, f"{self.path}/{self.generation}")  # of a compaction that was cut short
        self._table = self._create()
        merged.sortWithinPartitions("message_key").select("message_key", self.order).write.insertInto(self._table)
        self.spark.sql(f"DROP TABLE {old}")
        remove(self.spark, at)


def survivors(spark: SparkSession, keyed: DataFrame, batch: str = "batch_id", buckets: int | None = None) -> DataFrame:
    """The kept ``(message_key, delivery_id)`` of a whole table, through a store of its own: upserted by batches, then compacted.

    The number of buckets follows the number of rows, so that one is a task's work at every size.
    """
    # a count without columns reads no more than the footers of the files
    buckets = buckets or max(spark.sparkContext.defaultParallelism, keyed.count() // BUCKET_ROWS + 1)
    store = MessageStore(spark, Workspace(spark, "messages").path, buckets)
    store.upsert_batches(keyed, batch)
    store.compact()
    return store.read()


def surplus(keyed: DataFrame, kept: DataFrame, order: str = "delivery_id") -> DataFrame:
    """The rows that are not kept. Joined on ``order``, which is unique, so hot messages spread over all tasks."""
    return keyed.where("message_key is not null").join(kept.select(order), order, "left_anti")


def deduplicate(df: DataFrame, key: Column, kept: DataFrame, order: str = "delivery_id") -> DataFrame:
    """``df`` with one row per message; rows without identifier are no copies of anything and stay."""
    return df.where(key.isNull()).unionByName(df.where(key.isNotNull()).join(kept.select(order), order, "left_semi"))
