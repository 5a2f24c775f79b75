"""Aggregates per period that are put right as late records arrive.

The ledger stores mergeable partial aggregates. A partial belongs to one period (aggregate and UTC day)
and one arrival slot (the hour in which its events were first recorded), holds the number of events and
the newest ``(sequence, recorded, status)``, and merges by addition and maximum. Every cut-off is a whole
number of hours after the end of the day, so any state of a period - as first given out, as last
corrected - is the combination of whole partials: nothing is counted again from the events.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import instant, uuid_key
from ..sources.shared import Workspace, numbered, remove

EVENT = ["event_key"]
PERIOD = ["aggregate_id", "period_day"]


@dataclass(frozen=True)
class Lateness:
    """When a period is first given out and until when it may change, in hours after its end."""

    first_hours: int = 1
    closed_hours: int = 72


def _newest(status: Column, sequence: Column, recorded: Column) -> Column:
    return F.struct(sequence.alias("sequence"), recorded.alias("recorded"), status.alias("status"))


def readings(log: DataFrame) -> DataFrame:
    """One narrow row per delivery: the key of its event and the times that can be read, as epoch microseconds.

    Rows without ``event_id`` (null or blank) are left out. Needed columns: ``event_id, aggregate_id,
    sequence_number, payload.status, occurred_at, recorded_at``; others are ignored.
    """
    micros = lambda c: F.unix_micros(instant(F.col(c)))
    return log.select(
        uuid_key(F.col("event_id")).alias("event_key"),
        F.col("aggregate_id"),
        F.col("sequence_number").cast("bigint").alias("sequence"),
        F.col("payload.status").alias("status"),
        micros("occurred_at").alias("occurred"),
        micros("recorded_at").alias("recorded"),
    ).where("event_key is not null")


def fold_copies(read: DataFrame) -> DataFrame:
    """One row per event: its copies are folded into the earliest readable times and the newest status.

    Folding is by minimum and maximum only, hence it merges, is repeated without effect and combines
    before the shuffle. Copies that disagree on the aggregate go to the smallest one.
    """
    return read.groupBy(*EVENT).agg(
        F.min("aggregate_id").alias("aggregate_id"),
        F.min("occurred").alias("occurred"),
        F.min("recorded").alias("recorded"),
        F.max(_newest(F.col("status"), F.col("sequence"), F.col("recorded"))).alias("newest"),
    )


def partials(events: DataFrame) -> DataFrame:
    """Partial aggregates per period and arrival slot; events lacking either time are left out.

    ``arrival_hour`` is the number of whole hours from the end of the day to the first recording; all
    that came before the end of the day shares slot -1.
    """
    hour, day = 3_600_000_000, 86_400_000_000
    day_no = F.floor(F.col("occurred") / F.lit(day))
    arrival = F.floor((F.col("recorded") - (day_no + 1) * F.lit(day)) / F.lit(hour))
    return (
        events.where("occurred is not null and recorded is not null")
        .select(
            "aggregate_id",
            F.date_add(F.lit("1970-01-01").cast("date"), day_no.cast("int")).alias("period_day"),
            F.greatest(arrival, F.lit(-1)).cast("int").alias("arrival_hour"),
            "newest",
        )
        .groupBy(*PERIOD, "arrival_hour")
        .agg(F.count(F.lit(1)).alias("events"), F.max("newest").alias("newest"))
    )


def combine(parts: DataFrame, late: Lateness = Lateness()) -> DataFrame:
    """The periods on read: counts as first given out and as last corrected, the refused events, the status.

    ``status`` is that of the highest ``sequence_number`` among the counted events, ties going to the
    later ``recorded_at``, then to the greater status; null sequence numbers rank lowest.
    """
    on_time, counted = (F.col("arrival_hour") < h for h in (late.first_hours, late.closed_hours))
    return (
        parts.groupBy(*PERIOD)
        .agg(
            F.sum(F.when(on_time, F.col("events")).otherwise(0)).alias("first_events"),
            F.sum(F.when(counted, F.col("events")).otherwise(0)).alias("events"),
            F.sum(F.when(~counted, F.col("events")).otherwise(0)).alias("refused_events"),
            F.max(F.when(counted, F.col("newest"))).getField("status").alias("status"),
        )
        .select(*PERIOD, "first_events", "events", "refused_events", "status")
    )


def periods(spark: SparkSession, log: DataFrame, late: Lateness = Lateness()) -> DataFrame:
    """All periods of a log that is there as a whole: partials are stored in the shared folder and combined on read."""
    stored = Workspace(spark, "periods").write(partials(fold_copies(readings(log))), "partials")
    return combine(stored, late)


def changed_periods(result: DataFrame) -> DataFrame:
    """The periods whose count changed after it was first given out, from none, too."""
    return result.where("events <> first_events")


class PeriodLedger:
    """The same aggregates, kept up incrementally from arrival batches.

    ``absorb`` folds a batch into the events of periods that are still open; events of a closed period
    are refused, counted and not stored. ``close`` turns open periods whose last moment has passed into
    partials. Absorbing a batch again has no effect, as folding is by minimum and maximum: for a log
    absorbed in any order and any batches before its periods close, ``read`` equals :func:`periods`.

    Under ``path`` lie ``open/<generation>`` (folded events) and ``closed/<day>`` (partials of the periods closed by that
    day). Every step writes a new folder and only then drops the old one, so a lost executor or a failed step leaves
    the former state, and a ledger can be opened again by another session.
    """

    def __init__(self, spark: SparkSession, path: str, late: Lateness = Lateness()):
        self.spark, self.path, self.late = spark, path.rstrip("/"), late
        self._closed = numbered(spark, f"{self.path}/closed")
        self.closed_before_day = max(self._closed, default=0)  # days since the epoch; every earlier day is closed
        self.generation = max(numbered(spark, f"{self.path}/open"), default=0)

    def _open(self) -> DataFrame | None:
        """The folded events of open periods, without those that a step cut short had closed already."""
        if not self.generation:
            return None
        held = self.spark.read.parquet(f"{self.path}/open/{self.generation}")
        return held.where(~F.coalesce(F.col("occurred") < F.lit(self.closed_before_day * 86_400_000_000), F.lit(False)))

    def _swap(self, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/open/{self.generation + 1}")
        remove(self.spark, f"{self.path}/open/{self.generation}")
        self.generation += 1

    def absorb(self, batch: DataFrame) -> int:
        """Fold a batch in; returns how many of its events belong to closed periods and were refused."""
        fresh = fold_copies(readings(batch))
        shut = F.coalesce(F.col("occurred") < F.lit(self.closed_before_day * 86_400_000_000), F.lit(False))
        refused = fresh.where(shut).count()
        fresh, held = fresh.where(~shut), self._open()
        if held is not None:
            fresh = (
                held.unionByName(fresh)
                .groupBy(*EVENT)
                .agg(*(F.min(c).alias(c) for c in ("aggregate_id", "occurred", "recorded")), F.max("newest").alias("newest"))
            )
        self._swap(fresh)
        return refused

    def close(self, now_micros: int) -> None:
        """Close all days whose last moment for changes lies at or before ``now_micros``.

        Of what has no readable ``occurred_at`` yet, events that were recorded before these days ended, or never, are given up: a copy
        that still comes stands for itself. So what is open is never more than the open days.
        """
        day, hour = 86_400_000_000, 3_600_000_000
        before = max(self.closed_before_day, (now_micros - self.late.closed_hours * hour) // day)
        held = self._open()
        if held is None or before == self.closed_before_day:
            return
        done = F.col("occurred") < F.lit(before * day)
        at = f"{self.path}/closed/{before}"
        partials(held.where(done)).write.mode("overwrite").parquet(at)
        self._closed.append(before)
        given_up = F.col("occurred").isNull() & F.coalesce(F.col("recorded") < F.lit(before * day), F.lit(True))
        self._swap(held.where(~F.coalesce(done, F.lit(False)) & ~given_up))
        self.closed_before_day = before

    def read(self) -> DataFrame:
        """All periods, closed and open, combined from partials."""
        held = self._open()
        if held is None:
            raise ValueError("no batch has been absorbed")
        whole = partials(held)
        if self._closed:  # one scan, however many times was closed
            whole = whole.unionByName(self.spark.read.schema(whole.schema).parquet(*(f"{self.path}/closed/{n}" for n in self._closed)))
        return combine(whole, self.late)
