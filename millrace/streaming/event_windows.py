"""Structured Streaming twins: windowed counts with a watermark, checks on every micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.checks import Clause, run_checks


def tumbling_counts(events: DataFrame, time: str, by: Sequence[str], width: str = "1 hour", lateness: str = "10 minutes", value: str | None = None) -> DataFrame:
    """``window_start, by..., n`` (and ``total`` of ``value``) per tumbling window; works on streams and on tables.

    On a stream, rows later than ``lateness`` behind the newest event are dropped and a window is given out when it is closed.
    """
    rows = events.withWatermark(time, lateness) if events.isStreaming else events
    aggs = [F.count(F.lit(1)).alias("n"), *([F.sum(value).alias("total")] if value else [])]
    return rows.groupBy(F.window(time, width).alias("w"), *by).agg(*aggs).select(F.col("w.start").alias("window_start"), *by, "n", *(["total"] if value else []))


def check_stream(stream: DataFrame, clauses: Sequence[Clause], sink: Callable[[DataFrame, int], None], checkpoint: str, **trigger) -> StreamingQuery:
    """Run ``clauses`` on every micro-batch and hand the results with the batch's number to ``sink``.

    A batch may be handed over again after a failure, with the same number; a sink that writes by number is then exactly-once.
    """
    return stream.writeStream.foreachBatch(lambda df, n: sink(run_checks(df, clauses), n)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
