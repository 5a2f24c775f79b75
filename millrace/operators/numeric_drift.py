"""Numeric profiles and drift of means against a stored baseline."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import Workspace

QUANTILES = (0.25, 0.5, 0.75, 0.95, 0.99)


def numeric_profile(df: DataFrame, value: Column, by: list[str] | None = None) -> DataFrame:
    """``n, min, max, mean, stddev, p25 ... p99`` of the non-null values: exact, quantiles interpolated, population deviation.

    Values are counted, sorted by ranges and written; a quantile is looked up in the one part that holds its rank, by the totals of the parts
    before it. So no task holds a group, however many different values it has. An empty group has no row, an empty
    table one row of nulls and ``n`` 0.
    """
    work = Workspace(df.sparkSession, "profile")
    # a struct is never null, so groups of null keys meet like any other
    rows = df.select(F.struct(*(by or [F.lit(0).alias("all")])).alias("g"), value.cast("double").alias("v")).where("v is not null")
    counts = rows.groupBy("g", "v").agg(F.count(F.lit(1)).alias("k"))
    counts = work.write(counts.repartitionByRange("g", "v").withColumn("part", F.spark_partition_id()), "counts")
    sums = counts.groupBy("g").agg(F.sum("k").alias("n"), F.min("v").alias("min"), F.max("v").alias("max"), (F.sum(F.col("v") * F.col("k")) / F.sum("k")).alias("mean"))
    sums = work.write(sums, "sums")
    near = counts.join(sums.select("g", "mean"), "g")
    spread = near.groupBy("g").agg(F.sqrt(F.sum(F.pow(F.col("v") - F.col("mean"), 2) * F.col("k")) / F.sum("k")).alias("stddev"))
    before = W.partitionBy("g").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = counts.groupBy("g", "part").agg(F.sum("k").alias("here")).withColumn("ahead", F.coalesce(F.sum("here").over(before), F.lit(0)))
    at = [F.lit(q) * (F.col("n") - 1) for q in QUANTILES]
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(a), F.ceil(a)) for a in at))))
    placed = parts.join(sums.select("g", F.explode(ranks).alias("rank")), "g").where("rank >= ahead and rank < ahead + here").select("g", "part", "ahead", "rank")
    placed = work.write(placed, "placed")
    held = counts.join(placed.select("g", "part").distinct(), ["g", "part"], "left_semi")
    upto = W.partitionBy("g", "part").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    inside = held.withColumn("upto", F.sum("k").over(upto)).join(placed, ["g", "part"]).where("rank >= ahead + upto - k and rank < ahead + upto")
    found = inside.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))  # ten ranks at most
    pick = lambda r: F.try_element_at("at", r.cast("bigint"))
    quantiles = [(pick(F.floor(a)) + (a - F.floor(a)) * (pick(F.ceil(a)) - pick(F.floor(a)))).alias(f"p{round(q * 100)}") for a, q in zip(at, QUANTILES, strict=True)]
    out = sums.join(spread, "g").join(found, "g").select(*(F.col(f"g.{c}").alias(c) for c in by or []), "n", "min", "max", "mean", "stddev", *quantiles)
    return out if by else _one_row(out)


def _one_row(one: DataFrame) -> DataFrame:
    """The row of a table of at most one, or a row of nulls with ``n`` 0."""
    return one.agg(*(F.max(c).alias(c) for c in one.columns)).withColumn("n", F.coalesce("n", F.lit(0)))


def mean_drift(batch: DataFrame, baseline: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, mean, std, sigma, status, severity`` of each batch row (``keys, mean, std``) against ``baseline`` (the same columns).

    Further columns of the batch are kept.

    Distance of the means in deviations of the baseline's values: above 3 FAIL/HIGH, above 2 WARN/MEDIUM, else PASS/LOW.
    Without a baseline PASS/LOW and sigma null; one without a number is ERROR/LOW. A batch without values has mean 0.
    """
    base = baseline.select(*keys, F.col("mean").alias("base_mean"), F.col("std").alias("base_std"), F.lit(True).alias("known"))
    j = batch.withColumns({"mean": F.coalesce("mean", F.lit(0.0)), "std": F.coalesce("std", F.lit(0.0))}).join(base, keys, "left")
    sigma = F.abs(F.col("mean") - F.col("base_mean")) / F.greatest("base_std", F.lit(1e-9))
    broken = F.col("known") & (F.col("base_mean").isNull() | F.col("base_std").isNull())
    status = F.when(broken, "ERROR").when(sigma > 3, "FAIL").when(sigma > 2, "WARN").otherwise("PASS")
    severity = F.when(sigma > 3, "HIGH").when(sigma > 2, "MEDIUM").otherwise("LOW")
    others = [c for c in batch.columns if c not in (*keys, "mean", "std")]
    return j.select(*keys, *others, "mean", "std", F.when(~F.coalesce(broken, F.lit(False)), sigma).alias("sigma"), status.alias("status"), severity.alias("severity"))


class Baselines:
    """Means and deviations by key in a small JSON file of the driver; missing, unreadable or not an object reads as empty."""

    def __init__(self, path: str):
        self.path = Path(path)

    def load(self) -> dict[str, dict]:
        try:
            value = json.loads(self.path.read_text())
        except (OSError, ValueError):
            return {}
        return value if isinstance(value, dict) else {}

    def _save(self, entries: dict[str, dict]) -> None:
        self.path.parent.mkdir(parents=True, exist_ok=True)
        part = self.path.with_suffix(".part")
        part.write_text(json.dumps(entries, indent=2))
        os.replace(part, self.path)

    def establish(self, entries: dict[str, tuple[float, float]]) -> None:
        """Store what has no baseline yet; what has one stays."""
        held = self.load()
        self._save({k: {"mean": m, "std": max(s, 1e-9)} for k, (m, s) in entries.items()} | held)

    def upsert(self, entries: dict[str, tuple[float, float]]) -> None:
        """Replace baselines, rounded to eight digits."""
        self._save(self.load() | {k: {"mean": round(m, 8), "std": round(max(s, 1e-9), 8)} for k, (m, s) in entries.items()})

    def frame(self, spark: SparkSession) -> DataFrame:
        number = lambda x: float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else None
        rows = [(k, number(v.get("mean")) if isinstance(v, dict) else None, number(v.get("std", v.get("stddev"))) if isinstance(v, dict) else None) for k, v in self.load().items()]
        return spark.createDataFrame(rows, "key string, mean double, std double")


# Bounds within which numbers look like shares, and how near an end their mean is suspicious.
SHARE, MARGIN = (-0.001, 1.001), 0.05


def unit_interval_notes(profile: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Rows of a profile whose values look like shares of 0 to 1 but whose mean hugs an end."""
    unit = (F.col("min") >= SHARE[0]) & (F.col("max") <= SHARE[1])
    note = F.when(F.col("mean") <= margin, "mean near 0").when(F.col("mean") >= 1 - margin, "mean near 1")
    return profile.where(unit).withColumn("note", note).where("note is not null")


def counted_trend(df: DataFrame, bad: Column, baseline: float, multiplier: float = 1.5, least: float = 0.001) -> DataFrame:
    """``n, failures, rate, trend, status``: rising and WARN if the rate is above ``multiplier`` times the baseline and above it by ``least``."""
    one = df.agg(F.count_if(bad).alias("failures"), F.count(F.lit(1)).alias("n"))
    rate = F.col("failures") / F.greatest("n", F.lit(1))
    up = (rate > baseline * multiplier) & (rate > baseline + least)
    return one.select("n", "failures", rate.alias("rate"), F.when(up, "rising").otherwise("stable").alias("trend"), F.when(up, "WARN").otherwise("PASS").alias("status"))


def rate_trend(df: DataFrame, bad: Column, baseline: float) -> DataFrame:
    """``failures, rate, trend, status``, as of :func:`counted_trend`."""
    return counted_trend(df, bad, baseline).drop("n")
