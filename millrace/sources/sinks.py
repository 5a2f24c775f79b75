"""Writing reports, logs and quarantined records."""

from __future__ import annotations

import hashlib
import json
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import exists


def write_report(results: DataFrame, summary: DataFrame, path: str) -> None:
    """One JSON document on the driver: the summary and a result for each check. The file is replaced as a whole."""
    document = summary.first().asDict() | {"results": [r.asDict(recursive=True) for r in results.collect()]}
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_suffix(".part")
    part.write_text(json.dumps(document, indent=2, default=str))
    os.replace(part, target)


def append_new(spark: SparkSession, rows: DataFrame, path: str, keys: list[str]) -> int:
    """Append to a JSON log the rows whose ``keys`` it does not hold yet, nulls being equal; returns their number.

    Repeats within ``rows`` are appended once. One anti-join for all rows, whatever their number.
    """
    fresh = rows.dropDuplicates(keys)
    if exists(spark, path):
        held = spark.read.schema(rows.schema).json(path).select(*keys).distinct()
        same = [F.col(f"n.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
        fresh = fresh.alias("n").join(held.alias("h"), same, "left_anti")
    fresh = fresh.cache()
    try:
        n = fresh.count()
        if n:
            fresh.write.mode("append").json(path)
    finally:
        fresh.unpersist()
    return n


def quarantine(df: DataFrame, valid: Column, path: str) -> DataFrame:
    """Write the rows that are not ``valid`` as JSON, if there are any, and return the others."""
    good = F.coalesce(valid, F.lit(False))
    bad = df.where(~good)
    if bad.limit(1).count():
        bad.write.mode("overwrite").json(path)
    return df.where(good)


def write_jsonl(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines, in as many files as there are parts; what was there is replaced."""
    rows.write.mode("overwrite").json(path)


def write_manifest(spark: SparkSession, patterns: dict[str, str], path: str) -> dict:
    """The digests of the files of each named input as a document; they are computed where the files are read."""
    document = {name: {r.file_name: r.sha256 for r in file_digests(spark, pattern).collect()} for name, pattern in patterns.items()}  # one row for each file
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(json.dumps(document, indent=2, sort_keys=True))
    return document


def file_digest(path: str) -> str:
    """The SHA-256 of a file of the driver, read in pieces."""
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while piece := f.read(1 << 16):
            h.update(piece)
    return h.hexdigest()


def file_digests(spark: SparkSession, pattern: str) -> DataFrame:
    """``file_name, sha256`` of files small enough for a row."""
    return spark.read.format("binaryFile").load(pattern).select(F.col("path").alias("file_name"), F.sha2("content", 256).alias("sha256"))
