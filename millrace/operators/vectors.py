"""Centroids of vectors and their drift; hashed bags of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.ship import ship


def centroid(df: DataFrame, vector: str) -> DataFrame:
    """``dim, mean``: the mean of each dimension, from 0, over the vectors that reach it; null vectors are left out.

    Vectors are summed up in batches of rows where they lie, so what meets is one row per dimension and batch, not one per dimension and vector.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(0), np.zeros(0, np.int64)
        for b in batches:
            rows = [np.asarray(x, dtype=np.float64) for x in b["v"] if x is not None]
            width = max((len(x) for x in rows), default=0)
            if width > len(total):
                total, n = np.pad(total, (0, width - len(total))), np.pad(n, (0, width - len(n)))
            alike = [x for x in rows if len(x) == width]
            if alike:
                block = np.stack(alike)
                there = ~np.isnan(block)
                total[:width] += np.where(there, block, 0).sum(0)
                n[:width] += there.sum(0)
            for x in rows:
                if len(x) != width:
                    there = ~np.isnan(x)
                    total[: len(x)] += np.where(there, x, 0)
                    n[: len(x)] += there
        if len(total):
            yield pd.DataFrame({"dim": np.arange(len(total), dtype=np.int32), "s": total, "n": n})

    parts = df.select(F.transform(vector, lambda x: x.cast("double")).alias("v")).where("v is not null").mapInPandas(run, "dim int, s double, n bigint")
    return parts.groupBy("dim").agg((F.sum("s") / F.nullif(F.sum("n"), F.lit(0))).alias("mean"))


def cosine_drift(now: DataFrame, base: DataFrame, limit: float = 0.15) -> DataFrame:
    """``drift, status``: 1 minus the cosine of two centroids, to four digits; FAIL above ``limit``. A missing dimension is 0."""
    j = now.select("dim", F.col("mean").alias("a")).join(base.select("dim", F.col("mean").alias("b")), "dim", "full")
    s = j.agg(F.sum(F.coalesce("a", F.lit(0.0)) * F.coalesce("b", F.lit(0.0))).alias("ab"), F.sum(F.col("a") * F.col("a")).alias("aa"), F.sum(F.col("b") * F.col("b")).alias("bb"))
    drift = F.round(1 - F.col("ab") / ((F.sqrt("aa") + 1e-9) * (F.sqrt("bb") + 1e-9)), 4)
    return s.select(drift.alias("drift"), F.when(drift > limit, "FAIL").when(drift.isNull(), "WARN").otherwise("PASS").alias("status"))


def token_buckets(df: DataFrame, text: Column, buckets: int = 384) -> DataFrame:
    """``bucket, n``: how often tokens of two or more letters, digits and underscores of ASCII fall into each md5 bucket."""
    tokens = df.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9_]{2,}"), F.lit(0))).alias("t"))
    bucket = F.conv(F.substring(F.md5("t"), 1, 8), 16, 10).cast("bigint") % buckets
    return tokens.groupBy("t").agg(F.count(F.lit(1)).alias("n")).groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n"))


def murmur3_32(data: bytes, seed: int = 0) -> int:
    """The 32-bit MurmurHash3 of bytes, as a signed number."""
    h, mask = seed, 0xFFFFFFFF
    body = len(data) // 4 * 4
    mix = lambda k: ((k * 0xCC9E2D51 & mask) << 15 | (k * 0xCC9E2D51 & mask) >> 17) * 0x1B873593 & mask
    for i in range(0, body, 4):
        h ^= mix(int.from_bytes(data[i : i + 4], "little"))
        h = ((h << 13 | h >> 19) * 5 + 0xE6546B64) & mask
    if data[body:]:
        h ^= mix(int.from_bytes(data[body:], "little"))
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def hashed_embeddings(df: DataFrame, key: str, text: str, features: int = 384) -> DataFrame:
    """``key, embedding``: signed hashed counts of lower-case words of two or more characters, of length 1.

    The bucket of a word is its MurmurHash3 without sign modulo ``features``, its sign that of the hash. A word is hashed once per batch.
    """
    import re

    ship(df.sparkSession)
    word = re.compile(r"(?u)\b\w\w+\b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            known: dict[str, int] = {}
            out = np.zeros((len(b), features), dtype=np.float64)
            for i, t in enumerate(b[text]):
                for w in word.findall((t or "").lower()):
                    h = known.setdefault(w, None) if w not in known else known[w]
                    if h is None:
                        h = known[w] = murmur3_32(w.encode())
                    out[i, abs(h) % features] += 1 if h >= 0 else -1
            norm = np.linalg.norm(out, axis=1, keepdims=True)
            out = np.divide(out, norm, out=out, where=norm > 0)
            yield pd.DataFrame({key: b[key], "embedding": list(out)})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInPandas(run, f"{key} {kind}, embedding array<double>")
