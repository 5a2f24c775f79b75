"""Reading JSON-lines text without losing what cannot be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import Workspace


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, line_no, raw``: the lines of text files with their number in the file, from 1.

    Files are split where they are large. Lines are numbered within their split, and the lines of the splits before it are added; so no task
    holds a file. The lines are written once, as their numbers hang on the splits.
    """
    work = Workspace(spark, "lines")
    split = [F.col("_metadata.file_path").alias("file_name"), F.col("_metadata.file_block_start").alias("start")]
    lines = spark.read.text(path).select(*split, F.regexp_replace("value", "\r$", "").alias("raw"), F.monotonically_increasing_id().alias("m"))
    lines = work.write(lines, "lines")
    # numbers rise within a split, which one task reads from its start to its end
    sizes = lines.groupBy("file_name", "start").agg(F.count(F.lit(1)).alias("n"), F.min("m").alias("first"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("file_name").orderBy("start").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("file_name", "start", "first", before.alias("ahead"))
    return lines.join(sizes, ["file_name", "start"]).select("file_name", (F.col("ahead") + F.col("m") - F.col("first") + 1).alias("line_no"), F.trim("raw").alias("raw"))


def _content(raw: str) -> tuple[Column, Column]:
    """A line without a byte order mark, and whether it holds anything but a comment."""
    t = F.regexp_replace(F.trim(raw), "^\ufeff", "")
    return t, (F.length(t) > 0) & ~t.startswith("#") & ~t.startswith("//")


def parsed(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """``lines`` with the variant ``v`` and ``issue``: null, ``json_decode`` or ``not_object``; blank lines and comments (#, //) are dropped."""
    t, something = _content(raw)
    kept = lines.where(something).withColumn("v", F.try_parse_json(t))
    issue = F.when(F.col("v").isNull(), "json_decode").when(F.is_variant_null("v") | ~F.schema_of_variant("v").startswith("OBJECT"), "not_object")
    return kept.withColumn("issue", issue)


def records(lines: DataFrame) -> DataFrame:
    return parsed(lines).where("issue is null").drop("issue")


def issues(lines: DataFrame) -> DataFrame:
    """``line_no, kind, detail`` of the lines that hold no object, with the file where there is one."""
    keep = [c for c in ("file_name",) if c in lines.columns]
    return parsed(lines).where("issue is not null").select(*keep, "line_no", F.col("issue").alias("kind"), F.col("raw").alias("detail"))


def read_records(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """``v`` of every object, split within files; comments are left out. ``strict`` fails on the first line that is no JSON."""
    lines = spark.read.text(path).withColumnRenamed("value", "raw")
    if strict:
        t, something = _content("raw")
        return lines.where(something).select(F.parse_json(t).alias("v"))
    return records(lines).select("v")


def ingest_summary(lines: DataFrame, shown: int = 8) -> DataFrame:
    """``records, issues, first_issues``: counts and the first issues by line."""
    p = parsed(lines)
    counts = p.agg(F.count_if(F.col("issue").isNull()).alias("records"), F.count_if(F.col("issue").isNotNull()).alias("issues"))
    first = p.where("issue is not null").orderBy("line_no").limit(shown).agg(F.array_sort(F.collect_list(F.struct("line_no", "issue"))).alias("first_issues"))
    return counts.join(F.broadcast(first))  # two tables of one row
