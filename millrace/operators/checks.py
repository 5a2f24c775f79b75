"""Checks compiled to fused aggregates.

A clause says, for one row, how many violations it holds. All clauses of a table become one aggregate, hence one
scan without shuffle, whose single row of counters is turned into one result row per clause. Nested values are counted
inside their row by higher-order functions. Samples of failing values take a second pass, only where something failed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RESULT = (
    "check_id string, column_name string, check_type string, status string, actual_value string, expected string, "
    "severity string, records_failing bigint, sample_failing array<string>, message string"
)
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW", "WARNING")


@dataclass(frozen=True)
class Clause:
    """``violations``: their number in one row (a boolean counts as 0 or 1; null as 0).

    ``failing`` is the status when there are any; ``only_failing`` leaves the clause out of the results when it
    passes; ``unless`` names a clause whose failure silences this one. ``sample`` is what identifies a failing row.
    """

    check_id: str
    column_name: str
    check_type: str
    violations: Column
    expected: str = ""
    severity: str = "CRITICAL"
    failing: str = "FAIL"
    only_failing: bool = False
    unless: str | None = None
    sample: Column | None = None
    actual: Column | None = field(default=None)  # an aggregate that says what was found


def _number(c: Column) -> Column:
    return F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))


def run_checks(df: DataFrame, clauses: Sequence[Clause]) -> DataFrame:
    """One row per clause over the whole of ``df``, in the columns of :data:`RESULT`; an empty table passes all.

    Two stages at most: partial counters for each partition, then their sum. Samples are left null; see :func:`samples`.
    """
    if len({c.check_id for c in clauses}) < len(clauses):
        raise ValueError("a check_id is used twice")
    numbers = [F.coalesce(F.sum(_number(c.violations)), F.lit(0)).alias(f"n{i}") for i, c in enumerate(clauses)]
    actuals = [(c.actual if c.actual is not None else F.lit(None)).cast("string").alias(f"a{i}") for i, c in enumerate(clauses)]
    totals = df.agg(*numbers, *actuals)
    at = {c.check_id: i for i, c in enumerate(clauses)}
    rows = []
    for i, c in enumerate(clauses):
        n = F.col(f"n{i}")
        shown = n > 0 if c.only_failing else F.lit(True)
        if c.unless:
            shown = shown & (F.col(f"n{at[c.unless]}") == 0)
        bad = n > 0
        rows.append(
            F.when(
                shown,
                F.struct(
                    F.lit(c.check_id).alias("check_id"), F.lit(c.column_name).alias("column_name"), F.lit(c.check_type).alias("check_type"),
                    F.when(bad, c.failing).otherwise("PASS").alias("status"), F.coalesce(F.col(f"a{i}"), F.concat(n.cast("string"), F.lit(" failing"))).alias("actual_value"),
                    F.lit(c.expected).alias("expected"), F.when(bad, c.severity).otherwise("LOW").alias("severity"), n.alias("records_failing"),
                    F.lit(None).cast("array<string>").alias("sample_failing"),
                    F.when(bad, F.concat(n.cast("string"), F.lit(f" violations of {c.check_type} on {c.column_name}"))).otherwise(f"{c.column_name}: {c.check_type} holds").alias("message"),
                ),
            )
        )
    return totals.select(F.inline(F.filter(F.array(*rows), lambda r: r.isNotNull())))


def samples(df: DataFrame, clauses: Sequence[Clause], order: Sequence[Column], most: int = 5) -> DataFrame:
    """``check_id, sample_failing``: the first ``most`` failing rows of each clause with a ``sample``, in ``order``.

    One pass for all clauses: a row gives an entry for each clause it violates, and ranking keeps ``most`` of each clause in every
    task before anything is shuffled.
    """
    with_sample = [c for c in clauses if c.sample is not None]
    if not with_sample:
        raise ValueError("no clause has a sample")
    entries = F.array(*(F.when(_number(c.violations) > 0, F.struct(F.lit(i).alias("i"), c.sample.cast("string").alias("v"))) for i, c in enumerate(with_sample)))
    keys = [k.alias(f"o{i}") for i, k in enumerate(order)]
    failing = df.select(*keys, F.inline(F.filter(entries, lambda e: e.isNotNull())))
    rank = F.row_number().over(W.partitionBy("i").orderBy(*(f"o{i}" for i in range(len(keys)))))
    top = failing.withColumn("r", rank).where(F.col("r") <= most)  # at most so many of each clause leave a task
    found = top.groupBy("i").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "v"))), lambda x: x["v"]).alias("s"))
    names = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(c.check_id).alias("check_id")) for i, c in enumerate(with_sample)))
    ids = df.sparkSession.range(1).select(F.inline(names))
    none = F.array().cast("array<string>")
    return ids.join(found, "i", "left").select("check_id", F.coalesce("s", none).alias("sample_failing"))


def with_samples(spark: SparkSession, df: DataFrame, clauses: Sequence[Clause], order: Sequence[Column], most: int = 5) -> DataFrame:
    """Results with samples; the second pass reads only for the clauses that failed."""
    results = run_checks(df, clauses).collect()  # one row per clause
    failed = {r.check_id for r in results if r.records_failing}
    again = [c for c in clauses if c.check_id in failed and c.sample is not None]
    found = {r.check_id: r.sample_failing for r in samples(df, again, order, most).collect()} if again else {}
    rows = [tuple(found.get(r.check_id, []) if k == "sample_failing" else v for k, v in r.asDict().items()) for r in results]
    return spark.createDataFrame(rows, RESULT)


def ingest_results(issues: DataFrame, prefix: str = "runner.jsonl.line_") -> DataFrame:
    """Lines that could not be read, as results: one ERROR of severity HIGH for each."""
    return issues.select(
        F.concat(F.lit(prefix), F.col("line_no").cast("string")).alias("check_id"), F.lit("line").alias("column_name"), F.lit("ingest").alias("check_type"),
        F.lit("ERROR").alias("status"), F.col("kind").alias("actual_value"), F.lit("a JSON object").alias("expected"), F.lit("HIGH").alias("severity"),
        F.lit(1).cast("bigint").alias("records_failing"), F.array(F.left(F.col("detail"), F.lit(200))).alias("sample_failing"), F.concat(F.lit("unreadable line: "), F.col("kind")).alias("message"),
    )


def summary(results: DataFrame) -> DataFrame:
    """Counts of results by status, one row."""
    count = lambda s: F.count_if(F.col("status") == s).alias({"PASS": "passed", "WARN": "warned", "FAIL": "failed", "ERROR": "errored"}[s])
    return results.agg(F.count(F.lit(1)).alias("total_checks"), *(count(s) for s in ("PASS", "WARN", "FAIL", "ERROR")))


def blocks(results: DataFrame, mode: str) -> bool:
    """Whether a pipeline must stop: AUDIT never, WARN on critical failures, ENFORCE on critical and high ones; errors never."""
    severities = {"AUDIT": [], "WARN": ["CRITICAL"], "ENFORCE": ["CRITICAL", "HIGH"]}[mode]
    return bool(severities) and results.where((F.col("status") == "FAIL") & F.col("severity").isin(severities)).limit(1).count() > 0
