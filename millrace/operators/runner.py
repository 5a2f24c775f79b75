"""Whole validations of a dataset: unreadable lines, required fields, checks, drift and references across datasets, as one table of results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as p
from ..functions.paths import plain_path
from ..sources import json_lines
from . import checks, datasets, json_schema, matching, numeric_drift
from .checks import Clause


@dataclass(frozen=True)
class Metric:
    """Numbers of a dataset whose mean is watched: ``values`` is an array in each row. A metric that is ``optional`` has no result without values."""

    check_id: str
    column_name: str
    values: Column
    optional: bool = False


def _numbers(*values: Column) -> Column:
    return F.filter(F.array(*(v.cast("double") for v in values)), lambda v: v.isNotNull())


def _inside(array: str, field: str) -> Column:
    return F.filter(F.transform(F.col(array), lambda e: e[field].cast("double")), lambda v: v.isNotNull())


def metrics(dataset: str) -> list[Metric]:
    """The watched numbers of a dataset; of verdicts only confidences within 0 to 1 count."""
    if dataset == "intents":
        return [Metric("week1.code_refs.confidence", "code_refs.confidence", _inside("code_refs", "confidence"))]
    if dataset == "verdicts":
        return [Metric("week2.confidence", "confidence", F.when(p.in_unit_interval(F.col("confidence")), _numbers(F.col("confidence"))))]
    if dataset == "extractions":
        return [
            Metric("week3.extracted_facts.confidence", "extracted_facts.confidence", _inside("extracted_facts", "confidence")),
            Metric("week3.processing_time_ms", "processing_time_ms", _numbers(F.col("processing_time_ms"))),
        ]
    if dataset == "events":
        return [Metric("week5.payload.bytes", "payload.bytes", _numbers(F.col("payload.bytes")), optional=True)]
    return []


def baseline_key(contract_id: str, column_name: str) -> str:
    return f"{contract_id}::{column_name}.mean"


def drift_results(df: DataFrame, watched: Sequence[Metric], baselines: DataFrame, contract_id: str) -> DataFrame:
    """A result for each metric: ``<id>.drift_baseline`` where none is held yet, else ``<id>.statistical_drift``.

    ``baselines`` has ``key, mean, std``; see :class:`numeric_drift.Baselines`. One pass for all metrics. Without values the mean is 0.
    """
    spark = df.sparkSession

    def numbered(i: int, values: Column) -> Column:
        return F.transform(values, lambda x: F.struct(F.lit(i).alias("i"), x.alias("x")))

    entries = F.flatten(F.filter(F.array(*(numbered(i, m.values) for i, m in enumerate(watched))), lambda a: a.isNotNull()))
    batch = df.select(F.inline(entries)).groupBy("i").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.count(F.lit(1)).alias("n"))
    names = [(i, m.check_id, m.column_name, m.optional, baseline_key(contract_id, m.column_name)) for i, m in enumerate(watched)]
    named = spark.createDataFrame(names, "i int, check_id string, column_name string, optional boolean, key string")
    rows = named.join(batch, "i", "left").where("not optional or n > 0")
    held = baselines.select("key", F.lit(True).alias("held"))
    d = numeric_drift.mean_drift(rows.select("key", "mean", "std", "check_id", "column_name"), baselines, ["key"]).join(held, "key", "left")
    known = F.coalesce("held", F.lit(False))
    sigma = F.coalesce(F.format_string("%.2f deviations", F.col("sigma")), F.lit("no number held"))
    what = F.when(~known, "baseline set").when(F.col("status") == "ERROR", "the baseline is no number").otherwise(sigma)
    return d.select(
        F.concat("check_id", F.when(known, ".statistical_drift").otherwise(".drift_baseline")).alias("check_id"), "column_name", F.lit("drift").alias("check_type"), "status",
        F.format_string("mean=%.4f", F.col("mean")).alias("actual_value"), F.lit("within 2 deviations of the baseline").alias("expected"), "severity",
        F.when(F.col("status").isin("FAIL", "WARN", "ERROR"), 1).otherwise(0).cast("bigint").alias("records_failing"), F.lit(None).cast("array<string>").alias("sample_failing"), what.alias("message"),
    )


def settle_baselines(results: DataFrame, df: DataFrame, watched: Sequence[Metric], contract_id: str, store: numeric_drift.Baselines) -> None:
    """Store the means and deviations of metrics that have none yet."""
    entries = {}
    for m in watched:  # one or two for a dataset
        one = df.select(F.explode(m.values).alias("x")).agg(F.coalesce(F.avg("x"), F.lit(0.0)).alias("m"), F.coalesce(F.stddev_pop("x"), F.lit(0.0)).alias("s")).first()
        entries[baseline_key(contract_id, m.column_name)] = (one.m, one.s)
    store.establish(entries)


def empty_result(df: DataFrame) -> DataFrame:
    """A failing result if there is no snapshot at all, else none."""
    return checks.run_checks(df.agg(F.count(F.lit(1)).alias("n")), [Clause("week4.snapshot.non_empty", "*", "required", F.col("n") == 0, "one snapshot at least", only_failing=True)])


def missing_files_result(df: DataFrame, inventory: DataFrame, array: str = "code_refs", field: str = "file", check_id: str = "week1.code_refs.file.exists") -> DataFrame:
    """References to files that are not in ``inventory`` (``path``), each use counted; blank ones do not count."""
    uses = df.select(F.explode(F.transform(array, lambda e: plain_path(e[field]))).alias("path")).where(F.length("path") > 0)
    # a file is looked up once, however often it is named
    uses = uses.groupBy("path").agg(F.count(F.lit(1)).alias("uses"))
    lost = matching.missing_references(uses, F.col("path"), inventory.select(plain_path(F.col("path")).alias("path")), "path")
    total = lost.agg(F.coalesce(F.sum("uses"), F.lit(0)).alias("n"))
    return checks.run_checks(total, [Clause(check_id, f"{array}.{field}", "file_exists", F.col("n"), "a file of the project")])


def payload_result(df: DataFrame, schema: dict | None, event_type: str, check_id: str = "week5.payload.jsonschema") -> DataFrame:
    """Payloads of one type of events against its schema; a missing payload fails. Without a schema the check cannot run: an error of low severity."""
    if schema is None:
        return df.sparkSession.createDataFrame([(check_id, "payload", "jsonschema", "ERROR", "no schema", "a schema", "LOW", 0, [], "the schema is missing")], checks.RESULT)
    bad = (F.col("event_type") == event_type) & ~json_schema.column_valid(df, "payload", schema)
    return checks.run_checks(df, [Clause(check_id, "payload", "jsonschema", bad, f"the schema of {event_type}", sample=F.col("event_id"))])


def rubric_result(df: DataFrame, digest: str | None) -> DataFrame:
    """Whether all verdicts name the rubric's digest; without the rubric an error of low severity."""
    if digest is None:
        return df.sparkSession.createDataFrame([("week2.rubric_id.sha256", "rubric_id", "hash", "ERROR", "no rubric", "a rubric", "LOW", 0, [], "the rubric is missing")], checks.RESULT)
    return checks.run_checks(df, [c for c in datasets.verdicts(digest) if c.check_id == "week2.rubric_id.sha256"])


def _counted(lost: DataFrame, clause: Clause) -> DataFrame:
    return checks.run_checks(lost.agg(F.count(F.lit(1)).alias("n")), [clause])


def cross_results(intents: DataFrame, verdicts: DataFrame, extractions: DataFrame, snapshots: DataFrame, issues: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """References between datasets, as results: targets of verdicts that no intent names, documents that are no node of the last snapshot; and the unreadable lines of each dataset."""
    files = intents.select(F.explode("code_refs.file").alias("file"))
    targets = matching.missing_references(verdicts.select("target_ref"), F.coalesce("target_ref", F.lit("None")), files, "file")
    nodes = datasets.latest_snapshot(snapshots).select(F.explode("nodes.node_id").alias("node_id"))
    ids = extractions.select("doc_id").where("doc_id is not null").distinct()
    documents = matching.missing_references(ids, F.concat(F.lit("table::doc:"), F.col("doc_id")), nodes, "node_id")
    parts = [
        _counted(targets, Clause("cross.week2.target_ref.in_week1_code_refs", "target_ref", "relationship", F.col("n"), "a file that an intent names")),
        _counted(documents, Clause("cross.week4.doc_id.as_lineage_node", "doc_id", "relationship", F.col("n"), "a node of the last snapshot")),
    ]
    parts += [checks.ingest_results(rows, f"cross.ingest.{name}.line_") for name, rows in (issues or {}).items()]
    return reduce(DataFrame.unionByName, parts)


def run_validation(
    spark: SparkSession, dataset: str, df: DataFrame, *, contract_id: str | None = None, lines: DataFrame | None = None, required: Sequence[str] = (), order: str | None = None,
    first: int | None = None, baselines: DataFrame | None = None, payload_schema: dict | None = None, event_type: str = "DocumentProcessed", rubric: str | None = None, inventory: DataFrame | None = None,
) -> DataFrame:
    """All results of one dataset: unreadable ``lines``, required fields (of all rows, or the ``first`` in ``order``), its checks, and drift against ``baselines``.

    A dataset that is not known has the one result that says so. Snapshots are checked as they are given; take the last with :func:`datasets.latest_snapshot`.
    """
    contract_id = contract_id or dataset
    parts = [checks.ingest_results(json_lines.issues(lines))] if lines is not None else []
    if required:
        parts.append(datasets.required_result(df, list(required), order or df.columns[0], first))
    if dataset not in ("intents", "verdicts", "extractions", "snapshots", "events", "runs"):
        return reduce(DataFrame.unionByName, [*parts, datasets.unsupported_result(spark, contract_id)])
    parts.append(checks.run_checks(df, getattr(datasets, dataset)()))
    if dataset == "snapshots":
        parts.append(empty_result(df))
    if dataset == "intents" and inventory is not None:
        parts.append(missing_files_result(df, inventory))
    if dataset == "verdicts":
        parts.append(rubric_result(df, rubric))
    if dataset == "extractions":
        parts.append(datasets.unique_result(df, "doc_id", "week3.doc_id.unique"))
    if dataset == "events":
        parts += [payload_result(df, payload_schema, event_type), datasets.sequence_result(df, "aggregate_id", "sequence_number", "event_id", "week5.sequence_number.monotonic")]
    if (watched := metrics(dataset)) and baselines is not None:
        parts.append(drift_results(df, watched, baselines, contract_id))
    return reduce(DataFrame.unionByName, parts)


def type_anomalies(records: DataFrame, variant: str, kinds: Mapping[str, Sequence[str]]) -> DataFrame:
    """``path, anomalies``: how many values of text records are there but of no kind wanted. ``a[*].b`` goes through an array.

    ``kinds`` maps a path to kinds of ``schema_of_variant``: BIGINT, DECIMAL, DOUBLE, STRING, BOOLEAN, ARRAY, OBJECT. Nulls do not count.
    """

    def is_wrong(v: Column, wanted: Sequence[str]) -> Column:
        return v.isNotNull() & ~F.is_variant_null(v) & ~F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0).isin(*wanted)

    def count(path: str, wanted: Sequence[str]) -> Column:
        head, star, tail = path.partition("[*]")
        if not star:
            return is_wrong(F.try_variant_get(variant, f"$.{path}", "variant"), wanted).cast("int")
        parts = F.transform(F.try_variant_get(variant, f"$.{head}", "array<variant>"), lambda e: F.try_variant_get(e, f"${tail}", "variant"))
        return F.coalesce(F.size(F.filter(parts, lambda v: is_wrong(v, wanted))), F.lit(0))

    wrong = [F.coalesce(F.sum(count(path, wanted)), F.lit(0)).alias(f"n{i}") for i, (path, wanted) in enumerate(kinds.items())]
    one = records.agg(*wrong)
    rows = [F.struct(F.lit(path).alias("path"), F.col(f"n{i}").alias("anomalies")) for i, path in enumerate(kinds)]
    return one.select(F.inline(F.array(*rows)))
