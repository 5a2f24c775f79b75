"""Rolling results up into a report: worst failure of each check, score, priorities, pages."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import exists
from .matching import longest_prefix

# What a failing check takes from a score of 100, and the order of severities.
DEDUCTIONS = {"CRITICAL": 20.0, "HIGH": 10.0, "MEDIUM": 5.0, "LOW": 1.0, "WARNING": 1.0}
_RANKS = {s: i for i, s in enumerate(DEDUCTIONS)}


def _by_severity(values: dict, default) -> Column:
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in values.items() for x in kv)), F.col("severity")), F.lit(default))


def severity_rank(default: int = 99) -> Column:
    return _by_severity(_RANKS, default)


def worst_failures(results: DataFrame, order: list[str]) -> DataFrame:
    """The worst failing result of each ``check_id``, ties to the first in ``order``. Rows of one check meet; pre-aggregated by minimum."""
    failing = results.where(F.col("status").isin("FAIL", "ERROR"))
    rest = [c for c in failing.columns if c not in order]
    best = failing.groupBy("check_id").agg(F.min(F.struct(severity_rank().alias("_r"), *(F.col(c) for c in order if c != "check_id"), *(F.col(c) for c in rest if c != "check_id"))).alias("b"))
    return best.select("check_id", "b.*").drop("_r").select(*failing.columns)


def health_score(worst: DataFrame, weight: str | None = None) -> DataFrame:
    """``failing, score``: 100 less the weighted deductions of failing checks, kept within 0 to 100, to two digits."""
    w = F.col(weight) if weight else F.lit(1.0)
    lost = F.coalesce(F.sum(_by_severity(DEDUCTIONS, 1.0) * w), F.lit(0.0))
    return worst.agg(F.count(F.lit(1)).alias("failing"), F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.round(100 - lost, 2))).alias("score"))


def severity_counts(results: DataFrame) -> DataFrame:
    return results.where(F.col("status").isin("FAIL", "ERROR")).groupBy("severity").agg(F.count(F.lit(1)).alias("n"))


def pass_rate(results: DataFrame) -> DataFrame:
    return results.agg(F.round(100 * F.count_if(F.col("status") == "PASS") / F.greatest(F.lit(1), F.count(F.lit(1))), 2).alias("pass_rate"))


def prioritized(violations: DataFrame) -> DataFrame:
    """Violations by severity, then most failing rows; of one ``check_id`` and ``column_name`` only the first. ``position`` counts from 1."""
    key = ["check_id", "column_name"]
    first = violations.groupBy(*key).agg(F.min(F.struct(severity_rank().alias("r"), (-F.col("records_failing")).alias("m"), "severity")).alias("b"))
    first = first.select(*key, "b.severity", (-F.col("b.m")).alias("records_failing"), F.col("b.r").alias("r"))
    # a report has one row for each check and column, however large the data
    return first.withColumn("position", F.row_number().over(W.orderBy("r", F.desc("records_failing"), *key)).cast("bigint")).drop("r")


def normalized(log: DataFrame, results: DataFrame) -> DataFrame:
    """Violations of two sources in one form: ``check_id, field, severity, type, message, records_failing``.

    ``log`` has ``check_id, type, severity, message, records_failing, blame_hint``; its field is the hinted file, for structured outputs the record as such, which is
    always critical. ``results`` are results of checks, of which the failing ones count; their field is the column. What is missing is ``*``, LOW, 0 or blank.
    """
    text = lambda c, v: F.coalesce(F.nullif(c, F.lit("")), F.lit(v))
    output = F.coalesce(F.col("type") == "llm_output_schema", F.lit(False))
    number = F.coalesce(F.col("records_failing").cast("bigint"), F.lit(0))
    first = log.where("check_id is not null").select(
        "check_id", F.when(output, "verdict_record").otherwise(text(F.col("blame_hint.file"), "*")).alias("field"), F.when(output, "CRITICAL").otherwise(text(F.col("severity"), "MEDIUM")).alias("severity"),
        text(F.col("type"), "contract_violation").alias("type"), F.coalesce("message", F.lit("")).alias("message"), number.alias("records_failing"),
    )
    failing = results.where(F.col("status").isin("FAIL", "ERROR")).select(
        "check_id", text(F.col("column_name"), "*").alias("field"), text(F.col("severity"), "HIGH").alias("severity"), F.lit("check").alias("type"), F.coalesce("message", F.lit("")).alias("message"), number.alias("records_failing")
    )
    return first.unionByName(failing)


def two_source_priorities(log: DataFrame, results: DataFrame) -> DataFrame:
    """Violations of a log and of results by severity, then most failing rows, check and field; of one check and field only the first. ``position`` counts from 1."""
    rows = normalized(log, results)
    order = F.struct(severity_rank().alias("r"), (-F.col("records_failing")).alias("m"), "type", "message", "severity")
    first = rows.groupBy("check_id", "field").agg(F.min(order).alias("b"))
    first = first.select("check_id", "field", "b.severity", "b.type", "b.message", (-F.col("b.m")).alias("records_failing"), F.col("b.r").alias("r"))
    # one row for each check and field; of logs whose field is a file they are as many as files fail
    return first.withColumn("position", F.row_number().over(W.orderBy("r", F.desc("records_failing"), "check_id", "field")).cast("bigint")).drop("r")


def top_violations(rows: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` first by severity, ties by the number of failing rows, check and field: a top-k, nothing is sorted as a whole."""
    return rows.orderBy(severity_rank(), F.desc("records_failing"), "check_id", "field").limit(n)


def in_words(results: DataFrame, subscribers: DataFrame) -> DataFrame:
    """``check_id, text``: each failing result as a sentence with who depends on it; ``subscribers`` has ``check_id, names``."""
    told = results.where(F.col("status").isin("FAIL", "ERROR")).join(subscribers, "check_id", "left")
    text = F.format_string(
        "%s of %s does not hold: expected %s, found %s; %s rows. Concerns %s.", "check_type", "column_name", F.coalesce("expected", F.lit("what the contract says")), F.coalesce("actual_value", F.lit("see the report")),
        F.coalesce(F.col("records_failing").cast("string"), F.lit("an unknown number of")), F.coalesce(F.nullif("names", F.lit("")), F.lit("nobody registered")),
    )
    return told.select("check_id", text.alias("text"))


def merged_weights(*layers: dict | None) -> dict[str, float]:
    """Weights by prefix, later layers over earlier ones; what is no number, truth values too, is left out. ``default`` is 1 if none gives it."""
    out: dict[str, float] = {}
    for layer in layers:
        out |= {k: float(v) for k, v in (layer or {}).items() if isinstance(k, str) and isinstance(v, (int, float)) and not isinstance(v, bool)}
    return {"default": 1.0} | out


def resolve_weights(defaults: dict[str, float], file: str | None = None, environment: dict[str, str] | None = None, name: str = "REPORT_WEIGHTS", given: dict[str, float] | None = None) -> dict[str, float]:
    """Weights from defaults, a JSON file, the JSON of an environment variable and what is given, in this order; what cannot be read is left out."""
    def read(text: str | None) -> dict | None:
        try:
            value = json.loads(text) if text else None
        except ValueError:
            return None
        return value if isinstance(value, dict) else None

    try:
        held = Path(file).read_text() if file else None
    except OSError:
        held = None
    return merged_weights(defaults, read(held), read((os.environ if environment is None else environment).get(name)), given)


def weighted(worst: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``worst`` with the ``weight`` of the longest prefix of its check; ``default`` where there is none."""
    rows = [(k, v) for k, v in weights.items() if k != "default"]
    table = worst.sparkSession.createDataFrame([*rows, ("", weights.get("default", 1.0))], "prefix string, weight double")
    return longest_prefix(worst, "check_id", table)


def actions(rows: DataFrame, most: int = 3) -> list[dict]:
    """At most ``most`` things to do, the most severe first: one for each family of checks, from the violations as of :func:`two_source_priorities`."""
    family = F.regexp_extract("check_id", r"^([a-z]+[0-9]*)", 1)
    best = rows.groupBy(family.alias("family")).agg(F.min(F.struct(severity_rank().alias("r"), (-F.col("records_failing")).alias("m"), "check_id", "field", "severity")).alias("b"))
    top = best.orderBy("b.r", "b.m", "family").limit(most).collect()
    return [{"priority": i + 1, "severity": r.b.severity, "check_id": r.b.check_id, "action": f"Mend {r.b.field} at its source, then run {r.b.check_id} again: {-r.b.m} rows fail."} for i, r in enumerate(top)]


def generate_report(results: DataFrame, log: DataFrame, *, weights: dict[str, float] | None = None, number: int = 1, size: int = 10, migration: dict | None = None, schema_changes: list[str] | None = None) -> dict:
    """A whole report as a document: score, counts, pass rate, the three worst, a page of violations by priority, what to do, and the last schema change.

    What reaches the driver is a row for each severity, the page and the actions.
    """
    spark = results.sparkSession
    # results have a row for each check; kept, as they are read several times
    results = spark.createDataFrame(results.collect(), results.schema)
    worst = worst_failures(results.select("check_id", "column_name", "check_type", "status", "severity", "records_failing"), ["records_failing"])
    score = health_score(weighted(worst, weights or {"default": 1.0}), "weight").first()
    rows = two_source_priorities(log, results)
    shown = page(rows, number, size)
    pages = rows.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(size)))).first()[0]
    bullets, summary = migration_summary(migration) if migration else ([], None)
    return {
        "data_health_score": score.score, "failing_checks": score.failing, "pass_rate": pass_rate(results).first()[0], "by_severity": {r.severity: r.n for r in severity_counts(results).collect()},
        "top_violations": [r.asDict() for r in top_violations(rows).collect()], "violations": {"page": number, "page_size": size, "total_pages": int(pages), "rows": [r.asDict() for r in shown.drop("total_pages").orderBy("position").collect()]},
        "recommended_actions": actions(rows), "schema_changes": [*bullets, *(schema_changes or [])], "migration": summary,
    }


def migration_summary(document: dict, bullets: int = 14) -> tuple[list[str], dict]:
    """A stored migration report as lines, at most ``bullets``, and as a summary; parts that are missing or of another form are empty."""
    inner = document.get("migration_impact") if isinstance(document.get("migration_impact"), dict) else {}
    part = lambda name, kind: v if isinstance(v := inner.get(name) or document.get(name), kind) else kind()
    name, breaking, plan, tasks = str(document.get("contract_id") or "contract"), part("breaking_fields", list), part("rollback_plan", str), part("migration_checklist", list)
    outcome = part("compatibility_verdict", str) or "UNKNOWN"
    lines = [f"{name}: {outcome}"] + [f"{name}: {f} breaks" for f in breaking[:10] if isinstance(f, str) and f.strip()]
    lines += [f"{name}: to do: {t['task']}" for t in tasks[:6] if isinstance(t, dict) and str(t.get("task", "")).strip()] + ([f"{name}: way back: {plan[:280]}"] if plan else [])
    return lines[:bullets], {"contract_id": document.get("contract_id"), "compatibility_verdict": outcome, "breaking_fields": breaking, "rollback_plan": plan, "checklist": tasks[:8]}


def type_changes(changes: DataFrame, most: int = 5) -> list[str]:
    """Changes of type between the last versions of contracts, at most ``most``, in order; from rows as of :func:`contract_diff.diff`."""
    last = changes.groupBy("contract_id").agg(F.max("version").alias("version"))
    rows = changes.join(last, ["contract_id", "version"], "left_semi").where("attribute = 'type'").orderBy("contract_id", "path").limit(most).collect()
    return [f"{r.contract_id}: {r.path} was {r.old_value} and is {r.new_value}" for r in rows]


def load_log(spark: SparkSession, attributed: str, plain: str, schema: str) -> DataFrame:
    """The attributed violation log, or the plain one where that is missing or empty; without either no rows. Comment lines are left out."""
    for path in (attributed, plain):
        if exists(spark, path):
            lines = spark.read.text(path).where("length(trim(value)) > 0 and not startswith(trim(value), '#') and not startswith(trim(value), '//')")
            log = lines.select(F.from_json("value", schema).alias("v")).select("v.*")
            if not log.isEmpty():
                return log
    return spark.createDataFrame([], schema)


def page(rows: DataFrame, number: int, size: int, position: str = "position") -> DataFrame:
    """The rows of page ``number``, from 1, with ``total_pages``, at least 1."""
    pages = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.count(F.lit(1)).over(W.partitionBy()) / F.lit(size)))
    return rows.withColumn("total_pages", pages).where(F.col(position).between((number - 1) * size + 1, number * size))


def to_violations(results: DataFrame, contract_id: str, run_id: str) -> DataFrame:
    """Failing results as violation records, with an id that is the same for the same run and check."""
    return results.where(F.col("status").isin("FAIL", "ERROR")).select(
        F.sha2(F.concat_ws("/", F.lit(run_id), F.lit(contract_id), "check_id"), 256).alias("violation_id"), F.col("check_type").alias("type"), "check_id", "severity",
        F.lit(contract_id).alias("source_contract_id"), "message", "records_failing",
    )


def subscriber_impact(per_violation: DataFrame) -> DataFrame:
    """``violations_with_subscribers, most, total`` of a table with an array ``subscribers``."""
    n = F.coalesce(F.size("subscribers"), F.lit(0))
    return per_violation.agg(F.count_if(n > 0).alias("violations_with_subscribers"), F.coalesce(F.max(n), F.lit(0)).alias("most"), F.coalesce(F.sum(n), F.lit(0)).alias("total"))
