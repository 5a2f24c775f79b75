"""Command line: ``python -m millrace.cli validate|profile|draw|diff|impact|attribute|report|outputs|registry|inject|make ...``."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import ai_checks, attribution, checks, contract_diff, contracts, datasets, declared, matching, migration, numeric_drift, reporting, runner
from .sources import documents, history, json_lines, sinks, synthetic


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


def _validate(spark: SparkSession, a: argparse.Namespace) -> int:
    df = _read(spark, a.data)
    if a.contract:
        results = contracts.validate(df, contracts.Contract.from_document(documents.read_document(a.contract)))
    else:
        name = datasets.dispatch(a.dataset or "") or a.dataset or ""
        baselines = numeric_drift.Baselines(a.baselines).frame(spark) if a.baselines else None
        lines = json_lines.read_lines(spark, a.data) if a.data.endswith((".json", ".jsonl")) else None
        required = [f for f, s in declared.CONTRACTS[name].schema.items() if s.get("required")] if name in declared.CONTRACTS else []
        results = runner.run_validation(spark, name, df, contract_id=a.dataset, lines=lines, required=[f for f in required if f in df.columns], baselines=baselines)
        if a.cross:
            more = {n: _read(spark, p) for n, p in (x.split("=", 1) for x in a.cross)}
            results = results.unionByName(runner.cross_results(more["intents"], more["verdicts"], more["extractions"], more["snapshots"]))
    results = spark.createDataFrame(results.collect(), results.schema)  # one row for each check
    if a.baselines and not a.contract:
        runner.settle_baselines(results, df, runner.metrics(name), a.dataset, numeric_drift.Baselines(a.baselines))
    sinks.write_report(results, checks.summary(results), a.output)
    return int(checks.blocks(results, a.mode))


def _versions(a: argparse.Namespace) -> list[str]:
    if a.pair:
        return list(a.pair)
    held = documents.contract_versions(a.versions)
    return documents.versions_since(held, a.since, datetime.now(timezone.utc))[-2:] if a.since else held[-2:]


def _changes(spark: SparkSession, a: argparse.Namespace, pair: list[str]) -> DataFrame:
    return contract_diff.diff(contract_diff.schema_rows(spark, {(a.id, v): documents.read_schema_version(a.versions, v) for v in pair}))


def _diff(spark: SparkSession, a: argparse.Namespace) -> int:
    pair = _versions(a)
    if len(pair) < 2:
        print("fewer than two versions")
        return 0
    changes = _changes(spark, a, pair)
    if a.command == "impact":
        report = migration.impact(changes, documents.subscriptions(spark, a.registry), a.id, pair[-1])
        documents.write_document(a.output, report)
        return int(report["compatibility_verdict"] == "BREAKING")
    found = changes.collect()
    for c in sorted(found):
        print(json.dumps(c.asDict()))
    return int(any(c.breaking for c in found))


def _attribute(spark: SparkSession, a: argparse.Namespace) -> int:
    schema = "violation_id string, check_id string, type string, source_contract_id string, records_failing bigint"
    violations = spark.read.schema(schema).json(a.violations).withColumnRenamed("source_contract_id", "contract_id").where("violation_id is not null")
    if a.violation:
        violations = violations.where(F.col("violation_id") == a.violation)
    last = datasets.latest_snapshot(_read(spark, a.lineage), "captured_at")
    nodes = last.select(F.posexplode("nodes").alias("position", "n")).select("position", "n.*")
    if "metadata" in nodes.columns:
        nodes = nodes.withColumn("metadata", F.from_json(F.to_json("metadata"), "map<string,string>"))
    rules = attribution.starts(a.extractor, a.mapper, a.mapper_file) if a.extractor and a.mapper and a.mapper_file else ()
    paths = [r[0] for r in nodes.where("type = 'FILE'").select(attribution.node_path(F.col("node_id"), F.col("metadata"))).distinct().collect()]  # the files of one graph
    commits = history.last_changes(spark, a.root, paths) if a.root else spark.createDataFrame([], history.COMMIT)
    found = attribution.attribute_violations(spark, violations, nodes, last.select(F.inline("edges")), documents.subscriptions(spark, a.registry), commits, F.current_timestamp(), rules)
    sinks.write_jsonl(found, a.output)
    return 0


def _report(spark: SparkSession, a: argparse.Namespace) -> int:
    results = documents.stored_results(spark, a.results, ("migration*",)).drop("file_name", "position")
    schema = "check_id string, type string, severity string, message string, records_failing bigint, blame_hint struct<file:string>"
    log = reporting.load_log(spark, a.attributed or a.log, a.log, schema)
    weights = reporting.resolve_weights({"default": 1.0}, a.weights)
    moved = documents.read_document(a.migration) if a.migration else None
    documents.write_document(a.output, reporting.generate_report(results, log, weights=weights, number=a.page, size=a.page_size, migration=moved))
    return 0


def _outputs(spark: SparkSession, a: argparse.Namespace) -> int:
    settings = ai_checks.Settings.from_environment().changed(drift_limit=a.drift_limit, sample=a.sample, prompt_length=a.prompt_length)
    base = spark.read.json(a.base).select("dim", "mean") if a.base else None
    document, log = ai_checks.run_all(spark, _read(spark, a.extractions), _read(spark, a.verdicts), _read(spark, a.runs), base, a.rate, _now(), settings)
    documents.write_document(a.output, document)
    if a.log:
        sinks.append_new(spark, log, a.log, ["type", "check_id", "verdict_id"])
    return 0


def _registry(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = documents.registry(spark, a.registry)
    known = documents.known_contracts(a.contracts) if a.contracts else []
    found = matching.invalid_subscriptions(rows, spark.createDataFrame([(k,) for k in known], "contract_id string") if known else None).orderBy("subscription", "problem").collect()
    for r in found:
        print(f"subscription {r.subscription}: {r.problem}")
    empty = rows.isEmpty()
    if empty:
        print("no subscriptions")
    return int(bool(found) or empty)


def main(argv: list[str] | None = None) -> int:
    """``validate`` ends with 1 if its mode says that a pipeline must stop, ``diff`` and ``impact`` if a change is breaking, ``registry`` if it is not in order."""
    p = argparse.ArgumentParser(prog="millrace")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, about: str, *options: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name, help=about)
        for o in options:
            c.add_argument(f"--{o.rstrip('?')}", required=not o.endswith("?"))
        return c

    v = command("validate", "check a table against a contract document, or against the checks of a known dataset", "data", "contract?", "dataset?", "baselines?", "output")
    v.add_argument("--mode", choices=["AUDIT", "WARN", "ENFORCE"], default="AUDIT")
    v.add_argument("--cross", nargs="*", help="name=path of intents, verdicts, extractions and snapshots")
    command("profile", "numeric profile of columns", "data").add_argument("columns", nargs="+")
    command("draw", "draw a contract from a table and store its schema as a version", "data", "id", "versions")
    for name, about, more in (("diff", "changes between two stored versions of a schema", ()), ("impact", "what a new version asks of its consumers", ("registry", "output"))):
        d = command(name, about, "versions", *more)
        d.add_argument("--id", default="contract")
        d.add_argument("--since", type=float, help="days")
        d.add_argument("--pair", nargs=2)
    command("attribute", "likely causes of violations and whom they touch", "violations", "lineage", "registry", "output", "root?", "violation?", "extractor?", "mapper?", "mapper-file?")
    r = command("report", "a report of stored results and the violation log", "results", "log", "attributed?", "weights?", "migration?", "output")
    r.add_argument("--page", type=int, default=1)
    r.add_argument("--page-size", type=int, default=10)
    o = command("outputs", "check what models read and write", "extractions", "verdicts", "runs", "base?", "log?", "output")
    o.add_argument("--rate", type=float, default=0.0)
    o.add_argument("--drift-limit", type=float)
    o.add_argument("--sample", type=int)
    o.add_argument("--prompt-length", type=int)
    command("registry", "check a registry of subscriptions", "registry", "contracts?")
    command("inject", "put the fault of a changed scale into extractions", "data", "output")
    m = command("make", "made-up records of a dataset", "dataset", "output")
    m.add_argument("--rows", type=int, default=50)
    m.add_argument("--seed", type=int, default=42)
    command("tests", "write the tests of the flat tables as a document", "output")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("millrace").getOrCreate()
    if a.command == "profile":
        df = _read(spark, a.data)
        for c in a.columns:
            print(json.dumps({"column": c} | numeric_drift.numeric_profile(df, F.col(c)).first().asDict()))
    elif a.command == "draw":
        print(documents.write_schema_version(a.versions, contracts.draw_contract(_read(spark, a.data), a.id).schema, a.id))
    elif a.command == "inject":
        sinks.write_jsonl(synthetic.inject_scale(_read(spark, a.data)), a.output)
    elif a.command == "make":
        sinks.write_jsonl(synthetic.dataset(spark, a.dataset, a.rows, a.seed), a.output)
    elif a.command == "tests":
        documents.write_document(a.output, declared.models_document())
    else:
        run = {"validate": _validate, "diff": _diff, "impact": _diff, "attribute": _attribute, "report": _report, "outputs": _outputs, "registry": _registry}
        return run[a.command](spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
