"""Made-up datasets through whole validations, attribution, reports, output checks and the command line."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace import cli
from millrace.operators import ai_checks, attribution, checks, contract_diff, contracts, datasets, declared, lineage, migration, reporting, runner
from millrace.sources import documents, environment, history, json_lines, sinks, synthetic

SUBS = "contract_id string, subscriber_id string, field string, reason string, subscriber_team string, validation_mode string, contact string"


@pytest.fixture(scope="module")
def made(spark):
    return {n: synthetic.dataset(spark, n, 40).cache() for n in declared.CONTRACTS}


def test_made_up_data_is_clean_and_repeats(spark, made):
    for name, df in made.items():
        results = runner.run_validation(spark, name, df, rubric=None, order=df.columns[0])
        bad = results.where("status = 'FAIL' or status = 'ERROR' and severity <> 'LOW'")
        assert rows(bad, "check_id") == [], name
        declared_ = contracts.validate(df, declared.CONTRACTS[name])
        assert rows(declared_.where("status <> 'PASS'"), "check_id") == [], name
    assert rows(made["events"]) == rows(synthetic.dataset(spark, "events", 40))
    with pytest.raises(ValueError):
        synthetic.dataset(spark, "poems", 1)


def test_models_and_queries_that_are_tests(spark, made):
    tables = declared.model_tables(made["extractions"], made["events"])
    assert rows(declared.run_models(tables).where("failures > 0"), "model", "column_name") == []
    assert {n: df.count() for n, df in declared.run_singular(tables).items()} == dict.fromkeys(declared.SINGULAR, 0)
    wrong = declared.model_tables(synthetic.inject_scale(made["extractions"]), made["events"])
    assert declared.run_singular(wrong)["facts_confidence_within_0_and_1"].count() > 0
    lost = dict(tables) | {"extraction_entities": tables["extraction_entities"].limit(0)}
    assert ("extraction_fact_entity_refs", "entity_id") in rows(declared.run_models(lost).where("failures > 0"), "model", "column_name")
    document = declared.models_document()
    assert len(document["models"]) == 7 and {"relationships": {"to": "ref('events')", "field": "event_id"}} in document["models"][5]["columns"][0]["tests"]
    assert declared.described("runs", made["runs"], {"total_tokens": F.col("total_tokens")})["profiling"]["total_tokens"]["n"] == 40


def test_text_helpers(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    kinds = {"$5 m": "AMOUNT", "May 2019": "DATE", "Trade Bank": "ORG", "River Side": "LOCATION", "Ann Lee": "PERSON", "word": "OTHER"}
    assert {t: one(synthetic.entity_kind(F.lit(t))) for t in kinds} == kinds
    assert one(synthetic.capitalized_phrases(F.lit("The Big Bank met Ann Lee and The Big Bank. Of it."))) == ["The Big Bank", "Ann Lee"]
    assert one(synthetic.truncated(F.lit("one two three"), 8)) == "one two" and one(synthetic.truncated(F.lit("one"), 8)) == "one" and one(synthetic.truncated(F.lit("onetwothree"), 4)) == "onet"


def test_attribution(spark):
    nodes = spark.createDataFrame(
        [(i, f"file::src/f{i}.py", "FILE", {"path": f"src/f{i}.py"}) for i in range(8)] + [(8, "pipeline::extract", "PIPELINE", None), (9, "file::out.jsonl", "FILE", {}), (10, "m", "MODEL", None)],
        "position int, node_id string, type string, metadata map<string,string>",
    )
    edges = spark.createDataFrame([(f"file::src/f{i}.py", "pipeline::extract") for i in range(8)] + [("pipeline::extract", "file::out.jsonl"), ("file::out.jsonl", "m"), ("m", "file::src/f0.py")], "source string, target string")
    v = spark.createDataFrame(
        [("a", "week3.extracted_facts.confidence.range", "check", "c", 55), ("b", "nothing.known", None, None, None), ("d", None, "langsmith_trace_schema", "c", 1)], "violation_id string, check_id string, type string, contract_id string, records_failing bigint"
    )
    subs = spark.createDataFrame([("c", "s", "extracted_facts", "r", "t", "WARN", "x")], SUBS)
    commits = spark.createDataFrame([("src/f0.py", "a" * 40, "dev", "2025-01-01 00:00:00 +0000", "m")], history.COMMIT)
    found = {r.violation_id: r for r in attribution.attribute_violations(spark, v, nodes, edges, subs, commits, F.lit("2025-01-03 00:00:00").cast("timestamp"), attribution.starts("pipeline::extract", "pipeline::map", "file::map.py")).collect()}
    a = found["a"]
    assert a.start == "pipeline::extract" == found["d"].start and found["b"].start == "file::src/f0.py"
    assert [(c.rank, c.file_path) for c in a.blame_chain] == [(i + 1, f"src/f{i}.py") for i in range(5)]
    assert a.blame_chain[0].confidence_score == 0.6 and a.blame_chain[1].author == "unknown" and a.blame_chain[1].confidence_score == 0.0
    assert [s.subscriber_id for s in a.blast_radius.subscribers] == ["s"] and found["b"].blast_radius.subscribers == []
    assert a.blast_radius.affected_nodes == ["file::out.jsonl"] and a.blast_radius.affected_pipelines == ["m", "pipeline::extract"]
    assert (a.blast_radius.estimated_records, a.blast_radius.contamination_depth) == (55, 3)
    empty = attribution.attribute_violations(spark, v, nodes.limit(0), edges.limit(0), subs.limit(0), commits, F.current_timestamp())
    assert {(r.violation_id, r.start, r.blame_chain) for r in empty.collect()} == {("a", None, None), ("b", None, None), ("d", None, None)}
    assert rows(lineage.consumers(edges, nodes, F.contains("node_id", F.lit("pipeline::")))) == [(0, ["file::out.jsonl"], [])]
    lines = spark.createDataFrame([("f", "b"), ("f", "a"), ("f", "b"), ("g", "z"), ("g", "y"), ("g", None)], "file_path string, commit_hash string")
    assert rows(attribution.majority_commit(lines)) == [("f", "b"), ("g", "y")]


def test_report(spark):
    schema = "check_id string, type string, severity string, message string, records_failing bigint, blame_hint struct<file:string>"
    log = spark.createDataFrame([("x.a", "t", "LOW", "m", 3, ("f.py",)), ("x.a", "t", "HIGH", "m", 1, ("f.py",)), ("y.b", "llm_output_schema", "LOW", None, None, None), (None, "t", "LOW", "", 1, None), ("z", None, None, None, 2, None)], schema)
    results = spark.createDataFrame([("x.a", "f.py", "range", "FAIL", "9", "0 to 1", "CRITICAL", 7, [], "m"), ("w", "c", "enum", "PASS", "", "", "LOW", 0, [], ""), ("e", "d", "required", "ERROR", "", "", "HIGH", 4, [], "")], checks.RESULT)
    got = reporting.two_source_priorities(log, results)
    assert rows(got, "position", "check_id", "field", "severity", "records_failing") == [(1, "x.a", "f.py", "CRITICAL", 7), (2, "y.b", "verdict_record", "CRITICAL", 0), (3, "e", "d", "HIGH", 4), (4, "z", "*", "MEDIUM", 2)]
    report = reporting.generate_report(results, log, weights={"default": 1.0, "x.": 2.0}, number=2, size=3, migration={"contract_id": "k", "migration_impact": {"compatibility_verdict": "BREAKING", "breaking_fields": ["a", " ", 3], "migration_checklist": [{"task": "t"}, "no"]}})
    assert report["data_health_score"] == 50.0 and report["violations"]["total_pages"] == 2 and [r["check_id"] for r in report["violations"]["rows"]] == ["z"]
    assert [r["check_id"] for r in report["top_violations"]] == ["x.a", "y.b", "e"] and [a["priority"] for a in report["recommended_actions"]] == [1, 2, 3]
    assert report["schema_changes"] == ["k: BREAKING", "k: a breaks", "k: to do: t"] and report["pass_rate"] == 33.33
    assert reporting.merged_weights({"a": 1, "b": True, 3: 2}, None, {"a": 2.5, "c": "x"}) == {"default": 1.0, "a": 2.5}
    assert reporting.resolve_weights({"a": 1.0}, "/none", {"REPORT_WEIGHTS": '{"a": 3, "default": 2}'}, given={"b": 4}) == {"default": 2.0, "a": 3.0, "b": 4.0}
    assert reporting.resolve_weights({}, None, {"REPORT_WEIGHTS": "no json"}) == {"default": 1.0}
    words = reporting.in_words(results, spark.createDataFrame([("x.a", "s1, s2")], "check_id string, names string"))
    assert "Concerns s1, s2." in {r.check_id: r.text for r in words.collect()}["x.a"]
    assert reporting.migration_summary({}) == (["contract: UNKNOWN"], {"contract_id": None, "compatibility_verdict": "UNKNOWN", "breaking_fields": [], "rollback_plan": "", "checklist": []})


def test_migration(spark):
    share, hundred = {"a": {"type": "number", "minimum": 0, "maximum": 1}}, {"a": {"type": "integer", "minimum": 0, "maximum": 100}}
    changes = contract_diff.diff(contract_diff.schema_rows(spark, {("k", "1"): share, ("k", "2"): hundred, ("m", "1"): share, ("m", "2"): share | {"b": {"type": "string"}}}))
    subs = spark.createDataFrame([("k", "s", "a.b", "r", "t", "WARN", "x"), ("k", "u", "zz", "r", "t", "WARN", "x")], SUBS)
    report = migration.impact(changes, subs, "k", "2")
    assert report["compatibility_verdict"] == "BREAKING" and report["migration_checklist"][0]["owner"] == "platform" and "escalation" in report["rollback_plan_sections"]
    assert [(c["subscriber_id"], c["fields"], c["scale_changed"]) for c in report["consumers"]] == [("s", ["a.b"], True), ("u", [], True)]
    assert migration.impact(changes, subs, "m", "2")["migration_checklist"] == [] and list(migration.way_back(changes, "m", "2")) == ["summary"]
    assert reporting.type_changes(changes) == ["k: a was number and is integer"]


def test_outputs(spark, made):
    settings = ai_checks.Settings.from_environment(environment={"AI_CHECK_SAMPLE": "0", "AI_CHECK_FEATURES": "20", "AI_CHECK_DRIFT_LIMIT": "0.3", "AI_CHECK_PROMPT_LENGTH": "x"})
    assert (settings.sample, settings.features, settings.drift_limit, settings.prompt_length) == (1, 20, 0.3, 8000) and settings.changed(sample=7, features=None).sample == 7
    bad = made["extractions"].withColumn("source_path", F.when(F.col("source_path") == "docs/3.pdf", None).otherwise(F.col("source_path")))
    quarantined, summary = ai_checks.prompt_check(bad)
    assert quarantined.count() == 1 and tuple(summary.first()) == (1, "FAIL")
    wrong = made["verdicts"].withColumn("overall_verdict", F.lit("MAYBE"))
    check = ai_checks.verdict_check(wrong, 1.0)
    assert check.first().trend == "stable" and check.first().status == "PASS"  # all bad, as before
    rising = ai_checks.verdict_check(wrong, 0.0)
    assert rising.first().status == "WARN" and ai_checks.verdict_violations(wrong, "c", rising, most=5).count() == 6 and ai_checks.verdict_violations(wrong, "c", most=None).count() == 40
    texts = spark.createDataFrame([(f"text number {i}",) for i in range(300)] + [(" ",), (None,)], "t string")
    drawn = ai_checks.sample_texts(texts, "t", 50)
    assert drawn.count() == drawn.distinct().count() == 50 and rows(drawn) == rows(ai_checks.sample_texts(texts, "t", 50)) and ai_checks.sample_texts(texts, "t", 1000).count() == 300
    first, base = ai_checks.text_drift(texts, "t", None)
    assert tuple(first.first()) == (0.0, "PASS") and tuple(ai_checks.text_drift(texts.limit(0), "t", None)[0].first()) == (None, "WARN")
    assert ai_checks.text_drift(texts, "t", base)[0].first().drift == 0.0
    other = spark.createDataFrame([("wholly other words",)] * 3, "t string")
    assert ai_checks.text_drift(other, "t", base)[0].first().status == "FAIL"
    mine = ai_checks.embed_with(texts.limit(3).select(F.monotonically_increasing_id().alias("k"), "t"), "k", "t", lambda ts: [[1, len(t)] for t in ts], batch=2)
    assert {tuple(r.embedding)[0] for r in mine.collect()} == {1.0}
    told = []
    hooks = ai_checks.Hooks()
    hooks.register(lambda d: 1 / 0)
    hooks.register(told.append)
    document, log = ai_checks.run_all(spark, bad, wrong, made["runs"], None, 0.0, "now", hooks=hooks)
    assert told == [document] and document["codes"] == {"embedding_drift": 0, "prompt_input": 2, "output_schema": 1, "traces": 0} and document["gauges"]["output_violations"] == 40.0
    assert log.count() == 41


def test_settings_and_documents(spark, tmp_path):
    (tmp_path / ".env").write_text("# c\nA=1\nexport B='two words'\nno line\n=x\n")
    (tmp_path / ".env.local").write_text("A=3\n")
    held = {"A": "0", "B": "kept"}
    environment.load_settings(str(tmp_path), held)
    assert held == {"A": "3", "B": "kept"} and environment.read_settings(str(tmp_path / ".env"))["B"] == "two words"
    assert environment.float_or_none("2.5") == 2.5 and environment.float_or_none(True) is None and environment.number_or("7", 1) == 7 and environment.number_or("7.5", 1) == 1
    documents.write_document(str(tmp_path / "r.yaml"), {"subscriptions": [{"contract_id": "c", "subscriber_id": "s", "subscriber_team": "t", "fields_consumed": ["a"], "validation_mode": "warn", "contact": "x", "breaking_fields": [{"field": "a", "reason": "b"}]}, "odd"]})
    assert documents.registry(spark, str(tmp_path / "r.yaml")).count() == 2 and documents.registry(spark, "/none").count() == 0
    documents.write_document(str(tmp_path / "contracts" / "c.json"), {"id": "c"})
    assert documents.known_contracts(str(tmp_path / "contracts")) == ["c"] and "a of c" in documents.explain_subscription({"contract_id": "c", "breaking_fields": [{"field": "a"}]})
    assert cli.main(["registry", "--registry", str(tmp_path / "r.yaml"), "--contracts", str(tmp_path / "contracts")]) == 1
    assert history.read_log("a\x1fb\x1fc\x1fd\n", "p") == ("p", "a", "b", "c", "d") and history.read_log("", "p") is None
    assert history.last_changes(spark, str(tmp_path), ["x"]).count() == 0
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "a.txt").write_text("x")
    assert len(sinks.write_manifest(spark, {"d": str(tmp_path / "data")}, str(tmp_path / "m.json"))["d"]) == 1


def test_lines_are_numbered_across_splits(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("".join(f'{{"n": {i}}}\r\n' for i in range(1, 4001)))
    (tmp_path / "b.jsonl").write_text("﻿{}\n\n// c\n{\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = json_lines.read_lines(spark, str(tmp_path))
        a = lines.where("file_name like '%a.jsonl'")
        assert a.count() == 4000 and a.where(F.col("line_no") != F.get_json_object("raw", "$.n").cast("bigint")).count() == 0
        assert rows(json_lines.issues(lines), "line_no", "kind") == [(4, "json_decode")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert json_lines.read_records(spark, str(tmp_path / "a.jsonl"), strict=True).count() == 4000


def test_command_line_from_made_data_to_report(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    for n in ("extractions", "verdicts", "runs", "snapshots"):
        assert cli.main(["make", "--dataset", n, "--rows", "12", "--output", at(f"{n}.jsonl")]) == 0
    assert cli.main(["inject", "--data", at("extractions.jsonl"), "--output", at("wrong.jsonl")]) == 0
    (tmp_path / "reports").mkdir()
    run = lambda data, mode: cli.main(["validate", "--data", at(data), "--dataset", "extractions", "--baselines", at("b.json"), "--output", at("reports/r.json"), "--mode", mode])
    assert run("extractions.jsonl", "ENFORCE") == 0 and run("wrong.jsonl", "ENFORCE") == 1 and run("wrong.jsonl", "AUDIT") == 0
    got = {r["check_id"]: r["status"] for r in json.loads((tmp_path / "reports" / "r.json").read_text())["results"]}
    assert got["week3.extracted_facts.confidence.range"] == got["week3.extracted_facts.confidence.statistical_drift"] == "FAIL" and got["week3.processing_time_ms.statistical_drift"] == "PASS"
    results = documents.stored_results(spark, at("reports/*.json"))
    log = reporting.to_violations(results, "c", "run").where("check_id like '%range'")
    sinks.write_jsonl(log, at("log.jsonl"))
    documents.write_document(at("subs.yaml"), {"subscriptions": [{"contract_id": "c", "subscriber_id": "s", "breaking_fields": [{"field": "extracted_facts", "reason": "r"}]}]})
    assert cli.main(["attribute", "--violations", at("log.jsonl"), "--lineage", at("snapshots.jsonl"), "--registry", at("subs.yaml"), "--output", at("found.jsonl")]) == 0
    found = spark.read.json(at("found.jsonl")).first()
    assert found.blast_radius.subscribers[0].subscriber_id == "s" and found.start.startswith("file::")
    assert cli.main(["report", "--results", at("reports/*.json"), "--log", at("log.jsonl"), "--attributed", at("found.jsonl"), "--output", at("report.json")]) == 0
    report = json.loads((tmp_path / "report.json").read_text())
    assert report["data_health_score"] == 70.0 and report["violations"]["rows"][0]["check_id"] == "week3.extracted_facts.confidence.range"
    assert cli.main(["outputs", "--extractions", at("extractions.jsonl"), "--verdicts", at("verdicts.jsonl"), "--runs", at("runs.jsonl"), "--output", at("ai.json")]) == 0
    assert datasets.dispatch("x-extraction-y") == "extractions"


def test_descriptions():
    from millrace.operators.annotations import annotate

    schema = {"a": {"type": "integer", "required": True, "minimum": 1}, "b": {"type": "string", "enum": ["x"]}}
    plain = annotate(schema, {"a": {"min": 1, "max": 3, "mean": 2}})
    assert plain == {"a": "integer; required; minimum 1; from 1 to 3, mean 2", "b": "string; optional; one of x"}
    assert annotate(schema, None, [lambda s, p: 1 / 0, lambda s, p: {}, lambda s, p: {"b": "a letter", "z": "none"}]) == annotate(schema) | {"b": "a letter"}
