"""Checks, drift, schemas, graph walks and reports on small inputs."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions import predicates as p
from millrace.functions.text import instant, packed_id, unpacked_id, uuid_key
from millrace.operators import checks, contract_diff, datasets, json_schema, lineage, matching, numeric_drift, quality, reporting, runner, sequences, vectors
from millrace.operators.checks import Clause
from millrace.sources import json_lines, sinks
from millrace.streaming.event_windows import check_stream, tumbling_counts


def one(df):
    return tuple(df.first())


def test_instants(spark):
    good = ["2017-01-02T03:04:05Z", "2017-01-02 03:04:05", "20170102T030405Z", "1483326245000", "1483326245", "2017-01-02T05:04:05+02:00", " 2017-01-02T03:04:05.000Z "]
    bad = [None, "", "n/a", "0000-00-00T00:00:00Z", "2017-13-02T00:00:00Z", "12", "2017-01-02T25:00:00Z"]
    df = spark.createDataFrame([(x,) for x in good + bad], "t string").select("t", F.unix_micros(instant(F.col("t"))).alias("m"))
    assert {r.t: r.m for r in df.collect()} == {t: 1483326245000000 for t in good} | dict.fromkeys(bad)


def test_keys(spark):
    ids = ["0A000000-0000-4000-8000-00000000000a", "{0a000000-0000-4000-8000-00000000000A}", "URN:UUID:0a000000-0000-4000-8000-00000000000a", "0a0000000000400080000000 0000000a", "x", " x", None, " "]
    got = [r.k for r in spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "i int, x string").orderBy("i").select(F.hex(uuid_key(F.col("x"))).alias("k")).collect()]
    assert got[0] == got[1] == got[2] == "0A000000000040008000" + "0" * 11 + "A" and got[3] not in got[:3] and got[4] == got[5] and got[6] is None and got[7] is None
    back = spark.createDataFrame([(x,) for x in ids], "x string").select(unpacked_id(packed_id(F.col("x"))).alias("y"))
    assert [r.y for r in back.collect()] == [x.strip().lower() or None if x else None for x in ids]


def test_predicates(spark):
    iso = {"2017-01-02": True, "20170102": True, "2017": False, "2017-01": False, "2017-W02-5": True, "2017-02-30": False, "2017-01-02T24:00:00": False, "2017-01-02T03:04:05Z": True, None: False, "x": False}
    df = spark.createDataFrame([(k,) for k in iso], "t string").select("t", p.iso_readable(F.col("t")).alias("ok"))
    assert {r.t: r.ok for r in df.collect()} == iso
    pairs = [("2017-01-02T00:00:00Z", "2017-01-02T00:00:00Z", True, False), ("2017-01-02T00:00:00Z", "2017-01-02T00:00:01Z", True, True), ("2017-01-02T00:00:00", "2017-01-02T00:00:01Z", False, False), (None, "2017-01-02T00:00:01Z", False, False)]
    df = spark.createDataFrame([x[:2] for x in pairs], "a string, b string").select(p.ordered(F.col("a"), F.col("b")), p.ordered(F.col("a"), F.col("b"), True))
    assert [tuple(r) for r in df.collect()] == [x[2:] for x in pairs]


def test_required_uuid_and_silence(spark):
    schema = (
        "doc_id string, source_hash string, extracted_facts array<struct<fact_id:string,text:string,entity_refs:array<string>,confidence:double>>, entities array<struct<entity_id:string,type:string>>, "
        "processing_time_ms bigint, extraction_model string"
    )
    good = ("0a000000-0000-4000-8000-00000000000a", "a" * 64, [("f", "t", ["e", "q", "q"], 0.5), ("g", "t", None, 1.5)], [("e", "ORG")], 5, "gpt-x")
    result = {r.check_id: r for r in checks.run_checks(spark.createDataFrame([good], schema), datasets.extractions()).collect()}
    assert "week3.doc_id.required" not in result and result["week3.doc_id.uuid"].status == "PASS"
    assert result["week3.extracted_facts.entity_refs.relationship"].records_failing == 2
    assert result["week3.extracted_facts.confidence.range"].actual_value == "max=1.500 mean=1.000 min=0.500"
    missing = {r.check_id: r for r in checks.run_checks(spark.createDataFrame([good, ("", *good[1:])], schema), datasets.extractions()).collect()}
    assert missing["week3.doc_id.required"].status == "ERROR" and "week3.doc_id.uuid" not in missing
    assert checks.run_checks(spark.createDataFrame([], schema), datasets.extractions()).where("status <> 'PASS'").count() == 0
    again = checks.with_samples(spark, spark.createDataFrame([good] * 9, schema), datasets.extractions(), [F.col("doc_id")])
    assert len(again.where("check_id = 'week3.extracted_facts.confidence.range'").first().sample_failing) == 5
    assert "Exchange" not in checks.run_checks(spark.createDataFrame([good], schema), datasets.extractions())._jdf.queryExecution().executedPlan().toString().replace("Exchange SinglePartition", "")


def test_intents_and_quirks(spark):
    schema = "intent_id string, code_refs array<struct<file:string,line_start:bigint,line_end:bigint,confidence:double>>, governance_tags array<string>, created_at string"
    df = spark.createDataFrame([(None, None, [], "2017-01-01"), ("x", [("a", 2, 1, 0.5), ("a", None, 1, None)], ["t"], "no")], schema)
    n = {r.check_id.partition(".")[2]: r.records_failing for r in checks.run_checks(df, datasets.intents()).collect()}
    assert n == {"intent_id.required": 1, "intent_id.uuid": 1, "code_refs.non_empty": 1, "code_refs.confidence.range": 1, "code_refs.line_order": 2, "governance_tags.non_empty": 1, "created_at.iso8601": 1}
    nulls = spark.createDataFrame([(None, None)], "event_type string, x string").select(p.matches(F.col("event_type"), p.PASCAL))
    assert one(nulls) == (True,)  # the text "None"


def test_gate(spark):
    fail = spark.createDataFrame([("FAIL", "HIGH"), ("ERROR", "CRITICAL"), ("FAIL", None)], "status string, severity string")
    assert [checks.blocks(fail, m) for m in ("AUDIT", "WARN", "ENFORCE")] == [False, False, True]
    assert datasets.dispatch("some-extractions-events") == "extractions" and datasets.dispatch("other") is None
    assert datasets.unsupported_result(spark, "other").first().status == "ERROR"


@pytest.mark.parametrize("mean,status,severity", [(102.5, "WARN", "MEDIUM"), (104.0, "FAIL", "HIGH"), (101.0, "PASS", "LOW"), (None, "FAIL", "HIGH")])
def test_mean_drift(spark, mean, status, severity):
    now, base = (spark.createDataFrame([("m", x, 1.0)], "key string, mean double, std double") for x in (mean, 100.0))
    r = numeric_drift.mean_drift(now, base, ["key"]).first()
    assert (r.status, r.severity) == (status, severity)


def test_baselines(spark, tmp_path):
    b = numeric_drift.Baselines(str(tmp_path / "b.json"))
    assert b.load() == {}
    b.establish({"a": (1.0, 0.0)})
    b.establish({"a": (5.0, 1.0), "b": (2.0, 2.0)})
    assert b.load() == {"a": {"mean": 1.0, "std": 1e-9}, "b": {"mean": 2.0, "std": 2.0}}
    b.upsert({"a": (3.123456789, 0.0)})
    assert b.load()["a"] == {"mean": 3.12345679, "std": 0.0}
    (tmp_path / "b.json").write_text(json.dumps({"x": "text", "y": {"std": 1}, "z": {"mean": "1", "std": 1}, "ok": {"mean": 1, "std": 1}}))
    now = spark.createDataFrame([(k, 1.0, 1.0) for k in ("x", "y", "z", "ok", "new")], "key string, mean double, std double")
    assert rows(numeric_drift.mean_drift(now, b.frame(spark), ["key"]), "key", "status") == [("new", "PASS"), ("ok", "PASS"), ("x", "ERROR"), ("y", "ERROR"), ("z", "ERROR")]
    (tmp_path / "b.json").write_text("[]")
    assert b.load() == {} and rows(b.frame(spark)) == []


def test_profile(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)] + [(None,)], "v double")
    r = numeric_drift.numeric_profile(df, F.col("v")).first()
    assert (r.n, r["min"], r["max"], r["mean"], r.p25, r.p50, r.p95) == (4, 1.0, 4.0, 2.5, 1.75, 2.5, pytest.approx(3.85))
    assert numeric_drift.numeric_profile(df.where("false"), F.col("v")).first().n == 0
    assert one(numeric_drift.rate_trend(df, F.col("v") > 0, 1.0))[2:] == ("stable", "PASS")


def test_sequence(spark):
    df = spark.createDataFrame([("a", 5), ("a", 6), ("a", 6), ("a", 9), ("b", 1), ("b", None), (None, 2_500_000), (None, 1)], "k string, s bigint")
    assert rows(sequences.sequence_breaks(df, "k", "s", "s")) == [("None", 1), ("a", 3), ("b", 0)]


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, 2, "x", [("q",), (None,)]), (3, 2, "y", None)], "a int, b int, c string, f array<struct<v:string>>")
    rules = ["row_count >= 3", "missing_count(f[*].v) = 0", "a >= b", "c in {x, 'y'}", "max(a) <= 3", "min(a) >= min(b)", "a = b + b", "duplicate_count(b) = 0", "max(cardinality(f)) >= 2"]
    got = {r.rule: (r.observed, r.status) for r in quality.evaluate(df, rules).collect()}
    assert got == dict(zip(rules, [("2", "FAIL"), ("1", "FAIL"), ("1", "FAIL"), ("0", "PASS"), ("3", "PASS"), ("1", "FAIL"), ("2", "FAIL"), ("1", "FAIL"), ("2", "PASS")], strict=True))
    with pytest.raises(ValueError):
        quality.compile_rule("a likes b")


def test_json_schema(spark):
    schema = {
        "type": "object", "required": ["id"], "additionalProperties": False, "minProperties": 1,
        "properties": {"id": {"type": "string", "minLength": 1, "format": "uuid"}, "n": {"type": "integer", "minimum": 1}, "k": {"enum": ["a", 1, None]}, "l": {"type": "array", "items": {"type": "number", "maximum": 2}, "minItems": 1}},
    }
    cases = {
        '{"id":"x"}': True, '{"id":""}': False, "{}": False, '{"id":"x","q":1}': False, '{"id":"x","n":5.0}': True, '{"id":"x","n":true}': False, '{"id":"x","n":0}': False, '{"id":"x","k":null}': True,
        '{"id":"x","k":1}': True, '{"id":"x","k":"b"}': False, '{"id":"x","l":[1,2]}': True, '{"id":"x","l":[3]}': False, '{"id":"x","l":[]}': False, "[1]": False, "no": False, '{"id":5}': False,
    }
    df = spark.createDataFrame([(c,) for c in cases], "raw string").select("raw", json_schema.text_valid(F.col("raw"), schema).alias("ok"))
    assert {r.raw: r.ok for r in df.collect()} == cases
    with pytest.raises(ValueError):
        json_schema.valid(F.parse_json(F.lit("1")), {"oneOf": []})


def test_graph(spark):
    edges = spark.createDataFrame([(f"f{i}", "p") for i in range(8)] + [("p", "t"), ("t", "p"), ("x", None)], "source string, target string")
    nodes = spark.createDataFrame([(f"f{i}", "FILE") for i in range(8)] + [("p", "PIPELINE"), ("t", "TABLE")], "node_id string, type string")
    up = lineage.reach(spark, edges, spark.createDataFrame([("t",), ("t",), (None,)], "start string"), upstream=True)
    assert rows(lineage.upstream_candidates(up, nodes), "node", "hops", "rank") == [(f"f{i}", 2, i + 1) for i in range(5)]
    down = lineage.blast_radius(lineage.reach(spark, edges, spark.createDataFrame([("f0",)], "start string")), nodes)
    assert rows(down) == [("f0", 2, 0, 1)]
    assert one(spark.range(1).select(lineage.blame_score(F.lit(2), F.lit(1)), lineage.blame_score(F.lit(20), F.lit(1)))) == (0.6, 0.0)


def test_registry(spark):
    field = lambda f, c: one(spark.range(1).select(matching.field_concerns_check(F.lit(f), F.lit(c))))[0]
    assert field("runner.schema.required", "runner.schema.required.a") and not field("runner.schema.required", "week3.doc_id.uuid") and not field("cross.ingest", "cross.week2.x")
    assert field("extracted_facts.non_empty", "week3.extracted_facts.confidence.range") and field("doc_id", "week3.doc_id.unique") and not field("entities", "week3.doc_id.unique")
    w = spark.createDataFrame([("a", 1.0), ("a.b", 2.0), ("c", 3.0)], "prefix string, weight double")
    assert rows(matching.longest_prefix(spark.createDataFrame([("a.b.c",), ("a.x",), ("q",), ("",), (None,)], "k string"), "k", w)) == sorted([("a.b.c", 2.0), ("a.x", 1.0), ("q", 1.0), ("", 1.0), (None, 1.0)], key=repr)
    assert field("processing_time_ms.min", "week3.processing_time_ms.statistical_drift") and field("target_ref.x", "cross.week2.target_ref.in_week1_code_refs") and field("confidence.bounds", "week2.confidence.range")
    assert not field("", "week3.a") and not field(" ", "week3.a") and field("cross.ingest", "cross.ingest.week1.line_3") and field("runner.schema.required", "runner.schema.other")
    schema = "subscription int, contract_id string, subscriber_id string, subscriber_team string, fields_consumed array<string>, validation_mode string, contact string, breaking_fields array<struct<field:string,reason:string>>"
    good = (1, "c", "s", "t", ["a"], "audit", "x@y", [("f", "r")])
    subs = spark.createDataFrame([good, (2, "d", "", None, ["a", " "], "LOUD", " ", [("f", ""), (None, "r")]), (3, None, "s", "t", None, "WARN", "x", [])], schema)
    problems = matching.invalid_subscriptions(subs, spark.createDataFrame([("c",)], "contract_id string"))
    assert rows(problems.groupBy("subscription").count()) == [(2, 8), (3, 3)]
    assert matching.invalid_subscriptions(subs.where("subscription = 1")).count() == 0
    flat = subs.where("subscription = 1").select("contract_id", "subscriber_id", "subscriber_team", "validation_mode", "contact", F.explode("breaking_fields").alias("b")).select("*", "b.field", "b.reason")
    told = matching.subscriber_summaries(spark.createDataFrame([("v", "c", "week3.f.range"), ("w", "c", "week3.g"), ("x", None, None)], "violation_id string, contract_id string, check_id string"), flat)
    got = {r.violation_id: [(s.subscriber_id, [tuple(m) for m in s.matched_breaking_fields]) for s in r.subscribers] for r in told.collect()}
    assert got == {"v": [("s", [("f", "r")])], "w": [], "x": []}


def test_runner(spark, tmp_path):
    """Drift against a baseline: the cases of a mean 2.5 and 4 deviations off, none held, no number held, no values."""
    held = spark.createDataFrame([("k::confidence.mean", 100.0, 1.0), ("bad::confidence.mean", None, 1.0)], "key string, mean double, std double")
    batch = lambda *x: spark.createDataFrame([(v,) for v in x], "confidence double")
    watched = lambda: [runner.Metric("m", "confidence", F.array("confidence"))]
    drift = lambda df, contract: one(runner.drift_results(df, watched(), held, contract).select("check_id", "status", "severity"))
    assert drift(batch(102.0, 103.0), "k") == ("m.statistical_drift", "WARN", "MEDIUM") and drift(batch(104.0), "k") == ("m.statistical_drift", "FAIL", "HIGH")
    assert drift(batch(100.5), "k") == ("m.statistical_drift", "PASS", "LOW") and drift(batch(), "k") == ("m.statistical_drift", "FAIL", "HIGH")
    assert drift(batch(1.0), "new") == ("m.drift_baseline", "PASS", "LOW") and drift(batch(1.0), "bad") == ("m.statistical_drift", "ERROR", "LOW")
    assert runner.drift_results(batch(), [runner.Metric("m", "confidence", F.array().cast("array<double>"), optional=True)], held, "k").count() == 0
    store = numeric_drift.Baselines(f"{tmp_path}/b.json")
    runner.settle_baselines(None, batch(1.0, 3.0), watched(), "k", store)
    assert store.load() == {"k::confidence.mean": {"mean": 2.0, "std": 1.0}}
    assert rows(runner.empty_result(batch()), "status") == [("FAIL",)] and runner.empty_result(batch(1.0)).count() == 0
    lines = spark.createDataFrame([(1, '{"a": 1}'), (2, "{"), (3, "// note"), (4, "[]")], "line_no bigint, raw string")
    whole = runner.run_validation(spark, "runs", spark.createDataFrame([], "id string, run_type string, start_time string, end_time string, total_tokens bigint, prompt_tokens bigint, completion_tokens bigint, total_cost double"), lines=lines, required=["id"])
    assert rows(whole.where("status = 'ERROR'"), "check_id") == [("runner.jsonl.line_2",), ("runner.jsonl.line_4",)] and whole.count() == 7
    assert rows(runner.run_validation(spark, "poems", batch(1.0)), "check_id") == [("runner.unsupported_contract",)]


def test_profile_of_groups_and_edges(spark):
    import numpy as np

    values = [float((i * 7919) % 1013) for i in range(500)] + [3.0] * 200
    df = spark.createDataFrame([("a", v) for v in values] + [(None, 1.0), (None, None), ("b", -2.5)], "g string, v double").repartition(7)
    got = {r.g: r for r in numeric_drift.numeric_profile(df, F.col("v"), ["g"]).collect()}
    assert got.keys() == {"a", None, "b"} and got[None].p50 == 1.0 and got["b"].stddev == 0.0
    for q, name in ((25, "p25"), (50, "p50"), (75, "p75"), (95, "p95"), (99, "p99")):
        assert abs(got["a"][name] - np.percentile(values, q)) < 1e-9
    assert abs(got["a"].stddev - np.std(values)) < 1e-9
    empty = numeric_drift.numeric_profile(df.where("false"), F.col("v")).first()
    assert empty.n == 0 and empty.p50 is None


def test_schema_on_columns_equals_schema_on_json(spark):
    schema = {"type": "object", "required": ["a", "m"], "properties": {"a": {"type": ["integer", "string"], "minimum": 2}, "s": {"type": "string", "minLength": 2, "pattern": "^x"}, "d": {"type": "integer"}, "l": {"type": "array", "items": {"type": "string"}, "minItems": 1},
              "m": {"type": "object", "minProperties": 1, "additionalProperties": {"type": "object", "required": ["k"], "properties": {"k": {"enum": [1, 2]}}}}}, "additionalProperties": False}
    data = [(1, "xy", 1.0, ["q"], {"z": (1,)}), (2, "xy", 1.5, ["q"], {"z": (2,)}), (2, "x", 2.0, [None], {"z": (2,)}), (3, "xz", None, None, {"z": (None,)}), (3, None, None, [], {"z": (1,)}), (9, "xxx", 3.0, ["a", "b"], {"z": (1,), "y": None}), (None, "xx", None, None, {"z": (1,)}), (5, None, None, None, {}), (5, None, 4.0, None, None), (5, "xq", 4.0, ["w"], {"z": (3,)}), (7, "xq", 4.0, ["w"], {"z": (2,), "u": (1,)})]
    df = spark.createDataFrame(data, "a bigint, s string, d double, l array<string>, m map<string,struct<k:bigint>>")
    got = df.select(json_schema.row_valid(df, schema).alias("t"), json_schema.text_valid(F.to_json(F.struct("*")), schema).alias("j")).collect()
    assert [r.t for r in got] == [r.j for r in got] and {r.t for r in got} == {True, False}


def test_schema_versions(spark):
    old = {"a": {"type": "number", "minimum": 0, "maximum": 1}, "b": {"type": "string", "enum": ["x", "y"]}, "c": {"type": "object", "properties": {"d": {"type": "string"}}}}
    new = {"a": {"type": "integer", "minimum": 0, "maximum": 100}, "b": {"type": "string", "enum": ["y", "x"]}, "e": {"type": "string", "required": True}, "g": {"type": "string"}}
    changes = contract_diff.diff(contract_diff.schema_rows(spark, {("k", "1"): old, ("k", "2"): new, ("only", "1"): old}))
    assert rows(changes, "path", "change", "breaking") == sorted([("a", "changed", True), ("a", "scale_changed", True), ("c", "removed", True), ("e", "added", True), ("g", "added", False)], key=repr)
    assert rows(contract_diff.verdict(changes), "verdict") == [("BREAKING",)]
    subs = spark.createDataFrame([("k", "s", "c"), ("k", "t", "g")], "contract_id string, subscriber_id string, field string")
    assert rows(contract_diff.concerned(changes, subs), "subscriber_id", "path") == [("s", "c")]


def test_report(spark):
    results = spark.createDataFrame([("a", "FAIL", "CRITICAL", 1), ("a", "FAIL", "LOW", 9), ("b", "PASS", "LOW", 0)], "check_id string, status string, severity string, n int")
    worst = reporting.worst_failures(results, ["n"])
    assert one(reporting.health_score(worst)) == (1, 80.0)
    assert one(reporting.health_score(worst.withColumn("w", F.lit(2.0)), "w")) == (1, 60.0)
    assert one(reporting.health_score(worst.where("false"))) == (0, 100.0)
    v = spark.createDataFrame([(f"c{i}", "x", "HIGH", i) for i in range(5)], "check_id string, column_name string, severity string, records_failing bigint")
    last = reporting.page(reporting.prioritized(v), 3, 2)
    assert rows(last, "check_id", "position", "total_pages") == [("c0", 5, 3)]


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n# note\n// note\nnot json\n"text"\nnull\n{"a": 2}\n')
    lines = json_lines.read_lines(spark, str(tmp_path / "x.jsonl"))
    assert json_lines.records(lines).count() == 2
    assert rows(json_lines.issues(lines), "line_no", "kind") == [(5, "json_decode"), (6, "not_object"), (7, "not_object")]
    summary = json_lines.ingest_summary(lines).first()
    assert (summary.records, summary.issues, len(summary.first_issues)) == (2, 3, 3)
    assert checks.ingest_results(json_lines.issues(lines)).where("status = 'ERROR' and severity = 'HIGH'").count() == 3
    assert json_lines.read_records(spark, str(tmp_path / "x.jsonl")).count() == 2
    with pytest.raises(Exception):
        json_lines.read_records(spark, str(tmp_path / "x.jsonl"), strict=True).collect()


def test_sinks(spark, tmp_path):
    log, at = spark.createDataFrame([("a", None), ("a", None), ("b", "1")], "k string, v string"), f"file://{tmp_path}/log"
    assert [sinks.append_new(spark, log, at, ["k", "v"]) for _ in range(2)] == [2, 0]
    good = sinks.quarantine(log, F.col("v").isNotNull(), f"file://{tmp_path}/bad")
    assert good.count() == 1 and spark.read.json(f"file://{tmp_path}/bad").count() == 2
    results = checks.run_checks(log, [Clause("c", "v", "required", F.col("v").isNull())])
    sinks.write_report(results, checks.summary(results), str(tmp_path / "report.json"))
    assert json.loads((tmp_path / "report.json").read_text())["failed"] == 1
    assert sinks.file_digest(str(tmp_path / "report.json")) == sinks.file_digests(spark, str(tmp_path / "report.json")).first().sha256


def test_hashed_embeddings(spark):
    assert [vectors.murmur3_32(x) for x in (b"", b"foo", b"hello, world")] == [0, -156908512, 345750399]
    e = vectors.hashed_embeddings(spark.createDataFrame([(1, "Foo foo bar a"), (2, None), (3, "")], "i int, text string"), "i", "text", 64).orderBy("i").collect()
    assert sum(x * x for x in e[0].embedding) == pytest.approx(1) and not any(e[1].embedding) and not any(e[2].embedding)
    same = vectors.centroid(spark.createDataFrame([([1.0, 0.0],), ([0.0, 1.0],), (None,)], "v array<double>"), "v")
    assert rows(same) == [(0, 0.5), (1, 0.5)] and one(vectors.cosine_drift(same, same)) == (0.0, "PASS")


def test_streams(spark, tmp_path):
    spark.createDataFrame([("2017-01-01 00:10:00", "a", -1), ("2017-01-01 00:50:00", "a", 2), ("2017-01-01 05:00:00", "b", 3)], "t string, k string, v int").selectExpr("cast(t as timestamp) t", "k", "v").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("t timestamp, k string, v int").parquet(f"{tmp_path}/in")
    q = tumbling_counts(stream, "t", ["k"]).writeStream.format("memory").queryName("windows").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert rows(spark.table("windows"), "k", "n") == [("a", 2)]  # the last window is still open
    got = []
    q = check_stream(stream, [Clause("v.range", "v", "range", F.col("v") < 0)], lambda df, n: got.extend(df.collect()), f"{tmp_path}/cp")
    q.awaitTermination(60)
    assert sum(r.records_failing for r in got) == 1


def test_declared_contract_at_every_depth(spark):
    from millrace.operators.contracts import Contract, validate

    schema = {
        "a": {"required": True, "unique": True, "minimum": 1}, "s": {"properties": {"x": {"required": True, "enum": [1, 2]}}},
        "l": {"minItems": 1, "items": {"properties": {"v": {"required": True, "maximum": 5}, "m": {"items": {"pattern": "^q"}}}}},
    }
    df = spark.createDataFrame(
        [(1, (3,), [(9.0, ["q", "r"]), None, (None, None)]), (1, None, []), (None, (None,), None), (0, (1,), [(1.0, [None, "r"])])],
        "a int, s struct<x:int>, l array<struct<v:double,m:array<string>>>",
    )
    n = {r.check_id[2:]: (r.status, r.records_failing) for r in validate(df, Contract("c", schema, ["row_count >= 5"], {"a": ("other", "k")}), {"other": spark.createDataFrame([(1,)], "k int")}).collect()}
    quality = next(k for k in n if k.startswith("quality"))
    assert n.pop(quality) == ("FAIL", 1)
    assert n == {
        "a.required": ("ERROR", 1), "a.minimum": ("FAIL", 1), "s.x.required": ("ERROR", 1), "s.x.enum": ("FAIL", 1), "l.minItems": ("FAIL", 1), "l[].v.required": ("ERROR", 1),
        "l[].v.maximum": ("FAIL", 1), "l[].m[].pattern": ("FAIL", 2), "a.unique": ("FAIL", 1), "a.relationships": ("FAIL", 1),
    }
    assert validate(df, Contract("c", {})).count() == 0
    assert validate(df.where("false"), Contract("c", schema)).where("status <> 'PASS'").count() == 0


def test_documents_and_command_line(spark, tmp_path):
    from datetime import datetime, timezone

    from millrace import cli
    from millrace.sources import documents

    assert rows(documents.subscriptions(spark, str(tmp_path / "none.json"))) == []
    (tmp_path / "subs.json").write_text(json.dumps({"subscriptions": [{"contract_id": "c", "subscriber_id": "s", "breaking_fields": [{"field": "f", "reason": "r"}, {"field": "g"}]}, "junk"]}))
    assert rows(documents.subscriptions(spark, str(tmp_path / "subs.json")), "subscriber_id", "field") == [("s", "f"), ("s", "g")]
    for day in (1, 20, 21):
        documents.write_schema_version(str(tmp_path / "v"), {"a": {"type": "string", "required": day < 21}}, "c", datetime(2024, 1, day, tzinfo=timezone.utc))
    versions = documents.schema_versions(str(tmp_path / "v"))
    assert len(versions) == 3 and documents.read_schema_version(str(tmp_path / "v"), versions[0]) == {"a": {"type": "string", "required": True}}
    now = datetime(2024, 1, 22, tzinfo=timezone.utc)
    assert documents.versions_since(versions, 7, now) == versions[1:] and documents.versions_since(versions, 0.5, now) == versions[1:]
    assert documents.is_inferred({"a": {"types": ["str"]}}) and not documents.is_inferred({"a": {"type": "string"}})
    assert documents.staleness(datetime(2024, 1, 1, tzinfo=timezone.utc), now) and documents.staleness(now, now) is None
    assert cli.main(["diff", "--versions", str(tmp_path / "v")]) == 1
    assert cli.main(["diff", "--versions", str(tmp_path / "none")]) == 0
    spark.createDataFrame([(1, "x"), (5, None)], "a int, b string").write.parquet(str(tmp_path / "d.parquet"))
    (tmp_path / "c.json").write_text(json.dumps({"id": "c", "schema": {"a": {"maximum": 3}, "b": {"required": True}, "junk": 1}, "quality": ["row_count >= 1"]}))
    run = lambda mode, **k: cli.main(["validate", "--data", str(tmp_path / "d.parquet"), "--output", str(tmp_path / "r.json"), "--mode", mode, *sum(([f"--{x}", y] for x, y in k.items()), [])])
    assert (run("AUDIT", contract=str(tmp_path / "c.json")), run("WARN", contract=str(tmp_path / "c.json"))) == (0, 1)
    assert json.loads((tmp_path / "r.json").read_text())["errored"] == 1
    assert run("ENFORCE", dataset="unknown") == 0
    stored = documents.stored_results(spark, str(tmp_path / "r.json"))
    assert rows(stored, "status") == [("ERROR",)]
    assert cli.main(["draw", "--data", str(tmp_path / "d.parquet"), "--id", "d", "--versions", str(tmp_path / "w")]) == 0
    assert documents.read_schema_version(str(tmp_path / "w"), documents.schema_versions(str(tmp_path / "w"))[0])["a"] == {"type": "integer", "required": True, "minimum": 1.0, "maximum": 5.0}
    assert documents.latest_document(str(tmp_path), "c.js*n")[0]["id"] == "c" and documents.latest_document(str(tmp_path), "zz*") == (None, None)
    assert ("c.json",) in rows(documents.file_inventory(spark, str(tmp_path)))


def test_required_fields_of_all_rows(spark, tmp_path):
    from millrace.plans.registry import queries

    df = spark.range(1000).selectExpr("cast(id as string) id", "if(id = 999, null, 'x') name")
    assert [(r.check_id, r.records_failing) for r in datasets.required_result(df, df.columns, "id").collect()] == [("runner.schema.required.name", 1)]
    df.write.parquet(f"{tmp_path}/runs.parquet")
    assert [r.records_failing for r in queries()["required_fields_runs"](spark, str(tmp_path)).collect()] == [1]
