"""The whole validations, the registry rule and the reading of text records in DuckDB's SQL."""

from __future__ import annotations

from .contract_sql import SQL as CONTRACT
from .contract_sql import _bad, _count, _moment, _results, _unit, _UUID

_INTENTS = """
(SELECT violation_id AS intent_id, detected_at AS created_at, [severity] AS tags_raw, severity,
   list_concat(CASE WHEN blame_hint IS NOT NULL THEN [{'file': blame_hint.file, 'line_start': blame_hint.line_start, 'line_end': blame_hint.line_end, 'confidence': 1.0::DOUBLE}] ELSE [] END,
     [{'file': b.file_path, 'line_start': 1::BIGINT, 'line_end': b.rank, 'confidence': b.confidence_score} FOR b IN coalesce(blame_chain, [])]) AS code_refs FROM demo_blame)"""

_INTENT_CHECKS = _results(f"{_INTENTS} i", [
    ("week1.intent_id.required", "required", "coalesce(intent_id, '') = ''", "CRITICAL", "ERROR"),
    ("week1.intent_id.uuid", "format", f"coalesce(intent_id, '') <> '' AND {_bad('intent_id', _UUID)}", "CRITICAL", "FAIL"),
    ("week1.code_refs.non_empty", "array", "len(code_refs) < 1", "CRITICAL", "FAIL"),
    ("week1.code_refs.confidence.range", "range", _count("code_refs", "e", f"NOT {_unit('e.confidence')}"), "CRITICAL", "FAIL"),
    ("week1.code_refs.line_order", "range", _count("code_refs", "e", "NOT coalesce(e.line_end >= e.line_start, false)"), "CRITICAL", "FAIL"),
    ("week1.governance_tags.non_empty", "array", "severity IS NULL", "CRITICAL", "FAIL"),
    ("week1.created_at.iso8601", "format", f"coalesce({_moment('created_at')} IS NULL, true)", "CRITICAL", "FAIL"),
])

_DRIFT = f"""
WITH v AS (
  SELECT 'week3.extracted_facts.confidence' AS id, f.confidence AS x FROM (SELECT unnest(extracted_facts) AS f FROM extractions) a
  UNION ALL SELECT 'week3.processing_time_ms', processing_time_ms FROM extractions
  UNION ALL SELECT 'week2.confidence', confidence FROM verdicts WHERE {_unit("confidence")}
  UNION ALL SELECT 'week5.payload.bytes', payload.bytes FROM event_log
  UNION ALL SELECT 'week1.code_refs.confidence', e.confidence FROM (SELECT unnest(code_refs) AS e FROM {_INTENTS} i) b),
base(id, held, m, s) AS (VALUES ('week3.extracted_facts.confidence', true, 0.9::DOUBLE, 0.03::DOUBLE), ('week3.processing_time_ms', true, NULL, 10.0), ('week2.confidence', true, 0.72, 0.04),
  ('week5.payload.bytes', true, 30000.0, 9000.0), ('week1.code_refs.confidence', false, NULL, NULL)),
d AS (SELECT b.id, held, m, s, abs(coalesce(avg(x), 0) - m) / greatest(s, 1e-9) AS sigma FROM base b LEFT JOIN v ON v.id = b.id GROUP BY b.id, held, m, s)
SELECT id || CASE WHEN held THEN '.statistical_drift' ELSE '.drift_baseline' END AS check_id, 'drift' AS check_type,
  CASE WHEN NOT held THEN 'PASS' WHEN m IS NULL OR s IS NULL THEN 'ERROR' WHEN sigma > 3 THEN 'FAIL' WHEN sigma > 2 THEN 'WARN' ELSE 'PASS' END AS status,
  CASE WHEN NOT held OR m IS NULL OR s IS NULL THEN 'LOW' WHEN sigma > 3 THEN 'HIGH' WHEN sigma > 2 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
  CAST(CASE WHEN NOT held THEN 0 WHEN m IS NULL OR s IS NULL OR sigma > 2 THEN 1 ELSE 0 END AS BIGINT) AS records_failing FROM d"""

_PATH = "regexp_replace(trim(replace({}, chr(92), '/')), '^file::', '')"
_ONE = "SELECT '{i}' AS check_id, '{t}' AS check_type, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status, CASE WHEN n > 0 THEN 'CRITICAL' ELSE 'LOW' END AS severity, CAST(n AS BIGINT) AS records_failing FROM ({q}) q"

_FILES = _ONE.format(i="week1.code_refs.file.exists", t="file_exists", q=f"""
SELECT count(*) AS n FROM (SELECT {_PATH.format("e.file")} AS path FROM (SELECT unnest(code_refs) AS e FROM {_INTENTS} i) b) u
WHERE path <> '' AND path NOT IN (SELECT {_PATH.format("n.node_id")} FROM (SELECT unnest(nodes) AS n FROM lineage_snapshots) x WHERE n.type = 'FILE' AND n.node_id IS NOT NULL)""")

_PAYLOAD = _ONE.format(i="week5.payload.jsonschema", t="jsonschema", q="""
SELECT count(*) AS n FROM event_log WHERE event_type = 'FileReceived' AND NOT coalesce(payload IS NOT NULL AND payload.doc_id IS NOT NULL AND payload.status IN ('filed', 'waiting') AND (payload.bytes IS NULL OR payload.bytes >= 1000), false)""")

_TARGETS = _ONE.format(i="cross.week2.target_ref.in_week1_code_refs", t="relationship", q=f"""
SELECT count(*) AS n FROM verdicts WHERE coalesce(target_ref, 'None') NOT IN (SELECT e.file FROM (SELECT unnest(code_refs) AS e FROM {_INTENTS} i) b WHERE e.file IS NOT NULL)""")

_DOCUMENTS = _ONE.format(i="cross.week4.doc_id.as_lineage_node", t="relationship", q="""
SELECT count(DISTINCT doc_id) AS n FROM extractions WHERE doc_id IS NOT NULL AND 'table::doc:' || doc_id NOT IN (
  SELECT n.node_id FROM (SELECT unnest(nodes) AS n FROM (SELECT nodes FROM lineage_snapshots ORDER BY received_at DESC, snapshot_id DESC LIMIT 1) l) x WHERE n.node_id IS NOT NULL)""")

_LINE = "regexp_replace(trim(raw), '^' || chr(65279), '')"
_LINES = f"(SELECT *, {_LINE} AS t FROM raw_records WHERE length({_LINE}) > 0 AND NOT starts_with({_LINE}, '#') AND NOT starts_with({_LINE}, '//'))"
_ISSUE = "CASE WHEN NOT json_valid(t) THEN 'json_decode' WHEN json_type(t) <> 'OBJECT' THEN 'not_object' END"

_REQUIRED = " UNION ALL ".join(
    f"SELECT 'runner.schema.required.{c}' AS check_id, 'required_field' AS check_type, 'ERROR' AS status, 'CRITICAL' AS severity, count(*) AS records_failing FROM extractions WHERE {c} IS NULL HAVING count(*) > 0"
    for c in ("doc_id", "source_path", "extraction_model")
)

_RECORDS = f"(SELECT dataset, CAST(t AS JSON) AS j FROM {_LINES} l WHERE json_valid(t) AND json_type(t) = 'OBJECT')"


def _wrong(path: str, kinds: str) -> str:
    return f"SELECT '{path}' AS path, count(*) FILTER (json_type(j, '$.{path}') IS NOT NULL AND json_type(j, '$.{path}') NOT IN ('NULL', {kinds})) AS anomalies FROM {_RECORDS} r WHERE dataset = 'events'"


_GRAPH = """
snap AS (SELECT * FROM lineage_snapshots WHERE len(nodes) > 0 ORDER BY received_at DESC, snapshot_id DESC LIMIT 1),
nodes AS (SELECT n.node_id AS id, n.type AS type, n.metadata AS m, pos FROM (SELECT unnest(nodes) AS n, generate_subscripts(nodes, 1) AS pos FROM snap) x WHERE n.node_id IS NOT NULL),
edges AS (SELECT DISTINCT e.source AS s, e.target AS t FROM (SELECT unnest(edges) AS e FROM snap) x WHERE e.source IS NOT NULL AND e.target IS NOT NULL)"""


def _first(condition: str) -> str:
    return f"(SELECT id FROM nodes WHERE {condition} ORDER BY pos LIMIT 1)"


_ATTRIBUTED = f"""
WITH RECURSIVE {_GRAPH},
v AS (SELECT delivery_id AS violation_id, lower(trim(check_id)) AS c, type, source_contract_id AS contract_id FROM demo_blame WHERE violation_id IS NOT NULL),
started AS (SELECT *, coalesce(CASE WHEN starts_with(c, 'alder.') THEN {_first("contains(id, 'pipeline::')")} END, CASE WHEN starts_with(c, 'elm.') THEN {_first("contains(id, 'table::')")} END,
   CASE WHEN starts_with(c, 'birch.') THEN {_first("contains(id, 'file::') AND type = 'FILE'")} END, CASE WHEN type = 'answer_shape' THEN {_first("contains(id, 'pipeline::')")} END, {_first("true")}) AS start FROM v),
up AS (SELECT DISTINCT start, start AS node, 0 AS hops FROM started WHERE start IS NOT NULL UNION SELECT u.start, e.s, u.hops + 1 FROM up u JOIN edges e ON e.t = u.node WHERE u.hops < 60),
above AS (SELECT start, node, min(hops) AS hops FROM up GROUP BY 1, 2),
ranked AS (SELECT a.*, row_number() OVER (PARTITION BY start ORDER BY hops, node) AS r FROM above a WHERE hops >= 1 AND node IN (SELECT id FROM nodes WHERE type = 'FILE')),
tops AS (SELECT s.start, coalesce(min(node) FILTER (r = 1), {_first("type = 'FILE'")}) AS nearest, CASE WHEN count(r) = 0 AND {_first("type = 'FILE'")} IS NOT NULL THEN 1 ELSE least(count(r), 5) END AS candidates
  FROM (SELECT DISTINCT start FROM started WHERE start IS NOT NULL) s LEFT JOIN ranked r ON r.start = s.start GROUP BY s.start),
down AS (SELECT DISTINCT nearest, nearest AS node, 0 AS hops FROM tops WHERE nearest IS NOT NULL UNION SELECT d.nearest, e.t, d.hops + 1 FROM down d JOIN edges e ON e.s = d.node WHERE d.hops < 60),
below AS (SELECT nearest, node, min(hops) AS hops FROM down GROUP BY 1, 2),
hit AS (SELECT nearest, max(hops) AS depth, count(DISTINCT node) FILTER (hops > 0 AND n.type = 'FILE') AS files, count(DISTINCT node) FILTER (hops > 0 AND n.type IN ('PIPELINE', 'MODEL')) AS pipelines
  FROM below b LEFT JOIN nodes n ON n.id = b.node GROUP BY nearest),
told AS (SELECT violation_id, count(DISTINCT subscriber_id) AS n FROM ({CONTRACT["registry_match"]}) r GROUP BY 1)
SELECT s.violation_id, s.start, CAST(coalesce(t.candidates, 0) AS INTEGER) AS candidates,
  regexp_replace(coalesce(CASE WHEN trim(coalesce(f.m['path'], '')) <> '' THEN trim(replace(f.m['path'], chr(92), '/')) END, replace(t.nearest, chr(92), '/')), '^file::', '') AS file_path,
  CAST(coalesce(told.n, 0) AS INTEGER) AS subscribers, CAST(coalesce(h.files, 0) AS INTEGER) AS files, CAST(coalesce(h.pipelines, 0) AS INTEGER) AS pipelines, CAST(coalesce(h.depth, 0) AS BIGINT) AS depth
FROM started s LEFT JOIN tops t ON t.start = s.start LEFT JOIN hit h ON h.nearest = t.nearest LEFT JOIN told ON told.violation_id = s.violation_id
LEFT JOIN (SELECT id, any_value(m) AS m FROM nodes GROUP BY id) f ON f.id = t.nearest"""

_OUTPUT_BAD = """NOT coalesce(length(verdict_id) >= 1 AND length(target_ref) >= 1 AND length(rubric_id) >= 1 AND length(rubric_version) >= 1 AND scores IS NOT NULL AND cardinality(scores) >= 1
  AND len([1 FOR s IN map_values(scores) IF NOT coalesce(s.score BETWEEN 1 AND 5 AND s.evidence IS NOT NULL AND s.notes IS NOT NULL AND len([1 FOR e IN s.evidence IF e IS NULL]) = 0, false)]) = 0
  AND overall_verdict IN ('PASS', 'FAIL', 'WARN') AND overall_score IS NOT NULL AND confidence BETWEEN 0 AND 1 AND evaluated_at IS NOT NULL, false)"""

_RATE = f"""SELECT count(*) AS total_outputs, count(*) FILTER ({_OUTPUT_BAD}) AS schema_violations, round(count(*) FILTER ({_OUTPUT_BAD}) / greatest(count(*), 1), 6) AS violation_rate, 0.05::DOUBLE AS baseline_violation_rate,
  CASE WHEN count(*) FILTER ({_OUTPUT_BAD}) / greatest(count(*), 1) > 0.075 THEN 'rising' ELSE 'stable' END AS trend, CASE WHEN count(*) FILTER ({_OUTPUT_BAD}) / greatest(count(*), 1) > 0.075 THEN 'WARN' ELSE 'PASS' END AS status FROM verdicts"""

_WHOLE = "'BIGINT', 'UBIGINT'"

_RUNS = ("id", "name", "run_type", "inputs", "outputs", "error", "start_time", "end_time", "total_tokens", "prompt_tokens", "completion_tokens", "total_cost", "tags", "parent_run_id", "session_id")
_LEAF = "CASE WHEN t.type = 'OBJECT' THEN len(json_keys(t.value)) = 0 ELSE t.type <> 'NULL' END AND NOT contains(t.fullkey, '[')"

SQL = {
    "required_fields_runs": " UNION ALL ".join(
        f"SELECT 'runner.schema.required.{c}' AS check_id, 'required_field' AS check_type, 'ERROR' AS status, 'CRITICAL' AS severity, count(*) AS records_failing FROM runs WHERE {c} IS NULL HAVING count(*) > 0" for c in _RUNS
    ),
    "p7_table_sizes": f"""
WITH records AS (SELECT dataset, file_name, line_no, raw FROM raw_records WHERE feed IS NOT NULL AND file_name IS NOT NULL AND json_valid(raw) AND json_type(raw) = 'OBJECT'),
leaves AS (SELECT dataset, file_name, count(*) AS n FROM records, json_tree(raw) t WHERE {_LEAF} GROUP BY ALL)
SELECT r.dataset, r.file_name, count(*) AS records, any_value(coalesce(l.n, 0)) AS filled FROM records r LEFT JOIN leaves l ON l.dataset = r.dataset AND l.file_name = r.file_name GROUP BY 1, 2""",
    "attributed_violations": _ATTRIBUTED,
    "prompt_quarantine": "SELECT doc_id, source_path, left(coalesce(extracted_facts[1].text, ''), 40) AS content_preview FROM extractions WHERE coalesce(doc_id, '') = '' OR coalesce(source_path, '') = ''",
    "output_schema_check": _RATE,
    "output_violation_log": f"""
SELECT 'llm_output_schema' AS type, 'week2.verdict_record.schema' AS check_id, 'CRITICAL' AS severity, 'verdicts' AS source_contract_id, verdict_id, CAST(1 AS BIGINT) AS records_failing FROM verdicts WHERE {_OUTPUT_BAD}
UNION ALL SELECT 'llm_output_schema_trend', 'week2.verdict_record.violation_rate', 'WARNING', 'verdicts', NULL, schema_violations FROM ({_RATE}) r WHERE trend = 'rising'""",
    "trace_summary": f"""
SELECT (SELECT count(*) FROM runs) AS total_traces, count(*) FILTER (status = 'FAIL') AS checks_failed, CASE WHEN count(*) FILTER (status = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ({CONTRACT["checks_runs"]}) c""",
    "checks_intents": _INTENT_CHECKS,
    "drift_clauses": _DRIFT,
    "checks_files": _FILES,
    "checks_payload": _PAYLOAD,
    "cross_checks": f"{_TARGETS} UNION ALL {_DOCUMENTS}",
    "validation_extractions": f"""
SELECT check_id, check_type, status, severity, records_failing, count(*) AS n FROM (
  SELECT 'runner.jsonl.line_' || line_no AS check_id, 'ingest' AS check_type, 'ERROR' AS status, 'HIGH' AS severity, CAST(1 AS BIGINT) AS records_failing FROM {_LINES} l WHERE dataset = 'schema_evolution_demo' AND {_ISSUE} IS NOT NULL
  UNION ALL {_REQUIRED} UNION ALL SELECT * FROM ({CONTRACT["checks_extractions"]}) a UNION ALL SELECT * FROM ({CONTRACT["unique_doc_id"]}) b
  UNION ALL SELECT * FROM ({_DRIFT}) c WHERE starts_with(check_id, 'week3.')) r GROUP BY ALL""",
    "anomalies_of_kind": " UNION ALL ".join([
        _wrong("payload", "'OBJECT'"), _wrong("metadata", "'OBJECT'"), _wrong("sequence_number", _WHOLE), _wrong("schema_version", "'VARCHAR'"), _wrong("payload.bytes", f"{_WHOLE}, 'DOUBLE'"),
    ]),
    "ingest_issues": f"SELECT {_ISSUE} AS kind, count(*) AS n FROM {_LINES} l WHERE {_ISSUE} IS NOT NULL GROUP BY 1",
    "inferred_kinds": f"""
SELECT dataset, key, string_agg(DISTINCT CASE kind WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'DOUBLE' THEN 'NUMBER' ELSE kind END, ',' ORDER BY CASE kind WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'DOUBLE' THEN 'NUMBER' ELSE kind END) AS kinds
FROM (SELECT dataset, key, json_type(j, '$."' || key || '"') AS kind FROM (SELECT dataset, j, unnest(json_keys(j)) AS key FROM {_RECORDS} r) k) x WHERE kind <> 'NULL' GROUP BY 1, 2""",
    "registry_rule": r"""
WITH a AS (SELECT regexp_replace(lower(trim(check_id)), '^[a-z]+', 'week3') AS c FROM demo_blame WHERE violation_id IS NOT NULL AND check_id IS NOT NULL),
ids AS (SELECT DISTINCT c FROM (SELECT c FROM a UNION ALL SELECT regexp_replace(c, '^week3\.', 'cross.week2.') FROM a UNION ALL SELECT 'cross.ingest.' || c FROM a
  UNION ALL SELECT 'runner.schema.required.' || regexp_extract(c, '[^.]*$') FROM a) x),
t AS (SELECT c, CASE WHEN starts_with(c, 'cross.ingest.') THEN substr(c, 14) WHEN starts_with(c, 'cross.week2.') OR starts_with(c, 'cross.week4.') THEN substr(c, 13)
  WHEN left(c, 6) IN ('week1.', 'week2.', 'week3.', 'week4.', 'week5.') THEN substr(c, 7) WHEN starts_with(c, 'langsmith.') THEN substr(c, 11) ELSE c END AS tail FROM ids),
fields(f) AS (VALUES ('facts'), ('facts.score'), ('refs.known'), ('duration.min'), ('runner.schema.required'), ('cross.ingest'), ('order'), ('score'), ('known'))
SELECT c AS check_id, f AS field FROM t, fields WHERE CASE
  WHEN f = 'runner.schema.required' AND starts_with(c, 'runner.schema.required.') THEN true WHEN f = 'cross.ingest' AND starts_with(c, 'cross.ingest.') THEN true
  WHEN tail = f OR starts_with(tail, f || '.') THEN true WHEN starts_with(tail, split_part(f, '.', 1) || '.') THEN true ELSE strpos(c, f) > 0 END""",
}
