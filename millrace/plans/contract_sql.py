"""The contract queries in DuckDB's SQL."""

from __future__ import annotations

from .general_sql import instant_sql

_UUID = "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}\\n?$"
_SEMVER = "^[0-9]+\\.[0-9]+\\.[0-9]+(-[0-9A-Za-z.-]+)?(\\+[0-9A-Za-z.-]+)?\\n?$"
_ISO = (
    "^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{8}|[0-9]{4}-W[0-9]{2}(-[0-9])?|[0-9]{4}W[0-9]{2}([0-9])?)"
    "([T ]([0-9]{2}(:?[0-9]{2}(:?[0-9]{2}([.,][0-9]{1,9})?)?)?)(Z|[+-][0-9]{2}(:?[0-9]{2}(:?[0-9]{2}(\\.[0-9]+)?)?)?)?)?$"
)


def _bad(c: str, pattern: str) -> str:
    return f"NOT regexp_matches(coalesce({c}, 'None'), '{pattern}')"


def _zoned(c: str) -> str:
    return f"coalesce(regexp_matches({c}, '[T ].*(Z|[+-][0-9]{{2}}(:?[0-9]{{2}})?)$'), false)"


def _moment(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '{_ISO}') THEN ({instant_sql(c)}) END"


def _unit(c: str) -> str:
    return f"coalesce(isnan(CAST({c} AS DOUBLE)) OR ({c} >= 0 AND {c} <= 1), false)"


def _results(table: str, clauses: list[tuple[str, str, str, str, str]], only_failing: tuple[str, ...] = ()) -> str:
    """One row per clause ``(check_id, check_type, violations as a number, severity, failing status)``."""
    parts = []
    for i, t, v, severity, status in clauses:
        n = f"coalesce(sum(CAST({v} AS BIGINT)), 0)"
        having = f" HAVING {n} > 0" if i in only_failing else ""
        parts.append(
            f"SELECT '{i}' AS check_id, '{t}' AS check_type, CASE WHEN {n} > 0 THEN '{status}' ELSE 'PASS' END AS status, "
            f"CASE WHEN {n} > 0 THEN '{severity}' ELSE 'LOW' END AS severity, CAST({n} AS BIGINT) AS records_failing FROM {table}{having}"
        )
    return " UNION ALL ".join(parts)


def _in(c: str, members: str) -> str:
    return f"coalesce({c}, 'None') NOT IN ({members})"


def _count(array: str, each: str, bad: str) -> str:
    return f"coalesce(len([1 FOR {each} IN {array} IF {bad}]), 0)"


# The ids of the checks, and what they compare with.
_VERDICTS = _results("verdicts", [
    ("week2.overall_verdict.enum", "enum", _in("overall_verdict", "'PASS','FAIL','WARN'"), "CRITICAL", "FAIL"),
    ("week2.scores.criterion.range", "range", _count("map_values(scores)", "s", "s.score IS NOT NULL AND NOT s.score BETWEEN 1 AND 5"), "CRITICAL", "FAIL"),
    ("week2.overall_score.weighted_mean", "computed",
     "coalesce(CASE WHEN cardinality(scores) > 0 AND len([1 FOR s IN map_values(scores) IF coalesce(s.score BETWEEN 1 AND 5, false)]) = cardinality(scores) "
     "THEN abs(overall_score - list_sum([CAST(s.score AS DOUBLE) FOR s IN map_values(scores)]) / cardinality(scores)) > 0.05 END, false)", "CRITICAL", "FAIL"),
    ("week2.rubric_version.semver", "semver", _bad("rubric_version", _SEMVER), "CRITICAL", "FAIL"),
    ("week2.confidence.range", "range", f"NOT {_unit('confidence')}", "CRITICAL", "FAIL"),
])

_EXTRACTIONS = _results("extractions", [
    ("week3.doc_id.uuid", "format", _bad("doc_id", _UUID), "CRITICAL", "FAIL"),
    ("week3.source_hash.pattern", "pattern", _bad("source_hash", "^[a-f0-9]{64}\\n?$"), "CRITICAL", "FAIL"),
    ("week3.extracted_facts.non_empty", "array", "coalesce(len(extracted_facts), 0) < 1", "CRITICAL", "FAIL"),
    ("week3.extracted_facts.confidence.range", "range", _count("extracted_facts", "f", f"NOT {_unit('f.confidence')}"), "CRITICAL", "FAIL"),
    ("week3.extracted_facts.entity_refs.relationship", "relationship",
     "coalesce(len([1 FOR r IN flatten([coalesce(f.entity_refs, []) FOR f IN extracted_facts]) IF r IS NULL OR NOT coalesce(list_contains([e.entity_id FOR e IN entities], r), false)]), 0)", "CRITICAL", "FAIL"),
    ("week3.entities.type.enum", "enum", _count("entities", "e", _in("e.type", "'PERSON','ORG','LOCATION','DATE','AMOUNT','OTHER'")), "CRITICAL", "FAIL"),
    ("week3.processing_time_ms.positive", "range", "NOT coalesce(processing_time_ms > 0, false)", "CRITICAL", "FAIL"),
    ("week3.extraction_model.pattern", "pattern", _bad("extraction_model", "^(claude|gpt)-"), "CRITICAL", "FAIL"),
])


def _lineage(table: str) -> str:
    ids = "[n.node_id FOR n IN nodes]"
    return _results(table, [
        ("week4.snapshot_id.uuid", "format", _bad("snapshot_id", _UUID), "CRITICAL", "FAIL"),
        ("week4.git_commit.hex40", "pattern", _bad("git_commit", "^[a-f0-9]{40}\\n?$"), "CRITICAL", "FAIL"),
        ("week4.nodes.type.enum", "enum", _count("nodes", "n", _in("n.type", "'FILE','TABLE','SERVICE','MODEL','PIPELINE','EXTERNAL'")), "CRITICAL", "FAIL"),
        ("week4.edges.endpoints", "reference", _count("edges", "e", f"NOT (coalesce(list_contains({ids}, e.source), false) AND coalesce(list_contains({ids}, e.target), false))"), "CRITICAL", "FAIL"),
        ("week4.edges.relationship.enum", "enum", _count("edges", "e", _in("e.relationship", "'IMPORTS','CALLS','READS','WRITES','PRODUCES','CONSUMES'")), "CRITICAL", "FAIL"),
        ("week4.edges.confidence.range", "range", _count("edges", "e", f"NOT {_unit('e.confidence')}"), "CRITICAL", "FAIL"),
        ("week4.captured_at.iso8601", "format", f"({_moment('captured_at')}) IS NULL", "CRITICAL", "FAIL"),
    ])


def _order(a: str, b: str, sign: str) -> str:
    return f"NOT coalesce(({_moment(b)}) {sign} ({_moment(a)}) AND {_zoned(a)} = {_zoned(b)}, false)"


_EVENTS = _results("event_log", [
    ("week5.event_type.pascal", "pattern", _bad("event_type", "^[A-Z][a-zA-Z0-9]*\\n?$"), "CRITICAL", "FAIL"),
    ("week5.recorded_at.order", "temporal", _order("occurred_at", "recorded_at", ">="), "CRITICAL", "FAIL"),
    ("week5.payload.bytes.minimum", "range", "coalesce(payload.bytes < 0, false)", "CRITICAL", "FAIL"),
])
_RUNS = _results("runs", [
    ("langsmith.id.uuid", "format", _bad("id", _UUID), "CRITICAL", "FAIL"),
    ("langsmith.run_type.enum", "enum", _in("run_type", "'llm','chain','tool','retriever','embedding'"), "CRITICAL", "FAIL"),
    ("langsmith.end_time.after_start", "temporal", _order("start_time", "end_time", ">"), "CRITICAL", "FAIL"),
    ("langsmith.total_tokens.sum", "identity", "NOT coalesce(total_tokens = prompt_tokens + completion_tokens, false)", "CRITICAL", "FAIL"),
    ("langsmith.total_cost.non_negative", "range", "NOT coalesce(isnan(total_cost) OR total_cost >= 0, false)", "CRITICAL", "FAIL"),
])
_STAR = " UNION ALL ".join([
    _results("orders", [
        ("orders.o_custkey.required", "required", "o_custkey IS NULL", "CRITICAL", "ERROR"), ("orders.o_orderstatus.enum", "enum", _in("o_orderstatus", "'O','F'"), "HIGH", "FAIL"),
        ("orders.o_totalprice.range", "range", "NOT coalesce(o_totalprice BETWEEN 0 AND 250000, false)", "MEDIUM", "FAIL"), ("orders.o_orderpriority.pattern", "pattern", _bad("o_orderpriority", "^[1-5]-"), "LOW", "FAIL"),
    ]),
    _results("lineitem", [
        ("lineitem.l_discount.range", "range", "NOT coalesce(l_discount BETWEEN 0 AND 0.05, false)", "HIGH", "FAIL"), ("lineitem.l_quantity.positive", "range", "NOT coalesce(l_quantity > 0, false)", "CRITICAL", "FAIL"),
        ("lineitem.l_returnflag.enum", "enum", _in("l_returnflag", "'A','N','R'"), "MEDIUM", "FAIL"), ("lineitem.l_linestatus.enum", "enum", _in("l_linestatus", "'F'"), "LOW", "FAIL"),
    ]),
    _results("customer", [
        ("customer.c_name.pattern", "pattern", _bad("c_name", "^Customer#[0-9]{9}\\n?$"), "MEDIUM", "FAIL"), ("customer.c_acctbal.non_negative", "range", "NOT coalesce(c_acctbal >= 0, false)", "HIGH", "FAIL"),
    ]),
])


def _breaks(table: str, key: str, s: str) -> str:
    return f"""
SELECT {key}, CAST(sum(CASE WHEN before IS NOT NULL AND s <> before + 1 THEN 1 ELSE 0 END + CASE WHEN again > 1 THEN 1 ELSE 0 END) AS BIGINT) AS breaks
FROM (SELECT {key}, s, lag(s) OVER (PARTITION BY {key} ORDER BY s, again) AS before, again
      FROM (SELECT coalesce(CAST({key} AS VARCHAR), 'None') AS {key}, {s} AS s, row_number() OVER (PARTITION BY {key}, {s} ORDER BY {s}) AS again FROM {table} WHERE {s} IS NOT NULL) x) y
GROUP BY {key}"""


def _required(table: str, columns: str, rows: str) -> str:
    return _results(rows, [(f"runner.schema.required.{c}", "required_field", f"{c} IS NULL", "CRITICAL", "ERROR") for c in columns.split()], tuple(f"runner.schema.required.{c}" for c in columns.split()))


_PROFILE = "min({0}) AS min, max({0}) AS max, round(avg({0}), 6) AS mean, round(stddev_pop({0}), 6) AS stddev, " + ", ".join(
    f"round(quantile_cont({{0}}, {q / 100}), 6) AS p{q}" for q in (25, 50, 75, 95, 99)
)


def _drift(now: str, base: str, keys: str, more: str = "") -> str:
    k = [x.strip() for x in keys.split(",")]
    on = " AND ".join(f"n.{x} = b.{x}" for x in k)
    sigma = "abs(coalesce(n.mean, 0) - b.mean) / greatest(b.std, 1e-9)"
    return f"""
SELECT {', '.join(f'n.{x} AS {x}' for x in k)}, {more} round(coalesce(n.mean, 0), 6) AS mean, round(coalesce(n.std, 0), 6) AS std, round({sigma}, 6) AS sigma,
  CASE WHEN {sigma} > 3 THEN 'FAIL' WHEN {sigma} > 2 THEN 'WARN' ELSE 'PASS' END AS status, CASE WHEN {sigma} > 3 THEN 'HIGH' WHEN {sigma} > 2 THEN 'MEDIUM' ELSE 'LOW' END AS severity
FROM ({now}) n LEFT JOIN ({base}) b ON {on}"""


_RANK = "CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 3 WHEN 'WARNING' THEN 4 ELSE 99 END"
_LOSS = "CASE severity WHEN 'CRITICAL' THEN 20.0 WHEN 'HIGH' THEN 10.0 WHEN 'MEDIUM' THEN 5.0 ELSE 1.0 END"
_WEIGHT = "CASE WHEN starts_with(check_id, 'lineitem.l_discount') THEN 1.5 WHEN starts_with(check_id, 'lineitem.') THEN 2.0 WHEN starts_with(check_id, 'orders.') THEN 0.5 ELSE 1.0 END"
_GRAPH = """
edges AS (
  SELECT 'r' || n_regionkey AS source, 'n' || n_nationkey AS target FROM nation
  UNION SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer UNION SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier),
nodes AS (
  SELECT 'r' || r_regionkey AS node_id, 'FILE' AS type FROM region UNION ALL SELECT 'n' || n_nationkey, 'PIPELINE' FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'FILE' FROM customer UNION ALL SELECT 's' || s_suppkey, 'TABLE' FROM supplier)"""
_UP = f"""
WITH RECURSIVE {_GRAPH},
walk AS (SELECT 's' || s_suppkey AS start, 's' || s_suppkey AS node, CAST(0 AS BIGINT) AS hops FROM supplier UNION SELECT w.start, e.source, w.hops + 1 FROM walk w JOIN edges e ON e.target = w.node),
near AS (SELECT start, node, min(hops) AS hops FROM walk GROUP BY start, node),
ranked AS (SELECT start, node, hops, row_number() OVER (PARTITION BY start ORDER BY hops, node) AS rank FROM near JOIN nodes ON node_id = node WHERE type = 'FILE' AND hops >= 1)"""
_DATED = "ts < TIMESTAMP '2024-01-16'"
_TOUCHES = """
(tail = f OR starts_with(tail, f || '.') OR starts_with(tail, split_part(f, '.', 1) || '.') OR contains(check_id, f))"""
_SUBS = """(VALUES ('alder-intake-terms','sub-a','facts'), ('alder-intake-terms','sub-a','refs.known'), ('alder-intake-terms','sub-b','duration'),
 ('dogwood-map-terms','sub-b','links.known'), ('birch-bench-terms','sub-c','marks.bounds'), ('elm-log-terms','sub-c','order')) s(contract_id, subscriber_id, f)"""
_KIND = "CASE json_type(value) WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'DOUBLE' THEN 'DECIMAL' ELSE json_type(value) END"

SQL = {
    "checks_verdicts": _VERDICTS,
    "checks_extractions": _EXTRACTIONS,
    "checks_lineage": _lineage("lineage_snapshots"),
    "checks_lineage_latest": _lineage("(SELECT * FROM lineage_snapshots ORDER BY received_at DESC, snapshot_id DESC LIMIT 1)"),
    "checks_events": _EVENTS,
    "checks_runs": _RUNS,
    "star_checks": _STAR,
    "unique_doc_id": _results("(SELECT coalesce(doc_id, 'None') AS k FROM extractions GROUP BY 1 HAVING count(*) > 1)", [("week3.doc_id.unique", "unique", "1", "CRITICAL", "FAIL")]),
    "sequence_events": _results(f"({_breaks('event_log', 'aggregate_id', 'sequence_number')})", [("week5.sequence_number.monotonic", "ordering", "breaks", "CRITICAL", "FAIL")]),
    "sequence_breaks_by_aggregate": f"SELECT * FROM ({_breaks('event_log', 'aggregate_id', 'sequence_number')}) b WHERE breaks > 0",
    "cross_doc_as_node": "SELECT DISTINCT doc_id FROM extractions WHERE 'table::doc:' || doc_id NOT IN (SELECT n.node_id FROM (SELECT unnest(nodes) AS n FROM lineage_snapshots) x WHERE n.node_id IS NOT NULL)",
    "cross_verdict_targets": "SELECT verdict_id, target_ref FROM verdicts v WHERE NOT EXISTS (SELECT 1 FROM (SELECT unnest(nodes) AS n FROM lineage_snapshots) x WHERE n.type = 'FILE' AND regexp_replace(n.node_id, '^file::', '') = v.target_ref)",
    "required_fields": _required("demo_blame", "delivery_id batch_id violation_id type check_id detected_at severity source_contract_id message records_failing blame_hint blame_chain blast_radius", "demo_blame"),
    "required_fields_first_200": _required("runs", "id name run_type inputs outputs error start_time end_time total_tokens prompt_tokens completion_tokens total_cost tags parent_run_id session_id", "(SELECT * FROM runs ORDER BY id LIMIT 200)"),
    "enum_lang": "SELECT lang, count(*) AS n FROM documents WHERE lang IS NULL OR lang NOT IN ('en','de','es') GROUP BY lang",
    "unique_document_text": "SELECT sha256(text) AS text_sha256, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "unique_lineitem_key": "SELECT count(*) AS repeated_keys, CAST(sum(n) AS BIGINT) AS rows_affected FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) x",
    "temporal_ship_after_order": "SELECT count(*) FILTER (l_shipdate < o_orderdate) AS before, count(*) FILTER (l_shipdate <= o_orderdate) AS not_after FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "identity_n_chars": _results("documents", [("documents.n_chars.identity", "identity", "NOT coalesce(n_chars = length(coalesce(text, '')), false)", "CRITICAL", "FAIL")]),
    "identity_tokens": "SELECT id, total_tokens, prompt_tokens, completion_tokens FROM runs WHERE NOT coalesce(total_tokens = prompt_tokens + completion_tokens, false)",
    "computed_order_total": "SELECT count(*) AS orders, count(*) FILTER (abs(o_totalprice - lines) > 0.05) AS differ FROM orders JOIN (SELECT l_orderkey, sum(l_extendedprice) AS lines FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey",
    "sequence_lines": f"SELECT CAST(sum(breaks) AS BIGINT) AS breaks FROM ({_breaks('lineitem', 'l_orderkey', 'l_linenumber')}) b",
    "ref_unlabelled_documents": "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM subject_labels l WHERE l.doc_id = d.doc_id)",
    "ref_derived_key": "SELECT o_custkey, count(*) AS orders FROM orders WHERE 'c:' || o_custkey NOT IN (SELECT 'c:' || c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1",
    "semi_labelled_documents": "SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM subject_labels)",
    "json_payload_range": "SELECT event_type, count(*) FILTER (NOT coalesce(k BETWEEN 0 AND 5, false)) AS outside, min(k) AS least, max(k) AS greatest FROM (SELECT event_type, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) x GROUP BY 1",
    "json_schema_payload": "SELECT event_type, count(*) AS n, count(*) FILTER (payload IS NULL OR payload.doc_id IS NULL OR payload.status IS NULL OR payload.status NOT IN ('filed','waiting','broken') OR coalesce(payload.bytes < 100, false)) AS invalid FROM event_log GROUP BY 1",
    "quality_rules": """
SELECT r.rule AS rule, CASE WHEN coalesce(r.ok, r.observed IS NULL) THEN 'PASS' ELSE 'FAIL' END AS status, CAST(r.observed AS DOUBLE) AS observed FROM (
  SELECT unnest([
    {'rule': 'row_count >= 1', 'observed': CAST(n AS DOUBLE), 'ok': n >= 1}, {'rule': 'missing_count(processing_time_ms) = 0', 'observed': CAST(np AS DOUBLE), 'ok': np = 0},
    {'rule': 'duplicate_count(doc_id) = 0', 'observed': CAST(dup AS DOUBLE), 'ok': dup = 0}, {'rule': 'min(processing_time_ms) >= 1', 'observed': CAST(mn AS DOUBLE), 'ok': mn >= 1},
    {'rule': 'max(processing_time_ms) <= 60000', 'observed': CAST(mx AS DOUBLE), 'ok': mx <= 60000}, {'rule': 'missing_count(extracted_facts[*].confidence) = 0', 'observed': CAST(nc AS DOUBLE), 'ok': nc = 0},
    {'rule': 'max(extracted_facts[*].confidence) <= 1', 'observed': mc, 'ok': mc <= 1}, {'rule': 'max(cardinality(extracted_facts)) >= 1', 'observed': CAST(ml AS DOUBLE), 'ok': ml >= 1},
    {'rule': 'token_count.input >= token_count.output', 'observed': CAST(lt AS DOUBLE), 'ok': lt = 0}, {'rule': 'extraction_model in {refiner-layout-1, refiner-layout-2}', 'observed': CAST(nm AS DOUBLE), 'ok': nm = 0},
    {'rule': 'max(token_count.input) >= min(token_count.output)', 'observed': CAST(ti AS DOUBLE), 'ok': ti >= tn}]) AS r
  FROM (SELECT count(*) AS n, count(*) FILTER (processing_time_ms IS NULL) AS np, count(doc_id) - count(DISTINCT doc_id) AS dup, min(processing_time_ms) AS mn, max(processing_time_ms) AS mx,
          sum(coalesce(len([1 FOR f IN extracted_facts IF f.confidence IS NULL]), 0)) AS nc, max(list_max([f.confidence FOR f IN extracted_facts])) AS mc, max(coalesce(len(extracted_facts), 0)) AS ml,
          count(*) FILTER (NOT coalesce(token_count.input >= token_count.output, false)) AS lt, count(*) FILTER (NOT coalesce(extraction_model IN ('refiner-layout-1','refiner-layout-2'), false)) AS nm,
          max(token_count.input) AS ti, min(token_count.output) AS tn FROM extractions) a) b""",
    "profile_event_value": f"SELECT event_type, count(value) AS n, {_PROFILE.format('value')} FROM events WHERE value IS NOT NULL GROUP BY 1",
    "profile_confidence": f"SELECT count(c) AS n, {_PROFILE.format('c')} FROM (SELECT f.confidence AS c FROM (SELECT unnest(extracted_facts) AS f FROM extractions) x) y WHERE c IS NOT NULL",
    "flattened_profile_rows": "SELECT doc_id, source_hash, f.confidence AS fact_confidence, f.fact_id AS fact_id, CAST(coalesce(len(f.entity_refs), 0) AS BIGINT) AS entity_count FROM (SELECT doc_id, source_hash, unnest(extracted_facts) AS f FROM extractions) x",
    "drift_event_value": _drift(f"SELECT event_type, avg(value) AS mean, stddev_pop(value) AS std FROM events WHERE NOT {_DATED} GROUP BY 1", f"SELECT event_type, avg(value) AS mean, stddev_pop(value) AS std FROM events WHERE {_DATED} GROUP BY 1", "event_type"),
    "drift_processing_time": _drift("SELECT 'processing_time_ms' AS metric, load_id, avg(processing_time_ms) AS mean, stddev_pop(processing_time_ms) AS std FROM extractions GROUP BY load_id",
                                    "SELECT 'processing_time_ms' AS metric, avg(processing_time_ms) AS mean, stddev_pop(processing_time_ms) AS std FROM extractions WHERE loaded_at < TIMESTAMP '2017-01-09'", "metric", "n.load_id AS load_id,"),
    "scale_injection": "SELECT d.*, o.outside FROM (" + _drift("SELECT state, avg(v) AS mean, stddev_pop(v) AS std FROM (SELECT 'before' AS state, l_discount AS v FROM lineitem UNION ALL SELECT 'after', CASE WHEN l_discount > 0 AND l_discount <= 1 THEN round(l_discount * 100, 1) ELSE l_discount END FROM lineitem) x GROUP BY 1",
                        "SELECT s AS state, mean, std FROM (SELECT avg(l_discount) AS mean, stddev_pop(l_discount) AS std FROM lineitem) a, (VALUES ('before'), ('after')) t(s)", "state") + """) d JOIN (SELECT state, count(*) FILTER (NOT (v >= 0 AND v <= 1)) AS outside FROM (SELECT 'before' AS state, l_discount AS v FROM lineitem UNION ALL SELECT 'after', CASE WHEN l_discount > 0 AND l_discount <= 1 THEN round(l_discount * 100, 1) ELSE l_discount END FROM lineitem) x GROUP BY 1) o ON o.state = d.state""",
    "violation_rate_trend": f"SELECT failures, round(rate, 6) AS rate, CASE WHEN rate > 0.015 AND rate > 0.011 THEN 'rising' ELSE 'stable' END AS trend, CASE WHEN rate > 0.015 AND rate > 0.011 THEN 'WARN' ELSE 'PASS' END AS status FROM (SELECT count(*) FILTER (NOT {_unit('confidence')}) AS failures, count(*) FILTER (NOT {_unit('confidence')}) / greatest(count(*), 1) AS rate FROM verdicts) x",
    "embedding_centroid": "SELECT CAST(i - 1 AS BIGINT) AS dim, round(avg(CAST(x AS DOUBLE)), 6) AS mean FROM (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) e GROUP BY i",
    "embedding_drift": """
WITH e AS (SELECT label % 2 AS half, i, avg(CAST(x AS DOUBLE)) AS mean FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) y GROUP BY 1, 2),
s AS (SELECT sum(a.mean * b.mean) AS ab, sum(a.mean * a.mean) AS aa, sum(b.mean * b.mean) AS bb FROM e a JOIN e b ON a.i = b.i AND a.half = 0 AND b.half = 1),
d AS (SELECT round(1 - ab / ((sqrt(aa) + 1e-9) * (sqrt(bb) + 1e-9)), 4) AS drift FROM s)
SELECT drift, CASE WHEN drift > 0.15 THEN 'FAIL' WHEN drift IS NULL THEN 'WARN' ELSE 'PASS' END AS status FROM d""",
    "hash_token_buckets": "SELECT CAST(('0x' || substr(md5(t), 1, 8)) AS BIGINT) % 384 AS bucket, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(f.text), '[a-z0-9_]{2,}')) AS t FROM (SELECT unnest(extracted_facts) AS f FROM extractions) x) y GROUP BY 1",
    "lineage_upstream": f"{_UP} SELECT start, node, hops, rank FROM ranked WHERE rank <= 5",
    "blast_radius": f"""
WITH RECURSIVE {_GRAPH},
walk AS (SELECT node_id AS start, node_id AS node, CAST(0 AS BIGINT) AS hops FROM nodes WHERE node_id LIKE 'r%' OR node_id LIKE 'n%' UNION SELECT w.start, e.target, w.hops + 1 FROM walk w JOIN edges e ON e.source = w.node),
near AS (SELECT start, node, min(hops) AS hops FROM walk GROUP BY start, node)
SELECT start, max(hops) AS depth, count(*) FILTER (type = 'FILE' AND hops > 0) AS files, count(*) FILTER (type IN ('PIPELINE','MODEL') AND hops > 0) AS pipelines FROM near JOIN nodes ON node_id = node GROUP BY start""",
    "blame_score": f"""{_UP},
dated AS (SELECT r.*, greatest(0, date_diff('day', DATE '2024-01-01' + CAST(substr(node, 2) AS INTEGER), DATE '2024-01-06')) AS days FROM ranked r WHERE rank <= 5)
SELECT CAST(substr(start, 2) AS BIGINT) AS violation_id, node, hops, CAST(days AS BIGINT) AS days, greatest(0.0, round(1 - 0.1::DOUBLE * days - 0.2::DOUBLE * hops, 4)) AS score FROM dated""",
    "downstream_consumers": "SELECT consumer, count(*) AS edges FROM (SELECT CASE WHEN starts_with(e.target, 'table::') THEN 'table::*' ELSE e.target END AS consumer FROM (SELECT unnest(edges) AS e FROM lineage_snapshots) x WHERE e.target IS NOT NULL) y GROUP BY 1",
    "registry_match": f"""
WITH v AS (SELECT delivery_id AS violation_id, source_contract_id AS contract_id, lower(trim(check_id)) AS check_id FROM demo_blame WHERE violation_id IS NOT NULL AND check_id IS NOT NULL),
t AS (SELECT *, substr(check_id, strpos(check_id, '.') + 1) AS tail FROM v)
SELECT violation_id, subscriber_id, string_agg(DISTINCT f, ',' ORDER BY f) AS fields FROM t JOIN {_SUBS} ON s.contract_id = t.contract_id AND {_TOUCHES} GROUP BY 1, 2""",
    "schema_diff_paths": """
SELECT * FROM (VALUES ('confidence', 'scale_changed', 'maximum', true), ('doc_id', 'changed', 'type', true), ('extra', 'added', NULL, false), ('facts.items.properties.page', 'removed', NULL, true),
  ('facts.items.properties.text', 'changed', 'maxLength', true), ('gone', 'removed', NULL, true), ('must', 'added', NULL, true)) t(path, change, attribute, breaking)""",
    "status_counts": f"SELECT count(*) AS total_checks, count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'WARN') AS warned, count(*) FILTER (status = 'FAIL') AS failed, count(*) FILTER (status = 'ERROR') AS errored FROM ({_STAR}) r",
    "severity_counts": f"SELECT severity, count(*) AS n FROM ({_STAR}) r WHERE status IN ('FAIL','ERROR') GROUP BY 1",
    "health_score": f"SELECT count(*) AS failing, greatest(0.0, least(100.0, round(100 - coalesce(sum(CAST({_LOSS} AS DOUBLE)), 0), 2))) AS score FROM ({_STAR}) r WHERE status IN ('FAIL','ERROR')",
    "type_weighted_score": f"SELECT count(*) AS failing, greatest(0.0, least(100.0, round(100 - coalesce(sum(CAST({_LOSS} AS DOUBLE) * {_WEIGHT}), 0), 2))) AS score FROM ({_STAR}) r WHERE status IN ('FAIL','ERROR')",
    "pass_rate": f"SELECT round(100.0::DOUBLE * count(*) FILTER (status = 'PASS') / greatest(1, count(*)), 2) AS pass_rate FROM ({_STAR}) r",
    "worst_per_check": f"SELECT check_id, severity, records_failing, delivery_id FROM (SELECT lower(trim(check_id)) AS check_id, severity, records_failing, delivery_id, row_number() OVER (PARTITION BY lower(trim(check_id)) ORDER BY {_RANK}, -records_failing NULLS FIRST, delivery_id) AS r FROM demo_blame WHERE check_id IS NOT NULL) x WHERE r = 1",
    "prioritized_page": f"""
WITH rows AS (SELECT lower(trim(check_id)) AS check_id, coalesce(source_contract_id, '?') AS column_name, severity, records_failing, {_RANK} AS r FROM demo_blame WHERE check_id IS NOT NULL AND records_failing IS NOT NULL),
firsts AS (SELECT *, row_number() OVER (PARTITION BY check_id, column_name ORDER BY r, -records_failing, severity) AS k FROM rows),
placed AS (SELECT check_id, column_name, severity, records_failing, row_number() OVER (ORDER BY r, records_failing DESC, check_id, column_name) AS position, count(*) OVER () AS whole FROM firsts WHERE k = 1)
SELECT check_id, column_name, severity, records_failing, position, greatest(1, CAST(ceil(whole / 5.0) AS BIGINT)) AS total_pages FROM placed WHERE position BETWEEN 6 AND 10""",
    "top_samples": f"""
SELECT check_id, coalesce(string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey), '') AS samples FROM (VALUES ('customer.c_name.pattern'), ('customer.c_acctbal.non_negative')) t(check_id)
LEFT JOIN (SELECT * FROM (SELECT 'customer.c_name.pattern' AS k, c_custkey, row_number() OVER (ORDER BY c_custkey) AS r FROM customer WHERE {_bad('c_name', '^Customer#[0-9]{9}$')}) a WHERE r <= 5
  UNION ALL SELECT * FROM (SELECT 'customer.c_acctbal.non_negative', c_custkey, row_number() OVER (ORDER BY c_custkey) AS r FROM customer WHERE NOT coalesce(c_acctbal >= 0, false)) b WHERE r <= 5) s ON s.k = t.check_id GROUP BY 1""",
    "dedupe_log": "SELECT delivery_id, check_id, violation_id FROM (SELECT delivery_id, check_id, violation_id, row_number() OVER (PARTITION BY check_id, violation_id ORDER BY delivery_id) AS r FROM demo_blame) x WHERE r = 1 OR check_id IS NULL OR violation_id IS NULL",
    "subscriber_impact": "SELECT count(*) FILTER (n > 0) AS violations_with_subscribers, coalesce(max(n), 0) AS most, CAST(coalesce(sum(n), 0) AS BIGINT) AS total FROM (SELECT coalesce(len(blast_radius.subscribers), 0) AS n FROM demo_blame) x",
    "quarantine_prompts": "SELECT load_id, count(*) AS quarantined FROM extractions WHERE coalesce(source_path, '') = '' OR NOT length(coalesce(extracted_facts[1].text, '')) BETWEEN 10 AND 60 GROUP BY 1",
    "repaired_facts": """
SELECT doc_id, load_id, f.fact_id AS fact_id, round(greatest(0.0, least(1.0, CASE WHEN f.confidence > 1 THEN f.confidence / 100 ELSE f.confidence END)), 4) AS confidence,
  CAST(coalesce(len([1 FOR r IN f.entity_refs IF coalesce(list_contains(ids, r), false)]), 0) AS BIGINT) AS refs
FROM (SELECT doc_id, load_id, [e.entity_id FOR e IN entities] AS ids, unnest(extracted_facts) AS f FROM extractions) x""",
    "tumbling_event_counts": "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2",
    "snapshot_pairs": "SELECT codebase_root, snapshot_id, age FROM (SELECT codebase_root, snapshot_id, row_number() OVER (PARTITION BY codebase_root ORDER BY received_at DESC) AS age FROM lineage_snapshots) x WHERE age <= 2",
    "declared_contract": _results("extractions", [
        ("extractions.doc_id.required", "required", "doc_id IS NULL", "CRITICAL", "ERROR"), ("extractions.doc_id.minLength", "size", "coalesce(length(doc_id) < 36, false)", "CRITICAL", "FAIL"), ("extractions.doc_id.maxLength", "size", "coalesce(length(doc_id) > 36, false)", "CRITICAL", "FAIL"),
        ("extractions.source_hash.required", "required", "source_hash IS NULL", "CRITICAL", "ERROR"), ("extractions.source_hash.pattern", "pattern", "coalesce(NOT regexp_matches(source_hash, '^[a-f0-9]{64}$'), false)", "CRITICAL", "FAIL"),
        ("extractions.processing_time_ms.required", "required", "processing_time_ms IS NULL", "CRITICAL", "ERROR"), ("extractions.processing_time_ms.minimum", "range", "coalesce(processing_time_ms < 1, false)", "CRITICAL", "FAIL"),
        ("extractions.processing_time_ms.maximum", "range", "coalesce(processing_time_ms > 20000, false)", "CRITICAL", "FAIL"),
        ("extractions.extraction_model.enum", "enum", "coalesce(extraction_model NOT IN ('refiner-layout-1','refiner-layout-2','refiner-vision-1'), false)", "CRITICAL", "FAIL"),
        ("extractions.token_count.input.required", "required", "token_count IS NOT NULL AND token_count.input IS NULL", "CRITICAL", "ERROR"), ("extractions.token_count.input.minimum", "range", "coalesce(token_count.input < 1, false)", "CRITICAL", "FAIL"),
        ("extractions.extracted_facts.minItems", "size", "coalesce(len(extracted_facts) < 1, false)", "CRITICAL", "FAIL"),
        ("extractions.extracted_facts[].confidence.required", "required", _count("extracted_facts", "f", "f.confidence IS NULL"), "CRITICAL", "ERROR"),
        ("extractions.extracted_facts[].confidence.minimum", "range", _count("extracted_facts", "f", "coalesce(f.confidence < 0, false)"), "CRITICAL", "FAIL"),
        ("extractions.extracted_facts[].confidence.maximum", "range", _count("extracted_facts", "f", "coalesce(f.confidence > 1, false)"), "CRITICAL", "FAIL"),
        ("extractions.extracted_facts[].text.minLength", "size", _count("extracted_facts", "f", "coalesce(length(f.text) < 1, false)"), "CRITICAL", "FAIL"),
        ("extractions.extracted_facts[].entity_refs[].required", "required", "coalesce(len([1 FOR r IN flatten([coalesce(f.entity_refs, []) FOR f IN extracted_facts]) IF r IS NULL]), 0)", "CRITICAL", "ERROR"),
    ]) + " UNION ALL " + _results("(SELECT coalesce(doc_id, 'None') AS k FROM extractions GROUP BY 1 HAVING count(*) > 1)", [("extractions.doc_id.unique", "unique", "1", "CRITICAL", "FAIL")]),
    "relational_tests": """
WITH e AS (SELECT doc_id, x.entity_id AS entity_id, x.name AS name, x.type AS type FROM (SELECT doc_id, unnest(entities) AS x FROM extractions) y)
SELECT 'not_null' AS test, 'doc_id' AS column_name, count(*) FILTER (doc_id IS NULL) AS failures FROM e UNION ALL SELECT 'not_null', 'entity_id', count(*) FILTER (entity_id IS NULL) FROM e
UNION ALL SELECT 'not_null', 'name', count(*) FILTER (name IS NULL) FROM e UNION ALL SELECT 'not_null', 'type', count(*) FILTER (type IS NULL) FROM e
UNION ALL SELECT 'accepted_values', 'type', count(*) FILTER (type NOT IN ('PERSON','ORG','LOCATION','DATE','AMOUNT','OTHER')) FROM e
UNION ALL SELECT 'unique', 'entity_id', count(*) FROM (SELECT entity_id FROM e WHERE entity_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1) t""",
    "json_schema_verdicts": """
SELECT load_id, count(*) AS n, count(*) FILTER (NOT coalesce(
  length(verdict_id) >= 36 AND overall_verdict IN ('PASS','FAIL','WARN') AND overall_score BETWEEN 1 AND 5 AND coalesce(confidence BETWEEN 0 AND 1, true) AND cardinality(scores) >= 3
  AND len([1 FOR s IN map_values(scores) IF s IS NULL OR s.score IS NULL OR NOT s.score BETWEEN 1 AND 5 OR coalesce(list_contains([e IS NULL FOR e IN s.evidence], true), false)]) = 0, false)) AS invalid FROM verdicts GROUP BY 1""",
    "drawn_contract": "SELECT * FROM (VALUES ('required', 'PASS', CAST(11 AS BIGINT)), ('range', 'PASS', CAST(16 AS BIGINT))) t(check_type, status, n)",
}
