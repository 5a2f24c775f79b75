"""Declared contracts, rules, tests of flat tables and reports in DuckDB's SQL."""

from __future__ import annotations

import re

from ..operators.declared import CONTRACTS, MODELS
from .contract_queries import _SUBSCRIPTIONS
from .contract_sql import SQL as CONTRACT
from .general_sql import SQL as GENERAL

_TABLES = {"verdicts": "verdicts", "extractions": "extractions", "snapshots": "lineage_snapshots", "events": "event_log", "runs": "runs"}


def _bad(v: str, word: str, b) -> tuple[str, str] | None:
    """``(check type, condition)`` of a keyword of a schema."""
    if word == "required":
        return ("required", f"{v} IS NULL") if b else None
    plain = {
        "minimum": ("range", f"{v} < {b}"), "maximum": ("range", f"{v} > {b}"), "minLength": ("size", f"length({v}) < {b}"), "maxLength": ("size", f"length({v}) > {b}"),
        "minItems": ("size", f"len({v}) < {b}"), "maxItems": ("size", f"len({v}) > {b}"), "pattern": ("pattern", f"NOT regexp_matches({v}, '{b}')"),
    }
    if word == "enum":
        return "enum", f"{v} NOT IN ({', '.join(repr(x) for x in b)})"
    return plain.get(word)


def _contract(name: str, table: str) -> list[str]:
    out = []

    def clause(path: str, word: str, kind: str, n: str) -> None:
        status = "ERROR" if word == "required" else "FAIL"
        out.append(
            f"SELECT '{name}.{path}.{word}' AS check_id, '{kind}' AS check_type, CASE WHEN n > 0 THEN '{status}' ELSE 'PASS' END AS status, CASE WHEN n > 0 THEN 'CRITICAL' ELSE 'LOW' END AS severity, CAST(n AS BIGINT) AS records_failing "
            f"FROM (SELECT coalesce(sum({n}), 0) AS n FROM {table}) q"
        )

    for field, spec in CONTRACTS[name].schema.items():
        for word, b in spec.items():
            if found := _bad(field, word, b):
                clause(field, word, found[0], f"CASE WHEN {found[1]} THEN 1 ELSE 0 END")
        for inner, part in spec.get("items", {}).get("properties", {}).items():
            for word, b in part.items():
                if found := _bad(f"e.{inner}", word, b):
                    clause(f"{field}[].{inner}", word, found[0], f"coalesce(len([1 FOR e IN {field} IF e IS NOT NULL AND coalesce({found[1]}, false)]), 0)")
        if spec.get("unique"):
            out.append(
                f"SELECT '{name}.{field}.unique' AS check_id, 'unique' AS check_type, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status, CASE WHEN n > 0 THEN 'CRITICAL' ELSE 'LOW' END AS severity, CAST(n AS BIGINT) AS records_failing "
                f"FROM (SELECT count(*) AS n FROM (SELECT coalesce({field}, 'None') AS k FROM {table} GROUP BY 1 HAVING count(*) > 1) d) q"
            )
    return out


def _rule(name: str, table: str, rule: str) -> str:
    def value(f: str, path: str) -> str:
        head, star, tail = path.partition("[*].")
        return f"{f}(list_{f}([e.{tail} FOR e IN {head}]))" if star else f"{f}({path})"

    if m := re.fullmatch(r"row_count >= (\d+)", rule):
        holds = f"count(*) >= {m[1]}"
    elif m := re.fullmatch(r"missing_count\((.*)\) = 0", rule):
        head, star, tail = m[1].partition("[*].")
        holds = f"coalesce(sum(coalesce(len([1 FOR e IN {head} IF e.{tail} IS NULL]), 0)), 0) = 0" if star else f"count(*) = count({m[1]})"
    elif m := re.fullmatch(r"duplicate_count\((.*)\) = 0", rule):
        holds = f"count({m[1]}) = count(DISTINCT {m[1]})"
    elif m := re.fullmatch(r"max\(cardinality\((.*)\)\) (>=) (\d+)", rule):
        holds = f"max(coalesce(len({m[1]}), 0)) >= {m[3]}"
    elif m := re.fullmatch(r"(min|max)\((.*?)\) (>=|<=) (min|max)\((.*?)\)", rule):
        holds = f"coalesce({value(m[1], m[2])} {m[3]} {value(m[4], m[5])}, {value(m[1], m[2])} IS NULL)"
    elif m := re.fullmatch(r"(min|max)\((.*)\) (>=|<=) (\S+)", rule):
        holds = f"coalesce({value(m[1], m[2])} {m[3]} {m[4]}, true)"
    elif m := re.fullmatch(r"(\w+) in \{(.*)\}", rule):
        holds = f"count(*) = count(*) FILTER ({m[1]} IN ({', '.join(repr(x.strip()) for x in m[2].split(','))}))"
    else:
        holds = f"count(*) = count(*) FILTER ({rule})"
    return f"SELECT '{name}' AS dataset, '{rule}' AS rule, CASE WHEN {holds} THEN 'PASS' ELSE 'FAIL' END AS status FROM {table}"


_FACTS = "(SELECT doc_id, unnest(extracted_facts) AS f FROM extractions)"
_MODEL_SOURCES = {
    "extractions": "extractions", "extraction_facts": f"(SELECT doc_id, f.fact_id AS fact_id, f.text AS text, f.confidence AS confidence FROM {_FACTS} a)",
    "extraction_entities": "(SELECT doc_id, f.entity_id AS entity_id, f.name AS name, f.type AS type FROM (SELECT doc_id, unnest(entities) AS f FROM extractions) a)",
    "extraction_fact_entity_refs": f"(SELECT doc_id, f.fact_id AS fact_id, unnest(f.entity_refs) AS entity_id FROM {_FACTS} a)", "events": "event_log",
    "event_payloads": "(SELECT event_id, payload.doc_id AS doc_id, payload.status AS status, payload.bytes AS bytes FROM event_log WHERE payload IS NOT NULL)",
    "event_metadata": "(SELECT event_id, metadata.correlation_id AS correlation_id, metadata.user_id AS user_id, metadata.source_service AS source_service FROM event_log WHERE metadata IS NOT NULL)",
}


def _model_tests() -> str:
    out = []
    for name, tests in MODELS.items():
        source = _MODEL_SOURCES[name]
        row = lambda test, c, n, of=source, name=name: f"SELECT '{name}' AS model, '{test}' AS test, '{c}' AS column_name, CAST({n} AS BIGINT) AS failures FROM {of} s"
        out += [row("not_null", c, f"count(*) FILTER ({c} IS NULL)") for c in tests.get("not_null", ())]
        out += [row("accepted_values", c, f"count(*) FILTER ({c} NOT IN ({', '.join(map(repr, v))}))") for c, v in tests.get("accepted", {}).items()]
        out += [row("unique", c, "count(*)", f"(SELECT {c} FROM {source} u WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)") for c in tests.get("unique", ())]
        out += [row("relationships", c, f"count(*) FILTER ({c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {_MODEL_SOURCES[o]} o WHERE {k} IS NOT NULL))") for c, (o, k) in tests.get("references", {}).items()]
    return " UNION ALL ".join(out)


_RANK = "CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 3 WHEN 'WARNING' THEN 4 ELSE 99 END"
_REPORT = f"""
WITH v AS (
  SELECT check_id, CASE WHEN coalesce(type = 'llm_output_schema', false) THEN 'verdict_record' ELSE coalesce(nullif(blame_hint.file, ''), '*') END AS field,
    CASE WHEN coalesce(type = 'llm_output_schema', false) THEN 'CRITICAL' ELSE coalesce(nullif(severity, ''), 'MEDIUM') END AS severity, coalesce(records_failing, 0) AS records_failing FROM demo_blame WHERE check_id IS NOT NULL
  UNION ALL SELECT check_id, CASE check_id WHEN 'week3.extracted_facts.confidence.range' THEN 'extracted_facts.confidence' WHEN 'week3.extracted_facts.entity_refs.relationship' THEN 'extracted_facts.entity_refs'
    WHEN 'week3.entities.type.enum' THEN 'entities.type' ELSE split_part(check_id, '.', 2) END, severity, records_failing FROM ({CONTRACT["checks_extractions"]}) c WHERE status IN ('FAIL', 'ERROR')),
first AS (SELECT *, {_RANK} AS r, row_number() OVER (PARTITION BY check_id, field ORDER BY {_RANK}, records_failing DESC, severity) AS k FROM v)
SELECT check_id, field, severity, records_failing, row_number() OVER (ORDER BY r, records_failing DESC, check_id, field) AS position FROM first WHERE k = 1"""

_SUBS = ", ".join(f"('{c}', '{s}', '{f}')" for c, s, f, _ in _SUBSCRIPTIONS)

_ORDERS = {"o_orderkey": "integer", "o_custkey": "integer", "o_orderstatus": "string", "o_totalprice": "number", "o_orderdate": "string", "o_orderpriority": "string"}


def _drawn(field: str, kind: str) -> str:
    bounds = f"CAST(min({field}) AS DOUBLE) AS minimum, CAST(max({field}) AS DOUBLE) AS maximum" if kind in ("integer", "number") else "NULL::DOUBLE AS minimum, NULL::DOUBLE AS maximum"
    return f"SELECT '{field}' AS field, '{kind}' AS type, count(*) = count({field}) AS required, {bounds} FROM orders"


SQL = {
    "drawn_fields": " UNION ALL ".join(_drawn(f, k) for f, k in _ORDERS.items()),
    "schema_diff_files": f"""
WITH f AS ({GENERAL["p7_fields"]}),
v AS (SELECT feed, file_name, lag(file_name) OVER (PARTITION BY feed ORDER BY file_name) AS former FROM (SELECT DISTINCT feed, file_name FROM f) d),
n AS (SELECT v.feed, v.file_name, field, kinds FROM v JOIN f ON f.feed = v.feed AND f.file_name = v.file_name WHERE former IS NOT NULL),
o AS (SELECT v.feed, v.file_name, field, kinds FROM v JOIN f ON f.feed = v.feed AND f.file_name = v.former WHERE former IS NOT NULL),
j AS (SELECT coalesce(n.feed, o.feed) AS feed, coalesce(n.file_name, o.file_name) AS file_name, coalesce(n.field, o.field) AS field, o.kinds AS a, n.kinds AS b FROM n FULL JOIN o ON n.feed = o.feed AND n.file_name = o.file_name AND n.field = o.field),
whole AS (SELECT * FROM j WHERE a IS NULL OR b IS NULL)
SELECT feed AS contract_id, file_name AS version, field AS path, CASE WHEN a IS NULL THEN 'added' ELSE 'removed' END AS change, NULL AS attribute, NULL AS old_value, NULL AS new_value, b IS NULL AS breaking
FROM whole w WHERE NOT EXISTS (SELECT 1 FROM whole u WHERE u.feed = w.feed AND u.file_name = w.file_name AND starts_with(w.field, u.field || '.'))
UNION ALL SELECT feed, file_name, field, 'changed', 'type', a, b, true FROM j WHERE a IS NOT NULL AND b IS NOT NULL AND a <> b""",
    "declared_contracts": " UNION ALL ".join(x for n, t in _TABLES.items() for x in _contract(n, t)),
    "declared_rules": " UNION ALL ".join(_rule(n, t, r) for n, t in _TABLES.items() for r in CONTRACTS[n].rules),
    "model_tests": _model_tests(),
    "report_rows": _REPORT,
    "report_top": f"SELECT check_id, field, severity, records_failing FROM ({_REPORT}) r WHERE position <= 3",
    "weighted_score": f"""
SELECT count(*) AS failing, greatest(0.0, least(100.0, round(100 - coalesce(sum((CASE severity WHEN 'CRITICAL' THEN 20.0 WHEN 'HIGH' THEN 10.0 WHEN 'MEDIUM' THEN 5.0 ELSE 1.0 END)::DOUBLE
  * CASE WHEN starts_with(check_id, 'week3.entities') THEN 2.0 WHEN starts_with(check_id, 'week3.') THEN 0.75 ELSE 0.5 END), 0), 2)))::DOUBLE AS score FROM ({CONTRACT["checks_extractions"]}) c WHERE status IN ('FAIL', 'ERROR')""",
    "injected_scale": """
WITH f AS (SELECT CASE WHEN c > 0 AND c <= 1 THEN round(c * 100, 1) ELSE c END AS c FROM (SELECT x.confidence AS c FROM (SELECT unnest(extracted_facts) AS x FROM extractions) a) b),
r AS (SELECT count(*) FILTER (NOT coalesce(c BETWEEN 0 AND 1, false)) AS n, abs(avg(c) - 0.75) / 0.15 AS sigma FROM f),
p AS (SELECT count(*) FILTER (NOT coalesce(processing_time_ms > 0, false)) AS n FROM extractions)
SELECT 'week3.extracted_facts.confidence.range' AS check_id, 'range' AS check_type, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status, CASE WHEN n > 0 THEN 'CRITICAL' ELSE 'LOW' END AS severity, n AS records_failing FROM r
UNION ALL SELECT 'week3.processing_time_ms.positive', 'range', CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, CASE WHEN n > 0 THEN 'CRITICAL' ELSE 'LOW' END, n FROM p
UNION ALL SELECT 'week3.extracted_facts.confidence.statistical_drift', 'drift', CASE WHEN sigma > 3 THEN 'FAIL' WHEN sigma > 2 THEN 'WARN' ELSE 'PASS' END, CASE WHEN sigma > 3 THEN 'HIGH' WHEN sigma > 2 THEN 'MEDIUM' ELSE 'LOW' END, CASE WHEN sigma > 2 THEN 1 ELSE 0 END FROM r""",
    "failure_modes": f"""
WITH reports AS (SELECT file_name || '#' || line_no AS version, CAST(raw AS JSON) AS j FROM raw_records WHERE dataset = 'schema_evolution_demo' AND json_valid(raw) AND json_type(raw) = 'OBJECT'),
c AS (SELECT version, j->>'$.contract_id' AS contract_id, unnest(CAST(json_extract(j, '$.diff.breaking_changes[*]') AS JSON[])) AS b FROM reports),
changes AS (SELECT contract_id, version, b->>'$.field' AS path, replace(replace(b->>'$.field', '.properties.', '.'), '.items.', '.') AS plain FROM c WHERE contract_id IS NOT NULL AND b->>'$.field' IS NOT NULL),
subs(contract_id, subscriber_id, field) AS (VALUES {_SUBS}),
hits AS (SELECT DISTINCT k.contract_id, version, subscriber_id, field FROM changes k JOIN subs s ON s.contract_id = k.contract_id
  WHERE contains(path, field) OR len([1 FOR i IN range(1, len(string_split(field, '.')) + 1) IF contains(plain, array_to_string(string_split(field, '.')[1:i], '.'))]) > 0),
whole AS (SELECT DISTINCT k.contract_id, version, subscriber_id FROM changes k JOIN subs s ON s.contract_id = k.contract_id),
named AS (SELECT contract_id, version, subscriber_id, string_agg(field, ',' ORDER BY field) AS fields FROM hits GROUP BY ALL)
SELECT w.contract_id, w.version, w.subscriber_id, coalesce(fields, '') AS fields, CASE WHEN fields IS NULL THEN 'no registered field is touched; run all checks again' ELSE 'checks fail on ' || replace(fields, ',', ', ') END AS mode
FROM whole w LEFT JOIN named n ON n.contract_id = w.contract_id AND n.version = w.version AND n.subscriber_id = w.subscriber_id""",
}
