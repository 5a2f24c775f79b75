"""The same results in DuckDB's SQL, where SQL can express them."""

from __future__ import annotations

from .general_problems import PATTERNS


def instant_sql(c: str) -> str:
    """Epoch microseconds of a time held as text, null where it cannot be read; without a zone it is UTC."""
    t = f"trim({c})"
    zoned = "'(Z|[+-][0-9]{2}:?[0-9]{2})$'"
    basic = f"regexp_replace({t}, '^([0-9]{{4}})([0-9]{{2}})([0-9]{{2}})T([0-9]{{2}})([0-9]{{2}})([0-9]{{2}})', '\\1-\\2-\\3T\\4:\\5:\\6')"
    cast = lambda x: f"epoch_us(try_cast(CASE WHEN regexp_matches({x}, {zoned}) THEN {x} ELSE {x} || 'Z' END AS TIMESTAMPTZ))"
    return (
        f"CASE WHEN regexp_matches({t}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ][0-9]{{2}}:[0-9]{{2}}') THEN {cast(t)} "
        f"WHEN regexp_matches({t}, '^[0-9]{{12,13}}$') THEN try_cast({t} AS BIGINT) * 1000 "
        f"WHEN regexp_matches({t}, '^[0-9]{{9,10}}$') THEN try_cast({t} AS BIGINT) * 1000000 "
        f"WHEN regexp_matches({t}, '^[0-9]{{8}}T[0-9]{{6}}') THEN {cast(basic)} END"
    )


def uuid_sql(c: str) -> str:
    t = f"lower(trim({c}))"
    d = f"regexp_replace({t}, '^urn:uuid:|^\\{{|\\}}$|-', '', 'g')"
    return f"CASE WHEN regexp_matches({d}, '^[0-9a-f]{{32}}$') THEN {d} WHEN {t} <> '' THEN 'text ' || trim({c}) END"


_PERIODS = f"""
WITH read AS (
  SELECT {uuid_sql("event_id")} AS k, aggregate_id, sequence_number AS seq, payload.status AS status,
         {instant_sql("occurred_at")} AS occ, {instant_sql("recorded_at")} AS rec
  FROM event_log),
copies AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq DESC NULLS LAST, rec DESC NULLS LAST, status DESC NULLS LAST) AS best
  FROM read WHERE k IS NOT NULL),
events AS (
  SELECT k, min(aggregate_id) AS aggregate_id, min(occ) AS occ, min(rec) AS rec,
         max(CASE WHEN best = 1 THEN seq END) AS seq, max(CASE WHEN best = 1 THEN rec END) AS srec, max(CASE WHEN best = 1 THEN status END) AS status
  FROM copies GROUP BY k),
dated AS (
  SELECT *, CAST(floor(occ / 86400000000.0) AS BIGINT) AS day FROM events WHERE occ IS NOT NULL AND rec IS NOT NULL),
late AS (
  SELECT *, rec - (day + 1) * 86400000000 AS after FROM dated),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY aggregate_id, day ORDER BY (after < 259200000000) DESC, seq DESC NULLS LAST, srec DESC NULLS LAST, status DESC NULLS LAST) AS best
  FROM late)
SELECT aggregate_id, DATE '1970-01-01' + CAST(day AS INTEGER) AS period_day,
       CAST(count(*) FILTER (after < 3600000000) AS BIGINT) AS first_events,
       CAST(count(*) FILTER (after < 259200000000) AS BIGINT) AS events,
       CAST(count(*) FILTER (after >= 259200000000) AS BIGINT) AS refused_events,
       max(CASE WHEN best = 1 AND after < 259200000000 THEN status END) AS status
FROM ranked GROUP BY aggregate_id, day"""

_KEYED = f"""
SELECT 'event_log' AS table_name, delivery_id, {uuid_sql("event_id")} AS k, NULL AS q FROM event_log
UNION ALL SELECT 'demo_blame', delivery_id, {uuid_sql("violation_id")}, lower(trim(check_id)) FROM demo_blame"""

_NODES = """
WITH RECURSIVE ids AS (
  SELECT lower(trim(id)) AS id, max(nullif(lower(trim(parent_run_id)), '')) AS parent FROM runs WHERE trim(id) <> '' GROUP BY 1),
nodes AS (SELECT a.id, b.id AS parent FROM ids a LEFT JOIN ids b ON a.parent = b.id),
tree AS (
  SELECT id, parent, id AS root, CAST(0 AS BIGINT) AS depth, [id] AS path FROM nodes WHERE parent IS NULL
  UNION ALL
  SELECT n.id, n.parent, t.root, t.depth + 1, list_append(t.path, n.id) FROM tree t JOIN nodes n ON n.parent = t.id)"""



def _values(table: str, columns: dict[str, str], source: str) -> list[str]:
    """Rows ``load_id, column_name, t, x`` of columns given as SQL; one that starts with # is a number or a size."""
    out = []
    for name, c in columns.items():
        pair = f"NULL AS t, CAST({c[1:]} AS DOUBLE) AS x" if c.startswith("#") else f"CAST({c} AS VARCHAR) AS t, NULL AS x"
        out.append(f"SELECT '{table}' AS table_name, load_id, '{name}' AS column_name, {pair} FROM {source}")
    return out


def _unnested(table: str, array: str) -> str:
    return f"(SELECT load_id, unnest({array}) AS f FROM {table}) x"


def _profile() -> str:
    facts, entities, scores = _unnested("extractions", "extracted_facts"), _unnested("extractions", "entities"), _unnested("verdicts", "map_values(scores)")
    rows = _values("extractions", {
        "doc_id": "doc_id", "source_path": "source_path", "source_hash": "source_hash", "extracted_facts": "#len(extracted_facts)", "entities": "#len(entities)",
        "extraction_model": "extraction_model", "processing_time_ms": "#processing_time_ms", "token_count": "CASE WHEN token_count IS NOT NULL THEN '' END",
        "token_count.input": "#token_count.input", "token_count.output": "#token_count.output", "extracted_at": "extracted_at",
    }, "extractions")
    rows += _values("extractions", {f"extracted_facts.{n}": c for n, c in {"fact_id": "f.fact_id", "text": "f.text", "entity_refs": "#len(f.entity_refs)", "confidence": "#f.confidence", "page_ref": "#f.page_ref", "source_excerpt": "f.source_excerpt"}.items()}, facts)
    rows += _values("extractions", {"extracted_facts.entity_refs[]": "r"}, f"(SELECT load_id, unnest(f.entity_refs) AS r FROM {facts}) y")
    rows += _values("extractions", {f"entities.{n}": f"f.{n}" for n in ("entity_id", "name", "type", "canonical_value")}, entities)
    rows += _values("verdicts", {
        "verdict_id": "verdict_id", "target_ref": "target_ref", "rubric_id": "rubric_id", "rubric_version": "rubric_version", "scores": "#cardinality(scores)",
        "overall_verdict": "overall_verdict", "overall_score": "#overall_score", "confidence": "#confidence", "evaluated_at": "evaluated_at",
    }, "verdicts")
    rows += _values("verdicts", {"scores.key": "f"}, _unnested("verdicts", "map_keys(scores)"))
    rows += _values("verdicts", {"scores.score": "#f.score", "scores.evidence": "#len(f.evidence)", "scores.notes": "f.notes"}, scores)
    rows += _values("verdicts", {"scores.evidence[]": "r"}, f"(SELECT load_id, unnest(f.evidence) AS r FROM {scores}) y")
    fits = " ".join(f"WHEN table_name = '{t}' AND column_name = '{c}' THEN regexp_matches(t, '{p}')" for t, columns in PATTERNS.items() for c, p in columns.items())
    declared = " OR ".join(f"(table_name = '{t}' AND column_name IN ({', '.join(repr(c) for c in columns)}))" for t, columns in PATTERNS.items())
    return f"""
WITH v AS ({" UNION ALL ".join(rows)}),
counts AS (SELECT table_name, load_id, column_name, t, x, count(*) AS n FROM v GROUP BY ALL),
m AS (
  SELECT table_name, load_id, column_name, CAST(sum(n) AS BIGINT) AS "values", CAST(coalesce(sum(n) FILTER (t IS NULL AND x IS NULL), 0) AS BIGINT) AS nulls,
         count(*) FILTER (t IS NOT NULL OR x IS NOT NULL) AS "distinct", min(x) AS least, max(x) AS greatest, round(sum(x * n) / sum(n) FILTER (x IS NOT NULL), 9) AS mean,
         sum(n) FILTER (t IS NOT NULL OR x IS NOT NULL) AS filled, sum(n * log2(n)) FILTER (t IS NOT NULL OR x IS NOT NULL) AS nlogn, min(t) AS least_text, max(t) AS greatest_text,
         CASE WHEN ({declared}) AND count(t) > 0 THEN CAST(coalesce(sum(n) FILTER (t IS NOT NULL AND NOT CASE {fits} END), 0) AS BIGINT) END AS malformed
  FROM counts GROUP BY table_name, load_id, column_name)
SELECT table_name, load_id, column_name, "values", nulls, "distinct", least, greatest, mean, abs(round(coalesce(log2(filled) - nlogn / filled, 0), 9)) AS entropy, least_text, greatest_text, malformed FROM m"""


SQL = {
    "p5_profile": _profile(),
    "p1_periods": _PERIODS,
    "p1_found": f"SELECT aggregate_id, strftime(period_day, '%Y-%m-%d') AS period_day FROM ({_PERIODS}) p WHERE events <> first_events",
    "p2_found": f"{_NODES} SELECT id FROM nodes WHERE id NOT IN (SELECT id FROM tree)",
    "p2_hierarchy": f"""{_NODES}, below AS (SELECT a AS id, count(*) - 1 AS n FROM (SELECT unnest(path) AS a FROM tree) p GROUP BY a)
SELECT n.id, n.parent, t.root, t.depth, CAST(b.n AS BIGINT) AS descendants, t.id IS NULL AS endless
FROM nodes n LEFT JOIN tree t ON t.id = n.id LEFT JOIN below b ON b.id = n.id""",
    "p2_descendants": f"""{_NODES}
SELECT id, descendant FROM (SELECT unnest(path) AS id, id AS descendant FROM tree) p WHERE id <> descendant""",
    "p2_paths": f"""{_NODES}, below AS (SELECT a AS id, count(*) - 1 AS n FROM (SELECT unnest(path) AS a FROM tree) p GROUP BY a)
SELECT t.id, t.parent, t.root, t.depth, array_to_string(t.path, '/') AS path, CAST(b.n AS BIGINT) AS descendants FROM tree t JOIN below b ON b.id = t.id""",
    "p3_found": f"""SELECT table_name, delivery_id FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, k, q ORDER BY delivery_id) AS n FROM ({_KEYED}) a WHERE k IS NOT NULL) b WHERE n > 1""",
    "p3_event_log_once": f"""SELECT delivery_id, batch_id, event_id, event_type, aggregate_id, sequence_number, occurred_at, recorded_at FROM event_log
WHERE delivery_id NOT IN (SELECT delivery_id FROM (SELECT delivery_id, k, row_number() OVER (PARTITION BY k ORDER BY delivery_id) AS n FROM ({_KEYED}) a WHERE table_name = 'event_log') b WHERE n > 1 AND k IS NOT NULL)""",
    "p4_found": """
SELECT DISTINCT doc_id AS record_id, f.fact_id AS from_id, r AS to_id
FROM (SELECT doc_id, entities, f, unnest(f.entity_refs) AS r FROM (SELECT doc_id, entities, unnest(extracted_facts) AS f FROM extractions) x) y
WHERE r IS NOT NULL AND NOT coalesce(list_contains([e.entity_id for e in entities], r), false)
UNION
SELECT DISTINCT snapshot_id, e.source, e.target
FROM (SELECT snapshot_id, [n.node_id for n in nodes] AS ids, unnest(edges) AS e FROM lineage_snapshots) x
WHERE (e.source IS NOT NULL AND NOT coalesce(list_contains(ids, e.source), false)) OR (e.target IS NOT NULL AND NOT coalesce(list_contains(ids, e.target), false))""",
    "p4_facts": """
SELECT load_id, doc_id, CAST(i - 1 AS INTEGER) AS pos_extracted_facts, f.fact_id AS fact_id, f.text AS text, f.confidence AS confidence, f.page_ref AS page_ref, f.source_excerpt AS source_excerpt
FROM (SELECT load_id, doc_id, unnest(extracted_facts) AS f, generate_subscripts(extracted_facts, 1) AS i FROM extractions) x""",
    "p4_entities": """
SELECT load_id, doc_id, CAST(i - 1 AS INTEGER) AS pos_entities, f.entity_id AS entity_id, f.name AS name, f.type AS type, f.canonical_value AS canonical_value
FROM (SELECT load_id, doc_id, unnest(entities) AS f, generate_subscripts(entities, 1) AS i FROM extractions) x""",
    "p4_fact_refs": """
SELECT load_id, doc_id, fact_id, CAST(i - 1 AS INTEGER) AS pos_extracted_facts, CAST(j - 1 AS INTEGER) AS pos_entity_refs, entity_id
FROM (SELECT load_id, doc_id, f.fact_id AS fact_id, i, unnest(f.entity_refs) AS entity_id, generate_subscripts(f.entity_refs, 1) AS j
      FROM (SELECT load_id, doc_id, unnest(extracted_facts) AS f, generate_subscripts(extracted_facts, 1) AS i FROM extractions) x) y""",
    "p4_nodes": """
SELECT snapshot_id, received_at, CAST(i - 1 AS INTEGER) AS pos_nodes, f.node_id AS node_id, f.type AS type, f.label AS label
FROM (SELECT snapshot_id, received_at, unnest(nodes) AS f, generate_subscripts(nodes, 1) AS i FROM lineage_snapshots) x""",
    "p4_edges": """
SELECT snapshot_id, received_at, CAST(i - 1 AS INTEGER) AS pos_edges, f.source AS source, f.target AS target, f.relationship AS relationship, f.confidence AS confidence
FROM (SELECT snapshot_id, received_at, unnest(edges) AS f, generate_subscripts(edges, 1) AS i FROM lineage_snapshots) x""",
    "p7_fields": r"""
WITH records AS (SELECT feed, file_name, raw FROM raw_records WHERE feed IS NOT NULL AND file_name IS NOT NULL AND json_valid(raw) AND json_type(raw) = 'OBJECT'),
fields AS (
  SELECT feed, file_name, regexp_replace(regexp_replace(t.fullkey, '\[[0-9]+\]', '', 'g'), '^\$\.', '') AS field,
         CASE t.type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN NULL ELSE 'number' END AS kind
  FROM records, json_tree(raw) t WHERE t.fullkey <> '$' AND NOT regexp_matches(t.fullkey, '\]$'))
SELECT feed, file_name, field, coalesce(string_agg(DISTINCT kind, ',' ORDER BY kind), '') AS kinds FROM fields GROUP BY ALL""",
    "p4_node_metadata": """
SELECT snapshot_id, received_at, CAST(i - 1 AS INTEGER) AS pos_nodes, node_id, e.key AS key, e.value AS value
FROM (SELECT snapshot_id, received_at, i, f.node_id AS node_id, unnest(map_entries(f.metadata)) AS e
      FROM (SELECT snapshot_id, received_at, unnest(nodes) AS f, generate_subscripts(nodes, 1) AS i FROM lineage_snapshots) x) y""",
    "p4_scores": """
SELECT load_id, verdict_id, e.key AS key, e.value.score AS value_score, e.value.notes AS value_notes
FROM (SELECT load_id, verdict_id, unnest(map_entries(scores)) AS e FROM verdicts) x""",
    "p4_score_evidence": """
SELECT load_id, verdict_id, criterion, CAST(j - 1 AS INTEGER) AS pos_value_evidence, evidence
FROM (SELECT load_id, verdict_id, e.key AS criterion, unnest(e.value.evidence) AS evidence, generate_subscripts(e.value.evidence, 1) AS j
      FROM (SELECT load_id, verdict_id, unnest(map_entries(scores)) AS e FROM verdicts) x) y""",
    "p4_records": """
SELECT load_id, loaded_at, doc_id, source_path, source_hash, extraction_model, processing_time_ms, token_count.input AS token_count_input, token_count.output AS token_count_output, extracted_at FROM extractions""",
    "p4_record_parts": """
SELECT load_id, doc_id, CAST(coalesce(len(extracted_facts), 0) AS BIGINT) AS facts, CAST(coalesce(len(entities), 0) AS BIGINT) AS entities,
       CAST(coalesce(list_sum([coalesce(len(f.entity_refs), 0) for f in extracted_facts]), 0) AS BIGINT) AS refs FROM extractions""",
    "p4_blame_chain": """
SELECT delivery_id, CAST(i - 1 AS INTEGER) AS pos_blame_chain, f.rank AS rank, f.file_path AS file_path, f.commit_hash AS commit_hash, f.author AS author,
       f.commit_timestamp AS commit_timestamp, f.commit_message AS commit_message, f.confidence_score AS confidence_score
FROM (SELECT delivery_id, unnest(blame_chain) AS f, generate_subscripts(blame_chain, 1) AS i FROM demo_blame) x""",
    "p4_subscribers": """
SELECT delivery_id, CAST(i - 1 AS INTEGER) AS pos_blast_radius_subscribers, f.subscriber_id AS subscriber_id, f.subscriber_team AS subscriber_team, f.validation_mode AS validation_mode, f.contact AS contact
FROM (SELECT delivery_id, unnest(blast_radius.subscribers) AS f, generate_subscripts(blast_radius.subscribers, 1) AS i FROM demo_blame) x""",
    "p4_subscriber_fields": """
SELECT delivery_id, subscriber_id, CAST(i - 1 AS INTEGER) AS pos_blast_radius_subscribers, CAST(j - 1 AS INTEGER) AS pos_fields_consumed, field
FROM (SELECT delivery_id, f.subscriber_id AS subscriber_id, i, unnest(f.fields_consumed) AS field, generate_subscripts(f.fields_consumed, 1) AS j
      FROM (SELECT delivery_id, unnest(blast_radius.subscribers) AS f, generate_subscripts(blast_radius.subscribers, 1) AS i FROM demo_blame) x) y""",
    "p4_matched_fields": """
SELECT delivery_id, subscriber_id, CAST(i - 1 AS INTEGER) AS pos_blast_radius_subscribers, CAST(j - 1 AS INTEGER) AS pos_matched_breaking_fields, m.field AS field, m.reason AS reason
FROM (SELECT delivery_id, f.subscriber_id AS subscriber_id, i, unnest(f.matched_breaking_fields) AS m, generate_subscripts(f.matched_breaking_fields, 1) AS j
      FROM (SELECT delivery_id, unnest(blast_radius.subscribers) AS f, generate_subscripts(blast_radius.subscribers, 1) AS i FROM demo_blame) x) y""",
    "p6_found": f"""
WITH first AS (
  SELECT snapshot_id, min(codebase_root) AS root, min(coalesce({instant_sql("captured_at")}, epoch_us(received_at))) AS seen FROM lineage_snapshots GROUP BY 1),
pairs AS (SELECT snapshot_id, lag(snapshot_id) OVER (PARTITION BY root ORDER BY seen, snapshot_id) AS before FROM first),
items AS (
  SELECT DISTINCT snapshot_id, n.node_id AS node_id,
         to_json([n.type, n.label]) || coalesce(to_json(list_sort(map_entries(n.metadata))), '[]') AS content
  FROM (SELECT snapshot_id, unnest(nodes) AS n FROM lineage_snapshots) x),
new AS (SELECT p.snapshot_id, i.node_id, i.content FROM pairs p JOIN items i ON i.snapshot_id = p.snapshot_id WHERE p.before IS NOT NULL),
old AS (SELECT p.snapshot_id, i.node_id, i.content FROM pairs p JOIN items i ON i.snapshot_id = p.before)
SELECT coalesce(n.snapshot_id, o.snapshot_id) AS snapshot_id, coalesce(n.node_id, o.node_id) AS node_id,
       CASE WHEN o.node_id IS NULL THEN 'added' WHEN n.node_id IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM new n FULL JOIN old o ON n.snapshot_id = o.snapshot_id AND n.node_id = o.node_id
WHERE o.node_id IS NULL OR n.node_id IS NULL OR n.content <> o.content""",
}
