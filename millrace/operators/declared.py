"""The contracts of the known datasets and the tests of their flat tables, as data."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import contracts, datasets, matching
from .contracts import Contract

_ID = {"type": "string", "required": True, "format": "uuid", "minLength": 1}
_TEXT = {"type": "string", "required": True, "minLength": 1}
_TIME = {"type": "string", "required": True, "format": "date-time"}
_SHARE = {"type": "number", "required": True, "minimum": 0.0, "maximum": 1.0}
_OPTIONAL = {"type": "string"}


def _objects(least: int = 0, **properties: dict) -> dict:
    return {"type": "array", "required": True, "minItems": least, "items": {"type": "object", "properties": properties}}


# Fields, formats and bounds of the datasets, and rules on them.
CONTRACTS = {
    "intents": Contract(
        "intents",
        {"intent_id": _ID | {"unique": True}, "description": _TEXT, "code_refs": _objects(1, file=_TEXT, line_start={"type": "integer", "required": True, "minimum": 1}, line_end={"type": "integer", "required": True, "minimum": 1}, confidence=_SHARE),
         "governance_tags": {"type": "array", "required": True, "minItems": 1}, "created_at": _TIME},
        ["row_count >= 1", "missing_count(intent_id) = 0", "min(code_refs[*].confidence) >= 0", "max(code_refs[*].confidence) <= 1"],
    ),
    "verdicts": Contract(
        "verdicts",
        {"verdict_id": _ID | {"unique": True}, "target_ref": _TEXT, "rubric_id": _TEXT | {"pattern": "^[a-f0-9]{64}$"}, "rubric_version": _TEXT, "overall_verdict": _TEXT | {"enum": list(datasets.VERDICTS)},
         "overall_score": {"type": "number", "required": True, "minimum": 1.0, "maximum": 5.0}, "confidence": _SHARE, "evaluated_at": _TIME},
        ["row_count >= 1", "missing_count(verdict_id) = 0", "min(overall_score) >= 1", "max(overall_score) <= 5", "min(confidence) >= 0", "max(confidence) <= 1", "overall_verdict in {PASS, FAIL, WARN}"],
    ),
    "extractions": Contract(
        "extractions",
        {"doc_id": _ID | {"unique": True}, "source_path": _TEXT, "source_hash": _TEXT | {"pattern": "^[a-f0-9]{64}$"},
         "extracted_facts": _objects(1, fact_id=_ID, text=_TEXT, confidence=_SHARE, page_ref={"type": "integer", "minimum": 1}),
         "entities": _objects(0, entity_id=_ID, name=_TEXT, type=_TEXT | {"enum": list(datasets.ENTITY_TYPES)}, canonical_value=_OPTIONAL),
         "extraction_model": _TEXT | {"pattern": datasets.MODEL}, "processing_time_ms": {"type": "integer", "required": True, "minimum": 1}, "extracted_at": _TIME},
        ["row_count >= 1", "missing_count(doc_id) = 0", "duplicate_count(doc_id) = 0", "min(extracted_facts[*].confidence) >= 0", "max(extracted_facts[*].confidence) <= 1", "missing_count(extracted_facts[*].fact_id) = 0", "max(cardinality(extracted_facts)) >= 1", "min(processing_time_ms) >= 1"],
    ),
    "snapshots": Contract(
        "snapshots",
        {"snapshot_id": _ID | {"unique": True}, "codebase_root": _TEXT, "git_commit": _TEXT | {"pattern": "^[a-f0-9]{40}$"}, "nodes": _objects(1, node_id=_TEXT, type=_TEXT | {"enum": list(datasets.NODE_TYPES)}, label=_TEXT),
         "edges": _objects(0, source=_TEXT, target=_TEXT, relationship=_TEXT | {"enum": list(datasets.RELATIONSHIPS)}, confidence=_SHARE), "captured_at": _TIME},
        ["row_count >= 1"],
    ),
    "events": Contract(
        "events",
        {"event_id": _ID | {"unique": True}, "event_type": _TEXT | {"pattern": "^[A-Z][a-zA-Z0-9]*$"}, "aggregate_id": _TEXT, "aggregate_type": _TEXT, "sequence_number": {"type": "integer", "required": True, "minimum": 0},
         "payload": {"type": "object", "required": True}, "metadata": {"type": "object", "required": True}, "schema_version": _TEXT, "occurred_at": _TIME, "recorded_at": _TIME},
        ["row_count >= 1", "missing_count(event_id) = 0", "duplicate_count(event_id) = 0", "min(payload.bytes) >= 0", "min(recorded_at) >= min(occurred_at)", "recorded_at >= occurred_at"],
    ),
    "runs": Contract(
        "runs",
        {"id": _ID | {"unique": True}, "name": _TEXT, "run_type": _TEXT | {"enum": list(datasets.RUN_TYPES)}, "start_time": _TIME, "end_time": _TIME, "total_tokens": {"type": "integer", "required": True, "minimum": 0},
         "prompt_tokens": {"type": "integer", "required": True, "minimum": 0}, "completion_tokens": {"type": "integer", "required": True, "minimum": 0}, "total_cost": {"type": "number", "required": True, "minimum": 0.0}},
        ["row_count >= 1", "total_tokens = prompt_tokens + completion_tokens", "total_cost >= 0", "end_time > start_time"],
    ),
}


def described(name: str, df: DataFrame | None = None, numbers: Mapping[str, object] | None = None) -> dict:
    """A contract as a document, with a profile of ``numbers`` (name to column) of the data if given."""
    from . import numeric_drift

    c = CONTRACTS[name]
    document = {"id": c.contract_id, "kind": "DataContract", "schema": c.schema, "quality": list(c.rules)}
    if df is not None and numbers:
        document["profiling"] = {n: numeric_drift.numeric_profile(df, col).first().asDict() for n, col in numbers.items()}  # type: ignore[arg-type]
    return document


# Tests of the flat tables. ``key: (table, key)`` is a reference.
MODELS = {
    "extractions": {"not_null": ["doc_id", "source_path", "source_hash", "extracted_facts", "entities", "extraction_model", "processing_time_ms"], "unique": ["doc_id"]},
    "extraction_facts": {"not_null": ["doc_id", "fact_id", "text", "confidence"], "unique": ["fact_id"], "references": {"doc_id": ("extractions", "doc_id")}},
    "extraction_entities": {"not_null": ["doc_id", "entity_id", "name", "type"], "unique": ["entity_id"], "accepted": {"type": datasets.ENTITY_TYPES}, "references": {"doc_id": ("extractions", "doc_id")}},
    "extraction_fact_entity_refs": {"not_null": ["doc_id", "fact_id", "entity_id"], "references": {"doc_id": ("extractions", "doc_id"), "fact_id": ("extraction_facts", "fact_id"), "entity_id": ("extraction_entities", "entity_id")}},
    "events": {"not_null": ["event_id", "event_type", "aggregate_id", "aggregate_type", "sequence_number", "payload", "metadata", "schema_version", "occurred_at", "recorded_at"], "unique": ["event_id"]},
    "event_payloads": {"not_null": ["event_id", "doc_id", "status", "bytes"], "accepted": {"status": ("filed", "waiting", "broken")}, "references": {"event_id": ("events", "event_id")}},
    "event_metadata": {"not_null": ["event_id", "correlation_id", "user_id", "source_service"], "references": {"event_id": ("events", "event_id")}},
}


def model_tables(extractions: DataFrame, events: DataFrame) -> dict[str, DataFrame]:
    """The flat tables that the tests are about."""
    facts = extractions.select("doc_id", F.inline("extracted_facts"))
    return {
        "extractions": extractions, "extraction_facts": facts, "extraction_entities": extractions.select("doc_id", F.inline("entities")),
        "extraction_fact_entity_refs": facts.select("doc_id", "fact_id", F.explode("entity_refs").alias("entity_id")), "events": events,
        "event_payloads": events.where("payload is not null").select("event_id", "payload.*"), "event_metadata": events.where("metadata is not null").select("event_id", "metadata.*"),
    }


def run_models(tables: Mapping[str, DataFrame], models: Mapping[str, dict] = MODELS) -> DataFrame:
    """``model, test, column_name, failures`` of all tests; nulls pass ``unique``, ``accepted_values`` and ``relationships``."""
    parts = []
    for name, tests in models.items():
        df = tables[name]
        if any(tests.get(k) for k in ("not_null", "unique", "accepted")):
            parts.append(contracts.relational_tests(df, tests.get("not_null", ()), tests.get("unique", ()), tests.get("accepted")).select(F.lit(name).alias("model"), "test", "column_name", F.col("failures").cast("bigint").alias("failures")))
        for column, (other, key) in tests.get("references", {}).items():
            # a key is looked up once, however often it comes
            uses = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
            lost = matching.missing_references(uses, F.col("_k"), tables[other], key).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
            parts.append(lost.select(F.lit(name).alias("model"), F.lit("relationships").alias("test"), F.lit(column).alias("column_name"), "failures"))
    return reduce(DataFrame.unionByName, parts)


def models_document(models: Mapping[str, dict] = MODELS) -> dict:
    """The tests as a document of the kind that transformation tools read."""
    out = []
    for name, tests in models.items():
        columns: dict[str, list] = {}
        for c in tests.get("not_null", ()):
            columns.setdefault(c, []).append("not_null")
        for c in tests.get("unique", ()):
            columns.setdefault(c, []).append("unique")
        for c, values in tests.get("accepted", {}).items():
            columns.setdefault(c, []).append({"accepted_values": {"values": list(values)}})
        for c, (other, key) in tests.get("references", {}).items():
            columns.setdefault(c, []).append({"relationships": {"to": f"ref('{other}')", "field": key}})
        out.append({"name": name, "columns": [{"name": c, "tests": t} for c, t in columns.items()]})
    return {"version": 2, "models": out}


#: Tests that are a query of their own: the rows it gives are failures.
SINGULAR = {
    "facts_confidence_within_0_and_1": "SELECT doc_id, fact_id, confidence FROM extraction_facts WHERE confidence < 0 OR confidence > 1",
    "events_recorded_not_before_they_occurred": "SELECT event_id, occurred_at, recorded_at FROM events WHERE try_cast(recorded_at AS TIMESTAMP) < try_cast(occurred_at AS TIMESTAMP)",
    "payload_bytes_not_negative": "SELECT event_id, bytes FROM event_payloads WHERE bytes < 0",
}


def run_singular(tables: Mapping[str, DataFrame], tests: Mapping[str, str] = SINGULAR) -> dict[str, DataFrame]:
    """The failing rows of each test that is a query, over the flat tables as views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    spark = next(iter(tables.values())).sparkSession
    return {name: spark.sql(sql) for name, sql in tests.items()}
