"""The checks of the domain datasets, each a list of clauses or a small query beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as p
from .checks import RESULT, Clause, run_checks
from .sequences import sequence_breaks

# Members of enumerations.
VERDICTS = ("PASS", "FAIL", "WARN")
ENTITY_TYPES = ("PERSON", "ORG", "LOCATION", "DATE", "AMOUNT", "OTHER")
NODE_TYPES = ("FILE", "TABLE", "SERVICE", "MODEL", "PIPELINE", "EXTERNAL")
RELATIONSHIPS = ("IMPORTS", "CALLS", "READS", "WRITES", "PRODUCES", "CONSUMES")
RUN_TYPES = ("llm", "chain", "tool", "retriever", "embedding")
MODEL = r"^(claude|gpt)-"


def _items(array: str, bad) -> Column:
    """How many elements of an array violate ``bad``."""
    return F.coalesce(F.size(F.filter(F.col(array), lambda e: F.coalesce(bad(e), F.lit(True)))), F.lit(0))


def _empty(array: str) -> Column:
    return F.coalesce(F.size(array), F.lit(0)) < 1


def _not_in(c: Column, members) -> Column:
    return ~F.coalesce(c, F.lit("None")).isin(*members)


def _absent_uses(named: Column, ids: Column) -> Column:
    """How many elements of ``named`` are null or not in ``ids``. What is missing is found by hash; only where something is, its uses are counted."""
    given = F.filter(named, lambda r: r.isNotNull())
    lost = F.array_except(given, ids)
    return F.size(named) - F.size(given) + F.when(F.size(lost) > 0, F.size(F.filter(given, lambda r: F.array_contains(lost, r)))).otherwise(0)


def _flat_numbers(array: str, field: str) -> Column:
    return F.filter(F.transform(F.col(array), lambda e: e[field].cast("double")), lambda v: v.isNotNull())


# The ids of the checks below, and what they compare with.


def intents() -> list[Clause]:
    """Records that link an intent to code: ``intent_id, code_refs, governance_tags, created_at``."""
    i, missing = F.col("intent_id"), p.falsy_text(F.col("intent_id"))
    return [
        Clause("week1.intent_id.required", "intent_id", "required", missing, "present", failing="ERROR"),
        Clause("week1.intent_id.uuid", "intent_id", "format", ~missing & ~p.matches(i, p.UUID), "a UUID", sample=i),
        Clause("week1.code_refs.non_empty", "code_refs", "array", _empty("code_refs"), "one or more", sample=i),
        Clause("week1.code_refs.confidence.range", "code_refs.confidence", "range", _items("code_refs", lambda e: ~p.in_unit_interval(e["confidence"])), "0 to 1", sample=i),
        Clause("week1.code_refs.line_order", "code_refs.line_end", "range", _items("code_refs", lambda e: ~(e["line_end"] >= e["line_start"])), "line_end >= line_start", sample=i),
        Clause("week1.governance_tags.non_empty", "governance_tags", "array", _empty("governance_tags"), "one or more", sample=i),
        Clause("week1.created_at.iso8601", "created_at", "format", ~p.iso_readable(F.col("created_at")), "ISO 8601", sample=i),
    ]


def verdicts(rubric_sha256: str | None = None) -> list[Clause]:
    """Verdicts: enumerations, scores of 1 to 5, mean of the scores, versions. ``rubric_sha256`` is the digest all must name."""
    v, scores = F.col("verdict_id"), F.map_values("scores")
    bad = F.coalesce(F.size(F.filter(scores, lambda s: s["score"].isNotNull() & ~s["score"].between(1, 5))), F.lit(0))
    whole = F.coalesce(F.forall(scores, lambda s: F.coalesce(s["score"].between(1, 5), F.lit(False))), F.lit(False)) & (F.size("scores") > 0)
    mean = F.aggregate(scores, F.lit(0.0), lambda a, s: a + s["score"]) / F.size("scores")
    out = [
        Clause("week2.overall_verdict.enum", "overall_verdict", "enum", _not_in(F.col("overall_verdict"), VERDICTS), ", ".join(VERDICTS), sample=v),
        Clause("week2.scores.criterion.range", "scores.score", "range", bad, "1 to 5", sample=v),
        Clause("week2.overall_score.weighted_mean", "overall_score", "computed", F.when(whole, F.abs(F.col("overall_score") - mean) > 0.05), "mean of scores, within 0.05", sample=v),
        Clause("week2.rubric_version.semver", "rubric_version", "semver", ~p.matches(F.col("rubric_version"), p.SEMVER), "x.y.z", sample=v),
        Clause("week2.confidence.range", "confidence", "range", ~p.in_unit_interval(F.col("confidence")), "0 to 1", sample=v),
    ]
    if rubric_sha256:
        out.append(Clause("week2.rubric_id.sha256", "rubric_id", "hash", F.coalesce(F.col("rubric_id"), F.lit("None")) != rubric_sha256, rubric_sha256, sample=v))
    return out


def extractions() -> list[Clause]:
    """Extractions: ids, digests, facts and their references, entities, times."""
    d, facts = F.col("doc_id"), F.col("extracted_facts")
    ids = F.coalesce(F.transform("entities", lambda e: e["entity_id"]), F.array().cast("array<string>"))
    named = F.coalesce(F.flatten(F.filter(F.transform(facts, lambda f: f["entity_refs"]), lambda r: r.isNotNull())), F.array().cast("array<string>"))
    dangling = _absent_uses(named, ids)
    c = _flat_numbers("extracted_facts", "confidence")
    total, n = F.sum(F.aggregate(c, F.lit(0.0), lambda a, x: a + x)), F.sum(F.size(c))
    actual = F.format_string("max=%.3f mean=%.3f min=%.3f", F.coalesce(F.max(F.array_max(c)), F.lit(0.0)), F.coalesce(total / F.nullif(n, F.lit(0)), F.lit(0.0)), F.coalesce(F.min(F.array_min(c)), F.lit(0.0)))
    return [
        Clause("week3.doc_id.required", "doc_id", "required", p.falsy_text(d), "present", failing="ERROR", only_failing=True),
        Clause("week3.doc_id.uuid", "doc_id", "format", ~p.matches(d, p.UUID), "a UUID", unless="week3.doc_id.required", sample=d),
        Clause("week3.source_hash.pattern", "source_hash", "pattern", ~p.matches(F.col("source_hash"), p.SHA256), "64 hexadecimal digits", sample=d),
        Clause("week3.extracted_facts.non_empty", "extracted_facts", "array", _empty("extracted_facts"), "one or more", sample=d),
        Clause("week3.extracted_facts.confidence.range", "extracted_facts.confidence", "range", _items("extracted_facts", lambda f: ~p.in_unit_interval(f["confidence"])), "0 to 1", sample=d, actual=actual),
        Clause("week3.extracted_facts.entity_refs.relationship", "extracted_facts.entity_refs", "relationship", dangling, "an entity_id of the record", sample=d),
        Clause("week3.entities.type.enum", "entities.type", "enum", _items("entities", lambda e: _not_in(e["type"], ENTITY_TYPES)), ", ".join(ENTITY_TYPES), sample=d),
        Clause("week3.processing_time_ms.positive", "processing_time_ms", "range", p.is_false(F.col("processing_time_ms") > 0), "> 0", sample=d),
        Clause("week3.extraction_model.pattern", "extraction_model", "pattern", ~p.matches(F.col("extraction_model"), MODEL), MODEL, sample=d),
    ]


def snapshots() -> list[Clause]:
    """A lineage snapshot: ids, node types, edges between nodes that are there."""
    s = F.col("snapshot_id")
    ids = F.coalesce(F.transform("nodes", lambda n: n["node_id"]), F.array().cast("array<string>"))
    ends = F.coalesce(F.flatten(F.transform("edges", lambda e: F.array(e["source"], e["target"]))), F.array().cast("array<string>"))
    lost = F.array_except(ends, F.filter(ids, lambda i: i.isNotNull()))
    gone = lambda c: c.isNull() | F.coalesce(F.array_contains(lost, c), F.lit(False))
    loose = F.when(F.size(lost) > 0, _items("edges", lambda e: gone(e["source"]) | gone(e["target"]))).otherwise(0)
    return [
        Clause("week4.snapshot_id.uuid", "snapshot_id", "format", ~p.matches(s, p.UUID), "a UUID", sample=s),
        Clause("week4.git_commit.hex40", "git_commit", "pattern", ~p.matches(F.col("git_commit"), p.COMMIT), "40 hexadecimal digits", sample=s),
        Clause("week4.nodes.type.enum", "nodes.type", "enum", _items("nodes", lambda n: _not_in(n["type"], NODE_TYPES)), ", ".join(NODE_TYPES), sample=s),
        Clause("week4.edges.endpoints", "edges.source", "reference", loose, "ids of nodes", sample=s),
        Clause("week4.edges.relationship.enum", "edges.relationship", "enum", _items("edges", lambda e: _not_in(e["relationship"], RELATIONSHIPS)), ", ".join(RELATIONSHIPS), sample=s),
        Clause("week4.edges.confidence.range", "edges.confidence", "range", _items("edges", lambda e: ~p.in_unit_interval(e["confidence"])), "0 to 1", sample=s),
        Clause("week4.captured_at.iso8601", "captured_at", "format", ~p.iso_readable(F.col("captured_at")), "ISO 8601", sample=s),
    ]


def events() -> list[Clause]:
    """Events: names, times in order, payloads."""
    e = F.col("event_id")
    return [
        Clause("week5.event_type.pascal", "event_type", "pattern", ~p.matches(F.col("event_type"), p.PASCAL), "PascalCase", sample=e),
        Clause("week5.recorded_at.order", "recorded_at", "temporal", ~p.ordered(F.col("occurred_at"), F.col("recorded_at")), "recorded_at >= occurred_at", sample=e),
        Clause("week5.payload.bytes.minimum", "payload.bytes", "range", F.col("payload.bytes") < 0, ">= 0", sample=e),
    ]


def runs() -> list[Clause]:
    """Traced calls: ids, kinds, times, token sums, cost."""
    r = F.col("id")
    total = F.try_add(F.col("prompt_tokens"), F.col("completion_tokens"))
    return [
        Clause("langsmith.id.uuid", "id", "format", ~p.matches(r, p.UUID), "a UUID", sample=r),
        Clause("langsmith.run_type.enum", "run_type", "enum", _not_in(F.col("run_type"), RUN_TYPES), ", ".join(RUN_TYPES), sample=r),
        Clause("langsmith.end_time.after_start", "end_time", "temporal", ~p.ordered(F.col("start_time"), F.col("end_time"), strict=True), "end_time > start_time", sample=r),
        Clause("langsmith.total_tokens.sum", "total_tokens", "identity", p.is_false(F.col("total_tokens") == total), "prompt + completion", sample=r),
        Clause("langsmith.total_cost.non_negative", "total_cost", "range", p.is_false(F.isnan("total_cost") | (F.col("total_cost") >= 0)), ">= 0", sample=r),
    ]


def unique_result(df: DataFrame, column: str, check_id: str) -> DataFrame:
    """Ids that come more than once; counts ids, not rows, and takes missing ones for one id. Combines before the shuffle."""
    twice = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("None")).alias("k")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _single(twice, check_id, column, "unique", "no value twice")


def sequence_result(df: DataFrame, key: str, sequence: str, order: str, check_id: str) -> DataFrame:
    """Gaps and repeats of ``sequence`` within ``key``; see :func:`millrace.operators.sequences.sequence_breaks`."""
    broken = sequence_breaks(df, key, sequence, order).agg(F.coalesce(F.sum("breaks"), F.lit(0)).alias("n"))
    return _result(broken, check_id, sequence, "ordering", "each one more than the one before")


def required_result(df: DataFrame, fields: list[str], order: str, first: int | None = None) -> DataFrame:
    """Nulls in required fields of all rows, or among the ``first`` so many in ``order``, one ERROR row for each field with any."""
    rows = df if first is None else df.orderBy(order).limit(first)
    return run_checks(rows, [Clause(f"runner.schema.required.{f}", f, "required_field", F.col(f).isNull(), "present", failing="ERROR", only_failing=True) for f in fields])


def _single(failing: DataFrame, check_id: str, column: str, kind: str, expected: str) -> DataFrame:
    return _result(failing.agg(F.count(F.lit(1)).alias("n")), check_id, column, kind, expected)


def _result(counted: DataFrame, check_id: str, column: str, kind: str, expected: str) -> DataFrame:
    return run_checks(counted, [Clause(check_id, column, kind, F.col("n"), expected)])


def latest_snapshot(df: DataFrame, order: str = "received_at") -> DataFrame:
    """The last snapshot as it came: a top-1."""
    return df.orderBy(F.desc(order), F.desc("snapshot_id")).limit(1)


def unsupported_result(spark: SparkSession, contract_id: str) -> DataFrame:
    """What a contract without a validator gets."""
    return spark.createDataFrame([("runner.unsupported_contract", "id", "support", "ERROR", contract_id, "a known dataset", "LOW", 0, [], "no validator for this contract")], RESULT)


def dispatch(contract_id: str) -> str | None:
    """The dataset of a contract, by the first word of these that its id holds, in this order."""
    for word, name in (("extraction", "extractions"), ("event", "events"), ("intent", "intents"), ("verdict", "verdicts"), ("lineage", "snapshots"), ("trace", "runs")):
        if word in contract_id:
            return name
    return None
