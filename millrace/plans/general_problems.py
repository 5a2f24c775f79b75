"""The queries of the general data problems, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import late_events, messages, nested, profile_drift, schema_drift
from ..operators.hierarchy import descendants_of, endless_nodes, hierarchy
from ..operators.snapshots import node_changes
from ..sources.shared import Workspace
from ..sources.tables import table


def p1_periods(spark: SparkSession, folder: str) -> DataFrame:
    return late_events.periods(spark, table(spark, folder, "event_log"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    changed = late_events.changed_periods(p1_periods(spark, folder))
    return changed.select("aggregate_id", F.date_format("period_day", "yyyy-MM-dd").alias("period_day"))


def _tree(spark: SparkSession, folder: str, paths: bool) -> DataFrame:
    return hierarchy(spark, table(spark, folder, "runs"), "id", "parent_run_id", paths)


def p2_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    """Every run with its root, depth and number of descendants, and whether its parentage goes round in a ring."""
    return _tree(spark, folder, paths=False).select("id", "parent", "root", "depth", "descendants", "endless")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return endless_nodes(spark, table(spark, folder, "runs"), "id", "parent_run_id")


def p2_paths(spark: SparkSession, folder: str) -> DataFrame:
    tree = _tree(spark, folder, paths=True).where("not endless")
    return tree.select("id", "parent", "root", "depth", F.concat_ws("/", "path").alias("path"), "descendants")


def p2_descendants(spark: SparkSession, folder: str) -> DataFrame:
    """All descendants of every run."""
    tree = Workspace(spark, "tree").write(_tree(spark, folder, paths=False), "tree")
    return descendants_of(tree)


def _keyed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    keys = {
        "event_log": messages.message_key([F.col("event_id")]),
        "demo_blame": messages.message_key([F.col("violation_id")], [F.col("check_id")]),
    }
    return {t: table(spark, folder, t).select(k.alias("message_key"), "delivery_id", "batch_id") for t, k in keys.items()}


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    parts = []
    for name, keyed in _keyed(spark, folder).items():
        kept = messages.survivors(spark, keyed)
        parts.append(messages.surplus(keyed, kept).select(F.lit(name).alias("table_name"), "delivery_id"))
    return parts[0].unionByName(parts[1])


def p3_event_log_once(spark: SparkSession, folder: str) -> DataFrame:
    log = table(spark, folder, "event_log")
    key = messages.message_key([F.col("event_id")])
    kept = messages.survivors(spark, log.select(key.alias("message_key"), "delivery_id", "batch_id"))
    once = messages.deduplicate(log, key, kept)
    return once.select("delivery_id", "batch_id", "event_id", "event_type", "aggregate_id", "sequence_number", "occurred_at", "recorded_at")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    facts = nested.dangling_within(
        table(spark, folder, "extractions"), "extracted_facts", "entity_refs", "fact_id", ("entities", "entity_id"), {"record_id": F.col("doc_id")}
    )
    edges = nested.dangling_edges(table(spark, folder, "lineage_snapshots"), {"record_id": F.col("snapshot_id")})
    return facts.unionByName(edges).distinct()


_DOCUMENT = {"load_id": "load_id", "doc_id": "doc_id"}


def _flat(name: str, path: list[str], keys: dict[str, str], **rest):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return nested.flatten_table(table(spark, folder, name), path, {o: F.col(c) for o, c in keys.items()}, **rest)

    return run


p4_facts = _flat("extractions", ["extracted_facts"], _DOCUMENT)
p4_entities = _flat("extractions", ["entities"], _DOCUMENT)
p4_fact_refs = _flat("extractions", ["extracted_facts", "entity_refs"], _DOCUMENT, ancestors={0: {"fact_id": "fact_id"}}, value="entity_id")
p4_nodes = _flat("lineage_snapshots", ["nodes"], {"snapshot_id": "snapshot_id", "received_at": "received_at"})
p4_edges = _flat("lineage_snapshots", ["edges"], {"snapshot_id": "snapshot_id", "received_at": "received_at"})


_SNAPSHOT = {"snapshot_id": "snapshot_id", "received_at": "received_at"}


def _rows(name: str, path: list[str], keys: dict[str, str], **rest):
    """A flat table with ``record``, which tells repeated rows of one id apart."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        columns = {"record": nested.record_key()} | {o: F.col(c) for o, c in keys.items()}
        return nested.flatten_table(table(spark, folder, name), path, columns, **rest)

    return run


def _without(query, *columns: str):
    return lambda spark, folder: query(spark, folder).drop(*columns)


p4_fact_rows = _rows("extractions", ["extracted_facts"], _DOCUMENT)
# the order of a map's entries means nothing
p4_node_metadata = _without(_flat("lineage_snapshots", ["nodes", "metadata"], _SNAPSHOT, ancestors={0: {"node_id": "node_id"}}), "pos_metadata")


_LOAD = {"load_id": "load_id", "verdict_id": "verdict_id"}
_LOGGED = {"delivery_id": "delivery_id"}

p4_scores = _without(_flat("verdicts", ["scores"], _LOAD), "pos_scores")
p4_score_evidence = _without(_flat("verdicts", ["scores", "value.evidence"], _LOAD, ancestors={0: {"criterion": "key"}}, value="evidence"), "pos_scores")
p4_blame_chain = _flat("demo_blame", ["blame_chain"], _LOGGED)
p4_subscribers = _flat("demo_blame", ["blast_radius.subscribers"], _LOGGED)
p4_subscriber_fields = _flat("demo_blame", ["blast_radius.subscribers", "fields_consumed"], _LOGGED, ancestors={0: {"subscriber_id": "subscriber_id"}}, value="field")
p4_matched_fields = _flat("demo_blame", ["blast_radius.subscribers", "matched_breaking_fields"], _LOGGED, ancestors={0: {"subscriber_id": "subscriber_id"}})


def p4_records(spark: SparkSession, folder: str) -> DataFrame:
    """The extractions themselves, as the flat tables of their parts refer to them."""
    return nested.record_table(table(spark, folder, "extractions")).drop("record")


def p4_record_parts(spark: SparkSession, folder: str) -> DataFrame:
    """How many facts, entities and references lead back to each record of extractions, by the key of the record."""
    parts = nested.related_tables(table(spark, folder, "extractions"))
    counts = parts["records"].select("record", "load_id", "doc_id")
    for name, path in (("facts", "extracted_facts"), ("entities", "entities"), ("refs", "extracted_facts.entity_refs")):
        counts = counts.join(parts[path].groupBy("record").agg(F.count(F.lit(1)).alias(name)), "record", "left")
    return counts.select("load_id", "doc_id", *(F.coalesce(n, F.lit(0)).alias(n) for n in ("facts", "entities", "refs")))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return node_changes(spark, table(spark, folder, "lineage_snapshots"))


def p7_fields(spark: SparkSession, folder: str) -> DataFrame:
    """The fields of every file with the kinds of their non-null values."""
    fields = schema_drift.file_fields(spark, table(spark, folder, "raw_records")).where("size(path) > 0")
    return fields.select("feed", "file_name", F.array_join("path", ".").alias("field"), F.array_join("kinds", ",").alias("kinds"))


def p7_changes(spark: SparkSession, folder: str) -> DataFrame:
    return schema_drift.schema_changes(spark, table(spark, folder, "raw_records"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return schema_drift.reported(p7_changes(spark, folder)).select("file_name", "field", "change_kind")


def _consistent(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "raw_records")
    work = Workspace(spark, "consistent")
    changes = work.write(schema_drift.schema_changes(spark, lines), "changes")
    return work.write(schema_drift.consistent_table(spark, lines, changes), "table")


def p7_table(spark: SparkSession, folder: str) -> DataFrame:
    return _consistent(spark, folder).drop("kinds")


def p7_table_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """How many records each file gives the consistent table and how many of their fields are filled; renaming loses none."""
    filled = F.coalesce(F.sum(F.size("fields")), F.lit(0)).alias("filled")
    return _consistent(spark, folder).groupBy("dataset", "file_name").agg(F.count(F.lit(1)).alias("records"), filled)


def _typed(dataset: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return schema_drift.typed_tables(spark, _consistent(spark, folder))[dataset]

    return run


#: One table of each dataset, with a typed column for each field.
p7_events = _typed("events")
p7_reports = _typed("schema_evolution_demo")


#: Times as text, which move on by themselves.
_MOVING = ("extracted_at", "evaluated_at")


def _counted(spark: SparkSession, folder: str, name: str) -> tuple[DataFrame, profile_drift.ValueCounts]:
    df, store = table(spark, folder, name), profile_drift.ValueCounts(spark)
    store.apply(df)
    return df, store


def _both(query) -> DataFrame:
    parts = [query(name).withColumn("table_name", F.lit(name)) for name in ("extractions", "verdicts")]
    return parts[0].unionByName(parts[1])


_UUID, _DIGEST = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$", "^[0-9a-f]{64}$"
#: Declared formats of columns; what has another is malformed.
PATTERNS = {
    "extractions": {
        "doc_id": _UUID, "source_hash": _DIGEST, "extracted_facts.fact_id": _UUID, "extracted_facts.entity_refs[]": _UUID, "entities.entity_id": _UUID,
        "entities.type": "^(PERSON|ORG|LOCATION|DATE|AMOUNT|OTHER)$", "extraction_model": "^refiner-[a-z]+-[0-9]+$", "extracted_at": "^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ]",
    },
    "verdicts": {"verdict_id": _UUID, "rubric_id": _DIGEST, "rubric_version": "^[0-9]+[.][0-9]+[.][0-9]+$", "overall_verdict": "^(PASS|FAIL|WARN)$", "evaluated_at": "^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ]"},
}


def p5_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of every column per load; malformed is what has not the declared format of its column."""

    def one(name: str) -> DataFrame:
        _, store = _counted(spark, folder, name)
        m = profile_drift.metrics(store.read(), store.names, patterns=PATTERNS[name])
        return m.withColumns({c: F.round(c, 9) for c in ("mean", "entropy")})

    return _both(one)


def p5_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """Texts whose format is none of the usual ones of their column, which are learned from all loads."""

    def one(name: str) -> DataFrame:
        _, store = _counted(spark, folder, name)
        return profile_drift.metrics(store.read(), store.names).where("malformed > 0").select("load_id", "column_name", "malformed")

    return _both(one)


def p5_changes(spark: SparkSession, folder: str) -> DataFrame:
    def one(name: str) -> DataFrame:
        df, store = _counted(spark, folder, name)
        return profile_drift.changed_columns(spark, store, profile_drift.loads_in_order(df), _MOVING)

    return _both(one)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_changes(spark, folder).select("table_name", F.regexp_replace("column_name", r"\[\]", "").alias("column_name"), "load_id").distinct()
