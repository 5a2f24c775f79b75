"""The data-contract operators as queries over the driver's tables, each over its whole tables."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as p
from ..operators import ai_checks, attribution, checks, contract_diff, contracts, datasets, declared, json_schema, lineage, matching, migration, numeric_drift, quality, reporting, runner, schema_drift, sequences, vectors
from ..operators.checks import Clause
from ..sources import json_lines, synthetic
from ..sources.tables import table
from ..streaming.event_windows import tumbling_counts

#: The part of a result that SQL gives, too.
_SHOWN = ["check_id", "check_type", "status", "severity", "records_failing"]


def _checked(name: str, clauses):
    return lambda spark, folder: checks.run_checks(table(spark, folder, name), clauses() if callable(clauses) else clauses).select(*_SHOWN)


# --- checks of the domain tables -------------------------------------------------------------------------------------

checks_verdicts = _checked("verdicts", datasets.verdicts)
checks_extractions = _checked("extractions", datasets.extractions)
checks_lineage = _checked("lineage_snapshots", datasets.snapshots)
checks_events = _checked("event_log", datasets.events)
checks_runs = _checked("runs", datasets.runs)


def checks_lineage_latest(spark: SparkSession, folder: str) -> DataFrame:
    return checks.run_checks(datasets.latest_snapshot(table(spark, folder, "lineage_snapshots")), datasets.snapshots()).select(*_SHOWN)


def unique_doc_id(spark: SparkSession, folder: str) -> DataFrame:
    return datasets.unique_result(table(spark, folder, "extractions"), "doc_id", "week3.doc_id.unique").select(*_SHOWN)


def sequence_events(spark: SparkSession, folder: str) -> DataFrame:
    return datasets.sequence_result(table(spark, folder, "event_log"), "aggregate_id", "sequence_number", "delivery_id", "week5.sequence_number.monotonic").select(*_SHOWN)


def sequence_breaks_by_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    return sequences.sequence_breaks(table(spark, folder, "event_log"), "aggregate_id", "sequence_number", "delivery_id").where("breaks > 0")


def cross_doc_as_node(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that are no table node of any lineage snapshot, over distinct ids."""
    nodes = table(spark, folder, "lineage_snapshots").select(F.explode("nodes.node_id").alias("node_id"))
    ids = table(spark, folder, "extractions").select("doc_id").distinct()
    return matching.missing_references(ids, F.concat(F.lit("table::doc:"), F.col("doc_id")), nodes, "node_id")


def cross_verdict_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts whose target is no file of any lineage snapshot."""
    nodes = table(spark, folder, "lineage_snapshots").select(F.explode("nodes").alias("n")).where("n.type = 'FILE'")
    files = nodes.select(lineage.file_path(F.col("n.node_id")).alias("path"))
    return matching.missing_references(table(spark, folder, "verdicts").select("verdict_id", "target_ref"), F.col("target_ref"), files, "path")


# --- whole validations ------------------------------------------------------------------------------------------------

_BASELINES = [
    ("intake::extracted_facts.confidence.mean", 0.9, 0.03), ("intake::processing_time_ms.mean", None, 10.0), ("bench::confidence.mean", 0.72, 0.04), ("log::payload.bytes.mean", 30000.0, 9000.0),
]


def _intents(spark: SparkSession, folder: str) -> DataFrame:
    """Logged violations as intents: the place they hint at and those of their chain of causes are the code that they refer to."""
    log = table(spark, folder, "demo_blame")
    hint = F.when(F.col("blame_hint").isNotNull(), F.array(F.struct(F.col("blame_hint.file").alias("file"), F.col("blame_hint.line_start").alias("line_start"), F.col("blame_hint.line_end").alias("line_end"), F.lit(1.0).alias("confidence"))))
    chain = F.transform("blame_chain", lambda b: F.struct(b["file_path"].alias("file"), F.lit(1).cast("bigint").alias("line_start"), b["rank"].alias("line_end"), b["confidence_score"].alias("confidence")))
    return log.select(
        F.col("violation_id").alias("intent_id"), F.flatten(F.filter(F.array(hint, chain), lambda a: a.isNotNull())).alias("code_refs"),
        F.filter(F.array("severity"), lambda s: s.isNotNull()).alias("governance_tags"), F.col("detected_at").alias("created_at"), "delivery_id",
    )


def checks_intents(spark: SparkSession, folder: str) -> DataFrame:
    return checks.run_checks(_intents(spark, folder), datasets.intents()).select(*_SHOWN)


def drift_clauses(spark: SparkSession, folder: str) -> DataFrame:
    """Drift of every watched number of four datasets: against a baseline, against one that is no number, and where none is held."""
    baselines = spark.createDataFrame(_BASELINES, "key string, mean double, std double")
    tables = {"extractions": ("intake", table(spark, folder, "extractions")), "verdicts": ("bench", table(spark, folder, "verdicts")), "events": ("log", table(spark, folder, "event_log")), "intents": ("plans", _intents(spark, folder))}
    parts = [runner.drift_results(df, runner.metrics(n), baselines, c) for n, (c, df) in tables.items()]
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole.select(*_SHOWN)


def checks_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files that intents refer to against those of all lineage snapshots."""
    nodes = table(spark, folder, "lineage_snapshots").select(F.explode("nodes").alias("n")).where("n.type = 'FILE'")
    return runner.missing_files_result(_intents(spark, folder), nodes.select(F.col("n.node_id").alias("path"))).select(*_SHOWN)


def checks_payload(spark: SparkSession, folder: str) -> DataFrame:
    schema = {"type": "object", "required": ["doc_id", "status"], "properties": {"doc_id": {"type": "string"}, "status": {"enum": ["filed", "waiting"]}, "bytes": {"type": "integer", "minimum": 1000}}}
    return runner.payload_result(table(spark, folder, "event_log"), schema, "FileReceived").select(*_SHOWN)


def cross_checks(spark: SparkSession, folder: str) -> DataFrame:
    """References between datasets, as results."""
    t = lambda n: table(spark, folder, n)
    return runner.cross_results(_intents(spark, folder), t("verdicts"), t("extractions"), t("lineage_snapshots")).select(*_SHOWN)


def validation_extractions(spark: SparkSession, folder: str) -> DataFrame:
    """The whole validation of one dataset: unreadable lines, required fields, checks, unique ids and drift in one table of results."""
    lines = table(spark, folder, "raw_records").where("dataset = 'schema_evolution_demo'")
    results = runner.run_validation(
        spark, "extractions", table(spark, folder, "extractions"), contract_id="intake", lines=lines, required=["doc_id", "source_path", "extraction_model"],
        baselines=spark.createDataFrame(_BASELINES, "key string, mean double, std double"),
    )
    return results.groupBy(*_SHOWN).agg(F.count(F.lit(1)).alias("n"))


def anomalies_of_kind(spark: SparkSession, folder: str) -> DataFrame:
    """Values of event records that are there but of a wrong kind."""
    v = json_lines.records(table(spark, folder, "raw_records").where("dataset = 'events'"))
    return runner.type_anomalies(v, "v", {"payload": ["OBJECT"], "metadata": ["OBJECT"], "sequence_number": ["BIGINT"], "schema_version": ["STRING"], "payload.bytes": ["BIGINT", "DECIMAL", "DOUBLE"]})


# --- checks of the star schema ---------------------------------------------------------------------------------------


def orders_clauses() -> list[Clause]:
    return [
        Clause("orders.o_custkey.required", "o_custkey", "required", F.col("o_custkey").isNull(), failing="ERROR"),
        Clause("orders.o_orderstatus.enum", "o_orderstatus", "enum", ~F.coalesce("o_orderstatus", F.lit("None")).isin("O", "F"), severity="HIGH"),
        Clause("orders.o_totalprice.range", "o_totalprice", "range", p.is_false(F.col("o_totalprice").between(0, 250000)), severity="MEDIUM"),
        Clause("orders.o_orderpriority.pattern", "o_orderpriority", "pattern", ~p.matches(F.col("o_orderpriority"), r"^[1-5]-"), severity="LOW"),
    ]

def lineitem_clauses() -> list[Clause]:
    return [
        Clause("lineitem.l_discount.range", "l_discount", "range", p.is_false(F.col("l_discount").between(0, 0.05)), severity="HIGH"),
        Clause("lineitem.l_quantity.positive", "l_quantity", "range", p.is_false(F.col("l_quantity") > 0)),
        Clause("lineitem.l_returnflag.enum", "l_returnflag", "enum", ~F.coalesce("l_returnflag", F.lit("None")).isin("A", "N", "R"), severity="MEDIUM"),
        Clause("lineitem.l_linestatus.enum", "l_linestatus", "enum", ~F.coalesce("l_linestatus", F.lit("None")).isin("F"), severity="LOW"),
    ]

def customer_clauses() -> list[Clause]:
    return [
        Clause("customer.c_name.pattern", "c_name", "pattern", ~p.matches(F.col("c_name"), r"^Customer#[0-9]{9}\n?\z"), severity="MEDIUM"),
        Clause("customer.c_acctbal.non_negative", "c_acctbal", "range", p.is_false(F.col("c_acctbal") >= 0), severity="HIGH"),
    ]


_STAR = {"orders": orders_clauses, "lineitem": lineitem_clauses, "customer": customer_clauses}


def star_results(spark: SparkSession, folder: str) -> DataFrame:
    parts = [checks.run_checks(table(spark, folder, n), c()) for n, c in _STAR.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def star_checks(spark: SparkSession, folder: str) -> DataFrame:
    return star_results(spark, folder).select(*_SHOWN)


def required_fields(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "demo_blame")
    return datasets.required_result(df, df.columns, "delivery_id", first=None).select(*_SHOWN)


def required_fields_runs(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of runs; :func:`required_fields_first_200` is what the first rows alone show."""
    df = table(spark, folder, "runs")
    return datasets.required_result(df, df.columns, "id").select(*_SHOWN)


def required_fields_first_200(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "runs")
    return datasets.required_result(df, df.columns, "id", first=200).select(*_SHOWN)


def enum_lang(spark: SparkSession, folder: str) -> DataFrame:
    bad = ~F.coalesce("lang", F.lit("None")).isin("en", "de", "es")
    return table(spark, folder, "documents").where(bad).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


def unique_document_text(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that come more than once, by digest; repeats are counted before they are shuffled."""
    digest = F.sha2("text", 256)
    return table(spark, folder, "documents").where("text is not null").groupBy(digest.alias("text_sha256")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unique_lineitem_key(spark: SparkSession, folder: str) -> DataFrame:
    twice = table(spark, folder, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.agg(F.count(F.lit(1)).alias("repeated_keys"), F.sum("n").alias("rows_affected"))


def temporal_ship_after_order(spark: SparkSession, folder: str) -> DataFrame:
    j = table(spark, folder, "lineitem").join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.agg(F.count_if(F.col("l_shipdate") < F.col("o_orderdate")).alias("before"), F.count_if(F.col("l_shipdate") <= F.col("o_orderdate")).alias("not_after"))


def identity_n_chars(spark: SparkSession, folder: str) -> DataFrame:
    clause = Clause("documents.n_chars.identity", "n_chars", "identity", p.is_false(F.col("n_chars") == F.length(F.coalesce("text", F.lit("")))))
    return checks.run_checks(table(spark, folder, "documents"), [clause]).select(*_SHOWN)


def identity_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "runs").where(p.is_false(F.col("total_tokens") == F.try_add(F.col("prompt_tokens"), F.col("completion_tokens")))).select("id", "total_tokens", "prompt_tokens", "completion_tokens")


def computed_order_total(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("lines"))
    j = table(spark, folder, "orders").join(lines, "o_orderkey")
    return j.agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.abs(F.col("o_totalprice") - F.col("lines")) > 0.05).alias("differ"))


def sequence_lines(spark: SparkSession, folder: str) -> DataFrame:
    return sequences.sequence_breaks(table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber", "l_partkey").agg(F.sum("breaks").alias("breaks"))


def ref_unlabelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "subject_labels")
    return matching.missing_references(table(spark, folder, "documents").select("doc_id", "source"), F.col("doc_id"), labels, "doc_id").select("doc_id", "source")


def ref_derived_key(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "customer").where("c_acctbal >= 0").select(F.concat(F.lit("c:"), F.col("c_custkey").cast("string")).alias("k"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return matching.missing_references(orders, F.concat(F.lit("c:"), F.col("o_custkey").cast("string")), known, "k").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))


def semi_labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").join(table(spark, folder, "subject_labels").select("doc_id"), "doc_id", "left_semi").select("doc_id", "n_chars")


def json_payload_range(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return table(spark, folder, "events").groupBy("event_type").agg(F.count_if(p.is_false(k.between(0, 5))).alias("outside"), F.min(k).alias("least"), F.max(k).alias("greatest"))


def json_schema_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads of events against a JSON Schema, on the columns of the struct."""
    schema = {"type": "object", "required": ["doc_id", "status"], "properties": {"doc_id": {"type": "string"}, "status": {"type": "string", "enum": ["filed", "waiting", "broken"]}, "bytes": {"type": "integer", "minimum": 100}}}
    events = table(spark, folder, "event_log")
    bad = ~json_schema.column_valid(events, "payload", schema)
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("invalid"))


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = [
        "row_count >= 1", "missing_count(processing_time_ms) = 0", "duplicate_count(doc_id) = 0", "min(processing_time_ms) >= 1", "max(processing_time_ms) <= 60000",
        "missing_count(extracted_facts[*].confidence) = 0", "max(extracted_facts[*].confidence) <= 1", "max(cardinality(extracted_facts)) >= 1",
        "token_count.input >= token_count.output", "extraction_model in {refiner-layout-1, refiner-layout-2}", "max(token_count.input) >= min(token_count.output)",
    ]
    return quality.evaluate(table(spark, folder, "extractions"), rules).select("rule", "status", F.col("observed").try_cast("double").alias("observed"))


# --- profiles and drift -----------------------------------------------------------------------------------------------


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


_STATS = ("min", "max", "mean", "stddev", "p25", "p50", "p75", "p95", "p99")


def profile_event_value(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(numeric_drift.numeric_profile(table(spark, folder, "events"), F.col("value"), ["event_type"]), *_STATS)


def profile_confidence(spark: SparkSession, folder: str) -> DataFrame:
    facts = table(spark, folder, "extractions").select(F.explode("extracted_facts.confidence").alias("confidence"))
    return _rounded(numeric_drift.numeric_profile(facts, F.col("confidence")), *_STATS)


def flattened_profile_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each fact with how many entities it names."""
    df = table(spark, folder, "extractions").select("doc_id", "source_hash", F.explode("extracted_facts").alias("f"))
    return df.select("doc_id", "source_hash", F.col("f.confidence").alias("fact_confidence"), F.col("f.fact_id").alias("fact_id"), F.when(F.col("f.entity_refs").isNull(), 0).otherwise(F.size("f.entity_refs")).cast("bigint").alias("entity_count"))


def _mean_std(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def drift_event_value(spark: SparkSession, folder: str) -> DataFrame:
    """Later events of each type against those before."""
    events = table(spark, folder, "events")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    drift = numeric_drift.mean_drift(_mean_std(events.where(F.col("ts") >= cut), "value", ["event_type"]), _mean_std(events.where(F.col("ts") < cut), "value", ["event_type"]), ["event_type"])
    return _rounded(drift, "mean", "std", "sigma")


def drift_processing_time(spark: SparkSession, folder: str) -> DataFrame:
    """Each load against all loads of the first week."""
    df = table(spark, folder, "extractions")
    base = df.where("loaded_at < timestamp_ntz'2017-01-09 00:00:00'").agg(F.avg("processing_time_ms").alias("mean"), F.stddev_pop("processing_time_ms").alias("std")).withColumn("metric", F.lit("processing_time_ms"))
    loads = _mean_std(df.withColumn("metric", F.lit("processing_time_ms")), "processing_time_ms", ["load_id", "metric"])
    drift = numeric_drift.mean_drift(loads.select("load_id", "metric", "mean", "std"), base, ["metric"])
    return _rounded(drift, "mean", "std", "sigma")


def scale_injection(spark: SparkSession, folder: str) -> DataFrame:
    """Discounts of 0 to 1 multiplied by 100: range and drift before and after."""
    d = table(spark, folder, "lineitem").select("l_discount")
    scaled = F.when((F.col("l_discount") > 0) & (F.col("l_discount") <= 1), F.round(F.col("l_discount") * 100, 1)).otherwise(F.col("l_discount"))
    both = d.select(F.lit("before").alias("state"), F.col("l_discount").alias("v")).unionByName(d.select(F.lit("after").alias("state"), scaled.alias("v")))
    now = _mean_std(both, "v", ["state"])
    base = _mean_std(d.select(F.explode(F.array(F.lit("before"), F.lit("after"))).alias("state"), F.col("l_discount").alias("v")), "v", ["state"])
    outside = both.groupBy("state").agg(F.count_if(~p.in_unit_interval(F.col("v"))).alias("outside"))
    return _rounded(numeric_drift.mean_drift(now, base, ["state"]), "mean", "std", "sigma").join(outside, "state")


def violation_rate_trend(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(numeric_drift.rate_trend(table(spark, folder, "verdicts"), ~p.in_unit_interval(F.col("confidence")), 0.01), "rate")


def embedding_centroid(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(vectors.centroid(table(spark, folder, "embeddings"), "embedding"), "mean").select(F.col("dim").cast("bigint").alias("dim"), "mean")


def embedding_drift(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "embeddings")
    return vectors.cosine_drift(vectors.centroid(e.where("label % 2 = 0"), "embedding"), vectors.centroid(e.where("label % 2 = 1"), "embedding"))


def hash_token_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.token_buckets(table(spark, folder, "extractions").select(F.explode("extracted_facts.text").alias("text")), F.col("text"))


# --- graph, registry, schema versions ----------------------------------------------------------------------------------


def _geography(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Region to nation to customer and supplier as a lineage graph."""
    nation, customer, supplier, region = (table(spark, folder, t) for t in ("nation", "customer", "supplier", "region"))
    name = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    edges = (
        nation.select(name("r", "n_regionkey").alias("source"), name("n", "n_nationkey").alias("target"))
        .unionByName(customer.select(name("n", "c_nationkey").alias("source"), name("c", "c_custkey").alias("target")))
        .unionByName(supplier.select(name("n", "s_nationkey").alias("source"), name("s", "s_suppkey").alias("target")))
    )
    nodes = (
        region.select(name("r", "r_regionkey").alias("node_id"), F.lit("FILE").alias("type"))
        .unionByName(nation.select(name("n", "n_nationkey").alias("node_id"), F.lit("PIPELINE").alias("type")))
        .unionByName(customer.select(name("c", "c_custkey").alias("node_id"), F.lit("FILE").alias("type")))
        .unionByName(supplier.select(name("s", "s_suppkey").alias("node_id"), F.lit("TABLE").alias("type")))
    )
    return nodes, edges


def lineage_upstream(spark: SparkSession, folder: str) -> DataFrame:
    nodes, edges = _geography(spark, folder)
    starts = table(spark, folder, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("start"))
    return lineage.nearest(spark, edges, nodes, starts).select("start", "node", "hops", F.col("rank").cast("bigint").alias("rank"))


def blast_radius(spark: SparkSession, folder: str) -> DataFrame:
    nodes, edges = _geography(spark, folder)
    starts = nodes.where("node_id like 'r%' or node_id like 'n%'").select(F.col("node_id").alias("start"))
    return lineage.blast_radius(lineage.reach(spark, edges, starts), nodes)


def blame_score(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of suppliers' regions, by hops and by days before a fixed date."""
    nodes, edges = _geography(spark, folder)
    starts = table(spark, folder, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("start"), F.col("s_suppkey").alias("violation_id"))
    changed = table(spark, folder, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("node"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("r_regionkey")).alias("changed_at"))
    found = lineage.attribute(spark, starts, edges, nodes, changed, F.lit("2024-01-06").cast("date"))
    return found.select("violation_id", "node", "hops", F.col("days").cast("bigint").alias("days"), "score")


def downstream_consumers(spark: SparkSession, folder: str) -> DataFrame:
    edges = table(spark, folder, "lineage_snapshots").select(F.inline("edges"))
    return lineage.downstream_consumers(edges, "table::")


_SUBSCRIPTIONS = [
    ("alder-intake-terms", "sub-a", "facts", "reads facts"), ("alder-intake-terms", "sub-a", "refs.known", "joins on them"), ("alder-intake-terms", "sub-b", "duration", "plans by it"),
    ("dogwood-map-terms", "sub-b", "links.known", "walks them"), ("birch-bench-terms", "sub-c", "marks.bounds", "averages"), ("elm-log-terms", "sub-c", "order", "replays"),
]


#: What ids of the logged checks may start with.
_FAMILIES = ("alder", "birch", "cedar", "dogwood", "elm", "larch")


def _logged(spark: SparkSession, folder: str) -> DataFrame:
    v = table(spark, folder, "demo_blame").where("violation_id is not null and check_id is not null")
    return v.select(F.col("delivery_id").alias("violation_id"), F.col("source_contract_id").alias("contract_id"), F.lower(F.trim("check_id")).alias("check_id"))


def registry_match(spark: SparkSession, folder: str) -> DataFrame:
    """Subscribers concerned by each logged violation."""
    found = matching.concerned_subscribers(_logged(spark, folder), spark.createDataFrame(_SUBSCRIPTIONS, "contract_id string, subscriber_id string, field string, reason string"), _FAMILIES)
    return found.select("violation_id", "subscriber_id", F.array_join("fields", ",").alias("fields"))


def registry_rule(spark: SparkSession, folder: str) -> DataFrame:
    """Which registered fields concern which check ids, with the families of the declared datasets and ids across them."""
    ids = _logged(spark, folder).select(F.regexp_replace("check_id", r"^[a-z]+", "week3").alias("check_id"))
    across = ids.select(F.regexp_replace("check_id", r"^week3\.", F.lit("cross.week2.")).alias("check_id")).unionByName(ids.select(F.concat(F.lit("cross.ingest."), F.col("check_id")).alias("check_id")))
    ids = ids.unionByName(across).unionByName(ids.select(F.concat(F.lit("runner.schema.required."), F.substring_index("check_id", ".", -1)).alias("check_id"))).distinct()
    fields = spark.createDataFrame([(f,) for f in ("facts", "facts.score", "refs.known", "duration.min", "runner.schema.required", "cross.ingest", "order", "score", " ", "known")], "field string")
    pairs = ids.withColumn("_", F.lit(1)).join(F.broadcast(fields.withColumn("_", F.lit(1))), "_")  # ten fields
    return pairs.where(matching.field_concerns_check(F.col("field"), F.col("check_id"))).select("check_id", "field")


_STARTS = (attribution.Start("alder.", "pipeline::"), attribution.Start("elm.", "table::"), attribution.Start("birch.", "file::", of="FILE"), attribution.Start("", "pipeline::", kind="answer_shape"))


def _last_graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the last snapshot with nodes."""
    last = datasets.latest_snapshot(table(spark, folder, "lineage_snapshots").where("size(nodes) > 0"))
    nodes = last.select(F.posexplode("nodes").alias("position", "n")).select("position", "n.*")
    return nodes, last.select(F.inline("edges"))


def attributed_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Every logged violation with where its walk begins, its nearest file, the score of that and what lies below it, in the last lineage graph."""
    log = table(spark, folder, "demo_blame").where("violation_id is not null")
    v = log.select(F.col("delivery_id").alias("violation_id"), F.lower(F.trim("check_id")).alias("check_id"), "type", F.col("source_contract_id").alias("contract_id"), "records_failing")
    chain = log.select(F.inline("blame_chain")).where("file_path is not null")
    commits = chain.groupBy("file_path").agg(F.max(F.struct("commit_timestamp", "commit_hash", "author", "commit_message")).alias("c")).select("file_path", "c.*")
    nodes, edges = _last_graph(spark, folder)
    subs = spark.createDataFrame([(*s, "team", "WARN", "x") for s in _SUBSCRIPTIONS], "contract_id string, subscriber_id string, field string, reason string, subscriber_team string, validation_mode string, contact string")
    found = attribution.attribute_violations(spark, v, nodes, edges, subs, commits, F.lit("2017-03-01 00:00:00").cast("timestamp"), _STARTS, _FAMILIES)
    top = F.get("blame_chain", F.lit(0))
    return found.select(
        "violation_id", "start", F.coalesce(F.size("blame_chain"), F.lit(0)).alias("candidates"), top["file_path"].alias("file_path"), F.size("blast_radius.subscribers").alias("subscribers"),
        F.size("blast_radius.affected_nodes").alias("files"), F.size("blast_radius.affected_pipelines").alias("pipelines"), F.col("blast_radius.contamination_depth").alias("depth"),
    )


_OLD = {"doc_id": {"type": "string", "required": True}, "confidence": {"type": "number", "minimum": 0, "maximum": 1}, "facts": {"type": "array", "items": {"properties": {"text": {"type": "string"}, "page": {"type": "integer"}}}}, "gone": {"type": "object", "properties": {"a": {"type": "string"}}}}
_NEW = {"doc_id": {"type": "integer", "required": True}, "confidence": {"type": "number", "minimum": 0, "maximum": 100}, "facts": {"type": "array", "items": {"properties": {"text": {"type": "string", "maxLength": 9}}}}, "extra": {"type": "string"}, "must": {"type": "string", "required": True}}


def schema_diff_paths(spark: SparkSession, folder: str) -> DataFrame:
    rows = contract_diff.schema_rows(spark, {("extractions", "1"): _OLD, ("extractions", "2"): _NEW})
    return contract_diff.diff(rows).select("path", "change", "attribute", "breaking")


def schema_diff_files(spark: SparkSession, folder: str) -> DataFrame:
    """Fields of each file of text records against those of the file before it in its feed, each file being a version of its feed's schema."""
    fields = schema_drift.file_fields(spark, table(spark, folder, "raw_records")).where("size(path) > 0")
    attributes = F.array(F.struct(F.lit("present").alias("attribute"), F.lit("true").alias("value")), F.struct(F.lit("type").alias("attribute"), F.array_join("kinds", ",").alias("value")))
    rows = fields.select(F.col("feed").alias("contract_id"), F.col("file_name").alias("version"), F.array_join("path", ".").alias("path"), F.inline(attributes))
    return contract_diff.diff(rows).select("contract_id", "version", "path", "change", "attribute", "old_value", "new_value", "breaking")


def drawn_fields(spark: SparkSession, folder: str) -> DataFrame:
    """The fields of a contract drawn from the orders, with the bounds they keep."""
    drawn = contracts.draw_contract(table(spark, folder, "orders"), "orders").schema
    rows = [(n, s["type"], bool(s.get("required")), s.get("minimum"), s.get("maximum")) for n, s in drawn.items()]
    return spark.createDataFrame(rows, "field string, type string, required boolean, minimum double, maximum double")


def inferred_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """The kinds of each top-level key of all records of each dataset that came as text."""
    v = json_lines.parsed(table(spark, folder, "raw_records")).where("issue is null")
    name = lambda k: F.when(k.isin("DECIMAL", "DOUBLE", "FLOAT"), "NUMBER").otherwise(k)
    joined = F.array_join(F.array_sort(F.array_distinct(F.transform("kinds", name))), ",")
    kinds = [contract_diff.infer_kinds(v.where(F.col("dataset") == d), "v").select(F.lit(d).alias("dataset"), "key", joined.alias("kinds")) for d in ("events", "schema_evolution_demo")]
    return kinds[0].unionByName(kinds[1])


# --- results rolled up ---------------------------------------------------------------------------------------------------


def status_counts(spark: SparkSession, folder: str) -> DataFrame:
    return checks.summary(star_results(spark, folder))


def severity_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reporting.severity_counts(star_results(spark, folder))


def health_score(spark: SparkSession, folder: str) -> DataFrame:
    return reporting.health_score(reporting.worst_failures(star_results(spark, folder).select(*_SHOWN), ["records_failing"]))


_WEIGHTS = [("lineitem.", 2.0), ("lineitem.l_discount", 1.5), ("orders.", 0.5)]


def type_weighted_score(spark: SparkSession, folder: str) -> DataFrame:
    worst = reporting.worst_failures(star_results(spark, folder).select(*_SHOWN), ["records_failing"])
    return reporting.health_score(matching.longest_prefix(worst, "check_id", spark.createDataFrame(_WEIGHTS, "prefix string, weight double")), "weight")


def pass_rate(spark: SparkSession, folder: str) -> DataFrame:
    return reporting.pass_rate(star_results(spark, folder))


def worst_per_check(spark: SparkSession, folder: str) -> DataFrame:
    """Of the logged violations of each check the worst, ties to the most failing rows and the lowest delivery."""
    log = table(spark, folder, "demo_blame").where("check_id is not null").select(F.lower(F.trim("check_id")).alias("check_id"), F.lit("FAIL").alias("status"), "severity", (-F.col("records_failing")).alias("order_key"), "delivery_id")
    return reporting.worst_failures(log, ["order_key", "delivery_id"]).select("check_id", "severity", (-F.col("order_key")).alias("records_failing"), "delivery_id")


def prioritized_page(spark: SparkSession, folder: str) -> DataFrame:
    log = table(spark, folder, "demo_blame").where("check_id is not null and records_failing is not null")
    rows = log.select(F.lower(F.trim("check_id")).alias("check_id"), F.coalesce("source_contract_id", F.lit("?")).alias("column_name"), "severity", "records_failing")
    return reporting.page(reporting.prioritized(rows), 2, 5)


def top_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The first five failing customers of each clause, by key."""
    clauses = [Clause(c.check_id, c.column_name, c.check_type, c.violations, sample=F.col("c_custkey")) for c in customer_clauses()]
    return checks.samples(table(spark, folder, "customer"), clauses, [F.col("c_custkey")]).select("check_id", F.array_join(F.array_sort(F.transform("sample_failing", lambda x: x.cast("bigint"))), ",").alias("samples"))


def dedupe_log(spark: SparkSession, folder: str) -> DataFrame:
    """Logged violations, the first of each check and violation kept; null keys are kept as they are."""
    log = table(spark, folder, "demo_blame").select("delivery_id", "check_id", "violation_id")
    keyed = log.where("check_id is not null and violation_id is not null")
    first = keyed.groupBy("check_id", "violation_id").agg(F.min("delivery_id").alias("delivery_id"))
    return first.unionByName(log.where("check_id is null or violation_id is null"))


def subscriber_impact(spark: SparkSession, folder: str) -> DataFrame:
    return reporting.subscriber_impact(table(spark, folder, "demo_blame").select(F.col("blast_radius.subscribers").alias("subscribers")))


# --- reading, repairing, streaming -----------------------------------------------------------------------------------------


def ingest_issues(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "raw_records")
    return json_lines.issues(lines).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def quarantine_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """Records from whose first fact no prompt can be made: no path, or no text of 10 to 60 characters."""
    first = F.coalesce(F.try_element_at("extracted_facts", F.lit(1))["text"], F.lit(""))
    bad = p.falsy_text(F.col("source_path")) | ~F.length(first).between(10, 60)
    return table(spark, folder, "extractions").where(bad).groupBy("load_id").agg(F.count(F.lit(1)).alias("quarantined"))


def repaired_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Facts with confidence brought within 0 to 1 (above 1 it is a percentage) and only references that lead somewhere."""
    ids = F.transform("entities", lambda e: e["entity_id"])
    f = F.col("f")
    c = F.when(f["confidence"] > 1, f["confidence"] / 100).otherwise(f["confidence"])
    rows = table(spark, folder, "extractions").select("doc_id", "load_id", ids.alias("ids"), F.explode("extracted_facts").alias("f"))
    kept: Column = F.filter(f["entity_refs"], lambda r: F.coalesce(F.array_contains("ids", r), F.lit(False)))
    return rows.select("doc_id", "load_id", f["fact_id"].alias("fact_id"), F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)), 4).alias("confidence"), F.coalesce(F.size(kept), F.lit(0)).cast("bigint").alias("refs"))


_OUTPUT_SETTINGS = ai_checks.Settings(prompt_length=40)


def prompt_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Prompts that do not satisfy their schema, and so are not sent."""
    return ai_checks.prompt_check(table(spark, folder, "extractions"), _OUTPUT_SETTINGS)[0]


def output_schema_check(spark: SparkSession, folder: str) -> DataFrame:
    """Structured outputs against their schema, as a rate and its trend."""
    return ai_checks.verdict_check(table(spark, folder, "verdicts"), 0.05)


def output_violation_log(spark: SparkSession, folder: str) -> DataFrame:
    """Log records of all outputs that do not satisfy their schema, and of the rising rate."""
    verdicts = table(spark, folder, "verdicts")
    return ai_checks.verdict_violations(verdicts, "verdicts", ai_checks.verdict_check(verdicts, 0.05), most=None)


def trace_summary(spark: SparkSession, folder: str) -> DataFrame:
    return ai_checks.trace_check(table(spark, folder, "runs"))[0]


def text_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Hashed embeddings of all fact texts of the later loads against those of the first."""
    facts = table(spark, folder, "extractions").select("load_id", F.explode("extracted_facts.text").alias("text"))
    settings = ai_checks.Settings(sample=1 << 40, features=64)  # all texts
    _, base = ai_checks.text_drift(facts.where("load_id <= 'ex-00-0001'"), "text", None, settings)
    return ai_checks.text_drift(facts.where("load_id > 'ex-00-0001'"), "text", base, settings)[0]


def tumbling_event_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(tumbling_counts(table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"], "1 day", value="value"), "total").select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n", "total"
    )


def snapshot_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The last two deliveries of each codebase."""
    return sequences.last_two(table(spark, folder, "lineage_snapshots").select("codebase_root", "snapshot_id", "received_at"), ["codebase_root"], "received_at").select("codebase_root", "snapshot_id", F.col("age").cast("bigint").alias("age"))


# --- declared contracts ------------------------------------------------------------------------------------------------------

_DECLARED = {
    "doc_id": {"type": "string", "required": True, "unique": True, "minLength": 36, "maxLength": 36},
    "source_hash": {"type": "string", "required": True, "pattern": "^[a-f0-9]{64}$"},
    "processing_time_ms": {"type": "integer", "required": True, "minimum": 1, "maximum": 20000},
    "extraction_model": {"type": "string", "enum": ["refiner-layout-1", "refiner-layout-2", "refiner-vision-1"]},
    "token_count": {"type": "object", "properties": {"input": {"type": "integer", "required": True, "minimum": 1}}},
    "extracted_facts": {"type": "array", "minItems": 1, "items": {"properties": {"confidence": {"type": "number", "required": True, "minimum": 0, "maximum": 1}, "text": {"type": "string", "minLength": 1}, "entity_refs": {"type": "array", "items": {"type": "string", "required": True}}}}},
}


def declared_contract(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.validate(table(spark, folder, "extractions"), contracts.Contract("extractions", _DECLARED)).select(*_SHOWN)


def relational_tests(spark: SparkSession, folder: str) -> DataFrame:
    """The usual tests of the flat table of entities."""
    entities = table(spark, folder, "extractions").select("doc_id", F.inline("entities"))
    return contracts.relational_tests(entities, ["doc_id", "entity_id", "name", "type"], ["entity_id"], {"type": datasets.ENTITY_TYPES})


_TABLES = {"verdicts": "verdicts", "extractions": "extractions", "snapshots": "lineage_snapshots", "events": "event_log", "runs": "runs"}


def declared_contracts(spark: SparkSession, folder: str) -> DataFrame:
    """The contracts of five datasets, compiled from their schemas, as results."""
    parts = [contracts.validate(table(spark, folder, t), replace(declared.CONTRACTS[n], rules=())).select(*_SHOWN) for n, t in _TABLES.items()]
    return reduce(DataFrame.unionByName, parts)


def declared_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The quality rules of five datasets."""
    parts = [quality.evaluate(table(spark, folder, t), declared.CONTRACTS[n].rules).select(F.lit(n).alias("dataset"), "rule", "status") for n, t in _TABLES.items()]
    return reduce(DataFrame.unionByName, parts)


def model_tests(spark: SparkSession, folder: str) -> DataFrame:
    """The tests of the seven flat tables."""
    return declared.run_models(declared.model_tables(table(spark, folder, "extractions"), table(spark, folder, "event_log")))


def report_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Violations of the log and failing checks of a dataset as one list by priority."""
    log = table(spark, folder, "demo_blame").select("check_id", "type", "severity", "message", "records_failing", "blame_hint")
    return reporting.two_source_priorities(log, checks.run_checks(table(spark, folder, "extractions"), datasets.extractions())).select("check_id", "field", "severity", "records_failing", "position")


def report_top(spark: SparkSession, folder: str) -> DataFrame:
    return reporting.top_violations(report_rows(spark, folder)).select("check_id", "field", "severity", "records_failing")


def weighted_score(spark: SparkSession, folder: str) -> DataFrame:
    """The score of a dataset's checks with weights by prefix, one of them the default."""
    worst = reporting.worst_failures(checks.run_checks(table(spark, folder, "extractions"), datasets.extractions()).select(*_SHOWN), ["records_failing"])
    return reporting.health_score(reporting.weighted(worst, reporting.merged_weights({"default": 0.5, "week3.": 0.75}, {"week3.entities": 2, "week3.doc_id": True})), "weight")


def injected_scale(spark: SparkSession, folder: str) -> DataFrame:
    """The fault of a changed scale put into all extractions: the range check and the mean after it."""
    df = synthetic.inject_scale(table(spark, folder, "extractions"))
    held = spark.createDataFrame([("intake::extracted_facts.confidence.mean", 0.75, 0.15)], "key string, mean double, std double")
    drift = runner.drift_results(df, runner.metrics("extractions")[:1], held, "intake")
    return checks.run_checks(df, [c for c in datasets.extractions() if c.check_type == "range"]).unionByName(drift).select(*_SHOWN)


def failure_modes(spark: SparkSession, folder: str) -> DataFrame:
    """Who is hit by the fields that evolution reports call changed, how: each report is a version of its contract."""
    v = F.col("v")
    reports = json_lines.records(table(spark, folder, "raw_records").where("dataset = 'schema_evolution_demo'"))
    fields = F.try_variant_get(v, "$.diff.breaking_changes", "array<variant>")
    changes = reports.select(F.try_variant_get(v, "$.contract_id", "string").alias("contract_id"), F.concat_ws("#", "file_name", "line_no").alias("version"), F.explode(fields).alias("c"))
    changes = changes.select("contract_id", "version", F.try_variant_get("c", "$.field", "string").alias("path"), F.lit("changed").alias("change"), F.lit(True).alias("breaking")).where("path is not null and contract_id is not null")
    subs = spark.createDataFrame(_SUBSCRIPTIONS, "contract_id string, subscriber_id string, field string, reason string")
    return migration.failure_modes(changes, subs).select("contract_id", "version", "subscriber_id", F.array_join("fields", ",").alias("fields"), "mode")


def json_schema_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts against a JSON Schema with free keys, on their columns."""
    schema = {
        "type": "object", "required": ["verdict_id", "overall_verdict", "scores", "overall_score"],
        "properties": {
            "verdict_id": {"type": "string", "minLength": 36}, "overall_verdict": {"enum": ["PASS", "FAIL", "WARN"]}, "overall_score": {"type": "number", "minimum": 1, "maximum": 5}, "confidence": {"type": "number", "minimum": 0, "maximum": 1},
            "scores": {"type": "object", "minProperties": 3, "additionalProperties": {"type": "object", "required": ["score"], "properties": {"score": {"type": "integer", "minimum": 1, "maximum": 5}, "evidence": {"type": "array", "items": {"type": "string"}}}}},
        },
    }
    verdicts = table(spark, folder, "verdicts").select("load_id", F.struct("verdict_id", "overall_verdict", "overall_score", "confidence", "scores").alias("v"))
    return verdicts.groupBy("load_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(~json_schema.column_valid(verdicts, "v", schema)).alias("invalid"))


def drawn_contract(spark: SparkSession, folder: str) -> DataFrame:
    """A contract drawn from the line items holds for them."""
    lines = table(spark, folder, "lineitem")
    return contracts.validate(lines, contracts.draw_contract(lines, "lineitem")).groupBy("check_type", "status").agg(F.count(F.lit(1)).alias("n"))
