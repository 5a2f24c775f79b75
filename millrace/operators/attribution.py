"""From violations to their likely causes and to whom they touch: a start in the lineage graph, the files above it with their last changes, and what lies below the nearest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import commit_time, node_path
from ..functions.text import instant
from . import lineage, matching


@dataclass(frozen=True)
class Start:
    """``check``: what a check id starts with, or (``exact``) is; ``kind``: the type of a violation, instead. ``node``: what the id of a node holds, or (``whole``) is; ``of``: its type."""

    check: str
    node: str
    exact: bool = False
    whole: bool = False
    kind: str | None = None
    of: str | None = None


def starts(extractor: str, mapper: str, mapper_file: str) -> tuple[Start, ...]:
    """The rules of the known datasets, given the nodes of their graph: the pipelines that extract documents and that map lineage, and the file of the latter.

    The first rule whose check and node are there counts; after all of them, the first node.
    """
    # Which node the walk of a check begins at.
    exact = {
        "week3.extracted_facts.confidence.range": extractor, "week3.extracted_facts.entity_refs.relationship": extractor, "week3.extracted_facts.non_empty": extractor, "week5.payload.jsonschema": mapper,
        "week5.sequence_number.monotonic": mapper, "cross.week2.target_ref.in_week1_code_refs": mapper, "cross.week4.doc_id.as_lineage_node": extractor,
    }
    families = [
        Start("week3.", extractor), Start("week5.", mapper), Start("cross.week4", extractor, whole=True), Start("week1.", "week1", of="FILE"), Start("week2.", mapper_file), Start("cross.week2", mapper_file), Start("week4.", mapper_file),
        Start("cross.week4", mapper_file), Start("langsmith.", extractor), Start("cross.", extractor), Start("", mapper_file, kind="llm_output_schema"), Start("", extractor, kind="langsmith_trace_schema"),
    ]
    return (*(Start(c, n, exact=True, whole=True) for c, n in exact.items()), *families)


def resolve_starts(violations: DataFrame, nodes: DataFrame, rules: Sequence[Start] = ()) -> DataFrame:
    """``violations`` (``violation_id, check_id, type, ...``) with ``start``, the node its walk begins at; null where there are no nodes.

    ``nodes`` has ``node_id, type, position``. The node of each rule is found in one pass over the nodes, the one at the first position.
    """
    def there(r: Start) -> Column:
        named = (F.col("node_id") == r.node) if r.whole else F.contains(F.col("node_id"), F.lit(r.node))
        return named & (F.col("type") == r.of) if r.of else named

    first = lambda when: F.min(F.when(when, F.struct("position", "node_id")))["node_id"]
    found = nodes.where("node_id is not null").agg(F.array(*(first(there(r)) for r in rules)).cast("array<string>").alias("of_rules"), first(F.lit(True)).alias("any"))
    check = F.coalesce("check_id", F.lit(""))

    def meant(i: int, r: Start) -> Column:
        asks = (F.col("type") == r.kind) if r.kind else (check == r.check) if r.exact else check.startswith(r.check)
        return F.when(asks, F.get("of_rules", F.lit(i)))

    placed = violations.join(F.broadcast(found))  # one row
    return placed.withColumn("start", F.coalesce(*(meant(i, r) for i, r in enumerate(rules)), F.col("any"))).drop("of_rules", "any")


_UNKNOWN = {"commit_hash": "0" * 40, "author": "unknown", "commit_timestamp": None, "commit_message": "no change known"}
#: Days since its last change that a file without a known one counts as.
UNKNOWN_DAYS = 30


def attribute_violations(
    spark: SparkSession, violations: DataFrame, nodes: DataFrame, edges: DataFrame, subscriptions: DataFrame, commits: DataFrame, now: Column,
    rules: Sequence[Start] = (), families: Sequence[str] = matching.FAMILIES, most: int = 5,
) -> DataFrame:
    """Each violation with ``start, blame_chain`` and ``blast_radius``.

    ``violations``: ``violation_id`` (unique), ``check_id, type, contract_id, records_failing``; ``nodes``: ``node_id, type, metadata, position``; ``commits``: the last change
    of each ``file_path`` as ``commit_hash, author, commit_timestamp, commit_message``; ``subscriptions`` as of :func:`matching.subscriber_summaries`. Chains have at most
    ``most`` files, nearest first; without any above the start, the first file of the graph at no distance. What lies below is that of the nearest file. The graph is
    walked once for each distinct start and each distinct nearest file.
    """
    started = resolve_starts(violations, nodes, rules)
    above = lineage.nearest(spark, edges, nodes, started.select("start"), most=most)
    other = nodes.where("type = 'FILE'").agg(F.min(F.struct("position", "node_id"))["node_id"].alias("file"))
    lonely = started.select("start").where("start is not null").distinct().join(above.select("start").distinct(), "start", "left_anti")
    spare = lonely.join(F.broadcast(other)).where("file is not null").select("start", F.col("file").alias("node"), F.lit(0).cast("bigint").alias("hops"), F.lit(1).alias("rank"))
    candidates = above.select("start", "node", "hops", "rank").unionByName(spare)
    # a path of the graph is looked up once
    files = candidates.select("node").distinct().join(nodes.select(F.col("node_id").alias("node"), "metadata").dropDuplicates(["node"]), "node", "left").select("node", node_path(F.col("node"), F.col("metadata")).alias("file_path"))
    files = files.join(commits, "file_path", "left")
    at = instant(commit_time(F.col("commit_timestamp")))
    days = F.when(at.isNull(), float(UNKNOWN_DAYS)).otherwise(F.greatest(F.lit(0.0), (F.unix_seconds(now) - F.unix_seconds(at)) / 86400.0))
    known = {c: F.coalesce(c, F.lit(v)) for c, v in _UNKNOWN.items()}
    chain = candidates.join(files, "node").select("start", F.struct("rank", "file_path", *(v.alias(c) for c, v in known.items()), lineage.blame_score(days, F.col("hops")).alias("confidence_score")).alias("c"), F.when(F.col("rank") == 1, F.col("node")).alias("nearest"))
    chains = chain.groupBy("start").agg(F.array_sort(F.collect_list("c")).alias("blame_chain"), F.max("nearest").alias("nearest"))  # at most ``most`` rows
    below = lineage.affected(lineage.reach(spark, edges, chains.select(F.col("nearest").alias("start")).where("start is not null")), nodes).withColumnRenamed("start", "nearest")
    told = matching.subscriber_summaries(violations, subscriptions, families)
    whole = started.join(chains, "start", "left").join(below, "nearest", "left").join(told, "violation_id", "left")
    none = F.array().cast("array<string>")
    radius = F.struct(
        "subscribers", F.coalesce("affected_nodes", none).alias("affected_nodes"), F.coalesce("affected_pipelines", none).alias("affected_pipelines"),
        F.coalesce("records_failing", F.lit(0)).cast("bigint").alias("estimated_records"), F.coalesce("depth", F.lit(0)).cast("bigint").alias("contamination_depth"),
    )
    return whole.select(*violations.columns, "start", "blame_chain", radius.alias("blast_radius"))


def majority_commit(lines: DataFrame) -> DataFrame:
    """``file_path, commit_hash``: the commit that most of a file's looked-at lines come from, ties to the lowest hash; from rows ``file_path, commit_hash``, one for a line."""
    counts = lines.where("commit_hash is not null").groupBy("file_path", "commit_hash").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("file_path").agg(F.min(F.struct((-F.col("n")).alias("n"), "commit_hash"))["commit_hash"].alias("commit_hash"))
