"""Walks over a lineage graph: what lies upstream of a node, what lies downstream, and how near."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import Workspace


def _steps(work: Workspace, edges: DataFrame, upstream: bool) -> DataFrame:
    a, b = ("target", "source") if upstream else ("source", "target")
    return work.write(edges.select(F.col(a).alias("node"), F.col(b).alias("next")).where("node is not null and next is not null").distinct(), "edges")


def _level(work: Workspace, names: list[str], level: DataFrame, front: DataFrame, steps: DataFrame) -> DataFrame:
    """One step on: what ``front`` leads to and no level before has; all levels are read by one scan."""
    found = front.join(steps, "node").select("start", F.col("next").alias("node")).distinct()
    fresh = found.join(work.together(names, level).select("start", "node"), ["start", "node"], "left_anti")
    fresh = work.write(fresh.withColumn("hops", F.lit(len(names)).cast("bigint")), f"level-{len(names)}")
    names.append(f"level-{len(names)}")
    return fresh


def _begin(work: Workspace, starts: DataFrame) -> tuple[DataFrame, list[str]]:
    level = starts.select("start").where("start is not null").distinct().select("start", F.col("start").alias("node"), F.lit(0).cast("bigint").alias("hops"))
    return work.write(level, "level-0"), ["level-0"]


def reach(spark: SparkSession, edges: DataFrame, starts: DataFrame, upstream: bool = False, most_hops: int | None = None) -> DataFrame:
    """``start, node, hops``: all nodes reached from each start, at the fewest hops; the start itself at 0.

    ``edges`` has ``source, target``, ``starts`` has ``start``. One level is a join of the frontier with the edges and an anti-join
    with what is known; cycles end by themselves. Each distinct start is walked once. Levels are tables in the shared folder. The result is
    as long as all starts reach; where only the nearest matter, :func:`nearest` ends a start early.
    """
    work = Workspace(spark, "reach")
    steps = _steps(work, edges, upstream)
    level, names = _begin(work, starts)
    while not level.isEmpty() and (most_hops is None or len(names) <= most_hops):
        level = _level(work, names, level, level, steps)
    return work.together(names, level)


def nearest(spark: SparkSession, edges: DataFrame, nodes: DataFrame, starts: DataFrame, kind: str = "FILE", most: int = 5, upstream: bool = True) -> DataFrame:
    """``start, node, hops, rank``: the nearest ``most`` nodes of ``kind`` above each start, ties by id.

    A start is walked no further than the level that completes its candidates, so it costs as much as they are near.
    """
    work = Workspace(spark, "nearest")
    steps = _steps(work, edges, upstream)
    wanted = work.write(nodes.where(F.col("type") == kind).select(F.col("node_id").alias("node")).where("node is not null").distinct(), "wanted")
    level, names = _begin(work, starts)
    front = level
    while not front.isEmpty():
        level = _level(work, names, level, front, steps)
        seen = work.together(names, level)
        done = seen.where("hops >= 1").join(wanted, "node", "left_semi").groupBy("start").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= most)
        front = level.join(done.select("start"), "start", "left_anti")
    return upstream_candidates(work.together(names, level), wanted.select(F.col("node").alias("node_id"), F.lit(kind).alias("type")), kind, most)


def upstream_candidates(reached: DataFrame, nodes: DataFrame, kind: str = "FILE", most: int = 5) -> DataFrame:
    """``start, node, hops, rank``: the nearest ``most`` nodes of ``kind`` above each start, ties by id."""
    of = reached.where("hops >= 1").join(nodes.where(F.col("type") == kind).select(F.col("node_id").alias("node")).distinct(), "node")
    return of.withColumn("rank", F.row_number().over(W.partitionBy("start").orderBy("hops", "node"))).where(F.col("rank") <= most)


def blast_radius(reached: DataFrame, nodes: DataFrame) -> DataFrame:
    """``start, depth, files, pipelines``: the greatest hops and how many files and how many pipelines or models are reached."""
    j = reached.join(nodes.select(F.col("node_id").alias("node"), "type"), "node", "left")
    return j.groupBy("start").agg(
        F.max("hops").alias("depth"), F.count_if((F.col("type") == "FILE") & (F.col("hops") > 0)).alias("files"),
        F.count_if(F.col("type").isin("PIPELINE", "MODEL") & (F.col("hops") > 0)).alias("pipelines"),
    )


def affected(reached: DataFrame, nodes: DataFrame) -> DataFrame:
    """``start, depth, affected_nodes, affected_pipelines``: what lies below each start by name, in order; the lists are as long as that is much."""
    j = reached.join(nodes.select(F.col("node_id").alias("node"), "type").distinct(), "node", "left")
    below = F.col("hops") > 0
    names = lambda *kinds: F.array_sort(F.collect_set(F.when(below & F.col("type").isin(*kinds), F.col("node"))))
    return j.groupBy("start").agg(F.max("hops").alias("depth"), names("FILE").alias("affected_nodes"), names("PIPELINE", "MODEL").alias("affected_pipelines"))


def blame_score(days: Column, hops: Column) -> Column:
    """1 less a tenth for each day and a fifth for each hop, not below 0, to four digits."""
    return F.greatest(F.lit(0.0), F.round(1 - 0.1 * days - 0.2 * hops, 4))


def file_path(node: Column) -> Column:
    """The path in a node id ``file::path`` with forward slashes."""
    return F.regexp_replace(F.regexp_replace(node, r"\\", "/"), "^file::", "")


def consumers(edges: DataFrame, nodes: DataFrame, producer: Column, collapse: str = "table::doc:") -> DataFrame:
    """``documents, files, pipelines``: what the edges out of the nodes that ``producer`` picks lead to: how many single documents, and the other files and pipelines by name."""
    of = edges.join(nodes.where(producer).select(F.col("node_id").alias("source")).distinct(), "source", "left_semi").select("target").where("target is not null").distinct()
    kinds = of.join(nodes.select(F.col("node_id").alias("target"), "type").distinct(), "target", "left")
    single = F.col("target").startswith(collapse)
    names = lambda *t: F.array_sort(F.collect_set(F.when(~single & F.col("type").isin(*t), F.col("target"))))
    return kinds.agg(F.count_if(single).alias("documents"), names("FILE").alias("files"), names("PIPELINE", "MODEL").alias("pipelines"))


def downstream_consumers(edges: DataFrame, collapse: str = "table::doc:") -> DataFrame:
    """``consumer, edges``: targets of edges, those that start with ``collapse`` put together in one row."""
    name = F.when(F.col("target").startswith(collapse), F.lit(collapse + "*")).otherwise(F.col("target"))
    return edges.where("target is not null").groupBy(name.alias("consumer")).agg(F.count(F.lit(1)).alias("edges"))


def attribute(spark: SparkSession, violations: DataFrame, edges: DataFrame, nodes: DataFrame, changes: DataFrame, at: Column, most: int = 5) -> DataFrame:
    """Candidates for the cause of each violation: ``violation_id, node, hops, rank, days, score``.

    ``violations`` has ``violation_id, start``; ``changes`` has ``node, changed_at``, the last change of a node. The graph is walked once for
    each distinct start. A node without a known change counts as changed today.
    """
    above = nearest(spark, edges, nodes, violations, most=most)
    days = F.greatest(F.lit(0), F.coalesce(F.datediff(at, F.col("changed_at")), F.lit(0)))
    dated = above.join(changes, "node", "left").withColumn("days", days)
    scored = dated.withColumn("score", blame_score(F.col("days"), F.col("hops")))
    return violations.select("violation_id", "start").join(scored, "start").select("violation_id", "node", "hops", "rank", "days", "score")
