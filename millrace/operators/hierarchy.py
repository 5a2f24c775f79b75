"""Full hierarchies from parent-child links, by heavy-path decomposition.

1. Cycle separation. Pointer doubling follows every node to its 2^k-th ancestor. A node that reaches a root
   is in a tree; when a round settles no further node, all that are left run into a ring. The same rounds
   give root, depth and the size of every subtree.
2. Chains. The heavy child of a node is the one with the largest subtree; a chain runs from a head along
   heavy children. A path from a root meets at most log2(n) chains.
3. Labels. Chains are placed so that each subtree is one interval of positions within its tree: heavy child
   first, light ones after it. Descendants of a node are the rows of its tree whose position lies in
   ``(pos, last]``. Its path is the segments of the chains above it, put together.

Nodes are numbered first, so that the rounds move small numbers. All steps are joins and aggregates, written to the shared folder
between rounds; their number grows with the logarithm of the depth, not with the depth. What is settled is written once, and
a parent of very many children is joined in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import packed_id, unpacked_id
from ..sources.shared import Workspace
from .skew import look_up

#: Light siblings of one parent are numbered in groups of about this many.
SIBLING_GROUP = 100_000
#: Positions of a tree are cut into blocks of this many, by which descendants are found.
BLOCK = 4096


def _n() -> Column:
    return F.col("n")


def _long(x: int | None) -> Column:
    return F.lit(x).cast("bigint")


def numbered_links(work: Workspace, df: DataFrame, id_column: str, parent_column: str) -> tuple[DataFrame, int]:
    """``n, id, parent`` for each node, and how many there are; ids differ by more than letter case and outer blanks.

    ``n`` is a number of the node, ``parent`` that of its parent. Rows without id are no nodes. Repeated rows of a node
    agree on its parent; where they do not, a parent that is given wins over none, then the greatest. A parent that is no node
    itself, whether a word for "none" or a row that never arrived, makes its child a root.
    """
    pairs = df.select(packed_id(F.col(id_column)).alias("id"), packed_id(F.col(parent_column)).alias("above"))
    nodes = pairs.where("id is not null").groupBy("id").agg(F.max("above").alias("above"))
    nodes = work.write(nodes.withColumn("n", F.monotonically_increasing_id()), "ids")
    rows = nodes.count()
    numbers = nodes.select(F.col("id").alias("above"), F.col("n").alias("parent"))
    known = look_up(nodes.where("above is not null"), numbers, "above", rows, F.col("n"), "left")
    links = known.select("n", "id", "parent").unionByName(nodes.where("above is null").select("n", "id", F.lit(None).cast("bigint").alias("parent")))
    return work.write(links, "links"), rows


def _settle(work: Workspace, nodes: DataFrame) -> DataFrame:
    """Pointer doubling: ``n, parent, root, depth, size`` of the nodes in trees; those that run into a ring stay open and are left out.

    ``up`` is the ancestor reached so far and ``depth`` the steps to it; a node is open until a root is reached. ``size`` is the number of
    nodes below within fewer steps than that, itself included; a round adds to it the sizes of the nodes whose ``up`` it is.
    """
    start = nodes.select("n", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), _n()).alias("root"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("bigint").alias("depth"), _long(1).alias("size"))
    last, rounds = work.write(start.withColumn("gain", _long(None)), "round-0"), ["round-0"]
    left = last.where("up is not null").count()
    while left:
        # a round's table holds the nodes that were open, as they are after it, and what others gain from it
        open_ = last.where("up is not null").select("n", "up", "depth", "size")
        gain = open_.groupBy(F.col("up").alias("n")).agg(F.sum("size").alias("gain"))
        ahead = open_.select(F.col("n").alias("up"), F.col("up").alias("up2"), _long(None).alias("root"), F.col("depth").alias("more"))
        settled = work.together(rounds, last).where("root is not null")
        ahead = ahead.unionByName(settled.select(F.col("n").alias("up"), _long(None).alias("up2"), "root", F.col("depth").alias("more")))
        moved = look_up(open_, ahead, "up", left, _n()).select("n", F.col("up2").alias("up"), "root", (F.col("depth") + F.col("more")).alias("depth"), "size")
        grown = moved.join(gain, "n", "left").withColumn("size", F.col("size") + F.coalesce("gain", _long(0))).withColumn("gain", _long(None))
        rounds.append(f"round-{len(rounds)}")
        last = work.write(grown.unionByName(gain, allowMissingColumns=True), rounds[-1])
        now = last.where("up is not null").count()
        if now == left:
            break
        left = now
    found = work.together(rounds, last)
    gains = found.where("gain is not null").groupBy("n").agg(F.sum("gain").alias("gain"))
    sized = found.where("root is not null").drop("gain").join(gains, "n", "left").select("n", "root", "depth", (1 + F.coalesce("gain", _long(0))).alias("size"))
    return work.write(sized.join(nodes.select("n", "parent"), "n"), "trees")


def _offsets(work: Workspace, trees: DataFrame, rows: int) -> DataFrame:
    """Each node with its offset from its parent's position and whether it is the heavy child.

    The heavy child stands at 1; the light ones follow its subtree in groups by a hash. They are summed up in groups,
    whose totals are summed up per parent, so that a parent of very many children is no single task.
    """
    kids = trees.where("parent is not null")
    fans = kids.groupBy("parent").agg(
        F.max(F.struct("size", "n")).alias("h"), (F.count(F.lit(1)) / F.lit(SIBLING_GROUP)).cast("bigint").alias("fan")
    )
    fans = fans.select("parent", F.col("h.n").alias("heir"), F.col("h.size").alias("heavy_size"), "fan")
    kids = look_up(kids, fans, "parent", rows, _n()).select(
        "n", "parent", "root", "depth", "size", "heavy_size", (_n() == F.col("heir")).alias("heavy"), F.pmod(F.xxhash64("n"), F.col("fan") + 1).alias("grp")
    )
    kids = work.write(kids, "kids")
    light = kids.where("not heavy")
    one = W.partitionBy("parent").orderBy("grp").rowsBetween(W.unboundedPreceding, -1)
    groups = light.groupBy("parent", "grp").agg(F.sum("size").alias("total"))
    groups = groups.select("parent", "grp", F.coalesce(F.sum("total").over(one), F.lit(0)).alias("before"))
    within = W.partitionBy("parent", "grp").orderBy("n").rowsBetween(W.unboundedPreceding, -1)
    light = light.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0))).join(groups, ["parent", "grp"])
    light = light.withColumn("off", 1 + F.col("heavy_size") + F.col("before") + F.col("within"))
    columns = ["n", "parent", "root", "depth", "size", "heavy", "off"]
    roots = trees.where("parent is null").select("n", "parent", "root", "depth", "size", F.lit(False).alias("heavy"), _long(0).alias("off"))
    heavy = kids.where("heavy").withColumn("off", F.lit(1).cast("bigint"))
    return work.write(light.select(columns).unionByName(heavy.select(columns)).unionByName(roots), "offsets")


def _chains(work: Workspace, nodes: DataFrame) -> DataFrame:
    """``n, head, seat``: the head of each node's chain and the steps from it, by doubling along heavy links, of which a node has one at most."""
    heavy = F.col("heavy")
    start = nodes.select("n", F.when(heavy, F.col("parent")).alias("up"), F.when(~heavy, _n()).alias("head"), heavy.cast("bigint").alias("seat"))
    last, rounds = work.write(start, "chains-0"), ["chains-0"]
    while True:
        open_ = last.where("up is not null")
        if open_.isEmpty():
            break
        ahead = open_.select(F.col("n").alias("up"), F.col("up").alias("up2"), _long(None).alias("head2"), F.col("seat").alias("more"))
        seated = work.together(rounds, last).where("head is not null")
        ahead = ahead.unionByName(seated.select(F.col("n").alias("up"), _long(None).alias("up2"), F.col("head").alias("head2"), F.col("seat").alias("more")))
        moved = open_.select("n", "up", "seat").join(ahead, "up").select("n", F.col("up2").alias("up"), F.col("head2").alias("head"), (F.col("seat") + F.col("more")).alias("seat"))
        rounds.append(f"chains-{len(rounds)}")
        last = work.write(moved, rounds[-1])
    return work.together(rounds, last).where("head is not null").select("n", "head", "seat")


def hierarchy(spark: SparkSession, df: DataFrame, id_column: str, parent_column: str, paths: bool = True) -> DataFrame:
    """Every node once, with its place in its tree.

    Columns: ``id``; ``parent`` (null for a root); ``root``; ``depth`` (0 for a root); ``path`` (ids from the
    root to the node, only with ``paths``; it is as long as the node is deep); ``descendants`` (their number); ``pos`` and ``last`` (the node's
    position in its tree and the greatest position below it); ``chain`` (id of the head of its heavy path); ``endless`` (true for nodes that get no
    position, as going up from them never ends: in a ring or below one). Of an endless node all but ``id``, ``parent`` and
    ``endless`` is null. An empty table gives an empty one; further columns are not looked at.
    """
    work = Workspace(spark, "hierarchy")
    links, rows = numbered_links(work, df, id_column, parent_column)
    offsets = _offsets(work, _settle(work, links.select("n", "parent")), rows)
    nodes = work.write(offsets.join(_chains(work, offsets), "n"), "nodes")
    # the tree of chains, from the root chains down; at most log2(n) levels
    above = nodes.select(F.col("n").alias("parent"), F.col("head").alias("over"), F.col("seat").alias("at"))
    heads = work.write(look_up(nodes.where("not heavy").select("n", "parent", "off"), above, "parent", rows, _n(), "left").drop("parent"), "heads")
    names = links.select("n", "id")
    segments = None
    none = F.array().cast("array<binary>")
    if paths:
        seated = nodes.select("n", "head", "seat").join(names, "n")
        segments = work.write(seated.groupBy("head").agg(F.array_sort(F.collect_list(F.struct("seat", "id"))).alias("s")).select("head", F.col("s.id").alias("segment")), "segments")
    level = work.write(heads.where("over is null").select(F.col("n").alias("head"), _long(0).alias("start"), none.alias("prefix")), "level-0")
    levels = ["level-0"]
    while True:
        base = level.join(segments, "head") if paths else level.withColumn("segment", none)
        base = base.select(F.col("head").alias("over"), "start", "prefix", "segment")
        below = look_up(heads.where("over is not null"), base, "over", rows, _n()).select(
            F.col("n").alias("head"), (F.col("start") + F.col("at") + F.col("off")).alias("start"),
            (F.concat("prefix", F.slice("segment", F.lit(1), F.col("at").cast("int") + 1)) if paths else none).alias("prefix"),
        )
        levels.append(f"level-{len(levels)}")
        level = work.write(below, levels[-1])
        if level.isEmpty():
            break
    placed = work.together(levels, level)
    placed = placed.join(segments, "head") if paths else placed.withColumn("segment", none)
    tree = look_up(nodes, placed, "head", rows, _n())
    path = [F.transform(F.concat("prefix", F.slice("segment", F.lit(1), F.col("seat").cast("int") + 1)), unpacked_id).alias("path")] if paths else []
    pos = F.col("start") + F.col("seat")
    tree = tree.select(
        "n", "parent", "root", F.col("head").alias("chain"), "depth", *path, (F.col("size") - 1).alias("descendants"), pos.alias("pos"), (pos + F.col("size") - 1).alias("last")
    )
    # a node without a position is one from which going up never ends
    tree = links.join(tree.drop("parent"), "n", "left")
    for c in ("parent", "root", "chain"):
        tree = look_up(tree, names.select(F.col("n").alias(c), F.col("id").alias(f"{c}_id")), c, rows, _n(), "left")
    named = [unpacked_id(F.col(f"{c}_id")).alias(c) for c in ("parent", "root")]
    return tree.select(
        unpacked_id(F.col("id")).alias("id"), *named, "depth", *(["path"] if paths else []), "descendants", "pos", "last", unpacked_id(F.col("chain_id")).alias("chain"), F.col("pos").isNull().alias("endless")
    )


def endless_nodes(spark: SparkSession, df: DataFrame, id_column: str, parent_column: str) -> DataFrame:
    """``id`` of the nodes from which going up never ends: those that the labels of :func:`hierarchy` leave without a position."""
    return hierarchy(spark, df, id_column, parent_column, paths=False).where("endless").select("id")


def descendants_of(tree: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``(id, descendant)`` for the nodes in ``ids`` (column ``id``), or for all, from the intervals of :func:`hierarchy`.

    An interval is cut into blocks of :data:`BLOCK` positions and meets only the nodes of its blocks, so a single large
    tree is spread over tasks like many small ones. There is a row for each pair, so for all nodes as many as their depths add up to.
    """
    placed = tree.where("not endless")
    top = placed if ids is None else placed.join(ids.select("id").distinct(), "id", "left_semi")
    block = lambda c: F.floor(F.col(c) / F.lit(BLOCK)).cast("bigint")
    top = top.where("last > pos").select(F.col("id").alias("of"), "root", F.col("pos").alias("lo"), F.col("last").alias("hi"), F.explode(F.sequence(block("pos"), block("last"))).alias("block"))
    below = placed.select("id", "root", "pos", block("pos").alias("block"))
    return below.join(top, ["root", "block"]).where("pos > lo and pos <= hi").select(F.col("of").alias("id"), F.col("id").alias("descendant"))
