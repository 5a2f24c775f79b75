"""Snapshot differences against plain comparison; tables that are too small; order and repeats."""

import random

import pytest
from conftest import rows
from millrace.operators.snapshots import consecutive, differences, node_changes, node_items

SCHEMA = (
    "snapshot_id string, codebase_root string, captured_at string, received_at timestamp, "
    "nodes array<struct<node_id:string,type:string,label:string,metadata:map<string,string>>>, n int, key string"
)


def frame(spark, data):
    from datetime import datetime

    return spark.createDataFrame([(i, root, at, datetime(2017, 1, 20, received), nodes, 1, "k") for i, root, at, received, nodes in data], SCHEMA)


def node(i, kind="FILE", **metadata):
    return (i, kind, i, metadata)


def test_kinds_and_what_means_nothing(spark):
    data = [
        ("s1", "r", "2017-01-01T00:00:00Z", 1, [node("a", x="1", y="2"), node("b"), node("c"), (None, "FILE", "", {})]),
        ("s2", "r", "1483315200000", 5, [node("c", "TABLE"), node("a", y="2", x="1"), node("d"), node("d")]),
        ("s2", "r", "2017-01-02 00:00:00", 9, [node("d"), node("a", x="1", y="2"), node("c", "TABLE")]),
        ("s3", "r", "20170103T000000Z", 2, [node("d"), node("a", x="1"), ("c", "TABLE", None, {})]),
        ("s4", "r", "2017-01-04T00:00:00Z", 3, None),
        ("t1", "q", "2017-01-02T00:00:00Z", 3, [node("z")]),
        (None, "r", "2017-01-03T12:00:00Z", 3, [node("z")]),
    ]
    assert rows(node_changes(spark, frame(spark, data))) == sorted(
        [("s2", "b", "removed"), ("s2", "c", "changed"), ("s2", "d", "added"), ("s3", "a", "changed"), ("s3", "c", "changed")] + [("s4", x, "removed") for x in "acd"], key=repr
    )


@pytest.mark.parametrize("cells,enlargements", [(24, 4), (6, 1), (6, 0)])
def test_random_snapshots_whatever_the_table_size(spark, cells, enlargements):
    r = random.Random(cells)
    now, data = {f"n{i}": 0 for i in range(300)}, []
    for s in range(4):
        data.append((f"s{s}", "r", f"2017-01-0{s + 1}T00:00:00Z", 1, [node(k, v=str(v)) for k, v in now.items()]))
        now = {k: v + (r.random() < 0.1 * s) for k, v in now.items() if r.random() > 0.1 * s} | {f"m{s}-{i}": 0 for i in range(30 * s)}
    df = frame(spark, data)
    items = node_items(spark, df)
    got = differences(spark, items, consecutive(df), cells, enlargements)
    named = got.join(items.select("key", "node_id").distinct(), "key")
    want, before = [], None
    for s, _, _, _, nodes in data:
        mine = {n[0]: n[3] for n in nodes}
        if before is not None:
            want += [(s, k, "added") for k in mine.keys() - before.keys()] + [(s, k, "removed") for k in before.keys() - mine.keys()]
            want += [(s, k, "changed") for k in mine.keys() & before.keys() if mine[k] != before[k]]
        before = mine
    assert rows(named, "snapshot_id", "node_id", "change_kind") == sorted(want, key=repr)


def test_empty(spark):
    assert node_changes(spark, frame(spark, [])).count() == 0
