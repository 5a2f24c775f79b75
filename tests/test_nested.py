"""Flat tables and references: nulls and empties at every depth, quotes of names."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.nested import dangling_edges, dangling_within, flatten_table, record_table, related_tables

FACTS = "doc_id string, extracted_facts array<struct<fact_id:string,entity_refs:array<string>>>, entities array<struct<entity_id:string>>"
SNAP = "snapshot_id string, nodes array<struct<node_id:string>>, edges array<struct<source:string,target:string>>"


def test_levels(spark):
    df = spark.createDataFrame([("a", [("f", ["x", None]), ("g", []), ("h", None), None], None), ("b", None, None), ("c", [], None), ("a", [("f", ["x", None])], None)], FACTS)
    refs = flatten_table(df, ["extracted_facts", "entity_refs"], {"doc_id": F.col("doc_id")}, {0: {"fact_id": "fact_id"}}, value="ref")
    assert rows(refs, "doc_id", "fact_id", "pos_extracted_facts", "pos_entity_refs", "ref") == sorted([("a", "f", 0, 0, "x"), ("a", "f", 0, 1, None)] * 2, key=repr)
    facts = flatten_table(df, ["extracted_facts"], {"doc_id": F.col("doc_id")})
    assert rows(facts, "doc_id", "fact_id") == sorted([("a", "f"), ("a", "g"), ("a", "h"), ("a", None), ("a", "f")], key=repr)
    with pytest.raises(ValueError):
        flatten_table(df, ["extracted_facts"], {"fact_id": F.col("doc_id")})


def test_references_to_nothing(spark):
    df = spark.createDataFrame(
        [("a", [("f", ["x", "z", "z", None]), ("g", None), None], [("x",), (None,), None]), ("b", [("f", ["x"])], None), ("c", None, [("x",)]), (None, [(None, ["q"])], [])], FACTS
    )
    got = dangling_within(df, "extracted_facts", "entity_refs", "fact_id", ("entities", "entity_id"), {"record_id": F.col("doc_id")})
    assert rows(got) == sorted([("a", "f", "z"), ("b", "f", "x"), (None, None, "q")], key=repr)


def test_edges(spark):
    df = spark.createDataFrame([("s", [("a",), ("b",), None], [("a", "b"), ("a", "c"), ("A", "b"), ("a", None), (None, "q"), None]), ("t", None, [("a", "b")]), ("u", [("a",)], None), ("v", [], [])], SNAP)
    got = dangling_edges(df, {"record_id": F.col("snapshot_id")})
    assert rows(got) == sorted([("s", "a", "c"), ("s", "A", "b"), ("s", None, "q"), ("t", "a", "b")], key=repr)
    assert dangling_edges(df.where("false"), {"record_id": F.col("snapshot_id")}).count() == 0


def test_maps_and_records(spark, tmp_path):
    schema = "snapshot_id string, received_at timestamp, nodes array<struct<node_id:string,place:struct<root:string,at:struct<line:int>>,metadata:map<string,string>>>"
    one = ("s", None, [("a", ("r", (1,)), {"k": "1", "l": None}), ("b", None, None), None, ("c", ("q", None), {})])
    spark.createDataFrame([one, one], schema).coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    parts = related_tables(spark.read.parquet(f"{tmp_path}/t.parquet"))
    assert sorted(parts) == ["nodes", "nodes.metadata", "records"]
    got = parts["nodes.metadata"]
    assert rows(got, "pos_nodes", "key", "value") == sorted([(0, "k", "1"), (0, "l", None)] * 2, key=repr)
    nodes = parts["nodes"]
    assert rows(nodes, "node_id", "place_root", "place_at_line") == sorted([("a", "r", 1), ("b", None, None), (None, None, None), ("c", "q", None)] * 2, key=repr)
    assert nodes.select("record", "pos_nodes").distinct().count() == nodes.count() == 8 and got.select("record").distinct().count() == 2
    assert parts["records"].join(nodes, "record").count() == 8


def test_steps_through_structs_and_names_that_meet(spark):
    df = spark.createDataFrame([(1, (2, [("a", [("f", "r")])])), (2, None)], "id int, b struct<depth:int,subs:array<struct<name:string,hits:array<struct<field:string,reason:string>>>>>")
    hits = flatten_table(df, ["b.subs", "hits"], {"id": F.col("id")}, {0: {"name": "name"}})
    assert rows(hits) == [(1, "a", 0, 0, "f", "r")]
    with pytest.raises(ValueError):
        record_table(spark.createDataFrame([(1, (2,))], "a_b int, a struct<b:int>"))
