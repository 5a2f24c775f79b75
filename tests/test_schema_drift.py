"""Scripts between schemas, the report, and the consistent table."""

import itertools
import json
import random

import pytest
from conftest import rows
from millrace.operators import schema_tree as st
from millrace.operators.schema_drift import consistent_table, reported, schema_changes, typed_tables

SCHEMA = "dataset string, feed string, file_name string, line_no bigint, raw string, fields string"


def lines(spark, files):
    return spark.createDataFrame([("d", "f", name, i, x if isinstance(x, (str, type(None))) else json.dumps(x), "clash") for name, records in files.items() for i, x in enumerate(records)], SCHEMA)


def changes(spark, *files):
    return rows(reported(schema_changes(spark, lines(spark, {f"f/{i}": x for i, x in enumerate(files)}))), "file_name", "field", "change_kind")


@pytest.mark.parametrize("seed", range(30))
def test_assignment_is_the_cheapest(seed):
    r = random.Random(seed)
    n, m = r.randrange(1, 5), r.randrange(5, 7)
    cost = [[r.choice([0, 1, 2.5, 1e9, -1]) for _ in range(m)] for _ in range(n)]
    found = st.assignment(cost)
    assert len(set(found)) == n
    assert sum(cost[i][c] for i, c in enumerate(found)) == pytest.approx(min(sum(cost[i][c] for i, c in enumerate(p)) for p in itertools.permutations(range(m), n)))


def test_added_removed_typed(spark):
    assert changes(spark, [{"a": 1, "b": {"x": 1}}, {"a": None}], [{"a": "1", "b": {"x": 1, "y": [{"z": 1}]}}], [{"b": {"x": 1}}, "no json", None, "[]", "", '{"q": NaN}']) == sorted(
        [("f/1", "a", "type_changed"), ("f/1", "b.y", "added"), ("f/2", "a", "removed"), ("f/2", "b.y", "removed")], key=repr
    )


def test_only_the_outermost(spark):
    assert changes(spark, [{"a": "s", "b": {"x": 1, "y": {"z": 2}}}], [{"a": {"name": "s"}}]) == [("f/1", "a", "type_changed"), ("f/1", "b", "removed")]


def test_renames(spark):
    one = [{"payload": {"status": s, "bytes": i * 100}, "event_type": f"K{s}", "flag": True} for i, s in enumerate(["filed", "broken"] * 10)]
    two = [{"body": {"status": s, "bytes": i * 90}, "type": f"K{s}", "other": True} for i, s in enumerate(["broken", "filed"] * 10)]
    assert changes(spark, one, two) == sorted([("f/1", "payload", "renamed"), ("f/1", "event_type", "renamed"), ("f/1", "flag", "removed"), ("f/1", "other", "added")], key=repr)
    three = [{"payload": {"state": r["payload"]["status"], "bytes": 1}, "event_type": "x y", "note": {"k": 1}} for r in one]
    assert changes(spark, [{k: v for k, v in r.items() if k != "flag"} for r in one], three) == sorted([("f/1", "note", "added"), ("f/1", "payload.status", "renamed")], key=repr)


def test_names_are_told_by_whole_values_and_all_of_them(spark):
    """Values that agree in their first 64 characters are different; a common value beyond the first hundreds counts."""
    head = "the same beginning of every value, long enough to fill a prefix "
    one = [{"k": head + f"k{i}", "same": 1} for i in range(300)]
    other = [{"zz": head + "other " * (i % 40 + 1) + str(i), "same": 1} for i in range(300)]
    assert changes(spark, one, other) == [("f/1", "k", "removed"), ("f/1", "zz", "added")]
    again = [{"zz": r["k"], "same": 1} for r in one]
    assert changes(spark, one, again) == [("f/1", "k", "renamed")]
    half = [{"zz": f"{i:04d}:{'x' * (i % 9)}|" if i % 2 else r["k"], "same": 1} for i, r in enumerate(one)]
    assert changes(spark, one, half) == [("f/1", "k", "renamed")]


def test_broken_characters(spark):
    assert changes(spark, ['{"a": "\\ud800x", "b": 1}'], ['{"c": "\\ud800x", "b": 1}']) == [("f/1", "a", "renamed")]


def test_moved_is_removed_and_added(spark):
    one, two = [{"a": {"trace": {"span": "q", "depth": 1}}, "b": {}}], [{"a": {}, "b": {"trace": {"span": "q", "depth": 1}}}]
    df = lines(spark, {"f/0": one, "f/1": two})
    assert rows(schema_changes(spark, df), "field", "change_kind", "to_field") == [("a.trace", "moved", "b.trace")]
    assert changes(spark, one, two) == sorted([("f/1", "a.trace", "removed"), ("f/1", "b.trace", "added")], key=repr)


def test_consistent_table_keeps_first_names(spark):
    r = lambda **k: k
    df = lines(spark, {
        "f/0": [r(payload={"bytes": 10, "doc_id": "a"}), "broken {", r(payload=None)],
        "f/1": [r(body={"bytes": 20, "doc_id": "b"})],
        "f/2": [r(body={"size_bytes": 30, "doc_id": "c", "tags": [1]})],
        "f/3": [r(payload={"size_bytes": 40, "doc_id": "d"})],
    })
    got = consistent_table(spark, df, schema_changes(spark, df))
    assert rows(got.selectExpr("file_name", "line_no", "fields['payload.bytes'] b", "fields['payload.doc_id'] d", "size(fields) n")) == sorted(
        [("f/0", 0, "10", "a", 2), ("f/0", 2, None, None, 0), ("f/1", 0, "20", "b", 2), ("f/2", 0, "30", "c", 3), ("f/3", 0, "40", "d", 2)], key=repr
    )


def test_file_without_records_and_empty_table(spark):
    assert changes(spark, [{"a": 1}], ["null"], [{"a": 2}]) == [("f/1", "a", "removed"), ("f/2", "a", "added")]
    assert changes(spark) == []


def test_consistent_table_renames_inside_arrays(spark):
    types = ["integer", "string", "number", "boolean"] * 5
    one = [{"diff": {"type_changes": [{"field": f"col_{i}.x", "was": {"kind_a": t}}, {"field": f"k_{i}.y", "was": {"kind_a": t}}], "n": i}} for i, t in enumerate(types)]
    two = [{"diff": {"type_changes": [{"column_name": c["field"], "was": c["was"]} for c in r["diff"]["type_changes"]], "n": 1}} for r in one]
    df = lines(spark, {"f/0": one, "f/1": two, "f/2": two})
    found = schema_changes(spark, df)
    assert rows(found, "file_name", "field", "change_kind", "to_field") == [("f/1", "diff.type_changes.field", "renamed", "diff.type_changes.column_name")]
    got = consistent_table(spark, df, found).collect()
    assert len(got) == 60
    for r in got:
        assert json.loads(r.fields["diff.type_changes"]) == one[r.line_no]["diff"]["type_changes"]


def test_a_name_used_again(spark):
    note = lambda i: f"note number {i}"
    ids = [f"{i:08x}-0000-4000-8000-{i:012x}" for i in range(20)]
    df = lines(spark, {
        "f/0": [{"run_id": x} for x in ids], "f/1": [{"run_ref": x} for x in ids],
        "f/2": [{"run_ref": x, "run_id": i} for i, x in enumerate(ids)],  # another field takes the first name
        "g/0": [{"run_id": x, "k": 1} for x in ids], "g/1": [{"run_ref": x, "k": 1} for x in ids], "g/2": [{"k": 1}], "g/3": [{"k": 1, "run_ref": note(1)}],
    }).selectExpr("dataset", "substring(file_name, 1, 1) feed", "file_name", "line_no", "raw", "fields")
    got = {(r.file_name, r.line_no): r.fields for r in consistent_table(spark, df, schema_changes(spark, df)).collect()}
    assert got["f/1", 3] == {"run_id": ids[3]} and got["f/2", 3] == {"run_ref": ids[3], "run_id": "3"}
    assert got["g/1", 3] == {"run_id": ids[3], "k": "1"} and got["g/3", 0] == {"k": "1", "run_ref": note(1)}


def test_typed_tables(spark):
    df = lines(spark, {
        "f/0": [{"n": 1, "x": 1, "t": "a", "ok": True, "l": [1], "line_no": 5, "N": 2}, {"n": 2, "x": 2.5}],
        "f/1": [{"n": 3, "x": 3, "t": 7, "ok": None, "l": [2, 3], "line_no": 6, "N": 4}],
    })
    work = consistent_table(spark, df, schema_changes(spark, df))
    got = typed_tables(spark, work)["d"]
    assert dict(got.dtypes) == {"feed": "string", "file_name": "string", "line_no": "bigint", "N": "bigint", "l": "string", "line_no_": "bigint", "n_": "bigint", "ok": "boolean", "t": "string", "x": "double"}
    assert rows(got, "file_name", "n_", "x", "t", "ok", "l", "line_no_") == sorted([("f/0", 1, 1.0, "a", True, "[1]", 5), ("f/0", 2, 2.5, None, None, None, None), ("f/1", 3, 3.0, "7", None, "[2, 3]", 6)], key=repr)
    assert typed_tables(spark, work.limit(0)) == {}
