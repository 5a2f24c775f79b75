"""Every query that has SQL gives what its SQL gives, over the whole small tables; what the others must keep is asserted of them."""

import pytest

from millrace.plans import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark, run_queries):
    return run_queries(spark, registry.queries(), FOLDER)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(results, oracle, name):
    oracle(name, results[name].result(), registry.oracle_sql()[name], FOLDER)


#: What must hold of each row, or of all rows, of a query that SQL cannot express.
KEPT = {
    "p4_fact_rows": lambda rows: len({(r.record, r.pos_extracted_facts) for r in rows}) == len(rows) > 0,
    "p5_changes": lambda rows: all(r.effect > 0 and r.z > 0 and r.table_name in ("extractions", "verdicts") for r in rows),
    "p5_found": lambda rows: len(set(rows)) == len(rows) and not any("[]" in r.column_name for r in rows),
    "p5_malformed": lambda rows: all(r.malformed > 0 for r in rows),
    "p7_changes": lambda rows: all(r.cost >= 0 and (r.to_field is None) == (r.change_kind not in ("renamed", "moved")) for r in rows),
    "p7_found": lambda rows: len(set(rows)) == len(rows) and {r.change_kind for r in rows} <= {"added", "removed", "renamed", "type_changed"},
    "p7_table": lambda rows: len({(r.file_name, r.line_no) for r in rows}) == len(rows) > 0 and all(None not in r.fields.values() for r in rows),
    "p7_events": lambda rows: len({(r.file_name, r.line_no) for r in rows}) == len(rows) > 0 and all("event_id" in r.asDict() for r in rows),
    "p7_reports": lambda rows: len(rows) > 0 and all(isinstance(r["diff.type_changes"], (str, type(None))) for r in rows),
    "text_drift": lambda rows: len(rows) == 1 and (rows[0].drift is None or 0 <= rows[0].drift <= 2),
}


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_keeps(results, name):
    assert KEPT[name](results[name].result()[1])
