"""The text queries that have SQL against it, and what the others must keep, over the whole small tables."""

import pytest
from millrace.llm import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark, run_queries):
    return run_queries(spark, registry.queries(), FOLDER)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(results, oracle, name):
    oracle(name, results[name].result(), registry.oracle_sql()[name], FOLDER)


#: What must hold of all rows of a query that SQL cannot express.
KEPT = {
    "p8_packed": lambda rows: len({(r.capacity, r.doc_id, r.piece) for r in rows}) == len(rows) and all(0 <= r.tokens <= r.capacity and (r.bin is None) == (r.tokens == 0) for r in rows),
    "p8_fill": lambda rows: len(rows) == 4 and all(r.bins >= r.least_bins and 0.9 <= r.filled <= 1 for r in rows),
    "p9_mixes": lambda rows: len({(r.mix, r.source, r.doc_id, r.repeat) for r in rows}) == len(rows) > 0 and all(r.tokens > 0 for r in rows),
    "p9_report": lambda rows: all(r.most_repeats <= r.max_repeats and r.missed == (r.actual_tokens < r.wanted_tokens) for r in rows) and all(abs(sum(x.actual_share for x in rows if x.mix == m) - 1) < 1e-9 for m in {r.mix for r in rows}),
    "p10_found": lambda rows: len(set(rows)) == len(rows) > 0 and all(sum(x.doc_id == r.doc_id for x in rows) == 1 for r in rows if r.subject == "other"),
    "p10_composition": lambda rows: len(rows) > 0 and sum(r.share for r in rows) >= 1 - 1e-9,
}


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_keeps(results, name):
    assert KEPT[name](results[name].result()[1])
