"""Mixing: shares, caps, blocks, van der Corput points."""

import pytest
from millrace.llm import mixing
from millrace.llm.mixing import mix_sources, van_der_corput
from pyspark.sql import functions as F

TARGETS = "mix string, size_ratio double, source string, target_share double, max_repeats bigint"
DOCS = "doc_id bigint, source string, tokens bigint, mix string, slot int"


def test_points(spark):
    got = [r[0] for r in spark.range(8).select(van_der_corput(F.col("id"))).collect()]
    assert got == [0, 0.5, 0.25, 0.75, 0.125, 0.625, 0.375, 0.875]


@pytest.mark.parametrize("group", [500_000, 40])
def test_shares_and_caps(spark, monkeypatch, group):
    monkeypatch.setattr(mixing, "GROUP", group)
    docs = [(i, ("A ", "a", " A")[i % 3], 5 + i % 20, "m", 0) for i in range(900)] + [(1000 + i, "b", 10, "m", 0) for i in range(300)] + [(2000 + i, "C", 10, "m", 0) for i in range(10)]
    docs += [(3000, None, 50, "m", 0), (3001, "b", 0, "m", 0), (3002, "b", None, "m", 0), (3003, "d", 9, "m", 0)]
    targets = [("m", 1.0, "a", 0.6, 1), ("m", 1.0, "b", 0.38, 3), ("m", 1.0, "c", 0.02, 4), ("n", 0.5, "c", 0.5, 4), ("n", 0.5, "zz", 0.5, 2)]
    mixes, report = mix_sources(spark, spark.createDataFrame(docs, DOCS), spark.createDataFrame(targets, TARGETS), block_tokens=50)
    total = sum(t or 0 for _, _, t, _, _ in docs)
    r = {(x.mix, x.source): x for x in report.collect()}
    assert {k: x.missed for k, x in r.items()} == {("m", "a"): False, ("m", "b"): False, ("m", "c"): False, ("n", "c"): True, ("n", "zz"): True}
    assert r["m", "b"].supply_tokens == 9000 and r["m", "b"].wanted_tokens == pytest.approx(0.38 * total)
    for k in (("m", "a"), ("m", "b"), ("m", "c")):
        assert r[k].actual_tokens == pytest.approx(r[k].wanted_tokens, abs=250)
    assert r["n", "c"].actual_tokens == 400 and r["n", "c"].most_repeats == 4 and r["n", "zz"].actual_tokens == 0
    rows = mixes.collect()
    assert max(x.repeat for x in rows if (x.mix, x.source) == ("m", "a")) == 0
    assert len({(x.mix, x.doc_id, x.repeat) for x in rows}) == len(rows)
    assert sum(x.tokens for x in rows if x.mix == "m") == sum(x.actual_tokens for x in report.collect() if x.mix == "m")
    # every stretch of the mix keeps the shares
    early = [x for x in rows if x.mix == "m" and x.slot < 100]
    assert sum(x.tokens for x in early if x.source == "a") / sum(x.tokens for x in early) == pytest.approx(0.6, abs=0.08)


def test_empty(spark):
    mixes, report = mix_sources(spark, spark.createDataFrame([], DOCS), spark.createDataFrame([("m", 1.0, "a", 1.0, 1)], TARGETS))
    assert mixes.count() == 0 and report.first().missed is False
    mixes, report = mix_sources(spark, spark.createDataFrame([], DOCS), spark.createDataFrame([], TARGETS))
    assert mixes.count() == 0 and report.count() == 0
