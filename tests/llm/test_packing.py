"""Packing: bounds, cutting, the fullest bin against brute force."""

import itertools
import random

import pytest
from millrace.llm import packing
from millrace.llm.packing import fullest, pack, plan_bins


@pytest.mark.parametrize("seed", range(40))
def test_fullest_is_the_fullest(seed):
    r = random.Random(seed)
    room, left = r.randrange(1, 30), {r.randrange(1, 15): r.randrange(1, 4) for _ in range(r.randrange(0, 5))}
    chosen = fullest(room, left)
    assert all(uses <= left[n] for n, uses in chosen.items())
    best = max(s for c in itertools.product(*(range(k + 1) for k in left.values())) if (s := sum(n * u for n, u in zip(left, c, strict=True))) <= room)
    assert sum(n * u for n, u in chosen.items()) == best


@pytest.mark.parametrize("seed", range(10))
def test_plan_places_every_item_once(seed):
    r = random.Random(seed)
    counts = {r.randrange(1, 100): r.randrange(1, 500) for _ in range(30)}
    bins = plan_bins(counts, 100)
    placed: dict[int, int] = {}
    for times, b in bins:
        assert times > 0 and sum(n * u for n, u in b.items()) <= 100
        for n, u in b.items():
            placed[n] = placed.get(n, 0) + u * times
    assert placed == counts
    # no two items of more than half a bin can share one
    least = max(sum(n * c for n, c in counts.items()) / 100, sum(c for n, c in counts.items() if n > 50))
    assert sum(t for t, _ in bins) <= least * 1.1 + 2


def test_whole_result(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_GROUP", 7)  # ranks in several groups, as of a hot length
    r = random.Random(1)
    data = [(i, r.choice([0, 3, 3, 3, 5, 10, 11, 20, 20, 47, 64, None]), "x", 1) for i in range(120)] + [(7, 3, "again", 1)]
    items = spark.createDataFrame(data, "doc_id bigint, tokens bigint, bin string, rank int")
    out = pack(spark, items, [10, 20]).collect()
    for cap in (10, 20):
        mine = [x for x in out if x.capacity == cap]
        sums: dict[str, int] = {}
        for x in mine:
            if x.bin is not None:
                sums[x.bin] = sums.get(x.bin, 0) + x.tokens
        assert max(sums.values()) <= cap
        assert sum(sums.values()) == sum(t or 0 for _, t, _, _ in data)
        assert len(sums) <= sum(sums.values()) / cap + 3
        for i, t, _, _ in data[:-1]:
            pieces = sorted((x.piece, x.tokens, x.bin) for x in mine if x.doc_id == i)
            if i == 7:
                continue
            t = t or 0
            assert [p for p, _, _ in pieces] == list(range(max(1, -(-t // cap)))) and sum(n for _, n, _ in pieces) == t
            assert all(n == cap for _, n, _ in pieces[:-1])
            assert (pieces[0][2] is None) == (t == 0)
    assert sum(x.doc_id == 7 and x.capacity == 20 for x in out) >= 2


def test_empty_and_bad(spark):
    assert pack(spark, spark.createDataFrame([], "doc_id bigint, tokens bigint"), [5]).count() == 0
    for bad in ([], [0], [1 << 30]):
        with pytest.raises(ValueError):
            pack(spark, spark.createDataFrame([], "doc_id bigint, tokens bigint"), bad)
