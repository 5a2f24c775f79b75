"""Value counts, exact metrics, signed deltas, and loads in which a column changes."""

import math
import random
from datetime import datetime, timedelta

from conftest import rows
from millrace.operators.profile_drift import ValueCounts, changed_columns, loads_in_order, metrics, value_counts

SCHEMA = "load_id string, loaded_at timestamp, a string, b double, t struct<x:bigint>, f array<struct<c:double,r:array<string>>>, m map<string,struct<s:int>>, n bigint, key string, form string"


def row(load, a="v", b=1.0, t=(1,), f=(), m=None, n=0):
    return (load, datetime(2017, 1, 1) + timedelta(days=int(load)), a, b, t, [tuple(x) for x in f] if f is not None else None, m, n, None, "")


def test_metrics_are_exact(spark):
    df = spark.createDataFrame([row("1", a=None, b=2.0, f=[(0.5, ["x", None]), (None, None)], m={"k": (3,)}), row("1", a="", b=None, t=None, f=None), row("1", a="w", b=-4.0), row("1", a="w", b=-4.0)], SCHEMA)
    counts, names = value_counts(df)
    assert names == ["a", "b", "t", "t.x", "f", "f.c", "f.r", "f.r[]", "m", "m.key", "m.s", "n", "key", "form"]
    got = {r.column_name: r for r in metrics(counts, names).collect()}
    assert (got["a"]["values"], got["a"].nulls, got["a"].distinct) == (4, 1, 2)
    assert math.isclose(got["a"].entropy, math.log2(3) - 2 / 3, abs_tol=1e-8)
    assert (got["b"].nulls, got["b"].distinct, got["b"].least, got["b"].greatest, got["b"]["mean"]) == (1, 2, -4.0, 2.0, -2.0)
    assert (got["f"]["values"], got["f"].nulls, got["f"].greatest) == (4, 1, 2.0)
    assert (got["f.c"]["values"], got["f.c"].nulls) == (2, 1)
    assert (got["f.r"]["values"], got["f.r"].nulls, got["f.r[]"]["values"], got["f.r[]"].nulls) == (2, 1, 2, 1)
    assert (got["m.s"].least, got["m.key"].distinct, got["m"].nulls) == (3.0, 1, 3)
    assert (got["key"].nulls, got["key"].distinct, got["key"].entropy) == (4, 0, 0.0)


def test_signed_deltas(spark):
    one, two = (spark.createDataFrame([row(str(k), a=f"{i % 3}", b=float(i)) for i in range(9)], SCHEMA) for k in (1, 2))
    store = ValueCounts(spark)
    store.apply(one)
    before = rows(store.read())
    store.apply(two)
    store.apply(two, sign=-1)
    assert rows(store.read()) == before
    store.compact()
    assert rows(store.read()) == before


def test_a_store_goes_on_in_another_session_load_by_load(spark, tmp_path):
    loads = [spark.createDataFrame([row(str(k), a=f"{i % 3}", b=float(i)) for i in range(9)], SCHEMA) for k in (1, 2, 3)]
    path = f"file://{tmp_path}/store"
    for df in loads:
        ValueCounts(spark, path).apply(df)  # opened again for each
    store = ValueCounts(spark, path)
    one_pass = ValueCounts(spark)
    one_pass.apply(loads[0].unionByName(loads[1]).unionByName(loads[2]))
    assert store.names == one_pass.names and rows(store.read()) == rows(one_pass.read())
    assert rows(store.read("2")) == [x for x in rows(one_pass.read()) if x[0] == "2"]
    store.take_back("2")
    assert rows(store.read()) == [x for x in rows(one_pass.read()) if x[0] != "2"]
    odd = spark.createDataFrame([row("1")[:0] + ("", *row("1")[1:]), (None, *row("1")[1:])], SCHEMA)
    store.apply(odd)  # blank and null loads are two
    assert {x[0] for x in rows(store.read())} == {"1", "3", "", None}
    store.compact()
    assert {x[0] for x in rows(ValueCounts(spark, path).read())} == {"1", "3", "", None}
    with open(f"{tmp_path}/store/names/0/_SUCCESS"):
        pass


def test_limits_on_data_they_were_not_set_on(spark):
    """Columns and changes unlike those of the test tables: at least 19 of 20 planted changes are found, and little else."""
    r, loads, n = random.Random(11), 24, 250
    planted = {  # column -> loads in which it is another
        "a": (5, 6), "b": (9,), "n": (14, 15), "key": (3,), "form": (18,), "t.x": (11,), "f": (20,), "m.s": (7, 8),
    }
    data = []
    for k in range(loads):
        here = {c for c, ks in planted.items() if k in ks}
        for i in range(n):
            a = None if "a" in here and r.random() < 0.3 else f"AC-{r.randrange(10**5):05d}/{r.choice('KLM')}"
            b = r.lognormvariate(3, 0.6) * (1.8 if "b" in here else 1)
            t = (r.randrange(50, 90) if "t.x" in here else r.randrange(100),)
            f = [(r.random(), None)] * (r.randrange(4) + 3 * ("f" in here))
            m = {"k": (r.choice([1, 1, 5] if "m.s" in here else [1, 2, 3, 4, 5]),)}
            whole = r.choice([10, 20, 30, 40, 99] if "n" in here else [10, 20, 30, 40])
            key = r.choices(["lorry", "van", "bike", "tram"], [5, 3, 1, 3 if "key" in here else 0])[0]
            form = f"{r.randrange(28) + 1}.{r.randrange(12) + 1}.2019" if "form" in here else f"2019-{r.randrange(12) + 1:02d}-{r.randrange(28) + 1:02d}"
            data.append((f"{k:02d}", datetime(2017, 1, 1) + timedelta(days=k), a, b, t, f, m, whole, key, form))
    df = spark.createDataFrame(data, SCHEMA)
    store = ValueCounts(spark)
    store.apply(df)
    found = {(x.column_name, x.load_id) for x in changed_columns(spark, store, loads_in_order(df)).collect()}
    want = {(c, f"{k:02d}") for c, ks in planted.items() for k in (ks[0], ks[-1] + 1)}
    assert len(found & want) >= 0.95 * len(want), want - found
    assert len(found - want) <= 0.1 * len(found), found - want


def test_changes_are_found_where_they_start_and_end(spark):
    r, data = random.Random(3), []
    for k in range(12):
        for _ in range(300):
            a = None if k in (4, 5) and r.random() < 0.4 else ("X-1" if k == 8 else r.choice("pqrs"))
            b = r.gauss(100, 20) * (0.001 if k in (6, 7) else 1)
            if r.random() < 0.005:
                b = 1e9  # single bad values mean nothing
            data.append(row(str(k), a=a, b=b, n=r.randrange(5)))
    df = spark.createDataFrame(data, SCHEMA)
    store = ValueCounts(spark)
    store.apply(df)
    found = changed_columns(spark, store, loads_in_order(df))
    assert {(x.column_name, x.load_id) for x in found.collect()} == {("a", "4"), ("a", "6"), ("a", "8"), ("a", "9"), ("b", "6"), ("b", "8")}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    store = ValueCounts(spark)
    store.apply(df)
    assert metrics(store.read(), store.names).count() == 0
    assert changed_columns(spark, store, loads_in_order(df)).count() == 0


def test_range_and_malformed_values_of_text(spark):
    data = [row(str(k), a=f"{i:04d}-{k}") for k in (1, 2) for i in range(100)] + [row("2", a="?"), row("2", a="12/3"), row("2", a=None)]
    store = ValueCounts(spark)
    store.apply(spark.createDataFrame(data, SCHEMA))
    got = {(r.load_id, r.column_name): r for r in metrics(store.read(), store.names).collect()}
    assert (got["1", "a"].least_text, got["1", "a"].greatest_text, got["1", "a"].malformed) == ("0000-1", "0099-1", 0)
    assert (got["2", "a"].least_text, got["2", "a"].greatest_text, got["2", "a"].malformed) == ("0000-2", "?", 2)
    assert (got["2", "b"].least_text, got["2", "b"].malformed) == (None, None)
    whole = {r.column_name: r for r in metrics(store.read(), store.names, per_load=False).collect()}
    assert (whole["a"].least_text, whole["a"].greatest_text, whole["a"].malformed, whole["a"].nulls) == ("0000-1", "?", 2, 1)


def found_in(spark, make, loads=8, n=200):
    """Column ``a`` of loads whose values ``make(load, i)`` gives: the loads where it changes."""
    df = spark.createDataFrame([row(str(k), a=make(k, i)) for k in range(loads) for i in range(n)], SCHEMA)
    store = ValueCounts(spark)
    store.apply(df)
    return {x.load_id for x in changed_columns(spark, store, loads_in_order(df)).collect() if x.column_name == "a"}


def test_formats_are_those_of_whole_texts(spark):
    r = random.Random(5)
    digest = lambda: f"{r.getrandbits(256):064x}"
    assert found_in(spark, lambda k, i: digest() + "f" * 15 * (k == 5)) == {"5", "6"}  # 64 and 79 characters
    assert found_in(spark, lambda k, i: digest()[:32] + "*" * 32 if k == 5 else digest()) == {"5", "6"}
    assert found_in(spark, lambda k, i: "".join(r.choices("abcdef" if k == 5 else "0123456789", k=12))) == {"5", "6"}
    assert found_in(spark, lambda k, i: digest().upper() if k == 5 else digest()) == {"5", "6"}
    assert found_in(spark, lambda k, i: digest()) == set()


def test_values_of_a_single_load(spark):
    def verdict(k, i):
        return "SKIP" if k == 5 and i % 10 == 0 else ("PASS" if i % 10 < 6 else "WARN" if i % 10 < 9 else "FAIL")

    assert found_in(spark, verdict, n=400) == {"5", "6"}
    assert found_in(spark, lambda k, i: verdict(k - 2, i), n=400) == {"7"}  # in the last load
    assert found_in(spark, lambda k, i: "two" if k == 4 else "one") == {"4", "5"}
    assert found_in(spark, lambda k, i: f"run-{k}-{i % 5}") == set()  # every load has its own
