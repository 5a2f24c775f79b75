"""One copy of each message: spellings, replays, compaction."""

from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.messages import MessageStore, deduplicate, message_key, surplus, survivors

A = "0a000000-0000-4000-8000-00000000000a"


def keyed(spark, data):
    df = spark.createDataFrame(data, "delivery_id bigint, violation_id string, check_id string, message_key string")
    return df, df.select(message_key([F.col("violation_id")], [F.col("check_id")]).alias("message_key"), "delivery_id", F.pmod("delivery_id", F.lit(3)).cast("string").alias("batch_id"))


DATA = [
    (5, A, "x", ""), (3, A.upper(), " X ", ""), (9, "{" + A + "}", "x", ""), (4, A, "y", ""), (1, None, "x", ""), (2, " ", "x", ""),
    (6, "not a uuid", None, ""), (7, "not a uuid ", None, ""), (8, "not a uuid", "", ""), (10, "Not a uuid", None, ""),
]


def test_surplus(spark):
    _, k = keyed(spark, DATA)
    assert rows(surplus(k, survivors(spark, k, buckets=4)), "delivery_id") == [(5,), (7,), (8,), (9,)]


def test_replays_and_compaction_change_nothing(spark, tmp_path):
    _, k = keyed(spark, DATA)
    store = MessageStore(spark, f"file://{tmp_path}/store", 4)
    for part in ("delivery_id > 5", "delivery_id <= 5", "delivery_id > 5", "true"):
        store.upsert(k.where(part))
    before = rows(store.read())
    store.compact()
    assert rows(store.read()) == before == rows(survivors(spark, k, buckets=2))
    assert rows(MessageStore(spark, f"file://{tmp_path}/store", 4).read()) == before  # opened again
    assert "Exchange" not in store.read()._jdf.queryExecution().executedPlan().toString()


def test_batches_are_runs_that_compaction_merges(spark, tmp_path):
    _, k = keyed(spark, DATA)
    store = MessageStore(spark, f"file://{tmp_path}/store", 2)
    store.upsert_batches(k.unionByName(k.limit(0)), runs=3)
    apart, kept = store.runs(), rows(store.read())
    files = spark.read.parquet(f"{tmp_path}/store/0")
    assert files.count() > len(kept)  # copies in different batches are kept apart until they are merged
    store.compact()
    assert store.runs() <= 2 < apart and rows(store.read()) == kept == rows(survivors(spark, k, buckets=1))


def test_rows_without_identifier_stay(spark):
    df, k = keyed(spark, DATA)
    kept = survivors(spark, k, buckets=4)
    once = deduplicate(df, message_key([F.col("violation_id")], [F.col("check_id")]), kept)
    assert rows(once, "delivery_id") == [(1,), (10,), (2,), (3,), (4,), (6,)]


def test_empty(spark):
    _, k = keyed(spark, [])
    assert surplus(k, survivors(spark, k, buckets=4)).count() == 0
