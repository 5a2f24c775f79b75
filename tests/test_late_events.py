"""Late events: cut-offs, copies, times that cannot be read, increments."""

from datetime import datetime, timedelta, timezone

from conftest import rows
from millrace.operators.late_events import PeriodLedger, changed_periods, periods

SCHEMA = (
    "delivery_id bigint, event_id string, aggregate_id string, sequence_number bigint, payload struct<doc_id:string,status:string,bytes:bigint>, "
    "occurred_at string, recorded_at string, status string, n bigint"
)
A, B, C = ("00000000-0000-4000-8000-00000000000" + x for x in "abc")


def event(i, event_id, occurred, recorded, aggregate="g", sequence=1, status="s"):
    return (i, event_id, aggregate, sequence, ("d", status, 1), occurred, recorded, "clashing name", 7)


def log(spark, *events):
    return spark.createDataFrame(list(events), SCHEMA)


def found(spark, *events):
    return rows(periods(spark, log(spark, *events)), "aggregate_id", "first_events", "events", "refused_events", "status")


def test_cut_offs(spark):
    day = "2017-01-02T10:00:00Z"
    assert found(spark, event(1, A, day, "2017-01-03T00:59:59Z")) == [("g", 1, 1, 0, "s")]
    assert found(spark, event(1, A, day, "2017-01-03T01:00:00Z")) == [("g", 0, 1, 0, "s")]
    assert found(spark, event(1, A, day, "2017-01-05T23:59:59Z")) == [("g", 0, 1, 0, "s")]
    assert found(spark, event(1, A, day, "2017-01-06T00:00:00Z")) == [("g", 0, 0, 1, None)]
    assert found(spark, event(1, A, day, "2017-01-01T00:00:00Z")) == [("g", 1, 1, 0, "s")]  # clock skew


def test_copies_are_one_event_at_their_earliest_readable_times(spark):
    got = found(
        spark,
        event(1, A, "n/a", "2017-01-04T00:00:00Z"),
        event(2, "{" + A.upper() + "}", "2017-01-02 10:00:00", "2017-01-02T11:00:00+01:00"),
        event(3, "urn:uuid:" + A, "1483351200000", "unknown"),
        event(4, A.replace("-", "") + " ", None, "20170105T000000Z"),
    )
    assert got == [("g", 1, 1, 0, "s")]


def test_left_out(spark):
    day = "2017-01-02T10:00:00Z"
    assert found(spark, event(1, None, day, day), event(2, " ", day, day), event(3, B, "0000-00-00T00:00:00Z", day), event(4, C, day, "")) == []
    assert found(spark) == []


def test_status_is_of_the_highest_sequence_and_nulls_rank_lowest(spark):
    day = "2017-01-02T10:00:00Z"
    assert found(spark, event(1, A, day, day, sequence=None, status="z"), event(2, B, day, day, sequence=2, status="b"), event(3, C, day, day, sequence=2, status="a")) == [("g", 3, 3, 0, "b")]


def test_increments_equal_the_whole_in_any_order(spark, tmp_path):
    base = datetime(2017, 1, 2, tzinfo=timezone.utc)
    events = [
        event(i, f"{i % 23:08x}-0000-4000-8000-000000000000", (base + timedelta(hours=i * 5 % 60)).isoformat(), (base + timedelta(hours=(i * 37) % 150)).isoformat(), f"g{i % 3}", i % 7, f"s{i % 4}")
        for i in range(60)
    ]
    whole = periods(spark, log(spark, *events))
    ledger = PeriodLedger(spark, f"file://{tmp_path}/ledger")
    for part in (events[40:], events[:25], events[25:40], events[:25]):  # a batch comes twice
        assert ledger.absorb(log(spark, *part)) == 0
    assert rows(ledger.read()) == rows(whole)
    ledger.close(int((base + timedelta(days=4, hours=1)).timestamp() * 1e6))
    assert rows(ledger.read()) == rows(whole) and ledger.closed_before_day == 17169
    ledger = PeriodLedger(spark, f"file://{tmp_path}/ledger")  # opened again
    assert rows(ledger.read()) == rows(whole)
    ledger.close(int((base + timedelta(days=60)).timestamp() * 1e6))
    assert rows(ledger.read()) == rows(whole)
    assert ledger.absorb(log(spark, event(99, A, base.isoformat(), base.isoformat()))) == 1  # closed
    assert rows(ledger.read()) == rows(whole)
    assert rows(changed_periods(whole)) == [r for r in rows(whole) if r[2] != r[3]]


def test_what_cannot_be_dated_does_not_stay_open_for_ever(spark, tmp_path):
    ledger = PeriodLedger(spark, f"file://{tmp_path}/ledger")
    old, late = "2017-01-02T10:00:00Z", "2017-01-09T10:00:00Z"
    ledger.absorb(log(spark, event(1, A, "n/a", old), event(2, B, None, None), event(3, C, "n/a", late), event(4, "x", old, old)))
    ledger.close(int(datetime(2017, 1, 9, 12, tzinfo=timezone.utc).timestamp() * 1e6))
    assert spark.read.parquet(f"{tmp_path}/ledger/open/{ledger.generation}").count() == 1  # what came after the closed days
    ledger.absorb(log(spark, event(5, C, late, late)))
    assert rows(ledger.read().select("period_day", "events").where("events > 0")) == [(datetime(2017, 1, 2).date(), 1), (datetime(2017, 1, 9).date(), 1)]
