from pyspark.sql import functions as F

from conftest import at, frame, values
from syncloom.operators import quantity as qt
from syncloom.schemas import EVENT_KEYS

KEY = "company string, branch string, category decimal(3,0), class_code decimal(4,0)"
EVENT = f"{KEY}, event string, seq bigint, synced_at timestamp_ntz, qty decimal(6,0)"
DAY = at("2024-01-01")


def log(spark, *rows):
    """Events of (branch, seq, qty)."""
    return frame(spark, [("01", b, 1, 5, "EV", s, DAY, q) for b, s, q in rows], EVENT)


def test_quantity_before(spark):
    events = log(spark, ("b", 1, 5), ("b", 2, 3), ("b", 3, 3), ("b", 4, None), ("b", 5, 9), ("c", 1, 2))
    found = values(qt.quantity_delta(events), "branch", "seq", "prev_qty")
    assert found == [("b", 1, 0), ("b", 2, 5), ("b", 3, 3), ("b", 4, 3), ("b", 5, None), ("c", 1, 0)]


def test_fallback_replaces_zero_only_where_the_snapshot_has_the_key(spark):
    deltas = log(spark, ("b", 1, 5), ("b", 2, 3), ("c", 1, 2)).withColumn(
        "prev_qty", F.when(F.col("seq") == 2, 5).otherwise(0).cast("decimal(6,0)")
    )
    snapshot = frame(spark, [("01", "b", 1, 5, 7)], f"{KEY}, qty decimal(6,0)")
    filled = qt.fill_from_snapshot(deltas, snapshot)
    assert values(filled, "branch", "seq", "prev_qty") == [("b", 1, 7), ("b", 2, 5), ("c", 1, 0)]


def test_a_true_zero_stays_when_only_first_events_are_filled(spark):
    events = log(spark, ("b", 1, 0), ("b", 2, 3))
    snapshot = frame(spark, [("01", "b", 1, 5, 7)], f"{KEY}, qty decimal(6,0)")
    deltas = qt.quantity_delta(events, first="is_first")
    assert values(qt.fill_from_snapshot(deltas, snapshot, first="is_first"), "seq", "prev_qty") == [(1, 7), (2, 0)]
    assert values(qt.fill_from_snapshot(deltas, snapshot), "seq", "prev_qty") == [(1, 7), (2, 7)]


def changes(spark, events, state=None, active=("b",)):
    master = frame(
        spark, [("01", 1, 5, "Y"), ("01", 2, 5, "N")],
        "company string, category decimal(3,0), class_code decimal(4,0), bulk string",
    )
    branches = frame(spark, [("01", a) for a in active], "company string, branch string")
    risen = qt.risen_quantities(qt.quantity_delta(events), master, branches)
    return qt.mark_known_events(risen, state if state is not None else events.limit(0))


def test_only_rises_in_active_branches_are_sent(spark):
    events = log(spark, ("b", 1, 5), ("b", 2, 3), ("b", 3, 5), ("c", 1, 4))
    assert values(changes(spark, events), "seq", "qty_to_send", "change_type") == [(1, 5, "NEW"), (3, 2, "NEW")]


def test_other_skus_than_bulk_are_not_sent(spark):
    events = log(spark, ("b", 1, 5)).withColumn("category", F.lit(2).cast("decimal(3,0)"))
    assert changes(spark, events).isEmpty()


def test_known_events_are_updates_under_any_sync_time_and_never_double(spark):
    events = log(spark, ("b", 1, 5))
    twice = events.withColumn("synced_at", F.lit(at("2023-01-01")).cast("timestamp_ntz")).union(events)
    assert values(changes(spark, events, state=twice), "seq", "change_type") == [(1, "UPD")]


def test_sum_of_rises_is_not_the_net_change(spark):
    events = log(spark, ("b", 1, 5), ("b", 2, 3), ("b", 3, 5))
    rises = changes(spark, events).where("seq > 1")
    assert values(qt.rollup_quantities(rises), "branch", "qty", "status") == [("b", 2, "RC")]
    deltas = qt.quantity_delta(events).where("seq > 1")
    assert qt.rollup_quantities(deltas, net=True).isEmpty()


def test_events_sent_before_are_skipped(spark):
    events = log(spark, ("b", 1, 5), ("b", 2, 6))
    state = events.where("seq = 1").select(*EVENT_KEYS)
    assert values(qt.unseen_events(events, state), "seq") == [(2,)]
    assert values(qt.unseen_events(events, state, DAY, DAY), "seq") == [(2,)]
    later = at("2024-06-01")
    assert values(qt.unseen_events(events, state, later, later), "seq") == [(1,), (2,)]


def test_history_of_touched_keys(spark):
    history = log(spark, ("b", 1, 5), ("b", 2, 6), ("c", 1, 1))
    due = log(spark, ("b", 2, 6), ("b", 2, 6))
    keys = ["company", "branch", "category", "class_code"]
    assert values(qt.touched_history(history, due, keys), "branch", "seq") == [("b", 1), ("b", 2)]
