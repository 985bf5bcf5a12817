import pytest
from pyspark.sql import functions as F

from conftest import at, values
from syncloom.operators import changes as ch, joins
from syncloom.operators.upserts import advance_watermark, upsert
from syncloom.sources.scans import forced_scan, interval_bounds, interval_scan, scan_by_source

PRINT = "company string, asset_id string, hash string"
ACTIVE = "company string, branch string, id bigint"


def prints(spark, **hashes):
    return spark.createDataFrame([("01", a, h) for a, h in hashes.items()], PRINT)


def test_interval_takes_both_ends(spark):
    frame = spark.createDataFrame([(i, at(f"2024-01-0{i}")) for i in range(1, 6)], "i int, t timestamp_ntz")
    found = interval_scan(frame, "t", at("2024-01-02"), at("2024-01-04"))
    assert values(found, "i") == [(2,), (3,), (4,)]


def test_diff_finds_new_and_changed(spark):
    current = prints(spark, a="1", b="2", c="3")
    state = prints(spark, a="1", b="x", d="4")
    keys = ["company", "asset_id"]
    assert values(ch.snapshot_diff(current, state, keys)) == [("01", "b", "UPD"), ("01", "c", "NEW")]
    full = ch.snapshot_diff(current, state, keys, include_deletes=True)
    assert values(full) == [("01", "b", "UPD"), ("01", "c", "NEW"), ("01", "d", "DEL")]


def test_diff_with_itself_is_empty(spark):
    current = prints(spark, a="1", b="2")
    assert ch.snapshot_diff(current, current, ["company", "asset_id"]).isEmpty()


def test_same_branch_in_another_company_is_not_active(spark):
    active = spark.createDataFrame([("01", "0001", 5)], ACTIVE)
    rows = spark.createDataFrame([("01", "0001"), ("02", "0001"), ("01", "0002")], "company string, branch string")
    assert values(joins.in_active_branches(rows, active)) == [("01", "0001")]
    assert values(joins.in_active_branches(rows, active, company=None)) == [("01", "0001"), ("02", "0001")]
    assert values(joins.with_branch_id(rows, active)) == [("01", "0001", 5)]


def test_waiting_assets_join_the_changes_once(spark):
    changes = spark.createDataFrame([("01", "a", "NEW")], "company string, asset_id string, change_type string")
    queue = spark.createDataFrame(
        [("01", "a", None), ("01", "b", None), ("01", "b", None), ("01", "c", at("2024-01-01"))],
        "company string, asset_id string, sent_at timestamp_ntz",
    )
    assert values(ch.replay_into_changes(changes, queue)) == [("01", "a", "NEW"), ("01", "b", "UPD")]


def test_upsert_is_idempotent(spark):
    state, changes = prints(spark, a="1", b="2"), prints(spark, b="x", c="3")
    keys = ["company", "asset_id"]
    once = upsert(state, changes, keys)
    assert values(once) == [("01", "a", "1"), ("01", "b", "x"), ("01", "c", "3")]
    assert values(upsert(once, changes, keys)) == values(once)


CONTROL = "source string, start_ts timestamp_ntz, prev_start_ts timestamp_ntz, end_ts timestamp_ntz"


def test_intervals_follow_the_worked_example(spark):
    """Runs at 10:00, 10:15 and 10:30: each starts where the one before it started."""
    control = spark.createDataFrame([("s", None, None, None)], CONTROL)
    starts = []
    for minute in ("10:00", "10:15", "10:30"):
        now = F.lit(at(f"2024-01-01 {minute}:00")).cast("timestamp_ntz")
        row = interval_bounds(control, now).first()
        starts.append((row["start"].strftime("%H:%M"), row["end"].strftime("%H:%M")))
        control = advance_watermark(control, now)
    assert starts == [("10:00", "10:00"), ("10:00", "10:15"), ("10:15", "10:30")]


def test_start_after_end_fails(spark):
    later = at("2024-01-02")
    control = spark.createDataFrame([("s", later, later, later)], CONTROL)
    with pytest.raises(Exception, match="starts after it ends"):
        interval_bounds(control, F.lit(at("2024-01-01")).cast("timestamp_ntz")).collect()


def test_each_source_has_its_own_interval(spark):
    events = spark.createDataFrame(
        [(s, at(f"2024-01-0{d}")) for s in "ab" for d in range(1, 7)], "source string, synced_at timestamp_ntz"
    )
    bounds = spark.createDataFrame(
        [("a", at("2024-01-01"), at("2024-01-02")), ("b", at("2024-01-05"), at("2024-01-06")),
         ("c", at("2024-01-03"), at("2024-01-03"))],
        "source string, start timestamp_ntz, end timestamp_ntz",
    )
    found = values(scan_by_source(events, bounds))
    assert [(s, t.day) for s, t in found] == [("a", 1), ("a", 2), ("b", 5), ("b", 6)]


def test_watermark_at_the_data_and_without_data(spark):
    now = at("2024-02-01")
    control = spark.createDataFrame([("a", None, None, None), ("b", None, None, None)], CONTROL)
    events = spark.createDataFrame([("a", at("2024-01-05"))], "source string, synced_at timestamp_ntz")
    after = advance_watermark(control, F.lit(now).cast("timestamp_ntz"), events)
    assert values(after, "source", "end_ts") == [("a", at("2024-01-05")), ("b", now)]


def test_forced_scan_skips_what_is_selected_and_inactive_branches(spark):
    schema = "company string, asset_id string, home_branch string, current_branch string"
    assets = spark.createDataFrame(
        [("01", "home", "0007", "0001"), ("01", "here", "0001", "0007"), ("01", "both", "0007", "0007"),
         ("01", "done", "0007", "0007"), ("01", "else", "0001", "0001"), ("02", "other", "0007", "0007"),
         ("01", "none", None, "0007")],
        schema,
    )
    active = spark.createDataFrame([("01", "0007", 1), ("01", "0001", 2)], ACTIVE)
    already = assets.where("asset_id = 'done'")
    found = forced_scan(assets, active, 7, already, ["company", "asset_id"])
    assert values(found, "asset_id") == [("both",), ("here",), ("home",), ("none",)]
    assert forced_scan(assets, active, 9, already, ["company", "asset_id"]).isEmpty()


def test_lookup_defaults_and_flags(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1, 10), (2, None)], "k int, v int")
    found = joins.lookup(left, right, ["k"], {"v": F.lit(0)}, found="known")
    assert values(found, "k", "v", "known") == [(1, 10, True), (2, 0, True), (3, 0, False)]


def test_matching_never_multiplies(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert values(joins.keep_matching(left, right, ["k"])) == [(1,), (1,)]
    assert values(joins.exclude(left, right, ["k"])) == [(2,), (None,)]


def test_changes_of_active_branches_need_no_second_look_at_the_assets(spark):
    rows = [("01", "a", "h1", "0001"), ("01", "b", "h2", "0002"), ("01", "c", "h3", "0009"), ("01", "d", "h4", None)]
    current = spark.createDataFrame(rows, "company string, asset_id string, hash string, current_branch string")
    state = spark.createDataFrame([("01", "a", "h0"), ("01", "b", "h2"), ("01", "x", "h9")], "company string, asset_id string, hash string")
    active = spark.createDataFrame([("01", "0001"), ("01", "0002")], "company string, branch string")
    found = ch.active_changes(current, state, active)
    expected = ch.active_change_feed(ch.snapshot_diff(current, state, ["company", "asset_id"]), current, active)
    assert values(found) == values(expected) == [("01", "a", "UPD")]
