import pytest
from pyspark.sql import functions as F

from conftest import at, frame, values
from syncloom.plans.inputs import load_inputs
from syncloom.plans.rebuild import expire_events, rebuild
from syncloom.plans.sync import Inputs, Options, SyncRun, run_sync
from syncloom.schemas import SOURCE_COLUMNS
from syncloom.sinks.feeds import write_feed
from syncloom.sources.feeds import MissingFeed
from syncloom.sources.scans import by_day
from syncloom.state.store import StateStore


def ddl(name):
    return ", ".join(SOURCE_COLUMNS[name].values())


ASSETS = [
    ("01", "a1", at("2024-01-05"), 9, 5, "b1", "b1", "A", "A", " s1"),
    ("01", "a2", at("2024-01-06"), 9, 7, "b1", "b2", "A", "A", "s2"),
    ("01", "a3", at("2024-01-07"), 9, 5, "b1", "b9", "A", "A", "s3"),
]
EVENTS = [
    (1, at("2024-01-05"), "EV", "01", "b1", 9, 6, 2),
    (2, at("2024-01-06"), "EV", "01", "b1", 9, 6, 5),
    (3, at("2024-01-06"), "EV", "01", "b2", 9, 6, 4),
    (4, at("2024-01-07"), "EV", "01", "b1", 9, 6, 3),
]
MASTER = [("01", 9, 5, "drill", "N", "D"), ("01", 9, 7, "saw", "N", "S"), ("01", 9, 6, "cone", "Y", "C ")]
SKU_FEED = "sku_id bigint, location_id bigint, upc string, product_id string"
FIRST_SKUS = [(70, 1, "009", "0005"), (71, 1, "009", "0006")]


class Case:
    """A store and the inputs of the runs on it."""

    def __init__(self, spark, tmp_path):
        self.spark = spark
        self.store = StateStore(spark, f"{tmp_path}/state")
        self.out = f"{tmp_path}/feeds"
        control = "source string, start_ts timestamp_ntz, prev_start_ts timestamp_ntz, end_ts timestamp_ntz"
        seed = self.store.begin("seed")
        start = at("2024-01-01")
        seed.overwrite("control", frame(spark, [(s, start, start, start) for s in ("assets", "qty_events")], control))
        seed.publish()

    def inputs(self, assets=ASSETS, events=EVENTS, skus=FIRST_SKUS, items=()):
        spark = self.spark
        active = spark.createDataFrame([("01", "b1", 1), ("01", "b2", 2)], "company string, branch string, id bigint")
        remote = spark.createDataFrame(skus, SKU_FEED)
        return Inputs(
            assets=frame(spark, assets, ddl("assets")),
            qty_events=frame(spark, events, ddl("qty_events")),
            qty_snapshot=frame(spark, [("01", "b1", 9, 6, 3), ("01", "b2", 9, 6, 4)], ddl("qty_snapshot")),
            sku_master=frame(spark, MASTER, ddl("sku_master")),
            active=active,
            remote_skus_before=remote,
            remote_skus_after=remote,
            remote_items=spark.createDataFrame(list(items), "location_id bigint, sku_id bigint, asset_id string"),
        )

    def run(self, run_id, when, inputs, **options):
        result = run_sync(self.spark, inputs, self.store, at(when), run_id, self.out, Options(**options))
        feeds = {
            "skus": ["HQLocationID", "SKUListType"],
            "units": ["HQSKUID", "TagID"],
            "assets": ["HQSKUID", "TagID", "SerialNumber"],
        }
        return {name: values(result.feeds[name], *columns) for name, columns in feeds.items()}

    def waiting(self, queue, *columns):
        return values(self.store.read(queue).where("sent_at is null"), *columns)


@pytest.fixture
def case(spark, tmp_path):
    return Case(spark, tmp_path)


def test_runs_one_after_the_other(case):
    first = case.run("r1", "2024-02-01", case.inputs(items=[(1, 71, "C_00b1_3")]))
    assert first["skus"] == [(1, "009-0005"), (1, "009-0006"), (2, "009-0006"), (2, "009-0007")]
    # b1 rose by 2 and by 3; b2 has no remote id yet.
    assert first["units"] == [(71, f"C_00b1_{n}") for n in range(4, 9)]
    assert first["assets"] == [(70, "a1", "s1")]
    assert case.waiting("bulk_queue", "branch", "qty") == [("b2", 4)]
    assert case.waiting("asset_queue", "asset_id", "category", "class_code") == [("a2", "009", "0007")]

    # Nothing changed: the overlapping interval sends no asset and no unit again.
    second = case.run("r2", "2024-02-02", case.inputs())
    assert second["assets"] == [] and second["units"] == []
    assert case.waiting("bulk_queue", "branch", "qty") == [("b2", 4)]

    # The remote ids arrive, and what waited goes out.
    more = FIRST_SKUS + [(80, 2, "009", "0006"), (81, 2, "009", "0007")]
    third = case.run("r3", "2024-02-03", case.inputs(skus=more))
    assert third["units"] == [(80, f"C_00b2_{n}") for n in range(1, 5)]
    assert third["assets"] == [(81, "a2", "s2")]
    assert case.waiting("bulk_queue") == [] and case.waiting("asset_queue") == []

    # A changed asset and a new event; an asset that only has a new sync time stays.
    changed = [ASSETS[0][:2] + (at("2024-02-03 12:00"),) + ASSETS[0][3:9] + ("s9",)]
    touched = [ASSETS[1][:2] + (at("2024-02-03 12:00"),) + ASSETS[1][3:]]
    event = (5, at("2024-02-03 13:00"), "EV", "01", "b1", 9, 6, 4)
    fourth = case.run(
        "r4", "2024-02-04", case.inputs(assets=changed + touched + ASSETS[2:], events=EVENTS + [event], skus=more)
    )
    assert fourth["assets"] == [(70, "a1", "s9")]
    assert fourth["units"] == [(71, "C_00b1_1")]


def test_a_run_is_done_once(case):
    case.run("r1", "2024-02-01", case.inputs())
    again = run_sync(case.spark, case.inputs(), case.store, at("2024-02-01"), "r1", case.out)
    assert again.skipped and again.feeds == {}


def test_watermark_and_state_after_a_run(case):
    case.run("r1", "2024-02-01", case.inputs())
    now = at("2024-02-01")
    assert values(case.store.read("control")) == [("assets", now, now, now), ("qty_events", now, now, now)]
    assert values(case.store.read("asset_state"), "asset_id") == [("a1",)]
    assert values(case.store.read("prior_attributes")) == [("01", "a1", "s1")]
    assert values(case.store.read("qty_event_state"), "seq", "qty", "prev_qty") == [(1, 2, 2), (2, 5, 5), (3, 4, 4)]


def test_prior_serial_number_is_that_of_the_run_before(case):
    case.run("r1", "2024-02-01", case.inputs())
    changed = [ASSETS[0][:2] + (at("2024-02-01"),) + ASSETS[0][3:9] + ("s9",)]
    result = run_sync(case.spark, case.inputs(assets=changed), case.store, at("2024-02-02"), "r2", case.out)
    assert values(result.feeds["assets"], "TagID", "SerialNumber", "PrevSerial") == [("a1", "s9", "s1")]


def test_copies_of_a_source_row_count_once_and_the_latest_wins(case):
    older = [ASSETS[0][:2] + (at("2024-01-02"),) + ASSETS[0][3:9] + ("s0",)]
    sent = case.run("r1", "2024-02-01", case.inputs(assets=ASSETS[:1] * 3 + older, events=EVENTS[:1] * 3))
    assert sent["assets"] == [(70, "a1", "s1")]
    assert sent["units"] == [(71, "C_00b1_1"), (71, "C_00b1_2")]


def test_rebuild_then_run_sends_nothing_that_was_known(case):
    inputs = case.inputs()
    now = F.lit(at("2024-01-20")).cast("timestamp_ntz")
    rebuild(case.store, "rebuild", now, inputs.assets, inputs.active, inputs.qty_events, inputs.qty_snapshot)
    assert values(case.store.read("prior_attributes"), "asset_id") == [("a1",), ("a2",), ("a3",)]
    assert values(case.store.read("qty_event_state"), "seq", "prev_qty") == [(1, 3), (2, 2), (3, 4), (4, 5)]
    sent = case.run("r1", "2024-02-01", inputs)
    assert sent["assets"] == [] and sent["units"] == []


def test_forced_branch_loads_old_rows(case):
    """Rows outside the interval are sent when their branch is forced and the state lacks them."""
    start = at("2024-01-31")
    control = case.store.read("control").select(
        "source", *[F.lit(start).cast("timestamp_ntz").alias(c) for c in ("start_ts", "prev_start_ts", "end_ts")]
    )
    late = case.store.begin("late")
    late.overwrite("control", control)
    late.publish()
    assert case.run("r1", "2024-02-01", case.inputs())["assets"] == []
    inactive = [ASSETS[0][:5] + ("0001", "0001") + ASSETS[0][7:]]
    inputs = case.inputs(assets=inactive, skus=FIRST_SKUS + [(90, 5, "009", "0005")])
    inputs.active = case.spark.createDataFrame([("01", "0001", 5)], "company string, branch string, id bigint")
    assert case.run("r2", "2024-02-02", inputs, force_branch=1)["assets"] == [(90, "a1", "s1")]


def test_only_missing_skus_and_only_changed_sites(case):
    inputs = case.inputs()
    site = (1, "01", 11, "J", "A", "b1", 20240101, "yard", "c", "n", "l1", "l2", "x", "ST", "1", 212, 5551234, "t", 1, 7, "P")
    inputs.customer_sites = frame(case.spark, [site], ddl("customer_sites"))
    inputs.remote_sites = case.spark.createDataFrame(
        [(1, 100, "01", "11", "J", "yard", "PCb1")],
        "site_id bigint, location_id bigint, company string, account string, job string, job_location string, branch_name string",
    )
    options = {"only_missing_skus": True, "only_changed_sites": True}
    sent = case.run("r1", "2024-02-01", inputs, **options)
    assert sent["skus"] == [(2, "009-0006"), (2, "009-0007")]
    result = run_sync(case.spark, inputs, case.store, at("2024-02-02"), "r2", case.out, Options(**options))
    assert result.feeds["customer_sites"].isEmpty()
    always = run_sync(case.spark, inputs, case.store, at("2024-02-03"), "r3", case.out)
    assert values(always.feeds["customer_sites"], "CJID", "HQLocationID") == [(1, 100)]


def test_inputs_from_source_tables_and_landed_feeds(case, spark, tmp_path):
    def names(table):
        return list(SOURCE_COLUMNS[table])

    ours = case.inputs()
    sources = {}
    for name in ("assets", "qty_events", "qty_snapshot", "sku_master"):
        sources[name] = getattr(ours, name).toDF(*names(name))
    landing = f"{tmp_path}/landing"
    sku_ddl = "ID bigint, HQLocationID bigint, UPC string, ProductID string"
    skus = spark.createDataFrame(FIRST_SKUS, sku_ddl)
    write_feed(spark.createDataFrame([(1, "b1 "), (2, "b2")], "ID bigint, PC string"), landing, "branches", "s1")
    write_feed(skus, landing, "skus", "s1")
    items = spark.createDataFrame([(1, 71, "C_00b1_3")], "HQLocationID bigint, HQSKUID bigint, AssetID string")
    write_feed(items, landing, "items", "s1")
    with pytest.raises(MissingFeed):
        load_inputs(spark, sources, landing, "s1")
    write_feed(skus, landing, "skus_refreshed", "s1")
    sent = case.run("r1", "2024-02-01", load_inputs(spark, sources, landing, "s1"))
    assert sent["assets"] == [(70, "a1", "s1")]
    assert sent["units"] == [(71, f"C_00b1_{n}") for n in range(4, 9)]


def test_nested_sku_feed_and_first_only_fallback(case):
    result = run_sync(
        case.spark, case.inputs(), case.store, at("2024-02-01"), "r1", case.out,
        Options(nest_skus=True, fill_first_only=True),
    )
    rows = result.feeds["skus"].selectExpr("HQLocationID", "UPC", "inline(items)")
    assert values(rows, "HQLocationID", "SKUListType") == [
        (1, "009-0005"), (1, "009-0006"), (2, "009-0006"), (2, "009-0007")
    ]
    assert result.feeds["skus"].count() == 2


def test_nested_asset_feed(case):
    result = run_sync(
        case.spark, case.inputs(), case.store, at("2024-02-01"), "r1", case.out, Options(nest_assets=True)
    )
    rows = result.feeds["assets"].selectExpr("HQLocationID", "HQSKUID", "AssetGroup", "inline(items)")
    assert values(rows, "HQLocationID", "HQSKUID", "AssetGroup", "TagID") == [(1, 70, "", "a1")]


def test_late_and_new_events_take_the_right_quantity_before(case):
    """The second run reads its interval; an event that comes before known ones looks into the log."""
    skus = FIRST_SKUS + [(80, 2, "009", "0006")]
    case.run("r1", "2024-02-01", case.inputs(skus=skus))
    assert values(case.store.read("last_qty"), "branch", "seq", "qty") == [("b1", 4, 3), ("b2", 3, 4)]
    late = (2, at("2024-02-01 12:00"), "EV", "01", "b2", 9, 6, 1)
    event = (5, at("2024-02-01 13:00"), "EV", "01", "b1", 9, 6, 7)
    second = case.run("r2", "2024-02-02", case.inputs(events=EVENTS + [late, event], skus=skus))
    # 3 to 7 at b1; nothing to 1 at b2, whose snapshot says 4: no rise.
    assert second["units"] == [(71, f"C_00b1_{n}") for n in range(1, 5)]
    assert values(case.store.read("last_qty"), "branch", "seq", "qty") == [("b1", 5, 7), ("b2", 3, 4)]


def test_a_run_scans_the_interval_of_the_log_alone(case, tmp_path):
    case.run("r1", "2024-02-01", case.inputs())
    inputs = case.inputs()
    inputs.qty_events.write.parquet(f"{tmp_path}/log")
    inputs.qty_events = case.spark.read.parquet(f"{tmp_path}/log")
    run = SyncRun(case.spark, inputs, case.store, at("2024-02-02"), "r2", case.out)
    run.commit = case.store.begin("r2")
    _, bounds = run.intervals()
    run.work.stage, staged = recorder(run.work.stage)
    run.quantity_changes(*bounds["qty_events"])
    plans = [p for p in staged if "/log" in p]
    assert plans and all("GreaterThanOrEqual(synced_at" in p for p in plans)


def recorder(stage):
    plans = []

    def recorded(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, name)

    return recorded, plans


def test_moved_assets_are_sent_or_wait_over_three_runs(case):
    """a2 waits at b2 and moves to b1, where its SKU is known; then to b2 again."""
    case.run("r1", "2024-02-01", case.inputs())
    assert case.waiting("asset_queue", "asset_id", "branch") == [("a2", "b2")]
    moved = [ASSETS[1][:2] + (at("2024-02-01 12:00"),) + ASSETS[1][3:6] + ("b1",) + ASSETS[1][7:]]
    skus = FIRST_SKUS + [(82, 1, "009", "0007")]
    second = case.run("r2", "2024-02-02", case.inputs(assets=ASSETS[:1] + moved, skus=skus))
    assert second["assets"] == [(82, "a2", "s2")]
    assert case.waiting("asset_queue") == []
    back = [ASSETS[1][:2] + (at("2024-02-02 12:00"),) + ASSETS[1][3:]]
    third = case.run("r3", "2024-02-03", case.inputs(assets=ASSETS[:1] + back, skus=skus))
    assert third["assets"] == []
    assert case.waiting("asset_queue", "asset_id", "branch") == [("a2", "b2")]


def test_an_asset_that_moves_to_an_unknown_sku_goes_on_waiting(case):
    """The SKU of where it waited arrives, but the asset is elsewhere by then."""
    case.run("r1", "2024-02-01", case.inputs())
    moved = [ASSETS[1][:2] + (at("2024-02-01 12:00"),) + ASSETS[1][3:6] + ("b1",) + ASSETS[1][7:]]
    there = FIRST_SKUS + [(81, 2, "009", "0007")]
    second = case.run("r2", "2024-02-02", case.inputs(assets=ASSETS[:1] + moved, skus=there))
    assert second["assets"] == []
    assert case.waiting("asset_queue", "asset_id", "branch") == [("a2", "b1")]
    assert values(case.store.read("asset_state"), "asset_id") == [("a1",)]
    both = there + [(82, 1, "009", "0007")]
    third = case.run("r3", "2024-02-03", case.inputs(assets=ASSETS[:1] + moved, skus=both))
    assert third["assets"] == [(82, "a2", "s2")]
    assert case.waiting("asset_queue") == []


def test_a_quantity_on_top_of_one_that_waits_is_not_lost(case):
    case.run("r1", "2024-02-01", case.inputs(), dedupe_queue=True)
    assert case.waiting("bulk_queue", "branch", "qty") == [("b2", 4)]
    more = (5, at("2024-02-01 12:00"), "EV", "01", "b2", 9, 6, 6)
    case.run("r2", "2024-02-02", case.inputs(events=EVENTS + [more]), dedupe_queue=True)
    assert case.waiting("bulk_queue", "branch", "qty") == [("b2", 6)]
    skus = FIRST_SKUS + [(80, 2, "009", "0006")]
    third = case.run("r3", "2024-02-03", case.inputs(events=EVENTS + [more], skus=skus), dedupe_queue=True)
    assert third["units"] == [(80, f"C_00b2_{n}") for n in range(1, 7)]


def test_old_events_expire(case):
    case.run("r1", "2024-02-01", case.inputs())
    before = F.lit(at("2024-01-06")).cast("timestamp_ntz")
    expire_events(case.store, "tidy", before)
    assert values(case.store.read("qty_event_state"), "seq") == [(2,), (3,)]
    again = case.run("r2", "2024-02-02", case.inputs(), event_days=10)
    assert again["units"] == []


@pytest.mark.parametrize("snapshot", [True, False])
def test_a_fall_at_the_time_of_a_run_sends_nothing_later(case, snapshot):
    """A SKU at 10 falls to 3 at the very time of the second run; the third one reads that again."""
    first = [(1, at("2024-01-05"), "EV", "01", "b1", 9, 6, 10)]
    fall = (2, at("2024-02-02"), "EV", "01", "b1", 9, 6, 3)
    later = (3, at("2024-02-02 12:00"), "EV", "01", "b1", 9, 6, 5)

    def inputs(events):
        found = case.inputs(events=events)
        if not snapshot:
            found.qty_snapshot = found.qty_snapshot.where("false")
        return found

    assert len(case.run("r1", "2024-02-01", inputs(first))["units"]) == 10
    assert case.run("r2", "2024-02-02", inputs([*first, fall]))["units"] == []
    assert values(case.store.read("taken_events"), "seq") == [(2,)]
    assert case.run("r3", "2024-02-03", inputs([*first, fall]))["units"] == []
    # The same interval once more, as an operator may ask for, and then a rise.
    again = case.store.begin("again")
    start = F.lit(at("2024-01-01")).cast("timestamp_ntz")
    again.overwrite("control", case.store.read("control").select("source", *[start.alias(c) for c in ("start_ts", "prev_start_ts", "end_ts")]))
    again.publish()
    assert case.run("r4", "2024-02-04", inputs([*first, fall]))["units"] == []
    assert len(case.run("r5", "2024-02-05", inputs([*first, fall, (*later[:1], at("2024-02-04 12:00"), *later[2:])]))["units"]) == 2


def test_events_that_join_the_end_of_an_interval_later_are_taken(case):
    first = [(1, at("2024-01-05"), "EV", "01", "b1", 9, 6, 2)]
    edge = [(2, at("2024-02-01"), "EV", "01", "b1", 9, 6, 5), (3, at("2024-02-01"), "EV", "01", "b1", 9, 6, 9)]
    assert len(case.run("r1", "2024-02-01", case.inputs(events=first + edge[:1]))["units"]) == 5
    assert len(case.run("r2", "2024-02-02", case.inputs(events=first + edge))["units"]) == 4


def test_falls_count_with_net(case):
    sent = case.run("r1", "2024-02-01", case.inputs(), net=True)
    # b1 went to 2, to 5 and back to 3.
    assert len(sent["units"]) == 3


def test_ends_of_the_data(case):
    run_sync(case.spark, case.inputs(), case.store, at("2024-02-01"), "r1", case.out, Options(end_at_data=True))
    assert values(case.store.read("control"), "source", "end_ts") == [
        ("assets", at("2024-01-07")), ("qty_events", at("2024-01-07"))
    ]
    # Nothing new: the end is the run's own time.
    run_sync(case.spark, case.inputs(), case.store, at("2024-02-02"), "r2", case.out, Options(end_at_data=True))
    assert values(case.store.read("control"), "source", "end_ts") == [
        ("assets", at("2024-02-02")), ("qty_events", at("2024-02-02"))
    ]


def test_a_log_partitioned_by_day_is_read_by_the_days_of_the_interval(case, tmp_path):
    case.run("r1", "2024-02-01", case.inputs())
    event = (5, at("2024-02-01 13:00"), "EV", "01", "b1", 9, 6, 7)
    inputs = case.inputs(events=[*EVENTS, event])
    by_day(inputs.qty_events, "synced_at").write.partitionBy("sync_day").parquet(f"{tmp_path}/log")
    inputs.qty_events = case.spark.read.parquet(f"{tmp_path}/log")
    run = SyncRun(case.spark, inputs, case.store, at("2024-02-02"), "r2", case.out)
    run.commit = case.store.begin("r2")
    _, bounds = run.intervals()
    run.work.stage, staged = recorder(run.work.stage)
    found = run.quantity_changes(*bounds["qty_events"])
    assert values(found, "seq", "qty_to_send") == [(5, 4)]
    plans = [p for p in staged if "/log" in p]
    assert plans and all("PartitionFilters: [isnotnull(sync_day" in p for p in plans)
