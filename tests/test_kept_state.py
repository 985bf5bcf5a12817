"""Digests by bucket, state in buckets, kept aggregates, rejects, factorised matching, noted slices."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import frame, values
from syncloom.operators import digests, quantity as qt, units
from syncloom.operators.changes import snapshot_diff
from syncloom.operators.matching import expand_sites, factorise_sites, matched_pairs
from syncloom.operators.skew import equal_slices, last_known
from syncloom.operators.upserts import merge_aggregates, upsert
from syncloom.session import Workspace
from syncloom.sources import feeds, scans
from syncloom.state.buckets import BucketedTable

PRINTS = "company string, asset_id string, hash string"
KEYS = ["company", "asset_id"]


def prints(spark, n, changed=(), gone=(), new=()):
    rows = [("01", f"a{i}", f"h{i}" + ("x" if i in changed else "")) for i in range(n) if i not in gone]
    return spark.createDataFrame(rows + [("01", f"n{i}", "h") for i in new], PRINTS)


def test_only_buckets_that_differ_are_read(spark, tmp_path):
    before, after = prints(spark, 300), prints(spark, 300, changed={5}, gone={9}, new={1})
    digests.write_snapshot(before, KEYS, str(tmp_path), buckets=32)
    found = digests.snapshot_diff_buckets(after, str(tmp_path), KEYS, include_deletes=True, buckets=32, group=4)
    expected = snapshot_diff(after, before, KEYS, include_deletes=True)
    assert values(found) == values(expected) and found.count() == 3
    hit = {r[0] for r in digests.with_bucket(prints(spark, 300, new={1}), KEYS, 32).where("asset_id in ('a5', 'a9', 'n1')").select("bucket").collect()}
    state, kept = digests.read_snapshot(before, str(tmp_path))
    numbers = digests.differing_buckets(digests.bucket_digests(digests.with_bucket(after, KEYS, 32), KEYS), kept, 4)
    assert set(numbers) == hit
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    read = state.where(F.col("bucket").isin(numbers)).select(F.input_file_name()).distinct().collect()
    assert {int(f[0].split("bucket=")[1].split("/")[0]) for f in read} <= hit


def test_equal_snapshots_read_nothing(spark, tmp_path):
    digests.write_snapshot(prints(spark, 50), KEYS, str(tmp_path), buckets=8)
    assert digests.snapshot_diff_buckets(prints(spark, 50).repartition(3), str(tmp_path), KEYS, buckets=8, group=2).isEmpty()
    empty = digests.snapshot_diff_buckets(prints(spark, 0), str(tmp_path), KEYS, include_deletes=True, buckets=8, group=2)
    assert empty.where("change_type = 'DEL'").count() == empty.count() == 50


def test_bucketed_state_is_not_shuffled(spark, tmp_path):
    table = BucketedTable(spark, f"{tmp_path}/state", PRINTS, KEYS, buckets=4)
    table.write(prints(spark, 60), 1)
    state, changes = table.read(1), prints(spark, 10, changed={1, 2}, new={7})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("left_anti", "left_semi", "full"):
            plan = state.join(changes, KEYS, how)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1, how
            scan = plan[plan.index("FileScan") :] if "FileScan" in plan else plan
            assert "Bucketed: true" in scan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    after = table.upsert(state, changes, 2)
    assert values(after) == values(upsert(prints(spark, 60), changes, KEYS))
    assert values(table.read(2)) == values(after)
    assert values(table.read(1)) == values(prints(spark, 60))


def test_kept_aggregates_go_on(spark):
    state = spark.createDataFrame([("a", 5, 10), ("b", 1, 1)], "k string, top int, total long")
    part = spark.createDataFrame([("a", 3, 4), ("c", 9, 2)], "k string, top int, total long")
    changed = merge_aggregates(state, part, ["k"], {"top": "max", "total": "sum"})
    assert values(changed) == [("a", 5, 14), ("c", 9, 2)]
    assert changed.schema == state.schema
    with pytest.raises(ValueError):
        merge_aggregates(state, part, ["k"], {"top": "avg"})


def test_tags_after_three_runs(spark):
    items = spark.createDataFrame([(1, f"x_{n}") for n in (3, 9, 4)] + [(2, "y_1"), (2, "none")], "sku_id long, asset_id string")
    state = spark.createDataFrame([], "sku_id long, max_tag int")
    for n in range(3):
        part = items.where(F.pmod(F.hash("asset_id"), F.lit(3)) == n)
        changed = units.max_tags_after(state, part, ["sku_id"])
        state = Workspace(spark).stage(upsert(state, changed, ["sku_id"]), f"s{n}")
    assert values(state) == values(units.max_tag(items, ["sku_id"]))


def test_rejects_are_kept_and_good_rows_go_on(spark, tmp_path):
    folder = feeds.feed_path(str(tmp_path), "branches", "s1")
    os.makedirs(folder)
    with open(f"{folder}/one.json", "w") as file:
        file.write('{"ID":1,"PC":"a"}\n{"ID":"two","PC":"b"}\n{"ID":3\n\n{"ID":4}\n')
    with open(f"{folder}/two.json", "w") as file:
        file.write('{"ID":5,"PC":"e","more":1}\nnonsense\n[1]\n')
    work = Workspace(spark, "feed")
    read = lambda op: feeds.read_with_rejects(spark, str(tmp_path), "ID bigint, PC string", "s1", op, lambda df: work.stage(df, op))
    good, bad = read("branches")
    assert values(good) == [(1, "a"), (4, None), (5, "e")]
    rows = {(r.raw, r.reason, os.path.basename(r.file)) for r in bad.collect()}
    assert rows >= {('{"ID":"two","PC":"b"}', "ID", "one.json"), ('{"ID":3', "malformed", "one.json"), ("nonsense", "malformed", "two.json")}
    good, bad = read("absent")
    assert good.isEmpty() and bad.isEmpty() and bad.columns == ["raw", "file", "reason"]


def test_factorised_pairs_are_the_pairs(spark):
    sites = spark.createDataFrame(
        [(i, "01", i, f"J{i}", f"000{i % 3}", "yard") for i in range(1, 13)],
        "site_id long, company string, account long, job string, branch string, job_location string",
    )
    remote = spark.createDataFrame(
        [(i * 2, 100 + i % 4, "01", str(i), f"J{i}", "yard", f"PC000{i % 4}") for i in range(1, 9)],
        "site_id long, location_id long, company string, account string, job string, job_location string, branch_name string",
    )
    found = factorise_sites(sites, remote)
    assert values(expand_sites(found)) == values(matched_pairs(sites, remote).select("site_id", "location_id"))
    one = sites.where("site_id = 3")
    assert {r.site_id for r in expand_sites(found, one).collect()} == {3}
    assert found.locations.count() < expand_sites(found).count()


def test_slices_have_about_as_many_rows_as_asked_for(spark):
    """However sparse the order numbers are."""
    rows = [(1 if i % 3 else 2, i * i * 1_000_003, i) for i in range(20_000)]
    table = spark.createDataFrame(rows, "k int, seq long, qty int").repartition(6)
    sizes = [r[0] for r in equal_slices(table, ["k"], ["seq"], 20_000, 500).groupBy("_slice").agg(F.count("*")).collect()]
    assert len(sizes) > 30 and max(sizes) < 1500
    found = qt.quantity_delta(table, ["k"], ["seq"], hot_rows=100, span=500)
    plain = qt.quantity_delta(table, ["k"], ["seq"])
    assert values(found) == values(plain)


def test_small_slices_share_tasks(spark):
    """Tasks and files grow with the rows, not with the slices, down to one row each."""
    rows = [(i % 3, i * 1_000_003, i) for i in range(6_000)]
    table = spark.createDataFrame(rows, "k int, seq long, qty int").repartition(6)
    for slice_rows in (16, 1):
        sliced = equal_slices(table, ["k"], ["seq"], 6_000, slice_rows)
        sizes = [r[1] for r in sliced.groupBy("_slice").count().collect()]
        assert max(sizes) == slice_rows and sum(sizes) == 6_000 and len(sizes) == 6_000 // slice_rows
        assert len(sliced.inputFiles()) == 1
        borders = sliced.groupBy("k", "_slice").agg(F.min("seq"), F.max("seq")).orderBy("k", "_slice").collect()
        assert all(a[3] < b[2] for a, b in zip(borders, borders[1:]) if a[0] == b[0])
        found = qt.quantity_delta(table, ["k"], ["seq"], hot_rows=10, span=slice_rows)
        assert values(found) == values(qt.quantity_delta(table, ["k"], ["seq"]))


@pytest.mark.parametrize("hot_rows, span", [(1 << 20, 1 << 20), (20, 30)])
def test_last_known_value(spark, hot_rows, span):
    rows = [(k, i, None if (i * 7 + (k or 0)) % 5 else i) for k in (1, 2, None) for i in range(200 if k == 1 else 10)]
    table = spark.createDataFrame(rows, "k int, t int, v int").repartition(5)
    found = last_known(table, ["k"], ["t"], "v", "before", hot_rows, span)
    expected = []
    for k in (1, 2, None):
        known = None
        for _, t, v in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]):
            expected.append((k, t, v, known))
            known = v if v is not None else known
    assert values(found) == sorted(expected, key=repr)


def test_days_are_pruned_as_the_job_runs(spark, tmp_path):
    events = frame(spark, [("s", f"2024-01-{d:02d} 05:00:00", d) for d in range(1, 29)], "source string, at string, n int")
    events = events.select("source", F.col("at").cast("timestamp_ntz").alias("synced_at"), "n")
    scans.by_day(events, "synced_at").write.partitionBy("sync_day").parquet(f"{tmp_path}/log")
    bounds = frame(spark, [("s", "2024-01-05 00:00:00", "2024-01-07 05:00:00")], "source string, a string, b string").select(
        "source", F.col("a").cast("timestamp_ntz").alias("start"), F.col("b").cast("timestamp_ntz").alias("end")
    )
    bounds = Workspace(spark, "bounds").stage(bounds, "bounds")
    found = scans.scan_by_source_partitioned(spark.read.parquet(f"{tmp_path}/log"), bounds)
    assert values(found, "n") == [(5,), (6,), (7,)]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
