"""The registered queries: every operator over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from syncloom.functions import keys as k
from syncloom.operators import (
    changes as ch,
    digests,
    joins,
    payloads,
    quantity as qt,
    retry,
    skus as sk,
    units,
    upserts,
)
from syncloom.operators.matching import factorise_sites, match_sites, matched_pairs
from syncloom.plans import rebuild
from syncloom.plans.sync import SOURCES, Inputs, Options, run_sync
from syncloom.queries.standins import CUTOFF, EVENTS_FROM, EVENTS_TO, Standins, ntz
from syncloom.schemas import ASSET_KEYS, EVENT_KEYS, FEEDS, MASTER_KEYS, SKU_KEYS
from syncloom.sinks.feeds import nest_json, write_feed
from syncloom.sources import feeds, scans
from syncloom.session import no_rows
from syncloom.state.buckets import BucketedTable
from syncloom.state.store import StateStore
from syncloom.streaming.deltas import DeltaStream, append_stream, dedupe_within, event_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TS = "2024-02-01 00:00:00"
RUN_ID = "run-1"
FORCED_BRANCH = 7
#: Event numbers of a log that many others share.
SPARSE = 1_000_003


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers of any type as bigint, so that equal values are equal."""
    whole = (T.DecimalType, T.IntegerType, T.ShortType)
    return df.select(
        *[
            F.col(f.name).cast("long") if isinstance(f.dataType, whole) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(function: Callable[[Standins], DataFrame]) -> Callable[[Standins], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(Standins(spark, sf_dir)))

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


# --- scans and fingerprints ---------------------------------------------------


@query
def fingerprint_orders(t: Standins) -> DataFrame:
    """All-column hash per order."""
    orders = t.table("orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)"))
    return ch.fingerprint(orders, ["o_orderkey"])


@query
def interval_scan_events(t: Standins) -> DataFrame:
    """Events of one interval, both ends included."""
    found = scans.interval_scan(t.qty_events, "synced_at", ntz(EVENTS_FROM), ntz(EVENTS_TO))
    return found.select(*EVENT_KEYS, "qty")


def _bounds(t: Standins) -> DataFrame:
    return scans.interval_bounds(t.control, ntz(EVENTS_TO))


@query
def interval_bounds(t: Standins) -> DataFrame:
    """The interval each source is due for."""
    return _bounds(t)


@query
def scan_by_source(t: Standins) -> DataFrame:
    """Events within the interval of their own source."""
    events = t.table("events").select("event_id", "ts", "event_type")
    return scans.scan_by_source(events, _bounds(t), ts_col="ts", source="event_type")


@query
def scan_by_source_partitioned(t: Standins) -> DataFrame:
    """The same over a log that is partitioned by day."""
    events = t.table("events").select("event_id", "ts", "event_type")
    path = t.work.path("events_by_day")
    scans.by_day(events, "ts").write.partitionBy(scans.SYNC_DAY).parquet(path)
    bounds = t.stage(_bounds(t), "bounds")
    found = scans.scan_by_source_partitioned(
        t.spark.read.parquet(path), bounds, ts_col="ts", source="event_type"
    )
    return found.drop(scans.SYNC_DAY)


@query
def forced_scan_orders(t: Standins) -> DataFrame:
    """All assets of one branch that the interval scan has not selected."""
    assets = t.assets.select(*ASSET_KEYS, "home_branch", "current_branch", "synced_at")
    already = scans.interval_scan(assets, "synced_at", ntz(CUTOFF), ntz("2002-01-01"))
    return scans.forced_scan(assets, t.active, FORCED_BRANCH, already, ASSET_KEYS)


# --- asset changes ------------------------------------------------------------


@query
def snapshot_diff_orders(t: Standins) -> DataFrame:
    """Assets that are new or whose hash differs."""
    return t.diff


@query
def snapshot_diff_deletes(t: Standins) -> DataFrame:
    """The diff the other way round, with the assets that are gone."""
    return ch.snapshot_diff(
        t.prints(t.assets_before), t.prints(t.assets), ASSET_KEYS, include_deletes=True
    )


@query
def snapshot_diff_buckets(t: Standins) -> DataFrame:
    """The diff against a snapshot kept by bucket, reading the buckets whose digests differ."""
    root = t.work.path("snapshot")
    digests.write_snapshot(t.prints(t.assets_before), ASSET_KEYS, root, buckets=64)
    return digests.snapshot_diff_buckets(t.prints(t.assets), root, ASSET_KEYS, buckets=64, group=8)


@query
def active_change_feed(t: Standins) -> DataFrame:
    """Changes of assets whose current branch is active."""
    return ch.active_change_feed(t.diff, t.assets, t.active)


@query
def queue_replay_changes(t: Standins) -> DataFrame:
    """Changes and the waiting assets that are not among them."""
    return t.changes


@query
def restrict_to_changes(t: Standins) -> DataFrame:
    """Source rows of the changed assets."""
    lines = t.table("lineitem").select(
        F.concat(F.lit("A"), F.col("l_orderkey").cast("string")).alias("asset_id"),
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").cast("long").alias("qty"),
    )
    return joins.keep_matching(lines, t.diff, ["asset_id"])


# --- quantities ---------------------------------------------------------------


def _delta_columns(df: DataFrame) -> DataFrame:
    return df.select(*EVENT_KEYS, "qty", "prev_qty", k.increase(F.col("qty"), F.col("prev_qty")).alias("rise"))


@query
def quantity_delta_events(t: Standins) -> DataFrame:
    """Each event with the quantity before it."""
    return _delta_columns(qt.quantity_delta(t.qty_events))


@query
def quantity_delta_sliced(t: Standins) -> DataFrame:
    """The same with every key of more than a few rows treated as hot and cut into slices."""
    return _delta_columns(qt.quantity_delta(t.qty_events, hot_rows=10, span=500))


@query
def quantity_delta_sparse(t: Standins) -> DataFrame:
    """The same over event numbers that lie far apart, hot keys in slices of equal depth."""
    events = t.qty_events.withColumn("seq", F.col("seq") * SPARSE)
    return _delta_columns(qt.quantity_delta(events, hot_rows=10, span=16))


@query
def semi_join_history(t: Standins) -> DataFrame:
    """Deltas over the whole history of the keys an interval touches."""
    due = scans.interval_scan(t.qty_events, "synced_at", ntz(EVENTS_TO), ntz("2024-01-21"))
    return _delta_columns(qt.quantity_delta(qt.touched_history(t.qty_events, due, SKU_KEYS)))


@query
def snapshot_fallback(t: Standins) -> DataFrame:
    """Deltas whose quantity before comes from the snapshot where the log has none."""
    return _delta_columns(t.deltas)


@query
def snapshot_fallback_first(t: Standins) -> DataFrame:
    """The same, for the first event of each key alone."""
    deltas = qt.quantity_delta(t.qty_events, first="is_first")
    return _delta_columns(qt.fill_from_snapshot(deltas, t.qty_snapshot, first="is_first"))


@query
def lookup_default(t: Standins) -> DataFrame:
    """Events with the cached quantity, 0 by default, and a flag."""
    cached = t.event_state.select(*EVENT_KEYS, F.col("qty").alias("cached_qty"))
    return joins.lookup(
        t.qty_events.select(*EVENT_KEYS, "qty"),
        cached,
        EVENT_KEYS,
        {"cached_qty": F.lit(0)},
        found="known",
    )


@query
def quantity_change_feed(t: Standins) -> DataFrame:
    """Rises of bulk quantities in active branches within an interval."""
    return t.quantity_changes


@query
def unseen_events(t: Standins) -> DataFrame:
    """Events that no earlier interval has sent."""
    return qt.unseen_events(t.qty_events, t.event_state).select(*EVENT_KEYS)


@query
def rollup_quantities(t: Standins) -> DataFrame:
    """Sum of the rises per SKU and branch."""
    return t.to_send


@query
def rollup_net(t: Standins) -> DataFrame:
    """Sum of rises and falls per SKU and branch."""
    return qt.rollup_quantities(qt.quantity_delta(t.qty_events), net=True)


# --- SKUs ---------------------------------------------------------------------


@query
def sku_derivation(t: Standins) -> DataFrame:
    """SKUs of changed assets."""
    return t.asset_skus


@query
def sku_derivation_bulk(t: Standins) -> DataFrame:
    """SKUs of quantity changes."""
    return t.bulk_skus


@query
def sku_queue_assets(t: Standins) -> DataFrame:
    """SKUs of waiting assets that the list lacks."""
    return sk.skus_of_queued_assets(t.asset_queue, t.sku_master, t.active, t.bulk_skus)


@query
def sku_queue_bulk(t: Standins) -> DataFrame:
    """SKUs of waiting quantities that the list lacks."""
    return sk.skus_of_queued_bulk(t.bulk_queue, t.sku_master, t.active, t.listed)


@query
def sku_queue_bulk_any_branch(t: Standins) -> DataFrame:
    """The same, where listed for one branch is listed for all, and sent rows count too."""
    return sk.skus_of_queued_bulk(
        t.bulk_queue, t.sku_master, t.active, t.listed, include_sent=True, per_branch=False
    )


@query
def project_active_bulk(t: Standins) -> DataFrame:
    """Bulk SKUs of line items, mapped to the remote columns."""
    lines = t.bulk_queue.select(*MASTER_KEYS, "qty")
    bulk = t.sku_master.where(F.col("bulk") == "Y")
    return joins.project_map(
        lines.join(bulk, MASTER_KEYS),
        {
            "upc": k.upc(F.col("category")),
            "product_id": k.product_id(F.col("class_code")),
            "label": k.sku_label(F.col("category"), F.col("class_code")),
            "description": F.coalesce(F.col("description"), F.lit("")),
            "qty": F.col("qty").cast("long"),
            "is_bulk": F.lit(True),
        },
    )


@query
def remote_missing_skus(t: Standins) -> DataFrame:
    """SKUs that the remote list does not have."""
    return sk.missing_skus(t.listed, t.remote_skus)


@query
def flag_missing_skus(t: Standins) -> DataFrame:
    """The SKU list with the action each SKU needs."""
    return sk.flag_missing(t.listed, t.remote_skus).select(*SKU_KEYS, "label", "action")


@query
def resolve_skus(t: Standins) -> DataFrame:
    """The SKU list with remote ids."""
    return t.resolved.select(*SKU_KEYS, "is_bulk", "location_id", "sku_id")


@query
def unresolved_keys(t: Standins) -> DataFrame:
    """Waiting quantities whose SKU has no remote id."""
    return sk.unresolved(t.bulk_queue, t.resolved).select("run_id", *SKU_KEYS, "qty", "status")


# --- retry queues -------------------------------------------------------------


def _held_bulk(t: Standins) -> DataFrame:
    return retry.hold_back_bulk(
        t.to_send, t.resolved, t.active, t.bulk_queue, RUN_ID, ntz(RUN_TS)
    )


@query
def hold_back_bulk(t: Standins) -> DataFrame:
    """Quantities that have to wait for their SKU."""
    return _held_bulk(t)


@query
def hold_back_bulk_dedupe(t: Standins) -> DataFrame:
    """The queue when what is held goes into the entry that waits."""
    return retry.merge_held(t.bulk_queue, t.stage(_held_bulk(t), "held_bulk"))


def _held_assets(t: Standins) -> DataFrame:
    return retry.hold_back_assets(
        t.changes, t.changed_assets, t.resolved, t.active, t.asset_queue, RUN_ID, ntz(RUN_TS)
    )


@query
def hold_back_assets(t: Standins) -> DataFrame:
    """Changed assets that have to wait for their SKU."""
    return _held_assets(t)


@query
def append_capture_queue(t: Standins) -> DataFrame:
    """The queue after an append: the waiting rows."""
    queue, _ = retry.append_capture(t.asset_queue, _held_assets(t))
    return retry.unsent(queue)


@query
def append_capture_rows(t: Standins) -> DataFrame:
    """The rows an append captured."""
    _, rows = retry.append_capture(t.asset_queue, _held_assets(t))
    return rows


def _replayed(t: Standins) -> DataFrame:
    return retry.replay_quantities(t.bulk_queue, sk.resolved(t.resolved, is_bulk=True))


@query
def replay_quantities(t: Standins) -> DataFrame:
    """Sum of the waiting quantities whose SKU now resolves."""
    return _replayed(t)


def _send_list(t: Standins) -> DataFrame:
    sent = retry.send_list(t.to_send, _replayed(t), _held_bulk(t))
    return t.stage(sent, "send_list")


@query
def replay_send_list(t: Standins) -> DataFrame:
    """New and replayed quantities without those just held back."""
    return _send_list(t)


@query
def replay_mark_sent(t: Standins) -> DataFrame:
    """The queue with the replayed rows marked as sent."""
    marked = retry.mark_sent(t.bulk_queue, _send_list(t), SKU_KEYS, RUN_ID, ntz(RUN_TS))
    return marked.drop("reason")


def _settled(t: Standins):
    held = t.stage(_held_assets(t), "held_assets")
    queue, _ = retry.append_capture(t.asset_queue, held)
    return retry.settle_assets(
        t.changes, t.changed_assets, queue, t.resolved, t.active, RUN_ID, ntz(RUN_TS),
        stage=lambda df: t.stage(df, "placed_assets"),
    )


@query
def settle_changes(t: Standins) -> DataFrame:
    """The asset changes that can be sent."""
    return _settled(t)[0]


@query
def settle_queue(t: Standins) -> DataFrame:
    """The asset queue after the run."""
    return _settled(t)[1]


# --- units and tags -----------------------------------------------------------


@query
def max_tag(t: Standins) -> DataFrame:
    """The highest tag number per remote SKU."""
    return units.max_tag(t.remote_items, ["location_id", "sku_id"])


@query
def max_tag_incremental(t: Standins) -> DataFrame:
    """The highest tag numbers kept as state, after three runs that each saw a part of the items."""
    keys = ["location_id", "sku_id"]
    items = t.remote_items.withColumn("_part", F.pmod(F.xxhash64("asset_id"), F.lit(3)))
    state = no_rows(t.spark, "location_id long, sku_id long, max_tag int")
    for part in range(3):
        changed = units.max_tags_after(state, items.where(F.col("_part") == part), keys)
        state = t.stage(upserts.upsert(state, t.stage(changed, f"tags_{part}"), keys), f"max_tags_{part}")
    return state


@query
def waiting_sums_incremental(t: Standins) -> DataFrame:
    """Waiting quantities kept as sums, after all was queued in two runs and a part was sent."""
    keys = [*SKU_KEYS, "status"]
    sums = "company string, branch string, category decimal(3,0), class_code decimal(4,0), status string, qty decimal(18,2), entries long"
    state, queue = no_rows(t.spark, sums), t.bulk_queue.withColumn("qty", F.col("qty").cast("decimal(18,2)"))
    early = F.col("run_id") < "r4"
    sent = queue.where(F.col("sent_at").isNotNull())
    for run, (queued, gone) in enumerate(
        [(queue.where(early), sent.where("false")), (queue.where(~early), sent)]
    ):
        changed = t.stage(retry.waiting_sums_after(state, queued, gone), f"sums_{run}")
        state = t.stage(upserts.upsert(state, changed, keys), f"waiting_{run}")
    return state.where(F.col("entries") > 0)


@query
def expand_units(t: Standins) -> DataFrame:
    """One row per unit of each part."""
    parts = t.table("part").select("p_partkey", (F.col("p_size") - F.lit(0.25)).alias("qty"))
    return units.expand_units(parts).select("p_partkey", "unit_no")


@query
def expand_units_totals(t: Standins) -> DataFrame:
    """All units of all line items, expanded and counted per part."""
    lines = t.table("lineitem").select("l_partkey", "l_quantity")
    expanded = units.expand_units(lines, "l_quantity")
    return expanded.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("units"), F.sum("unit_no").alias("sum_unit_no")
    )


@query
def expand_units_chunked(t: Standins) -> DataFrame:
    """The same per part in one row of many units, cut into chunks that are spread."""
    parts = t.table("lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("qty"))
    expanded = units.expand_units(parts, chunk=100)
    return expanded.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("units"), F.sum("unit_no").alias("sum_unit_no")
    )


def _ranges(t: Standins) -> DataFrame:
    ready = sk.resolved(t.resolved, is_bulk=True)
    return units.tag_ranges(
        _send_list(t), units.sku_max_tags(ready, t.remote_items), t.sku_master
    )


@query
def tag_ranges(t: Standins) -> DataFrame:
    """Where the tags of each SKU and source start."""
    return _ranges(t).select(*SKU_KEYS, "source_rank", "units", "after_tag", "sku_id")


@query
def allocate_tags(t: Standins) -> DataFrame:
    """One tag per unit that goes out."""
    return units.allocate_tags(_ranges(t)).select("location_id", "sku_id", "tag_no", "tag")


# --- matching and payloads ----------------------------------------------------


@query
def match_customer_sites(t: Standins) -> DataFrame:
    """Customer sites matched to remote locations by any rule."""
    return match_sites(t.customer_sites, t.remote_sites, mode="union")


@query
def union_site_rules(t: Standins) -> DataFrame:
    """Sites and locations that any of the four rules brings together."""
    return matched_pairs(t.customer_sites, t.remote_sites)


@query
def union_site_rules_factorised(t: Standins) -> DataFrame:
    """The same pairs as groups: the sites of each, and its locations."""
    found = factorise_sites(t.customer_sites, t.remote_sites, lambda df: t.stage(df, f"sites_{uuid4().hex}"))
    members = found.members.select("group", F.lit("site").alias("side"), F.col("site_id").alias("id"))
    locations = found.locations.select("group", F.lit("location").alias("side"), F.col("location_id").alias("id"))
    return members.unionByName(locations)


@query
def match_sites_first_rule(t: Standins) -> DataFrame:
    """Customer sites matched by the strictest rule that finds a location."""
    return match_sites(t.customer_sites, t.remote_sites, mode="first_rule")


def _prior(t: Standins) -> DataFrame:
    return payloads.prior_attributes(t.assets_before, t.active)


@query
def prior_attributes(t: Standins) -> DataFrame:
    """Serial numbers of assets in use by home branch."""
    return _prior(t)


@query
def asset_payload(t: Standins) -> DataFrame:
    """Changed assets as they are sent."""
    ready = sk.resolved(t.resolved, is_bulk=False)
    sendable = t.stage(_settled(t)[0], "sendable")
    return payloads.asset_payload(
        sendable, t.assets, t.active, ready, _prior(t), ntz(RUN_TS)
    )


@query
def asset_payload_nested(t: Standins) -> DataFrame:
    """Changed assets as documents of a location, a SKU and a group of ids."""
    feed = payloads.with_group(asset_payload(t)).drop("DateAdded", "LastUpdated", "LastNotification")
    parent = list(payloads.ASSET_DOCUMENT)
    return nest_json(feed, parent, [c for c in feed.columns if c not in parent], "items")


@query
def sku_payload(t: Standins) -> DataFrame:
    """The SKU list as it is sent."""
    return payloads.sku_payload(sk.flag_missing(t.listed, t.remote_skus), ntz(RUN_TS))


@query
def sku_payload_missing(t: Standins) -> DataFrame:
    """Only the SKUs that the remote side lacks."""
    flagged = sk.flag_missing(t.listed, t.remote_skus)
    return payloads.sku_payload(flagged, ntz(RUN_TS), only_missing=True)


@query
def json_shred_events(t: Standins) -> DataFrame:
    """JSON objects of events as typed columns."""
    boxed = t.table("events").select("event_id", F.concat(F.lit("["), "props", F.lit("]")).alias("doc"))
    return feeds.shred(boxed, "doc", "k bigint", keep=["event_id"])


@query
def json_nest_orders(t: Standins) -> DataFrame:
    """One document per customer and order status with its orders."""
    orders = t.table("orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_orderpriority")
    parent, children = ["o_custkey", "o_orderstatus"], ["o_orderkey", "o_orderpriority"]
    return nest_json(orders, parent, children, "orders")


@query
def export_roundtrip(t: Standins) -> DataFrame:
    """Orders written as a gzip feed and read back."""
    root = t.work.path("feeds")
    orders = t.table("orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        k.stamp(F.col("o_orderdate")).alias("added"),
    )
    write_feed(orders, root, "orders", RUN_ID)
    found = feeds.read_json_feed(t.spark, root, orders.schema.toDDL(), RUN_ID, "orders")
    return found.withColumn("price", F.col("price").cast("string"))


@query
def feed_remote_skus(t: Standins) -> DataFrame:
    """The remote SKU list landed as a feed, read, and brought under our names."""
    landing = t.work.path("landing")
    day = ntz(RUN_TS)
    sent = t.remote_skus.select(
        F.col("sku_id").alias("ID"),
        day.alias("DateAdded"),
        day.alias("LastUpdated"),
        F.col("location_id").alias("HQLocationID"),
        F.col("upc").alias("UPC"),
        F.col("product_id").alias("ProductID"),
    )
    write_feed(sent, landing, "skus", RUN_ID)
    return feeds.remote_skus(feeds.read_json_feed(t.spark, landing, FEEDS["skus"], RUN_ID, "skus"))


@query
def customer_snapshot(t: Standins) -> DataFrame:
    """Customers fingerprinted, stored and read back."""
    tables = {"customers": "c_custkey bigint, hash string"}
    store = StateStore(t.spark, t.work.path("state"), tables)
    customers = t.table("customer").withColumn(
        "c_acctbal", F.col("c_acctbal").cast("decimal(12,2)")
    )
    commit = store.begin(RUN_ID)
    commit.overwrite("customers", ch.fingerprint(customers, ["c_custkey"]))
    commit.publish()
    return store.read("customers")


# --- joins and keys -----------------------------------------------------------


@query
def distinct_keys(t: Standins) -> DataFrame:
    """Distinct SKU keys of the line items."""
    return joins.distinct_keys(t.bulk_queue, SKU_KEYS)


@query
def dimension_joins(t: Standins) -> DataFrame:
    """Customers per location, restricted by company and branch and by branch alone."""
    sites = t.customer_sites.select("site_id", "company", "branch")
    by_both = joins.with_branch_id(sites, t.active)
    by_branch = joins.in_active_branches(sites, t.active, company=None)
    counts = by_branch.groupBy("branch").agg(F.count(F.lit(1)).alias("sites"))
    return by_both.join(counts, "branch").select("site_id", "location_id", "branch", "sites")


# --- state and runs -----------------------------------------------------------


@query
def upsert_state(t: Standins) -> DataFrame:
    """The asset state after the changed assets went in."""
    changed = joins.keep_matching(t.assets, t.changes, ASSET_KEYS)
    return upserts.upsert(t.prints(t.assets_before), t.prints(changed), ASSET_KEYS)


@query
def upsert_bucketed(t: Standins) -> DataFrame:
    """The same, merged by bucket into a state that lies in buckets of its key."""
    ddl = "company string, asset_id string, hash string"
    state = BucketedTable(t.spark, t.work.path("bucketed"), ddl, ASSET_KEYS, buckets=8)
    before = state.write(t.prints(t.assets_before), 1)
    changed = joins.keep_matching(t.assets, t.changes, ASSET_KEYS)
    return state.upsert(before, t.prints(changed), 2)


@query
def advance_watermark(t: Standins) -> DataFrame:
    """The control table after a run, its ends where each source's data ends."""
    found = scans.scan_by_source(
        t.table("events"), _bounds(t), ts_col="ts", source="event_type"
    )
    return upserts.advance_watermark(
        t.control, ntz(EVENTS_TO), found, ts_col="ts", source="event_type"
    )


@query
def rebuild_assets(t: Standins) -> DataFrame:
    """The asset state rebuilt: hashes, and the serial numbers of before."""
    prints = rebuild.asset_fingerprints(t.assets, ntz(RUN_TS)).drop("cached_at")
    prior = payloads.prior_attributes(t.assets, t.active)
    return prints.join(prior, ASSET_KEYS, "left")


@query
def rebuild_quantities(t: Standins) -> DataFrame:
    """The event state rebuilt from the whole log."""
    state = rebuild.event_fingerprints(t.qty_events, t.qty_snapshot, ntz(RUN_TS))
    return state.select(*EVENT_KEYS, "qty", "prev_qty", "hash")


@query
def rebuild_snapshot(t: Standins) -> DataFrame:
    """The snapshot state rebuilt."""
    return rebuild.snapshot_fingerprints(t.qty_snapshot, ntz(RUN_TS)).drop("cached_at")


@query
def stream_delta(t: Standins) -> DataFrame:
    """Quantity deltas of the event log read as a stream."""
    source = t.table("events").schema
    stream = event_stream(t.spark, t.sf_dir, source, files="events.parquet").select(
        "event_id", "ts", "user_id", "event_type", F.floor("value").cast("long").alias("qty")
    )
    keys = ["user_id", "event_type"]
    job = DeltaStream(
        t.spark, stream.schema, t.work.path("stream"),
        event_keys=[*keys, "event_id", "ts"], keys=keys, order=["event_id"], ts_col="ts",
    )
    job.start(stream).awaitTermination()
    return job.deltas()


def _arrivals(t: Standins, parts: list[DataFrame], name: str):
    """Parts of a log that land in a folder one after the other."""
    folder = t.work.path(name)
    for part in parts:
        part.write.mode("append").parquet(folder)
        yield folder


@query
def stream_late_corrections(t: Standins) -> DataFrame:
    """Deltas of a log whose events arrive out of order, corrected as late ones come."""
    events = t.table("events").select(
        "event_id", "ts", "user_id", "event_type", F.floor("value").cast("long").alias("qty")
    )
    keys = ["user_id", "event_type"]
    job = DeltaStream(
        t.spark, events.schema, t.work.path("corrected"), event_keys=[*keys, "event_id", "ts"],
        keys=keys, order=["event_id"], ts_col="ts", corrections=True, fold=2,
    )
    turn = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for folder in _arrivals(t, [events.where(turn == n) for n in range(3)], "late_log"):
        job.start(event_stream(t.spark, folder, events.schema)).awaitTermination()
    return job.deltas()


@query
def stream_dedupe(t: Standins) -> DataFrame:
    """Events of exports that overlap by a day, each once."""
    events = t.table("events").select("event_id", "ts", "user_id", "event_type")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    length = (last - first) / 4
    overlap = timedelta(days=1)
    # A quarter is rounded to the microsecond: the last export ends where the log ends.
    ends = [first + (n + 1) * length for n in range(3)] + [last]
    exports = [
        events.where(F.col("ts").between(first + n * length - overlap, end)) for n, end in enumerate(ends)
    ]
    root = t.work.path("deduped")
    for folder in _arrivals(t, exports, "exports"):
        stream = event_stream(t.spark, folder, events.schema)
        append_stream(dedupe_within(stream, ["event_id"], "ts", "3 days"), root).awaitTermination()
    return t.spark.read.schema(events.schema).parquet(f"{root}/rows")


@query
def feed_rejects(t: Standins) -> DataFrame:
    """A landed feed with lines that are broken or do not fit: the good rows, and the rejects."""
    number, kind = F.col("event_id").cast("string"), F.col("event_id") % 50
    whole = lambda value: F.concat(F.lit('{"ID":'), value, F.lit(',"PC":"'), F.col("event_type"), F.lit('"}'))
    line = (
        F.when(kind == 7, whole(F.concat(F.lit('"x'), number, F.lit('"'))))
        .when(kind == 11, F.concat(F.lit('{"ID":'), number))
        .otherwise(whole(number))
    )
    landing = t.work.path("landing")
    t.table("events").select(line.alias("value")).write.text(feeds.feed_path(landing, "branches", "s1"))
    good, bad = feeds.read_with_rejects(
        t.spark, landing, FEEDS["branches"], "s1", "branches", lambda df: t.stage(df, "parsed")
    )
    return good.select(
        F.lit("good").alias("kind"), F.col("ID").cast("string").alias("content"), F.col("PC").alias("note")
    ).unionByName(
        bad.select(F.lit("bad").alias("kind"), F.col("raw").alias("content"), F.col("reason").alias("note"))
    )


def sync_inputs(t: Standins) -> Inputs:
    return Inputs(
        assets=t.assets,
        qty_events=t.qty_events,
        qty_snapshot=t.qty_snapshot,
        sku_master=t.sku_master,
        active=t.active,
        remote_skus_before=t.remote_skus,
        remote_skus_after=t.remote_skus,
        remote_items=t.remote_items,
        customer_sites=t.customer_sites,
        remote_sites=t.remote_sites,
    )


def seeded_store(t: Standins, root: str) -> StateStore:
    """State as an earlier run left it: the assets and queues of before, nothing sent of late."""
    store = StateStore(t.spark, root)
    commit = store.begin("seed")
    long_ago = ntz("1995-01-01")
    commit.overwrite(
        "asset_state", t.prints(t.assets_before).withColumn("cached_at", long_ago)
    )
    commit.overwrite("prior_attributes", _prior(t))
    commit.overwrite(
        "qty_snapshot_state", rebuild.snapshot_fingerprints(t.qty_snapshot, long_ago)
    )
    commit.overwrite("bulk_queue", t.bulk_queue)
    commit.overwrite("asset_queue", t.asset_queue)
    times = {c: long_ago for c in ("start_ts", "prev_start_ts", "end_ts")}
    sources = t.spark.createDataFrame([(s,) for s in SOURCES], "source string")
    commit.overwrite("control", sources.withColumns(times))
    commit.publish()
    return store


def _whole_run(t: Standins):
    """A run over the stand-ins, and the store after it."""
    t.write_tables("sku_master", "qty_snapshot", "remote_skus")
    store = seeded_store(t, t.work.path("state"))
    run_id = f"{RUN_ID}-{uuid4().hex}"
    result = run_sync(
        t.spark, sync_inputs(t), store, datetime.fromisoformat(RUN_TS), run_id,
        t.work.path("feeds"), Options(end_at_data=True),
    )
    return result, store


@query
def sync_run(t: Standins) -> DataFrame:
    """A whole run: every record of the SKU, unit and asset feeds it sent."""
    result, _ = _whole_run(t)
    texts = (
        "TagID AssetID SerialNumber PrevSerial UPC ProductID SKUListType Description"
    ).split()
    numbers = ["HQLocationID", "HQSKUID", "IsConsumable", "IsActive"]
    found = None
    for name in ("skus", "units", "assets"):
        feed = result.feeds[name]
        have = set(feed.columns)
        times = [c for c in ("DateAdded", "LastUpdated", "LastNotification") if c in have]
        quantity = next((c for c in ("QuantityOnHand", "Quantity") if c in have), None)
        columns = [
            F.lit(name).alias("feed"),
            F.concat(
                *[F.date_format(F.col(c).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSS") for c in times]
            ).alias("stamps"),
            *[(F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in texts],
            *[(F.col(c) if c in have else F.lit(None)).cast("long").alias(c) for c in numbers],
            (F.col(quantity) if quantity else F.lit(None)).cast("long").alias("quantity"),
        ]
        rows = feed.select(*columns)
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def sync_run_state(t: Standins) -> DataFrame:
    """What the state and queue tables hold after a whole run, as keys and values."""
    _, store = _whole_run(t)
    sku = [F.col(c).cast("string") for c in SKU_KEYS]
    asset = [F.col(c) for c in ASSET_KEYS]
    qty = F.col("qty").cast("long").cast("string")
    shown = {
        "asset_state": (asset, [F.col("hash")]),
        "prior_attributes": (asset, [F.col("serial")]),
        "qty_event_state": ([*sku, F.col("seq").cast("string")], [qty]),
        "last_qty": (sku, [F.col("seq").cast("string"), qty]),
        "qty_snapshot_state": (sku, [qty]),
        "bulk_queue": ([*sku, F.col("status")], [qty]),
        "asset_queue": (asset, [F.col("branch"), F.col("category"), F.col("class_code")]),
        "control": (
            [F.col("source")],
            [F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("start_ts", "end_ts")],
        ),
    }
    found = None
    for name, (keys, kept) in shown.items():
        rows = store.read(name).select(
            F.lit(name).alias("name"),
            F.concat_ws("/", *keys).alias("key"),
            F.concat_ws("/", *kept).alias("value"),
        )
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def sync_run_sites(t: Standins) -> DataFrame:
    """The customer site feed of a whole run."""
    result, _ = _whole_run(t)
    return result.feeds["customer_sites"]


#: A log in which times are whole hours, so that many events lie at the very time of a run, and
#: every seventh event is replicated three days late.
FIRST_RUN_TS = "2024-01-15 00:00:00"


@query
def sync_run_second(t: Standins) -> DataFrame:
    """Two runs: what each took for a rise, and what each left waiting.

    The first one sees half of the events at its own time, the second one all; falls, late events
    and the repeated end of the interval are in both. No SKU has a remote id, so what a run
    would send waits in the queue, by run.
    """
    hour = F.date_trunc("hour", F.col("synced_at")).cast("timestamp_ntz")
    late = F.when(F.col("seq") % 7 == 0, hour + F.expr("interval 3 days")).otherwise(hour)
    log = t.qty_events.withColumn("synced_at", late).where(F.col("synced_at") <= ntz(RUN_TS))
    log = t.stage(log, "hourly")
    run_1 = ntz(FIRST_RUN_TS)
    at, half = F.col("synced_at") == run_1, F.col("seq") % 2 == 0
    seen = log.where((F.col("synced_at") < run_1) | (at & half))
    t.write_tables("sku_master")
    store = StateStore(t.spark, t.work.path("state"))
    seed = store.begin("seed")
    times = {c: ntz("1995-01-01") for c in ("start_ts", "prev_start_ts", "end_ts")}
    seed.overwrite("control", t.spark.createDataFrame([(s,) for s in SOURCES], "source string").withColumns(times))
    seed.publish()
    for run, (events, ts) in enumerate([(seen, FIRST_RUN_TS), (log, RUN_TS)], start=1):
        inputs = replace(
            sync_inputs(t),
            assets=t.assets.where("false"),
            qty_events=events,
            qty_snapshot=events.groupBy(*SKU_KEYS).agg(F.max("qty").alias("qty")),
            remote_skus_before=t.remote_skus.where("false"),
            remote_skus_after=t.remote_skus.where("false"),
            customer_sites=None,
            remote_sites=None,
        )
        run_sync(
            t.spark, inputs, store, datetime.fromisoformat(ts), f"run-{run}", t.work.path("feeds"), Options()
        )
    sku = [F.col(c).cast("string") for c in SKU_KEYS]
    qty = F.col("qty").cast("long").alias("qty")
    of_run = lambda c: F.when(F.col(c) == run_1, 1).otherwise(2).alias("run")
    risen = store.read("qty_event_state").select(
        F.lit("rise").alias("what"), F.concat_ws("/", *sku, F.col("seq").cast("string")).alias("key"), of_run("cached_at"), qty
    )
    waiting = store.read("bulk_queue").select(
        F.lit("waits").alias("what"), F.concat_ws("/", *sku).alias("key"), of_run("detected_at"), qty
    )
    last = store.read("last_qty").select(
        F.lit("last").alias("what"), F.concat_ws("/", *sku, F.col("seq").cast("string")).alias("key"), F.lit(2).alias("run"), qty
    )
    return risen.unionByName(waiting).unionByName(last)
