"""One sync run: find what changed, resolve it, publish it, then advance the state."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from syncloom.operators import changes as ch, payloads, quantity as qt, retry, skus as sk, units
from syncloom.operators.joins import exclude, in_active_branches, keep_matching
from syncloom.operators.matching import match_sites
from syncloom.operators.skew import latest
from syncloom.operators.upserts import advance_watermark
from syncloom.plans.rebuild import snapshot_fingerprints
from syncloom.schemas import ASSET_KEYS, EVENT_KEYS, SKU_KEYS
from syncloom.session import Workspace, together
from syncloom.sinks.feeds import as_json, nest_json, nested_ddl, write_feed
from syncloom.sources.feeds import read_json_feed
from syncloom.sources.scans import SYNC_DAY, forced_scan, interval_bounds, interval_scan
from syncloom.state.store import StateStore

SOURCES = ("assets", "qty_events")
EVENT_DAYS = 60


@dataclass
class Inputs:
    """Source tables and remote feeds, under this library's column names.

    Remote ids appear only after the remote side has taken in the SKU feed, so its
    SKU list comes twice: as it was before, and as it is after.
    """

    assets: DataFrame
    qty_events: DataFrame
    qty_snapshot: DataFrame
    sku_master: DataFrame
    active: DataFrame
    remote_skus_before: DataFrame
    remote_skus_after: DataFrame
    remote_items: DataFrame
    customer_sites: DataFrame | None = None
    remote_sites: DataFrame | None = None


@dataclass
class Options:
    force_branch: int | str | None = None
    only_missing_skus: bool = False
    only_changed_sites: bool = False
    dedupe_queue: bool = False
    fill_first_only: bool = False
    nest_skus: bool = False
    nest_assets: bool = False
    site_mode: str = "first_rule"
    # Events sent longer ago than this before the interval no longer count as known; the source
    # itself forgets events after so many days. None looks back without end.
    event_days: int | None = EVENT_DAYS
    # Falls count against the rises of a SKU.
    net: bool = False
    # The end of each source's interval is the time of the latest row it delivered.
    end_at_data: bool = False


@dataclass
class Result:
    """The feeds a run sent, read back from where they were written."""

    feeds: dict[str, DataFrame] = field(default_factory=dict)
    paths: dict[str, str | None] = field(default_factory=dict)
    skipped: bool = False


class SyncRun:
    """The stages of one run; ``run`` takes them in order."""

    def __init__(
        self,
        spark: SparkSession,
        inputs: Inputs,
        store: StateStore,
        run_ts: datetime,
        run_id: str,
        out: str,
        options: Options | None = None,
    ):
        self.spark = spark
        self.inputs = inputs
        self.store = store
        self.run_ts = run_ts
        self.now: Column = F.lit(run_ts).cast("timestamp_ntz")
        self.run_id = run_id
        self.out = out
        self.options = options or Options()
        self.work = Workspace(spark, run_id)
        self.result = Result()
        self.reached: dict[str, Observation] = {}

    def run(self) -> Result:
        """All stages; the state and the watermark are published last, in one step."""
        self.commit = self.store.begin(self.run_id)
        if self.commit.done:
            return Result(skipped=True)
        control, bounds = self.intervals()
        (asset_changes, changed_assets), quantity_changes, _ = together(
            lambda: self.asset_changes(*bounds["assets"]),
            lambda: self.quantity_changes(*bounds["qty_events"]),
            self.customer_sites,
        )
        skus = self.sku_list(asset_changes, changed_assets, quantity_changes)
        together(
            lambda: self.sku_feed(skus),
            lambda: self.bulk(quantity_changes, skus),
            lambda: self.assets(asset_changes, changed_assets, skus),
        )
        self.quantity_state(quantity_changes)
        self.commit.overwrite("control", advance_watermark(control, self.now, reached=self.ends()))
        self.commit.publish()
        return self.result

    def intervals(self):
        """The control table with every source in it, and each source's interval."""
        known = self.commit.read("control")
        every = self.spark.createDataFrame([(s,) for s in SOURCES], "source string")
        control = every.join(known, "source", "left")
        # One row per source: two.
        rows = interval_bounds(control, self.now).collect()
        return control, {row["source"]: (row["start"], row["end"]) for row in rows}

    def scan(self, source: DataFrame, name: str, start, end) -> DataFrame:
        """The rows of an interval; on demand their latest time is noted as they are written."""
        found = interval_scan(source, "synced_at", start, end, day=SYNC_DAY)
        if self.options.end_at_data:
            self.reached[name] = Observation(f"{name}-{self.run_id}")
            found = found.observe(self.reached[name], F.max("synced_at").alias("reached"))
        return found

    def ends(self) -> dict[str, Column]:
        """Where each source's data ends; sources without rows in their interval are left out."""
        noted = {name: o.get["reached"] for name, o in self.reached.items()}
        return {n: F.lit(t).cast("timestamp_ntz") for n, t in noted.items() if t is not None}

    def send(self, name: str, feed: DataFrame, nest_by: Sequence[str] = ()) -> None:
        """Write a feed, flat or as one document for each value of the columns it nests by."""
        ddl, lines = feed.schema.toDDL(), as_json(feed)
        if nest_by:
            shape = (list(nest_by), [c for c in feed.columns if c not in nest_by], "items")
            ddl = nested_ddl(feed, *shape)
            lines = nest_json(feed, *shape).select(F.col("doc").alias("value"))
        self.result.paths[name] = write_feed(lines, self.out, name, self.run_id, encoded=True)
        self.result.feeds[name] = read_json_feed(
            self.spark, self.out, ddl, self.run_id, name, required=False
        )

    def customer_sites(self) -> None:
        sites = self.inputs.customer_sites
        if sites is None or sites.isEmpty():
            return
        prints = ch.fingerprint(sites, ["site_id"])
        state = self.commit.read("customer_site_state")
        if self.options.only_changed_sites:
            changed = ch.snapshot_diff(prints, state, ["site_id"])
            sites = keep_matching(sites, changed, ["site_id"], unique=True)
        feed = match_sites(
            sites,
            self.inputs.remote_sites,
            self.options.site_mode,
            stage=lambda df: self.work.stage(df, "locations"),
        ).drop("rule")
        self.send("customer_sites", feed)
        self.commit.overwrite("customer_site_state", prints.withColumn("cached_at", self.now))

    def asset_changes(self, start, end) -> tuple[DataFrame, DataFrame]:
        """The changed assets' keys and types, and their source rows."""
        source, active = self.inputs.assets, self.inputs.active
        chosen = self.scan(source, "assets", start, end)
        if self.options.force_branch is not None:
            already = interval_scan(source, "synced_at", start, end)
            chosen = chosen.unionByName(
                forced_scan(source, active, self.options.force_branch, already, ASSET_KEYS)
            )
        # Hashed first: what is shuffled to find the latest row of an asset is narrow.
        hashed = ch.fingerprint(
            chosen,
            ASSET_KEYS,
            exclude_columns=["synced_at"],
            keep=["current_branch", "synced_at"],
        )
        prints = self.work.stage(latest(hashed, ASSET_KEYS, ["synced_at"]), "asset_prints")
        found = ch.active_changes(prints, self.commit.read("asset_state"), active)
        located = self.work.stage(found, "asset_feed")
        changes = ch.replay_into_changes(located, self.commit.read("asset_queue"))
        changes = self.work.stage(changes, "asset_changes")
        # The wide table is read once for all that follows.
        rows = keep_matching(source, changes, ASSET_KEYS, unique=True)
        return changes, self.work.stage(latest(rows, ASSET_KEYS, ["synced_at"]), "changed_assets")

    def quantity_changes(self, start, end) -> DataFrame:
        """Rises of the interval's events, over the last quantity of each SKU before them.

        Only the interval of the log is read. The log as a whole is looked into for SKUs with an
        event that comes before one already taken in, and by the first run of a store, which has
        no last quantities yet. Events of the interval that the run before took in are known by their
        keys, whether they rose or fell, as both ends of an interval belong to it; of intervals
        further back those that rose are known, and the last one of each SKU.
        """
        log = self.inputs.qty_events
        day = [SYNC_DAY] if SYNC_DAY in log.columns else []
        rows = log.select(*EVENT_KEYS, "qty", *day)
        state = self.known_events(start)
        found = self.scan(rows, "qty_events", start, end).drop(*day)
        found = self.work.stage(found, "events_found")
        events = rows.drop(*day)
        self.commit.overwrite("taken_events", found.select(*EVENT_KEYS).distinct())
        unseen = qt.unseen_events(found, self.commit.read("taken_events"), start, end)
        due = self.work.stage(qt.unseen_events(unseen, state, start, end), "events_due")
        first = "is_first" if self.options.fill_first_only else None
        last = self.commit.read("last_qty")
        if "last_qty" not in self.commit.before:
            earlier = qt.last_quantities(events.where(F.col("synced_at") < start))
            last = self.work.stage(earlier, "last_quantities")
        due = qt.after_last(due, last)
        late = self.work.stage(qt.late_keys(due, last), "late_skus")
        on_time = exclude(due, late, SKU_KEYS, unique=True)
        deltas = qt.delta_since(on_time, last, first=first)
        if not late.isEmpty():
            history = keep_matching(events, late, SKU_KEYS, unique=True)
            whole = qt.quantity_delta(history.distinct(), first=first)
            deltas = deltas.unionByName(keep_matching(whole, due, EVENT_KEYS))
        self.keep_last(due, last)
        snapshot = self.commit.read("qty_snapshot_state")
        filled = qt.fill_from_snapshot(deltas, snapshot, first=first)
        risen = qt.risen_quantities(
            filled, self.inputs.sku_master, self.inputs.active, self.options.net
        )
        risen = self.work.stage(risen, "risen_quantities")
        return self.work.stage(qt.mark_known_events(risen, state), "quantity_changes")

    def known_events(self, start) -> DataFrame:
        """Events of earlier runs, as far back as the run is told to look."""
        state = self.commit.read("qty_event_state")
        if self.options.event_days is None:
            return state
        return state.where(F.col("synced_at") >= start - timedelta(days=self.options.event_days))

    def keep_last(self, due: DataFrame, last: DataFrame) -> None:
        """Last quantities move on to the interval's events; the first run writes them all."""
        if "last_qty" in self.commit.before:
            last = keep_matching(last, due, SKU_KEYS)
        newest = qt.last_quantities(due.select(*last.columns).unionByName(last))
        self.commit.change("last_qty", newest)

    def sku_list(
        self, asset_changes: DataFrame, changed_assets: DataFrame, quantity_changes: DataFrame
    ) -> DataFrame:
        master, active = self.inputs.sku_master, self.inputs.active
        listed = sk.skus_of_assets(asset_changes, changed_assets, master, active).unionByName(
            sk.skus_of_quantities(quantity_changes, master, active)
        )
        listed = self.work.stage(listed, "skus_of_changes")
        queued_assets = sk.skus_of_queued_assets(
            self.commit.read("asset_queue"), master, active, listed
        )
        queued_bulk = sk.skus_of_queued_bulk(self.commit.read("bulk_queue"), master, active, listed)
        needed = listed.unionByName(queued_assets).unionByName(queued_bulk)
        needed = self.work.stage(needed, "skus_needed")
        flagged = sk.flag_missing(needed, self.inputs.remote_skus_before)
        skus = sk.resolve_skus(flagged, self.inputs.remote_skus_after)
        return self.work.stage(skus, "skus")

    def sku_feed(self, skus: DataFrame) -> None:
        feed = payloads.sku_payload(skus, self.now, self.options.only_missing_skus)
        # A location's SKUs of a category are bounded: their class has four digits.
        self.send("skus", feed, ("HQLocationID", "UPC") if self.options.nest_skus else ())

    def bulk(self, changes: DataFrame, skus: DataFrame) -> None:
        queue = self.commit.read("bulk_queue")
        to_send = in_active_branches(qt.rollup_quantities(changes), self.inputs.active)
        to_send = self.work.stage(to_send, "quantities")
        held = retry.hold_back_bulk(
            to_send, skus, self.inputs.active, queue, self.run_id, self.now
        )
        held = self.work.stage(held, "bulk_held")
        if self.options.dedupe_queue:
            queue = retry.merge_held(queue, held)
        else:
            queue, _ = retry.append_capture(queue, held)
        ready = sk.resolved(skus, is_bulk=True)
        replayed = retry.replay_quantities(queue, ready)
        sent = self.work.stage(retry.send_list(to_send, replayed, held), "send_list")
        self.keep_queue(
            "bulk_queue", retry.mark_sent(queue, sent, SKU_KEYS, self.run_id, self.now)
        )
        tagged = units.sku_max_tags(ready, self.inputs.remote_items)
        ranges = units.tag_ranges(sent, tagged, self.inputs.sku_master)
        ranges = self.work.stage(ranges, "tag_ranges")
        self.send("units", payloads.unit_payload(units.allocate_tags(ranges), self.now))

    def keep_queue(self, name: str, queue: DataFrame) -> None:
        """What waits stays in the queue, what was sent is set aside."""
        settled = self.work.stage(queue, name)
        self.commit.overwrite(name, retry.unsent(settled))
        self.commit.append(f"{name}_sent", settled.where(F.col("sent_at").isNotNull()))

    def quantity_state(self, changes: DataFrame) -> None:
        """Events sent are remembered; the snapshot becomes the current one."""
        hashed = ch.fingerprint(
            changes.select(*EVENT_KEYS, "qty"), EVENT_KEYS, keep=["qty"]
        ).withColumns({"prev_qty": F.col("qty"), "cached_at": self.now})
        self.commit.append("qty_event_state", hashed)
        snapshot = snapshot_fingerprints(self.inputs.qty_snapshot, self.now)
        state = self.commit.read("qty_snapshot_state")
        changed = exclude(snapshot, state, [*SKU_KEYS, "hash"], unique=True)
        self.commit.change("qty_snapshot_state", changed)

    def assets(self, changes: DataFrame, changed: DataFrame, skus: DataFrame) -> None:
        active = self.inputs.active
        queue = self.commit.read("asset_queue")
        held = retry.hold_back_assets(
            changes, changed, skus, active, queue, self.run_id, self.now
        )
        held = self.work.stage(held, "asset_held")
        queue, _ = retry.append_capture(queue, held)
        remaining, settled = retry.settle_assets(
            changes, changed, queue, skus, active, self.run_id, self.now,
            stage=lambda df: self.work.stage(df, "placed_assets"),
        )
        remaining = self.work.stage(remaining, "assets_to_send")
        self.keep_queue("asset_queue", settled)
        prior = self.commit.read("prior_attributes")
        feed = payloads.asset_payload(
            remaining, changed, active, sk.resolved(skus, is_bulk=False), prior, self.now
        )
        nest_by = payloads.ASSET_DOCUMENT if self.options.nest_assets else ()
        self.send("assets", payloads.with_group(feed) if nest_by else feed, nest_by)
        sent = keep_matching(changed, remaining, ASSET_KEYS, unique=True)
        prints = ch.fingerprint(sent, ASSET_KEYS, exclude_columns=["synced_at"])
        self.commit.change("asset_state", prints.withColumn("cached_at", self.now))
        # After the feed, which still shows the serial numbers of the run before.
        self.commit.change("prior_attributes", payloads.prior_attributes(sent, active))


def run_sync(
    spark: SparkSession,
    inputs: Inputs,
    store: StateStore,
    run_ts: datetime,
    run_id: str,
    out: str,
    options: Options | None = None,
) -> Result:
    return SyncRun(spark, inputs, store, run_ts, run_id, out, options).run()


