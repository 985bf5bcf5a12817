"""State rebuilt from the whole source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from syncloom.operators.changes import fingerprint
from syncloom.operators.payloads import prior_attributes
from syncloom.operators.quantity import fill_from_snapshot, last_quantities, quantity_delta
from syncloom.operators.skew import latest
from syncloom.schemas import ASSET_KEYS, EVENT_KEYS, SKU_KEYS
from syncloom.state.store import StateStore


def asset_fingerprints(assets: DataFrame, cached_at: Column) -> DataFrame:
    """Hash per asset over all columns but the sync time, which changes without them."""
    hashed = fingerprint(
        assets, ASSET_KEYS, exclude_columns=["synced_at"], keep=["synced_at"]
    )
    current = latest(hashed, ASSET_KEYS, ["synced_at"]).drop("synced_at")
    return current.withColumn("cached_at", cached_at)


def event_fingerprints(events: DataFrame, snapshot: DataFrame, cached_at: Column) -> DataFrame:
    """Events with their hash and the quantity before each, from the log or else the snapshot."""
    hashed = fingerprint(events, EVENT_KEYS, keep=["qty"])
    deltas = fill_from_snapshot(quantity_delta(hashed), snapshot)
    return deltas.withColumn("cached_at", cached_at)


def snapshot_fingerprints(snapshot: DataFrame, cached_at: Column) -> DataFrame:
    return fingerprint(snapshot, SKU_KEYS, keep=["qty"]).withColumn("cached_at", cached_at)


def rebuild(
    store: StateStore,
    run_id: str,
    run_ts: Column,
    assets: DataFrame | None = None,
    active: DataFrame | None = None,
    events: DataFrame | None = None,
    snapshot: DataFrame | None = None,
) -> None:
    """Replace the asset state, the quantity state, or both, by what the sources hold."""
    commit = store.begin(run_id)
    if commit.done:
        return
    if assets is not None:
        commit.overwrite("asset_state", asset_fingerprints(assets, run_ts))
        commit.overwrite("prior_attributes", prior_attributes(assets, active))
    if events is not None:
        commit.overwrite("qty_event_state", event_fingerprints(events, snapshot, run_ts))
        commit.overwrite("last_qty", last_quantities(events))
        commit.overwrite("qty_snapshot_state", snapshot_fingerprints(snapshot, run_ts))
    commit.publish()


def expire_events(store: StateStore, run_id: str, before: Column) -> None:
    """Forget events sent before a time, which the source no longer holds either.

    A step of its own, as it rewrites the event state.
    """
    commit = store.begin(run_id)
    if commit.done:
        return
    state = commit.read("qty_event_state")
    commit.overwrite("qty_event_state", state.where(F.col("synced_at") >= before))
    commit.publish()
