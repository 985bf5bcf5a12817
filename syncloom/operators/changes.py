"""Fingerprints, snapshot diffs and the asset change feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from syncloom.functions.hashing import row_hash
from syncloom.operators.joins import enrich, exclude, in_active_branches, keep_matching
from syncloom.schemas import ASSET_KEYS, DEL, NEW, UPD


def fingerprint(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Key columns, the columns to keep, and the hash over all or the given columns."""
    hashed = [c for c in (columns or df.columns) if c not in exclude_columns]
    return df.select(*keys, *keep, row_hash(df, hashed).alias("hash"))


def snapshot_diff(
    current: DataFrame,
    state: DataFrame,
    keys: Sequence[str],
    include_deletes: bool = False,
) -> DataFrame:
    """Keys that are new, or whose hash differs from the state; on demand also deleted keys.

    Both sides hold each key once.
    """
    old = state.select(*keys, F.col("hash").alias("_old"))
    if include_deletes:
        both = current.select(*keys, F.col("hash").alias("_new")).join(old, list(keys), "full")
        change = (
            F.when(F.col("_old").isNull(), NEW)
            .when(F.col("_new").isNull(), DEL)
            .when(F.col("_new") != F.col("_old"), UPD)
        )
    else:
        both = enrich(current.select(*keys, F.col("hash").alias("_new")), old, keys)
        change = F.when(F.col("_old").isNull(), NEW).when(F.col("_new") != F.col("_old"), UPD)
    typed = both.select(*keys, change.alias("change_type"))
    return typed.where(F.col("change_type").isNotNull())


def active_change_feed(diff: DataFrame, assets: DataFrame, active: DataFrame) -> DataFrame:
    """Changes of assets whose current branch is active."""
    located = in_active_branches(
        assets.select(*ASSET_KEYS, "current_branch"), active, branch="current_branch"
    )
    return keep_matching(diff, located, ASSET_KEYS, unique=True)


def active_changes(
    current: DataFrame, state: DataFrame, active: DataFrame
) -> DataFrame:
    """Changes of assets whose current branch is active, found by comparing those assets alone.

    ``current`` holds each asset once, with its hash and ``current_branch``; the result is that of
    ``active_change_feed`` on ``snapshot_diff``, without the join that brings the branch back.
    """
    return snapshot_diff(
        in_active_branches(current, active, branch="current_branch"), state, ASSET_KEYS
    )


def replay_into_changes(changes: DataFrame, queue: DataFrame) -> DataFrame:
    """Add the assets that wait in the queue and are not among the changes, as updates."""
    waiting = queue.where(F.col("sent_at").isNull()).select(*ASSET_KEYS).distinct()
    added = exclude(waiting, changes, ASSET_KEYS, unique=True).withColumn("change_type", F.lit(UPD))
    return changes.select(*ASSET_KEYS, "change_type").unionByName(added)
