"""The retry queues: hold back what does not resolve, replay it once it does, settle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from syncloom.functions.keys import product_id, upc
from syncloom.operators.joins import exclude, in_active_branches, keep_matching
from syncloom.operators.skus import resolved, unresolved
from syncloom.operators.upserts import merge_aggregates
from syncloom.schemas import ASSET_KEYS, REASON_SKU_MISSING, SKU_KEYS, STATE, conform


def unsent(queue: DataFrame) -> DataFrame:
    return queue.where(F.col("sent_at").isNull())


def _entries(df: DataFrame, table: str, run_id: str, run_ts: Column) -> DataFrame:
    filled = df.withColumns(
        {
            "run_id": F.lit(run_id),
            "reason": F.lit(REASON_SKU_MISSING),
            "detected_at": run_ts,
            "sent_at": F.lit(None),
        }
    )
    return conform(filled, STATE[table])


def append_capture(queue: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The queue with the rows added, and the rows that were added."""
    return queue.unionByName(rows), rows


def hold_back_bulk(
    to_send: DataFrame,
    skus: DataFrame,
    active: DataFrame,
    queue: DataFrame,
    run_id: str,
    run_ts: Column,
) -> DataFrame:
    """Queue entries for quantities whose SKU has no remote id yet.

    Quantities are what came on top, so a SKU that already waits gets an entry for the addition.
    """
    held = unresolved(in_active_branches(to_send, active), skus.where("is_bulk"))
    return _entries(held, "bulk_queue", run_id, run_ts)


def merge_held(queue: DataFrame, held: DataFrame) -> DataFrame:
    """The queue with the held rows, where each of their SKUs and statuses waits as one entry.

    That entry has the sum of what waited and what was added, and the run and time of the oldest.
    """
    keys = [*SKU_KEYS, "status"]
    touched = held.select(*keys).distinct()
    waiting = keep_matching(unsent(queue), touched, keys, unique=True).unionByName(held)
    oldest = F.min(F.struct("detected_at", "run_id", "reason"))
    merged = waiting.groupBy(*keys).agg(F.sum("qty").alias("qty"), oldest.alias("_oldest"))
    entries = merged.withColumn("sent_at", F.lit(None)).select("*", "_oldest.*").drop("_oldest")
    others = exclude(unsent(queue), touched, keys, unique=True)
    sent = queue.where(F.col("sent_at").isNotNull())
    return others.unionByName(sent).unionByName(conform(entries, STATE["bulk_queue"]))


def waiting_sums_after(state: DataFrame, queued: DataFrame, sent: DataFrame) -> DataFrame:
    """Kept sums of waiting quantities that queue rows change, by SKU and status: rows to upsert.

    Rows just queued count for, rows just sent count against; `entries` is how many wait. A SKU with
    no entries left keeps a row of zeros.
    """
    signed = queued.select(*SKU_KEYS, "status", "qty", F.lit(1).cast("long").alias("entries")).unionByName(
        sent.select(*SKU_KEYS, "status", (-F.col("qty")).alias("qty"), F.lit(-1).cast("long").alias("entries"))
    )
    keys = [*SKU_KEYS, "status"]
    partial = signed.groupBy(*keys).agg(F.sum("qty").alias("qty"), F.sum("entries").alias("entries"))
    return merge_aggregates(state, partial, keys, {"qty": "sum", "entries": "sum"})


def replay_quantities(queue: DataFrame, skus: DataFrame) -> DataFrame:
    """Sum of the waiting quantities per SKU and status, for the SKUs given."""
    # Summed first, so that a SKU with very many waiting rows shrinks before the shuffle.
    summed = unsent(queue).groupBy(*SKU_KEYS, "status").agg(F.sum("qty").alias("qty"))
    return keep_matching(summed, skus, SKU_KEYS, unique=True)


def send_list(to_send: DataFrame, replayed: DataFrame, held: DataFrame) -> DataFrame:
    """What goes out: new and replayed quantities without the SKUs just held back."""
    columns = [*SKU_KEYS, "qty", "status"]
    ranked = to_send.select(*columns, F.lit(0).alias("source_rank")).unionByName(
        replayed.select(*columns, F.lit(1).alias("source_rank"))
    )
    return exclude(ranked, held, SKU_KEYS, unique=True)


def mark_sent(
    queue: DataFrame, sent: DataFrame, keys: Sequence[str], run_id: str, run_ts: Column
) -> DataFrame:
    """The queue with the waiting rows of the sent keys marked as sent by this run."""
    done = sent.select(*keys).distinct().withColumn("_done", F.lit(True))
    joined = queue.join(done, list(keys), "left")
    now = F.col("sent_at").isNull() & F.coalesce(F.col("_done"), F.lit(False))
    return _sent_now(joined, now, run_id, run_ts).select(*queue.columns)


def _sent_now(queue: DataFrame, now: Column, run_id: str, run_ts: Column) -> DataFrame:
    return queue.withColumns(
        {
            "run_id": F.when(now, F.lit(run_id)).otherwise(F.col("run_id")),
            "sent_at": F.when(now, run_ts).otherwise(F.col("sent_at")),
        }
    )


def asset_positions(changes: DataFrame, assets: DataFrame, active: DataFrame) -> DataFrame:
    """Changed assets with their SKU keys, where their current branch is active."""
    located = assets.withColumn("branch", F.col("current_branch"))
    changed = keep_matching(located, changes, ASSET_KEYS, unique=True)
    return in_active_branches(changed, active).select("asset_id", *SKU_KEYS)


ENTRY_KEYS = [*ASSET_KEYS, "branch", "category", "class_code"]


def _padded(positions: DataFrame) -> DataFrame:
    """SKU keys as the asset queue writes them."""
    return positions.withColumns(
        {"category": upc(F.col("category")), "class_code": product_id(F.col("class_code"))}
    )


def hold_back_assets(
    changes: DataFrame,
    assets: DataFrame,
    skus: DataFrame,
    active: DataFrame,
    queue: DataFrame,
    run_id: str,
    run_ts: Column,
) -> DataFrame:
    """Queue entries for changed assets whose SKU has no remote id.

    An asset that waits with its current branch and SKU is not queued again; one that has moved
    since gets an entry for where it is now.
    """
    missing = unresolved(asset_positions(changes, assets, active), skus.where(~F.col("is_bulk")))
    fresh = exclude(_padded(missing), unsent(queue), ENTRY_KEYS)
    return _entries(fresh, "asset_queue", run_id, run_ts)


def settle_assets(
    changes: DataFrame,
    assets: DataFrame,
    queue: DataFrame,
    skus: DataFrame,
    active: DataFrame,
    run_id: str,
    run_ts: Column,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> tuple[DataFrame, DataFrame]:
    """The changes that can be sent, and the queue after them.

    ``queue`` already has the held rows. What counts is where an asset is now: it is sent when its
    current branch is active and its current SKU, not a bulk one, has a remote id, just as the
    payload takes it. All its entries are then marked as sent. Of an asset that still waits, the
    entries for where it no longer is are closed, and the one for where it is stays. ``stage`` may
    write where the assets are and whether they can be sent, which is read three times.
    """
    ids = resolved(skus, is_bulk=False).select(*SKU_KEYS, F.lit(True).alias("_ready"))
    placed = asset_positions(changes, assets, active).join(ids, SKU_KEYS, "left")
    placed = stage(placed.withColumn("_ready", F.coalesce("_ready", F.lit(False))))
    ready = placed.where("_ready").select(*ASSET_KEYS)
    # Each asset and each place once, so that no queue row is multiplied.
    located = placed.groupBy(*ASSET_KEYS).agg(F.max("_ready").alias("_ready"))
    here = _padded(placed.select(*ENTRY_KEYS)).distinct().withColumn("_here", F.lit(True))
    joined = queue.join(located, ASSET_KEYS, "left").join(here, ENTRY_KEYS, "left")
    whole = F.concat("branch", "category", "class_code").isNotNull()
    now = F.col("sent_at").isNull() & whole & (F.col("_ready") | F.col("_here").isNull())
    done = F.col("_ready").isNotNull() & now
    return keep_matching(changes, ready, ASSET_KEYS, unique=True), _sent_now(
        joined, done, run_id, run_ts
    ).select(*queue.columns)
