"""Quantity deltas of an event log, their snapshot fallback, and the quantity change feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from syncloom.functions.keys import increase
from syncloom.operators.joins import exclude, in_active_branches, keep_matching
from syncloom.operators.skew import HOT_ROWS, SLICE_ROWS, latest, previous_value
from syncloom.schemas import EVENT_KEYS, MASTER_KEYS, NEW, SKU_KEYS, STATUS_RECEIVE, UPD

# What comes before an event: number, then time.
ORDER = ("seq", "synced_at")


def touched_history(history: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The whole history of the keys that were touched, and no other."""
    return keep_matching(history, touched, list(keys))


def quantity_delta(
    events: DataFrame,
    keys: Sequence[str] = tuple(SKU_KEYS),
    order: Sequence[str] = ("seq", "synced_at"),
    qty: str = "qty",
    hot_rows: int = HOT_ROWS,
    span: int = SLICE_ROWS,
    first: str | None = None,
) -> DataFrame:
    """Add the quantity of the event before as ``prev_qty``; 0 for the first event of a key.

    ``first`` names a column to add that marks these first events.
    """
    return previous_value(
        events, list(keys), list(order), qty, 0, "prev_qty", hot_rows, span, first
    )


def last_quantities(
    events: DataFrame, keys: Sequence[str] = tuple(SKU_KEYS), order: Sequence[str] = ORDER
) -> DataFrame:
    """The last event of each key: its order columns and its quantity."""
    return latest(events.select(*keys, *order, "qty"), list(keys), list(order))


def late_keys(
    due: DataFrame,
    last: DataFrame,
    keys: Sequence[str] = tuple(SKU_KEYS),
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Keys with an event that comes before one that is known already."""
    known = last.select(*keys, F.struct(*order).alias("_known"))
    late = due.join(known, list(keys)).where(F.struct(*order) < F.col("_known"))
    return late.select(*keys).distinct()


def delta_since(
    due: DataFrame,
    last: DataFrame,
    keys: Sequence[str] = tuple(SKU_KEYS),
    order: Sequence[str] = ORDER,
    first: str | None = None,
) -> DataFrame:
    """Add the quantity before to new events, from the last event of their key before them.

    None of the new events may come before that last one.
    """
    mark = "_new"
    before = keep_matching(last, due, list(keys)).withColumn(mark, F.lit(False))
    rows = due.withColumn(mark, F.lit(True)).unionByName(before, allowMissingColumns=True)
    return quantity_delta(rows, keys, order, first=first).where(mark).drop(mark)


def fill_from_snapshot(
    deltas: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str] = tuple(SKU_KEYS),
    first: str | None = None,
) -> DataFrame:
    """Where the quantity before is 0, take it from the snapshot if that has the key.

    A quantity that truly was 0 is replaced too, unless ``first`` names the column
    that marks the events no other comes before: then only these are filled.
    """
    known = snapshot.select(*keys, F.col("qty").alias("_snapshot"), F.lit(True).alias("_known"))
    joined = deltas.join(known, list(keys), "left")
    use = (F.col(first) if first else F.col("prev_qty") == 0) & F.col("_known")
    filled = F.when(use, F.col("_snapshot")).otherwise(F.col("prev_qty"))
    return joined.withColumn("prev_qty", filled).drop("_snapshot", "_known")


def risen_quantities(
    deltas: DataFrame, sku_master: DataFrame, active: DataFrame, net: bool = False
) -> DataFrame:
    """Rises of bulk quantities in active branches; with ``net`` falls too, as negative amounts."""
    if net:
        amount = (F.col("qty") - F.col("prev_qty")).cast(deltas.schema["qty"].dataType)
        risen = deltas.withColumn("qty_to_send", amount).where(F.col("qty_to_send") != 0)
    else:
        qty = increase(F.col("qty"), F.col("prev_qty"))
        risen = deltas.withColumn("qty_to_send", qty).where(F.col("qty_to_send") > 0)
    bulk = sku_master.where(F.col("bulk") == "Y")
    wanted = in_active_branches(keep_matching(risen, bulk, MASTER_KEYS, unique=True), active)
    return wanted.select(*EVENT_KEYS, "qty", "qty_to_send").distinct()


def mark_known_events(risen: DataFrame, event_state: DataFrame) -> DataFrame:
    """Type each change: an event that the state has, under any sync time, is an update."""
    event_id = [c for c in EVENT_KEYS if c != "synced_at"]
    # The state shrinks to the changed events, each once, before it meets them.
    seen = keep_matching(event_state.select(*event_id), risen, event_id).distinct()
    flagged = risen.join(seen.withColumn("_seen", F.lit(True)), event_id, "left")
    change = F.when(F.col("_seen"), UPD).otherwise(NEW)
    return flagged.select(*risen.columns, change.alias("change_type"))


def after_last(
    due: DataFrame,
    last: DataFrame,
    keys: Sequence[str] = tuple(SKU_KEYS),
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """New events without those that are the last known ones of their keys themselves."""
    return exclude(due, last, [*keys, *order], unique=True)


def unseen_events(events: DataFrame, event_state: DataFrame, start=None, end=None) -> DataFrame:
    """Events that an earlier, overlapping interval has not already sent, or taken in.

    An event's sync time is part of its key: with the interval of the events, only
    the state of that interval is read.
    """
    if start is not None:
        event_state = event_state.where(F.col("synced_at").between(start, end))
    return exclude(events, event_state, EVENT_KEYS, unique=True)


def rollup_quantities(changes: DataFrame, net: bool = False) -> DataFrame:
    """Sum of the rises per SKU and branch; with ``net`` of rises and falls alike."""
    amount = F.col("qty") - F.col("prev_qty") if net else F.col("qty_to_send")
    return (
        changes.groupBy(*SKU_KEYS)
        .agg(F.sum(amount).alias("qty"))
        .where(F.col("qty") > 0)
        .withColumn("status", F.lit(STATUS_RECEIVE))
    )
