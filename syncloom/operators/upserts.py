"""State tables after a change: pure functions, since plain files know no update in place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def upsert(state: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state with the changed rows in place of the old ones and the new rows added.

    Both sides hold each key once.
    """
    rows = changes.select(*state.columns)
    return state.join(changes.select(*keys), list(keys), "left_anti").unionByName(rows)


def advance_watermark(
    control: DataFrame,
    run_ts: Column,
    events: DataFrame | None = None,
    ts_col: str = "synced_at",
    source: str = "source",
    reached: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The control table after a run: both starts at the run's own time, the end at it too.

    With events, the end of a source is the latest time it delivered instead; ``reached`` gives
    these times where a run has noted them.
    """
    end = run_ts
    table = control
    if events is not None:
        latest = events.groupBy(F.col(source).alias("source")).agg(
            F.max(ts_col).alias("_reached")
        )
        table = control.join(latest, "source", "left")
        end = F.coalesce(F.col("_reached"), run_ts)
    for name, time in (reached or {}).items():
        end = F.when(F.col("source") == name, time).otherwise(end)
    return table.select(
        "source", run_ts.alias("start_ts"), run_ts.alias("prev_start_ts"), end.alias("end_ts")
    )


def merge_aggregates(
    state: DataFrame, partial: DataFrame, keys: Sequence[str], how: Mapping[str, str]
) -> DataFrame:
    """The rows of kept aggregates that new rows change, to be upserted into the state.

    ``partial`` has the aggregates of the new rows alone, ``how`` says for each column whether it is a
    `max`, a `min` or a `sum`: those that can go on from what is kept. Of the state only the keys of
    the new rows are looked at, and both sides hold a key once.
    """
    unknown = set(how.values()) - {"max", "min", "sum"}
    if unknown:
        raise ValueError(f"cannot go on from a kept {', '.join(sorted(unknown))}")
    kept = state.join(partial.select(*keys), list(keys), "left_semi").select(*keys, *how)
    joined = partial.select(*keys, *how).unionByName(kept)
    return joined.groupBy(*keys).agg(
        *[getattr(F, kind)(c).cast(state.schema[c].dataType).alias(c) for c, kind in how.items()]
    )
