"""Scans of source tables: by interval, per source, and forced for one branch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from syncloom.functions.keys import BRANCH_WIDTH, pad
from syncloom.operators.joins import exclude, in_active_branches


#: The column that a source partitioned by the day of its sync time has.
SYNC_DAY = "sync_day"


def interval_scan(df: DataFrame, ts_col: str, start, end, day: str | None = None) -> DataFrame:
    """Rows whose time lies in the interval, both ends included; the scan prunes by it.

    Where the table has the column ``day``, only partitions of the interval's days are listed.
    """
    if day and day in df.columns:
        first, last = (F.to_date(t if isinstance(t, Column) else F.lit(t)) for t in (start, end))
        df = df.where(F.col(day).between(first, last))
    return df.where(F.col(ts_col).between(start, end))


def by_day(df: DataFrame, ts_col: str, day: str = SYNC_DAY) -> DataFrame:
    """The table with the day of its time, to be written partitioned by it."""
    return df.withColumn(day, F.to_date(ts_col))


def interval_bounds(control: DataFrame, run_ts: Column) -> DataFrame:
    """The interval each source is due for.

    A source that never ran starts at the run's own time, any other where its run
    before started. A start that lies after the end fails the job.
    """
    start = F.when(F.col("start_ts").isNull(), run_ts).otherwise(F.col("prev_start_ts"))
    problem = F.concat(F.lit("interval starts after it ends: source "), F.col("source"))
    checked = F.when(start > run_ts, F.raise_error(problem).cast("timestamp_ntz"))
    return control.select(
        "source", checked.otherwise(start).alias("start"), run_ts.alias("end")
    )


def scan_by_source(
    events: DataFrame, bounds: DataFrame, ts_col: str = "synced_at", source: str = "source"
) -> DataFrame:
    """Rows within the interval of their own source.

    The widest interval of all sources goes into the scan, where it prunes files
    and row groups; the join then applies each source's own.
    """
    widest = F.col(ts_col).between(
        bounds.agg(F.min("start")).scalar(), bounds.agg(F.max("end")).scalar()
    )
    own = bounds.select(
        F.col("source").alias(source), F.col("start").alias("_start"), F.col("end").alias("_end")
    )
    return (
        events.where(widest)
        .join(own, source)
        .where(F.col(ts_col).between(F.col("_start"), F.col("_end")))
        .drop("_start", "_end")
    )


def scan_by_source_partitioned(
    events: DataFrame,
    bounds: DataFrame,
    ts_col: str = "synced_at",
    source: str = "source",
    day: str = SYNC_DAY,
) -> DataFrame:
    """Rows within the interval of their own source, of a table partitioned by day.

    The bounds, a written table, become one row per source and day, so the join names the days that
    any source is due for, and the scan reads these partitions alone: the planner prunes them when
    the job runs, where it sees that the days are few enough to be broadcast.
    """
    start, end = F.col("start"), F.col("end")
    days = bounds.where(start <= end).select(
        F.col("source").alias(source),
        start.alias("_start"),
        end.alias("_end"),
        F.explode(F.sequence(F.to_date(start), F.to_date(end))).alias(day),
    )
    return (
        events.join(days, [source, day])
        .where(F.col(ts_col).between(F.col("_start"), F.col("_end")))
        .drop("_start", "_end")
    )


def forced_scan(
    df: DataFrame,
    active: DataFrame,
    branch: int | str,
    already: DataFrame,
    keys: Sequence[str],
    branch_columns: Sequence[str] = ("home_branch", "current_branch"),
) -> DataFrame:
    """All rows of one active branch, by any of its branch columns, not already selected."""
    code = pad(F.lit(str(branch)), BRANCH_WIDTH)
    wanted = F.lit(False)
    for column in branch_columns:
        wanted = wanted | (F.col(column) == code)
    # The branch is one value: whether it is active is one row, not a join per column.
    chosen = df.where(wanted).withColumn("_branch", code)
    rows = in_active_branches(chosen, active, branch="_branch").drop("_branch")
    return exclude(rows, already, list(keys)).distinct()
