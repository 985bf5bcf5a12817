"""Ordered per-key computations that hold when one key owns a large share of all rows.

A window over a key puts all rows of the key into one task. Here the rows of hot keys are dealt
into slices of key and order that hold about equal numbers of rows, however the order numbers are
spread; each slice of a key is a window partition of its own, and one carry row per slice brings in
what the slices before it amount to.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from syncloom.session import Workspace

# A key with fewer rows than this never needs splitting.
HOT_ROWS = 1_000_000
# The written list of hot keys is broadcast when it has at most so many rows; beyond that the
# planner joins it by its size.
BROADCAST_KEYS = 100_000
# Rows of a slice.
SLICE_ROWS = 1 << 20
# Rows of a task that cuts slices, at least: however small slices are, tasks, their files and the
# sample that the driver takes its borders from grow with the rows alone.
RANGE_ROWS = 1 << 18

_SLICE = "_slice"
_REAL = "_real"
_HOT = "_hot"
_CARRY = "_carry"


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, a NULL in them included, and their rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_HOT))
    return counts.where(F.col(_HOT) > hot_rows)


def _of_keys(df: DataFrame, hot: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """The rows whose key is hot, or is not; NULL equals NULL."""
    side = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]
    return df.join(side, same, how).select(*df.columns)


def _add_previous(
    rows: DataFrame, window, value: str, default: Column, name: str, first: str | None, carried: bool
) -> DataFrame:
    """The value before; where none comes before, the default. Carry rows lead and go."""
    # The value before may be NULL; the flag before is NULL only where no row comes before.
    before = {name: F.lag(value, 1).over(window), _CARRY: F.lag(_REAL, 1).over(window)}
    alone = F.col(_CARRY).isNull()
    added = {name: F.when(alone, default).otherwise(F.col(name))}
    if first:
        added[first] = alone
    found = rows.withColumns(before)
    found = found.where(_REAL) if carried else found
    return found.withColumns(added).drop(_REAL, _CARRY)


def equal_slices(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, slice_rows: int
) -> DataFrame:
    """The rows, written, with the number of their slice.

    Ranges of key and order come from quantiles that Spark samples from the rows. Each is sorted and
    cut after every ``slice_rows`` rows, so slices hold as many wherever the order numbers lie; only a
    range's last one may hold fewer. Slices of a key ascend with the order.
    """
    n = max(1, math.ceil(rows / max(slice_rows, RANGE_ROWS)))
    # An explicit number keeps adaptive execution from putting ranges together again.
    ranged = df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
    # Numbers of rows, gapless within a range; those of different ranges lie 2^33 apart.
    cut = F.expr(f"monotonically_increasing_id() div {slice_rows}")
    return Workspace(df.sparkSession, "slices").stage(ranged.withColumn(_SLICE, cut), "rows")


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    default: int,
    name: str,
    hot_rows: int = HOT_ROWS,
    span: int = SLICE_ROWS,
    first: str | None = None,
) -> DataFrame:
    """The value of the row before, per key; the default only where no row comes before.

    Order columns are unique per key together, or nearly so. NULLs in a key are equal, and such a
    key is split like any other. Keys of more than ``hot_rows`` rows are cut into slices of about
    ``span`` rows. ``first`` names a column to add that is true for the rows that none comes before.
    """
    start = F.lit(default).cast(df.schema[value].dataType)
    # Written, so that its size is known.
    hot = Workspace(df.sparkSession, "hot").stage(hot_keys(df, keys, hot_rows), "keys")
    number, rows = hot.agg(F.count(F.lit(1)), F.sum(_HOT)).first()
    plain = Window.partitionBy(*keys).orderBy(*order)
    if not number:
        rows = df.repartition(*keys).withColumn(_REAL, F.lit(True))
        return _add_previous(rows, plain, value, start, name, first, False)
    if number <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    cold = _of_keys(df, hot, keys, "left_anti").withColumn(_REAL, F.lit(True))
    sliced = equal_slices(_of_keys(df, hot, keys, "left_semi"), keys, order, rows, span)
    last = F.max_by(F.struct(F.col(value)), F.struct(*order)).alias("_last")
    ends = sliced.groupBy(*keys, _SLICE).agg(last)
    # One row per slice of a hot key: its rows by ``span``.
    following = F.lead(_SLICE).over(Window.partitionBy(*keys).orderBy(_SLICE))
    carries = (
        ends.withColumn(_SLICE, following)
        .where(F.col(_SLICE).isNotNull())
        .select(*keys, _SLICE, F.col(f"_last.`{value}`").alias(value), F.lit(False).alias(_REAL))
    )
    led = sliced.withColumn(_REAL, F.lit(True)).unionByName(carries, allowMissingColumns=True)
    # Keep the slices apart even where the rows already lie together by key.
    led = led.repartition(*keys, _SLICE)
    window = Window.partitionBy(*keys, _SLICE).orderBy(_REAL, *order)
    hot_rows_ = _add_previous(led, window, value, start, name, first, True).drop(_SLICE)
    return _add_previous(cold, plain, value, start, name, first, False).unionByName(hot_rows_)


def last_known(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    hot_rows: int = HOT_ROWS,
    span: int = SLICE_ROWS,
) -> DataFrame:
    """The last value that is not NULL of the rows before, per key; NULL where there is none.

    Hot keys are cut into slices as in ``previous_value``; a slice's carry is the last value that the
    slices before it know.
    """
    hot = Workspace(df.sparkSession, "hot").stage(hot_keys(df, keys, hot_rows), "keys")
    number, rows = hot.agg(F.count(F.lit(1)), F.sum(_HOT)).first()
    before = Window.unboundedPreceding
    plain = Window.partitionBy(*keys).orderBy(*order).rowsBetween(before, -1)
    if not number:
        return df.withColumn(name, F.last(value, ignorenulls=True).over(plain))
    if number <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    cold = _of_keys(df, hot, keys, "left_anti")
    sliced = equal_slices(_of_keys(df, hot, keys, "left_semi"), keys, order, rows, span)
    # The last value of each slice; one row per slice of a hot key.
    known = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order)))
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(before, -1)
    carries = (
        sliced.groupBy(*keys, _SLICE)
        .agg(known.alias(_CARRY))
        .withColumn(_CARRY, F.last(_CARRY, ignorenulls=True).over(earlier))
    )
    side = carries.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col(_SLICE).alias("_c"), _CARRY)
    same = [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys]
    joined = sliced.join(side, [*same, F.col(_SLICE) == F.col("_c")]).repartition(*keys, _SLICE)
    inside = Window.partitionBy(*keys, _SLICE).orderBy(*order).rowsBetween(before, -1)
    found = F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col(_CARRY))
    sliced_found = joined.withColumn(name, found).select(*df.columns, name)
    return cold.withColumn(name, F.last(value, ignorenulls=True).over(plain)).unionByName(sliced_found)


def latest(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per key, the latest; an aggregate, so copies shrink before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*by, *[c for c in rest if c not in by]))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(
        *keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest]
    ).select(*df.columns)
