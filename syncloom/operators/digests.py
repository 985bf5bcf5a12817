"""Digests of a snapshot in two levels, so that a diff touches only what differs.

Keys fall into buckets by their hash, buckets into groups. A bucket's digest combines the hashes of
its rows in any order, a group's those of its buckets. Two snapshots with equal digests of a group
hold the same rows there, but for a collision of 128 bits and the count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from syncloom.operators.changes import snapshot_diff

#: Buckets of a snapshot, and buckets of a group. Digests are at most BUCKETS rows.
BUCKETS, GROUP = 4096, 64

BUCKET = "bucket"


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The rows with the number of their bucket, to be written partitioned by it."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _combined(parts: Sequence[Column]) -> list[Column]:
    return [F.bit_xor(p).alias(n) for p, n in zip(parts, ("left", "right"), strict=True)]


def bucket_digests(prints: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(bucket, n, left, right) of rows with keys, hash and bucket; summed before any shuffle."""
    row = [*keys, "hash"]
    halves = [F.xxhash64(F.lit(seed), *row) for seed in (1, 2)]
    return prints.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), *_combined(halves))


def group_digests(digests: DataFrame, group: int = GROUP) -> DataFrame:
    """(part, n, left, right) of groups of buckets."""
    row = [BUCKET, "n", "left", "right"]
    halves = [F.xxhash64(F.lit(seed), *row) for seed in (3, 4)]
    part = F.floor(F.col(BUCKET) / group).cast("int").alias("part")
    return digests.groupBy(part).agg(F.sum("n").alias("n"), *_combined(halves))


def _differing(current: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """Keys whose digests differ, or that one side lacks."""
    old = state.select(key, F.struct("n", "left", "right").alias("_old"))
    new = current.select(key, F.struct("n", "left", "right").alias("_new"))
    return new.join(old, key, "full").where(~F.col("_new").eqNullSafe(F.col("_old"))).select(key)


def differing_buckets(current: DataFrame, state: DataFrame, group: int = GROUP) -> list[int]:
    """Numbers of the buckets that differ: groups first, then the buckets of those that do.

    At most as many numbers as there are buckets.
    """
    groups = _differing(group_digests(current, group), group_digests(state, group), "part")
    part = F.floor(F.col(BUCKET) / group).cast("int")
    inside = lambda d: d.withColumn("part", part).join(groups, "part", "left_semi")
    found = _differing(inside(current), inside(state), BUCKET)
    return sorted(r[0] for r in found.collect())


def write_snapshot(prints: DataFrame, keys: Sequence[str], root: str, buckets: int = BUCKETS) -> None:
    """A snapshot of keys and hashes, written by bucket, and its digests beside it."""
    rows = with_bucket(prints, keys, buckets)
    # Rows of a bucket come together first, so that a bucket is a file or a few.
    rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{root}/rows")
    written = _rows(prints, root)
    bucket_digests(written, keys).coalesce(1).write.parquet(f"{root}/digests")


def _rows(like: DataFrame, root: str) -> DataFrame:
    schema = f"{like.schema.toDDL()}, {BUCKET} int"
    return like.sparkSession.read.schema(schema).parquet(f"{root}/rows")


def read_snapshot(like: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """The rows and the digests of a written snapshot, whose columns are those of `like`."""
    digests = f"{BUCKET} int, n long, left long, right long"
    return _rows(like, root), like.sparkSession.read.schema(digests).parquet(f"{root}/digests")


def snapshot_diff_buckets(
    current: DataFrame,
    root: str,
    keys: Sequence[str],
    include_deletes: bool = False,
    buckets: int = BUCKETS,
    group: int = GROUP,
) -> DataFrame:
    """The same as `snapshot_diff` against the snapshot written at `root`.

    The current rows are read for their digests, which shuffles a row per bucket and task. Then
    only rows of buckets that differ are read of the snapshot, whose other partitions are not
    listed, and only those rows of either side are shuffled.
    """
    rows = with_bucket(current.select(*keys, "hash"), keys, buckets)
    state, digests = read_snapshot(rows.drop(BUCKET), root)
    differing = differing_buckets(bucket_digests(rows, keys), digests, group)
    chosen = F.col(BUCKET).isin(differing) if differing else F.lit(False)
    return snapshot_diff(rows.where(chosen), state.where(chosen), keys, include_deletes)
