"""Sharding: proportional stratified interleaving."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from syncloom.llm.common import (
    Scratch,
    fresh,
    leading,
    named,
    packed,
    running_offsets,
    seeded,
)

#: Rows that a window partition holds about; the order does not depend on it.
ROWS_PER_WINDOW = 20_000


def shard(
    df: DataFrame,
    n_shards: int,
    key: str = "doc_id",
    stratum: str = "source",
    seed: int = 7,
    shard_col: str = "shard",
    slot_col: str = "slot",
    rows_per_window: int = ROWS_PER_WINDOW,
) -> DataFrame:
    """The rows with their shard and their slot in it: row counts differ by one at most.

    Rows of a stratum rank by a seeded digest of their key. Rank r of n becomes the fraction
    (r - u) / n, where u is a number of 0 to 1 drawn for the stratum, so that strata of one row
    spread out. The order of the fractions is cut into shards of equal counts; each is a slice of
    every stratum and so matches the mixture.

    Both ranks come in two steps, so that neither a hot stratum nor the whole order meets in one
    task: counts per digest bucket (per slice of the fractions) give where a bucket starts, and a
    window of about `rows_per_window` rows gives the place in it.

    A null stratum is one stratum, null keys rank by the text of their row. Rows of equal keys are
    put in order by all their columns; equal rows are interchangeable. Equal texts are not held
    together, since the law is equal counts. Columns called like the two new ones are replaced. An
    empty table gives an empty result; with fewer rows than shards some shards stay empty.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "shard")
    own = [c for c in df.columns if c.lower() not in (shard_col.lower(), slot_col.lower())]
    base = df.select(*map(named, own))
    digest, tie, bucket, side, share, piece, at = fresh(
        base, "_digest", "_tie", "_bucket", "_side", "_share", "_piece", "_at"
    )
    strata = scratch.write(
        base.groupBy(named(stratum).alias("_s")).agg(F.count(F.lit(1)).alias("_n")), "strata"
    )
    total, largest = strata.agg(F.sum("_n"), F.max("_n")).first()
    total, largest = total or 0, largest or 0
    digits = max(1, math.ceil(math.log(max(largest / rows_per_window, 1), 16)))
    slices = max(1, math.ceil(total / rows_per_window))

    every = F.xxhash64(*map(named, own))
    rows = base.withColumns({digest: seeded(seed, named(key)), tie: every}).withColumn(
        bucket, leading(named(digest), digits)
    )
    counts = rows.groupBy(named(stratum).alias("_s"), named(bucket).alias("_b")).agg(
        F.count(F.lit(1)).alias("_count")
    )
    starts = running_offsets(counts, ["_s"], "_b", "_count", "_start")
    drawn = (leading(seeded(seed, F.lit("draw"), F.col("a._s")), 8) + 0.5) / F.lit(2.0**32)
    known = scratch.write(
        starts.alias("a")
        .join(strata.alias("b"), F.col("a._s").eqNullSafe(F.col("b._s")))
        .select("a._s", "_b", "_start", "_n", drawn.alias("_u")),
        "starts",
    )
    in_bucket = Window.partitionBy(named(stratum), named(bucket)).orderBy(named(digest), named(tie))
    from_side = named(side)
    placed = rows.withColumn(at, F.row_number().over(in_bucket)).join(
        packed(known, side),
        named(stratum).eqNullSafe(from_side["_s"]) & (named(bucket) == from_side["_b"]),
    )
    fraction = (from_side["_start"] + named(at) - from_side["_u"]) / from_side["_n"]
    ranked = placed.select(
        *map(named, own), named(digest), named(tie), fraction.alias(share)
    ).withColumn(
        piece, F.least(F.floor(named(share) * slices), F.lit(slices - 1)).cast("long")
    )
    # Counted over the narrow columns first; the rows themselves move in the last two exchanges.
    per_piece = ranked.groupBy(named(piece).alias("_p")).agg(F.count(F.lit(1)).alias("_count"))
    offsets = running_offsets(per_piece, [], "_p", "_count", "_base").select("_p", "_base")
    offsets = scratch.write(offsets, "offsets")
    in_piece = Window.partitionBy(named(piece)).orderBy(
        named(share), named(stratum), named(digest), named(tie)
    )
    counted = ranked.withColumn(at, F.row_number().over(in_piece) - 1).join(
        packed(offsets, side), named(piece) == from_side["_p"]
    )
    rows_in_all = max(total, 1)
    position = f"(`{side}`._base + `{at}`)"
    number = f"({position} * {n_shards}L) div {rows_in_all}L"
    first = f"({number} * {rows_in_all}L + {n_shards - 1}L) div {n_shards}L"
    return counted.select(
        *map(named, own),
        F.expr(f"cast({number} as int)").alias(shard_col),
        F.expr(f"{position} - {first}").alias(slot_col),
    )
