"""Quantities as single units, and tag numbers that go on from the highest one in use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from syncloom.functions.keys import BRANCH_WIDTH, has_tag_number, pad, tag_number
from syncloom.operators.upserts import merge_aggregates
from syncloom.schemas import MASTER_KEYS, SKU_KEYS

# A row of more units than this is first cut into rows of this many.
CHUNK_UNITS = 10_000


def expand_units(
    df: DataFrame, qty: str = "qty", name: str = "unit_no", chunk: int = CHUNK_UNITS
) -> DataFrame:
    """One row per whole unit, numbered from 1; rows with less than one unit yield none.

    Ordinary rows expand where they lie. A row with a huge quantity becomes
    chunks that are spread over all tasks and expanded there, so no array and no
    task holds more than its chunk.
    """
    units = F.floor(F.col(qty)).cast("long")
    ordinary = df.where((F.col(qty) >= 1) & (F.col(qty) < chunk + 1))
    single = ordinary.withColumn(name, F.explode(F.sequence(F.lit(1).cast("long"), units)))
    huge = df.where(F.col(qty) >= chunk + 1).withColumn(
        "_chunk",
        F.explode(F.expr(f"sequence(0L, (floor(`{qty}`) - 1) div {chunk})")),
    )
    first = F.col("_chunk") * chunk + 1
    last = F.least(F.col("_chunk") * chunk + chunk, units)
    # A fixed number of partitions: chunks are tiny before they expand, and would be
    # coalesced into few tasks by their size.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = (
        huge.repartition(tasks, *df.columns, "_chunk")
        .withColumn(name, F.explode(F.sequence(first, last)))
        .drop("_chunk")
    )
    return single.unionByName(split)


def max_tag(items: DataFrame, keys: Sequence[str], asset_id: str = "asset_id") -> DataFrame:
    """The highest tag number in use per key, among ids that have one."""
    tagged = items.where(has_tag_number(F.col(asset_id)))
    return tagged.groupBy(*keys).agg(F.max(tag_number(F.col(asset_id))).alias("max_tag"))


def max_tags_after(state: DataFrame, changed: DataFrame, keys: Sequence[str], asset_id: str = "asset_id") -> DataFrame:
    """Kept highest tag numbers that changed items raise, by key: rows to upsert.

    Tag numbers are not used again, so the highest one ever seen counts, also of items that are gone.
    """
    return merge_aggregates(state, max_tag(changed, keys, asset_id), keys, {"max_tag": "max"})


def sku_max_tags(skus: DataFrame, items: DataFrame) -> DataFrame:
    """The highest tag number per resolved SKU, 0 where the remote side has no tagged item."""
    highest = max_tag(items, ["location_id", "sku_id"])
    joined = skus.join(highest, ["location_id", "sku_id"], "left")
    return joined.withColumn("max_tag", F.coalesce(F.col("max_tag"), F.lit(0)))


def tag_ranges(
    to_send: DataFrame,
    tagged_skus: DataFrame,
    sku_master: DataFrame,
    keys: Sequence[str] = tuple(SKU_KEYS),
    rank: str = "source_rank",
) -> DataFrame:
    """Per SKU and source, how many units go out and after which tag number they start.

    Rows are first summed per SKU and source, so a window holds one row per source
    of a SKU, not its rows and not the units they expand to; each source starts
    where the one before it ends.
    """
    units = F.floor(F.col("qty")).cast("long")
    summed = (
        to_send.where(F.col("qty") >= 1)
        .groupBy(*keys, rank)
        .agg(F.sum(units).cast("long").alias("units"))
    )
    earlier = (
        Window.partitionBy(*keys).orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = summed.withColumn(
        "_offset", F.coalesce(F.sum("units").over(earlier), F.lit(0)).cast("long")
    )
    ids = tagged_skus.select(*keys, "location_id", "sku_id", "max_tag")
    items = sku_master.select(*MASTER_KEYS, "item")
    return (
        offset.join(ids, list(keys))
        .join(items, MASTER_KEYS)
        .withColumn("after_tag", F.col("max_tag").cast("long") + F.col("_offset"))
        .drop("_offset", "max_tag")
    )


def tag_text(item: Column, branch: Column, number: Column) -> Column:
    return F.concat(
        F.trim(item), F.lit("_"), pad(branch, BRANCH_WIDTH), F.lit("_"), number.cast("string")
    )


def allocate_tags(ranges: DataFrame) -> DataFrame:
    """One row per unit with its tag."""
    units = expand_units(ranges, "units")
    number = F.col("after_tag") + F.col("unit_no")
    return units.withColumns(
        {"tag_no": number, "tag": tag_text(F.col("item"), F.col("branch"), number)}
    )
