"""Rows of the feeds that go out. Their column names are fixed values that receivers rely on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from syncloom.functions.keys import stamp
from syncloom.operators.joins import in_active_branches, keep_matching, with_branch_id
from syncloom.schemas import ASSET_KEYS, SKU_KEYS, ACTION_ADD


# The columns of the asset feed that name a document of its nested form. Any number of assets may
# be of one SKU, so their ids are grouped by all but the last two characters.
ASSET_DOCUMENT = ("HQLocationID", "HQSKUID", "AssetGroup")


def with_group(feed: DataFrame) -> DataFrame:
    """The asset feed with the group that its nested documents hold together."""
    return feed.withColumn("AssetGroup", F.expr("left(AssetID, greatest(length(AssetID) - 2, 0))"))


def prior_attributes(assets: DataFrame, active: DataFrame) -> DataFrame:
    """Trimmed serial numbers of assets in use whose home branch is active."""
    in_use = assets.where(F.col("status") == "A")
    rows = in_active_branches(in_use, active, branch="home_branch")
    return rows.select(*[F.trim(c).alias(c) for c in ("company", "asset_id", "serial")])


def asset_payload(
    changes: DataFrame,
    assets: DataFrame,
    active: DataFrame,
    skus: DataFrame,
    prior: DataFrame,
    run_ts: Column,
) -> DataFrame:
    """Changed assets with their remote ids and their serial numbers, now and before."""
    located = assets.withColumn("branch", F.col("current_branch"))
    changed = keep_matching(located, changes, ASSET_KEYS, unique=True)
    ids = skus.where(~F.col("is_bulk")).select(*SKU_KEYS, "sku_id")
    before = prior.select(
        "company",
        F.col("asset_id").alias("_asset"),
        F.col("serial").alias("prev_serial"),
    )
    joined = (
        with_branch_id(changed, active)
        .join(ids, SKU_KEYS)
        .withColumn("_asset", F.trim("asset_id"))
        .join(before, ["company", "_asset"], "left")
    )
    return joined.select(
        run_ts.alias("DateAdded"),
        run_ts.alias("LastUpdated"),
        run_ts.alias("LastNotification"),
        F.col("location_id").alias("HQLocationID"),
        F.col("sku_id").alias("HQSKUID"),
        F.col("_asset").alias("TagID"),
        F.col("_asset").alias("AssetID"),
        F.trim("serial").alias("SerialNumber"),
        F.trim("prev_serial").alias("PrevSerial"),
    )


def sku_payload(skus: DataFrame, run_ts: Column, only_missing: bool = False) -> DataFrame:
    """The SKU list as the remote side wants it; all of it, or only what that side lacks."""
    listed = skus.where(F.col("action") == ACTION_ADD) if only_missing else skus
    return listed.select(
        stamp(run_ts).alias("DateAdded"),
        stamp(run_ts).alias("LastUpdated"),
        stamp(run_ts).alias("LastNotification"),
        F.col("pc_id").alias("HQLocationID"),
        F.col("upc").alias("UPC"),
        F.col("product_id").alias("ProductID"),
        F.col("label").alias("SKUListType"),
        F.col("description").alias("Description"),
        F.col("is_consumable").cast("int").alias("IsConsumable"),
        F.lit(1).alias("IsActive"),
        F.lit(1).alias("QuantityOnHand"),
    )


def unit_payload(units: DataFrame, run_ts: Column) -> DataFrame:
    """One record per unit."""
    return units.select(
        stamp(run_ts).alias("DateAdded"),
        F.col("location_id").alias("HQLocationID"),
        F.col("sku_id").alias("HQSKUID"),
        F.lit(1).alias("Quantity"),
        F.col("tag").alias("TagID"),
        F.col("tag").alias("AssetID"),
        F.lit(1).alias("IsActive"),
    )
