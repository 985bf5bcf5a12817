"""The list of SKUs a run needs: derived from changes and queues, then resolved to remote ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from syncloom.functions.keys import number_key, product_id, sku_label, upc
from syncloom.operators.joins import enrich, exclude, keep_matching, with_branch_id
from syncloom.schemas import ACTION_ADD, ACTION_IDLE, ASSET_KEYS, MASTER_KEYS, SKU_KEYS


def _derive(keys: DataFrame, sku_master: DataFrame, active: DataFrame, bulk: bool) -> DataFrame:
    """SKU rows for distinct SKU keys that the master and the active branches know."""
    master = sku_master.where(F.col("bulk") == ("Y" if bulk else "N"))
    described = keys.distinct().join(
        master.select(*MASTER_KEYS, "description"), MASTER_KEYS
    )
    category, class_code = F.col("category"), F.col("class_code")
    return with_branch_id(described, active, name="pc_id").select(
        "pc_id",
        *SKU_KEYS,
        product_id(class_code).alias("product_id"),
        "description",
        upc(category).alias("upc"),
        sku_label(category, class_code).alias("label"),
        F.lit(False).alias("is_consumable"),
        F.lit(bulk).alias("is_bulk"),
    )


def _asset_skus(assets: DataFrame) -> DataFrame:
    return assets.withColumn("branch", F.col("current_branch")).select(*SKU_KEYS)


def skus_of_assets(
    changes: DataFrame, assets: DataFrame, sku_master: DataFrame, active: DataFrame
) -> DataFrame:
    """SKUs of changed assets that are not deleted."""
    live = assets.where(F.col("delete_code") == "A")
    changed = keep_matching(live, changes, ASSET_KEYS, unique=True)
    return _derive(_asset_skus(changed), sku_master, active, bulk=False)


def skus_of_quantities(
    changes: DataFrame, sku_master: DataFrame, active: DataFrame
) -> DataFrame:
    """SKUs of quantity changes."""
    return _derive(changes.select(*SKU_KEYS), sku_master, active, bulk=True)


def _queued(queue: DataFrame, include_sent: bool) -> DataFrame:
    return queue if include_sent else queue.where(F.col("sent_at").isNull())


def skus_of_queued_assets(
    queue: DataFrame,
    sku_master: DataFrame,
    active: DataFrame,
    listed: DataFrame,
    include_sent: bool = False,
) -> DataFrame:
    """SKUs of queued assets that the list does not have yet."""
    keys = _queued(queue, include_sent).select(
        "company",
        "branch",
        number_key(F.col("category"), 3).alias("category"),
        number_key(F.col("class_code"), 4).alias("class_code"),
    )
    return _derive(exclude(keys, listed, SKU_KEYS), sku_master, active, bulk=False)


def skus_of_queued_bulk(
    queue: DataFrame,
    sku_master: DataFrame,
    active: DataFrame,
    listed: DataFrame,
    include_sent: bool = False,
    per_branch: bool = True,
) -> DataFrame:
    """SKUs of queued bulk quantities that the list does not have yet.

    Without ``per_branch`` a SKU listed for one branch counts as listed for all.
    """
    waiting = _queued(queue, include_sent).where(F.col("qty") > 0).select(*SKU_KEYS)
    unlisted = exclude(waiting, listed, SKU_KEYS if per_branch else MASTER_KEYS)
    return _derive(unlisted, sku_master, active, bulk=True)


def flag_missing(skus: DataFrame, remote: DataFrame) -> DataFrame:
    """Set the action of each SKU: add where the remote list has no such SKU."""
    known = remote.select(
        F.col("location_id").alias("pc_id"), "upc", "product_id", F.lit(True).alias("_known")
    )
    joined = enrich(skus, known, ["pc_id", "upc", "product_id"])
    action = F.when(F.col("_known"), ACTION_IDLE).otherwise(ACTION_ADD)
    return joined.withColumn("action", action).select(*skus.columns, "action")


def missing_skus(skus: DataFrame, remote: DataFrame) -> DataFrame:
    """SKUs that the remote list does not have."""
    known = {"pc_id": "location_id", "upc": "upc", "product_id": "product_id"}
    return exclude(skus, remote, known, unique=True)


def resolve_skus(skus: DataFrame, remote: DataFrame) -> DataFrame:
    """Add the remote location and SKU ids; an unknown SKU keeps its branch and gets id 0."""
    ids = remote.select(F.col("location_id").alias("pc_id"), "upc", "product_id", "sku_id")
    joined = enrich(skus, ids, ["pc_id", "upc", "product_id"])
    sku_id = F.coalesce(F.col("sku_id"), F.lit(0)).cast("long")
    return joined.withColumns({"location_id": F.col("pc_id"), "sku_id": sku_id}).select(
        *skus.columns, "location_id", "sku_id"
    )


def resolved(skus: DataFrame, is_bulk: bool | None = None) -> DataFrame:
    """SKUs that have a remote id."""
    usable = skus.where(F.col("sku_id") != 0)
    return usable if is_bulk is None else usable.where(F.col("is_bulk") == is_bulk)


def unresolved(df: DataFrame, skus: DataFrame, keys=tuple(SKU_KEYS)) -> DataFrame:
    """Rows whose SKU is not listed, or is listed without a remote id."""
    return exclude(df, resolved(skus), list(keys), unique=True)


