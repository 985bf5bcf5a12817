"""Source, state and remote tables, derived from the test tables.

Each stand-in derives from a whole table; those that stand for what was, is active or waits
(`assets_before`, `active`, `event_state`, `remote_skus`, `asset_queue`) take the part of it that a
condition names, which is what they stand for. The check SQL derives the same ones in
``oracle.py``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from syncloom.functions.keys import pad, product_id, upc
from syncloom.operators.changes import (
    active_changes,
    fingerprint,
    replay_into_changes,
    snapshot_diff,
)
from syncloom.operators.joins import keep_matching
from syncloom.operators.quantity import (
    fill_from_snapshot,
    mark_known_events,
    quantity_delta,
    risen_quantities,
    rollup_quantities,
)
from syncloom.operators.skus import resolve_skus, skus_of_assets, skus_of_quantities
from syncloom.schemas import ASSET_KEYS, DEFAULT_COMPANY, SKU_KEYS
from syncloom.session import Workspace, together

CUTOFF = "2000-01-01 00:00:00"
EVENTS_FROM = "2024-01-10 00:00:00"
EVENTS_TO = "2024-01-20 00:00:00"

SECOND_COMPANY = "02"

PROJECTIONS = {"assets", "assets_before", "qty_events", "customer_sites", "remote_items"}

EVENT_CLASSES = {"click": 5, "view": 10, "purchase": 15, "signup": 20, "error": 25}


def company_of(number: Column) -> Column:
    """Two companies, whose branches have the same codes."""
    return F.when(number % 4 == 0, SECOND_COMPANY).otherwise(DEFAULT_COMPANY)


def location_base(company: Column) -> Column:
    return F.when(company == SECOND_COMPANY, 200).otherwise(100)


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


class Standins:
    """The tables, and the steps of a run over them that several queries go on from.

    Like a run, a query writes such a step once and reads it as often as it needs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.work = Workspace(spark)
        self.written: set[str] = set()

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        return self.work.stage(df, name)

    def write_tables(self, *names: str) -> None:
        """Write stand-ins as tables, so that a run reads columns as it would of a source."""
        # Mere projections of a test table are read from it each time; nothing is gained by a copy.
        missing = [n for n in names if n not in self.written and n not in PROJECTIONS]
        if missing:
            tables = together(
                *[lambda n=n: self.stage(getattr(self, n), f"table_{n}") for n in missing]
            )
            self.__dict__.update(zip(missing, tables))
            self.written.update(missing)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def assets(self) -> DataFrame:
        """Orders as serialized assets."""
        order, customer = F.col("o_orderkey"), F.col("o_custkey")
        return self.table("orders").select(
            company_of(customer).alias("company"),
            F.concat(F.lit("A"), order.cast("string")).alias("asset_id"),
            (1 + customer % 25).cast("decimal(3,0)").alias("category"),
            (1 + order % 50).cast("decimal(4,0)").alias("class_code"),
            pad(customer % 25, 4).alias("home_branch"),
            pad(order % 25, 4).alias("current_branch"),
            F.when(F.col("o_orderstatus") == "F", "I").otherwise("A").alias("status"),
            F.when(F.col("o_orderpriority") == "5-LOW", "D").otherwise("A").alias("delete_code"),
            F.concat(F.lit(" S"), customer.cast("string"), F.lit(" ")).alias("serial"),
            F.col("o_orderpriority").alias("priority"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
            F.col("o_orderdate").alias("synced_at"),
        )

    @cached_property
    def assets_before(self) -> DataFrame:
        """The assets as they were: later ones unknown, urgent ones in another status."""
        known = self.assets.where(F.col("synced_at") < ntz(CUTOFF))
        status = F.when(F.col("priority") == "1-URGENT", "X").otherwise(F.col("status"))
        return known.withColumn("status", status)

    def prints(self, assets: DataFrame) -> DataFrame:
        return fingerprint(assets, ASSET_KEYS, exclude_columns=["synced_at"])

    @cached_property
    def active(self) -> DataFrame:
        """Nations of three regions as active branches of one company, and of three of the other."""
        nation, region = F.col("n_nationkey"), F.col("n_regionkey")
        each = self.table("nation").select(
            "*",
            F.explode(F.array(F.lit(DEFAULT_COMPANY), F.lit(SECOND_COMPANY))).alias("company"),
        )
        open_ = F.when(F.col("company") == SECOND_COMPANY, region > 1).otherwise(region < 3)
        return each.where(open_).select(
            (location_base(F.col("company")) + nation).cast("long").alias("id"),
            "company",
            pad(nation, 4).alias("branch"),
        )

    @cached_property
    def sku_master(self) -> DataFrame:
        """Brand and size of parts as category and class."""
        keys = self.table("part").select(
            F.substring("p_brand", 7, 3).cast("decimal(3,0)").alias("category"),
            F.col("p_size").cast("decimal(4,0)").alias("class_code"),
            "p_name",
        )
        category, class_code = F.col("category"), F.col("class_code")
        even = (category + class_code) % 2 == 0
        described = keys.groupBy("category", "class_code").agg(F.min("p_name").alias("description"))
        # The second company has some of them only.
        some = F.when(class_code % 3 == 0, F.array(F.lit(DEFAULT_COMPANY))).otherwise(
            F.array(F.lit(DEFAULT_COMPANY), F.lit(SECOND_COMPANY))
        )
        return described.withColumn("company", F.explode(some)).select(
            "company",
            "category",
            "class_code",
            "description",
            F.when(even, "Y").otherwise("N").alias("bulk"),
            F.concat(self.item(category, class_code), F.lit(" ")).alias("item"),
        )

    @staticmethod
    def item(category: Column, class_code: Column) -> Column:
        return F.concat(
            F.lit("P"), category.cast("string"), F.lit("X"), class_code.cast("string")
        )

    @cached_property
    def qty_events(self) -> DataFrame:
        """Events as a log of owned quantities; one SKU of a branch per user and type."""
        user = F.col("user_id")
        class_code = F.lit(0)
        for kind, code in EVENT_CLASSES.items():
            class_code = F.when(F.col("event_type") == kind, code).otherwise(class_code)
        return self.table("events").select(
            company_of(user).alias("company"),
            pad(user % 25, 4).alias("branch"),
            (1 + F.floor(user / 25) % 25).cast("decimal(3,0)").alias("category"),
            class_code.cast("decimal(4,0)").alias("class_code"),
            F.upper(F.substring("event_type", 1, 2)).alias("event"),
            F.col("event_id").alias("seq"),
            F.col("ts").alias("synced_at"),
            F.floor("value").cast("decimal(6,0)").alias("qty"),
        )

    @cached_property
    def qty_snapshot(self) -> DataFrame:
        return self.qty_events.groupBy(*SKU_KEYS).agg(F.max("qty").alias("qty"))

    @cached_property
    def event_state(self) -> DataFrame:
        """Events already sent: those before the interval; clicks under an older sync time."""
        before = self.qty_events.where(F.col("synced_at") < ntz(EVENTS_FROM))
        clicks = self.qty_events.where(F.col("event") == "CL")
        older = F.col("synced_at") - F.expr("interval 100 days")
        return before.unionByName(clicks.withColumn("synced_at", older))

    @cached_property
    def deltas(self) -> DataFrame:
        return fill_from_snapshot(quantity_delta(self.qty_events), self.qty_snapshot)

    @cached_property
    def quantity_changes(self) -> DataFrame:
        due = self.deltas.where(
            F.col("synced_at").between(ntz(EVENTS_FROM), ntz(EVENTS_TO))
        )
        risen = risen_quantities(due, self.sku_master, self.active)
        return mark_known_events(self.stage(risen, "risen"), self.event_state)

    def _remote(self, keys: DataFrame) -> DataFrame:
        location = location_base(F.col("company")) + F.col("branch").cast("long")
        category, class_code = F.col("category"), F.col("class_code")
        number = location * 10_000_000 + category.cast("long") * 10_000 + class_code.cast("long")
        return keys.select(*SKU_KEYS).distinct().select(
            F.when(class_code == 20, 0).otherwise(number).cast("long").alias("sku_id"),
            location.alias("location_id"),
            upc(category).alias("upc"),
            product_id(class_code).alias("product_id"),
        )

    @cached_property
    def remote_skus(self) -> DataFrame:
        """SKUs the remote side knows; class 20 is listed there without an id."""
        old = self.assets_before.withColumnRenamed("current_branch", "branch")
        moved = self.qty_events.where(F.col("event") != "ER")
        return self._remote(old.select(*SKU_KEYS).unionByName(moved.select(*SKU_KEYS)))

    @cached_property
    def remote_items(self) -> DataFrame:
        """One remote item per event, its id tagged by the quantity, some ids malformed."""
        qty, branch = F.col("qty"), F.col("branch")
        item = self.item(F.col("category"), F.col("class_code"))
        stem = F.concat(item, F.lit("_"), branch, F.lit("_"))
        name = (
            F.when(qty == 0, "nounderscore")
            .when(qty == 1, stem)
            .when(qty == 2, F.concat(stem, F.lit("x")))
            .otherwise(F.concat(stem, qty.cast("string")))
        )
        location = location_base(F.col("company")) + branch.cast("long")
        category, class_code = F.col("category").cast("long"), F.col("class_code").cast("long")
        return self.qty_events.select(
            location.alias("location_id"),
            (location * 10_000_000 + category * 10_000 + class_code).alias("sku_id"),
            name.alias("asset_id"),
        )

    @cached_property
    def bulk_queue(self) -> DataFrame:
        """Line items as held-back quantities; closed ones have been sent."""
        part, supplier = F.col("l_partkey"), F.col("l_suppkey")
        return self.table("lineitem").select(
            F.concat(F.lit("r"), F.col("l_linenumber").cast("string")).alias("run_id"),
            company_of(supplier).alias("company"),
            pad(supplier % 25, 4).alias("branch"),
            (1 + part % 25).cast("decimal(3,0)").alias("category"),
            (1 + part % 50).cast("decimal(4,0)").alias("class_code"),
            F.col("l_quantity").cast("decimal(18,2)").alias("qty"),
            F.when(F.col("l_returnflag") == "N", "RC").otherwise("RT").alias("status"),
            F.lit(1).alias("reason"),
            F.col("l_shipdate").alias("detected_at"),
            F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("sent_at"),
        )

    @cached_property
    def asset_queue(self) -> DataFrame:
        """Assets of two priorities as held back; inactive ones have been sent.

        Some have moved since, and some were of another class.
        """
        waiting = self.assets.where(F.col("priority").isin("2-HIGH", "3-MEDIUM"))
        category = F.col("category").cast("int")
        then = F.when(category % 3 == 0, F.col("home_branch")).otherwise(F.col("current_branch"))
        other = F.when(category % 5 == 0, 1).otherwise(0)
        return waiting.select(
            F.lit("r0").alias("run_id"),
            "company",
            "asset_id",
            then.alias("branch"),
            upc(F.col("category")).alias("category"),
            product_id((F.col("class_code") + other).cast("decimal(4,0)")).alias("class_code"),
            F.lit(1).alias("reason"),
            F.col("synced_at").alias("detected_at"),
            F.when(F.col("status") == "I", F.col("synced_at")).alias("sent_at"),
        )

    @cached_property
    def customer_sites(self) -> DataFrame:
        key = F.col("c_custkey")
        text = key.cast("string")
        return self.table("customer").select(
            key.alias("site_id"),
            company_of(key).alias("company"),
            key.cast("decimal(7,0)").alias("account"),
            F.concat(F.lit("J"), text).alias("job"),
            pad(F.col("c_nationkey"), 4).alias("branch"),
            F.col("c_mktsegment").alias("job_location"),
            F.concat(F.lit("contact "), text).alias("contact"),
            F.col("c_name").alias("name"),
            F.concat(text, F.lit(" Main St")).alias("address1"),
            F.concat(F.lit("Unit "), text).alias("address2"),
            F.lit("Springfield").alias("city"),
            F.lit("OH").alias("state"),
            F.right(F.concat(F.lit("00000"), text), F.lit(5)).alias("zip"),
            (200 + key % 700).cast("decimal(3,0)").alias("area_code"),
            (5_550_000 + key % 10_000).cast("decimal(7,0)").alias("phone"),
            (key % 97).cast("decimal(6,0)").alias("sales_rep"),
            F.concat(F.lit("PO"), text).alias("po_number"),
        )

    @cached_property
    def remote_sites(self) -> DataFrame:
        """Suppliers as remote sites; a branch has up to three locations."""
        key = F.col("s_suppkey")
        nation = F.col("s_nationkey")
        text = key.cast("string")
        return self.table("supplier").select(
            (key * 3).alias("site_id"),
            (1000 + nation * 10 + key % 3).cast("long").alias("location_id"),
            company_of(key).alias("company"),
            text.alias("account"),
            F.concat(F.lit("J"), text).alias("job"),
            F.lit("BUILDING").alias("job_location"),
            F.concat(F.lit("PC"), pad(nation, 4)).alias("branch_name"),
        )

    @cached_property
    def control(self) -> DataFrame:
        """One source per event type, last started days after its first event; one never ran."""
        day = F.expr(
            "cast(cast(min(ts) as date) as timestamp_ntz) + make_dt_interval(length(event_type))"
        )
        rows = self.table("events").groupBy("event_type").agg(day.alias("day"))
        ran = F.col("event_type") != "error"
        return rows.select(
            F.col("event_type").alias("source"),
            F.when(ran, F.col("day")).alias("start_ts"),
            F.when(ran, F.col("day")).alias("prev_start_ts"),
            F.when(ran, F.col("day")).alias("end_ts"),
        )

    @cached_property
    def diff(self) -> DataFrame:
        return snapshot_diff(
            self.prints(self.assets), self.prints(self.assets_before), ASSET_KEYS
        )

    @cached_property
    def changes(self) -> DataFrame:
        self.write_tables("assets")
        current = fingerprint(
            self.assets, ASSET_KEYS, exclude_columns=["synced_at"], keep=["current_branch"]
        )
        found = active_changes(current, self.prints(self.assets_before), self.active)
        feed = self.stage(found, "feed")
        return self.stage(replay_into_changes(feed, self.asset_queue), "changes")

    @cached_property
    def changed_assets(self) -> DataFrame:
        """Where changed assets are, and of what SKU; read by all that follows the changes."""
        columns = [*ASSET_KEYS, "current_branch", "category", "class_code", "delete_code"]
        changed = keep_matching(self.assets.select(*columns), self.changes, ASSET_KEYS, unique=True)
        return self.stage(changed, "changed_assets")

    @cached_property
    def sent_quantities(self) -> DataFrame:
        return self.stage(self.quantity_changes, "quantity_changes")

    @cached_property
    def to_send(self) -> DataFrame:
        return self.stage(rollup_quantities(self.sent_quantities), "to_send")

    @cached_property
    def asset_skus(self) -> DataFrame:
        return skus_of_assets(self.changes, self.changed_assets, self.sku_master, self.active)

    @cached_property
    def bulk_skus(self) -> DataFrame:
        return skus_of_quantities(self.sent_quantities, self.sku_master, self.active)

    @cached_property
    def listed(self) -> DataFrame:
        self.write_tables("assets", "qty_events", "sku_master")
        together(lambda: self.changed_assets, lambda: self.sent_quantities)
        return self.stage(self.asset_skus.unionByName(self.bulk_skus), "listed")

    @cached_property
    def resolved(self) -> DataFrame:
        return self.stage(resolve_skus(self.listed, self.remote_skus), "resolved")
