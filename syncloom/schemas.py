"""Column names, keys and schemas of the sources, feeds and state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

SKU_KEYS = ["company", "branch", "category", "class_code"]
EVENT_KEYS = [*SKU_KEYS, "event", "seq", "synced_at"]
ASSET_KEYS = ["company", "asset_id"]
BRANCH_KEYS = ["company", "branch"]
MASTER_KEYS = ["company", "category", "class_code"]

DEFAULT_COMPANY = "01"

# Codes that receivers of the feeds rely on.
ACTION_IDLE, ACTION_ADD = 0, 1
REASON_SKU_MISSING = 1
STATUS_RECEIVE = "RC"
NEW, UPD, DEL = "NEW", "UPD", "DEL"

# Column names of the source tables, with the names and types used here.
SOURCE_COLUMNS = {
    "assets": {
        "EMCMP": "company string",
        "EMEQP#": "asset_id string",
        "SYNCDTTM": "synced_at timestamp_ntz",
        "EMCATG": "category decimal(3,0)",
        "EMCLAS": "class_code decimal(4,0)",
        "EMALOC": "home_branch string",
        "EMCLOC": "current_branch string",
        "EMSTAT": "status string",
        "EMDLCD": "delete_code string",
        "EMSER#": "serial string",
    },
    "qty_events": {
        "RRN_FIELD_DATA": "seq bigint",
        "SYNCDTTM": "synced_at timestamp_ntz",
        "ELEVENT": "event string",
        "ELCMP": "company string",
        "ELLOC": "branch string",
        "ELCATG": "category decimal(3,0)",
        "ELCLAS": "class_code decimal(4,0)",
        "ELQOWN": "qty decimal(6,0)",
    },
    "qty_snapshot": {
        "ELCMP": "company string",
        "ELLOC": "branch string",
        "ELCATG": "category decimal(3,0)",
        "ELCLAS": "class_code decimal(4,0)",
        "ELQOWN": "qty decimal(6,0)",
    },
    "sku_master": {
        "ECCMP": "company string",
        "ECCATG": "category decimal(3,0)",
        "ECCLAS": "class_code decimal(4,0)",
        "ECDESC": "description string",
        "ECBULK": "bulk string",
        "ECEQP#": "item string",
    },
    "customer_sites": {
        "CJID": "site_id bigint",
        "CJCMP": "company string",
        "CJCUS#": "account decimal(7,0)",
        "CJJOB#": "job string",
        "CJDLCD": "delete_code string",
        "CJLOC": "branch string",
        "CJRCDT": "record_date decimal(8,0)",
        "CJJLOC": "job_location string",
        "CJCOM": "contact string",
        "CJNAME": "name string",
        "CJADR1": "address1 string",
        "CJADR2": "address2 string",
        "CJCITY": "city string",
        "CJST": "state string",
        "CJZIP": "zip string",
        "CJAREA": "area_code decimal(3,0)",
        "CJPHON": "phone decimal(7,0)",
        "CJTAXD": "tax_district string",
        "CJTERR": "territory decimal(3,0)",
        "CJSREP": "sales_rep decimal(6,0)",
        "CJPO#": "po_number string",
    },
}

# Fields of the JSON feeds that come in.
FEEDS = {
    "branches": "ID bigint, PC string",
    "skus": (
        "ID bigint, DateAdded timestamp_ntz, LastUpdated timestamp_ntz, "
        "HQLocationID bigint, UPC string, ProductID string"
    ),
    "items": (
        "ID bigint, DateAdded timestamp_ntz, LastUpdated timestamp_ntz, HQLocationID bigint, "
        "HQSKUID bigint, TagID string, Status string, AssetID string, IsActive boolean"
    ),
    "customer_sites": (
        "CJID bigint, ID bigint, CompanyCode string, AccountNumber string, JobNumber string, "
        "JobLocation string, ContactName string, Name string, Address1 string, Address2 string, "
        "City string, State string, Zip string, OrderedByAreaCode int, OrderedByPhone int, "
        "SalesRep string, PONumber string, PCName string"
    ),
}

STATE = {
    "asset_state": "company string, asset_id string, hash string, cached_at timestamp_ntz",
    "qty_event_state": (
        "company string, branch string, category decimal(3,0), class_code decimal(4,0), "
        "event string, seq bigint, synced_at timestamp_ntz, qty decimal(6,0), "
        "prev_qty decimal(6,0), hash string, cached_at timestamp_ntz"
    ),
    "qty_snapshot_state": (
        "company string, branch string, category decimal(3,0), class_code decimal(4,0), "
        "qty decimal(6,0), hash string, cached_at timestamp_ntz"
    ),
    "last_qty": (
        "company string, branch string, category decimal(3,0), class_code decimal(4,0), "
        "seq bigint, synced_at timestamp_ntz, qty decimal(6,0)"
    ),
    "taken_events": (
        "company string, branch string, category decimal(3,0), class_code decimal(4,0), "
        "event string, seq bigint, synced_at timestamp_ntz"
    ),
    "prior_attributes": "company string, asset_id string, serial string",
    "bulk_queue": (
        "run_id string, company string, branch string, category decimal(3,0), "
        "class_code decimal(4,0), qty decimal(18,2), status string, reason int, "
        "detected_at timestamp_ntz, sent_at timestamp_ntz"
    ),
    "asset_queue": (
        "run_id string, company string, asset_id string, branch string, category string, "
        "class_code string, reason int, detected_at timestamp_ntz, sent_at timestamp_ntz"
    ),
    "customer_site_state": "site_id bigint, hash string, cached_at timestamp_ntz",
    "control": (
        "source string, start_ts timestamp_ntz, prev_start_ts timestamp_ntz, "
        "end_ts timestamp_ntz"
    ),
}

# Queue rows that have been sent are set aside, so that a run reads those that wait.
STATE["bulk_queue_sent"] = STATE["bulk_queue"]
STATE["asset_queue_sent"] = STATE["asset_queue"]

STATE_KEYS = {
    "asset_state": ASSET_KEYS,
    "prior_attributes": ASSET_KEYS,
    "qty_snapshot_state": SKU_KEYS,
    "last_qty": SKU_KEYS,
}


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of a schema, in its order and with its types."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema(ddl).fields])


def from_source(df: DataFrame, table: str) -> DataFrame:
    """Rename and type the columns of a source table, and drop trailing blanks of its texts.

    The source compares texts without regard to trailing blanks and Spark does
    not, so they go once, here. Columns that have no name of ours keep theirs
    and so still count in the row fingerprint.
    """
    known = SOURCE_COLUMNS[table]
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        named = known.get(field.name)
        name, data_type = named.split(" ", 1) if named else (field.name, None)
        if isinstance(field.dataType, T.StringType):
            column = F.rtrim(column)
        if data_type:
            column = column.cast(data_type)
        columns.append(column.alias(name))
    return df.select(*columns)
