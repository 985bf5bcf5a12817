"""The inputs of a run, from source tables and from the feeds of a session."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from syncloom.plans.sync import Inputs
from syncloom.schemas import DEFAULT_COMPANY, FEEDS, from_source
from syncloom.sources import feeds

# Names under which the feeds of a session land; the SKU list comes again after the
# remote side has taken in the SKUs it lacked.
OPS = {
    "active": "branches",
    "remote_skus_before": "skus",
    "remote_skus_after": "skus_refreshed",
    "remote_items": "items",
    "remote_sites": "customer_sites",
}


def load_inputs(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    landing: str,
    session_id: str,
    company: str = DEFAULT_COMPANY,
    documents: bool = False,
) -> Inputs:
    """Source tables under their own column names, and the feeds that landed for a session.

    All feeds are required but that of the customer sites.
    """

    def feed(name: str, required: bool = True) -> DataFrame:
        op = OPS[name]
        ddl = FEEDS["skus" if op == "skus_refreshed" else op]
        return feeds.read_json_feed(
            spark, landing, ddl, session_id, op, required=required, documents=documents
        )

    tables = {name: from_source(df, name) for name, df in sources.items()}
    return Inputs(
        **tables,
        active=feeds.active_branches(feed("active"), company),
        remote_skus_before=feeds.remote_skus(feed("remote_skus_before")),
        remote_skus_after=feeds.remote_skus(feed("remote_skus_after")),
        remote_items=feeds.remote_items(feed("remote_items")),
        remote_sites=feeds.remote_sites(feed("remote_sites", required=False)),
    )
