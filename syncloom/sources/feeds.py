"""JSON feeds that come in, as landing folders of gzip files or as text columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from syncloom.schemas import DEFAULT_COMPANY
from syncloom.session import no_rows


class MissingFeed(ValueError):
    """A feed that a run cannot do without is absent or empty."""


def feed_path(root: str, op: str, session_id: str) -> str:
    return f"{root}/op={op}/session={session_id}"


def read_json_feed(
    spark: SparkSession,
    root: str,
    ddl: str,
    session_id: str,
    op: str,
    required: bool = True,
    documents: bool = False,
    encoding: str = "UTF-8",
    strict: bool = True,
) -> DataFrame:
    """The rows of one feed of one session.

    A feed is a folder of many files: one object per line, or with ``documents``
    one array or object per file. ``strict`` fails on a value that does not fit
    its column, which would otherwise turn into NULL.
    """
    reader = spark.read.schema(ddl).options(
        multiLine=documents,
        encoding=encoding,
        lineSep="\n",
        mode="FAILFAST" if strict else "PERMISSIVE",
    )
    try:
        feed = reader.json(feed_path(root, op, session_id))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        feed = None
    if required and (feed is None or feed.isEmpty()):
        raise MissingFeed(f"no rows for feed {op} of session {session_id}")
    return no_rows(spark, ddl) if feed is None else feed


#: Columns of a reject: the line as it came, the file it came in, and what is wrong with it.
REJECTED = "raw string, file string, reason string"


def read_with_rejects(
    spark: SparkSession,
    root: str,
    ddl: str,
    session_id: str,
    op: str,
    stage: Callable[[DataFrame], DataFrame],
    encoding: str = "UTF-8",
) -> tuple[DataFrame, DataFrame]:
    """The good rows of a feed of one object per line, and its rejects.

    A line that is no JSON object, or has a value that does not fit its column, is kept as it came,
    with its file and a reason: `malformed`, or the names of the columns. All other lines go on.
    ``stage`` writes the parsed feed once, as both results are read from it. Blank lines are neither.
    """
    fields = T.StructType.fromDDL(ddl)
    raw, file = "_raw", "_file"
    schema = T.StructType([*fields, T.StructField(raw, T.StringType())])
    reader = spark.read.schema(schema).options(
        encoding=encoding, lineSep="\n", mode="PERMISSIVE", columnNameOfCorruptRecord=raw
    )
    try:
        feed = reader.json(feed_path(root, op, session_id))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, ddl), no_rows(spark, REJECTED)
    parsed = stage(feed.select(*fields.fieldNames(), raw, F.col("_metadata.file_path").alias(file)))
    good = parsed.where(F.col(raw).isNull()).select(*fields.fieldNames())
    bad = parsed.where(F.col(raw).isNotNull())
    # As texts all values of an object fit; what is there and did not fit its column is to blame.
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    as_texts = F.from_json(F.col(raw), texts, {"mode": "PERMISSIVE"})
    blamed = F.array_compact(
        F.array(
            *[
                F.when(as_texts[f.name].isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f.name))
                for f in fields
            ]
        )
    )
    reason = F.when(F.size(blamed) > 0, F.array_join(blamed, ", ")).otherwise(F.lit("malformed"))
    return good, bad.select(F.col(raw).alias("raw"), F.col(file).alias("file"), reason.alias("reason"))


def shred(df: DataFrame, column: str, ddl: str, keep: Sequence[str] = ()) -> DataFrame:
    """The objects of a JSON array column as rows; a single object counts as an array of one."""
    objects = F.from_json(F.col(column), T.ArrayType(T.StructType.fromDDL(ddl)))
    return df.select(*keep, F.inline(objects))


def active_branches(feed: DataFrame, company: str = DEFAULT_COMPANY) -> DataFrame:
    """The branch feed under our names, each branch once; the feed names no company."""
    rows = feed.select(
        F.col("ID").alias("id"), F.lit(company).alias("company"), F.rtrim("PC").alias("branch")
    )
    return rows.groupBy("company", "branch").agg(F.min("id").alias("id"))


def remote_skus(feed: DataFrame) -> DataFrame:
    """The SKU feed under our names, each SKU of a location once."""
    rows = feed.select(
        F.col("ID").alias("sku_id"),
        F.col("HQLocationID").alias("location_id"),
        F.rtrim("UPC").alias("upc"),
        F.rtrim("ProductID").alias("product_id"),
    )
    return rows.groupBy("location_id", "upc", "product_id").agg(F.max("sku_id").alias("sku_id"))


def remote_items(feed: DataFrame) -> DataFrame:
    """The item feed under our names."""
    return feed.select(
        F.col("HQLocationID").alias("location_id"),
        F.col("HQSKUID").alias("sku_id"),
        F.rtrim("AssetID").alias("asset_id"),
    )


def remote_sites(feed: DataFrame) -> DataFrame:
    """The customer site feed under our names."""
    return feed.select(
        F.col("CJID").alias("site_id"),
        F.col("ID").alias("location_id"),
        F.rtrim("CompanyCode").alias("company"),
        F.rtrim("AccountNumber").alias("account"),
        F.rtrim("JobNumber").alias("job"),
        F.rtrim("JobLocation").alias("job_location"),
        F.rtrim("PCName").alias("branch_name"),
    )
