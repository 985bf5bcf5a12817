"""What the operators of this folder share: scratch tables, fresh names, words, offsets."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: White space of the word rules: space, tab, line feed, vertical tab, form feed, return.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
#: A written table is broadcast when it has at most so many bytes, and joined by a shuffle beyond.
BROADCAST_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors reach, as the session names it.

    Only a session of one machine may go without the setting; it then gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    fallback = tempfile.mkdtemp(prefix="corpus-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


class Scratch:
    """Tables that one call writes once and reads again.

    A written table survives lost executors, cuts the lineage, and tells the planner its size.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.count, self.count_of = 0, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        self.count_of[name] = self.count
        path = f"{self.root}/{self.count:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @contextmanager
    def held(self, df: DataFrame, name: str) -> Iterator[DataFrame]:
        """A written table that is deleted when what was made of it has been written itself."""
        table = self.write(df, name)
        try:
            yield table
        finally:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{self.count_of[name]:03d}-{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def use_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each Spark application.

    It goes as an archive through the shared folder, so workers on other machines find it too.
    """
    context = spark.sparkContext
    if getattr(context, "_corpus_package", False):
        return
    package = os.path.join(PACKAGE_ROOT, __name__.partition(".")[0])
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(n for n in names if not n.endswith((".pyc", ".pyo"))):
                path = os.path.join(folder, name)
                archive.write(path, os.path.relpath(path, PACKAGE_ROOT))
    path = f"{shared_root(spark)}/package-{uuid.uuid4().hex}.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(target)
    try:
        out.write(bytearray(body.getvalue()))
    finally:
        out.close()
    context.addPyFile(files.makeQualified(target).toString())
    context._corpus_package = True


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the ones asked for that no column of the table has, in whatever case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def named(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, name: str) -> DataFrame:
    """The table as one struct column, whose fields cannot clash with another table's columns."""
    return df.select(F.struct(*map(named, df.columns)).alias(name))


def row_key(key: Column, text: Column) -> Column:
    """16 bytes that stand for a row's id and text. Rows that agree in both share all results."""
    parts = [F.coalesce(c.cast("string"), F.lit("\x00")) for c in (key, text)]
    return F.unhex(F.md5(F.concat_ws("\x01", *parts)))


def small(df: DataFrame, columns: list[str], limit: int = BROADCAST_BYTES) -> DataFrame:
    """The written table with a broadcast hint if its rows are shown to fit the limit."""
    width = F.lit(64)
    for c in columns:
        width = width + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    size = df.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def white_words(text: Column) -> Column:
    """The runs of other characters than white space; none for null."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, WHITE_RUN)
    )


def count_white_words(text: Column) -> Column:
    return F.size(white_words(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower case for A to Z alone. Where all characters are ASCII, plain lower case does the same."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def seeded(seed: int, *keys: Column) -> Column:
    """32 hex digits that look random and depend on the seed and the keys only."""
    parts = [F.coalesce(k.cast("string"), F.lit("\x00")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def leading(digest: Column, digits: int) -> Column:
    """The first hex digits as a number."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def running_offsets(
    counts: DataFrame, by: Sequence[str], bucket: str, value: str, out: str, span: int = 1024
) -> DataFrame:
    """Per bucket, what the buckets before it sum up to.

    Two levels: spans of buckets are summed first, so that no window holds more than the spans of
    a group or the buckets of one span.
    """
    coarse = counts.withColumn("_span", F.floor(F.col(bucket) / span))
    before = Window.partitionBy(*by).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        coarse.groupBy(*by, "_span")
        .agg(F.sum(value).alias("_total"))
        .select(*by, "_span", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    )
    inside = (
        Window.partitionBy(*by, "_span")
        .orderBy(bucket)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    within = coarse.withColumn("_inner", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = [within[c].eqNullSafe(spans[c]) for c in by] + [within["_span"] == spans["_span"]]
    return within.join(spans, same, "left").select(
        *[within[c] for c in counts.columns], (F.col("_base") + F.col("_inner")).alias(out)
    )
