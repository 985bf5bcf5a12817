"""JSON feeds that go out: gzip files of one object per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from syncloom.sources.feeds import feed_path


def nest_json(
    df: DataFrame, parent: Sequence[str], children: Sequence[str], name: str
) -> DataFrame:
    """One document per parent with its rows as a sorted array of objects.

    The parent's columns name whose rows make a document. Where a parent can have any number of
    rows, the caller adds a column to it within which they are bounded; it then stands in the
    document as well. A parent of NULL is a parent too.
    """
    items = F.array_sort(F.collect_list(F.struct(*children))).alias(name)
    nested = df.groupBy(*parent).agg(items)
    return nested.select(*parent, F.to_json(F.struct(*parent, name)).alias("doc"))


def nested_ddl(df: DataFrame, parent: Sequence[str], children: Sequence[str], name: str) -> str:
    """The schema of the documents that ``nest_json`` makes of a table."""
    items = T.ArrayType(T.StructType([df.schema[c] for c in children]))
    return T.StructType([*[df.schema[c] for c in parent], T.StructField(name, items)]).toDDL()


def as_json(df: DataFrame) -> DataFrame:
    """One JSON object per row, without the properties that are NULL."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def write_feed(
    df: DataFrame, root: str, op: str, session_id: str, encoded: bool = False
) -> str | None:
    """Write a feed of a session and return its path, or None when it has no rows.

    The folder is replaced in any case, so a run that starts over leaves no rows of before. The
    rows are computed once: whether there are any is read from what was written.
    """
    path = feed_path(root, op, session_id)
    lines = df if encoded else as_json(df)
    lines.write.mode("overwrite").option("compression", "gzip").text(path)
    return None if df.sparkSession.read.text(path).isEmpty() else path
