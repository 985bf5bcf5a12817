"""Row hashes that tell NULLs, blanks and column borders apart."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T


def canonical(field: T.StructField) -> Column:
    """One value as text that depends on nothing but the value."""
    column = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column, {"ignoreNullFields": "false"})
    return column.cast("string")


def row_hash(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """SHA-256 over columns in name order, each value led by its length.

    The length makes the text unambiguous whatever the values hold, and a NULL
    has no length, so it differs from the empty text and keeps its place.
    """
    chosen = set(df.columns if columns is None else columns)
    parts = []
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        if field.name in chosen:
            text = canonical(field)
            led = F.concat(F.length(text).cast("string"), F.lit(":"), text)
            parts.append(F.coalesce(led, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)
