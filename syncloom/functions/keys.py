"""Key texts: zero padding, composite labels, branch codes, numeric keys, tag suffixes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CATEGORY_WIDTH = 3
CLASS_WIDTH = 4
BRANCH_WIDTH = 4


def pad(column: Column, width: int) -> Column:
    """Zero-pad to a width, keeping the rightmost characters of longer texts."""
    text = F.concat(F.lit("0" * width), F.trim(column.cast("string")))
    return F.right(text, F.lit(width))


def upc(category: Column) -> Column:
    return pad(category, CATEGORY_WIDTH)


def product_id(class_code: Column) -> Column:
    return pad(class_code, CLASS_WIDTH)


def sku_label(category: Column, class_code: Column) -> Column:
    return F.concat(upc(category), F.lit("-"), product_id(class_code))


def number_key(column: Column, digits: int) -> Column:
    """A padded text as the number it stands for; NULL when it is none."""
    return column.try_cast(f"decimal({digits},0)")


def branch_code(branch_name: Column) -> Column:
    """The code that follows the two-letter prefix of a branch name."""
    return F.substring(branch_name, 3, 10)


def has_tag_number(asset_id: Column) -> Column:
    return asset_id.rlike("_[0-9]")


def tag_number(asset_id: Column) -> Column:
    """The number after the last underscore, 0 when there is none."""
    suffix = F.substring_index(asset_id, "_", -1)
    return F.coalesce(suffix.try_cast("int"), F.lit(0))


def increase(now: Column, before: Column) -> Column:
    """How much a quantity rose; 0 when it fell or when either value is unknown."""
    return F.greatest(now - before, F.lit(0))


def stamp(ts: Column) -> Column:
    """A time as text to the millisecond."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")
