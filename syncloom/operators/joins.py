"""Joins the other operators are made of.

None carries a broadcast hint: the planner broadcasts a side whose size it knows to
be small and joins by sort-merge, with skewed partitions split, beyond that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from syncloom.schemas import BRANCH_KEYS

Keys = Sequence[str] | Mapping[str, str]


def _right_keys(right: DataFrame, keys: Keys, unique: bool) -> DataFrame:
    """The right side's key columns under the left side's names.

    Unless the right side has each key once, its copies go before the shuffle, so
    that a key with very many of them cannot overload a task.
    """
    if isinstance(keys, Mapping):
        chosen = right.select(*[F.col(theirs).alias(ours) for ours, theirs in keys.items()])
    else:
        chosen = right.select(*keys)
    return chosen if unique else chosen.distinct()


def keep_matching(
    left: DataFrame, right: DataFrame, keys: Keys, unique: bool = False
) -> DataFrame:
    """Rows of the left side whose key occurs on the right; never multiplies rows."""
    joined = left.join(_right_keys(right, keys, unique), list(keys), "left_semi")
    return joined.select(*left.columns)


def exclude(left: DataFrame, right: DataFrame, keys: Keys, unique: bool = False) -> DataFrame:
    """Rows of the left side whose key does not occur on the right."""
    joined = left.join(_right_keys(right, keys, unique), list(keys), "left_anti")
    return joined.select(*left.columns)


def enrich(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the left side with the columns of the right, NULL where it lacks the key.

    Meant for a small left side that is a table and a large right side, each with
    every key once: the right side is first cut down to the left side's keys,
    whose broadcast spares it a shuffle.
    """
    return left.join(keep_matching(right, left, keys, unique=True), list(keys), "left")


def in_active_branches(
    df: DataFrame, active: DataFrame, branch: str = "branch", company: str | None = "company"
) -> DataFrame:
    """Rows of active branches, by company and branch, or by branch alone."""
    keys = {branch: "branch"} if company is None else {company: "company", branch: "branch"}
    return keep_matching(df, active, keys, unique=company is not None)


def with_branch_id(
    df: DataFrame, active: DataFrame, branch: str = "branch", name: str = "location_id"
) -> DataFrame:
    """Rows of active branches with the branch's id."""
    ids = active.select(
        F.col("company"), F.col("branch").alias(branch), F.col("id").alias(name)
    )
    return df.join(ids, ["company", branch])


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    defaults: Mapping[str, Column],
    found: str | None = None,
) -> DataFrame:
    """Add right-side columns with defaults, and on demand a flag that the key was found.

    The right side holds each key once.
    """
    mark = "_found"
    side = right.select(
        *keys, *[F.col(c).alias(f"_r_{c}") for c in defaults], F.lit(True).alias(mark)
    )
    joined = left.join(side, list(keys), "left")
    for column, default in defaults.items():
        joined = joined.withColumn(column, F.coalesce(F.col(f"_r_{column}"), default))
    if found:
        joined = joined.withColumn(found, F.col(mark).isNotNull())
    return joined.drop(mark, *[f"_r_{c}" for c in defaults])


def project_map(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Map columns to another schema: output name to expression."""
    return df.select(*[expression.alias(name) for name, expression in columns.items()])


def distinct_keys(df: DataFrame, keys: Sequence[str] = BRANCH_KEYS) -> DataFrame:
    return df.select(*keys).distinct()


def union_rules(*frames: DataFrame) -> DataFrame:
    """All rows that any of the rules yields, each once."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result.distinct()
