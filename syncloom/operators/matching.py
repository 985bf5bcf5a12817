"""Rule-based matching of two lists of customer sites."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from syncloom.functions.keys import branch_code
from syncloom.operators.joins import exclude, keep_matching, project_map, union_rules

# The equality rules from strictest to loosest.
SITE_RULES = (
    ("site_id",),
    ("company", "branch", "account", "job", "job_location"),
    ("company", "branch"),
    ("branch",),
)


def site_columns(address2: str = "address2") -> dict:
    """The columns of a site under the remote side's names, which are fixed values."""
    text = {
        "CompanyCode": "company",
        "AccountNumber": "account",
        "JobNumber": "job",
        "JobLocation": "job_location",
        "ContactName": "contact",
        "Name": "name",
        "Address1": "address1",
        "Address2": address2,
        "City": "city",
        "State": "state",
        "Zip": "zip",
    }
    columns = {"CJID": F.col("site_id"), "HQLocationID": F.col("location_id")}
    columns |= {name: F.col(source).cast("string") for name, source in text.items()}
    columns["OrderedByAreaCode"] = F.col("area_code").cast("int")
    columns["OrderedByPhone"] = F.col("phone").cast("int")
    columns["SalesRep"] = F.col("sales_rep").cast("string")
    columns["PONumber"] = F.col("po_number").cast("string")
    return columns


def _comparable(df: DataFrame, keys) -> DataFrame:
    """The key columns with account numbers as texts, as the remote side holds them."""
    return df.withColumn("account", F.col("account").cast("string")) if "account" in keys else df


def _rule_columns(remote: DataFrame) -> DataFrame:
    """The remote list with the columns that rules ask for, each combination once."""
    coded = remote.withColumn("branch", branch_code(F.col("branch_name")))
    names = dict.fromkeys(k for keys in SITE_RULES for k in keys)
    return coded.select(*names, "location_id").distinct()


def _locations(remote: DataFrame, keys) -> DataFrame:
    """Distinct keys and locations: remote sites that share a location do not multiply rows."""
    return remote.select(*keys, "location_id").distinct()


def _by_rule(sites: DataFrame, remote: DataFrame, keys) -> DataFrame:
    """Sites with the locations that one rule gives them."""
    return _comparable(sites, keys).join(_locations(remote, keys), list(keys))


def matched_pairs(sites: DataFrame, remote: DataFrame) -> DataFrame:
    """Ids of all sites and locations that any of the rules brings together."""
    remote = _rule_columns(remote)
    found = [_by_rule(sites, remote, keys).select("site_id", "location_id") for keys in SITE_RULES]
    return union_rules(*found)


class Factorised(NamedTuple):
    """All pairs that any rule finds, without the pairs: (site_id, group) and (group, location_id).

    A pair is a site and a location of a group that the site is in. Sites of a branch share one
    group, so rows grow with sites plus locations, not with their product.
    """

    members: DataFrame
    locations: DataFrame


def _group(kind: str, column: str) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.col(column).cast("string"))


def factorise_sites(
    sites: DataFrame, remote: DataFrame, stage: Callable[[DataFrame], DataFrame] = lambda df: df
) -> Factorised:
    """The union of all rules as groups of a branch, and of a site id for what its branch lacks."""
    remote = stage(_rule_columns(remote))
    by_branch = _locations(remote, ["branch"])
    by_id = _by_rule(sites.select("site_id", "branch").distinct(), remote.select("site_id", "location_id"), SITE_RULES[0])
    alone = stage(exclude(by_id.distinct(), by_branch, ["branch", "location_id"], unique=True))
    branches = keep_matching(sites.select("site_id", "branch").distinct(), by_branch, ["branch"])
    members = branches.select("site_id", _group("branch", "branch").alias("group")).unionByName(
        alone.select("site_id", _group("site", "site_id").alias("group")).distinct()
    )
    locations = by_branch.select(_group("branch", "branch").alias("group"), "location_id").unionByName(
        alone.select(_group("site", "site_id").alias("group"), "location_id").distinct()
    )
    return Factorised(members.distinct(), locations)


def expand_sites(found: Factorised, sites: DataFrame | None = None) -> DataFrame:
    """The pairs (site_id, location_id), of all sites or of those given."""
    members = found.members if sites is None else keep_matching(found.members, sites, ["site_id"])
    return members.join(found.locations, "group").select("site_id", "location_id").distinct()


def match_sites(
    sites: DataFrame,
    remote: DataFrame,
    mode: str = "first_rule",
    address2: str = "address2",
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Match sites to remote locations and map them to the remote columns.

    Equal rows of a site count once. ``stage`` may write the shrunken remote list,
    which every rule reads. ``union`` grows with the sites times the locations of a
    branch, so it is asked for by name.

    ``union`` gives every pair that any rule finds, once. A pair that agrees in
    company and branch, or in these and the job, also agrees in branch, so the
    first and the last rule find them all; what the first finds is left out where
    the last finds it too, which spares a distinct over the wide rows.
    ``first_rule`` gives each site the pairs of the strictest rule that finds any.
    """
    columns = site_columns(address2)
    sites = sites.distinct()
    if mode not in ("union", "first_rule"):
        raise ValueError(f"unknown mode {mode}")
    remote = stage(_rule_columns(remote))
    if mode == "union":
        by_branch = _locations(remote, ["branch"])
        by_id = _by_rule(sites, remote, SITE_RULES[0])
        only_by_id = exclude(by_id, by_branch, ["branch", "location_id"], unique=True)
        in_branch = sites.join(by_branch, "branch")
        return project_map(in_branch, columns).unionByName(project_map(only_by_id, columns))
    left, result = sites, None
    for rule, keys in enumerate(SITE_RULES, start=1):
        pairs = project_map(_by_rule(left, remote, keys), {**columns, "rule": F.lit(rule)})
        result = pairs if result is None else result.unionByName(pairs)
        left = exclude(_comparable(left, keys), _locations(remote, keys), list(keys))
    return result
