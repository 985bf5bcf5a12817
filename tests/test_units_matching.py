from decimal import Decimal

from pyspark.sql import functions as F

from conftest import frame, values
from syncloom.operators import units
from syncloom.operators.matching import SITE_RULES, match_sites, matched_pairs

KEY = "company string, branch string, category decimal(3,0), class_code decimal(4,0)"


def test_units_are_whole_and_counted_from_one(spark):
    table = frame(spark, [("a", q) for q in ("0", "0.5", "1", "2.75", "-3", None)], "k string, qty decimal(7,2)")
    found = [(float(q), n) for _, q, n in units.expand_units(table).collect()]
    assert sorted(found) == [(1.0, 1), (2.75, 1), (2.75, 2)]


def test_chunks_give_the_same_units(spark):
    table = frame(spark, [(q, float(q)) for q in (1, 9, 10, 11, 20, 21, 99, 100, 12345)], "k int, qty double")
    assert values(units.expand_units(table, chunk=10)) == values(units.expand_units(table))
    # Just below a whole unit beyond the chunk stays a single row.
    edge = frame(spark, [(1, 10.5), (2, 10.999), (3, 11.0)], "k int, qty double")
    counts = units.expand_units(edge, chunk=10).groupBy("k").agg(F.count("*"), F.max("unit_no"))
    assert values(counts) == [(1, 10, 10), (2, 10, 10), (3, 11, 11)]


def test_a_huge_row_is_spread_over_tasks(spark):
    table = frame(spark, [(1, 100_000.0)], "k int, qty double")
    spread = units.expand_units(table, chunk=100).groupBy(F.spark_partition_id()).count()
    assert spread.count() > 1
    assert spread.agg(F.sum("count")).first()[0] == 100_000


def test_highest_tag(spark):
    ids = ["AH34_0999_3", "AH34_0999_2", "A_1_x", "A_1_", "nounderscore", None]
    items = frame(spark, [("k", i) for i in ids] + [("m", "A_1_x"), ("n", "none")], "k string, asset_id string")
    assert values(units.max_tag(items, ["k"])) == [("k", 3), ("m", 0)]


def test_tags_go_on_from_the_highest(spark):
    """Two units of item AH34 at branch 999, whose highest tag is 3, get the tags 4 and 5."""
    to_send = frame(
        spark, [("01", "999", 1, 1, Decimal("1.5"), 0), ("01", "999", 1, 1, Decimal(1), 1), ("01", "1", 1, 1, Decimal("0.9"), 0)],
        f"{KEY}, qty decimal(18,2), source_rank int",
    )
    skus = frame(
        spark, [("01", "999", 1, 1, 7, 70), ("01", "1", 1, 1, 8, 80)], f"{KEY}, location_id bigint, sku_id bigint"
    )
    items = frame(spark, [(7, 70, "AH34_0999_3")], "location_id bigint, sku_id bigint, asset_id string")
    master = frame(
        spark, [("01", 1, 1, "AH34  ")], "company string, category decimal(3,0), class_code decimal(4,0), item string"
    )
    ranges = units.tag_ranges(to_send, units.sku_max_tags(skus, items), master)
    assert values(units.allocate_tags(ranges), "tag", "sku_id") == [("AH34_0999_4", 70), ("AH34_0999_5", 70)]


def test_tags_are_unique_and_as_many_as_units(spark):
    rows = [("01", str(b), 1, c, Decimal(q), r) for b in range(3) for c in range(3) for r in (0, 1) for q in ("2.9", "3")]
    to_send = frame(spark, rows, f"{KEY}, qty decimal(18,2), source_rank int")
    skus = to_send.select("company", "branch", "category", "class_code").distinct().withColumns(
        {"location_id": F.col("branch").cast("long"), "sku_id": F.col("class_code").cast("long"), "max_tag": F.lit(5)}
    )
    master = frame(
        spark, [("01", 1, c, f"I{c}") for c in range(3)], "company string, category decimal(3,0), class_code decimal(4,0), item string"
    )
    tags = units.allocate_tags(units.tag_ranges(to_send, skus, master))
    assert tags.count() == tags.select("tag").distinct().count() == sum(int(r[4]) for r in rows)
    assert tags.agg(F.min("tag_no"), F.max("tag_no")).first() == (6, 15)


SITE = (
    "site_id bigint, company string, branch string, account decimal(7,0), job string, job_location string, "
    "contact string, name string, address1 string, address2 string, city string, state string, zip string, "
    "area_code decimal(3,0), phone decimal(7,0), sales_rep decimal(6,0), po_number string"
)
REMOTE = (
    "site_id bigint, location_id bigint, company string, account string, job string, job_location string, branch_name string"
)


def site(number, company, branch, account):
    return (number, company, branch, account, "J1", "yard", "c", "n", "line 1", "line 2", "city", "ST", "1", 212, 5551234, 7, "P")


def lists(spark):
    sites = frame(
        spark, [site(1, "01", "0001", 11), site(2, "02", "0001", 12), site(3, "01", "0002", 13), site(4, "01", "0009", 14)], SITE
    )
    remote = frame(
        spark, [(1, 100, "01", "11", "J1", "yard", "PC0002"), (9, 200, "01", "11", "J1", "yard", "PC0001"),
         (8, 300, "01", "99", "J1", "yard", "PC0001"), (7, 300, "02", "99", "J1", "yard", "PC0001"),
         (3, 400, "01", "13", "J1", "yard", "PC0002"), (6, 100, "01", "55", "J1", "yard", "PC0001")],
        REMOTE,
    )
    return sites, remote


def brute_force(sites, remote):
    """The strictest rule that brings each pair together."""
    pairs = {}
    for s in sites.collect():
        for r in remote.collect():
            ours = {**s.asDict(), "account": str(s["account"])}
            theirs = {**r.asDict(), "branch": r["branch_name"][2:]}
            for rule, keys in enumerate(SITE_RULES, start=1):
                if all(ours[k] == theirs[k] for k in keys):
                    pair = (s["site_id"], r["location_id"])
                    pairs[pair] = min(rule, pairs.get(pair, rule))
    return pairs


def test_union_of_rules(spark):
    sites, remote = lists(spark)
    expected = sorted(brute_force(sites, remote))
    assert values(match_sites(sites, remote, mode="union"), "CJID", "HQLocationID") == expected
    twice = match_sites(sites.union(sites), remote, mode="union")
    assert values(twice, "CJID", "HQLocationID") == expected
    assert values(matched_pairs(sites, remote)) == expected


def test_first_rule(spark):
    sites, remote = lists(spark)
    pairs = brute_force(sites, remote)
    best = {s: min(rule for (o, _), rule in pairs.items() if o == s) for s, _ in pairs}
    expected = sorted((s, l, rule) for (s, l), rule in pairs.items() if rule == best[s])
    assert values(match_sites(sites, remote, mode="first_rule"), "CJID", "HQLocationID", "rule") == expected


def test_second_address_line(spark):
    sites, remote = lists(spark)
    assert {r[0] for r in match_sites(sites, remote).select("Address2").collect()} == {"line 2"}
    as_first = match_sites(sites, remote, address2="address1")
    assert {r[0] for r in as_first.select("Address2").collect()} == {"line 1"}
