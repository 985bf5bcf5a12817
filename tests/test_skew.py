import random

import pytest
from pyspark.sql import functions as F

from conftest import values
from syncloom.operators import quantity as qt, skew
from syncloom.operators.skew import hot_keys, latest
from syncloom.schemas import SKU_KEYS

SCHEMA = (
    "company string, branch string, category int, class_code int, event string, "
    "seq bigint, synced_at bigint, qty int"
)


def events(seed, rows=3000):
    """A third of all rows belong to one key; some quantities are NULL, some orders equal."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        branch = "0001" if rng.random() < 0.34 else f"{rng.randrange(2, 60):04d}"
        seq = i if rng.random() < 0.95 else max(0, i - 1)
        qty = None if rng.random() < 0.05 else rng.randrange(9)
        out.append(("01", branch, 1, 1, "EV", seq * 7, i, qty))
    rng.shuffle(out)
    return out


def brute_force(rows):
    """The quantity before each event, 0 before the first."""
    last, result = {}, []
    for row in sorted(rows, key=lambda r: (r[:4], r[5], r[6])):
        result.append((row[1], row[6], row[7], last.get(row[:4], 0)))
        last[row[:4]] = row[7]
    return sorted(result, key=repr)


@pytest.mark.parametrize("hot_rows, span", [(1_000_000, 1 << 20), (100, 500), (1, 7), (100, 10**9)])
def test_delta_is_the_same_however_hot_keys_are_sliced(spark, hot_rows, span):
    rows = events(seed=hot_rows + span)
    frame = spark.createDataFrame(rows, SCHEMA)
    deltas = qt.quantity_delta(frame, hot_rows=hot_rows, span=span)
    assert values(deltas, "branch", "synced_at", "qty", "prev_qty") == brute_force(rows)


@pytest.mark.parametrize("range_rows, span, files", [(1000, 20, 3), (1000, 1500, 2), (10_000, 20, 1)])
def test_tasks_of_slices_grow_with_the_rows_alone(spark, monkeypatch, range_rows, span, files):
    """Several ranges of several slices each: borders within and between ranges."""
    monkeypatch.setattr(skew, "RANGE_ROWS", range_rows)
    rows = events(seed=3)
    frame = spark.createDataFrame(rows, SCHEMA)
    order = ["seq", "synced_at"]
    assert len(skew.equal_slices(frame, SKU_KEYS, order, len(rows), span).inputFiles()) <= files
    deltas = qt.quantity_delta(frame, hot_rows=1, span=span)
    assert values(deltas, "branch", "synced_at", "qty", "prev_qty") == brute_force(rows)


def test_hot_slices_lie_in_different_partitions(spark):
    rows = events(seed=1)
    frame = spark.createDataFrame(rows, SCHEMA)
    plan = qt.quantity_delta(frame, hot_rows=100, span=500)
    hot = plan.where("branch = '0001'").groupBy(F.spark_partition_id()).count()
    whole = qt.quantity_delta(frame).where("branch = '0001'").groupBy(F.spark_partition_id()).count()
    assert whole.count() == 1
    spread = [r[1] for r in hot.collect()]
    assert sum(spread) == sum(r[1] == "0001" for r in rows)


def test_negative_and_huge_order_numbers(spark):
    rows = [("01", "1", 1, 1, "E", s, i, i) for i, s in enumerate([-5, -1, 0, 3, 2**60, 2**60 + 1])]
    frame = spark.createDataFrame(rows, SCHEMA)
    deltas = qt.quantity_delta(frame, hot_rows=1, span=2)
    assert values(deltas, "qty", "prev_qty") == [(0, 0), (1, 0), (2, 1), (3, 2), (4, 3), (5, 4)]


def test_hot_keys_are_those_with_many_rows(spark):
    frame = spark.createDataFrame(events(seed=2), SCHEMA)
    assert values(hot_keys(frame, SKU_KEYS, hot_rows=500), "branch") == [("0001",)]


def test_latest_keeps_one_row_per_key(spark):
    rows = [("a", 1, "old"), ("a", 3, "new"), ("a", 2, "mid"), ("b", 1, None)] + [("a", 1, "old")] * 50
    frame = spark.createDataFrame(rows, "k string, t int, v string")
    assert values(latest(frame, ["k"], ["t"])) == [("a", 3, "new"), ("b", 1, None)]
    assert latest(frame, ["k"], ["t"]).columns == frame.columns
