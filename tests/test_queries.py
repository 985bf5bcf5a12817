import pytest

import __spark_entry__ as entry
import check
from syncloom.queries import catalog, oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check.tables(SF_DIR)


def test_every_query_has_check_sql():
    assert set(catalog.QUERIES) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_gives_what_its_check_sql_gives(spark, db, name):
    found = entry.queries()[name](spark, SF_DIR)
    _, problems = check.differences(found, db, entry.oracle_sql()[name])
    assert not problems


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()


@pytest.mark.parametrize("more", [0, 1, 2, 3])
def test_exports_of_a_log_end_with_its_last_event(spark, tmp_path, more):
    """Also where its length is no multiple of four microseconds."""
    times = ["2024-01-01 00:00:00", "2024-01-09 12:00:00", "2024-01-20 00:00:00", f"2024-01-31 00:00:00.00000{more}"]
    rows = [(n, time, n % 2, "view") for n, time in enumerate(times)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string")
    events.withColumn("ts", events.ts.cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    found = catalog.QUERIES["stream_dedupe"](spark, str(tmp_path))
    assert sorted(r.event_id for r in found.collect()) == [0, 1, 2, 3]
