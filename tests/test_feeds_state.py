import glob
import gzip
import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import at, frame, values
from syncloom.schemas import FEEDS
from syncloom.session import Workspace, shared_dir
from syncloom.sinks.feeds import nest_json, write_feed
from syncloom.sources import feeds
from syncloom.state.store import StateConflict, StateStore


def land(root, op, session, name, text, encoding="utf-8"):
    folder = feeds.feed_path(str(root), op, session)
    os.makedirs(folder, exist_ok=True)
    with gzip.open(f"{folder}/{name}.json.gz", "wb") as file:
        file.write(text.encode(encoding))


def test_documents_lines_and_single_objects(spark, tmp_path):
    rows = [{"ID": 1, "PC": "0001 "}, {"ID": 2}]
    land(tmp_path, "branches", "s1", "array", json.dumps(rows))
    land(tmp_path, "branches", "s1", "object", json.dumps({"ID": 3, "PC": "0003", "more": 1}))
    land(tmp_path, "branches", "s1", "empty", "[]")
    found = feeds.read_json_feed(spark, str(tmp_path), FEEDS["branches"], "s1", "branches", documents=True)
    assert values(found) == [(1, "0001 "), (2, None), (3, "0003")]
    land(tmp_path, "branches", "s2", "lines", "\n".join(json.dumps(r) for r in rows))
    lines = feeds.read_json_feed(spark, str(tmp_path), FEEDS["branches"], "s2", "branches")
    assert values(feeds.active_branches(lines)) == [("01", "0001", 1), ("01", None, 2)]


def test_wide_characters(spark, tmp_path):
    land(tmp_path, "branches", "s", "a", json.dumps([{"ID": 1, "PC": "é"}], ensure_ascii=False), "utf-16-le")
    found = feeds.read_json_feed(
        spark, str(tmp_path), FEEDS["branches"], "s", "branches", documents=True, encoding="UTF-16LE"
    )
    assert values(found) == [(1, "é")]


def test_a_value_that_does_not_fit(spark, tmp_path):
    land(tmp_path, "branches", "s", "a", json.dumps({"ID": "x", "PC": "1"}))
    args = (spark, str(tmp_path), FEEDS["branches"], "s", "branches")
    assert values(feeds.read_json_feed(*args, required=False, strict=False)) == [(None, "1")]
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        feeds.read_json_feed(*args, required=False).collect()


def test_required_and_optional_feeds(spark, tmp_path):
    args = (spark, str(tmp_path), FEEDS["skus"], "none", "skus")
    with pytest.raises(feeds.MissingFeed):
        feeds.read_json_feed(*args)
    assert feeds.read_json_feed(*args, required=False).isEmpty()
    land(tmp_path, "skus", "none", "a", "")
    with pytest.raises(feeds.MissingFeed):
        feeds.read_json_feed(*args)


def test_remote_lists_under_our_names(spark):
    skus = frame(
        spark, [(7, None, None, 1, "009 ", "0005"), (8, None, None, 1, "009", "0005")], FEEDS["skus"]
    )
    assert values(feeds.remote_skus(skus)) == [(1, "009", "0005", 8)]
    items = frame(spark, [(1, None, None, 2, 3, "t", "s", "A_1_2 ", True)], FEEDS["items"])
    assert values(feeds.remote_items(items)) == [(2, 3, "A_1_2")]


def test_json_columns(spark):
    table = spark.createDataFrame(
        [(1, '[{"a": 1, "b": "x"}, {"a": 2}]'), (2, '{"a": 3}'), (3, "[]"), (4, None)], "id int, doc string"
    )
    found = feeds.shred(table, "doc", "a bigint, b string", keep=["id"])
    assert values(found) == [(1, 1, "x"), (1, 2, None), (2, 3, None)]


def test_feed_goes_out_as_gzip_lines_and_comes_back(spark, tmp_path):
    ddl = "id bigint, name string, at timestamp_ntz"
    table = frame(spark, [(1, "a", at("2024-01-02 03:04:05")), (2, None, None)], ddl)
    path = write_feed(table, str(tmp_path), "units", "r1")
    assert write_feed(table, str(tmp_path), "units", "r1") == path
    lines = []
    for name in glob.glob(f"{path}/*.gz"):
        with gzip.open(name, "rt") as file:
            lines += file.read().splitlines()
    assert sorted(json.loads(line).get("id") for line in lines) == [1, 2]
    assert "name" not in json.loads(next(line for line in lines if '"id":2' in line))
    assert values(feeds.read_json_feed(spark, str(tmp_path), ddl, "r1", "units")) == values(table)


def test_an_empty_feed_has_no_rows(spark, tmp_path):
    ddl = "id bigint"
    assert write_feed(spark.range(0), str(tmp_path), "units", "r1") is None
    assert feeds.read_json_feed(spark, str(tmp_path), ddl, "r1", "units", required=False).isEmpty()


def test_an_empty_feed_replaces_one_with_rows(spark, tmp_path):
    ddl = "id bigint"
    assert write_feed(spark.range(1), str(tmp_path), "units", "r1")
    assert write_feed(spark.range(0), str(tmp_path), "units", "r1") is None
    assert feeds.read_json_feed(spark, str(tmp_path), ddl, "r1", "units", required=False).isEmpty()


def test_nested_documents_keep_every_row(spark):
    rows = [("p", i % 3, i, "x") for i in range(95)] + [("p", 1, 1, "copy")] * 40
    rows += [("q", 1, 1, "y"), (None, 5, 5, "z"), ("q", None, 7, "w")]
    table = spark.createDataFrame(rows, "parent string, kind int, id int, name string")
    whole = nest_json(table, ["parent"], ["id", "name"], "items")
    assert whole.count() == 3
    first = json.loads(whole.where("parent is null").first()["doc"])
    assert first == {"items": [{"id": 5, "name": "z"}]}
    split = nest_json(table, ["parent", "kind"], ["id", "name"], "items")
    docs = [json.loads(r["doc"]) for r in split.collect()]
    assert len(docs) == 6 and {(d.get("parent"), d.get("kind")) for d in docs} == {r[:2] for r in rows}
    found = [(d.get("parent"), d.get("kind"), i["id"], i["name"]) for d in docs for i in d["items"]]
    assert sorted(found, key=repr) == sorted(rows, key=repr)


TABLES = {"kept": "id bigint, v string", "log": "id bigint"}


def table(spark, *rows):
    return spark.createDataFrame(rows, TABLES["kept"])


def test_state_is_published_together_and_old_versions_stay_readable(spark, tmp_path):
    store = StateStore(spark, str(tmp_path), TABLES)
    assert store.read("kept").isEmpty() and not store.published("r1")
    first = store.begin("r1")
    first.overwrite("kept", table(spark, (1, "a")))
    first.append("log", spark.range(2))
    assert store.read("kept").isEmpty()
    first.publish()
    assert store.published("r1") and not store.published("r2")
    before = store.read("kept")
    second = store.begin("r2")
    # A table may be written from what it holds.
    second.overwrite("kept", before.unionByName(table(spark, (2, "b"))))
    second.append("log", spark.range(5, 6))
    second.publish()
    assert values(store.read("kept")) == [(1, "a"), (2, "b")]
    assert values(store.read("log")) == [(0,), (1,), (5,)]
    assert values(before) == [(1, "a")]
    assert values(second.read("kept")) == [(1, "a")]


def test_changed_rows_replace_those_of_their_key(spark, tmp_path):
    store = StateStore(spark, str(tmp_path), TABLES, keys={"kept": ["id"]})
    expected = {}
    for run in range(7):
        rows = [(run % 4, f"v{run}"), (10 + run, "new")]
        commit = store.begin(f"run {run}:00")
        commit.change("kept", table(spark, *rows))
        commit.append("log", spark.range(run, run + 1))
        commit.publish()
        expected.update(rows)
    assert store.folders("kept") == store.folders("log") == 7
    store.compact("kept", "tidy 1")
    store.compact("log", "tidy 2")
    store.compact("log", "tidy 3")  # nothing to do
    assert store.folders("kept") == store.folders("log") == 1
    assert values(store.read("kept")) == sorted(expected.items(), key=repr)
    assert values(store.read("log")) == sorted([(n,) for n in range(7)], key=repr)
    assert store.published("run 3:00") and store.published("tidy 1")
    assert not store.published("run 20:00") and not store.published("tidy 3")


def test_what_a_crash_left_does_not_stand_in_the_way(spark, tmp_path):
    store = StateStore(spark, str(tmp_path), TABLES)
    first = store.begin("r1")
    first.overwrite("kept", table(spark, (1, "a")))
    first.publish()
    (tmp_path / "_versions" / "_half-written").touch()
    os.makedirs(tmp_path / "kept" / "000000002-r2-0" / "_temporary" / "0")
    assert values(store.read("kept")) == [(1, "a")] and not store.published("r2")
    again = store.begin("r2")
    again.overwrite("kept", table(spark, (2, "b")))
    again.publish()
    assert values(store.read("kept")) == [(2, "b")] and store.published("r2")


def test_a_run_that_fails_leaves_the_state_and_may_start_over(spark, tmp_path):
    store = StateStore(spark, str(tmp_path), TABLES)
    broken = store.begin("r1")
    broken.overwrite("kept", table(spark, (1, "a")))
    bad = table(spark, (1, "a")).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    broken.overwrite("log", bad)
    with pytest.raises(Exception, match="lost"):
        broken.publish()
    assert store.read("kept").isEmpty()
    again = store.begin("r1")
    again.overwrite("kept", table(spark, (1, "b")))
    again.publish()
    assert values(store.read("kept")) == [(1, "b")]


def test_two_runs_cannot_publish_the_same_version(spark, tmp_path):
    store = StateStore(spark, str(tmp_path), TABLES)
    one, two = store.begin("r1"), store.begin("r2")
    one.overwrite("kept", table(spark, (1, "a")))
    two.overwrite("kept", table(spark, (1, "b")))
    one.publish()
    with pytest.raises(StateConflict):
        two.publish()
    assert values(store.read("kept")) == [(1, "a")]
    assert not store.published("r2")


@pytest.mark.parametrize("order", [("aa", "zz"), ("zz", "aa")])
def test_of_two_runs_that_race_one_is_published(spark, tmp_path, order):
    """Both have written their tables and looked at the versions before either creates the pointer."""
    store = StateStore(spark, str(tmp_path), TABLES)
    commits = {}
    for name in ("aa", "zz"):
        commits[name] = store.begin(name)
        commits[name].overwrite("kept", table(spark, (1, name)))
    first, second = order
    commits[first].publish()
    with pytest.raises(StateConflict):
        commits[second].publish()
    assert values(store.read("kept")) == [(1, first)]
    assert store.published(first) and not store.published(second)
    again = store.begin(second)
    again.overwrite("kept", table(spark, (1, second)))
    again.publish()
    assert values(store.read("kept")) == [(1, second)] and store.published(first)


def test_racing_threads_publish_one_pointer(spark, tmp_path):
    store = StateStore(spark, str(tmp_path), TABLES)
    store._create_once("_versions/000000001.json", '{"runs": [], "folders": {}}')
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: store._create_once("_versions/000000002.json", f'"{i}"'), range(24)))
    assert sum(made) == 1
    assert [f for f in os.listdir(tmp_path / "_versions") if f[0] not in "._"] == ["000000001.json", "000000002.json"]


def test_plan_of_many_changes_is_bounded(spark, tmp_path):
    store = StateStore(spark, str(tmp_path), TABLES, keys={"kept": ["id"]})
    sizes = []
    for run in range(14):
        commit = store.begin(f"r{run}")
        commit.change("kept", table(spark, (run % 5, f"v{run}")))
        commit.publish()
        plan = store.read("kept")._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(len(plan.splitlines()))
    assert sizes[3] == sizes[-1]
    assert values(store.read("kept")) == [(i, f"v{i + 10 if i < 4 else 9}") for i in range(5)]


def test_staged_tables_lie_in_the_shared_folder(spark):
    work = Workspace(spark, "r1")
    staged = work.stage(spark.range(3), "three")
    assert work.path("three").startswith(shared_dir(spark))
    assert staged.count() == 3 and os.path.exists(work.path("three"))
