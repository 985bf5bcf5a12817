"""Quality rules, mixing, sharding and decontamination against plain Python."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from syncloom.llm import decontamination, mixing, quality_rules, sharding
from tests.llm import brute
from tests.llm.conftest import prose


def test_measures(docs, texts):
    for row in quality_rules.judge(docs).select("doc_id", "quality", "_side").collect():
        found, expected = row.quality.asDict(), brute.quality(texts[row.doc_id])
        assert {k: found[k] for k in expected} == expected, row.doc_id
        assert row._side == row.doc_id
        assert not (found["base_failed"] and found["kept"])


def test_rules_reject_symbols_and_keep_prose(docs, texts):
    kept = {r.doc_id for r in quality_rules.keep_good(docs).select("doc_id").collect()}
    assert 907 not in kept and 908 not in kept and 900 not in kept
    prose_ids = {k for k in range(60) if len(texts[k].split()) >= 50}
    stops = set(quality_rules.STOP_WORDS)
    rich = {k for k in prose_ids if any(w in stops for w in texts[k].split())}
    assert {k for k in rich if sum(w in stops for w in texts[k].split()) * 100 >= len(texts[k].split())} <= kept


def test_rules_are_data(docs):
    rules = (quality_rules.Rule("long", "n_words", 100, None),)
    kept = quality_rules.keep_good(docs, rules=rules)
    assert kept.columns == docs.columns
    assert min(len(r.text.split()) for r in kept.collect()) >= 100


def test_rules_on_nulls_and_nothing(nulls, empty):
    assert quality_rules.judge(nulls).count() == nulls.count()
    assert quality_rules.keep_good(empty).isEmpty()


def mixed(docs, **options):
    size = mixing.count_white_words(F.col("text"))
    sizes = mixing.source_sizes(docs, "source", size)
    return mixing.mix(docs, mixing.cyclic_weights(sizes, (5.0, 2.0, 1.0)), size=size, **options)


def test_mixture(docs, texts):
    rows = mixed(docs).select("doc_id", "source", "mix.*").collect()
    assert len(rows) == len(texts)
    size, taken, target, largest = Counter(), Counter(), {}, Counter()
    for r in rows:
        assert r.size == len(brute.WORD.findall(texts[r.doc_id] or ""))
        assert r.taken == r.size * r.copies and r.taken <= 2 * r.size
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
    expected = brute.targets(size)
    for s in size:
        assert target[s] == pytest.approx(expected[s])
        assert abs(taken[s] - target[s]) <= largest[s] / 2
    again = {r.doc_id: r.copies for r in mixed(docs.repartition(3)).select("doc_id", "mix.*").collect()}
    assert again == {r.doc_id: r.copies for r in rows}


def test_repetitions(docs):
    found = mixed(docs, out="m")
    copies = {r.doc_id: r.copies for r in found.select("doc_id", "m.copies").collect() if r.copies}
    rows = mixing.repeat_rows(found, "m")
    assert rows.columns == docs.columns
    assert Counter(r.doc_id for r in rows.collect()) == Counter(copies)


@pytest.mark.parametrize("sizes", [(100, 1, 1), (10, 10, 10), (0, 5, 1000), (7,), (3, 0)])
def test_water_fill(spark, sizes):
    names = [None, *"abcdef"][: len(sizes)]
    table = spark.createDataFrame(list(zip(names, sizes)), "source string, size long")
    filled = mixing.water_fill(mixing.cyclic_weights(table, (5.0, 2.0, 1.0)), 1.5, 2.0)
    found = {r.source: r.target for r in filled.collect()}
    assert found == pytest.approx(brute.targets(dict(zip(names, sizes))))


def test_mixture_of_nulls_and_nothing(nulls, empty):
    rows = mixed(nulls).select("mix.*").collect()
    assert len(rows) == nulls.count() and all(r.taken <= 2 * r.size for r in rows)
    assert mixed(empty).isEmpty()


@pytest.mark.parametrize("rows_per_window", [20_000, 5])
def test_shards(docs, texts, rows_per_window):
    found = sharding.shard(docs, 8, rows_per_window=rows_per_window)
    assert sorted(found.columns) == sorted([*docs.columns, "slot"])
    slots, mixture = defaultdict(list), defaultdict(Counter)
    rows = found.collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        slots[r.shard].append(r.slot)
        mixture[r.source][r.shard] += 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    for counts in mixture.values():
        each = [counts[k] for k in range(8)]
        assert max(each) - min(each) <= 3
    again = sharding.shard(docs.repartition(2), 8, rows_per_window=rows_per_window).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_window_size_does_not_matter(docs):
    one = sharding.shard(docs, 5).select("doc_id", "shard", "slot")
    other = sharding.shard(docs, 5, rows_per_window=3).select("doc_id", "shard", "slot")
    assert sorted(one.collect()) == sorted(other.collect())


def test_shards_of_nulls_and_nothing(nulls, empty):
    rows = sharding.shard(nulls, 3).collect()
    assert len(rows) == nulls.count()
    assert Counter(r.shard for r in rows) == Counter(i * 3 // len(rows) for i in range(len(rows)))
    assert sharding.shard(empty, 3).isEmpty()
    assert Counter(r.shard for r in sharding.shard(nulls, 50).collect()).most_common(1)[0][1] == 1


@pytest.fixture(scope="module")
def items(spark, texts):
    """Passages of the documents, whole and cut, short ones, and such that never occur."""
    words = lambda k, a, b: " ".join(texts[k].split()[a:b])
    rows = [
        ("p0", words(0, 0, 30)),
        ("p1", words(100, 20, 45).upper() + "!"),
        ("p2", words(300, 35, 70)),
        ("p3", words(3, 0, 13).replace(" ", " -- ")),
        ("p4", words(4, 0, 12) + " never"),
        ("short", "shared line here"),
        ("one", "ONE"),
        ("nothing", "..."),
        ("null", None),
        (None, words(5, 0, 20)),
        ("far", prose(77, 30)),
        ("p0", words(6, 0, 20)),
        ("p0", words(0, 0, 30)),
    ]
    return spark.createDataFrame(rows, "item_id string, text string")


def expected_hits(texts, items):
    by_text = [(r.item_id, r.text) for r in items.collect() if r.item_id is not None]
    parts = [brute.windows_of(t) for _, t in by_text]
    return {
        k: brute.hits_of(t, [(i, w) for (i, _), w in zip(by_text, parts, strict=True)])
        for k, t in texts.items()
    }


def test_contamination(docs, texts, items):
    expected = expected_hits(texts, items)
    for r in decontamination.contamination(docs, items, out="found").select("doc_id", "found.*").collect():
        assert (r.n_words, r.n_hit, r["items"], r.contaminated) == expected[r.doc_id], r.doc_id


def test_dropping_keeps_columns(docs, texts, items):
    kept = decontamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    bad = {k for k, v in expected_hits(texts, items).items() if v[3]}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == set(texts) - bad


def test_contamination_without_items_or_documents(docs, empty, nulls, items):
    none = decontamination.contamination(nulls, items.where("item_id = 'nothing'"))
    assert {r.contaminated for r in none.select("contamination.*").collect()} == {False}
    assert decontamination.contamination(empty, items).isEmpty()
    short = items.sparkSession.createDataFrame([("x", "Same text")], "item_id string, text string")
    found = decontamination.contamination(nulls, short).select("doc_id", "text", "contamination.n_hit")
    assert {r.n_hit for r in found.collect() if r.text == "same text here"} == {2}


def test_index_and_proximity(spark):
    docs = spark.createDataFrame(
        [(1, "alpha beta gamma delta"), (2, "alpha x beta y gamma delta"), (3, "beta beta")],
        "doc_id long, text string",
    ).withColumn("doc_key", F.col("doc_id"))
    index = decontamination.postings(docs).cache()
    found = {(r.term, r.doc_key, r.position) for r in index.collect()}
    assert ("gamma", 2, 4) in found and ("beta", 3, 1) in found and len(found) == 12
    items = decontamination.item_words(
        spark.createDataFrame([("i", "alpha beta gamma")], "item_id string, text string")
    )
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    rarest = decontamination.rarest_terms(items, decontamination.item_windows(items), counts)
    exact = decontamination.alignments(index, rarest)
    assert [(r.doc_key, r["shift"]) for r in exact.collect()] == [(1, 0)]
    near = decontamination.alignments(index, rarest, slop=4)
    assert {r.doc_key for r in near.collect()} == {1, 2}


def nearby(docs: dict, items: dict, counts: Counter, slop: int, depth: int = 3, width: int = 13) -> dict:
    """By document: items of which enough rarest words stand within a cell of so many words."""
    found = defaultdict(set)
    for name, words in items.items():
        anchors, needed = set(), []
        for first in range(max(1, len(words) - width + 1)):
            places = range(first, min(first + width, len(words)))
            if all(counts[words[p]] for p in places):
                rare = sorted(places, key=lambda p: (counts[words[p]], words[p], p))[:depth]
                anchors |= {(p, words[p]) for p in rare}
                needed.append(len(rare))
        for key, text in docs.items():
            cells = defaultdict(set)
            for at, word in enumerate(text):
                for place in (p for p, w in anchors if w == word):
                    shift = at - place
                    cells[shift // slop * slop].add(place)
                    cells[(shift + slop // 2) // slop * slop - slop // 2].add(place)
            if needed and any(len(c) >= min(needed) for c in cells.values()):
                found[key].add(name)
    return found


def test_items_that_stand_nearby(spark, docs, texts):
    passage = prose(1001, 60).split(" ")
    items = {"exact": passage[5:30], "gaps": [w for i, w in enumerate(passage[10:40]) if i % 7], "none": "zz yy xx".split()}
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id string, text string")
    words = {k: brute.TERM.findall((t or "").translate(brute.LOWER)) for k, t in texts.items()}
    items = {k: brute.TERM.findall(" ".join(w).translate(brute.LOWER)) for k, w in items.items()}
    counts = Counter(w for t in words.values() for w in t)
    expected = nearby(words, items, counts, 8)
    rows = decontamination.contamination(docs, table, slop=8).select("doc_id", "contamination.*").collect()
    assert {r.doc_id: set(r.near) for r in rows if r.near} == dict(expected)
    assert any("gaps" in r.near and "gaps" not in r.items for r in rows)
    assert all(set(r.items) <= set(r.near) for r in rows)
    plain = decontamination.contamination(docs, table).select("contamination.near").collect()
    assert all(r.near == [] for r in plain)
