"""The conversation trie and fill-in-middle against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from syncloom.llm import fill_middle, prefix_trie
from tests.llm import brute

# --- trie --------------------------------------------------------------------------------------


def branching(seed: int, n: int) -> dict[int, list[tuple[str, str]]]:
    """Conversations that share beginnings, copies, prefixes of others, and some of many turns."""
    rng = random.Random(seed)
    found: dict[int, list] = {}
    for c in range(n):
        kind = rng.random()
        if found and kind < 0.6:
            base = found[rng.choice(list(found))]
            turns = list(base[: rng.randint(0, len(base))])
        else:
            turns = []
        more = rng.choice([0, 3, 70] if c % 9 == 0 else [0, 1, 2, 3])
        for _ in range(more):
            turns.append((rng.choice(["user", "assistant"]), " ".join("ab"[: rng.randint(0, 2)] for _ in range(rng.randint(0, 3)))))
        found[c * 7 + 3] = turns
    return found


def table_of(spark, conversations):
    rows = [
        (c, i * 2 - 3 if i else None, role, text, "x")
        for c, turns in conversations.items()
        for i, (role, text) in enumerate(turns)
    ]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, words string").repartition(7)


def nodes_of(conversations, ordered, container):
    nodes, ends = prefix_trie.prefix_trie(conversations, ordered, container)
    found = nodes.join(prefix_trie.ends_digests(ends), ["a", "b"], "left")
    rows = found.select(
        "least", "depth", "parent", "n", "children", "leaves", "saved",
        F.coalesce("ends_sha256", F.lit(brute.sha(""))).alias("sha"),
    ).collect()
    assert len(set(map(tuple, rows))) == len(rows)
    return set(map(tuple, rows))


@pytest.mark.parametrize("seed, container", [(1, 60), (2, 1 << 11)])
def test_trie(spark, seed, container):
    conversations = branching(seed, 60)
    ordered = prefix_trie.ordered_turns(table_of(spark, conversations))
    every = spark.createDataFrame([(c,) for c in conversations], "conversation long")
    assert nodes_of(every, ordered, container) == brute.trie(conversations)


def test_one_long_conversation_and_many_copies(spark):
    long = [("user", f"turn {i // 2}") for i in range(700)]
    conversations = {i: list(long[:650]) for i in range(40)} | {100: long, 101: long[:64], 102: long[:65], 103: []}
    ordered = prefix_trie.ordered_turns(table_of(spark, conversations))
    every = spark.createDataFrame([(c,) for c in conversations], "conversation long")
    assert nodes_of(every, ordered, 1 << 11) == brute.trie(conversations)


def test_positions_over_many_parts(spark):
    """A conversation that most rows belong to is spread over parts and still numbered through."""
    rows = [(5, i, "u", str(i)) for i in range(3000)] + [(c, i, "u", "x") for c in range(40) for i in range(c % 4)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 23)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = prefix_trie.ordered_turns(table)
        found = ordered.groupBy("conversation").agg(
            F.count("*").alias("n"), F.countDistinct("position").alias("d"), F.max("position").alias("m")
        ).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = {r.conversation: r.n for r in found}
    assert all(r.n == r.d == r.m + 1 for r in found)
    assert sizes[5] == 3001 and set(sizes) == {c for c in range(40) if c % 4} | {5}


def test_openings(spark):
    conversations = {20: [("u", "a"), ("v", "b")], 21: [("u", str(i)) for i in range(5)], 45: [("u", "z")], 40: []}
    ordered = prefix_trie.ordered_turns(table_of(spark, conversations))
    rows = [(20, 20, 2), (21, 20, 3), (45, 40, 1)]
    openings = spark.createDataFrame(rows, "conversation long, base long, taken long")
    turns = prefix_trie.with_openings(ordered, openings, 3).collect()
    kept = {}
    for r in sorted(turns, key=lambda r: (r.conversation, r.position)):
        kept.setdefault(r.conversation, []).append(r.position)
    assert kept == {20: [0, 1], 21: [0, 1, 2, 3]}


def test_trie_of_nulls_and_nothing(spark):
    ddl = "conv_id long, turn long, role string, text string, a long"
    rows = [(1, None, None, None, 0), (1, None, "", "", 0), (2, 1, None, "", 0), (None, 1, "u", "x", 0), (3, 2, "u", "w " * 40000, 0)]
    ordered = prefix_trie.ordered_turns(spark.createDataFrame(rows, ddl))
    expected = {1: [("", "")] * 2, 2: [("", "")], 3: [("u", "w " * 40000)]}
    every = prefix_trie.conversations_of(ordered)
    assert nodes_of(every, ordered, 1 << 11) == brute.trie(expected)
    nothing = prefix_trie.ordered_turns(spark.createDataFrame([], ddl))
    assert nodes_of(prefix_trie.conversations_of(nothing), nothing, 8) == set()
    lone = spark.createDataFrame([(4,), (9,)], "conversation long")
    assert nodes_of(lone, nothing, 8) == {(4, 0, None, 2, 0, 1, 0, brute.sha("4,9"))}


# --- fill in the middle ------------------------------------------------------------------------


def test_fill_in_middle(docs, texts):
    more = docs.unionByName(
        docs.where("doc_id < 5").withColumns({"doc_id": F.col("doc_id") + 5000, "text": F.lit("has <S> in it " * 9)})
    )
    texts = texts | {5000 + i: "has <S> in it " * 9 for i in range(5)}
    again = fill_middle.restored(F.col("fim.output"), F.col("fim.form")).alias("again")
    found = fill_middle.fill_in_middle(more).select("doc_id", "fim.*", again, "_side").collect()
    assert len(found) == len(texts)
    for r in found:
        expected = brute.fill_in_middle(r.doc_id, texts[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected, r.doc_id
        assert r.again == (texts[r.doc_id] or "")
    assert {r.form for r in found} == {"plain", "spm", "psm"}


def test_all_rows_transformed_by_lines(docs, texts):
    found = fill_middle.fill_in_middle(docs, rate=100, spm=0, unit="lines", out="text_cut")
    again = fill_middle.restored(F.col("text_cut.output"), F.col("text_cut.form")).alias("again")
    for r in found.select("doc_id", "text_cut.*", again).collect():
        text = texts[r.doc_id] or ""
        assert r.again == text and r.form == ("psm" if text else "plain")
        assert r.n == len(text.split("\n")) - (not text or text.endswith("\n"))
        if text:
            prefix = text[: r.prefix_chars]
            assert not prefix or prefix.endswith("\n") or prefix == text


def test_fill_in_middle_of_nulls_and_nothing(nulls, empty):
    found = fill_middle.fill_in_middle(nulls, rate=100).select("doc_id", "text", "fim.*").collect()
    assert len(found) == nulls.count()
    for r in found:
        assert (r.n, r.output) == (0, "") if not r.text else r.form != "plain"
    assert len({r.output for r in found if r.doc_id == 1}) == 2
    assert fill_middle.fill_in_middle(empty).isEmpty()
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(nulls, unit="pages")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tab.é😀1", max_size=70), min_size=1, max_size=6), st.randoms())
def test_units_are_found_anywhere(texts, rng):
    units = fill_middle.Units(texts)
    tokens = [brute.TOKEN.findall(t) for t in texts]
    assert units.n.tolist() == [len(t) for t in tokens]
    k = np.array([rng.randint(0, len(t)) for t in tokens])
    assert units.after(k).tolist() == [len("".join(t[:j])) for t, j in zip(tokens, k, strict=True)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 7), max_size=300), st.data())
def test_ranks(symbols, data):
    matrix = fill_middle.WaveletMatrix(np.array(symbols, dtype=np.uint8))
    a, b = sorted((data.draw(st.integers(0, len(symbols))), data.draw(st.integers(0, len(symbols)))))
    for s in range(8):
        assert matrix.rank(s, np.array([a]), np.array([b]))[0] == symbols[a:b].count(s)
