"""Line dedup, Jaccard join, token blocks and the classifier against plain Python."""

from __future__ import annotations

import json
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from syncloom.llm import jaccard_join, line_dedup, quality_model, token_blocks
from syncloom.llm.common import Scratch
from syncloom.llm.components import components
from tests.llm import brute
from tests.llm.conftest import altered, prose

public_tokenizers = pytest.importorskip("public_tokenizers")


# --- lines -------------------------------------------------------------------------------------


@pytest.mark.parametrize("least_docs, least_chars", [(10, 1), (2, 0), (1, 5)])
def test_line_bitmaps(docs, texts, least_docs, least_chars):
    found = line_dedup.line_bitmaps(docs, least_docs=least_docs, least_chars=least_chars)
    cut = found.withColumn("_kept", line_dedup.kept_text(found))
    expected = brute.dedup_lines(texts, least_docs, least_chars)
    for r in cut.select("doc_id", "_kept", "lines.*").collect():
        assert (r.n_lines, r.n_dropped, brute.sha(r._kept)) == expected[r.doc_id], r.doc_id
        keep = np.unpackbits(np.frombuffer(zlib.decompress(r.keep), np.uint8), count=r.n_lines)
        assert r.n_lines - keep.sum() == r.n_dropped


def test_first_occurrence_stays(docs, texts):
    found = line_dedup.line_bitmaps(docs, keep_first=True)
    dropped = {r.doc_id: r.n_dropped for r in found.select("doc_id", "lines.*").collect()}
    everywhere = brute.dedup_lines(texts)
    # Two lines are frequent: the shared one, and the whole text that copies have.
    assert sum(v[1] for v in everywhere.values()) - sum(dropped.values()) == 2
    assert dropped[400] == 1 and everywhere[400][1] == 2


def test_many_ranges_give_the_same(docs, spark):
    one = line_dedup.line_bitmaps(docs).select("doc_id", "lines.*")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 61)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        other = line_dedup.line_bitmaps(docs).select("doc_id", "lines.*").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(one.collect()) == sorted(other)


def test_lines_of_nulls_and_nothing(nulls, empty):
    found = line_dedup.line_bitmaps(nulls, least_docs=2)
    rows = found.withColumn("_kept", line_dedup.kept_text(found)).collect()
    assert len(rows) == nulls.count()
    # The text stands under id 1 and under null; copies under one id are one document.
    assert {r.lines.n_dropped for r in rows if r.text == "same text here"} == {1}
    assert {r._kept for r in rows if r.text == "same text here"} == {""}
    assert [r.lines.n_lines for r in rows if r.text is None] == [1]
    assert line_dedup.line_bitmaps(empty).isEmpty()


# --- similarity --------------------------------------------------------------------------------


def test_components_of_links(spark):
    links = [(i, i + 1) for i in range(1, 30)] + [(50, 40), (40, 60), (60, 50), (70, 70)]
    links += [(100, k) for k in range(101, 140)]
    table = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.component for r in components(table, Scratch(spark, "test")).collect()}
    assert found == {**{i: 1 for i in range(1, 31)}, 40: 40, 50: 40, 60: 40, **{k: 100 for k in range(100, 140)}}
    assert components(table.where("a < 0"), Scratch(spark, "test")).isEmpty()


def test_jaccard_join(docs, texts):
    found = jaccard_join.similar(docs).select("doc_id", "similar.*", "_side").collect()
    expected = brute.components(texts)
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_shingles, r.component) == expected[r.doc_id], r.doc_id
        assert r._side == r.doc_id
    assert len({r.component for r in found}) < len(texts) - 40


@pytest.mark.parametrize("block, frequent", [(2, 0), (5, 3), (2048, 1 << 16)])
def test_blocks_and_frequent_shingles_do_not_matter(docs, texts, monkeypatch, block, frequent):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    few = docs.where("doc_id between 100 and 330 or doc_id >= 900")
    kept = {k: t for k, t in texts.items() if 100 <= k <= 330 or k >= 900}
    found = jaccard_join.similar(few).select("doc_id", "similar.*").collect()
    assert {r.doc_id: (r.n_shingles, r.component) for r in found} == brute.components(kept)


def test_threshold_is_exact(spark):
    """Pairs on both sides of 80 percent, for many sizes."""
    texts, key = {}, 0
    for n in range(1, 60):
        words = [f"w{n}_{i}" for i in range(n + 4)]
        for cut in range(0, n // 3 + 1):
            texts[key] = " ".join(words[: n + 4 - cut])
            key += 1
        texts[key] = " ".join([*words[:-1], "other"])
        key += 1
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = jaccard_join.similar(table).select("doc_id", "similar.*").collect()
    assert {r.doc_id: (r.n_shingles, r.component) for r in found} == brute.components(texts)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(1, 400), st.integers(0, 400), st.integers(0, 2**32 - 1))
def test_bound_is_an_upper_bound(a, b, shared, seed):
    shared = min(a, b, shared)
    rng = np.random.default_rng(seed)
    values = np.unique(rng.integers(0, 2**63, a + b - shared, dtype=np.uint64))
    x, y = np.sort(values[:a]), np.sort(values[-b:])
    bits_x, bits_y = jaccard_join.bitmap(x), jaccard_join.bitmap(y)
    size = min(len(bits_x), len(bits_y))
    fold = jaccard_join._fold
    bound = jaccard_join.overlap_bound(fold(bits_x, size), fold(bits_y, size), len(x), len(y))
    assert bound >= len(np.intersect1d(x, y))


def test_one_of_each_group(docs, texts):
    kept = jaccard_join.first_of_each(jaccard_join.similar(docs))
    assert kept.columns == docs.columns
    expected = {k for k, (_, first) in brute.components(texts).items() if k == first}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)


def test_similarity_of_nulls_and_nothing(nulls, empty):
    found = jaccard_join.similar(nulls)
    rows = found.select("doc_id", "text", "similar.*").collect()
    assert len(rows) == nulls.count()
    assert {r.component for r in rows if r.text == "same text here"} == {1}
    assert {r.n_shingles for r in rows if r.text is None or r.text == ""} == {0}
    kept = sorted(map(str, jaccard_join.first_of_each(found).select("doc_id", "text").collect()))
    assert len(kept) == 4  # one of the copies, the other text, and the two without words
    assert jaccard_join.similar(empty).isEmpty()
    assert jaccard_join.first_of_each(jaccard_join.similar(empty)).isEmpty()


# --- token blocks ------------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(
    st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500),
    st.booleans(),
)
def test_segment_round_trip(ids, even):
    values = np.array([7] * len(ids) if even else ids, dtype=np.uint32)
    segment = token_blocks.Segment(token_blocks.encode_segment(values))
    assert (segment.read() == values).all() and len(segment.read()) == len(values)
    for block in range(segment.blocks):
        part = segment.read(np.array([block]))[: len(values) - block * 256]
        assert (part == values[block * 256 : (block + 1) * 256]).all()


def test_exceptions_keep_blocks_narrow():
    values = np.arange(256, dtype=np.uint32) % 16
    values[[3, 99]] = 50_000
    segment = token_blocks.Segment(token_blocks.encode_segment(values))
    assert segment.widths.tolist() == [4] and len(segment.places) == 2


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\r\x0b\x1c\x85\xa0 ab.'s1é", max_size=30), max_size=5))
def test_pieces_encode_like_whole_texts(tokenizer, texts):
    encoder = token_blocks._encoder(public_tokenizers.path("byte_bpe_50k.json"), 2)
    ids, counts = encoder.encode(texts)
    ends = np.cumsum(counts)
    for text, end, n in zip(texts, ends, counts, strict=True):
        assert ids[end - n : end].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [2]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.lists(
            st.one_of(
                st.sampled_from(["foo,", "Ünï", "le'au", "it's", "x1", "...", "end.\nNext", "a\n\nb", "<|endoftext|>"]),
                st.text(alphabet="abéßɏɐж中'!.,-_19\n\t\r\x00\x7f\x85\xa0\xad\u200b\u2028\u180e\ufeffĊĠ🙂", max_size=8),
            ),
            max_size=12,
        ).map(" ".join),
        max_size=6,
    ),
    st.booleans(),
)
def test_new_pieces_encode_like_whole_texts(tokenizer, texts, forget):
    """Whatever is new, known, or known from before."""
    encoder = token_blocks._encoder(public_tokenizers.path("byte_bpe_50k.json"), 2)
    if forget:
        encoder.clear()
    for _ in range(2):
        ids, counts = encoder.encode(texts)
        wanted = [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts))[:-1]] == wanted


@pytest.mark.parametrize("token", ["foo", "!?", "a b", "x\ny", "<x>", None])
def test_other_vocabularies_encode_like_whole_texts(tmp_path, token):
    """With an added token of any kind, or with cuts that are not known."""
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        described = json.load(file)
    if token:
        described["added_tokens"].append(described["added_tokens"][0] | {"id": 50257, "content": token})
    else:
        described["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [described["pre_tokenizer"]]}
    path = tmp_path / "vocabulary.json"
    path.write_text(json.dumps(described), encoding="utf-8")
    texts = ["fooy", "foo bar foo, !?", "a b a bb, x\ny", "one <x>two\nthree four.\n\nFive", "é!? foo\nfoo", ""]
    ids, counts = token_blocks.PieceEncoder(str(path), 2).encode(texts)
    whole = Tokenizer.from_file(str(path))
    wanted = [whole.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts))[:-1]] == wanted


def test_new_pieces_share_calls_of_the_tokenizer(tokenizer):
    """Not a text for each of them: its overhead was most of the work."""

    class Counted:
        texts = 0

        def __init__(self, held):
            self.held = held

        def encode_batch_fast(self, texts, add_special_tokens):
            Counted.texts += len(texts)
            return self.held.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    encoder = token_blocks.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"), 2)
    for name in {"tokenizer", "line_tokenizer"} & set(vars(encoder)):
        setattr(encoder, name, Counted(getattr(encoder, name)))
    words = [f"{a}{b}{c}" for a in "brém tol gas".split() for b in "aeiouäö" for c in ("x", "n,", "k's", "l.\nThen")]
    text = " ".join(words)
    assert encoder.encode([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [2]
    assert Counted.texts < len(words) / 4


def test_tokens_through_files(spark, docs, texts, tokenizer, tmp_path):
    path = str(tmp_path / "tokens")
    token_blocks.write_tokens(
        docs, path, public_tokenizers.path("byte_bpe_50k.json"), 2, segment_ids=500
    )
    found = {r.doc_id: r for r in token_blocks.read_documents(spark, path).collect()}
    arrays = {r.doc_id: r.ids for r in token_blocks.read_ids(spark, path).collect()}
    start = 0
    for key in sorted(texts):
        ids = tokenizer.encode(texts[key] or "", add_special_tokens=False).ids + [2]
        raw = np.array(ids, dtype="<u4").tobytes()
        r = found.pop(key)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(raw))
        assert arrays[key] == ids
        start += len(ids)
    assert not found


def test_tokens_of_nulls_and_nothing(spark, nulls, empty, tmp_path):
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    token_blocks.write_tokens(nulls, str(tmp_path / "nulls"), vocabulary, 2)
    rows = token_blocks.read_documents(spark, str(tmp_path / "nulls")).orderBy("start").collect()
    assert len(rows) == nulls.count() and rows[0].doc_id is None and rows[-1].doc_id == 2
    assert sum(r.n_tokens for r in rows[:-1]) == rows[-1].start
    token_blocks.write_tokens(empty, str(tmp_path / "empty"), vocabulary, 2)
    assert token_blocks.read_documents(spark, str(tmp_path / "empty")).isEmpty()


# --- classifier --------------------------------------------------------------------------------


def junk(seed: int) -> str:
    return " ".join(w + "###" if i % 2 else w.upper() + "!!" for i, w in enumerate(prose(seed, 80).split()))


def test_risk_never_counts_below_zero():
    rng = np.random.default_rng(1)
    p, u = rng.normal(2, 1, (50, 3)), rng.normal(2, 1, (50, 3))
    risk, _, part = quality_model.nn_risk(np.array([3.0, 3.0, 3.0]), p, u, 0.9)
    assert risk >= 0
    w = np.array([-1.0, 0.5, 0.2])
    risk, grad, part = quality_model.nn_risk(w, p, u, 0.3)
    assert part > 0
    for k in range(3):
        step = np.eye(3)[k] * 1e-6
        slope = (quality_model.nn_risk(w + step, p, u, 0.3)[0] - risk) / 1e-6
        assert slope == pytest.approx(grad[k], abs=1e-3)


def test_prior_from_scores():
    rng = np.random.default_rng(2)
    positive = rng.normal(3, 1, 4000)
    unlabelled = np.concatenate([rng.normal(3, 1, 2800), rng.normal(-3, 1, 1200)])
    assert quality_model.estimate_prior(positive, unlabelled) == pytest.approx(0.7, abs=0.06)


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, junk(i) if i % 5 == 0 else prose(i, 40 + i % 90), int(i % 5 > 0)) for i in range(800)]
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_held_out_documents_are_told_apart(labelled):
    learnt = ~quality_model.held_out(F.col("doc_id"))
    trusted = labelled.where(learnt & (F.col("quality") == 1)).where("doc_id % 3 = 0")
    model = quality_model.fit(labelled.where(learnt), trusted.select("doc_id"))
    assert 0.6 < model.prior <= 0.95
    rows = quality_model.score(labelled.where(~learnt), model).collect()
    right = sum((r.score >= 0.3) == bool(r.quality) for r in rows)
    assert len(rows) > 100 and right / len(rows) > 0.95
    again = quality_model.fit(labelled.where(learnt).repartition(3), trusted.select("doc_id"))
    assert np.allclose(model.weights, again.weights)


def test_held_out_fold(labelled):
    rows = labelled.select("doc_id", quality_model.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_scores_of_odd_rows(docs, nulls, empty, labelled):
    none = quality_model.fit(labelled, labelled.select("doc_id").where("doc_id < 0"))
    assert {r.score for r in quality_model.score(nulls, none).collect()} == {0.5}
    model = quality_model.fit(labelled, labelled.select("doc_id").where("quality = 1"))
    found = quality_model.score(docs, model).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    assert quality_model.score(empty, model).isEmpty()
    assert len(quality_model.score(nulls, model).collect()) == nulls.count()


def test_altered_is_near():
    text = prose(1, 200)
    a, b = brute.shingles(text), brute.shingles(altered(text, 1, 0.01))
    assert 0.5 < len(a & b) / len(a | b) <= 1
