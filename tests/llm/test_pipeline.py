"""The pipeline's stages, one after the other, against plain Python; and the registered queries."""

from __future__ import annotations

import ast
from collections import Counter

import corpus_pipeline
import pytest

import __spark_entry__ as entry
import check
from syncloom.llm import queries
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {"documents": docs.cache()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR).cache()
        found[name] = docs
    return found


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(stages):
    columns = stages["documents"].columns
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == columns
    assert stages["sharding"].columns == [*columns, "shard", "slot"]


def test_rules_drop_what_fails(stages):
    all_texts, kept = texts_of(stages["documents"]), texts_of(stages["quality_rules"])
    assert 0 < len(kept) < len(all_texts)
    assert not any(brute.quality(t)["base_failed"] for t in kept.values())


def test_one_document_of_each_group(stages):
    before, kept = texts_of(stages["quality_rules"]), texts_of(stages["ngram_jaccard_join"])
    assert set(kept) == {k for k, (_, first) in brute.components(before).items() if k == first}


def test_contaminated_documents_go(spark, stages):
    before = texts_of(stages["ngram_jaccard_join"])
    kept = texts_of(stages["benchmark_decontamination"])
    rows = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    bad = brute.decontaminate(before, {str(r.item_id): r.text for r in rows})
    assert set(kept) == {k for k, v in bad.items() if not v[4]}


def test_mixture_repeats_documents(stages):
    before, rows = stages["benchmark_decontamination"].collect(), stages["mixing"].collect()
    words, taken = Counter(), Counter()
    for r in before:
        words[r.source] += len(brute.WORD.findall(r.text))
    for r in rows:
        taken[r.source] += len(brute.WORD.findall(r.text))
    assert max(Counter(r.doc_id for r in rows).values()) <= 2
    largest = max(len(brute.WORD.findall(r.text)) for r in before)
    for source, goal in brute.targets(words).items():
        assert abs(taken[source] - goal) <= largest / 2


def test_all_rows_get_a_shard(stages):
    rows = stages["sharding"].collect()
    assert len(rows) == stages["mixing"].count()
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1


def test_run_gives_the_stages_rows(spark, stages):
    found = corpus_pipeline.run(spark, SF_DIR)
    columns = ["doc_id", "shard", "slot"]
    assert sorted(found.select(columns).collect()) == sorted(stages["sharding"].select(columns).collect())


@pytest.fixture(scope="module")
def db():
    return check.tables(SF_DIR)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"pipeline"}))
def test_query(spark, db, name):
    found = entry.queries()[name](spark, SF_DIR)
    if sql := entry.oracle_sql().get(name):
        _, problems = check.differences(found, db, sql)
        assert not problems
    else:
        assert found.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_no_import_error_is_swallowed():
    """Only the entry guards its import."""
    for module in (corpus_pipeline, queries):
        tree = ast.parse(open(module.__file__).read())
        assert not [n for n in ast.walk(tree) if isinstance(n, ast.Try)]
