"""The pipeline's stages on rows that are odd in every way, and the classifier's sums over all rows."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import pytest

from syncloom.llm import quality_model
from syncloom.llm.common import Scratch
from tests.llm.conftest import prose

SF_DIR = "/root/testdata/sf0.001"
GOOD = "the of and to in a is that " * 3 + prose(5, 90)


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, ids that are null or shared, repeated rows, columns of the stages' own names."""
    rows = [(1, GOOD, "a"), (1, GOOD, "a"), (1, GOOD + " more of it", None), (None, GOOD, "a"), (None, None, None)]
    rows += [(2, None, "b"), (3, "", "b"), (4, prose(9, 200, 4), "hot"), (5, " \n ", "hot")]
    ddl = "doc_id long, text string, source string, shard string, slot int, similar int, mix int, quality int, contamination int, _side int"
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5, 6) for r in rows], ddl).repartition(3)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_a_stage_on_odd_rows_and_on_none(spark, odd, name, stage):
    found = stage(spark, odd, SF_DIR)
    rows = found.collect()
    assert set(odd.columns) <= set(found.columns)
    if name == "quality_rules":
        assert len(rows) < odd.count() and all(r.text for r in rows)
    elif name == "ngram_jaccard_join":
        assert sum(r.text == GOOD for r in rows) + sum(r.text == GOOD + " more of it" for r in rows) == 1
        assert sum(not (r.text or "").strip() for r in rows) == 4
    elif name == "benchmark_decontamination":
        assert len(rows) == odd.count()
    elif name == "sharding":
        assert len(rows) == odd.count()
    assert stage(spark, odd.where("false"), SF_DIR).isEmpty()
    if name != "sharding":
        assert found.columns == odd.columns


def test_sums_over_all_rows_are_those_of_the_whole_matrix(spark, docs, texts):
    rows = Scratch(spark, "test").write(quality_model.featurised(docs.select("doc_id", "text")), "features")
    x = np.stack([quality_model.features(t.encode() if t is not None else None) for t in texts.values()])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-2
    w = np.random.default_rng(3).normal(0, 0.1, x.shape[1] + 1)
    work = lambda block: quality_model.risk_sums(block, w, mean, scale)
    found = quality_model.summed(rows.repartition(7), work, 1 + 2 * len(w))
    assert np.allclose(found, work(x))
    # The slope of the sums is the slope that the risk of plain Python has.
    u = quality_model._standard(x, mean, scale)
    p = u[:20]
    _, slope, part = quality_model.nn_risk(w, p, u, 0.3)
    assert part > 0
    sp = quality_model._sigmoid(p @ w)
    streamed = found[1 : len(w) + 1] / len(x) - 0.3 * p.T @ sp / len(p) - 0.3 * p.T @ (1 - sp) / len(p)
    assert np.allclose(streamed, slope)


def test_scores_are_the_models_own_and_their_mean_is_the_prior(spark):
    rng = np.random.default_rng(4)
    z = rng.normal(1, 2, 5000)
    edges = np.linspace(-30, 30, quality_model.BINS + 1)
    shift = quality_model.prior_shift(np.histogram(z, edges)[0].astype(float), edges, 0.4)
    assert quality_model._sigmoid(z + shift).mean() == pytest.approx(0.4, abs=2e-3)
    table = spark.createDataFrame([(i, prose(i, 30 + i)) for i in range(40)], "doc_id long, text string")
    model = quality_model.fit(table, table.select("doc_id").where("doc_id < 20"))
    again = {r.doc_id: r.score for r in quality_model.score(table, model).collect()}
    rows = quality_model.featurised(table)
    found = {r.doc_id: r.score for r in quality_model.score_features(rows, model).collect()}
    plain = {i: float(model.scores(quality_model.features(prose(i, 30 + i).encode())[None])[0]) for i in range(40)}
    assert again == pytest.approx(plain) and found == pytest.approx(plain)
