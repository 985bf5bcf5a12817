"""Personal data: the rules against their patterns, the network against held-out examples."""

from __future__ import annotations

import random
from dataclasses import replace

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from syncloom.llm import personal_data as pd_, queries
from syncloom.llm.personal_data import KINDS
from tests.llm import brute


def named_spans(spans):
    return [(KINDS[k], a, b) for k, a, b in spans]


PLAIN = (
    "mail jo.doe+x@mail8.example.com, or a@b.c_d@e.f; not @home, x@y, x@y..z. 1.2.3.4.5.6.7.8 and 999.1.1.1"
    " 4111 1111 1111 1111 and 4111-1111-1111-1112, +1 (766) 555-2373, + 1, +12, +1 2345 67 (8) 9-."
)


@pytest.fixture(scope="module")
def net():
    return pd_.train(*pd_.arrays(pd_.examples([], 1200, 5)), steps=320, seed=5)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="019 .-+()@a_é\n", max_size=60))
def test_rules(text):
    assert named_spans(pd_.base_spans(text)) == brute.personal(text)


def test_rules_on_words(texts):
    for text in [PLAIN, *filter(None, texts.values())]:
        assert named_spans(pd_.base_spans(text)) == brute.personal(text)
    assert len(pd_.base_spans(PLAIN)) == 7


@pytest.mark.parametrize("piece", ["1", "1.", "a", "+1 ", "1 ", "a@", "(at)", "1.1.1."])
def test_rules_take_long_runs_in_their_stride(piece):
    text = piece * 60_000
    found = pd_.base_spans(text)
    assert all(0 <= a < b <= len(text) for _, a, b in found)


def test_gradients():
    x, y = pd_.arrays(pd_.made_up(5, 1))
    net = pd_.untrained(3, hidden=6)
    _, slope = pd_.loss_and_gradients(net, x, y)
    for name in ("tables", "recurrent", "output", "moves"):
        g = getattr(slope, name).ravel()
        for i in np.argsort(-np.abs(g))[:5]:
            sides = []
            for e in (1e-5, -1e-5):
                w = getattr(net, name).copy()
                w.ravel()[i] += e
                sides.append(pd_.loss_and_gradients(replace(net, **{name: w}), x, y)[0])
            assert abs((sides[0] - sides[1]) / 2e-5 - g[i]) < 1e-4


def test_crf_against_all_sequences():
    rng = np.random.default_rng(1)
    scores, moves = rng.normal(size=(1, 3, pd_.LABELS)), rng.normal(size=(pd_.LABELS + 1, pd_.LABELS))
    full = moves + pd_._FORBIDDEN
    every = {}
    for path in np.ndindex(*[pd_.LABELS] * 3):
        total = full[-1, path[0]] + sum(scores[0, t, p] for t, p in enumerate(path))
        every[path] = total + sum(full[a, b] for a, b in zip(path, path[1:], strict=False))
    values = np.array(list(every.values()))
    probability, _, total = pd_.marginals(scores, moves)
    assert np.isclose(total[0], np.logaddexp.reduce(values))
    assert tuple(pd_.best_labels(scores, moves)[0]) == max(every, key=every.get)
    weights = np.exp(values - total[0])
    for label in range(pd_.LABELS):
        share = sum(w for p, w in zip(every, weights, strict=True) if p[1] == label)
        assert np.isclose(probability[0, 1, label], share)


def test_windows_hold_every_seed():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab 1") if rng.random() < 0.1 else "x" for _ in range(n)) for n in (0, 1, 63, 64, 65, 96, 97, 500)]
    points, bounds = pd_.points_of(texts)
    rows, starts = pd_.windows_of(pd_.seeds_of(points, texts, bounds), bounds)
    found = set(zip(rows.tolist(), starts.tolist(), strict=True))
    for r, text in enumerate(texts):
        grid = [0]
        while grid[-1] + pd_.WINDOW < len(text):
            grid.append(grid[-1] + pd_.STRIDE)
        wanted = {(r, s) for s in grid if any(c.isdigit() for c in text[s : s + pd_.WINDOW])}
        assert {f for f in found if f[0] == r} == wanted


def test_held_out_examples(net):
    held = [e for e in pd_.made_up(500, 77)]
    whole = found = extra = 0
    for (text, spans), (own, more) in zip(held, pd_.find_all([t for t, _ in held], net), strict=True):
        gold = {s for s in spans if s[1] >= 0 and s[2] <= len(text)}
        whole, found = whole + len(gold), found + len(gold & (set(own) | set(more)))
        extra += sum(all(b <= x or y <= a for _, x, y in spans) for _, a, b in more)
    assert found > 0.85 * whole
    assert extra < 0.03 * len(held)


def test_spans_longer_than_a_stride_and_far_into_a_text(net):
    filler = "plain words without anything of note " * 3000
    mail = "somebody.with.a.rather.long.name [at] department.of.words [dot] example"
    text = f"{filler}write to {mail} or (640) 555-0953 soon. {filler}"
    ((own, more),) = pd_.find_all([text], net)
    assert own == []
    assert {text[a:b] for _, a, b in more} >= {"(640) 555-0953"}
    assert all(a >= len(filler) - 1 and b <= len(text) - len(filler) for _, a, b in more)


def test_rules_stay_and_nothing_overlaps(net, texts):
    every = [t or "" for t in texts.values()] + [PLAIN, PLAIN * 30]
    for text, (own, more) in zip(every, pd_.find_all(every, net), strict=True):
        assert named_spans(own) == brute.personal(text)
        taken = sorted((a, b) for _, a, b in more)
        assert all(b <= x for (_, b), (x, _) in zip(taken, taken[1:], strict=False))
        assert all(b <= x or y <= a for a, b in taken for _, x, y in own)


def test_reconcile_takes_the_heaviest_set():
    text = "call 640-555-0953-1 now, 640-555-0954"
    proposed = [(3, 5, 17, 3.0), (3, 5, 19, 2.0), (3, 25, 37, 1.0), (3, 25, 37, 0.5)]
    assert pd_.reconcile(text, [], proposed) == [(3, 5, 17), (3, 25, 37)]
    assert pd_.reconcile(text, [(2, 10, 12)], proposed) == [(3, 25, 37)]
    assert pd_.put_together([(0, 0, 40, 1.0, False, True), (0, 32, 50, 2.0, True, False)]) == [(0, 0, 50, 3.0)]


def test_spark_gives_what_python_gives(spark, docs, texts, net):
    more = docs.unionByName(docs.where("doc_id < 3").withColumn("text", F.lit(PLAIN)))
    found = pd_.find_personal_data(more, net, out="SIZE")
    rows = found.collect()
    assert len(rows) == len(texts) + 3 and found.columns[-1] == "SIZE"
    for r in rows:
        ((own, added),) = pd_.find_all([r.text or ""], net)
        assert [(s.kind, s.start, s.end) for s in r.SIZE if s.rule] == named_spans(own)
        assert [(s.kind, s.start, s.end) for s in r.SIZE if not s.rule] == named_spans(added)
        spans = [(KINDS.index(s.kind), s.start, s.end) for s in r.SIZE]
        assert (pd_.without_spans(r.text or "", spans) == (r.text or "")) == (not spans)


def test_query_gives_the_rules_spans(spark, monkeypatch):
    monkeypatch.setattr(queries.personal_data, "fit", lambda docs: None)
    sf_dir = "/root/testdata/sf0.001"
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.op11_personal_data(spark, sf_dir).collect()
    assert len(found) == len(rows)
    for r in found:
        spans = brute.personal(rows[r.doc_id])
        counts = [sum(s[0] == k for s in spans) for k in KINDS]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert (r.base_sha256, r.spans) == (brute.sha(listed), listed)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in found) > 0


def test_nulls_and_nothing(nulls, empty, spark):
    found = pd_.find_personal_data(nulls, None)
    assert found.count() == nulls.count() and all(r.personal == [] for r in found.collect())
    assert pd_.find_personal_data(empty, None).isEmpty()
    for table in (empty, nulls):
        net = pd_.fit(table, made=20, steps=3)
        assert pd_.find_personal_data(table, net).count() == table.count()
    again = pd_.fit(nulls.repartition(3), made=20, steps=3)
    assert np.array_equal(net.tables, again.tables)
