"""Problem 8: levels by the latent model, against made texts of known level and held-out judgements."""

from __future__ import annotations

import random

import numpy as np

from quern.llm import reading as R

POOLS = {b: [f"{c}word{k}" for k in range(60)] for b, c in zip((1, 2, 3, 4), "abcd")}
SHARED = "the of and to in is that for with must be".split()


def make_text(band: int, rng: random.Random, n: int = 120) -> str:
    near = [b for b in (band - 1, band + 1) if 1 <= b <= 4]
    out = []
    for _ in range(n):
        kind = rng.random()
        out.append(rng.choice(SHARED) if kind < 0.4 else rng.choice(POOLS[band if kind < 0.85 else rng.choice(near)]))
    return " ".join(out)


def corpus(spark):
    rng = random.Random(1)
    bands = [rng.randint(1, 4) for _ in range(400)]
    docs = [(k, make_text(b, rng), "xx", 5) for k, b in enumerate(bands)]
    labels = [(k, k, "r1", b, None) for k, b in enumerate(bands[:120])] + [(999, 0, "r2", None, None), (998, 1, "r1", 9, None), (997, 5_000, "r1", 2, None)]
    # A tenth of the judgements is off by one.
    labels = [(i, d, r, min(4, b + 1) if b and i % 10 == 3 else b, t) for i, d, r, b, t in labels]
    documents = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, band int")
    return documents, spark.createDataFrame(labels, "label_id bigint, doc_id bigint, rater string, band int, rated_at timestamp"), bands


def test_held_out_accuracy(spark):
    documents, labels, bands = corpus(spark)
    got = {r.doc_id: r for r in R.reading_levels(documents, labels).collect()}
    held_out = range(120, 400)
    assert np.mean([got[k].band == bands[k] for k in held_out]) > 0.95
    levels = [got[k].level for k in held_out]
    assert np.corrcoef(levels, [bands[k] for k in held_out])[0, 1] > 0.95


def test_which_documents(spark):
    english = "the owner must keep the key and the card in the box when the door is not shut for the night " * 4
    spanish = "el equipo revisa los registros de la oficina y avisa al supervisor si faltan datos en el informe " * 4
    rows = [(1, english, "fr"), (1, english, "fr"), (2, spanish, "en"), (3, None, "en"), (4, "", "en"), (5, "  ", "en"), (6, "the cat sat", "en"), (7, english * 300, None), (None, english, "en")]
    documents = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id bigint, text string, lang string, band int, level double")
    labels = spark.createDataFrame([(1, 1, "a", 2, None)], "label_id bigint, doc_id bigint, rater string, band int, rated_at timestamp")
    got = R.reading_levels(documents, labels).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 7]
    assert len({r.band for r in got if r.doc_id == 1}) == 1
    assert R.reading_levels(documents, labels.where("false")).count() == 3
    assert R.reading_levels(documents.where("false"), labels).count() == 0


def test_newton_steps_reach_the_likelihood_maximum():
    """With the levels known, the words' difficulties are found: the gradient vanishes."""
    rng = np.random.default_rng(0)
    f, b = rng.normal(size=30), rng.normal(size=30)
    t = rng.choice(R.GRID[60:101], size=300)
    p = np.exp(f[:, None] + b[:, None] * t[None])
    counts = np.array([rng.multinomial(200, q / q.sum()) for q in p.T], dtype=float)
    totals = np.zeros(R.PLACES)
    totals[:30] = counts.sum(0)
    model = R.Model(totals)
    s1 = np.zeros(R.PLACES)
    s1[:30] = t @ counts
    weights = np.bincount(np.round((t - R.GRID[0]) / (R.GRID[1] - R.GRID[0])).astype(int), counts.sum(1), len(R.GRID))
    model.improve(totals, s1, weights, R.GRID, steps=60)
    assert np.corrcoef(model.b, b)[0, 1] > 0.99
