"""Positive-unlabelled toxicity: held-out quality, the risk's fit, edge rows."""

import math
import random
import re
from collections import Counter

import numpy as np

from tessera.llm.op7_toxicity import Model, features, fit, found_in, keep_clean, toxicity, training_model
from tests.llm.conftest import documents


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for s in np.unique(score):
        rank[score == s] = rank[score == s].mean()
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = toxicity(docs, labels).join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic").toPandas()
    # one toxic label in twelve here is on a text of filler words alone, which nothing can tell: at best 0.96
    assert auc(rows.score.to_numpy(), rows.toxic.to_numpy()) > 0.95
    clean = rows[rows.toxic == 0]
    assert (clean.predicted == 0).mean() > 0.99


def test_fit_separates_despite_positives_among_the_unlabelled():
    rng = np.random.default_rng(2)
    one = np.ones(1)
    positive = [(np.array([0]), one) for _ in range(300)]
    unlabelled = [(np.array([0]), one) if rng.random() < 0.2 else (np.array([1]), one) for _ in range(3000)]
    w, b = fit(positive, unlabelled, 2, 0.2)
    assert 1 / (1 + np.exp(-w[0] - b)) > 0.9 and 1 / (1 + np.exp(-w[1] - b)) < 0.1


def test_features_are_a_set_with_densities():
    owner, f = features(["Bad bad word", "", "bad"])
    assert owner.tolist().count(1) == 0 and set(f[owner == 2]) <= set(f[owner == 0])
    wanted = np.unique(f[owner == 2])
    owner, at, value = features(["bad " + "fine " * 2999, "bad"], wanted)
    assert owner.tolist() == [0, 1] and value.tolist() == [300 / 3000, 1.0]


def test_edges(spark):
    rows = [(i, "vile text you fool " * 3 if i % 4 == 0 else "kind words for all " * 3) for i in range(400)]
    odd = [(1000, None), (1001, ""), (None, "vile fool"), (1002, "vile fool " * 30000), (0, "vile text")]
    labels = spark.createDataFrame(
        [(i, 1, int(i % 4 == 0)) for i in range(300)] + [(5, 1, None), (None, 1, 1), (99999, 0, 1), (0, 1, 0)], "doc_id long, quality int, toxic int"
    )
    docs = documents(spark, rows + odd, ["toxic", "positive", "feature", "p"])
    got = toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 0}
    assert by[1000]["score"] == by[1001]["score"] < 0.7 and by[1002]["predicted"] == 1 and by[399]["predicted"] == 0 and by[396]["predicted"] == 1
    kept = keep_clean(docs, training_model(docs, labels))
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.select("doc_id").collect()} >= {399, 1000, 1001}
    assert kept.filter("doc_id = 396").count() == 0


def test_nothing_to_learn(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["predicted"] for r in toxicity(documents(spark, [(1, "a")]), labels).collect()] == [0]
    assert toxicity(documents(spark, []), labels).count() == 0


def parts_of(text):
    """Words and their beginnings, in bytes, with the word's number."""
    words = [w for w in re.split(rb"[^0-9A-Za-z\x80-\xff]+", text.lower().encode()) if w]
    return [(i, part) for i, w in enumerate(words) for part in (w, *((w[:h], h) for h in (4, 5, 6, 7) if len(w) > h))], len(words)


def plain_score(text, weights, bias):
    found, n = parts_of(text)
    found = [(i, p) for i, p in found if p in weights]
    often = Counter(p for _, p in found)
    z = sum(weights[p] * min(1.0, c * 300 / max(n, 300)) for p, c in often.items())
    if n > 300 and found:
        z = max(z, max(sum(weights[p] for p in {p for i, p in found if end - 300 < i <= end}) for end in {i for i, _ in found}))
    return 1 / (1 + math.exp(-z - bias))


def test_scores_are_those_of_a_plain_reading():
    rng = random.Random(3)
    vocabulary = ["vile", "villain", "fools", "idiotic", "Été", "kind", "words", "of", "peaceful", "été2"]
    weights = {}
    for w in vocabulary[:5]:
        weights |= {p: rng.uniform(-1, 3) for _, p in parts_of(w)[0]}
    number = {}
    for w in vocabulary:  # hashes of the parts of a word come in the order of the parts
        number |= dict(zip([p for _, p in parts_of(w)[0]], found_in([w])[1].tolist()))
    known = sorted((number[p], x) for p, x in weights.items())
    model = Model(np.array([k for k, _ in known]), np.array([x for _, x in known]), -2.0)
    texts = ["", " .,", "vile", *(" ".join(rng.choices(vocabulary[5:], k=n) + rng.choices(vocabulary, k=m) + rng.choices(vocabulary[5:], k=n)) for n in (0, 50, 400, 700) for m in (1, 5, 350))]
    for t, s in zip(texts, model.scores(texts)):
        assert abs(s - plain_score(t, weights, -2.0)) < 1e-9, t[:60]


def plain_fit(positive, unlabelled, n, prior, steps, rate=0.1, decay=1e-5):
    """The estimator's steps with sums over documents one at a time."""
    w, m, v = [0.0] * n + [math.log(prior / (1 - prior))], [0.0] * (n + 1), [0.0] * (n + 1)
    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    for step in range(1, steps + 1):
        value = lambda r: w[n] + sum(w[f] * x for f, x in zip(*r))  # noqa: E731, B023
        as_zero = lambda rows: sum(math.log(1 + math.exp(value(r))) for r in rows) / len(rows)
        ok = as_zero(unlabelled) - prior * as_zero(positive) >= 0
        slope = [decay * x for x in w[:n]] + [0.0]
        for rows, is_positive in ((positive, True), (unlabelled, False)):
            for r in rows:
                s = sigmoid(value(r)) / len(rows)
                if is_positive:
                    d = -prior / len(rows) if ok else prior * s
                else:
                    d = s if ok else -s
                for f, x in zip(*r):
                    slope[f] += d * x
                slope[n] += d
        for i, g in enumerate(slope):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
            w[i] -= rate * (m[i] / (1 - 0.9**step)) / (math.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return w[:n], w[n]


def test_fit_takes_the_steps_of_the_plain_estimator():
    rng = random.Random(1)
    rows = [[[f for f in range(4) if rng.random() < p] for _ in range(n)] for n, p in ((12, 0.6), (40, 0.3))]
    rows = [[(f, [rng.choice([1.0, 0.4]) for _ in f]) for f in side] for side in rows]
    for prior in (0.1, 0.7):  # with the larger one the second part falls below zero
        w, b = fit(*[[(np.array(f), np.array(x)) for f, x in side] for side in rows], 4, prior, steps=60)
        plain_w, plain_b = plain_fit(*rows, 4, prior, 60)
        assert np.allclose(w, plain_w, atol=1e-6) and abs(b - plain_b) < 1e-6


def test_a_passage_counts_however_much_surrounds_it(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = training_model(docs, labels)
    rows = docs.join(labels, "doc_id").select("text", "toxic").toPandas()
    texts = [t for t in rows.text if t]
    flagged = dict(zip(texts, np.concatenate([model.scores(texts[i : i + 500]) for i in range(0, len(texts), 500)]) >= 0.7))
    clean = [t for t, bad in zip(rows.text, rows.toxic) if t and not bad]
    assert sum(flagged[t] for t in clean) < 0.01 * len(clean)
    toxic = [t for t, bad in zip(rows.text, rows.toxic) if t and bad and flagged[t] and len(t.split()) <= 300][:60]
    pool = " ".join(t for t in clean if not flagged[t]).split()
    for n in (300, 3000, 10_000):
        long = [" ".join(pool[: n // 2]) + " " + t + " " + " ".join(pool[n // 2 : n]) for t in toxic]
        assert (model.scores(long) >= 0.7).mean() >= 0.9
