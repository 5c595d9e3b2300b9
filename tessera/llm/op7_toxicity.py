"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; documents drawn from the corpus
without looking at labels are the unlabelled ones.  A linear model on word
and word-beginning features minimises, with the class prior p,

    p * R+(positive as 1) + max(0, R-(unlabelled as 0) - p * R-(positive as 0))

and where the second term would fall below zero, takes a step that raises it
again, as the non-negative estimator prescribes.  The prior is the share of
toxic documents among labelled training rows unless given.

Bounds, documented parameters: at most ``POSITIVES`` positive and
``UNLABELLED`` unlabelled documents (those of least id hash) teach; the model
keeps features found in at least ``SUPPORT`` of the positives whose estimated
precision, prior x share of positives / share of unlabelled with it, reaches
``PRECISION``.  The model is what tasks
receive: at most a few thousand (feature, weight) pairs.

A text is scored as a whole, features weighing by how often they occur in it,
and by the densest stretch of ``WINDOW`` words, so that a passage counts however much
surrounds it.

Defined results: null text counts as empty and gets the model's bias, as all
texts without a feature do.  Without a positive (or without an unlabelled
document) every score is the prior, 0 if unknown.  Labels that are null or of
unknown ids teach nothing; an id labelled twice counts toxic if any label
says so.  Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batch_of, chunks, keep_rows, register, rows_in, store, table, text_or_empty
from tessera.llm.words import Words

POSITIVES, UNLABELLED = 4000, 12000
SUPPORT, PRECISION, THRESHOLD = 0.01, 0.75, 0.7
#: Beginnings of words, in bytes, that are features beside whole words.
HEADS = (4, 5, 6, 7)
WINDOW = 300
BITS = 20

SEPARATOR = np.ones(256, bool)
SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def found_in(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, feature, which of its text's words it is of) of every occurrence, and the texts' numbers of words.

    With ``wanted`` (sorted) only those features, by their number there.
    """
    words = Words([t.lower() for t in texts], SEPARATOR)
    size = words.ends - words.starts
    place = np.arange(len(words.owner)) - (np.cumsum(words.counts) - words.counts)[words.owner]
    owners, found, places = [], [], []
    for k, head in enumerate((None, *HEADS)):
        h = words.hashes(head)
        use = np.ones(len(h), bool) if head is None else size > head
        f = ((h >> np.uint64(8)) << np.uint64(3) | np.uint64(k)).astype(np.int64) & ((1 << 62) - 1)
        if wanted is not None:
            bits = np.zeros(1 << BITS, bool)
            bits[wanted >> 3 & ((1 << BITS) - 1)] = True
            use &= bits[f >> 3 & ((1 << BITS) - 1)]
        owners.append(words.owner[use])
        found.append(f[use])
        places.append(place[use])
    owner, f, at = np.concatenate(owners), np.concatenate(found), np.concatenate(places)
    if wanted is not None:
        number = np.minimum(np.searchsorted(wanted, f), max(len(wanted) - 1, 0))
        hit = wanted[number] == f if len(wanted) else np.zeros(len(f), bool)
        owner, f, at = owner[hit], number[hit], at[hit]
    return owner, f, at, words.counts


def densities(owner: np.ndarray, f: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, feature, value) pairs, each once: 1 from one occurrence in ``WINDOW`` words on, less in proportion where they are rarer."""
    pair, often = np.unique(owner * max(n, 1) + f, return_counts=True)
    owner = pair // max(n, 1)
    return owner, pair % max(n, 1), np.minimum(1.0, often * WINDOW / np.maximum(counts[owner], WINDOW))


def features(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(owner, feature) pairs, each once.

    With ``wanted`` (sorted) only those, by their number there, and as a third
    array their values: 1 from one occurrence in ``WINDOW`` words on, less in
    proportion where they are rarer, as chance finds in very long texts are.
    """
    owner, f, _, counts = found_in(texts, wanted)
    if wanted is not None:
        return densities(owner, f, counts, len(wanted))
    order = np.lexsort((f, owner))
    owner, f = owner[order], f[order]
    first = np.ones(len(f), bool)
    first[1:] = (f[1:] != f[:-1]) | (owner[1:] != owner[:-1])
    return owner[first], f[first]


def densest(f: np.ndarray, place: np.ndarray, weights: np.ndarray) -> float:
    """The greatest sum of weights of the features in the ``WINDOW`` words up to any that has one, each feature once."""
    order = np.argsort(place, kind="stable")
    f, place = f[order].tolist(), place[order].tolist()
    held: dict[int, int] = {}
    best, total, left = -np.inf, 0.0, 0
    for k, x, after in zip(f, place, [*place[1:], -1]):
        while x - place[left] >= WINDOW:
            held[f[left]] -= 1
            if not held[f[left]]:
                total -= weights[f[left]]
            left += 1
        if not held.get(k):
            total += weights[k]
        held[k] = held.get(k, 0) + 1
        if after != x:  # all features of the word are held
            best = max(best, total)
    return best


@dataclass
class Model:
    wanted: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        """Of each text: of all its words, or of its densest ``WINDOW`` words if that is more."""
        n = len(self.wanted)
        owner, f, place, counts = found_in(texts, self.wanted)
        own, feature, value = densities(owner, f, counts, n)
        z = np.bincount(own, value * self.weights[feature], len(texts)) if len(own) else np.zeros(len(texts))
        order = np.argsort(owner, kind="stable")
        for i in np.flatnonzero((counts > WINDOW) & (np.bincount(owner, minlength=len(texts)) > 0)):
            at = order[np.searchsorted(owner, i, "left", order) : np.searchsorted(owner, i, "right", order)]
            z[i] = max(z[i], densest(f[at], place[at], self.weights))
        return 1.0 / (1.0 + np.exp(-np.clip(z + self.bias, -40, 40)))


def fit(positive: list[tuple], unlabelled: list[tuple], n: int, prior: float, steps: int = 1500, rate: float = 0.1, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic non-negative PU risk, by Adam over all rows (features, values) at once."""

    def csr(rows):
        flat = lambda k, kind: np.concatenate([np.zeros(0, kind), *(np.asarray(r[k], kind) for r in rows)])
        return np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows]), flat(0, np.int64), flat(1, np.float64)

    (po, pf, px), (uo, uf, ux) = csr(positive), csr(unlabelled)
    w, b = np.zeros(n), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    sigmoid = lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, steps + 1):
        zp = np.bincount(po, px * w[pf], len(positive)) + b
        zu = np.bincount(uo, ux * w[uf], len(unlabelled)) + b
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp, gu = sigmoid(zp) / len(zp), sigmoid(zu) / len(zu)  # slopes of the loss as 0
        if negative >= 0:
            dp, du = prior * (gp - 1 / len(zp)) - prior * gp, gu
        else:  # step back: raise the part that fell below zero
            dp, du = prior * gp, -gu
        slope = np.bincount(pf, px * dp[po], n) + np.bincount(uf, ux * du[uo], n) + decay * w
        slope = np.append(slope, dp.sum() + du.sum())
        m = 0.9 * m + 0.1 * slope
        v = 0.999 * v + 0.001 * slope * slope
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def _sampled(rows: DataFrame, most: int, total: int, salt: int) -> DataFrame:
    draw = F.xxhash64("doc_id", F.lit(salt)).bitwiseAND(F.lit((1 << 30) - 1)) / float(1 << 30)
    return rows.filter(draw < min(1.0, most / max(total, 1)))


def learn(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> Model:
    """A model from the texts of ``docs`` and the labels given; both are training rows already."""
    labels = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    docs = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", text_or_empty("text").alias("text"))
    toxic = labels.filter("toxic = 1").select("doc_id")
    count = labels.agg(F.count("*").alias("n"), F.count(F.when(F.col("toxic") == 1, 1)).alias("toxic")).first()
    if prior is None:
        prior = count["toxic"] / count["n"] if count["n"] else 0.0
    nothing = Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))) if 0 < prior < 1 else -40.0)
    if not count["toxic"]:
        return nothing
    positives = _sampled(toxic, POSITIVES, count["toxic"], 1)  # about POSITIVES ids at most: broadcast, so no text is shuffled
    unlabelled = _sampled(docs, UNLABELLED, docs.select("doc_id").count(), 2)
    sample = store(
        docs.join(F.broadcast(positives), "doc_id").select(F.lit(1).alias("positive"), "text").union(unlabelled.select(F.lit(0), "text")), "toxicity-sample"
    )
    sizes = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    if len(sizes) < 2:
        return nothing

    def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(rows_in(batches), lambda r: len(r[1])):
            owner, f = features([r[1] for r in rows])
            own = np.array([r[0] for r in rows])[owner]
            found, at, n = np.unique(f, return_inverse=True, return_counts=True)
            with_label = np.bincount(at, own, len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(with_label), pa.array(n - with_label)], names=["feature", "p", "u"])

    tallies = sample.mapInArrow(count_features, "feature long, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    enough = max(3.0, SUPPORT * sizes[1])
    chosen = tallies.filter((F.col("p") >= enough) & (prior * F.col("p") / sizes[1] >= PRECISION * F.col("u") / sizes[0])).select("feature")
    wanted = np.array(sorted(r[0] for r in chosen.collect()), np.int64)  # at most features per text / SUPPORT
    if not len(wanted):
        return nothing

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(rows_in(batches), lambda r: len(r[1])):
            owner, f, value = features([r[1] for r in rows], wanted)
            ends = pa.array(np.searchsorted(owner, np.arange(len(rows) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (f.astype(np.int32), value)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *lists], names=["positive", "features", "values"])

    rows = sample.mapInArrow(pick, "positive int, features array<int>, values array<double>").collect()  # the bounded sample
    sides = [sorted((r["features"], r["values"]) for r in rows if r["positive"] == side) for side in (1, 0)]  # one order, so one model
    weights, bias = fit(*sides, len(wanted), min(max(prior, 1e-4), 0.9))
    return Model(wanted, weights, bias)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def score(docs: DataFrame, model: Model, held_out=None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(rows_in(batches), lambda r: len(r[2])):
            s = model.scores([r[2] for r in rows])
            yield batch_of(SCHEMA, [[r[0] for r in rows], [r[1] for r in rows], s, (s >= THRESHOLD).astype(np.int32)])

    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), text_or_empty("text").alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents the model does not reject, with all their columns."""
    return keep_rows(docs, lambda texts: (model.scores(texts) < THRESHOLD).tolist())


def fold(col: str = "doc_id"):
    return F.crc32(F.col(col).cast("string").cast("binary")) % 3


def training_model(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> Model:
    """Learnt from the rows whose crc32 of the id modulo 3 is not 1."""
    return learn(docs.filter(fold() != 1), labels.select("doc_id", "toxic").filter(fold() != 1), prior)


def toxicity(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> DataFrame:
    """Learn from the training rows, score all."""
    return score(docs, training_model(docs, labels, prior), fold() == 1)


@register("op7_toxicity")
def op7(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
