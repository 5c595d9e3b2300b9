"""The mix against a loop over whole sources."""

import hashlib
import math
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from tessera.llm.op13_mixing import BITS, SEED, mixed, sampled
from tests.llm.conftest import DOCS


def frame(spark, rows, extra=()):
    """Documents from (doc_id, text, source)."""
    full = [(i, t, None, s, None, *["x"] * len(extra)) for i, t, s in rows]
    return spark.createDataFrame(full, ", ".join([DOCS, *(f"`{c}` string" for c in extra)]))


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def goals(sizes, share=Fraction(3, 2), most=2):
    """Targets by resharing the excess round by round."""
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    left, out = share * sum(sizes.values()), {}
    while len(out) < len(sizes):
        open_ = [s for s in sizes if s not in out]
        each = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if each * weight[s] >= most * sizes[s]]
        for s in over or open_:
            out[s] = most * sizes[s] if over else each * weight[s]
        left -= sum(out[s] for s in over)
        if not over:
            break
    return out


def plain(rows):
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size_of(t)
    target, out = goals(sizes), []
    for s in sizes:
        name = hashlib.md5((SEED + ("?" if s is None else "=" + s)).encode()).hexdigest()
        each = math.floor(float(target[s]) / sizes[s] * (1 << BITS)) if sizes[s] else 0
        total = int(name[:7], 16) << (BITS - 28)
        own = [(i, size_of(t)) for i, t, x in rows if x == s]
        falls = lambda i: i is not None and i % 2 != 0
        for i, n in sorted(own, key=lambda r: (falls(r[0]), -r[1] if falls(r[0]) else r[1], (r[0] is not None, r[0] or 0))):
            crossed = (total + each >> BITS) - (total >> BITS)
            total += each
            out.append((i, n, sizes[s], round(float(target[s]), 6), crossed))
    return sorted(out, key=str)


def mine(df):
    return sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["copies"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_copies_are_the_integers_crossed(spark, seed):
    rng = random.Random(seed)
    names = ["hot", "a", "Ä", "ｚ", "😀", "", None, "b"]
    rows = [(k, "w " * rng.choice([0, 1, 5, 40, 300]), rng.choice(names[: 3 + 2 * seed] + ["hot"] * 4)) for k in range(400)]
    assert mine(sampled(frame(spark, rows, extra=("part", "at", "name", "copies")))) == plain(rows)


def test_nulls_copies_and_odd_texts(spark):
    rows = [(1, None, None), (2, "", "x"), (2, "", "x"), (5, " \t\n\x0b\f\r ", "x"), (6, " a b ", None), (7, "a\x1cb c", None),
            (8, "w " * 100_000, "y"), (None, "no id here", "y"), (-3, "a b c", "y")]
    assert mine(sampled(frame(spark, rows))) == plain(rows)


def test_empty_table_and_no_words(spark):
    assert sampled(frame(spark, [])).count() == 0
    assert [r["target"] for r in sampled(frame(spark, [(1, None, "a"), (2, " ", None)])).collect()] == [0.0, 0.0]


def test_sources_come_near_their_targets(spark):
    rng = random.Random(9)
    rows = [(k, "w " * int(rng.lognormvariate(3, 1)), "big" if k % 3 else f"s{k % 7}") for k in range(4000)]
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    source = {k: s for k, _, s in rows}
    for r in sampled(frame(spark, rows)).collect():
        s = source[r["doc_id"]]
        taken[s] += r["size"] * r["copies"]
        target[s] = r["target"]
        largest[s] = max(largest[s], r["size"])
        assert 0 <= r["copies"] <= 2
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(size_of(t) for _, t, _ in rows)) < 1e-3


def test_mixed_documents_keep_their_columns_and_reruns_agree(spark):
    docs = frame(spark, [(k, f"text {k} " * (k % 5 + 1), f"s{k % 3}") for k in range(60)], extra=("col", "doc"))
    copies = {r["doc_id"]: r["copies"] for r in sampled(docs).collect()}
    out = mixed(docs)
    rows = sorted(map(tuple, out.collect()))
    assert out.columns == docs.columns and sorted(map(tuple, mixed(docs.repartition(5)).collect())) == rows
    assert sorted(tuple(r) for r in docs.collect() for _ in range(copies[r["doc_id"]])) == rows


def test_other_weights_and_shares(spark):
    docs = frame(spark, [(k, "a b", f"s{k % 2}") for k in range(100)])
    got = {(r["source_size"], r["target"]) for r in sampled(docs, weights=(1, 3), share=(1, 2), most=1).collect()}
    assert got == {(100, 25.0), (100, 75.0)}
    with pytest.raises(ValueError):
        sampled(docs, share=(5, 2)).collect()
