"""BagMinHash: unbiased signatures; groups against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm.bagminhash import SLOTS, signatures
from tessera.llm.op10_bagminhash import _in_blocks, keep_one, near_duplicates
from tests.llm.conftest import documents


def test_signatures_are_unbiased():
    rng, z = np.random.default_rng(1), []
    for _ in range(150):
        n = rng.integers(1, 60)
        element = rng.integers(1, 1 << 60, n).astype(np.uint64)
        a = rng.integers(0, 6, n) * rng.choice([1, 1, 50])
        b = np.where(rng.random(n) < 0.6, a, rng.integers(0, 9, n))
        if not a.sum() or not b.sum():
            continue
        j = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        owner = np.concatenate([np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)])
        s = signatures(owner, np.concatenate([element[a > 0], element[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]).astype(float), 2)
        z.append(((s[0] == s[1]).mean() - j) / np.sqrt(j * (1 - j) / SLOTS + 1e-4))
    assert abs(np.mean(z)) < 0.35 and np.std(z) < 1.4


def brute(rows):
    bags = []
    for _, t in rows:
        w = (t or "").split()
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(bags):
        for j, b in enumerate(bags[:i]):
            if a and b and rows[i][0] is not None and rows[j][0] is not None:
                both = sum((a & b).values())
                if both >= 0.8 * (sum(a.values()) + sum(b.values()) - both) - 1e-9:
                    x, y = sorted((find(i), find(j)), key=lambda k: rows[k][0])
                    parent[y] = x
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    rows = [(1000 + i, " ".join(rng.choices(words, k=rng.choice([3, 30, 120])))) for i in range(60)]
    for base in range(6):  # stars and chains of near copies
        text = rng.choices(words, k=200)
        for i in range(rng.choice([4, 25])):
            own = list(text)
            for _ in range(rng.choice([1, 3, 4, 6])):
                own[rng.randrange(200)] = "edit"
            rows.append((rng.randrange(10**6, 10**9), " ".join(own)))
            if base % 2:
                text = own
    rows += [(d + 10**10, t) for d, t in rows[:20]] + [rows[3]]
    return rows


@pytest.mark.parametrize("block", [2048, 5])
def test_groups_against_all_pairs(spark, block):
    rows = corpus() + [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "a  b"), (6, "spam " * 5000), (7, "spam " * 4500), (8, "x" * 90000), (None, "a b"), (9, "word")]
    got = near_duplicates(documents(spark, rows, ["band", "rep", "part", "class_id"]), block).collect()
    assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=str) == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)


def test_keep_one(spark):
    rows = [(5, "a b c d e f g"), (2, "a b c d e f g"), (9, "other words"), (None, "a b c d e f g"), (7, None), (9, "other words")]
    docs = documents(spark, rows, ["kept", "copy_of"])
    kept = keep_one(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"] for r in kept.collect()), key=str) == [2, 7, 9, None]


def test_no_documents(spark):
    assert near_duplicates(documents(spark, [])).count() == 0


def test_ids_that_come_with_several_texts(spark):
    rng = random.Random(6)
    a, b, c = (" ".join(f"{k}{rng.randrange(10**6)}" for _ in range(100)) for k in "abc")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, c), (4, c + " more")]
    got = sorted((r["doc_id"], r["class_id"]) for r in near_duplicates(documents(spark, rows)).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4)]
    kept = sorted((r["doc_id"], r["text"][:1]) for r in keep_one(documents(spark, rows)).collect())
    assert kept == [(1, "a"), (1, "b"), (4, "c")]  # one of each group, though two have one id
    assert keep_one(documents(spark, rows[:2] * 3)).count() == 2


@pytest.mark.parametrize("others", [1, 3, 250])
def test_large_buckets_are_dealt_by_their_smaller_part(spark, others):
    """Every pair with an end outside the largest component meets once; the rest are not dealt to one another."""
    n, block = 3000, 100
    rows = [(7, k, 0 if k >= others else k + 1, 0, n, n, n - others, n - others, 0) for k in range(n)]
    names = "band long, rep long, part long, center long, n long, words long, main_n long, main_words long, main long"
    dealt = _in_blocks(spark.createDataFrame(rows, names), block).collect()
    smaller = -(-others // block)
    assert len(dealt) <= n * smaller + others * (n // block + 2 + smaller)
    met = Counter()
    groups = {}
    for r in dealt:
        groups.setdefault((r["low"], r["high"]), ([], []))[r["side"]].append(r["rep"])
    for (low, high), (first, second) in groups.items():
        pairs = ((x, y) for x in first for y in second) if low != high else ((x, y) for i, x in enumerate(first) for y in first[:i])
        for x, y in pairs:
            if min(x, y) < others:
                met[min(x, y), max(x, y)] += 1
    assert set(met.values()) == {1} and len(met) == others * (n - others) + others * (others - 1) // 2
