"""The packing plan against exhaustive search and item-wise best fit; pieces against whole-text tokenization."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm.op4_packing import best_fit, cut, encoder, pack, plan, reduce
from tests.llm.conftest import documents

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def optimum(items, capacity):
    best = [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b >= items[i]}.values():
            bins[k] -= items[i]
            place(i + 1, bins)
            bins[k] += items[i]
        place(i + 1, [*bins, capacity - items[i]])

    items = sorted(items, reverse=True)
    place(0, [])
    return best[0]


def test_reduction_keeps_an_optimum():
    rng = random.Random(1)
    for _ in range(150):
        capacity = rng.choice([10, 20, 30])
        items = [rng.randint(1, capacity) for _ in range(8)]
        fixed, left = reduce(dict(Counter(items)), capacity)
        assert sum(n for _, n in fixed) + optimum([w for w, n in left.items() for _ in range(n)], capacity) == optimum(items, capacity)


def test_best_fit_on_counts_is_best_fit_on_items():
    rng = random.Random(2)
    for _ in range(100):
        capacity = rng.choice([10, 64, 1024])
        items = sorted((rng.randint(1, capacity) for _ in range(rng.choice([0, 1, 7, 200]))), reverse=True)
        bins = []
        for w in items:
            fits = [(r, i) for i, r in enumerate(bins) if r >= w]
            if fits:
                bins[min(fits)[1]] -= w
            else:
                bins.append(capacity - w)
        mine = [capacity - sum(p) for p, n in best_fit(dict(Counter(items)), capacity) for _ in range(n)]
        assert sorted(bins) == sorted(mine)


def test_plan_uses_every_item_once():
    rng = random.Random(3)
    counts = {w: rng.randint(1, 900) for w in range(1, 1025)}
    got = Counter()
    for pattern, n in plan(counts, 1024):
        assert sum(pattern) <= 1024
        for w in pattern:
            got[w] += n
    assert got == counts


def test_units_equal_whole_text():
    tokenizer, rng = Tokenizer.from_file(PATH), random.Random(5)
    parts = [" ", "  ", "\n", "\t", "a", "the", "é", "'s", "'", "1", "٣", "!", "<|endoftext|>", "日本", "\u00a0", "x" * 30, "😀", "_"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    for text, raw in ((t, encoder(PATH, PATTERN)(t)) for t in texts):
        assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("text", ["x" + " " * 1_000_000 + "y", "\n" * 1_000_000, "日本" * 100_000 + " " * 99_999 + "z"])
def test_very_long_texts(text):
    ids = np.frombuffer(encoder(PATH, PATTERN)(text), "<u4").tolist()
    assert ids == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_cut():
    assert cut(1024, 1024) == [(0, 1024)] and cut(1025, 1024) == [(0, 1), (1, 1024)] and cut(2, 1024) == [(0, 2)]


@pytest.mark.parametrize("capacity", [16, 1024])
def test_pack(spark, capacity):
    rows = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (4, "word " * 9000), (None, "no id"), (6, "x" * 20000), *((100 + i, "some words " * (i % 17)) for i in range(60))]
    got = pack(documents(spark, rows, ["length", "task", "rank", "before"]), PATH, PATTERN, capacity).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.update((i, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for k, (s, n) in enumerate(cut(len(ids), capacity)))
    assert Counter(tuple(r)[:5] for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in got)
    assert len(sequences) <= -(-total // capacity) * 1.06 + 1


def test_no_documents(spark):
    assert pack(documents(spark, []), PATH, PATTERN).count() == 0
