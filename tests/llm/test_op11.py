"""Phrases against counting every phrase with dictionaries; the summaries' guarantee."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm.op11_phrases import Laid, Summary, blocks, collocations, frequent, frequent_of, grams, sections, word_array
from tests.llm.conftest import documents


def pieces_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", lower)]


def counted(rows, longest=3):
    f = defaultdict(Counter)
    for _, text, lang in rows:
        for words in pieces_of(text):
            for n in range(1, longest + 1):
                f[lang if lang is not None else "und"].update(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
    return f


def plain(rows, threshold=10, longest=3, first=2000):
    out = []
    for lang, f in counted(rows, longest).items():
        total = sum(n for p, n in f.items() if " " not in p)
        own = {p: n for p, n in f.items() if " " in p and n >= threshold}
        kept = []
        for p, a in own.items():
            if any(100 * n >= 50 * a for q, n in own.items() if len(q) > len(p) and f" {p} " in f" {q} "):
                continue
            w = p.split(" ")
            scores = []
            for k in range(1, len(w)):
                left, right = f[" ".join(w[:k])], f[" ".join(w[k:])]
                scores.append((1_000_000 * a * a // (left * right), k, left, right))
            s, _, left, right = min(scores)
            kept.append((-s, -a, p.encode(), p, left, right))
        for rank, (s, a, _, p, left, right) in enumerate(sorted(kept)[:first], 1):
            out.append((lang, rank, p, -a, left, right, total, -s))
    return sorted(out)


def texts(seed, n=300):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "naïve", "ÄB", "x y", "日本", "New", "York", "city", "é", "A\x1cB", "tab\\t", "100%", "a+b"]
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "; ", "!?"]
    line = "in the beginning there was a phrase"
    return [
        (k, "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.choice([0, 1, 2, 3, 40]))) + rng.choice(["", line, line.upper()]),
         rng.choice(["en", "en", "de", None, "a\tb %", ""]))
        for k in range(n)
    ]


@pytest.mark.parametrize("seed", range(2))
def test_phrases_are_those_of_a_full_count(spark, seed):
    rows = [*texts(seed), (1, None, "en"), (2, "", None), (2, "", None), (None, "the of the", "xx"), (7, " \t. ", "blank")]
    want = plain(rows)
    assert sorted(map(tuple, collocations(documents(spark, rows, extra=("words", "phrase", "slot")), partitions=5).collect())) == want and want


def test_longer_phrases_and_other_thresholds(spark):
    rows = texts(5, 120)
    assert sorted(map(tuple, collocations(documents(spark, rows), threshold=3, longest=5, first=7, partitions=3).collect())) == plain(rows, 3, 5, 7)


def test_counts_pass_64_bits(spark):
    from pyspark.sql import functions as F

    from tessera.llm.op11_phrases import score

    rows = [(10**12, 10**12 + 7, 10**12 + 9), (3, 10**14, 10**14), (10**14, 10**14, 10**14)]
    df = spark.createDataFrame(rows, "a long, l long, r long").select(score(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert [r["s"] for r in df.collect()] == [1_000_000 * a * a // (x * y) for a, x, y in rows]


@pytest.mark.parametrize("seed", range(6))
def test_summaries_keep_what_reaches_the_threshold(seed):
    rng = random.Random(seed)
    threshold = rng.choice([3, 10])
    stream = [b"k%d" % min(int(rng.paretovariate(rng.choice([0.4, 1.0]))), 4000) for _ in range(6000)]
    full, summary = Counter(stream), Summary(len(stream) // threshold + 1)
    tight = Summary(25)
    for at in range(0, len(stream), 500):
        part = Counter(stream[at : at + 500])
        for s in (summary, tight):
            s.add(pa.array(list(part), pa.large_binary()), np.array(list(part.values())))
    for s in (summary, tight):
        assert len(s.keys) <= s.capacity and s.lost * (s.capacity + 1) <= len(stream)
        held = dict(zip(s.keys.to_pylist(), s.counts.tolist()))
        assert all(n - s.lost <= held.get(k, 0) <= n for k, n in full.items())
    assert summary.lost < threshold
    assert {k for k, n in full.items() if n >= threshold} <= set(summary.reaching(threshold).to_pylist())


def test_a_partition_that_overflows_its_summary_counts_exactly(spark):
    """Nearly all n-grams occur once, so counters are subtracted; what reaches the threshold is still whole."""
    rng = random.Random(3)
    text = " ".join(rng.choice(["hot", f"w{rng.randrange(10**6)}"]) for _ in range(40_000))
    rows = [(1, text, "en"), (2, "rare pair here. " * 12, "en")]
    want = {(p.count(" ") + 1, p): n for p, n in counted(rows)["en"].items() if n >= 10}
    got = {(r["words"], r["phrase"]): r["n"] for r in frequent(documents(spark, rows), partitions=2).collect()}
    assert got.pop((0, "")) == sum(n for p, n in counted(rows)["en"].items() if " " not in p) and got == want
    laid = Laid((r["grams"], r["counts"], r["size"], r["n"], r["mass"]) for r in blocks(documents(spark, rows), 1, 3).collect())
    summary = Summary(laid.mass // 10 + 1)
    for keys, counts in laid.batches():
        summary.add(keys, counts)
    found = dict(zip(*(x.to_pylist() if isinstance(x, pa.Array) else x.tolist() for x in frequent_of(laid, 10))))
    finer = list(Laid((r["grams"], r["counts"], r["size"], r["n"], r["mass"]) for r in blocks(documents(spark, rows), 1, 3).collect()).parts(9000))
    assert len(finer) == -(-laid.mass // 9000) > 5 and sum(p.mass for p in finer) == laid.mass
    split = [dict(zip(*(x.to_pylist() if isinstance(x, pa.Array) else x.tolist() for x in frequent_of(p, 10)))) for p in finer]
    assert sum(map(len, split)) == len(found) and {k: n for p in split for k, n in p.items()} == found
    assert len(found) == len(want) + 1 and laid.mass // 10 + 1 < sum(n for _, _, _, n in laid.lengths)


def test_slices_of_words(monkeypatch):
    """N-grams that begin in one slice and end in the next are counted once."""
    rows = texts(8, 60)
    words, follow = word_array([t for _, t, _ in rows])
    monkeypatch.setattr("tessera.llm.op11_phrases.CODES", 4)  # slices of 13 words
    total = Counter()
    for names, h, times in grams(words, follow, 3):
        assert len(names) == len(h) == len(times)
        total.update(dict(zip([n.decode() for n in names.to_pylist()], times.tolist())))
    assert total == sum(counted([(0, t, "x") for _, t, _ in rows]).values(), Counter())


def test_long_texts_are_cut_at_separators(spark):
    rng = random.Random(2)
    text = "".join(rng.choice(["one two ", "three. ", "four, five "]) for _ in range(2000))
    parts = [t for _, t in sections(iter([("x", text)]), 100)]
    assert max(map(len, parts)) < 200 and sum(counted([(0, p, "x") for p in parts]).values(), Counter()) == counted([(0, text, "x")])["x"]
    rows = [(1, "long text " * 300_000 + ". " + "no separator" * 100_000, "en")]
    assert sorted(map(tuple, collocations(documents(spark, rows)).collect())) == plain(rows)


def test_empty_table(spark):
    assert collocations(documents(spark, [])).collect() == [] and collocations(documents(spark, [(1, None, "x")])).collect() == []
