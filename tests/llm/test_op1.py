"""Fingerprints against brute force, and the multiset laws."""

import hashlib

import pytest

from tessera.llm.op1_fingerprints import changed, edited, fingerprint, fingerprints, likeness
from tests.llm.conftest import documents


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        e = edited(t, following)
        fp, fe, fn = fingerprint(t), fingerprint(e), fingerprint(following)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), fp, fe, round(likeness(fp, fe), 9), round(likeness(fp, fn), 9)))
    return sorted(out, key=str)


@pytest.mark.parametrize("ranges", [1, 5])
def test_against_brute_force(spark, ranges):
    rows = [(7, "one two three\nfour five"), (3, None), (3, ""), (9, "four five\none two three"), (9, "four five\none two three"),
            (-4, "é" * 7 + "\n\nß"), (None, "no id here"), (100, "word " * 40000), (101, "x" * 50001), (55, "\n")]
    df = fingerprints(documents(spark, rows, ["range", "carried", "to", "first_id"]), ranges)
    got = [(*r[:5], round(r[5], 9), round(r[6], 9)) for r in df.collect()]
    assert sorted(got, key=str) == brute(rows)


def test_one_and_no_document(spark):
    row = fingerprints(documents(spark, [(1, "abc")])).first()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(b"aba").hexdigest()
    assert fingerprints(documents(spark, [])).count() == 0


def test_order_insert_delete():
    parts = ["alpha beta gamma delta", "epsilon zeta", "", "eta theta iota kappa", "eta theta iota kappa"]
    fp = fingerprint("\n".join(parts))
    assert fp == fingerprint("\n".join(reversed(parts)))
    assert changed(fingerprint("\n".join(parts[:3])), insert=parts[3:]) == fp
    assert changed(fp, delete=parts[4:]) == fingerprint("\n".join(parts[:4])) != fp
    assert fingerprint("a\nb") != fingerprint("a\n\nb") and fingerprint("a b") != fingerprint("b a")
    assert fingerprint(None) == fingerprint("") and likeness(fingerprint(""), fp) == 0.0


def test_likeness_follows_the_share_kept():
    words = [f"w{i}" for i in range(4000)]
    other = [f"v{i}" for i in range(4000)]
    fp = fingerprint("\n".join(" ".join(words[i : i + 20]) for i in range(0, 4000, 20)))
    for keep in (0, 1000, 2000, 3000, 4000):
        mixed = words[:keep] + other[keep:]
        near = likeness(fp, fingerprint("\n".join(" ".join(mixed[i : i + 20]) for i in range(0, 4000, 20))))
        assert abs(near - keep / 4000) < 0.35, (keep, near)


def test_likeness_of_long_repeats():
    text = "one two three " * 40000  # each run more than 32,767 times
    assert likeness(fingerprint(text), fingerprint(text[: len(text) // 2])) > 0.99
