"""Language profiles: held-out accuracy, bundling against a plain loop, edge rows."""

import numpy as np

from tessera.llm.op5_language import DIM, bundles, identify, keep_known, letter_vector, training_prototypes
from tests.llm.conftest import documents


def test_bundle_is_the_sum_of_bound_trigrams():
    texts = ["Abé, ça!", "x", "", "a  b\n12c", "漢字 text"]
    for text, got in zip(texts, bundles(texts)):
        letters = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
        while "  " in letters:
            letters = letters.replace("  ", " ")
        codes = [0 if c == " " else ord(c) for c in letters]
        want = np.zeros(DIM, np.float32)
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            want += letter_vector(a) * np.roll(letter_vector(b), 1) * np.roll(letter_vector(c), 2)
        assert np.allclose(got, want)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = identify(docs).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").filter("held_out AND n_chars > 100").collect()
    assert len(rows) > 100 and np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97


def test_edges(spark):
    rows = [(i, "the cat and the dog " * 3, "en") for i in range(20)] + [(40 + i, "der Hund und die Katze " * 3, "de") for i in range(20)]
    odd = [(100, None), (101, ""), (102, "12 34 !!"), (None, "the cat", "en"), (103, "the dog " * 30000), (104, "the cat", None), (104, "the cat", None)]
    docs = documents(spark, rows + odd, ["share", "dim", "value", "held_out"])
    got = identify(docs).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3 and by[100]["score"] == 0.0
    assert by[103]["lang_pred"] == by[104]["lang_pred"] == "en" and all(0 <= r["score"] <= 1 for r in got)
    assert by[None]["held_out"] is False
    kept = keep_known(docs, *training_prototypes(docs))
    assert kept.columns == docs.columns and kept.count() == len(rows) + len(odd) - 3


def test_nothing_learnt(spark):
    assert identify(documents(spark, [])).count() == 0
    row = identify(documents(spark, [(1, "text", None)])).first()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)


def test_only_known_languages_stay(spark):
    rng = np.random.default_rng(5)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learnt = training_prototypes(docs)
    held = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").filter("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2").collect()]
    clean = [t for _, text in held for k in (1, 2, 5, 50) for t in [" ".join((text or "").split()[:k])] if any(map(str.isalpha, t))]

    def share(texts):
        return keep_known(documents(spark, list(enumerate(texts))), *learnt).count() / len(texts)

    assert share(clean) > 0.99 and share([t for _, t in held if t]) > 0.99
    for first, last in ((0x430, 0x450), (0x3B1, 0x3CA), (0x4E00, 0x5E00), (0x5D0, 0x5EB), (0x61, 0x7B)):  # unlearnt letters, then a-z
        for words, most in ((300, 0.0), (20, 0.0), (2, 0.3 if first == 0x61 else 0.1)):  # two words of a-z can be clean ones
            noise = [" ".join("".join(map(chr, rng.integers(first, last, rng.integers(3, 10)))) for _ in range(words)) for _ in range(50)]
            assert share(noise) <= most, (first, words)
