"""Byte-level BPE against the tiktoken library, and exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tessera.llm import op6_byte_bpe as O
from tessera.llm.op6_byte_bpe import coder, decode, digests, encode, read_ranks
from tests.llm.conftest import documents

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def texts():
    rng = random.Random(8)
    parts = ["the", " a", "é", "日本", "\n", "  ", "\t", "'s", "don't", "123", "!?", "😀", "\u00a0", "zzzqx", "aaaa", "<|endoftext|>", "\x00"]
    odd = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    return [None, "", " ", "a" * 700, "ab" * 300, "0123456789abcdef" * 30, "lorem ipsum " * 9000, *odd, odd[0]]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


def test_digests(spark, library):
    rows = list(enumerate(texts())) + [(None, "no id")]
    got = {r["doc_id"]: tuple(r)[1:] for r in digests(documents(spark, rows, ["piece", "ids", "bytes"]), PATH, PATTERN).collect()}
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert got[i] == want, text
    assert digests(documents(spark, []), PATH, PATTERN).count() == 0


def test_round_trip(spark, library):
    rows = list(enumerate(t for t in texts() if t is not None))
    coded = encode(documents(spark, rows), PATH, PATTERN)
    assert {r["doc_id"]: r["ids"] for r in coded.collect()} == {i: library.encode_ordinary(t) for i, t in rows}
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in decode(coded, PATH).collect()} == dict(rows)
    odd = spark.createDataFrame([(1, None), (2, []), (3, [50255, 0, 198])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: bytes(r["bytes"]) for r in decode(odd, PATH).collect()} == {1: b"", 2: b"", 3: library.decode_bytes([50255, 0, 198])}


def test_unknown_id():
    with pytest.raises(ValueError):
        coder(PATH).decode([[50256]])


def test_a_worker_merges_a_piece_once(library, monkeypatch):
    """Also for the next task's texts, and pieces that stay in use outlive those that do not."""
    monkeypatch.setattr(O, "_met", {}, raising=False)
    monkeypatch.setattr(O, "KEPT", 40)
    merged = []
    query = O.Coder._query
    monkeypatch.setattr(O.Coder, "_query", lambda self, name, rows, *rest: merged.append((name, rows.num_rows)) or query(self, name, rows, *rest))
    for task in range(8):
        texts = O.Texts(PATH, PATTERN)
        merged.clear()
        rows = ["zqxjv kwvzq", f"zqxjv own{task}zzq " + " ".join(f"t{task}qz{chr(97 + i)}x" for i in range(8))]
        for text, pieces in zip(rows, texts.pieces(rows)):
            known = [texts.known[p] for p in pieces]
            assert " ".join(line for line, _ in known) == " ".join(map(str, library.encode_ordinary(text)))
            assert b"".join(raw for _, raw in known) == text.encode()
        if task:
            distinct = {p for ps in map(texts.split, rows) for p in ps}
            assert sum(n for name, n in merged if name == "coded") <= 2 * (len(distinct) - 2)
