"""Alignments against a reading of whole texts token by token."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tessera.llm.op4_packing import byte_of
from tessera.llm.op12_alignment import aligned, alignments, groups, labels, pair_counts, pair_of, stretches
from tests.llm.conftest import documents

A, B, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN


def plain(rows):
    """The same from whole texts, without stretches, arrays or pointers."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    spelled = byte_of()
    made, pairs = [], Counter()
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text, out_type=int) if text else []
        raw_a = [bytes(spelled[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = []
        for i in ids_b:
            piece = b.id_to_piece(i)
            raw_b.append(bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x..>", piece) else piece.replace("▁", " ").encode())
        whole = (" " + (text or "")).encode()
        if not text or b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            made.append((doc_id, [], [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        own, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            na, nb = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            own.append((ids_a[i:na], ids_b[j:nb]))
            i, j = na, nb
        links = [(x[-1], y[-1]) for x, y in own]
        pairs.update(links)
        made.append((doc_id, ids_a, ids_b, own, links))
    best = {}
    for (_, y), n in pairs.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for doc_id, ids_a, ids_b, own, links in made:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in own)
        out.append((doc_id, len(ids_a), len(ids_b), len(own), len(links), sum(pairs[p] == best[p[1]] for p in links),
                    sum(pairs[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out, pairs


ODD = [
    "", None, " ", "  ", " a", "a ", "a  b", "a \n b", "a\n b", "a\t b  c ", "　 x　y", "naïve café déjà-vu", "日本語 のテキスト 梦",
    "▁a b", "x ▁", "<s> </s> <unk> <pad> <|endoftext|> <0x41>", "a\0b \x1c c", "﻿x", "é ﬁ", "don't we'll 'tis  's", "👩‍👩‍👧 ok", "x" * 3000,
    "a" + " " * 5000 + "b", "\n\n\n  \n", "1234567 12.5e-7 $%^&*", "word\nnext\r\nline   end\u0085 z",
]


def test_whole_texts_give_the_same(spark):
    rng = random.Random(4)
    words = ["the", "ation", "Über", "naïve", "  ", "\n", "日本", "x1", "'s", "—", "\t", " ", "ß", "don't"]
    rows = [(k, t) for k, t in enumerate(ODD + ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(60)) for _ in range(150)])]
    rows += [(3, "a copy"), (3, "a copy"), (None, "no id")]
    got = alignments(documents(spark, rows, extra=("n", "pair", "best")), A, B, PATTERN)
    want, pairs = plain(rows)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    counted = pair_counts(aligned(documents(spark, rows), A, B, PATTERN), 32000).collect()
    assert {(r["a"], r["b"]): r["n"] for r in counted} == dict(pairs)


def test_documents_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, alignments(docs, A, B, PATTERN).collect())) == sorted(plain(rows)[0])


def test_a_text_is_its_stretches():
    for text in ODD:
        if text:
            parts = stretches(text)
            assert " ".join(parts) == text
            assert all(p and not p[-1].isspace() for p in parts[:-1])  # every cut follows something that is no white space


@pytest.mark.parametrize("seed", range(5))
def test_labels_are_components_of_overlaps(seed):
    rng = random.Random(seed)
    total = 400
    ends = [sorted({*rng.sample(range(1, total), rng.choice([3, 60, 200])), total}) for _ in range(2)]
    label_a, label_b = labels(*map(np.array, ends))
    ranges = [[(s, e) for s, e in zip([0, *own], own)] for own in ends]
    group = list(range(len(ends[0]) + len(ends[1])))  # merged by overlap, the slow way
    n = len(ends[0])
    for i, (s, e) in enumerate(ranges[0]):
        for j, (u, v) in enumerate(ranges[1]):
            if s < v and u < e:
                old, new = group[n + j], group[i]
                group = [new if g == old else g for g in group]
    mine = [*label_a.tolist(), *label_b.tolist()]
    assert len({(g, m) for g, m in zip(group, mine)}) == len(set(group)) == len(set(mine))


def test_groups_spell_the_text(spark):
    pair = pair_of(A, B, PATTERN)
    rows = [(1, "Some tokens, aligned: naïve 日本語"), (2, None), (3, "▁x")]
    got = {r["doc_id"]: r for r in groups(documents(spark, rows), A, B, PATTERN).collect()}
    assert got[2]["a"] == got[2]["b"] == got[3]["a"] == []
    for a, b in zip(got[1]["a"], got[1]["b"]):
        assert b"".join(pair.bytes_a[i] for i in a) == b"".join(pair.bytes_b[i] for i in b)
    assert b"".join(pair.bytes_a[i] for g in got[1]["a"] for i in g).decode() == " " + rows[0][1]


def test_linked_tokens_end_in_one_another(spark):
    """The bound on the pairs: one's bytes are a suffix of the other's."""
    pair = pair_of(A, B, PATTERN)
    for r in pair_counts(aligned(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), A, B, PATTERN), 32000).collect():
        x, y = pair.bytes_a[r["a"]], pair.bytes_b[r["b"]]
        assert x.endswith(y) or y.endswith(x)


def test_empty_table_and_texts_without_tokens(spark):
    assert alignments(documents(spark, []), A, B, PATTERN).count() == 0
    none = alignments(documents(spark, [(1, None), (2, "▁")]), A, B, PATTERN)
    assert sorted(map(tuple, none.collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_very_long_stretches(spark):
    rows = [(1, "x" + " " * 1_000_000 + "y"), (2, "".join(random.Random(1).choices("abcdefgh", k=300_000)))]
    got = {r["doc_id"]: r for r in alignments(documents(spark, rows), A, B, PATTERN).collect()}
    assert got[1]["n_a"] == 1 + 999_999 + 1 and got[2]["n_a"] > 100_000
