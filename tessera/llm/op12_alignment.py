"""Aligning the tokens of two tokenizers by pointer jumping.

1. A text with a space before it is cut where a space follows something that is no
   white space.  Both tokenizers begin a new token there (A's pattern never goes on
   past such a place, and no piece of B holds a space after another character; both
   are checked on loading), so each stretch is tokenized on its own, once for all its
   occurrences in a worker, and alignments of stretches put together are the text's.
2. In each stretch every token points to its farthest-right overlapping token: the one
   of the other side that covers its last byte, if that one ends further
   right.  Doubling all pointers of many stretches at once (next = next[next])
   ends at each component's last token, which labels the group.  Two tokens
   that end together, a group's last ones, are linked.
3. Tasks count linked id pairs; sums per pair and the highest per B id follow
   with DataFrames.  Of two tokens that end together one's bytes are a suffix of the
   other's, so there are at most as many pairs as the vocabularies hold bytes
   (twice that, as a byte can be spelt in two ways): a proven bound, whatever
   the corpus, for what goes through the driver to the tasks.
4. The documents' links were stored with them (compressed), so that the texts are
   tokenized once; a second job over them sums the counts per document.

Defined results: null and empty texts have no tokens, and neither have texts that one of
the tokenizers does not reproduce byte for byte (zeros and an empty digest);
they count no links.  Special tokens' strings are plain text.  A very long
stretch is tokenized whole, in time that grows with n log n.  Repeated rows
are documents of their own; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batch_of, chunks, register, rows_in, store, table, text_or_empty
from tessera.llm.op4_packing import Ids, byte_of

#: Stretches a worker remembers (twice), the longest it does, and the longest it encodes by ranks.
KEPT, KEPT_CHARS, RANKED_CHARS = 1 << 17, 64, 1 << 10
#: Space that follows other white space: there the plain cut at spaces does not hold.
AFTER_BLANK = re.compile(r"\s ")


def stretches(text: str) -> list[str]:
    """The text's stretches, each without the space it begins with; joined by spaces they are the text."""
    parts = text.split(" ")
    if not (text.startswith(" ") or text.endswith(" ") or AFTER_BLANK.search(text)):
        return parts
    out: list[str] = []
    held: list[str] = []
    for part in parts:
        held.append(part)
        if part and not part[-1].isspace():
            out.append(" ".join(held))
            held = []
    if held:  # white space at the end stays with what is before it
        out.append(" ".join([out.pop(), *held] if out else held))
    return out


def labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every A and every B token the A token that ends its group.

    Ends ascend on either side and the last ones are equal.
    """
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)  # the B token that covers an A token's last byte
    over_b = np.searchsorted(ends_a, ends_b)
    to = np.concatenate([np.where(ends_b[over_a] > ends_a, n + over_a, np.arange(n)), over_b]) if n else np.empty(0, np.int64)
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to[:n], to[n:]
        to = further


class Pair:
    """Two tokenizers and what they make of stretches."""

    def __init__(self, path_a: str, path_b: str, pattern: str):
        import sentencepiece

        self.a = Ids(path_a, pattern)  # the file's ranks give the tokenizer's ids faster
        self.a.tokenizer.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        spelled = byte_of()
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in spelled for c in token):  # others are special tokens, never made from text
                self.bytes_a[i] = bytes(spelled[c] for c in token)
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        self.bytes_b = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            raw = byte.fullmatch(piece) if self.b.is_byte(i) else None
            self.bytes_b.append(bytes([int(raw[1], 16)]) if raw else piece.replace("▁", " ").encode())
        before = json.loads(self.a.tokenizer.to_str())["pre_tokenizer"] or {}
        if before.get("type") != "ByteLevel" or not before.get("use_regex") or any(re.search(rb"[^ ] ", raw) for raw in self.bytes_b):
            raise ValueError("a token can hold a space after another character: texts cannot be cut at spaces")
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        #: An id with the sign before it: between tokens, between groups, between the sides.
        self.spelt = [sign + str(i) for sign in (",", ";", "") for i in range(len(self.bytes_a))]
        self.spelt += [sign + str(i) for sign in (",", "|") for i in range(len(self.bytes_b))]
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def code_a(self, part: str) -> list[int]:
        if self.a.by_rank is None or len(part) > RANKED_CHARS:
            return self.a.tokenizer.encode(" " + part, add_special_tokens=False).ids
        return self.a.by_rank.encode_ordinary(" " + part)

    def align(self, parts: list[str]) -> list[tuple | None]:
        """Per stretch (n_a, n_b, n_groups, groups, links); None where a tokenizer does not reproduce it.

        ``links`` are keys a * |B| + b, one a group, as bytes of 64-bit integers.
        """
        coded_a = [self.code_a(p) for p in parts]
        coded_b = self.b.encode(parts, out_type=int, num_threads=1)
        raw = [(" " + p).encode() for p in parts]
        good = [True] * len(parts)
        for coded, known in ((coded_a, self.bytes_a), (coded_b, self.bytes_b)):
            made = [b"".join(map(known.__getitem__, c)) for c in coded]
            if made != raw:
                good = [g and m == r for g, m, r in zip(good, made, raw)]
        kept_a, kept_b = ([c for c, g in zip(coded, good) if g] for coded in (coded_a, coded_b))
        n_a, n_b = (np.fromiter(map(len, kept), np.int64, len(kept)) for kept in (kept_a, kept_b))
        ids_a, ids_b = (np.fromiter(itertools.chain.from_iterable(kept), np.int64, int(n.sum())) for kept, n in ((kept_a, n_a), (kept_b, n_b)))
        ends_a, ends_b = np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b])
        label_a, label_b = labels(ends_a, ends_b)
        last = np.flatnonzero(label_a == np.arange(len(label_a)))  # one A token a group
        links = (ids_a[last] * len(self.bytes_b) + ids_b[np.searchsorted(ends_b, ends_a[last])]).tobytes()
        upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
        upto_g = np.searchsorted(last, upto_a)  # groups that end within the stretches so far

        # the tokens of both sides in the order in which they are written: by group, A before B
        group_a, group_b = np.searchsorted(last, label_a), np.searchsorted(last, label_b)
        ends_of_a, ends_of_b = last + 1, np.searchsorted(group_b, np.arange(len(last)), "right")
        first_a = np.diff(group_a, prepend=-1) > 0
        sign = first_a.astype(np.int64)
        sign[upto_a - n_a] = 2  # nothing before a stretch's first token
        written = np.empty(len(ids_a) + len(ids_b), np.int64)
        written[np.arange(len(ids_a)) + np.where(group_a > 0, ends_of_b[group_a - 1], 0)] = sign * len(self.bytes_a) + ids_a
        first_b = np.diff(group_b, prepend=-1) > 0
        written[np.arange(len(ids_b)) + ends_of_a[group_b]] = 3 * len(self.bytes_a) + first_b * len(self.bytes_b) + ids_b
        texts = list(map(self.spelt.__getitem__, written.tolist()))
        out: list[tuple | None] = []
        t = g = 0
        rows = zip(n_a.tolist(), n_b.tolist(), (upto_a + upto_b).tolist(), upto_g.tolist())
        for ok in good:
            if not ok:
                out.append(None)
                continue
            a, b, upto, groups_upto = next(rows)
            out.append((a, b, groups_upto - g, "".join(texts[t:upto]), links[8 * g : 8 * groups_upto]))
            t, g = upto, groups_upto
        return out

    def texts(self, texts: list[str]) -> tuple[list[list[str]], dict[str, tuple | None]]:
        """The stretches of each text, and the alignment of each of them.

        What is known is kept in two halves: once the newer is full it becomes the older
        one, and what is used again moves up.
        """
        cut = [stretches(t) if t else [] for t in texts]
        if len(self.known) > KEPT:
            self.known, self.older = {}, self.known
        have, new = {}, []
        for p in set().union(*cut):
            if p in self.known:
                have[p] = self.known[p]
            elif p in self.older:
                have[p] = self.known[p] = self.older[p]
            else:
                new.append(p)
        for at in range(0, len(new), 1 << 14):
            part = new[at : at + (1 << 14)]
            made = dict(zip(part, self.align(part)))
            have.update(made)
            self.known.update((p, v) for p, v in made.items() if len(p) <= KEPT_CHARS)
        return cut, have


_pairs: dict[tuple[str, str, str], Pair] = {}


def pair_of(path_a: str, path_b: str, pattern: str) -> Pair:
    """One pair of tokenizers for all tasks of a worker."""
    key = (path_a, path_b, pattern)
    if key not in _pairs:
        _pairs[key] = Pair(*key)
    return _pairs[key]


ALIGNED = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups")] + [("groups_sha256", pa.string()), ("links", pa.binary())]
)
COUNTS = pa.schema([("pair", pa.int64()), ("n", pa.int64())])


def pack(links: bytes) -> bytes:
    """Bytes of 64-bit integers, compressed, with their number before them."""
    return len(links).to_bytes(8, "little") + pa.compress(links, "zstd", asbytes=True)


def unpack(packed: bytes) -> bytes:
    return pa.decompress(memoryview(packed)[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)


def aligned(docs: DataFrame, path_a: str, path_b: str, pattern: str) -> DataFrame:
    """One row per document: numbers of tokens and groups, the groups' digest, and its links (packed keys a * |B| + b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(path_a, path_b, pattern)
        for rows in chunks(rows_in(batches), lambda r: len(r[1]), 1 << 22):
            cut, have = pair.texts([r[1] for r in rows])
            bad = {p for p, v in have.items() if v is None}
            out = []
            for (doc_id, _), parts in zip(rows, cut):
                if not parts or (bad and bad.intersection(parts)):
                    out.append((doc_id, 0, 0, 0, "", pack(b"")))
                    continue
                n_a, n_b, n_groups, groups, links = zip(*map(have.__getitem__, parts))
                digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
                out.append((doc_id, sum(n_a), sum(n_b), sum(n_groups), digest, pack(b"".join(links))))
            yield batch_of(ALIGNED, list(zip(*out)))

    return docs.select("doc_id", text_or_empty("text").alias("text")).mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"
    )


def link_batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of ``batches`` with all links of their rows and how many each row has."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            raw = [unpack(x) for x in part.column(column).to_pylist()]
            yield part, np.frombuffer(b"".join(raw), np.int64), np.fromiter(map(len, raw), np.int64, len(raw)) // 8


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """(a, b, n): how many links of ``aligned`` rows hold A id ``a`` and B id ``b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times = np.empty(0, np.int64), np.empty(0, np.int64)
        for _, links, _ in link_batches(batches, "links"):
            new, often = np.unique(links, return_counts=True)
            both, where = np.unique(np.concatenate([keys, new]), return_inverse=True)
            summed = np.zeros(len(both), np.int64)
            np.add.at(summed, where, np.concatenate([times, often]))
            keys, times = both, summed
        if len(keys):
            yield batch_of(COUNTS, [keys, times])

    counted = rows.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return counted.select(F.expr(f"pair div {size_b}").cast("int").alias("a"), (F.col("pair") % size_b).cast("int").alias("b"), "n")


def best_flags(counts: DataFrame) -> DataFrame:
    """``counts`` with ``best``: whether ``n`` is the highest of its B id."""
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))
    return counts.join(highest, "b").select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best"))


ROWS = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [("groups_sha256", pa.string())]
)


def alignments(docs: DataFrame, path_a: str, path_b: str, pattern: str) -> DataFrame:
    """One row per document: its numbers of tokens, groups and links, how many links are best, their counts' sum, its groups' digest."""
    size_b = len(pair_of(path_a, path_b, pattern).bytes_b)
    rows = store(aligned(docs, path_a, path_b, pattern), "aligned")
    known = best_flags(pair_counts(rows, size_b)).toArrow()  # bounded by the vocabularies (see above)
    keys = known["a"].to_numpy().astype(np.int64) * size_b + known["b"].to_numpy()
    order = np.argsort(keys)
    keys, counts = keys[order], known["n"].to_numpy()[order]
    best = known["best"].to_numpy()[order].astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, links, sizes in link_batches(batches, "links"):
            at = np.searchsorted(keys, links)
            upto = np.cumsum(sizes)
            facts = []
            for of_key in (best, counts):
                sums = np.concatenate([[0], np.cumsum(of_key[at])])
                facts.append(pa.array(sums[upto] - sums[upto - sizes], pa.int64()))
            own = {c: part.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "groups_sha256")}
            own |= {"n_links": own["n_groups"], "n_best": facts[0], "count_sum": facts[1]}
            yield pa.RecordBatch.from_arrays([own[f.name] for f in ROWS], schema=ROWS)

    return rows.mapInArrow(
        run,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    )


GROUPS = pa.schema(
    [("doc_id", pa.int64()), ("a", pa.list_(pa.list_(pa.int32()))), ("b", pa.list_(pa.list_(pa.int32())))]
)


def groups(docs: DataFrame, path_a: str, path_b: str, pattern: str) -> DataFrame:
    """(doc_id, a, b): per document the A ids and the B ids of each group, in order; empty without tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(path_a, path_b, pattern)
        for rows in chunks(rows_in(batches), lambda r: len(r[1]), 1 << 19):
            cut, have = pair.texts([r[1] for r in rows])
            out = []
            for (doc_id, _), parts in zip(rows, cut):
                own = [have[p] for p in parts]
                sides = [g.split("|") for x in own for g in x[3].split(";")] if all(own) else []
                out.append((doc_id, *([[int(i) for i in s[k].split(",")] for s in sides] for k in (0, 1))))
            yield batch_of(GROUPS, list(zip(*out)))

    return docs.select("doc_id", text_or_empty("text").alias("text")).mapInArrow(
        run, "doc_id long, a array<array<int>>, b array<array<int>>"
    )


@register("op12_alignment")
def op12(spark, sf_dir):
    import public_tokenizers

    return alignments(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
        public_tokenizers.PATTERN,
    )
