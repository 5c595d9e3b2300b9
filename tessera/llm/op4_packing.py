"""Best-fit packing of tokenized documents after Martello-Toth reduction.

1. Tokenize once (tasks write pieces to the shared folder).  A document's ids
   end with an end id; longer ones than a sequence are cut so that every piece
   but the first is full.  Each row notes its task and its rank among that
   task's pieces of the same length.
2. Count pieces by length: at most ``capacity`` rows, however large the corpus.
3. On those counts, the dominance reduction permanently fixes small sets: the
   largest length j with its largest partner k, when {j, k} provably dominates
   every other set that holds j (k fills the room; or no two partners fit; or
   at most two fit and no pair of them exceeds k), and {j} alone when nothing
   fits.  What is left is packed best-fit decreasing.  A plan is a list of
   patterns (lengths in one sequence) with how often each is used.
4. Ranks over all tasks come from summed counts per (task, length); a rank
   and the plan give a piece its sequence and place, without a shuffle by
   length, so a length held by a third of all rows is no hot key.

Defined results: null text counts as empty (only the end id); a very long text
is one row of its task, in time about linear in its length; repeated rows
are packed like others; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import batch_of, chunks, register, rows_in, store, table, text_or_empty

CAPACITY, END = 1024, 2
#: White space in a row from which the rank encoder is not used: its pattern backtracks over it.
BLANK_RUN = 100_000
LONG_BLANK = re.compile(rf"\s{{{BLANK_RUN}}}")


def byte_of() -> dict[str, int]:
    """Byte of each character in which byte-level vocabularies spell tokens: printable bytes stand for themselves, others follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}


class Ids:
    """Ids of texts as little-endian bytes, those the tokenizer file defines.

    The file's vocabulary numbers its merges in order, so its ids are ranks
    and the faster rank encoder gives the same ids (checked on loading as far
    as the file goes, and by tests against the tokenizer itself).  Texts that
    hold a special token's string or more white space in a row than the rank
    encoder's pattern bears, and files of another kind, go through the tokenizer.
    """

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary, spelled = model["vocab"], byte_of()
        made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        ranks = {bytes(spelled[c] for c in t): i for t, i in vocabulary.items() if t not in self.special}
        self.by_rank = None
        if made == sorted(made) and sorted(ranks.values()) == list(range(len(made) + 256)):
            self.by_rank = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        blank = len(text) > BLANK_RUN and LONG_BLANK.search(text)
        if self.by_rank is None or blank or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.by_rank.encode_to_numpy(text).astype("<u4", copy=False).tobytes()


_ids: dict[str, Ids] = {}


def encoder(path: str, pattern: str) -> Ids:
    """One encoder for all tasks of a worker."""
    if path not in _ids:
        _ids[path] = Ids(path, pattern)
    return _ids[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be short."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))] if n else []


PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64()),
     ("task", pa.int32()), ("task_rank", pa.int64())]
)


def pieces(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, task, seen = encoder(path, pattern), TaskContext.get().partitionId(), defaultdict(int)
        for rows in chunks(rows_in(batches), lambda r: len(r[1]), 1 << 20):
            out = []
            for doc_id, text in rows:
                raw = ids(text) + tail
                for k, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                    out.append((doc_id, k, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), task, seen[length]))
                    seen[length] += 1
            yield batch_of(PIECES, list(zip(*out)))

    return docs.select("doc_id", text_or_empty("text").alias("text")).mapInArrow(
        run, "doc_id long, piece int, start long, length int, ids_crc32 long, task int, task_rank long"
    )


def reduce(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """(fixed patterns with how often, remaining counts) by dominance."""
    left = {w: n for w, n in counts.items() if n}
    fixed: list[tuple[tuple[int, ...], int]] = []

    def smallest(skip: int, most: int) -> list[int]:
        """The least lengths on hand besides one piece of length ``skip``."""
        out: list[int] = []
        for w in sorted(left):
            out += [w] * min(most - len(out), left[w] - (w == skip))
            if len(out) >= most:
                break
        return out

    def best_pair(skip: int, room: int) -> int:
        have = sorted(w for w in left if w <= room and left[w] - (w == skip) > 0)
        best, hi = 0, len(have) - 1
        for lo, a in enumerate(have):
            while hi >= lo and a + have[hi] > room:
                hi -= 1
            if hi < lo:
                break
            b = have[hi]
            if a == b and left[a] - (a == skip) < 2:
                if hi == lo:
                    break
                b = have[hi - 1] if hi > lo else 0
            best = max(best, a + b if b else 0)
        return best

    changed = True
    while changed:
        changed = False
        for j in sorted(left, reverse=True):
            while left.get(j):
                room = capacity - j
                partners = [w for w in left if w <= room and left[w] - (w == j) > 0]
                if not partners:
                    fixed.append(((j,), left.pop(j)))
                    changed = True
                    break
                k = max(partners)
                if k < room:
                    few = smallest(j, 3)
                    two = len(few) >= 2 and few[0] + few[1] <= room
                    three = len(few) >= 3 and sum(few) <= room
                    if two and (three or best_pair(j, room) > k):
                        break
                times = left[j] // 2 if j == k else min(left[j], left[k])
                if k < room:  # while four of each are left, the sets that fit stay the same; then one at a time
                    times = max(1, times - 4)
                fixed.append(((j, k), times))
                for w in (j, k):
                    left[w] -= times
                    if not left[w]:
                        del left[w]
                changed = True
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: the same bins as piece by piece."""
    open_bins: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # room -> pattern -> how many
    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            room = min((r for r in open_bins if r >= w), default=capacity)
            if open_bins.get(room):
                pattern, bins = open_bins[room].popitem()
                if not open_bins[room]:
                    del open_bins[room]
            else:
                pattern, bins = (), n
            each = room // w  # best fit returns to the bin just used until it is too full
            full = min(bins, n // each)
            rest = n - full * each if full < bins else 0
            rest = min(rest, each - 1)
            for used, times in ((each, full), (rest, 1 if rest else 0)):
                if times:
                    into, key = open_bins[room - used * w], pattern + (w,) * used
                    into[key] = into.get(key, 0) + times
            untouched = bins - full - (1 if rest else 0)
            if pattern and untouched:
                open_bins[room][pattern] = open_bins[room].get(pattern, 0) + untouched
            n -= full * each + rest
    return [(p, n) for group in open_bins.values() for p, n in group.items()]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    fixed, left = reduce(counts, capacity)
    return fixed + best_fit(left, capacity)


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For every slot of every pattern: which ranks of its length it takes, from which sequence, at which offset."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for w in pattern:
            rows.append((w, used[w], sequence, offset))
            used[w] += times
            offset += w
        sequence += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4)
    return {"key": cols[:, 0] << 44 | cols[:, 1], "rank": cols[:, 1], "sequence": cols[:, 2], "offset": cols[:, 3]}


def pack(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    rows = store(pieces(docs, path, pattern, capacity, end), "pieces")
    per_task = rows.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    slots = places(plan(counts, capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(slots["key"], length << 44 | rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "long_length", "ids_crc32")),
                 pa.array(slots["sequence"][at] + rank - slots["rank"][at]), pa.array(slots["offset"][at])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = rows.join(per_task.drop("n"), ["task", "length"]).select(
        "doc_id", "piece", "start", "length", F.col("length").cast("long").alias("long_length"), "ids_crc32",
        (F.col("before") + F.col("task_rank")).alias("rank"),
    )
    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def production(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@register("op4_packing")
def op4(spark, sf_dir):
    return production(table(spark, sf_dir, "documents"))
