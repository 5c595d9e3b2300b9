"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A text's paragraphs are its pieces between line feeds (empty pieces count, so
a text of n line feeds has n + 1).  Each paragraph hashes to a wide vector:
``WIDE`` uniform lanes modulo 2^64 (SHAKE-128 output) followed by ``LIKE``
lanes modulo 2^32, into which every run of three words inside the paragraph
adds +1 or -1 at one lane.  A fingerprint is the sum of the vectors, so it
does not depend on paragraph order, and paragraphs can be added or removed
later without the rest of the text.  The wide lanes decide equality; the
like lanes keep inner products, so likeness is their cosine.

Defined results: null text counts as empty; equal fingerprints have likeness
1.0; if just one side has words, 0.0.  Likeness is an estimate with standard
error about 1 / sqrt(LIKE), clipped to 0..1.  Repeated ids and null ids are
rows like others (null sorts first; ties go by text).  Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batch_of, register, rows_in, table, text_or_empty
from tessera.llm.words import mix, word_hashes

WIDE, LIKE, RUN = 16, 128, 3
#: Id ranges at most: their bounds are part of the plan.  A task streams its range, so larger ones need no more memory.
RANGES = 16384


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The wide lanes (n, WIDE) and like lanes (n, LIKE) of whole texts."""
    digests, counts = [], []
    for text in texts:
        parts = text.encode("utf-8", "surrogatepass").split(b"\n")
        counts.append(len(parts))
        digests += [hashlib.shake_128(p).digest(8 * WIDE) for p in parts]
    lanes = np.frombuffer(b"".join(digests), "<u8").reshape(-1, WIDE)
    first = np.cumsum(counts) - counts
    wide = np.add.reduceat(lanes, first, axis=0) if texts else np.zeros((0, WIDE), np.uint64)
    h, words, lines = word_hashes(texts)
    n = len(h)
    run = h.copy()
    for j in range(1, RUN):
        if n > j:
            same = lines[j:] == lines[:-j]
            run[:-j] += np.where(same, h[j:] * np.uint64(2 * j + 1), np.uint64(0))
    run = mix(run)
    owner = np.repeat(np.arange(len(texts)), words)
    at = owner * LIKE + (run % np.uint64(LIKE)).astype(np.int64)
    sign = 1.0 - 2.0 * (run >> np.uint64(63)).astype(np.float64)
    like = np.bincount(at, sign, minlength=len(texts) * LIKE).reshape(-1, LIKE)
    return wide, like.astype(np.int64).astype(np.uint32)


def pack(wide: np.ndarray, like: np.ndarray) -> str:
    return wide.astype("<u8").tobytes().hex() + like.astype("<u4").tobytes().hex()


def unpack(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = bytes.fromhex(fingerprint)
    return np.frombuffer(raw[: 8 * WIDE], "<u8"), np.frombuffer(raw[8 * WIDE :], "<u4")


def fingerprint(text: str | None) -> str:
    wide, like = vectors([text or ""])
    return pack(wide[0], like[0])


def changed(fp: str, insert: Iterable[str] = (), delete: Iterable[str] = ()) -> str:
    """The fingerprint after paragraphs come and go; costs only those paragraphs."""
    wide, like = (x.copy() for x in unpack(fp))
    for paragraphs, sign in ((list(insert), 1), (list(delete), -1)):
        if paragraphs:
            w, k = vectors(paragraphs)
            w, k = w.sum(0, dtype=np.uint64), k.sum(0, dtype=np.uint32)
            wide, like = (wide + w, like + k) if sign > 0 else (wide - w, like - k)
    return pack(wide, like)


def cosines(wa, la, wb, lb) -> np.ndarray:
    """Likeness row by row, from fingerprint lanes only."""
    a, b = la.astype(np.int32).astype(np.float64), lb.astype(np.int32).astype(np.float64)
    norm = np.sqrt((a * a).sum(1) * (b * b).sum(1))
    cos = np.divide((a * b).sum(1), norm, out=np.zeros(len(a)), where=norm > 0)
    equal = (wa == wb).all(1) & (la == lb).all(1)
    return np.where(equal, 1.0, np.clip(cos, 0.0, 1.0))


def likeness(fp_a: str, fp_b: str) -> float:
    (wa, la), (wb, lb) = unpack(fp_a), unpack(fp_b)
    return float(cosines(wa[None], la[None], wb[None], lb[None])[0])


def _range_number(ids, bounds: list):
    """How many of the sorted bounds are <= the id, by a two-level search."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    heads = F.array(*[F.lit(b) for b in bounds[::step]])
    parts = F.array(*[F.array(*[F.lit(b) for b in bounds[i : i + step]]) for i in range(0, len(bounds), step)])
    head = F.size(F.filter(heads, lambda x: x <= ids))
    part = F.element_at(parts, F.greatest(head, F.lit(1)))
    return F.when(ids.isNull() | (head == 0), 0).otherwise((head - 1) * step + F.size(F.filter(part, lambda x: x <= ids)))


def in_id_order(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """(range, carried, doc_id, text): id ranges with, at each one's end, the next range's first row.

    One shuffle of the texts.  The driver sees two numbers per range.
    """
    spark = docs.sparkSession
    ranges = ranges or min(RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = docs.select("doc_id", text_or_empty("text").alias("text"))
    ids = docs.select("doc_id")
    wanted = [i / ranges for i in range(1, ranges)]
    bounds = sorted({int(b) for b in ids.approxQuantile("doc_id", wanted, 0.25 / ranges)}) if wanted else []
    docs = docs.withColumn("range", _range_number(F.col("doc_id"), bounds))
    firsts = (
        docs.groupBy("range").agg(F.min(F.struct("doc_id")).alias("first")).orderBy("range").collect()
    )  # a row per range
    if not firsts:
        return docs.select("range", F.lit(False).alias("carried"), "doc_id", "text")
    before = {r["range"]: firsts[i - 1]["range"] for i, r in enumerate(firsts)}
    edges = spark.createDataFrame(
        [(r["range"], r["first"]["doc_id"], before[r["range"]]) for r in firsts],
        "range int, first_id long, previous int",
    )
    copies = F.when(
        F.col("doc_id").eqNullSafe(F.col("first_id")),
        F.array(
            F.struct(F.col("range").alias("r"), F.lit(False).alias("c")),
            F.struct(F.col("previous").alias("r"), F.lit(True).alias("c")),
        ),
    ).otherwise(F.array(F.struct(F.col("range").alias("r"), F.lit(False).alias("c"))))
    return (
        docs.join(F.broadcast(edges), "range")  # a row per range
        .select(F.explode(copies).alias("to"), "doc_id", "text")
        .select(F.col("to.r").alias("range"), F.col("to.c").alias("carried"), "doc_id", "text")
        .repartition(F.col("range"))
        .sortWithinPartitions("range", "carried", "doc_id", "text")
    )


SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(text: str, following: str) -> str:
    n = len(text)
    return text[: n - n // 2] + following[: n // 2]


def _runs(rows: Iterator[tuple], most: int = 1 << 20) -> Iterator[list[tuple]]:
    """Lists of consecutive rows whose last row only serves as the next of the one before."""
    held, total = [], 0
    for row in rows:
        if held and held[-1][0] != row[0]:
            if len(held) > 1:
                yield held
            held, total = [], 0
        if held and held[-1][1]:  # carried rows after the first serve nobody
            continue
        held.append(row)
        total += len(row[3])
        if total >= most and len(held) > 1:
            yield held
            held, total = [row], len(row[3])
    if len(held) > 1:
        yield held


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for run in _runs(rows_in(batches)):
        texts = [r[3] for r in run]
        changed_texts = [edited(a, b) for a, b in zip(texts, texts[1:])]
        wide, like = vectors(texts)
        ewide, elike = vectors(changed_texts)
        n = len(changed_texts)
        yield batch_of(SCHEMA, [
            [r[2] for r in run[:-1]],
            [len(t) for t in texts[:-1]],
            [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed_texts],
            [pack(wide[i], like[i]) for i in range(n)],
            [pack(ewide[i], elike[i]) for i in range(n)],
            cosines(wide[:-1], like[:-1], ewide, elike),
            cosines(wide[:-1], like[:-1], wide[1:], like[1:]),
        ])


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of documents, of their edited texts, and the likeness of neighbours by id."""
    return in_id_order(docs, ranges).mapInArrow(_judge, DDL)


@register("op1_fingerprints")
def op1(spark, sf_dir):
    return fingerprints(table(spark, sf_dir, "documents"))
