"""Language ID with hyperdimensional profiles.

Every letter (and the gap between words) has a random vector of +1 and -1,
drawn from its code point.  A letter trigram is bound as the product of its
three letters' vectors, each rotated by its place; a text is the bundle (sum)
of its trigrams; a language's prototype is the bundle of unit vectors of
known texts.  A text gets the language of the prototype with the largest
cosine, which is its score (clipped to 0..1).

Prototypes are learnt from at most ``PER_LANGUAGE`` documents of each
language, those of least hash: a documented bound on a labelled sample.  They
are the only thing broadcast (languages x ``DIM`` numbers).

Whether a text is in any learnt language at all is too fine a question for
cosines of ``DIM`` numbers (unrelated ones differ by 0.04).  :func:`keep_known`
asks it of counts: the mean logarithm of the probability of a text's trigrams
in a language, from their counts over *all* training rows in ``BUCKETS``
hashed buckets.  Bounds are set from the same rows, by language and by how
many trigrams a text effectively has: between labelled texts and their
excerpts of 1 to 128 words (less the row's own counts) on one side, and those
of the other languages and of evenly drawn letters on the other.  Where the
two overlap the bound is the least thousandth of the labelled ones, so clean
texts stay.

Defined results: null text or text without a letter gives ``und`` and score
0; so does any text when nothing was learnt.  Rows without a language teach
nothing; rows with a null id neither teach nor are held out.  Ties go to the
first language by name.  Other columns are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batch_of, chunks, keep_rows, register, rows_in, table, text_or_empty

DIM, PER_LANGUAGE, SCALE = 512, 2000, 1 << 20
DENSE = 1 << 22
BITS = 17
BUCKETS = 1 << BITS
#: Words in the excerpts that set the bounds; bins of a bit; labelled texts of a bound at least, if there are; share below it.
EXCERPTS, STEPS, ENOUGH, LOST = (1, 2, 4, 8, 16, 32, 64, 128), 16, 1000, 0.001

_letters: dict[int, np.ndarray] = {}
_is_letter: list[np.ndarray] = []


def letter_vector(code: int) -> np.ndarray:
    if code not in _letters:
        _letters[code] = np.random.default_rng([71, code]).choice(np.array([-1, 1], np.float32), DIM)
    return _letters[code]


def is_letter() -> np.ndarray:
    if not _is_letter:
        _is_letter.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _is_letter[0]


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts' letters, 0 for a gap; the text of each)."""
    codes = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
    c = np.concatenate(codes).astype(np.int64)
    c = np.where(is_letter()[c], c, 0)
    keep = (c != 0) | (np.concatenate([[1], c[:-1]]) != 0) | (np.concatenate([[-1], owner[:-1]]) != owner)
    return c[keep], owner[keep]


def bundles(texts: list[str]) -> np.ndarray:
    """(n, DIM): each text's sum of trigram vectors; zero without a letter."""
    c, owner = letters(texts)
    present = np.flatnonzero(np.bincount(c))
    number = np.zeros(present[-1] + 1, np.int64)
    number[present] = np.arange(len(present))
    c, n = number[c], len(present)
    inside = owner[2:] == owner[:-2]
    gram, owner = ((c[:-2] * n + c[1:-1]) * n + c[2:])[inside], owner[2:][inside]
    out = np.zeros((len(texts), DIM), np.float32)
    if not len(gram):
        return out
    if n**3 <= DENSE:
        found = np.flatnonzero(np.bincount(gram, minlength=n**3))
        column = np.zeros(n**3, np.int32)
        column[found] = np.arange(len(found))
        column = column[gram]
    else:
        found, column = np.unique(gram, return_inverse=True)
    first, second, third = found // (n * n), found // n % n, found % n
    vectors = np.stack([letter_vector(int(p)) for p in present])
    grams = vectors[first] * np.roll(vectors, 1, 1)[second] * np.roll(vectors, 2, 1)[third]
    step = max(1, (1 << 24) // len(found))
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    for a in range(0, len(texts), step):
        b = min(a + step, len(texts))
        lo, hi = ends[a], ends[b]
        counts = np.bincount((owner[lo:hi] - a) * len(found) + column[lo:hi], minlength=(b - a) * len(found))
        out[a:b] = counts.reshape(b - a, -1).astype(np.float32) @ grams
    return out


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def remainder(col: str, by: int):
    """crc32 of the id as text modulo ``by``; null for a null id."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % by


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """(languages, prototypes as unit rows) from rows (doc_id, text, lang)."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").count().collect()  # a row per language
    if not counts:
        return [], np.zeros((0, DIM), np.float32)
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, per_language / r["count"])) for r in counts], "lang string, share double")
    draw = (F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 30) - 1)) / float(1 << 30))
    sample = known.join(F.broadcast(shares), "lang").filter(draw < F.col("share")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for rows in chunks(rows_in(batches), lambda r: len(r[1]), 1 << 20, 512):
            own = np.rint(unit(bundles([r[1] for r in rows])) * SCALE).astype(np.int64)  # whole numbers: sums in any order agree
            for (lang, _), v in zip(rows, own):
                sums[lang] = sums.get(lang, 0) + v
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * DIM), pa.array(np.arange(DIM, dtype=np.int32)), pa.array(v)], names=["lang", "dim", "value"]
            )

    sums = sample.mapInArrow(run, "lang string, dim int, value long").groupBy("lang", "dim").agg(F.sum("value").alias("value")).collect()
    langs = sorted({r["lang"] for r in sums})
    out = np.zeros((len(langs), DIM), np.float32)
    for r in sums:
        out[langs.index(r["lang"]), r["dim"]] = r["value"]
    return langs, unit(out)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def judged(texts: list[str], langs: list[str], prototypes: np.ndarray) -> tuple[list[str], np.ndarray]:
    v = bundles(texts)
    if not langs:
        return ["und"] * len(texts), np.zeros(len(texts))
    cos = unit(v) @ prototypes.T
    best, some = cos.argmax(1), np.array([any(map(str.isalpha, t)) for t in texts])
    score = np.where(some, np.clip(cos.max(1), 0.0, 1.0), 0.0).astype(np.float64)
    return [langs[b] if s else "und" for b, s in zip(best, some)], score


def predict(docs: DataFrame, langs: list[str], prototypes: np.ndarray, held_out=None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(rows_in(batches), lambda r: len(r[2]), 1 << 20, 512):
            names, score = judged([r[2] for r in rows], langs, prototypes)
            yield batch_of(SCHEMA, [[r[0] for r in rows], [r[1] for r in rows], names, score])

    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), text_or_empty("text").alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double"
    )


def buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every trigram, the text of each)."""
    c, owner = letters(texts)
    inside = owner[2:] == owner[:-2]
    c = c.astype(np.uint64)
    h = (c[:-2] * np.uint64(0x9E3779B97F4A7C55) + c[1:-1]) * np.uint64(0xBF58476D1CE4E5B9) + c[2:]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)[inside], owner[2:][inside]


def counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, occurrences) of every bucket of every text, in order."""
    found, owner = buckets(texts)
    key, n = np.unique(owner * BUCKETS + found, return_counts=True)
    return key >> BITS, key & (BUCKETS - 1), n


def sizes(owner: np.ndarray, n: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(trigrams, class) of each text: the class is log2 of its effective number of different trigrams."""
    total = np.bincount(owner, n, texts)
    return total, np.log2(np.maximum(total, 1) ** 2 / np.maximum(np.bincount(owner, n.astype(float) ** 2, texts), 1)).astype(np.int64)


@dataclass
class Known:
    """Trigram counts of each language, and the mean bits per trigram that its texts reach, by class."""

    counts: np.ndarray  # languages x BUCKETS
    least: np.ndarray | None = None  # languages x classes

    def bits(self) -> np.ndarray:
        return np.log2((self.counts + 0.5) / (self.counts.sum(1, keepdims=True) + 0.5 * BUCKETS)).astype(np.float32)


def fits(texts: list[str], bits: np.ndarray, least: np.ndarray) -> list[bool]:
    """Whether each text has a letter and reaches the bound of some language."""
    owner, bucket, n = counted(texts)
    total, size = sizes(owner, n, len(texts))
    size = np.minimum(size, least.shape[1] - 1)
    ok = np.zeros(len(texts), bool)
    for own, bound in zip(bits, least):
        ok |= np.bincount(owner, n * own[bucket], len(texts)) >= bound[size] * total
    return (ok & (total > 0)).tolist()


def excerpts(text: str) -> list[str]:
    """Excerpts of a text at places drawn from it, each followed by its copy in evenly drawn letters of the text."""
    words = text.split()
    draw = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    parts = [" ".join(words[a : a + k]) for k in EXCERPTS if k <= len(words) for a in [int(draw.integers(len(words) - k + 1))]]
    if not parts:
        return []
    c = np.frombuffer("\n".join(parts).lower().encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    known = is_letter()[c]
    if known.any():
        c[known] = draw.choice(np.unique(c[known]), known.sum())
    noise = c.tobytes().decode("utf-32-le", "surrogatepass").split("\n")
    return [t for pair in zip(parts, noise) for t in pair]


def known_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for rows in chunks(rows_in(batches), lambda r: len(r[1]), 1 << 20, 512):
        for lang in {r[0] for r in rows}:
            own = np.bincount(buckets([r[1] for r in rows if r[0] == lang])[0], minlength=BUCKETS)
            sums[lang] = sums.get(lang, 0) + own
    for lang, v in sums.items():
        at = np.flatnonzero(v)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(v[at])], names=["lang", "bucket", "n"])


def histogram(rows: list[tuple[int, str]], counts: np.ndarray) -> dict[tuple[int, int, int, bool], int]:
    """(language, class, bin, whether the language's own) -> labelled texts, excerpts and noise of rows (language, text)."""
    texts, row, noise = [], [], []
    for i, (_, text) in enumerate(rows):
        parts = excerpts(text)
        texts += [text, *parts]
        row += [i] * (1 + len(parts))
        noise += [False, *[False, True] * (len(parts) // 2)]
    lang, row, noise = np.array([r[0] for r in rows]), np.array(row), np.array(noise)
    owner, bucket, n = counted(texts)
    total, size = sizes(owner, n, len(texts))
    whole = np.flatnonzero(np.diff(row, prepend=-1))  # each row's text itself
    mine = np.isin(owner, whole)
    keys, own_n = row[owner[mine]] * BUCKETS + bucket[mine], n[mine]
    at = np.minimum(np.searchsorted(keys, row[owner] * BUCKETS + bucket), max(len(keys) - 1, 0))
    less = np.where(keys[at] == row[owner] * BUCKETS + bucket, own_n[at], 0) if len(keys) else np.zeros(0)
    out: dict[tuple[int, int, int, bool], int] = {}
    for i, own in enumerate(counts):
        taught = lang[row] == i  # by this language's counts the row is judged without its own
        c = own[bucket] - np.where(taught[owner], less, 0)
        whole_n = own.sum() - np.where(taught, total[whole][row], 0)
        bits = np.bincount(owner, n * np.log2(c + 0.5), len(texts)) / np.maximum(total, 1) - np.log2(whole_n + 0.5 * BUCKETS)
        some = total > 0
        cells = np.stack([size, np.floor(bits * STEPS).astype(np.int64), taught & ~noise], 1)[some]
        for (a, b, good), k in zip(*np.unique(cells, axis=0, return_counts=True)):
            key = (i, int(a), int(b), bool(good))
            out[key] = out.get(key, 0) + int(k)
    return out


def bound(good: dict[int, int], bad: dict[int, int]) -> float:
    """Half way between the labelled texts and the others, LOST of each left out; the former's least if they overlap."""
    def edge(bins: dict[int, int], order: list[int]) -> int:
        left = LOST * sum(bins.values())
        for b in order:
            left -= bins[b]
            if left < 0:
                return b
        return order[-1]

    low = edge(good, sorted(good)) / STEPS
    high = (edge(bad, sorted(bad, reverse=True)) + 1) / STEPS if bad else low
    return (low + high) / 2 if high < low else low


def learn_known(docs: DataFrame) -> Known:
    """Trigram counts and bounds from all rows (doc_id, text, lang) that have each."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    sums = rows.mapInArrow(known_sums, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sums["lang"].to_pylist()
    langs = sorted(set(names))
    number = {name: i for i, name in enumerate(langs)}
    counts = np.zeros((len(langs), BUCKETS))
    counts[[number[x] for x in names], sums["bucket"].to_numpy()] = sums["n"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int, int, bool], int] = {}
        for part in chunks(rows_in(batches), lambda r: len(r[1]), 1 << 19, 256):
            for key, k in histogram([(number[x], t) for x, t in part if x in number], counts).items():
                found[key] = found.get(key, 0) + k
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*found)] + [pa.array(list(found.values()))], names=["lang", "class", "bin", "good", "n"])

    if not langs:
        return Known(counts, np.zeros((0, 1)))
    cells = rows.mapInArrow(run, "lang long, class long, bin long, good boolean, n long").groupBy("lang", "class", "bin", "good").agg(F.sum("n").alias("n")).collect()
    most = max((r["class"] for r in cells), default=0)
    least = np.full((len(langs), most + 1), -np.inf)
    for i in range(len(langs)):
        for size in range(most + 1):
            for reach in range(most + 1):  # classes round this one, until there are labelled texts enough
                near = [r for r in cells if r["lang"] == i and abs(r["class"] - size) <= reach]
                if reach == most or sum(r["n"] for r in near if r["good"]) >= ENOUGH:
                    break
            sides: tuple[dict, dict] = ({}, {})
            for r in near:
                sides[r["good"]][r["bin"]] = sides[r["good"]].get(r["bin"], 0) + r["n"]
            if sides[True]:
                least[i, size] = bound(sides[True], sides[False])
    return Known(counts, least)


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows whose crc32 of the id modulo 4 is not 2."""
    return docs.filter(remainder("doc_id", 4) != 2).select("doc_id", "text", "lang")


def training_prototypes(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray, Known]:
    """(languages, prototypes, what tells their texts from others) of the training rows."""
    rows = training_rows(docs)
    return *learn(rows, per_language), learn_known(rows)


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Learn from the training rows, predict all."""
    return predict(docs, *learn(training_rows(docs), per_language), remainder("doc_id", 4) == 2)


def keep_known(docs: DataFrame, langs: list[str], prototypes: np.ndarray, known: Known) -> DataFrame:
    """The documents in a known language, with all their columns.

    Rejected are texts without a letter and those whose trigrams are too
    unlikely in every language, for a text of as many.
    """
    bits, least = known.bits(), known.least

    def wanted(texts: list[str]) -> list[bool]:
        names = judged(texts, langs, prototypes)[0] if texts else []
        return [n != "und" and ok for n, ok in zip(names, fits(texts, bits, least) if texts else [])]

    return keep_rows(docs, wanted)


@register("op5_language")
def op5(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))
