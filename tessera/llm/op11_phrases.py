"""Phrase collocations from mergeable Misra-Gries summaries.

1. Tasks cut texts into words, count their n-grams (up to ``longest`` words, and per
   language the number of words as the n-gram of none) and send each hash
   partition one compressed block of distinct n-grams and counts.  The number of
   hash partitions grows with the corpus up to what a shuffle bears; heavier ones are
   split further inside their task, by a second hash over files.
2. A hash partition's task first lays its blocks by in a temporary file, which gives
   its mass (all counts).  Then it merges them into a Misra-Gries summary of more counters
   than mass / threshold: adding counts, and whenever there are too many, subtracting
   the largest count beyond the capacity from all and dropping what is
   not positive.  Each subtraction takes at least capacity + 1 times itself from the mass,
   so all of them take less than the threshold from any count: every n-gram that reaches
   the threshold is still there at the end, and one whose counter and the subtractions
   together do not reach it cannot be frequent.
3. A second pass over the same blocks counts the survivors exactly.
4. Every part of a frequent phrase is frequent too, so scores come from joins of
   the frequent n-grams with one another.  Word counts are dealt over salts, since
   a common word begins or ends a large share of all phrases.  Products are
   decimals of 38 digits.  The first rows per language are found
   in two steps, within hash buckets first.

No task holds more than a block of texts, or a summary and a batch of blocks, so a word, a phrase
or a language with a third of all rows does no harm.

Defined results: null texts count as empty, null languages as ``und``; only A-Z change
case; a word is any run without blanks and separators, of any length; a text's last
words do not run into the next text; repeated rows count each time; an empty table gives
no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import tempfile
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import batch_of, chunks, register, rows_in, store, table, text_or_empty
from tessera.llm.words import VALUE, mix

THRESHOLD, LONGEST, FIRST = 10, 3, 2000
#: Bytes of text a task counts at once, bytes of text for each hash partition, how many of these there are at most.
BLOCK, PARTITION, PARTITIONS = 4 << 20, 4 << 20, 20_000
#: Distinct n-grams merged at once, and the mass up to which a hash partition is summarised in one go.
BATCH, MASS = 1 << 18, 1 << 23
#: Salts of the word counts, buckets of the first step of the ranking.
SALTS, BUCKETS = 16, 64
SEPARATORS = ".,;:!?\n\x0b\x0c\r"
#: A-Z to a-z, separators to line feeds, tabs to blanks.
LOWER = bytes.maketrans(
    bytes(range(65, 91)) + SEPARATORS.encode() + b"\t", bytes(range(97, 123)) + b"\n" * len(SEPARATORS) + b" "
)
CODES = 21  # bits of a word's or n-gram's number within a slice: two of them fit in a 64-bit integer
BLANK, END, NOTHING = (pa.scalar(x, pa.large_binary()) for x in (b" ", b"\n", b""))
SEPARATOR = re.compile(f"[{re.escape(SEPARATORS)}]")


def sections(rows: Iterator[tuple[str, str]], most: int) -> Iterator[tuple[str, str]]:
    """``rows`` of (language, text), long texts cut at separators, over which no phrase goes."""
    for lang, text in rows:
        at = 0
        while len(text) - at > most:
            cut = SEPARATOR.search(text, at + most)
            if cut is None:
                break
            yield lang, text[at : cut.start()]
            at = cut.end()
        yield lang, text[at:] if at else text


def word_array(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """All words, and for each how many words follow it in its piece (up to any number)."""
    data = np.frombuffer(b"\n".join(t.encode() for t in texts).translate(LOWER) + b"\n", np.uint8)
    inside = (data != 10) & (data != 32)
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    starts, ends = edge[0::2], edge[1::2]  # data ends in a separator, so they pair up
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))]
    )
    piece = np.searchsorted(np.flatnonzero(data == 10), starts)  # the piece of each word
    last = np.searchsorted(piece, piece, "right") - 1 if len(piece) else piece
    return words, last - np.arange(len(piece))


def grams(words: pa.Array, follow: np.ndarray, longest: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Distinct n-grams of every length with hashes and counts, a slice of words at a time."""
    step = (1 << CODES) - longest
    for at in range(0, len(words), step):
        size = min(step, len(words) - at)
        coded = words.slice(at, size + longest - 1).dictionary_encode()
        # codes in the order of the words, so that distinct n-grams come out sorted and compress well
        order = pc.sort_indices(coded.dictionary).to_numpy()
        own = coded.dictionary.take(pa.array(order))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        codes = place[coded.indices.to_numpy()]
        hashes = np.fromiter((zlib.crc32(w) for w in own.to_pylist()), np.uint64, len(own))

        begins, ids, names, h = np.arange(size), codes[:size], own, hashes
        for n in range(1, longest + 1):
            if n == 1:
                times = np.bincount(ids, minlength=len(own))
            else:  # an n-gram is its first n - 1 words' id and its last word's code
                goes_on = follow[at + begins] >= n - 1
                begins, ids = begins[goes_on], ids[goes_on]
                distinct, ids, times = np.unique(ids << CODES | codes[begins + n - 1], return_inverse=True, return_counts=True)
                first, last = distinct >> CODES, distinct & ((1 << CODES) - 1)
                names = pc.binary_join_element_wise(names.take(pa.array(first)), own.take(pa.array(last)), BLANK)
                h = mix(h[first] * np.uint64(31) + hashes[last] + np.uint64(1))
            seen = times > 0  # words that only go on into the next slice
            yield names.filter(pa.array(seen)), h[seen], times[seen]


BLOCKS = pa.schema(
    [("slot", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary()), ("size", pa.int64()), ("n", pa.int64()), ("mass", pa.int64())]
)


def blocks(docs: DataFrame, partitions: int, longest: int) -> DataFrame:
    """One row per block of texts and hash partition ``slot``: distinct n-grams and counts, compressed.

    An n-gram is its language (percent-encoded), a tab and its words with blanks
    between; each ends with a line feed.  ``size`` is their bytes, ``n`` their
    number, ``mass`` the sum of the counts.
    """

    def dealt(lang: str, names: pa.Array, h: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        slots = (mix(h + np.uint64(zlib.crc32(lang.encode()))) % np.uint64(partitions)).astype(np.int32)
        order = np.argsort(slots, kind="stable")
        head = pa.scalar(quote(lang, safe="").encode() + b"\t", pa.large_binary())
        keys = pc.binary_join_element_wise(head, names.take(pa.array(order)), END, NOTHING)
        times, slots = times[order], slots[order]
        _, ends, data = keys.buffers()
        offsets, data = np.frombuffer(ends, np.int64, len(keys) + 1), memoryview(data)
        found, at = np.unique(slots, return_index=True)
        rows = [(slot, *packed(data[offsets[i] : offsets[j]], times[i:j])) for slot, i, j in zip(found, at, [*at[1:], len(slots)])]
        return batch_of(BLOCKS, list(zip(*rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(sections(rows_in(batches), BLOCK), lambda r: len(r[1]), BLOCK, 1 << 20):
            texts: dict[str, list[str]] = {}
            for lang, text in rows:
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                words, follow = word_array(own)
                if len(words):
                    yield dealt(lang, pa.array([b""], pa.large_binary()), np.zeros(1, np.uint64), np.array([len(words)]))
                for names, h, times in grams(words, follow, longest):
                    if len(times):
                        yield dealt(lang, names, h, times)
            pa.default_memory_pool().release_unused()

    source = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), text_or_empty("text").alias("text"))
    return source.mapInArrow(run, "slot int, grams binary, counts binary, size long, n long, mass long")


def packed(keys: memoryview, counts: np.ndarray) -> tuple[bytes, bytes, int, int, int]:
    """A block of keys that each end with a line feed: compressed keys and counts, bytes, number and mass."""
    codec = pa.Codec("zstd")
    own = counts.astype("<i8").tobytes()
    return codec.compress(keys, asbytes=True), codec.compress(own, asbytes=True), len(keys), len(counts), int(counts.sum())


def block(keys: pa.Array, counts: np.ndarray) -> tuple[bytes, bytes, int, int, int]:
    return packed(memoryview(keys.buffers()[2]), counts)


def unpacked(grams_: bytes, counts: bytes, size: int, n: int) -> tuple[pa.Array, np.ndarray]:
    """Keys and counts of a block."""
    codec = pa.Codec("zstd")
    data = np.frombuffer(codec.decompress(grams_, size, asbytes=True), np.uint8)
    ends = np.flatnonzero(data == 10)
    offsets = np.concatenate([[0], ends - np.arange(n)]).astype(np.int64)
    kept = pa.py_buffer(np.ascontiguousarray(data[data != 10]))
    keys = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), kept])
    return keys, np.frombuffer(codec.decompress(counts, 8 * n, asbytes=True), "<i8")


class Summary:
    """A Misra-Gries summary of up to ``capacity`` counters that takes whole batches.

    ``lost`` is what any count may have lost: a key counted f times has a
    counter of at least f - lost, or none if f <= lost.
    """

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = pa.array([], pa.large_binary()), np.empty(0, np.int64)

    def add(self, keys: pa.Array, counts: np.ndarray) -> None:
        both = pa.table({"key": pa.concat_arrays([self.keys, keys]), "n": np.concatenate([self.counts, counts])})
        summed = both.group_by("key").aggregate([("n", "sum")])
        keys, counts = summed["key"].combine_chunks(), summed["n_sum"].to_numpy()
        if len(counts) > self.capacity:
            cut = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            kept = counts > cut
            self.lost += cut
            keys, counts = keys.filter(pa.array(kept)), counts[kept] - cut
        self.keys, self.counts = keys, counts

    def reaching(self, threshold: int) -> pa.Array:
        """All keys that may have reached the threshold."""
        return self.keys.filter(pa.array(self.counts + self.lost >= threshold))


class Laid:
    """Blocks of a hash partition in a temporary file of the task, so that they can be read again."""

    def __init__(self, rows: Iterable[tuple] = ()):
        self.file = tempfile.TemporaryFile()
        self.mass, self.lengths = 0, []
        for row in rows:
            self.add(*row)

    def add(self, grams_: bytes, counts: bytes, size: int, n: int, mass: int) -> None:
        self.mass += mass
        self.lengths.append((len(grams_), len(counts), size, n))
        self.file.write(grams_)
        self.file.write(counts)

    def batches(self) -> Iterator[tuple[pa.Array, np.ndarray]]:
        self.file.seek(0)
        keys, counts, total = [], [], 0
        for a, b, size, n in self.lengths:
            own = unpacked(self.file.read(a), self.file.read(b), size, n)
            keys.append(own[0])
            counts.append(own[1])
            total += n
            if total >= BATCH:
                yield pa.concat_arrays(keys), np.concatenate(counts)
                keys, counts, total = [], [], 0
        if keys:
            yield pa.concat_arrays(keys), np.concatenate(counts)

    def parts(self, most: int = MASS) -> Iterator[Laid]:
        """This partition, or if its mass is above ``most`` finer ones by a second hash, so that memory stays bounded."""
        if self.mass <= most:
            yield self
            return
        finer = [Laid() for _ in range(-(-self.mass // most))]
        for keys, counts in self.batches():
            _, ends, data = keys.buffers()
            offsets = np.frombuffer(ends, np.int64, len(keys) + 1, 8 * keys.offset)
            own = np.add.reduceat(VALUE[np.frombuffer(data, np.uint8, offsets[-1])], offsets[:-1])  # no key is empty
            which = mix(own) % np.uint64(len(finer))
            for k, part in enumerate(finer):
                at = np.flatnonzero(which == k)
                if len(at):
                    part.add(*block(pc.binary_join_element_wise(keys.take(pa.array(at)), END, NOTHING), counts[at]))
        self.file.close()
        yield from finer


def frequent_of(laid: Laid, threshold: int) -> tuple[pa.Array, np.ndarray]:
    """All keys that reach the threshold, with their counts: a summary, then a second pass."""
    summary = Summary(laid.mass // threshold + 1)
    for keys, counts in laid.batches():
        summary.add(keys, counts)
    wanted = summary.reaching(threshold)
    exact = np.zeros(len(wanted), np.int64)
    for keys, counts in laid.batches():
        at = pc.index_in(keys, value_set=wanted)
        hit = at.is_valid().to_numpy(zero_copy_only=False)
        np.add.at(exact, at.drop_null().to_numpy(), counts[hit])
    kept = exact >= threshold
    return wanted.filter(pa.array(kept)), exact[kept]


def frequent(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, partitions: int | None = None) -> DataFrame:
    """(lang, words, phrase, n): every n-gram of up to ``longest`` words counted ``threshold`` times, and per language its words (words = 0)."""
    if partitions is None:
        size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
        partitions = min(1 + size // PARTITION, PARTITIONS)
    schema = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for laid in Laid(rows_in(batches)).parts():
            keys, counts = frequent_of(laid, threshold)
            for at in range(0, len(keys), 1 << 16):
                split = [k.decode().split("\t") for k in keys.slice(at, 1 << 16).to_pylist()]
                langs, names = [unquote(lang) for lang, _ in split], [name for _, name in split]
                yield batch_of(schema, [langs, [x.count(" ") + 1 if x else 0 for x in names], names, counts[at : at + (1 << 16)]])
            pa.default_memory_pool().release_unused()

    dealt = blocks(docs, partitions, longest).repartitionById(partitions, "slot").drop("slot")
    return dealt.mapInArrow(run, "lang string, words int, phrase string, n long")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) without rounding: up to 38 digits, enough for counts below 10^15."""
    a, left, right = (c.cast("decimal(15,0)") for c in (a, left, right))
    over = F.lit(1_000_000).cast("decimal(7,0)") * (a * a)
    return F.call_function("div", over, left * right)


def cuts(counted: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, words, a, k, l, r) for every candidate and each of its cuts."""
    phrases = counted.where("words >= 2").withColumnRenamed("n", "a")
    each = phrases.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    each = each.withColumns({
        "head": F.expr("substring_index(phrase, ' ', k)"),
        "tail": F.expr("substring_index(phrase, ' ', k - words)"),
        # a common word is the head or tail of many phrases: its count is copied to every salt
        "head_salt": F.when(F.col("k") == 1, F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).otherwise(0).cast("int"),
        "tail_salt": F.when(F.col("words") - F.col("k") == 1, F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).otherwise(0).cast("int"),
    })
    parts = counted.where(F.col("words").between(1, longest - 1)).select(
        "lang", "phrase", "n", F.explode(F.when(F.col("words") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt")
    )
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("salt").alias("head_salt"), F.col("n").alias("l"))
    tails = parts.select("lang", F.col("phrase").alias("tail"), F.col("salt").alias("tail_salt"), F.col("n").alias("r"))
    joined = each.join(heads, ["lang", "head", "head_salt"]).join(tails, ["lang", "tail", "tail_salt"])
    return joined.select("lang", "phrase", "words", "a", "k", "l", "r")


def inside_longer(phrases: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, most): the highest count of a longer candidate around each phrase inside one."""
    around = phrases.where("words >= 3").withColumnRenamed("a", "n")
    # all shorter runs of two or more words, not the phrase itself
    runs = F.expr(
        "flatten(transform(sequence(2, words - 1), w -> transform(sequence(0, words - w),"
        " i -> array_join(slice(split(phrase, ' '), i + 1, w), ' '))))"
    )
    return around.select("lang", F.explode(runs).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("most"))


def collocations(
    docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, first: int = FIRST, partitions: int | None = None
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first rows of each language by score, count and phrase."""
    counted = store(frequent(docs, threshold, longest, partitions), "phrases")
    each = cuts(counted, longest).withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    lowest = each.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = lowest.select("lang", "phrase", "words", "a", "cut.score", "cut.l", "cut.r")
    scored = scored.join(inside_longer(scored, longest), ["lang", "phrase"], "left")
    kept = scored.where("most IS NULL OR 100 * CAST(most AS decimal(20,0)) < 50 * CAST(a AS decimal(20,0))")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS))
    near = kept.withColumn("bucket", bucket).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order)))
    near = near.where(F.col("rank") <= first).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    totals = counted.where("words = 0").select("lang", "n")
    return near.where(F.col("rank") <= first).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def sql(threshold: int = THRESHOLD, first: int = FIRST) -> str:
    """The same for phrases of two and three words, by counting every phrase."""
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
runs AS (
  SELECT lang, unnest(list_concat(
    list_transform(range(1, len(w) + 1), lambda i: struct_pack(words := 1, phrase := w[i])),
    list_transform(range(1, len(w)), lambda i: struct_pack(words := 2, phrase := w[i] || ' ' || w[i + 1])),
    list_transform(range(1, len(w) - 1), lambda i: struct_pack(words := 3, phrase := w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS g
  FROM words),
f AS (SELECT lang, g.words AS words, g.phrase AS phrase, count(*) AS n FROM runs GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE words = 1 GROUP BY ALL),
candidates AS (SELECT lang, words, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE words >= 2 AND n >= {threshold}),
cuts AS (SELECT *, unnest(range(1, words)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.words, c.phrase, c.a, c.k, l.n AS l, r.n AS r, (1000000::HUGEINT * c.a * c.a) // (l.n::HUGEINT * r.n) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
              JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a FROM candidates WHERE words = 3) GROUP BY ALL),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, encode(s.phrase)) AS rank
  FROM lowest s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE i.most IS NULL OR 100 * i.most < 50 * s.a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= {first}
"""


@register("op11_phrases", sql())
def op11(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
