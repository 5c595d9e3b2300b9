"""Near-duplicate documents by BagMinHash on five-word shingles.

A document is the multiset of its five-word shingles (words are runs without
ASCII white space; a text of fewer words is one shingle).  Documents with
equal multisets form a class with a number of its own.  Class signatures
(:mod:`tessera.llm.bagminhash`) are cut into ``BANDS`` bands of ``ROWS``
slots; classes that share a band are candidates, and a candidate pair is a
link if its weighted Jaccard similarity, computed from the texts, is at least
``BOUND``.  Components of links are the groups; the least id of each is kept.

A group's members need not all be compared: what matters is that each link
ends inside one component.  So each bucket is settled in two rounds:

1. every member is compared with the bucket's least member (as many pairs as
   members), and links give first components;
2. buckets that still hold several components are compared by sketch; pairs of
   different components whose sketches do not rule a link out (similarity
   within four standard errors of the bound or more) are verified in the same
   task, likeliest first, and a pair whose components have met by then is
   skipped.  A task returns only links that joined components, so its output
   is linear in its input, and a pair is handled in the first band it shares.

Buckets above ``BLOCK`` rows or ``SHINGLES`` shingles are dealt out as pairs
of blocks, so none is capped and no task grows with one.  Two members of a
bucket's largest component need not meet, so its blocks meet only those of
the others: a bucket of n near copies and a stranger is dealt about n rows.

Defined results: a text without a word (null, empty, blank) is in no group;
rows with a null id are in none and have a null class; rows that share an id
are documents of their own, each in the group of its text, and groups are named by
their least id, so that two groups can have one name.  A pair at
exactly the bound shares a band with probability 0.9999.  Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bagminhash import SLOTS, signatures
from tessera.llm.common import batch_of, chunks, register, rows_in, store, table, text_or_empty
from tessera.llm.components import components, least_names, merged
from tessera.llm.words import mix, shingles, word_hashes

WORDS, BOUND, ROWS, BLOCK, SHINGLES = 5, 0.8, 5, 2048, 1_000_000
BANDS = SLOTS // ROWS
#: Sketches of eight bits a slot that agree in fewer slots rule a link out.
AGREE = int(np.ceil(SLOTS * (BOUND - 4 * np.sqrt(BOUND * (1 - BOUND) / SLOTS))))


def multisets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, shingle, count), sorted by owner and shingle."""
    h, counts, _ = word_hashes(texts)
    s, n = shingles(h, counts, WORDS)
    owner = np.repeat(np.arange(len(texts)), n)
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    first = np.ones(len(s), bool)
    first[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    return owner[at], s[at], np.diff(np.append(at, len(s)))


SCAN = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("size", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])
SCAN_DDL = "doc_id long, text_key long, size long, d1 long, d2 long, bands array<long>, sketch binary"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in chunks(rows_in(batches), lambda r: len(r[1]), 1 << 19, 128):
        n = len(rows)
        owner, s, count = multisets([r[1] for r in rows])
        sig = signatures(owner, s, count.astype(np.float64), n)
        size = np.bincount(owner, count, n).astype(np.int64)
        digest = np.zeros((2, n), np.uint64)
        for k in range(2):
            np.add.at(digest[k], owner, mix(s + np.uint64(k + 1)) * mix(count.astype(np.uint64) + np.uint64(7 * k)))
        bands = np.zeros((n, BANDS), np.uint64)
        for b in range(BANDS):
            key = np.full(n, b + 1, np.uint64)
            for x in range(ROWS):
                key = mix(key + sig[:, b * ROWS + x] * np.uint64(2 * x + 3))
            bands[:, b] = key
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(bands.view(np.int64).ravel()))
        sketch = (sig >> np.uint64(56)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([r[k] for r in rows], pa.int64()) for k in (0, 2)), pa.array(size), pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64)),
             lists, pa.array([k.tobytes() for k in sketch], pa.binary())], schema=SCAN
        )


class Bags:
    """The multisets of several texts, made a slice of texts at a time."""

    def __init__(self, texts: list[str]):
        self.parts: list[tuple[np.ndarray, np.ndarray, int]] = []  # shingles, counts, their sum
        for rows in chunks(((t,) for t in texts), lambda r: len(r[0]), 1 << 19, 128):
            owner, s, count = multisets([r[0] for r in rows])
            cuts = np.searchsorted(owner, np.arange(1, len(rows)))
            for own, n in zip(np.split(s, cuts), np.split(count, cuts)):
                self.parts.append((own.copy(), n.astype(np.int32), int(n.sum())))

    def alike(self, i: int, j: int) -> bool:
        """Whether two of them have weighted Jaccard similarity ``BOUND`` or more."""
        (s, m, total), (t, n, other) = self.parts[i], self.parts[j]
        if min(total, other) < BOUND * max(total, other) - 1e-9:  # the most they can share
            return False
        _, x, y = np.intersect1d(s, t, assume_unique=True, return_indices=True)
        both = int(np.minimum(m[x], n[y]).sum())
        return both >= BOUND * (total + other - both) - 1e-9


LINKED = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("linked", pa.bool_())])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in chunks(rows_in(batches), lambda r: len(r[1]) + len(r[3]), 1 << 20, 512):
        number: dict[str, int] = {}
        pairs = [(number.setdefault(a, len(number)), number.setdefault(b, len(number))) for _, a, _, b in rows]
        bags = Bags(list(number))
        yield batch_of(LINKED, list(zip(*[(u, v, bags.alike(i, j)) for (u, _, v, _), (i, j) in zip(rows, pairs)])))


def _find(parent: dict[int, int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _joined(rows: dict[str, np.ndarray], texts: list[str], crossed: bool) -> list[tuple[int, int]]:
    """Links that join different components among the rows of one bucket or block, or (crossed) between two blocks."""
    rep, part, side, sketch, bands = (rows[k] for k in ("rep", "part", "side", "sketch", "bands"))
    names, size = np.unique(part, return_counts=True)
    if len(names) < 2:
        return []
    first = np.flatnonzero(side == 0) if crossed else np.arange(len(rep))
    second = np.flatnonzero(side == 1) if crossed else first
    main = part == names[size.argmax()]  # two of its rows are never compared
    sides = [(first[~main[first]], second), (first[main[first]], second[~main[second]])]
    if not crossed:
        sides = [(first[~main], first)]
    bags = Bags(texts)
    parent = {int(x): int(x) for x in names}
    links = []
    for a_all, b_all in sides:
        step = max(1, (1 << 22) // (max(len(b_all), 1) * SLOTS))
        for at in range(0, len(a_all) if len(b_all) else 0, step):
            a = a_all[at : at + step]
            agree = (sketch[a][:, None, :] == sketch[b_all][None, :, :]).sum(2, dtype=np.int16)
            agree[part[a][:, None] == part[b_all][None, :]] = -1
            if not crossed:  # a pair of two rows outside the main component comes up once
                agree[~main[b_all][None, :] & (a[:, None] >= b_all[None, :])] = -1
            i, j = np.nonzero(agree >= AGREE)
            order = np.argsort(-agree[i, j], kind="stable")
            i, j = a[i[order]], b_all[j[order]]
            for x, y in zip(i.tolist(), j.tolist()):
                p, q = _find(parent, int(part[x])), _find(parent, int(part[y]))
                if p == q or rep[x] == rows["center"][x] or rep[y] == rows["center"][y]:  # met, or compared in round one
                    continue
                if bands[x, (bands[x] == bands[y]).argmax()] == rows["band"][x] and bags.alike(x, y):
                    parent[max(p, q)] = min(p, q)
                    links.append((int(rep[x]), int(rep[y])))
    return links


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def grouped():
        held, key = [], None
        for batch in batches:
            ids = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("band", "low", "high")], 1)
            change = np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1
            for lo, hi in zip([0, *change], [*change, len(ids)]):
                if hi > lo:
                    now = tuple(ids[lo])
                    if key is not None and now != key:
                        yield key, held
                        held = []
                    key = now
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield key, held

    for (_, low, high), parts in grouped():
        rows = pa.Table.from_batches(parts).combine_chunks()
        own = {c: rows.column(c).to_numpy() for c in ("band", "rep", "part", "center", "side")}
        own["sketch"] = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, SLOTS)
        own["bands"] = np.array(rows.column("bands").to_pylist(), np.int64)
        links = _joined(own, rows.column("text").to_pylist(), low != high)
        if links:
            u, v = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _in_blocks(members: DataFrame, block: int) -> DataFrame:
    """Rows of every bucket, dealt out as pairs of blocks where it is large.

    ``n``, ``words``: rows and shingles of the bucket; ``main``: its largest component,
    which has ``main_n`` and ``main_words`` of them.  Blocks of other rows meet one another and
    the main component's blocks, which are numbered after them.
    """

    def blocks(n: str, words: str):
        return F.greatest(F.ceil(F.greatest(F.expr(n) / block, F.expr(words) / SHINGLES)), F.lit(1)).cast("int")

    small = blocks("n", "words") == 1
    is_main = (F.col("part") == F.col("main")) & ~small
    sized = members.withColumns({
        "others": F.when(small, 1).otherwise(blocks("n - main_n", "words - main_words")), "mains": F.when(small, 0).otherwise(blocks("main_n", "main_words")),
        "is_main": is_main,
    })
    at = F.pmod(F.xxhash64("rep", "band"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others")).cast("long")).cast("int")
    mine = F.when(F.col("is_main"), F.col("others") + at).otherwise(at)
    last = F.col("others") + F.when(F.col("is_main"), 0).otherwise(F.col("mains")) - 1
    return (
        sized.withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        .select("band", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
                F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"), "rep", "part", "center")
    )


def _grouped(docs: DataFrame, block: int) -> DataFrame:
    """doc_id, text_key, class_id, copy_of, ``group`` (a number; null for rows in none) of every document."""
    docs = docs.select("doc_id", text_or_empty("text").alias("text")).withColumn("text_key", F.xxhash64("text"))
    scanned = store(docs.mapInArrow(_scan, SCAN_DDL), "bagminhash")
    same = ["size", "d1", "d2"]
    usable = F.col("doc_id").isNotNull() & (F.col("size") > 0)
    classes = scanned.filter(usable).groupBy(*same).agg(F.min(F.struct("doc_id", "text_key", "bands", "sketch")).alias("r"))
    classes = store(
        classes.select(*same, F.monotonically_increasing_id().alias("rep"), F.col("r.doc_id").alias("least_id"), F.col("r.text_key").alias("text_key"),
                       F.col("r.bands").alias("bands"), F.col("r.sketch").alias("sketch")), "classes"
    )
    visits = classes.select("rep", F.explode("bands").alias("band"))
    sizes = visits.groupBy("band").agg(F.count("*").alias("n"), F.min("rep").alias("center")).filter("n > 1")
    members = store(visits.join(sizes, "band"), "buckets")
    involved = members.select("rep").distinct().join(classes.select("rep", F.col("least_id").alias("doc_id"), "text_key"), "rep")
    # rows that share id and text are one text
    texts = store(docs.join(involved, ["doc_id", "text_key"]).groupBy("rep").agg(F.min("text").alias("text")), "texts")

    def verified(pairs: DataFrame) -> DataFrame:
        left, right = (texts.select(F.col("rep").alias(c), F.col("text").alias(f"text_{c}")) for c in "uv")
        return store(
            pairs.join(left, "u").join(right, "v").select("u", "text_u", "v", "text_v").mapInArrow(_verify, "u long, v long, linked boolean"),
            "verified",
        )

    pairs = members.filter("rep <> center").select(F.col("center").alias("u"), F.col("rep").alias("v")).distinct()
    tested = verified(pairs)
    labels = store(components(tested.filter("linked").select("u", "v")), "labels")

    sizes = classes.select("rep", "size")
    labelled = members.join(labels, members["rep"] == labels["id"], "left").join(sizes, "rep").select(
        "band", "rep", "center", "size", F.coalesce("component", "rep").alias("part")
    )
    parts = labelled.groupBy("band", "part").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    several = parts.groupBy("band").agg(
        F.sum("n").alias("n"), F.sum("words").alias("words"), F.count("*").alias("parts"), F.max(F.struct("n", "words", "part")).alias("m")
    )
    several = several.filter("n > 2 AND parts > 1").select(  # of two, one is the center
        "band", "n", "words", F.col("m.n").alias("main_n"), F.col("m.words").alias("main_words"), F.col("m.part").alias("main")
    )
    data = classes.select("rep", "bands", "sketch").join(texts, "rep")
    found = (
        _in_blocks(labelled.drop("size").join(several, "band"), block)
        .join(data, "rep")
        .repartition(F.col("band"), F.col("low"), F.col("high"))
        .sortWithinPartitions("band", "low", "high")
        .mapInArrow(_settle, "u long, v long")
    )
    labels = merged(labels, found)
    least = least_names(labels, classes.select(F.col("rep").alias("id"), F.col("least_id").alias("name")))
    groups = labels.join(least, "id").select(F.col("id").alias("rep"), "component", "least")
    named = classes.select(*same, "rep", "least_id").join(groups, "rep", "left").select(
        *same, F.coalesce("component", "rep").alias("group"), F.coalesce("least", "least_id").alias("class_id"), F.col("least_id").alias("copy_of")
    )
    own = ["doc_id", "text_key", "class_id", "copy_of", "group"]
    full = scanned.filter(usable).join(named, same).select(*own)
    alone = scanned.filter(~F.coalesce(usable, F.lit(False))).withColumns({"class_id": F.col("doc_id"), "copy_of": F.col("doc_id"), "group": F.lit(None).cast("long")})
    return full.unionByName(alone.select(*own))


def near_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, class_id, kept, copy_of) of every document.

    class_id: least id reachable by links, that of the group; kept: this
    row's id is that id; copy_of: least id with the same multiset of shingles.
    """
    kept = F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")
    return _grouped(docs, block).select("doc_id", "class_id", kept, "copy_of")


def keep_one(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One document of each group (of those with the least id one), and all rows in no group but repeated ones, with all their columns.

    Rows with a null id all stay.
    """
    rows = _grouped(docs, block).filter("doc_id IS NOT NULL")
    one = F.min(F.struct("doc_id", "text_key")).alias("k")
    first = rows.filter("`group` IS NOT NULL").groupBy("group").agg(one).select("k.*")
    wanted = first.unionByName(rows.filter("`group` IS NULL").select("doc_id", "text_key")).distinct()
    keyed = docs.withColumn("__text_key", F.xxhash64(text_or_empty("text")))
    same = (F.col("d.doc_id") == F.col("w.doc_id")) & (F.col("d.__text_key") == F.col("w.text_key"))
    found = keyed.alias("d").join(wanted.alias("w"), same, "left_semi").dropDuplicates(["doc_id", "__text_key"]).drop("__text_key")
    return found.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))


SQL = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(regexp_split_to_array(COALESCE(text, ''), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w FROM documents
), shingled AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END AS s FROM worded
), bags AS (
    SELECT doc_id, shingle, COUNT(*) AS n FROM (SELECT doc_id, unnest(s) AS shingle FROM shingled) GROUP BY ALL
), sizes AS (SELECT doc_id, len(s) AS size FROM shingled),
shared AS (
    SELECT a.doc_id AS u, b.doc_id AS w, SUM(LEAST(a.n, b.n)) AS n FROM bags a JOIN bags b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT u, w FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = w WHERE shared.n >= 0.8 * (x.size + y.size - shared.n) - 1e-9
), reach AS (SELECT u, w FROM links UNION SELECT r.u, l.w FROM reach r JOIN links l ON r.w = l.u),
least_ids AS (SELECT u, MIN(w) AS w FROM reach GROUP BY u),
copies AS (SELECT doc_id, CASE WHEN len(s) = 0 THEN doc_id ELSE MIN(doc_id) OVER (PARTITION BY list_sort(s)) END AS copy_of FROM shingled),
named AS (SELECT doc_id, LEAST(doc_id, COALESCE(w, doc_id)) AS class_id, copy_of FROM copies LEFT JOIN least_ids ON u = doc_id)
SELECT doc_id, class_id, doc_id = class_id AS kept, copy_of FROM named
"""


@register("op10_bagminhash", SQL)
def op10(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
