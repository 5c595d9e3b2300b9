"""Embedding near-duplicates by lattice hashing.

Each of ``TABLES`` random projections takes a unit vector to eight
dimensions, scaled by ``WIDTH``, and decodes it to the nearest point of the
E8 lattice: its home cell.  A vector also visits the ``PROBES`` neighbouring
cells (of 240) nearest to its projection.  Two vectors meet in a cell that is
home to at least one of them; those that meet are compared by exact cosine
in double precision, so no link below the bound is ever returned.

Cells hold vectors, not pairs: a cell task multiplies blocks of at most
``BLOCK`` rows and returns, per vector, how many links it found and one edge
to the root of its local group.  A pair that meets several times is counted
in the least of its meeting cells, which both vectors' cells tell.  A cell
with more rows than ``BLOCK`` is dealt out as pairs of blocks, so any size
is compared in full, in tasks of bounded size.  Equal vectors are merged
first and weigh as many as they are.

A pair at exactly the bound meets with probability above 0.999 under the
defaults; larger cosines more often (measured recall: README).

Defined results: null vectors, zero vectors and vectors with null or
non-finite components link with nothing; so do rows with a null id (their
component is null).  Vectors of unequal lengths never link.  Repeated ids
count as separate rows.  Labels and other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import register, store, table
from tessera.llm.components import components, least_names
from tessera.llm.words import mix

COSINE, TABLES, PROBES, WIDTH, BLOCK = 0.95, 10, 2, 0.8, 2048


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


NEIGHBOURS = _minimal_vectors()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Round; where the sum is odd, round the worst coordinate the other way."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: the better of D8 and D8 shifted by a half."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


def cells(x: np.ndarray, tables: int = TABLES, probes: int = PROBES, width: float = WIDTH) -> np.ndarray:
    """(n, tables, 1 + probes) cell numbers of unit rows; the first of each table is home."""
    n, dim = x.shape
    out = np.empty((n, tables, 1 + probes), np.uint64)
    weights = np.random.default_rng(8).integers(1, 1 << 62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for t in range(tables):
        y = width * (x @ np.random.default_rng([dim, t]).normal(size=(dim, 8)))
        home = nearest_e8(y)
        points = [home]
        if probes:
            nearer = np.argsort(-((y - home) @ NEIGHBOURS.T), axis=1, kind="stable")[:, :probes]
            points += [home + NEIGHBOURS[nearer[:, k]] for k in range(probes)]
        for k, p in enumerate(points):
            doubled = np.rint(2 * p).astype(np.int64).astype(np.uint64)
            out[:, t, k] = mix((doubled * weights).sum(1, dtype=np.uint64) + np.uint64(t + 1 + 1000 * dim))
    return out.view(np.int64)


def _emit(tables: int, probes: int, width: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, copies = batch.column("rep").to_numpy(), batch.column("copies").to_numpy()
            vectors = [np.frombuffer(v, "<f8") for v in batch.column("vector").to_pylist()]
            sizes = np.array([len(v) for v in vectors])
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                for at in range(0, len(rows), 2048):
                    own = rows[at : at + 2048]
                    x = np.stack([vectors[i] for i in own])
                    x = x / np.linalg.norm(x / np.abs(x).max(1, keepdims=True), axis=1, keepdims=True) / np.abs(x).max(1, keepdims=True)
                    keys = cells(x, tables, probes, width).reshape(len(own), -1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rep[own]), pa.array(copies[own]), pa.array([r.tobytes() for r in x], pa.binary()),
                         pa.array([k.tobytes() for k in keys], pa.binary()),
                         pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel()))],
                        names=["rep", "copies", "unit", "keys", "cells"],
                    )

    return run


def _find(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _meet(probes: int, cosine: float):
    """Compare the rows of each (cell, block pair); rows are sorted by them."""

    def judged(cell: int, crossed: bool, rows: dict[str, np.ndarray]):
        home, side = rows["home"], rows["side"]
        x, n = rows["unit"], len(home)
        first = np.flatnonzero(side == 0) if crossed else np.arange(n)
        second = np.flatnonzero(side == 1) if crossed else first
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(first), 512):
            a = first[at : at + 512]
            near = (x[a] @ x[second].T >= cosine - 1e-9) & (home[a][:, None] | home[second][None, :])
            i, j = np.nonzero(near)
            i, j = a[i], second[j]
            if not crossed:
                i, j = i[i < j], j[i < j]
            found_a.append(i)
            found_b.append(j)
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        if not len(a):
            return None
        exact = (x[a] * x[b]).sum(1) >= cosine
        a, b = a[exact], b[exact]
        if not len(a):
            return None
        ka, kb = (rows["keys"][k].reshape(len(k), -1, 1 + probes) for k in (a, b))
        most = np.iinfo(np.int64).max
        meets = np.minimum(
            np.where((kb == ka[:, :, :1]).any(2), ka[:, :, 0], most).min(1),
            np.where((ka == kb[:, :, :1]).any(2), kb[:, :, 0], most).min(1),
        )
        mine = meets == cell
        a, b = a[mine], b[mine]
        if not len(a):
            return None
        links = np.bincount(a, rows["copies"][b], n) + np.bincount(b, rows["copies"][a], n)
        parent = np.arange(n)
        for i, j in zip(a.tolist(), b.tolist()):
            i, j = _find(parent, i), _find(parent, j)
            if i != j:
                parent[max(i, j)] = min(i, j)
        use = np.flatnonzero(links)
        return rows["rep"][use], links[use].astype(np.int64), rows["rep"][[_find(parent, i) for i in use]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grouped():
            held, key = [], None
            for batch in batches:
                ids = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "low", "high")], 1)
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

        out: list[tuple] = []
        for key, parts in grouped():
            part = pa.Table.from_batches(parts).combine_chunks()
            if part.num_rows < 2:
                continue
            rows = {c: part.column(c).to_numpy() for c in ("rep", "copies", "home", "side")}
            raw = part.column("unit").to_pylist()
            if len({len(r) for r in raw}) > 1:
                raise ValueError("a cell holds vectors of unequal lengths")
            rows["unit"] = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
            rows["keys"] = np.frombuffer(b"".join(part.column("keys").to_pylist()), "<i8").reshape(len(raw), -1)
            if (got := judged(key[0], key[1] != key[2], rows)) is not None:
                out.append(got)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["rep", "links", "root"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["rep", "links", "root"])

    return run


def near_duplicates(rows: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, width: float = WIDTH, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row (vec_id, embedding)."""
    rows = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    marked = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    vectors = store(marked.filter("usable").select("vec_id", "v"), "vectors")
    # a class of equal vectors goes by its hash: ids may be shared by different vectors
    classes = vectors.groupBy("v").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies")).withColumn("rep", F.xxhash64("v"))

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("rep"), b.column("copies"), pa.array([np.array(v, "<f8").tobytes() for v in b.column("v").to_pylist()], pa.binary())],
                names=["rep", "copies", "vector"],
            )

    reps = classes.select("rep", "copies", "v").mapInArrow(raw, "rep long, copies long, vector binary")
    indexed = store(
        reps.mapInArrow(_emit(tables, probes, width), "rep long, copies long, unit binary, keys binary, cells array<long>"), "lattice"
    )
    visits = indexed.select("rep", F.posexplode("cells").alias("n", "cell")).select("rep", "cell", (F.col("n") % (1 + probes) == 0).alias("home"))
    visits = visits.groupBy("rep", "cell").agg(F.max("home").alias("home"))  # two tables may share a cell number
    used = visits.groupBy("cell").agg(F.count("*").alias("n"), F.max("home").alias("some"))
    used = used.filter("n > 1 AND some").select("cell", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("rep", "cell"), F.col("blocks").cast("long")).cast("int")
    dealt = (
        visits.join(used, "cell")
        .withColumn("mine", mine)
        .select("rep", "cell", "home", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("rep", "cell", "home", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
                F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"))
    )
    found = store(
        dealt.join(indexed.drop("cells"), "rep")
        .select("cell", "low", "high", "rep", "home", "side", "copies", "unit", "keys")
        .repartition(F.col("cell"), F.col("low"), F.col("high"))
        .sortWithinPartitions("cell", "low", "high")
        .mapInArrow(_meet(probes, cosine), "rep long, links long, root long"),
        "met",
    )
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    groups = least_names(labels, classes.select(F.col("rep").alias("id"), F.col("least_id").alias("name"))).withColumnRenamed("id", "rep")
    summary = classes.join(links, "rep", "left").join(groups, "rep", "left").select(
        "v",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("least", "least_id").alias("component_id"),
    )
    linked = vectors.join(summary, "v").select("vec_id", "n_links", "component_id")
    alone = marked.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS u, b.vec_id AS w FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (SELECT u, w FROM links UNION SELECT r.u, l.w FROM reach r JOIN links l ON r.w = l.u),
counts AS (SELECT u, COUNT(*) AS n FROM links GROUP BY u), least_ids AS (SELECT u, MIN(w) AS w FROM reach GROUP BY u),
named AS (
    SELECT vec_id, COALESCE(n, 0) AS n_links, LEAST(vec_id, COALESCE(w, vec_id)) AS component_id
    FROM embeddings LEFT JOIN counts ON counts.u = vec_id LEFT JOIN least_ids ON least_ids.u = vec_id
)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM named
"""


@register("op3_lattice", SQL)
def op3(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))
