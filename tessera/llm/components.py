"""Connected components by alternating large-star and small-star steps.

Each step is a minimum per node (pre-aggregated before its shuffle) and a
join, so a node with a third of all links is split like any skewed join key.
Every round is written to the shared folder.  The driver sees one number a
round, never links; it serves to write few files where there are few links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import store

#: Links a task handles at least, where there are fewer than the shuffle's partitions would have.
LINKS_A_TASK = 250_000
#: A component's name is copied to so many salts, so that one with a third of all ids is no hot join key.
SALTS = 16


def _star(edges: DataFrame, large: bool, tasks: int) -> DataFrame:
    """edges (u, v) with u > v; large: link larger neighbours to the least one, small: the others."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).coalesce(tasks)
        out = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        out = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u > v").coalesce(tasks).distinct().coalesce(tasks)


def _settled(edges: DataFrame, tasks: int) -> bool:
    """Whether every node hangs on one other that hangs on none."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("hangs")), F.struct(F.col("v").alias("id"), F.lit(0).alias("hangs")))).alias("e"))
    per_id = ends.select("e.*").groupBy("id").agg(F.sum("hangs").alias("n"), F.count("*").alias("all")).coalesce(tasks)
    return per_id.filter("n > 1 OR (n = 1 AND all > 1)").isEmpty()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every id in ``links`` (u, v long): the least id it reaches."""
    edges = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = store(edges, "links")
    tasks = 1 + edges.count() // LINKS_A_TASK  # rounds never add links
    for _ in range(rounds):
        if _settled(edges, tasks):
            break
        edges = store(_star(_star(edges, True, tasks), False, tasks), "links")
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (id, component) after new links (u, v) between ids, labelled or not."""

    def ends(frame: DataFrame, name: str) -> DataFrame:
        own = labels.select(F.col("id").alias(name), F.col("component").alias(f"{name}c"))
        return frame.join(own, name, "left").withColumn(f"{name}c", F.coalesce(f"{name}c", name))

    found = store(ends(ends(links.select("u", "v"), "u"), "v"), "new-links")
    if found.isEmpty():
        return labels
    groups = components(found.select(F.col("uc").alias("u"), F.col("vc").alias("v"))).select(F.col("id").alias("component"), F.col("component").alias("into"))
    fresh = found.select(F.explode(F.array("u", "v")).alias("id")).distinct().join(labels, "id", "left_anti")
    every = labels.unionByName(fresh.select("id", F.col("id").alias("component")))
    return store(every.join(groups, "component", "left").select("id", F.coalesce("into", "component").alias("component")), "labels")


def least_names(labels: DataFrame, names: DataFrame) -> DataFrame:
    """(id, least) of every id in ``labels`` (id, component): the least name in its component, by ``names`` (id, name)."""
    own = labels.join(names, "id").select("id", "component", "name")
    least = own.groupBy("component").agg(F.min("name").alias("least"))
    least = least.select("component", "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = own.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    return salted.join(least, ["component", "salt"]).select("id", "least")
