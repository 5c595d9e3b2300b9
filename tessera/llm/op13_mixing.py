"""Mixing sources to target weights by systematic sampling.

1. A document's size is its number of words.  Sources weigh by their place in
   code point order (null last); together they shall give a share of all words.
   A target stops at ``most`` times its source's size and the excess is reshared
   by weight: with sources ordered by cap / weight, a source is capped as long as
   its cap does not exceed its part of what is left (prefix sums; no loop).
2. All documents of a source are expected equally often: target / source size
   copies, which the prefix sum over a source's documents adds up.  To it comes
   one random offset a source, and a document is emitted once for every integer
   that its step crosses.  Steps are whole multiples of 2^-30, so the sum modulo
   1 is exact at any length and a rerun agrees.
3. Documents are laid out by size, one half rising and the other falling, so
   that neighbours are alike in size and both ends are small: what a source
   gives then stays within about the largest gap between sizes of its target.

Prefix sums are taken over range partitions (rank within the partition plus
what lower partitions hold), so neither a hot source nor all sources together
go to one task; the only windows run over one row per partition.

Defined results: null text counts as empty, size 0; a null source is a source of
its own; a source without words has target 0; repeated rows are documents of
their own (rows equal in id and size may swap copies); null ids come first; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import register, store, table, text_or_empty

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), (3, 2), 2, "mix-13"
BITS = 30
SPACES = " \t\n\x0b\f\r"


def words(text: Column) -> Column:
    """Number of words, counted without an array of them."""
    return F.length(F.regexp_replace(F.ltrim(text, F.lit(SPACES)), r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x")).cast("long")


def laid_out(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` stored in the order of ``keys``, with its range partition ``part`` and its place ``at`` there."""
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = placed.withColumn("part", F.shiftright("_at", 33)).withColumn("at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    return store(placed.drop("_at"), name)


def lower_parts(parts: DataFrame, sums: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """One row per partition (and ``by``): each of ``sums`` over the partitions below."""
    # without ``by`` the window holds one row per partition, so a single group is right
    below = Window.partitionBy(*(by or [F.lit(0)])).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumns({f"{c}_below": F.coalesce(F.sum(c).over(below), F.lit(0)) for c in sums})


def exact(col: str) -> Column:
    return F.col(col).cast("decimal(20,0)")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """(unknown, name, source_size) with ``target`` added; one row per source."""
    if not 0 <= share[0] <= share[1] * most:
        raise ValueError("the share must be between 0 and the most copies")
    named = laid_out(sizes, ["unknown", "name"], "mix-names")
    lower = lower_parts(named.groupBy("part").agg(F.count("*").alias("n")), ["n"]).select("part", "n_below")
    place = (F.col("n_below") + F.col("at")) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (place + 1).cast("int"))
    weighed = named.join(lower, "part").select("unknown", "name", "source_size", weight.alias("weight"))

    ratio = F.col("source_size") / F.col("weight")
    rows = laid_out(weighed.withColumn("ratio", ratio), ["ratio", "unknown", "name"], "mix-caps")
    held = rows.groupBy("part").agg(F.sum("source_size").alias("size"), F.sum("weight").alias("w"))
    total = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("all_size"), F.coalesce(F.sum("weight"), F.lit(0)).alias("all_weight"))
    before = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    so_far = {
        "capped_size": F.col("size_below") + F.coalesce(F.sum("source_size").over(before), F.lit(0)),
        "capped_weight": F.col("w_below") + F.coalesce(F.sum("weight").over(before), F.lit(0)),
    }
    lower = lower_parts(held, ["size", "w"]).select("part", "size_below", "w_below")
    run = rows.join(F.broadcast(total), F.lit(True)).join(lower, "part").withColumns(so_far)  # total: one row
    run = run.withColumns({
        # what is left times the share's denominator, and the weight it is shared by
        "left": exact("all_size") * share[0] - exact("capped_size") * (most * share[1]),
        "by": F.col("all_weight") - F.col("capped_weight"),
    })
    run = run.withColumn("capped", exact("source_size") * (most * share[1]) * exact("by") <= F.col("left") * exact("weight"))
    run = store(run.select("unknown", "name", "source_size", "weight", "ratio", "capped", "left", "by"), "mix-levels")
    level = run.where(~F.col("capped")).agg(F.min_by(F.struct("left", "by"), F.struct("ratio", "unknown", "name")).alias("first"))
    per_weight = (F.col("first.left").cast("double") / share[1]) / F.col("first.by")
    target = F.when(F.col("capped"), F.col("source_size") * F.lit(float(most))).otherwise(per_weight * F.col("weight"))
    return run.join(F.broadcast(level), F.lit(True)).select("unknown", "name", "source_size", target.alias("target"))  # level: one row


def sampled(docs: DataFrame, carry: tuple[str, ...] = (), weights=WEIGHTS, share=SHARE, most=MOST, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, copies and the columns ``carry`` (as ``doc``, a struct) of every document."""
    sized = docs.select(
        "doc_id", words(text_or_empty("text")).alias("size"), F.col("source").isNull().alias("unknown"), text_or_empty("source").alias("name"),
        F.struct(*[F.col(f"`{c}`") for c in carry] or [F.lit(None).cast("int").alias("_")]).alias("doc"),
        F.xxhash64("text").alias("tie"),
    )
    falls = F.coalesce(F.col("doc_id") % 2 != 0, F.lit(False))
    sized = sized.withColumn("falls", falls).withColumn("step", F.when(F.col("falls"), -F.col("size")).otherwise(F.col("size")))
    rows = laid_out(sized, ["unknown", "name", "falls", "step", "doc_id", "tie"], "mix-rows")

    held = rows.groupBy("part", "unknown", "name").agg(F.count("*").alias("n"), F.min("at").alias("first"), F.sum("size").alias("size"))
    held = store(held, "mix-parts")
    sizes = held.groupBy("unknown", "name").agg(F.sum("size").alias("source_size"))
    goals = targets(sizes, weights, share, most)
    each = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * (1 << BITS))).otherwise(0).cast("long")
    draw = F.md5(F.concat(F.lit(seed), F.when(F.col("unknown"), "?").otherwise("="), "name"))
    offset = F.conv(F.substring(draw, 1, 7), 16, 10).cast("long") * (1 << (BITS - 28))
    goals = goals.withColumns({"each": each, "offset": offset})
    lower = lower_parts(held, ["n"], ("unknown", "name")).drop("n", "size").join(goals, ["unknown", "name"])

    whole = 1 << BITS
    rank = F.col("n_below") + F.col("at") - F.col("first")
    # both factors are below 2^30, so the product stays within 64 bits
    phase = ((rank % whole) * (F.col("each") % whole) + F.col("offset")) % whole
    copies = F.floor((phase + F.col("each")) / F.lit(whole)).cast("int")
    return rows.join(lower, ["part", "unknown", "name"]).select(
        "doc_id", "size", "source_size", "target", copies.alias("copies"), "doc"
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken."""
    rows = sampled(docs, carry=tuple(docs.columns), **options).where("copies > 0")
    return rows.select("doc", F.explode(F.sequence(F.lit(1), "copies"))).select("doc.*")


#: The same prefix sums as windows over whole sources, which suits a table that one machine reads.
SQL = rf"""
WITH sized AS (
  SELECT doc_id, source IS NULL AS unknown, coalesce(source, '') AS name,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         coalesce(doc_id % 2 <> 0, FALSE) AS falls
  FROM documents),
sources AS (
  SELECT *, [{", ".join(map(str, WEIGHTS))}][1 + (row_number() OVER (ORDER BY unknown, encode(name)) - 1) % {len(WEIGHTS)}]::BIGINT AS weight
  FROM (SELECT unknown, name, sum(size)::BIGINT AS source_size FROM sized GROUP BY ALL)),
levels AS (
  SELECT *, {SHARE[0]} * sum(source_size) OVER () - {MOST * SHARE[1]} * (sum(source_size) OVER below - source_size) AS rest,
         sum(weight) OVER () - (sum(weight) OVER below - weight) AS share_by
  FROM (SELECT *, source_size / weight AS ratio FROM sources)
  WINDOW below AS (ORDER BY ratio, unknown, encode(name) ROWS UNBOUNDED PRECEDING)),
judged AS (SELECT *, {MOST * SHARE[1]} * source_size * share_by <= rest * weight AS capped FROM levels),
goals AS (
  SELECT unknown, name, source_size, CASE WHEN capped THEN source_size * {MOST}.0::DOUBLE ELSE
    ((SELECT arg_min(rest, (ratio, unknown, encode(name))) FROM judged WHERE NOT capped)::DOUBLE / {SHARE[1]})
    / (SELECT arg_min(share_by, (ratio, unknown, encode(name))) FROM judged WHERE NOT capped)::DOUBLE * weight END AS target
  FROM judged),
steps AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * {1 << BITS})::BIGINT ELSE 0 END AS each,
         ('0x' || substr(md5('{SEED}' || CASE WHEN unknown THEN '?' ELSE '=' END || name), 1, 7))::BIGINT * {1 << (BITS - 28)} AS offs
  FROM goals),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY unknown, name ORDER BY falls, CASE WHEN falls THEN -size ELSE size END, doc_id NULLS FIRST) - 1 AS k
  FROM sized JOIN steps USING (unknown, name))
SELECT doc_id, size, source_size, target,
       (size * (((((k % {1 << BITS}) * (each % {1 << BITS}) + offs) % {1 << BITS}) + each) // {1 << BITS}))::BIGINT AS taken
FROM ranked
"""


@register("op13_mixing", SQL)
def op13(spark, sf_dir):
    rows = sampled(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
