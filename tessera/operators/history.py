"""Row history as a plain table of validity intervals.

A history has the columns of the table it tells of, and ``valid_from`` and
``valid_to``: a row was so from the first on and before the second (null: it
still is).  It is made from dated full snapshots, which are compared by key and whole
row, and needs no commit protocol: the state at a time is a filter, the changes
between two times are another, and a history that is partitioned by the day of
``valid_from`` grows by rewriting its open rows only.

Defined results: a key may appear once in a snapshot (else the operators
raise); rows with a null in the key are keys like others; a key that a
snapshot lacks is deleted as of it; a row that comes back unchanged after a gap begins a new
interval; a snapshot without rows deletes all, which is why
the times of snapshots can be given apart from their rows.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import qcol

FROM, TO = "valid_from", "valid_to"
INSERT, UPDATE, DELETE = "insert", "update", "delete"


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    pairs = [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns]
    return functools.reduce(operator.and_, pairs)


def _quoted(names: Sequence[str]) -> list[str]:
    return ["`" + c.replace("`", "``") + "`" for c in names]


def _once(n: Column, what: str) -> Column:
    """``n`` rows of a key; raises when there is more than one."""
    return F.when(n > 1, F.raise_error(F.lit(f"a key occurs more than once in {what}")).cast("long")).otherwise(n)


def from_snapshots(snapshots: DataFrame, key: Sequence[str], at: str, times: DataFrame | None = None) -> DataFrame:
    """History of the rows of ``snapshots``, one of which has one value of ``at``.

    Consecutive snapshots in which a key's row is the same make one interval: its
    number among all snapshots less its rank within equal rows is constant there.
    ``times`` (one column) names all snapshot times if some have no rows.
    Grouping is by key and row, so a key with many versions is
    no heavier than its snapshots; the times are one row each.
    """
    rest = [c for c in snapshots.columns if c not in {*key, at}]
    known = times.select(F.col(_quoted(times.columns)[0]).alias("__t")) if times is not None else snapshots.select(qcol(at).alias("__t"))
    known = known.where("__t IS NOT NULL").distinct()
    in_order = Window.partitionBy(F.lit(0)).orderBy("__t")  # one row per snapshot
    known = known.select("__t", F.row_number().over(in_order).alias("__no"), F.lead("__t").over(in_order).alias("__next"))
    rows = snapshots.withColumnRenamed(at, "__at")
    numbered = rows.join(known, rows["__at"] == known["__t"]).drop("__t")

    per_key = numbered.groupBy(*[qcol(c) for c in key], "__no").agg(F.count(F.lit(1)).alias("__n"), *[F.first(qcol(c)).alias(c) for c in rest],
                                                                   F.first("__at").alias("__at"), F.first("__next").alias("__next"))
    checked = per_key.withColumn("__n", _once(F.col("__n"), "a snapshot")).where("__n = 1")
    alike = Window.partitionBy(*[qcol(c) for c in [*key, *rest]]).orderBy("__no")
    islands = checked.withColumn("__island", F.col("__no") - F.row_number().over(alike))
    spans = islands.groupBy(*[qcol(c) for c in [*key, *rest]], "__island").agg(
        F.min("__at").alias(FROM), F.max(F.struct("__no", "__next")).alias("__last")
    )
    return spans.select(*[qcol(c) for c in snapshots.columns if c != at], FROM, F.col("__last.__next").alias(TO))


def extend(history: DataFrame, snapshot: DataFrame, key: Sequence[str], now: Column) -> DataFrame:
    """``history`` after one more snapshot, taken at ``now``: changed and missing rows close, changed and new ones open.

    Only open rows are joined; closed ones pass through.
    """
    columns = [c for c in history.columns if c not in (FROM, TO)]
    rest = [c for c in columns if c not in key]
    new = snapshot.groupBy(*[qcol(c) for c in key]).agg(F.count(F.lit(1)).alias("__n"), *[F.first(qcol(c)).alias(c) for c in rest])
    new = new.withColumn("__n", _once(F.col("__n"), "the snapshot")).where("__n = 1").select(*[qcol(c) for c in columns], F.lit(True).alias("__new"))
    closed, open_ = history.where(F.col(TO).isNotNull()), history.where(F.col(TO).isNull()).withColumn("__old", F.lit(True))
    both = open_.alias("o").join(new.alias("n"), _same("o", "n", key), "full_outer")
    unchanged = F.coalesce(F.col("o.__old") & F.col("n.__new") & (_same("o", "n", rest) if rest else F.lit(True)), F.lit(False))
    stays = both.where(F.col("o.__old")).select(
        *[F.col(f"o.{c}") for c in _quoted(columns)], F.col(f"o.{FROM}"), F.when(~unchanged, now).cast(history.schema[TO].dataType).alias(TO)
    )
    opens = both.where(F.col("n.__new") & ~unchanged).select(
        *[F.col(f"n.{c}") for c in _quoted(columns)], now.cast(history.schema[FROM].dataType).alias(FROM),
        F.lit(None).cast(history.schema[TO].dataType).alias(TO),
    )
    return closed.select(*[qcol(c) for c in history.columns]).unionByName(stays).unionByName(opens)


def as_of(history: DataFrame, when: Column) -> DataFrame:
    """The table as it was at ``when``."""
    return history.where((F.col(FROM) <= when) & (F.col(TO).isNull() | (F.col(TO) > when))).drop(FROM, TO)


def diff(history: DataFrame, key: Sequence[str], first: Column, second: Column) -> DataFrame:
    """How the table at ``second`` differs from the one at ``first``: key, ``change``, ``before`` and ``after`` (structs of the other columns).

    Rows that hold at both times are left out before anything is joined.
    """
    rest = [c for c in history.columns if c not in {*key, FROM, TO}]
    holds = [(F.col(FROM) <= t) & (F.col(TO).isNull() | (F.col(TO) > t)) for t in (first, second)]
    image = F.struct(*[qcol(c) for c in rest]) if rest else F.struct(F.lit(True).alias("exists"))
    rows = history.select(*[qcol(c) for c in key], image.alias("__row"), holds[0].alias("__a"), holds[1].alias("__b")).where("__a <> __b")
    one = rows.groupBy(*[qcol(c) for c in key]).agg(
        F.first(F.when(F.col("__a"), F.col("__row")), ignorenulls=True).alias("before"),
        F.first(F.when(F.col("__b"), F.col("__row")), ignorenulls=True).alias("after"),
    )
    change = F.when(F.col("before").isNull(), INSERT).when(F.col("after").isNull(), DELETE).otherwise(UPDATE)
    # a row that ended and came back alike between the two times is no change
    changed = one.where(~F.col("before").eqNullSafe(F.col("after")))
    return changed.select(*[qcol(c) for c in key], change.alias("change"), "before", "after")


def changes(history: DataFrame, key: Sequence[str], times: DataFrame | None = None) -> DataFrame:
    """Every change ever: key, ``at``, ``change`` and the row's other columns after it (of a deletion: before it).

    An interval that begins where the key's interval before ends is an update; else it is an
    insertion, and the end of the one before a deletion.
    """
    rest = [c for c in history.columns if c not in {*key, FROM, TO}]
    by_key = Window.partitionBy(*[qcol(c) for c in key]).orderBy(FROM)
    seen = history.withColumns({"__before": F.lag(TO).over(by_key), "__next": F.lead(FROM).over(by_key)})
    begins = F.struct(F.col(FROM).alias("at"), F.when(F.col("__before") == F.col(FROM), UPDATE).otherwise(INSERT).alias("change"))
    ends = F.when(F.col(TO).isNotNull() & ~F.col(TO).eqNullSafe(F.col("__next")), F.struct(F.col(TO).alias("at"), F.lit(DELETE).alias("change")))
    out = seen.select(*[qcol(c) for c in [*key, *rest]], F.explode(F.array_compact(F.array(begins, ends))).alias("__c"))
    return out.select(*[qcol(c) for c in key], "__c.at", "__c.change", *[qcol(c) for c in rest])
