"""Versioned tables on plain Parquet: a change log plus a commit log.

Layout under the table path (a folder in shared storage)::

    data/_version=N/_attempt=U/_op=I|U|D/   rows written by one attempt at commit N
    commits/N.json                          one small record per commit

Every write goes to a folder of its own and counts only once a commit record
names it, so a failed or repeated write is never read.  Records are created
exclusively: of two writers that try the same version, one fails and nothing
of it is visible.

A row keeps its ``_row_id`` for life.  Inserted ids are new, so the state at
a version is all inserted rows since the last *full* version (create, static
overwrite, compaction), less the rows that later updates and deletes touch,
plus the last update of each of those.  Only updates and deletes are ordered
by a window; a table filled by appends is a plain scan, with no shuffle.

Evolution commits are versions too: a version is read with its own columns.
Column renames are metadata (files keep the physical name).
"""

from __future__ import annotations

import datetime as _dt
import functools
import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import qcol
from tessera.session import scratch_path

ROW_ID, OP, VERSION, ATTEMPT = "_row_id", "_op", "_version", "_attempt"
INSERT, UPDATE, DELETE = "I", "U", "D"
META = (ROW_ID, OP)

COMMIT_SCHEMA = (
    "version long, committed_at string, operation string, full boolean, attempts array<string>, changes boolean, "
    "expired_before long, rows_inserted long, rows_updated long, rows_deleted long, columns_json string, "
    "partition_by array<string>, next_row_id long, properties string, stream_query string, stream_batch long"
)


class VersionedTableError(Exception):
    pass


@functools.lru_cache(maxsize=256)
def _dtype(ddl: str) -> T.DataType:
    return T.DataType.fromDDL(ddl)


def _storage(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


class VersionedTable:
    """A table with versions, row-level changes and time travel."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._records: list[dict] | None = None

    @property
    def data_path(self) -> str:
        return f"{self.path}/data"

    @property
    def commits_path(self) -> str:
        return f"{self.path}/commits"

    # -------------------------------------------------------------- commits
    def exists(self) -> bool:
        fs, p = _storage(self.spark, self.commits_path)
        return fs.exists(p)

    def commits(self) -> list[dict]:
        """All commit records (one small row each), oldest first; record k is version k."""
        if self._records is None:
            rows = self.spark.read.schema(COMMIT_SCHEMA).json(self.commits_path).collect() if self.exists() else []
            self._records = sorted((r.asDict() for r in rows), key=lambda r: r["version"])
        return self._records

    def _last(self) -> dict:
        if not self.commits():
            raise VersionedTableError(f"no table at {self.path}")
        return self.commits()[-1]

    @property
    def current_version(self) -> int:
        return self._last()["version"]

    def _at(self, version: int | None) -> dict:
        return self._last() if version is None else self.commits()[version]

    def _columns(self, version: int | None = None) -> list[dict]:
        return json.loads(self._at(version)["columns_json"])

    def logical_schema(self, version: int | None = None) -> T.StructType:
        return T.StructType([T.StructField(c["name"], _dtype(c["type"])) for c in self._columns(version)])

    def partition_by(self) -> list[str]:
        return list(self._last()["partition_by"] or [])

    def properties(self) -> dict:
        return json.loads(self._last()["properties"] or "{}")

    def _commit(self, operation: str, committed_at=None, **values) -> int:
        """Create the next record; fails if another writer was first."""
        last = self.commits()[-1] if self.commits() else {}
        record = {k: last.get(k) for k in ("expired_before", "columns_json", "partition_by", "next_row_id", "properties")}
        record |= {"full": False, "attempts": [], "changes": False, "rows_inserted": 0, "rows_updated": 0, "rows_deleted": 0,
                   "stream_query": None, "stream_batch": None, **values}
        record |= {"version": len(self.commits()), "operation": operation, "committed_at": (committed_at or _now()).isoformat()}
        fs, p = _storage(self.spark, f"{self.commits_path}/{record['version']:012d}.json")
        if fs.exists(p):
            self._records = None
            raise VersionedTableError(f"version {record['version']} of {self.path} was committed by another writer")
        out = fs.create(p, False)
        try:
            out.write(bytearray((json.dumps(record) + "\n").encode()))
        finally:
            out.close()
        self._records = [*self.commits(), record]
        return record["version"]

    # --------------------------------------------------------------- create
    def create(self, schema: T.StructType | str, partition_by: Sequence[str] = (), properties: Mapping[str, str] | None = None,
               if_not_exists: bool = True, committed_at=None) -> "VersionedTable":
        """Version 0: an empty, full version with the given schema."""
        if self.exists():
            if if_not_exists:
                return self
            raise VersionedTableError(f"table exists at {self.path}")
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        cols = [{"name": f.name, "physical": f.name, "type": f.dataType.simpleString()} for f in schema.fields]
        self._records = []
        self._commit("create", committed_at, full=True, columns_json=json.dumps(cols), partition_by=list(partition_by), next_row_id=0,
                     properties=json.dumps(dict(properties or {})), expired_before=0)
        return self

    def drop(self) -> None:
        """Remove the table and all its files (idempotent)."""
        fs, p = _storage(self.spark, self.path)
        if fs.exists(p):
            fs.delete(p, True)
        self._records = None

    # ---------------------------------------------------------------- reads
    def _physical_schema(self) -> T.StructType:
        """Of the files: all columns a version ever had stay readable by physical name."""
        seen = {c["physical"]: c["type"] for r in self.commits() for c in json.loads(r["columns_json"])}
        fields = [T.StructField(name, _dtype(kind)) for name, kind in seen.items()]
        return T.StructType([*fields, T.StructField(ROW_ID, T.LongType())])

    def _rows(self, records: Sequence[dict], ops: Sequence[str]) -> DataFrame:
        """Rows of the attempts that the given records name; no other folder is listed."""
        schema = self._physical_schema().add(VERSION, "long").add(ATTEMPT, "string").add(OP, "string")
        folders = [f"{self.data_path}/{VERSION}={r['version']}/{ATTEMPT}={a}" for r in records for a in r["attempts"]]
        if not folders:
            return self.spark.createDataFrame([], schema).drop(ATTEMPT)
        rows = self.spark.read.schema(schema).option("basePath", self.data_path).parquet(*folders)
        return rows.where(F.col(OP).isin(*ops)).drop(ATTEMPT)

    def _check_readable(self, v: int) -> None:
        if not 0 <= v <= self.current_version:
            raise VersionedTableError(f"version {v} does not exist (have 0 to {self.current_version})")
        oldest = self._last()["expired_before"] or 0
        if v < oldest:
            raise VersionedTableError(f"version {v} was expired (oldest readable: {oldest})")

    def state_with_meta(self, version: int | None = None) -> DataFrame:
        """Live rows at ``version``: physical columns and ``_row_id``."""
        v = self.current_version if version is None else version
        self._check_readable(v)
        full = max(r["version"] for r in self.commits()[: v + 1] if r["full"])
        records = self.commits()[full : v + 1]
        inserted = self._rows(records, [INSERT]).drop(VERSION, OP)
        later = [r for r in records if r["changes"]]
        if not later:
            return inserted
        changes = self._rows(later, [UPDATE, DELETE])
        rank = F.row_number().over(Window.partitionBy(ROW_ID).orderBy(F.col(VERSION).desc()))
        latest = changes.withColumn("__rank", rank).where(f"__rank = 1 AND {OP} = '{UPDATE}'").drop("__rank", VERSION, OP)
        untouched = inserted.join(changes.select(ROW_ID), ROW_ID, "left_anti")
        return untouched.unionByName(latest)

    def _to_logical(self, df: DataFrame, version: int | None = None, keep_id: bool = False) -> DataFrame:
        cols = [qcol(c["physical"]).alias(c["name"]) for c in self._columns(version)]
        return df.select(*cols, *([F.col(ROW_ID)] if keep_id else []))

    def read(self, version: int | None = None) -> DataFrame:
        """The table's rows at ``version`` (default: current), in that version's columns."""
        state = self.state_with_meta(version)
        return self._to_logical(state, version)

    def version_at(self, ts) -> int:
        """Last version committed at or before ``ts``."""
        if isinstance(ts, str):
            ts = _dt.datetime.fromisoformat(ts)
        found = [r["version"] for r in self.commits() if _dt.datetime.fromisoformat(r["committed_at"]) <= ts]
        if not found:
            raise VersionedTableError(f"no version committed at or before {ts}")
        return max(found)

    def read_at(self, ts) -> DataFrame:
        return self.read(self.version_at(ts))

    def history(self) -> DataFrame:
        """One row per version."""
        return self.spark.read.schema(COMMIT_SCHEMA).json(self.commits_path).select(
            "version", F.col("committed_at").cast("timestamp_ntz").alias("committed_at"), "operation", "rows_inserted", "rows_updated", "rows_deleted"
        )

    # --------------------------------------------------------------- writes
    def _physical(self, df: DataFrame) -> DataFrame:
        """Logical input columns -> physical names; missing columns NULL; extra columns rejected."""
        cols = self._columns()
        known = {c["name"] for c in cols}
        extra = [c for c in df.columns if c not in known and c not in META]
        if extra:
            raise VersionedTableError(f"columns {extra} not in table schema; add them first")
        out = [
            (qcol(c["name"]) if c["name"] in df.columns else F.lit(None)).cast(_dtype(c["type"])).alias(c["physical"]) for c in cols
        ]
        return df.select(*out, *[F.col(m) for m in META if m in df.columns])

    def _fresh(self, df: DataFrame) -> DataFrame:
        """Inserted rows with new ids."""
        return df.withColumns({ROW_ID: F.monotonically_increasing_id() + F.lit(self._last()["next_row_id"] or 0), OP: F.lit(INSERT)})

    def _attempt(self, rows: DataFrame) -> dict:
        """Write physical rows with ``_row_id`` and ``_op`` to a folder of their own; what the commit has to say about it."""
        attempt, seen = uuid.uuid4().hex, Observation()
        parts = [{c["name"]: c["physical"] for c in self._columns()}[p] for p in self.partition_by()]
        counts = [F.count_if(F.col(OP) == o).alias(n) for o, n in ((INSERT, "i"), (UPDATE, "u"), (DELETE, "d"))]
        rows.observe(seen, *counts, F.max(ROW_ID).alias("id")).write.partitionBy(OP, *parts).parquet(
            f"{self.data_path}/{VERSION}={len(self.commits())}/{ATTEMPT}={attempt}"
        )
        got = seen.get
        n = {k: got.get(k) or 0 for k in "iud"}
        return {
            "attempts": [attempt] if any(n.values()) else [], "changes": bool(n["u"] or n["d"]),
            "rows_inserted": n["i"], "rows_updated": n["u"], "rows_deleted": n["d"],
            "next_row_id": max(self._last()["next_row_id"] or 0, (got.get("id") if got.get("id") is not None else -1) + 1),
        }

    def append(self, df: DataFrame, committed_at=None) -> int:
        """Insert rows as a new version; returns the version."""
        return self._commit("append", committed_at, **self._attempt(self._fresh(self._physical(df))))

    def overwrite(self, df: DataFrame, committed_at=None, partitions: bool = False) -> int:
        """Replace the table's rows.

        ``partitions=False`` (static, Spark's default): the new version holds
        the whole state.  ``partitions=True`` (dynamic): only partitions that
        appear in ``df`` are replaced, NULL ones included; their old rows are
        deleted.
        """
        new = self._fresh(self._physical(df))
        if not partitions or not self.partition_by():
            return self._commit("overwrite", committed_at, full=True, **self._attempt(new))
        phys = {c["name"]: c["physical"] for c in self._columns()}
        keys = [phys[p] for p in self.partition_by()]
        touched = new.select(*[qcol(k).alias(f"__new_{i}") for i, k in enumerate(keys)]).distinct()
        same = functools.reduce(lambda a, b: a & b, [qcol(k).eqNullSafe(F.col(f"__new_{i}")) for i, k in enumerate(keys)])
        old = self.state_with_meta().join(touched, same, "left_semi").withColumn(OP, F.lit(DELETE))
        return self._commit("overwrite_partitions", committed_at, **self._attempt(new.unionByName(old, allowMissingColumns=True)))

    def _where(self, cond: Column | str) -> Column:
        return F.coalesce(F.expr(cond) if isinstance(cond, str) else cond, F.lit(False))

    def delete(self, cond: Column | str, committed_at=None) -> int:
        """Delete rows where ``cond`` is true (NULL keeps the row)."""
        gone = self._to_logical(self.state_with_meta(), keep_id=True).where(self._where(cond)).withColumn(OP, F.lit(DELETE))
        return self._commit("delete", committed_at, **self._attempt(self._physical(gone)))

    def update(self, cond: Column | str | None, assignments: Mapping[str, Column], committed_at=None) -> int:
        """Set columns on rows where ``cond`` is true (NULL leaves the row untouched)."""
        state = self._to_logical(self.state_with_meta(), keep_id=True)
        hit = state if cond is None else state.where(self._where(cond))
        changed = hit.withColumns({k: (F.lit(e) if not isinstance(e, Column) else e) for k, e in assignments.items()})
        return self._commit("update", committed_at, **self._attempt(self._physical(changed.withColumn(OP, F.lit(UPDATE)))))

    def merge(self, source: DataFrame, on: Sequence[str], update_columns: Sequence[str] | None = None, insert: bool = True,
              committed_at=None, stream: tuple[str, int] | None = None) -> int:
        """Upsert ``source``: matched target rows get ``update_columns`` (default:
        every non-key source column); unmatched source rows are inserted by name.

        NULL keys never match.  Two source rows for one target row raise
        before anything is visible.  The source is evaluated once (staged in
        the shared folder); the target rows whose key it has come from one
        semi join, whose strategy the planner picks from the staged size;
        updates and inserts come from one outer join and one write.

        ``stream``: (query id, batch id) kept in the merge's own record; a
        batch of a query that has committed it or a later one is a no-op.
        """
        if stream is not None:
            done = [r["stream_batch"] for r in self.commits() if r["stream_query"] == stream[0]]
            if done and max(done) >= stream[1]:
                return self.current_version
        keys, names = list(on), [c["name"] for c in self._columns()]
        upd = list(update_columns) if update_columns is not None else [c for c in source.columns if c not in keys]
        path = scratch_path(self.spark, "merge-source")
        source.write.parquet(path)
        src = self.spark.read.schema(source.schema).parquet(path)
        has_key = functools.reduce(lambda a, b: a & b, [qcol(k).isNotNull() for k in keys])
        target = self._to_logical(self.state_with_meta(), keep_id=True)
        hits = target.join(src.where(has_key).select(*keys).distinct(), keys, "left_semi")
        old = hits.select(*[qcol(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.struct(*[qcol(n) for n in names]).alias("__old"), F.col(ROW_ID))
        equal = functools.reduce(lambda a, b: a & b, [qcol(k) == F.col(f"__k{i}") for i, k in enumerate(keys)])
        both = src.join(old, equal, "left" if insert else "inner")
        matched = F.col(ROW_ID).isNotNull()

        def value(name: str) -> Column:
            new = qcol(name) if name in source.columns else F.lit(None)
            return F.when(matched & F.lit(name not in upd and name not in keys), F.col("__old").getField(name)).otherwise(new).alias(name)

        start = F.lit(self._last()["next_row_id"] or 0)
        rows = both.select(
            *[value(n) for n in names],
            F.coalesce(F.col(ROW_ID), F.monotonically_increasing_id() + start).alias(ROW_ID),
            F.when(matched, UPDATE).otherwise(INSERT).alias(OP),
        )
        extra = [c for c in source.columns if c not in names]
        if extra:
            raise VersionedTableError(f"columns {extra} not in table schema; add them first")
        done = self._attempt(self._physical(rows))
        if done["rows_updated"]:
            written = self._rows([{**done, "version": len(self.commits())}], [UPDATE])
            if not written.groupBy(ROW_ID).count().where("count > 1").isEmpty():
                raise VersionedTableError("merge: a target row matched more than one source row")
        query, batch = stream or (None, None)
        return self._commit("merge", committed_at, stream_query=query, stream_batch=batch, **done)

    # ------------------------------------------------------- change views
    def _touched(self, low: int, high: int) -> DataFrame:
        return self._rows(self.commits()[low + 1 : high + 1], [INSERT, UPDATE, DELETE]).select(ROW_ID).distinct()

    def _rewritten(self, low: int, high: int) -> bool:
        return any(r["full"] for r in self.commits()[low + 1 : high + 1])

    def changes(self, from_version: int, to_version: int | None = None) -> DataFrame:
        """Net row changes between two versions: ``change_type`` insert /
        update / delete with the row's values (old values for deletes).

        Only rows touched by versions in between are compared, unless a full
        rewrite happened in between."""
        to_v = self.current_version if to_version is None else to_version
        cols = self._columns(to_v)
        phys = [c["physical"] for c in cols]
        before, after = (self.state_with_meta(v).select(ROW_ID, F.struct(*phys).alias(s)) for v, s in ((from_version, "b"), (to_v, "a")))
        if not self._rewritten(from_version, to_v):
            ids = self._touched(from_version, to_v)
            before, after = (df.join(ids, ROW_ID, "left_semi") for df in (before, after))
        kind = (
            F.when(F.col("b").isNull(), F.lit("insert"))
            .when(F.col("a").isNull(), F.lit("delete"))
            .when(~F.col("a").eqNullSafe(F.col("b")), F.lit("update"))
        )
        values = F.coalesce(F.col("a"), F.col("b"))
        return (
            before.join(after, ROW_ID, "full_outer")
            .withColumn("change_type", kind)
            .where(F.col("change_type").isNotNull())
            .select(ROW_ID, "change_type", *[values.getField(c["physical"]).alias(c["name"]) for c in cols])
        )

    def rollback(self, version: int, committed_at=None) -> int:
        """Commit a new version whose state equals the state at ``version``.
        Later versions stay in the history."""
        self._check_readable(version)
        columns = {k: self._at(version)[k] for k in ("columns_json", "partition_by")}
        target = self.state_with_meta(version)
        if self._rewritten(version, self.current_version) or columns["partition_by"] != self._last()["partition_by"]:
            done = self._attempt(target.withColumn(OP, F.lit(INSERT)))
            return self._commit("rollback", committed_at, full=True, **columns, **done)
        touched = self._touched(version, self.current_version)
        restore = target.join(touched, ROW_ID, "left_semi").withColumn(OP, F.lit(UPDATE))
        now = self.state_with_meta().join(touched, ROW_ID, "left_semi")
        remove = now.join(target.select(ROW_ID), ROW_ID, "left_anti").withColumn(OP, F.lit(DELETE))
        return self._commit("rollback", committed_at, **columns, **self._attempt(restore.unionByName(remove)))

    # ---------------------------------------------------------- evolution
    def add_column(self, name: str, dtype: str | T.DataType, committed_at=None) -> int:
        """Add a column as a new version; rows written before read it as NULL."""
        if isinstance(dtype, str):
            dtype = _dtype(dtype)
        cols = self._columns()
        if any(c["name"] == name for c in cols):
            raise VersionedTableError(f"column {name!r} exists")
        physical, taken = name, set(self._physical_schema().names)
        while physical in taken:
            physical = "_" + physical
        cols.append({"name": name, "physical": physical, "type": dtype.simpleString()})
        return self._commit("add_column", committed_at, columns_json=json.dumps(cols))

    def rename_column(self, old: str, new: str, committed_at=None) -> int:
        """Rename a column as a new version (metadata only; files keep the physical name)."""
        cols = self._columns()
        if not any(c["name"] == old for c in cols):
            raise VersionedTableError(f"no column {old!r}")
        if any(c["name"] == new for c in cols):
            raise VersionedTableError(f"column {new!r} exists")
        cols = [{**c, "name": new if c["name"] == old else c["name"]} for c in cols]
        parts = [new if p == old else p for p in self.partition_by()]
        return self._commit("rename_column", committed_at, columns_json=json.dumps(cols), partition_by=parts)

    # --------------------------------------------------------- rewriting
    def compact(self, committed_at=None) -> int:
        """A full version with the current rows and ids, written in evenly sized files; earlier versions stay."""
        state = self.state_with_meta().withColumn(OP, F.lit(INSERT)).hint("rebalance")
        return self._commit("compact", committed_at, full=True, **self._attempt(state))

    def expire(self, older_than=None, keep_from_version: int | None = None, committed_at=None) -> int:
        """Make versions before a cutoff unreadable; returns the oldest readable one.

        ``older_than``: versions followed by another one committed before it;
        none if the table is younger.  No file is removed: what only expired
        versions name is listed by :meth:`unreferenced`, for the storage's
        own lifecycle rules.
        """
        if keep_from_version is None:
            cutoff = older_than if older_than is not None else _now() - _dt.timedelta(days=7)
            before = [r["version"] for r in self.commits() if _dt.datetime.fromisoformat(r["committed_at"]) <= cutoff]
            keep_from_version = max(before, default=0)
        keep = max(keep_from_version, self._last()["expired_before"] or 0)
        self._check_readable(keep)
        self._commit("expire", committed_at, expired_before=keep)
        return keep

    def unreferenced(self) -> DataFrame:
        """(path, size, version) of data files no readable version needs, found by a listing job."""
        oldest = self._last()["expired_before"] or 0
        base = max((r["version"] for r in self.commits()[: oldest + 1] if r["full"]), default=0)
        named = [(a,) for r in self.commits()[base:] for a in r["attempts"]]
        fs, p = _storage(self.spark, self.data_path)
        if not fs.exists(p):
            return self.spark.createDataFrame([], "path string, size long, version long")
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(self.data_path)
        found = files.select(
            "path", F.col("length").alias("size"), F.regexp_extract("path", rf"/{VERSION}=(\d+)/", 1).try_cast("long").alias("version"),
            F.regexp_extract("path", rf"/{ATTEMPT}=(\w+)/", 1).alias("attempt"),
        )
        return found.join(self.spark.createDataFrame(named, "attempt string"), "attempt", "left_anti").select("path", "size", "version")
