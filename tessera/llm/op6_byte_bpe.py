"""Byte-level BPE by recursive DuckDB queries, one in-process database per task.

Encoding: each distinct piece of a worker's texts becomes token-position rows
that join the merge table; every round contracts the leftmost pair of least
rank in each piece until none is left; a piece leaves the rounds once nothing merges in it.  Decoding joins ids with the
vocabulary and concatenates their bytes in order of position.  Ids of a text
are those of its pieces in turn, so its decoded bytes are theirs in turn.

The merge table has a row for every split of a vocabulary entry into two
entries, which is how ranks alone define merges; a piece that is itself an
entry is one id.  Its size is fixed by the vocabulary (some 110,000 rows).
Every task loads the file by its path, a parameter, on the executor.

Defined results: null text counts as empty and gives no ids; lone surrogates
become U+FFFD as in UTF-8 with replacement.  Cost of one unbroken piece grows
with the square of its length; all lengths are encoded.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import batch_of, chunks, register, rows_in, table, text_or_empty

#: Pieces merged by one recursive query, pieces decoded by one query, and pieces a worker remembers.
AT_ONCE, DECODED, KEPT = 20_000, 60_000, 400_000

ENCODE = """
WITH RECURSIVE state(piece, toks, best) AS (
    SELECT piece, toks, 0::BIGINT FROM pieces
  UNION ALL
    SELECT s.piece,
           CASE WHEN least.best IS NULL THEN toks
                ELSE toks[:(least.best & 4294967295) - 1] || [(least.best >> 32)::INTEGER] || toks[(least.best & 4294967295) + 2:] END,
           least.best
    FROM (SELECT * FROM state WHERE best IS NOT NULL) s LEFT JOIN (
        SELECT piece, min(made::BIGINT << 32 | pos) AS best
        FROM (
            SELECT piece, unnest(toks[:-2]) AS a, unnest(toks[2:]) AS b, generate_subscripts(toks[2:], 1) AS pos
            FROM state WHERE len(toks) > 1 AND best IS NOT NULL
        ) token JOIN merges ON pair = (a::BIGINT << 32 | b)
        GROUP BY piece
    ) least ON s.piece = least.piece
)
SELECT piece, toks AS ids FROM state WHERE best IS NULL ORDER BY piece
"""

DECODE = """
SELECT piece, unhex(string_agg(hexed, '' ORDER BY pos)) AS bytes
FROM (SELECT piece, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM coded) token
JOIN vocabulary USING (id) GROUP BY piece ORDER BY piece
"""

WRITE = "SELECT array_to_string(ids, ' ') AS line FROM coded ORDER BY piece"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Coder:
    """A vocabulary loaded into an in-process DuckDB."""

    def __init__(self, path: str):
        import duckdb

        self.ranks = ranks = read_ranks(path)
        pair, made = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pair.append(a << 32 | b)
                    made.append(rank)
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        merges = pa.table({"pair": pa.array(pair, pa.int64()), "made": pa.array(made, pa.int32())})
        vocabulary = pa.table({"id": pa.array(ranks.values(), pa.int32()), "hexed": pa.array([token.hex() for token in ranks])})
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", rows)
            self.db.sql(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def _query(self, name: str, rows: pa.Table, sql: str, column: str) -> pa.ChunkedArray:
        self.db.register(name, rows)
        out = self.db.sql(sql).to_arrow_table().column(column)
        self.db.unregister(name)
        return out

    def _merged(self, pieces: list[bytes]) -> Iterator[tuple[list[int], pa.ChunkedArray]]:
        """Places of pieces and the ids of each, some at a time."""
        whole, todo = [], []
        for i, piece in enumerate(pieces):
            (todo if piece not in self.ranks else whole).append(i)
        if whole:
            yield whole, pa.chunked_array([pa.array([[self.ranks[pieces[i]]] for i in whole], pa.list_(pa.int32()))])
        for at in range(0, len(todo), AT_ONCE):
            part = todo[at : at + AT_ONCE]
            data = np.frombuffer(b"".join([pieces[i] for i in part]), np.uint8)
            ends = np.cumsum([0] + [len(pieces[i]) for i in part]).astype(np.int32)
            toks = pa.ListArray.from_arrays(pa.array(ends), pa.array(self.byte[data]))
            rows = pa.table({"piece": pa.array(np.arange(len(part), dtype=np.int32)), "toks": toks})
            yield part, self._query("pieces", rows, ENCODE, "ids")

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece, which must not be empty."""
        out: list = [None] * len(pieces)
        for part, merged in self._merged(pieces):
            for i, ids in zip(part, merged.to_pylist()):
                out[i] = ids
        return out

    def _decoded(self, coded: pa.Table) -> list[bytes]:
        return self._query("coded", coded, DECODE, "bytes").to_pylist()

    def decode(self, coded: list[list[int]]) -> list[bytes]:
        """Bytes of each id list; an unknown id raises."""
        out = []
        for at in range(0, len(coded), AT_ONCE):
            part = coded[at : at + AT_ONCE]
            full = [i for i, ids in enumerate(part) if ids]
            for ids in part:
                if ids and not (0 <= min(ids) and max(ids) < len(self.ranks)):
                    raise ValueError("id outside the vocabulary")
            rows = pa.table({"piece": pa.array(full, pa.int32()), "ids": pa.array([part[i] for i in full], pa.list_(pa.int32()))})
            got = [b""] * len(part)
            for i, raw in zip(full, self._decoded(rows)):
                got[i] = raw
            out += got
        return out

    def both(self, pieces: list[bytes]) -> Iterator[tuple[int, str, bytes]]:
        """Place, ids joined by spaces, and the bytes that these ids decode to, of each piece; ids stay in Arrow between."""
        places: list[int] = []
        arrays: list[pa.Array] = []

        def flush():
            ids = pa.chunked_array(arrays, pa.list_(pa.int32()))
            rows = pa.table({"piece": pa.array(np.arange(len(places), dtype=np.int32)), "ids": ids})
            lines = self._query("coded", rows, WRITE, "line").to_pylist()
            return list(zip(places, lines, self._decoded(rows), strict=True))

        for part, merged in self._merged(pieces):
            places += part
            arrays += [c.cast(pa.list_(pa.int32())) for c in merged.chunks]
            if len(places) >= DECODED:
                yield from flush()
                places, arrays = [], []
        if places:
            yield from flush()


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


#: Ids and decoded bytes of the pieces that a worker met, by vocabulary: those of late, and those before them.
_met: dict[str, list[dict[str, tuple[str, bytes]]]] = {}


class Texts:
    """Encodes and decodes texts piece by piece, each distinct piece once in a worker that remembers it."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.coder, self.split = coder(path), regex.compile(pattern).findall
        self.met = _met.setdefault(path, [{}, {}])

    @property
    def known(self) -> dict[str, tuple[str, bytes]]:
        return self.met[0]

    def pieces(self, texts: list[str]) -> list[list[str]]:
        """Pieces of each text; afterwards ``known`` has the ids and decoded bytes of all of them."""
        split = [self.split(t) for t in texts]
        if len(self.known) > KEPT // 2:
            self.met[:] = [{}, self.known]
        known, before = self.met
        new = []
        for piece in set().union(*split) - known.keys():
            if piece in before:
                known[piece] = before[piece]
            else:
                new.append(piece)
        for i, line, raw in self.coder.both([p.encode("utf-8", "replace") for p in new]):
            known[new[i]] = (line, raw)
        return split


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document the number and digest of its ids, and the digest of the bytes they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = Texts(path, pattern)
        for rows in chunks(rows_in(batches), lambda r: len(r[1]), 1 << 22):
            out, split = [], texts.pieces([r[1] for r in rows])
            known = texts.known
            for (doc_id, _), pieces in zip(rows, split):
                own = [known[p] for p in pieces]
                ids = " ".join([x[0] for x in own])
                raw = b"".join([x[1] for x in own])
                out.append((doc_id, ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(raw).hexdigest()))
            yield batch_of(SCHEMA, list(zip(*out)))

    return docs.select("doc_id", text_or_empty("text").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every document."""

    def run(batches):
        texts = Texts(path, pattern)
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
        for rows in chunks(rows_in(batches), lambda r: len(r[1]), 1 << 22):
            split = texts.pieces([r[1] for r in rows])
            known = texts.known
            ids = [[int(x) for p in ps for x in known[p][0].split()] for ps in split]
            yield batch_of(schema, [[r[0] for r in rows], ids])

    return docs.select("doc_id", text_or_empty("text").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """(doc_id, bytes) of rows (doc_id, ids); null ids count as none."""

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("bytes", pa.binary())])
        for rows in chunks(rows_in(batches), lambda r: len(r[1] or ()), 1 << 20):
            yield batch_of(schema, [[r[0] for r in rows], coder(path).decode([list(r[1] or ()) for r in rows])])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


@register("op6_byte_bpe")
def op6(spark, sf_dir):
    import public_tokenizers

    return digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
