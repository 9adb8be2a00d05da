"""Operator 5, byte-level BPE encoding and decoding with DuckDB's recursive queries inside the tasks.

Every task cuts its texts into pieces by the tokenizer's pattern, keeps the pieces it has not met
yet and hands them to DuckDB, one process-local database with one thread beside each Python
worker. There a recursive query joins the token positions of each piece with the merge table and
contracts the piece's leftmost pair of lowest rank, until no pair is left. Decoding joins the ids
with the vocabulary and puts the pieces of bytes together by an ordered aggregation. Spark deals
out the work; there is no shuffle, and memory is bounded by slices of texts and a limited cache.

Pieces over ``LONG`` bytes go through a second query which contracts all occurrences of the pair
at once where that cannot change the result: where no token that extends the merged one has a
lower rank. It keeps the number of rounds small for very long runs of letters.

Nulls, ties and odd input: a null text counts as empty and has no ids; ids decode to the bytes of
the text exactly; strings that look like special tokens are ordinary text; repeated rows are
encoded each; an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import base64
import hashlib
import os
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.llm.common import column, in_arrow, table

LONG = 64
#: Characters of text in a slice, ids decoded at once, and pieces remembered by a worker (twice: see ``encode``).
SLICE_CHARS, SLICE_IDS, REMEMBERED = 2_000_000, 1_000_000, 250_000

_SHORT_SQL = """
WITH RECURSIVE state(w, t, done) AS (
    SELECT w, t, false FROM pieces
    UNION ALL
    SELECT s.w, CASE WHEN best IS NULL THEN s.t
                     ELSE s.t[:(best & 1048575) - 1] || [(best >> 20)::INT] || s.t[(best & 1048575) + 2:] END, best IS NULL
    FROM state s LEFT JOIN (
        SELECT w, min((merged << 20) | p) AS best
        FROM (SELECT w, unnest(range(1, len(t))) AS p, (unnest(t[:len(t) - 1])::BIGINT << 20) | unnest(t[2:]) AS pair
              FROM state WHERE NOT done)
        JOIN merges USING (pair) GROUP BY w) b USING (w)
    WHERE NOT done)
SELECT w, t FROM state WHERE done
"""

_LONG_SQL = """
WITH RECURSIVE state(w, t, done) AS (
    SELECT w, t, false FROM pieces
    UNION ALL
    (WITH tokens AS (
        SELECT w, unnest(range(1, len(t) + 1)) AS p, unnest(t) AS tok,
               (unnest(t)::BIGINT << 20) | unnest(t[2:] || [NULL::INT]) AS pair
        FROM state WHERE NOT done),
     ranked AS (SELECT w, p, tok, merged, safe, min(merged) OVER (PARTITION BY w) AS low FROM tokens LEFT JOIN merges USING (pair)),
     runs AS (SELECT w, p, safe, p - row_number() OVER (PARTITION BY w ORDER BY p) AS run FROM ranked WHERE merged = low),
     turns AS (SELECT w, p, safe, row_number() OVER (PARTITION BY w, run ORDER BY p) AS turn, min(p) OVER (PARTITION BY w) AS first FROM runs),
     chosen AS (SELECT w, p FROM turns WHERE p = first OR (safe AND turn % 2 = 1))
     SELECT r.w, list((CASE WHEN c.p IS NULL THEN tok ELSE low END)::INT ORDER BY r.p) FILTER (WHERE d.p IS NULL), any_value(low) IS NULL
     FROM ranked r LEFT JOIN chosen c ON c.w = r.w AND c.p = r.p LEFT JOIN chosen d ON d.w = r.w AND d.p = r.p - 1
     GROUP BY r.w))
SELECT w, t FROM state WHERE done
"""

_DECODE_SQL = """
SELECT d, array_to_string(list(chars ORDER BY p), '') AS chars FROM positions JOIN vocabulary USING (id) GROUP BY d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file: base64 of a token's bytes, a space, its rank, line by line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Tokenizer:
    """The merge table and vocabulary of one ranks file in a database of the worker's own."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        import duckdb
        import regex

        self.ranks, self.pattern = read_ranks(ranks_path), regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        splits = [(self.ranks[token[:i]], self.ranks[token[i:]], rank) for token, rank in self.ranks.items()
                  for i in range(1, len(token)) if token[:i] in self.ranks and token[i:] in self.ranks]
        left, right, merged = np.array(splits, np.int64).reshape(-1, 3).T
        extended = np.unique(np.concatenate([left[left > merged], right[right > merged]]))
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "200MB",
                                         "temp_directory": os.path.join(tempfile.gettempdir(), f"bpe-{os.getpid()}")})
        self._create("merges", pair=left << 20 | right, merged=merged, safe=~np.isin(merged, extended))
        chars = ["".join(chr(256 + b) for b in token) for token in self.ranks]
        self._create("vocabulary", id=np.fromiter(self.ranks.values(), np.int32), chars=pa.array(chars))

    def _create(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _contract(self, sql: str, pieces: list[str]) -> None:
        raw = [p.encode() for p in pieces]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int32)
        start = pa.ListArray.from_arrays(offsets, self.bytes[np.frombuffer(b"".join(raw), np.uint8)])
        self.db.register("pieces", pa.table({"w": np.arange(len(pieces), dtype=np.int32), "t": start}))
        done = self.db.sql(sql).to_arrow_table().combine_chunks()
        self.db.unregister("pieces")
        tokens = done.column("t").combine_chunks()
        ids, ends = tokens.values.to_numpy().astype("<u4").tobytes(), tokens.offsets.to_numpy() * 4
        for w, start, end in zip(done.column("w").to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            self.known[pieces[w]] = ids[start:end]

    def learn(self, pieces: set[str]) -> None:
        """Adds the ids of pieces not known yet. A piece that is a token as it stands is that token."""
        new = []
        for piece in pieces:
            whole = self.ranks.get(piece.encode())
            if whole is None:
                new.append(piece)
            else:
                self.known[piece] = whole.to_bytes(4, "little")
        long = [p for p in new if len(p.encode()) > LONG]
        short = [p for p in new if len(p.encode()) <= LONG]
        for sql, group, step in ((_SHORT_SQL, short, 50_000), (_LONG_SQL, long, 200)):
            for i in range(0, len(group), step):
                self._contract(sql, group[i:i + step])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers.

        When enough pieces are known, they become the older ones; of these, the pieces that come up
        again are taken over, so the common ones are never learned twice.
        """
        pieces = [self.pattern.findall(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        new = set().union(*pieces).difference(self.known)
        again = new.intersection(self.older)
        self.known.update((piece, self.older[piece]) for piece in again)
        self.learn(new - again)
        return [b"".join(map(self.known.__getitem__, p)) for p in pieces]

    def forget(self) -> None:
        """Pieces are remembered for a task; the worker may sit idle for long after it."""
        self.known, self.older = {}, {}

    def decode(self, texts: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids."""
        ids = np.concatenate([*texts, np.empty(0, np.int32)]).astype(np.int32)
        self.db.register("positions", pa.table({"d": np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts]),
                                                "p": np.arange(len(ids), dtype=np.int32), "id": ids}))
        found = dict(self.db.execute(_DECODE_SQL).fetchall())
        self.db.unregister("positions")
        return [found.get(d, "").encode("utf-16-le")[::2] for d in range(len(texts))]  # chr(256 + b) back to b


_loaded: dict[tuple[str, str], Tokenizer] = {}


def tokenizer(ranks_path: str, pattern: str) -> Tokenizer:
    """One per Python worker and ranks file."""
    if (ranks_path, pattern) not in _loaded:
        _loaded[ranks_path, pattern] = Tokenizer(ranks_path, pattern)
    return _loaded[ranks_path, pattern]


def _slices(sizes: list[int], most: int):
    """Runs of rows whose sizes add up to ``most``, or single rows above it."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def _encoder(ranks_path: str, pattern: str):
    def encode(batches):
        bpe = tokenizer(ranks_path, pattern)
        for batch in batches:
            kept = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            lengths = pa.compute.utf8_length(batch.column("text")).fill_null(0).to_pylist()
            for start, end in _slices(lengths, SLICE_CHARS):
                part = batch.slice(start, end - start)
                ids = bpe.encode([text or "" for text in part.column("text").to_pylist()])
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), lists],
                                                 names=[*(batch.schema.names[i] for i in kept), "ids"])
        bpe.forget()

    return encode


def _decoder(ranks_path: str, pattern: str):
    def decode(batches):
        bpe = tokenizer(ranks_path, pattern)
        for batch in batches:
            lists = batch.column("ids")
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            texts = [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            for start, end in _slices([len(t) for t in texts], SLICE_IDS):
                part = batch.slice(start, end - start)
                decoded = pa.array(bpe.decode(texts[start:end]), pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*batch.schema.names, "decoded"])

    return decode


def _digester(encode, decode, with_ids: bool):
    def digest(batches):
        for batch in decode(encode(batches)):
            lists = batch.column("ids")
            ends, values = lists.offsets.to_numpy(), np.ascontiguousarray(lists.values.to_numpy(), "<u4")
            ids = [hashlib.sha256(values[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            decoded = [hashlib.sha256(x).hexdigest() for x in batch.column("decoded").to_pylist()]
            columns = [batch.column("id"), pa.array(np.diff(ends).astype(np.int64)), pa.array(ids), pa.array(decoded)]
            yield pa.RecordBatch.from_arrays(columns + [lists] * with_ids,
                                             names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:4 + with_ids])

    return digest


def _defaults(ranks_path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers

    return ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """``(id, ids)`` per row of ``docs``. ``ranks_path`` must name a file every executor can read."""
    rows = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return in_arrow(rows, _encoder(*_defaults(ranks_path, pattern)), schema)


def decode(encoded: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``(id, ids)`` with the ids' bytes beside them as ``decoded``; null ids decode to nothing."""
    rows = encoded.select("id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())])
    return in_arrow(rows, _decoder(*_defaults(ranks_path, pattern)), schema)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
               pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """Encodes and decodes in one pass: the row's id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``
    and, if asked for, the ``ids``."""
    rows = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
                           *[T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids])
    chosen = _defaults(ranks_path, pattern)
    return in_arrow(rows, _digester(_encoder(*chosen), _decoder(*chosen), with_ids), schema).withColumnRenamed("id", id_col)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: every document's ids, their number and digests."""
    return round_trip(docs, with_ids=True)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
