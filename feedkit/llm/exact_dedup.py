"""Operator 9, exact dedup by deterministic block naming.

Every text is cut into blocks of a fixed number of characters. All blocks are sorted and
numbered, equal blocks alike; then adjacent numbers are paired, the pairs sorted and numbered
again, until each text has one number. Texts with as many blocks and the same last number are
identical, with no hash involved (Karp, Miller and Rosenberg's naming).

Copies within one input split are folded into one representative before anything is shuffled,
so a group that holds a third of all rows sends one row per split. Equal blocks of one split are sent
once as well, under a reference, whatever the number of texts that hold them; their numbers go back to
the texts by a join of references.

Nulls, ties and odd input: a null text counts as empty, empty texts equal one another; rows
without an id come last in their group; of rows that repeat an id, one stays; very long texts are cut like
any other and their numbers paired as often as they need; an empty table gives an empty result; other
columns are never looked at.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.llm.common import StagingScope, column, first_id, in_arrow, match, numbered, stage, table, without

BLOCK = 2048
#: Characters of distinct texts a split keeps to fold its own copies; beyond it folding starts afresh.
FOLD_CHARS = 8_000_000
#: Rows a task turns into blocks at once.
FOLD_ROWS = 500
_WHITE = b" \t\n\v\f\r"


def normalised(text: str | None) -> bytes:
    """UTF-8 of the text with each run of ASCII white space as one space."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return b" " if raw else b""
    return b" " * (raw[0] in _WHITE) + b" ".join(words) + b" " * (raw[-1] in _WHITE)


def _folder(block: int, id_type: pa.DataType):
    schema = pa.schema([("rid", pa.int64()), ("id", id_type), ("sha", pa.string()), ("rep", pa.int64()), ("n", pa.int32()),
                        ("refs", pa.list_(pa.int64())), ("blocks", pa.list_(pa.struct([("ref", pa.int64()), ("block", pa.string())])))])

    def fold(batches):
        texts: dict[bytes, tuple[int, str, int]] = {}
        known: dict[str, int] = {}
        held, ref = 0, TaskContext.get().partitionId() << 33
        for batch in (whole.slice(at, FOLD_ROWS) for whole in batches for at in range(0, len(whole), FOLD_ROWS)):
            shas, reps, counts, refs, blocks = [], [], [], [], []
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("text"), strict=True):
                flat = normalised(text.as_py())
                if flat not in texts:
                    if held > FOLD_CHARS:
                        texts, known, held = {}, {}, 0
                    chars = flat.decode()
                    parts = [chars[i:i + block] for i in range(0, len(chars), block)] or [""]
                    texts[flat] = rid, hashlib.sha256(flat).hexdigest(), len(parts)
                    held += len(flat)
                    new = []
                    for part in parts:
                        if part not in known:
                            known[part], ref = ref, ref + 1
                            new.append({"ref": known[part], "block": part})
                    refs.append([known[part] for part in parts]), blocks.append(new)
                else:
                    refs.append(None), blocks.append(None)
                rep, sha, count = texts[flat]
                shas.append(sha), reps.append(rep), counts.append(count)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("id"), pa.array(shas, pa.string()), pa.array(reps, pa.int64()), pa.array(counts, pa.int32()),
                 pa.array(refs, schema.field("refs").type), pa.array(blocks, schema.field("blocks").type)], schema=schema)

    return fold


def named(df: DataFrame, keys: list[str], spread: list | None = None) -> DataFrame:
    """``df`` with its ``keys`` replaced by one integer ``name``: sorted, equal keys numbered alike.

    ``spread``: shorter values of the keys to sort by first, for Spark samples these on the driver.
    """
    spread = spread or keys
    kept = [f for f in df.schema.fields if f.name not in keys]
    columns = [f.name for f in kept]
    out = T.StructType([*kept, T.StructField("name", T.LongType())])

    def number(batches):
        name, last = TaskContext.get().partitionId() << 33, None
        for batch in batches:
            names = []
            for key in zip(*(batch.column(k).to_pylist() for k in keys), strict=True):
                if key != last:
                    name, last = name + 1, key
                names.append(name)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(names, pa.int64())],
                                             names=[*columns, "name"])

    return in_arrow(df.repartitionByRange(*spread).sortWithinPartitions(*spread, *keys), number, out)


def block_identities(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """From ``rows(rid, id, text)``: the folded rows ``(rid, id, sha, rep, ...)`` and, for each
    representative, its identity ``(rep, n, name)``."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("rid", T.LongType()), T.StructField("id", id_type),
                           *T.StructType.fromDDL("sha string, rep long, n int, refs array<long>, blocks array<struct<ref:long,block:string>>")])
    with StagingScope(rows.sparkSession) as scope:  # the blocks go when they have their numbers
        whole = stage(in_arrow(rows, _folder(block, to_arrow_type(id_type)), schema), "whole")
        blocks = whole.select(F.explode("blocks").alias("b")).select("b.ref", "b.block")
        names = named(blocks, ["block"], [F.substring("block", 1, 16), F.xxhash64("block")])
        places = whole.where("refs IS NOT NULL").select("rep", "n", F.posexplode("refs").alias("pos", "ref"))
        level = scope.keep(match(places, names, ["ref"]).select("rep", "n", "pos", "name"), "level")
        folded = scope.keep(whole.drop("refs", "blocks"), "folded")
    longest = folded.agg(F.max("n")).first()[0] or 1
    done, width = level.where("n = 1"), 1
    while width < longest:  # one pass per doubling of the longest text
        pairs = (level.where(f"n > {width}").groupBy("rep", "n", F.expr("pos div 2").cast("int").alias("pos"))
                 .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b")))
        level = stage(named(pairs, ["a", "b"]), "level")
        width *= 2
        done = done.unionByName(level.where(f"n > {width // 2} AND n <= {width}"))
    return folded, done.select("rep", "n", "name")


def exact_groups(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows(rid, id, text)`` to ``(rid, id, keep_id, keep_rid, group_size, text_sha256)``."""
    folded, identity = block_identities(rows, block)
    reps = folded.groupBy("rep").agg(F.min(first_id()).alias("first"), F.count("*").alias("rows"))
    reps = reps.join(identity, "rep")  # at most one row per split and text from here on
    groups = reps.groupBy("n", "name").agg(F.min("first").alias("keep"), F.sum("rows").alias("group_size"))
    of_rep = reps.select("rep", "n", "name").join(groups, ["n", "name"]).select("rep", "keep", "group_size")
    return folded.select("rid", "id", "sha", "rep").join(of_rep, "rep").select(
        "rid", "id", F.col("keep.id").alias("keep_id"), F.col("keep.rid").alias("keep_rid"), "group_size",
        F.col("sha").alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), column(id_col).alias("id"),
                       column(text_col).alias("text"))
    return exact_groups(rows, block).select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the first row of each group of equal texts, all columns."""
    rows = numbered(docs)
    groups = exact_groups(rows.select("rid", F.col("row.doc_id").alias("id"), F.col("row.text").alias("text")))
    return without(rows, groups.where("rid <> keep_rid"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS flat FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       sha256(flat) AS text_sha256
FROM t WINDOW w AS (PARTITION BY flat)
"""
