"""Operator 12, ranked lexical search over a length-stratified index.

Documents of equal normaliser m form a stratum. The index holds, per document, the query terms it
has and how often; it is range-sorted by m, so a task meets whole strata (a crowded one is cut by
id). In a task the postings of a stratum are ordered by term and tf, each term's greatest tf bounds
what it can add there, and an item's bound on a stratum is the sum of its terms' bounds. An item
visits the strata by falling bound and stops where the bound is below its twentieth score so far.
The impact of a tf is computed once per stratum and tf, not per posting. Tasks return their best of
each item; one more grouping picks the best of all.

Items are searched in blocks of about ``BLOCK_ITEMS``, each of which reads the documents once; a
block's terms and weights go to every task, so their size is bounded by the block and not by the
table of items. A task holds ``SLICE_ROWS`` documents of its part at a time.

Nulls, ties and odd input: a null text has no terms; a document without terms is not counted and
never found; an item without terms, or with none that a document has, gets no rows; equal scores
are ranked by id, null ids last, then by row number; rows that repeat an id are separate items or
documents; very long texts count whole; an empty table on either side gives an empty result; other
columns are never looked at.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.llm.common import column, in_arrow, stage, table

TOP = 20
BLOCK_ITEMS, SLICE_ROWS = 4096, 20_000
#: Every ASCII character but letters and digits parts terms.
_PARTS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, A-Z lower-cased."""
    return (text or b"").lower().translate(_PARTS).split()


def impact(tf, m):
    """What an occurrence count adds per unit of weight (integers or arrays of them)."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _counter(vocabulary: dict[bytes, int]):
    def count(batches):
        for batch in batches:
            sizes, held, tfs = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = terms(text)
                sizes.append(len(words))
                found = [(vocabulary[t], tf) for t, tf in Counter(words).items() if t in vocabulary]
                held.append([t for t, _ in found]), tfs.append([tf for _, tf in found])
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("id"), pa.array(sizes, pa.int64()),
                                              pa.array(held, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                                             names=["rid", "id", "n", "terms", "tfs"])

    return count


class _Items:
    """A block's items as flat arrays: the terms of all items, how often each has them, and where an item starts."""

    def __init__(self, items: list[tuple[int, Counter]], weights: np.ndarray) -> None:
        self.rids = [rid for rid, _ in items]
        self.starts = np.concatenate([[0], np.cumsum([len(c) for _, c in items])]).astype(np.int64)
        self.terms = np.fromiter((t for _, c in items for t in c), np.int64, self.starts[-1])
        times = np.fromiter((q for _, c in items for q in c.values()), np.int64, self.starts[-1])
        self.gain = times * weights[self.terms]  # what one unit of impact is worth

    def part(self, item: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(self.starts[item], self.starts[item + 1])
        return self.terms[span], self.gain[span]


class Stratum:
    """The postings of the documents of one m: by term, then by tf."""

    def __init__(self, m: int, start: int, docs: int, at: np.ndarray, held: np.ndarray, tfs: np.ndarray, n_terms: int) -> None:
        order = np.lexsort((-tfs, held))
        self.start, self.docs, self.at = start, docs, at[order] - start
        distinct, which = np.unique(tfs[order], return_inverse=True)
        self.impact = impact(distinct, m)[which]  # once per tf
        held = held[order]
        self.first = np.searchsorted(held, np.arange(n_terms + 1))
        self.most = np.zeros(n_terms, np.int64)  # of the term's greatest tf, 0 where no document has it
        there = self.first[1:] > self.first[:-1]
        self.most[there] = self.impact[self.first[:-1][there]]

    def bounds(self, items: _Items) -> np.ndarray:
        """No document here scores more for the item."""
        best = np.concatenate([[0], np.cumsum(items.gain * self.most[items.terms])])
        return best[items.starts[1:]] - best[items.starts[:-1]]

    def scores(self, held: np.ndarray, gain: np.ndarray) -> np.ndarray:
        total = np.zeros(self.docs, np.int64)
        for term, worth in zip(held.tolist(), gain.tolist(), strict=True):
            span = slice(self.first[term], self.first[term + 1])
            total[self.at[span]] += worth * self.impact[span]
        return total


def _strata(rows: pa.Table, n_terms: int) -> list[Stratum]:
    """The strata of rows that come sorted by m and id."""
    ms = rows.column("m").to_numpy()
    held, tfs = (rows.column(c).combine_chunks() for c in ("terms", "tfs"))
    each = np.diff(held.offsets.to_numpy())
    at, held, tfs = np.repeat(np.arange(len(ms)), each), held.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy()
    edges = np.concatenate([np.flatnonzero(np.concatenate([[True], ms[1:] != ms[:-1]])), [len(ms)]])
    ends = np.concatenate([[0], np.cumsum(each)])[edges]
    return [Stratum(int(ms[a]), int(a), int(b - a), at[x:y], held[x:y], tfs[x:y], n_terms)
            for a, b, x, y in zip(edges[:-1], edges[1:], ends[:-1], ends[1:], strict=True)]


def _best(total: np.ndarray, least: int, top: int) -> np.ndarray:
    """Places of the ``top`` highest scores from ``least`` on, ties by place."""
    places = np.flatnonzero(total >= max(least, 1))
    if len(places) > top:
        cut = np.partition(total[places], len(places) - top)[len(places) - top]
        places = places[total[places] >= cut]
    return places[np.lexsort((places, -total[places]))][:top]


def _searcher(items: _Items, n_terms: int, top: int):
    def search(batches):
        found: list[list[tuple]] = [[] for _ in items.rids]  # (-score, id is missing, id, row) of each item, best first

        def look(rows: pa.Table) -> None:
            strata = _strata(rows, n_terms)
            ids, rids = rows.column("id").to_pylist(), rows.column("rid").to_numpy()
            bounds = np.array([s.bounds(items) for s in strata])
            for item, so_far in enumerate(found):
                held, gain = items.part(item)
                for place in np.argsort(-bounds[:, item], kind="stable").tolist():
                    least = -so_far[top - 1][0] if len(so_far) >= top else 1
                    if bounds[place, item] < least:
                        break
                    s = strata[place]
                    total = s.scores(held, gain)
                    so_far += [(-int(total[p]), ids[s.start + p] is None, ids[s.start + p], int(rids[s.start + p]))
                               for p in _best(total, least, top).tolist()]
                    so_far.sort(key=lambda x: (x[0], x[1], 0 if x[1] else x[2], x[3]))
                    del so_far[top:]

        waiting, rows = [], 0
        id_type = None
        for batch in batches:
            id_type = batch.column("id").type
            waiting.append(batch)
            rows += len(batch)
            if rows >= SLICE_ROWS:
                look(pa.Table.from_batches(waiting))
                waiting, rows = [], 0
        if rows:
            look(pa.Table.from_batches(waiting))
        if id_type is not None:
            flat = [(rid, -score, i, row) for rid, best in zip(items.rids, found, strict=True) for score, _, i, row in best]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in flat], pa.int64()), pa.array([f[1] for f in flat], pa.int64()),
                                              pa.array([f[2] for f in flat], id_type), pa.array([f[3] for f in flat], pa.int64())],
                                             names=["item", "score", "id", "rid"])

    return search


def _index(rows: DataFrame, vocabulary: dict[bytes, int]) -> tuple[DataFrame, int, dict[int, int]]:
    """The documents with their m and query terms, the number of documents, and each term's df."""
    schema = T.StructType([rows.schema["rid"], rows.schema["id"], *T.StructType.fromDDL("n long, terms array<int>, tfs array<long>")])
    counts = stage(in_arrow(rows, _counter(vocabulary), schema).where("n > 0"), "counts")
    n_docs, length = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r["term"]: r["df"] for r in counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
    held = counts.where("size(terms) > 0").select("rid", "id", F.expr(f"75 + (25 * n * {n_docs}) div {max(length, 1)}").alias("m"), "terms", "tfs")
    return held, n_docs, df


def search(items: DataFrame, docs: DataFrame, top: int = TOP, item_col: str = "item_id", item_text_col: str = "text",
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``top`` best documents of each item: its id, ``rank``, the document's id and ``score``."""
    asked = stage(items.select(F.monotonically_increasing_id().alias("item"), column(item_col).alias("name"), column(item_text_col).alias("text")), "items")
    blocks = max(1, -(-asked.count() // BLOCK_ITEMS))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), column(id_col).alias("id"), column(text_col).alias("text"))
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("score", T.LongType()), rows.schema["id"], T.StructField("rid", T.LongType())])
    best = docs.sparkSession.createDataFrame([], schema)
    for block in range(blocks):
        chosen = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "text").collect()  # one block's items
        words = {r["item"]: Counter(terms((r["text"] or "").encode())) for r in chosen}
        vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for c in words.values() for t in c))}
        if not vocabulary:
            continue
        held, n_docs, df = _index(rows, vocabulary)
        weights = np.array([weight(n_docs, df.get(i, 0)) for i in range(len(vocabulary))], np.int64)
        flat = _Items([(item, Counter({vocabulary[t]: q for t, q in c.items()})) for item, c in sorted(words.items()) if c], weights)
        by_m = held.repartitionByRange("m", "id", "rid").sortWithinPartitions("m", F.col("id").asc_nulls_last(), "rid")
        best = best.unionByName(stage(in_arrow(by_m, _searcher(flat, len(vocabulary), top), schema), "found"))
    order = W.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "rid")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(asked.select("item", "name"), "item").select(F.col("name").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents),
q AS (
    SELECT item_id, term, count(*) AS times
    FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
    GROUP BY ALL),
total AS (SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS length FROM d WHERE len(words) > 0),
m AS (SELECT doc_id, 75 + (25 * len(words) * n_docs) // length AS m FROM d, total WHERE len(words) > 0),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM d) SEMI JOIN q USING (term) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM p GROUP BY term), total),
s AS (
    SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, (row_number() OVER o)::INT AS rank, doc_id, score FROM s WHERE score > 0
WINDOW o AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY rank <= 20
"""
