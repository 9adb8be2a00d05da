"""Operator 10, MinHash near-dedup by a multi-index Hamming join.

A text's set of word shingles gives a signature of ``CHUNKS * WIDTH`` MinHash values of 16 bits
each. The signature is cut into chunks; if two signatures differ in at most ``RADIUS`` places,
some chunk differs in at most ``ERRORS`` places (pigeonhole), so indexing every chunk with every
choice of ``ERRORS`` places left out brings each such pair together in a bucket. At the default
48 values and radius 23 a pair at similarity 0.8 lies outside with probability below 1e-5.

Links are confirmed on the full shingle sets. Not all pairs of a bucket are looked at: texts with
one set are one node (folded per input split before the shuffle), and each node is first checked
against the nearest and the most central of its buckets' hubs. Nodes whose buckets then still hold several components are
compared by an exact positional prefix filter over their rare shingles, or over what they change in
the hub they share, which leaves out the pairs that cannot be similar enough before they are made;
the rest of different components are confirmed like the others. One shared bucket is enough to be
compared there, so every pair within the radius is. Most nodes of mixed buckets only have a passage
in common with others; they fall out first, by their lowest hashes: two similar sets share ``EXTRA``
percent of their size among these. Families of edited copies cost about a row per member instead of
one per pair.

Shingles are compared as 64-bit hashes (two different shingles of one pair agree with a chance
around 1e-12).

Nulls, ties and odd input: a null text, or one without words, has an empty set and is linked with
nothing; a text shorter than a shingle has its word sequence as its only shingle; repeated rows
are members of one node; rows without an id count last when the smallest id is taken; an empty
table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.llm.common import column, first_id, in_arrow, match, numbered, stage, table, without
from feedkit.llm.graph import components

CHUNKS, WIDTH, ERRORS = 12, 4, 1
RADIUS = CHUNKS * (ERRORS + 1) - 1
#: Percent of a set's size by which its lowest hashes are more than a similar set may lack.
EXTRA = 15
_RANDOM = np.random.default_rng(20240607)
_MULTIPLY = _RANDOM.integers(0, 2**63, CHUNKS * WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RANDOM.integers(0, 2**63, CHUNKS * WIDTH, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_KEPT = list(combinations(range(WIDTH), WIDTH - ERRORS))


class _WordHashes(dict):
    """64-bit hash of a word, remembered; emptied when large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(text: str | None, size: int, hashes: _WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; A-Z lower-cased, words cut at ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    length = min(size, len(ids))
    count = len(ids) - length + 1
    mixed = np.full(count, length, np.uint64)
    for i in range(length):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX + ids[i:i + count]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """One 16-bit value per hash function: bits of the smallest hash over the set."""
    low = np.full(CHUNKS * WIDTH, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 4096):
        low = np.minimum(low, (shingles[i:i + 4096, None] * _MULTIPLY + _ADD).min(axis=0))
    return (low * _MIX >> np.uint64(48)).astype(np.uint16)


def _signer(size: int, schema: pa.Schema):
    def sign(batches):
        hashes, seen = _WordHashes(), {}
        for batch in batches:
            reps, counts, sets, signs = [], [], [], []
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("text"), strict=True):
                shingles = shingle_hashes(text.as_py(), size, hashes)
                counts.append(len(shingles))
                mark = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None
                new = mark is not None and mark not in seen
                if new:
                    seen[mark] = rid
                reps.append(seen.get(mark, rid))
                sets.append(mark if new else None)
                signs.append(signature(shingles).tobytes() if new else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("rid", "id", "k")), pa.array(reps, pa.int64()),
                 pa.array(counts, pa.int64()), pa.array(sets, pa.binary()), pa.array(signs, pa.binary())], schema=schema)

    return sign


def _matrix(signs: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(signs.to_pylist()), np.uint16).reshape(len(signs), CHUNKS * WIDTH)


def _index(batches):
    """A row for each chunk and each choice of places kept in it: the key holds chunk, choice and values."""
    for batch in batches:
        signs = _matrix(batch.column("sig")).astype(np.int64).reshape(-1, CHUNKS, WIDTH)
        node, n = (batch.column(c).to_numpy() for c in ("node", "n"))
        for chunk in range(CHUNKS):
            for choice, places in enumerate(_KEPT):
                key = np.full(len(node), chunk * len(_KEPT) + choice, np.int64)
                for p in places:
                    key = (key << 16) | signs[:, chunk, p]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(n)], names=["key", "node", "n"])


def _distances(batches):
    for batch in batches:
        far = (_matrix(batch.column("sig_a")) != _matrix(batch.column("sig_b"))).sum(axis=1)
        near = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(far.astype(np.int32))],
                                          names=["a", "b", "distance"])
        yield near.filter(pa.array(far <= RADIUS))


def _sets(size: int):
    def make(batches):
        hashes, seen = _WordHashes(), set()
        for batch in batches:
            nodes, counts, sets = [], [], []
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text"), strict=True):
                if node not in seen:
                    seen.add(node)
                    shingles = shingle_hashes(text.as_py(), size, hashes)
                    nodes.append(node), counts.append(len(shingles)), sets.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()), pa.array(sets, pa.binary())],
                                             names=["node", "n", "set"])

    return make


_ELEMENTS = "node long, n long, comp long, lead long, size long, group long, element long"


def _spread(batch: pa.RecordBatch, sets: list[np.ndarray], groups: np.ndarray):
    """A row per element of each row's set, in pieces."""
    sizes = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate([*sets, np.empty(0, np.int64)])
    columns = [*(batch.column(c).to_numpy() for c in ("node", "n", "comp", "lead")), sizes, groups]
    for i in range(0, len(flat), 500_000):
        at = owner[i:i + 500_000]
        yield pa.RecordBatch.from_arrays([*(pa.array(c[at]) for c in columns), pa.array(flat[i:i + 500_000])],
                                         names=["node", "n", "comp", "lead", "size", "group", "element"])


def _elements(batches):
    for batch in batches:
        yield from _spread(batch, [np.frombuffer(v.as_py(), np.int64) for v in batch.column("set")], np.zeros(len(batch), np.int64))


def _lowest(percent: int):
    def lowest(batches):
        for batch in batches:
            nodes, sizes, found = [], [], []
            for node, n, data in zip(batch.column("node").to_pylist(), batch.column("n").to_pylist(), batch.column("set"), strict=True):
                low = np.frombuffer(data.as_py(), np.uint64)[:n + (-percent * n) // 100 - (-EXTRA * n) // 100]
                nodes.append(np.full(len(low), node)), sizes.append(np.full(len(low), n)), found.append(low.view(np.int64))
            empty = [np.empty(0, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x + empty).astype(np.int64)) for x in (nodes, sizes, found)],
                                             names=["node", "n", "element"])

    return lowest


def _differences(batches):
    for batch in batches:
        pairs = zip(batch.column("set"), batch.column("lead_set"), strict=True)
        sets = [np.setxor1d(*(np.frombuffer(v.as_py(), np.int64) for v in pair), assume_unique=True) for pair in pairs]
        yield from _spread(batch, sets, batch.column("lead").to_numpy())


def _confirm(percent: int):
    def confirm(batches):
        for batch in batches:
            links = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (a, b))
                common = len(np.intersect1d(x, y, assume_unique=True))
                links.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(links, pa.bool_()))

    return confirm


class _Join:
    """The join's tables and the three steps each round of it needs."""

    def __init__(self, rows: DataFrame, size: int, percent: int) -> None:
        from pyspark.sql.pandas.types import to_arrow_schema

        self.size, self.percent = size, percent
        self.texts = rows.select("rid", "id", F.xxhash64("id", "text").alias("k"), "text")
        schema = T.StructType([T.StructField("rid", T.LongType()), T.StructField("id", rows.schema["id"].dataType),
                               T.StructField("k", T.LongType()), T.StructField("rep", T.LongType()),
                               T.StructField("n", T.LongType()), T.StructField("shingles", T.BinaryType()),
                               T.StructField("sig", T.BinaryType())])
        self.signed = stage(in_arrow(self.texts, _signer(size, to_arrow_schema(schema)), schema), "signed")
        reps = self.signed.where("shingles IS NOT NULL").select("rep", "k", "n", "shingles", "sig")
        self.nodes = stage(reps.groupBy("shingles").agg(F.min(F.struct("rep", "k", "n", "sig")).alias("x"))
                           .select("shingles", F.col("x.rep").alias("node"), "x.k", "x.n", "x.sig"), "nodes")
        self.rep_nodes = reps.select("rep", "shingles").join(self.nodes.select("shingles", "node"), "shingles")

    def alike(self, n: str, m: str) -> str:
        """Sets whose sizes are too far apart cannot be similar enough."""
        return f"100 * least({n}, {m}) >= {self.percent} * greatest({n}, {m})"

    def buckets(self) -> DataFrame:
        """``(key, node, n, hub, hub_n, score)`` of every bucket with more than one member. The hub is the member
        whose own buckets are the most crowded: in a family of edited copies, the text they come from."""
        keys = in_arrow(self.nodes.select("node", "n", "sig"), _index, "key long, node long, n long")
        sizes = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
        crowded = stage(keys.join(sizes, "key"), "crowded")
        score = crowded.groupBy("node").agg(F.sum("members").alias("score"))
        hubs = crowded.join(score, "node").groupBy("key").agg(F.max(F.struct("score", "node", "n")).alias("hub"))
        return stage(crowded.join(hubs, "key").select("key", "node", "n", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"), "hub.score"), "buckets")

    def close(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` whose signatures are within the radius, with their distance."""
        signs = self.nodes.select("node", "sig")
        both = (pairs.join(signs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
                .join(signs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b"))
        return in_arrow(both, _distances, "a long, b long, distance int")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """The shingle sets of some nodes, read again from one text each."""
        needed = nodes.select("node").distinct().join(self.nodes.select("node", "k"), "node")
        texts = match(self.texts.select("k", "text"), needed, ["k"]).select("node", "text")
        return stage(in_arrow(texts, _sets(self.size), "node long, n long, set binary").dropDuplicates(["node"]), "sets")

    def links(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs whose full sets are similar enough."""
        sets = sets.select("node", "set")
        both = (pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
                .join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b"))
        return stage(in_arrow(both, _confirm(self.percent), "a long, b long"), "links")

    def components(self) -> DataFrame:
        """``(node, comp)`` for each node that is linked with another."""
        buckets = self.buckets()
        star = stage(buckets.where("node <> hub AND " + self.alike("n", "hub_n")).groupBy(F.col("node").alias("a"), F.col("hub").alias("b"))
                     .agg(F.max("score").alias("score")), "star")
        near = self.close(star.select("a", "b")).join(star, ["a", "b"]).groupBy("a").agg(
            F.min(F.struct("distance", "b")).alias("x"), F.max(F.struct("score", "b")).alias("y"))
        near = stage(near.select("a", "x.b", F.col("y.b").alias("lead")), "near")
        best = near.select("a", "b").union(near.select("a", "lead")).distinct()
        ends = best.select(F.col("a").alias("node")).union(best.select("b"))
        first = stage(components(self.links(best, self.sets(ends))), "first")
        open_nodes = self.open_nodes(buckets, first)
        if open_nodes.isEmpty():
            return first
        open_nodes = stage(self.promising(self.sets(open_nodes)), "promising")
        leads = near.select(F.col("a").alias("node"), "lead").join(open_nodes, "node")
        sets = self.sets(open_nodes.union(leads.select("lead")))
        more = self.links(self.close(self.sharing(sets.join(open_nodes, "node"), sets, first, leads)), sets)
        names = first.select(F.col("node").alias("x"), F.col("comp"))
        for end in ("a", "b"):  # links between the components found so far
            more = more.join(names.withColumnRenamed("x", end), end, "left").withColumn(
                end, F.coalesce("comp", end)).drop("comp")
        joined = stage(components(more), "joined").select(F.col("node").alias("comp"), F.col("comp").alias("into"))
        merged = first.join(joined, "comp", "left").select("node", F.coalesce("into", "comp").alias("comp"))
        alone = joined.join(first.select("comp").distinct(), "comp", "left_anti")
        return merged.unionByName(alone.select(F.col("comp").alias("node"), F.col("into").alias("comp")))

    def open_nodes(self, buckets: DataFrame, known: DataFrame) -> DataFrame:
        """The nodes that share a bucket with nodes of another component."""
        members = buckets.join(known, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
        members = stage(members, "members")
        mixed = members.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
        return stage(members.join(mixed.select("key"), "key").select("node").distinct(), "open")

    def promising(self, sets: DataFrame) -> DataFrame:
        """The nodes of ``sets`` that share enough of their lowest hashes with others of them.

        Sets that share s elements share at least k of those among their first n - s + k in order of hash.
        """
        each = in_arrow(sets.select("node", "n", "set"), _lowest(self.percent), "node long, n long, element long")
        common = each.groupBy("element").agg(F.count("*").alias("sets")).where("sets > 1").select("element")
        held = match(each, common, ["element"], "left_semi").groupBy("node", "n").agg(F.count("*").alias("held"))
        return held.where(f"held >= ({EXTRA} * (({self.percent} * n + 99) div 100) + 99) div 100").select("node")

    def sharing(self, rows: DataFrame, sets: DataFrame, known: DataFrame, leads: DataFrame) -> DataFrame:
        """The pairs of different components among ``rows`` that can still be similar enough.

        Positional prefix filter: with elements in order of rarity, two sets that overlap enough have a
        common element early in both, with enough elements after it. Between nodes of different leads
        the elements are the shingles. Nodes of one lead (a hub both were checked against) are mostly
        alike, so there the elements are those by which a node differs from the lead: two sets differ
        by no more than the similarity allows only if their differences share enough elements, and
        at least one where a node is not itself linked with the lead.
        """
        named = (rows.join(known, "node", "left").join(leads, "node", "left")
                 .select("node", "n", F.coalesce("comp", "node").alias("comp"), F.coalesce("lead", "node").alias("lead"), "set"))
        named = stage(named, "named")
        p = self.percent
        pair = f"x.element = y.element AND x.node < y.node AND x.comp <> y.comp AND {self.alike('x.n', 'y.n')}"
        whole = self.prefixes(in_arrow(named, _elements, _ELEMENTS), f"n - CAST(ceil({p} * n / 100) AS BIGINT) + 1")
        across = whole.alias("x").join(whole.alias("y"), F.expr(
            f"{pair} AND x.lead <> y.lead AND {100 + p} * least(x.rest, y.rest) >= {p} * (x.n + y.n)"))
        led = named.where("lead <> node").join(sets.select(F.col("node").alias("lead"), F.col("set").alias("lead_set")), "lead")
        differing = self.prefixes(in_arrow(led, _differences, _ELEMENTS), f"CAST(floor({100 - p} * n / {p}) AS BIGINT) + 1")
        within = differing.alias("x").join(differing.alias("y"), F.expr(
            f"{pair} AND x.lead = y.lead AND {100 + p} * (x.size + y.size - 2 * least(x.rest, y.rest)) <= {100 - p} * (x.n + y.n)"))
        return across.select("x.node", "y.node").union(within.select("x.node", "y.node")).toDF("b", "a").select("a", "b").distinct()

    def prefixes(self, each: DataFrame, length: str) -> DataFrame:
        """The first elements of each node's set in order of rarity, as far as ``length`` and without those
        no other node has (they come first and take up places); ``rest`` counts from the element on."""
        common = each.groupBy("group", "element").agg(F.count("*").alias("sets")).where("sets > 1")
        held = each.join(stage(common, "common"), ["group", "element"]).groupBy("node", "n", "comp", "lead", "size").agg(
            F.array_sort(F.collect_list(F.struct("sets", "element"))).alias("shared"))
        held = held.withColumn("left", F.expr(length) - F.col("size") + F.size("shared")).where("left > 0")
        return stage(held.select("node", "n", "comp", "lead", "size", F.size("shared").alias("all"),
                                 F.posexplode(F.slice("shared", F.lit(1), F.col("left").cast("int"))).alias("at", "s"))
                     .select("node", "n", "comp", "lead", "size", F.col("s.element").alias("element"), (F.col("all") - F.col("at")).alias("rest")), "prefix")


def near_groups(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``rows(rid, id, text)`` to ``(rid, id, n_shingles, component_id, keep_rid)``."""
    join = _Join(rows, shingle, percent)
    of_rep = join.rep_nodes.join(join.components(), "node", "left").select(
        "rep", F.coalesce("comp", "node").alias("comp"))
    firsts = join.signed.groupBy("rep").agg(F.min(first_id()).alias("first"))
    of_rep = firsts.join(of_rep, "rep", "left").select("rep", "first", F.coalesce("comp", "rep").alias("comp"))
    smallest = of_rep.groupBy("comp").agg(F.min("first").alias("keep"))
    named = of_rep.select("rep", "comp").join(smallest, "comp").select("rep", "keep")
    return join.signed.select("rid", "id", "n", "rep").join(named, "rep").select(
        "rid", "id", F.col("n").alias("n_shingles"), F.col("keep.id").alias("component_id"), F.col("keep.rid").alias("keep_rid"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
               percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles``, ``component_id`` (the smallest id of its
    group of near copies) and ``kept``."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), column(id_col).alias("id"), column(text_col).alias("text"))
    return near_groups(rows, shingle, percent).select(
        F.col("id").alias(id_col), "n_shingles", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.col("rid") == F.col("keep_rid")).alias("kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the first document of each group of near copies (5 words, 0.8), all columns."""
    rows = numbered(docs)
    groups = near_groups(rows.select("rid", F.col("row.doc_id").alias("id"), F.col("row.text").alias("text")), 5, 80)
    return without(rows, groups.where("rid <> keep_rid"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), shingle=3, percent=85)
