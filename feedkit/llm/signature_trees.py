"""Operator 13, n-gram Jaccard join by signature trees.

Texts with one set of word shingles are one node. A node's signature is a bitmap of its shingles, eight
bits wide for each (a power of two, so that a bitmap folds to half its width). Nodes that may have a
partner are gathered in trees. An inner tree node holds the OR of its children's bitmaps and the range
of their sizes. Two subtrees are traversed together from the top. Two members have at most *bits set in
both, plus the bits' most repeated use in one of them* shingles in common, so a pair of tree nodes goes
no further where that, with the least sizes, cannot reach the similarity; nor where the sizes are too
far apart, or all members are in one component already. Pairs of leaves that are left are confirmed on
full sets.

Which nodes meet in a tree is decided exactly, in the steps of a prefix filter:

* Each set's lowest hashes, enough of them that two similar sets share ``EXTRA`` percent of their size
  there, are counted over the corpus; a node that has too few in common with any other node has no
  partner (most texts end here, at a third of their shingles).
* The full sets of the others are counted; a node needs as many shared shingles as the similarity
  asks. Its rarest ones, one more than may be missing, are its tokens: similar sets share a token.
* A token's hub is the node whose tokens are the most crowded. All nodes that share a hub's tokens
  make a tree. Each is first checked against two of its hubs, so a family of copies is one component
  before the trees are looked at, and costs a row per member instead of one per pair.

Both counts shuffle the hashes once, with the nodes that have them, and count them where they arrive. Before
that the hashes of a block of nodes are put together, so one that is in every text is a row per block.

In a tree, the members of its largest component (``major``) are compared with the others (``minor``)
but not with one another. Trees over ``PIECE_BYTES`` of bitmaps are cut into pieces by hash of the
node and their pieces dealt out in pairs, so no tree has to fit in a task. Shingles are compared as
64-bit hashes (two different shingles of one pair agree with a chance around 1e-12).

Nulls, ties and odd input: a null text, or one without words, has an empty set and is linked with
nothing; a text shorter than a shingle has its word sequence as its only shingle; a very long text
counts whole; repeated rows are members of one node; rows without an id count last when the smallest
id is taken (a group of only such rows has a null component); an empty table gives an empty result;
other columns are never looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.llm.common import StagingScope, column, first_id, in_arrow, match, stage, table
from feedkit.llm.graph import components
from feedkit.llm.near_dedup import _WordHashes, shingle_hashes

SHINGLE, PERCENT = 4, 85
EXTRA = 15
FAN = 8
#: Bitmaps are at least 2^``NARROW`` bits wide.
NARROW = 9
PIECE_BYTES = 32_000_000
#: Hashes that are put together by value before they are shuffled.
BLOCK = 500_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def needed(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` must share with a similar one."""
    return -(-percent * n // 100)


def _folder(size: int, percent: int, schema: pa.Schema):
    def fold(batches):
        hashes, seen = _WordHashes(), {}
        for batch in batches:
            reps, counts, sets, lows = [], [], [], []
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("text"), strict=True):
                shingles = shingle_hashes(text.as_py(), size, hashes)
                n = len(shingles)
                counts.append(n)
                mark = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if n else None
                new = mark is not None and mark not in seen
                if new:
                    seen[mark] = rid
                reps.append(seen.get(mark, rid))
                sets.append(mark if new else None)
                lows.append(shingles[:n - needed(n, percent) + needed(n, EXTRA)].view(np.int64) if new else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("rid", "id", "k")), pa.array(reps, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(sets, pa.binary()), pa.array(lows, pa.list_(pa.int64()))], schema=schema)

    return fold


def _blocks(batches, name: str, block: int):
    """``(node, hash)``, two arrays: the hashes of whole nodes, ``block`` or a little more at a time."""
    nodes, hashes, held = [], [], 0
    for batch in batches:
        for node, value in zip(batch.column("node").to_pylist(), batch.column(name), strict=True):
            own = np.frombuffer(value.as_py(), np.int64) if name == "set" else value.values.to_numpy()
            nodes.append(np.full(len(own), node, np.int64)), hashes.append(own)
            held += len(own)
            if held >= block:
                yield np.concatenate(nodes), np.concatenate(hashes)
                nodes, hashes, held = [], [], 0
    if held:
        yield np.concatenate(nodes), np.concatenate(hashes)


def _lowest(block: int):
    """``(element, node, known)``, ``known`` 0 for a hash that one node of a block has.

    Hashes that several have are shared already. They stand once (-1), and each node has a row under a
    key of its own that tells how many it has. So a hash that is in every text is a row per block.
    """
    def count(batches):
        for node, flat in _blocks(batches, "low", block):
            element, first, inverse, sets = np.unique(flat, return_index=True, return_inverse=True, return_counts=True)
            owner, known = np.unique(node[sets[inverse] > 1], return_counts=True)
            key = (owner.astype(np.uint64) * _MIX).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([element, key])), pa.array(np.concatenate([node[first], owner])),
                 pa.array(np.concatenate([np.where(sets > 1, -1, 0), known]).astype(np.int32))], names=["element", "node", "known"])

    return count


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


def _elements(block: int):
    """``(element, nodes)``: a hash and the nodes of a block that have it."""
    def gather(batches):
        for node, flat in _blocks(batches, "set", block):
            order = np.argsort(flat, kind="stable")
            flat = flat[order]
            starts = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
            nodes = pa.ListArray.from_arrays(pa.array(np.append(starts, len(flat)).astype(np.int32)), pa.array(node[order]))
            yield pa.RecordBatch.from_arrays([pa.array(flat[starts]), nodes], names=["element", "nodes"])

    return gather


def bitmap(shingles: np.ndarray, width: int) -> bytes:
    """``2 ** width`` bits, each shingle's by the lowest bits of its hash."""
    bits = np.zeros(1 << width, np.uint8)
    bits[shingles & np.uint64((1 << width) - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _mapper(batches):
    for batch in batches:
        maps = [bitmap(np.frombuffer(s, np.uint64), w) for s, w in zip(batch.column("set").to_pylist(), batch.column("width").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(maps, pa.binary())], names=["node", "bits"])


class Tree:
    """Levels of tree nodes over rows, from the rows themselves up to at most ``FAN`` nodes."""

    def __init__(self, bits: np.ndarray, n: np.ndarray, comp: np.ndarray, side: np.ndarray) -> None:
        slack = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        #: bitmaps, least and greatest size, most repeated use of bits, and ranges of component and side
        self.levels = [(bits, n, n, slack, comp, comp, side, side)]
        lower = [np.minimum, np.maximum, np.maximum, np.minimum, np.maximum, np.minimum, np.maximum]
        while len(self.levels[-1][0]) > FAN:
            below = self.levels[-1]
            starts = np.arange(0, len(below[0]), FAN)
            self.levels.append((np.bitwise_or.reduceat(below[0], starts, axis=0),
                                *(f.reduceat(x, starts) for f, x in zip(lower, below[1:], strict=True))))

    def pairs(self, percent: int):
        """``(i, j, bits in common)`` of the pairs of rows that can be similar, in blocks: rows of one component
        are not paired, nor are those of one side where there are two."""
        side = self.levels[0][6]
        cross = len(side) > 0 and side.min() != side.max()
        top = len(self.levels) - 1
        open_ = [(top, *np.triu_indices(len(self.levels[top][0])))]
        while open_:
            level, i, j = open_.pop()
            words = self.levels[level][0].shape[1]
            most = max(64, 2_000_000 // words)
            if len(i) > most:
                open_ += [(level, i[s:s + most], j[s:s + most]) for s in range(0, len(i), most)]
                continue
            bits, least, great, slack, first, last, left, right = self.levels[level]
            kept = (100 * great[i] >= percent * least[j]) & (100 * great[j] >= percent * least[i])
            kept &= (np.maximum(last[i], last[j]) != np.minimum(first[i], first[j]))
            if cross:
                kept &= np.maximum(right[i], right[j]) != np.minimum(left[i], left[j])
            if level == 0:
                kept &= i != j
            i, j = i[kept], j[kept]
            common = np.bitwise_count(bits[i] & bits[j]).sum(axis=1, dtype=np.int64)
            overlap = np.minimum(np.minimum(great[i], great[j]), common + np.minimum(slack[i], slack[j]))
            kept = (100 + percent) * overlap >= percent * (least[i] + least[j])
            i, j, common = i[kept], j[kept], common[kept]
            if level == 0:
                yield i, j, common
            elif len(i):
                below = len(self.levels[level - 1][0])
                steps = np.arange(FAN)
                a = np.repeat(i * FAN, FAN * FAN) + np.tile(np.repeat(steps, FAN), len(i))
                b = np.repeat(j * FAN, FAN * FAN) + np.tile(steps, FAN * len(i))
                real = (a < below) & (b < below) & ((np.repeat(i != j, FAN * FAN)) | (a <= b))
                open_.append((level - 1, a[real], b[real]))


_ITEM = "item string, width int, node long, n long, comp long, side int, visitor boolean, bits binary"


def _fold(bits: bytes, width: int) -> np.ndarray:
    words = np.frombuffer(bits, np.uint64)
    while len(words) * 64 > 1 << width:
        words = words[:len(words) // 2] | words[len(words) // 2:]
    return words


def _traverser(percent: int):
    def matches(rows: pa.Table):
        node, n, comp, side = (rows.column(c).to_numpy() for c in ("node", "n", "comp", "side"))
        if comp.min() == comp.max():
            return
        order = np.lexsort((node, n, comp, side))
        width = rows.column("width")[0].as_py()
        bits = np.stack([_fold(b, width) for b in rows.column("bits").to_pylist()])[order]
        visitor = rows.column("visitor").to_numpy(zero_copy_only=False)[order]
        node, n, comp, side = node[order], n[order], comp[order], side[order].astype(np.int64)
        for i, j, common in Tree(bits, n, comp, side).pairs(percent):
            kept = ~(visitor[i] & visitor[j])  # two of the wider ones meet in the tree of their own width
            i, j = i[kept], j[kept]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (node[i], node[j], comp[i], comp[j], common[kept])],
                                             names=["a", "b", "comp_a", "comp_b", "common"])

    def traverse(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            items = batch.column("item").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(items[1:] != items[:-1]) + 1).tolist(), len(batch)]
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                if start == end:
                    continue
                if held and held[-1].column("item")[0].as_py() != items[start]:
                    yield from matches(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(start, end - start))
        if held:
            yield from matches(pa.Table.from_batches(held))

    return traverse


def _confirmer(percent: int):
    def confirm(batches):
        for batch in batches:
            links = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (a, b))
                common = len(np.intersect1d(x, y, assume_unique=True))
                links.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(links, pa.bool_()))

    return confirm


def _width(n: Column) -> Column:
    """Binary digits of 8n - 1: the power of two that holds eight bits a shingle."""
    return F.greatest(F.length(F.bin(8 * n - 1)), F.lit(NARROW))


def _renamed(links: DataFrame, names: DataFrame) -> DataFrame:
    """Links between nodes as links between their components."""
    for end in ("a", "b"):
        of_end = names.select(F.col("node").alias(end), "comp")
        links = links.join(of_end, end, "left").withColumn(end, F.coalesce("comp", end)).drop("comp")
    return links.where("a <> b").distinct()


def _merged(names: DataFrame, joined: DataFrame) -> DataFrame:
    """``names(node, comp)`` after ``joined(node, comp)`` has put components, or nodes without one, together."""
    joined = joined.select(F.col("node").alias("old"), F.col("comp").alias("into"))
    of_named = names.join(joined, names["comp"] == joined["old"], "left").select("node", F.coalesce("into", "comp").alias("comp"))
    alone = joined.join(names.select(F.col("comp").alias("old")).distinct(), "old", "left_anti")
    return of_named.unionByName(alone.select(F.col("old").alias("node"), F.col("into").alias("comp")))


class SignatureJoin:
    """The tables of one join and the steps over them."""

    def __init__(self, rows: DataFrame, size: int, percent: int, piece_bytes: int = PIECE_BYTES, block: int = BLOCK) -> None:
        from pyspark.sql.pandas.types import to_arrow_schema

        self.size, self.percent, self.piece_bytes, self.block = size, percent, piece_bytes, block
        self.need = f"({percent} * n + 99) div 100"
        self.texts = rows.select("rid", "id", F.xxhash64("id", "text").alias("k"), "text")
        schema = T.StructType([T.StructField("rid", T.LongType()), rows.schema["id"],
                               *T.StructType.fromDDL("k long, rep long, n long, mark binary, low array<long>")])
        with StagingScope(rows.sparkSession) as scope:  # the lowest hashes, most of what is written, go with it
            read = stage(in_arrow(self.texts, _folder(size, percent, to_arrow_schema(schema)), schema), "read")
            #: One row per row of the input; copies within a split share ``rep``.
            self.folded = scope.keep(read.drop("low"), "folded")
            reps = self.folded.where("mark IS NOT NULL").select("rep", "k", "n", "mark")
            self.nodes = scope.keep(reps.groupBy("mark").agg(F.min_by(F.struct("rep", "k", "n"), "rep").alias("x"))
                                    .select("mark", F.col("x.rep").alias("node"), "x.k", "x.n"), "nodes")
            lows = read.where("mark IS NOT NULL").select(F.col("rep").alias("node"), "low")
            copies = reps.select(F.col("rep").alias("node")).join(self.nodes, "node", "left_anti")  # of other splits' sets
            #: ``(node, k, n)`` of the nodes that may have a partner.
            self.candidates = scope.keep(self.with_partner(match(lows, copies, ["node"], "left_anti")), "candidates")
        self.rep_nodes = reps.select("rep", "mark").join(self.nodes.select("mark", "node"), "mark").select("rep", "node")

    def with_partner(self, lows: DataFrame) -> DataFrame:
        """``(node, k, n)`` of the nodes that share enough of their lowest hashes, ``lows(node, low)``, with others."""
        each = in_arrow(lows, _lowest(self.block), "element long, node long, known int")
        sets = F.sum(F.when(F.col("known") == 0, 1).otherwise(2)).over(W.partitionBy("element"))  # shuffled once, counted in place
        held = each.withColumn("sets", sets).where("sets > 1 AND known >= 0").groupBy("node").agg(
            F.sum(F.greatest("known", F.lit(1))).alias("held"))
        return self.nodes.select("node", "k", "n").join(held, "node").where(
            f"held >= ({EXTRA} * ({self.need}) + 99) div 100").select("node", "k", "n")

    def sets(self, nodes: DataFrame) -> DataFrame:
        """``(node, n, set)``: the shingle sets, read again from one text each."""
        texts = match(self.texts.select("k", "text"), nodes.select("k", "node"), ["k"]).select("node", "text")
        return stage(in_arrow(texts, _sets(self.size), "node long, n long, set binary").dropDuplicates(["node"]), "sets")

    def tokens(self, sets: DataFrame) -> DataFrame:
        """``(token, node, n)``: each node's rarest shared shingles, one more than a similar set may lack."""
        each = in_arrow(sets, _elements(self.block), "element long, nodes array<long>")
        each = each.withColumn("sets", F.sum(F.size("nodes")).over(W.partitionBy("element"))).where("sets > 1")
        node = W.partitionBy("node")
        held = each.select(F.explode("nodes").alias("node"), "sets", "element").join(self.candidates.select("node", "n"), "node")
        held = held.withColumn("shared", F.count("*").over(node)).where(f"shared >= {self.need}").withColumn(
            "place", F.row_number().over(node.orderBy("sets", "element"))).where(f"place <= shared - ({self.need}) + 1")
        with StagingScope(sets.sparkSession) as scope:
            each = stage(held.select(F.col("element").alias("token"), "node", "n"), "tokens")
            several = each.groupBy("token").agg(F.count("*").alias("members")).where("members > 1")
            return scope.keep(match(each, several, ["token"]), "shared")

    def regions(self, tokens: DataFrame) -> DataFrame:
        """``(hub, hub_n, score, node, n, votes)``: the nodes that have tokens of a hub, the hub with them."""
        score = tokens.groupBy("node").agg(F.sum("members").alias("score"))
        hubs = tokens.join(score, "node").groupBy("token").agg(F.max(F.struct("score", "node", "n")).alias("hub"))
        hubs = hubs.select("token", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.score").alias("score"))
        return match(tokens, hubs, ["token"]).groupBy("hub", "hub_n", "score", "node", "n").agg(F.count("*").alias("votes"))

    def links(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs whose full sets are similar enough."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        sets = match(sets.select("node", "set"), ends, ["node"], "left_semi")  # before they are shuffled
        both = (pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
                .join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b"))
        return stage(in_arrow(both, _confirmer(self.percent), "a long, b long"), "links")

    def items(self, regions: DataFrame, names: DataFrame, sets: DataFrame) -> DataFrame:
        """The trees, cut into pieces: a row per node and pair of pieces it takes part in, with its bitmap."""
        rows = regions.join(names, "node", "left").select("hub", "node", "n", F.coalesce("comp", "node").alias("comp"))
        own = rows.withColumn("width", _width(F.col("n"))).withColumn("lowest", _width(F.expr(self.need)))
        # sizes of similar sets are at most one width apart; the wider one also takes part folded
        rows = own.withColumn("width", F.explode(F.expr("sequence(lowest, width)"))).withColumn(
            "visitor", F.col("width") < _width(F.col("n"))).drop("lowest")
        by_comp = rows.groupBy("hub", "width", "comp").agg(F.count("*").alias("members"))
        trees = by_comp.groupBy("hub", "width").agg(F.max(F.struct("members", "comp")).alias("major"), F.sum("members").alias("members"),
                                                    F.count("*").alias("comps")).where("comps > 1")
        piece = F.greatest(F.lit(2), (F.lit(8.0 * self.piece_bytes) / F.pow(F.lit(2.0), F.col("width"))).cast("long"))
        cut = lambda members: F.ceil(members / piece).cast("int")
        trees = stage(trees.select("hub", "width", F.col("major.comp").alias("major"), cut(F.col("members") - F.col("major.members")).alias("minors"),
                                   cut(F.col("major.members")).alias("majors")), "trees")
        rows = rows.join(trees, ["hub", "width"]).withColumn("is_major", F.expr("comp = major"))
        rows = rows.withColumn("at", F.expr("CAST(pmod(xxhash64(node), IF(is_major, majors, minors)) AS INT)"))
        others = F.expr("""IF(is_major, transform(sequence(0, minors - 1), q -> named_struct('kind', 1, 'i', q, 'j', at, 'side', 1)),
            concat(transform(sequence(0, minors - 1), q -> named_struct('kind', 0, 'i', least(at, q), 'j', greatest(at, q), 'side', CAST(at > q AS INT))),
                   transform(sequence(0, majors - 1), q -> named_struct('kind', 1, 'i', at, 'j', q, 'side', 0))))""")
        rows = rows.withColumn("to", F.explode(others)).select(
            F.concat_ws("/", "hub", "width", "to.kind", "to.i", "to.j").alias("item"), "width", "node", "n", "comp", "to.side", "visitor")
        wanted = sets.join(rows.select("node").distinct(), "node").select("node", "set", _width(F.col("n")).alias("width"))
        maps = in_arrow(wanted, _mapper, "node long, bits binary")
        return rows.join(maps, "node").select("item", "width", "node", "n", "comp", "side", "visitor", "bits")

    def components(self) -> DataFrame:
        """``(node, comp)`` of each node that is linked with another."""
        sets = self.sets(self.candidates)
        with StagingScope(sets.sparkSession) as scope:
            regions = scope.keep(self.regions(self.tokens(sets)), "regions")
        p = self.percent
        star = regions.where(f"node <> hub AND 100 * least(n, hub_n) >= {p} * greatest(n, hub_n)").groupBy("node").agg(
            F.max(F.struct("votes", "hub")).alias("x"), F.max(F.struct("score", "hub")).alias("y"))
        star = stage(star.select("node", F.col("x.hub").alias("x"), F.col("y.hub").alias("y")), "star")
        pairs = star.select(F.col("node").alias("a"), F.col("x").alias("b")).union(star.select("node", "y")).distinct()
        names = stage(components(self.links(pairs, sets)), "names")
        rows = self.items(regions, names, sets).repartition("item").sortWithinPartitions("item")
        found = in_arrow(rows, _traverser(p), "a long, b long, comp_a long, comp_b long, common long")
        found = stage(found.groupBy("a", "b", "comp_a", "comp_b").agg(F.max("common").alias("common")), "found")
        # a node's most promising pair with each other component first, the rest where that was not enough
        best = stage(found.groupBy("a", "comp_b").agg(F.max(F.struct("common", "b")).alias("x")).select("a", F.col("x.b").alias("b")), "best")
        names = stage(_merged(names, components(_renamed(self.links(best, sets), names))), "names")
        rest = found.select("a", "b").join(best, ["a", "b"], "left_anti")
        for end in ("a", "b"):
            rest = rest.join(names.select(F.col("node").alias(end), F.col("comp").alias(f"of_{end}")), end, "left")
        rest = stage(rest.where("coalesce(of_a, a) <> coalesce(of_b, b)").select("a", "b"), "rest")
        return stage(_merged(names, components(_renamed(self.links(rest, sets), names))), "components")


def join_groups(rows: DataFrame, size: int, percent: int, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``rows(rid, id, text)`` to ``(rid, id, n_shingles, component_id)``."""
    join = SignatureJoin(rows, size, percent, piece_bytes)
    firsts = join.folded.groupBy("rep").agg(F.min(first_id()).alias("first"))
    named = firsts.join(join.rep_nodes, "rep", "left").join(join.components(), "node", "left").select(
        "rep", "first", F.coalesce("comp", "node", "rep").alias("comp"))
    smallest = named.groupBy("comp").agg(F.min("first").alias("keep"))
    named = named.select("rep", "comp").join(smallest, "comp").select("rep", F.col("keep.id").alias("component_id"))
    return join.folded.select("rid", "id", "n", "rep").join(named, "rep").select("rid", "id", F.col("n").alias("n_shingles"), "component_id")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80,
                 piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles`` and ``component_id``, the smallest id that links lead to."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), column(id_col).alias("id"), column(text_col).alias("text"))
    return join_groups(rows, size, percent, piece_bytes).select(F.col("id").alias(id_col), "n_shingles", "component_id")


def op13_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"), size=SHINGLE, percent=PERCENT)
