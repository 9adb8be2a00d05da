"""Operator 6, mixing sources to target weights by weighted fair queueing.

Each source's documents are put in a random but repeatable order (by hash of the id). A document
finishes at virtual time *words of its source up to and with it, divided by the source's target*;
a further pass over the source follows at once, up to ``max_passes``. All copies are sorted by
finish time over the whole cluster and the mix ends where the total budget is used up, so each
source gets its target to within a document or so.

No sum runs through one task: running sums are taken per hash bucket (within a source) or range
partition (over all), and the buckets' totals are added up separately. There are as many buckets as a
bucket has rows, about; one that an id in very many rows crowds is split by row number.

Nulls, ties and odd input: a null text has no words; sources are ordered by code point, null
last, and null is a source like any other; rows that repeat an id are separate documents and near
each other in their source's order; a very long text is one document like any other, taken or not; a source without words has target 0 and takes nothing; an
empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedkit.llm.common import WORD, column, match, numbered, stage, table

MAX_PASSES = 3
#: A hash bucket of a source with this many times the average's rows is split by row number.
CROWDED = 4
SEED = 6


def sized(rows: DataFrame) -> DataFrame:
    """``rows(rid, id, source, text)`` to ``(rid, id, source, size, place)``, written once."""
    return stage(rows.select(
        "rid", "id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("id", F.lit(SEED)).alias("place")), "sized")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_passes: int = MAX_PASSES) -> DataFrame:
    """``(source, source_size, target)``: weights repeat over the sources in order; a target stops at
    ``max_passes`` times its source, and what it leaves goes to the others by weight.

    With sources sorted by cap over weight, those below the water level are the ones that stop. The
    windows here run over one row per source, whatever the number of documents.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = each.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))))
    share = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    capped = ranked.select("source", "source_size", "rank", share.cast("double").alias("weight"),
                           (F.col("source_size") * max_passes).alias("cap"))
    by_fill = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    below, everything = by_fill.rowsBetween(W.unboundedPreceding, -1), W.orderBy(F.lit(0)).rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0)))
    # The level rises while the next source is still under water and falls from there on.
    filled = capped.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return filled.select("source", "source_size",
                         F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target"))


def mix_copies(sizes: DataFrame, goals: DataFrame, max_passes: int = MAX_PASSES) -> DataFrame:
    """``(rid, copies)``: how often the mix takes each row of ``sizes`` (0 included)."""
    spark = sizes.sparkSession
    total, rows = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    buckets = max(16, math.isqrt(rows))  # as many as each holds, about
    limit = max(16, CROWDED * rows // buckets)
    dealt = sizes.withColumn("bucket", F.pmod(F.shiftrightunsigned("place", 20), F.lit(buckets)))
    crowded = (dealt.groupBy("source", "bucket").agg(F.count("*").alias("rows")).where(f"rows > {limit}")  # of an id in very many rows
               .select(F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("key"), "bucket",
                       F.expr(f"rows div {max(1, limit // CROWDED)} + 1").alias("parts")))
    dealt = match(dealt.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))), crowded, ["key", "bucket"], "left")
    dealt = dealt.withColumn("part", F.coalesce(F.expr("pmod(xxhash64(rid), parts)"), F.lit(0)))
    in_order = W.partitionBy("source").orderBy("bucket", "part").rowsBetween(W.unboundedPreceding, -1)
    before = (dealt.groupBy("source", "bucket", "part").agg(F.sum("size").alias("words"))
              .withColumn("before", F.coalesce(F.sum("words").over(in_order), F.lit(0))).select("source", "bucket", "part", "before"))
    of_bucket = before.join(goals, before["source"].eqNullSafe(goals["source"])).select(before["source"], "bucket", "part", "before", "source_size", "target")
    queue = dealt.alias("d").join(of_bucket.alias("b"), F.expr("d.source <=> b.source AND d.bucket = b.bucket AND d.part = b.part"))
    within = W.partitionBy("d.source", "d.bucket", "d.part").orderBy("d.place", "d.id", "d.rid").rowsBetween(W.unboundedPreceding, 0)
    queue = queue.select("d.rid", "d.source", "d.size", "d.place", "source_size", "target",
                         (F.col("before") + F.sum("d.size").over(within)).alias("upto"))
    copies = queue.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max_passes - 1)))).select(
        "rid", "size", ((F.col("pass") * F.col("source_size") + F.col("upto")) / F.nullif("target", F.lit(0.0))).alias("finish"))
    order = ["finish", "rid"]
    queue = stage(copies.where("finish IS NOT NULL").repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("part", F.spark_partition_id()), "queue")
    parts = queue.groupBy("part").agg(F.sum("size").alias("words"))  # one row per range partition
    parts = parts.withColumn("ahead", F.coalesce(F.sum("words").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    parts = stage(parts, "parts")
    whole = queue.join(parts.where(f"ahead + words <= {total}").select("part"), "part", "left_semi").select("rid")
    split = queue.join(parts.where(f"ahead <= {total} AND ahead + words > {total}").select("part", "ahead"), "part")
    running = F.col("ahead") + F.sum("size").over(W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    taken = whole.unionByName(split.withColumn("upto", running).where(f"upto <= {total}").select("rid"))
    counted = taken.groupBy("rid").agg(F.count("*").alias("copies"))
    return sizes.select("rid").join(counted, "rid", "left").select("rid", F.coalesce("copies", F.lit(0)).alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """One row per row of ``docs``: its id, ``size`` in words, ``source_size``, ``target`` and ``taken`` words."""
    rows = numbered(docs.select(column(id_col).alias("id"), column(source_col).alias("source"), column(text_col).alias("text")))
    sizes = sized(rows.select("rid", "row.id", "row.source", "row.text"))
    goals = stage(targets(sizes, weights), "targets")
    rows = sizes.join(mix_copies(sizes, goals), "rid").alias("r")
    return rows.join(goals.alias("g"), F.expr("r.source <=> g.source")).select(
        F.col("r.id").alias(id_col), "r.size", "g.source_size", "g.target", (F.col("r.size") * F.col("r.copies")).alias("taken"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it, all columns."""
    rows = numbered(docs)
    sizes = sized(rows.select("rid", F.col("row.doc_id").alias("id"), F.col("row.source").alias("source"),
                              F.col("row.text").alias("text")))
    copies = mix_copies(sizes, stage(targets(sizes), "targets")).where("copies > 0")
    return match(rows, copies, ["rid"]).select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
