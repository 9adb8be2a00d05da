"""Operator 2, quality rules with host-level verdicts (DataFrame functions only).

Each document is measured and tested against a few rules. The rule failures of a host's documents
are counted and each host's failure rate is shrunk towards the corpus by a beta prior. Its two
parameters are estimated by beta-binomial moments: the hosts' rates, weighted by their documents, spread
by chance as well as by kind, and only what exceeds chance counts. So a host with three documents is
not judged by them alone. The verdicts go back to the documents:

* ``ok``: only the base rule counts;
* ``strict`` (shrunken rate of ``strict_rate`` or more): a document that fails any rule goes;
* ``reject`` (``reject_rate`` or more): all documents of the host go.

A clean document on a host of mixed quality therefore stays.

Nulls, ties and odd input: a null text has no words and fails the base rule; rows without a host
form one host; repeated rows count each; an empty table gives an empty result; very long texts
are measured whole, inside their row; other columns cannot clash, as only the three named ones
are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.llm.common import SPACE, WORD, column, numbered, stage, table, without

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_SYMBOL_PERCENT = 10  # symbols to words
MAX_DUP_LINE_PERCENT = 30
STRICT_RATE, REJECT_RATE = 0.5, 0.9
#: Documents the prior is worth where hosts do not differ.
MOST_PRIOR = 1000000


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for the row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pairs(hashes: Column, apart: int) -> Column:
    """The hash of each element with the one ``apart`` places on; shorter by as many."""
    return _let(hashes, lambda h: F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - apart, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(h, i + apart))))


def repeated_words(words: Column) -> Column:
    """Words that lie in an eight-word window found twice or more in the same text.

    Windows are compared by 64-bit hashes, built by doubling. Only a text with equal windows pays
    for sorting them; positions of equal windows then cover up to eight words each.
    """
    windows = _pairs(_pairs(_pairs(F.transform(words, lambda w: F.xxhash64(w)), 1), 2), 4)

    def positions(w: Column) -> Column:
        in_order = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("hash"), i.alias("at"))))
        equal = lambda x, y: x["hash"] == y["hash"]
        found = _let(in_order, lambda s: F.transform(s, lambda x, i: F.when(
            equal(x, F.get(s, i - 1)) | equal(x, F.get(s, i + 1)), x["at"])))
        return F.array_sort(F.filter(found, lambda at: at.isNotNull()))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long"))
                .otherwise(_let(positions(w), covered)))


def measured(rows: DataFrame) -> DataFrame:
    """``rows(rid, id, host, text)`` with the text replaced by its measures and rule verdicts."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    counts = rows.select(
        "rid", "id", "host",
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
        _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeat"))).alias("words"))
    return counts.select(
        "rid", "id", "host", F.col("words.n").alias("n_words"), "word_chars", "n_symbols",
        F.col("lines.dup").alias("n_dup_lines"), F.col("words.repeat").alias("n_repeat_words"),
        F.expr(f"words.n < {MIN_WORDS} OR 100 * words.repeat > {MAX_REPEAT_PERCENT} * words.n").alias("base_failed"),
        F.expr(f"100 * n_symbols > {MAX_SYMBOL_PERCENT} * words.n").alias("symbols_failed"),
        F.expr(f"100 * lines.dup > {MAX_DUP_LINE_PERCENT} * lines.n").alias("lines_failed"),
    ).withColumn("any_failed", F.expr("base_failed OR symbols_failed OR lines_failed"))


def host_verdicts(docs: DataFrame, strict_rate: float = STRICT_RATE, reject_rate: float = REJECT_RATE) -> DataFrame:
    """``(host, n_docs, n_failed, host_rate, verdict)`` from measured documents.

    With k hosts, N documents, m of them failed (mean p), and S the sum of n (rate - p)^2, chance alone
    makes S about p(1-p)(k-1); a correlation r of a host's documents adds r (N - k + 1 - sum(n^2) / N) of
    p(1-p). The prior is worth 1/r - 1 documents, never fewer than one. Where hosts spread no more than by
    chance, or their sizes cannot tell (all of one document, or one host), it is a fixed large number.
    """
    hosts = docs.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("any_failed").cast("long")).alias("n_failed"))
    prior = hosts.agg(F.count("*").alias("k"), F.sum("n_docs").alias("n"), F.sum("n_failed").alias("m"),
                      F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("squares"),
                      F.sum(F.col("n_failed").cast("double") * F.col("n_failed") / F.col("n_docs")).alias("rates"))
    prior = prior.select("k", "n", "squares", (F.col("m") / F.col("n")).alias("mean"), F.expr("rates - CAST(m AS DOUBLE) * m / n").alias("spread"))
    chance, room = "mean * (1 - mean)", "(n - k + 1 - squares / n)"
    prior = prior.withColumn("r", F.expr(f"CASE WHEN {chance} > 0 AND {room} > 0.000001 THEN (spread / ({chance}) - (k - 1)) / {room} END"))
    prior = prior.select(F.struct("mean", F.expr(f"CASE WHEN r > 1 / ({MOST_PRIOR} + 1D) THEN greatest(1D, 1 / r - 1) ELSE {MOST_PRIOR}D END").alias("weight")).alias("p"))
    shrunk = hosts.withColumn("p", prior.scalar()).withColumn(
        "host_rate", (F.col("n_failed") + F.col("p.mean") * F.col("p.weight")) / (F.col("n_docs") + F.col("p.weight")))
    return shrunk.select("host", "n_docs", "n_failed", "host_rate", F.when(F.col("host_rate") >= reject_rate, "reject")
                         .when(F.col("host_rate") >= strict_rate, "strict").otherwise("ok").alias("verdict"))


def judged(rows: DataFrame, strict_rate: float = STRICT_RATE, reject_rate: float = REJECT_RATE) -> DataFrame:
    """``rows(rid, id, host, text)`` to their measures, the host's rate and verdict, and ``kept``.

    The measures are written once, without the texts; the table of hosts is written too, so Spark
    knows its size when it chooses how to join.
    """
    docs = stage(measured(rows), "measured")
    hosts = stage(host_verdicts(docs, strict_rate, reject_rate), "hosts")
    return docs.alias("d").join(hosts.alias("h"), F.expr("d.host <=> h.host"), "left").select(
        "d.*", F.round("host_rate", 9).alias("host_rate"), "verdict",
        F.expr("NOT base_failed AND verdict <> 'reject' AND NOT (verdict = 'strict' AND any_failed)").alias("kept"))


def host_rules(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, measures, rule verdicts, the host's shrunken rate and ``kept``."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), column(id_col).alias("id"),
                       column(host_col).alias("host"), column(text_col).alias("text"))
    return judged(rows).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "symbols_failed", "lines_failed", "host_rate", F.col("verdict").alias("host_verdict"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents the rules keep, all columns."""
    rows = numbered(docs)
    verdicts = judged(rows.select("rid", F.col("row.doc_id").alias("id"), F.col("row.source").alias("host"),
                                  F.col("row.text").alias("text")))
    return without(rows, verdicts.where("NOT kept"))


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules(table(spark, sf_dir, "documents"))


SQL = r"""
WITH w AS (
    SELECT doc_id, source, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS all_lines,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
windows AS (
    SELECT doc_id, i, list_slice(words, i, i + 7) AS win
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows),
repeats AS (
    SELECT doc_id, sum(least(coalesce(lead - i, 8), 8)) AS n_repeat
    FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS lead FROM twice WHERE n > 1) GROUP BY doc_id),
m AS (
    SELECT doc_id, source, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           list_filter(all_lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN repeats USING (doc_id)),
r AS (
    SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, 100 * n_symbols > 10 * n_words AS symbols_failed
    FROM m),
f AS (SELECT *, 100 * n_dup_lines > 30 * len(lines) AS lines_failed FROM r),
h AS (
    SELECT source, count(*) AS n_docs, sum((base_failed OR symbols_failed OR lines_failed)::INT) AS n_failed FROM f GROUP BY source),
p AS (
    SELECT count(*) AS k, sum(n_docs)::DOUBLE AS n, sum(n_failed)::DOUBLE / sum(n_docs) AS mean, sum(n_docs::DOUBLE * n_docs) AS squares,
           sum(n_failed::DOUBLE * n_failed / n_docs) - sum(n_failed)::DOUBLE * sum(n_failed) / sum(n_docs) AS spread FROM h),
q AS (
    SELECT mean, CASE WHEN mean * (1 - mean) > 0 AND n - k + 1 - squares / n > 0.000001
                      THEN (spread / (mean * (1 - mean)) - (k - 1)) / (n - k + 1 - squares / n) END AS r FROM p),
k AS (SELECT mean, CASE WHEN r > 1 / 1000001.0 THEN greatest(1.0, 1 / r - 1) ELSE 1e6 END AS weight FROM q),
v AS (
    SELECT source, (n_failed + mean * weight) / (n_docs + weight) AS host_rate FROM h, k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND host_rate < 0.9 AND NOT (host_rate >= 0.5 AND (symbols_failed OR lines_failed)) AS kept,
       symbols_failed, lines_failed, round(host_rate, 9) AS host_rate,
       CASE WHEN host_rate >= 0.9 THEN 'reject' WHEN host_rate >= 0.5 THEN 'strict' ELSE 'ok' END AS host_verdict
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""
