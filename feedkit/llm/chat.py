"""Operator 4, chat formatting with prefix-target expansion (DataFrame functions only).

Each turn becomes ``<|im_start|>role, line end, text, <|im_end|>, line end``. Each assistant turn
becomes an example of its own: all turns before it as context, then the reply, of which only the
text is trainable (``loss_start`` to ``loss_end``, code points). Where turns follow the last reply,
one more example holds the whole conversation with nothing to train, so no turn is lost.

Control strings inside texts are escaped reversibly: a backslash becomes ``\\0``, ``<|`` becomes
``<\\1``, and the other templates' markers get ``\\2`` after their first character; a line end in a
role becomes ``\\3``. Offsets come from running sums of the turns' lengths. Only the last example
of a conversation is kept whole when conversations are read back.

An example repeats its context, so the text written grows with the square of a conversation's
turns; that is the method's own output. It is made row by row and never gathered.

Nulls, ties and odd input: a null text or role counts as empty; turns are ordered by turn, then
role, then text, nulls first; repeated turns all stay; nothing joins rows without a conversation, so
each is one of its own (told apart by ``lone``, null for the others); a conversation without an assistant gives one example without a target; an empty table gives an
empty result; other columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedkit.llm.common import column, table

START, STOP = "<|im_start|>", "<|im_end|>"
TARGET_ROLE = "assistant"
# Markers of other common chat templates.
MARKERS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]


def _replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escaped(text: Column) -> Column:
    return _replaced(text, [("\\", "\\0"), ("<|", "<\\1"), *((m, f"{m[0]}\\2{m[1:]}") for m in MARKERS)])


def unescaped(text: Column) -> Column:
    return _replaced(text, [("\\3", "\n"), ("\\2", ""), ("\\1", "|"), ("\\0", "\\")])


def prefix_examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text") -> DataFrame:
    """``(conv_id, lone, example, last, text, loss_start, loss_end)``: one row per assistant turn, and one
    without a span where turns follow the last reply."""
    rows = turns.select(column(conv_col).alias("conv_id"), F.when(column(conv_col).isNull(), F.monotonically_increasing_id()).alias("lone"),
                        column(turn_col).alias("turn"),
                        F.coalesce(column(role_col), F.lit("")).alias("role"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    head = F.concat(F.lit(START), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\3")), F.lit("\n"))
    tail = STOP + "\n"
    rows = rows.select("conv_id", "lone", "turn", "role", "text", head.alias("head"), escaped(F.col("text")).alias("body"))
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(tail)))
    in_order = W.partitionBy("conv_id", "lone").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.length("piece")).over(in_order))
    stop = F.col("end") - len(tail)
    turn = F.struct("end", "piece", F.when(F.col("role") == TARGET_ROLE, stop - F.length("body")).alias("loss_start"),
                    F.when(F.col("role") == TARGET_ROLE, stop).alias("loss_end"))
    convs = rows.groupBy("conv_id", "lone").agg(F.array_sort(F.collect_list(turn)).alias("turns")).select(
        "conv_id", "lone", F.array_join("turns.piece", "").alias("whole"), F.transform("turns", lambda t: t.dropFields("piece")).alias("turns"))
    targets = F.filter("turns", lambda t: t["loss_end"].isNotNull() | (t["end"] == F.length("whole")))
    return convs.select("conv_id", "lone", "whole", F.posexplode(targets).alias("example", "t")).select(
        "conv_id", "lone", "example", (F.col("t.end") == F.length("whole")).alias("last"),
        F.substring("whole", F.lit(1), F.col("t.end").cast("int")).alias("text"), "t.loss_start", "t.loss_end")


def read_back(examples: DataFrame) -> DataFrame:
    """``(conv_id, turns, replies, formatted_chars)`` from the examples alone: the turns as (role, text)
    and the unescaped text under each loss mask, in order."""
    reply = unescaped(F.substring("text", (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int")))
    rows = examples.select("conv_id", "lone", F.when(F.col("last"), F.col("text")).alias("whole"), F.length("text").cast("long").alias("chars"),
                           F.when(F.col("loss_start").isNotNull(), F.struct("example", reply.alias("reply"))).alias("reply"))
    convs = rows.groupBy("conv_id", "lone").agg(F.max("whole").alias("whole"), F.array_sort(F.collect_list("reply")).alias("replies"),
                                        F.sum("chars").alias("formatted_chars"))
    pieces = F.filter(F.split("whole", r"<\|im_start\|>"), lambda p: p != "")  # nothing before the first
    turns = F.transform(pieces, lambda p: F.struct(
        unescaped(F.substring_index(p, "\n", 1)).alias("role"),
        unescaped(F.substring(p, F.instr(p, "\n") + 1, F.length(p) - F.instr(p, "\n") - len(STOP) - 1)).alias("text")))
    return convs.select("conv_id", turns.alias("turns"), F.col("replies.reply").alias("replies"), "formatted_chars")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = read_back(prefix_examples(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("replies", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
                       F.size("replies").cast("long").alias("n_targets"))


def _sql() -> str:
    def nested(text: str) -> str:
        for old, new in [("\\", "\\0"), ("<|", "<\\1"), *((m, f"{m[0]}\\2{m[1:]}") for m in MARKERS)]:
            text = f"replace({text}, '{old}', '{new}')"
        return text

    return f"""
WITH t AS (
    SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS lone, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL VALUES (-1, NULL, 0, 'user', '</s>[INST] ok [/INST]'), (-1, NULL, 1, 'assistant', '</s>[INST] ok [/INST]')),
p AS (
    SELECT *, sum(length({nested('role')}) + length({nested('text')}) + {len(START) + len(STOP) + 2}) OVER w AS upto,
           lead(turn) OVER w IS NULL AS last
    FROM t WINDOW w AS (PARTITION BY conv_id, lone ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = '{TARGET_ROLE}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = '{TARGET_ROLE}'), '')) AS loss_sha256,
       (sum(upto) FILTER (WHERE last OR role = '{TARGET_ROLE}'))::BIGINT AS formatted_chars,
       count(*) FILTER (WHERE role = '{TARGET_ROLE}') AS n_targets
FROM p GROUP BY conv_id, lone
"""


SQL = _sql()
