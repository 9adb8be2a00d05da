"""Operator 7, line dedup by a log-template tree.

Lines are parsed by a tree of fixed depth: by number of tokens, then by the first ``depth`` tokens,
tokens with digits counting as a variable field. Lines that agree after masking are one form; it
recurs if ``docs`` documents hold it and at least ``fixed`` of the tokens after the leading ones are
not masked. In a leaf, a form's tokens are ordered by the documents that have them at their place;
each beginning of that order (ties whole) is a template, the other tokens its variable fields. A
template of ``docs`` documents recurs if at least ``fixed`` of the tokens after the leading ones are
fixed and it holds at least ``cohesion`` of the documents of its rarest fixed token, so tokens that
are merely frequent make none, and a field's values may each be in many documents. One with a single
fixed token after the leading ones, or with ``fixed`` only over the whole line, recurs if it fills its
leaf (``fill`` of its documents, in the second case in leaves of ``fill_docs`` documents or more). A
line that enough documents hold word for word recurs by itself. Recurring lines are dropped from
every document.

A document here is a text: copies of one text are one document, so a text stored twice keeps its
lines. The numbers are parameters (``Rules``). Counts of documents do not depend on the size of the
table: they say how many different texts make a repetition, more of them for short lines.

Only hashes of lines are shuffled; texts are read again for one line per form of the leaves with
several forms, and for the documents that lose lines. A line that a third of all documents hold is
counted per task before the shuffle. Texts and lines are told apart by 64-bit hashes.

Nulls, ties and odd input: a null text counts as empty, and an empty text has one line and no
tokens; rows that repeat a text get the same result each; a very long text or line is taken whole; an
empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.llm.common import column, in_arrow, match, stage, table

FIELD = b"<*>"
_DIGIT = re.compile(rb"[0-9]")


@dataclass(frozen=True)
class Rules:
    """Leading tokens of a leaf and what recurs."""

    depth: int = 3
    tokens: int = 5           # lines below form no template
    docs: int = 3             # of a form or template
    fixed: float = 0.5
    cohesion: float = 0.5
    fill: float = 0.9
    fill_docs: int = 10
    line_docs: int = 2        # of a line, word for word
    short_docs: int = 5       # of a line below ``tokens``, word for word


RULES = Rules()


def _hash(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) - 2**63


def masked(line: str) -> list[bytes]:
    """The line's tokens, those with a digit as a variable field."""
    tokens = line.encode().split()
    return [FIELD if _DIGIT.search(t) else t for t in tokens] if _DIGIT.search(line.encode()) else tokens


def leaf_of(tokens: list[bytes], depth: int) -> int:
    return _hash(b" ".join([str(len(tokens)).encode(), *tokens[:depth]]))


def _numbers(pos: int, part: str, rules: Rules) -> dict[str, int]:
    """The number of the line's very words and the documents they need; its leaf and form, which short lines
    lack, and whether enough tokens of its form are not masked."""
    tokens, words = masked(part), part.encode().split()
    found = {"pos": pos, "line": _hash(b" ".join(words)), "need": rules.short_docs}
    if len(words) < rules.tokens:
        return found
    tail = tokens[rules.depth:]
    solid = sum(t != FIELD for t in tail) >= rules.fixed * len(tail)
    return {**found, "need": rules.line_docs, "leaf": leaf_of(tokens, rules.depth), "form": _hash(b" ".join(tokens)), "solid": solid}


def _parser(id_type: pa.DataType, rules: Rules):
    line = pa.struct([("pos", pa.int32()), ("leaf", pa.int64()), ("form", pa.int64()), ("line", pa.int64()), ("solid", pa.bool_()), ("need", pa.int32())])
    schema = pa.schema([("id", id_type), ("k", pa.int64()), ("n_lines", pa.int64()), ("sha", pa.string()), ("lines", pa.list_(line))])

    def parse(batches):
        for batch in batches:
            counts, shas, lines = [], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                parts = text.split("\n")
                counts.append(len(parts))
                shas.append(hashlib.sha256(text.encode()).hexdigest())
                lines.append([_numbers(pos, part, rules) for pos, part in enumerate(parts) if part.encode().split()])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("k"), pa.array(counts, pa.int64()),
                                              pa.array(shas, pa.string()), pa.array(lines, pa.list_(line))], schema=schema)

    return parse


def _celler(depth: int):
    def cells(batches):
        """For each line: a number for each token after the leading ones that is not masked, at its place in the
        leaf, how many tokens follow the leading ones, and how many of the leading ones are not masked."""
        for batch in batches:
            leaves = batch.column("leaf").to_pylist()
            lines = [masked(line) for line in batch.column("line").to_pylist()]
            found = [[_hash(f"{leaf} {at} ".encode() + token) for at, token in enumerate(tokens) if at >= depth and token != FIELD]
                     for leaf, tokens in zip(leaves, lines, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("leaf", "form", "docs", "in_leaf")), pa.array(found, pa.list_(pa.int64())),
                                              pa.array([len(t) - depth for t in lines], pa.int64()),
                                              pa.array([sum(x != FIELD for x in t[:depth]) for t in lines], pa.int64())],
                                             names=["leaf", "form", "docs", "in_leaf", "cells", "n", "lead"])

    return cells


def _cleaner(batches):
    for batch in batches:
        cleaned = []
        for text, dropped in zip(batch.column("text").to_pylist(), batch.column("dropped").to_pylist(), strict=True):
            gone = set(dropped)
            cleaned.append("\n".join(part for pos, part in enumerate((text or "").split("\n")) if pos not in gone))
        yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(cleaned, pa.string())], names=["k", "clean"])


class LineTemplates:
    """The tables of one run over ``docs``."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = RULES) -> None:
        from pyspark.sql.pandas.types import to_arrow_type

        self.rules = rules
        rows = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
        self.texts = rows.select("id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("k"), "text")
        line = T.StructType.fromDDL("pos int, leaf long, form long, line long, solid boolean, need int")
        schema = T.StructType([rows.schema["id"], T.StructField("k", T.LongType()), T.StructField("n_lines", T.LongType()),
                               T.StructField("sha", T.StringType()), T.StructField("lines", T.ArrayType(line))])
        #: One row per row of ``docs``: ``(id, k, n_lines, sha, lines)``.
        self.docs = stage(in_arrow(self.texts, _parser(to_arrow_type(rows.schema["id"].dataType), rules), schema), "lines")

    def recurring(self) -> DataFrame:
        """``(leaf, form)`` of the forms that recur or have a template that does."""
        r = self.rules
        lines = self.docs.select("k", F.explode("lines").alias("line")).select("k", "line.*").where("form IS NOT NULL")
        once = stage(lines.groupBy("k", "leaf", "form", "solid").agg(F.min("pos").alias("pos")), "once")
        forms = stage(once.groupBy("leaf", "form", "solid").agg(F.count("*").alias("docs"), F.min(F.struct("k", "pos")).alias("at")), "forms")
        leaves = forms.groupBy("leaf").agg(F.sum("docs").alias("in_leaf"), F.count("*").alias("forms")).where(f"in_leaf >= {r.docs}")
        forms = stage(match(forms, leaves, ["leaf"]), "of_leaves")
        solid = forms.where(f"solid AND docs >= {r.docs}").select("leaf", "form")
        open_ = forms.where("forms > 1 OR NOT solid").select("leaf", "form", "docs", "in_leaf", "at.k", "at.pos")
        template = self.templates(open_)
        # a form that enough documents hold makes its templates' documents enough
        sure = template.groupBy("template").agg(F.max("docs").alias("docs")).where(f"docs >= {r.docs}").select("template")
        rest = match(template, sure, ["template"], "left_anti").select("leaf", "form", "template")
        counted = match(once, rest, ["leaf", "form"]).groupBy("template", "k").agg(F.lit(1).alias("one"))
        often = counted.groupBy("template").agg(F.count("*").alias("docs")).where(f"docs >= {r.docs}").select("template")
        found = match(template, sure.union(often), ["template"], "left_semi").select("leaf", "form")
        return stage(solid.union(found).distinct(), "recurring")

    def repeated(self) -> DataFrame:
        """``(line)`` of the lines that enough documents hold word for word."""
        lines = self.docs.select("k", F.explode("lines").alias("line")).select("k", "line.line", "line.need")
        often = lines.distinct().groupBy("line", "need").agg(F.count("*").alias("docs"))
        return often.where("docs >= need").select("line")

    def templates(self, forms: DataFrame) -> DataFrame:
        """``(leaf, form, docs, template)``: the templates of each form that hold together and are fixed enough."""
        r = self.rules
        texts = match(self.texts.select("k", "text"), forms, ["k"])
        lines = texts.select("leaf", "form", "docs", "in_leaf", F.get(F.split("text", "\n"), F.col("pos")).alias("line"))
        cells = in_arrow(lines, _celler(r.depth), "leaf long, form long, docs long, in_leaf long, cells array<long>, n long, lead long")
        cells = stage(cells.dropDuplicates(["leaf", "form"]), "cells")
        each = cells.select("leaf", "form", "docs", "in_leaf", "n", "lead", F.explode("cells").alias("cell"))
        held = each.groupBy("cell").agg(F.sum("docs").alias("held")).where(f"held >= {r.docs}")
        kept = match(each, held, ["cell"]).groupBy("leaf", "form", "docs", "in_leaf", "n", "lead").agg(
            F.array_sort(F.collect_list(F.struct((-F.col("held")).alias("less"), "cell"))).alias("kept"))
        cuts = kept.withColumn("cut", F.explode(F.expr(
            f"filter(sequence(1, size(kept)), i -> (i = size(kept) OR kept[i - 1].less <> get(kept, i).less) AND "
            f"(i >= {r.fixed} * n OR (in_leaf >= {r.fill_docs} AND lead + i >= {r.fixed} * (n + {r.depth}))))")))
        cuts = stage(cuts.select("leaf", "form", "docs", "in_leaf", F.expr("xxhash64(leaf, slice(kept.cell, 1, cut))").alias("template"),
                                 F.expr("-kept[cut - 1].less").alias("held"), F.expr(f"cut > 1 AND cut >= {r.fixed} * n").alias("apart")), "cuts")
        whole = cuts.groupBy("template").agg(*(F.max(c).alias(c) for c in ("held", "apart", "in_leaf")), F.sum("docs").alias("total"))
        whole = whole.where(f"total >= {r.docs} AND total >= {r.cohesion} * held AND (apart OR total >= {r.fill} * in_leaf)")
        return stage(match(cuts, whole.select("template"), ["template"], "left_semi").select("leaf", "form", "docs", "template"), "templates")

    def dropped(self) -> DataFrame:
        """``(k, dropped)``: the places of the lines that go."""
        lines = self.docs.select("k", F.explode(F.array_distinct("lines")).alias("line")).select("k", "line.*")
        gone = match(lines, self.recurring().select("leaf", "form"), ["leaf", "form"], "left_semi").select("k", "pos").union(
            match(lines, self.repeated(), ["line"], "left_semi").select("k", "pos"))
        return stage(gone.groupBy("k").agg(F.array_sort(F.collect_set("pos")).alias("dropped")), "dropped")

    def cleaned(self, dropped: DataFrame) -> DataFrame:
        """``(k, clean)`` of the texts that lose lines."""
        texts = match(self.texts.select("k", "text"), dropped, ["k"], lists=F.size("dropped"))
        return in_arrow(texts.select("k", "text", "dropped"), _cleaner, "k long, clean string")


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = RULES) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_lines``, ``n_dropped``, the places ``dropped`` and
    ``clean_sha256`` of the text without them (lines joined again by line ends)."""
    run = LineTemplates(docs, id_col, text_col, rules)
    dropped = run.dropped()
    digests = run.cleaned(dropped).groupBy("k").agg(F.min(F.sha2("clean", 256)).alias("clean"))
    changed = dropped.join(digests, "k")
    return match(run.docs, changed, ["k"], "left", lists=F.size("dropped") + 8).select(
        F.col("id").alias(id_col), "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"), F.coalesce("clean", "sha").alias("clean_sha256"))


def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_recurring_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped"), "clean_sha256")
