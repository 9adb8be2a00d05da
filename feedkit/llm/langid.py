"""Operator 8, language identification by cross-parsing entropy.

For each language a reference of labelled texts becomes a suffix automaton, which follows any substring
of the reference. The texts are whole: the first by hash of the id, at most ``rows`` of them with at
most ``chars`` characters together, for the ``languages`` that most rows have. These parameters of
``learn`` bound what is learned from and what the driver holds. A text is parsed against it from left to
right into the longest phrases that occur in the reference. Phrases times the logarithm of the
reference's length, over the text's length, estimate the cross entropy; the lowest wins.

Texts are parsed whole, in segments of ``SEGMENT`` characters that advance side by side in numpy:
a step of all segments against all languages is one table lookup. A seam costs one phrase at most,
for every language alike. Only letters count; they are lower-cased, and everything else is one
space.

Nulls, ties and odd input: ``und`` with score 0 where the text is null or has no letter, or where
nothing could be learned; equal entropies go to the first language by name; a row without an id is
not held out and not learned from, nor is one whose text alone is over ``chars``; repeated rows get a row each; an empty table gives an empty
result; other columns are never looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.llm.common import column, in_arrow, stage, table

ROWS, CHARS, LANGUAGES = 40, 60_000, 100
SEGMENT, SLICE_CHARS, FOLDS = 512, 2_000_000, 5
UNKNOWN = "und"


class SuffixAutomaton:
    """The smallest automaton that follows every substring of a sequence of symbols."""

    def __init__(self, symbols) -> None:
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for symbol in symbols:
            state = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and symbol not in self.next[p]:
                self.next[p][symbol] = state
                p = link[p]
            if p >= 0:
                q = self.next[p][symbol]
                if length[p] + 1 == length[q]:
                    link[state] = q
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(symbol) == q:
                        self.next[p][symbol] = copy
                        p = link[p]
                    link[q] = link[state] = copy
            last = state


class CrossParser:
    """All languages' automata in one transition table."""

    def __init__(self, references: dict[str, str]) -> None:
        self.languages = sorted(references)
        letters = sorted({c for text in references.values() for c in text.lower() if c.isalpha()})
        # Symbols: 0 other letters, 1 anything but letters, from 2 on the letters of the references.
        self.symbol = np.fromiter((0 if chr(c).isalpha() else 1 for c in range(0x110000)), np.uint16, 0x110000)
        self.symbol[[ord(c) for c in letters]] = np.arange(2, 2 + len(letters))
        self.width = 2 + len(letters)
        tables, self.roots, self.bits, base = [], [], [], 0
        for language in self.languages:
            symbols = self.symbols(references[language])[0]
            automaton = SuffixAutomaton(symbols.tolist())
            start = base * self.width
            root = np.full(self.width, start, np.int64)
            for symbol, state in automaton.next[0].items():
                root[symbol] = (base + state) * self.width
            moves = np.tile(~root, (len(automaton.next), 1))  # negative: a phrase ends, the next begins here
            moves[0] = root
            moves[0, root == start] = ~start  # a letter the reference lacks is a phrase
            for state, following in enumerate(automaton.next):
                for symbol, to in following.items():
                    moves[state, symbol] = (base + to) * self.width
            tables.append(moves.astype(np.int32))
            self.roots.append(start)
            self.bits.append(math.log2(max(2, len(symbols))))
            base += len(automaton.next)
        self.moves = np.concatenate(tables).ravel() if tables else np.empty(0, np.int32)

    def symbols(self, text: str) -> tuple[np.ndarray, int]:
        """The text's symbols, runs of non-letters as one, and its number of letters."""
        symbols = self.symbol[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
        space = symbols == 1
        letters = int(len(symbols) - space.sum())
        space[1:] &= space[:-1].copy()
        space[:1] = False
        return symbols[~space], letters

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases per language (rows) and text (columns)."""
        per_text = np.array([-(-len(t) // SEGMENT) for t in texts], np.int64)
        owner = np.repeat(np.arange(len(texts)), per_text)
        first = np.cumsum(per_text) - per_text
        place = np.arange(len(owner)) - first[owner]
        lengths = np.array([len(t) for t in texts], np.int64)
        starts = (np.cumsum(lengths) - lengths)[owner] + place * SEGMENT
        size = np.minimum(SEGMENT, lengths[owner] - place * SEGMENT)
        order = np.argsort(-size, kind="stable")
        starts, size = starts[order], size[order]
        flat = np.concatenate([*texts, np.zeros(SEGMENT, np.uint16)])
        active = np.searchsorted(-size, -np.arange(SEGMENT), side="left")  # segments longer than the step
        roots = np.array(self.roots, np.int32)[:, None]
        state = np.repeat(roots, len(owner), axis=1)
        count = np.zeros((len(self.languages), len(owner)), np.int32)
        for step in range(SEGMENT):
            n = active[step]
            if n == 0:
                break
            to = self.moves.take(state[:, :n] + flat[starts[:n] + step].astype(np.int32))
            ended = to >> 31
            count[:, :n] -= ended
            state[:, :n] = to ^ ended
        count += state != roots
        totals = np.zeros((len(self.languages), len(texts)), np.int64)
        for language in range(len(self.languages)):
            np.add.at(totals[language], owner[order], count[language])
        return totals

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        parsed = [self.symbols(text) for text in texts]
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        entropy = self.phrases([symbols for symbols, _ in parsed]) * np.array(self.bits)[:, None]
        out = []
        for i, (symbols, letters) in enumerate(parsed):
            if not letters:
                out.append((UNKNOWN, 0.0))
                continue
            each = entropy[:, i] / len(symbols)
            best = int(each.argmin())
            others = np.delete(each, best)
            out.append((self.languages[best], float(1 - each[best] / others.min()) if len(others) else 1.0))
        return out


_parsers: dict[tuple, CrossParser] = {}


def parser(references: dict[str, str]) -> CrossParser:
    """One per Python worker; the automata are built from the references where they are used."""
    key = tuple(sorted(references.items()))
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = CrossParser(references)
    return _parsers[key]


def _predictor(references: dict[str, str]):
    def predict(batches):
        cross = parser(references)
        for batch in batches:
            lengths = np.cumsum(pa.compute.utf8_length(batch.column("text")).fill_null(0).to_numpy())
            cuts = np.searchsorted(lengths, np.arange(SLICE_CHARS, lengths[-1] if len(lengths) else 0, SLICE_CHARS)) + 1
            edges = np.unique([0, *cuts.tolist(), len(batch)])
            for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                part = batch.slice(start, end - start)
                found = cross.predict([text or "" for text in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("held_out"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    names=["id", "held_out", "lang_pred", "score"])

    return predict


def _held_out(docs: DataFrame, id_col: str):
    return F.coalesce(F.crc32(column(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = ROWS,
          chars: int = CHARS, languages: int = LANGUAGES) -> dict[str, str]:
    """The reference text of each language, from rows that are not held out: at most ``rows`` whole texts of
    ``chars`` characters in all per language reach the driver, for at most ``languages`` of them."""
    from pyspark.sql import Window as W

    given = docs.where(column(id_col).isNotNull() & column(text_col).isNotNull() & column(lang_col).isNotNull() & ~_held_out(docs, id_col))
    given = given.select(column(lang_col).alias("lang"), F.xxhash64(column(id_col)).alias("place"), column(text_col).alias("text"))
    places = given.select("lang", "place", F.length("text").alias("chars")).where(f"chars <= {chars}")
    # Thinned by the hash until about enough are left, then cut exactly, within each language.
    first = places.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    first = first.select("lang", F.least(F.lit(1.0), F.lit(4.0 * rows) / F.col("n")).alias("share"))
    unit = (F.col("place") / F.lit(2.0**64)) + 0.5
    near = stage(places.join(stage(first, "shares"), "lang").where(unit <= F.col("share")).select("lang", "place", "chars"), "near")
    in_order = W.partitionBy("lang").orderBy("place", "chars")
    chosen = near.withColumn("n", F.row_number().over(in_order)).withColumn(
        "upto", F.sum("chars").over(in_order.rowsBetween(W.unboundedPreceding, 0))).where(f"n <= {rows} AND upto <= {chars}")
    chosen = stage(chosen.select("lang", "place", "chars").distinct(), "chosen")
    texts = given.withColumn("chars", F.length("text")).join(chosen, ["lang", "place", "chars"])
    found = texts.groupBy("lang", "place").agg(F.min("text").alias("text")).collect()
    references: dict[str, list[str]] = {}
    for row in sorted(found, key=lambda r: (r["lang"], r["place"])):
        references.setdefault(row["lang"], []).append(row["text"])
    return {lang: "\n".join(parts) for lang, parts in references.items()}


def predict(docs: DataFrame, references: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, lang_pred, score)`` per row of ``docs``, from its text alone."""
    rows = docs.select(column(id_col).alias("id"), _held_out(docs, id_col).alias("held_out"), column(text_col).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("held_out", T.BooleanType()),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return in_arrow(rows, _predictor(references), schema).withColumnRenamed("id", id_col)


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, learn(docs))
