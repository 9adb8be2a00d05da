"""The training-data pipeline: quality rules, exact dedup, near dedup, mixing, tokens.

``run`` applies the stages to ``documents`` in turn. Each stage's rows are written as Parquet to
the shared checkpoint folder and read again, so a lost executor never reaches back further than
one stage. Every stage but the last returns the columns of ``documents``.

Nulls, ties and odd input: a null or empty text fails the quality rules; rows that repeat an id are
separate documents, of equal ones the first stays; a very long text passes whole through every stage;
further columns, whatever their names, are carried to the last stage; an empty table gives an empty
result with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedkit.llm.bpe import bpe_stage
from feedkit.llm.common import StagingScope, table
from feedkit.llm.exact_dedup import exact_stage
from feedkit.llm.host_rules import quality_stage
from feedkit.llm.mixing import mix_stage
from feedkit.llm.near_dedup import near_stage

STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mix_stage),
    ("bpe", bpe_stage),
]

#: MinHash, the mix's hash order and BPE have no SQL form; tests/llm holds a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        with StagingScope(spark) as scope:  # what a stage stages for itself goes when its rows are written
            docs = scope.keep(step(spark, docs, sf_dir), name)
    return docs
