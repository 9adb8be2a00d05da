"""Small helpers the operators of this package share."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedkit.context import StagingScope, stage, staging_path  # noqa: F401  (re-exported for the operators)

#: The white space of every contract here: space, tab, newline, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def in_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow``, after making this package importable for the Python workers of every executor."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "_feedkit_sent", False):
        with tempfile.TemporaryDirectory() as folder:  # on the driver, until Spark has it for its executors
            kept = f"{folder}/code/feedkit"
            shutil.copytree(Path(__file__).parents[1], kept, ignore=shutil.ignore_patterns("__pycache__"))
            with tempfile.NamedTemporaryFile(prefix="feedkit-", suffix=".zip", delete=False) as archive:
                pass
            shutil.make_archive(archive.name.removesuffix(".zip"), "zip", f"{folder}/code")
        context.addPyFile(archive.name)
        context._feedkit_sent = True
    return df.mapInArrow(function, schema)


def _reads_files(docs: DataFrame) -> bool:
    """Whether each row of ``docs`` is a row of a parquet file, no more than cut by columns or conditions."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation" and "row_index" in docs.select(docs.metadataColumn("_metadata").alias("m")).schema["m"].dataType.names


def numbered(docs: DataFrame, name: str = "rows") -> DataFrame:
    """``docs`` as ``(rid, row)``: a row number beside the whole row as one struct, so no column can clash.

    The number must stay the same however often a lost executor makes Spark read the rows again. Rows of
    parquet files have one, their place in the file below the file's rank by name; nothing is copied.
    Other tables are written once with a running number.
    """
    if not _reads_files(docs):
        row = F.struct(*[column(c) for c in docs.columns]).alias("row")
        return stage(docs.select(F.monotonically_increasing_id().alias("rid"), row), name)
    where = docs.metadataColumn("_metadata")
    plain = [f"c{i}" for i in range(len(docs.columns))]  # columns up to the last step, so that those not needed are not read
    files = docs.select(where["file_path"].alias("file")).distinct()  # a row per file
    files = files.select(F.xxhash64("file").alias("file"), (F.row_number().over(W.orderBy("file")) - 1).cast("long").alias("rank"))
    rows = docs.select(F.xxhash64(where["file_path"]).alias("file"), where["row_index"].alias("at"),
                       *[column(c).alias(p) for c, p in zip(docs.columns, plain, strict=True)])
    row = F.struct(*[F.col(p).alias(c) for c, p in zip(docs.columns, plain, strict=True)])
    return match(rows, files, ["file"]).select((F.col("rank") * F.lit(2**33) + F.col("at")).alias("rid"), row.alias("row"))


#: Numbers that may be broadcast in one table: about 30 MB on each executor.
BROADCAST_NUMBERS = 2_000_000


def match(rows: DataFrame, few: DataFrame, keys: list[str], how: str = "inner", lists: Column | None = None) -> DataFrame:
    """``rows.join(few)``, where ``few`` holds keys and numbers and ``rows`` may hold texts.

    ``few`` is written and its numbers counted first (``lists``: how many a row holds in arrays). Up to
    ``BROADCAST_NUMBERS`` it goes to every executor and the texts stay where they are; beyond, both
    sides are shuffled and Spark splits skewed partitions.
    """
    few = stage(few, "few")
    numbers = few.agg(F.sum((F.lit(0) if lists is None else lists) + len(few.columns))).first()[0] or 0
    return rows.join(F.broadcast(few) if numbers <= BROADCAST_NUMBERS else few, keys, how)


def without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``numbered`` whose ``rid`` is not in ``dropped``, unpacked again."""
    return match(rows, dropped.select("rid"), ["rid"], "left_anti").select("row.*")


def first_id(id_col: str = "id", rid: str = "rid") -> Column:
    """Order of rows in a group: by id, rows without one last, then by row number."""
    return F.struct(F.col(id_col).isNull().alias("missing"), F.col(id_col).alias("id"), F.col(rid).alias("rid"))
