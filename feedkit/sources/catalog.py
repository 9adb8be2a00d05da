"""Reading sources and publishing feeds.

Sources are addressed through a :class:`Namespace`: either a catalog + schema
(``spark.table``) or a folder of parquet tables. Feeds take a ``Sources``
mapping of table name -> DataFrame, so tests pass in-memory frames and jobs pass
catalog tables without changing the feed code.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.context import StagingScope, delete_folder, folder_of, stage

Sources = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Namespace:
    """``catalog.schema`` for tables, or ``root`` for a folder of ``<name>.parquet``."""

    schema: str | None = None
    catalog: str | None = None
    root: str | None = None

    def table_name(self, name: str) -> str:
        parts = [p for p in (self.catalog, self.schema) if p]
        return ".".join([*parts, name])


def read_source(spark: SparkSession, ns: Namespace, name: str) -> DataFrame:
    """One source table; column names are lower-cased (the SQL is case-insensitive)."""
    if ns.root:
        df = spark.read.parquet(f"{ns.root.rstrip('/')}/{name}.parquet")
    else:
        df = spark.table(ns.table_name(name))
    return df.toDF(*[c.lower() for c in df.columns])


def read_sources(spark: SparkSession, ns: Namespace, names: Iterable[str]) -> dict[str, DataFrame]:
    return {n: read_source(spark, ns, n) for n in names}


def publish(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    """Full refresh of a feed's stored result, a folder (with a slash) or a catalog table.

    The rows are computed and written in full before anything is replaced, so a failed computation
    leaves the earlier result. A table is replaced in one step where its catalog can (``createOrReplace``),
    and else overwritten from the written rows. A folder's rows are written beside it; then the old folder
    is set aside, the new one takes its name, and the old one goes. At each of these steps the old or the
    new result is there in full, and ``published`` finds it.
    """
    spark = df.sparkSession
    if "/" not in target:
        with StagingScope(spark):
            rows = stage(df, "publish")
            try:
                rows.writeTo(target).using(fmt).createOrReplace()
            except AnalysisException as error:
                if not (error.getCondition() or "").startswith("UNSUPPORTED_FEATURE"):
                    raise
                rows.write.mode("overwrite").format(fmt).saveAsTable(target)
        return
    live, fresh, old = (f"{target.rstrip('/')}{x}" for x in ("", NEW, OLD))
    _settle(spark, target)
    df.write.mode("overwrite").format(fmt).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").save(fresh)
    if _exists(spark, live):
        _rename(spark, live, old)
    _rename(spark, fresh, live)
    delete_folder(spark, old)


#: Endings of the folders a result is in while it is being replaced.
NEW, OLD = "._new", "._old"


def published(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """A published result, also in the middle of a refresh or after one that was cut off."""
    if "/" not in target:
        return spark.table(target)
    return spark.read.format(fmt).load(_whole(spark, target))


def _whole(spark: SparkSession, target: str) -> str:
    live = target.rstrip("/")
    for where in (live, f"{live}{NEW}", f"{live}{OLD}"):
        if _exists(spark, f"{where}/_SUCCESS") or where == live and _exists(spark, live):
            return where
    return live


def _settle(spark: SparkSession, target: str) -> None:
    """Finish a refresh that was cut off between its steps."""
    live, whole = target.rstrip("/"), _whole(spark, target)
    if whole != live:
        _rename(spark, whole, live)
    delete_folder(spark, f"{live}{OLD}")


def _exists(spark: SparkSession, path: str) -> bool:
    files, where = folder_of(spark, path)
    return files.exists(where)


def _rename(spark: SparkSession, path: str, to: str) -> None:
    files, where = folder_of(spark, path)
    if not files.rename(where, folder_of(spark, to)[1]):
        raise RuntimeError(f"{path} could not be renamed to {to}")


def export_text(feed: DataFrame, path: str) -> None:
    """Write REPORT_TEXT lines sorted by REPORT_ORDER, then the text itself.

    A global sort range-partitions the lines, so part files concatenated in
    name order give the file with the header block first.
    """
    (feed.orderBy(F.col("REPORT_ORDER").asc(), F.col("REPORT_TEXT").asc_nulls_first())
     .select("REPORT_TEXT").write.mode("overwrite").text(path))
