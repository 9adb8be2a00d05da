"""Control table: what was already delivered (O38, O39 source gate, O40).

The control table is upserted without MERGE: the new state is computed as a
full outer join of the current snapshot with the run's source rows and
written as a *new* numbered version. The current version is the highest one
Spark finished writing, so there is no pointer that could be lost, a path being
read is never overwritten, and a failed run leaves the previous version current.
A run claims its version's number before it computes the rows, so overlapping runs
cannot lose one another's.
"""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType, TimestampType

from feedkit.functions.text import hour_gate, utc_wall

# Fixed values that must equal the reference's: control table column names and types.
CONTROL_SCHEMA = StructType([
    StructField("wsrsrez_pidm", DecimalType(38, 10), True),
    StructField("wsrsrez_init_term", StringType(), True),
    StructField("wsrsrez_last_acyr", StringType(), True),
    StructField("wsrsrez_last_term", StringType(), True),
    StructField("wsrsrez_last_sent", TimestampType(), True),
    StructField("wsrsrez_status_ind", StringType(), True),
    StructField("wsrsrez_activity_date", TimestampType(), True),
])
KEY_TYPE = DecimalType(8, 0)
#: Ending of the file by which a run holds a version's number.
CLAIM = ".claim"


def control_key(col: str | Column = "wsrsrez_pidm") -> Column:
    """Control key as DECIMAL(8,0); out-of-range keys become NULL (never match)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(KEY_TYPE)


def control_source(feed: DataFrame, now: Column, tz: str = "America/New_York", modulus: int = 2,
                   key: str = "tmpPidm", year: str = "tmpTermACYR", term: str = "tmpPulledTerm") -> DataFrame:
    """Per person: MAX(year), MAX(term) of the feed's data rows, only in gated hours."""
    rows = feed.filter((F.col("IS_HEADER") == 0) & hour_gate(utc_wall(now), tz, modulus))
    return rows.groupBy(key).agg(F.max(year).alias(year), F.max(term).alias(term))


def upsert_control(target: DataFrame, source: DataFrame, now: Column,
                   key: str = "tmpPidm", year: str = "tmpTermACYR", term: str = "tmpPulledTerm") -> DataFrame:
    """New control state: matched rows updated (5 columns), unmatched source rows inserted.

    ``source`` must be unique per ``key``. Target rows that match nothing are kept.
    """
    t = target.withColumn("__tk", control_key()).withColumn("__t", F.lit(True))
    s = source.select(F.col(key).alias("__sk"), F.col(year).alias("__sy"), F.col(term).alias("__st"),
                      F.lit(True).alias("__s"))
    j = t.join(s, F.col("__tk") == F.col("__sk"), "full_outer")
    hit = F.col("__s").isNotNull()
    has_t = F.col("__t").isNotNull()
    sent_at = now.cast("timestamp")
    out = j.select(
        F.when(has_t, F.col("wsrsrez_pidm")).otherwise(F.col("__sk").cast(DecimalType(38, 10))).alias("wsrsrez_pidm"),
        F.when(has_t, F.col("wsrsrez_init_term")).otherwise(F.col("__st")).alias("wsrsrez_init_term"),
        F.when(hit, F.col("__sy")).otherwise(F.col("wsrsrez_last_acyr")).alias("wsrsrez_last_acyr"),
        F.when(hit, F.col("__st")).otherwise(F.col("wsrsrez_last_term")).alias("wsrsrez_last_term"),
        F.when(hit, sent_at).otherwise(F.col("wsrsrez_last_sent")).alias("wsrsrez_last_sent"),
        F.when(hit, F.lit("A")).otherwise(F.col("wsrsrez_status_ind")).alias("wsrsrez_status_ind"),
        F.when(hit, sent_at).otherwise(F.col("wsrsrez_activity_date")).alias("wsrsrez_activity_date"),
    )
    return out


class CatalogControl:
    """The control table as a table of a catalog (``catalog.schema.table``), upserted row by row.

    ``merge`` needs a catalog whose tables support row-level operations. It is one transaction of that
    catalog, which also settles overlapping runs; only rows that changed are written. Other catalogs
    raise, and nothing is written: overwriting a table in place could lose it, ``ControlTable`` cannot.
    """

    def __init__(self, spark: SparkSession, table: str, fmt: str = "parquet"):
        self.spark, self.table, self.fmt = spark, table, fmt

    def ensure(self) -> None:
        """CREATE TABLE IF NOT EXISTS with the columns of the control table."""
        if not self.spark.catalog.tableExists(self.table):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CONTROL_SCHEMA.fields)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}) USING {self.fmt}")

    def read(self) -> DataFrame:
        return self.spark.table(self.table).select(*[F.col(f.name).cast(f.dataType) for f in CONTROL_SCHEMA.fields])

    def merge(self, source: DataFrame, now: Column, key: str = "tmpPidm", year: str = "tmpTermACYR",
              term: str = "tmpPulledTerm") -> None:
        """``upsert_control`` as a MERGE. ``source`` must be unique per ``key``."""
        rows = source.select(F.col(key).alias("__sk"), F.col(year).alias("__sy"), F.col(term).alias("__st"),
                             now.cast("timestamp").alias("__now"))
        sent = {"wsrsrez_last_acyr": F.col("__sy"), "wsrsrez_last_term": F.col("__st"), "wsrsrez_last_sent": F.col("__now"),
                "wsrsrez_status_ind": F.lit("A"), "wsrsrez_activity_date": F.col("__now")}
        first = {"wsrsrez_pidm": F.col("__sk").cast(DecimalType(38, 10)), "wsrsrez_init_term": F.col("__st")}
        (rows.mergeInto(self.table, control_key() == F.col("__sk"))
         .whenMatched().update(sent).whenNotMatched().insert(first | sent).merge())


class ControlTable:
    """Versions ``v<number>`` of the control table under ``root`` (a shared, durable folder)."""

    def __init__(self, spark: SparkSession, root: str, abandoned_after: float = 6 * 3600):
        self.spark, self.abandoned_after = spark, abandoned_after
        self.root = f"{root.rstrip('/')}/versions"
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> tuple[list[int], list[int]]:
        """Numbers of the finished versions and of all that were begun or claimed."""
        if not self._fs.exists(self._path(self.root)):
            return [], []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(self.root))]
        begun = sorted({int(n[1:].removesuffix(CLAIM)) for n in names})
        return [v for v in begun if self._fs.exists(self._path(f"{self._at(v)}/_SUCCESS"))], begun

    def _claim_path(self, number: int):
        return self._path(f"{self._at(number)}{CLAIM}")

    def _claimed(self, number: int) -> bool:
        """Whether a run that may still finish holds the number."""
        path = self._claim_path(number)
        return self._fs.exists(path) and time.time() - self._fs.getFileStatus(path).getModificationTime() / 1000 < self.abandoned_after

    def _at(self, number: int) -> str:
        return f"{self.root}/v{number}"

    def current_version(self) -> int | None:
        """The highest finished version; None only where nothing was ever begun."""
        finished, begun = self._versions()
        if begun and not finished:
            raise RuntimeError(f"{self.root} holds versions, but none was finished")
        return finished[-1] if finished else None

    def ensure(self) -> None:
        """Create an empty table if none exists (CREATE TABLE IF NOT EXISTS)."""
        if self.current_version() is None:
            self.commit(self.spark.createDataFrame([], CONTROL_SCHEMA))

    def read(self, version: int | None = None) -> DataFrame:
        version = self.current_version() if version is None else version
        if version is None:
            return self.spark.createDataFrame([], CONTROL_SCHEMA)
        return self.spark.read.schema(CONTROL_SCHEMA).parquet(self._at(version))

    def claim(self, after: int | None = None) -> int:
        """Take the next version number for this run, before it computes its rows.

        ``after`` is the version the rows will be computed from. The claim is a file that only one run can
        create (on file systems that create files atomically). It is refused where ``after`` is not
        the current version or where another run holds a claim, so of two runs that overlap one fails
        at once and no rows are lost. A claim older than ``abandoned_after`` seconds no longer counts.
        """
        finished, begun = self._versions()
        if after is not None and finished[-1:] != [after]:
            raise RuntimeError(f"version {after} is no longer current: {finished[-1:]}")
        held = [v for v in begun if v not in finished and self._claimed(v)]
        if held:
            raise RuntimeError(f"another run is about to commit version {held[-1]}")
        number = begun[-1] + 1 if begun else 0
        try:
            self._fs.create(self._claim_path(number), False).close()
        except Py4JJavaError as taken:
            raise RuntimeError(f"another run has taken version {number}") from taken
        return number

    def release(self, number: int) -> None:
        """Give a claim back that will not be committed."""
        self._fs.delete(self._claim_path(number), False)

    def commit(self, df: DataFrame, after: int | None = None, claim: int | None = None) -> int:
        """Write ``df`` as the version claimed, or as the next one after ``after``, and return its number."""
        number = self.claim(after) if claim is None else claim
        try:
            later = [v for v in self._versions()[1] if v > number]
            if later or not self._claimed(number):
                raise RuntimeError(f"the claim of version {number} has lapsed: {later}")
            df.select(*[F.col(f.name).cast(f.dataType) for f in CONTROL_SCHEMA.fields]) \
                .write.mode("errorifexists").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(self._at(number))
        finally:
            self.release(number)
        return number

    def prune(self, keep: int = 10) -> None:
        """Remove all but the newest ``keep`` finished versions (at least the current one)."""
        for number in self._versions()[0][:-max(1, keep)]:
            self._fs.delete(self._path(self._at(number)), True)
