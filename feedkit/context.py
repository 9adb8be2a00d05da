"""Run context: the injected clock, plus session helpers shared by all operators."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextvars import ContextVar, copy_context
from dataclasses import dataclass, field
from functools import partial
from typing import TypeVar
from zoneinfo import ZoneInfo

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunContext:
    """Replaces every ``current_date()`` / ``current_timestamp()`` of a feed.

    ``as_of`` is the business date, ``now`` the UTC wall-clock instant of the run
    (a naive ``datetime`` read as UTC) and ``tz`` the zone the hour gate uses.
    """

    as_of: dt.date
    now: dt.datetime = field(default_factory=lambda: dt.datetime(2000, 1, 1))
    tz: str = "America/New_York"

    @classmethod
    def at(cls, as_of: str | dt.date, now: str | dt.datetime | None = None,
           tz: str = "America/New_York") -> "RunContext":
        if isinstance(as_of, str):
            as_of = dt.date.fromisoformat(as_of)
        if now is None:
            now = dt.datetime.combine(as_of, dt.time(12, 0))
        elif isinstance(now, str):
            now = dt.datetime.fromisoformat(now)
        return cls(as_of=as_of, now=now, tz=tz)

    def as_of_col(self) -> Column:
        return F.lit(self.as_of)

    def now_col(self) -> Column:
        """The run instant as a TIMESTAMP literal, the same in every session zone."""
        micros = (self.now.replace(tzinfo=dt.timezone.utc) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
        return F.timestamp_micros(F.lit(micros))

    def gate_open(self, modulus: int = 2) -> bool:
        """Whether the run's hour in ``tz`` is a multiple of ``modulus``."""
        local = self.now.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(self.tz))
        return local.hour % modulus == 0


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Where the session names none (tests, a plain local session) the folder is put
    under the warehouse, which every executor shares as well. The rule is the same
    on every master; a machine-local temporary folder is never used.
    """
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never localCheckpoint): survives executor loss."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint(eager=True)


T = TypeVar("T")
_scope: ContextVar["StagingScope | None"] = ContextVar("staging_scope", default=None)


class StagingScope:
    """Staged tables with a lifetime: those written inside ``with`` are deleted at its end.

    ``keep`` writes what is to outlive the scope; that belongs to the scope around it, or where there
    is none, to the application. Frames that read the scope's tables must be written or kept before
    it ends. ``stage_all`` hands the scope on to its threads.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.roots = spark, []

    def __enter__(self) -> "StagingScope":
        self.outer, self._token = _scope.get(), _scope.set(self)
        return self

    def __exit__(self, *_: object) -> None:
        _scope.reset(self._token)
        for root in self.roots:
            delete_folder(self.spark, root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        token = _scope.set(self.outer)
        try:
            return stage(df, name)
        finally:
            _scope.reset(token)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Cuts lineage like a reliable checkpoint but computes the input only once,
    and later reads get column pruning and filter pushdown from the file scan.
    The folder goes away with the ``StagingScope`` it was written in, at the latest when the application ends.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_all(tasks: Mapping[str, Callable[[], T]], at_once: int = 8) -> dict[str, T]:
    """The results of tasks that do not depend on one another; the Spark jobs they start share the executors.

    Threads take over the session's local properties and the staging scope.
    """
    if not tasks:
        return {}
    heir = inheritable_thread_target(SparkSession.getActiveSession())
    with ThreadPoolExecutor(min(at_once, len(tasks))) as pool:
        jobs = {name: pool.submit(copy_context().run, heir(task)) for name, task in tasks.items()}
        return {name: job.result() for name, job in jobs.items()}


def stage_all(frames: Mapping[str, DataFrame], at_once: int = 8) -> dict[str, DataFrame]:
    """``stage`` for frames that do not depend on one another, as concurrent jobs."""
    return run_all({name: partial(stage, df, name) for name, df in frames.items()}, at_once)


def staging_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, deleted with its scope or when the application ends."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/staged/{uuid.uuid4().hex}"
    folder_of(spark, root)[0].deleteOnExit(folder_of(spark, root)[1])
    scope = _scope.get()
    if scope is not None:
        scope.roots.append(root)
    return f"{root}/{name}"


def folder_of(spark: SparkSession, path: str) -> tuple:
    """The Hadoop file system and path object of ``path``."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def delete_folder(spark: SparkSession, path: str) -> None:
    files, where = folder_of(spark, path)
    files.delete(where, True)
