"""Change detection against a control table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType


def latest_activity(arms: Mapping[str, tuple[DataFrame, str, str]], out_key: str = "__ck",
                    out_ts: str = "__cts") -> DataFrame:
    """Union every arm's (key, timestamp) and keep the latest timestamp per key.

    Each arm is ``(df, key column, timestamp column)`` already filtered by its
    own predicate. One union, one partial+final aggregate, one shuffle in total.
    """
    parts = [df.select(F.col(k).alias(out_key), F.col(ts).alias(out_ts)) for df, k, ts in arms.values()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.filter(F.col(out_key).isNotNull()).groupBy(out_key).agg(F.max(out_ts).alias(out_ts))


def changed_since(base: DataFrame, key: str, last_sent: str,
                  arms: Mapping[str, tuple[DataFrame, str, str]],
                  column_arms: Sequence[Column] = ()) -> DataFrame:
    """Keep base rows with any activity strictly after their ``last_sent`` time.

    Equivalent to ``EXISTS(arm1 ts > last_sent) OR EXISTS(arm2 ...) OR col > last_sent``
    as long as no arm's own filter reads the base row: the latest activity
    per key is compared once instead of one existence join per arm. A NULL
    ``last_sent`` never counts as changed.

    No activity up to the smallest ``last_sent`` of all base rows can count, so that time
    is read first, from the base alone, and goes into every arm as a literal that reaches the scans.
    """
    if arms:
        # As text or microseconds: a Python time would be read in the driver's own zone.
        kind = base.schema[last_sent].dataType
        instant = isinstance(kind, TimestampType)
        smallest = F.min(last_sent)
        bound = base.agg((F.unix_micros(smallest) if instant else smallest.cast("string")).alias("bound")).first()["bound"]
        since = F.timestamp_micros(F.lit(bound).cast("long")) if instant else F.lit(bound).cast(kind)
        arms = {name: (df.filter(F.col(ts) > since), k, ts) for name, (df, k, ts) in arms.items()}
    act = latest_activity(arms) if arms else None
    out = base
    cond = F.lit(False)
    if act is not None:
        out = out.join(act, F.col(key) == F.col("__ck"), "left")
        cond = cond | (F.col("__cts") > F.col(last_sent))
    for c in column_arms:
        cond = cond | (c > F.col(last_sent))
    out = out.filter(F.coalesce(cond, F.lit(False)))
    return out.drop("__ck", "__cts") if act is not None else out


def not_sent(df: DataFrame, control: DataFrame, on: tuple[str, str],
             cond: Column | None = None) -> DataFrame:
    """Anti join: drop rows that have a control row with the same key (and ``cond``).

    ``cond`` is the residual between the row and the control row (for example
    ``control.last_year >= row.year``); it stays a residual of a hash anti join.
    """
    jc = F.col(on[0]) == F.col(on[1])
    if cond is not None:
        jc = jc & cond
    return df.join(control, jc, "left_anti")


def exclude_same_year(df: DataFrame, events: DataFrame, on: tuple[str, str],
                      year: tuple[str, str]) -> DataFrame:
    """Drop rows whose key has a qualifying event in the same year.

    ``events`` carries (key, year) of qualifying events; they are made distinct
    first so the anti join probes a set.
    """
    ev = events.select(F.col(on[1]).alias("__xk"), F.col(year[1]).alias("__xy")).distinct()
    jc = (F.col(on[0]) == F.col("__xk")) & (F.col(year[0]) == F.col("__xy"))
    return df.join(ev, jc, "left_anti")
