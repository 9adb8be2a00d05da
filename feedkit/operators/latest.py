"""Latest-per-key and max-effective-key selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order_by`` (give a full tie-break).

    Written as ``row_number() == 1`` so Spark plans a partial WindowGroupLimit
    before the shuffle: each map task forwards at most one row per key, so a
    hot key costs one row per map task, not all of its rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def at_max(df: DataFrame, keys: Sequence[str], eff_col: str, where: Column | None = None) -> DataFrame:
    """All rows whose ``eff_col`` equals the per-key maximum (ties are kept).

    The maximum is a partial+final hash aggregate (hot keys are combined map
    side); the equi-join back is split by AQE's skew-join handling when one key
    dominates.
    """
    src = df if where is None else df.filter(where)
    mx = src.groupBy(*keys).agg(F.max(eff_col).alias("__max_eff"))
    return (src.join(mx, list(keys), "inner")
            .filter(F.col(eff_col) == F.col("__max_eff")).drop("__max_eff"))


def max_per_key(df: DataFrame, keys: Sequence[str], eff_col: str, out: str,
                where: Column | None = None) -> DataFrame:
    """Per-key maximum of ``eff_col`` (the pre-aggregated side of O6)."""
    src = df if where is None else df.filter(where)
    return src.groupBy(*keys).agg(F.max(eff_col).alias(out))


def preferred(df: DataFrame, key: str, code_col: str, codes: Sequence[str],
              tie_break: Sequence[Column] = (), where: Column | None = None) -> DataFrame:
    """One row per key: the row whose ``code_col`` comes first in ``codes``.

    ``codes`` is the preference order (earlier wins); rows with other codes are
    dropped. ``tie_break`` orders rows with the same code.
    """
    src = df.filter(F.col(code_col).isin(list(codes)))
    if where is not None:
        src = src.filter(where)
    rank = F.lit(len(codes))
    for i, c in reversed(list(enumerate(codes))):
        rank = F.when(F.col(code_col) == c, F.lit(i)).otherwise(rank)
    return latest_per_key(src, [key], [rank.asc(), *tie_break])
