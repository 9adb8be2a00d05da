"""Reporting-period resolution.

A *period table* has one row per period code with ``code`` (fixed-width string,
ordered lexicographically), ``year`` (its reporting-year code), ``start_date`` and
``end_date``. Period tables are calendar-sized (a few rows per year), so joins to
them are joined as they are: their size grows with elapsed time, never with the data.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERIOD_COLS = ("code", "year", "start_date", "end_date")


def _lit(x: Any) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def current_period(periods: DataFrame, as_of: Any, rule: str = "earliest_open",
                   floor: str | None = None, suffix: str | None = None,
                   suffix_pos: int = 6, out: str = "period_code") -> DataFrame:
    """One-row DataFrame holding the current period code (NULL when none).

    ``earliest_open``: the smallest code whose end date is on/after ``as_of``
    (and above ``floor`` when given).
    ``latest_started``: the largest code that started on/before ``as_of`` whose
    character at ``suffix_pos`` equals ``suffix`` (when given).
    """
    as_of = _lit(as_of)
    p = periods
    if rule == "earliest_open":
        cond = F.col("end_date") >= as_of
        if floor is not None:
            cond = cond & (F.col("code") > F.lit(floor))
        agg = F.min("code")
    elif rule == "latest_started":
        cond = as_of >= F.col("start_date")
        agg = F.max("code")
    else:
        raise ValueError(f"unknown rule {rule!r}")
    if suffix is not None:
        cond = cond & (F.substring("code", suffix_pos, len(suffix)) == suffix)
    return p.filter(cond).agg(agg.alias(out))


def next_period(periods: DataFrame, as_of: Any, suffix: str | None = "0",
                out: str = "period_code") -> DataFrame:
    """Smallest code that starts strictly after ``as_of`` (ending in ``suffix``)."""
    cond = F.col("start_date") > _lit(as_of)
    if suffix is not None:
        cond = cond & F.col("code").endswith(suffix)
    return periods.filter(cond).agg(F.min("code").alias(out))


def run_params(periods: DataFrame, as_of: Any, floor: str | None = None) -> DataFrame:
    """One row: current period (earliest open), its year and the next year code.

    Each code's year and whether it is open come from one aggregate over the calendar; the least open
    code brings its year with it. The next year is the least one above, a scalar subquery: no window, no join.
    """
    open_ = F.col("end_date") >= _lit(as_of)
    if floor is not None:
        open_ = open_ & (F.col("code") > F.lit(floor))
    codes = periods.groupBy("code").agg(F.min("year").alias("year"), F.max(open_).alias("open"))
    first = codes.filter("open").agg(F.min(F.struct("code", "year")).alias("first")).select(
        F.col("first.code").alias("period_code"), F.col("first.year").alias("period_year"))
    later = periods.filter(F.col("year") > first.select("period_year").scalar()).agg(F.min("year").alias("next_year"))
    return first.withColumn("next_year", later.scalar())


def collect_one(df: DataFrame) -> dict[str, Any]:
    """Collect a one-row parameter relation to Python literals.

    Literals let Catalyst push parameter comparisons into parquet scans. Only
    ever used on aggregates that return exactly one row.
    """
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one parameter row, got {len(rows)}")
    return rows[0].asDict()


def year_of(periods: DataFrame) -> DataFrame:
    """``code -> year`` lookup, one row per code (smallest year on duplicates)."""
    return periods.groupBy("code").agg(F.min("year").alias("year"))


def floor_period(df: DataFrame, col: str, current: Any, periods: DataFrame,
                 out_term: str, out_year: str, default_year: str = "0000") -> DataFrame:
    """Raise ``col`` to ``current`` when below it (NULL stays NULL) and add its year.

    The year comes from the period table, ``default_year`` when the code is unknown.
    """
    cur = _lit(current)
    floored = F.when(F.col(col) < cur, cur).otherwise(F.col(col))
    lk = year_of(periods).select(F.col("code").alias("__fp_code"), F.col("year").alias("__fp_year"))
    out = df.withColumn(out_term, floored)
    out = out.join(lk, F.col(out_term) == F.col("__fp_code"), "left")
    return (out.withColumn(out_year, F.coalesce(F.col("__fp_year"), F.lit(default_year)))
            .drop("__fp_code", "__fp_year"))
