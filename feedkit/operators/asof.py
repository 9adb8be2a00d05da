"""As-of lookup and as-of running totals.

For each left row, find the right row with the same ``by`` keys whose
effective key is the greatest one ``<=`` the left row's key. This is the
correlated ``MAX(eff) WHERE eff <= x`` / lateral ``ORDER BY eff DESC LIMIT 1``
shape, re-expressed as one sort-based window sweep instead of a nested-loop
join: left and right rows are unioned, sorted by (key, side) inside each
``by`` partition, and every left row takes the last right row seen so far. A
running total is the same sweep with a sum in place of the last row.

The unioned rows are written once, so both inputs are evaluated once, whatever
they are made of. Keys with more than ``hot_rows`` rows are found by a count over
the written rows and split by themselves: a sorted sample of the key's rows
gives the cuts, each stretch between two cuts is swept on its own, and one carry
row per stretch hands on what came before it (a two-level prefix sum for totals).
Other keys cost nothing extra; where no key is hot, no cuts are made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedkit.context import stage
from feedkit.operators.latest import latest_per_key

#: Rows of one key that a task sweeps; beyond it the key is cut.
HOT_ROWS = 2_000_000
#: Sampled rows for each stretch of a hot key.
SAMPLED = 64


def _cuts(rows: DataFrame, byc: list[str], hot_rows: int) -> DataFrame | None:
    """``(by, __cuts)``: the sorted keys at which each hot key's rows are cut, or None where no key is hot.

    A hot key has more than ``hot_rows`` rows, so there are at most as many as that number goes into all rows.
    """
    if rows.count() <= hot_rows:  # of the written rows: read from the files' footers
        return None
    known = rows.filter(~F.greatest(*[F.col(c).isNull() for c in (*byc, "__k")]))
    hot = stage(known.groupBy(*byc).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows), "hot")
    if hot.isEmpty():
        return None
    sample = known.join(hot, byc).filter(F.rand(20) < F.lit(float(SAMPLED)) / F.least(F.lit(hot_rows), F.col("__n")))
    cuts = sample.groupBy(*byc).agg(F.expr(
        f"array_distinct(filter(array_sort(collect_list(__k)), (x, i) -> i % {SAMPLED} = {SAMPLED - 1}))").alias("__cuts"))
    return stage(cuts, "cuts")


def _sweep(left: DataFrame, events: DataFrame, byc: list[str], total: bool, hot_rows: int) -> DataFrame:
    """Core sweep over ``left(by, __k, __l)`` and ``events(by, __k, __v)``.

    Returns the left rows with ``__m``: the sum of ``__v`` over the key's events up to ``__k`` (``total``),
    or else the last event's ``__v``, for which events must be unique per (by, __k).
    """
    left = left.withColumn("__side", F.lit(1))
    rows = stage(events.withColumn("__side", F.lit(0)).unionByName(left, allowMissingColumns=True), "sweep")
    cuts = _cuts(rows, byc, hot_rows)
    # Left rows with a missing key match nothing; they are spread instead of meeting in one group.
    missing = (F.col("__side") == 1) & F.greatest(*[F.col(c).isNull() for c in (*byc, "__k")])
    rows = rows.withColumn("__s", F.when(missing, F.pmod(F.xxhash64("__l"), F.lit(64)) + 1).otherwise(F.lit(0).cast("long")))
    part = [*byc, "__s"]
    if cuts is not None:
        part.append("__b")
        rows = rows.join(cuts, byc, "left").withColumn(
            "__b", F.expr("greatest(0, coalesce(size(filter(__cuts, x -> x <= __k)), 0))")).drop("__cuts")
        stretches = cuts.select(*byc, F.explode(F.expr("sequence(0, size(__cuts))")).alias("__b"))
        of_hot = rows.filter(F.col("__side") == 0).join(cuts.select(*byc), byc, "left_semi")
        value = F.sum("__v") if total else F.max_by("__v", "__k")
        summary = of_hot.groupBy(*byc, "__b").agg(value.alias("__v"))
        earlier = Window.partitionBy(*byc).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)  # a row per stretch
        before = F.sum("__v").over(earlier) if total else F.last("__v", ignorenulls=True).over(earlier)
        carry = (stretches.join(summary, [*byc, "__b"], "left").withColumn("__v", before).filter(F.col("__v").isNotNull())
                 .withColumn("__side", F.lit(0)).withColumn("__s", F.lit(0).cast("long")))
        rows = rows.unionByName(carry, allowMissingColumns=True)
    w = (Window.partitionBy(*part).orderBy(F.col("__k").asc_nulls_first(), F.col("__side"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = F.sum("__v").over(w) if total else F.last("__v", ignorenulls=True).over(w)
    return rows.withColumn("__m", found).filter(F.col("__side") == 1)


def _sides(left: DataFrame, right: DataFrame, left_by: Sequence[str], right_by: Sequence[str], left_on: str,
           right_on: str, value: Column) -> tuple[DataFrame, DataFrame, list[str]]:
    byc = [f"__by{i}" for i in range(len(left_by))]
    whole = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    lft = left.select(*[F.col(c).alias(b) for c, b in zip(left_by, byc)], F.col(left_on).alias("__k"), whole.alias("__l"))
    for c in (*right_by, right_on):
        right = right.filter(F.col(c).isNotNull())
    events = right.select(*[F.col(c).alias(b) for c, b in zip(right_by, byc)], F.col(right_on).alias("__k"), value.alias("__v"))
    return lft, events, byc


def asof_join(left: DataFrame, right: DataFrame, left_by: Sequence[str], right_by: Sequence[str],
              left_on: str, right_on: str, payload: Sequence[str],
              tie_break: Sequence[Column] = (), ties: str = "first", how: str = "left",
              eff_out: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Attach to each left row the right row with the greatest ``right_on <= left_on``.

    ``ties``: ``first`` keeps one right row per (by, key) using ``tie_break``
    (default: payload descending); ``all`` keeps every right row at the matched
    key (fan-out, like ``eff = (SELECT MAX(eff) ...)``); ``unique`` promises the
    right side is already unique per (by, key).
    ``how``: ``left`` keeps unmatched left rows with NULL payload; ``inner`` drops them.
    ``eff_out`` names an output column holding the matched right key.
    NULL keys never match, on either side.
    """
    item = F.struct(*[F.col(p).alias(p) for p in payload])
    if ties == "all":
        # One event per key holds all its rows, so nothing is joined back.
        value = F.struct(F.col(right_on).alias("__eff"), F.col("__items"))
        for c in (*right_by, right_on):
            right = right.filter(F.col(c).isNotNull())
        right = right.groupBy(*right_by, right_on).agg(F.collect_list(item).alias("__items"))
    elif ties == "first":
        order = list(tie_break) or [F.col(p).desc_nulls_last() for p in payload]
        right = latest_per_key(right, [*right_by, right_on], order) if order else right.select(*right_by, right_on).distinct()
    elif ties != "unique":
        raise ValueError(f"unknown ties mode {ties!r}")
    if ties != "all":
        value = F.struct(F.col(right_on).alias("__eff"), item.alias("__item")) if payload else F.struct(F.col(right_on).alias("__eff"))
    lft, events, byc = _sides(left, right, left_by, right_by, left_on, right_on, value)
    m = _sweep(lft, events, byc, False, hot_rows)
    if how == "inner":
        m = m.filter(F.col("__m").isNotNull())
    if ties == "all":
        m = m.select("__l", "__m", F.explode_outer("__m.__items").alias("__item"))
    else:
        m = m.select("__l", "__m", *([F.col("__m.__item").alias("__item")] if payload else []))
    extra = [F.col(f"__item.{p}").alias(p) for p in payload]
    if eff_out:
        extra.append(F.col("__m.__eff").alias(eff_out))
    return m.select(*[F.col(f"__l.`{c}`").alias(c) for c in left.columns], *extra)


def asof_cumulative(left: DataFrame, facts: DataFrame, left_by: Sequence[str], fact_by: Sequence[str],
                    left_on: str, fact_on: str, value: str | Column, out: str,
                    default: object | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Running total of ``value`` per ``by`` read at the greatest fact key ``<= left_on``.

    Equals ``SUM(value) WHERE by = left.by AND fact_on <= left_on``; ``default``
    replaces the NULL of "no fact yet" (or all-NULL values). Facts and questions go
    through one sweep; no table of totals is joined.
    """
    v = F.col(value) if isinstance(value, str) else value
    lft, events, byc = _sides(left, facts, left_by, fact_by, left_on, fact_on, v)
    total = F.col("__m") if default is None else F.coalesce(F.col("__m"), F.lit(default))
    m = _sweep(lft, events, byc, True, hot_rows)
    return m.select(*[F.col(f"__l.`{c}`").alias(c) for c in left.columns], total.alias(out))
