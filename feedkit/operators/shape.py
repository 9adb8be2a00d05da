"""Reshaping operators: cohorts, fallbacks, winners, overrides, pivots, lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.functions.text import q
from feedkit.functions.text import s as sq
from feedkit.operators.latest import latest_per_key


def union_cohorts(cohorts: Mapping[int, DataFrame], tag: str = "grp_num") -> DataFrame:
    """Tag each cohort, union by name and de-duplicate over the whole union.

    The tag keeps the same person in two cohorts as two rows (UNION semantics).
    """
    items = list(cohorts.items())
    out = None
    for t, df in items:
        d = df.select(F.lit(t).alias(tag), *[F.col(f"`{c}`") for c in df.columns if c != tag])
        out = d if out is None else out.unionByName(d)
    return out.distinct()


def first_available(*cols: Column) -> Column:
    """First non-NULL of the candidate columns, in order."""
    return F.coalesce(*cols)


def season_winner(sources: Sequence[DataFrame], key: str, group: str, term: str,
                  within: Sequence[Sequence[Column]] | None = None, src_col: str = "src") -> DataFrame:
    """Top row per (key, group) in each source, then across sources by term desc, source asc.

    ``within[i]`` orders rows inside source ``i``; with ``within=None`` the
    sources are already one row per (key, group). All sources share columns;
    the 1-based source index is added as ``src_col``.
    """
    tops = []
    for i, df in enumerate(sources, start=1):
        top = df if within is None else latest_per_key(df, [key, group], list(within[i - 1]))
        tops.append(top.withColumn(src_col, F.lit(i)))
    u = tops[0]
    for t in tops[1:]:
        u = u.unionByName(t)
    return latest_per_key(u, [key, group], [F.col(term).desc_nulls_last(), F.col(src_col).asc()])


def apply_override(df: DataFrame, overrides: DataFrame, on: Sequence[tuple[str, str]], col: str,
                   override_col: str, codes: Sequence[str], default: str) -> DataFrame:
    """Replace ``col`` values in ``codes`` by the matching override (else ``default``).

    Left join on ``on`` pairs; other values pass through unchanged. Duplicate
    override rows fan out (the reference does not de-duplicate them).
    """
    ov = overrides.select(*[F.col(r).alias(f"__ov{i}") for i, (_, r) in enumerate(on)],
                          F.col(override_col).alias("__ovv"))
    jc = None
    for i, (lcol, _) in enumerate(on):
        c = F.col(lcol) == F.col(f"__ov{i}")
        jc = c if jc is None else jc & c
    j = df.join(ov, jc, "left")
    new = F.when(F.col(col).isin(list(codes)), F.coalesce(F.col("__ovv"), F.lit(default))).otherwise(F.col(col))
    return j.withColumn(col, new).drop(*[f"__ov{i}" for i in range(len(on))], "__ovv")


def pivot_first(df: DataFrame, key: str, on: str, values: Mapping[str, str],
                measures: Mapping[str, str]) -> DataFrame:
    """``MAX(CASE WHEN on = v THEN m END)`` for every (value, measure): one aggregate pass.

    ``values`` maps pivot values to column prefixes, ``measures`` maps measure
    columns to suffixes; output columns are ``prefix + suffix``.
    """
    aggs = [F.expr(f"max(CASE WHEN {q(on)} = {sq(v)} THEN {q(m)} END)").alias(f"{p}{s}")
            for v, p in values.items() for m, s in measures.items()]
    return df.groupBy(key).agg(*aggs)


def ordered_list(df: DataFrame, keys: Sequence[str], value: Column, order: Sequence[str],
                 sep: str = ";", out: str = "items") -> DataFrame:
    """``LISTAGG(value, sep) WITHIN GROUP (ORDER BY order...)`` per key, duplicates kept.

    Sort keys ascend with NULLs first, as in Spark SQL. Partial lists are built
    map side and merged per key.
    """
    item = F.struct(*[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)], value.alias("__v"))
    agg = F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda s: s["__v"]), sep)
    return df.groupBy(*keys).agg(agg.alias(out))


def with_rows(df: DataFrame, rows: Sequence[Sequence[object]], distinct: bool = True) -> DataFrame:
    """Append fixed configuration rows (same column order as ``df``), UNION-distinct by default.

    Values are cast to the columns' types, so plain Python ints fit decimal keys.
    """
    spark: SparkSession = df.sparkSession
    fields = df.schema.fields
    out = df
    for r in rows:
        one = spark.range(1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, fields)])
        out = out.unionByName(one)
    return out.distinct() if distinct else out
