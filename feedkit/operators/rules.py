"""Rule matching and flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.context import stage
from feedkit.functions.text import q
from feedkit.functions.text import s as sq
from feedkit.operators.asof import asof_cumulative
from feedkit.operators.latest import latest_per_key


def rules_with_attributes(rules: DataFrame, attrs: DataFrame, rule_key: str, attr_key: str,
                          attr_col: str, rule_cols: Sequence[str],
                          list_out: str = "attributes", flag_out: str = "no_atts_flag") -> DataFrame:
    """One row per rule: its attribute set (sorted, as an array) and a 1/0 "no attributes" flag."""
    a = attrs.select(F.col(attr_key).alias("__ak"), F.col(attr_col).alias("__av"))
    j = rules.join(a, F.col(rule_key) == F.col("__ak"), "left")
    return j.groupBy(*rule_cols).agg(
        F.array_sort(F.collect_set("__av")).alias(list_out),
        F.when(F.count("__av") == 0, F.lit(1)).otherwise(F.lit(0)).alias(flag_out))


#: Bands of one key that a value may be compared with one by one.
DIRECT_BANDS = 64


def band_match(left: DataFrame, rules: DataFrame, by: Sequence[tuple[str, str]], value: str,
               lo: str, hi: str, prefer: Sequence[tuple[str, str]], out: Mapping[str, str],
               direct: int = DIRECT_BANDS) -> DataFrame:
    """Attach the best rule whose band ``[lo, hi]`` contains ``value`` (left outer).

    ``by`` pairs left/rule equality keys; ``prefer`` lists ``(rule column,
    "asc"|"desc")`` sort keys (first candidate wins); ``out`` maps rule columns to
    output names. The match is computed once per *distinct* (by, value) of the
    left side and joined back on those columns, so no row id is needed, and a hot
    key costs nothing extra. A NULL value or key never matches.

    The rules are written once and counted by key. Where no key has more than ``direct``
    bands, values meet their key's bands in an equi-join with the band as a residual.
    Beyond, bands are taken apart into dyadic nodes (``_by_nodes``), which grows with the
    logarithm of the bands and not with their number. The result is the same.
    """
    lkeys = [lk for lk, _ in by]
    keys = [f"__rk{i}" for i in range(len(by))]
    needed = list(dict.fromkeys([*out.keys(), *[c for c, _ in prefer]]))
    rr = rules.select(*[F.col(rk).alias(k) for k, (_, rk) in zip(keys, by)], F.col(lo).alias("__lo"), F.col(hi).alias("__hi"),
                      *[F.col(c).alias(f"__o_{c}") for c in needed])
    for k in keys:
        rr = rr.filter(F.col(k).isNotNull())
    rr = stage(rr.filter(F.col("__lo") <= F.col("__hi")), "bands")
    order = [F.col(f"__o_{c}").desc_nulls_last() if d.lower() == "desc"
             else F.col(f"__o_{c}").asc_nulls_first() for c, d in prefer]
    dom = left.select(*[F.col(lk).alias(k) for k, lk in zip(keys, lkeys)], F.col(value).alias("__v")).distinct()
    for k in (*keys, "__v"):
        dom = dom.filter(F.col(k).isNotNull())
    most = rr.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= direct:
        found = dom.alias("d").join(rr.alias("r"), F.expr(" AND ".join(f"d.{k} = r.{k}" for k in keys) + " AND d.__v BETWEEN r.__lo AND r.__hi"))
        best = latest_per_key(found.select("d.*", *[F.col(f"r.__o_{c}") for c in needed]), [*keys, "__v"], order)
    else:
        best = _by_nodes(stage(dom, "values"), rr, keys, order, [f"__o_{c}" for c in needed])
    best = best.select(*[F.col(k).alias(f"__d{i}") for i, k in enumerate(keys)], F.col("__v").alias("__dv"),
                       *[F.col(f"__o_{c}").alias(o) for c, o in out.items()])
    jc = F.col(value) == F.col("__dv")
    for i, lk in enumerate(lkeys):
        jc = jc & (F.col(lk) == F.col(f"__d{i}"))
    return left.join(best, jc, "left").drop("__dv", *[f"__d{i}" for i in range(len(lkeys))])


def _by_nodes(dom: DataFrame, bands: DataFrame, keys: list[str], order: Sequence[Column], kept: list[str]) -> DataFrame:
    """``dom(keys, __v)`` with the best band's columns, values without a band left out.

    The ends of a key's bands are numbered in order by an as-of running total, which cuts hot keys by
    itself: end number r is slot 2r - 1, what lies between it and the next one is slot 2r. A band is a
    range of slots, which falls into at most two aligned blocks (nodes) of each power of two. Each node
    keeps its best band; a value looks at the one node of each size that its slot lies in.
    """
    ends = bands.select(*keys, F.col("__lo").alias("__q")).union(bands.select(*keys, "__hi")).distinct()
    asked = ends.withColumn("__end", F.lit(1)).unionByName(dom.select(*keys, F.col("__v").alias("__q"), F.lit(0).alias("__end")))
    asked = asked.groupBy(*keys, "__q").agg(F.max("__end").alias("__end"))
    ranks = asof_cumulative(asked, ends.withColumn("__one", F.lit(1)), keys, keys, "__q", "__q", "__one", "__r", default=0)
    slots = stage(ranks.select(*keys, "__q", (2 * F.col("__r") - F.col("__end")).cast("long").alias("__slot")), "slots")

    def located(rows: DataFrame, column: str, name: str) -> DataFrame:
        return rows.join(slots.select(*keys, F.col("__q").alias(column), F.col("__slot").alias(name)), [*keys, column])

    held = located(located(bands, "__lo", "__a"), "__hi", "__z")
    # At size 2^l the band covers blocks from __f up to __t, __t left out; an odd one at either end has no whole parent.
    nodes = held.withColumn("__l", F.explode(F.expr("sequence(0, length(bin(__z + 1)))")))
    nodes = nodes.withColumn("__f", F.expr("shiftright(__a + shiftleft(1L, __l) - 1, __l)")).withColumn("__t", F.expr("shiftright(__z + 1, __l)"))
    nodes = nodes.filter("__f < __t").withColumn("__node", F.explode(F.expr(
        "filter(array(IF(__f % 2 = 1, __f, NULL), IF(__t % 2 = 1, __t - 1, NULL)), x -> x IS NOT NULL)")))
    best = latest_per_key(nodes, [*keys, "__l", "__node"], order).select(*keys, "__l", "__node", *kept)
    top = (slots.agg(F.max("__slot")).first()[0] or 0).bit_length()
    looks = located(dom, "__v", "__slot").withColumn("__l", F.explode(F.expr(f"sequence(0, {top})")))
    looks = looks.withColumn("__node", F.expr("shiftright(__slot, __l)")).drop("__slot")
    return latest_per_key(looks.join(best, [*keys, "__l", "__node"]), [*keys, "__v"], order)


def code_flags(df: DataFrame, key: str, code_col: str, flags: Mapping[str, Sequence[str]],
               where: Column | None = None, yes: str = "1", no: str = "0") -> DataFrame:
    """Per key, ``yes`` if any row's code is in each flag's set, else ``no`` (one pass)."""
    src = df if where is None else df.filter(where)
    aggs = [F.expr(f"max(CASE WHEN {q(code_col)} IN ({', '.join(sq(c) for c in codes)}) THEN {sq(yes)} "
                   f"ELSE {sq(no)} END)").alias(name)
            for name, codes in flags.items()]
    return src.groupBy(key).agg(*aggs)


def presence_flag(df: DataFrame, other: DataFrame, on: tuple[str, str], out: str,
                  yes: object = "1", no: object = "0") -> DataFrame:
    """Add ``out`` = ``yes`` when ``df[on[0]]`` appears in ``other[on[1]]``, else ``no``."""
    keys = other.select(F.col(on[1]).alias("__pk")).distinct().withColumn("__hit", F.lit(True))
    j = df.join(keys, F.col(on[0]) == F.col("__pk"), "left")
    flag = F.when(F.col("__hit").isNotNull(), F.lit(yes)).otherwise(F.lit(no))
    return j.withColumn(out, flag).drop("__pk", "__hit")
