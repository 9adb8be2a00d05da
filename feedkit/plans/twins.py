"""Operator twins on the driver testdata: one query per operator of the inventory.

Each ``q_*`` takes ``(spark, sf_dir)`` and returns a lazy DataFrame built from
the library's operators over whole tables. The matching DuckDB SQL lives in
:mod:`feedkit.plans.oracle_sql` under the same name; column names agree.
Dates and timestamps are rendered as text and money as DECIMAL(18,2) so both
engines produce identical values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.functions import text as T
from feedkit.operators import asof, changes, latest, periods as P, render, rules, shape
from feedkit.sources.testdata import AS_OF, PERIOD_FLOOR, Testdata, fmt_day, fmt_ts, term_of

MONEY = "decimal(18,2)"


# -- O1-O4: periods -------------------------------------------------------------------------

def q_current_period_open(spark: SparkSession, sf: str) -> DataFrame:
    return P.current_period(Testdata(spark, sf).periods(), AS_OF, "earliest_open", floor=PERIOD_FLOOR)


def q_current_period_started(spark: SparkSession, sf: str) -> DataFrame:
    return P.current_period(Testdata(spark, sf).periods(), AS_OF, "latest_started", suffix="0")


def q_next_period(spark: SparkSession, sf: str) -> DataFrame:
    return P.next_period(Testdata(spark, sf).periods(), AS_OF, suffix="0")


def q_run_params(spark: SparkSession, sf: str) -> DataFrame:
    return P.run_params(Testdata(spark, sf).periods(), AS_OF, floor=PERIOD_FLOOR)


# -- O5, O6: latest / max effective ---------------------------------------------------------

def q_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    o = Testdata(spark, sf).orders
    top = latest.latest_per_key(o, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return top.select("o_custkey", "o_orderkey", fmt_day("o_orderdate").alias("o_orderdate"), "o_orderstatus")


def q_at_max(spark: SparkSession, sf: str) -> DataFrame:
    o = Testdata(spark, sf).orders.select("o_custkey", "o_orderkey", term_of("o_orderdate").alias("period_code"))
    return latest.at_max(o, ["o_custkey"], "period_code")


# -- O7, O8: as-of ----------------------------------------------------------------------------

def _lines(td: Testdata) -> DataFrame:
    return td.order_lines().select("l_orderkey", "l_linenumber", "l_shipdate", "custkey")


def q_asof_join(spark: SparkSession, sf: str) -> DataFrame:
    td = Testdata(spark, sf)
    right = td.orders.select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("asof_orderkey"))
    m = asof.asof_join(_lines(td), right, ["custkey"], ["o_custkey"], "l_shipdate", "o_orderdate",
                       payload=["asof_orderkey"], tie_break=[F.desc("asof_orderkey")],
                       eff_out="asof_date")
    return m.select("l_orderkey", "l_linenumber", fmt_day("l_shipdate").alias("l_shipdate"), "custkey",
                    "asof_orderkey", fmt_day("asof_date").alias("asof_orderdate"))


def q_asof_cumulative(spark: SparkSession, sf: str) -> DataFrame:
    td = Testdata(spark, sf)
    facts = td.orders.select("o_custkey", "o_orderdate", F.col("o_totalprice").cast(MONEY).alias("amt"))
    m = asof.asof_cumulative(_lines(td), facts, ["custkey"], ["o_custkey"], "l_shipdate", "o_orderdate",
                             "amt", "cum_total", default=0)
    return m.select("l_orderkey", "l_linenumber", fmt_day("l_shipdate").alias("l_shipdate"), "custkey",
                    F.col("cum_total").cast(MONEY).alias("cum_total"))


# -- O9-O12: rules and flags ------------------------------------------------------------------

def _band_rules(td: Testdata) -> DataFrame:
    s = td.supplier.join(td.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    r = s.select(F.col("s_suppkey").alias("seq"), F.col("s_name").alias("clas_code"),
                 F.col("n_regionkey").alias("levl"), (F.col("s_acctbal") - 2000.0).alias("lo"),
                 (F.col("s_acctbal") + 2000.0).alias("hi"))
    lp = td.lineitem.join(td.part, F.col("l_partkey") == F.col("p_partkey"))
    # Every line is read; only lines of large discounted quantities carry an attribute code.
    code = F.when((F.col("l_quantity") >= 50) & (F.col("l_discount") >= 0.1), F.col("p_brand"))
    attrs = lp.select(F.col("l_suppkey").alias("seq"), code.alias("att")).distinct()
    return rules.rules_with_attributes(r, attrs, "seq", "seq", "att", ["seq", "clas_code", "levl", "lo", "hi"])


def q_rules_with_attributes(spark: SparkSession, sf: str) -> DataFrame:
    r = _band_rules(Testdata(spark, sf))
    return r.select("seq", "clas_code", "levl", "lo", "hi",
                    F.array_join("attributes", ";").alias("attributes"), "no_atts_flag")


def q_band_match(spark: SparkSession, sf: str) -> DataFrame:
    td = Testdata(spark, sf)
    cust = td.customer.join(td.nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .select("c_custkey", F.col("n_regionkey").alias("levl"), "c_acctbal")
    m = rules.band_match(cust, _band_rules(td), [("levl", "levl")], "c_acctbal", "lo", "hi",
                         prefer=[("no_atts_flag", "desc"), ("clas_code", "asc")],
                         out={"clas_code": "band_code"})
    return m.select("c_custkey", "band_code")


def _line_codes(td: Testdata) -> DataFrame:
    return td.order_lines().withColumn("code", F.concat("l_returnflag", "l_linestatus"))


# Flag sets of the twin (analogs of the hold-code flag sets).
LINE_FLAGS = {"flag_returned": ["RO", "RF"], "flag_accepted_open": ["AO"], "flag_other": ["NF", "NO", "AF"]}


def q_code_flags(spark: SparkSession, sf: str) -> DataFrame:
    td = Testdata(spark, sf)
    return rules.code_flags(_line_codes(td), "custkey", "code", LINE_FLAGS,
                            where=T.still_active("l_shipdate", F.lit(AS_OF)))


def q_presence_flag(spark: SparkSession, sf: str) -> DataFrame:
    td = Testdata(spark, sf)
    urgent = td.orders.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P"))
    recent = td.order_lines().filter((F.col("l_returnflag") == "R") & (F.col("l_shipdate") > F.lit(AS_OF)))
    c = td.customer.select("c_custkey")
    c = rules.presence_flag(c, urgent, ("c_custkey", "o_custkey"), "urgent_flag", yes="Y", no=None)
    return rules.presence_flag(c, recent, ("c_custkey", "custkey"), "recent_return", yes="1", no="0")


# -- O13-O15: change detection ----------------------------------------------------------------

def _control(td: Testdata) -> DataFrame:
    """Control analog: per customer, last 'F' order = last time sent."""
    f = td.orders.filter(F.col("o_orderstatus") == "F")
    return f.groupBy(F.col("o_custkey").alias("ctl_custkey")).agg(
        F.max("o_orderdate").alias("last_sent"), F.max(F.year("o_orderdate").cast("string")).alias("last_year"))


def _changed(td: Testdata) -> DataFrame:
    pending = td.orders.filter(F.col("o_orderstatus") == "P")
    returns = td.order_lines().filter(F.col("l_returnflag") == "R")
    return changes.changed_since(_control(td), "ctl_custkey", "last_sent",
                                 {"pending": (pending, "o_custkey", "o_orderdate"),
                                  "returns": (returns, "custkey", "l_shipdate")})


def q_changed_since(spark: SparkSession, sf: str) -> DataFrame:
    ch = _changed(Testdata(spark, sf))
    return ch.select(F.col("ctl_custkey").alias("custkey"), fmt_day("last_sent").alias("last_sent"))


def _open_orders(td: Testdata, current: str = "199820") -> DataFrame:
    """Orders of the current period or later, with the period's year attached."""
    o = td.orders.select("o_orderkey", "o_custkey", "o_orderstatus", term_of("o_orderdate").alias("period_code"))
    o = o.filter(F.col("period_code") >= current)
    yr = P.year_of(td.periods()).select(F.col("code").alias("__c"), F.col("year").alias("period_year"))
    return o.join(yr, F.col("period_code") == F.col("__c")).drop("__c")


def _not_sent(td: Testdata) -> DataFrame:
    ctl = _control(td)
    return changes.not_sent(_open_orders(td), ctl, ("o_custkey", "ctl_custkey"),
                            cond=F.col("last_year") >= F.col("period_year"))


def q_not_sent(spark: SparkSession, sf: str) -> DataFrame:
    return _not_sent(Testdata(spark, sf)).select("o_orderkey", "o_custkey", "period_code", "period_year")


def _returns_by_year(td: Testdata) -> DataFrame:
    yr = P.year_of(td.periods()).select(F.col("code").alias("__c"), F.col("year").alias("ret_year"))
    r = td.order_lines().filter(F.col("l_returnflag") == "R").select("custkey", term_of("l_shipdate").alias("t"))
    return r.join(yr, F.col("t") == F.col("__c")).select("custkey", "ret_year")


def _excluded(td: Testdata) -> DataFrame:
    return changes.exclude_same_year(_open_orders(td), _returns_by_year(td), ("o_custkey", "custkey"),
                                     ("period_year", "ret_year"))


def q_exclude_same_year(spark: SparkSession, sf: str) -> DataFrame:
    return _excluded(Testdata(spark, sf)).select("o_orderkey", "o_custkey", "period_code", "period_year")


# -- O16-O27: cohorts, enrichment, seasons, pivots, floors ------------------------------------

def _cohorts(td: Testdata) -> DataFrame:
    c1 = _not_sent(td).select(F.col("o_custkey").alias("custkey"), F.col("period_code").alias("pulled_term"))
    c2 = _changed(td).select(F.col("ctl_custkey").alias("custkey"), term_of("last_sent").alias("pulled_term"))
    c3 = _excluded(td).filter(F.col("o_orderstatus") == "O") \
        .select(F.col("o_custkey").alias("custkey"), F.col("period_code").alias("pulled_term"))
    reg = td.order_lines().filter(F.col("l_linestatus") == "O").withColumn("t", term_of("o_orderdate"))
    c4 = reg.filter(F.col("t") >= "199820").groupBy("custkey").agg(F.min("t").alias("pulled_term"))
    return shape.union_cohorts({1: c1, 2: c2, 3: c3, 4: c4}, tag="grp_num")


def q_cohort_union(spark: SparkSession, sf: str) -> DataFrame:
    return _cohorts(Testdata(spark, sf))


def _enroll_terms(td: Testdata) -> DataFrame:
    o = td.orders.withColumn("t", term_of("o_orderdate"))
    t1 = (o.filter((F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
          .groupBy("o_custkey").agg(F.max("t").alias("term1")))
    t2 = o.groupBy("o_custkey").agg(F.max_by("t", "o_orderkey").alias("term2"))
    c = td.customer.select("c_custkey")
    c = c.join(t1, F.col("c_custkey") == t1["o_custkey"], "left").drop("o_custkey")
    c = c.join(t2, F.col("c_custkey") == t2["o_custkey"], "left").drop("o_custkey")
    return c.withColumn("enroll_term", shape.first_available(F.col("term1"), F.col("term2")))


def q_first_available(spark: SparkSession, sf: str) -> DataFrame:
    return _enroll_terms(Testdata(spark, sf))


def q_enrich(spark: SparkSession, sf: str) -> DataFrame:
    td = Testdata(spark, sf)
    base = _cohorts(td)
    geo = td.customer.join(td.nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .join(td.region, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "n_name", "r_name")
    last = latest.latest_per_key(td.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]) \
        .select(F.col("o_custkey").alias("__lk"), F.col("o_orderkey").alias("latest_orderkey"))
    flags = rules.code_flags(_line_codes(td), "custkey", "code", LINE_FLAGS,
                             where=T.still_active("l_shipdate", F.lit(AS_OF))) \
        .select(F.col("custkey").alias("__fk"), "flag_returned")
    enr = _enroll_terms(td).select(F.col("c_custkey").alias("__ek"), "enroll_term")
    e = (base.join(geo, F.col("custkey") == F.col("c_custkey"), "left").drop("c_custkey")
         .join(last, F.col("custkey") == F.col("__lk"), "left").drop("__lk")
         .join(flags, F.col("custkey") == F.col("__fk"), "left").drop("__fk")
         .join(enr, F.col("custkey") == F.col("__ek"), "left").drop("__ek")
         .withColumn("flag_returned", F.coalesce("flag_returned", F.lit("0"))))
    # Second-stage lookup on the derived enrollment term.
    adv = latest.latest_per_key(td.orders.withColumn("t", term_of("o_orderdate")), ["o_custkey", "t"],
                                [F.desc("o_orderdate"), F.desc("o_orderkey")]) \
        .select(F.col("o_custkey").alias("__ak"), F.col("t").alias("__at"),
                F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("adviser"))
    e = e.join(adv, (F.col("custkey") == F.col("__ak")) & (F.col("enroll_term") == F.col("__at")), "left")
    return e.drop("__ak", "__at")


PDATE = "MM/dd/yyyy hh:mm:ss a"


def _season_winners(td: Testdata) -> DataFrame:
    a = td.orders.select(F.col("o_custkey").alias("pidm"), term_of("o_orderdate").alias("term"),
                         F.col("o_orderstatus").alias("camp"),
                         F.date_format("o_orderdate", PDATE).alias("pdate"), "o_orderkey")
    a = a.withColumn("suffix", T.season_suffix("term"))
    b = td.order_lines().select(F.col("custkey").alias("pidm"), term_of("l_shipdate").alias("term"),
                                F.when(F.col("l_returnflag") == "N", F.lit("M"))
                                .otherwise(F.col("l_returnflag")).alias("camp"))
    b = b.withColumn("suffix", T.season_suffix("term")).withColumn("pdate", F.lit(None).cast("string"))
    cols = ["pidm", "suffix", "term", "camp", "pdate"]
    top_a = latest.latest_per_key(a, ["pidm", "suffix"],
                                  [F.desc("term"), F.asc("pdate"), F.asc("o_orderkey")]).select(*cols)
    top_b = latest.latest_per_key(b, ["pidm", "suffix"], [F.desc("term"), F.asc("camp")]).select(*cols)
    return shape.season_winner([top_a, top_b], "pidm", "suffix", "term")


def q_season_winner(spark: SparkSession, sf: str) -> DataFrame:
    return _season_winners(Testdata(spark, sf))


def _overridden(td: Testdata) -> DataFrame:
    returned = td.lineitem.filter(F.col("l_returnflag") == "R").select("l_orderkey")
    ov = td.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")) \
        .join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    ov = ov.select(F.col("o_custkey").alias("ov_pidm"), term_of("o_orderdate").alias("ov_term"),
                   F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("A"))
                   .when(F.col("o_orderpriority") == "2-HIGH", F.lit("M")).otherwise(F.lit("X")).alias("rs_camp"))
    w = _season_winners(td).drop("src")
    return shape.apply_override(w, ov, [("pidm", "ov_pidm"), ("term", "ov_term")], "camp", "rs_camp",
                                ["P", "R"], "M")


def q_override(spark: SparkSession, sf: str) -> DataFrame:
    return _overridden(Testdata(spark, sf))


SEASONS = {"10": "t10_", "20": "t20_", "30": "t30_", "40": "t40_"}


def q_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return shape.pivot_first(_overridden(Testdata(spark, sf)), "pidm", "suffix", SEASONS,
                             {"term": "term", "camp": "camp", "pdate": "pdate"})


def q_floor_period(spark: SparkSession, sf: str) -> DataFrame:
    td = Testdata(spark, sf)
    li = td.lineitem.select("l_orderkey", "l_linenumber",
                            F.nullif(term_of("l_shipdate"), F.lit("199930")).alias("pulled_term"))
    return P.floor_period(li, "pulled_term", "199820", td.periods(), "tmpPulledTerm", "tmpTermACYR")


# -- O28-O33: text columns, lists, preferred ------------------------------------------------

def _phone_parts(o: DataFrame) -> DataFrame:
    area = (F.when(F.col("o_totalprice") < 50000, F.lit(None))
            .when(F.col("o_totalprice") < 100000, F.lit("0"))
            .when(F.col("o_totalprice") < 300000, F.substring(F.lpad(F.col("o_custkey").cast("string"), 4, "0"), 2, 3))
            .otherwise(F.col("o_custkey").cast("string")))
    number = (F.when(F.col("o_orderstatus") == "O", F.lpad(F.col("o_orderkey").cast("string"), 7, "0"))
              .when(F.col("o_totalprice") < 20000, F.lit("0"))
              .otherwise(F.col("o_orderkey").cast("string")))
    return o.withColumn("area", area).withColumn("number", number)


def q_phone(spark: SparkSession, sf: str) -> DataFrame:
    o = _phone_parts(Testdata(spark, sf).orders)
    return o.select("o_orderkey", T.format_phone("area", "number", 12).alias("phone12"),
                    T.format_phone("area", "number", 25).alias("phone25"))


def _lines23(o: DataFrame) -> DataFrame:
    l2 = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None))
          .when(F.col("o_orderpriority") == "2-HIGH", F.lit("0"))
          .otherwise(F.concat(F.lit("Suite "), F.col("o_orderpriority"))))
    l3 = (F.when(F.col("o_totalprice") < 100000, F.lit(None))
          .when(F.col("o_totalprice") < 200000, F.lit("0"))
          .otherwise(F.concat(F.lit("Floor "), F.col("o_custkey").cast("string"))))
    return o.withColumn("line2", l2).withColumn("line3", l3)


def q_join_lines(spark: SparkSession, sf: str) -> DataFrame:
    o = _lines23(Testdata(spark, sf).orders)
    return o.select("o_orderkey", T.join_lines("line2", "line3", "append", 80).alias("append_line"),
                    T.join_lines("line2", "line3", "guarded", 80).alias("guarded_line"))


def _names(c: DataFrame) -> DataFrame:
    pref = (F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None))
            .when(F.col("c_mktsegment") == "FURNITURE", F.lit("0"))
            .otherwise(F.substring("c_name", 10, 9)))
    first = (F.when(F.col("c_nationkey") < 8, F.lit(None))
             .when(F.col("c_nationkey") < 12, F.lit("0"))
             .otherwise(F.concat(F.lit("First"), F.col("c_nationkey").cast("string"))))
    return c.withColumn("pref", pref).withColumn("first", first)


def q_display_name(spark: SparkSession, sf: str) -> DataFrame:
    c = _names(Testdata(spark, sf).customer)
    return c.select("c_custkey", T.display_name("pref", "first").alias("name_first"),
                    T.display_name("pref", "first", fallback=None).alias("name_preferred"))


def _levels(td: Testdata) -> DataFrame:
    c = td.customer.join(td.nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .join(td.region, F.col("n_regionkey") == F.col("r_regionkey"))
    level = (F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Graduate"))
             .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None)).otherwise(F.lit("Undergraduate")))
    cls = (F.when(F.col("r_regionkey") == 0, F.lit("Freshmen"))
           .when(F.col("r_regionkey") == 1, F.lit(None)).otherwise(F.col("r_name")))
    return c.withColumn("level", level).withColumn("cls", cls)


def q_patron_class(spark: SparkSession, sf: str) -> DataFrame:
    c = _levels(Testdata(spark, sf))
    return c.select("c_custkey", T.patron_class("level", "cls").alias("patron"))


def q_ordered_list(spark: SparkSession, sf: str) -> DataFrame:
    li = Testdata(spark, sf).lineitem.withColumn("s", F.nullif("l_returnflag", F.lit("N")))
    val = F.concat(F.coalesce("s", F.lit("")), F.coalesce("l_linestatus", F.lit("")))
    return shape.ordered_list(li, ["l_orderkey"], val, ["s", "l_linestatus"], ";", out="items")


def q_preferred(spark: SparkSession, sf: str) -> DataFrame:
    ev = Testdata(spark, sf).events
    top = latest.preferred(ev, "user_id", "event_type", ["purchase", "signup"],
                           tie_break=[F.desc("ts"), F.desc("event_id")], where=F.col("value") > 5)
    return top.select("user_id", "event_type", "event_id", F.lower("props").alias("contact"))


# -- O34-O39: rendering, header, injected rows, control ---------------------------------------

def q_render_delimited(spark: SparkSession, sf: str) -> DataFrame:
    td = Testdata(spark, sf)
    n = td.nation.join(td.region, F.col("n_regionkey") == F.col("r_regionkey"))
    n = n.withColumn("r", F.nullif("r_name", F.lit("ASIA"))).withColumn("empty", F.lit(None).cast("string"))
    return n.select("n_nationkey", render.render_delimited(["n_nationkey", "n_name", "r", "n_regionkey", "empty"])
                    .alias("line"))


def _quoted_fields(c: DataFrame) -> DataFrame:
    cid = F.when(F.col("c_nationkey") == 7, F.lit(None)) \
        .otherwise(F.concat(F.lit("C"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")))
    name = F.concat("c_name", F.when(F.col("c_nationkey") == 3, F.lit('"')).otherwise(F.lit("")))
    return c.select("c_custkey", cid.alias("cid"), name.alias("nm"),
                    F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("seg"), F.lit("ACTIVE").alias("st"))


def q_render_quoted(spark: SparkSession, sf: str) -> DataFrame:
    c = _quoted_fields(Testdata(spark, sf).customer)
    return c.select("c_custkey", render.render_quoted(["cid", "nm", "seg", "st"], raw=["cid"]).alias("line"))


REGION_HEADER = ["__BEGIN_CONFIG__,,", "TYPE,GROUP,", "GROUP-IDENTIFIER,NAME,ORGANIZATION"]


def q_with_header(spark: SparkSession, sf: str) -> DataFrame:
    td = Testdata(spark, sf)
    g = td.nation.join(td.region, F.col("n_regionkey") == F.col("r_regionkey")) \
        .select(F.concat("r_name", F.lit("-"), F.col("n_regionkey").cast("string")).alias("GROUP_IDENTIFIER"),
                F.col("r_name").alias("NAME"), F.lit("Regions").alias("ORGANIZATION")).distinct()
    d = render.data_rows(g, ["GROUP_IDENTIFIER", "NAME", "ORGANIZATION"],
                         render.render_quoted(["GROUP_IDENTIFIER", "NAME", "ORGANIZATION"]))
    return render.with_header(d, REGION_HEADER, distinct=True)


# Injected configuration row of the twin (synthetic values).
TEST_ROWS = [(-1, "Test Person")]


def q_with_rows(spark: SparkSession, sf: str) -> DataFrame:
    c = Testdata(spark, sf).customer.select("c_custkey", "c_name")
    return shape.with_rows(c, TEST_ROWS)


def _control_target(td: Testdata, orders: DataFrame | None = None) -> DataFrame:
    """Control analog: people with filled orders were sent (at their last filled order)."""
    o = (td.orders if orders is None else orders).filter(F.col("o_orderstatus") == "F") \
        .withColumn("t", term_of("o_orderdate"))
    return o.groupBy("o_custkey").agg(
        F.min("t").alias("wsrsrez_init_term"), F.max(F.year("o_orderdate").cast("string")).alias("wsrsrez_last_acyr"),
        F.max("t").alias("wsrsrez_last_term"), F.max("o_orderdate").alias("wsrsrez_last_sent"),
        F.lit("A").alias("wsrsrez_status_ind"), F.max("o_orderdate").alias("wsrsrez_activity_date")) \
        .select(F.col("o_custkey").cast("decimal(38,10)").alias("wsrsrez_pidm"), "wsrsrez_init_term",
                "wsrsrez_last_acyr", "wsrsrez_last_term", "wsrsrez_last_sent", "wsrsrez_status_ind",
                "wsrsrez_activity_date")


def _feed_rows(td: Testdata) -> DataFrame:
    fl = P.floor_period(_cohorts(td), "pulled_term", "199820", td.periods(), "tmpPulledTerm", "tmpTermACYR")
    return fl.select(F.col("custkey").alias("tmpPidm"), "tmpTermACYR", "tmpPulledTerm",
                     F.lit(0).alias("IS_HEADER"))


def q_upsert_control(spark: SparkSession, sf: str) -> DataFrame:
    from feedkit.operators import control
    from feedkit.sources.testdata import NOW
    td = Testdata(spark, sf)
    now = F.lit(NOW.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    src = control.control_source(_feed_rows(td), now)
    new = control.upsert_control(_control_target(td), src, now)
    return new.select(F.col("wsrsrez_pidm").cast("bigint").alias("pidm"),
                      F.col("wsrsrez_init_term").alias("init_term"), F.col("wsrsrez_last_acyr").alias("last_acyr"),
                      F.col("wsrsrez_last_term").alias("last_term"),
                      fmt_ts("wsrsrez_last_sent").alias("last_sent"), F.col("wsrsrez_status_ind").alias("status_ind"),
                      fmt_ts("wsrsrez_activity_date").alias("activity_date"))


def q_hour_gate(spark: SparkSession, sf: str) -> DataFrame:
    ev = Testdata(spark, sf).events
    local = F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), F.col("ts"))
    return ev.filter(T.hour_gate("ts", "America/New_York", 2)) \
        .select("event_id", "user_id", fmt_ts(local).alias("local_ts"))


# -- O43, O45-O48: filters and per-person builders ---------------------------------------------

def q_active(spark: SparkSession, sf: str) -> DataFrame:
    td = Testdata(spark, sf)
    o = td.orders.withColumn("end_date", F.when(F.col("o_orderstatus") == "O", F.lit(None))
                             .otherwise(F.to_date("o_orderdate")))
    o = o.filter(T.open_on("end_date", F.lit(AS_OF)))
    c = td.customer.withColumn("change_ind", F.when(F.col("c_acctbal") < 0, F.lit("Y")))
    c = c.filter(T.is_current("change_ind")).select("c_custkey")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_custkey")


def q_gpa_like(spark: SparkSession, sf: str) -> DataFrame:
    from feedkit.plans import people
    li = Testdata(spark, sf).order_lines()
    src = li.select(F.col("custkey").alias("shrlgpa_pidm"), F.col("l_returnflag").alias("shrlgpa_levl_code"),
                    F.when(F.col("l_linestatus") == "F", F.lit("O")).otherwise(F.lit("I")).alias("shrlgpa_gpa_type_ind"),
                    (F.abs("l_tax") * 50).alias("shrlgpa_gpa"),
                    F.nullif("l_quantity", F.lit(1.0)).alias("shrlgpa_hours_earned"))
    return people.gpa_credits(src)


def _tele(o: DataFrame) -> DataFrame:
    o = _phone_parts(o)
    code = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("MA"))
            .when(F.col("o_orderpriority") == "2-HIGH", F.lit("MOB"))
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("PR")).otherwise(F.lit("XX")))
    return o.select(F.col("o_custkey").alias("sprtele_pidm"), code.alias("sprtele_tele_code"),
                    F.col("area").alias("sprtele_phone_area"), F.col("number").alias("sprtele_phone_number"),
                    F.when(F.col("o_orderstatus") == "P", F.lit("I")).alias("sprtele_status_ind"),
                    F.when(F.col("o_orderstatus") == "F", F.lit("Y")).alias("sprtele_primary_ind"),
                    F.col("o_orderkey").alias("sprtele_seqno"), F.col("o_orderdate").alias("sprtele_activity_date"))


def q_phone_best(spark: SparkSession, sf: str) -> DataFrame:
    from feedkit.plans import people
    return people.phones(_tele(Testdata(spark, sf).orders))


def _addr(td: Testdata) -> DataFrame:
    o = _lines23(td.orders).join(td.customer.select("c_custkey", "c_nationkey"),
                                 F.col("o_custkey") == F.col("c_custkey"))
    atyp = (F.when(F.col("o_orderstatus") == "F", F.lit("MA"))
            .when(F.col("o_orderstatus") == "O", F.lit("PR")).otherwise(F.lit("BI")))
    return o.select(
        F.col("o_custkey").alias("spraddr_pidm"), atyp.alias("spraddr_atyp_code"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("spraddr_street_line1"),
        F.col("line2").alias("spraddr_street_line2"), F.col("line3").alias("spraddr_street_line3"),
        F.repeat("o_orderpriority", 6).alias("spraddr_city"), F.col("o_orderstatus").alias("spraddr_stat_code"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("spraddr_zip"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .otherwise(F.col("c_nationkey").cast("string")).alias("spraddr_natn_code"),
        F.when(F.col("o_totalprice") > 450000, F.lit("I")).alias("spraddr_status_ind"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
        .otherwise(F.to_date("o_orderdate")).alias("spraddr_to_date"),
        F.col("o_orderdate").alias("spraddr_activity_date"))


def _crosswalk(td: Testdata) -> DataFrame:
    iso = (F.when(F.col("n_regionkey") == 0, F.lit("0")).when(F.col("n_regionkey") == 1, F.lit(None))
           .otherwise(F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))))
    return td.nation.select(F.col("n_nationkey").cast("string").alias("scadem_banner_code"), iso.alias("sf_iso"))


def q_address_best(spark: SparkSession, sf: str) -> DataFrame:
    from feedkit.plans import people
    td = Testdata(spark, sf)
    return people.addresses(_addr(td), _crosswalk(td), F.lit(AS_OF))


def _emrg(td: Testdata) -> DataFrame:
    o = _lines23(_phone_parts(td.orders))
    return o.select(
        F.col("o_custkey").alias("spremrg_pidm"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.lit("Kin")).alias("spremrg_first_name"),
        F.concat(F.lit("Contact"), F.col("o_orderkey").cast("string")).alias("spremrg_last_name"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("spremrg_street_line1"),
        F.col("line2").alias("spremrg_street_line2"), F.col("line3").alias("spremrg_street_line3"),
        F.col("o_orderpriority").alias("spremrg_city"), F.col("o_orderstatus").alias("spremrg_stat_code"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("spremrg_zip"),
        F.col("area").alias("spremrg_phone_area"), F.col("number").alias("spremrg_phone_number"),
        F.col("o_orderstatus").alias("spremrg_relt_code"), F.col("o_orderdate").alias("spremrg_activity_date"))


def q_contact_best(spark: SparkSession, sf: str) -> DataFrame:
    from feedkit.context import stage
    from feedkit.plans import people
    td = Testdata(spark, sf)
    relt = td.orders.filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderstatus").alias("stvrelt_code"),
        F.concat(F.lit("Relation "), F.col("o_orderstatus")).alias("stvrelt_desc")).distinct()
    # Written, the code table has a known size: the contacts are not shuffled by their few codes to meet it.
    return people.emergency_contact(_emrg(td), stage(relt, "relt"))


# -- F1-F4: whole-feed twins --------------------------------------------------------------------

def _feed_ctx():
    from feedkit.context import RunContext
    from feedkit.sources.testdata import NOW
    return RunContext.at(AS_OF, NOW)


def q_feed_groups(spark: SparkSession, sf: str) -> DataFrame:
    from feedkit.plans import course_feeds
    from feedkit.sources.testdata import course_sources
    return course_feeds.group_feed(course_sources(Testdata(spark, sf)), _feed_ctx())


def q_feed_sections(spark: SparkSession, sf: str) -> DataFrame:
    from feedkit.plans import course_feeds
    from feedkit.sources.testdata import course_sources
    return course_feeds.section_feed(course_sources(Testdata(spark, sf)), _feed_ctx())


# Injected member of the twin (configuration, synthetic values).
TWIN_MEMBER = (7, "TESTMEMBER")


def q_feed_members(spark: SparkSession, sf: str) -> DataFrame:
    from feedkit.plans import course_feeds
    from feedkit.sources.testdata import course_sources
    inj = course_feeds.InjectedMember(*TWIN_MEMBER)
    return course_feeds.section_member_feed(course_sources(Testdata(spark, sf)), _feed_ctx(), inj)


TWIN_PERSON = [(-1, "T0000001", "GRAD2", "Test", "A", "Person", "ACTIVE", "test@example.org", "Testing", "")]


def q_feed_persons(spark: SparkSession, sf: str) -> DataFrame:
    from feedkit.plans import person_feed
    from feedkit.sources.testdata import course_sources
    return person_feed.person_feed(course_sources(Testdata(spark, sf)), _feed_ctx(), TWIN_PERSON)


# -- F5: housing feed twin ----------------------------------------------------------------------

def _housing_sources(td: Testdata) -> dict[str, DataFrame]:
    """Testdata mapped onto the housing feed's 34 source tables (all derived from the tables).

    Each table is one SQL query over the testdata frames; the phone, address and
    contact mappings are shared with their own twins. Lineitems meet their orders once:
    the joined lines and the student records, which other tables derive from, are written first.
    """
    from feedkit.context import stage_all
    from feedkit.sources.testdata import course_sources, person_id_sql, term_sql
    sql = td.spark.sql
    f = {"c": td.customer, "o": td.orders, "n": td.nation, "r": td.region, "l": td.order_lines()}
    base = course_sources(td)
    cts = "cast(date_add(DATE'1996-01-01', cast(floor(c_acctbal) AS int)) AS timestamp_ntz)"
    t_o, t_s = term_sql("o_orderdate"), term_sql("l_shipdate")
    spriden = sql(f"""
        SELECT c_custkey AS spriden_pidm, {person_id_sql('c_custkey')} AS spriden_id, c_name AS spriden_last_name,
               CASE WHEN c_nationkey < 3 THEN NULL WHEN c_nationkey < 5 THEN '0' ELSE concat('F', cast(c_nationkey AS string))
               END AS spriden_first_name, cast(NULL AS string) AS spriden_change_ind, {cts} AS spriden_activity_date
        FROM {{c}}
        UNION ALL
        SELECT c_custkey, {person_id_sql('c_custkey', 'X')}, c_name, 'Old', 'N', cast(NULL AS timestamp_ntz)
        FROM {{c}} WHERE c_acctbal < 0""", **f)
    spbpers = sql(f"""
        SELECT c_custkey AS spbpers_pidm, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Dr' END AS spbpers_name_prefix,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL WHEN c_mktsegment = 'FURNITURE' THEN '0'
                    ELSE concat('P', cast(c_nationkey AS string)) END AS spbpers_pref_first_name,
               CASE WHEN c_nationkey < 12 THEN 'F' ELSE 'M' END AS spbpers_sex,
               CASE WHEN c_nationkey = 7 THEN 'bad'
                    ELSE date_format(date_add(DATE'1980-01-01', cast(c_custkey AS int)), 'dd-MMM-yyyy') END AS spbpers_birth_date,
               CASE WHEN c_acctbal > 9000 THEN 'Y' END AS spbpers_confid_ind, {cts} AS spbpers_activity_date
        FROM {{c}}""", **f)
    g = sql(f"""
        SELECT o_custkey AS sgbstdn_pidm, {t_o} AS sgbstdn_term_code_eff,
               CASE WHEN min(o_orderpriority) = '1-URGENT' THEN 'GR' ELSE 'UG' END AS sgbstdn_levl_code,
               CASE WHEN max(o_orderstatus) = 'P' THEN 'F' WHEN max(o_orderstatus) = 'O' THEN 'C' ELSE 'P' END
                 AS sgbstdn_styp_code,
               min(o_orderpriority) AS sgbstdn_majr_code_1,
               CASE WHEN count(1) >= 2 THEN 'L' WHEN max(o_orderstatus) = 'O' THEN 'O'
                    WHEN min(o_orderstatus) = 'F' THEN 'R' ELSE 'M' END AS sgbstdn_camp_code,
               max(o_orderdate) AS sgbstdn_activity_date
        FROM {{o}} GROUP BY o_custkey, {t_o}""", **f)
    lines = sql(f"""SELECT custkey, {t_o} AS order_term, {t_s} AS ship_term, l_returnflag, l_linestatus, l_quantity, l_shipdate
                    FROM {{l}}""", **f)
    first = stage_all({"saturn_sgbstdn": g, "lines": lines})
    g, f["lines"] = first["saturn_sgbstdn"], first["lines"]
    tbrdepo = sql("""
        SELECT custkey AS tbrdepo_pidm, ship_term AS tbrdepo_term_code,
               CASE WHEN l_returnflag = 'R' AND l_quantity >= 45 THEN 'DHOU'
                    WHEN l_returnflag = 'N' AND l_quantity >= 48 THEN 'DRES'
                    WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'DLAC' ELSE 'XXXX' END AS tbrdepo_detail_code_deposit,
               l_shipdate AS tbrdepo_entry_date, l_shipdate AS tbrdepo_activity_date
        FROM {lines}""", **f)
    sfrstcr = sql(f"""
        SELECT o_custkey AS sfrstcr_pidm, {t_o} AS sfrstcr_term_code, cast(o_orderkey AS string) AS sfrstcr_crn,
               CASE WHEN o_orderstatus = 'O' THEN 'RE' WHEN o_orderstatus = 'P' THEN 'AU' ELSE 'DD' END AS sfrstcr_rsts_code
        FROM {{o}}""", **f)
    shrlgpa = sql("""
        SELECT c_custkey AS shrlgpa_pidm, 'UG' AS shrlgpa_levl_code, 'O' AS shrlgpa_gpa_type_ind,
               cast(c_nationkey AS double) / 8 AS shrlgpa_gpa,
               CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE cast(c_custkey AS double) / 4 END AS shrlgpa_hours_earned
        FROM {c}
        UNION ALL
        SELECT c_custkey, 'GR', 'O', 3.5D, 12.0D FROM {c} WHERE c_mktsegment = 'BUILDING'""", **f)
    shrtgpa = sql("""
        SELECT custkey AS shrtgpa_pidm, 'UG' AS shrtgpa_levl_code, order_term AS shrtgpa_term_code,
               CASE WHEN l_linestatus = 'F' THEN 'I' ELSE 'T' END AS shrtgpa_gpa_type_ind,
               CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity END AS shrtgpa_hours_earned
        FROM {lines}""", **f)
    sgrclsr = sql("""
        SELECT r_regionkey AS sgrclsr_seq_no, upper(substring(r_name, 1, 2)) AS sgrclsr_clas_code, 'UG' AS sgrclsr_levl_code,
               cast(r_regionkey * 100 AS double) AS sgrclsr_from_hours, cast(r_regionkey * 100 AS double) + 99.99D AS sgrclsr_to_hours
        FROM {r}
        UNION ALL
        SELECT n_nationkey + 10, concat('N', cast(n_nationkey AS string)), CASE WHEN n_nationkey < 5 THEN 'UG' ELSE 'XX' END,
               cast(n_regionkey * 100 AS double), cast(n_regionkey * 100 AS double) + 99.99D FROM {n}
        UNION ALL
        SELECT 99, 'GR', 'GR', 0.0D, 1e9D FROM {r} WHERE r_regionkey = 0""", **f)
    sgrcatt = sql("""SELECT n_nationkey + CASE WHEN n_nationkey IN (0, 2, 4) THEN 10 ELSE 1000 END AS sgrcatt_seq_no,
                            concat('A', cast(n_nationkey AS string)) AS sgrcatt_atts_code FROM {n}""", **f)
    stvclas = sql("""
        SELECT upper(substring(r_name, 1, 2)) AS stvclas_code, r_name AS stvclas_desc FROM {r}
        UNION ALL SELECT concat('N', cast(n_nationkey AS string)), n_name FROM {n}
        UNION ALL SELECT 'GR', 'Graduate' FROM {r} WHERE r_regionkey = 0""", **f)
    sprhold = sql("""
        SELECT o_custkey AS sprhold_pidm,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'RH' WHEN '2-HIGH' THEN 'DI' WHEN '3-MEDIUM' THEN 'LF' ELSE 'ZZ' END
                 AS sprhold_hldd_code,
               date_add(to_date(o_orderdate), 400) AS sprhold_to_date,
               CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN NULL ELSE 'N' END AS sprhold_release_ind,
               o_orderdate AS sprhold_activity_date
        FROM {o}""", **f)
    relt = sql("""SELECT DISTINCT o_orderstatus AS stvrelt_code, concat('Relation ', o_orderstatus) AS stvrelt_desc
                  FROM {o} WHERE o_orderstatus <> 'P'""", **f)
    gobintl = sql(f"""SELECT c_custkey AS gobintl_pidm, cast(c_nationkey AS string) AS gobintl_natn_code_legal,
                             {cts} AS gobintl_activity_date FROM {{c}} WHERE c_mktsegment <> 'MACHINERY'""", **f)
    gorvisa = sql(f"""SELECT c_custkey AS gorvisa_pidm, substring(c_mktsegment, 1, 2) AS gorvisa_vtyp_code,
                             {cts} AS gorvisa_activity_date FROM {{c}} WHERE c_mktsegment IN ('MACHINERY', 'AUTOMOBILE')""", **f)
    saradap = sql(f"""
        SELECT o_custkey AS saradap_pidm, {t_o} AS saradap_term_code_entry, o_orderkey AS saradap_appl_no,
               CASE o_orderstatus WHEN 'F' THEN 'D' WHEN 'O' THEN 'W' ELSE '1' END AS saradap_apst_code,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'R' ELSE 'N' END AS saradap_styp_code,
               o_orderdate AS saradap_activity_date
        FROM {{o}}""", **f)
    sarappd = sql(f"""
        SELECT o_custkey AS sarappd_pidm, {t_o} AS sarappd_term_code_entry,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'RS' WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'CP'
                    ELSE 'XX' END AS sarappd_apdc_code
        FROM {{o}}""", **f)
    saraatt = sql("""SELECT custkey AS saraatt_pidm, ship_term AS saraatt_term_code, 'HOUS' AS saraatt_atts_code,
                            l_shipdate AS saraatt_activity_date
                     FROM {lines} WHERE l_linestatus = 'O' AND l_returnflag = 'N'""", **f)
    sorainf = sql(f"""
        SELECT o_custkey AS sorainf_pidm, {t_o} AS sorainf_term_code,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'ADMCOUN' ELSE 'OTHER' END AS sorainf_radm_code,
               o_custkey + 1 AS sorainf_arol_pidm, o_orderdate AS sorainf_activity_date
        FROM {{o}}""", **f)
    sgrsprt = sql(f"""
        SELECT o_custkey AS sgrsprt_pidm, {t_o} AS sgrsprt_term_code, substring(o_orderpriority, 1, 1) AS sgrsprt_actc_code,
               'AC' AS sgrsprt_spst_code, CASE WHEN o_orderstatus = 'F' THEN 'AC' ELSE 'NO' END AS sgrsprt_elig_code,
               o_orderdate AS sgrsprt_activity_date
        FROM {{o}}""", **f)
    stvactc = sql("""SELECT DISTINCT concat(IF(o_orderpriority < '4', '', 'X'), substring(o_orderpriority, 1, 1)) AS stvactc_code,
                            concat('Team ', substring(o_orderpriority, 1, 1)) AS stvactc_desc FROM {o}""", **f)
    levels = sql("""SELECT DISTINCT sgbstdn_levl_code AS stvlevl_code,
                           CASE WHEN sgbstdn_levl_code = 'UG' THEN 'Undergraduate' ELSE 'Graduate' END AS stvlevl_desc
                    FROM {g}""", g=g)
    styp = sql("""SELECT DISTINCT sgbstdn_styp_code AS stvstyp_code, concat('Type ', sgbstdn_styp_code) AS stvstyp_desc
                  FROM {g}""", g=g)
    majr = sql("""SELECT DISTINCT o_orderpriority AS stvmajr_code, concat('Major ', substring(o_orderpriority, 3, 20))
                    AS stvmajr_desc FROM {o}""", **f)
    vtyp = sql("""SELECT DISTINCT 'MA' AS stvvtyp_code, 'Visa MA' AS stvvtyp_desc FROM {c}
                  WHERE c_mktsegment = 'MACHINERY'""", **f)
    location = ("CASE WHEN o_orderstatus = 'F' THEN 'Rising Star Atlanta' WHEN o_orderstatus = 'O' THEN 'Rising Star Main' "
                "ELSE 'Main' END")
    stvcamp = sql(f"""SELECT DISTINCT CASE WHEN o_orderstatus = 'F' THEN 'RSA' WHEN o_orderstatus = 'O' THEN 'RSM' ELSE 'M' END
                        AS stvcamp_code, {location} AS stvcamp_desc FROM {{o}}""", **f)
    contact = sql("SELECT concat('K', cast(c_custkey AS string)) AS id, c_custkey AS pidm FROM {c}", **f)
    opp = sql(f"""
        SELECT concat('K', cast(o_custkey AS string)) AS contact__c, concat({t_o}, ' Term') AS entering_term__c,
               {location} AS location__c,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Rising Star' ELSE 'Other' END AS student_type__c,
               CASE WHEN o_totalprice > 400000 THEN 'Y' WHEN o_totalprice > 300000 THEN NULL ELSE 'N' END AS isdeleted
        FROM {{o}}""", **f)
    ferpa = sql("SELECT c_custkey AS student_pidm FROM {c} WHERE c_acctbal < 0", **f)
    return {
        "saturn_stvterm": base["saturn_stvterm"], "saturn_spriden": spriden, "saturn_spbpers": spbpers,
        "saturn_sgbstdn": g, "taismgr_tbrdepo": tbrdepo, "saturn_sfrstcr": sfrstcr, "saturn_shrlgpa": shrlgpa,
        "saturn_shrtgpa": shrtgpa, "saturn_sgrclsr": sgrclsr, "saturn_sgrcatt": sgrcatt, "saturn_sprhold": sprhold,
        "saturn_sprtele": _tele(td.orders), "saturn_spraddr": _addr(td), "saturn_spremrg": _emrg(td),
        "general_goremal": base["general_goremal"], "general_gobintl": gobintl, "general_gorvisa": gorvisa,
        "saturn_saradap": saradap, "saturn_sarappd": sarappd, "saturn_saraatt": saraatt, "saturn_sorainf": sorainf,
        "saturn_sgrsprt": sgrsprt, "saturn_stvlevl": levels, "saturn_stvstyp": styp, "saturn_stvmajr": majr,
        "saturn_stvclas": stvclas, "saturn_stvvtyp": vtyp, "saturn_stvactc": stvactc, "saturn_stvrelt": relt,
        "saturn_stvcamp": stvcamp, "scadsf_wxwalknation": _crosswalk(td), "scadsf_sf_contact": contact,
        "scadsf_sf_opportunity": opp, "grailssf_ferpa": ferpa,
    }


# Adapted tables written once: those derived through joins, unions or aggregates and, so that their size is
# known before a join, the tables of a few codes. The others are projections of a single scan or of tables
# that are written already, and stay cheap plan leaves on their own.
_STAGED = {"saturn_stvterm", "saturn_spriden", "saturn_spraddr", "saturn_stvlevl", "saturn_stvstyp", "saturn_stvmajr",
           "saturn_stvvtyp", "saturn_stvactc", "saturn_stvrelt", "saturn_stvcamp"}


def _housing_inputs(spark: SparkSession, sf: str):
    """The adapted sources and control table of the housing feed. Those derived through joins or
    aggregates and the code tables are written once, so that they read as file scans, as catalog tables would."""
    from feedkit.context import stage_all
    td = Testdata(spark, sf)
    src = _housing_sources(td)
    # Orders of other priorities make control rows too, of keys that no person has.
    key = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")).otherwise(-F.col("o_custkey"))
    control = _control_target(td, td.orders.withColumn("o_custkey", key))
    staged = stage_all({**{k: src[k] for k in _STAGED}, "control": control})
    control = staged.pop("control")
    return src | staged, control


def _thin(cohort: DataFrame) -> DataFrame:
    return cohort.select("pidm", "pulled_term", "asof_term", "levl", "styp", "majr").distinct()


def q_cohort_deposits(spark: SparkSession, sf: str) -> DataFrame:
    from feedkit.plans import housing
    src, sent = _housing_inputs(spark, sf)
    return _thin(housing.cohort_new_deposits(src, sent, housing._params(src, _feed_ctx(), PERIOD_FLOOR)[0]))


def q_cohort_changed(spark: SparkSession, sf: str) -> DataFrame:
    from feedkit.plans import housing
    src, sent = _housing_inputs(spark, sf)
    return _thin(housing.cohort_changed(src, sent, *housing._params(src, _feed_ctx(), PERIOD_FLOOR)))


def q_cohort_campus(spark: SparkSession, sf: str) -> DataFrame:
    from feedkit.plans import housing
    src, sent = _housing_inputs(spark, sf)
    return _thin(housing.cohort_campus(src, sent, housing._params(src, _feed_ctx(), PERIOD_FLOOR)[0]))


def q_cohort_registered(spark: SparkSession, sf: str) -> DataFrame:
    from feedkit.plans import housing
    src, sent = _housing_inputs(spark, sf)
    return _thin(housing.cohort_registered(src, sent, housing._params(src, _feed_ctx(), PERIOD_FLOOR)[0]))


def q_advisors(spark: SparkSession, sf: str) -> DataFrame:
    from feedkit.plans import housing
    return housing.advisors(_housing_inputs(spark, sf)[0])


#: What the enrichment knows of a person, under short names.
ENRICHMENT = {
    "citizenship": "citizenship", "visa": "visa", "completed": "term1", "applied": "term2", "exempt": "housing_exempt",
    "academic_hold": "academic_hold", "incident_hold": "incident_hold", "account_hold": "account_hold", "team": "stvactc_desc",
    "ferpa": "ferpa", "email": "goremal_email_address", "em_contact_name": "emgr_contact_name", "em_street_line1": "emgr_street_line1",
    "em_street_line2": "emgr_street_line2", "em_city": "emgr_city", "em_stat_code": "emgr_stat_code", "em_zip": "emgr_zip",
    "em_phone": "emgr_phone", "em_relt_desc": "emgr_relt_desc",
    **{f"{k}_{c}": f"{k}_{c}" for k in ("ma", "pr") for c in ("street_line1", "street_line2", "city", "stat_code", "zip", "iso")},
    "phone_MA": "ma_phone", "phone_MOB": "mob_phone", "phone_PR": "pr_phone"}


def q_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    """The housing feed's own enrichment, for every person."""
    from feedkit.plans import housing
    src, _ = _housing_inputs(spark, sf)
    known = housing.enrichment(src, _feed_ctx(), housing._params(src, _feed_ctx(), PERIOD_FLOOR)[0])
    everyone = Testdata(spark, sf).customer.join(known, F.col("c_custkey") == F.col("en_pidm"), "left")
    value = lambda name, c: f"coalesce({c}, '0') AS {name}" if name.endswith("_hold") else f"{c} AS {name}"
    return everyone.selectExpr("c_custkey AS pidm", *[value(n, c) for n, c in ENRICHMENT.items()])


def q_feed_housing(spark: SparkSession, sf: str) -> DataFrame:
    """F5 twin: every line of the housing feed over the adapted sources."""
    from feedkit.plans import housing
    src, sent = _housing_inputs(spark, sf)
    return housing.housing_feed(src, sent, _feed_ctx(), floor=PERIOD_FLOOR)
