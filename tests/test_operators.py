"""Unit tests per operator and per semantic trap (tiny hand-made DataFrames)."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from feedkit.functions import text as T
from feedkit.operators import asof, changes, control, latest, periods, render, rules, shape


class Bag(list):
    """Rows compared as a multiset (order-insensitive, NULL-safe)."""

    def __eq__(self, other):
        return Counter(map(repr, self)) == Counter(map(repr, other))

    __hash__ = None


def rows(df, *cols):
    cols = cols or df.columns
    return Bag(tuple(r[c] for c in cols) for r in df.collect())


# -- periods ----------------------------------------------------------------------------------

@pytest.fixture()
def terms(spark):
    return spark.createDataFrame([
        ("202340", "2324", dt.date(2024, 6, 15), dt.date(2024, 8, 20)),
        ("202410", "2425", dt.date(2024, 9, 20), dt.date(2024, 11, 30)),
        ("202415", "2425", dt.date(2024, 9, 1), dt.date(2024, 10, 15)),
        ("202420", "2425", dt.date(2025, 1, 6), dt.date(2025, 3, 15)),
    ], "code string, year string, start_date date, end_date date")


def test_period_rules_disagree_between_terms(terms):
    as_of = dt.date(2024, 9, 15)
    assert periods.current_period(terms, as_of, "earliest_open", floor="201510").first()[0] == "202410"
    assert periods.current_period(terms, as_of, "latest_started", suffix="0").first()[0] == "202340"
    assert periods.current_period(terms, as_of, "latest_started").first()[0] == "202415"
    assert periods.next_period(terms, as_of, suffix="0").first()[0] == "202410"
    assert periods.next_period(terms, dt.date(2030, 1, 1)).first()[0] is None


def test_run_params(terms):
    p = periods.collect_one(periods.run_params(terms, dt.date(2024, 9, 15), floor="201510"))
    assert p == {"period_code": "202410", "period_year": "2425", "next_year": None}
    p = periods.collect_one(periods.run_params(terms, dt.date(2024, 7, 1)))
    assert p == {"period_code": "202340", "period_year": "2324", "next_year": "2425"}


def test_floor_period_null_passes_and_unknown_year(spark, terms):
    df = spark.createDataFrame([("202340",), ("202410",), ("202420",), (None,), ("209910",)], "t string")
    out = periods.floor_period(df, "t", "202410", terms, "ft", "fy")
    assert rows(out, "t", "ft", "fy") == [("202340", "202410", "2425"), ("202410", "202410", "2425"),
                                          ("202420", "202420", "2425"), (None, None, "0000"),
                                          ("209910", "209910", "0000")]


# -- latest / max -----------------------------------------------------------------------------

def test_latest_per_key_tie_break_and_at_max_keeps_ties(spark):
    df = spark.createDataFrame([(1, "2", 5), (1, "2", 7), (1, "1", 9), (2, "3", 1)], "k int, eff string, v int")
    top = latest.latest_per_key(df, ["k"], [F.desc("eff"), F.desc("v")])
    assert rows(top) == [(1, "2", 7), (2, "3", 1)]
    assert rows(latest.at_max(df, ["k"], "eff")) == [(1, "2", 5), (1, "2", 7), (2, "3", 1)]


def test_preferred_code_order(spark):
    df = spark.createDataFrame([(1, "BB", "b"), (1, "AA", "a"), (2, "BB", "c"), (3, "CC", "d")],
                               "k int, code string, v string")
    assert rows(latest.preferred(df, "k", "code", ["AA", "BB"])) == [(1, "AA", "a"), (2, "BB", "c")]


# -- as-of ------------------------------------------------------------------------------------

def brute_asof(left, right):
    out = []
    for k, x in left:
        cands = [(e, p) for kk, e, p in right if kk == k and e is not None and x is not None and e <= x]
        best = max(cands, key=lambda t: (t[0], t[1])) if cands else (None, None)
        out.append((k, x, best[1]))
    return sorted(out, key=str)


small_int = st.integers(min_value=0, max_value=30)


@settings(max_examples=8, deadline=None)
@given(left=st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), small_int)), min_size=1, max_size=25),
       right=st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), small_int), st.integers(0, 99)),
                      min_size=0, max_size=25),
       bucketed=st.booleans())
def test_asof_join_matches_brute_force(spark, left, right, bucketed):
    L = spark.createDataFrame(left, "k int, x int")
    R = spark.createDataFrame(right, "rk int, e int, p int")
    got = asof.asof_join(L, R, ["k"], ["rk"], "x", "e", ["p"], tie_break=[F.desc("p")], hot_rows=5 if bucketed else asof.HOT_ROWS)
    assert rows(got, "k", "x", "p") == brute_asof(left, right)


def test_asof_join_ties_all_fan_out_and_inner(spark):
    L = spark.createDataFrame([(1, 10), (1, 3), (2, 5)], "k int, x int")
    R = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 8, "c"), (2, 9, "z")], "rk int, e int, p string")
    got = asof.asof_join(L, R, ["k"], ["rk"], "x", "e", ["p"], ties="all", how="inner", eff_out="m")
    assert rows(got, "k", "x", "m", "p") == [(1, 10, 8, "c")]
    got = asof.asof_join(L.filter("x = 5 or x = 10"), R.filter("e = 5"), ["k"], ["rk"], "x", "e", ["p"],
                         ties="all", how="left")
    assert rows(got, "k", "x", "p") == [(1, 10, "a"), (1, 10, "b"), (2, 5, None)]


def test_asof_cumulative_equals_sum_up_to_key(spark):
    """The running total read at the greatest key <= x equals SUM(value WHERE key <= x)."""
    facts = [(1, "202310", 15.0), (1, "202320", 15.0), (1, "202330", 20.0), (1, "202330", None),
             (1, "202420", 30.0), (2, "202410", None)]
    F_ = spark.createDataFrame(facts, "p int, t string, h double")
    L = spark.createDataFrame([(1, "202330"), (1, "202410"), (1, "202010"), (2, "202410"), (3, "202410")],
                              "p int, x string")
    got = asof.asof_cumulative(L, F_, ["p"], ["p"], "x", "t", "h", "cum", default=0.0)
    assert rows(got, "p", "x", "cum") == [(1, "202010", 0.0), (1, "202330", 50.0), (1, "202410", 50.0),
                                          (2, "202410", 0.0), (3, "202410", 0.0)]


def test_one_key_for_all_rows_is_cut_by_itself(spark):
    """A key that holds every row: swept in stretches, with the same answers."""
    right = spark.range(3000).selectExpr("1 AS k", "id * 7 % 5000 AS e", "id AS p")
    left = spark.range(4000).selectExpr("IF(id % 50 = 0, NULL, 1) AS k", "IF(id % 33 = 0, NULL, id * 3 % 5500) AS x", "id AS n")
    plain = asof.asof_join(left, right, ["k"], ["k"], "x", "e", ["p"])
    cut = asof.asof_join(left, right, ["k"], ["k"], "x", "e", ["p"], hot_rows=300)
    assert rows(cut, "n", "p") == rows(plain, "n", "p") and cut.filter("p IS NOT NULL").count() > 3500
    assert "__b" in cut._jdf.queryExecution().executedPlan().toString()
    used = [r for r in cut._jdf.queryExecution().optimizedPlan().toString().split("\n") if "__b" in r]
    assert used
    totals = asof.asof_cumulative(left, right, ["k"], ["k"], "x", "e", "p", "sum", default=0)
    assert rows(asof.asof_cumulative(left, right, ["k"], ["k"], "x", "e", "p", "sum", default=0, hot_rows=300), "n", "sum") == rows(totals, "n", "sum")
    events = sorted((r["e"], r["p"]) for r in right.collect())
    want = {r["n"]: sum(p for e, p in events if r["k"] is not None and r["x"] is not None and e <= r["x"]) for r in left.collect() if r["n"] % 97 == 0}
    assert {r["n"]: r["sum"] for r in totals.collect() if r["n"] % 97 == 0} == want


def test_hot_key_stretches_are_bounded(spark):
    one = spark.range(20000).selectExpr("1 AS __by0", "id AS __k")
    cuts = asof._cuts(one, ["__by0"], 2000).first()["__cuts"]
    edges = [0, *cuts, 20000]
    assert len(cuts) >= 5 and max(b - a for a, b in zip(edges, edges[1:])) < 6000


# -- rules and flags --------------------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2, 3])
def test_band_match_by_nodes(spark, seed):
    """Dyadic nodes against every (value, band) pair; the direct join gives the same."""
    import random
    random.seed(seed)
    bands = []
    for i in range(150):
        lo = random.choice([None, *range(60)])
        width = random.choice([0, 0, 1, 5, 40, -3])
        bands.append((random.choice(["a", "a", "a", "b", None]), None if lo is None else float(lo), None if lo is None or i % 40 == 0 else float(lo + width),
                      i % 3, f"c{i:03d}"))
    values = [(n, random.choice(["a", "a", "b", "z", None]), random.choice([None, -1.0, 0.0, -0.0, *[x / 2 for x in range(210)]])) for n in range(250)]
    R = spark.createDataFrame(bands, "g string, lo double, hi double, rank int, code string")
    L = spark.createDataFrame(values, "n int, level string, v double")
    prefer = [("rank", "desc"), ("code", "asc")]

    def match(direct):
        return rows(rules.band_match(L, R, [("level", "g")], "v", "lo", "hi", prefer, {"code": "found"}, direct=direct), "n", "found")

    def best(level, v):
        hit = [(-rank, code) for g, lo, hi, rank, code in bands if g == level and None not in (g, v, lo, hi) and lo <= v <= hi]
        return min(hit)[1] if hit else None

    want = sorted(((n, best(level, v)) for n, level, v in values), key=str)
    assert match(0) == want and match(1000) == want and sum(f is not None for _, f in want) > 100


def test_band_nodes_do_not_grow_with_the_bands(spark):
    """Ten times the bands over ten times the values: about ten times the joined rows, not a hundred."""
    joined = {}
    for n in (100, 1000):
        bands = spark.range(n).selectExpr("1 AS __rk0", "CAST(id AS DOUBLE) AS __lo", "CAST(id + 40 * sqrt(id) AS DOUBLE) AS __hi", "id AS __o_c")
        dom = spark.range(n).selectExpr("1 AS __rk0", "id + 0.5D AS __v")
        seen = []
        original = rules.latest_per_key
        rules.latest_per_key = lambda df, *a: seen.append(df.count()) or original(df, *a)
        try:
            assert rules._by_nodes(dom, bands, ["__rk0"], [F.desc("__o_c")], ["__o_c"]).count() == n - 1
        finally:
            rules.latest_per_key = original
        joined[n] = seen
    assert all(b < 20 * a for a, b in zip(joined[100], joined[1000]))


def test_rules_with_attributes_and_band_match_edges(spark):
    r = spark.createDataFrame([(1, "FR", "UG", Decimal("0"), Decimal("44.99")),
                               (2, "SO", "UG", Decimal("45"), Decimal("89.99")),
                               (3, "SOH", "UG", Decimal("45"), Decimal("89.99"))],
                              "seq int, code string, lv string, lo decimal(9,2), hi decimal(9,2)")
    a = spark.createDataFrame([(3, "HONR"), (3, "ABC")], "seq int, att string")
    ra = rules.rules_with_attributes(r, a, "seq", "seq", "att", ["seq", "code", "lv", "lo", "hi"])
    assert rows(ra, "code", "attributes", "no_atts_flag") == [("FR", [], 1), ("SO", [], 1), ("SOH", ["ABC", "HONR"], 0)]
    left = spark.createDataFrame([(1, "UG", Decimal("44.99")), (2, "UG", Decimal("45")), (3, "UG", None),
                                  (4, "GR", Decimal("10")), (5, "UG", Decimal("95")), (6, "UG", Decimal("45"))],
                                 "id int, lv string, v decimal(9,2)")
    got = rules.band_match(left, ra, [("lv", "lv")], "v", "lo", "hi",
                           prefer=[("no_atts_flag", "desc"), ("code", "asc")], out={"code": "cls"})
    assert rows(got, "id", "cls") == [(1, "FR"), (2, "SO"), (3, None), (4, None), (5, None), (6, "SO")]


def test_code_flags_and_presence(spark):
    df = spark.createDataFrame([(1, "RH", 1), (1, "LF", 0), (2, "DI", 1), (3, "ZZ", 1)], "k int, c string, live int")
    got = rules.code_flags(df, "k", "c", {"a": ["RH", "AH"], "i": ["DI"], "f": ["LF"]}, where=F.col("live") == 1)
    assert rows(got, "k", "a", "i", "f") == [(1, "1", "0", "0"), (2, "0", "1", "0"), (3, "0", "0", "0")]
    other = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    base = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    got = rules.presence_flag(base, other, ("id", "k"), "y", yes="Y", no=None)
    assert rows(got, "id", "y") == [(1, "Y"), (2, None), (3, "Y")]


# -- change detection -------------------------------------------------------------------------

def test_changed_since_matches_exists_or(spark):
    t = dt.datetime
    ctl = spark.createDataFrame([(1, t(2024, 9, 1)), (2, t(2024, 9, 1)), (3, t(2024, 9, 1)), (4, None),
                                 (5, t(2024, 9, 1))], "k int, sent timestamp_ntz")
    a = spark.createDataFrame([(1, t(2024, 9, 2)), (2, t(2024, 9, 1)), (4, t(2030, 1, 1))], "k int, ts timestamp_ntz")
    b = spark.createDataFrame([(3, t(2024, 8, 1)), (3, t(2024, 9, 3))], "k int, ts timestamp_ntz")
    base = ctl.withColumn("col_ts", F.when(F.col("k") == 5, F.lit(t(2024, 9, 5))).cast("timestamp_ntz"))
    got = changes.changed_since(base, "k", "sent", {"a": (a, "k", "ts"), "b": (b, "k", "ts")},
                                column_arms=[F.col("col_ts")])
    # 2: equal time is not a change; 4: NULL last-sent never changes.
    assert rows(got, "k") == [(1,), (3,), (5,)]


def test_not_sent_and_exclude_same_year(spark):
    df = spark.createDataFrame([(1, "2425"), (2, "2425"), (3, "2526"), (4, "2425")], "p int, y string")
    ctl = spark.createDataFrame([(1, "2425", "A"), (2, "2324", "A"), (3, "2526", "I")], "cp int, cy string, s string")
    got = changes.not_sent(df, ctl.filter("s = 'A'"), ("p", "cp"), cond=F.col("cy") >= F.col("y"))
    assert rows(got, "p") == [(2,), (3,), (4,)]
    ev = spark.createDataFrame([(2, "2425"), (2, "2425"), (4, "2324")], "ep int, ey string")
    assert rows(changes.exclude_same_year(df, ev, ("p", "ep"), ("y", "ey")), "p") == [(1,), (3,), (4,)]


# -- shaping ----------------------------------------------------------------------------------

def test_union_cohorts_keeps_tags_distinct(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "p int, t string")
    b = spark.createDataFrame([(1, "x")], "p int, t string")
    assert rows(shape.union_cohorts({1: a, 2: b})) == [(1, 1, "x"), (2, 1, "x")]


def test_season_winner_override_and_pivot(spark):
    a = spark.createDataFrame([(1, "10", "202410", "R", "05/01/2024 10:30:00 AM"),
                               (1, "10", "202410", "M", "04/30/2025 09:00:00 AM"),
                               (1, "20", "202320", "M", "x")], "p int, s string, t string, c string, d string")
    b = spark.createDataFrame([(1, "10", "202410", "A", None), (1, "20", "202420", "M", None)],
                              "p int, s string, t string, c string, d string")
    # Within source 1, the payment date orders as text (T4): "04/30/2025" < "05/01/2024".
    w = shape.season_winner([a, b], "p", "s", "t", [[F.desc("t"), F.asc("d")], [F.desc("t"), F.asc("c")]])
    assert rows(w, "s", "t", "c", "src") == [("10", "202410", "M", 1), ("20", "202420", "M", 2)]
    ov = spark.createDataFrame([(1, "202410", "A"), (1, "202410", "B")], "op int, ot string, rc string")
    w2 = spark.createDataFrame([(1, "10", "202410", "R"), (1, "20", "202420", "R"), (1, "30", "202430", "L")],
                               "p int, s string, t string, c string")
    got = shape.apply_override(w2, ov, [("p", "op"), ("t", "ot")], "c", "rc", ["R", "RSM"], "M")
    assert rows(got, "s", "c") == [("10", "A"), ("10", "B"), ("20", "M"), ("30", "L")]   # T16 fan-out
    pv = shape.pivot_first(got, "p", "s", {"10": "t10_", "20": "t20_"}, {"c": "camp"})
    assert rows(pv, "p", "t10_camp", "t20_camp") == [(1, "B", "M")]


def test_ordered_list_nulls_first_duplicates_kept(spark):
    df = spark.createDataFrame([(1, "ART", "101"), (1, None, "300"), (1, "ART", "101"), (1, "BIO", None)],
                               "k int, s string, n string")
    v = F.concat(F.coalesce("s", F.lit("")), F.coalesce("n", F.lit("")))
    assert rows(shape.ordered_list(df, ["k"], v, ["s", "n"])) == [(1, "300;ART101;ART101;BIO")]


def test_with_rows_union_distinct_casts(spark):
    df = spark.createDataFrame([(Decimal(1), "a")], "k decimal(8,0), v string")
    out = shape.with_rows(df, [(1, "a"), (2, "b")])
    assert rows(out) == [(Decimal(1), "a"), (Decimal(2), "b")]


# -- text functions ---------------------------------------------------------------------------

@pytest.mark.parametrize("area,number,n,expected", [
    ("912", "5551234", 12, "912-555-1234"), (None, "5551234", 12, "555-1234"), ("0", "12345", 12, "12345"),
    ("9123", "0", 12, "9123"), ("912", None, 12, "912-"), ("912", "5551234567890", 12, "912-55512345"),
    ("912", "5551234567890", 25, "912-5551234567890"),
])
def test_format_phone(spark, area, number, n, expected):
    df = spark.createDataFrame([(area, number)], "a string, b string")
    assert df.select(T.format_phone("a", "b", n)).first()[0] == expected


@pytest.mark.parametrize("l2,l3,append,guarded", [
    (None, "Unit 5", " Unit 5", ""), ("Apt 1", None, "Apt 1", "Apt 1"), ("Apt 1", "0", "Apt 1", "Apt 1 0"),
    ("0", "X", "0 X", ""), (None, None, "", ""),
])
def test_join_lines_variants(spark, l2, l3, append, guarded):
    df = spark.createDataFrame([(l2, l3)], "a string, b string")
    r = df.select(T.join_lines("a", "b", "append"), T.join_lines("a", "b", "guarded")).first()
    assert (r[0], r[1]) == (append, guarded)


@pytest.mark.parametrize("pref,first,name,preferred", [
    (None, "Ann", "Ann", "Ann"), ("0", "Ann", "Ann", "Ann"), ("Bo", "Ann", "Bo", "Bo"),
    (None, None, "NoName", None), ("0", "0", "NoName", "0"),
])
def test_display_name(spark, pref, first, name, preferred):
    df = spark.createDataFrame([(pref, first)], "p string, f string")
    r = df.select(T.display_name("p", "f"), T.display_name("p", "f", fallback=None)).first()
    assert (r[0], r[1]) == (name, preferred)


@pytest.mark.parametrize("level,cls,expected", [
    ("Graduate", "Senior", "GRAD2"), ("GRADUATE", None, "GRAD2"), ("Undergraduate", "Freshmen", "UNDERGRADUATE-FRESHMAN"),
    ("Undergraduate", "First Year", "UNDERGRADUATE-FIRST-YEAR"), (None, None, "-"), ("Undergraduate", None, "UNDERGRADUATE-"),
])
def test_patron_class(spark, level, cls, expected):
    df = spark.createDataFrame([(level, cls)], "l string, c string")
    assert df.select(T.patron_class("l", "c")).first()[0] == expected


@pytest.mark.parametrize("utc,even", [
    (dt.datetime(2024, 3, 10, 5, 30), True),    # 00:30 EST
    (dt.datetime(2024, 3, 10, 7, 30), False),   # 03:30 EDT (clocks jumped from 02:00)
    (dt.datetime(2024, 3, 10, 8, 30), True),    # 04:30 EDT
    (dt.datetime(2024, 11, 3, 5, 30), False),   # 01:30 EDT
    (dt.datetime(2024, 11, 3, 6, 30), False),   # 01:30 EST (repeated hour)
    (dt.datetime(2024, 11, 3, 7, 30), True),    # 02:30 EST
    (dt.datetime(2024, 9, 15, 14, 0), True),    # 10:00 EDT
])
def test_hour_gate_new_york_across_dst(spark, utc, even):
    df = spark.createDataFrame([(utc,)], "ts timestamp_ntz")
    assert df.select(T.hour_gate("ts")).first()[0] is even


# -- rendering --------------------------------------------------------------------------------

def test_render_delimited_and_quoted(spark):
    df = spark.createDataFrame([("A1", None, 12345678.0, 0.0, 'Film"', "x")], "a string, b string, c double, d double, e string, f string")
    assert df.select(render.render_delimited(["a", "b", "c", "d"])).first()[0] == "A1||1.2345678E7|0.0"
    # Empty fields vanish; a field ending in a quote merges with the next separator.
    assert df.select(render.render_quoted(["a", "b", "e", "f"])).first()[0] == '"A1",,"Film,"x"'
    nul = spark.createDataFrame([(None, "x")], "a string, b string")
    assert nul.select(render.render_quoted(["a", "b"], raw=["a"])).first()[0] is None          # T20


def test_with_header_union_and_union_all(spark):
    d = spark.createDataFrame([("x", 999, 0, "L"), ("x", 999, 0, "L")], "k string, REPORT_ORDER int, IS_HEADER int, REPORT_TEXT string")
    assert render.with_header(d, ["H1", "H2"], distinct=True).count() == 3
    out = render.with_header(d, ["H1", "H2"], distinct=False)
    assert rows(out, "REPORT_ORDER", "REPORT_TEXT") == [(1, "H1"), (2, "H2"), (999, "L"), (999, "L")]
    assert out.filter("IS_HEADER = 1 AND k IS NOT NULL").count() == 0


# -- control ----------------------------------------------------------------------------------

def test_upsert_control(spark):
    t = dt.datetime
    target = spark.createDataFrame([
        (Decimal(1), "202310", "2324", "202310", t(2024, 1, 1), "A", t(2024, 1, 1)),
        (Decimal(2), "202310", "2324", "202310", t(2024, 1, 1), "I", t(2024, 1, 1)),
        (Decimal("123456789"), "202310", "2324", "202310", t(2024, 1, 1), "A", t(2024, 1, 1)),
    ], control.CONTROL_SCHEMA)
    src = spark.createDataFrame([(1, "2425", "202410"), (3, "2425", "202420"), (123456789, "2526", "202510")],
                                "tmpPidm long, tmpTermACYR string, tmpPulledTerm string")
    now = F.lit("2024-09-15 14:00:00").cast("timestamp_ntz")
    out = {(int(r[0]), r[1], r[3]): r for r in control.upsert_control(target, src, now).collect()}
    assert set(out) == {(1, "202310", "202410"), (2, "202310", "202310"), (123456789, "202310", "202310"),
                        (3, "202420", "202420"), (123456789, "202510", "202510")}   # T23: 9-digit key never matches
    assert out[(1, "202310", "202410")]["wsrsrez_status_ind"] == "A"
    assert out[(2, "202310", "202310")]["wsrsrez_status_ind"] == "I"


def test_catalog_control_merges_or_leaves_the_table(spark):
    name = "feedkit_control"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    tbl = control.CatalogControl(spark, name)
    tbl.ensure()
    row = (Decimal(7), "202410", "2425", "202410", dt.datetime(2024, 1, 1), "A", dt.datetime(2024, 1, 1))
    spark.createDataFrame([row], control.CONTROL_SCHEMA).write.insertInto(name)
    tbl.ensure()
    assert tbl.read().count() == 1 and tbl.read().schema == control.CONTROL_SCHEMA
    src = spark.createDataFrame([(7, "2425", "202420"), (8, "2425", "202420")], "tmpPidm long, tmpTermACYR string, tmpPulledTerm string")
    with pytest.raises(UnsupportedOperationException) as refused:  # no catalog at hand supports row-level operations
        tbl.merge(src, F.lit("2024-09-15 14:00:00").cast("timestamp"))
    assert (refused.value.getCondition() or "").startswith("UNSUPPORTED_FEATURE")
    assert tbl.read().collect()[0]["wsrsrez_last_term"] == "202410" and tbl.read().count() == 1
    spark.sql(f"DROP TABLE {name}")


def test_control_table_versions(spark, tmp_path):
    tbl = control.ControlTable(spark, str(tmp_path / "ctl"))
    assert tbl.current_version() is None and tbl.read().count() == 0
    tbl.ensure()
    assert tbl.current_version() == 0
    row = [(Decimal(7), "202410", "2425", "202410", dt.datetime(2024, 1, 1), "A", dt.datetime(2024, 1, 1))]
    one = spark.createDataFrame(row, control.CONTROL_SCHEMA)
    assert tbl.commit(one, after=0) == 1 and tbl.read().count() == 1
    tbl.ensure()
    assert tbl.current_version() == 1
    with pytest.raises(RuntimeError):  # computed from a version that is no longer current
        tbl.commit(one, after=0)
    assert tbl.commit(one.union(one), after=1) == 2
    tbl.prune(keep=1)
    assert tbl.current_version() == 2 and tbl.read().count() == 2


def test_overlapping_runs_cannot_lose_rows(spark, tmp_path):
    """Run A claims from v0; run B, also from v0, is refused; the claim of a dead run lapses."""
    row = lambda n: spark.createDataFrame(
        [(Decimal(n), "202410", "2425", "202410", dt.datetime(2024, 1, 1), "A", dt.datetime(2024, 1, 1))], control.CONTROL_SCHEMA)
    a, b = (control.ControlTable(spark, str(tmp_path / "ctl")) for _ in range(2))
    a.ensure()
    mine = a.claim(after=0)
    with pytest.raises(RuntimeError):
        b.claim(after=0)
    with pytest.raises(RuntimeError):
        b.commit(row(2), after=0)
    assert a.commit(row(1), claim=mine) == 1
    assert b.commit(b.read().union(row(2)), after=1) == 2 and b.read().count() == 2  # on top of A's rows
    dead = a.claim(after=2)
    late = control.ControlTable(spark, str(tmp_path / "ctl"), abandoned_after=0)
    assert late.claim(after=2) == dead + 1
    late.abandoned_after = 3600
    with pytest.raises(RuntimeError):  # A comes back after its claim lapsed and another run went on
        a.commit(row(3), claim=dead)
    assert late.commit(late.read(), claim=dead + 1) == dead + 1 and a.current_version() == dead + 1
    released = a.claim(after=dead + 1)
    a.release(released)
    assert b.claim(after=dead + 1) == released


def test_a_failed_commit_gives_its_claim_back(spark, tmp_path):
    tbl = control.ControlTable(spark, str(tmp_path / "ctl"))
    tbl.ensure()
    broken = tbl.read().select(*[F.raise_error(F.lit("no")).cast(f.dataType).alias(f.name) for f in control.CONTROL_SCHEMA.fields])
    with pytest.raises(Exception):
        tbl.commit(broken.union(spark.range(1).selectExpr(*[f"CAST(raise_error('no') AS {f.dataType.simpleString()}) AS {f.name}"
                                                              for f in control.CONTROL_SCHEMA.fields])), after=0)
    assert tbl.current_version() == 0 and tbl.commit(tbl.read(), after=0) >= 1


def test_changed_since_pushes_the_smallest_time(spark, tmp_path):
    spark.createDataFrame([(1, dt.datetime(2024, 5, 1)), (2, dt.datetime(2023, 1, 1))], "k int, ts timestamp").write.parquet(str(tmp_path / "arm"))
    arm = spark.read.parquet(str(tmp_path / "arm"))
    base = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 2, 1)), (3, None)], "k int, sent timestamp")
    out = changes.changed_since(base, "k", "sent", {"arm": (arm, "k", "ts")})
    assert "GreaterThan(ts,2024-01-01" in out._jdf.queryExecution().executedPlan().toString()
    assert [r["k"] for r in out.collect()] == [1]
    assert changes.changed_since(base.filter("false"), "k", "sent", {"arm": (arm, "k", "ts")}).collect() == []


def test_control_table_after_a_crash(spark, tmp_path):
    tbl = control.ControlTable(spark, str(tmp_path / "ctl"))
    tbl.ensure()
    row = [(Decimal(7), "202410", "2425", "202410", dt.datetime(2024, 1, 1), "A", dt.datetime(2024, 1, 1))]
    tbl.commit(spark.createDataFrame(row, control.CONTROL_SCHEMA))
    (tmp_path / "ctl" / "versions" / "v2").mkdir()  # a run that died while writing
    assert tbl.current_version() == 1 and tbl.read().count() == 1
    for v in (0, 1):
        (tmp_path / "ctl" / "versions" / f"v{v}" / "_SUCCESS").unlink()
    with pytest.raises(RuntimeError):  # never reads as empty once versions exist
        tbl.read()


def test_export_text_orders_header_first(spark, tmp_path):
    from feedkit.sources.catalog import export_text
    d = spark.createDataFrame([(999, 0, "b"), (999, 0, "a"), (2, 1, "H2"), (1, 1, "H1")],
                              "REPORT_ORDER int, IS_HEADER int, REPORT_TEXT string")
    export_text(d, str(tmp_path / "out"))
    import glob
    lines = []
    for f in sorted(glob.glob(str(tmp_path / "out" / "part-*"))):
        lines += open(f).read().splitlines()
    assert lines == ["H1", "H2", "a", "b"]
