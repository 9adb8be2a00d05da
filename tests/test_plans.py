"""Scale properties pinned on the physical plan (regression guards for the README claims)."""

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from feedkit.context import RunContext
from feedkit.operators import asof, latest
from feedkit.operators.control import CONTROL_SCHEMA
from feedkit.plans import course_feeds as cf
from feedkit.plans import housing as hz
from feedkit.plans import twins
from feedkit.sources.catalog import Namespace, read_sources

CTX = RunContext.at(fx.AS_OF, fx.NOW)


def plan(df) -> str:
    """Physical plan text with scan metadata (pushed filters) printed in full."""
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def test_top1_is_limited_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id AS v")
    p = plan(latest.latest_per_key(df, ["k"], [F.desc("v")]))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_asof_sweep_is_partitioned_by_key_and_stretch(spark):
    left = spark.range(50).selectExpr("id % 3 AS k", "id AS x")
    right = spark.range(50).selectExpr("id % 3 AS rk", "id AS e", "id AS p")
    p = plan(asof.asof_join(left, right, ["k"], ["rk"], "x", "e", ["p"], hot_rows=10))
    assert "__b" in p and "Window" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


@pytest.mark.parametrize("build", [lambda lft, rgt: asof.asof_join(lft, rgt, ["k"], ["rk"], "x", "e", ["p"], ties="unique"),
                                   lambda lft, rgt: asof.asof_cumulative(lft, rgt, ["k"], ["rk"], "x", "e", "p", "sum")])
def test_asof_reads_its_inputs_once_and_shuffles_once(spark, build):
    left = spark.range(50).selectExpr("id % 3 AS k", "id AS x")
    right = spark.range(50).selectExpr("id % 3 AS rk", "id AS e", "id AS p")
    p = plan(build(left, right))
    assert p.count("FileScan parquet") == 1 and p.count("Exchange hashpartitioning") == 1 and "Range (" not in p


@pytest.fixture(scope="module")
def parquet_src(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("src")
    for name, df in fx.make_sources(spark).items():
        df.write.parquet(str(root / f"{name}.parquet"))
    return read_sources(spark, Namespace(root=str(root)), fx.SCHEMAS)


def test_period_literal_reaches_the_parquet_scan(parquet_src):
    p = plan(cf.section_member_feed(parquet_src, CTX))
    assert "EqualTo(ssbsect_term_code,202340)" in p
    assert "EqualTo(sfrstcr_term_code,202340)" in p


@pytest.mark.parametrize("build", [
    lambda src, spark: cf.section_member_feed(src, CTX),
    lambda src, spark: cf.group_feed(src, CTX),
    lambda src, spark: hz.housing_feed(src, spark.createDataFrame([], CONTROL_SCHEMA), CTX),
])
def test_feeds_have_no_nested_loops_or_cartesian_products(spark, parquet_src, build):
    p = plan(build(parquet_src, spark))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_housing_deposit_filter_reaches_the_scan(parquet_src, spark):
    p = plan(hz.cohort_new_deposits(parquet_src, spark.createDataFrame([], CONTROL_SCHEMA), "202410"))
    assert "GreaterThanOrEqual(tbrdepo_term_code,202410)" in p


def test_housing_feed_scans_each_source_a_handful_of_times(parquet_src, spark):
    """The cohorts are written once; what follows reads them and each source's rows of their people."""
    p = plan(hz.housing_feed(parquet_src, spark.createDataFrame([], CONTROL_SCHEMA), CTX))
    assert p.count("FileScan parquet") < 100


@pytest.fixture(scope="module")
def small_tables(spark, tmp_path_factory):
    """Testdata tables of 5000 orders with one event, customer and two lineitems for some of them."""
    root = tmp_path_factory.mktemp("tables")
    day = "timestamp_ntz'1998-01-01 00:00:00' + make_dt_interval(cast(id % 300 AS int))"
    tables = {
        "region": spark.range(5).selectExpr("cast(id AS int) r_regionkey", "concat('REGION', id) r_name"),
        "nation": spark.range(25).selectExpr("cast(id AS int) n_nationkey", "concat('NATION', id) n_name", "cast(id % 5 AS int) n_regionkey"),
        "customer": spark.range(500).selectExpr(
            "id c_custkey", "concat('Customer', id) c_name", "cast(id % 25 AS int) c_nationkey", "cast(id % 700 AS double) - 50 c_acctbal",
            "element_at(array('BUILDING', 'MACHINERY', 'AUTOMOBILE', 'HOUSEHOLD', 'FURNITURE'), cast(id % 5 + 1 AS int)) c_mktsegment"),
        "part": spark.range(10).selectExpr("id p_partkey", "concat('Brand#', id) p_brand", "concat('TYPE', id) p_type", "cast(id AS int) p_size"),
        "orders": spark.range(5000).selectExpr(
            "id o_orderkey", "id % 500 o_custkey", "element_at(array('F', 'O', 'P'), cast(id % 3 + 1 AS int)) o_orderstatus",
            "cast(id * 90 AS double) o_totalprice", f"{day} o_orderdate",
            "element_at(array('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'), cast(id % 7 % 5 + 1 AS int)) o_orderpriority"),
        "lineitem": spark.range(10000).selectExpr(
            "id div 2 l_orderkey", "id % 10 l_partkey", "cast(id % 50 AS double) l_quantity", "0.1D l_tax",
            "element_at(array('R', 'N', 'A'), cast(id % 3 + 1 AS int)) l_returnflag",
            "element_at(array('O', 'F'), cast(id % 2 + 1 AS int)) l_linestatus", f"{day} l_shipdate"),
        "events": spark.range(1000).selectExpr(
            "id event_id", "id % 500 user_id", "element_at(array('purchase', 'signup', 'view'), cast(id % 3 + 1 AS int)) event_type",
            "cast(id % 10 AS double) value", f"{day} ts"),
    }
    for name, df in tables.items():
        df.write.parquet(str(root / f"{name}.parquet"))
    return str(root)


@pytest.fixture()
def threshold_below_the_tables(spark):
    """Broadcasts up to 8 KB: a handful of codes, and no more than that of the tables of ``small_tables``."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8192")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_contacts_are_shuffled_by_person_only(spark, small_tables, threshold_below_the_tables):
    """Three relation codes would put all contacts into three tasks."""
    p = plan(twins.q_contact_best(spark, small_tables))
    assert "hashpartitioning(spremrg_relt_code" not in p and p.count("Exchange hashpartitioning") == 1


def test_code_tables_of_the_housing_feed_are_file_scans(spark, small_tables, threshold_below_the_tables):
    src, _ = twins._housing_inputs(spark, small_tables)
    for code in ("relt", "actc", "levl", "styp", "majr", "vtyp", "camp"):
        p = plan(src[f"saturn_stv{code}"])
        assert "FileScan parquet" in p and "Aggregate" not in p, code
    p = plan(hz.enrichment(src, CTX, "199820"))
    for few in ("spremrg_relt_code", "sgrsprt_actc_code", "vtype"):
        assert f"hashpartitioning({few}" not in p


def test_lineitems_of_the_housing_feed_meet_their_orders_once(spark, small_tables):
    src = twins._housing_sources(twins.Testdata(spark, small_tables))
    for name in ("taismgr_tbrdepo", "saturn_shrtgpa", "saturn_saraatt", "saturn_sgbstdn"):
        p = plan(src[name])
        assert "FileScan parquet" in p and "Join" not in p and "Exchange" not in p, name


def test_flags_of_a_person_are_numbers_until_they_are_aggregated(spark):
    src = {**fx.make_sources(spark)}
    p = plan(hz.enrichment(src, CTX, "202410"))
    assert "HashAggregate(keys=[en_pidm" in p and "partial_max(housing_exempt" in p
