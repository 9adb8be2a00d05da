"""Adapters from the driver's TPC-H-like testdata to the feeds' data model.

Analogs: a *person* is a customer; *periods* are calendar quarters of order
dates (code ``yyyyQ0``, e.g. ``199820``) plus month sub-periods (``yyyyQm``,
m = 1..3 inside the quarter), so the 6th-character '0' rule and the season
suffix (last two characters 10/20/30/40) behave as in the reference's term
codes. Effective-dated history = orders per customer; activity = lineitems.

Every adapter is a lazy DataFrame derived from the given tables, so its size
grows with the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

AS_OF = dt.date(1998, 6, 15)
PERIOD_FLOOR = "199510"
# Run instant (UTC) used by the control queries: 14:00 UTC = 10:00 in New York.
NOW = dt.datetime(1998, 6, 15, 14, 0, 0)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def term_of(ts: str | Column) -> Column:
    """Quarter period code of a date/timestamp: ``yyyy`` + quarter + ``0``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(F.year(c).cast("string"), F.quarter(c).cast("string"), F.lit("0"))


def periods(orders: DataFrame) -> DataFrame:
    """Period table (code, year, start_date, end_date) of every month with orders.

    Bounded by the calendar span of the data (<= 16 rows per year), never by
    the row count, so it is safe to broadcast.
    """
    m = orders.select(F.trunc(F.to_date("o_orderdate"), "MM").alias("m")).distinct()
    y = F.year("m").cast("string")
    q = F.quarter("m")
    qstart = F.trunc("m", "quarter")
    quarters = m.select(F.concat(y, q.cast("string"), F.lit("0")).alias("code"), y.alias("year"),
                        qstart.alias("start_date"),
                        F.date_sub(F.add_months(qstart, 3), 1).alias("end_date"))
    months = m.select(F.concat(y, q.cast("string"), (F.month("m") - (q - 1) * 3).cast("string")).alias("code"),
                      y.alias("year"), F.col("m").alias("start_date"), F.last_day("m").alias("end_date"))
    return quarters.unionByName(months).distinct()


def fmt_day(c: str | Column) -> Column:
    """``yyyy-MM-dd`` text of a date/timestamp (engine-neutral output)."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd")


def fmt_ts(c: str | Column) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss")


class Testdata:
    """Lazy access to the testdata tables of one scale factor plus derived views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        # One DataFrame per table and query: the file listing happens once and
        # repeated uses share one relation, so Spark can reuse their exchanges.
        if name in TABLES:
            if name not in self._frames:
                self._frames[name] = load(self.spark, self.sf_dir, name)
            return self._frames[name]
        raise AttributeError(name)

    def periods(self) -> DataFrame:
        if "__periods" not in self._frames:
            self._frames["__periods"] = periods(self.orders)
        return self._frames["__periods"]

    def order_lines(self) -> DataFrame:
        """Lineitems with their order's customer (the activity analog)."""
        o = self.orders.select("o_orderkey", F.col("o_custkey").alias("custkey"), "o_orderdate")
        return self.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner").drop("o_orderkey")


def term_sql(x: str) -> str:
    """SQL of :func:`term_of`: quarter period code of a date/timestamp."""
    return f"concat(cast(year({x}) AS string), cast(quarter({x}) AS string), '0')"


def person_id_sql(x: str, prefix: str = "C") -> str:
    return f"concat('{prefix}', lpad(cast({x} AS string), 8, '0'))"


def course_sources(td: Testdata) -> dict[str, DataFrame]:
    """Testdata mapped onto the source tables of the daily feeds.

    Sections are parts ordered in a quarter, registrations are lineitems,
    persons are customers, e-mails come from events. NULLs are induced
    where the feeds have NULL rules (subject, transfer flag, add date).
    Each table is one SQL query over the testdata frames.
    """
    sql = td.spark.sql
    f = {"l": td.lineitem, "o": td.orders, "p": td.part, "c": td.customer, "n": td.nation, "r": td.region,
         "e": td.events}
    lop = "{l} JOIN {o} ON l_orderkey = o_orderkey JOIN {p} ON l_partkey = p_partkey"
    ssbsect = sql(f"""SELECT DISTINCT {term_sql('o_orderdate')} AS ssbsect_term_code, cast(l_partkey AS string) AS ssbsect_crn,
                         nullif(p_brand, 'Brand#1') AS ssbsect_subj_code, cast(p_size AS string) AS ssbsect_crse_numb,
                         substring(p_type, 1, 3) AS ssbsect_seq_numb FROM {lop}""", **f)
    sfrstcr = sql(f"""SELECT o_custkey AS sfrstcr_pidm, {term_sql('o_orderdate')} AS sfrstcr_term_code,
                         cast(l_partkey AS string) AS sfrstcr_crn,
                         CASE l_returnflag WHEN 'R' THEN 'DD' WHEN 'A' THEN 'RW' ELSE 'RE' END AS sfrstcr_rsts_code
                  FROM {{l}} JOIN {{o}} ON l_orderkey = o_orderkey""", **f)
    spriden = sql(f"""SELECT c_custkey AS spriden_pidm, {person_id_sql('c_custkey')} AS spriden_id, c_name AS spriden_last_name,
                         concat('F', cast(c_nationkey AS string)) AS spriden_first_name,
                         cast(NULL AS string) AS spriden_change_ind FROM {{c}}
                  UNION ALL
                  SELECT c_custkey, {person_id_sql('c_custkey', 'X')}, c_name, 'Old', 'N' FROM {{c}} WHERE c_acctbal < 0""", **f)
    study = sql(f"""
        SELECT o_custkey AS person_uid, {person_id_sql('o_custkey')} AS id, academic_period,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Graduate' WHEN 'AUTOMOBILE' THEN NULL ELSE 'Undergraduate' END
                 AS student_level_desc,
               CASE r_regionkey WHEN 0 THEN 'Freshmen' WHEN 1 THEN NULL ELSE r_name END AS student_classification_desc,
               concat(c_mktsegment, CASE WHEN c_nationkey = 3 THEN '"' ELSE '' END) AS major_desc,
               'Y' AS primary_program_ind, registered_ind
        FROM (SELECT o_custkey, {term_sql('o_orderdate')} AS academic_period,
                     max(CASE WHEN o_orderstatus = 'O' THEN 'Y' ELSE 'N' END) AS registered_ind
              FROM {{o}} GROUP BY o_custkey, {term_sql('o_orderdate')})
        JOIN {{c}} ON o_custkey = c_custkey JOIN {{n}} ON c_nationkey = n_nationkey JOIN {{r}} ON n_regionkey = r_regionkey""",
                **f)
    course = sql(f"""SELECT o_custkey AS person_uid, {term_sql('o_orderdate')} AS academic_period,
                        nullif(p_brand, 'Brand#1') AS subject, cast(p_size AS string) AS course_number,
                        CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN NULL ELSE 'N' END AS transfer_course_ind,
                        CASE WHEN l_linestatus = 'O' THEN to_date(l_shipdate) END AS section_add_date FROM {lop}""", **f)
    detail = sql("""SELECT c_custkey AS person_uid,
                           CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE concat('P', cast(c_nationkey AS string)) END
                             AS preferred_first_name,
                           concat('F"', cast(c_custkey AS string)) AS first_name,
                           substring(c_mktsegment, 1, 1) AS middle_initial, c_name AS last_name FROM {c}""", **f)
    goremal = sql("""SELECT user_id AS goremal_pidm,
                            CASE event_type WHEN 'purchase' THEN 'SCAD' WHEN 'signup' THEN 'STEM' ELSE 'OTHR' END
                              AS goremal_emal_code,
                            concat('U', cast(user_id AS string), '.', event_type, '@Example.ORG') AS goremal_email_address,
                            CASE WHEN value > 5 THEN 'A' ELSE 'I' END AS goremal_status_ind, ts AS goremal_activity_date
                     FROM {e}""", **f)
    stvterm = td.periods().selectExpr("code AS stvterm_code", "year AS stvterm_acyr_code",
                                      "start_date AS stvterm_start_date", "end_date AS stvterm_end_date")
    return {"saturn_stvterm": stvterm, "saturn_ssbsect": ssbsect, "saturn_sfrstcr": sfrstcr,
            "saturn_spriden": spriden, "odsmgr_academic_study": study, "odsmgr_student_course": course,
            "odsmgr_person_detail": detail, "general_goremal": goremal}
