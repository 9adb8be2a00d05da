"""Daily person feed (F1): registered primary-program students of the current term.

One line per person (and distinct name/e-mail/major combination) with the
ordered course list, rendered as a quoted CSV line under the header block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.context import RunContext
from feedkit.functions.text import patron_class, quoted_field_safe
from feedkit.operators.latest import preferred
from feedkit.operators.render import Lit, data_rows, render_quoted, with_header
from feedkit.operators.shape import ordered_list, with_rows
from feedkit.plans.course_feeds import _code_eq, started_term
from feedkit.sources.catalog import Sources

# Fixed values that must equal the reference's: header block, e-mail code preference, status.
PERSON_HEADER = ["__BEGIN_CONFIG__,,,,,,,,", "VERSION,2,,,,,,,", "TYPE,PERSON,,,,,,,", "ORIGIN,EXTERNAL,,,,,,,",
                 "LOOKUP_COLUMNS,USERID,,,,,,,",
                 "IMPORT_COLUMNS,PATRON-CLASS,FIRST-NAME,OTHER-NAME,LAST-NAME,STATUS,EMAIL,DEPARTMENT,NOTE",
                 "__BEGIN_DATA__,,,,,,,,", ",,,,,,,,",
                 '"USERID","PATRON-CLASS","FIRST-NAME","OTHER-NAME","LAST-NAME","STATUS","EMAIL","DEPARTMENT","NOTE"']
EMAIL_CODES = ("SCAD", "STEM")
STATUS = "ACTIVE"

LEAD = ["PIDM", "ID", "PATRON", "FIRST_NAME", "MIDDLE_INITIAL", "LAST_NAME", "STATUS", "SCAD_EMAIL",
        "MAJR_DESC1", "COURSES"]


def preferred_email(goremal: DataFrame, codes: Sequence[str] = EMAIL_CODES) -> DataFrame:
    """Active e-mail per person, lower-cased, first code in ``codes`` wins.

    Rows with the same code are ordered by address (the reference leaves that
    choice open).
    """
    e = goremal.withColumn("__addr", F.lower("goremal_email_address"))
    top = preferred(e, "goremal_pidm", "goremal_emal_code", codes, tie_break=[F.col("__addr").asc_nulls_last()],
                    where=F.col("goremal_status_ind") == "A")
    return top.select(F.col("goremal_pidm").alias("__em_pidm"), F.col("__addr").alias("__em_addr"))


def person_rows(src: Sources, term: str | None) -> DataFrame:
    ast = src["odsmgr_academic_study"].filter((F.col("primary_program_ind") == "Y") & (F.col("registered_ind") == "Y")
                                              & _code_eq("academic_period", term))
    sc = src["odsmgr_student_course"].filter((F.col("transfer_course_ind") != "Y") & F.col("section_add_date").isNotNull()
                                             & _code_eq("academic_period", term))
    sc = sc.select(F.col("person_uid").alias("__sc_uid"), F.col("academic_period").alias("__sc_period"),
                   "subject", "course_number")
    pd = src["odsmgr_person_detail"].select(F.col("person_uid").alias("__pd_uid"), "preferred_first_name",
                                            "first_name", "middle_initial", "last_name")
    j = (ast.join(sc, (F.col("__sc_uid") == F.col("person_uid")) & (F.col("__sc_period") == F.col("academic_period")))
         .join(pd, F.col("__pd_uid") == F.col("person_uid"))
         .join(preferred_email(src["general_goremal"]), F.col("__em_pidm") == F.col("person_uid"), "left"))
    j = j.select(F.col("person_uid").alias("PIDM"), F.col("id").alias("ID"),
                 patron_class("student_level_desc", "student_classification_desc").alias("PATRON"),
                 F.nvl("preferred_first_name", "first_name").alias("__first"),
                 F.col("middle_initial").alias("__middle"), F.col("last_name").alias("__last"),
                 F.coalesce("__em_addr", F.lit("")).alias("SCAD_EMAIL"), F.col("major_desc").alias("MAJR_DESC1"),
                 "subject", "course_number")
    item = F.concat(F.coalesce("subject", F.lit("")), F.coalesce("course_number", F.lit("")))
    keys = ["PIDM", "ID", "PATRON", "__first", "__middle", "__last", "SCAD_EMAIL", "MAJR_DESC1"]
    g = ordered_list(j, keys, item, ["subject", "course_number"], ";", out="COURSES")
    # Grouped by the raw names; quotes are stripped afterwards (equal lines merge in the UNION).
    return g.select("PIDM", "ID", "PATRON", quoted_field_safe("__first").alias("FIRST_NAME"),
                    quoted_field_safe("__middle").alias("MIDDLE_INITIAL"),
                    quoted_field_safe("__last").alias("LAST_NAME"), F.lit(STATUS).alias("STATUS"),
                    "SCAD_EMAIL", "MAJR_DESC1", "COURSES")


def person_feed(src: Sources, ctx: RunContext, extra_rows: Sequence[Sequence[object]] = ()) -> DataFrame:
    """person lines (UNION with configured extra rows) under the header block.

    ``extra_rows`` are full rows in ``LEAD`` order (configuration, synthetic
    values in tests). A NULL ID makes the whole line NULL, as in the reference.
    """
    rows = person_rows(src, started_term(src, ctx))
    # One distinct, before the lines are rendered: names that differ in quotes alone merge here.
    rows = with_rows(rows, extra_rows, distinct=True) if extra_rows else rows.distinct()
    text = render_quoted(["ID", "PATRON", "FIRST_NAME", "MIDDLE_INITIAL", "LAST_NAME", Lit(STATUS),
                          "SCAD_EMAIL", "MAJR_DESC1", "COURSES"], raw=["ID", "SCAD_EMAIL"])
    return with_header(data_rows(rows, LEAD, text), PERSON_HEADER)
