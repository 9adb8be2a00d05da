"""Daily course feeds: groups (F2), sections (F3), section members.

Sources use the source-table names and columns listed in FIXTURES.md. The
current and next periods are resolved once into literals, so the period
predicates reach the parquet scans of the section and registration tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.context import RunContext
from feedkit.functions.text import is_current
from feedkit.operators.periods import collect_one, current_period, next_period
from feedkit.operators.render import data_rows, render_quoted, with_header
from feedkit.sources.catalog import Sources

# Fixed values that must equal the reference's: header blocks and the organization name.
GROUP_HEADER = ["__BEGIN_CONFIG__,,", "VERSION,2,", "TYPE,GROUP,", "ORIGIN,EXTERNAL,",
                "LOOKUP_COLUMNS,GROUP-IDENTIFIER", "IMPORT_COLUMNS,NAME,ORGANIZATION", "__BEGIN_DATA__,,", ",,",
                "GROUP-IDENTIFIER,NAME,ORGANIZATION"]
SECTION_HEADER = ["__BEGIN_CONFIG__,,", "VERSION,2,", "TYPE,SECTION,", "ORIGIN,EXTERNAL,",
                  "LOOKUP_COLUMNS,SECTION-IDENTIFIER", "IMPORT_COLUMNS,NAME,GROUP", "__BEGIN_DATA__,,", ",,",
                  "SECTION-IDENTIFIER,NAME,GROUP"]
MEMBER_HEADER = ["__BEGIN_CONFIG__,,", "VERSION,2,", "TYPE,SECTION-MEMBER,", "ORIGIN,EXTERNAL,",
                 "LOOKUP_COLUMNS,SECTION,MEMBER", "IMPORT_COLUMNS,START-DATE,END-DATE", "__BEGIN_DATA__,,", ",,",
                 "SECTION,MEMBER,START-DATE,END-DATE"]
ORGANIZATION = "WebCheckout"


def term_periods(stvterm: DataFrame) -> DataFrame:
    """The term table as a period table (code, year, start_date, end_date)."""
    return stvterm.select(F.col("stvterm_code").alias("code"), F.col("stvterm_acyr_code").alias("year"),
                          F.col("stvterm_start_date").alias("start_date"),
                          F.col("stvterm_end_date").alias("end_date"))


def started_term(src: Sources, ctx: RunContext) -> str | None:
    """Latest started quarter term (6th character '0') on the run date."""
    p = term_periods(src["saturn_stvterm"])
    return collect_one(current_period(p, ctx.as_of_col(), "latest_started", suffix="0"))["period_code"]


def next_term(src: Sources, ctx: RunContext) -> str | None:
    p = term_periods(src["saturn_stvterm"])
    return collect_one(next_period(p, ctx.as_of_col(), suffix="0"))["period_code"]


def _code_lit(code: str | None):
    return F.lit(code) if code is not None else F.lit(None).cast("string")


def _code_eq(col: str, code: str | None):
    # A missing period compares with NULL, which keeps no rows (as `= NULL` does).
    return F.col(col) == _code_lit(code)


def _sections(src: Sources, term: str | None) -> DataFrame:
    terms = src["saturn_stvterm"].filter(_code_eq("stvterm_code", term)).select("stvterm_code")
    s = src["saturn_ssbsect"].filter(_code_eq("ssbsect_term_code", term))
    # Inner join to the term row(s); the result is made distinct, so a semi join
    # plus the code literal gives the same rows without fan-out.
    return s.join(terms.distinct(), F.col("ssbsect_term_code") == F.col("stvterm_code"), "inner")


def _dash(*cols: str):
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("-"))
        parts.append(F.coalesce(F.col(c), F.lit("")))
    return F.concat(*parts)


def group_feed(src: Sources, ctx: RunContext) -> DataFrame:
    """distinct subject-number groups of the current term as quoted lines + header."""
    term = started_term(src, ctx)
    g = _sections(src, term).select(_dash("ssbsect_subj_code", "ssbsect_crse_numb").alias("GROUP_IDENTIFIER"),
                                    _dash("ssbsect_subj_code", "ssbsect_crse_numb").alias("NAME"),
                                    F.lit(ORGANIZATION).alias("ORGANIZATION")).distinct()
    cols = ["GROUP_IDENTIFIER", "NAME", "ORGANIZATION"]
    return with_header(data_rows(g, cols, render_quoted(cols)), GROUP_HEADER)  # rows are distinct already


def section_feed(src: Sources, ctx: RunContext) -> DataFrame:
    """distinct sections of the current term with their parent group."""
    term = started_term(src, ctx)
    ident = F.concat(F.coalesce(F.col("ssbsect_crn"), F.lit("")), F.lit("."),
                     F.coalesce(F.col("stvterm_code"), F.lit("")))
    s = _sections(src, term).select(ident.alias("SECTION_IDENTIFIER"),
                                    _dash("ssbsect_subj_code", "ssbsect_crse_numb", "ssbsect_seq_numb").alias("NAME"),
                                    _dash("ssbsect_subj_code", "ssbsect_crse_numb").alias("GROUP")).distinct()
    cols = ["SECTION_IDENTIFIER", "NAME", "GROUP"]
    return with_header(data_rows(s, cols, render_quoted(cols)), SECTION_HEADER)  # rows are distinct already


@dataclass(frozen=True)
class InjectedMember:
    """Configuration: list ``member_id`` in every current section of ``source_pidm``."""

    source_pidm: object
    member_id: str


def term_starts(src: Sources, code: str | None) -> Column:
    """The start dates of one period code as an array, a scalar subquery over the calendar table.

    A code table has one row per code. Where a code repeats, every distinct start date fans out as a
    join to it would, a missing date included.
    """
    rows = src["saturn_stvterm"].filter(_code_eq("stvterm_code", code))
    return rows.agg(F.collect_set(F.struct(F.col("stvterm_start_date").cast("date").alias("start")))).scalar()


def section_members(src: Sources, term: str | None, next_code: str | None,
                    injected: InjectedMember | None = None) -> DataFrame:
    """Distinct (section, member, start, end) of the current term.

    End date = next term's start - 1 day; with no next term there are no rows.
    Both start dates are period parameters, attached by scalar subqueries.
    """
    sect = src["saturn_ssbsect"].filter(_code_eq("ssbsect_term_code", term)).select("ssbsect_term_code", "ssbsect_crn")
    reg = src["saturn_sfrstcr"].filter(_code_eq("sfrstcr_term_code", term)) \
        .select("sfrstcr_pidm", "sfrstcr_term_code", "sfrstcr_crn")
    j = sect.join(reg, (F.col("ssbsect_term_code") == F.col("sfrstcr_term_code"))
                  & (F.col("ssbsect_crn") == F.col("sfrstcr_crn")))
    j = j.withColumn("a_starts", term_starts(src, term)).withColumn("z_starts", term_starts(src, next_code))
    j = j.withColumn("a", F.explode("a_starts")).withColumn("z", F.explode("z_starts"))
    j = j.withColumn("a_start", F.col("a.start")).withColumn("z_start", F.col("z.start"))
    section = F.concat(F.coalesce(F.col("ssbsect_crn"), F.lit("")), F.lit("."), F.coalesce(F.col("ssbsect_term_code"), F.lit("")))
    start = F.date_format("a_start", "MM/dd/yyyy")
    end = F.date_format(F.date_add("z_start", -1), "MM/dd/yyyy")
    people = src["saturn_spriden"].filter(is_current("spriden_change_ind")).select("spriden_pidm", "spriden_id")
    # The injected member joins its person's rows as one more id of the same row, with or without a current identity.
    members = j.join(people, F.col("sfrstcr_pidm") == F.col("spriden_pidm"), "inner" if injected is None else "left")
    ids = F.array(F.col("spriden_id"))
    if injected is not None:
        current = F.when(F.col("spriden_pidm").isNotNull(), ids).otherwise(F.array().cast("array<string>"))
        extra = F.when(F.col("sfrstcr_pidm") == F.lit(injected.source_pidm), F.array(F.lit(injected.member_id))).otherwise(
            F.array().cast("array<string>"))
        ids = F.concat(current, extra)
    return members.select(section.alias("section_col"), F.explode(ids).alias("member_col"),
                          start.alias("start_date_col"), end.alias("end_date_col")).distinct()


def section_member_feed(src: Sources, ctx: RunContext, injected: InjectedMember | None = None) -> DataFrame:
    """section members as quoted lines + header (UNION ALL)."""
    rows = section_members(src, started_term(src, ctx), next_term(src, ctx), injected)
    cols = ["section_col", "member_col", "start_date_col", "end_date_col"]
    return with_header(data_rows(rows, cols, render_quoted(cols)), MEMBER_HEADER, distinct=False)
