"""Hourly housing demographics feed (F5) and its cohorts.

Plan shape (one pass per source, no nested loops):

1. Run parameters (current period, its year) are resolved once to literals.
2. Each cohort emits *thin* rows ``(grp_num, pidm, pulled_term, asof_term,
   levl, styp, majr)`` from its own deposits / control / registration logic.
3. Classification runs once over the distinct ``(pidm, levl, asof_term)``:
   as-of cumulative hours (O8) then the class band (O9).
4. The ~17 per-person lookups are one union of narrow rows, one shuffle by person
   and one aggregate, joined once.
5. Season winners are pivoted per person and the 72 fields are rendered.

Assumption stated for the thin plan: a person has one current identity row
(``spriden_change_ind IS NULL``) and one biographic row, as in the source system.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.context import RunContext, run_all, stage
from feedkit.functions.text import display_name, is_current, season_suffix
from feedkit.functions.text import s as sq
from feedkit.operators.asof import asof_cumulative, asof_join
from feedkit.operators.changes import changed_since, exclude_same_year, not_sent
from feedkit.operators.control import control_key
from feedkit.operators.latest import at_max, latest_per_key
from feedkit.operators.periods import collect_one, floor_period, run_params
from feedkit.operators.render import DATA_ORDER, header_frame, render_delimited
from feedkit.operators.rules import band_match, rules_with_attributes
from feedkit.operators.shape import apply_override, pivot_first, season_winner, union_cohorts
from feedkit.plans.course_feeds import term_periods
from feedkit.plans.people import (
    ADDRESS_COLS, ADDRESS_TYPES, CONTACT_COLS, PHONE_TYPES, address_rows, contact_rows, gpa_credits, phone_rows)
from feedkit.sources.catalog import Sources

# Fixed values that must equal the reference's: period floor, code sets, names, field list.
PERIOD_FLOOR = "201510"
HOUSING_DEPOSITS = ("DHOU", "DRST", "DHOS", "DRES", "DREH", "DOHK", "DHOK", "DPHK", "DHRS", "DHRA", "DHSA", "DHAT")
CAMPUS_DEPOSITS = ("DLAC", "DLAS")
ACADEMIC_HOLDS = ("RH", "AH", "VC", "AA", "LR", "NS", "IN", "ES", "GA", "GD", "AD", "UN", "RC")
INCIDENT_HOLDS = ("DI", "JS")
ACCOUNT_HOLDS = ("LF", "AM", "BR", "DH", "GR", "RB", "SA", "CO", "DC", "IL", "AT", "FA", "PP", "PW", "NC", "CA",
                 "RP", "TR", "LH", "FN")
CHANGE_HOLDS = ("RH", "AH", "AM", "BR", "DH", "DI", "GR", "AA", "RB", "LR", "SA", "CO", "DC", "NS", "IL", "IN",
                "AT", "ES", "GA", "GD", "AD", "UN", "RC", "CA", "RP", "JS", "TR", "LH", "FA")
REG_STATUSES = ("RE", "RW", "AU")
ALT_CAMPUS = "L"
STUDENT_TYPE_NAMES = {"P": "Graduate First Term", "F": "Freshman First Term", "D": "Dual Enrollment Freshman",
                      "A": "Graduate First Term", "J": "Freshman First Term"}
CAMP_RENAMES = {"O": "M"}
OVERRIDE_CAMPS = ("R", "RSM", "RSA")
OVERRIDE_RENAMES = {"RSA": "A", "RSM": "M"}
DEFAULT_CAMP = "M"
OVERRIDE_STUDENT_TYPE = "Rising Star"
OVERRIDE_APPL_TYPE = "R"
OVERRIDE_DECISIONS = ("MT", "RS", "ND")
ADMIT_DECISION = "CP"
CLOSED_APPL_STATUSES = ("1", "W")
ADVISOR_ROLE = "ADMCOUN"
SPORT_ACTIVE = "AC"
HOUSING_ATTRIBUTE = "HOUS"
STEM_EMAIL = "STEM"
CUM_GPA_TYPES = ("I", "T")
DEFAULT_COUNTRY = "US"
SEASONS = {"10": "t10_", "20": "t20_", "30": "t30_", "40": "t40_"}
PDATE_FORMAT = "MM/dd/yyyy hh:mm:ss a"
FIELDS = [
    "Entry.ID1", "Entry.ID2", "Entry.NameTitle", "Entry.NameLast", "Entry.NameFirst", "Entry.NameOther",
    "Entry.NamePreferred", "Entry.Birth_GenderEnum", "Entry.DOB", "EntryDetail.Married",
    "EntryDetail.Citizenship_CountryID.Abbreviation", "EntryDetail.Ethnicity", "Entry.DirectoryFlagPrivacy",
    "EntryAddress[Alternate Email].Email", "EntryAddress[Mailing].Email", "EntryAddress[Mailing].Street",
    "EntryAddress[Mailing].Street2", "EntryAddress[Mailing].City", "EntryAddress[Mailing].StateProvince",
    "EntryAddress[Mailing].ZipPostcode", "EntryAddress[Mailing].CountryID.Abbreviation",
    "EntryAddress[Mailing].Phone", "EntryAddress[Mailing].PhoneMobileCell", "EntryAddress[Home].Email",
    "EntryAddress[Home].Street", "EntryAddress[Home].Street2", "EntryAddress[Home].City",
    "EntryAddress[Home].StateProvince", "EntryAddress[Home].ZipPostcode", "EntryAddress[Home].CountryID.Abbreviation",
    "EntryAddress[Home].Phone", "EntryAddress[Home].PhoneMobileCell", "EntryAddress[Emergency].ContactName",
    "EntryAddress[Emergency].Street", "EntryAddress[Emergency].Street2", "EntryAddress[Emergency].City",
    "EntryAddress[Emergency].StateProvince", "EntryAddress[Emergency].ZipPostcode", "EntryAddress[Emergency].Phone",
    "EntryAddress[Emergency].Relationship", "EntryDetail.EnrollmentClass", "EntryDetail.EnrollmentLevel",
    "EntryDetail.EnrollmentStatus", "EntryDetail.EnrollmentTerm", "EntryDetail.AcademicHold",
    "EntryDetail.IncidentHold", "EntryDetail.AccountHold", "EntryDetail.Athlete", "EntryDetail.AthleteTeam",
    "EntryDetail.CurrentMajor", "EntryDetail.CurrentHours", "EntryDetail.CumulativeHours", "EntryDetail.CurrentGPA",
    "EntryDetail.CumulativeGPA", "EntryDetail.ExpectedGraduationDate", "EntryDetail.Residency",
    "EntryCustomField.AdmissionAdvisor", "EntryDetail.VisaDetails", "EntryCustomField.HousingExemptionIndicator",
    "EntryCustomField.FERPA", "EntryCustomField.FallTerm", "EntryCustomField.FallLocation",
    "EntryCustomField.FallHousingPaymentDate", "EntryCustomField.WinterTerm", "EntryCustomField.WinterLocation",
    "EntryCustomField.WinterHousingPaymentDate", "EntryCustomField.SpringTerm", "EntryCustomField.SpringLocation",
    "EntryCustomField.SpringHousingPaymentDate", "EntryCustomField.SummerTerm", "EntryCustomField.SummerLocation",
    "EntryCustomField.SummerHousingPaymentDate",
]



def _null_str() -> Column:
    return F.lit(None).cast("string")


def _rename(col: Column, mapping: dict[str, str]) -> Column:
    out = col
    for k, v in mapping.items():
        out = F.when(col == k, F.lit(v)).otherwise(out)
    return out


def _params(src: Sources, ctx: RunContext, floor: str = PERIOD_FLOOR) -> tuple[str | None, str | None]:
    p = collect_one(run_params(term_periods(src["saturn_stvterm"]), ctx.as_of_col(), floor=floor))
    return p["period_code"], p["period_year"]


def _ge(col: str, term: str | None) -> Column:
    return F.col(col) >= (F.lit(term) if term is not None else _null_str())


def _student_records(src: Sources) -> DataFrame:
    return src["saturn_sgbstdn"].select(
        F.col("sgbstdn_pidm").alias("g_pidm"), F.col("sgbstdn_term_code_eff").alias("g_eff"),
        F.col("sgbstdn_levl_code").alias("levl"), F.col("sgbstdn_styp_code").alias("styp"),
        F.col("sgbstdn_majr_code_1").alias("majr"), F.col("sgbstdn_camp_code").alias("g_camp"),
        F.col("sgbstdn_activity_date").alias("g_activity"))


def _term_years(src: Sources) -> DataFrame:
    """Every (code, year) row of the term table (duplicates kept, as a join to it would)."""
    return src["saturn_stvterm"].select(F.col("stvterm_code").alias("ty_code"), F.col("stvterm_acyr_code").alias("ty_year"))


def _deposit_years(src: Sources) -> DataFrame:
    """(person, year) of every housing deposit, for the same-year exclusions."""
    d = src["taismgr_tbrdepo"].filter(F.col("tbrdepo_detail_code_deposit").isin(list(HOUSING_DEPOSITS)))
    return (d.join(_term_years(src), F.col("tbrdepo_term_code") == F.col("ty_code"))
            .select(F.col("tbrdepo_pidm").alias("x_pidm"), F.col("ty_year").alias("x_year")).distinct())


def _keyed_control(control: DataFrame) -> DataFrame:
    return control.withColumn("c_key", control_key())


#: Tables that hold facts of a person, with their person columns.
PERSON_KEYS = {
    "general_gobintl": "gobintl_pidm", "general_gorvisa": "gorvisa_pidm", "general_goremal": "goremal_pidm",
    "saturn_saradap": "saradap_pidm", "saturn_sarappd": "sarappd_pidm", "saturn_saraatt": "saraatt_pidm",
    "saturn_sprhold": "sprhold_pidm", "saturn_sgrsprt": "sgrsprt_pidm", "saturn_spremrg": "spremrg_pidm",
    "saturn_spraddr": "spraddr_pidm", "saturn_sprtele": "sprtele_pidm", "saturn_sorainf": "sorainf_pidm",
    "saturn_sgbstdn": "sgbstdn_pidm", "saturn_shrtgpa": "shrtgpa_pidm", "saturn_shrlgpa": "shrlgpa_pidm",
    "taismgr_tbrdepo": "tbrdepo_pidm", "grailssf_ferpa": "student_pidm",
}


def of_people(src: Sources, rows: DataFrame) -> dict[str, DataFrame]:
    """The sources with every person's table cut to the people of ``rows`` before any aggregate or window."""
    people = stage(rows.select(F.col("pidm").alias("__who")).distinct(), "people")
    return {name: df.join(people, F.col(PERSON_KEYS[name]) == F.col("__who"), "left_semi") if name in PERSON_KEYS else df
            for name, df in src.items()}


# -- cohorts (thin rows) ----------------------------------------------------------------------

def cohort_new_deposits(src: Sources, control: DataFrame, term_in: str | None) -> DataFrame:
    """Latest housing-deposit term (on/after the current period), not yet sent for its year."""
    dep = src["taismgr_tbrdepo"].filter(F.col("tbrdepo_detail_code_deposit").isin(list(HOUSING_DEPOSITS))
                                        & _ge("tbrdepo_term_code", term_in))
    # MAX over deposits on/after the floor equals the overall MAX whenever that passes the floor.
    d = dep.groupBy(F.col("tbrdepo_pidm").alias("pidm")).agg(F.max("tbrdepo_term_code").alias("dterm"))
    g = at_max(_student_records(src), ["g_pidm"], "g_eff")
    base = d.join(g, F.col("pidm") == F.col("g_pidm"))
    yrs = _term_years(src).groupBy("ty_code").agg(F.min("ty_year").alias("d_year"))
    base = base.join(yrs, F.col("dterm") == F.col("ty_code"), "left")
    ctl = _keyed_control(control).filter(F.col("wsrsrez_status_ind") == "A")
    base = not_sent(base, ctl, ("pidm", "c_key"), cond=F.col("wsrsrez_last_acyr") >= F.col("d_year"))
    return base.select(F.lit(1).alias("grp_num"), "pidm", F.col("dterm").alias("pulled_term"),
                       F.col("dterm").alias("asof_term"), "levl", "styp", "majr")


def cohort_changed(src: Sources, control: DataFrame, term_in: str | None, year: str | None) -> DataFrame:
    """Already sent for the current year and active in any of 15 sources since."""
    g = at_max(_student_records(src), ["g_pidm"], "g_eff")
    ctl = _keyed_control(control).filter((F.col("wsrsrez_last_acyr") >= (F.lit(year) if year else _null_str()))
                                         & (F.col("wsrsrez_status_ind") == "A"))
    base = g.join(ctl, F.col("g_pidm") == F.col("c_key"))
    saradap = src["saturn_saradap"]
    admits = saradap.filter(~F.col("saradap_apst_code").isin(list(CLOSED_APPL_STATUSES))).join(
        src["saturn_sarappd"].filter(F.col("sarappd_apdc_code") == ADMIT_DECISION),
        (F.col("sarappd_pidm") == F.col("saradap_pidm"))
        & (F.col("sarappd_term_code_entry") == F.col("saradap_term_code_entry")), "left_semi")
    hold = src["saturn_sprhold"].filter(F.col("sprhold_hldd_code").isin(list(CHANGE_HOLDS))
                                        & (F.col("sprhold_release_ind") != "Y"))
    sport = src["saturn_sgrsprt"].filter((F.col("sgrsprt_term_code") == (F.lit(term_in) if term_in else _null_str()))
                                         & (F.col("sgrsprt_spst_code") == SPORT_ACTIVE)
                                         & (F.col("sgrsprt_elig_code") == SPORT_ACTIVE))
    deps = src["taismgr_tbrdepo"].filter(F.col("tbrdepo_detail_code_deposit").isin(list(HOUSING_DEPOSITS))
                                         & _ge("tbrdepo_term_code", term_in))
    arms = {
        "email": (src["general_goremal"].filter(F.col("goremal_emal_code") == STEM_EMAIL),
                  "goremal_pidm", "goremal_activity_date"),
        "address": (src["saturn_spraddr"].filter(F.col("spraddr_atyp_code").isin("MA", "PR")),
                    "spraddr_pidm", "spraddr_activity_date"),
        "phone": (src["saturn_sprtele"].filter(F.col("sprtele_tele_code").isin("MA", "PR")),
                  "sprtele_pidm", "sprtele_activity_date"),
        "identity": (src["saturn_spriden"].filter(is_current("spriden_change_ind")),
                     "spriden_pidm", "spriden_activity_date"),
        "bio": (src["saturn_spbpers"], "spbpers_pidm", "spbpers_activity_date"),
        "citizenship": (src["general_gobintl"], "gobintl_pidm", "gobintl_activity_date"),
        "visa": (src["general_gorvisa"], "gorvisa_pidm", "gorvisa_activity_date"),
        "emergency": (src["saturn_spremrg"], "spremrg_pidm", "spremrg_activity_date"),
        "admission": (admits, "saradap_pidm", "saradap_activity_date"),
        "advisor": (src["saturn_sorainf"].filter((F.col("sorainf_radm_code") == ADVISOR_ROLE)
                                                 & _ge("sorainf_term_code", term_in)),
                    "sorainf_pidm", "sorainf_activity_date"),
        "sport": (sport, "sgrsprt_pidm", "sgrsprt_activity_date"),
        "housing_attr": (src["saturn_saraatt"].filter(_ge("saraatt_term_code", term_in)
                                                      & (F.col("saraatt_atts_code") == HOUSING_ATTRIBUTE)),
                         "saraatt_pidm", "saraatt_activity_date"),
        "hold": (hold, "sprhold_pidm", "sprhold_activity_date"),
        "deposit": (deps, "tbrdepo_pidm", "tbrdepo_activity_date"),
    }
    ch = changed_since(base, "g_pidm", "wsrsrez_last_sent", arms, column_arms=[F.col("g_activity")])
    return ch.select(F.lit(2).alias("grp_num"), F.col("g_pidm").alias("pidm"),
                     F.col("wsrsrez_last_term").alias("pulled_term"),
                     (F.lit(term_in) if term_in else _null_str()).alias("asof_term"), "levl", "styp", "majr")


def cohort_campus(src: Sources, control: DataFrame, term_in: str | None) -> DataFrame:
    """Alternate-campus depositors without a housing deposit in the same year, never sent."""
    dep = src["taismgr_tbrdepo"].filter(F.col("tbrdepo_detail_code_deposit").isin(list(CAMPUS_DEPOSITS))
                                        & _ge("tbrdepo_term_code", term_in))
    d = dep.groupBy(F.col("tbrdepo_pidm").alias("pidm")).agg(F.max("tbrdepo_term_code").alias("dterm"))
    d = d.join(_term_years(src), F.col("dterm") == F.col("ty_code")).drop("ty_code")
    recs = _student_records(src).filter(F.col("g_camp") == ALT_CAMPUS)
    g = asof_join(d, recs, ["pidm"], ["g_pidm"], "dterm", "g_eff",
                  payload=["levl", "styp", "majr"], ties="all", how="inner")
    g = exclude_same_year(g, _deposit_years(src), ("pidm", "x_pidm"), ("ty_year", "x_year"))
    years = src["saturn_stvterm"].select(F.col("stvterm_acyr_code").alias("any_year")).distinct()
    ctl = _keyed_control(control).join(years, F.col("wsrsrez_last_acyr") == F.col("any_year"), "left_semi")
    g = not_sent(g, ctl, ("pidm", "c_key"))
    return g.select(F.lit(3).alias("grp_num"), "pidm", F.col("dterm").alias("pulled_term"),
                    F.col("dterm").alias("asof_term"), "levl", "styp", "majr")


def cohort_registered(src: Sources, control: DataFrame, term_in: str | None) -> DataFrame:
    """O20 (before grouping): active registrations on/after the current period, per registration term."""
    r = src["saturn_sfrstcr"].filter(F.col("sfrstcr_rsts_code").isin(list(REG_STATUSES))
                                     & _ge("sfrstcr_term_code", term_in))
    r = r.select(F.col("sfrstcr_pidm").alias("pidm"), F.col("sfrstcr_term_code").alias("rterm")).distinct()
    r = r.join(_term_years(src), F.col("rterm") == F.col("ty_code")).drop("ty_code")
    g = asof_join(r, _student_records(src), ["pidm"], ["g_pidm"], "rterm", "g_eff",
                  payload=["levl", "styp", "majr"], ties="all", how="inner")
    g = exclude_same_year(g, _deposit_years(src), ("pidm", "x_pidm"), ("ty_year", "x_year"))
    g = not_sent(g, _keyed_control(control), ("pidm", "c_key"),
                 cond=F.col("wsrsrez_last_acyr") >= F.col("ty_year"))
    return g.select(F.lit(4).alias("grp_num"), "pidm", F.col("rterm").alias("pulled_term"),
                    F.col("rterm").alias("asof_term"), "levl", "styp", "majr")


# -- classification and person rows -----------------------------------------------------------

def classify(thin: DataFrame, src: Sources) -> DataFrame:
    """Add level/type/major descriptions, class (as-of hours + band), GPA and credits."""
    lv = src["saturn_stvlevl"].select(F.col("stvlevl_code").alias("__lv"), F.col("stvlevl_desc").alias("lvl_desc"))
    st = src["saturn_stvstyp"].select(F.col("stvstyp_code").alias("styp_code"), F.col("stvstyp_desc").alias("styp_desc"))
    mj = src["saturn_stvmajr"].select(F.col("stvmajr_code").alias("__mj"), F.col("stvmajr_desc").alias("majr_desc"))
    t = (thin.join(lv, F.col("levl") == F.col("__lv")).drop("__lv")
         .join(st, F.col("styp") == F.col("styp_code"))
         .join(mj, F.col("majr") == F.col("__mj")).drop("__mj"))
    # Class: computed once per distinct (person, level, as-of term).
    keys = t.select("pidm", "levl", "asof_term").distinct()
    facts = src["saturn_shrtgpa"].filter(F.col("shrtgpa_gpa_type_ind").isin(list(CUM_GPA_TYPES)))
    cum = asof_cumulative(keys, facts, ["pidm", "levl"], ["shrtgpa_pidm", "shrtgpa_levl_code"], "asof_term",
                          "shrtgpa_term_code", "shrtgpa_hours_earned", "cum_hrs", default=0)
    rules = rules_with_attributes(src["saturn_sgrclsr"], src["saturn_sgrcatt"], "sgrclsr_seq_no", "sgrcatt_seq_no",
                                  "sgrcatt_atts_code",
                                  ["sgrclsr_seq_no", "sgrclsr_clas_code", "sgrclsr_levl_code", "sgrclsr_from_hours",
                                   "sgrclsr_to_hours"])
    cls = band_match(cum, rules, [("levl", "sgrclsr_levl_code")], "cum_hrs", "sgrclsr_from_hours",
                     "sgrclsr_to_hours", prefer=[("no_atts_flag", "desc"), ("sgrclsr_clas_code", "asc")],
                     out={"sgrclsr_clas_code": "clas_code"})
    cl = src["saturn_stvclas"].select(F.col("stvclas_code").alias("__cl"), F.col("stvclas_desc").alias("class_desc"))
    cls = cls.join(cl, F.substring("clas_code", 1, 2) == F.col("__cl"), "left") \
        .select(F.col("pidm").alias("__k_pidm"), F.col("levl").alias("__k_levl"),
                F.col("asof_term").alias("__k_term"), "class_desc")
    t = t.join(cls, (F.col("pidm") == F.col("__k_pidm")) & (F.col("levl") == F.col("__k_levl"))
               & F.col("asof_term").eqNullSafe(F.col("__k_term")), "left").drop("__k_pidm", "__k_levl", "__k_term")
    gpa = gpa_credits(src["saturn_shrlgpa"]).select(F.col("shrlgpa_pidm").alias("__g_pidm"),
                                                    F.col("shrlgpa_levl_code").alias("__g_levl"), "tmpGPA", "tmpCredit")
    t = t.join(gpa, (F.col("pidm") == F.col("__g_pidm")) & (F.col("levl") == F.col("__g_levl")), "left") \
        .drop("__g_pidm", "__g_levl").withColumn("tmpCredit", F.coalesce(F.col("tmpCredit"), F.lit(0)))
    status = _rename(F.col("styp_code"), STUDENT_TYPE_NAMES)
    status = F.when(F.col("styp_code").isin(list(STUDENT_TYPE_NAMES)), status).otherwise(F.col("styp_desc"))
    return t.withColumn("enrollment_status", status)


COHORT_COLS = ["grp_num", "pidm", "pulled_term", "lvl_desc", "enrollment_status", "majr_desc", "class_desc",
               "tmpGPA", "tmpCredit"]


def thin_cohorts(src: Sources, control: DataFrame, term_in: str | None, year: str | None) -> DataFrame:
    """The thin rows of the four cohorts, built at once and written together."""
    cohorts = {1: partial(cohort_new_deposits, src, control, term_in), 2: partial(cohort_changed, src, control, term_in, year),
               3: partial(cohort_campus, src, control, term_in), 4: partial(cohort_registered, src, control, term_in)}
    built = run_all({str(n): build for n, build in cohorts.items()})  # each stages what its own sweep reads
    return stage(union_cohorts({n: built[str(n)].drop("grp_num") for n in cohorts}), "cohorts")


def base_students(thin: DataFrame, src: Sources) -> DataFrame:
    """The cohorts' rows classified, with person attributes, UNION-distinct."""
    c = stage(classify(thin, src), "classified")
    first3 = c.filter(F.col("grp_num") != 4).select(*COHORT_COLS)
    reg = (c.filter(F.col("grp_num") == 4)
           .groupBy("grp_num", "pidm", "levl", "lvl_desc", "styp_code", "styp_desc", "enrollment_status", "majr_desc",
                    "class_desc")
           .agg(F.min("pulled_term").alias("pulled_term"), F.max("tmpGPA").alias("tmpGPA"),
                F.max("tmpCredit").alias("tmpCredit"))
           .select(*COHORT_COLS))
    rows = first3.unionByName(reg)
    person = src["saturn_spriden"].filter(is_current("spriden_change_ind")).join(
        src["saturn_spbpers"], F.col("spriden_pidm") == F.col("spbpers_pidm"))
    birth = F.col("spbpers_birth_date")
    if dict(person.dtypes).get("spbpers_birth_date") == "string":
        birth = F.try_to_date(birth, "dd-MMM-yyyy")
    person = person.select(
        F.col("spriden_pidm").alias("__p_pidm"), F.col("spriden_id").alias("entry_id1"),
        F.col("spbpers_name_prefix").alias("name_title"), F.col("spriden_last_name").alias("name_last"),
        display_name("spbpers_pref_first_name", "spriden_first_name").alias("name_first"),
        display_name("spbpers_pref_first_name", "spriden_first_name", fallback=None).alias("name_preferred"),
        F.col("spbpers_sex").alias("gender"), F.date_format(birth, "MM/dd/yyyy").alias("dob"),
        F.when(F.col("spbpers_confid_ind") == "Y", F.lit("1")).otherwise(F.lit("0")).alias("privacy"))
    return rows.join(person, F.col("pidm") == F.col("__p_pidm")).drop("__p_pidm").distinct()


# -- enrichment -------------------------------------------------------------------------------

def _greatest(df: DataFrame, key: str, name: str, order: list[str], cols: list[str]) -> DataFrame:
    """Rows of one attribute: the person and, as a struct, what its rows are ranked by and what is kept.

    The person's value is the greatest struct; a missing value ranks last, as in a descending order.
    """
    fields = [*((f"o{i}", c) for i, c in enumerate(order)), *((c, c) for c in cols if c not in order)]
    ranked = ", ".join(f"{sq(n)}, {c}" for n, c in fields)
    return df.selectExpr(f"{key} AS en_pidm", f"named_struct({ranked}) AS {name}")


def enrichment(src: Sources, ctx: RunContext, term_in: str | None) -> DataFrame:
    """All lookups of a person in one row (more only where a crosswalk repeats a code).

    Every table contributes narrow rows ``(person, one attribute's struct)``; their union is shuffled by
    person once, and one aggregate takes each attribute's greatest struct. What is only a flag comes from a
    hash aggregate over numbers, so that its many rows are not sorted with the others.
    """
    as_of = ctx.as_of_col()
    ap = src["saturn_saradap"]
    admitted = src["saturn_sarappd"].filter(F.col("sarappd_apdc_code") == ADMIT_DECISION)
    completed = ap.filter(~F.col("saradap_apst_code").isin(list(CLOSED_APPL_STATUSES))).join(
        admitted, (F.col("sarappd_pidm") == F.col("saradap_pidm"))
        & (F.col("sarappd_term_code_entry") == F.col("saradap_term_code_entry")), "left_semi")
    holds = src["saturn_sprhold"].filter(F.col("sprhold_to_date") > as_of)
    flags = {"academic_hold": ACADEMIC_HOLDS, "incident_hold": INCIDENT_HOLDS, "account_hold": ACCOUNT_HOLDS}
    held = [f"IF(sprhold_hldd_code IN ({', '.join(map(sq, codes))}), 1, 0) AS {name}" for name, codes in flags.items()]
    exempt = src["saturn_saraatt"].filter(F.col("saraatt_atts_code") == HOUSING_ATTRIBUTE).selectExpr("saraatt_pidm AS en_pidm", "1 AS housing_exempt")
    flagged = (exempt.unionByName(holds.selectExpr("sprhold_pidm AS en_pidm", *held), allowMissingColumns=True)
               .unionByName(src["grailssf_ferpa"].selectExpr("student_pidm AS en_pidm", "1 AS ferpa"), allowMissingColumns=True))
    flagged = flagged.groupBy("en_pidm").agg(*[F.max(c).alias(c) for c in ("housing_exempt", *flags, "ferpa")])
    sport = src["saturn_sgrsprt"].filter((F.col("sgrsprt_term_code") == (F.lit(term_in) if term_in else _null_str()))
                                         & (F.col("sgrsprt_spst_code") == SPORT_ACTIVE)
                                         & (F.col("sgrsprt_elig_code") == SPORT_ACTIVE))
    sport = sport.join(src["saturn_stvactc"], F.col("stvactc_code") == F.col("sgrsprt_actc_code"))
    mail = src["general_goremal"].filter((F.col("goremal_status_ind") == "A") & (F.col("goremal_emal_code") == STEM_EMAIL))
    homes = address_rows(src["saturn_spraddr"], src["scadsf_wxwalknation"], as_of)
    arms = [
        _greatest(src["general_gobintl"], "gobintl_pidm", "legal", ["gobintl_activity_date", "gobintl_natn_code_legal"], []),
        _greatest(src["general_gorvisa"], "gorvisa_pidm", "vtype", ["gorvisa_activity_date", "gorvisa_vtyp_code"], []),
        completed.selectExpr("saradap_pidm AS en_pidm", "saradap_term_code_entry AS term1"),
        _greatest(ap.filter(F.col("saradap_appl_no").isNotNull()), "saradap_pidm", "applied", ["saradap_appl_no", "saradap_term_code_entry"], []),
        flagged.selectExpr("en_pidm", "IF(housing_exempt = 1, 'Y', NULL) AS housing_exempt", *[f"CAST({c} AS STRING) AS {c}" for c in (*flags, "ferpa")]),
        _greatest(sport, "sgrsprt_pidm", "team", ["sgrsprt_activity_date", "stvactc_desc"], []),
        _greatest(mail, "goremal_pidm", "mail", ["goremal_activity_date", "goremal_email_address"], []),
        _greatest(contact_rows(src["saturn_spremrg"], src["saturn_stvrelt"]), "spremrg_pidm", "emgr",
                  ["spremrg_activity_date", "contact_name", "street_line1", "street_line2", "phone", "relt_desc"], ["city", "stat_code", "zip"]),
        *[_greatest(homes.filter(F.col("spraddr_atyp_code") == kind), "spraddr_pidm", kind.lower(),
                    ["spraddr_activity_date", "street_line1", "street_line2", "city", "zip", "iso"], ["stat_code"]) for kind in ADDRESS_TYPES],
        phone_rows(src["saturn_sprtele"]).selectExpr("sprtele_pidm AS en_pidm", *[
            f"CASE WHEN sprtele_tele_code = {sq(kind)} THEN rank END AS {kind.lower()}_tele" for kind in PHONE_TYPES]),
    ]
    rows = arms[0]
    for arm in arms[1:]:
        rows = rows.unionByName(arm, allowMissingColumns=True)
    best = rows.filter(F.col("en_pidm").isNotNull()).groupBy("en_pidm").agg(*[F.max(c).alias(c) for c in rows.columns if c != "en_pidm"])
    contact = {"contact_name": "o1", "street_line1": "o2", "street_line2": "o3", "phone": "o4", "relt_desc": "o5"}
    address = {"street_line1": "o1", "street_line2": "o2", "city": "o3", "zip": "o4", "iso": "o5"}
    best = best.selectExpr(
        "en_pidm", "legal.o1 AS legal", "vtype.o1 AS vtype", "term1", "applied.o1 AS term2", "housing_exempt", *flags,
        "team.o1 AS stvactc_desc", "ferpa", "mail.o1 AS goremal_email_address",
        *[f"emgr.{contact.get(c, c)} AS emgr_{c}" for c in CONTACT_COLS],
        *[f"{k.lower()}.{address.get(c, c)} AS {k.lower()}_{c}" for k in ADDRESS_TYPES for c in ADDRESS_COLS],
        *[f"{k.lower()}_tele.phone AS {k.lower()}_phone" for k in PHONE_TYPES])
    nations = src["scadsf_wxwalknation"].selectExpr("scadem_banner_code AS __nation", "sf_iso AS citizenship")
    visas = src["saturn_stvvtyp"].selectExpr("stvvtyp_code AS __vtype", "stvvtyp_desc AS visa")
    return (best.join(nations, F.col("legal") == F.col("__nation"), "left")
            .join(visas, F.col("vtype") == F.col("__vtype"), "left").drop("legal", "vtype", "__nation", "__vtype"))


def advisors(src: Sources) -> DataFrame:
    """O23 source: admission counselor name per (person, term), latest assignment."""
    who = src["saturn_spriden"].filter(is_current("spriden_change_ind")).select(
        F.col("spriden_pidm").alias("__a_pidm"),
        F.concat_ws(" ", "spriden_first_name", "spriden_last_name").alias("adviser"))
    s = src["saturn_sorainf"].filter(F.col("sorainf_radm_code") == ADVISOR_ROLE)
    s = s.join(who, F.col("sorainf_arol_pidm") == F.col("__a_pidm"))
    top = latest_per_key(s, ["sorainf_pidm", "sorainf_term_code"],
                         [F.col("sorainf_activity_date").desc_nulls_last(), F.col("adviser").desc_nulls_last()])
    return top.select(F.col("sorainf_pidm").alias("adv_pidm"), F.col("sorainf_term_code").alias("adv_term"), "adviser")


# -- seasons ----------------------------------------------------------------------------------

def season_terms(src: Sources) -> DataFrame:
    """Per person, the winning term / location / payment date of each season."""
    recs = _student_records(src)
    dep = src["taismgr_tbrdepo"].filter(F.col("tbrdepo_detail_code_deposit").isin(list(HOUSING_DEPOSITS))).select(
        F.col("tbrdepo_pidm").alias("pidm"), F.col("tbrdepo_term_code").alias("term"),
        F.date_format("tbrdepo_entry_date", PDATE_FORMAT).alias("pdate"))
    keys = dep.select("pidm", "term").distinct()
    camp = asof_join(keys, recs, ["pidm"], ["g_pidm"], "term", "g_eff", payload=["g_camp"],
                     tie_break=[F.col("g_camp").asc_nulls_first()])
    camp = camp.select(F.col("pidm").alias("__c_pidm"), F.col("term").alias("__c_term"),
                       _rename(F.col("g_camp"), CAMP_RENAMES).alias("camp"))
    a = dep.join(camp, (F.col("pidm") == F.col("__c_pidm")) & (F.col("term") == F.col("__c_term")), "left") \
        .drop("__c_pidm", "__c_term").withColumn("suffix", season_suffix("term"))
    cols = ["pidm", "suffix", "term", "camp", "pdate"]
    top_a = latest_per_key(a, ["pidm", "suffix"], [F.col("term").desc_nulls_last(), F.col("pdate").asc_nulls_first(),
                                                   F.col("camp").asc_nulls_first()]).select(*cols)
    b = recs.select(F.col("g_pidm").alias("pidm"), season_suffix("g_eff").alias("suffix"), F.col("g_eff").alias("term"),
                    _rename(F.col("g_camp"), CAMP_RENAMES).alias("camp"), _null_str().alias("pdate"))
    top_b = latest_per_key(b, ["pidm", "suffix"], [F.col("term").desc_nulls_last(),
                                                   F.col("camp").asc_nulls_first()]).select(*cols)
    w = season_winner([top_a, top_b], "pidm", "suffix", "term").drop("src")
    return pivot_first(apply_override(w, overrides(src), [("pidm", "ov_pidm"), ("term", "ov_term")], "camp",
                                      "rs_camp", OVERRIDE_CAMPS, DEFAULT_CAMP),
                       "pidm", "suffix", SEASONS, {"term": "term", "camp": "camp", "pdate": "pdate"})


def overrides(src: Sources) -> DataFrame:
    """Campus overrides per (person, entering term) from CRM opportunities (not de-duplicated)."""
    c = src["scadsf_sf_contact"]
    o = src["scadsf_sf_opportunity"].filter((F.col("student_type__c") == OVERRIDE_STUDENT_TYPE)
                                            & (F.col("isdeleted") != "Y"))
    j = c.join(o, F.col("contact__c") == F.col("id")).join(
        src["saturn_stvcamp"], F.col("location__c") == F.col("stvcamp_desc"))
    j = j.withColumn("ov_term", F.substring("entering_term__c", 1, 6))
    ok = src["saturn_saradap"].filter(F.col("saradap_styp_code") == OVERRIDE_APPL_TYPE).join(
        src["saturn_sarappd"].filter(F.col("sarappd_apdc_code").isin(list(OVERRIDE_DECISIONS))),
        (F.col("saradap_pidm") == F.col("sarappd_pidm"))
        & (F.col("saradap_term_code_entry") == F.col("sarappd_term_code_entry")))
    ok = ok.select(F.col("saradap_pidm").alias("__ok_pidm"), F.col("sarappd_term_code_entry").alias("__ok_term"))
    j = j.join(ok, (F.col("pidm") == F.col("__ok_pidm")) & (F.col("ov_term") == F.col("__ok_term")), "left_semi")
    return j.select(F.col("pidm").alias("ov_pidm"), "ov_term",
                    _rename(F.col("stvcamp_code"), OVERRIDE_RENAMES).alias("rs_camp"))


# -- the feed ---------------------------------------------------------------------------------

def query_rows(src: Sources, control: DataFrame, ctx: RunContext, floor: str = PERIOD_FLOOR) -> DataFrame:
    """One row per output line with the 72 fields plus the four control columns."""
    term_in, year = _params(src, ctx, floor)
    thin = thin_cohorts(src, control, term_in, year)
    src = of_people(src, thin)
    # The people are known now; what is to be known of them is independent of one another.
    parts = run_all({"base": lambda: stage(base_students(thin, src), "base"), "seasons": lambda: stage(season_terms(src), "seasons"),
                     "known": lambda: stage(enrichment(src, ctx, term_in), "known"), "advisors": lambda: stage(advisors(src), "advisors")})
    e = parts["base"].join(parts["known"], F.col("pidm") == F.col("en_pidm"), "left").drop("en_pidm")
    e = e.withColumn("enroll_term", F.coalesce("term1", "term2"))
    e = e.join(parts["advisors"], (F.col("pidm") == F.col("adv_pidm")) & (F.col("enroll_term") == F.col("adv_term")), "left") \
        .drop("adv_pidm", "adv_term")
    tp = parts["seasons"].withColumnRenamed("pidm", "__tp_pidm")
    e = e.join(tp, F.col("pidm") == F.col("__tp_pidm"), "left").drop("__tp_pidm")
    e = floor_period(e, "pulled_term", F.lit(term_in) if term_in else _null_str(),
                     term_periods(src["saturn_stvterm"]), "tmpPulledTerm", "tmpTermACYR")
    fields = ", ".join(f"{sq(n)}, {v}" for n, v in zip(FIELDS, _values_sql()))
    return (e.select(F.col("pidm").alias("tmpPidm"), "tmpTermACYR", "tmpPulledTerm", "grp_num",
                     F.expr(f"named_struct({fields})").alias("__f"))
            .select("tmpPidm", "tmpTermACYR", "tmpPulledTerm", "grp_num", "__f.*"))


def _values_sql() -> list[str]:
    """SQL of the 72 output fields over the enriched row, in FIELDS order."""
    null, zero = "CAST(NULL AS STRING)", "'0'"
    country = sq(DEFAULT_COUNTRY)
    seasons = [f"{p}{m}" for p in SEASONS.values() for m in ("term", "camp", "pdate")]
    values = [
        "entry_id1", null, "name_title", "name_last", "name_first", null, "name_preferred", "gender", "dob", zero,
        f"coalesce(citizenship, {country})", null, "privacy", null, "goremal_email_address",
        "ma_street_line1", "ma_street_line2", "ma_city", "ma_stat_code", "ma_zip", "ma_iso", "ma_phone", "mob_phone",
        null, "pr_street_line1", "pr_street_line2", "pr_city", "pr_stat_code", "pr_zip", "pr_iso", "pr_phone", null,
        "emgr_contact_name", "emgr_street_line1", "emgr_street_line2", "emgr_city", "emgr_stat_code", "emgr_zip",
        "emgr_phone", "emgr_relt_desc", "class_desc", "lvl_desc", "enrollment_status", "enroll_term",
        f"coalesce(academic_hold, {zero})", f"coalesce(incident_hold, {zero})", f"coalesce(account_hold, {zero})",
        f"CASE WHEN stvactc_desc IS NOT NULL THEN '1' ELSE {zero} END", "stvactc_desc", "majr_desc", zero,
        "coalesce(tmpCredit, 0)", zero, "coalesce(tmpGPA, 0)", null, null, "adviser", f"coalesce(visa, {country})",
        "housing_exempt", f"coalesce(ferpa, {zero})", *seasons,
    ]
    assert len(values) == len(FIELDS)
    return values


def housing_feed(src: Sources, control: DataFrame, ctx: RunContext, floor: str = PERIOD_FLOOR) -> DataFrame:
    """data lines (pipe-delimited 72 fields) UNION ALL the header line.

    ``floor``: periods at or below it are never current (the reference's value by default).
    """
    q = query_rows(src, control, ctx, floor)
    data = q.select("tmpPidm", "tmpTermACYR", "tmpPulledTerm", "grp_num", F.lit(DATA_ORDER).alias("REPORT_ORDER"),
                    F.lit(0).alias("IS_HEADER"), render_delimited(FIELDS, "|").alias("REPORT_TEXT"))
    hdr = header_frame(q.sparkSession, ["|".join(FIELDS)])
    hdr = hdr.select(F.lit(None).cast(data.schema["tmpPidm"].dataType).alias("tmpPidm"),
                     _null_str().alias("tmpTermACYR"), _null_str().alias("tmpPulledTerm"),
                     F.lit(None).cast("int").alias("grp_num"), "REPORT_ORDER", "IS_HEADER", "REPORT_TEXT")
    return data.unionByName(hdr)
