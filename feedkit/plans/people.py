"""Per-person detail builders used by the housing feed.

Inputs use the source-table column names listed in FIXTURES.md; each
function returns at most one row per person (and type), chosen with a full
tie-break so repeated runs give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.functions.text import format_phone, join_lines, missing, open_on
from feedkit.operators.latest import latest_per_key

# Fixed values that must equal the reference's: phone and address type codes.
PHONE_TYPES = ("MA", "MOB", "PR")
ADDRESS_TYPES = ("MA", "PR")
DEFAULT_ISO = "US"


def gpa_credits(shrlgpa: DataFrame, gpa_type: str = "O") -> DataFrame:
    """GPA (4 decimals) and earned hours (NULL->0, 3 decimals) per (person, level).

    The reference keeps an arbitrary row per key; here the row with most hours,
    then highest GPA, wins.
    """
    g = shrlgpa.filter(F.col("shrlgpa_gpa_type_ind") == gpa_type).select(
        "shrlgpa_pidm", "shrlgpa_levl_code",
        F.round(F.col("shrlgpa_gpa").cast("double"), 4).alias("tmpGPA"),
        F.round(F.coalesce(F.col("shrlgpa_hours_earned"), F.lit(0)).cast("double"), 3).alias("tmpCredit"))
    return latest_per_key(g, ["shrlgpa_pidm", "shrlgpa_levl_code"],
                          [F.col("tmpCredit").desc_nulls_last(), F.col("tmpGPA").desc_nulls_last()])


def phone_rows(sprtele: DataFrame, types: Sequence[str] = PHONE_TYPES, max_len: int = 12) -> DataFrame:
    """Active phones with ``rank``: the greatest is primary first, then of the highest sequence number."""
    src = sprtele.filter(F.col("sprtele_status_ind").isNull() & F.col("sprtele_tele_code").isin(list(types)))
    return src.withColumn("phone", format_phone("sprtele_phone_area", "sprtele_phone_number", max_len)).selectExpr(
        "sprtele_pidm", "sprtele_tele_code", "phone",
        "named_struct('main', IF(sprtele_primary_ind = 'Y', 1, 0), 'seqno', sprtele_seqno, 'noted', sprtele_activity_date, 'phone', phone) AS rank")


def phones(sprtele: DataFrame, types: Sequence[str] = PHONE_TYPES, max_len: int = 12) -> DataFrame:
    """Active phone per (person, type): primary first, then highest sequence number."""
    top = latest_per_key(phone_rows(sprtele, types, max_len), ["sprtele_pidm", "sprtele_tele_code"], [F.col("rank").desc()])
    return top.select("sprtele_pidm", "sprtele_tele_code", "phone")


ADDRESS_COLS = ("street_line1", "street_line2", "city", "stat_code", "zip", "iso")
CONTACT_COLS = ("contact_name", "street_line1", "street_line2", "city", "stat_code", "zip", "phone", "relt_desc")


def address_rows(spraddr: DataFrame, crosswalk: DataFrame, as_of: Column, types: Sequence[str] = ADDRESS_TYPES) -> DataFrame:
    """Active addresses, nation mapped to ISO ('US' default), a row per crosswalk row of the nation."""
    a = spraddr.filter(F.col("spraddr_atyp_code").isin(list(types)) & F.col("spraddr_status_ind").isNull()
                       & open_on("spraddr_to_date", as_of))
    xw = crosswalk.select(F.col("scadem_banner_code").alias("__xw_code"), F.col("sf_iso").alias("__xw_iso"))
    a = a.join(xw, F.col("__xw_code") == F.col("spraddr_natn_code"), "left")
    return a.select(
        "spraddr_pidm", "spraddr_atyp_code", "spraddr_activity_date",
        F.col("spraddr_street_line1").alias("street_line1"),
        join_lines("spraddr_street_line2", "spraddr_street_line3", "append", 80).alias("street_line2"),
        F.substring("spraddr_city", 1, 60).alias("city"),
        F.col("spraddr_stat_code").alias("stat_code"),
        F.substring("spraddr_zip", 1, 10).alias("zip"),
        F.when(missing("__xw_iso"), F.lit(DEFAULT_ISO)).otherwise(F.col("__xw_iso")).alias("iso"))


def addresses(spraddr: DataFrame, crosswalk: DataFrame, as_of: Column,
              types: Sequence[str] = ADDRESS_TYPES, tie_break: Sequence[Column] | None = None) -> DataFrame:
    """Latest active address per (person, type), nation mapped to ISO ('US' default).

    The crosswalk is joined without de-duplication, as in the reference.
    """
    order = [F.col("spraddr_activity_date").desc_nulls_last(),
             *(tie_break if tie_break is not None else
               [F.col(c).desc_nulls_last() for c in ("street_line1", "street_line2", "city", "zip", "iso")])]
    return latest_per_key(address_rows(spraddr, crosswalk, as_of, types), ["spraddr_pidm", "spraddr_atyp_code"], order).drop("spraddr_activity_date")


def contact_rows(spremrg: DataFrame, relt: DataFrame) -> DataFrame:
    """Emergency contacts with formatted name, lines, phone (25) and relation."""
    r = relt.select(F.col("stvrelt_code").alias("__r_code"), F.col("stvrelt_desc").alias("relt_desc"))
    e = spremrg.join(r, F.col("__r_code") == F.col("spremrg_relt_code"), "left")
    return e.select(
        "spremrg_pidm", "spremrg_activity_date",
        F.substring(F.concat_ws(" ", "spremrg_first_name", "spremrg_last_name"), 1, 80).alias("contact_name"),
        F.substring("spremrg_street_line1", 1, 80).alias("street_line1"),
        join_lines("spremrg_street_line2", "spremrg_street_line3", "guarded", 80).alias("street_line2"),
        F.col("spremrg_city").alias("city"),
        F.col("spremrg_stat_code").alias("stat_code"),
        F.substring("spremrg_zip", 1, 10).alias("zip"),
        format_phone("spremrg_phone_area", "spremrg_phone_number", 25).alias("phone"),
        "relt_desc")


def emergency_contact(spremrg: DataFrame, relt: DataFrame,
                      tie_break: Sequence[Column] | None = None) -> DataFrame:
    """Latest emergency contact per person with formatted name, lines, phone (25) and relation."""
    order = [F.col("spremrg_activity_date").desc_nulls_last(),
             *(tie_break if tie_break is not None else
               [F.col(c).desc_nulls_last() for c in ("contact_name", "street_line1", "street_line2", "phone", "relt_desc")])]
    return latest_per_key(contact_rows(spremrg, relt), ["spremrg_pidm"], order).drop("spremrg_activity_date")
