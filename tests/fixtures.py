"""Synthetic source tables for feed tests (invented names, ids and codes only).

Schemas follow FIXTURES.md section A; rows cover the cases of section C.
Run date: 2024-09-15. Term 202340 (summer) has started and ended, 202410
(fall) starts on 2024-09-20, so the two "current period" rules disagree:
latest started = 202340, earliest open = 202410.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

D = dt.date
TS = dt.datetime
P = Decimal

SCHEMAS = {
    "saturn_stvterm": "stvterm_code string, stvterm_acyr_code string, stvterm_start_date date, stvterm_end_date date",
    "saturn_spriden": "spriden_pidm decimal(8,0), spriden_id string, spriden_last_name string, "
                      "spriden_first_name string, spriden_change_ind string, spriden_activity_date timestamp_ntz",
    "saturn_spbpers": "spbpers_pidm decimal(8,0), spbpers_name_prefix string, spbpers_pref_first_name string, "
                      "spbpers_sex string, spbpers_birth_date string, spbpers_confid_ind string, "
                      "spbpers_activity_date timestamp_ntz",
    "saturn_sgbstdn": "sgbstdn_pidm decimal(8,0), sgbstdn_term_code_eff string, sgbstdn_levl_code string, "
                      "sgbstdn_styp_code string, sgbstdn_majr_code_1 string, sgbstdn_camp_code string, "
                      "sgbstdn_activity_date timestamp_ntz",
    "taismgr_tbrdepo": "tbrdepo_pidm decimal(8,0), tbrdepo_term_code string, tbrdepo_detail_code_deposit string, "
                       "tbrdepo_entry_date timestamp_ntz, tbrdepo_activity_date timestamp_ntz",
    "saturn_sfrstcr": "sfrstcr_pidm decimal(8,0), sfrstcr_term_code string, sfrstcr_crn string, sfrstcr_rsts_code string",
    "saturn_ssbsect": "ssbsect_term_code string, ssbsect_crn string, ssbsect_subj_code string, "
                      "ssbsect_crse_numb string, ssbsect_seq_numb string",
    "saturn_shrlgpa": "shrlgpa_pidm decimal(8,0), shrlgpa_levl_code string, shrlgpa_gpa_type_ind string, "
                      "shrlgpa_gpa decimal(6,3), shrlgpa_hours_earned decimal(9,3)",
    "saturn_shrtgpa": "shrtgpa_pidm decimal(8,0), shrtgpa_levl_code string, shrtgpa_term_code string, "
                      "shrtgpa_gpa_type_ind string, shrtgpa_hours_earned decimal(9,3)",
    "saturn_sgrclsr": "sgrclsr_seq_no int, sgrclsr_clas_code string, sgrclsr_levl_code string, "
                      "sgrclsr_from_hours decimal(9,3), sgrclsr_to_hours decimal(9,3)",
    "saturn_sgrcatt": "sgrcatt_seq_no int, sgrcatt_atts_code string",
    "saturn_sprhold": "sprhold_pidm decimal(8,0), sprhold_hldd_code string, sprhold_to_date date, "
                      "sprhold_release_ind string, sprhold_activity_date timestamp_ntz",
    "saturn_sprtele": "sprtele_pidm decimal(8,0), sprtele_tele_code string, sprtele_phone_area string, "
                      "sprtele_phone_number string, sprtele_status_ind string, sprtele_primary_ind string, "
                      "sprtele_seqno int, sprtele_activity_date timestamp_ntz",
    "saturn_spraddr": "spraddr_pidm decimal(8,0), spraddr_atyp_code string, spraddr_street_line1 string, "
                      "spraddr_street_line2 string, spraddr_street_line3 string, spraddr_city string, "
                      "spraddr_stat_code string, spraddr_zip string, spraddr_natn_code string, "
                      "spraddr_status_ind string, spraddr_to_date date, spraddr_activity_date timestamp_ntz",
    "saturn_spremrg": "spremrg_pidm decimal(8,0), spremrg_first_name string, spremrg_last_name string, "
                      "spremrg_street_line1 string, spremrg_street_line2 string, spremrg_street_line3 string, "
                      "spremrg_city string, spremrg_stat_code string, spremrg_zip string, spremrg_phone_area string, "
                      "spremrg_phone_number string, spremrg_relt_code string, spremrg_activity_date timestamp_ntz",
    "general_goremal": "goremal_pidm decimal(8,0), goremal_emal_code string, goremal_email_address string, "
                       "goremal_status_ind string, goremal_activity_date timestamp_ntz",
    "general_gobintl": "gobintl_pidm decimal(8,0), gobintl_natn_code_legal string, gobintl_activity_date timestamp_ntz",
    "general_gorvisa": "gorvisa_pidm decimal(8,0), gorvisa_vtyp_code string, gorvisa_activity_date timestamp_ntz",
    "saturn_saradap": "saradap_pidm decimal(8,0), saradap_term_code_entry string, saradap_appl_no int, "
                      "saradap_apst_code string, saradap_styp_code string, saradap_activity_date timestamp_ntz",
    "saturn_sarappd": "sarappd_pidm decimal(8,0), sarappd_term_code_entry string, sarappd_apdc_code string",
    "saturn_saraatt": "saraatt_pidm decimal(8,0), saraatt_term_code string, saraatt_atts_code string, "
                      "saraatt_activity_date timestamp_ntz",
    "saturn_sorainf": "sorainf_pidm decimal(8,0), sorainf_term_code string, sorainf_radm_code string, "
                      "sorainf_arol_pidm decimal(8,0), sorainf_activity_date timestamp_ntz",
    "saturn_sgrsprt": "sgrsprt_pidm decimal(8,0), sgrsprt_term_code string, sgrsprt_actc_code string, "
                      "sgrsprt_spst_code string, sgrsprt_elig_code string, sgrsprt_activity_date timestamp_ntz",
    "saturn_stvlevl": "stvlevl_code string, stvlevl_desc string",
    "saturn_stvstyp": "stvstyp_code string, stvstyp_desc string",
    "saturn_stvmajr": "stvmajr_code string, stvmajr_desc string",
    "saturn_stvclas": "stvclas_code string, stvclas_desc string",
    "saturn_stvvtyp": "stvvtyp_code string, stvvtyp_desc string",
    "saturn_stvactc": "stvactc_code string, stvactc_desc string",
    "saturn_stvrelt": "stvrelt_code string, stvrelt_desc string",
    "saturn_stvcamp": "stvcamp_code string, stvcamp_desc string",
    "odsmgr_academic_study": "person_uid decimal(8,0), id string, academic_period string, student_level_desc string, "
                             "student_classification_desc string, major_desc string, primary_program_ind string, "
                             "registered_ind string",
    "odsmgr_student_course": "person_uid decimal(8,0), academic_period string, subject string, course_number string, "
                             "transfer_course_ind string, section_add_date date",
    "odsmgr_person_detail": "person_uid decimal(8,0), preferred_first_name string, first_name string, "
                            "middle_initial string, last_name string",
    "scadsf_wxwalknation": "scadem_banner_code string, sf_iso string",
    "scadsf_sf_contact": "id string, pidm decimal(8,0)",
    "scadsf_sf_opportunity": "contact__c string, entering_term__c string, location__c string, "
                             "student_type__c string, isdeleted string",
    "grailssf_ferpa": "student_pidm decimal(8,0)",
}

AS_OF = D(2024, 9, 15)
NOW = TS(2024, 9, 15, 14, 0, 0)  # 10:00 in New York: an even hour

A = TS(2024, 1, 10, 9, 0, 0)  # an old activity time, before any control row


DATA: dict[str, list[tuple]] = {
    "saturn_stvterm": [
        ("202330", "2324", D(2024, 3, 20), D(2024, 6, 1)),
        ("202340", "2324", D(2024, 6, 15), D(2024, 8, 20)),
        ("202410", "2425", D(2024, 9, 20), D(2024, 11, 30)),
        ("202415", "2425", D(2024, 9, 1), D(2024, 10, 15)),
        ("202420", "2425", D(2025, 1, 6), D(2025, 3, 15)),
        ("202430", "2425", D(2025, 3, 25), D(2025, 6, 1)),
        ("202510", "2526", D(2025, 9, 20), D(2025, 11, 30)),
    ],
    "saturn_ssbsect": [
        ("202340", "10001", "ART", "101", "01"),
        ("202340", "10002", "ART", "101", "02"),
        ("202340", "10003", None, "205", "01"),
        ("202410", "20001", "BIO", "110", "01"),
    ],
    "saturn_sfrstcr": [
        (P(1001), "202340", "10001", "RE"), (P(1002), "202340", "10001", "RE"),
        (P(1002), "202340", "10003", "RE"), (P(1003), "202410", "20001", "RE"),
        (P(2004), "202410", "20001", "RE"), (P(2004), "202420", "20009", "RW"),
        (P(2004), "202430", "20010", "DD"), (P(2005), "202410", "20001", "RE"),
    ],
    "saturn_spriden": [
        (P(1001), "A00001001", "Ames", "Ann", None, A),
        (P(1002), "A00001002", "Bell", "Bo", None, A),
        (P(1002), "OLD1002", "Bellx", "Bo", "N", A),
        (P(2001), "S2001", "Cole", "Cy", None, A),
        (P(2002), "S2002", "Dunn", "0", None, A),
        (P(2003), "S2003", "Egan", None, None, A),
        (P(2004), "S2004", "Finn", "Fay", None, A),
        (P(2005), "S2005", "Gray", "Gus", None, A),
        (P(2006), "S2006", "Hale", "Hal", None, A),
        (P(3001), "ADV3001", "Counsel", "Ivy", None, A),
    ],
    "saturn_spbpers": [
        (P(2001), "Mx", None, "F", "05-Jan-2006", "Y", A),
        (P(2002), None, "0", "M", "17-Mar-2005", None, A),
        (P(2003), None, "Eve", "F", "bad-date", "N", A),
        (P(2004), "Dr", "Fifi", None, "29-Feb-2004", None, A),
        (P(2005), None, None, "M", None, None, A),
        (P(2006), None, None, "M", None, None, A),
    ],
    "saturn_sgbstdn": [
        (P(2001), "202310", "UG", "F", "ANIM", "M", A),
        (P(2001), "202410", "UG", "C", "ANIM", "O", A),
        (P(2002), "202330", "UG", "C", "FILM", "M", A),
        (P(2003), "202340", "UG", "F", "FILM", "L", A),
        (P(2003), "202420", "UG", "C", "FILM", "M", A),
        (P(2004), "202410", "UG", "F", "ANIM", "R", A),
        (P(2005), "202410", "GR", "P", "ANIM", "M", A),
        (P(2006), "202410", "UG", "C", "ANIM", "M", A),
    ],
    "taismgr_tbrdepo": [
        (P(2001), "202410", "DHOU", TS(2024, 5, 1, 10, 30), A),
        (P(2001), "202410", "DRES", TS(2024, 5, 2, 14, 5), A),
        (P(2001), "202330", "DHOU", TS(2023, 2, 1, 9, 0), A),
        (P(2002), "202410", "DHOU", TS(2024, 4, 1, 8, 0), A),
        (P(2003), "202410", "DLAC", TS(2024, 6, 1, 8, 0), A),
        (P(2005), "202420", "DRES", TS(2024, 7, 1, 16, 45), A),
        (P(2006), "202310", "DHOU", TS(2023, 1, 1, 8, 0), A),
    ],
    "saturn_shrlgpa": [
        (P(2001), "UG", "O", P("3.12345"), P("50.0")),
        (P(2001), "UG", "O", P("2.5"), None),
        (P(2001), "UG", "I", P("4.0"), P("99.0")),
        (P(2005), "GR", "O", P("3.9"), P("12.5")),
    ],
    "saturn_shrtgpa": [
        (P(2001), "UG", "202310", "I", P("15")), (P(2001), "UG", "202320", "T", P("15")),
        (P(2001), "UG", "202330", "I", P("20")), (P(2001), "UG", "202330", "T", None),
        (P(2001), "UG", "202420", "I", P("30")),
        (P(2002), "UG", "202310", "I", P("95")),
        (P(2004), "UG", "202410", "I", P("44.99")),
    ],
    "saturn_sgrclsr": [
        (1, "FR", "UG", P("0"), P("44.99")), (2, "SO", "UG", P("45"), P("89.99")),
        (3, "SOH", "UG", P("45"), P("89.99")), (4, "JR", "UG", P("90"), P("134.99")),
        (5, "GR", "GR", P("0"), P("999")),
    ],
    "saturn_sgrcatt": [(3, "HONR")],
    "saturn_sprhold": [
        (P(2001), "RH", D(2024, 12, 31), None, A), (P(2001), "LF", D(2024, 9, 15), None, A),
        (P(2002), "DI", D(2025, 1, 1), "N", A), (P(2005), "FN", D(2025, 1, 1), None, A),
    ],
    "saturn_sprtele": [
        (P(2001), "MA", "912", "5551234", None, "Y", 1, A),
        (P(2001), "MA", "404", "5559999", None, None, 7, A),
        (P(2001), "MOB", "0", "12345", None, None, 2, A),
        (P(2001), "PR", None, "5550000", "I", "Y", 3, A),
        (P(2004), "PR", "4045", "0", None, None, 1, A),
    ],
    "saturn_spraddr": [
        (P(2001), "MA", "1 Main St", None, "Unit 5", "Springfield", "GA", "31401-12345", "IT", None, None, A),
        (P(2001), "MA", "2 Old St", "Apt 1", None, "Springfield", "GA", "31401", None, None, D(2024, 1, 1),
         TS(2024, 3, 1)),
        (P(2001), "PR", "9 Home Rd", "Floor 2", "0", "C" * 70, "NY", "10001", "0", None, None, A),
        (P(2004), "PR", "4 Elm", None, None, "Atlanta", "GA", "30301", "XX", "I", None, A),
    ],
    "saturn_spremrg": [
        (P(2001), "Pat", None, "1 Main St", None, "Unit 5", "Springfield", "GA", "31401", "912", "5551234", "P", A),
        (P(2001), "Old", "Contact", None, None, None, None, None, None, None, None, "P", TS(2023, 1, 1)),
    ],
    "general_goremal": [
        (P(1001), "STEM", "Ann@Stem.EDU", "A", A), (P(1001), "SCAD", "ann@Mail.Example.org", "A", A),
        (P(1002), "SCAD", "x@mail.example.org", "I", A), (P(1002), "STEM", "Bo@STEM.Example.org", "A", A),
        (P(2001), "STEM", "cy@stem.example", "A", A),
        (P(2002), "STEM", "dunn@stem.example", "A", TS(2024, 9, 10)),
    ],
    "general_gobintl": [(P(2001), "IT", A), (P(2001), "FR", TS(2023, 1, 1)), (P(2003), "ZZ", A)],
    "general_gorvisa": [(P(2001), "F1", A), (P(2004), "J9", A)],
    "saturn_saradap": [
        (P(2001), "202410", 1, "D", "N", A), (P(2001), "202420", 2, "D", "N", A),
        (P(2003), "202340", 1, "W", "R", A), (P(2003), "202410", 2, "D", "R", A),
        (P(2004), "202430", 5, "D", "R", A), (P(2004), "202410", 3, "D", "R", A),
    ],
    "saturn_sarappd": [
        (P(2001), "202410", "CP"), (P(2003), "202340", "CP"), (P(2004), "202410", "RS"),
    ],
    "saturn_saraatt": [(P(2001), "202410", "HOUS", A), (P(2004), "202410", "MISC", A)],
    "saturn_sorainf": [
        (P(2001), "202410", "ADMCOUN", P(3001), A), (P(2001), "202410", "OTHER", P(2006), TS(2024, 9, 1)),
    ],
    "saturn_sgrsprt": [(P(2001), "202410", "SWM", "AC", "AC", A), (P(2004), "202410", "SWM", "AC", "XX", A)],
    "saturn_stvlevl": [("UG", "Undergraduate"), ("GR", "Graduate")],
    "saturn_stvstyp": [("F", "First Time Freshman"), ("C", "Continuing"), ("P", "New Graduate")],
    "saturn_stvmajr": [("ANIM", "Animation"), ("FILM", "Film")],
    "saturn_stvclas": [("FR", "Freshman"), ("SO", "Sophomore"), ("JR", "Junior"), ("GR", "Graduate")],
    "saturn_stvvtyp": [("F1", "Student Visa")],
    "saturn_stvactc": [("SWM", "Swimming")],
    "saturn_stvrelt": [("P", "Parent")],
    "saturn_stvcamp": [("RSA", "Rising Star Atlanta"), ("RSM", "Rising Star Main"), ("M", "Main")],
    "odsmgr_academic_study": [
        (P(1001), "A1001", "202340", "Graduate", "Senior", "Animation", "Y", "Y"),
        (P(1002), "A1002", "202340", "Undergraduate", "Freshmen", 'Film"', "Y", "Y"),
        (P(1003), None, "202340", None, None, "Sound", "Y", "Y"),
        (P(1004), "A1004", "202340", "Undergraduate", "First Year", "Art", "Y", "N"),
        (P(1005), "A1005", "202410", "Undergraduate", "Senior", "Art", "Y", "Y"),
        (P(1006), "A1006", "202340", "Undergraduate", "Senior", "Art", "Y", "Y"),
    ],
    "odsmgr_student_course": [
        (P(1001), "202340", "ART", "101", "N", D(2024, 6, 1)), (P(1001), "202340", "ART", "101", "N", D(2024, 6, 2)),
        (P(1001), "202340", "BIO", "210", "N", D(2024, 6, 1)), (P(1001), "202340", None, "300", "N", D(2024, 6, 1)),
        (P(1001), "202340", "CHM", "100", "Y", D(2024, 6, 1)), (P(1001), "202340", "PHY", "100", None, D(2024, 6, 1)),
        (P(1001), "202340", "MTH", "100", "N", None),
        (P(1002), "202340", "ART", "101", "N", D(2024, 6, 1)),
        (P(1003), "202340", "BIO", "210", "N", D(2024, 6, 1)),
        (P(1004), "202340", "BIO", "210", "N", D(2024, 6, 1)),
        (P(1005), "202410", "BIO", "210", "N", D(2024, 6, 1)),
        (P(1006), "202340", "BIO", "210", "Y", D(2024, 6, 1)),
    ],
    "odsmgr_person_detail": [
        (P(1001), None, 'Ann"a', "B", "Smith"), (P(1002), "Bo", "Robert", None, "Lee"),
        (P(1003), None, "Cy", None, "Ng"), (P(1004), None, "Di", None, "Ox"),
        (P(1005), None, "Ed", None, "Po"), (P(1006), None, "Flo", None, "Qi"),
    ],
    "scadsf_wxwalknation": [("IT", "IT"), ("FR", "FR"), ("XX", "0")],
    "scadsf_sf_contact": [("c1", P(2004))],
    "scadsf_sf_opportunity": [
        ("c1", "202410 Fall", "Rising Star Atlanta", "Rising Star", "N"),
        ("c1", "202410 Fall", "Rising Star Main", "Rising Star", None),
    ],
    "grailssf_ferpa": [(P(2001),), (P(2001),)],
}


def make_sources(spark: SparkSession, overrides: dict[str, list[tuple]] | None = None) -> dict[str, DataFrame]:
    data = dict(DATA)
    data.update(overrides or {})
    return {name: spark.createDataFrame(data.get(name, []), schema) for name, schema in SCHEMAS.items()}
