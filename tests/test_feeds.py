"""Whole-feed tests on the synthetic fixtures (expected lines derived by hand)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from feedkit.context import RunContext
from feedkit.context import checkpoint_dir
from feedkit.operators.control import CONTROL_SCHEMA, ControlTable
from feedkit.plans import course_feeds as cf
from feedkit.plans import housing as hz
from feedkit.plans import person_feed as pf
from feedkit.streaming import run_cycle

CTX = RunContext.at(fx.AS_OF, fx.NOW)


@pytest.fixture(scope="module")
def src(spark):
    return fx.make_sources(spark)


def lines(df, order=999):
    return sorted(r["REPORT_TEXT"] for r in df.filter(F.col("REPORT_ORDER") == order).collect()
                  if r["REPORT_TEXT"] is not None)


def header(df):
    return [r["REPORT_TEXT"] for r in df.filter(F.col("IS_HEADER") == 1).orderBy("REPORT_ORDER").collect()]


def test_current_period_rules_disagree(src):
    assert cf.started_term(src, CTX) == "202340"
    assert cf.next_term(src, CTX) == "202410"
    assert hz._params(src, CTX) == ("202410", "2425")


def test_group_feed(src):
    out = cf.group_feed(src, CTX)
    assert header(out) == cf.GROUP_HEADER
    assert lines(out) == ['"-205","-205","WebCheckout"', '"ART-101","ART-101","WebCheckout"']


def test_section_feed(src):
    out = cf.section_feed(src, CTX)
    assert header(out) == cf.SECTION_HEADER
    assert lines(out) == ['"10001.202340","ART-101-01","ART-101"', '"10002.202340","ART-101-02","ART-101"',
                          '"10003.202340","-205-01","-205"']


def test_section_member_feed_with_injected_member(src):
    out = cf.section_member_feed(src, CTX, cf.InjectedMember(1002, "TESTMEMBER"))
    end = '"06/15/2024","09/19/2024"'
    assert header(out) == cf.MEMBER_HEADER
    assert lines(out) == [f'"10001.202340","A00001001",{end}', f'"10001.202340","A00001002",{end}',
                          f'"10001.202340","TESTMEMBER",{end}', f'"10003.202340","A00001002",{end}',
                          f'"10003.202340","TESTMEMBER",{end}']


def test_section_member_feed_without_next_term_is_header_only(spark):
    terms = [t for t in fx.DATA["saturn_stvterm"] if t[0] <= "202340"]
    src = fx.make_sources(spark, {"saturn_stvterm": terms})
    out = cf.section_member_feed(src, CTX)
    assert out.filter(F.col("IS_HEADER") == 0).count() == 0
    assert out.count() == 9


EXTRA = [(9999999, "T0000001", "GRAD2", "Test", "A", "Person", "ACTIVE", "test@example.org", "Testing", "")]


def test_person_feed(src):
    out = pf.person_feed(src, CTX, EXTRA)
    assert header(out) == pf.PERSON_HEADER
    assert lines(out) == [
        '"A1001","GRAD2","Anna","B","Smith","ACTIVE","ann@mail.example.org","Animation","300;ART101;ART101;BIO210"',
        '"A1002","UNDERGRADUATE-FRESHMAN","Bo",,"Lee","ACTIVE","bo@stem.example.org","Film,"ART101"',
        '"T0000001","GRAD2","Test","A","Person","ACTIVE","test@example.org","Testing",',
    ]
    # A NULL id makes the whole line NULL (T20); registered-only, current-term-only persons.
    data = out.filter(F.col("IS_HEADER") == 0)
    assert data.filter(F.col("REPORT_TEXT").isNull()).select("PATRON").collect()[0][0] == "-"
    assert sorted(int(r[0]) for r in data.select("PIDM").collect()) == [1001, 1002, 1003, 9999999]


def _control(spark, rows):
    return spark.createDataFrame(rows, CONTROL_SCHEMA)


SENT_2002 = [(fx.P(2002), "202330", "2425", "202410", dt.datetime(2024, 9, 1), "A", dt.datetime(2024, 9, 1))]


@pytest.fixture(scope="module")
def housing(spark, src):
    rows = hz.housing_feed(src, _control(spark, SENT_2002), CTX).collect()
    data = {}
    for r in rows:
        if r["IS_HEADER"] == 0:
            data.setdefault(int(r["tmpPidm"]), []).append(r)
    return rows, data


def fields(row):
    return dict(zip(hz.FIELDS, row["REPORT_TEXT"].split("|")))


def test_housing_cohorts(housing):
    rows, data = housing
    assert {k: sorted(r["grp_num"] for r in v) for k, v in data.items()} == {
        2001: [1], 2002: [2], 2003: [3], 2004: [4], 2005: [1]}
    hdr = [r for r in rows if r["IS_HEADER"] == 1]
    assert len(hdr) == 1 and hdr[0]["REPORT_TEXT"] == "|".join(hz.FIELDS) and hdr[0]["REPORT_ORDER"] == 1
    assert {(k, v[0]["tmpPulledTerm"], v[0]["tmpTermACYR"]) for k, v in data.items()} == {
        (2001, "202410", "2425"), (2002, "202410", "2425"), (2003, "202410", "2425"),
        (2004, "202410", "2425"), (2005, "202420", "2425")}


def test_housing_fields_new_depositor(housing):
    f = fields(housing[1][2001][0])
    assert len(f) == 72
    assert f["Entry.NameFirst"] == "Cy" and f["Entry.DOB"] == "01/05/2006" and f["Entry.DirectoryFlagPrivacy"] == "1"
    assert f["EntryAddress[Mailing].Street2"] == " Unit 5"           # T6 append variant
    assert f["EntryAddress[Mailing].ZipPostcode"] == "31401-1234"
    assert f["EntryAddress[Mailing].Phone"] == "912-555-1234"         # primary phone wins
    assert f["EntryAddress[Mailing].PhoneMobileCell"] == "12345"      # area '0' dropped
    assert f["EntryAddress[Home].Phone"] == ""                        # inactive phone
    assert f["EntryAddress[Home].City"] == "C" * 60
    assert f["EntryAddress[Home].CountryID.Abbreviation"] == "US"     # '0' nation -> default
    assert f["EntryAddress[Emergency].Street2"] == ""                 # T6 guarded variant
    assert f["EntryAddress[Emergency].ContactName"] == "Pat"
    assert f["EntryDetail.EnrollmentClass"] == "Sophomore"            # 50 hours; band without attributes wins
    assert f["EntryDetail.CumulativeHours"] == "50.0" and f["EntryDetail.CumulativeGPA"] == "3.123"
    assert (f["EntryDetail.AcademicHold"], f["EntryDetail.AccountHold"]) == ("1", "0")  # hold ending today
    assert f["EntryDetail.AthleteTeam"] == "Swimming" and f["EntryDetail.Athlete"] == "1"
    assert f["EntryCustomField.AdmissionAdvisor"] == "Ivy Counsel"
    assert f["EntryCustomField.HousingExemptionIndicator"] == "Y" and f["EntryCustomField.FERPA"] == "1"
    assert f["EntryDetail.Citizenship_CountryID.Abbreviation"] == "IT"
    assert f["EntryCustomField.FallHousingPaymentDate"] == "05/01/2024 10:30:00 AM"  # string order (T4)
    assert (f["EntryCustomField.SpringTerm"], f["EntryCustomField.SpringLocation"]) == ("202330", "M")


def test_housing_fields_other_cohorts(housing):
    f2 = fields(housing[1][2002][0])
    assert (f2["Entry.NameFirst"], f2["Entry.NamePreferred"]) == ("NoName", "0")      # T5
    assert f2["EntryDetail.EnrollmentClass"] == "Junior"
    assert f2["EntryDetail.Citizenship_CountryID.Abbreviation"] == "US"
    assert f2["EntryDetail.VisaDetails"] == "US"
    f3 = fields(housing[1][2003][0])
    assert f3["Entry.DOB"] == "" and f3["EntryDetail.EnrollmentTerm"] == "202410"     # T23 bad date
    assert (f3["EntryCustomField.SummerTerm"], f3["EntryCustomField.SummerLocation"]) == ("202340", "L")
    f4 = fields(housing[1][2004][0])
    assert f4["EntryDetail.EnrollmentClass"] == "Freshman"                            # 44.99 on the band edge
    assert f4["EntryCustomField.FallLocation"] == "A"                                 # override, NULL isdeleted dropped
    assert f4["EntryAddress[Home].Phone"] == "4045" and f4["EntryDetail.EnrollmentTerm"] == "202430"
    f5 = fields(housing[1][2005][0])
    assert f5["EntryDetail.EnrollmentStatus"] == "Graduate First Term"
    assert f5["EntryCustomField.WinterHousingPaymentDate"] == "07/01/2024 04:45:00 PM"


def test_send_cycle_loop(spark, src, tmp_path):
    ctl = ControlTable(spark, str(tmp_path / "control"))
    feed1, v1 = run_cycle(spark, src, ctl, CTX, feed_path=str(tmp_path / "feed1"))
    sent = {int(r[0]) for r in feed1.filter("IS_HEADER = 0").select("tmpPidm").collect()}
    assert sent == {2001, 2002, 2003, 2004, 2005}
    state = {int(r["wsrsrez_pidm"]): r for r in ctl.read().collect()}
    assert set(state) == sent and state[2005]["wsrsrez_last_term"] == "202420"
    assert state[2001]["wsrsrez_last_sent"] == fx.NOW and state[2001]["wsrsrez_init_term"] == "202410"
    # Second run, two hours later: nothing new.
    ctx2 = RunContext.at(fx.AS_OF, dt.datetime(2024, 9, 15, 16, 0, 0))
    feed2, _ = run_cycle(spark, src, ctl, ctx2, feed_path=str(tmp_path / "feed2"))
    assert feed2.filter("IS_HEADER = 0").count() == 0
    # A change after the last send re-emits that person as "changed".
    upd = dict(fx.DATA)
    upd["general_goremal"] = fx.DATA["general_goremal"] + [
        (fx.P(2004), "STEM", "finn@stem.example", "A", dt.datetime(2024, 9, 15, 17, 0))]
    src3 = fx.make_sources(spark, upd)
    ctx3 = RunContext.at(fx.AS_OF, dt.datetime(2024, 9, 15, 18, 0, 0))
    feed3, _ = run_cycle(spark, src3, ctl, ctx3, feed_path=str(tmp_path / "feed3"))
    assert [(int(r[0]), r[1]) for r in feed3.filter("IS_HEADER = 0").select("tmpPidm", "grp_num").collect()] == [
        (2004, 2)]


def test_cycles_leave_no_staged_tables(spark, src, tmp_path):
    import os
    root = checkpoint_dir(spark).removeprefix("file:") + "/staged"
    held = lambda: set(os.listdir(root)) if os.path.isdir(root) else set()
    ctl = ControlTable(spark, str(tmp_path / "control"))
    before = held()
    for n, hour in enumerate((14, 15, 16)):  # the second is an odd hour
        ctx = RunContext.at(fx.AS_OF, dt.datetime(2024, 9, 15, hour, 0, 0))
        run_cycle(spark, src, ctl, ctx, feed_path=str(tmp_path / "feed"))
    assert held() == before and ctl.current_version() == 2


def test_overlapping_cycles(spark, src, tmp_path):
    """A cycle that starts while another one runs fails before it publishes anything."""
    ctl = ControlTable(spark, str(tmp_path / "control"))
    ctl.ensure()
    ctl.claim(after=0)  # another run is computing its feed
    with pytest.raises(RuntimeError):
        run_cycle(spark, src, ctl, CTX, feed_path=str(tmp_path / "feed"))
    assert not (tmp_path / "feed").exists() and ctl.current_version() == 0


def test_control_upsert_odd_hour_changes_nothing(spark, src, tmp_path):
    ctl = ControlTable(spark, str(tmp_path / "control"))
    odd = RunContext.at(fx.AS_OF, dt.datetime(2024, 9, 15, 15, 0, 0))  # 11:00 New York
    feed, _ = run_cycle(spark, src, ctl, odd, feed_path=str(tmp_path / "feed"))
    assert feed.filter("IS_HEADER = 0").count() == 5
    assert ctl.read().count() == 0 and ctl.current_version() == 0  # nothing is committed


def test_send_cycle_without_publish_path_stages(spark, src, tmp_path):
    """Without a publish path the feed is written once before the upsert reads it."""
    ctl = ControlTable(spark, str(tmp_path / "control"))
    feed, tag = run_cycle(spark, src, ctl, CTX)
    assert "FileScan parquet" in feed._jdf.queryExecution().executedPlan().toString()
    assert ctl.current_version() == tag
    assert {int(r[0]) for r in ctl.read().select("wsrsrez_pidm").collect()} == {2001, 2002, 2003, 2004, 2005}


def test_send_cycle_in_another_zone_with_timestamp_sources(spark, tmp_path):
    """Control times are instants: a change after the last send counts in every session zone."""
    upd = dict(fx.DATA)
    upd["general_goremal"] = fx.DATA["general_goremal"] + [(fx.P(2004), "STEM", "finn@stem.example", "A", dt.datetime(2024, 9, 15, 15, 0))]

    def instants(data):
        src = fx.make_sources(spark, data)  # UTC wall clock, made TIMESTAMP while the session is in UTC
        return {n: df.select(*[F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes])
                for n, df in src.items()}

    for name, data in (("first", fx.DATA), ("second", upd)):
        for table, df in instants(data).items():
            df.write.parquet(str(tmp_path / name / f"{table}.parquet"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        read = lambda name: {t: spark.read.parquet(str(tmp_path / name / f"{t}.parquet")) for t in fx.SCHEMAS}
        ctl = ControlTable(spark, str(tmp_path / "control"))
        run_cycle(spark, read("first"), ctl, CTX)                                   # sent at 14:00 UTC
        later = RunContext.at(fx.AS_OF, dt.datetime(2024, 9, 15, 16, 0))
        feed, _ = run_cycle(spark, read("second"), ctl, later)                      # changed at 15:00 UTC
        assert [int(r[0]) for r in feed.filter("IS_HEADER = 0").select("tmpPidm").collect()] == [2004]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_repeated_and_missing_term_starts_fan_out(spark):
    terms = fx.DATA["saturn_stvterm"]
    again = [t for t in terms if t[0] == "202340"]
    src = fx.make_sources(spark, {"saturn_stvterm": terms + [(*r[:2], None, *r[3:]) for r in again] + again})
    plain = cf.section_members(fx.make_sources(spark), "202340", "202410").collect()
    both = cf.section_members(src, "202340", "202410").collect()
    assert len(both) == 2 * len(plain) and {r["start_date_col"] for r in both} == {plain[0]["start_date_col"], None}
