"""Operator rules: filters, joins, profiles, smoothing, selection."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from citesight import presets
from citesight.operators import aggregates as agg
from citesight.operators import filters, joins, profile, selection
from citesight.plans import pipelines as pl


def test_standardize_columns(spark):
    df = spark.createDataFrame([(1,)], "` facid ` int")
    assert filters.standardize_columns(df).columns == ["FACID"]


def test_drop_header_rows_keeps_null(spark):
    df = spark.createDataFrame([("VARIABLE",), ("VARIABLE  ",), (None,), ("FAC_TYPE_CODE",)], "VARIABLE string")
    got = [r[0] for r in filters.drop_values(df, "VARIABLE", presets.LOOKUP_HEADER_VALUES).collect()]
    assert got == [None, "FAC_TYPE_CODE"]


def test_exclude_outcomes_keeps_null(spark):
    df = spark.createDataFrame([("REVERSED",), ("Dismissed by court",), (None,), ("AA",)], "CLASS_FINAL string")
    got = [r[0] for r in filters.exclude_outcomes(df, "CLASS_FINAL", presets.INVALID_OUTCOMES).collect()]
    assert got == [None, "AA"]
    rep = filters.filter_report(df, filters.keep_outcome("CLASS_FINAL", presets.INVALID_OUTCOMES)).first()
    assert (rep.rows_before, rep.dropped, rep.remaining) == (4, 2, 2)


def test_overlapping_flags(spark):
    df = spark.createDataFrame([("Non-Immediate Jeopardy",), ("AE04 - Retention of a foreign object in a patient",),
                                ("Death associated with a fall",)], "PENALTY_CATEGORY string")
    f = filters.keyword_flags(df, "PENALTY_CATEGORY", presets.HEALTH_FLAGS).collect()
    assert f[0].is_ij == 1 and f[0].is_non_ij == 1
    assert f[1].is_ae == 0 and f[1].is_ae_surgery == 1
    assert f[2].is_ae_fall == 1 and f[2].is_ae_death == 1


def _lookup(spark):
    rows = [("FAC_TYPE_CODE", " GACH\t", "General", "A hospital with a governing body, 24-hour care"),
            ("FAC_TYPE_CODE", "SNF", "Skilled", "A nonprofit 24-Hour nursing facility"),
            ("Class_Assessed_Final", "C_AA", "AA", None),
            ("Class_Assessed_Final", "C_A1", "A", None),
            ("Class_Assessed_Final", "C_A2", "A", None),
            ("VARIABLE", "VALUE", "DESCRIPTION", "DEFINITION")]
    return pl.clean_lookup(spark.createDataFrame(rows, "VARIABLE string, VALUE string, DESCRIPTION string, "
                                                       "DEFINITION string"))


def test_lookup_flags_masked(spark):
    lk = {r.VALUE: r for r in _lookup(spark).collect()}
    assert (lk["GACH"].IS_HOSPITAL, lk["GACH"].IS_24HR) == (1, 1)
    assert (lk["SNF"].IS_HOSPITAL, lk["SNF"].IS_24HR, lk["SNF"].IS_LOW_RESOURCE) == (0, 0, 1)
    assert lk["C_AA"].IS_HOSPITAL is None


def _raw_enf(spark, rows):
    schema = ("EVENTID string, FACID string, FACILITY_NAME string, FAC_TYPE_CODE string, FAC_FDR string, "
              "DISTRICT_OFFICE string, PENALTY_NUMBER string, PENALTY_ISSUE_DATE string, "
              "VIOLATION_FROM_DATE string, PENALTY_TYPE string, PENALTY_CATEGORY string, PENALTY_DETAIL string, "
              "DISPOSITION string, CLASS_ASSESSED_INITIAL string, CLASS_ASSESSED_FINAL string, "
              "DEATH_RELATED string, APPEALED string, TOTAL_AMOUNT_INITIAL decimal(18,2), "
              "TOTAL_AMOUNT_DUE_FINAL decimal(18,2), TOTAL_BALANCE_DUE decimal(18,2), "
              "TOTAL_PENALTY_OFFSET_AMOUNT decimal(18,2), PRIORITY_ALL string")
    return spark.createDataFrame(rows, schema)


def _row(facid, code, cls_i, cls_f, appealed, balance, cat="Other", death="N", pnum="1", date="2020-01-01"):
    b = None if balance is None else Decimal(balance)
    return ("E1", facid, "Fac " + facid, code, "F", "District", pnum, date, date, "Citation", cat, "detail",
            "Closed", cls_i, cls_f, death, appealed, b, b, b, b, "A")


def test_mart_joins_and_quirks(spark):
    rows = [_row("010000001", "gach", "AA", "AA", "No", "10.00"),
            _row("2", "SPHOSP", "A", "A", "Yes", "5.00"),       # no facility-type row -> flags 0
            _row("3", "SNF", "B", "WF", "Yes", None),          # class without lookup row -> NULL
            _row("4", "SNF", "A", "A", "Yes", None)]           # duplicate class key -> fans out
    mart = pl.build_mart(pl.clean_enforcement(_raw_enf(spark, rows)), _lookup(spark))
    got = mart.orderBy("FACID", "DESCRIPTION").collect()
    assert len(got) == 1 + 2 + 1 + 2
    assert got[0].FACID == "010000001" and got[0].IS_HOSPITAL == 1 and got[0].CLASS_FINAL == "AA"
    sphosp = [r for r in got if r.FACID == "2"]
    assert all(r.IS_HOSPITAL == 0 and r.FACILITY_TYPE_DESC is None for r in sphosp)
    assert [r.CLASS_FINAL for r in got if r.FACID == "3"] == [None]


def test_profile_eb_and_all_null_balance(spark):
    rows = [_row("1", "SNF", "AA", "AA", "No", None, pnum="p1"),
            _row("1", "SNF", "AA", "AA", "No", None, pnum="p2"),
            _row("2", "SNF", "B", "B", "No", "7.00", pnum="p3")]
    mart = pl.build_mart(pl.clean_enforcement(_raw_enf(spark, rows)), _lookup(spark))
    fac = pl.facility_table(pl.penalty_features(mart, presets.HEALTH), presets.HEALTH, hospital=False)
    got = {r.FACID: r for r in fac.collect()}
    assert got["1"].total_balance_due == 0 and got["1"].balance_per_penalty == 0.0
    assert got["1"].class_aa_rate == 1.0 and got["2"].class_aa_rate == 0.0
    mean = (1.0 + 0.0) / 2
    # facility with one penalty: (1/6) * rate + (5/6) * mean
    assert abs(got["2"].class_aa_rate_eb - (1 / 6 * 0.0 + 5 / 6 * mean)) < 1e-12
    assert abs(got["1"].class_aa_rate_eb - (2 / 7 * 1.0 + 5 / 7 * mean)) < 1e-12


def test_top_k_ties_by_key(spark):
    df = spark.createDataFrame([("b", "S", -1.0), ("a", "S", -1.0), ("c", "S", 0.0), ("d", "T", -2.0)],
                               "FACID string, stratum string, score double")
    q = spark.createDataFrame([("S", 1, 2), ("T", 1, 1)], "stratum string, hits long, quota int")
    got = selection.top_k_strata(df, "score", q, "FACID").orderBy("stratum", "score", "FACID").collect()
    assert [r.FACID for r in got] == ["a", "b", "d"]


def test_first_per_key_deterministic(spark):
    df = spark.createDataFrame([("1", "p2", "B"), ("1", "p1", "A"), ("2", "p9", "C")], "FACID string, PN string, N string")
    got = {r.FACID: r.N for r in joins.first_per_key(df, "FACID", ["PN"], ["N"]).collect()}
    assert got == {"1": "A", "2": "C"}


def test_value_share_within_labels(spark):
    df = spark.createDataFrame([("T", 1)] * 3 + [("T", 2)], "PENALTY_TYPE string, COMPLAINT_COUNT int")
    got = agg.value_share_within(df, "PENALTY_TYPE", "COMPLAINT_COUNT").collect()
    assert [r.label for r in got] == ["3 (75.0%)", "1 (25.0%)"]


def test_log_histogram_edges(spark):
    df = spark.createDataFrame([(10.0,), (100.0,), (1000.0,), (0.0,), (None,)], "b double")
    got = agg.log_histogram(df, "b", 2).orderBy("bin").collect()
    assert [(r.bin, r["count"]) for r in got] == [(0, 1), (1, 2)]


def test_event_gaps(spark):
    d = dt.datetime
    df = spark.createDataFrame([("1", "e1", d(2020, 1, 1)), ("1", "e1", d(2020, 1, 5)), ("1", "e2", d(2020, 1, 11))],
                               "FACID string, EVENTID string, PENALTY_ISSUE_DATE timestamp_ntz")
    from citesight.operators.windows import event_gaps
    got = event_gaps(df, "FACID", "EVENTID", "PENALTY_ISSUE_DATE").orderBy("EVENTID").collect()
    assert [r.days_to_prev for r in got] == [None, 10]


def test_profile_columns_names():
    cols = profile.profile_columns(presets.HEALTH["hosp_profile"])
    assert cols[0] == "total_ae" and cols[-1] == "total_deaths" and len(cols) == 17


def test_event_gaps_hot_facility_split_across_partitions(spark):
    from citesight.operators.windows import event_gaps
    d0 = dt.datetime(2020, 1, 1)
    rows = [("hot", f"e{i:03d}", d0 + dt.timedelta(days=3 * i)) for i in range(60)]
    rows += [("b", "x1", d0), ("b", "x2", d0 + dt.timedelta(days=2)), ("b", "x2", d0 + dt.timedelta(days=9))]
    rows += [("c", "y1", None)]
    df = spark.createDataFrame(rows, "FACID string, EVENTID string, PENALTY_ISSUE_DATE timestamp_ntz")
    got = {(r.FACID, r.EVENTID): r.days_to_prev
           for r in event_gaps(df, "FACID", "EVENTID", "PENALTY_ISSUE_DATE", partitions=7).collect()}
    assert got[("hot", "e000")] is None
    assert all(got[("hot", f"e{i:03d}")] == 3 for i in range(1, 60))
    assert got[("b", "x1")] is None and got[("b", "x2")] == 2
    assert got[("c", "y1")] is None
    assert len(got) == 63


def test_flag_substring_rules(spark):
    df = spark.createDataFrame([("Rainfall injuries",), ("Deliberate breach of PHI",), (None,)],
                               "PENALTY_CATEGORY string")
    got = filters.keyword_flags(df, "PENALTY_CATEGORY", presets.HEALTH_FLAGS).collect()
    assert got[0].is_ae_fall == 1
    assert got[1].is_breach == 1 and got[1].is_deliberate_breach == 1
    assert all(getattr(got[2], f) == 0 for f in presets.HEALTH_FLAGS)


def test_lookup_value_trimmed_description_kept(spark):
    rows = [("Class_Assessed_Final", " C_AA\t", " AA ", None)]
    lk = pl.clean_lookup(spark.createDataFrame(rows, "VARIABLE string, VALUE string, DESCRIPTION string, "
                                                     "DEFINITION string")).first()
    assert lk.VALUE == "C_AA" and lk.DESCRIPTION == " AA "


def test_mart_alias_swap(spark):
    mart = pl.build_mart(pl.clean_enforcement(_raw_enf(spark, [_row("1", "SNF", "AA", "AA", "No", "1.00")])),
                         _lookup(spark))
    r = mart.first()
    assert r.CLASS_FINAL == "AA" and r.DESCRIPTION == "C_AA"


def test_profile_all_null_dates_and_sums(spark):
    rows = [_row("9", "SNF", "B", "B", "No", None, pnum="q1", date="not a date"),
            _row("9", "SNF", "B", "B", "No", None, pnum="q2", date="31/31/2020")]
    mart = pl.build_mart(pl.clean_enforcement(_raw_enf(spark, rows)), _lookup(spark))
    prof = profile.facility_profile(pl.penalty_features(mart, presets.HEALTH), presets.HEALTH["ltc_profile"]).first()
    assert prof.last_penalty_date is None and prof.total_balance_due == 0 and prof.total_penalties == 2


def test_optional_category_recode(spark):
    rows = [_row("1", "SNF", "A", "A", "No", "1.00", cat=" AE04 - Retention of a foreign object ")]
    raw = _raw_enf(spark, rows)
    plain = pl.clean_enforcement(raw).first()
    assert plain.PENALTY_CATEGORY == " AE04 - Retention of a foreign object "
    rec = pl.clean_enforcement(raw, category_recode={"AE04 - Retention of a foreign object":
                                                     "AE: Retention of a foreign object"}).first()
    assert rec.PENALTY_CATEGORY == "AE: Retention of a foreign object"
    flags = filters.keyword_flags(pl.clean_enforcement(raw, category_recode={
        "AE04 - Retention of a foreign object": "AE: Retention of a foreign object"}),
        "PENALTY_CATEGORY", presets.HEALTH_FLAGS).first()
    assert flags.is_ae == 1 and flags.is_ae_surgery == 1


def test_top_keywords_pad(spark):
    from citesight.operators.keywords import top_keywords
    docs = spark.createDataFrame([("d1",), ("d2",), ("d3",)], "doc string")
    w = spark.createDataFrame([("d1", "alpha", 0.9), ("d1", "beta", 0.9), ("d1", "gamma", 0.1), ("d1", "delta", 0.5),
                               ("d2", "alpha", 1.0), ("d2", "zeta", 0.0)], "doc string, term string, weight double")
    got = {r.doc: r.TOP_KEYWORDS for r in top_keywords(docs, w, "doc").collect()}
    assert got == {"d1": "beta, alpha, delta", "d2": "alpha", "d3": ""}
    padded = {r.doc: r.TOP_KEYWORDS for r in top_keywords(docs, w, "doc", pad=True).collect()}
    assert padded["d1"] == "beta, alpha, delta"
    assert padded["d2"] == "alpha, zeta, gamma"
    assert padded["d3"] == "zeta, gamma, delta"


def test_impute_and_scale_equals_two_steps(spark):
    df = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (3.0, 5.0), (10.0, 5.0)], "a double, b double")
    one = profile.impute_and_scale(df, ["a", "b"]).collect()
    two = profile.standard_scale(profile.impute_median(df, ["a", "b"]), ["a", "b"]).collect()
    assert [(round(r.a, 12), r.b) for r in one] == [(round(r.a, 12), r.b) for r in two]
    assert all(r.b == 0.0 for r in one)


def test_counts_per_year_makes_the_date_once(spark):
    from citesight.functions import parse_date
    rows = spark.createDataFrame([(1, "1/2/2020"), (1, "2020-05-01"), (2, "31/31/2020"), (2, None), (1, "20190101"), (3, "2019/1/1")],
                                 "k int, t string")
    keys = spark.createDataFrame([(1,), (2,)], "j int")
    # the joined rows' date: a filter on it would be pushed below the join and make the date there too
    joined = rows.join(keys, F.col("k") == F.col("j")).select(parse_date("t").alias("d"))
    out = agg.counts_per_year(joined, "d")
    assert [tuple(r) for r in out.collect()] == [(2019, 1), (2020, 2)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert sum("try_cast" in line.lower() or "element_at(transform" in line for line in plan.splitlines()) == 1


def test_attach_first_stores_only_what_is_read(spark, monkeypatch):
    from citesight.plans import catalog
    from citesight.sources import schemas

    def row(**said):
        return tuple(said.get(f.name) for f in schemas.MART.fields)

    day = dt.datetime(2020, 1, 1)
    mart = spark.createDataFrame([
        row(FACID="1", IS_HOSPITAL=1, PENALTY_NUMBER="b", EVENTID="9", PENALTY_ISSUE_DATE=day, FACILITY_NAME="B", DISTRICT_OFFICE="X",
            CLASS_FINAL="A", PENALTY_CATEGORY="hot"),
        row(FACID="1", IS_HOSPITAL=1, PENALTY_NUMBER="a", EVENTID="9", PENALTY_ISSUE_DATE=day, FACILITY_NAME="A", DISTRICT_OFFICE="Y"),
        row(FACID="1", IS_HOSPITAL=1, PENALTY_NUMBER="0", PENALTY_ISSUE_DATE=day, FACILITY_NAME="void", CLASS_FINAL="PARTIAL"),
        row(FACID="2", IS_HOSPITAL=0, PENALTY_NUMBER="c", FACILITY_NAME="C"), row(FACILITY_NAME="D", IS_HOSPITAL=1)], schemas.MART)
    stored, real = [], catalog.materialize
    monkeypatch.setattr(catalog, "_mart", lambda spark, sf: mart)
    monkeypatch.setattr(catalog, "materialize", lambda df: stored.append(df.columns) or real(df))
    assert [tuple(r) for r in catalog.QUERIES["attach_first"](spark, "").collect()] == [("1", 2, "A", "Y")]
    assert stored == [pl.SELECTION_COLUMNS] and set(pl.SELECTION_COLUMNS) < set(schemas.MART.fieldNames())
