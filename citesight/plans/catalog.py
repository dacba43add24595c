"""Registered queries: one per operator of the inventory.

Each query takes ``(spark, sf_dir)``, reads the driver's tables through the
stand-in adapters and returns a DataFrame with explicitly named columns.
Floating-point outputs are rounded to 6 places and money is returned as
double so that results compare exactly with the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import presets
from ..operators import aggregates as agg
from ..operators import filters, joins, profile, selection, windows
from ..operators.profile import profile_columns, rate_name
from ..session import materialize
from ..sources import standin
from . import pipelines as pl

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
P = presets.STANDIN


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def money(c) -> F.Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 2)


def _mart(spark, sf):
    return pl.standin_mart(spark, sf)


def _flagged(spark, sf):
    return pl.penalty_features(_mart(spark, sf), P)


def _fac(spark, sf, hospital: bool, checkpoint: bool = False):
    return pl.facility_table(_flagged(spark, sf), P, hospital, checkpoint=checkpoint)


# --------------------------------------------------------------------- mart


def ts_text(c) -> F.Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss")


def dbl(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def big(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


MONEY_COLS = ["TOTAL_AMOUNT_INITIAL", "TOTAL_AMOUNT_DUE_FINAL", "TOTAL_BALANCE_DUE",
              "TOTAL_PENALTY_OFFSET_AMOUNT"]


@query("enriched_mart")
def q_enriched_mart(spark, sf):
    m = _mart(spark, sf)
    out = {c: money(c) for c in MONEY_COLS}
    out.update({c: dbl(c) for c in ["DEATH_RELATED", "APPEALED", "HIGHEST_PRIORITY"]})
    out.update({c: big(c) for c in ["IS_HOSPITAL", "IS_24HR", "IS_LOW_RESOURCE", "COMPLAINT_COUNT"]})
    out["PENALTY_ISSUE_DATE"] = ts_text("PENALTY_ISSUE_DATE")
    return m.withColumns(out)


# ----------------------------------------------------------------- profiles


def _profile_out(df: DataFrame) -> DataFrame:
    return df.withColumns({"total_balance_due": money("total_balance_due"),
                           "last_penalty_date": ts_text("last_penalty_date")})


@query("profile_hosp")
def q_profile_hosp(spark, sf):
    f = _flagged(spark, sf).where(F.col("IS_HOSPITAL") == 1)
    return _profile_out(profile.facility_profile(f, P["hosp_profile"]))


@query("profile_ltc")
def q_profile_ltc(spark, sf):
    f = _flagged(spark, sf).where(F.col("IS_HOSPITAL") == 0)
    return _profile_out(profile.facility_profile(f, P["ltc_profile"]))


@query("stored_profile")
def q_stored_profile(spark, sf):
    """The hospital profiles from a mart that is stored by name and clustered by facility."""
    from ..session import scratch_path
    from ..sources import schemas
    from ..sources.warehouse import Warehouse
    wh = Warehouse(spark, scratch_path(spark))
    mart = wh.replace("enriched_mart", _mart(spark, sf), key="FACID", schema=schemas.MART)
    f = pl.penalty_features(mart, P).where(F.col("IS_HOSPITAL") == 1)
    return _profile_out(profile.facility_profile(f, P["hosp_profile"]))


def _rate_cols(preset_key):
    counts = profile_columns(P[preset_key])
    return [rate_name(c) for c in counts] + ["appeal_rate", "complaint_rate_log", "balance_per_penalty"]


@query("rates")
def q_rates(spark, sf):
    f = _flagged(spark, sf).where(F.col("IS_HOSPITAL") == 1)
    prof = profile.facility_profile(f, P["hosp_profile"])
    rated = profile.add_rates(prof, profile_columns(P["hosp_profile"]))
    return rated.select("FACID", "total_penalties", *[r6(c).alias(c) for c in _rate_cols("hosp_profile")])


@query("eb_smooth")
def q_eb_smooth(spark, sf):
    t = _fac(spark, sf, hospital=False, checkpoint=True)
    rates = [rate_name(c) for c in profile_columns(P["ltc_profile"])]
    return t.select("FACID", "total_penalties", *[r6(f"{r}_eb").alias(f"{r}_eb") for r in rates])


# ----------------------------------------------------------- selection (SQL-checkable)

# Stand-in score for the SQL-checked selection: the smoothed death rate
# (negated, so that the smallest score is the most severe, like the anomaly
# score) and a hit flag from a fixed threshold.
SCORE_RATE = "deaths_rate_eb"
HIT_THRESHOLD = 0.4


def _scored_by_rate(spark, sf):
    h, lt = pl.strata_tables(_flagged(spark, sf), P)
    return h.withColumn("score", r6(-F.col(SCORE_RATE))), lt.withColumn("score", r6(-F.col(SCORE_RATE)))


def _quotas(h, lt):
    hit = F.col(SCORE_RATE) >= HIT_THRESHOLD
    return selection.allocate_quota(h, lt, hit, [presets.STRATUM_HOSPITAL, presets.STRATUM_LTC],
                                    presets.INSPECTION_SLOTS)


@query("quotas")
def q_quotas(spark, sf):
    h, lt = _scored_by_rate(spark, sf)
    return _quotas(h, lt).select("stratum", F.col("hits").cast("bigint").alias("hits"),
                                 F.col("quota").cast("bigint").alias("quota"))


@query("top_k_strata")
def q_top_k_strata(spark, sf):
    h, lt = _scored_by_rate(spark, sf)
    both = selection.union_strata(
        h.select("FACID", "score", "total_penalties").withColumn("stratum", F.lit(presets.STRATUM_HOSPITAL)),
        lt.select("FACID", "score", "total_penalties").withColumn("stratum", F.lit(presets.STRATUM_LTC)))
    top = selection.top_k_strata(both, "score", _quotas(h, lt), "FACID", max_k=presets.INSPECTION_SLOTS)
    return windows.with_rank(top, [F.col("score"), F.col("FACID")])


# ------------------------------------------------------ scans / projections


@query("std_columns")
def q_std_columns(spark, sf):
    c = standin.tpch(spark, sf, "customer")
    messy = c.toDF(*[f" {x.lower()}\t" for x in c.columns])
    out = filters.standardize_columns(messy)
    return out.withColumns({"C_NATIONKEY": big("C_NATIONKEY")})


def _lookup_clean(spark, sf):
    return pl.clean_lookup(standin.raw_lookup(spark, sf))


@query("drop_values")
def q_drop_values(spark, sf):
    raw = standin.raw_lookup(spark, sf)
    return filters.drop_values(raw, "VARIABLE", presets.LOOKUP_HEADER_VALUES)


@query("typed_scan")
def q_typed_scan(spark, sf):
    """Rejects of a text copy of the penalties in which some amounts are no numbers."""
    from ..functions import parse_date
    from ..sources import schemas
    from ..sources.typed import RESCUED, merge, reject_report, rescued, typed_scan
    raw = standin.raw_enforcement(spark, sf)
    number, due = F.col("TOTAL_AMOUNT_INITIAL"), F.col("TOTAL_BALANCE_DUE").cast("string")
    said = {c: F.col(c).cast("string") for c in raw.columns} | {
        "TOTAL_AMOUNT_INITIAL": F.when(number % 10 < 1, F.concat(F.lit("$"), number.cast("string"))).otherwise(number.cast("string")),
        "TOTAL_BALANCE_DUE": F.when(number % 10 < 2, F.lit("n/a")).when(number % 10 < 3, F.lit("  ")).otherwise(due)}
    text = raw.select(*[e.alias(c) for c, e in said.items()])
    typed = typed_scan(text, schemas.ENFORCEMENT)
    dates = rescued([(c, F.col(c), parse_date(c)) for c in schemas.ENFORCEMENT_DATES])
    return reject_report(typed.withColumn(RESCUED, merge(F.col(RESCUED), dates)))


@query("mart_proofs")
def q_mart_proofs(spark, sf):
    return pl.mart_proofs(_enf_clean(spark, sf), *pl.dims(_lookup_clean(spark, sf)))


@query("column_quantiles")
def q_column_quantiles(spark, sf):
    """Exact quantiles of all amounts, narrowed together."""
    from ..operators.quantiles import exact_quantiles
    shares = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    m = materialize(_mart(spark, sf).select(*MONEY_COLS, "COMPLAINT_COUNT", "HIGHEST_PRIORITY"))
    got = exact_quantiles(m, {c: shares for c in m.columns})
    rows = [(c, q, v) for c, vs in got.items() for q, v in zip(shares, vs)]
    return spark.createDataFrame(rows, "column string, share double, value double").withColumn("value", r6("value"))


@query("masked_flags")
def q_masked_flags(spark, sf):
    lk = _lookup_clean(spark, sf)
    return lk.withColumns({c: dbl(c) for c in ["IS_24HR", "IS_HOSPITAL", "IS_LOW_RESOURCE"]})


@query("split_strata")
def q_split_strata(spark, sf):
    m = _mart(spark, sf)
    return m.where(F.col("IS_HOSPITAL") == 1).select("EVENTID", "FACID", "PENALTY_NUMBER", "CLASS_FINAL")


@query("exclude_outcomes")
def q_exclude_outcomes(spark, sf):
    m = _mart(spark, sf)
    return filters.exclude_outcomes(m, "CLASS_FINAL", P["invalid_outcomes"]).select(
        "EVENTID", "FACID", "PENALTY_NUMBER", "CLASS_FINAL")


@query("filter_report")
def q_filter_report(spark, sf):
    m = _mart(spark, sf)
    return filters.filter_report(m, filters.keep_outcome("CLASS_FINAL", P["invalid_outcomes"]))


@query("keyword_flags")
def q_keyword_flags(spark, sf):
    f = _flagged(spark, sf)
    return f.select("EVENTID", "PENALTY_NUMBER", "PENALTY_CATEGORY", *[big(n).alias(n) for n in P["flags"]])


# ---------------------------------------------------------------- cleaning


def _enf_clean(spark, sf):
    return pl.clean_enforcement(standin.raw_enforcement(spark, sf), P)


@query("clean_code")
def q_clean_code(spark, sf):
    e = _enf_clean(spark, sf)
    return e.select("EVENTID", "PENALTY_NUMBER", "FACID", "FAC_TYPE_CODE", "CLASS_ASSESSED_INITIAL")


@query("clean_detail")
def q_clean_detail(spark, sf):
    e = _enf_clean(spark, sf)
    return e.select("EVENTID", "PENALTY_NUMBER", "PENALTY_DETAIL")


@query("recode_keep")
def q_recode_keep(spark, sf):
    from ..functions import recode, strip_tabs, utrim
    r = standin.raw_enforcement(spark, sf)
    return r.select("EVENTID", "PENALTY_NUMBER", recode(strip_tabs(utrim("CLASS_ASSESSED_FINAL")),
                                                        P["class_final_recode"]).alias("class_recoded"))


@query("recode_null")
def q_recode_null(spark, sf):
    from ..functions import recode
    r = standin.raw_enforcement(spark, sf)
    filled = F.coalesce(F.col("DEATH_RELATED"), F.lit(presets.DEATH_FILL))
    return r.select("EVENTID", "PENALTY_NUMBER", F.col("DEATH_RELATED").alias("death_raw"),
                    dbl(recode(filled, presets.DEATH_MAP, keep=False)).alias("death_code"))


@query("effective_class")
def q_effective_class(spark, sf):
    e = _enf_clean(spark, sf)
    return e.select("EVENTID", "PENALTY_NUMBER", "CLASS_ASSESSED_INITIAL", "CLASS_ASSESSED_FINAL",
                    dbl("APPEALED").alias("APPEALED"))


@query("parse_dates")
def q_parse_dates(spark, sf):
    from ..functions import parse_date
    r = standin.raw_enforcement(spark, sf)
    return r.select("EVENTID", "PENALTY_NUMBER", F.col("PENALTY_ISSUE_DATE").alias("issue_raw"),
                    ts_text(parse_date("PENALTY_ISSUE_DATE")).alias("issue_date"),
                    ts_text(parse_date("VIOLATION_FROM_DATE")).alias("violation_date"))


@query("priority_features")
def q_priority_features(spark, sf):
    e = _enf_clean(spark, sf)
    return e.select("EVENTID", "PENALTY_NUMBER", "PRIORITY_ALL", dbl("HIGHEST_PRIORITY").alias("HIGHEST_PRIORITY"),
                    big("COMPLAINT_COUNT").alias("COMPLAINT_COUNT"))


# ------------------------------------------------------------------- joins


@query("attach_first")
def q_attach_first(spark, sf):
    m = materialize(pl.selection_columns(_mart(spark, sf)))  # read by the profiles and by the attached names
    prof = profile.facility_profile(pl.penalty_features(m, P).where(F.col("IS_HOSPITAL") == 1), P["hosp_profile"])
    return joins.attach_first(prof.select("FACID", "total_penalties"), pl.valid_penalties(m, P), "FACID",
                              pl.FIRST_ORDER, ["FACILITY_NAME", "DISTRICT_OFFICE"])


@query("first_per_key")
def q_first_per_key(spark, sf):
    m = pl.valid_penalties(_mart(spark, sf), P)
    return joins.first_per_key(m, "FACID", pl.FIRST_ORDER,
                               ["PENALTY_NUMBER", "EVENTID", "FACILITY_NAME", "DISTRICT_OFFICE", "PENALTY_TYPE"])


# ------------------------------------------------------------ aggregations


@query("value_counts")
def q_value_counts(spark, sf):
    return agg.value_counts(_mart(spark, sf), "FAC_TYPE_CODE")


@query("value_share")
def q_value_share(spark, sf):
    v = agg.value_share(_mart(spark, sf), "PENALTY_TYPE")
    return v.withColumn("percent", r6("percent"))


@query("complaints_by_type")
def q_complaints_by_type(spark, sf):
    v = agg.value_share_within(_mart(spark, sf), "PENALTY_TYPE", "COMPLAINT_COUNT", P["report_types"], "key")
    return v.withColumns({"percent": r6("percent"), "COMPLAINT_COUNT": big("COMPLAINT_COUNT")})


@query("class_by_type")
def q_class_by_type(spark, sf):
    v = agg.value_share_within(_mart(spark, sf), "PENALTY_TYPE", "CLASS_FINAL", P["report_types"], "count")
    return v.withColumn("percent", r6("percent"))


@query("crosstab")
def q_crosstab(spark, sf):
    return agg.crosstab(_mart(spark, sf), "DISTRICT_OFFICE", "PENALTY_TYPE")


@query("crosstab_share")
def q_crosstab_share(spark, sf):
    c = agg.crosstab_share(_mart(spark, sf), "DISTRICT_OFFICE", "PENALTY_TYPE", top=presets.HEATMAP_TOP_ROWS)
    return c.withColumns({v: r6(F.col(f"`{v}`")) for v in c.columns if v != "DISTRICT_OFFICE"})


@query("group_size")
def q_group_size(spark, sf):
    return agg.group_size(_mart(spark, sf), ["DISTRICT_OFFICE", "PENALTY_TYPE"])


@query("district_stats")
def q_district_stats(spark, sf):
    d = agg.district_stats(_mart(spark, sf), "DISTRICT_OFFICE", P["serious_classes"])
    return d.withColumn("total_balance", money("total_balance"))


@query("district_geo")
def q_district_geo(spark, sf):
    from ..operators.reports import district_map, map_points
    d = map_points(district_map(_mart(spark, sf), standin.coordinates(spark, sf), "DISTRICT_OFFICE",
                                P["serious_classes"]))
    return d.withColumns({"total_balance": money("total_balance"), "size_scaled": r6("size_scaled"),
                          "lat": r6("lat"), "lon": r6("lon")})


@query("table_report")
def q_table_report(spark, sf):
    return agg.table_report(_mart(spark, sf), "FACID")


@query("log_histogram")
def q_log_histogram(spark, sf):
    h = agg.log_histogram(_mart(spark, sf), "TOTAL_BALANCE_DUE", presets.HISTOGRAM_BINS)
    return h.withColumns({"bin": big("bin"), "bin_lo": r6("bin_lo"), "bin_hi": r6("bin_hi")})


@query("actions_per_year")
def q_actions_per_year(spark, sf):
    y = agg.counts_per_year(_mart(spark, sf), "PENALTY_ISSUE_DATE")
    return y.withColumn("Year", big("Year"))


@query("rate_by_group")
def q_rate_by_group(spark, sf):
    r = agg.rate_by_group(_mart(spark, sf), "PENALTY_TYPE", F.col("APPEALED") == 1)
    return r.withColumn("appeal_rate", r6("appeal_rate"))


@query("share_within")
def q_share_within(spark, sf):
    g = agg.group_size(_mart(spark, sf), ["DISTRICT_OFFICE", "PENALTY_TYPE"])
    return windows.share_within(g, "PENALTY_TYPE").withColumn("percent", r6("percent"))


@query("event_gaps")
def q_event_gaps(spark, sf):
    g = windows.event_gaps(_mart(spark, sf), "FACID", "EVENTID", "PENALTY_ISSUE_DATE")
    return g.withColumns({"event_date": ts_text("event_date"), "days_to_prev": dbl("days_to_prev")})


@query("gap_by_group")
def q_gap_by_group(spark, sf):
    # one narrow copy of the mart, read by the gaps and by the groups
    m = materialize(_mart(spark, sf).select("FACID", "EVENTID", "PENALTY_ISSUE_DATE", "IS_HOSPITAL"))
    _, by_group = windows.gap_report(m, "FACID", "EVENTID", "PENALTY_ISSUE_DATE", "IS_HOSPITAL")
    return by_group.withColumns({"IS_HOSPITAL": big("IS_HOSPITAL"), "mean_days": r6("mean_days"),
                                 "median_days": r6("median_days")})


@query("gap_overall")
def q_gap_overall(spark, sf):
    m = materialize(_mart(spark, sf).select("FACID", "EVENTID", "PENALTY_ISSUE_DATE", "IS_HOSPITAL"))
    overall, _ = windows.gap_report(m, "FACID", "EVENTID", "PENALTY_ISSUE_DATE", "IS_HOSPITAL")
    return overall.withColumns({"mean_days": r6("mean_days"), "median_days": r6("median_days")})


@query("union_strata")
def q_union_strata(spark, sf):
    f = _flagged(spark, sf)
    grouped = materialize(profile.strata_profiles(f, P["hosp_profile"], P["ltc_profile"]))
    h, lt = profile.split_strata(grouped, P["hosp_profile"], P["ltc_profile"])
    u = selection.union_strata(h.withColumn("stratum", F.lit(presets.STRATUM_HOSPITAL)),
                               lt.withColumn("stratum", F.lit(presets.STRATUM_LTC)))
    return u.select("stratum", "FACID", "total_penalties", dbl("total_ap_ij").alias("total_ap_ij"),
                    dbl("total_class_aa").alias("total_class_aa"), "total_ftr_br")


# ----------------------------------------------------------- flow reports


def _transitions(spark, sf):
    from ..operators.reports import transitions
    return transitions(_mart(spark, sf), "CLASS_ASSESSED_INITIAL", "CLASS_FINAL", P["transition_start"],
                       presets.TRANSITION_MIN_COUNT)


@query("transitions")
def q_transitions(spark, sf):
    return _transitions(spark, sf)


def _flow(spark, sf):
    from ..operators.reports import flow_graph
    return flow_graph(_transitions(spark, sf), "CLASS_ASSESSED_INITIAL", "CLASS_FINAL",
                      P["reversed_outcomes"], P["dropped_outcome"], P["severe_markers"])


@query("flow_nodes")
def q_flow_nodes(spark, sf):
    n, _ = _flow(spark, sf)
    return n.withColumns({"id": big("id"), "side": big("side")})


@query("flow_edges")
def q_flow_edges(spark, sf):
    _, e = _flow(spark, sf)
    return e.withColumns({"source": big("source"), "target": big("target")})


# ------------------------------------------------------- model preparation


@query("impute_scale")
def q_impute_scale(spark, sf):
    t = _fac(spark, sf, hospital=False, checkpoint=True)
    feats = P["ltc_features"]
    s = profile.impute_and_scale(t.select("FACID", *feats), feats)
    return s.select("FACID", *[r6(c).alias(c) for c in feats])


# ------------------------------------------------------------------- text


def _narr(spark, sf):
    return pl.clean_narratives(standin.raw_narratives(spark, sf))


@query("quoted_scan")
def q_quoted_scan(spark, sf):
    """Narratives written as quoted multi-line Latin-1 text, read range by range."""
    from ..session import scratch_path
    from ..sources import scan_quoted, write_text_table
    raw = standin.raw_narratives(spark, sf).withColumn(
        "NARRATIVE", F.regexp_replace("NARRATIVE", "[^\\x{00}-\\x{FF}]", "?"))
    path = scratch_path(spark)
    write_text_table(raw, path, encoding="ISO-8859-1")
    rows = scan_quoted(spark, path, "ISO-8859-1")
    return rows.select("FACID", "FACILITY_NAME", "PENALTY_ISSUE_DATE", big(F.length("NARRATIVE")).alias("n_chars"),
                       F.md5("NARRATIVE").alias("narrative_md5"))


@query("narrative_table")
def q_narrative_table(spark, sf):
    return pl.narrative_table(standin.raw_narratives(spark, sf))


@query("clean_text")
def q_clean_text(spark, sf):
    return _narr(spark, sf).select("FACID", "NARRATIVE_CLEAN")


@query("title_case")
def q_title_case(spark, sf):
    return _narr(spark, sf).select("FACID", "FACILITY_NAME")


@query("term_counts")
def q_term_counts(spark, sf):
    from ..operators import keywords as kw
    return kw.term_counts(_narr(spark, sf), "FACID", "NARRATIVE_CLEAN")


@query("vocabulary")
def q_vocabulary(spark, sf):
    from ..operators import keywords as kw
    tf = kw.term_counts(_narr(spark, sf), "FACID", "NARRATIVE_CLEAN")
    return kw.vocabulary(tf, "FACID")


@query("tfidf")
def q_tfidf(spark, sf):
    from ..operators import keywords as kw
    w = kw.tfidf(_narr(spark, sf), "FACID", "NARRATIVE_CLEAN")
    return w.withColumn("weight", r6("weight"))


@query("top_keywords")
def q_top_keywords(spark, sf):
    from ..operators import keywords as kw
    n = _narr(spark, sf)
    return kw.top_keywords(n, kw.tfidf(n, "FACID", "NARRATIVE_CLEAN"), "FACID")


# -------------------------------------------------------- forest (rows-only)


def _scored(spark, sf):
    return pl.score_facilities(_mart(spark, sf), P)


@query("iforest_score")
def q_iforest_score(spark, sf):
    parts = [s.select(F.lit(name).alias("stratum"), "FACID", r6("anomaly_score").alias("anomaly_score"),
                      big("is_anomaly").alias("is_anomaly"))
             for name, (s, _, _) in _scored(spark, sf).items()]
    return parts[0].unionByName(parts[1])


@query("attribution")
def q_attribution(spark, sf):
    fitted = pl.score_facilities(_mart(spark, sf), P, score=False)
    return pl.attribution(fitted).withColumn("mean_abs", r6("mean_abs"))


@query("inspection_list")
def q_inspection_list(spark, sf):
    m = materialize(pl.selection_columns(_mart(spark, sf)))  # read by the profiles and by the attached names
    return pl.inspection_list(m, pl.score_facilities(m, P), preset=P).withColumns(
        {"anomaly_score": r6("anomaly_score"), "deaths_rate": r6("deaths_rate"),
         "balance_per_penalty": r6("balance_per_penalty"), "rank": big("rank")})
