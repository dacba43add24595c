"""DuckDB oracle SQL for the registered queries (same column names)."""

from __future__ import annotations

from .. import presets
from . import oracle_base as ob
from .oracle_base import BASE_FLAGGED, BASE_MART, in_list

P = presets.STANDIN
ORACLE: dict[str, str] = {}


def r6(e: str) -> str:
    return f"round({e}, 6)"


def money(e: str) -> str:
    return f"round(CAST({e} AS DOUBLE), 2)"


ORACLE["enriched_mart"] = BASE_MART + """
SELECT EVENTID, FACID, FACILITY_NAME, FAC_TYPE_CODE, FAC_FDR, DISTRICT_OFFICE, FACILITY_TYPE_DESC,
  CAST(IS_HOSPITAL AS BIGINT) AS IS_HOSPITAL, CAST(IS_24HR AS BIGINT) AS IS_24HR,
  CAST(IS_LOW_RESOURCE AS BIGINT) AS IS_LOW_RESOURCE, PENALTY_NUMBER,
  strftime(PENALTY_ISSUE_DATE, '%Y-%m-%d %H:%M:%S') AS PENALTY_ISSUE_DATE, PENALTY_TYPE, PENALTY_CATEGORY,
  DISPOSITION, CLASS_ASSESSED_INITIAL, CLASS_FINAL, DESCRIPTION,
  CAST(DEATH_RELATED AS DOUBLE) AS DEATH_RELATED, CAST(APPEALED AS DOUBLE) AS APPEALED,
  round(CAST(TOTAL_AMOUNT_INITIAL AS DOUBLE), 2) AS TOTAL_AMOUNT_INITIAL,
  round(CAST(TOTAL_AMOUNT_DUE_FINAL AS DOUBLE), 2) AS TOTAL_AMOUNT_DUE_FINAL,
  round(CAST(TOTAL_BALANCE_DUE AS DOUBLE), 2) AS TOTAL_BALANCE_DUE,
  round(CAST(TOTAL_PENALTY_OFFSET_AMOUNT AS DOUBLE), 2) AS TOTAL_PENALTY_OFFSET_AMOUNT,
  CAST(HIGHEST_PRIORITY AS DOUBLE) AS HIGHEST_PRIORITY, CAST(COMPLAINT_COUNT AS BIGINT) AS COMPLAINT_COUNT
FROM mart"""


def profile_select(prof, hospital: bool) -> str:
    cols = [
        "count(PENALTY_NUMBER) AS total_penalties",
        "CAST(coalesce(sum(DEATH_RELATED), 0) AS BIGINT) AS total_deaths",
        "CAST(coalesce(sum(APPEALED), 0) AS BIGINT) AS total_appealed",
        "round(CAST(coalesce(sum(TOTAL_BALANCE_DUE), 0) AS DOUBLE), 2) AS total_balance_due",
        "CAST(coalesce(sum(COMPLAINT_COUNT), 0) AS BIGINT) AS total_complaints",
    ]
    cols += [f"CAST(coalesce(sum(is_{f}), 0) AS BIGINT) AS total_{f}" for f in prof["flags"]]
    cols += [f"count(*) FILTER (WHERE CLASS_FINAL IN {in_list(v)}) AS total_{n}" for n, v in prof["classes"]]
    cols.append("strftime(max(PENALTY_ISSUE_DATE), '%Y-%m-%d %H:%M:%S') AS last_penalty_date")
    return (f"SELECT FACID, {', '.join(cols)} FROM flagged WHERE IS_HOSPITAL = {1 if hospital else 0} "
            f"AND FACID IS NOT NULL GROUP BY FACID")


def _counts(prof):
    return [f"total_{f}" for f in prof["flags"]] + [f"total_{n}" for n, _ in prof["classes"]] + ["total_deaths"]


def _rname(c):
    return c.replace("total_", "") + "_rate"


def rates_select(prof, src: str) -> str:
    n = "CAST(nullif(total_penalties, 0) AS DOUBLE)"
    cols = [f"CAST({c} AS DOUBLE) / {n} AS {_rname(c)}" for c in _counts(prof)]
    cols += [f"CAST(total_appealed AS DOUBLE) / {n} AS appeal_rate",
             f"ln(1 + CAST(total_complaints AS DOUBLE)) / {n} AS complaint_rate_log",
             f"CAST(total_balance_due AS DOUBLE) / {n} AS balance_per_penalty"]
    return f"SELECT *, {', '.join(cols)} FROM {src}"


def eb_select(prof, src: str) -> str:
    rates = [_rname(c) for c in _counts(prof)]
    means = ", ".join(f"avg({r}) AS mu_{r}" for r in rates)
    w = "(CAST(total_penalties AS DOUBLE) / (CAST(total_penalties AS DOUBLE) + 5.0))"
    cols = ", ".join(f"{w} * {r} + (1.0 - {w}) * m.mu_{r} AS {r}_eb" for r in rates)
    return (f"SELECT s.*, {cols} FROM {src} s, "
            f"(SELECT {means} FROM {src} WHERE total_penalties > 0) m")


def fac_ctes(hospital: bool) -> str:
    prof = P["hosp_profile"] if hospital else P["ltc_profile"]
    tag = "h" if hospital else "l"
    return (f", prof_{tag} AS ({profile_select(prof, hospital)})"
            f", rated_{tag} AS ({rates_select(prof, f'prof_{tag}')})"
            f", fac_{tag} AS ({eb_select(prof, f'rated_{tag}')})")


ORACLE["profile_hosp"] = BASE_FLAGGED + "\n" + profile_select(P["hosp_profile"], True)
ORACLE["profile_ltc"] = BASE_FLAGGED + "\n" + profile_select(P["ltc_profile"], False)

_hosp_rates = [_rname(c) for c in _counts(P["hosp_profile"])] + ["appeal_rate", "complaint_rate_log",
                                                                  "balance_per_penalty"]
ORACLE["rates"] = (BASE_FLAGGED + fac_ctes(True) + "\nSELECT FACID, total_penalties, "
                   + ", ".join(f"round({c}, 6) AS {c}" for c in _hosp_rates) + " FROM rated_h")

_ltc_rates = [_rname(c) for c in _counts(P["ltc_profile"])]
ORACLE["eb_smooth"] = (BASE_FLAGGED + fac_ctes(False) + "\nSELECT FACID, total_penalties, "
                       + ", ".join(f"round({r}_eb, 6) AS {r}_eb" for r in _ltc_rates) + " FROM fac_l")

_SCORED = (fac_ctes(True) + fac_ctes(False) + """,
scored AS (
  SELECT 'Hospital' AS stratum, FACID, round(-deaths_rate_eb, 6) AS score, deaths_rate_eb, total_penalties FROM fac_h
  UNION ALL
  SELECT 'LTC & NTC', FACID, round(-deaths_rate_eb, 6), deaths_rate_eb, total_penalties FROM fac_l
),
hits AS (
  SELECT count(*) FILTER (WHERE stratum = 'Hospital' AND deaths_rate_eb >= 0.4) AS h1,
         count(*) FILTER (WHERE stratum <> 'Hospital' AND deaths_rate_eb >= 0.4) AS h2 FROM scored
),
quotas AS (
  SELECT 'Hospital' AS stratum, h1 AS hits,
         greatest(1, CAST(coalesce(round_even(25.0 * h1 / nullif(h1 + h2, 0), 0), 1) AS BIGINT)) AS quota FROM hits
  UNION ALL
  SELECT 'LTC & NTC', h2,
         25 - greatest(1, CAST(coalesce(round_even(25.0 * h1 / nullif(h1 + h2, 0), 0), 1) AS BIGINT)) FROM hits
)""")

ORACLE["quotas"] = BASE_FLAGGED + _SCORED + "\nSELECT stratum, CAST(hits AS BIGINT) AS hits, CAST(quota AS BIGINT) AS quota FROM quotas"

ORACLE["top_k_strata"] = BASE_FLAGGED + _SCORED + """,
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.stratum ORDER BY s.score, s.FACID) AS rn FROM scored s
)
SELECT r.FACID, r.score, r.total_penalties, r.stratum,
       CAST(row_number() OVER (ORDER BY r.score, r.FACID) AS INTEGER) AS rank
FROM ranked r JOIN quotas q ON r.stratum = q.stratum
WHERE r.rn <= q.quota"""


# ------------------------------------------------------ scans / projections

ORACLE["std_columns"] = """
SELECT c_custkey AS C_CUSTKEY, c_name AS C_NAME, CAST(c_nationkey AS BIGINT) AS C_NATIONKEY,
       c_acctbal AS C_ACCTBAL, c_mktsegment AS C_MKTSEGMENT FROM customer"""

_LK_BASE = ob.with_ctes(ob.RAW_LOOKUP, ob.LOOKUP)

ORACLE["drop_values"] = _LK_BASE + f"""
SELECT * FROM raw_lookup WHERE VARIABLE IS NULL OR VARIABLE NOT IN {in_list(presets.LOOKUP_HEADER_VALUES)}"""

ORACLE["masked_flags"] = _LK_BASE + """
SELECT VARIABLE, VALUE, DESCRIPTION, DEFINITION, CAST(IS_24HR AS DOUBLE) AS IS_24HR,
       CAST(IS_HOSPITAL AS DOUBLE) AS IS_HOSPITAL, CAST(IS_LOW_RESOURCE AS DOUBLE) AS IS_LOW_RESOURCE FROM lk"""

ORACLE["split_strata"] = BASE_MART + """
SELECT EVENTID, FACID, PENALTY_NUMBER, CLASS_FINAL FROM mart WHERE IS_HOSPITAL = 1"""

_KEEP = f"lower(coalesce(CLASS_FINAL, '')) NOT IN {in_list([v.lower() for v in P['invalid_outcomes']])}"

ORACLE["exclude_outcomes"] = BASE_MART + f"""
SELECT EVENTID, FACID, PENALTY_NUMBER, CLASS_FINAL FROM mart WHERE {_KEEP}"""

ORACLE["filter_report"] = BASE_MART + f"""
SELECT count(*) AS rows_before, count(*) FILTER (WHERE NOT ({_KEEP})) AS dropped,
       count(*) FILTER (WHERE {_KEEP}) AS remaining FROM mart"""

ORACLE["keyword_flags"] = BASE_FLAGGED + "\nSELECT EVENTID, PENALTY_NUMBER, PENALTY_CATEGORY, " + ", ".join(
    f"CAST({n} AS BIGINT) AS {n}" for n in P["flags"]) + " FROM flagged"

# ---------------------------------------------------------------- cleaning

_ENF_BASE = ob.with_ctes(ob.RAW_ENF, ob.ENF)

ORACLE["clean_code"] = _ENF_BASE + """
SELECT EVENTID, PENALTY_NUMBER, FACID, FAC_TYPE_CODE, CLASS_ASSESSED_INITIAL FROM enf"""

ORACLE["clean_detail"] = _ENF_BASE + """
SELECT EVENTID, PENALTY_NUMBER, PENALTY_DETAIL FROM enf"""

ORACLE["recode_keep"] = ob.with_ctes(ob.RAW_ENF) + f"""
SELECT EVENTID, PENALTY_NUMBER,
  {ob.case_recode(f"replace({ob.utrim('CLASS_ASSESSED_FINAL')}, chr(9), '')", P['class_final_recode'])} AS class_recoded
FROM raw_enf"""

ORACLE["recode_null"] = ob.with_ctes(ob.RAW_ENF) + """
SELECT EVENTID, PENALTY_NUMBER, DEATH_RELATED AS death_raw,
  CAST(CASE coalesce(DEATH_RELATED, 'N') WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS DOUBLE) AS death_code
FROM raw_enf"""

ORACLE["effective_class"] = _ENF_BASE + """
SELECT EVENTID, PENALTY_NUMBER, CLASS_ASSESSED_INITIAL, CLASS_ASSESSED_FINAL, CAST(APPEALED AS DOUBLE) AS APPEALED
FROM enf"""

ORACLE["parse_dates"] = ob.with_ctes(ob.RAW_ENF) + f"""
SELECT EVENTID, PENALTY_NUMBER, PENALTY_ISSUE_DATE AS issue_raw,
  strftime({ob.parse_ts('PENALTY_ISSUE_DATE')}, '%Y-%m-%d %H:%M:%S') AS issue_date,
  strftime({ob.parse_ts('VIOLATION_FROM_DATE')}, '%Y-%m-%d %H:%M:%S') AS violation_date
FROM raw_enf"""

ORACLE["priority_features"] = _ENF_BASE + """
SELECT EVENTID, PENALTY_NUMBER, PRIORITY_ALL, CAST(HIGHEST_PRIORITY AS DOUBLE) AS HIGHEST_PRIORITY,
  CAST(COMPLAINT_COUNT AS BIGINT) AS COMPLAINT_COUNT FROM enf"""

# ------------------------------------------------------------------- joins

_FIRST = """
firstrow AS (
  SELECT FACID, PENALTY_NUMBER, EVENTID, FACILITY_NAME, DISTRICT_OFFICE, PENALTY_TYPE FROM (
    SELECT *, row_number() OVER (PARTITION BY FACID ORDER BY PENALTY_ISSUE_DATE, PENALTY_NUMBER, EVENTID,
                                 FACILITY_NAME, DISTRICT_OFFICE, PENALTY_TYPE) AS rn
    FROM flagged WHERE FACID IS NOT NULL) WHERE rn = 1
)"""

ORACLE["first_per_key"] = BASE_FLAGGED + "," + _FIRST + "\nSELECT * FROM firstrow"

ORACLE["attach_first"] = BASE_FLAGGED + "," + """
firstinfo AS (
  SELECT FACID, FACILITY_NAME, DISTRICT_OFFICE FROM (
    SELECT *, row_number() OVER (PARTITION BY FACID ORDER BY PENALTY_ISSUE_DATE, PENALTY_NUMBER, EVENTID,
      FACILITY_NAME, DISTRICT_OFFICE) AS rn
    FROM flagged WHERE FACID IS NOT NULL) WHERE rn = 1
)
SELECT p.FACID, p.total_penalties, f.FACILITY_NAME, f.DISTRICT_OFFICE
FROM (SELECT FACID, count(PENALTY_NUMBER) AS total_penalties FROM flagged
      WHERE IS_HOSPITAL = 1 AND FACID IS NOT NULL GROUP BY FACID) p
LEFT JOIN firstinfo f ON p.FACID = f.FACID"""

# ------------------------------------------------------------ aggregations

ORACLE["value_counts"] = BASE_MART + """
SELECT FAC_TYPE_CODE, count(*) AS count FROM mart WHERE FAC_TYPE_CODE IS NOT NULL GROUP BY 1"""

ORACLE["value_share"] = BASE_MART + """
SELECT PENALTY_TYPE, count, round(count * 100.0 / sum(count) OVER (), 6) AS percent
FROM (SELECT PENALTY_TYPE, count(*) AS count FROM mart WHERE PENALTY_TYPE IS NOT NULL GROUP BY 1)"""

_TYPES = in_list(P["report_types"])


def _within(col: str, cast: str = "") -> str:
    c = f"CAST({col} AS BIGINT)" if cast else col
    return BASE_MART + f"""
SELECT PENALTY_TYPE, {c} AS {col}, count,
  round(count * 100.0 / sum(count) OVER (PARTITION BY PENALTY_TYPE), 6) AS percent,
  printf('%d (%.1f%%)', count, round_even(count * 100.0 / sum(count) OVER (PARTITION BY PENALTY_TYPE), 1)) AS label
FROM (SELECT PENALTY_TYPE, {col}, count(*) AS count FROM mart
      WHERE PENALTY_TYPE IN {_TYPES} AND PENALTY_TYPE IS NOT NULL AND {col} IS NOT NULL GROUP BY 1, 2)"""


ORACLE["complaints_by_type"] = _within("COMPLAINT_COUNT", "bigint")
ORACLE["class_by_type"] = _within("CLASS_FINAL")

_PRI = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

ORACLE["crosstab"] = BASE_MART + "\nSELECT DISTRICT_OFFICE, " + ", ".join(
    f"count(*) FILTER (WHERE PENALTY_TYPE = {ob.q(v)}) AS \"{v}\"" for v in _PRI) + \
    " FROM mart WHERE DISTRICT_OFFICE IS NOT NULL AND PENALTY_TYPE IS NOT NULL GROUP BY 1"

ORACLE["crosstab_share"] = BASE_MART + """,
cnt AS (SELECT DISTRICT_OFFICE, PENALTY_TYPE, count(*) AS c FROM mart
        WHERE DISTRICT_OFFICE IS NOT NULL AND PENALTY_TYPE IS NOT NULL GROUP BY 1, 2),
pct AS (SELECT *, c * 100.0 / sum(c) OVER (PARTITION BY PENALTY_TYPE) AS p FROM cnt),
toprows AS (SELECT DISTRICT_OFFICE FROM pct GROUP BY 1 ORDER BY sum(p) DESC, DISTRICT_OFFICE LIMIT 20)
SELECT DISTRICT_OFFICE, """ + ", ".join(
    f"round(coalesce(max(p) FILTER (WHERE PENALTY_TYPE = {ob.q(v)}), 0.0), 6) AS \"{v}\"" for v in _PRI) + """
FROM pct WHERE DISTRICT_OFFICE IN (SELECT DISTRICT_OFFICE FROM toprows) GROUP BY 1"""

ORACLE["group_size"] = BASE_MART + """
SELECT DISTRICT_OFFICE, PENALTY_TYPE, count(*) AS count FROM mart
WHERE DISTRICT_OFFICE IS NOT NULL AND PENALTY_TYPE IS NOT NULL GROUP BY 1, 2"""

_DSTATS = f"""
dstats AS (
  SELECT DISTRICT_OFFICE, count(PENALTY_NUMBER) AS total_actions,
    count(*) FILTER (WHERE CLASS_FINAL IN {in_list(P['serious_classes'])}) AS serious_citations,
    CAST(coalesce(sum(DEATH_RELATED), 0) AS BIGINT) AS death_related,
    round(CAST(coalesce(sum(TOTAL_BALANCE_DUE), 0) AS DOUBLE), 2) AS total_balance
  FROM mart WHERE DISTRICT_OFFICE IS NOT NULL GROUP BY 1
)"""

ORACLE["district_stats"] = BASE_MART + "," + _DSTATS + "\nSELECT * FROM dstats"

ORACLE["district_geo"] = BASE_MART + "," + _DSTATS + """,
coords AS (SELECT n_name AS DISTRICT_OFFICE, 32.5 + n_nationkey * 0.25 AS lat, -124.0 + n_regionkey * 1.5 AS lon
           FROM nation),
shares AS (
  SELECT d.*, round(c.lat, 6) AS lat, round(c.lon, 6) AS lon,
    round_even(d.total_actions * 100.0 / sum(d.total_actions) OVER (), 1) AS citation_share_pct,
    round_even(d.serious_citations * 100.0 / nullif(sum(d.serious_citations) OVER (), 0), 1) AS serious_share_pct,
    round_even(d.serious_citations * 100.0 / nullif(d.total_actions, 0), 1) AS serious_rate
  FROM dstats d LEFT JOIN coords c ON d.DISTRICT_OFFICE = c.DISTRICT_OFFICE
)
SELECT *, round(pow(sqrt(citation_share_pct), 2.5), 6) AS size_scaled FROM shares
WHERE lat IS NOT NULL AND lon IS NOT NULL"""

ORACLE["table_report"] = BASE_MART + """
SELECT count(*) AS row_count, count(DISTINCT FACID) AS distinct_keys FROM mart"""

ORACLE["log_histogram"] = BASE_MART + """,
x AS (SELECT log10(CAST(TOTAL_BALANCE_DUE AS DOUBLE)) AS x FROM mart WHERE TOTAL_BALANCE_DUE > 0),
b AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 50.0 AS w FROM x)
SELECT CAST(bin AS BIGINT) AS bin, round(lo + bin * w, 6) AS bin_lo, round(lo + (bin + 1) * w, 6) AS bin_hi,
       count(*) AS count
FROM (SELECT CASE WHEN b.w > 0 THEN least(floor((x.x - b.lo) / b.w), 49) ELSE 0 END AS bin, b.lo, b.w
      FROM x, b)
GROUP BY bin, lo, w"""

ORACLE["actions_per_year"] = BASE_MART + """
SELECT CAST(year(PENALTY_ISSUE_DATE) AS BIGINT) AS Year, count(*) AS Violation_Count
FROM mart WHERE PENALTY_ISSUE_DATE IS NOT NULL GROUP BY 1"""

ORACLE["rate_by_group"] = BASE_MART + """
SELECT PENALTY_TYPE, total, appealed, round(appealed * 100.0 / total, 6) AS appeal_rate,
  printf('%d (%.1f%%)', appealed, round_even(appealed * 100.0 / total, 1)) AS label
FROM (SELECT PENALTY_TYPE, count(*) AS total, count(*) FILTER (WHERE APPEALED = 1) AS appealed
      FROM mart WHERE PENALTY_TYPE IS NOT NULL GROUP BY 1)"""

ORACLE["share_within"] = BASE_MART + """
SELECT DISTRICT_OFFICE, PENALTY_TYPE, count, round(count * 100.0 / sum(count) OVER (PARTITION BY PENALTY_TYPE), 6) AS percent
FROM (SELECT DISTRICT_OFFICE, PENALTY_TYPE, count(*) AS count FROM mart
      WHERE DISTRICT_OFFICE IS NOT NULL AND PENALTY_TYPE IS NOT NULL GROUP BY 1, 2)"""

_GAPS = """
gaps AS (
  SELECT FACID, EVENTID, event_date,
    CAST(date_sub('day', lag(event_date) OVER (PARTITION BY FACID ORDER BY event_date ASC NULLS FIRST, EVENTID),
                   event_date) AS DOUBLE) AS days_to_prev
  FROM (SELECT FACID, EVENTID, min(PENALTY_ISSUE_DATE) AS event_date FROM mart
        WHERE FACID IS NOT NULL AND EVENTID IS NOT NULL GROUP BY 1, 2)
)"""

ORACLE["event_gaps"] = BASE_MART + "," + _GAPS + """
SELECT FACID, EVENTID, strftime(event_date, '%Y-%m-%d %H:%M:%S') AS event_date, days_to_prev FROM gaps"""

ORACLE["gap_by_group"] = BASE_MART + "," + _GAPS + """
SELECT CAST(g2.IS_HOSPITAL AS BIGINT) AS IS_HOSPITAL, count(*) AS n_gaps, round(avg(days_to_prev), 6) AS mean_days,
  round(median(days_to_prev), 6) AS median_days
FROM gaps g LEFT JOIN (SELECT DISTINCT FACID, IS_HOSPITAL FROM mart) g2 ON g.FACID = g2.FACID
WHERE days_to_prev IS NOT NULL AND g2.IS_HOSPITAL IS NOT NULL GROUP BY 1"""

ORACLE["gap_overall"] = BASE_MART + "," + _GAPS + """
SELECT count(*) AS n_gaps, round(avg(days_to_prev), 6) AS mean_days, round(median(days_to_prev), 6) AS median_days
FROM gaps WHERE days_to_prev IS NOT NULL"""

ORACLE["union_strata"] = BASE_FLAGGED + f"""
SELECT 'Hospital' AS stratum, FACID, count(PENALTY_NUMBER) AS total_penalties,
  CAST(count(*) FILTER (WHERE CLASS_FINAL IN {in_list(dict(P['hosp_profile']['classes'])['ap_ij'])}) AS DOUBLE) AS total_ap_ij,
  CAST(NULL AS DOUBLE) AS total_class_aa,
  count(*) FILTER (WHERE CLASS_FINAL IN {in_list(dict(P['hosp_profile']['classes'])['ftr_br'])}) AS total_ftr_br
FROM flagged WHERE IS_HOSPITAL = 1 AND FACID IS NOT NULL GROUP BY FACID
UNION ALL
SELECT 'LTC & NTC', FACID, count(PENALTY_NUMBER), CAST(NULL AS DOUBLE),
  CAST(count(*) FILTER (WHERE CLASS_FINAL IN {in_list(dict(P['ltc_profile']['classes'])['class_aa'])}) AS DOUBLE),
  count(*) FILTER (WHERE CLASS_FINAL IN {in_list(dict(P['ltc_profile']['classes'])['ftr_br'])})
FROM flagged WHERE IS_HOSPITAL = 0 AND FACID IS NOT NULL GROUP BY FACID"""

# ----------------------------------------------------------- flow reports

_TRANS = f"""
trans AS (
  SELECT CLASS_ASSESSED_INITIAL, CLASS_FINAL, count(*) AS count FROM mart
  WHERE CLASS_ASSESSED_INITIAL IS NOT NULL AND CLASS_FINAL IS NOT NULL
  GROUP BY 1, 2
  HAVING CLASS_ASSESSED_INITIAL <> CLASS_FINAL AND CLASS_ASSESSED_INITIAL IN {in_list(P['transition_start'])}
     AND count(*) >= {presets.TRANSITION_MIN_COUNT}
)"""

ORACLE["transitions"] = BASE_MART + "," + _TRANS + "\nSELECT * FROM trans"

_SEVERE = " OR ".join(f"contains(label, {ob.q(m)})" for m in P["severe_markers"])
_NODES = f"""
nodes0 AS (
  SELECT DISTINCT CLASS_ASSESSED_INITIAL || ' (Initial)' AS label, 0 AS side,
         CLASS_ASSESSED_INITIAL || ' (Initial)' AS o FROM trans
  UNION ALL
  SELECT CLASS_FINAL AS label, 1 AS side, min(CLASS_ASSESSED_INITIAL) AS o FROM trans GROUP BY CLASS_FINAL
),
nodes AS (
  SELECT CAST(row_number() OVER (ORDER BY side, o, label) - 1 AS BIGINT) AS id, label, CAST(side AS BIGINT) AS side,
    CASE WHEN {_SEVERE} THEN 'severe'
         WHEN contains(label, '(Initial)') THEN 'initial'
         WHEN label IN {in_list(P['reversed_outcomes'])} THEN 'removed'
         WHEN label = {ob.q(P['dropped_outcome'])} THEN 'dropped'
         ELSE 'other' END AS category
  FROM nodes0
)"""

ORACLE["flow_nodes"] = BASE_MART + "," + _TRANS + "," + _NODES + "\nSELECT * FROM nodes"

ORACLE["flow_edges"] = BASE_MART + "," + _TRANS + "," + _NODES + f"""
SELECT s.id AS source, t.id AS target, tr.count AS value,
  CASE WHEN tr.CLASS_FINAL IN {in_list(P['reversed_outcomes'])} THEN 'removed'
       WHEN tr.CLASS_FINAL = {ob.q(P['dropped_outcome'])} THEN 'dropped' ELSE 'other' END AS category
FROM trans tr
JOIN nodes s ON s.side = 0 AND s.label = tr.CLASS_ASSESSED_INITIAL || ' (Initial)'
JOIN nodes t ON t.side = 1 AND t.label = tr.CLASS_FINAL"""

# ------------------------------------------------------- model preparation

_feats = P["ltc_features"]
ORACLE["impute_scale"] = BASE_FLAGGED + fac_ctes(False) + """,
imp AS (SELECT FACID, """ + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM fac_l), 0.0) AS {c}" for c in _feats) + """ FROM fac_l),
st AS (SELECT """ + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _feats) + """ FROM imp)
SELECT FACID, """ + ", ".join(
    f"round(({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0 END, 6) AS {c}" for c in _feats) + " FROM imp, st"


# ------------------------------------------------------------------- text

_W = r"[\p{L}\p{N}_]"
_NW = r"[^\p{L}\p{N}_]"


def _clean_sql(e: str) -> str:
    x = f"coalesce({e}, '')"
    for pat in [r"F\p{Nd}{3,4}", r"T\p{Nd}{2}", r"DIV\p{Nd}+", r"CH\p{Nd}+", r"ART\p{Nd}+", r"\([^)]*\)"]:
        x = f"regexp_replace({x}, '{pat}', '', 'g')"
    for _ in range(2):  # stand-alone digit runs; two passes cover runs that share a separator
        x = f"regexp_replace({x}, '(^|{_NW})\\p{{Nd}}+({_NW}|$)', '\\1\\2', 'g')"
    x = f"regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_\\t\\n\\x0B\\f\\r\\x1C-\\x1F\\x{{85}}\\p{{Z}}]', ' ', 'g')"
    x = f"regexp_replace({x}, '\\n+', ' ', 'g')"
    x = f"regexp_replace({x}, '{ob.WS}+', ' ', 'g')"
    return f"lower({ob.utrim(x)})"


_NARR = f"""
raw_narr AS (
  SELECT CAST(doc_id AS VARCHAR) AS FACID,
    lower(source) || '''s ' || lang || ' 3rd st.' AS FACILITY_NAME,
    CAST(doc_id % 12 + 1 AS VARCHAR) || '/' || CAST(doc_id % 28 + 1 AS VARCHAR) || '/2020' AS PENALTY_ISSUE_DATE,
    'F' || CAST(1000 + doc_id % 9000 AS VARCHAR) || ' ART' || CAST(n_chars % 100 AS VARCHAR) || ' (ref ' || source
      || ') ' || 'DIV' || CAST(doc_id % 7 AS VARCHAR) || ' T' || lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') || ' '
      || text || ' CH' || CAST(doc_id % 50 AS VARCHAR) AS NARRATIVE
  FROM documents
),
narr AS (
  SELECT FACID, PENALTY_ISSUE_DATE,
    array_to_string(list_transform(regexp_extract_all(lower(FACILITY_NAME), '(\\p{{L}}+|\\P{{L}}+)'),
                                   lambda r: upper(r[1]) || r[2:]), '') AS FACILITY_NAME,
    {_clean_sql('NARRATIVE')} AS NARRATIVE_CLEAN
  FROM raw_narr
)"""


def _stop_list() -> str:
    from ..operators.keywords import default_stop_words
    return "[" + ", ".join(ob.q(w) for w in default_stop_words()) + "]"


_TERMS = f"""
tok AS (SELECT FACID, regexp_extract_all(lower(NARRATIVE_CLEAN), '[a-zA-Z]{{3,}}') AS t FROM narr),
uni AS (SELECT FACID, list_filter(t, lambda x: NOT list_contains({_stop_list()}, x)) AS u FROM tok),
terms AS (SELECT FACID, list_concat(u, list_transform(range(1, len(u)), lambda i: u[i] || ' ' || u[i + 1])) AS terms
          FROM uni),
tf AS (SELECT FACID, term, count(*) AS tf FROM (SELECT FACID, unnest(terms) AS term FROM terms) GROUP BY 1, 2),
vocab AS (SELECT term, sum(tf) AS total, count(FACID) AS df FROM tf GROUP BY 1 ORDER BY total DESC, term LIMIT 100),
wt AS (
  SELECT tf.FACID, tf.term, tf.tf,
    tf.tf * (ln((1.0 + (SELECT count(*) FROM narr)) / (1.0 + v.df)) + 1.0) AS w
  FROM tf JOIN vocab v ON tf.term = v.term
),
weights AS (SELECT FACID, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY FACID)) AS weight FROM wt)"""

_TEXT = ob.with_ctes(_NARR)
_TEXT_TERMS = ob.with_ctes(_NARR, _TERMS)

ORACLE["clean_text"] = _TEXT + "\nSELECT FACID, NARRATIVE_CLEAN FROM narr"
ORACLE["title_case"] = _TEXT + "\nSELECT FACID, FACILITY_NAME FROM narr"
ORACLE["term_counts"] = _TEXT_TERMS + "\nSELECT FACID, term, tf FROM tf"
ORACLE["vocabulary"] = _TEXT_TERMS + "\nSELECT term, CAST(total AS BIGINT) AS total, df FROM vocab"
ORACLE["tfidf"] = _TEXT_TERMS + "\nSELECT FACID, term, tf, round(weight, 6) AS weight FROM weights"
ORACLE["top_keywords"] = _TEXT_TERMS + """
SELECT n.FACID, coalesce(k.TOP_KEYWORDS, '') AS TOP_KEYWORDS
FROM narr n LEFT JOIN (
  SELECT FACID, string_agg(term, ', ' ORDER BY rn) AS TOP_KEYWORDS FROM (
    SELECT FACID, term, row_number() OVER (PARTITION BY FACID ORDER BY weight DESC, term DESC) AS rn
    FROM weights WHERE weight > 0) WHERE rn <= 3 GROUP BY FACID) k ON n.FACID = k.FACID"""

ORACLE["quoted_scan"] = _TEXT + """
SELECT FACID, FACILITY_NAME, PENALTY_ISSUE_DATE, length(t) AS n_chars, md5(t) AS narrative_md5
FROM (SELECT *, regexp_replace(NARRATIVE, '[^\\x{00}-\\x{FF}]', '?', 'g') AS t FROM raw_narr)"""
ORACLE["narrative_table"] = _TEXT_TERMS + """
SELECT n.FACID, n.FACILITY_NAME, n.FACID AS PENALTY_NUMBER, 'A' AS CLASS_ASSESSED_INITIAL, n.PENALTY_ISSUE_DATE,
  n.FACID AS EVENTID, coalesce(k.TOP_KEYWORDS, '') AS TOP_KEYWORDS
FROM narr n LEFT JOIN (
  SELECT FACID, string_agg(term, ', ' ORDER BY rn) AS TOP_KEYWORDS FROM (
    SELECT FACID, term, row_number() OVER (PARTITION BY FACID ORDER BY weight DESC, term DESC) AS rn
    FROM weights WHERE weight > 0) WHERE rn <= 3 GROUP BY FACID) k ON n.FACID = k.FACID"""

_REJECTS = """texts AS (
  SELECT CASE WHEN TOTAL_AMOUNT_INITIAL % 10 < 1 THEN '$' || TOTAL_AMOUNT_INITIAL END AS a,
         CASE WHEN TOTAL_AMOUNT_INITIAL % 10 < 2 THEN 'n/a' END AS b, PENALTY_ISSUE_DATE AS d, {issued} AS issued,
         VIOLATION_FROM_DATE AS v, {violated} AS violated
  FROM raw_enf)""".format(issued=ob.parse_ts("PENALTY_ISSUE_DATE"), violated=ob.parse_ts("VIOLATION_FROM_DATE"))
ORACLE["typed_scan"] = ob.with_ctes(ob.RAW_ENF, _REJECTS) + """
SELECT * FROM (
  SELECT 'TOTAL_AMOUNT_INITIAL' AS "column", count(a) AS rejected, count(DISTINCT a) AS texts FROM texts
  UNION ALL SELECT 'TOTAL_BALANCE_DUE', count(b), count(DISTINCT b) FROM texts
  UNION ALL SELECT 'PENALTY_ISSUE_DATE', count(d), count(DISTINCT d) FROM texts WHERE issued IS NULL AND trim(d) <> ''
  UNION ALL SELECT 'VIOLATION_FROM_DATE', count(v), count(DISTINCT v) FROM texts WHERE violated IS NULL AND trim(v) <> '')
WHERE rejected > 0"""

ORACLE["mart_proofs"] = BASE_MART + """,
types AS (SELECT VALUE, count(*) AS n FROM lk WHERE VARIABLE = 'FAC_TYPE_CODE' AND VALUE IS NOT NULL GROUP BY 1),
classes AS (SELECT DESCRIPTION, count(*) AS n FROM lk WHERE VARIABLE = 'Class_Assessed_Final' AND DESCRIPTION IS NOT NULL GROUP BY 1),
met AS (SELECT e.FAC_TYPE_CODE AS code, e.CLASS_ASSESSED_FINAL AS klass, t.n AS tn, c.n AS cn
        FROM enf e LEFT JOIN types t ON t.VALUE = e.FAC_TYPE_CODE LEFT JOIN classes c ON c.DESCRIPTION = e.CLASS_ASSESSED_FINAL)
SELECT count(*) AS fact_rows, CAST(sum(coalesce(tn, 1) * coalesce(cn, 1)) AS BIGINT) AS mart_rows,
  count(*) FILTER (code IS NULL) AS type_missing, count(*) FILTER (code IS NOT NULL AND tn IS NULL) AS type_unknown,
  count(*) FILTER (klass IS NULL) AS class_missing, count(*) FILTER (klass IS NOT NULL AND cn IS NULL) AS class_unknown,
  (SELECT count(*) FROM types WHERE n > 1) AS repeated_types, (SELECT count(*) FROM classes WHERE n > 1) AS repeated_classes
FROM met"""

_MEASURED = ["TOTAL_AMOUNT_INITIAL", "TOTAL_AMOUNT_DUE_FINAL", "TOTAL_BALANCE_DUE", "TOTAL_PENALTY_OFFSET_AMOUNT",
             "COMPLAINT_COUNT", "HIGHEST_PRIORITY"]
ORACLE["column_quantiles"] = BASE_MART + " UNION ALL ".join(
    f"\nSELECT '{c}' AS \"column\", CAST({q} AS DOUBLE) AS share, round(quantile_cont(CAST({c} AS DOUBLE), {q}), 6) AS value FROM mart"
    for c in _MEASURED for q in (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0))

ORACLE["stored_profile"] = ORACLE["profile_hosp"]
