"""SQL text of the stand-in tables for the DuckDB oracle.

The oracle is written independently of the Spark operators: plain SQL over
the driver's tables, mirroring the stand-in rules of
``citesight.sources.standin`` and the cleaning rules of the pipelines.
DuckDB's ``\\s`` is ASCII-only, so Unicode whitespace is spelled out.
"""

from __future__ import annotations

from .. import presets
from ..sources import schemas

# Unicode whitespace for RE2: tab..CR, NEL, and every separator (space, NBSP, ...).
WS = r"[\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]"


def utrim(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


_DATE_FORMATS = ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%m/%d/%Y", "%Y%m%d", "%Y/%m/%d", "%d %B %Y", "%m/%d/%Y %I:%M %p")


def parse_ts(e: str) -> str:
    return "coalesce(" + ", ".join(f"try_strptime({e}, '{f}')" for f in _DATE_FORMATS) + ")"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_recode(e: str, mapping: dict, keep: bool = True) -> str:
    whens = " ".join(f"WHEN {e} = {q(k)} THEN {q(v) if isinstance(v, str) else v}" for k, v in mapping.items())
    return f"(CASE {whens} ELSE {e if keep else 'NULL'} END)"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def like_any(e: str, literals) -> str:
    return "(" + " OR ".join(f"contains({e}, {q(x)})" for x in literals) + ")"


ln = "l.l_linenumber"
CODE = "substr('ABCDE', CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER), 1)"
PNUM = "CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR)"
FAC = "CAST(o.o_custkey AS VARCHAR)"

RAW_ENF = f"""
raw_enf AS (
  SELECT
    CAST(l.l_orderkey AS VARCHAR) AS EVENTID,
    CASE WHEN {ln} = 5 THEN ' ' || {FAC} || ' ' ELSE {FAC} END AS FACID,
    c.c_name AS FACILITY_NAME,
    CASE WHEN {ln} = 1 THEN ' ' || lower(c.c_mktsegment) || chr(9)
         WHEN {ln} = 2 THEN c.c_mktsegment || chr(160)
         ELSE c.c_mktsegment END AS FAC_TYPE_CODE,
    CAST(c.c_nationkey AS VARCHAR) AS FAC_FDR,
    n.n_name AS DISTRICT_OFFICE,
    CASE WHEN {ln} = 3 THEN {PNUM} || ' ' ELSE {PNUM} END AS PENALTY_NUMBER,
    CASE WHEN {ln} = 7 THEN '31/31/2020' WHEN {ln} = 3 THEN strftime(l.l_shipdate, '%Y%m%d')
         WHEN {ln} = 4 THEN strftime(l.l_shipdate, '%Y/%m/%d') WHEN {ln} = 5 THEN strftime(l.l_shipdate, '%-d %B %Y')
         WHEN {ln} = 6 THEN strftime(l.l_shipdate, '%-m/%-d/%Y') || ' 1:30 PM' ELSE strftime(l.l_shipdate, '%Y-%m-%d') END AS PENALTY_ISSUE_DATE,
    strftime(o.o_orderdate, '%m/%d/%Y') AS VIOLATION_FROM_DATE,
    o.o_orderpriority AS PENALTY_TYPE,
    p.p_name AS PENALTY_CATEGORY,
    CASE WHEN {ln} = 4 THEN ' ' || p.p_type || chr(9) || chr(9) ELSE p.p_type END AS PENALTY_DETAIL,
    l.l_linestatus AS DISPOSITION,
    CASE WHEN {ln} = 4 THEN l.l_returnflag || chr(9)
         WHEN {ln} = 6 THEN ' ' || l.l_returnflag ELSE l.l_returnflag END AS CLASS_ASSESSED_INITIAL,
    CASE WHEN {ln} = 2 THEN o.o_orderstatus || chr(9) ELSE o.o_orderstatus END AS CLASS_ASSESSED_FINAL,
    CASE WHEN l.l_returnflag = 'R' THEN (CASE WHEN {ln} = 5 THEN 'y' ELSE 'Y' END)
         WHEN l.l_returnflag = 'A' THEN 'N' END AS DEATH_RELATED,
    CASE WHEN {ln} = 6 AND l.l_returnflag = 'N' THEN NULL
         WHEN l.l_linestatus = 'F' THEN 'Yes' ELSE 'No' END AS APPEALED,
    CAST(l.l_extendedprice AS DECIMAL(18,2)) AS TOTAL_AMOUNT_INITIAL,
    CAST(l.l_extendedprice AS DECIMAL(18,2)) AS TOTAL_AMOUNT_DUE_FINAL,
    CASE WHEN {ln} = 3 THEN NULL ELSE CAST(l.l_extendedprice AS DECIMAL(18,2)) END AS TOTAL_BALANCE_DUE,
    CAST(c.c_acctbal AS DECIMAL(18,2)) AS TOTAL_PENALTY_OFFSET_AMOUNT,
    CASE WHEN {ln} = 7 THEN NULL
         WHEN {ln} = 6 THEN l.l_returnflag || ',,' || {CODE}
         ELSE {CODE} || ', ' || l.l_returnflag END AS PRIORITY_ALL
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

_P = presets.STANDIN
_TOKS = in_list(presets.PRIORITY_TOKENS)

ENF = f"""
enf1 AS (
  SELECT *,
    {case_recode(f"replace({utrim(f"replace({utrim('CLASS_ASSESSED_FINAL')}, chr(9), '')")}, chr(9), '')",
                 _P['class_final_recode'])} AS caf,
    replace({utrim('CLASS_ASSESSED_INITIAL')}, chr(9), '') AS cai,
    list_min(list_filter(list_transform(string_split(PRIORITY_ALL, ','), lambda t: {utrim('t')}),
                         lambda t: t IN {_TOKS})) AS hp
  FROM raw_enf
),
enf AS (
  SELECT
    EVENTID,
    {utrim('FACID')} AS FACID,
    FACILITY_NAME,
    upper({utrim('FAC_TYPE_CODE')}) AS FAC_TYPE_CODE,
    FAC_FDR,
    DISTRICT_OFFICE,
    {utrim('PENALTY_NUMBER')} AS PENALTY_NUMBER,
    {parse_ts('PENALTY_ISSUE_DATE')} AS PENALTY_ISSUE_DATE,
    {parse_ts('VIOLATION_FROM_DATE')} AS VIOLATION_FROM_DATE,
    PENALTY_TYPE,
    PENALTY_CATEGORY,
    {case_recode(f"regexp_replace({utrim('PENALTY_DETAIL')}, '{WS}+', ' ', 'g')", _P['detail_recode'])} AS PENALTY_DETAIL,
    DISPOSITION,
    cai AS CLASS_ASSESSED_INITIAL,
    CASE WHEN APPEALED = 'No' THEN cai ELSE caf END AS CLASS_ASSESSED_FINAL,
    CASE coalesce(DEATH_RELATED, 'N') WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS DEATH_RELATED,
    CASE APPEALED WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS APPEALED,
    TOTAL_AMOUNT_INITIAL, TOTAL_AMOUNT_DUE_FINAL, TOTAL_BALANCE_DUE, TOTAL_PENALTY_OFFSET_AMOUNT,
    PRIORITY_ALL,
    CASE hp WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 WHEN 'D' THEN 4 END AS HIGHEST_PRIORITY,
    CASE WHEN PRIORITY_ALL IS NULL THEN 0 ELSE len(string_split(PRIORITY_ALL, ',')) END AS COMPLAINT_COUNT
  FROM enf1
)"""

_DEFS = ", ".join(f"({q(k)}, {q(v)})" for k, v in presets.STANDIN_SEGMENT_DEFINITIONS.items())
_CLS = ", ".join(f"({q(d)})" for d in presets.STANDIN_CLASS_DESCRIPTIONS)

RAW_LOOKUP = f"""
raw_lookup AS (
  SELECT 'FAC_TYPE_CODE' AS VARIABLE, ' ' || s.seg || chr(9) AS VALUE,
         upper(s.seg[1]) || lower(s.seg[2:]) AS DESCRIPTION, d.def AS DEFINITION
  FROM (SELECT DISTINCT c_mktsegment AS seg FROM customer) s
  JOIN (VALUES {_DEFS}) d(seg2, def) ON s.seg = d.seg2
  UNION ALL
  SELECT 'Class_Assessed_Final', 'C_' || x, x, NULL FROM (VALUES {_CLS}) t(x)
  UNION ALL
  SELECT * FROM (VALUES ('VARIABLE', 'VALUE', 'DESCRIPTION', 'DEFINITION'),
                        ('VARIABLE  ', 'VALUE', 'DESCRIPTION', 'DEFINITION'),
                        (NULL, 'NULLVAR', 'no variable', 'kept: a NULL variable is not a header')) h(a, b, c, d)
)"""


def _lk_flag(name):
    case_sensitive, lits = presets.LOOKUP_FLAGS[name]
    text = "DEFINITION" if case_sensitive else "lower(DEFINITION)"
    return (f"CASE WHEN VARIABLE = 'FAC_TYPE_CODE' THEN CAST(coalesce({like_any(text, lits)}, false) AS INTEGER) END")


LOOKUP = f"""
lk AS (
  SELECT VARIABLE, {utrim('VALUE')} AS VALUE, DESCRIPTION, DEFINITION,
    {_lk_flag('IS_24HR')} AS IS_24HR,
    {_lk_flag('IS_HOSPITAL')} AS IS_HOSPITAL,
    {_lk_flag('IS_LOW_RESOURCE')} AS IS_LOW_RESOURCE
  FROM raw_lookup
  WHERE VARIABLE IS NULL OR VARIABLE NOT IN {in_list(presets.LOOKUP_HEADER_VALUES)}
)"""

#: What the lookup adds to a penalty, and types that the mart fixes; every
#: other column of the mart's schema is the cleaned penalty's own.
_ADDED = {
    "FACILITY_TYPE_DESC": "kind.DEFINITION", "CLASS_FINAL": "class_row.DESCRIPTION", "DESCRIPTION": "class_row.VALUE",
    **{flag: f"CAST(coalesce(kind.{flag}, 0) AS INTEGER)" for flag in presets.LOOKUP_FLAGS},
    "APPEALED": "CAST(penalty.APPEALED AS INTEGER)",
}
_MART_COLUMNS = ", ".join(f"{_ADDED.get(c, 'penalty.' + c)} AS {c}" for c in schemas.MART.fieldNames())
_KIND, _CLASS = (f"(SELECT * FROM lk WHERE {column} = {q(v)})" for column, v in (presets.LOOKUP_FLAG_ROW, presets.LOOKUP_CLASS_ROW))

MART = f"""
mart AS (
  SELECT {_MART_COLUMNS}
  FROM enf penalty
  LEFT JOIN {_KIND} kind ON kind.VALUE = penalty.FAC_TYPE_CODE
  LEFT JOIN {_CLASS} class_row ON class_row.DESCRIPTION = penalty.CLASS_ASSESSED_FINAL
)"""


def _flag_sql(name):
    return f"CAST({like_any('cat', _P['flags'][name])} AS INTEGER) AS {name}"


FLAGGED = f"""
valid AS (
  SELECT * FROM mart WHERE lower(coalesce(CLASS_FINAL, '')) NOT IN {in_list([v.lower() for v in _P['invalid_outcomes']])}
),
flagged AS (
  SELECT *, {", ".join(_flag_sql(n) for n in _P['flags'])}
  FROM (SELECT *, lower(coalesce(PENALTY_CATEGORY, '')) AS cat FROM valid)
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


BASE_MART = with_ctes(RAW_ENF, ENF, RAW_LOOKUP, LOOKUP, MART)
BASE_FLAGGED = with_ctes(RAW_ENF, ENF, RAW_LOOKUP, LOOKUP, MART, FLAGGED)
