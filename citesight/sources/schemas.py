"""Declared schemas of the raw inputs (no type inference).

Raw exports hold text; dates and flags are parsed by the cleaning stage.
Money columns are exact decimals.  Column names are the normalised
(stripped, upper-case) header names.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D = T.StringType(), T.DecimalType(18, 2)


def _schema(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ENFORCEMENT = _schema([
    ("EVENTID", S), ("FACID", S), ("FACILITY_NAME", S), ("FAC_TYPE_CODE", S), ("FAC_FDR", S),
    ("DISTRICT_OFFICE", S), ("PENALTY_NUMBER", S), ("PENALTY_ISSUE_DATE", S), ("VIOLATION_FROM_DATE", S),
    ("PENALTY_TYPE", S), ("PENALTY_CATEGORY", S), ("PENALTY_DETAIL", S), ("DISPOSITION", S),
    ("CLASS_ASSESSED_INITIAL", S), ("CLASS_ASSESSED_FINAL", S), ("DEATH_RELATED", S), ("APPEALED", S),
    ("TOTAL_AMOUNT_INITIAL", D), ("TOTAL_AMOUNT_DUE_FINAL", D), ("TOTAL_BALANCE_DUE", D),
    ("TOTAL_PENALTY_OFFSET_AMOUNT", D), ("PRIORITY_ALL", S),
])

LOOKUP = _schema([("VARIABLE", S), ("VALUE", S), ("DESCRIPTION", S), ("DEFINITION", S)])

NARRATIVES = _schema([
    ("FACID", S), ("FACILITY_NAME", S), ("PENALTY_NUMBER", S), ("CLASS_ASSESSED_INITIAL", S),
    ("PENALTY_ISSUE_DATE", S), ("EVENTID", S), ("NARRATIVE", S),
])

I, TS = T.IntegerType(), T.TimestampNTZType()

#: Text columns that hold dates; the cleaning stage reads them.
ENFORCEMENT_DATES = ("PENALTY_ISSUE_DATE", "VIOLATION_FROM_DATE")

_CLEANED = {"PENALTY_ISSUE_DATE": TS, "VIOLATION_FROM_DATE": TS, "DEATH_RELATED": I, "APPEALED": I}
CLEAN_ENFORCEMENT = _schema([(f.name, _CLEANED.get(f.name, f.dataType)) for f in ENFORCEMENT.fields]
                            + [("HIGHEST_PRIORITY", I), ("COMPLAINT_COUNT", I)])

CLEAN_LOOKUP = _schema([(f.name, f.dataType) for f in LOOKUP.fields]
                       + [("IS_24HR", I), ("IS_HOSPITAL", I), ("IS_LOW_RESOURCE", I)])

#: The stored narratives: what identifies them, and their keywords.
STORED_NARRATIVES = _schema([(n, S) for n in ("FACID", "FACILITY_NAME", "PENALTY_NUMBER", "CLASS_ASSESSED_INITIAL",
                                              "PENALTY_ISSUE_DATE", "EVENTID", "TOP_KEYWORDS")])

#: The enriched mart (fixed names and order).  Those of the derived columns are
#: in ``MART_DERIVED``; all others are the cleaned penalty's own.
MART = _schema([
    ("EVENTID", S), ("FACID", S), ("FACILITY_NAME", S), ("FAC_TYPE_CODE", S), ("FAC_FDR", S), ("DISTRICT_OFFICE", S),
    ("FACILITY_TYPE_DESC", S), ("IS_HOSPITAL", I), ("IS_24HR", I), ("IS_LOW_RESOURCE", I),
    ("PENALTY_NUMBER", S), ("PENALTY_ISSUE_DATE", TS), ("PENALTY_TYPE", S), ("PENALTY_CATEGORY", S), ("DISPOSITION", S),
    ("CLASS_ASSESSED_INITIAL", S), ("CLASS_FINAL", S), ("DESCRIPTION", S), ("DEATH_RELATED", I), ("APPEALED", I),
    ("TOTAL_AMOUNT_INITIAL", D), ("TOTAL_AMOUNT_DUE_FINAL", D), ("TOTAL_BALANCE_DUE", D),
    ("TOTAL_PENALTY_OFFSET_AMOUNT", D), ("HIGHEST_PRIORITY", I), ("COMPLAINT_COUNT", I),
])
MART_DERIVED = ("FACILITY_TYPE_DESC", "IS_HOSPITAL", "IS_24HR", "IS_LOW_RESOURCE", "CLASS_FINAL", "DESCRIPTION")


def check_schema(df, schema: T.StructType):
    """``df`` with its columns in the order of ``schema``; a missing column, one
    too many or one of another type raises."""
    have, want = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (df.schema, schema))
    wrong = sorted(f"{n}: {have.get(n, 'missing')}, not {want.get(n, 'wanted')}" for n in {**have, **want} if have.get(n) != want.get(n))
    if wrong:
        raise ValueError("; ".join(wrong))
    return df.select(*schema.fieldNames())
