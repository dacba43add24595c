"""Projections, filters and flag columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_any


def standardize_columns(df: DataFrame) -> DataFrame:
    """Header normalisation: strip and upper-case every column name."""
    return df.toDF(*[c.strip().upper() for c in df.columns])


def drop_values(df: DataFrame, col: str, values: Iterable[str]) -> DataFrame:
    """Drop rows whose ``col`` equals one of ``values``; NULL rows are kept
    (a plain SQL ``NOT IN`` would drop them)."""
    c = F.col(col)
    return df.where(c.isNull() | ~c.isin(list(values)))


def keep_outcome(col: str, invalid: Iterable[str]) -> Column:
    """True unless the lower-cased outcome is one of ``invalid``; NULL is kept."""
    return ~F.lower(F.coalesce(F.col(col), F.lit(""))).isin([v.lower() for v in invalid])


def exclude_outcomes(df: DataFrame, col: str, invalid: Iterable[str]) -> DataFrame:
    """Case-insensitive NOT IN that keeps NULL outcomes."""
    return df.where(keep_outcome(col, invalid))


def filter_report(df: DataFrame, keep: Column) -> DataFrame:
    """One pass: rows before, dropped and kept by a (non-NULL) condition."""
    k = F.coalesce(keep, F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("rows_before"),
                  F.count_if(~k).alias("dropped"),
                  F.count_if(k).alias("remaining"))


def keyword_flags(df: DataFrame, col: str, flags: Mapping[str, Sequence[str]]) -> DataFrame:
    """One 0/1 column per flag: the lower-cased text contains any literal."""
    low = F.lower(F.coalesce(F.col(col), F.lit("")))
    return df.withColumns({name: has_any(low, pats) for name, pats in flags.items()})


def flag_where(df: DataFrame, mask: Column, flags: Mapping[str, tuple[bool, Sequence[str]]],
               source: str) -> DataFrame:
    """Masked assignment: flags are computed on rows where ``mask`` holds and
    are NULL on every other row.  Each flag is ``(case_sensitive, literals)``."""
    out = {}
    for name, (case_sensitive, pats) in flags.items():
        text = F.col(source) if case_sensitive else F.lower(F.col(source))
        out[name] = F.when(mask, has_any(text, pats))
    return df.withColumns(out)
