"""Joins: dimension look-ups, attaching one row per key, global statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only after a bounded scan has shown it is small.
DEFAULT_BROADCAST_ROWS = 100_000
DEFAULT_BROADCAST_BYTES = 16 << 20


def is_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
             max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes (of
    its rows as JSON: free text counts by its length).  Reading stops after
    ``max_rows + 1`` rows, so the check is cheap even on a large input."""
    width = F.octet_length(F.to_json(F.struct("*")))
    n, size = df.limit(max_rows + 1).select(width.alias("w")).agg(F.count(F.lit(1)), F.sum("w")).first()
    return n <= max_rows and (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint behind a size check.  A larger side is left to the
    planner (shuffle join, or AQE's own runtime broadcast decision)."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def lookup(df: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "left",
           max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Dictionary-style look-up join against a small table."""
    return df.join(broadcast_if_small(small, max_rows), on, how)


def value(df: DataFrame, expr: Column):
    """A global statistic of ``df`` computed now (one aggregate job, one
    value back) for use as a literal: unlike a scalar subquery referenced
    several times, it is evaluated exactly once."""
    return df.select(expr.alias("v")).first()["v"]


def scalar(df: DataFrame, expr: Column) -> Column:
    """A global statistic of ``df`` as a scalar subquery column.

    Spark runs the one-row aggregate once, folds it into the plan as a value
    and merges several such subqueries over the same input into one job; no
    join is needed to attach it to every row.
    """
    return df.select(expr).scalar()


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                  cols: Sequence[str]) -> DataFrame:
    """One row per key: the row that is smallest by ``order``, nulls last (ties
    broken by the remaining columns).  ``min_by`` aggregates partially on the map side,
    so a hot key never gathers its rows in one task."""
    keys = [key] if isinstance(key, str) else list(key)
    ordering = F.struct(*[x for i, c in enumerate([*order, *cols])
                          for x in (F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_v{i}"))])
    picked = F.min_by(F.struct(*[F.col(c) for c in cols]), ordering).alias("_first")
    return df.where(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(picked).select(*keys, "_first.*")


def attach_first(df: DataFrame, info: DataFrame, key: str, order: Sequence[str],
                 cols: Sequence[str]) -> DataFrame:
    """Left-join descriptive columns, one row per key, onto ``df``."""
    return df.join(first_per_key(info, key, order, cols), key, "left")


def enrich_mart(fact: DataFrame, dim_fac: DataFrame, dim_class: DataFrame,
                dims_small: bool | None = None) -> DataFrame:
    """The enriched mart: fact LEFT JOIN facility-type dim LEFT JOIN class dim.

    Both dims are tiny lookup tables, broadcast behind a size check (pass
    ``dims_small`` when the caller has already checked the lookup they come
    from).  Columns keep the original aliases, including ``CLASS_FINAL`` = the
    class dim's DESCRIPTION and ``DESCRIPTION`` = its VALUE.
    """
    def hint(d):
        if dims_small is None:
            return broadcast_if_small(d)
        return F.broadcast(d) if dims_small else d

    f = hint(dim_fac.select(
        F.col("VALUE").alias("_f_value"), F.col("DEFINITION").alias("_f_def"),
        F.col("IS_HOSPITAL").alias("_f_hosp"), F.col("IS_24HR").alias("_f_24"),
        F.col("IS_LOW_RESOURCE").alias("_f_low")))
    b = hint(dim_class.select(
        F.col("VALUE").alias("_b_value"), F.col("DESCRIPTION").alias("_b_desc")))
    a = fact
    j = (a.join(f, a["FAC_TYPE_CODE"] == f["_f_value"], "left")
         .join(b, a["CLASS_ASSESSED_FINAL"] == b["_b_desc"], "left"))
    return j.select(
        "EVENTID", "FACID", "FACILITY_NAME", "FAC_TYPE_CODE", "FAC_FDR", "DISTRICT_OFFICE",
        F.col("_f_def").alias("FACILITY_TYPE_DESC"),
        F.coalesce(F.col("_f_hosp"), F.lit(0)).cast("int").alias("IS_HOSPITAL"),
        F.coalesce(F.col("_f_24"), F.lit(0)).cast("int").alias("IS_24HR"),
        F.coalesce(F.col("_f_low"), F.lit(0)).cast("int").alias("IS_LOW_RESOURCE"),
        "PENALTY_NUMBER", "PENALTY_ISSUE_DATE", "PENALTY_TYPE", "PENALTY_CATEGORY", "DISPOSITION",
        "CLASS_ASSESSED_INITIAL",
        F.col("_b_desc").alias("CLASS_FINAL"),
        F.col("_b_value").alias("DESCRIPTION"),
        "DEATH_RELATED",
        F.col("APPEALED").cast("int").alias("APPEALED"),
        "TOTAL_AMOUNT_INITIAL", "TOTAL_AMOUNT_DUE_FINAL", "TOTAL_BALANCE_DUE",
        "TOTAL_PENALTY_OFFSET_AMOUNT", "HIGHEST_PRIORITY", "COMPLAINT_COUNT",
    )
