"""Aggregations and the summary tables built from them.

Every aggregate is one ``groupBy().agg()`` (partial aggregation on the map
side, one exchange on the group key).  NULL group keys are dropped, matching
the group-by semantics the reports were written against.  Global totals are
computed once (a small grouped result is checkpointed first) and attached as
literals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import round_half_even, safe_div
from .joins import value


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _not_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        e = F.col(k).isNotNull()
        cond = e if cond is None else cond & e
    return df.where(cond)


def group_size(df: DataFrame, keys: str | Sequence[str], name: str = "count") -> DataFrame:
    """Rows per group over one or more keys (NULL keys dropped)."""
    ks = _keys(keys)
    return _not_null(df, ks).groupBy(*ks).agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Counts per value, largest first (ties by value)."""
    return group_size(df, col, name).orderBy(F.desc(name), F.asc(col))


def value_share(df: DataFrame, col: str) -> DataFrame:
    """Counts per value with the share of all counted rows in percent."""
    from ..session import materialize
    counts = materialize(group_size(df, col))  # small; read twice below
    total = value(counts, F.sum("count"))
    return (counts.withColumn("percent", F.col("count") * F.lit(100.0) / F.lit(total))
            .orderBy(F.desc("count"), F.asc(col)))


def count_label(n, pct) -> Column:
    """``"n (p.p%)"`` with the percentage rounded half-even to 1 decimal."""
    return F.format_string("%d (%.1f%%)", n, round_half_even(pct, 1))


def value_share_within(df: DataFrame, by: str, col: str, values: Sequence | None = None,
                       order: str = "key") -> DataFrame:
    """Value counts of ``col`` inside each ``by`` group (optionally only the
    listed ``by`` values) with percent-of-group and a text label.

    One ``groupBy(by, col)`` replaces a filter-and-count loop per group; the
    group total is a window sum over the small grouped result.
    """
    src = df.where(F.col(by).isin(list(values))) if values is not None else df
    counts = group_size(src, [by, col])
    w = Window.partitionBy(by)
    out = (counts.withColumn("percent", F.col("count") * F.lit(100.0) / F.sum("count").over(w))
           .withColumn("label", count_label(F.col("count"), F.col("percent"))))
    if order == "count":
        return out.orderBy(by, "count", col)
    return out.orderBy(by, col)


def crosstab(df: DataFrame, row: str, col: str, values: Sequence | None = None) -> DataFrame:
    """Counts of ``row`` x ``col``; missing cells are 0.  ``df`` is read once:
    the grouped counts are stored, and give the columns unless ``values`` does."""
    from ..session import materialize
    counts = materialize(group_size(df, [row, col]))
    if values is None:
        values = [r[0] for r in counts.select(col).distinct().orderBy(col).collect()]
    return counts.groupBy(row).pivot(col, list(values)).agg(F.sum("count")).na.fill(0)


def crosstab_share(df: DataFrame, row: str, col: str, values: Sequence | None = None, top: int = 20) -> DataFrame:
    """Column-normalised cross-tab in percent, limited to the ``top`` rows by
    row total of the percentages (ties by row key), in that order.  Without
    ``values`` the columns are the values found in the grouped counts.

    Stays in long form until the very end: counts -> percent within column
    (window over the grouped counts) -> row totals -> top rows (a bounded
    ``limit``, broadcast back) -> pivot over the given column values.
    """
    from ..session import materialize
    counts = materialize(group_size(df, [row, col]))  # small; read twice below
    pct = counts.withColumn(
        "pct", F.col("count") * F.lit(100.0) / F.sum("count").over(Window.partitionBy(col)))
    top_rows = (pct.groupBy(row).agg(F.sum("pct").alias("_total"))
                .orderBy(F.desc("_total"), F.asc(row)).limit(top))
    if values is None:
        values = [r[0] for r in counts.select(col).distinct().orderBy(col).collect()]
    kept = pct.join(F.broadcast(top_rows), row, "inner")
    wide = kept.groupBy(row, "_total").pivot(col, list(values)).agg(F.first("pct")).na.fill(0.0)
    return wide.orderBy(F.desc("_total"), F.asc(row)).drop("_total")


def table_report(df: DataFrame, key: str, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Row count and distinct-key count of a table (exact, or HyperLogLog++
    with relative error ``rsd`` when ``approx``)."""
    distinct = (F.approx_count_distinct(F.col(key), rsd) if approx else F.count_distinct(F.col(key)))
    return df.agg(F.count(F.lit(1)).alias("row_count"), distinct.alias("distinct_keys"))


def district_stats(df: DataFrame, district: str, serious: Sequence[str],
                   number: str = "PENALTY_NUMBER", klass: str = "CLASS_FINAL",
                   death: str = "DEATH_RELATED", balance: str = "TOTAL_BALANCE_DUE") -> DataFrame:
    """Per district: penalties, serious citations, deaths, balance due."""
    return (_not_null(df, [district]).groupBy(district).agg(
        F.count(F.col(number)).alias("total_actions"),
        F.count_if(F.col(klass).isin(list(serious))).alias("serious_citations"),
        F.coalesce(F.sum(death), F.lit(0)).cast("bigint").alias("death_related"),
        F.coalesce(F.sum(balance), F.lit(0)).alias("total_balance")))


def log_histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Histogram of log10(x) over positive x with ``bins`` equal-width bins
    between the smallest and the largest value (the top edge closes the
    last bin).  Only non-empty bins are returned."""
    from ..session import materialize
    x = materialize(df.where(F.col(col) > 0).select(F.log10(F.col(col).cast("double")).alias("x")))  # read twice
    ext = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    lo, hi = F.lit(ext["lo"]).cast("double"), F.lit(ext["hi"]).cast("double")
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(width > 0, F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1))).otherwise(0)
    return (x.select(b.cast("int").alias("bin"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
            .select("bin", (lo + F.col("bin") * width).alias("bin_lo"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_hi"), "count"))


def counts_per_year(df: DataFrame, date_col: str, year_name: str = "Year",
                    count_name: str = "Violation_Count") -> DataFrame:
    """Rows per calendar year of a date (rows without a date dropped).

    Rows without a date are dropped as the one group that counts no year: a filter on
    the date would be pushed down to the scan, and the date would be made from its
    text there and once more after the joins."""
    return (df.groupBy(F.year(date_col).alias(year_name))
            .agg(F.count(F.year(date_col)).alias(count_name))
            .where(F.col(count_name) > 0).orderBy(year_name))


def rate_by_group(df: DataFrame, key: str, cond: Column, total_name: str = "total",
                  hit_name: str = "appealed", rate_name: str = "appeal_rate") -> DataFrame:
    """Rows and condition hits per group in one conditional aggregate (a group
    without hits gets 0), the rate in percent and a ``"n (p%)"`` label."""
    g = _not_null(df, [key]).groupBy(key).agg(
        F.count(F.lit(1)).alias(total_name),
        F.count_if(F.coalesce(cond, F.lit(False))).alias(hit_name))
    rate = F.col(hit_name) * F.lit(100.0) / F.col(total_name)
    return (g.withColumn(rate_name, rate)
            .withColumn("label", count_label(F.col(hit_name), F.col(rate_name))))
