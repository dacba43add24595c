"""Facility profiles: grouped counts, rates, credibility smoothing, scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import safe_div


def profile_columns(preset: Mapping) -> list[str]:
    """The count columns a profile preset produces (the inputs of rates)."""
    return ([f"total_{f}" for f in preset["flags"]]
            + [f"total_{n}" for n, _ in preset["classes"]] + ["total_deaths"])


def _bare_aggs(preset: Mapping, number: str, klass: str, date: str) -> list:
    return ([F.count(F.col(number)),
             F.coalesce(F.sum("DEATH_RELATED"), F.lit(0)).cast("bigint"),
             F.coalesce(F.sum("APPEALED"), F.lit(0)).cast("bigint"),
             F.coalesce(F.sum("TOTAL_BALANCE_DUE"), F.lit(0)),
             F.coalesce(F.sum("COMPLAINT_COUNT"), F.lit(0)).cast("bigint")]
            + [F.coalesce(F.sum(f"is_{f}"), F.lit(0)).cast("bigint") for f in preset["flags"]]
            + [F.count_if(F.col(klass).isin(list(v))) for _, v in preset["classes"]]
            + [F.max(date)])


def profile_names(preset: Mapping) -> list[str]:
    """Output columns of a profile, in order."""
    return (["total_penalties", "total_deaths", "total_appealed", "total_balance_due", "total_complaints"]
            + [f"total_{f}" for f in preset["flags"]] + [f"total_{n}" for n, _ in preset["classes"]]
            + ["last_penalty_date"])


def profile_aggs(preset: Mapping, prefix: str = "", number: str = "PENALTY_NUMBER",
                 klass: str = "CLASS_FINAL", date: str = "PENALTY_ISSUE_DATE") -> list:
    """The preset's named aggregates: penalty count, sums of deaths, appeals,
    balance and complaints, one sum per keyword flag, one conditional count
    per class list, and the latest date."""
    return [e.alias(prefix + n) for e, n in zip(_bare_aggs(preset, number, klass, date), profile_names(preset))]


def facility_profile(df: DataFrame, preset: Mapping, key: str = "FACID") -> DataFrame:
    """One row per facility with the preset's named aggregates.

    A single ``groupBy(key).agg`` of counts, sums and conditional counts: Spark
    aggregates partially before the exchange, so a facility with a third of
    all rows still sends one partial row per map task.
    Sums of all-NULL inputs are 0; the latest date is NULL when no date.
    """
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*profile_aggs(preset))


def strata_profiles(df: DataFrame, first: Mapping, second: Mapping, stratum: str = "IS_HOSPITAL",
                    values=(1, 0), key: str = "FACID") -> DataFrame:
    """Both strata's facility profiles from one ``groupBy(stratum, key)`` pass
    over the penalty rows (instead of one pass per stratum).  Each group lies
    in one stratum; both presets' aggregates are computed, prefixed ``a__`` /
    ``b__``, and ``split_strata`` keeps each stratum's own set."""
    return (df.where(F.col(key).isNotNull() & F.col(stratum).isin(*values))
            .groupBy(stratum, key).agg(*profile_aggs(first, "a__"), *profile_aggs(second, "b__")))


def split_strata(grouped: DataFrame, first: Mapping, second: Mapping, stratum: str = "IS_HOSPITAL",
                 values=(1, 0), key: str = "FACID") -> tuple[DataFrame, DataFrame]:
    """The two per-stratum profiles out of ``strata_profiles``' result."""
    a = grouped.where(F.col(stratum) == values[0]).select(
        key, *[F.col("a__" + n).alias(n) for n in profile_names(first)])
    b = grouped.where(F.col(stratum) == values[1]).select(
        key, *[F.col("b__" + n).alias(n) for n in profile_names(second)])
    return a, b


def rate_name(count_col: str) -> str:
    return count_col.replace("total_", "") + "_rate"


def add_rates(df: DataFrame, count_cols: Sequence[str], total: str = "total_penalties") -> DataFrame:
    """Per-penalty rates (count / total, NULL when total is 0), plus appeal
    rate, log1p(complaints) / total and balance per penalty."""
    cols = {rate_name(c): safe_div(F.col(c), F.col(total)) for c in count_cols}
    cols["appeal_rate"] = safe_div(F.col("total_appealed"), F.col(total))
    cols["complaint_rate_log"] = safe_div(F.log1p(F.col("total_complaints").cast("double")), F.col(total))
    cols["balance_per_penalty"] = safe_div(F.col("total_balance_due").cast("double"), F.col(total))
    return df.withColumns(cols)


def eb_smooth(df: DataFrame, rates: Sequence[str], n: str = "total_penalties", k: float = 5.0) -> DataFrame:
    """Credibility (empirical-Bayes) smoothing toward the mean rate.

    ``r_eb = w * r + (1 - w) * mean``, ``w = n / (n + k)``, where ``mean`` is the
    unweighted mean of ``r`` over rows with ``n > 0``.  All means come from one
    aggregate whose single row is attached as literals (fit, then transform).
    """
    present = [r for r in rates if r in df.columns]
    means = df.where(F.col(n) > 0).agg(*[F.avg(r).alias(r) for r in present]).first()
    w = F.col(n).cast("double") / (F.col(n).cast("double") + F.lit(float(k)))
    return df.withColumns({
        f"{r}_eb": w * F.col(r) + (F.lit(1.0) - w) * F.lit(means[r]).cast("double") for r in present})


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace NULLs by the column's exact median; an all-NULL column
    becomes 0.  One pass finds the columns that hold NULLs; their medians are
    found together, in a few jobs however many columns there are."""
    from .quantiles import exact_quantiles
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    return fill_medians(df, exact_quantiles(df, {c: [0.5] for c in cols if nulls[c]}))


def fill_medians(df: DataFrame, medians: Mapping[str, Sequence[float | None]]) -> DataFrame:
    """Replace NULLs by the given medians (None: 0)."""
    fill = {c: 0.0 if m is None else m for c, (m,) in medians.items()}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in fill.items()})


def standard_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / population std; a constant column is divided by 1.
    The statistics are one aggregate row (fit), applied as literals."""
    st = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    out = {}
    for c in cols:
        m = st[f"m_{c}"]
        s = st[f"s_{c}"]
        scale = s if (s is not None and s > 0) else 1.0
        out[c] = (F.col(c).cast("double") - F.lit(m if m is not None else 0.0)) / F.lit(float(scale))
    return df.withColumns(out)


def impute_and_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``standard_scale(impute_median(df))`` with fewer passes: one aggregate
    gives NULL counts, means and standard deviations; only when a column has
    NULLs are its median and its statistics after filling computed again, for
    all such columns together."""
    from .quantiles import exact_quantiles
    aggs = []
    for c in cols:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"n_{c}"), F.avg(c).alias(f"m_{c}"),
                 F.stddev_pop(c).alias(f"s_{c}")]
    st = df.agg(*aggs).first().asDict()
    with_nulls = [c for c in cols if st[f"n_{c}"]]
    if with_nulls:
        df = fill_medians(df, exact_quantiles(df, {c: [0.5] for c in with_nulls}))
        st2 = df.agg(*[F.avg(c).alias(f"m_{c}") for c in with_nulls],
                     *[F.stddev_pop(c).alias(f"s_{c}") for c in with_nulls]).first().asDict()
        st.update(st2)
    out = {}
    for c in cols:
        m, s = st[f"m_{c}"], st[f"s_{c}"]
        scale = s if (s is not None and s > 0) else 1.0
        out[c] = (F.col(c).cast("double") - F.lit(m if m is not None else 0.0)) / F.lit(float(scale))
    return df.withColumns(out)
