"""Window operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def share_within(df: DataFrame, by: str | Sequence[str], value: str = "count",
                 name: str = "percent") -> DataFrame:
    """``value`` as a percentage of its ``by`` group's total."""
    keys = [by] if isinstance(by, str) else list(by)
    return df.withColumn(name, F.col(value) * F.lit(100.0) / F.sum(value).over(Window.partitionBy(*keys)))


def with_rank(df: DataFrame, order: Sequence, name: str = "rank") -> DataFrame:
    """1-based position after a total sort.

    Only for small, bounded inputs (the final inspection list): a window with
    no partition key runs in one task.
    """
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def event_gaps(df: DataFrame, key: str, event: str, date: str, partitions: int | None = None) -> DataFrame:
    """Whole days that passed from a facility's previous event to each event.

    The event date is the first date seen for the (facility, event) pair; the
    gap is NULL for a facility's first event.  Ties on date are ordered by the
    event id so the result is deterministic.

    Skew-safe: instead of a window partitioned by facility (one task per
    facility, however many events it has), the (facility, event) rows are
    range-partitioned on (facility, date, event), so a very large facility is
    split across tasks.  The previous row is found inside each range
    partition, and the first row of a partition takes the last row of the
    partition before it (a table of at most ``partitions`` rows).  The range
    assignment is checkpointed so that both uses see the same partitions.
    """
    from ..session import materialize
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = (df.where(F.col(key).isNotNull() & F.col(event).isNotNull())
             .groupBy(key, event).agg(F.min(date).alias("event_date")))
    order = [F.col(key).asc(), F.col("event_date").asc_nulls_first(), F.col(event).asc()]
    ranged = materialize(first.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy("_pid", key).orderBy(*order[1:])
    local = (ranged.withColumn("_prev", F.lag("event_date").over(w))
             .withColumn("_rn", F.row_number().over(w)))
    row = F.struct(F.col(key).alias("k"), F.col("event_date").alias("d"), F.col(event).alias("e"))
    last = ranged.groupBy("_pid").agg(F.max_by(row, row).alias("_last"))
    # carry-in: the last row of the nearest earlier non-empty partition
    carry = (last.withColumn("_carry", F.lag("_last").over(Window.orderBy("_pid")))
             .select(F.col("_pid").alias("_cpid"), "_carry"))
    joined = local.join(F.broadcast(carry), local["_pid"] == carry["_cpid"], "left")
    from_carry = F.when(F.col("_carry.k") == F.col(key), F.col("_carry.d"))
    prev = F.when(F.col("_rn") == 1, from_carry).otherwise(F.col("_prev"))
    passed = F.col("event_date").cast("timestamp_ntz") - prev.cast("timestamp_ntz")
    return joined.select(key, event, "event_date", F.extract(F.lit("DAY"), passed).cast("int").alias("days_to_prev"))


def gap_summary(gaps: DataFrame, by: str | None = None) -> DataFrame:
    """Mean and median gap overall, or per group ``by``.  Gaps are whole days,
    so a median's buffer holds one entry per distinct number of days."""
    g = gaps.where(F.col("days_to_prev").isNotNull())
    aggs = [F.count(F.lit(1)).alias("n_gaps"),
            F.avg("days_to_prev").alias("mean_days"),
            F.median("days_to_prev").alias("median_days")]
    if by is None:
        return g.agg(*aggs)
    return g.where(F.col(by).isNotNull()).groupBy(by).agg(*aggs)


def gap_report(df: DataFrame, key: str, event: str, date: str, group: str) -> tuple[DataFrame, DataFrame]:
    """``(overall, by_group)`` gap summaries; a facility with rows in several
    groups counts in each.  ``df`` is read twice: pass a stored table."""
    gaps = event_gaps(df, key, event, date)
    groups = df.select(key, group).distinct()
    return gap_summary(gaps), gap_summary(gaps.join(groups, key, "left"), group)
