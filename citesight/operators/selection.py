"""Quota allocation over strata and the per-stratum selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import quota


def allocate_quota(first: DataFrame, second: DataFrame, hit: Column, names: Sequence[str],
                   slots: int = 25) -> DataFrame:
    """Split ``slots`` between two strata in proportion to their hit counts.

    The first stratum gets ``max(1, round_half_even(slots * h1 / (h1 + h2)))``,
    the second the rest; unused slots are not moved.  Returns two rows
    ``(stratum, hits, quota)``.
    """
    h1 = F.lit(first.agg(F.count_if(hit).alias("h")).first()["h"]).cast("bigint")
    h2 = F.lit(second.agg(F.count_if(hit).alias("h")).first()["h"]).cast("bigint")
    q1 = quota(h1, h1 + h2, slots)
    one = first.sparkSession.range(1)
    return one.select(F.inline(F.array(
        F.struct(F.lit(names[0]).alias("stratum"), h1.alias("hits"), q1.alias("quota")),
        F.struct(F.lit(names[1]).alias("stratum"), h2.alias("hits"), (F.lit(slots) - q1).alias("quota")),
    )))


def top_k_strata(df: DataFrame, score: str, quotas: DataFrame, key: str,
                 stratum: str = "stratum", max_k: int | None = None) -> DataFrame:
    """The ``quota`` smallest scores of each stratum (ties by key).

    The literal ``rn <= max_k`` filter lets Spark insert a partial
    ``WindowGroupLimit`` before the exchange, so each map task ships at most
    ``max_k`` rows per stratum however large the stratum is; the data-dependent
    quota is applied afterwards through a two-row broadcast join.  The bound is
    the largest quota; a ``max_k`` below it is refused.
    """
    largest = quotas.agg(F.max("quota")).first()[0] or 0
    if max_k is not None and max_k < largest:
        raise ValueError(f"max_k {max_k} is below the quota {largest}")
    max_k = int(largest)
    w = Window.partitionBy(stratum).orderBy(F.col(score).asc_nulls_last(), F.col(key).asc())
    ranked = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_k)
    q = F.broadcast(quotas.select(F.col("stratum").alias("_q_stratum"), F.col("quota").alias("_quota")))
    return (ranked.join(q, ranked[stratum] == q["_q_stratum"], "inner")
            .where(F.col("_rn") <= F.col("_quota")).drop("_q_stratum", "_quota", "_rn"))


def union_strata(*dfs: DataFrame) -> DataFrame:
    """Union by column name; a column missing on one side becomes NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
