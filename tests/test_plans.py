"""Physical-plan checks and the stand-in pipeline end to end."""

import os
import re

from pyspark.sql import functions as F

from citesight import presets
from citesight.operators import reports
from citesight.operators.joins import is_small
from citesight.plans import pipelines as pl
from citesight.plans.catalog import QUERIES
from citesight.sources import standin
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mart_uses_two_broadcast_dim_joins(spark):
    mart = pl.standin_mart(spark, SF_SMALL)
    plan = mart._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2
    assert "LeftOuter" in plan


def test_top_k_uses_window_group_limit(spark):
    df = QUERIES["top_k_strata"](spark, SF_SMALL)
    df.collect()
    assert "WindowGroupLimit" in _plan(df)


def test_profile_pushes_projection_to_scan(spark):
    df = QUERIES["profile_ltc"](spark, SF_SMALL)
    read = re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().sparkPlan().toString())
    lineitem = [r for r in read if "l_orderkey" in r]
    assert len(lineitem) == 1
    for unused in ("l_tax", "l_shipmode", "l_receiptdate"):
        assert unused not in lineitem[0]


def test_hot_part_key_is_split(spark, tmp_path):
    """A part with a third of all line items: the skew join deals its rows out
    to several tasks."""
    for name in ("region", "nation", "customer", "supplier", "part", "orders"):
        os.symlink(f"{SF_SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    hot = F.when(F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == 0, F.lit(1).cast("bigint"))
    (li.withColumn("l_partkey", F.coalesce(hot, F.col("l_partkey"))).repartition(8)
     .write.parquet(str(tmp_path / "lineitem.parquet")))
    small = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.openCostInBytes": "0",
             "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        df = standin.raw_enforcement(spark, str(tmp_path))
        assert df.count() == li.count()
        df.collect()
        assert "skew=true" in _plan(df)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_broadcast_is_bounded_in_rows_and_bytes(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    assert is_small(wide, 100, 200_000) and is_small(wide.where("id < 0"))
    assert not is_small(wide, 99, 200_000) and not is_small(wide, 100, 90_000)


def test_map_points_have_coordinates(spark):
    coords = reports.district_coordinates(spark, presets.DISTRICT_COORDS)
    assert coords.count() == 21
    rows = [("Fresno", "1", "A", 1, 2.0), ("Fresno", "2", "B", 0, 1.0), ("Elsewhere", "3", "A", 0, 1.0)]
    mart = spark.createDataFrame(rows, "DISTRICT_OFFICE string, PENALTY_NUMBER string, CLASS_FINAL string, "
                                       "DEATH_RELATED int, TOTAL_BALANCE_DUE double")
    every = reports.district_map(mart, coords, "DISTRICT_OFFICE", ["A"])
    got = reports.map_points(every).collect()
    assert [(r.DISTRICT_OFFICE, r.lat, r.lon) for r in got] == [("Fresno", 36.7378, -119.7871)]
    assert got[0].citation_share_pct == 66.7 and every.count() == 2  # shares over all districts


def test_pipeline_inspection_list(spark):
    mart = pl.standin_mart(spark, SF_SMALL)
    scored = pl.score_facilities(mart, presets.STANDIN, n_trees=50)
    sel = pl.inspection_list(mart, scored).collect()
    assert 0 < len(sel) <= presets.INSPECTION_SLOTS
    assert sorted(r["rank"] for r in sel) == list(range(1, len(sel) + 1))
    assert len({r.FACID for r in sel}) == len(sel)
    assert all(r.FACILITY_NAME is not None for r in sel)
    hs, _, _ = scored[presets.STRATUM_HOSPITAL]
    ls, _, _ = scored[presets.STRATUM_LTC]
    from citesight.operators.selection import allocate_quota
    q = allocate_quota(hs, ls, F.col("is_anomaly") == -1, ["H", "L"], 25).collect()
    assert sum(r.quota for r in q) == 25


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert len(df.collect()) <= 25
    assert set(e.oracle_sql()) <= set(e.queries())


def test_no_unpartitioned_window_over_rows(spark):
    for key in ["share_within", "complaints_by_type", "crosstab_share", "top_k_strata", "tfidf"]:
        df = QUERIES[key](spark, SF_SMALL)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [ln for ln in plan.splitlines() if re.search(r"(^|- )Window \[", ln)]
        assert lines, key
        for ln in lines:
            tail = ln.rsplit(" AS ", 1)[-1]          # "name#1], [partition], [order]"
            partition = tail.split("], [")[1].rstrip("]")
            assert partition.strip(), (key, ln)
