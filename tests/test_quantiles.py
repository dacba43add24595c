"""Exact distributed quantiles equal numpy's linear-interpolation percentile."""

import numpy as np
from pyspark.sql import functions as F
import pytest

from citesight.operators import quantiles
from citesight.operators.quantiles import exact_quantile, exact_quantiles


@pytest.mark.parametrize("q", [0.0, 0.05, 0.15, 0.5, 0.93, 1.0])
def test_exact_quantile_matches_numpy(spark, q):
    rng = np.random.default_rng(5)
    vals = np.concatenate([rng.normal(size=3000), np.full(200, 0.25)])  # with heavy ties
    rows = [(float(v),) for v in vals] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "x double").repartition(6)
    assert exact_quantile(df, "x", q) == pytest.approx(float(np.percentile(vals, 100 * q)), abs=1e-12)


def test_exact_quantile_narrows_wide_bracket(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BUCKETS", 2)
    vals = [float(i % 7) for i in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert exact_quantile(df, "x", 0.5) == float(np.percentile(vals, 50))
    assert exact_quantile(df.where("x > 100"), "x", 0.5) is None


def test_many_columns_equal_numpy(spark):
    rng = np.random.default_rng(3)
    n = 4000
    cols = {"even": rng.random(n), "wide": rng.choice([-1, 1], n) * 10.0 ** rng.uniform(-300, 300, n), "ties": rng.integers(0, 3, n) * 1.0,
            "one": np.full(n, 7.5), "zero": np.where(rng.random(n) < .4, 0.0, -rng.random(n)), "tiny": 5e-324 * rng.integers(0, 9, n),
            "near": 1.0 + np.spacing(1.0) * rng.integers(0, 5, n), "inf": rng.choice([-np.inf, np.inf, 1.0, 2.0], n),
            "third": np.where(rng.random(n) < .34, 3.25, rng.standard_normal(n))}
    rows = [[None if rng.random() < .1 else float(v) for v in r] + [None, float("nan")] for r in zip(*cols.values())]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*cols, "none", "nan"])).repartition(5).cache()
    qs = [0.0, 0.013, 0.25, 0.5, 0.5001, 0.95, 1.0]
    got = exact_quantiles(df, {c: qs for c in [*cols, "none", "nan"]})
    assert got["none"] == got["nan"] == [None] * len(qs)
    for i, c in enumerate(cols):
        x = np.array([r[i] for r in rows if r[i] is not None])
        with np.errstate(all="ignore"):
            want = np.percentile(x, [100 * q for q in qs])
        if c != "inf":  # numpy gives nan between equal infinities
            assert np.allclose(got[c], want, rtol=1e-12, atol=0), c
    assert got["inf"][0] == -np.inf and got["inf"][-1] == np.inf
    assert exact_quantiles(df, {}) == {} and exact_quantiles(df.limit(0), {"even": [.5]}) == {"even": [None]}


def test_jobs_do_not_grow_with_the_columns(spark):
    n = 2000
    df = spark.range(n).select(*[(F.rand(7 + i) * 100).alias(f"c{i}") for i in range(12)])
    jobs = []
    for k in (1, 12):
        spark.sparkContext.setJobGroup(f"quantiles-{k}", "")
        exact_quantiles(df, {f"c{i}": [0.5] for i in range(k)})
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"quantiles-{k}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0] + 2


def test_ranks_between_the_same_bounds_are_counted_once(spark, monkeypatch):
    asked = []
    count = quantiles._counter
    monkeypatch.setattr(quantiles, "_counter", lambda spans: asked.append([s[:3] for s in spans]) or count(spans))
    df = spark.range(1, 5001).select(F.col("id").cast("double").alias("x"))
    qs = [i / 100 for i in range(101)]
    assert np.allclose(exact_quantiles(df, {"x": qs})["x"], np.percentile(np.arange(1, 5001), [100 * q for q in qs]))
    assert len(asked[0]) == 1 and all(len(set(spans)) == len(spans) for spans in asked)
