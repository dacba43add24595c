"""Isolation forest and attribution properties (no oracle possible)."""

from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from citesight.operators.attribution import GROUP_BITS, _TreeTables, chunks, shap_values
from citesight.operators.forest import ForestArrays, IsolationForest, average_path_length, grow_tree


def _frame(spark, n=400, seed=1, outliers=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 3))
    X[:outliers] += 12.0
    pdf = pd.DataFrame(X, columns=["a", "b", "c"])
    pdf.insert(0, "key", [f"k{i:04d}" for i in range(n)])
    return spark.createDataFrame(pdf)


def test_same_seed_same_scores_any_partitioning(spark):
    df = _frame(spark)
    m1 = IsolationForest(n_trees=40, seed=7).fit(df.repartition(1), ["a", "b", "c"], "key")
    m2 = IsolationForest(n_trees=40, seed=7).fit(df.repartition(5), ["a", "b", "c"], "key")
    s1 = m1.score(df, 0.1).select("key", "anomaly_score").toPandas().sort_values("key")
    s2 = m2.score(df.repartition(3), 0.1).select("key", "anomaly_score").toPandas().sort_values("key")
    assert np.allclose(s1["anomaly_score"].to_numpy(), s2["anomaly_score"].to_numpy())


def test_planted_outliers_rank_first_and_share(spark):
    df = _frame(spark)
    model = IsolationForest(n_trees=100, seed=42).fit(df, ["a", "b", "c"], "key")
    scored = model.score(df, 0.05).toPandas()
    top = scored.sort_values(["anomaly_score", "key"]).head(3)["key"].tolist()
    assert sorted(top) == ["k0000", "k0001", "k0002"]
    flagged = (scored["is_anomaly"] == -1).mean()
    assert abs(flagged - 0.05) <= 1.0 / len(scored) + 1e-9
    raw = model.raw_scores(df, "r").toPandas()["r"]
    assert ((-raw > 0) & (-raw < 1)).all()


def test_affine_rescale_keeps_ranks(spark):
    df = _frame(spark)
    m1 = IsolationForest(n_trees=50, seed=3).fit(df, ["a", "b", "c"], "key")
    r1 = m1.raw_scores(df, "r").toPandas().sort_values("key")["r"].rank().to_numpy()
    df2 = df.withColumn("a", F.col("a") * 3 + 5)
    m2 = IsolationForest(n_trees=50, seed=3).fit(df2, ["a", "b", "c"], "key")
    r2 = m2.raw_scores(df2, "r").toPandas().sort_values("key")["r"].rank().to_numpy()
    assert np.allclose(r1, r2)


def test_average_path_length():
    assert list(average_path_length([0, 1, 2])) == [0.0, 0.0, 1.0]
    assert abs(average_path_length([256])[0] - 10.244770920116851) < 1e-9


def _small_forest():
    rng = np.random.default_rng(0)
    X = rng.normal(size=(64, 4))
    rows = []
    for t in range(4):
        tr = grow_tree(X[rng.choice(64, 32, replace=False)], np.random.default_rng([1, t]), 5)
        rows.append(pd.DataFrame({"tree": t, "node": np.arange(len(tr["feature"])), **tr}))
    return ForestArrays.from_nodes(pd.concat(rows), 32, 5), X


def brute_force_shap(forest: ForestArrays, x: np.ndarray) -> np.ndarray:
    """Reference Shapley values by enumerating feature subsets."""
    d = x.shape[0]

    def value(S: tuple[int, ...]) -> float:
        total = 0.0
        for t in range(forest.n_trees):
            total += _cond_expect(forest, t, x, set(S), 0)
        return total / forest.n_trees

    phi = np.zeros(d)
    for i in range(d):
        others = [j for j in range(d) if j != i]
        for k in range(len(others) + 1):
            wk = factorial(k) * factorial(d - k - 1) / factorial(d)
            for S in combinations(others, k):
                phi[i] += wk * (value(S + (i,)) - value(S))
    return phi


def _cond_expect(forest: ForestArrays, t: int, x: np.ndarray, S: set, u: int) -> float:
    f = forest.feature[t][u]
    if f < 0:
        return float(forest.depth[t][u] + average_path_length([forest.size[t][u]])[0])
    lc, rc = forest.left[t][u], forest.right[t][u]
    if f in S:
        nxt = lc if x[f] <= forest.threshold[t][u] else rc
        return _cond_expect(forest, t, x, S, nxt)
    n = forest.size[t][u]
    return (forest.size[t][lc] / n * _cond_expect(forest, t, x, S, lc)
            + forest.size[t][rc] / n * _cond_expect(forest, t, x, S, rc))


def test_shap_additivity_and_brute_force():
    forest, X = _small_forest()
    phi, ev = shap_values(forest, X[:8], 4)
    assert np.allclose(phi.sum(axis=1) + ev, forest.path_length(X[:8]))
    for r in range(3):
        assert np.allclose(brute_force_shap(forest, X[r]), phi[r])


def test_shapley_tables_do_not_grow_with_rows_times_leaves():
    """A row looks up one sum per group of leaves, far fewer than leaves; NaN and infinite values go right or left as in scoring."""
    rng = np.random.default_rng(3)
    X = rng.normal(size=(600, 6))
    X[0, 1], X[1, 2], X[2, 3] = np.nan, np.inf, -np.inf
    X[:, 5] = 1.0
    parts = []
    for t in range(3):
        tree = grow_tree(X[10:266], np.random.default_rng([5, t]), 8)
        k = len(tree["feature"])
        parts.append(pd.DataFrame({"tree": np.full(k, t), "node": np.arange(k), **tree}))
    forest = ForestArrays.from_nodes(pd.concat(parts), 256, 8)
    phi, ev = shap_values(forest, X, 6, chunk_rows=250)
    assert np.allclose(phi.sum(axis=1) + ev, forest.path_length(X))
    assert (phi[:, 5] == 0).all()
    for t in range(3):
        leaves = int(((forest.feature[t] < 0) & (forest.size[t] > 0)).sum())
        tables = _TreeTables(forest, t, 6).tables
        assert leaves > 40 and len(tables) < leaves / 2
        assert all(len(x) <= 1 << GROUP_BITS for x in tables)


def test_attribution_reads_partitions_in_bounded_arrays():
    parts = [pd.DataFrame({"a": np.arange(n, dtype=float), "b": 0.0}) for n in (3, 0, 25, 1)]
    got = list(chunks(iter(parts), ["a", "b"], rows=10))
    assert [len(x) for x in got] == [10, 10, 9]
    assert np.concatenate(got)[:, 0].tolist() == [v for p in parts for v in p["a"]]
    assert list(chunks(iter([]), ["a", "b"])) == []


def _rows_with_a_hot_key(spark, parts):
    rng = np.random.default_rng(9)
    rows = [("hot", 1.0, 2.0)] * 3000 + [(f"k{i % 2500}", float(a), float(b)) for i, (a, b) in enumerate(rng.random((6000, 2)))]
    return spark.createDataFrame(rows, "k string, a double, b double").repartition(parts)


def test_a_repeated_key_gives_bounded_samples(spark):
    from citesight.operators.forest import sample_share, smallest_draws
    trees, psi = 60, 64
    df = _rows_with_a_hot_key(spark, 5)
    sample = smallest_draws(df, "k", ["a", "b"], trees, psi, 1, sample_share(psi, 9000))
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    pdf = sample.toPandas()
    assert (pdf.groupby("_tree").size() == psi).all() and pdf._tree.nunique() == trees
    hot = (pdf.k == "hot").mean()          # a third of the rows, give or take the chance of 3840 draws
    assert abs(hot - 1 / 3) < 5 * (2 / 9 / (trees * psi)) ** 0.5
    # the draws of copies are those of single rows: uniform up to the largest one kept
    assert abs(pdf[pdf.k == "hot"]._u.mean() / pdf[pdf.k != "hot"]._u.mean() - 1) < 0.1
    again = smallest_draws(_rows_with_a_hot_key(spark, 3), "k", ["a", "b"], trees, psi, 1, 1.0).toPandas()
    cols = ["_tree", "_u", "k", "a", "b"]
    assert sorted(map(tuple, pdf[cols].values)) == sorted(map(tuple, again[cols].values))


def test_small_tables_are_sampled_whole(spark):
    from citesight.operators.forest import sample_share, smallest_draws
    df = spark.createDataFrame([("a", 1.0)] * 3 + [("b", 2.0)], "k string, a double")
    got = smallest_draws(df, "k", ["a"], 4, 4, 1, sample_share(4, 4)).groupBy("_tree", "k").count().collect()
    assert {(r._tree, r.k): r["count"] for r in got} == {(t, k): n for t in range(4) for k, n in (("a", 3), ("b", 1))}
