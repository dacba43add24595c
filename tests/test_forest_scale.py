"""scoring and draws hold little more than their results."""
import tracemalloc

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from citesight.operators import forest


def small_forest(trees=60):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(256, 5)).round(1)
    grown = [forest.grow_tree(X[rng.integers(0, 256, 256)], np.random.default_rng([1, t]), 8) for t in range(trees)]
    nodes = pd.concat([pd.DataFrame({"tree": t, "node": range(len(g["feature"])), **g}) for t, g in enumerate(grown)])
    return forest.ForestArrays.from_nodes(nodes, 256, 8), grown


def test_leaves_are_those_of_a_walk_and_need_no_tables_of_rows_by_trees():
    arrays, grown = small_forest()
    X = np.random.default_rng(5).normal(size=(9000, 5)).round(1)
    X[7, 2] = np.nan
    tracemalloc.start()
    got = arrays.leaves(X)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * got.nbytes
    for row in (0, 7, 4095, 4096, 8999):
        for t, g in enumerate(grown):
            node = 0
            while g["feature"][node] >= 0:
                side = "left" if X[row, g["feature"][node]] <= g["threshold"][node] else "right"
                node = g[side][node]
            assert got[row, t] == node


def test_draws_that_no_tree_needs_make_no_arrays(spark):
    data = spark.range(2000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).cast("double").alias("x"))
    data = data.unionByName(data.where("x = 3")).unionByName(data.where("k = '11'"))  # 285 rows with copies
    share = forest.sample_share(16, data.count())
    assert share < 0.1
    draws = forest.smallest_draws(data, "k", ["x"], 20, 16, 1, share)
    plan = draws._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode(") == 2  # trees, cut by the share; then what is left of each
    few, every = (sorted(map(tuple, d.collect())) for d in (draws, forest.smallest_draws(data, "k", ["x"], 20, 16, 1, 1.0)))
    assert few == every and len(few) == 20 * 16
