"""Isolation forest on Spark (Liu, Ting & Zhou, 2008).

Spark ML has no isolation forest, so it is built from DataFrame pieces with
numpy only inside tasks:

1. *Sample* -- each tree needs ``psi = min(max_samples, N)`` rows drawn without
   replacement: the ``psi`` smallest of uniform draws, one per row and tree.  A
   draw is a hash of the row (its key; also its features if the key repeats),
   the tree and the seed, so it is the same for any partitioning.  Equal rows are counted first; a row with
   ``c`` copies draws the smallest of ``c`` numbers in order, as sums of
   exponential gaps, at most ``psi`` of them.  Draws above a share of the rows
   that no tree needs are left out where they are made, and each task keeps at
   most ``psi`` draws a tree before the exchange (a group limit), so no table of
   rows x trees is built and no tree's group holds more than ``psi`` rows.
2. *Fit* -- ``groupBy(tree).applyInPandas``: one group per tree, a few hundred
   rows each, grown with a per-tree seeded generator.
3. *Model* -- a node table ``(tree, node, feature, threshold, left, right,
   size, depth)`` of at most ``trees x (2 psi - 1)`` rows: the only thing
   collected, and what is broadcast.
4. *Score* -- ``mapInPandas``: vectorised traversal of every tree for a batch
   of rows; path length ``E[h] = mean(depth + c(leaf size))``; score
   ``s = 2 ** (-E[h] / c(psi))``.
5. *Threshold* -- the ``contamination`` quantile of ``-s`` (linear
   interpolation); ``anomaly_score = -s - threshold``; ``is_anomaly = -1`` when
   the score is negative, else 1.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

EULER_GAMMA = 0.5772156649015329
ROWS = 4096  # rows that go down a tree together
NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, "
               "size int, depth int")


def average_path_length(n):
    """c(n): average path length of an unsuccessful search in a binary
    search tree of n items (0 for n <= 1, 1 for n = 2)."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    nb = n[big]
    out[big] = 2.0 * (np.log(nb - 1.0) + EULER_GAMMA) - 2.0 * (nb - 1.0) / nb
    return out


def grow_tree(X: np.ndarray, rng: np.random.Generator, max_depth: int) -> dict[str, np.ndarray]:
    """Grow one isolation tree on the rows of X (all of them)."""
    n = X.shape[0]
    cap = max(1, 2 * n - 1)
    feature = np.full(cap, -1, dtype=np.int32)
    threshold = np.zeros(cap)
    left = np.full(cap, -1, dtype=np.int32)
    right = np.full(cap, -1, dtype=np.int32)
    size = np.zeros(cap, dtype=np.int32)
    depth = np.zeros(cap, dtype=np.int32)
    count = 1
    stack = [(0, np.arange(n), 0)]
    while stack:
        node, idx, d = stack.pop()
        size[node] = idx.size
        depth[node] = d
        if idx.size <= 1 or d >= max_depth:
            continue
        sub = X[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            continue
        f = int(usable[rng.integers(usable.size)])
        thr = float(rng.uniform(lo[f], hi[f]))
        if thr >= hi[f]:
            thr = float(lo[f])
        go_left = sub[:, f] <= thr
        feature[node], threshold[node] = f, thr
        left[node], right[node] = count, count + 1
        count += 2
        stack.append((right[node], idx[~go_left], d + 1))
        stack.append((left[node], idx[go_left], d + 1))
    return {"feature": feature[:count], "threshold": threshold[:count], "left": left[:count],
            "right": right[:count], "size": size[:count], "depth": depth[:count]}


@dataclass
class ForestArrays:
    """The forest as padded arrays, one row per tree."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    size: np.ndarray
    depth: np.ndarray
    psi: int
    max_depth: int

    @property
    def n_trees(self) -> int:
        return self.feature.shape[0]

    @classmethod
    def from_nodes(cls, nodes: pd.DataFrame, psi: int, max_depth: int) -> "ForestArrays":
        nodes = nodes.sort_values(["tree", "node"])
        trees = np.sort(nodes["tree"].unique())
        t_index = {t: i for i, t in enumerate(trees)}
        m = int(nodes["node"].max()) + 1
        shape = (len(trees), m)
        arr = {k: np.full(shape, -1, dtype=np.int32) for k in ["feature", "left", "right", "size", "depth"]}
        thr = np.zeros(shape)
        ti = nodes["tree"].map(t_index).to_numpy()
        ni = nodes["node"].to_numpy()
        for k in arr:
            arr[k][ti, ni] = nodes[k].to_numpy()
        thr[ti, ni] = nodes["threshold"].to_numpy()
        return cls(arr["feature"], thr, arr["left"], arr["right"], arr["size"], arr["depth"], psi, max_depth)

    def leaves(self, X: np.ndarray) -> np.ndarray:
        """Leaf node index per (row, tree).

        Tree by tree over blocks of rows, so that a tree's nodes and a block's
        rows stay in the processor's cache; a leaf is its own child."""
        n, m = X.shape[0], self.feature.shape[1]
        out = np.zeros((n, self.n_trees), dtype=np.int64)
        if not X.shape[1]:
            return out
        leaf = self.feature < 0
        own = np.arange(m)
        feature = np.where(leaf, 0, self.feature).astype(np.int64)
        child = np.stack([np.where(leaf, own, self.right), np.where(leaf, own, self.left)], axis=2).astype(np.int64)
        child = child.reshape(self.n_trees, 2 * m)
        for at in range(0, n, ROWS):
            rows = np.ascontiguousarray(X[at:at + ROWS].T)
            size = rows.shape[1]
            flat, place = rows.ravel(), np.arange(size)
            for t in range(self.n_trees):
                start, threshold, step = feature[t] * size, self.threshold[t], child[t]
                node = np.zeros(size, dtype=np.int64)
                for _ in range(self.max_depth):
                    go_left = flat.take(start.take(node) + place) <= threshold.take(node)
                    node = step.take(2 * node + go_left)
                out[at:at + ROWS, t] = node
        return out

    def path_length(self, X: np.ndarray) -> np.ndarray:
        """Mean over trees of depth(leaf) + c(size(leaf))."""
        leaf = self.leaves(X)
        length = self.depth + average_path_length(self.size)
        h = length.ravel()[leaf + np.arange(self.n_trees) * length.shape[1]]
        return h.mean(axis=1)

    def raw_score(self, X: np.ndarray) -> np.ndarray:
        """Negated anomaly score -2^(-E[h]/c(psi)); lower is more anomalous."""
        c = float(average_path_length([self.psi])[0]) or 1.0
        return -np.power(2.0, -self.path_length(X) / c)


def _uniform(*parts: Column) -> Column:
    """A uniform [0, 1) number from a 64-bit hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)).cast("double") / float(1 << 53)


def sample_share(psi: int, n: int) -> float:
    """The share of draws that holds the ``psi`` smallest of ``n``: by
    Chernoff's bound it holds fewer with a chance below ``e ** -36``."""
    return min(1.0, (psi + 12.0 * math.sqrt(psi) + 72.0) / max(n, 1))


def smallest_draws(data: DataFrame, key: str, features: Sequence[str], trees: int, psi: int, seed: int,
                   share: float) -> DataFrame:
    """The rows of each tree's sample: ``_tree`` and ``_u`` next to the columns
    of ``data``, the ``psi`` smallest draws of each tree."""
    counted = data.groupBy(key, *features).agg(F.count("*").alias("_copies"))
    # a key draws for its row; where it has several rows, the features tell them apart
    many = counted.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows")).where("_rows > 1")
    row = F.when(F.col("_rows").isNull(), F.xxhash64(F.col(key))).otherwise(F.xxhash64(F.col(key), *[F.col(c) for c in features]))
    counted = counted.join(many, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn("_row", row)
    below = F.lit(share if share < 1.0 else 2.0)
    tree, copies = F.col("_tree"), F.col("_copies")
    draw = _uniform(F.col("_row"), tree, F.lit(seed))

    # the i-th smallest of c uniform numbers is 1 - exp(-E_i), E_i = E_(i-1) + X_i / (c - i + 1), X_i exponential
    def gap(i: Column) -> Column:
        return -F.log1p(-_uniform(F.col("_row"), tree, F.lit(seed), i)) / (copies - i + 1)
    sums = F.aggregate(F.sequence(F.lit(1).cast("long"), F.least(copies, F.lit(psi))), F.array().cast("array<double>"),
                       lambda e, i: F.concat(e, F.array(F.coalesce(F.try_element_at(e, F.lit(-1)), F.lit(0.0)) + gap(i))))
    several = F.transform(sums, lambda e: -F.expm1(-e))

    # most rows draw once a tree: those draws are left out before any array is made of them
    drawn = counted.withColumn("_tree", F.explode(F.array(*[F.lit(t) for t in range(trees)])))
    drawn = drawn.where((copies > 1) | (draw < below))
    kept = F.filter(F.when(copies == 1, F.array(draw)).otherwise(several), lambda u: u < below)
    # explode_outer + NULL filter keeps the optimizer from evaluating the
    # draws a second time in an inferred pre-filter
    made = drawn.withColumn("_u", F.explode_outer(kept)).where(F.col("_u").isNotNull())
    made = made.select(key, *features, "_row", "_tree", "_u")
    first = Window.partitionBy("_tree").orderBy("_u", key, "_row")
    return made.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= psi).drop("_rn", "_row")


def _fit_group(features: Sequence[str], key: str, psi: int, seed: int, max_depth: int):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["_tree"].iloc[0])
        pdf = pdf.sort_values([key, "_u"], kind="mergesort")
        X = pdf[list(features)].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        t = grow_tree(X, rng, max_depth)
        k = len(t["feature"])
        return pd.DataFrame({"tree": np.full(k, tree, dtype=np.int32), "node": np.arange(k, dtype=np.int32),
                             "feature": t["feature"], "threshold": t["threshold"], "left": t["left"],
                             "right": t["right"], "size": t["size"], "depth": t["depth"]})
    return fit


@dataclass
class IsolationForestModel:
    nodes: pd.DataFrame
    features: list[str]
    psi: int
    max_depth: int
    n_rows: int

    def arrays(self) -> ForestArrays:
        return ForestArrays.from_nodes(self.nodes, self.psi, self.max_depth)

    def raw_scores(self, df: DataFrame, name: str = "raw_score") -> DataFrame:
        """Append the raw score (``-s``) to every row, in Arrow batches."""
        from ..session import share, ship_package
        spark = df.sparkSession
        ship_package(spark)
        bc = share(spark, self.arrays())
        feats = list(self.features)
        schema = T.StructType(df.schema.fields + [T.StructField(name, T.DoubleType(), True)])

        def score(batches):
            forest = bc.value
            for pdf in batches:
                X = pdf[feats].to_numpy(dtype=float)
                yield pdf.assign(**{name: forest.raw_score(X)})

        return df.mapInPandas(score, schema)

    def score(self, df: DataFrame, contamination: float, name: str = "anomaly_score",
              flag: str = "is_anomaly") -> DataFrame:
        """Decision score (raw score minus the contamination quantile of the
        raw scores) and the -1/1 flag."""
        from ..session import materialize
        from .quantiles import exact_quantile
        raw = materialize(self.raw_scores(df, "_raw"))
        thr = exact_quantile(raw, "_raw", contamination)
        return (raw.withColumn(name, F.col("_raw") - F.lit(thr))
                .withColumn(flag, F.when(F.col(name) < 0, F.lit(-1)).otherwise(F.lit(1)))
                .drop("_raw"))


class IsolationForest:
    """Estimator: ``IsolationForest(n_trees, max_samples, seed).fit(df, features, key)``."""

    def __init__(self, n_trees: int = 300, max_samples: int = 256, seed: int = 42):
        self.n_trees = n_trees
        self.max_samples = max_samples
        self.seed = seed

    def fit(self, df: DataFrame, features: Sequence[str], key: str) -> IsolationForestModel:
        from ..session import ship_package
        ship_package(df.sparkSession)
        feats = list(features)
        data = df.select(key, *[F.col(c).cast("double").alias(c) for c in feats])
        n = data.count()
        psi = max(1, min(self.max_samples, n))
        max_depth = int(math.ceil(math.log2(max(psi, 2))))
        share = sample_share(psi, n)
        nodes = self._grow(data, key, feats, psi, max_depth, share)
        if share < 1.0 and (nodes.loc[nodes["node"] == 0, "size"] < psi).any():  # next to impossible
            nodes = self._grow(data, key, feats, psi, max_depth, 1.0)
        return IsolationForestModel(nodes, feats, psi, max_depth, n)

    def _grow(self, data: DataFrame, key: str, feats: list[str], psi: int, max_depth: int, share: float) -> pd.DataFrame:
        sample = smallest_draws(data, key, feats, self.n_trees, psi, self.seed, share)
        return (sample.groupBy("_tree")
                .applyInPandas(_fit_group(feats, key, psi, self.seed, max_depth), NODE_SCHEMA).toPandas())
