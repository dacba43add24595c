"""Feature attribution for the isolation forest: exact path-dependent tree
Shapley values (Lundberg et al., 2018) of the expected path length, averaged
over trees, and the global importance mean(|phi|) per feature.

For one tree the path-dependent value of a feature set S is a sum over leaves
of ``f(leaf) * prod_j g_j(S)``, where ``j`` runs over the distinct features on
the leaf's path and ``g_j`` is ``a_j`` (does the row follow the path at every
split on j: 0/1) when ``j`` is in S and ``b_j`` (the share of training rows that
follow those splits) otherwise.  Each leaf is therefore a product game, whose
Shapley values have a closed form through the polynomial
``prod_{j != i} (b_j + a_j t)``.  Since the ``a_j`` are 0/1, a leaf with p
features has only ``2**p`` possible rows patterns: the per-pattern values are
tabulated once per tree (independent of the number of rows), summed over the
leaves of a small subtree for each outcome of its splits, and each row
just looks one sum up per subtree.  Padding a short path with null players
(``a = b = 1``) keeps every leaf of a tree in one array without changing any
value.

The work is distributed with ``mapInPandas`` over the scored rows; each batch
emits per-feature partial sums, so nothing row-sized leaves the executors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .forest import ForestArrays, IsolationForestModel, average_path_length


#: A group's path features and inner splits are at most this many together (a
#: leaf on its own may have more path features), so its table stays in a cache.
GROUP_BITS = 9


class _TreeTables:
    """Per-tree tables for Shapley look-ups.

    The leaves below a node form a group.  A row's part of a group is fixed by
    one code: a bit for each feature on the path to the group's root (does the
    row follow the path at every split on it) and a bit for each split inside.
    Each bit depends on one feature, so a row's codes are sums of one row a
    feature, looked up by where its value lies among the tree's thresholds."""

    def __init__(self, forest: ForestArrays, t: int, n_features: int):
        size = forest.size[t]
        n_nodes = int(np.sum(size > 0))
        feat, left, right = (a[t][:n_nodes].tolist() for a in (forest.feature, forest.left, forest.right))
        threshold, sizes = forest.threshold[t][:n_nodes], size[:n_nodes].tolist()
        # distinct features on the path to a node, from the root on, with the share of rows that follows their splits
        slots: list[dict[int, float]] = [{} for _ in range(n_nodes)]
        entries: list[tuple] = [() for _ in range(n_nodes)]   # (node, went left) from the root on
        inner = [0] * n_nodes                                 # splits below a node, itself included
        order, stack = [], [0]
        while stack:
            u = stack.pop()
            order.append(u)
            if feat[u] >= 0:
                for child, to_left in ((left[u], True), (right[u], False)):
                    follows = dict(slots[u])
                    follows[feat[u]] = follows.get(feat[u], 1.0) * (sizes[child] / sizes[u])
                    slots[child], entries[child] = follows, entries[u] + ((u, to_left),)
                    stack.append(child)
        for u in reversed(order):
            if feat[u] >= 0:
                inner[u] = 1 + inner[left[u]] + inner[right[u]]
        leaves = [u for u in order if feat[u] < 0]
        p = max([len(slots[u]) for u in leaves] + [1])
        B = np.ones((len(leaves), p))
        for i, u in enumerate(leaves):
            B[i, :len(slots[u])] = list(slots[u].values())
        leaf_ix = np.array(leaves, dtype=int)
        fval = forest.depth[t][leaf_ix] + average_path_length(size[leaf_ix])
        self.expected = float(np.sum(fval * size[leaf_ix]) / size[0])
        leaf_table, leaf_no = _leaf_tables(fval, B), {u: i for i, u in enumerate(leaves)}

        splits: dict[int, list[int]] = {}
        for u in order:
            if feat[u] >= 0:
                splits.setdefault(feat[u], []).append(u)
        self.cuts = {f: np.unique(threshold[us]) for f, us in splits.items()}
        # of each split, by the place of a row's value among the cuts: does the row go left
        goes_left = {u: np.arange(len(c) + 1) <= np.searchsorted(c, threshold[u])
                     for f, c in self.cuts.items() for u in splits[f]}

        groups, stack = [], [0]
        while stack:
            u = stack.pop()
            if feat[u] < 0 or len(slots[u]) + inner[u] <= GROUP_BITS:
                groups.append(u)
            else:
                stack += [left[u], right[u]]
        kind = np.uint16 if max(len(slots[u]) + inner[u] for u in groups) <= 16 else np.int64
        self.codes = {f: np.zeros((len(c) + 1, len(groups)), kind) for f, c in self.cuts.items()}
        self.tables = []
        full = (1 << p) - 1
        for g, root in enumerate(groups):
            at = {f: i for i, f in enumerate(slots[root])}
            follows: dict[int, np.ndarray] = {}
            for u, to_left in entries[root]:
                follows[feat[u]] = follows.get(feat[u], True) & (goes_left[u] == to_left)
            for f, a in follows.items():
                self.codes[f][:, g] += a.astype(kind) << kind(at[f])
            known, below, stack = len(at), [], [root]
            bit = {}
            while stack:
                u = stack.pop()
                if feat[u] < 0:
                    below.append(u)
                    continue
                bit[u] = known + len(bit)
                self.codes[feat[u]][:, g] += goes_left[u].astype(kind) << kind(bit[u])
                stack += [left[u], right[u]]
            code = np.arange(1 << (known + len(bit)))
            path = (code & ((1 << known) - 1)) | (full & ~((1 << known) - 1))
            said = {u: (code >> b) & 1 for u, b in bit.items()}
            table = np.zeros((len(code), n_features))
            for u in below:
                slot = {f: i for i, f in enumerate(slots[u])}
                pattern = path
                for v, to_left in entries[u][len(entries[root]):]:
                    off = 1 - said[v] if to_left else said[v]    # a failed split clears its feature's bit
                    pattern = pattern & ~(off << slot[feat[v]])
                if slot:
                    table[:, list(slot)] += leaf_table[leaf_no[u]][pattern, :len(slot)]
            self.tables.append(table)

    def rows(self, X: np.ndarray, columns: np.ndarray | None = None) -> np.ndarray:
        """Shapley values (n x features) of this tree for the rows of X
        (``columns``: X by column, if the caller has it)."""
        columns = np.ascontiguousarray(X.T) if columns is None else columns
        code = 0
        for f, cuts in self.cuts.items():
            code = code + self.codes[f].take(np.searchsorted(cuts, columns[f]), axis=0)
        phi = np.zeros((X.shape[0], self.tables[0].shape[1]))
        if not self.cuts:
            return phi
        part = np.empty_like(phi)
        for table, c in zip(self.tables, np.ascontiguousarray(code.T).astype(np.intp)):
            phi += table.take(c, axis=0, out=part, mode="clip")
        return phi


def _leaf_tables(fval: np.ndarray, B: np.ndarray) -> np.ndarray:
    """phi[leaf, pattern, slot] for every 0/1 pattern of the leaf's slots.

    For player i the polynomial of the *other* players is the full product
    of the pattern with bit i cleared, divided by ``b_i`` (clearing the bit
    turns player i's factor into the constant ``b_i``).  So one weighted sum
    ``T(m) = sum_k w_k [t^k] prod_j (b_j + a_j(m) t)`` per pattern serves every
    player: ``phi_i(m) = f * (a_i(m) - b_i) * T(m without i) / b_i``.
    """
    n_leaves, p = B.shape
    m = 1 << p
    pats = np.arange(m)
    A = ((pats[:, None] >> np.arange(p)[None, :]) & 1).astype(float)  # (m, p)
    # pattern by pattern: setting bit j turns its factor b_j into b_j + t, so
    # each bit doubles the patterns that are known
    poly = np.zeros((n_leaves, m, p + 1))
    poly[:, 0, 0] = B.prod(axis=1)
    for j in range(p):
        known, new = poly[:, :1 << j, :j + 2], poly[:, 1 << j:2 << j, :j + 2]
        new[:] = known
        new[:, :, 1:] += known[:, :, :-1] / B[:, j][:, None, None]
    w = np.array([factorial(k) * factorial(p - 1 - k) / factorial(p) for k in range(p)])
    T = poly[:, :, :p] @ w                                            # (L, m)
    T *= fval[:, None]
    out = np.empty((n_leaves, m, p))
    for i in range(p):
        b = B[:, i][:, None]
        np.multiply(T[:, pats & ~(1 << i)], np.where(A[:, i][None, :] == 1, 1 / b - 1, -1.0), out=out[:, :, i])
    return out


def shap_values(forest: ForestArrays, X: np.ndarray, n_features: int | None = None,
                chunk_rows: int = 4000) -> tuple[np.ndarray, float]:
    """(phi, expected value) of the mean path length for the rows of X.

    Trees are tabulated one at a time (a table is a few MB) and applied to
    the rows in chunks, so memory stays bounded."""
    nf = n_features or X.shape[1]
    phi = np.zeros((X.shape[0], nf))
    starts = range(0, X.shape[0], chunk_rows)
    columns = [np.ascontiguousarray(X[start:start + chunk_rows].T) for start in starts]
    expected = 0.0
    for t in range(forest.n_trees):
        tt = _TreeTables(forest, t, nf)
        expected += tt.expected
        for start, by_column in zip(starts, columns):
            phi[start:start + chunk_rows] += tt.rows(X[start:start + chunk_rows], by_column)
    return phi / forest.n_trees, expected / forest.n_trees


#: Rows that a task holds at once; the trees are tabulated again for the next ones.
CHUNK_ROWS = 100_000


def chunks(batches: Iterable[pd.DataFrame], feats: Sequence[str], rows: int = CHUNK_ROWS) -> Iterator[np.ndarray]:
    """The feature rows of ``batches`` in arrays of ``rows`` rows (the last
    one of fewer)."""
    held = np.zeros((0, len(feats)))
    for pdf in batches:
        held = np.concatenate([held, pdf[list(feats)].to_numpy(dtype=float)], axis=0)
        while held.shape[0] >= rows:
            yield held[:rows]
            held = held[rows:]
    if held.shape[0]:
        yield held


def feature_importance(model: IsolationForestModel, df: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """``(feature, mean_abs)``: mean |Shapley value| of each feature over all
    rows of ``df``, largest first.  Each task reads its partition (features
    only) in arrays of ``CHUNK_ROWS`` rows, however large it is, and emits one
    partial sum per feature and array.  ``rows_per_task`` only sets the number
    of tasks."""
    from ..session import share, ship_package
    spark = df.sparkSession
    ship_package(spark)
    bc = share(spark, model.arrays())
    feats = list(model.features)
    nf = len(feats)

    def run(batches):
        for X in chunks(batches, feats):
            phi, _ = shap_values(bc.value, X, nf)
            yield pd.DataFrame({"feature": feats, "sum_abs": np.abs(phi).sum(axis=0),
                                "n": np.full(nf, X.shape[0], dtype=np.int64)})

    # Each task tabulates every tree once (some 3 s for 300 trees; 10,000 rows
    # take as long), so tasks get 10,000-100,000 rows: enough to spread over the
    # cores, and enough rows to amortise the tables on a large input.
    src = df.select(*feats)
    n_rows = src.count()
    try:
        par = spark.sparkContext.defaultParallelism
        have = src.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - Spark Connect: no RDD view
        par, have = 8, None
    per_task = rows_per_task or max(10_000, min(CHUNK_ROWS, -(-n_rows // max(par, 1))))
    tasks = max(1, -(-n_rows // per_task))
    if have is None or tasks > have:
        src = src.repartition(tasks)
    elif tasks < have:
        src = src.coalesce(tasks)
    parts = src.mapInPandas(run, "feature string, sum_abs double, n long")
    return (parts.groupBy("feature").agg((F.sum("sum_abs") / F.sum("n")).alias("mean_abs"))
            .orderBy(F.desc("mean_abs"), F.asc("feature")))
