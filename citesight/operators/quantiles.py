"""Exact quantiles of many columns at once, without gathering any of them.

``percentile``/``median`` are exact but merge every distinct value into one
final buffer.  Here all wanted ranks are narrowed together:

1. one aggregate gives each column's count, smallest and largest value;
2. each round counts, in one pass over the rows, how many values of each
   column fall into each of ``BUCKETS`` buckets between the bounds of a rank (once
   for all ranks that still have the same bounds), and
   the smallest and largest value in each; the bucket that holds the rank gives
   the next bounds, which are always values of the column.

A round is one job for all columns; each task counts its rows (Arrow batches, sorted
by column), and rows meet only as partial counts.  A
rank is found when its bucket holds one value, or when the two neighbouring
ranks of an interpolation lie in two buckets.  Buckets are made by sign, then
by logarithm while the bounds are far apart, then evenly, so any doubles
are narrowed in few rounds (ties and infinities included).  Any rising bucket
rule gives the same result, as only counts decide.

The result equals numpy's linear-interpolation percentile.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024


@dataclass
class _Rank:
    """The search for the ranks ``k`` and ``k + more`` (0 or 1) of a column."""
    column: str
    low: float
    high: float
    below: int      # values of the column below ``low``
    k: int
    more: int
    share: float    # of the way from one rank to the next
    found: tuple[float, float] | None = None

    def __post_init__(self):
        if self.low == self.high:
            self.found = self.low, self.low

    @property
    def span(self) -> tuple[str, float, float]:
        return self.column, self.low, self.high

    def edges(self) -> np.ndarray:
        """Where a new bucket begins; the largest value always begins one."""
        lo, hi = self.low, self.high
        if math.isinf(lo) or math.isinf(hi):
            return np.array([-sys.float_info.max, math.inf])
        if lo <= 0 <= hi:
            return np.array([0.0, 5e-324])
        far, near = max(abs(lo), abs(hi)), min(abs(lo), abs(hi))
        steps = np.arange(1, BUCKETS) / BUCKETS
        if far / near > 2:
            cuts = np.exp(math.log(near) + steps * (math.log(far) - math.log(near)))
            cuts = cuts if lo > 0 else -cuts[::-1]
        else:
            cuts = lo + (hi - lo) * steps
        return np.sort(np.append(np.clip(cuts, lo, hi), hi))

    def narrow(self, rows: list[tuple[int, int, float, float]]) -> None:
        """``rows``: (bucket, count, smallest, largest) of the values within the bounds."""
        below, before = self.below, None
        for _, n, low, high in sorted(rows):
            if before is not None:       # the rank before was the last one of its bucket
                self.found = before, low
                return
            if self.k < below + n:
                if self.k + self.more < below + n:
                    self.low, self.high, self.below = low, high, below
                    self.__post_init__()
                    return
                before = high
            below += n

    def value(self) -> float:
        a, b = self.found
        if a == b:
            return a
        return a + (b - a) * self.share if self.share < 0.5 else b - (b - a) * (1 - self.share)


def _counter(spans: list[tuple[str, float, float, np.ndarray]]):
    """Of one task: (span, bucket, count, smallest, largest); spans are (column, low, high, edges)."""
    def run(batches):
        n = [np.zeros(len(e) + 1, np.int64) for *_, e in spans]
        lo = [np.full(len(e) + 1, np.inf) for *_, e in spans]
        hi = [np.full(len(e) + 1, -np.inf) for *_, e in spans]
        for batch in batches:
            ordered = {}
            for i, (column, low, high, edges) in enumerate(spans):
                if column not in ordered:
                    v = batch.column(column).to_numpy(zero_copy_only=False).astype(float)
                    ordered[column] = np.sort(v[~np.isnan(v)])
                v = ordered[column]
                v = v[np.searchsorted(v, low, "left"):np.searchsorted(v, high, "right")]
                at = np.concatenate([[0], np.searchsorted(v, edges, "left"), [len(v)]])
                some = np.flatnonzero(np.diff(at))
                n[i][some] += np.diff(at)[some]
                lo[i][some] = np.minimum(lo[i][some], v[at[some]])
                hi[i][some] = np.maximum(hi[i][some], v[at[some + 1] - 1])
        for i in range(len(spans)):
            b = np.flatnonzero(n[i])
            yield pa.RecordBatch.from_pydict({"i": np.full(len(b), i, np.int32), "b": b.astype(np.int32), "n": n[i][b],
                                              "lo": lo[i][b], "hi": hi[i][b]})
    return run


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Iterable[float]]) -> dict[str, list[float | None]]:
    """For each column its quantiles (0 to 1), in the order asked for.  NULL and
    NaN do not count; a column without values gives None.  ``df`` is read once
    per round: pass a stored table if it is expensive."""
    wanted = {c: list(qs) for c, qs in wanted.items()}
    if not wanted:
        return {}
    names = {c: f"_{i}" for i, c in enumerate(wanted)}
    x = df.select(*[F.col(c).cast("double").alias(n) for c, n in names.items()])
    x = x.select(*[F.when(F.isnan(n), None).otherwise(F.col(n)).alias(n) for n in names.values()])
    st = x.agg(*[f(n).alias(p + n) for n in names.values() for p, f in (("n", F.count), ("l", F.min), ("h", F.max))]).first()
    out: dict[str, list] = {}
    for c, qs in wanted.items():
        n = st["n" + names[c]]
        out[c] = [_Rank(names[c], st["l" + names[c]], st["h" + names[c]], 0, k := int(q * (n - 1)),
                        int(q * (n - 1) > k), q * (n - 1) - k) if n else None for q in qs]
    ranks = [r for rs in out.values() for r in rs if r]
    while open_ := [r for r in ranks if r.found is None]:
        # ranks that are sought between the same bounds are counted once
        spans: dict[tuple, _Rank] = {}
        for r in open_:
            spans.setdefault(r.span, r)
        order = list(spans)
        cuts = [(*span, r.edges()) for span, r in spans.items()]
        rows: dict[tuple, list] = {}
        for g in (x.select(*dict.fromkeys(c for c, *_ in order)).mapInArrow(_counter(cuts), "i int, b int, n long, lo double, hi double")
                  .groupBy("i", "b").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()):
            rows.setdefault(order[g.i], []).append((g.b, g.n, g.lo, g.hi))
        for r in open_:
            r.narrow(rows[r.span])
    return {c: [r.value() if r else None for r in rs] for c, rs in out.items()}


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """One quantile of one column."""
    return exact_quantiles(df.select(col), {col: [q]})[col][0]
