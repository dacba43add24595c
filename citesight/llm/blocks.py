"""Buckets compared in blocks: no task ever holds more than two blocks of one
bucket, however many rows share its key."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import shuffle_partitions

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 512


def blocked(rows: DataFrame, keys: Sequence[str], id_col: str, block: int = BLOCK) -> DataFrame:
    """The rows of every bucket of two or more, once for each pair of blocks
    that their own block belongs to, with ``_lo``, ``_hi`` (the pair) and
    ``_own`` (their block); rows of one (keys, _lo, _hi) stand together."""
    keys = list(keys)
    sizes = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    # both sides are plain exchanges, so Spark can split a hot bucket here
    joined = rows.join(sizes, keys)
    blocks = F.ceil(F.col("_n") / block).cast("int")
    own = F.pmod(F.xxhash64(F.col(id_col), F.lit(42)), blocks).cast("int")
    out = (joined.withColumn("_own", own).withColumn("_o", F.explode(F.sequence(F.lit(0), blocks - 1)))
           .withColumn("_lo", F.least("_own", "_o")).withColumn("_hi", F.greatest("_own", "_o")).drop("_o", "_n"))
    together = [*keys, "_lo", "_hi"]
    return out.repartition(shuffle_partitions(rows), *together).sortWithinPartitions(*together)


def map_groups(rows: DataFrame, together: Sequence[str], function: Callable[[pa.Table], dict], schema: str) -> DataFrame:
    """Apply ``function`` to each run of equal ``together`` columns of sorted
    partitions; it returns columns.  Only one batch and one run are held."""
    together = list(together)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, done = None, []
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            if not t.num_rows:
                continue
            new = np.zeros(t.num_rows, dtype=bool)
            for k in together:
                x = t.column(k).to_numpy()
                new[1:] |= x[1:] != x[:-1]
            starts = np.concatenate([[0], np.flatnonzero(new)])
            for a, z in zip(starts[:-1], starts[1:]):
                done.append(function(t.slice(a, z - a)))
            rest = t.slice(starts[-1]).combine_chunks()
            if done:
                yield _gathered(done)
                done = []
        if rest is not None and rest.num_rows:
            yield _gathered([function(rest)])

    return rows.mapInArrow(run, schema)


def _gathered(parts: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: np.concatenate([p[k] for p in parts]) for k in parts[0]})


def local_roots(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest id reachable by the pairs (a, b) of positions, for each id."""
    root = ids.copy()
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (root == before).all():
            break
    return root
