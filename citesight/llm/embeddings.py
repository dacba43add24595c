"""Embedding near-dedup: sign hashes of random hyperplanes in several tables,
exact cosine verification, distributed connected components.

Bits per table grow with the logarithm of the number of vectors, so buckets
keep their size; the number of tables follows from the recall wanted at the
threshold.  Equal vectors are one class and are compared once; a bucket is
compared in blocks; a pair counts in the first table in which it meets.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different length never meet; rows of
one vec_id are one node (their links add up); a null vec_id has no links, no
component and is kept; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .blocks import BLOCK, blocked, local_roots, map_groups
from .components import connected_components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKET = 256
RECALL = 0.995


def plan_tables(n: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """Bits per table and tables, for ``n`` vectors."""
    bits = min(31, max(4, math.ceil(math.log2(max(n, 1) / BUCKET)) if n > BUCKET else 4))
    p = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - p)))


def _matrix(column) -> np.ndarray:
    """Rows of equally long lists as doubles of length one."""
    x = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    m = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(x), -1)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def near_pairs(vectors: DataFrame, threshold: float = 0.9, recall: float = RECALL, seed: int = 1) -> DataFrame:
    """``vectors`` (vec_id, embedding), each different and valid, with a
    ``weight`` -> ``vec_id, root, links``: partial sums of the weights linked,
    and the smallest vec_id linked within the block pair."""
    n = vectors.count()
    bits, tables = plan_tables(n, threshold, recall)

    def hash_signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            sizes = pa.compute.list_value_length(b.column("embedding")).to_numpy()
            for dim in np.unique(sizes):
                part = b.filter(pa.array(sizes == dim))
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), bits * tables))
                sign = (_matrix(part.column("embedding")) @ planes[dim] > 0).reshape(-1, tables, bits)
                code = (sign * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": part.column("vec_id"), "weight": part.column("weight"), "embedding": part.column("embedding"),
                    "codes": pa.FixedSizeListArray.from_arrays(pa.array(code.ravel()), tables).cast(pa.list_(pa.int32()))})

    kind = dict(vectors.dtypes)["embedding"]
    hashed = materialize(vectors.select("vec_id", "weight", "embedding").mapInArrow(
        hash_signs, f"vec_id long, weight long, embedding {kind}, codes array<int>"))
    rows = hashed.withColumn("dim", F.size("embedding")).select(
        "vec_id", "weight", "embedding", "dim", "codes", F.posexplode("codes").alias("table", "code"))
    keys = ["dim", "table", "code"]

    def compare(t: pa.Table) -> dict:
        lo, hi, table = (t.column(c)[0].as_py() for c in ("_lo", "_hi", "table"))
        ids, own = t.column("vec_id").to_numpy(), t.column("_own").to_numpy()
        x = _matrix(t.column("embedding"))
        w = t.column("weight").to_numpy()
        codes = t.column("codes").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)[:, :table]
        left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
        links, root = np.zeros(len(ids), dtype=np.int64), ids
        if len(left) and len(right):
            near = x[left] @ x[right].T >= threshold
            i, j = np.nonzero(near)
            i, j = left[i], right[j]
            new = ids[i] != ids[j]
            if lo == hi:
                new &= i < j
            i, j = i[new], j[new]
            if table:
                met = np.zeros(len(i), dtype=bool)
                for c in range(table):
                    met |= codes[i, c] == codes[j, c]
                i, j = i[~met], j[~met]
            np.add.at(links, i, w[j])
            np.add.at(links, j, w[i])
            root = local_roots(ids, i, j)
        some = links > 0
        return {"vec_id": ids[some], "root": root[some], "links": links[some]}

    return map_groups(blocked(rows, keys, "vec_id", BLOCK), [*keys, "_lo", "_hi"], compare,
                      "vec_id long, root long, links long")


def near_dedup(vectors: DataFrame, threshold: float = 0.9, recall: float = RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row; see the module."""
    e = F.col("embedding")
    sound = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(e, lambda v: v != 0)
    ok = F.coalesce(sound, F.lit(False)) & F.col("vec_id").isNotNull()
    rows = vectors.select("vec_id", "embedding", F.when(ok, F.xxhash64(e)).alias("_h"),
                          F.when(ok, F.xxhash64(F.lit(7), e)).alias("_g"))
    # equal vectors: one class, named by its smallest vec_id
    named = rows.where("_h is not null").groupBy("_h", "_g").agg(
        F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("weight"))
    named = materialize(named)
    reps = rows.join(named, (rows["_h"] == named["_h"]) & (rows["_g"] == named["_g"]) & (rows["vec_id"] == named["rep"])).select(
        F.col("rep").alias("vec_id"), "weight", "embedding", rows["_h"], rows["_g"]).dropDuplicates(["_h", "_g"])
    found = materialize(near_pairs(materialize(reps), threshold, recall))
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    comps = connected_components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    classes = materialize(
        named.join(links.withColumnRenamed("vec_id", "rep"), "rep", "left")
        .join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        .select("_h", "_g", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id")))
    out = rows.select("vec_id", "_h", "_g").join(classes, ["_h", "_g"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
