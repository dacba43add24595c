"""N-gram Jaccard join by chosen paths.

Texts become sets of hashed five-word shingles; equal sets are one class.  Of
each class, a row of ``COORDINATES`` min-hashes gives the tokens: two sets share
a token with the probability of their similarity.  A run starts with all
classes in one bucket and splits each bucket, recursively, on ``BRANCHES``
tokens sampled by the bucket's path: a class goes on into the bucket of each of
its sampled tokens, so similar sets part only if they differ in all of them.
Buckets of at most ``LEAF`` classes are compared by brute force, as are, in
blocks, larger ones that a further split would not divide (large groups of near
copies) or that ``DEPTH`` splits have left.
Runs are repeated until the recall at the threshold is reached.

A pair is compared only in the first leaf that it shares: min-hashes decide
which classes of a leaf can have a partner (four standard deviations below the
threshold), full shingle sets then verify exactly.

Defined cases: null or wordless text has no shingles, is linked with nothing
and kept; a text of fewer than five words is one shingle; rows equal in doc_id
and text are one document; the smallest doc_id (null last, then text hash) of a
group is kept; an empty table gives an empty result; extra columns stay as they
are.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .blocks import blocked, local_roots, map_groups
from .components import connected_components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
COORDINATES = 64
BRANCHES = 3
LEAF = 512
DEPTH = 4
_WORD = re.compile(r"\w+")
_C = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


def runs_needed(threshold: float = THRESHOLD, recall: float = RECALL, branches: int = BRANCHES) -> int:
    """Runs until a pair at the threshold meets with probability ``recall``,
    however deep the recursion goes."""
    lost = 0.0
    for _ in range(100):  # the pair parts in a run if every branch loses it
        lost = (1 - threshold + threshold * lost) ** branches
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost)))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles."""
    found = _WORD.findall((text or "").lower())
    if not found:
        return np.zeros(0, dtype=np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in found], dtype=np.uint64)
    n = max(1, len(h) - words + 1)
    s = np.zeros(n, dtype=np.uint64)
    for k in range(min(words, len(h))):
        s += h[k:k + n] * (_C[k % len(_C)] + np.uint64(2 * (k // len(_C))))
    s = (s ^ (s >> np.uint64(31))) * _C[1]
    return np.unique(s ^ (s >> np.uint64(29)))


def min_hashes(s: np.ndarray) -> np.ndarray:
    rng = np.random.default_rng(7)
    a = rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
    out = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(s), 4096):
        out = np.minimum(out, (s[at:at + 4096, None] * a + b).min(axis=0))
    return (out >> np.uint64(33)).astype(np.int32)


def _row_key() -> Column:
    h = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), h.cast("string"))


def _first_common(mine: np.ndarray, i: np.ndarray, j: np.ndarray, path: int) -> np.ndarray:
    """Whether no leaf before ``path`` holds both classes of each pair; the
    leaves of a class are a row of ``mine``, sorted, filled up with its end."""
    out = np.ones(len(i), dtype=bool)
    for at in range(0, len(i), 1 << 14):
        a, b = mine[i[at:at + (1 << 14)]], mine[j[at:at + (1 << 14)]]
        for c in range(mine.shape[1]):
            x = a[:, c:c + 1]
            out[at:at + (1 << 14)] &= ~((x == b) & (x < path)).any(axis=1)
    return out


def _padded(leaves) -> np.ndarray:
    x = leaves.combine_chunks() if isinstance(leaves, pa.ChunkedArray) else leaves
    size = pa.compute.list_value_length(x).to_numpy()
    out = np.full((len(size), int(size.max())), np.iinfo(np.int64).max, dtype=np.int64)
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = x.flatten().to_numpy()
    return out


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of left with right sets, by products of
    incidence matrices of the shingles that several sets have."""
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n > 1
    new = np.cumsum(shared) - 1
    keep = shared[token]
    doc, token = doc[keep], new[token[keep]]
    order = np.argsort(token, kind="stable")
    doc, token = doc[order], token[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    width = 4096
    for a in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        lo, hi = np.searchsorted(token, [a, a + width])
        m = np.zeros((len(sets), width), dtype=np.float32)
        m[doc[lo:hi], token[lo:hi] - a] = 1
        out += m[left] @ m[right].T
    return out


def chosen_paths(classes: DataFrame, runs: int, leaf: int = LEAF, depth: int = DEPTH) -> DataFrame:
    """``classes`` (cid, sig) -> ``path, cid``: the leaves with two or more
    classes, over all runs."""
    def coordinate(path: Column, k: int) -> Column:
        return F.pmod(F.xxhash64(path, F.lit(k), F.lit("split")), F.lit(COORDINATES)).cast("int")

    def split(rows: DataFrame) -> DataFrame:
        ways = [F.struct(coordinate(F.col("path"), k).alias("c"), F.lit(k).alias("k")) for k in range(BRANCHES)]
        go = rows.withColumn("_w", F.explode(F.array(*ways)))
        return go.select(F.xxhash64("path", "_w.c", F.get("sig", F.col("_w.c"))).alias("path"), "cid").distinct()

    def divisible(large: DataFrame) -> DataFrame:
        """Paths of the large buckets that splitting divides: on average over
        the sampled tokens, no value holds half of the bucket."""
        ways = [F.struct(F.lit(k).alias("k"), F.get("sig", coordinate(F.col("path"), k)).alias("v")) for k in range(BRANCHES)]
        values = large.select("path", "_n", F.explode(F.array(*ways)).alias("_w")).groupBy("path", "_n", "_w").agg(
            F.count(F.lit(1)).alias("_m"))
        most = values.groupBy("path", "_n", F.col("_w.k").alias("k")).agg(F.max("_m").alias("_m"))
        return most.groupBy("path", "_n").agg(F.avg("_m").alias("_m")).where(F.col("_m") < F.col("_n") / 2).select("path")

    start = classes.withColumn("path", F.explode(F.array(*[F.lit(1000 + r).cast("long") for r in range(runs)])))
    rows, leaves = materialize(split(start)), None
    for level in range(1, depth + 1):
        sizes = materialize(rows.groupBy("path").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
        large = sizes.where(F.col("_n") > leaf)
        if level < depth and large.limit(1).count():
            large = materialize(rows.join(large, "path").join(classes, "cid"))
            open_ = materialize(divisible(large))
        else:
            open_ = None
        done = sizes if open_ is None else sizes.join(open_, "path", "left_anti")
        done = rows.join(materialize(done), "path").select("path", "cid")
        leaves = done if leaves is None else leaves.unionByName(done)
        if open_ is None:
            break
        rows = materialize(split(large.join(open_, "path")))
    return materialize(leaves.distinct())


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
                 words: int = WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, links): each row's class; the classes with their first
    row and number of documents; partial links ``cid, root, links`` between
    different classes."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                cid, check, sig = [], [], []
                for t in part.column("text").to_pylist():
                    s = shingle_set(t, words)
                    d = xxhash.xxh3_128_intdigest(s.tobytes())
                    cid.append((d & (1 << 64) - 1) - (1 << 63) if len(s) else None)
                    check.append((d >> 64) - (1 << 63) if len(s) else None)
                    sig.append(min_hashes(s) if len(s) else None)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "_rk": part.column("_rk"), "cid": pa.array(cid, pa.int64()),
                    "check": pa.array(check, pa.int64()), "sig": pa.array(sig, pa.list_(pa.int32()))})

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        _row_key().alias("_rk"))
    rows = materialize(keyed.mapInArrow(describe, "doc_id long, _rk string, cid long, check long, sig array<int>"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_rk")
    classes = materialize(rows.where("cid is not null").groupBy("cid", "check").agg(
        F.min(first).alias("_f"), F.count(F.lit(1)).alias("weight")).select(
        "cid", "check", "weight", F.col("_f.doc_id").alias("first_id"), F.col("_f._rk").alias("_rk")))
    # one row of each class carries its min-hashes on
    sigs = materialize(rows.select("cid", "_rk", "sig").join(classes.select("cid", "_rk", "weight"), ["cid", "_rk"])
                       .dropDuplicates(["cid"]))
    leaves = chosen_paths(sigs.select("cid", "sig"), runs_needed(threshold, recall))
    own = materialize(leaves.groupBy("cid").agg(F.sort_array(F.collect_set("path")).alias("leaves")))  # at most runs x branches^depth

    least = threshold - 4 * math.sqrt(threshold * (1 - threshold) / COORDINATES)

    def pairs_of(t: pa.Table):
        lo, hi, path = (t.column(c)[0].as_py() for c in ("_lo", "_hi", "path"))
        blocks = t.column("_own").to_numpy()
        return np.flatnonzero(blocks == lo), np.flatnonzero(blocks == hi), lo == hi, path

    def maybe(t: pa.Table) -> dict:
        left, right, same, path = pairs_of(t)
        ids = t.column("cid").to_numpy()
        some = np.zeros(len(ids), dtype=bool)
        if len(left) and len(right):
            sig = t.column("sig").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            equal = np.zeros((len(left), len(right)), dtype=np.int16)
            for c in range(sig.shape[1]):
                equal += sig[left, c][:, None] == sig[right, c][None, :]
            i, j = np.nonzero(equal >= least * sig.shape[1])
            i, j = left[i], right[j]
            new = i < j if same else np.ones(len(i), dtype=bool)
            i, j = i[new], j[new]
            new = _first_common(_padded(t.column("leaves")), i, j, path)
            some[i[new]] = some[j[new]] = True
        return {"path": np.full(int(some.sum()), path), "cid": ids[some]}

    together = ["path", "_lo", "_hi"]
    likely = map_groups(
        blocked(leaves.join(sigs.select("cid", "sig"), "cid").join(own, "cid"), ["path"], "cid"), together, maybe,
        "path long, cid long")
    likely = materialize(likely.distinct())

    def hash_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                sets = [shingle_set(t, words).astype(np.int64) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "cid": part.column("cid"), "weight": part.column("weight"),
                    "shingles": pa.array(sets, pa.list_(pa.int64()))})

    wanted = materialize(sigs.select("cid", "_rk", "weight").join(likely.select("cid").distinct(), "cid"))
    texts = keyed.select("_rk", "text").join(wanted.hint("shuffle_hash"), "_rk")
    sets = materialize(texts.select("cid", "weight", "text").mapInArrow(
        hash_again, "cid long, weight long, shingles array<long>").dropDuplicates(["cid"]))

    def verify(t: pa.Table) -> dict:
        left, right, same, path = pairs_of(t)
        ids, w = t.column("cid").to_numpy(), t.column("weight").to_numpy()
        links, root = np.zeros(len(ids), dtype=np.int64), ids
        if len(left) and len(right):
            x = t.column("shingles").combine_chunks()
            size = pa.compute.list_value_length(x).to_numpy()
            sets = np.split(x.flatten().to_numpy(), np.cumsum(size)[:-1])
            common = _common(sets, left, right)
            i, j = np.nonzero(common / (size[left][:, None] + size[right][None, :] - common.astype(np.float64)) >= threshold)
            i, j = left[i], right[j]
            new = i < j if same else np.ones(len(i), dtype=bool)
            i, j = i[new], j[new]
            new = _first_common(_padded(t.column("leaves")), i, j, path)
            i, j = i[new], j[new]
            np.add.at(links, i, w[j])
            np.add.at(links, j, w[i])
            root = local_roots(ids, i, j)
        some = links > 0
        return {"cid": ids[some], "root": root[some], "links": links[some]}

    links = map_groups(blocked(likely.join(sets, "cid").join(own, "cid"), ["path"], "cid"), together, verify,
                       "cid long, root long, links long")
    return rows.select("doc_id", "_rk", "cid", "check"), classes, materialize(links)


def ngram_groups(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id`` (smallest doc_id with
    the same shingles), ``n_links`` (other documents at the threshold or
    above), ``component_id`` (smallest doc_id of the linked group), ``kept``,
    and ``_rk``, the row's key."""
    rows, classes, links = near_classes(docs, threshold, recall)
    comps = materialize(connected_components(links.select(F.col("cid").alias("a"), F.col("root").alias("b"))))
    labelled = materialize(classes.join(comps.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
        "component", F.coalesce("component", "cid")).join(
        links.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left"))
    first = F.struct(F.col("first_id").isNull().alias("none"), "first_id", "_rk")
    heads = materialize(labelled.groupBy("component").agg(F.min(first).alias("_h")))
    table = materialize(labelled.join(heads, "component").select(
        "cid", "check", F.col("first_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.col("_h.first_id").alias("component_id"), F.col("_h._rk").alias("_head")))
    out = rows.join(table, ["cid", "check"], "left")
    alone = F.col("cid").isNull()
    return out.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | (F.col("_rk") == F.col("_head"))).alias("kept"), "_rk")


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``docs`` with one document of each group of near copies."""
    groups = ngram_groups(docs, threshold, recall)
    kept = materialize(groups.where("kept").groupBy("_rk").agg(F.count(F.lit(1)).alias("_n")))
    out = docs.withColumn("_rk", _row_key()).join(kept.hint("shuffle_hash"), "_rk")
    if kept.where("_n > 1").limit(1).count():  # rows equal in doc_id and text
        out = out.dropDuplicates(["_rk"])
    return out.drop("_rk", "_n")
