"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text is cut into lines and sentences (a long one also after words chosen by
their hash), each hashed with its occurrence number.  A sketch is a small table
of cells (count, sum of hashes, sum of check hashes), each paragraph in three of
them.  Two sketches subtract cell by cell; peeling cells that hold one paragraph
recovers the paragraphs that differ.  Where cells are left over, larger sketches
of the two texts are tried, until they peel: twice as many cells each time.
Likeness = common paragraphs / paragraphs of either.

``fingerprint_versions`` pairs each document with the next by doc_id.  Texts
move once: they are dealt into ranges of doc_id (bounds from quantiles of the
ids), and only the first document of each range is also sent to the range
before, so neighbours meet in one streamed pass over each sorted range.

Defined cases: null text is empty; two empty texts are alike (1.0); rows are
ordered by doc_id, null last, equal ids by text hash; the document after the
last is the first (a single document follows itself); an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, text_or_empty

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENDS = re.compile(r"(?<=[.!?;:。！？])\s*|\n")
LONG = 16              # a longer sentence is cut further
CELLS = 12             # of the fingerprint that is returned
CHUNK = 1 << 21        # characters compared at a time
_P = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def paragraphs(text: str) -> list[str]:
    out: list[str] = []
    for s in ENDS.split(text):
        if len(s) <= LONG:
            if s:
                out.append(s)
            continue
        words, part = re.findall(r"\S+\s*|\s+", s), []
        for w in words:
            part.append(w)
            if xxhash.xxh32_intdigest(w) % 4 == 0:
                out.append("".join(part))
                part = []
        if part:
            out.append("".join(part))
    return out


def _mix(x: np.ndarray, p: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * p
    return x ^ (x >> np.uint64(29))


def digests(text: str) -> np.ndarray:
    """One 64-bit digest per paragraph; a repeat also hashes its number."""
    keys = np.array([xxhash.xxh3_64_intdigest(p) for p in paragraphs(text)], dtype=np.uint64)
    if len(keys) < 2:
        return keys
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.concatenate([[True], k[1:] != k[:-1]])
    if first.all():
        return keys
    at = np.arange(len(k))
    nth = (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64)
    keys[order] = np.where(nth > 0, _mix(k + nth * _P[1], _P[0]), k)
    return keys


def _cells(keys: np.ndarray, doc: np.ndarray, m: int) -> list[np.ndarray]:
    third = m // 3
    return [doc * m + r * third + (_mix(keys, _P[r]) >> np.uint64(11)).astype(np.int64) % third for r in range(3)]


class Sketches:
    """Sketches of ``m`` cells (a multiple of three) of several texts at once."""

    def __init__(self, n: int, m: int):
        self.n, self.m = n, m
        self.count = np.zeros(n * m, dtype=np.int64)
        self.keys = np.zeros(n * m, dtype=np.uint64)
        self.checks = np.zeros(n * m, dtype=np.uint64)

    def add(self, keys: np.ndarray, doc: np.ndarray, sign: np.ndarray | int) -> None:
        sign = np.broadcast_to(np.asarray(sign, dtype=np.int64), keys.shape)
        s = sign.astype(np.uint64)  # -1 wraps, as the sums do
        check = _mix(keys, np.uint64(0x27D4EB2F165667C5)) * s
        signed = keys * s
        for c in _cells(keys, doc, self.m):
            np.add.at(self.count, c, sign)
            np.add.at(self.keys, c, signed)
            np.add.at(self.checks, c, check)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of subtracted sketches: how many paragraphs only the first and only
        the second text has, and whether all were recovered."""
        first, second = np.zeros(self.n, dtype=np.int64), np.zeros(self.n, dtype=np.int64)
        while True:
            at = np.flatnonzero(np.abs(self.count) == 1)
            sign = self.count[at]
            keys = self.keys[at] * sign.astype(np.uint64)
            pure = _mix(keys, np.uint64(0x27D4EB2F165667C5)) * sign.astype(np.uint64) == self.checks[at]
            at, sign, keys = at[pure], sign[pure], keys[pure]
            if not len(at):
                break
            doc = at // self.m
            order = np.lexsort((keys, doc))
            doc, keys, sign = doc[order], keys[order], sign[order]
            new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])])
            doc, keys, sign = doc[new], keys[new], sign[new]
            first += np.bincount(doc[sign > 0], minlength=self.n)
            second += np.bincount(doc[sign < 0], minlength=self.n)
            self.add(keys, doc, -sign)
        left = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        return first, second, ~left.reshape(self.n, self.m).any(axis=1)


def _joined(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    doc = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    return (np.concatenate(keys) if keys else np.zeros(0, np.uint64)), doc


def likeness(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Likeness of each pair of digest lists, by subtracting and peeling."""
    out = np.ones(len(a))
    size = np.array([max(len(x), len(y), 4) for x, y in zip(a, b)])
    cells = 3 * (1 << np.ceil(np.log2(size / 3)).astype(int)) if len(a) else size
    todo = np.arange(len(a))
    while len(todo):
        later = []
        for m in np.unique(cells[todo]):
            pick = todo[cells[todo] == m]
            for k in range(0, len(pick), max(1, (1 << 20) // int(m))):
                part = pick[k:k + max(1, (1 << 20) // int(m))]
                s = Sketches(len(part), int(m))
                s.add(*_joined([a[i] for i in part]), 1)
                s.add(*_joined([b[i] for i in part]), -1)
                first, second, done = s.peel()
                na, nb = np.array([len(a[i]) for i in part]), np.array([len(b[i]) for i in part])
                union = na + second
                out[part] = np.where(union > 0, (na - first) / np.maximum(union, 1), 1.0)
                later.append(part[~done])
        todo = np.concatenate(later)
        cells[todo] *= 2
    return out


def _written(keys: list[np.ndarray]) -> list[str]:
    """The fingerprints: number of paragraphs and the cells."""
    s = Sketches(len(keys), CELLS)
    s.add(*_joined(keys), 1)
    raw = np.stack([s.count.astype(np.uint64), s.keys, s.checks], axis=1).astype("<u8").reshape(len(keys), -1)
    return [f"{len(k)}:" + base64.b64encode(r.tobytes()).decode() for k, r in zip(keys, raw)]


def compare_versions(ids: list, texts: list[str]) -> dict:
    """Columns for all but the last text, which only follows the one before."""
    edited = []
    for t, after in zip(texts, texts[1:]):
        q = len(t) // 4
        edited.append(t[:len(t) - q] + after[:q])
    keys = [digests(t) for t in texts]
    changed = [digests(t) for t in edited]
    return {
        "doc_id": pa.array(ids[:-1], pa.int64()), "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        "fingerprint": _written(keys[:-1]), "edited_fingerprint": _written(changed),
        "near_edited": likeness(keys[:-1], changed), "near_next": likeness(keys[:-1], keys[1:])}


def _range_of(doc_id, bounds: list[int]):
    """Number of bounds below ``doc_id``, looked up in two steps."""
    step = max(1, int(len(bounds) ** 0.5))
    all_, coarse = F.array(*[F.lit(int(b)) for b in bounds]), F.array(*[F.lit(int(b)) for b in bounds[step - 1::step]])
    c = F.size(F.filter(coarse, lambda b: b < doc_id)) * step
    near = F.slice(all_, c + 1, F.lit(step))
    return F.when(doc_id.isNull(), len(bounds) + 1).otherwise(c + F.size(F.filter(near, lambda b: b < doc_id))).cast("int")


def fingerprint_versions(docs: DataFrame) -> DataFrame:
    """The columns of ``compare_versions`` for every document; see the module."""
    spark = docs.sparkSession
    n = shuffle_partitions(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    got = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0]
    bounds = sorted(set(got or [0]))
    rows = rows.withColumn("_at", _range_of(F.col("doc_id"), bounds)).withColumn("_th", F.xxhash64("text"))
    heads = sorted(rows.groupBy("_at").agg(F.min(F.struct("doc_id", "_th")).alias("m")).collect())  # one row a range
    before = {h["_at"]: heads[i - 1]["_at"] for i, h in enumerate(heads)}
    head = spark.createDataFrame([(h["_at"], h["m"]["doc_id"], h["m"]["_th"], before[h["_at"]]) for h in heads],
                                 "_at int, _hd long, _ht long, _to int")
    j = rows.join(F.broadcast(head), "_at")  # at most one row a range
    first = F.col("doc_id").eqNullSafe(F.col("_hd")) & (F.col("_th") == F.col("_ht"))
    places = F.when(first, F.array(F.struct("_at", F.lit(0).alias("_tail")),
                                   F.struct(F.col("_to").alias("_at"), F.lit(1).alias("_tail")))).otherwise(
        F.array(F.struct("_at", F.lit(0).alias("_tail"))))
    dealt = j.select("doc_id", "_th", "text", F.explode(places).alias("_p")).select(
        "doc_id", "_th", "text", "_p._at", "_p._tail")
    dealt = dealt.repartitionById(len(bounds) + 2, F.col("_at")).sortWithinPartitions(
        "_at", "_tail", F.col("doc_id").asc_nulls_last(), "_th")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, ended = [], [], 0, False
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                for i, t, tail in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(),
                                      part.column("_tail").to_pylist()):
                    if ended:  # further copies of the same head
                        continue
                    ended = bool(tail)
                    ids.append(i)
                    texts.append(t)
                    size += len(t)
                    if size >= CHUNK and len(ids) > 1:
                        yield pa.RecordBatch.from_pydict(compare_versions(ids, texts))
                        ids, texts, size = ids[-1:], texts[-1:], len(t)
        if len(ids) > 1:
            yield pa.RecordBatch.from_pydict(compare_versions(ids, texts))

    return dealt.select("doc_id", "text", "_tail").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
