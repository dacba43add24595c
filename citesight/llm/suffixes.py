"""Suffix-array dedup: bytes covered by a long string that also starts elsewhere.

A suffix array is built where repeats can be.  Every string of ``LENGTH`` bytes
has an anchor, its smallest hashed 16-byte gram, and at least half a length of
text to the right or to the left of it; strings are classed by the hash of that
half, so equal strings share a class and most classes hold one place.  Equal
surroundings (contexts) within a text, as a repeated phrase has them, are found
where the text is read: the text they cover is a span, and one place stands for
them.  Places of classes of several send their contexts to one task a class,
equal contexts merged on the way.  Of classes of very many places only the different
contexts go on; if those are still too many, each is cut into blocks of
neighbouring strings, classed by all the text that the strings of a block share,
and so on with shorter blocks: a row a context, then at most about four a block.

Contexts are sorted in two stages: suffixes smaller than their successors are
sorted directly, the others are induced by scanning the buckets of first bytes
upwards; neighbours with a common prefix of ``LENGTH`` are repeats.  Removed
bytes are the union over all repeats, judged on the input.

Defined cases: null text is empty; texts shorter than ``LENGTH`` keep all; rows
equal in doc_id and text are two places; overlapping repeats within a text
count; texts of any length are read in pieces; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import shuffle_partitions, text_or_empty

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 400
GRAM = 16
PIECE = 1 << 20        # bytes hashed at a time
HOT = 1000             # places, then different contexts, of a class, above which it is parted
PARTS = (64, 16, 4, 1)  # strings of a block, each time that such a class is parted
SORT_BYTES = 1 << 20   # contexts sorted together
_BASE, _SEED = 0x9E3779B97F4A7C15 | 1, np.uint64(0xC2B2AE3D27D4EB4F)


class _Powers:
    """Powers of the hash base and of its inverse modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 14)
            steps = np.full(size, _BASE, dtype=np.uint64)
            steps[0] = 1
            back = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
            back[0] = 1
            self.up, self.down = np.cumprod(steps), np.cumprod(back)
        return self.up[:n], self.down[:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _SEED
    return h ^ (h >> np.uint64(29))


class _Hashes:
    """Hashes of any window of a byte string."""

    def __init__(self, b: np.ndarray, powers: _Powers):
        up, self.down = powers.get(len(b) + 1)
        self.sums = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, size: int) -> np.ndarray:
        return _mix((self.sums[start + size] - self.sums[start]) * self.down[start])


def _window_least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of ``w``."""
    n = len(x) - w + 1
    full = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, dtype=x.dtype)
    full[:len(x)] = x
    blocks = full.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def anchors(b: np.ndarray, powers: _Powers, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Classes of all strings of ``length``: key, anchor, first and last start
    of the strings of each class (one row for either side of an anchor)."""
    out = [[], [], [], []]
    half = length // 2
    for at in range(0, max(len(b) - length + 1, 0), PIECE):
        part = b[at:at + PIECE + length - 1]
        h = _Hashes(part, powers)
        gram = h.of(np.arange(len(part) - GRAM + 1), GRAM)
        place = np.arange(len(gram), dtype=np.uint64)
        least = _window_least((gram & np.uint64(~((1 << 24) - 1) & (1 << 64) - 1)) | place, length - GRAM + 1)
        anchor = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.concatenate([first[1:] - 1, [len(anchor) - 1]])
        a = anchor[first]
        right = np.maximum(first, a - half)  # enough text right of the anchor
        ok = right <= last
        left = np.minimum(last, a - half - 1)
        ok2 = first <= left
        keys = (h.of(a[ok], length - half), h.of(a[ok2] - half, half) ^ _SEED)
        for k, x in enumerate((np.concatenate(keys).astype(np.int64), np.concatenate([a[ok], a[ok2]]) + at,
                               np.concatenate([right[ok], first[ok2]]) + at, np.concatenate([last[ok], left[ok2]]) + at)):
            out[k].append(x)
    return tuple(np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in out)


def copies_within(raw: bytes, found: tuple[np.ndarray, ...], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of the places of one text (``anchors``) to keep, one for equal
    contexts of a class, and start and end of the text that such contexts cover."""
    key, _, p0, p1 = found
    again, twice = np.zeros((2, len(key)), dtype=bool)
    _, at, times = np.unique(key, return_inverse=True, return_counts=True)
    first: dict[tuple[int, bytes], int] = {}
    for i in np.flatnonzero(times[at] > 1):
        one = first.setdefault((key[i], hashlib.blake2b(raw[p0[i]:p1[i] + length], digest_size=16).digest()), i)
        if one != i:
            again[i] = twice[i] = twice[one] = True
    by_start = np.argsort(p0[twice])
    start, end = p0[twice][by_start], np.maximum.accumulate(p1[twice][by_start] + length)
    apart = start[1:] > end[:-1]
    return ~again, start[np.concatenate([[True], apart])[:len(start)]], end[np.concatenate([apart, [True]])[:len(end)]]


def rising(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor (the last: not)."""
    n = len(s)
    differs = np.flatnonzero(s[1:] != s[:-1])
    at = np.searchsorted(differs, np.arange(n - 1))
    known = at < len(differs)
    out = np.zeros(n, dtype=bool)
    end = differs[at[known]]
    out[:-1][known] = s[end] < s[end + 1]
    return out


def two_stage_order(parts: list[bytes], need: list[tuple[int, int]], length: int = LENGTH) -> tuple[np.ndarray, bytes, np.ndarray]:
    """Sort the suffixes that start in ``need`` (first, end) of each part, by
    ``length`` bytes: their places in order, the joined parts, and the offset
    of each part."""
    data = b"\0".join(parts) + b"\0"
    size = np.array([len(p) + 1 for p in parts])
    offset = np.concatenate([[0], np.cumsum(size)[:-1]])
    ends = offset + size - 1
    s = np.frombuffer(data, dtype=np.uint8).astype(np.int16) + 1
    s[ends] = 0  # a part's end is smaller than any byte
    up = rising(s)
    up[ends] = False
    ups = np.flatnonzero(up)
    # every wanted suffix, and those after it up to the next rising one
    lo = offset + np.array([a for a, _ in need])
    hi = offset + np.array([b for _, b in need])
    at = np.searchsorted(ups, hi - 1)
    stop = np.minimum(np.where(at < len(ups), ups[np.minimum(at, max(len(ups) - 1, 0))] if len(ups) else ends, ends), ends)
    mark = np.zeros(len(s) + 1, dtype=np.int64)
    np.add.at(mark, lo, 1)
    np.add.at(mark, stop + 1, -1)
    wanted = (np.cumsum(mark[:-1]) > 0) & (s > 0)
    # stage one: sort the rising suffixes directly
    direct = np.flatnonzero(wanted & up)
    stops = np.minimum(direct + length, np.repeat(ends, size)[direct])
    keys = [data[i:z] for i, z in zip(direct.tolist(), stops.tolist())]
    direct = direct[np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)]
    # stage two: scan the buckets upwards; a falling suffix follows its successor
    rank = np.zeros(len(s), dtype=np.int64)
    falling = np.flatnonzero(wanted & ~up)
    falling = falling[np.argsort(s[falling], kind="stable")]
    direct = direct[np.argsort(s[direct], kind="stable")]
    count = 1
    f_at = np.searchsorted(s[falling], np.arange(258))
    d_at = np.searchsorted(s[direct], np.arange(258))
    for c in np.unique(np.concatenate([s[falling], s[direct]])):
        own = falling[f_at[c]:f_at[c + 1]]
        ready = own[s[own + 1] < c]
        rest = own[s[own + 1] == c]
        while len(ready):
            ready = ready[np.argsort(rank[ready + 1], kind="stable")]
            rank[ready] = count + np.arange(len(ready))
            count += len(ready)
            now = rank[rest + 1] > 0  # the next longer run of this byte
            ready, rest = rest[now], rest[~now]
        own = direct[d_at[c]:d_at[c + 1]]
        rank[own] = count + np.arange(len(own))
        count += len(own)
    inside = np.zeros(len(s) + 1, dtype=np.int64)
    np.add.at(inside, lo, 1)
    np.add.at(inside, hi, -1)
    starts = np.flatnonzero((np.cumsum(inside[:-1]) > 0) & (s > 0))
    return starts[np.argsort(rank[starts], kind="stable")], data, offset


def repeated(parts: list[bytes], starts: list[int], times: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each context, which of its first ``starts`` strings of ``length``
    are found twice: in the context itself met ``times``, or in any other."""
    order, data, offset = two_stage_order(parts, [(0, n) for n in starts], length)
    hit = np.zeros(len(data), dtype=bool)
    if len(order) > 1:
        raw = np.frombuffer(data, dtype=np.uint8)
        p, q = order[:-1], order[1:]
        same = np.ones(len(p), dtype=bool)
        for k in (0, length - 1, length // 2, length // 4, 3 * length // 4):
            same &= raw[p + k] == raw[q + k]
        for i in np.flatnonzero(same).tolist():  # the adjacent common prefix
            a, b = int(p[i]), int(q[i])
            if data[a:a + length] == data[b:b + length]:
                hit[a] = hit[b] = True
    return [np.ones(n, dtype=bool) if t > 1 else hit[o:o + n] for o, n, t in zip(offset.tolist(), starts, times)]


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def contexts(raw: bytes, places: list[dict], length: int = LENGTH) -> Iterator[tuple]:
    """``(key, start, strings, bytes)`` of the places of one text in classes that are not hot."""
    for x in places:
        if not x["hot"]:
            yield x["key"], x["p0"], x["p1"] - x["p0"] + 1, raw[x["p0"]:x["p1"] + length]


def hot_parts(places: list[dict], part: int = PARTS[0]) -> list[tuple[int, int]]:
    """``(start, strings)`` of the blocks of one text in hot classes; their
    offsets from the anchor are equal in all places."""
    out = []
    for x in places:
        if x["hot"]:
            first, last = x["p0"], x["p1"]
            for at in range(first - (first - x["a"]) % part, last + 1, part):
                lo = max(first, at)
                out.append((lo, min(last, at + part - 1) - lo + 1))
    return out


def block_class(raw: bytes, a: int, start: int, part: int, length: int = LENGTH) -> int:
    """Class of a block: a hash of the text that all its strings share, of the
    block's offset from the anchor and of the anchor's side."""
    at = start - (start - a) % part
    same = b"%d %d " % (at - a, start < a - length // 2) + raw[at + part - 1:at + length]
    return int.from_bytes(hashlib.blake2b(same, digest_size=8).digest(), "little", signed=True)


def digests(raw: bytes, parts: list[tuple[int, int]], length: int = LENGTH) -> np.ndarray:
    """128-bit digests (two columns) of the contexts (start, strings) of one text."""
    found = b"".join(hashlib.blake2b(raw[p:p + n - 1 + length], digest_size=16).digest() for p, n in parts)
    return np.frombuffer(found, dtype=np.int64).reshape(-1, 2)


PLACES = "rid long, key long, a long, p0 long, p1 long"


def _by_text(texts: DataFrame, places: DataFrame, hot: Column) -> DataFrame:
    """``rid, text, places`` of the texts that have ``places`` (a null key: none, but the text is wanted)."""
    own = places.groupBy("rid").agg(F.collect_set(F.when(
        F.col("key").isNotNull(), F.struct("key", "a", "p0", "p1", hot.alias("hot")))).alias("places"))
    return texts.join(own.hint("shuffle_hash"), "rid")


def digested(texts: DataFrame, part: int | None, length: int = LENGTH) -> DataFrame:
    """``rid, key, a, p0, p1, d1, d2``: a row for the context of each hot place
    of ``texts`` (rid, text, places), or for each of its blocks of ``part``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                rows = b.slice(at, 64)
                out, found = [], [np.zeros((0, 2), dtype=np.int64)]
                for r, t, places in zip(*(rows.column(c).to_pylist() for c in ("rid", "text", "places"))):
                    raw, own = t.encode(), []
                    for x in places:
                        if not x["hot"]:
                            continue
                        for p, n in [(x["p0"], x["p1"] - x["p0"] + 1)] if part is None else hot_parts([x], part):
                            key = x["key"] if part is None else block_class(raw, x["a"], p, part, length)
                            out.append((r, key, x["a"], p, p + n - 1))
                            own.append((p, n))
                    found.append(digests(raw, own, length))
                d = np.concatenate(found)
                cols = np.array(out, dtype=np.int64).reshape(-1, 5)
                yield pa.RecordBatch.from_pydict({
                    **{c: cols[:, k].copy() for k, c in enumerate(("rid", "key", "a", "p0", "p1"))},
                    "d1": d[:, 0].copy(), "d2": d[:, 1].copy()})

    return texts.mapInArrow(run, PLACES + ", d1 long, d2 long")


def part_hot(shared: DataFrame, length: int = LENGTH) -> tuple[list[DataFrame], list[DataFrame]]:
    """The hot classes of ``shared`` (rid, text, places): what is left of them to
    sort, as rows like those of ``shared`` in classes of at most ``HOT`` different
    contexts, and the spans ``rid, start, end`` of contexts and blocks met twice."""
    small, spans = [], []
    todo = shared.where(F.exists("places", lambda x: x["hot"]))
    texts = todo.select("rid", "text").dropDuplicates(["rid"])
    for part in (None, *(w for w in PARTS if w <= max(1, length // 4))):
        if todo.isEmpty():
            break
        around = materialize(digested(todo, part, length))
        kinds = materialize(around.groupBy("key", "d1", "d2").agg(
            F.count(F.lit(1)).alias("times"), F.min(F.struct("rid", "a", "p0", "p1")).alias("one")))
        twice = kinds.where("times > 1").select("key", "d1", "d2")
        spans.append(around.join(twice, ["key", "d1", "d2"]).select(
            "rid", F.col("p0").alias("start"), (F.col("p1") + length).alias("end")))
        if part == 1:  # a block is a string: all is known
            break
        # a class of one context has no other strings; of the rest, one place stands for equal contexts
        several = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
        left = materialize(kinds.join(several, "key").select("one.rid", "key", "one.a", "one.p0", "one.p1", "kinds"))
        small.append(left.where(F.col("kinds") <= HOT).drop("kinds"))
        todo = materialize(_by_text(texts, left.where(F.col("kinds") > HOT), F.lit(True)))
    return [_by_text(texts, reduce(DataFrame.unionByName, small), F.lit(False))] if small else [], spans


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """``texts`` (rid, text) -> the texts that share classes or repeat themselves, and the removed
    spans ``rid, start, end`` (bytes; they may overlap)."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rid, none, cols = [], [], [[], [], [], []]
                for r, t in zip(part.column("rid").to_pylist(), part.column("text").to_pylist()):
                    raw = t.encode()
                    found = anchors(np.frombuffer(raw, dtype=np.uint8), powers, length)
                    keep, start, end = copies_within(raw, found, length)
                    rid.append(np.full(keep.sum() + len(start), r, dtype=np.int64))
                    none.append(np.arange(len(rid[-1])) >= keep.sum())
                    for c, x, y in zip(cols, found, (start, start, start, end)):
                        c.append(np.concatenate([x[keep], y]))
                key, a, p0, p1 = (np.concatenate(c) for c in cols)
                key = pa.array(key, mask=np.concatenate(none))
                yield pa.RecordBatch.from_pydict({"rid": np.concatenate(rid), "key": key, "a": a, "p0": p0, "p1": p1})

    # a place, or without key: a span (p0 to before p1) of contexts met twice in the text
    rows = materialize(texts.mapInArrow(find, PLACES))
    within = rows.where("key is null")
    keys = materialize(rows.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "key", (F.col("n") > HOT).alias("hot")))
    # both sides are plain exchanges, so Spark can split a hot class
    shared = materialize(_by_text(texts, rows.join(keys, "key").unionByName(within.withColumn("hot", F.lit(False))), F.col("hot")))
    parted, spans = part_hot(shared, length)
    spans.append(within.select("rid", F.col("p0").alias("start"), F.col("p1").alias("end")))

    def surround(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                out = {"rid": [], "key": [], "p0": [], "n": [], "ctx": []}
                for r, t, found in zip(*(part.column(c).to_pylist() for c in ("rid", "text", "places"))):
                    for key, p0, n, ctx in contexts(t.encode(), found, length):
                        for c, x in zip(out.values(), (r, key, p0, n, ctx)):
                            c.append(x)
                yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary() if k == "ctx" else pa.int64()) for k, v in out.items()})

    around = materialize(reduce(DataFrame.unionByName, parted, shared).mapInArrow(surround, "rid long, key long, p0 long, n long, ctx binary").withColumn(
        "ch", F.xxhash64("ctx")))
    merged = around.groupBy("key", "ch", "n", "ctx").agg(F.count(F.lit(1)).alias("times"))
    by_class = merged.repartition(shuffle_partitions(texts), "key").sortWithinPartitions("key")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def judge(t: pa.Table) -> pa.RecordBatch:
            key, ch = t.column("key").to_numpy(), t.column("ch").to_numpy()
            masks = repeated(t.column("ctx").to_pylist(), t.column("n").to_pylist(), t.column("times").to_pylist(), length)
            found = [_runs(m) for m in masks]
            k = np.repeat(np.arange(len(masks)), [len(s) for s, _ in found])
            return pa.RecordBatch.from_pydict({
                "key": key[k], "ch": ch[k], "n": t.column("n").to_numpy()[k],
                "s": np.concatenate([s for s, _ in found]), "e": np.concatenate([e for _, e in found])})

        rest = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            key = t.column("key").to_numpy()
            used = np.cumsum(pa.compute.binary_length(t.column("ctx")).to_numpy())
            edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
            at = 0
            for e in edges[1:].tolist():
                if used[e - 1] - (used[at - 1] if at else 0) >= SORT_BYTES:
                    yield judge(t.slice(at, e - at))
                    at = e
            rest = t.slice(at).combine_chunks()
        if rest is not None and rest.num_rows:
            yield judge(rest)

    hits = materialize(by_class.mapInArrow(sort, "key long, ch long, n long, s long, e long"))
    found = around.select("rid", "key", "ch", "n", "p0").join(hits, ["key", "ch", "n"]).select(
        "rid", (F.col("p0") + F.col("s")).alias("start"), (F.col("p0") + F.col("e") + (length - 1)).alias("end"))
    return shared.select("rid", "text"), reduce(DataFrame.unionByName, spans, found)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and ``rid`` of every
    row, and ``kept`` (the remaining bytes) where something was removed."""
    t = docs.select(F.col("doc_id"), text_or_empty().alias("text"))
    t = t.withColumn("rid", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), "text"))
    long_texts = t.where(F.octet_length("text") >= length).select("rid", "text")
    shared, spans = repeated_spans(long_texts, length)
    merged = spans.groupBy("rid").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                out = {"rid": [], "n_removed": [], "n_spans": [], "sha": [], "kept": []}
                for r, text, found in zip(*(part.column(c).to_pylist() for c in ("rid", "text", "spans"))):
                    raw, kept, end, n = text.encode(), [], 0, 0
                    for x in found:
                        if x["start"] > end or not n:
                            kept.append(raw[end:x["start"]])
                            n += 1
                        end = max(end, x["end"])
                    kept = b"".join([*kept, raw[end:]])
                    for c, v in zip(out.values(), (r, len(raw) - len(kept), n, hashlib.sha256(kept).hexdigest(), kept)):
                        c.append(v)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_pydict({k: pa.array(v, kind) for (k, v), kind in zip(out.items(), kinds)})

    done = shared.dropDuplicates(["rid"]).join(merged.hint("shuffle_hash"), "rid").mapInArrow(
        cut, "rid long, n_removed long, n_spans long, sha string, kept binary")
    every = t.select("doc_id", "rid", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("_all"))
    return every.join(done, "rid", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("sha", "_all").alias("kept_sha256"), "rid", "kept")
