"""Collocations: phrases that occur more often than their parts suggest.

Texts are lower-cased (A-Z only), split into pieces at ``.,;:!?`` and line
ends, and pieces into words at spaces and tabs.  Each task indexes its texts in
shards of some megabytes, language by language: the words become numbers, and
an FM-index over them (suffix order and Burrows-Wheeler column, for the text
and for its reverse) enumerates all phrases up to the wanted depth by extending
intervals to the left and to the right in turn; the size of an interval is the
phrase's count.  Counts are summed across shards.

Most phrases are rare, so a first pass sums the words and the pairs of
neighbouring words in hash buckets.  Where a bucket's sum is below the least
count, none of its phrases can reach it, and the index leaves the pair out: it
splits the text there.  A second pass sums the triples of pairs that are left in
the same way; the index doesn't follow triples that cannot reach the count.  A
longer phrase can only be as frequent as all its parts are.  Sums are never too
small, so no phrase is lost.  There are about half as many buckets as words, up
to ``2 ** MAX_BUCKET_BITS``; more data means only that less is left out.  The two
tables of the buckets' bits are all that is sent to every task: each at most ``2
** MAX_BUCKET_BITS / 8`` bytes, whatever the input.

A phrase is scored at its weakest cut, by integers alone.  ``collocations``
states the rules.

Defined cases: null texts are empty; a null language is ``und``; texts longer
than a shard are cut at words, with the last words carried over and phrases
within them subtracted once; repeated rows count each time; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, share
from .common import shuffle_partitions, text_or_empty

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_WORDS = 3
MIN_COUNT = 10
COVER_PERCENT = 50    # a phrase goes if a longer one has so many of its occurrences
TOP = 2_000
SCALE = 1_000_000
SHARD_BYTES = 8 << 20    # text indexed at a time
HELD_BYTES = 32 << 20    # text a task holds for all languages together
MIN_BUCKET_BITS, MAX_BUCKET_BITS = 16, 29  # of the table that all tasks get: 64 MB at most
SLICE_BITS = 18          # buckets counted by one group

_CLASS = np.zeros(256, np.uint8)          # 0 part of a word, 1 between words, 2 between pieces
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shards(batches: Iterator[pa.RecordBatch], most: int, held: int, carry: int) -> Iterator[tuple[str, bytes, int]]:
    """(language, text, carried): whole texts of one language, joined by line
    ends.  A longer text is cut between words; each further part then begins
    with the last ``carried`` words of the part before."""
    waiting: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}

    def full(lang: str) -> tuple[str, bytes, int]:
        size.pop(lang)
        return lang, b"\n".join(waiting.pop(lang)), 0

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
            text = text.as_py()
            if len(text) > most:
                yield from ((lang, part, n) for part, n in _cut(text, most, carry))
                continue
            waiting.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text) + 1
            if size[lang] >= most:
                yield full(lang)
            elif sum(size.values()) >= held:
                yield full(max(size, key=size.get))
    for lang in [*waiting]:
        yield full(lang)


def _cut(text: bytes, most: int, carry: int) -> Iterator[tuple[bytes, int]]:
    at, before = 0, b""
    while at < len(text):
        end = at + most
        while end < len(text):
            between = np.flatnonzero(_CLASS[np.frombuffer(text, np.uint8, min(most, len(text) - end), end)])
            if len(between):
                end += int(between[0]) + 1
                break
            end = min(len(text), end + most)  # a word of many megabytes stays whole
        part = before + text[at:end]
        yield part, len(before.split())
        data, start, stop, brk = _words(part)
        tail: list[bytes] = []
        if len(start) and not (_CLASS[data[stop[-1]:]] == 2).any():  # the last piece goes on
            for i in range(len(start) - 1, max(-1, len(start) - 1 - carry), -1):
                if tail and brk[i + 1]:
                    break
                tail.insert(0, data[start[i]:stop[i]].tobytes())
        before = b" ".join(tail) + b" " if tail else b""
        at = end


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes, start and end of each word, and whether a new
    piece begins with it (one more entry for the end)."""
    data = np.frombuffer(text.translate(_LOWER), np.uint8)
    kind = _CLASS[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], kind == 0, [False]]).astype(np.int8)))
    start, stop = edge[::2], edge[1::2]
    breaks = np.concatenate([[0], np.cumsum(kind == 2, dtype=np.int32)])
    at = breaks[start]
    return data, start, stop, np.concatenate([[True], at[1:] != at[:-1], [True]]) if len(start) else np.array([True])


def numbered(text: bytes) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Word numbers from 1, the words (by number - 1), and ``brk`` of ``_words``."""
    data, start, stop, brk = _words(text)
    if not len(start):
        return np.zeros(0, np.int64), [], brk
    offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int64)
    letters = data[_CLASS[data] == 0]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64) + 1, coded.dictionary.to_pylist(), brk


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, by number (0 for none)."""
    seed = xxhash.xxh32_intdigest(lang.encode())
    out = np.zeros(len(words) + 1, np.uint64)
    out[1:] = [xxhash.xxh3_64_intdigest(w, seed) for w in words]
    return out


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def _pairs(h: np.ndarray, ids: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of each two neighbouring words (whether or not of one piece)."""
    a, b = h[ids[:-1]], h[ids[1:]]
    return _bucket((a ^ a >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) + b, bits)


def _triples(h: np.ndarray, ids: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of each three neighbouring words."""
    a, b, c = h[ids[:-2]], h[ids[1:-1]], h[ids[2:]]
    a = (a ^ a >> np.uint64(31)) * np.uint64(0x94D049BB133111EB) + b
    return _bucket((a ^ a >> np.uint64(27)) * np.uint64(0xD6E8FEB86659FD93) + c, bits)


class FmIndex:
    """Intervals of phrases in the suffix order of ``words`` (numbers from 1,
    0 between stretches, in front and at the end) and of its reverse."""

    def __init__(self, words: np.ndarray, depth: int):
        self.n, self.top = len(words), int(words.max()) + 1
        self.column, self.rank = zip(self._side(words, depth), self._side(words[::-1], depth))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(words, minlength=self.top))])

    def _side(self, words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The Burrows-Wheeler column in the order of the first ``depth``
        words, and its rank look-up: (word, row) pairs in order."""
        # the order of depth words, a few at a time so that keys stay below 2^62
        step = max(1, 62 // max(1, int(self.top).bit_length()))
        order = None
        wide = np.concatenate([words, np.zeros(depth, words.dtype)])
        for upto in range(depth, 0, -step):
            key = np.zeros(self.n, np.int64)
            for k in range(max(0, upto - step), upto):
                key = key * self.top + wide[k:k + self.n]
            order = np.argsort(key, kind="stable") if order is None else order[np.argsort(key[order], kind="stable")]
        column = words[order - 1]  # the row of place 0 gets the last entry, a 0
        return column, np.sort(column * self.n + np.arange(self.n))

    def phrases(self, depth: int, keep=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1, 2 .. ``depth``: the phrases (a row of word numbers each) and
        their counts.  ``keep`` tells which phrases of a length to follow up."""
        word = np.flatnonzero(np.diff(self.first))
        word = word[word > 0]
        low = [self.first[word], self.first[word]]     # where the interval starts, in the text's and the reverse order
        size = self.first[word + 1] - self.first[word]
        text = word[:, None]
        yield text, size
        for d in range(1, depth):
            left = d % 2  # extend to the left by the text's own column, to the right by the reverse's
            here, there = (0, 1) if left else (1, 0)
            of = np.repeat(np.arange(len(size)), size)
            row = low[here][of] + np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
            key, count = np.unique(of * self.top + self.column[here][row], return_counts=True)
            of, word = key // self.top, key % self.top
            # in the other order the extended phrases lie inside the old interval, by the added word
            before = np.cumsum(count) - count
            inside = before - before[np.searchsorted(of, of)]
            real = word > 0
            of, word, count, inside = of[real], word[real], count[real], inside[real]
            grown = np.searchsorted(self.rank[here], word * self.n + low[here][of])  # = first[word] + rank before the interval
            grown += self.first[word] - np.searchsorted(self.rank[here], word * self.n)
            other = low[there][of] + inside
            low = [grown, other] if here == 0 else [other, grown]
            size = count
            text = np.concatenate([word[:, None], text[of]] if left else [text[of], word[:, None]], axis=1)
            if keep is not None:
                wanted = keep(text)
                low, size, text = [x[wanted] for x in low], size[wanted], text[wanted]
            yield text, size


def _pack(bucket: np.ndarray, n: np.ndarray) -> bytes:
    """Rising bucket numbers and their small counts: gaps byte by byte, lowest
    bytes first, so that what follows compresses."""
    gaps = np.diff(bucket, prepend=0).astype("<u4")
    return gaps.view(np.uint8).reshape(-1, 4).T.tobytes() + n.astype(np.uint8).tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(5, -1)
    gaps = np.ascontiguousarray(planes[:4].T).view("<u4").ravel()
    return np.cumsum(gaps, dtype=np.int64), planes[4]


def _bucket_sums(most: int, held: int, bits: int, enough: int, pairs=None):
    """For each shard and slice of the buckets, the counts of its words and
    pairs, none above ``enough``; given the table of ``pairs``, the counts of
    triples of which both pairs may be frequent."""
    low = min(bits, SLICE_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, text, carried in shards(batches, most, held, 1 if pairs is None else 2):
            ids, words, brk = numbered(text)
            if len(ids) < (1 if pairs is None else 3):
                continue
            h = _hashes(lang, words)
            if pairs is None:
                single = np.repeat(_bucket(h[1:], bits), np.minimum(np.bincount(ids[carried:], minlength=len(h))[1:], enough))
                found = np.concatenate([single, _pairs(h, ids, bits)[~brk[1:-1]]])
            else:
                joined = ~brk[1:-1] & _has(pairs.value, _pairs(h, ids, bits))
                found = _triples(h, ids, bits)[joined[:-1] & joined[1:]]
            bucket, n = np.unique(found, return_counts=True)
            n = np.minimum(n, enough)
            cuts = np.searchsorted(bucket, np.arange((1 << bits - low) + 1) << low)
            full = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_pydict({"part": full, "sums": pa.array(
                [_pack(bucket[cuts[k]:cuts[k + 1]] - (int(k) << low), n[cuts[k]:cuts[k + 1]]) for k in full], pa.binary())})
    return run


def _bits(bits: int, enough: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for b in batches:
            for part, data in zip(b.column("part").to_pylist(), b.column("sums")):
                at, n = _unpack(data.as_py())
                table = made.get(part)
                if table is None:
                    table = made[part] = np.zeros(1 << min(bits, SLICE_BITS), np.uint16)
                table[at] = np.minimum(table[at] + n, enough)
        for part, table in made.items():
            yield pa.RecordBatch.from_pydict({"part": [part], "bits": [np.packbits(table >= enough).tobytes()]})
    return run


def bucket_bits(docs: DataFrame) -> int:
    """As many buckets as about two to four words, within bounds."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(MAX_BUCKET_BITS, max(MIN_BUCKET_BITS, (size // 16).bit_length()))


def frequent_buckets(docs: DataFrame, min_count: int, bits: int, pairs=None) -> np.ndarray:
    """One bit for each bucket whose words and pairs (given the table of
    ``pairs``: triples) together reach the count, or 255, if that is less."""
    enough = max(1, min(min_count, 255))
    parts = max(1, 1 << bits >> SLICE_BITS)
    sums = docs.mapInArrow(_bucket_sums(SHARD_BYTES, HELD_BYTES, bits, enough, pairs), "part long, sums binary")
    made = (sums.repartition(min(parts, shuffle_partitions(docs)), "part")
            .mapInArrow(_bits(bits, enough), "part long, bits binary"))
    table = np.zeros(max(1, (1 << bits) // 8), np.uint8)
    width = len(table) // parts
    for r in made.collect():  # at most 2 ** bits / 8 bytes in all
        table[r.part * width:(r.part + 1) * width] = np.frombuffer(r.bits, np.uint8)
    return table


def _has(table: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return (table[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8) & 1).astype(bool)


def _stretches(ids: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """The words that are joined to a neighbour, 0 in front of and behind each stretch."""
    keep = np.concatenate([joined, [False]]) | np.concatenate([[False], joined])
    kept = np.flatnonzero(keep)
    ends = ~np.concatenate([joined, [False]])[kept]
    place = 1 + np.arange(len(kept)) + np.cumsum(ends) - ends
    out = np.zeros(len(kept) + int(ends.sum()) + 1, np.int64)
    out[place] = ids[kept]
    return out


def _index_shards(table, triples, most: int, held: int, bits: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = table.value

        def rows(lang, words, text, n):
            names = pa.array([b"", *words], pa.binary())
            said = pc.binary_join_element_wise(
                *(names.take(pa.array(text[:, k])) for k in range(text.shape[1])), b" ").cast(pa.string())
            return pa.RecordBatch.from_pydict({
                "lang": pa.repeat(pa.scalar(lang, pa.string()), len(n)), "phrase": said, "n": np.asarray(n, np.int64)})

        for lang, text, carried in shards(batches, most, held, depth - 1):
            ids, words, brk = numbered(text)
            if not len(ids):
                continue
            h = _hashes(lang, words)
            yield pa.RecordBatch.from_pydict({"lang": [lang], "phrase": [""], "n": pa.array([len(ids) - carried], pa.int64())})
            single = np.bincount(ids[carried:], minlength=len(words) + 1)
            own = np.flatnonzero((single > 0) & _has(full, _bucket(h, bits)))
            own = own[own > 0]
            if len(own):
                yield rows(lang, words, own[:, None], single[own])
            if len(ids) < 2:
                continue
            joined = ~brk[1:-1] & _has(full, _pairs(h, ids, bits))

            def keep(phrase, h=h):
                if phrase.shape[1] != 3:
                    return slice(None)
                return _has(triples.value, np.concatenate([_triples(h, p.ravel(), bits)[::3] for p in np.array_split(
                    phrase, -(-len(phrase) // 100_000))]) if len(phrase) else np.zeros(0, np.int64))
            for part, sign in ((joined, 1), (joined[:max(0, carried - 1)], -1)):  # the carried words were counted before
                if not part.any():
                    continue
                for phrase, n in FmIndex(_stretches(ids[:len(part) + 1], part), depth).phrases(depth, keep):
                    if phrase.shape[1] > 1 and len(n):
                        yield rows(lang, words, phrase, sign * n)
    return run


def phrase_counts(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                  bits: int | None = None) -> DataFrame:
    """(lang, phrase, m, n): every phrase of 1 to ``max_words`` words that
    occurs at least ``min_count`` times, with its number of words and of
    occurrences; for ``m`` = 0 the number of all words of the language."""
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    bits = bucket_bits(docs) if bits is None else bits
    table = share(docs.sparkSession, frequent_buckets(docs, min_count, bits))
    triples = share(docs.sparkSession, frequent_buckets(docs, min_count, bits, table)) if max_words > 2 else None
    found = docs.mapInArrow(_index_shards(table, triples, SHARD_BYTES, HELD_BYTES, bits, max_words),
                            "lang string, phrase string, n long")
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return (found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
            .where((F.col("phrase") == "") | (F.col("n") >= min_count)).withColumn("m", words))


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                 cover_percent: int = COVER_PERCENT, top: int = TOP) -> DataFrame:
    """The best phrases of 2 to ``max_words`` words of each language.

    A phrase with ``a`` >= ``min_count`` occurrences, cut after its first k
    words into parts with ``l`` and ``r`` occurrences, scores ``floor(10^6 a a /
    (l r))``; the weakest cut counts (at equal scores the earliest).  A phrase
    that lies inside a longer one with at least ``cover_percent`` of its
    occurrences goes.  Returns the first ``top`` by score, ``a`` (both falling) and
    phrase: lang, rank, phrase, a, l, r, n, score."""
    counts = materialize(phrase_counts(docs, max_words, min_count))
    total = counts.where("m = 0").select("lang", F.col("n").alias("words"))
    parts = counts.where("m > 0").select("lang", "phrase", "n")
    wide = counts.where("m > 1").select("lang", F.col("phrase").alias("whole"), F.col("n").alias("a"), "m",
                                        F.split("phrase", " ").alias("w"))

    def sub(first, length):
        return F.array_join(F.slice("w", first, length), " ")

    # the two parts are the phrase: no more than they cross the joins
    cuts = wide.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1))).select(
        "lang", "a", sub(F.lit(1), F.col("k")).alias("head"), sub(F.col("k") + 1, F.col("m") - F.col("k")).alias("tail"))
    for side, as_ in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(side), F.col("n").alias(as_)), ["lang", side])
    # 10^6 a a and l r in 38 digits: exact while counts are below 10^16 and 10^19
    a = F.col("a").cast("decimal(16,0)")
    over, under = a * a * F.lit(SCALE).cast("decimal(7,0)"), F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")
    cuts = cuts.withColumn("over", over.cast("decimal(38,0)")).withColumn("under", under.cast("decimal(38,0)"))
    scored = (cuts.withColumn("score", F.expr("over div under")).withColumn("k", F.size(F.split("head", " ")))
              .groupBy("lang", F.concat_ws(" ", "head", "tail").alias("whole"))
              .agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("best")).select("lang", "whole", "best.*"))
    inner = [wide.where(F.col("m") > size).withColumn("at", F.explode(F.sequence(F.lit(1), F.col("m") - size + 1)))
             .select("lang", sub(F.col("at"), F.lit(size)).alias("whole"), F.col("a").alias("longer"))
             for size in range(2, max_words)]
    if inner:
        covered = reduce(DataFrame.unionByName, inner).groupBy("lang", "whole").agg(F.max("longer").alias("longer"))
        scored = scored.join(covered, ["lang", "whole"], "left").where(
            F.col("longer").isNull() | (100 * F.col("longer") < cover_percent * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "whole")
    return (scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .join(total, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), F.col("whole").alias("phrase"), "a", "l", "r",
                    F.col("words").alias("n"), "score"))


ORACLE_SQL = r"""
WITH pieces AS (
    SELECT lang, unnest(regexp_split_to_array(said, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS said
          FROM documents)),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM lists, (SELECT unnest([1, 2, 3]) AS m) WHERE len(w) >= m)),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS n FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
wide AS MATERIALIZED (SELECT lang, m, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND n >= 10),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
         FROM (SELECT *, unnest(range(1, m)) AS k FROM wide)),
scored AS (
    SELECT c.*, x.n AS l, y.n AS r, (1000000::HUGEINT * a * a // (x.n::HUGEINT * y.n))::BIGINT AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covered AS (
    SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT lang, w, a, unnest([1, 2]) AS i FROM wide WHERE m = 3) GROUP BY ALL),
kept AS (
    SELECT s.* FROM weakest s LEFT JOIN covered v ON v.lang = s.lang AND v.phrase = s.phrase
    WHERE v.longer IS NULL OR 100 * v.longer < 50 * s.a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, total.n AS n, score
FROM kept JOIN total ON total.lang = kept.lang
QUALIFY rank <= 2000
"""
