"""Spelling variants: words that differ by one character, grouped under the
most frequent form.

The vocabulary is a plain count.  Its words are entered into one blocked Bloom
filter (a word sets a few bits of one 64-bit block), whose blocks are divided
among the lengths.  Each word then makes its own edits: every character left
out, and every character replaced by a later one of the alphabet; that meets
each pair of near words once, as the longer word makes the shorter.  An edit's
hash follows from the hashes of the word's beginnings and ends, so no string is
made unless the filter of the edit's length says yes.  Only these edits are
shuffled, to an exact join with the vocabulary, which removes what the filter
let through by chance.

The filter is broadcast.  If all its blocks are more than ``FILTER_BYTES``,
they are taken in several rounds of at most that size; a round leaves edits
whose block is not in it to the others, so the result is the same.

Defined cases: null and empty texts have no words; a null ``doc_id`` counts as
an empty string where words are marked; words of any length are handled, a
block of places at a time; repeated rows count each time; ties are settled by
the words' order of code points; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, share
from .common import shuffle_partitions, text_or_empty

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 6
MIN_COUNT = 5
FORM_FACTOR = 5           # a form occurs at least so many times as often
DROP_EVERY = 199
BITS_A_WORD = 16
FILTER_BYTES = 16 << 20   # filter broadcast at a time
LENGTHS = 64              # longer words share one part of the filter
PROBES = 1 << 20          # edits hashed at a time
_BASE = np.uint64(0x9E3779B97F4A7C15)


def corpus_words(docs: DataFrame, min_chars: int = MIN_CHARS, drop_every: int | None = DROP_EVERY) -> DataFrame:
    """(word): each run of letters, with A-Z lower-cased.  Where ``drop_every``
    divides the crc32 of ``<doc_id>:<run>``, the run loses the character at that
    number modulo its length (spelling errors at known places).  Runs and results
    of fewer than ``min_chars`` characters are left out."""
    said = F.translate(text_or_empty(), UPPER, LOWER)
    # longer runs only: a run can get shorter, never longer.  (An outer explode: no filter is inferred that reads all texts twice.)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("of"),
                       F.explode_outer(F.regexp_extract_all(said, F.lit(f"({LETTERS}{{{min_chars},}})"))).alias("run"))
    runs = runs.where(F.col("run").isNotNull())
    if drop_every:
        h = F.crc32(F.concat_ws(":", "of", "run"))
        at = (F.col("h") % F.length("run")).cast("int")
        cut = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
        runs = runs.withColumn("h", h).withColumn("at", at).withColumn(
            "run", F.when(F.col("h") % drop_every == 0, cut).otherwise(F.col("run")))
    return runs.where(F.length("run") >= min_chars).select(F.col("run").alias("word"))


def vocabulary(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that occur at least ``min_count`` times."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


# -- hashes --------------------------------------------------------------------
def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places in ``words``, code points) of the words of each length."""
    length = np.array([len(w) for w in words], np.int64)
    for n in np.unique(length[length > 0]):
        at = np.flatnonzero(length == n)
        yield int(n), at, np.frombuffer("".join([words[i] for i in at]).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, n)


def _powers(n: int) -> np.ndarray:
    """base ** 0 .. base ** n, modulo 2^64."""
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE)]), dtype=np.uint64)


def _ends(points: np.ndarray, power: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first 0 .. n characters, and of what follows the first 0 .. n."""
    n = points.shape[1]
    head = np.zeros((len(points), n + 1), np.uint64)
    for i in range(n):
        head[:, i + 1] = head[:, i] * _BASE + points[:, i]
    return head, head[:, n:] - head * power[n - np.arange(n + 1)]


class Blocks:
    """Where a hash lies in the filter, and its bits there."""

    def __init__(self, counts: dict[int, int], bits_a_word: int = BITS_A_WORD):
        self.count = [0] * (LENGTHS + 1)
        for n, words in counts.items():
            self.count[min(n, LENGTHS)] += words
        blocks = [-(-c * bits_a_word // 64) for c in self.count]
        self.first, self.blocks = np.concatenate([[0], np.cumsum(blocks)]).tolist(), blocks

    @property
    def total(self) -> int:
        return self.first[-1]

    def find(self, h: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        part = min(length, LENGTHS)
        h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        block = (h >> np.uint64(32)) * np.uint64(self.blocks[part]) >> np.uint64(32)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        one, bits = np.uint64(1), np.zeros(len(h), np.uint64)
        for k in (58, 52, 46, 40):
            bits |= one << (h >> np.uint64(k) & np.uint64(63))
        return block.astype(np.int64) + self.first[part], bits


def _entries(blocks: Blocks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, _, points in _by_length(b.column("word").to_pylist()):
                block, bits = blocks.find(_ends(points, _powers(n))[0][:, n], n)
                yield pa.RecordBatch.from_pydict({"block": block, "bits": bits.view(np.int64)})
    return run


# -- edits -----------------------------------------------------------------------
def _edits(points: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, hashes, rows, places, new characters; 0 for one left out) of the
    edits of words of one length.  A character left out of a run of equal ones
    counts once; a character is replaced by greater ones only."""
    n = points.shape[1]
    power = _powers(n)
    wide = points.astype(np.uint64)
    step = max(1, PROBES // (n * (len(alphabet) + 1)))
    for at in range(0, len(points), step):
        part = wide[at:at + step]
        head, tail = _ends(part, power)
        places = max(1, PROBES // (len(part) * (len(alphabet) + 1)))
        for i in range(0, n, places):
            upto = min(n, i + places)
            k = np.arange(i, upto)
            here = part[:, i:upto]
            if n > 1:
                first = np.ones(here.shape, bool)
                same = part[:, max(i, 1):upto] == part[:, max(i, 1) - 1:upto - 1]
                first[:, max(i, 1) - i:] = ~same
                row, col = np.nonzero(first)
                h = (head[:, k] * power[n - 1 - k] + tail[:, k + 1])[row, col]
                yield n - 1, h, row + at, col + i, np.zeros(len(row), np.uint32)
            row, col, letter = np.nonzero(alphabet[None, None, :] > here[:, :, None])
            whole = head[:, n]
            h = whole[row] + (alphabet[letter] - here[row, col]) * power[n - 1 - k][col]
            yield n, h, row + at, col + i, alphabet[letter].astype(np.uint32)


def _probe(blocks: Blocks, shared, low: int):
    """Edits that the blocks from ``low`` on may hold: (word, n, near)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, alphabet = shared.value["table"], shared.value["alphabet"]
        for b in batches:
            words, count = b.column("word").to_pylist(), b.column("n").to_numpy()
            for _, at, points in _by_length(words):
                for length, h, row, place, letter in _edits(points, alphabet):
                    if not blocks.blocks[min(length, LENGTHS)]:
                        continue
                    block, bits = blocks.find(h, length)
                    block -= low
                    inside = np.flatnonzero((block >= 0) & (block < len(table)))
                    hit = inside[table[block[inside]] & bits[inside] == bits[inside]]
                    if not len(hit):
                        continue
                    of = at[row[hit]]
                    near = [words[w][:k] + (chr(c) if c else "") + words[w][k + 1:]
                            for w, k, c in zip(of.tolist(), place[hit].tolist(), letter[hit].tolist())]
                    yield pa.RecordBatch.from_pydict({"word": pa.array([words[w] for w in of.tolist()], pa.string()),
                                                      "n": count[of], "near": pa.array(near, pa.string())})
    return run


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_pydict({"point": pa.array([ord(c) for c in set("".join(b.column("word").to_pylist()))], pa.int64())})


def near_pairs(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n): each unordered pair of words of the vocabulary
    ``words`` (word, n) that differ by one character, once."""
    spark = words.sparkSession
    blocks = Blocks({r.size: r.words for r in words.groupBy(F.least(F.length("word"), F.lit(LENGTHS)).alias("size"))
                     .agg(F.count("*").alias("words")).collect()})
    letters = words.mapInArrow(_points, "point long").distinct().collect()  # at most one row per code point of the language(s)
    alphabet = np.sort(np.array([r.point for r in letters], np.uint64))
    spread = words.repartition(max(shuffle_partitions(words), spark.sparkContext.defaultParallelism), "word")
    most = max(1, filter_bytes // 8)
    entries = words.select("word").mapInArrow(_entries(blocks), "block long, bits long")
    entries = entries.groupBy("block").agg(F.bit_or("bits").alias("bits"))
    if blocks.total > most:
        entries = materialize(entries)
    found = None
    for low in range(0, max(1, blocks.total), most):
        held = min(most, blocks.total - low)
        table = np.zeros(max(1, held), np.uint64)
        got = entries.where((F.col("block") >= low) & (F.col("block") < low + most)).toArrow()  # at most filter_bytes / 8 rows
        table[got.column("block").to_numpy() - low] = got.column("bits").to_numpy().view(np.uint64)
        part = spread.mapInArrow(_probe(blocks, share(spark, {"table": table, "alphabet": alphabet}), low),
                                 "word string, n long, near string")
        found = part if found is None else found.unionByName(part)
    return found.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")


def group_variants(words: DataFrame, factor: int = FORM_FACTOR, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """For each word of the vocabulary ``words`` (word, n): its number of near
    words (``n_near``), its ``form``, the near word of largest n (ties: the
    smallest) if that is at least ``factor`` times its own n, ``form_n``, and
    its ``root``, where following forms ends (the word itself without one)."""
    words = materialize(words.select("word", "n"))
    pairs = near_pairs(words, filter_bytes)

    def side(word: str, near: str, near_n: str) -> Column:
        return F.struct(F.col(word).alias("word"), F.col(near).alias("near"), F.col(near_n).alias("near_n"))

    both = pairs.select(F.explode(F.array(side("word", "near", "near_n"), side("near", "word", "n"))).alias("x")).select("x.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    has_form = -F.col("best.less") >= factor * F.col("n")
    out = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best.near")).alias("form"), F.when(has_form, -F.col("best.less")).alias("form_n")))
    links = out.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    # each form is ``factor`` times as frequent as what it stands for, which bounds the steps; their number doubles each time
    most = out.agg(F.max("n")).first()[0] or 1
    steps = math.log(most, factor) if factor > 1 else out.count()
    for _ in range(max(0, math.ceil(math.log2(max(1, steps)))) + 1):
        links = materialize(links)
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        links = links.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"))
    return (out.join(links, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


ORACLE_SQL = r"""
WITH RECURSIVE crc AS MATERIALIZED (
    SELECT list(c ORDER BY b) AS t
    FROM (SELECT b, list_reduce(list_prepend(b, range(8)),
                                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
          FROM range(256) r(b))),
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-z\x{00C0}-\x{00FF}]{6,}')) AS run
    FROM documents),
counted AS MATERIALIZED (SELECT doc_id, run, count(*) AS c FROM runs GROUP BY ALL),
hashed AS (
    SELECT run, c, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
               string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
               lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)] ELSE [195, ord(x) - 64] END))),
               lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h
    FROM counted, crc),
cut AS (
    SELECT c, CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                   ELSE run END AS word
    FROM hashed),
vocab AS MATERIALIZED (
    SELECT word, sum(c)::BIGINT AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
holes AS MATERIALIZED (
    SELECT word, n, i, left(word, i - 1) AS head, substr(word, i + 1) AS tail
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
near AS MATERIALIZED (
    SELECT a.word, b.word AS near, b.n AS near_n
    FROM holes a JOIN holes b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
    UNION SELECT h.word, v.word, v.n FROM holes h JOIN vocab v ON v.word = h.head || h.tail
    UNION SELECT v.word, h.word, h.n FROM holes h JOIN vocab v ON v.word = h.head || h.tail),
best AS (
    SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word),
formed AS MATERIALIZED (
    SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 5 * v.n THEN b.near END AS form,
           CASE WHEN b.near_n >= 5 * v.n THEN b.near_n END AS form_n
    FROM vocab v LEFT JOIN best b ON b.word = v.word),
walk AS (
    SELECT word, word AS at, form AS next FROM formed
    UNION ALL SELECT w.word, f.word, f.form FROM walk w JOIN formed f ON f.word = w.next)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk w ON w.word = f.word AND w.next IS NULL
"""
