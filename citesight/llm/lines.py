"""Line dedup by winnowing over line hashes.

Two consecutive lines (of ``MIN_PAIR_CHARS`` together) make a gram; of each
window of ``WINDOW`` grams the smallest is kept as a fingerprint (rightmost of
equals), so two texts that share a run of ``WINDOW + 1`` lines or more share a
fingerprint; a line of ``LONG_LINE`` characters is a fingerprint of its own, and
so is a gram of two shorter lines that have as many together: a shared run of
``LONG_LINE`` characters is found however few lines it has.  Where two lines have
fewer than ``MIN_PAIR_CHARS`` together, the gram spans as many lines as reach
them (blank ones count by their place only), and each such gram is a fingerprint.
Each fingerprint is joined with its earliest place; the match is extended in
both directions along the two documents, and the later run is deleted: every
line that equals its counterpart and is long or is of a run of two equal lines or
more that has ``MIN_PAIR_CHARS`` as a whole.  A spanning gram that a document has
again is matched with its place before in that document, so that a document of
equal short lines has one diagonal and not one for each line.

Documents are ordered by (doc_id, text hash), null doc_id first.  Only hashes
and positions move until the last join; a fingerprint that a third of all
documents share is joined with one place, never with all its others, and that
join can be split by Spark's skew handling (both sides are plain exchanges).

Defined cases: null text stays null with no lines; empty text is one empty
line; rows equal in doc_id and text are one document and get equal results;
clashing extra columns are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import hash60

WINDOW = 2
LONG_LINE = 200
MIN_PAIR_CHARS = 40
_NONE = (1 << 62) - 1


def lines(text: str = "text") -> Column:
    return F.split(F.col(text), "\n", -1)


def _row_key() -> tuple[Column, Column]:
    th = hash60(F.col("text"))
    return th, F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), th.cast("string"))


def _grams(h: Column, n: Column) -> Column:
    at = F.sequence(F.lit(1), F.size(h) - 1)
    gram = F.transform(at, lambda i: F.when(
        F.get(n, i - 1) + F.get(n, i) >= MIN_PAIR_CHARS,
        hash60(F.concat_ws("|", F.get(h, i - 1), F.get(h, i)))).otherwise(F.lit(_NONE)))
    return F.when(F.size(h) > 1, gram).otherwise(F.array().cast("array<bigint>"))


def _fingerprints(h: Column, n: Column, g: Column, window: int) -> Column:
    """Kinds (2: gram, 1: long line), hashes and positions (from 1)."""
    def least(part: Column, start: Column) -> Column:
        return (start + F.size(part) - F.array_position(F.reverse(part), F.array_min(part))).cast("int")

    starts = F.sequence(F.lit(1), F.greatest(F.size(g) - window + 1, F.lit(1)))
    chosen = F.when(F.size(g) > 0, F.array_distinct(
        F.transform(starts, lambda s: least(F.slice(g, s, F.lit(window)), s)))).otherwise(
            F.array().cast("array<int>"))

    def long_pair(i: Column) -> Column:
        a, b = F.get(n, i - 1), F.get(n, i)
        return (a < LONG_LINE) & (b < LONG_LINE) & (a + b >= LONG_LINE)

    every = F.when(F.size(g) > 0, F.sequence(F.lit(1), F.size(g))).otherwise(F.array().cast("array<int>"))
    chosen = F.array_union(chosen, F.filter(every, long_pair))
    of_grams = F.filter(F.transform(chosen, lambda i: F.struct(
        F.lit(2).alias("kind"), F.get(g, i - 1).alias("hash"), i.alias("i"))), lambda s: s["hash"] != _NONE)
    of_lines = F.filter(F.transform(h, lambda x, i: F.struct(
        F.lit(1).alias("kind"), x.alias("hash"), (i + 1).cast("int").alias("i"))),
        lambda s: F.get(n, s["i"] - 1) >= LONG_LINE)
    return F.concat(of_grams, of_lines)


def _spans(h: Column, n: Column, p: Column) -> Column:
    """Kind 3: grams from each line that is too short with its next one, over
    the lines (of ``p``, those not blank) that reach ``MIN_PAIR_CHARS``."""
    def gram(k: Column) -> Column:
        start = F.get(p, k - 1)
        none = F.struct(F.lit(0).cast("bigint").alias("chars"), F.lit("").alias("key"))
        return F.aggregate(F.slice(p, k, F.lit(MIN_PAIR_CHARS)), none, lambda a, i: F.when(
            a["chars"] >= MIN_PAIR_CHARS, a).otherwise(F.struct(
                (a["chars"] + F.get(n, i)).cast("bigint").alias("chars"),
                F.concat_ws("|", a["key"], F.get(h, i), i - start).alias("key"))),
            lambda a: F.when(a["chars"] >= MIN_PAIR_CHARS, hash60(a["key"])))

    every = F.when(F.size(p) > 0, F.sequence(F.lit(1), F.size(p))).otherwise(F.array().cast("array<int>"))
    short = F.filter(every, lambda k: F.get(n, F.get(p, k - 1)) + F.get(n, F.get(p, k - 1) + 1) < MIN_PAIR_CHARS)
    return F.filter(F.transform(short, lambda k: F.struct(
        F.lit(3).alias("kind"), gram(k).alias("hash"), (F.get(p, k - 1) + 1).cast("int").alias("i"))),
        lambda s: s["hash"].isNotNull())


def repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``_rk`` (row key) and ``_del``: positions (from 0) of the lines to delete."""
    th, rk = _row_key()
    hashed = docs.where(F.col("text").isNotNull()).select(
        "doc_id", th.alias("_th"), rk.alias("_rk"), F.transform(lines(), hash60).alias("_h"),
        F.transform(lines(), F.length).alias("_n")).dropDuplicates(["_rk"])
    # written with the grams: what a lambda reads is then a stored column, not
    # an expression that each of its calls would evaluate again; for the same
    # reason explode_outer, from which no filter on its input is inferred
    hashed = hashed.withColumn("_g", _grams(F.col("_h"), F.col("_n")))
    hashed = hashed.withColumn("_p", F.filter(F.transform("_n", lambda n, i: F.when(n > 0, i)), lambda i: i.isNotNull()))
    hashed = materialize(hashed)

    def exploded(found: Column) -> DataFrame:
        return hashed.withColumn("_f", F.explode_outer(found)).where("_f is not null").select(
            "_f.kind", "_f.hash", "doc_id", "_th", "_rk", "_f.i")

    h, n = F.col("_h"), F.col("_n")
    before = F.lag("i").over(Window.partitionBy("hash", "_rk").orderBy("i"))
    every = exploded(_fingerprints(h, n, F.col("_g"), window)).withColumn("_before", F.lit(None).cast("int"))
    every = materialize(every.unionByName(exploded(_spans(h, n, F.col("_p"))).withColumn("_before", before)))
    fps = every.where("_before is null")
    again = every.where("_before is not null").select("_rk", F.col("_rk").alias("_ek"), (F.col("i") - F.col("_before")).alias("_d"))
    place = F.struct("doc_id", "_th", "i", "_rk")
    first = materialize(fps.groupBy("kind", "hash").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_c"))
                        .where("_c > 1").select("kind", "hash", "_first"))
    pairs = fps.join(first, ["kind", "hash"]).where(
        (F.col("_rk") != F.col("_first._rk")) | (F.col("i") != F.col("_first.i")))
    diagonals = pairs.select("_rk", F.col("_first._rk").alias("_ek"), (F.col("i") - F.col("_first.i")).alias("_d")).union(again).distinct()
    # written, so that both sides of the next joins are plain exchanges, which Spark can split
    diagonals = materialize(diagonals)
    x = diagonals.join(hashed.select("_rk", "_h", "_n"), "_rk").join(
        hashed.select(F.col("_rk").alias("_ek"), F.col("_h").alias("_eh")), "_ek")

    def equal(i: Column) -> Column:
        return F.coalesce(F.get("_h", i) == F.get(F.col("_eh"), i - F.col("_d")), F.lit(False))

    def chars(r: Column) -> Column:
        return F.aggregate(F.slice("_n", r["a"] + 1, r["z"] - r["a"] + 1), F.lit(0).cast("bigint"), lambda t, n: t + n)

    def runs(ends: Column) -> Column:
        found = F.transform(F.sequence(F.lit(1), F.size(ends) - 1), lambda k: F.struct(
            (F.get(ends, k - 1) + 1).alias("a"), (F.get(ends, k) - 1).alias("z")))
        return F.filter(found, lambda r: (r["a"] < r["z"]) & (chars(r) >= MIN_PAIR_CHARS))

    lo = F.greatest(F.lit(0), F.col("_d"))
    hi = F.least(F.size("_h"), F.size("_eh") + F.col("_d")) - 1
    at = F.sequence(lo, hi)
    ends = F.concat(F.array(lo - 1), F.filter(at, lambda i: ~equal(i)), F.array(hi + 1))
    # transform() over an array of one: its lambda reads the ends as a value
    in_runs = F.flatten(F.transform(F.flatten(F.transform(F.array(ends), runs)), lambda r: F.sequence(r["a"], r["z"])))
    hit = F.array_union(in_runs, F.filter(at, lambda i: equal(i) & (F.get("_n", i) >= LONG_LINE)))
    gone = x.select("_rk", F.explode_outer(hit).alias("_i")).where("_i is not null")
    return materialize(gone.groupBy("_rk").agg(F.collect_set("_i").alias("_del")))


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with later repeated runs of lines taken out of ``text``;
    ``n_lines`` and ``n_deleted`` are added."""
    docs = docs.drop("n_lines", "n_deleted", "_rk", "_del", "_ls")
    gone = repeated_lines(docs, window)
    # texts cross the join split into lines, so that taking one out by its
    # position below doesn't split the text again; the positions are the side
    # that is hashed, so texts are not sorted
    split = docs.withColumn("_rk", _row_key()[1]).withColumn("_ls", lines()).drop("text")
    joined = split.join(gone.hint("shuffle_hash"), "_rk", "left")
    n = F.coalesce(F.size("_ls"), F.lit(0))
    keep = F.array_except(F.sequence(F.lit(0), n - 1), F.col("_del"))
    kept = F.when(F.col("_del").isNull(), F.col("_ls")).otherwise(F.transform(keep, lambda i: F.get("_ls", i)))
    out = (joined.withColumn("n_lines", F.when(F.col("_ls").isNull(), 0).otherwise(n).cast("long"))
           .withColumn("n_deleted", F.coalesce(F.size("_del"), F.lit(0)).cast("long"))
           .withColumn("text", F.array_join(kept, "\n")))
    return out.select(*docs.columns, "n_lines", "n_deleted")


ORACLE_SQL = f"""
WITH t AS (SELECT DISTINCT doc_id, text, ('0x' || md5(text)[1:15])::BIGINT AS th FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, th, unnest(string_split(text, chr(10))) AS ln,
  generate_subscripts(string_split(text, chr(10)), 1) AS i FROM t),
h AS (SELECT doc_id, th, i, ('0x' || md5(ln)[1:15])::BIGINT AS h, length(ln) AS n FROM l),
g AS (SELECT *, CASE WHEN n + lead(n) OVER d >= {MIN_PAIR_CHARS}
    THEN ('0x' || md5(h || '|' || lead(h) OVER d)[1:15])::BIGINT ELSE {_NONE} END AS g,
  lead(n) OVER d AS nn, count(*) OVER (PARTITION BY doc_id, th) AS m FROM h WINDOW d AS (PARTITION BY doc_id, th ORDER BY i)),
w AS (SELECT *, lag(g) OVER d AS gp, lead(g) OVER d AS gn FROM g WHERE i < m WINDOW d AS (PARTITION BY doc_id, th ORDER BY i)),
f AS (SELECT 2 AS kind, g AS hash, doc_id, th, i FROM w WHERE g <> {_NONE} AND (m = 2 OR g <= gp OR g < gn
    OR (n < {LONG_LINE} AND nn < {LONG_LINE} AND n + nn >= {LONG_LINE}))
  UNION ALL SELECT 1, h, doc_id, th, i FROM h WHERE n >= {LONG_LINE}),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, th ORDER BY i) AS k
  FROM (SELECT *, lead(n) OVER (PARTITION BY doc_id, th ORDER BY i) AS nx FROM h) WHERE n > 0),
s AS (SELECT a.doc_id, a.th, a.i, b.i AS j, b.h, b.n, sum(b.n) OVER (PARTITION BY a.doc_id, a.th, a.i ORDER BY b.k) AS upto
  FROM b a JOIN b ON b.doc_id IS NOT DISTINCT FROM a.doc_id AND b.th = a.th AND b.k BETWEEN a.k AND a.k + {MIN_PAIR_CHARS - 1}
  WHERE a.n + a.nx < {MIN_PAIR_CHARS}),
spans AS (SELECT doc_id, th, i, ('0x' || md5(string_agg('|' || h || '|' || (j - i), '' ORDER BY j))[1:15])::BIGINT AS hash
  FROM s WHERE upto - n < {MIN_PAIR_CHARS} GROUP BY ALL HAVING max(upto) >= {MIN_PAIR_CHARS}),
o AS (SELECT 3 AS kind, hash, doc_id, th, i, lag(i) OVER (PARTITION BY hash, doc_id, th ORDER BY i) AS before FROM spans),
p AS (SELECT kind, hash, doc_id, th, i FROM f UNION ALL SELECT kind, hash, doc_id, th, i FROM o WHERE before IS NULL),
e AS (SELECT kind, hash, doc_id AS ed, th AS et, i AS ei FROM p
  QUALIFY row_number() OVER (PARTITION BY kind, hash ORDER BY doc_id NULLS FIRST, th, i) = 1),
x AS (SELECT doc_id, th, ed, et, i - ei AS d FROM p JOIN e USING (kind, hash)
  WHERE NOT (doc_id IS NOT DISTINCT FROM ed AND th = et AND i = ei)
  UNION SELECT doc_id, th, doc_id, th, i - before FROM o WHERE before IS NOT NULL),
q AS (SELECT x.doc_id, x.th, x.ed, x.et, x.d, a.i, a.n FROM x
  JOIN h a ON a.doc_id IS NOT DISTINCT FROM x.doc_id AND a.th = x.th
  JOIN h b ON b.doc_id IS NOT DISTINCT FROM x.ed AND b.th = x.et AND b.i = a.i - x.d AND b.h = a.h),
r AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, th, ed, et, d ORDER BY i) AS run FROM q),
z AS (SELECT *, count(*) OVER w AS run_lines, sum(n) OVER w AS run_chars FROM r WINDOW w AS (PARTITION BY doc_id, th, ed, et, d, run)),
gone AS (SELECT DISTINCT doc_id, th, i FROM z
  WHERE n >= {LONG_LINE} OR (run_lines > 1 AND run_chars >= {MIN_PAIR_CHARS})),
k AS (SELECT l.doc_id, l.th, count(*) AS n_lines, count(gone.i) AS n_deleted,
  coalesce(string_agg(CASE WHEN gone.i IS NULL THEN ln END, chr(10) ORDER BY l.i), '') AS kept
  FROM l LEFT JOIN gone ON gone.doc_id IS NOT DISTINCT FROM l.doc_id AND gone.th = l.th AND gone.i = l.i GROUP BY 1, 2)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_deleted, 0) AS n_deleted,
  coalesce(length(k.kept), 0) AS kept_chars, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN k ON k.doc_id IS NOT DISTINCT FROM d.doc_id AND k.th = ('0x' || md5(d.text)[1:15])::BIGINT"""
