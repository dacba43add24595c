"""Mixing sources to target weights (Efraimidis-Spirakis sampling).

Each source gets a word target: its weight's share of all words, at most
``max_epochs`` times its own words, the excess shared out again by weight
until no source is above (water filling).  A source is taken in complete
epochs first; the rest of its target is filled with documents in ascending
order of the exponential key ``-ln(u) / quality`` (``u`` hashed from the row,
so reruns agree), prefix-summed to the remaining budget.

No source is ever sorted in one task: the key is cut into ranges, the words of
each range are summed (partial aggregates), and only the range in which the
budget runs out is cut further, until it holds few rows.

Defined cases: null text has size 0; a null source is a source of its own,
ordered last; rows with equal doc_id, source and size share a key and are taken
together; an empty table gives an empty result; a source without words gets
target 0; input columns with the names of the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import bounded, text_or_empty

WORD = "[^\\x20\\x09-\\x0D]+"
KEY_BITS = 50
LEVEL_BITS = 10
#: A range of keys with at most this many rows is sorted as it is.
SORT_ROWS = 10_000


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def density_quality(text: str, size: Column) -> Column:
    """A quality weight in (0, 1]: 1 for prose of six characters a word, less
    for very long or very short words."""
    per_word = F.length(text_or_empty(text)).cast("double") / size.cast("double")
    return F.when(size > 0, F.lit(1.0) / (F.lit(1.0) + F.abs(per_word - 6.0) / 6.0)).otherwise(F.lit(0.5))


def exponential_key(quality: Column, *parts: Column) -> Column:
    """``-ln(u) / quality``, mapped in the same order onto 50-bit integers."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])), 1, 13),
               16, 10).cast("double")
    u = (h + 0.5) / F.lit(float(1 << 52))
    return F.floor((F.lit(1.0) - F.exp(F.log(u) / quality)) * F.lit(float(1 << KEY_BITS))).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0,
                   max_epochs: int = 3) -> DataFrame:
    """``(source, source_size)`` -> + ``target``.  Sources are ordered by code
    point, null last, and take ``weights`` in turn.  One row per source: the
    unpartitioned windows see the list of sources, never documents."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    by_ratio = Window.orderBy(F.col("source_size") / F.col("_w"), "_i")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("_i") % len(weights) + 1).cast("int"))
    d = (sizes.withColumn("_i", F.row_number().over(order) - 1).withColumn("_w", w.cast("long"))
         .withColumn("_t", F.floor(F.sum("source_size").over(everything) * F.lit(float(share))).cast("long"))
         .withColumn("_wt", F.sum("_w").over(everything))
         .withColumn("_sb", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
         .withColumn("_wb", F.coalesce(F.sum("_w").over(before), F.lit(0)))
         .withColumn("_cap", F.col("source_size") * max_epochs))
    # full sources come first in this order: the budget left per weight only grows
    full = F.col("_cap") * (F.col("_wt") - F.col("_wb")) <= F.col("_w") * (F.col("_t") - max_epochs * F.col("_sb"))
    d = d.withColumn("_full", full)
    left = F.col("_t") - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0)).over(everything)
    open_w = F.sum(F.when(F.col("_full"), 0).otherwise(F.col("_w"))).over(everything)
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(
        (F.col("_w") * left).cast("double") / F.greatest(open_w, F.lit(1)).cast("double"))
    return d.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0, max_epochs: int = 3,
                quality: str | None = None) -> DataFrame:
    """``docs`` + ``size``, ``source_size``, ``target``, ``copies`` (times the
    mix takes the row; 0 to ``max_epochs``).  ``quality`` names a column of
    positive weights; without it the word density of the text is used."""
    added = ["size", "source_size", "target", "copies"]
    size = word_count()
    q = F.greatest(F.col(quality).cast("double"), F.lit(1e-6)) if quality else density_quality("text", F.col("size"))
    base = docs.drop(*added).withColumn("size", size)
    base = base.withColumn("_e", exponential_key(q, F.col("doc_id"), F.col("source"), F.col("size")))
    slim = materialize(base.select("source", "size", "_e"))

    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(sizes, weights, share, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = (plan.withColumn("epochs", epochs.cast("int"))
            .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    plan = bounded(plan.coalesce(1))

    state = plan.where("rest > 0").select(
        F.col("source").alias("_s"), "rest", F.lit(0).cast("long").alias("_lo"),
        F.lit(1 << KEY_BITS).cast("long").alias("_hi"), F.lit(0).cast("long").alias("_before"))
    for level in range(1, KEY_BITS // LEVEL_BITS + 1):
        width = 1 << (KEY_BITS - level * LEVEL_BITS)
        inside = _inside(slim, state)
        sums = inside.groupBy("_s", "rest", "_before", F.floor(F.col("_e") / width).alias("_b")).agg(
            F.sum("size").alias("_sum"), F.count(F.lit(1)).alias("_n"))
        w = Window.partitionBy("_s").orderBy("_b")
        sums = sums.withColumn("_end", F.col("_before") + F.sum("_sum").over(w))
        cut = sums.where(F.col("_end") >= F.col("rest")).groupBy("_s", "rest").agg(
            F.min(F.struct("_b", (F.col("_end") - F.col("_sum")).alias("before"), "_n")).alias("_m"))
        state = bounded(cut.select(
            "_s", "rest", (F.col("_m._b") * width).cast("long").alias("_lo"),
            ((F.col("_m._b") + 1) * width).cast("long").alias("_hi"), F.col("_m.before").alias("_before"),
            F.col("_m._n").alias("_n")).coalesce(1))
        most = state.agg(F.max("_n")).first()[0]
        if most is None or most <= SORT_ROWS:
            break
    ties = _inside(slim, state).groupBy("_s", "rest", "_before", "_lo", "_e").agg(F.sum("size").alias("_sum"))
    w = Window.partitionBy("_s").orderBy("_e")
    ties = ties.withColumn("_at", F.col("_before") + F.sum("_sum").over(w) - F.col("_sum"))
    taken = (F.col("_at") < F.col("rest")) & (2 * F.col("_at") + F.col("_sum") <= 2 * F.col("rest"))
    cutoff = ties.groupBy("_s").agg(
        F.coalesce(F.max(F.when(taken, F.col("_e"))), F.min("_lo") - 1).alias("_cut"))
    plan = bounded(plan.join(cutoff, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        F.col("source").alias("_s"), "source_size", "target", "epochs", "_cut").coalesce(1))
    out = base.join(plan, base["source"].eqNullSafe(plan["_s"]), "left")
    extra = F.when(F.col("_e") <= F.col("_cut"), 1).otherwise(0)
    return out.withColumn("copies", (F.col("epochs") + extra).cast("int")).drop("_s", "_cut", "_e", "epochs")


def _inside(slim: DataFrame, state: DataFrame) -> DataFrame:
    """Rows in the open key range of their source."""
    return slim.join(state, slim["source"].eqNullSafe(state["_s"])).where(
        (F.col("_e") >= F.col("_lo")) & (F.col("_e") < F.col("_hi")))


ORACLE_SQL = """
WITH b AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    length(coalesce(text, '')) AS chars FROM documents),
k AS (
  SELECT *, CASE WHEN size > 0 THEN 1.0::DOUBLE / (1.0::DOUBLE + abs(chars::DOUBLE / size::DOUBLE - 6.0::DOUBLE) / 6.0::DOUBLE)
      ELSE 0.5::DOUBLE END AS q,
    (('0x' || md5(coalesce(doc_id::VARCHAR, '~') || '|' || coalesce(source, '~') || '|' || size::VARCHAR)[1:13])::BIGINT::DOUBLE
      + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM b),
e AS (SELECT *, floor((1.0::DOUBLE - exp(ln(u) / q)) * 1125899906842624.0::DOUBLE)::BIGINT AS e FROM k),
s AS (SELECT source, sum(size)::BIGINT AS s FROM e GROUP BY 1),
i AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM s),
w AS (SELECT *, (i % 3) + 1 AS w FROM i),
t AS (SELECT *, sum(s) OVER () AS t, sum(w) OVER () AS wt,
    coalesce(sum(s) OVER (ORDER BY s::DOUBLE / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sb,
    coalesce(sum(w) OVER (ORDER BY s::DOUBLE / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wb FROM w),
f AS (SELECT *, 3 * s * (wt - wb) <= w * (t - 3 * sb) AS full_ FROM t),
g AS (SELECT source, s, CASE WHEN full_ THEN (3 * s)::DOUBLE ELSE
    (w * (t - sum(CASE WHEN full_ THEN 3 * s ELSE 0 END) OVER ()))::DOUBLE
    / greatest(sum(CASE WHEN full_ THEN 0 ELSE w END) OVER (), 1)::DOUBLE END AS target FROM f),
p AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END AS epochs FROM g),
r AS (SELECT *, target - epochs * s AS rest FROM p),
u AS (SELECT source, e, sum(size) AS sz FROM e GROUP BY 1, 2),
v AS (SELECT *, sum(sz) OVER (PARTITION BY source ORDER BY e) - sz AS at_ FROM u),
x AS (SELECT v.source, v.e, v.at_ < r.rest AND 2 * v.at_ + v.sz <= 2 * r.rest AS extra
      FROM v JOIN r ON v.source IS NOT DISTINCT FROM r.source)
SELECT e.doc_id, e.size, r.s AS source_size, r.target,
  (e.size * (r.epochs + CASE WHEN x.extra THEN 1 ELSE 0 END))::BIGINT AS taken
FROM e JOIN r ON e.source IS NOT DISTINCT FROM r.source
  JOIN x ON x.source IS NOT DISTINCT FROM e.source AND x.e = e.e
"""
