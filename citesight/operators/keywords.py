"""Narrative keywords: tokens, uni+bigrams, a top-N vocabulary, TF-IDF and
the top terms per document.

Tokenising, stop-word removal and bigram building are built-in array
expressions; everything after is a long ``(doc, term, ...)`` table, never a
dense matrix.

Plan shape: the texts are dealt by document, then tokens are exploded and
counted per ``(doc, term)`` without another exchange.  The vocabulary is a ``groupBy(term)`` (partial sums, so a
very common term does not gather in one task) followed by a bounded top-N,
which is what gets broadcast.  Weights are normalised per document with a
window over at most N rows per document.
"""

from __future__ import annotations

import functools
import pkgutil
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import presets
from .joins import scalar


@functools.lru_cache(maxsize=1)
def english_stop_words() -> tuple[str, ...]:
    """The packaged English stop-word list (``data/stopwords_en.txt``)."""
    raw = pkgutil.get_data("citesight", "data/stopwords_en.txt").decode("utf-8")
    return tuple(w for w in raw.splitlines() if w and not w.startswith("#"))


def default_stop_words() -> list[str]:
    return list(dict.fromkeys(list(english_stop_words()) + presets.CUSTOM_STOP_WORDS))


#: Texts that one task counts the terms of; a document may hold so many times its share.
TEXTS_A_TASK = 5_000
MAX_SKEW = 4


def tokens(df: DataFrame, doc: str, text: str, stop_words: Sequence[str] | None = None,
           pattern: str = presets.TFIDF_TOKEN_PATTERN) -> DataFrame:
    """``(doc, _uni)``: tokens matching ``pattern`` (lower-cased) without stop words."""
    sw = list(stop_words) if stop_words is not None else default_stop_words()
    found = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(pattern), F.lit(0))
    return df.select(doc, F.filter(found, lambda t: ~t.isin(sw)).alias("_uni"))


def _with_bigrams(uni: DataFrame, doc: str) -> DataFrame:
    pairs = F.zip_with(F.col("_uni"), F.slice("_uni", F.lit(2), F.greatest(F.size("_uni") - 1, F.lit(0))),
                       lambda a, b: F.concat_ws(" ", a, b))
    bi = F.slice(pairs, F.lit(1), F.greatest(F.size("_uni") - 1, F.lit(0)))
    return uni.select(doc, F.concat(F.col("_uni"), bi).alias("terms"))


def doc_terms(df: DataFrame, doc: str, text: str, stop_words: Sequence[str] | None = None,
              pattern: str = presets.TFIDF_TOKEN_PATTERN) -> DataFrame:
    """``(doc, terms)``: tokens matching ``pattern`` (lower-cased), stop words
    removed, then unigrams followed by bigrams of the remaining tokens."""
    return _with_bigrams(tokens(df, doc, text, stop_words, pattern), doc)


def by_document(df: DataFrame, doc: str) -> DataFrame:
    """The rows of each document in one task, so that its terms are counted
    where they are made.  If a document has far more rows than its share, the rows
    stay where they are, and term counts meet as partial sums."""
    most, rows = df.groupBy(doc).count().agg(F.max("count"), F.sum("count")).first()
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(rows or 0) // TEXTS_A_TASK))
    even = not rows or most <= max(TEXTS_A_TASK, MAX_SKEW * rows / tasks)
    return df.repartition(tasks, doc) if even else df


def _count(terms: DataFrame, doc: str) -> DataFrame:
    # explode_outer + NULL filter: a plain explode makes the optimizer infer a
    # `size(terms) > 0` filter and push the whole text pipeline below the
    # repartition into the scan, where it would run (twice) before spreading.
    return (terms.select(doc, F.explode_outer("terms").alias("term")).where(F.col("term").isNotNull())
            .groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf")))


def term_counts(df: DataFrame, doc: str, text: str, stop_words: Sequence[str] | None = None) -> DataFrame:
    """``(doc, term, tf)`` raw term counts.  What is shuffled are the texts."""
    return _count(doc_terms(by_document(df.select(doc, text), doc), doc, text, stop_words), doc)


def vocabulary(tf: DataFrame, doc: str, size: int = presets.TFIDF_VOCAB_SIZE) -> DataFrame:
    """Top ``size`` terms by corpus count (ties by term), with document
    frequency.  The result is bounded by ``size`` rows."""
    return (tf.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.col(doc)).alias("df"))
            .orderBy(F.desc("total"), F.asc("term")).limit(size))


def tfidf(docs: DataFrame, doc: str, text: str, size: int = presets.TFIDF_VOCAB_SIZE,
          stop_words: Sequence[str] | None = None) -> DataFrame:
    """``(doc, term, tf, weight)`` for vocabulary terms.

    idf = ln((1 + N) / (1 + df)) + 1 with N = all documents (empty ones
    included); weight = tf * idf / L2 norm of the document's vocabulary row.
    """
    from ..session import materialize
    # the tokens feed both the vocabulary and the weights: written once so the text
    # clean-up and tokenising run once; only terms of the vocabulary are weighed
    uni = materialize(tokens(docs, doc, text, stop_words))
    vocab = materialize(vocabulary(_count(_with_bigrams(by_document(uni, doc), doc), doc), doc, size))
    known = [r.term for r in vocab.select("term").collect()]
    tf = _count(_with_bigrams(uni, doc).select(doc, F.filter("terms", lambda t: t.isin(known)).alias("terms")), doc)
    n_docs = scalar(docs, F.count(F.lit(1))).cast("double")
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df").cast("double"))) + F.lit(1.0)
    v = F.broadcast(vocab.select("term", idf.alias("idf")))
    w = tf.join(v, "term").withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(doc)))
    return w.select(doc, "term", "tf", (F.col("_w") / norm).alias("weight"))


def top_keywords(docs: DataFrame, weights: DataFrame, doc: str, n: int = presets.TOP_KEYWORDS,
                 name: str = "TOP_KEYWORDS", pad: bool = False) -> DataFrame:
    """The ``n`` highest-weighted terms of each document joined with ``', '``
    (ties: later term first).  Documents without a vocabulary term get ''.

    With ``pad`` a document with fewer than ``n`` positive terms is filled up
    with zero-weight vocabulary terms, later terms first (the same tie rule),
    so every document lists ``n`` terms when the vocabulary allows.  The
    candidates are the ``2n - 1`` last vocabulary terms (a bounded literal
    list): at most ``n - 1`` of them can already be in the document.
    """
    w = Window.partitionBy(doc).orderBy(F.desc("weight"), F.desc("term"))
    top = (weights.where(F.col("weight") > 0).withColumn("_rn", F.row_number().over(w))
           .where(F.col("_rn") <= n)
           .groupBy(doc).agg(F.sort_array(F.collect_list(F.struct("_rn", "term"))).alias("_t")))
    terms = F.transform("_t", lambda s: s["term"])
    joined = top.select(doc, terms.alias("_terms"))
    out = docs.select(doc).join(joined, doc, "left")
    chosen = F.coalesce(F.col("_terms"), F.array().cast("array<string>"))
    if pad:
        pool = [r["term"] for r in weights.select("term").distinct()
                .orderBy(F.desc("term")).limit(2 * n - 1).collect()]
        fill = F.array_except(F.array(*[F.lit(t) for t in pool]).cast("array<string>"), chosen)
        chosen = F.concat(chosen, F.slice(fill, 1, F.greatest(F.lit(n) - F.size(chosen), F.lit(0))))
    return out.select(doc, F.array_join(chosen, ", ").alias(name))
