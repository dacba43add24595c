"""The training-data pipeline: documents in, token ids out.

Stages, each written as Parquet and read again before the next: language ID
(documents it rejects go), line dedup (later repeated runs of lines go, and
documents of which nothing is left), n-gram Jaccard join (one document of each
group of near copies stays), mixing of the sources to their target weights
(a document appears as often as the mix takes it), byte-level BPE.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citesight.llm import bpe, langid, lines, mixing, shingles
from citesight.session import materialize
from citesight.sources.tables import tpch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is recognised; the models learn from all
    documents with a language."""
    model = langid.fit(docs)
    return langid.identify(docs, model, docs.columns).where("accepted").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(docs).where((F.col("n_lines") == 0) | (F.col("n_deleted") < F.col("n_lines")))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shingles.drop_near_duplicates(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(docs).where("copies > 0")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    # the same executors ran the stages before: less is remembered than by default
    model = bpe.load(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                     max_pieces=100_000, max_states=60_000)
    return bpe.encode_texts(docs.select("doc_id", "text", "lang", "source"), model, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("ngram_join", ngram_join),
    ("mix_sources", mix_sources), ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tpch(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Kneser-Ney models, sampled tokens and merges are not SQL; tests/llm compares
#: with brute force instead.
ORACLE_SQL = None
