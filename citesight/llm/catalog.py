"""One query per training-data operator: it applies the operator, with
production parameters, to its whole table and returns its full result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import tpch
from . import bpe, chat, collocations, embeddings, fingerprints, langid, lines, mixing, pieces, shingles, spelling, suffixes, urls


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(tpch(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    model = bpe.load(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encode_texts(tpch(spark, sf_dir, "documents", "doc_id", "text"), model)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingles.ngram_groups(tpch(spark, sf_dir, "documents", "doc_id", "text")).drop("_rk")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_dedup(tpch(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_versions(tpch(spark, sf_dir, "documents", "doc_id", "text"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.remove_repeats(tpch(spark, sf_dir, "documents", "doc_id", "text")).drop("rid", "kept")
    return out.withColumn("kept_bytes", F.col("n_bytes") - F.col("n_removed"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(tpch(spark, sf_dir, "documents", "doc_id", "text"))
    kept = F.coalesce(F.col("text"), F.lit(""))
    return out.select("doc_id", "n_lines", "n_deleted", F.length(kept).cast("long").alias("kept_chars"),
                      F.sha2(kept, 256).alias("kept_sha256"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                F.lit(said).alias("text"))
    turns = tpch(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(own)
    return chat.chat_digest(chat.format_chat(turns))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    outcomes = tpch(spark, sf_dir, "labels", "doc_id", "quality", "toxic").select(
        F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return urls.filter_urls(tpch(spark, sf_dir, "pages", "page_id", "url"), outcomes)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tpch(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", langid.held_out())
    model = langid.fit(docs.where(F.col("doc_id").isNotNull() & ~F.col("held_out")))
    out = langid.identify(docs, model, ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(tpch(spark, sf_dir, "documents", "text", "lang"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.corpus_words(tpch(spark, sf_dir, "documents", "doc_id", "text"))
    return spelling.group_variants(spelling.vocabulary(words))


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    model = pieces.load(spark, public_tokenizers.path("piece_bpe_32k.model"))
    out = pieces.encode_texts(tpch(spark, sf_dir, "documents", "doc_id", "text"), model)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
                      F.sha2(F.concat("starts", "ends"), 256).alias("spans_sha256"))


QUERIES = {q.__name__: q for q in (
    op1_mix_sources, op2_byte_bpe, op3_ngram_join, op4_embedding_dedup, op5_fingerprints, op6_suffix_dedup, op7_line_dedup,
    op8_chat_format, op9_url_filter, op10_language_id, op11_collocations, op12_spelling_variants, op13_sentence_pieces)}
ORACLE = {"op1_mix_sources": mixing.ORACLE_SQL, "op7_line_dedup": lines.ORACLE_SQL,
          "op8_chat_format": chat.ORACLE_SQL, "op9_url_filter": urls.ORACLE_SQL,
          "op11_collocations": collocations.ORACLE_SQL, "op12_spelling_variants": spelling.ORACLE_SQL}
