"""One query per operator over the whole of its table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    exact_dedup,
    hard_negatives,
    html_extract,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    suffix_dedup,
    token_alignment,
    token_output,
    toxicity,
    winnowing,
)
from .common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents"), keep="largest")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_texts(table(spark, sf_dir, "pages"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, spans = suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"), keep="none")
    return suffix_dedup.remove_spans(rows, spans).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), capacity=1024, end_id=2)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = ngram_join.jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)
    return found


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprint_edits(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_on(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= toxicity.CUT).cast("int").alias("predicted"),
    )


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # only the token count of the text is carried through the selection
    slim = docs.select("doc_id", "lang", "source", mixing.tokens_of(F.col("text")).alias("tokens"))
    return mixing.mix(slim, tokens=F.col("tokens")).select(
        "doc_id",
        F.col("_mix_domain").alias("domain"),
        F.coalesce("lang", F.lit("none")).alias("lang"),
        F.coalesce("source", F.lit("none")).alias("source"),
        "tokens",
        F.col("_mix_epoch").alias("epoch"),
    )


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, files = token_output.write_tokens(
        table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1
    )
    return token_output.read_tokens(folder, files)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), label)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = token_alignment.align(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    )
    return documents


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, path, "doc_id", "n_tokens").select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_html_extraction,
        op3_suffix_dedup,
        op4_best_fit_packing,
        op5_line_dedup,
        op6_ngram_jaccard_join,
        op7_document_fingerprints,
        op8_toxicity,
        op9_source_mixing,
        op10_token_output,
        op11_hard_negatives,
        op12_token_alignment,
        op13_byte_bpe,
    )
}

ORACLE_SQL = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op9_source_mixing": mixing.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
}
