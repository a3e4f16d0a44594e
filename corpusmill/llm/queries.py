"""Queries of the subpackage and their SQL, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import (
    cover_tree,
    importance,
    jaccard,
    langid,
    licenses,
    lm_scoring,
    merkle,
    nn_descent,
    packing,
    periodic_runs,
    piece_bpe,
    repeats,
    token_counts,
)
from corpusmill.llm.common import table


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles agree to 90 %."""
    return jaccard.join_components(table(spark, sf_dir, "documents"), words=3, percent=90)


def op3_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids and decoded text of every document, as digests."""
    return piece_bpe.encode_decode(table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op4_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op6_dual_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every 20th vector with all others."""
    return cover_tree.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20, scale=64)


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of a label, cosine 0.93 or more."""
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op8_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that every document names."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight of every document and whether it is drawn."""
    drawn = importance.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return drawn.select("doc_id", "log_weight", "gumbel_key", "selected")


def op10_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 400-byte strings."""
    return repeats.without_repeats(table(spark, sf_dir, "documents"), length=400, digest=True)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document and what is left without them."""
    docs = periodic_runs.with_periodic_tails(table(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.find_runs(docs))


def op12_recurrent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and recurrent language-model score of every document."""
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op13_merkle_butterfly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents by source, and whether each row as
    offered folds to its root."""
    return merkle.verify(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_language_filters, op2_ngram_jaccard, op3_piece_bpe, op4_bin_slack_packing, op5_token_counts,
    op6_dual_tree_top_k, op7_nn_descent, op8_license_sentences, op9_importance_resampling, op10_repeated_strings,
    op11_periodic_runs, op12_recurrent_scores, op13_merkle_butterfly)}
ORACLE: dict[str, str] = {"op8_license_sentences": licenses.scan_sql()}
