"""A training corpus from ``documents``: the stages and how they are chained.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.

1. ``language``: fits the language filters on the stage's own labelled rows and
   drops documents without a letter and those whose best language explains
   less than ``MIN_LANGUAGE_SHARE`` of the n-grams.
2. ``quality``: importance resampling against the labelled good documents;
   documents that are not drawn go.
3. ``near_duplicates``: documents of one component of the n-gram Jaccard join
   (five-word shingles, similarity 0.8 or more) are copies; the one with the
   smallest doc_id stays, and of several rows with that id one. Documents
   without a word, or without an id, stay.
4. ``repeated_strings``: removes repeated strings of 400 bytes; a document that
   is left without any text goes.
5. ``packing``: ids in sequences of at most 1024 tokens.

An empty table passes through every stage; a null text is rejected by the
first; columns besides those of ``documents`` are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import importance, jaccard, langid, packing, repeats
from corpusmill.llm.common import cut, table

MIN_LANGUAGE_SHARE = 0.2
SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs.where(~langid.held_out()))
    found = langid.predict(docs, model, [c for c in docs.columns if c != "text"], with_text=True)
    kept = found.where((F.col("lang_pred__") != "und") & (F.col("score__") >= MIN_LANGUAGE_SHARE))
    return kept.select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return importance.drawn(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.representatives(docs, words=SHINGLE_WORDS, percent=SIMILARITY_PERCENT)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(docs).where("text is not null and text <> ''")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # trained models and a tokenizer: tested against brute force
