"""Training-corpus pipeline: language ID, near-duplicates, benchmark
decontamination, personal data, SentencePiece encoding.

Every stage takes ``(spark, docs, sf_dir)``, works on all documents that the
stage before kept, and returns a DataFrame. All but the last return the columns
of ``docs``, extra ones included.

Defined cases: documents without a letter (null and empty texts too) go in the
first stage. Of a near-duplicate group the document with the smallest id stays
(null counts as largest), of rows with that id the one with the smallest text
hash, of equal rows one. A null text is kept by every later stage as it is. An
empty table gives empty results.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylens.llm import decontamination, language_id, pii, queries, simhash
from relaylens.llm.common import bound_batches, read_table, scratch_folder


def _bounded(stage):
    """``stage`` in a session whose Arrow batches are bounded."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)
    return run


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` has not."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be determined."""
    found = _fresh(docs, "language")
    judged = language_id.predict_language(docs, language_id.fit_languages(docs), out=found)
    return judged.filter(F.col(f"{found}.lang") != language_id.UNDETERMINED).select(*docs.columns)


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every SimHash component (3-word shingles, 2 bits)."""
    return simhash.keep_one(docs, shingle=3, limit=2)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a benchmark leak (13 tokens, 11 of them equal)."""
    return decontamination.remove_leaks(docs, read_table(spark, sf_dir, "benchmark"), window=13, share=0.8)


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; ``n_chars`` follows the text."""
    clean = docs.withColumn("text", pii.redacted(F.col("text"), pii.fit_tagger(docs)))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def stage_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document, their number, and whether they decode to its text."""
    coded = queries.encoded(docs.select("doc_id", "text"), queries.piece_model(spark))
    return coded.select("doc_id", "pieces", "n_pieces", "round_trip", "decoded_sha256")


STAGES = [(name, _bounded(stage)) for name, stage in (
    ("language_id", stage_language), ("near_duplicates", stage_near_duplicates), ("decontamination", stage_decontaminate),
    ("pii", stage_pii), ("sentencepiece", stage_pieces))]

#: SQL can't express the learned stages; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = scratch_folder(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
