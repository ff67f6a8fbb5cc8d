"""Corpus pipeline: five operators of pitchline.llm in a row over ``documents``.

Each stage reads what its predecessor wrote; all but the last return the
columns of ``documents``. Stages shuffle texts compressed or not at all where
they can; see the operators for what they do with odd rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm import host_quality, order_minhash, pfair, secrets, sentencepiece_backend
from pitchline.llm.common import read_documents
from pitchline.operators.ranking import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no base rule, and no rule that their host fails
    as a rule."""
    return host_quality.filter_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of least doc_id."""
    return order_minhash.deduplicate(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by the name of its kind."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the mixed order: by file, then by row of the file."""
    return pfair.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of all documents, with ``part`` and ``row``: file and row that
    held the document, so that sorting by them gives the mixed order."""
    import public_tokenizers

    stored = docs.select(
        "doc_id", "text", F.regexp_extract("_metadata.file_name", r"^part-(\d+)-", 1).cast("int").alias("part"),
        F.col("_metadata.row_index").alias("row"))
    return sentencepiece_backend.encode(stored, public_tokenizers.path("piece_bpe_32k.model"), keep=("part", "row"))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("secret scans", secret_scan),
    ("mixing sources", mix_sources),
    ("SentencePiece encoding", encode_pieces),
]

#: Alignment, guess costs, schedules and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = read_documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
