"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage works on all that its predecessor kept and returns the columns of
``documents`` (doc_id, text, lang, source, n_chars); the last returns pieces
with their sequences. ``run`` writes each stage's rows to the shared folder and
reads them back, so that a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerguard.llm.common import doc_id, written
from ledgerguard.llm.line_dedup import dedup_lines
from ledgerguard.llm.packing import pack
from ledgerguard.llm.pfp_dedup import drop_repeats
from ledgerguard.llm.quality_rules import keep_good
from ledgerguard.llm.simhash_gray import keep_one

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Shortest string that counts as repeated: 50 words of five letters, each but
#: the last with a space after it, have 299 bytes; 256 leaves room for shorter words.
REPEAT_BYTES = 256


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def _edited(rows: DataFrame) -> DataFrame:
    """Documents whose text is now ``kept``."""
    return rows.select(doc_id(), F.col("kept").alias("text"), "lang", "source",
                       F.length("kept").cast("long").alias("n_chars"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the compression bands reject go."""
    return keep_good(_documents(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a smaller doc_id holds go; a document may end up empty but stays."""
    return _edited(dedup_lines(docs, "lang", "source"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within three bits (three-word shingles) stays."""
    return keep_one(_documents(docs), words_per_shingle=3, limit=3)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings of ``REPEAT_BYTES`` bytes found twice or more go."""
    return _edited(drop_repeats(docs, "lang", "source", length=REPEAT_BYTES))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 2048."""
    return pack(docs, capacity=2048)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Compression, XXH64 votes and tokens have no SQL form: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
