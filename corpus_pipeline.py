"""Corpus pipeline: documents in, packed training sequences out.

Each stage is one operator of ``tablekit.llm`` over all documents that the
stage before kept; ``run`` writes each stage's result as Parquet in the shared
checkpoint folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm.bestfit_pack import pack_documents
from tablekit.llm.common import stored, table, unused
from tablekit.llm.line_dedup import dedup_lines
from tablekit.llm.quality_llr import filter_quality
from tablekit.llm.signature_join import drop_near_copies
from tablekit.llm.temperature_mix import mix_documents
from tablekit.session import ship_package, tune


def _ready(spark: SparkSession) -> None:
    tune(spark)
    ship_package(spark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or the likelihood-ratio threshold."""
    _ready(spark)
    return filter_quality(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines that three documents or more share out of all but the last of them."""
    _ready(spark)
    out = dedup_lines(docs)
    changed = F.col(unused("_n_dropped", docs.columns)) > 0
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 80 percent of 5-word shingles stays."""
    _ready(spark)
    return drop_near_copies(docs, 5, 80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources flattened as far as no document is repeated more than twice and none is left out."""
    _ready(spark)
    return mix_documents(docs, max_repetition=2.0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of permitted lengths."""
    _ready(spark)
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_copies", near_copies),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Hashed models, set joins and best fit have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
