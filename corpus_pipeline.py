"""A corpus made ready for training: the stages in order, each over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of `documents`; the last one returns, for each reading of
a document, its ids and whether they decode to its text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from creditloom.llm.common import document_rows, staged
from creditloom.llm.line_dedup import drop_shared_lines
from creditloom.llm.mixing import mix
from creditloom.llm.near_dedup import drop_near_duplicates
from creditloom.llm.piece_scan import piece_report
from creditloom.llm.quality_rules import keep_good


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines in five documents or more stay in the last of these only."""
    return drop_shared_lines(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, by five-word shingles and a similarity of 0.8."""
    return drop_near_duplicates(docs, words=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are read up to twice, and no document is left out: a document stands as often as it is read."""
    return mix(docs, max_epochs=2.0)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document."""
    return piece_report(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", encoding_stage),
]

#: SQL can express neither the estimated rule accuracies nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = document_rows(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
