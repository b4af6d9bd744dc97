"""Corpus pipeline: from raw documents to an encoded training mix.

Stages run in order; each gets the rows that the one before kept, written as Parquet under
the shared checkpoint folder and read again, so that a lost executor repeats one stage and
no lineage grows. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabline.llm.jaccard import drop_near_copies
from cabline.llm.lines import drop_repeated_lines
from cabline.llm.mixing import take_mix
from cabline.llm.pieces import encode
from cabline.llm.quality import drop_low_quality
from cabline.session import drop_path, materialize_at, written_tables

#: Tables that the stage called last wrote for itself.
_LEFT: list[str] = []


def stage(fn):
    """A stage's own tables serve until its result is written, which is done before the next
    stage is called (it reads that result); so they are dropped when the next one starts."""

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in _LEFT:
            drop_path(spark, path)
        _LEFT.clear()
        with written_tables() as paths:
            out = fn(spark, docs, sf_dir)
        _LEFT.extend(paths)
        return out

    return run_stage


DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go (operator 5)."""
    return drop_low_quality(docs)


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later places of repeated passages go from the texts (operator 4)."""
    return drop_repeated_lines(docs)


@stage
def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (operator 10)."""
    return drop_near_copies(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (operator 9)."""
    return take_mix(docs)


@stage
def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the piece ids of the best segmentation, its score, and those of the next best
    ones (operator 1)."""
    out = encode(docs)
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], "ids", "score", F.col("others.score").alias("other_scores"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: Winnowing, MinHash and piece lattices have no SQL form; tests/llm checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select(*DOCUMENT)
    before = None
    for name, fn in STAGES:
        docs, path = materialize_at(fn(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            drop_path(spark, before)         # the stage before has been read
        before = path
    return docs
