"""From raw documents to packed sequences: each stage reads what the one before wrote.

Every stage judges the rows its predecessor kept, and its decisions take effect: rejected
documents and all but one of each group of copies or near copies go, the mix repeats or
leaves out whole documents. All stages but the last return the columns of ``documents``;
the last returns a row per packed piece.

Defined cases are those of the operators; besides, ``mix`` leaves out documents without
words, and repeats or leaves out whole documents, so an id may occur twice behind it. An
empty table passes through all stages.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from functools import wraps
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from fairgauge.llm import contentsort, importance, mixing, packing, parity
from fairgauge.llm.common import drop_scratch, materialise, noted_scratch, read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Scratch tables of the stage before, by session.
_left: dict[int, list[str]] = {}


def _stage(function: Stage) -> Stage:
    """A stage whose predecessor's result is written drops the scratch tables that the
    predecessor needed to make it; they stay where ``docs`` still reads them."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        paths = _left.setdefault(id(spark), [])
        read = docs.inputFiles() if paths else []
        if not any(path.rpartition("/")[2] in file for path in paths for file in read):
            drop_scratch(spark, paths)
        gc.collect()  # frames of the predecessor let go of their shuffles
        with noted_scratch(paths):
            return function(spark, docs, sf_dir)

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling (1) towards the labelled good documents."""
    return importance.classify(docs, read_table(spark, sf_dir, "labels"), rows=True)


@_stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Content sort (9); of equal texts that with the smallest id stays."""
    return contentsort.drop_copies(docs)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Parity-sketch join (8) on five-word shingles at similarity 0.8; of linked
    documents that with the smallest id stays."""
    return parity.drop_similar(docs, words=5, threshold=Fraction(4, 5))


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Curriculum (6): whole documents in training order, repeated up to twice."""
    return mixing.mix_documents(docs)


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sum-of-squares packing (3) of the mix's documents."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]

#: SQL can't express the tokenizer's ids; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    _left.pop(id(spark), None)  # what an earlier run's result may still be read from
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
