"""A training corpus from ``documents``: quality rules, near-copies, personal data, source mix, pieces.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written and read again as the next stage's ``docs``. All stages but the last
return the columns of ``docs``. A stage first deletes the working tables of the
stage before it, whose result has been written by then: write the result of a
stage before calling the next one. ``ORACLE_SQL`` is None: line fields, boosted
trees and piece encoding are not SQL; tests hold the rows of ``run`` against a
brute-force version.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from auctide.llm import mix, pii, piece_wfst, quality, simhash
from auctide.llm.common import drop_tables, table, written
from auctide.llm.queries import tokenizer_file
from auctide.session import stored

PIECE_MODEL = "piece_bpe_32k.model"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rule and the line field keep."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: 3-word shingles, 2 bits."""
    return simhash.drop_near_copies(docs, max_bits=2, shingle=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data replaced by the name of its kind."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes: weights 3, 1, 2 at 150 % of the words, a row per pass over a document."""
    return mix.mixed_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every row, with the check that they decode to its text."""
    return piece_wfst.encode(docs, tokenizer_file(PIECE_MODEL))


_working: list[str] = []  # tables of the stage that ran last


def _after_the_last(stage):
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(spark, _working)
        before = len(written)
        out = stage(spark, docs, sf_dir)
        _working[:] = written[before:]
        return out
    return run_stage


STAGES = [("quality_rules", quality_rules), ("simhash_dedup", simhash_dedup), ("personal_data", personal_data),
          ("source_mix", source_mix), ("sentencepiece", pieces)]
STAGES = [(name, _after_the_last(stage)) for name, stage in STAGES]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
