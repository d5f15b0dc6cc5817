"""A training-data pipeline over ``documents``: each stage's result is written as
Parquet and read again as the next stage's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontam_fm, langid_zstd, minhash_bbit, mix_waterfill, token_orc
from quarry.llm.catalog import BYTE_VOCABULARY
from quarry.llm.common import read_table, scratch, stage


def _set_aside(docs: DataFrame) -> tuple[DataFrame, list]:
    """``docs`` with all columns but the id under names that no operator uses, and the
    columns that bring the old names back."""
    others = {c: f"_kept_{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    back = [F.col(others.get(c, c)).alias(c) for c in docs.columns]
    return docs.withColumnsRenamed(others), back


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found without doubt stay."""
    model = langid_zstd.train(docs.where(~langid_zstd.held_out()))
    given, back = _set_aside(docs)
    judged = langid_zstd.identify(given, model, keep=tuple(c for c in given.columns if c != "doc_id"))
    return judged.where(~F.col("rejected")).select(*back)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one of smallest id."""
    return minhash_bbit.keep_one(docs, minhash_bbit.near_duplicates(docs)).select(*docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage stay."""
    given, back = _set_aside(docs)
    others = tuple(c for c in given.columns if c != "doc_id")
    found = decontam_fm.decontaminate(given, read_table(spark, sf_dir, "benchmark"), keep=others)
    return found.where(F.size("spans") == 0).select(*back)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents, so that the sources come to their targets."""
    return mix_waterfill.repeated(mix_waterfill.mix(docs))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the ids as ORC and return the digest of the files, one row per document taken."""
    path = scratch(spark, "pipeline-token-orc")
    token_orc.write_token_orc(docs, path, public_tokenizers.path(BYTE_VOCABULARY))
    return token_orc.token_digest(spark, path)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix_stage),
    ("token_orc", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Tokenizing and compression classes have no SQL form.
ORACLE_SQL = None
