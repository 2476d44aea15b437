"""From raw documents to token files: five stages, each one operator's decision on all that the stage before kept.

Every stage but the last returns rows of its input, whole and with all columns, of
whatever names.  A null text is an empty one; null ids, languages and sources are
values like others; equal rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelprep.llm import fm_decontam, minhash, mixing, quality_trees, token_store
from panelprep.llm.common import stored, table
from panelprep.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more; it learns from the labels of documents outside fold 0."""
    trees = quality_trees.fit(docs, table(spark, sf_dir, "labels"))
    return quality_trees.classify(docs, trees).where(F.col("score") >= 0.3).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id; of equal rows any; a null id is chosen last."""
    return minhash.one_of_each(docs, minhash.near_duplicates(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word passage of the benchmark; one without words has none."""
    return fm_decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")).where(~F.col("found.contaminated")).select("doc.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, or up to three times each; equal rows share theirs."""
    return mixing.mixed_documents(docs, mixing.mix_plan(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and from them the place, length and crc of every document's ids; one without words has the end id alone."""
    return token_store.encode_documents(docs, tokenizer_path())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # trees, samples, draws and the tokenizer can't be put in SQL; tests/llm compares each stage with a plain version
