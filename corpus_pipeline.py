"""The corpus pipeline: quality rules, near-duplicates, personal data, mixing, encoding.

Every stage is ``(spark, docs, sf_dir) -> DataFrame`` over the rows that the stage before
it kept. All but the last return the columns of ``docs``. Between stages the rows are
written as Parquet in the shared checkpoint folder and read again, so a stage's work is
never repeated and survives the loss of any executor.

Null ids, texts, sources and languages, empty texts, repeated rows, empty tables and extra
columns are handled as the operators' docstrings say: texts with fewer than ten words
go in the first stage, repeated rows in the second.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.llm import bpe, dartminhash, mixing, pii, quality
from eventflow.llm.common import BATCH_BYTES_CONF, col, fresh, release, table, write_cut

BATCH_BYTES = 2 << 20


def modest(spark: SparkSession) -> None:
    """Smaller Arrow batches than a single operator takes, since the Python workers of all stages
    stay beside one another on an executor; and what earlier stages left on the driver goes."""
    spark.conf.set(BATCH_BYTES_CONF, str(BATCH_BYTES))
    release()
    spark.sparkContext._jvm.System.gc()


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a base rule or a risk-controlled threshold rejects."""
    modest(spark)
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    verdict = judged.columns[-1]
    return judged.where(F.col(f"{verdict}.kept")).drop(verdict)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies: that of the least id."""
    modest(spark)
    return dartminhash.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data, and terms that give it away, in the texts."""
    modest(spark)
    return pii.sanitise(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws the sources to their targets: a row each time a document is taken."""
    modest(spark)
    return mixing.draw(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes the texts; adds the ids, their number, and whether they decode to the text."""
    modest(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids, back = fresh("ids", docs), fresh("decoded", docs)
    count, exact = fresh("n_tokens", docs), fresh("round_trip", docs)
    # Written between the two, so that a task needs one Python worker and not two at once.
    coded = bpe.decode(write_cut(bpe.encode(docs, path, ids=ids), "encoded"), path, ids=ids, decoded=back)
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    return coded.select(*[col(c) for c in docs.columns], col(ids),
                        F.expr(f"octet_length(`{ids}`) div 4").cast("long").alias(count),
                        (col(back) == text).alias(exact))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]

# Binomial bounds, signatures and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_cut(stage(spark, docs, sf_dir), name)
    return docs
