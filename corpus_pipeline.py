"""The corpus pipeline: raw documents in, packed training bins out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents.

1. quality_rules drops documents that the base rules or the log-likelihood ratio reject.
2. near_duplicates keeps the smallest doc_id of each group of documents that share 80 % of their five-word shingles.
3. personal_data replaces personal data by its kind in brackets.
4. source_mix repeats the documents of small sources, at most twice in all, until the weights are even enough; none is lost.
5. best_fit packs the texts into bins of 8192 bytes; copies of one text, and sources named as conflicting, never share one.

Empty tables pass through every stage; what nulls, empty texts, ties and repeated rows do is stated with each operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import minhash, mixing, packing, pii, quality
from tickloom.llm._state import shared_dir

#: No SQL: the first three stages rest on fitted models and on hashing; tests hold the run against its stages one by one, whose operators have tests of their own.
ORACLE_SQL = None
SOURCE_CONFLICTS = (("src1", "src2"),)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7 over all documents; its model is fitted on these documents and the labels."""
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4 with five words and a similarity of 0.8."""
    return minhash.keep_one(docs, size=5, num=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8; a document that is used twice is two rows."""
    return mixing.mix(docs).select(*docs.columns)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3, with the packed bytes."""
    return packing.pack(docs, source_conflicts=SOURCE_CONFLICTS, shard_rows=4000, with_text=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("best_fit", best_fit),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage returns is checkpointed, so that no later one runs it again."""
    shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else docs.checkpoint(), sf_dir)
    return docs
