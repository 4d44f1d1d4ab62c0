"""Training-data pipeline over documents: five stages, each written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sievemill.llm.common import documents, shared_dir
from sievemill.llm.line_dedup import clean_documents
from sievemill.llm.mixing import repeat_documents
from sievemill.llm.ngram_join import keep_one
from sievemill.llm.packing import pack_documents
from sievemill.llm.quality import filter_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go; n_chars follows the text."""
    return clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words a shingle, similarity 0.8."""
    return keep_one(docs, percent=80, n=5)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its source's target takes it."""
    return repeat_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048."""
    return pack_documents(docs)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates), ("mixing", mixture), ("packing", packing)]

#: SQL can't express tokenisation and near duplicates at once; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    top = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{top}/{k}")
        docs = spark.read.schema(made.schema).parquet(f"{top}/{k}")
    return docs
