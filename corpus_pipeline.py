"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, piece encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. All but the last
return the columns of ``documents``. Defined results for odd input are those of the operators.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import decontaminate, linededup, neardup, pieces, toxicity
from riskframe.llm.common import read, small_batches, stage


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score as toxic."""
    small_batches(spark)
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that an earlier document has; every document stays."""
    small_batches(spark)
    return linededup.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest document of each group of near duplicates (five words, similarity 0.8)."""
    small_batches(spark)
    return neardup.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that share a run of ten words with a benchmark item."""
    small_batches(spark)
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the documents that are left."""
    small_batches(spark)
    coded = pieces.encode(docs, pieces.load())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("toxicity", toxic_documents),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_passages),
    ("sentencepiece", piece_ids),
]

#: Trained scores, minwise trees and best paths have no SQL form: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
