"""Corpus pipeline: five stages over ``documents``, each one of the operators
in ``parcelflow.llm``.

Each stage takes (spark, docs, sf_dir); the result is written as Parquet and
read again as the next stage's documents. All but the last return the columns
of ``documents``: a text that a stage changes has its ``n_chars`` counted anew.

Defined results: rows are judged, not ids, so repeated and null ids are fine;
null, empty and wordless texts have a quality score like any other, link with
nothing, leak nothing and are packed as the end id alone; copies leave the row of
the smallest id, or one of them where none has an id; other columns are kept,
whatever their names, up to the last stage; without labels every row has the same
score; an empty table, or one that a stage empties, gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import line_crf, partition_join, secret_scan, tiling, window_packing
from parcelflow.llm.frames import documents, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model rejects go. The model is trained on the
    labelled rows of the whole table."""
    model = line_crf.train(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return line_crf.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, Jaccard 0.8 or
    more) the document with the smallest id stays."""
    return partition_join.keep_one(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return tiling.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by marks; no document goes."""
    clean = secret_scan.redact_secrets(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 tokens."""
    return window_packing.pack(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("packing", packing)]

#: The line model and the tokenizer are beyond SQL; tests compare with a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
