"""Spark helpers of the subpackage: tables, staging, checked broadcasts and
connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.session import stage_table

#: Rows of two or three longs that may be broadcast (about 24 MB at most).
BROADCAST_ROWS = 1_000_000


#: Bytes of a batch of rows that goes to Python.
BATCH_BYTES = 4 << 20

#: Whether shuffle files are removed at the end of the query that wrote them.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession) -> None:
    """Rows of whole texts go to Python in batches of 1000 and of a few MB each,
    in place of 10,000 rows of any size: two workers an executor hold one batch
    each, and the JVM the bytes of as many."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """A stage table; the shuffle files of its job go when it is written, not
    when the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return stage_table(df, f"llm-{name}")
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name1``, ``name2``, ... that no column has."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (name, *(f"{name}{i}" for i in range(1, len(taken) + 2))) if n.lower() not in taken)


def keyed(small: DataFrame, rows: int) -> DataFrame:
    """A narrow key table for a join: broadcast where its counted rows allow
    it, else left to a shuffled join with the same result."""
    return F.broadcast(small) if rows <= BROADCAST_ROWS else small


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links(a, b)``; the component is the
    smallest node reachable.

    Alternating large-star and small-star rounds until the edges are stars,
    which one grouping tells; a round is two pre-aggregated minima and two
    joins, its edges are staged as Parquet, and nothing but a count reaches the
    driver. A hub's rows are split by the skew join."""
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not _stars(edges):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = staged(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.union(low.select("u", "m")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "small-star")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node is either a smallest node or has one edge, to such a
    node; holds for no edges."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.agg(F.count_if((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1)))).first()[0] == 0
