"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder, small Arrow batches (texts may be very long) and the
    package on the Python workers' path."""
    checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    root = str(Path(__file__).resolve().parents[2])
    if root not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        spark.sparkContext.addFile(str(Path(root) / "shopwright"), recursive=True)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: cuts the lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over undirected ``edges`` (a, b).

    Alternates large-star and small-star steps until the edge set is stable;
    every step is a shuffle on the nodes that have edges, and the number of
    steps grows with the logarithm of the longest path.  A hub holds one edge
    per neighbour, and both stars need only the neighbours' minimum (a
    partial aggregate), so a hot node is never gathered.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    last = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low2, "u")
        small = (joined.select("u", F.col("m").alias("v"))
                 .unionByName(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
                 .distinct())
        e = cut(small)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    return (nodes.select("node").distinct().join(e.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left")
            .select("node", F.coalesce("root", "node").alias("root")))
