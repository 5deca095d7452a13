"""Helpers of the corpus operators: tables, checkpoints, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all machines see.

    Where it is unset a local session gets a temporary folder; a cluster gets an error, since
    its machines would each write to a disk of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    set_before = spark.sparkContext.getCheckpointDir()
    if set_before:
        return set_before
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines see")
    folder = tempfile.mkdtemp(prefix="checkpoints-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, where lost executors don't matter."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _signature(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "root"))).first()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b) that is not its own root.

    The root is the smallest node of the component. Large-star and small-star steps take
    turns until nothing changes, some log(n) rounds. Each is a minimum per node with partial
    aggregation and a join whose larger side AQE can split; only two numbers per round reach
    the driver.
    """
    stars = checkpointed(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        .distinct()
    )
    before = _signature(stars)
    while before[0]:
        both = stars.unionAll(stars.select("root", "node").toDF("node", "root"))
        least = both.groupBy("node").agg(F.min("root").alias("least"))
        large = (
            both.join(least, "node")
            .filter("root > node")
            .select(F.col("root").alias("node"), F.least("least", "node").alias("root"))
            .distinct()
        )
        large = checkpointed(large)
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least, "node").select(
            F.inline(
                F.array(
                    F.struct(F.col("root").alias("node"), F.col("least").alias("root")),
                    F.struct(F.col("node").alias("node"), F.col("least").alias("root")),
                )
            )
        )
        stars = checkpointed(small.filter("node <> root").distinct())
        after = _signature(stars)
        if after == before:
            break
        before = after
    return stars
