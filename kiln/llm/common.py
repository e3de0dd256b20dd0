"""Helpers shared by the training-data operators.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]``: only the six ASCII white
space characters separate words, whatever else Unicode calls a space.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import drop_written, write_parquet

__all__ = ["WORD", "SPACE", "BROADCAST_IDS", "words", "read_table", "shared_dir", "write_table", "drop_table",
           "rows_with", "connected_components"]

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Most integer ids that are broadcast (some 30 MB in memory); more meet their rows in a shuffle.
BROADCAST_IDS = 1_000_000


def words(text: Column) -> Column:
    """Array of the words of ``text``; empty for null or blank texts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    Only a local session without that setting (tests) gets a scratch folder;
    elsewhere a missing setting is an error, since a machine's own folder
    could not be read by other executors.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="kiln-shared-")
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kiln-{name}-{uuid.uuid4().hex}"
    write_parquet(df, path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table of ``write_table`` that nothing reads any more."""
    drop_written(df)


def rows_with(df: DataFrame, ids: DataFrame, key: str, most: int = BROADCAST_IDS) -> DataFrame:
    """The rows of ``df`` whose ``key`` is among ``ids`` (one integer column of that name, distinct).

    The ids are written and counted first: few enough are broadcast, so that long rows need no shuffle.
    """
    ids = write_table(ids, "ids")
    return df.join(F.broadcast(ids) if ids.count() <= most else ids, key, "left_semi")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge; component is the smallest node reachable.

    Large-star / small-star rounds: each links nodes to smaller ones until
    every node points at its component's minimum.  A round is a partial
    (map-side) minimum per node and an equi-join, so a node with a third of
    all edges is neither collected nor bound to one task (skewed joins split).
    Each round's edges are written to the shared folder; the previous round's
    are deleted.
    """
    def links(df: DataFrame) -> DataFrame:
        return df.where(F.col("hi") != F.col("lo")).distinct()

    cur = write_table(links(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))), "cc")
    fingerprint = None
    while True:
        both = cur.unionByName(cur.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m"))
        large = links(both.join(least, "hi").where(F.col("lo") > F.col("hi"))
                      .select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
        large = write_table(large, "cc")
        drop_table(cur)
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(least, "hi")
        new = write_table(links(joined.select(F.greatest("lo", "m").alias("hi"), F.least("lo", "m").alias("lo"))
                                .unionByName(least.select("hi", F.col("m").alias("lo")))), "cc")
        drop_table(large)
        mark = tuple(new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        cur = new
        if mark == fingerprint:
            return cur.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
                cur.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
        fingerprint = mark
