"""Shared helpers of the operators: intermediate tables, row keys, connected components."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checkmart.session import written

__all__ = ["components", "documents", "partitions", "ship_package", "text_key", "written"]


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for clusters on which it is not installed."""
    context = spark.sparkContext
    if getattr(context, "_checkmart_sent", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="checkmart-")) / "checkmart.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._checkmart_sent = True


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """A table of a folder; the package is sent along for the operators that run Python in tasks."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: Column) -> Column:
    """Tells apart rows that share a doc_id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of the edges (a, b), as (node, component), the component being its smallest node.

    Alternating large-star and small-star steps: every step is a group minimum and an equi-join, and each result is
    written, so a hot node is a hot join key that adaptive execution can split, and lineage stays short.
    """
    edges = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        name,
    )
    known = _digest(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        # large star: the larger neighbours of a node move to the least of its neighbourhood
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        # small star: a node and its smaller neighbours move to the least of them
        lower = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lower, "a")
        stars = small.select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b")
        moved = written(stars.union(lower.select("a", F.col("low").alias("b"))).distinct(), name)
        digest = _digest(moved)
        if digest == known:
            return moved.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                moved.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        edges, known = moved, digest


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
