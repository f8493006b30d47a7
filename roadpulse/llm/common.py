"""What the operators of this subpackage share: tables, written intermediates, components."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.session import new_work_dir

#: Characters that separate words, as a regular expression for what lies between them.
WORD = r"[^\x20\x09-\x0D]+"

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application.

    Functions that run there are sent by name; on a cluster the modules must be sent along.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="roadpulse-code-"), "roadpulse.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, os.path.dirname(package)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs the tasks that ran on it, not the whole history,
    and iterations do not grow the plan. Unlike a local checkpoint the files outlive executors.
    """
    spark = rows.sparkSession
    path = new_work_dir(spark, purpose)
    rows.write.parquet(path)
    found = spark.read.schema(rows.schema).parquet(path)
    found.saved_path = path
    return found


def discard(*tables: DataFrame) -> None:
    """Remove the files of ``saved`` tables that no plan will read any more."""
    for rows in tables:
        path = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(rows.saved_path)
        hadoop = rows.sparkSession._jsc.hadoopConfiguration()
        path.getFileSystem(hadoop).delete(path, True)


def named(rows: DataFrame) -> list[Column]:
    """All columns, also those with a dot or a quote in their name."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in rows.columns]


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z alone; every other character stays."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def connected_components(edges: DataFrame, purpose: str) -> DataFrame:
    """(id, component) for every id that ``edges`` (a, b) links with another: the smallest reached.

    Alternates the large-star and small-star steps of Kiveris et al. (2014) until the edges are
    stars: each step joins every edge with the minimum of one endpoint's neighbours, so a hub
    costs rows in proportion to its edges, the minimum is pre-aggregated before its shuffle, and
    the skewed side of the join can be split. No component is gathered anywhere. Loops, repeated
    edges, null ends and an empty table are fine: an id without a link to another has no row.
    The result is written; ``discard`` it after use.
    """
    edges = edges.select("a", "b").na.drop().where("a <> b")
    current = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = saved(current.distinct(), f"{purpose}-star")
    while not _are_stars(current):
        wide, least = _large_star(current, purpose)
        after = saved(_small_star(wide), f"{purpose}-star")
        discard(current, least)
        current = after
    named = current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    found = saved(named.union(roots), f"{purpose}-components")
    discard(current)
    return found


def _are_stars(edges: DataFrame) -> bool:
    """Whether every edge (a, b), a > b, leads from a node with one edge to a node with none."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("out")).union(
        edges.select("b", F.lit(0)).distinct()
    )
    sums = ends.groupBy("id").agg(F.sum("out").alias("out"), F.count("*").alias("rows"))
    # A node that is only an a has as many rows as edges; one that is also a b has one more.
    return sums.where("out > 1 or (out = 1 and rows > 1)").isEmpty()


def _large_star(edges: DataFrame, purpose: str) -> tuple[DataFrame, DataFrame]:
    """Links each node's larger neighbours with the least of it and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    # Written, so that both sides of the join are shuffled for it and a hub's edges can be
    # split over tasks: a component of a third of all ids has such a hub.
    least = saved(least.select("a", F.least("a", "m").alias("m")), f"{purpose}-least")
    joined = both.join(least, "a").where("b > a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), least


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours with the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    linked = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        joined.select("a", F.col("m").alias("b"))
    )
    return linked.where("a <> b").distinct()
