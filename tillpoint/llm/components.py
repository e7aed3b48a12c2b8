"""Connected components of an edge table by alternating large and small
stars: each round is two joins on a vertex, no neighbour list is collected,
and the number of rounds grows with the logarithm of the longest path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import materialize, scratch


def _large(e: DataFrame) -> DataFrame:
    both = e.union(e.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(e: DataFrame) -> DataFrame:
    e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    return (e.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))))


def _mark(e: DataFrame) -> tuple:
    # decimal sums: no overflow, equal for equal edge sets
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(v, comp) for every vertex of ``edges`` (a, b): the smallest vertex of
    its component."""
    with scratch() as block:
        e = materialize(edges.select("a", "b").filter("a <> b").distinct(), "edges")
        mark = _mark(e)
        while mark[0]:
            e = materialize(_small(_large(e)).filter("a <> b").distinct(), "edges")
            mark, old = _mark(e), mark
            if mark == old:
                break
        block.keep(e)
    return e.select(F.col("a").alias("v"), F.col("b").alias("comp")).union(
        e.select(F.col("b").alias("v"), F.col("b").alias("comp")).distinct())


def extend(comp: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``components`` of all edges so far: those behind ``comp`` (v, comp) and
    the new ``edges`` (a, b).  Only edges between different components are
    worked on."""
    if comp is None:
        return components(edges)
    with scratch() as block:
        for end in ("a", "b"):
            edges = (edges.join(comp.select(F.col("v").alias(end), "comp"), end, "left")
                     .withColumn(end, F.coalesce("comp", end)).drop("comp"))
        joined = components(edges).toDF("v", "root")
        old = comp.join(joined.withColumnRenamed("v", "comp"), "comp", "left").select(
            "v", F.coalesce("root", "comp").alias("comp"))
        new = joined.join(comp.select("v"), "v", "left_anti").toDF("v", "comp")
        return block.keep(materialize(old.union(new), "components"))
