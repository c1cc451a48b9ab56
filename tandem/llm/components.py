"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.session import Scratch


def extended(found: DataFrame, links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """The components with stored ``links`` added to those that gave ``found``, which takes their place.

    Without new links they are ``found``, and no round is run.
    """
    if links.isEmpty():
        return found
    a, b = links.columns
    return components(
        found.unionByName(links.select(F.col(a).alias("id"), F.col(b).alias("component"))), scratch, label)


def components(links: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """Per end of a link: id and component, the smallest id reachable. ``links`` has two columns of ids.

    Each round hangs the larger neighbours of every id under its smallest one, then does the same with the smaller
    neighbours, until every id hangs under one id that hangs nowhere; links only ever lead to smaller ids. An id that
    has only itself as component is not listed unless other ids hang under it. The links of an id are never gathered:
    only minima are.
    """
    a, b = links.columns
    edges = scratch.stage(
        links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v"), label)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # no more rows than links, so repeated ones wait for the distinct of the round's end
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = large.join(lowest, "u").select("m", F.explode(F.array("u", "v")).alias("u"))
        edges = scratch.stage(ends.select("u", F.col("m").alias("v")).filter("u <> v").distinct(), label)
        links_, children = edges.agg(F.count("*"), F.count_distinct("u")).first()
        hung = edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi")
        if links_ == children and hung.isEmpty():
            break
    roots = edges.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
