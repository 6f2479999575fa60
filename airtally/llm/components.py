"""Connected components of links, by DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.llm.common import stored


def _hooked(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: a node's larger (or its smaller) neighbours are linked to the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least")), "least")
    if large:
        out = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        smaller = both.where("b < a").join(least, "a")
        out = smaller.select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
    return stored(out.where("a <> b").distinct(), "stars")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Per node that has an edge: node, component (its least node). edges: a, b of type long.

    Large-star and small-star steps in turn until nothing changes; the number of
    rounds grows with the logarithm of the nodes, and links never pass the
    driver. Each step is written to the shared folder.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = _hooked(_hooked(edges, large=True), large=False)
        now = _state(edges)
        if now == state:
            break
        state = now
    own = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return stored(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own), "components")
