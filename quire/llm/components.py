"""Connected components of a link table by alternating star contraction.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014).  A round is
two aggregations (combined before their shuffle) and two joins, whose hot keys AQE may
split because nothing above them needs a key's rows together.  Each round is written to
the shared checkpoint folder; the driver sees one count and one checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import staged


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_least_neighbour(both), "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come with u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (edges.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                      F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u != v"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every linked node but the smallest of each component.

    ``component`` is the smallest node reachable.  Null ends and self links are ignored,
    repeated links count once; no links give no rows.  Nodes that are not in the result
    are their own component."""
    edges = staged(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .filter(F.col(a).isNotNull() & F.col(b).isNotNull()).filter("u != v").distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = tuple(state)
        edges = staged(_small_star(_large_star(edges).distinct()).distinct(), "stars")
