"""Connected components of an edge table that may be larger than any machine.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014).  A step needs only the minimum
neighbour of each node, which is pre-aggregated before the shuffle, and one
join that adaptive execution can split at a hub; each round is written to the
shared folder, so lineage stays one round long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.storage import materialize, tidy


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` to ``(node, root)``, root being the component's least
    node; nodes without an edge to another node do not appear.

    Null ends, loops and repeated edges are ignored; no edges give no rows.
    """
    state = materialize(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    digest = _digest(state)
    while digest[0]:
        state = materialize(_small_star(_large_star(state)), "edges")
        was, digest = digest, _digest(state)
        if was == digest:
            break
    tidy(state.sparkSession)
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
