"""Connected components of an edge table by alternating star contraction.

Every round lets each node point its neighbours to the smallest node it knows,
first among all neighbours (large star), then among the smaller ones (small
star). The edge table never grows, and the number of rounds grows with the
logarithm of the longest chain. Minima are aggregated before the shuffle and
joined back, so a node with very many neighbours needs no task of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged

MAX_ROUNDS = 100


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(hi, lo))")).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that an edge touches; root is the smallest node.

    Loops and repeated edges change nothing; edges with a null end are ignored;
    no edges give no rows. Node columns are integers.
    """
    now = staged(
        edges.where(f"`{a}` <> `{b}`").select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(),
        "edges",
    )
    before = _state(now)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(least, "hi")
            .select(F.explode(F.array(F.struct("hi", "m"), F.struct(F.col("lo").alias("hi"), "m"))).alias("e"))
            .select("e.hi", F.col("e.m").alias("lo"))
            .where("hi <> lo")
            .distinct()
        )
        now = staged(small, "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots)
