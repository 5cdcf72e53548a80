"""Connected components of an edge table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import written

#: Edges that one task settles, in less time than a round of joins takes; beyond it the rounds are distributed.
FEW = 10_000


def _settled(edges: DataFrame) -> DataFrame:
    """Components of at most FEW edges (u, v), by union-find in one task."""
    kind = edges.schema["u"].dataType.simpleString()

    def run(batches):
        up: dict = {}

        def find(x):
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        for b in batches:
            for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True):
                u, v = find(u), find(v)
                up[max(u, v)] = min(u, v)
        nodes = list(up)
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([find(x) for x in nodes])], names=["node", "component"])

    return edges.coalesce(1).mapInArrow(run, f"node {kind}, component {kind}")


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for each node of the undirected edges; component is the smallest node reachable.

    Alternating large-star and small-star rounds: each is a grouped minimum and a join, rows never multiply, and the
    number of rounds grows with the logarithm of the longest path. Each round is a written table. At most FEW edges, which
    are counted first, are settled in one task, with the same result. No edges: no rows."""
    cur = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    if edges.schema[a].dataType == edges.schema[b].dataType and cur.count() <= FEW:
        return _settled(cur)
    for _ in range(max_rounds):
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # u > v holds now; each u keeps the smallest of its smaller neighbours as its only parent
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        cur = written(small, replaces=cur)
        n, heads = cur.agg(F.count("*"), F.countDistinct("u")).first()
        if n == heads and cur.join(cur.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(cur.select("v", "v").distinct())
