"""Insert-or-update without MERGE: a join of current and incoming rows by null-safe keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _match(a: str, b: str, keys: list[str]):
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str], policy: str = "overwrite", columns: list[str] | None = None) -> DataFrame:
    """current with incoming rows. policy: ignore (rows that exist stay), overwrite (they are replaced), columns (only
    these columns of them are). Of incoming rows with one key, one counts, the same on every run; nulls match nulls."""
    names = current.columns
    order = F.struct(*[F.col(c) if not dict(incoming.dtypes)[c].startswith("map") else F.to_json(c) for c in names])
    one = incoming.groupBy(*keys).agg(F.max_by(F.struct(*names), order).alias("r")).select("r.*")
    if policy == "ignore":
        return current.unionByName(one.alias("i").join(current.alias("c"), _match("i", "c", keys), "left_anti"))
    if policy == "overwrite":
        return current.alias("c").join(one.alias("i"), _match("c", "i", keys), "left_anti").unionByName(one)
    if policy != "columns":
        raise ValueError(policy)
    both = current.withColumn("_c", F.lit(True)).alias("c").join(one.withColumn("_i", F.lit(True)).alias("i"), _match("c", "i", keys), "full_outer")
    pick = lambda n: F.when(F.col("_c").isNull() | (F.col("_i").isNotNull() & F.lit(n in (columns or []))), F.col(f"i.{n}")).otherwise(F.col(f"c.{n}")).alias(n)
    return both.select(*[pick(n) for n in names])
