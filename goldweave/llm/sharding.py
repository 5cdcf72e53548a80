"""Minimax contiguous partition of documents into shards.

Rows with equal texts are one atomic group; groups are ordered by a 60-bit hash of the text. The smallest capacity for
which a greedy cut of that order needs no more than the wanted shards is found by binary search. The order itself is
never gathered: the driver works on sums by hash range, finds between which capacities the answer lies and which ranges
a cut can fall into, and asks for finer sums of those ranges alone, until every range that matters is one group."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import only, written

SHARDS, OVERHEAD = 24, 8
HASH_BITS, FIRST_BITS, NEXT_BITS = 60, 12, 6
#: Rows of a shard are numbered in so many cells, each by itself.
CELLS = 256


def text_hash(c) -> F.Column:
    """The first 60 bits of the MD5 of the text; null as empty."""
    return F.conv(F.substring(F.md5(F.coalesce(c, F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def greedy(sums: list[int], capacity: int) -> list[int]:
    """Ends of the parts that a greedy cut makes of sums; no sum may exceed the capacity."""
    ends, filled = [], 0
    for i, s in enumerate(sums):
        if filled + s > capacity and filled:
            ends.append(i)
            filled = 0
        filled += s
    return [*ends, len(sums)]


def parts(prefix: list[int], capacity: int, most: int) -> list[int] | None:
    """Ends of at most `most` greedy parts by bisection of the running sums (prefix[0] = 0); None if they don't do."""
    ends, at, n = [], 0, len(prefix) - 1
    while at < n:
        if len(ends) == most:
            return None
        nxt = bisect_right(prefix, prefix[at] + capacity, at) - 1
        if nxt == at:
            return None
        ends.append(nxt)
        at = nxt
    return ends


def smallest_capacity(sums: list[int], shards: int) -> int:
    """The least capacity for which parts() succeeds on whole entries of sums."""
    prefix = [0]
    for s in sums:
        prefix.append(prefix[-1] + s)
    lo, hi = max([0, *sums, -(-prefix[-1] // shards)]), prefix[-1]
    while lo < hi:
        mid = (lo + hi) // 2
        if parts(prefix, mid, shards) is None:
            lo = mid + 1
        else:
            hi = mid
    return lo


def _possible(prefix: list[int], lo: int, hi: int, shards: int) -> set[int]:
    """Entries that the end of some part can fall into, for any capacity from lo to hi, if entries can be cut."""
    found, low, high = set(), 0, 0
    n = len(prefix) - 1
    # earliest and latest place, in size units, where part k can end
    for _ in range(shards):
        i = bisect_right(prefix, low + lo) - 1
        low = prefix[i] if i < n else prefix[n]  # a cut entry can end the part as early as the entry's start
        high = min(prefix[n], high + hi)
        j = min(n - 1, bisect_right(prefix, high) - 1)
        found.update(range(min(i, n - 1), j + 1))
        if low >= prefix[n]:
            break
    return found


def cuts(rows: DataFrame, shards: int = SHARDS) -> tuple[list[int], int]:
    """For rows(h, size): the first hash of each shard after the first, and the smallest capacity.

    The driver holds 2**FIRST_BITS ranges and, each round, 2**NEXT_BITS for each range that a cut can fall into."""
    def sums(df: DataFrame, bits: int) -> list[tuple[int, int, int, int, int]]:
        shift = HASH_BITS - bits
        got = df.groupBy(F.shiftright("h", shift).alias("p")).agg(F.sum("size").alias("s"), F.min("h").alias("lo"), F.max("h").alias("hi")).collect()
        return sorted((r["lo"], r["hi"], r["s"], r["p"], bits) for r in got)

    entries = sums(rows, FIRST_BITS)
    if not entries:
        return [], 0
    while True:
        sizes = [e[2] for e in entries]
        prefix = [0]
        for s in sizes:
            prefix.append(prefix[-1] + s)
        # whole entries give a capacity that does; entries of one group, and an even split, one that is needed
        hi = smallest_capacity(sizes, shards)
        lo = max([-(-prefix[-1] // shards), *(e[2] for e in entries if e[0] == e[1])])
        split = {i for i in _possible(prefix, lo, hi, shards) if entries[i][0] != entries[i][1]} if lo < hi else set()
        if not split:
            break
        by_bits: dict[int, list[int]] = {}
        for i in split:
            by_bits.setdefault(entries[i][4], []).append(entries[i][3])
        finer = []
        for bits, prefixes in by_bits.items():
            of = rows.sparkSession.createDataFrame([(p,) for p in prefixes], "p long")
            inside = rows.join(F.broadcast(of), F.shiftright("h", HASH_BITS - bits) == F.col("p"), "left_semi")  # at most the ranges that the driver holds
            finer += sums(inside, min(HASH_BITS, bits + NEXT_BITS))
        entries = sorted([e for i, e in enumerate(entries) if i not in split] + finer)
    ends = parts(prefix, hi, shards)
    return [entries[e][0] for e in ends[:-1]], hi


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """docs (all columns, clashing ones replaced) with size, text_crc32, shard and slot.

    size is the UTF-8 bytes of the text (null: none) plus 8. Equal texts share a shard (null and empty are equal). The
    largest shard is as small as any contiguous cut of the hash order allows; shards at the end may be empty where there
    are few groups. slot numbers a shard's rows from 0 without gaps, in an order that reruns repeat."""
    names = [c for c in docs.columns if c.lower() not in ("size", "text_crc32", "shard", "slot")]
    light = written(
        only(docs, doc_id="long", text="string").select(
            "doc_id", text_hash(F.col("text")).alias("h"), (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size")
        )
    )
    firsts, _ = cuts(light, shards)

    def shard_of(h) -> F.Column:
        out = F.lit(0)
        for f in firsts:
            out = out + (h >= F.lit(f)).cast("int")
        return out

    cell = F.pmod(F.xxhash64("doc_id", "h"), F.lit(CELLS)).cast("int")
    counts = light.groupBy(shard_of(F.col("h")).alias("shard"), cell.alias("cell")).count()
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))  # shards * CELLS rows at most
    rows = docs.select(*[F.col(f"`{c}`") for c in names]).select(
        "*",
        (F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("text_crc32"),
        text_hash(F.col("text").cast("string")).alias("_gw_h"),
    )
    rows = rows.withColumn("shard", shard_of(F.col("_gw_h"))).withColumn("_gw_cell", F.pmod(F.xxhash64(F.col("doc_id").cast("long"), "_gw_h"), F.lit(CELLS)).cast("int"))
    place = Window.partitionBy("shard", "_gw_cell").orderBy("_gw_h", "doc_id")
    return (
        rows.withColumn("_gw_n", F.row_number().over(place) - 1)
        .join(F.broadcast(offsets.withColumnsRenamed({"shard": "_gw_s", "cell": "_gw_c", "offset": "_gw_offset"})), (F.col("shard") == F.col("_gw_s")) & (F.col("_gw_cell") == F.col("_gw_c")))
        .select(*[F.col(f"`{c}`") for c in names], "size", "text_crc32", "shard", (F.col("_gw_n") + F.col("_gw_offset")).cast("long").alias("slot"))
    )


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = sharded(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
