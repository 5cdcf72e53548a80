"""Mixing sources to target weights by hash-threshold histograms.

Each source gets a target of words. Whole passes over a source are counts; for the part of a pass that remains, the
documents below a hash threshold are taken. The threshold comes from sums of words by source and hash bucket: the
bucket that the budget falls into is the only one refined, by the next bits of the hash, until it holds one hash. No
sort, no sample; a larger budget takes a superset, so thresholds nest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import only, words, written

#: Weights of the sources in order of their names, repeating; share of all words to take; passes over a source at most.
WEIGHTS, SHARE_PERCENT, MAX_PASSES = (5, 2, 1), 150, 2
#: Bits of the hash that one histogram level looks at; 60 bits are used.
LEVEL_BITS, HASH_BITS = 10, 60


def hash60(c) -> F.Column:
    """The first 60 bits of the MD5 of a number's decimal text (null: of "null"), 0 or more."""
    return F.conv(F.substring(F.md5(F.coalesce(c.cast("string"), F.lit("null")).cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, passes: int = MAX_PASSES) -> DataFrame:
    """source, source_size, target for sizes(source, source_size), one row a source.

    Sources in code-point order, null last, get the weights in turn. The budget is shared by weight; a target stops at
    `passes` times its source's size and the rest is shared again until none is above. In closed form: sources ordered
    by size over weight fill up first, so the level is found from running sums. The windows run over one row a source."""
    n = len(weights)
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    fill = Window.orderBy((F.col("source_size") / F.col("w")), F.col("rank")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("w", F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("rank") % n + 1).cast("int")).cast("long"))
    # in hundredths of words, so that all sums are whole numbers
    running = (
        ranked.withColumn("budget", F.sum("source_size").over(everything) * share_percent)
        .withColumn("cap", F.col("source_size") * passes * 100)
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(fill), F.lit(0)))
        .withColumn("w_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(fill), F.lit(0)))
        .withColumn("level", (F.col("budget") - F.col("caps_before")).cast("double") / F.col("w_left"))
        .withColumn("full", F.col("level") * F.col("w") >= F.col("cap"))
    )
    # the sources that fill up come first; the first that does not sets the level of all after it
    first = F.min(F.when(~F.col("full"), F.struct((F.col("source_size") / F.col("w")).alias("ratio"), "rank", "level"))).over(everything)
    return (
        running.withColumn("share", first["level"])
        .select("source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("share") * F.col("w")).alias("t"))
        .select("source", "source_size", (F.least("t", F.col("source_size") * float(passes * 100)) / 100).alias("target"))
    )


#: One row a source is broadcast up to this number of sources (some 10 MB); beyond it the joins shuffle.
BROADCAST_SOURCES = 100_000


def _sized(docs: DataFrame) -> DataFrame:
    base = only(docs, doc_id="long", source="string", text="string")
    return written(base.select("doc_id", "source", words(F.col("text")).alias("size"), hash60(F.col("doc_id")).alias("h")))


def cuts(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, passes: int = MAX_PASSES) -> DataFrame:
    """s (source), source_size, target, whole, below for rows(doc_id, source, size, h): the mix takes each document of
    the source `whole` times, and once more if its h is less than below."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = written(
        targets(sizes, weights, share_percent, passes)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    out = written(_thresholds(rows, plan))
    return F.broadcast(out) if out.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else out


def epochs() -> F.Column:
    """Times that the mix takes a row, over the columns size, h, whole, below."""
    return F.when(F.col("size") > 0, F.col("whole") + (F.col("h") < F.col("below")).cast("int")).otherwise(0)


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, passes: int = MAX_PASSES) -> DataFrame:
    """doc_id, source, size, h, source_size, target, epochs for each row: how often the mix takes the document.

    The part of a pass takes the documents with the smallest hashes of doc_id; the one at the boundary is in if that
    comes nearer to the target (a tie: out). Rows with equal doc_id go together. Documents without words are never
    taken. Null doc_ids share one hash, a null source is a source, an empty table gives no rows."""
    rows = _sized(docs)
    plan = cuts(rows, weights, share_percent, passes)
    joined = rows.join(plan, rows["source"].eqNullSafe(F.col("s")))
    return joined.select("doc_id", "source", "size", "h", "source_size", "target", epochs().alias("epochs"))


def taken(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, passes: int = MAX_PASSES) -> DataFrame:
    """The mix itself: the rows of docs, all columns, each as often as mixed() says. Texts are not shuffled."""
    plan = cuts(_sized(docs), weights, share_percent, passes).select("s", "whole", "below")
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("source").cast("string").alias("_source"), hash60(F.col("doc_id").cast("long")).alias("h"), words(F.col("text").cast("string")).alias("size"))
    joined = rows.join(plan, F.col("_source").eqNullSafe(F.col("s"))).withColumn("epochs", epochs()).where("epochs > 0")
    repeated = joined if passes == 1 else joined.select("row", F.explode(F.sequence(F.lit(1), F.col("epochs"))).alias("_n"))
    return repeated.select(*[F.col("row").getField(c).alias(c) for c in names])


def _thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """plan with s (its source) and below: documents of the source with h < below make up the part of a pass."""
    state = plan.select(F.col("source").alias("s"), "source_size", "target", "whole", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"), F.lit(None).cast("long").alias("last"))
    bits = 0
    while bits < HASH_BITS:
        bits += LEVEL_BITS
        shift = HASH_BITS - bits
        bucket = F.shiftright("h", shift)
        # rows of the boundary bucket of their source only; all rows at first
        inside = rows if bits == LEVEL_BITS else rows.join(open_state.select(F.col("s"), F.col("prefix")), F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix"))).drop("s", "prefix")
        counted = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        hist = counted.withColumn("prior", F.coalesce(F.sum("words").over(running), F.lit(0)))
        at = hist.join(state, F.col("source").eqNullSafe(F.col("s"))).where("last IS NULL").withColumn("prior", F.col("prior") + F.col("before"))
        # the bucket in which the running sum passes what is left of the target
        hit = at.where("prior <= rest AND rest < prior + words").select(F.col("s").alias("s2"), F.col("bucket"), "prior", "words", "lo", "hi")
        state = written(
            state.join(hit, F.col("s").eqNullSafe(F.col("s2")), "left").select(
                "s", "source_size", "target", "whole", "rest",
                F.coalesce("bucket", "prefix").alias("prefix"),
                F.coalesce("prior", "before").alias("before"),
                # one hash in the bucket: it is in if that comes nearer to the target
                F.coalesce(
                    "last",
                    F.when(F.col("s2").isNull() & F.col("bucket").isNull(), F.lit(0).cast("long")),
                    F.when(F.col("lo") == F.col("hi"), F.col("lo") + (F.col("prior") + F.col("words") - F.col("rest") < F.col("rest") - F.col("prior")).cast("long")),
                ).alias("last"),
            )
        )
        open_state = state.where("last IS NULL")
        if open_state.isEmpty():
            break
    return state.select("s", "source_size", "target", "whole", F.col("last").alias("below"))


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size")).cast("long").alias("taken"))


#: The same in DuckDB: running sums over the hash order stand for the histograms.
OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15)) AS BIGINT) AS h FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS rank FROM s
), w AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM r
), f AS (
  SELECT *, source_size * 200 AS cap, sum(source_size) OVER () * 150 AS budget,
         coalesce(sum(source_size * 200) OVER q, 0) AS caps_before, sum(w) OVER () - coalesce(sum(w) OVER q, 0) AS w_left
  FROM w WINDOW q AS (ORDER BY CAST(source_size AS DOUBLE) / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT *, CAST(budget - caps_before AS DOUBLE) / CAST(w_left AS DOUBLE) AS level FROM f
), g AS (
  SELECT *, level * w >= cap AS is_full FROM l
), t AS (
  SELECT source, source_size, least(CASE WHEN is_full THEN CAST(cap AS DOUBLE)
           ELSE (SELECT min_by(level, rn) FROM (SELECT level, row_number() OVER (ORDER BY CAST(source_size AS DOUBLE) / w, rank) AS rn FROM g WHERE NOT is_full)) * w END,
         CAST(source_size AS DOUBLE) * 200.0) / CAST(100 AS DOUBLE) AS target FROM g
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t
), m AS (
  SELECT source, h, sum(size) AS words FROM d GROUP BY source, h
), c AS (
  SELECT m.source, m.h, m.words, target - whole * source_size AS rest,
         coalesce(sum(words) OVER (PARTITION BY m.source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
  FROM m JOIN p ON m.source IS NOT DISTINCT FROM p.source
), k AS (
  SELECT source, h, (prior + words <= rest) OR (prior <= rest AND rest < prior + words AND prior + words - rest < rest - prior) AS more FROM c
)
SELECT d.doc_id, d.size, p.source_size, p.target,
       CAST(CASE WHEN d.size > 0 THEN d.size * (p.whole + CASE WHEN k.more THEN 1 ELSE 0 END) ELSE 0 END AS BIGINT) AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.h = k.h
"""
