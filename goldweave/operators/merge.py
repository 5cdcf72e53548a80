"""Merged entities: tombstones, merges, reviews of candidates, re-blocking triage, purging a source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import text
from ..scratch import written

MAX_HOPS = 16


def survivors(entities: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """entity_id, survivor_id: where the chain of merges from each entity ends. A longer chain or a cycle raises.

    Pointers are doubled each round, so 16 hops take five joins."""
    at = entities.select("entity_id", F.coalesce("merged_into_entity_id", "entity_id").alias("to"))
    ends = written(at)
    hops = 1
    while hops < max_hops:
        step = ends.select(F.col("entity_id").alias("to"), F.col("to").alias("next"))
        ends = written(ends.join(step, "to", "left").select("entity_id", F.coalesce("next", "to").alias("to")), replaces=ends)
        hops *= 2
    active = entities.where("merged_into_entity_id IS NULL").select(F.col("entity_id").alias("to"))
    lost = ends.join(active, "to", "left_anti").limit(1).collect()
    if lost:
        raise ValueError(f"the merges of {lost[0]['entity_id']} lead to no active entity")
    return ends.withColumnRenamed("to", "survivor_id")


def merge(links: DataFrame, keys: DataFrame, entities: DataFrame, merges: DataFrame, run_ts: Column) -> dict[str, DataFrame]:
    """links, keys, entities after merges, and entity_merge rows. merges: merged_id, surviving_id, actor, reason,
    confidence. Keys that the survivor has already are dropped. Relationships keep their ends; readers go through
    survivors(). Links stay one for each record and role."""
    to = F.broadcast(merges.select(F.col("merged_id").alias("entity_id"), "surviving_id")) if merges.limit(100_001).count() <= 100_000 else merges.select(F.col("merged_id").alias("entity_id"), "surviving_id")
    moved_links = links.join(to, "entity_id", "left")
    moved_keys = keys.join(to, "entity_id", "left")
    records = moved_links.where("surviving_id IS NOT NULL").groupBy(F.col("entity_id").alias("merged_id")).agg(F.count("*").cast("int").alias("records_moved"))
    held = moved_keys.where("surviving_id IS NOT NULL").groupBy(F.col("entity_id").alias("merged_id")).agg(F.count("*").cast("int").alias("keys_moved"))
    audit = (
        merges.join(records, "merged_id", "left").join(held, "merged_id", "left")
        .select(text.stable_id("merge", F.col("merged_id"), F.col("surviving_id")).alias("merge_id"), F.col("merged_id").alias("merged_entity_id"), F.col("surviving_id").alias("surviving_entity_id"), F.col("confidence").alias("match_confidence"), F.coalesce("records_moved", F.lit(0)).alias("records_moved"), F.coalesce("keys_moved", F.lit(0)).alias("keys_moved"), "actor", "reason", run_ts.alias("created_at"))
    )
    return {
        "links": moved_links.withColumn("entity_id", F.coalesce("surviving_id", "entity_id")).select(*links.columns),
        "keys": moved_keys.withColumn("entity_id", F.coalesce("surviving_id", "entity_id")).groupBy("entity_id", "entity_type", "key_type", "key_value").agg(*[F.min(c).alias(c) for c in keys.columns if c not in ("entity_id", "entity_type", "key_type", "key_value")]).select(*keys.columns),
        "entities": entities.join(to, "entity_id", "left").withColumns({"status": F.when(F.col("surviving_id").isNotNull(), "merged").otherwise(F.col("status")), "merged_into_entity_id": F.coalesce("surviving_id", "merged_into_entity_id")}).select(*entities.columns),
        "merges": audit,
    }


def candidate_merge(cands: DataFrame, links: DataFrame, entities: DataFrame, candidate_id: str, actor: str) -> DataFrame:
    """The merge that accepting a candidate asks for: the record's own entity goes into the candidate's. Both ends go
    through tombstones; no row where they are one entity already."""
    ends = survivors(entities)
    own = links.where("role = 'self'").select("record_id", F.col("entity_id").alias("own"))
    one = cands.where(F.col("candidate_id") == candidate_id).join(own, "record_id")
    a = ends.select(F.col("entity_id").alias("own"), F.col("survivor_id").alias("merged_id"))
    b = ends.select("entity_id", F.col("survivor_id").alias("surviving_id"))
    return one.join(a, "own").join(b, "entity_id").where("merged_id <> surviving_id").select("merged_id", "surviving_id", F.lit(actor).alias("actor"), F.lit("candidate accepted").alias("reason"), F.col("match_confidence").alias("confidence"))


def close_candidate(cands: DataFrame, candidate_id: str, status: str, actor: str, note: str | None, run_ts: Column) -> DataFrame:
    hit = (F.col("candidate_id") == candidate_id) & (F.col("status") == "open")
    return cands.withColumns({"status": F.when(hit, status).otherwise(F.col("status")), "reviewed_by": F.when(hit, actor), "review_note": F.when(hit, F.lit(note).cast("string")), "reviewed_at": F.when(hit, run_ts)})


def duplicate_groups(keys: DataFrame, golden: DataFrame, entities: DataFrame, entity_type: str) -> DataFrame:
    """Active entities that share a strong key and a folded name: key_type, key_value, folded, entity_ids (sorted).

    No closure over groups. A group is the entities of one key and name: duplicates that triage is to find, few."""
    live = entities.where((F.col("entity_type") == entity_type) & (F.col("status") == "active")).select("entity_id")
    field = "company_name" if entity_type == "company" else "full_name"
    names = golden.where((F.col("canonical_field") == field) & F.col("valid_to").isNull()).select("entity_id", text.folded_name(F.col("value")).alias("folded")).where("folded <> ''")
    strong = keys.where(F.col("key_type").isin(*sorted({k for v in vocab.STRONG_KEYS.values() for k in v})) & (F.col("strength") == "strong"))
    return (
        strong.join(live, "entity_id").join(names, "entity_id").groupBy("key_type", "key_value", "folded")
        .agg(F.array_sort(F.collect_set("entity_id")).alias("entity_ids")).where("size(entity_ids) > 1")
    )


def survivor_of(groups: DataFrame, links: DataFrame) -> DataFrame:
    """groups with survivor: the entity with most links, then the smallest id."""
    n = links.groupBy("entity_id").agg(F.count("*").alias("n"))
    each = groups.select("key_type", "key_value", "folded", F.explode("entity_ids").alias("entity_id")).join(n, "entity_id", "left")
    best = each.groupBy("key_type", "key_value", "folded").agg(F.min_by("entity_id", F.struct(-F.coalesce("n", F.lit(0)), F.col("entity_id"))).alias("survivor"))
    return groups.join(best, ["key_type", "key_value", "folded"])


def purge(tables: dict[str, DataFrame], names: list[str]) -> dict[str, DataFrame]:
    """Tables without what the named sources brought: rows of their source_id, and entities, keys, golden values and
    relationships that no remaining link supports."""
    gone = F.broadcast(tables["source"].where(F.col("source_name").isin(names)).select("source_id"))
    out = {}
    for name, t in tables.items():
        col = next((c for c in ("source_id", "winning_source_id") if c in t.columns), None)
        out[name] = t if col is None else t.join(gone.withColumnRenamed("source_id", col), col, "left_anti").select(*t.columns)
    records = tables["raw_record"].join(gone, "source_id").select("record_id") if "raw_record" in tables else None
    for name in ("validation_result", "quarantine_event", "match_candidate"):
        if name in out and records is not None:
            out[name] = out[name].join(records, "record_id", "left_anti")
    if "record_entity_link" in out and "entity" in out:
        alive = out["record_entity_link"].select("entity_id").distinct()
        out["entity"] = out["entity"].join(alive.union(out["entity"].where("status = 'merged'").select("entity_id")).distinct(), "entity_id", "left_semi")
        for name in ("entity_identity_key", "golden_attribute"):
            if name in out:
                out[name] = out[name].join(alive, "entity_id", "left_semi")
        if "entity_relationship" in out:
            r = out["entity_relationship"]
            for end in ("from_entity_id", "to_entity_id"):
                r = r.join(alive.withColumnRenamed("entity_id", end), end, "left_semi")
            out["entity_relationship"] = r.select(*out["entity_relationship"].columns)
    return out
