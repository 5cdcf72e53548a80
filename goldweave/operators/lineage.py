"""Lineage: what is known about an entity or a record, and why. Every function takes tables by name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import few

Tables = dict[str, DataFrame]


def resolve_entity(t: Tables, entity_id: str, max_hops: int = 16) -> str | None:
    """The active entity that an id stands for; None if unknown; a cycle raises."""
    at = entity_id
    for _ in range(max_hops + 1):
        row = t["entity"].where(F.col("entity_id") == at).select("merged_into_entity_id").first()
        if row is None:
            return None
        if row[0] is None:
            return at
        at = row[0]
    raise ValueError(f"the merges of {entity_id} do not end")


def _golden(t: Tables) -> DataFrame:
    return t["golden_attribute"].where("valid_to IS NULL")


def display_names(t: Tables) -> DataFrame:
    """entity_id, display_name: the smallest of its current full or company names."""
    return _golden(t).where(F.col("canonical_field").isin("full_name", "company_name")).groupBy("entity_id").agg(F.min("value").alias("display_name"))


def entity_summary(t: Tables, entity_id: str) -> DataFrame:
    """Current attributes of an entity, with the number of records that observe it. Merged ids lead to the survivor."""
    at = resolve_entity(t, entity_id)
    seen = t["record_entity_link"].where(F.col("entity_id") == at).groupBy("entity_id").agg(F.countDistinct("record_id").alias("records"), F.countDistinct("source_id").alias("sources"))
    return _golden(t).where(F.col("entity_id") == at).join(seen, "entity_id", "left").orderBy("canonical_field")


def contributions(t: Tables, entity_id: str | None = None, canonical_field: str | None = None) -> DataFrame:
    """The source cells behind entities: file, row, column, raw and normalized value, mapping, verdict.

    The mapping is the one of the batch's own layout, so several layouts of a source do not multiply rows."""
    links = t["record_entity_link"] if entity_id is None else t["record_entity_link"].where(F.col("entity_id") == entity_id)
    obs = t["attribute_observation"] if canonical_field is None else t["attribute_observation"].where(F.col("canonical_field") == canonical_field)
    own = links.select("record_id", F.col("role").alias("subject"), "entity_id")
    out = (
        obs.join(own, ["record_id", "subject"])
        .join(t["raw_record"].select("record_id", "row_number", "source_record_id"), "record_id")
        .join(few(t["batch"].select("batch_id", "file_name", "source_schema_id")), "batch_id")
        .join(few(t["source"].select("source_id", "source_name", "reliability")), "source_id")
        .join(t["record_validation"].select("record_id", F.col("status").alias("validation_status")), "record_id", "left")
        .join(few(t["column_mapping"].select("source_schema_id", "source_column", "mapping_method", "mapping_confidence")), ["source_schema_id", "source_column"], "left")
    )
    return out.select("entity_id", "canonical_field", "source_name", "reliability", "file_name", "row_number", "source_record_id", "record_id", "observation_id", "source_column", "subject", "raw_value", "normalized_value", "validation_status", "mapping_method", "mapping_confidence")


def explain_value(t: Tables, entity_id: str, canonical_field: str) -> dict[str, DataFrame]:
    """golden, contributions (with agreement and judgements) and history of one value."""
    at = resolve_entity(t, entity_id)
    rows = t["golden_attribute"].where((F.col("entity_id") == at) & (F.col("canonical_field") == canonical_field))
    now = rows.where("valid_to IS NULL")
    judged = t["validation_result"].where("observation_id IS NOT NULL").groupBy("observation_id").agg(F.sort_array(F.collect_list(F.struct((F.col("severity") != "error").alias("later"), "rule_id", "severity", "outcome", "message"))).alias("judgements"))  # the rules of one value
    cells = contributions(t, at, canonical_field).join(judged, "observation_id", "left").join(now.select("entity_id", F.col("value").alias("golden_value"), "winning_record_id"), "entity_id", "left")
    return {
        "golden": now,
        "contributions": cells.withColumns({"agrees_with_golden": F.col("normalized_value").eqNullSafe(F.col("golden_value")), "is_winning_record": F.col("record_id") == F.col("winning_record_id")}),
        "history": rows.withColumn("is_current", F.col("valid_to").isNull()).orderBy(F.desc("valid_from")),
    }


def timeline(t: Tables, entity_id: str) -> DataFrame:
    """What happened to an entity: at, event, detail."""
    at = resolve_entity(t, entity_id)
    links = t["record_entity_link"].where(F.col("entity_id") == at)
    raw = t["raw_record"].join(links.select("record_id").distinct(), "record_id", "left_semi").join(few(t["batch"].select("batch_id", "file_name")), "batch_id")
    gold = t["golden_attribute"].where(F.col("entity_id") == at)
    text = lambda *c: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in c])  # noqa: E731  null if any part is
    arm = lambda df, when, event, detail: df.select(F.col(when).alias("at"), F.lit(event).alias("event"), detail.alias("detail"))
    arms = [
        arm(raw, "ingested_at", "record_ingested", text("row ", F.col("row_number").cast("string"), " of ", F.col("file_name"))),
        arm(links, "linked_at", "record_linked", text(F.col("match_method"), " ", F.col("match_confidence").cast("string"))),
        arm(t["quarantine_event"].join(links.select("record_id"), "record_id", "left_semi"), "created_at", "record_quarantined", text(F.col("action"), ": ", F.array_join("reason_codes", ", "))),
        arm(t["entity_merge"].where((F.col("surviving_entity_id") == at) | (F.col("merged_entity_id") == at)), "created_at", "entity_merged", text(F.col("merged_entity_id"), " into ", F.col("surviving_entity_id"))),
        arm(gold, "valid_from", "golden_value_set", text(F.col("canonical_field"), " = ", F.col("value"))),
        arm(gold.where("valid_to IS NOT NULL"), "valid_to", "golden_value_superseded", text(F.col("canonical_field"), " was ", F.col("value"))),
    ]
    return reduce(DataFrame.unionByName, arms).orderBy("at", "event", "detail")


def find_entities(t: Tables, query: str, entity_type: str | None = None, limit: int = 50) -> DataFrame:
    """Entities with an identity key like the query (% and _ are wildcards), active ones, by name; limit: page size."""
    hit = t["entity_identity_key"].where(F.col("key_value").ilike(f"%{query}%")).select("entity_id").distinct()
    live = t["entity"].where("status = 'active'")
    if entity_type is not None:
        live = live.where(F.col("entity_type") == entity_type)
    records = t["record_entity_link"].groupBy("entity_id").agg(F.countDistinct("record_id").alias("record_count"))
    return (
        live.join(hit, "entity_id", "left_semi").join(display_names(t), "entity_id", "left").join(records, "entity_id", "left")
        .select("entity_id", "entity_type", "display_name", F.coalesce("record_count", F.lit(0)).alias("record_count"))
        .orderBy(F.asc_nulls_last("display_name"), "entity_id").limit(limit)
    )


def record_lineage(t: Tables, record_id: str) -> dict[str, DataFrame]:
    """record, verdict, quarantine, links, observations and the golden values that the record has won."""
    of = lambda name, col="record_id": t[name].where(F.col(col) == record_id)
    return {
        "record": of("raw_record"), "verdict": of("record_validation"), "quarantine": of("quarantine_item"), "links": of("record_entity_link"),
        "observations": of("attribute_observation").orderBy("source_column", "value_index"),
        "won": of("golden_attribute", "winning_record_id").where("valid_to IS NULL"),
    }


def relationships(t: Tables, entity_id: str) -> DataFrame:
    """Both directions of an entity's relationships, with the other end's name; ends go through tombstones."""
    from .merge import survivors

    at = resolve_entity(t, entity_id)
    ends = survivors(t["entity"])
    r = t["entity_relationship"]
    for end in ("from_entity_id", "to_entity_id"):
        r = r.join(ends.withColumnsRenamed({"entity_id": end, "survivor_id": f"{end}_now"}), end)
    arm = lambda mine, other, word: r.where(F.col(f"{mine}_now") == at).select(F.lit(word).alias("direction"), F.col(f"{other}_now").alias("entity_id"), "relationship_type", "valid_from", "valid_to")
    both = arm("from_entity_id", "to_entity_id", "outgoing").unionByName(arm("to_entity_id", "from_entity_id", "incoming"))
    return both.join(display_names(t), "entity_id", "left").orderBy(F.asc_nulls_last("display_name"), "entity_id")
