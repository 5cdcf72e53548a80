"""Lists that people work through, and lookups of batches. A limit is the size of a page."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matching(df: DataFrame, **wanted: object) -> DataFrame:
    """Rows whose columns equal the given values; None asks for nothing."""
    tests = [F.col(c) == v for c, v in wanted.items() if v is not None]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def mappings(column_mapping: DataFrame, source_schema: DataFrame, source: DataFrame, source_schema_id: str | None = None, status: str | None = None) -> DataFrame:
    """Mappings with their source, in the order of confidence."""
    found = matching(column_mapping, source_schema_id=source_schema_id, mapping_status=status)
    named = source_schema.select("source_schema_id", "source_id", "entity_type").join(F.broadcast(source.select("source_id", "source_name")), "source_id")
    return found.join(F.broadcast(named), "source_schema_id").orderBy("source_name", F.desc("mapping_confidence"), "source_column")


def candidates(match_candidate: DataFrame, status: str | None = "open", limit: int = 50) -> DataFrame:
    """Possible duplicates, the most likely first."""
    return matching(match_candidate, status=status).orderBy(F.desc("match_confidence"), "created_at", "candidate_id").limit(limit)


def candidate(match_candidate: DataFrame, links: DataFrame, candidate_id: str) -> DataFrame:
    """One candidate with the entity that its record has now."""
    own = links.where("role = 'self'").select("record_id", F.col("entity_id").alias("own_entity_id"))
    return match_candidate.where(F.col("candidate_id") == candidate_id).join(own, "record_id", "left")


def errors(record_error: DataFrame, batch_id: str | None = None, limit: int = 50) -> DataFrame:
    """Open errors, newest first."""
    return matching(record_error, status="open", batch_id=batch_id).orderBy(F.desc("occurred_at"), "row_number", "error_id").limit(limit)


def error_count(record_error: DataFrame, batch_id: str) -> DataFrame:
    return matching(record_error, status="open", batch_id=batch_id).agg(F.count("*").alias("open_errors"))


def completed_batch(batch: DataFrame, source_id: str, file_hash: str) -> DataFrame:
    """The newest completed batch of a file."""
    return matching(batch, source_id=source_id, file_hash=file_hash, status="completed").orderBy(F.desc("started_at"), "batch_id").limit(1)


def running_batch(batch: DataFrame, source_id: str, file_hash: str) -> DataFrame:
    """The oldest batch of a file that is in flight."""
    return matching(batch, source_id=source_id, file_hash=file_hash, status="running").orderBy("started_at", "batch_id").limit(1)


def same_file_elsewhere(batch: DataFrame, source: DataFrame, source_id: str, file_hash: str) -> DataFrame:
    """Completed batches of other sources with the same content."""
    found = matching(batch, file_hash=file_hash, status="completed").where(F.col("source_id") != source_id)
    return found.join(F.broadcast(source.select("source_id", "source_name")), "source_id").select("batch_id", "source_name")


def entity_sources(links: DataFrame, source: DataFrame, entity_id: str) -> DataFrame:
    """Sources that observe an entity, with their records."""
    n = links.where(F.col("entity_id") == entity_id).groupBy("source_id").agg(F.countDistinct("record_id").alias("records"))
    return n.join(F.broadcast(source.select("source_id", "source_name", "reliability")), "source_id")


def entities_of_batch(links: DataFrame, entities: DataFrame, batch_id: str) -> DataFrame:
    """Active entities that a batch touched, in any role."""
    return links.where(F.col("batch_id") == batch_id).select("entity_id").distinct().join(entities.where("status = 'active'").select("entity_id", "entity_type"), "entity_id")
