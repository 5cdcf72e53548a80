"""Normalization: raw records to observations, one row for each value of each cell; raw values never change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import text


def value_types(spark) -> DataFrame:
    """entity_type, subject, canonical_field, value_type of the vocabulary (65 rows)."""
    return spark.createDataFrame([(f.entity_type, f.subject, f.name, f.value_type) for f in vocab.vocabulary()], "entity_type string, subject string, canonical_field string, value_type string")


def observations(raw: DataFrame, mappings: DataFrame) -> DataFrame:
    """Observations of raw records.

    raw: record_id, batch_id, source_id, entity_type, raw_payload (map), ingested_at. mappings: batch_id, source_column,
    canonical_field, mapping_status, subject. A column without mapping keeps its values with no field. An absent cell
    (null) is one observation with an empty raw value and method type:absent."""
    types = F.broadcast(value_types(raw.sparkSession))
    cells = raw.select("record_id", "batch_id", "source_id", "entity_type", F.col("ingested_at").alias("observed_at"), F.explode("raw_payload").alias("source_column", "cell"))
    mapped = cells.join(F.broadcast(mappings.select("batch_id", "source_column", "canonical_field", "mapping_status", "subject")), ["batch_id", "source_column"], "left")
    typed = (
        mapped.withColumn("subject", F.coalesce("subject", F.lit("self")))
        .join(types, ["entity_type", "subject", "canonical_field"], "left")
        .withColumn("value_type", F.coalesce("value_type", F.lit("text")))
    )
    absent = F.col("cell").isNull()
    split = typed.withColumn("absent", absent).select("*", F.posexplode(F.when(absent, F.array(F.lit(""))).otherwise(text.split_values(F.col("cell"), F.col("value_type")))).alias("value_index", "raw_value"))
    norm = split.withColumn("n", text.normalized(F.col("raw_value"), F.col("value_type")))
    return norm.select(
        text.stable_id("observation", F.col("record_id"), F.col("source_column"), F.col("value_index")).alias("observation_id"),
        "record_id", "batch_id", "source_id", "entity_type", "source_column", "canonical_field",
        F.coalesce("mapping_status", F.lit("unmapped")).alias("mapping_status"),
        "value_index", "raw_value", "n.normalized_value", "value_type",
        F.when(F.col("absent"), F.concat("value_type", F.lit(":absent"))).otherwise(F.col("n.normalization_method")).alias("normalization_method"),
        (F.col("absent") | F.col("n.is_null_token")).alias("is_null_token"),
        "observed_at", "subject",
    )


def confirmed(obs: DataFrame) -> DataFrame:
    """Observations that count for identity and golden values: an accepted mapping and a value."""
    return obs.where(F.col("mapping_status").isin("auto_accepted", "approved") & F.col("canonical_field").isNotNull() & F.col("normalized_value").isNotNull())


def observation_counts(obs: DataFrame) -> DataFrame:
    """One row: total, canonical, uncanonical, null_tokens, extra_values."""
    return obs.agg(
        F.count("*").alias("total"),
        F.count("canonical_field").alias("canonical"),
        F.count_if(F.col("canonical_field").isNull()).alias("uncanonical"),
        F.count_if("is_null_token").alias("null_tokens"),
        F.count_if(F.col("value_index") > 0).alias("extra_values"),
    )
