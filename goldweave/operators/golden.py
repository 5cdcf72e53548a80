"""Golden values: one winner for each entity and field, by the field's strategy, with confidence and history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab
from ..functions import text

_D = "decimal(5,3)"


def strategy_of(entity_type: Column, field: Column) -> Column:
    cases = reduce(lambda acc, kv: acc.when((entity_type == kv[0][0]) & (field == kv[0][1]), kv[1]), vocab.FIELD_STRATEGY.items(), F.when(F.lit(False), ""))
    return cases.otherwise(vocab.MOST_RELIABLE)


def confidence(reliability: Column, supporting: Column, dissenting: Column) -> Column:
    """Reliability, more for sources that agree, less for sources that say otherwise; decimal(4,3)."""
    d = lambda s: F.lit(s).cast(_D)
    score = reliability.cast(_D) + (d(vocab.AGREEMENT_BONUS) * (supporting - 1).cast("decimal(18,0)")) - (d(vocab.DISAGREEMENT_PENALTY) * dissenting.cast("decimal(18,0)"))
    return F.least(d(vocab.MAX_CONFIDENCE), F.greatest(d(vocab.MIN_CONFIDENCE), score)).cast("decimal(4,3)")


def choices(claims: DataFrame) -> DataFrame:
    """The chosen value of each entity and field.

    claims: entity_id, entity_type, canonical_field, value, raw_value, source_id, source_name, reliability, record_id,
    observed_at. Empty values are no claims. Ties end at the record id, so every choice is repeatable. All is grouped
    minima and sums with partial aggregation: first by value and source (which a hot entity cannot inflate beyond its
    distinct pairs), then by value, then by field."""
    used = claims.where("value IS NOT NULL AND value <> ''")
    chain = F.struct((-F.col("reliability")).alias("r"), (-F.unix_micros(F.col("observed_at").cast("timestamp"))).alias("t"), "source_name", "value", "record_id", "raw_value", "source_id", "reliability")
    micros = F.unix_micros(F.col("observed_at").cast("timestamp"))
    key = ["entity_id", "entity_type", "canonical_field"]
    per_source = used.groupBy(*key, "value", "source_id").agg(
        F.min(chain).alias("best"),
        F.min(F.struct((-micros).alias("t0"), chain.alias("c"))).alias("newest"),
        F.min(F.struct(micros.alias("t0"), chain.alias("c"))).alias("oldest"),
        F.min("source_name").alias("source_name"),
    )
    per_value = per_source.groupBy(*key, "value").agg(
        F.count("*").alias("sources"), F.min("best").alias("best"), F.min("newest").alias("newest"), F.min("oldest").alias("oldest"),
        F.array_sort(F.collect_set("source_name")).alias("source_names"),
        F.collect_set("source_id").alias("source_ids"),
    )
    per_field = per_value.groupBy(*key).agg(
        F.count("*").alias("competing_values"),
        F.min("best").alias("reliable"),
        F.min("newest").alias("newest"),
        F.min("oldest").alias("oldest"),
        F.min(F.struct((-F.col("sources")).alias("n"), F.col("best").alias("c"))).alias("frequent"),
        # distinct values of one field of one entity, with the sources of each
        F.collect_list(F.struct("value", "source_names", F.col("sources").alias("supporting_sources"), "source_ids")).alias("all"),
    )
    picked = per_field.withColumn("strategy", strategy_of(F.col("entity_type"), F.col("canonical_field"))).withColumn(
        "w",
        F.when(F.col("strategy") == vocab.MOST_FREQUENT, F.col("frequent.c"))
        .when(F.col("strategy") == vocab.MOST_RECENT, F.col("newest.c"))
        .when(F.col("strategy") == vocab.EARLIEST, F.col("oldest.c"))
        .otherwise(F.col("reliable")),
    )
    winner = F.filter("all", lambda x: x["value"] == F.col("w.value"))[0]
    others = F.filter("all", lambda x: x["value"] != F.col("w.value"))
    counted = picked.withColumns({
        "supporting_sources": winner["supporting_sources"].cast("int"),
        "dissenting": F.size(F.array_distinct(F.flatten(F.transform(others, lambda x: x["source_ids"])))),
    })
    return counted.select(
        *key, F.col("w.value").alias("value"), F.col("w.raw_value").alias("raw_value"), "strategy",
        confidence(F.col("w.reliability"), F.col("supporting_sources"), F.col("dissenting")).alias("confidence"),
        F.col("w.record_id").alias("winning_record_id"), F.col("w.source_id").alias("winning_source_id"),
        "supporting_sources", F.col("competing_values").cast("int").alias("competing_values"),
        F.to_json(F.struct(
            F.col("strategy").alias("won_by"), F.col("w.source_name").alias("winning_source"), F.col("w.reliability").alias("winning_source_reliability"),
            winner["source_names"].alias("agreeing_sources"),
            F.transform(F.array_sort(others), lambda x: F.struct(x["value"].alias("value"), x["source_names"].alias("sources"), x["supporting_sources"].alias("supporting_sources"))).alias("alternatives"),
        )).alias("evidence"),
    )


def claims(obs: DataFrame, links: DataFrame, source: DataFrame) -> DataFrame:
    """Claims of confirmed observations for the entity that their record has in the observations' role."""
    own = links.select("record_id", F.col("role").alias("subject"), "entity_id", F.col("entity_type").alias("linked_type"))
    return (
        obs.join(own, ["record_id", "subject"])
        .join(F.broadcast(source.select("source_id", "source_name", "reliability")), "source_id")
        .select("entity_id", F.col("linked_type").alias("entity_type"), "canonical_field", F.col("normalized_value").alias("value"), "raw_value", "source_id", "source_name", "reliability", "record_id", "observed_at")
    )


def diff(new: DataFrame, current: DataFrame, run_ts: Column) -> DataFrame:
    """All rows of the golden table for the entities in question, after comparing choices with current rows (valid_to
    null): outcome is written, refreshed, unchanged, closed or retired. An unchanged value keeps valid_from."""
    key = ["entity_id", "canonical_field"]
    n = new.select(*key, F.struct(*[c for c in new.columns if c not in key]).alias("n"))
    c = current.select(*key, F.struct(*[x for x in current.columns if x not in key]).alias("c"))
    both = n.join(c, key, "full_outer")
    same = F.col("n").isNotNull() & F.col("c").isNotNull() & (F.col("n.value") == F.col("c.value"))
    moved = (F.col("n.supporting_sources") != F.col("c.supporting_sources")) | (F.col("n.competing_values") != F.col("c.competing_values")) | (F.col("n.confidence") != F.col("c.confidence"))
    new_id = text.stable_id("golden", F.col("entity_id"), F.col("canonical_field"), F.col("n.value"), run_ts)
    outcomes = F.when(same & moved, F.array(F.lit("refreshed"))).when(same, F.array(F.lit("unchanged"))).when(F.col("n").isNull(), F.array(F.lit("retired"))).when(F.col("c").isNull(), F.array(F.lit("written"))).otherwise(F.array(F.lit("closed"), F.lit("written")))
    rows = both.withColumn("outcome", F.explode(outcomes)).withColumn("new_id", new_id)
    old, fresh = F.col("outcome").isin("unchanged", "closed", "retired"), F.col("outcome") == "written"
    pick = lambda name: F.when(old, F.col(f"c.{name}")).otherwise(F.col(f"n.{name}")).alias(name)
    return rows.select(
        F.when(fresh, F.col("new_id")).otherwise(F.col("c.golden_id")).alias("golden_id"),
        *key, pick("entity_type"), pick("value"), pick("raw_value"),
        F.when(fresh, F.col("n.strategy")).otherwise(F.col("c.strategy")).alias("strategy"),
        pick("confidence"), pick("winning_record_id"), pick("winning_source_id"), pick("supporting_sources"), pick("competing_values"), pick("evidence"),
        F.when(fresh, run_ts).otherwise(F.col("c.valid_from")).alias("valid_from"),
        F.when(F.col("outcome").isin("closed", "retired"), run_ts).alias("valid_to"),
        F.when(F.col("outcome") == "closed", F.col("new_id")).alias("superseded_by"),
        "outcome",
    )


def current(golden: DataFrame) -> DataFrame:
    return golden.where("valid_to IS NULL")


def history(golden: DataFrame) -> DataFrame:
    return golden.withColumn("is_current", F.col("valid_to").isNull()).orderBy("entity_id", "canonical_field", F.desc("valid_from"))


def scd2(changes: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Intervals of a value that is reported over time: key, value, valid_from, valid_to (null: still so).

    Repeats of the value in force start no interval. Reports of one key at one time count once, the largest value."""
    w = Window.partitionBy(key).orderBy(at)
    reports = changes.groupBy(key, at).agg(F.max(value).alias(value))
    starts = reports.withColumn("before", F.lag(value).over(w)).where(~F.col("before").eqNullSafe(F.col(value)))
    return starts.select(key, value, F.col(at).alias("valid_from"), F.lead(at).over(w).alias("valid_to"))


def pivot(golden: DataFrame, entities: DataFrame, entity_type: str) -> DataFrame:
    """A row for each active entity: its fields as columns, their number, and their mean confidence."""
    names = vocab.PERSON_PIVOT if entity_type == "person" else vocab.COMPANY_PIVOT
    live = entities.where((F.col("entity_type") == entity_type) & (F.col("status") == "active")).select("entity_id")
    return (
        current(golden).join(live, "entity_id")
        .groupBy(F.col("entity_id").alias(f"{entity_type}_id"))
        .agg(*[F.max(F.when(F.col("canonical_field") == f, F.col("value"))).alias(f) for f in names], F.count("*").alias("golden_fields"), F.round(F.avg("confidence"), 3).alias("mean_confidence"))
    )


def golden_counts(golden: DataFrame) -> DataFrame:
    live = F.col("valid_to").isNull()
    return golden.agg(
        F.count_if(live).alias("current"), F.count_if(~live).alias("superseded"),
        F.countDistinct(F.when(live, F.col("entity_id"))).alias("entities"),
        F.count_if(live & (F.col("competing_values") > 1)).alias("contested"),
    )


def contested_entities(golden: DataFrame, entities: DataFrame) -> DataFrame:
    live = entities.where("status = 'active'").select("entity_id", "entity_type")
    return current(golden).where("competing_values > 1").select("entity_id").distinct().join(live, "entity_id")
