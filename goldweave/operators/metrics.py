"""Gauges, alert conditions, integrity checks and worked reports over the engine's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import few
from . import golden

Tables = dict[str, DataFrame]


def _gauge(name: str, df: DataFrame, value: Column, *labels: str) -> DataFrame:
    pairs = [x for c in labels for x in (F.lit(c), F.col(c).cast("string"))]
    tags = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    grouped = df.groupBy(*labels).agg(value.cast("double").alias("value")) if labels else df.agg(value.cast("double").alias("value"))
    return grouped.select(F.lit(name).alias("name"), tags.cast("map<string,string>").alias("labels"), F.coalesce("value", F.lit(0.0)).alias("value"))


def _age(column: str, run_ts: Column) -> Column:
    return F.coalesce(F.unix_timestamp(run_ts) - F.unix_timestamp(F.min(column)), F.lit(0))


def gauges(t: Tables, run_ts: Column) -> DataFrame:
    """name, labels, value of every gauge, as of run_ts."""
    n = F.count("*")
    failing = t["validation_result"].where("outcome = 'fail'")
    live = golden.current(t["golden_attribute"])
    linked = t["record_entity_link"].where("role = 'self'").select("record_id")
    state = t["golden_attribute"].withColumn("state", F.when(F.col("valid_to").isNull(), "current").otherwise("superseded"))
    all_of = [
        _gauge("batches", t["batch"], n, "status"),
        _gauge("batches_unpublished", t["batch"].where("status = 'completed' AND events_published_at IS NULL"), n),
        _gauge("raw_records", t["raw_record"], n),
        _gauge("mappings", t["column_mapping"], n, "mapping_status"),
        _gauge("oldest_unreviewed_mapping_seconds", t["column_mapping"].where("mapping_status = 'needs_review'"), _age("created_at", run_ts)),
        _gauge("observations", t["attribute_observation"], n),
        _gauge("observations_uncanonical", t["attribute_observation"].where("canonical_field IS NULL"), n),
        _gauge("records_by_verdict", t["record_validation"], n, "status"),
        _gauge("failing_judgements", failing, n, "severity"),
        _gauge("quarantine_items", t["quarantine_item"], n, "status"),
        _gauge("oldest_open_quarantine_seconds", t["quarantine_item"].where("status = 'open'"), _age("quarantined_at", run_ts)),
        _gauge("entities", t["entity"], n, "entity_type", "status"),
        _gauge("match_candidates", t["match_candidate"], n, "status"),
        _gauge("oldest_open_candidate_seconds", t["match_candidate"].where("status = 'open'"), _age("created_at", run_ts)),
        _gauge("records_awaiting_resolution", t["resolvable_record"].join(linked, "record_id", "left_anti"), n),
        _gauge("golden_values", state, n, "state"),
        _gauge("golden_contested", live.where("competing_values > 1"), n),
        _gauge("golden_mean_confidence", live, F.sum("confidence").cast("double") / F.count("confidence"), "entity_type"),  # an average of decimals is rounded at seven digits
        _gauge("golden_low_confidence", live.where("confidence < 0.5"), n),
    ]
    return reduce(DataFrame.unionByName, all_of)


#: Alert: gauge, limit that must be exceeded, severity, gauge it is divided by or None.
ALERTS = {
    "unpublished_batches": ("batches_unpublished", 0, "warning", None),
    "awaiting_resolution": ("records_awaiting_resolution", 0, "info", None),
    "quarantine_not_reviewed": ("oldest_open_quarantine_seconds", 7 * 86400, "warning", None),
    "mapping_not_reviewed": ("oldest_unreviewed_mapping_seconds", 7 * 86400, "warning", None),
    "candidate_not_reviewed": ("oldest_open_candidate_seconds", 14 * 86400, "warning", None),
    "mostly_uncanonical": ("observations_uncanonical", 0.75, "info", "observations"),
}
#: Alert on growth between two readings an hour apart: gauge, label, rows, severity.
GROWTH_ALERTS = {
    "failed_batches_growing": ("batches", ("status", "failed"), 0, "critical"),
    "candidates_growing": ("match_candidates", ("status", "open"), 500, "warning"),
    "invalid_records_growing": ("records_by_verdict", ("status", "invalid"), 100, "warning"),
}
SEVERITY_RANK = {"critical": 0, "warning": 1, "info": 2}


def alerts(now: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """alert, severity, value of the conditions that hold, worst first. before: the gauges of an hour ago."""
    totals = now.groupBy("name").agg(F.sum("value").alias("v"))
    arms = []
    for name, (gauge, limit, severity, per) in ALERTS.items():
        value = F.max(F.when(F.col("name") == gauge, F.col("v")))
        if per:
            value = value / F.nullif(F.max(F.when(F.col("name") == per, F.col("v"))), F.lit(0.0))
        arms.append(totals.agg(value.alias("value")).where(F.col("value") > limit).select(F.lit(name).alias("alert"), F.lit(severity).alias("severity"), "value"))
    if before is not None:
        for name, (gauge, (label, wanted), limit, severity) in GROWTH_ALERTS.items():
            pick = lambda g, sign: g.where((F.col("name") == gauge) & (F.col("labels")[label] == wanted)).select((F.col("value") * sign).alias("d"))  # noqa: B023, E731
            arms.append(pick(now, 1).union(pick(before, -1)).agg(F.sum("d").alias("value")).where(F.col("value") > limit).select(F.lit(name).alias("alert"), F.lit(severity).alias("severity"), "value"))
    rank = F.create_map(*[F.lit(x) for kv in SEVERITY_RANK.items() for x in kv])
    return reduce(DataFrame.unionByName, arms).orderBy(rank[F.col("severity")], "alert")


def alert_summary(active: DataFrame) -> DataFrame:
    return active.groupBy("severity").count()


def checks(t: Tables) -> dict[str, DataFrame]:
    """Integrity checks by name; each has rows only where something is wrong."""
    raw, obs, link, ent = t["raw_record"], t["attribute_observation"], t["record_entity_link"], t["entity"]
    live = golden.current(t["golden_attribute"])
    done = t["batch"].where("status = 'completed'")
    actual = raw.groupBy("batch_id").agg(F.count("*").alias("actual"))
    quarantined = t["quarantine_item"].where("status IN ('open', 'rejected')").select(F.col("record_id").alias("winning_record_id"))
    kind = ent.select("entity_id", F.col("entity_type").alias("is_type"))
    ends = t["entity_relationship"].where("relationship_type = 'employed_at'")
    won = live.join(link.select(F.col("record_id").alias("winning_record_id"), "entity_id", "role"), ["winning_record_id", "entity_id"])
    said = obs.where("canonical_field IS NOT NULL").select(F.col("record_id").alias("winning_record_id"), "canonical_field", F.col("subject").alias("role"))
    return {
        "batch_row_counts": done.join(actual, "batch_id", "left").where(F.coalesce("actual", F.lit(0)) != F.col("rows_ingested")).select("batch_id", "rows_ingested", "actual"),
        "records_without_observations": raw.join(obs.select("record_id"), "record_id", "left_anti").select("record_id"),
        "resolvable_without_entity": t["resolvable_record"].join(done.select("batch_id"), "batch_id", "left_semi").join(link.where("role = 'self'").select("record_id"), "record_id", "left_anti").select("record_id"),
        "quarantined_golden": live.join(quarantined, "winning_record_id", "left_semi").select("golden_id"),
        "several_current_values": live.groupBy("entity_id", "canonical_field").count().where("count > 1"),
        "entities_without_records": ent.where("status = 'active'").join(link.select("entity_id"), "entity_id", "left_anti").select("entity_id"),
        "link_type_mismatch": link.join(kind, "entity_id").where("entity_type <> is_type OR (role = 'employer' AND is_type <> 'company')").select("link_id"),
        "employment_direction": ends.join(kind.withColumnsRenamed({"entity_id": "from_entity_id", "is_type": "a"}), "from_entity_id").join(kind.withColumnsRenamed({"entity_id": "to_entity_id", "is_type": "b"}), "to_entity_id").where("a <> 'person' OR b <> 'company'").select("relationship_id"),
        "employer_on_company_record": obs.where("entity_type = 'company' AND subject = 'employer'").select("observation_id"),
        "merged_without_survivor": ent.where("status = 'merged' AND merged_into_entity_id IS NULL").select("entity_id"),
        "golden_from_other_role": won.select("golden_id").distinct().join(won.join(said, ["winning_record_id", "canonical_field", "role"], "left_semi").select("golden_id"), "golden_id", "left_anti"),
        "errors_without_payload": t["record_error"].where("status = 'open' AND raw_payload_bytes IS NULL").select("error_id"),
    }


# --- worked reports; a limit is the size of the report ---


def trusted(t: Tables, entity_type: str, limit: int = 50) -> DataFrame:
    need = "email" if entity_type == "person" else "address_line1"
    return golden.pivot(t["golden_attribute"], t["entity"], entity_type).where(F.col(need).isNotNull()).orderBy(F.desc("mean_confidence"), f"{entity_type}_id").limit(limit)


def who_works_where(t: Tables, limit: int = 50) -> DataFrame:
    p, c = (golden.pivot(t["golden_attribute"], t["entity"], e) for e in ("person", "company"))
    now = t["entity_relationship"].where("valid_to IS NULL")
    return (
        now.join(p.select(F.col("person_id").alias("from_entity_id"), "full_name", "first_name", "last_name", "job_title", "email"), "from_entity_id")
        .join(c.select(F.col("company_id").alias("to_entity_id"), "company_name", "website", F.col("city").alias("company_city")), "to_entity_id")
        .orderBy(F.asc_nulls_last("company_name"), "from_entity_id").limit(limit)
    )


def top_employers(t: Tables, limit: int = 25) -> DataFrame:
    c = golden.pivot(t["golden_attribute"], t["entity"], "company").select("company_id", "company_name", "website")
    people = t["entity_relationship"].where("valid_to IS NULL").groupBy(F.col("to_entity_id").alias("company_id")).agg(F.count("*").alias("people_found"))
    return people.join(c, "company_id").orderBy(F.desc("people_found"), "company_id").limit(limit)


def disagreements(t: Tables, limit: int = 50) -> DataFrame:
    return golden.current(t["golden_attribute"]).where("competing_values > 1").orderBy(F.desc("competing_values"), "confidence", "entity_id", "canonical_field").limit(limit)


def all_columns(t: Tables, record_id: str) -> DataFrame:
    """Every cell of a record, canonical or not."""
    return t["attribute_observation"].where(F.col("record_id") == record_id).orderBy(F.col("canonical_field").isNull(), "source_column", "value_index")


def queues(t: Tables) -> DataFrame:
    """What waits for a human."""
    arms = {"mapping needs review": t["column_mapping"].where("mapping_status = 'needs_review'"), "quarantined records": t["quarantine_item"].where("status = 'open'"), "possible duplicate entities": t["match_candidate"].where("status = 'open'"), "rows that failed to process": t["record_error"].where("status = 'open'")}
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("items")).select(F.lit(k).alias("queue"), "items") for k, df in arms.items()])


def contribution_report(t: Tables) -> DataFrame:
    """Files, records and entities that each source brought; sources without any too."""
    done = t["batch"].where("status = 'completed'")
    files = done.groupBy("source_id").agg(F.countDistinct("batch_id").alias("files"))
    records = t["raw_record"].join(few(done.select("batch_id")), "batch_id", "left_semi")
    counted = records.groupBy("source_id").agg(F.countDistinct("record_id").alias("records"))
    entities = records.select("record_id", "source_id").join(t["record_entity_link"].select("record_id", "entity_id"), "record_id").groupBy("source_id").agg(F.countDistinct("entity_id").alias("entities"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return t["source"].join(files, "source_id", "left").join(counted, "source_id", "left").join(entities, "source_id", "left").select("source_name", "reliability", zero("files"), zero("records"), zero("entities")).orderBy(F.desc("records"), "source_name")


def low_confidence(t: Tables, competing: int = 20, limit: int = 30) -> DataFrame:
    c = golden.pivot(t["golden_attribute"], t["entity"], "company").select(F.col("company_id").alias("entity_id"), "company_name")
    naming = t["record_entity_link"].where("role = 'employer'").groupBy("entity_id").agg(F.count("*").alias("records_naming_it"))
    return (
        golden.current(t["golden_attribute"]).where(F.col("competing_values") > competing).join(c, "entity_id").join(naming, "entity_id", "left")
        .select("company_name", "canonical_field", F.left("value", F.lit(40)).alias("chosen_value"), "confidence", "supporting_sources", "competing_values", F.coalesce("records_naming_it", F.lit(0)).alias("records_naming_it"))
        .orderBy(F.desc("competing_values"), "company_name", "canonical_field").limit(limit)
    )


def parity(a: Tables, b: Tables, columns: dict[str, list[str]]) -> DataFrame:
    """table, side, rows: what one of two runs has and the other lacks, repeats counted. No rows: they agree."""
    arms = []
    for name, cols in columns.items():
        x, y = a[name].select(*cols), b[name].select(*cols)
        arms += [d.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), F.lit(side).alias("side"), "rows") for side, d in (("first only", x.exceptAll(y)), ("second only", y.exceptAll(x)))]
    return reduce(DataFrame.unionByName, arms).where("rows > 0")
