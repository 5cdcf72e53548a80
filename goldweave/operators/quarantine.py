"""Quarantine: a pure function of a verdict and the current item, human reviews, and the gate to resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

OPEN, RELEASED, REJECTED, RESOLVED = "open", "released", "rejected", "resolved"


def action(status: Column, reasons: Column, item_status: Column, item_reasons: Column) -> Column:
    """What happens to the item of a record: quarantined, reasons_changed, reopened, resolved, or null for nothing.

    status: of the verdict; reasons: its sorted error rules. A rejected item is terminal."""
    invalid = status == "invalid"
    changed = ~reasons.eqNullSafe(F.array_sort(item_reasons))
    return (
        F.when(invalid & item_status.isNull(), "quarantined")
        .when(invalid & (item_status == OPEN) & changed, "reasons_changed")
        .when(invalid & (item_status == RELEASED) & changed, "reopened")
        .when(invalid & (item_status == RESOLVED), "quarantined")
        .when(~invalid & item_status.isin(OPEN, RELEASED), "resolved")
    )


def route(verdicts: DataFrame, items: DataFrame, run_ts: Column) -> DataFrame:
    """Transitions of the verdicts' records: record_id, quarantine_id, action, from_status, to_status, reason_codes,
    added (reasons that are new), and the columns of the record."""
    current = items.select("record_id", F.col("status").alias("item_status"), F.col("reason_codes").alias("item_reasons"))
    judged = verdicts.join(current, "record_id", "left").withColumn("action", action(F.col("status"), F.col("error_rules"), F.col("item_status"), F.col("item_reasons")))
    done = F.col("action") == "resolved"
    return judged.where("action IS NOT NULL").select(
        text.stable_id("quarantine", F.col("record_id")).alias("quarantine_id"),
        "record_id", "batch_id", "source_id", "entity_type", "action",
        F.col("item_status").alias("from_status"),
        F.when(done, RESOLVED).otherwise(OPEN).alias("to_status"),
        F.when(done, F.array().cast("array<string>")).otherwise(F.col("error_rules")).alias("reason_codes"),
        F.array_except(F.col("error_rules"), F.coalesce("item_reasons", F.array().cast("array<string>"))).alias("added"),
        "error_count", run_ts.alias("at"),
    )


def items_from(transitions: DataFrame) -> DataFrame:
    """Item rows to write over those with the same record_id."""
    return transitions.select(
        "quarantine_id", "record_id", "batch_id", "source_id", "entity_type", F.col("to_status").alias("status"), "reason_codes",
        F.col("error_count").cast("int").alias("error_count"), F.col("at").alias("quarantined_at"),
        F.lit(None).cast("timestamp").alias("reviewed_at"), F.lit(None).cast("string").alias("reviewed_by"), F.lit(None).cast("string").alias("review_note"), F.col("at").alias("updated_at"),
    )


def events_from(transitions: DataFrame) -> DataFrame:
    """Event rows to append; ids depend on record, action and time, so a retry adds none."""
    return transitions.select(
        text.stable_id("event", F.col("record_id"), F.col("action"), F.col("at")).alias("event_id"),
        "quarantine_id", "record_id", "action", "from_status", "to_status", "reason_codes", F.lit("pipeline").alias("actor"),
        F.when(F.col("action").isin("reasons_changed", "reopened"), F.concat(F.lit("new: "), F.array_join("added", ", "))).alias("note"), F.col("at").alias("created_at"),
    )


def reviewed_status(verb: str, status: str) -> str:
    """The status that a reviewer's verb (release, reject, reopen) leads to, or ValueError where it may not."""
    wanted = {"release": RELEASED, "reject": REJECTED, "reopen": OPEN}[verb]
    if status == wanted or (verb != "reopen" and status == RESOLVED):
        raise ValueError(f"cannot {verb} an item that is {status}")
    return wanted


def review(items: DataFrame, record_id: str, verb: str, actor: str, note: str | None, run_ts: Column) -> tuple[DataFrame, DataFrame]:
    """(item row, event row) of a human decision on one record's item."""
    one = items.where(F.col("record_id") == record_id)
    found = one.select("status").first()
    if found is None:
        raise KeyError(record_id)
    to = reviewed_status(verb, found["status"])
    done = {"release": "released", "reject": "rejected", "reopen": "reopened"}[verb]
    item = one.withColumns({"status": F.lit(to), "reviewed_at": run_ts, "reviewed_by": F.lit(actor), "review_note": F.lit(note).cast("string"), "updated_at": run_ts})
    event = one.select(
        text.stable_id("event", F.col("record_id"), F.lit(done), run_ts).alias("event_id"), "quarantine_id", "record_id", F.lit(done).alias("action"),
        F.col("status").alias("from_status"), F.lit(to).alias("to_status"), "reason_codes", F.lit(actor).alias("actor"), F.lit(note).cast("string").alias("note"), run_ts.alias("created_at"),
    )
    return item, event


def resolvable(raw: DataFrame, verdicts: DataFrame, items: DataFrame) -> DataFrame:
    """The gate: records with an accepted verdict or a release, and never a rejected one. Null statuses follow SQL."""
    v = verdicts.select("record_id", F.col("status").alias("validation_status"))
    q = items.select("record_id", F.col("status").alias("quarantine_status"))
    open_gate = (F.col("quarantine_status").isNull() | (F.col("quarantine_status") != REJECTED)) & (F.col("validation_status").isin("valid", "warning") | (F.col("quarantine_status") == RELEASED))
    return raw.join(v, "record_id").join(q, "record_id", "left").where(open_gate).withColumn("was_quarantined", F.col("quarantine_status").isNotNull())


def quarantine_counts(items: DataFrame) -> DataFrame:
    return items.agg(*[F.count_if(F.col("status") == s).alias(s) for s in (OPEN, RELEASED, REJECTED, RESOLVED)])


def listed(items: DataFrame, raw: DataFrame, batch: DataFrame, source: DataFrame, status: str | None = OPEN, entity_type: str | None = None, limit: int = 50) -> DataFrame:
    """Items with file and source names, oldest first; limit is the page size."""
    found = items
    for column, value in (("status", status), ("entity_type", entity_type)):
        if value is not None:
            found = found.where(F.col(column) == value)
    return (
        found.join(raw.select("record_id", "row_number", "source_record_id"), "record_id")
        .join(batch.select("batch_id", "file_name"), "batch_id")
        .join(source.select("source_id", "source_name"), "source_id")
        .orderBy("quarantined_at", "row_number", "record_id")
        .limit(limit)
    )


def history(events: DataFrame, record_id: str) -> DataFrame:
    return events.where(F.col("record_id") == record_id).orderBy("created_at", "event_id")


def failures(results: DataFrame, record_id: str) -> DataFrame:
    """A record's failed judgements, errors first."""
    return results.where((F.col("record_id") == record_id) & (F.col("outcome") == "fail")).orderBy((F.col("severity") == "error").desc(), "rule_id")
