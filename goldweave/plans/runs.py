"""Commands: a file through all stages, or the stages one by one, on a store of tables.

Each stage is a function of tables; a command computes its changes and commits them together."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from decimal import Decimal
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import text
from ..operators import golden, mapping, merge, normalize, quarantine, resolve, validate
from ..operators.upsert import upsert
from ..schemas import KEYS, TABLES
from ..sources import files
from ..sources.store import Store
from ..scratch import written


class AlreadyIngested(RuntimeError):
    pass


@dataclass
class RunResult:
    batch_id: str
    rows: int
    failed: int


def _id(*parts: object) -> str:
    return sha256("\x1f".join(map(str, parts)).encode()).hexdigest()[:32]


def _ts(at: datetime) -> Column:
    return F.lit(at)


def _row(store: Store, name: str, **values: object) -> DataFrame:
    schema = store.spark.createDataFrame([], TABLES[name]).schema
    return store.spark.createDataFrame([tuple(values.get(f.name) for f in schema)], schema)


def ingest(store: Store, path: str, entity_type: str, source_name: str, source_type: str = "csv", reliability: str = "0.50", describes: str | None = None, record_id_column: str | None = None, allow_reingest: bool = False, sheet: str | None = None, at: datetime | None = None) -> RunResult:
    """Store every row of a file as it is. Rows that cannot be stored exactly go to record_error with their bytes.

    A file that its source has completed is refused. A source's reliability is that of its first load; describes
    (organisation, location) changes when given. A failure marks the batch failed and raises."""
    at = at or datetime.now(timezone.utc)
    spark = store.spark
    digest, size = files.file_facts(spark, path)
    source_id = _id("source", source_name)
    old = store.table("source").where(F.col("source_id") == source_id).first()
    seen = store.table("batch").where((F.col("source_id") == source_id) & (F.col("file_hash") == digest))
    if not allow_reingest and (done := seen.where("status IN ('completed', 'running')").orderBy(F.desc("started_at")).first()):
        raise AlreadyIngested(f"{path} is {done['status']} as batch {done['batch_id']}")
    batch_id = _id("batch", source_id, digest, seen.count())
    seq = (store.table("batch").agg(F.max("seq")).first()[0] or 0) + 1
    source = _row(store, "source", source_id=source_id, source_name=source_name, source_type=old["source_type"] if old else source_type, reliability=old["reliability"] if old else Decimal(reliability), describes=describes or (old["describes"] if old else "organisation"), created_at=old["created_at"] if old else at, updated_at=at)
    facts = dict(batch_id=batch_id, source_id=source_id, entity_type=entity_type, file_path=path, file_name=path.rsplit("/", 1)[-1], file_hash=digest, file_size_bytes=size, started_at=at, seq=seq)
    store.commit({"source": store.merged("source", source), "batch": store.merged("batch", _row(store, "batch", status="running", **facts))})
    try:
        columns, rows = files.read_file(spark, path, sheet)
        if record_id_column and record_id_column not in columns:
            raise KeyError(f"no column {record_id_column}")
        natural = F.coalesce(F.nullif(text.strip(F.col("raw_payload")[record_id_column]), F.lit("")), F.col("row_number").cast("string")) if record_id_column else F.col("row_number").cast("string")
        full = rows.select(
            text.stable_id("record", F.lit(batch_id), F.col("row_number")).alias("record_id"), F.lit(batch_id).alias("batch_id"), F.lit(source_id).alias("source_id"), F.lit(entity_type).alias("entity_type"),
            natural.alias("source_record_id"), "row_number", "raw_payload", _ts(at).cast("timestamp").alias("ingested_at"), text.unstorable(F.col("raw_payload")).alias("bad"),
        )
        full = written(full)
        good = full.where("bad IS NULL").withColumn("payload_hash", text.payload_hash(F.col("raw_payload")))
        bad = full.where("bad IS NOT NULL").select(
            text.stable_id("error", F.col("batch_id"), F.col("row_number")).alias("error_id"), "batch_id", "source_id", "entity_type", "row_number", "source_record_id",
            text.sanitized(F.col("raw_payload")).alias("raw_payload"), F.to_json("raw_payload").cast("binary").alias("raw_payload_bytes"), F.lit("screening").alias("stage"), F.lit("UnstorableText").alias("error_type"),
            F.left(F.concat(F.lit("unstorable text in column "), "bad"), F.lit(4000)).alias("error_message"), F.lit("open").alias("status"), F.col("ingested_at").alias("occurred_at"),
        )
        n, failed = full.agg(F.count("*"), F.count("bad")).first()
        if not columns:
            raise ValueError("the file is empty")
        done = _row(store, "batch", status="completed", columns=columns, rows_read=n, rows_ingested=n - failed, rows_skipped=failed, finished_at=at, **facts)
        store.commit({"batch": store.merged("batch", done)}, {"raw_record": good, "record_error": bad}, batch_id)
    except Exception as e:
        store.commit({"batch": store.merged("batch", _row(store, "batch", status="failed", error_message=str(e)[:2000], finished_at=at, **facts))})
        raise
    return RunResult(batch_id, n - failed, failed)


def _batch(store: Store, batch_id: str):
    row = store.table("batch").where(F.col("batch_id") == batch_id).first()
    if row is None:
        raise KeyError(batch_id)
    if row["status"] != "completed":
        raise ValueError(f"batch {batch_id} is {row['status']}")
    return row


def map_batch(store: Store, batch_id: str, at: datetime) -> str:
    """Map the columns of a batch's layout; a known layout of the source keeps its mappings and human decisions."""
    b = _batch(store, batch_id)
    schema_id = _id("schema", b["source_id"], vocab.column_fingerprint(b["columns"]), vocab.SCHEMA_VERSION)
    changes = {"batch": store.merged("batch", store.table("batch").where(F.col("batch_id") == batch_id).withColumn("source_schema_id", F.lit(schema_id)))}
    if store.table("source_schema").where(F.col("source_schema_id") == schema_id).isEmpty():
        raw = store.batch("raw_record", batch_id)
        found = mapping.map_columns(b["columns"], b["entity_type"], mapping.shape_ratios(raw, b["columns"]))
        row = _row(store, "source_schema", source_schema_id=schema_id, source_id=b["source_id"], first_seen_batch_id=batch_id, entity_type=b["entity_type"], column_fingerprint=vocab.column_fingerprint(b["columns"]), columns=b["columns"], schema_version=vocab.SCHEMA_VERSION, created_at=at)
        changes |= {"source_schema": store.merged("source_schema", row, "ignore"), "column_mapping": store.merged("column_mapping", mapping.mapping_rows(store.spark, schema_id, found).withColumn("created_at", _ts(at)), "ignore")}
    store.commit(changes)
    return schema_id


def _mappings(store: Store) -> DataFrame:
    batches = store.table("batch").select("batch_id", "source_schema_id")
    return batches.join(store.table("column_mapping"), "source_schema_id").select("batch_id", "source_column", "canonical_field", "mapping_status", "subject")


def normalize_batch(store: Store, batch_id: str) -> None:
    """Observations of a batch. A rerun refreshes what derives from mappings; raw values and times are the same."""
    _batch(store, batch_id)
    obs = normalize.observations(store.batch("raw_record", batch_id), _mappings(store).where(F.col("batch_id") == batch_id))
    store.commit(batch={"attribute_observation": obs}, batch_id=batch_id)


def validate_batch(store: Store, batch_id: str, at: datetime) -> None:
    """Judgements, verdicts and quarantine of a batch, in one commit."""
    _batch(store, batch_id)
    obs = store.batch("attribute_observation", batch_id)
    if obs.isEmpty():
        raise ValueError(f"batch {batch_id} has no observations")
    results, verdicts = validate.validate(obs, at.year)
    verdicts = written(verdicts)
    moves = written(quarantine.route(verdicts, store.table("quarantine_item"), _ts(at)))
    store.commit(
        {"quarantine_item": store.merged("quarantine_item", quarantine.items_from(moves))},
        {"validation_result": results, "record_validation": verdicts}, batch_id,
        {"quarantine_event": quarantine.events_from(moves)},
    )


def gate(store: Store, batch_id: str | None = None) -> DataFrame:
    """Records that may be resolved, of one batch or all."""
    of = store.table if batch_id is None else lambda name: store.batch(name, batch_id)
    return quarantine.resolvable(of("raw_record"), of("record_validation"), store.table("quarantine_item"))


def accepted_observations(store: Store, batch_id: str | None = None) -> DataFrame:
    return normalize.confirmed(store.table("attribute_observation") if batch_id is None else store.batch("attribute_observation", batch_id))


def resolve_batch(store: Store, batch_id: str, at: datetime) -> None:
    """Link the batch's records that passed the gate and are not linked yet, people's employers too."""
    _batch(store, batch_id)
    done = store.table("record_entity_link").where("role = 'self'").select("record_id")
    todo = gate(store, batch_id).join(done, "record_id", "left_anti")
    order = todo.join(F.broadcast(store.table("batch").select("batch_id", F.col("seq").alias("batch_seq"))), "batch_id").select("record_id", (F.col("batch_seq") * F.lit(1 << 32) + F.col("row_number")).alias("seq"))
    obs = accepted_observations(store, batch_id)
    role_email = store.batch("validation_result", batch_id).where("rule_id = 'email.role_account' AND outcome = 'fail'").select("record_id").distinct()
    work = written(resolve.units(resolve.record_values(obs), order, store.table("source"), role_email))
    # records without any confirmed value become entities of their own, too
    bare = order.join(work.where("role = 'self'").select("record_id"), "record_id", "left_anti").join(store.batch("raw_record", batch_id).select("record_id", "entity_type", "batch_id", "source_id"), "record_id")
    work = written(work.unionByName(bare.select("record_id", F.lit("self").alias("role"), "entity_type", "batch_id", "source_id", (F.col("seq") * 2).alias("seq"), F.array().cast(f"array<{resolve.KEY}>").alias("keys"), F.lit(None).cast("string").alias("employer"))))
    active = store.table("entity").where("status = 'active'").select("entity_id")
    stored = store.table("entity_identity_key").join(active, "entity_id", "left_semi").select("entity_id", "entity_type", "key_type", "key_value", "strength")
    out = resolve.resolve(work, stored)
    store.commit(batch_id=batch_id, added={
        "record_entity_link": out["links"].withColumn("linked_at", _ts(at)), "entity": out["entities"], "entity_identity_key": out["keys"],
        "match_candidate": out["candidates"].withColumn("created_at", _ts(at)), "entity_relationship": out["relationships"].withColumn("valid_from", _ts(at)),
    })


def build_golden(store: Store, entities: DataFrame | None, at: datetime) -> dict[str, int]:
    """Recompute golden values of the entities (entity_id; None: all active), keeping history. Counts by outcome."""
    live = store.table("entity").where("status = 'active'").select("entity_id")
    touched = live if entities is None else live.join(entities.select("entity_id").distinct(), "entity_id", "left_semi")
    touched = written(touched)
    links = store.table("record_entity_link").join(touched, "entity_id", "left_semi")
    new = golden.choices(golden.claims(accepted_observations(store), links, store.table("source")))
    table = store.table("golden_attribute")
    now = golden.current(table).join(touched, "entity_id", "left_semi")
    changed = written(golden.diff(new, now, _ts(at)))
    rest = table.join(changed.select("golden_id"), "golden_id", "left_anti")
    store.commit({"golden_attribute": rest.unionByName(changed.select(*rest.columns))})
    return {r["outcome"]: r["count"] for r in changed.groupBy("outcome").count().collect()}  # five outcomes


def golden_batch(store: Store, batch_id: str, at: datetime) -> dict[str, int]:
    _batch(store, batch_id)
    return build_golden(store, store.batch("record_entity_link", batch_id), at)


def run_file(store: Store, path: str, entity_type: str, source_name: str, at: datetime | None = None, with_golden: bool = True, **options: object) -> RunResult:
    """A file through all stages."""
    at = at or datetime.now(timezone.utc)
    result = ingest(store, path, entity_type, source_name, at=at, **options)
    map_batch(store, result.batch_id, at)
    normalize_batch(store, result.batch_id)
    validate_batch(store, result.batch_id, at)
    resolve_batch(store, result.batch_id, at)
    if with_golden:
        golden_batch(store, result.batch_id, at)
    return result


# --- human decisions and repairs ---


def review_mapping(store: Store, mapping_id: str, canonical_field: str | None, actor: str, at: datetime) -> None:
    row = store.table("column_mapping").join(store.table("source_schema").select("source_schema_id", "entity_type"), "source_schema_id").where(F.col("mapping_id") == mapping_id).first()
    if row is None:
        raise KeyError(mapping_id)
    store.commit({"column_mapping": mapping.reviewed(store.table("column_mapping"), mapping_id, row["entity_type"], canonical_field, actor, _ts(at))})


def review_quarantine(store: Store, record_id: str, verb: str, actor: str, note: str | None, at: datetime) -> None:
    item, event = quarantine.review(store.table("quarantine_item"), record_id, verb, actor, note, _ts(at))
    store.commit({"quarantine_item": store.merged("quarantine_item", item)}, added={"quarantine_event": event})


def accept_candidate(store: Store, candidate_id: str, actor: str, at: datetime) -> None:
    """Merge the record's own entity into the candidate; one that is merged already is only closed."""
    t = store.tables()
    plan = written(merge.candidate_merge(t["match_candidate"], t["record_entity_link"], t["entity"], candidate_id, actor))
    changes = {"match_candidate": merge.close_candidate(t["match_candidate"], candidate_id, "accepted", actor, None, _ts(at))}
    if not plan.isEmpty():
        out = merge.merge(t["record_entity_link"], t["entity_identity_key"], t["entity"], plan, _ts(at))
        changes |= {"record_entity_link": out["links"], "entity_identity_key": out["keys"], "entity": out["entities"], "entity_merge": store.merged("entity_merge", out["merges"], "ignore")}
    store.commit(changes)
    build_golden(store, None, at)


def reject_candidate(store: Store, candidate_id: str, actor: str, note: str | None, at: datetime) -> None:
    store.commit({"match_candidate": merge.close_candidate(store.table("match_candidate"), candidate_id, "rejected", actor, note, _ts(at))})


def merge_duplicates(store: Store, entity_type: str, confirm: bool, at: datetime) -> DataFrame:
    """Triage of entities that share a strong key and a name; with confirm, each group's entities go into its survivor."""
    t = store.tables()
    groups = written(merge.survivor_of(merge.duplicate_groups(t["entity_identity_key"], t["golden_attribute"], t["entity"], entity_type), t["record_entity_link"]))
    if confirm:
        each = groups.select(F.explode("entity_ids").alias("merged_id"), F.col("survivor").alias("surviving_id")).where("merged_id <> surviving_id").groupBy("merged_id").agg(F.min("surviving_id").alias("surviving_id"))
        # a survivor that is to be merged itself waits for the next triage
        plan = written(each.join(each.select(F.col("merged_id").alias("surviving_id")), "surviving_id", "left_anti").select("merged_id", "surviving_id", F.lit("triage").alias("actor"), F.lit("same strong key and name").alias("reason"), F.lit("0.900").cast("decimal(4,3)").alias("confidence")))
        out = merge.merge(t["record_entity_link"], t["entity_identity_key"], t["entity"], plan, _ts(at))
        store.commit({"record_entity_link": out["links"], "entity_identity_key": out["keys"], "entity": out["entities"], "entity_merge": store.merged("entity_merge", out["merges"], "ignore")})
        build_golden(store, None, at)
    return groups


def reprocess_errors(store: Store, batch_id: str, actor: str, at: datetime) -> int:
    """Open errors of a batch again, from their exact bytes; rows that can be stored now become records."""
    bad = store.batch("record_error", batch_id).where("status = 'open'")
    again = bad.withColumn("p", F.from_json(F.col("raw_payload_bytes").cast("string"), "map<string,string>")).where(text.unstorable(F.col("p")).isNull() & F.col("p").isNotNull())
    again = written(again)
    rows = again.select(text.stable_id("record", F.col("batch_id"), F.col("row_number")).alias("record_id"), "batch_id", "source_id", "entity_type", "source_record_id", "row_number", text.payload_hash(F.col("p")).alias("payload_hash"), F.col("p").alias("raw_payload"), _ts(at).alias("ingested_at"))
    n = again.count()
    closed = again.drop("p").withColumns({"status": F.lit("reprocessed"), "reviewed_by": F.lit(actor), "review_note": text.stable_id("record", F.col("batch_id"), F.col("row_number"))})
    one = store.table("batch").where(F.col("batch_id") == batch_id).withColumns({"rows_ingested": F.col("rows_ingested") + n, "rows_skipped": F.greatest(F.col("rows_skipped") - n, F.lit(0))})
    errors = upsert(store.batch("record_error", batch_id), store.full("record_error", closed), KEYS["record_error"])
    store.commit({"batch": store.merged("batch", one)}, {"record_error": errors}, batch_id, {"raw_record": rows})
    return n


def abandon(store: Store, batch_id: str, actor: str, reason: str, at: datetime) -> None:
    """Mark a batch that got stuck as failed."""
    one = store.table("batch").where((F.col("batch_id") == batch_id) & (F.col("status") == "running"))
    store.commit({"batch": store.merged("batch", one.withColumns({"status": F.lit("failed"), "error_message": F.lit(f"{actor}: {reason}"[:2000]), "finished_at": _ts(at)}))})


def purge_sources(store: Store, names: list[str]) -> None:
    store.commit(merge.purge(store.tables(), names))


def view_tables(store: Store) -> dict[str, DataFrame]:
    """All tables and the gate, for lineage, metrics and checks."""
    return store.tables() | {"resolvable_record": gate(store)}
