"""More named queries: gauges, record rules, timelines, integrity checks, person keys, quarantine lists, mapping coverage.

The driver's tables stand for the engine's own; each query runs the operator over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..operators import golden, lineage, listing, mapping, metrics, quarantine, resolve, validate
from .queries import _ITEM_SQL, _list, _t, query

# --- gauges ---


def _sql(spark, d: str, table: str, *columns: str, where: str = "true") -> DataFrame:
    return _t(spark, d, table).where(where).selectExpr(*columns)


_GAUGE_SQL = """
b AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END AS status, o_orderkey % 3 = 0 AS published FROM orders),
m AS (SELECT CASE p_size % 3 WHEN 0 THEN 'needs_review' WHEN 1 THEN 'auto_accepted' ELSE 'unmapped' END AS status, TIMESTAMP '2024-01-01' + to_hours(CAST(p_size AS INTEGER)) AS since FROM part),
r AS (SELECT CASE o_custkey % 3 WHEN 0 THEN 'valid' WHEN 1 THEN 'warning' ELSE 'invalid' END AS status FROM orders),
q AS (SELECT CASE o_orderkey % 2 WHEN 0 THEN 'open' ELSE 'released' END AS status, o_orderdate AS since FROM orders),
e AS (SELECT CASE s_nationkey % 2 WHEN 0 THEN 'person' ELSE 'company' END AS kind, CASE WHEN s_acctbal > 0 THEN 'active' ELSE 'merged' END AS status FROM supplier),
c AS (SELECT CASE c_custkey % 2 WHEN 0 THEN 'open' ELSE 'rejected' END AS status, TIMESTAMP '2024-02-01' + to_minutes(CAST(c_custkey AS INTEGER)) AS since FROM customer),
g AS (SELECT CASE p_size % 2 WHEN 0 THEN 'person' ELSE 'company' END AS kind, p_partkey % 7 <> 0 AS live, p_partkey % 4 AS competing, p_size % 100 / 100.0 AS confidence FROM part)"""


@query(f"""WITH {_GAUGE_SQL}
SELECT name, labels, round(CAST(value AS DOUBLE), 6) AS value FROM (
SELECT 'batches' AS name, 'status=' || status AS labels, count(*) AS value FROM b GROUP BY status
UNION ALL SELECT 'batches_unpublished', '', count(*) FILTER (status = 'completed' AND NOT published) FROM b
UNION ALL SELECT 'raw_records', '', count(*) FROM lineitem
UNION ALL SELECT 'mappings', 'mapping_status=' || status, count(*) FROM m GROUP BY status
UNION ALL SELECT 'oldest_unreviewed_mapping_seconds', '', coalesce(date_diff('second', min(since), TIMESTAMP '2024-06-01'), 0) FROM m WHERE status = 'needs_review'
UNION ALL SELECT 'observations', '', count(*) FROM lineitem
UNION ALL SELECT 'observations_uncanonical', '', count(*) FROM lineitem WHERE l_returnflag <> 'A'
UNION ALL SELECT 'records_by_verdict', 'status=' || status, count(*) FROM r GROUP BY status
UNION ALL SELECT 'failing_judgements', 'severity=' || l_returnflag, count(*) FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_returnflag
UNION ALL SELECT 'quarantine_items', 'status=' || status, count(*) FROM q GROUP BY status
UNION ALL SELECT 'oldest_open_quarantine_seconds', '', coalesce(date_diff('second', min(since), TIMESTAMP '2024-06-01'), 0) FROM q WHERE status = 'open'
UNION ALL SELECT 'entities', 'entity_type=' || kind || ',status=' || status, count(*) FROM e GROUP BY kind, status
UNION ALL SELECT 'match_candidates', 'status=' || status, count(*) FROM c GROUP BY status
UNION ALL SELECT 'oldest_open_candidate_seconds', '', coalesce(date_diff('second', min(since), TIMESTAMP '2024-06-01'), 0) FROM c WHERE status = 'open'
UNION ALL SELECT 'records_awaiting_resolution', '', count(*) FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 4)
UNION ALL SELECT 'golden_values', 'state=' || CASE WHEN live THEN 'current' ELSE 'superseded' END, count(*) FROM g GROUP BY live
UNION ALL SELECT 'golden_contested', '', count(*) FROM g WHERE live AND competing > 1
UNION ALL SELECT 'golden_mean_confidence', 'entity_type=' || kind, avg(confidence) FROM g WHERE live GROUP BY kind
UNION ALL SELECT 'golden_low_confidence', '', count(*) FROM g WHERE live AND confidence < 0.5)""")
def gauges(spark, d):
    """All gauges over the driver's tables."""
    return _readings(spark, d).select("name", F.array_join(F.transform(F.map_entries("labels"), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ",").alias("labels"), F.round("value", 6).alias("value"))


def _readings(spark, d: str) -> DataFrame:
    kind = "CASE WHEN {} % 2 = 0 THEN 'person' ELSE 'company' END AS entity_type"
    t = {
        "batch": _sql(spark, d, "orders", "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END AS status", "CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END AS events_published_at"),
        "raw_record": _sql(spark, d, "lineitem", "l_orderkey"),
        "column_mapping": _sql(spark, d, "part", "CASE p_size % 3 WHEN 0 THEN 'needs_review' WHEN 1 THEN 'auto_accepted' ELSE 'unmapped' END AS mapping_status", "TIMESTAMP '2024-01-01' + make_interval(0, 0, 0, 0, p_size) AS created_at"),
        "attribute_observation": _sql(spark, d, "lineitem", "CASE WHEN l_returnflag = 'A' THEN 'email' END AS canonical_field"),
        "record_validation": _sql(spark, d, "orders", "CASE o_custkey % 3 WHEN 0 THEN 'valid' WHEN 1 THEN 'warning' ELSE 'invalid' END AS status"),
        "validation_result": _sql(spark, d, "lineitem", "CASE WHEN l_linestatus = 'F' THEN 'fail' ELSE 'pass' END AS outcome", "l_returnflag AS severity"),
        "quarantine_item": _sql(spark, d, "orders", "CASE WHEN o_orderkey % 2 = 0 THEN 'open' ELSE 'released' END AS status", "o_orderdate AS quarantined_at"),
        "entity": _sql(spark, d, "supplier", kind.format("s_nationkey"), "CASE WHEN s_acctbal > 0 THEN 'active' ELSE 'merged' END AS status"),
        "match_candidate": _sql(spark, d, "customer", "CASE WHEN c_custkey % 2 = 0 THEN 'open' ELSE 'rejected' END AS status", "TIMESTAMP '2024-02-01' + make_interval(0, 0, 0, 0, 0, c_custkey) AS created_at"),
        "resolvable_record": _sql(spark, d, "orders", "o_orderkey AS record_id"),
        "record_entity_link": _sql(spark, d, "lineitem", "l_orderkey AS record_id", "'self' AS role", where="l_linenumber = 4"),
        "golden_attribute": _sql(spark, d, "part", kind.format("p_size"), "CASE WHEN p_partkey % 7 = 0 THEN current_timestamp() END AS valid_to", "p_partkey % 4 AS competing_values", "CAST(p_size % 100 / 100 AS DECIMAL(4,3)) AS confidence"),
    }
    return metrics.gauges(t, F.lit("2024-06-01").cast("timestamp"))


@query("""WITH n AS (SELECT count(*) FILTER (l_returnflag <> 'A') * 1.0 / count(*) AS bare FROM lineitem),
a AS (SELECT 'unpublished_batches' AS alert, 'warning' AS severity, CAST(count(*) AS DOUBLE) AS value FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 <> 0
UNION ALL SELECT 'awaiting_resolution', 'info', CAST(count(*) AS DOUBLE) FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 4)
UNION ALL SELECT 'quarantine_not_reviewed', 'warning', CASE WHEN v > 604800 THEN v ELSE 0 END FROM (SELECT CAST(coalesce(date_diff('second', min(o_orderdate), TIMESTAMP '2024-06-01'), 0) AS DOUBLE) AS v FROM orders WHERE o_orderkey % 2 = 0)
UNION ALL SELECT 'mapping_not_reviewed', 'warning', CASE WHEN v > 604800 THEN v ELSE 0 END FROM (SELECT CAST(coalesce(date_diff('second', min(TIMESTAMP '2024-01-01' + to_hours(CAST(p_size AS INTEGER))), TIMESTAMP '2024-06-01'), 0) AS DOUBLE) AS v FROM part WHERE p_size % 3 = 0)
UNION ALL SELECT 'candidate_not_reviewed', 'warning', CASE WHEN v > 1209600 THEN v ELSE 0 END FROM (SELECT CAST(coalesce(date_diff('second', min(TIMESTAMP '2024-02-01' + to_minutes(CAST(c_custkey AS INTEGER))), TIMESTAMP '2024-06-01'), 0) AS DOUBLE) AS v FROM customer WHERE c_custkey % 2 = 0)
UNION ALL SELECT 'mostly_uncanonical', 'info', CASE WHEN bare > 0.75 THEN bare ELSE 0 END FROM n)
SELECT severity, count(*) AS alerts FROM a WHERE value > 0 GROUP BY severity""")
def alert_summary(spark, d):
    """Alert conditions that hold on the gauges, by severity."""
    return metrics.alert_summary(metrics.alerts(_readings(spark, d))).select("severity", F.col("count").alias("alerts"))


# --- record rules ---

#: Field to the condition under which an order, as a record, has a value for it.
_PRESENT = {"full_name": "k % 5 = 0", "first_name": "k % 2 = 0", "last_name": "k % 3 = 0", "email": "k % 7 < 2", "phone": "k % 4 = 1", "company_name": "k % 6 < 3", "job_title": "k % 3 = 1", "website": "k % 8 < 2", "city": "k % 2 = 1", "country": "k % 9 < 6"}


def _missing(table: dict[str, tuple[str, ...]]) -> str:
    arm = lambda fields: " OR ".join(f"NOT ({_PRESENT.get(f, 'false')})" for f in fields)
    return f"CASE WHEN e = 'person' THEN {arm(table['person'])} ELSE {arm(table['company'])} END"


_named = lambda kind: "(" + " OR ".join(f"({_PRESENT.get(f, 'false')})" for f in vocab.IDENTIFYING[kind]) + ")"
_parts = " AND ".join(f"({_PRESENT[f]})" for f in vocab.NAME_PARTS)
_RECORD_RULES = {
    "record.all_values_missing": ("error", " OR ".join(f"({x})" for x in _PRESENT.values()) + " OR notes > 0"),
    "record.has_identifier": ("error", f"CASE WHEN e = 'person' THEN {_named('person')} OR ({_parts}) ELSE {_named('company')} END"),
    "record.core_fields": ("warning", f"NOT ({_missing(vocab.CORE)})"),
    "record.expected_fields": ("info", f"NOT ({_missing(vocab.EXPECTED)})"),
    "record.mapping_coverage": ("warning", f"{len(_PRESENT)} >= {vocab.MIN_COVERAGE} * ({len(_PRESENT)} + notes)"),
}


@query(" UNION ALL ".join(f"SELECT k AS o_orderkey, '{rule}' AS rule_id, '{severity}' AS severity, CASE WHEN {ok} THEN 'pass' ELSE 'fail' END AS outcome FROM (SELECT o_orderkey AS k, CASE WHEN o_custkey % 2 = 0 THEN 'person' ELSE 'company' END AS e, CASE WHEN o_orderkey % 3 = 0 THEN 40 ELSE 0 END AS notes FROM orders)" for rule, (severity, ok) in _RECORD_RULES.items()))
def record_rules(spark, d):
    """The five record rules: orders as records with ten fields, a third of them with forty unmapped notes."""
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_custkey") % 2 == 0, "person").otherwise("company").alias("entity_type"))
    cells = F.array(*[F.struct(F.lit(f).alias("canonical_field"), F.when(F.expr(c), F.lit("v")).alias("v")) for f, c in _PRESENT.items()])
    notes = F.when(F.col("k") % 3 == 0, F.array_repeat(F.struct(F.lit(None).cast("string").alias("canonical_field"), F.lit("x").alias("v")), 40)).otherwise(F.array().cast("array<struct<canonical_field:string,v:string>>"))
    obs = o.select("k", "entity_type", F.explode(F.concat(cells, notes)).alias("c")).select(
        F.col("k").cast("string").alias("record_id"), F.lit("b").alias("batch_id"), F.lit("s").alias("source_id"), "entity_type", "c.canonical_field", F.col("c.v").alias("normalized_value")
    )
    return validate.record_results(validate.record_facts(obs)).select(F.col("record_id").cast("long").alias("o_orderkey"), "rule_id", "severity", "outcome")


@query("""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'value.normalization_failed' ELSE 'value.empty_after_normalization' END AS rule_id, 'error' AS severity, 'fail' AS outcome FROM events WHERE event_id % 4 < 2""")
def rules_normalization_outcome(spark, d):
    """Values that a normalizer refused or consumed; others without a value are not judged."""
    k = F.col("event_id")
    method = F.when(k % 4 == 0, "phone:failed").when(k % 4 == 1, "phone:empty").when(k % 4 == 2, "phone:null_token").otherwise("phone:absent")
    obs = _t(spark, d, "events").select(k.cast("string").alias("observation_id"), k.cast("string").alias("record_id"), F.lit("b").alias("batch_id"), F.lit("s").alias("source_id"), F.lit("person").alias("entity_type"), F.lit("phone").alias("canonical_field"), F.lit("abc").alias("raw_value"), F.lit(None).cast("string").alias("normalized_value"), F.lit("phone").alias("value_type"), method.alias("normalization_method"))
    return validate.attribute_results(obs, 2024).select(F.col("observation_id").cast("long").alias("event_id"), "rule_id", "severity", "outcome")


# --- lineage ---


@query("""SELECT o_orderdate AS at, 'record_ingested' AS event, 'row ' || o_custkey || ' of f' || o_orderkey % 3 AS detail FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderdate, 'record_linked', CASE WHEN o_orderkey % 10 <> 0 THEN 'phone ' || o_orderkey END FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderdate, 'record_quarantined', 'opened: a, ' || o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 = 0
UNION ALL SELECT TIMESTAMP '2024-01-01', 'entity_merged', s_suppkey || ' into main' FROM supplier
UNION ALL SELECT TIMESTAMP '2024-01-01', 'golden_value_set', 'name = ' || p_name FROM part
UNION ALL SELECT TIMESTAMP '2024-02-01', 'golden_value_superseded', 'name was ' || p_name FROM part WHERE p_size > 25""")
def timeline(spark, d):
    """The six arms of an entity's history: orders as its records, suppliers merged into it, parts as its values. A
    merged id leads to the survivor; a detail with a null part is null."""
    o = _t(spark, d, "orders")
    at = F.col("o_orderdate").cast("timestamp")
    linked = F.when(F.col("o_orderkey") % 2 == 0, "main").otherwise("other")
    day = lambda x: F.lit(x).cast("timestamp")
    t = {
        "entity": spark.createDataFrame([("main", None), ("old", "main")], "entity_id string, merged_into_entity_id string"),
        "record_entity_link": o.select(F.col("o_orderkey").alias("record_id"), linked.alias("entity_id"), at.alias("linked_at"), F.lit("phone").alias("match_method"), F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderkey")).alias("match_confidence")),
        "raw_record": o.select(F.col("o_orderkey").alias("record_id"), (F.col("o_orderkey") % 3).alias("batch_id"), at.alias("ingested_at"), F.col("o_custkey").alias("row_number")),
        "batch": spark.createDataFrame([(i, f"f{i}") for i in range(3)], "batch_id int, file_name string"),
        "quarantine_event": o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("record_id"), at.alias("created_at"), F.lit("opened").alias("action"), F.array(F.lit("a"), F.col("o_orderstatus")).alias("reason_codes")),
        "entity_merge": _t(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("merged_entity_id"), F.lit("main").alias("surviving_entity_id"), day("2024-01-01").alias("created_at")),
        "golden_attribute": _t(spark, d, "part").select(F.lit("main").alias("entity_id"), F.lit("name").alias("canonical_field"), F.col("p_name").alias("value"), day("2024-01-01").alias("valid_from"), F.when(F.col("p_size") > 25, day("2024-02-01")).alias("valid_to")),
    }
    return lineage.timeline(t, "old").select(F.col("at").cast("timestamp_ntz").alias("at"), "event", "detail")


_CHECK_SQL = f"""
l AS (SELECT l_orderkey * 10 + l_linenumber AS record_id, l_orderkey AS batch_id, l_linenumber AS n, l_suppkey AS entity_id, CASE WHEN l_partkey % 2 = 0 THEN 'person' ELSE 'company' END AS kind, CASE WHEN l_suppkey % 2 = 0 THEN 'person' ELSE 'company' END AS said_kind, CASE WHEN l_linenumber = 1 THEN 'employer' ELSE 'self' END AS role, l_returnflag AS flag, l_quantity > 25 AS live FROM lineitem),
b AS (SELECT o_orderkey AS batch_id, o_orderstatus = 'F' AS done, o_orderkey % 4 + 1 AS claimed FROM orders),
e AS (SELECT s_suppkey AS entity_id, CASE WHEN s_nationkey % 2 = 0 THEN 'person' ELSE 'company' END AS kind, s_acctbal < 0 AS merged, CASE WHEN s_suppkey % 3 = 0 THEN 1 END AS into_id FROM supplier),
q AS (SELECT o_orderkey * 10 + 1 AS record_id, {_ITEM_SQL} AS status FROM orders),
o AS (SELECT * FROM l WHERE n <> 3), k AS (SELECT * FROM l WHERE n < 5), g AS (SELECT * FROM l WHERE n <= 2 AND live),
r AS (SELECT o_orderkey AS id, o_custkey % 10 + 1 AS a, o_orderkey % 10 + 1 AS z FROM orders WHERE o_orderkey % 2 = 0)"""


@query(f"""WITH {_CHECK_SQL}
SELECT 'batch_row_counts' AS name, count(*) AS rows FROM b LEFT JOIN (SELECT batch_id, count(*) AS n FROM l GROUP BY 1) a USING (batch_id) WHERE done AND coalesce(n, 0) <> claimed
UNION ALL SELECT 'records_without_observations', count(*) FROM l WHERE n = 3
UNION ALL SELECT 'resolvable_without_entity', count(*) FROM l JOIN b USING (batch_id) WHERE done AND NOT (n < 5 AND role = 'self')
UNION ALL SELECT 'quarantined_golden', count(*) FROM g WHERE record_id IN (SELECT record_id FROM q WHERE status IN ('open', 'rejected'))
UNION ALL SELECT 'several_current_values', count(*) FROM (SELECT entity_id FROM g GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'entities_without_records', count(*) FROM e WHERE NOT merged AND entity_id NOT IN (SELECT entity_id FROM k)
UNION ALL SELECT 'link_type_mismatch', count(*) FROM k JOIN e USING (entity_id) WHERE k.kind <> e.kind OR (role = 'employer' AND e.kind <> 'company')
UNION ALL SELECT 'employment_direction', count(*) FROM r JOIN e x ON x.entity_id = a JOIN e y ON y.entity_id = z WHERE x.kind <> 'person' OR y.kind <> 'company'
UNION ALL SELECT 'employer_on_company_record', count(*) FROM o WHERE said_kind = 'company' AND role = 'employer'
UNION ALL SELECT 'merged_without_survivor', count(*) FROM e WHERE merged AND into_id IS NULL
UNION ALL SELECT 'golden_from_other_role', count(DISTINCT g.record_id) FROM g JOIN k USING (record_id, entity_id) WHERE g.record_id NOT IN (SELECT record_id FROM o WHERE flag = 'A')
UNION ALL SELECT 'errors_without_payload', count(*) FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 = 0""")
def integrity_checks(spark, d):
    """Rows that each of the twelve checks finds wrong in tables made to have all of these faults."""
    record = "l_orderkey * 10 + l_linenumber AS record_id"
    role = "CASE WHEN l_linenumber = 1 THEN 'employer' ELSE 'self' END"
    own = f"CASE WHEN {{}} % 2 = 0 THEN 'person' ELSE 'company' END AS {{}}"  # noqa: F541
    raw = _sql(spark, d, "lineitem", record, "l_orderkey AS batch_id")
    t = {
        "raw_record": raw, "resolvable_record": raw,
        "batch": _sql(spark, d, "orders", "o_orderkey AS batch_id", "CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'running' END AS status", "o_orderkey % 4 + 1 AS rows_ingested"),
        "attribute_observation": _sql(spark, d, "lineitem", record, "uuid() AS observation_id", "CASE WHEN l_returnflag = 'A' THEN 'x' ELSE 'y' END AS canonical_field", f"{role} AS subject", own.format("l_suppkey", "entity_type"), where="l_linenumber <> 3"),
        "record_entity_link": _sql(spark, d, "lineitem", record, "l_orderkey * 10 + l_linenumber AS link_id", "l_suppkey AS entity_id", own.format("l_partkey", "entity_type"), f"{role} AS role", where="l_linenumber < 5"),
        "entity": _sql(spark, d, "supplier", "s_suppkey AS entity_id", own.format("s_nationkey", "entity_type"), "CASE WHEN s_acctbal < 0 THEN 'merged' ELSE 'active' END AS status", "CASE WHEN s_suppkey % 3 = 0 THEN 1 END AS merged_into_entity_id"),
        "golden_attribute": _sql(spark, d, "lineitem", "l_orderkey * 10 + l_linenumber AS golden_id", "l_orderkey * 10 + l_linenumber AS winning_record_id", "l_suppkey AS entity_id", "'x' AS canonical_field", "CASE WHEN l_quantity <= 25 THEN current_timestamp() END AS valid_to", where="l_linenumber <= 2"),
        "quarantine_item": _sql(spark, d, "orders", "o_orderkey * 10 + 1 AS record_id", f"{_ITEM_SQL} AS status"),
        "entity_relationship": _sql(spark, d, "orders", "o_orderkey AS relationship_id", "CASE WHEN o_orderkey % 2 = 0 THEN 'employed_at' ELSE 'owns' END AS relationship_type", "o_custkey % 10 + 1 AS from_entity_id", "o_orderkey % 10 + 1 AS to_entity_id"),
        "record_error": _sql(spark, d, "customer", "c_custkey AS error_id", "CASE WHEN c_custkey % 2 = 0 THEN 'open' ELSE 'closed' END AS status", "CASE WHEN c_custkey % 3 <> 0 THEN 'x' END AS raw_payload_bytes"),
    }
    out = None
    for name, found in metrics.checks(t).items():
        arm = found.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = arm if out is None else out.unionByName(arm)
    return out


@query("""WITH e AS (SELECT s_suppkey AS id, s_name AS name FROM supplier),
r AS (SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN 1 ELSE o_custkey % 10 END AS a, CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE o_orderkey % 10 END AS z FROM orders)
SELECT direction, CAST(x.id AS VARCHAR) AS entity_id, e.name AS display_name, count(*) AS n FROM (
SELECT 'outgoing' AS direction, z AS id FROM r WHERE a = 1 UNION ALL SELECT 'incoming', a FROM r WHERE z = 1) x LEFT JOIN e ON e.id = x.id GROUP BY ALL""")
def entity_relationships(spark, d):
    """Both directions of an entity's relationships, ends through tombstones: entity 0 was merged into 1."""
    ids = "CAST({} AS STRING) AS {}"
    t = {
        "entity": spark.createDataFrame([(str(i), "1" if i == 0 else None) for i in range(10)], "entity_id string, merged_into_entity_id string"),
        "entity_relationship": _sql(spark, d, "orders", ids.format("o_custkey % 10", "from_entity_id"), ids.format("o_orderkey % 10", "to_entity_id"), "'employed_at' AS relationship_type", "o_orderdate AS valid_from", "NULL AS valid_to"),
        "golden_attribute": _sql(spark, d, "supplier", ids.format("s_suppkey", "entity_id"), "'company_name' AS canonical_field", "s_name AS value", "CAST(NULL AS TIMESTAMP) AS valid_to"),
    }
    return lineage.relationships(t, "0").groupBy("direction", "entity_id", "display_name").agg(F.count("*").alias("n"))


# --- keys of people and of locations ---


@query("""WITH p AS (SELECT c_custkey AS k, 'N' || c_custkey % 20 AS first, 'M' || c_custkey % 7 AS last, c_custkey % 3 = 0 AS whole, c_custkey % 5 = 0 AS role, c_custkey % 4 = 0 AS employed FROM customer),
n AS (SELECT *, CASE WHEN whole THEN 'Full ' || k ELSE first || ' ' || last END AS name FROM p)
SELECT k AS c_custkey, 'self' AS role, 'external_id' AS key_type, 's:' || k AS key_value, 'strong' AS strength FROM n
UNION ALL SELECT k, 'self', 'email', 'e' || k || '@x.com', CASE WHEN role THEN 'moderate' ELSE 'strong' END FROM n
UNION ALL SELECT k, 'self', 'name_city', name || '|Rome', 'moderate' FROM n
UNION ALL SELECT k, 'self', 'name_company', name || '|Co' || k, 'moderate' FROM n WHERE employed
UNION ALL SELECT k, 'self', 'phone', '+' || k, 'moderate' FROM n
UNION ALL SELECT k, 'employer', 'website_domain', 'co' || k || '.com', 'strong' FROM n WHERE employed
UNION ALL SELECT k, 'employer', 'name', 'Co' || k, 'moderate' FROM n WHERE employed""")
def person_identity_keys(spark, d):
    """Keys of people and of the employers that their rows name; a phone written twice is one key."""
    c = _t(spark, d, "customer")
    k = F.col("c_custkey").cast("string")
    one = lambda x: F.array(x)
    whole = F.col("c_custkey") % 3 == 0
    person = F.create_map(
        F.lit("person_external_id"), one(k), F.lit("email"), one(F.concat(F.lit("e"), k, F.lit("@x.com"))), F.lit("city"), one(F.lit("Rome")), F.lit("phone"), F.array(F.concat(F.lit("+"), k), F.concat(F.lit("+"), k)),
        F.lit("first_name"), one(F.concat(F.lit("N"), (F.col("c_custkey") % 20).cast("string"))), F.lit("last_name"), one(F.concat(F.lit("M"), (F.col("c_custkey") % 7).cast("string"))), F.lit("full_name"), one(F.when(whole, F.concat(F.lit("Full "), k)).otherwise("")),
    )
    employer = F.create_map(F.lit("company_name"), one(F.concat(F.lit("Co"), k)), F.lit("website"), one(F.concat(F.lit("https://www.co"), k, F.lit(".com/jobs"))))
    ident = F.lpad(k, 9, "0").alias("record_id")
    row = lambda df, subject, values: df.select(ident, F.lit("b").alias("batch_id"), F.lit("s").alias("source_id"), F.lit("person").alias("entity_type"), F.lit(subject).alias("subject"), values.alias("values"))
    values = row(c, "self", person).unionByName(row(c.where("c_custkey % 4 = 0"), "employer", employer))
    source = spark.createDataFrame([("s", "organisation")], "source_id string, describes string")
    units = resolve.units(values, c.select(ident, F.col("c_custkey").alias("seq")), source, c.where("c_custkey % 5 = 0").select(ident))
    return units.select(F.col("record_id").cast("long").alias("c_custkey"), "role", F.explode("keys").alias("k")).select("c_custkey", "role", "k.*")


@query("""SELECT s_suppkey, 'website_domain' AS key_type, 's' || s_suppkey || '.org' AS key_value, CASE WHEN s_suppkey % 2 = 0 THEN 'moderate' ELSE 'strong' END AS strength FROM supplier
UNION ALL SELECT s_suppkey, 'email', 'a@s' || s_suppkey || '.org', CASE WHEN s_suppkey % 2 = 0 THEN 'moderate' ELSE 'strong' END FROM supplier
UNION ALL SELECT s_suppkey, 'name', s_name, 'moderate' FROM supplier""")
def location_identity_keys(spark, d):
    """Keys of companies; what locations share is only moderate where the source describes locations."""
    s = _t(spark, d, "supplier")
    k = F.col("s_suppkey").cast("string")
    values = F.create_map(F.lit("website"), F.array(F.concat(F.lit("http://s"), k, F.lit(".org"))), F.lit("email"), F.array(F.concat(F.lit("a@s"), k, F.lit(".org"))), F.lit("company_name"), F.array(F.lit(""), F.col("s_name")))
    ident = F.lpad(k, 9, "0").alias("record_id")
    rows = s.select(ident, F.lit("b").alias("batch_id"), F.when(F.col("s_suppkey") % 2 == 0, "place").otherwise("org").alias("source_id"), F.lit("company").alias("entity_type"), F.lit("self").alias("subject"), values.alias("values"))
    source = spark.createDataFrame([("place", "location"), ("org", "organisation")], "source_id string, describes string")
    units = resolve.units(rows, s.select(ident, F.col("s_suppkey").alias("seq")), source, spark.createDataFrame([], "record_id string"))
    return units.select(F.col("record_id").cast("long").alias("s_suppkey"), F.explode("keys").alias("k")).select("s_suppkey", "k.*")


# --- quarantine, mapping and error lists ---


@query("""SELECT o_orderkey AS record_id, o_custkey AS row_number, 'f' || o_orderkey % 3 AS file_name, CASE WHEN o_orderkey % 3 = 0 THEN 'n0' ELSE 'n1' END AS source_name FROM orders WHERE o_orderkey % 4 = 0 AND o_orderstatus = 'F' ORDER BY o_orderdate, o_custkey, o_orderkey LIMIT 40""")
def quarantine_list(spark, d):
    """A page of the open items of people, the oldest first, with file and source names."""
    o = _t(spark, d, "orders")
    items = o.selectExpr("o_orderkey AS record_id", "CASE WHEN o_orderkey % 4 = 0 THEN 'open' ELSE 'released' END AS status", "CASE WHEN o_orderstatus = 'F' THEN 'person' ELSE 'company' END AS entity_type", "o_orderdate AS quarantined_at", "o_orderkey % 3 AS batch_id", "CASE WHEN o_orderkey % 3 = 0 THEN 's0' ELSE 's1' END AS source_id")
    raw = o.selectExpr("o_orderkey AS record_id", "o_custkey AS row_number", "'' AS source_record_id")
    batch = spark.createDataFrame([(i, f"f{i}") for i in range(3)], "batch_id int, file_name string")
    source = spark.createDataFrame([("s0", "n0"), ("s1", "n1")], "source_id string, source_name string")
    return quarantine.listed(items, raw, batch, source, entity_type="person", limit=40).select("record_id", "row_number", "file_name", "source_name")


@query("""SELECT l_orderkey * 10 + l_linenumber AS event_id, l_shipdate AS created_at, row_number() OVER (ORDER BY l_shipdate, l_orderkey * 10 + l_linenumber) AS no FROM lineitem WHERE l_quantity > 25""")
def quarantine_history(spark, d):
    """What happened to one record, in order: line items as its events."""
    events = _t(spark, d, "lineitem").selectExpr("CASE WHEN l_quantity > 25 THEN 'r' ELSE 'other' END AS record_id", "l_orderkey * 10 + l_linenumber AS event_id", "l_shipdate AS created_at")
    from pyspark.sql import Window

    ordered = quarantine.history(events, "r").withColumn("at", F.monotonically_increasing_id())
    return ordered.select("event_id", "created_at", F.row_number().over(Window.orderBy("at")).cast("long").alias("no"))


@query("""SELECT rule_id, severity, row_number() OVER (ORDER BY severity <> 'error', rule_id) AS no FROM (SELECT DISTINCT p_type || ' ' || p_brand AS rule_id, CASE WHEN p_type LIKE 'S%' THEN 'error' ELSE 'warning' END AS severity FROM part WHERE p_size > 10)""")
def record_failures(spark, d):
    """The failed judgements of one record, errors first: part types as rules."""
    from pyspark.sql import Window

    results = _t(spark, d, "part").selectExpr("'r' AS record_id", "concat(p_type, ' ', p_brand) AS rule_id", "CASE WHEN p_type LIKE 'S%' THEN 'error' ELSE 'warning' END AS severity", "CASE WHEN p_size > 10 THEN 'fail' ELSE 'pass' END AS outcome").distinct()
    ordered = quarantine.failures(results, "r").withColumn("at", F.monotonically_increasing_id())
    return ordered.select("rule_id", "severity", F.row_number().over(Window.orderBy("at")).cast("long").alias("no"))


@query("""SELECT s_name AS source_name, p_partkey AS source_column, CAST(p_size AS DOUBLE) AS mapping_confidence FROM part JOIN supplier ON s_suppkey = p_partkey % 5 + 1 WHERE p_size % 3 = 0""")
def mapping_review_list(spark, d):
    """Mappings that wait for review, with their source."""
    p = _t(spark, d, "part").selectExpr("p_partkey AS source_column", "p_partkey % 5 AS source_schema_id", "CASE WHEN p_size % 3 = 0 THEN 'needs_review' ELSE 'auto_accepted' END AS mapping_status", "CAST(p_size AS DOUBLE) AS mapping_confidence")
    schema = spark.createDataFrame([(i, i + 1, "company") for i in range(5)], "source_schema_id int, source_id int, entity_type string")
    source = _t(spark, d, "supplier").selectExpr("s_suppkey AS source_id", "s_name AS source_name")
    return listing.mappings(p, schema, source, status="needs_review").select("source_name", "source_column", "mapping_confidence")


@query("""SELECT c_custkey AS error_id, CAST(c_nationkey AS BIGINT) AS row_number FROM customer WHERE c_custkey % 2 = 0 ORDER BY c_acctbal DESC, c_nationkey, c_custkey LIMIT 30""")
def error_list(spark, d):
    """A page of the open errors, the newest first."""
    e = _t(spark, d, "customer").selectExpr("c_custkey AS error_id", "CASE WHEN c_custkey % 2 = 0 THEN 'open' ELSE 'closed' END AS status", "c_acctbal AS occurred_at", "CAST(c_nationkey AS BIGINT) AS row_number", "'b' AS batch_id")
    return listing.errors(e, "b", 30).select("error_id", "row_number")


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS entity_id, 'f' || l_partkey AS canonical_field, CAST(l_linenumber AS BIGINT) AS competing_values FROM lineitem WHERE l_linenumber > 1 ORDER BY l_linenumber DESC, l_quantity, entity_id, canonical_field LIMIT 50""")
def worked_disagreements(spark, d):
    """The report on values that sources disagree on most."""
    g = _t(spark, d, "lineitem").selectExpr("CAST(l_orderkey AS STRING) AS entity_id", "concat('f', l_partkey) AS canonical_field", "CAST(l_linenumber AS BIGINT) AS competing_values", "l_quantity AS confidence", "CAST(NULL AS TIMESTAMP) AS valid_to")
    return metrics.disagreements({"golden_attribute": golden.current(g)}).select("entity_id", "canonical_field", "competing_values")


_STATUS = ("auto_accepted", "needs_review", "unmapped")


@query(f"""SELECT CASE WHEN p_size % 3 = 0 THEN 'auto_accepted' WHEN p_size % 3 = 1 THEN 'needs_review' ELSE 'unmapped' END AS mapping_status, count(*) AS n FROM part WHERE 'unmapped' IN ({_list(_STATUS)}) GROUP BY 1""")
def mapping_status_counts(spark, d):
    """Mappings by status."""
    return mapping.mapping_counts(_t(spark, d, "part").selectExpr("CASE WHEN p_size % 3 = 0 THEN 'auto_accepted' WHEN p_size % 3 = 1 THEN 'needs_review' ELSE 'unmapped' END AS mapping_status")).select("mapping_status", F.col("count").alias("n"))
