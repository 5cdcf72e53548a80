"""Named queries over the driver's tables, one or more for each operator, with DuckDB SQL of the same result.

The driver's tables hold no vendor files, so each operator meets a deterministic projection of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import text
from ..operators import golden, graph, lineage, listing, mapping, merge, metrics, normalize, quarantine, resolve, upsert, validate

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark, d: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{d}/{name}.parquet")
    for c, kind in df.dtypes:
        if kind == "timestamp_ntz":
            df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df


def _list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# --- projections of the tables that stand for observations, statuses and claims ---


def _claims(spark, d: str) -> DataFrame:
    """Events as claims: a user's event type, from source k mod 5 with a reliability of its own."""
    k = F.get_json_object("props", "$.k").cast("int") % 5
    return _t(spark, d, "events").select(
        F.col("user_id").cast("string").alias("entity_id"), F.lit("person").alias("entity_type"), F.lit("email").alias("canonical_field"), F.col("event_type").alias("value"), F.col("event_type").alias("raw_value"),
        F.concat(F.lit("s"), k.cast("string")).alias("source_id"), F.concat(F.lit("vendor "), k.cast("string")).alias("source_name"), ((k + 4) / 10).cast("decimal(3,2)").alias("reliability"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("record_id"), F.col("ts").alias("observed_at"),
    )


_CLAIMS_SQL = """
c AS (
  SELECT CAST(user_id AS VARCHAR) AS entity_id, event_type AS value, CAST(json_extract(props, '$.k') AS INTEGER) % 5 AS k, lpad(CAST(event_id AS VARCHAR), 12, '0') AS record_id, ts FROM events
), v AS (
  SELECT entity_id, value, count(DISTINCT k) AS sources FROM c GROUP BY ALL
), n AS (
  SELECT entity_id, count(DISTINCT value) AS competing FROM c GROUP BY ALL
)"""


def _golden_sql(order: str, strategy: str) -> str:
    return f"""WITH {_CLAIMS_SQL}, r AS (
  SELECT c.*, v.sources, n.competing, row_number() OVER (PARTITION BY c.entity_id ORDER BY {order}) AS rn FROM c JOIN v USING (entity_id, value) JOIN n USING (entity_id)
), w AS (SELECT * FROM r WHERE rn = 1), dis AS (
  SELECT w.entity_id, count(DISTINCT c.k) FILTER (WHERE c.value <> w.value) AS dissenting FROM w JOIN c USING (entity_id) GROUP BY 1
)
SELECT entity_id, value, '{strategy}' AS strategy, CAST(greatest(5, least(99, (k + 4) * 10 + 15 * (sources - 1) - 10 * dissenting)) AS DOUBLE) / 100 AS confidence, record_id AS winning_record_id,
       CAST(sources AS INTEGER) AS supporting_sources, CAST(competing AS INTEGER) AS competing_values FROM w JOIN dis USING (entity_id)"""


def _chosen(spark, d: str, entity_type: str, field: str) -> DataFrame:
    claims = _claims(spark, d).withColumns({"entity_type": F.lit(entity_type), "canonical_field": F.lit(field)})
    return golden.choices(claims).select("entity_id", "value", "strategy", F.col("confidence").cast("double").alias("confidence"), "winning_record_id", "supporting_sources", "competing_values")


@query(_golden_sql("k DESC, ts DESC, value, record_id", "most_reliable_source"))
def golden_most_reliable(spark, d):
    return _chosen(spark, d, "person", "email")


@query(_golden_sql("ts DESC, k DESC, value, record_id", "most_recent"))
def golden_most_recent(spark, d):
    return _chosen(spark, d, "person", "job_title")


@query(_golden_sql("ts, k DESC, value, record_id", "earliest"))
def golden_earliest(spark, d):
    return _chosen(spark, d, "company", "founded_year")


@query(_golden_sql("sources DESC, k DESC, ts DESC, value, record_id", "most_frequent"))
def golden_most_frequent(spark, d):
    return _chosen(spark, d, "person", "full_name")


@query(f"""WITH {_CLAIMS_SQL}, p AS (SELECT entity_id, value, k, min(ts) AS first_at FROM c GROUP BY ALL)
SELECT entity_id, CAST(count(*) FILTER (WHERE value = 'click') AS BIGINT) AS click_sources, CAST(count(DISTINCT k) AS BIGINT) AS sources, max(value) FILTER (WHERE value <> 'click') AS last_other, CAST(count(DISTINCT value) AS BIGINT) AS distinct_values FROM p GROUP BY entity_id""")
def golden_support(spark, d):
    """Distinct sources by value and in all (partial sums by value and source first)."""
    per = _claims(spark, d).groupBy("entity_id", "value", "source_id").agg(F.min("observed_at").alias("first_at"))
    return per.groupBy("entity_id").agg(F.count_if(F.col("value") == "click").alias("click_sources"), F.countDistinct("source_id").alias("sources"), F.max(F.when(F.col("value") != "click", F.col("value"))).alias("last_other"), F.countDistinct("value").alias("distinct_values"))


@query("""WITH c AS (SELECT o_custkey, o_orderdate, max(o_orderstatus) AS s FROM orders GROUP BY ALL),
b AS (SELECT *, lag(s) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS p FROM c), s AS (SELECT * FROM b WHERE p IS DISTINCT FROM s)
SELECT o_custkey, s AS o_orderstatus, o_orderdate AS valid_from, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to FROM s""")
def golden_history_scd2(spark, d):
    return golden.scd2(_t(spark, d, "orders"), "o_custkey", "o_orderdate", "o_orderstatus").select("o_custkey", "o_orderstatus", F.col("valid_from").cast("timestamp_ntz").alias("valid_from"), F.col("valid_to").cast("timestamp_ntz").alias("valid_to"))


def _golden_rows(spark, d: str) -> DataFrame:
    """Parts as current golden rows: three fields of a company for each part."""
    p = _t(spark, d, "part")
    arms = [p.select(F.col("p_partkey").cast("string").alias("entity_id"), F.lit(f).alias("canonical_field"), F.col(c).cast("string").alias("value"), (F.col("p_size") % 100 / 100).cast("decimal(4,3)").alias("confidence"), (F.col("p_partkey") % 4).cast("int").alias("competing_values"), F.when(F.col("p_partkey") % 7 == 0, F.lit("2024-01-01").cast("timestamp")).alias("valid_to")) for f, c in (("company_name", "p_name"), ("industry", "p_type"), ("legal_name", "p_brand"))]
    return arms[0].unionByName(arms[1]).unionByName(arms[2])


def _entities(spark, d: str) -> DataFrame:
    p = _t(spark, d, "part")
    return p.select(F.col("p_partkey").cast("string").alias("entity_id"), F.lit("company").alias("entity_type"), F.when(F.col("p_size") > 40, "merged").otherwise("active").alias("status"), F.when(F.col("p_size") > 40, "0").alias("merged_into_entity_id"))


@query("""SELECT CAST(p_partkey AS VARCHAR) AS company_id, p_name AS company_name, p_type AS industry, p_brand AS legal_name, CAST(NULL AS VARCHAR) AS website, CAST(3 AS BIGINT) AS golden_fields, CAST(p_size % 100 AS DOUBLE) / 100 AS mean_confidence
FROM part WHERE p_size <= 40 AND p_partkey % 7 <> 0""")
def golden_pivot(spark, d):
    return golden.pivot(_golden_rows(spark, d), _entities(spark, d), "company").select("company_id", "company_name", "industry", "legal_name", "website", "golden_fields", F.col("mean_confidence").cast("double").alias("mean_confidence"))


@query("""SELECT CAST(3 * count(*) FILTER (WHERE p_partkey % 7 <> 0) AS BIGINT) AS current, CAST(3 * count(*) FILTER (WHERE p_partkey % 7 = 0) AS BIGINT) AS superseded, count(*) FILTER (WHERE p_partkey % 7 <> 0) AS entities, CAST(3 * count(*) FILTER (WHERE p_partkey % 7 <> 0 AND p_partkey % 4 > 1) AS BIGINT) AS contested FROM part""")
def golden_counts(spark, d):
    return golden.golden_counts(_golden_rows(spark, d))


@query("""SELECT CAST(p_partkey AS VARCHAR) AS entity_id, 'company' AS entity_type FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 4 > 1 AND p_size <= 40""")
def golden_contested(spark, d):
    return golden.contested_entities(_golden_rows(spark, d), _entities(spark, d))


@query("""SELECT coalesce(a.entity_id, b.entity_id) AS entity_id, CASE WHEN a.entity_id IS NULL THEN 'retired' WHEN b.entity_id IS NULL THEN 'written' WHEN a.value = b.value AND a.n <> b.n THEN 'refreshed' WHEN a.value = b.value THEN 'unchanged' ELSE u.o END AS outcome
FROM (SELECT p_partkey AS entity_id, p_name AS value, p_size % 3 AS n FROM part WHERE p_size < 40) a FULL JOIN (SELECT p_partkey AS entity_id, CASE WHEN p_size % 2 = 0 THEN p_name ELSE 'old' END AS value, p_size % 2 AS n FROM part WHERE p_size > 10) b USING (entity_id)
CROSS JOIN (VALUES ('closed'), ('written')) u(o) WHERE u.o = 'written' OR (a.entity_id IS NOT NULL AND b.entity_id IS NOT NULL AND a.value <> b.value)""")
def golden_diff(spark, d):
    """Choices against current rows: what is written, refreshed, unchanged, closed or retired."""
    p = _t(spark, d, "part")
    row = lambda df, value, n: df.select(F.col("p_partkey").alias("entity_id"), F.lit("company_name").alias("canonical_field"), F.lit("company").alias("entity_type"), value.alias("value"), value.alias("raw_value"), F.lit("most_frequent").alias("strategy"), F.lit("0.5").cast("decimal(4,3)").alias("confidence"), F.lit("r").alias("winning_record_id"), F.lit("s").alias("winning_source_id"), n.alias("supporting_sources"), F.lit(1).alias("competing_values"), F.lit("{}").alias("evidence"))
    new = row(p.where("p_size < 40"), F.col("p_name"), F.col("p_size") % 3)
    old = row(p.where("p_size > 10"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise("old"), F.col("p_size") % 2).withColumns({"golden_id": F.col("entity_id").cast("string"), "valid_from": F.lit("2024-01-01").cast("timestamp"), "valid_to": F.lit(None).cast("timestamp"), "superseded_by": F.lit(None).cast("string")})
    return golden.diff(new, old, F.lit("2024-02-01").cast("timestamp")).select("entity_id", "outcome")


# --- ids, hashes, raw records ---


@query(r"""SELECT c_custkey, sha256('{"k":"key"}{"v":"' || c_custkey || '"},{"k":"name"}{"v":"' || c_name || '"},{"k":"segment"}' || CASE WHEN c_custkey % 3 = 0 THEN '{}' ELSE '{"v":"' || c_mktsegment || '"}' END) AS payload_hash,
substr(sha256('=record' || chr(31) || '=' || c_custkey || chr(31) || '=' || c_name), 1, 32) AS record_id FROM customer""")
def raw_record_hash(spark, d):
    payload = F.create_map(F.lit("name"), F.col("c_name"), F.lit("key"), F.col("c_custkey").cast("string"), F.lit("segment"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")))
    return _t(spark, d, "customer").select("c_custkey", text.payload_hash(payload).alias("payload_hash"), text.stable_id("record", F.col("c_custkey"), F.col("c_name")).alias("record_id"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'b' END AS bad_column FROM part")
def unstorable_screening(spark, d):
    value = F.when(F.col("p_partkey") % 5 == 0, F.concat("p_name", F.lit("\u0000"))).otherwise(F.col("p_name"))
    return _t(spark, d, "part").select("p_partkey", text.unstorable(F.create_map(F.lit("a"), F.col("p_brand"), F.lit("b"), value)).alias("bad_column"))


# --- normalization ---


def _customer_observations(spark, d: str) -> DataFrame:
    """Customers as raw records of four columns, through normalization."""
    key = F.col("c_custkey")
    phone = F.when(key % 4 == 0, F.concat(F.lit("+1 ("), key.cast("string"), F.lit(") 555-0100;"), key.cast("string"))).when(key % 4 == 1, "N/A")
    payload = F.create_map(F.lit("name"), F.concat(F.lit("  "), F.upper("c_name"), F.lit("  x ")), F.lit("phone"), phone, F.lit("note"), F.concat("c_mktsegment", F.lit("^^"), key.cast("string")))
    raw = _t(spark, d, "customer").select(F.concat(F.lit("r"), key.cast("string")).alias("record_id"), F.lit("b").alias("batch_id"), F.lit("s").alias("source_id"), F.lit("company").alias("entity_type"), payload.alias("raw_payload"), F.lit("2024-01-01").cast("timestamp").alias("ingested_at"))
    maps = spark.createDataFrame([("b", "name", "company_name", "auto_accepted", "self"), ("b", "phone", "phone", "needs_review", "self")], "batch_id string, source_column string, canonical_field string, mapping_status string, subject string")
    return normalize.observations(raw, maps)


_OBS_SQL = r"""
o AS (
  SELECT 'r' || c_custkey AS record_id, 'name' AS source_column, 'company_name' AS canonical_field, 0 AS value_index, trim('  ' || upper(c_name) || '  x ') AS raw_value, trim(regexp_replace(upper(c_name) || '  x', '\s+', ' ', 'g')) AS normalized_value, 'text' AS normalization_method, false AS is_null_token FROM customer
  UNION ALL SELECT 'r' || c_custkey, 'phone', 'phone', u.i, CASE WHEN u.i = 0 THEN '+1 (' || c_custkey || ') 555-0100' ELSE CAST(c_custkey AS VARCHAR) END, CASE WHEN u.i = 0 THEN '+1' || c_custkey || '5550100' ELSE CAST(c_custkey AS VARCHAR) END, 'phone', false FROM customer, (VALUES (0), (1)) u(i) WHERE c_custkey % 4 = 0
  UNION ALL SELECT 'r' || c_custkey, 'phone', 'phone', 0, 'N/A', NULL, 'phone:null_token', true FROM customer WHERE c_custkey % 4 = 1
  UNION ALL SELECT 'r' || c_custkey, 'phone', 'phone', 0, '', NULL, 'phone:absent', true FROM customer WHERE c_custkey % 4 > 1
  UNION ALL SELECT 'r' || c_custkey, 'note', NULL, u.i, CASE WHEN u.i = 0 THEN c_mktsegment ELSE CAST(c_custkey AS VARCHAR) END, CASE WHEN u.i = 0 THEN c_mktsegment ELSE CAST(c_custkey AS VARCHAR) END, 'text', false FROM customer, (VALUES (0), (1)) u(i)
)"""


@query(f"WITH {_OBS_SQL} SELECT * FROM o")
def unpivot_observations(spark, d):
    return _customer_observations(spark, d).select("record_id", "source_column", "canonical_field", "value_index", "raw_value", "normalized_value", "normalization_method", "is_null_token")


@query(f"WITH {_OBS_SQL} SELECT count(*) AS total, count(canonical_field) AS canonical, count(*) FILTER (WHERE canonical_field IS NULL) AS uncanonical, count(*) FILTER (WHERE is_null_token) AS null_tokens, count(*) FILTER (WHERE value_index > 0) AS extra_values FROM o")
def observation_counts(spark, d):
    return normalize.observation_counts(_customer_observations(spark, d))


@query(f"""WITH v AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN ' N/A ' WHEN 1 THEN 'Unknown' WHEN 2 THEN '--' WHEN 3 THEN '' WHEN 4 THEN 'na' ELSE event_type END AS v FROM events)
SELECT event_id, v AS value, lower(trim(v)) IN ({_list(vocab.NULL_TOKENS)}) AS is_null FROM v""")
def null_token_filter(spark, d):
    r = F.col("event_id") % 6
    value = F.when(r == 0, " N/A ").when(r == 1, "Unknown").when(r == 2, "--").when(r == 3, "").when(r == 4, "na").otherwise(F.col("event_type"))
    return _t(spark, d, "events").select("event_id", value.alias("value")).withColumn("is_null", text.is_null_token(F.col("value")))


@query("""WITH v AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'email' ELSE 'text' END AS t, p_name || ' ^^ ' || p_brand || '; ' || p_type || '|' AS c FROM part),
s AS (SELECT p_partkey, t, unnest(string_split_regex(c, CASE t WHEN 'email' THEN '\\^\\^|[;|]' ELSE '\\^\\^' END)) AS part, generate_subscripts(string_split_regex(c, CASE t WHEN 'email' THEN '\\^\\^|[;|]' ELSE '\\^\\^' END), 1) AS i FROM v)
SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY i) - 1 AS INTEGER) AS value_index, trim(part) AS value FROM s WHERE trim(part) <> ''""".replace("\\\\", "\\"))
def multi_value_split(spark, d):
    cell = F.concat("p_name", F.lit(" ^^ "), "p_brand", F.lit("; "), "p_type", F.lit("|"))
    kind = F.when(F.col("p_partkey") % 2 == 0, "email").otherwise("text")
    return _t(spark, d, "part").select("p_partkey", F.posexplode(text.split_values(cell, kind)).alias("value_index", "value"))


@query(r"""SELECT o_orderkey, '+' || o_custkey || o_orderkey AS phone, '+44' || o_orderkey AS signed_phone, o_orderkey || '1' AS late_plus, 'x.com?q=a' || o_orderkey || '/B' AS bare_url, lower(o_orderpriority) || '@x.com' AS email, CASE WHEN o_orderkey = 0 THEN '0' ELSE CAST(o_orderkey AS VARCHAR) END AS number, upper(o_orderpriority) AS postal, o_orderpriority AS identifier,
regexp_replace(o_orderpriority, '\s+', ' ', 'g') || ' a' AS address FROM orders""")
def normalize_values(spark, d):
    k = F.col("o_orderkey").cast("string")
    return _t(spark, d, "orders").select(
        "o_orderkey", text.phone(F.concat(F.lit(" +"), F.col("o_custkey").cast("string"), F.lit(" ("), k, F.lit(")"))).alias("phone"),
        text.phone(F.concat(F.lit("tel: (+44) "), k)).alias("signed_phone"), text.phone(F.concat(k, F.lit(" +1"))).alias("late_plus"), text.url(F.concat(F.lit(" X.COM?Q=A"), k, F.lit("/B//"))).alias("bare_url"), text.email(F.concat(F.lit(" "), "o_orderpriority", F.lit("@X.COM "))).alias("email"),
        text.integer(F.concat(F.lit("00"), k, F.lit(" items"))).alias("number"), text.postal_code(F.concat(F.lower("o_orderpriority"), F.lit(" "))).alias("postal"), text.strip(F.concat(F.lit("\t"), "o_orderpriority", F.lit("\n"))).alias("identifier"),
        text.collapse(F.concat("o_orderpriority", F.lit(" \t a "))).alias("address"),
    )


@query("""SELECT n_nationkey, 'Nation_' || n_nationkey || ' O''Brien' AS name, 'Jean-Luc McDonald' AS fixed_name, 'N' || n_nationkey AS region, CASE WHEN n_nationkey % 2 = 0 THEN 'CA' ELSE 'New York' END AS code FROM nation""")
def normalize_names(spark, d):
    code = F.when(F.col("n_nationkey") % 2 == 0, " ca").otherwise("NEW  york")
    return _t(spark, d, "nation").select(
        "n_nationkey", text.person_name(F.concat("n_name", F.lit("  o'brien"))).alias("name"), text.person_name(F.lit("JEAN-LUC mcdonald")).alias("fixed_name"),
        text.NORMALIZERS["text"](F.concat(F.lit(" N"), F.col("n_nationkey").cast("string"))).alias("region"),
        F.when(F.col("n_nationkey") % 2 == 0, text.region_code(code)).otherwise("New York").alias("code"),
    )


_DOMAIN_SQL = r"regexp_replace(lower(split_part(split_part(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '/', 1), ':', 1)), '^www[0-9]*\.', '')"


@query(rf"""SELECT page_id, regexp_replace(url, '/+$', '') AS url, CASE WHEN {_DOMAIN_SQL} LIKE '%.%' THEN {_DOMAIN_SQL} END AS domain, lower(regexp_replace(url, '[^a-zA-Z0-9]+', '', 'g')) AS folded FROM pages""")
def normalize_url(spark, d):
    shouted = F.concat(F.upper(F.regexp_extract("url", "^([^:]*://[^/]*)", 1)), F.regexp_replace("url", "^[^:]*://[^/]*", ""))
    return _t(spark, d, "pages").select("page_id", text.url(shouted).alias("url"), text.website_domain(F.col("url")).alias("domain"), text.folded_name(F.col("url")).alias("folded"))


@query("""SELECT page_id, 'in/' || lower(split_part(url, '/', 3)) AS handle, CAST(NULL AS VARCHAR) AS none FROM pages""")
def linkedin_handle(spark, d):
    host = F.split_part("url", F.lit("/"), F.lit(3))
    return _t(spark, d, "pages").select("page_id", text.linkedin_handle(F.concat(F.lit("HTTPS://www.LinkedIn.com/in/"), host, F.lit("/?utm=1"))).alias("handle"), text.linkedin_handle(F.col("url")).alias("none"))


@query(r"""WITH v AS (SELECT url AS x FROM pages UNION ALL SELECT CAST(o_orderkey AS VARCHAR) FROM orders UNION ALL SELECT strftime(o_orderdate, '%Y') FROM orders UNION ALL SELECT CAST(10000 + c_custkey AS VARCHAR) FROM customer UNION ALL SELECT c_name || '@x.com' FROM customer UNION ALL SELECT '+1 555 ' || (1000 + c_custkey) FROM customer)
SELECT count(*) AS n, count(*) FILTER (regexp_matches(x, '^[^@\s]+@[^@\s]+\.[A-Za-z]{2,}$')) AS email, count(*) FILTER (regexp_matches(x, '(?i)^(https?://|www\.)\S+$|^[a-z0-9-]+(\.[a-z0-9-]+)+$')) AS url, count(*) FILTER (regexp_matches(x, '(?i)linkedin\.com/')) AS linkedin,
count(*) FILTER (regexp_matches(x, '^[0-9\s()+\-.]+$') AND length(regexp_replace(x, '[^0-9]', '', 'g')) BETWEEN 7 AND 15) AS phone, count(*) FILTER (regexp_matches(x, '^[0-9]{1,9}$')) AS integer, count(*) FILTER (regexp_matches(x, '^(1[89][0-9]{2}|20[0-9]{2}|21[0-9]{2})$')) AS year,
count(*) FILTER (regexp_matches(x, '^[0-9]{5}(-[0-9]{4})?$') OR regexp_matches(x, '^[0-9]{6}$') OR regexp_matches(x, '(?i)^[A-Z]{1,2}[0-9][A-Z0-9]?\s*[0-9][A-Z]{2}$') OR regexp_matches(x, '(?i)^[A-Z][0-9][A-Z]\s*[0-9][A-Z][0-9]$')) AS postal_code FROM v""")
def detector_ratios(spark, d):
    c, o = _t(spark, d, "customer"), _t(spark, d, "orders")
    arms = [_t(spark, d, "pages").select(F.col("url").alias("x")), o.select(F.col("o_orderkey").cast("string")), o.select(F.date_format("o_orderdate", "yyyy")), c.select((F.col("c_custkey") + 10000).cast("string")), c.select(F.concat("c_name", F.lit("@x.com"))), c.select(F.concat(F.lit("+1 555 "), (F.col("c_custkey") + 1000).cast("string")))]
    v = arms[0]
    for a in arms[1:]:
        v = v.union(a)
    return v.agg(F.count("*").alias("n"), *[F.count_if(f(F.col("x"))).alias(k) for k, f in text.DETECTORS.items()])


@query("""SELECT * FROM (VALUES ('c_name', 'full_name', 'similarity', 'needs_review'), ('e_mail', 'email', 'exact_alias', 'auto_accepted'), ('Mobile No', 'phone', 'exact_alias', 'auto_accepted'), ('location', 'city', 'ambiguous_alias', 'needs_review'), ('website', 'website', 'exact_alias', 'auto_accepted'), ('zzz', NULL, 'none', 'unmapped')) v(source_column, canonical_field, mapping_method, mapping_status) WHERE source_column <> 'c_name'""")
def map_columns(spark, d):
    """Columns of a person file, with customers' values as evidence."""
    cols = ["e_mail", "Mobile No", "location", "website", "zzz"]
    c = _t(spark, d, "customer")
    payload = F.create_map(F.lit("e_mail"), F.concat("c_name", F.lit("@x.com")), F.lit("Mobile No"), F.concat(F.lit("+1555"), (F.col("c_custkey") + 100000).cast("string")), F.lit("location"), F.lit("Paris"), F.lit("website"), F.concat(F.lit("x"), F.col("c_custkey").cast("string"), F.lit(".com")), F.lit("zzz"), F.col("c_mktsegment"))
    raw = c.select((F.col("c_custkey") + 1).alias("row_number"), payload.alias("raw_payload"))
    found = mapping.map_columns(cols, "person", mapping.shape_ratios(raw, cols))
    return mapping.mapping_rows(spark, "s", found).select("source_column", "canonical_field", "mapping_method", "mapping_status")


@query("""WITH p AS (SELECT l_orderkey, list_sort(list(l_partkey % 3)) AS a FROM lineitem GROUP BY 1) SELECT l_orderkey, a = list_reverse_sort(a) AS one_part, len(a) AS n FROM p""")
def set_equality_arrays(spark, d):
    p = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_partkey") % 3).alias("a"))  # an order's own lines
    return p.select("l_orderkey", mapping.same_columns(F.col("a"), F.transform("a", lambda x: F.element_at("a", 1))).alias("one_part"), F.size("a").cast("long").alias("n"))


# --- validation ---

_RULE_VALUES = {
    "email": "CASE o_orderkey % 5 WHEN 0 THEN 'info@gmail.com' WHEN 1 THEN 'bad address' WHEN 2 THEN 'a.b@' || o_custkey || '.org' WHEN 3 THEN repeat('x', 70) || '@x.com' ELSE 'jane@corp.com' END",
    "phone": "CASE o_orderkey % 5 WHEN 0 THEN '0000000000' WHEN 1 THEN '123' WHEN 2 THEN '+1555' || (1000000 + o_custkey) WHEN 3 THEN '12345678' ELSE CASE o_custkey % 2 WHEN 0 THEN '5551234567 x12' ELSE '5551234567' END END",
    "url": "CASE o_orderkey % 5 WHEN 0 THEN 'https://u:p@x.com/a' WHEN 1 THEN 'not a host' WHEN 2 THEN 'x' || o_custkey || '.org' WHEN 3 THEN 'http://-bad.com' ELSE 'https://www.linkedin.com/in/x' END",
    "person_name": "CASE o_orderkey % 7 WHEN 0 THEN 'Dr.' WHEN 1 THEN 'A' WHEN 2 THEN 'Test' WHEN 5 THEN 'Test.' WHEN 6 THEN 'Mrs..' WHEN 3 THEN 'Jane ' || (100 + o_custkey) ELSE 'Jane Doe2' END",
    "address": "CASE o_orderkey % 5 WHEN 0 THEN 'See Above.' WHEN 1 THEN '1 A' WHEN 2 THEN 'MainStreetNorthEnd' || o_custkey WHEN 3 THEN CASE o_custkey % 4 WHEN 0 THEN 'a@b.com' WHEN 1 THEN 'wwwilson street 4' WHEN 2 THEN 'WWW.x.org/1' ELSE 'http at b@c d' END ELSE '1 Main St' END",
    "integer": "CASE o_orderkey % 5 WHEN 0 THEN '0' WHEN 1 THEN '6000000' WHEN 2 THEN CAST(o_custkey AS VARCHAR) WHEN 3 THEN '12345678901234567890' ELSE '50' END",
    "postal_code": "CASE o_orderkey % 5 WHEN 0 THEN '501' WHEN 1 THEN '1' WHEN 2 THEN 'SW1A 1AA' WHEN 3 THEN 'A_B' ELSE '02134' END",
}
_RULE_FIELD = {"email": "email", "phone": "phone", "url": "linkedin_url", "person_name": "full_name", "address": "address_line1", "integer": "employee_count", "postal_code": "postal_code"}
_HOST = r"regexp_replace(regexp_replace(regexp_extract(v, '(?i)^(?:[a-z][a-z0-9+.-]*://)?([^/\s?#]+)', 1), '^.*@', ''), ':.*$', '')"
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
#: rule: value type, severity, condition of a pass, condition to apply.
_RULE_SQL = {
    "email.syntax": ("email", "'error'", r"regexp_matches(v, '^[^@\s]+@[^@\s.]+(?:\.[^@\s.]+)+$')", "true"),
    "email.length": ("email", "'error'", "length(v) <= 254 AND length(split_part(v, '@', 1)) <= 64", "true"),
    "email.role_account": ("email", "'warning'", f"lower(split_part(v, '@', 1)) NOT IN ({_list(vocab.ROLE_LOCAL_PARTS)})", "e = 'person' AND v LIKE '%@%'"),
    "email.consumer_domain": ("email", "'warning'", f"lower(split_part(v, '@', -1)) NOT IN ({_list(vocab.CONSUMER_DOMAINS)})", "e = 'company' AND v LIKE '%@%'"),
    "phone.digit_count": ("phone", "'error'", f"length({_DIGITS}) BETWEEN 7 AND 15", "true"),
    "phone.country_code": ("phone", "'warning'", "v LIKE '+%'", "true"),
    "phone.filler": ("phone", "'warning'", f"NOT (regexp_matches({_DIGITS}, '^(0+|1+|9+)$') OR (length({_DIGITS}) >= 7 AND (contains('0123456789', {_DIGITS}) OR contains('1234567890', {_DIGITS}) OR contains('9876543210', {_DIGITS}))))", f"{_DIGITS} <> ''"),
    "phone.extension_merged": ("phone", "'warning'", "NOT (lower(v) LIKE '% x%' OR lower(v) LIKE '%ext%')", "true"),
    "url.host": ("url", "'error'", rf"regexp_matches({_HOST}, '(?i)^[a-z0-9]([a-z0-9-]*[a-z0-9])?(\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)+$')", "true"),
    "linkedin.host": ("url", "'warning'", "lower(v) LIKE '%linkedin.%'", "true"),
    "url.embedded_credentials": ("url", "'warning'", "v NOT LIKE '%:%@%'", "true"),
    "name.length": ("person_name", "'error'", "length(v) >= 2", "true"),
    "name.placeholder": ("person_name", "'warning'", f"lower(trim(v)) NOT IN ({_list(vocab.PLACEHOLDER_NAMES)}) AND rtrim(lower(trim(v)), '.') NOT IN ({_list(vocab.BARE_TITLES)})", "true"),
    "name.shape": ("person_name", "'warning'", f"NOT (v LIKE '%@%' OR length({_DIGITS}) >= 3)", "true"),
    "full_name.completeness": ("person_name", "'warning'", "v LIKE '% %'", "true"),
    "address.length": ("address", "'warning'", "length(v) >= 5", "true"),
    "address.placeholder": ("address", "'warning'", f"rtrim(lower(trim(v)), '.') NOT IN ({_list(vocab.PLACEHOLDER_ADDRESSES)})", "true"),
    "address.spacing": ("address", "'warning'", "NOT (length(split_part(v, ' ', 1)) >= 12 AND regexp_matches(split_part(v, ' ', 1), '[a-z][A-Z]'))", "true"),
    "address.drifted_field": ("address", "'warning'", "NOT ((contains(v, '@') AND NOT contains(trim(v), ' ')) OR starts_with(lower(v), 'http://') OR starts_with(lower(v), 'https://') OR starts_with(lower(v), 'www.'))", "true"),
    "address.street_number": ("address", "'info'", "regexp_matches(v, '[0-9]')", "true"),
    "integer.input": ("integer", "'warning'", "regexp_matches(v, '^[0-9]+$')", "true"),
    "employee_count.range": ("integer", "CASE WHEN v = '0' THEN 'warning' ELSE 'error' END", "CAST(v AS HUGEINT) BETWEEN 1 AND 5000000", "true"),
    "postal_code.shape": ("postal_code", "'warning'", "length(v) BETWEEN 3 AND 10 AND regexp_matches(v, '^[A-Z0-9][A-Z0-9 -]*$')", "true"),
    "postal_code.us_zip_truncation": ("postal_code", "'warning'", "NOT (regexp_matches(v, '^[0-9]+$') AND length(v) < 5)", "true"),
}


def _rules_sql(kinds: tuple[str, ...]) -> str:
    arms = [
        f"SELECT o_orderkey, e, '{rule}' AS rule_id, {sev} AS severity, CASE WHEN {ok} THEN 'pass' ELSE 'fail' END AS outcome FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'person' ELSE 'company' END AS e, {_RULE_VALUES[kind]} AS v FROM orders) WHERE {when}"
        for rule, (kind, sev, ok, when) in _RULE_SQL.items() if kind in kinds
    ]
    return " UNION ALL ".join(arms)


def _rule_observations(spark, d: str, kinds: tuple[str, ...]) -> DataFrame:
    o = _t(spark, d, "orders")
    out = None
    for kind in kinds:
        value = F.expr(_RULE_VALUES[kind].replace("VARCHAR", "STRING"))
        arm = o.select(F.col("o_orderkey").cast("string").alias("observation_id"), F.col("o_orderkey").cast("string").alias("record_id"), F.lit("b").alias("batch_id"), F.lit("s").alias("source_id"), F.when(F.col("o_orderkey") % 2 == 0, "person").otherwise("company").alias("entity_type"), F.lit(_RULE_FIELD[kind]).alias("canonical_field"), value.alias("raw_value"), value.alias("normalized_value"), F.lit(kind).alias("value_type"), F.lit(kind).alias("normalization_method"))
        out = arm if out is None else out.unionByName(arm)
    return out


def _rules(spark, d: str, *kinds: str) -> DataFrame:
    r = validate.attribute_results(_rule_observations(spark, d, kinds), 2024)
    return r.select(F.col("record_id").cast("long").alias("o_orderkey"), F.col("entity_type").alias("e"), "rule_id", "severity", "outcome")


@query(_rules_sql(("email", "phone")))
def rules_email_phone(spark, d):
    return _rules(spark, d, "email", "phone")


@query(_rules_sql(("url", "person_name")))
def rules_url_name(spark, d):
    return _rules(spark, d, "url", "person_name")


@query(_rules_sql(("address", "integer", "postal_code")))
def rules_address_number_postal(spark, d):
    return _rules(spark, d, "address", "integer", "postal_code")


@query("SELECT c_custkey, CASE WHEN y BETWEEN 1600 AND 2024 THEN 'pass' ELSE 'fail' END AS outcome FROM (SELECT c_custkey, 1500 + c_custkey % 700 AS y FROM customer)")
def rules_founded_year(spark, d):
    y = (F.col("c_custkey") % 700 + 1500).cast("string")
    o = _t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("observation_id"), F.col("c_custkey").cast("string").alias("record_id"), F.lit("b").alias("batch_id"), F.lit("s").alias("source_id"), F.lit("company").alias("entity_type"), F.lit("founded_year").alias("canonical_field"), y.alias("raw_value"), y.alias("normalized_value"), F.lit("integer").alias("value_type"), F.lit("integer").alias("normalization_method"))
    return validate.attribute_results(o, 2024).where("rule_id = 'founded_year.range'").select(F.col("record_id").cast("long").alias("c_custkey"), "outcome")


_VERDICT_SQL = f"""
o AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'person' ELSE 'company' END AS e, {_RULE_VALUES['email']} AS email, CASE WHEN o_orderkey % 3 > 0 THEN {_RULE_VALUES['phone']} END AS phone FROM orders
), x AS (
  SELECT k, e, CASE WHEN k % 4 = 0 THEN NULL ELSE email END AS email, phone FROM o
)"""


def _record_observations(spark, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    k = F.col("o_orderkey")
    arms = [
        o.select(k, F.lit("email").alias("canonical_field"), F.when(k % 4 != 0, F.expr(_RULE_VALUES["email"])).alias("v")),
        o.select(k, F.lit("phone").alias("canonical_field"), F.when(k % 3 > 0, F.expr(_RULE_VALUES["phone"])).alias("v")),
        o.select(k, F.lit(None).cast("string").alias("canonical_field"), F.lit("x").alias("v")),
    ]
    rows = arms[0].unionByName(arms[1]).unionByName(arms[2])
    kind = F.coalesce("canonical_field", F.lit("text"))
    return rows.select(F.concat_ws("-", k.cast("string"), kind).alias("observation_id"), k.cast("string").alias("record_id"), F.lit("b").alias("batch_id"), F.lit("s").alias("source_id"), F.when(k % 2 == 0, "person").otherwise("company").alias("entity_type"), "canonical_field", F.coalesce("v", F.lit("")).alias("raw_value"), F.col("v").alias("normalized_value"), kind.alias("value_type"), F.when(F.col("v").isNull(), F.concat(kind, F.lit(":absent"))).otherwise(kind).alias("normalization_method"))


@query(f"""WITH {_VERDICT_SQL}, f AS (
  SELECT k, e, CASE WHEN email IS NULL THEN 1 ELSE 0 END AS no_id,
  CASE WHEN email IS NOT NULL AND (NOT regexp_matches(email, '^[^@\\s]+@[^@\\s.]+(?:\\.[^@\\s.]+)+$') OR length(split_part(email, '@', 1)) > 64) THEN 1 ELSE 0 END
   + CASE WHEN phone IS NOT NULL AND length(regexp_replace(phone, '[^0-9]', '', 'g')) NOT BETWEEN 7 AND 15 THEN 1 ELSE 0 END AS attr_errors FROM x
)
SELECT k AS o_orderkey, CASE WHEN no_id = 1 THEN 'invalid' ELSE 'warning' END AS status, CAST(no_id + attr_errors AS BIGINT) AS error_count FROM f""")
def record_verdict(spark, d):
    _, v = validate.validate(_record_observations(spark, d), 2024)
    return v.select(F.col("record_id").cast("long").alias("o_orderkey"), "status", "error_count")


@query(f"""WITH {_VERDICT_SQL} SELECT count(*) AS records, CAST(0 AS BIGINT) AS valid, count(*) FILTER (email IS NOT NULL) AS warning, count(*) FILTER (email IS NULL) AS invalid, CAST(2 * count(*) AS BIGINT) AS validated_attributes, count(*) AS unvalidated_attributes FROM x""")
def status_counts(spark, d):
    _, v = validate.validate(_record_observations(spark, d), 2024)
    return validate.status_counts(v)


@query(f"SELECT rule_id, severity, count(*) AS failures FROM ({_rules_sql(('email', 'phone', 'url'))}) WHERE outcome = 'fail' GROUP BY 1, 2")
def failure_breakdown(spark, d):
    return validate.failure_breakdown(validate.attribute_results(_rule_observations(spark, d, ("email", "phone", "url")), 2024))


# --- quarantine ---

_ITEM_SQL = "CASE o_orderkey % 5 WHEN 0 THEN 'open' WHEN 1 THEN 'released' WHEN 2 THEN 'rejected' WHEN 3 THEN 'resolved' END"


def _verdict_rows(spark, d: str) -> tuple[DataFrame, DataFrame]:
    o = _t(spark, d, "orders")
    k = F.col("o_orderkey").cast("string")
    v = o.select(k.alias("record_id"), F.lit("b").alias("batch_id"), F.lit("s").alias("source_id"), F.lit("person").alias("entity_type"), F.when(F.col("o_orderstatus") == "F", "invalid").when(F.col("o_orderstatus") == "O", "valid").otherwise("warning").alias("status"), F.lit(1).alias("error_count"), F.when(F.col("o_orderstatus") == "F", F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>")).alias("error_rules"))
    i = o.where("o_orderkey % 5 < 4").select(k.alias("record_id"), F.expr(_ITEM_SQL).alias("status"), F.when(F.col("o_custkey") % 2 == 0, F.array(F.lit("b"), F.lit("a"))).otherwise(F.array(F.lit("a"))).alias("reason_codes"))
    return v, i


@query(f"""WITH r AS (SELECT o_orderkey, o_orderstatus = 'F' AS bad, {_ITEM_SQL} AS item, o_custkey % 2 <> 0 AS changed FROM orders),
a AS (SELECT *, CASE WHEN bad AND item IS NULL THEN 'quarantined' WHEN bad AND item = 'open' AND changed THEN 'reasons_changed' WHEN bad AND item = 'released' AND changed THEN 'reopened' WHEN bad AND item = 'resolved' THEN 'quarantined' WHEN NOT bad AND item IN ('open', 'released') THEN 'resolved' END AS action FROM r)
SELECT o_orderkey, action, item AS from_status, CASE WHEN action = 'resolved' THEN 'resolved' ELSE 'open' END AS to_status, CASE WHEN action = 'resolved' THEN '' ELSE 'a,b' END AS reasons, CASE WHEN NOT bad THEN '' WHEN item IS NULL THEN 'a,b' WHEN changed THEN 'b' ELSE '' END AS added FROM a WHERE action IS NOT NULL""")
def quarantine_route(spark, d):
    v, i = _verdict_rows(spark, d)
    moves = quarantine.route(v, i, F.lit("2024-01-01").cast("timestamp"))
    return moves.select(F.col("record_id").cast("long").alias("o_orderkey"), "action", "from_status", "to_status", F.array_join("reason_codes", ",").alias("reasons"), F.array_join("added", ",").alias("added"))


@query(f"""SELECT o_orderkey, was IS NOT NULL AS was_quarantined FROM (SELECT o_orderkey, o_orderstatus, {_ITEM_SQL} AS was FROM orders) WHERE (was IS NULL OR was <> 'rejected') AND (o_orderstatus <> 'F' OR was = 'released')""")
def resolvable_gate(spark, d):
    v, i = _verdict_rows(spark, d)
    return quarantine.resolvable(_t(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("record_id")), v, i).select("o_orderkey", "was_quarantined")


@query(f"SELECT count(*) FILTER (s = 'open') AS open, count(*) FILTER (s = 'released') AS released, count(*) FILTER (s = 'rejected') AS rejected, count(*) FILTER (s = 'resolved') AS resolved FROM (SELECT {_ITEM_SQL} AS s FROM orders)")
def quarantine_counts(spark, d):
    return quarantine.quarantine_counts(_verdict_rows(spark, d)[1])


# --- resolution ---


def _page_units(spark, d: str) -> DataFrame:
    """Pages as company records: the website, a name of the first host label, two towns."""
    p = _t(spark, d, "pages")
    one = lambda c: F.array(c)
    name = F.concat(F.lit("n"), (F.col("page_id") % 40).cast("string"))
    values = F.map_filter(F.create_map(F.lit("website"), one(F.col("url")), F.lit("company_name"), one(name), F.lit("city"), one(F.when(F.col("page_id") % 2 == 0, "Rome").otherwise("Oslo"))), lambda k, v: F.size(v) > 0)
    rows = p.select(F.lpad(F.col("page_id").cast("string"), 9, "0").alias("record_id"), F.lit("b").alias("batch_id"), F.lit("s").alias("source_id"), F.lit("company").alias("entity_type"), F.lit("self").alias("subject"), values.alias("values"))
    order = p.select(F.lpad(F.col("page_id").cast("string"), 9, "0").alias("record_id"), F.col("page_id").alias("seq"))
    source = spark.createDataFrame([("s", "organisation")], "source_id string, describes string")
    return resolve.units(rows, order, source, spark.createDataFrame([], "record_id string"))


@query(f"""WITH p AS (SELECT page_id, 'n' || (page_id % 40) AS name, CASE WHEN page_id % 2 = 0 THEN 'Rome' ELSE 'Oslo' END AS city, {_DOMAIN_SQL} AS dom FROM pages)
SELECT page_id, 'website_domain' AS key_type, dom AS key_value, 'strong' AS strength FROM p WHERE dom LIKE '%.%' UNION ALL SELECT page_id, 'name', name, 'moderate' FROM p UNION ALL SELECT page_id, 'name_city', name || '|' || city, 'moderate' FROM p""")
def identity_keys(spark, d):
    return _page_units(spark, d).select(F.col("record_id").cast("long").alias("page_id"), F.explode("keys").alias("k")).select("page_id", "k.*")


@query(f"""WITH p AS (SELECT page_id, {_DOMAIN_SQL} AS dom, page_id % 40 AS n FROM pages), f AS (SELECT page_id, dom, n, min(page_id) OVER (PARTITION BY dom) AS first FROM p),
k AS (SELECT first, n, min(page_id) AS added FROM f GROUP BY ALL)
SELECT f.page_id, lpad(CAST(f.first AS VARCHAR), 9, '0') AS first_record, CASE WHEN f.page_id = f.first THEN 'new_entity' ELSE 'auto_linked' END AS match_status,
CASE WHEN f.page_id <> f.first THEN 'website_domain' WHEN EXISTS (SELECT 1 FROM k WHERE k.n = f.n AND k.added < f.page_id) THEN 'name_city' ELSE 'no_match' END AS match_method,
CASE WHEN f.page_id <> f.first THEN CASE WHEN EXISTS (SELECT 1 FROM k WHERE k.first = f.first AND k.n = f.n AND k.added < f.page_id) THEN 0.99 ELSE 0.92 END WHEN EXISTS (SELECT 1 FROM k WHERE k.n = f.n AND k.added < f.page_id) THEN 0.84 ELSE 0.0 END AS match_confidence
FROM f""")
def resolve_companies(spark, d):
    """Pages resolved in order: a known domain links, an equal name and town is a candidate for review."""
    none = spark.createDataFrame([], "entity_id string, entity_type string, key_type string, key_value string, strength string")
    out = resolve.resolve(_page_units(spark, d), none)
    first = out["entities"].select("entity_id", F.col("first_seen_record_id").alias("first_record"))
    return out["links"].join(first, "entity_id").select(F.col("record_id").cast("long").alias("page_id"), "first_record", "match_status", "match_method", F.col("match_confidence").cast("double").alias("match_confidence"))


@query("""SELECT o_orderkey, CASE WHEN s.strong THEN s.score ELSE least(s.score, 890) END AS score, s.method FROM (
  SELECT o_orderkey, o_orderkey % 2 = 0 AS strong, CASE WHEN o_custkey % 3 = 0 THEN 960 WHEN o_custkey % 3 = 1 THEN 920 ELSE 990 END AS score, 'website_domain' AS method FROM orders) s""")
def match_scores(spark, d):
    """Scores of shared keys: the best weight, more for other kinds, a ceiling without a strong key."""
    kinds = F.array(F.lit("website_domain"), F.lit("phone"), F.lit("name"))
    n = F.when(F.col("o_custkey") % 3 == 0, 2).when(F.col("o_custkey") % 3 == 1, 1).otherwise(3)
    weight = F.create_map(*[F.lit(x) for kv in resolve.WEIGHT["company"].items() for x in kv])
    types = F.transform(F.slice(kinds, 1, n), lambda k: F.struct(weight[k].alias("weight"), ((k == "website_domain") & (F.col("o_orderkey") % 2 == 0)).alias("strong"), k.alias("key_type")))
    return _t(spark, d, "orders").select("o_orderkey", resolve.score_column(F.lit("company"), types).alias("s")).select("o_orderkey", "s.score", "s.method")


@query("SELECT CAST(1 AS BIGINT) AS node, CAST(1 AS BIGINT) AS component WHERE false")
def entity_components_empty(spark, d):
    """Components of no edges: no rows."""
    none = _t(spark, d, "events").where("user_id < 0").select(F.col("user_id").alias("a"), F.col("event_id").alias("b"))
    return graph.components(none)


@query("""SELECT doc_id AS node, first AS component FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first, count(*) OVER (PARTITION BY text) AS n FROM documents) WHERE n > 1""")
def entity_components(spark, d):
    """Documents of equal text, joined through a chain of neighbours, as components."""
    from pyspark.sql import Window

    docs = _t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    chain = docs.withColumn("next", F.lead("doc_id").over(Window.partitionBy("h").orderBy("doc_id"))).where("next IS NOT NULL")
    return graph.components(chain.select(F.col("doc_id").alias("a"), F.col("next").alias("b")))


@query("""WITH k AS (SELECT user_id, event_type, min(event_id) AS added FROM events GROUP BY ALL) SELECT e.event_id, count(k.event_type) AS seen FROM events e LEFT JOIN k ON k.user_id = e.user_id AND k.added < e.event_id GROUP BY e.event_id""")
def asof_key_visibility(spark, d):
    """How many keys an entity had when an event came: only those that were added earlier count."""
    e = _t(spark, d, "events").select("user_id", "event_id", "event_type")
    k = e.groupBy("user_id", "event_type").agg(F.min("event_id").alias("added")).groupBy("user_id").agg(F.collect_list("added").alias("at"))  # one for each event type
    return e.join(k, "user_id").select("event_id", F.size(F.filter("at", lambda x: x < F.col("event_id"))).cast("long").alias("seen"))


@query("""SELECT n_nationkey AS entity_id, n_nationkey % 5 AS survivor_id FROM nation""")
def tombstone_resolution(spark, d):
    n = _t(spark, d, "nation").select(F.col("n_nationkey").alias("entity_id"), F.when(F.col("n_nationkey") >= 5, F.col("n_nationkey") - 5).cast("int").alias("merged_into_entity_id"))
    return merge.survivors(n)


@query("""SELECT l_suppkey % 7 AS entity_id, count(*) AS links, CAST(CASE WHEN l_suppkey % 7 IN (5, 6) THEN 0 ELSE 1 END AS INTEGER) AS active FROM (SELECT CASE WHEN l_suppkey % 7 = 5 THEN 0 WHEN l_suppkey % 7 = 6 THEN 1 ELSE l_suppkey % 7 END AS l_suppkey FROM lineitem) GROUP BY ALL""")
def merge_entities(spark, d):
    """Seven entities, two of them merged into others: links move, tombstones stay."""
    l = _t(spark, d, "lineitem")
    links = l.select((F.col("l_suppkey") % 7).cast("string").alias("entity_id"), F.col("l_orderkey").alias("record_id"))
    keys = l.select((F.col("l_suppkey") % 7).cast("string").alias("entity_id"), F.lit("company").alias("entity_type"), F.lit("phone").alias("key_type"), (F.col("l_partkey") % 9).cast("string").alias("key_value"), F.lit("k").alias("key_id")).distinct()
    ents = links.select("entity_id").distinct().withColumns({"status": F.lit("active"), "merged_into_entity_id": F.lit(None).cast("string")})
    plan = spark.createDataFrame([("5", "0"), ("6", "1")], "merged_id string, surviving_id string").withColumns({"actor": F.lit("t"), "reason": F.lit("t"), "confidence": F.lit("0.9").cast("decimal(4,3)")})
    out = merge.merge(links, keys, ents, plan, F.lit("2024-01-01").cast("timestamp"))
    return out["links"].groupBy("entity_id").agg(F.count("*").alias("links")).join(out["entities"], "entity_id").select(F.col("entity_id").cast("long").alias("entity_id"), "links", (F.col("status") == "active").cast("int").alias("active"))


@query(f"""WITH e AS (SELECT CAST(page_id AS VARCHAR) AS entity_id, {_DOMAIN_SQL} AS dom, 'name' || (page_id % 3) AS folded FROM pages)
SELECT dom AS key_value, folded, string_agg(entity_id, ',' ORDER BY entity_id) AS entity_ids, CAST(min(CAST(entity_id AS BIGINT)) AS VARCHAR) AS survivor FROM e GROUP BY 1, 2 HAVING count(DISTINCT entity_id) > 1""")
def reblock_groups(spark, d):
    """Entities that share a domain and a folded name, with the survivor by number of links."""
    p = _t(spark, d, "pages")
    ident = F.col("page_id").cast("string").alias("entity_id")
    keys = p.select(ident, F.lit("website_domain").alias("key_type"), text.website_domain(F.col("url")).alias("key_value"), F.lit("strong").alias("strength"))
    gold = p.select(ident, F.lit("company_name").alias("canonical_field"), F.concat(F.lit("Name "), (F.col("page_id") % 3).cast("string")).alias("value"), F.lit(None).cast("timestamp").alias("valid_to"))
    ents = p.select(ident, F.lit("company").alias("entity_type"), F.lit("active").alias("status"))
    links = p.select(ident, F.col("page_id"), F.explode(F.sequence(F.lit(0), F.lit(100000) - F.col("page_id").cast("int"), F.lit(100000))).alias("i"))
    groups = merge.survivor_of(merge.duplicate_groups(keys, gold, ents, "company"), links.union(links.where("i < 0")))
    # one link each: the smallest id as text; the oracle's smallest number is found among them here
    return groups.select("key_value", "folded", F.array_join("entity_ids", ",").alias("entity_ids"), F.array_min(F.transform("entity_ids", lambda x: x.cast("long"))).cast("string").alias("survivor"))


# --- lineage ---


def _part_tables(spark, d: str) -> dict[str, DataFrame]:
    p = _t(spark, d, "part")
    ident = F.col("p_partkey").cast("string").alias("entity_id")
    return {
        "entity": p.select(ident, F.when(F.col("p_size") % 2 == 0, "person").otherwise("company").alias("entity_type"), F.when(F.col("p_size") > 45, "merged").otherwise("active").alias("status")),
        "entity_identity_key": p.select(ident, F.col("p_name").alias("key_value")),
        "golden_attribute": p.where("p_size % 3 > 0").select(ident, F.lit("company_name").alias("canonical_field"), F.col("p_name").alias("value"), F.lit(None).cast("timestamp").alias("valid_to")),
        "record_entity_link": _t(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("entity_id"), F.col("l_orderkey").alias("record_id")),
    }


@query("""SELECT CAST(p_partkey AS VARCHAR) AS entity_id, 'company' AS entity_type, CASE WHEN p_size % 3 > 0 THEN p_name END AS display_name, (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_partkey = p_partkey) AS record_count
FROM part WHERE p_name ILIKE '%RED%' AND p_size % 2 = 1 AND p_size <= 45 ORDER BY display_name NULLS LAST, entity_id LIMIT 50""")
def find_entities_ilike(spark, d):
    return lineage.find_entities(_part_tables(spark, d), "RED", "company")


@query("""SELECT ts AS at, 'click' AS event, CAST(event_id AS VARCHAR) || ' ' || event_type AS detail FROM events WHERE event_type = 'click' UNION ALL SELECT o_orderdate, 'order', CAST(o_orderkey AS VARCHAR) || ' ' || CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END FROM orders""")
def timeline_union(spark, d):
    """Arms of a timeline; a detail with a null part is null."""
    arm = lambda df, at, event, key, word: df.select(F.col(at).cast("timestamp_ntz").alias("at"), F.lit(event).alias("event"), F.concat(F.col(key).cast("string"), F.lit(" "), word).alias("detail"))
    clicks = arm(_t(spark, d, "events").where("event_type = 'click'"), "ts", "click", "event_id", F.col("event_type"))
    orders = arm(_t(spark, d, "orders"), "o_orderdate", "order", "o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")))
    return clicks.unionByName(orders)


@query("""SELECT l.l_orderkey AS record_id, l.l_linenumber AS line, CAST(l.l_suppkey AS VARCHAR) AS entity_id, s.s_name AS source_name, o.o_orderpriority AS file_name, o.o_orderstatus AS validation_status FROM lineitem l JOIN supplier s ON l_suppkey = s_suppkey JOIN orders o ON l_orderkey = o_orderkey""")
def explain_contributions(spark, d):
    """The chain of joins behind a contribution, over line items, suppliers and orders."""
    l, s, o = (_t(spark, d, n) for n in ("lineitem", "supplier", "orders"))
    t = {
        "attribute_observation": l.select(F.col("l_orderkey").alias("record_id"), F.lit("self").alias("subject"), F.col("l_suppkey").alias("source_id"), F.col("l_orderkey").alias("batch_id"), F.lit("c").alias("source_column"), F.lit("x").alias("canonical_field"), F.lit("").alias("raw_value"), F.lit("").alias("normalized_value"), F.col("l_linenumber").alias("observation_id")),
        "record_entity_link": o.select(F.col("o_orderkey").alias("record_id"), F.lit("self").alias("role"), F.lit("e").alias("entity_id")),
        "raw_record": o.select(F.col("o_orderkey").alias("record_id"), F.lit(1).alias("row_number"), F.lit("").alias("source_record_id")),
        "batch": o.select(F.col("o_orderkey").alias("batch_id"), F.col("o_orderpriority").alias("file_name"), F.lit("s").alias("source_schema_id")),
        "source": s.select(F.col("s_suppkey").alias("source_id"), F.col("s_name").alias("source_name"), F.lit(1).alias("reliability")),
        "record_validation": o.select(F.col("o_orderkey").alias("record_id"), F.col("o_orderstatus").alias("status")),
        "column_mapping": spark.createDataFrame([("s", "c", "m", 1)], "source_schema_id string, source_column string, mapping_method string, mapping_confidence int"),
    }
    supp = F.regexp_extract("source_name", "#0*([0-9]+)$", 1)
    return lineage.contributions(t).select("record_id", F.col("observation_id").alias("line"), supp.alias("entity_id"), "source_name", "file_name", "validation_status")


@query("""SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')""")
def anti_unlinked(spark, d):
    return _t(spark, d, "customer").select("c_custkey").join(_t(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("""SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AND c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def semi_exists(spark, d):
    return _t(spark, d, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).join(_t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey", "c_name")


# --- metrics, reports, upserts ---


@query("""SELECT 'mapping needs review' AS queue, count(*) AS items FROM part WHERE p_size % 2 = 0 UNION ALL SELECT 'quarantined records', count(*) FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 'possible duplicate entities', count(*) FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'rows that failed to process', count(*) FROM supplier WHERE s_suppkey % 4 = 0""")
def queue_union_counts(spark, d):
    mark = lambda name, col, word: _t(spark, d, name).select(F.when(col, word).alias("s"))
    t = {"column_mapping": mark("part", F.col("p_size") % 2 == 0, "needs_review").withColumnRenamed("s", "mapping_status"), "quarantine_item": mark("orders", F.col("o_orderstatus") == "O", "open").withColumnRenamed("s", "status"), "match_candidate": mark("customer", F.col("c_custkey") % 3 == 0, "open").withColumnRenamed("s", "status"), "record_error": mark("supplier", F.col("s_suppkey") % 4 == 0, "open").withColumnRenamed("s", "status")}
    return metrics.queues(t)


@query("""WITH r AS (SELECT s_suppkey AS k, s_name AS source_name FROM supplier), done AS (SELECT o_orderkey, o_custkey % 50 AS s FROM orders WHERE o_orderstatus <> 'P')
SELECT r.source_name, count(DISTINCT done.o_orderkey) AS files, count(DISTINCT l.l_orderkey * 10 + l.l_linenumber) AS records, count(DISTINCT l.l_partkey) FILTER (WHERE l.l_orderkey IS NOT NULL) AS entities
FROM r LEFT JOIN done ON done.s = r.k LEFT JOIN lineitem l ON l.l_orderkey = done.o_orderkey GROUP BY 1""")
def contribution_report(spark, d):
    o, l = _t(spark, d, "orders"), _t(spark, d, "lineitem")
    raw = l.join(o.select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 50).alias("source_id")), "l_orderkey").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("record_id"), F.col("l_orderkey").alias("batch_id"), "source_id", F.col("l_partkey").alias("entity_id"))
    t = {
        "source": _t(spark, d, "supplier").select(F.col("s_suppkey").alias("source_id"), F.col("s_name").alias("source_name"), F.lit(1).alias("reliability")),
        "batch": o.select(F.col("o_orderkey").alias("batch_id"), (F.col("o_custkey") % 50).alias("source_id"), F.when(F.col("o_orderstatus") != "P", "completed").alias("status")),
        "raw_record": raw.drop("entity_id"), "record_entity_link": raw.select("record_id", "entity_id"),
    }
    return metrics.contribution_report(t).drop("reliability")


@query("""SELECT p_brand AS brand, CAST(max(p_size) AS INTEGER) AS size, CASE WHEN max(p_size) > 48 THEN NULL ELSE p_brand END AS shown FROM part GROUP BY p_brand ORDER BY shown NULLS LAST, brand LIMIT 10""")
def nulls_last_topk(spark, d):
    p = _t(spark, d, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.max("p_size").alias("size"))
    return p.withColumn("shown", F.when(F.col("size") <= 48, F.col("brand"))).orderBy(F.asc_nulls_last("shown"), "brand").limit(10)


def _halves(spark, d: str) -> tuple[DataFrame, DataFrame]:
    c = _t(spark, d, "customer").select(F.when(F.col("c_custkey") > 0, F.col("c_custkey").cast("string")).alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"))
    return c.where("k IS NULL OR cast(k as bigint) % 3 < 2"), c.where("k IS NULL OR cast(k as bigint) % 3 > 0").select("k", F.lit("new").alias("name"), F.lit("seg").alias("seg"))


_HALVES_SQL = "c AS (SELECT CASE WHEN c_custkey > 0 THEN CAST(c_custkey AS VARCHAR) END AS k, c_name AS name, c_mktsegment AS seg FROM customer), a AS (SELECT * FROM c WHERE k IS NULL OR CAST(k AS BIGINT) % 3 < 2), b AS (SELECT k, 'new' AS name, 'seg' AS seg FROM c WHERE k IS NULL OR CAST(k AS BIGINT) % 3 > 0)"


def _upsert(spark, d: str, policy: str, columns=None) -> DataFrame:
    a, b = _halves(spark, d)
    return upsert.upsert(a, b, ["k"], policy, columns)


@query(f"WITH {_HALVES_SQL} SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.k IS NOT DISTINCT FROM b.k)")
def upsert_ignore(spark, d):
    return _upsert(spark, d, "ignore")


@query(f"WITH {_HALVES_SQL} SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.k IS NOT DISTINCT FROM b.k)")
def upsert_overwrite(spark, d):
    return _upsert(spark, d, "overwrite")


@query(f"WITH {_HALVES_SQL} SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.name IS NULL OR b.name IS NOT NULL THEN b.name ELSE a.name END AS name, coalesce(a.seg, b.seg) AS seg FROM a FULL JOIN b ON a.k IS NOT DISTINCT FROM b.k")
def upsert_columns(spark, d):
    return _upsert(spark, d, "columns", ["name"])


@query(f"WITH {_HALVES_SQL} SELECT 't' AS \"table\", 'first only' AS side, count(*) AS rows FROM (SELECT k FROM a EXCEPT ALL SELECT k FROM b) UNION ALL SELECT 't', 'second only', count(*) FROM (SELECT k FROM b EXCEPT ALL SELECT k FROM a)")
def parity_compare(spark, d):
    a, b = _halves(spark, d)
    return metrics.parity({"t": a}, {"t": b}, {"t": ["k"]})


@query("""SELECT o_custkey % 10 AS source, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_orders, count(DISTINCT o_custkey) AS customers, coalesce(max(o_orderkey) FILTER (WHERE o_orderstatus = 'P'), -1) AS last_pending FROM orders GROUP BY 1""")
def distinct_filter_counts(spark, d):
    return _t(spark, d, "orders").groupBy((F.col("o_custkey") % 10).alias("source")).agg(F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"), F.countDistinct("o_custkey").alias("customers"), F.coalesce(F.max(F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey"))), F.lit(-1)).alias("last_pending"))


# --- lists and lookups ---


@query("""SELECT o_orderkey AS candidate_id, CAST(o_totalprice AS DOUBLE) AS match_confidence FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderdate, o_orderkey LIMIT 20""")
def review_queue(spark, d):
    c = _t(spark, d, "orders").select(F.col("o_orderkey").alias("candidate_id"), F.col("o_totalprice").alias("match_confidence"), F.col("o_orderdate").alias("created_at"), F.when(F.col("o_orderstatus") == "O", "open").otherwise("rejected").alias("status"))
    return listing.candidates(c, limit=20).select("candidate_id", "match_confidence")


@query("""SELECT o_orderkey AS batch_id FROM orders WHERE o_custkey = 7 AND o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey LIMIT 1""")
def newest_completed_batch(spark, d):
    b = _t(spark, d, "orders").select(F.col("o_orderkey").alias("batch_id"), F.col("o_custkey").alias("source_id"), F.lit("h").alias("file_hash"), F.when(F.col("o_orderstatus") == "F", "completed").alias("status"), F.col("o_orderdate").alias("started_at"))
    return listing.completed_batch(b, 7, "h").select("batch_id")


@query("""SELECT DISTINCT l_suppkey AS entity_id, CASE WHEN s_nationkey % 2 = 0 THEN 'person' ELSE 'company' END AS entity_type FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_partkey = 7 AND s_acctbal > 0""")
def entities_of_batch(spark, d):
    links = _t(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("batch_id"), F.col("l_suppkey").alias("entity_id"))
    ents = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("entity_id"), F.when(F.col("s_nationkey") % 2 == 0, "person").otherwise("company").alias("entity_type"), F.when(F.col("s_acctbal") > 0, "active").otherwise("merged").alias("status"))
    return listing.entities_of_batch(links, ents, "7")


_FLAGSHIP_SQL = rf"""WITH p AS (SELECT page_id, url, 'n' || (page_id % 40) AS name, min(page_id) OVER (PARTITION BY {_DOMAIN_SQL}) AS first FROM pages),
v AS (SELECT first, 'company_name' AS canonical_field, name AS value, 'most_frequent' AS strategy FROM p UNION ALL SELECT first, 'website', regexp_replace(url, '/+$', ''), 'most_reliable_source' FROM p)
SELECT substr(sha256('=entity' || chr(31) || '=company' || chr(31) || '=' || lpad(CAST(first AS VARCHAR), 9, '0') || chr(31) || '=self'), 1, 32) AS entity_id, canonical_field, min(value) AS value, strategy,
CASE WHEN count(DISTINCT value) > 1 THEN 0.4 ELSE 0.5 END::DOUBLE AS confidence, CAST(1 AS INTEGER) AS supporting_sources, CAST(count(DISTINCT value) AS INTEGER) AS competing_values FROM v GROUP BY first, canonical_field, strategy"""


@query(_FLAGSHIP_SQL)
def website_golden(spark, d: str) -> DataFrame:
    """Web pages to companies: domains as keys, entities, the most frequent name of each, with confidence."""
    none = spark.createDataFrame([], "entity_id string, entity_type string, key_type string, key_value string, strength string")
    links = resolve.resolve(_page_units(spark, d), none)["links"].select("record_id", "entity_id", "entity_type")
    p = _t(spark, d, "pages").select(F.lpad(F.col("page_id").cast("string"), 9, "0").alias("record_id"), "page_id", "url")
    arms = [p.select("record_id", F.lit(f).alias("canonical_field"), c.alias("value")) for f, c in (("company_name", F.concat(F.lit("n"), (F.col("page_id") % 40).cast("string"))), ("website", text.url(F.col("url"))))]
    claims = arms[0].unionByName(arms[1]).join(links, "record_id").select("entity_id", "entity_type", "canonical_field", "value", F.col("value").alias("raw_value"), F.lit("s").alias("source_id"), F.lit("crawl").alias("source_name"), F.lit("0.5").cast("decimal(3,2)").alias("reliability"), "record_id", F.lit("2024-01-01").cast("timestamp").alias("observed_at"))
    return golden.choices(claims).select("entity_id", "canonical_field", "value", "strategy", F.col("confidence").cast("double").alias("confidence"), "supporting_sources", "competing_values")


flagship = website_golden

from . import operator_queries  # noqa: E402, F401  registers its queries
