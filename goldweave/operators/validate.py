"""Validation: rules over values and records, as one array of structs per row; nothing is changed, only judged."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import text

ERROR, WARNING, INFO = "error", "warning", "info"


@dataclass(frozen=True)
class Context:
    """Columns that a rule may look at besides the normalized value."""

    entity_type: Column
    canonical_field: Column
    raw_value: Column
    year: Column


@dataclass(frozen=True)
class Rule:
    """ok gives true (pass), false (fail) or null (does not apply)."""

    rule_id: str
    severity: str
    message: str
    ok: Callable[[Column, Context], Column]
    failed_severity: Callable[[Column], Column] | None = None


def _host(v: Column) -> Column:
    authority = F.regexp_extract(v, r"(?i)^(?:[a-z][a-z0-9+.-]*://)?([^/\s?#]+)", 1)
    return F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":.*$", "")


def _authority(v: Column) -> Column:
    return F.regexp_extract(v, r"(?i)^(?:[a-z][a-z0-9+.-]*://)?([^/\s?#]+)", 1)


def _local(v: Column) -> Column:
    return F.lower(F.regexp_extract(v, "^(.*)@[^@]*$", 1))


def _number(v: Column) -> Column:
    """Digits as a number; longer ones than 18 are above every limit anyway."""
    return F.when(F.length(v) > 18, F.lit(10**18)).otherwise(v.try_cast("long"))


def _only(condition: Column, ok: Column) -> Column:
    return F.when(condition, ok)


def _filler(v: Column) -> Column:
    d = text.digits(v)
    sequence = F.lit(False)
    for s in vocab.PHONE_SEQUENCES:
        sequence = sequence | F.lit(s).contains(d)
    return _only(d != "", ~(d.rlike("^(0+|1+|9+)$") | ((F.length(d) >= 7) & sequence)))


#: Rules of each value type, in order. Types that are not here have none.
RULES: dict[str, tuple[Rule, ...]] = {
    "email": (
        Rule("email.syntax", ERROR, "not an email address", lambda v, c: v.rlike(r"^[^@\s]+@[^@\s.]+(?:\.[^@\s.]+)+$")),
        Rule("email.length", ERROR, "longer than mail systems accept", lambda v, c: (F.length(v) <= 254) & (F.length(F.regexp_extract(v, "^([^@]*)", 1)) <= 64)),
        Rule("email.role_account", WARNING, "a mailbox of a function, not of a person", lambda v, c: _only((c.entity_type == "person") & v.contains("@"), ~_local(v).isin(*vocab.ROLE_LOCAL_PARTS))),
        Rule("email.consumer_domain", WARNING, "a company reached at a consumer mail provider", lambda v, c: _only((c.entity_type == "company") & v.contains("@"), ~F.lower(F.regexp_extract(v, "@([^@]*)$", 1)).isin(*vocab.CONSUMER_DOMAINS))),
    ),
    "phone": (
        Rule("phone.digit_count", ERROR, "too few or too many digits to dial", lambda v, c: F.length(text.digits(v)).between(7, 15)),
        Rule("phone.country_code", WARNING, "no country code", lambda v, c: v.startswith("+")),
        Rule("phone.filler", WARNING, "placeholder digits", lambda v, c: _filler(v)),
        Rule("phone.extension_merged", WARNING, "an extension has become part of the number", lambda v, c: ~F.lower(c.raw_value).rlike(" x|ext")),
    ),
    "url": (
        Rule("url.host", ERROR, "no usable host name", lambda v, c: _host(v).rlike(r"(?i)^[a-z0-9]([a-z0-9-]*[a-z0-9])?(\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)+$")),
        Rule("linkedin.host", WARNING, "not a LinkedIn address", lambda v, c: _only(c.canonical_field == "linkedin_url", F.lower(v).contains("linkedin."))),
        Rule("url.embedded_credentials", WARNING, "credentials inside the address", lambda v, c: ~_authority(v).rlike("^[^@]*:.*@")),
    ),
    "person_name": (
        Rule("name.length", ERROR, "too short for a name", lambda v, c: F.length(v) >= 2),
        Rule("name.placeholder", WARNING, "a placeholder or a bare title", lambda v, c: ~(F.lower(text.strip(v)).isin(*vocab.PLACEHOLDER_NAMES) | F.regexp_replace(F.lower(text.strip(v)), r"\.+$", "").isin(*vocab.BARE_TITLES))),
        Rule("name.shape", WARNING, "looks like another field", lambda v, c: ~(v.contains("@") | (F.length(text.digits(v)) >= 3))),
        Rule("full_name.completeness", WARNING, "one word only", lambda v, c: _only(c.canonical_field == "full_name", F.size(F.split(text.collapse(v), " ")) >= 2)),
    ),
    "address": (
        Rule("address.length", WARNING, "too short for an address", lambda v, c: F.length(v) >= 5),
        Rule("address.placeholder", WARNING, "a placeholder", lambda v, c: ~F.regexp_replace(F.lower(text.strip(v)), r"\.+$", "").isin(*vocab.PLACEHOLDER_ADDRESSES)),
        Rule("address.spacing", WARNING, "words run together", lambda v, c: ~F.exists(F.split(v, r"\s+"), lambda t: (F.length(t) >= 12) & t.rlike("[a-z][A-Z]"))),
        Rule("address.drifted_field", WARNING, "an email or a link in the address", lambda v, c: ~((v.contains("@") & ~text.strip(v).contains(" ")) | F.lower(v).rlike(r"^(https?://|www\.)"))),
        Rule("address.street_number", INFO, "no number", lambda v, c: v.rlike("[0-9]")),
    ),
    "integer": (
        Rule("integer.input", WARNING, "not written as plain digits", lambda v, c: text.strip(c.raw_value).rlike("^[0-9]+$")),
        Rule(
            "employee_count.range", ERROR, "no plausible head count",
            lambda v, c: _only(c.canonical_field == "employee_count", (_number(v) <= vocab.MAX_EMPLOYEES) & (_number(v) > 0)),
            lambda v: F.when(_number(v) == 0, WARNING).otherwise(ERROR),
        ),
        Rule("founded_year.range", ERROR, "no plausible year", lambda v, c: _only(c.canonical_field == "founded_year", _number(v).between(vocab.MIN_FOUNDED_YEAR, c.year))),
    ),
    "postal_code": (
        Rule("postal_code.shape", WARNING, "no postal code of any country", lambda v, c: F.length(v).between(3, 10) & v.rlike("^[A-Z0-9][A-Z0-9 -]*$")),
        Rule("postal_code.us_zip_truncation", WARNING, "leading zeros may be lost", lambda v, c: ~(v.rlike("^[0-9]+$") & (F.length(v) < 5))),
    ),
}

_JUDGEMENT = "array<struct<rule_id:string,severity:string,outcome:string,message:string>>"


def _judgement(rule_id: str, severity: Column, ok: Column, message: str) -> Column:
    """A struct, or null where the rule does not apply."""
    return F.when(
        ok.isNotNull(),
        F.struct(F.lit(rule_id).alias("rule_id"), severity.alias("severity"), F.when(ok, "pass").otherwise("fail").alias("outcome"), F.when(~ok, F.lit(message)).alias("message")),
    )


def value_judgements(value: Column, value_type: Column, method: Column, context: Context) -> Column:
    """Array of the judgements of one value; a null token or absent cell has none."""
    out = F.lit(None).cast(_JUDGEMENT)
    for kind, rules in RULES.items():
        found = F.array(*[_judgement(r.rule_id, F.when(~r.ok(value, context), r.failed_severity(value)).otherwise(r.severity) if r.failed_severity else F.lit(r.severity), r.ok(value, context), r.message) for r in rules])
        out = F.when((value_type == kind) & value.isNotNull(), F.filter(found, lambda j: j.isNotNull())).otherwise(out)
    lost = lambda suffix, rule: _judgement(rule, F.lit(ERROR), F.when(method.endswith(suffix), F.lit(False)), "the raw value is kept, no value is left to use")
    failed = F.filter(F.array(lost(":failed", "value.normalization_failed"), lost(":empty", "value.empty_after_normalization")), lambda j: j.isNotNull())
    return F.coalesce(F.when(value.isNull(), failed).otherwise(out), F.array().cast(_JUDGEMENT))


def attribute_results(obs: DataFrame, current_year: int) -> DataFrame:
    """A row for each judgement of each mapped value."""
    context = Context(F.col("entity_type"), F.col("canonical_field"), F.col("raw_value"), F.lit(current_year))
    judged = obs.where("canonical_field IS NOT NULL").select(
        "observation_id", "record_id", "batch_id", "source_id", "entity_type", "canonical_field",
        F.explode(value_judgements(F.col("normalized_value"), F.col("value_type"), F.col("normalization_method"), context)).alias("j"),
    )
    return judged.select("observation_id", "record_id", "batch_id", "source_id", "entity_type", F.lit("attribute").alias("scope"), "canonical_field", "j.*")


def record_facts(obs: DataFrame) -> DataFrame:
    """One row a record: present (fields with a value), total, canonical, populated."""
    return obs.groupBy("record_id", "batch_id", "source_id", "entity_type").agg(
        F.collect_set(F.when(F.col("normalized_value").isNotNull(), F.col("canonical_field"))).alias("present"),  # at most the vocabulary
        F.count("*").alias("total"),
        F.count("canonical_field").alias("canonical"),
        F.count("normalized_value").alias("populated"),
        F.count_if(F.col("canonical_field").isNotNull()).alias("validated_attributes"),
        F.count_if(F.col("canonical_field").isNull()).alias("unvalidated_attributes"),
    )


def _fields(table: dict[str, tuple[str, ...]]) -> Column:
    arrays = {k: F.array(*[F.lit(x) for x in v]) for k, v in table.items()}
    return F.when(F.col("entity_type") == "person", arrays["person"]).otherwise(arrays["company"])


def record_judgements() -> Column:
    """Array of the five judgements of record_facts()."""
    present = F.col("present")
    missing = lambda table: F.array_except(_fields(table), present)
    parts = F.lit(True)
    for f in vocab.NAME_PARTS:
        parts = parts & F.array_contains(present, f)
    named = F.arrays_overlap(present, _fields(vocab.IDENTIFYING)) | ((F.col("entity_type") == "person") & parts)
    covered = (F.col("total") > 0) & (F.col("canonical") / F.greatest(F.col("total"), F.lit(1)) >= vocab.MIN_COVERAGE)
    return F.array(
        _judgement("record.all_values_missing", F.lit(ERROR), F.col("populated") > 0, "every column is blank or a null token"),
        _judgement("record.has_identifier", F.lit(ERROR), named, "nothing identifies this row"),
        _judgement("record.core_fields", F.lit(WARNING), F.size(missing(vocab.CORE)) == 0, "a core field is missing"),
        _judgement("record.expected_fields", F.lit(INFO), F.size(missing(vocab.EXPECTED)) == 0, "an expected field is missing"),
        _judgement("record.mapping_coverage", F.lit(WARNING), covered, "most columns have no confirmed field"),
    )


def record_results(facts: DataFrame) -> DataFrame:
    judged = facts.withColumn("j", F.explode(record_judgements()))
    return judged.select(F.lit(None).cast("string").alias("observation_id"), "record_id", "batch_id", "source_id", "entity_type", F.lit("record").alias("scope"), F.lit(None).cast("string").alias("canonical_field"), "j.*")


def record_status(record_errors: Column, attribute_errors: Column, warnings: Column) -> Column:
    """Only a record-level error makes a record invalid; a bad value is a warning about the record."""
    return F.when(record_errors > 0, "invalid").when((attribute_errors > 0) | (warnings > 0), "warning").otherwise("valid")


def verdicts(results: DataFrame, facts: DataFrame) -> DataFrame:
    """One row a record: status, counts, failed_rules (errors and warnings, sorted), error_rules."""
    failed = F.col("outcome") == "fail"
    is_error, is_warning = failed & (F.col("severity") == ERROR), failed & (F.col("severity") == WARNING)
    counted = results.groupBy("record_id").agg(
        F.count_if(is_error & (F.col("scope") == "record")).alias("record_errors"),
        F.count_if(is_error & (F.col("scope") == "attribute")).alias("attribute_errors"),
        F.count_if(is_warning).alias("warning_count"),
        F.array_sort(F.collect_set(F.when(is_error | is_warning, F.col("rule_id")))).alias("failed_rules"),  # at most the rules
        F.array_sort(F.collect_set(F.when(is_error, F.col("rule_id")))).alias("error_rules"),
    )
    return facts.join(counted, "record_id").select(
        "record_id", "batch_id", "source_id", "entity_type",
        record_status(F.col("record_errors"), F.col("attribute_errors"), F.col("warning_count")).alias("status"),
        (F.col("record_errors") + F.col("attribute_errors")).alias("error_count"),
        "warning_count", "validated_attributes", "unvalidated_attributes", "failed_rules", "error_rules",
        F.lit(vocab.RULESET_VERSION).alias("ruleset_version"),
    )


def validate(obs: DataFrame, current_year: int) -> tuple[DataFrame, DataFrame]:
    """(validation results, record verdicts) of observations. Founding years are held against current_year."""
    facts = record_facts(obs)
    results = attribute_results(obs, current_year).unionByName(record_results(facts))
    return results, verdicts(results, facts)


def status_counts(verdict: DataFrame) -> DataFrame:
    return verdict.agg(
        F.count("*").alias("records"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("valid", "warning", "invalid")],
        F.coalesce(F.sum("validated_attributes"), F.lit(0)).alias("validated_attributes"),
        F.coalesce(F.sum("unvalidated_attributes"), F.lit(0)).alias("unvalidated_attributes"),
    )


def failure_breakdown(results: DataFrame) -> DataFrame:
    return results.where("outcome = 'fail'").groupBy("rule_id", "severity").agg(F.count("*").alias("failures")).orderBy(F.desc("failures"), "rule_id", "severity")
