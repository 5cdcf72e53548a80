"""Files through all stages, on a store in a temporary folder."""

from datetime import datetime, timezone

import pytest

from goldweave.operators import lineage, metrics
from goldweave.plans import runs
from goldweave.sources.store import Store

T1, T2, T3 = (datetime(2024, 5, d, tzinfo=timezone.utc) for d in (1, 2, 3))

COMPANIES_A = """org_name,web_address,phone_number,street_address,city,employees,founded,description
Acme Corp,https://www.acme.com/,+1 555 123 4567,1 Main St,BOSTON,120,1999,Tools
Beta Ltd,beta.io,0000000000,22 Side Rd,Paris,50-100,2099,
Gamma,,,,,,,
,,,,,,,
NULL,N/A,-,,,,,
"""
COMPANIES_B = """company,website,address,city,state,employees
ACME Corporation,http://acme.com/about,9 New Ave,Boston,ma,130
Delta GmbH,delta.de,5 Strasse,Berlin,,10
"""
PEOPLE = """full_name,e_mail,mobile_no,employer,company_domain,title,city
JANE O'BRIEN,Jane@Acme.com,+15551112222,Acme Corp,acme.com,CTO,Boston
Jane O'Brien,jane@acme.com,+15551112222,Acme Corp,acme.com,CEO,Boston
Bob Ray,info@shared.org,,Self-Employed,,,Paris
Al Mac,info@shared.org,,freelance,,,Rome
"""


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    store = Store(spark, f"file://{root}/db")
    for name, body in (("a.csv", COMPANIES_A), ("b.csv", COMPANIES_B), ("p.csv", PEOPLE)):
        (root / name).write_text(body)
    runs.run_file(store, f"file://{root}/a.csv", "company", "vendor a", reliability="0.60", at=T1)
    runs.run_file(store, f"file://{root}/b.csv", "company", "vendor b", reliability="0.80", at=T2)
    runs.run_file(store, f"file://{root}/p.csv", "person", "people", reliability="0.50", at=T3)
    return store, root


def golden(store, entity_type, field):
    return {r["value"] for r in store.table("golden_attribute").where(f"valid_to IS NULL AND entity_type = '{entity_type}' AND canonical_field = '{field}'").collect()}


def test_rows_are_stored_verbatim_and_blank_rows_dropped(loaded):
    store, _ = loaded
    rows = store.table("raw_record").where("entity_type = 'company'").orderBy("ingested_at", "row_number").collect()
    assert [r["row_number"] for r in rows] == [1, 2, 3, 4, 1, 2]
    assert rows[1]["raw_payload"]["employees"] == "50-100"


def test_unidentified_record_is_quarantined_and_kept_from_resolution(loaded):
    store, _ = loaded
    items = store.table("quarantine_item").collect()
    assert len(items) == 1 and items[0]["status"] == "open"
    assert "record.has_identifier" in items[0]["reason_codes"]
    assert store.table("record_entity_link").where(f"record_id = '{items[0]['record_id']}'").isEmpty()


def test_bad_values_are_warnings_only(loaded):
    store, _ = loaded
    status = {r["source_record_id"]: r["status"] for r in store.table("raw_record").where("entity_type = 'company'").join(store.table("record_validation").select("record_id", "status"), "record_id").where("source_id = source_id").collect() if r["ingested_at"].day == 1}
    assert status["2"] == "warning" and status["4"] == "invalid"
    failed = {r["rule_id"] for r in store.table("validation_result").where("outcome = 'fail'").collect()}
    assert {"phone.filler", "founded_year.range", "integer.input", "email.role_account"} <= failed


def test_same_domain_is_one_company_and_newer_address_wins(loaded):
    store, _ = loaded
    t = runs.view_tables(store)
    acme = lineage.find_entities(t, "acme.com", "company").collect()
    assert len(acme) == 1
    summary = {r["canonical_field"]: r["value"] for r in lineage.entity_summary(t, acme[0]["entity_id"]).collect()}
    assert summary["address_line1"] == "9 New Ave" and summary["employee_count"] == "130" and summary["city"] == "Boston"
    assert summary["website"] == "http://acme.com/about"  # the most reliable source's


def test_people_link_by_email_and_name_their_employer(loaded):
    store, _ = loaded
    t = runs.view_tables(store)
    jane = lineage.find_entities(t, "jane@acme.com", "person").collect()
    assert len(jane) == 1 and jane[0]["record_count"] == 2
    assert golden(store, "person", "full_name") >= {"Jane O'Brien", "Bob Ray"}
    works = metrics.who_works_where(t).collect()
    assert [(r["full_name"], r["website"]) for r in works] == [("Jane O'Brien", "http://acme.com/about")]
    rel = lineage.relationships(t, jane[0]["entity_id"]).collect()
    assert len(rel) == 1 and rel[0]["direction"] == "outgoing"
    # a function's mailbox links nobody, and people between jobs have no employer entity
    assert lineage.find_entities(t, "info@shared.org", "person").count() == 2


def test_checks_hold_and_gauges_count(loaded, spark):
    from pyspark.sql import functions as F

    store, _ = loaded
    t = runs.view_tables(store)
    for name, df in metrics.checks(t).items():
        assert df.isEmpty(), name
    g = {(r["name"], tuple(sorted(r["labels"].items()))): r["value"] for r in metrics.gauges(t, F.lit(T3)).collect()}
    assert g["raw_records", ()] == 10 and g["quarantine_items", (("status", "open"),)] == 1
    assert metrics.alerts(metrics.gauges(t, F.lit(datetime(2024, 6, 1, tzinfo=timezone.utc)))).count() >= 2


def test_explain_timeline_and_record_lineage(loaded):
    store, _ = loaded
    t = runs.view_tables(store)
    acme = lineage.find_entities(t, "acme.com", "company").first()["entity_id"]
    why = lineage.explain_value(t, acme, "address_line1")
    assert {r["raw_value"]: r["is_winning_record"] for r in why["contributions"].collect()} == {"1 Main St": False, "9 New Ave": True}
    assert why["history"].count() == 2
    events = [r["event"] for r in lineage.timeline(t, acme).collect()]
    assert {"record_ingested", "record_linked", "golden_value_set", "golden_value_superseded"} <= set(events)
    rec = t["record_entity_link"].where(f"entity_id = '{acme}'").first()["record_id"]
    assert lineage.record_lineage(t, rec)["record"].count() == 1


def test_same_file_again_is_refused_and_unchanged_values_keep_their_start(loaded):
    store, root = loaded
    with pytest.raises(runs.AlreadyIngested):
        runs.ingest(store, f"file://{root}/a.csv", "company", "vendor a")
    before = store.table("golden_attribute").where("valid_to IS NULL").select("golden_id", "valid_from").collect()
    counts = runs.build_golden(store, None, datetime(2024, 7, 1, tzinfo=timezone.utc))
    assert set(counts) == {"unchanged"}
    assert sorted(before) == sorted(store.table("golden_attribute").where("valid_to IS NULL").select("golden_id", "valid_from").collect())


def test_released_record_resolves_and_review_moves_are_guarded(loaded):
    store, _ = loaded
    record = store.table("quarantine_item").first()["record_id"]
    runs.review_quarantine(store, record, "release", "ann", "known vendor", T3)
    with pytest.raises(ValueError):
        runs.review_quarantine(store, record, "release", "ann", None, T3)
    batch = store.table("raw_record").where(f"record_id = '{record}'").first()["batch_id"]
    runs.resolve_batch(store, batch, T3)
    link = store.table("record_entity_link").where(f"record_id = '{record}'").collect()
    assert len(link) == 1 and link[0]["match_method"] == "no_identity_keys"


def test_purge_removes_a_source_only(loaded, spark):
    store, root = loaded
    copy = Store(spark, f"file://{root}/db2")
    copy.commit({n: df for n, df in store.tables().items()})
    runs.purge_sources(copy, ["people"])
    assert copy.table("raw_record").where("entity_type = 'person'").isEmpty()
    assert copy.table("entity_relationship").isEmpty()
    assert copy.table("raw_record").count() == 6
    for name, df in metrics.checks(runs.view_tables(copy)).items():
        assert df.isEmpty(), name


def test_stream_runs_announced_batches(spark, tmp_path):
    from goldweave.streaming import stages

    store = Store(spark, f"file://{tmp_path}/db")
    (tmp_path / "a.csv").write_text(COMPANIES_A)
    runs.ingest(store, f"file://{tmp_path}/a.csv", "company", "vendor a", at=T1)
    assert stages.announce(store, f"file://{tmp_path}/in", T1) == 1
    assert stages.announce(store, f"file://{tmp_path}/in", T1) == 0
    stages.publish(spark.createDataFrame([(stages.INGESTED, "nope", "{}", T1)], stages.EVENT), f"file://{tmp_path}/in")
    stages.start(store, f"file://{tmp_path}/in", f"file://{tmp_path}/out", f"file://{tmp_path}/cp").awaitTermination()
    out = {(r["topic"], r["key"]) for r in spark.read.schema(stages.EVENT).json(f"file://{tmp_path}/out").collect()}
    assert {t for t, _ in out} == {stages.DONE, stages.FAULTS}
    assert not store.table("golden_attribute").isEmpty()
