"""Small cases of single operators."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from goldweave import vocab
from goldweave.functions import text
from goldweave.operators import graph, mapping, merge, quarantine, resolve
from goldweave.sources import files


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


@pytest.mark.parametrize(("value", "want"), [("JANE o'brien", "Jane O'Brien"), ("mcdonald", "McDonald"), ("MACARTHUR-SMITH", "MacArthur-Smith"), ("van der Berg", "Van Der Berg"), ("DeVito", "DeVito"), ("  a   b ", "A B")])
def test_person_name(spark, value, want):
    assert one(spark, text.person_name(F.lit(value))) == want


@pytest.mark.parametrize(("value", "want"), [("HTTPS://WWW.X.com/Path/", "https://www.x.com/Path"), ("X.COM", "x.com"), ("http://a.b//", "http://a.b")])
def test_url(spark, value, want):
    assert one(spark, text.url(F.lit(value))) == want


@pytest.mark.parametrize(("value", "want"), [("https://u:p@www2.Acme.com:80/x?y", "acme.com"), ("localhost", None), ("acme.co.uk#a", "acme.co.uk")])
def test_website_domain(spark, value, want):
    assert one(spark, text.website_domain(F.lit(value))) == want


def test_split_values(spark):
    got = [one(spark, text.split_values(F.lit(v), F.lit(t))) for v, t in (("a; b|c", "email"), ("a; b", "text"), ("a^^ b", "text"), ("^^", "text"), (" ; ", "phone"))]
    assert got == [["a", "b", "c"], ["a; b"], ["a", "b"], ["^^"], [";"]]


def test_normalized_outcomes(spark):
    got = [tuple(one(spark, text.normalized(F.lit(v).cast("string"), F.lit(t)))) for v, t in ((" N/A ", "email"), ("abc", "phone"), ("50-100", "integer"), ("0000", "integer"), (None, "text"), ("na", "text"))]
    assert got == [(None, "email:null_token", True), (None, "phone:empty", False), ("50100", "integer", False), ("0", "integer", False), (None, "text:null_token", True), ("na", "text", False)]


def test_vocabulary():
    n = {}
    for f in vocab.vocabulary():
        n[f.entity_type, f.subject] = n.get((f.entity_type, f.subject), 0) + 1
    assert n == {("person", "self"): 28, ("person", "employer"): 13, ("company", "self"): 24}


def test_mapping_collisions_and_evidence():
    found = {m.source_column: m for m in mapping.map_columns(["full_name", "email", "e_mail", "reachable_at"], "person", {"email": {"email": 1.0}, "e_mail": {"email": 1.0}, "reachable_at": {"phone": 1.0}})}
    assert found["full_name"].status == "auto_accepted"
    assert found["email"].status == found["e_mail"].status == "needs_review"
    assert found["reachable_at"].canonical_field is None or found["reachable_at"].method == "similarity"
    held = {m.source_column: m for m in mapping.map_columns(["email", "emial"], "person", {"emial": {"email": 1.0}})}
    assert held["email"].status == "auto_accepted" and held["emial"].canonical_field is None


def test_employer_fields_need_qualified_names():
    assert mapping.map_column("city", "person", {}).subject == "self"
    assert (m := mapping.map_column("company_city", "person", {})).subject == "employer" and m.canonical_field == "city"


def test_disambiguate():
    assert files.disambiguate(["a", " a ", "", None, "b"]) == ["a", "a__2", "unnamed", "unnamed__2", "b"]


def test_csv_is_read_verbatim(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("﻿name,notes,notes\n\" a \",\"x, \"\"y\"\"\",00501\n,,\n9.99E10,\"two\nlines\",é\n".encode())
    columns, rows = files.read_file(spark, f"file://{tmp_path}/x.csv")
    assert columns == ["name", "notes", "notes__2"]
    got = [(r["row_number"], r["raw_payload"]) for r in rows.orderBy("row_number").collect()]
    assert got == [(1, {"name": " a ", "notes": 'x, "y"', "notes__2": "00501"}), (2, {"name": "9.99E10", "notes": "two\nlines", "notes__2": "é"})]
    (tmp_path / "e.csv").write_text("a,b\n")
    assert files.read_file(spark, f"file://{tmp_path}/e.csv")[1].isEmpty()
    with pytest.raises(files.UnsupportedFileType):
        files.read_file(spark, f"file://{tmp_path}/e.pdf")


def test_scores():
    assert resolve.score("person", {"email": True, "phone": False}) == (990, "email")
    assert resolve.score("person", {"name_company": False, "name_city": False, "phone": False}) == (880, "name_company")
    assert resolve.score("company", {"website_domain": False, "name": False, "phone": False}) == (890, "website_domain")
    assert resolve.decide("company", {"a": {"website_domain": True}, "b": {"website_domain": True}})[0] == "review"
    assert resolve.decide("company", {"a": {"name": False}})[0] == "review"
    assert resolve.decide("company", {"a": {"phone": False}})[0] == "new"


@pytest.mark.parametrize("seed", range(3))
def test_resolution_equals_one_record_at_a_time(spark, seed):
    """Phase A and B together against the plain procedure."""
    rng = random.Random(seed)
    kinds = [("website_domain", 4, "strong"), ("email", 5, "strong"), ("name", 3, "moderate"), ("phone", 4, "moderate")]
    rows = []
    for i in range(60):
        keys = [(k, f"{k}{rng.randrange(n * 4)}", s if rng.random() < 0.8 else "moderate") for k, n, s in kinds if rng.random() < 0.5]
        rows.append((f"r{i:03}", "self", "company", "b", "s", i, keys, None))
    schema = f"record_id string, role string, entity_type string, batch_id string, source_id string, seq long, keys array<{resolve.KEY}>, employer string"
    none = spark.createDataFrame([], "entity_id string, entity_type string, key_type string, key_value string, strength string")
    out = resolve.resolve(spark.createDataFrame(rows, schema), none)
    first = {r["entity_id"]: r["first_seen_record_id"] for r in out["entities"].collect()}
    got = {r["record_id"]: (first[r["entity_id"]], r["match_status"], r["match_confidence"]) for r in out["links"].collect()}
    held, want = {}, {}
    for rec, *_, keys, _ in rows:
        met = {}
        for k, v, s in keys:
            for e, strong in held.get((k, v), {}).items():
                met.setdefault(e, {})[k] = met.get(e, {}).get(k, False) or (strong and s == "strong")
        decision, entity, total, _ = resolve.decide("company", met)
        mine = entity if decision == "link" else rec
        want[rec] = (mine, "auto_linked" if decision == "link" else "new_entity", Decimal(total) / 1000)
        for k, v, s in keys:
            held.setdefault((k, v), {}).setdefault(mine, s == "strong")
    assert got == want


def test_components_and_tombstones(spark, monkeypatch):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(80)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    want = {x: find(x) for e in edges for x in e if e[0] != e[1]}
    for few in (graph.FEW, 0):  # in one task, and in distributed rounds
        monkeypatch.setattr(graph, "FEW", few)
        got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == want
    chain = spark.createDataFrame([(str(i), str(i - 1) if i else None) for i in range(17)], "entity_id string, merged_into_entity_id string")
    assert {r["survivor_id"] for r in merge.survivors(chain).collect()} == {"0"}
    with pytest.raises(ValueError):
        merge.survivors(spark.createDataFrame([("a", "b"), ("b", "a")], "entity_id string, merged_into_entity_id string"))


def test_review_guards():
    assert quarantine.reviewed_status("reopen", "rejected") == "open"
    for verb, status in (("release", "released"), ("release", "resolved"), ("reject", "resolved"), ("reopen", "open")):
        with pytest.raises(ValueError):
            quarantine.reviewed_status(verb, status)


def test_file_facts_are_of_the_content(spark, tmp_path):
    import hashlib

    body = bytes(range(256)) * 5000
    (tmp_path / "a b.csv").write_bytes(body)
    assert files.file_facts(spark, f"file://{tmp_path}/a b.csv") == (hashlib.sha256(body).hexdigest(), len(body))


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from goldweave import scratch

    conf = SimpleNamespace(get=lambda *_: None)
    context = SimpleNamespace(applicationId="not local", master="spark://host:7077", getConf=lambda: conf)
    with pytest.raises(RuntimeError):
        scratch.shared_dir(SimpleNamespace(sparkContext=context, conf=conf))


def test_many_batches_are_not_broadcast(spark):
    from goldweave.operators import lineage

    def hints(batches):
        one = spark.range(1)
        t = {
            "attribute_observation": one.selectExpr("id AS record_id", "'self' AS subject", "0 AS source_id", "id AS batch_id", "'c' AS source_column", "'x' AS canonical_field", "'' AS raw_value", "'' AS normalized_value", "id AS observation_id"),
            "record_entity_link": one.selectExpr("id AS record_id", "'self' AS role", "'e' AS entity_id"), "raw_record": one.selectExpr("id AS record_id", "1 AS row_number", "'' AS source_record_id"),
            "batch": spark.range(batches).selectExpr("id AS batch_id", "'f' AS file_name", "'s' AS source_schema_id"), "source": one.selectExpr("0 AS source_id", "'v' AS source_name", "1 AS reliability"),
            "record_validation": one.selectExpr("id AS record_id", "'valid' AS status"), "column_mapping": one.selectExpr("'s' AS source_schema_id", "'c' AS source_column", "'m' AS mapping_method", "1 AS mapping_confidence"),
        }
        out = lineage.contributions(t)
        assert out.count() == 1
        return out._jdf.queryExecution().analyzed().toString().count("strategy=broadcast")

    assert (hints(10), hints(100_001)) == (3, 2)
