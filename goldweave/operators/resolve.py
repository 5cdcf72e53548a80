"""Entity resolution: records to entities, as if records were taken one by one in their order.

A record's outcome depends only on earlier records that share its keys, and only a key that is strong on both sides can
link. So (A) records are grouped by components over strong keys, and each component is walked in order: a sorted scan
that holds the component's keys, not its rows; (B) what moderate keys add, candidates for review, is a join of keys
with the condition that the entity had the key before the record came."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import text
from ..scratch import written
from .graph import components

STRONG, MODERATE = "strong", "moderate"
KEY = "struct<key_type:string,key_value:string,strength:string>"
#: Scores are whole thousandths, so that equal scores are equal.
WEIGHT = {e: {k: int(float(w) * 1000 + 0.5) for k, w in ws.items()} for e, ws in vocab.KEY_WEIGHTS.items()}
LINK, REVIEW, BOOST, MOST, WEAK = (int(float(x) * 1000 + 0.5) for x in (vocab.AUTO_LINK, vocab.MATCH_REVIEW, vocab.KEY_BOOST, vocab.MAX_MATCH, vocab.WEAK_CAP))


# --- keys ---


def record_values(obs: DataFrame) -> DataFrame:
    """One row for each record and subject: values, a map of field to its values in cell order. obs: confirmed ones."""
    per_field = obs.groupBy("record_id", "batch_id", "source_id", "entity_type", "subject", "canonical_field").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("source_column", "value_index", "normalized_value"))), lambda x: x["normalized_value"]).alias("v")  # the cells of one record
    )
    return per_field.groupBy("record_id", "batch_id", "source_id", "entity_type", "subject").agg(F.map_from_entries(F.collect_list(F.struct("canonical_field", "v"))).alias("values"))


def _all(field: str) -> Column:
    return F.coalesce(F.element_at("values", field), F.array().cast("array<string>"))


def _first(field: str) -> Column:
    return F.get(F.filter(_all(field), lambda x: x != ""), 0)


def _keys(kind: str, strength: Column | str, values: Column) -> Column:
    s = F.lit(strength) if isinstance(strength, str) else strength
    made = F.transform(F.filter(values, lambda v: v.isNotNull()), lambda v: F.struct(F.lit(kind).alias("key_type"), v.alias("key_value"), s.alias("strength")))
    return F.coalesce(made, F.array().cast(f"array<{KEY}>"))


def _one(kind: str, strength: str, value: Column) -> Column:
    return _keys(kind, strength, F.array(value))


def _deduped(keys: Column) -> Column:
    """The first key of each type and value."""
    name = lambda k: F.concat(k["key_type"], F.lit("\u001f"), k["key_value"])
    names = F.transform(keys, name)
    return F.filter(keys, lambda k, i: F.array_position(names, name(k)) == i + 1)


def person_keys(role_email: Column) -> Column:
    """Keys of a person from its values; an email that is a function's mailbox is only moderate."""
    name = F.coalesce(_first("full_name"), F.when(_first("first_name").isNotNull() & _first("last_name").isNotNull(), F.concat_ws(" ", _first("first_name"), _first("last_name"))))
    return _deduped(F.concat(
        _one("external_id", STRONG, F.concat(F.col("source_id"), F.lit(":"), _first("person_external_id"))),
        _keys("linkedin", STRONG, F.transform(_all("linkedin_url"), text.linkedin_handle)),
        _keys("email", F.when(role_email, MODERATE).otherwise(STRONG), _all("email")),
        _one("name_company", MODERATE, F.concat(name, F.lit("|"), _first("company_name"))),
        _one("name_city", MODERATE, F.concat(name, F.lit("|"), _first("city"))),
        _keys("phone", MODERATE, _all("phone")),
    ))


def company_keys(location: Column) -> Column:
    """Keys of a company; sources that describe locations share domains and mailboxes, so those are moderate there."""
    name = F.coalesce(_first("company_name"), _first("legal_name"))
    shared = F.when(location, MODERATE).otherwise(STRONG)
    return _deduped(F.concat(
        _one("external_id", STRONG, F.concat(F.col("source_id"), F.lit(":"), _first("company_external_id"))),
        _keys("website_domain", shared, F.transform(_all("website"), text.website_domain)),
        _keys("email", shared, _all("email")),
        _one("name", MODERATE, name),
        _one("name_city", MODERATE, F.concat(name, F.lit("|"), _first("city"))),
        _keys("phone", MODERATE, _all("phone")),
    ))


def employer_name() -> Column:
    """The first company name that is no placeholder for not having an employer."""
    return F.get(F.filter(_all("company_name"), lambda x: (x != "") & text.real_employer(x)), 0)


def employer_known() -> Column:
    """Whether the row says enough about the employer to make it an entity."""
    return F.size(F.concat(*[_all(f) for f in vocab.CORROBORATING])) > 0


def units(values: DataFrame, order: DataFrame, source: DataFrame, role_emails: DataFrame) -> DataFrame:
    """What is to be resolved: record_id, role, entity_type, batch_id, source_id, seq, keys, employer.

    order: record_id, seq (a total order of records). role_emails: record_ids whose email is a function's mailbox.
    An employer unit exists where a person row names a real employer and something identifies it."""
    base = values.join(order, "record_id").join(F.broadcast(source.select("source_id", "describes")), "source_id", "left").join(role_emails.select("record_id", F.lit(True).alias("role_email")), "record_id", "left")
    own = base.where("subject = 'self'")
    # the employer's name is also part of a person's keys
    named = base.where("subject = 'employer'").select("record_id", F.element_at("values", "company_name").alias("employer_names"))
    people = own.where("entity_type = 'person'").join(named, "record_id", "left")
    with_employer = F.when(F.col("employer_names").isNotNull() & ~F.map_contains_key("values", F.lit("company_name")), F.map_concat("values", F.create_map(F.lit("company_name"), F.col("employer_names")))).otherwise(F.col("values"))
    person = people.withColumn("values", with_employer).select("record_id", F.lit("self").alias("role"), "entity_type", "batch_id", "source_id", (F.col("seq") * 2).alias("seq"), person_keys(F.coalesce("role_email", F.lit(False))).alias("keys"), F.lit(None).cast("string").alias("employer"))
    company = own.where("entity_type = 'company'").select("record_id", F.lit("self").alias("role"), "entity_type", "batch_id", "source_id", (F.col("seq") * 2).alias("seq"), company_keys(F.coalesce(F.col("describes") == "location", F.lit(False))).alias("keys"), F.lit(None).cast("string").alias("employer"))
    employer = (
        base.where("entity_type = 'person' AND subject = 'employer'")
        .select("record_id", F.lit("employer").alias("role"), F.lit("company").alias("entity_type"), "batch_id", "source_id", (F.col("seq") * 2 + 1).alias("seq"), company_keys(F.lit(False)).alias("keys"), F.when(employer_known(), employer_name()).alias("employer"))
        .where("employer IS NOT NULL AND size(keys) > 0")
    )
    return person.unionByName(company).unionByName(employer)


# --- scores ---


def score(entity_type: str, matched: dict[str, bool]) -> tuple[int, str] | None:
    """(thousandths, key type of the best key) for the key types shared; the flag: strong on both sides."""
    if not matched:
        return None
    weight = WEIGHT[entity_type]
    best = min(matched, key=lambda k: (-weight.get(k, 0), not matched[k], k))
    total = weight.get(best, 0) + BOOST * (len(matched) - 1)
    return min(total if matched[best] else min(total, WEAK), MOST), best


def score_column(entity_type: Column, types: Column) -> Column:
    """The same over an array of struct(weight, strong, key_type): struct(score, method). types: distinct, not empty."""
    ranked = F.array_sort(F.transform(types, lambda t: F.struct((-t["weight"]).alias("w"), (~t["strong"]).alias("weak"), t["key_type"].alias("k"))))
    total = -ranked[0]["w"] + BOOST * (F.size(ranked) - 1)
    return F.struct(F.least(F.when(ranked[0]["weak"], F.least(total, F.lit(WEAK))).otherwise(total), F.lit(MOST)).alias("score"), ranked[0]["k"].alias("method"))


def decide(entity_type: str, candidates: dict[str, dict[str, bool]]) -> tuple[str, str | None, int, str]:
    """(link, review or new; entity; thousandths; method) for the candidates' shared keys, in order of appearance."""
    scored = [(s, e) for e, m in candidates.items() if (s := score(entity_type, m))]
    if not scored:
        return "new", None, 0, "no_match"
    (top, method), entity = max(scored, key=lambda x: x[0][0])
    if top >= LINK:
        tie = sum(s[0] == top for s, _ in scored) > 1
        return ("review" if tie else "link"), entity, top, method
    return ("review" if top >= REVIEW else "new"), entity, top, method


# --- phase A: links ---

WALKED = "record_id string, role string, entity_type string, batch_id string, source_id string, seq long, entity_id string, decision string, match_method string, match_score int, candidate_entity_id string, new_keys array<struct<key_type:string,key_value:string,strength:string>>"


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by entity type, component and seq; what is held is the keys of one component's entities."""
    at = None
    holders: dict[tuple[str, str], dict[str, bool]] = {}
    for b in batches:
        out = []
        for r in b.itertuples(index=False):
            if (r.entity_type, r.component) != at:
                at, holders = (r.entity_type, r.component), {}
            keys = [(k["key_type"], k["key_value"], k["strength"] == STRONG) for k in r.keys]
            if r.known_entity is not None:  # an entity of earlier runs with its keys
                for kind, value, strong in keys:
                    holders.setdefault((kind, value), {}).setdefault(r.known_entity, strong)
                continue
            found: dict[str, dict[str, bool]] = {}
            for kind, value, strong in keys:
                for entity, stored in holders.get((kind, value), {}).items():
                    m = found.setdefault(entity, {})
                    m[kind] = m.get(kind, False) or (stored and strong)
            decision, entity, total, method = decide(r.entity_type, found)
            mine = entity if decision == "link" else r.new_entity
            new = []
            for kind, value, strong in keys:
                held = holders.setdefault((kind, value), {})
                if mine not in held:
                    held[mine] = strong
                    new.append({"key_type": kind, "key_value": value, "strength": STRONG if strong else MODERATE})
            if not keys:
                method = "no_identity_keys"
            out.append((r.record_id, r.role, r.entity_type, r.batch_id, r.source_id, r.seq, mine, decision, method, total, entity if decision == "review" else None, new))
        yield pd.DataFrame(out, columns=[x.split()[0] for x in WALKED.split(", ")[:11]] + ["new_keys"])


def links(todo: DataFrame, stored: DataFrame) -> DataFrame:
    """Phase A. todo: units(); stored: entity_id, entity_type, key_type, key_value, strength of active entities.

    A row for each unit: its entity, how it came to it, and the keys that the entity gained."""
    node = lambda *p: text.stable_id("node", *p)
    new = todo.withColumn("new_entity", text.stable_id("entity", F.col("entity_type"), F.col("record_id"), F.col("role"))).withColumn("unit", node(F.col("new_entity")))
    strong = new.select("unit", "entity_type", F.explode("keys").alias("k")).where(F.col("k.strength") == STRONG).select("unit", node(F.lit("key"), F.col("entity_type"), F.col("k.key_type"), F.col("k.key_value")).alias("key"))
    old = stored.withColumn("unit", node(F.col("entity_id")))
    held = old.where(F.col("strength") == STRONG).select("unit", node(F.lit("key"), F.col("entity_type"), F.col("key_type"), F.col("key_value")).alias("key"))
    # only stored entities that a new unit can meet, through strong keys or further ones, need a part in the walk
    comp = components(strong.union(held.join(strong.select("key").distinct(), "key", "left_semi").select("unit", "key")), "unit", "key")
    at = comp.select(F.col("node").alias("unit"), "component")
    rows = new.join(at, "unit", "left").select(
        F.coalesce("component", "unit").alias("component"), "entity_type", "record_id", "role", "batch_id", "source_id", "seq", "keys", "new_entity", F.lit(None).cast("string").alias("known_entity")
    )
    known = (
        old.join(at, "unit").groupBy("component", "entity_type", "entity_id").agg(F.collect_list(F.struct("key_type", "key_value", "strength")).alias("keys"))
        .select("component", "entity_type", F.lit(None).cast("string").alias("record_id"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("batch_id"), F.lit(None).cast("string").alias("source_id"), F.lit(-1).cast("long").alias("seq"), "keys", F.lit(None).cast("string").alias("new_entity"), F.col("entity_id").alias("known_entity"))
    )
    ordered = rows.unionByName(known).repartition("entity_type", "component").sortWithinPartitions("entity_type", "component", "seq", "known_entity", "role")
    return written(ordered.mapInPandas(_walk, WALKED))


# --- phase B: candidates that moderate keys bring ---


def _weights(spark) -> DataFrame:
    return spark.createDataFrame([(e, k, w) for e, ws in WEIGHT.items() for k, w in ws.items()], "entity_type string, key_type string, weight int")


def candidates(todo: DataFrame, linked: DataFrame, stored: DataFrame) -> DataFrame:
    """Units that were not linked, with their best earlier entity: record_id, role, entity_type, entity_id, method,
    score, decision (review at 0.60 or more, else new).

    Keys that could reach a review alone make the pairs; lighter ones (phone) are looked up for these pairs only, and
    without pairs only whether some earlier entity has them, so a filler number shared by many makes no pairs."""
    weights = F.broadcast(_weights(todo.sparkSession))
    gained = linked.select("entity_id", "entity_type", F.explode("new_keys").alias("k"), F.col("seq").alias("added")).select("entity_id", "entity_type", "k.*", "added")
    have = gained.unionByName(stored.select("entity_id", "entity_type", "key_type", "key_value", "strength", F.lit(-1).cast("long").alias("added"))).join(weights, ["entity_type", "key_type"])
    open_units = linked.where("decision <> 'link'").select("record_id", "role", F.col("entity_id").alias("own"))
    want = todo.join(open_units, ["record_id", "role"]).select("record_id", "role", "own", "entity_type", "seq", F.explode("keys").alias("k")).select("record_id", "role", "own", "entity_type", "seq", "k.key_type", "k.key_value", F.col("k.strength").alias("built"))
    on = ["entity_type", "key_type", "key_value"]
    heavy = have.where(F.col("weight") >= REVIEW)
    met = want.join(heavy, on).where((F.col("added") < F.col("seq")) & (F.col("entity_id") != F.col("own")))
    pairs = met.select("record_id", "role", "entity_type", "entity_id", "seq").distinct()
    light = have.where(F.col("weight") < REVIEW)
    wanted_light = want.join(pairs.select("record_id", "role", "entity_id"), ["record_id", "role"])
    also = wanted_light.join(light, [*on, "entity_id"]).where(F.col("added") < F.col("seq"))
    cols = ["record_id", "role", "entity_type", "entity_id", "key_type", "weight", "built", "strength"]
    shared = met.select(*cols).union(also.select(*cols))
    types = shared.groupBy("record_id", "role", "entity_type", "entity_id", "key_type", "weight").agg(F.max((F.col("built") == STRONG) & (F.col("strength") == STRONG)).alias("strong"))
    scored = types.groupBy("record_id", "role", "entity_type", "entity_id").agg(F.collect_list(F.struct("weight", "strong", "key_type")).alias("types")).withColumn("s", score_column(F.col("entity_type"), F.col("types")))
    best = scored.groupBy("record_id", "role", "entity_type").agg(F.min(F.struct((-F.col("s.score")).alias("n"), "entity_id", F.col("s.method").alias("method"))).alias("b"))
    # units with light keys only: the earliest other holder of each key stands for all
    first = light.groupBy(*on, "weight").agg(F.min(F.struct("added", "entity_id")).alias("f"))
    alone = (
        want.join(best.select("record_id", "role"), ["record_id", "role"], "left_anti").join(first, on).where((F.col("f.added") < F.col("seq")) & (F.col("f.entity_id") != F.col("own")))
        .groupBy("record_id", "role", "entity_type").agg(F.min(F.struct((-F.col("weight")).alias("n"), F.col("f.entity_id").alias("entity_id"), F.col("key_type").alias("method"))).alias("b"))
    )
    return best.unionByName(alone).select("record_id", "role", "entity_type", "b.entity_id", "b.method", (-F.col("b.n")).cast("int").alias("score"), F.when(F.col("b.n") <= -REVIEW, "review").otherwise("new").alias("decision"))


# --- results ---


def resolve(todo: DataFrame, stored: DataFrame) -> dict[str, DataFrame]:
    """links, entities, keys, candidates, relationships that the units add to what is stored."""
    walked = links(todo, stored)
    better = candidates(todo, walked, stored).withColumnsRenamed({"entity_id": "b_entity", "method": "b_method", "score": "b_score", "decision": "b_decision"}).drop("entity_type")
    both = walked.join(better, ["record_id", "role"], "left")
    use_b = (F.col("decision") != "link") & (F.coalesce("b_score", F.lit(-1)) > F.col("match_score"))
    final = written(both.withColumns({
        "match_method": F.when(use_b, F.col("b_method")).otherwise(F.col("match_method")),
        "score": F.when(use_b, F.col("b_score")).otherwise(F.col("match_score")),
        "outcome": F.when(use_b, F.col("b_decision")).otherwise(F.col("decision")),
        "candidate": F.when(use_b, F.when(F.col("b_decision") == "review", F.col("b_entity"))).otherwise(F.col("candidate_entity_id")),
    }))
    confidence = (F.col("score") / 1000).cast("decimal(4,3)")
    link = final.select(
        text.stable_id("link", F.col("record_id"), F.col("role")).alias("link_id"), "record_id", "entity_id", "entity_type", "batch_id", "source_id", "match_method", confidence.alias("match_confidence"),
        F.when(F.col("outcome") == "link", "auto_linked").otherwise("new_entity").alias("match_status"), "role",
    )
    entities = final.where("outcome <> 'link'").select("entity_id", "entity_type", F.lit("active").alias("status"), F.lit(None).cast("string").alias("merged_into_entity_id"), F.col("record_id").alias("first_seen_record_id"))
    keys = final.select("entity_id", "entity_type", F.explode("new_keys").alias("k"), "record_id", "seq").select(text.stable_id("key", F.col("entity_id"), F.col("k.key_type"), F.col("k.key_value")).alias("key_id"), "entity_id", "entity_type", "k.*", F.col("record_id").alias("source_record_id"), "seq")
    cand = final.where("candidate IS NOT NULL").select(text.stable_id("candidate", F.col("record_id"), F.col("candidate")).alias("candidate_id"), "record_id", F.col("candidate").alias("entity_id"), "entity_type", "match_method", confidence.alias("match_confidence"), F.lit("open").alias("status"))
    person = final.where("role = 'self' AND entity_type = 'person'").select("record_id", F.col("entity_id").alias("from_entity_id"), "batch_id", "source_id")
    employer = final.where("role = 'employer'").select("record_id", F.col("entity_id").alias("to_entity_id"))
    relation = (
        person.join(employer, "record_id").where("from_entity_id <> to_entity_id")
        .groupBy("from_entity_id", "to_entity_id").agg(F.min(F.struct("record_id", "batch_id", "source_id")).alias("r"))
        .select(text.stable_id("relationship", F.col("from_entity_id"), F.col("to_entity_id"), F.lit("employed_at")).alias("relationship_id"), "from_entity_id", "to_entity_id", F.lit("employed_at").alias("relationship_type"), "r.*")
    )
    return {"links": link, "entities": entities, "keys": keys, "candidates": cand, "relationships": relation}


def resolution_counts(link: DataFrame, cand: DataFrame) -> DataFrame:
    """One row: linked, new, manual records, open candidates."""
    own = link.where("role = 'self'").select(F.col("match_status").alias("s"))
    both = own.union(cand.where("status = 'open'").select(F.lit("candidate")))
    return both.agg(*[F.count_if(F.col("s") == s).alias(n) for s, n in (("auto_linked", "linked"), ("new_entity", "new"), ("manual", "manual"), ("candidate", "candidates"))])
