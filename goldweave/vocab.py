"""The canonical vocabulary, and the values that rules, keys and strategies use."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass
from functools import cache
from pathlib import Path

SCHEMA_VERSION, RULESET_VERSION = "3", "2"


@dataclass(frozen=True)
class Field:
    entity_type: str
    subject: str
    name: str
    value_type: str
    detector: str | None
    aliases: tuple[str, ...]
    ambiguous: tuple[str, ...]


def fold(name: str) -> str:
    """Column name for comparison: lower case, runs of other than a-z 0-9 as one underscore, none at the ends."""
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


@cache
def vocabulary(path: str | None = None) -> tuple[Field, ...]:
    """Fields in the order of the file (the packaged one by default)."""
    out = []
    for line in Path(path or Path(__file__).with_name("vocabulary.txt")).read_text().splitlines():
        if line and not line.startswith("#"):
            head, aliases, ambiguous = ([x.strip() for x in line.split(" :")] + ["", ""])[:3]
            entity, subject, name, kind, detector = head.split()
            split = lambda s: tuple(fold(x) for x in s.split(",") if x.strip())
            out.append(Field(entity, subject, name, kind, None if detector == "-" else detector, split(aliases), split(ambiguous)))
    return tuple(out)


def fields(entity_type: str) -> tuple[Field, ...]:
    return tuple(f for f in vocabulary() if f.entity_type == entity_type)


def field_by_name(entity_type: str, name: str, subject: str = "self") -> Field | None:
    return next((f for f in fields(entity_type) if f.name == name and f.subject == subject), None)


def column_fingerprint(columns: list[str]) -> str:
    """Identity of a layout: SHA-256 of the compact JSON of its ordered column names."""
    return hashlib.sha256(json.dumps(columns, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


# --- Fixed values ---

NULL_TOKENS = ("", "null", "n/a", "n\\a", "none", "nil", "-", "--", "---", "\\n", "(null)", "not available", "unknown")
SPLITTABLE_TYPES = ("email", "phone", "url")

AUTO_ACCEPT, REVIEW = 0.90, 0.60
VALUE_CAP, VALUE_MIN_RATIO, CORROBORATION, AMBIGUOUS = 0.75, 0.60, 0.15, 0.85
MAX_ALTERNATIVES, SAMPLE_SIZE = 3, 200
METHOD_RANK = {"exact_alias": 3, "corroborated": 2, "ambiguous_alias": 1, "similarity": 1, "value_analysis": 0}
DETECTOR_SPECIFICITY = {"linkedin": 2, "email": 2, "url": 1}

ROLE_LOCAL_PARTS = ("info", "admin", "support", "sales", "contact", "webmaster", "office", "hello", "help", "mail", "enquiries", "inquiries", "hr", "careers", "jobs", "billing", "accounts", "noreply", "no-reply", "donotreply", "postmaster", "marketing", "press", "media", "team", "general")
CONSUMER_DOMAINS = ("gmail.com", "googlemail.com", "yahoo.com", "yahoo.co.uk", "hotmail.com", "outlook.com", "live.com", "msn.com", "aol.com", "icloud.com", "me.com", "mail.com", "gmx.com", "yandex.com", "protonmail.com", "proton.me", "rediffmail.com", "qq.com", "163.com")
PHONE_SEQUENCES = ("0123456789", "1234567890", "9876543210")
PLACEHOLDER_NAMES = ("test", "tests", "testing", "asdf", "qwerty", "xxx", "xxxx", "abc", "aaa", "sample", "dummy", "example", "tbd", "todo", "no name", "noname", "name", "first last", "john doe", "jane doe", "firstname lastname", "n a")
BARE_TITLES = ("mr", "mrs", "ms", "miss", "dr", "prof", "sir", "madam", "mx")
PLACEHOLDER_ADDRESSES = ("same as above", "see above", "as above", "same", "address", "street", "no address", "not provided", "not given", "tbd", "todo", "xxx", "n a", "undisclosed", "confidential", "withheld", "na na")
MAX_EMPLOYEES, MIN_FOUNDED_YEAR = 5_000_000, 1600
MIN_COVERAGE = 0.5
IDENTIFYING = {"person": ("email", "linkedin_url", "person_external_id", "full_name"), "company": ("company_name", "legal_name", "website", "company_external_id", "email")}
NAME_PARTS = ("first_name", "last_name")
CORE = {"person": ("full_name", "email"), "company": ("company_name",)}
EXPECTED = {"person": ("phone", "job_title", "company_name", "city", "country"), "company": ("website", "phone", "address_line1", "city", "country", "industry")}

KEY_WEIGHTS = {
    "person": {"external_id": "0.98", "linkedin": "0.95", "email": "0.95", "name_company": "0.80", "name_city": "0.70", "phone": "0.40"},
    "company": {"external_id": "0.98", "website_domain": "0.92", "email": "0.90", "name_city": "0.80", "name": "0.65", "phone": "0.45"},
}
STRONG_KEYS = {"person": ("external_id", "linkedin", "email"), "company": ("external_id", "website_domain", "email")}
LOCATION_DEMOTED = ("website_domain", "email")
AUTO_LINK, MATCH_REVIEW, KEY_BOOST, MAX_MATCH, WEAK_CAP = "0.90", "0.60", "0.04", "0.99", "0.89"
CORROBORATING = ("website", "linkedin_url", "company_external_id", "phone", "address_line1")
NON_EMPLOYERS = ("self employed", "selfemployed", "self-employed", "freelance", "freelancer", "unemployed", "retired", "none", "n/a", "na", "student", "independent", "self", "private", "not applicable", "unknown")

MOST_RECENT, MOST_FREQUENT, EARLIEST, MOST_RELIABLE = "most_recent", "most_frequent", "earliest", "most_reliable_source"
FIELD_STRATEGY = {
    **{("person", f): MOST_RECENT for f in ("job_title", "department", "company_name", "address_line1", "address_line2", "city", "state_region", "postal_code", "email_status")},
    **{("company", f): MOST_RECENT for f in ("employee_count", "address_line1", "address_line2", "city", "state_region", "postal_code", "phone")},
    **{("person", f): MOST_FREQUENT for f in ("full_name", "first_name", "last_name")},
    **{("company", f): MOST_FREQUENT for f in ("company_name", "legal_name", "sic_code", "sic_description", "naics_code")},
    ("company", "founded_year"): EARLIEST,
}
AGREEMENT_BONUS, DISAGREEMENT_PENALTY, MIN_CONFIDENCE, MAX_CONFIDENCE = "0.15", "0.10", "0.05", "0.99"

#: Columns of the flat views, in order.
PERSON_PIVOT = ("full_name", "first_name", "last_name", "email", "phone", "job_title", "company_name", "linkedin_url", "city", "state_region", "country")
COMPANY_PIVOT = ("company_name", "legal_name", "website", "email", "phone", "address_line1", "city", "state_region", "postal_code", "country", "industry", "sic_description", "employee_count", "founded_year", "linkedin_url")
