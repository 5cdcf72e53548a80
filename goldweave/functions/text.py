"""Column expressions over single values: normalizers, shape detectors, key parts, ids. All stay in generated code."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab

# --- blanks ---


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Runs of Unicode white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def is_null_token(c: Column) -> Column:
    return F.lower(strip(c)).isin(*vocab.NULL_TOKENS)


def split_values(raw: Column, value_type: Column) -> Column:
    """Array of the values in a cell: ^^ splits any type; ; and | split emails, phones and URLs. Never empty."""
    cut = F.when(value_type.isin(*vocab.SPLITTABLE_TYPES), F.split(raw, r"\^\^|[;|]")).otherwise(F.split(raw, r"\^\^"))
    found = F.filter(F.transform(cut, strip), lambda x: x != "")
    return F.when(F.size(found) > 0, found).otherwise(F.array(strip(raw)))


# --- normalizers ---


def _capital(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1_000_000)))


def _name_part(p: Column) -> Column:
    def prefixed(n: int, head: str) -> Column:
        return F.concat(F.lit(head), _capital(F.substring(p, n + 1, 1_000_000)))

    low = F.lower(p)
    return (
        F.when(low.startswith("mc") & (F.length(p) > 2), prefixed(2, "Mc"))
        .when(low.startswith("mac") & (F.length(p) > 3), prefixed(3, "Mac"))
        .otherwise(_capital(p))
    )


def _joined(token: Column, sign: str) -> Column:
    return F.array_join(F.transform(F.split(token, rf"\{sign}"), _name_part), sign)


def smart_title(token: Column) -> Column:
    """One token re-cased; its parts are those at the first of - ' . that it has."""
    return F.when(token.contains("-"), _joined(token, "-")).when(token.contains("'"), _joined(token, "'")).when(token.contains("."), _joined(token, ".")).otherwise(_name_part(token))


def person_name(c: Column) -> Column:
    """Tokens that are all upper or all lower case are re-cased; mixed case is the owner's choice and stays."""
    cased = lambda t: F.when(((t == F.upper(t)) | (t == F.lower(t))) & (F.upper(t) != F.lower(t)), smart_title(t)).otherwise(t)
    return F.array_join(F.transform(F.split(collapse(c), " "), cased), " ")


def email(c: Column) -> Column:
    return F.lower(collapse(c))


def phone(c: Column) -> Column:
    """Digits, after a + if that comes before the first digit; without either, empty is left to the dispatcher."""
    return F.concat(F.when(F.regexp_replace(c, "[^0-9+]", "").startswith("+"), "+").otherwise(""), digits(c))


def postal_code(c: Column) -> Column:
    return F.upper(collapse(c))


def url(c: Column) -> Column:
    """Without trailing slashes; all up to the first slash after the scheme in lower case, the rest as written."""
    v = F.regexp_replace(collapse(c), "/+$", "")
    scheme = F.regexp_extract(v, r"^([A-Za-z][A-Za-z0-9+.-]*://)", 1)
    rest = F.substring(v, F.length(scheme) + 1, F.length(v))
    host = F.regexp_extract(rest, r"^([^/]*)", 1)
    return F.concat(F.lower(scheme), F.lower(host), F.substring(rest, F.length(host) + 1, F.length(v)))


def integer(c: Column) -> Column:
    d = digits(c)
    return F.when(d == "", F.lit(None).cast("string")).when(d.rlike("^0+$"), "0").otherwise(F.regexp_replace(d, "^0+", ""))


def region_code(c: Column) -> Column:
    v = collapse(c)
    return F.when((F.length(v) <= 3) & v.rlike(r"^\p{L}+$"), F.upper(v)).otherwise(person_name(c))


#: Normalizer by value type; any other type is text.
NORMALIZERS: dict[str, Callable[[Column], Column]] = {
    "person_name": person_name,
    "email": email,
    "phone": phone,
    "postal_code": postal_code,
    "url": url,
    "integer": integer,
    "identifier": strip,
    "address": collapse,
    "text": collapse,
    "lower_token": email,
    "place_name": person_name,
    "region_code": region_code,
}


def normalized(raw: Column, value_type: Column) -> Column:
    """struct(normalized_value, normalization_method, is_null_token) of one raw value."""
    token = raw.isNull() | is_null_token(raw)
    value = reduce(lambda acc, kv: acc.when(value_type == kv[0], kv[1](raw)), NORMALIZERS.items(), F.when(F.lit(False), F.lit(None).cast("string"))).otherwise(collapse(raw))
    value = F.when(~token, value)
    empty = value.isNull() | (value == "")
    method = F.when(token, F.concat(value_type, F.lit(":null_token"))).when(empty, F.concat(value_type, F.lit(":empty"))).otherwise(value_type)
    return F.struct(F.when(~empty, value).alias("normalized_value"), method.alias("normalization_method"), token.alias("is_null_token"))


# --- shape detectors: evidence for a type, never a field by itself ---

DETECTORS: dict[str, Callable[[Column], Column]] = {
    "email": lambda c: c.rlike(r"^[^@\s]+@[^@\s]+\.[A-Za-z]{2,}$"),
    "url": lambda c: c.rlike(r"(?i)^(https?://|www\.)\S+$|^[a-z0-9-]+(\.[a-z0-9-]+)+$"),
    "linkedin": lambda c: c.rlike(r"(?i)linkedin\.com/"),
    "phone": lambda c: c.rlike(r"^[0-9\s()+\-.]+$") & F.length(digits(c)).between(7, 15),
    "integer": lambda c: c.rlike(r"^[0-9]{1,9}$"),
    "year": lambda c: c.rlike(r"^(1[89][0-9]{2}|20[0-9]{2}|21[0-9]{2})$"),
    "postal_code": lambda c: c.rlike(r"^[0-9]{5}(-[0-9]{4})?$") | c.rlike(r"^[0-9]{6}$") | c.rlike(r"(?i)^[A-Z]{1,2}[0-9][A-Z0-9]?\s*[0-9][A-Z]{2}$") | c.rlike(r"(?i)^[A-Z][0-9][A-Z]\s*[0-9][A-Z][0-9]$"),
}

# --- parts of identity keys ---


def website_domain(c: Column) -> Column:
    """Host of a URL without www, credentials and port, lower case; null if it has no dot."""
    v = F.regexp_replace(strip(c), r"[?#].*$", "")
    v = F.regexp_replace(v, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "/.*$", ""), "^.*@", ""), ":.*$", ""))
    host = F.regexp_replace(host, r"^www[0-9]*\.", "")
    return F.when(host.contains("."), host)


def linkedin_handle(c: Column) -> Column:
    """What follows linkedin.com, lower case, without query and outer slashes; else null."""
    v = F.regexp_replace(F.regexp_replace(F.lower(strip(c)), r"[?#].*$", ""), "/+$", "")
    handle = F.regexp_replace(F.regexp_extract(v, r"linkedin\.com(.*)$", 1), "^/+|/+$", "")
    return F.when(handle != "", handle)


def folded_name(c: Column) -> Column:
    """Letters and digits only, lower case: for comparing entity names."""
    return F.lower(F.regexp_replace(c, "[^a-zA-Z0-9]+", ""))


def real_employer(c: Column) -> Column:
    return c.isNotNull() & ~F.lower(strip(c)).isin(*vocab.NON_EMPLOYERS)


# --- ids and hashes ---


def stable_id(*parts: Column | str) -> Column:
    """An id that depends on its parts only, so retries and reruns agree; a null part differs from an empty one."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.substring(F.sha2(F.concat_ws("\u001f", *[F.coalesce(F.concat(F.lit("="), c), F.lit("~")) for c in cols]), 256), 1, 32)


def payload_hash(payload: Column) -> Column:
    """SHA-256 of the payload as JSON with sorted keys; nulls are kept."""
    entries = F.array_sort(F.map_entries(payload))
    cell = lambda e: F.concat(F.to_json(F.struct(e["key"].alias("k"))), F.coalesce(F.to_json(F.struct(e["value"].alias("v"))), F.lit("{}")))
    return F.sha2(F.concat_ws(",", F.transform(entries, cell)), 256)


def unstorable(payload: Column) -> Column:
    """Name of the first column (in name order) whose name or value holds a NUL or invalid UTF-8; else null."""
    bad = lambda x: x.isNotNull() & (x.contains("\u0000") | ~F.is_valid_utf8(x))
    found = F.filter(F.array_sort(F.map_entries(payload)), lambda e: bad(e["key"]) | bad(e["value"]))
    return F.when(F.size(found) > 0, found[0]["key"])


def sanitized(payload: Column) -> Column:
    """The payload with NULs and invalid sequences as U+FFFD."""
    clean = lambda x: F.make_valid_utf8(F.replace(x, F.lit("\u0000"), F.lit("�")))
    return F.transform_values(F.transform_keys(payload, lambda k, v: clean(k)), lambda k, v: clean(v))
