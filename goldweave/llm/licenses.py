"""License scan by canonical digests, with Spark expressions only.

A text is brought to a canonical form (lower case, copyright lines out, equivalent spellings made one, punctuation and
blanks to single spaces), digested, and joined with the digests of known licences in the same form. Whole texts are
looked up; the lines of a text are looked up too, for documents that carry a licence notice among other text. A line is
digested if its canonical form is as long as one of the known notices, which is no restriction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .license_texts import DIGESTS, KNOWN, SPELLINGS


def _flat(c) -> F.Column:
    """Lower case, copyright lines out, signs as spaces; line ends stay. Regular expressions are ASCII, as are the
    letters lowered."""
    low = F.translate(F.coalesce(c, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # whole lines that only state a copyright, and the line "all rights reserved"
    out = F.regexp_replace(low, r"(^|\n)[ \t\r*#/;-]*(copyright|\(c\)|©)[^\n]*", "\n")
    out = F.regexp_replace(out, r"(^|\n)[ \t\r*#/;-]*all rights reserved[ \t\r.]*", "\n")
    return F.regexp_replace(out, r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F‘’“”«»–—…]+", " ")


def _spelled(c) -> F.Column:
    """One spelling of each word, between spaces. Few texts have any that changes: the others cost one search."""
    replaced = reduce(lambda x, e: F.replace(x, F.lit(f" {e[0]} "), F.lit(f" {e[1]} ")), SPELLINGS, c)
    return F.when(c.rlike(" (?:" + "|".join(one for one, _ in SPELLINGS) + ") "), replaced).otherwise(c)


def canonical(c) -> F.Column:
    """The canonical form of a text; null as empty."""
    return F.trim(_spelled(F.concat(F.lit(" "), F.trim(F.regexp_replace(_flat(c), "[ \n]+", " ")), F.lit(" "))))


def digest(c) -> F.Column:
    return F.sha2(canonical(c).cast("binary"), 256)


def known(spark, scope: str) -> DataFrame:
    """digest, license_id, chars of the known texts (scope 'text') or notices ('notice'). As many rows as the list has."""
    rows = [(i, t) for i, kind, t in KNOWN if scope == "text" or kind == "notice"]
    found = spark.createDataFrame(rows, "license_id string, t string").select(digest(F.col("t")).alias("digest"), "license_id", F.length(canonical(F.col("t"))).alias("chars"))
    if scope == "text":
        found = found.unionByName(spark.createDataFrame([(d, i, 0) for i, d in DIGESTS], "digest string, license_id string, chars int"))
    return found.groupBy("digest").agg(F.min("license_id").alias("license_id"), F.max("chars").alias("chars"))


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, text_digest, license_id (of the whole text, or null), notices (sorted ids of licence lines) for each row.

    Null and empty texts share the digest of an empty text and match nothing. Other columns play no part."""
    spark = docs.sparkSession
    texts = F.broadcast(known(spark, "text").select("digest", "license_id"))
    notices = known(spark, "notice").orderBy("digest").collect()  # a row for each notice of the list
    table = F.create_map(*[F.lit(x) for r in notices for x in (r["digest"], r["license_id"])])
    lengths = sorted({r["chars"] for r in notices})
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _flat(F.col("text").cast("string")).alias("flat"))
    # a map of the known digests stands for the join of exploded lines, so a document stays one row and nothing is
    # shuffled; the flat form serves the whole text and its lines
    # (each step is a column of its own, so that none is worked out twice)
    spaced = base.select("doc_id", F.concat(F.lit(" "), F.regexp_replace("flat", r" *\n *", " \n "), F.lit(" ")).alias("l"), F.concat(F.lit(" "), F.trim(F.regexp_replace("flat", "[ \n]+", " ")), F.lit(" ")).alias("w"))
    spelled = spaced.select("doc_id", _spelled(F.col("l")).alias("l"), F.trim(_spelled(F.col("w"))).alias("w"))
    lines = F.transform(F.split("l", "\n"), lambda x: F.trim(x))
    candidates = F.filter(lines, lambda x: F.length(x).isin(lengths))
    found = F.array_sort(F.array_distinct(F.filter(F.transform(candidates, lambda x: F.element_at(table, F.sha2(x.cast("binary"), 256))), lambda x: x.isNotNull())))
    return (
        spelled.select("doc_id", F.sha2(F.col("w").cast("binary"), 256).alias("text_digest"), found.alias("notices"))
        .join(texts, F.col("text_digest") == F.col("digest"), "left")
        .select("doc_id", "text_digest", "license_id", "notices")
    )


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return scanned(table(spark, sf_dir, "documents")).select("doc_id", "text_digest", "license_id", F.array_join("notices", ",").alias("notices"))


def _canonical_sql(c: str) -> str:
    out = f"translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = f"regexp_replace({out}, '(^|\\n)[ \\t\\r*#/;-]*(copyright|\\(c\\)|©)[^\\n]*', chr(10), 'g')"
    out = f"regexp_replace({out}, '(^|\\n)[ \\t\\r*#/;-]*all rights reserved[ \\t\\r.]*', chr(10), 'g')"
    out = f"regexp_replace({out}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+|[‘’“”«»–—…]', ' ', 'g')"
    out = f"' ' || trim(regexp_replace({out}, ' +', ' ', 'g')) || ' '"
    for one, other in SPELLINGS:
        out = f"replace({out}, ' {one} ', ' {other} ')"
    return f"trim({out})"


def _known_sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    return ", ".join(f"({quoted(i)}, {quoted(kind)}, {quoted(t)})" for i, kind, t in KNOWN)


def _digests_sql() -> str:
    return ", ".join(f"('{i}', '{d}')" for i, d in DIGESTS)


OP1_SQL = f"""
WITH k AS (
  SELECT id, kind, sha256({_canonical_sql("t")}) AS digest FROM (VALUES {_known_sql()}) v(id, kind, t)
), whole AS (
  SELECT digest, min(id) AS license_id FROM (SELECT id, digest FROM k UNION ALL SELECT * FROM (VALUES {_digests_sql()}) w(id, digest)) GROUP BY digest
), notice AS (
  SELECT digest, min(id) AS license_id FROM k WHERE kind = 'notice' GROUP BY digest
), d AS (
  SELECT doc_id, text, sha256({_canonical_sql("text")}) AS text_digest FROM documents
), l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
), f AS (
  SELECT DISTINCT doc_id, license_id FROM l JOIN notice ON sha256({_canonical_sql("line")}) = digest
), n AS (
  SELECT doc_id, string_agg(license_id, ',' ORDER BY license_id) AS notices FROM f GROUP BY doc_id
)
SELECT d.doc_id, d.text_digest, whole.license_id, coalesce(n.notices, '') AS notices
FROM d LEFT JOIN whole ON d.text_digest = whole.digest LEFT JOIN n ON d.doc_id = n.doc_id
"""
