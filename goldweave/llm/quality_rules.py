"""Quality rules: base counts of every text, and a hashed n-gram log-likelihood ratio between trusted and raw text.

Words and word pairs are hashed into BUCKETS. Two multinomials are counted: one over the trusted documents, one over
all. A document's score is the mean, over its n-grams, of log p_trusted - log p_raw; it is kept at LEAST or more. Both
counts run over all documents; each task sends one sum a bucket, whatever it has read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, only, small_batches, utf8

BUCKETS = 1 << 14
#: Least mean log-likelihood ratio of a kept document.
LEAST = -0.12
#: Fails the base rules: fewer words, or more than this percentage of words in repeated 3-word windows.
MIN_WORDS, REPEAT_PERCENT = 50, 50
#: Ids of trusted documents are broadcast up to this number (about 30 MB); beyond it the join shuffles.
BROADCAST_IDS = 1_000_000
SYMBOLS = b"#*$%&|<>"
_OUTSIDE = b" \t\n\r\x0b\x0c" + bytes(range(0x80, 0xC0))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes], memo: dict[bytes, int]) -> np.ndarray:
    """XXH3 of each word; memo is only a cache, emptied when large."""
    if len(memo) > 500_000:
        memo.clear()
    for w in set(words):
        if w not in memo:
            memo[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def grams(h: np.ndarray) -> np.ndarray:
    """Buckets of the words and the pairs of neighbours."""
    one = h * _MIX
    two = (h[:-1] * _MIX ^ (h[1:] >> np.uint64(7))) * _MIX
    return (np.concatenate([one, two]) >> np.uint64(64 - 14)).astype(np.int64)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text, the first included."""
    n = len(words)
    if n < 4:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    if len(names) == n:
        return 0
    v = len(names)
    pair = ids[:-1] * v + ids[1:]
    if v >= 1 << 20:  # the third power would not fit: name the pairs anew
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * v + ids[2:]
    _, where, times = np.unique(window, return_inverse=True, return_counts=True)
    start = times[where] > 1
    covered = np.zeros(n, bool)
    for i in range(3):
        covered[i : i + len(start)] |= start
    return int(covered.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    words = text.split()
    seen: set[bytes] = set()
    dup = 0
    if b"\n" in text:
        for line in text.split(b"\n"):
            if line in seen:
                dup += 1
            elif line.strip():
                seen.add(line)
    return len(words), len(text.translate(None, _OUTSIDE)), len(text) - len(text.translate(None, SYMBOLS)), dup, repeat_words(words)


def trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, trusted: whether labels mark the document with quality 1 (any row of it)."""
    ids = only(labels, doc_id="long", quality="int").where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id")).distinct()
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    base = only(docs, doc_id="long", text="string")
    return base.join(ids, base["doc_id"] == F.col("_id"), "left").select("doc_id", "text", F.col("_id").isNotNull().alias("trusted"))


def log_ratios(marked: DataFrame) -> np.ndarray:
    """log p_trusted - log p_raw of each bucket, each count plus one, over all rows of trusted().

    No trusted document at all: zeros, so that only the base rules judge."""
    small_batches(marked.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good, memo = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64), {}
        for b in batches:
            for text, ok in zip(utf8(b), b.column("trusted").to_pylist(), strict=True):
                if w := text.lower().split():
                    c = np.bincount(grams(word_hashes(w, memo)), minlength=BUCKETS)
                    raw += c
                    if ok:
                        good += c
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(raw[some]), pa.array(good[some])], names=["bucket", "raw", "good"])

    sums = marked.mapInArrow(count, "bucket int, raw long, good long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
    raw, good = np.ones(BUCKETS), np.ones(BUCKETS)
    for r in sums.collect():  # BUCKETS rows at most
        raw[r["bucket"]] += r["raw"]
        good[r["bucket"]] += r["good"]
    return np.log(good / good.sum()) - np.log(raw / raw.sum()) if good.sum() > BUCKETS else np.zeros(BUCKETS)


def judged(docs: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, the base counts, score, base_failed, kept for each row of docs.

    A null or empty text has no words, fails the base rules and scores 0. Other columns play no part. Empty tables:
    no rows, or no trusted text (see log_ratios)."""
    ratios = log_ratios(trusted(docs, labels))
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(b):
        rows, memo = [], {}
        for text in utf8(b):
            n, *rest = base_counts(text)
            failed = n < MIN_WORDS or 100 * rest[-1] > REPEAT_PERCENT * n
            score = float(shared.value[grams(word_hashes(text.lower().split(), memo))].mean()) if n else 0.0
            rows.append((n, *rest, failed, score, not failed and score >= least))
        cols = list(zip(*rows, strict=True)) or [[]] * 8
        return {"doc_id": b.column("doc_id")} | dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"), map(list, cols), strict=True))

    return arrow_map(only(docs, doc_id="long", text="string"), run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean")


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
