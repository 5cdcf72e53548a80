"""Line dedup: lines found in many documents stay in one of them only.

Two Bloom filters hold the hashes of line keys seen once and seen twice. A scan of all texts builds them in pieces, so
neither lines nor their hashes are shuffled: each batch sends, for every segment of the filters, the positions it saw
once and twice, two bytes each, and a task per segment merges them (twice = any twice, or once in two batches). Only
lines whose bits are all set in the second filter are suspected; their digests are shuffled and counted exactly. Filters
have BITS_PER_LINE bits for each long line; where that is more than one broadcast may hold, the hashes are dealt into
slices and each slice has filters and a scan of its own, so they are as full at every size. The digests that turn out
common, with the document that keeps each, go back by broadcast up to a checked number, so texts are not shuffled."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, only, small_batches, utf8, written

#: A key has at least so many code points, and loses its lines when at least so many documents hold it.
MIN_CHARS, MIN_DOCS = 40, 5
#: Hash functions of the filters, bits of each for a line, and the bits that are broadcast at once at most (32 MB).
HASHES, BITS_PER_LINE, MAX_BITS = 2, 8, 1 << 28
#: Common lines are broadcast up to this number (40 MB in a Python worker); beyond it texts are joined with them.
BROADCAST_LINES = 250_000
#: Bits of a segment, in which a position takes two bytes.
SEGMENT = 1 << 16
BLANKS = b" \t\n\r\x0b\x0c"


def line_key(line: bytes) -> bytes:
    """The line without [\\x20\\x09-\\x0D] at both ends, A-Z lower-cased; other characters stay as they are."""
    return line.strip(BLANKS).lower()


def long_key(key: bytes, min_chars: int = MIN_CHARS) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)


def document_keys(text: bytes, min_chars: int = MIN_CHARS) -> set[bytes]:
    return {k for x in text.split(b"\n") if len(x) >= min_chars and long_key(k := line_key(x), min_chars)}


def positions(keys: list[bytes], bits: int) -> np.ndarray:
    """A row of HASHES filter positions for each key."""
    h = np.frombuffer(b"".join([xxhash.xxh3_128_digest(k) for k in keys]), np.uint64).reshape(-1, 2)
    return np.stack([(h[:, 0] + np.uint64(i) * h[:, 1]) % np.uint64(bits) for i in range(HASHES)], axis=1).astype(np.int64)


def filter_bits(lines: int) -> tuple[int, int]:
    """Bits of a filter, a power of two and a segment at least, and the number of slices."""
    want = max(SEGMENT, lines * BITS_PER_LINE)
    bits = min(max(SEGMENT, MAX_BITS), 1 << (want - 1).bit_length())
    return bits, -(-want // bits)


def of_slice(keys: list[bytes], bits: int, slices: int, no: int) -> tuple[list[bytes], np.ndarray]:
    """The keys whose hash belongs to the slice, and their positions."""
    p = positions(keys, bits)
    if slices == 1:
        return keys, p
    mine = [i for i, k in enumerate(keys) if xxhash.xxh3_64_intdigest(k, 1) % slices == no]
    return [keys[i] for i in mine], p[mine]


def _pieces(bits: int, min_chars: int, slices: int = 1, no: int = 0):
    """Batches of doc_id, text to rows (segment, once, twice): packed uint16 positions that the batches saw."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0
        for b in batches:
            # a document counts once for a key, and rows that repeat a doc_id do no harm: suspicion is only widened
            keys = [k for t in utf8(b) for k in document_keys(t, min_chars)]
            if keys:
                held.append(of_slice(keys, bits, slices, no)[1])
                n += len(held[-1])
            if n >= 200_000:
                yield from _emit(held)
                held, n = [], 0
        if held:
            yield from _emit(held)

    def _emit(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(held)
        if not len(rows):
            return
        # equal rows are equal keys (or a collision, which only widens suspicion)
        pos, times = np.unique(rows.ravel(), return_counts=True)
        seg = pos // SEGMENT
        cuts = np.flatnonzero(np.diff(seg)) + 1
        off = (pos % SEGMENT).astype("<u2")
        twice = times > 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(pos)]])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(seg[s]) for s in starts], pa.int32()),
                pa.array([off[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary()),
                pa.array([off[s:e][twice[s:e]].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary()),
            ],
            names=["segment", "once", "twice"],
        )

    return run


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by segment to one row (segment, bits) of the second filter each; two segments' bits are held at most."""
    at, once, twice = None, None, None
    for b in batches:
        for seg, o, t in zip(b["segment"], b["once"], b["twice"], strict=True):
            if seg != at:
                if at is not None:
                    yield pd.DataFrame({"segment": [at], "bits": [np.packbits(twice).tobytes()]})
                at, once, twice = seg, np.zeros(SEGMENT, bool), np.zeros(SEGMENT, bool)
            seen = np.frombuffer(o, "<u2")
            twice[seen[once[seen]]] = True
            once[seen] = True
            twice[np.frombuffer(t, "<u2")] = True
    if at is not None:
        yield pd.DataFrame({"segment": [at], "bits": [np.packbits(twice).tobytes()]})


def twice_seen(base: DataFrame, bits: int, min_chars: int, slices: int = 1, no: int = 0) -> bytes:
    """The second filter, of bits / 8 bytes (MAX_BITS / 8 at most), on the driver."""
    small_batches(base.sparkSession)
    pieces = base.mapInArrow(_pieces(bits, min_chars, slices, no), "segment int, once binary, twice binary")
    merged = pieces.repartition("segment").sortWithinPartitions("segment").mapInPandas(_merge, "segment int, bits binary")
    out = bytearray(bits // 8)
    step = SEGMENT // 8
    for r in merged.toLocalIterator():
        out[r["segment"] * step : (r["segment"] + 1) * step] = r["bits"]
    return bytes(out)


def _suspects(base: DataFrame, bits: int, min_chars: int, slices: int, no: int) -> DataFrame:
    """doc_id, digest of the lines that the second filter of a slice suspects, once a document."""
    shared = base.sparkSession.sparkContext.broadcast(twice_seen(base, bits, min_chars, slices, no))

    def run(b):
        flat = np.frombuffer(shared.value, np.uint8)
        ids, digests = [], []
        for doc, text in zip(b.column("doc_id").to_pylist(), utf8(b), strict=True):
            if keys := list(document_keys(text, min_chars)):
                keys, p = of_slice(keys, bits, slices, no)
                hit = ((flat[p >> 3] >> (7 - (p & 7))) & 1).all(axis=1)
                found = [hashlib.md5(keys[i]).digest() for i in np.flatnonzero(hit)]
                ids += [doc] * len(found)
                digests += found
        return {"doc_id": ids, "digest": digests}

    return arrow_map(base, run, "doc_id long, digest binary")


def common_lines(base: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """digest, keep: the line keys of min_docs documents or more, and the largest doc_id that holds each. base has doc_id
    (never null) and text. Holders are counted without gathering any: distinct pairs, then partial sums a task."""
    long = F.filter(F.split("text", "\n"), lambda x: F.length(x) >= min_chars)
    lines = base.agg(F.coalesce(F.sum(F.size(long).cast("long")), F.lit(0))).first()[0]
    bits, slices = filter_bits(lines)
    held = reduce(DataFrame.unionByName, [_suspects(base, bits, min_chars, slices, no) for no in range(slices)])
    return held.distinct().groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep")).where(F.col("n") >= min_docs).select("digest", "keep")


def without_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text (what stays, joined by \\n), n_lines, n_dropped for each row of docs.

    A null or empty text is one empty line. Rows that share a doc_id are one document when holders are counted. Rows
    without doc_id hold no line and lose none. Empty table: no rows. Other columns play no part."""
    base = only(docs, doc_id="long", text="string")
    common = written(common_lines(base.where("doc_id IS NOT NULL"), min_docs, min_chars))
    if common.count() <= BROADCAST_LINES:
        keepers = {bytes(r["digest"]): r["keep"] for r in common.collect()}
        shared = base.sparkSession.sparkContext.broadcast(keepers)
        rows, lost = base, lambda b: repeat(shared.value)
    else:
        # the lines are cut again, as suspects were not kept; a line that very many documents hold is a key of a join
        # that AQE splits, and only a document's own common lines are gathered
        def keyed(b):
            pairs = [(d, hashlib.md5(k).digest()) for d, t in zip(b.column("doc_id").to_pylist(), utf8(b), strict=True) for k in document_keys(t, min_chars)]
            return dict(zip(("doc_id", "digest"), map(list, zip(*pairs, strict=True)) if pairs else ([], []), strict=True))

        pairs = arrow_map(base.where("doc_id IS NOT NULL"), keyed, "doc_id long, digest binary").join(common, "digest").where("doc_id <> keep")
        rows = base.join(pairs.groupBy("doc_id").agg(F.collect_set("digest").alias("digests")), "doc_id", "left").select("doc_id", "text", "digests")
        lost = lambda b: (dict.fromkeys(x or ()) for x in b.column("digests").to_pylist())

    def keep(b):
        texts, n, dropped = [], [], []
        for doc, text, gone in zip(b.column("doc_id").to_pylist(), utf8(b), lost(b)):
            lines = text.split(b"\n")
            left = lines
            if gone and doc is not None and len(text) >= min_chars:
                # the keeper of a line is the largest doc_id, so a line is lost where its keeper is another
                left = [x for x in lines if len(x) < min_chars or not long_key(k := line_key(x), min_chars) or gone.get(hashlib.md5(k).digest(), doc) == doc]
            texts.append(b"\n".join(left).decode("utf-8", "replace"))
            n.append(len(lines))
            dropped.append(len(lines) - len(left))
        return {"doc_id": b.column("doc_id"), "text": texts, "n_lines": n, "n_dropped": dropped}

    return arrow_map(rows, keep, "doc_id long, text string, n_lines long, n_dropped long")


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = without_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH l AS (
  SELECT doc_id, u.line, u.no, translate(regexp_replace(regexp_replace(u.line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS no FROM documents) u
), r AS (
  SELECT k, max(doc_id) AS keep FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), x AS (
  SELECT l.*, r.keep IS NOT NULL AND l.doc_id <> r.keep AS gone FROM l LEFT JOIN r USING (k)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS kept_sha256
FROM x GROUP BY doc_id
"""
