"""Substring dedup by unit hashing: passages that repeat across documents go, but for their earliest occurrence.

Units are lines of MIN_RUN_WORDS words or more and, so that a passage is found where it is only part of a line, pieces
of lines: texts are cut at sentence and line ends and where a hash of the words near by says so. A passage has the same
pieces wherever it stands, also where its sentences are few, long or joined with the host's words; only its first and
last words depend on the host. A unit of pieces is two neighbouring ones, as one of a few words repeats by chance. Units
are normalised and digested; the earliest (doc_id, offset) of each digest is its keeper. What later units cover is
removed where it runs on for MIN_RUN_WORDS words or more: a single common sentence is no repeated passage. A text is
cut once; its units carry their offsets, so texts are never shuffled."""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import BROADCAST_ROWS, arrow_map, only, utf8, written

#: Words of a removed run at least. A passage of over 50 words may be cut into a line anywhere: its words up to the first
#: cut that it shares with its copies, and those after the last one, are in units with others' words.
MIN_RUN_WORDS = 25
#: Besides sentences, a piece begins at a word whose hash is the least of the NEAR words before and after it.
NEAR = 3

#: A unit found so often has its keeper broadcast.
HOT = 2000

#: A sentence ends after . ! ? (and closing quotes) before a blank, or at a line end.
_STOP = re.compile(rb"[.!?][\"')\]]*(?=[ \t\r\x0b\x0c])|\n")

_NOISE = bytes.maketrans(bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127)), b" " * 32)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _cuts(words: list[bytes]) -> np.ndarray:
    """Numbers of the words that hashes choose for a piece to begin at; the hash is of a word and the one before it."""
    n = len(words)
    h = np.fromiter(map(crc32, words), np.uint64, n)
    v = h * np.uint64(0x9E3779B97F4A7C15)
    v[1:] ^= h[:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
    v = (v ^ (v >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    least = np.ones(n, bool)
    for d in range(1, NEAR + 1):
        least[d:] &= v[d:] < v[:-d]
        least[:-d] &= v[:-d] <= v[d:]
    return np.flatnonzero(least)


def units(text: bytes, least: int = MIN_RUN_WORDS) -> list[tuple[int, int, int, int, int]]:
    """(first word, last word + 1, start, end, digest) of the units, offsets in code points; normal form: ASCII lower
    case, ASCII punctuation and blanks as one space. A unit ends with the signs that follow its last word; a text of
    one piece is one unit."""
    plain = text.lower().translate(_NOISE)
    words = plain.split()
    if not words:
        return []
    raw = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[False], ~_BLANK[np.frombuffer(plain, np.uint8)], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    begun = np.zeros(len(words) + 1, bool)
    begun[_cuts(words)] = True
    begun[np.searchsorted(starts, [m.start() for m in _STOP.finditer(text)])] = True
    begun[0], begun[-1] = True, True
    blank = np.append(np.flatnonzero(_BLANK[raw]), len(text))
    points = np.cumsum(np.append((raw & 0xC0) != 0x80, False)) if max(raw) >= 0x80 else None

    def placed(first: np.ndarray, last: np.ndarray) -> tuple[list[int], list[int]]:
        """Offsets of words first to last - 1, with the signs that follow."""
        at = starts[first]
        end = np.minimum(blank[np.searchsorted(blank, ends[last - 1])], np.append(starts, len(text))[last])
        if points is not None:
            at, end = points[at] - 1, np.where(end > 0, points[end - 1], 0)
        return at.tolist(), end.tolist()

    cuts = np.flatnonzero(begun)
    one, two = (cuts[:-1], cuts[1:]) if len(cuts) == 2 else (cuts[:-2], cuts[2:])
    out = [(f, e, x, y, _digest(words[f:e])) for f, e, x, y in zip(one.tolist(), two.tolist(), *placed(one, two), strict=True)]
    # lines by their own words alone, wherever they stand
    bounds = np.unique(np.concatenate([[0], np.searchsorted(starts, np.flatnonzero(raw == 10)), [len(words)]]))
    long = np.flatnonzero(np.diff(bounds) >= least)
    one, two = bounds[long], bounds[long + 1]
    return out + [(f, e, x, y, _digest([b"\n", *words[f:e]])) for f, e, x, y in zip(one.tolist(), two.tolist(), *placed(one, two), strict=True)]


def _digest(words: list[bytes]) -> int:
    return xxh3_64_intdigest(b" ".join(words)) - (1 << 63)


def runs(found: list[tuple[int, int, int, int, int]], least: int = MIN_RUN_WORDS) -> list[tuple[int, int, int, int]]:
    """(start, end, words, keeper's doc) of what to remove, from a document's repeated units (first word, last word + 1,
    start, end, keeper's doc): units that share words run on."""
    out, run = [], None
    for first, last, start, end, keeper in sorted(found):
        if run and first < run[1]:
            run = (run[0], max(run[1], last), run[2], max(run[3], end), min(run[4], keeper))
            continue
        if run and run[1] - run[0] >= least:
            out.append((run[2], run[3], run[1] - run[0], run[4]))
        run = (first, last, start, end, keeper)
    if run and run[1] - run[0] >= least:
        out.append((run[2], run[3], run[1] - run[0], run[4]))
    return out


def repeated_runs(docs: DataFrame, least: int = MIN_RUN_WORDS) -> DataFrame:
    """doc_id, start, end (code points, half open), n_words, keeper_doc_id: a row for each run to remove.

    The earliest occurrence, by doc_id and offset, of each unit stays. Rows that share a doc_id are taken as parts of
    one document; their units are told apart by offset and digest only. Rows without doc_id keep all their text and
    keep none from others. Null or empty texts have no units."""
    base = only(docs, doc_id="long", text="string").where("doc_id IS NOT NULL")

    def cut(b):
        ids, cols = [], []
        for doc, text in zip(b.column("doc_id").to_pylist(), utf8(b), strict=True):
            found = units(text, least)
            ids += [doc] * len(found)
            cols += found
        first, last, start, end, digest = np.array(cols, np.int64).reshape(-1, 5).T
        # offsets and lengths share a number: a unit lies within 2**31 words and code points
        return {"doc_id": pa.array(ids, pa.int64()), "digest": digest, "at": first << 32 | start, "size": (last - first) << 32 | (end - start)}

    rows = written(arrow_map(base, cut, "doc_id long, digest long, at long, size long"))
    # one partial sum a task and digest: a sentence that every document has is one row a task
    firsts = rows.groupBy("digest").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = written(firsts.select("digest", F.col("first.doc_id").alias("keeper"), F.col("first.at").alias("keeper_at"), "n"))
    # units found in very many places are few, as each stands for so many rows: they are told by broadcast, so that the
    # join by digest has no hot key
    total = firsts.agg(F.sum("n")).first()[0] or 0
    least_hot = max(HOT, -(-total // BROADCAST_ROWS))
    hot = firsts.where(F.col("n") >= least_hot)
    few = rows.join(firsts.where(F.col("n") < least_hot), "digest")
    later = few.unionByName(rows.join(F.broadcast(hot), "digest")) if total and not hot.isEmpty() else few
    hits = later.where("doc_id <> keeper OR at <> keeper_at")
    found = hits.groupBy("doc_id").agg(F.collect_list(F.struct("at", "size", "keeper")).alias("hits"))  # a document's own units

    def spans(b):
        out = []
        for doc, hits in zip(b.column("doc_id").to_pylist(), b.column("hits"), strict=True):
            at, size, keeper = (hits.values.field(i).to_numpy() for i in range(3))
            first, start = at >> 32, at & 0xFFFFFFFF
            rows = zip(first.tolist(), (first + (size >> 32)).tolist(), start.tolist(), (start + (size & 0xFFFFFFFF)).tolist(), keeper.tolist(), strict=True)
            out += [(doc, *x) for x in runs(list(rows), least)]
        return dict(zip(("doc_id", "start", "end", "n_words", "keeper_doc_id"), map(list, zip(*out, strict=True)) if out else [[]] * 5, strict=True))

    return arrow_map(found, spans, "doc_id long, start long, end long, n_words long, keeper_doc_id long")


def without_repeated_runs(docs: DataFrame, least: int = MIN_RUN_WORDS) -> DataFrame:
    """doc_id, text (without the runs), removed (array of start, end, in offsets of the original) for each row."""
    gone = repeated_runs(docs, least).groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("removed"))
    rows = only(docs, doc_id="long", text="string").join(gone, "doc_id", "left")
    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    kept = F.aggregate(
        F.coalesce("removed", F.array().cast("array<struct<start:bigint,end:bigint>>")),
        first,
        lambda a, r: F.struct(r["end"].alias("at"), F.concat(a["out"], F.col("text").substr((a["at"] + 1).cast("int"), (r["start"] - a["at"]).cast("int"))).alias("out")),
        lambda a: F.concat(a["out"], F.col("text").substr((a["at"] + 1).cast("int"), F.length("text"))),
    )
    return rows.select("doc_id", kept.alias("text"), "removed")


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return repeated_runs(table(spark, sf_dir, "documents"))
