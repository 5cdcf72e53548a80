"""Benchmark decontamination: a BM25 index of the test items, block-max pruning, and an overlap check.

Each training passage is a query against the items. Scores are BM25 divided by what the item scores against itself, so
one threshold holds for all items. Posting lists longer than LONG are not walked: for them each block of BLOCK items has
a maximum for each word, and these maxima bound what the long lists can add. As in block-max WAND, an item is scored in
full only if its short lists plus the bound of its block reach the threshold, or if long lists alone can bring it there
and the bound of its block does. No passage is skipped and no item above the threshold is lost. Items that are retrieved
are verified: enough of the question's and of the answer's word n-grams must stand in the passage.

Document frequencies, mean length and the size of a passage are those of all items, whichever share an index."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, drop, only, utf8, written

K1, B = 1.2, 0.75
#: Share of its own score that an item must reach; share of question and answer n-grams that must be found; their words.
THRESHOLD, OVERLAP, NGRAM = 0.5, 0.6, 4
#: Words of half a passage, at least; the longest item if that is longer. Passages overlap by half, so every item lies
#: whole in one.
HALF = 64
#: Posting lists up to this length are walked; items of a block; items of one index (more items: one pass for each).
LONG, BLOCK, INDEX_ITEMS = 6, 32, 4096

_SIGNS = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_PLAIN = bytes.maketrans(_SIGNS, b" " * len(_SIGNS))
#: An answer is what follows the last sentence end of the item.
_ANSWER = re.compile(rb"^(.*[.!?\n][\"')]*\s+)(\S.*?)\s*$", re.DOTALL)


def plain(text: bytes) -> list[bytes]:
    """Words, A-Z lower-cased, without ASCII punctuation."""
    return text.lower().translate(_PLAIN).split()


def question_answer(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """The item's last sentence is its answer, the rest its question; one sentence alone: its last quarter."""
    if m := _ANSWER.match(text.strip()):
        q, a = plain(m[1]), plain(m[2])
        if len(q) >= NGRAM and a:
            return q, a
    w = plain(text)
    cut = len(w) - len(w) // 4
    return w[:cut], w[cut:]


def ngrams(words: list[bytes], n: int = NGRAM) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    n = min(n, len(words))
    return set(zip(*(words[i:] for i in range(n)), strict=False))


def share_found(words: list[bytes], passage: list[bytes]) -> float:
    """Share of the n-grams of words that stand in the passage; no words: 1."""
    want = ngrams(words)
    return len(want & ngrams(passage, min(NGRAM, len(words)))) / len(want) if want else 1.0


class Statistics:
    """Of all items, however many indexes they are in: their number, mean and greatest length in words, and df, the
    number of items that have a word, for the words of an index at least."""

    def __init__(self, n: int, mean: float, longest: int, df: dict[bytes, int]):
        self.n, self.mean, self.half, self.df = n, max(1.0, mean), max(HALF, longest), df

    @classmethod
    def of(cls, bags: list[Counter]) -> Statistics:
        sizes = [b.total() for b in bags]
        return cls(len(bags), sum(sizes) / max(1, len(bags)), max(sizes, default=0), Counter(w for b in bags for w in b))


class Index:
    """Inverted index of up to INDEX_ITEMS items, weighed by the statistics of all (None: these are all)."""

    def __init__(self, items: list[tuple[int, bytes]], statistics: Statistics | None = None):
        # items of like size share blocks, which keeps the blocks' maxima near their items'
        items = sorted(items, key=lambda x: (len(x[1]), x))
        bags = [Counter(plain(t)) for _, t in items]
        self.ids = np.array([i for i, _ in items], np.int64)
        self.parts = [question_answer(t) for _, t in items]
        every = statistics or Statistics.of(bags)
        df, n, mean, self.half = every.df, every.n, every.mean, every.half
        here = Counter(w for b in bags for w in b)  # lengths of the posting lists
        postings: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
        self.weights: list[dict[int, float]] = []
        # short lists first: a word's number tells whether its list is walked
        order = sorted(here, key=lambda w: (here[w] > LONG, w))
        self.number = {w: i + 1 for i, w in enumerate(order)}
        self.n_short = sum(here[w] <= LONG for w in order)
        for j, b in enumerate(bags):
            size = b.total()
            raw = {w: np.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * size / mean)) for w, f in b.items()}
            whole = math.fsum(raw.values()) or 1.0
            self.weights.append({self.number[w]: x / whole for w, x in raw.items()})
            for w, x in raw.items():
                postings[w].append((j, x / whole))
        short = order[: self.n_short]
        self.begin = np.cumsum([0, 0, *(len(postings[w]) for w in short)])  # by number; 0 is no word
        self.item = np.array([j for w in short for j, _ in postings[w]], np.int64)
        self.value = np.array([x for w in short for _, x in postings[w]])
        blocks = -(-len(items) // BLOCK)
        self.most = np.zeros((len(order) - self.n_short, blocks), np.float32)
        for i, w in enumerate(order[self.n_short :]):
            for j, x in postings[w]:
                self.most[i, j // BLOCK] = max(self.most[i, j // BLOCK], x)
        #: What an item's long lists can add at most, whatever the passage.
        self.rest = np.array([sum(x for w, x in ws.items() if w > self.n_short) for ws in self.weights])

    def search(self, numbers: np.ndarray, lengths: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
        """The documents' first passages, and (passage, item, score) of all items at the threshold or above.

        numbers: of the words of all documents in turn, lengths: how many each has. Passages are numbered through; p of
        a document holds its words from p * half up to (p + 2) * half, the last may be short."""
        half, v, n_items = self.half, len(self.number) + 1, max(1, len(self.ids))
        chunks = np.maximum(1, -(-lengths // half))
        passages = np.maximum(1, chunks - 1)
        first_chunk, first = np.cumsum(chunks) - chunks, np.cumsum(passages) - passages
        at = np.flatnonzero(numbers)
        if not len(at):
            return first, []
        doc = np.repeat(np.arange(len(lengths)), lengths)[at]
        chunk = first_chunk[doc] + (at - (np.cumsum(lengths) - lengths)[doc]) // half
        # distinct words of each half, then of each passage: a half belongs to two passages, at the ends to one
        held = np.unique(chunk * v + numbers[at])
        c, t = held // v, held % v
        doc = np.searchsorted(first_chunk, c, side="right") - 1
        local = c - first_chunk[doc]
        one, two = first[doc] + np.minimum(local, passages[doc] - 1), first[doc] + np.maximum(local - 1, 0)
        twice = one != two
        pair = np.unique(np.concatenate([one * v + t, two[twice] * v + t[twice]]))
        p, t = pair // v, pair % v
        is_long = t > self.n_short
        bound = np.zeros((int(passages.sum()), self.most.shape[1]), np.float32)
        if is_long.any():
            pl = p[is_long]
            starts = np.flatnonzero(np.diff(pl, prepend=-1))
            bound[pl[starts]] = np.add.reduceat(self.most[t[is_long] - self.n_short - 1], starts, axis=0)
        ps, ts = p[~is_long], t[~is_long]
        count = self.begin[ts + 1] - self.begin[ts]
        total = int(count.sum())
        flat = np.repeat(self.begin[ts] - (np.cumsum(count) - count), count) + np.arange(total)
        key, where = np.unique(np.repeat(ps, count) * n_items + self.item[flat], return_inverse=True)
        partial = np.bincount(where, self.value[flat], len(key))
        kp, kj = key // n_items, key % n_items
        eps = 1e-4  # the bounds are single precision
        reach = partial + np.minimum(bound[kp, kj // BLOCK], self.rest[kj]) >= threshold - eps
        wanted = set(zip(kp[reach].tolist(), kj[reach].tolist(), strict=True))
        # items that long lists alone can bring to the threshold: where their block's bound allows it
        for j in np.flatnonzero(self.rest >= threshold - eps).tolist():
            wanted.update((q, j) for q in np.flatnonzero(bound[:, j // BLOCK] >= threshold - eps).tolist())
        out, last, have = [], -1, set()
        for q, j in sorted(wanted):
            if q != last:
                last, have = q, set(t[slice(*np.searchsorted(p, [q, q + 1]))].tolist())
            score = round(math.fsum(x for w, x in self.weights[j].items() if w in have), 9)
            if score >= threshold - 1e-9:
                out.append((q, j, score))
        return first, out

    def contaminations(self, texts: list[bytes]) -> list[tuple[int, int, int, float, float, float]]:
        """(number of the text, item_id, passage, score, question share, answer share): the best passage of each
        verified item of each text."""
        words = [plain(t) for t in texts]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        numbers = np.fromiter(map(self.number.get, chain.from_iterable(words), repeat(0)), np.int64, int(lengths.sum()))
        first, found = self.search(numbers, lengths)
        best: dict[tuple[int, int], tuple[float, float, float, int]] = {}
        for p, j, score in found:
            i = int(np.searchsorted(first, p, side="right")) - 1
            q = p - int(first[i])
            passage = words[i][q * self.half : (q + 2) * self.half]
            question, answer = self.parts[j]
            qs, as_ = share_found(question, passage), share_found(answer, passage)
            if qs >= OVERLAP and as_ >= OVERLAP:
                best[i, j] = max(best.get((i, j), (0.0, 0.0, 0.0, 0)), (score, qs, as_, q))
        return [(i, int(self.ids[j]), q, score, qs, as_) for (i, j), (score, qs, as_, q) in sorted(best.items())]


def item_statistics(items: DataFrame) -> tuple[int, float, int, DataFrame]:
    """Number, mean and greatest length of the items(no, item_id, text), and the items with df: of each of their words
    in how many items it is."""

    def cut(b):
        bags = [Counter(plain(t)) for t in utf8(b)]
        return {"no": b.column("no"), "size": [x.total() for x in bags], "words": [list(x) for x in bags]}

    cuts = written(arrow_map(items, cut, "no long, size long, words array<binary>"))
    n, total, longest = cuts.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    one = cuts.select("no", F.explode("words").alias("word"))
    # a common word has many items, so the join by word is of partial sums with rows that AQE splits; an item's own
    # words are gathered
    counts = one.groupBy("word").agg(F.count("*").alias("k"))
    weighed = items.join(one.join(counts, "word").groupBy("no").agg(F.collect_list(F.struct("word", "k")).alias("df")), "no")
    return n, total / max(1, n), longest, weighed


def contaminated(docs: DataFrame, benchmark: DataFrame, index_items: int = INDEX_ITEMS) -> DataFrame:
    """doc_id, item_id, passage, score, question_share, answer_share: a row for each document and verified item.

    All documents are searched, for index_items items at a time; an index has a bounded size, the items any number, and
    scores don't depend on which items share one.
    Items without words match nothing; items or documents with null ids are left out; rows that repeat an item_id are
    items of their own, of which one row a document is reported. Empty tables: no rows."""
    schema = "doc_id long, item_id long, passage int, score double, question_share double, answer_share double"
    spark = docs.sparkSession
    base = only(docs, doc_id="long", text="string").where("doc_id IS NOT NULL")
    items = only(benchmark, item_id="long", text="string").where(r"item_id IS NOT NULL AND text rlike '[^\\x20\\x09-\\x0D]'")
    items = written(items.withColumn("no", F.monotonically_increasing_id()))
    n, mean, longest, weighed = item_statistics(items)
    out, held, df = [], [], {}

    def search() -> DataFrame:
        shared = spark.sparkContext.broadcast(Index(held, Statistics(n, mean, longest, df)))

        def run(b):
            index = shared.value
            ids = b.column("doc_id").to_pylist()
            rows = [(ids[i], *x) for i, *x in index.contaminations(utf8(b))]
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            return dict(zip(("doc_id", "item_id", "passage", "score", "question_share", "answer_share"), map(list, cols), strict=True))

        found = written(arrow_map(base, run, schema))
        shared.destroy()  # the driver holds one index at a time
        return found

    for r in weighed.orderBy("item_id", "text", "no").toLocalIterator():
        held.append((r["item_id"], r["text"].encode()))
        df |= {bytes(w): k for w, k in r["df"]}
        if len(held) == index_items:
            out.append(search())
            held, df = [], {}
    if held or not out:
        out.append(search())
    drop(items)
    found = out[0]
    for x in out[1:]:
        found = found.unionByName(x)
    best = F.max(F.struct("score", "question_share", "answer_share", "passage")).alias("m")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.passage", "m.score", "m.question_share", "m.answer_share")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, whose doc_id is in no row of contaminated(). Rows without doc_id stay."""
    leaks = written(contaminated(docs, benchmark).select(F.col("doc_id").alias("_gw_leak")).distinct())
    return docs.join(leaks, F.col("doc_id").cast("long") == F.col("_gw_leak"), "left_anti")


def op8_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
