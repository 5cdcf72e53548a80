"""SimHash fingerprints, and near copies found through Golay-code keys of fingerprint segments.

Two uses share the method (segments of a fingerprint are decoded to nearby Golay codewords; their indices are the keys
that are joined; each pair that meets is verified):

* fingerprints() and linked(): 64 bits of word shingles, all pairs of at most two differing bits, found without loss.
  The bits are cut into segments of 22, 21 and 21. Two errors leave one of the three segments without error, and any
  other segment has at most two, where the index sets of golay.ball() always meet. So a key is one whole segment and an
  index of the next one; 33 bits or more, and some 16 keys a fingerprint.
* near_copies(): five-word shingles with a Jaccard similarity of 0.8 or more. Such texts differ in some 15 % of the
  bits, so the fingerprint is longer (SEGMENTS times 23 bits) and each segment is decoded softly: a bit that the
  shingles hardly decide counts less, and the two best codewords are kept. A key is a segment with an index, so the
  others may err, and the least values of two hashes of the shingles, which texts of similarity 0.8 share in 80 % each:
  36 bits, so that chance fills few buckets; it is the same at every size. The bits that differ, and an odd sketch, which
  bounds from below the shingles that differ, decide which pairs of a bucket go on. Every one of these is verified on its
  whole shingle sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import golay
from .common import arrow_map, bounded, components, drop, only, small_batches, utf8, written

#: Differing bits at most, of 64; bits of the segments.
NEAR_BITS, CUT = 2, (22, 21, 21)
#: For near_copies: words of a shingle, least Jaccard similarity, 23-bit segments, codewords kept of each.
SHINGLE, SIMILARITY, SEGMENTS, CODEWORDS = 5, 0.8, 16, 2
#: near_copies: a pair is verified if at most this share of its bits differs. Pairs of similarity 0.8 differ in 15 % on
#: average, of 1,024 bits, so 19.5 % is four standard deviations away; texts that merely share a passage differ in more.
BITS_APART = 0.195
#: near_copies: while buckets hold over MANY pairs a member across components, up to ROUNDS times their members meet
#: the first one, which draws families together, as long as that links one in ten; then all pairs meet, BLOCK members of a bucket a task. No limit of these
#: changes what is compared in the end. SPLIT: a text in more pairs than this is verified in several tasks.
#: WIDE: rows with sketches (some 10 MB) that are broadcast.
MANY, ROUNDS, BLOCK, SPLIT, WIDE = 8, 3, 4096, 1024, 20_000


def shingle_slices(text: bytes, k: int) -> list[bytes]:
    """Word shingles of a text, lower-cased A-Z, joined by one space; fewer words: all of them; none: no shingle."""
    w = text.lower().split()
    if not w:
        return []
    joined = b" ".join(w)
    if len(w) <= k:
        return [joined]
    size = np.fromiter(map(len, w), np.int64, len(w))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    return [joined[s:e] for s, e in zip(starts[: len(w) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)]


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes (rows of little-endian 64-bit words) have each bit; bit 0 is the lowest of the first word."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(len(hashes), -1), axis=1, bitorder="little")
    if len(bits) < 256:
        return bits.sum(axis=0, dtype=np.uint8).astype(np.int64)
    whole = len(bits) // 255 * 255
    blocks = bits[:whole].reshape(-1, 255, bits.shape[1]).sum(axis=1, dtype=np.uint8)
    return blocks.sum(axis=0, dtype=np.int64) + bits[whole:].sum(axis=0, dtype=np.uint8)


def fingerprint(text: bytes, k: int = 3) -> int:
    """64 bits; a bit is set if over half of the shingles' XXH64 (seed 42) have it. No words: zero."""
    s = shingle_slices(text, k)
    if not s:
        return 0
    h = np.frombuffer(b"".join([xxhash.xxh64_digest(x, 42) for x in s]), ">u8").astype(np.uint64)
    return int.from_bytes(np.packbits(bit_counts(h) * 2 > len(s), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """doc_id, fp: the fingerprint of each whole text as a signed 64-bit number. Null text: as empty."""

    def run(b):
        fps = np.fromiter((fingerprint(t, k) for t in utf8(b)), np.uint64, b.num_rows)
        return {"doc_id": b.column("doc_id"), "fp": fps.view(np.int64)}

    return arrow_map(only(docs, doc_id="long", text="string"), run, "doc_id long, fp long")


def fingerprint_keys(fp: np.ndarray) -> np.ndarray:
    """One row of keys for each fingerprint (-1: none): a whole segment and an index of the next, 37 bits with its kind."""
    u = fp.view(np.uint64)
    seg, at = [], 0
    for n in CUT:
        seg.append((u >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64))
        at += n
    out = []
    for kind in range(3):
        near = golay.ball(seg[(kind + 1) % 3], CUT[(kind + 1) % 3])
        out.append(np.where(near < 0, -1, (kind << 35) | (seg[kind][:, None] << 12) | near))
    return np.concatenate(out, axis=1)


def _explode(ids: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    some = keys >= 0
    return np.broadcast_to(ids[:, None], keys.shape)[some], keys[some]


def linked(fps: DataFrame, bits: int = NEAR_BITS) -> DataFrame:
    """doc_id, fp, component_id for each row of fingerprints(): fingerprints at most `bits` (0 to 2) apart are linked,
    and component_id is the smallest doc_id reachable.

    Equal fingerprints are one node, so copies never multiply. A node has at most 2080 others within two bits, so the
    links grow with the nodes. Rows without doc_id follow their fingerprint; a component of only such has a null id.
    Empty table: no rows."""
    if not 0 <= bits <= 2:
        raise ValueError("the keys are complete for at most two differing bits")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))

    def run(b):
        fp = b.column("fp").to_numpy(zero_copy_only=False)
        ids, keys = _explode(fp, fingerprint_keys(fp))
        return {"fp": ids, "key": keys}

    keys = arrow_map(nodes.select("fp"), run, "fp long, key long")
    pairs = (
        keys.select("key", F.col("fp").alias("a"))
        .join(keys.select("key", F.col("fp").alias("b")), "key")
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits))
        .select("a", "b")
        .distinct()
    )
    # null representatives sort first among fingerprints, so components are of fingerprints and the ids come after
    comp = components(pairs)
    of = comp.join(nodes, comp["node"] == nodes["fp"]).select("fp", "rep", "component")
    low = of.groupBy("component").agg(F.min("rep").alias("component_id"))
    joined = of.join(low, "component").select("fp", "component_id")
    final = written(nodes.join(joined, "fp", "left").select("fp", F.coalesce("component_id", "rep").alias("component_id")))
    return fps.join(final, "fp").select("doc_id", "fp", "component_id")


# --- near copies: five-word shingles, Jaccard similarity of 0.8 or more ---

#: First and last segment of a key, by its kind; a key has one segment, and each is in two kinds.
KINDS = [(i, i) for i in [*range(0, SEGMENTS, 2), *range(1, SEGMENTS, 2)]] * 2
#: 64-bit words of the fingerprint, of which the segments take the first bits, and of the codewords' indices, five a word.
WORDS, CODES = 16, -(-SEGMENTS * CODEWORDS // 5)
#: Least hashes, of which a key has two; 64-bit words of them, five a word, and of the odd sketch.
LEAST = 2 * SEGMENTS
LEASTS, ODD = -(-LEAST // 5), 16


def shingle_set(text: bytes, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles, each mixed from the XXH3 of its words; fewer words: one of all."""
    words = text.lower().split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(k, len(h))
    out = np.zeros(max(0, len(h) - n + 1) if n else 0, np.uint64)
    for i in range(n):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[i : i + len(out)]
    return np.unique(out ^ (out >> np.uint64(32)))


def streams(h: np.ndarray, words: int = WORDS) -> np.ndarray:
    """A row of words for each hash: the outputs of SplitMix64 that follow it."""
    out = np.empty((len(h), words), np.uint64)
    for i in range(words):
        z = h + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, i] = z ^ (z >> np.uint64(31))
    return out


def wide_margins(text: bytes, k: int = SHINGLE) -> np.ndarray:
    """For each of the bits, by how many the distinct shingles that have it exceed those that don't."""
    return _margins_and_least(shingle_set(text, k))[0]


def _margins_and_least(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Margins of the bits, and twelve bits each of the least of all shingles' 32-bit hashes."""
    counts, least = np.zeros(WORDS * 64, np.int64), np.full(LEAST, (1 << 32) - 1, np.uint32)
    for i in range(0, len(h), 16384):
        s = streams(h[i : i + 16384])
        counts += bit_counts(s)
        least = np.minimum(least, s.view(np.uint32).min(axis=0)[:LEAST])
    return counts * 2 - len(h), (least & np.uint32(0xFFF)).astype(np.int64)


def odd_sketch(h: np.ndarray) -> np.ndarray:
    """Words of bits, each set if an odd number of the hashes fall on it: two sets differ in at least as many members as
    their sketches in bits."""
    at = (h * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(ODD * 64)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=ODD * 64) & 1 > 0, bitorder="little").view(np.int64)


def _codebook() -> np.ndarray:
    """4096 x 23: the codewords with bits as -1 and 1, lowest bit first."""
    return (((golay.codewords()[:, None] >> np.arange(23)) & 1).astype(np.float32) * 2 - 1)


def soft_indices(margins: np.ndarray, keep: int = CODEWORDS) -> np.ndarray:
    """Rows of segments x 23 margins, whole numbers, to rows of segments x keep indices: the codewords that agree best.

    Sums of whole numbers are exact, and of equal ones the smaller index goes first, so that reruns agree."""
    rows = margins.reshape(-1, 23).astype(np.float32)
    book = _codebook().T
    out = np.empty((len(rows), keep), np.int64)
    for i in range(0, len(rows), 1024):
        score = rows[i : i + 1024] @ book
        for j in range(keep):
            best = score.argmax(axis=1)
            out[i : i + 1024, j] = best
            score[np.arange(len(score)), best] = -np.inf
    return out.reshape(len(margins), -1, keep)


def packed_bits(margins: np.ndarray) -> np.ndarray:
    """Rows of 64-bit words: a bit is set where the margin is above zero."""
    return np.packbits(margins > 0, axis=1, bitorder="little").view(np.int64)


def packed_indices(indices: np.ndarray) -> np.ndarray:
    """Rows of segments x keep indices to rows of CODES words, twelve bits an index."""
    return _packed(indices.reshape(len(indices), -1))


def _packed(flat: np.ndarray) -> np.ndarray:
    out = np.zeros((len(flat), -(-flat.shape[1] // 5)), np.int64)
    for i in range(flat.shape[1]):
        out[:, i // 5] |= flat[:, i] << (i % 5 * 12)
    return out


def _index(segment: int, choice: int, of: str = "") -> F.Column:
    i = segment * CODEWORDS + choice
    return F.shiftright(f"{of}b{i // 5}", i % 5 * 12).bitwiseAND(F.lit(0xFFF))


def leasts(kind: int) -> tuple[int, int]:
    """The least hashes of a kind's keys; the second kind of a segment has others."""
    return (2 * kind, 2 * kind + 1) if kind < SEGMENTS else (2 * ((kind + 5) % SEGMENTS), 2 * ((kind + 9) % SEGMENTS) + 1)


def _least(kind: int, of: str = "") -> list[F.Column]:
    return [F.shiftright(f"{of}m{i // 5}", i % 5 * 12).bitwiseAND(F.lit(0xFFF)) for i in leasts(kind)]


def _key(kind: int, index: F.Column, least: bool, of: str = "") -> F.Column:
    key = F.lit(kind << 12).cast("long") + index
    return F.shiftleft(key, 24) + F.shiftleft(_least(kind, of)[0], 12) + _least(kind, of)[1] if least else key


def least_shared(kinds: list[int], choices: int, x: str, y: str, least: bool = False) -> F.Column:
    """The least of the keys of these kinds that two rows have in common; kinds are tried in turn, up to the first."""

    def common(segment: int) -> F.Column:
        mine, other = ([_index(segment, c, of) for c in range(choices)] for of in (x, y))
        found = [F.when(m.isin(*other), m) for m in mine]
        return F.least(*found) if choices > 1 else found[0]

    def shared(kind: int) -> F.Column:
        key = _key(kind, common(KINDS[kind][0]), least, x)
        (p, q), (r, s) = _least(kind, x), _least(kind, y)
        return F.when((p == r) & (q == s), key) if least else key

    return F.coalesce(*[shared(no) for no in sorted(kinds)])


def wide_keys(kinds: list[int], choices: int = CODEWORDS, least: bool = False) -> list[F.Column]:
    """The keys of these kinds over columns b0, b1, ...: a segment with each choice of its index; least: and the kind's
    two least hashes, from columns m0, m1, ..."""
    return [_key(no, _index(KINDS[no][0], c), least) for no in kinds for c in range(choices)]


def key_rounds() -> list[tuple[list[int], int]]:
    """Kinds and choices of the keys in the order in which they are joined: first a few that draw families together, then
    all kinds, some at a time, so that what is in one group already makes no rows later."""
    step = SEGMENTS // 2
    return [(list(range(step)), 1), *((list(range(i, i + step)), CODEWORDS) for i in range(0, len(KINDS), step))]


def several_met(rows: DataFrame) -> DataFrame:
    """key, total, most, lead of the buckets (rows of key, id, c) with members of several components c. total: the members;
    most: the component of most of them, lead: one of its members there; both null where all may meet as they are.

    Texts that are alike share many keys, so many buckets have the same members, which two 64-bit sums over their ids tell;
    of these the one with the least key stands for all. Two texts whose least common key is that of a bucket share no
    lesser one, so theirs is always left."""
    # partial sums a task: a bucket that all texts share is one row a task and component
    parts = rows.groupBy("key", "c").agg(F.count("*").alias("n"), F.bit_xor("id").alias("ids"), F.bit_xor(F.xxhash64("id")).alias("hashes"), F.min(F.struct(F.xxhash64("id", "key"), "id"))["id"].alias("lead"))
    largest = F.max(F.struct("n", "c", "lead"))
    buckets = parts.groupBy("key").agg(F.count("*").alias("parts"), F.sum("n").alias("total"), F.bit_xor("ids").alias("ids"), F.bit_xor("hashes").alias("hashes"), largest.alias("l")).where("parts > 1")
    one = buckets.groupBy("parts", "total", "ids", "hashes").agg(F.min(F.struct("key", "l")).alias("b"))
    crowded = F.col("total") > 2 * MANY
    return one.select("b.key", "total", *[F.when(crowded, F.col(f"b.l.{c}")).alias(name) for c, name in (("c", "most"), ("lead", "lead"))])


def _ordered(x: str, y: str) -> list[F.Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _digest(c) -> F.Column:
    return F.unhex(F.md5(F.coalesce(c, F.lit("")).cast("binary")))


#: Columns of a text's sketch: fingerprint, codewords' indices, least hashes, odd sketch, number of shingles.
SKETCH = [*(f"{c}{i}" for c, n in (("w", WORDS), ("b", CODES), ("m", LEASTS), ("o", ODD)) for i in range(n)), "size"]


def _sketched(base: DataFrame, k: int) -> DataFrame:
    """doc_id, digest and SKETCH for each row; texts without words have no fingerprint."""

    def sketch(texts):
        sets = [shingle_set(t, k) for t in texts]
        m, least = map(np.stack, zip(*map(_margins_and_least, sets), strict=True))
        odd, size = np.stack([odd_sketch(h) for h in sets]), np.array([[len(h)] for h in sets], np.int64)
        return np.concatenate([packed_bits(m), packed_indices(soft_indices(m[:, : SEGMENTS * 23])), _packed(least), odd, size], axis=1).tolist()

    def run(batches):
        memo: dict[bytes, tuple] = {}  # only a cache: copies in one task are sketched once
        for batch in batches:
            texts = utf8(batch)
            digests = [hashlib.md5(t).digest() for t in texts]
            new = {d: t for d, t in zip(digests, texts, strict=True) if d not in memo}
            some = {d: t for d, t in new.items() if t.split()}
            if len(memo) > 20_000:
                memo = {d: memo[d] for d in digests if d in memo}
            memo.update((d, (None,) * len(SKETCH)) for d in new if d not in some)
            if some:
                memo.update(zip(some, sketch(some.values()), strict=True))
            cols = list(zip(*(memo[d] for d in digests), strict=True)) or [()] * len(SKETCH)
            arrays = [batch.column("doc_id"), pa.array(digests, pa.binary()), *(pa.array(c, pa.int64()) for c in cols)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "digest", *SKETCH])

    small_batches(base.sparkSession)
    return base.mapInArrow(run, "doc_id long, digest binary, " + ", ".join(f"{c} long" for c in SKETCH))


def near_copies(docs: DataFrame, similarity: float = SIMILARITY, k: int = SHINGLE) -> DataFrame:
    """doc_id, digest, keeper, keeper_digest for each document that has an equal text or a near copy: rows of one keeper
    are one group, joined by links of at least `similarity` on sets of k-word shingles. The keeper is the group's
    smallest doc_id, then digest (MD5 of the text, null as empty).

    Equal texts are one class and one node, so copies are never expanded, and a doc_id that repeats with other texts is
    as many nodes. Keys are joined some kinds at a time; what they link is contracted before the next. Members of
    a crowded bucket meet its first member first; then each two members of a bucket that are in different components
    meet, whatever the bucket's size. So each pair that shares a key and differs in few enough bits is verified or in
    one group already. Texts without words are grouped only if equal. Rows without doc_id are in no group."""
    base = only(docs, doc_id="long", text="string").where("doc_id IS NOT NULL")
    members = written(_sketched(base, k))
    grouped = members.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), *[F.max(c).alias(c) for c in SKETCH])
    classes = written(grouped.withColumn("id", F.monotonically_increasing_id()))
    sketches = classes.where("w0 IS NOT NULL").select("id", "rep", "digest", *SKETCH)
    members = written(members.select("doc_id", "digest"), replaces=members)
    # only rows that repeat the doc_id and text of their class make a text appear twice
    repeats = not members.groupBy("doc_id", "digest").count().where("count > 1").isEmpty()

    def near(x: str, y: str) -> F.Column:
        """Whether the fingerprints of two rows differ in few enough bits, and no fewer shingles than their odd sketches
        differ in leave them similar enough: sets of a and b members have at most (a + b) (1 - s) / (1 + s) not in common."""

        def apart(word: str, n: int) -> F.Column:
            return sum((F.bit_count(F.col(f"{x}.{word}{i}").bitwiseXOR(F.col(f"{y}.{word}{i}"))) for i in range(n)), F.lit(0))

        most = (F.col(f"{x}.size") + F.col(f"{y}.size")) * F.lit((1 - similarity) / (1 + similarity)) + F.lit(1e-6)
        return (apart("w", WORDS) <= int(BITS_APART * WORDS * 64)) & (apart("o", ODD) <= most)

    def verified(pairs: DataFrame, n: int) -> DataFrame:
        """Those of the n pairs whose shingle sets are similar enough, from their whole texts."""
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        wanted = sketches.select("id", "rep", "digest").join(bounded(ids, 2 * n), "id", "left_semi")
        texts = base.join(bounded(wanted, 2 * n), (F.col("doc_id") == F.col("rep")) & (_digest(F.col("text")) == F.col("digest"))).select("id", "text")

        def sets(b):
            return {"id": b.column("id"), "s": [shingle_set(t, k).view(np.int64) for t in utf8(b)]}

        shingles = written(arrow_map(texts, sets, "id long, s array<long>"))
        if repeats:
            shingles = written(shingles.dropDuplicates(["id"]), replaces=shingles)
        hot = None
        left, one, on = pairs, shingles.select(F.col("id").alias("a"), F.col("s").alias("sa")), ["a"]
        if n > SPLIT:  # a text in very many pairs is dealt over several tasks
            hot = written(pairs.groupBy("a").count().where(F.col("count") > SPLIT).select("a", F.ceil(F.col("count") / SPLIT).cast("int").alias("parts")))
            deal = bounded(hot, n // SPLIT)
            part = F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"), F.lit(0))
            left, on = pairs.join(deal, "a", "left").select("a", "b", part.alias("part")), ["a", "part"]
            one = one.join(deal, "a", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        both = left.join(one, on).join(shingles.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b").select("a", "b", "sa", "sb")

        def judge(b):
            sa, sb = (b.column(c) for c in ("sa", "sb"))
            ok = np.zeros(b.num_rows, bool)
            for i in range(b.num_rows):
                x, y = sa[i].values.to_numpy(), sb[i].values.to_numpy()
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok[i] = common >= similarity * (len(x) + len(y) - common) - 1e-9
            return {"a": b.column("a"), "b": b.column("b"), "ok": ok}

        out = written(arrow_map(both, judge, "a long, b long, ok boolean").where("ok").select("a", "b"))
        for t in (shingles, hot):
            drop(t)
        return out

    def exploded(keys: list[F.Column], groups: DataFrame | None) -> DataFrame:
        """key, id, c, the sketch of all texts: c the component."""
        info = sketches.drop("rep", "digest")
        info = info.withColumn("c", F.col("id")) if groups is None else info.join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn("c", F.coalesce("component", "id"))
        return info.select(F.explode(F.array(*keys)).alias("key"), "id", "c", *SKETCH)

    def opened(rows: DataFrame) -> DataFrame | None:
        """rows with total and most of several_met(): of small buckets all members, of crowded ones the members outside the
        largest component and one of that. None: there is no bucket with several components."""
        several = written(several_met(rows))
        n = several.count()
        out = written(rows.join(bounded(several, n), "key").where("most IS NULL OR c <> most OR id = lead").drop("lead")) if n else None
        drop(several)
        return out

    def refreshed(rows: DataFrame, groups: DataFrame) -> DataFrame:
        """rows with the components as they are now; a component is named by one of its texts."""
        now = groups.select(F.col("node").alias("_of"), F.col("component").alias("_c"))
        after = rows
        for c, of in (("c", "id"), ("most", "most")):
            after = after.join(now, F.col(of) == F.col("_of"), "left").withColumn(c, F.coalesce("_c", of)).drop("_of", "_c")
        return written(after, replaces=rows)

    def crowding(rows: DataFrame) -> tuple[int, float]:
        """Members of the buckets, and their pairs across components, with those of the largest one that are not among rows."""
        outside = F.col("most").isNull() | (F.col("c") != F.col("most"))
        parts = rows.groupBy("key", "c").agg(F.sum(outside.cast("long")).alias("n"), F.max("total").alias("total"))
        parts = parts.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("square"), F.max("total").alias("t"))
        pairs = (F.col("n") * F.col("n") - F.col("square")) / 2 + F.col("n") * (F.col("t") - F.col("n"))
        return parts.agg(F.sum("t"), F.sum(pairs)).first()

    def first_met(rows: DataFrame, turn: int) -> DataFrame:
        """Pairs (a, b), a < b: members of a bucket with its first member, where that is of another component. At first that
        is one of the largest component, another one in each bucket."""
        order = F.struct(F.coalesce(F.col("c") != F.col("most"), F.lit(False)) if turn == 0 else F.xxhash64("id", "key", F.lit(turn)), F.col("id"))
        lead = rows.groupBy("key").agg(F.min_by(F.struct("id", "c", *SKETCH), order).alias("l")).select("key", "l.*")
        met = (F.col("x.key") == F.col("y.key")) & (F.col("x.c") != F.col("y.c")) & near("x", "y")
        return rows.alias("x").join(lead.alias("y"), met).select(*_ordered("x.id", "y.id")).distinct()

    def all_met(rows: DataFrame, texts: DataFrame, kinds: list[int], choices: int) -> DataFrame:
        """Pairs (a, b), a < b: all members of a bucket with all of its other components; rows: as opened, texts: exploded.
        Members outside the largest component meet each other, in large buckets block by block, and then the largest
        one's, which are read where they are. Two texts that share several of the keys meet in the bucket of the least, so
        each pair is made once."""
        once = near("x", "y") & (least_shared(kinds, choices, "x.", "y.", least=True) == F.col("x.key"))
        few = rows.where("most IS NULL OR c <> most")
        blocks = F.ceil(F.col("total") / BLOCK).cast("int")
        x = few.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        y = few.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
        same = (F.col("x.key") == F.col("y.key")) & (F.col("x.block") == F.col("y.block"))
        found = x.alias("x").join(y.alias("y"), same & (F.col("x.c") != F.col("y.c")) & (F.col("x.id") < F.col("y.id")) & once)
        found = found.select(*_ordered("x.id", "y.id"))
        left = few.where("most IS NOT NULL")
        if not (n := left.count()):
            return found
        members = (F.col("x.key") == F.col("y.key")) & (F.col("x.most") == F.col("y.c"))
        if n <= WIDE:
            left = F.broadcast(left)
        else:
            buckets = bounded(left.select("key", "total", F.col("most").alias("c")).distinct(), n)
            texts = texts.join(buckets, ["key", "c"]).withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
            left, members = left.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))), members & (F.col("x.block") == F.col("y.block"))
        return found.unionByName(texts.alias("y").join(left.alias("x"), members & once).select(*_ordered("x.id", "y.id")))

    groups, tried = None, None
    for no, (kinds, choices) in enumerate(key_rounds()):
        # the first keys only draw families together: the kinds they are of come again, with all choices
        seeds, whole, turn, helped = no == 0, False, 0, True
        keys = wide_keys(kinds, choices, least=True)
        if (rows := opened(exploded(keys, groups))) is None:
            continue
        while not whole:
            n, square = crowding(rows)
            whole = seeds or square <= MANY * n or turn >= ROUNDS or not helped
            found = first_met(rows, turn) if seeds or not whole else all_met(rows, exploded(keys, groups), kinds, choices)
            pairs = written(found if tried is None else found.join(tried, ["a", "b"], "left_anti"))
            helped = False
            if met := pairs.count():
                links = verified(pairs, met)
                tried = written(pairs if tried is None else tried.union(pairs), replaces=tried)
                helped = links.count() * 10 > met
                groups = _contracted(links, groups)
                drop(links)
                if not whole:
                    rows = refreshed(rows, groups)
            drop(pairs)
            turn += 1
        drop(rows)
    if groups is None:
        of = classes.select("digest", "rep", "n", F.col("id").alias("g"), F.lit(False).alias("near"))
    else:
        of = classes.join(groups, classes["id"] == groups["node"], "left").select("digest", "rep", "n", F.coalesce("component", "id").alias("g"), F.col("component").isNotNull().alias("near"))
    of = written(of.where("n > 1 OR near"))
    keepers = of.groupBy("g").agg(F.min(F.struct("rep", "digest")).alias("k"))
    named = written(of.join(keepers, "g").select("digest", F.col("k.rep").alias("keeper"), F.col("k.digest").alias("keeper_digest")))
    out = written(members.join(bounded(named, named.count()), "digest").select("doc_id", "digest", "keeper", "keeper_digest"))
    for t in (members, classes, groups, tried, of, named):
        drop(t)
    return out


def _contracted(links: DataFrame, groups: DataFrame | None) -> DataFrame:
    """groups (node, component) with the nodes and components that links join made one; the old table goes."""
    if groups is None:
        return written(components(links))
    of = groups.select("node", "component")
    edges = links
    for c in ("a", "b"):
        edges = edges.join(of.select(F.col("node").alias(c), F.col("component").alias("_c")), c, "left").withColumn(c, F.coalesce("_c", c)).drop("_c")
    joined = written(components(edges))
    moved = of.join(joined.select(F.col("node").alias("component"), F.col("component").alias("_to")), "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    fresh = joined.join(of.select("node"), "node", "left_anti").select("node", "component")
    out = written(moved.unionByName(fresh), replaces=groups)
    drop(joined)
    return out


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs without the members of near-copy groups other than one row each: the smallest doc_id (then digest) stays.

    Rows without doc_id all stay. Rows that repeat a doc_id with other texts are told apart by their texts; of rows that
    repeat a group's keeper whole, one stays."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    groups = near_copies(docs, similarity)
    lost = written(groups.where("doc_id <> keeper OR digest <> keeper_digest").select(F.col("doc_id").alias("_gw_id"), F.col("digest").alias("_gw_digest")).distinct())
    mine = F.col("doc_id").cast("long"), _digest(F.col("text").cast("string"))
    same = (mine[0] == F.col("_gw_id")) & (mine[1] == F.col("_gw_digest"))
    kept = docs.select(*names).join(bounded(lost, lost.count()), same, "left_anti")
    again = groups.where("doc_id = keeper AND digest = keeper_digest").groupBy("doc_id", "digest").count().where("count > 1")
    again = written(again.select(F.col("doc_id").alias("_gw_id"), F.col("digest").alias("_gw_digest")))
    n = again.count()
    if not n:
        return kept
    once = kept.join(bounded(again, n), same, "left_anti")
    twice = kept.join(bounded(again, n), same).dropDuplicates(["_gw_id", "_gw_digest"]).select(*names)
    return once.select(*names).unionByName(twice)
