"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Each passage is encoded (byte classes, word shapes, repetition); a
layer maps it to a vector; gated attention, tanh(hV) * sigmoid(hU), gives it a weight within its document; the weighted
mean of the vectors is scored. All weights are learned from document labels by gradient descent on the driver, on a
bounded sample of labelled documents; every document is then scored whole by the executors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, only, utf8, written

PASSAGE = 64
#: The classifier is fitted on so many labelled documents at most, those with the smallest hash of doc_id.
MAX_TRAIN = 3000
#: Passages of the sample that the driver takes in at most: 2**18 passages are 34 MB. A document that does not
#: fit in any more is left out, later ones that fit are not; scoring has no such bound.
MAX_PASSAGES = 1 << 18
HIDDEN, ATTENTION, STEPS, RATE, DECAY = 16, 8, 250, 0.03, 1e-4
#: Rows of the fold with remainder 0 are held out.
FOLDS, CUTOFF = 5, 0.3

#: Bytes of a class: letters, digits and space; each kind of sign that marks junk; the rest.
_CLASSES = [bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b" ", b"!", b"#*$%&", b"|<>", b".", b",", b"?;:'\"()-", b"/\\@_=+~^`[]{}", bytes(range(0x80, 0x100))]
_CLASS = np.full(256, len(_CLASSES), np.uint8)
for _i, _c in enumerate(_CLASSES):
    _CLASS[np.frombuffer(_c, np.uint8)] = _i
N_CLASSES = len(_CLASSES) + 1
DIM = N_CLASSES + 6


def encode(text: bytes) -> np.ndarray:
    """One row of DIM numbers for each passage of the whole text; a text without words is one row of zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros((1, DIM), np.float32)
    joined = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    size = np.fromiter(map(len, words), np.int64, n)
    starts = np.arange(0, n, PASSAGE)
    count = np.diff(np.append(starts, n)).astype(np.float32)
    lengths = np.add.reduceat(size + 1, starts)
    p = len(starts)
    flat = np.repeat(np.arange(p) * N_CLASSES, lengths) + _CLASS[joined]
    out = np.zeros((p, DIM), np.float32)
    out[:, :N_CLASSES] = np.bincount(flat, minlength=p * N_CLASSES).reshape(p, N_CLASSES) / lengths[:, None]
    out[:, N_CLASSES] = np.add.reduceat(size, starts) / count / 10
    distinct = [len(set(words[s : s + PASSAGE])) for s in starts.tolist()]
    # a passage of fewer words repeats less: compared with what a full one would have
    out[:, N_CLASSES + 1] = np.array(distinct, np.float32) / count
    out[:, N_CLASSES + 2] = np.log1p(count) / 4
    same = np.fromiter((a == b for a, b in zip(words, words[1:], strict=False)), np.float32, n - 1) if n > 1 else np.zeros(0, np.float32)
    out[:, N_CLASSES + 3] = np.add.reduceat(np.append(same, 0), starts) / count
    out[:, N_CLASSES + 4] = np.add.reduceat((size == 1).astype(np.float32), starts) / count
    out[:, N_CLASSES + 5] = np.add.reduceat((size > 20).astype(np.float32), starts) / count
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


class GatedAttention:
    """The model: arrays by name, and mean and scale of the encoding."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.w = w

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """x: passages of all documents in turn; starts: the first passage of each document."""
        w = self.w
        bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        z = (x - w["mean"]) / w["scale"]
        h = np.tanh(z @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        s = (t * g) @ w["a"]
        e = np.exp(s - np.maximum.reduceat(s, starts)[bag])
        weight = e / np.add.reduceat(e, starts)[bag]
        doc = np.add.reduceat(weight[:, None] * h, starts, axis=0)
        return {"z": z, "h": h, "t": t, "g": g, "weight": weight, "doc": doc, "bag": bag, "p": _sigmoid(doc @ w["c"] + w["d"])}

    def score(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return self.forward(x, starts)["p"]

    @classmethod
    def fit(cls, x: np.ndarray, starts: np.ndarray, y: np.ndarray, steps: int = STEPS) -> GatedAttention:
        """Full-batch Adam on cross-entropy from a fixed start, so that reruns agree."""
        rng = np.random.default_rng(7)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        model = cls({"mean": x.mean(0, dtype=np.float64), "scale": x.std(0, dtype=np.float64) + 1e-3, "W": draw(x.shape[1], HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, ATTENTION), "U": draw(HIDDEN, ATTENTION), "a": draw(ATTENTION), "c": draw(HIDDEN), "d": np.zeros(1)})
        w, n = model.w, len(y)
        learned = ("W", "b", "V", "U", "a", "c", "d")
        m, v = {k: np.zeros_like(w[k]) for k in learned}, {k: np.zeros_like(w[k]) for k in learned}
        for step in range(1, steps + 1):
            f = model.forward(x, starts)
            h, t, g, weight, bag = f["h"], f["t"], f["g"], f["weight"], f["bag"]
            dl = (f["p"] - y) / n
            ddoc = dl[:, None] * w["c"]
            dweight = (h * ddoc[bag]).sum(1)
            ds = weight * (dweight - np.add.reduceat(weight * dweight, starts)[bag])
            dgate = ds[:, None] * w["a"]
            dt, dg = dgate * g * (1 - t * t), dgate * t * g * (1 - g)
            dh = (weight[:, None] * ddoc[bag] + dt @ w["V"].T + dg @ w["U"].T) * (1 - h * h)
            grad = {"W": f["z"].T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "a": (t * g).T @ ds, "c": f["doc"].T @ dl, "d": dl.sum(keepdims=True)}
            for k in learned:
                q = grad[k] + DECAY * w[k]
                m[k] = 0.9 * m[k] + 0.1 * q
                v[k] = 0.999 * v[k] + 0.001 * q * q
                w[k] = w[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return model


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> GatedAttention | None:
    """The model from labelled rows outside the held-out fold; None if they don't show both labels.

    A doc_id that labels mark twice counts by its largest label; rows that repeat a doc_id among docs count each."""
    marks = only(labels, doc_id="long", quality="int").where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id")))
    chosen = marks.groupBy("doc_id").agg(F.max("quality").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    chosen = written(chosen)
    rows = only(docs, doc_id="long", text="string").join(F.broadcast(chosen), "doc_id")  # max_train rows at most

    def run(b):
        return {"doc_id": b.column("doc_id"), "y": b.column("y"), "x": [encode(t).tobytes() for t in utf8(b)]}

    bags, ys, n = [], [], 0
    coded = arrow_map(rows, run, "doc_id long, y int, x binary").orderBy(F.xxhash64("doc_id"), "doc_id", "x")
    for r in coded.toLocalIterator():
        x = np.frombuffer(bytes(r["x"]), np.float32).reshape(-1, DIM)
        if n + len(x) > MAX_PASSAGES:
            continue
        bags.append(x)
        ys.append(r["y"])
        n += len(x)
    if len(set(ys)) < 2:
        return None
    starts = np.cumsum([0, *map(len, bags)])[:-1]
    return GatedAttention.fit(np.concatenate(bags).astype(np.float64), starts, np.array(ys, float))


def scored(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """docs (doc_id, text only) with held_out, score, predicted for each row.

    The whole text is scored; null or empty text as a passage of zeros. Labels, lang, source and doc_id are no input of
    the score. Without a model (no or one-sided labels) each score is 0.5. Null doc_id: not held out."""
    model = train(docs, labels, max_train)
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else model.w)

    def run(b):
        texts = utf8(b)
        if shared.value is None or not texts:
            p = np.full(len(texts), 0.5)
        else:
            bags = [encode(t) for t in texts]
            p = GatedAttention(shared.value).score(np.concatenate(bags).astype(np.float64), np.cumsum([0, *map(len, bags)])[:-1])
        p = np.round(p, 9)
        return {"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "score": p, "predicted": (p >= CUTOFF).astype(np.int32)}

    rows = only(docs, doc_id="long", text="string").withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    return arrow_map(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of docs, all columns as they are, that the classifier scores at CUTOFF or more."""
    model = train(docs, labels, max_train)
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else model.w)
    names = docs.columns

    def run(batches):
        for b in batches:
            texts = utf8(b)
            if shared.value is not None and texts:
                bags = [encode(t) for t in texts]
                p = GatedAttention(shared.value).score(np.concatenate(bags).astype(np.float64), np.cumsum([0, *map(len, bags)])[:-1])
                b = b.filter(pa.array(np.round(p, 9) >= CUTOFF))
            yield b

    from .common import small_batches

    small_batches(docs.sparkSession)
    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, docs.schema)


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
