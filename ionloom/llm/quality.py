"""Quality classifier: a factorisation machine over hashed words, structure statistics and length.

Every pair of features interacts through low-rank vectors; the sum-of-squares identity scores a document in time linear
in its features: 1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2).
"""

from __future__ import annotations

import zlib
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ionloom.llm.sampling import SAMPLE_ROWS, held_out, labelled_sample
from ionloom.llm.shared import record_batch, slices, small_batches, texts

WORD_BITS = 15
RANK = 8
BINS = 16
EPOCHS = 8
BATCH = 256
#: Score from which a document counts as good.
THRESHOLD = 0.3
_STATS = ("chars", "words", "word_length", "distinct", "runs", "upper", "digit", "symbol", "high", "lines", "line_repeats", "sentence")
N_FEATURES = (1 << WORD_BITS) + len(_STATS) * BINS

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_SYMBOL[[39, 44, 46]] = False  # ' , . are at home in prose


def statistics(raw: bytes, words: list[bytes], distinct: int) -> list[float]:
    """Each between 0 and 1."""
    n = max(1, len(raw))
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = raw.split(b"\n")
    high = int(seen[128:].sum())
    logs = lambda x: min(1.0, np.log1p(x) / 14)
    return [
        logs(n - int(seen[128:192].sum())), logs(len(words)), min(1.0, n / max(1, len(words)) / 24), distinct / max(1, len(words)),
        sum(map(eq, words, words[1:])) / max(1, len(words)), int(seen[_UPPER].sum()) / n, int(seen[_DIGIT].sum()) / n,
        int(seen[_SYMBOL].sum()) / n, high / n, min(1.0, len(lines) * 20 / n), 1 - len(set(lines)) / len(lines), min(1.0, int(seen[46]) / max(1, len(words))),
    ]


def features(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features; the words' values have length 1 together."""
    words = raw.lower().split()
    counts = Counter(words)
    mask = (1 << WORD_BITS) - 1
    index = np.fromiter((zlib.crc32(w) & mask for w in counts), np.int64, len(counts))
    value = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    if len(value):
        value /= np.sqrt((value * value).sum())
    stats = np.sqrt(np.clip(statistics(raw, words, len(counts)), 0, 1))  # finer where shares are small
    slot = np.minimum(BINS - 1, (stats * BINS).astype(np.int64))
    index = np.concatenate([index, (1 << WORD_BITS) + np.arange(len(slot)) * BINS + slot])
    return index, np.concatenate([value, np.full(len(slot), 0.5)]).astype(np.float32)


class FactorisationMachine:
    def __init__(self, bias: float, linear: np.ndarray, vectors: np.ndarray):
        self.bias, self.linear, self.vectors = bias, linear, vectors

    def raw(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores before the logistic function; vx for each feature; its sums for each document. No document is without features."""
        vx = self.vectors[index] * value[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat((vx * vx).sum(1), starts)
        return self.bias + np.add.reduceat(self.linear[index] * value, starts) + 0.5 * ((sums * sums).sum(1) - squares), vx, sums

    def score(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(index, value, starts)[0], -30, 30)))


def joined(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum([len(i) for i, _ in rows])[:-1]]).astype(np.int64)
    return np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]), starts


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 0, epochs: int = EPOCHS, rate: float = 0.02, decay: float = 1e-5) -> FactorisationMachine:
    """Adam on the logistic loss. With no rows, or one class, a constant: its share with one good and one bad row added."""
    rng = np.random.default_rng(seed)
    prior = (y.sum() + 1) / (len(y) + 2)
    theta = np.zeros((N_FEATURES, 1 + RANK), np.float32)
    bias = float(np.log(prior / (1 - prior)))
    model = FactorisationMachine(bias, theta[:, 0], theta[:, 1:])
    if len(set(y.tolist())) < 2:
        return model
    theta[:, 1:] = rng.normal(0, 0.05, (N_FEATURES, RANK))
    m, v, step = np.zeros_like(theta), np.zeros_like(theta), 0
    for _ in range(max(epochs, -(-120 * BATCH // len(rows)))):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            some = order[at : at + BATCH]
            index, value, starts = joined([rows[i] for i in some])
            out, vx, sums = model.raw(index, value, starts)
            g = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[some]).astype(np.float32) / len(some)
            each = np.repeat(g, np.diff(np.append(starts, len(index))))
            owner = np.repeat(np.arange(len(some)), np.diff(np.append(starts, len(index))))
            grad = np.empty_like(theta)
            grad[:, 0] = np.bincount(index, each * value, N_FEATURES)
            gv = (sums[owner] - vx) * (each * value)[:, None]
            for f in range(RANK):
                grad[:, 1 + f] = np.bincount(index, gv[:, f], N_FEATURES)
            grad += decay * theta
            step += 1
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            model.bias -= rate * float(g.sum())
    return model


_FEATURES = pa.schema([("y", pa.int32()), ("doc_id", pa.int64()), ("i", pa.binary()), ("v", pa.binary())])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = SAMPLE_ROWS, seed: int = 0) -> FactorisationMachine:
    """Learns from at most `bound` labelled documents outside the held-out fold."""

    def extract(batches):
        for batch in batches:
            found = [features(x) for x in texts(batch.column("text"))]
            yield record_batch(_FEATURES, y=batch.column("y").to_pylist(), doc_id=batch.column("doc_id").to_pylist(), i=[i.astype("<u4").tobytes() for i, _ in found], v=[v.tobytes() for _, v in found])

    rows = labelled_sample(docs, labels, label, bound).mapInArrow(extract, "y int, doc_id long, i binary, v binary").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.i)))
    got = [(np.frombuffer(bytes(r.i), "<u4").astype(np.int64), np.frombuffer(bytes(r.v), np.float32)) for r in rows]
    return train(got, np.array([r.y for r in rows], np.float32), seed)


def score(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """docs with a column score (0 to 1). Null and empty texts are scored as empty. All columns of docs stay."""
    packed = docs.sparkSession.sparkContext.broadcast((model.bias, model.linear.copy(), model.vectors.copy()))
    position = docs.schema.names.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches):
        machine = FactorisationMachine(*packed.value)
        for batch in batches:
            items, out = texts(batch.column(position)), []
            for lo, hi in slices([len(x) for x in items], 1 << 20):
                out.append(machine.score(*joined([features(x) for x in items[lo:hi]])))
            got = pa.array(np.concatenate(out) if out else [], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, "score"])

    return small_batches(docs).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bound: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Null and empty texts are scored like empty texts; a null doc_id is not held out. Repeated rows and ties score alike.
    Extra columns play no part. Without usable labels every score is the same.
    """
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = score(own, fit(docs, labels, bound=bound)).select("doc_id", "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bound: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs that score at least the threshold, with their columns; a column named score of theirs stays theirs."""
    model = fit(docs, labels, bound=bound)
    wrapped = docs.select(F.col("text").cast("string").alias("text"), F.struct(*docs.columns).alias("row"))
    return score(wrapped, model).where(F.col("score") >= threshold).select("row.*")
