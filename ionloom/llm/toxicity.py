"""Toxicity: a linear-chain conditional random field tags toxic tokens; its marginals give scores and offsets.

Labels mark documents, so the training tokens are labelled first: in a toxic document, a token is toxic if its word or
one of its beginnings is found, significantly often, in toxic documents alone (near copies count once). The field is
trained on those tags. A text's score is a logistic function of its tokens' forward-backward marginals.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ionloom.llm.hashing import shingle_hashes
from ionloom.llm.sampling import held_out, labelled_sample
from ionloom.llm.shared import slices, small_batches, texts

FEATURE_BITS = 17
#: Features of a token; those that may mark it as toxic (not the shortest beginning, nor the ending).
FORMS, TELLING = 6, [0, 2, 3, 4]
#: Tokens that training passes through the chain at a time.
CHAIN_TOKENS = 400_000
#: A text counts as toxic from this score on, a token from this marginal on.
THRESHOLD = 0.5
BLOCK = 64
STEPS = 25
#: Labelled documents, at most, that the field is fitted on.
SAMPLE_ROWS = 5000
#: Words whose weights a Python worker remembers at a time.
MEMO_WORDS = 200_000

_STRIP = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~¿¡…“”‘’«»"
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def forms(token: bytes) -> list[int]:
    """Hashes of a token's features: its word in lower case without marks around it, its beginnings of 3 to 6 letters, its ending; 0 for what it hasn't."""
    word = token.decode("utf-8", "replace").lower().strip(_STRIP)
    if not word:
        return [0] * FORMS
    return [zlib.crc32(b"w" + word.encode()), *(zlib.crc32(f"p{n}{word[:n]}".encode()) if len(word) > n else 0 for n in (3, 4, 5, 6)), zlib.crc32(b"s" + word[-3:].encode())]


def slots(found: np.ndarray) -> np.ndarray:
    """Places of features in the weights; the last is for absent ones and stays 0."""
    return np.where(found == 0, 1 << FEATURE_BITS, found & ((1 << FEATURE_BITS) - 1)).astype(np.int64)


class Chain:
    """Two states, 0 clean and 1 toxic. Texts follow each other in one chain; a step into a new text forgets what was before."""

    def __init__(self, first: np.ndarray, step: np.ndarray):
        self.first, self.step = first, step  # exponentials of the start's and the transitions' weights

    def marginals(self, emission: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The probability that each token is toxic; expected transitions, summed.

        Forward-backward over blocks of BLOCK tokens at once: the blocks' matrix products first, then what enters and
        leaves each block, then the tokens inside.
        """
        n = len(emission)
        if not n:
            return np.zeros(0), np.zeros((2, 2))
        nb = -(-n // BLOCK)
        e = np.zeros(nb * BLOCK)
        e[:n] = np.clip(emission, -30, 30)
        reset = np.zeros(nb * BLOCK, bool)
        reset[starts[starts < n]] = True
        reset[n:] = True
        e, reset = np.exp(e.reshape(nb, BLOCK).T), reset.reshape(nb, BLOCK).T
        f, s = self.first, self.step
        m00, m10 = np.where(reset, f[0], s[0, 0]), np.where(reset, f[0], s[1, 0])
        m01, m11 = np.where(reset, f[1], s[0, 1]) * e, np.where(reset, f[1], s[1, 1]) * e
        p00, p01, p10, p11 = np.ones(nb), np.zeros(nb), np.zeros(nb), np.ones(nb)
        for t in range(BLOCK):
            p00, p01 = p00 * m00[t] + p01 * m10[t], p00 * m01[t] + p01 * m11[t]
            p10, p11 = p10 * m00[t] + p11 * m10[t], p10 * m01[t] + p11 * m11[t]
            scale = 1 / (p00 + p01 + p10 + p11)
            p00, p01, p10, p11 = p00 * scale, p01 * scale, p10 * scale, p11 * scale
        a0, a1 = np.empty(nb), np.empty(nb)
        b0, b1 = np.empty(nb), np.empty(nb)
        products = list(zip(p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist(), strict=True))
        x, y = 0.5, 0.5
        for k, (q00, q01, q10, q11) in enumerate(products):
            a0[k], a1[k] = x, y
            x, y = x * q00 + y * q10, x * q01 + y * q11
            x, y = x / (x + y), y / (x + y)
        x, y = 0.5, 0.5
        for k in range(nb - 1, -1, -1):
            b0[k], b1[k] = x, y
            q00, q01, q10, q11 = products[k]
            x, y = q00 * x + q01 * y, q10 * x + q11 * y
            x, y = x / (x + y), y / (x + y)
        alpha = np.empty((2, BLOCK + 1, nb))
        alpha[0, 0], alpha[1, 0] = a0, a1
        for t in range(BLOCK):
            a0, a1 = a0 * m00[t] + a1 * m10[t], a0 * m01[t] + a1 * m11[t]
            total = a0 + a1
            a0, a1 = a0 / total, a1 / total
            alpha[0, t + 1], alpha[1, t + 1] = a0, a1
        out = np.empty((BLOCK, nb))
        pairs = np.zeros((2, 2))
        for t in range(BLOCK - 1, -1, -1):
            up, down = alpha[1, t + 1] * b1, alpha[0, t + 1] * b0
            out[t] = up / (up + down)
            w00, w01 = alpha[0, t] * m00[t] * b0, alpha[0, t] * m01[t] * b1
            w10, w11 = alpha[1, t] * m10[t] * b0, alpha[1, t] * m11[t] * b1
            scale = np.where(reset[t], 0, 1 / (w00 + w01 + w10 + w11))
            pairs += [[(w00 * scale).sum(), (w01 * scale).sum()], [(w10 * scale).sum(), (w11 * scale).sum()]]
            b0, b1 = m00[t] * b0 + m01[t] * b1, m10[t] * b0 + m11[t] * b1
            total = b0 + b1
            b0, b1 = b0 / total, b1 / total
        return out.T.ravel()[:n], pairs


class Tagger:
    """The field's weights, and those of the score: bias, log of expected toxic tokens, largest marginal."""

    def __init__(self, weights: np.ndarray, first: np.ndarray, step: np.ndarray, score: np.ndarray):
        self.weights, self.chain, self.score_weights = weights, Chain(first, step), score
        self.memo: dict[bytes, float] = {}

    def emissions(self, tokens: list[bytes]) -> np.ndarray:
        memo, weights = self.memo, self.weights
        if len(memo) > MEMO_WORDS:
            memo.clear()
        fresh = [w for w in set(tokens) if w not in memo]
        if fresh:
            found = slots(np.array([forms(w) for w in fresh], np.uint32))
            memo.update(zip(fresh, weights[found].sum(1).tolist(), strict=True))
        return np.array([memo[w] for w in tokens], np.float64)

    def tag(self, items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all tokens in turn, and the first token of each text (one more than texts)."""
        words = [x.split() for x in items]
        starts = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        emission = self.emissions([w for ws in words for w in ws])
        return self.chain.marginals(emission, starts[:-1])[0], starts

    def score(self, marginals: np.ndarray, starts: np.ndarray) -> np.ndarray:
        z = aggregated(marginals, starts) @ self.score_weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def aggregated(marginals: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each text: 1, log(1 + expected toxic tokens), the largest marginal. Without tokens, 1, 0, 0."""
    x = np.zeros((len(starts) - 1, 3))
    x[:, 0] = 1
    some = np.diff(starts) > 0
    if some.any():
        at = starts[:-1][some]
        x[some, 1] = np.log1p(np.add.reduceat(marginals, at))
        x[some, 2] = np.maximum.reduceat(marginals, at)
    return x


def without_copies(items: list[bytes], most_shared: float = 0.3) -> list[int]:
    """Places of texts that share few shingles with those before them."""
    seen: set[int] = set()
    out = []
    for lo, hi in slices([len(x) for x in items]):
        hashes, starts = shingle_hashes(items[lo:hi])
        for i in range(hi - lo):
            own = hashes[starts[i] : starts[i + 1]].tolist()
            if sum(h in seen for h in own) <= most_shared * len(own):
                out.append(lo + i)
                seen.update(own)
    return out


def toxic_words(found: np.ndarray, documents: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Which words have a form that is found in toxic texts so much more than in others that chance among all forms is out of the question.

    found: the forms of each word; documents: the distinct words of each text.
    """
    telling = found[:, TELLING]
    names, place = np.unique(telling, return_inverse=True)
    place = place.reshape(telling.shape)
    toxic, clean = np.zeros(len(names)), np.zeros(len(names))
    for own, label in zip(documents, y, strict=True):
        (toxic if label else clean)[np.unique(place[own])] += 1
    share = y.sum() / len(y)
    p = toxic / np.maximum(1, toxic + clean)
    with np.errstate(divide="ignore", invalid="ignore"):
        # log-likelihood ratio against what the classes' sizes make likely
        gain = np.where(toxic > 0, toxic * np.log(p / share), 0) + np.where(clean > 0, clean * np.log((1 - p) / (1 - share)), 0)
    signs = (p >= 0.8) & (p > share) & (gain > np.log((toxic > 0).sum() + 1) + 3) & (names != 0)
    return signs[place].any(1)


def train(items: list[bytes], y: np.ndarray, steps: int = STEPS, rate: float = 0.3) -> Tagger:
    """Adam on the field's log-likelihood, then a logistic regression on its marginals. Without both classes, a constant score."""
    size = 1 << FEATURE_BITS
    weights, theta = np.zeros(size + 1), np.zeros(6)  # first 2, step 4
    share = (y.sum() + 1) / (len(y) + 2)
    constant = Tagger(weights, np.ones(2), np.ones((2, 2)), np.array([np.log(share / (1 - share)), 0.0, 0.0]))
    if len(set(y.tolist())) < 2:
        return constant
    kept = without_copies(items)
    y = y[kept]
    if len(set(y.tolist())) < 2:
        return constant
    vocabulary: dict[bytes, int] = {}
    words = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in items[i].split()], np.int32) for i in kept]
    found = np.array([forms(w) for w in vocabulary], np.uint32).reshape(-1, FORMS)
    del vocabulary
    ids, lengths = np.concatenate(words), np.array([len(w) for w in words])
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    if not len(ids):
        return constant
    marked = toxic_words(found, [np.unique(w) for w in words], y)
    slot = slots(found)
    del found, words
    gold = marked[ids] & np.repeat(y.astype(bool), lengths)
    inside = np.ones(len(ids), bool)
    inside[starts[:-1][lengths > 0]] = False
    before = np.flatnonzero(inside) - 1
    counted = np.bincount(gold[before] * 2 + gold[before + 1], minlength=4).astype(float)
    del before
    at_first = np.bincount(gold[~inside].astype(int), minlength=2).astype(float)
    cuts = [0, *(np.searchsorted(starts, np.arange(CHAIN_TOKENS, starts[-1], CHAIN_TOKENS))).tolist(), len(lengths)]

    def passed(chain: Chain) -> tuple[np.ndarray, np.ndarray]:
        """Marginals and transitions of all texts, some at a time."""
        of_word, p, pairs = weights[slot].sum(1), np.empty(len(ids)), np.zeros((2, 2))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            a, b = starts[lo], starts[hi]
            p[a:b], own = chain.marginals(of_word[ids[a:b]], starts[lo:hi] - a)
            pairs += own
        return p, pairs

    scale = 1 / max(1, gold.sum())
    m, v = np.zeros(size + 6), np.zeros(size + 6)
    for k in range(1, steps + 1):
        p, pairs = passed(Chain(np.exp(theta[:2]), np.exp(theta[2:].reshape(2, 2))))
        by_word = np.bincount(ids, p - gold, len(slot))
        of_slot = np.zeros(size + 1)
        for c in range(FORMS):
            of_slot += np.bincount(slot[:, c], by_word, size + 1)
        first = np.array([(1 - p[~inside]).sum(), p[~inside].sum()])
        grad = np.concatenate([of_slot[:size], first - at_first, pairs.ravel() - counted]) * scale
        grad[:size] += 1e-4 * weights[:size]
        m += 0.1 * (grad - m)
        v += 0.05 * (grad * grad - v)
        move = rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.95**k)) + 1e-6)
        weights[:size] -= move[:size]
        theta -= move[size:]
    tagger = Tagger(weights, np.exp(theta[:2]), np.exp(theta[2:].reshape(2, 2)), np.zeros(3))
    x, w = aggregated(passed(tagger.chain)[0], starts), np.array([np.log(share / (1 - share)), 0.0, 0.0])
    for _ in range(50):  # Newton steps on the penalised logistic loss
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (q * (1 - q))[:, None]).T @ x + 0.05 * np.eye(3)
        w -= np.linalg.solve(hessian, x.T @ (q - y) + 0.05 * w)
    tagger.score_weights = w
    return tagger


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = SAMPLE_ROWS) -> Tagger:
    """Learns from at most `bound` labelled documents outside the held-out fold."""
    rows = labelled_sample(docs, labels, label, bound).collect()
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return train([r.text.encode() for r in rows], np.array([r.y for r in rows], np.int64))


def spans(raw: bytes, marginals: np.ndarray, threshold: float) -> list[dict]:
    """Runs of toxic tokens: from and to in code points, and the largest marginal."""
    out: list[dict] = []
    prior = -2
    for k, m in enumerate(_WORD.finditer(raw)):
        if marginals[k] < threshold:
            continue
        end = len(raw[: m.end()].decode("utf-8", "replace"))
        if k == prior + 1:
            out[-1]["end"], out[-1]["probability"] = end, max(out[-1]["probability"], float(marginals[k]))
        else:
            out.append({"begin": len(raw[: m.start()].decode("utf-8", "replace")), "end": end, "probability": float(marginals[k])})
        prior = k
    return out


SPAN = "array<struct<begin:long,end:long,probability:double>>"


def score(docs: DataFrame, tagger: Tagger, threshold: float = THRESHOLD, with_spans: bool = True) -> DataFrame:
    """doc_id, score, n_toxic (tokens), toxic_spans for each row. Null texts are scored as empty."""
    sent = docs.sparkSession.sparkContext.broadcast((tagger.weights.astype(np.float32), tagger.chain.first, tagger.chain.step, tagger.score_weights))
    span_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    def run(batches):
        own = Tagger(*sent.value)
        for batch in batches:
            items, keys = texts(batch.column("text")), batch.column("doc_id")
            for lo, hi in slices([len(x) for x in items], 1 << 20):
                p, starts = own.tag(items[lo:hi])
                toxic = np.concatenate([[0], np.cumsum(p >= threshold)])
                n_toxic = toxic[starts[1:]] - toxic[starts[:-1]]
                found = [spans(items[lo + i], p[starts[i] : starts[i + 1]], threshold) if with_spans and n_toxic[i] else [] for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo), pa.array(own.score(p, starts)), pa.array(n_toxic, pa.int64()), pa.array(found, span_type)], names=["doc_id", "score", "n_toxic", "toxic_spans"])

    own = small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return own.mapInArrow(run, f"doc_id long, score double, n_toxic long, toxic_spans {SPAN}")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bound: int = SAMPLE_ROWS, with_spans: bool = True) -> DataFrame:
    """doc_id, held_out, score, predicted, n_toxic, toxic_spans for every row of docs.

    Null and empty texts score as texts without tokens; a null doc_id is not held out. Repeated rows score alike. Extra
    columns play no part. Without usable labels every score is the same. Texts of any length are tagged whole.
    """
    scored = score(docs, fit(docs, labels, bound=bound), threshold, with_spans)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_toxic", "toxic_spans")
