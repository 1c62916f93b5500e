from __future__ import annotations

import math
import random
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ionloom.llm import bilinear, language_model, quality, toxicity

from .helpers import empty, frame, odd_rows, prose

LABELS = "doc_id long, quality int, toxic int"


def _labelled(n=700):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        bad, toxic = i % 5 == 0, i % 7 == 0
        words = prose(rng, rng.randrange(30, 90)).split()
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                words[rng.randrange(len(words))] = rng.choice(["vilefool", "grimscum", "vilefools", "GRIMSCUM,"])
        if bad:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), "en", "s", None))
        labels.append((i, int(not bad), int(toxic)))
    return rows, labels


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_held_out_accuracy(spark, operator):
    rows, labels = _labelled()
    got = operator.classify(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    truth = {i: (q if operator is quality else t) for i, q, t in labels}
    out = [r for r in got if r.held_out]
    assert {r.doc_id for r in out} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == truth[r.doc_id] for r in out]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_labels_of_the_held_out_fold_change_nothing(spark, operator):
    rows, labels = _labelled(200)
    turned = [(i, 1 - q, 1 - t) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, q, t) for i, q, t in labels]
    score = lambda x: {r.doc_id: r.score for r in operator.classify(frame(spark, rows), spark.createDataFrame(x, LABELS)).collect()}
    assert score(labels) == pytest.approx(score(turned))


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_odd_documents_and_labels(spark, operator):
    rows = odd_rows()
    labels = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 1, 0), (2, 0, 1), (3, 0, 1), (4, 1, 0), (999, 1, 0)], LABELS)
    got = operator.classify(frame(spark, rows, extra=True), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert operator.classify(empty(spark), labels).count() == 0
    none = operator.classify(frame(spark, rows), labels.limit(0)).collect()
    assert len({r.score for r in none}) == 1


def test_rejected_rows_go_and_columns_stay(spark):
    rows, labels = _labelled(300)
    d = frame(spark, rows, extra=True)
    left = quality.keep_good(d, spark.createDataFrame(labels, LABELS))
    assert left.columns == d.columns
    ids = {r.doc_id for r in left.collect()}
    assert {i for i, q, _ in labels if q} <= ids and len(ids) < len(rows)


def test_sum_of_squares_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    m = quality.FactorisationMachine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    index, value = np.array([3, 9, 20, 41]), rng.normal(size=4)
    plain = 0.3 + (m.linear[index] * value).sum() + sum(m.vectors[index[i]] @ m.vectors[index[j]] * value[i] * value[j] for i in range(4) for j in range(i + 1, 4))
    assert m.raw(index, value, np.array([0]))[0][0] == pytest.approx(plain)


@pytest.mark.parametrize("n", [1, 5, 63, 64, 65, 400])
def test_marginals_are_those_of_the_plain_recursion(n):
    rng = np.random.default_rng(n)
    chain = toxicity.Chain(np.exp(rng.normal(size=2)), np.exp(rng.normal(size=(2, 2))))
    e = rng.normal(size=n) * 2
    starts = np.unique(np.concatenate([[0], rng.integers(0, n, n // 20)]))
    got, pairs = chain.marginals(e, starts)
    counted = np.zeros((2, 2))
    for a, b in zip(starts, np.append(starts[1:], n), strict=True):
        k = b - a
        alpha, beta = np.zeros((k, 2)), np.ones((k, 2))
        factor = np.stack([np.ones(k), np.exp(e[a:b])], 1)
        alpha[0] = chain.first * factor[0]
        for t in range(1, k):
            alpha[t] = (alpha[t - 1] @ chain.step) * factor[t]
        for t in range(k - 2, -1, -1):
            beta[t] = chain.step @ (factor[t + 1] * beta[t + 1])
        z = alpha[-1].sum()
        assert got[a:b] == pytest.approx(alpha[:, 1] * beta[:, 1] / z)
        for t in range(k - 1):
            counted += alpha[t][:, None] * chain.step * (factor[t + 1] * beta[t + 1])[None, :] / z
    assert pairs == pytest.approx(counted)


def test_spans_are_where_the_words_stand(spark):
    rows, labels = _labelled()
    got = toxicity.classify(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        for s in r.toxic_spans:
            assert all("vile" in w.lower() or "grim" in w.lower() for w in texts[r.doc_id][s.begin : s.end].split())
    assert sum(r.n_toxic for r in got) > 100


def _words(text):
    return (text or "").encode().lower().split()


@pytest.mark.parametrize("extra", [False, True])
def test_base_and_counts(spark, extra, monkeypatch):
    monkeypatch.setattr(language_model, "KNOWN_WORDS", 40)  # most words come by the join
    rows = odd_rows()
    got = language_model.score(frame(spark, rows, extra=extra)).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts: Counter = Counter()
    for r in rows:
        if not held(r[0]):
            counts.update(_words(r[1]))
            counts[b""] += 1
    n, v = sum(counts.values()), len(counts)
    want = []
    for r in rows:
        own = [*_words(r[1]), b""]
        want.append((str(r[0]), held(r[0]), len(own), sum(counts[w] > 0 for w in own), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), 6)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    assert all(r.score < 0 for r in got)


def test_model_is_normalised_and_beats_the_base(spark):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        own = WORDS_A if i % 2 else WORDS_B
        rows.append((i, " ".join(rng.choice(own) for _ in range(60)), "en", "s", None))
    got = [r for r in language_model.score(frame(spark, rows)).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


WORDS_A = [f"al{k}ing" for k in range(90)]
WORDS_B = [f"be{k}ung" for k in range(90)]


def _model(n, seed=1):
    rng = np.random.default_rng(seed)
    model = bilinear.LogBilinear(rng.integers(0, 50, n))
    trainer = bilinear.Trainer(model, seed)
    for _ in range(20):
        trainer.step(*(rng.integers(0, n, 300) for _ in range(3)))
    model.ready()
    return model


@pytest.mark.parametrize("n", [1, 2, 7, 150, 1000])
def test_probabilities_are_those_of_the_plain_definition_and_add_up(n):
    model = _model(n)
    context, near, far, upper, upper_bias, target, bias = (p.astype(float) for p in model.parameters)
    rng = np.random.default_rng(0)
    for two, one in rng.integers(0, n, (5, 2)):
        q = context[two] @ far + context[one] @ near
        want = np.empty(n)
        groups = [math.exp(q @ upper[g] + upper_bias[g]) for g in range(len(upper))]
        for s in range(n):
            place = model.position[s]
            g = place // model.size
            members = range(g * model.size, min(n, (g + 1) * model.size))
            want[s] = math.log(groups[g] / sum(groups)) + math.log(math.exp(q @ target[place] + bias[place]) / sum(math.exp(q @ target[k] + bias[k]) for k in members))
        got = model.log_probabilities(np.full(n, two), np.full(n, one), np.arange(n))
        assert got == pytest.approx(want, abs=1e-4) and np.exp(got).sum() == pytest.approx(1.0, abs=1e-5)


def test_an_untrained_model_is_the_unigram_one():
    counts = np.random.default_rng(2).integers(0, 90, 500)
    model = bilinear.LogBilinear(counts)
    model.ready()
    got = model.log_probabilities(np.zeros(500, int), np.zeros(500, int), np.arange(500))
    assert np.exp(got) == pytest.approx((counts + 1) / (counts + 1).sum(), rel=1e-3)


def test_noise_contrastive_training_finds_a_pattern():
    rng, n = np.random.default_rng(3), 300
    model = bilinear.LogBilinear(np.full(n, 100))
    trainer = bilinear.Trainer(model)
    for _ in range(400):
        one, two = rng.integers(0, n, (2, 1024))
        trainer.step(two, one, (one + 1) % n)
    model.ready()
    one = np.arange(n)
    p = np.exp(model.log_probabilities(rng.integers(0, n, n), one, (one + 1) % n))
    assert np.median(p) > 0.3  # by chance 0.003


def test_scores_are_those_of_a_plain_loop(spark, monkeypatch):
    """Token by token, with the trained model's parameters and counters of words and pairs."""
    monkeypatch.setattr(language_model, "KNOWN_WORDS", 60)
    monkeypatch.setattr(language_model, "KNOWN_PAIRS", 50)
    monkeypatch.setattr(language_model, "FEWEST_OWN", 30)
    monkeypatch.setattr(language_model, "MAP_BITS", 1 << 12)
    held = {}
    whole = language_model.trained
    monkeypatch.setattr(language_model, "trained", lambda docs, own, endings, counts: held.update(model=whole(docs, own, endings, counts), own=own, endings=endings) or held["model"])
    rows = odd_rows()
    got = language_model.score(frame(spark, rows)).collect()
    model, symbols = held["model"], language_model.Symbols(held["own"], held["endings"])
    model.ready()
    train = [[*_words(r[1]), b""] for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in t)
    pairs = Counter((a, b) for t in train for a, b in zip([b"", *t], t, strict=False))
    followers: dict = defaultdict(Counter)
    for (a, b), c in pairs.items():
        if c >= language_model.LEAST_PAIR:
            followers[a][b] = c
    symbol = lambda w: symbols[w] if w else symbols.end
    tokens, kinds = Counter(), Counter()
    for w, c in counts.items():
        tokens[symbol(w)] += c
        kinds[symbol(w)] += 1
    in_memory = {w for w, _ in zip(*language_model.frequent(spark.createDataFrame([(bytearray(w), c) for w, c in counts.items()], "word binary, c long"), 60), strict=True)}
    assert len(counts) > len(in_memory)
    want = []
    for r in rows:
        total, two, one, last = 0.0, symbols.end, symbols.end, b""
        for w in [*_words(r[1]), b""]:
            s = symbol(w)
            p = math.exp(model.log_probabilities(np.array([two]), np.array([one]), np.array([s]))[0])
            if s > symbols.end:
                p *= (counts[w] + 1) / max(1, tokens[s] + kinds[s] + 1)
            after = followers[last] if last in in_memory else {}
            weight = len(after) + 2 * (counts[last] - sum(after.values())) if after else 1
            total += math.log10((weight * p + after.get(w, 0)) / (weight + sum(after.values()))) if after else math.log10(p)
            two, one, last = one, s, w
        want.append((str(r[0]), round(total, 2)))
    close = sorted((str(r.doc_id), r.score) for r in got)
    assert [k for k, _ in close] == [k for k, _ in sorted(want)]
    assert [x for _, x in close] == pytest.approx([x for _, x in sorted(want)], abs=0.02)


@pytest.mark.parametrize("times", [1, 10**6])
def test_each_pass_takes_every_token_once_whatever_the_size(spark, monkeypatch, tmp_path, times):
    steps, folder = language_model._steps, str(tmp_path)

    def noted(trainer, held):
        with open(f"{folder}/{uuid.uuid4()}", "w") as out:
            out.write(str(sum(len(h[0]) for h in held)))
        steps(trainer, held)

    monkeypatch.setattr(language_model, "_steps", noted)
    rows = [(i, " ".join(["aa", "bb", "cc"] * 400), "en", "s", None) for i in range(30)]
    language_model.trained(frame(spark, rows), [b"aa", b"bb"], [b"cc"], times * np.array([12_000, 12_000, 30, 12_000, 0]), passes=2)
    assert sum(int(p.read_text()) for p in tmp_path.iterdir()) == 2 * 30 * 1201


def test_no_training_text(spark):
    assert language_model.score(empty(spark)).count() == 0
    lone = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = language_model.score(frame(spark, [(lone, "only held out", "en", "s", None)])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (4, 0, 0) and r.base_score == 0.0


def test_contexts_of_words_outside_the_symbols_count(spark, monkeypatch):
    # 400 words alike in ending, each always followed by the next one: none of them has a symbol of its own that tells
    rows = [(i, " ".join(f"q{(i * 37 + k) % 400}zz" for k in range(60)), "en", "s", None) for i in range(300)]
    scored = lambda: {r.doc_id: r for r in language_model.score(frame(spark, rows)).collect()}
    got = scored()
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) / sum(r.n_tokens for r in held) > -0.5
    monkeypatch.setattr(language_model, "KNOWN_PAIRS", 0)  # all pairs come by the join
    assert {i: r.score for i, r in scored().items()} == pytest.approx({i: r.score for i, r in got.items()}, abs=1e-4)


def test_probabilities_of_short_texts_add_up(spark, monkeypatch):
    monkeypatch.setattr(language_model, "KNOWN_WORDS", 3)
    monkeypatch.setattr(language_model, "KNOWN_PAIRS", 3)
    ids = [i for i in range(9000) if zlib.crc32(str(i).encode()) % 7 == 2]
    rng, words = random.Random(4), ["aa", "bb", "cc", "dd"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(3))), "en", "s", None) for i in range(400) if i not in ids]
    tried = ["", *words, *[f"{a} {b}" for a in words for b in words], *[f"{a} {b} {c}" for a in words for b in words for c in words]]
    got = [r.score for r in language_model.score(frame(spark, rows + [(i, t, "en", "s", None) for i, t in zip(ids, tried, strict=False)])).collect() if r.held_out]
    assert len(got) == len(tried) and 0.8 < sum(10**x for x in got) <= 1


def test_lookups_of_pairs_travel_packed(spark, monkeypatch):
    """One row of Spark for a task's pairs in a bucket, not one for each token."""
    monkeypatch.setattr(language_model, "KNOWN_PAIRS", 0)  # all pairs are looked up in buckets
    monkeypatch.setattr(language_model, "PAIR_TOKENS", 4096)
    held, kept = {}, language_model.kept
    monkeypatch.setattr(language_model, "kept", lambda df, what: held.setdefault(what, kept(df, what)))
    rows = [(i, " ".join(f"w{(i * 7 + k) % 50}" for k in range(60)), "en", "s", None) for i in range(300)]
    got = language_model.score(frame(spark, rows)).collect()
    n_tokens, partial = sum(r.n_tokens for r in got), held["lm-partial"]
    asked = partial.where("bucket is not null").selectExpr("count(*) n", "sum(length(key)) / 8 keys").first()
    buckets = 1 + got[0].train_tokens // 4096
    assert n_tokens == 300 * 61 and buckets > 1
    assert asked.keys > 0.8 * n_tokens and asked.n <= buckets * partial.rdd.getNumPartitions() * 4 < n_tokens / 20


def test_tokens_are_those_of_a_plain_loop():
    items = ["", "A", "a Bc", " \t x\x0by ", "\u00a0\u00c9t\u00e9 \u00e9", "end\n", "z\x1cq 12"]
    raw = [x.encode() for x in items]
    parts = language_model.Texts(raw)
    words = [w for x in raw for w in (*language_model.tokens(x), b"")]
    assert parts.size.tolist() == [len(language_model.tokens(x)) + 1 for x in raw]
    assert language_model.words_at(parts, np.arange(len(words))).to_pylist() == words
    assert parts.hash.tolist() == language_model.hashes_of(words).tolist()
    symbols = language_model.Symbols([b"a", b"bc"], [b"x", b"12", "\u00e9".encode()])
    assert symbols.by_code()[parts.codes()].tolist() == [symbols.by_ending(w) for w in words if w]
    known = [b"bc", b"", b"x"]
    assert language_model.Places(language_model.hashes_of(known)).of(parts.hash).tolist() == [known.index(w) if w in known else -1 for w in words]
