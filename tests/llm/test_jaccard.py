from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ionloom.llm import jaccard
from ionloom.llm.graphs import roots

from .helpers import empty, frame, jaccard_links, odd_rows


def _expected(rows):
    links = jaccard_links([r[1] for r in rows])
    count = [0] * len(rows)
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        count[a] += 1
        count[b] += 1
        x, y = find(a), find(b)
        if x != y:
            label[max(x, y)] = min(x, y)
    least: dict = {}
    for i, r in enumerate(rows):
        k = find(i)
        if r[0] is not None:
            least[k] = min(r[0], least.get(k, r[0]))
    return sorted((str(r[0]), least.get(find(i)), count[i]) for i, r in enumerate(rows))


@pytest.mark.parametrize("extra", [False, True])
def test_links_and_classes_are_those_of_all_pairs(spark, extra):
    rows = odd_rows()
    got = jaccard.jaccard_join(frame(spark, rows, extra=extra)).collect()
    assert sorted((str(r.doc_id), r.class_id, r.n_links) for r in got) == _expected(rows)


def test_large_groups_are_tiled_with_the_same_links(spark, monkeypatch):
    import random

    rng = random.Random(1)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(3):
            words[rng.randrange(200)] = f"v{rng.randrange(99)}"
        rows.append((i, " ".join(words), "en", "s", None))
    monkeypatch.setattr(jaccard, "BUCKET_TILE", 16)
    monkeypatch.setattr(jaccard, "VERIFY_TILE", 16)
    got = jaccard.jaccard_join(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.class_id, r.n_links) for r in got) == _expected(rows)


def test_empty_table(spark):
    assert jaccard.jaccard_join(empty(spark)).count() == 0
    assert jaccard.one_of_each(empty(spark)).count() == 0


def test_one_of_each_keeps_the_columns_and_a_row_for_each_class(spark):
    rows = odd_rows()
    d = frame(spark, rows, extra=True)
    left = jaccard.one_of_each(d)
    assert left.columns == d.columns
    assert sorted(map(str, left.select("doc_id", "text").collect())) == sorted(map(str, _kept(spark, rows)))


def _kept(spark, rows):
    """By all pairs: of each class the row of the smallest id, null last, then of the smallest hash."""
    import hashlib

    from pyspark.sql import Row

    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in jaccard_links([r[1] for r in rows]):
        x, y = find(a), find(b)
        label[max(x, y)] = min(x, y)
    best: dict = {}
    for i, r in enumerate(rows):
        order = (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest())
        best[find(i)] = min(best.get(find(i), (order, i)), (order, i))
    return [Row(doc_id=rows[i][0], text=rows[i][1]) for _, i in best.values()]


@pytest.mark.parametrize("ids", [[None, None, None], [7, 7, None], [7, 7, 7]])
def test_unrelated_documents_without_ids_of_their_own_all_stay(spark, ids):
    import random

    from .helpers import prose

    texts = [prose(random.Random(k), 60) for k in range(3)]
    rows = [(i, t, "en", "s", len(t)) for i, t in zip(ids, texts, strict=True)] + [(ids[0], texts[0] + " more", "en", "s", None)]
    got = jaccard.one_of_each(frame(spark, rows))
    assert got.count() == 3
    joined = jaccard.jaccard_join(frame(spark, rows)).collect()
    assert len({r.class_key for r in joined}) == 3 and sorted(r.n_links for r in joined) == [0, 0, 1, 1]


def test_very_large_buckets_are_tiled_by_their_counts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HELD_KEYS", 8)
    monkeypatch.setattr(jaccard, "BUCKET_TILE", 8)
    monkeypatch.setattr(jaccard, "VERIFY_BYTES", 4000)
    base = [f"w{k}" for k in range(100)]
    rows = [(i, " ".join([*base[: 40 + i % 7], f"v{i}", *base[40 + i % 7 :]]), "en", "s", None) for i in range(50)] + odd_rows()[:20]
    got = jaccard.jaccard_join(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.class_id, r.n_links) for r in got) == _expected(rows)


def test_the_rule_keeps_pairs_at_the_threshold():
    rule = jaccard.fewest_matches()
    rng = np.random.default_rng(0)
    equal = rng.random((4000, jaccard.VALUES)) < jaccard.THRESHOLD
    sig = np.zeros((2, jaccard.VALUES), np.uint8)
    kept = sum(len(jaccard.prune(np.stack([np.zeros(jaccard.VALUES, np.uint8), (~e).astype(np.uint8)]), np.array([0]), np.array([1]), rule)[0]) for e in equal[:400])
    assert kept == 400
    sig[1] = 1
    assert len(jaccard.prune(sig, np.array([0]), np.array([1]), rule)[0]) == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_roots_are_smallest_members(pairs):
    a, b = np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)
    got = roots(31, a, b)
    label = list(range(31))
    for _ in range(40):
        for x, y in pairs:
            label[x] = label[y] = min(label[x], label[y])
    assert got.tolist() == label


def test_shared_counts_are_intersections():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 30)).astype(np.uint64) for _ in range(12)]
    got = jaccard.shared_counts(sets, 16)
    for i in range(12):
        for j in range(12):
            if i != j:
                assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))
