from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from ionloom.llm import mixing, packing

from .helpers import empty, frame, odd_rows


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("extra", [False, True])
def test_pieces_put_together_are_the_documents(spark, tokenizer, extra):
    rows = odd_rows()
    got = packing.best_fit_packing(frame(spark, rows, extra=extra)).collect()
    want = sorted(str((r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0])) for r in rows)
    parts: dict = defaultdict(list)
    for r in got:
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r.length <= packing.CAPACITY and r.ids_crc32 == zlib.crc32(bytes(r["ids"]))
        parts[r.doc_id].append((r.piece, r.start, ids.tolist()))
    whole = []
    for key, own in parts.items():
        streams: list = []
        for piece, start, ids in sorted(own):
            if piece == 0:
                streams.append(list(ids))
        if all(p == 0 for p, _, _ in own):
            whole += [str((key, s)) for s in streams]
        else:
            assert len(streams) == 1
            for piece, start, ids in sorted(own)[1:]:
                assert start == len(streams[0]) and len(ids) == packing.CAPACITY
                streams[0] += ids
            whole.append(str((key, streams[0])))
    assert sorted(whole) == want


def test_sequences_are_gapless_and_few(spark):
    got = packing.best_fit_packing(frame(spark, odd_rows(n=400)), with_ids=False).toPandas()
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]]
        assert s["length"].sum() <= packing.CAPACITY
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // packing.CAPACITY) + 1


def test_encoders_agree(tokenizer):
    texts = ["", "a", "  x  y", " a \n b", "x" * 5000, " " * 3000, "don't you'll 12 345", "日本語 é ß", "<|endoftext|> z", "a b c", "\r\n\r\n x"]
    encode = packing.encoder(packing.vocabulary())
    for text, ids in zip(texts, encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60), st.integers(1, 8))
def test_best_fit_never_overfills(lengths, open_bins):
    where, offsets = packing.best_fit(lengths, 20, open_bins)
    used: dict = defaultdict(int)
    for n, b, o in zip(lengths, where, offsets, strict=True):
        assert used[b] == o
        used[b] += n
    assert all(v <= 20 for v in used.values())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=80), st.integers(1, 4))
def test_best_fit_is_that_of_plain_lists(lengths, open_bins):
    free: dict = {}
    want, n_bins = [], 0
    for need in lengths:
        b = min((x for x in free.items() if x[1] >= need), key=lambda x: x[1], default=None)
        if b is None:
            free[n_bins], n_bins = 20, n_bins + 1
            space = 20
        else:
            space = b[1]
        want.append(20 - space)
        own = [x for x in free if free[x] == space][-1]
        free[own] -= need
        free = {x: v for x, v in free.items() if v}
        if len(free) > open_bins:
            del free[[x for x in free if free[x] == min(free.values())][-1]]
    assert packing.best_fit(lengths, 20, open_bins)[1] == want


def test_the_bound_binds_and_one_document_meets_many_packers(spark):
    rows = [(1, "stone river " * 60_000, "en", "s", None)] + odd_rows(n=100) + [(None, "same", "en", "s", None)] * 300
    pieces = packing.token_pieces(frame(spark, rows)).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    got = packing.pack_pieces(pieces, 5, open_bins=2, ahead=8).toPandas()
    packers = got["sequence_id"] // (1 << 40)
    assert len(got) == pieces.count() and set(packers) == set(range(5))
    assert got[got["doc_id"] == 1].groupby(packers)["length"].count().max() < 30 and got[got["doc_id"].isna()].groupby(packers)["length"].count().max() < 150
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]] and s["length"].sum() <= packing.CAPACITY


def test_empty_tables(spark):
    assert packing.best_fit_packing(empty(spark)).count() == 0
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.apply_mix(empty(spark)).count() == 0


def _targets(sizes: dict) -> dict:
    """Shares by weight, the excess over three times a source's size dealt anew until none is above."""
    names = sorted((k for k in sizes if k is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: float(1 + i % 3) for i, s in enumerate(names)}
    total, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
        open_ -= over
    return target


@pytest.mark.parametrize("extra", [False, True])
def test_mix_meets_targets(spark, extra):
    rows = odd_rows(n=300)
    got = mixing.mix(frame(spark, rows, extra=extra)).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes: dict = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r[1])
    target = _targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(target[r["source"]]) and r.source_size == sizes[r["source"]]
        assert 0 <= r.copies <= 3 and (r["size"] or r.copies == 0)
        taken[r["source"]] += r.copies * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert len(got) == len(rows)
    for s, t in target.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1


def test_mix_does_not_depend_on_how_rows_lie(spark):
    rows = odd_rows(n=200)
    a = mixing.mix(frame(spark, rows, 2), fan_in=16).select("doc_id", "size", "copies").collect()
    b = mixing.mix(frame(spark, rows, 7), fan_in=16).select("doc_id", "size", "copies").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_pivot_keeps_the_words():
    sizes, shares = [7, 3, 10, 1, 4, 8], [0.3, 0.7, 0.5, 0.9, 0.2, 0.4]
    out, held, p = mixing.pivot(list(range(6)), sizes, shares, 0)
    total = sum(s * q for s, q in zip(sizes, shares, strict=True))
    kept = sum(s * o for s, o in zip(sizes, out, strict=True)) + (sizes[held] * p if held is not None else 0)
    assert kept == pytest.approx(total)


def test_pivot_is_fair():
    sizes, shares = [5, 9, 2, 6], [0.25, 0.5, 0.6, 0.4]
    seen = np.zeros(4)
    for seed in range(3000):
        out, held, p = mixing.pivot(list(range(4)), sizes, shares, seed)
        seen += out
        if held is not None:
            seen[held] += p
    assert np.abs(seen / 3000 - shares).max() < 0.04


def test_apply_mix_repeats_rows(spark):
    rows = odd_rows(n=100)
    d = frame(spark, rows, extra=True)
    left = mixing.apply_mix(d)
    assert left.columns == d.columns
    assert left.count() == sum(r.copies for r in mixing.mix(d).collect())


def test_many_rows_alike_are_shared_out(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ALIKE_ROWS", 7)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)  # sources come by the salted join
    rows = odd_rows(n=60) + [(None, "the same few words again", "en", "src1", None)] * 150 + [(7, "of one id", "en", None, None)] * 40
    got = mixing.mix(frame(spark, rows), fan_in=16).collect()
    assert len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r.copies * r["size"]
    for s, t in _targets(sizes).items():
        assert abs(taken[s] - t) <= max(r["size"] for r in got if r["source"] == s) / 2 + 1
    hot = [r.copies for r in got if r.doc_id is None and r["source"] == "src1"]
    assert len(hot) == 150 and max(hot) - min(hot) <= 1
    left = mixing.apply_mix(frame(spark, rows), fan_in=16)
    key = lambda x: sorted(map(str, x))
    assert key(r.doc_id for r in left.collect()) == key(r.doc_id for r in got for _ in range(r.copies))
