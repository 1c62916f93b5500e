from __future__ import annotations

import hashlib
import random
import subprocess
import sys

import numpy as np
import pytest

from ionloom.llm import suffixes

from .helpers import empty, frame, odd_rows, repeats_removed


def _check(spark, rows, most=suffixes.CONTEXT_ROWS, **kind):
    want = repeats_removed(rows)
    got = suffixes.remove_repeats(frame(spark, rows, **kind), most=most).collect()
    assert len(got) == len(rows)
    texts: dict = {}
    for r in rows:
        texts.setdefault(r[0], []).append(r[1] or "")
    for r in got:
        options = [want[r.doc_id, t] for t in texts[r.doc_id]]
        assert any(bytes(r.kept) == k and r.n_spans == s and r.n_removed == r.n_bytes - len(k) for k, s in options)
        assert r.kept_sha256 == hashlib.sha256(bytes(r.kept)).hexdigest()
        assert len(r.spans) == r.n_spans and sum(s.end - s.begin for s in r.spans) == r.n_removed


@pytest.mark.parametrize("extra", [False, True])
def test_odd_documents(spark, extra):
    _check(spark, odd_rows(), extra=extra)


def test_planted_passages_and_self_repeats(spark):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    p, q = text(150), text(100)
    rows = [(i, text(rng.randrange(0, 400)) + rng.choice([p, q, p[20:140], p + q, ""]) + text(rng.randrange(0, 200)), "en", "s", None) for i in range(40)]
    rows += [(50, "a" * 350, "en", "s", None), (51, (text(99) + "|") * 1, "en", "s", None), (52, p * 3, "en", "s", None), (53, q[:99], "en", "s", None)]
    _check(spark, rows)


@pytest.mark.parametrize("line", [24, 62, 90, 100, 120])
def test_cores_with_many_contexts_are_dealt_anew(spark, line):
    """One line in many surroundings, some of which share more with it."""
    rng = random.Random(line)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    common, sides = text(line), [text(60) for _ in range(6)]
    rows = [(i, rng.choice([text(90), *sides[:3]]) + common + rng.choice([text(90), *sides[3:]]), "en", "s", None) for i in range(120)]
    _check(spark, rows, most=4)
    _check(spark, rows, most=30)


def test_a_line_with_very_many_contexts_in_little_memory():
    """200,000 different surroundings of one line, in one worker: what is held doesn't grow with them."""
    code = """if True:
        import resource, numpy as np, pyarrow as pa
        from ionloom.llm import suffixes
        rng = np.random.default_rng(0)
        reach, n, step = suffixes.LENGTH - suffixes.GRAM, 200_000, 5000
        def batches():
            for at in range(0, n, step):
                rows = rng.integers(97, 123, (step, reach + suffixes.LENGTH)).astype(np.uint8)
                rows[:, reach : reach + 90] = 120
                yield pa.RecordBatch.from_arrays([pa.array(np.full(step, 7)), pa.array(np.arange(at, at + step)), pa.array(np.zeros(step, np.int64)), pa.array(np.full(step, reach)), pa.array(np.full(step, reach, np.int32)),
                    pa.array(np.full(step, suffixes.LENGTH, np.int32)), pa.array([r.tobytes() for r in rows], pa.binary()), pa.array(np.zeros(step, np.int32))], names=["key", "ord", "tie", "pos", "before", "after", "context", "low"])
        seen = sum(b.num_rows for b in suffixes._find_covered(suffixes.LENGTH, suffixes.GRAM)(batches()))
        assert seen == 2 * n, seen
        print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
    """
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 500


def test_anchors_are_found_across_chunks(monkeypatch):
    rng = np.random.default_rng(0)
    buffer = rng.integers(97, 101, 5000).astype(np.uint8)
    starts = np.array([0, 700, 705, 5000])
    whole = suffixes.anchors(buffer, starts)
    monkeypatch.setattr(suffixes, "CHUNK", 256)
    parts = suffixes.anchors(buffer, starts)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    for s, e in zip(starts[:-1], starts[1:], strict=True):
        for p in range(s, e - 99):  # every string holds an anchor
            assert ((whole[0] >= p) & (whole[0] <= p + 100 - suffixes.GRAM)).any()


def test_refine_tells_equal_strings():
    rng = np.random.default_rng(3)
    width = -(-(76 + 100) // 8) * 8
    base = rng.integers(0, 4, (6, width)).astype(np.uint8)
    rows = np.concatenate([base, base])
    rows[6:, 150] ^= 1
    group = np.concatenate([np.arange(6), np.arange(6)])
    got = suffixes.refine(rows, group, 100)[:, :77]
    for r in range(6):
        for c in range(77):
            same = (rows[r, c : c + 100] == rows[r + 6, c : c + 100]).all()
            assert (got[r, c] >= 0 and got[r, c] == got[r + 6, c]) == same


def test_empty_table_and_columns(spark):
    assert suffixes.remove_repeats(empty(spark)).count() == 0
    assert suffixes.without_repeats(empty(spark)).count() == 0
    rows = odd_rows()
    d = frame(spark, rows, extra=True)
    left = suffixes.without_repeats(d)
    assert left.columns == d.columns and left.count() == len(rows)
    texts = {r.doc_id: r for r in left.collect() if r.doc_id is not None}
    assert texts[7].text == "" or len(texts[7].text) < 100  # a copy of 5 goes
    assert texts[100].text is None and texts[7].n_chars == len(texts[7].text)
