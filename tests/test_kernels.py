"""Kernels against published cosines and against plain definitions."""

from __future__ import annotations

import math
import random

import pytest
from hypothesis import given, settings, strategies as st

from ionloom.functions import kernels as K

R5 = [1, 2, 3, 4, 5]
# m/z and intensities of two spectra, tolerance, shift; cosine and matched peaks.
GOLDEN = [
    (R5, R5, R5, R5, 0.0, 1, 1.0, 5),
    ([3], [5], [1, 2], [1, 2], 0.025, 0, 0.0, 0),
    ([1, 2, 3], [1, 2, 3], [3], [3], 0.025, 0, 9 / math.sqrt(14 * 9), 1),
    (R5, R5, [1, 2, 3, 4, 6], R5, 0.0, -1, 1.0, 5),
    ([1, 3, 4, 5, 7], R5, [2, 3, 4, 5, 8], R5, 0.0, -1, 1.0, 5),
    ([1, 2, 3, 4], [1, 2, 3, 4], [2.5, 3], [2, 3], 0.025, -0.5, 13 / math.sqrt(13 * 30), 2),
    ([3, 6], [3, 2], [5, 8], [3, 2], 0.025, -2, 1.0, 2),
    ([3, 6], [5, 3], [1, 4], [5, 3], 0.025, 2, 1.0, 2),
    ([0, 4, 5, 7], [7, 5, 3, 1], [1, 2, 5, 7], [7, 5, 3, 1], 0.025, 1, 10 / 84, 2),
    ([1, 2, 5, 7], [7, 5, 3, 1], [0, 4, 5, 7], [7, 5, 3, 1], 0.025, -1, 10 / 84, 2),
    ([5, 6], [3, 5], [5, 7], [3, 5], 0.025, 2, 9 / 34, 1),
]


@pytest.mark.parametrize("case", GOLDEN)
def test_shifted_cosine_golden(case):
    a, x, b, y, tolerance, shift, cosine, matched = case
    got = K.shifted_cosine(a, x, b, y, tolerance, shift)
    assert got[0] == pytest.approx(cosine, abs=1e-9)
    assert got[1] == matched


def test_shift_is_symmetric():
    a, b, v = [3, 8, 10], [3, 7, 9], [3, 2, 1]
    assert K.shifted_cosine(a, v, b, v, 0.025, 1) == K.shifted_cosine(b, v, a, v, 0.025, -1)


spectrum = st.lists(st.tuples(st.integers(1, 60), st.integers(1, 100)), min_size=1, max_size=20, unique_by=lambda p: p[0]).map(sorted)


@settings(max_examples=200, deadline=None)
@given(spectrum, spectrum)
def test_integer_masses_match_like_an_equi_join(p, q):
    a, x, b, y = [m for m, _ in p], [v for _, v in p], [m for m, _ in q], [v for _, v in q]
    other = dict(q)
    top = sum(v * other[m] for m, v in p if m in other)
    expected = top / math.sqrt(sum(v * v for v in x) * sum(v * v for v in y)) if top else 0.0
    assert K.cosine(a, x, b, y, 0.25) == pytest.approx(expected, abs=1e-12)
    assert 0 <= K.shifted_cosine(a, x, b, y, 0.25, 3)[0] <= 1 + 1e-12


def test_joined_peaks_keep_a_thousand():
    rng = random.Random(1)
    mz = sorted(rng.uniform(50, 500) for _ in range(60))
    v = [rng.uniform(1, 1000) for _ in mz]
    m, s = K.joined_peaks(mz, v, 0.5, scale=0.5)
    assert sum(x * x for x in s) == pytest.approx(1000)
    assert m == sorted(m) and len(m) <= len(mz)
    assert K.joined_peaks([], [], 0.5) == ([], [])


def test_first_peak_is_never_trimmed():
    assert K.joined_peaks([100.0, 101.0, 300.0], [1.0, 1.0, 1.0], 0.01, trim_mz=110.0)[0] == [100.0, 300.0]


def test_trimmed_cosine_stops_at_the_precursor():
    a, x = [10, 20, 30], [1.0, 1.0, 1.0]
    assert K.trimmed_cosine(a, x, a, x, 0.1, 25) == pytest.approx(1.0)
    assert K.trimmed_cosine([30], [1.0], [30], [1.0], 0.1, 25) == 0.0


def test_consensus_of_equal_spectra_is_that_spectrum():
    peaks = [(100.0, 5.0), (150.0, 10.0), (200.0, 1.0)]
    mz, v = K.consensus_peaks([peaks, peaks], [1, 1], 0.05)
    assert mz == [100.0, 150.0, 200.0]
    assert sum(v) == pytest.approx(2000)


def test_window_merge_sums_intensity():
    mz, v = K.window_merge([1.0, 1.01, 2.0], [1.0, 3.0, 2.0], 0.025)
    assert v == [4.0, 2.0] and mz[0] == pytest.approx(1.0075)


def test_isotopes_fold_only_when_asked():
    mz, v = [100.0, 101.0033, 150.0], [90.0, 30.0, 50.0]
    assert len(K.joined_peaks(mz, v, 0.05)[0]) == 3
    assert len(K.joined_peaks(mz, v, 0.05, isotopes=True)[0]) == 2


def test_distance_peaks_leave_the_precursor_out():
    places, keys = K.distance_peaks([50, 100, 182.0, 200, 210], [5, 9, 8, 50, 50], 200.0)
    assert places == [0, 1] and keys == [0, 1]
