"""Order-dependent peak-list kernels: numpy and plain Python, with Arrow-batched column functions around them."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

COSINE = "struct<cosine:double,matched:int>"
# Spectra up to which presence is counted exactly, and the chance from which a peak is surely there.
MOST_COUNTED, SURE = 64, 0.99


def direct_matches(a, b, tolerance: float, stop: float = math.inf) -> tuple[list[tuple[int, int]], int, int]:
    """Peaks of two ascending lists within tolerance, each used once, lowest first; where the walk ended in both."""
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b) and a[i] < stop and b[j] < stop:
        gap = a[i] - b[j]
        if abs(gap) <= tolerance:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif gap < 0:
            i += 1
        else:
            j += 1
    return pairs, i, j


def shifted_matches(a, b, pairs: list[tuple[int, int]], tolerance: float, shift: float) -> list[tuple[int, int]]:
    """Among what direct matching left over: a peak and the first free one that lies `shift` below it."""
    taken_a, taken_b = {i for i, _ in pairs}, {j for _, j in pairs}
    free = [j for j in range(len(b)) if j not in taken_b]
    out = []
    for i in (i for i in range(len(a)) if i not in taken_a):
        for place, j in enumerate(free):
            gap = a[i] - b[j]
            if gap > 0 and abs(gap - shift) <= tolerance:
                out.append((i, j))
                del free[place]
                break
            if gap <= 0 or gap < shift:
                break
    return out


def _share(pairs, x, y, whole_x: float, whole_y: float) -> float:
    top = sum(x[i] * y[j] for i, j in pairs)
    return top / math.sqrt(whole_x * whole_y) if top > 0 else 0.0


def cosine(a, x, b, y, tolerance: float) -> float:
    """Of two spectra (m/z a, intensities x; b, y)."""
    pairs, _, _ = direct_matches(a, b, tolerance)
    return _share(pairs, x, y, sum(v * v for v in x), sum(v * v for v in y))


def trimmed_cosine(a, x, b, y, tolerance: float, trim_mz: float) -> float:
    """Matching stops once either list reaches trim_mz; norms take peaks up to and including it."""
    pairs, _, _ = direct_matches(a, b, tolerance, trim_mz)
    used_a, used_b = {i for i, _ in pairs}, {j for _, j in pairs}
    norm = lambda mz, v, used: sum(v[i] * v[i] for i in range(len(mz)) if i in used or mz[i] <= trim_mz)
    return _share(pairs, x, y, norm(a, x, used_a), norm(b, y, used_b))


def shifted_cosine(a, x, b, y, tolerance: float, shift: float) -> tuple[float, int]:
    """Cosine and matched peaks, directly and then by the precursors' difference; norms take all peaks."""
    if shift < 0:
        a, x, b, y, shift = b, y, a, x, -shift
    pairs, _, _ = direct_matches(a, b, tolerance)
    if shift > tolerance:
        pairs = pairs + shifted_matches(a, b, pairs, tolerance, shift)
    return _share(pairs, x, y, sum(v * v for v in x), sum(v * v for v in y)), len(pairs)


def joined_peaks(mz, intensity, tolerance: float, trim_mz: float = -1.0, scale: float = 0.5, isotopes: bool = False) -> tuple[list[float], list[float]]:
    """Adjacent peaks within tolerance of the running centroid become one; weak ones go; 1000 in all, then scaled.

    Peaks around trim_mz are left out, within 20 and beyond the tolerance; the first peak never is. With isotopes, peaks
    one or two isotope steps above a peak, of at most two thirds of its intensity, are added to it; the default leaves
    them, as the established results do.
    """
    if not len(mz):
        return [], []
    out_mz, out_int = [float(mz[0])], [float(intensity[0])]
    for m, v in zip(mz[1:], intensity[1:], strict=True):
        if trim_mz != -1 and tolerance < abs(m - trim_mz) < 20:
            continue
        if m - out_mz[-1] <= tolerance:
            share = out_int[-1] / (out_int[-1] + v)
            out_mz[-1] = out_mz[-1] * share + m * (1 - share)
            out_int[-1] += v
        else:
            out_mz.append(float(m))
            out_int.append(float(v))
    least = sorted(out_int)[2 * len(out_int) // 3] * 0.001 if len(out_int) > 10 else 0.0
    if isotopes:
        out_mz, out_int = folded_isotopes(out_mz, out_int, tolerance)
    kept = [(m, v) for m, v in zip(out_mz, out_int, strict=True) if v > least]
    whole = sum(v for _, v in kept)
    if not kept:
        return [], []
    unit = 1000.0 / whole
    grown = (lambda v: 1 + math.log1p(unit * v)) if scale == 0 else (lambda v: (unit * v) ** scale)
    return [m for m, _ in kept], [grown(v) for _, v in kept]


def folded_isotopes(mz: list[float], intensity: list[float], tolerance: float, step: float = 1.0033) -> tuple[list[float], list[float]]:
    total, gone = list(intensity), set()
    for i, m in enumerate(mz):
        if i in gone:
            continue
        for j in range(i + 1, len(mz)):
            if mz[j] - m > 2 * step + tolerance:
                break
            near = min(abs(mz[j] - m - k * step) for k in (1, 2)) <= tolerance
            if near and j not in gone and intensity[j] <= 2 / 3 * intensity[i]:
                total[i] += total[j]
                gone.add(j)
    return [m for i, m in enumerate(mz) if i not in gone], [v for i, v in enumerate(total) if i not in gone]


def strong_in_window(mz, intensity, window: float = 100.0, top: int = 10, least_share: float = 0.0) -> list[int]:
    """Places of peaks among the `top` strongest of their window; of fewer than ten peaks, all; the first and last stay."""
    n = len(mz)
    if n < 10:
        return list(range(n))
    mz, v = np.asarray(mz, float), np.asarray(intensity, float)
    low, high = np.searchsorted(mz, mz - window / 2, "left"), np.searchsorted(mz, mz + window / 2, "right")
    keep = np.array([(v[low[i] : high[i]] > v[i]).sum() < top for i in range(n)])
    keep[[0, -1]] = True
    if least_share:
        keep &= v >= np.sort(v)[2 * n // 3] * least_share
    return np.flatnonzero(keep).tolist()


def consensus_peaks(peak_lists, sizes, tolerance: float, least: int = 5) -> tuple[list[float], list[float]]:
    """One spectrum of several: peaks pooled and joined (the first peak's mass is pinned), weighted by how many of the
    spectra show them, 1000 for each spectrum in all, weak ones dropped."""
    pooled = sorted((m, v, k) for k, peaks in enumerate(peak_lists) for m, v in peaks)
    groups: list[list[tuple[float, float, int]]] = []
    for peak in pooled:
        if groups and peak[0] - groups[-1][-1][0] <= tolerance * 0.5:
            groups[-1].append(peak)
        else:
            groups.append([peak])
    n = max(1, sum(sizes))
    mz, v = [], []
    for k, g in enumerate(groups):
        weight = sum(p[1] for p in g)
        seen = min(255, sum(sizes[s] for s in {p[2] for p in g}))
        mz.append(g[0][0] if k == 0 or not weight else sum(p[0] * p[1] for p in g) / weight)
        v.append(weight * presence_weight(seen, n))
    whole = sum(v)
    v = [1000.0 * n * x / whole for x in v] if whole else v
    keep = strong_in_window(mz, v) if len(mz) > least else range(len(mz))
    return [mz[i] for i in keep], [v[i] for i in keep]


def presence_weight(seen: int, n: int, chance: float = 0.15) -> float:
    """0.05 and up to 1: how sure it is, by the binomial distribution, that a peak seen so often isn't there by chance.

    Beyond MOST_COUNTED spectra both counts are halved until they fit; more than SURE is as good as sure.
    """
    while n > MOST_COUNTED:
        n, seen = n // 2, seen // 2
    chances = [math.comb(n, k) * chance**k * (1 - chance) ** (n - k) for k in range(min(seen, n) + 1)]
    whole = sum(chances)
    return 0.05 + 0.95 * (1.0 if whole > SURE or seen > n else whole - chances[-1])


def distance_peaks(mz, intensity, precursor: float, most: int = 30, keys: int = 6, water: float = 18.0106) -> tuple[list[int], list[int]]:
    """Places of the strongest peaks that tell spectra apart, and of the few that index them: not near the precursor or
    its water loss, not above it, not a weak neighbour one step above a stronger peak."""
    mz, v = np.asarray(mz, float), np.asarray(intensity, float)
    ok = (mz < precursor) & (np.abs(mz - precursor) > 1.0) & (np.abs(mz - precursor + water) > 1.0)
    for i in np.flatnonzero(ok):
        near = np.abs(mz[i] - mz - 1.0033) <= 0.05
        if near.any() and v[i] < 0.66 * v[near].max():
            ok[i] = False
    order = sorted(np.flatnonzero(ok).tolist(), key=lambda i: (-v[i], mz[i]))[:most]
    return sorted(order), sorted(order[:keys])


def window_merge(mz, intensity, width: float = 0.025) -> tuple[list[float], list[float]]:
    """Peaks of fixed windows of m/z as one each: mean m/z by intensity, summed intensity."""
    cell = np.floor(np.asarray(mz, float) / width).astype(np.int64)
    _, place = np.unique(cell, return_inverse=True)
    total = np.bincount(place, intensity)
    return (np.bincount(place, np.asarray(mz) * np.asarray(intensity)) / total).tolist(), total.tolist()


# Column functions -----------------------------------------------------------------------------------------------


def _lists(peaks) -> tuple[list[float], list[float]]:
    return ([p["mz"] for p in peaks], [p["intensity"] for p in peaks]) if peaks is not None else ([], [])


def cosine_of(peaks_a: Column, peaks_b: Column, tolerance: float) -> Column:
    @F.pandas_udf("double")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([cosine(*_lists(p), *_lists(q), tolerance) for p, q in zip(left, right, strict=True)], dtype="float64")

    return run(peaks_a, peaks_b)


def trimmed_cosine_of(peaks_a: Column, peaks_b: Column, trim_mz: Column, tolerance: float) -> Column:
    @F.pandas_udf("double")
    def run(left: pd.Series, right: pd.Series, trim: pd.Series) -> pd.Series:
        return pd.Series([trimmed_cosine(*_lists(p), *_lists(q), tolerance, t) for p, q, t in zip(left, right, trim, strict=True)], dtype="float64")

    return run(peaks_a, peaks_b, trim_mz)


def shifted_cosine_of(peaks_a: Column, peaks_b: Column, shift: Column, tolerance: float, max_shift: float = math.inf, least: float = 0.0) -> Column:
    """cosine and matched; a shift beyond max_shift counts as none, and what is under `least` as no likeness at all."""

    @F.pandas_udf(COSINE)
    def run(left: pd.Series, right: pd.Series, moved: pd.Series) -> pd.DataFrame:
        found = [shifted_cosine(*_lists(p), *_lists(q), tolerance, s if abs(s) <= max_shift else 0.0) for p, q, s in zip(left, right, moved, strict=True)]
        found = [(c, m) if c >= least else (0.0, 0) for c, m in found]
        return pd.DataFrame({"cosine": [c for c, _ in found], "matched": [m for _, m in found]}).astype({"cosine": "float64", "matched": "int32"})

    return run(peaks_a, peaks_b, shift)


def joined_peaks_of(peaks: Column, tolerance: float, trim_mz: Column | None = None, scale: float = 0.5, isotopes: bool = False) -> Column:
    @F.pandas_udf("struct<mz:array<double>,intensity:array<double>>")
    def run(lists: pd.Series, trim: pd.Series) -> pd.DataFrame:
        found = [joined_peaks(*_lists(p), tolerance, t, scale, isotopes) for p, t in zip(lists, trim, strict=True)]
        return pd.DataFrame({"mz": [m for m, _ in found], "intensity": [v for _, v in found]})

    both = run(peaks, F.lit(-1.0) if trim_mz is None else trim_mz.cast("double"))
    return F.arrays_zip(both["mz"], both["intensity"]).cast("array<struct<mz:double,intensity:double>>")


def matched_pairs_of(peaks_a: Column, peaks_b: Column, shift: Column, tolerance: float) -> Column:
    """Places of matched peaks: direct ones, then shifted ones."""

    @F.pandas_udf("array<struct<a:int,b:int,shifted:boolean>>")
    def run(left: pd.Series, right: pd.Series, moved: pd.Series) -> pd.Series:
        out = []
        for p, q, s in zip(left, right, moved, strict=True):
            a, b = _lists(p)[0], _lists(q)[0]
            swap = s < 0
            a, b = (b, a) if swap else (a, b)
            pairs, _, _ = direct_matches(a, b, tolerance)
            more = shifted_matches(a, b, pairs, tolerance, abs(s)) if abs(s) > tolerance else []
            rows = [(i, j, False) for i, j in pairs] + [(i, j, True) for i, j in more]
            out.append([{"a": j if swap else i, "b": i if swap else j, "shifted": m} for i, j, m in rows])
        return pd.Series(out)

    return run(peaks_a, peaks_b, shift)
