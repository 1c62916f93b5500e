"""Greedy merging and clustering in independent islands of m/z.

Rows sorted by m/z are cut where neighbours lie further apart than any merge can reach. A merged row's m/z is a weighted
mean, so it stays among its members', and no merge crosses a cut: islands are groups that run in parallel with the same
results as one pass over everything. Rows that merge only where they elute together are cut by time inside each island too,
and by m/z once more inside those; a baseline, that elutes with everything, holds its island together.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ionloom.functions.kernels import consensus_peaks, cosine, distance_peaks
from ionloom.operators.graph import cut

#: What rounding a weighted mean to four digits can move it by.
GUARD = 1e-4
#: A bucket of m/z, in tolerances, within which runs are found; runs that touch across buckets are then joined.
RUN = 4096


def islands(rows: DataFrame, mz: str, tolerance: float) -> DataFrame:
    """rows with `island`: a number shared by rows that gaps of more than the tolerance don't part.

    Gaps are looked for within buckets of m/z, in parallel; only each bucket's first and last value meet across buckets.
    """
    width = RUN * (tolerance + GUARD)
    own = rows.withColumn("_cell", F.floor(F.col(mz) / width))
    order = Window.partitionBy("_cell").orderBy(mz)
    gap = F.col(mz) - F.lag(mz).over(order) > tolerance + GUARD
    run = F.sum(F.when(gap, 1).otherwise(0)).over(order.rangeBetween(Window.unboundedPreceding, 0))
    own = own.withColumn("_run", run)
    # one row a bucket: does its first run go on from the last run of the bucket before?
    ends = own.groupBy("_cell").agg(F.min(mz).alias("low"), F.max(mz).alias("high"), F.max("_run").alias("runs"))
    line = Window.orderBy("_cell")
    linked = (F.lag("_cell").over(line) == F.col("_cell") - 1) & (F.col("low") - F.lag("high").over(line) <= tolerance + GUARD)
    linked = F.coalesce(linked, F.lit(False))
    # islands are numbered on: a bucket starts at the number its first run has
    before = F.coalesce(F.sum(F.col("runs") + 1).over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.sum(F.when(linked, 1).otherwise(0)).over(line.rowsBetween(Window.unboundedPreceding, 0))
    starts = ends.select("_cell", before.alias("_start"))
    return own.join(starts, "_cell").withColumn("island", F.col("_start") + F.col("_run")).drop("_cell", "_run", "_start")


def timed_islands(rows: DataFrame, mz: str, tolerance: float, rt_tolerance: float) -> DataFrame:
    """rows (rt_mean, rt_min, rt_max) with `island`: a number shared by rows that no gaps in m/z and in time part.

    A row reaches over its interval and centre; so does one that it merges into, over those of all its members.
    """
    low, high = F.least("rt_min", "rt_mean"), F.greatest("rt_max", "rt_mean")
    own = islands(rows, mz, tolerance).withColumnRenamed("island", "_by_mz")
    order = Window.partitionBy("_by_mz").orderBy("_low", "_high")
    own = own.withColumns({"_low": low, "_high": high}).withColumn("_reach", F.max("_high").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    own = own.withColumn("_by_rt", F.sum(F.when(F.col("_low") - F.col("_reach") > rt_tolerance + GUARD, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    inner = Window.partitionBy("_by_mz", "_by_rt").orderBy(mz)
    own = own.withColumn("_gap", F.col(mz) - F.lag(mz).over(inner) > tolerance + GUARD)
    own = own.withColumn("_part", F.sum(F.when(F.col("_gap"), 1).otherwise(0)).over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    return own.withColumn("island", F.struct("_by_mz", "_by_rt", "_part")).drop("_by_mz", "_by_rt", "_part", "_low", "_high", "_reach", "_gap")


# Greedy cleaning -----------------------------------------------------------------------------------------------------

CLEAN_COLUMNS = "id long, mz double, rt_mean double, rt_min double, rt_max double, num_spectra long, sum_ints double, base_peak_int double, blanks_total long, bflag boolean, peak_ids array<string>"


class _Row:
    __slots__ = ("id", "mz", "rt_mean", "rt_min", "rt_max", "num_spectra", "sum_ints", "base", "blanks", "bflag", "peaks", "members", "slot")

    def __init__(self, r):
        self.id, self.mz, self.rt_mean, self.rt_min, self.rt_max = int(r.id), r.mz, r.rt_mean, r.rt_min, r.rt_max
        self.num_spectra, self.sum_ints, self.base, self.blanks = int(r.num_spectra), r.sum_ints, r.base_peak_int, int(r.blanks_total)
        self.bflag = bool(r.bflag)
        self.peaks = [p for p in (r.peak_ids if r.peak_ids is not None else [])]
        self.members = [self.id]


def _round4(x: float) -> float:
    return round(x, 4)


def _merge(rows: list[_Row]) -> _Row:
    whole = sum(r.sum_ints for r in rows)
    mean = lambda name: _round4(sum(getattr(r, name) * r.sum_ints for r in rows) / whole) if whole else getattr(rows[0], name)
    baseline = any(r.rt_min == 0 and r.rt_max == 1_000_000 for r in rows)
    out = min(rows, key=lambda r: r.id)
    mz, rt_mean, low, high = mean("mz"), mean("rt_mean"), 0.0 if baseline else mean("rt_min"), 1_000_000.0 if baseline else mean("rt_max")
    peaks = list(dict.fromkeys(p for r in rows for p in r.peaks))
    members = [m for r in rows for m in r.members]
    num, base, blanks, flag = sum(r.num_spectra for r in rows), max(r.base for r in rows), sum(r.blanks for r in rows), any(r.bflag for r in rows)
    out.mz, out.rt_mean, out.rt_min, out.rt_max, out.peaks, out.members = mz, rt_mean, low, high, peaks, members
    out.num_spectra, out.sum_ints, out.base, out.blanks, out.bflag = num, whole, base, blanks, flag
    return out


def clean_island(rows: list[_Row], pairs: dict[tuple[int, int], float], similarity: float | None, mz_tol: float, rt_tol: float, cutoff: float, any_blank: bool, exact_ids: bool, most_steps: int = 10) -> list[_Row]:
    """The greedy loop over one island: step 0 (with blanks) seeds blank rows, step 1 all, later ones what the last joined.

    Within a step similarities are those of its start; after it a pair of merged rows has its members' largest.
    similarity None: every row that elutes together with the seed joins it.
    """
    slots: list[_Row | None] = sorted(rows, key=lambda r: r.id)  # a merged row takes its seed's place
    for k, r in enumerate(slots):
        r.slot = k
    by_mz = sorted((r.mz, r.slot) for r in slots)
    sim = dict(pairs)
    joined: set[int] = set()
    step = 0 if any_blank else 1
    while True:
        rep = {r.id: r.id for r in slots if r is not None}
        stands_for = {k: [k] for k in rep}
        likes: dict[int, list[int]] = {}
        if similarity is not None:
            for (a, b), c in sim.items():
                if c >= similarity:
                    likes.setdefault(a, []).append(b)
                    likes.setdefault(b, []).append(a)
        changed: set[int] = set()
        for seed in slots:
            if seed is None or slots[seed.slot] is not seed:  # merged into another meanwhile
                continue
            if step == 0 and seed.blanks == 0 or step > 1 and seed.id not in joined:
                continue
            window = by_mz[bisect_left(by_mz, (seed.mz - mz_tol - GUARD, -1)) : bisect_right(by_mz, (seed.mz + mz_tol + GUARD, len(slots)))]
            near = [slots[k] for k in sorted(k for _, k in window)]
            near = [r for r in near if abs(r.mz - seed.mz) <= mz_tol and (seed.rt_min - rt_tol <= r.rt_mean <= seed.rt_max + rt_tol or r.rt_min - rt_tol <= seed.rt_mean <= r.rt_max + rt_tol)]
            if not any_blank or not seed.bflag:
                near = [r for r in near if r is seed or abs(r.rt_mean - seed.rt_mean) <= 4 * rt_tol or math.sqrt(((r.rt_min - seed.rt_min) ** 2 + (r.rt_max - seed.rt_max) ** 2) / 2) <= 2 * rt_tol]
            if similarity is not None:
                like = {rep.get(x, x) for x in likes.get(seed.id, ())}
                own = [p for p in seed.peaks if not p.startswith("fake_")]
                low = cutoff >= 0
                take = []
                for r in near:
                    ok = r is seed or r.id in like
                    if not ok and seed.num_spectra < 5000 and 0 < len(own) <= 500:
                        ok = any(p in r.peaks for p in own) if exact_ids else any(p in q for p in own for q in r.peaks)
                    if not ok and low:
                        ok = r.base <= cutoff if seed.blanks > 0 else seed.bflag and seed.base <= cutoff and r.blanks > 0
                    if ok:
                        take.append(r)
                near = take
            if len(near) < 2:
                continue
            place = seed.slot
            for r in near:
                del by_mz[bisect_left(by_mz, (r.mz, r.slot))]
                slots[r.slot] = None
            ids = {r.id for r in near}
            whole = _merge(near)
            held = [k for x in sorted(ids) for k in stands_for.pop(x)]
            for k in held:
                rep[k] = whole.id
            stands_for[whole.id] = held
            whole.slot, slots[place] = place, whole
            insort(by_mz, (whole.mz, place))
            changed = {c for c in changed if c not in ids} | {whole.id}
        after: dict[tuple[int, int], float] = {}
        for (a, b), c in sim.items():
            x, y = rep.get(a, a), rep.get(b, b)
            if x != y:
                key = (min(x, y), max(x, y))
                after[key] = max(c, after.get(key, 0.0))
        sim, joined = after, changed
        if step >= 1 and (not changed or step == most_steps):
            return [r for r in slots if r is not None]
        step += 1


def greedy_clean(clusters: DataFrame, pairs: DataFrame | None, mz_tolerance: float, rt_tolerance: float, similarity: float | None, bflag_cutoff: float = -1.0, peak_id_match: str = "exact") -> DataFrame:
    """rep, id: which row each cluster is merged into. clusters: CLEAN_COLUMNS; pairs: id_a, id_b, cosine.

    Without pairs or similarity (MS1 peaks alone) all rows that elute together are merged.
    """
    blanks = bool(clusters.where("blanks_total > 0").limit(1).count())
    placed = cut(timed_islands(clusters, "mz", mz_tolerance, rt_tolerance), "islands")
    where = placed.select("id", "island")
    empty = clusters.sparkSession.createDataFrame([], "id_a long, id_b long, cosine double")
    within = (pairs.select("id_a", "id_b", "cosine") if pairs is not None else empty).join(where.select(F.col("id").alias("id_a"), "island"), "id_a").join(where.select(F.col("id").alias("id_b"), F.col("island").alias("other")), "id_b").where("island = other").drop("other")
    within = cut(within, "island-pairs")
    exact = peak_id_match == "exact"
    level = similarity if pairs is not None else None

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        sim = {(min(a, b), max(a, b)): c for a, b, c in zip(right["id_a"], right["id_b"], right["cosine"], strict=True)}
        done = clean_island([_Row(r) for r in left.itertuples()], sim, level, mz_tolerance, rt_tolerance, bflag_cutoff, blanks, exact)
        return pd.DataFrame([(r.id, m) for r in done for m in r.members], columns=["rep", "id"]).astype("int64")

    return placed.groupBy("island").cogroup(within.groupBy("island")).applyInPandas(run, "rep long, id long")


def clean_peaks(rows: DataFrame, membership: DataFrame, factor: float, tolerance: float) -> DataFrame:
    """rep, peaks of merged rows: unscaled peaks weighted by their row's sum of intensities, pooled, joined and scaled anew.

    rows: id, sum_ints, peaks (scaled, of 1000 in all before that).
    """
    from ionloom.functions.kernels import joined_peaks_of
    from ionloom.functions.scalars import unscaled

    heavy = F.transform("peaks", lambda p: F.struct(p["mz"].alias("mz"), (unscaled(p["intensity"], factor) * F.col("sum_ints")).alias("intensity")))
    pooled = rows.withColumn("_peaks", heavy).join(membership, "id").groupBy("rep").agg(F.array_sort(F.flatten(F.collect_list("_peaks"))).alias("_all"))
    return pooled.select("rep", joined_peaks_of(F.col("_all"), tolerance, scale=factor).alias("peaks"))


# Clustering ------------------------------------------------------------------------------------------------------------


def _cluster_island(left: pd.DataFrame, window: float, tolerance: float, rt_tol: float, similarity: float, rounds: int, first: float, least_candidate: float) -> list[tuple[int, int]]:
    """Rounds of falling thresholds; within one, pairs by m/z and id join at once if they reach it."""
    items = []
    for r in sorted(left.itertuples(), key=lambda r: (r.mz, r.id)):
        mz, v = [p["mz"] for p in r.peaks], [p["intensity"] for p in r.peaks]
        _, keys = distance_peaks(mz, v, r.mz)
        items.append({"ids": [int(r.id)], "mz": r.mz, "rt": r.rt_mean, "low": r.rt_min, "high": r.rt_max, "weight": max(r.precursor_intensity, 1e-9), "peaks": list(zip(mz, v, strict=True)), "keys": {int(mz[k] / tolerance) for k in keys}})
    near = lambda a, b: a["low"] - rt_tol <= b["rt"] <= a["high"] + rt_tol or b["low"] - rt_tol <= a["rt"] <= b["high"] + rt_tol
    scores: dict[tuple[int, int], float] = {}
    for k in range(rounds):
        level = similarity if rounds == 1 else first + (similarity - first) * k / (rounds - 1)
        reach = window if k == 0 else 2 * window
        place = lambda x: (x["mz"], x["ids"][0])
        items.sort(key=place)
        i = 0
        while i < len(items):
            a, best = items[i], None
            for b in items[i + 1 :] if i + 1 < len(items) and items[i + 1]["mz"] - a["mz"] <= reach else ():
                if b["mz"] - a["mz"] > reach:
                    break
                if abs(len(a["peaks"]) - len(b["peaks"])) > 30 or not near(a, b):
                    continue
                if not any(x + d in b["keys"] for x in a["keys"] for d in (-2, -1, 0, 1, 2)):
                    continue
                key = (id(a), id(b))
                if key not in scores:
                    scores[key] = min(1.0, cosine([m for m, _ in a["peaks"]], [v for _, v in a["peaks"]], [m for m, _ in b["peaks"]], [v for _, v in b["peaks"]], tolerance))
                s = scores[key]
                if s >= max(level, least_candidate) and (best is None or s > best[0]):
                    best = (s, b)
                    if k == 0:
                        break
            if not best:
                i += 1
                continue
            b = best[1]
            w = a["weight"] + b["weight"]
            mean = lambda n, a=a, b=b, w=w: (a[n] * a["weight"] + b[n] * b["weight"]) / w
            baseline = any(x["low"] == 0 and x["high"] == 1_000_000 for x in (a, b))
            mz, v = consensus_peaks([a["peaks"], b["peaks"]], [len(a["ids"]), len(b["ids"])], tolerance)
            _, keys = distance_peaks(mz, v, mean("mz"))
            fresh = {"ids": sorted(a["ids"] + b["ids"]), "mz": mean("mz"), "rt": mean("rt"), "low": 0.0 if baseline else mean("low"), "high": 1_000_000.0 if baseline else mean("high"), "weight": w, "peaks": list(zip(mz, v, strict=True)), "keys": {int(mz[x] / tolerance) for x in keys}}
            fresh["was"] = (a, b)  # keeps both alive, so that their place in memory isn't another's
            del items[next(j for j in range(i + 1, len(items)) if items[j] is b)]
            del items[i]
            insort(items, fresh, key=place)
            # rows before it found no partner and only the new one could be theirs: on from the first that reaches it
            i = min(i, bisect_left(items, fresh["mz"] - reach, key=lambda x: x["mz"]))
    return [(x["ids"][0], m) for x in items for m in x["ids"]]


def cluster(spectra: DataFrame, window: float, tolerance: float, rt_tolerance: float, similarity: float, rounds: int = 15, first: float = 0.7, least_candidate: float = 0.15) -> DataFrame:
    """cluster_id, id. spectra: id, mz, rt_mean, rt_min, rt_max, precursor_intensity, peaks.

    Candidates share one of their six strongest telling peaks (within two bins), lie in the window of m/z, elute together
    and differ by 30 peaks at most. Thresholds fall from `first` to `similarity`. The order is by m/z and id, so results
    depend on nothing else.
    """

    def run(left: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_cluster_island(left, window, tolerance, rt_tolerance, similarity, rounds, max(first, similarity), least_candidate), columns=["cluster_id", "id"]).astype("int64")

    return islands(spectra, "mz", 2 * window).groupBy("island").applyInPandas(run, "cluster_id long, id long")


def consensus(spectra: DataFrame, membership: DataFrame, tolerance: float) -> DataFrame:
    """cluster_id, size, mz, rt_mean (weighted by precursor intensity), rt_min, rt_max and the consensus peaks of each cluster."""

    def run(left: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("id")
        w = left["precursor_intensity"].clip(lower=1e-9)
        mean = lambda c: float((left[c] * w).sum() / w.sum())
        share = (left["precursor_intensity"] / max(left["precursor_intensity"].max(), 1e-9)).clip(lower=0.2)
        lists = [[(p["mz"], p["intensity"] * s) for p in ps] for ps, s in zip(left["peaks"], share, strict=True)]
        mz, v = consensus_peaks(lists, [1] * len(lists), tolerance)
        baseline = ((left["rt_min"] == 0) & (left["rt_max"] == 1_000_000)).any()
        peaks = [{"mz": m, "intensity": x} for m, x in zip(mz, v, strict=True)]
        return pd.DataFrame({"cluster_id": [left["cluster_id"].iloc[0]], "size": [len(left)], "mz": [mean("mz")], "rt_mean": [mean("rt_mean")], "rt_min": [0.0 if baseline else mean("rt_min")], "rt_max": [1e6 if baseline else mean("rt_max")], "peaks": [peaks]})

    schema = "cluster_id long, size long, mz double, rt_mean double, rt_min double, rt_max double, peaks array<struct<mz:double,intensity:double>>"
    return spectra.join(membership, "id").groupBy("cluster_id").applyInPandas(run, schema)


def hierarchical(spectra: DataFrame, window: float, tolerance: float, rt_tolerances: tuple[float, float], similarity: float, similarity_blank: float, rounds: int = 15) -> DataFrame:
    """cluster_id, id by four levels: each sample's data, its blanks, each batch, all. spectra also have batch, is_blank.

    Blanks use their own threshold; the first time tolerance holds until the last level, which uses the second.
    """
    columns = ["id", "mz", "rt_mean", "rt_min", "rt_max", "precursor_intensity", "peaks"]

    def level(rows: DataFrame, keys: list[str], sim: float, rt: float) -> DataFrame:
        def run(left: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame(_cluster_island(left, window, tolerance, rt, sim, rounds, max(0.7, sim), 0.15), columns=["cluster_id", "id"]).astype("int64")

        width = RUN * (2 * window + GUARD)
        if not keys:
            return islands(rows, "mz", 2 * window).groupBy("island").applyInPandas(run, "cluster_id long, id long")
        order = Window.partitionBy(*keys, F.floor(F.col("mz") / width)).orderBy("mz")
        gap = F.sum(F.when(F.col("mz") - F.lag("mz").over(order) > 2 * window + GUARD, 1).otherwise(0)).over(order.rangeBetween(Window.unboundedPreceding, 0))
        return rows.withColumn("_island", gap).groupBy(*keys, F.floor(F.col("mz") / width), "_island").applyInPandas(run, "cluster_id long, id long")

    def step(rows: DataFrame, member: DataFrame, carried: list[str]) -> DataFrame:
        whole = consensus(rows.select(*columns), member, tolerance)
        weight = rows.join(member, "id").groupBy("cluster_id").agg(F.sum("precursor_intensity").alias("precursor_intensity"), *[F.min(c).alias(c) for c in carried])
        return cut(whole.join(weight, "cluster_id").select(F.col("cluster_id").alias("id"), *columns[1:], *carried), "clusters")

    data = cut(level(spectra.where("not is_blank"), ["batch"], similarity, rt_tolerances[0]).unionByName(level(spectra.where("is_blank"), ["batch"], similarity_blank, rt_tolerances[0])), "clusters")
    first = step(spectra, data, ["batch"])
    batch = cut(level(first, ["batch"], similarity, rt_tolerances[0]), "clusters")
    second = step(first, batch, ["batch"])
    last = cut(level(second, [], similarity, rt_tolerances[1]), "clusters")
    via = data.withColumnRenamed("cluster_id", "c1").join(batch.select(F.col("id").alias("c1"), F.col("cluster_id").alias("c2")), "c1")
    return via.join(last.select(F.col("id").alias("c2"), "cluster_id"), "c2").select("cluster_id", "id")
