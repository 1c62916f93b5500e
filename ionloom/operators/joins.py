"""Tolerance joins as equi-joins on buckets: nothing here plans as a nested loop, whatever the sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ionloom.functions.scalars import aligned


def range_join(left: DataFrame, right: DataFrame, left_value: Column, right_value: Column, tolerance: float, how: str = "inner", extra: Column | None = None, equal: list[str] | None = None) -> DataFrame:
    """Pairs with |left_value - right_value| <= tolerance (and extra), by buckets of the tolerance's width.

    Alias both sides first; `equal` names columns that l and r share. The right side is dealt to its own bucket and both
    neighbours, so each pair is met once. A tolerance of 0 joins on equality.
    """
    width = tolerance if tolerance > 0 else 1.0
    own = left.withColumn("_bucket", F.floor(left_value / width))
    other = right.withColumn("_near", F.explode(F.array(*[F.floor(right_value / width) + k for k in (-1, 0, 1)])))
    # a float's last bit can't lose a pair: neighbours overlap, and this is the rule itself
    on = (F.col("_bucket") == F.col("_near")) & (F.abs(left_value - right_value) <= tolerance)
    for name in equal or []:
        on = on & (F.col(f"l.{name}") == F.col(f"r.{name}"))
    if extra is not None:
        on = on & extra
    out = own.join(other, on, how)
    return out.drop("_bucket", "_near") if how not in ("left_semi", "left_anti") else out.drop("_bucket")


def near_exists(rows: DataFrame, value: str, others: DataFrame, other_value: str, tolerance: float, flag: str) -> DataFrame:
    """rows with a boolean `flag`: some row of others lies within the tolerance. Others are reduced to distinct values first."""
    keys = others.select(F.col(other_value).alias("_other")).where("_other is not null").distinct()
    width = tolerance if tolerance > 0 else 1.0
    spread = keys.withColumn("_near", F.explode(F.array(*[F.floor(F.col("_other") / width) + k for k in (-1, 0, 1)]))).alias("o")
    values = rows.select(F.col(value).alias("_value")).where("_value is not null").distinct().withColumn("_bucket", F.floor(F.col("_value") / width))
    hit = values.join(spread, (F.col("_bucket") == F.col("_near")) & (F.abs(F.col("_value") - F.col("_other")) <= tolerance), "left_semi").select(F.col("_value").alias("_hit"))
    return rows.join(hit, rows[value] == hit["_hit"], "left").withColumn(flag, F.col("_hit").isNotNull()).drop("_hit")


def median_width(rows: DataFrame, low: str, high: str, tolerance: float) -> float:
    """Of intervals widened by the tolerance, about; 1 where they have none. It sets the size of buckets, never what meets."""
    found = rows.agg(F.percentile_approx(F.col(high) - F.col(low), 0.5, 1000)).first()[0]
    width = (found or 0.0) + 2 * tolerance
    return float(width) if 0 < width < float("inf") else 1.0


def cells(low: Column, high: Column, width: float) -> Column:
    """Numbers of the buckets between low and high."""
    a, b = F.floor(low / width), F.floor(high / width)
    return F.when(b >= a, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))


def interval_join(left: DataFrame, right: DataFrame, rt_tolerance: float, bucket: float | None = None, extra: Column | None = None, equal: list[str] | None = None) -> DataFrame:
    """Pairs of l and r (rt_mean, rt_min, rt_max) where one's centre lies in the other's interval, widened by the tolerance.

    Rows are told apart by their places, so each pair of rows comes once. Intervals are dealt to the buckets that they reach, centres to their own. A baseline, that reaches everything, only
    gets the buckets that the other side's centres lie in. Without a given width, buckets are half as wide as most intervals.
    Sides are sorted by bucket: what they are dealt to is larger than Spark's estimates, which would have it broadcast.
    """
    bucket = bucket or median_width(left, "rt_min", "rt_max", rt_tolerance) / 2

    def inside(p: str, s: str) -> Column:
        centre = F.col(f"{p}.rt_mean")
        return F.coalesce((centre >= F.col(f"{s}.rt_min") - rt_tolerance) & (centre <= F.col(f"{s}.rt_max") + rt_tolerance), F.lit(False))

    def centre_in(points: DataFrame, spans: DataFrame, p: str, s: str, unless: Column | None = None) -> DataFrame:
        bounds = points.agg(F.min("rt_mean").alias("_low"), F.max("rt_mean").alias("_high"))
        reach = spans.crossJoin(F.broadcast(bounds))
        low, high = F.greatest(F.col("rt_min") - rt_tolerance, F.col("_low")), F.least(F.col("rt_max") + rt_tolerance, F.col("_high"))
        dealt = reach.withColumn("_cell", F.explode(cells(low, high, bucket))).drop("_low", "_high").alias(s)
        own = points.withColumn("_cell", F.floor(F.col("rt_mean") / bucket)).alias(p)
        on = (F.col(f"{p}._cell") == F.col(f"{s}._cell")) & inside(p, s)
        if unless is not None:
            on = on & ~unless
        for name in equal or []:
            on = on & (F.col(f"{p}.{name}") == F.col(f"{s}.{name}"))
        if extra is not None:
            on = on & extra
        fields = lambda side, cols: F.struct(*[F.col(f"{side}.{c}") for c in cols]).alias(side)
        return own.hint("merge").join(dealt, on).select(fields("l", left.columns), fields("r", right.columns))

    # a centre has one bucket, so a pair is met once each way; those met the first way are left out of the second
    return centre_in(left, right, "l", "r").unionByName(centre_in(right, left, "r", "l", inside("l", "r")))


def nearest_peak(spectra: DataFrame, ms1: DataFrame, mz_tolerance: float, rt_tolerance: float, mean_width: float, keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    """Each spectrum with the MS1 peak whose m/z and time ranges, widened, hold it; of several, the nearest in time.

    spectra: spectrum_id, mz, rt, is_blank and the keys; ms1: peak_id, mz_min, mz_max, rt, rt_min, rt_max, area and the
    keys. Ties go to the smaller peak_id. Without a peak: a fake one around the spectrum's time, or, for blanks, none but
    the baseline (is_baseline).
    """
    # spectra alike in m/z and time find the same; peaks alike in their ranges are one, with their number and the first of their ids
    asking = spectra.where("mz is not null and rt is not null").select(*keys, "mz", "rt")
    limits = asking.agg(*[f(c) for c in ("mz", "rt") for f in (F.min, F.max)]).first()
    alike = ms1.groupBy(*keys, "mz_min", "mz_max", "rt", "rt_min", "rt_max").agg(F.min(F.struct("peak_id", "area")).alias("first"), F.count("*").alias("n"))
    l, r = asking.distinct(), alike
    for c, tolerance, (least, most) in (("mz", mz_tolerance, limits[:2]), ("rt", rt_tolerance, limits[2:])):
        width = median_width(ms1, f"{c}_min", f"{c}_max", tolerance)
        l = l.withColumn(f"_{c}", F.floor(F.col(c) / width))
        r = r.withColumn(f"_{c}", F.explode(cells(F.greatest(F.col(f"{c}_min") - tolerance, F.lit(least)), F.least(F.col(f"{c}_max") + tolerance, F.lit(most)), width)))
    inside = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in (*keys, "_mz", "_rt")] + [
        F.col("l.mz").between(F.col("r.mz_min") - mz_tolerance, F.col("r.mz_max") + mz_tolerance), F.col("l.rt").between(F.col("r.rt_min") - rt_tolerance, F.col("r.rt_max") + rt_tolerance),
    ]
    met = l.alias("l").hint("merge").join(r.alias("r"), reduce(Column.__and__, inside))
    place = [F.col(f"l.{c}") for c in (*keys, "mz", "rt")]
    met = met.select(*place, F.struct(F.abs(F.col("l.rt") - F.col("r.rt")).alias("gap"), F.col("r.first.peak_id").alias("peak_id"), F.col("r.rt_min").alias("rt_min"), F.col("r.rt_max").alias("rt_max"), F.col("r.first.area").alias("area")).alias("_peak"), F.col("r.n").alias("_n"))
    best = met.groupBy(*keys, "mz", "rt").agg(F.min("_peak").alias("_peak"), F.sum("_n").alias("_n"))
    # rows that share a spectrum_id share what any of them has found
    one, named = Window.partitionBy("spectrum_id"), F.col("spectrum_id").isNotNull()
    out = spectra.join(best, [*keys, "mz", "rt"], "left").withColumns({"peak": F.when(named, F.min("_peak").over(one)), "n_candidates": F.when(named, F.sum("_n").over(one))})
    fake = F.col("peak").isNull()
    half = mean_width / 2
    return out.select(
        *spectra.columns, F.when(fake, F.concat(F.lit("fake_"), F.col(keys[0]).cast("string"))).otherwise(F.col("peak.peak_id")).alias("peak_id"), fake.alias("is_fake"), (fake & F.col("is_blank")).alias("is_baseline"),
        F.when(fake & F.col("is_blank"), F.lit(0.0)).when(fake, F.col("rt") - half).otherwise(F.col("peak.rt_min")).alias("rt_min"),
        F.when(fake & F.col("is_blank"), F.lit(1_000_000.0)).when(fake, F.col("rt") + half).otherwise(F.col("peak.rt_max")).alias("rt_max"),
        F.col("peak.area").alias("peak_area"), F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"),
    )


def coelution_pairs(clusters: DataFrame, mz_tolerance: float, rt_tolerance: float, refine: bool = True) -> DataFrame:
    """id_a < id_b of clusters (id, mz, rt_mean, rt_min, rt_max, bflag) that elute together at one m/z.

    Refined: unless a is flagged as blank, their centres or their bounds must be aligned too.
    """
    own = clusters.select("id", "mz", "rt_mean", "rt_min", "rt_max", F.coalesce("bflag", F.lit(False)).alias("bflag"))
    met = (F.col("l.id") < F.col("r.id")) & (F.abs(F.col("l.mz") - F.col("r.mz")) <= mz_tolerance)
    if refine:
        met = met & (F.col("l.bflag") | aligned("l", "r", rt_tolerance))
    # pairs meet in buckets of mass and time; the right side is in its own bucket of mass and both neighbours
    bucket = F.floor(F.col("mz") / (mz_tolerance if mz_tolerance > 0 else 1.0))
    left, right = own.withColumn("_mass", bucket), own.withColumn("_mass", F.explode(F.array(*[bucket + k for k in (-1, 0, 1)])))
    return interval_join(left, right, rt_tolerance, extra=met, equal=["_mass"]).select(F.col("l.id").alias("id_a"), F.col("r.id").alias("id_b"))


def shared_peak_ids(a: Column, b: Column, match: str = "exact") -> Column:
    """Whether two id lists (arrays) share a real peak. match="substring": an id that is part of another counts too."""
    real = lambda x: F.filter(x, lambda p: ~p.startswith("fake_"))
    if match == "exact":
        return F.arrays_overlap(real(a), real(b))
    return F.exists(real(a), lambda p: F.exists(b, lambda q: q.contains(p)))


def dealt(rows: DataFrame, values: Column, name: str) -> DataFrame:
    """A row for each distinct value of a list: the value by `name`, and those before it by `name`_before (null at the first)."""
    own = rows.withColumn(f"{name}_all", F.array_distinct(F.filter(values, lambda v: v.isNotNull())))
    own = own.select("*", F.posexplode(f"{name}_all").alias(f"{name}_at", name))
    before = F.when(F.col(f"{name}_at") > 0, F.slice(f"{name}_all", F.lit(1), F.col(f"{name}_at")))
    return own.withColumn(f"{name}_before", before).drop(f"{name}_at")


def first_shared(name: str) -> Column:
    """l and r, dealt by their lists and joined by the value, meet at the first value of l's that r has too: so once."""
    before = F.col(f"l.{name}_before")
    return before.isNull() | ~F.arrays_overlap(before, F.col(f"r.{name}_all"))


def peak_sharing_pairs(clusters: DataFrame, mz_tolerance: float) -> DataFrame:
    """id_a < id_b of clusters (id, mz, peak_ids) of about one mass that share a real peak. Pairs are met by peak and mass."""
    own = dealt(clusters.select("id", "mz", "peak_ids"), F.filter("peak_ids", lambda p: ~p.startswith("fake_")), "_peak").drop("peak_ids")
    met = range_join(own.alias("l").hint("merge"), own.alias("r"), F.col("l.mz"), F.col("r.mz"), mz_tolerance, extra=(F.col("l.id") < F.col("r.id")) & first_shared("_peak"), equal=["_peak"])
    return met.select(F.col("l.id").alias("id_a"), F.col("r.id").alias("id_b"))


def header_lookup(members: DataFrame, headers: DataFrame) -> DataFrame:
    """Members with their spectra's header columns, by sample and scan."""
    return members.join(headers, ["sample", "scan"], "left")


def with_metadata(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """Rows by sample code with the sample's metadata; a table of samples is small, its size is known at run time."""
    return rows.join(metadata.withColumnRenamed("sample_code", "sample"), "sample", "left")


def first_of_each(rows: DataFrame, keys: list[str], order: list[Column | str], n: int = 1) -> DataFrame:
    """The first n rows of each key, by a full order."""
    place = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= n).drop("_place")


def almost_unique(rows: DataFrame, value: str, tolerance: float, order: list[Column | str], keys: list[str] | None = None) -> DataFrame:
    """One row, the first, of those whose value / tolerance rounds (half to even) to the same number."""
    return first_of_each(rows.withColumn("_cell", F.bround(F.col(value) / tolerance)), [*(keys or []), "_cell"], order).drop("_cell")
