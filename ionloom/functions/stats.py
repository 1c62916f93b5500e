"""Correlation of long tables: rows of key, x, y; constant rows are told apart, never divided by."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType


def _guarded(rows: DataFrame, key: list[str], x: str, y: str) -> DataFrame:
    """key, n, corr, where both vary; null otherwise."""
    sums = rows.groupBy(*key).agg(F.count("*").alias("n"), F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"), F.covar_pop(x, y).alias("c"), F.var_pop(x).alias("vx"), F.var_pop(y).alias("vy"))
    varies = (F.col("x0") < F.col("x1")) & (F.col("y0") < F.col("y1")) & (F.col("vx") > 0) & (F.col("vy") > 0)
    return sums.select(*key, "n", F.when(varies, F.col("c") / F.sqrt(F.col("vx") * F.col("vy"))).alias("corr"))


def pearson(rows: DataFrame, key: list[str], x: str, y: str) -> DataFrame:
    return _guarded(rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()), key, x, y)


def average_ranks(rows: DataFrame, key: list[str], value: str, name: str) -> DataFrame:
    """rows with the value's rank among the key's; equal values share the mean of their places."""
    order = Window.partitionBy(*key).orderBy(value)
    ties = F.count("*").over(Window.partitionBy(*key, value))
    return rows.withColumn(name, F.rank().over(order) + (ties - 1) / 2)


def spearman(rows: DataFrame, key: list[str], x: str, y: str) -> DataFrame:
    own = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return _guarded(average_ranks(average_ranks(own, key, x, "_rx"), key, y, "_ry"), key, "_rx", "_ry")


def inversions(ranks: np.ndarray) -> int:
    """Pairs of places i < j with ranks[i] > ranks[j], by merging blocks that double in size; ranks are whole numbers from 0."""
    n, found, width = len(ranks), 0, 1
    place, step = np.arange(n), int(ranks.max()) + 1 if n else 1
    values = ranks.astype(np.int64)
    while width < n:
        pair, on_left = place // (2 * width), place // width % 2 == 0
        keys = values + pair * step  # in each block in order, and so over all left blocks
        left, right = keys[on_left], keys[~on_left]
        ends = np.searchsorted(left, (pair[~on_left] + 1) * step)
        found += int((ends - np.searchsorted(left, right, "right")).sum())
        keys.sort(kind="stable")
        values, width = keys - pair * step, 2 * width
    return found


def _tied(*columns: np.ndarray) -> int:
    """Pairs of places at which all columns are equal."""
    order = np.lexsort(columns)
    new = np.zeros(max(0, len(order) - 1), bool)
    for c in columns:
        new |= c[order][1:] != c[order][:-1]
    sizes = np.diff(np.concatenate([[0], np.flatnonzero(new) + 1, [len(order)]]))
    return int((sizes * (sizes - 1) // 2).sum())


def concordance(x: np.ndarray, y: np.ndarray) -> tuple[int, int, int]:
    """Over all pairs of rows: the sum of sign(dx) * sign(dy), pairs that differ in x, in y. In n log n steps."""
    n = len(x)
    x, y = (np.unique(v, return_inverse=True)[1].reshape(-1) for v in (x, y))
    every, tx, ty, both = n * (n - 1) // 2, _tied(x), _tied(y), _tied(x, y)
    against = inversions(y[np.lexsort((y, x))])
    return every - tx - ty + both - 2 * against, every - tx, every - ty


def kendall(rows: DataFrame, key: list[str], x: str, y: str, order: str) -> DataFrame:
    """Tau-b. `order` numbers a key's rows; those that share a number, or have none, aren't compared. A key's rows meet in one task, as a table of numbers; their pairs never become rows."""
    own = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*key, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), F.col(order).alias("o"))
    kinds = StructType([*[own.schema[k] for k in key], StructField("n", LongType()), *[StructField(c, DoubleType()) for c in ("s", "nx", "ny")]])

    def compared(table: pa.Table) -> pa.Table:
        numbered = table.filter(table.column("o").is_valid())
        a, b = (numbered.column(c).to_numpy() for c in ("x", "y"))
        o = numbered.column("o").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        found = np.array(concordance(a, b), np.float64)
        at = np.argsort(o, kind="stable")
        for alike in np.split(at, np.flatnonzero(np.diff(o[at])) + 1) if len(np.unique(o)) < len(o) else []:
            found -= concordance(a[alike], b[alike])
        # a difference without a sign (of what is no number, of equal infinities) leaves none to the sums
        for k, v in ((1, a), (2, b)):
            if any(same.any() and len(np.unique(o if v[same][0] != v[same][0] else o[same])) > 1 for same in (np.isnan(v), v == np.inf, v == -np.inf)):
                found[[0, k]] = np.nan
        first = table.slice(0, 1)
        return pa.table({**{k: first.column(k) for k in key}, "n": pa.array([table.num_rows], pa.int64()), **{c: pa.array([v], pa.float64()) for c, v in zip(("s", "nx", "ny"), found, strict=True)}})

    known = F.lit(True)
    for k in key:
        known = known & F.col(k).isNotNull()
    found = own.groupBy(*key).applyInArrow(compared, kinds)
    return found.select(*key, "n", F.when(known & (F.col("nx") > 0) & (F.col("ny") > 0), F.col("s") / F.sqrt(F.col("nx") * F.col("ny"))).alias("corr"))


def quartiles(rows: DataFrame, value: str, key: list[str] | None = None) -> DataFrame:
    """q1, median, q3 by linear interpolation between order statistics."""
    q = lambda p, name: F.percentile(value, F.lit(p)).alias(name)
    grouped = rows.groupBy(*key) if key else rows
    return grouped.agg(q(0.25, "q1"), q(0.5, "median"), q(0.75, "q3"))
