"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is due target / source_size copies. The whole part is taken; the fraction is rounded so that
words balance: two fractional documents meet, and words move from one to the other, in a direction drawn so that neither
expectation changes, until one of them is at 0 or 1. What is left of a group meets what is left of others, in a
reduction tree over groups, until one fractional document of each source remains, which is rounded to the nearest.
Rows alike in id, source and text are one entry with their number: its whole copies are shared out at once, and at most one
fraction goes on, so no leaf grows with repeated rows.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ionloom.llm.shared import WORD, kept

#: Weights by a source's place in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: No document is taken more often than this, so no source's target exceeds it times its size.
MOST_COPIES = 3
#: Fractional documents that one leaf or node of the tree reduces.
FAN_IN = 4096
#: More sources than these are joined by shuffle, dealt to so many salts, so that a large source isn't one task.
BROADCAST_SOURCES, SALTS = 10_000, 64
#: Rows alike that one task writes out or numbers.
ALIKE_ROWS = 10_000
_EPS = 1e-12


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, n_docs, target, copies (target / source_size), from rows of source, size and m (how many rows are alike).

    Targets are min(most * source_size, level * weight) with the one level at which they add up to all words.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.count("*").alias("n_docs"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))).cast("int") + 1))
    per = per.withColumn("cap", F.lit(float(most)) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("below", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    per = per.withColumn("rest", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    per = per.withColumn("total", F.sum("source_size").over(every).cast("double"))
    per = per.withColumn("level_here", (F.col("total") - F.col("below")) / F.col("rest"))
    # the first source, by ratio, that its cap doesn't hold back gives the level
    level = F.min(F.when(F.col("level_here") <= F.col("ratio"), F.struct("ratio", "level_here"))).over(every)["level_here"]
    per = per.withColumn("target", F.coalesce(F.least("cap", level * F.col("weight")), F.col("cap")))
    per = per.withColumn("copies", F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0)))
    return per.select("source", "source_size", "n_docs", "target", "copies")


def _draw(seed: int, a, b) -> float:
    """A number in [0, 1) that only the seed and the two documents decide."""
    digest = hashlib.blake2b(repr((seed, a, b)).encode(), digest_size=8).digest()
    return struct.unpack("<Q", digest)[0] / 2.0**64


def pivot(keys: list, sizes: list[int], shares: list[float], seed: int) -> tuple[list[int], int | None, float]:
    """1 or 0 for each document; the place of the one that stays fractional, or None; its share."""
    out = [0] * len(keys)
    held, p = None, 0.0
    for i, (size, q) in enumerate(zip(sizes, shares, strict=True)):
        if size <= 0 or q <= _EPS:
            continue
        if q >= 1 - _EPS:
            out[i] = 1
            continue
        if held is None:
            held, p = i, q
            continue
        a, b = sizes[held], size
        up, down = min(a * (1 - p), b * q), min(a * p, b * (1 - q))  # words that the held one can gain, or give
        moved = up if _draw(seed, keys[held], keys[i]) * (up + down) < down else -down
        p, q = p + moved / a, q - moved / b
        if q <= _EPS or q >= 1 - _EPS:
            out[i] = int(q > 0.5)
            if p <= _EPS or p >= 1 - _EPS:
                out[held], held = int(p > 0.5), None
        else:
            out[held] = int(p > 0.5)
            held, p = i, q
    return out, held, p


def _node_reducer(seed: int, last: bool):
    def reduce_node(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "leaf"], ascending=[False, True], kind="stable").reset_index(drop=True)
        taken, held, p = pivot(group["leaf"].tolist(), group["size"].tolist(), group["share"].tolist(), seed)
        group["extra"], group["share"] = np.array(taken, np.int32), 0.0
        if held is not None:
            group.loc[held, "extra"], group.loc[held, "share"] = (int(p >= 0.5), 0.0) if last else (-1, p)
        return group

    return reduce_node


def _entries(docs: DataFrame, weights: tuple[int, ...], most: int, fan_in: int, seed: int) -> DataFrame:
    """doc_id, source, size, source_size, target, digest, base, m, extra: of m rows alike, `extra` are taken once more than base."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("digest"))
    rows = kept(rows.groupBy("doc_id", "source", "size", "digest").agg(F.count("*").alias("m")), "mix-rows")
    per = kept(source_targets(rows, weights, most), "mix-sources")
    if per.count() <= BROADCAST_SOURCES:
        joined = rows.join(F.broadcast(per), rows.source.eqNullSafe(per.source)).drop(per.source)
    else:
        salted = per.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SALTS)).cast("int"))
        joined = own.join(salted.hint("merge"), own.source.eqNullSafe(salted.source) & (own.salt == salted.salt)).drop(salted.source, own.salt, salted.salt)
    base = F.when(F.col("size") > 0, F.floor(F.col("copies") + F.lit(1e-9)).cast("int")).otherwise(0)
    due = F.when(F.col("size") > 0, F.greatest(F.lit(0.0), F.col("copies") - F.col("base")) * F.col("m")).otherwise(0.0)
    joined = joined.withColumn("base", base).withColumn("due", due).withColumn("whole", F.floor(F.col("due") + F.lit(1e-9))).withColumn("share", F.greatest(F.lit(0.0), F.col("due") - F.col("whole")))
    spread = F.xxhash64("doc_id", "digest", F.lit(seed))
    joined = joined.withColumn("leaf", F.pmod(spread, F.greatest(F.lit(1), F.ceil(F.col("n_docs") / F.lit(fan_in)))))
    leaf_out = "doc_id long, source string, size long, source_size long, target double, base int, digest long, m long, whole long, leaf long, extra int, share double"

    def reduce_leaf(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "doc_id", "digest"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        ids = group["doc_id"].astype(object).where(group["doc_id"].notna(), None).tolist()
        taken, held, p = pivot(list(zip(ids, group["digest"].tolist(), strict=True)), group["size"].tolist(), group["share"].tolist(), seed)
        group["extra"], group["share"] = np.array(taken, np.int32), 0.0
        if held is not None:
            group.loc[held, "extra"], group.loc[held, "share"] = -1, p
        return group[[c.split()[0] for c in leaf_out.split(", ")]]

    leaves = kept(joined.groupBy("source", "leaf").applyInPandas(reduce_leaf, leaf_out), "mix-leaves")
    # level by level, at most fan_in residuals of a source meet; each level decides all but one of each node
    rest = leaves.where("extra = -1").select("source", "leaf", "size", "share", F.lit(0).alias("extra"), F.col("leaf").alias("node"))
    decided = None
    n_leaves = int(leaves.agg(F.max("leaf")).first()[0] or 0) + 1
    while True:
        last = n_leaves <= fan_in
        rest = rest.withColumn("node", F.floor(F.col("node") / fan_in))
        done = kept(rest.groupBy("source", "node").applyInPandas(_node_reducer(seed + 1, last), rest.schema), "mix-nodes")
        part = done.where("extra >= 0").select("source", "leaf", F.col("extra").alias("late"))
        decided = part if decided is None else decided.unionByName(part)
        if last:
            break
        rest, n_leaves = done.where("extra = -1"), -(-n_leaves // fan_in)
    left, right = leaves.alias("l"), decided.alias("d")
    on = (F.col("l.extra") == -1) & F.col("l.source").eqNullSafe(F.col("d.source")) & (F.col("l.leaf") == F.col("d.leaf"))
    fractional = left.where("extra = -1").join(right, on, "left").select("l.*", "d.late")
    whole = leaves.where("extra >= 0").withColumn("late", F.lit(0))
    out = fractional.withColumn("extra", F.lit(0)).unionByName(whole)
    extra = (F.col("whole") + F.col("extra") + F.coalesce("late", F.lit(0))).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", "digest", "base", "m", extra.alias("extra"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, fan_in: int = FAN_IN, seed: int = 0) -> DataFrame:
    """doc_id, size, source, source_size, target, copies (how often the mix takes the document), digest.

    Null and empty texts have size 0 and are never taken. A null source is a source, the last; a null doc_id is a
    document like others. Rows alike in doc_id, source and text are rows of their own, whose copies differ by one at most.
    Other columns play no part. An empty table gives no rows. The same rows give the same mix, however they are dealt.
    """
    found = kept(_entries(docs, weights, most, fan_in, seed), "mix-entries")
    parts = found.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / ALIKE_ROWS))))
    if found.where(F.col("m") > ALIKE_ROWS).limit(1).count():
        parts = parts.repartition("doc_id", "digest", "part")
    first = F.col("part") * ALIKE_ROWS
    rows = parts.withColumn("i", F.explode(F.sequence(first, F.least(F.col("m"), first + ALIKE_ROWS) - 1)))
    copies = F.col("base") + (F.col("i") < F.col("extra")).cast("int")
    return rows.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"), "digest")


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, fan_in: int = FAN_IN, seed: int = 0) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with the columns of docs. Null and empty texts are never taken.

    Rows alike in doc_id, source and text get the copies that the mix gave such rows, one each in turn. No rows give no rows.
    """
    chosen = kept(_entries(docs, weights, most, fan_in, seed).select("doc_id", "source", "digest", "base", "m", "extra"), "mix-entries")
    digest = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    own = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("k1"), F.col("source").cast("string").alias("k2"), digest.alias("k3"))
    met = own.join(chosen, own.k1.eqNullSafe(chosen.doc_id) & own.k2.eqNullSafe(chosen.source) & (own.k3 == chosen.digest)).select("row", "base", "m", "extra", "k1", "k2", "k3")
    out = met.where("m = 1").select("row", (F.col("base") + F.col("extra")).alias("n"))
    if chosen.where("m > 1").limit(1).count():
        # rows alike are numbered by the task that wrote them and their place there, so that many of them aren't one task's
        key = ["k1", "k2", "k3"]
        alike = kept(met.where("m > 1").withColumn("at", F.monotonically_increasing_id()), "mix-alike").withColumn("task", F.shiftright("at", 33) * 1_000_000 + F.floor(F.expr("at & 8589934591") / ALIKE_ROWS))
        sizes = alike.groupBy(*key, "task").agg(F.count("*").alias("rows"))
        before = F.coalesce(F.sum("rows").over(Window.partitionBy(*key).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        starts = sizes.select(*[F.col(c).alias(f"{c}_") for c in key], F.col("task").alias("task_"), before.alias("before"))
        place = F.row_number().over(Window.partitionBy(*key, "task").orderBy("at"))
        numbered = alike.withColumn("place", place).join(starts, F.col("k1").eqNullSafe(F.col("k1_")) & F.col("k2").eqNullSafe(F.col("k2_")) & (F.col("k3") == F.col("k3_")) & (F.col("task") == F.col("task_")))
        out = out.unionByName(numbered.select("row", (F.col("base") + (F.col("place") + F.col("before") <= F.col("extra")).cast("int")).alias("n")))
    return out.where("n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n").cast("long")))).select("row.*")
