"""Networks as edge and node tables: thresholds, mutual top-k, components, pruning, distances, ranks."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

MOST_ROUNDS = 60
#: Edges of a component that one task prunes.
IN_MEMORY = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors see; where none is set, a local one for a local master alone."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        where = "file://" + tempfile.mkdtemp(prefix="ionloom-")
        spark.sparkContext.setCheckpointDir(where)
    return where


def cut(df: DataFrame, what: str = "graph") -> DataFrame:
    """df written to the shared folder and read again, so that loops don't grow the plan."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def thresholded(pairs: DataFrame, least: float) -> DataFrame:
    return pairs.where(F.col("cosine") >= least)


def with_self_loops(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """edges (id_a, id_b, cosine, matched) and, for nodes (id) without any, a loop of cosine 1 and -1 matched peaks."""
    touched = edges.select(F.col("id_a").alias("id")).unionByName(edges.select(F.col("id_b").alias("id"))).distinct()
    alone = nodes.select("id").join(touched, "id", "left_anti")
    loops = alone.select(F.col("id").alias("id_a"), F.col("id").alias("id_b"), F.lit(1.0).alias("cosine"), F.lit(-1).cast(edges.schema["matched"].dataType).alias("matched"))
    return edges.select("id_a", "id_b", "cosine", "matched").unionByName(loops)


def min_matched(edges: DataFrame, least: int) -> DataFrame:
    """Without edges of fewer matched peaks than `least`, where both ends have more peaks than that, or of fewer than 2."""
    few = F.least("n_peaks_a", "n_peaks_b")
    bad = (F.col("matched") < least) & ((few > least) | (F.col("matched") < 2))
    return edges.where((F.col("id_a") == F.col("id_b")) | ~bad)


def mutual_top_k(edges: DataFrame, k: int) -> DataFrame:
    """Edges above both ends' cutoff: the cosine of the end's (k+1)-th best edge. Ties at a cutoff all go; loops stay."""
    ends = edges.select(F.col("id_a").alias("id"), "cosine").unionByName(edges.where("id_a <> id_b").select(F.col("id_b").alias("id"), "cosine"))
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("cosine")))
    cutoffs = ends.withColumn("place", place).where(F.col("place") == k + 1).select("id", F.col("cosine").alias("cutoff"))
    side = lambda s: cutoffs.select(F.col("id").alias(f"id_{s}"), F.col("cutoff").alias(f"cutoff_{s}"))
    met = edges.join(side("a"), "id_a", "left").join(side("b"), "id_b", "left")
    above = lambda s: F.col(f"cutoff_{s}").isNull() | (F.col("cosine") > F.col(f"cutoff_{s}"))
    return met.where((F.col("id_a") == F.col("id_b")) | (above("a") & above("b"))).select(*edges.columns)


def components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """id, component: the smallest id that edges (id_a, id_b) connect with it. nodes (id) adds those without edges.

    Large and small stars in turn until all edges form stars; rounds grow with the logarithm of the size. Each round's minima
    are written, so that Spark broadcasts them or splits a node of many edges when it joins them.
    """
    star = cut(edges.where("id_a <> id_b").select(F.greatest("id_a", "id_b").alias("a"), F.least("id_a", "id_b").alias("b")).distinct())
    for _ in range(MOST_ROUNDS):
        ends = star.select(F.col("a").alias("id"), F.lit(1).alias("low"), F.lit(0).alias("high")).unionByName(star.select(F.col("b").alias("id"), F.lit(0).alias("low"), F.lit(1).alias("high")))
        open_ = ends.groupBy("id").agg(F.sum("low").alias("low"), F.max("high").alias("high")).where("low > 1 or low > 0 and high > 0")
        if not open_.limit(1).count():
            break
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        star = cut(small)
    else:
        raise RuntimeError(f"components still move after {MOST_ROUNDS} rounds")
    out = star.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(star.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
    loops = edges.where("id_a = id_b").select(F.col("id_a").alias("id"))
    every = loops.unionByName(nodes.select("id")) if nodes is not None else loops
    alone = every.distinct().join(out, "id", "left_anti")
    return out.unionByName(alone.select("id", F.col("id").alias("component")))


def numbered(rows: DataFrame, by: str, name: str) -> DataFrame:
    """rows with `name`: 1, 2, ... in ascending order of `by`. Ranges are numbered in parallel; only their counts meet."""
    dealt = cut(rows.repartitionByRange(by).withColumn("_range", F.spark_partition_id()), "numbered")
    counts = dealt.groupBy("_range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each range
    place = F.row_number().over(Window.partitionBy("_range").orderBy(by))
    return dealt.join(F.broadcast(counts.select("_range", before.alias("_before"))), "_range").withColumn(name, (place + F.col("_before")).cast("long")).drop("_range", "_before")


def component_index(edges: DataFrame) -> DataFrame:
    """edges (smaller id first) with component_index: 1, 2, ... by the components' smallest ids."""
    found = components(edges)
    index = numbered(found.select("component").distinct(), "component", "component_index")
    named = edges.withColumns({"_a": F.least("id_a", "id_b"), "_b": F.greatest("id_a", "id_b")}).drop("id_a", "id_b").withColumnsRenamed({"_a": "id_a", "_b": "id_b"})
    return named.join(found.withColumnRenamed("id", "id_a"), "id_a").join(F.broadcast(index) if index.limit(100_001).count() <= 100_000 else index, "component").drop("component")


def _delta(size: float, most: int) -> float:
    return 0.01 if size > 3 * most else 0.005 if size > 2 * most else 0.002 if size > 1.5 * most else 0.001


def prune_in_memory(edges: pd.DataFrame, most: int) -> pd.DataFrame:
    """The rounds of prune_components for edges (id_a, id_b, cosine) of one component."""
    todo, done = [edges], []
    while todo:
        own = todo.pop()
        names, place = np.unique(np.concatenate([own["id_a"], own["id_b"]]), return_inverse=True)
        a, b = place[: len(own)], place[len(own) :]
        label = np.arange(len(names))
        while True:
            before = label.copy()
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
            if (label == before).all():
                break
        size = np.bincount(label, minlength=len(names))
        for root in np.unique(label[a]) if len(own) else []:
            part = own[label[a] == root]
            if size[root] <= most:
                done.append(part)
            else:
                todo.append(part[part["cosine"] >= part["cosine"].min() + _delta(size[root], most)])
    return pd.concat(done) if done else edges.iloc[:0]


def prune_components(edges: DataFrame, most: int, rounds: int = 2000) -> DataFrame:
    """Edges less the weakest of components with more than `most` nodes, again and again until none is as large.

    Each round drops a large component's edges under its least cosine plus 0.01, 0.005, 0.002 or 0.001, for more than 3,
    2, 1.5 times the size, or less. 0 leaves all. Components are independent: those of up to IN_MEMORY edges go through
    their rounds in a task of their own; larger ones have a round of the whole cluster, and are looked at again.
    """
    if most == 0:
        return edges
    done, open_ = None, cut(edges.where("id_a <> id_b"))
    loops = edges.where("id_a = id_b")
    for _ in range(rounds):
        found = components(open_)
        sizes = found.groupBy("component").agg(F.count("*").alias("size"))
        placed = open_.join(found.withColumnRenamed("id", "id_a"), "id_a").join(sizes, "component")
        met = cut(placed.join(placed.groupBy("component").agg(F.count("*").alias("n_edges")), "component"))
        small = met.where(F.col("size") <= most).select(*edges.columns)
        local = met.where((F.col("size") > most) & (F.col("n_edges") <= IN_MEMORY)).select("component", *edges.columns)
        pruned = local.groupBy("component").applyInPandas(lambda left: prune_in_memory(left.drop(columns="component"), most), edges.schema)
        small = small.unionByName(pruned)
        done = small if done is None else done.unionByName(small)
        large = met.where((F.col("size") > most) & (F.col("n_edges") > IN_MEMORY))
        if not large.limit(1).count():
            return done.unionByName(loops.select(*edges.columns))
        delta = F.when(F.col("size") > 3 * most, 0.01).when(F.col("size") > 2 * most, 0.005).when(F.col("size") > 1.5 * most, 0.002).otherwise(0.001)
        floor = large.groupBy("component").agg(F.min("cosine").alias("lowest"))
        open_ = cut(large.join(floor, "component").where(F.col("cosine") >= F.col("lowest") + delta).select(*edges.columns))
    raise RuntimeError(f"components are still too large after {rounds} rounds")


def distance_from(edges: DataFrame, seeds: DataFrame, most: int = 3) -> DataFrame:
    """id, distance: steps from the nearest seed (id), up to `most`, along edges in either direction."""
    both = cut(edges.select(F.col("id_a").alias("x"), F.col("id_b").alias("y")).unionByName(edges.select(F.col("id_b").alias("x"), F.col("id_a").alias("y"))).where("x <> y").distinct())
    reached = seeds.select("id").distinct().withColumn("distance", F.lit(0))
    front = reached
    for d in range(1, most + 1):
        front = cut(front.join(both, F.col("id") == F.col("x")).select(F.col("y").alias("id")).distinct().join(reached, "id", "left_anti").withColumn("distance", F.lit(d)))
        reached = reached.unionByName(front)
    return reached


def pagerank(edges: DataFrame, damping: float = 0.85, tolerance: float = 1e-7, most_rounds: int = 200, personal: DataFrame | None = None) -> DataFrame:
    """id, rank of directed edges (src, dst), adding up to 1. personal (id, weight) says where walks restart and where
    nodes without successors lead; without it, or where its weights are all 0, anywhere alike. Fails if most_rounds don't do."""
    own = cut(edges.where("src <> dst").select("src", "dst").distinct())
    nodes = edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id"))).distinct()
    weights = nodes.withColumn("w", F.lit(1.0)) if personal is None else nodes.join(personal.select("id", F.col("weight").cast("double").alias("w")), "id", "left").fillna(0.0, ["w"])
    total = weights.agg(F.sum("w").alias("t"), F.count("*").alias("n")).first()
    if not total["n"]:
        return nodes.withColumn("rank", F.lit(0.0))
    even = 1.0 / total["n"]
    weights = weights.withColumn("w", F.col("w") / total["t"] if total["t"] else F.lit(even))
    degree = own.groupBy("src").agg(F.count("*").alias("degree"))
    nodes = cut(weights.join(degree.withColumnRenamed("src", "id"), "id", "left"))
    ranks = nodes.select("id", F.lit(even).alias("rank"))
    for _ in range(most_rounds):
        now = nodes.join(ranks, "id")
        sent = own.join(now.select(F.col("id").alias("src"), (F.col("rank") / F.col("degree")).alias("part")), "src").groupBy(F.col("dst").alias("id")).agg(F.sum("part").alias("got"))
        lost = now.where("degree is null").agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("lost"))
        moved = now.join(sent, "id", "left").crossJoin(F.broadcast(lost))
        fresh = F.lit(damping) * (F.coalesce("got", F.lit(0.0)) + F.col("lost") * F.col("w")) + F.lit(1 - damping) * F.col("w")
        after = cut(moved.select("id", fresh.alias("rank"), F.abs(fresh - F.col("rank")).alias("change")))
        change = after.agg(F.sum("change")).first()[0]
        ranks = after.select("id", "rank")
        if change < tolerance * total["n"]:
            return ranks
    raise RuntimeError(f"ranks still change by {change} after {most_rounds} rounds")


NEUTRAL_LOSSES = ("[M+H-NH3]+", "[M+H-H2O]+", "[M+H-NH3-H2O]+")


def ancestors(src, dst) -> dict:
    """For each node all nodes that lead to it; in memory, for one component."""
    before: dict = {}
    for a, b in zip(src, dst, strict=True):
        before.setdefault(b, set()).add(a)
        before.setdefault(a, set())
    out = {}
    for node in before:
        seen, todo = set(), list(before[node])
        while todo:
            x = todo.pop()
            if x not in seen and x != node:
                seen.add(x)
                todo.extend(before[x])
        out[node] = seen
    return out


def choose_representatives(edges: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
    """For one weak component: id, representative (0 or 1), and the errors and edges among its ancestors.

    The node of the largest rank is chosen, its ancestors leave with it, and so on. Among equal ranks the smallest id is
    looked at; if edges in both directions tie it with others, the target of the least m/z error among them is taken.
    Ions of several charges and isotopes leave without being chosen, as do those that a neutral loss of such an ion leads
    to; they hand the mark on to their neutral losses.
    """
    rank = dict(zip(nodes["id"], nodes["rank"], strict=True))
    marked = {i for i, m, s in zip(nodes["id"], nodes["multicharge_ion"], nodes["isotope_ion"], strict=True) if m > 0 or s > 0}
    first_marked = set(marked)
    own = edges[edges["src"] != edges["dst"]]
    links = {(a, b): (t, e, r) for a, b, t, e, r in zip(own["src"], own["dst"], own["annotation"], own["mz_error"], own["rt_error"], strict=True)}
    leads = ancestors([a for a, _ in links], [b for _, b in links])
    loss = lambda a, b: any(x in (links[a, b][0] or "") for x in NEUTRAL_LOSSES)
    left, chosen = set(rank), set()
    while left:
        top = max(rank[i] for i in left)
        ties = sorted(i for i in left if rank[i] == top)
        star = ties[0]
        mutual = [i for i in ties[1:] if (star, i) in links and (i, star) in links]
        if mutual:
            group = {star, *mutual}
            star = min(((links[a, b][1], a, b) for a, b in links if a in group and b in group))[2]
        inherited = any(b == star and a in first_marked and loss(a, b) for a, b in links)
        if star in marked or inherited:
            marked |= {b for a, b in links if a == star and b in left and loss(a, b)}
        else:
            chosen.add(star)
        left -= leads.get(star, set()) | {star}
    rows = []
    for i in sorted(rank):
        inside = leads.get(i, set()) | {i}
        path = [v for (a, b), v in links.items() if a in inside and b in inside] if i in chosen else []
        rows.append((i, int(i in chosen), round(sum(v[1] for v in path), 5), round(sum(v[2] for v in path), 5), len(path)))
    return pd.DataFrame(rows, columns=["id", "representative", "mz_error_sum", "rt_error_sum", "n_ancestor_edges"])


def protonated_representatives(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """id, rank, n_ancestors, representative, mz_error_sum, rt_error_sum, n_ancestor_edges.

    edges: src, dst, annotation, mz_error, rt_error (loops stand for lone nodes); nodes: id, multicharge_ion, isotope_ion.
    Ranks are PageRanks that restart at nodes by their number of ancestors.
    """
    found = components(edges.select(F.col("src").alias("id_a"), F.col("dst").alias("id_b")), nodes)
    placed = cut(edges.join(found.withColumnRenamed("id", "src"), "src"))

    def count(group: pd.DataFrame) -> pd.DataFrame:
        own = group[group["src"] != group["dst"]]
        got = ancestors(own["src"], own["dst"])
        for i in group["src"]:
            got.setdefault(i, set())
        return pd.DataFrame({"id": list(got), "n_ancestors": [len(v) for v in got.values()]})

    leads = cut(placed.groupBy("component").applyInPandas(count, "id long, n_ancestors long"))
    ranks = pagerank(edges, personal=leads.select("id", F.col("n_ancestors").alias("weight")))
    own = nodes.join(found, "id").join(ranks, "id", "left").fillna(0.0, ["rank"])

    def choose(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return choose_representatives(left, right)

    kinds = "id long, representative int, mz_error_sum double, rt_error_sum double, n_ancestor_edges long"
    chosen = placed.groupBy("component").cogroup(own.groupBy("component")).applyInPandas(choose, kinds)
    return chosen.join(own.select("id", "rank"), "id").join(leads, "id", "left").fillna(0, ["n_ancestors"])


def without_blanks(edges: DataFrame, blanks: DataFrame, expansion: int = 0) -> DataFrame:
    """Edges (id_a, id_b, ...) less blank nodes (id), and what lies within `expansion` steps of them; -1: their components."""
    if expansion == 0:
        gone = blanks.select("id").distinct()
    elif expansion > 0:
        gone = distance_from(edges, blanks, expansion).select("id")
    else:
        found = components(edges)
        gone = found.join(found.join(blanks.select("id"), "id").select("component").distinct(), "component").select("id")
    gone = cut(gone.unionByName(blanks.select("id")).distinct())
    return edges.join(gone.withColumnRenamed("id", "id_a"), "id_a", "left_anti").join(gone.withColumnRenamed("id", "id_b"), "id_b", "left_anti")


def protonated_networks(ivamn: DataFrame, ssmn: DataFrame, nodes: DataFrame, expansion: int, least_matched: int, k: int, most: int) -> tuple[DataFrame, DataFrame]:
    """The annotation network (id_a, id_b, ...) and the similarity network among representatives that aren't blank.

    nodes: id, blanks_total, representative. The similarity network is filtered by matched peaks, top k and size.
    """
    clean = without_blanks(ivamn, nodes.where("blanks_total > 0"), expansion)
    stays = clean.select(F.col("id_a").alias("id")).unionByName(clean.select(F.col("id_b").alias("id"))).distinct()
    chosen = cut(nodes.where("representative = 1").select("id").join(stays, "id", "left_semi"))
    among = lambda e: e.join(chosen.withColumnRenamed("id", "id_a"), "id_a", "left_semi").join(chosen.withColumnRenamed("id", "id_b"), "id_b", "left_semi")
    filtered = prune_components(mutual_top_k(min_matched(among(ssmn), least_matched), k), most)
    return among(clean), with_self_loops(filtered, chosen)


def network(pairs: DataFrame, nodes: DataFrame, least: float, least_matched: int, k: int, most: int) -> DataFrame:
    """The similarity network: threshold, matched peaks, mutual top k, component size, loops, component index."""
    kept = prune_components(mutual_top_k(min_matched(thresholded(pairs, least), least_matched), k), most)
    return component_index(with_self_loops(kept, nodes))


def described(edges: DataFrame, annotations: DataFrame) -> DataFrame:
    """Similarity edges with the annotations (id_a, id_b, annotation) of either direction, joined by ';'."""
    key = lambda d: d.withColumns({"_x": F.least("id_a", "id_b"), "_y": F.greatest("id_a", "id_b")})
    texts = key(annotations).groupBy("_x", "_y").agg(F.array_join(F.array_sort(F.collect_list("annotation")), ";").alias("annotation"))
    return key(edges).join(texts, ["_x", "_y"], "left").drop("_x", "_y")

