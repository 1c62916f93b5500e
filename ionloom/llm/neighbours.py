"""Approximate nearest neighbours by cosine: an inverted file of lists, each scanned dimension block by block.

Vectors are scaled to length 1 and rotated at random, so that the first dimensions are a fair sample of a distance. In
each list that a query probes, a candidate is abandoned as soon as a hypothesis test on its partial distance rejects
that it could be among the nearest. The test starts from the k nearest in the sample that the lists are fitted on, which
are found already, and tightens with what else is. What is returned is scored on the original vectors.

How many lists a query probes is measured on that sample, for a wanted recall against brute force there: few where vectors
have structure, many where they have none. Lists that lie near each other form groups; rows go to their group, a query once
to each group in which it probes a list, and all queries of a list meet its rows in matrix products.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ionloom.llm.shared import kept, record_batch

#: Vectors, at most, that rotation and lists are fitted on.
SAMPLE_ROWS = 20_000
MOST_LISTS, LIST_GROUPS = 1024, 16
#: Recall on the sample that the number of probed lists is chosen for, and how many of its vectors ask.
WANTED_RECALL, ASKED_OF_SAMPLE = 0.95, 500
#: Vectors that a query sees at least, where there are as many.
FEWEST_SEEN = 512
#: Rows of a group of lists, and queries of one, that one task meets.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 2048
COLUMNS = 16
#: Width of the test: how far the partial distance may lie above what the bound makes likely.
EPSILON = 2.1
#: Rows of a list that meet its queries at a time, and pairs whose remaining dimensions are looked at together.
CHUNK, PAIRS = 1024, 1 << 16


class Index:
    def __init__(self, rotation: np.ndarray, centres: np.ndarray):
        self.rotation, self.centres = rotation, centres

    def place(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rotated vectors of length 1 and their nearness to each list's centre."""
        unit = scaled(vectors) @ self.rotation
        return unit, unit @ self.centres.T - 0.5 * (self.centres * self.centres).sum(1)


def scaled(vectors: np.ndarray) -> np.ndarray:
    top = np.abs(vectors).max(1, keepdims=True)
    x = vectors / top
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit(sample: np.ndarray, n_lists: int, seed: int = 0, rounds: int = 8) -> Index:
    rng = np.random.default_rng(seed)
    d = sample.shape[1]
    rotation = np.linalg.qr(rng.normal(size=(d, d)))[0]
    unit = scaled(sample) @ rotation
    centres = unit[rng.choice(len(unit), n_lists, replace=False)]
    for _ in range(rounds):
        near = (unit @ centres.T - 0.5 * (centres * centres).sum(1)).argmax(1)
        count = np.bincount(near, minlength=n_lists)
        total = np.zeros_like(centres)
        np.add.at(total, near, unit)
        centres = np.where(count[:, None] > 0, total / np.maximum(1, count)[:, None], unit[rng.integers(0, len(unit), n_lists)])
    return Index(rotation, centres)


def cosines(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Of rows and queries in pairs, in double precision, added in one fixed order, so that equal vectors have equal scores."""
    dot, norm, own = np.zeros(len(rows)), np.zeros(len(rows)), np.zeros(len(rows))
    for j in range(rows.shape[1]):
        x, y = rows[:, j], queries[:, j]
        dot += x * y
        norm += x * x
        own += y * y
    return dot / (np.sqrt(norm) * np.sqrt(own))


class Best:
    """The k best of each query so far: by score, ties to the smaller id."""

    def __init__(self, n: int, k: int, bound: np.ndarray):
        self.k, self.bound = k, bound.copy()
        self.query, self.ids, self.rows, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, query: np.ndarray, ids: np.ndarray, rows: np.ndarray, score: np.ndarray) -> None:
        query, ids, rows, score = np.concatenate([self.query, query]), np.concatenate([self.ids, ids]), np.concatenate([self.rows, rows]), np.concatenate([self.score, score])
        order = np.lexsort((rows, ids, -score, query))
        query, ids, rows, score = query[order], ids[order], rows[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        stays = place < self.k
        last = place == self.k - 1
        self.bound[query[last]] = np.minimum(self.bound[query[last]], 2 - 2 * score[last] + 1e-9)
        self.query, self.ids, self.rows, self.score = query[stays], ids[stays], rows[stays], score[stays]


def scan(ids: np.ndarray, rows: np.ndarray, unit: np.ndarray, original: np.ndarray, asking: np.ndarray, query_ids: np.ndarray, query_unit: np.ndarray, query: np.ndarray, best: Best, epsilon: float = EPSILON, columns: int = COLUMNS, chunk: int = CHUNK) -> None:
    """Adds to best what these rows hold for the queries at the places `asking` (rows of a query's own id are left out)."""
    d = unit.shape[1]

    def limit(bound, seen):
        # at `seen` of d dimensions a distance within the bound shows bound * seen / d, give or take
        return bound * (seen / d) * (1 + epsilon / np.sqrt(seen)) ** 2 + 1e-12 if seen < d else bound + 1e-9

    first = query_unit[asking, :columns]
    for at in range(0, len(ids), chunk):
        own, block = ids[at : at + chunk], unit[at : at + chunk]
        seen = min(columns, d)
        head = block[:, :columns]
        partial = (first * first).sum(1)[:, None] + (head * head).sum(1)[None, :] - 2 * (first @ head.T)
        alive = (partial <= limit(best.bound[asking], seen)[:, None]) & (query_ids[asking][:, None] != own[None, :])
        i, j = np.nonzero(alive)
        part = partial[i, j]
        i = asking[i]
        for lo in range(0, len(i), PAIRS):
            a, b, x = i[lo : lo + PAIRS], j[lo : lo + PAIRS], part[lo : lo + PAIRS]
            for s in range(columns, d, columns):
                step = block[b, s : s + columns] - query_unit[a, s : s + columns]
                x = x + np.einsum("ij,ij->i", step, step)
                stays = x <= limit(best.bound[a], min(d, s + columns))
                a, b, x = a[stays], b[stays], x[stays]
            if len(a):
                best.add(a, own[b], rows[at + b], cosines(original[at + b], query[a]))


def probes_for(index: Index, sample: np.ndarray, k: int, wanted: float, seed: int = 0) -> int:
    """How many lists must be probed for so large a share of the nearest that brute force finds in the sample."""
    unit, near = index.place(sample)
    asked = np.random.default_rng(seed).permutation(len(sample))[:ASKED_OF_SAMPLE]
    like = unit[asked] @ unit.T
    like[np.arange(len(asked)), asked] = -np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return near.shape[1]
    top = np.argpartition(-like, k - 1, axis=1)[:, :k]
    place = np.empty((len(asked), near.shape[1]), np.int64)
    np.put_along_axis(place, np.argsort(-near[asked], axis=1, kind="stable"), np.arange(near.shape[1])[None, :], 1)
    needed = np.take_along_axis(place, near.argmax(1)[top], 1)
    return int(np.quantile(needed, wanted, method="higher")) + 1


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) of rows with an id and a finite, non-zero vector of the most frequent length."""
    own = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and embedding is not null")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = own.where(finite & F.exists("embedding", lambda x: x != 0))
    length = own.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return own.where(F.size("embedding") == (length["n"] if length else 0))


def _matrix(column, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.float64)


def distinct_enough(own: DataFrame, k: int) -> DataFrame:
    """Candidates: of rows with equal vectors all that can be among the k nearest of any query, the k + 1 smallest ids, each k times at most.

    Nothing is lost: equal vectors are equally near to a query and ties go to the smaller id, so before each row left out come
    k others at least that aren't the query's own. Queries are not taken from these rows but from all.
    """
    rows = own.withColumn("_n", F.row_number().over(Window.partitionBy("embedding", "vec_id").orderBy("vec_id"))).where(F.col("_n") <= k)
    rows = rows.withColumn("_n", F.dense_rank().over(Window.partitionBy("embedding").orderBy("vec_id"))).where(F.col("_n") <= k + 1)
    return rows.drop("_n")


def nearest(vectors: DataFrame, k: int = 5, query_every: int = 50, wanted_recall: float = WANTED_RECALL, sample_rows: int = SAMPLE_ROWS, epsilon: float = EPSILON, seed: int = 0) -> DataFrame:
    """query_id, rank, vec_id, score: for rows whose vec_id is divisible by query_every, their k nearest other rows.

    Vectors that are null, zero, of another length than most, or that hold null or non-finite components take no part;
    nor do rows without vec_id. All rows are indexed; the lists are fitted on at most sample_rows. Rows that share a
    vec_id are candidates of their own, but never for their own id; of those that share a query's, the one with the
    smallest vector asks, however many rows equal it. Fewer candidates than k are all returned. Extra columns play no part. No
    rows give no rows.
    """
    every_row = usable(vectors)
    own = kept(distinct_enough(every_row, k).withColumn("row", F.monotonically_increasing_id()), "ann-rows")  # numbers hold once they are written
    spark = own.sparkSession
    n = own.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = own.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(sample_rows).collect()
    sample, sample_ids, sample_rows_ = np.array([r.embedding for r in rows]), np.array([r.vec_id for r in rows]), np.array([r.row for r in rows])
    del rows
    d = sample.shape[1]
    n_lists = max(1, min(MOST_LISTS, int(2 * n**0.5), len(sample) // 16))
    index = fit(sample, n_lists, seed)
    probes = probes_for(index, sample, k, wanted_recall, seed)
    # lists near each other are a group: those that lie nearest to one of some lists
    groups = (index.centres @ index.centres[:LIST_GROUPS].T - 0.5 * (index.centres[:LIST_GROUPS] ** 2).sum(1)).argmax(1)
    sent = spark.sparkContext.broadcast((index.rotation, index.centres, sample, sample_ids, sample_rows_, groups))
    listed = pa.schema([("list", pa.int32()), ("group", pa.int32()), ("row", pa.int64()), ("vec_id", pa.int64()), ("embedding", pa.list_(pa.float64()))])

    def assign(batches):
        rotation, centres, _, _, _, of_list = sent.value
        for batch in batches:
            if batch.num_rows:
                near = Index(rotation, centres).place(_matrix(batch.column("embedding"), d))[1].argmax(1)
                yield record_batch(listed, list=near.astype(np.int32), group=of_list[near].astype(np.int32), row=batch.column("row"), vec_id=batch.column("vec_id"), embedding=batch.column("embedding"))

    placed = kept(own.mapInArrow(assign, "list int, group int, row long, vec_id long, embedding array<double>"), "ann-lists")
    counts = np.zeros(n_lists, np.int64)
    for r in placed.groupBy("list").count().collect():  # a row for each list, MOST_LISTS at most
        counts[r["list"]] = r["count"]
    hit = pa.struct([("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    asked_schema = pa.schema([("group", pa.int32()), ("vec_id", pa.int64()), ("embedding", pa.list_(pa.float64())), ("bound", pa.float64()), ("lists", pa.list_(pa.int32())), ("hits", pa.list_(hit))])

    def probe(batches):
        rotation, centres, some, some_ids, some_rows, of_list = sent.value
        unit = (scaled(some) @ rotation).astype(np.float32)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids = batch.column("vec_id").to_numpy()
                own_unit, near = Index(rotation, centres).place(_matrix(batch.column("embedding"), d))
                order = np.argsort(-near, axis=1, kind="stable")
                reached = np.cumsum(counts[order], axis=1)
                wanted = np.maximum(probes, 1 + (reached < FEWEST_SEEN + 1).sum(1)).clip(max=n_lists)
                like = own_unit.astype(np.float32) @ unit.T
                like[ids[:, None] == some_ids[None, :]] = -np.inf
                bound, hits = np.full(len(ids), np.inf), []
                queries = _matrix(batch.column("embedding"), d)
                for r in range(len(ids)):
                    near_by = np.argpartition(-like[r], k)[: k + 1] if len(some_ids) > k else np.arange(len(some_ids))
                    near_by = np.flatnonzero(like[r] >= like[r][near_by].min() - 1e-4) if len(some_ids) > k else near_by
                    near_by = near_by[like[r][near_by] > -np.inf]
                    scored = cosines(some[near_by], np.repeat(queries[r : r + 1], len(near_by), 0))
                    first = np.lexsort((some_ids[near_by], -scored))[:k]
                    if len(first) == k:
                        # the k-th distance within the sample is no smaller than that within all rows
                        bound[r] = 2 - 2 * scored[first[-1]] + 1e-9
                    hits.append([{"row": int(some_rows[near_by[i]]), "vec_id": int(some_ids[near_by[i]]), "score": float(scored[i])} for i in first])
                out: dict[str, list] = {"group": [], "row": [], "lists": [], "hits": []}
                for r in range(len(ids)):
                    lists = np.sort(order[r, : wanted[r]])
                    lists = lists[counts[lists] > 0]
                    for n_group, g in enumerate(np.unique(of_list[lists]).tolist()):
                        out["group"].append(g)
                        out["row"].append(r)
                        out["lists"].append(lists[of_list[lists] == g].astype(np.int32))
                        out["hits"].append(hits[r] if n_group == 0 else [])
                taken = pa.array(out["row"], pa.int64())
                yield record_batch(asked_schema, group=out["group"], vec_id=batch.column("vec_id").take(taken), embedding=batch.column("embedding").take(taken), bound=bound[out["row"]], lists=out["lists"], hits=out["hits"])

    asking = every_row.where(F.col("vec_id") % query_every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = kept(asking.mapInArrow(probe, "group int, vec_id long, embedding array<double>, bound double, lists array<int>, hits array<struct<row:long,vec_id:long,score:double>>"), "ann-queries")
    sizes, asked_sizes = ({r["group"]: r["count"] for r in x.groupBy("group").count().collect()} for x in (placed, asked))  # LIST_GROUPS rows at most
    shape = spark.createDataFrame([(g, -(-sizes[g] // BLOCK_ROWS), -(-max(1, asked_sizes.get(g, 0)) // BLOCK_QUERIES)) for g in sorted(sizes)], "group int, n_blocks int, n_asked int")
    # a large group is cut into blocks of rows and of its queries; every block of rows meets every block of queries
    part = lambda n: F.pmod(F.xxhash64("vec_id", "embedding"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    candidates = placed.join(F.broadcast(shape), "group").withColumn("block", part("n_blocks")).withColumn("asked", every("n_asked"))
    queries = asked.join(F.broadcast(shape), "group").withColumn("asked", part("n_asked")).withColumn("block", every("n_blocks"))
    key = ["group", "block", "asked"]

    def meet(group: pa.Table, ask: pa.Table) -> pa.Table:
        best = Best(ask.num_rows, k, ask.column("bound").to_numpy())
        query_ids = ask.column("vec_id").to_numpy()
        if group.num_rows and ask.num_rows:
            rotation, centres = sent.value[:2]
            group = group.sort_by([("list", "ascending"), ("vec_id", "ascending")])
            of_row, ids, row, original = group.column("list").to_numpy(), group.column("vec_id").to_numpy(), group.column("row").to_numpy(), _matrix(group.column("embedding"), d)
            queries = _matrix(ask.column("embedding"), d)
            unit, query_unit = scaled(original) @ rotation, scaled(queries) @ rotation
            lists = ask.column("lists").combine_chunks()
            flat, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            for one in np.unique(of_row).tolist():
                lo, hi = np.searchsorted(of_row, [one, one + 1])
                a, b = np.searchsorted(flat, [one, one + 1])
                if a < b:
                    scan(ids[lo:hi], row[lo:hi], unit[lo:hi], original[lo:hi], owner[a:b], query_ids, query_unit, queries, best, epsilon)
        return pa.table({"query_id": pa.array(query_ids[best.query], pa.int64()), "row": pa.array(best.rows, pa.int64()), "vec_id": pa.array(best.ids, pa.int64()), "score": pa.array(best.score, pa.float64())})

    found = candidates.select(*key, "list", "row", "vec_id", "embedding").groupBy(*key).cogroup(queries.select(*key, "vec_id", "embedding", "bound", "lists").groupBy(*key)).applyInArrow(meet, "query_id long, row long, vec_id long, score double")
    found = found.unionByName(asked.select(F.col("vec_id").alias("query_id"), F.explode("hits").alias("h")).select("query_id", "h.*")).dropDuplicates(["query_id", "row"])
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
