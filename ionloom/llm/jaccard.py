"""N-gram Jaccard join of documents: word shingles, MinHash buckets, Bayesian candidate pruning, exact verification.

Equal texts are joined first, by a 128-bit hash, and go on as one numbered text. MinHash values of a text are grouped into bands; texts that
agree in a band meet in a bucket. There each pair's values are compared a few at a time: with m of n equal, the posterior
of the similarity is Beta(m + 1, n - m + 1) under a flat prior, and the pair is dropped once the probability of reaching
the threshold is below a tolerance. Texts that surviving pairs connect are brought together, and all links among them
are verified on their whole shingle sets. Large buckets and components are cut into tiles; pairs never become rows.
Texts of a component that needs several tiles don't travel to each: their shingle sets are told by what they differ in from
one text of the component, and with R that text's set and D the differences, |A & B| = |R| - |R - A| - |R - B| + |D(A) & D(B)|.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ionloom.llm.graphs import components, roots
from ionloom.llm.hashing import SHINGLE, shingle_hashes
from ionloom.llm.shared import bytes_of, kept, record_batch, slices, small_batches, texts

THRESHOLD = 0.8
#: A pair at the threshold misses all buckets with a probability of (1 - 0.8 ** ROWS) ** BANDS = 7e-6.
BANDS, ROWS = 30, 5
#: Values compared at a time, and the probability of reaching the threshold below which a pair is dropped.
STEP, TOLERANCE = 25, 1e-6
#: Texts in one tile of a bucket, and in a component (or a tile of one) whose texts are compared, and bytes there.
BUCKET_TILE, VERIFY_TILE, VERIFY_BYTES = 4096, 512, 8 << 20
#: Keys of one bucket that a worker holds; larger ones are cut into tiles by the count of their rows.
HELD_KEYS = 1 << 20
#: Bytes of text that a worker hashes at a time; it takes some fifty times that in memory.
HASHED_BYTES = 1 << 20
#: Membership of connected texts is broadcast up to this size; beyond it texts are shuffled to it.
BROADCAST_BYTES = 8 << 20

VALUES = BANDS * ROWS
_RNG = np.random.default_rng(20240501)
_XOR = _RNG.integers(0, 1 << 32, VALUES, dtype=np.uint32)
_TIMES = _RNG.integers(0, 1 << 31, VALUES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def fewest_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, values: int = VALUES, step: int = STEP) -> list[tuple[int, int]]:
    """(n, m): after n values, pairs with fewer than m equal ones are dropped."""
    out = []
    for n in range(step, values + 1, step):
        total, m = 0.0, 0
        while True:  # P(J >= t | m of n) = P(Binomial(n + 1, t) <= m)
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def signatures(items: list[bytes], width: int = SHINGLE) -> list[bytes | None]:
    """One byte of each MinHash value; None for a text without words."""
    hashes, starts = shingle_hashes(items, width, distinct=False)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    out: list[bytes | None] = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if a == b:
            out.append(None)
            continue
        least = None
        for at in range(a, b, 128):
            block = short[at : min(b, at + 128), None] ^ _XOR
            block *= _TIMES
            low = block.min(0)
            least = low if least is None else np.minimum(least, low)
        out.append(((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes())
    return out


def text_key(text):
    """By this 128-bit hash texts are told apart; null is empty."""
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def signed(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, text_key, n_bytes, sig (null for a text without words)."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.string()), ("n_bytes", pa.int64()), ("sig", pa.binary())])

    def run(batches):
        for batch in batches:
            items = texts(batch.column("text"))
            for lo, hi in slices([len(x) for x in items], HASHED_BYTES):
                yield record_batch(schema, doc_id=batch.column("doc_id").slice(lo, hi - lo), text_key=batch.column("text_key").slice(lo, hi - lo), n_bytes=[len(x) for x in items[lo:hi]], sig=signatures(items[lo:hi], width))

    own = small_batches(docs).select(F.col("doc_id").cast("long"), text_key(F.col("text")).alias("text_key"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, text_key string, n_bytes long, sig binary")


def _bands(batches):
    """bucket, key for every band of every signature."""
    schema = pa.schema([("bucket", pa.int64()), ("key", pa.int64())])
    weights = (np.int64(1) << (8 * np.arange(ROWS, dtype=np.int64)))[None, None, :]
    for batch in batches:
        if batch.num_rows:
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(-1, BANDS, ROWS).astype(np.int64)
            bucket = (sig * weights).sum(2) + (np.arange(BANDS, dtype=np.int64) << (8 * ROWS))[None, :]
            yield record_batch(schema, bucket=bucket.ravel(), key=np.repeat(batch.column("key").to_numpy(), BANDS))


def _tiles(n: int, tile: int) -> int:
    return max(1, -(-n // tile))


def _spread(group: int, keys: np.ndarray, tile: int) -> tuple[np.ndarray, ...]:
    """group, i, j, tile, key: each key in every pair of tiles that its own tile is part of."""
    nt = _tiles(len(keys), tile)
    own = np.arange(len(keys)) % nt
    other = np.tile(np.arange(nt), len(keys))
    own, key = np.repeat(own, nt), np.repeat(keys, nt)
    return np.full(len(key), group, np.int64), np.minimum(own, other), np.maximum(own, other), own, key


def _shared_buckets(held_keys: int):
    """Rows sorted by bucket to tile pairs of buckets that hold two texts or more; i is -1 for keys of buckets beyond held_keys."""
    schema = pa.schema([("bucket", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("tile", pa.int32()), ("key", pa.int64())])

    def emit(b, k):
        edge = np.flatnonzero(np.diff(b)) + 1
        starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(b)]])
        many = ends - starts >= 2
        small = many & (ends - starts <= BUCKET_TILE)
        rows = np.repeat(small, ends - starts)
        none = np.zeros(rows.sum(), np.int64)
        parts = [(b[rows], none, none, none, k[rows])]
        parts += [_spread(b[s], k[s:e], BUCKET_TILE) for s, e in zip(starts[many & ~small], ends[many & ~small], strict=True)]
        bucket, i, j, own, key = (np.concatenate(x) for x in zip(*parts, strict=True))
        return record_batch(schema, bucket=bucket, i=i.astype(np.int32), j=j.astype(np.int32), tile=own.astype(np.int32), key=key)

    def large(b, k):
        none = np.full(len(b), -1, np.int32)
        return record_batch(schema, bucket=b, i=none, j=none, tile=none, key=k)

    def run(batches):
        held_b, held_k = np.zeros(0, np.int64), np.zeros(0, np.int64)
        hot = None  # a bucket beyond held_keys, whose keys go on at once
        for batch in batches:
            if not batch.num_rows:
                continue
            b, k = batch.column("bucket").to_numpy(), batch.column("key").to_numpy()
            if hot is not None:
                n = int(np.searchsorted(b, hot, "right"))
                if n:
                    yield large(b[:n], k[:n])
                b, k = b[n:], k[n:]
                if not len(b):
                    continue
                hot = None
            held_b, held_k = np.concatenate([held_b, b]), np.concatenate([held_k, k])
            last = np.searchsorted(held_b, held_b[-1])  # the last bucket may go on
            if last:
                yield emit(held_b[:last], held_k[:last])
                held_b, held_k = held_b[last:], held_k[last:]
            if len(held_b) > held_keys:
                hot = held_b[0]
                yield large(held_b, held_k)
                held_b, held_k = held_b[:0], held_k[:0]
        if len(held_b):
            yield emit(held_b, held_k)

    return run


def _tiled(met: DataFrame) -> DataFrame:
    """met, keys of buckets beyond what a worker holds dealt out to their pairs of tiles by the buckets' counts."""
    if not met.where("i < 0").limit(1).count():
        return met
    far = met.where("i < 0")
    counts = kept(far.groupBy("bucket").agg(F.ceil(F.count("*") / F.lit(BUCKET_TILE)).cast("int").alias("tiles")), "jaccard-buckets")
    own = far.select("bucket", "key").join(counts, "bucket").withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return met.where("i >= 0").unionByName(own.select("bucket", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "key"))


def _pairs_within(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places inside each of several consecutive groups."""
    a, b, at = [], [], 0
    starts = np.cumsum(sizes) - sizes
    for m in np.unique(sizes):
        if m > 1:
            x, y = np.triu_indices(m, 1)
            own = starts[sizes == m][:, None]
            a.append((own + x).ravel())
            b.append((own + y).ravel())
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def prune(sig: np.ndarray, a: np.ndarray, b: np.ndarray, rule: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of sig whose posterior stays above the tolerance as more values are compared."""
    matches, seen = np.zeros(len(a), np.int32), 0
    for n, m in rule:
        matches += (sig[a, seen:n] == sig[b, seen:n]).sum(1, dtype=np.int32)
        seen = n
        alive = matches >= m
        if not alive.all():
            a, b, matches = a[alive], b[alive], matches[alive]
    return a, b


def _surviving(rule):
    """Per group of tile pairs: links from each text to the first one that surviving pairs connect it with."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def group_links(key, sig, tile, i, j):
        n = len(key)
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if i == j:
            rows = [(np.arange(n), x) for x in np.array_split(np.arange(n), max(1, n // 128))]
        else:
            one, two = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
            rows = [(two, x) for x in np.array_split(one, max(1, len(one) // 128))]
        for others, some in rows:
            x, y = np.repeat(some, len(others)), np.tile(others, len(some))
            if i == j:
                x, y = x[x < y], y[x < y]
            x, y = prune(sig, x, y, rule)
            # what connects is enough: one link for each text that has any
            first = roots(n, np.concatenate([a, x]), np.concatenate([b, y]))
            b = np.flatnonzero(first != np.arange(n))
            a = first[b]
        return a, b

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            g = [held.column(c).to_numpy() for c in ("bucket", "i", "j")]
            last = int(np.flatnonzero((g[0] == g[0][-1]) & (g[1] == g[1][-1]) & (g[2] == g[2][-1]))[0])
            if last:
                yield from links(held.slice(0, last))
                held = held.slice(last)
        if held is not None:
            yield from links(held)

    def links(rows):
        bucket, i, j, key, tile = (rows.column(c).to_numpy() for c in ("bucket", "i", "j", "key", "tile"))
        sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(-1, VALUES)
        edge = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(bucket)]])
        small = (ends - starts <= 64) & (i[starts] == j[starts])
        keep = np.repeat(small, ends - starts)
        place = np.flatnonzero(keep)
        a, b = _pairs_within((ends - starts)[small])
        found = [prune(sig, place[a], place[b], rule)] if len(a) else []
        for s, e in zip(starts[~small], ends[~small], strict=True):
            x, y = group_links(key[s:e], sig[s:e], tile[s:e], i[s], j[s])
            found.append((x + s, y + s))
        if not found:
            return
        a, b = np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])
        _, place = np.unique(key, return_inverse=True)
        first = roots(len(key), place[a], place[b])
        names = np.unique(key)
        touched = np.unique(np.concatenate([place[a], place[b]]))
        touched = touched[first[touched] != touched]
        yield record_batch(schema, a=names[touched], b=names[first[touched]])

    return run


def shared_counts(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many hashes each two of the sets share, by products of blocks of the incidence matrix."""
    n = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.cumsum(count > 1) - 1  # what only one set holds is shared by none
    many = count[place] > 1
    owner, place = owner[many], column[place[many]]
    out = np.zeros((n, n), np.float32)
    for at in range(0, int((count > 1).sum()), columns):
        here = (place >= at) & (place < at + columns)
        block = np.zeros((n, columns), np.float32)
        block[owner[here], place[here] - at] = 1
        out += block @ block.T
    return out


_VERIFIED = pa.schema([("comp", pa.int64()), ("tiles", pa.int32()), ("key", pa.int64()), ("root", pa.int64()), ("links", pa.int64()), ("linked_docs", pa.int64())])
_VERIFIED_SQL = "comp long, tiles int, key long, root long, links long, linked_docs long"


def _hash_sets(items: list[bytes], width: int) -> list[np.ndarray]:
    sets: list[np.ndarray] = []
    for lo, hi in slices([len(x) for x in items], HASHED_BYTES):
        hashes, starts = shingle_hashes(items[lo:hi], width)
        sets += np.split(hashes, starts[1:-1])
    return sets


def _linked(both: np.ndarray, size: np.ndarray, threshold: float) -> np.ndarray:
    union = size[:, None] + size[None, :] - both
    out = (both >= threshold * union - 1e-9) & (union > 0)
    np.fill_diagonal(out, False)
    return out


def _checked(comp: int, tiles: int, key: np.ndarray, weight: np.ndarray, linked: np.ndarray) -> pa.RecordBatch:
    a, b = np.nonzero(linked)
    first = roots(len(key), a[a < b], b[a < b])
    n = len(key)
    return record_batch(_VERIFIED, comp=[comp] * n, tiles=[tiles] * n, key=key, root=key[first], links=linked.sum(1), linked_docs=(linked * weight[None, :]).sum(1))


def _grouped(batches, by: list[str], columns: list[str], ready=None):
    """Rows sorted by `by`: each group's values of `columns` as lists, in turn. What is held is one group."""
    now, held = None, {}
    for batch in batches:
        values = {c: (texts if c == "text" else lambda x: x.to_pylist())(batch.column(c)) for c in {*by, *columns}}
        for r in range(batch.num_rows):
            group = tuple(values[c][r] for c in by)
            if group != now:
                if now is not None:
                    yield now, held
                now, held = group, {c: [] for c in columns}
            for c in columns:
                held[c].append(values[c][r])
    if now is not None:
        yield now, held


def _verify(threshold: float, width: int):
    """Whole components; rows that repeat a key are alike in text and id and count once."""

    def run(batches):
        for (comp,), rows in _grouped(batches, ["comp"], ["key", "n", "text"]):
            unique = sorted({k: p for p, k in enumerate(rows["key"])}.items())
            place = [p for _, p in unique]
            sets = _hash_sets([rows["text"][p] for p in place], width)
            size = np.array([len(s) for s in sets], np.float64)
            linked = _linked(shared_counts(sets).astype(np.float64), size, threshold)
            yield _checked(comp, 1, np.array([k for k, _ in unique], np.int64), np.array([rows["n"][p] for p in place], np.int64), linked)

    return run


_DIFFERENT = pa.schema([("comp", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("size", pa.int64()), ("whole", pa.int64()), ("lacks", pa.int64()), ("hashes", pa.binary())])


def _differences(width: int):
    """Rows sorted by comp, part, with the component's first text before the others: what each text's shingle set differs in from its."""

    def run(batches):
        now, first = None, None
        for batch in batches:
            own = {c: batch.column(c).to_pylist() for c in ("comp", "part", "lead", "key", "n")}
            items = texts(batch.column("text"))
            for lo, hi in slices([len(x) for x in items], HASHED_BYTES):
                out: dict[str, list] = {f.name: [] for f in _DIFFERENT}
                for r, found in zip(range(lo, hi), _hash_sets(items[lo:hi], width), strict=True):
                    if (own["comp"][r], own["part"][r]) != now:
                        now, first = (own["comp"][r], own["part"][r]), found
                    if own["lead"][r] == 0:
                        continue  # the first text, told to each part
                    apart = np.setxor1d(found, first, assume_unique=True)
                    lacks = len(first) - (len(found) + len(first) - len(apart)) // 2
                    for c, x in (("comp", own["comp"][r]), ("key", own["key"][r]), ("n", own["n"][r]), ("size", len(found)), ("whole", len(first)), ("lacks", lacks), ("hashes", apart.tobytes())):
                        out[c].append(x)
                yield record_batch(_DIFFERENT, **out)

    return run


def _verify_tiles(threshold: float):
    """Pairs of tiles of differences."""

    def run(batches):
        for (comp, i, j), rows in _grouped(batches, ["comp", "i", "j"], ["tiles", "tile", "key", "n", "size", "whole", "lacks", "hashes"]):
            unique = sorted({k: p for p, k in enumerate(rows["key"])}.items())
            place = [p for _, p in unique]
            column = lambda c, place=place, rows=rows: np.array([rows[c][p] for p in place], np.int64)
            size, lacks, tile = column("size").astype(np.float64), column("lacks").astype(np.float64), column("tile")
            sets = [np.frombuffer(rows["hashes"][p], np.uint64) for p in place]
            both = shared_counts(sets).astype(np.float64) + rows["whole"][0] - lacks[:, None] - lacks[None, :]
            linked = _linked(both, size, threshold)
            if i != j:
                linked &= tile[:, None] != tile[None, :]
            yield _checked(comp, rows["tiles"][0], np.array([k for k, _ in unique], np.int64), column("n"), linked)

    return run


def _verified_tiles(chosen: DataFrame, threshold: float, width: int) -> DataFrame:
    """Components of several tiles, from rows of comp, parts, key, n, text."""
    part = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    rows = chosen.select("comp", part.alias("part"), F.lit(1).alias("lead"), "key", "n", "text")
    leaders = chosen.where("key = comp").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))  # comp is its smallest key
    told = leaders.select("comp", "part", F.lit(0).alias("lead"), "key", "n", "text").unionByName(rows)
    told = told.repartition("comp", "part").sortWithinPartitions("comp", "part", "lead", "key")
    apart = kept(told.mapInArrow(_differences(width), "comp long, key long, n long, size long, whole long, lacks long, hashes binary").dropDuplicates(["key"]), "jaccard-differences")
    needed = F.greatest(F.ceil(F.count("*") / F.lit(VERIFY_TILE)), F.ceil(F.sum(F.octet_length("hashes")) / F.lit(VERIFY_BYTES))).cast("int")
    tiles = apart.groupBy("comp").agg(needed.alias("tiles"))
    spread = apart.join(tiles, "comp").withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    spread = spread.withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")}).drop("other")
    return spread.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j").mapInArrow(_verify_tiles(threshold), _VERIFIED_SQL)


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, width: int = SHINGLE, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, class_id, n_links, n_text_links, n_copies, text_key, class_key for every row of docs.

    Two documents are linked if their sets of word shingles have a Jaccard similarity of threshold or more, or if their
    texts are equal. class_id is the smallest doc_id that links connect (null if all are null); class_key is the smallest
    text_key that they connect, so it tells classes apart where ids are null or repeated. n_links counts linked documents,
    copies among them; n_text_links counts linked different texts; n_copies counts documents of the same text. A text of
    fewer words than width is one shingle; one without words is linked to its copies alone. Null texts are empty. Rows that
    repeat a doc_id are documents of their own. Extra columns play no part. No rows give no rows. The rule is exact for all
    pairs that meet in a bucket and survive pruning; README has the shares of others.
    """
    rule = fewest_matches(threshold, tolerance)
    every = kept(signed(docs, width), "jaccard-signed")
    unique = every.groupBy("text_key").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n"), F.first("n_bytes").alias("n_bytes"), F.first("sig").alias("sig"))
    unique = kept(unique.withColumn("key", F.monotonically_increasing_id()), "jaccard-texts")  # numbers hold once they are written
    some = unique.where("sig is not null").select("key", "sig")
    buckets = some.mapInArrow(_bands, "bucket long, key long").repartition("bucket").sortWithinPartitions("bucket", "key")
    met = _tiled(kept(buckets.mapInArrow(_shared_buckets(HELD_KEYS), "bucket long, i int, j int, tile int, key long"), "jaccard-buckets"))
    pairs = met.join(some, "key").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "key")
    links = pairs.select("bucket", "i", "j", "tile", "key", "sig").mapInArrow(_surviving(rule), "a long, b long")
    parts = kept(components(links), "jaccard-components")
    sized = parts.join(unique.select("key", "text_key", "first_doc", "n", "n_bytes"), "key").withColumnRenamed("root", "comp")
    needed = F.greatest(F.ceil(F.count("*") / F.lit(VERIFY_TILE)), F.ceil(F.sum("n_bytes") / F.lit(VERIFY_BYTES))).cast("int")
    needed = F.when(F.count("*") <= 2, 1).otherwise(needed)
    sizes = kept(parts.join(unique.select("key", "n_bytes"), "key").groupBy(F.col("root").alias("comp")).agg(needed.alias("parts")), "jaccard-sizes")
    placed = kept(sized.join(sizes, "comp").select("key", "text_key", "first_doc", "n", "comp", "parts"), "jaccard-placed")

    own = docs.select(F.col("doc_id").cast("long"), text_key(F.col("text")).alias("text_key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    wanted = F.broadcast(placed) if bytes_of(placed) <= BROADCAST_BYTES else placed.hint("merge")
    chosen = own.join(wanted, (own.text_key == placed.text_key) & F.col("doc_id").eqNullSafe(F.col("first_doc"))).select("comp", "parts", "key", "n", "text")
    whole = chosen.where("parts = 1").repartition("comp").sortWithinPartitions("comp")
    verified = whole.select("comp", "key", "n", "text").mapInArrow(_verify(threshold, width), _VERIFIED_SQL)
    if placed.where("parts > 1").limit(1).count():
        verified = verified.unionByName(_verified_tiles(chosen.where("parts > 1"), threshold, width))
    verified = kept(verified, "jaccard-verified")
    totals = verified.groupBy("key").agg(F.sum("links").alias("links"), F.sum("linked_docs").alias("linked_docs"), F.max("tiles").alias("tiles"), F.min("root").alias("root"))
    large = verified.where("tiles > 1")
    if large.limit(1).count():
        joined = components(large.select(F.col("key").alias("a"), F.col("root").alias("b"))).withColumnRenamed("root", "far")
        totals = totals.join(joined, "key", "left").withColumn("root", F.when(F.col("tiles") > 1, F.coalesce("far", "key")).otherwise(F.col("root"))).drop("far")
    totals = kept(totals, "jaccard-totals")
    lowest = totals.join(unique.select("key", "first_doc", "text_key"), "key").groupBy("root").agg(F.min("first_doc").alias("class_id"), F.min("text_key").alias("class_key"))
    classes = totals.join(lowest, "root").select("key", "class_id", "class_key", "links", "linked_docs")
    told = unique.select("key", "text_key", "first_doc", "n").join(classes, "key", "left")
    told = told.select(
        "text_key", F.coalesce("class_id", "first_doc").alias("class_id"), F.coalesce("class_key", "text_key").alias("class_key"), (F.coalesce("linked_docs", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("links", F.lit(0)).alias("n_text_links"), F.col("n").alias("n_copies"),
    )
    return every.select("doc_id", "text_key").join(kept(told, "jaccard-told"), "text_key").select("doc_id", "class_id", "n_links", "n_text_links", "n_copies", "text_key", "class_key")


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs, with their columns, less those that links connect with a smaller doc_id.

    One row of each class stays: that of its smallest id (rows without id come last), of those the one with the smallest
    text key, of rows alike in id and text any one. Classes are told apart by their texts: unrelated texts stay, whether
    their ids are null, repeated or neither. No rows give no rows.
    """
    classes = kept(jaccard_join(docs, **settings), "jaccard-classes")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key")
    best = kept(classes.groupBy("class_key").agg(F.min(order).alias("pick")).select(F.col("pick.doc_id").alias("id"), F.col("pick.text_key").alias("key")), "jaccard-kept")
    small = F.broadcast(best) if bytes_of(best) <= BROADCAST_BYTES else best.hint("merge")
    rows = docs.withColumns({"_row": F.struct(*docs.columns), "_id": F.col("doc_id").cast("long"), "_key": text_key(F.col("text"))}).select("_row", "_id", "_key")
    stay = rows.join(small, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_key") == F.col("key")), "left_semi")
    alike = classes.groupBy("doc_id", "text_key").count().where("count > 1")
    if alike.limit(1).count():
        stay = stay.groupBy("_id", "_key").agg(F.first("_row").alias("_row"))
    return stay.select("_row.*")
