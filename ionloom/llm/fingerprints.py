"""Document fingerprints: the hashes of a text's word shingles that lie below a fixed share of all hashes.

Such sketches of two texts are samples by the same rule whatever the texts' lengths: their union is the union's sketch,
and the share of one that lies in the other estimates containment.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ionloom.llm.hashing import SHINGLE, shingle_hashes
from ionloom.llm.shared import record_batch, slices, small_batches, texts

#: One of so many hashes is retained.
SCALE = 4
#: Bits of a retained hash that the fingerprint spells out, ten hexadecimal digits.
BITS = 40
#: Neighbours are found in ranges of ids, of about so many rows; the driver holds a bound and an id for each range.
RANGE_ROWS, MOST_RANGES = 4096, 10_000


def sketches(items: list[bytes], scale: int = SCALE, width: int = SHINGLE) -> list[np.ndarray]:
    """For each text its retained hashes, distinct and ascending, cut to BITS bits."""
    below = (1 << 64) // scale
    shift = np.uint64(below.bit_length() - 1 - BITS)
    hashes, starts = shingle_hashes(items, width, below)
    return [np.unique(x) for x in np.split(hashes >> shift, starts[1:-1])] if len(items) else []


def spelled(raw: bytes, sketch: np.ndarray) -> str:
    """The fingerprint: a hash of the whole text, a colon, and the retained hashes; equal texts have equal ones."""
    return f"{xxhash.xxh3_64_hexdigest(raw)}:{sketch.astype('>u8').view(np.uint8).reshape(-1, 8)[:, 3:].tobytes().hex()}"


def parsed(fingerprint: str) -> tuple[str, np.ndarray]:
    whole, _, rest = fingerprint.partition(":")
    wide = np.zeros((len(rest) // 10, 8), np.uint8)
    wide[:, 3:] = np.frombuffer(bytes.fromhex(rest), np.uint8).reshape(-1, 5)
    return whole, wide.reshape(-1).view(">u8").astype(np.uint64)


def _likeness(a: np.ndarray, b: np.ndarray, same: bool) -> float:
    if not len(a) and not len(b):
        return float(same)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def likeness(a: str, b: str) -> float:
    """Estimated Jaccard similarity of two fingerprints' texts. Where both retain nothing: 1 for the same text, else 0."""
    (x, p), (y, q) = parsed(a), parsed(b)
    return _likeness(p, q, x == y)


def containment(a: str, b: str) -> float:
    """Estimated share of a's shingles that b holds, between texts of any lengths. Where a retains nothing: 1 for the same text, else 0."""
    (x, p), (y, q) = parsed(a), parsed(b)
    return len(np.intersect1d(p, q, assume_unique=True)) / len(p) if len(p) else float(x == y)


def merged(a: str, b: str) -> str:
    """The fingerprint of both texts' shingles together; its whole-text hash is that of the two hashes."""
    (x, p), (y, q) = parsed(a), parsed(b)
    return spelled((x + y).encode(), np.union1d(p, q)) if x != y else a


def fingerprint(docs: DataFrame, scale: int = SCALE, width: int = SHINGLE) -> DataFrame:
    """doc_id, n_retained, fingerprint of every row. Null texts count as empty; extra columns play no part."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_retained", pa.int64()), ("fingerprint", pa.string())])

    def run(batches):
        for batch in batches:
            keys, items = batch.column("doc_id").to_pylist(), texts(batch.column("text"))
            for lo, hi in slices([len(x) for x in items], 1 << 20):
                found = sketches(items[lo:hi], scale, width)
                yield record_batch(schema, doc_id=keys[lo:hi], n_retained=[len(x) for x in found], fingerprint=[spelled(t, x) for t, x in zip(items[lo:hi], found, strict=True)])

    return small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_retained long, fingerprint string")


def with_follower(docs: DataFrame) -> DataFrame:
    """doc_id, text dealt into ranges of ids, each sorted, with the row that follows a range at its end (late = 1).

    One shuffle moves each text once. The order is by id, null first, then by text; after the last comes the first.
    """
    from pyspark.ml.feature import Bucketizer

    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = own.select("doc_id")
    n = min(MOST_RANGES, max(1, ids.count() // RANGE_ROWS))
    cuts = sorted(set(ids.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n))) if n > 1 else []
    bounds = Bucketizer(splits=[float("-inf"), *(cuts or [0.0]), float("inf")], inputCol="id_value", outputCol="range")
    dealt = lambda df: bounds.transform(df.withColumn("id_value", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))).withColumn("range", F.col("range").cast("int"))
    heads = sorted(dealt(ids).groupBy("range").agg(F.min(F.struct("doc_id")).alias("head")).collect(), key=lambda r: r["range"])
    before = [(heads[k]["head"]["doc_id"], heads[k - 1]["range"]) for k in range(len(heads))]
    sent = spark.createDataFrame(before, "head_id long, prior int")
    rows = dealt(own).drop("id_value").join(F.broadcast(sent), F.col("doc_id").eqNullSafe(F.col("head_id")), "left")
    place = lambda r, late: F.struct(F.col(r).alias("range"), F.lit(late).alias("late"))
    places = F.when(F.col("prior").isNull(), F.array(place("range", 0))).otherwise(F.array(place("range", 0), place("prior", 1)))
    rows = rows.withColumn("place", F.explode(places)).select("place.range", "place.late", "doc_id", "text")
    return rows.repartition("range").sortWithinPartitions("range", "late", "doc_id", "text")


_EDITED = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _edit(raw: bytes, following: bytes) -> tuple[int, bytes]:
    """Code points of a text, and the text whose last quarter the start of the following one replaces."""
    text = raw.decode("utf-8", "surrogateescape")
    k = len(text) // 4
    if not k:
        return len(text), raw
    # k code points take 4 k bytes at most
    start = following[: 4 * k + 4].decode("utf-8", "surrogateescape")[:k]
    return len(text), (text[: len(text) - k] + start).encode("utf-8", "surrogateescape")


def compare_edited(docs: DataFrame, scale: int = SCALE, width: int = SHINGLE) -> DataFrame:
    """Each text's fingerprint beside those of its edited text and of the next document.

    The last quarter of a text (code points, rounded down) gives way to the first as many, or all, of the next document
    by ascending doc_id; the last is followed by the first, a lone one by itself. Null texts are empty. Rows without id
    come first; rows of one id follow each other by text. Extra columns play no part. No rows give no rows.
    """

    def pairs(batches):
        """(range, doc_id, text, text that follows), in order; memory holds one batch."""
        last = None
        for batch in batches:
            for r, late, key, raw in zip(batch.column("range").to_pylist(), batch.column("late").to_pylist(), batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
                if last is not None and last[0] == r:
                    yield last[1], last[2], raw
                    last = None
                if not late:
                    last = (r, key, raw)

    def emitted(rows):
        firsts, nexts = [x[1] for x in rows], [x[2] for x in rows]
        edits = [_edit(a, b) for a, b in zip(firsts, nexts, strict=True)]
        changed = [x[1] for x in edits]
        # mostly, the text that follows is the next row's own
        chain = all(nexts[i] is firsts[i + 1] for i in range(len(rows) - 1))
        own = sketches(firsts + nexts[-1:] if chain else firsts + nexts, scale, width)
        follow = own[1:] if chain else own[len(rows) :]
        after = sketches(changed, scale, width)
        return record_batch(
            _EDITED, doc_id=[x[0] for x in rows], n_chars=[x[0] for x in edits], edited_sha256=[hashlib.sha256(x).hexdigest() for x in changed],
            fingerprint=[spelled(t, s) for t, s in zip(firsts, own, strict=False)], edited_fingerprint=[spelled(t, s) for t, s in zip(changed, after, strict=True)],
            near_edited=[_likeness(a, b, x == y) for a, b, x, y in zip(own, after, firsts, changed, strict=False)], near_next=[_likeness(a, b, x == y) for a, b, x, y in zip(own, follow, firsts, nexts, strict=False)],
        )

    def run(batches):
        held, size = [], 0
        for row in pairs(batches):
            held.append(row)
            size += len(row[1])
            if size > 1 << 20:
                yield emitted(held)
                held, size = [], 0
        if held:
            yield emitted(held)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_follower(small_batches(docs)).mapInArrow(run, schema)
