"""Suffix-array dedup: bytes covered by long strings that also start earlier in the corpus.

Suffixes that share `length` bytes are found in three steps. Anchors: each string of that length holds a q-gram whose hash
is its window's smallest, the same one wherever the string occurs; anchors are dealt out by hash, and those that occur
once drop out. Contexts: around each repeated anchor, the bytes that a string through it can reach. Bucket-pointer
refinement: the contexts' suffixes start in buckets by their first eight bytes; buckets are refined by sorting on the
bucket identifiers of later offsets, 8, 16, 32, ... bytes on, where each round reuses the identifiers that the one before
has updated, until suffixes agree to the full length. Buckets of one suffix drop out as they appear.

No task holds all contexts of an anchor. Where more of them differ than a worker refines at once, they are dealt out anew,
twice: by the core (the anchor at first) with half of the missing bytes before it, and with half of them after it. Each
string through the core holds one of these longer cores. After seven such rounds a core is a whole string.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ionloom.llm.shared import flat, kept, record_batch, slices, small_batches, texts

LENGTH = 100
GRAM = 24
#: Bytes that a numpy pass over a text holds at once; contexts that one refinement holds.
CHUNK = 1 << 20
CONTEXT_ROWS = 1 << 13
#: Contexts among which a worker leaves out those alike before they are dealt out.
COLLAPSED_ROWS = 1 << 14
_LAST = (1 << 63) - 1
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _words_at(raw: np.ndarray, n: int) -> np.ndarray:
    """The eight bytes at each of the first n + 16 places, as one number."""
    m = -(-(n + 16) // 8) * 8
    padded = np.zeros(m + 16, np.uint8)
    padded[: len(raw)] = raw
    data, out = padded.tobytes(), np.empty(m, np.uint64)
    for k in range(8):
        out[k::8] = np.frombuffer(data, "<u8", m // 8, k)
    return out


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes at each place of raw; places near the end take zeros in."""
    n = len(raw)
    u = _words_at(raw, n)
    return _mixed(u[:n], u[8 : n + 8], u[16 : n + 16])


def _mixed(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    x = a * _C[0] + b * _C[1] + c * _C[2]
    x ^= x >> np.uint64(29)
    x *= _C[3]
    x ^= x >> np.uint64(32)
    return x


def anchors(buffer: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all texts in the buffer, ascending."""
    n, w = len(buffer), length - GRAM + 1
    step = np.zeros(n + 1, np.int8)
    long = np.diff(starts) >= length
    np.add.at(step, starts[:-1][long], 1)
    np.add.at(step, starts[1:][long] - length + 1, -1)
    valid = np.cumsum(step[:n], dtype=np.int8) > 0  # a string may start here
    places, hashes = [], []
    for at in range(0, n, CHUNK):
        ok = valid[at : at + CHUNK]
        if not ok.any():
            continue
        raw = buffer[at : at + CHUNK + length]
        h = gram_hashes(raw)
        bits = np.uint64((1 << int(len(raw)).bit_length()) - 1)
        blocks = -(-(len(raw) + w) // w)
        key = np.full(blocks * w, np.uint64(2**64 - 1))
        key[: len(raw)] = (h & ~bits) | np.arange(len(raw), dtype=np.uint64)
        ahead = np.minimum.accumulate(key.reshape(blocks, w), axis=1).ravel()
        behind = np.minimum.accumulate(key.reshape(blocks, w)[:, ::-1], axis=1)[:, ::-1].ravel()
        m = len(ok)
        least = np.minimum(behind[:m], ahead[w - 1 : w - 1 + m])[ok] & bits
        chosen = np.zeros(len(raw), bool)
        chosen[least.astype(np.int64)] = True
        found = np.flatnonzero(chosen)
        places.append(found + at)
        hashes.append(h[found])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first]


#: What an anchor's row is: the only one of its hash among some texts; one of several there, so known to be repeated and
#: dealt out by place, not by hash; or, once for those, a row without place that tells others of the hash.
ALONE, SEVERAL, TELLS = 0, 1, 2
_ANCHOR = pa.schema([("key", pa.int64()), ("kind", pa.int32()), ("ord", pa.int64()), ("tie", pa.int64()), ("pos", pa.int64())])


def _find_anchors(length: int):
    def run(batches):
        for batch in batches:
            items = texts(batch.column("text"))
            ord_, tie = batch.column("ord").to_numpy(), batch.column("tie").to_numpy()
            for lo, hi in slices([len(x) for x in items], 4 << 20):
                buffer, starts = flat(items[lo:hi])
                place, h = anchors(buffer, starts, length)
                owner = np.searchsorted(starts, place, "right") - 1
                names, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
                several = count[inverse] > 1
                own_ord, own_tie, pos = ord_[lo + owner], tie[lo + owner], place - starts[owner]
                spread = (own_ord.astype(np.uint64) * _C[0] + pos.astype(np.uint64) * _C[1]) ^ own_tie.view(np.uint64)
                told = np.flatnonzero(count > 1)
                key = np.concatenate([np.where(several, spread, h), names[told]]).view(np.int64)
                kind = np.concatenate([np.where(several, SEVERAL, ALONE), np.full(len(told), TELLS)]).astype(np.int32)
                none = np.zeros(len(told), np.int64)
                yield record_batch(_ANCHOR, key=key, kind=kind, ord=np.concatenate([own_ord, none]), tie=np.concatenate([own_tie, none]), pos=np.concatenate([pos, none]))

    return run


def _repeated(batches):
    """Of rows sorted by key, those of hashes that another row has too, and those known to be. One row is held back."""
    held = None
    schema = pa.schema([("ord", pa.int64()), ("tie", pa.int64()), ("pos", pa.int64())])
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        h, kind = rows.column("key").to_numpy(), rows.column("kind").to_numpy()
        same = np.zeros(len(h) + 1, bool)
        same[1:-1] = h[1:] == h[:-1]
        same[0] = before is not None and before == h[0]
        often = (kind == SEVERAL) | (kind == ALONE) & (same[:-1] | same[1:])
        done = len(h) - 1
        take = pa.array(np.flatnonzero(often[:done]))
        yield pa.RecordBatch.from_arrays([rows.column(c).take(take) for c in schema.names], schema=schema)
        held = rows.slice(done)
        before = h[done - 1] if done else before
    if held is not None and (held.column("kind")[0].as_py() == SEVERAL or held.column("kind")[0].as_py() == ALONE and before is not None and held.column("key")[0].as_py() == before):
        yield pa.RecordBatch.from_arrays([held.column(c) for c in schema.names], schema=schema)


_CONTEXT = pa.schema([("key", pa.int64()), ("ord", pa.int64()), ("tie", pa.int64()), ("pos", pa.int64()), ("before", pa.int32()), ("after", pa.int32()), ("context", pa.binary())])
_CONTEXT_SQL = "key long, ord long, tie long, pos long, before int, after int, context binary"


def _find_contexts(length: int):
    reach = length - GRAM  # bytes before an anchor that a string through it can start at

    def run(batches):
        for batch in batches:
            items, positions = texts(batch.column("text")), batch.column("positions").to_pylist()
            for key, tie, raw, own in zip(batch.column("ord").to_pylist(), batch.column("tie").to_pylist(), items, positions, strict=True):
                every, whole = np.unique(np.array(own, np.int64)), np.frombuffer(raw, np.uint8)
                for at in range(0, len(every), COLLAPSED_ROWS):
                    pos = every[at : at + COLLAPSED_ROWS]
                    start, end = np.maximum(0, pos - reach), np.minimum(len(raw), pos + length)
                    grams = whole[pos[:, None] + np.arange(GRAM)[None, :]].view("<u8")
                    h = _mixed(grams[:, 0], grams[:, 1], grams[:, 2]).view(np.int64)
                    found = [raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                    n = len(pos)
                    yield record_batch(_CONTEXT, key=h, ord=np.full(n, key), tie=np.full(n, tie), pos=pos, before=(pos - start).astype(np.int32), after=(end - pos).astype(np.int32), context=found)

    def collapsed(batches):
        """Contexts alike, within some texts: all but the first are sent on without their bytes, by any key."""
        held, size = [], 0
        for batch in run(batches):
            held.append(batch)
            size += batch.num_rows
            if size >= COLLAPSED_ROWS:
                yield first_only(held)
                held, size = [], 0
        if held:
            yield first_only(held)

    def first_only(parts):
        rows = pa.Table.from_batches(parts).combine_chunks()
        ord_, tie, pos = (rows.column(c).to_numpy() for c in ("ord", "tie", "pos"))
        matrix, h, before, after = _matrix(rows, length)
        later = _later(matrix, h, before, after, ord_, tie, pos)[0]
        key = np.where(later, (pos * 0x9E3779B1) ^ ord_, h)
        context = pa.array([None if x else c for x, c in zip(later.tolist(), rows.column("context").to_pylist(), strict=True)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(key), *(rows.column(c).combine_chunks() for c in _CONTEXT.names[1:-1]), context], schema=_CONTEXT)

    return collapsed


def _matrix(rows, length: int) -> tuple[np.ndarray, ...]:
    """Contexts as rows of bytes with the anchor at one place; their keys; bytes before and from the anchor."""
    reach = length - GRAM
    before, after = rows.column("before").to_numpy().astype(np.int64), rows.column("after").to_numpy().astype(np.int64)
    width = -(-(reach + length) // 8) * 8
    out = np.zeros((len(before), width), np.uint8)
    data = np.frombuffer(b"".join(rows.column("context").to_pylist()), np.uint8)
    n = before + after
    starts = np.cumsum(n) - n
    full = (before == reach) & (after == length)
    if full.any():
        out[full, : reach + length] = data[starts[full][:, None] + np.arange(reach + length)[None, :]]
    for r in np.flatnonzero(~full).tolist():
        out[r, reach - before[r] : reach + after[r]] = data[starts[r] : starts[r] + n[r]]
    return out, rows.column("key").to_numpy(), before, after


def _later(matrix, h, before, after, ord_, tie, pos) -> tuple[np.ndarray, np.ndarray]:
    """Which contexts are like an earlier one with the same key; the order by key, context, place."""
    words = matrix.view(np.uint64)
    multipliers = (np.arange(1, words.shape[1] + 1, dtype=np.uint64) * _C[1]) | np.uint64(1)
    digest = (words * multipliers[None, :]).sum(1, dtype=np.uint64) + (before * 512 + after).astype(np.uint64) * _C[2]
    digest ^= digest >> np.uint64(31)
    order = np.lexsort((pos, tie, ord_, digest, h))
    a, b = order[1:], order[:-1]
    alike = (h[a] == h[b]) & (digest[a] == digest[b]) & (before[a] == before[b]) & (after[a] == after[b])
    alike &= (matrix[a] == matrix[b]).all(1)
    out = np.zeros(len(h), bool)
    out[a] = alike
    return out, order


def _digest(part: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of bytes."""
    width = -(-part.shape[1] // 8) * 8
    padded = np.zeros((len(part), width), np.uint8)
    padded[:, : part.shape[1]] = part
    words = padded.view(np.uint64)
    out = ((words ^ (words >> np.uint64(31))) * ((np.arange(1, width // 8 + 1, dtype=np.uint64) * _C[1]) | np.uint64(1))[None, :]).sum(1, dtype=np.uint64)
    return (out ^ (out >> np.uint64(29))) * _C[0]


def _half(length: int, core: int) -> int:
    """Of the bytes that a core lacks to be a string, how many lie on one of its sides at least."""
    return -(-(length - core) // 2)


def _half_shared(matrix, key, low, core: int, length: int) -> np.ndarray:
    """Which contexts share the half string before, or that after, their core with another of the same key.

    The core of each is at low from the anchor (0 or less), `core` bytes long. Every string through it holds one of these halves.
    """
    half = _half(length, core)
    out = np.zeros(len(key), bool)
    for at in (length - GRAM + low - half, length - GRAM + low + core):
        part = matrix[np.arange(len(key))[:, None], np.clip(at[:, None] + np.arange(half)[None, :], 0, matrix.shape[1] - 1)]
        _, inverse, count = np.unique(_digest(part) + key.view(np.uint64) * _C[2], return_inverse=True, return_counts=True)
        out |= count[inverse] > 1
    return out


def refine(matrix: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Bucket of the string of `length` bytes at each (row, column), for strings of one group and column; -1 where it's alone.

    Bucket-pointer refinement: depth 8, then twice as deep with each round, by pairs of identifiers at two offsets.
    """
    rows, width = matrix.shape
    n = width - 8 + 1
    grams = np.empty((rows, n), np.uint64)
    for k in range(8):
        part = np.ascontiguousarray(matrix[:, k : k + (n - k + 7) // 8 * 8])
        cols = np.arange(k, n, 8)
        grams[:, cols] = part.view(np.uint64)[:, : len(cols)]
    _, value = np.unique(grams.ravel(), return_inverse=True)
    key = value.astype(np.int64) * (int(group.max()) + 1) + np.repeat(group, n)
    bucket = _buckets(key * width + np.tile(np.arange(n), rows), np.arange(rows * n), rows * n).reshape(rows, n)
    depth = 8
    while depth < length:
        shift = min(depth, length - depth)
        here, there = bucket[:, :-shift], bucket[:, shift:]
        both = np.flatnonzero(((here >= 0) & (there >= 0)).ravel())
        key = (here.ravel()[both].astype(np.int64) << 32) | there.ravel()[both]
        bucket = _buckets(key, both, here.size).reshape(here.shape)
        depth += shift
    return bucket


def _buckets(key: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
    """Identifiers by key, put at their places; -1 elsewhere and for keys that come once."""
    out = np.full(size, -1, np.int64)
    if len(key):
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        out[place] = np.where(count[inverse] > 1, inverse, -1)
    return out


#: What a round finds: covered bytes, or contexts (with the place of their core) for the next round, dealt out by key.
_FOUND = pa.schema([("ord", pa.int64()), ("tie", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("key", pa.int64()), ("low", pa.int32()), ("pos", pa.int64()), ("before", pa.int32()), ("after", pa.int32()), ("context", pa.binary())])
_FOUND_SQL = "ord long, tie long, begin long, end long, key long, low int, pos long, before int, after int, context binary"


def _found(**columns) -> pa.RecordBatch:
    n = len(columns["ord"])
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _FOUND], schema=_FOUND)


def _covered_in(rows, length: int, core: int) -> pa.RecordBatch:
    """Covered bytes in contexts that their keys bring together."""
    reach = length - GRAM
    ord_, tie, pos = (rows.column(c).to_numpy() for c in ("ord", "tie", "pos"))
    before, after = rows.column("before").to_numpy().astype(np.int64), rows.column("after").to_numpy().astype(np.int64)
    sent = np.array(rows.column("context").is_null())
    covered = sent.copy()
    parts = []
    have = np.flatnonzero(~sent)
    if len(have):
        matrix, key, b, a = _matrix(rows.take(pa.array(have)), length)
        low = rows.column("low").to_numpy()[have].astype(np.int64)
        later, order = _later(matrix, key, b, a, ord_[have], tie[have], pos[have])
        covered[have[later]] = True
        first = order[~later[order]]
        edge = np.flatnonzero(np.diff(key[first])) + 1
        count = np.diff(np.concatenate([[0], edge, [len(first)]]))
        several = first[np.repeat(count > 1, count)]
        several = several[_half_shared(matrix[several], key[several], low[several], core, length)] if len(several) else several
        if len(several):
            group = np.cumsum(np.concatenate([[0], np.diff(key[several]) != 0]))
            # within a group by place in the corpus, so that the first of a bucket is the first string
            several = several[np.lexsort((pos[have][several], tie[have][several], ord_[have][several], group))]
            bucket = refine(matrix[several], group, length)[:, : reach + 1]
            column = np.arange(reach + 1)[None, :]
            ok = (bucket >= 0) & (column >= reach - b[several][:, None]) & (column + length <= reach + a[several][:, None])
            r, c = np.nonzero(ok)
            by = np.lexsort((r, bucket[r, c]))
            again = np.zeros(len(by), bool)
            again[1:] = np.diff(bucket[r, c][by]) == 0
            r, c = r[by[again]], c[by[again]]
            by = np.lexsort((c, r))
            r, c = r[by], c[by]
            cut = np.flatnonzero((np.diff(r) != 0) | (np.diff(c) != 1)) + 1
            s, e = np.concatenate([[0], cut]).astype(int), np.concatenate([cut, [len(r)]]).astype(int) - 1
            if len(r):
                own = have[several[r[s]]]
                parts.append((ord_[own], tie[own], pos[own] - reach + c[s], pos[own] - reach + c[e] + length))
    rest = np.flatnonzero(covered & (before + after >= length))
    parts.append((ord_[rest], tie[rest], pos[rest] - before[rest], pos[rest] + after[rest]))
    ord_, tie, begin, end = (np.concatenate(x) for x in zip(*parts, strict=True))
    return _found(ord=ord_, tie=tie, begin=begin, end=end)


def _dealt_anew(rows, length: int, core: int):
    """Contexts of one core, too many to refine at once: those alike are covered; the others go on with both longer cores."""
    matrix, key, before, after = _matrix(rows, length)
    low = rows.column("low").to_numpy().astype(np.int64)
    ord_, tie, pos = (rows.column(c).to_numpy() for c in ("ord", "tie", "pos"))
    later = _later(matrix, key, before, after, ord_, tie, pos)[0]
    rest = np.flatnonzero(later & (before + after >= length))
    yield _found(ord=ord_[rest], tie=tie[rest], begin=pos[rest] - before[rest], end=pos[rest] + after[rest])
    half, reach = _half(length, core), length - GRAM
    longer = core + half
    for start, ok in ((low - half, before + low >= half), (low, after - low - core >= half)):
        some = np.flatnonzero(ok & ~later)
        if not len(some):
            continue
        at = start[some]
        string = matrix[some[:, None], reach + at[:, None] + np.arange(longer)[None, :]]
        fresh = (_digest(string) + at.astype(np.uint64) * _C[2] + np.uint64(longer)).view(np.int64)
        if longer < length:
            own = rows.take(pa.array(some))
            yield _found(**{c: own.column(c).combine_chunks() if isinstance(own, pa.Table) else own.column(c) for c in ("ord", "tie", "pos", "before", "after", "context")}, key=fresh, low=at.astype(np.int32))
            continue
        # the core is a whole string: of those alike here, only the first needs to be told others
        names = string.copy().view(f"V{length}").ravel()
        _, place = np.unique(names, return_inverse=True)
        by = np.lexsort((pos[some], tie[some], ord_[some], place))
        again = np.zeros(len(some), bool)
        again[by[1:]] = np.diff(place[by]) == 0
        gone, first = some[again], some[~again]
        yield _found(ord=ord_[gone], tie=tie[gone], begin=pos[gone] + start[gone], end=pos[gone] + start[gone] + length)
        yield _found(ord=ord_[first], tie=tie[first], pos=pos[first], key=fresh[~again], low=start[first].astype(np.int32), before=before[first].astype(np.int32), after=after[first].astype(np.int32), context=[x.tobytes() for x in string[~again]])


def _find_covered(length: int, core: int, most: int = CONTEXT_ROWS):
    """Rows sorted by key to what one round finds; about `most` contexts are held."""

    def chunks(rows):
        """Rows cut between keys, about `most` of them at a time."""
        key = rows.column("key").to_numpy()
        edge = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
        at = 0
        while at < len(edge) - 1:
            to = max(at + 1, int(np.searchsorted(edge, edge[at] + most, "right")) - 1)
            yield rows.slice(edge[at], edge[to] - edge[at])
            at = to

    def run(batches):
        held: list[pa.RecordBatch] = []
        size, hot = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < most:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            key = rows.column("key").to_numpy()
            if hot is not None:
                of_hot = int(np.searchsorted(key, hot, "right"))
                if of_hot:
                    yield from _dealt_anew(rows.slice(0, of_hot), length, core)
                    rows, key = rows.slice(of_hot), key[of_hot:]
                    if not len(key):
                        held, size = [], 0
                        continue
                hot = None
            last = int(np.searchsorted(key, key[-1]))
            for part in chunks(rows.slice(0, last)) if last else ():
                yield _covered_in(part, length, core)
            rows = rows.slice(last)
            if rows.num_rows >= most:  # all of one key
                hot = key[-1]
                yield from _dealt_anew(rows, length, core)
                rows = rows.slice(0, 0)
            held, size = rows.to_batches(), rows.num_rows
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        if hot is not None:
            of_hot = int(np.searchsorted(rows.column("key").to_numpy(), hot, "right"))
            if of_hot:
                yield from _dealt_anew(rows.slice(0, of_hot), length, core)
            rows = rows.slice(of_hot)
        for part in chunks(rows) if rows.num_rows else ():
            yield _covered_in(part, length, core)

    return run


def _find_whole(length: int):
    """Rows sorted by key, string and place, each a whole string: all but the first of each string are covered. One row is held."""

    def run(batches):
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            string = batch.column("context").to_pylist()
            again = np.array([x == y for x, y in zip(string, [before, *string[:-1]], strict=True)])
            before = string[-1]
            begin = batch.column("pos").to_numpy() + batch.column("low").to_numpy()
            yield _found(ord=batch.column("ord").to_numpy()[again], tie=batch.column("tie").to_numpy()[again], begin=begin[again], end=begin[again] + length)

    return run


def _ordered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """docs with ord and tie, by which documents follow each other; whether ids repeat."""
    own = docs.withColumn("ord", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)))
    repeated = own.groupBy("ord").count().where("count > 1").limit(1).count()
    return own.withColumn("tie", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) if repeated else F.lit(0).cast("long")), bool(repeated)


def _met(docs: DataFrame, small: DataFrame, how: str) -> DataFrame:
    """By document. small is read from files, so Spark knows its size and broadcasts it within the session's bound."""
    return docs.join(small, ["ord", "tie"], how)


def repeated_spans(docs: DataFrame, repeated: bool, length: int = LENGTH, most: int = CONTEXT_ROWS) -> DataFrame:
    """ord, tie, begins, ends for documents that have any: bytes covered by strings of `length` bytes that start earlier too. docs: text, ord, tie."""
    own = small_batches(docs).select("ord", "tie", F.col("text").cast("string").alias("text"))
    if repeated:  # rows alike are one document
        own = own.dropDuplicates(["ord", "tie"])
    found = own.mapInArrow(_find_anchors(length), "key long, kind int, ord long, tie long, pos long")
    again = found.repartition("key").sortWithinPartitions("key").mapInArrow(_repeated, "ord long, tie long, pos long")
    places = kept(again.groupBy("ord", "tie").agg(F.collect_list(F.col("pos")).alias("positions")), "suffix-anchors")
    contexts = _met(own, places, "inner").mapInArrow(_find_contexts(length), _CONTEXT_SQL).withColumn("low", F.lit(0))
    spans, core = None, GRAM
    while contexts is not None:
        if core < length:
            met = contexts.repartition("key").sortWithinPartitions("key").mapInArrow(_find_covered(length, core, most), _FOUND_SQL)
        else:
            met = contexts.repartition("key").sortWithinPartitions("key", "context", "ord", "tie", "pos").mapInArrow(_find_whole(length), _FOUND_SQL)
        met = kept(met, "suffix-met")
        covered = met.where("begin is not null").select("ord", "tie", "begin", "end")
        spans = covered if spans is None else spans.unionByName(covered)
        again = met.where("key is not null").drop("begin", "end")
        contexts = again.select("key", "ord", "tie", "pos", "before", "after", "context", "low") if again.limit(1).count() else None
        core += _half(length, core)
    return kept(spans.groupBy("ord", "tie").agg(F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends")), "suffix-spans")


def cut_spans(raw: bytes, begins, ends) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of raw, and the maximal removed runs."""
    if not begins:
        return raw, []
    step = np.zeros(len(raw) + 1, np.int32)
    np.add.at(step, np.array(begins, np.int64), 1)
    np.add.at(step, np.array(ends, np.int64), -1)
    gone = np.cumsum(step[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def remove_repeats(docs: DataFrame, length: int = LENGTH, most: int = CONTEXT_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept (bytes) for every row of docs.

    A byte goes if a string of `length` bytes covers it that starts earlier as well: in a document of smaller doc_id, or
    earlier in the same one. Strings lie within one document and are judged on the input. Null texts are empty. Documents
    without id come last; those that share an id follow each other by a hash of their texts; rows alike in id and text
    are one document. Texts shorter than length stay whole. Extra columns play no part. No rows give no rows. `most` is
    how many contexts of one core are refined in one task; more are dealt out anew, with the same result.
    """
    own, repeated = _ordered(docs.select("doc_id", "text"))
    met = _met(own, repeated_spans(own, repeated, length, most), "left")
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", span), ("kept", pa.binary())])

    def run(batches):
        for batch in batches:
            items = texts(batch.column("text"))
            cut = [cut_spans(raw, b, e) for raw, b, e in zip(items, batch.column("begins").to_pylist(), batch.column("ends").to_pylist(), strict=True)]
            yield record_batch(
                schema, doc_id=batch.column("doc_id"), n_bytes=[len(x) for x in items], n_removed=[len(x) - len(k) for x, (k, _) in zip(items, cut, strict=True)], n_spans=[len(s) for _, s in cut],
                kept_sha256=[hashlib.sha256(k).hexdigest() for k, _ in cut], spans=[[{"begin": b, "end": e} for b, e in s] for _, s in cut], kept=[k for k, _ in cut],
            )

    met = met.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "begins", "ends")
    return met.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<begin:long,end:long>>, kept binary")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows and columns of docs, texts less what remove_repeats takes from them (n_chars, where there is one, follows).

    Characters of which a part is removed go as a whole.
    """
    others = [c for c in docs.columns if c != "text"]
    own, repeated = _ordered(docs.select(F.struct(*others).alias("_row"), "doc_id", F.col("text").cast("string").alias("text")))
    met = _met(own, repeated_spans(own, repeated, length), "left")

    @F.arrow_udf("string")
    def cut(text: pa.Array, begins: pa.Array, ends: pa.Array) -> pa.Array:
        return pa.array([cut_spans(raw, b, e)[0].decode("utf-8", "ignore") if b else None for raw, b, e in zip(texts(text), begins.to_pylist(), ends.to_pylist(), strict=True)], pa.string())

    # a text crosses the network once; only those that change go to Python
    met = met.withColumn("_cut", cut(F.when(F.col("begins").isNotNull(), F.col("text")), "begins", "ends"))
    columns = []
    for f in docs.schema.fields:
        if f.name == "text":
            columns.append(F.coalesce("_cut", "text").cast(f.dataType).alias("text"))
        elif f.name == "n_chars":
            columns.append(F.when(F.col("_cut").isNotNull(), F.char_length("_cut").cast(f.dataType)).otherwise(F.col("_row").getField("n_chars")).alias("n_chars"))
        else:
            columns.append(F.col("_row").getField(f.name).alias(f.name))
    return met.select(*columns)
