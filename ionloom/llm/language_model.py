"""LM scoring: a log-bilinear neural model with normalised token log-probabilities, next to a smoothed unigram base.

The model predicts a token's symbol from the two before it. Frequent words are symbols of their own, as many as the square
root of the training tokens; the others share symbols by their last two letters, the most frequent endings of the corpus.
The model is trained by noise-contrastive estimation on every token of every training text, in the tasks that read them,
by the same rule for inputs of all sizes: each pass starts from the average of what the tasks of the pass before have learnt. Within a shared symbol a word has its add-one
share; one place there is for words never seen. So the probabilities of a token add up to one.

What follows each of the known words is counted as well, over all training texts; followers seen once are left to the
model. The counts of a word's followers are joined with the model's probability, which weighs as many tokens as the word
has different followers (Witten and Bell), and as those left out, so the sum stays one. This table grows with the
corpus; it is joined, never collected: hashes of pairs and what belongs to them go to buckets as packed numbers. A bitmap of fixed size tells most tokens that their pair isn't in it.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ionloom.llm.bilinear import BATCH, LogBilinear, Trainer, run_starts
from ionloom.llm.hashing import hashed_words, mixed, word_hashes
from ionloom.llm.shared import crc_mod, flat, kept, record_batch, small_batches, swept, text_slices

FOLDS, HELD_OUT = 7, 2
#: Words of their own: the square root of the training tokens, within these bounds. Endings that others share.
FEWEST_OWN, MOST_OWN, ENDINGS = 64, 32_768, 63
#: Words whose counts a Python worker looks up in memory; the counts of all others are joined.
KNOWN_WORDS = 400_000
#: Pairs of words whose counts a Python worker looks up in memory; the counts of all others are joined.
KNOWN_PAIRS = 1_000_000
#: Training tokens for each bucket in which pairs of words are counted and looked up, and for each in which texts add up what was found.
PAIR_TOKENS, TEXT_TOKENS = 1 << 18, 1 << 22
#: Tokens whose pairs a task sends to the buckets at once.
SENT_TOKENS = 1 << 19
#: How often a pair must come for its count to be used; bits of the map of such pairs.
LEAST_PAIR, MAP_BITS = 2, 1 << 27
#: Distinct words that a worker counts before it sends them on.
COUNTED_WORDS = 200_000
#: Words whose symbols a worker remembers, and bytes of text that it scores at a time.
MEMO_WORDS, SCORED_BYTES = 100_000, 1 << 20
#: Passes of training; each takes every token of all training texts once.
PASSES = 2
#: Models of tasks that one task adds up, in so many parts.
FAN_IN, PARTS = 64, 16
_END_HASH, _ODD = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


class Symbols(dict):
    """word: symbol. Words of their own come first, then the end, then endings and what has none of them."""

    def __init__(self, own: list[bytes], endings: list[bytes]):
        super().__init__({w: k for k, w in enumerate(own)})
        self.own, self.end = dict(self), len(own)
        self.endings = {e: self.end + 1 + k for k, e in enumerate(endings)}
        self.size = self.end + 2 + len(endings)

    def by_ending(self, word: bytes) -> int:
        return self.endings.get(word[-2:], self.size - 1)

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_WORDS + self.end:
            self.clear()
            self.update(self.own)
        found = self[word] = self.by_ending(word)
        return found

    def by_code(self) -> np.ndarray:
        """What Texts.codes() leads to."""
        out = np.full((1 << 16) + 256, self.size - 1, np.int32)
        for e, symbol in self.endings.items():
            out[e[-2] << 8 | e[-1] if len(e) > 1 else 1 << 16 | e[-1]] = symbol
        return out


class Texts:
    """Tokens of texts without a Python step for each: their hashes, an end after each text, and where texts begin."""

    def __init__(self, items: list[bytes]):
        self.bytes, edges = flat([x.lower() for x in items])
        hashes, self.begin, self.end, first = hashed_words(self.bytes, edges)
        self.size = np.diff(first) + 1
        self.starts = np.cumsum(self.size) - self.size
        self.is_word = np.ones(int(self.size.sum()), bool)
        self.is_word[self.starts + self.size - 1] = False
        self.hash = np.full(len(self.is_word), _END_HASH, np.uint64)
        self.hash[self.is_word] = hashes

    def codes(self) -> np.ndarray:
        """Numbers for the last two bytes of words."""
        last = self.bytes[self.end - 1].astype(np.int32)
        return np.where(self.end - self.begin > 1, self.bytes[self.end - 2].astype(np.int32) << 8 | last, 1 << 16 | last)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """For each token a 64-bit key of it and the word before it, and the hash of that word; before a text there is an end."""
        before = np.roll(self.hash, 1)
        before[self.starts] = _END_HASH
        return mixed(before * _ODD + self.hash).view(np.int64), before


class Places:
    """Where hashes stand in an array of different ones."""

    def __init__(self, hashes: np.ndarray):
        self.place = np.argsort(hashes).astype(np.int32)
        self.hashes = hashes[self.place]

    def of(self, asked: np.ndarray) -> np.ndarray:
        """The place of each; -1 for others. In their order the memory is read in its own."""
        out = np.full(len(asked), -1, np.int32)
        if len(self.hashes):
            order = np.argsort(asked)
            near = np.searchsorted(self.hashes, asked[order]).clip(max=len(self.hashes) - 1)
            found = self.hashes[near] == asked[order]
            out[order[found]] = self.place[near[found]]
        return out


def tokens(raw: bytes) -> list[bytes]:
    """Words; letters A to Z in lower case. The end that follows them isn't among them."""
    return raw.lower().split()


def training(docs: DataFrame) -> DataFrame:
    return docs.where(~is_held_out(F.col("doc_id")))


def is_held_out(column):
    return F.coalesce(crc_mod(column, FOLDS) == HELD_OUT, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """word (bytes; the end is empty), c: how often it comes in docs."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def run(batches):
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for _, _, items in text_slices(batch.column("text"), SCORED_BYTES):
                for raw in items:
                    counts.update(tokens(raw))
                counts[b""] += len(items)
                if len(counts) > COUNTED_WORDS:
                    yield record_batch(schema, word=list(counts), c=list(counts.values()))
                    counts.clear()
        if counts:
            yield record_batch(schema, word=list(counts), c=list(counts.values()))

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def commonest(counted: DataFrame, most: int) -> DataFrame | None:
    """Rows of the largest c, at most so many; None if there are none. Their bound is found from a histogram of logarithms."""
    size = F.floor(F.log2("c") * 8).cast("int")
    bins = sorted(((r["b"], r["n"]) for r in counted.groupBy(size.alias("b")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, total = None, 0
    for b, n in bins:
        if total + n > most:
            break
        total, least = total + n, b
    return None if least is None else counted.where(size >= least)


def frequent(vocabulary: DataFrame, most: int) -> tuple[list[bytes], np.ndarray]:
    """Words and counts of the most frequent words, at most so many, by descending count."""
    found = commonest(vocabulary, most)
    if found is None:
        return [], np.zeros(0, np.int64)
    table = found.toArrow()
    words, counts = table.column("word").to_pylist(), table.column("c").to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    return [words[i] for i in order], counts[order]


def common_endings(vocabulary: DataFrame, most: int = ENDINGS) -> list[bytes]:
    """The last two bytes of words that most tokens have."""
    ending = F.substring("word", -2, 2)
    found = vocabulary.where(F.length("word") > 0).groupBy(ending.alias("e")).agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "e").limit(most)
    return [bytes(r["e"]) for r in found.collect()]


def symbol_totals(vocabulary: DataFrame, own: list[bytes], endings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of each symbol."""
    schema = pa.schema([("symbol", pa.int32()), ("n", pa.int64()), ("v", pa.int64())])
    size = Symbols(own, endings).size

    def run(batches):
        symbols = Symbols(own, endings)
        n, v = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            at = np.array([symbols[w] if w else symbols.end for w in batch.column("word").to_pylist()], np.int64)
            n += np.bincount(at, batch.column("c").to_numpy(), size).astype(np.int64)
            v += np.bincount(at, minlength=size)
        some = np.flatnonzero(v)
        yield record_batch(schema, symbol=some.astype(np.int32), n=n[some], v=v[some])

    n, v = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for r in vocabulary.mapInArrow(run, "symbol int, n long, v long").groupBy("symbol").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        n[r["symbol"]], v[r["symbol"]] = r["n"], r["v"]
    return n, v


def contexts_of(symbol: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """For each token the symbol two before it and the one before it; before a text there are ends."""
    one, two = np.roll(symbol, 1), np.roll(symbol, 2)
    one[starts] = end
    two[starts] = end
    after = starts + 1
    after = after[after < len(symbol)]
    two[after] = end
    return two, one


def trained(docs: DataFrame, own: list[bytes], endings: list[bytes], counts: np.ndarray, passes: int = PASSES) -> LogBilinear:
    """The model after so many passes over docs; it is the unigram one where there is nothing to learn from."""
    schema = pa.schema([("part", pa.int32()), ("node", pa.int64()), ("weight", pa.float64()), ("sum", pa.binary())])
    model = LogBilinear(counts)
    if not counts.sum():
        return model
    text = docs.select(F.col("text").cast("string"))
    n_tasks = docs.rdd.getNumPartitions()
    symbols, places = Symbols(own, endings), Places(hashes_of(own))

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in table.column("sum"))
        first = table.slice(0, 1)
        return pa.table({"part": first.column("part"), "node": first.column("node"), "weight": pa.array([sum(table.column("weight").to_pylist())]), "sum": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    for turn in range(passes):
        sent = docs.sparkSession.sparkContext.broadcast((places, symbols.by_code(), symbols.end, counts, model.vector))

        def run(batches, sent=sent, turn=turn):
            from pyspark import TaskContext

            known, by_code, end, times, vector = sent.value
            node = TaskContext.get().partitionId()
            local = LogBilinear(times).load(vector)
            trainer = Trainer(local, seed=turn * 1_000_003 + node)
            held: list[tuple] = []
            size = 0
            for batch in batches:
                for _, _, items in text_slices(batch.column("text"), SCORED_BYTES):
                    parts = Texts(items)
                    s = known.of(parts.hash)
                    s[parts.is_word] = np.where(s[parts.is_word] < 0, by_code[parts.codes()], s[parts.is_word])
                    s[~parts.is_word] = end
                    two, one = contexts_of(s, parts.starts, end)
                    held.append((two, one, s))
                    size += len(s)
                    if size >= 16 * BATCH:
                        _steps(trainer, held)
                        held, size = [], 0
            if size:
                _steps(trainer, held)
            if trainer.seen:
                parts = np.array_split(local.vector * np.float32(trainer.seen), PARTS)
                yield record_batch(schema, part=np.arange(PARTS, dtype=np.int32), node=np.full(PARTS, node), weight=np.full(PARTS, float(trainer.seen)), sum=[p.astype(np.float32).tobytes() for p in parts])

        with swept(docs.sparkSession):
            found, n = text.mapInArrow(run, "part int, node long, weight double, sum binary"), n_tasks
            while True:
                found = found.withColumn("node", F.floor(F.col("node") / FAN_IN)).groupBy("part", "node").applyInArrow(added, "part int, node long, weight double, sum binary")
                n = -(-n // FAN_IN)
                if n <= 1:
                    break
            rows = sorted(found.collect(), key=lambda r: r["part"])
        if len(rows) < PARTS:
            break
        model.load(np.concatenate([np.frombuffer(bytes(r["sum"]), np.float32) / np.float32(r["weight"]) for r in rows]))
    return model


def _steps(trainer: Trainer, held: list[tuple]) -> None:
    """Steps over what is held, in an order that mixes its texts."""
    two, one, symbol = (np.concatenate(x) for x in zip(*held, strict=True))
    order = trainer.rng.permutation(len(symbol))
    for at in range(0, len(order), BATCH):
        own = order[at : at + BATCH]
        trainer.step(two[own], one[own], symbol[own])


def words_at(parts: Texts, tokens: np.ndarray) -> pa.Array:
    """The words of tokens; the end is empty."""
    raw, word = parts.bytes.tobytes(), (np.cumsum(parts.is_word) - 1)[tokens]
    some = parts.is_word[tokens]
    edges = zip(parts.begin[word[some]].tolist(), parts.end[word[some]].tolist(), strict=True)
    out = [b""] * len(tokens)
    for k, (lo, hi) in zip(np.flatnonzero(some).tolist(), edges, strict=True):
        out[k] = raw[lo:hi]
    return pa.array(out, pa.binary())


def hashes_of(words: list[bytes]) -> np.ndarray:
    """Hashes of single words, as Texts has them."""
    out = np.full(len(words), _END_HASH, np.uint64)
    some = np.array([bool(w) for w in words], bool)
    if some.any():
        out[some] = word_hashes([w for w in words if w])[0]
    return out


def parcels(schema: pa.Schema, buckets: int, by: np.ndarray, **values: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket that the hashes `by` have, with the bytes of its values: rows of Spark cost more than numbers."""
    bucket = ((by.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    first = run_starts(bucket[order])
    edges = np.append(first, len(by))

    def cut(x: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((edges * x.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x[order]))])

    full = {"bucket": pa.array(bucket[order[first]], pa.int32())} | {k: cut(x) for k, x in values.items()}
    return pa.RecordBatch.from_arrays([full[f.name] if f.name in full else pa.nulls(len(first), f.type) for f in schema], schema=schema)


def unpacked(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def pair_counts(docs: DataFrame, words: list[bytes], buckets: int, least: int = LEAST_PAIR) -> DataFrame:
    """key, before, c: how often each pair of neighbouring words comes in docs, `least` times or more, after one of words (at place `before`)."""
    schema = pa.schema([("bucket", pa.int32()), ("key", pa.binary()), ("before", pa.binary()), ("c", pa.binary())])
    sent = docs.sparkSession.sparkContext.broadcast(Places(hashes_of(words)))

    def counted(held: list[tuple]) -> pa.RecordBatch:
        key, before = (np.concatenate(x) for x in zip(*held, strict=True))
        key, first, c = np.unique(key, return_index=True, return_counts=True)
        at = sent.value.of(before[first])
        found = at >= 0
        return parcels(schema, buckets, key[found], key=key[found], before=at[found], c=c[found].astype(np.int32))

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for _, _, items in text_slices(batch.column("text"), SCORED_BYTES):
                held.append(Texts(items).pairs())
                size += len(held[-1][0])
                if size >= SENT_TOKENS:
                    yield counted(held)
                    held, size = [], 0
        if size:
            yield counted(held)

    def added(table: pa.Table) -> pa.Table:
        key, before, c = unpacked(table["key"], np.int64), unpacked(table["before"], np.int32), unpacked(table["c"], np.int32)
        order = np.argsort(key)
        first = run_starts(key[order])
        total = np.add.reduceat(c[order].astype(np.int64), first)
        some = order[first[total >= least]]
        return pa.table({"key": key[some], "before": before[some], "c": total[total >= least]})

    found = docs.select(F.col("text").cast("string")).mapInArrow(run, "bucket int, key binary, before binary, c binary")
    return found.groupBy("bucket").applyInArrow(added, "key long, before int, c long")


def found_in(pairs: DataFrame, lookups: DataFrame, buckets: int, text_buckets: int) -> DataFrame:
    """row, more: what the counts of pairs add to the logarithms of rows. lookups has bucket, key, x, row: hashes of pairs, the model's logarithm with its weight, rows."""
    schema = pa.schema([("bucket", pa.int32()), ("key", pa.binary()), ("c", pa.binary())])
    summed = pa.schema([("bucket", pa.int32()), ("row", pa.binary()), ("more", pa.binary())])

    def dealt(batches):
        for batch in batches:
            key = batch.column("key").to_numpy()
            yield parcels(schema, buckets, key, key=key, c=batch.column("c").to_numpy())

    def looked_up(held: pa.Table, asked: pa.Table) -> pa.Table:
        key, x, row = unpacked(asked["key"], np.int64), unpacked(asked["x"], np.float32), unpacked(asked["row"], np.int64)
        keys, c = unpacked(held["key"], np.int64), unpacked(held["c"], np.int64)
        order = np.argsort(keys)
        near = order[np.searchsorted(keys, key, sorter=order).clip(max=max(0, len(keys) - 1))] if len(keys) else np.zeros(len(key), np.int64)
        some = np.flatnonzero(keys[near] == key) if len(keys) else near[:0]
        more, row = np.log10(1 + c[near[some]] * 10.0 ** -x[some].astype(np.float64)), row[some]
        order = np.argsort(row, kind="stable")
        first = run_starts(row[order])
        row, more = row[order[first]], np.add.reduceat(more[order], first) if len(first) else more
        return pa.Table.from_batches([parcels(summed, text_buckets, mixed(row.view(np.uint64)), row=row, more=more)])

    def added(table: pa.Table) -> pa.Table:
        row, more = unpacked(table["row"], np.int64), unpacked(table["more"], np.float64)
        order = np.argsort(row, kind="stable")
        first = run_starts(row[order])
        return pa.table({"row": row[order[first]], "more": np.add.reduceat(more[order], first)})

    held = pairs.select("key", "c").mapInArrow(dealt, "bucket int, key binary, c binary")
    found = held.groupBy("bucket").cogroup(lookups.groupBy("bucket")).applyInArrow(looked_up, "bucket int, row binary, more binary")
    return found.groupBy("bucket").applyInArrow(added, "row long, more double")


def map_of(pairs: DataFrame, bits: int = MAP_BITS) -> np.ndarray:
    """One bit for each key that may be in pairs. Tasks send the bytes that they set, at most all of the map."""
    schema = pa.schema([("at", pa.int32()), ("byte", pa.int16())])

    def run(batches):
        own = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            place = batch.column("key").to_numpy().view(np.uint64) % np.uint64(bits)
            np.bitwise_or.at(own, (place >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (place & np.uint64(7)).astype(np.uint8)))
        some = np.flatnonzero(own)
        yield record_batch(schema, at=some.astype(np.int32), byte=own[some].astype(np.int16))

    out = np.zeros(bits // 8, np.uint8)
    with swept(pairs.sparkSession):
        found = pairs.select("key").mapInArrow(run, "at int, byte short").groupBy("at").agg(F.bit_or("byte").alias("byte")).toArrow()
    out[found.column("at").to_numpy()] = found.column("byte").to_numpy().astype(np.uint8)
    return out


def may_hold(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    place = key.view(np.uint64) % np.uint64(8 * len(bitmap))
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs.

    Null and empty texts are an end alone. A null doc_id is not held out. Repeated rows count, and are scored, as often as
    they come. Extra columns play no part. Counts of words and of pairs of words cover all training texts; without any,
    every word is unseen. The most frequent words, and words in pairs, are told apart by 64-bit hashes.
    """
    own = small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    vocabulary = kept(word_counts(training(own)), "lm-words")
    totals = vocabulary.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = int(totals["n"] or 0), int(totals["v"])
    words, counts = frequent(vocabulary, KNOWN_WORDS)
    single = [w for w in words if w][: min(MOST_OWN, max(FEWEST_OWN, int(n**0.5)))]
    endings = common_endings(vocabulary)
    in_symbol, kinds = symbol_totals(vocabulary, single, endings)
    model = trained(training(own), single, endings, in_symbol)
    end = len(single)
    base_whole = np.log10(n + v + 1)
    shared_whole = np.log10(np.maximum(1, in_symbol + kinds + 1))
    buckets, text_buckets = 1 + n // PAIR_TOKENS, 1 + n // TEXT_TOKENS
    pairs = kept(pair_counts(training(own), words, buckets), "lm-pairs")
    # the model's probability stands for as many tokens as the word before has different followers, besides those counted
    weight, total = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    with swept(own.sparkSession):
        followers = pairs.groupBy("before").agg(F.count("*").alias("n"), F.sum("c").alias("c")).toArrow()
    some = followers.column("before").to_numpy()
    total[some] = followers.column("c").to_numpy()
    # a word is followed as often as it comes; those that follow it once count as different followers, and what they counted for goes to the model
    weight[some] = followers.column("n").to_numpy() + 2 * (counts[some] - total[some])
    bitmap = map_of(pairs)
    often = commonest(pairs.select("key", "c"), KNOWN_PAIRS)
    often = often.toArrow() if often is not None else pa.table({"key": pa.array([], pa.int64()), "c": pa.array([], pa.int64())})
    symbols = Symbols(single, endings)
    of_word = np.array([symbols.own[w] if w in symbols.own else end if not w else symbols.by_ending(w) for w in words] + [0], np.int32)
    sent = own.sparkSession.sparkContext.broadcast((Places(hashes_of(words)), counts, symbols.by_code(), of_word, in_symbol, model.vector, weight, total, bitmap, Places(often.column("key").to_numpy()), np.append(often.column("c").to_numpy(), 0)))
    rare_type = pa.struct([("word", pa.binary()), ("symbol", pa.int32()), ("key", pa.int64()), ("x", pa.float32())])  # key: null where none can be found
    asked = pa.schema([("bucket", pa.int32()), ("key", pa.binary()), ("x", pa.binary()), ("asking", pa.binary())])
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("model", pa.float64()), ("rare", pa.list_(rare_type)), *asked])
    columns = "row long, doc_id long, n_tokens long, n_known long, base double, model double, rare array<struct<word:binary,symbol:int,key:long,x:float>>, bucket int, key binary, x binary, asking binary"

    def run(batches):
        from pyspark import TaskContext

        known_words, known_counts, by_code, of_word, times, vector, weights, followed, held, known_pairs, pair_times = sent.value
        neural = LogBilinear(times).load(vector)
        neural.ready()
        # of what follows a word, counted tokens and the model's share in the place of weight tokens
        counted = weights > 0
        log_weight, whole = np.log10(np.where(counted, weights, 1.0)), np.log10(np.where(counted, followed + weights, 1.0))
        before_all = known_words.of(np.array([_END_HASH]))[0]
        base = np.append(np.log10(known_counts + 1.0) - base_whole, 0.0)
        within = np.append(np.where(of_word[:-1] <= end, 0.0, np.log10(known_counts + 1.0) - shared_whole[of_word[:-1]]), 0.0)
        row = TaskContext.get().partitionId() << 33
        waiting: list[tuple] = []
        for batch in batches:
            keys = batch.column("doc_id")
            for lo, hi, items in text_slices(batch.column("text"), SCORED_BYTES):
                parts = Texts(items)
                size, starts = parts.size, parts.starts
                at = known_words.of(parts.hash)
                symbol = of_word[at]
                symbol[parts.is_word] = np.where(at[parts.is_word] < 0, by_code[parts.codes()], symbol[parts.is_word])
                symbol[~parts.is_word] = end
                unknown = np.flatnonzero(at < 0)
                out = neural.log_probabilities(*contexts_of(symbol, starts, end), symbol) / np.log(10) + within[at]
                before = np.roll(at, 1)
                before[starts] = before_all
                # probability by the model as so many tokens, to which those counted after the word before are added
                out += log_weight[before]
                key, _ = parts.pairs()
                times = np.where(counted[before], pair_times[known_pairs.of(key)], 0)
                look = (times == 0) & counted[before] & may_hold(held, key)
                joined = np.flatnonzero(look & (at >= 0))
                total = out - whole[before]
                some = np.flatnonzero(times)
                total[some] += np.log10(1 + times[some] * 10.0 ** -out[some])
                edges, rows = np.append(starts, len(key)), row + np.arange(len(items))
                row += len(items)
                rare = pa.StructArray.from_arrays([words_at(parts, unknown), pa.array(symbol[unknown].astype(np.int32)), pa.array(key[unknown], mask=~look[unknown]), pa.array(out[unknown].astype(np.float32))], fields=list(rare_type))
                rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(unknown, edges).astype(np.int32)), rare)
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows), keys.slice(lo, hi - lo), pa.array(size), pa.array(np.add.reduceat((at >= 0).astype(np.int64), starts)), pa.array(np.add.reduceat(base[at], starts)),
                    pa.array(np.add.reduceat(total, starts)), rare, *(pa.nulls(len(items), f.type) for f in asked),
                ], schema=schema)
                waiting.append((key[joined], out[joined].astype(np.float32), np.repeat(rows, size)[joined]))
                if sum(len(x) for x, _, _ in waiting) >= SENT_TOKENS:
                    yield sent_on(waiting)
                    waiting = []
        if waiting:
            yield sent_on(waiting)

    def sent_on(waiting, into=schema):
        key, x, row = (np.concatenate(y) for y in zip(*waiting, strict=True))
        return parcels(into, buckets, key, key=key, x=x, asking=row)

    def ask(batches):
        for batch in batches:
            yield sent_on([tuple(batch.column(c).to_numpy() for c in ("key", "x", "row"))], asked)

    partial = kept(own.mapInArrow(run, columns), "lm-partial")
    by_text = partial.where("bucket is null").drop("bucket", "key", "x", "asking")
    # words that no worker keeps in memory get their counts by a join; unseen ones have none
    shared = F.element_at(F.array(*[F.lit(float(x)) for x in shared_whole[end + 1 :]]), F.greatest(F.lit(1), F.col("symbol") - end))
    c = F.coalesce(F.col("c"), F.lit(0))
    within_rare = F.when(F.col("symbol") <= end, F.lit(0.0)).otherwise(F.log10(c + 1.0) - shared)
    rare = by_text.select("row", F.explode("rare").alias("r")).select("row", "r.*").join(vocabulary.hint("merge"), "word", "left").select(
        "row", "key", (F.col("x") + within_rare).alias("x"), (c > 0).cast("int").alias("known"), (F.log10(c + 1.0) - F.lit(float(base_whole))).alias("base"),
        within_rare.alias("model"),
    )
    rare = kept(rare, "lm-rare")
    # so do pairs of words, where the map doesn't rule them out
    asking = partial.where("bucket is not null").select("bucket", "key", "x", "asking").unionAll(
        rare.where("key is not null").select("key", F.col("x").cast("float"), "row").mapInArrow(ask, "bucket int, key binary, x binary, asking binary")
    )
    more = found_in(pairs, asking.withColumnRenamed("asking", "row"), buckets, text_buckets)
    joined = rare.select("row", "known", "base", "model").unionAll(more.select("row", F.lit(0).alias("known"), F.lit(0.0).alias("base"), F.col("more").alias("model")))
    joined = joined.groupBy("row").agg(F.sum("known").alias("more_known"), F.sum("base").alias("more_base"), F.sum("model").alias("more_model"))
    out = by_text.drop("rare").join(joined, "row", "left")
    zero = lambda name, x: F.coalesce(F.col(name), F.lit(x))
    return out.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("n_known") + zero("more_known", 0)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + zero("more_base", 0.0)).alias("base_score"), (F.col("model") + zero("more_model", 0.0)).alias("score"),
    )
