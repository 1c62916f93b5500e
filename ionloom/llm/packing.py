"""Best-fit packing: documents cut into pieces of tokens, pieces put into sequences.

Bounded-space online best-fit: a fixed number of bins is open at a time, held in a bitset keyed by free space. A piece
goes to the open bin with the least room that holds it; when one bin too many is open, the fullest closes. Pieces stream
past: a packer sees some hundred of them ahead, and of these takes the longest first. It holds nothing but those and the
open bins, whatever the number and length of the documents.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ionloom.llm.shared import flat, record_batch, small_batches, text_slices

CAPACITY = 2048
END_ID = 0
#: Bins that a packer holds open, and pieces that it sees ahead.
OPEN_BINS, AHEAD = 256, 1024
#: Bytes of text whose pieces one packer takes; the number of packers follows from the bytes of all texts.
PACKER_BYTES = 64 << 20
#: A text with a longer run of one kind of byte (white space or not) is encoded by the slower, never quadratic encoder.
LONG_RUN = 2048

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("turn", pa.int64())])
_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Token ids of the vocabulary in `path`.json by tokenizers; short-worded texts by the same ranks in `path`.tiktoken, with equal ids."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(f"{path}.tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.path = path

    @cached_property
    def exact(self):
        """Only loaded where a text needs it."""
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(f"{self.path}.json")
        found.encode_special_tokens = True
        return found

    def __call__(self, items: list[bytes]) -> Iterator[np.ndarray]:
        buffer, starts = flat(items)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(buffer <= 32)) + 1, [len(buffer)]])
        runs = np.flatnonzero(np.diff(edges) > LONG_RUN)
        first, last = np.searchsorted(starts, edges[runs], "right") - 1, np.searchsorted(starts, edges[runs + 1], "left") - 1
        slow = {i for a, b in zip(first.tolist(), last.tolist(), strict=True) for i in range(a, b + 1)}
        for i, raw in enumerate(items):
            text = raw.decode("utf-8", "replace")
            if i in slow:
                yield np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
            else:
                yield self.fast.encode_to_numpy(text, disallowed_special=())


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary() -> str:
    """Where the public byte-level vocabulary lies, without its ending."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json")).removesuffix(".json")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all full but the first, which may be shorter."""
    head = n % capacity or min(n, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit), turn (the place among its task's pieces). A null text is empty and holds the end id alone."""
    path = path or vocabulary()

    def run(batches):
        encode, turn = encoder(path), 0
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for lo, hi, items in text_slices(batch.column("text"), 4 << 20):
                out: dict[str, list] = {f.name: [] for f in _PIECES if f.name != "turn"}
                for key, ids in zip(keys[lo:hi], encode(items), strict=True):
                    raw = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
                    for k, (start, length) in enumerate(cut(len(ids) + 1, capacity)):
                        for name, value in zip(out, (key, k, start, length, raw[4 * start : 4 * (start + length)]), strict=True):
                            out[name].append(value)
                yield record_batch(_PIECES, **out, turn=np.arange(turn, turn + len(out["ids"])))
                turn += len(out["ids"])

    return small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary, turn long")


class Packer:
    """Open bins by free space, in lists under a bitset of the spaces that have any."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.free, self.n_open, self.n_bins = 0, 0, 0

    def _pop(self, space: int) -> int:
        b = self.bins[space].pop()
        if not self.bins[space]:
            self.free ^= 1 << space
        self.n_open -= 1
        return b

    def put(self, need: int) -> tuple[int, int]:
        """The bin that takes so many tokens, and their offset there."""
        room = self.free >> need
        if room:
            space = need + (room & -room).bit_length() - 1
            b = self._pop(space)
        else:
            space, b = self.capacity, self.n_bins
            self.n_bins += 1
        left = space - need
        if left:
            self.bins[left].append(b)
            self.free |= 1 << left
            self.n_open += 1
            if self.n_open > self.open_bins:
                self._pop((self.free & -self.free).bit_length() - 1)  # the fullest closes
        return b, self.capacity - space


def best_fit(lengths, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> tuple[list[int], list[int]]:
    """For each length in turn: the number of its bin, and its offset there."""
    packer = Packer(capacity, open_bins)
    placed = [packer.put(n) for n in lengths]
    return [b for b, _ in placed], [o for _, o in placed]


def pack_pieces(pieces: DataFrame, n_packers: int, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, ahead: int = AHEAD) -> DataFrame:
    """pieces, less turn, with sequence_id and offset. Pieces are dealt to packers by hash, rows alike too, as their turns differ."""
    plain = [c for c in pieces.columns if c != "ids"]
    keyed = pieces.withColumn("_order", F.xxhash64(*plain)).repartition(max(1, n_packers), "_order").sortWithinPartitions("_order", *plain).drop("_order", "turn")
    out = T.StructType([*keyed.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches):
        from pyspark import TaskContext

        packer, first = Packer(capacity, open_bins), TaskContext.get().partitionId() << 40

        def placed(rows):
            lengths = rows.column("length").to_numpy()
            turn = np.argsort(-lengths, kind="stable")
            spots = np.array([packer.put(n) for n in lengths[turn].tolist()], np.int64)
            rows = rows.take(pa.array(turn))
            return rows.append_column("sequence_id", pa.array(first + spots[:, 0])).append_column("offset", pa.array(spots[:, 1]))

        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            while held.num_rows >= ahead:
                yield from placed(held.slice(0, ahead)).to_batches()
                held = held.slice(ahead)
        if held is not None and held.num_rows:
            yield from placed(held).to_batches()

    return keyed.mapInArrow(run, out)


def best_fit_packing(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, open_bins: int = OPEN_BINS, with_ids: bool = True) -> DataFrame:
    """Packed pieces: doc_id, piece, start, length, [ids], ids_crc32, sequence_id, offset.

    Null and empty texts hold the end id alone. Repeated rows are packed as often as they come. A null doc_id stays null.
    Other columns of docs play no part. No rows give no pieces. Texts of any length are cut, never dropped.
    """
    pieces = token_pieces(docs, path, capacity, end_id).withColumn("ids_crc32", F.crc32("ids"))
    if not with_ids:
        pieces = pieces.drop("ids")
    n_bytes = docs.agg(F.sum(F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)) + 8)).first()[0] or 0
    return pack_pieces(pieces, -(-n_bytes // PACKER_BYTES), capacity, open_bins)
