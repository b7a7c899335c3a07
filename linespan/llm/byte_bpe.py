"""Byte-level BPE encoding and decoding with padded numpy matrices.

A text is split by the vocabulary's pattern. Pieces not met before are sorted
into buckets of similar length and laid out as one padded matrix of token ids
per bucket. Each round looks up the rank of every adjacent pair in a hash
table, every row merges its leftmost pair of minimum rank, and the columns
behind it move up. Rows without a known pair leave the matrix.

A piece of ``WIDE`` bytes or more has a row of its own, cut into blocks that keep their
minima, so a round costs the same at any length.

Null and empty texts give no ids and decode to no bytes. Repeated rows are
encoded alike. Texts of any length are encoded whole: a piece's row is as long
as the piece, and only rows of like length share a matrix. Of equal ranks the leftmost pair
merges first. An empty table gives no rows. All columns of the documents are kept; ``ids`` and
``decoded`` take the place of columns of that name.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linespan.llm.common import tidy

NO_PAIR_ID = 2**31 - 1
NO_PAIR = np.int32(NO_PAIR_ID)
CACHED_PIECES = 120_000
MATRIX_CELLS = 1 << 18
WIDE = 512
IDS_AT_ONCE = 200_000
# Bytes of text encoded at once.
TEXT_AT_ONCE = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Read a rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PairTable:
    """Open-addressing hash table from a pair of token ids to the merged id."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        keys = (np.array(left, np.uint64) << np.uint64(32)) | np.array(right, np.uint64)
        values = np.array(merged, np.int32)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.mask = np.int64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << self.bits, NO_PAIR)
        slots = self._slot(keys)
        waiting = np.arange(len(keys))
        while len(waiting):
            # Of the keys that want one free slot the first gets it; the others step on.
            wanted = slots[waiting]
            free = self.values[wanted] == NO_PAIR
            _, first = np.unique(wanted[free], return_index=True)
            placed = waiting[free][first]
            self.keys[slots[placed]] = keys[placed]
            self.values[slots[placed]] = values[placed]
            waiting = np.setdiff1d(waiting, placed, assume_unique=True)
            slots[waiting] = (slots[waiting] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def one(self, left: int, right: int) -> int:
        """Merged id of one pair, NO_PAIR where there is none."""
        key = left << 32 | right
        slot = ((key * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)
        while (value := self.values.item(slot)) != NO_PAIR_ID:
            if self.keys.item(slot) == key:
                return value
            slot = (slot + 1) & int(self.mask)
        return NO_PAIR_ID

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, NO_PAIR where there is none. Ids below 0 never pair."""
        keys = ((left.astype(np.uint64) << np.uint64(32)) | (right.astype(np.uint64) & np.uint64(0xFFFFFFFF))).ravel()
        found = np.full(len(keys), NO_PAIR)
        open_ = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slots = self._slot(keys[open_])
        while len(open_):
            hit = self.keys[slots] == keys[open_]
            found[open_[hit]] = self.values[slots[hit]]
            on = ~hit & (self.values[slots] != NO_PAIR)
            open_, slots = open_[on], (slots[on] + 1) & self.mask
        return found.reshape(left.shape)


class Encoder:
    """Encodes texts by a rank file; remembers pieces met before."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.pairs = PairTable(ranks)
        self.byte_ids = np.full(256, -1, np.int32)
        for byte in range(256):
            self.byte_ids[byte] = ranks.get(bytes([byte]), -1)
        if (self.byte_ids < 0).any():
            raise ValueError("the rank file has no token for some byte")
        # Ids of a piece, packed as 32-bit numbers.
        self.known: dict[str, bytes] = {}

    def _merge_matrix(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces of like length, packed as 32-bit numbers."""
        lengths = np.array([len(p) for p in pieces])
        ids = np.full((len(pieces), lengths.max()), -1, np.int32)
        ids[np.arange(ids.shape[1]) < lengths[:, None]] = self.byte_ids[
            np.frombuffer(b"".join(pieces), np.uint8)
        ]
        results = [b""] * len(pieces)
        rows = np.arange(len(pieces))
        merged = self.pairs.lookup(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = merged.argmin(axis=1) if merged.shape[1] else np.zeros(len(rows), np.int64)
            best = merged[np.arange(len(rows)), at] if merged.shape[1] else np.full(len(rows), NO_PAIR)
            done = best == NO_PAIR
            if done.any():
                ready = ids[done]
                full = ready >= 0
                packed = ready[full].tobytes()
                ends = (np.cumsum(full.sum(axis=1)) * 4).tolist()
                begin = 0
                for row, end in zip(rows[done].tolist(), ends, strict=True):
                    results[row] = packed[begin:end]
                    begin = end
                rows, ids, merged, at, best = rows[~done], ids[~done], merged[~done], at[~done], best[~done]
                if not len(rows):
                    break
                used = int((ids >= 0).sum(axis=1).max())
                ids, merged = ids[:, :used], merged[:, : used - 1]
            every = np.arange(len(rows))
            ids[every, at] = best
            columns = np.arange(ids.shape[1] - 1)
            source = columns + (columns > at[:, None])
            ids = np.concatenate(
                [np.take_along_axis(ids, source, 1), np.full((len(rows), 1), -1, np.int32)], axis=1
            )
            columns = np.arange(merged.shape[1] - 1)
            source = columns + (columns >= at[:, None])
            merged = np.concatenate(
                [np.take_along_axis(merged, source, 1), np.full((len(rows), 1), NO_PAIR)], axis=1
            )
            # Only the pairs that hold the new token change.
            merged[every, at] = np.where(
                at + 1 < ids.shape[1],
                self.pairs.lookup(best, ids[every, np.minimum(at + 1, ids.shape[1] - 1)]),
                NO_PAIR,
            )
            inner = at > 0
            merged[every[inner], at[inner] - 1] = self.pairs.lookup(
                ids[every[inner], at[inner] - 1], best[inner]
            )
        return results

    def _merge_wide(self, piece: bytes) -> bytes:
        """Ids of one long piece: the same rounds over a row cut into blocks.

        Each block keeps its minimum, so a round looks at the minima and at the blocks of the pairs it
        changes. Merged places stay as gaps that neighbours skip.
        """
        n = len(piece)
        start = self.byte_ids[np.frombuffer(piece, np.uint8)]
        ids, after, before = start.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        merged = np.full(-(-n // WIDE) * WIDE, NO_PAIR)
        merged[: n - 1] = self.pairs.lookup(start[:-1], start[1:])
        blocks = merged.reshape(-1, WIDE)
        least = blocks.min(axis=1)
        none, find = int(NO_PAIR), self.pairs.one
        while True:
            block = int(least.argmin())
            best = int(least[block])
            if best == none:
                return np.array([i for i in ids if i >= 0], np.int32).tobytes()
            at = block * WIDE + int(blocks[block].argmin())
            gone = after[at]
            following, previous = after[gone], before[at]
            ids[at], ids[gone], after[at] = best, -1, following
            merged[gone] = none
            if following < n:
                before[following] = at
                merged[at] = find(best, ids[following])
            else:
                merged[at] = none
            if previous >= 0:
                merged[previous] = find(ids[previous], best)
            for changed in {block, gone // WIDE, max(previous, 0) // WIDE}:
                least[changed] = blocks[changed].min()

    def _learn(self, pieces: list[str]) -> None:
        raw = [p.encode() for p in pieces]
        buckets: dict[int, list[int]] = {}
        for number, piece in enumerate(raw):
            whole = self.ranks.get(piece)
            if whole is not None:
                self.known[pieces[number]] = np.int32(whole).tobytes()
            else:
                size = len(piece)
                if size >= WIDE:
                    self.known[pieces[number]] = self._merge_wide(piece)
                    continue
                # Lengths within an eighth of each other share a bucket.
                step = 1 << max(0, size.bit_length() - 4)
                buckets.setdefault(-(-size // step) * step, []).append(number)
        for width, numbers in buckets.items():
            rows = max(1, MATRIX_CELLS // width)
            for start in range(0, len(numbers), rows):
                part = numbers[start : start + rows]
                for number, ids in zip(part, self._merge_matrix([raw[n] for n in part]), strict=True):
                    self.known[pieces[number]] = ids

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each whole text."""
        split = [self.pattern.findall(text) if text else [] for text in texts]
        if len(self.known) > CACHED_PIECES:
            self.known.clear()
        new = set().union(*split).difference(self.known)
        if new:
            self._learn(list(new))
        packed = self.known.__getitem__
        return [np.frombuffer(b"".join(map(packed, pieces)), np.int32) for pieces in split]


class Decoder:
    """Bytes of token ids, by one table of all tokens' bytes."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        top = max(ranks.values(), default=-1) + 1
        tokens = [b""] * top
        for token, rank in ranks.items():
            tokens[rank] = token
        self.table = np.frombuffer(b"".join(tokens), np.uint8)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def decode(self, lists: pa.ListArray) -> list[bytes]:
        """Decoded bytes of each row; null rows give none. Many ids are looked up at once."""
        out, values = [], lists.flatten().to_numpy()
        sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        row = 0
        while row < len(sizes):
            last = max(row + 1, int(np.searchsorted(edges, edges[row] + IDS_AT_ONCE, "right")) - 1)
            ids = values[edges[row] : edges[last]]
            length = self.length[ids]
            ends = np.cumsum(length)
            place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[ids] - ends + length, length)
            packed = self.table[place].tobytes()
            at = np.concatenate([[0], ends])[edges[row : last + 1] - edges[row]].tolist()
            out += [packed[a:b] for a, b in zip(at, at[1:], strict=False)]
            row = last
        return out


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _slices(batch: pa.RecordBatch, column: str, cells: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of bounded bytes, so that few very long texts are held at once."""
    start, held = 0, 0
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    for number, size in enumerate(sizes):
        if held and held + size > cells:
            yield batch.slice(start, number - start)
            start, held = number, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def share_file(docs: DataFrame, path: str) -> str:
    """Send a vocabulary file with the job; return the name workers find it by."""
    docs.sparkSession.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(docs: DataFrame, vocabulary: str, pattern: str, *, text: str = "text") -> DataFrame:
    """Return the rows with ``ids``, the token ids of the whole text.

    Columns of ``docs`` stay, but for one named ``ids``, which is replaced.
    """
    name = share_file(docs, vocabulary)
    columns = [c for c in docs.columns if c != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(read_ranks(SparkFiles.get(name)), pattern)
        for whole in batches:
            for batch in _slices(whole, text, TEXT_AT_ONCE):
                ids = _lists(encoder.encode(batch.column(text).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in columns), ids], names=[*columns, "ids"]
                )

    slim = docs.select(*(f"`{c}`" for c in columns))
    return slim.mapInArrow(tidy(run), _schema_with(slim, "ids array<int>"))


def decode(tokens: DataFrame, vocabulary: str, *, ids: str = "ids", drop: tuple[str, ...] = ()) -> DataFrame:
    """Return the rows with ``decoded``, the bytes of ``ids``; null ids give no bytes."""
    name = share_file(tokens, vocabulary)
    columns = [c for c in tokens.columns if c != "decoded" and c not in drop]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(read_ranks(SparkFiles.get(name)))
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(decoder.decode(batch.column(ids)), pa.binary())],
                names=[*columns, "decoded"],
            )

    slim = tokens.select(*(f"`{c}`" for c in columns))
    return slim.mapInArrow(tidy(run), _schema_with(slim, "decoded binary"))


def _schema_with(rows: DataFrame, extra: str):
    schema = rows.sparkSession.createDataFrame([], extra).schema
    return type(schema)([*rows.schema.fields, *schema.fields])


def ids_digest(ids: Column) -> Column:
    """Lowercase hex SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.concat_ws(" ", ids.cast("array<string>")), 256)
