"""Token ids in files of shuffled, compressed planes.

Texts are dealt to ranges of ascending identifiers, tokenised where they land and
written by their tasks, so the files in order hold all ids in order. A file is

    magic | chunks | document table | chunk index | footer

A chunk holds up to ``CHUNK`` ids. Its 32-bit ids are transposed into planes (one per
byte, or one per bit), so that equal parts of neighbouring ids lie together, and each
plane is compressed by itself; a plane of zeros takes no bytes. The chunk index has
every chunk's offset, ids, crc32 and the compressed length of each plane, so a range of
ids is read without the rest of the file. The document table has identifier and ids of
each document. All numbers are little-endian.

A document lies in one file; a file is closed after ``FILE_IDS`` ids. The table of files
is written by Spark, in order of range and number, and names the files of the attempts
that succeeded: what a lost task left is in no table. Starts are sums over that table.

Null texts count as empty; an empty text has the end id only. Null identifiers come
last. Rows with equal identifiers follow in the order of their texts' digests; repeated
rows are written each, and a repeated identifier is spread over ranges. An empty table
gives a table of no files and no rows. Very long texts are used whole; where the
tokenizer drops white space they are taken apart in pieces cut at white space. Only the
named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator
from pathlib import Path
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linespan.llm.common import WHITE, scratch_folder, settle, tidy

MAGIC = b"IDPLANE1"
CHUNK = 1 << 16
FILE_IDS = 1 << 22
LEVEL = 3
PLANES = {"byte": 4, "bit": 32}
# Footer: kind of planes, lengths of the compressed document table and chunk index, documents, chunks, ids.
FOOTER = "<B7xQQQQQ"
KINDS = tuple(PLANES)
# White space is cut as bytes, which leaves other characters whole.
WHITE_BYTES = frozenset(WHITE.encode())
PIECE_BYTES = 1 << 20
# Words whose ids a worker keeps, and words tokenised at once.
REMEMBERED, WORDS_AT_ONCE = 800_000, 500
# Words that are one piece: letters without combining marks, or marks. A border lies between the two.
LATER_LETTER = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"
PLAIN_WORD = re.compile(rb"(?:[A-Za-z]|" + LATER_LETTER + rb")+|[.,;:!?#$%&*]+")
MARK_AFTER_LETTER = re.compile(
    rb"[.,;:!?#$%&*](?:(?<=[A-Za-z].)|(?<=" + LATER_LETTER + rb".))", re.DOTALL
)
# First byte of the combining marks that join ASCII letters to one letter.
JOINING_MARK = b"\xcc"
KEPT_MODULE = "token_words_of_this_worker"
FILES = "path string, part int, number int, n_docs long, n_ids long"


def split_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """Transpose ids into planes, least significant first."""
    cells = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [plane.tobytes() for plane in cells.T]
    bits = np.unpackbits(cells, axis=1, bitorder="little")
    return [plane.tobytes() for plane in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def join_planes(planes: list[bytes], count: int, kind: str) -> np.ndarray:
    """The ids of planes; an empty plane is all zeros."""
    cells = np.zeros((PLANES[kind], count if kind == "byte" else -(-count // 8)), np.uint8)
    for row, plane in zip(cells, planes, strict=True):
        if plane:
            row[:] = np.frombuffer(plane, np.uint8)
    if kind == "bit":
        bits = np.unpackbits(cells, axis=1, count=count, bitorder="little")
        cells = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").T
    return np.ascontiguousarray(cells.T).view("<u4").ravel()


def index_kind(kind: str) -> np.dtype:
    return np.dtype([("offset", "<u8"), ("ids", "<u4"), ("crc", "<u4"), ("lengths", "<u4", (PLANES[kind],))])


DOCUMENT = np.dtype([("id", "<i8"), ("known", "u1"), ("ids", "<u8")])


class PlaneWriter:
    """Writes documents to one file."""

    def __init__(self, files: pyarrow.fs.FileSystem, path: str, kind: str) -> None:
        self.out = files.open_output_stream(path)
        self.kind, self.pack = kind, zstandard.ZstdCompressor(level=LEVEL)
        self.held, self.n_held, self.n_ids = [], 0, 0
        self.chunks, self.documents = [], []
        self.out.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, identifier: int | None, ids: np.ndarray) -> None:
        self.documents.append((identifier or 0, identifier is not None, len(ids)))
        self.n_ids += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= CHUNK:
            every = np.concatenate(self.held)
            full = len(every) // CHUNK * CHUNK
            for start in range(0, full, CHUNK):
                self._chunk(every[start : start + CHUNK])
            self.held, self.n_held = [every[full:]], len(every) - full

    def _chunk(self, ids: np.ndarray) -> None:
        planes = [
            self.pack.compress(plane) if any(plane) else b"" for plane in split_planes(ids, self.kind)
        ]
        self.chunks.append((self.at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), [len(p) for p in planes]))
        for plane in planes:
            self.out.write(plane)
            self.at += len(plane)

    def close(self) -> tuple[int, int]:
        """Write what is left; return the numbers of documents and ids."""
        if self.n_held:
            self._chunk(np.concatenate(self.held))
        table = self.pack.compress(np.array(self.documents, DOCUMENT).tobytes())
        index = self.pack.compress(np.array(self.chunks, index_kind(self.kind)).tobytes())
        self.out.write(table + index)
        self.out.write(
            struct.pack(
                FOOTER, KINDS.index(self.kind), len(table), len(index), len(self.documents), len(self.chunks), self.n_ids
            )
        )
        self.out.write(MAGIC)
        self.out.close()
        return len(self.documents), self.n_ids


class PlaneReader:
    """Reads documents or ranges of ids from one file."""

    def __init__(self, files: pyarrow.fs.FileSystem, path: str) -> None:
        self.source = files.open_input_file(path)
        end = self.source.size()
        size = struct.calcsize(FOOTER)
        tail = size + len(MAGIC)
        last = self._bytes(end - tail, tail) if end >= tail + len(MAGIC) else b""
        if last[size:] != MAGIC or self._bytes(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is not a complete file of planes")
        kind, table, index, n_docs, n_chunks, self.n_ids = struct.unpack(FOOTER, last[:size])
        self.kind, self.unpack = KINDS[kind], zstandard.ZstdDecompressor()
        self.documents = self._table(end - tail - index - table, table, DOCUMENT, n_docs)
        self.chunks = self._table(end - tail - index, index, index_kind(self.kind), n_chunks)
        self.ends = np.cumsum(self.chunks["ids"].astype(np.int64))

    def _bytes(self, at: int, length: int) -> bytes:
        self.source.seek(at)
        return self.source.read(length)

    def _table(self, at: int, length: int, kind: np.dtype, rows: int) -> np.ndarray:
        content = self.unpack.decompress(self._bytes(at, length), max_output_size=max(1, kind.itemsize * rows))
        return np.frombuffer(content, kind, rows)

    def chunk(self, number: int) -> np.ndarray:
        entry = self.chunks[number]
        lengths = entry["lengths"].tolist()
        content, count = self._bytes(int(entry["offset"]), sum(lengths)), int(entry["ids"])
        size = count if self.kind == "byte" else -(-count // 8)
        planes, at = [], 0
        for length in lengths:
            part = content[at : at + length]
            planes.append(self.unpack.decompress(part, max_output_size=size) if length else b"")
            at += length
        ids = join_planes(planes, count, self.kind)
        if zlib.crc32(ids.tobytes()) != int(entry["crc"]):
            raise ValueError(f"chunk {number} does not have its checksum")
        return ids

    def span(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file; only the chunks that hold them are read."""
        first = int(np.searchsorted(self.ends, start, "right"))
        last = int(np.searchsorted(self.ends, stop, "left"))
        parts = [self.chunk(k) for k in range(first, min(last + 1, len(self.chunks)))] if stop > start else []
        begin = int(self.ends[first - 1]) if first else 0
        every = np.concatenate(parts) if parts else np.zeros(0, "<u4")
        return every[start - begin : stop - begin]

    def each(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Identifier, start and ids of every document, one chunk at a time."""
        held, n_held, number, start = [], 0, 0, 0
        for identifier, known, count in self.documents.tolist():
            while n_held < count:
                ids = self.chunk(number)
                held.append(ids)
                n_held, number = n_held + len(ids), number + 1
            every = held[0] if len(held) == 1 else np.concatenate(held or [np.zeros(0, "<u4")])
            yield identifier if known else None, start, every[:count]
            held, n_held, start = [every[count:]], len(every) - count, start + count


def pieces(text: bytes, length: int) -> Iterator[bytes]:
    """Cut a long text at white space, about every ``length`` bytes; a word stays whole."""
    start = 0
    while len(text) - start > length:
        cut = next((at for at in range(start + length, start, -1) if text[at] in WHITE_BYTES), 0)
        cut = cut or next((at for at in range(start + length, len(text)) if text[at] in WHITE_BYTES), 0)
        if not cut:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def remembered_words(definition: str) -> dict[bytes, bytes]:
    """Ids of words known to this worker process; it serves several tasks."""
    holder = sys.modules.setdefault(KEPT_MODULE, ModuleType(KEPT_MODULE))
    name = f"words_{zlib.crc32(definition.encode())}"
    if not hasattr(holder, name):
        setattr(holder, name, {})
    return getattr(holder, name)


class Encoder:
    """Ids of texts, from the tokenizers library.

    A tokenizer that drops white space gives a text the ids of its words one after the
    other. Then words not met before are tokenised many at a time and looked up
    afterwards. Words of plain letters, or of plain marks, are one piece with one
    end-of-word token, which tells their ids apart; other words are tokenised alone.
    """

    def __init__(self, definition: str, end_id: int, drops_white: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        self.end, self.drops_white = np.array([end_id], "<u4"), drops_white
        stated = json.loads(definition)
        suffix = stated["model"].get("end_of_word_suffix")
        normalizer = stated.get("normalizer") or {}
        self.lowers = any(n["type"] == "Lowercase" for n in normalizer.get("normalizers", [normalizer]) if n)
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if suffix:
            self.closes[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.known = remembered_words(definition)

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4")

    def _learn(self, words: list[bytes]) -> None:
        together = self.closes.any()
        plain = [w for w in words if together and PLAIN_WORD.fullmatch(w)]
        parts = [plain[start : start + WORDS_AT_ONCE] for start in range(0, len(plain), WORDS_AT_ONCE)]
        for part, ids in zip(parts, self._each([b" ".join(part) for part in parts]), strict=True):
            ends = (4 * np.flatnonzero(self.closes[ids]) + 4).tolist()
            if len(ends) != len(part):
                raise ValueError("a word has several end-of-word tokens")
            packed = ids.tobytes()
            self.known.update(zip(part, map(packed.__getitem__, map(slice, [0, *ends], ends)), strict=True))
        others = [word for word in words if word not in self.known]
        self.known.update(zip(others, (ids.tobytes() for ids in self._each(others)), strict=True))

    def _each(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text; offsets into the texts are not asked for."""
        for start in range(0, len(texts), WORDS_AT_ONCE):
            part = [text.decode() for text in texts[start : start + WORDS_AT_ONCE]]
            for found in self.tokenizer.encode_batch_fast(part, add_special_tokens=False):
                yield np.array(found.ids, "<u4")

    def _lowered(self, text: bytes) -> bytes:
        """ASCII letters lower-cased before the lookup, where the tokenizer does so itself."""
        return text.lower() if self.lowers and JOINING_MARK not in text else text

    def _packed(self, texts: list[bytes]) -> list[bytes]:
        lists = [MARK_AFTER_LETTER.sub(rb" \g<0>", self._lowered(text)).split() for text in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self._learn(list(set().union(*lists).difference(self.known)))
        return [b"".join(map(self.known.__getitem__, words)) for words in lists]

    def encode(self, texts: Iterator[bytes | None]) -> Iterator[np.ndarray]:
        """Ids of each text with the end id; about ``PIECE_BYTES`` of texts are looked up together."""
        held: list[bytes] = []
        n_held = 0
        for text in texts:
            content = text or b""
            if not self.drops_white:
                yield np.concatenate((self.whole(content), self.end))
            elif len(content) > PIECE_BYTES:
                yield from self._flush(held)
                held, n_held = [], 0
                parts = [self._packed([piece])[0] for piece in pieces(content, PIECE_BYTES)]
                yield np.concatenate((np.frombuffer(b"".join(parts), "<u4"), self.end))
            else:
                held.append(content)
                n_held += len(content)
                if n_held > PIECE_BYTES:
                    yield from self._flush(held)
                    held, n_held = [], 0
        yield from self._flush(held)

    def _flush(self, held: list[bytes]) -> Iterator[np.ndarray]:
        for packed in self._packed(held):
            yield np.concatenate((np.frombuffer(packed, "<u4"), self.end))


def write(
    docs: DataFrame, *, identifier: Column, text: Column, tokenizer: str, end_id: int, planes: str = "byte",
    drops_white: bool = False, folder: str | None = None, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Tokenise, write files to ``folder`` in ascending order, and return the table of files.

    ``tokenizer`` is the path of a definition for the tokenizers library, read by the driver.
    Columns: path, part, number (their order), n_docs, n_ids, start (ids of all files before).
    """
    spark = docs.sparkSession
    folder = folder or scratch_folder(spark, "token-files")
    definition = spark.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        part, encoder, writer, rows = TaskContext.get().partitionId(), None, None, []
        path = ""

        def close() -> None:
            n_docs, n_ids = writer.close()
            rows.append((f"{folder}/{path}", part, len(rows), n_docs, n_ids))

        for batch in batches:
            if encoder is None and batch.num_rows:
                encoder = Encoder(definition.value, end_id, drops_white)
                files.create_dir(root, recursive=True)
            texts = (text.as_py() for text in batch.column("text").cast(pa.binary()))
            found = encoder.encode(texts) if batch.num_rows else ()
            for identifier, ids in zip(batch.column("id").to_pylist(), found, strict=True):
                if writer is None:
                    path = f"{part:08d}-{len(rows):04d}-{uuid.uuid4().hex}.idp"
                    writer = PlaneWriter(files, f"{root}/{path}", planes)
                writer.add(identifier, ids)
                if writer.n_ids >= file_ids:
                    close()
                    writer = None
        if writer is not None:
            close()
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
            names=["path", "part", "number", "n_docs", "n_ids"],
        )

    order = [F.col("id").asc_nulls_last(), F.col("digest"), F.col("row")]
    dealt = docs.select(
        identifier.cast("long").alias("id"), text.alias("text"),
        F.xxhash64(text).alias("digest"), F.monotonically_increasing_id().alias("row"),
    ).repartitionByRange(*order).sortWithinPartitions(*order)
    files = settle(dealt.select("id", "text").mapInArrow(tidy(run), FILES), "token-index")
    # One small row a file.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return settle(files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "token-starts")


def read(files: DataFrame) -> DataFrame:
    """Return id, start, n_tokens and ids (little-endian unsigned 32-bit numbers) of every document in the files."""
    n_files = max(1, files.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                source, place = pyarrow.fs.FileSystem.from_uri(path)
                rows, held = [], 0
                for identifier, start, ids in PlaneReader(source, place).each():
                    rows.append((identifier, base + start, len(ids), ids.tobytes()))
                    held += len(ids)
                    if held >= 1 << 20:
                        yield batched(rows)
                        rows, held = [], 0
                if rows:
                    yield batched(rows)

    def batched(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            names=["id", "start", "n_tokens", "ids"],
        )

    return files.select("path", "start").repartition(n_files).mapInArrow(
        tidy(run), "id long, start long, n_tokens long, ids binary"
    )
