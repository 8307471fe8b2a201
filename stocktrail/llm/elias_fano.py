"""Token files: ids one after another, and document boundaries as Elias-Fano codes.

An ascending list of n numbers below u takes about 2 + log2(u / n) bits each: the low bits of each
number as they are, the high ones as gaps in unary. A sample of the places of the set bits answers
``select`` by looking at a few bytes, so that no table of 64-bit offsets is kept.

File: 8 bytes of magic, a header, the code of the documents' ends, that of their doc_ids less the
first, the ids as little-endian integers of ``width`` bytes, and the CRC-32 of all that.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from stocktrail.llm.token_ids import document_ids
from stocktrail.session import scratch_path, written

MAGIC = b"EFTOKEN1"
#: magic, documents, of these without doc_id, ids, bytes per id, first doc_id, bytes of both codes
HEADER = struct.Struct("<8sQQQQqQQ")
#: A place is kept for every so many set bits.
SAMPLE = 128
_CODE = struct.Struct("<QQQ")


class EliasFano:
    """An ascending list of whole numbers from 0 (equal ones allowed)."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, sample: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.sample = n, low_bits, low, high, sample

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        shifts = np.arange(bits, dtype=np.uint64)
        low = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8), bitorder="little")
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        unary[ones] = 1
        return cls(n, bits, low, np.packbits(unary, bitorder="little"), ones[::SAMPLE].astype(np.uint64))

    def to_bytes(self) -> bytes:
        head = _CODE.pack(self.n, self.low_bits, len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.sample.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, bits, n_high = _CODE.unpack_from(data)
        a = _CODE.size
        b = a + -(-n * bits // 8)
        low, high = np.frombuffer(data[a:b], np.uint8), np.frombuffer(data[b : b + n_high], np.uint8)
        return cls(n, bits, low, high, np.frombuffer(data[b + n_high :], "<u8"))

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """Place of the i-th set bit: from the nearest sample on, byte by byte."""
        place, left = int(self.sample[i // SAMPLE]), i % SAMPLE
        byte, bit = divmod(place, 8)
        word = int(self.high[byte]) >> bit << bit
        while left >= (many := word.bit_count()):
            left -= many
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        return byte * 8 + (word & -word).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        start = i * self.low_bits
        stop = start + self.low_bits
        piece = int.from_bytes(self.low[start // 8 : -(-stop // 8)].tobytes(), "little")
        low = (piece >> start % 8) & ((1 << self.low_bits) - 1)
        return (self.select(i) - i) << self.low_bits | low

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        bits = np.unpackbits(self.low, bitorder="little", count=self.n * self.low_bits)
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return high | (bits.reshape(self.n, self.low_bits).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)


class TokenFile:
    """A token file in memory: the ids of any document, and the document of any id."""

    def __init__(self, data: bytes):
        if len(data) < HEADER.size + 4 or zlib.crc32(data[:-4]) != int.from_bytes(data[-4:], "little"):
            raise ValueError("not a whole token file")
        magic, self.n_docs, self.n_null, self.n_ids, width, self.first, n_ends, n_names = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        a, b = HEADER.size + n_ends, HEADER.size + n_ends + n_names
        self.ends = EliasFano.from_bytes(data[HEADER.size : a])
        self.names = EliasFano.from_bytes(data[a:b])
        self.ids = np.frombuffer(data, f"<u{width}", self.n_ids, b)

    @staticmethod
    def pack(doc_ids: list[int | None], documents: list[np.ndarray], width: int) -> bytes:
        """A file of documents in ascending order of doc_id, those without one first."""
        ends = np.cumsum([len(d) for d in documents])
        named = [d for d in doc_ids if d is not None]
        first = named[0] if named else 0
        codes = [EliasFano.of(ends).to_bytes(), EliasFano.of(np.array([d - first for d in named], dtype=np.uint64)).to_bytes()]
        ids = np.concatenate(documents).astype(f"<u{width}") if documents else np.zeros(0, f"<u{width}")
        head = HEADER.pack(MAGIC, len(documents), len(doc_ids) - len(named), len(ids), width, first, *map(len, codes))
        body = b"".join([head, *codes, ids.tobytes()])
        return body + zlib.crc32(body).to_bytes(4, "little")

    def doc_id(self, i: int) -> int | None:
        return None if i < self.n_null else self.first + self.names[i - self.n_null]

    def span(self, i: int) -> tuple[int, int]:
        return (self.ends[i - 1] if i else 0), self.ends[i]

    def document(self, i: int) -> np.ndarray:
        a, b = self.span(i)
        return self.ids[a:b]

    def holder(self, position: int) -> int:
        """The document in which the id at ``position`` lies."""
        a, b = 0, self.n_docs - 1
        while a < b:
            m = (a + b) // 2
            a, b = (m + 1, b) if self.ends[m] <= position else (a, m)
        return a


def _put(folder: str, name: str, data: bytes) -> None:
    """Write a file under another name and move it, so that a task that runs twice does no harm."""
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    passing = f"{root}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(passing) as out:
        out.write(data)
    store.move(passing, f"{root}/{name}")


def _get(folder: str, name: str) -> bytes:
    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{root}/{name}") as f:
        return f.read()


def _write(tokenizer: str, end: int, folder: str, width: int, most_ids: int):
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        names: list = []
        documents: list[np.ndarray] = []
        held = number = 0

        def flush() -> pa.RecordBatch:
            name = f"part-{part:06d}-{number:05d}.eft"
            _put(folder, name, TokenFile.pack(names, documents, width))
            row = {"part": [part], "number": [number], "file": [name], "n_docs": [len(names)], "n_ids": [held]}
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), document_ids(tokenizer, batch.column(1), end)):
                if documents and held + len(ids) > most_ids:
                    yield flush()
                    names.clear(), documents.clear()
                    held, number = 0, number + 1
                names.append(doc_id)
                documents.append(ids.astype(f"<u{width}"))
                held += len(ids)
        if documents:
            yield flush()

    return run


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = TokenFile(_get(folder, name))
                ends = file.ends.all().astype(np.int64)
                starts = np.concatenate([[0], ends])[:-1].astype(np.int64)
                names = [None] * file.n_null + [file.first + int(x) for x in file.names.all()]
                crcs = [
                    zlib.crc32(file.ids[a:b].astype("<u4").tobytes())
                    for a, b in zip(starts.tolist(), ends.tolist())
                ]
                columns = [pa.array(names, pa.int64()), pa.array(starts + base), pa.array(ends - starts), pa.array(crcs, pa.int64())]
                yield pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def write_token_files(
    docs: DataFrame, tokenizer: str, end: int, folder: str, width: int = 2, most_ids: int = 1 << 22
) -> DataFrame:
    """Write all texts' ids, in ascending order of doc_id, as token files below ``folder``.

    Returns (file, base, n_docs, n_ids) per file, ``base`` counting the ids of all files before.
    ``docs`` has doc_id and text; further columns are ignored. NULL or empty text is the end id
    alone. Rows without doc_id come first; of equal doc_ids, each row is a document, in the order
    of a hash of their texts. An empty table gives no files. ``width`` must hold the vocabulary.

    Texts move once, by ranges of (doc_id, hash), and ids not at all. ``folder`` is one that all
    executors reach; files hold ``most_ids`` ids, or a single longer document.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    files = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(
            _write(tokenizer, end, folder, width, most_ids),
            "part long, number long, file string, n_docs long, n_ids long",
        )
    )
    upto = F.sum("n_ids").over(Window.orderBy("part", "number"))
    return written(files, "token-files").select("file", (upto - F.col("n_ids")).alias("base"), "n_docs", "n_ids")


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document of the files that were written."""
    files = written(files, "token-files")
    many = max(1, files.count())
    return (
        files.select("file", "base")
        .repartition(many, "file")
        .mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def token_table(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Write token files to the shared folder and read them back."""
    folder = scratch_path(docs.sparkSession, "token-ids")
    return read_token_files(write_token_files(docs, tokenizer, end, folder), folder)
