"""Words of many texts at once, as 64-bit hashes, straight from Arrow's text buffers.

A word is a run of bytes outside ``\\x20 \\x09-\\x0D``; A-Z is lower-cased first, nothing else. Hashes
are sums of a random value per byte and place in the word, then mixed with the length, so that each
word costs two look-ups in a running sum whatever its length. Two different words share a hash by
chance alone, once in 2^64. All constants come from one seed, the same in every process.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_rng = np.random.default_rng(20240229)


def _odd(n: int) -> np.ndarray:
    return _rng.integers(0, 2**63, n, dtype=np.uint64) * U64(2) + U64(1)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Kinds of bytes: ASCII letters, digits, all else in ASCII; 0 is space and what is not ASCII.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[:128] = 3
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[_SPACE] = 0
#: Multipliers that bind words to their places in a window.
PLACES = _odd(64)
#: Texts are worked on in slices of about so many bytes, which stay in a CPU's cache.
SLICE_BYTES = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
        return h ^ (h >> U64(31))


#: Places in a word whose values are kept; those behind are made when they come.
_KEPT = 32
_SEED = _odd(1)[0]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]


def _value(byte: np.ndarray, place: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((place.astype(U64) << U64(8) | _LOWER[byte]) * U64(0x9E3779B97F4A7C15) + _SEED)


_VALUES = _value(np.tile(np.arange(256), _KEPT), np.repeat(np.arange(_KEPT), 256))


@dataclass
class Slice:
    """Words of the texts ``first .. first + n - 1`` of a batch."""

    first: int
    n: int
    hashes: np.ndarray  # uint64 per word
    doc: np.ndarray  # text of each word, counted from 0 in this slice
    ends: np.ndarray  # words up to and with each text, n + 1 values from 0
    starts: np.ndarray  # byte at which each word starts in ``data``
    stops: np.ndarray
    data: np.ndarray  # bytes of all the texts
    _sums: np.ndarray

    def prefix(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(index, hash) of the first ``length`` bytes of the words that are longer than that."""
        longer = np.flatnonzero(self.stops - self.starts > length)
        starts = self.starts[longer]
        return longer, _span_hash(self._sums, starts, starts + length, U64(length))


def _span_hash(sums: np.ndarray, starts: np.ndarray, stops: np.ndarray, salt=U64(0)) -> np.ndarray:
    """Hashes of spans that each begin where a word does."""
    with np.errstate(over="ignore"):
        size = (stops - starts).astype(U64)
        return mix(sums[stops] - sums[starts] + size * PLACES[61] + salt * PLACES[63])


def _give_back() -> None:
    """Return to the system what is free in this process; not every C library can be asked for it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def sparing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, holding on to no freed memory: Python workers are used again, and what
    one job has freed would lie beside the memory of the next, or beside that of a job without Python."""

    def spared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _give_back()
        yield from run(batches)
        _give_back()

    return spared


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column, NULL as empty, without copying the bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    b = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return b, o


def slices(column: pa.Array | pa.ChunkedArray, parts: bool = False) -> Iterator[Slice]:
    """All words of a text column, some texts at a time; or parts of words, which also end where
    ASCII letters, digits and other ASCII characters meet, but not behind an apostrophe nor at a
    vertical bar."""
    if len(column) == 0:
        return
    data, offsets = text_buffers(column)
    first = 0
    while first < len(column):
        stop = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        stop = min(max(stop, first + 1), len(column))
        yield _words(data[offsets[first] : offsets[stop]], offsets[first : stop + 1], first, parts)
        first = stop


def _words(data: np.ndarray, offsets: np.ndarray, first: int, parts: bool) -> Slice:
    edges = offsets - offsets[0]
    n = len(data)
    space = _SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    ends = ~space
    ends[:-1] &= space[1:]
    inner = edges[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    begins[inner] = ~space[inner]
    ends[inner - 1] = ~space[inner - 1]
    if parts:
        kind, before = _KIND[data], data[:-1]
        meet = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        meet &= (before != ord("'")) & (before != ord("|")) & (data[1:] != ord("|"))
        begins[1:] |= meet
        ends[:-1] |= meet
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    # Places take half the memory where they fit 32 bits.
    at = np.arange(n, dtype=np.int32 if n < 1 << 31 else np.int64)
    place = at - np.maximum.accumulate(np.where(begins, at, at.dtype.type(0))) if n else at
    value = _VALUES[np.minimum(place, _KEPT - 1) << 8 | data]
    far = np.flatnonzero((place >= _KEPT) & ~space)
    value[far] = _value(data[far], place[far])
    sums = np.zeros(n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(value, out=sums[1:])
    upto = np.searchsorted(starts, edges, "left")
    return Slice(
        first=first,
        n=len(offsets) - 1,
        hashes=_span_hash(sums, starts, stops),
        doc=np.repeat(np.arange(len(offsets) - 1), np.diff(upto)),
        ends=upto,
        starts=starts,
        stops=stops,
        data=data,
        _sums=sums,
    )


def shingles(words: Slice, size: int) -> Iterator[np.ndarray]:
    """Per text, its distinct windows of ``size`` words, sorted; one of fewer words is one window
    as a whole, one without words has none."""
    h, ends = words.hashes, words.ends
    with np.errstate(over="ignore"):
        many = max(0, len(h) - size + 1)
        window = np.zeros(many, dtype=np.uint64)
        for k in range(size):
            window += h[k : k + many] * PLACES[k]
        window = mix(window)
        for i in range(words.n):
            a, b = int(ends[i]), int(ends[i + 1])
            if b - a >= size:
                yield np.unique(window[a : b - size + 1])
            elif b > a:
                whole = (h[a:b] * PLACES[: b - a]).sum(dtype=np.uint64)
                yield mix(np.array([whole + U64(b - a) * PLACES[62]], dtype=np.uint64))
            else:
                yield np.zeros(0, dtype=np.uint64)
