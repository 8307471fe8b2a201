"""Token ids of whole texts by a public tokenizer, with a memory of word parts seen.

Ids are those that the library gives for the whole text. Most of its time goes into normalising
and splitting the same words again and again. The tokenizer drops white space, lower-cases, and
never merges across the places where ``words.slices(parts=True)`` cuts, so each part is encoded
by the library once and looked up from then on, all parts of many texts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from stocktrail.llm.words import Slice, slices

#: Places of the table of parts at first and at most (powers of two), a quarter of which is filled at
#: most, and ids remembered at most; then all are let go and learnt again.
FIRST_PLACES, PLACES, MOST_IDS = 1 << 16, 1 << 22, 8_000_000
#: Bytes of new parts encoded in one call, about; the library takes some hundred times their memory.
LEARN_BYTES = 1 << 16
#: Places next to its own in which a part may lie.
PROBES = 16


class Encoder:
    """Ids by part: a table of hashes with open addressing, and one pool of ids."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self._make_places(FIRST_PLACES)
        self.pool = np.zeros(0, dtype=np.uint32)
        self.at = np.zeros(0, dtype=np.int64)
        self.n = np.zeros(0, dtype=np.int64)

    def _make_places(self, places: int) -> None:
        self.places = places
        self.key = np.zeros(places + PROBES, dtype=np.uint64)
        self.slot = np.zeros(places + PROBES, dtype=np.int32)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys & np.uint64(self.places - 1)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where it is not known."""
        place = self._place(keys)
        there = self.key[place]
        slots = np.where(there == keys, self.slot[place], np.int32(-1))
        left = np.flatnonzero((there != keys) & (there != 0))
        for step in range(1, PROBES):
            if not left.size:
                break
            there = self.key[place[left] + step]
            same = there == keys[left]
            slots[left[same]] = self.slot[place[left[same]] + step]
            left = left[~same & (there != 0)]
        return slots

    def _learn(self, keys: np.ndarray, parts: list[str]) -> None:
        """Encode new parts in one call, apart by spaces, and remember them."""
        starts = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
        found = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        at = np.array([o[0] for o in found.offsets], dtype=np.int64)
        n = np.bincount(np.searchsorted(starts, at, "right") - 1, minlength=len(parts))
        first = len(self.n)
        self.at = np.concatenate([self.at, len(self.pool) + np.cumsum(n) - n])
        self.n = np.concatenate([self.n, n])
        self.pool = np.concatenate([self.pool, np.array(found.ids, dtype=np.uint32)])
        new = np.arange(first, len(self.n), dtype=np.int32)
        if len(self.n) > self.places // 4:
            keys, new = self._wider(keys, new)
        self._put(keys, new)

    def _wider(self, keys: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Make a larger table; what is to be put into it, with what the old one held."""
        held = np.flatnonzero(self.key)
        keys = np.concatenate([self.key[held], keys])
        new = np.concatenate([self.slot[held], new])
        places = self.places
        while len(keys) > places // 4:
            places *= 2
        self._make_places(places)
        return keys, new

    def _put(self, keys: np.ndarray, new: np.ndarray) -> None:
        place = self._place(keys)
        for _ in range(PROBES):
            # Of several keys that ask for one free place, one gets it; the others go on.
            free = np.flatnonzero(self.key[place] == 0)
            self.key[place[free]] = keys[free]
            self.slot[place[free]] = new[free]
            got = np.flatnonzero(self.key[place] != keys)
            if not got.size:
                return
            keys, new, place = keys[got], new[got], place[got] + 1
        raise OverflowError("no place near")  # not with a quarter of them filled

    def ids(self, words: Slice) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of the slice, where each text's begin and the last one's end)."""
        if len(self.n) > PLACES // 4 or len(self.pool) > MOST_IDS:
            self._forget()
        keys = words.hashes | np.uint64(1) << np.uint64(63)  # 0 is a free place
        slots = self._find(keys)
        unknown = np.flatnonzero(slots < 0)
        if unknown.size:
            new, one = np.unique(keys[unknown], return_index=True)
            data = words.data.tobytes()
            starts, stops = words.starts[unknown[one]], words.stops[unknown[one]]
            group = np.cumsum(stops - starts) // LEARN_BYTES
            for some in np.split(np.arange(len(new)), np.flatnonzero(np.diff(group)) + 1):
                spans = zip(starts[some].tolist(), stops[some].tolist())
                self._learn(new[some], [data[a:b].decode() for a, b in spans])
            slots[unknown] = self._find(keys[unknown])
        n = self.n[slots]
        stop = np.cumsum(n)
        total = int(stop[-1]) if len(stop) else 0
        place = np.repeat(self.at[slots] - (stop - n), n)
        place += np.arange(total)
        return self.pool[place], np.concatenate([[0], stop])[words.ends]


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per process and file: Python workers that are used again keep what they know."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def document_ids(path: str, texts: pa.Array, end: int) -> Iterator[np.ndarray]:
    """Per text (NULL as empty), its ids and the end id, as unsigned 32-bit integers."""
    memory = encoder(path)
    for words in slices(texts, parts=True):
        ids, edges = memory.ids(words)
        for i in range(words.n):
            yield np.append(ids[edges[i] : edges[i + 1]], np.uint32(end))
