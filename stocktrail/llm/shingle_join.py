"""Exact Jaccard self-join on word shingles by partition of the universe and pigeonhole.

The hash range is split into segments; a document's shingles in a segment are its subset there.
Two sets within Hamming distance H can differ in at most H places, so

* of segments matched exactly, each that differs uses up one place;
* of segments matched up to one deletion, each that matches neither way uses up two.

Sizes go by bands of a factor two, each band with segments of its own. Pairs are sought in the
band of the smaller set; a set that may be the larger partner of a smaller band is signed there
too. In each band the allocation gives two units to a fixed few segments, which are indexed with
their one-deletion neighbourhoods where sets are so small that this is cheap, one unit to as many
other segments as the distance still asks for, the rarest first, by sums of what each task counts
of its frequent keys, and none to the rest. As that order is the same for all sets, two sets within the distance share a
key among those that both index. All candidates are then verified on their whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stocktrail.llm.components import components
from stocktrail.llm.words import PLACES, U64, mix, shingles, slices, sparing
from stocktrail.session import written

#: Keys of frequent subsets that are known to all tasks: at most so many, the most frequent.
HOT_KEYS = 1 << 18
#: Documents of one key that are paired in one task at most; a key with more is as many blocks
#: as it takes, and every two blocks are a task's cell.
BLOCK = 4096
#: A cell of so many documents is gone through pair by pair; arrays for each would take longer.
FEW = 16
#: Pairs of one task that are held to give each out once.
MOST_PAIRS = 500_000
#: Cells of one task that are held to be given out together.
HELD_CELLS = 100_000
#: A task counts the keys that occur so often among so many keys, one after another.
OFTEN, HELD_KEYS = 4, 1 << 20
#: Places of the table by which a task tells keys that are not frequent.
HOT_BITS = 1 << 22
#: Bits of the filter of candidate ids, as words of 64: at most 2 MB as a table, proven.
FILTER_WORDS = 1 << 17


@dataclass(frozen=True)
class Jaccard:
    """Threshold ``num / den``; words per shingle; spare segments; where deletions are indexed."""

    num: int = 3
    den: int = 4
    words: int = 5
    spare: float = 4.0
    deletion_bands: tuple[int, ...] = (4, 5)
    deletion_size: int = 8

    def distance(self, size: int, partner: int) -> int:
        """Most elements in which linked sets of these sizes can differ."""
        return (size + partner) * (self.den - self.num) // (self.den + self.num)

    def most_partner(self, size: int) -> int:
        return size * self.den // self.num

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = np.intersect1d(a, b, assume_unique=True).size
        return bool(both) and self.den * both >= self.num * (a.size + b.size - both)


class Hot:
    """How often the frequent keys occur. A table of bits by the keys' low ends tells most others
    apart before any search."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]
        self.maybe = np.zeros(HOT_BITS, dtype=bool)
        self.maybe[(keys & U64(HOT_BITS - 1)).astype(np.int64)] = True

    def counts_of(self, key: np.ndarray) -> np.ndarray:
        out = np.zeros(len(key), dtype=np.int64)
        may = np.flatnonzero(self.maybe[(key & U64(HOT_BITS - 1)).astype(np.int64)])
        if len(may):
            at = np.minimum(np.searchsorted(self.keys, key[may]), len(self.keys) - 1)
            out[may] = np.where(self.keys[at] == key[may], self.counts[at], 0)
        return out


class _Often:
    """Counts of the keys of one task in bounded memory: of each run of ``HELD_KEYS`` keys those
    that came ``OFTEN`` times or more in it, or had before, are kept on."""

    def __init__(self) -> None:
        self.held: list[np.ndarray] = []
        self.size = 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        self.held.append(keys)
        self.size += len(keys)
        if self.size > HELD_KEYS:
            self.settle()

    def settle(self) -> None:
        new, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.held]), return_counts=True)
        self.held, self.size = [], 0
        if len(self.keys) and len(new):
            at = np.minimum(np.searchsorted(self.keys, new), len(self.keys) - 1)
            known = self.keys[at] == new
            self.counts[at[known]] += n[known]
            new, n = new[~known], n[~known]
        keep = n >= OFTEN
        keys, counts = np.concatenate([self.keys, new[keep]]), np.concatenate([self.counts, n[keep]])
        if len(keys) > HOT_KEYS:
            most = np.argsort(-counts, kind="stable")[:HOT_KEYS]
            keys, counts = keys[most], counts[most]
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]


def _band(size: int) -> int:
    return size.bit_length() - 1


def _schemes(rule: Jaccard, size: int) -> list[tuple[int, int]]:
    """(band, most distance) of the bands in which a set of this size is signed."""
    own = _band(size)
    out = [(own, rule.distance(size, rule.most_partner(size)))]
    below = (1 << own) - 1  # largest set of the band below
    if below and rule.most_partner(below) >= size:
        out.append((own - 1, rule.distance(size, below)))
    return out


def _segments(rule: Jaccard, band: int, shingle: np.ndarray):
    """Segments of a band: (two-unit ones, one-unit ones, segment of each shingle)."""
    low, high = 1 << band, (2 << band) - 1
    most = rule.distance(high, rule.most_partner(high))
    with np.errstate(over="ignore"):
        salt = PLACES[40 + band % 16] * U64(band + 1)
        place = (mix(shingle + salt) >> U64(11)).astype(np.float64)
    place *= 2.0**-53
    twos, share = 0, 0.0
    if band in rule.deletion_bands:
        twos, share = 1, rule.deletion_size / low
    ones = int(np.ceil(rule.spare * (most + 1 - 2 * twos))) if most + 1 > 2 * twos else 1
    segment = twos + ((place - share) / (1 - share) * ones).astype(np.int64)
    segment = np.where(place < share, 0, np.minimum(segment, twos + ones - 1))
    return twos, ones, segment


class _Subsets:
    """The subsets of many sets in the segments of a band, one cell per set and segment. A key is a
    mix of the sum of a subset's elements, so that a deletion is a subtraction."""

    def __init__(self, rule: Jaccard, band: int, sets: list[np.ndarray]):
        shingle = np.concatenate(sets)
        self.band = band
        self.twos, self.ones, segment = _segments(rule, band, shingle)
        self.count = self.twos + self.ones
        owner = np.repeat(np.arange(len(sets)), [s.size for s in sets])
        self.cell = owner * self.count + segment
        self.element = mix(shingle ^ PLACES[50])
        self.sums = np.zeros(len(sets) * self.count, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.add.at(self.sums, self.cell, self.element)
        self.sizes = np.bincount(self.cell, minlength=self.sums.size)

    def keys(self, cells: np.ndarray, less: np.ndarray | None = None) -> np.ndarray:
        segments = (cells % self.count).astype(np.uint64)
        with np.errstate(over="ignore"):
            sums = self.sums[cells] if less is None else self.sums[cells] - less
            return mix(sums + (segments + U64(1)) * PLACES[51] + U64(self.band) * PLACES[52])

    def full(self) -> np.ndarray:
        """Cells of one-unit segments that are not empty."""
        cells = np.flatnonzero(self.sizes)
        return cells[cells % self.count >= self.twos] if self.twos else cells


def _by_band(rule: Jaccard, sets: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, _Subsets]]:
    """Per band: (indices of the sets that are signed in it, their most distances, their subsets)."""
    bands: dict[int, list[tuple[int, int]]] = {}
    for i, one in enumerate(sets):
        if one.size:
            for band, most in _schemes(rule, int(one.size)):
                bands.setdefault(band, []).append((i, most))
    for band, signed in bands.items():
        index, most = np.array(signed, dtype=np.int64).T
        yield index, most, _Subsets(rule, band, [sets[i] for i in index])


def possible_keys(rule: Jaccard, sets: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Keys of the one-unit segments that the sets might index."""
    for _, _, subsets in _by_band(rule, sets):
        yield subsets.keys(subsets.full())


def _order(counts: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Rare keys first, then those of large subsets, then by the key: what is left of ties is
    settled by the segment, so that the order is the same for all sets."""
    rare = np.minimum(counts, (1 << 24) - 1).astype(np.uint64) << U64(40)
    large = (255 - np.minimum(sizes, 255)).astype(np.uint64) << U64(32)
    return rare | large | keys >> U64(32)


def signatures(rule: Jaccard, sets: list[np.ndarray], hot: Hot) -> tuple[np.ndarray, np.ndarray]:
    """(index of the set, key) for all keys under which the sets are indexed. Those of one set
    differ but for chance and some deletions."""
    owners, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for index, most, subsets in _by_band(rule, sets):
        twos, count = subsets.twos, subsets.count
        if twos:
            first = (np.arange(len(index))[:, None] * count + np.arange(twos)).ravel()
            mine = np.flatnonzero(subsets.cell % count < twos)
            cells = subsets.cell[mine]
            owners += [index[first // count], index[cells // count]]
            keys += [subsets.keys(first), subsets.keys(cells, subsets.element[mine])]
        full = subsets.full()
        key = subsets.keys(full)
        order = _order(hot.counts_of(key), subsets.sizes[full], key)
        ends = np.searchsorted(full, np.arange(len(index) + 1) * count)
        needs = np.maximum(most + 1 - 2 * twos, 0)
        chosen, empty = [], []
        for i, need in enumerate(needs):
            a, b = ends[i], ends[i + 1]
            if b - a > need:
                chosen.append(a + np.argsort(order[a:b], kind="stable")[:need])
            else:
                chosen.append(np.arange(a, b))
                # Empty segments come last, in their own order.
                none = np.flatnonzero(subsets.sizes[i * count + twos : (i + 1) * count] == 0)
                empty.append(i * count + twos + none[: need - (b - a)])
        chosen = np.concatenate(chosen)
        owners.append(index[full[chosen] // count])
        keys.append(key[chosen])
        if empty:
            cells = np.concatenate(empty)
            owners.append(index[cells // count])
            keys.append(subsets.keys(cells))
    return np.concatenate(owners), np.concatenate(keys)


def _sizes_and_counts(rule: Jaccard):
    """Rows (doc_id, n_shingles, NULL), and (NULL, count, key) of keys frequent in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = _Often()
        for batch in batches:
            size = np.zeros(batch.num_rows, dtype=np.int64)
            for part in slices(batch.column(1)):
                sets = list(shingles(part, rule.words))
                size[part.first : part.first + part.n] = [s.size for s in sets]
                for keys in possible_keys(rule, sets):
                    often.add(keys)
            yield pa.record_batch(
                [batch.column(0), pa.array(size), pa.nulls(batch.num_rows, pa.int64())],
                names=["doc_id", "n_shingles", "key"],
            )
        often.settle()
        columns = [pa.nulls(len(often.keys), pa.int64()), pa.array(often.counts), pa.array(often.keys.view(np.int64))]
        yield pa.record_batch(columns, names=["doc_id", "n_shingles", "key"])

    return sparing(run)


def _signed(rule: Jaccard, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hot(*hot.value)
        for batch in batches:
            doc = batch.column(0).to_numpy()
            for part in slices(batch.column(1)):
                owner, keys = signatures(rule, list(shingles(part, rule.words)), known)
                yield pa.record_batch(
                    [pa.array(doc[part.first + owner]), pa.array(keys.view(np.int64))],
                    names=["doc", "key"],
                )

    return sparing(run)


def _verify(rule: Jaccard):
    """Rows (a, b, text_a, text_b), sorted by a as it happens, to the linked (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)  # rows of the same text_a follow one another
        for batch in batches:
            texts = batch.column(2)
            keep = np.zeros(batch.num_rows, dtype=bool)
            for part in slices(batch.column(3)):
                for i, other in enumerate(shingles(part, rule.words), part.first):
                    text = texts[i].as_py()
                    if last[0] != text:
                        one = next(slices(texts.slice(i, 1)))
                        last = text, next(shingles(one, rule.words))
                    keep[i] = rule.linked(last[1], other)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return sparing(run)


def parities(shingle: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls in each of some buckets, as bits: four to eight
    buckets per shingle, 512 at least, by the low bits of the hashes. With fewer, sets just beyond
    the distance hide it by sharing buckets, and each such pair is verified on its texts. Folded to the same size, two sets' bits
    differ in at most as many places as the sets do."""
    buckets = 1 << max(9, _band(max(1, int(shingle.size))) + 3)
    odd = np.bincount((shingle & U64(buckets - 1)).astype(np.int64), minlength=buckets) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def _sketches(rule: Jaccard):
    """Rows (doc_id, text) to (doc_id, n, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                sets = list(shingles(part, rule.words))
                yield pa.record_batch(
                    [
                        batch.column(0).slice(part.first, part.n),
                        pa.array([x.size for x in sets], pa.int64()),
                        pa.array([parities(x).tobytes() for x in sets], pa.binary()),
                    ],
                    names=["doc_id", "n", "sketch"],
                )

    return sparing(run)


def _apart(rule: Jaccard, n_a: int, n_b: int, a: bytes, b: bytes) -> bool:
    """Whether sizes and sketches alone show that two sets are too far from each other."""
    if rule.den * min(n_a, n_b) < rule.num * max(n_a, n_b):
        return True
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    words = min(x.size, y.size)
    differ = np.bitwise_count(_folded(x, words) ^ _folded(y, words)).sum()
    return int(differ) > rule.distance(n_a, n_b)


def _near(rule: Jaccard):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(2, 6)]
            keep = [not _apart(rule, *row) for row in zip(*columns)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return sparing(run)


def _across(rule: Jaccard, forest: bool = False):
    """Rows (cell, doc, component, side, n, sketch), sorted by cell, to pairs (a > b) of one cell
    that lie in different components and may be linked by their sizes and sketches. ``side`` is 0
    in a cell that is paired with itself, else 1 or 2, and pairs have both.

    With ``forest``, components that a pair given out would link count as one from then on, so that
    a cell gives fewer pairs than it has components; a cell of which pairs were left out for that
    is a row (NULL, NULL, cell).
    """

    left_out: set[int] = set()

    def cells_left() -> pa.RecordBatch:
        cells = pa.array(sorted(left_out), pa.int64())
        left_out.clear()
        none = pa.nulls(len(cells), pa.int64())
        return pa.record_batch([none, none, cells], names=["a", "b", "cell"])

    def few_pairs(cell: int | None, rows: list[tuple]) -> Iterator[tuple[list[int], list[int]]]:
        doc, component, side, n, sketch = zip(*rows)
        words = min(map(len, sketch)) // 8
        bits = [int.from_bytes(b if len(b) == 8 * words else _folded(np.frombuffer(b, np.uint64), words).tobytes()) for b in sketch]
        label, a, b = list(component), [], []
        for i in range(len(doc)):
            for j in range(i):
                if component[i] == component[j] or side[i] == side[j] != 0:
                    continue
                if rule.den * min(n[i], n[j]) < rule.num * max(n[i], n[j]):
                    continue
                if (bits[i] ^ bits[j]).bit_count() > rule.distance(n[i], n[j]):
                    continue
                if label[i] == label[j]:
                    left_out.add(cell)
                    continue
                a.append(max(doc[i], doc[j])), b.append(min(doc[i], doc[j]))
                if forest:
                    label = [label[i] if x == label[j] else x for x in label]
        if a:
            yield a, b

    def pairs(cell: int | None, rows: list[tuple]) -> Iterator[tuple]:
        if len({r[1] for r in rows}) < 2:
            return
        if len(rows) <= FEW:
            yield from few_pairs(cell, rows)
            return
        doc, component, side, n = (np.array([r[i] for r in rows], dtype=np.int64) for i in range(4))
        bits = [np.frombuffer(r[4], np.uint64) for r in rows]
        words = min(b.size for b in bits)
        bits = np.stack([_folded(b, words) for b in bits])
        label = np.unique(component, return_inverse=True)[1]
        # By size, then component: of several largest ones, the last has its rows together.
        order = np.lexsort((label, np.bincount(label)[label]))
        doc, component, side, n, bits = doc[order], component[order], side[order], n[order], bits[order]
        label = np.unique(component, return_inverse=True)[1]
        # Documents of small components come first, so that those of the last, a largest one, never ask.
        for i in range(len(doc) - 1):
            if component[i] == component[-1]:
                break
            rest = slice(i + 1, None)
            maybe = label[rest] != label[i]
            if forest and np.count_nonzero(maybe) < np.count_nonzero(component[rest] != component[i]):
                left_out.add(cell)
            maybe &= (side[rest] != side[i]) | (side[i] == 0)
            small, large = np.minimum(n[i], n[rest]), np.maximum(n[i], n[rest])
            maybe &= rule.den * small >= rule.num * large
            at = i + 1 + np.flatnonzero(maybe)
            differ = np.bitwise_count(bits[at] ^ bits[i]).sum(axis=1)
            most = (n[i] + n[at]) * (rule.den - rule.num) // (rule.den + rule.num)
            at = at[differ <= most]
            if forest:
                joined, first = np.unique(label[at], return_index=True)
                if len(joined) < len(at):
                    left_out.add(cell)
                at = at[first]
                label[np.isin(label, joined)] = label[i]
            other = doc[at]
            yield np.maximum(other, doc[i]), np.minimum(other, doc[i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        cell = None
        found: list[tuple] = []
        once = np.zeros((0, 2), dtype=np.int64)
        left_out.clear()

        def gather() -> None:
            nonlocal once
            new = [np.stack(f, axis=1) for f in found]
            found.clear()
            once = np.unique(np.concatenate([once, *new]), axis=0)

        def out() -> pa.RecordBatch:
            none = pa.nulls(len(once) if forest else 0, pa.int64())
            columns = [pa.array(once[:, 0].copy()), pa.array(once[:, 1].copy()), none]
            return pa.record_batch(columns if forest else columns[:2], names=["a", "b", "cell"][: 2 + forest])

        for batch in batches:
            for row in zip(*[batch.column(k).to_pylist() for k in range(6)]):
                if row[0] != cell:
                    found += pairs(cell, held)
                    if len(left_out) > HELD_CELLS:
                        yield cells_left()
                    cell, held = row[0], []
                    if len(found) > 4096:
                        gather()
                        if len(once) > MOST_PAIRS:
                            yield out()
                            once = once[:0]
                held.append(row[1:])
        found += pairs(cell, held)
        gather()
        yield out()
        if forest:
            yield cells_left()

    return sparing(run)


def _rows_of(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The documents named in ``pairs``, and few others, without moving a text: a filter of
    FILTER_WORDS rows of two numbers at most, which is what is broadcast whatever the corpus. It
    only spares work; where it fills up, more rows come through, to no effect on the joins."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_WORDS * 64))
    bit = F.pmod(place, F.lit(64)).cast("int")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    bits = asked.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(one).alias("bits"))
    return (
        docs.withColumn("word", F.shiftright(place, 6))
        .join(F.broadcast(bits), "word")
        .where(F.getbit("bits", bit) == 1)
        .select("doc_id", "text")
    )


def _links(rule: Jaccard, docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The linked of the candidate pairs (a > b): by sketches first, then on whole texts."""
    kinds = "doc_id long, n long, sketch binary"
    sketches = written(_rows_of(docs, pairs).mapInArrow(_sketches(rule), kinds), "sketches")
    a = sketches.toDF("a", "n_a", "sketch_a")
    b = sketches.toDF("b", "n_b", "sketch_b")
    sides = ["a", "b", "n_a", "n_b", "sketch_a", "sketch_b"]
    near = pairs.join(b, "b").join(a, "a").select(*sides).mapInArrow(_near(rule), "a long, b long")
    return _verified(rule, docs, written(near.distinct(), "near-pairs"))


def _verified(rule: Jaccard, docs: DataFrame, near: DataFrame) -> DataFrame:
    texts = written(_rows_of(docs, near), "candidate-texts")
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    rows = near.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")
    return written(rows.mapInArrow(_verify(rule), "a long, b long"), "verified")


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` (id, component) with what verified pairs (a > b) link made one. What it does not
    name is a component of its own; only the components linked are gone through."""
    ends = links.select("a", "b")
    for end in ("a", "b"):
        label = found.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}"))
        ends = ends.join(label, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    edges = ends.where("of_a != of_b").select(
        F.greatest("of_a", "of_b").alias("a"), F.least("of_a", "of_b").alias("b")
    )
    least = components(edges)
    up = least.select(F.col("id").alias("component"), F.col("component").alias("least"))
    known = found.join(up, "component", "left").select("id", F.coalesce("least", "component").alias("component"))
    return written(known.unionAll(least.join(found, "id", "left_anti")), "components")


def jaccard_components(docs: DataFrame, rule: Jaccard = Jaccard()) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text, and any more).

    ``component_id`` is the least doc_id that links reach. NULL or wordless text is an empty set
    and links with nothing. A row without doc_id keeps its size, links with nothing and has no
    component. Rows that repeat a doc_id come back one by one; they count as one document that
    links by whichever of its texts does. An empty table gives no rows.

    Pairs are verified in rounds: first each key's least document against its others, as
    many pairs as rows, however large a group of copies is; then, of keys whose documents are not
    all in one component by then, the pairs across components: a forest of them, and after it those
    left out that still lie across. Every pair that shares a key is thus verified or within one
    component already.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    first = written(
        docs.mapInArrow(_sizes_and_counts(rule), "doc_id long, n_shingles long, key long"), "sizes"
    )
    sizes = first.where("key is null").select("doc_id", "n_shingles")
    # No more than HOT_KEYS rows of two numbers, whatever the corpus.
    often = (
        first.where("key is not null")
        .groupBy("key")
        .agg(F.sum("n_shingles").alias("n"))
        .orderBy(F.desc("n"), "key")
        .limit(HOT_KEYS)
        .toPandas()
    )
    hot = often["key"].to_numpy(dtype=np.int64).view(np.uint64), often["n"].to_numpy(dtype=np.int64)
    known = spark.sparkContext.broadcast(hot)
    keys = docs.where("doc_id is not null").mapInArrow(_signed(rule, known), "doc long, key long")
    by_key = Window.partitionBy("key").orderBy("doc").rowsBetween(Window.unboundedPreceding, 0)
    shared = written(
        keys.withColumn("least", F.first("doc").over(by_key)).where("doc != least"), "shared-keys"
    )
    # An id that stands for several texts has several sizes.
    n = sizes.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high")
    )
    n_a = n.toDF("a", "low_a", "high_a")
    n_b = n.toDF("b", "low_b", "high_b")
    fits = F.expr(
        f"{rule.den} * high_a >= {rule.num} * low_b and {rule.den} * high_b >= {rule.num} * low_a"
    )
    stars = shared.select(F.col("doc").alias("a"), F.col("least").alias("b")).distinct()
    stars = written(stars.join(n_a, "a").join(n_b, "b").where(fits).select("a", "b"), "stars")
    links = _links(rule, docs, stars)
    found = written(components(links), "components")

    label = found.select(F.col("id").alias("doc"), "component")
    members = (
        shared.select("key", "least", "doc")
        .unionAll(shared.select("key", "least", F.col("least").alias("doc")))
        .distinct()
        .join(label, "doc", "left")
        .select("key", "least", "doc", F.coalesce("component", "doc").alias("component"))
    )
    members = written(members, "members")
    split = (
        members.groupBy("key")
        .agg(
            F.min("component").alias("x"),
            F.max("component").alias("y"),
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("doc")).alias("these"),
            F.bit_xor(F.xxhash64(F.lit(1), "doc")).alias("docs"),
        )
        .where("x != y and n > 2")
        # Of keys held by the same documents, as a shared passage makes many, one will do.
        .groupBy("n", "these", "docs")
        .agg(F.min("key").alias("key"))
        .select("key", "n")
    )
    # Whatever the key's size, a cell has two blocks of documents at most. Documents that share one
    # key often share more; keys of the same least document go to one task, cell after cell, which
    # gives out a pair once.
    open_rows = members.join(split, "key").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    block = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    cells = (
        open_rows.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("cell"),
            F.xxhash64("least", F.least("block", "other"), F.greatest("block", "other")).alias("route"),
            "doc",
            "component",
            F.expr("case when block = other then 0 when block < other then 1 else 2 end").alias("side"),
        )
    )
    cells = written(cells, "cells")
    asked = cells.select(F.col("doc").alias("a"), F.col("doc").alias("b")).distinct()
    shape = "doc_id long, n long, sketch binary"
    sketches = written(_rows_of(docs, asked).mapInArrow(_sketches(rule), shape), "sketches")

    def paired(rows: DataFrame, forest: bool) -> DataFrame:
        return (
            rows.join(sketches.withColumnRenamed("doc_id", "doc"), "doc")
            .repartition("route")
            .sortWithinPartitions("route", "cell")
            .select("cell", "doc", "component", F.col("side").cast("long").alias("side"), "n", "sketch")
            .mapInArrow(_across(rule, forest), "a long, b long" + ", cell long" * forest)
            .distinct()
        )

    # First no more pairs of a cell than it has components. Of near copies these link most, and
    # only cells that then still have several components, and pairs left out, are paired in full.
    few = written(paired(cells, True), "across")
    found = _joined(found, _verified(rule, docs, few.where("cell is null").select("a", "b")))
    label = found.select(F.col("id").alias("doc"), F.col("component").alias("now"))
    again = (
        cells.join(few.where("cell is not null").select("cell").distinct(), "cell", "left_semi")
        .join(label, "doc", "left")
        .withColumn("component", F.coalesce("now", "component"))
        .drop("now")
    )
    several = again.groupBy("cell").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    again = again.join(several.where("x != y").select("cell"), "cell", "left_semi")
    found = _joined(found, _verified(rule, docs, written(paired(again, False), "across")))
    return sizes.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
