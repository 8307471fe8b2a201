"""Packing documents into sequences as a cutting-stock problem, by column generation.

Documents are cut at multiples of the sequence length; the pieces that remain are items. Only
their histogram goes to the driver, a number per class of lengths. There a linear program chooses
patterns (how many pieces of which classes share a sequence); a knapsack by dynamic programming
finds the pattern that would lower its cost most, until none does. Whole parts of the solution and
a subset-sum for each sequence of the rest make a plan of some hundred patterns, whatever the number of documents.
Back on Spark, each piece's rank in its class leads to its place in the plan by arithmetic.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stocktrail.llm.token_ids import document_ids
from stocktrail.llm.words import sparing
from stocktrail.session import batches_of, written

#: Lengths are rounded up to multiples of this in the plan.
GRID = 8
#: Bytes of texts that go to a Python worker at a time, about.
BATCH_BYTES = 1 << 21
#: Buckets over which the ranking of one class is spread.
BUCKETS = 256


def best_pattern(worth: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the multiset of classes of most worth that fits ``room``."""
    best = np.zeros(room + 1)
    last = np.full(room + 1, -1, dtype=np.int64)
    order = np.argsort(sizes, kind="stable")
    sizes_up, worth_up = sizes[order], worth[order]
    for r in range(1, room + 1):
        fits = int(np.searchsorted(sizes_up, r, "right"))
        best[r], last[r] = best[r - 1], -1
        if fits:
            gain = best[r - sizes_up[:fits]] + worth_up[:fits]
            k = int(gain.argmax())
            if gain[k] > best[r] + 1e-12:
                best[r], last[r] = gain[k], order[k]
    pattern = np.zeros(len(sizes))
    r = room
    while r > 0:
        if last[r] < 0:
            r -= 1
        else:
            pattern[last[r]] += 1
            r -= int(sizes[last[r]])
    return float(best[room]), pattern


def inverted(matrix: np.ndarray) -> np.ndarray:
    """The inverse by elimination, a vector operation per row: the threads of a linear algebra
    library have been seen to stall within Spark's driver."""
    n = len(matrix)
    both = np.concatenate([matrix, np.eye(n)], axis=1)
    for i in range(n):
        pivot = i + int(np.abs(both[i:, i]).argmax())
        both[[i, pivot]] = both[[pivot, i]]
        both[i] /= both[i, i]
        factor = both[:, i].copy()
        factor[i] = 0
        both -= factor[:, None] * both[i]
    return both[:, n:]


def solve_patterns(
    sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = 2e-3, rounds: int = 5000
) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as columns, how often each) of a linear program within ``gap`` of its best.

    Revised simplex with the basis' inverse kept up to date; starts from patterns of one class.
    """
    m = len(sizes)
    basis = np.diag((room // sizes).astype(float))
    inverse = np.diag(1 / (room // sizes).astype(float))
    bound = 0.0
    for turn in range(rounds):
        if turn % 250 == 249:
            inverse = inverted(basis)
        x = (inverse * demand).sum(axis=1)
        price = inverse.sum(axis=0)
        worth, pattern = best_pattern(np.maximum(price, 0), sizes, room)
        cost = float((price * demand).sum())
        bound = max(bound, cost / worth)  # dual prices, scaled so that no pattern is worth over 1
        if worth <= 1 + 1e-9 or cost <= (1 + gap) * bound:
            break
        turnout = (inverse * pattern).sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(turnout > 1e-9, np.maximum(x, 0) / turnout, np.inf)
        out = int(ratio.argmin())
        basis[:, out] = pattern
        row = inverse[out] / turnout[out]
        inverse -= np.outer(turnout, row)
        inverse[out] = row
    return basis, np.maximum((inverted(basis) * demand).sum(axis=1), 0)


def fullest(size: np.ndarray, left: np.ndarray, room: int, pattern: np.ndarray) -> None:
    """Add to ``pattern`` those of the pieces left whose sizes fill ``room`` most, long ones
    first: subset sums as the bits of whole numbers."""
    sums, seen, everything = 1, [], (1 << room + 1) - 1
    for i in np.argsort(-size, kind="stable").tolist():
        for _ in range(min(int(left[i]), room // int(size[i]))):
            seen.append((i, sums))
            sums = (sums | sums << int(size[i])) & everything
            if sums >> room:
                break
        if sums >> room:
            break
    total = sums.bit_length() - 1
    for i, before in reversed(seen):
        if not before >> total & 1:
            pattern[i] += 1
            total -= int(size[i])


def plan(sizes: list[int], demand: list[int], room: int) -> list[tuple[dict[int, int], int]]:
    """Patterns {class: pieces} and whole numbers of sequences that hold exactly ``demand``."""
    if not sizes:
        return []
    size, left = np.array(sizes, dtype=np.int64), np.array(demand, dtype=np.int64)
    patterns, times = solve_patterns(size, left.astype(float), room)
    made: list[tuple[dict[int, int], int]] = []

    def take(pattern: np.ndarray, many: int) -> None:
        nonlocal left
        if many > 0:
            made.append(({int(i): int(pattern[i]) for i in np.flatnonzero(pattern)}, many))
            left = left - pattern * many

    # Largest shares first; never more than the demand that is left.
    for k in np.argsort(-times, kind="stable"):
        pattern = np.round(patterns[:, k]).astype(np.int64)
        used = pattern > 0
        if used.any():
            take(pattern, int(min(np.floor(times[k] + 1e-6), (left[used] // pattern[used]).min())))
    while left.any():
        # What is left is less than a sequence per pattern: the longest piece, then what fills
        # the sequence best.
        pattern = np.zeros_like(left)
        longest = int(np.flatnonzero(left)[size[left > 0].argmax()])
        pattern[longest] = 1
        fullest(size, left - pattern, room - int(size[longest]), pattern)
        used = pattern > 0
        take(pattern, int((left[used] // pattern[used]).min()))
    return made


def _pieces(tokenizer: str, end: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), document_ids(tokenizer, batch.column(1), end)):
                for a in range(0, len(ids), length):
                    piece = ids[a : a + length]
                    rows.append((doc_id, a, len(piece), zlib.crc32(piece.astype("<u4").tobytes()), len(ids)))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)]
            yield pa.record_batch(columns, names=names)

    return sparing(run)


def pack(docs: DataFrame, tokenizer: str, end: int, length: int = 2048, grid: int = GRID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece.

    ``docs`` has doc_id and text; further columns are ignored. Every row is a document, also one
    that repeats another or has no doc_id; NULL or empty text is the end id alone. Each id lies in
    exactly one piece; a sequence's pieces lie from 0 on without gaps, in at most ``length``
    tokens. An empty table gives no rows.
    """
    spark = docs.sparkSession
    cut = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _pieces(tokenizer, end, length),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long",
    )
    with batches_of(spark, BATCH_BYTES):
        pieces = written(cut, "pieces")
    pieces = pieces.withColumn("class", F.ceil(F.col("length") / grid).cast("int"))
    # At most length / grid rows.
    histogram = sorted(tuple(r) for r in pieces.groupBy("class").count().collect())
    classes = [c for c, _ in histogram]
    slots, sequence, before = [], 0, dict.fromkeys(classes, 0)
    for pattern, many in plan(classes, [n for _, n in histogram], length // grid):
        for i, each in pattern.items():
            c = classes[i]
            slots.append((c, before[c], before[c] + each * many, each, sequence))
            before[c] += each * many
        sequence += many
    slots = spark.createDataFrame(slots, "class int, from_rank long, to_rank long, each long, first_sequence long")

    # Ranks in two steps, so that no class is one task: within a bucket, and buckets in order.
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(BUCKETS)))
    counts = pieces.groupBy("class", "bucket").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("class").orderBy("bucket"))
    counts = written(counts.select("class", "bucket", (upto - F.col("n")).alias("ranks_before")), "class-ranks")
    in_bucket = Window.partitionBy("class", "bucket").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32")
    rank = F.col("ranks_before") + F.row_number().over(in_bucket) - 1
    ranked = pieces.join(counts, ["class", "bucket"]).withColumn("rank", rank)
    placed = (
        ranked.join(slots, "class")
        .where("from_rank <= rank and rank < to_rank")
        .withColumn("nth", F.col("rank") - F.col("from_rank"))
        .withColumn("sequence_id", F.expr("first_sequence + nth div each"))
        .withColumn("turn", F.expr("nth % each"))
    )
    in_sequence = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "turn")
    stop = F.sum("length").over(in_sequence.rowsBetween(Window.unboundedPreceding, 0))
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", (stop - F.col("length")).alias("offset")
    )
