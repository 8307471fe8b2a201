"""Spelling variants: words one edit apart, by pivotal bigrams, and the form that each goes back to.

Bigrams are ordered by how many words hold them, rare ones first. One edit can destroy two bigrams
that overlap but not two that do not; so of two disjoint bigrams of a word, its pivots, each near
word still holds one. The pivots are picked, by dynamic programming, among the word's rarest three
bigrams, its prefix. Of two near words, let the one whose prefix ends at the rarer bigram ask: the
bigram it keeps is then in the other's prefix.

Where that bigram lies is limited, too. The edit is either behind it, and all up to the bigram is
the same in both words, or before it, and all from the bigram on is. The index therefore holds not
the bare bigram but the word's part up to it, or from it, and the length of the whole word.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from stocktrail.session import written

#: Edits between near words, and letters of a gram. The keys rely on these two values.
EDITS, GRAM = 1, 2
#: One run in so many loses a code point.
SPOILT = 97
#: Words counted in one task before the counts so far go on; text looked at in one piece.
HELD, PIECE = 200_000, 1 << 20

#: A byte of Latin-1 to the letter it counts as, or to a space: a-z, A-Z as a-z, U+00C0 to U+00FF.
_LETTER = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs(text: str) -> Iterator[list[bytes]]:
    """The lower-cased runs of letters of a text, as Latin-1, some at a time."""
    data = text.encode("latin-1", "replace").translate(_LETTER)
    start = 0
    while start < len(data):
        stop = data.find(b" ", start + PIECE)
        stop = len(data) if stop < 0 else stop
        yield data[start:stop].split()
        start = stop


def spoilt(doc_id: int | None, run: bytes, before: int | None = None) -> bytes:
    """The run, short of a code point where the hash of document and run says so."""
    before = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode())) if before is None else before
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), before)
    if h % SPOILT:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counts(least: int):
    """(doc_id, text) to (word, times), each word once for some hundred thousand words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            made = pa.record_batch([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return made

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                doc_id, found = doc.as_py(), Counter()
                for some in runs(text.as_py() or ""):
                    found.update(some)
                before = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
                for one, n in found.items():
                    word = spoilt(doc_id, one, before)
                    if len(word) >= least:
                        total[word] += n
                if len(total) > HELD:
                    yield out()
        yield out()

    return run


def vocabulary(docs: DataFrame, length: int = 5, times: int = 3) -> DataFrame:
    """(word, n): words of at least so many code points and occurrences over all documents."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counted = texts.mapInArrow(_counts(length), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= times)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n: Counter[str] = Counter()
        for word in batch.column(0).to_pylist():
            n.update({word[i : i + GRAM] for i in range(len(word) - GRAM + 1)})
        yield pa.record_batch([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["gram", "n"])


def gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Each bigram's place from the rarest on, and the number of words that hold it. There are at
    most 90 x 90 bigrams of the 90 letters, whatever the corpus."""
    rows = words.select("word").mapInArrow(_gram_counts, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {g: (i, n) for i, (n, g) in enumerate(sorted((r["n"], r["gram"]) for r in rows))}


def pivots(places: list[int], weights: list[int], need: int = EDITS + 1, size: int = GRAM) -> list[int]:
    """The ``need`` places, in ascending order given, of least weight in sum whose grams do not overlap."""
    # best[k]: (weight, places) of k disjoint grams among those so far; ends[j] as of the first j.
    ends: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ())] + [None] * need]
    for j, place in enumerate(places):
        apart = next((i for i in range(j, 0, -1) if places[i - 1] + size <= place), 0)
        row = list(ends[j])
        for k in range(1, need + 1):
            rest = ends[apart][k - 1]
            if rest is not None and (row[k] is None or rest[0] + weights[j] < row[k][0]):
                row[k] = (rest[0] + weights[j], (*rest[1], place))
        ends.append(row)
    return list(ends[-1][need][1])


def signature(word: str, order: dict[str, tuple[int, int]]) -> tuple[int, list[int], list[int]]:
    """(place of the prefix's last bigram, places of the pivots, places of the prefix). All places
    of a bigram are in the prefix if one is, so that the order needs no places."""
    grams = [order[word[i : i + GRAM]] for i in range(len(word) - GRAM + 1)]
    last = sorted(g[0] for g in grams)[GRAM * EDITS]
    prefix = [i for i, g in enumerate(grams) if g[0] <= last]
    return last, pivots(prefix, [grams[i][1] for i in prefix]), prefix


def letter_parity(word: str) -> int:
    """Whether each letter comes an odd number of times, as bits (some letters share one). An edit
    turns two of them at most."""
    bits = 0
    for c in word:
        bits ^= 1 << (ord(c) * 37 % 61)
    return bits


def _keys(order):
    """(word, n) to (key, word, n, last, letters, asks): a row per part of a word and, of words that
    ask, per length of a near one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = order.value
        for batch in batches:
            at, key, asks, lasts, letters = [], [], [], [], []
            for i, word in enumerate(batch.column(0).to_pylist()):
                last, picked, prefix = signature(word, known)
                lasts.append(last)
                letters.append(letter_parity(word))
                n = len(word)
                for places, lengths, asking in ((picked, range(n - EDITS, n + EDITS + 1), True), (prefix, (n,), False)):
                    for p in places:
                        for part in ("<" + word[: p + GRAM], ">" + word[p:]):
                            for length in lengths:
                                at.append(i)
                                key.append(xxhash.xxh64_intdigest(f"{length}{part}"))
                                asks.append(asking)
            rows = np.array(at, dtype=np.int64)
            yield pa.record_batch(
                [
                    pa.array(np.array(key, dtype=np.uint64).view(np.int64)),
                    batch.column(0).take(pa.array(rows)),
                    batch.column(1).take(pa.array(rows)),
                    pa.array(np.array(lasts, dtype=np.int64)[rows]),
                    pa.array(np.array(letters, dtype=np.int64)[rows]),
                    pa.array(asks, pa.bool_()),
                ],
                names=["key", "word", "n", "last", "letters", "asks"],
            )

    return run


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all pairs of ``words`` (word, n) that are one edit apart, both ways.

    A word has less than 180 near words for each of its letters, as there are no more edits.
    """
    spark = words.sparkSession
    order = spark.sparkContext.broadcast(gram_order(words))
    shape = "key long, word string, n long, last long, letters long, asks boolean"
    keys = written(words.mapInArrow(_keys(order), shape), "gram-keys")
    a, b = keys.where("asks").alias("a"), keys.where("not asks").alias("b")
    may = (
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.last") <= F.col("b.last"))
        & (F.bit_count(F.col("a.letters").bitwiseXOR(F.col("b.letters"))) <= 2 * EDITS)
        & (F.col("a.word") != F.col("b.word"))
        & (F.levenshtein("a.word", "b.word", EDITS) == EDITS)
    )
    one = a.join(b, may).select("a.word", "a.n", F.col("b.word").alias("near"), F.col("b.n").alias("near_n"))
    other = one.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return one.unionAll(other).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following ``forms`` (word, form) from each word ends. A form is at least
    twice as frequent as the word, so a chain is no longer than the logarithm of the corpus, and
    each round doubles what has been followed of it."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        a, b = now.alias("a"), now.alias("b")
        further = a.join(b, F.col("a.root") == F.col("b.word"), "left").select(
            "a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved")
        )
        further = written(further, "roots")
        now = further.select("word", "root")
        if further.where("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, length: int = 5, times: int = 3, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of at least ``length`` code points that
    occurs ``times`` times or more in the texts of ``docs`` (doc_id, text; more columns are ignored).

    A word is a run of letters, A-Z lower-cased; one run in 97, by a hash of doc_id and run, is
    short of a code point. A word's form is its near word of largest n, the smallest in code-point
    order of equals, if that is at least ``ratio`` times the word's own; ``root`` is the end of the
    chain of forms. NULL text has no words; a NULL doc_id is empty in the hash; repeated rows count
    as often as they come. Without words there are no rows.
    """
    words = written(vocabulary(docs, length, times), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form")))
    near = near_words(words).groupBy("word").agg(F.first("n").alias("own"), F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.minus") >= ratio * F.col("own")
    near = written(
        near.select("word", "n_near", F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n")),
        "near-words",
    )
    ends = roots(near.where("form is not null"))
    return (
        words.join(near, "word", "left")
        .join(ends, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
    )
