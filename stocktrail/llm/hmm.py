"""Scoring texts by a hidden Markov language model, next to a smoothed unigram base.

The model emits symbols: each of the most frequent words by itself, the end of a text, and one
symbol per class of all other words (classes go by a word's last two bytes); within a class a word
has its smoothed share of the class's tokens. So parameters have a fixed size whatever the
vocabulary, and log P(text) = log P(symbols) + the sum of log P(word | class) over its rare words.
The first is an exact scaled forward recursion over the whole sequence; the second is a join of
(document, rare word) with the word counts, as is what the base needs of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stocktrail.llm.words import Slice, slices
from stocktrail.session import written

#: Stands for the end of a text among the words' hashes.
END = -1
_FOLD = np.arange(256, dtype=np.int64)
_FOLD[65:91] = _FOLD[97:123]


@dataclass(frozen=True)
class Model:
    """Hidden states; words with a symbol of their own; classes of the rest; rounds of
    Baum-Welch over all training texts; tokens that one training segment holds; seed."""

    states: int = 8
    heads: int = 16384
    classes: int = 512
    rounds: int = 4
    segment: int = 256
    seed: int = 5
    smooth: float = 0.1

    @property
    def symbols(self) -> int:
        return self.heads + self.classes + 1

    @property
    def end(self) -> int:
        return self.symbols - 1


def _classes(model: Model, words: Slice) -> np.ndarray:
    last = _FOLD[words.data[words.stops - 1]]
    before = np.where(words.stops - words.starts > 1, _FOLD[words.data[np.maximum(words.stops - 2, 0)]], 0)
    return (last * 131 + before * 7) % model.classes


def _hashes(words: Slice) -> np.ndarray:
    return words.hashes.view(np.int64)


def _counts(model: Model):
    """Word counts of one task: (word, class, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple] = []
            for part in slices(batch.column(0)):
                word, one, n = np.unique(_hashes(part), return_index=True, return_counts=True)
                held.append((word, _classes(model, part)[one], n))
            if held:
                word, one, which = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
                n = np.bincount(which, weights=np.concatenate([h[2] for h in held])).astype(np.int64)
                kind = np.concatenate([h[1] for h in held])[one]
                yield pa.record_batch([pa.array(word), pa.array(kind), pa.array(n)], names=["word", "class", "n"])
            ends = [np.array([v], dtype=np.int64) for v in (END, -1, batch.num_rows)]
            yield pa.record_batch([pa.array(v) for v in ends], names=["word", "class", "n"])

    return run


def _encode(model: Model, heads, total: float):
    """Texts to symbols, the base's sum over frequent words, and the rare words with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, end_count = heads.value
        log_p = np.log10((count + model.smooth) / total)
        end_p = np.log10((end_count + model.smooth) / total)
        for batch in batches:
            for part in slices(batch.column(2)):
                h = _hashes(part)
                at = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
                head = known[at] == h if len(known) else np.zeros(len(h), dtype=bool)
                symbol = np.where(head, at, model.heads + _classes(model, part)).astype(np.uint16)
                value = np.where(head, log_p[at], 0.0) if len(known) else np.zeros(len(h))
                base = np.concatenate([[0.0], np.cumsum(value)])
                heads_upto = np.concatenate([[0], np.cumsum(head)])
                sequences, rare, rare_n, rare_class, base_sum, n_known = [], [], [], [], [], []
                end = np.array([model.end], dtype=np.uint16)
                for i in range(part.n):
                    a, b = int(part.ends[i]), int(part.ends[i + 1])
                    sequences.append(np.concatenate([symbol[a:b], end]).tobytes())
                    tail = ~head[a:b]
                    word, one, n = np.unique(h[a:b][tail], return_index=True, return_counts=True)
                    rare.append(word)
                    rare_n.append(n)
                    rare_class.append(symbol[a:b][tail][one].astype(np.int64) - model.heads)
                    base_sum.append(base[b] - base[a] + end_p)
                    n_known.append(int(heads_upto[b] - heads_upto[a]) + int(end_count > 0))
                ends = pa.array(np.concatenate([[0], np.cumsum([len(w) for w in rare])]).astype(np.int32))
                lists = [
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).astype(t)))
                    for x, t in ((rare, np.int64), (rare_class, np.int32), (rare_n, np.int32))
                ]
                n = np.diff(part.ends) + 1
                columns = [
                    batch.column(0).slice(part.first, part.n),
                    batch.column(1).slice(part.first, part.n),
                    pa.array(n.astype(np.int64)),
                    pa.array(n_known, pa.int64()),
                    pa.array(base_sum, pa.float64()),
                    pa.array(sequences, pa.binary()),
                    *lists,
                ]
                yield pa.record_batch(columns, names=ENCODED.replace(",", " ").split()[::2])

    return run


ENCODED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base double, symbols binary, "
    "words array<bigint>, classes array<int>, times array<int>"
)


def forward(a: np.ndarray, start: np.ndarray, e: np.ndarray, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log likelihood of each whole sequence: the scaled forward recursion, many
    sequences at a time, the longest first so that those still running are always in front."""
    out = np.zeros(len(sequences))
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    for first in range(0, len(order), 512):
        group = order[first : first + 512]
        lengths = np.array([len(sequences[i]) for i in group])
        symbols = np.zeros((int(lengths[0]), len(group)), dtype=np.uint16)
        for k, i in enumerate(group):
            symbols[: lengths[k], k] = sequences[i]
        running = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")
        logs = np.zeros(len(group))
        state = np.broadcast_to(start, (len(group), len(start)))
        block: list[tuple[int, np.ndarray]] = []
        for t, n in enumerate(running.tolist()):
            state = (state[:n] if t == 0 else state[:n] @ a) * e[symbols[t, :n]]
            scale = state.sum(axis=1)
            state = state / scale[:, None]
            block.append((n, scale))
            if len(block) == 64 or t + 1 == len(running):
                for m, s in block:
                    logs[:m] += np.log(s)
                block = []
        out[group] = logs
    return out


def expected_counts(
    a: np.ndarray, start: np.ndarray, e: np.ndarray, symbols: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One step of Baum-Welch over segments of equal length (time x segment): expected emissions
    (symbol x state), transitions, and first states of those segments that begin a text."""
    steps, n = symbols.shape
    k = len(start)
    middle = stationary(a)
    alpha = np.empty((steps, n, k))
    scales = np.empty((steps, n))
    state = np.where(first[:, None], start, middle)
    for t in range(steps):
        state = (state if t == 0 else state @ a) * e[symbols[t]]
        scales[t] = state.sum(axis=1)
        state = state / scales[t][:, None]
        alpha[t] = state
    moves = np.zeros((k, k))
    beta = np.ones((n, k))
    for t in range(steps - 1, 0, -1):
        back = e[symbols[t]] * beta / scales[t][:, None]
        moves += alpha[t - 1].T @ back
        beta = back @ a.T
        alpha[t - 1] *= beta
    flat = symbols.ravel().astype(np.int64)
    gamma = alpha.reshape(-1, k)
    emitted = np.stack([np.bincount(flat, weights=gamma[:, j], minlength=len(e)) for j in range(k)], axis=1)
    return emitted, moves * a, alpha[0][first].sum(axis=0)


def stationary(a: np.ndarray) -> np.ndarray:
    p = np.full(len(a), 1 / len(a))
    for _ in range(200):
        p = p @ a
    return p / p.sum()


def _baum_welch(model: Model, parameters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, start, e = parameters.value
        emitted = np.zeros_like(e)
        moves, firsts = np.zeros_like(a), np.zeros_like(start)
        for batch in batches:
            by_length: dict[int, list[tuple[np.ndarray, bool]]] = {}

            def count(length: int) -> None:
                segments = by_length.pop(length)
                symbols = np.stack([s for s, _ in segments], axis=1)
                got = expected_counts(a, start, e, symbols, np.array([f for _, f in segments]))
                for total, more in zip((emitted, moves, firsts), got):
                    total += more

            for data in batch.column(0):
                s = np.frombuffer(data.as_buffer(), dtype=np.uint16)
                # Cut so that only a few lengths occur: whole segments, then powers of two.
                at = 0
                while at < len(s):
                    left = len(s) - at
                    length = model.segment if left >= model.segment else 1 << left.bit_length() - 1
                    held = by_length.setdefault(length, [])
                    held.append((s[at : at + length], at == 0))
                    if len(held) * length >= 1 << 17:
                        count(length)
                    at += length
            for length in list(by_length):
                count(length)
        k = model.states
        # Rows from -k - 1 on: transitions by state, then first states.
        table = np.concatenate([emitted, moves, firsts[None, :]])
        index = np.concatenate([np.arange(len(e)), -1 - np.arange(k + 1)])
        columns = [pa.array(index), *[pa.array(table[:, j]) for j in range(k)]]
        yield pa.record_batch(columns, names=["symbol", *[f"s{j}" for j in range(k)]])

    return run


def train(sequences: DataFrame, model: Model, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(transitions, first states, emissions symbol x state) from all of ``sequences``.

    Each round, tasks add up expected counts over their texts, Spark adds up the tasks', and the
    driver gets symbols x states numbers, a size that the model fixes.
    """
    k, context = model.states, sequences.sparkSession.sparkContext
    rng = np.random.default_rng(model.seed)
    e = shares[:, None] * np.exp(rng.normal(0, 1.0, (model.symbols, k)))
    e /= e.sum(axis=0)
    a = np.full((k, k), 0.1 / (k - 1)) if k > 1 else np.ones((1, 1))
    np.fill_diagonal(a, 0.9 if k > 1 else 1.0)
    start = np.full(k, 1 / k)
    kinds = "symbol long, " + ", ".join(f"s{j} double" for j in range(k))
    for _ in range(model.rounds):
        now = context.broadcast((a, start, e))
        rows = (
            sequences.mapInArrow(_baum_welch(model, now), kinds)
            .groupBy("symbol")
            .agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(k)])
            .collect()
        )
        emitted, moves, firsts = np.zeros((model.symbols, k)), np.zeros((k, k)), np.zeros(k)
        for row in rows:
            symbol = row[0]
            target = emitted[symbol] if symbol >= 0 else moves[-1 - symbol] if symbol >= -k else firsts
            target += row[1:]
        a = moves + 0.1
        a /= a.sum(axis=1, keepdims=True)
        start = (firsts + 0.1) / (firsts + 0.1).sum()
        # A few tokens' worth of the overall shares keeps every symbol possible in every state.
        e = emitted + 100 * shares[:, None]
        e /= e.sum(axis=0)
    return a, start, e


def _score(parameters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, start, e = parameters.value
        for batch in batches:
            sequences = [np.frombuffer(x.as_buffer(), dtype=np.uint16) for x in batch.column(5)]
            logs = forward(a, start, e, sequences) / np.log(10)
            columns = [*[batch.column(i) for i in range(5)], pa.array(logs), batch.column(6)]
            yield pa.record_batch(columns, names=[*batch.schema.names[:5], "log_symbols", "row"])

    return run


def score(docs: DataFrame, model: Model = Model()) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), logs to base 10.

    ``docs`` has doc_id and text; further columns are ignored. Texts whose crc32(doc_id as text)
    is a multiple of 10 are held out of all learning; a row without doc_id is learnt from. NULL or
    empty text is the end token alone. Repeated rows are counted, and come back, one by one. An
    empty table gives no rows.
    """
    context = docs.sparkSession.sparkContext
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(10)) == 0, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), F.col("text").cast("string"))
    words = written(
        docs.where(~F.col("held_out"))
        .select("text")
        .mapInArrow(_counts(model), "word long, class long, n long")
        .groupBy("word", "class")
        .agg(F.sum("n").alias("n")),
        "word-counts",
    ).where("n > 0")
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total = tokens + model.smooth * (distinct + 1)
    ends = words.where(F.col("word") == END).select("n").first()
    ends = ends[0] if ends else 0
    rare_or_head = words.where(F.col("class") >= 0)
    head = sorted(tuple(r) for r in rare_or_head.orderBy(F.desc("n"), "word").limit(model.heads).select("word", "n").collect())
    known = np.array([w for w, _ in head], dtype=np.int64)
    count = np.array([n for _, n in head], dtype=np.float64)
    heads = context.broadcast((known, count, ends))
    # Rare words: all but the heads, which the least count and word among them tell apart.
    edge = min(((n, -w) for w, n in head), default=(0, 0))
    rare = rare_or_head.where((F.col("n") < edge[0]) | ((F.col("n") == edge[0]) & (F.col("word") > -edge[1])))
    class_rows = rare.groupBy("class").agg(F.sum("n").alias("class_n"), F.count("*").alias("class_words")).collect()

    encoded = written(
        docs.select("doc_id", "held_out", "text").mapInArrow(_encode(model, heads, total), ENCODED).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "symbols",
    )
    shares = np.full(model.symbols, 0.1)
    shares[: len(count)] += count
    shares[model.end] += ends
    for kind, n, _ in class_rows:
        shares[model.heads + kind] += n
    parameters = context.broadcast(
        train(encoded.where(~F.col("held_out")).select("symbols"), model, shares / shares.sum())
    )
    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, log_symbols double, row long"
    scored = encoded.select(*ENCODED.replace(",", " ").split()[:12:2], "row").mapInArrow(_score(parameters), kinds)

    # At most as many rows as classes.
    mass = {kind: n + model.smooth * (types + 1) for kind, n, types in class_rows}
    class_mass = F.array(*[F.lit(float(mass.get(c, model.smooth))) for c in range(model.classes)])
    tail = (
        encoded.select("row", F.explode(F.arrays_zip("words", "classes", "times")).alias("w"))
        .select("row", F.col("w.words").alias("word"), F.col("w.classes").alias("class"), F.col("w.times").alias("times"))
        .join(rare.select("word", F.col("n").alias("c")), "word", "left")
        .withColumn("c", F.coalesce("c", F.lit(0)))
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10((F.col("c") + model.smooth) / F.lit(total))).alias("base_tail"),
            F.sum(F.col("times") * F.log10((F.col("c") + model.smooth) / F.element_at(class_mass, (F.col("class") + 1).cast("int")))).alias("log_words"),
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known_tail"),
        )
    )
    zero = F.lit(0)
    return scored.join(tail, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known_tail", zero)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_tail", zero)).alias("base_score"),
        (F.col("log_symbols") + F.coalesce("log_words", zero)).alias("score"),
    )
