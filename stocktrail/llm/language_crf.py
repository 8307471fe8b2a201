"""Language of texts by a linear-chain conditional random field over their words.

A word's features are its first and last bytes, the bigrams and trigrams of its bytes, and how its
occurrences in the corpus spread over the languages, if it is among the frequent words of one. The
field adds transitions, learnt on sequences stitched together from spans of several languages, so
that a text may switch between them. A text's language is the one with most expected words, by
forward-backward over the whole text; the score is their share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stocktrail.llm.words import U64, Slice, slices, sparing
from stocktrail.session import batches_of, written

UNKNOWN = "und"
#: Affixes up to so many bytes; a word's grams together weigh as much as so many affixes.
PREFIX, SUFFIX, GRAMS = 3, 4, 3.0
#: Words whose grams are looked at together, words of a block of the field.
TOGETHER, BLOCK = 1 << 15, 512
#: Bytes of texts that go to a Python worker at a time, about.
BATCH_BYTES = 1 << 21
#: Rows (word, language, times) that a task holds before they go on.
HELD = 1 << 18


@dataclass(frozen=True)
class Rule:
    """Held out are documents whose hash leaves ``held`` on division by ``folds``. The field is
    fitted on at most ``sample`` documents per language, ``spans`` spans of ``span`` words of each;
    the lexicon counts all documents and takes ``lexicon`` words per language."""

    folds: int = 4
    held: int = 2
    sample: int = 300
    spans: int = 3
    span: int = 24
    lexicon: int = 4096
    buckets: int = 1 << 16
    steps: int = 60
    penalty: float = 1e-4


@dataclass(frozen=True)
class Field:
    """``weights`` per bucket and language, ``moves`` between languages as factors; ``lexicon``:
    sorted words (as hashes) and the weight each adds to each language."""

    languages: list[str]
    weights: np.ndarray
    moves: np.ndarray
    lexicon: np.ndarray
    worth: np.ndarray


_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _wordlike(part: Slice) -> np.ndarray:
    """Which of a slice's words hold a letter; bytes that are not ASCII pass as letters."""
    upto = np.concatenate([[0], np.cumsum(_LETTER[part.data])])
    return np.flatnonzero(upto[part.stops] > upto[part.starts])


def _bucket(code: np.ndarray, kind: int, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (code.astype(np.uint64) + U64(kind << 40)) * U64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> U64(29))) * U64(0xBF58476D1CE4E5B9) >> U64(40)).astype(np.int64) & (buckets - 1)


def _affixes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of the words' first 1, 2 .. and last 1, 2 .. bytes, a column each. ``data`` has some
    bytes behind the last word."""
    out, code = [], np.zeros(len(starts), dtype=np.uint64)
    size = stops - starts
    for k in range(PREFIX):
        code = code << U64(8) | np.where(size > k, data[starts + k], 0).astype(np.uint64)
        out.append(_bucket(code, k + 1, buckets))
    code = np.zeros(len(starts), dtype=np.uint64)
    for k in range(SUFFIX):
        code = code << U64(8) | np.where(size > k, data[stops - 1 - np.minimum(k, size - 1)], 0).astype(np.uint64)
        out.append(_bucket(code, 8 + k, buckets))
    return np.stack(out, axis=1)


def _grams(data: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the bigram and of the trigram that begin at each byte but the last two."""
    a, b, c = (data[i : len(data) - 2 + i].astype(np.uint64) for i in range(3))
    two = a << U64(8) | b
    return _bucket(two, 16, buckets), _bucket(two << U64(8) | c, 17, buckets)


def _each(part: Slice, which: np.ndarray):
    """Words ``which`` of a slice, some at a time: (them, their bytes one behind another, where each
    starts and stops in these)."""
    for i in range(0, len(which), TOGETHER):
        some = which[i : i + TOGETHER]
        size = part.stops[some] - part.starts[some]
        stops = np.cumsum(size)
        data = np.zeros(int(stops[-1]) + PREFIX, dtype=np.uint8)
        data[:-PREFIX] = _LOWER[part.data[np.repeat(part.starts[some] - (stops - size), size) + np.arange(stops[-1])]]
        yield some, data, stops - size, stops


def emissions(field: Field, part: Slice, which: np.ndarray) -> np.ndarray:
    """What each of the words adds to each language."""
    out = np.zeros((len(which), len(field.languages)))
    buckets, at = len(field.weights), 0
    for some, data, starts, stops in _each(part, which):
        mine = field.weights[_affixes(data, starts, stops, buckets)].sum(axis=1)
        two, three = _grams(data, buckets)
        size = stops - starts
        for gram, n in ((two, 2), (three, 3)):
            upto = np.concatenate([np.zeros((1, out.shape[1])), np.cumsum(field.weights[gram], axis=0)])
            has = np.flatnonzero(size >= n)
            sums = upto[stops[has] - n + 1] - upto[starts[has]]
            mine[has] += sums * (GRAMS / (2 * size[has] - 3 + (size[has] < 3)))[:, None]
        if len(field.lexicon):
            h = part.hashes[some]
            place = np.minimum(np.searchsorted(field.lexicon, h), len(field.lexicon) - 1)
            mine += np.where((field.lexicon[place] == h)[:, None], field.worth[place], 0)
        out[at : at + len(some)] = mine
        at += len(some)
    return out


def factors(field: Field, part: Slice, which: np.ndarray) -> np.ndarray:
    """``expected_words``'s factors of the words, each different one looked at once."""
    _, one, place = np.unique(part.hashes[which], return_index=True, return_inverse=True)
    score = emissions(field, part, which[one]).T
    return np.exp(score - score.max(axis=0, initial=-np.inf))[:, place]


def _times(rows: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Rows times a small matrix, term by term: threads of a linear algebra library do not go well
    with Spark's."""
    out = rows[..., :1] * matrix[0]
    for i in range(1, len(matrix)):
        out = out + rows[..., i : i + 1] * matrix[i]
    return out


def _moved(state: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """``state[i, ..]`` carried from language i to each j."""
    out = state[0] * moves[0].reshape(-1, *[1] * (state.ndim - 1))
    for i in range(1, len(moves)):
        out += state[i] * moves[i].reshape(-1, *[1] * (state.ndim - 1))
    return out


def expected_words(likely: np.ndarray, ends: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Per text, the expected number of words of each language, by forward-backward.

    ``likely[j, w]``: the factor of word w for language j, 1 for the likeliest. Text i has words
    ``ends[i]`` to ``ends[i + 1]``. Texts are cut into blocks whose products are taken side by side,
    so that a long text takes as many steps as its blocks; nothing is lost by it.
    """
    k, n = len(likely), np.diff(ends)
    if not likely.shape[1]:
        return np.zeros((len(n), k))
    blocks = -(-n // BLOCK)
    start = np.cumsum(blocks) - blocks
    text = np.repeat(np.arange(len(n)), blocks)
    first = ends[:-1][text] + (np.arange(len(text)) - start[text]) * BLOCK
    size = np.minimum(BLOCK, ends[1:][text] - first)
    # Longest blocks first, so that those with a t-th word are the first so many; words by t.
    order = np.argsort(-size, kind="stable")
    place = np.argsort(order, kind="stable")
    wide = np.searchsorted(-size[order], -np.arange(size.max()), "left")  # blocks with more than t words
    offset = np.concatenate([[0], np.cumsum(wide)])
    t = np.arange(likely.shape[1]) - np.repeat(first, size)
    at = offset[t] + np.repeat(place, size)
    by_step = np.empty_like(likely)
    by_step[:, at] = likely
    steps = [(int(a), slice(int(o), int(o + a)), i % 8 == 7) for i, (a, o) in enumerate(zip(wide, offset))]

    into, after = np.full((k, len(order)), 1 / k), np.full((k, len(order)), 1 / k)
    if blocks.max() > 1:
        # What a block does to any state: through[j, i] is how language i before it leads to j at its
        # end. Blocks that are a whole text need none.
        some = np.sort(place[blocks[text] > 1])
        through = np.zeros((k, k, len(some)))
        through[np.arange(k), np.arange(k)] = 1
        for a, words, _ in steps:
            m = int(np.searchsorted(some, a))
            step = _moved(through[:, :, :m], moves) * by_step[:, words][:, None, some[:m]]
            through[:, :, :m] = step / step.sum(axis=(0, 1))
        inner = np.full(len(order), -1)
        inner[some] = np.arange(len(some))
        for b in range(1, int(blocks.max())):
            long = np.flatnonzero(blocks > b)
            here, before = place[start[long] + b], place[start[long] + b - 1]
            came = (through[:, :, inner[before]] * into[:, before]).sum(axis=1)
            into[:, here] = came / came.sum(axis=0)
        for b in range(int(blocks.max()) - 1, 0, -1):
            long = np.flatnonzero(blocks > b)
            here, before = place[start[long] + b], place[start[long] + b - 1]
            goes = (through[:, :, inner[here]] * after[:, None, here]).sum(axis=0)
            after[:, before] = goes / goes.sum(axis=0)

    forward = np.empty_like(likely)
    for a, words, scale in steps:
        step = _moved(into[:, :a], moves) * by_step[:, words]
        if scale:
            step /= step.sum(axis=0)
        into[:, :a] = forward[:, words] = step
    for a, words, scale in reversed(steps):
        forward[:, words] *= after[:, :a]
        step = _moved(by_step[:, words] * after[:, :a], moves.T)
        if scale:
            step /= step.sum(axis=0)
        after[:, :a] = step
    forward /= forward.sum(axis=0)
    of = np.empty(likely.shape[1], dtype=np.int64)
    of[at] = np.repeat(np.arange(len(n)), n)
    return np.stack([np.bincount(of, weights=forward[j], minlength=len(n)) for j in range(k)], axis=1)


def chain_expectations(likely: np.ndarray, real: np.ndarray, moves: np.ndarray):
    """(log of the sum over all labellings, chances per word, expected moves) of sequences side by
    side, ``likely[t, s]`` the factors of the t-th word of sequence s, ``real`` where there is one."""
    steps, many, k = likely.shape
    forward, log = np.empty_like(likely), 0.0
    state = np.full((many, k), 1 / k)
    for t in range(steps):
        step = _times(state, moves) * likely[t]
        total = step.sum(axis=1, keepdims=True)
        state = np.where(real[t][:, None], step / total, state)
        log += np.log(total[real[t]]).sum()
        forward[t] = state
    chance, moved = np.zeros_like(likely), np.zeros((k, k))
    back = np.full((many, k), 1 / k)
    for t in range(steps - 1, -1, -1):
        before = forward[t - 1] if t else np.full((many, k), 1 / k)
        both = forward[t] * back
        chance[t] = np.where(real[t][:, None], both / both.sum(axis=1, keepdims=True), 0)
        ahead = likely[t] * back
        pair = before[:, :, None] * moves * ahead[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        moved += pair[real[t]].sum(axis=0)
        step = _times(ahead, moves.T)
        back = np.where(real[t][:, None], step / step.sum(axis=1, keepdims=True), back)
    return log, chance, moved


def fit(rule: Rule, spans: list[tuple[str, str]], languages: list[str], lexicon: np.ndarray, shares: np.ndarray) -> Field:
    """The field of most likelihood, with a penalty, by Adam. ``spans``: (language, words in a text);
    ``shares[i]``: how lexicon word i spreads over the languages."""
    rng, k = np.random.default_rng(7), len(languages)
    number = {x: i for i, x in enumerate(languages)}
    order = rng.permutation(len(spans))
    part = next(slices(pa.array([spans[i][1] for i in order], pa.large_string()), parts=True)) if len(spans) else None
    label = np.array([number[spans[i][0]] for i in order], dtype=np.int64)
    empty = Field(languages, np.zeros((rule.buckets, k)), np.full((k, k), 1 / k), lexicon, np.zeros_like(shares))
    if part is None or not len(which := _wordlike(part)):
        return empty
    # Pieces of random length, a few to a sequence: languages change within it.
    span = part.doc[which]
    nth = np.arange(len(which)) - np.searchsorted(span, span, "left")
    inside = nth < rng.integers(4, rule.span + 1, len(spans))[span]
    which, span, gold = which[inside], span[inside], label[span[inside]]
    chain = span // 4
    t = np.arange(len(chain)) - np.searchsorted(chain, chain, "left")
    steps, many = int(t.max()) + 1, int(chain.max()) + 1
    real = np.zeros((steps, many), dtype=bool)
    real[t, chain] = True

    # Features as (word, bucket, value), buckets of the lexicon's shares behind the others.
    word, bucket, value, at = [], [], [], 0
    for some, data, starts, stops in _each(part, which):
        me, size = at + np.arange(len(some)), stops - starts
        affix = _affixes(data, starts, stops, rule.buckets)
        word.append(np.repeat(me, affix.shape[1])), bucket.append(affix.ravel()), value.append(np.ones(affix.size))
        for gram, n in zip(_grams(data, rule.buckets), (2, 3)):
            many_of = np.maximum(size - n + 1, 0)
            inner = np.arange(many_of.sum()) - np.repeat(np.cumsum(many_of) - many_of, many_of)
            word.append(np.repeat(me, many_of)), bucket.append(gram[np.repeat(starts, many_of) + inner])
            value.append(np.repeat(GRAMS / np.maximum(1, 2 * size - 3 + (size < 3)), many_of))
        at += len(some)
    word, bucket, value = np.concatenate(word), np.concatenate(bucket), np.concatenate(value)
    by_word = np.argsort(word, kind="stable")
    word, bucket, value = word[by_word], bucket[by_word], value[by_word]
    begins = np.searchsorted(word, np.arange(len(which)))
    share = np.zeros((len(which), k))
    if len(lexicon):
        place = np.minimum(np.searchsorted(lexicon, part.hashes[which]), len(lexicon) - 1)
        share = np.where((lexicon[place] == part.hashes[which])[:, None], shares[place], 0)

    goal = np.zeros((len(which), k))
    goal[np.arange(len(which)), gold] = 1
    follows = t > 0
    gold_moves = np.zeros((k, k))
    np.add.at(gold_moves, (gold[np.flatnonzero(follows) - 1], gold[follows]), 1)
    x = [np.zeros((rule.buckets, k)), np.zeros((k, k)), np.zeros((k, k))]  # buckets, shares, moves
    first, second = [np.zeros_like(p) for p in x], [np.zeros_like(p) for p in x]
    likely = np.ones((steps, many, k))
    for turn in range(1, rule.steps + 1):
        score = np.add.reduceat(x[0][bucket] * value[:, None], begins, axis=0) + _times(share, x[1])
        likely[t, chain] = np.exp(score - score.max(axis=1, keepdims=True))
        moves = np.exp(x[2])
        _, chance, moved = chain_expectations(likely, real, moves)
        miss = goal - chance[t, chain]
        # What comes before a sequence's first word is any language: the expectation of that move
        # stands on both sides of the difference.
        begin = np.flatnonzero(~follows)
        came = moves[:, gold[begin]] / moves[:, gold[begin]].sum(axis=0)
        from_any = np.stack([np.bincount(gold[begin], weights=came[i], minlength=k) for i in range(k)])
        step = [
            np.stack([np.bincount(bucket, weights=value * miss[word, j], minlength=rule.buckets) for j in range(k)], axis=1),
            np.stack([(share * miss[:, j : j + 1]).sum(axis=0) for j in range(k)], axis=1),
            gold_moves + from_any - moved,
        ]
        for i, g in enumerate(step):
            g = g / len(which) - rule.penalty * x[i]
            first[i], second[i] = 0.9 * first[i] + 0.1 * g, 0.99 * second[i] + 0.01 * g * g
            x[i] = x[i] + 0.1 * (first[i] / (1 - 0.9**turn)) / (np.sqrt(second[i] / (1 - 0.99**turn)) + 1e-6)
    moves = np.exp(x[2] - x[2].max())
    return Field(languages, x[0].astype(np.float32), moves, lexicon, _times(shares, x[1]) if len(lexicon) else shares)


def _language_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (word, lang, n): words as hashes, each once per language for some texts."""
    held: dict[str, list[np.ndarray]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, some in held.items():
            words, n = np.unique(np.concatenate(some), return_counts=True)
            columns = [pa.array(words.view(np.int64)), pa.array([lang] * len(words), pa.string()), pa.array(n)]
            yield pa.record_batch(columns, names=["word", "lang", "n"])
        held.clear()

    size = 0
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        for part in slices(batch.column(1), parts=True):
            which = _wordlike(part)
            lang = langs[part.first + part.doc[which]]
            for one in set(lang):
                held.setdefault(one, []).append(part.hashes[which[lang == one]])
            size += len(which)
            if size > 4 * HELD:
                yield from out()
                size = 0
    yield from out()


def lexicon_of(rule: Rule, training: DataFrame, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(words as sorted hashes, their shares of the languages): the ``rule.lexicon`` most frequent
    words of each language, by counts over all of ``training`` (lang, text)."""
    spark = training.sparkSession
    counts = training.select("lang", "text").mapInArrow(sparing(_language_counts), "word long, lang string, n long")
    with batches_of(spark, BATCH_BYTES):
        counts = written(counts.groupBy("word", "lang").agg(F.sum("n").alias("n")), "language-words")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= rule.lexicon).select("word").distinct()
    # So many words per language at most.
    rows = counts.join(F.broadcast(top), "word").toPandas()
    total = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    words, place = np.unique(rows["word"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
    share = np.zeros((len(words), len(languages)))
    number = {x: i for i, x in enumerate(languages)}
    share[place, rows["lang"].map(number).to_numpy(int)] = rows["n"].to_numpy(float) / rows["lang"].map(total).to_numpy(float)
    return words, share / np.maximum(share.sum(axis=1, keepdims=True), 1e-300)


def _spans(rule: Rule):
    """(lang, text) to (lang, words): spans at even distances, as texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, words = [], []
            for part in slices(batch.column(1), parts=True):
                which = _wordlike(part)
                data = part.data.tobytes()
                for i in range(part.n):
                    mine = which[np.searchsorted(part.doc[which], i) : np.searchsorted(part.doc[which], i, "right")]
                    spans = min(rule.spans, -(-len(mine) // rule.span))
                    for at in np.linspace(0, max(0, len(mine) - rule.span), spans).astype(int):
                        some = mine[at : at + rule.span]
                        lang.append(batch.column(0)[part.first + i].as_py())
                        words.append(b" ".join(data[part.starts[w] : part.stops[w]] for w in some).decode())
            yield pa.record_batch([pa.array(lang, pa.string()), pa.array(words, pa.string())], names=["lang", "words"])

    return sparing(run)


def learn(rule: Rule, docs: DataFrame) -> Field | None:
    """The field, from the rows that are not held out and have a language; None without any."""
    training = docs.where("not held_out and lang is not null and text is not null")
    n = {r["lang"]: r["count"] for r in training.groupBy("lang").count().collect()}
    languages = sorted(n)
    if not languages:
        return None
    lexicon, shares = lexicon_of(rule, training, languages)
    # About twice the rows wanted, by a hash, and of these the first by it.
    share = F.coalesce(*[F.when(F.col("lang") == x, F.lit(2.0 * rule.sample / n[x])) for x in languages])
    key = F.xxhash64("doc_id", "text")
    some = training.select("lang", "text", key.alias("key")).where(F.pmod("key", F.lit(1 << 30)) < share * float(1 << 30) + 1)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    some = some.withColumn("rank", rank).where(F.col("rank") <= rule.sample)
    with batches_of(docs.sparkSession, BATCH_BYTES):
        spans = some.select("lang", "text").mapInArrow(_spans(rule), "lang string, words string").toPandas()
    rows = sorted(zip(spans["lang"], spans["words"]))
    return fit(rule, rows, languages, lexicon, shares)


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = model.value
        for batch in batches:
            for part in slices(batch.column(2), parts=True):
                which = _wordlike(part)
                ends = np.searchsorted(part.doc[which], np.arange(part.n + 1))
                words = expected_words(factors(field, part, which), ends, field.moves)
                texts = batch.column(2).slice(part.first, part.n)
                letters = np.array([any(map(str.isalpha, t.as_py() or "")) for t in texts], dtype=bool)
                letters &= np.diff(ends) > 0
                best = words.argmax(axis=1)
                score = np.where(letters, words[np.arange(part.n), best] / np.maximum(np.diff(ends), 1), 0.0)
                said = [field.languages[b] if has else UNKNOWN for b, has in zip(best, letters)]
                columns = [
                    batch.column(0).slice(part.first, part.n),
                    batch.column(1).slice(part.first, part.n),
                    pa.array(said, pa.string()),
                    pa.array(np.minimum(score, 1.0)),
                ]
                yield pa.record_batch(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    return sparing(run)


def languages(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs`` (doc_id, text, lang; more
    columns are ignored).

    ``lang_pred`` is one of the languages of the rows learnt from, or ``und`` where the text is NULL
    or has no letter, or where nothing could be learnt; the score is 0 then. A text of one language
    as well as a code-switched one gets the language of most of its words; equals go to the first
    by name. A NULL doc_id is an empty text to the hash that holds rows out. Repeated rows come back
    one by one; an empty table gives no rows. The texts' languages must be few: the field's work is
    by their square.
    """
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(rule.folds)) == rule.held
    docs = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"), held.alias("held_out")
    )
    field = learn(rule, docs)
    rows = docs.select("doc_id", "held_out", "text")
    if field is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    model = docs.sparkSession.sparkContext.broadcast(field)
    said = rows.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")
    # Worked out here, as the size of batches is a setting of the session: some twenty bytes a text.
    with batches_of(docs.sparkSession, BATCH_BYTES):
        return written(said, "languages")
