"""Toxicity as ordered grades: cumulative-link regression on sparse text features.

One weight vector is shared by all thresholds: P(grade <= j) = logistic(theta_j - w x). Features
are word parts and their first bytes, as hashes; those that mark toxic texts are chosen by document
counts that Spark adds up over the sample of labelled texts. Features that mark clean texts are
left out: they mostly tell how long a text is, and would let a long text hide an insult.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from stocktrail.llm.words import U64, Slice, slices, sparing

#: A filter in front of the look-up of features: that many flags.
FLAGS = 1 << 18
SAID = [
    T.StructField("severity", T.DoubleType()),
    T.StructField("p_toxic", T.DoubleType()),
    T.StructField("grade", T.LongType()),
]


@dataclass(frozen=True)
class Rule:
    """``sample`` labelled texts at most are fitted on; ``features`` at most, each with a z-score
    of ``least_z`` and a share of toxic texts, among those that have it, of ``least_share`` or more; toxic texts are
    graded 1 to ``grades`` by how much of these they hold."""

    sample: int = 20_000
    features: int = 4096
    least_z: float = 4.0
    least_share: float = 0.75
    prefixes: tuple[int, ...] = (4, 5, 6)
    grades: int = 3
    penalty: float = 1e-6
    steps: int = 400


@dataclass(frozen=True)
class Fitted:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray
    reject_at: float  # chance of grade 1 or more from which a text is rejected


def _occurrences(rule: Rule, part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every occurrence in a slice."""
    texts, features = [part.doc], [part.hashes]
    for length in rule.prefixes:
        longer, hashes = part.prefix(length)
        texts.append(part.doc[longer])
        features.append(hashes)
    return np.concatenate(texts), np.concatenate(features)


def _document_counts(rule: Rule):
    """(text, toxic) to (feature, toxic texts with it, clean texts with it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.array(batch.column(1).to_pylist(), dtype=bool)
            for part in slices(batch.column(0), parts=True):
                text, feature = _occurrences(rule, part)
                order = np.lexsort((text, feature))
                text, feature = text[order], feature[order]
                new = np.ones(len(text), dtype=bool)
                new[1:] = (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])
                text, feature = text[new], feature[new]
                if not len(feature):
                    continue
                each, start = np.unique(feature, return_index=True)
                bad = np.add.reduceat(toxic[part.first + text].astype(np.int64), start)
                n = np.diff(np.append(start, len(feature)))
                columns = [pa.array(each.view(np.int64)), pa.array(bad), pa.array(n - bad)]
                yield pa.record_batch(columns, names=["feature", "toxic", "clean"])

    return run


def _vectors(rule: Rule, batch_texts, known: np.ndarray):
    """Per slice: (slice, text, index of the feature, times) of the known features in it."""
    flags = np.zeros(FLAGS, dtype=bool)
    flags[(known & U64(FLAGS - 1)).astype(np.int64)] = True
    for part in slices(batch_texts, parts=True):
        text, feature = _occurrences(rule, part)
        hit = flags[(feature & U64(FLAGS - 1)).astype(np.int64)]
        text, feature = text[hit], feature[hit]
        if len(known):
            at = np.minimum(np.searchsorted(known, feature), len(known) - 1)
            same = known[at] == feature
            pair, times = np.unique(text[same] * len(known) + at[same], return_counts=True)
            yield part, pair // len(known), pair % len(known), times
        else:
            none = np.zeros(0, dtype=np.int64)
            yield part, none, none, none


def _sample_vectors(rule: Rule, features):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, text, at, times in _vectors(rule, batch.column(0), features.value):
                ends = np.searchsorted(text, np.arange(part.n + 1)).astype(np.int32)
                columns = [
                    batch.column(1).slice(part.first, part.n),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(at.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int32))),
                ]
                yield pa.record_batch(columns, names=["toxic", "at", "times"])

    return run


def fit_cumulative_link(
    rows: np.ndarray, at: np.ndarray, value: np.ndarray, grade: np.ndarray, features: int, rule: Rule
) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of least penalised log loss, by Adam on all rows at once. No weight is
    negative: a word and its own beginnings would else offset each other.

    Row ``rows[i]`` has ``value[i]`` at feature ``at[i]``. The thresholds stay in order as a first
    one and positive steps.
    """
    n, j = len(grade), int(grade.max())
    share = np.array([np.mean(grade <= k) for k in range(j)])
    theta = np.log(share / (1 - share))
    x = np.concatenate([np.zeros(features), theta[:1], np.log(np.maximum(np.diff(theta), 0.05))])
    m, v = np.zeros_like(x), np.zeros_like(x)
    logistic = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    upper, lower = np.minimum(grade, j - 1), np.maximum(grade - 1, 0)
    for step in range(1, rule.steps + 1):
        w, steps = x[:features], np.exp(x[features + 1 :])
        theta = x[features] + np.concatenate([[0.0], np.cumsum(steps)])
        score = np.bincount(rows, weights=w[at] * value, minlength=n)
        # P(grade) = logistic(theta_grade - score) - logistic(theta_(grade - 1) - score)
        up = np.where(grade == j, 1.0, logistic(theta[upper] - score))
        down = np.where(grade == 0, 0.0, logistic(theta[lower] - score))
        p = np.maximum(up - down, 1e-9)
        d_up, d_down = up * (1 - up) / p, down * (1 - down) / p
        to_score = (d_up - d_down) / n
        to_theta = np.bincount(upper, -d_up / n * (grade < j), j) + np.bincount(lower, d_down / n * (grade > 0), j)
        tails = np.cumsum(to_theta[::-1])[::-1]
        gradient = np.concatenate(
            [np.bincount(at, weights=to_score[rows] * value, minlength=features) + rule.penalty * w, tails[:1], tails[1:] * steps]
        )
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        x = x - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        x[:features] = np.maximum(x[:features], 0)
    return x[:features], x[features] + np.concatenate([[0.0], np.cumsum(np.exp(x[features + 1 :]))])


def fit(docs: DataFrame, labels: DataFrame, rule: Rule) -> Fitted | None:
    """The model from a bounded sample of labelled texts, None where it has not both kinds."""
    spark = docs.sparkSession
    chosen = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rule.sample)
    )
    # ``rule.sample`` rows of a number and a flag at most, so no text moves.
    texts = docs.join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    kinds = texts.groupBy("toxic").count().collect()
    n = {bool(k): c for k, c in kinds}
    if len(n) < 2:
        return None
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(t / (n[True] - F.col("toxic") + 0.5)) - F.log(c / (n[False] - F.col("clean") + 0.5))
    ranked = (
        texts.mapInArrow(_document_counts(rule), "feature long, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .withColumn("z", odds / F.sqrt(1 / t + 1 / c))
        .where((F.col("z") >= rule.least_z) & (t / (t + c) >= rule.least_share))
        .orderBy(F.desc("z"), "feature")
        .limit(rule.features)
        .collect()
    )
    features = np.array(sorted(r["feature"] % 2**64 for r in ranked), dtype=np.uint64)
    if not len(features):
        return None
    shape = "toxic boolean, at array<int>, times array<int>"
    known = spark.sparkContext.broadcast(features)
    sample = texts.mapInArrow(_sample_vectors(rule, known), shape).toPandas()
    sizes = sample["at"].map(len).to_numpy()
    rows = np.repeat(np.arange(len(sample)), sizes)
    at = np.concatenate(sample["at"].tolist()).astype(np.int64)
    value = np.log1p(np.concatenate(sample["times"].tolist()).astype(float))
    marks = np.bincount(rows, weights=value, minlength=len(sample))
    toxic = sample["toxic"].to_numpy(dtype=bool)
    edges = np.quantile(marks[toxic], np.arange(1, rule.grades) / rule.grades)
    grade = np.where(toxic, 1 + np.searchsorted(edges, marks), 0)
    weights, thresholds = fit_cumulative_link(rows, at, value, grade, len(features), rule)
    score = np.bincount(rows, weights=weights[at] * value, minlength=len(sample))
    return Fitted(features, weights, thresholds, chance_above(thresholds[0], best_cut(score, toxic)))


def chance_above(threshold: float, score: float) -> float:
    return float(1 / (1 + np.exp(np.clip(threshold - score, -40, 40))))


def best_cut(score: np.ndarray, toxic: np.ndarray) -> float:
    """The score that parts the sample's toxic from its clean texts with the fewest errors, in the
    middle between its neighbours; of equal ones the highest."""
    levels, which = np.unique(score, return_inverse=True)
    bad = np.bincount(which, weights=toxic, minlength=len(levels))
    good = np.bincount(which, weights=~toxic, minlength=len(levels))
    # Errors if all from level k on are rejected; none, at the end.
    errors = np.append(np.cumsum(good[::-1])[::-1], 0) + np.concatenate([[0], np.cumsum(bad)])
    k = len(errors) - 1 - int(errors[::-1].argmin())
    if k == 0:
        return float(levels[0])
    return float((levels[k - 1] + levels[k]) / 2) if k < len(levels) else float(levels[-1] + 1)


def _predict(rule: Rule, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for batch in batches:
            row = batch.column(0)
            texts = row.flatten()[row.type.get_field_index("text")]
            for part, text, at, times in _vectors(rule, texts, fitted.features):
                score = np.bincount(text, weights=np.log1p(times) * fitted.weights[at], minlength=part.n)
                above = 1 / (1 + np.exp(np.clip(fitted.thresholds[None, :] - score[:, None], -40, 40)))
                below = 1 - np.concatenate([above, np.zeros((part.n, 1))], axis=1)
                chance = np.diff(np.concatenate([np.zeros((part.n, 1)), below], axis=1), axis=1)
                columns = [
                    row.slice(part.first, part.n),
                    pa.array(above.sum(axis=1)),
                    pa.array(above[:, 0].copy()),
                    pa.array(chance.argmax(axis=1).astype(np.int64)),
                ]
                yield pa.record_batch(columns, names=["row", "severity", "p_toxic", "grade"])

    return sparing(run)


def graded(docs: DataFrame, labels: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(row, severity, p_toxic, grade, kept): each row of ``docs`` as it is, in a struct, so that
    no column's name can clash, next to what the model says of its text. Nothing is shuffled."""
    labels = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    fitted = fit(texts, labels, rule)
    rows = docs.withColumn("text", F.col("text").cast("string")).select(F.struct("*").alias("row"))
    if fitted is None:
        zero = F.lit(0.0)
        out = rows.select("row", zero.alias("severity"), zero.alias("p_toxic"), F.lit(0).cast("long").alias("grade"))
    else:
        model = docs.sparkSession.sparkContext.broadcast(fitted)
        shape = T.StructType([*rows.schema.fields, *SAID])
        out = rows.mapInArrow(_predict(rule, model), shape)
    return out.withColumn("kept", F.col("p_toxic") < (fitted.reject_at if fitted else 1.0))


def toxicity(docs: DataFrame, labels: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, severity, p_toxic, grade, kept) for every row of ``docs``.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic (0 or 1); further columns are
    ignored. ``severity`` is the expected grade, from 0 to ``grades``. NULL or empty text has no
    features and gets the severity of such. A doc_id labelled more than once is toxic if any
    label says so; labels without doc_id or value are passed over. Without toxic and clean
    labelled texts, or without telling features, nothing is known: severity 0, all kept. Repeated
    rows come back one by one, and an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return graded(docs, labels, rule).select("row.doc_id", "severity", "p_toxic", "grade", "kept")
