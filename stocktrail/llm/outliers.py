"""Quality rules by robust multivariate outliers, on DataFrame functions only.

Every document gets a few counts from its whole text and fixed base rules; of what passes, the
transformed counts of each language and source get a minimum-covariance-determinant estimate, and
documents too far from it by Mahalanobis distance are rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from stocktrail.session import written

SPACE = r"[\x20\x09-\x0D]+"


def text_counts(docs: DataFrame, *carried: str) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each whole text.

    A word is a run of characters outside ``\\x20 \\x09-\\x0D``. Repeated words are those in windows
    of five words that occur twice or more, each word counted once. All of it is sorting and
    hashing within a row's arrays: n log n in a text's length, no rows are made.
    """
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split("t", SPACE), "")
    d = docs.select(*carried, t.alias("t")).withColumn("words", F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size("words")
    d = d.withColumn("n_words", n.cast("long")).withColumn(
        "grams",
        F.expr(
            "if(n_words < 5, cast(array() as array<bigint>), transform(slice(words, 1, cast(n_words as int) - 4), "
            "(w, i) -> xxhash64(w, words[i + 1], words[i + 2], words[i + 3], words[i + 4])))"
        ),
    )
    # Windows sorted with their places; those like a neighbour repeat. An array of one binds a name.
    repeated = """
      if(size(array_distinct(grams)) = size(grams), 0L,
        transform(array(sort_array(transform(grams, (g, i) -> struct(g, i)))), s ->
          transform(array(sort_array(transform(
            filter(s, (x, j) -> coalesce(x.g = get(s, j - 1).g, false) or coalesce(x.g = get(s, j + 1).g, false)),
            x -> x.i))), p ->
            aggregate(transform(p, (x, j) -> cast(least(5, coalesce(get(p, j + 1) - x, 5)) as bigint)), 0L, (a, b) -> a + b)
          )[0])[0])
    """
    d = d.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return d.select(
        *carried,
        "n_words",
        (F.length("t") - F.regexp_count("t", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(repeated).alias("n_repeat_words"),
    )


#: Of the documents passing the base rules, these are the statistics; each with the least
#: deviation that counts as one, so that a statistic that most documents share (no symbols at
#: all, say) does not turn any other value into an outlier. They are small enough that, where all
#: others have none, symbols in one character of 17, a repeated line for every 7 words, and repeats
#: of a fifth of the words each pass the cutoff alone.
STATISTICS = {
    "v0": ("ln(1.0D + n_words)", 0.4),
    "v1": ("ln(word_chars / n_words)", 0.2),
    "v2": ("ln(1.0D + 200.0D * n_symbols / word_chars)", 0.5),
    "v3": ("ln(1.0D + 50.0D * n_dup_lines / n_words)", 0.4),
    "v4": ("ln(1.0D + 10.0D * n_repeat_words / n_words)", 0.2),
}
NAMES = list(STATISTICS)
D = len(NAMES)


@dataclass(frozen=True)
class Rule:
    """Share that an estimate covers; concentration steps; squared distance beyond which a
    document is rejected; least documents for an estimate of their own."""

    share: float = 0.75
    steps: int = 4
    #: Of a normal sample in five dimensions, one in 10,000 is farther (chi-square, 0.9999).
    cutoff: float = 25.745
    least: int = 60
    #: Makes the covariance of the middle 75 % of a normal sample in five dimensions unbiased.
    consistency: float = 1.41


def _quantiles(rows: DataFrame, value: str, width: float, shares: list[float], name: str) -> DataFrame:
    """Per cell, quantiles of ``value`` to within ``width``, from exact counts of bins."""
    bins = rows.groupBy("cell", F.floor(F.col(value) / width).alias("bin")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("cell").orderBy("bin")
    every = Window.partitionBy("cell")
    ranked = bins.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(every))
    return ranked.groupBy("cell").agg(
        *[
            F.min(F.when(F.col("upto") >= F.col("all") * share, (F.col("bin") + 1) * width)).alias(f"{name}{i}")
            for i, share in enumerate(shares)
        ]
    )


def _moments(rows: DataFrame, scale: float) -> DataFrame:
    """Per cell: means m_i and the lower triangle l_ij of the covariance's Cholesky factor."""
    pairs = [(i, j) for i in range(D) for j in range(i + 1)]
    out = rows.groupBy("cell").agg(
        F.count("*").alias("n"),
        *[F.avg(NAMES[i]).alias(f"m{i}") for i in range(D)],
        *[F.covar_pop(NAMES[i], NAMES[j]).alias(f"c{i}{j}") for i, j in pairs],
    )
    for i, j in pairs:
        c = F.col(f"c{i}{j}") * scale
        if i == j:
            c = c + STATISTICS[NAMES[i]][1] ** 2
        for k in range(j):
            c = c - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(c, F.lit(1e-12))) if i == j else c / F.col(f"l{j}{j}"))
    return out.select("cell", *[f"m{i}" for i in range(D)], *[f"l{i}{j}" for i, j in pairs])


def _distance(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Add ``distance``, the squared Mahalanobis distance, by forward substitution."""
    out = rows.join(estimate, "cell")
    total = F.lit(0.0)
    for i in range(D):
        z = F.col(NAMES[i]) - F.col(f"m{i}")
        for k in range(i):
            z = z - F.col(f"l{i}{k}") * F.col(f"z{k}")
        out = out.withColumn(f"z{i}", z / F.col(f"l{i}{i}"))
        total = total + F.col(f"z{i}") * F.col(f"z{i}")
    return out.withColumn("distance", total)


def _start(rows: DataFrame) -> DataFrame:
    """First estimate: medians, and quartile ranges as deviations, each statistic by itself."""
    out = None
    for i, name in enumerate(NAMES):
        q = _quantiles(rows, name, 1 / 64, [0.25, 0.5, 0.75], f"q{i}_")
        out = q if out is None else out.join(q, "cell")
    zero = F.lit(0.0)
    return out.select(
        "cell",
        *[F.col(f"q{i}_1").alias(f"m{i}") for i in range(D)],
        *[
            (F.greatest((F.col(f"q{i}_2") - F.col(f"q{i}_0")) / 1.349, F.lit(STATISTICS[NAMES[i]][1])) if i == j else zero).alias(f"l{i}{j}")
            for i in range(D)
            for j in range(i + 1)
        ],
    )


def estimates(rows: DataFrame, rule: Rule) -> DataFrame:
    """Minimum covariance determinant per cell: concentration steps, each the moments of the
    ``share`` of documents nearest by the last, from a robust start."""
    now = written(_start(rows), "mcd-start")
    for _ in range(rule.steps):
        far = _distance(rows, now).withColumn("spread", F.log(F.col("distance") + 1e-9))
        edge = _quantiles(far, "spread", 1 / 64, [rule.share], "edge")
        near = far.join(edge, "cell").where(F.floor(F.col("spread") * 64) < F.round(F.col("edge0") * 64))
        now = written(_moments(near.select("cell", *NAMES), rule.consistency), "mcd-step")
    return now


def quality(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance,
    kept) for every row of ``docs``.

    ``docs`` has doc_id, text, lang, source; further columns are ignored. NULL text has no words
    and fails the base rules: fewer than 10 words, or more than a fifth of them repeated. NULL
    languages and sources are values like any. A language and source with fewer than ``least``
    documents that pass is pooled with its language's others of that kind, these with all
    others; where even those are too few, nothing is rejected. Repeated rows come back one by
    one. An empty table gives no rows.
    """
    counts = written(
        text_counts(
            docs.select(
                F.col("doc_id").cast("long"),
                F.col("text"),
                F.col("lang").cast("string"),
                F.col("source").cast("string"),
            ),
            "doc_id",
            "lang",
            "source",
        ).withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")),
        "quality-counts",
    )
    fine = F.to_json(F.struct("lang", "source"))
    coarse = F.to_json(F.struct(F.col("lang").alias("all_of_lang")))
    rows = counts.where(~F.col("base_failed")).select(
        "doc_id",
        *counts.columns[3:],
        fine.alias("fine"),
        coarse.alias("coarse"),
        *[F.expr(e).alias(v) for v, (e, _) in STATISTICS.items()],
    )
    by_fine = rows.groupBy("fine", "coarse").agg(F.count("*").alias("n"))
    pooled = F.sum(F.when(F.col("n") < rule.least, F.col("n"))).over(Window.partitionBy("coarse"))
    cells = written(
        by_fine.withColumn("pooled", pooled)
        .withColumn(
            "cell",
            F.when(F.col("n") >= rule.least, F.col("fine"))
            .when(F.col("pooled") >= rule.least, F.col("coarse"))
            .otherwise(F.lit("all")),
        )
        .withColumn("judged", F.sum("n").over(Window.partitionBy("cell")) >= rule.least)
        .select("fine", "cell", "judged"),
        "mcd-cells",
    )
    rows = rows.join(cells, "fine")
    found = estimates(rows.where("judged").select("cell", *NAMES), rule)
    judged = _distance(rows.where("judged"), found)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    unjudged = rows.where(~F.col("judged")).withColumn("distance", F.lit(None).cast("double"))
    failed = counts.where("base_failed").withColumn("distance", F.lit(None).cast("double"))
    return (
        judged.select(*columns, "distance")
        .unionAll(unjudged.select(*columns, "distance"))
        .unionAll(failed.select(*columns, "distance"))
        .withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= rule.cutoff))
    )
