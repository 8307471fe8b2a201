"""Mixing sources to target weights by Sainte-Lague apportionment, on DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stocktrail.session import written

WORD = r"[^\x20\x09-\x0D]+"


def seeded(*parts) -> Column:
    """A number of 60 bits from the text of ``parts``; any engine with MD5 gets the same."""
    text = F.concat_ws(":", *[F.coalesce(F.col(p).cast("string"), F.lit("-")) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def water_levels(sources: DataFrame, share: float, weights: list[int], most: float) -> DataFrame:
    """``target`` of each source: ``share`` of all sizes by weight, at most ``most`` sizes each.

    Weights repeat over the sources by code point, NULL last. What the full ones cannot take is
    shared again by weight until none is above: all targets are least(most * size, level * weight)
    for one level, found among the sources in the order in which they fill up.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))).cast("int") + 1)
    full = F.col("source_size") * F.lit(float(most))
    every = Window.partitionBy(F.lit(0))
    by_fill = Window.orderBy((F.col("full") / F.col("weight")), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(0, Window.unboundedFollowing)
    return (
        sources.withColumn("weight", weight)
        .withColumn("full", full)
        .withColumn("all", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn(
            "level",
            (F.col("all") - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
            / F.sum("weight").over(onward),
        )
        .withColumn("target", F.least("full", F.max("level").over(every) * F.col("weight")))
        .drop("weight", "full", "all", "level")
    )


def apportion(parties: DataFrame, group: list[str], tie: list[str]) -> DataFrame:
    """Add ``seats``: the ``house`` of each group dealt to its parties by highest quotients
    ``votes / (2 k + 1)``, none above its ``most``; ties go by the columns of ``tie``.

    Seats that any near divisor gives are given at once, and quotients are ranked only around
    them: about two rows per party, not one per seat.
    """
    all_of = Window.partitionBy(*(group or [F.lit(0)]))
    near = lambda side: F.floor(
        F.col("votes") * (F.col("house") + side * F.col("parties") / 2.0) / F.col("cast") + 0.5
    )
    sure = F.when(F.col("cast") > 0, F.least("most", F.greatest(F.lit(0), near(-1)))).otherwise(0)
    up_to = F.when(F.col("cast") > 0, F.least("most", near(1) + 1)).otherwise(0)
    given = (
        parties.withColumn("cast", F.sum("votes").over(all_of))
        .withColumn("parties", F.count("*").over(all_of))
        .withColumn("sure", sure.cast("long"))
        .withColumn("up_to", up_to.cast("long"))
        .withColumn("left", F.col("house") - F.sum("sure").over(all_of))
    )
    rank = F.row_number().over(
        Window.partitionBy(*(group or [F.lit(0)])).orderBy(
            F.desc("quotient"), *[F.col(c).asc_nulls_last() for c in tie], "k"
        )
    )
    key = list(dict.fromkeys([*group, *tie]))
    won = (
        given.where("up_to > sure")
        .select(*key, "votes", "left", F.explode(F.sequence("sure", F.col("up_to") - 1)).alias("k"))
        .withColumn("quotient", F.col("votes") / (2 * F.col("k") + 1))
        .withColumn("rank", rank)
        .where("rank <= left")
        .groupBy(*key)
        .agg(F.count("*").alias("more"))
    )
    g, w = given.alias("g"), won.alias("w")
    same = None
    for c in key:
        one = F.col(f"g.{c}").eqNullSafe(F.col(f"w.{c}"))
        same = one if same is None else same & one
    return g.join(w, same, "left").select(
        *[f"g.{c}" for c in parties.columns],
        (F.col("g.sure") + F.coalesce(F.col("w.more"), F.lit(0))).alias("seats"),
    )


def _placed(docs: DataFrame, share: float, weights: tuple[int, ...], most: int, block: int, shard_rows: int, seed: int, whole: bool) -> DataFrame:
    """Rows with (doc_id, source, size, source_size, target, passes, and in words the spans
    from_1 .. to_1 and from_2 .. to_2 taken beyond whole passes); with ``row``, all columns of
    ``docs`` in a struct, if ``whole``."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        size.alias("size"),
        *([F.struct("*").alias("row")] if whole else []),
    )
    sizes = written(rows.select("doc_id", "source", "size"), "mix-sizes")
    rows = rows if whole else sizes
    carried = ["row"] if whole else []
    sources = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("rows")
    )
    sources = written(
        water_levels(sources, share, list(weights), most).withColumn(
            "shards", F.ceil(F.col("rows") / shard_rows).cast("long")
        ),
        "mix-sources",
    )
    shards_of = sources.select("source", "shards").alias("s")

    def dealt(table: DataFrame) -> DataFrame:
        return (
            table.alias("d")
            .join(shards_of, F.col("d.source").eqNullSafe(F.col("s.source")))
            .select("d.*", F.pmod(seeded(F.lit(f"{seed}:shard"), "doc_id", "size"), F.col("shards")).alias("shard"))
        )

    shards = dealt(sizes).groupBy("source", "shard").agg(F.sum("size").alias("words")).withColumn(
        "blocks",
        F.when(F.col("words") > 0, F.greatest(F.lit(1), F.round(F.col("words") / block))).otherwise(0).cast("long"),
    )
    shards = written(shards, "mix-shards")
    blocks = shards.groupBy("source").agg(F.sum("blocks").alias("blocks"))
    every = Window.partitionBy(F.lit(0))
    parties = (
        sources.alias("s")
        .join(blocks.alias("b"), F.col("s.source").eqNullSafe(F.col("b.source")))
        .select(
            "s.source",
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.col("blocks"))
            .otherwise(0.0)
            .alias("votes"),
            (F.col("blocks") * most).alias("most"),
        )
        .withColumn("house", F.round(F.sum("votes").over(every)).cast("long"))
    )
    seats = apportion(parties, [], ["source"])
    parties = (
        shards.alias("h")
        .join(seats.alias("s"), F.col("h.source").eqNullSafe(F.col("s.source")))
        .select(
            "h.source",
            "h.shard",
            "words",
            "blocks",
            F.col("blocks").cast("double").alias("votes"),
            (F.col("blocks") * most).alias("most"),
            F.col("seats").alias("house"),
        )
    )
    quotas = written(
        apportion(parties, ["source"], ["shard"])
        .where("blocks > 0")
        .withColumn("from_block", F.pmod(seeded(F.lit(f"{seed}:turn"), "source", "shard"), F.col("blocks")))
        .select(
            "source",
            "shard",
            "words",
            "blocks",
            F.expr("seats div blocks").alias("passes"),
            "from_block",
            F.expr("from_block + seats % blocks").alias("to_block"),
        ),
        "mix-quotas",
    )
    in_shard = Window.partitionBy("source", "shard").orderBy("turn", "doc_id", "size")
    placed = (
        dealt(rows).withColumn("turn", seeded(F.lit(f"{seed}:turn"), "doc_id", "size"))
        .withColumn("stop", F.sum("size").over(in_shard.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("start", F.col("stop") - F.col("size"))
    )
    edge = lambda at: f"({at}) * words div blocks"
    spans = []
    for i, (a, b) in enumerate([("from_block", "least(to_block, blocks)"), ("0L", "greatest(to_block - blocks, 0L)")], 1):
        begin = f"coalesce(least(greatest({edge(a)} - start, 0L), size), 0L)"
        end = f"coalesce(least(greatest({edge(b)} - start, 0L), size), 0L)"
        spans += [F.expr(begin).alias(f"from_{i}"), F.expr(f"greatest({begin}, {end})").alias(f"to_{i}")]
    p, q, s = placed.alias("p"), quotas.alias("q"), sources.alias("s")
    return (
        p.join(q, F.col("p.source").eqNullSafe(F.col("q.source")) & (F.col("p.shard") == F.col("q.shard")), "left")
        .join(s, F.col("p.source").eqNullSafe(F.col("s.source")))
        .select(
            "p.doc_id",
            "p.source",
            "size",
            "source_size",
            "target",
            F.coalesce("passes", F.lit(0)).cast("long").alias("passes"),
            *spans,
            *carried,
        )
    )


def mix(
    docs: DataFrame,
    share: float = 1.5,
    weights: tuple[int, ...] = (5, 2, 1),
    most: int = 2,
    block: int = 64,
    shard_rows: int = 4096,
    seed: int = 17,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of ``docs``.

    ``docs`` has doc_id, text, source; further columns are ignored. ``size`` is the number of
    words; NULL text has none. A source's documents are dealt to shards of about ``shard_rows``
    rows, each in seeded order; a shard's words are cut into equal blocks of about ``block``. The
    blocks of the mix are apportioned to sources, then each source's to its shards; a shard takes
    whole passes over its blocks and, for the rest, the run of blocks from a seeded one on. So
    no document is taken more than ``most`` times, reruns agree, and a source with a third of all
    rows is as many shards as its rows ask for. ``taken`` counts words, repeats included.

    A NULL source is a source. Rows that repeat a doc_id, or have none, are mixed one by one. An
    empty table gives no rows; empty texts are taken zero words.
    """
    return _placed(docs, share, weights, most, block, shard_rows, seed, False).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.expr("size * passes + to_1 - from_1 + to_2 - from_2").alias("taken"),
    )


def mixed(
    docs: DataFrame,
    share: float = 1.5,
    weights: tuple[int, ...] = (5, 2, 1),
    most: int = 2,
    block: int = 64,
    shard_rows: int = 4096,
    seed: int = 17,
) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row per whole pass over a document, and one
    per span of its words that the mix takes beyond those, white space between them as it was.
    ``n_chars``, if there, follows the text. Texts move once, by source and shard."""
    placed = _placed(docs, share, weights, most, block, shard_rows, seed, True)
    # Words with the white space behind them.
    words = r"split(regexp_replace(row.text, r'^[\x20\x09-\x0D]+', ''), r'(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])')"
    cut = lambda i: (
        f"if(to_{i} > from_{i}, array(regexp_replace(array_join(slice({words}, cast(from_{i} + 1 as int), "
        f"cast(to_{i} - from_{i} as int)), ''), r'[\x20\x09-\x0D]+$', '')), cast(array() as array<string>))"
    )
    texts = f"concat(array_repeat(row.text, cast(passes as int)), {cut(1)}, {cut(2)})"
    rows = placed.where("passes > 0 or to_1 > from_1 or to_2 > from_2").select("row", F.explode(F.expr(texts)).alias("taken"))
    replaced = {"text": F.col("taken"), "n_chars": F.length("taken").cast("long")}
    return rows.select(
        *[
            (replaced[c] if c in replaced else F.col(f"row.`{c}`")).cast(docs.schema[c].dataType).alias(c)
            for c in docs.columns
        ]
    )
