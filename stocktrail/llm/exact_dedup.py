"""Exact duplicates by a tree of merges of sorted digest runs, on DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stocktrail.session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What makes two rows copies: SHA-256, verified at every level by an independent hash and a length.
DIGEST = ["sha", "n_bytes", "proof"]


def folded(text) -> F.Column:
    """``text`` with A-Z as a-z and all else as it is, NULL as empty.

    ``lower`` does just that, and faster, where every character is one byte.
    """
    t = F.coalesce(text, F.lit(""))
    return F.when(F.length(t) == F.octet_length(t), F.lower(t)).otherwise(
        F.translate(t, UPPER, LOWER)
    )


def fingerprints(docs: DataFrame, runs: int) -> DataFrame:
    """One narrow row per document, written once: its number in that table tells rows apart
    that are alike in all else."""
    text = F.col("folded")
    rows = (
        docs.select(F.col("doc_id").cast("long"), folded(F.col("text").cast("string")).alias("folded"))
        .select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            F.unhex(F.sha2(text, 256)).alias("sha"),
            F.octet_length(text).alias("n_bytes"),
            F.xxhash64(text).alias("proof"),
        )
    )
    return written(rows, "fingerprints").withColumn(
        "run", F.pmod(F.xxhash64("doc_id", "row"), F.lit(runs))
    )


def merged_runs(prints: DataFrame, runs: int, fan: int, keep: str) -> list[DataFrame]:
    """Levels of the tree: one entry per run and digest, its best row and its number of rows.

    Level 0 has ``runs`` runs; each next one merges ``fan`` neighbours, down to a single run. All
    rows of a run and digest meet by a sort on them, after a partial aggregate, so a digest with a
    third of all rows is at most ``runs`` entries, spread over as many keys, from level 0 on.
    """
    best = F.max if keep == "largest" else F.min
    levels = [
        prints.groupBy("run", *DIGEST).agg(
            best(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("size")
        )
    ]
    while True:
        levels[-1] = written(levels[-1].sortWithinPartitions("run", *DIGEST), "run-level")
        if runs <= 1:
            return levels
        runs = -(-runs // fan)
        up = levels[-1].withColumn("run", F.floor(F.col("run") / fan))
        levels.append(
            up.groupBy("run", *DIGEST).agg(best("best").alias("best"), F.sum("size").alias("size"))
        )


def exact_duplicates(
    docs: DataFrame, runs: int = 512, fan: int = 8, keep: str = "largest"
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    ``docs`` has doc_id and text; further columns, whatever their names, are ignored. Texts are
    equal when they are so after lower-casing A-Z; NULL text counts as empty. Of equal texts the
    row with the largest (or smallest) doc_id stays; a row without doc_id stays only if no equal
    text has one. Of rows alike in both, exactly one is kept. An empty table gives no rows.

    What the root of the tree decides goes back down level by level, joined on run and digest, so
    that no join ever has a hot key: each run holds a digest once.
    """
    if fan < 2 or runs < 1:
        raise ValueError("runs from 1, fan from 2")
    prints = fingerprints(docs, runs)
    levels = merged_runs(prints, runs, fan, keep)
    known = levels[-1]
    for level in reversed(levels[:-1]):
        above = known.select(F.col("run").alias("up"), *DIGEST, "best", "size")
        known = written(
            level.select("run", *DIGEST, F.floor(F.col("run") / fan).alias("up"))
            .join(above, ["up", *DIGEST])
            .select("run", *DIGEST, "best", "size"),
            "run-decided",
        )
    return prints.join(known, ["run", *DIGEST]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
