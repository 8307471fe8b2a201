"""Filters, joins and aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stocktrail.functions.scalars import day, filled


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value in every one of ``columns``."""
    return df.dropna(how="any", subset=columns)


def ilike_any(c, *patterns: str) -> Column:
    """Case-insensitive match against any of the patterns."""
    c = F.col(c) if isinstance(c, str) else c
    return reduce(lambda a, b: a | b, [F.upper(c).ilike(p) for p in patterns])


def enrich(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """All of ``left`` and some columns of ``right``, rows without a match left out."""
    return left.join(right.select(key, *columns), key).select(
        *[left[c] for c in left.columns], *columns
    )


def resolve_parent(child: DataFrame, parents: DataFrame, on: list[str], own: str, parent: str):
    """Left join to the parent map, the child's own key standing in where there is no parent."""
    return child.join(parents, on, "left").withColumn(parent, F.coalesce(parent, own))


def full_outer(left: DataFrame, right: DataFrame, key: str, keep: Column | None = None):
    """Full outer join on ``key`` as a left join plus the right rows that nothing matches.

    A full outer join can not be split when one key (or NULL) holds much of the left side; a left
    join can, and the keys of the left side are made distinct before they meet the right one. The
    left side's ``key`` column stays as it is in the rows it has; the right side's is dropped.

    ``keep`` filters the joined left rows. It is applied before the join, where it reaches the
    scan, and does not change which right rows count as matched.
    """
    kept = left if keep is None else left.where(keep)
    joined = kept.join(right, key, "left")
    return joined.unionByName(unmatched(left, right, key), allowMissingColumns=True)


def unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The right rows of a full outer join that nothing matches, without their key."""
    keys = left.select(key).where(F.col(key).isNotNull()).distinct()
    return right.join(keys, key, "left_anti").drop(key)


def assemble(spine: DataFrame, features: list[DataFrame], on: list[str]) -> DataFrame:
    """Add feature columns to a spine, one left join after the other on the same key."""
    return reduce(lambda df, feature: df.join(feature, on, "left"), features, spine)


def union_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    """SQL UNION: matched by position, one copy of equal rows."""
    return first.union(second).distinct()


def daily_counts(df: DataFrame, ts: str, entity: str, out: str = "user_count") -> DataFrame:
    """Non-NULL entities per day; rows without a time form their own group."""
    return df.groupBy(day(ts).alias("date")).agg(F.count(entity).alias(out))


def receipt_span(receipts: DataFrame, keys: list[str], received_at: str) -> DataFrame:
    """First and last day of receipt per key."""
    return receipts.groupBy(*keys).agg(
        F.to_date(F.min(received_at)).alias("first_rec_date"),
        F.to_date(F.max(received_at)).alias("last_rec_date"),
    )


def rollup_position(
    df: DataFrame, keys: list[str], sums: list[str], firsts: list[str], labels: list[str]
) -> DataFrame:
    """An aggregate taken up to coarser keys: quantities add up, the earliest date and the
    greatest price or label stay."""
    return df.groupBy(*keys).agg(
        *[F.sum(filled(F.col(c))).alias(c) for c in sums],
        *[F.min(c).alias(c) for c in firsts],
        *[F.max(c).alias(c) for c in labels],
    )
