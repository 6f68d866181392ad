"""Operators on host lists: first-seen distinct, collapse under parents, order, exclusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hosts as H
from ..plans.scratch import hold

ORDER = ("src_idx", "pos")


def first_seen(rows: DataFrame, key: str, order: tuple[str, ...] = ORDER) -> DataFrame:
    """One row a key: the first by `order`. Pre-aggregated before its one shuffle; filters on the key reach below it."""
    rest = [c for c in rows.columns if c != key]
    kept = F.min_by(F.struct(*rest), F.struct(*order)) if set(rest) != set(order) else F.min(F.struct(*order))
    return rows.groupBy(key).agg(kept.alias("_kept")).select(key, *[F.col(f"_kept.{c}").alias(c) for c in (rest if set(rest) != set(order) else order)]).select(*rows.columns)


def under(rows: DataFrame, parents: DataFrame, host: str = "host", parent: str = "host", own: bool = False, least_labels: int = 2) -> DataFrame:
    """The distinct hosts of `rows` that have an ancestor (or, with `own`, are themselves) in `parents`.

    Every host asks for each of its suffixes by an equi-join; single-label parents count from `least_labels` 1 on.
    """
    asked = rows.select(F.col(host).alias("_h"), F.explode(H.ancestors(F.col(host), least_labels, own)).alias("_a"))
    return asked.join(parents.select(F.col(parent).alias("_a")), "_a", "left_semi").select(F.col("_h").alias(host)).distinct()


def collapse(rows: DataFrame, host: str = "host") -> DataFrame:
    """Without hosts below another host of the list that has two labels at least."""
    return rows.join(under(rows, rows, host, host), host, "left_anti").select(*rows.columns)


def exclude_suffix(rows: DataFrame, patterns: DataFrame, host: str = "host", pattern: str = "pattern") -> DataFrame:
    """Without hosts that are, or are below, a pattern; patterns of one label count. Rows with a null host stay, and equal rows each.

    Distinct hosts ask for each of their suffixes; only those that a pattern has come back to the rows, which are made once.
    """
    rows = hold(rows)
    return rows.join(under(rows.select(host).distinct(), patterns, host, pattern, own=True, least_labels=1), host, "left_anti").select(*rows.columns)


def below_any(host: Column, patterns: list[str]) -> Column:
    """Whether a host is, or is below, one of a few patterns."""
    return F.exists(H.ancestors(host, 1, own=True), lambda a: a.isin(patterns))


def exclude_exact(rows: DataFrame, patterns: DataFrame, host: str = "host", pattern: str = "pattern") -> DataFrame:
    return rows.join(patterns.select(F.col(pattern).alias(host)), host, "left_anti").select(*rows.columns)


def exclude_regex(rows: DataFrame, regexes: list[str], column: str = "host") -> DataFrame:
    """Without rows in whose text one of a few expressions is found."""
    for r in regexes:
        rows = rows.where(~F.col(column).rlike(r))
    return rows


def sorted_rank(rows: DataFrame, host: str = "host") -> DataFrame:
    """`rows` with rank BIGINT, from 1, by reversed labels in byte order."""
    return ranked(rows, H.reverse_labels(F.col(host)))


#: Keys sampled to cut a list into ranges, and ranges.
SAMPLE, RANGES = 2048, 64


def ranked(rows: DataFrame, *keys) -> DataFrame:
    """`rows` with rank BIGINT, from 1, in the order of the keys, which must tell rows apart.

    A bounded sample of keys cuts the list into ranges; rows are numbered in their range, from the number of rows in the ranges before
    it. No task sees all rows, and a retried task numbers alike.
    """
    key = F.struct(*[(F.col(k) if isinstance(k, str) else k).alias(f"k{i}") for i, k in enumerate(keys)])
    held = rows.withColumn("_key", key)
    sample = sorted(r[0] for r in held.select("_key").orderBy(F.xxhash64("_key"), "_key").limit(SAMPLE).collect())
    cuts = sample[:: max(1, len(sample) // RANGES)][1:]
    kinds = dict(held.select("_key.*").dtypes)
    literal = lambda cut: F.struct(*[F.lit(v).cast(kinds[f"k{i}"]).alias(f"k{i}") for i, v in enumerate(cut)])
    part = F.size(F.filter(F.array(*map(literal, cuts)), lambda c: c <= F.col("_key"))) if cuts else F.lit(0)
    held = held.withColumn("_part", part)
    sizes = held.groupBy("_part").agg(F.count("*").alias("_size"))  # at most RANGES + 1 rows
    before = sizes.select("_part", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    numbered = held.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy("_key")))
    return numbered.join(F.broadcast(before), "_part").select(*rows.columns, (F.col("_before") + F.col("_n")).cast("bigint").alias("rank"))
