"""Operators on address blocks (columns fam, bits, first, last): coverage, dedupe, merging, exclusion, order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import prefixes as P
from ..plans.scratch import hold

KEYS = ("fam", "bits", "first", "last")
#: Blocks of fewer bits are wide: there are under 2**17 of them, whatever the input.
CELL_BITS = 16


def _struct() -> Column:
    return F.struct(*KEYS)


def _lengths(rows: DataFrame) -> list[int]:
    """The block lengths that occur: at most 129."""
    return sorted(r[0] for r in rows.select("bits").distinct().collect())


def inside(rows: DataFrame, patterns: DataFrame, proper: bool = False) -> DataFrame:
    """The distinct blocks of `rows` that a block of `patterns` contains (a larger one, if `proper`).

    Containment as an equi-join: a block asks for the blocks around it of each length that patterns have, a few keys a row.
    """
    lengths = _lengths(patterns)
    asked_for = F.filter(F.array(*[F.lit(x) for x in lengths]).cast("array<int>"), lambda n: (n < F.col("bits")) if proper else (n <= F.col("bits")))
    asked = rows.select(*KEYS, F.explode(asked_for).alias("_n")).withColumn("_f", P.widened(_struct(), F.col("_n")))
    around = patterns.select(F.col("fam").alias("_fam"), F.col("bits").alias("_bits"), F.col("first").alias("_first"))
    return asked.join(around, (F.col("fam") == F.col("_fam")) & (F.col("_n") == F.col("_bits")) & (F.col("_f") == F.col("_first")), "left_semi").select(*KEYS).distinct()


def dedupe(rows: DataFrame) -> DataFrame:
    """Distinct blocks, without those inside another."""
    found = hold(rows.select(*KEYS).distinct())  # read on three sides, and its expressions are large
    return found.join(inside(found, found, proper=True), list(KEYS), "left_anti")


def exclude(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """Without blocks inside a pattern; a pattern inside a block carves nothing out."""
    return rows.join(inside(rows, patterns), list(KEYS), "left_anti").select(*rows.columns)


def _merged(rows: DataFrame, *cell: Column | str) -> DataFrame:
    """Disjoint blocks -> the fewest blocks that make up the same addresses, cell by cell."""
    order = Window.partitionBy("fam", *cell).orderBy("first")
    joins = F.lag(P.after(F.col("last"))).over(order) == F.col("first")
    runs = rows.withColumn("_run", F.sum(F.when(joins, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy("fam", *cell, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    made = spans.select("fam", F.explode(P.cover(F.col("fam"), F.col("first"), P.after(F.col("last")))).alias("b"))
    return made.select(P.block(F.col("fam"), F.col("b.bits"), F.col("b.first")).alias("b")).select("b.*")


def aggregate(rows: DataFrame) -> DataFrame:
    """Distinct blocks, none inside another, siblings merged until none are left: the fewest blocks of the same addresses.

    Runs of adjacent blocks are found inside cells of CELL_BITS leading bits, which spreads the sort; what fills whole cells, and the
    wide blocks, at most 2**17 rows, are then merged by family.
    """
    alone = hold(dedupe(rows))
    cell = F.substring("first", 1, CELL_BITS // 4)
    cells = _merged(alone.where(F.col("bits") >= CELL_BITS).withColumn("_cell", cell), "_cell")
    wide = alone.where(F.col("bits") < CELL_BITS).unionByName(cells.where(F.col("bits") == CELL_BITS))
    return cells.where(F.col("bits") > CELL_BITS).unionByName(_merged(wide))


def sort_keys() -> tuple[Column, ...]:
    """IPv4 first, then by address, then length."""
    return F.col("fam"), F.col("first"), F.col("bits")
