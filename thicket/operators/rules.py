"""Operators on canonical rules (column rule, with src_idx and pos): distinct, collapse, order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hosts as H
from ..functions import prefixes as P
from ..functions import rules as R
from . import blocks, hosts


def distinct(rows: DataFrame) -> DataFrame:
    """The first rule of each type and value, with its options."""
    keyed = rows.withColumn("key", R.key(F.col("rule")))
    return hosts.first_seen(keyed, "key").drop("key").select(*rows.columns)


def collapse(rows: DataFrame) -> DataFrame:
    """Distinct rules without those another covers: suffixes below a suffix of two labels at least; hosts at or below any suffix; blocks inside
    a block. Options play no part. Other types, SRC-IP-CIDR among them, all stay."""
    rows = distinct(rows)
    kind = F.col("rule.type")
    of = lambda *kinds: rows.where(kind.isin(*kinds))
    named = lambda df: df.withColumn("host", F.col("rule.value"))
    suffixes = named(of("DOMAIN-SUFFIX"))
    kept_suffixes = hosts.collapse(suffixes).select(*rows.columns)
    kept_hosts = hosts.exclude_suffix(named(of("DOMAIN")), suffixes.select(F.col("host").alias("pattern"))).select(*rows.columns)
    ranges = of("IP-CIDR", "IP-CIDR6").withColumn("b", P.parse(F.col("rule.value"))).select("*", "b.*")
    covered = blocks.inside(ranges, ranges, proper=True)
    kept_ranges = ranges.join(covered, list(blocks.KEYS), "left_anti").select(*rows.columns)
    rest = rows.where(~F.coalesce(kind.isin("DOMAIN-SUFFIX", "DOMAIN", "IP-CIDR", "IP-CIDR6"), F.lit(False)))
    return rest.unionByName(kept_suffixes).unionByName(kept_hosts).unionByName(kept_ranges)


def ranked(rows: DataFrame, within_sorted: bool = False) -> DataFrame:
    """`rows` with rank BIGINT: groups of types in their fixed order, others last; inside a group by source and position, or sorted: hosts by reversed
    labels, blocks by address, others by value. Unlisted types form one group, in which only neighbours of one type are sorted."""
    rows = rows.withColumn("_rank", R.rank(F.col("rule.type")))
    if not within_sorted:
        return hosts.ranked(rows, "_rank", "src_idx", "pos").drop("_rank")
    listed = F.col("_rank") != R.OTHER_RANK
    # Runs of one type among the unlisted, numbered along the list; the listed have a run each.
    order = Window.partitionBy("_rank").orderBy("src_idx", "pos")
    others = rows.where(~listed).withColumn("_new", F.when(F.lag("rule.type").over(order) == F.col("rule.type"), 0).otherwise(1))
    others = others.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
    rows = rows.where(listed).withColumn("_run", F.lit(0).cast("bigint")).unionByName(others)
    block = P.parse(F.when(R.is_block(F.col("rule")), F.col("rule.value")))
    by_host = F.when(R.is_host(F.col("rule")), H.reverse_labels(F.col("rule.value")))
    by_block = F.when(block.isNotNull(), F.concat(block["fam"].cast("string"), block["first"], F.lpad(block["bits"].cast("string"), 3, "0")))
    return hosts.ranked(rows, "_rank", "_run", F.coalesce(by_host, by_block, F.col("rule.value")), "src_idx", "pos").drop("_rank", "_run")
