"""The jobs as plans: entries of all sources to one ordered list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hosts as H
from ..functions import prefixes as P
from ..functions import rules as R
from ..operators import blocks, hosts, rules
from ..operators.filters import Excludes
from .scratch import hold


@dataclass
class Plan:
    """lines (line STRING and sort keys), how to order them, and the entries (valid or not) and those left by the filters, for the counts.

    What several steps read (entries, the merged list, the final one) is written once, see `scratch.hold`.
    """

    lines: DataFrame
    keys: tuple
    entries: DataFrame
    left: DataFrame

    def ordered(self) -> DataFrame:
        return self.lines.orderBy(*self.keys).select("line")

    def ranked(self) -> DataFrame:
        return hosts.ranked(self.lines, *self.keys).select("rank", "line")


def _allowed(job_allows: bool, sources_that_allow: list[int]) -> Column:
    return F.lit(True) if job_allows else F.col("src_idx").isin(sources_that_allow) if sources_that_allow else F.lit(False)


def _by_source(entries: DataFrame, filters: dict[int, Excludes], apply) -> DataFrame:
    """Each source's own filter on its own entries; sources without one go through untouched."""
    if not filters:
        return entries
    out = entries.where(~F.col("src_idx").isin(list(filters)))
    for i, x in filters.items():
        out = out.unionByName(apply(x, entries.where(F.col("src_idx") == i)))
    return out


def domain_job(items: DataFrame, excludes: Excludes | None = None, by_source: dict[int, Excludes] | None = None, order: str = "sorted", allow_tld: bool = False, tld_sources: list[int] = (), idna: bool = True) -> Plan:
    """Hosts, normalised, valid, filtered, first seen, filtered by the job, collapsed under their parents, in order."""
    value = H.to_ascii(F.col("value")) if idna else F.col("value")
    entries = hold(items.withColumn("host", R.host_of_item(F.col("kind"), value, _allowed(allow_tld, list(tld_sources)))).select("src_idx", "pos", "value", "host"))
    valid = entries.where("host is not null").select("src_idx", "pos", "host")
    left = _by_source(valid, by_source or {}, lambda x, rows: x.hosts(rows))
    merged = hold((excludes or Excludes()).hosts(hosts.first_seen(left, "host")))
    final = hold(hosts.collapse(merged))
    keys = (H.reverse_labels(F.col("line")),) if order == "sorted" else ("src_idx", "pos")
    return Plan(final.withColumnRenamed("host", "line"), keys, entries.select("src_idx", "pos", "value", F.col("host").isNotNull().alias("valid")), left)


def ip_job(items: DataFrame, excludes: Excludes | None = None, by_source: dict[int, Excludes] | None = None, aggregate: bool = True) -> Plan:
    """Blocks, valid, filtered, distinct, filtered by the job, merged to the fewest (or just without those inside others), by address."""
    entries = hold(items.select("src_idx", "pos", "value", R.block_of_item(F.col("kind"), F.col("value")).alias("b")))
    valid = entries.where("b is not null").select("src_idx", "b.*")
    left = _by_source(valid, by_source or {}, lambda x, rows: x.blocks(rows))
    merged = hold((excludes or Excludes()).blocks(left.select(*blocks.KEYS).distinct()))
    final = hold((blocks.aggregate(merged) if aggregate else blocks.dedupe(merged)))
    return Plan(final.withColumn("line", P.text(F.struct(*blocks.KEYS))), blocks.sort_keys(), entries.select("src_idx", "pos", "value", F.col("b").isNotNull().alias("valid")), left)


class _RulePlan(Plan):
    within_sorted = False

    def ranked(self) -> DataFrame:
        return rules.ranked(self.lines, self.within_sorted).select("rank", "line")

    def ordered(self) -> DataFrame:
        if self.within_sorted:
            return self.ranked().orderBy("rank").select("line")
        return self.lines.orderBy(R.rank(F.col("rule.type")), "src_idx", "pos").select("line")


def rule_job(items: DataFrame, excludes: Excludes | None = None, by_source: dict[int, Excludes] | None = None, order: str = "source", allow_tld: bool = False, tld_sources: list[int] = (), idna: bool = True) -> Plan:
    """Entries of all kinds as canonical rules, filtered, first seen, filtered by the job, collapsed, grouped by type."""
    value = H.to_ascii(F.col("value")) if idna else F.col("value")
    entries = hold(items.withColumn("rule", R.of_item(F.col("kind"), value, _allowed(allow_tld, list(tld_sources)))).select("src_idx", "pos", "value", "rule"))
    valid = entries.where("rule is not null").select("src_idx", "pos", "rule")
    left = _by_source(valid, by_source or {}, lambda x, rows: x.canonical_rules(rows))
    merged = hold((excludes or Excludes()).canonical_rules(rules.distinct(left)))
    final = hold(rules.collapse(merged))
    plan = _RulePlan(final.withColumn("line", R.text(F.col("rule"))), ("src_idx", "pos"), entries.select("src_idx", "pos", "value", F.col("rule").isNotNull().alias("valid")), left)
    plan.within_sorted = order == "sorted"
    return plan


def mirror_job(items: DataFrame, excludes: Excludes | None = None, idna: bool = True) -> Plan:
    """One source's rules as they are written, repeats and all, without invalid and excluded ones. The source's own filter plays no part."""
    ascii_value = H.to_ascii(F.col("value")) if idna else F.col("value")
    rule = R.parse(ascii_value)
    raw = R.unquote(F.regexp_replace(F.col("value"), r"(?U)\A\s+|\s+\z", ""))
    entries = hold(items.select("src_idx", "pos", "value", F.when(F.col("kind") == "rule", rule).alias("found"), raw.alias("raw")))
    valid = entries.where("found is not null").select("src_idx", "pos", F.col("raw").alias("line"), R.canonical(F.col("found")).alias("rule"))
    left = hold((excludes or Excludes()).canonical_rules(valid))
    return Plan(left.select("src_idx", "pos", "line"), ("src_idx", "pos"), entries.select("src_idx", "pos", "value", F.col("found").isNotNull().alias("valid")), left)


def source_stats(plan: Plan, samples: int = 5) -> DataFrame:
    """(src_idx, valid, invalid, excluded, samples): what became of each source's entries, and the first few rejected.

    Samples come from a limit a group, so no list of rejects is gathered.
    """
    from pyspark.sql import Window

    counts = plan.entries.groupBy("src_idx").agg(F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("invalid"))
    kept = plan.left.groupBy("src_idx").agg(F.count("*").alias("kept"))
    first = plan.entries.where("not valid").withColumn("n", F.row_number().over(Window.partitionBy("src_idx").orderBy("pos"))).where(F.col("n") <= samples)
    shown = first.groupBy("src_idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "value"))), lambda x: x["value"]).alias("samples"))
    rows = counts.join(kept, "src_idx", "left").join(shown, "src_idx", "left")
    return rows.select("src_idx", "valid", "invalid", (F.col("valid") - F.coalesce("kept", F.lit(0))).alias("excluded"), F.coalesce("samples", F.array().cast("array<string>")).alias("samples"))
