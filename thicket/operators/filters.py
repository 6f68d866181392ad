"""Exclude patterns: classified on the driver, applied as anti-joins."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hosts as H
from ..functions import prefixes as P
from ..functions import rules as R
from . import blocks, hosts


class PatternError(ValueError):
    """A pattern that is none."""


#: What Java accepts in an expression and RE2 does not.
_NOT_RE2 = re.compile(r"\(\?(?:[=!>]|<[=!])|\\[1-9]|\\k<|(?:[*+?}])\+|\\[ZGRXhHV]|\[[^\]]*&&")


def check_regex(spark: SparkSession, pattern: str, shown: str) -> str:
    """The expression, if RE2 would take it: no look-around, back-references, possessive or atomic groups."""
    if _NOT_RE2.search(re.sub(r"\\\\", "", pattern)):
        raise PatternError(f"pattern {shown!r}: not an RE2 expression")
    try:
        spark._jvm.java.util.regex.Pattern.compile(pattern)
    except Exception as e:
        raise PatternError(f"pattern {shown!r}: {str(e).splitlines()[0][:200]}") from None
    return re.sub(r"\\C", ".", pattern)


@dataclass
class Excludes:
    """Compiled patterns: a few that are written by hand go into predicates; those of lists, and many, stay tables (suffixes, ranges)."""

    #: Hand-written patterns of a kind that go into one predicate.
    FEW = 500

    regexes: list[str] = field(default_factory=list)
    exact: list[str] = field(default_factory=list)
    rules: list[str] = field(default_factory=list)
    below: list[str] = field(default_factory=list)
    within: list[tuple] = field(default_factory=list)  # (fam, bits, first, last)
    suffixes: DataFrame | None = None  # (pattern)
    ranges: DataFrame | None = None  # fam, bits, first, last

    def hosts(self, rows: DataFrame, host: str = "host") -> DataFrame:
        if self.exact:
            rows = rows.where(~F.col(host).isin(self.exact))
        if self.below:
            rows = rows.where(~hosts.below_any(F.col(host), self.below))
        if self.suffixes is not None:
            rows = hosts.exclude_suffix(rows, self.suffixes, host)
        return hosts.exclude_regex(rows, self.regexes, host)

    def _within(self, b: Column) -> Column:
        """Whether a block is inside one of `within`."""
        held = F.array(*[F.struct(F.lit(f).alias("fam"), F.lit(first).alias("first"), F.lit(last).alias("last")) for f, _, first, last in self.within])
        return F.exists(held, lambda x: (x["fam"] == b["fam"]) & (x["first"] <= b["first"]) & (x["last"] >= b["last"]))

    def blocks(self, rows: DataFrame) -> DataFrame:
        if self.within:
            rows = rows.where(~self._within(F.struct(*blocks.KEYS)))
        if self.ranges is not None:
            rows = blocks.exclude(rows, self.ranges)
        for r in self.regexes:
            rows = rows.where(~P.text(F.struct(*blocks.KEYS)).rlike(r))
        return rows

    def canonical_rules(self, rows: DataFrame, rule: str = "rule") -> DataFrame:
        """Host patterns meet hosts and suffixes, ranges meet blocks, and exact rules and expressions every rule's text. Null rules stay."""
        columns = rows.columns
        r = F.col(rule)
        if self.rules:
            rows = rows.where(~F.coalesce(R.key(r).isin(self.rules), F.lit(False)))
        for x in self.regexes:
            rows = rows.where(~F.coalesce(R.text(r).rlike(x) | (R.is_host(r) & r["value"].rlike(x)) | (R.is_block(r) & P.text(P.parse(r["value"])).rlike(x)), F.lit(False)))
        if self.exact:
            rows = rows.where(~F.coalesce(R.is_host(r) & r["value"].isin(self.exact), F.lit(False)))
        if self.below:
            rows = rows.where(~F.coalesce(R.is_host(r) & hosts.below_any(r["value"], self.below), F.lit(False)))
        if self.within:
            rows = rows.where(~F.coalesce(self._within(P.parse(F.when(R.is_block(r), r["value"]))), F.lit(False)))
        if self.suffixes is not None:
            named = rows.withColumn("_host", F.when(R.is_host(r), r["value"]))
            rows = hosts.exclude_suffix(named, self.suffixes, "_host").select(*columns)
        if self.ranges is not None:
            placed = rows.withColumn("_b", P.parse(F.when(R.is_block(r), r["value"]))).select("*", "_b.*")
            rows = blocks.exclude(placed, self.ranges).select(*columns)
        return rows


def compile_patterns(spark: SparkSession, patterns: list[str], listed: DataFrame | None = None) -> Excludes:
    """Patterns by shape: /expression/; =TYPE,value; an address or block; =host; else a host and all below it. A malformed one is an error.

    listed (pattern): those of exclude_from lists, hosts and blocks already in normal form, which never leave the cluster.
    """
    out = Excludes()
    whole = [p for p in patterns if len(p) > 2 and p[0] == p[-1] == "/"]
    out.regexes = [check_regex(spark, p[1:-1], p) for p in whole]
    others = [p for p in patterns if p not in whole]
    typed = [p for p in others if p.startswith("=") and "," in p]
    plain = [p for p in others if p not in typed]

    def solve(given: list[str], *found: Column) -> list:
        rows = spark.createDataFrame([(i, p) for i, p in enumerate(given)], "i int, p string").select("i", "p", *found)
        return sorted(rows.collect(), key=lambda r: r[0])

    if typed:
        for r in solve(typed, R.key(R.canonical(R.parse(H.to_ascii(F.substr("p", F.lit(2)))))).alias("key")):
            if r.key is None:
                raise PatternError(f"pattern {r.p!r}: not a rule")
            out.rules.append(r.key)
    suffixes, ranges = [], []
    if plain:
        bare = F.when(F.trim("p").startswith("="), F.substr(F.trim("p"), F.lit(2))).otherwise(F.trim("p"))
        for r in solve(plain, P.parse(F.col("p")).alias("b"), H.normalize(H.to_ascii(bare), True).alias("host")):
            shown = r.p.strip()
            if len(shown) > 2 and shown[0] == shown[-1] == "/":  # only untrimmed ones come here: they are expressions on hosts alone
                raise PatternError(f"pattern {r.p!r}: white space around an expression")
            if r.b is not None:
                ranges.append(tuple(r.b))
            elif not shown:
                continue
            elif r.host is None:
                raise PatternError(f"pattern {r.p!r}: neither a host nor a block")
            elif shown.startswith("="):
                out.exact.append(r.host)
            else:
                suffixes.append((r.host,))
    if len(suffixes) <= Excludes.FEW:
        out.below = [x for (x,) in suffixes]
    else:
        out.suffixes = spark.createDataFrame(suffixes, "pattern string")
    if len(ranges) <= Excludes.FEW:
        out.within = ranges
    else:
        out.ranges = spark.createDataFrame(ranges, "fam int, bits int, first string, last string")
    if listed is not None:
        told = listed.select("pattern", P.parse(F.col("pattern")).alias("b"))
        names, found = told.where("b is null").select("pattern"), told.where("b is not null").select("b.*")
        out.suffixes = names if out.suffixes is None else out.suffixes.unionByName(names)
        out.ranges = found if out.ranges is None else out.ranges.unionByName(found)
    return out
