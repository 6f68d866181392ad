"""Column functions on raw text: lines, comments, fields, base64, content hashes. Null in, null out."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries of hosts files that are never list entries.
LOCAL_NAMES = (
    "localhost", "localhost.localdomain", "local", "broadcasthost", "ip6-localhost", "ip6-loopback",
    "ip6-localnet", "ip6-mcastprefix", "ip6-allnodes", "ip6-allrouters", "ip6-allhosts", "0.0.0.0",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), the value computed once: an expression that names a large one many times would repeat it as often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shared(body: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """`body`, whose value is computed once and whose expression is built once a session: building a large one costs thousands of calls to the JVM."""
    made: dict = {}

    @wraps(body)
    def call(value: Column) -> Column:
        context = SparkContext._active_spark_context
        try:
            from pyspark.sql.classic.column import _to_seq
            from pyspark.sql.functions.builtin import _create_lambda

            if made.get("context") is not context:
                made.update(context=context, function=_create_lambda(body))
            applied = Column(context._jvm.PythonSQLUtils.fn("transform", _to_seq(context, [F.array(value)._jc, made["function"]])))
        except (ImportError, AttributeError):  # another client than the classic one
            return let(value, body)
        return F.get(applied, F.lit(0))

    return call


def trim(s: Column) -> Column:
    """Outer Unicode white space off."""
    return F.regexp_replace(s, r"(?U)\A\s+|\s+\z", "")


def fields(s: Column) -> Column:
    """Runs of anything but Unicode white space; no fields for blank text."""
    t = trim(s)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"(?U)\s+"))


def first_field(s: Column) -> Column:
    """What stands before the first space or tab."""
    return F.regexp_extract(s, r"\A[^ \t]*", 0)


def strip_comment(s: Column) -> Column:
    """'' for a comment line (# ! ; //); else the line up to a # that follows a space or tab, trimmed."""
    t = trim(s)
    return F.when(t.rlike(r"\A([#!;]|//)"), "").otherwise(trim(F.regexp_replace(t, r"(?s)(?<!\A)(?<=[ \t])#.*", "")))


def is_local_name(s: Column) -> Column:
    return F.lower(s).isin(*LOCAL_NAMES)


def is_ascii(s: Column) -> Column:
    return s.rlike(r"\A[\x00-\x7F]*\z")


def lines(bodies: DataFrame, body: str = "body") -> DataFrame:
    """One row a non-blank line: the columns of `bodies` but `body`, then pos BIGINT and line STRING (trimmed).

    A leading byte order mark goes; only \\n ends lines. Null and blank bodies give no rows. pos counts all lines, so it orders but has gaps.
    """
    rest = [c for c in bodies.columns if c != body]
    text = F.regexp_replace(F.col(body), r"\A﻿", "")
    out = bodies.select(*rest, F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    return out.select(*rest, F.col("pos").cast("bigint").alias("pos"), trim(F.col("line")).alias("line")).where("line <> ''")


# -- base64 ---------------------------------------------------------------------------------------------------------------------


def from_base64(s: Column) -> Column:
    """Bytes of base64 text, padded or not, line ends and blanks ignored; null where it is none."""
    bare = F.regexp_replace(s, r"[\n\r \t]", "")
    stripped = F.regexp_replace(bare, r"={1,2}\z", "")
    ok = bare.rlike(r"\A[A-Za-z0-9+/]*={0,2}\z") & (F.length(stripped) % 4 != 1) & ((F.length(bare) % 4 == 0) | ~bare.contains("="))
    padded = F.concat(stripped, F.expr("'==='").substr(F.lit(1), (F.lit(4) - F.length(stripped) % 4) % 4))
    return F.when(ok, F.try_to_binary(padded, F.lit("base64")))


def looks_base64(s: Column) -> Column:
    """At least 16 characters, of the base64 alphabet and white space alone, without a blank line inside."""
    return (F.octet_length(s) >= 16) & s.rlike(r"\A[A-Za-z0-9+/=\s]+\z") & ~F.regexp_replace(s, r"\A\s+|\s+\z", "").contains("\n\n")


def decode(s: Column, encoding: str = "auto") -> Column:
    """The text of a body: `plain` as it is; `base64` decoded, null where that fails; `auto` decoded where it looks like base64 and
    gives UTF-8 text of several lines without NUL, else as it is."""
    if encoding in ("", "plain"):
        return s
    raw = from_base64(s)
    if encoding == "base64":
        return F.decode(F.when(F.is_valid_utf8(raw.cast("string")), raw), "UTF-8")
    if encoding != "auto":
        raise ValueError(f"unknown encoding {encoding!r}")
    text = raw.cast("string")
    good = looks_base64(s) & raw.isNotNull() & F.is_valid_utf8(text) & ~text.contains("\0") & text.contains("\n")
    return F.when(F.coalesce(good, F.lit(False)), text).otherwise(s)


# -- content hashes --------------------------------------------------------------------------------------------------------------


def joined(ordered: Column) -> Column:
    """An array of lines as text, each line ended by a line end; '' for none."""
    return F.when(F.size(ordered) == 0, "").otherwise(F.concat(F.array_join(ordered, "\n"), F.lit("\n")))


def content_hash(ranked: DataFrame, rank: str = "rank", line: str = "line") -> DataFrame:
    """One row (hash STRING, entries BIGINT): hex SHA-256 of the lines in order of rank.

    It needs all lines as one text, so it is for finished lists, which the sinks hold whole anyway; `thicket.plans.state.hash_lines` streams.
    """
    held = F.array_sort(F.collect_list(F.struct(F.col(rank), F.col(line))))
    return ranked.agg(F.sha2(joined(F.transform(held, lambda x: x[line])), 256).alias("hash"), F.count("*").alias("entries"))
