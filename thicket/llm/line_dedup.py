"""Line dedup by site-relative frequency, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save, unused

#: Measured size up to which the boilerplate lists are broadcast.
BROADCAST_BYTES = 32 << 20


def _digest(line: Column) -> Column:
    """What lines are compared by: outer ASCII white space off, lower case, 64 bits of it."""
    return F.xxhash64(F.lower(F.btrim(line, F.lit(" \t\r\f\x0b"))))


def line_dedup(docs: DataFrame, host: str = "source", text_col: str = "text", max_ratio: float = 0.1, min_pages: int = 2, counts: bool = True) -> DataFrame:
    """docs with boilerplate lines dropped from the text; all columns stay, and `lines_kept`, `lines_dropped` (BIGINT) follow if `counts`.

    A line is boilerplate on a host where more than `max_ratio` of the host's pages hold it and, so that a small host keeps what it says once,
    at least `min_pages` do. Every row is a page; a page counts once for a line, however often it holds it, and repeated rows are pages each.
    Blank lines are kept and never counted. Null host: a host of its own. Null text: stays null, with 0 lines, and counts as a page. Empty text: one
    blank line. Very long texts: a text's lines are held at once, nothing is cut. Empty table: no rows. Columns of any name pass through;
    those named like the two new ones are replaced if `counts`.

    Scale: texts never move for the count; pages emit distinct 64-bit line digests, summed before the shuffle by
    (host, digest). A page of k lines on average lets at most k / max_ratio lines of a host be boilerplate, so a host's list is short. The
    lists are written, and broadcast if their measured size is at most BROADCAST_BYTES, so that texts stay where they are; else
    rows meet them by host, hot hosts split by Spark.
    """
    h, d, n, total, boilerplate, left = (unused(x, docs.columns) for x in ("host_key", "digest", "pages_with", "pages", "boilerplate", "kept_lines"))
    key = F.coalesce(F.concat(F.lit("h"), F.col(host).cast("string")), F.lit("n"))
    lines = F.split(F.col(text_col), "\n", -1)
    digests = F.array_remove(F.array_distinct(F.transform(lines, _digest)), F.xxhash64(F.lit("")))
    pages = docs.select(key.alias(h), digests.alias(d))
    totals = pages.groupBy(h).agg(F.count("*").alias(total))
    held = pages.select(h, F.explode(d).alias(d)).groupBy(h, d).agg(F.count("*").alias(n)).where(F.col(n) >= min_pages)
    # The lists are bounded by the host, see above; partial lists are merged map-side.
    boiler = save(held.join(totals, h).where(F.col(n) > F.lit(float(max_ratio)) * F.col(total)).groupBy(h).agg(F.collect_set(d).alias(boilerplate)))
    size = boiler.agg(F.sum(F.size(boilerplate) + 8)).first()[0] or 0  # 8 bytes a digest, and a host's name
    lists = F.broadcast(boiler) if 8 * size <= BROADCAST_BYTES else boiler
    names = [c for c in docs.columns if not (counts and c in ("lines_kept", "lines_dropped"))]
    joined = docs.select(*names, key.alias(h)).join(lists, h, "left")
    kept = F.when(F.col(boilerplate).isNull(), lines).otherwise(F.filter(lines, lambda x: ~F.array_contains(F.col(boilerplate), _digest(x))))
    out = joined.withColumn(left, kept)
    n_kept = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(left)).cast("bigint")
    n_lines = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("bigint")
    new = [n_kept.alias("lines_kept"), (n_lines - n_kept).alias("lines_dropped")] if counts else []
    return out.select(*[F.array_join(left, "\n").alias(c) if c == text_col else F.col(c) for c in names], *new)
