"""Sharding by extendible hashing, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save, unused

#: Fixed value: usable bits of a key's hash, the first 15 hex digits of its MD5.
BITS = 60


def _bits_of(key: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("\\N")).cast("binary")), 1, 15), 16, 10).cast("bigint")


def _directory(rows: DataFrame, limit: int, total: int, label: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows (.., h, n_bytes) with their shards, and the rows, if any, that all `BITS` bits leave in too large a bucket."""
    low, high = 0, min(BITS, (max(1, total) // limit).bit_length() + 4)
    placed: list[DataFrame] = []
    inside = rows
    while True:
        # A prefix is held as its bits with a 1 before them, so that prefixes of all lengths differ.
        deep = F.shiftright("h", BITS - high) + F.lit(1 << high)
        cells = inside.groupBy(deep.alias("cell")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("r"))
        cells = save(cells)  # at most one row a cell: read for the sums and for the lookup
        prefixes = cells.select("cell", "b", "r", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")).withColumn("prefix", F.expr(f"shiftright(cell, {high} - depth)"))
        sums = prefixes.groupBy("prefix").agg(F.sum("b").alias("shard_bytes"), F.sum("r").alias("shard_rows"))
        fits = sums.where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1))
        found = prefixes.select("cell", "depth", "prefix").join(fits.hint("merge"), "prefix").groupBy("cell").agg(F.min_by(F.struct("prefix", "depth", "shard_bytes", "shard_rows"), "depth").alias("s"))
        at = inside.withColumn("cell", deep)
        # By merge at every size: the cells grow with the input, and rows are narrow.
        placed.append(at.join(found.hint("merge"), "cell").select(*rows.columns, F.col("s.depth").cast("int").alias("depth"), F.concat(F.lit(label), F.substring(F.conv(F.col("s.prefix").cast("string"), 10, 2), 2, BITS + 1)).alias("shard"), "s.shard_bytes", "s.shard_rows"))
        large = cells.where((F.col("b") > limit) & (F.col("r") > 1)).select("cell")
        if large.isEmpty():
            rest = None
            break
        rest = at.join(large.hint("merge"), "cell", "left_semi").select(*rows.columns)
        if high == BITS:
            break
        inside, low, high = rest, high, min(BITS, high + 12)
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out, rest


def shard(docs: DataFrame, key: str = "doc_id", size_col: str = "text", limit: int = 1 << 20) -> DataFrame:
    """docs -> (doc_id, n_bytes, depth, shard, shard_bytes, shard_rows, oversize), one row per row of `docs`; `doc_id` is the key.

    The directory is indexed by the leading bits of the MD5 of the key (as text). A bucket above `limit` bytes, and no other, splits
    on its next bit: a row's shard is the shortest prefix of its hash whose rows fit. `shard` is that prefix in 0 and 1, `depth` its length;
    '' is the whole table. n_bytes: UTF-8 length, 0 for null text. A null key hashes as the text '\\N'. Rows that share all bits (a
    repeated key) and exceed the limit together are told apart by a hash of their row number, as shards 'r<prefix>'. A single row above
    the limit, a very long text say, has a shard of its own, marked oversize. Empty table: no rows. Other columns are not read, whatever their names.

    Scale: sizes are summed by prefix before the shuffle, to a depth that follows from the total; only buckets still too large there are
    summed deeper, so a run takes a few aggregations however many shards there are, and no text is shuffled. Rows meet their shards by a merge join.
    """
    rows = docs.select(F.col(key).alias("doc_id"), _size(size_col).alias("n_bytes"))
    return _placed(rows, limit).select("doc_id", "n_bytes", "depth", "shard", "shard_bytes", "shard_rows", (F.col("shard_bytes") > limit).alias("oversize"))


def _size(size_col: str) -> Column:
    return F.coalesce(F.octet_length(F.col(size_col).cast("string")), F.lit(0)).cast("bigint")


def _placed(rows: DataFrame, limit: int) -> DataFrame:
    """Rows (doc_id, n_bytes, any others) with h, depth, shard, shard_bytes and shard_rows."""
    rows = rows.withColumn("h", _bits_of(F.col("doc_id")))
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    out, rest = _directory(rows, limit, total, "")
    if rest is not None:
        rest = save(rest.withColumn("row", F.monotonically_increasing_id()))  # written, so that a retry sees the same numbers
        again, none = _directory(rest.withColumn("h", _bits_of(F.col("row"))), limit, rest.agg(F.sum("n_bytes")).first()[0], "r")
        assert none is None  # row numbers are unique
        out = out.unionByName(again.drop("row"))
    return out


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", size_col: str = "text", limit: int = 1 << 20) -> None:
    """Write `docs` as Parquet, one folder `shard=<prefix>` a shard; the empty prefix is written as 'all'. Every row is written once, whatever the
    keys; columns of any name stay (where one is named shard, the folders are `shard_=<prefix>`). Nulls as in `shard`. Empty table: no folders.

    Whole rows move to their shards here, in one struct, as they must.
    """
    folder = unused("shard", docs.columns)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("whole"), F.col(key).alias("doc_id"), _size(size_col).alias("n_bytes"))
    placed = _placed(rows, limit).select("whole", F.when(F.col("shard") == "", "all").otherwise(F.col("shard")).alias("to"))
    placed.repartition("to").select("whole.*", F.col("to").alias(folder)).write.partitionBy(folder).parquet(path)
