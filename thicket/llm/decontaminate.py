"""Benchmark decontamination: a broadcast hash set of benchmark word windows against every window of every text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, rebuild_rows, save, unused, window_hashes, word_hashes

#: Bytes of benchmark text up to which its windows are looked for at once (they take some 100 MB of a worker); beyond, they go block by block.
BLOCK_BYTES = 16 << 20

# Bytes: A-Z to lower case; 0-9, a-z and all of 80-FF stay; everything else becomes a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class WindowSet:
    """The windows of a bounded set of items: sorted hashes to find them by, the items' words to verify them with. Some 30 bytes a word in all."""

    def __init__(self, items: Iterable[tuple[object, str | None]], n: int = 10):
        self.names, texts, lengths, hashes = [], [], [], []
        for item_id, text in items:
            words = words_of(text)
            if words:
                self.names.append(item_id)
                texts.append(b" ".join(words))
                lengths.append(len(words))
                hashes.append(word_hashes(words))
        self.text = b" ".join(texts)
        ends = np.flatnonzero(np.frombuffer(self.text + b" ", np.uint8) == 32)
        self.ends, self.begins = ends, np.r_[0, ends[:-1] + 1] if len(ends) else ends
        self.first = np.r_[0, np.cumsum(lengths)].astype(np.int64)  # of each item, the number of its first word
        self.by: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for m in sorted({min(n, k) for k in lengths}):
            of = [i for i, k in enumerate(lengths) if min(n, k) == m]
            found = np.concatenate([window_hashes(hashes[i], m) for i in of])
            places = np.concatenate([np.arange(self.first[i], self.first[i + 1] - m + 1) for i in of])
            order = np.argsort(found, kind="stable")
            self.by[m] = found[order], places[order]

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set]:
        """Which words are inside a window of an item, and those items."""
        hit, items = np.zeros(len(words), bool), set()
        hashes = word_hashes(words)
        known: dict[tuple[int, int, bytes], bool] = {}
        for m, (keys, places) in self.by.items():
            if len(words) < m:
                continue
            found = window_hashes(hashes, m)
            at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            for i in np.flatnonzero(keys[at] == found).tolist():
                window, code = b" ".join(words[i : i + m]), int(found[i])
                if (m, code, window) not in known:  # the hash finds, the words decide; a window that comes again is known
                    same = [p for p in places[at[i] : np.searchsorted(keys, found[i], "right")].tolist() if self.text[self.begins[p] : self.ends[p + m - 1]] == window]
                    items.update(self.names[k] for k in set((np.searchsorted(self.first, same, "right") - 1).tolist()))
                    known[m, code, window] = bool(same)
                if known[m, code, window]:
                    hit[i : i + m] = True
        return hit, items


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """WindowSets, each of at most `block_bytes` of text (or of one item), read one after the other: the size is checked, not assumed."""
    sized = benchmark.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("t"))
    total = sized.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_blocks = int(total // block_bytes) + 1
    if n_blocks == 1:
        yield sized.collect()
        return
    # Twice as many blocks as needed, by hash: one that still comes out too large is read as an iterator, in parts.
    parts = sized.withColumn("part", F.pmod(F.xxhash64("item", "t"), F.lit(2 * n_blocks)))
    for part in range(2 * n_blocks):
        held, size = [], 0
        for row in parts.where(F.col("part") == part).select("item", "t").toLocalIterator():
            held.append(row)
            size += len(row.t)
            if size >= block_bytes:
                yield held
                held, size = [], 0
        if held:
            yield held


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs -> (doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans), one row per row of `docs`.

    Words: runs of 0-9, a-z and non-ASCII characters after lower-casing A-Z. An item's windows are its runs of
    `n` words, or the whole of a shorter one. spans: [start, end) of hit word positions. items_sha256: of the found item ids,
    sorted as strings and comma-joined; of the empty string where there are none. Null or wordless texts: zeros.
    Items that are null or wordless never match; a null item_id never counts. Repeated items count once an id; repeated documents
    keep a row each. Very long texts are scanned whole, one at a time. Empty tables: no rows, or rows without hits. Other columns are not read, whatever
    their names. A benchmark above `block_bytes` of text, whose windows take some six times that in a worker, is scanned in several passes.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    span = "array<struct<start: int, end: int>>"
    schema = f"doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, spans {span}"
    blocks = _blocks(benchmark.where(F.col(item_col).isNotNull()), item_col, item_text_col, block_bytes)
    first, second = next(blocks, []), next(blocks, None)

    def told(doc_id, hit, items):
        n_hit = int(hit.sum())
        return doc_id, len(hit), n_hit, len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), n_hit > 0, spans_of(hit)

    if second is None:
        shared = spark.sparkContext.broadcast([(r[0], r[1]) for r in first])

        def make():
            known = WindowSet(shared.value, n)

            def one(doc_id, text):
                yield told(doc_id, *known.hits(words_of(text)))

            return one

        return map_rows(docs, make, schema)

    docs = save(docs.withColumn("at", F.monotonically_increasing_id()))  # saved: each pass sees the same rows under the same numbers
    found = docs.select("at", F.lit(None).cast(span).alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    for rows in chain((first, second), blocks):
        shared = spark.sparkContext.broadcast([(r[0], r[1]) for r in rows])

        def search(shared=shared):
            known = WindowSet(shared.value, n)

            def one(at, text):
                hit, items = known.hits(words_of(text))
                if items:
                    yield at, spans_of(hit), sorted(items)

            return one

        found = found.unionByName(save(map_rows(docs.select("at", "text"), search, f"at bigint, spans {span}, items array<string>")))
        shared.destroy()
    # A row's lists are bounded by its text and the items in it.
    found = found.groupBy("at").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def finish():
        def one(doc_id, text, spans, items):
            hit = np.zeros(len(words_of(text)), bool)
            for s in spans:
                hit[s["start"] : s["end"]] = True
            yield told(doc_id, hit, items)

        return one

    return map_rows(docs.join(found, "at").select("doc_id", "text", "spans", "items"), finish, schema)


def spans_of(hit: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = 10, max_hit_ratio: float = 0.5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without what the benchmark holds: hit spans are cut out of the text; a row goes where over `max_hit_ratio` of its words are hit.

    All columns stay, whatever their names; a text without a hit stays as it is to the byte. Null and empty texts stay; repeated rows go alike. Very
    long texts are held whole, one at a time. Empty tables: no rows, or all rows as they are. A benchmark above `block_bytes`
    is looked for in passes over the same original texts; their hits are put together before the ratio is judged and the text is cut, once.
    """
    spark = docs.sparkSession
    benchmark = benchmark.where(F.col(item_col).isNotNull())
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    first, second = next(blocks, []), next(blocks, None)

    def left(text, hit):
        if not hit.any():
            return (text,)
        return None if hit.mean() > max_hit_ratio else (cut(text, hit),)

    if second is None:
        shared = spark.sparkContext.broadcast([(r[0], r[1]) for r in first])

        def make():
            known = WindowSet(shared.value, n)
            return lambda text: left(text, known.hits(words_of(text))[0])

        return rebuild_rows(docs, make, text_col)

    columns = docs.columns
    at, spans = (unused(x, columns) for x in ("at", "spans"))
    docs = save(docs.withColumn(at, F.monotonically_increasing_id()))  # saved: each pass sees the same rows under the same numbers
    found = None
    for rows in chain((first, second), blocks):
        shared = spark.sparkContext.broadcast([(r[0], r[1]) for r in rows])

        def search(shared=shared):
            known = WindowSet(shared.value, n)

            def one(row, text):
                hit, _ = known.hits(words_of(text))
                if hit.any():
                    yield row, spans_of(hit)

            return one

        part = save(map_rows(docs.select(at, text_col), search, f"{at} bigint, {spans} array<struct<start: int, end: int>>"))
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    found = found.groupBy(at).agg(F.flatten(F.collect_list(spans)).alias(spans))  # bounded by one text

    def rebuild():
        def one(text, hits):
            hit = np.zeros(len(words_of(text)), bool)
            for s in hits or ():
                hit[s["start"] : s["end"]] = True
            return left(text, hit)

        return one

    return rebuild_rows(docs.join(found, at, "left").select(*columns, spans), rebuild, text_col, beside=spans)


def cut(text: str, hit: np.ndarray) -> str:
    """The text without its hit words and what stands between neighbouring ones."""
    raw = text.encode("utf-8", "surrogatepass")
    word = np.frombuffer(raw.translate(_FOLD), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.r_[False, word, False].astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    kept, last = [], 0
    for s in spans_of(hit):
        kept.append(raw[last : begin[s["start"]]])
        last = int(end[s["end"] - 1])
    kept.append(raw[last:])
    return b"".join(kept).decode("utf-8", "surrogatepass")
