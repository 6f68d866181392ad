"""N-gram Jaccard self-join: exact links at a Jaccard threshold over distinct word shingles, by T-occurrence search.

1. One pass over the texts hashes every n-word shingle to 64 bits and forms the set's size and digest. Sets with one digest are copies:
   only one node of them goes on.
2. Routing by prefix filter. All shingles are put in one order; two linked sets share one of their first |x| - ceil(t * |x|) + 1. That holds
   for any order. Here a fixed part of all shingles, by hash, comes first, and among these the rarest: so frequencies are needed of that part
   alone, and what many texts hold, a common passage say, comes last and joins nothing. Sets of like size that share a prefix shingle,
   directly or through others, form a family.
3. Search. A family's sets are indexed in inverted lists and searched by DivideSkip (Li, Lu, Lu 2008): the longest lists are set aside,
   the short ones merged over a heap, and the sets that reach the remaining count looked up in the long lists by binary search.
   A family above `block_shingles` is searched in rounds: each indexes a block of it and streams the whole family past the index.
   What a round joins into the family's largest component needs no index of its own, so a large group of near copies takes few rounds.
4. A pair already in one component is not probed again; the found links span every component.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_saved, map_rows, mix, save, window_hashes, word_hashes
from .graph import Roots, components

#: Fixed value: the weight of a binary probe against a merge step in DivideSkip.
MU = 0.0085
#: Fixed value: how many times a prefix the part of the shingles is that comes first in the common order: it sets the work, never the result.
FIRST = 2


def shingles(text: str | None, n: int = 3) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the n-word shingles; a text of fewer words is one shingle, one without words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z alone become lower case, and 20, 09-0D split
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words), min(n, len(words))))


def least_overlap(total: int, percent: int) -> int:
    """The smallest intersection of two sets with `total` elements together that links them."""
    return -(-percent * total // (100 + percent))


def bands(size: int, percent: int) -> list[tuple[int, int]]:
    """(band, prefix length) of a set: the band of its size and, if it can have a larger partner there, the next, for which it needs fewer.

    Bands are so wide that linked sets are in one or in neighbouring ones; two sets meet in the band of the larger one.
    """
    ratio = 1.008 * 100 / percent
    band = max(0, int(math.log(size) / math.log(ratio)) - 1)
    while math.ceil(ratio ** (band + 1)) <= size:
        band += 1
    both = ((band, -(-percent * size // 100)), (band + 1, math.ceil(ratio ** (band + 1))))
    return [(b, size - min(size, least_overlap(size + least, percent)) + 1) for b, least in both if 100 * size >= percent * least]


def split(found: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(the shingles that come first in the common order, sorted by hash; codes of those after them that a set too poor in first ones needs).

    A code is a shingle and a band.
    """
    mark = mix(found ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    order = np.argsort(mark, kind="stable")
    n_first = int(np.searchsorted(mark[order], np.uint64(min(1.0, FIRST * (100 - percent) / 100) * 0xFFFFFFFF) << np.uint64(32)))
    rest = order[n_first:]
    more = [mix(found[rest[: max(0, length - n_first)]] ^ np.uint64((b + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) for b, length in bands(len(found), percent)]
    return found[order[:n_first]], np.concatenate(more)


class Index:
    """Inverted lists of the shingles of a bounded number of sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        shingle, owner = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)
        order = np.lexsort((owner, shingle))
        shingle, self.members = shingle[order], owner[order]
        starts = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]]) if len(shingle) else np.empty(0, np.int64)
        self.shingles, self.starts = shingle[starts], starts
        self.lengths = np.diff(np.r_[starts, len(shingle)])
        # Entries as (list, owner) in one sorted row: a list is probed for an owner by a binary search in it.
        self.entries = np.repeat(np.arange(len(starts)), self.lengths) * len(sets) + self.members

    def search(self, own: np.ndarray, percent: int, wanted: Callable[[np.ndarray], np.ndarray] = lambda seen: np.ones(len(seen), bool)) -> Iterator[int]:
        """DivideSkip: the positions of the sets that link to `own`, likeliest first. wanted: which of some positions are still to be probed."""
        n = len(own)
        if not n or not len(self.shingles):
            return
        at = np.minimum(np.searchsorted(self.shingles, own), len(self.shingles) - 1)
        lists = at[self.shingles[at] == own]
        need = least_overlap(n + -(-percent * n // 100), percent)
        if len(lists) < need:
            return
        lists = lists[np.argsort(self.lengths[lists], kind="stable")]
        n_long = min(need - 1, int(need / (MU * math.log2(max(2, self.lengths[lists[-1]])) + 1)))
        short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
        seen, count = _merged([self.members[self.starts[i] : self.starts[i] + self.lengths[i]] for i in short.tolist()])
        size = self.sizes[seen]
        keep = (count >= need - n_long) & (100 * size >= percent * n) & (100 * n >= percent * size)
        seen, count = seen[keep], count[keep]
        order = np.argsort(-count, kind="stable")
        seen, count = seen[order], count[order]
        while len(seen):
            left = wanted(seen)
            seen, count = seen[left], count[left]
            part, many, seen, count = seen[:32], count[:32], seen[32:], count[32:]
            probed = long[:, None] * len(self.sizes) + part
            place = np.minimum(np.searchsorted(self.entries, probed), len(self.entries) - 1)
            both = many + (self.entries[place] == probed).sum(0)
            yield from part[100 * both >= percent * (n + self.sizes[part] - both)].tolist()


def _merged(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(members, on how many lists) of sorted lists: a heap gives the two shortest, which are merged and go back."""
    heap = [(len(x), i, x) for i, x in enumerate(lists)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, _, b = heap[0]
        heapq.heapreplace(heap, (len(a) + len(b), i, np.sort(np.concatenate((a, b)), kind="stable")))  # two sorted runs: one merge
    return np.unique(heap[0][2], return_counts=True)


def link(held: list[tuple[int, int, np.ndarray]], given: Iterable[tuple[int, int, np.ndarray]], percent: int) -> Iterator[tuple[int, int]]:
    """Links between given and held sets (node, known component, shingles), spanning every component of these pairs."""
    index, roots = Index([x for _, _, x in held]), Roots()
    nodes, joined = (np.array(x, np.int64) for x in zip(*[r[:2] for r in held], strict=True))  # joined: each held set's component by now
    inside = set(nodes.tolist())
    for node, known, own in given:
        below = node if node in inside else np.iinfo(np.int64).max  # of two held sets, the larger one asks

        def wanted(seen: np.ndarray, node=node, known=known, below=below) -> np.ndarray:
            return (joined[seen] != roots.find(known)) & (nodes[seen] < below) & (nodes[seen] != node)

        for y in index.search(own, percent, wanted):
            mine, its = roots.find(known), int(joined[y])
            if mine != its:
                roots[mine] = roots.find(its)
                joined[joined == mine] = its
                yield node, int(nodes[y])


def pairs_of(found: Iterable[tuple[int, int]], most: int = 10_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int]] = []
    for pair in found:
        held.append(pair)
        if len(held) >= most:
            yield _pairs(held)
            held = []
    yield _pairs(held)


def _pairs(held: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in held], pa.int64()), "b": pa.array([b for _, b in held], pa.int64())})


def _families(sent: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(node, first, more) of each set, nodes (node, first, size, n_first) -> (family, node, first, size) of the sets that share a code with another."""
    rows = sent.select("node", F.explode("first").alias("shingle"))
    shared = rows.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    common = rows.join(shared, "shingle")

    def banded():
        def one(node, size, n_first):
            for band, length in bands(size, percent):
                yield node, band, n_first - min(length, n_first)

        return one

    spared = map_rows(nodes.select("node", "size", "n_first"), banded, "node bigint, band int, spared int")
    # Counted from the end, where the commonest are: so shingles of one set alone, which come first of all, need not be there. Copies count once.
    order = Window.partitionBy("node").orderBy(F.desc("df"), F.desc("shingle"))  # a set's own shingles: bounded by its text
    ranked = common.select("node", "shingle", F.dense_rank().over(order).alias("at"))
    prefix = ranked.join(spared, "node").where("at > spared").select("node", F.xxhash64("shingle", "band").alias("code"))
    prefix = save(prefix.unionAll(sent.select("node", F.explode("more"))))
    hubs = prefix.groupBy("code").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last").select("code", "hub")
    found = components(prefix.join(hubs, "code").where("node > hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct())
    drop_saved(prefix)
    return found.withColumnRenamed("component", "family").join(nodes.drop("n_first"), "node")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 90, n: int = 3, block_shingles: int = 1_000_000) -> DataFrame:
    """docs -> (doc_id, n_shingles, component_id), one row per row of `docs`; other columns are not read.

    Words are what stands between ASCII white space, A-Z in lower case. Two rows link when 100 * |intersection| >= percent * |union| of their
    shingle sets, each shingle as a 64-bit hash of its words. component_id: the smallest id reachable.
    Null or wordless text: n_shingles 0, links with nothing. Null id: null component_id, links nothing. Rows that repeat an
    id are one node with the links of all its texts; each keeps a row. Equal texts (ties) take the smallest id. Very long texts are one set as any
    other, whole. An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def read():
        seen: set[bytes] = set()  # the sets of one task: copies send their shingles once a task

        def one(doc_id, text):
            found = shingles(text, n)
            if not len(found) or doc_id is None:
                yield doc_id, len(found), 0, None, None, None
                return
            digest = hashlib.md5(found.tobytes()).digest()
            first, more = split(found, percent)
            yield doc_id, len(found), len(first), digest, *((None, None) if digest in seen else (first.view(np.int64), more.view(np.int64)))
            seen.add(digest)

        return one

    base = save(map_rows(docs, read, "doc_id bigint, n_shingles bigint, n_first int, digest binary, first array<bigint>, more array<bigint>"))
    # One node a set: its digest's first 8 bytes or, should two digests share these, others.
    firsts = save(base.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("n_shingles").alias("size"), F.max("n_first").alias("n_first")))
    for at in range(9):
        node_of = F.conv(F.hex(F.substring("digest", at + 1, 8)), 16, -10).cast("bigint")
        nodes = firsts.select(node_of.alias("node"), "first", "size", "n_first")
        if nodes.groupBy("node").count().where("count > 1").isEmpty():
            break

    def node_in(found: np.ndarray) -> int:
        return int.from_bytes(hashlib.md5(found.tobytes()).digest()[at : at + 8], "big", signed=True)

    families = save(_families(base.where("first is not null").select(node_of.alias("node"), "first", "more"), nodes, percent))
    families = families.groupBy("family").agg((F.sum("size") > block_shingles).alias("large")).join(families, "family")
    families = save(families.select("family", "large", "node", "first", "size"))
    # The texts of all families, one a set, moved once. Families grow with the input and are never broadcast to the texts.
    held = save(docs.join(families.hint("merge"), docs.doc_id == families["first"]).select("family", "large", "node", "text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first column, node, shingles), of those texts of an id that are the node's."""
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                for key, node, text in zip(*(c.to_pylist() for c in batch.slice(lo, 256).columns), strict=True):
                    found = shingles(text, n)
                    if node_in(found) == node:
                        yield key, node, found

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[int, int]]:
            key, own = None, {}
            for family, node, x in sets(batches):
                if family != key:
                    yield from inner(own)
                    key, own = family, {}
                own[node] = (node, node, x)
            yield from inner(own)

        def inner(own: dict) -> Iterator[tuple[int, int]]:
            return link(list(own.values()), own.values(), percent) if len(own) > 1 else iter(())

        return pairs_of(found())

    small = held.where("not large").select("family", "node", "text").repartition("family").sortWithinPartitions("family", "node")
    links = save(small.mapInArrow(search, "a bigint, b bigint"))
    large = held.where("large").select("family", "node", "text")
    state = save(families.where("large").select("family", "node", "size", F.col("node").alias("component"), F.lit(True).alias("open")))
    scratch = [base, firsts, families, held]
    left = state.agg(F.sum("size")).first()[0] or 0
    turn = 0
    while left:
        # The next block: by hash, of nodes not yet indexed that are outside their family's largest component.
        turn += 1
        blocks = -(-left // block_shingles)
        dealt = state.withColumn("now", F.col("open") & (F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(blocks)) == 0 if blocks > 1 else F.lit(True)))
        texts = large.join(dealt.select("node", "component", "now"), "node").select("component", "node", "text", "now")
        block = spark.sparkContext.broadcast([(r.component, r.node, r.text) for r in texts.where("now").collect()])  # some block_shingles

        def across(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            indexed = {node: (node, known, x) for known, node, text in block.value if node_in(x := shingles(text, n)) == node}
            return pairs_of(link(list(indexed.values()), ((node, known, x) for known, node, x in sets(batches)), percent)) if indexed else iter(())

        links = links.unionByName(save(texts.select("component", "node", "text").mapInArrow(across, "a bigint, b bigint")))
        block.destroy()
        joined = components(links).withColumnRenamed("component", "joined")
        after = dealt.join(joined, "node", "left").select("family", "node", "size", F.coalesce("joined", "node").alias("component"), (F.col("open") & ~F.col("now")).alias("open"))
        largest = after.groupBy("family", "component").agg(F.count("*").alias("c")).groupBy("family").agg(F.max_by("component", F.struct("c", "component")).alias("most"))
        after = save(after.join(largest, "family").withColumn("open", F.col("open") & (F.col("component") != F.col("most"))).drop("most"))
        drop_saved(state)
        state, left = after, after.where("open").agg(F.sum("size")).first()[0] or 0
    # Copies of one set go by its node; the nodes of an id that comes with several texts belong together.
    reps = save(base.join(firsts.select("digest", node_of.alias("node")), "digest", "left").select("doc_id", "n_shingles", "node"))
    several = reps.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high and doc_id is not null")
    same = reps.join(several, "doc_id").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()
    joined = components(links.unionByName(same))
    # A component's id: the smallest document id of its nodes.
    whole = nodes.select("node", "first").join(joined, "node", "left").withColumn("c", F.coalesce("component", "node"))
    least = save(whole.join(whole.groupBy("c").agg(F.min("first").alias("component_id")), "c").select("node", "component_id"))
    for x in scratch:
        drop_saved(x)
    return reps.join(least, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
