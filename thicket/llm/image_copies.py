"""Copies of images, cropped or edited, by local descriptors.

Corners on several scales, each turned to the direction of its intensity centroid, are described by 256 binary comparisons of a smoothed
image. Hamming tables: eight overlapping words of 48 bits of a descriptor. Descriptors that agree on all bits of a word and differ in at
most MOST_BITS in all meet; images in which at least LEAST_SHARED descriptors do so are matched whole, and count as copies if enough matches agree on one
similarity transform. Tables are made of a block of images at a time, past which the others stream where they lie.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, drop_saved, give_back, map_rows, save
from .graph import Roots, components

#: Production parameters: longest side looked at, scales, radius of a patch, descriptors that must meet in the tables.
SIDE, SCALES, RADIUS, LEAST_SHARED = 256, (1.0, 0.84, 0.71, 0.59), 8, 8
#: Most differing bits of a match, least matches that agree (beyond one in CHANCE, which do by chance), their tolerance in pixels of the scale.
MOST_BITS, LEAST_INLIERS, CHANCE, TOLERANCE = 40, 8, 100, 2.5
_TURNS = 32
#: Bounds on memory alone: cells of a matrix of two images' features at once, features of a block of images, matches looked at in one go,
#: features looked up together. Bits of the hash by which words that no table holds are told.
_CELLS, BLOCK_FEATURES, _HITS, _GROUP, _SLOTS = 1 << 18, 1 << 19, 1 << 17, 1 << 13, 23


def decode(data: bytes | None) -> np.ndarray | None:
    """Grey pixels, 0 to 255, of a binary PGM or PPM or a non-interlaced 8-bit PNG; None for what cannot be read."""
    try:
        if data is None:
            return None
        if data[:2] in (b"P5", b"P6"):
            at, fields = 2, []
            while len(fields) < 3:
                while data[at : at + 1].isspace():
                    at += 1
                if data[at : at + 1] == b"#":
                    at = data.index(b"\n", at)
                    continue
                end = at
                while not data[end : end + 1].isspace():
                    end += 1
                fields.append(int(data[at:end]))
                at = end
            w, h, top = fields
            channels = 1 if data[:2] == b"P5" else 3
            if not 0 < top < 256 or w * h == 0:
                return None
            pixels = np.frombuffer(data, np.uint8, w * h * channels, at + 1).reshape(h, w, channels) * np.float32(255 / top)
        elif data[:8] == b"\x89PNG\r\n\x1a\n":
            pixels = _png(data)
        else:
            return None
        return pixels[:, :, 0] if pixels.shape[2] < 3 else pixels[:, :, :3] @ np.array([0.299, 0.587, 0.114], np.float32)
    except (ValueError, IndexError, KeyError, zlib.error):
        return None


def _png(data: bytes) -> np.ndarray:
    at, body, palette, head = 8, b"", None, b""
    while at < len(data):
        size, kind = int.from_bytes(data[at : at + 4]), data[at + 4 : at + 8]
        part = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = part
        elif kind == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body += part
        at += 12 + size
    w, h, depth, color, lace = int.from_bytes(head[:4]), int.from_bytes(head[4:8]), head[8], head[9], head[12]
    n = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[color]
    if depth != 8 or lace:
        raise ValueError("unsupported PNG")
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * n)
    out, above = np.zeros((h, w, n), np.uint8), np.zeros((w, n), np.int64)
    for y in range(h):
        line, kind = raw[y, 1:].reshape(w, n).astype(np.int64), raw[y, 0]
        if kind == 1:
            line = np.cumsum(line, 0)
        elif kind == 2:
            line = line + above
        elif kind in (3, 4):
            left, corner = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for x in range(w):
                up = above[x]
                if kind == 3:
                    guess = (left + up) // 2
                else:
                    p = left + up - corner
                    a, b, c = abs(p - left), abs(p - up), abs(p - corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
                left, corner = (line[x] + guess) & 255, up
                line[x] = left
        above = line & 255
        out[y] = above
    return (palette[out[:, :, 0]] if color == 3 else out).astype(np.float32)


@cache
def _resizer(old: int, new: int) -> np.ndarray:
    """Weights [new, old] of area sampling."""
    edge = np.linspace(0, old, new + 1)
    out = np.minimum(edge[1:, None], np.arange(1, old + 1)) - np.maximum(edge[:-1, None], np.arange(old))
    out = np.maximum(out, 0).astype(np.float32)
    return out / out.sum(1, keepdims=True)


def resize(image: np.ndarray, h: int, w: int) -> np.ndarray:
    return _resizer(image.shape[0], h) @ image @ _resizer(image.shape[1], w).T


def _blur(image: np.ndarray, kernel: tuple[float, ...]) -> np.ndarray:
    r = len(kernel) // 2
    p = np.pad(image, r, mode="edge")
    h, w = image.shape
    p = sum(k * p[i : i + h] for i, k in enumerate(kernel))
    return sum(k * p[:, i : i + w] for i, k in enumerate(kernel))


_G5 = (0.0625, 0.25, 0.375, 0.25, 0.0625)


@cache
def _pattern() -> tuple[np.ndarray, np.ndarray]:
    """The comparisons, turned: rows and columns [_TURNS, 256, 2]; points from a fixed rule, spread like a normal law in the patch."""
    rng = np.random.Generator(np.random.PCG64(20240229))
    points = np.clip(rng.normal(0, RADIUS / 2.2, (256, 2, 2)), -RADIUS * 0.7, RADIUS * 0.7)
    turn = np.arange(_TURNS) * 2 * np.pi / _TURNS
    c, s = np.cos(turn)[:, None, None], np.sin(turn)[:, None, None]
    y, x = points[None, :, :, 0], points[None, :, :, 1]
    return np.rint(s * x + c * y).astype(np.int64), np.rint(c * x - s * y).astype(np.int64)


@cache
def _disc() -> tuple[np.ndarray, np.ndarray]:
    y, x = np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1]
    inside = x * x + y * y <= RADIUS * RADIUS
    return y[inside], x[inside]


def describe(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(descriptors [n, 4] of 64 bits, places [n, 4]: x, y, size, angle, in pixels of the image given)."""
    h, w = image.shape
    most = max(h, w)
    if most > SIDE:
        image = resize(image, max(1, round(h * SIDE / most)), max(1, round(w * SIDE / most)))
    base = w / image.shape[1]
    rows, cols = _pattern()
    dy, dx = _disc()
    bits, places = [], []
    for scale in SCALES:
        hh, ww = round(image.shape[0] * scale), round(image.shape[1] * scale)
        if min(hh, ww) <= 2 * RADIUS + 2:
            continue
        level = _blur(image if scale == 1 else resize(image, hh, ww), _G5)
        gy, gx = np.gradient(level)
        a, b, c = _blur(gx * gx, _G5), _blur(gy * gy, _G5), _blur(gx * gy, _G5)
        answer = a * b - c * c - 0.05 * (a + b) ** 2
        m = RADIUS
        inner = answer[m : hh - m, m : ww - m]
        top = np.ones(inner.shape, bool)
        for oy in (-1, 0, 1):
            for ox in (-1, 0, 1):
                if oy or ox:
                    top &= inner > answer[m + oy : hh - m + oy, m + ox : ww - m + ox]
        ys, xs = np.nonzero(top & (inner > 1.0))
        if not len(ys):
            continue
        ys, xs = ys + m, xs + m
        patch = level[ys[:, None] + dy, xs[:, None] + dx]
        angle = np.arctan2((patch * dy).sum(1), (patch * dx).sum(1))
        turn = np.rint(angle / (2 * np.pi) * _TURNS).astype(np.int64) % _TURNS
        smooth = _blur(level, _G5)
        at = smooth[ys[:, None, None] + rows[turn], xs[:, None, None] + cols[turn]]
        bits.append(np.packbits(at[:, :, 0] < at[:, :, 1], axis=1).view(np.uint64))
        places.append(np.stack([(xs + 0.5) / scale * base, (ys + 0.5) / scale * base, np.full(len(xs), base / scale), angle], 1))
    if not bits:
        return np.empty((0, 4), np.uint64), np.empty((0, 4))
    return np.concatenate(bits), np.concatenate(places)


def words(bits: np.ndarray) -> Iterator[np.ndarray]:
    """The eight overlapping words of 48 bits of each descriptor, a word of all at a time."""
    half = np.ascontiguousarray(bits).view(np.uint32)
    for t in range(8):
        yield half[:, t] | (half[:, (t + 1) % 8] & np.uint64(0xFFFF)) << np.uint64(32)


def copies(bits_a: np.ndarray, at_a: np.ndarray, bits_b: np.ndarray, at_b: np.ndarray) -> int:
    """How many matches of two images agree on one similarity transform, less one in CHANCE of all matches; 0 where too few do."""
    if not len(bits_a) or not len(bits_b):
        return 0
    found, step = [], max(1, _CELLS // len(bits_b))
    for lo in range(0, len(bits_a), step):
        apart = np.zeros((len(bits_a[lo : lo + step]), len(bits_b)), np.uint16)
        for k in range(bits_a.shape[1]):
            apart += np.bitwise_count(bits_a[lo : lo + step, None, k] ^ bits_b[None, :, k])
        least = apart.min(1, keepdims=True)
        i, j = np.nonzero((apart == least) & (least <= MOST_BITS))
        found.append((i + lo, j))
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    if len(i) < LEAST_INLIERS:
        return 0
    p, q = at_a[i].astype(np.float64), at_b[j].astype(np.float64)
    size, turn = q[:, 2] / p[:, 2], q[:, 3] - p[:, 3]
    # Each match proposes a transform; the places of all others are held against it.
    uc, us, log = np.cos(turn), np.sin(turn), np.log(size)
    c, s = size * uc, size * us
    chance = len(i) // CHANCE
    near, most = None, LEAST_INLIERS + chance - 1
    step = max(1, _CELLS // len(i))
    for lo in range(0, len(i), step):
        k = np.arange(lo, min(lo + step, len(i)))
        alike = (abs(log[k, None] - log) < 0.35) & (uc[k, None] * uc + us[k, None] * us > 0.9)
        k, alike = (x[alike.sum(1) > most] for x in (k, alike))
        if not len(k):
            continue
        ox, oy = p[:, 0] - p[k, None, 0], p[:, 1] - p[k, None, 1]
        ex = c[k, None] * ox - s[k, None] * oy + q[k, None, 0] - q[:, 0]
        ey = s[k, None] * ox + c[k, None] * oy + q[k, None, 1] - q[:, 1]
        agree = alike & (ex * ex + ey * ey <= (TOLERANCE * np.maximum(q[:, 2], 1) + 0.1 * np.sqrt(ox * ox + oy * oy)) ** 2)
        counts = agree.sum(1)
        if counts.max() > most:
            near, most = agree[counts.argmax()], counts.max()
    if near is None:
        return 0
    return max(0, min(len(set(i[near].tolist())), len({tuple(x) for x in np.rint(at_b[j[near], :2]).tolist()}), len({tuple(x) for x in np.rint(at_a[i[near], :2]).tolist()})) - chance)


class Tables:
    """Hamming tables of a bounded set of images (node, bits, places), to find those that share descriptors with another image."""

    def __init__(self, images: list[tuple[int, np.ndarray, np.ndarray]]):
        self.nodes = np.array([node for node, _, _ in images], np.int64)
        self.bits, places = (np.concatenate([r[k] for r in images]) for k in (1, 2))
        edges = np.r_[0, np.cumsum([len(bits) for _, bits, _ in images])].tolist()
        self.images = [(r[0], self.bits[a:b], places[a:b]) for r, a, b in zip(images, edges, edges[1:], strict=False)]
        self.owner = np.repeat(np.arange(len(images), dtype=np.int32), [len(bits) for _, bits, _ in images])
        self.order = np.empty((8, len(self.bits)), np.int32)
        self.tables = []
        for cut, order in zip(words(self.bits), self.order, strict=True):
            order[:] = np.argsort(cut, kind="stable")
            cut = cut[order]
            starts = np.flatnonzero(np.r_[True, cut[1:] != cut[:-1]]).astype(np.int32)
            filled = np.zeros(1 << _SLOTS, bool)
            filled[self._slots(cut)] = True
            self.tables.append((cut[starts], np.r_[starts, np.int32(len(cut))], np.packbits(filled, bitorder="little")))

    @staticmethod
    def _slots(cut: np.ndarray) -> np.ndarray:
        return (cut * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _SLOTS)).view(np.int64)

    def _met(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where descriptors agree on a word with some that are held: the descriptors, in order, the first such place in `order`, laid flat, and how many."""
        met = []
        for t, (own, (keys, starts, filled)) in enumerate(zip(words(bits), self.tables, strict=True)):
            slot = self._slots(own)
            some = np.flatnonzero(filled[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)  # most other words are held nowhere
            some = some[np.argsort(own[some])]  # looked up in order: neighbours lie together in memory
            at = np.minimum(np.searchsorted(keys, own[some]), len(keys) - 1)
            held = keys[at] == own[some]
            some, at = some[held], at[held]
            met.append((some, starts[at] + np.int64(t * len(self.bits)), starts[at + 1] - starts[at]))
        of, low, size = (np.concatenate(x) for x in zip(*met, strict=True))
        by = np.argsort(of, kind="stable")
        return of[by], low[by], size[by].astype(np.int64)

    def sharing(self, given: list[np.ndarray]) -> list[np.ndarray]:
        """For each image's descriptors, positions of the images of which at least LEAST_SHARED of them meet one within MOST_BITS, those with the most first."""
        bits, many = np.concatenate(given), len(self.images)
        image = np.repeat(np.arange(len(given)), [len(x) for x in given])
        of, low, size = self._met(bits)
        ends = np.cumsum(size)

        def near(lo: int, hi: int) -> np.ndarray:
            """Distinct (descriptor, held image) in one number."""
            i, n = np.repeat(of[lo:hi], size[lo:hi]), size[lo:hi]
            j = self.order.reshape(-1)[np.arange(len(i)) + np.repeat(low[lo:hi] - np.cumsum(n) + n, n)]
            apart = np.bitwise_count(bits[i] ^ self.bits[j])
            close = apart[:, 0] + apart[:, 1] + apart[:, 2] + apart[:, 3] <= MOST_BITS  # 208 at most, as a word agrees
            return _distinct(i[close] * many + self.owner[j[close]])

        pairs, counts, lo = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
        while lo < len(of):  # a descriptor's matches at least, some _HITS at once
            hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _HITS, "right"))
            hi = int(np.searchsorted(of, of[hi])) if hi < len(of) else hi
            if hi > lo:
                found = near(lo, hi)
            else:  # one descriptor that has more, a word at a time
                hi = int(np.searchsorted(of, of[lo], "right"))
                found = _distinct(np.concatenate([near(k, k + 1) for k in range(lo, hi)]))
            found, count = np.unique(image[found // many] * many + found % many, return_counts=True)
            pairs.append(found)
            counts.append(count)
            lo = hi
        pairs, where = np.unique(np.concatenate(pairs), return_inverse=True)
        count = np.bincount(where, np.concatenate(counts), len(pairs))
        pairs, count = pairs[count >= LEAST_SHARED], count[count >= LEAST_SHARED]
        pairs = pairs[np.lexsort((-count, pairs // many))]
        edges = np.searchsorted(pairs // many, np.arange(len(given) + 1))
        return [pairs[a:b] % many for a, b in zip(edges, edges[1:], strict=False)]


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def _groups(images: Iterable[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
    """Images that have descriptors, some _GROUP descriptors together."""
    held, n = [], 0
    for r in images:
        if len(r[1]):
            held.append(r)
            n += len(r[1])
        if n >= _GROUP:
            yield held
            held, n = [], 0
    if held:
        yield held


def link(held: Tables, given: Iterable[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int]]:
    """Links (a, b) between given and held images (node, bits, places) that are copies, spanning every component of these pairs.

    A given image that is held itself is compared with smaller nodes alone.
    """
    roots, inside = Roots(), set(held.nodes.tolist())
    for some in _groups(given):
        for (node, bits, places), shares in zip(some, held.sharing([r[1] for r in some]), strict=True):
            for y in shares.tolist():
                other, *features = held.images[y]
                if other == node or node in inside and other > node or roots.find(other) == roots.find(node):
                    continue
                # The larger node's features are matched to the smaller's, whichever of the two is held.
                pair = ((bits, places), features) if node > other else (features, (bits, places))
                if copies(*pair[0], *pair[1]) >= LEAST_INLIERS:
                    roots[roots.find(node)] = roots.find(other)
                    yield node, other


_tables: dict[str, Tables] = {}


def _features(bits: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(bits, np.uint64).reshape(-1, 4), np.frombuffer(places, np.float32).reshape(-1, 4)


def image_copies(images: DataFrame, id_col: str = "image_id", image_col: str = "image", block_features: int = BLOCK_FEATURES) -> DataFrame:
    """images -> (image_id, class_id, n_keypoints), one row per row of `images`; class_id: the smallest id reachable through copies.

    Images that decode to the same pixels are copies at once. Null, unreadable or featureless images have 0 keypoints and, where no
    pixels are shared, a class of their own. Null id: null class. Rows that repeat an id each take the class of their own pixels. Empty table:
    no rows. Other columns are not read, whatever their names. An image above SIDE pixels is looked at in that size, however large.
    Every corner above the response threshold describes an image, so that a crop keeps those of its area.

    Scale: pixel copies are one node, found by narrow digests; only nodes are described, once, and their features written. Blocks of
    `block_features` are broadcast in turn, a bound checked by count, as tables past which the features from that block on stream where they
    lie: nothing is shuffled, no list is gathered and any two images meet once. The passes grow with the images, the work with their square,
    by a lookup in the tables an image and block; whole images are matched for those alone that share descriptors.
    """
    spark = images.sparkSession
    images = images.select(F.col(id_col).cast("bigint").alias("image_id"), F.col(image_col).alias("image"))

    def digest_of(pixels: np.ndarray) -> bytes:
        return hashlib.md5(repr(pixels.shape).encode() + np.rint(pixels).astype(np.uint8).tobytes()).digest()

    def see():
        def one(image_id, data):
            pixels = decode(data) if image_id is not None else None
            yield image_id, digest_of(pixels) if pixels is not None else None

        return one

    def make():
        _tables.clear()  # of an earlier run in this worker

        def one(image_id, data, digest, node):
            pixels = decode(data)
            if pixels is not None and digest_of(pixels) == digest:
                bits, at = describe(pixels)
                yield node, len(bits), bits.tobytes(), at.astype(np.float32).tobytes()

        return one

    rows = save(map_rows(images, see, "image_id bigint, digest binary"))
    firsts = save(rows.where("digest is not null").groupBy("digest").agg(F.min("image_id").alias("image_id")).withColumn("node", F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("bigint")))
    with batches_of(spark, 512):
        nodes = save(map_rows(images.join(firsts, "image_id").select("image_id", "image", "digest", "node"), make, "node bigint, n_keypoints int, bits binary, places binary"))
    total = nodes.agg(F.sum("n_keypoints")).first()[0] or 0
    n_blocks = -(-total // block_features)
    block = F.pmod(F.xxhash64("node"), F.lit(max(1, n_blocks)))
    links = None
    for k in range(n_blocks):
        held = [tuple(r) for r in nodes.where((block == k) & (F.col("n_keypoints") > 0)).select("node", "bits", "places").collect()]  # some block_features
        if not held:
            continue
        shared, name = spark.sparkContext.broadcast(held), uuid.uuid4().hex

        def across(batches: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            if name not in _tables:  # once a worker and pass
                _tables.clear()
                give_back()
                _tables[name] = Tables([(node, *_features(bits, places)) for node, bits, places in shared.value])
                vars(shared).pop("_value", None)  # the tables have their own copy
                give_back()
            given = ((node, *_features(bits, places)) for batch in batches for lo in range(0, batch.num_rows, 256) for node, bits, places in zip(*(c.to_pylist() for c in batch.slice(lo, 256).columns), strict=True))
            pairs = link(_tables[name], given)
            while part := list(islice(pairs, 10_000)):
                yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in part], pa.int64()), "b": pa.array([b for _, b in part], pa.int64())})

        with batches_of(spark, 512):
            found = save(nodes.where(block >= k).select("node", "bits", "places").mapInArrow(across, "a bigint, b bigint"))
        links = found if links is None else links.unionByName(found)
        shared.destroy()
        del held
    give_back()
    sized = firsts.join(nodes.groupBy("node").agg(F.max("n_keypoints").alias("n_keypoints")), "node", "left")
    joined = components(links) if links is not None else spark.createDataFrame([], "node bigint, component bigint")
    sized = sized.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = sized.join(sized.groupBy("component").agg(F.min("image_id").alias("class_id")), "component").select("digest", "class_id", "n_keypoints")
    known = save(known)
    drop_saved(nodes)
    return rows.join(known, "digest", "left").select("image_id", F.coalesce("class_id", "image_id").alias("class_id"), F.coalesce("n_keypoints", F.lit(0)).alias("n_keypoints"))


@cache
def _grains(side: int) -> np.ndarray:
    """64 fixed fields of smooth noise [64, side, side]."""
    noise = np.random.Generator(np.random.PCG64(64)).normal(0, 1, (64, side, side))
    return np.stack([_blur(_blur(_blur(n, _G5), _G5), _G5) for n in noise])


def picture(vector: list[float] | None, side: int = 64) -> bytes | None:
    """A picture, as PGM, of a vector of 64 numbers: the weights of 64 fields of noise. Other lengths are folded."""
    if vector is None:
        return None
    v = np.nan_to_num(np.array([x if x is not None else 0 for x in vector], np.float64))
    field = np.tensordot(np.pad(v, (0, -len(v) % 64)).reshape(-1, 64).sum(0), _grains(side), 1)
    top = abs(field).max()
    return b"P5 %d %d 255\n" % (side, side) + np.rint(127.5 + 127 * field / (top or 1)).astype(np.uint8).tobytes()


def pictures(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vectors -> (image_id, image): a picture of each row's vector."""

    def make():
        def one(vec_id, vector):
            yield vec_id, picture(vector)

        return one

    return map_rows(vectors.select(F.col(id_col).cast("bigint").alias("i"), F.col(vector_col).alias("v")), make, "image_id bigint, image binary")
