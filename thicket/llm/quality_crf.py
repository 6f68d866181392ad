"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. Its evidence is what it and its two neighbours look like (frequencies of character-class pairs, length,
word shape, repetition); transitions tie neighbouring lines together. Forward-backward gives each line's marginal, the mean of
which, weighted by line length, is the document's quality; a two-parameter logistic map turns that into a
probability. Labels exist for documents only: lines start with their document's label, and lines of bad documents that the fitted field
finds good are then relabelled softly and the field fitted again.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, rebuild_rows

#: The character classes.
_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\f\x0b", b".,;:", b"!?", b"$#%&*@^~=+<>{}[]\\_`", b"|", b"()\"'-/"]
_CLASS = np.zeros(256, np.int64)  # 0: a-z and non-ASCII
_CLASS[:97] = _CLASS[123:128] = len(_CLASSES) + 1
for _i, _chars in enumerate(_CLASSES):
    _CLASS[np.frombuffer(_chars, np.uint8)] = _i + 1
N_CLASSES = len(_CLASSES) + 2
N_FEATURES = N_CLASSES * N_CLASSES + 7
_UPPER, _SPACE = 1, 3
#: Lines whose features are held at once.
CHUNK = 1 << 16


def line_chunks(text: str | None):
    """(features [lines, N_FEATURES], lengths in bytes) of the lines, CHUNK at a time; a text without lines is one empty line."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    codes = np.frombuffer(raw, np.uint8)
    ends = np.r_[np.flatnonzero(codes == 10), len(raw)]
    starts = np.r_[0, ends[:-1] + 1]
    marks = np.fromiter((hash(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.int64, len(starts))  # 8 bytes a line
    came = np.ones(len(starts), np.float32)
    came[np.unique(marks, return_index=True)[1]] = 0
    came[starts == ends] = 0
    for lo in range(0, len(starts), CHUNK):
        a, b = starts[lo : lo + CHUNK], ends[lo : lo + CHUNK]
        begin, end, n = int(a[0]), int(b[-1]), len(a)
        cls = _CLASS[codes[begin:end]]
        size = b - a
        line = np.repeat(np.arange(n), np.minimum(size + 1, np.r_[a[1:], end] - a))
        inner = codes[begin:end] != 10
        out = np.zeros((n, N_FEATURES), np.float32)
        if len(cls) > 1:
            pair = inner[:-1] & inner[1:]
            found = np.bincount((line[:-1] * N_CLASSES * N_CLASSES + cls[:-1] * N_CLASSES + cls[1:])[pair], minlength=n * N_CLASSES * N_CLASSES)
            out[:, : N_CLASSES * N_CLASSES] = np.sqrt(found.reshape(n, -1) / np.maximum(size - 1, 1)[:, None])
        if len(cls):
            space = cls == _SPACE
            word = inner & ~space & np.r_[True, (space | ~inner)[:-1]]
            words = np.bincount(line[word], minlength=n)
            upper = np.bincount(line[word & (cls == _UPPER)], minlength=n)
            filled = np.bincount(line[inner & ~space], minlength=n)
        else:
            words = upper = filled = np.zeros(n)
        variety = np.ones(n, np.float32)
        for i in range(n):
            mine = raw[a[i] : b[i]]
            if mine:
                parts = mine.split()
                if len(parts) > 1:
                    variety[i] = len(set(parts)) / len(parts)
        extra = out[:, N_CLASSES * N_CLASSES :]
        extra[:, 0] = np.log1p(size) / 8
        extra[:, 1] = np.minimum(filled / np.maximum(words, 1), 30) / 10
        extra[:, 2] = upper / np.maximum(words, 1)
        extra[:, 3] = came[lo : lo + n]
        extra[:, 4] = variety
        extra[:, 5] = size == 0
        extra[:, 6] = 1
        yield out, size


@dataclass
class Field:
    """weights [N_FEATURES, 3]: of a line's own features, the previous line's, the next line's, as log odds of good; moves[y, y']: transition weights."""

    weights: np.ndarray
    moves: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def evidence(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        parts, sizes = [], []
        for features, size in line_chunks(text):
            parts.append(features @ self.weights)
            sizes.append(size)
        return join_neighbours(np.concatenate(parts)), np.concatenate(sizes)

    def marginals(self, odds: np.ndarray) -> np.ndarray:
        """P(good) of each line, by forward-backward on log odds."""
        (bb, bg), (gb, gg) = self.moves.tolist()
        n, e = len(odds), odds.tolist()
        ahead, back = [0.0] * n, [0.0] * n
        for t in range(1, n):
            x = ahead[t - 1] + e[t - 1]
            ahead[t] = _logsum(x + gg, bg) - _logsum(x + gb, bb)
        for t in range(n - 2, -1, -1):
            x = back[t + 1] + e[t + 1]
            back[t] = _logsum(x + gg, gb) - _logsum(x + bg, bb)
        total = np.clip(odds + np.array(ahead) + np.array(back), -40, 40)
        return 1 / (1 + np.exp(-total))

    def quality(self, text: str | None) -> float:
        """The length-weighted mean of the lines' P(good)."""
        odds, sizes = self.evidence(text)
        return float(np.average(self.marginals(odds), weights=sizes + 1))

    def score(self, text: str | None) -> float:
        return self.calibrate(self.quality(text))

    def calibrate(self, quality: float) -> float:
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.slope * _logit(quality) + self.offset))))


def _logsum(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def _logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return math.log(p / (1 - p))


def join_neighbours(parts: np.ndarray) -> np.ndarray:
    out = parts[:, 0].astype(np.float64)
    out[1:] += parts[:-1, 1]
    out[:-1] += parts[1:, 2]
    return out


def fit(features: list[np.ndarray], sizes: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, rounds: int = 2, steps: int = 100) -> Field:
    """Fit the field and its calibration. features, sizes: by document; weight: how many labelled documents each stands for."""
    docs = len(features)
    lengths = np.array([len(f) for f in features])
    x = np.concatenate(features).astype(np.float32)
    first = np.r_[0, np.cumsum(lengths)[:-1]]
    last = first + lengths - 1
    not_first, not_last = np.ones(len(x), bool), np.ones(len(x), bool)
    not_first[first], not_last[last] = False, False
    of = np.repeat(np.arange(docs), lengths)
    order = np.argsort(-lengths, kind="stable")  # documents still going at step t are a prefix
    going = [int((lengths > t).sum()) for t in range(lengths.max())]
    at = first[order]
    target = labels[of].astype(np.float64)
    each = (1 / lengths)[of] ** 0.5  # long documents count for more, not in proportion
    field = Field(np.zeros((N_FEATURES, 3)), np.array([[0.5, -0.5], [-0.5, 0.5]]))

    def messages(odds):
        moves = np.exp(field.moves)
        ahead, back = np.zeros(len(x)), np.zeros(len(x))
        for t in range(1, len(going)):
            i = at[: going[t]] + t
            z = np.exp(np.clip(ahead[i - 1] + odds[i - 1], -30, 30))
            ahead[i] = np.log((z * moves[1, 1] + moves[0, 1]) / (z * moves[1, 0] + moves[0, 0]))
        for t in range(len(going) - 2, -1, -1):
            i = at[: going[t + 1]] + t
            z = np.exp(np.clip(back[i + 1] + odds[i + 1], -30, 30))
            back[i] = np.log((z * moves[1, 1] + moves[1, 0]) / (z * moves[0, 1] + moves[0, 0]))
        return ahead, back

    def joined():
        parts = x @ field.weights.astype(np.float32)
        odds = parts[:, 0].astype(np.float64)
        odds[not_first] += parts[:-1, 1][not_first[1:]]
        odds[not_last] += parts[1:, 2][not_last[:-1]]
        return np.clip(odds, -30, 30)

    def gradient():
        odds = joined()
        ahead, back = messages(odds)
        p = 1 / (1 + np.exp(-np.clip(odds + ahead + back, -30, 30)))
        d = (p - target) * each
        prev, nxt = np.zeros_like(d), np.zeros_like(d)
        prev[:-1], nxt[1:] = (d * not_first)[1:], (d * not_last)[:-1]
        g = x.T @ np.stack([d, prev, nxt], 1).astype(np.float32)
        i = np.flatnonzero(not_first)
        left, right = odds[i - 1] + ahead[i - 1], odds[i] + back[i]
        joint = np.stack([np.zeros(len(i)) + field.moves[0, 0], right + field.moves[0, 1], left + field.moves[1, 0], left + right + field.moves[1, 1]], 1)
        joint = np.exp(joint - joint.max(1, keepdims=True))
        joint /= joint.sum(1, keepdims=True)
        a, b = target[i - 1], target[i]
        want = np.stack([(1 - a) * (1 - b), (1 - a) * b, a * (1 - b), a * b], 1)
        return g / docs, ((joint - want) * each[i, None]).sum(0).reshape(2, 2) / docs

    for turn in range(rounds):
        m = [np.zeros((N_FEATURES, 3)), np.zeros((2, 2))]
        v = [np.zeros((N_FEATURES, 3)), np.zeros((2, 2))]
        for step in range(1, steps + 1):
            gs = gradient()
            gs = (gs[0] + 1e-4 * field.weights, gs[1] + 1e-3 * field.moves)
            for k, (g, name) in enumerate(zip(gs, ("weights", "moves"), strict=True)):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                setattr(field, name, getattr(field, name) - 0.08 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8))
        odds = joined()
        ahead, back = messages(odds)
        p = 1 / (1 + np.exp(-np.clip(odds + ahead + back, -30, 30)))
        if turn + 1 < rounds:  # lines of bad documents that look good may be good
            target = np.where(labels[of] == 1, 1.0, np.where(p > 0.5, p, 0.0))
    w = np.concatenate(sizes) + 1.0
    quality = np.bincount(of, w * p) / np.bincount(of, w)
    z = np.array([_logit(q) for q in quality])
    slope, offset = 1.0, 0.0
    for _ in range(50):  # Newton's method on the two parameters
        q = 1 / (1 + np.exp(-np.clip(slope * z + offset, -30, 30)))
        g = np.array([(weight * (q - labels) * z).sum() + 1e-2 * (slope - 1), (weight * (q - labels)).sum() + 1e-2 * offset])
        h = weight * q * (1 - q)
        hess = np.array([[(h * z * z).sum() + 1e-2, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-2]])
        slope, offset = np.array([slope, offset]) - np.clip(np.linalg.solve(hess, g), -1, 1)
    field.slope, field.offset = max(float(slope), 0.05), float(offset)
    return field


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = 1500, max_lines: int = 200) -> Field:
    """Fit on a bounded sample: of each label, the `per_class` documents with the smallest hash of their id among those not held out
    (crc32 of the id as text, mod 5, not 0); of these, texts of at most `max_lines` lines. The bound is on training alone.

    Labels other than 0 and 1 and null ids are left out; an id labelled both ways counts as 0. Without both labels the field is flat and
    scores every text by the one label there is, or 0.5.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("k")).agg(F.min(label_col).cast("int").alias("y"))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    flat = Field(np.zeros((N_FEATURES, 3)), np.zeros((2, 2)), 0.05, 6.0 if set(counts) == {1} else -6.0 if set(counts) == {0} else 0.0)
    if set(counts) != {0, 1}:
        return flat
    picked = known.where("y = 0").orderBy(F.xxhash64("k"), "k").limit(per_class).unionAll(known.where("y = 1").orderBy(F.xxhash64("k"), "k").limit(per_class))
    # At most 2 * per_class narrow rows: the bound of this broadcast.
    sample = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(picked), F.col("doc_id") == F.col("k")).select("doc_id", "text", "y")

    def make():
        def one(doc_id, text, y):
            parts = list(line_chunks(text))
            if len(parts) == 1 and len(parts[0][0]) <= max_lines:
                yield doc_id, y, len(parts[0][0]), parts[0][0].astype(np.float16).tobytes(), parts[0][1].astype(np.int64).tobytes()

        return one

    rows = map_rows(sample, make, "doc_id bigint, y int, n int, features binary, sizes binary").collect()
    if {r.y for r in rows} != {0, 1}:
        return flat
    rows.sort(key=lambda r: (r.doc_id, bytes(r.features)))
    labels_of = np.array([r.y for r in rows])
    got = np.bincount(labels_of, minlength=2)
    weight = np.array([counts[r.y] / got[r.y] for r in rows]) / sum(counts.values()) * len(rows)
    return fit([np.frombuffer(r.features, np.float16).reshape(r.n, N_FEATURES) for r in rows], [np.frombuffer(r.sizes, np.int64) for r in rows], labels_of, weight)


def score(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """docs -> (doc_id, held_out, score, predicted, quality, n_lines), one row per row of `docs`.

    The text alone is read for the score, all of it. Null and empty texts score as one empty line. Null ids are not held out. Repeated rows
    each get a row. Very long texts: features of 65,536 lines are held at once, and some 40 bytes a line. Empty table: no rows. Other columns are not
    read, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def make():
        known = shared.value

        def one(doc_id, held, text):
            odds, sizes = known.evidence(text)
            quality = float(np.average(known.marginals(odds), weights=sizes + 1))
            value = known.calibrate(quality)
            yield doc_id, held, value, int(value >= threshold), quality, len(sizes)

        return one

    key = F.col(id_col)
    return map_rows(docs.select(key.cast("bigint").alias("doc_id"), held_out(key).alias("held_out"), F.col(text_col).alias("text")), make, "doc_id bigint, held_out boolean, score double, predicted int, quality double, n_lines bigint")


def keep_good(docs: DataFrame, field: Field, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of `docs`, all columns unchanged, whose text scores at least `threshold`; null texts are scored as empty ones."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def make():
        known = shared.value
        return lambda text: (text,) if known.score(text) >= threshold else None

    return rebuild_rows(docs, make, text_col)
