"""Substring dedup: units of text hashed, grouped over the corpus, all but the earliest occurrence of a repeated passage removed.

Units are lines or paragraphs. How a passage is wrapped into lines differs from copy to copy, and so does what stands before and after it
in its first and last line; so lines are, by default, broken anew at the ends of sentences before they are hashed. Passages that begin or end
inside sentences are found whole by the units 'words': every window of words in a row that repeats goes.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_saved, map_rows, save, window_hashes, word_hashes

#: Where units end, by kind; what follows a unit belongs to it, so that units tile the text. The first is written for RE2 as well.
SENTENCE = r"[^\n]*?(?:[.!?…][\"'”’)\]»]*[ \t\r]+|[。！？]|\n|$)"
ENDS = {"sentence": re.compile(SENTENCE.replace("$", r"\Z")), "line": re.compile(r"[^\n]*(?:\n|\Z)"), "paragraph": re.compile(r"(?s:.*?)(?:\n[ \t\r]*\n\s*|\Z)"), "words": re.compile(r"(?:\A[\W_]+)?[^\W_]+[\W_]*")}
#: Fixed value: characters that count as a word at most, for scripts without spaces.
WORD_CHARS = 12
_APART, _WORD = re.compile(r"[\W_]+"), re.compile(r"[^\W_]+")


def normal(unit: str) -> str:
    """What units are compared by: lower case, runs of anything but letters and digits (line breaks, too) as one space."""
    return _APART.sub(" ", unit.lower()).strip()


def n_words(form: str) -> int:
    return max(form.count(" ") + 1, len(form) // WORD_CHARS) if form else 0


def units_of(text: str, unit: str = "sentence", min_words: int = 5) -> list[tuple[int, int, str, int]]:
    """(start, end, normal form, words) of the units, which tile the text. A sentence of under `min_words` words belongs to the one before it in its line."""
    out: list[tuple[int, int, str, int]] = []
    fresh = True
    for m in ENDS[unit].finditer(text):
        start, end = m.span()
        if start == end:
            continue
        form = normal(m[0])
        words = 1 if unit == "words" else n_words(form)
        if unit == "sentence" and not fresh and words < min_words:
            first, _, before, _ = out[-1]
            form = f"{before} {form}".strip()
            out[-1] = (first, end, form, n_words(form))
        else:
            out.append((start, end, form, words))
        fresh = text[end - 1] == "\n"
    return out


def passages(units: list[tuple[int, int, str, int]], again: set[int], min_words: int, min_run: int) -> set[int]:
    """Positions of the units to remove: those in `again` that, with those that follow one another, hold `min_run` words. Units too short to be compared
    neither count nor end a run."""
    gone: set[int] = set()
    run: list[int] = []
    held = 0
    for k, (_, _, _, words) in enumerate([*units, (0, 0, "", min_words)]):
        if k in again:
            run.append(k)
            held += words
        elif words >= min_words:
            if held >= min_run:
                gone.update(run)
            run, held = [], 0
    return gone


def _words(text: str) -> list[bytes]:
    return [w.encode("utf-8", "surrogatepass") for w in " ".join(_WORD.findall(text)).lower().split()]


def marks(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(the smallest hash of n // 2 words in each window of n, the hashes of n // 2 words): windows of equal words have equal marks."""
    short = max(1, n // 2)
    grams = window_hashes(hashes, short).view(np.int64)
    least, width, left = grams, 1, n - short + 1
    while width < left:  # of `width` in a row, twice as many each time
        by = min(width, left - width)
        least, width = np.minimum(least[: len(least) - by], least[by:]), width + by
    return least, grams


def _again_in_windows(base: DataFrame, n: int) -> DataFrame:
    """base (doc_id, text, row) -> (l_id, l_row, n_units, again): first words of the windows of `n` words that an earlier one equals, which ends before it.

    Windows are compared where their marks occur twice, which those of equal windows do: few of all windows are hashed and moved.
    """

    def mark():
        def one(doc_id, text, row):
            words = _words(text)
            if len(words) >= n:
                least, grams = marks(word_hashes(words), n)
                least = np.unique(least)
                grams, count = np.unique(grams, return_counts=True)
                for h, k in zip(least.tolist(), np.minimum(count[np.searchsorted(grams, least)], 2).tolist(), strict=True):
                    yield h, doc_id, row, k

        return one

    def windows():
        def one(doc_id, text, row, common):
            words = _words(text)
            least, _ = marks(word_hashes(words), n)
            ends = np.r_[0, np.cumsum([len(w) + 1 for w in words])].tolist()
            line = b" ".join(words) + b" "
            for k in np.flatnonzero(np.isin(least, np.array(common, np.int64))).tolist():
                yield hashlib.md5(line[ends[k] : ends[k + n]]).digest(), doc_id, row, k

        return one

    texts = base.where(F.col("text").isNotNull())
    of_row = lambda l, r: F.col(f"{l}row").eqNullSafe(F.col(f"{r}row")) & F.col(f"{l}doc_id").eqNullSafe(F.col(f"{r}doc_id"))
    seen = save(map_rows(texts, mark, "h bigint, doc_id bigint, row bigint, n int"))
    common = seen.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    common = seen.join(common, "h").groupBy(F.col("doc_id").alias("m_doc_id"), F.col("row").alias("m_row")).agg(F.collect_set("h").alias("common"))  # bounded by one text
    near = texts.join(common, of_row("", "m_")).select("doc_id", "text", "row", "common")
    found = save(map_rows(near, windows, "digest binary, doc_id bigint, row bigint, k int"))  # rows that repeat give equal ranks
    drop_saved(seen)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "k")
    firsts = found.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    same = F.col("row").eqNullSafe(F.col("first.row")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    again = found.join(firsts, "digest").where(~same | (F.col("k") >= F.col("first.k") + n))
    return again.groupBy(F.col("doc_id").alias("l_id"), F.col("row").alias("l_row")).agg(F.collect_set("k").alias("again"))  # bounded by one text


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence", min_words: int = 5, min_run: int = 25) -> DataFrame:
    """docs -> (doc_id, n_units, n_removed, removed_words, removed_chars, removed, kept, text), one row per row of `docs`.

    unit: 'sentence' (lines, broken at the ends of sentences; a line break ends one, too), 'line', 'paragraph' (line breaks in it fold to a space)
    or 'words': `min_run` words in a row that an earlier text holds, or the same one before them, go wherever they begin, and nothing else does. Each
    word that goes has an equal one before it in equal words; from copy to copy, that ends at one that stays. A run of letters is a word there,
    also in scripts without spaces, `min_words` has no part in it, and n_units and n_removed count words.
    Units of at least `min_words` words are compared by the MD5 of their normal form; in text without spaces every 12 characters count as a word. Of
    equal ones the earliest stays: the smallest doc_id, then the first in its text; ties between rows that repeat an id go by a hash of their texts.
    The others go where units that repeat follow one another for at least `min_run` words: a passage. A sentence or a short line that repeats alone
    stays (a boilerplate line is `line_dedup`'s). Every unit that goes has an equal one that stays. removed_words, removed_chars: how much went.
    removed, kept: [start, end) character offsets in the original text, neighbours joined, which together tile it; text: the kept spans.
    Null text: null text, zeros. Empty text: no units. Very long texts: one text's units are held at once, nothing is cut. Null ids rank last. Rows
    equal in id and text are one document: each comes out alike. Empty table: no rows. Other columns are not read, whatever their names.

    Scale: texts are parsed once and only (digest, rank) moves for the search, pre-aggregated by digest; the join back is by digest, whose hot keys
    Spark splits, and only repeated units of it go on to their documents.
    """
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    base = base.withColumn("row", F.xxhash64("doc_id", "text"))

    if unit == "words":
        return _rebuilt(base, _again_in_windows(base, min_run), unit, min_words, min_run)

    def cut():
        def one(doc_id, text, row):
            units = units_of(text, unit, min_words)
            yield None, doc_id, row, len(units)
            for k, (_, _, form, words) in enumerate(units):
                if words >= min_words:
                    yield hashlib.md5(form.encode("utf-8", "surrogatepass")).digest(), doc_id, row, k

        return one

    # k: the unit's position; without a digest, the number of the document's units.
    units = save(map_rows(base.where(F.col("text").isNotNull()), cut, "digest binary, doc_id bigint, row bigint, k int"))
    hashed = units.where("digest is not null")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "k")
    firsts = hashed.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    again = hashed.join(firsts, "digest").where(~rank.eqNullSafe(F.col("first"))).select("digest", "doc_id", "row", "k")
    told = again.unionByName(units.where("digest is null"))
    told = told.groupBy(F.col("doc_id").alias("l_id"), F.col("row").alias("l_row")).agg(  # bounded by one text
        F.max(F.when(F.col("digest").isNull(), F.col("k"))).alias("n_units"), F.collect_set(F.when(F.col("digest").isNotNull(), F.col("k"))).alias("again")
    )
    return _rebuilt(base, told, unit, min_words, min_run)


def _rebuilt(base: DataFrame, told: DataFrame, unit: str, min_words: int, min_run: int) -> DataFrame:
    """The result, of base (doc_id, text, row) and the units of each that repeat."""
    if unit == "words":
        told = told.withColumn("n_units", F.lit(0))  # counted below, as no table holds the words of every text
    joined = base.join(told, F.col("row").eqNullSafe(F.col("l_row")) & F.col("doc_id").eqNullSafe(F.col("l_id")), "left")

    def rebuild():
        def spans(edges, length):
            return [{"start": a, "end": b} for a, b in zip(edges, [*edges[1:], length], strict=True)]

        def one(doc_id, text, n_units, again):
            if not again:
                yield doc_id, len(_WORD.findall(text or "")) if unit == "words" else n_units or 0, 0, 0, 0, [], [{"start": 0, "end": len(text)}] if text else [], text
                return
            units = units_of(text, unit, min_words)
            gone = {j for k in again for j in range(k, k + min_run)} if unit == "words" else passages(units, set(again), min_words, min_run)
            turns = [0, *(k for k in range(1, len(units)) if (k in gone) != (k - 1 in gone))]
            tiles = [(k in gone, s) for k, s in zip(turns, spans([units[k][0] for k in turns], len(text)), strict=True)]
            removed, kept = [s for lost, s in tiles if lost], [s for lost, s in tiles if not lost]
            yield doc_id, len(units), len(gone), sum(units[k][3] for k in gone), sum(s["end"] - s["start"] for s in removed), removed, kept, "".join(text[s["start"] : s["end"]] for s in kept)

        return one

    span = "array<struct<start: int, end: int>>"
    return map_rows(joined.select("doc_id", "text", "n_units", "again"), rebuild, f"doc_id bigint, n_units bigint, n_removed bigint, removed_words bigint, removed_chars bigint, removed {span}, kept {span}, text string")
