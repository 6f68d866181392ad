"""Substring dedup by windows of words: passages that begin and end inside sentences, against brute force and on the driver's tables."""

import random
import re

import numpy as np
import pytest

from thicket.llm.common import window_hashes, word_hashes
from thicket.llm.substring_dedup import _words, marks, substring_dedup, units_of

DOCS = "doc_id bigint, text string"


def brute(rows, n):
    """doc_id -> the text that stays."""
    first, out = {}, {}
    for doc_id, text in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is None, r[0])):
        found = list(re.finditer(r"[^\W_]+", text))
        words, gone = [m[0].lower() for m in found], set()
        for k in range(len(words) - n + 1):
            where, at = first.setdefault(tuple(words[k : k + n]), (doc_id, k))
            if where != doc_id or k >= at + n:
                gone |= set(range(k, k + n))
        starts = [0, *(m.start() for m in found[1:]), len(text)]
        out[doc_id] = "".join(text[starts[k] : starts[k + 1]] for k in range(len(found)) if k not in gone) if found else text
    return out


def rows_of(rng):
    say = lambda n, of="abcdefghij": " ".join("".join(rng.choice(of) for _ in range(rng.randint(2, 6))) for _ in range(n))
    passage, other = say(30), say(64)
    rows = [(1, f"{say(9)} {passage} {say(7)}"), (2, f"({say(5)} {passage.replace(' ', ', ', 3)} {say(4)}."), (3, f"{say(3)}\n{passage.upper()[: len(passage) // 2]} x {say(3)}")]
    rows += [(4, f"{other} {say(3)} {other} {say(2)}"), (5, "again " * 70), (6, rows[1][1]), (7, say(300, "ab")), (8, say(300, "ab")), (9, f"{say(6)} {other[20:]}"), (None, passage)]
    return rows + [(10, None), (11, ""), (12, " ?! "), (13, "one two"), (14, f"İstanbul {passage} ΑΣ")]


@pytest.mark.parametrize("n", [2, 3, 20, 25])
def test_windows_against_brute_force(spark, n):
    rows = rows_of(random.Random(n))
    text, expected = dict(rows), brute(rows, n)
    got = substring_dedup(spark.createDataFrame(rows, DOCS), unit="words", min_run=n).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == expected.get(r.doc_id)
        if r.text is not None:
            tiles = sorted((s.start, s.end) for s in [*r.removed, *r.kept])
            assert not tiles and not r.text or [a for a, _ in tiles] == [0, *(b for _, b in tiles[:-1])] and tiles[-1][1] == len(text[r.doc_id])
            assert r.n_units == len(re.findall(r"[^\W_]+", text[r.doc_id])) and r.removed_words == r.n_removed == r.n_units - len(re.findall(r"[^\W_]+", r.text))


def test_equal_windows_have_equal_marks():
    words = _words(" ".join(random.Random(1).choice("abc") for _ in range(400)))
    for n in (1, 2, 3, 8, 50):
        least, grams = marks(word_hashes(words), n)
        short = max(1, n // 2)
        assert least.tolist() == [grams[k : k + n - short + 1].min() for k in range(400 - n + 1)]
    assert units_of("- a, b\n", "words") == [(0, 5, "a", 1), (5, 7, "b", 1)] and _words(" _ ") == []


def test_every_passage_of_the_tables(spark):
    """All documents that repeat 50 words in a row of an earlier one lose some, and none that share no such words."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first, late, shared, owners = {}, set(), set(), {}
    for r in docs.orderBy("doc_id").collect():
        words = _words(r.text or "")
        owners[r.doc_id] = window_hashes(word_hashes(words), 50).tolist() if len(words) >= 50 else []
        for h in owners[r.doc_id]:
            if first.setdefault(h, r.doc_id) != r.doc_id:
                late.add(r.doc_id)
                shared.add(h)
    clean = {d for d, hs in owners.items() if not shared.intersection(hs) and len(set(hs)) == len(hs)}
    touched = {r.doc_id for r in substring_dedup(docs, unit="words", min_run=50).where("n_removed > 0").collect()}
    assert len(late) > 50 and late <= touched and not clean & touched and len(clean) > 500
    assert np.mean([d in touched for d in owners]) < 0.5
