"""Substring dedup against a plain second form of it, on odd rows, and on passages of 50 words that the driver's tables repeat."""

import random
import re

import numpy as np
import pytest

from thicket.llm.common import window_hashes, word_hashes
from thicket.llm.substring_dedup import normal, substring_dedup, units_of

DOCS = "doc_id bigint, text string"


def prose(rng, n):
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)]
    return " ".join(w + "." if rng.random() < 0.12 else w for w in words) + "."


def brute(rows, min_words=5, min_run=25):
    """(doc_id, removed text pieces, kept text), a sentence at a time over all texts in order."""
    seen, out = set(), {}
    for doc_id, text in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is None, r[0])):
        units = []
        for line in re.findall(r"[^\n]*\n|[^\n]+", text):
            pieces = re.split(r"(?<=\.)(?=[ ])", line)
            pieces = [p + (re.match(" *", q)[0]) for p, q in zip(pieces, [*pieces[1:], ""], strict=True)]
            pieces = [pieces[0], *(p.lstrip(" ") for p in pieces[1:])]
            first = True
            for p in pieces:
                n = len(re.findall(r"[^\W_]+", p))
                if p and (first or n >= min_words):
                    units.append(p)
                elif p:
                    units[-1] += p
                first = False
        words = [re.findall(r"[^\W_]+", u.lower()) for u in units]
        again = []
        for w in words:
            again.append(len(w) >= min_words and tuple(w) in seen)
            seen.add(tuple(w))
        gone, run = set(), []
        for k in range(len(units) + 1):
            if k < len(units) and again[k]:
                run.append(k)
            elif k == len(units) or len(words[k]) >= min_words:
                if sum(len(words[j]) for j in run) >= min_run:
                    gone |= set(run)
                run = []
        out[doc_id] = (len(gone), "".join(u for k, u in enumerate(units) if k in gone), "".join(u for k, u in enumerate(units) if k not in gone))
    return out


def rows_of(rng):
    passage, other = prose(rng, 70), prose(rng, 60)
    wrapped = passage.replace(". ", ".\n", 2)
    line = "one line that very many pages of a site hold below their text."
    rows = [(i, f"{prose(rng, 40)}\n{line}\n{prose(rng, 30)}") for i in range(10, 20)]
    rows += [(1, f"{prose(rng, 30)} {passage} {prose(rng, 30)}"), (2, f"{prose(rng, 20)}\n{passage}\n{prose(rng, 9)}"), (3, f"{prose(rng, 20)} {wrapped} {prose(rng, 50)}")]
    rows += [(4, other + "\n\n" + prose(rng, 12) + "\n" + other.upper()), (5, rows[0][1]), (6, other.replace(" ", " -- "))]
    return rows


def test_against_brute_force(spark):
    rows = rows_of(random.Random(3))
    got = {r.doc_id: r for r in substring_dedup(spark.createDataFrame(rows, DOCS)).collect()}
    text = dict(rows)
    for doc_id, (n, removed, kept) in brute(rows).items():
        r = got[doc_id]
        assert (r.n_removed, "".join(text[doc_id][s.start : s.end] for s in r.removed), r.text) == (n, removed, kept)
        tiles = sorted((s.start, s.end) for s in [*r.removed, *r.kept])
        assert [a for a, _ in tiles] == [0, *(b for _, b in tiles[:-1])] and tiles[-1][1] == len(text[doc_id])
        assert r.removed_chars == len(removed) and r.removed_words == len(re.findall(r"[^\W_]+", removed))
    # A copy goes whole but for its short lines; a passage goes however it is wrapped; lines that repeat alone stay.
    assert got[10].removed_words > 60 and got[5].n_removed == 0 and got[4].removed_words >= 50 and got[6].removed_words >= 50
    assert got[1].n_removed == 0 and got[2].removed_words >= 50 and got[3].removed_words >= 30
    assert all(got[i].n_removed == 0 for i in range(11, 20))


def test_odd_rows(spark):
    long = "this text begins with a sentence. " + prose(random.Random(4), 60_000)
    thai = "กขค" * 200
    rows = [(4, None), (5, ""), (6, "\n \n"), (7, "?!."), (None, long), (8, long), (8, long), (9, f"x {thai}。\ny"), (10, f"z\n{thai}。\nx"), (11, f"{thai}。")]
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], DOCS + ", k int, digest string, row int")  # clashing names
    got = substring_dedup(frame).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by[4].text is None and by[4].kept == [] and by[5].text == "" and by[5].n_units == 0
    assert by[6].text == "\n \n" and by[7].n_removed == 0
    assert by[None].text == "" and by[None].removed_chars == len(long)  # null ids rank last
    assert [r.text for r in got if r.doc_id == 8] == [long, long]  # one document
    assert by[9].n_removed == 0 and by[11].text == "" and by[10].n_removed == 0
    assert substring_dedup(frame.where("false")).count() == 0


@pytest.mark.parametrize("unit", ["line", "paragraph"])
def test_other_units(spark, unit):
    rng = random.Random(5)
    a, b = prose(rng, 40), prose(rng, 40)
    gap = "\n" if unit == "line" else "\n \n"
    inner = b if unit == "line" else b.replace(" ", "\n", 3)
    got = {r.doc_id: r.text for r in substring_dedup(spark.createDataFrame([(1, a + gap + b), (2, f"own{gap}{inner}{gap}own")], DOCS), unit=unit).collect()}
    assert got == {1: a + gap + b, 2: f"own{gap}own"}
    text = "a\n\n b\nc"
    assert [text[s:e] for s, e, _, _ in units_of(text, unit)] == (["a\n", "\n", " b\n", "c"] if unit == "line" else ["a\n\n ", "b\nc"]) and normal("A-b_\nc") == "a b c"


def test_passages_of_the_tables(spark):
    """Of documents that repeat 50 words in a row of an earlier one, at least 0.85 lose something; of those that share none, 0.95 stay whole."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first, late, shared, owners = {}, set(), set(), {}
    for r in docs.orderBy("doc_id").collect():
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").encode().lower())
        owners[r.doc_id] = window_hashes(word_hashes(words), 50).tolist() if len(words) >= 50 else []
        for h in owners[r.doc_id]:
            if first.setdefault(h, r.doc_id) != r.doc_id:
                late.add(r.doc_id)
                shared.add(h)
    clean = {d for d, hs in owners.items() if not shared.intersection(hs)}
    touched = {r.doc_id for r in substring_dedup(docs).where("n_removed > 0").collect()}
    assert len(late) > 50 and np.mean([d in touched for d in late]) >= 0.85
    assert np.mean([d not in touched for d in clean]) >= 0.95
