"""The search for copies of images: what it holds at once, and that it finds what brute force does."""

import tracemalloc

import numpy as np

from thicket.llm import image_copies as I
from thicket.llm import queries as Q


def near_copies(rng, n, descriptors):
    """Images whose descriptors differ from those of one image in a few bits."""
    base = rng.integers(0, 1 << 63, (descriptors, 4), dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (n, descriptors, 4), dtype=np.uint64)
    return base ^ np.where(rng.random(flips.shape) < 0.3, flips, np.uint64(0))


def test_a_large_group_of_copies_is_searched_in_little_memory():
    rng = np.random.default_rng(5)
    near = near_copies(rng, 3_000, 100)
    places = np.ones((100, 4), np.float32)
    held = I.Tables([(k, bits, places) for k, bits in enumerate(near)])
    tracemalloc.start()
    got = held.sharing(list(near[:4]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [sorted(x) for x in got] == [list(range(3_000))] * 4
    assert peak < 40 << 20  # 400 descriptors that each meet all 3,000 images, in up to eight tables


def test_sharing_against_brute_force(monkeypatch):
    """Images near and unrelated, a descriptor held by all, the most shared first: in one go and in many."""
    rng = np.random.default_rng(6)
    images = [*near_copies(rng, 6, 12), *near_copies(rng, 5, 40), *rng.integers(0, 1 << 63, (4, 9, 4), dtype=np.uint64), np.empty((0, 4), np.uint64)]
    images = [np.concatenate([bits, np.full((3, 4), 7, np.uint64)]) for bits in images]
    held = I.Tables([(k, bits, np.ones((len(bits), 4), np.float32)) for k, bits in enumerate(images)])

    def shared(a, b):
        alike = np.bitwise_count(a[:, None] ^ b[None]).sum(2) <= I.MOST_BITS
        words = [np.stack(list(I.words(x)), 1) for x in (a, b)]
        return (alike & (words[0][:, None] == words[1][None]).any(2)).any(1).sum()

    counts = [[shared(a, b) for b in images] for a in images]
    expected = [[int(y) for y in np.lexsort((range(len(c)), -np.array(c))) if c[y] >= I.LEAST_SHARED] for c in counts]
    assert sum(map(len, expected)) == 6 * 6 + 5 * 5 + 4
    for hits in (I._HITS, 50, 1):
        monkeypatch.setattr(I, "_HITS", hits)
        assert [x.tolist() for x in held.sharing(images)] == expected


def test_pictures_are_not_drawn_where_they_are_looked_at(spark, monkeypatch):
    """Two Python stages in one task make two workers a core, each of which keeps tables of the search."""
    plans = []

    def stub(images):
        plans.append(images._jdf.queryExecution().executedPlan().toString())
        return images.select("image_id")

    monkeypatch.setattr(Q, "image_copies", stub)
    Q.op4_image_copies(spark, "/root/testdata/sf0.001")
    assert "InArrow" not in plans[0]
