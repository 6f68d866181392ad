"""Odd rows, clashing names, repeats, empty tables and very long rows for the operators; the stages of the pipeline among them."""

import random
import time

import pytest

from thicket.llm import decontaminate as D
from thicket.llm import html_text as W
from thicket.llm import image_copies as I
from thicket.llm import jaccard_join as J
from thicket.llm import language_id as L
from thicket.llm import quality_crf as Q
from thicket.llm.common import save
from thicket.llm.line_dedup import line_dedup
from thicket.llm.sharding import shard, write_shards

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_line_dedup_of_odd_rows(spark):
    names = "host_key string, digest int, pages int, kept_lines string, lines_kept string"
    rows = [(i, f"same\nown {i}", "h", "k", 1, 2, "x", "y") for i in range(4)] + [(9, "alone\nonce", "tiny", None, None, None, None, None)] * 1
    frame = spark.createDataFrame(rows, DOCS + ", source string, " + names)
    got = {r.doc_id: r for r in line_dedup(frame, counts=False).collect()}
    assert line_dedup(frame, counts=False).columns == frame.columns
    assert got[3].text == "own 3" and got[3].host_key == "k" and got[3].lines_kept == "y"  # on all four pages of a small host
    assert got[9].text == "alone\nonce"  # a host's only page keeps what it says
    counted = {r.doc_id: (r.lines_kept, r.lines_dropped) for r in line_dedup(frame).collect()}
    assert counted[3] == (1, 1) and counted[9] == (2, 0)
    twice = spark.createDataFrame([(1, "a\nb", "s"), (1, "a\nb", "s")], DOCS + ", source string")
    assert [r.text for r in line_dedup(twice).collect()] == ["", ""]  # repeated rows are pages each


def test_shards_are_written_whole(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i % 50, "x" * rng.randint(0, 60), i, f"s{i}", "h") for i in range(200)] + [(None, None, 900, None, "h"), (7, "y" * 5000, 901, "long", "h")]
    frame = spark.createDataFrame(rows, DOCS + ", n_bytes int, shard string, cell string")
    write_shards(frame, str(tmp_path / "out"), limit=300)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.select(*frame.columns).collect(), key=str) == sorted(frame.collect(), key=str)
    sizes = {}
    for r in back.collect():
        sizes.setdefault(r["shard_"], []).append(len(r.text or ""))
    assert all(sum(x) <= 300 or len(x) == 1 for x in sizes.values())
    empty = frame.where("false")
    assert shard(empty).count() == 0
    clash = {r.doc_id for r in shard(frame.drop("shard").withColumnRenamed("cell", "depth"), limit=300).collect()}
    assert clash == {*range(50), None}


def test_decontamination_of_odd_rows(spark):
    rng = random.Random(5)
    item = prose(rng, 30)
    long = prose(rng, 100_000)
    docs = [(1, item), (1, item), (None, "x " + item), (3, None), (4, ""), (5, long + " " + item)]
    frame = spark.createDataFrame([(*r, "a", 1, "s") for r in docs], DOCS + ", items string, at int, spans string")
    bench = spark.createDataFrame([(1, item, 5), (2, item, 5), (None, long, 5), (3, None, 5), (4, prose(rng, 12), 5)], "item_id bigint, text string, doc_id int")
    for block in (D.BLOCK_BYTES, 60):
        got = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items) for r in D.scan(frame, bench, block_bytes=block).collect())
        assert got == [(0, 31, 30, 2), (1, 30, 30, 2), (1, 30, 30, 2), (3, 0, 0, 0), (4, 0, 0, 0), (5, 100_030, 30, 2)]
        none = D.scan(frame, bench.where("false"), block_bytes=block).collect()
        assert len(none) == len(docs) and not any(r.contaminated for r in none)
        assert D.scan(frame.where("false"), bench, block_bytes=block).count() == 0
        assert D.remove(frame.where("false"), bench, block_bytes=block).columns == frame.columns


def test_window_set_holds_no_more_than_it_says():
    import tracemalloc

    rng = random.Random(6)
    items = [(str(i), prose(rng, 300)) for i in range(500)]
    size = sum(len(t) for _, t in items)
    tracemalloc.start()
    known = D.WindowSet(items)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 10 * size and known.hits(D.words_of("x " + items[3][1][:400]))[1] == {"3"}


def test_quality_of_odd_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    field = Q.train(docs, labels)
    many = "\n".join(f"line {i % 40_000}" for i in range(150_000))
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (None, "x"), (3, many)]
    frame = spark.createDataFrame([(*r, 2, 0.5, "f") for r in rows], DOCS + ", quality int, score double, held_out string")
    got = Q.score(frame, field).collect()
    assert len(got) == 5 and len({r.score for r in got if r.doc_id == 1}) == 1 and [r.n_lines for r in got if r.doc_id == 3] == [150_000]
    assert Q.score(frame.where("false"), field).count() == 0 and Q.keep_good(frame, field).columns == frame.columns
    came = [x for part, _ in Q.line_chunks(many) for x in part[:, Q.N_CLASSES * Q.N_CLASSES + 3].tolist()]
    assert came == [0] * 40_000 + [1] * 110_000  # repeats are seen over chunks


def test_language_of_odd_rows(spark):
    docs, pages = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/pages.parquet")
    model = L.train(docs)
    rows = [(1, None, "s"), (1, None, "s"), (None, "", None), (2, "?!", "host.example.de")]
    odd = spark.createDataFrame([(*r, 1, "z") for r in rows], DOCS + ", source string, p0 int, declared string")
    odd_pages = spark.createDataFrame([(5, "http://host.example.de/", None, 1), (5, "http://host.example.de/", None, 1), (6, None, "<nav " * 30_000, 2)], "page_id bigint, url string, html string, host int")
    began = time.time()
    got = L.language_id(odd, odd_pages, model).collect()
    assert len(got) == 7 and all(r.lang in model[0] for r in got) and time.time() - began < 60
    assert L.language_id(odd.where("false"), odd_pages.where("false"), model).count() == 0
    assert L.train(docs.where("false"))[0] == ["und"]
    more = docs.select("doc_id", "text", "doc_id").toDF("doc_id", "text", "k").selectExpr("doc_id", "text", "concat('l', k % 90) as lang")
    assert len(L.train(more)[0]) > 64  # no language is left out
    assert L.address("https://a.b.example.co.uk/de/x") == ("a.b.example.co.uk", "example.co.uk", "uk/de") and L.shown("a<script>b</script>c<!-- d -->e") == "a c e"
    same = [L.language_id(docs, pages, model).select("doc_id", "page_id", "lang").collect() for _ in range(2)]
    assert sorted(same[0], key=str) == sorted(same[1], key=str)


@pytest.mark.parametrize("page", ["<a ", "<i>", "</b>", "<div><p>", "<p a='", "<script>", "<table><td>", "<li><ul>", "<!--", "</p>", "&"])
def test_pages_take_time_in_proportion(page):
    def took(k):
        began = time.perf_counter()
        W.html_to_text(page * k + "</b>" * (k if page == "<i>" else 0) + "end")
        return time.perf_counter() - began

    took(100)
    assert took(40_000) < 12 * took(8_000) + 1


def test_cells_of_any_length_are_aligned(spark):
    long = "w" * 60
    assert W.html_to_text(f"<table><tr><td>{long}<td>1<tr><td>x<td>2</table>") == f"{long}  1\nx{' ' * 59}  2"
    pages = spark.createDataFrame([(1, "<p>" * 200_000 + "x", "t")], "page_id bigint, html string, text string")
    assert [(r.page_id, r.text) for r in W.extract(pages).collect()] == [(1, "x")] and W.extract(pages.where("false")).count() == 0


def test_stages_of_odd_rows(spark):
    """Each stage keeps the columns, names of its own making included, and takes nulls, empty and repeated rows and empty tables."""
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(9001, None, "en", None, None), (None, "", None, "s", 0), (9002, "same words here", "en", "s", 5), (9002, "same words here", "en", "s", 5)], docs.schema)
    frame = docs.unionByName(odd)
    for c in ("host_key", "kept_lines", "lines_kept", "at", "spans", "digest", "node", "component_id", "held_out", "y"):
        frame = frame.selectExpr("*", f"'{c}' as {c}")
    frame = save(frame)
    for name, stage in C.STAGES:
        for given in (frame, frame.where("false")):
            got = stage(spark, given, SF)
            rows = got.collect()
            if name != C.STAGES[-1][0]:
                assert got.columns == frame.columns, name
                assert all(r.at == "at" and r.y == "y" for r in rows)
            assert len(rows) <= given.count() and (given is frame) == bool(rows), name
            if name != C.STAGES[0][0] and given is frame:
                ids = [r.doc_id for r in rows]
                assert 9001 in ids and None in ids and ids.count(9002) == 2


def test_jaccard_and_images_of_empty_tables(spark):
    assert J.jaccard_components(spark.createDataFrame([(1, None), (None, "a b")], DOCS)).count() == 2
    none = spark.createDataFrame([], "image_id bigint, image binary")
    assert I.image_copies(none).count() == 0
