"""The registered queries of this folder, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_saved, save, table
from .decontaminate import scan
from .html_text import extract
from .image_copies import image_copies, pictures
from .jaccard_join import jaccard_components
from .language_id import language_id
from .line_dedup import line_dedup
from .quality_crf import score, train
from .sharding import shard
from .sp_tokenizer import encode, model_for
from .substring_dedup import SENTENCE, WORD_CHARS, substring_dedup


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """removed: the offsets as text, 'start-end,...'."""
    found = substring_dedup(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return found.select("doc_id", "n_units", "n_removed", "removed_words", "removed_chars", spans.alias("removed"), "text")


def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op4_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no images: each vector of `embeddings` is drawn as one, so that near vectors make edited copies. Drawn pictures are written, as
    images would be there: else a task draws and looks in two Python workers at once, all of which hold tables of the search later on."""
    drawn = save(pictures(table(spark, sf_dir, "embeddings")))
    found = image_copies(drawn)
    drop_saved(drawn)  # the result reads none of it
    return found


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "source", "text", "lines_kept", "lines_dropped")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), model_for(spark))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NORM = "lower(regexp_replace(x, '^[ \\t\\r\\f\\x0B]+|[ \\t\\r\\f\\x0B]+$', '', 'g'))"

_SENTENCE = SENTENCE.replace("'", "''")
_WORDS = f"CASE WHEN form = '' THEN 0 ELSE greatest(len(string_split(form, ' ')), len(form) // {WORD_CHARS}) END"
_FORM = "trim(regexp_replace(lower(piece), '[^\\p{L}\\p{N}]+', ' ', 'g'))"

_SQL = {
    "op1_substring_dedup": f"""
WITH p AS (SELECT doc_id, pieces[i] AS piece, i, coalesce(pieces[i - 1], chr(10)) AS before FROM (SELECT doc_id, pieces, unnest(range(1, len(pieces) + 1)) AS i FROM (SELECT doc_id, list_filter(regexp_extract_all(text, '{_SENTENCE}'), lambda x: x <> '') AS pieces FROM documents))),
f AS (SELECT *, {_FORM} AS form FROM p),
g AS (SELECT *, sum(CASE WHEN before LIKE '%' || chr(10) OR {_WORDS} >= 5 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM f),
u AS (SELECT doc_id, k, sum(len(piece)) AS chars, trim(coalesce(string_agg(form, ' ' ORDER BY i) FILTER (WHERE form <> ''), '')) AS form FROM g GROUP BY doc_id, k),
w AS (SELECT *, {_WORDS} AS words, sum(chars) OVER (PARTITION BY doc_id ORDER BY k) - chars AS start FROM u),
r AS (SELECT *, words >= 5 AND row_number() OVER (PARTITION BY form ORDER BY doc_id, k) > 1 AS again FROM w),
b AS (SELECT *, sum(CASE WHEN words >= 5 AND NOT again THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM r),
x AS (SELECT *, again AND sum(CASE WHEN again THEN words ELSE 0 END) OVER (PARTITION BY doc_id, run) >= 25 AS gone FROM b),
t AS (SELECT *, sum(CASE WHEN gone = was THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY k) AS tile FROM (SELECT *, lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY k) AS was FROM x)),
s AS (SELECT doc_id, string_agg(CAST(a AS VARCHAR) || '-' || CAST(e AS VARCHAR), ',' ORDER BY a) AS removed FROM (SELECT doc_id, tile, CAST(min(start) AS BIGINT) AS a, CAST(max(start + chars) AS BIGINT) AS e FROM t WHERE gone GROUP BY doc_id, tile) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_units, count_if(gone) AS n_removed, sum(CASE WHEN gone THEN words ELSE 0 END) AS removed_words, sum(CASE WHEN gone THEN chars ELSE 0 END) AS removed_chars FROM t GROUP BY doc_id),
k AS (SELECT t.doc_id, string_agg(substr(text, CAST(start + 1 AS BIGINT), CAST(chars AS BIGINT)), '' ORDER BY k) AS text FROM t JOIN documents d ON d.doc_id = t.doc_id WHERE NOT gone GROUP BY t.doc_id)
SELECT d.doc_id, CAST(coalesce(n_units, 0) AS BIGINT) AS n_units, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words, CAST(coalesce(removed_chars, 0) AS BIGINT) AS removed_chars, coalesce(removed, '') AS removed, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id""",
    "op5_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 2], ' ') END AS sh FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * n_both >= 90 * (x.n + y.n - n_both)),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m.b, w.doc_id)) AS component_id FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) m ON m.a = w.doc_id""",
    "op6_line_dedup": f"""
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
n AS (SELECT source, doc_id, unnest(list_distinct(list_transform(ls, lambda x: {_NORM}))) AS line FROM d),
t AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
g AS (SELECT source, line, count(*) AS c FROM n WHERE line <> '' GROUP BY source, line),
b AS (SELECT g.source, list(g.line) AS lines FROM g JOIN t ON g.source = t.source WHERE c >= 2 AND c > 0.1 * pages GROUP BY g.source),
k AS (SELECT d.doc_id, d.source, ls, CASE WHEN b.lines IS NULL THEN ls ELSE list_filter(ls, lambda x: NOT list_contains(b.lines, {_NORM})) END AS kept FROM d LEFT JOIN b ON d.source = b.source)
SELECT doc_id, source, array_to_string(kept, chr(10)) AS text, len(kept) AS lines_kept, len(ls) - len(kept) AS lines_dropped FROM k""",
    "op7_benchmark_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
q AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT item_id, m, array_to_string(ws[i:i + m - 1], ' ') AS win FROM (SELECT item_id, ws, least(10, len(ws)) AS m, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM q WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') AS win FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, lens WHERE len(ws) >= m)),
h AS (SELECT doc_id, dw.m AS m, i, item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.win = bw.win),
p AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM h) GROUP BY doc_id),
f AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(ws), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN f ON f.doc_id = d.doc_id""",
    "op10_sharding": """
WITH r AS (SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h FROM documents),
p AS (SELECT doc_id, n_bytes, d, CAST(h // CAST(pow(2, 60 - d) AS BIGINT) AS BIGINT) AS pre FROM (SELECT doc_id, n_bytes, h, CAST(unnest(range(0, 31)) AS INT) AS d FROM r)),
s AS (SELECT d, pre, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_rows FROM p GROUP BY d, pre),
f AS (SELECT p.doc_id, p.n_bytes, p.d, p.pre, s.shard_bytes, s.shard_rows, row_number() OVER (PARTITION BY p.doc_id ORDER BY p.d) AS k FROM p JOIN s ON p.d = s.d AND p.pre = s.pre WHERE s.shard_bytes <= 1048576 OR s.shard_rows = 1)
SELECT doc_id, n_bytes, d AS depth, CASE WHEN d = 0 THEN '' ELSE lpad(bin(pre), d, '0') END AS shard, shard_bytes, shard_rows, shard_bytes > 1048576 AS oversize FROM f WHERE k = 1""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
