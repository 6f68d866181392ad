"""Language identification by Bayesian evidence fusion.

Text likelihoods from byte trigrams, the language that the markup declares, the address suffix, and a prior of the host are fused as log
odds. What the declared language and the suffix are worth is not assumed: their distributions given the language come from the
corpus, by grouped sums of the text's own posteriors. A host's prior is its sum of posteriors without the page at hand, smoothed by its
domain's, which is smoothed by its suffix's, which is smoothed by the whole corpus's.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, save

#: Hashed trigrams; weight of a trigram against independence; pseudo-counts of channels and priors.
BUCKETS, TEMPER, CHANNEL, PRIOR = 1 << 16, 0.25, 0.5, 5.0
#: Measured size up to which the hosts' priors are broadcast.
BROADCAST_BYTES = 32 << 20
_FOLD = np.arange(256, dtype=np.int64)
_FOLD[65:91] += 32
_FOLD[:65] = _FOLD[91:97] = _FOLD[123:128] = 32
_DECLARED = re.compile(r"<html\b[^>]*?\s(?:xml:)?lang\s*=\s*[\"']?\s*([a-zA-Z]{2,3})(?![a-zA-Z])", re.I)
_TAG = re.compile(r"<!--|<(/?)(script|style|nav|head|footer)(?=[\s/>])[^<>]*>?|<[^<>]*>?|&[#\w]+;", re.I)
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::\d*)?(?:/([a-zA-Z]{2})(?=[/?#]|$))?")


def trigrams(text: str | None) -> np.ndarray:
    """Hashed byte trigrams of the folded text; runs of anything but letters count as one space."""
    codes = _FOLD[np.frombuffer(b" " + (text or "").encode("utf-8", "surrogatepass") + b" ", np.uint8)]
    codes = codes[(codes != 32) | np.r_[True, codes[:-1] != 32]]
    if len(codes) < 3:
        return np.empty(0, np.int64)
    return ((codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]) * 0x9E3779B1 & 0xFFFFFFFF) >> 16


def shown(html: str) -> str:
    """The markup's text without tags, comments and what is inside scripts, styles, navigation, head and footer, in one pass over it."""
    out, at, inside = [], 0, None
    for m in iter(lambda: _TAG.search(html, at), None):
        if inside is None:
            out.append(html[at : m.start()])
        at = m.end()
        if m[0] == "<!--":
            if inside is None:
                end = html.find("-->", at)
                at = len(html) if end < 0 else end + 3
        elif m[2]:
            name = m[2].lower()
            if m[1] and name == inside:
                inside = None
            elif not m[1] and inside is None:
                inside = name
    if inside is None:
        out.append(html[at:])
    return " ".join(out)


def address(url: str | None) -> tuple[str | None, str | None, str | None]:
    """(host, domain, suffix): the suffix is the top-level label, with the two letters that begin the path where there are. The domain is the last two
    labels, three where both of these are short (co.uk)."""
    m = _HOST.match(url or "")
    if not m:
        return None, None, None
    host = m[1].lower().rstrip(".")
    labels = host.split(".")
    top = labels[-1] if re.fullmatch(r"[a-z]{2,24}", labels[-1]) else "?"
    last = 3 if len(labels) > 2 and len(labels[-1]) == 2 and len(labels[-2]) <= 3 else 2
    return host, ".".join(labels[-last:]), top + ("/" + m[2].lower() if m[2] else "")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 250, max_chars: int = 20_000) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities [BUCKETS, languages]) from a bounded sample: of each language, the `per_lang` rows with the smallest hash of
    their id, of those with crc32(id as text) mod 5 not 0 and at most `max_chars` characters. The bound is on training alone."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & (F.length(text_col) <= max_chars) & (F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0))
    langs = sorted(r[0] for r in known.select(lang_col).distinct().collect())  # the languages there are: a closed set of names
    if not langs:
        return ["und"], np.zeros((BUCKETS, 1), np.float32)
    first = Window.partitionBy("l").orderBy(F.xxhash64("k"), "k")  # Spark keeps a limit per group before the shuffle
    narrow = known.select(F.col(id_col).alias("k"), F.col(lang_col).alias("l"))
    picked = narrow.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_lang).select("k", "l")  # per_lang narrow rows a language: the bound of this broadcast

    def make():
        def one(lang, text):
            found, n = np.unique(trigrams(text), return_counts=True)
            yield lang, found.astype(np.int32).tolist(), n.astype(np.int32).tolist()

        return one

    sample = known.join(F.broadcast(picked), (F.col(id_col) == F.col("k")) & (F.col(lang_col) == F.col("l"))).select("l", F.col(text_col).alias("t"))
    counts = np.full((BUCKETS, len(langs)), 0.2)
    for r in map_rows(sample, make, "lang string, grams array<int>, n array<int>").toLocalIterator():
        counts[np.array(r.grams, np.int64), langs.index(r.lang)] += r.n
    return langs, np.log(counts / counts.sum(0)).astype(np.float32)


def evidence(rows: DataFrame, langs: list[str], table: np.ndarray) -> DataFrame:
    """(doc_id, page_id, text, html, url, host) -> their narrow evidence, one row each: log likelihoods l0.. and posteriors p0.. of the text."""
    shared = rows.sparkSession.sparkContext.broadcast(table)
    n = len(langs)

    def make():
        known = shared.value

        def one(doc_id, page_id, text, html, url, host):
            declared = None
            own_host, domain, suffix = address(url)
            if html is not None:
                m = _DECLARED.search(html)
                declared = m[1].lower() if m else None
                text = shown(html)
            grams = trigrams(text)
            if len(grams) < BUCKETS:
                ll = known[grams].sum(0, dtype=np.float64)
            else:
                ll = np.bincount(grams, minlength=BUCKETS) @ known.astype(np.float64)
            ll = (ll - ll.max()) * TEMPER
            p = np.exp(ll)
            p /= p.sum()
            yield doc_id, page_id, len(grams), declared, suffix, own_host or host, domain, *ll.tolist(), *p.tolist()

        return one

    fields = ", ".join([f"l{i} double" for i in range(n)] + [f"p{i} double" for i in range(n)])
    return map_rows(rows.select("doc_id", "page_id", "text", "html", "url", "host"), make, f"doc_id bigint, page_id bigint, n_grams bigint, declared string, suffix string, host string, domain string, {fields}")


def fuse(found: DataFrame, langs: list[str]) -> DataFrame:
    """Evidence rows -> their languages. Grouped sums only move one row a key and task; Spark broadcasts or splits by measured size."""
    n = len(langs)
    found = save(found)
    cols = lambda k: [F.col(f"{k}{i}") for i in range(n)]
    told = F.col("n_grams") > 0  # rows without text have no posterior of their own to teach with

    def sums(by: list[str], source: DataFrame, k: str, out: str) -> DataFrame:
        return source.groupBy(*by).agg(*[F.sum(c).alias(f"{out}{i}") for i, c in enumerate(cols(k))])

    teach = found.where(told)
    total = teach.agg(*[F.coalesce(F.sum(c), F.lit(0.0)) for c in cols("p")]).first()
    glob = [(x + 1) / (sum(total) + n) for x in total]

    def smooth(own: list[Column], above: list[Column]) -> list[Column]:
        size = reduce(lambda a, b: a + b, own)
        return [(o + F.lit(PRIOR) * a) / (size + F.lit(PRIOR)) for o, a in zip(own, above, strict=True)]

    by_host = save(sums(["host", "domain", "suffix"], teach.where("host is not null"), "p", "h"))
    hosts = sums(["host", "domain"], by_host, "h", "h")
    domains = sums(["domain"], hosts.where("domain is not null"), "h", "d")
    tops = by_host.withColumn("top", F.substring_index("suffix", "/", 1))
    tops = sums(["top"], tops.where("top is not null"), "h", "s")
    domains = domains.withColumn("top", F.substring_index("domain", ".", -1)).join(tops, "top", "left")
    above = smooth([F.coalesce(c, F.lit(0.0)) for c in cols("s")], [F.lit(x) for x in glob])
    domains = domains.select("domain", *[c.alias(f"q{i}") for i, c in enumerate(smooth(cols("d"), above))])
    priors = hosts.join(domains, "domain", "left").select("host", *cols("h"), *[F.coalesce(F.col(f"q{i}"), F.lit(glob[i])).alias(f"q{i}") for i in range(n)])
    priors = priors.groupBy("host").agg(*[F.sum(f"h{i}").alias(f"h{i}") for i in range(n)], *[F.avg(f"q{i}").alias(f"q{i}") for i in range(n)])  # a host that is a source and an address too: the mean of both

    # A few numbers a host: broadcast at a measured size, so that a hot host's rows stay where they are; else Spark splits hot hosts.
    priors = save(priors)
    if priors.count() * (16 * n + 64) <= BROADCAST_BYTES:
        priors = F.broadcast(priors)

    def channel(key: str, out: str) -> DataFrame:
        """P(value | language) by value: smoothed shares of the posterior sums."""
        seen = sums([key], teach.where(F.col(key).isNotNull()), "p", out)
        sizes = seen.agg(F.count("*").alias("v"), *[F.coalesce(F.sum(c), F.lit(0.0)) for c in cols(out)]).first()
        return seen.select(F.col(key), *[F.log((c + CHANNEL) / F.lit(sizes[i + 1] + CHANNEL * max(1, sizes[0]))).alias(f"{out}{i}") for i, c in enumerate(cols(out))])

    rows = found.join(priors, "host", "left").join(channel("declared", "c"), "declared", "left").join(channel("suffix", "u"), "suffix", "left")
    # The row's own share leaves its host's sum before it serves as its prior.
    own = [F.greatest(F.coalesce(h, F.lit(0.0)) - F.when(told, p).otherwise(0.0), F.lit(0.0)) for h, p in zip(cols("h"), cols("p"), strict=True)]
    prior = smooth(own, [F.coalesce(F.col(f"q{i}"), F.lit(glob[i])) for i in range(n)])
    score = [l + F.log(q) + F.coalesce(c, F.lit(0.0)) + F.coalesce(u, F.lit(0.0)) for l, q, c, u in zip(cols("l"), prior, cols("c"), cols("u"), strict=True)]  # noqa: E741
    best = F.array_max(F.array(*[F.struct(s.alias("s"), F.lit(-i).alias("i")) for i, s in enumerate(score)]))
    names = F.array(*[F.lit(x) for x in langs])
    text_best = F.array_max(F.array(*[F.struct(c.alias("s"), F.lit(-i).alias("i")) for i, c in enumerate(cols("l"))]))
    rows = rows.withColumn("_best", best)
    mass = reduce(lambda a, b: a + b, [F.exp(s - F.col("_best.s")) for s in score])
    return rows.select(
        "doc_id", "page_id",
        F.element_at(names, 1 - F.col("_best.i")).alias("lang"),
        (1 / mass).alias("posterior"),
        F.when(told, F.element_at(names, 1 - text_best["i"])).alias("text_lang"),
        "declared", "suffix", "host", "n_grams",
    )


def language_id(docs: DataFrame, pages: DataFrame, model: tuple[list[str], np.ndarray] | None = None) -> DataFrame:
    """documents (doc_id, text, source) and pages (page_id, url, html) -> one row per row of either, with page_id or doc_id null:
    (doc_id, page_id, lang, posterior, text_lang, declared, suffix, host, n_grams).

    All evidence that a row has is fused: a document has its text and its source as host; a page also its declared language and address.
    The lang column of documents trains the text model (on a bounded sample, a fifth of all ids held out) and is no evidence of a row.
    Null or letterless text: the other evidence decides, at last the corpus's prior. Null url, source or markup: that evidence is left out. Ties go to
    the language first by name. Repeated rows each get a row. Very long texts are counted whole, markup is read in one pass. Without a language to learn
    from every row is 'und'. Empty tables: no rows. Other columns are not read, whatever their names.
    """
    langs, table = model or train(docs)
    none = lambda t: F.lit(None).cast(t)
    both = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), none("bigint").alias("page_id"), "text", none("string").alias("html"), none("string").alias("url"), F.col("source").cast("string").alias("host"))
    both = both.unionAll(pages.select(none("bigint"), F.col("page_id").cast("bigint"), none("string"), "html", "url", none("string")))
    return fuse(evidence(both, langs, table), langs)
