"""Registered queries of the list engine over the driver's tables, and the same in DuckDB SQL.

The tables hold no rule lists, so lists are made of them: hosts from page addresses, blocks from order and customer keys, rules from both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import hosts as H
from .functions import prefixes as P
from .functions import rules as R
from .functions import text as T
from .operators import blocks, hosts, rules
from .operators.filters import compile_patterns
from .plans import render
from .plans.jobs import domain_job, ip_job, mirror_job, rule_job, source_stats
from .sources import formats

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f: Query) -> Query:
        _queries[f.__name__.lstrip("_")] = f
        if sql:
            _sql[f.__name__.lstrip("_")] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


# -- hosts: one a page, and for every fifth page its parent ----------------------------------------------------------------------

HOST = "regexp_extract(lower(url), '://([^/?:]+)', 1)"
HOSTS = f"h AS (SELECT CAST(page_id % 4 AS INT) AS src_idx, page_id AS pos, {HOST} AS host FROM pages)"
MORE = "m AS (SELECT host, min(pos) AS pos FROM (SELECT host, pos FROM h UNION ALL SELECT regexp_replace(host, '^[^.]+[.]', ''), pos FROM h WHERE pos % 5 = 0) GROUP BY host)"
REVERSED = "array_to_string(list_reverse(string_split(host, '.')), '.')"


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select((F.col("page_id") % 4).cast("int").alias("src_idx"), F.col("page_id").alias("pos"), "url")


def _hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("src_idx", "pos", H.normalize(F.col("url")).alias("host"))


def _more(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _hosts(spark, sf_dir).select("host", "pos")
    parents = h.where("pos % 5 = 0").select(F.regexp_replace("host", r"\A[^.]+\.", "").alias("host"), "pos")
    return hosts.first_seen(h.unionByName(parents), "host", ("pos",))


@_query(f"WITH {HOSTS} SELECT pos, host FROM h")
def host_normalize(spark, sf_dir):
    return _hosts(spark, sf_dir).select("pos", "host")


@_query(f"WITH {HOSTS} SELECT host, src_idx, pos FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY src_idx, pos) AS n FROM h) WHERE n = 1")
def host_distinct_first(spark, sf_dir):
    return hosts.first_seen(_hosts(spark, sf_dir), "host").select("host", "src_idx", "pos")


@_query(f"WITH {HOSTS}, {MORE} SELECT host, row_number() OVER (ORDER BY {REVERSED}) AS rank FROM m")
def host_reverse_sort(spark, sf_dir):
    return hosts.sorted_rank(_more(spark, sf_dir)).select("host", "rank")


@_query(f"WITH {HOSTS}, {MORE} SELECT host FROM m WHERE NOT EXISTS (SELECT 1 FROM m p WHERE p.host LIKE '%.%' AND m.host LIKE '%.' || p.host)")
def host_collapse(spark, sf_dir):
    return hosts.collapse(_more(spark, sf_dir)).select("host")


@_query(f"WITH {HOSTS}, {MORE} SELECT host FROM m WHERE host <> 'example.org' AND host NOT LIKE '%.example.org'")
def host_exclude_suffix(spark, sf_dir):
    return hosts.exclude_suffix(_more(spark, sf_dir), spark.createDataFrame([("example.org",)], "pattern string")).select("host")


@_query(f"WITH {HOSTS}, {MORE} SELECT host FROM m WHERE host NOT IN ('example.org', 'example.com')")
def host_exclude_exact(spark, sf_dir):
    return hosts.exclude_exact(_more(spark, sf_dir), spark.createDataFrame([("example.org",), ("example.com",)], "pattern string")).select("host")


@_query(f"WITH {HOSTS}, {MORE} SELECT host FROM m WHERE NOT regexp_matches(host, '^(www|blog)[.]')")
def host_exclude_regex(spark, sf_dir):
    return hosts.exclude_regex(_more(spark, sf_dir), [r"^(www|blog)[.]"]).select("host")


# -- lines -----------------------------------------------------------------------------------------------------------------------

LINES = "l AS (SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, trim(parts[i]) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents))"


@_query(f"WITH {LINES} SELECT doc_id, pos, line FROM l WHERE line <> ''")
def lines_split(spark, sf_dir):
    return T.lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), "text")


COMMENTED = "CASE CAST(pos % 4 AS INT) WHEN 0 THEN '# ' || host WHEN 1 THEN host || ' # note' WHEN 2 THEN '//' || host ELSE host || '#x y' END"


def _commented(spark, sf_dir):
    k, h = F.col("pos") % 4, F.col("host")
    line = F.when(k == 0, F.concat(F.lit("# "), h)).when(k == 1, F.concat(h, F.lit(" # note"))).when(k == 2, F.concat(F.lit("//"), h)).otherwise(F.concat(h, F.lit("#x y")))
    return _hosts(spark, sf_dir).select("pos", line.alias("line"))


@_query(f"WITH {HOSTS} SELECT pos, CASE WHEN pos % 4 IN (0, 2) THEN '' WHEN pos % 4 = 1 THEN host ELSE line END AS stripped FROM (SELECT *, {COMMENTED} AS line FROM h)")
def strip_comment(spark, sf_dir):
    return _commented(spark, sf_dir).select("pos", T.strip_comment(F.col("line")).alias("stripped"))


@_query(f"WITH {HOSTS} SELECT pos, string_split({COMMENTED}, ' ')[1] AS field FROM h")
def first_field(spark, sf_dir):
    return _commented(spark, sf_dir).select("pos", T.first_field(F.col("line")).alias("field"))


@_query("SELECT doc_id, md5(text) AS digest FROM documents")
def base64_decode(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", F.md5(T.decode(F.base64(F.col("text").cast("binary")), "base64").cast("binary")).alias("digest"))


#: Lines made of a host, and what of each a format takes: the host, or nothing.
TEMPLATES = {
    "domain": [("{}", True), ("{} trailing", True), ("# {}", False), ("{} # x", True)],
    "hosts": [("0.0.0.0 {}", True), ("::1\t{} localhost", True), ("{}", False), ("name {}", False)],
    "v2ray": [("full:{}", True), ("domain:{} @cn", True), ("{}", True), ("keyword:{}", False)],
    "dnsmasq": [("server=/{}/1.1.1.1", True), ("ipset=/.{}/set", True), ("server={}", False), ("address=/{}", False)],
    "smartdns": [("address /{}/#", True), ("{}", True), ("server {}", False), ("nameserver /{}/x", True)],
    "adblock": [("||{}^", True), ("||{}^$important", True), ("@@||{}^", False), ("||{}^$client=x", False), ("||{}/x", False), ("0.0.0.0 {}", True)],
    "autoproxy": [("||{}", True), ("|http://{}/", True), (".{}", True), ("|{}", False), ("{}/path", False)],
    "iplist": [("10.0.0.1 {}", False), ("{}", True)],
}


def _format_query(name: str, templates: list[tuple[str, bool]]) -> None:
    n = len(templates)

    def query(spark, sf_dir):
        line = F.lit(None).cast("string")
        for i, (t, _) in enumerate(templates):
            a, b = t.split("{}")
            line = F.when(F.col("pos") % n == i, F.concat(F.lit(a), F.col("host"), F.lit(b))).otherwise(line)
        found = formats.lookup(name).line(line)
        return _hosts(spark, sf_dir).select("pos", F.explode(found).alias("value"))

    taken = [i for i, (_, yes) in enumerate(templates) if yes]
    value = "host" if name != "iplist" else "CASE WHEN pos % 2 = 0 THEN '10.0.0.1' ELSE host END"
    where = f"pos % {n} IN ({', '.join(map(str, taken))})" if name != "iplist" else "true"
    query.__name__ = f"fmt_{name}"
    _query(f"WITH {HOSTS} SELECT pos, {value} AS value FROM h WHERE {where}")(query)


for _name, _templates in TEMPLATES.items():
    _format_query(_name, _templates)


@_query("SELECT * FROM (VALUES (0, 'hosts'), (1, 'adblock'), (2, 'autoproxy'), (3, 'dnsmasq'), (4, 'domain')) AS t(src_idx, format)")
def detect_format(spark, sf_dir):
    """Five lists of the same hosts in five syntaxes."""
    h = _hosts(spark, sf_dir)
    shapes = ["0.0.0.0 {}", "||{}^", "||{}", "server=/{}/x", "{}"]
    rows = None
    for i, s in enumerate(shapes):
        a, b = s.split("{}")
        part = h.select(F.lit(i).alias("src_idx"), "pos", F.concat(F.lit(a), F.col("host"), F.lit(b)).alias("line"))
        rows = part if rows is None else rows.unionByName(part)
    return formats.detect(rows)


# -- blocks: 10.a.b.c/n of order keys, with siblings and blocks inside others ----------------------------------------------------

NETS = """n AS (SELECT DISTINCT k, bits, (a // size) * size AS a FROM (SELECT o_orderkey AS k, 167772160 + (o_orderkey * 16) % 262144 AS a, CAST(22 + o_custkey % 11 AS INT) AS bits, CAST(pow(2, 10 - o_custkey % 11) AS BIGINT) AS size FROM orders)),
d AS (SELECT DISTINCT bits, a, a + CAST(pow(2, 32 - bits) AS BIGINT) AS e FROM n)"""
DOTTED = "CAST(a // 16777216 AS VARCHAR) || '.' || CAST(a // 65536 % 256 AS VARCHAR) || '.' || CAST(a // 256 % 256 AS VARCHAR) || '.' || CAST(a % 256 AS VARCHAR)"
CIDR = f"{DOTTED} || '/' || CAST(bits AS VARCHAR)"
OUTER = "o AS (SELECT * FROM d WHERE NOT EXISTS (SELECT 1 FROM d p WHERE p.bits < d.bits AND p.a <= d.a AND p.e >= d.e))"
MERGED = """s AS (SELECT *, CASE WHEN a = lag(e) OVER (ORDER BY a) THEN 0 ELSE 1 END AS fresh FROM o), r AS (SELECT *, sum(fresh) OVER (ORDER BY a) AS run FROM s),
i AS (SELECT min(a) AS a, max(e) AS e FROM r GROUP BY run),
c AS (SELECT a, e, CASE WHEN a % 2 = 1 THEN 1 ELSE least(CAST(a & -a AS BIGINT), CAST(pow(2, floor(log2(e - a))) AS BIGINT)) END AS size FROM i
UNION ALL SELECT a + size, e, least(CAST((a + size) & -(a + size) AS BIGINT), CAST(pow(2, floor(log2(e - a - size))) AS BIGINT)) FROM c WHERE a + size < e)"""


def _nets(spark, sf_dir) -> DataFrame:
    a = F.lit(167772160) + (F.col("o_orderkey") * 16) % 262144
    dotted = F.concat_ws(".", *[(F.shiftright(a, s) % 256).cast("string") for s in (24, 16, 8, 0)])
    raw = F.concat(dotted, F.lit("/"), (22 + F.col("o_custkey") % 11).cast("string"))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k"), raw.alias("raw"))


def _net_blocks(spark, sf_dir) -> DataFrame:
    return _nets(spark, sf_dir).select(P.parse(F.col("raw")).alias("b")).select("b.*")


def _cidr():
    return P.cidr(F.struct(*blocks.KEYS)).alias("cidr")


@_query(f"WITH {NETS} SELECT k, {CIDR} AS cidr FROM n")
def ip_parse(spark, sf_dir):
    return _nets(spark, sf_dir).select("k", P.cidr(P.parse(F.col("raw"))).alias("cidr"))


# The same blocks in IPv6: the 32 bits of an address are the second half of 2001:db8:x:y::, written in capitals with leading zeros.
CIDR6 = "'2001:db8:' || printf('%x', a // 65536) || CASE WHEN a % 65536 = 0 THEN '' ELSE ':' || printf('%x', a % 65536) END || '::/' || CAST(bits + 32 AS VARCHAR)"


def _nets6(spark, sf_dir) -> DataFrame:
    a = F.lit(167772160) + (F.col("o_orderkey") * 16) % 262144
    group = lambda x: F.lpad(F.hex(x), 4, "0")
    raw = F.concat(F.lit("2001:0DB8:"), group(F.shiftright(a, 16)), F.lit(":"), group(a % 65536), F.lit("::1/"), (54 + F.col("o_custkey") % 11).cast("string"))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k"), raw.alias("raw"))


def _net_blocks6(spark, sf_dir) -> DataFrame:
    return _nets6(spark, sf_dir).select(P.parse(F.col("raw")).alias("b")).select("b.*")


@_query(f"WITH {NETS} SELECT k, {CIDR6} AS cidr FROM n")
def ip6_parse(spark, sf_dir):
    return _nets6(spark, sf_dir).select("k", P.cidr(P.parse(F.col("raw"))).alias("cidr"))


@_query(f"WITH {NETS}, {OUTER} SELECT {CIDR6} AS cidr FROM o")
def ip6_dedupe(spark, sf_dir):
    return blocks.dedupe(_net_blocks6(spark, sf_dir)).select(_cidr())


@_query(f"WITH RECURSIVE {NETS}, {OUTER}, {MERGED}, z AS (SELECT a, CAST(32 - round(log2(size)) AS INT) AS bits FROM c) SELECT {CIDR6} AS cidr FROM z")
def ip6_aggregate(spark, sf_dir):
    return blocks.aggregate(_net_blocks6(spark, sf_dir)).select(_cidr())


@_query(f"WITH {NETS} SELECT {CIDR6} AS cidr FROM d WHERE NOT (a >= 167772160 AND e <= 167772160 + 65536)")
def ip6_exclude(spark, sf_dir):
    patterns = spark.createDataFrame([("2001:db8:a00::/48",)], "s string").select(P.parse(F.col("s")).alias("b")).select("b.*")
    return blocks.exclude(_net_blocks6(spark, sf_dir).distinct(), patterns).select(_cidr())


@_query(f"WITH {NETS} SELECT row_number() OVER (ORDER BY a, bits) AS rank, {CIDR6} AS line FROM (SELECT DISTINCT a, bits FROM n)")
def ip6_order(spark, sf_dir):
    return hosts.ranked(_net_blocks6(spark, sf_dir).distinct(), *blocks.sort_keys()).select("rank", _cidr().alias("line"))


@_query(f"WITH {NETS}, t AS (SELECT DISTINCT a, bits, CASE WHEN bits = 32 THEN {DOTTED} ELSE {CIDR} END AS shown FROM n) SELECT shown FROM t WHERE NOT regexp_matches(shown, '^10[.]1[.]|/30$')")
def ip_exclude_regex(spark, sf_dir):
    """Expressions meet a block's text, an address alone without its length."""
    left = compile_patterns(spark, [r"/^10[.]1[.]/", "//30$/"]).blocks(_net_blocks(spark, sf_dir).distinct())
    return left.select(P.text(F.struct(*blocks.KEYS)).alias("shown"))


@_query(f"WITH {NETS} SELECT k, CASE WHEN bits = 32 THEN {DOTTED} ELSE {CIDR} END AS shown FROM n")
def ip_format(spark, sf_dir):
    return _nets(spark, sf_dir).select("k", P.text(P.parse(F.col("raw"))).alias("shown"))


@_query(f"WITH {NETS}, {OUTER} SELECT {CIDR} AS cidr FROM o")
def ip_dedupe(spark, sf_dir):
    return blocks.dedupe(_net_blocks(spark, sf_dir)).select(_cidr())


@_query(f"WITH RECURSIVE {NETS}, {OUTER}, {MERGED} SELECT {DOTTED} || '/' || CAST(CAST(32 - round(log2(size)) AS INT) AS VARCHAR) AS cidr FROM c")
def ip_aggregate(spark, sf_dir):
    return blocks.aggregate(_net_blocks(spark, sf_dir)).select(_cidr())


@_query(f"WITH {NETS} SELECT {CIDR} AS cidr FROM d WHERE NOT (a >= 167772160 AND e <= 167772160 + 65536) AND NOT (a >= 167903232 AND e <= 167903232 + 4096)")
def ip_exclude(spark, sf_dir):
    patterns = spark.createDataFrame([("10.0.0.0/16",), ("10.2.0.0/20",)], "s string").select(P.parse(F.col("s")).alias("b")).select("b.*")
    return blocks.exclude(_net_blocks(spark, sf_dir).distinct(), patterns).select(_cidr())


# -- rules -----------------------------------------------------------------------------------------------------------------------

RULES = f"""{HOSTS}, x AS (SELECT pos, host, CAST(pos % 6 AS INT) AS k, CAST(pos % 200 AS VARCHAR) AS b FROM h),
v AS (SELECT pos, CASE k WHEN 0 THEN 'domain,' || upper(host) WHEN 1 THEN 'DOMAIN-SUFFIX,' || host || ',opt' WHEN 2 THEN 'IP-CIDR,10.' || b || '.7.7/16,no-resolve' WHEN 3 THEN '+.' || host WHEN 4 THEN 'DOMAIN-KEYWORD,' || string_split(host, '.')[1] ELSE 'NOPE,' || host END AS raw, k, host, b FROM x),
t AS (SELECT pos, CASE k WHEN 0 THEN 'DOMAIN' WHEN 2 THEN 'IP-CIDR' WHEN 4 THEN 'DOMAIN-KEYWORD' ELSE 'DOMAIN-SUFFIX' END AS type, CASE k WHEN 2 THEN '10.' || b || '.0.0/16' WHEN 4 THEN string_split(host, '.')[1] ELSE host END AS value, CASE k WHEN 1 THEN ',opt' WHEN 2 THEN ',no-resolve' ELSE '' END AS opts FROM v WHERE k < 5),
u AS (SELECT type, value, arg_min(opts, pos) AS opts, min(pos) AS pos FROM t GROUP BY type, value),
f AS (SELECT * FROM u WHERE NOT (type IN ('DOMAIN', 'DOMAIN-SUFFIX') AND EXISTS (SELECT 1 FROM u p WHERE p.type = 'DOMAIN-SUFFIX' AND (u.value LIKE '%.' || p.value OR u.type = 'DOMAIN' AND u.value = p.value)))),
g AS (SELECT *, CASE type WHEN 'DOMAIN-KEYWORD' THEN 0 WHEN 'DOMAIN' THEN 1 WHEN 'DOMAIN-SUFFIX' THEN 2 ELSE 6 END AS grp FROM f)"""


def _rule_items(spark, sf_dir) -> DataFrame:
    k, h = F.col("pos") % 6, F.col("host")
    b = (F.col("pos") % 200).cast("string")
    raw = (
        F.when(k == 0, F.concat(F.lit("domain,"), F.upper(h))).when(k == 1, F.concat(F.lit("DOMAIN-SUFFIX,"), h, F.lit(",opt"))).when(k == 2, F.concat(F.lit("IP-CIDR,10."), b, F.lit(".7.7/16,no-resolve")))
        .when(k == 3, F.concat(F.lit("+."), h)).when(k == 4, F.concat(F.lit("DOMAIN-KEYWORD,"), F.substring_index(h, ".", 1))).otherwise(F.concat(F.lit("NOPE,"), h))
    )
    return _hosts(spark, sf_dir).select(F.lit(0).alias("src_idx"), "pos", F.lit("rule").alias("kind"), raw.alias("value"))


@_query(f"""WITH {RULES} SELECT pos, k < 5 AS valid, k = 3 AS scalar,
CASE k WHEN 0 THEN 'DOMAIN' WHEN 1 THEN 'DOMAIN-SUFFIX' WHEN 2 THEN 'IP-CIDR' WHEN 4 THEN 'DOMAIN-KEYWORD' ELSE '' END AS type,
CASE k WHEN 0 THEN upper(host) WHEN 1 THEN host WHEN 2 THEN '10.' || b || '.7.7/16' WHEN 3 THEN '+.' || host WHEN 4 THEN string_split(host, '.')[1] ELSE '' END AS value,
CASE k WHEN 1 THEN 'opt' WHEN 2 THEN 'no-resolve' ELSE '' END AS options FROM v""")
def rule_parse(spark, sf_dir):
    rule = R.parse(F.col("value"))
    told = _rule_items(spark, sf_dir).select("pos", rule.alias("r"))
    text = lambda c: F.coalesce(c, F.lit(""))
    return told.select("pos", F.col("r").isNotNull().alias("valid"), F.coalesce("r.scalar", F.lit(False)).alias("scalar"), text(F.col("r.type")).alias("type"), text(F.col("r.value")).alias("value"), text(F.array_join("r.options", ",")).alias("options"))


@_query(f"WITH {RULES} SELECT type || ',' || value || opts AS line FROM u WHERE NOT regexp_matches(type || ',' || value || opts, 'no-resolve$|^DOMAIN-KEYWORD,b') AND type || ',' || value <> 'DOMAIN,example.org' AND NOT (type IN ('DOMAIN', 'DOMAIN-SUFFIX') AND regexp_matches(value, 'no-resolve$|^DOMAIN-KEYWORD,b'))")
def rule_exclude(spark, sf_dir):
    """Expressions on rules' text with options, and an exact rule."""
    items = _rule_items(spark, sf_dir).select("src_idx", "pos", R.of_item(F.col("kind"), F.col("value"), F.lit(False)).alias("rule")).where("rule is not null")
    left = compile_patterns(spark, ["/no-resolve$|^DOMAIN-KEYWORD,b/", "=DOMAIN,example.org"]).canonical_rules(rules.distinct(items))
    return left.select(R.text(F.col("rule")).alias("line"))


def _rule_lines(spark, sf_dir) -> DataFrame:
    return _rule_items(spark, sf_dir).select("pos", R.canonical(R.parse(F.col("value"))).alias("r")).where("r is not null").select("pos", R.text(F.col("r")).alias("line"), "r.type")


def _rule_render(name: str, behavior: str, kinds: tuple[str, ...], sql: str) -> None:
    def query(spark, sf_dir):
        return render.rendered(_rule_lines(spark, sf_dir).where(F.col("type").isin(*kinds)), "clash", "clash", behavior).select("pos", "out")

    query.__name__ = f"render_rules_{name}"
    _query(f"WITH {RULES} SELECT pos, {sql} AS out FROM t WHERE type IN ({', '.join(map(repr, kinds))})")(query)


_rule_render("classical", "classical", ("DOMAIN", "DOMAIN-SUFFIX", "IP-CIDR", "DOMAIN-KEYWORD"), "'  - ' || type || ',' || value || opts")
_rule_render("domain", "domain", ("DOMAIN", "DOMAIN-SUFFIX"), "'  - ' || chr(39) || CASE type WHEN 'DOMAIN' THEN '' ELSE '+.' END || value || chr(39)")
_rule_render("ipcidr", "ipcidr", ("IP-CIDR",), "'  - ' || chr(39) || value || chr(39)")


PAYLOADS = "SELECT page_id AS src_idx, string_split(regexp_replace(host, '^www[.]', ''), '.') AS ls FROM (SELECT page_id, regexp_extract(lower(url), '://([^/?:]+)', 1) AS host FROM pages)"


@_query(f"SELECT src_idx, pos, 'rule' AS kind, value FROM (SELECT src_idx, CAST(0 AS BIGINT) AS pos, 'DOMAIN,' || ls[1] || '.yes' AS value FROM ({PAYLOADS}) UNION ALL SELECT src_idx, 1, '1.10' FROM ({PAYLOADS}) UNION ALL SELECT src_idx, 2, ls[1] FROM ({PAYLOADS}))")
def fmt_clash(spark, sf_dir):
    """YAML bodies, one a page: strings stay as written, blanks go."""
    label = F.split(F.regexp_replace("host", r"\Awww\.", ""), r"\.")[0]
    bodies = _hosts(spark, sf_dir).select(F.col("pos").alias("src_idx"), F.concat(F.lit("payload:\n  - 'DOMAIN,"), label, F.lit(".yes'\n  - 1.10\n  - ''\n  - \""), label, F.lit(" \"\n")).alias("body"))
    found = formats.items(bodies, "clash")
    order = Window.partitionBy("src_idx").orderBy("pos")
    return found.select("src_idx", (F.row_number().over(order) - 1).cast("bigint").alias("pos"), "kind", "value")


@_query(f"WITH {HOSTS} SELECT pos AS src_idx, CAST(i AS BIGINT) AS n, 'domain' AS kind, v AS value FROM (SELECT pos, host, unnest(range(0, 2)) AS i, unnest([host, 'b.' || host]) AS v FROM h WHERE pos % 3 < 2)")
def items_auto(spark, sf_dir):
    """Bodies of a few lines in hosts or adblock syntax, told apart by detection; others hold comments alone."""
    h, k = F.col("host"), F.col("pos") % 3
    body = (
        F.when(k == 0, F.concat(F.lit("\ufeff# list\n0.0.0.0 "), h, F.lit(" localhost\n\n::1 b."), h))
        .when(k == 1, F.concat(F.lit("! list\n||"), h, F.lit("^\n@@||x.y^\n||b."), h, F.lit("^$important")))
        .otherwise("# nothing\n! here")
    )
    found = formats.items(_hosts(spark, sf_dir).select(F.col("pos").alias("src_idx"), body.alias("body")))
    order = Window.partitionBy("src_idx").orderBy("pos")
    return found.select("src_idx", (F.row_number().over(order) - 1).cast("bigint").alias("n"), "kind", "value")


@_query(f"WITH {HOSTS} SELECT pos, CASE WHEN pos % 2 = 0 THEN host || chr(10) || 'b.' || host ELSE to_base64(encode(host || 'xxxxxxxxxxxx')) END AS body FROM h")
def base64_sniff(spark, sf_dir):
    """Lines in base64 are decoded; what only looks like base64 (no line break inside) stays."""
    lines = F.concat("host", F.lit("\nb."), "host")
    body = F.when(F.col("pos") % 2 == 0, F.base64(lines.cast("binary"))).otherwise(F.base64(F.concat("host", F.lit("xxxxxxxxxxxx")).cast("binary")))
    return _hosts(spark, sf_dir).select("pos", T.decode(body, "auto").alias("body"))


@_query(f"WITH {HOSTS} SELECT pos, 'xn--mnchen-3ya.' || host AS host FROM h")
def host_idna(spark, sf_dir):
    """Hosts with letters beyond ASCII, capitals among them, in punycode."""
    raw = F.concat(F.when(F.col("pos") % 2 == 0, "MÜNCHEN.").otherwise("münchen."), F.col("host"))
    return _hosts(spark, sf_dir).select("pos", H.normalize(H.to_ascii(raw)).alias("host"))


@_query(f"WITH {RULES} SELECT pos, type || ',' || value || opts AS line FROM t")
def rule_canonical(spark, sf_dir):
    return _rule_items(spark, sf_dir).select("pos", R.text(R.canonical(R.parse(F.col("value")))).alias("line")).where("line is not null")


@_query(f"WITH {RULES} SELECT row_number() OVER (ORDER BY grp, pos) AS rank, type || ',' || value || opts AS line FROM g")
def job_rules(spark, sf_dir):
    """Distinct, collapsed and grouped: the whole rule job in source order."""
    return rule_job(_rule_items(spark, sf_dir)).ranked()


@_query(f"WITH {RULES} SELECT row_number() OVER (ORDER BY grp, CASE WHEN type IN ('DOMAIN', 'DOMAIN-SUFFIX') THEN array_to_string(list_reverse(string_split(value, '.')), '.') WHEN type = 'IP-CIDR' THEN lpad(string_split(value, '.')[2], 3, '0') ELSE value END) AS rank, type || ',' || value || opts AS line FROM g")
def job_rules_sorted(spark, sf_dir):
    return rule_job(_rule_items(spark, sf_dir), order="sorted").ranked()


@_query(f"WITH {RULES} SELECT row_number() OVER (ORDER BY pos) AS rank, raw AS line FROM v WHERE k < 5 AND NOT (k IN (0, 1, 3) AND (host = 'example.org' OR host LIKE '%.example.org')) AND NOT (k = 2 AND b = '2')")
def job_mirror(spark, sf_dir):
    """Rules as written, without what a suffix and an address pattern exclude."""
    return mirror_job(_rule_items(spark, sf_dir), compile_patterns(spark, ["example.org", "10.2.0.0/16"])).ranked()


# -- whole jobs ------------------------------------------------------------------------------------------------------------------

DOMAIN_JOB = f"{HOSTS}, {MORE}, e AS (SELECT * FROM m WHERE NOT (host = 'spam-farm.example.org' OR host LIKE '%.spam-farm.example.org')), j AS (SELECT host, row_number() OVER (ORDER BY {REVERSED}) AS rank FROM e WHERE NOT EXISTS (SELECT 1 FROM e p WHERE e.host LIKE '%.' || p.host))"


def _domain_items(spark, sf_dir) -> DataFrame:
    urls = _pages(spark, sf_dir)
    parents = _hosts(spark, sf_dir).where("pos % 5 = 0").select("src_idx", "pos", F.regexp_replace("host", r"\A[^.]+\.", "+.").alias("value"))
    return urls.select("src_idx", "pos", F.col("url").alias("value")).unionByName(parents).withColumn("kind", F.lit("domain"))


@_query(f"WITH {DOMAIN_JOB} SELECT rank, host AS line FROM j")
def job_domain(spark, sf_dir):
    """Page addresses to an ordered host list: normalise, validate, exclude, first seen, collapse, sort."""
    return domain_job(_domain_items(spark, sf_dir), compile_patterns(spark, ["spam-farm.example.org"])).ranked()


@_query(f"WITH {DOMAIN_JOB} SELECT sha256(string_agg(host, chr(10) ORDER BY rank) || chr(10)) AS hash, count(*) AS entries FROM j")
def content_hash(spark, sf_dir):
    return T.content_hash(job_domain(spark, sf_dir))


def _render_query(name: str, format: str, behavior: str, sql: str) -> None:
    def query(spark, sf_dir):
        return render.rendered(job_domain(spark, sf_dir), format, "domain", behavior).select("rank", "out")

    query.__name__ = f"render_{name}"
    _query(f"WITH {DOMAIN_JOB} SELECT rank, {sql} AS out FROM j")(query)


_render_query("plain", "plain", "", "host")
_render_query("smartdns", "smartdns", "", "'address /' || host || '/#'")
_render_query("clash_classical", "clash", "classical", "'  - DOMAIN-SUFFIX,' || host")
_render_query("clash_domain", "clash", "domain", "'  - ''+.' || host || ''''")


@_query(f"WITH RECURSIVE {NETS}, {OUTER}, {MERGED}, z AS (SELECT a, CAST(32 - round(log2(size)) AS INT) AS bits FROM c) SELECT row_number() OVER (ORDER BY a) AS rank, CASE WHEN bits = 32 THEN {DOTTED} ELSE {CIDR} END AS line FROM z")
def job_ip(spark, sf_dir):
    items = _nets(spark, sf_dir).select(F.lit(0).alias("src_idx"), F.col("k").alias("pos"), F.lit("ip").alias("kind"), F.col("raw").alias("value"))
    return ip_job(items).ranked()


def _ip_render(name: str, format: str, sql: str) -> None:
    def query(spark, sf_dir):
        return render.rendered(job_ip(spark, sf_dir), format, "ip").select("rank", "out")

    query.__name__ = f"render_{name}"
    _query(f"WITH RECURSIVE {NETS}, {OUTER}, {MERGED}, z AS (SELECT a, CAST(32 - round(log2(size)) AS INT) AS bits FROM c) SELECT row_number() OVER (ORDER BY a) AS rank, {sql} AS out FROM z")(query)


_ip_render("iplist", "iplist", f"CASE WHEN bits = 32 THEN {DOTTED} ELSE {CIDR} END")
_ip_render("clash_ip_classical", "clash", f"'  - IP-CIDR,' || {CIDR} || ',no-resolve'")


@_query(f"WITH RECURSIVE {NETS}, {OUTER}, {MERGED}, z AS (SELECT a, CAST(32 - round(log2(size)) AS INT) AS bits FROM c) SELECT row_number() OVER (ORDER BY a) AS rank, '  - ''' || {CIDR} || '''' AS out FROM z")
def render_clash_ipcidr(spark, sf_dir):
    return render.rendered(job_ip(spark, sf_dir), "clash", "ip", "ipcidr").select("rank", "out")


@_query(f"WITH {RULES} SELECT CAST(0 AS INT) AS src_idx, count_if(k < 5) AS valid, count_if(k = 5) AS invalid, CAST(0 AS BIGINT) AS excluded FROM v")
def source_counts(spark, sf_dir):
    return source_stats(rule_job(_rule_items(spark, sf_dir))).select("src_idx", "valid", "invalid", "excluded")
