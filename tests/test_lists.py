"""Formats, operators and jobs on small lists."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from thicket.functions import prefixes as P
from thicket.functions import rules as R
from thicket.operators import blocks, hosts, rules
from thicket.operators.filters import PatternError, compile_patterns
from thicket.plans.jobs import domain_job, ip_job, mirror_job, rule_job, source_stats
from thicket.sources import formats

LISTS = {
    "domain": ("# head\none.example\n  two.example trailing\n// x\nThree.Example # note\n", ["one.example", "two.example", "Three.Example"]),
    "hosts": ("127.0.0.1 localhost\n0.0.0.0 ads.example track.example # x\n::1\tip6-localhost six.example\nbare.example\n", ["ads.example", "track.example", "six.example"]),
    "adblock": ("[Adblock Plus]\n! c\n||ads.example^\n||mod.example^$important\n||skip.example^$badfilter\n@@||ok.example^\n||wild*.example^\nx.example##.ad\n/re/\n|http://u.example\nbare.example\n0.0.0.0 hosty.example\n||nocaret.example\n||path.example/x\na b\n", ["ads.example", "mod.example", "bare.example", "hosty.example", "nocaret.example"]),
    "autoproxy": ("[AutoProxy 0.2.9]\n!c\n||one.example\n|http://two.example/\n|https://two.example/path\n.three.example\nfour.example\n@@||no.example\n/re/\n*.w.example\n|nourl\n", ["one.example", "two.example", "three.example", "four.example"]),
    "dnsmasq": ("server=/one.example/1.1.1.1\nipset=/.two.example/three.example/set\naddress=/four.example/\nlog-queries\nserver=1.1.1.1\n", ["one.example", "two.example", "three.example", "four.example"]),
    "smartdns": ("address /one.example/#\nnameserver /two.example/grp\nserver 1.1.1.1\nbare.example\nspeed-check-mode ping\nipset /three.example/x\n", ["one.example", "two.example", "bare.example", "three.example"]),
    "v2ray": ("full:one.example\ndomain:two.example @cn\nthree.example\nregexp:^x\nkeyword:ads\ninclude:other\n", ["one.example", "two.example", "three.example"]),
    "iplist": ("10.0.0.0/8 # x\n2001:db8::/32\n; c\n10.1.1.1\t5\n", ["10.0.0.0/8", "2001:db8::/32", "10.1.1.1"]),
    "clash": ("# c\npayload:\n  - DOMAIN,one.example\n  - '+.two.example'\n  - 1.10\n  - IP-CIDR,10.0.0.0/8,no-resolve\n", ["DOMAIN,one.example", "+.two.example", "1.10", "IP-CIDR,10.0.0.0/8,no-resolve"]),
}


def test_every_format_and_its_detection(spark):
    names = list(LISTS)
    bodies = spark.createDataFrame([(i, LISTS[n][0]) for i, n in enumerate(names)], "src_idx int, body string")
    for chosen in (dict(enumerate(names)), None):
        rows = formats.items(bodies, chosen).orderBy("src_idx", "pos").collect()
        for i, n in enumerate(names):
            assert [r.value for r in rows if r.src_idx == i] == LISTS[n][1], (n, chosen)
            assert {r.kind for r in rows if r.src_idx == i} == {formats.lookup(n).kind}


def test_detection_counts(spark):
    bodies = ["\n".join([f"h{i}.example" for i in range(63)] + ["10.0.0.1"]), "\n".join([f"h{i}.example" for i in range(64)] + ["10.0.0.1"]), "! c\n" * 100 + "[Adblock Plus]\nx.example", "full:a.example\n10.0.0.1\n", "a.example\n" * 64 + "payload:\n", "", "# only\n", "payload: []\n"]
    rows = spark.createDataFrame(list(enumerate(bodies)), "src_idx int, body string")
    from thicket.functions.text import lines

    got = {r.src_idx: r.format for r in formats.detect(lines(rows)).collect()}
    assert [got.get(i) for i in range(len(bodies))] == ["iplist", "domain", "adblock", "v2ray", "domain", None, None, "clash"]
    assert formats.items(rows.where("src_idx in (5, 6, 7)")).count() == 0


def test_bad_yaml_is_an_error_row(spark):
    rows = spark.createDataFrame([(0, "payload: [a"), (1, "payload:\n"), (2, "other: 1"), (3, "payload: {a: b}")], "src_idx int, body string")
    assert [r.kind for r in formats.items(rows, "clash").collect()] == ["error"] * 4


def test_hosts(spark):
    given = ["b.a.example", "a.example", "example", "x.b.a.example", "q.example", "ba.example", "z"]
    rows = spark.createDataFrame([(0, i, h) for i, h in enumerate([*given, "a.example"])], "src_idx int, pos long, host string")
    seen = hosts.first_seen(rows, "host")
    assert {(r.host, r.pos) for r in seen.collect()} == {(h, i) for i, h in enumerate(given)}
    assert {r.host for r in hosts.collapse(seen).collect()} == {"a.example", "example", "q.example", "ba.example", "z"}
    order = [r.host for r in hosts.sorted_rank(seen).orderBy("rank").collect()]
    assert order == sorted(given, key=lambda h: ".".join(reversed(h.split("."))))


def test_ranks_over_many_ranges(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).cast("string").alias("line"))
    got = [r.line for r in hosts.ranked(rows, "line").orderBy("rank").collect()]
    assert got == sorted(got) and len(got) == 5000
    assert hosts.ranked(rows.where("false"), "line").count() == 0


def test_merged_blocks_against_the_library(spark):
    rng = random.Random(11)
    nets = [ipaddress.ip_network((rng.choice([0x0A000000, 0x0A010000, 0x0AFFFF00]) + rng.getrandbits(9), rng.randint(23, 32)), strict=False) for _ in range(150)]
    nets += [ipaddress.ip_network((x, 16), strict=False) for x in (0x14000000, 0x14010000)] + [ipaddress.ip_network("20.2.0.0/15"), ipaddress.ip_network("128.0.0.0/2"), ipaddress.ip_network("192.0.0.0/2")]
    nets += [ipaddress.ip_network((0x20010DB8 << 96 | rng.getrandbits(5), rng.randint(123, 128)), strict=False) for _ in range(40)]
    rows = spark.createDataFrame([(str(n),) for n in nets], "s string").select(P.parse(F.col("s")).alias("b")).select("b.*")
    shown = lambda df: {r[0] for r in df.select(P.cidr(F.struct(*blocks.KEYS))).collect()}
    want = {str(n) for v in (4, 6) for n in ipaddress.collapse_addresses(n for n in nets if n.version == v)}
    assert shown(blocks.aggregate(rows)) == want
    outer = {n for n in nets if not any(m != n and m.version == n.version and n.subnet_of(m) for m in nets)}
    assert shown(blocks.dedupe(rows)) == {str(n) for n in outer}


def _items(spark, *sources):
    return spark.createDataFrame([(s, i, k, v) for s, (k, values) in enumerate(sources) for i, v in enumerate(values)], "src_idx int, pos long, kind string, value string")


def _lines(plan):
    got = [r[0] for r in plan.ordered().collect()]
    assert got == [r.line for r in plan.ranked().orderBy("rank").collect()]
    return got


def test_domain_job(spark):
    items = _items(spark, ("domain", ["b.one.example", "one.example", "bad_host", "x.skip.example", "keep.example"]), ("rule", ["DOMAIN,two.example", "DOMAIN-SUFFIX,lan", "IP-CIDR,10.0.0.0/8", "DOMAIN,one.example"]))
    job = domain_job(items, compile_patterns(spark, ["=keep.example"]), {0: compile_patterns(spark, ["skip.example", "/^zz/"])}, "source")
    assert _lines(job) == ["one.example", "two.example"]
    stats = {r.src_idx: (r.valid, r.invalid, r.excluded, r.samples) for r in source_stats(job).collect()}
    assert stats == {0: (4, 1, 1, ["bad_host"]), 1: (2, 2, 0, ["DOMAIN-SUFFIX,lan", "IP-CIDR,10.0.0.0/8"])}
    assert _lines(domain_job(items, None, None, "sorted", False, [1])) == sorted(["keep.example", "lan", "one.example", "x.skip.example", "two.example"], key=lambda h: ".".join(reversed(h.split("."))))


def test_ip_job(spark):
    items = _items(spark, ("ip", ["10.0.0.0/25", "10.0.0.128/25", "10.0.0.5", "192.168.1.1", "x", "2001:db8::/33", "2001:db8:8000::/33"]), ("rule", ["IP-CIDR,172.16.0.0/12", "GEOIP,XX"]))
    assert _lines(ip_job(items, compile_patterns(spark, ["192.168.0.0/16"]))) == ["10.0.0.0/24", "172.16.0.0/12", "2001:db8::/32"]
    assert _lines(ip_job(items, compile_patterns(spark, ["/^192/", "172.0.0.0/8"]), None, False)) == ["10.0.0.0/25", "10.0.0.128/25", "2001:db8::/33", "2001:db8:8000::/33"]


def test_rule_jobs(spark):
    entries = ["DOMAIN,a.one.example", "DOMAIN-SUFFIX,one.example,x", "DOMAIN-SUFFIX,one.example,y", "IP-CIDR,10.1.0.0/16,no-resolve", "10.0.0.0/8", "DOMAIN-KEYWORD,ads", "DOMAIN,c.lan", "DOMAIN-SUFFIX,lan", "DOMAIN-SUFFIX,d.lan", "GEOIP,XX", "NETWORK,udp", "nope nope", "DOMAIN-KEYWORD,aab"]
    items = _items(spark, ("rule", entries))
    assert _lines(rule_job(items)) == ["DOMAIN-KEYWORD,ads", "DOMAIN-KEYWORD,aab", "DOMAIN-SUFFIX,one.example,x", "DOMAIN-SUFFIX,lan", "DOMAIN-SUFFIX,d.lan", "IP-CIDR,10.0.0.0/8", "GEOIP,XX", "NETWORK,udp"]
    assert _lines(rule_job(items, compile_patterns(spark, ["=geoip,XX", "/udp$/", "lan"]), order="sorted")) == ["DOMAIN-KEYWORD,aab", "DOMAIN-KEYWORD,ads", "DOMAIN-SUFFIX,one.example,x", "IP-CIDR,10.0.0.0/8"]
    mirrored = mirror_job(_items(spark, ("rule", [*entries, "'+.q.example'", "domain,A.example", "DOMAIN-KEYWORD,ads"])), compile_patterns(spark, ["lan"]))
    assert _lines(mirrored) == [*entries[:6], "GEOIP,XX", "NETWORK,udp", "DOMAIN-KEYWORD,aab", "+.q.example", "domain,A.example", "DOMAIN-KEYWORD,ads"]


def test_unlisted_types_sort_in_runs(spark):
    items = _items(spark, ("rule", ["NETWORK,b", "NETWORK,a", "DST-PORT,9", "DST-PORT,1", "NETWORK,0"]))
    assert _lines(rule_job(items, order="sorted")) == ["NETWORK,a", "NETWORK,b", "DST-PORT,1", "DST-PORT,9", "NETWORK,0"]


@pytest.mark.parametrize("pattern", ["bad_host", "=bad_host", "/(/", "/a(?=b)/", r"/(a)\1/", "=NOPE,x", "=10.0.0.0/8"])
def test_bad_patterns(spark, pattern):
    with pytest.raises(PatternError):
        compile_patterns(spark, [pattern])


def test_collapse_keeps_other_rules(spark):
    rows = spark.createDataFrame([(0, 0, "SRC-IP-CIDR,10.1.0.0/16"), (0, 1, "IP-CIDR,10.0.0.0/8"), (0, 2, "IP-CIDR,10.1.1.1")], "src_idx int, pos long, v string")
    got = rules.collapse(rows.select("src_idx", "pos", R.canonical(R.parse(F.col("v"))).alias("rule")))
    assert {r[0] for r in got.select(R.text(F.col("rule"))).collect()} == {"SRC-IP-CIDR,10.1.0.0/16", "IP-CIDR,10.0.0.0/8"}
