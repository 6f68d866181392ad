"""Column functions, each held against tables of cases in one plan."""

import base64
import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from thicket.functions import hosts as H
from thicket.functions import prefixes as P
from thicket.functions import rules as R
from thicket.functions import text as T


def apply(spark, values, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in sorted(rows.select("i", column(F.col("v"))).collect(), key=lambda r: r[0])]


def check(spark, cases, column):
    assert dict(zip(cases, apply(spark, list(cases), column), strict=True)) == cases


def test_normalize(spark):
    cases = {
        "Shop.Example": "shop.example", "  a.example\t": "a.example", "'q.example'": "q.example", '""q.example\'': "q.example",
        "https://u.example/path?x": "u.example", "ftp://u.example:21/": "u.example", "p.example?x=1": "p.example", "p.example:8443": "p.example",
        "*.w.example": "w.example", "+.w.example": "w.example", ".w.example": "w.example", "*.+..w.example": "w.example", "dot.example.": "dot.example",
        "dot.example..": None, "": None, " ": None, "single": None, "a_b.example": None, "-a.example": None, "a-.example": None, "a..example": None,
        "a.1": None, "1.2.3.4": None, "a.xn--p1ai": "a.xn--p1ai", "9.a1": "9.a1", "x" * 63 + ".example": "x" * 63 + ".example", "x" * 64 + ".example": None,
        ".".join(["abcdefg"] * 31) + ".abcde": ".".join(["abcdefg"] * 31) + ".abcde", ".".join(["abcdefg"] * 31) + ".abcdef": None, "a b.example": None, "a.com\n/x": None, "a.b-": None,
    }
    check(spark, cases, H.normalize)
    check(spark, {"single": "single", "com.": "com", "7up": None, "+.lan": "lan"}, lambda c: H.normalize(c, True))


def test_hosts_with_other_letters(spark):
    cases = {"Bücher.example": "xn--bcher-kva.example", "https://bücher.example/ü": "xn--bcher-kva.example", "例え.テスト": "xn--r8jz45g.xn--zckzah", "+.bücher.example": "xn--bcher-kva.example", "a b.ü": None, "☃.example": "xn--n3h.example"}
    check(spark, cases, lambda c: H.normalize(H.to_ascii(c)))
    check(spark, {"DOMAIN,bücher.example,x": "DOMAIN,xn--bcher-kva.example,x", "DOMAIN-KEYWORD,bücher": "DOMAIN-KEYWORD,bücher"}, H.to_ascii)


def test_reversed_and_ancestors(spark):
    check(spark, {"a.b.c": "c.b.a", "a": "a"}, H.reverse_labels)
    assert apply(spark, ["a.b.c", "c"], H.ancestors) == [["c", "b.c"], []]
    assert apply(spark, ["a.b.c", "b.c", "c"], lambda c: H.ancestors(c, 2)) == [["b.c"], [], []]
    assert apply(spark, ["a.b", "c"], lambda c: H.ancestors(c, 1, True)) == [["b", "a.b"], ["c"]]


def test_lines(spark):
    rows = spark.createDataFrame([(0, "﻿ a \r\n\n\t b　\n"), (1, None), (2, "x\ry")], "src_idx int, body string")
    assert [(r.src_idx, r.line) for r in T.lines(rows).orderBy("src_idx", "pos").collect()] == [(0, "a"), (0, "b"), (2, "x\ry")]


def test_comments_and_fields(spark):
    check(spark, {"# a": "", "! a": "", "; a": "", "// a": "", "a # b": "a", "a\t#b": "a", "a#b": "a#b", " a ": "a", "a #b #c": "a", "/a": "/a", "": ""}, T.strip_comment)
    check(spark, {"a b": "a", "a\tb": "a", "a": "a", "": ""}, T.first_field)
    assert apply(spark, [" a  b\tc ", ""], T.fields) == [["a", "b", "c"], []]


def test_decoding(spark):
    text = "||one.example^\n||two.example^\n"
    code = base64.b64encode(text.encode()).decode()
    bare = code.rstrip("=")
    wrapped = "\n".join(code[i : i + 20] for i in range(0, len(code), 20))
    assert apply(spark, [code, bare, wrapped, "no base64!", text], lambda c: T.decode(c, "base64")) == [text, text, text, None, None]
    short, one_line = base64.b64encode(b"a\nb").decode(), base64.b64encode(b"a long text without a line end").decode()
    given = [code, bare, wrapped, short, one_line, text, code[:20] + "\n\n" + code[20:]]
    assert apply(spark, given, T.decode) == [text, text, text, short, one_line, text, given[-1]]
    assert apply(spark, [code], lambda c: T.decode(c, "plain")) == [code]
    with pytest.raises(ValueError):
        T.decode(F.col("v"), "rot13")


def test_content_hash(spark):
    import hashlib

    rows = spark.createDataFrame([(2, "b"), (1, "a")], "rank long, line string")
    assert T.content_hash(rows).first().hash == hashlib.sha256(b"a\nb\n").hexdigest()
    assert T.content_hash(rows.where("false")).first().hash == hashlib.sha256(b"").hexdigest()


def _expected(s):
    """What an entry's block is, by the standard library."""
    address, slash, bits = s.strip().partition("/")
    if slash and (not bits.isdigit() or not bits.isascii() or bits != str(int(bits))) or "%" in s:
        return None
    try:
        a = ipaddress.ip_address(address)
        n = int(bits) if slash else a.max_prefixlen
        if a.version == 6 and a.ipv4_mapped:
            if n < 96:
                return None
            a, n = a.ipv4_mapped, n - 96
        return str(ipaddress.ip_network((a, n), strict=False))
    except ValueError:
        return None


def test_blocks(spark):
    given = [
        "10.1.2.3", "10.1.2.3/8", "10.1.2.3/0", "10.1.2.3/31", "0.0.0.0/0", "255.255.255.255", "1.2.3", "1.2.3.4.5", "256.1.1.1", "01.2.3.4", "1.2.3.4/33", "1.2.3.4/08", "1.2.3.4/", "1.2.3.4/255.0.0.0", "", " 1.2.3.4 ", "a.example",
        "::", "::1", "::/0", "2001:db8::", "2001:DB8::a:0:0:1/64", "2001:db8::/129", "1::2::3", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:0:0:2:0:0:0:3", "1:0:2:3:4:5:6:7", "fe80::1%eth0", "fe80::1%eth0/64", "::ffff:1.2.3.4", "::ffff:1.2.3.4/120", "::ffff:1.2.3.4/95", "::1.2.3.4", "64:ff9b::1.2.3.4/100", "12345::", "g::", "1:2:3:4:5:6:7:8::",
    ]
    rng = random.Random(5)
    given += [f"{ipaddress.IPv4Address(rng.getrandbits(32))}/{rng.randint(0, 32)}" for _ in range(40)]
    given += [f"{ipaddress.IPv6Address(rng.getrandbits(128) & rng.getrandbits(128) & rng.getrandbits(128))}/{rng.randint(0, 128)}" for _ in range(40)]
    got = apply(spark, given, lambda c: P.cidr(P.parse(c)))
    assert got == [_expected(s) for s in given]
    assert apply(spark, ["10.1.2.3", "10.0.0.0/8", "::1", "2001:db8::/32"], lambda c: P.text(P.parse(c))) == ["10.1.2.3", "10.0.0.0/8", "::1", "2001:db8::/32"]
    outer = apply(spark, [g for g, e in zip(given, got, strict=True) if e], lambda c: F.concat_ws("-", P.parse(c)["first"], P.parse(c)["last"]))
    for e, o in zip([e for e in got if e], outer, strict=True):
        n = ipaddress.ip_network(e)
        w = n.max_prefixlen // 4
        assert o == f"{int(n[0]):0{w}x}-{int(n[-1]):0{w}x}"


def test_addresses_and_lengths(spark):
    assert apply(spark, ["1.2.3.4", "::1", "fe80::1%lo0", "1.2.3.4/8", "x"], P.is_address) == [True, True, True, False, False]
    assert apply(spark, ["1.2.3.4/8", "::/0", "fe80::%1/64", "1.2.3.4"], P.is_block) == [True, True, False, False]


def test_cover(spark):
    rng = random.Random(3)
    spans = [(a, rng.randint(a + 1, 256)) for a in [rng.randrange(256) for _ in range(60)]] + [(0, 256), (0, 255), (1, 256)]
    for fam, width in ((4, 8), (6, 32)):
        top = 16**width
        base = top - 256
        rows = spark.createDataFrame([(i, f"{base + a:0{width}x}", "g" if base + b == top else f"{base + b:0{width}x}") for i, (a, b) in enumerate(spans)], "i int, a string, e string")
        for r in rows.select("i", P.cover(F.lit(fam), F.col("a"), F.col("e")).alias("c")).collect():
            a, b = spans[r.i]
            kind = ipaddress.IPv4Address if fam == 4 else ipaddress.IPv6Address
            want = list(ipaddress.summarize_address_range(kind(base + a), kind(base + b - 1)))
            assert sorted((int(x.first, 16), x.bits) for x in r.c) == sorted((int(n[0]), n.prefixlen) for n in want)


def test_rules(spark):
    shown = lambda c: F.when(R.parse(c).isNotNull(), F.concat_ws("|", F.coalesce(R.parse(c)["type"], F.lit("-")), R.parse(c)["value"], F.array_join(R.parse(c)["options"], "+")))
    cases = {
        "DOMAIN,a.example": "DOMAIN|a.example|", "domain-suffix, a.example , x, y": "DOMAIN-SUFFIX|a.example|x+y", "'DOMAIN-KEYWORD,ads'": "DOMAIN-KEYWORD|ads|", "MATCH": "MATCH||", "MATCH,": "MATCH||", "DOMAIN": None,
        "DOMAIN,single": None, "DOMAIN-SUFFIX,single": "DOMAIN-SUFFIX|single|", "DOMAIN,": None, "NOPE,a": None, "IP-CIDR,10.0.0.0/8,no-resolve": "IP-CIDR|10.0.0.0/8|no-resolve", "IP-CIDR,10.0.0.0/40": None, "SRC-IP-CIDR,::/0": "SRC-IP-CIDR|::/0|",
        "10.0.0.1": "-|10.0.0.1|", "+.a.example": "-|+.a.example|", "localhost": "-|localhost|", "": None, "''": None, "a b": None, "AND,((DOMAIN,a),(X,b))": "AND|((DOMAIN|a)+(X+b))", "GEOIP,XX": "GEOIP|XX|", "uid": None, "shop": "-|shop|",
    }
    check(spark, cases, shown)


def test_canonical(spark):
    cases = {
        "DOMAIN,A.Example.": "DOMAIN,a.example", "domain-suffix,Com": "DOMAIN-SUFFIX,com", "IP-CIDR6,2001:DB8::1/32,no-resolve": "IP-CIDR,2001:db8::/32,no-resolve", "IP-CIDR,10.9.9.9/8": "IP-CIDR,10.0.0.0/8", "SRC-IP-CIDR,10.9.9.9": "SRC-IP-CIDR,10.9.9.9/32",
        "10.0.0.1": "IP-CIDR,10.0.0.1/32", "+.A.example": "DOMAIN-SUFFIX,a.example", ".lan": "DOMAIN-SUFFIX,lan", "*.a.example": "DOMAIN-WILDCARD,*.a.example", "a.example": "DOMAIN,a.example", "localhost": None, "DOMAIN-KEYWORD,Ads": "DOMAIN-KEYWORD,Ads", "match": "MATCH",
    }
    check(spark, cases, lambda c: R.text(R.canonical(R.parse(c))))


def test_yaml_quoting(spark):
    check(spark, {"DOMAIN,a": "DOMAIN,a", "+.a.example": "'+.a.example'", "'x'": "'x'", "it's": "'it''s'", "10.0.0.0/8": "'10.0.0.0/8'", "ip-cidr6,::/0": "'ip-cidr6,::/0'", " MATCH ": "MATCH", "'": "''''"}, R.quote_yaml)


def test_entries(spark):
    rows = spark.createDataFrame([("domain", "A.example"), ("domain", "lan"), ("ip", "10.1.1.1/8"), ("domain", "10.1.1.1"), ("rule", "DOMAIN,b.example"), ("rule", "DOMAIN-SUFFIX,lan"), ("rule", "IP-CIDR,10.1.1.1/8"), ("rule", "GEOIP,XX"), ("ip", "x")], "k string, v string")
    k, v = F.col("k"), F.col("v")
    got = rows.select(R.host_of_item(k, v).alias("h"), R.host_of_item(k, v, True).alias("t"), P.text(R.block_of_item(k, v)).alias("b"), R.text(R.of_item(k, v)).alias("r"), R.pattern_of_item(k, v).alias("p")).collect()
    assert [tuple(r) for r in got] == [
        ("a.example", "a.example", None, "DOMAIN-SUFFIX,a.example", "a.example"),
        (None, "lan", None, None, "lan"),
        (None, None, "10.0.0.0/8", "IP-CIDR,10.0.0.0/8,no-resolve", "10.0.0.0/8"),
        (None, None, None, None, None),
        ("b.example", "b.example", None, "DOMAIN,b.example", "b.example"),
        (None, "lan", None, "DOMAIN-SUFFIX,lan", "lan"),
        (None, None, "10.0.0.0/8", "IP-CIDR,10.0.0.0/8", "10.0.0.0/8"),
        (None, None, None, "GEOIP,XX", None),
        (None, None, None, None, None),
    ]


def test_patterns_of_hosts_and_blocks(spark):
    check(spark, {"+.a": True, "+": False, "a.+": False, "*": True, "a.*": True, "a*": False, ".a": True, "": False, "a.": False, "a..b": False, ".": False}, R.valid_pattern)
    check(spark, {"DOMAIN,a.example": "a.example", "DOMAIN-SUFFIX,a.example": "+.a.example", "+.A.example": "+.a.example", "DOMAIN-WILDCARD,*.A.example": "*.a.example", "DOMAIN-KEYWORD,a": None, "DOMAIN-WILDCARD,a*.example": None}, R.host_pattern)
    check(spark, {"IP-CIDR,10.1.0.0/8,no-resolve": "10.0.0.0/8", "10.0.0.1": "10.0.0.1/32", "DOMAIN,a.example": None, "SRC-IP-CIDR,10.0.0.0/8": None}, R.block_text)
