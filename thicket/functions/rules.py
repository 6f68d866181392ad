"""Column functions on proxy rules: TYPE,value,options lines and the scalar items of single-purpose lists.

A rule is a struct (type, value, options ARRAY, scalar BOOLEAN, raw); null where an entry is none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import hosts, prefixes
from .text import let, shared, trim

#: The rule types, those whose value is a host or a block, and the order of groups (others come last, together).
KNOWN_TYPES = (
    "DOMAIN", "DOMAIN-SUFFIX", "DOMAIN-KEYWORD", "DOMAIN-REGEX", "DOMAIN-WILDCARD", "GEOSITE",
    "IP-CIDR", "IP-CIDR6", "IP-SUFFIX", "IP-ASN", "GEOIP", "SRC-GEOIP", "SRC-IP-ASN", "SRC-IP-CIDR", "SRC-IP-SUFFIX",
    "DST-PORT", "SRC-PORT", "IN-PORT", "IN-TYPE", "IN-USER", "IN-NAME",
    "PROCESS-PATH", "PROCESS-PATH-REGEX", "PROCESS-NAME", "PROCESS-NAME-REGEX",
    "UID", "NETWORK", "DSCP", "RULE-SET", "AND", "OR", "NOT", "SUB-RULE", "MATCH",
)
HOST_TYPES = ("DOMAIN", "DOMAIN-SUFFIX")
BLOCK_TYPES = ("IP-CIDR", "IP-CIDR6", "SRC-IP-CIDR")
TYPE_RANK = {
    "DOMAIN-KEYWORD": 0, "DOMAIN": 1, "DOMAIN-SUFFIX": 2, "DOMAIN-WILDCARD": 3, "DOMAIN-REGEX": 4, "GEOSITE": 5,
    "IP-CIDR": 6, "IP-CIDR6": 7, "IP-SUFFIX": 8, "IP-ASN": 9, "GEOIP": 10,
}
OTHER_RANK = 111
_TYPED = r"\A[A-Z][A-Z0-9-]*(,|\z)"
_NO_OPTIONS = "array<string>"


def _none(kind: str) -> Column:
    return F.lit(None).cast(kind)


def unquote(s: Column) -> Column:
    """Without one pair of equal outer quotes."""
    return F.regexp_replace(s, r"(?s)\A(['\"])(.*)\1\z", "$2")


def _rule(kind: Column, value: Column, options: Column, scalar: bool, raw: Column) -> Column:
    return F.struct(kind.alias("type"), value.alias("value"), options.alias("options"), F.lit(scalar).alias("scalar"), raw.alias("raw"))


@shared
def parse(item: Column) -> Column:
    """The rule of an entry. Typed: it begins like a type name and holds a comma or is a type's name; the type must be known, its value there (but
    for MATCH) and, for hosts and blocks, well formed. Else a scalar: an address, a block or a host."""

    def typed(s: Column) -> Column:
        parts = F.split(s, ",", -1)
        options = F.when(F.size(parts) > 2, F.transform(F.slice(parts, 3, F.greatest(F.size(parts), F.lit(1))), trim)).otherwise(F.array().cast(_NO_OPTIONS))
        made = _rule(F.upper(trim(parts[0])), trim(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))), options, False, s)
        return let(made, lambda r: F.when(good(r["type"], r["value"]), r))

    def good(kind: Column, value: Column) -> Column:
        ok = kind.isin(*KNOWN_TYPES) & ((value != "") | (kind == "MATCH"))
        ok &= ~kind.isin(*HOST_TYPES) | hosts.normalize(value, kind == "DOMAIN-SUFFIX").isNotNull()
        return ok & (~kind.isin(*BLOCK_TYPES) | prefixes.parse(value).isNotNull())

    def of(s: Column) -> Column:
        like = F.upper(s).rlike(_TYPED) & (s.contains(",") | F.upper(s).isin(*KNOWN_TYPES))
        lone = prefixes.parse(s).isNotNull() | hosts.normalize(s, True).isNotNull()
        return F.when(s == "", None).when(like, typed(s)).when(lone, _rule(_none("string"), s, F.array().cast(_NO_OPTIONS), True, s))

    return let(unquote(trim(item)), of)


def is_host(rule: Column) -> Column:
    return F.coalesce(rule["type"].isin(*HOST_TYPES), F.lit(False))


def is_block(rule: Column) -> Column:
    return F.coalesce(rule["type"].isin("IP-CIDR", "IP-CIDR6"), F.lit(False))


@shared
def text(rule: Column) -> Column:
    """A scalar's value; else type, value (where there is one) and options, comma-joined."""

    def of(r: Column) -> Column:
        return F.when(r["scalar"], r["value"]).otherwise(F.concat_ws(",", r["type"], F.nullif(r["value"], F.lit("")), r["options"]))

    return F.when(rule.isNotNull(), let(rule, of))


def key(rule: Column) -> Column:
    """What makes two rules the same: type and value."""
    return F.concat(rule["type"], F.lit(","), rule["value"])


@shared
def canonical(rule: Column) -> Column:
    """Scalars typed, hosts and blocks in normal form, IP-CIDR6 as IP-CIDR. Null where a scalar host has a single label."""

    def made(kind: str | Column, value: Column, options: Column) -> Column:
        kind = F.lit(kind) if isinstance(kind, str) else kind
        head = F.concat_ws(",", kind, F.nullif(value, F.lit("")), options)
        return F.when(value.isNotNull(), _rule(kind, value, options, False, head))

    def lone(v: Column) -> Column:
        none = F.array().cast(_NO_OPTIONS)
        block = prefixes.cidr(prefixes.parse(v))
        return (
            F.when(prefixes.parse(v).isNotNull(), let(block, lambda b: made("IP-CIDR", b, none)))
            .when(v.rlike(r"\A\+?\."), let(hosts.normalize(v, True), lambda h: made("DOMAIN-SUFFIX", h, none)))
            .when(v.startswith("*."), let(F.concat(F.lit("*."), hosts.normalize(v)), lambda h: made("DOMAIN-WILDCARD", h, none)))
            .otherwise(let(hosts.normalize(v), lambda h: made("DOMAIN", h, none)))
        )

    def typed(r: Column) -> Column:
        v = r["value"]
        kind = F.when(r["type"] == "IP-CIDR6", "IP-CIDR").otherwise(r["type"])
        held = F.when(r["type"].isin(*HOST_TYPES), hosts.normalize(v, r["type"] == "DOMAIN-SUFFIX")).when(r["type"].isin(*BLOCK_TYPES), prefixes.cidr(prefixes.parse(v))).otherwise(v)
        return let(held, lambda h: made(kind, h, r["options"]))

    return let(rule, lambda r: F.when(r["scalar"], lone(r["value"])).otherwise(typed(r)))


@shared
def rank(kind: Column) -> Column:
    out = F.lit(OTHER_RANK)
    for name, n in TYPE_RANK.items():
        out = F.when(kind == name, n).otherwise(out)
    return out


@shared
def quote_yaml(item: Column) -> Column:
    """A list element in YAML: typed rules (upper case alone) and single-quoted text as they are, the rest single-quoted."""
    s = trim(item)
    quoted = (F.octet_length(s) >= 2) & s.startswith("'") & s.endswith("'")
    return F.when(s.rlike(_TYPED) | quoted, s).otherwise(F.concat(F.lit("'"), F.replace(s, F.lit("'"), F.lit("''")), F.lit("'")))


# -- entries of any kind ---------------------------------------------------------------------------------------------------------


@shared
def _canonical_of(value: Column) -> Column:
    return canonical(parse(value))


def of_item(kind: Column, value: Column, allow_tld: Column | bool = False) -> Column:
    """The canonical rule of an entry: hosts as DOMAIN-SUFFIX, blocks as IP-CIDR with no-resolve, rules as they are."""
    none, direct = F.array().cast(_NO_OPTIONS), F.array(F.lit("no-resolve"))
    from_host = let(hosts.normalize(value, allow_tld), lambda h: F.when(h.isNotNull(), _rule(F.lit("DOMAIN-SUFFIX"), h, none, False, F.concat(F.lit("DOMAIN-SUFFIX,"), h))))
    from_block = let(prefixes.cidr(prefixes.parse(value)), lambda b: F.when(b.isNotNull(), _rule(F.lit("IP-CIDR"), b, direct, False, F.concat(F.lit("IP-CIDR,"), b, F.lit(",no-resolve")))))
    return F.when(kind == "domain", from_host).when(kind == "ip", from_block).when(kind == "rule", _canonical_of(value))


def host_of_item(kind: Column, value: Column, allow_tld: Column | bool = False) -> Column:
    """The host of a host entry, or of a DOMAIN or DOMAIN-SUFFIX rule; blocks have none."""
    allowed = allow_tld if isinstance(allow_tld, Column) else F.lit(allow_tld)
    from_rule = let(_canonical_of(value), lambda r: F.when(is_host(r) & (allowed | r["value"].contains(".")), r["value"]))
    return F.when(kind == "domain", hosts.normalize(value, allow_tld)).when(kind == "rule", from_rule)


def block_of_item(kind: Column, value: Column) -> Column:
    """The block of a block entry or of an IP-CIDR rule; hosts have none, even if they look like addresses."""
    from_rule = let(_canonical_of(value), lambda r: F.when(is_block(r), r["value"]))
    return prefixes.parse(F.when(kind == "ip", value).when(kind == "rule", from_rule))


def pattern_of_item(kind: Column, value: Column) -> Column:
    """The exclude pattern of an entry, null where it gives none."""
    from_rule = let(_canonical_of(value), lambda r: F.when(is_host(r) | is_block(r), r["value"]))
    return F.when(kind == "domain", hosts.normalize(value, True)).when(kind == "ip", prefixes.cidr(prefixes.parse(value))).when(kind == "rule", from_rule)


# -- rules as entries of single-purpose lists ------------------------------------------------------------------------------------


@shared
def valid_pattern(p: Column) -> Column:
    """Whether a host pattern is well formed: '*' and '+' are whole labels, '+' only the first of several; only the first label may be empty."""

    def of(labels: Column) -> Column:
        first_of_many = lambda i: (i == 0) & (F.size(labels) > 1)
        fine = F.transform(labels, lambda x, i: F.when(x.isin("", "+"), first_of_many(i)).otherwise((x == "*") | ~x.rlike(r"[*+]")))
        return F.forall(fine, lambda x: x)

    return (p != "") & ~p.endswith(".") & let(F.split(p, r"\.", -1), of)


@shared
def host_pattern(line: Column) -> Column:
    """A rule's line as a host pattern, null where it cannot be one."""

    def of(r: Column) -> Column:
        whole = r["scalar"] | (r["type"] == "DOMAIN-WILDCARD")
        return F.when(whole, F.lower(r["value"])).when(r["type"] == "DOMAIN", r["value"]).when(r["type"] == "DOMAIN-SUFFIX", F.concat(F.lit("+."), r["value"]))

    return let(let(parse(line), of), lambda p: F.when(valid_pattern(p), p))


@shared
def block_text(line: Column) -> Column:
    """A rule's line as address and length, null where it is no block."""
    return prefixes.cidr(prefixes.parse(let(parse(line), lambda r: F.when(r["scalar"] | is_block(r), r["value"]))))
