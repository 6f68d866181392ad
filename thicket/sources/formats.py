"""The entry formats: extraction of entries from lines, format detection, and the registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

from ..functions import text as T
from ..functions.prefixes import is_address, is_block

_NONE = "array<string>"


def _no() -> Column:
    return F.array().cast(_NONE)


def _if(test: Column, found: Column) -> Column:
    return F.when(F.coalesce(test, F.lit(False)), found).otherwise(_no())


def _tail(fields: Column) -> Column:
    """All fields but the first, without local names."""
    return F.filter(F.slice(fields, 2, F.greatest(F.size(fields), F.lit(1))), lambda h: ~T.is_local_name(h))


@T.shared
def domain(line: Column) -> Column:
    s = T.strip_comment(line)
    return _if(s != "", F.array(T.first_field(s)))


@T.shared
def hosts(line: Column) -> Column:
    """Address, then hosts."""
    f = T.fields(T.strip_comment(line))
    return _if((F.size(f) >= 2) & is_address(F.get(f, F.lit(0))), _tail(f))


@T.shared
def v2ray(line: Column) -> Column:
    """full:, domain: or bare hosts, attributes after."""
    s = T.first_field(T.strip_comment(line))
    return _if((s != "") & ~s.rlike(r"\A(regexp|keyword|include):"), F.array(F.regexp_replace(s, r"\A(full|domain):", "")))


@T.shared
def dnsmasq(line: Column) -> Column:
    """directive=/host/host/target."""
    s = T.strip_comment(line)
    parts = F.split(F.regexp_extract(s, r"(?s)\A.*?=(/.*)\z", 1), "/", -1)
    inner = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0))), lambda d: F.regexp_replace(d, r"\A\.+", ""))
    return _if(s.contains("=/") & (F.size(parts) >= 3), F.filter(inner, lambda d: d != ""))


#: Directives whose second field names hosts.
SMARTDNS = ("address", "nameserver", "domain-rules", "ipset", "nftset", "cname", "https-record", "srv-record", "ddns")


@T.shared
def smartdns(line: Column) -> Column:
    """directive /host/..., or a host alone."""
    f = T.fields(T.strip_comment(line))
    one, two = F.get(f, F.lit(0)), F.get(f, F.lit(1))
    host = F.regexp_extract(two, r"\A/([^/]*)", 1)
    alone = (F.size(f) == 1) & ~one.rlike("[/:]")
    return F.when(F.coalesce(alone, F.lit(False)), F.array(one)).otherwise(_if((F.size(f) >= 2) & one.isin(*SMARTDNS) & (host != ""), F.array(host)))


#: Modifiers of rules that do not simply block a host.
SKIPPED_MODIFIERS = ("dnsrewrite", "denyallow", "badfilter", "ctag", "client")


@T.shared
def adblock(line: Column) -> Column:
    """||host^ with modifiers, lines of hosts files, or hosts alone."""
    out = line.rlike(r"\A(?:[!#\[/]|@@)") | line.rlike(r"##|#@#|#\?#|#\$#|\$\$|://")
    rule = F.substr(line, F.lit(3))
    mods = F.transform(F.split(F.regexp_extract(rule, r"(?s)\A[^$]*\$(.*)\z", 1), ",", -1), lambda m: F.substring_index(m, "=", 1))
    host = F.regexp_replace(F.substring_index(rule, "$", 1), r"\^\z", "")
    blocks = ~F.exists(mods, lambda m: m.isin(*SKIPPED_MODIFIERS)) & (host != "") & ~host.rlike(r"[/^|*]")
    f = T.fields(T.strip_comment(line))
    one = F.get(f, F.lit(0))
    return (
        F.when(out | (line == ""), _no())
        .when(line.startswith("||"), _if(blocks, F.array(host)))
        .when(line.startswith("|") | (F.size(f) == 0), _no())
        .when(F.size(f) >= 2, _if(is_address(one), _tail(f)))
        .otherwise(_if(~one.rlike(r"[\^|$*]"), F.array(one)))
    )


@T.shared
def autoproxy(line: Column) -> Column:
    """||host, |scheme://host/, .host or bare hosts."""
    s = F.when(line.startswith("||"), F.substr(line, F.lit(3))).when(line.startswith("|"), F.regexp_extract(line, r"(?s)\A\|.*?://(.*)\z", 1)).otherwise(line)
    s = F.regexp_replace(F.regexp_replace(s, r"/\z", ""), r"\A\.+", "")
    return _if(~line.rlike(r"\A(?:[!\[/]|@@)") & (s != "") & ~s.rlike(r"[/*%:^|@ ]"), F.array(s))


def _payload(body: str) -> list[str] | None:
    import yaml

    try:
        found = yaml.load(body, yaml.BaseLoader)  # strings stay as written
    except yaml.YAMLError:
        return None
    items = found.get("payload") if isinstance(found, dict) else None
    return [x.strip() for x in items if x.strip()] if isinstance(items, list) and all(isinstance(x, str) for x in items) else None


@pandas_udf(ArrayType(StringType()))
def yaml_payload(bodies: pd.Series) -> pd.Series:
    """The `payload` list of a YAML body; null where there is none."""
    return bodies.map(_payload, na_action="ignore")


@dataclass(frozen=True)
class Format:
    """kind: of its entries. line: from a trimmed line to entries; body: from a whole body to entries, null where it is malformed."""

    name: str
    kind: str
    line: Callable[[Column], Column] | None = None
    body: Callable[[Column], Column] | None = None


_registry: dict[str, Format] = {}


def register(found: Format) -> None:
    """Add a format; one of the same name is replaced."""
    _registry[found.name] = found


def lookup(name: str) -> Format | None:
    return _registry.get(name)


def names() -> list[str]:
    return sorted(_registry)


for _f in (domain, hosts, v2ray, dnsmasq, smartdns, adblock, autoproxy):
    register(Format(_f.__name__, "domain", line=_f))
register(Format("iplist", "ip", line=domain))
register(Format("clash", "rule", body=yaml_payload))


# -- detection -------------------------------------------------------------------------------------------------------------------

#: Non-comment lines looked at; formats by priority where counts tie.
SAMPLE = 64
PRIORITY = ("clash", "adblock", "autoproxy", "dnsmasq", "smartdns", "hosts", "v2ray", "iplist")


@T.shared
def classify(line: Column) -> Column:
    """The format whose syntax a line shows, '' for none."""
    f = T.fields(T.strip_comment(line))
    one = F.get(f, F.lit(0))
    return (
        F.when(line.rlike(r"\A(?:\|\||\|http|@@)"), F.when(line.rlike(r"[\^$]"), "adblock").otherwise("autoproxy"))
        .when(line.rlike(r"\A(?:server|ipset|address|nftset)=/"), "dnsmasq")
        .when(line.rlike(r"\A(?:address|nameserver|domain-rules|ipset|nftset) /"), "smartdns")
        .when(line.rlike(r"\A(?:full|regexp|domain|keyword|include):"), "v2ray")
        .when(line.rlike(r"\A-[ \t]"), "clash")
        .when(line.startswith("."), "autoproxy")
        .when(F.size(f) == 0, "")
        .when(is_address(one), F.when(F.size(f) >= 2, "hosts").otherwise("iplist"))
        .when(is_block(one), "iplist")
        .otherwise("domain")
    )


def detect(lines: DataFrame, by: str = "src_idx") -> DataFrame:
    """lines (by, pos, line) -> (by, format): a marker line decides at once if no more than SAMPLE - 1 lines that are no comments precede it; else the
    syntax of most of the first SAMPLE such lines, ties by PRIORITY; 'domain' where no other syntax shows.

    Only a source's first lines matter: they are ranked per source, which Spark cuts to a limit per group before the shuffle.
    """
    marker = F.when(F.col("line").startswith("payload:"), "clash").when(F.col("line").startswith("[Adblock"), "adblock").when(F.col("line").startswith("[AutoProxy"), "autoproxy")
    rows = lines.select(by, "pos", "line", marker.alias("marker")).where(F.col("marker").isNotNull() | ~F.col("line").rlike(r"\A(?:[#!;]|//)"))
    order = Window.partitionBy(by).orderBy("pos")
    # Of the markers the first counts; with at most SAMPLE lines before it, it is among the first SAMPLE rows.
    first = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE)
    told = first.withColumn("name", classify(F.col("line")))
    counted = told.groupBy(by).agg(F.min_by("marker", F.when(F.col("marker").isNotNull(), F.col("pos"))).alias("marker"), *[F.count_if(F.col("name") == p).alias(p) for p in PRIORITY])
    best = F.array_max(F.array(*[F.struct(F.col(p).alias("n"), F.lit(-i).alias("i"), F.lit(p).alias("name")) for i, p in enumerate(PRIORITY)]))
    return counted.select(by, F.coalesce("marker", F.when(best["n"] > 0, best["name"]), F.lit("domain")).alias("format"))


# -- entries ---------------------------------------------------------------------------------------------------------------------


def items(bodies: DataFrame, formats: dict[int, str] | str | None = None) -> DataFrame:
    """bodies (src_idx, body) -> entries (src_idx, pos, kind, value) in each source's format: one name for all, names by src_idx, or 'auto'.

    pos BIGINT orders the entries of a source. A malformed body gives one row of kind 'error', its message as value. Null bodies give no rows.
    Every line is split once and meets only its own format's expression; bodies go to Python for YAML alone.
    """
    lines = T.lines(bodies.select("src_idx", "body"))
    named = F.lit(formats) if isinstance(formats, str) else F.create_map(*[F.lit(x) for kv in (formats or {-1: "auto"}).items() for x in kv])[F.col("src_idx")]
    named = F.coalesce(named, F.lit("auto"))
    wanted = set(names()) | {"auto"} if formats is None else {formats} if isinstance(formats, str) else set(formats.values())
    if "auto" in wanted:
        found = detect(lines.where(named == "auto"))
        given = bodies.select("src_idx").where(named != "auto").distinct().withColumn("format", named)
        chosen = found.unionByName(given)
        empty = bodies.select("src_idx").distinct().join(chosen, "src_idx", "left_anti").withColumn("format", F.lit("domain"))
        chosen = chosen.unionByName(empty)  # one row a source
        lines = lines.join(chosen, "src_idx")
        bodies = bodies.join(chosen, "src_idx")
        wanted = set(names())
    else:
        lines, bodies = lines.withColumn("format", named), bodies.withColumn("format", named)
    by_line = [f for f in _registry.values() if f.line and f.name in wanted]
    by_body = [f for f in _registry.values() if f.body and f.name in wanted]
    out = None
    if by_line:
        kind, found = F.lit(None).cast("string"), _no()
        for f in by_line:
            kind = F.when(F.col("format") == f.name, f.kind).otherwise(kind)
            found = F.when(F.col("format") == f.name, f.line(F.col("line"))).otherwise(found)
        rows = lines.where(F.col("format").isin([f.name for f in by_line])).select("src_idx", "pos", kind.alias("kind"), F.posexplode(found).alias("k", "value"))
        out = rows.where("value <> ''").select("src_idx", (F.shiftleft("pos", 31) + F.col("k")).alias("pos"), "kind", "value")
    for f in by_body:
        found = bodies.where((F.col("format") == f.name) & F.col("body").isNotNull()).select("src_idx", f.body(F.col("body")).alias("found"))
        whole = found.select("src_idx", F.posexplode_outer(F.coalesce("found", F.array(F.lit("malformed body")))).alias("pos", "value"), F.when(F.col("found").isNull(), "error").otherwise(f.kind).alias("kind"))
        whole = whole.where("value is not null").select("src_idx", F.col("pos").cast("bigint").alias("pos"), "kind", "value")
        out = whole if out is None else out.unionByName(whole)
    return out
