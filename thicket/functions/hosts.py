"""Column functions on host names."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from .text import is_ascii, let, shared, trim

LABEL, TOP = r"[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?", r"[a-z](?:[a-z0-9-]{0,61}[a-z0-9])?"


def validate(host: Column, allow_tld: Column | bool = False) -> Column:
    """Whether a lower-case ASCII host is well formed: at most 253 characters, labels of 1 to 63 of [a-z0-9-] without outer hyphens,
    the last one beginning with a letter; a single label only if `allow_tld`."""
    several = host.rlike(rf"\A(?:{LABEL}\.)+{TOP}\z")
    single = host.rlike(rf"\A{TOP}\z")
    allowed = allow_tld if isinstance(allow_tld, Column) else F.lit(allow_tld)
    return (F.octet_length(host) <= 253) & (several | (allowed & single))


def bare(raw: Column) -> Column:
    """The host part of an entry: white space and quotes off, lower case, scheme, path, port and wildcard prefixes cut, one final dot off."""
    s = F.lower(F.regexp_replace(trim(raw), r"\A['\"]+|['\"]+\z", ""))
    s = F.regexp_replace(s, r"(?s)\A.*?://", "")
    s = F.regexp_replace(s, r"(?s)[/?].*\z", "")
    s = F.regexp_replace(s, r"(?s):.*\z", "")
    s = F.regexp_replace(s, r"\A(?:[*+]?\.)+", "")
    return F.regexp_replace(s, r"\.\z", "")


@shared
def _strict(raw: Column) -> Column:
    return let(bare(raw), lambda host: F.when(validate(host), host))


@shared
def _loose(raw: Column) -> Column:
    return let(bare(raw), lambda host: F.when(validate(host, True), host))


def normalize(raw: Column, allow_tld: Column | bool = False) -> Column:
    """The canonical host of an entry, null where it has none. Non-ASCII hosts are null here; `to_ascii` goes first where they may occur."""
    if isinstance(allow_tld, bool):
        return _loose(raw) if allow_tld else _strict(raw)
    return F.when(allow_tld, _loose(raw)).otherwise(_strict(raw))


def reverse_labels(host: Column) -> Column:
    """a.b.com as com.b.a: the key that groups a domain's hosts."""
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def ancestors(host: Column, least_labels: int = 1, own: bool = False) -> Column:
    """The host's suffixes at label boundaries of at least `least_labels` labels: proper ones, or with the host itself."""
    n = F.size(F.split(host, r"\."))
    last = n if own else n - 1
    steps = F.when(last >= least_labels, F.sequence(F.lit(least_labels), F.greatest(last, F.lit(least_labels)))).otherwise(F.array().cast("array<int>"))
    return F.transform(steps, lambda i: F.array_join(F.slice(F.split(host, r"\."), F.lit(0) - i, i), "."))


def _ascii_host(raw: str) -> str:
    """An entry's host in ASCII ('' if it has none), for entries with other characters."""
    import idna

    s = raw.strip().strip("'\"")
    s = "".join(c.lower() if len(c.lower()) == 1 else "i" if c == "İ" else c for c in s)
    s = s.split("://", 1)[-1]
    for end in "/?:":
        s = s.split(end, 1)[0]
    lead = ""
    while s[:2] in ("*.", "+.") or s[:1] == ".":
        cut = 1 if s[0] == "." else 2
        lead, s = lead + s[:cut], s[cut:]
    s = s.removesuffix(".")
    try:
        return lead + idna.encode(s, uts46=True, std3_rules=True).decode()
    except (idna.IDNAError, UnicodeError):
        pass
    try:  # symbols that UTS 46 allows and IDNA 2008 does not
        parts = []
        for label in idna.uts46_remap(s, std3_rules=True).split("."):
            parts.append(label if label.isascii() else "xn--" + label.encode("punycode").decode())
        return lead + ".".join(parts)
    except (idna.IDNAError, UnicodeError):
        return ""


_TYPED = ("DOMAIN", "DOMAIN-SUFFIX")


def _ascii_entry(value: str) -> str:
    kind, comma, rest = value.partition(",")
    if comma:
        if kind.strip().strip("'\"").upper() not in _TYPED:
            return value
        host, comma, options = rest.partition(",")
        return f"{kind},{_ascii_host(host)}{comma}{options}"
    return _ascii_host(value)


@pandas_udf(StringType())
def _to_ascii(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(_ascii_entry, na_action="ignore")


def to_ascii(value: Column) -> Column:
    """Entries and rules with non-ASCII hosts in punycode; ASCII ones as they are, and only the others are sent to Python."""
    return F.when(is_ascii(value), value).otherwise(_to_ascii(F.when(~is_ascii(value), value)))
