"""Column functions on addresses and blocks of both families, in built-in expressions alone.

A block is held as fam INT (4 or 6), bits INT, and first and last STRING: its outer addresses in 8 or 32 lower-case hex digits, which
compare like the addresses.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, shared, trim

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
V4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_H = "[0-9a-fA-F]{1,4}"


def _v6() -> str:
    """Eight groups, or fewer around one '::'; an IPv4 address may stand for the last two."""
    forms = [rf"(?:{_H}:){{7}}{_H}", rf"(?:{_H}:){{6}}{V4}"]
    for left in range(8):
        head = rf"{_H}(?::{_H}){{{left - 1}}}" if left else ""
        right = []
        if left <= 5:
            right.append(rf"(?:{_H}:){{0,{5 - left}}}{V4}")
        if left <= 6:
            right.append(rf"(?:{_H}(?::{_H}){{0,{6 - left}}})?")
        forms.append(rf"{head}::(?:{'|'.join(right)})" if right else rf"{head}::")
    return "(?:" + "|".join(forms) + ")"


V6 = _v6()
_BITS4, _BITS6 = "(?:3[0-2]|[12]?[0-9])", "(?:12[0-8]|1[01][0-9]|[1-9]?[0-9])"
FIELDS = ("fam", "bits", "first", "last")


def is_address(s: Column) -> Column:
    """An address of either family; a zone may follow an IPv6 one."""
    return s.rlike(rf"\A(?:{V4}|{V6}(?:%.+)?)\z")


def is_block(s: Column) -> Column:
    """Address and length, without a zone."""
    return s.rlike(rf"\A(?:{V4}/{_BITS4}|{V6}/{_BITS6})\z")


def _hex(n: Column, digits: int) -> Column:
    return F.lower(F.lpad(F.hex(n), digits, "0"))


def _hex4(s: Column) -> Column:
    parts = F.split(s, r"\.")
    return F.concat(*[_hex(F.try_element_at(parts, F.lit(i)).try_cast("bigint"), 2) for i in range(1, 5)])


def _hex6(s: Column) -> Column:
    """32 hex digits of a well-formed IPv6 address."""
    tail = _hex4(F.regexp_extract(s, rf"({V4})\z", 1))
    s = F.lower(F.when(s.contains("."), F.concat(F.regexp_replace(s, rf"{V4}\z", ""), F.substring(tail, 1, 4), F.lit(":"), F.substring(tail, 5, 4))).otherwise(s))
    groups = lambda part: F.filter(F.split(part, ":"), lambda x: x != "")
    padded = lambda part: F.array_join(F.transform(groups(part), lambda x: F.lpad(x, 4, "0")), "")
    left, right = padded(F.substring_index(s, "::", 1)), padded(F.when(s.contains("::"), F.substring_index(s, "::", -1)).otherwise(""))
    return F.concat(left, F.repeat(F.lit("0"), F.lit(32) - F.length(left) - F.length(right)), right)


def _edge(address: Column, bits: Column, width: Column, fill: int) -> Column:
    """The address of `width` digits with all bits from `bits` on set to `fill`."""
    whole = F.floor(bits / 4).cast("int")
    rest = F.get(F.array(*[F.lit(x) for x in (15, 7, 3, 1)]), (bits % 4).cast("int"))
    digit = F.conv(F.substr(address, whole + 1, F.lit(1)), 16, 10).cast("int")
    mixed = F.lower(F.hex((digit.bitwiseOR(rest) if fill else digit.bitwiseAND(F.lit(15) - rest)).cast("bigint")))
    return F.when(bits == 4 * width, address).otherwise(F.concat(F.substr(address, F.lit(1), whole), mixed, F.repeat(F.lit("f" if fill else "0"), width - 1 - whole)))


@shared
def _block(x: Column) -> Column:
    width = F.when(x["fam"] == 4, 8).otherwise(32)
    edge = lambda fill: _edge(x["at"], x["bits"], width, fill)
    return F.when(x["bits"].isNotNull() & x["at"].isNotNull(), F.struct(x["fam"].alias("fam"), x["bits"].alias("bits"), edge(0).alias("first"), edge(1).alias("last")))


def block(fam: Column, bits: Column, address: Column) -> Column:
    """The struct of the block of `bits` bits around an address in hex."""
    return _block(F.struct(fam.cast("int").alias("fam"), bits.cast("int").alias("bits"), address.alias("at")))


@shared
def parse(s: Column) -> Column:
    """The block of an entry, masked; an address is a block of its own. IPv4-mapped IPv6 becomes IPv4. Null for anything else."""

    def of(t: Column) -> Column:
        address, length = F.substring_index(t, "/", 1), F.when(t.contains("/"), F.substring_index(t, "/", -1).try_cast("int"))
        v4 = block(F.lit(4), F.coalesce(length, F.lit(32)), _hex4(address))
        v6 = let(F.struct(F.coalesce(length, F.lit(128)).alias("bits"), _hex6(address).alias("at")), of6)
        return F.when(t.rlike(rf"\A{V4}(?:/{_BITS4})?\z"), v4).when(t.rlike(rf"\A{V6}(?:/{_BITS6})?\z"), v6)

    def of6(x: Column) -> Column:
        mapped = F.when(x["bits"] >= 96, block(F.lit(4), x["bits"] - 96, F.substring(x["at"], 25, 8)))
        return F.when(x["at"].startswith("00000000000000000000ffff"), mapped).otherwise(block(F.lit(6), x["bits"], x["at"]))

    return let(trim(s), of)


def _groups(first: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.lower(F.conv(F.substr(first, i * 4 + 1, F.lit(4)), 16, 16))), ":")


def address_text(fam: Column, first: Column) -> Column:
    """The address as text; in IPv6 the first longest run of at least two zero groups is '::'."""
    v4 = F.concat_ws(".", *[F.conv(F.substring(first, i, 2), 16, 10) for i in (1, 3, 5, 7)])

    def short(text: Column) -> Column:
        out = F
        for run in range(8, 1, -1):
            at = F.instr(text, ":" + "0:" * run)
            out = out.when(at > 0, F.concat(F.substr(text, F.lit(1), at - 1), F.lit("::"), F.substr(text, at + 2 * run + 1)))
        return F.regexp_replace(out.otherwise(text), r"\A:(?!:)|(?<!:):\z", "")

    return F.when(fam == 4, v4).otherwise(let(F.concat(F.lit(":"), _groups(first), F.lit(":")), short))


@shared
def cidr(b: Column) -> Column:
    """Address and length."""
    return let(b, lambda x: F.concat(address_text(x["fam"], x["first"]), F.lit("/"), x["bits"].cast("string")))


@shared
def text(b: Column) -> Column:
    """A block of one address as that address, others as address and length."""

    def of(x: Column) -> Column:
        alone = x["bits"] == F.when(x["fam"] == 4, 32).otherwise(128)
        return F.concat(address_text(x["fam"], x["first"]), F.when(alone, "").otherwise(F.concat(F.lit("/"), x["bits"].cast("string"))))

    return let(b, of)


def widened(b: Column, bits: Column) -> Column:
    """The first address of the block of `bits` bits around b."""
    return _edge(b["first"], bits, F.when(b["fam"] == 4, 8).otherwise(32), 0)


@shared
def after(last: Column) -> Column:
    """The address that follows, in hex; 'g' after the last one."""

    def raised(x: Column) -> Column:
        n = F.length(x["kept"])
        digit = F.lower(F.hex(F.conv(F.substr(x["kept"], n, F.lit(1)), 16, 10).cast("bigint") + 1))
        return F.when(n == 0, "g").otherwise(F.concat(F.substr(x["kept"], F.lit(1), n - 1), digit, F.repeat(F.lit("0"), F.length(x["last"]) - n)))

    return let(F.struct(last.alias("last"), F.regexp_replace(last, r"f+\z", "").alias("kept")), raised)


def bit_text(hex_digits: Column) -> Column:
    """Hex digits as bits in text."""
    return F.array_join(F.transform(F.split(hex_digits, "(?!\\A)(?!\\z)"), lambda d: F.lpad(F.conv(d, 16, 2), 4, "0")), "")


def hex_text(bits: Column, width: int) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.lower(F.conv(F.substr(bits, i * 4 + 1, F.lit(4)), 2, 16))), "")


def cover(fam: Column, first: Column, following: Column) -> Column:
    """The fewest blocks that make up the addresses from `first` up to, without, `following` ('g': past the end): an array of (bits, first).

    On bits as text, with one leading bit for the end of the address space: let the two differ first at bit d. Below it, the start gives a
    block at its lowest one and at every zero above that; the end gives a block at every one. If the start has no ones below d it is
    one block of its own.
    """
    return _cover(F.struct(fam.alias("fam"), first.alias("first"), following.alias("following")))


@shared
def _cover(span: Column) -> Column:
    fam, first, following = span["fam"], span["first"], span["following"]

    def of(width: int) -> Column:
        n = width * 4
        places = F.sequence(F.lit(1), F.lit(n + 1))
        bit = lambda s, i: F.substr(s, i, F.lit(1))
        up_to = lambda s, i: F.substr(s, F.lit(1), i)
        made = lambda i, s: F.struct((i - 1).cast("int").alias("bits"), hex_text(F.substr(F.rpad(s, n + 1, "0"), F.lit(2), F.lit(n)), width).alias("first"))
        a = F.concat(F.lit("0"), bit_text(first))
        e = F.when(following == "g", F.concat(F.lit("1"), F.repeat(F.lit("0"), n))).otherwise(F.concat(F.lit("0"), bit_text(following)))

        def place(x: Column) -> Column:
            differ = F.array_min(F.filter(places, lambda i: bit(x["a"], i) != bit(x["e"], i)))
            lowest = F.length(F.regexp_replace(x["a"], r"0+\z", ""))  # place of the lowest one, 0 without any
            return F.struct(x["a"].alias("a"), x["e"].alias("e"), differ.alias("d"), lowest.alias("low"))

        def blocks(x: Column) -> Column:
            whole = x["low"] <= x["d"]  # nothing below d: the whole lower half
            up = F.filter(places, lambda i: ~whole & (i > x["d"]) & (i <= x["low"]) & ((i == x["low"]) | (bit(x["a"], i) == "0")))
            down = F.filter(places, lambda i: (i > x["d"]) & (bit(x["e"], i) == "1"))
            own = F.when(whole, F.array(made(x["d"], up_to(x["a"], x["d"])))).otherwise(F.array().cast("array<struct<bits:int,first:string>>"))
            return F.concat(F.transform(up, lambda i: made(i, F.concat(up_to(x["a"], i - 1), F.lit("1")))), own, F.transform(down, lambda i: made(i, up_to(x["e"], i - 1))))

        return let(let(F.struct(a.alias("a"), e.alias("e")), place), blocks)

    return F.when(fam == 4, of(8)).otherwise(of(32))
