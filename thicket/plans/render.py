"""Output formats: a list's lines as the text of a file."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import prefixes as P
from ..functions import rules as R


class RenderError(ValueError):
    pass


#: The payload styles of each job kind.
BEHAVIORS = {"domain": ("classical", "domain"), "ip": ("classical", "ipcidr"), "clash": ("classical", "domain", "ipcidr")}


def _cidr(line: Column) -> Column:
    return F.coalesce(P.cidr(P.parse(line)), line)


def _payload(kind: str, behavior: str, line: Column) -> Column:
    quoted = lambda c: F.concat(F.lit("  - '"), c, F.lit("'"))
    match kind, behavior or "classical":
        case "domain", "domain":
            return F.concat(F.lit("  - '+."), line, F.lit("'"))
        case "domain", _:
            return F.concat(F.lit("  - DOMAIN-SUFFIX,"), line)
        case "ip", "ipcidr":
            return quoted(_cidr(line))
        case "ip", _:
            return F.concat(F.lit("  - IP-CIDR,"), _cidr(line), F.lit(",no-resolve"))
        case _, "domain":
            return quoted(R.host_pattern(line))
        case _, "ipcidr":
            return quoted(R.block_text(line))
    return F.concat(F.lit("  - "), R.quote_yaml(line))


@dataclass(frozen=True)
class Renderer:
    """line(kind, behavior, line) is null for a line that the format cannot express."""

    name: str
    kinds: tuple[str, ...]
    line: Callable[[str, str, Column], Column]
    behaviors: dict[str, tuple[str, ...]] = field(default_factory=dict)
    before: str = ""
    empty: str = ""

    def supports(self, kind: str) -> bool:
        return kind in self.kinds

    def check(self, kind: str, behavior: str = "") -> None:
        if not self.supports(kind):
            raise RenderError(f"renderer {self.name!r} does not support {kind!r} jobs")
        if behavior and not self.behaviors:
            raise RenderError(f"behavior is not valid for {self.name!r} outputs")
        if behavior and behavior not in self.behaviors.get(kind, ()):
            raise RenderError(f"behavior {behavior!r} is not valid for {kind} jobs (allowed: {', '.join(self.behaviors.get(kind, ()))})")


_registry: dict[str, Renderer] = {}


def register(r: Renderer) -> None:
    """Add a renderer; one of the same name is replaced."""
    _registry[r.name] = r


def lookup(name: str) -> Renderer | None:
    return _registry.get(name)


def names() -> list[str]:
    return sorted(_registry)


register(Renderer("plain", ("domain", "ip"), lambda kind, behavior, line: line))
register(Renderer("iplist", ("ip",), lambda kind, behavior, line: line))
register(Renderer("smartdns", ("domain",), lambda kind, behavior, line: F.concat(F.lit("address /"), line, F.lit("/#"))))
register(Renderer("clash", ("domain", "ip", "clash"), _payload, BEHAVIORS, "payload:\n", "payload: []\n"))


def rendered(lines: DataFrame, format: str, kind: str, behavior: str = "", column: str = "line") -> DataFrame:
    """`lines` with out STRING: each line in the format; null where it cannot be expressed."""
    renderer = lookup(format)
    if renderer is None:
        raise RenderError(f"unknown format {format!r}")
    renderer.check(kind, behavior)
    return lines.withColumn("out", renderer.line(kind, behavior, F.col(column)))


def header(lines: Iterable[str], timestamp: str = "") -> str:
    """Comment lines, the last one with the time of the last change."""
    return "".join(f"# {x}\n" for x in lines) + (f"# last updated: {timestamp}\n" if timestamp else "")


def document(renderer: Renderer, head: str, rows: Iterable[tuple[str, str | None]]) -> Iterator[str]:
    """The parts of a file: rows (line, out) in order. The first line without `out` is an error that names it."""
    yield head
    some = False
    for line, out in rows:
        if out is None:
            raise RenderError(f"renderer {renderer.name!r}: rule {line!r} cannot be expressed in this behavior")
        yield (out if some else renderer.before + out) + "\n"
        some = True
    if not some:
        yield renderer.empty or renderer.before
