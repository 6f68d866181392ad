"""The configuration file: strict YAML to frozen dataclasses."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field
from datetime import timedelta
from pathlib import Path

import yaml

from ..sources import formats
from . import render

VERSION = "0.1"


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Http:
    timeout: timedelta = timedelta(seconds=60)
    retries: int = 3
    user_agent: str = f"thicket/{VERSION}"
    concurrency: int = 8
    max_body_bytes: int = 64 << 20


@dataclass(frozen=True)
class S3:
    bucket: str = ""
    region: str = ""
    endpoint: str = ""
    prefix: str = ""
    force_path_style: bool = False


@dataclass(frozen=True)
class Filter:
    exclude: tuple[str, ...] = ()
    exclude_from: tuple[Source, ...] = ()


@dataclass(frozen=True)
class Source:
    url: str = ""
    file: str = ""
    inline: str = ""
    format: str = "auto"
    encoding: str = "auto"
    filter: Filter = field(default_factory=Filter)
    allow_tld: bool = False
    optional: bool = False

    def __str__(self) -> str:
        """What logs call the source."""
        return self.url or self.file or f"inline ({len(self.inline.encode())} bytes)"


@dataclass(frozen=True)
class S3Target:
    key: str = ""
    bucket: str = ""


@dataclass(frozen=True)
class Output:
    format: str
    path: str
    behavior: str = ""
    header: tuple[str, ...] = ()
    timestamp: bool = True
    s3: tuple[S3Target, ...] = ()


@dataclass(frozen=True)
class Job:
    name: str
    kind: str
    mode: str
    order: str
    sources: tuple[Source, ...]
    outputs: tuple[Output, ...]
    aggregate: bool = True
    allow_tld: bool = False
    filter: Filter = field(default_factory=Filter)


@dataclass(frozen=True)
class Config:
    jobs: tuple[Job, ...]
    base_dir: str
    state_dir: str = "state"
    timestamp_layout: str = "2006-01-02T15:04:05Z"
    http: Http = field(default_factory=Http)
    s3: S3 = field(default_factory=S3)

    def resolve(self, path: str) -> str:
        """A path relative to the configuration's folder."""
        return path if os.path.isabs(path) else os.path.join(self.base_dir, path)


def expand_env(text: str, env: dict[str, str] | None = None) -> str:
    """$NAME and ${NAME} replaced by the environment, unset ones by nothing; $ before one of *#$@!?- or a digit goes with it; other $ stay."""
    env = os.environ if env is None else env

    def put(m: re.Match) -> str:
        name = m[1] if m[1] is not None else m[2]
        if name is None:
            return ""
        return env.get(name, "")

    return re.sub(r"\$(?:\{([^}]*)\}|([A-Za-z_][A-Za-z0-9_]*)|[*#$@!?0-9-])", put, text)


_UNITS = {"ns": 1e-3, "us": 1, "µs": 1, "μs": 1, "ms": 1e3, "s": 1e6, "m": 6e7, "h": 3.6e9}


def duration(text: str) -> timedelta:
    """A signed run of numbers with units (h, m, s, ms, us, ns), such as 1h30m; 0 needs none."""
    m = re.fullmatch(r"([+-]?)((?:(?:\d+\.?\d*|\.\d+)(?:ns|us|µs|μs|ms|s|m|h))+|0)", text)
    if not m:
        raise ValueError(f"bad duration {text!r}")
    total = sum(float(n) * _UNITS[u] for n, u in re.findall(r"(\d+\.?\d*|\.\d+)(ns|us|µs|μs|ms|s|m|h)", m[2]))
    return timedelta(microseconds=-total if m[1] == "-" else total)


class _Loader(yaml.SafeLoader):
    """Without duplicate keys."""

    def construct_mapping(self, node, deep=False):
        keys = [self.construct_object(k, deep) for k, _ in node.value]
        if len(keys) != len(set(keys)):
            raise ConfigError(f"duplicate key near line {node.start_mark.line + 1}")
        return super().construct_mapping(node, deep)


#: Keys and the types of their values; a tuple of one type is a list.
_SCHEMA = {
    "top": {"state_dir": str, "timestamp_layout": str, "http": "http", "s3": "s3", "jobs": ["job"]},
    "http": {"timeout": str, "retries": int, "user_agent": str, "concurrency": int, "max_body_bytes": int},
    "s3": {"bucket": str, "region": str, "endpoint": str, "prefix": str, "force_path_style": bool},
    "job": {"name": str, "kind": str, "mode": str, "order": str, "aggregate": bool, "allow_tld": bool, "sources": ["source"], "filter": "filter", "outputs": ["output"]},
    "source": {"url": str, "file": str, "inline": str, "format": str, "encoding": str, "filter": "filter", "allow_tld": bool, "optional": bool},
    "filter": {"exclude": [str], "exclude_from": ["source"]},
    "output": {"format": str, "path": str, "behavior": str, "header": [str], "timestamp": bool, "s3": "targets"},
    "target": {"key": str, "bucket": str},
}


def _typed(value, want, where: str):
    """The value, checked against its type; nulls are left out by the caller."""
    if want == "targets":
        return [_typed(v, "target", where) for v in value] if isinstance(value, list) else [_typed(value, "target", where)]
    if isinstance(want, list):
        if not isinstance(value, list):
            raise ConfigError(f"{where}: must be a list")
        return [_typed(v, want[0], f"{where} {i + 1}") for i, v in enumerate(value)]
    if isinstance(want, str):
        if not isinstance(value, dict):
            raise ConfigError(f"{where}: must be a mapping")
        if unknown := [k for k in value if k not in _SCHEMA[want]]:
            raise ConfigError(f"{where}: unknown key {unknown[0]!r}")
        return {k: _typed(v, _SCHEMA[want][k], f"{where}.{k}" if where else k) for k, v in value.items() if v is not None}
    if want is str and isinstance(value, (int, float)) and not isinstance(value, bool):
        return str(value)
    if not isinstance(value, want) or want is int and isinstance(value, bool):
        raise ConfigError(f"{where}: must be {want.__name__}")
    return value


def _check(ok: bool, message: str) -> None:
    if not ok:
        raise ConfigError(message)


def _http(raw: dict) -> Http:
    raw = {k: v for k, v in raw.items() if v != ""}
    if "timeout" in raw:
        try:
            raw["timeout"] = duration(raw["timeout"])
        except ValueError:
            raw["timeout"] = timedelta(0)
        _check(raw["timeout"] > timedelta(0), "http.timeout must be a positive duration such as 30s")
    _check(raw.get("retries", 0) >= 0, "http.retries must not be negative")
    _check(raw.get("concurrency", 1) >= 1, "http.concurrency must be at least 1")
    _check(raw.get("max_body_bytes", 1) >= 1, "http.max_body_bytes must be positive")
    return Http(**raw)


def _filter(raw: dict) -> Filter:
    return Filter(tuple(raw.get("exclude", ())), tuple(_source(s, f"exclude_from {i + 1}") for i, s in enumerate(raw.get("exclude_from", ()))))


def _source(raw: dict, where: str) -> Source:
    raw = {k: v for k, v in raw.items() if v != ""}
    found = Source(**raw | {"filter": _filter(raw.get("filter", {}))})
    _check(sum(map(bool, (found.url, found.file, found.inline))) == 1, f"{where}: needs exactly one of url, file or inline")
    _check(found.format == "auto" or formats.lookup(found.format) is not None, f"{where}: unknown format {found.format!r} (known: {', '.join(formats.names())})")
    _check(found.encoding in ("plain", "base64", "auto"), f"{where}: encoding {found.encoding!r} must be plain, base64 or auto")
    return found


def _output(raw: dict, kind: str, where: str) -> Output:
    name, behavior = raw.get("format", ""), raw.get("behavior", "")
    renderer = render.lookup(name)
    _check(renderer is not None, f"{where}: unknown format {name!r} (known: {', '.join(render.names())})")
    _check(renderer.supports(kind), f"{where}: format {name!r} cannot render {kind} jobs")
    try:
        renderer.check(kind, behavior)
    except render.RenderError as e:
        raise ConfigError(f"{where}: {e}") from None
    _check(bool(raw.get("path")), f"{where}: path is required")
    targets = raw.get("s3")
    if targets is not None:
        _check(bool(targets), f"{where}: s3 must name at least one target")
        _check(all(t.get("key") for t in targets), f"{where}: every s3 target needs a key")
        ids = [(t.get("bucket", ""), t["key"]) for t in targets]
        _check(len(set(ids)) == len(ids), f"{where}: duplicate s3 target")
    if renderer.behaviors and not behavior:
        behavior = "classical"
    return Output(name, raw["path"], behavior, tuple(raw.get("header", ())), raw.get("timestamp", True), tuple(S3Target(**t) for t in targets or ()))


def _job(raw: dict) -> Job:
    name, kind = raw.get("name", ""), raw.get("kind", "")
    mode = raw.get("mode") or "aggregate"
    order = raw.get("order") or ("source" if kind == "clash" else "sorted")
    sources, outputs = raw.get("sources", []), raw.get("outputs", [])
    _check(bool(re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", name)), f"name {name!r} must be letters, digits, '.', '_' or '-', a letter or digit first")
    _check(kind in ("domain", "ip", "clash"), f"kind {kind!r} must be one of domain, ip, clash")
    _check(mode in ("aggregate", "mirror"), f"mode {mode!r} must be aggregate or mirror")
    _check(mode != "mirror" or kind == "clash", "mode mirror is only valid for clash jobs")
    _check(mode != "mirror" or len(sources) == 1, "mode mirror needs exactly one source")
    _check(order in ("sorted", "source"), f"order {order!r} must be sorted or source")
    _check(bool(sources), "no sources")
    _check(bool(outputs), "no outputs")
    job = Job(
        name, kind, mode, order,
        tuple(_source(s, f"source {i + 1}") for i, s in enumerate(sources)),
        tuple(_output(o, kind, f"output {i + 1}") for i, o in enumerate(outputs)),
        raw.get("aggregate", True), raw.get("allow_tld", False), _filter(raw.get("filter", {})),
    )
    paths = [o.path for o in job.outputs]
    _check(len(set(paths)) == len(paths), "duplicate output path")
    return job


def parse(text: str, base_dir: str, env: dict[str, str] | None = None) -> Config:
    """The configuration in `text`, whose $NAME are expanded first. Unknown and doubled keys, wrong types and broken rules are errors."""
    try:
        raw = yaml.load(expand_env(text, env), _Loader)
    except yaml.YAMLError as e:
        raise ConfigError(f"parse config: {e}") from None
    raw = _typed(raw or {}, "top", "")
    _check(bool(raw.get("jobs")), "config has no jobs")
    jobs = []
    for i, j in enumerate(raw["jobs"]):
        try:
            jobs.append(_job(j))
        except ConfigError as e:
            raise ConfigError(f"job {i + 1} ({j.get('name', '')!r}): {e}") from None
    given = [j.name for j in jobs]
    _check(len(set(given)) == len(given), "duplicate job name")
    more = {k: raw[k] for k in ("state_dir", "timestamp_layout") if raw.get(k)}
    return Config(tuple(jobs), base_dir, http=_http(raw.get("http", {})), s3=S3(**raw.get("s3", {})), **more)


def load(path: str) -> Config:
    try:
        return parse(Path(path).read_text("utf-8"), str(Path(path).absolute().parent))
    except (ConfigError, UnicodeDecodeError) as e:
        raise ConfigError(f"{path}: {e}") from None
