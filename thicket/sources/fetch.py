"""Bodies of sources: URLs with retries, files, inline text; one row a source."""

from __future__ import annotations

import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import text as T

SCHEMA = "src_idx int, spec string, body string, error string"


class FetchError(OSError):
    pass


def delay(attempt: int, chance: Callable[[], float] = random.random) -> float:
    """Seconds before attempt 1, 2, ...: 0.2 doubling up to 5, and up to half as much again by chance."""
    return min(5.0, 0.2 * 2 ** (attempt - 1)) * (1 + chance() / 2)


@dataclass
class Fetcher:
    """Reads one source. `get` and `sleep` are seams for tests: get(url, timeout, agent, limit) -> (status, at most limit bytes)."""

    timeout: float = 60
    retries: int = 3
    user_agent: str = "thicket"
    max_body_bytes: int = 64 << 20
    base_dir: str = "."
    get: Callable[[str, float, str, int], tuple[int, bytes]] | None = None
    sleep: Callable[[float], None] = field(default=time.sleep)

    def _get(self, url: str) -> tuple[int, bytes]:
        if self.get:
            return self.get(url, self.timeout, self.user_agent, self.max_body_bytes + 1)
        request = urllib.request.Request(url, headers={"User-Agent": self.user_agent})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as r:
                return r.status, r.read(self.max_body_bytes + 1)
        except urllib.error.HTTPError as e:
            return e.code, b""

    def url(self, url: str) -> bytes:
        """The body at a URL. Network errors, 429 and 5xx are tried again; other answers than 200, and bodies above the limit, are final."""
        for attempt in range(self.retries + 1):
            if attempt:
                self.sleep(delay(attempt))
            try:
                status, body = self._get(url)
            except (OSError, urllib.error.URLError) as e:
                problem = str(e)
                continue
            if status == 200:
                if len(body) > self.max_body_bytes:
                    raise FetchError(f"GET {url}: body exceeds {self.max_body_bytes} bytes")
                return body
            problem = f"status {status}"
            if status != 429 and status < 500:
                break
        raise FetchError(f"GET {url}: {problem}")

    def read(self, url: str = "", file: str = "", inline: str = "") -> bytes:
        if sum(map(bool, (url, file, inline))) != 1:
            raise FetchError("needs exactly one of url, file or inline")
        if url:
            return self.url(url)
        return inline.encode() if inline else (Path(self.base_dir) / file).read_bytes()


def load(spark: SparkSession, specs: Iterable, fetcher: Fetcher, concurrency: int = 8) -> DataFrame:
    """specs (url, file, inline, encoding) -> (src_idx, spec, body, error), in their order; body is decoded, error is null where all went well.

    The driver reads, up to `concurrency` sources at once: a configuration's few lists, each below the body limit, read exactly once.
    Where lists are many or live in a store, `from_files` and the `thicket_urls` source read them on the executors.
    """
    specs = list(specs)

    def one(spec) -> tuple[bytes | None, str | None]:
        try:
            return fetcher.read(spec.url, spec.file, spec.inline), None
        except OSError as e:
            return None, str(e)

    with ThreadPoolExecutor(max(1, concurrency)) as pool:
        got = list(pool.map(one, specs))
    rows = [(i, str(s), s.encoding, b.decode("utf-8", "replace") if b is not None else None, e) for i, (s, (b, e)) in enumerate(zip(specs, got, strict=True))]
    raw = spark.createDataFrame(rows, "src_idx int, spec string, encoding string, raw string, error string")
    return decoded(raw.repartition(max(1, min(len(rows), 32)), "src_idx"))


def decoded(raw: DataFrame) -> DataFrame:
    """(src_idx, spec, encoding, raw, error) -> (src_idx, spec, body, error): each body by its own encoding."""
    c = F.col("raw")
    body = F.when(F.col("encoding") == "plain", c).when(F.col("encoding") == "base64", T.decode(c, "base64")).otherwise(T.decode(c, "auto"))
    problem = F.when(c.isNotNull() & body.isNull(), F.lit("body is not base64"))
    return raw.select("src_idx", "spec", body.alias("body"), F.coalesce("error", problem).alias("error"))


def from_files(spark: SparkSession, path: str, encoding: str = "auto") -> DataFrame:
    """Every file under a path of any store that Spark reads, one row each; src_idx by name order (files are few against their lines)."""
    from ..operators.hosts import ranked

    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("spec"), F.col("content").cast("string").alias("raw"))
    named = ranked(files.select("spec"), "spec").select("spec", (F.col("rank") - 1).cast("int").alias("src_idx"))
    return decoded(files.join(named, "spec").select("src_idx", "spec", F.lit(encoding).alias("encoding"), "raw", F.lit(None).cast("string").alias("error")))


class _UrlPartition(InputPartition):
    def __init__(self, i: int, url: str):
        self.i, self.url = i, url


class _UrlReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        return [_UrlPartition(i, u) for i, u in enumerate(self.options["urls"].split())]

    def read(self, part):
        o = self.options
        fetcher = Fetcher(float(o.get("timeout", 60)), int(o.get("retries", 3)), o.get("useragent", "thicket"), int(o.get("maxbodybytes", 64 << 20)))
        try:
            yield part.i, part.url, o.get("encoding", "auto"), fetcher.url(part.url).decode("utf-8", "replace"), None
        except FetchError as e:
            yield part.i, part.url, o.get("encoding", "auto"), None, str(e)


class UrlSource(DataSource):
    """spark.read.format("thicket_urls").option("urls", "http://a http://b").load(): a partition a URL, read on the executors; pass the rows to `decoded`."""

    @classmethod
    def name(cls):
        return "thicket_urls"

    def schema(self):
        return "src_idx int, spec string, encoding string, raw string, error string"

    def reader(self, schema):
        return _UrlReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(UrlSource)
