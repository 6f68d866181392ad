"""Runs jobs: read, parse, filter, process, compare with the last run, write and upload what needs it."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hosts as H
from ..functions import rules as R
from ..operators.filters import Excludes, PatternError, compile_patterns
from ..sources import formats
from ..sources.fetch import Fetcher, load
from . import render
from .config import Config, Filter, Job, Output, Source
from .jobs import Plan, domain_job, ip_job, mirror_job, rule_job, source_stats
from .publish import Object, Publisher
from .state import OutputState, State, StateError, Store, hash_bytes, hash_lines, write_atomic

log = logging.getLogger("thicket")


class JobError(RuntimeError):
    pass


@dataclass
class Result:
    job: str
    entries: int = 0
    changed: bool = False
    written: list[str] = field(default_factory=list)
    uploaded: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    error: str | None = None


#: The elements of a time layout and what strftime calls them.
_LAYOUT = {
    "January": "%B", "Jan": "%b", "Monday": "%A", "Mon": "%a", "2006": "%Y", "01": "%m", "02": "%d", "15": "%H", "03": "%I", "04": "%M", "05": "%S",
    "06": "%y", "PM": "%p", "MST": "%Z", "-0700": "%z", "Z07:00": "Z", "Z0700": "Z", "-07:00": "+00:00", ".000000": ".%f",
}


def format_time(now: datetime, layout: str) -> str:
    """A time, in UTC, in the layout that spells out 2006-01-02T15:04:05."""
    now = now.astimezone(UTC)
    plain = {"1": str(now.month), "2": str(now.day), "_2": f"{now.day:2}", "3": str((now.hour + 11) % 12 + 1), "4": str(now.minute), "5": str(now.second), "pm": now.strftime("%p").lower(), ".000": f".{now.microsecond // 1000:03}"}
    known = sorted([*_LAYOUT, *plain], key=len, reverse=True)
    return re.sub("|".join(map(re.escape, known)), lambda m: plain[m[0]] if m[0] in plain else now.strftime(_LAYOUT[m[0]]), layout)


@dataclass
class Runner:
    """now, fetcher and publisher are seams; without a publisher nothing is uploaded."""

    spark: SparkSession
    config: Config
    fetcher: Fetcher | None = None
    publisher: Publisher | None = None
    now: Callable[[], datetime] = lambda: datetime.now(UTC)
    dry_run: bool = False
    no_upload: bool = False
    force: bool = False

    def __post_init__(self):
        h = self.config.http
        self.fetcher = self.fetcher or Fetcher(h.timeout.total_seconds(), h.retries, h.user_agent, h.max_body_bytes, self.config.base_dir)
        self.store = Store(self.config.resolve(self.config.state_dir))

    def run(self, only: Iterable[str] = ()) -> list[Result]:
        """The named jobs, in that order, or all; one after another, since a job may read what an earlier one wrote. A failing one stops no other."""
        by_name = {j.name: j for j in self.config.jobs}
        names = list(only) or list(by_name)
        return [self.run_job(by_name[n]) if n in by_name else Result(n, error=f"job {n!r} is not in the config") for n in names]

    def run_job(self, job: Job) -> Result:
        result = Result(job.name)
        held: list[DataFrame] = []
        try:
            entries, failed = self._entries(job.sources, held)
            by_source = {}
            for i, s in enumerate(job.sources):
                if s.filter != Filter():
                    by_source[i] = self._excludes(s.filter, held, f"source {s}: filter")
            plan = self._plan(job, entries, by_source, self._excludes(job.filter, held, "filter"))
            self._gate(job, plan, failed)
            # The finished list is what the sinks write and the hash covers: it comes to the driver once, in order.
            lines = plan.ordered().cache()
            held.append(lines)
            ordered = [r[0] for r in lines.toLocalIterator(prefetchPartitions=True)]
            result.entries = len(ordered)
            problems = self._sync(job, ordered, result)
            if problems:
                raise JobError("; ".join(problems))
        except (JobError, PatternError, StateError, render.RenderError, OSError) as e:
            result.error = f"job {job.name}: {e}"
        finally:
            for df in held:
                df.unpersist()
        return result

    # -- reading -----------------------------------------------------------------------------------------------------------------

    def _entries(self, sources: tuple[Source, ...], held: list[DataFrame]) -> tuple[DataFrame, set[int]]:
        """The entries of all sources, read once, and the optional ones that failed. The first required one that fails is an error."""
        bodies = load(self.spark, sources, self.fetcher, self.config.http.concurrency).cache()
        items = formats.items(bodies.where("error is null"), {i: s.format for i, s in enumerate(sources)}).cache()
        held += [bodies, items]
        problems = {r.src_idx: r.error for r in bodies.where("error is not null").select("src_idx", "error").collect()}
        problems |= {r.src_idx: r.value for r in items.where("kind = 'error'").select("src_idx", "value").collect()}
        for i in sorted(problems):
            if not sources[i].optional:
                raise JobError(f"source {sources[i]}: {problems[i]}")
            log.warning("optional source failed: %s: %s", sources[i], problems[i])
        return items.where("kind <> 'error'"), set(problems)

    def _excludes(self, f: Filter, held: list[DataFrame], where: str) -> Excludes:
        try:
            listed = None
            if f.exclude_from:
                entries, _ = self._entries(f.exclude_from, held)
                listed = entries.select(R.pattern_of_item(F.col("kind"), H.to_ascii(F.col("value"))).alias("pattern")).where("pattern is not null").distinct()
            return compile_patterns(self.spark, list(f.exclude), listed)
        except (PatternError, JobError) as e:
            raise JobError(f"{where}: {e}") from None

    def _plan(self, job: Job, entries: DataFrame, by_source: dict[int, Excludes], excludes: Excludes) -> Plan:
        tlds = [i for i, s in enumerate(job.sources) if s.allow_tld]
        if job.kind == "domain":
            return domain_job(entries, excludes, by_source, job.order, job.allow_tld, tlds)
        if job.kind == "ip":
            return ip_job(entries, excludes, by_source, job.aggregate)
        if job.mode == "mirror":
            return mirror_job(entries, excludes)
        return rule_job(entries, excludes, by_source, job.order, job.allow_tld, tlds)

    def _gate(self, job: Job, plan: Plan, failed: set[int]) -> None:
        """Every source must have valid entries, before filters and repeats are counted off; optional ones only earn a warning. A mirror's always must."""
        stats = {r.src_idx: r for r in source_stats(plan).collect()}
        for i, s in enumerate(job.sources):
            strict = job.mode == "mirror" or not s.optional
            if i in failed and not strict:
                continue
            r = stats.get(i)
            if r:
                log.info("source %s: valid %d, invalid %d, excluded %d, rejected such as %s", s, r.valid, r.invalid, r.excluded, r.samples)
            if not r or not r.valid:
                problem = f"source {s}: no valid entries ({r.invalid if r else 0} invalid)"
                if strict:
                    raise JobError(problem)
                log.warning("optional source ignored: %s", problem)

    # -- writing -----------------------------------------------------------------------------------------------------------------

    def _sync(self, job: Job, lines: list[str], result: Result) -> list[str]:
        digest = hash_lines(lines)
        before = self.store.load(job.name)
        last = before or State()
        result.changed = self.force or before is None or last.hash != digest
        stamp = last.updated_at
        if result.changed or not stamp:
            stamp = format_time(self.now(), self.config.timestamp_layout)
        if result.changed and not self.dry_run:
            self.store.write_intermediate(job.name, lines)
        problems, following = [], State(digest, stamp)
        for out in job.outputs:
            following.outputs[out.path], found = self._output(job, out, lines, stamp, last.outputs.get(out.path, OutputState()), result)
            problems += found
        if not self.dry_run:
            self.store.save(job.name, following)
        return problems

    def _body(self, job: Job, out: Output, lines: list[str], stamp: str) -> bytes:
        renderer = render.lookup(out.format)
        if renderer is None:
            raise render.RenderError(f"unknown format {out.format!r}")
        renderer.check(job.kind, out.behavior)
        head = render.header(out.header, stamp if out.timestamp else "")
        numbered = self.spark.createDataFrame(list(enumerate(lines)), "n long, line string")
        shown = render.rendered(numbered, out.format, job.kind, out.behavior).orderBy("n").select("line", "out")
        return "".join(render.document(renderer, head, shown.toLocalIterator())).encode()

    def _output(self, job: Job, out: Output, lines: list[str], stamp: str, last: OutputState, result: Result) -> tuple[OutputState, list[str]]:
        where = f"output {out.path}"
        try:
            body = self._body(job, out, lines, stamp)
        except render.RenderError as e:
            return last, [f"{where}: {e}"]
        state = OutputState(hash_bytes(body), list(last.uploaded_to) if last.hash == hash_bytes(body) else [])
        path = self.config.resolve(out.path)
        if result.changed or last.hash != state.hash or not self._holds(path, state.hash):
            result.written.append(out.path)
            if not self.dry_run:
                try:
                    write_atomic(path, body)
                except OSError as e:
                    return state, [f"{where}: {e}"]
        else:
            result.skipped.append(out.path)
        done, problems = [], []
        for target in out.s3:
            bucket = target.bucket or self.config.s3.bucket
            uri = f"s3://{bucket}/{self.config.s3.prefix}{target.key}"
            if not result.changed and uri in state.uploaded_to:
                done.append(uri)
            elif not bucket or self.no_upload or self.publisher is None:
                log.warning("not uploaded: %s", uri)
            elif self.dry_run:
                result.uploaded.append(uri)
            else:
                try:
                    got = self.publisher.put(Object(bucket, self.config.s3.prefix + target.key, body))
                    result.uploaded.append(got)
                    done.append(got)
                except OSError as e:
                    problems.append(f"{where}: {e}")
        state.uploaded_to = done
        return state, problems

    @staticmethod
    def _holds(path: str, digest: str) -> bool:
        try:
            with open(path, "rb") as f:
                return hash_bytes(f.read()) == digest
        except OSError:
            return False
