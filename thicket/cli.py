"""The command line: run, check, version."""

from __future__ import annotations

import argparse
import logging
import signal
import sys
import threading
from collections.abc import Callable
from datetime import UTC, datetime
from typing import TextIO

from pyspark.sql import SparkSession

from .plans.config import VERSION, Config, ConfigError, load
from .plans.publish import Hadoop, Publisher
from .plans.runner import Result, Runner
from .streaming.loop import parse_every, run_loop


def columns(rows: list[list[str]]) -> str:
    """Rows in columns, two spaces apart."""
    widths = [max(len(r[i]) for r in rows) for i in range(len(rows[0]))]
    return "".join("".join(c.ljust(w + 2) for c, w in zip(r[:-1], widths, strict=False)) + r[-1] + "\n" for r in rows)


def result_table(results: list[Result], dry_run: bool = False) -> str:
    head = ["JOB", "ENTRIES", "CHANGED", *(["WOULD WRITE", "WOULD UPLOAD"] if dry_run else ["WRITTEN", "UPLOADED"]), "STATUS"]
    return columns([head, *([r.job, str(r.entries), str(r.changed).lower(), str(len(r.written)), str(len(r.uploaded)), f"error: {r.error}" if r.error else "ok"] for r in results)])


def job_table(config: Config) -> str:
    rows = [["JOB", "KIND", "MODE", "ORDER", "SOURCES", "OUTPUTS"]]
    for j in config.jobs:
        outs = [f"{o.format}:{o.path}" + "".join(f" → s3:{config.s3.prefix}{t.key}" for t in o.s3) for o in j.outputs]
        rows.append([j.name, j.kind, j.mode, j.order, str(len(j.sources)), ", ".join(outs)])
    return columns(rows)


def wants_uploads(config: Config) -> bool:
    return any(t.bucket or config.s3.bucket for j in config.jobs for o in j.outputs for t in o.s3)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="thicket", description="Build network rule lists.")
    commands = p.add_subparsers(dest="command", required=True)
    for name, text in (("run", "fetch, process and publish the jobs of the config file"), ("check", "validate the config file and print its jobs")):
        c = commands.add_parser(name, help=text)
        c.add_argument("-c", "--config", default="thicket.yaml", help="config file")
        c.add_argument("-j", "--job", action="append", default=[], help="run only this job; repeatable")
        c.add_argument("--dry-run", action="store_true", help="report what would change")
        c.add_argument("--no-upload", action="store_true", help="write local outputs alone")
        c.add_argument("--force", action="store_true", help="treat every job as changed")
        c.add_argument("--every", default="", help="repeat every interval, such as 30m, 6h or 1d; the config is read anew each time")
        c.add_argument("-v", action="store_true", dest="verbose", help="debug logging")
    commands.add_parser("version", help="print the version")
    return p


def run_once(args: argparse.Namespace, spark: SparkSession, out: TextIO, err: TextIO, publisher: Callable[[Config], Publisher] | None = None, stop: threading.Event | None = None) -> int:
    try:
        config = load(args.config)
    except (ConfigError, OSError) as e:
        print("error:", e, file=err)
        return 1
    target = None
    if not args.dry_run and not args.no_upload and wants_uploads(config):
        target = publisher(config) if publisher else Hadoop(spark, config.s3.region, config.s3.endpoint, config.s3.force_path_style)
    results = Runner(spark, config, publisher=target, dry_run=args.dry_run, no_upload=args.no_upload, force=args.force).run(args.job)
    print("run at", datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), file=out)
    out.write(result_table(results, args.dry_run))
    return int(any(r.error for r in results) or bool(stop and stop.is_set()))


def main(argv: list[str] | None = None, spark: SparkSession | None = None, out: TextIO = sys.stdout, err: TextIO = sys.stderr, stop: threading.Event | None = None) -> int:
    """0: all went well; 1: a job or the config failed; 2: wrong usage."""
    try:
        args = _parser().parse_args(argv)
    except SystemExit as e:
        return 2 if e.code else 0
    if args.command == "version":
        print(VERSION, file=out)
        return 0
    if args.command == "check":
        try:
            config = load(args.config)
        except (ConfigError, OSError) as e:
            print("error:", e, file=err)
            return 1
        out.write(job_table(config))
        print(f'\nconfig ok: {len(config.jobs)} jobs, state dir {config.resolve(config.state_dir)}, s3 bucket "{config.s3.bucket}"', file=out)
        return 0
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO, stream=err)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    every = None
    if args.every:
        try:
            every = parse_every(args.every)
        except ValueError as e:
            print("error: --every:", e, file=err)
            return 2
    if stop is None:
        stop = threading.Event()
        for s in (signal.SIGINT, signal.SIGTERM):
            signal.signal(s, lambda *_: stop.set())
    spark = spark or SparkSession.builder.appName("thicket").getOrCreate()
    once = lambda: run_once(args, spark, out, err, stop=stop)
    return run_loop(every, once, stop, lambda text: print(text, file=out)) if every else once()


if __name__ == "__main__":
    sys.exit(main())
