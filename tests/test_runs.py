"""Configuration, rendering, state, fetching, whole runs and the command line."""

import io
import json
import threading
from datetime import UTC, datetime, timedelta

import pytest

from thicket import cli
from thicket.plans import config as C
from thicket.plans import render
from thicket.plans.publish import Folder, Memory, Object
from thicket.plans.runner import Runner, format_time
from thicket.plans.state import OutputState, State, StateError, Store, hash_bytes, hash_lines, join
from thicket.sources.fetch import Fetcher, FetchError, delay, load
from thicket.streaming.loop import parse_every, run_loop

NOW = datetime(2031, 5, 6, 7, 8, 9, tzinfo=UTC)

BASE = """
state_dir: kept
s3: {bucket: b, prefix: p/}
jobs:
  - name: hosts
    kind: domain
    sources:
      - inline: "b.one.example\\none.example\\nbad_host\\nskip.example\\n"
        format: domain
    filter: {exclude: [skip.example]}
    outputs:
      - {format: plain, path: out/hosts.txt, header: [mine], s3: {key: hosts.txt}}
      - {format: clash, path: out/hosts.yaml, behavior: domain, timestamp: false}
"""


def test_config():
    c = C.parse(BASE, "/base", {})
    job = c.jobs[0]
    assert (c.resolve(c.state_dir), job.mode, job.order, c.http.retries, c.http.timeout) == ("/base/kept", "aggregate", "sorted", 3, timedelta(seconds=60))
    assert [o.behavior for o in job.outputs] == ["", "domain"] and job.outputs[0].s3 == (C.S3Target("hosts.txt"),)
    assert C.expand_env("$A ${B}x $/ $1 $$ $C", {"A": "1", "B": "2"}) == "1 2x $/   "


@pytest.mark.parametrize("old,new", [
    ("kind: domain", "kind: other"), ("name: hosts", "name: -x"), ("name: hosts", "nme: hosts"), ("format: plain", "format: none"), ("format: plain", "format: iplist"), ("path: out/hosts.txt", "path: out/hosts.yaml"),
    ("behavior: domain", "behavior: ipcidr"), ("header: [mine]", "behavior: domain"), ("kind: domain", "kind: domain\n    mode: mirror"), ("kind: domain", "kind: domain\n    order: up"), ("s3: {key: hosts.txt}", "s3: []"), ("s3: {key: hosts.txt}", "s3: [{key: a}, {key: a}]"),
    ("s3: {key: hosts.txt}", "s3: {bucket: x}"), ("format: domain", "format: nope"), ("format: domain", "encoding: rot13"), ("format: domain", "file: x"), ("state_dir: kept", "http: {timeout: 0s}"), ("state_dir: kept", "http: {retries: -1}"), ("state_dir: kept", "http: {concurrency: 0}"),
    ("state_dir: kept", "http: {max_body_bytes: 0}"), ("state_dir: kept", "state_dir: a\nstate_dir: b"), ("jobs:", "jobs: []\nx:"), ("state_dir: kept", "state_dir: [a]"), ("format: plain, path: out/hosts.txt", "format: plain"), ("exclude: [skip.example]", "exclude: skip.example"),
])
def test_invalid_configs(old, new):
    assert old in BASE
    with pytest.raises(C.ConfigError):
        C.parse(BASE.replace(old, new, 1), "/base", {})


def test_intervals():
    assert [parse_every(x) for x in ("30m", "1h30m", "2d", "60s")] == [timedelta(minutes=30), timedelta(minutes=90), timedelta(days=2), timedelta(minutes=1)]
    for bad in ("", "x", "1.5d", "59s", "-1h", "10", "d"):
        with pytest.raises(ValueError):
            parse_every(bad)


def test_loop_stops():
    stop, runs = threading.Event(), []

    def once():
        runs.append(1)
        if len(runs) == 3:
            stop.set()
        return 1

    assert run_loop(timedelta(0), once, stop, lambda _: None) == 0 and len(runs) == 3


def test_times():
    assert format_time(NOW, "2006-01-02T15:04:05Z") == "2031-05-06T07:08:09Z"
    assert format_time(NOW, "Jan 2, 2006 3:04 PM") == "May 6, 2031 7:08 AM"


def test_state(tmp_path):
    store = Store(str(tmp_path))
    assert store.load("j") is None
    kept = State("h", "t", {"a": OutputState("x", ["s3://b/k"]), "b": OutputState("y")})
    store.save("j", kept)
    assert store.load("j") == kept
    path = tmp_path / "j" / "state.json"
    path.write_text(json.dumps({"hash": "h", "outputs": {"a": {"hash": "x", "uploaded_to": "s3://b/k"}}}))
    assert store.load("j").outputs["a"].uploaded_to == ["s3://b/k"]
    path.write_text("{")
    with pytest.raises(StateError):
        store.load("j")
    assert join([]) == "" and hash_lines(["a", "b"]) == hash_bytes(b"a\nb\n") and hash_lines([]) == hash_bytes(b"")


def test_fetching():
    answers, slept = [], []

    def get(url, timeout, agent, limit):
        found = answers.pop(0)
        if isinstance(found, Exception):
            raise found
        return found

    f = Fetcher(retries=2, max_body_bytes=5, get=get, sleep=slept.append)
    answers[:] = [(500, b""), OSError("reset"), (200, b"abc")]
    assert f.url("u") == b"abc" and len(slept) == 2
    for given in ([(404, b"")], [(200, b"abcdef")], [(503, b""), (429, b""), (500, b"")]):
        answers[:] = given
        with pytest.raises(FetchError):
            f.url("u")
        assert not answers
    assert [delay(n, lambda: 0) for n in (1, 2, 9)] == [0.2, 0.4, 5.0] and delay(1, lambda: 1) == pytest.approx(0.3)
    with pytest.raises(FetchError):
        f.read(url="u", inline="x")


def test_loading_keeps_order_and_errors(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x.example\n")
    specs = [C.Source(file="a.txt"), C.Source(file="none.txt"), C.Source(inline="y.example"), C.Source(inline="!", encoding="base64")]
    rows = load(spark, specs, Fetcher(base_dir=str(tmp_path))).orderBy("src_idx").collect()
    assert [(r.body, r.error is None) for r in rows] == [("x.example\n", True), (None, False), ("y.example", True), (None, False)]


def test_rendering(spark):
    def out(lines, format, kind, behavior=""):
        rows = render.rendered(spark.createDataFrame(list(enumerate(lines)), "n int, line string"), format, kind, behavior).orderBy("n").collect()
        return "".join(render.document(render.lookup(format), render.header(["h"], "t"), [(r.line, r.out) for r in rows]))

    head = "# h\n# last updated: t\n"
    assert out(["a.example"], "smartdns", "domain") == head + "address /a.example/#\n"
    assert out(["10.0.0.1", "10.0.0.0/8"], "clash", "ip") == head + "payload:\n  - IP-CIDR,10.0.0.1/32,no-resolve\n  - IP-CIDR,10.0.0.0/8,no-resolve\n"
    assert out(["DOMAIN,a.example", "+.b.example"], "clash", "clash") == head + "payload:\n  - DOMAIN,a.example\n  - '+.b.example'\n"
    assert out(["DOMAIN-SUFFIX,a.example"], "clash", "clash", "domain") == head + "payload:\n  - '+.a.example'\n"
    assert out(["10.0.0.1"], "clash", "clash", "ipcidr") == head + "payload:\n  - '10.0.0.1/32'\n"
    assert out([], "clash", "domain") == head + "payload: []\n" and out([], "plain", "ip") == head
    for bad in (lambda: out(["GEOIP,XX"], "clash", "clash", "domain"), lambda: out(["a"], "iplist", "domain"), lambda: out(["a"], "clash", "ip", "domain"), lambda: out(["a"], "plain", "ip", "classical")):
        with pytest.raises(render.RenderError):
            bad()


def test_life_of_a_job(spark, tmp_path):
    memory = Memory()

    def run(text=BASE, **more):
        more = {"publisher": memory} | more
        return Runner(spark, C.parse(text, str(tmp_path), {}), now=lambda: NOW, **more).run()[0]

    planned = run(dry_run=True)
    assert (planned.changed, planned.written, planned.uploaded) == (True, ["out/hosts.txt", "out/hosts.yaml"], ["s3://b/p/hosts.txt"])
    assert not (tmp_path / "out").exists()
    first = run()
    assert (first.error, first.entries, first.changed, len(first.written), first.uploaded) == (None, 1, True, 2, ["s3://b/p/hosts.txt"])
    assert (tmp_path / "out/hosts.txt").read_text() == "# mine\n# last updated: 2031-05-06T07:08:09Z\none.example\n"
    assert (tmp_path / "out/hosts.yaml").read_text() == "payload:\n  - '+.one.example'\n"
    assert (tmp_path / "kept/hosts/intermediate.txt").read_text() == "one.example\n"
    again = run()
    assert (again.changed, again.written, again.uploaded, len(again.skipped)) == (False, [], [], 2)
    (tmp_path / "out/hosts.yaml").unlink()
    assert run().written == ["out/hosts.yaml"]
    memory.failing.add("s3://b/p/hosts.txt")
    failed = run(BASE.replace("skip.example\\n", "more.example\\n"))
    assert failed.error and failed.changed and len(failed.written) == 2
    memory.failing.clear()
    repaired = run(BASE.replace("skip.example\\n", "more.example\\n"))
    assert (repaired.changed, repaired.uploaded) == (False, ["s3://b/p/hosts.txt"])
    assert run(force=True, no_upload=True).uploaded == []
    assert "no valid entries" in run(BASE.replace("b.one.example\\none.example\\n", "").replace("skip.example\\n", "")).error


def test_jobs_read_lists_and_earlier_jobs(spark, tmp_path):
    text = """
jobs:
  - {name: first, kind: domain, sources: [{inline: "skip.example\\n", format: domain}], outputs: [{format: plain, path: first.txt}]}
  - name: second
    kind: clash
    sources:
      - {inline: "payload: ['DOMAIN-SUFFIX,keep.example', 'DOMAIN,a.skip.example', '10.1.0.0/16']", filter: {exclude: [10.0.0.0/8]}}
      - {file: gone.txt, optional: true}
    filter: {exclude_from: [{file: state/first/intermediate.txt, format: domain}]}
    outputs: [{format: clash, path: second.yaml, timestamp: false}]
  - {name: third, kind: ip, sources: [{inline: "x", format: iplist}], outputs: [{format: plain, path: third.txt}]}
"""
    runner = Runner(spark, C.parse(text, str(tmp_path), {}), now=lambda: NOW)
    results = runner.run()
    assert [r.error is None for r in results] == [True, True, False]
    assert (tmp_path / "second.yaml").read_text() == "payload:\n  - DOMAIN-SUFFIX,keep.example\n"
    assert runner.run(["nope"])[0].error


def test_publishers(tmp_path):
    assert Folder(str(tmp_path)).put(Object("b", "k/x", b"1")) == "s3://b/k/x" and (tmp_path / "b/k/x").read_bytes() == b"1"


def test_command_line(spark, tmp_path):
    def call(*args):
        out, err = io.StringIO(), io.StringIO()
        return cli.main(list(args), spark, out, err, threading.Event()), out.getvalue(), err.getvalue()

    path = tmp_path / "c.yaml"
    path.write_text(BASE.replace("s3: {bucket: b, prefix: p/}\n", ""))
    assert call("check", "-c", str(path))[0] == 0 and "hosts  domain  aggregate" in call("check", "-c", str(path))[1]
    code, out, _ = call("run", "-c", str(path), "--dry-run")
    assert code == 0 and "WOULD WRITE" in out and not (tmp_path / "out").exists()
    assert call("run", "-c", str(path), "--every", "1s")[0] == 2 and call("run", "--nope")[0] == 2 and call()[0] == 2
    assert call("check", "-c", str(tmp_path / "none"))[0] == 1 and call("version")[0] == 0
    assert call("run", "-c", str(path), "-j", "nope")[0] == 1
