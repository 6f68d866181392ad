"""What is kept of a job's last run, and files written whole."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
from collections.abc import Iterable
from dataclasses import dataclass, field


class StateError(ValueError):
    pass


def hash_bytes(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def join(lines: Iterable[str]) -> str:
    """Lines, each with a line end."""
    return "".join(f"{x}\n" for x in lines)


def hash_lines(lines: Iterable[str]) -> str:
    """Hex SHA-256 of the joined lines, without joining them."""
    h = hashlib.sha256()
    for x in lines:
        h.update(x.encode() + b"\n")
    return h.hexdigest()


def write_atomic(path: str, data: bytes) -> None:
    """Write a file by renaming a temporary one beside it; folders are made as needed."""
    folder = os.path.dirname(path) or "."
    os.makedirs(folder, exist_ok=True)
    fd, temp = tempfile.mkstemp(prefix=f".{os.path.basename(path)}.", suffix=".tmp", dir=folder)
    try:
        with os.fdopen(fd, "wb") as f:
            f.write(data)
        os.chmod(temp, 0o644)
        os.replace(temp, path)
    except BaseException:
        os.unlink(temp)
        raise


@dataclass
class OutputState:
    hash: str = ""
    uploaded_to: list[str] = field(default_factory=list)


@dataclass
class State:
    hash: str = ""
    updated_at: str = ""
    outputs: dict[str, OutputState] = field(default_factory=dict)


@dataclass
class Store:
    """One folder a job: state.json and intermediate.txt."""

    dir: str

    def _path(self, job: str, name: str) -> str:
        return os.path.join(self.dir, job, name)

    def intermediate_path(self, job: str) -> str:
        return self._path(job, "intermediate.txt")

    def load(self, job: str) -> State | None:
        """The state of a job; None before its first run. A file that is none is an error. `uploaded_to` may be one text instead of a list."""
        path = self._path(job, "state.json")
        try:
            with open(path, "rb") as f:
                raw = json.load(f)
            outputs = {}
            for k, v in (raw.get("outputs") or {}).items():
                to = v.get("uploaded_to") or []
                outputs[k] = OutputState(v.get("hash", ""), [to] if isinstance(to, str) else list(to))
            return State(raw.get("hash", ""), raw.get("updated_at", ""), outputs)
        except FileNotFoundError:
            return None
        except (ValueError, AttributeError, TypeError) as e:
            raise StateError(f"state {path}: {e}") from None

    def save(self, job: str, state: State) -> None:
        outputs = {k: {"hash": v.hash} | ({"uploaded_to": v.uploaded_to} if v.uploaded_to else {}) for k, v in sorted(state.outputs.items())}
        text = json.dumps({"hash": state.hash, "updated_at": state.updated_at, "outputs": outputs}, indent=2, ensure_ascii=False)
        write_atomic(self._path(job, "state.json"), text.encode() + b"\n")

    def write_intermediate(self, job: str, lines: Iterable[str]) -> None:
        write_atomic(self.intermediate_path(job), join(lines).encode())
