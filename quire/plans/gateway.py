"""What stands between the engine and a model or a process: retries, JSON answers, permits, executors. The call is given."""

from __future__ import annotations

import contextlib
import hashlib
import json
import os
import re
import subprocess
import sys
import threading
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any


@dataclass(frozen=True)
class Answer:
    text: str
    tokens: int | None = None
    cost_usd: float | None = None
    finish: str | None = None


class TransientError(Exception):
    """A failure that may pass: it is tried again."""


class Truncated(Exception):
    """An answer that was cut off: not tried again, the caller cuts its input smaller."""


def generate(call: Callable[[str], Answer], prompt: str, attempts: int = 4, base: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> Answer:
    """An answer; transient failures are tried again after base, twice base and so on."""
    for i in range(attempts):
        try:
            answer = call(prompt)
        except TransientError:
            if i == attempts - 1:
                raise
            sleep(base * 2**i)
            continue
        if (answer.finish or "").lower() in ("length", "max_tokens", "max_output_tokens"):
            raise Truncated(answer.finish)
        return answer
    raise AssertionError


def first_value(text: str) -> Any:
    """The first JSON value of an answer, without code fences and whatever follows; ValueError if there is none."""
    body = text.strip()
    if body.startswith("```"):
        body = body.split("\n", 1)[1] if "\n" in body else body.strip("`")
    starts = [i for i in (body.find("{"), body.find("[")) if i >= 0]
    return json.JSONDecoder().raw_decode(body[min(starts) :] if starts else body)[0]


def generate_json(call: Callable[[str], Answer], prompt: str, check: Callable[[Any], list[str]], attempts: int = 3, **retry: Any) -> tuple[Any, Answer]:
    """A checked JSON value, and usage summed over the attempts (unknown if one is). What was wrong goes into the next prompt."""
    tokens: int | None = 0
    cost: float | None = 0.0
    said = prompt
    problems: list[str] = []
    for _ in range(attempts):
        answer = generate(call, said, **retry)
        tokens = None if tokens is None or answer.tokens is None else tokens + answer.tokens
        cost = None if cost is None or answer.cost_usd is None else cost + answer.cost_usd
        try:
            value = first_value(answer.text)
            problems = check(value)
        except ValueError as e:
            problems = [str(e)]
        if not problems:
            return value, Answer(answer.text, tokens, cost, answer.finish)
        said = prompt + "\n\nThe last answer was refused: " + "; ".join(problems)
    raise ValueError("; ".join(problems))


class Permits:
    """At most so many calls at once for each provider."""

    def __init__(self, most: Mapping[str, int], default: int = 3):
        self.most, self.default, self.lock, self.open = dict(most), default, threading.Lock(), {}

    @contextlib.contextmanager
    def lease(self, provider: str, wait: float = 120.0) -> Iterator[None]:
        with self.lock:
            gate = self.open.setdefault(provider, threading.BoundedSemaphore(self.most.get(provider, self.default)))
        if not gate.acquire(timeout=wait):
            raise TimeoutError(f"no permit for {provider}")
        try:
            yield
        finally:
            gate.release()


class FilePermits(Permits):
    """At most so many calls at once for each provider over all processes that share a folder: a permit is a lock on one of its files.

    Threads of one process contend for the process's own permits first. A process that ends gives its locks back.
    """

    def __init__(self, folder: str, most: Mapping[str, int], default: int = 3, poll: float = 0.05):
        super().__init__(most, default)
        self.folder, self.poll = folder, poll

    @contextlib.contextmanager
    def lease(self, provider: str, wait: float = 120.0) -> Iterator[None]:
        import fcntl

        name = re.sub(r"[^a-z0-9_-]+", "_", provider.strip().partition("/")[0].lower()) or "_"
        until = time.monotonic() + wait
        os.makedirs(self.folder, exist_ok=True)
        with super().lease(name, wait):
            while True:
                for i in range(self.most.get(name, self.default)):
                    fd = os.open(f"{self.folder}/{name}.{i}.lock", os.O_RDWR | os.O_CREAT, 0o666)
                    try:
                        fcntl.flock(fd, fcntl.LOCK_EX | fcntl.LOCK_NB)
                    except OSError:
                        os.close(fd)
                        continue
                    try:
                        yield
                    finally:
                        os.close(fd)
                    return
                if time.monotonic() >= until:
                    raise TimeoutError(f"no permit for {provider}")
                time.sleep(self.poll)


@dataclass(frozen=True)
class Cell:
    """One run of a station: what an executor needs, in JSON."""

    doc_id: str
    station: str
    page_id: str | None = None
    prompt: str | None = None
    prompt_sha256: str | None = None
    params: tuple[tuple[str, Any], ...] = ()

    def to_json(self) -> str:
        return json.dumps(self.__dict__ | {"params": dict(self.params)}, sort_keys=True)


def check_prompt(cell: Cell) -> None:
    if cell.prompt is not None and hashlib.sha256(cell.prompt.encode()).hexdigest() != cell.prompt_sha256:
        raise ValueError(f"{cell.station}: the prompt has changed")


class InlineExecutor:
    """Runs cells in this process."""

    def __init__(self, run: Callable[[Cell], dict[str, Any]]):
        self.run = run

    def execute(self, cell: Cell) -> dict[str, Any]:
        check_prompt(cell)
        try:
            return {"ok": True, "value": self.run(cell), "error": None}
        except Exception as e:  # a failed cell is a row, not a failed job
            return {"ok": False, "value": None, "error": f"{type(e).__name__}: {e}"}


class SubprocessExecutor:
    """Runs each cell in a process of its own: JSON in, JSON out."""

    def __init__(self, command: list[str] | None = None, timeout: float = 28_800.0):
        self.command, self.timeout = command or [sys.executable, "-m", "quire.plans.cellmain"], timeout

    def execute(self, cell: Cell) -> dict[str, Any]:
        check_prompt(cell)
        try:
            done = subprocess.run(self.command, input=cell.to_json(), capture_output=True, text=True, timeout=self.timeout)
        except subprocess.TimeoutExpired:
            return {"ok": False, "value": None, "error": "timed out"}
        if done.returncode:
            return {"ok": False, "value": None, "error": done.stderr[-500:]}
        try:
            return {"ok": True, "value": json.loads(done.stdout), "error": None}
        except ValueError:
            return {"ok": False, "value": None, "error": "the process gave no JSON"}
