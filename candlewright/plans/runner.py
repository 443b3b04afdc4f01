"""Running named tasks one after another, each isolated from the others' failures."""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path


@dataclass(frozen=True)
class Task:
    name: str
    run: Callable[[], object]
    enabled: bool = True


@dataclass
class Outcome:
    name: str
    status: str
    seconds: float = 0.0
    error: str = ""


def run_tasks(tasks: list[Task]) -> list[Outcome]:
    """Tasks in order, each name once; disabled ones are skipped, a failure does not stop the rest."""
    out, seen = [], set()
    for task in tasks:
        if task.name in seen:
            continue
        seen.add(task.name)
        if not task.enabled:
            out.append(Outcome(task.name, "SKIPPED"))
            continue
        began = time.monotonic()
        try:
            task.run()
            out.append(Outcome(task.name, "OK", time.monotonic() - began))
        except Exception as e:
            out.append(Outcome(task.name, "FAILED", time.monotonic() - began, f"{type(e).__name__}: {e}"))
    return out


def exit_code(outcomes: list[Outcome]) -> int:
    return int(any(o.status == "FAILED" for o in outcomes))


class Lock:
    """An exclusive lock file with the owner's process id; one whose process is gone is taken over."""

    def __init__(self, path: str):
        self.path = Path(path)

    def __enter__(self):
        for _ in range(2):
            try:
                with self.path.open("x") as f:
                    f.write(str(os.getpid()))
                return self
            except FileExistsError:
                owner = self.path.read_text().strip()
                if owner.isdigit() and Path(f"/proc/{owner}").exists():
                    raise RuntimeError(f"held by process {owner}") from None
                self.path.unlink(missing_ok=True)
        raise RuntimeError(f"cannot lock {self.path}")

    def __exit__(self, *_):
        self.path.unlink(missing_ok=True)
