"""Calls of functions that users pass in: within a time limit, and without an end to a task."""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Sequence
from typing import Any, NamedTuple

# So many calls in a row that bring nothing in time, and a task asks no more.
MOST_SILENT = 3


class Outcome(NamedTuple):
    value: Any
    error: str | None
    seconds: float


class _Silent(Exception):
    pass


def within(limit: float | None, function: Callable, *given: Any) -> Any:
    """What ``function`` returns, or ``_Silent`` after ``limit`` seconds.

    A call that never returns keeps its thread, which ends with the worker.
    """
    if limit is None:
        return function(*given)
    replies: queue.Queue = queue.Queue()

    def call() -> None:
        try:
            replies.put((function(*given), None))
        except Exception as problem:  # noqa: BLE001 - handed to the caller
            replies.put((None, problem))

    threading.Thread(target=call, daemon=True).start()
    try:
        found, problem = replies.get(timeout=limit)
    except queue.Empty:
        raise _Silent(f"TimeoutError: no reply within {limit:g} seconds") from None
    if problem is not None:
        raise problem
    return found


class Hook:
    """One task's use of a function ``list -> as many results``.

    A call may take ``limit`` seconds.  If it fails, its items are asked one by one; these share
    ``limit`` seconds once more, each an equal part of what is left, so an item that hangs does
    not take the others' time and a call with its retries ends within twice the limit.  After
    ``MOST_SILENT`` calls in a row that bring nothing in time the function is not called again.
    """

    def __init__(self, function: Callable[[list], Sequence], limit: float | None = None) -> None:
        self.function, self.limit, self.silent = function, limit, 0

    def outcomes(self, items: list) -> list[Outcome]:
        if not items:
            return []
        if self.silent >= MOST_SILENT:
            return [Outcome(None, f"TimeoutError: not asked after {MOST_SILENT} calls without a reply", 0.0)] * len(items)
        found, silent = self._asked(items, self.limit)
        if found[0].error and len(items) > 1:
            ends = None if self.limit is None else time.perf_counter() + self.limit
            found, silent = [], True
            for k, item in enumerate(items):
                part = None if ends is None else max(0.0, ends - time.perf_counter()) / (len(items) - k)
                [one], nothing = self._asked([item], part)
                found.append(one)
                silent &= nothing
        self.silent = self.silent + 1 if silent else 0
        return found

    def _asked(self, items: list, limit: float | None) -> tuple[list[Outcome], bool]:
        """The outcome of every item of one call, and whether no reply came in time."""
        started, silent = time.perf_counter(), False
        try:
            values = within(limit, self.function, items)
            if len(values) != len(items):
                raise ValueError(f"{len(values)} replies to {len(items)} items")
        except _Silent as problem:
            values, error, silent = [None] * len(items), str(problem), True
        except Exception as problem:  # noqa: BLE001 - any failure of a hook becomes data
            values, error = [None] * len(items), f"{type(problem).__name__}: {problem}"
        else:
            error = None
        seconds = (time.perf_counter() - started) / len(items)
        return [Outcome(v, error, seconds) for v in values], silent
