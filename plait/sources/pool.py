"""Calls to other machines from within a task: some at once, answers in order."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor


def pooled(items: Iterable, call: Callable, workers: int) -> Iterator[tuple]:
    """(item, answer, error) of each item in the order of the items, with at most ``workers`` calls at a time and twice as many answers held.
    A call that fails is an error of its item, cut to 300 characters; the others go on."""

    def ended(item, future) -> tuple:
        try:
            return item, future.result(), None
        except Exception as error:  # noqa: BLE001  a call may fail in any way
            return item, None, str(error)[:300] or type(error).__name__

    with ThreadPoolExecutor(workers) as pool:
        waiting: deque = deque()
        for item in items:
            waiting.append((item, pool.submit(call, item)))
            if len(waiting) >= 2 * workers:
                yield ended(*waiting.popleft())
        while waiting:
            yield ended(*waiting.popleft())
