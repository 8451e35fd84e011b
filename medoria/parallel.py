"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

T = TypeVar("T")
R = TypeVar("R")

AT_ONCE = 4


def together(work: Callable[[T], R], items: Iterable[T], at_once: int = AT_ONCE) -> list[R]:
    """``work`` on each item, a few at a time, results in order.

    A small table keeps few cores busy; jobs of several tables fill the rest.
    The first error is raised once all items are done.
    """
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(work, items))
