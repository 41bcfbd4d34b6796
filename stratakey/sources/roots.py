"""Replicas of a table under several roots, and the choice of one."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from typing import TypeVar

from pyspark.sql import SparkSession

R = TypeVar("R")


class NoRoot(RuntimeError):
    pass


class FirstAvailable:
    """The first root in order of priority that answers. Names are compared without case."""

    name = "firstAvailable"

    def __init__(self, roots: Mapping[str, str], available: Callable[[str], bool], priorities: Sequence[str] | None = None, remember: float = 60.0, period: float = 600.0, clock: Callable[[], float] = time.monotonic):
        self.roots = {k.upper(): v for k, v in roots.items()}
        order = [p.upper() for p in (priorities or self.roots)]
        if len(set(order)) < len(order):
            raise ValueError(f"a root is named twice: {', '.join(order)}")
        if missing := set(self.roots) - set(order):
            raise ValueError(f"roots without a priority: {', '.join(sorted(missing))}")
        if unknown := set(order) - set(self.roots):
            raise ValueError(f"unknown roots: {', '.join(sorted(unknown))}")
        self.order, self._available, self.remember, self.period, self.clock = order, available, remember, period, clock
        self._known: dict[str, tuple[float, bool]] = {}
        self._chosen: tuple[float, str] | None = None

    def available(self, name: str) -> bool:
        at, ok = self._known.get(name, (-float("inf"), False))
        if self.clock() - at > self.remember:
            ok = self._available(self.roots[name])
            self._known[name] = (self.clock(), ok)
        return ok

    def pick(self) -> str:
        """The name of the root in use; chosen anew after each period, or when refresh() asks for it."""
        if self._chosen is None or self.clock() - self._chosen[0] >= self.period:
            found = next((n for n in self.order if self.available(n)), None)
            if found is None:
                raise NoRoot("no root is available")
            self._chosen = (self.clock(), found)
        return self._chosen[1]

    def refresh(self) -> None:
        self._chosen = None
        self._known.clear()

    def run(self, work: Callable[[str], R], attempts: int = 3) -> R:
        """work(root); if it fails and the root is gone, again with another one."""
        for attempt in range(attempts):
            name = self.pick()
            try:
                return work(self.roots[name])
            except Exception:
                self._known.clear()
                if attempt == attempts - 1 or self.available(name):
                    raise
                self.refresh()
        raise AssertionError


STRATEGIES = {FirstAvailable.name: FirstAvailable}


def path_exists(spark: SparkSession) -> Callable[[str], bool]:
    def check(root: str) -> bool:
        p = spark._jvm.org.apache.hadoop.fs.Path(root)
        return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))

    return check
