"""Pacing of external calls; helpers of injected functions, used where those run."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable


class Pacer:
    """At most ``most`` units (calls, or tokens) in any ``span`` seconds."""

    def __init__(self, most: float, span: float = 60.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.most, self.span, self.clock, self.sleep = most, span, clock, sleep
        self.spent: deque[tuple[float, float]] = deque()

    def take(self, units: float = 1.0) -> None:
        while True:
            now = self.clock()
            while self.spent and self.spent[0][0] <= now - self.span:
                self.spent.popleft()
            if not self.spent or sum(u for _, u in self.spent) + units <= self.most:
                self.spent.append((now, units))
                return
            self.sleep(self.spent[0][0] + self.span - now)


def with_retries(call: Callable, retries: int, wait_of: Callable[[Exception, int], float | None], sleep: Callable[[float], None] = time.sleep) -> Callable:
    """``call``, tried again for errors for which ``wait_of`` has a pause."""

    def run(*args):
        for attempt in range(retries + 1):
            try:
                return call(*args)
            except Exception as e:
                pause = wait_of(e, attempt)
                if pause is None or attempt == retries:
                    raise
                sleep(pause)

    return run
