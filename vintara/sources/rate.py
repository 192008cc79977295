"""One rate of requests for a whole job, though its tasks don't know of each other.

Time is a grid of slots as wide as the limit allows, counted from the epoch. Of ``of`` tasks the
``number``-th holds the slots that leave that remainder, so no two tasks share a slot: the limit
holds for any number of tasks, and a task that is run again takes up the slots of the lost one.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable


class Lease:
    """The slots of one task; ``wait`` sleeps until its next one and takes it."""

    def __init__(self, number: int, of: int, per_minute: float, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        if not 0 <= number < of or per_minute <= 0:
            raise ValueError("0 <= number < of and a rate above zero are needed")
        self.number, self.of, self.width, self.clock, self.sleep, self.last = number, of, 60.0 / per_minute, clock, sleep, -1

    def wait(self) -> int:
        """The slot that was waited for."""
        now = self.clock()
        slot = max(math.ceil(now / self.width), self.last + 1)
        slot += (self.number - slot) % self.of
        if slot * self.width > now:
            self.sleep(slot * self.width - now)
        self.last = slot
        return slot


def leased(call: Callable[[str], str], number: int, of: int, per_minute: float | None) -> Callable[[str], str]:
    """``call`` within the rate; as it is where there is none."""
    if per_minute is None:
        return call
    lease = Lease(number, of, per_minute)

    def run(k: str) -> str:
        lease.wait()
        return call(k)

    return run
