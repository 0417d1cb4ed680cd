"""Results that are asked for again: persisted under a key, for a time, and for so many keys.

A lookup by time repeats within minutes, so keys have times by the minute.  What is kept are persisted DataFrames: the
rows stay with the executors, the driver has the keys only, and a lost executor's part is computed again.
"""

from __future__ import annotations

import time
from collections import OrderedDict
from collections.abc import Callable, Hashable
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame

SECONDS = 300
ENTRIES = 64


def minute(at: datetime, minutes: int = 1) -> datetime:
    """The beginning of the minute, or of the so many minutes of the hour, that holds a time."""
    return at.replace(minute=at.minute // minutes * minutes, second=0, microsecond=0)


class ResultCache:
    """Persisted results by key; the one that was used longest ago goes where there are too many."""

    def __init__(self, seconds: float = SECONDS, entries: int = ENTRIES, minutes: int = 1, clock: Callable[[], float] = time.monotonic):
        self.seconds, self.entries, self.minutes, self.clock = seconds, entries, minutes, clock
        self.held: OrderedDict[Hashable, tuple[float, DataFrame]] = OrderedDict()
        self.hits = self.misses = 0

    def get(self, key: Hashable, make: Callable[[], DataFrame]) -> DataFrame:
        """The result under the key, made and persisted where there is none that is young enough."""
        self.expire()
        if key in self.held:
            self.hits += 1
            self.held.move_to_end(key)
            return self.held[key][1]
        self.misses += 1
        made = make().persist(StorageLevel.MEMORY_AND_DISK)
        self.held[key] = (self.clock() + self.seconds, made)
        while len(self.held) > self.entries:
            self.drop(next(iter(self.held)))
        return made

    def at(self, at: datetime, *parameters: Hashable, make: Callable[[], DataFrame]) -> DataFrame:
        """The result for a time, by the minute, and other parameters."""
        return self.get((minute(at, self.minutes), *parameters), make)

    def expire(self) -> None:
        now = self.clock()
        for key in [k for k, (until, _) in self.held.items() if until <= now]:
            self.drop(key)

    def drop(self, key: Hashable) -> None:
        self.held.pop(key)[1].unpersist()

    def clear(self) -> None:
        for key in list(self.held):
            self.drop(key)

    def __enter__(self) -> ResultCache:
        return self

    def __exit__(self, *_) -> None:
        self.clear()
