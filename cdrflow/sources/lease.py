"""One run at a time on a warehouse: a lease with an expiry on the shared file system.

Each lease is a numbered file, created exclusively, so of runs that start
together one gets it.  Its expiry is in the names of further files, so nothing
is ever rewritten; a heartbeat thread adds a later one while the run goes on.  A lease
whose run was lost is taken over, by the next number, once it has expired, and
a run that finds a higher number than its own stops before it writes.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from cdrflow.sources import shared_fs as FS


class RunInProgress(RuntimeError):
    """Another run holds the lease."""


class LeaseLost(RuntimeError):
    """The lease expired and another run took it over."""


class RunLease:
    """``with RunLease(spark, folder): ...``; raises RunInProgress where another run holds it."""

    def __init__(self, spark: SparkSession, folder: str, seconds: float = 900, owner: str = "",
                 clock: Callable[[], float] = time.time):
        self.spark, self.folder, self.seconds, self.owner, self.clock = spark, folder, seconds, owner, clock
        self.number: int | None = None
        self._stop = threading.Event()
        self._beat: threading.Thread | None = None

    def _state(self) -> tuple[int, bool, int]:
        """The highest number, whether it was released, and when it expires (ms)."""
        found = FS.names(self.spark, self.folder)
        number = max((int(n[1:13]) for n in found if n.startswith("g")), default=-1)
        if number < 0:
            return -1, True, 0
        mine = [n for n in found if n.startswith(f"g{number:012d}")]
        until = [int(n.rsplit(".", 1)[1]) for n in mine if ".until." in n]
        if not until:  # created a moment ago
            created = FS.modified_ms(self.spark, f"{self.folder}/g{number:012d}") or 0
            until = [created + int(1000 * self.seconds)]
        return number, any(n.endswith(".done") for n in mine), max(until)

    def acquire(self) -> RunLease:
        number, done, until = self._state()
        if not done and until > 1000 * self.clock():
            raise RunInProgress(f"another run holds {self.folder} until {until} ms")
        if not FS.create_exclusive(self.spark, f"{self.folder}/g{number + 1:012d}", self.owner):
            raise RunInProgress(f"another run has just taken {self.folder}")
        self.number = number + 1
        self.renew()
        for n in FS.names(self.spark, self.folder):  # the newest number always stays
            if n.startswith("g") and int(n[1:13]) < self.number:
                FS.delete_path(self.spark, f"{self.folder}/{n}")
        return self

    def renew(self) -> None:
        until = int(1000 * (self.clock() + self.seconds))
        FS.create_exclusive(self.spark, f"{self.folder}/g{self.number:012d}.until.{until}")

    def check(self) -> None:
        """Raises LeaseLost if another run has taken over; called before each lasting write."""
        if self._state()[0] != self.number:
            raise LeaseLost(f"another run has taken over {self.folder}")

    def release(self) -> None:
        FS.create_exclusive(self.spark, f"{self.folder}/g{self.number:012d}.done")

    def __enter__(self) -> RunLease:
        self.acquire()

        def beat() -> None:
            while not self._stop.wait(self.seconds / 3):
                self.renew()

        self._beat = threading.Thread(target=beat, daemon=True)
        self._beat.start()
        return self

    def __exit__(self, *_) -> None:
        self._stop.set()
        self._beat.join()
        self.release()
