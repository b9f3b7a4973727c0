"""Control of a running replication."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from ..plans.store import Files
from .apply import Applier, start
from .offsets import OffsetStore, patch_binlog, patch_lsn


class Replicator:
    """start, stop, restart, status and positions of one change log.

    source(position) makes the stream of events; position is the stored offset's JSON, or None.
    """

    def __init__(self, source: Callable[[str | None], DataFrame], applier: Applier, home: str, name: str = "replication"):
        self.source, self.applier, self.home, self.name, self.query = source, applier, home.rstrip("/"), name, None
        self.spark = applier.warehouse.spark
        self.offsets = OffsetStore(self.spark, f"{self.home}/offsets")
        self.generation = 0
        if applier.settings.autostart:
            self.start()

    @property
    def running(self) -> bool:
        return self.query is not None and self.query.isActive

    def start(self) -> None:
        if not self.running:
            self.query = start(self.source(self.offsets.get(self.name)), self.applier, f"{self.home}/checkpoint-{self.generation}")

    def stop(self) -> None:
        if self.query is not None:
            self.query.stop()
            self.query = None

    def restart(self) -> None:
        self.stop()
        self.start()

    def caught_up(self) -> None:
        """Wait until all that has arrived is applied."""
        self.query.processAllAvailable()

    def status(self) -> dict[str, object]:
        last = self.query.lastProgress if self.query is not None else None
        problem = self.query.exception() if self.query is not None else None
        return {"running": self.running, "batch": last and last["batchId"], "rows": last and last["numInputRows"], "error": problem and str(problem), "failed_ddl": list(self.applier.failed)}

    def set_position(self, file: str | None = None, pos: str | None = None, gtids: str | None = None, lsn: str | None = None) -> None:
        """Change where to read from; only while stopped. The checkpoint begins anew."""
        if self.running:
            raise RuntimeError("stop the replication first")
        old = self.offsets.get(self.name)
        now = time.time_ns()
        self.offsets.put(self.name, patch_lsn(old, lsn) if lsn else patch_binlog(old, file, pos, gtids, now // 10**9), now)
        self.generation += 1

    def reset_offsets(self) -> None:
        if self.running:
            raise RuntimeError("stop the replication first")
        self.offsets.delete(self.name, time.time_ns())
        Files(self.spark).delete(f"{self.home}/checkpoint-{self.generation}")
        self.generation += 1

    def supervise(self, idle_s: float, checks: int, retries: int = 25) -> int:
        """Restart a query that failed, or that made no progress for idle_s; returns how often it did."""
        restarts, seen, since = 0, None, time.monotonic()
        for _ in range(checks):
            time.sleep(min(1.0, idle_s))
            batch = self.status()["batch"]
            if batch != seen:
                seen, since = batch, time.monotonic()
            if restarts < retries and (not self.running or time.monotonic() - since > idle_s):
                self.restart()
                restarts, since = restarts + 1, time.monotonic()
        return restarts
