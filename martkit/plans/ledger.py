"""A ledger of finished steps, so that a restarted run goes on where it stopped.

An entry is a small file, created once the step's result is known to be stored:
``<folder>/<step>/0000000001.json`` with the digest of what was stored.  The
newest entry that was written to its end counts.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from martkit.sources.smallfiles import Folder


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self._folder = Folder(spark, path)

    def last(self, step: str) -> dict | None:
        """The newest entry of a step."""
        for name in reversed(self._folder.names(step)):
            try:
                entry = json.loads(self._folder.read(f"{step}/{name}") or "")
            except ValueError:  # not written to its end
                continue
            if entry.get("complete"):
                return entry
        return None

    def record(self, step: str, **told: object) -> None:
        entry = json.dumps({"step": step, "at": time.time(), **told, "complete": True})
        taken = [int(n.split(".")[0]) for n in self._folder.names(step) if n.endswith(".json")]
        number = max(taken, default=0) + 1
        while not self._folder.create(f"{step}/{number:010d}.json", entry):
            number += 1

    def once(self, step: str, action: Callable[[], object]) -> bool:
        """Run ``action`` unless the step is recorded; whether it ran."""
        if self.last(step) is not None:
            return False
        action()
        self.record(step)
        return True
