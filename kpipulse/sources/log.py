"""A commit log on any Hadoop file system: numbered one-line JSON records.

``append`` creates the next record without overwriting, so of two writers one
fails. A hint file names the newest record; a reader starts there and steps
forward, so reading costs the same however long the log is. Old records are
removed in passing (``keep``): a record holds a whole state, not a change.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from . import files as FS

HINT = "_last"


class CommitLog:
    def __init__(self, spark: SparkSession, path: str, keep: int = 50):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep

    def _name(self, n: int) -> str:
        return f"{self.path}/{n:012d}.json"

    def get(self, n: int) -> dict | None:
        text = FS.read_text(self.spark, self._name(n))
        return None if text is None else json.loads(text)

    def last(self) -> tuple[int, dict] | None:
        """Number and content of the newest record, or None."""
        hint = FS.read_text(self.spark, f"{self.path}/{HINT}")
        n = int(hint) if hint and hint.strip().isdigit() else None
        found = None if n is None else self.get(n)
        if found is None:  # no hint, or one that a crash has left behind
            numbers = [int(f[:-5]) for f in FS.child_files(self.spark, self.path) if f.endswith(".json")]
            if not numbers:
                return None
            n = max(numbers)
            found = self.get(n)
        while FS.exists(self.spark, self._name(n + 1)):
            n += 1
            found = self.get(n)
        return n, found

    def append(self, n: int, body: dict) -> None:
        """Write record ``n``; an error if it is there already."""
        FS.write_text(self.spark, self._name(n), json.dumps(body), overwrite=False)
        FS.write_text(self.spark, f"{self.path}/{HINT}", str(n))
        if n >= self.keep:
            FS.delete(self.spark, self._name(n - self.keep))
