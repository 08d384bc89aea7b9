"""Ledger of a job's stages: what is committed is not done again.

A stage's record (run, stage, version of its input, output, counts, seconds) is put in place by one
rename after its output is committed. A run that is repeated skips the stages whose record has the
same input version and goes on with the first that has none; the version of a stage's input
is a digest of the job's settings and of the record before, so a stage whose input was made
anew is made anew too. Outputs belong to (run, stage) and are overwritten, never added to.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from ledgerlake import files


@dataclass(frozen=True)
class Record:
    run_id: str
    stage: str
    input_version: str
    output: str
    counts: dict[str, int]
    seconds: float
    attempt: int

    def version(self) -> str:
        """Of the stage's output: it changes whenever the stage is done again."""
        return _digest(asdict(self))


def _digest(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True).encode()).hexdigest()


class Ledger:
    """Stages of one run, in order. ``hook(stage, moment)`` is called when a stage's output is
    ``written`` and when its record is ``committed`` (tests let it fail there)."""

    def __init__(self, spark: SparkSession, folder: str, run_id: str, settings: dict, hook: Callable[[str, str], None] | None = None):
        self.spark, self.folder, self.run_id, self.hook = spark, f"{folder}/{run_id}", run_id, hook or (lambda stage, moment: None)
        self.input_version = _digest(settings)
        self.records: list[Record] = []

    def _read(self, name: str) -> dict | None:
        text = files.read_text(self.spark, f"{self.folder}/{name}.json")
        return json.loads(text) if text else None

    def stage(self, name: str, output: str, work: Callable[[], dict[str, int]]) -> Record:
        """Do ``work`` (it writes ``output`` and returns counts) unless it is on record."""
        old = self._read(name)
        if old and old["input_version"] == self.input_version:
            record = Record(**old)
        else:
            # The number of attempts is on record before the work, so that a stage that fails is seen to have run.
            tries = ((self._read(f"{name}.attempts") or {}).get("n") or 0) + 1
            files.put_text(self.spark, f"{self.folder}/{name}.attempts.json", json.dumps({"n": tries}), replace=True)
            began = time.perf_counter()
            counts = work()
            self.hook(name, "written")
            record = Record(self.run_id, name, self.input_version, output, {k: int(v) for k, v in counts.items()}, time.perf_counter() - began, tries)
            files.put_text(self.spark, f"{self.folder}/{name}.json", json.dumps(asdict(record), sort_keys=True), replace=True)
            self.hook(name, "committed")
        self.records.append(record)
        self.input_version = record.version()
        return record
