"""Log of the ratings that a stream has taken in, compacted in levels.

Every micro-batch writes its ratings to ``<path>/batch_id=N``. As soon as
``fanout`` runs of one level are there, they become one run of the next level,
sorted by user, so the runs that a reader opens stay below ``fanout`` per level
and their number grows with the logarithm of the batches. Compacted runs lie
under ``<path>/_runs``.

Which runs count is said by the manifest that each batch writes last:
``<path>/_manifest/batch_id=N``, made from the manifest before it and the
batch alone. A replay of a batch starts from the same manifest, writes the
same runs over its own first attempt and gives the same manifest, also when
the batch now has other rows or none. Runs and manifests that neither this
batch nor the one before it names are removed.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from reelspark.sources.files import child_folders, read_small, remove_folder, write_small

HISTORY = "event_id long, uid int, mid int, score double, timestamp int"
FANOUT = 8
FILE_ROWS = 4_000_000


class Run(NamedTuple):
    level: int
    first: int
    last: int
    rows: int

    @property
    def folder(self) -> str:
        return f"batch_id={self.first}" if self.level == 0 else f"_runs/L{self.level}-{self.first}-{self.last}"


class HistoryLog:
    def __init__(self, spark: SparkSession, path: str, fanout: int = FANOUT, file_rows: int = FILE_ROWS):
        self.spark, self.path, self.fanout, self.file_rows = spark, path.rstrip("/"), fanout, file_rows

    def runs(self, before: int | None = None) -> list[Run]:
        """Runs of the newest manifest, of batches before ``before`` if given."""
        manifests = self._manifests()
        known = [b for b in manifests if before is None or b < before]
        if not known:
            return []
        named = json.loads(read_small(self.spark, f"{self.path}/_manifest/{manifests[max(known)]}/runs.json"))
        return sorted(Run(*r) for r in named)

    def _manifests(self) -> dict[int, str]:
        return {int(f.split("=")[1]): f for f in child_folders(self.spark, f"{self.path}/_manifest")}

    def rows(self, before: int | None = None) -> DataFrame:
        """The ratings of all batches (before ``before``), each once."""
        return self._read(self.runs(before))

    def _read(self, runs: list[Run]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], HISTORY)
        return self.spark.read.schema(HISTORY).parquet(*[f"{self.path}/{r.folder}" for r in runs])

    def _write(self, df: DataFrame, run: Run) -> None:
        files = max(1, -(-run.rows // self.file_rows))
        spread = df.repartitionByRange(files, "uid", "timestamp", "event_id") if files > 1 else df.coalesce(1)
        (spread.sortWithinPartitions("uid", "timestamp", "event_id").write.mode("overwrite")
         .parquet(f"{self.path}/{run.folder}"))

    def append(self, batch_id: int, ratings: DataFrame) -> list[Run]:
        """Add the ratings of a batch; a replay replaces its first attempt."""
        before = self.runs(before=batch_id)
        new = Run(0, batch_id, batch_id, ratings.count())
        if new.rows:
            self._write(ratings.select("event_id", "uid", "mid", "score", "timestamp"), new)
        runs = [*before, new] if new.rows else before
        level = 0
        while len(full := [r for r in runs if r.level == level]) >= self.fanout:
            merged = Run(level + 1, min(r.first for r in full), max(r.last for r in full), sum(r.rows for r in full))
            self._write(self._read(full), merged)
            runs = [r for r in runs if r.level != level] + [merged]
            level += 1
        write_small(self.spark, f"{self.path}/_manifest/batch_id={batch_id}/runs.json", json.dumps(sorted(runs)))
        self._remove_unnamed(batch_id, {r.folder for r in [*runs, *before, *([new] if new.rows else [])]})
        return sorted(runs)

    def _remove_unnamed(self, batch_id: int, named: set[str]) -> None:
        """Remove what no replay can need: Structured Streaming runs only the
        last batch again, which starts from the manifest before it."""
        manifests = self._manifests()
        if max(manifests) > batch_id:
            return  # an old batch run again: newer manifests decide
        earlier = sorted(b for b in manifests if b < batch_id)
        for b in earlier[:-1]:
            remove_folder(self.spark, f"{self.path}/_manifest/{manifests[b]}")
        for folder in [f for f in child_folders(self.spark, self.path) if f.startswith("batch_id=")]:
            if folder not in named:
                remove_folder(self.spark, f"{self.path}/{folder}")
        for folder in child_folders(self.spark, f"{self.path}/_runs"):
            if f"_runs/{folder}" not in named:
                remove_folder(self.spark, f"{self.path}/_runs/{folder}")
