"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder of this application."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it reread.

    Cuts the lineage on storage that outlives executors, so a lost executor
    never makes an earlier step run again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_bucket(id_col: str | Column, n: int) -> Column:
    """crc32 of the id's text modulo ``n``; a null id counts as the empty text."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def row_fraction(bound: int, total: int) -> float:
    """Share of ``total`` rows that keeps about ``bound`` of them."""
    return 1.0 if total <= bound else bound / total


def hashed_share(id_col: str | Column, share: Column | float, salt: str) -> Column:
    """True for about ``share`` of the ids, the same ids in every run."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    u = F.pmod(F.xxhash64(F.lit(salt), c), F.lit(1 << 30)) / float(1 << 30)
    return u < share


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as the Python worker process.

    Spark reuses workers between tasks, so look-ups that one task paid for
    serve the next; callers bound the size themselves.
    """
    module = sys.modules.get("reelspark_llm_worker")
    if module is None:
        module = sys.modules["reelspark_llm_worker"] = types.ModuleType("reelspark_llm_worker")
        module.stores = {}
    return module.stores.setdefault(name, {})


class TwoGenerations:
    """A cache of at most twice ``size`` entries. When the young generation is
    full it becomes the old one, so entries that are asked for again stay."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value

    def __len__(self) -> int:
        return len(self.young) + len(self.old)


def slices(values: list, max_chars: int = 4 << 20):
    """Cut a list of texts (None allowed) into runs of about ``max_chars``."""
    run: list = []
    size = 0
    for v in values:
        run.append(v)
        size += len(v) if v is not None else 0
        if size >= max_chars:
            yield run
            run, size = [], 0
    if run:
        yield run
