"""Line dedup over levelled sorted runs of line hashes.

A *run* holds one row per line key, sorted by the key's 128-bit hash: in how
many documents the key stands and the largest of their ids. Documents arrive
in batches of descending ids, cut at quantiles of the ids. Every batch adds
its own run at level 0; ``fanout`` runs of a level are merged into one run of
the next, so a key is rewritten once per level. The batch's lines then
merge-join the runs, its own among them. As ids descend, a key's largest
document is known when the key is first seen, so a line with an earlier
document than its key's last one is

* *settled*, if the key has enough documents by now: it goes, and so does
  every line of the key in the batches to come, when it arrives;
* *pending* otherwise: its document is one of the key's ranks 2 to
  ``min_docs - 1``. Pending lines meet the runs once more after the last batch.

Lines that no run beats stay. A document's lines meet in one batch, as
batches are ranges of ids, so counts of distinct documents add up over runs.

Every batch reads the runs before it. With batches of a fixed size that would
be quadratic in the input, so their number grows with its logarithm
(``batch_count``): 4 for half a gigabyte of text, 9 for 30 GB, 21 for 100 TB.
A batch is a distributed table, so its size bounds no task's memory.

Only DataFrame operations are used. Texts are shuffled once, to meet the
places of their dropped lines; everything else moves hashes.

Defined results: a null or empty text is one empty line; keys shorter than
``min_chars`` code points are never dropped. A null id counts as the smallest.
Rows that repeat an id are one document for counting; each row keeps its own
lines, and a row's dropped places are found by its id and its text's hash.
Other columns pass through, but for any that bear the added names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, scratch_path

MIN_CHARS = 20
MIN_DOCS = 3
FANOUT = 4
BATCH_BYTES = 128 << 20   # of text: the unit of the number of batches
_QUANTILES = 64
# The white space that a key loses at both ends.
EDGE_SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWEST = -(1 << 63)


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does that for pure ASCII, at far less cost."""
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(F.translate(c, _UPPER, _UPPER.lower()))


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(EDGE_SPACE)))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def document(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST))


def batch_count(text_bytes: int) -> int:
    return 1 + math.ceil(math.log2(1 + text_bytes / BATCH_BYTES))


def batch_bounds(docs: DataFrame, text: str, id_col: str, batches: int | None = None) -> list[int]:
    """Ids at which a new batch starts, descending: a batch holds the ids up
    to its bound and above the next."""
    shares = [k / _QUANTILES for k in range(1, _QUANTILES)]
    size, ids = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)),
                         F.percentile_approx(document(id_col), shares, 1000)).first()
    batches = batches or batch_count(int(size))
    return sorted({ids[round(k * _QUANTILES / batches) - 1] for k in range(1, min(batches, _QUANTILES))}, reverse=True) if ids else []


def batch_of(bounds: list[int], id_col: str) -> Column:
    """Number of the batch of a document, 0 for the largest ids."""
    return sum(((document(id_col) <= b).cast("int") for b in bounds), F.lit(0))


def line_hashes(docs: DataFrame, text: str, id_col: str, batch: Column | int, min_chars: int) -> DataFrame:
    """``batch, doc, text_hash, place, h1, h2`` of every line whose key is long enough."""
    lines = docs.select(F.lit(batch).alias("batch"), document(id_col).alias("doc"),
                        F.xxhash64(text).alias("text_hash"),
                        F.posexplode(split_lines(F.col(text))).alias("place", "line"))
    keys = lines.select("batch", "doc", "text_hash", "place", line_key(F.col("line")).alias("key"))
    return (keys.where(F.char_length("key") >= min_chars)
            .select("batch", "doc", "text_hash", "place",
                    F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")))


class SortedRuns:
    """Runs of (h1, h2, n_docs, last_doc) by level, stored under one folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.folder = scratch_path(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.written = 0
        self._held: tuple[int, DataFrame] | None = None

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, n_docs long, last_doc long").parquet(*paths)

    def _write(self, run: DataFrame, level: int) -> None:
        path = f"{self.folder}/level{level}-{self.written}"
        self.written += 1
        run.sortWithinPartitions("h1", "h2").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(_merge(self._read(full)), level + 1)

    def arrive(self, lines: DataFrame, min_docs: int) -> DataFrame:
        """Add a batch and merge-join its lines with the runs: its lines that
        are not of their key's last document, with ``settled``."""
        self.add(lines)
        held, beaten = self._beaten(lines)
        return lines.join(held, beaten).select(*(lines[c] for c in ("doc", "text_hash", "place", "h1", "h2")),
                                               (F.col("held.n_docs") >= min_docs).alias("settled"))

    def add(self, lines: DataFrame) -> None:
        """Add a batch's own run. No later batch may hold the same documents."""
        docs_of = lines.select("h1", "h2", "doc").distinct()
        self._write(docs_of.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc").alias("last_doc")), 0)

    def entries(self) -> DataFrame:
        """All runs merged: one row per key."""
        paths = [p for level in self.levels for p in level]
        return _merge(self._read(paths)) if len(paths) > 1 else self._read(paths)

    def survivors(self, lines: DataFrame, min_docs: int) -> DataFrame:
        """Lines that the merge-anti-join with the runs leaves."""
        return lines.join(*self._beaten(lines, min_docs), "left_anti")

    def dropped(self, lines: DataFrame, min_docs: int) -> DataFrame:
        """The other side of ``survivors``: the lines that it takes away."""
        return lines.join(*self._beaten(lines, min_docs), "left_semi")

    def _beaten(self, lines: DataFrame, min_docs: int = 2):
        # A key of one document beats no line. Written out, so that the join
        # shuffles both sides anew and Spark may split a hot key.
        if self._held is None or self._held[0] != self.written:
            self._held = self.written, materialise(self.entries().where(F.col("n_docs") > 1), "line-runs-held")
        held = self._held[1].where(F.col("n_docs") >= min_docs).alias("held")
        return held, ((lines["h1"] == F.col("held.h1")) & (lines["h2"] == F.col("held.h2"))
                      & (lines["doc"] < F.col("held.last_doc")))


def _merge(runs: DataFrame) -> DataFrame:
    return runs.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))


def beaten_lines(docs: DataFrame, text: str, id_col: str, min_chars: int, min_docs: int,
                 batches: int | None, runs: SortedRuns) -> DataFrame:
    """``doc, text_hash, place`` of every line that goes, batch by batch."""
    spark = docs.sparkSession
    bounds = batch_bounds(docs, text, id_col, batches)
    path, beaten = scratch_path(spark, "line-hashes"), scratch_path(spark, "lines-beaten")
    line_hashes(docs, text, id_col, batch_of(bounds, id_col), min_chars).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("doc long, text_hash long, place int, h1 long, h2 long, batch int").parquet(path)
    for b in range(len(bounds) + 1):
        runs.arrive(lines.where(F.col("batch") == b), min_docs).write.parquet(f"{beaten}/batch={b}")
    known = spark.read.schema("doc long, text_hash long, place int, h1 long, h2 long, settled boolean, batch int").parquet(beaten)
    places = known.where("settled").select("doc", "text_hash", "place")
    if bounds and min_docs > 2:
        late = runs.dropped(known.where(~F.col("settled") & (F.col("batch") < len(bounds))), min_docs)
        places = places.unionByName(late.select("doc", "text_hash", "place"))
    return places


def dedup_lines(docs: DataFrame, text: str = "text", id_col: str = "doc_id", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS, batches: int | None = None, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped`` added."""
    places = beaten_lines(docs, text, id_col, min_chars, min_docs, batches, SortedRuns(docs.sparkSession, fanout))
    # Names that no column of the documents can have.
    doc, text_hash, dropped = (f"{n}_{uuid.uuid4().hex}" for n in ("doc", "text_hash", "dropped"))
    gone = (places.groupBy(F.col("doc").alias(doc), F.col("text_hash").alias(text_hash))
            .agg(F.collect_set("place").alias(dropped)))
    own = F.coalesce(docs[id_col].cast("long"), F.lit(_LOWEST))
    joined = docs.join(gone, (own == gone[doc]) & (F.xxhash64(docs[text]) == gone[text_hash]), "left")
    all_lines = split_lines(docs[text])
    places = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col(dropped))
    kept = F.when(F.col(dropped).isNull(), F.coalesce(docs[text], F.lit(""))).otherwise(
        F.array_join(F.transform(places, lambda i: F.get(all_lines, i)), "\n"))
    own_columns = [docs[c] for c in docs.columns if c not in ("kept_text", "n_lines", "n_dropped")]
    return joined.select(*own_columns, kept.alias("kept_text"),
                         F.size(all_lines).cast("long").alias("n_lines"),
                         F.greatest(F.size(dropped), F.lit(0)).cast("long").alias("n_dropped"))
