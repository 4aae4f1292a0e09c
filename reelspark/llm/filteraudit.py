"""Interaction of quality filters in every order of application.

Every row gets a row id; ids of one input split follow one another, so an id
range of ``RANGE`` ids is a run of neighbouring rows. For each part and range
there is one sorted posting list per filter with the ids of the rows that fail
it, and one per label. All counts follow from sizes of differences
``filter minus the union of earlier filters``. They are computed by merging
the lists: the shorter list gallops through the longer one, and the rows that
are left of one set of earlier filters start the next larger set. Ranges are
independent, so a part that holds most rows is many ranges, and only sizes are
added up: per part, filter and set of earlier filters.

A filter is a condition that is true for rows that fail it. ``DUPLICATE``
stands for "same text as a row of smaller id", which takes a grouping of text
hashes (128 bits); texts themselves are never shuffled. Text hashes that hold
more than one row in ``HOT_SHARE`` are at most ``HOT_SHARE`` and meet their
rows by a broadcast, so no join key holds many rows.

Defined results: a null text is the empty text, a null part the empty string.
Rows that repeat an id count each and are no duplicates of each other; a null
id is neither a duplicate nor smaller than another, and has no label. Label
rows that repeat an id count once, as a positive if one of them is. An empty
table has no part and no row. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

RANGE = 1 << 14
HOT_SHARE = 1000
DUPLICATE = "duplicate"
SPACES = r"[ \t-\r]+"


def quality_filters(text: Column) -> dict[str, Column | str]:
    """The five failure conditions, by their letters."""
    words = F.array_remove(F.split(text, SPACES), "")
    n = F.size(words)
    return {
        "A": n < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
        "E": DUPLICATE,
    }


def _duplicates(rows: DataFrame) -> DataFrame:
    """``part, rid`` of the rows whose text a row of smaller id has."""
    groups = rows.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.count("*").alias("size"))
    groups = materialise(groups.where("size > 1 AND first IS NOT NULL"), "text-groups")
    bound = max(2, rows.count() // HOT_SHARE)
    hot = groups.where(F.col("size") > bound).select("h1", "h2", "first", F.lit(True).alias("hot"))  # at most HOT_SHARE rows
    cold = groups.where(F.col("size") <= bound).select("h1", "h2", "first")
    met = rows.select("part", "rid", "id", "h1", "h2").join(F.broadcast(hot), ["h1", "h2"], "left")
    by_hot = met.where(F.col("hot") & (F.col("id") > F.col("first"))).select("part", "rid")
    by_cold = met.where("hot IS NULL").drop("hot", "first").join(cold, ["h1", "h2"]).where(F.col("id") > F.col("first"))
    return by_hot.unionByName(by_cold.select("part", "rid"))


def list_entries(docs: DataFrame, labels: DataFrame, filters=quality_filters, text: str = "text",
                 part: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """``part, rid, list``: every row once with list -1, and once per list that holds it.

    Lists 0 to f - 1 are the filters, f is label quality, f + 1 label toxic.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole.alias("text"))
    conditions = list(filters(F.col("text")).values())
    fails = [F.when(c, F.lit(k)) for k, c in enumerate(conditions) if not isinstance(c, str)]
    rows = named.select("id", "part", F.monotonically_increasing_id().alias("rid"), F.xxhash64("text").alias("h1"),
                        F.xxhash64(F.lit(1), "text").alias("h2"), F.array_compact(F.array(F.lit(-1), *fails)).alias("lists"))
    rows = materialise(rows, "filter-facts")
    entries = rows.select("part", "rid", F.explode("lists").alias("list"))
    for k, c in enumerate(conditions):
        if isinstance(c, str):
            entries = entries.unionByName(_duplicates(rows).withColumn("list", F.lit(k)))
    f = len(conditions)
    marks = [F.when(F.max(F.col(c) == 1), F.lit(f + k)) for k, c in enumerate(("quality", "toxic"))]
    marked = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
              .agg(F.array_compact(F.array(*marks)).alias("lists")).where(F.size("lists") > 0))
    marked = rows.select("id", "part", "rid").join(marked, "id")
    return entries.unionByName(marked.select("part", "rid", F.explode("lists").alias("list")))


def posting_lists(entries: DataFrame, n_lists: int) -> DataFrame:
    """``part, id_range, n, list_0, list_1, ...``: rows and sorted ids per list."""
    lists = [F.sort_array(F.collect_list(F.when(F.col("list") == k, F.col("rid")))).alias(f"list_{k}") for k in range(n_lists)]
    return (entries.groupBy("part", F.floor(F.col("rid") / RANGE).alias("id_range"))
            .agg(F.count_if(F.col("list") == -1).alias("n"), *lists))


def minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ids of sorted ``a`` that are not in sorted ``b``: the shorter list is
    sought in the part of the longer one that it can lie in."""
    if not len(a) or not len(b) or a[-1] < b[0] or b[-1] < a[0]:
        return a
    if len(a) <= len(b):
        at = np.searchsorted(b, a)
        return a[b[np.minimum(at, len(b) - 1)] != a]
    at = np.searchsorted(a, b)
    at = at[a[np.minimum(at, len(a) - 1)] == b]
    return np.delete(a, at)


def common(a: np.ndarray, b: np.ndarray) -> int:
    return len(a) - len(minus(a, b))


def _differences(f: int):
    """Sizes of every filter's list minus every union of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for r in range(batch.num_rows):
                part, n = batch.column(0)[r].as_py(), batch.column(1)[r].as_py()
                lists = [np.asarray(batch.column(2 + k)[r].values) for k in range(f + 2)]
                for k in range(f):
                    stack = [(lists[k], 0, 0)]
                    while stack:
                        left, earlier, after = stack.pop()
                        for column, value in zip(out, (part, n, k, earlier, len(left), common(left, lists[f]), common(left, lists[f + 1]))):
                            column.append(value)
                        stack += [(minus(left, lists[g]), earlier | 1 << g, g + 1) for g in range(after, f) if g != k]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), *(pa.array(c, pa.int64()) for c in out[1:])],
                ["part", "n", "filter", "earlier", "removed", "good_lost", "toxic_lost"])
    return run


def differences(postings: DataFrame, f: int) -> DataFrame:
    """``part, filter, earlier`` (bits of the filters before) with ``n, removed,
    good_lost, toxic_lost``, zeros included."""
    parts = postings.select("part", "n", *[f"list_{k}" for k in range(f + 2)]).mapInArrow(
        _differences(f), "part string, n long, filter long, earlier long, removed long, good_lost long, toxic_lost long")
    return parts.groupBy("part", "filter", "earlier").agg(*[F.sum(c).alias(c) for c in ("n", "removed", "good_lost", "toxic_lost")])


def _steps(spark, letters: list[str]) -> DataFrame:
    """All orders, step by step: (number of filters)! times that many rows."""
    out = []
    for order in permutations(range(len(letters))):
        earlier, name = 0, "".join(letters[k] for k in order)
        for step, k in enumerate(order, 1):
            out.append((name, step, k, earlier))
            earlier |= 1 << k
    return spark.createDataFrame(out, "filter_order string, step int, filter long, earlier long")


def audit(docs: DataFrame, labels: DataFrame, filters=quality_filters, text: str = "text",
          part: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """Per part, order and step: ``kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley``."""
    letters = list(filters(F.col(text)))
    f = len(letters)
    if f > 6:
        raise ValueError("more than six filters have too many orders to list")
    entries = list_entries(docs, labels, filters, text, part, id_col)
    sizes = materialise(differences(posting_lists(entries, f + 2), f), "filter-sizes")
    per_filter = sizes.groupBy("part", "filter").agg(
        F.max(F.when(F.col("earlier") == 0, F.col("removed"))).alias("fails"),
        F.min("removed").alias("unique_fails"),
        F.sum(F.col("removed") * _orders_with(F.bit_count("earlier"), f)).alias("shapley"))
    rows = sizes.join(per_filter, ["part", "filter"]).join(F.broadcast(_steps(docs.sparkSession, letters)), ["filter", "earlier"])
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    return rows.select("part", "filter_order", "step", (F.col("n") - F.sum("removed").over(so_far)).alias("kept"), "removed",
                       (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley")


def _orders_with(before: Column, f: int) -> Column:
    """Number of orders in which exactly a given set of ``before`` filters precedes a filter."""
    out = F.lit(None).cast("long")
    for k in range(f):
        out = F.when(before == k, F.lit(factorial(k) * factorial(f - 1 - k))).otherwise(out)
    return out
