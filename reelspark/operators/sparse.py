"""Thresholded cosine of sparse vectors over an inverted index of their places.

Places are ordered by how many vectors have them, rarest first. A vector's
prefix ends as soon as the norm of the rest falls below the threshold: two unit
vectors that share no place of both prefixes share places only within the rest
of the one whose prefix ends first, and their cosine cannot exceed that norm.
So it is complete to compare the vectors listed under each prefix place, and a
pair is reported by the first place that both have.

The list of a place is dealt to blocks by a hash of the id and compared block
pair by block pair, so a place that a third of all vectors have forms many
bounded groups; pairs leave a group only above the threshold. The driver holds
one count per place, so the width of the vectors bounds it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.operators.similarity import (BLOCK_BYTES, DEFAULT_BLOCK_SIZE, GROUPS_PER_SLOT, MAX_BLOCK, MIN_BLOCK,
                                            block_pairs_fn, cosine_pairs, pair_schema, unit_vectors)
from reelspark.session import checkpoint_dir

BOUND_MARGIN = 1e-9


def _prefixes(order: np.ndarray, threshold: float):
    """Vectors in the order of places, with the places of their prefix."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                m = np.vstack(f["u"].to_numpy())[:, order]
                finite = np.isfinite(m).all(axis=1)  # others pair with nothing
                f, m = f[finite], m[finite]
                if not len(f):
                    continue
                # rest[k]: norm of places k and later
                rest = np.sqrt(np.cumsum((m * m)[:, ::-1], axis=1))[:, ::-1]
                listed = (m != 0) & (rest >= threshold - BOUND_MARGIN)
                yield pd.DataFrame({"id": f["id"], "u": list(m),
                                    "places": [np.flatnonzero(r).astype(np.int32) for r in listed]})
    return run


def prefix_index(vectors: DataFrame, id_col: str, vec_col: str, threshold: float) -> tuple[DataFrame, int]:
    """``id, u, places``: unit vectors (rarest place first), and their prefix
    places; and the vectors' width.

    The unit vectors are written out, as the counts of the places, the counts
    of the lists and the comparison all read them.
    """
    checkpoint_dir(vectors.sparkSession)
    units = unit_vectors(vectors, id_col, vec_col).checkpoint()
    held = (units.select(F.posexplode("u").alias("place", "w"))
            .groupBy("place").agg(F.count(F.when(F.col("w") != 0, 1)).alias("n")).collect())
    order = np.array([r["place"] for r in sorted(held, key=lambda r: (r["n"], r["place"]))], np.int64)
    schema = T.StructType([units.schema["id"], T.StructField("u", T.ArrayType(T.DoubleType())),
                           T.StructField("places", T.ArrayType(T.IntegerType()))])
    return units.mapInPandas(_prefixes(order, threshold), schema), len(order)


def list_sizes(index: DataFrame) -> dict[int, int]:
    """Vectors listed under each prefix place."""
    return {r["place"]: r["n"] for r in index.select(F.explode("places").alias("place"))
            .groupBy("place").agg(F.count("*").alias("n")).collect()}


def candidates(sizes: dict[int, int]) -> int:
    """Pairs that are compared; one that shares several prefix places counts for each."""
    return sum(n * (n - 1) // 2 for n in sizes.values())


def sparse_cosine_pairs(vectors: DataFrame, id_col: str, vec_col: str, threshold: float,
                        block_size: int | None = DEFAULT_BLOCK_SIZE, include_self: bool = False,
                        both_directions: bool = True) -> DataFrame:
    """The rows of ``cosine_pairs``, found by shared places.

    A negative threshold lets vectors without a common place pair, so it goes
    to the dense form.
    """
    if threshold < 0:
        return cosine_pairs(vectors, id_col, vec_col, threshold, block_size, include_self, both_directions)
    spark = vectors.sparkSession
    index, width = prefix_index(vectors, id_col, vec_col, threshold)
    sizes = list_sizes(index)
    slots = GROUPS_PER_SLOT * max(1, spark.sparkContext.defaultParallelism)
    block = block_size or min(MAX_BLOCK, max(1, BLOCK_BYTES // (8 * max(1, width))),
                              max(MIN_BLOCK, math.ceil(math.sqrt((candidates(sizes) + 1) / slots))))
    parts = {place: math.ceil(n / block) for place, n in sizes.items()}
    groups = sum(p * (p + 1) // 2 for p in parts.values())
    counts = spark.createDataFrame(list(parts.items()), "place int, parts int")
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    routed = (index.select("id", "u", F.explode("places").alias("place")).join(counts, "place")
              .select("id", "u", "place", own.alias("blk"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
              .withColumn("lo", F.least("blk", "other"))
              .withColumn("hi", F.greatest("blk", "other"))
              .select("lo", "hi", "place", "blk", "id", "u"))
    # Of fixed count, as in cosine_pairs; small lists share a task.
    tasks = max(1, min(groups, max(slots, groups // 8)))
    return (routed.repartition(tasks, "lo", "hi", "place").groupBy("lo", "hi", "place")
            .applyInPandas(block_pairs_fn(float(threshold), include_self, both_directions, by_place=True),
                           schema=pair_schema(index.schema["id"].dataType)))
