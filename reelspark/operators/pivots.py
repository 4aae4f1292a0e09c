"""Pivot blocks for thresholded cosine: block pairs that cannot hold a pair are skipped.

The angle between unit vectors is a metric, so for vectors ``x``, ``y`` and a
pivot ``p``: ``angle(x, y) >= |angle(x, p) - angle(y, p)|``. Vectors go to the
cell of their nearest pivot; a cell keeps the smallest and largest angle of its
members to every pivot. A vector needs a cell only if, for every pivot, its own
angle lies within the threshold's angle of the cell's interval. Cells larger
than a block are dealt to several blocks by a hash of the id, so a cell with a
third of all vectors is no larger group than any other.

The pivots come from a bounded sample (``SAMPLE`` rows, spread by farthest-first
choice) and change the cost alone: the bounds are measured over all vectors and
are exact for any pivots. Where the sample says that pivots skip little (angles
in high dimensions without clusters are all alike), ``choose`` returns None and
the caller deals its blocks by hash; the rows are the same.

The driver holds the sample, the pivots and one interval per (cell, pivot): at
most ``MAX_PIVOTS`` squared, whatever the number of vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.session import checkpoint_dir

SAMPLE = 512           # rows the pivots are chosen from
SAMPLE_BYTES = 32 << 20  # of doubles, whatever the width
MAX_PIVOTS = 128
WORTH = 0.7             # pivots pay if a vector needs less than this share of the cells
SLACK = 1e-6            # radians; arccos loses half the digits near 1


@dataclass
class PivotRouting:
    """``routed``: ``id, u, blk, others``; the counts of block pairs."""

    routed: DataFrame
    blocks: int
    pairs: int      # block pairs left
    skipped: int    # block pairs that the bounds rule out


def spread(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first pivots of the sample, distinct, at most ``count``."""
    chosen = [0]
    nearest = sample @ sample[0]
    while len(chosen) < count:
        far = int(nearest.argmin())
        if nearest[far] > 1 - 1e-9:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, sample @ sample[far])
    return sample[chosen]


def threshold_angle(threshold: float) -> float:
    return math.acos(min(1.0, max(-1.0, threshold))) + SLACK


def reach(low: np.ndarray, high: np.ndarray, theta: float):
    """Angles to the pivots -> (vectors x cells): may the cell hold a partner of the vector?"""
    def needed(angles: np.ndarray) -> np.ndarray:
        out = np.empty((len(angles), len(low)), bool)
        for c in range(len(low)):
            out[:, c] = ((angles >= low[c] - theta) & (angles <= high[c] + theta)).all(axis=1)
        return out
    return needed


def choose(units: DataFrame, n: int, dim: int, threshold: float, blocks: int, worth: float = WORTH) -> np.ndarray | None:
    """Pivots, or None where a sample shows that they would skip little."""
    if blocks < 3 or threshold <= -1:
        return None
    rows = min(SAMPLE, max(1, SAMPLE_BYTES // (8 * dim)))
    key = F.xxhash64("id")
    taken = (units.where(F.pmod(key, F.lit(max(1, n // rows))) == 0).select("u", key.alias("h"))
             .orderBy("h").limit(rows).toPandas()["u"])
    taken = [u for u in taken if np.isfinite(u).all()]
    if not taken:
        return None
    sample = np.array(taken)
    pivots = spread(sample, min(MAX_PIVOTS, max(2, blocks // 2)))
    if len(pivots) < 2:
        return None
    angles = np.arccos(np.clip(sample @ pivots.T, -1, 1))
    cell = angles.argmin(axis=1)
    used = np.unique(cell)
    low = np.array([angles[cell == c].min(axis=0) for c in used])
    high = np.array([angles[cell == c].max(axis=0) for c in used])
    share = reach(low, high, threshold_angle(threshold))(angles).mean()
    return pivots if share < worth else None


def _assign(pivots: np.ndarray):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                m = np.vstack(f["u"].to_numpy())
                finite = np.isfinite(m).all(axis=1)  # others pair with nothing
                f, m = f[finite], m[finite]
                if not len(f):
                    continue
                angles = np.arccos(np.clip(m @ pivots.T, -1, 1))
                yield f.assign(cell=angles.argmin(axis=1).astype(np.int32), angles=list(angles))
    return run


def _route(low: np.ndarray, high: np.ndarray, theta: float, offset: np.ndarray, parts: np.ndarray):
    needed = reach(low, high, theta)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks_of = [np.arange(offset[c], offset[c] + parts[c], dtype=np.int32) for c in range(len(parts))]
        for f in frames:
            if len(f):
                cells = needed(np.vstack(f["angles"].to_numpy()))
                cell = f["cell"].to_numpy()
                blk = offset[cell] + f["h"].to_numpy() % parts[cell]
                others = [np.concatenate([blocks_of[c] for c in np.flatnonzero(row)]) for row in cells]
                yield pd.DataFrame({"id": f["id"], "u": f["u"], "blk": blk.astype(np.int32), "others": others})
    return run


def route(units: DataFrame, pivots: np.ndarray, n: int, blocks: int, threshold: float, max_block: int) -> PivotRouting:
    """Deal ``units`` (``id, u``) to about ``blocks`` blocks of cells.

    The cells are written out (checkpoint): bounds and routing must see the
    same cell of a vector, also when a lost task is run again.
    """
    checkpoint_dir(units.sparkSession)
    id_type = units.schema["id"].dataType
    assigned = units.mapInPandas(_assign(pivots), T.StructType([
        T.StructField("id", id_type), T.StructField("u", T.ArrayType(T.DoubleType())),
        T.StructField("cell", T.IntegerType()), T.StructField("angles", T.ArrayType(T.DoubleType()))])).checkpoint()
    p = len(pivots)
    angle = [F.col("angles")[k] for k in range(p)]
    stats = (assigned.groupBy("cell").agg(F.count("*").alias("n"), F.array(*[F.min(a) for a in angle]).alias("low"),
                                          F.array(*[F.max(a) for a in angle]).alias("high")).collect())
    # Cells nobody is in get an interval that nothing reaches.
    low, high, count = np.full((p, p), np.inf), np.full((p, p), -np.inf), np.zeros(p, np.int64)
    for r in stats:
        low[r["cell"]], high[r["cell"]], count[r["cell"]] = r["low"], r["high"], r["n"]
    target = max(1.0, min(n / blocks, max_block / 2))
    parts = np.where(count > 0, np.maximum(1, np.ceil(count / target - 0.5)), 0).astype(np.int64)
    offset = np.concatenate([[0], np.cumsum(parts)[:-1]])
    theta = threshold_angle(threshold)
    total = int(parts.sum())
    meets = np.array([((low[c] <= high + theta) & (high[c] >= low - theta)).all(axis=1) for c in range(p)])
    inside = int((parts * (parts + 1) // 2).sum())
    across = np.triu(np.outer(parts, parts) * meets, 1)
    pairs = inside + int(across.sum())
    routed = (assigned.withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1 << 31)))
              .mapInPandas(_route(low, high, theta, offset, np.maximum(parts, 1)), T.StructType([
                  T.StructField("id", id_type), T.StructField("u", T.ArrayType(T.DoubleType())),
                  T.StructField("blk", T.IntegerType()), T.StructField("others", T.ArrayType(T.IntegerType()))])))
    return PivotRouting(routed, total, pairs, total * (total + 1) // 2 - pairs)
