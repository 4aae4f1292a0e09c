"""Distributed connected components by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .common import materialise


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) over the links ``a - b``."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[:len(a)], place[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        while True:  # point every node at the end of its chain
            jump = new[new]
            if np.array_equal(jump, new):
                break
            new = jump
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


KEY_BYTES = 16


def keys_of(column: pa.Array) -> np.ndarray:
    """A column of longs, or of keys of ``KEY_BYTES`` bytes, as comparable values."""
    if pa.types.is_integer(column.type):
        return column.to_numpy()
    return np.frombuffer(b"".join(column.to_pylist()), f"S{KEY_BYTES}")


def column_of(keys: np.ndarray) -> pa.Array:
    """The column that ``keys_of`` read."""
    if keys.dtype.kind != "S":
        return pa.array(keys)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(KEY_BYTES), len(keys), [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())


def _local_forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of each batch's links instead of the links."""
    for batch in batches:
        node, root = forest(keys_of(batch.column(0)), keys_of(batch.column(1)))
        far = node != root
        yield pa.RecordBatch.from_arrays([column_of(node[far]), column_of(root[far])], ["u", "v"])


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component_id`` (smallest reachable id) of every linked id: a
    number, or a binary key of ``KEY_BYTES`` bytes.

    Links with a null end are ignored. Each round points a node's larger
    neighbours at its smallest one and then its smaller ones likewise, until
    every component is a star. Minima are pre-aggregated before they shuffle
    and the joins on a hub's id may be split, so no task needs a whole
    component. Rounds are cut in the shared folder.
    """
    kind = "binary" if isinstance(links.schema[a].dataType, BinaryType) else "long"
    links = links.select(F.col(a).cast(kind).alias("a"), F.col(b).cast(kind).alias("b")).where("a <> b")
    stars = materialise(links.mapInArrow(_local_forests, f"u {kind}, v {kind}").distinct(), "links")
    state = _fingerprint(stars)
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        large = materialise(large, "large-stars")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                            F.col("m").alias("v")).distinct()
        stars = materialise(small, "stars")
        new = _fingerprint(stars)
        if new == state:
            break
        state = new
    return (stars.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
            .unionByName(stars.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()))


def _fingerprint(stars: DataFrame) -> tuple:
    r = stars.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h"),
                  F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31))).alias("s")).first()
    return r["n"], r["h"], r["s"]
