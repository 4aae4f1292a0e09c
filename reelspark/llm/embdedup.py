"""Embedding near-dedup by random-hyperplane sign hashing.

A vector's hash in a table is the sign pattern of its products with the
table's random hyperplanes; two vectors at angle t agree in one sign with
probability 1 - t/pi. Planes per table follow the number of vectors, so that
unrelated vectors seldom meet, and the number of tables follows from the
planes so that a pair on the threshold is found with probability ``RECALL``
(more similar pairs more often). The planes come from a fixed seed.

Equal vectors are one class. Members of a bucket are compared block by block
(``BLOCK`` classes; every pair of blocks is a group of its own, so no group
grows with a bucket); a pair that already met in an earlier table is skipped,
so each found pair counts once. Every candidate's cosine is computed exactly
in double precision. A group returns link counts and a spanning forest of its
links, not the links; forests meet in distributed connected components.

Defined results: vectors that are null, zero, or hold a null or non-finite
component link with nothing, not even with equal ones, and are kept. Vectors
of different lengths never link. Rows that repeat an id each count as a
vector; a null id has a null component and is kept. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .components import connected_components, forest

THRESHOLD = 0.9
RECALL = 0.98
BUCKET = 32              # unrelated classes that a bucket may hold
BLOCK = 1024
SEED = 20240229


def plan(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(planes per table, tables) for ``n`` vectors."""
    planes = min(60, max(4, math.ceil(math.log2(max(n, 1) / BUCKET + 1))))
    agree = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def hyperplanes(dim: int, planes: int, tables: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim, planes * tables))


def unit_vectors(df: DataFrame, vec: str, id_col: str) -> DataFrame:
    """``vec_id, vec`` (doubles), vec null where it may not link."""
    v = F.col(vec).cast("array<double>")
    usable = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = usable & F.exists(v, lambda x: x != 0)
    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.when(usable, v).alias("vec"))


def _hashes(planes: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normals: dict[int, np.ndarray] = {}
        weights = (1 << np.arange(planes, dtype=np.int64))
        for b in batches:
            lists = b.column("vec").to_pylist()
            out = []
            for v in lists:
                if len(v) not in normals:
                    normals[len(v)] = hyperplanes(len(v), planes, tables)
                x = np.array(v)
                signs = (x / np.abs(x).max()) @ normals[len(v)] >= 0
                out.append(signs.reshape(tables, planes) @ weights)
            yield pa.RecordBatch.from_arrays(
                [b.column("class_id"), b.column("copies"), b.column("vec"),
                 pa.array([list(map(int, h)) for h in out], pa.list_(pa.int64()))],
                ["class_id", "copies", "vec", "hashes"])
    return run


def _links(threshold: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Link counts and a spanning forest of one pair of blocks."""
        x = np.array(group["vec"].tolist(), float)
        # Powers of two keep the products exact in scale and clear of overflow.
        x = x / np.exp2(np.floor(np.log2(np.abs(x).max(axis=1))))[:, None]
        length = np.sqrt((x * x).sum(axis=1))
        hashes = np.array(group["hashes"].tolist(), np.int64)
        ids, copies = group["class_id"].to_numpy(np.int64), group["copies"].to_numpy(np.int64)
        table, side = int(group["table"].iloc[0]), group["side"].to_numpy()
        one, two = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        count = np.zeros(len(ids), np.int64)
        a, b = [], []
        for at in range(0, len(one), 256):
            rows = one[at:at + 256]
            cos = (x[rows] @ x[two].T) / length[rows][:, None] / length[two][None, :]
            hit = cos >= threshold
            # A product's sum may round differently by shape; decide close calls one by one.
            for i, j in np.argwhere(np.abs(cos - threshold) < 1e-9):
                p, q = x[rows[i]], x[two[j]]
                hit[i, j] = math.fsum(p * q) / math.sqrt(math.fsum(p * p) * math.fsum(q * q)) >= threshold
            for t in range(table):
                hit &= hashes[rows, t][:, None] != hashes[two, t][None, :]
            hit &= ids[rows][:, None] != ids[two][None, :]
            both = side[rows[0]] == 2  # one block with itself: every pair twice
            count[rows] += hit @ copies[two]
            if not both:
                np.add.at(count, two, copies[rows] @ hit)
            i, j = np.nonzero(hit)
            if len(i):
                node, root = forest(ids[rows[i]], ids[two[j]])
                a.append(node)
                b.append(root)
        linked = count > 0
        out = pd.DataFrame({"class_id": ids[linked], "n": count[linked], "root": ids[linked]})
        if a:
            node, root = forest(np.concatenate(a), np.concatenate(b))
            out["root"] = pd.Series(root, index=node).reindex(out["class_id"]).to_numpy()
        return out
    return run


def near_duplicates(embeddings: DataFrame, vec: str = "embedding", id_col: str = "vec_id",
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``."""
    rows = unit_vectors(embeddings, vec, id_col)
    # -0.0 and 0.0 are one value; the key is the exact vector.
    key = F.transform("vec", lambda x: x + 0.0)
    rows = rows.withColumn("h1", F.xxhash64(key)).withColumn("h2", F.xxhash64(F.lit(1), key))
    usable = rows.where("vec IS NOT NULL AND vec_id IS NOT NULL")
    classes = materialise(usable.groupBy("h1", "h2").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"),
                                                         F.first("vec").alias("vec")), "vector-classes")
    planes, tables = plan(classes.count(), threshold, recall)
    hashed = (classes.select("class_id", "copies", "vec")
              .mapInArrow(_hashes(planes, tables), "class_id long, copies long, vec array<double>, hashes array<long>"))
    hashed = materialise(hashed, "sign-hashes")
    keys = hashed.select("class_id", F.size("vec").alias("dim"), F.posexplode("hashes").alias("table", "bucket"))
    sizes = keys.groupBy("dim", "table", "bucket").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK)
    own, other = F.pmod(F.xxhash64("class_id"), blocks), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    dealt = (keys.join(sizes, ["dim", "table", "bucket"])
             .select("class_id", "dim", "table", "bucket", own.alias("own"), other.alias("other"))
             .select("class_id", "dim", "table", "bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                     F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side")))
    dealt = dealt.join(hashed.select("class_id", "copies", "vec", "hashes"), "class_id")
    found = materialise(dealt.groupBy("dim", "table", "bucket", "lo", "hi")
                        .applyInPandas(_links(threshold), "class_id long, n long, root long"), "vector-links")
    counts = found.groupBy("class_id").agg(F.sum("n").alias("n"))
    comps = connected_components(found.select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    per_class = (classes.select("h1", "h2", "class_id", "copies").join(counts, "class_id", "left")
                 .join(comps.withColumnRenamed("id", "class_id"), "class_id", "left")
                 .select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("component_id", "class_id").alias("component")))
    out = rows.join(per_class, ["h1", "h2"], "left")
    linked = F.col("vec").isNotNull() & F.col("vec_id").isNotNull()
    component = F.when(linked, F.col("component")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.when(linked, F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
