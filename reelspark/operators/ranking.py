"""Ranks inside groups of any size."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from reelspark.session import checkpoint_dir


def distributed_rank(df: DataFrame, keys: list[str], order: list[Column], rank: str = "rank", path: str | None = None) -> DataFrame:
    """``df`` with the 1-based rank of each row in its group of ``keys``.

    A window would hold a whole group in one task. Here the rows are range
    partitioned and sorted by ``keys`` and ``order``, so a large group spans
    several partitions; each partition numbers its rows as they stream by, and
    the rows of a group in earlier partitions are added. Only groups that go on
    in a later partition need that, at most two rows per partition, so it is a
    small broadcast. ``order`` must be total inside a group.

    The numbered rows are written once under ``path`` (default: a new folder
    in the session's checkpoint dir), so counts and ranks see the same
    partitions whatever is run again. Null keys form one group.
    """
    spark = df.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/ranked-{uuid.uuid4().hex}"
    places = [df.columns.index(k) for k in keys]
    spread = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    spread = spread.withColumn("_part", F.spark_partition_id())
    schema = T.StructType([*spread.schema.fields, T.StructField("_place", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place = None, 0
        for b in batches:
            out = []
            for key in zip(*(b.column(i).to_pylist() for i in places)):
                place = place + 1 if key == last else 1
                last = key
                out.append(place)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int64())], [*b.schema.names, "_place"])

    spread.mapInArrow(number, schema).write.mode("overwrite").parquet(path)
    rows = spark.read.schema(schema).parquet(path)
    sizes = rows.groupBy(*keys, "_part").agg(F.max("_place").alias("_n"))
    # A partition's first group may have begun earlier; only the parts after a group's first matter.
    group = Window.partitionBy(*keys)
    several = sizes.withColumn("_parts", F.count(F.lit(1)).over(group)).where("_parts > 1")
    ahead = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = several.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"),
                             F.sum("_n").over(ahead).alias("_ahead")).where("_ahead IS NOT NULL")
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (rows.join(F.broadcast(offsets), same, "left")
            .select(*df.columns, (F.col("_place") + F.coalesce("_ahead", F.lit(0))).alias(rank)))
