"""Token files: Parquet list columns that can be read selectively.

Layout of a file set: ``doc_id, n_tokens, file_start, ids``, one row per
document, ascending by id within and across files. ``ids`` is a list of
32-bit integers, dictionary-encoded (a vocabulary's ids fit in 16 bits) or
delta-encoded; row groups and pages have set sizes and the writer adds page
indexes, so a reader fetches the metadata columns or a range of documents
without the rest. ``file_start`` counts the ids before the document in its
file; one small sum per file turns it into a corpus offset.

Defined results: a null or empty text yields the end id alone; documents with
one id stand in the order of their text's hash and then text; a null id comes first.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bytebpe import BYTE_BPE, ChunkCoder

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
END_ID = 0


def encode_sorted(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                  tokenizer: str = BYTE_BPE, end_id: int = END_ID) -> DataFrame:
    """Documents range-partitioned and sorted by id, with their token ids."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = [struct.Struct(f"<{n}I").pack for n in range(64)]
        coder = ChunkCoder(tokenizer, lambda ids: pack[len(ids)](*ids) if len(ids) < 64 else struct.pack(f"<{len(ids)}I", *ids), "id-cache")
        start = 0
        for b in batches:
            at = 0
            for ids in coder.encode_lists(b.column(1), end):
                ends = ids.offsets.to_numpy()
                lengths = np.diff(ends).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(ids)), pa.array(lengths), pa.array(start + ends[:-1].astype(np.int64)), ids],
                    ["doc_id", "n_tokens", "file_start", "ids"])
                at += len(ids)
                start += int(ends[-1])

    return ordered.mapInArrow(encode, "doc_id long, n_tokens long, file_start long, ids array<int>")


def write_token_files(encoded: DataFrame, path: str, encoding: str = "dictionary",
                      row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> None:
    """Write with the layout above; ``encoding`` is 'dictionary' or 'delta'."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding!r}")
    (encoded.write
     .option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
     .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
     .option("parquet.writer.version", "PARQUET_1_0" if encoding == "dictionary" else "PARQUET_2_0")
     .option("maxRecordsPerFile", 0)  # file_start counts the ids of one task, which must be one file
     .option("compression", "snappy").parquet(path))


def read_tokens(spark: SparkSession, path: str, columns: tuple = ("doc_id", "n_tokens", "file_start", "ids")) -> DataFrame:
    """The file set's rows with ``file``; unread columns are never fetched."""
    schema = "doc_id long, n_tokens long, file_start long, ids array<int>"
    return spark.read.schema(schema).parquet(path).select(*columns, F.col("_metadata.file_path").alias("file"))


def file_offsets(spark: SparkSession, path: str) -> DataFrame:
    """``file, file_offset``: ids in all earlier files, from metadata columns.

    Files follow one another by their smallest id; file names, which number
    the range partitions, settle ties. One row per file.
    """
    per_file = (read_tokens(spark, path, ("doc_id", "n_tokens")).groupBy("file")
                .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.sum("n_tokens").alias("n")))
    before = Window.orderBy(F.asc_nulls_first("low"), F.asc_nulls_first("high"), "file").rowsBetween(Window.unboundedPreceding, -1)
    return per_file.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_offset"))


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a file set: ``doc_id, start, n_tokens, ids_crc32``, all read back."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids")
            ends = ids.offsets.to_numpy()
            raw = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [zlib.crc32(raw[a:z].tobytes()) for a, z in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("file"), b.column("file_start"),
                 pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
                ["doc_id", "file", "file_start", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path, ("doc_id", "file_start", "ids")).mapInArrow(
        digest, "doc_id long, file string, file_start long, n_tokens long, ids_crc32 long")
    return (rows.join(file_offsets(spark, path), "file")
            .select("doc_id", (F.col("file_offset") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32"))
