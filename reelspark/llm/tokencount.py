"""Token counts per document: map-side two-tier look-up.

Tier 1 is a broadcast table of the corpus's most frequent text chunks and
their token counts; tier 2 is each worker's bounded cache, filled by encoding
the chunks that miss. Texts and chunks are never shuffled: the frequent table
comes from bounded per-task summaries, and the counts are a map over rows.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows
are counted each; other columns pass through untouched.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytebpe import BYTE_BPE, ChunkCoder

FREQUENT = 1 << 14          # entries of the broadcast table
TASK_SUMMARY = 1 << 12      # entries that each task reports
COUNTER_LIMIT = 200_000     # entries that a task counts at once


def frequent_chunks(docs: DataFrame, text: str = "text", size: int = FREQUENT,
                    task_size: int = TASK_SUMMARY) -> list[str]:
    """The most frequent chunks of all texts by per-task heavy-hitter summaries.

    Every text is counted. A task keeps at most ``COUNTER_LIMIT`` counters
    (when full, the smaller half is dropped) and reports its ``task_size``
    largest; their sums rank the table. An approximate table costs speed
    only: counts never depend on it.
    """
    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    counts.update(t.split(" "))
                    if len(counts) > COUNTER_LIMIT:
                        counts = Counter(dict(counts.most_common(COUNTER_LIMIT // 2)))
        top = [(c, n) for c, n in counts.most_common(task_size)
               if n > 1 and c and len(c) <= 64 and not c[0].isspace() and "\0" not in c]
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in top], pa.string()),
                                          pa.array([n for _, n in top], pa.int64())], ["chunk", "n"])

    parts = docs.select(text).mapInArrow(summary, "chunk string, n long")
    top = parts.groupBy("chunk").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "chunk").limit(size)
    return [r["chunk"] for r in top.collect()]


def token_count_udf(spark, frequent: list[str], tokenizer: str = BYTE_BPE):
    """Arrow UDF text -> number of tokens; ``frequent`` is bounded by ``FREQUENT``."""
    coder = ChunkCoder(tokenizer, len, "count-table")
    keys = [c for c in frequent if c and not c[0].isspace()]
    known = spark.sparkContext.broadcast(dict(zip(keys, coder.encode_chunks(keys))))

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = ChunkCoder(tokenizer, len, "count-cache", known.value)
        for b in batches:
            yield pa.array([sum(v) for v in c.encode(b.to_pylist())], pa.int64())

    return count


def token_counts(docs: DataFrame, text: str = "text", limit: int = 1024, tokenizer: str = BYTE_BPE) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` added."""
    count = token_count_udf(docs.sparkSession, frequent_chunks(docs, text), tokenizer)
    n_tokens: Column = count(F.col(text))
    return (docs.withColumn("n_bytes", F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")))
            .withColumn("n_tokens", n_tokens)
            .withColumn("over_limit", F.col("n_tokens") > limit))
