"""Stream sources and sinks described by small option dicts.

``{"format": "kafka", "options": {"kafka.bootstrap.servers": ..., "subscribe":
"logs", "startingOffsets": "latest"}}`` reads Kafka (the connector jar must be
on the classpath; it is not part of the PySpark wheel); ``{"format": "text",
"path": dir}`` reads new text files of a folder, one line per record. Both
yield a string column ``value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, source: dict) -> DataFrame:
    fmt = source.get("format", "text")
    reader = spark.readStream.format(fmt).options(**source.get("options", {}))
    if fmt == "kafka":
        df = reader.load()
        cols = [F.col("value").cast("string").alias("value")]
        if "offset" in df.columns:
            cols += [F.col("partition").alias("src_partition"), F.col("offset").alias("src_offset")]
        return df.select(*cols)
    if source.get("max_files_per_trigger"):
        reader = reader.option("maxFilesPerTrigger", int(source["max_files_per_trigger"]))
    return reader.load(source["path"]).select(F.col("value").cast("string").alias("value"))


def write_lines(df: DataFrame, sink: dict, checkpoint: str, trigger: dict | None = None,
                query_name: str | None = None):
    """Start a streaming write of column ``value`` (kafka) or all columns."""
    fmt = sink.get("format", "parquet")
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if query_name:
        w = w.queryName(query_name)
    w = _trigger(w, trigger)
    if fmt == "kafka":
        return (w.format("kafka").options(**sink.get("options", {}))
                .start())
    if fmt == "memory":
        if not query_name:
            w = w.queryName(sink.get("name", "reelspark_out"))
        return w.format("memory").start()
    return w.format(fmt).options(**sink.get("options", {})).start(sink["path"])


def _trigger(writer, trigger: dict | None):
    trigger = trigger or {"processingTime": "5 seconds"}
    return writer.trigger(**trigger)
