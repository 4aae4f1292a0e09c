"""Continuous log cleaning: log lines in, rating messages out.

A stateless projection + filter, so exactly the batch operator runs in the
stream; the checkpoint folder records source offsets and the sink commits.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from reelspark.operators.logs import clean_log_lines, log_to_ratings
from reelspark.streaming.sources import read_lines, write_lines


def start_log_cleaning(spark: SparkSession, source: dict, sink: dict, checkpoint: str,
                       trigger: dict | None = None, parsed: bool = False,
                       keep_unmatched: bool = False):
    """Start the cleaning stream. ``log_rejects`` (``operators/logs.py``) gives
    the messages that the typed form leaves out, as a stream of its own.

    ``parsed=False`` writes the message text as ``value`` (for a Kafka topic
    consumed by the scorer); ``parsed=True`` writes typed rating rows.
    """
    lines = read_lines(spark, source)
    if parsed:
        out = log_to_ratings(lines)
    else:
        out = clean_log_lines(lines, keep_unmatched=keep_unmatched).select(
            F.col("message").alias("value"))
        if sink.get("format") == "kafka":
            out = out.select(F.lit("logProcessor").alias("key"), "value")
    return write_lines(out, sink, checkpoint, trigger)
