"""Real-time recommendation stream.

``readStream`` (rating messages ``uid|mid|score|timestamp``) -> parse -> keyed
state that gives every rating its user's recent ratings
(``reelspark.streaming.state.with_recents``) -> ``foreachBatch``, which finds
and scores the candidates and writes the batch's results (bad messages go to
an optional rejects folder). The history table is read by the first batch
only, to start the state; later batches read state, whose size per user does
not grow.

The seen pairs are far larger than a micro-batch. ``write_side_table`` stores
them partitioned by a hash bucket of ``uid``; each batch then reads only the
buckets of its own users (static partition pruning on the bucket ids of the
batch - a list bounded by the bucket count).

Exactly-once: every output (recommendations, lists, rejects, ratings) is
written to its own ``batch_id=N`` folder with a plain overwrite, so a batch
replayed after a failure replaces its own earlier attempt, also when it now
has no rows; a replay starts from the state before the batch. The ratings form
a log that is compacted in levels (``reelspark.streaming.history``). The
checkpoint folder holds source offsets, commits and state.

``score_batch`` scores one batch without state, from a history table and the
log of earlier batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.operators.logs import parse_ratings
from reelspark.operators.realtime import (
    N_CANDIDATES, N_RECENT, candidates, realtime_lists, realtime_recs, score_candidates,
)
from reelspark.streaming.history import HistoryLog
from reelspark.streaming.sources import _trigger, read_lines
from reelspark.streaming.state import ROCKSDB, STATE_STORE, with_recents


USER_BUCKETS = 256
BUCKET_COL = "uid_bucket"


def user_bucket(uid_col: str = "uid", buckets: int = USER_BUCKETS):
    return F.pmod(F.xxhash64(F.col(uid_col).cast("int")), F.lit(buckets)).cast("int")


def write_side_table(df: DataFrame, path: str, buckets: int = USER_BUCKETS) -> None:
    """Write a per-user side table (history, seen pairs) bucketed by user."""
    (df.withColumn(BUCKET_COL, user_bucket("uid", buckets))
     .write.mode("overwrite").partitionBy(BUCKET_COL).parquet(path))


def prune_to_users(side: DataFrame, users: DataFrame, buckets: int = USER_BUCKETS) -> DataFrame:
    """Rows of a bucketed side table whose bucket holds one of ``users``.

    The distinct bucket ids of the batch (at most ``buckets`` ints) become a
    partition filter, so the scan skips every other bucket folder. Tables
    without the bucket column are returned unchanged.
    """
    if BUCKET_COL not in side.columns:
        return side
    ids = [r[0] for r in users.select(user_bucket("uid", buckets).alias("b")).distinct().collect()]
    return side.where(F.col(BUCKET_COL).isin(ids)).drop(BUCKET_COL)


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={int(batch_id)}")


def with_event_ids(batch: DataFrame, batch_id: int) -> DataFrame:
    """Event ids that a replay reproduces and that rise from batch to batch:
    the Kafka (partition, offset) when present, else the batch, the partition
    and the row's place in it."""
    if "src_offset" in batch.columns:
        eid = F.shiftleft(F.col("src_partition").cast("long"), 40) + F.col("src_offset")
    else:
        place = F.monotonically_increasing_id()
        row = place.bitwiseAND(F.lit((1 << 33) - 1))
        eid = F.lit(int(batch_id) << 44) + F.shiftleft(F.shiftright(place, 33), 28) + row
    return batch.withColumn("event_id", eid)


RECS = "event_id long, uid int, mid int, score double"


def _write_results(recs: DataFrame, incoming: DataFrame, batch_id: int, out_path: str, lists_path: str | None,
                   history_path: str | None) -> None:
    spark = incoming.sparkSession
    _write_batch(recs, out_path, batch_id)
    if lists_path:
        written = spark.read.schema(RECS).parquet(f"{out_path.rstrip('/')}/batch_id={int(batch_id)}")
        _write_batch(realtime_lists(written, incoming), lists_path, batch_id)
    if history_path:
        HistoryLog(spark, history_path).append(batch_id, incoming)


def score_batch(batch: DataFrame, batch_id: int, history: Callable[[], DataFrame],
                seen: DataFrame, sims: DataFrame, out_path: str,
                rejects_path: str | None = None, history_path: str | None = None,
                n_recent: int = N_RECENT, n_candidates: int = N_CANDIDATES,
                lists_path: str | None = None) -> None:
    """Score one micro-batch of messages without state. With ``history_path``
    the batch's ratings become history for later batches; with ``lists_path``
    one packed list per rating is written, the empty list included."""
    parsed = parse_ratings(with_event_ids(batch, batch_id).withColumnRenamed("value", "message"))
    parsed = parsed.persist()
    try:
        if rejects_path:
            _write_batch(parsed.where(~F.col("valid")).select("message"), rejects_path, batch_id)
        incoming = parsed.where("valid").select("event_id", "uid", "mid", "score", "timestamp")
        hist = history()
        hist_b = prune_to_users(hist, incoming)
        if history_path:
            past = HistoryLog(batch.sparkSession, history_path).rows(before=batch_id)
            hist_b = hist_b.unionByName(past, allowMissingColumns=True)
        recs = realtime_recs(incoming, hist_b, prune_to_users(seen, incoming), sims, n_recent=n_recent,
                             n_candidates=n_candidates)
        _write_results(recs, incoming, batch_id, out_path, lists_path, history_path)
    finally:
        parsed.unpersist()


def score_rated(batch: DataFrame, batch_id: int, seen: DataFrame, sims, out_path: str,
                rejects_path: str | None = None, history_path: str | None = None,
                n_candidates: int = N_CANDIDATES, lists_path: str | None = None) -> None:
    """Score one micro-batch of ratings that carry their recents (``with_recents``)."""
    batch = batch.persist()
    cands = None
    try:
        if rejects_path:
            _write_batch(batch.where("event_id IS NULL").select("message"), rejects_path, batch_id)
        incoming = batch.where("event_id IS NOT NULL").select("event_id", "uid", "mid", "score", "timestamp")
        # At most n_candidates rows per rating, asked for twice: by the lookup and by the scores.
        cands = candidates(incoming, prune_to_users(seen, incoming), sims, n_candidates).persist()
        recents = batch.select("event_id", F.explode(F.arrays_zip("r_mids", "r_scores")).alias("r"))
        pairs = (cands.repartition(batch.sparkSession.sparkContext.defaultParallelism, "event_id")
                 .join(recents.select("event_id", F.col("r.r_mids").alias("r_mid"), F.col("r.r_scores").alias("r_score")), "event_id"))
        _write_results(score_candidates(pairs, sims), incoming, batch_id, out_path, lists_path, history_path)
    finally:
        batch.unpersist()
        if cands is not None:
            cands.unpersist()


def start_realtime(spark: SparkSession, source: dict, history: Callable[[], DataFrame],
                   seen: DataFrame, sims: DataFrame, out_path: str, checkpoint: str,
                   rejects_path: str | None = None, history_path: str | None = None,
                   trigger: dict | None = None, lists_path: str | None = None,
                   n_recent: int = N_RECENT):
    """Start the scoring stream (default trigger: 5-second micro-batches).

    With ``history_path`` incoming ratings become history of later batches:
    they are logged there, and the users' recent ratings are kept as state.
    ``history`` then only starts the state of a new checkpoint and is not read
    again. Without it every batch is scored against ``history`` alone.
    ``seen`` and ``sims`` are static snapshots, as in the reference.
    """
    lines = read_lines(spark, source)
    if not history_path:
        def run(batch: DataFrame, batch_id: int) -> None:
            score_batch(batch, batch_id, history, seen, sims, out_path, rejects_path, n_recent=n_recent, lists_path=lists_path)

        return _trigger(lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run), trigger).start()

    if "src_offset" in lines.columns:
        lines = lines.withColumn("source_id", F.shiftleft(F.col("src_partition").cast("long"), 40) + F.col("src_offset"))
    past = history()
    if BUCKET_COL in past.columns:
        past = past.drop(BUCKET_COL)
    rated = with_recents(parse_ratings(lines.withColumnRenamed("value", "message")), past, n_recent)

    def run_rated(batch: DataFrame, batch_id: int) -> None:
        score_rated(batch, batch_id, seen, sims, out_path, rejects_path, history_path, lists_path=lists_path)

    w = rated.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(run_rated)
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # a query keeps the settings it was started with
    try:
        return _trigger(w, trigger).start()
    finally:
        spark.conf.set(STATE_STORE, before)
