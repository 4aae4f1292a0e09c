"""Per-user recent ratings as keyed streaming state.

The reference keeps each user's latest ratings in an external list store.
Here the list is Structured Streaming state of at most ``n_recent`` entries per
user whatever the number of ratings. It lives in the checkpointed state store,
so it survives restarts and executor loss.

``with_recents`` is what the real-time stream runs: every incoming rating
leaves with the list that its user had before the batch, and the batch's
ratings then enter the list. The lists start from a history table, which only
the first batch reads; no later batch reads any history.
``recent_ratings_state`` is the list alone, emitted whenever it changes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupStateTimeout

from reelspark.operators.realtime import N_RECENT, recent_ratings

_STATE = T.StructType([
    T.StructField("mids", T.ArrayType(T.IntegerType())),
    T.StructField("scores", T.ArrayType(T.DoubleType())),
    T.StructField("ts", T.ArrayType(T.IntegerType())),
    T.StructField("eids", T.ArrayType(T.LongType())),
])

OUTPUT = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mids", T.ArrayType(T.IntegerType())),
    T.StructField("scores", T.ArrayType(T.DoubleType())),
    T.StructField("ts", T.ArrayType(T.IntegerType())),
    T.StructField("eids", T.ArrayType(T.LongType())),
])


def _merge_fn(n_recent: int):
    # defined here, so that it is pickled by value with the function below
    def newest(rows: pd.DataFrame, n: int) -> pd.DataFrame:
        """The ``n`` newest rows in the order of ``recent_ratings``."""
        order = np.lexsort((rows["score"].to_numpy(float), rows["mid"].to_numpy(np.int64),
                            -rows["event_id"].to_numpy(np.int64), -rows["timestamp"].to_numpy(np.int64)))[:n]
        return rows.iloc[order]

    def run(key, pdfs, state):
        top = pd.DataFrame({"mid": [], "score": [], "timestamp": [], "event_id": []})
        if state.exists:
            mids, scores, ts, eids = state.get
            top = pd.DataFrame({"mid": list(mids), "score": list(scores),
                                "timestamp": list(ts), "event_id": list(eids)})
        for pdf in pdfs:  # folded chunk by chunk: a hot user never gathers more
            chunk = pdf[["mid", "score", "timestamp", "event_id"]]
            top = newest(pd.concat([top, chunk], ignore_index=True) if len(top) else chunk, n_recent)
        value = (top["mid"].astype("int32").tolist(), top["score"].astype(float).tolist(),
                 top["timestamp"].astype("int32").tolist(), top["event_id"].astype("int64").tolist())
        state.update(value)
        yield pd.DataFrame({"uid": [int(key[0])], "mids": [value[0]], "scores": [value[1]],
                            "ts": [value[2]], "eids": [value[3]]})
    return run


def recent_ratings_state(ratings: DataFrame, n_recent: int = N_RECENT) -> DataFrame:
    """Streaming ``(uid, mid, score, timestamp, event_id)`` -> updated recent
    lists per user (output mode ``update``)."""
    return (ratings.select("uid", "mid", "score", "timestamp", "event_id")
            .groupBy("uid")
            .applyInPandasWithState(_merge_fn(n_recent), OUTPUT, _STATE, "update",
                                    GroupStateTimeout.NoTimeout))


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
REJECT_LANES = 64        # groups that messages without a usable rating are spread over
RATED = ("event_id long, uid int, mid int, score double, timestamp int, message string, "
         "r_mids array<int>, r_scores array<double>")


def _recents_processor(n_recent: int):
    # a class made here is pickled by value, so executors need no copy of the package
    class Recents(StatefulProcessor):
        def init(self, handle):
            self.state = handle.getValueState("recents", "mids array<int>, scores array<double>, ts array<int>, seqs array<long>, next long")

        def close(self):
            pass

        def _get(self):
            if not self.state.exists():
                return [], [], [], [], 0
            mids, scores, ts, seqs, next_seq = self.state.get()
            return list(mids), list(scores), list(ts), list(seqs), next_seq

        def _put(self, mids, scores, ts, seqs, next_seq):
            newest = np.lexsort((-np.array(seqs, np.int64), -np.array(ts, np.int64)))[:n_recent]
            self.state.update(([int(mids[k]) for k in newest], [float(scores[k]) for k in newest],
                               [int(ts[k]) for k in newest], [int(seqs[k]) for k in newest], int(next_seq)))

        def handleInitialState(self, key, rows, timers):
            mids, scores, ts, seqs, next_seq = self._get()
            # Older than anything that arrives at the same second; the newest first among themselves.
            self._put(mids + rows["r_mid"].tolist(), scores + rows["r_score"].tolist(), ts + rows["r_time"].tolist(),
                      seqs + (-rows["r_rank"].astype("int64")).tolist(), next_seq)

        def handleInputRows(self, key, rows, timers):
            if key[1] >= 0:  # messages without a usable rating pass by
                for pdf in rows:
                    yield pd.DataFrame({"event_id": None, "uid": None, "mid": None, "score": None, "timestamp": None,
                                        "message": pdf["message"], "r_mids": None, "r_scores": None})
                return
            mids, scores, ts, seqs, next_seq = self._get()
            # One user's ratings of one batch, in an order that a replay repeats.
            new = pd.concat(list(rows), ignore_index=True).sort_values(["timestamp", "source_id", "mid", "score"], kind="stable")
            n, uid = len(new), int(key[0])
            seq = next_seq + np.arange(n, dtype=np.int64)
            own = (np.int64(uid) << np.int64(32)) | seq
            ids = np.where(new["source_id"].to_numpy(np.int64) >= 0, new["source_id"].to_numpy(np.int64), own)
            yield pd.DataFrame({"event_id": ids, "uid": uid, "mid": new["mid"].to_numpy(), "score": new["score"].to_numpy(),
                                "timestamp": new["timestamp"].to_numpy(), "message": None,
                                "r_mids": [mids] * n, "r_scores": [scores] * n})
            self._put(mids + new["mid"].tolist(), scores + new["score"].tolist(), ts + new["timestamp"].tolist(),
                      seqs + seq.tolist(), next_seq + n)

    return Recents()


def with_recents(parsed: DataFrame, history: DataFrame | None = None, n_recent: int = N_RECENT) -> DataFrame:
    """Streaming ratings with their users' recent ratings (columns ``RATED``).

    ``parsed`` = ``(message, uid, mid, score, timestamp, valid[, source_id])``.
    Rows that are not valid leave with their message alone. An event id is the
    ``source_id`` where the source numbers its records, else the user and the
    count of the user's ratings so far, so a replay gives the same ids.
    Ratings of one batch do not see each other. A user's ratings of one batch
    are sorted in one task: bound the batches of a large backlog by the
    source's rate options. Needs the RocksDB state store.
    """
    source_id = F.col("source_id") if "source_id" in parsed.columns else F.lit(-1)
    lane = F.when(F.col("valid"), -1).otherwise(F.pmod(F.xxhash64("message"), F.lit(REJECT_LANES))).cast("int")
    keyed = parsed.select(F.coalesce(F.when(F.col("valid"), F.col("uid")), F.lit(0)).alias("user"), lane.alias("lane"), "mid", "score",
                          "timestamp", "message", source_id.cast("long").alias("source_id"))
    start = None
    if history is not None:
        first = recent_ratings(history, n_recent, with_rank=True, with_time=True)
        start = (first.where("uid IS NOT NULL").select(F.col("uid").cast("int").alias("user"), F.lit(-1).alias("lane"), "r_rank",
                                                       F.col("r_time").cast("int").alias("r_time"), "r_mid", "r_score")
                 .groupBy("user", "lane"))
    return keyed.groupBy("user", "lane").transformWithStateInPandas(_recents_processor(n_recent), RATED, "append", "none", start)
