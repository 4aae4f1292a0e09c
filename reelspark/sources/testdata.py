"""Mapping of the shared test tables onto the rating model.

The reference's own movie and rating files are not published, so the
TPC-H-like tables are mapped as follows (the DuckDB oracle uses the same
mapping written in SQL):

* ``ratings_li`` - one rating per line item: the order's customer rates the
  part, score ``ceil(quantity / 5) / 2`` (0.5 .. 5.0), time = ship date.
* ``movies``     - one movie per part; genres = part type plus the words of the
  part name, joined by ``|`` (three genres per item).
* ``ratings_ev`` - one rating per event: item id from ``props.k``, score from
  the event type.
* ``tags``       - one tag per event (the event type).
* ``log_lines``  - application log text: even events carry a rating message,
  odd events are heartbeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions.text import RATING_PREFIX, format_rating_message
from reelspark.functions.time import ntz_epoch_seconds

# Fixed values of the fixture mapping.
EVENT_SCORES = {"purchase": 5.0, "click": 3.5, "view": 3.0, "signup": 2.0}
EVENT_SCORE_OTHER = 1.0
LOG_HEAD = "INFO svc - "
LOG_HEARTBEAT = "INFO svc - heartbeat"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    return j.select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("score"),
        ntz_epoch_seconds("l_shipdate").alias("timestamp"))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return p.select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.concat_ws("|", "p_type", F.replace("p_name", F.lit(" "), F.lit("|"))).alias("genres"))


def _event_score() -> F.Column:
    expr = None
    for kind, score in EVENT_SCORES.items():
        expr = (F.when(F.col("event_type") == kind, F.lit(score)) if expr is None
                else expr.when(F.col("event_type") == kind, F.lit(score)))
    return expr.otherwise(F.lit(EVENT_SCORE_OTHER)).cast("double")


def ratings_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    return ev.select(
        "event_id",
        F.col("user_id").cast("int").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        _event_score().alias("score"),
        ntz_epoch_seconds("ts").alias("timestamp"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("user_id", "props", "event_type", "ts")
    return ev.select(
        F.col("user_id").cast("int").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        F.col("event_type").alias("tag"),
        ntz_epoch_seconds("ts").alias("timestamp"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = ratings_ev(spark, sf_dir)
    msg = format_rating_message(F.col("uid"), F.col("mid"), F.col("score"), F.col("timestamp"))
    line = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(LOG_HEAD + RATING_PREFIX), msg)) \
        .otherwise(F.lit(LOG_HEARTBEAT))
    return r.select("event_id", line.alias("value"))


def history_cut(spark: SparkSession, sf_dir: str, history_frac: float = 0.9) -> int:
    """Second at which the given share of the events' time range has passed.

    One bounded aggregate to the driver: the first and last second.
    """
    r = ratings_ev(spark, sf_dir).agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("z")).first()
    return 0 if r["a"] is None else r["a"] + int((r["z"] - r["a"]) * history_frac)


def realtime_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Split ``ratings_ev`` by time into rating history and incoming events;
    the seen pairs are those of the whole history."""
    cut = history_cut(spark, sf_dir)
    r = ratings_ev(spark, sf_dir)
    history = r.where(F.col("timestamp") < cut)
    return {
        "seen": history.select("uid", "mid"),
        "history": history,
        "incoming": r.where(F.col("timestamp") >= cut),
    }
