"""End-to-end batch and stream jobs: read tables, run operators, write tables.

Each job corresponds to one of the reference's executables and writes the
same result tables (names below). Lists are written flat and ranked
``(key, rank, item, score)`` by default; ``packed=True`` writes the
``(mid,score)|(mid,score)`` text form, which puts a whole list in one row, so
similarity lists are only packed together with a ``top_n`` cut.

Usage::

    python -m reelspark.plans.jobs statistics --source parquet:/data/raw --sink parquet:/data/out
    python -m reelspark.plans.jobs lfm        --source parquet:/data/raw --sink parquet:/data/out
    python -m reelspark.plans.jobs content    --source parquet:/data/raw --sink parquet:/data/out
    python -m reelspark.plans.jobs load --movies m.csv --ratings r.csv --tags t.csv --sink parquet:/data/raw
    python -m reelspark.plans.jobs tune       --source parquet:/data/raw --sink parquet:/data/out
    python -m reelspark.plans.jobs log-clean --source text:/logs --sink text:/msgs --checkpoint /ck/logs
    python -m reelspark.plans.jobs realtime --source text:/msgs --tables parquet:/data/raw \
        --sink parquet:/data/out --checkpoint /ck/rt

A target is ``format:path``; ``--source-option``, ``--sink-option`` and
``--tables-option`` add ``key=value`` pairs to it. JDBC takes the URL as its
path and ``partition_column``, ``lower``, ``upper``, ``partitions`` and
connection properties as options; Kafka takes its options as they are::

    --source jdbc:jdbc:derby:/db --source-option partition_column=mid --source-option lower=0 \
        --source-option upper=1000000 --source-option partitions=64
    --source kafka: --source-option kafka.bootstrap.servers=h:9092 --source-option subscribe=ratings

Tables are read with ``read_table`` (Parquet folders or JDBC) - the job never
caches an input whole: each output needs two or three columns of the ratings
and re-reads them with column pruning.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions import lists
from reelspark.operators import content, factor, stats
from reelspark.operators.ranking import distributed_rank
from reelspark.operators.simsource import TableSims, sims_from_packed
from reelspark.sources.files import load_movies, load_ratings, load_tags, read_table, write_table

# Result table names, equal to the reference's.
T_MOVIE, T_RATING, T_TAG, T_MOVIE_TAGS = "rec_movie", "rec_rating", "rec_tag", "rec_movie_tags"
T_HISTORY_HOT, T_RECENT_HOT = "rec_history_hot", "rec_recent_hot"
T_AVERAGE, T_GENRES_TOP = "rec_average_score", "rec_GENRES_TOP"
T_USER_RECS, T_MOVIE_RECS = "rec_user_movies", "rec_movie_movies"
T_CONTENT_RECS, T_REAL_TIME = "rec_content_recs", "rec_real_time"
T_TUNING = "rec_als_tuning"


def _packed(flat: DataFrame, key: str, item: str, score: str) -> DataFrame:
    grouped = lists.collect_ranked(flat, key, item, score)
    return grouped.select(key, lists.pack_list(F.col("recs")).alias("recs"))


def load_job(spark: SparkSession, movies_csv: str, ratings_csv: str, tags_csv: str,
             sink: dict) -> None:
    """Raw CSV files -> rating/movie/tag tables + movies with their tags."""
    movies = load_movies(spark, movies_csv)
    tags = load_tags(spark, tags_csv)
    write_table(movies, T_MOVIE, sink)
    write_table(load_ratings(spark, ratings_csv), T_RATING, sink)
    write_table(tags, T_TAG, sink)
    write_table(stats.movie_tags(movies, tags), T_MOVIE_TAGS, sink)


def statistics_job(spark: SparkSession, source: dict, sink: dict, packed: bool = True) -> None:
    """Hot items, monthly hot items, mean scores and top-10 per genre."""
    ratings = read_table(spark, T_RATING, source)
    movies = read_table(spark, T_MOVIE, source)
    write_table(stats.history_hot(ratings), T_HISTORY_HOT, sink)
    recent_sink = dict(sink, partition_by=["yearmonth"]) if sink.get("format", "parquet") == "parquet" else sink
    write_table(stats.recent_hot(ratings), T_RECENT_HOT, recent_sink)
    # The mean scores are written once and read back for the genre lists, so
    # the rating scan is not repeated and the lists see exactly that table.
    write_table(stats.average_score(ratings), T_AVERAGE, sink)
    avg = read_table(spark, T_AVERAGE, sink)
    top = stats.genre_topn(movies, avg)
    write_table(_packed(top, "genres", "mid", "score") if packed else top, T_GENRES_TOP, sink)


def lfm_job(spark: SparkSession, source: dict, sink: dict, packed: bool = True,
            sim_top_n: int | None = None) -> None:
    """Train ALS once; write top-20 per user and item-item factor similarity."""
    ratings = read_table(spark, T_RATING, source)
    model = factor.train_als(ratings)
    recs = factor.als_user_recs(model)
    write_table(_packed(recs, "uid", "mid", "score") if packed else recs, T_USER_RECS, sink)
    sims = factor.factor_similarity(model)
    write_table(_similarity_lists(sims, packed and sim_top_n is not None, sim_top_n),
                T_MOVIE_RECS, sink)


def content_job(spark: SparkSession, source: dict, sink: dict, packed: bool = False,
                sim_top_n: int | None = None) -> None:
    """TF-IDF genre similarity between movies."""
    movies = read_table(spark, T_MOVIE, source)
    sims = content.content_similarity(movies)
    write_table(_similarity_lists(sims, packed, sim_top_n), T_CONTENT_RECS, sink)


def _similarity_lists(sims: DataFrame, packed: bool, top_n: int | None) -> DataFrame:
    order = [F.desc("sim"), F.asc("sim_mid")]
    ranked = distributed_rank(sims, ["mid"], order) if top_n is None else lists.top_k(sims, ["mid"], order, top_n)
    if not packed:
        return ranked.select("mid", "rank", "sim_mid", "sim")
    if top_n is None:
        raise ValueError("packed similarity lists need top_n (one row per item holds the list)")
    return _packed(ranked, "mid", "sim_mid", "sim")


def log_clean_job(spark: SparkSession, source: dict, sink: dict, checkpoint: str,
                  trigger: dict | None = None):
    """Stream: log lines -> rating messages (one text line each), to a format
    that the ``realtime`` job reads."""
    if sink.get("format") not in ("text", "kafka"):
        raise ValueError("rating messages are lines: give a text or kafka sink")
    from reelspark.streaming.logs import start_log_cleaning
    return start_log_cleaning(spark, source, sink, checkpoint, trigger)


def stored_similarities(spark: SparkSession, tables: dict) -> DataFrame:
    """``(mid, sim_mid, sim)`` from the stored lists of the ``lfm`` job, flat or packed."""
    stored = read_table(spark, T_MOVIE_RECS, tables)
    return sims_from_packed(stored) if "recs" in stored.columns else stored.select("mid", "sim_mid", "sim")


def realtime_job(spark: SparkSession, source: dict, tables: dict, sink: dict, checkpoint: str,
                 trigger: dict | None = None, similarity: str = "stored"):
    """Stream: rating messages -> per-event recommendations.

    Side tables come from ``tables``: the rating history (``rec_rating``,
    bucketed by user if written with ``write_side_table``), the seen pairs
    (the same ratings) and the stored item similarity (``rec_movie_movies``),
    or with ``similarity="content"`` the content similarity of ``rec_movie``
    (threshold 0.6, kept in factored form). Incoming ratings join the history
    of later batches. Results go to ``<sink>/rec_real_time/batch_id=N`` (one
    packed list per rating) and ``<sink>/rec_real_time_flat``.
    """
    from reelspark.streaming.realtime import start_realtime
    if sink.get("format", "parquet") != "parquet":
        raise ValueError("replayed batches overwrite their own folder: give a parquet sink")
    ratings = read_table(spark, T_RATING, tables)
    seen = ratings.select("uid", "mid", *(["uid_bucket"] if "uid_bucket" in ratings.columns else []))
    if similarity == "content":
        sims = content.content_sim_source(read_table(spark, T_MOVIE, tables), threshold=0.6,
                                          decimals=9).materialize(f"{checkpoint.rstrip('/')}-sims")
    else:
        sims = TableSims(stored_similarities(spark, tables), dedupe=True).materialize(f"{checkpoint.rstrip('/')}-sims")
    out = f"{sink['path'].rstrip('/')}/{T_REAL_TIME}"
    return start_realtime(spark, source, lambda: ratings, seen, sims, out + "_flat", checkpoint,
                          rejects_path=out + "_rejects", history_path=out + "_history",
                          trigger=trigger, lists_path=out)


def tune_job(spark: SparkSession, source: dict, sink: dict) -> None:
    """Hold-out RMSE of every ALS setting of the grid, the best one marked."""
    write_table(factor.als_grid_search(read_table(spark, T_RATING, source)), T_TUNING, sink)


_TABLE_KEYS = ("partition_column", "lower", "upper", "partitions", "batchsize")


def _target(spec: str, options: list[str] | None = None) -> dict:
    """``format:path`` and ``key=value`` options as a source or sink dict."""
    fmt, _, path = spec.partition(":")
    pairs = dict(o.split("=", 1) for o in options or [])
    if fmt == "jdbc":
        own = {k: v for k, v in pairs.items() if k in _TABLE_KEYS}
        return {"format": fmt, "url": path, **own,
                "properties": {k: v for k, v in pairs.items() if k not in _TABLE_KEYS}}
    return {"format": fmt, **({"path": path} if path else {}), "options": pairs}


def main(argv: list[str] | None = None) -> None:
    from reelspark.session import build_session
    ap = argparse.ArgumentParser(prog="reelspark.plans.jobs")
    ap.add_argument("job", choices=["load", "statistics", "lfm", "content", "tune", "log-clean", "realtime"])
    ap.add_argument("--tables", help="side tables of the realtime job")
    ap.add_argument("--checkpoint", help="stream checkpoint folder (shared storage)")
    ap.add_argument("--once", action="store_true", help="process what is available, then stop")
    ap.add_argument("--source", default=None)
    ap.add_argument("--sink", required=True)
    for name in ("source", "sink", "tables"):
        ap.add_argument(f"--{name}-option", action="append", metavar="KEY=VALUE")
    ap.add_argument("--similarity", choices=["stored", "content"], default="stored",
                    help="similarity of the realtime job")
    ap.add_argument("--top-n", type=int, help="cut similarity lists to this length (packed lists need it)")
    ap.add_argument("--movies")
    ap.add_argument("--ratings")
    ap.add_argument("--tags")
    ap.add_argument("--flat", action="store_true", help="write ranked rows instead of packed text")
    args = ap.parse_args(argv)
    shared = SparkSession.getActiveSession() is not None  # the caller's session stays open
    spark = build_session(app_name=f"reelspark-{args.job}")
    sink = _target(args.sink, args.sink_option)
    source = _target(args.source, args.source_option) if args.source else {}
    packed = not args.flat
    if args.job == "load":
        load_job(spark, args.movies, args.ratings, args.tags, sink)
    elif args.job == "statistics":
        statistics_job(spark, source, sink, packed=packed)
    elif args.job == "lfm":
        lfm_job(spark, source, sink, packed=packed, sim_top_n=args.top_n)
    elif args.job == "content":
        content_job(spark, source, sink, packed=packed and args.top_n is not None, sim_top_n=args.top_n)
    elif args.job == "tune":
        tune_job(spark, source, sink)
    else:
        trigger = {"availableNow": True} if args.once else None
        if args.job == "log-clean":
            q = log_clean_job(spark, source, sink, args.checkpoint, trigger)
        else:
            q = realtime_job(spark, source, _target(args.tables, args.tables_option), sink, args.checkpoint,
                             trigger, args.similarity)
        q.awaitTermination()
    if not shared:
        spark.stop()


if __name__ == "__main__":
    main()
