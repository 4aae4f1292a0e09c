import os

import pytest

from pyspark.sql import functions as F

from reelspark.plans import jobs
from reelspark.sources import testdata as td
from reelspark.sources.files import read_table
from tests.conftest import SF_SMALL


def test_load_statistics_lfm_content_jobs(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "csv")
    movies = td.movies(spark, SF_SMALL)
    blank = F.lit(None).cast("string")
    (movies.select("mid", "name", blank, blank, blank, blank, blank, "genres", blank, blank)
     .write.option("sep", "^").csv(os.path.join(raw, "movies")))
    td.ratings_li(spark, SF_SMALL).write.csv(os.path.join(raw, "ratings"))
    td.tags(spark, SF_SMALL).write.csv(os.path.join(raw, "tags"))
    src = {"format": "parquet", "path": os.path.join(tmp_dir, "tables")}
    jobs.load_job(spark, os.path.join(raw, "movies"), os.path.join(raw, "ratings"),
                  os.path.join(raw, "tags"), src)
    assert read_table(spark, jobs.T_MOVIE, src).count() == movies.count()
    assert read_table(spark, jobs.T_MOVIE_TAGS, src).where("tags IS NOT NULL").count() > 0

    out = {"format": "parquet", "path": os.path.join(tmp_dir, "out")}
    jobs.statistics_job(spark, src, out)
    top = read_table(spark, jobs.T_GENRES_TOP, out)
    assert top.columns == ["genres", "recs"] and top.count() > 0
    assert top.where(~F.col("recs").rlike(r"^\(\d+,[0-9.E-]+\)(\|\(\d+,[0-9.E-]+\))*$")).count() == 0
    assert read_table(spark, jobs.T_RECENT_HOT, out).count() > 0

    jobs.lfm_job(spark, src, out)
    users = read_table(spark, jobs.T_USER_RECS, out)
    assert users.count() == read_table(spark, jobs.T_RATING, src).select("uid").distinct().count()
    assert set(read_table(spark, jobs.T_MOVIE_RECS, out).columns) == {"mid", "rank", "sim_mid", "sim"}

    jobs.content_job(spark, src, out)
    assert read_table(spark, jobs.T_CONTENT_RECS, out).count() > 0


def test_stream_jobs_once(spark, tmp_dir):
    from reelspark.sources.files import write_table
    raw = {"format": "parquet", "path": os.path.join(tmp_dir, "tables")}
    write_table(td.movies(spark, SF_SMALL), jobs.T_MOVIE, raw)
    write_table(td.ratings_ev(spark, SF_SMALL).drop("event_id"), jobs.T_RATING, raw)
    sims = spark.range(100).select(F.col("id").cast("int").alias("mid"),
                                   F.explode(F.sequence(F.lit(0), F.lit(99))).alias("sim_mid")).where("mid <> sim_mid")
    stored = sims.withColumn("sim", 1 / (1 + F.abs(F.col("mid") - F.col("sim_mid")))).withColumn("rank", F.lit(1))
    write_table(stored, jobs.T_MOVIE_RECS, raw)
    logs = os.path.join(tmp_dir, "logs")
    td.log_lines(spark, SF_SMALL).select("value").write.text(logs)
    msgs = {"format": "text", "path": os.path.join(tmp_dir, "msgs")}
    q = jobs.log_clean_job(spark, {"format": "text", "path": logs}, msgs,
                           os.path.join(tmp_dir, "ck1"), {"availableNow": True})
    q.awaitTermination(300)
    n_msgs = spark.read.text(msgs["path"]).count()
    assert n_msgs == td.log_lines(spark, SF_SMALL).where("value LIKE '%MOVIE_RATING_PREFIX:%'").count()
    out = {"format": "parquet", "path": os.path.join(tmp_dir, "out")}
    q = jobs.realtime_job(spark, msgs, raw, out, os.path.join(tmp_dir, "ck2"), {"availableNow": True})
    q.awaitTermination(300)
    recs = spark.read.parquet(os.path.join(out["path"], jobs.T_REAL_TIME + "_flat"))
    assert set(recs.columns) >= {"event_id", "uid", "mid", "score", "batch_id"}
    rows = spark.read.parquet(os.path.join(out["path"], jobs.T_REAL_TIME))
    assert rows.count() == n_msgs  # one list per rating, empty ones included
    assert rows.where("movies <> ''").count() == recs.select("event_id").distinct().count()


def test_message_sink_must_be_lines(spark, tmp_dir):
    with pytest.raises(ValueError):
        jobs.log_clean_job(spark, {"format": "text", "path": tmp_dir}, {"format": "parquet", "path": tmp_dir}, tmp_dir)


def test_documented_chain_through_main(spark, tmp_dir):
    from reelspark.sources.files import write_table
    at = lambda *n: os.path.join(tmp_dir, *n)
    raw = {"format": "parquet", "path": at("tables")}
    write_table(td.movies(spark, SF_SMALL), jobs.T_MOVIE, raw)
    write_table(td.ratings_ev(spark, SF_SMALL).drop("event_id"), jobs.T_RATING, raw)
    packed = spark.createDataFrame([(m, f"({(m + 1) % 100},0.9)|({(m + 2) % 100},0.8)") for m in range(100)], "mid int, recs string")
    write_table(packed, jobs.T_MOVIE_RECS, raw)
    spark.createDataFrame([("x MOVIE_RATING_PREFIX:1|5|4.0|9999999",), ("noise",)], "value string").write.text(at("logs"))
    jobs.main(["log-clean", "--source", f"text:{at('logs')}", "--sink", f"text:{at('msgs')}", "--checkpoint", at("c1"), "--once"])
    jobs.main(["realtime", "--source", f"text:{at('msgs')}", "--tables", f"parquet:{at('tables')}",
               "--sink", f"parquet:{at('out')}", "--checkpoint", at("c2"), "--once"])
    got = spark.read.parquet(at("out", jobs.T_REAL_TIME)).collect()
    assert [r["uid"] for r in got] == [1]


def test_targets_carry_options():
    t = jobs._target("jdbc:jdbc:derby:/db", ["partition_column=mid", "lower=0", "upper=9", "partitions=3", "user=u"])
    assert t == {"format": "jdbc", "url": "jdbc:derby:/db", "partition_column": "mid", "lower": "0", "upper": "9",
                 "partitions": "3", "properties": {"user": "u"}}
    k = jobs._target("kafka:", ["kafka.bootstrap.servers=h:9092", "subscribe=r"])
    assert k == {"format": "kafka", "options": {"kafka.bootstrap.servers": "h:9092", "subscribe": "r"}}
