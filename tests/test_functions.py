from pyspark.sql import functions as F

from reelspark.functions import lists
from reelspark.functions.text import log_payload, parse_rating_message, rating_message_ok, split_genres
from reelspark.functions.time import ntz_epoch_seconds
from reelspark.operators.logs import log_rejects, log_to_ratings


def test_list_codec_round_trip(spark):
    df = spark.createDataFrame([("(2,4.5)|(3,5.0)",), ("",), (None,), ("(x,1.0)|(4,0.5)",)], "t string")
    out = df.select("t", lists.unpack_list(F.col("t")).alias("l"))
    got = [(r["t"], [(e["mid"], e["score"]) for e in r["l"]]) for r in out.collect()]
    assert got[0][1] == [(2, 4.5), (3, 5.0)]
    assert got[1][1] == [] and got[2][1] == []
    assert got[3][1] == [(4, 0.5)]
    back = out.select(lists.pack_list(F.col("l")).alias("p")).collect()
    assert back[0]["p"] == "(2,4.5)|(3,5.0)"


def test_pack_prints_jvm_doubles(spark):
    df = spark.createDataFrame([([(1, 0.0001), (2, 3.0)],)], "l array<struct<mid:int,score:double>>")
    assert df.select(lists.pack_list(F.col("l"))).first()[0] == "(1,1.0E-4)|(2,3.0)"


def test_parse_rating_message(spark):
    df = spark.createDataFrame([("1|2|4.0|99",), (" 1 | 2 | 4.0 | 99",), ("x|2|4",), ("",), ("1|2",)],
                               "m string")
    p = df.select(parse_rating_message("m").alias("p"))
    got = [(r["p"]["uid"], r["p"]["mid"], r["p"]["score"], r["p"]["timestamp"])
           for r in p.collect()]
    assert got[0] == (1, 2, 4.0, 99) and got[1] == (1, 2, 4.0, 99)
    ok = [r[0] for r in p.select(rating_message_ok(F.col("p"))).collect()]
    assert ok == [True, True, False, False, False]


def test_log_payload(spark):
    pre = "MOVIE_RATING_PREFIX:"
    df = spark.createDataFrame([
        (f"INFO a - {pre}1|2|3.0|4",),
        (f"x {pre} 1|2|3.0|4 {pre}tail",),
        (f"INFO {pre}",),
        ("INFO heartbeat",)], "value string")
    got = [r[0] for r in df.select(log_payload("value")).collect()]
    assert got == ["1|2|3.0|4", "1|2|3.0|4", "", None]
    ok = log_to_ratings(df).collect()
    assert [(r["uid"], r["mid"], r["score"]) for r in ok] == [(1, 2, 3.0), (1, 2, 3.0)]
    rej = log_rejects(df).collect()
    assert [r["message"] for r in rej] == [""]


def test_split_genres(spark):
    df = spark.createDataFrame([("A| B|A",), (None,), ("",), ("|x||",)], "g string")
    got = [r[0] for r in df.select(split_genres("g")).collect()]
    assert got == [["A", "B"], [], [], ["x"]]


def test_ntz_epoch_seconds_zone_free(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 0, 0, 0, 900000),)], "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ["UTC", "America/Los_Angeles"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert df.select(ntz_epoch_seconds("t")).first()[0] == 1577836800
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_sql_java_double_text_matches_spark(spark):
    import duckdb

    from reelspark.plans.oracle import java_double_text
    vals = [0.00057, 1e-6, 0.000123, -0.0005, 0.001, 0.0009999, 1e-4, 3.5, -0.25, 0.0,
            1.5e-7, 2.2e-5, 1.666667, 123456.789]
    con = duckdb.connect()
    duck = [r[0] for r in con.execute(
        "SELECT " + java_double_text("x") + " FROM (VALUES " +
        ",".join(f"({i}, {v!r}::DOUBLE)" for i, v in enumerate(vals)) + ") t(i, x) ORDER BY i").fetchall()]
    jvm = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "x double")
           .select(F.col("x").cast("string")).collect()]
    assert duck == jvm


def test_clean_log_lines_keep_unmatched_and_bytes(spark):
    from reelspark.operators.logs import clean_log_lines
    pre = "MOVIE_RATING_PREFIX:"
    df = spark.createDataFrame([(bytearray(f"INFO {pre}1|2|3.0|4".encode()),),
                                (bytearray(b"INFO heartbeat"),)], "value binary")
    kept = [r["message"] for r in clean_log_lines(df, keep_unmatched=True).collect()]
    assert kept == ["1|2|3.0|4", "INFO heartbeat"]
    dropped = [r["message"] for r in clean_log_lines(df).collect()]
    assert dropped == ["1|2|3.0|4"]


def test_parse_recent_entry(spark):
    from reelspark.functions.text import parse_recent_entry
    df = spark.createDataFrame([("1:3.0",), (" 2 : 4.5 ",), ("x:1",), ("7",)], "e string")
    got = [(r["p"]["mid"], r["p"]["score"]) for r in df.select(parse_recent_entry("e").alias("p")).collect()]
    assert got == [(1, 3.0), (2, 4.5), (None, 1.0), (7, None)]


def test_malformed_list_entries_are_listed(spark):
    df = spark.createDataFrame([("(1,2.5)|(x,1)|7",), (None,), ("",), ("(3,4.0)",)], "t string")
    got = [r[0] for r in df.select(lists.malformed_entries(F.col("t"))).collect()]
    assert got == [["(x,1)", "7"], [], [], []]
