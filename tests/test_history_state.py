"""Recents in streaming state, the compacted history log, ranked lookups."""

import os
import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from reelspark.operators.ranking import distributed_rank
from reelspark.operators.realtime import realtime_recs
from reelspark.operators.simsource import FactoredSims, StoredSims, TableSims
from reelspark.sources.files import child_folders
from reelspark.streaming.history import HISTORY, HistoryLog
from reelspark.streaming.realtime import start_realtime
from tests.conftest import plan_text, session_conf

SIMS = "mid int, sim_mid int, sim double"


def sims_table(spark, items=40):
    rnd = random.Random(4)
    rows = [(a, b, round(0.5 + rnd.random() / 2, 2)) for a in range(items) for b in rnd.sample(range(items), 12) if a != b]
    return spark.createDataFrame(rows, SIMS)


def ratings(batch, n=30):
    rnd = random.Random(batch)  # user 1 sends a third of them; the same second may hold several
    return [(1 if k % 3 == 0 else rnd.randrange(2, 9), rnd.randrange(40), rnd.randrange(1, 11) / 2, 1000 * batch + k // 2)
            for k in range(n)]


def start(spark, src, dirs, hist, sims):
    return start_realtime(spark, {"format": "text", "path": src, "max_files_per_trigger": 1}, lambda: hist,
                          spark.createDataFrame([], "uid int, mid int"), sims, dirs["out"], dirs["ck"], rejects_path=dirs["rej"],
                          history_path=dirs["log"], lists_path=dirs["lists"], trigger={"availableNow": True}, n_recent=5)


def send(spark, src, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(src)


def test_stream_with_state_equals_three_dependent_batches(spark, tmp_dir):
    dirs = {n: os.path.join(tmp_dir, n) for n in ("out", "ck", "rej", "log", "lists", "src")}
    sims = sims_table(spark)
    old = [(u, m, s, t) for u, m, s, t in ratings(0, 60)]
    hist = spark.createDataFrame([(k, *r) for k, r in enumerate(old)], HISTORY)
    empty = spark.createDataFrame([], "uid int, mid int")
    past, want = list(old), []
    for b in (1, 2, 3):
        new = ratings(b)
        send(spark, dirs["src"], ["|".join(map(str, r)) for r in new] + ["no rating", "x|2|4"])
        start(spark, dirs["src"], dirs, hist if b == 1 else hist.limit(0), sims).awaitTermination(300)  # each a restart
        # The ids of the batch function rise in the order of (timestamp, item, score).
        order = sorted(range(len(new)), key=lambda k: (new[k][3], new[k][1], new[k][2]))
        incoming = spark.createDataFrame([(len(past) + i, *new[k]) for i, k in enumerate(order)], HISTORY)
        before = spark.createDataFrame([(k, *r) for k, r in enumerate(past)], HISTORY)
        recs = realtime_recs(incoming, before, empty, sims, n_recent=5).join(incoming.select("event_id", F.col("mid").alias("rated")), "event_id")
        want += [(b, r["uid"], r["rated"], r["mid"], round(r["score"], 9)) for r in recs.collect()]
        past += [new[k] for k in order]
    log = HistoryLog(spark, dirs["log"]).rows()
    assert log.count() == 90 and log.select("event_id").distinct().count() == 90
    got = spark.read.parquet(dirs["out"]).join(log.select("event_id", F.col("mid").alias("rated")), "event_id")
    assert sorted((r["batch_id"] + 1, r["uid"], r["rated"], r["mid"], round(r["score"], 9)) for r in got.collect()) == sorted(want)
    assert len(want) > 500
    assert spark.read.parquet(dirs["rej"]).count() == 6 and spark.read.parquet(dirs["lists"]).count() == 90

    # A batch whose commit is lost runs again from the state before it, with the same rows and ids.
    logged = sorted(map(tuple, log.collect()))
    state = lambda: [sorted(map(str, spark.read.parquet(dirs[n]).collect())) for n in ("out", "lists", "rej")]
    first = state()
    for name in ("2", ".2.crc"):
        os.remove(os.path.join(dirs["ck"], "commits", name))
    start(spark, dirs["src"], dirs, hist, sims).awaitTermination(300)
    assert state() == first
    assert sorted(map(tuple, HistoryLog(spark, dirs["log"]).rows().collect())) == logged


def test_history_log_stays_bounded_over_100_batches(spark, tmp_dir):
    log = HistoryLog(spark, os.path.join(tmp_dir, "log"), fanout=4)
    batch = lambda b, shift=0: spark.createDataFrame(
        [(b * 10 + k, (b * 7 + k) % 5, k + shift, 4.0, b) for k in range(b % 3)], HISTORY).coalesce(1)
    most, local = 0, {"spark.sql.shuffle.partitions": "1", "spark.sql.leafNodeDefaultParallelism": "1"}
    with session_conf(spark, local):
        for b in range(100):
            runs = log.append(b, batch(b))
            most = max(most, len(runs))
            if b in (37, 64):  # a replay, also with other rows or none
                log.append(b, batch(b, 100))
                assert log.rows().where(F.col("timestamp") == b).where("mid >= 100").count() == b % 3
                log.append(b, batch(b))
    assert most <= 3 * 4 and max(r.level for r in log.runs()) >= 3
    want = reduce(lambda x, y: x.unionByName(y), [batch(b) for b in range(100)])
    assert log.rows().count() == want.count() and log.rows().exceptAll(want).count() == 0
    assert log.rows(before=99).where("timestamp = 99").count() == 0
    files = log.rows().inputFiles()
    assert len(files) <= 12
    # Folders that are not named are gone, but for those of the batch before.
    assert len(child_folders(spark, log.path + "/_manifest")) == 2
    assert len(child_folders(spark, log.path + "/_runs")) + len(child_folders(spark, log.path)) <= 2 * 12 + 6
    # Runs are sorted by user.
    for run in log.runs():
        users = [r["uid"] for r in log._read([run]).collect()]
        assert users == sorted(users)


def test_rank_of_a_group_over_many_partitions(spark):
    rows = [(1, k, (k * 37 % 1000) / 1000) for k in range(3000)] + [(2, 5, 0.5)] + [(None, k, 0.1) for k in range(50)] + [(9, 1, 0.2)]
    df = spark.createDataFrame(rows, "mid int, sim_mid int, sim double").repartition(5)
    with session_conf(spark, {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        got = distributed_rank(df, ["mid"], [F.desc("sim"), F.asc("sim_mid")], "rank").collect()
    want = {}
    for key in {r[0] for r in rows}:
        for n, r in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: (-r[2], r[1])), 1):
            want[r[:2]] = n
    assert {(r["mid"], r["sim_mid"]): r["rank"] for r in got} == want and len(got) == len(rows)


def brute_top(pairs, limits):
    out = set()
    for mid, lim in limits:
        near = sorted(((-s, b) for a, b, s in pairs if a == mid and b != mid))[:lim]
        out |= {(mid, b, -s, n) for n, (s, b) in enumerate(near, 1)}
    return out


def top_rows(df):
    return {(r["mid"], r["sim_mid"], r["sim"], r["nrank"]) for r in df.collect()}


def test_rank_join_with_a_vector_of_a_third_of_the_catalogue(spark, monkeypatch):
    from reelspark.operators import simsource
    monkeypatch.setattr(simsource, "MEMBER_BLOCK", 16)
    rnd = random.Random(2)
    vector = {m: 0 if m % 3 == 0 else rnd.randrange(1, 30) for m in range(900)}
    sim = {(a, b): 1.0 if a == b else round(0.6 + 0.1 * ((a * b + a + b) % 4), 1) for a in range(30) for b in range(a + 1)}
    sim.update({(b, a): s for (a, b), s in list(sim.items())})
    members = spark.createDataFrame(list(vector.items()), "mid int, vkey int")
    vpairs = spark.createDataFrame([(a, b, s) for (a, b), s in sim.items()], "id_a int, id_b int, sim double")
    limits = [(0, 7), (3, 301), (4, 20), (5, 1), (899, 64), (12345, 3)]
    pairs = [(a, b, sim[vector[a], vector[b]]) for a in (0, 3, 4, 5, 899) for b in vector]
    asked = spark.createDataFrame(limits, "mid int, lim long")
    lazy = FactoredSims(members, vpairs)
    want = brute_top(pairs, limits)
    assert top_rows(lazy.top_neighbors(asked)) == want
    stored = lazy.materialize(buckets=8)
    assert top_rows(stored.top_neighbors(asked)) == want
    # Of 300 members of the large vector, an item that asks for one neighbour meets two.
    one = stored.top_neighbors(spark.createDataFrame([(3, 1)], "mid int, lim long"))
    assert one.count() == 1


def test_stored_similarity_is_joined_without_a_shuffle_of_the_table(spark, monkeypatch):
    from reelspark.operators import simsource
    table = sims_table(spark)
    stored = TableSims(table).materialize(buckets=4)
    assert isinstance(stored, StoredSims)
    pairs = [tuple(r) for r in table.collect()]
    limits = [(k, 1 + k % 14) for k in range(0, 45, 2)]
    asked = spark.createDataFrame(limits, "mid int, lim long")
    items = asked.select("mid")
    some = spark.createDataFrame([(k % 41, k % 37, k) for k in range(300)], "a int, b int, note int")
    looked = sorted((r["a"], r["b"], r["note"], r["sim"] or -1) for r in TableSims(table).pair_sims(some, "a", "b").collect())
    for literals in (1000, 3):  # with and without the items in the filter
        monkeypatch.setattr(simsource, "LITERALS", literals)
        with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
            top, near, sims = stored.top_neighbors(asked), stored.neighbors(items), stored.pair_sims(some, "a", "b")
            assert top_rows(top) == brute_top(pairs, limits)
            assert sorted(map(tuple, near.collect())) == sorted(p for p in pairs if p[0] % 2 == 0)
            assert sorted((r["a"], r["b"], r["note"], r["sim"] or -1) for r in sims.collect()) == looked
            for df in (top, near, sims):
                assert exchanged_scans(plan_text(df)) == 0
        if literals == 1000:
            assert "SelectedBucketsCount" in plan_text(stored.neighbors(items.where("mid = 4")))


def exchanged_scans(plan):
    """Scans of the stored table that have an exchange above them before a join."""
    bad, stack = 0, []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        while stack and stack[-1][0] >= depth:
            stack.pop()
        if "stored_sims_" in line and "FileScan" in line:
            above = [name for _, name in reversed(stack)]
            for name in above:
                if "Join" in name:
                    break
                bad += "Exchange" in name
        stack.append((depth, line))
    return bad


@pytest.mark.parametrize("kind", ["table", "stored"])
def test_lookup_of_nothing(spark, kind):
    table = sims_table(spark).limit(0)
    sims = TableSims(table) if kind == "table" else TableSims(table).materialize(buckets=2)
    none = spark.createDataFrame([], "mid int, lim long")
    assert sims.top_neighbors(none).collect() == [] and sims.neighbors(none).collect() == []
    assert sims.pair_sims(spark.createDataFrame([(None, 1)], "a int, b int"), "a", "b").collect()[0]["sim"] is None
