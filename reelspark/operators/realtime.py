"""Real-time scoring of incoming ratings (batch function; the stream wrapper
in ``reelspark.streaming.realtime`` calls it once per micro-batch).

For each incoming rating ``(event_id, uid, mid)``:

1. candidates: the items most similar to ``mid`` that the user has not seen,
   top ``n_candidates`` by similarity (ties: lower item id first);
2. recents: the user's last ``n_recent`` ratings from the history
   (``timestamp desc, event_id desc``);
3. per candidate ``q`` over the recents ``r`` with ``sim = sim(q, r)``
   (0 when the pair is not in the similarity table):
   ``score = sum(sim * R_r) / count(r) + log10(max(inc, 1)) - log10(max(dec, 1))``
   where ``inc`` / ``dec`` count recents with ``sim > 0.7`` and ``R_r > 3.0`` /
   ``R_r <= 3.0``.

Everything is an equi-join keyed by user or item: the static side tables
(seen pairs, history, similarities) are first semi-joined to the users and
items of the batch, so a micro-batch only touches the rows it needs and the
per-event work is bounded by ``n_candidates * n_recent``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.functions.lists import top_k
from reelspark.operators.simsource import as_source

# Fixed values equal to the reference's.
N_RECENT = 20          # recent ratings per user
N_CANDIDATES = 20      # similar unseen items per incoming rating
SIM_STRONG = 0.7       # a recent counts as (dis)liked-and-similar when sim > 0.7
LIKE_SCORE = 3.0       # liked when score > 3.0, else disliked


def recent_ratings(history: DataFrame, n_recent: int = N_RECENT,
                   users: DataFrame | None = None, with_rank: bool = False, with_time: bool = False) -> DataFrame:
    """Last ``n_recent`` ratings per user: ``(uid, r_mid, r_score)`` (plus
    ``r_rank``, 1 = newest, when ``with_rank``, and ``r_time`` when
    ``with_time``). Newest first by ``timestamp``, then ``event_id`` (if
    present), then ``mid``, ``score``.

    ``users`` (optional) restricts the history to those users first.
    """
    h = history
    if users is not None:
        h = h.join(users, "uid", "left_semi")
    # a total order, so a re-run task picks the same rows (event_id, when
    # present, already decides; mid and score only break remaining ties)
    order = ([F.desc("timestamp")] + ([F.desc("event_id")] if "event_id" in h.columns else [])
             + [F.asc("mid"), F.asc("score")])
    ranked = top_k(h.select("uid", "mid", "score", "timestamp",
                            *(["event_id"] if "event_id" in h.columns else [])),
                   ["uid"], order, n_recent, rank="r_rank")
    return ranked.select("uid", *(["r_rank"] if with_rank else []), *([F.col("timestamp").alias("r_time")] if with_time else []),
                         F.col("mid").alias("r_mid"), F.col("score").alias("r_score"))


def candidates(incoming: DataFrame, seen: DataFrame, sims, n_candidates: int = N_CANDIDATES) -> DataFrame:
    """The ``n_candidates`` most similar unseen items per incoming rating:
    ``(event_id, uid, cand)``.

    The N best unseen neighbours of an event lie within the first
    N + |distinct items seen by the user| ranks (exact; repeats of a pair do
    not widen the bound). Each batch item's neighbours are asked for up to the
    largest such bound of its events, and each event joins its own bound.
    """
    ev = incoming.select("event_id", "uid", "mid")
    # the filter side of a semi-join: duplicates do not change it, so no
    # distinct (and no extra shuffle) is needed
    seen_b = seen.select("uid", F.col("mid").alias("cand")).join(ev.select("uid"), "uid", "left_semi")
    n_seen = seen_b.distinct().groupBy("uid").agg(F.count(F.lit(1)).alias("n_seen"))
    lim = F.lit(n_candidates) + F.coalesce(F.col("n_seen"), F.lit(0))
    bounded = ev.join(n_seen, "uid", "left").withColumn("lim", lim)
    limits = bounded.groupBy("mid").agg(F.max("lim").alias("lim"))
    cands = (bounded.join(as_source(sims).top_neighbors(limits), "mid").where(F.col("nrank") <= F.col("lim"))
             .select("event_id", "uid", F.col("sim_mid").alias("cand"), "nrank")
             .join(seen_b, ["uid", "cand"], "left_anti"))
    return top_k(cands, ["event_id"], [F.asc("nrank")], n_candidates, rank="c_rank").select("event_id", "uid", "cand")


def score_candidates(pairs: DataFrame, sims, sim_strong: float = SIM_STRONG, like_score: float = LIKE_SCORE,
                     formula: str = "default") -> DataFrame:
    """``(event_id, uid, mid, score)`` from ``(event_id, uid, cand, r_mid,
    r_score)``: every candidate with each of the user's recent ratings."""
    x = as_source(sims).pair_sims(pairs, "cand", "r_mid", out="rsim")
    x = x.withColumn("rsim", F.coalesce("rsim", F.lit(0.0)))
    strong = F.col("rsim") > sim_strong
    agg = x.groupBy("event_id", "uid", "cand").agg(
        F.avg(F.col("rsim") * F.col("r_score")).alias("base"),
        F.count_if(strong & (F.col("r_score") > like_score)).alias("inc"),
        F.count_if(strong & (F.col("r_score") <= like_score)).alias("dec"))
    if formula == "default":
        score = (F.col("base") + F.log10(F.greatest("inc", F.lit(1)))
                 - F.log10(F.greatest("dec", F.lit(1))))
    elif formula == "as_coded":
        inner = F.when(F.col("dec") > 0, F.log10("dec"))
        score = F.when((F.col("inc") > 0) & inner.isNotNull(),
                       F.col("base") + F.log10(F.col("inc") - inner))
    else:
        raise ValueError(f"unknown formula {formula!r}")
    return agg.select("event_id", "uid", F.col("cand").alias("mid"), score.alias("score"))


def realtime_recs(incoming: DataFrame, history: DataFrame, seen: DataFrame, sims,
                  n_recent: int = N_RECENT, n_candidates: int = N_CANDIDATES,
                  sim_strong: float = SIM_STRONG, like_score: float = LIKE_SCORE,
                  formula: str = "default", spread: bool = True) -> DataFrame:
    """Score candidates for each incoming rating: ``(event_id, uid, mid, score)``.

    ``incoming`` = ``(event_id, uid, mid, ...)``; ``history`` =
    ``(uid, mid, score, timestamp[, event_id])``; ``seen`` = ``(uid, mid)``;
    ``sims`` = a ``(mid, sim_mid, sim)`` DataFrame or a similarity source
    (``reelspark.operators.simsource``). An incoming rating whose item has no
    similar unseen item, or whose user has no history, yields no row.
    ``formula='as_coded'`` returns the reference's nested logarithm
    ``log10(inc - log10(dec))``, NULL where the reference would fail.
    """
    sims = as_source(sims)
    # What a lookup needs to know of an item is joined to the candidates and to
    # the recents, not to every candidate x recent row.
    cands = sims.with_key(candidates(incoming, seen, sims, n_candidates), "cand", "a")
    recents = sims.with_key(recent_ratings(history, n_recent, incoming.select("uid")), "r_mid", "b")
    # The candidate rows are few next to what they expand to (x n_recent, then
    # the similarity lookups), so they are spread over every task slot by
    # event; the final per-(event, candidate) aggregate reuses that
    # partitioning without another exchange.
    if spread:
        cands = cands.repartition(incoming.sparkSession.sparkContext.defaultParallelism, "event_id")
    return score_candidates(cands.join(recents, "uid"), sims, sim_strong, like_score, formula)


def realtime_lists(recs: DataFrame, incoming: DataFrame) -> DataFrame:
    """One result row per incoming rating, as stored by the reference:
    ``(event_id, uid, movies)`` with ``movies`` = ``(mid,score)|...``, best
    score first (ties: lower id), and the empty text for a rating without any
    scored candidate. Each list holds at most ``n_candidates`` entries, so
    packing a group into one row is bounded."""
    from reelspark.functions.lists import collect_ranked, pack_list
    ranked = top_k(recs, ["event_id"], [F.desc("score"), F.asc("mid")], None)
    lists = collect_ranked(ranked, "event_id", "mid", "score")
    packed = lists.select("event_id", pack_list(F.col("recs")).alias("movies"))
    return (incoming.select("event_id", "uid").join(packed, "event_id", "left")
            .select("event_id", "uid", F.coalesce("movies", F.lit("")).alias("movies")))
