"""DuckDB SQL for the same computations, used as the independent oracle.

Written directly against the raw test tables (views ``lineitem``, ``orders``,
``part``, ``events``, ``embeddings`` ...), with the fixture mapping inlined as
CTEs. Nothing here calls Spark.
"""

from __future__ import annotations

# ---- fixture mapping (same as reelspark.sources.testdata) -----------------

RATINGS_LI = """
ratings AS (
  SELECT CAST(o_custkey AS INT) AS uid, CAST(l_partkey AS INT) AS mid,
         ceil(l_quantity / 5) / 2 AS score,
         CAST(floor(epoch(l_shipdate)) AS INT) AS timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

MOVIES = """
movies AS (
  SELECT CAST(p_partkey AS INT) AS mid, p_name AS name,
         concat_ws('|', p_type, replace(p_name, ' ', '|')) AS genres
  FROM part)"""

RATINGS_EV = """
ratings_ev AS (
  SELECT event_id, CAST(user_id AS INT) AS uid,
         CAST(json_extract_string(props, '$.k') AS INT) AS mid,
         CAST(CASE event_type WHEN 'purchase' THEN 5.0 WHEN 'click' THEN 3.5
              WHEN 'view' THEN 3.0 WHEN 'signup' THEN 2.0 ELSE 1.0 END AS DOUBLE) AS score,
         CAST(floor(epoch(ts)) AS INT) AS timestamp
  FROM events)"""

TAGS = """
tags AS (
  SELECT CAST(user_id AS INT) AS uid,
         CAST(json_extract_string(props, '$.k') AS INT) AS mid,
         event_type AS tag, CAST(floor(epoch(ts)) AS INT) AS timestamp
  FROM events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


HISTORY_HOT = with_(RATINGS_LI) + """
SELECT mid, count(mid) AS count FROM ratings WHERE score >= 3.0 GROUP BY mid"""

RECENT_HOT = with_(RATINGS_LI) + """
SELECT mid, yearmonth, count(mid) AS count FROM (
  SELECT mid, CAST(year(make_timestamp(CAST(timestamp AS BIGINT) * 1000000)) * 100
                   + month(make_timestamp(CAST(timestamp AS BIGINT) * 1000000)) AS INT) AS yearmonth
  FROM ratings) GROUP BY yearmonth, mid"""

AVERAGE_SCORE = with_(RATINGS_LI) + """
SELECT mid, avg(score) AS score FROM ratings GROUP BY mid"""

_GENRE_BASE = with_(RATINGS_LI, MOVIES, """
avg_scores AS (SELECT mid, avg(score) AS score FROM ratings GROUP BY mid)""", """
vocab AS (
  SELECT DISTINCT trim(g) AS genre FROM movies, unnest(string_split(genres, '|')) AS t(g)
  WHERE genres IS NOT NULL AND trim(g) <> '')""", """
rated AS (SELECT m.mid, m.genres, a.score FROM movies m JOIN avg_scores a ON m.mid = a.mid
          WHERE m.genres IS NOT NULL)""")

GENRE_TOPN = _GENRE_BASE + """
SELECT genres, CAST(rank AS INTEGER) AS rank, mid, score FROM (
  SELECT v.genre AS genres, r.mid, r.score,
         row_number() OVER (PARTITION BY v.genre ORDER BY r.score DESC, r.mid ASC) AS rank
  FROM vocab v JOIN rated r ON contains(r.genres, v.genre))
WHERE rank <= 10"""

GENRE_TOPN_TOKEN = _GENRE_BASE + """
SELECT genres, CAST(rank AS INTEGER) AS rank, mid, score FROM (
  SELECT p.genre AS genres, p.mid, p.score,
         row_number() OVER (PARTITION BY p.genre ORDER BY p.score DESC, p.mid ASC) AS rank
  FROM (SELECT DISTINCT r.mid, r.score, trim(g) AS genre
        FROM rated r, unnest(string_split(r.genres, '|')) AS t(g) WHERE trim(g) <> '') p)
WHERE rank <= 10"""

MOVIE_TAGS = with_(MOVIES, TAGS) + """
SELECT m.mid, m.name, m.genres, t.tags FROM movies m LEFT JOIN (
  SELECT mid, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags
  FROM tags WHERE tag IS NOT NULL GROUP BY mid) t ON m.mid = t.mid"""


def java_double_text(x: str) -> str:
    """SQL text of a DOUBLE as the JVM prints it (``Double.toString``) for
    |x| < 1e7: plain decimal from 1e-3 up, ``d.dddE-n`` below. The digits
    are DuckDB's shortest round-trip digits."""
    a = f"CAST(abs({x}) AS VARCHAR)"
    sci_m = f"replace(split_part({a}, 'e', 1), '.', '')"
    sci = (f"left({sci_m}, 1) || '.' || coalesce(nullif(substr({sci_m}, 2), ''), '0') || 'E' || "
           f"CAST(CAST(split_part({a}, 'e', 2) AS INTEGER) AS VARCHAR)")
    frac = f"split_part({a}, '.', 2)"
    digits = f"ltrim({frac}, '0')"
    plain = (f"left({digits}, 1) || '.' || coalesce(nullif(substr({digits}, 2), ''), '0') || 'E-' || "
             f"CAST(length({frac}) - length({digits}) + 1 AS VARCHAR)")
    return (f"(CASE WHEN {x} = 0 OR abs({x}) >= 0.001 THEN CAST({x} AS VARCHAR) "
            f"ELSE (CASE WHEN {x} < 0 THEN '-' ELSE '' END) || "
            f"(CASE WHEN contains({a}, 'e') THEN {sci} ELSE {plain} END) END)")


# ---- hashed TF-IDF (independent murmur3-32, seed 42, as HashingTF uses) ----

_M = "4294967296"


def _mul(x: str, c: int) -> str:
    return f"CAST((CAST({x} AS HUGEINT) * {c}) % {_M} AS BIGINT)"


def _rotl(x: str, r: int) -> str:
    return f"(((({x}) << {r}) | (({x}) >> {32 - r})) & 4294967295)"


def _mixk(k: str) -> str:
    return _mul(_rotl(_mul(k, 0xCC9E2D51), 15), 0x1B873593)


def _mixh(h: str, k: str) -> str:
    return f"((({_rotl(f'xor({h}, {k})', 13)}) * 5 + {0xE6546B64}) % {_M})"


def _byte(idx: str) -> str:
    return f"CAST(('0x' || substr(hx, 2 * ({idx}) + 1, 2)) AS BIGINT)"


def _word(i: str) -> str:
    return (f"({_byte(f'4*{i}')} | ({_byte(f'4*{i}+1')} << 8) | ({_byte(f'4*{i}+2')} << 16)"
            f" | ({_byte(f'4*{i}+3')} << 24))")


def tfidf_ctes(num_features: int = 50) -> list[str]:
    """CTEs ``docs``, ``w(mid, bucket, w)`` and ``nrm(mid, nrm)`` over ``movies``."""
    return [f"""
docs AS (SELECT mid, string_split(rtrim(lower(replace(genres, '|', ' ')), ' '), ' ') AS words
         FROM movies WHERE genres IS NOT NULL AND genres <> '')""", """
dw AS (SELECT mid, w FROM docs, unnest(words) AS t(w))""", """
tokens AS (SELECT DISTINCT w AS token FROM dw)""", """
tb AS (SELECT token, octet_length(encode(token)) AS n, hex(encode(token)) AS hx FROM tokens)""", f"""
tk AS (SELECT token, n,
  list_reduce(list_prepend(CAST(42 AS BIGINT),
      list_transform(range(n // 4), lambda i: {_mixk(_word('i'))})),
    lambda h, k: {_mixh('h', 'k')}) AS h0,
  list_reduce(list_prepend(CAST(0 AS BIGINT),
      list_transform(range(n % 4), lambda j: {_byte('(n // 4) * 4 + j')} << (8 * j))),
    lambda a, x: a | x) AS tail
  FROM tb)""", f"""
th AS (SELECT token, xor(xor(h0, {_mixk('tail')}), n) AS h FROM tk)""", """
f1 AS (SELECT token, xor(h, h >> 16) AS h FROM th)""", f"""
f2 AS (SELECT token, {_mul('h', 0x85EBCA6B)} AS h FROM f1)""", """
f3 AS (SELECT token, xor(h, h >> 13) AS h FROM f2)""", f"""
f4 AS (SELECT token, {_mul('h', 0xC2B2AE35)} AS h FROM f3)""", """
f5 AS (SELECT token, xor(h, h >> 16) AS h FROM f4)""", f"""
buckets AS (SELECT token,
  (((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % {num_features}) + {num_features})
   % {num_features} AS bucket FROM f5)""", """
tf AS (SELECT dw.mid, b.bucket, CAST(count(*) AS DOUBLE) AS tf
       FROM dw JOIN buckets b ON b.token = dw.w GROUP BY dw.mid, b.bucket)""", """
ndocs AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM docs)""", """
dfreq AS (SELECT bucket, CAST(count(*) AS DOUBLE) AS df FROM tf GROUP BY bucket)""", """
w AS (SELECT tf.mid, tf.bucket, tf.tf * ln((ndocs.m + 1) / (dfreq.df + 1)) AS w
      FROM tf JOIN dfreq ON tf.bucket = dfreq.bucket CROSS JOIN ndocs)""", """
nrm AS (SELECT mid, sqrt(sum(w * w)) AS nrm FROM w GROUP BY mid)"""]


def content_pairs_ctes(threshold: float, decimals: int = 6) -> list[str]:
    """Adds ``sims(mid, sim_mid, sim)``: ordered pairs with cosine > threshold."""
    return tfidf_ctes() + [f"""
dots AS (SELECT a.mid AS mid, b.mid AS sim_mid, sum(a.w * b.w) AS dot
         FROM w a JOIN w b ON a.bucket = b.bucket AND a.mid <> b.mid GROUP BY a.mid, b.mid)""", f"""
sims AS (SELECT d.mid, d.sim_mid, round(round(d.dot / (na.nrm * nb.nrm), 12), {decimals}) AS sim
         FROM dots d JOIN nrm na ON na.mid = d.mid JOIN nrm nb ON nb.mid = d.sim_mid
         WHERE na.nrm * nb.nrm > 0 AND round(d.dot / (na.nrm * nb.nrm), 12) > {threshold})"""]


CONTENT_SIMILARITY = with_(MOVIES, *content_pairs_ctes(0.8)) + """
SELECT mid, sim_mid, sim FROM sims"""

CONTENT_SIMILARITY_LISTS = with_(MOVIES, *content_pairs_ctes(0.8)) + """
SELECT mid, sim_mid, sim, CAST(row_number() OVER (PARTITION BY mid ORDER BY sim DESC, sim_mid) AS BIGINT) AS rank FROM sims"""

HOLDOUT_ROWS = with_(RATINGS_LI) + """
SELECT uid, mid, score, repeat,
       CAST('0x' || md5(concat_ws(',', '42', uid, mid, repeat))[1:8] AS BIGINT) < 3435973836 AS is_train
FROM (SELECT uid, mid, score, CAST(row_number() OVER (PARTITION BY uid, mid ORDER BY score) AS INTEGER) AS repeat FROM ratings)"""

HASHED_BUCKETS = with_(MOVIES, *tfidf_ctes()) + """
SELECT token, bucket FROM buckets"""

ITEM_SIMILARITY = """
WITH v AS (SELECT CAST(vec_id AS BIGINT) AS mid, CAST(embedding AS DOUBLE[]) AS e,
                  sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n
           FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT a.mid AS mid, b.mid AS sim_mid, list_dot_product(a.e, b.e) / (a.n * b.n) AS s
      FROM v a JOIN v b ON a.mid <> b.mid WHERE a.n > 0 AND b.n > 0)
SELECT mid, sim_mid, round(round(s, 12), 6) AS sim FROM p WHERE round(s, 12) > 0.3"""

LOG_LINES = """
lines AS (
  SELECT event_id,
         CASE WHEN event_id % 2 = 0
              THEN 'INFO svc - MOVIE_RATING_PREFIX:' || uid || '|' || mid || '|' || score || '|' || timestamp
              ELSE 'INFO svc - heartbeat' END AS value
  FROM ratings_ev)"""

LOG_TO_RATINGS = with_(RATINGS_EV, LOG_LINES, """
msgs AS (SELECT trim(split_part(value, 'MOVIE_RATING_PREFIX:', 2)) AS message
         FROM lines WHERE contains(value, 'MOVIE_RATING_PREFIX:'))""", """
parsed AS (SELECT message,
  TRY_CAST(trim(split_part(message, '|', 1)) AS INT) AS uid,
  TRY_CAST(trim(split_part(message, '|', 2)) AS INT) AS mid,
  TRY_CAST(trim(split_part(message, '|', 3)) AS DOUBLE) AS score,
  TRY_CAST(trim(split_part(message, '|', 4)) AS INT) AS timestamp
  FROM msgs)""") + """
SELECT message, uid, mid, score, timestamp FROM parsed
WHERE uid IS NOT NULL AND mid IS NOT NULL AND score IS NOT NULL"""

REALTIME_RECS = with_(RATINGS_EV, MOVIES, *content_pairs_ctes(0.6, 9), """
cuts AS (SELECT min(timestamp) + CAST(floor((max(timestamp) - min(timestamp)) * 0.9) AS INT) AS c
         FROM ratings_ev)""", """
seen AS (SELECT DISTINCT r.uid, r.mid FROM ratings_ev r, cuts WHERE r.timestamp < cuts.c)""", """
hist AS (SELECT r.* FROM ratings_ev r, cuts WHERE r.timestamp < cuts.c)""", """
inc AS (SELECT r.* FROM ratings_ev r, cuts WHERE r.timestamp >= cuts.c)""", """
cand AS (SELECT event_id, uid, cand FROM (
  SELECT i.event_id, i.uid, s.sim_mid AS cand,
         row_number() OVER (PARTITION BY i.event_id ORDER BY s.sim DESC, s.sim_mid ASC) AS rn
  FROM inc i JOIN sims s ON s.mid = i.mid
  WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.uid = i.uid AND seen.mid = s.sim_mid))
  WHERE rn <= 20)""", """
rec AS (SELECT uid, mid AS r_mid, score AS r_score FROM (
  SELECT h.uid, h.mid, h.score,
         row_number() OVER (PARTITION BY h.uid ORDER BY h.timestamp DESC, h.event_id DESC) AS rn
  FROM hist h) WHERE rn <= 20)""", """
x AS (SELECT c.event_id, c.uid, c.cand, r.r_score, coalesce(s.sim, 0.0) AS sim
      FROM cand c JOIN rec r ON r.uid = c.uid
      LEFT JOIN sims s ON s.mid = c.cand AND s.sim_mid = r.r_mid)""") + """
SELECT event_id, uid, cand AS mid,
       round(avg(sim * r_score)
             + log10(greatest(count_if(sim > 0.7 AND r_score > 3.0), 1))
             - log10(greatest(count_if(sim > 0.7 AND r_score <= 3.0), 1)), 6) AS score
FROM x GROUP BY event_id, uid, cand"""

REALTIME_RECS_AS_CODED = REALTIME_RECS.replace("""SELECT event_id, uid, cand AS mid,
       round(avg(sim * r_score)
             + log10(greatest(count_if(sim > 0.7 AND r_score > 3.0), 1))
             - log10(greatest(count_if(sim > 0.7 AND r_score <= 3.0), 1)), 6) AS score
FROM x GROUP BY event_id, uid, cand""", """SELECT event_id, uid, mid,
       round(CASE WHEN inc > 0 AND dec > 0 AND inc - log10(dec) > 0
                  THEN base + log10(inc - log10(dec)) END, 6) AS score
FROM (SELECT event_id, uid, cand AS mid, avg(sim * r_score) AS base,
             count_if(sim > 0.7 AND r_score > 3.0) AS inc,
             count_if(sim > 0.7 AND r_score <= 3.0) AS dec
      FROM x GROUP BY event_id, uid, cand)""")

RMSE_ITEM_MEAN = with_(RATINGS_LI, """
avg_s AS (SELECT mid, avg(score) AS prediction FROM ratings GROUP BY mid)""", """
pred AS (SELECT p.uid, p.mid, a.prediction FROM (SELECT DISTINCT uid, mid FROM ratings) p
         JOIN avg_s a ON a.mid = p.mid)""") + """
SELECT round(sqrt(avg(pow(r.score - p.prediction, 2))), 6) AS rmse, count(*) AS n
FROM ratings r JOIN pred p ON r.uid = p.uid AND r.mid = p.mid"""

PACK_RECS = "WITH flat AS (" + GENRE_TOPN + """)
SELECT genres, string_agg('(' || CAST(mid AS VARCHAR) || ',' || """ + java_double_text("score") + """ || ')', '|'
                          ORDER BY rank) AS recs
FROM flat GROUP BY genres"""

REALTIME_LISTS = "WITH recs AS (" + REALTIME_RECS + "),\n" + with_(RATINGS_EV)[5:].rstrip() + """,
cut AS (SELECT min(timestamp) + CAST(floor((max(timestamp) - min(timestamp)) * 0.9) AS INT) AS c FROM ratings_ev),
inc AS (SELECT event_id, uid FROM ratings_ev, cut WHERE timestamp >= cut.c),
lists AS (SELECT event_id,
       string_agg('(' || CAST(mid AS VARCHAR) || ',' || """ + java_double_text("score") + """ || ')', '|'
                  ORDER BY score DESC, mid ASC) AS movies
FROM recs GROUP BY event_id)
SELECT inc.event_id, inc.uid, coalesce(movies, '') AS movies FROM inc LEFT JOIN lists USING (event_id)"""

LOG_MESSAGES_KEEP_UNMATCHED = with_(RATINGS_EV, LOG_LINES) + """
SELECT event_id,
       CASE WHEN contains(value, 'MOVIE_RATING_PREFIX:')
            THEN trim(split_part(value, 'MOVIE_RATING_PREFIX:', 2)) ELSE value END AS message
FROM lines"""

GENRE_VOCABULARY = with_(MOVIES) + """
SELECT DISTINCT trim(g) AS genre FROM movies, unnest(string_split(genres, '|')) AS t(g)
WHERE genres IS NOT NULL AND trim(g) <> ''"""

RECENT_RATINGS = with_(RATINGS_EV) + """
SELECT uid, CAST(r_rank AS INTEGER) AS r_rank, mid AS r_mid, score AS r_score FROM (
  SELECT uid, mid, score,
         row_number() OVER (PARTITION BY uid ORDER BY timestamp DESC, event_id DESC) AS r_rank
  FROM ratings_ev) WHERE r_rank <= 20"""

CONTENT_TFIDF = with_(MOVIES, *tfidf_ctes()) + """
SELECT mid, CAST(bucket AS INTEGER) AS bucket, round(w, 6) AS weight FROM w WHERE w <> 0"""

FACTOR_TOPK = """
WITH v AS (SELECT CAST(vec_id AS INT) AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT u.id AS uid, i.id AS mid, round(list_dot_product(u.e, i.e), 12) AS score FROM v u, v i)
SELECT uid, CAST(rank AS INTEGER) AS rank, mid, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid ASC) AS rank FROM p) WHERE rank <= 20"""

FACTOR_PREDICT = with_(RATINGS_EV) + """
SELECT r.uid, r.mid, round(list_dot_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])), 6) AS prediction
FROM (SELECT DISTINCT uid, mid FROM ratings_ev) r
JOIN embeddings u ON u.vec_id = r.uid JOIN embeddings i ON i.vec_id = r.mid"""

ALS_RECS_CHECK = with_(RATINGS_LI) + """
SELECT uid, least(20, (SELECT count(DISTINCT mid) FROM ratings)) AS n, true AS ok FROM (SELECT DISTINCT uid FROM ratings)"""

ALS_USER_OPTIMALITY = with_(RATINGS_LI) + """
SELECT uid, count(*) AS n, true AS ok FROM ratings GROUP BY uid"""

CONTENT_VECTOR_PAIRS = with_(MOVIES, *content_pairs_ctes(0.8)) + """
, sizes AS (SELECT mid, count(*) AS n_similar FROM sims GROUP BY mid)
SELECT m.mid, coalesce(s.n_similar, 0) AS n_similar FROM (SELECT mid FROM docs) m LEFT JOIN sizes s USING (mid)
WHERE EXISTS (SELECT 1 FROM nrm WHERE nrm.mid = m.mid AND nrm.nrm > 0)"""

MOVIE_TAG_PAIRS = with_(MOVIES, TAGS) + """
SELECT DISTINCT m.mid, t.tag FROM movies m JOIN tags t ON t.mid = m.mid WHERE t.tag IS NOT NULL"""
