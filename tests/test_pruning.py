"""Similarity that skips pairs must return the rows of the plain product."""
import numpy as np
import pytest

from reelspark.operators import pivots, similarity, sparse

SCHEMA = "id long, v array<double>"


def brute_force(vecs, threshold, include_self=False):
    m = np.array(list(vecs.values()))
    ids = np.array(list(vecs))
    norm = np.linalg.norm(m, axis=1)
    cos = np.round(m @ m.T / np.outer(np.where(norm > 0, norm, 1), np.where(norm > 0, norm, 1)), 12)
    hit = (cos > threshold) & (norm > 0)[:, None] & (norm > 0)[None, :]
    if not include_self:
        np.fill_diagonal(hit, False)
    return {(int(ids[i]), int(ids[j])): min(cos[i, j], 1.0) for i, j in zip(*np.nonzero(hit))}


def check(pairs, want):
    rows = pairs.collect()
    got = {(r["id_a"], r["id_b"]): r["sim"] for r in rows}
    assert len(got) == len(rows) and set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-11 for k in got)


def clustered(n=600, centres=12, dim=8, noise=0.05, seed=5, hot=0.0):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    at = np.where(rng.random(n) < hot, 0, rng.integers(0, centres, n))
    m = c[at] / np.linalg.norm(c[at], axis=1)[:, None] + noise * rng.normal(size=(n, dim))
    return {i: m[i] * rng.uniform(0.1, 10) for i in range(n)}


def frame(spark, vecs):
    return spark.createDataFrame([(k, [float(x) for x in v]) for k, v in vecs.items()], SCHEMA)


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_pivots_skip_block_pairs_and_lose_nothing(spark, hot):
    vecs = clustered(hot=hot)
    df = frame(spark, vecs)
    units = similarity.unit_vectors(df, "id", "v")
    dealt = similarity.pivot_routing(units, len(vecs), 8, 0.9, blocks=20)
    assert dealt is not None and dealt.skipped > dealt.pairs
    rows = dealt.routed.collect()
    assert len(rows) == len(vecs) and all(r["blk"] in r["others"] for r in rows)
    # a cell with 40 % of the rows is dealt to several blocks
    assert max(np.bincount([r["blk"] for r in rows])) < 100
    check(similarity.cosine_pairs(df, "id", "v", 0.9, block_size=60), brute_force(vecs, 0.9))


def test_pivots_exact_even_where_they_do_not_pay(spark, monkeypatch):
    rng = np.random.default_rng(11)
    vecs = {i: rng.normal(size=5) for i in range(200)} | {200 + i: np.eye(5)[0] for i in range(30)}
    df = frame(spark, vecs)
    units = similarity.unit_vectors(df, "id", "v")
    assert pivots.choose(units, 230, 5, 0.1, 20) is None      # nearly everything is in reach
    choose = pivots.choose
    monkeypatch.setattr(similarity.pivots, "choose", lambda *a: choose(*a[:5], 2.0))
    for t in (-0.2, 0.95):
        check(similarity.cosine_pairs(df, "id", "v", t, block_size=25, include_self=True), brute_force(vecs, t, True))


def test_equal_and_single_vectors_have_no_pivots(spark):
    same = {i: [1.0, 2.0] for i in range(50)}
    df = frame(spark, same)
    assert pivots.choose(similarity.unit_vectors(df, "id", "v"), 50, 2, 0.5, 10) is None
    assert similarity.cosine_pairs(df, "id", "v", 0.5, block_size=5).count() == 50 * 49
    assert similarity.cosine_pairs(df.limit(0), "id", "v", 0.5).count() == 0


def test_non_finite_vectors_pair_with_nothing(spark):
    vecs = clustered(n=200)
    odd = {1000: np.full(8, np.nan), 1001: np.r_[np.inf, np.zeros(7)], 1002: np.full(8, 1e200)}
    check(similarity.cosine_pairs(frame(spark, vecs | odd), "id", "v", 0.9, block_size=40), brute_force(vecs, 0.9))


def bags(n, places, seed, hot=False):
    """Sparse vectors; with ``hot``, a third of them have place 0 alone or first."""
    rng = np.random.default_rng(seed)
    out = {}
    for i in range(n):
        v = np.zeros(places)
        at = rng.choice(np.arange(1, places), rng.integers(1, 5), replace=False)
        v[at] = rng.choice([0.5, 1.0, 2.0, 3.1], len(at))
        if hot and i % 3 == 0:
            v[0] = rng.choice([1.0, 5.0])
        out[i] = v
    out[n] = np.zeros(places)
    return out


@pytest.mark.parametrize("threshold", [0.0, 0.6, 0.8, 0.999])
def test_sparse_pairs_equal_brute_force(spark, threshold):
    vecs = bags(250, 30, seed=2)
    check(sparse.sparse_cosine_pairs(frame(spark, vecs), "id", "v", threshold, include_self=True),
          brute_force(vecs, threshold, True))


def test_sparse_pairs_of_signed_dense_and_equal_vectors(spark):
    rng = np.random.default_rng(4)
    vecs = {i: rng.normal(size=6) for i in range(80)} | {80 + i: np.array([1.0, 0, 0, -2, 0, 0]) for i in range(20)}
    for t in (-0.5, 0.5):
        check(sparse.sparse_cosine_pairs(frame(spark, vecs), "id", "v", t), brute_force(vecs, t))


def test_hot_place_is_split_and_candidates_stay_below_all_pairs(spark):
    vecs = bags(400, 60, seed=9, hot=True)
    df = frame(spark, vecs)
    sizes = sparse.list_sizes(sparse.prefix_index(df, "id", "v", 0.8)[0])
    assert sparse.candidates(sizes) < 400 * 399 // 2 // 4
    check(sparse.sparse_cosine_pairs(df, "id", "v", 0.8, block_size=15), brute_force(vecs, 0.8))


def test_sparse_odd_input(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
                                (6, [2.0, 0.0]), (7, [None, 1.0])], SCHEMA)
    got = {(r[0], r[1]) for r in sparse.sparse_cosine_pairs(df, "id", "v", 0.5).collect()}
    assert got == {(1, 6), (6, 1)}
    assert sparse.sparse_cosine_pairs(df.limit(0), "id", "v", 0.5).count() == 0


def test_catalogue_candidates_below_all_pairs(spark):
    from pyspark.sql import functions as F

    from reelspark.operators import content
    from reelspark.sources.testdata import movies
    from tests.conftest import SF_SMALL
    vec = content.tfidf(movies(spark, SF_SMALL)).select("tfidf").distinct().withColumn("id", F.monotonically_increasing_id())
    vec = vec.checkpoint()
    index, _ = sparse.prefix_index(vec, "id", "tfidf", content.CONTENT_THRESHOLD)
    n = index.count()
    assert sparse.candidates(sparse.list_sizes(index)) < n * (n - 1) // 2
