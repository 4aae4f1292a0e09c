import numpy as np
import pytest

from reelspark.operators import content
from reelspark.operators.simsource import FactoredSims
from reelspark.operators.similarity import cosine_expr, cosine_link_counts, cosine_pairs


def brute_force(vecs, threshold, include_self=False):
    out = set()
    for i, a in vecs.items():
        for j, b in vecs.items():
            if i == j and not include_self:
                continue
            na, nb = np.linalg.norm(a), np.linalg.norm(b)
            if na == 0 or nb == 0:
                continue
            s = float(np.dot(a, b) / (na * nb))
            if s > threshold:
                out.add((i, j, round(min(s, 1.0), 9)))
    return out


@pytest.mark.parametrize("block_size", [1, 7, 64, 10_000])
def test_block_cosine_equals_brute_force(spark, block_size):
    rng = np.random.default_rng(3)
    vecs = {i: rng.normal(size=6) for i in range(40)}
    vecs[40] = np.zeros(6)                 # zero vector: no pair
    vecs[41] = vecs[3] * 2.0               # parallel to 3: sim 1
    df = spark.createDataFrame([(k, v.tolist()) for k, v in vecs.items()], "id long, v array<double>")
    got = {(r["id_a"], r["id_b"], round(r["sim"], 9))
           for r in cosine_pairs(df, "id", "v", 0.3, block_size=block_size).collect()}
    assert got == brute_force(vecs, 0.3)
    assert all(a != b for a, b, _ in got)
    assert (3, 41, 1.0) in got and (41, 3, 1.0) in got


def test_block_cosine_self_pairs_and_one_direction(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 0.0])], "id long, v array<double>")
    both = {(r[0], r[1]) for r in cosine_pairs(df, "id", "v", 0.5, include_self=True).collect()}
    assert both == {(1, 1), (2, 2), (1, 2), (2, 1)}
    one = {(r[0], r[1]) for r in cosine_pairs(df, "id", "v", 0.5, both_directions=False).collect()}
    assert len(one) == 1


def test_cosine_expr_zero_vector_is_null(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 4.0]), ([0.0, 0.0], [1.0, 1.0])],
                               "a array<double>, b array<double>")
    got = [r[0] for r in df.select(cosine_expr(df.a, df.b)).collect()]
    assert abs(got[0] - 1.0) < 1e-12 and got[1] is None


def test_content_similarity_distinct_vectors_and_zero_idf(spark):
    movies = spark.createDataFrame([
        (1, "Drama|Action"), (2, "Drama|Action"), (3, "Action|Drama"),  # equal vectors
        (4, "Comedy"), (5, None), (6, ""), (7, "Comedy|Drama")],
        "mid int, genres string")
    out = content.content_similarity(movies, threshold=0.8)
    got = {(r["mid"], r["sim_mid"]): r["sim"] for r in out.collect()}
    for a, b in [(1, 2), (2, 1), (1, 3), (3, 2)]:
        assert got[(a, b)] == 1.0
    assert all(a != b for a, b in got)
    assert not any(5 in k or 6 in k for k in got)


def test_content_similarity_term_in_all_documents(spark):
    # every document holds exactly the same single term: idf 0, zero vectors, no pair
    movies = spark.createDataFrame([(1, "Drama"), (2, "Drama"), (3, "drama")], "mid int, genres string")
    assert content.content_similarity(movies, threshold=0.0).count() == 0


def test_hashing_matches_sql_murmur3(spark):
    """HashingTF bucket of a term == the independent murmur3 of the oracle."""
    import duckdb

    from reelspark.plans import oracle
    terms = ["action", "drama", "", "sci-fi", "economy", "small", "abcd", "abcde", "é"]
    movies = spark.createDataFrame([(i, t) for i, t in enumerate(terms)], "mid int, genres string")
    from pyspark.ml.feature import HashingTF
    tf = HashingTF(inputCol="w", outputCol="f", numFeatures=50)
    df = movies.selectExpr("genres", "array(genres) AS w")
    spark_b = {r["genres"]: int(r["f"].indices[0]) for r in tf.transform(df).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE part AS SELECT * FROM (VALUES " + ",".join(
        f"({i}, '{t}', 'x')" for i, t in enumerate(terms)) + ") t(p_partkey, p_name, p_type)")
    # route each term through the oracle's token hashing
    sql = oracle.with_(*oracle.tfidf_ctes()[:13]).replace(
        "FROM movies WHERE genres IS NOT NULL AND genres <> ''",
        "FROM (SELECT p_partkey AS mid, p_name AS genres FROM part)") + " SELECT token, bucket FROM buckets"
    duck_b = dict(con.execute(sql).fetchall())
    assert spark_b["action"] == 33 and spark_b["drama"] == 44 and spark_b["sci-fi"] == 16
    for t in terms:
        if t:
            assert duck_b[t.lower()] == spark_b[t], t


def test_block_count_rule():
    from reelspark.operators.similarity import block_count
    assert block_count(100, 8, block_size=7) == 15          # fixed size wins
    assert block_count(20_000, 8) == 7                      # ~3 groups per slot
    assert block_count(300, 8) == 2                          # blocks not below MIN_BLOCK
    assert block_count(10_000_000, 8_000) == 220             # 45k vectors per block
    assert block_count(10_000_000, 8) == 200                 # memory bound: <= 50k per block


def test_product_blocks_copy_the_larger_side_least():
    from reelspark.operators.similarity import MAX_BLOCK, product_blocks
    bu, bi = product_blocks(100_000_000, 1_000_000, 8000)
    assert bu >= 100_000_000 / MAX_BLOCK and bi >= 1_000_000 / MAX_BLOCK
    assert bi < bu  # users (the larger side) are copied to fewer item blocks
    assert product_blocks(1000, 1000, 8) == (4, 4)
    assert product_blocks(100, 50, 8) == (1, 1)
    assert product_blocks(30, 50, 8, block_size=8) == (4, 7)
    # a costlier left copy moves blocks to the left side
    bl, br = product_blocks(20_000, 20_000, 8, left_weight=110, right_weight=50)
    assert bl > br and product_blocks(20_000, 20_000, 8) == (5, 5)


def test_product_blocks_respect_memory_cap_property():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from reelspark.operators.similarity import MAX_BLOCK, product_blocks

    @settings(max_examples=300, deadline=None)
    @given(st.integers(1, 10**9), st.integers(1, 10**9), st.integers(1, 20_000),
           st.floats(1, 1000), st.floats(1, 1000))
    def check(nl, nr, par, wl, wr):
        bl, br = product_blocks(nl, nr, par, left_weight=wl, right_weight=wr)
        assert bl >= 1 and br >= 1
        assert -(-nl // bl) <= MAX_BLOCK and -(-nr // br) <= MAX_BLOCK
    check()


def test_content_classes_give_back_every_item_pair(spark):
    movies = spark.createDataFrame(
        [(i, ["Drama|Action", "Action|Drama|Drama", "Comedy", "Comedy|Drama|Comedy"][i % 4]) for i in range(40)]
        + [(100, None), (101, "")], "mid int, genres string")
    pairs = {(r["mid"], r["sim_mid"]): r["sim"] for r in content.content_similarity(movies, threshold=0.8).collect()}
    rows = content.content_classes(movies, threshold=0.8).collect()
    members = [(r["mid"], r["class_id"]) for r in rows if r["kind"] == "item"]
    links = {(r["class_id"], r["sim_class"]): (r["sim"], r["n_items"]) for r in rows if r["kind"] == "link"}
    assert len(rows) == len(members) + len(links) <= 40 + 16 < len(pairs)
    assert {(a, b): links[x, y][0] for a, x in members for b, y in members if a != b and (x, y) in links} == pairs
    assert all(n == sum(y == c for _, c in members) for (_, y), (_, n) in links.items())


def test_scorer_looks_vectors_up_before_pairs(spark):
    """No join on an item's vector above the candidate x recent rows."""
    members = spark.createDataFrame([(1, "a"), (2, "b")], "mid int, vkey string")
    vpairs = spark.createDataFrame([("a", "a", 1.0), ("b", "b", 1.0), ("a", "b", 0.9), ("b", "a", 0.9)],
                                   "id_a string, id_b string, sim double")
    sims = FactoredSims(members, vpairs)
    cands = sims.with_key(spark.createDataFrame([(1,), (3,)], "cand int"), "cand", "a")
    both = cands.crossJoin(sims.with_key(spark.createDataFrame([(1,), (2,)], "r_mid int"), "r_mid", "b"))
    keyed = sims.pair_sims(both, "cand", "r_mid")
    plain = sims.pair_sims(both.select("cand", "r_mid"), "cand", "r_mid")
    got = sorted((r["cand"], r["r_mid"], str(r["sim"])) for r in keyed.select("cand", "r_mid", "sim").collect())
    assert got == sorted((r["cand"], r["r_mid"], str(r["sim"])) for r in plain.collect())
    assert got == [(1, 1, "None"), (1, 2, "0.9"), (3, 1, "None"), (3, 2, "None")]


@pytest.mark.parametrize("threshold, seed", [(0.6, 1), (0.9, 2), (-0.2, 3)])
def test_link_counts_equal_brute_force(spark, threshold, seed):
    rng = np.random.default_rng(seed)
    vecs = {int(i): rng.normal(size=4) for i in rng.permutation(90)}
    vecs[200], vecs[201], vecs[202] = np.zeros(4), vecs[5] * 2, vecs[5]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in vecs.items()], "id int, v array<double>")
    near = {}
    for r in cosine_pairs(df, "id", "v", threshold).collect():
        near.setdefault(r["id_a"], set()).add(r["id_b"])

    def least(i):
        todo, done = [i], {i}
        while todo:
            new = near.get(todo.pop(), set()) - done
            done |= new
            todo += new
        return min(done)
    got = {r["id"]: (r["class_id"], r["n_links"]) for r in cosine_link_counts(df, "id", "v", threshold, block_size=17).collect()}
    assert got == {i: (least(i), len(near.get(i, ()))) for i in vecs}


def test_a_product_step_holds_few_cells():
    """Executor memory: a worker's score chunk and blocks are small next to 4 GB on four cores."""
    from reelspark.operators import similarity
    assert similarity.CHUNK_CELLS * 8 <= 16 << 20 and similarity.BLOCK_BYTES <= 32 << 20
    bu, bi = similarity.product_blocks(1_000_000, 1_000_000, 12, max_block=1_000)
    assert bu >= 1_000 and bi >= 1_000


def test_links_of_few_candidates_touch_only_those(monkeypatch):
    """One product's links, taken from its candidates or from whole matrices: same counts and classes, and
    with few candidates no matrix is counted along its rows."""
    import pandas as pd
    from reelspark.operators import similarity
    rng = np.random.default_rng(12)
    v = rng.normal(size=(120, 6))
    v[70] = v[3] * 1.0
    v /= np.linalg.norm(v, axis=1)[:, None]
    pdf = pd.DataFrame({"blk": [0] * 60 + [1] * 60, "id": rng.permutation(120), "u": list(v)})
    whole, counted = [], np.count_nonzero

    def links(key, sparse):
        whole.clear()
        monkeypatch.setattr(similarity, "SPARSE_LINKS", sparse)
        monkeypatch.setattr(np, "count_nonzero", lambda a, axis=None: whole.append(axis) or counted(a, axis=axis))
        out = pd.concat(similarity.block_links_fn(0.7)(key, iter([pdf])))
        monkeypatch.setattr(np, "count_nonzero", counted)
        return sorted(out.itertuples(index=False, name=None))
    for key in ((0, 0), (0, 1)):
        few = links(key, 0)
        assert few and whole == [None]           # rows and columns of the product are not counted
        assert few == links(key, 1 << 30) and 1 in whole
