"""Bit-sliced scatter and whitening against exact integers and numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest

from reelspark.llm import queries, whitening
from tests.conftest import SF_SMALL


def exact(x):
    x = np.concatenate([x.astype(object), np.ones((len(x), 1), object)], axis=1)
    return x.T @ x


@pytest.mark.parametrize("low,high,shape", [(-160, 160, (1000, 16)), (-3, 3, (63, 5)), (0, 2, (64, 1)), (-2**62, 2**62, (70, 3))])
def test_block_scatter_is_exact(low, high, shape):
    x = np.random.default_rng(1).integers(low, high, shape)
    got, want = whitening.block_scatter(x), exact(x)
    assert all(got[p][q] == want[p][q] for p in range(len(want)) for q in range(p, len(want)))


def test_block_scatter_at_the_ends_of_long():
    x = np.array([[2**63 - 1, -2**63], [-2**63, 2**63 - 1], [0, 0]])
    got, want = whitening.block_scatter(x), exact(x)
    assert got[0][0] == want[0][0] and got[0][1] == want[0][1] and got[1][2] == want[1][2]


def brute(rows, k=4):
    """(id, component) -> values, computed with fractions and numpy's eigh."""
    xs = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows
          if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in xs})
    n, dim = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dim)]
    cov = [[Fraction(sum((n * x[p] - sums[p]) * (n * x[q] - sums[q]) for x in fit), n ** 3) for q in range(dim)] for p in range(dim)]
    values, axes = np.linalg.eigh(np.array([[float(c) for c in r] for r in cov]))
    trace = sum(cov[d][d] for d in range(dim))
    out = []
    for i, x in xs:
        y = np.array([float(Fraction(n * x[d] - sums[d], n)) for d in range(dim)])
        for c in range(min(k, dim)):
            out.append((i, c + 1, n, sum((n * x[d] - sums[d]) ** 2 for d in range(dim)),
                        y @ axes[:, -1 - c] / math.sqrt(values[-1 - c]), values[-1 - c] / float(trace)))
    return out


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((300, 6)) * [3, 2, 1.5, 1, .5, .2]
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(500 + k, base[0].tolist()) for k in range(200)]
    rows += [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5),
             (3, base[7].tolist()), (None, base[8].tolist()), (904, [-0.0] * 6)]
    d = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, component int")
    for name in ("x", "n", "dim", "p", "deviation"):
        d = d.selectExpr("*", f"'clash' AS {name}")
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], abs(r[4]))
    got = sorted(((r["vec_id"], r["component"], r["n"], int(r["deviation"]), r["whitened"], r["explained"], r["identity_error"])
                  for r in whitening.whiten(d).collect()), key=key)
    want = sorted(brute(rows), key=key)
    assert len(got) == len(want)
    sign = {}
    for g, w in zip(got, want):
        assert g[:4] == w[:4] and abs(g[5] / w[5] - 1) < 1e-9 and g[6] < 1e-9
        sign.setdefault(g[1], 1 if g[4] * w[4] > 0 else -1)
        assert g[4] == pytest.approx(sign[g[1]] * w[4], rel=1e-7, abs=1e-9)


def test_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    whiten = lambda rows: sorted(map(tuple, whitening.whiten(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert whiten([]) == [] and whiten([(1, None), (2, [float("nan")])]) == []
    one = whiten([(1, [0.5, 0.25]), (2, [0.5, 0.25])])  # one distinct vector: no variance
    assert [(r[0], r[1], r[2], r[3], r[4], r[5]) for r in one] == [(i, c, 1, "0", None, None) for i in (1, 2) for c in (1, 2)]
    flat = whiten([(1, [0.0, 0.5]), (2, [1.0, 0.5])])   # the second dimension has no variance
    assert [(r[0], r[1], r[3], r[4] and abs(round(r[4], 9)), r[5]) for r in flat] == [
        (1, 1, str(256 ** 2), 1.0, 1.0), (1, 2, str(256 ** 2), None, 0.0), (2, 1, str(256 ** 2), 1.0, 1.0), (2, 2, str(256 ** 2), None, 0.0)]
    mixed = whiten([(1, [0.0]), (2, [1.0]), (3, [1.0, 2.0]), (4, [])])
    assert [(r[0], r[1], r[3], r[4] is None) for r in mixed] == [
        (1, 1, str(256 ** 2), False), (2, 1, str(256 ** 2), False), (3, 1, None, True), (4, 1, None, True)]
    big = whiten([(1, [1e30, 0.0]), (2, [2.0 ** 50, 0.0]), (3, [-2.0 ** 50, 1.0])])  # beyond a long: no integer vector
    assert {r[0] for r in big} == {2, 3} and {r[3] for r in big} == {str(2 ** 118 + 256 ** 2)}


def test_registered_query_equals_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = queries.op12_embedding_whitening(spark, SF_SMALL).collect()
    want = {(r[0], r[1]): r for r in brute(rows)}
    assert len(got) == len(want) and {(r["vec_id"], r["component"]) for r in got} == set(want)
    for r in got:
        w = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == w[2:4] and abs(r["whitened"]) == pytest.approx(abs(w[4]), rel=1e-6, abs=1e-8)
        assert abs(r["explained"] / w[5] - 1) < 1e-9 and r["identity_error"] < 1e-4
