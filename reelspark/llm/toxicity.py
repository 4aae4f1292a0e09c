"""Toxicity by maximum-scoring segments.

Every token has a log-odds score learned from labelled documents. A token's
rate of toxic documents is shrunk by a Dirichlet prior towards that of its
prefixes of ``PREFIXES`` characters, those towards each other and the
shortest towards the corpus, so rare and unseen spellings of a known family
are scored too. Less a drift per token, a linear-time scan finds all maximal
scoring segments (the toxic passages). Under the clean documents' score
distribution the best segment of a text follows an extreme-value law: its
significance is ``rate * score - ln(length)``, minus the log of the number of
equally good segments a clean text would have by chance. A passage is
reported when its significance is above 0. The best significance and the
excess of all segments' scores over what clean text of that length brings go
through a logistic curve to a score between 0 and 1. The curve is fitted on
training rows whose counts are left out of the lexicon it is fitted with.

The model is fitted on at most about ``TRAIN_DOCS`` whole labelled documents
of each class (documented bound; fewer are all used), drawn by the hash of
their id, so its size has a bound too.

Defined results: null and empty texts score as a text without any segment;
without labelled rows of both classes every score is 0. A document labelled
twice counts under each label. Other columns pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashed_share, materialise, row_fraction

TRAIN_DOCS = 10_000
PREFIXES = (3, 4, 5, 6)
PRIOR = 2.0              # documents that a prior counts for
DRIFT = 1.0              # log-odds taken off every token
MIN_TOXIC_DOCS = 2
CURVE_SHARE = 0.3        # of the drawn rows, kept out of the lexicon behind the curve
THRESHOLD = 0.7
CACHE_WORDS = 500_000
_TOKEN = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """A token's prefixes, shortest first, then the token itself (marked)."""
    return [word[:k] for k in PREFIXES if len(word) > k] + ["=" + word]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score) in linear time.

    Each positive token opens a candidate. It joins the nearest earlier
    candidate of lower start total if that one's end total is lower too, and
    the joined candidate tries again. A candidate remembers the nearest earlier
    one of lower start total, so the search skips those between, which no later
    search looks at again. Without one, all candidates so far are final.
    """
    total = np.concatenate(([0.0], np.cumsum(scores)))
    done: list[list] = []
    out: list[list] = []        # first, end, total before it, total at its end, nearest lower start
    for at in np.flatnonzero(scores > 0).tolist():
        first, end, low, high, k = at, at + 1, float(total[at]), float(total[at + 1]), len(out) - 1
        while True:
            while k >= 0 and out[k][2] >= low:
                k = out[k][4]
            if k < 0:
                done += out
                out = [[first, end, low, high, -1]]
                break
            if out[k][3] >= high:
                out.append([first, end, low, high, k])
                break
            first, low, nearest = out[k][0], out[k][2], out[k][4]
            del out[k:]
            k = nearest
    return [(a, z, high - low) for a, z, low, high, _ in done + out]


class ToxicityModel:
    """Lexicon of log-odds, extreme-value rate, clean text's segment score
    per token, and calibration curve."""

    def __init__(self, lexicon: dict[str, float], rate: float, noise: float, curve: tuple[float, ...]):
        self.lexicon, self.rate, self.noise, self.curve = lexicon, rate, noise, curve
        self.words: dict[str, float] = {}

    def word_score(self, word: str) -> float:
        for f in reversed(features(word)):
            known = self.lexicon.get(f)
            if known is not None:
                return known
        return 0.0

    def token_scores(self, words: list[str]) -> np.ndarray:
        get = self.words.get
        values = list(map(get, words))
        at = -1
        for _ in range(values.count(None)):
            at = values.index(None, at + 1)
            w = words[at]
            score = get(w)
            if score is None:
                score = self.word_score(w)
                if len(w) <= 64:
                    if len(self.words) >= CACHE_WORDS:
                        self.words.clear()
                    self.words[w] = score
            values[at] = score
        return np.array(values) - DRIFT

    def scan(self, text: str | None) -> tuple[list[tuple[int, int, float]], float, float, int]:
        """(significant segments as first and end token and significance,
        best significance, total scaled score, number of tokens)."""
        scores = self.token_scores(_TOKEN.findall(text.lower())) if text else np.zeros(0)
        n = len(scores)
        least = float(np.log(n + 1.0))
        found = [(a, z, self.rate * s - least) for a, z, s in segments(scores)]
        best = max((s for _, _, s in found), default=-least)
        return [x for x in found if x[2] > 0], best, sum(s + least for _, _, s in found), n

    def inputs(self, best, total, n) -> np.ndarray:
        """Inputs of the curve: extreme value, and total above clean text's."""
        expected = self.noise * np.asarray(n, float)
        excess = (np.asarray(total, float) - expected) / np.sqrt(expected + 1)
        return np.column_stack([np.ones_like(excess), np.asarray(best, float), np.arcsinh(excess)])

    def score(self, best: list, total: list, n: list) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.inputs(best, total, n) @ np.array(self.curve), -30, 30)))


def _rate(scores: np.ndarray, weights: np.ndarray) -> float:
    """Positive root of sum(weights * exp(root * scores)) = 1."""
    low, high = 0.0, 1.0
    f = lambda x: float(weights @ np.exp(np.minimum(x * scores, 500))) - 1
    while f(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def _curve(m: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps with a small ridge."""
    w = np.zeros(m.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
        h = (m * (p * (1 - p))[:, None]).T @ m + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, m.T @ (y - p) - 1e-2 * w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(map(float, w))


def _lexicon(found: dict) -> tuple[dict[str, float], float]:
    """Log-odds per feature and the extreme-value rate from (toxic, clean)
    document counts; '' holds the documents and ' ' the distinct tokens."""
    toxic_docs, clean_docs = (max(n, 1) for n in found.get("", (1, 1)))
    clean_tokens = max(found.get(" ", (0, 1))[1], 1)
    weight = PRIOR / min(toxic_docs, clean_docs)
    lexicon = {}
    for f, (toxic, _) in found.items():
        if toxic < MIN_TOXIC_DOCS or f in ("", " "):
            continue
        word = f[1:] if f[0] == "=" else f
        rate_t, rate_c = 0.5, 0.5
        for g in [word[:k] for k in PREFIXES if k < len(word)] + [f]:
            t, c = found.get(g, (0, 0))
            t, c = t / toxic_docs, c / clean_docs
            rate_t, rate_c = (t + weight * rate_t) / (t + c + weight), (c + weight * rate_c) / (t + c + weight)
        lexicon[f] = float(np.log(rate_t / rate_c))
    own = [f for f in lexicon if f[0] == "="]
    share = np.array([(found[f][1] + 0.05) / clean_tokens for f in own])
    scores = np.array([lexicon[f] - DRIFT for f in own] + [-DRIFT])
    return lexicon, _rate(scores, np.append(share, max(0.0, 1 - share.sum())))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", id_col: str = "doc_id",
          train_docs: int = TRAIN_DOCS) -> ToxicityModel | None:
    """Fit on documents that ``labels`` (already limited to training rows) marks.

    The drawn labels have a proven bound and are broadcast; documents are
    never shuffled. Feature counts meet in a sum per feature.
    """
    marks = labels.select(id_col, label).where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).distinct()
    sizes = {r[label]: r["count"] for r in marks.groupBy(label).count().collect()}
    if len(sizes) < 2:
        return None
    share = F.when(F.col(label) == 1, row_fraction(train_docs, sizes[1])).otherwise(row_fraction(train_docs, sizes[0]))
    drawn = F.broadcast(marks.where(hashed_share(id_col, share, "toxicity")))
    sample = (docs.select(id_col, text).where(F.col(text).isNotNull()).join(drawn, id_col)
              .select(F.col(label).cast("int").alias("y"),
                      hashed_share(id_col, CURVE_SHARE, "toxicity-curve").cast("int").alias("part"),
                      F.col(text).alias("text")))
    sample = materialise(sample, "toxicity-sample")  # bounded; read three times

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for b in batches:
            for y, part, t in zip(*(c.to_pylist() for c in b.columns)):
                words = set(_TOKEN.findall(t.lower()))
                c = found.setdefault((y, part), Counter())
                c.update({f for w in words for f in features(w)})
                c[""] += 1
                c[" "] += len(words)
        for (y, part), c in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.string()), pa.array([y] * len(c), pa.int32()),
                 pa.array([part] * len(c), pa.int32()), pa.array(list(c.values()), pa.int64())],
                ["feature", "y", "part", "n"])

    def n(y: int, part: int):
        return F.sum(F.when((F.col("y") == y) & (F.col("part") == part), F.col("n")).otherwise(0))

    counts = (sample.mapInArrow(count, "feature string, y int, part int, n long").groupBy("feature")
              .agg(n(1, 0).alias("t0"), n(0, 0).alias("c0"), n(1, 1).alias("t1"), n(0, 1).alias("c1"))
              .where(F.col("t0") + F.col("t1") >= MIN_TOXIC_DOCS)
              .select("feature", *(F.col(c).cast("int") for c in ("t0", "c0", "t1", "c1"))).toPandas())
    rows = list(zip(*(counts[c].tolist() for c in ("feature", "t0", "c0", "t1", "c1"))))
    del counts

    def scanned(model: ToxicityModel):
        scan = evidence_udf(docs.sparkSession, model)(F.col("text"))
        x = sample.where("part = 1").select("y", scan.alias("s")).select("y", "s.best", "s.total", "s.n_tokens").toPandas()
        return (x[c].to_numpy(float) for c in ("y", "best", "total", "n_tokens"))

    model = ToxicityModel(*_lexicon({f: (t, c) for f, t, c, _, _ in rows}), 0.0, (0.0, 0.0, 0.0))
    y, best, total, tokens = scanned(model)
    noise = total[y == 0].sum() / max(tokens[y == 0].sum(), 1)
    model.noise = float(noise)
    curve = _curve(model.inputs(best, total, tokens), y)
    return ToxicityModel(*_lexicon({f: (t + u, c + d) for f, t, c, u, d in rows}), model.noise, curve)


def evidence_udf(spark, model: ToxicityModel | None):
    """Arrow UDF text -> struct(score, best, total, n_tokens, passages of token positions)."""
    shared = spark.sparkContext.broadcast(model and (model.lexicon, model.rate, model.noise, model.curve))

    @F.arrow_udf("struct<score double, best double, total double, n_tokens long, "
                 "passages array<struct<first: int, end: int, significance: double>>>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = ToxicityModel(*shared.value) if shared.value else None
        passage = pa.struct([("first", pa.int32()), ("end", pa.int32()), ("significance", pa.float64())])
        for b in batches:
            found = [m.scan(t) if m else ([], 0.0, 0.0, 0) for t in b.to_pylist()]
            spans, best, total, n = map(list, zip(*found)) if found else ([], [], [], [])
            yield pa.StructArray.from_arrays(
                [pa.array(m.score(best, total, n) if m and n else np.zeros(len(n))), pa.array(best, pa.float64()),
                 pa.array(total, pa.float64()), pa.array(n, pa.int64()),
                 pa.array([[dict(first=a, end=z, significance=s) for a, z, s in x] for x in spans], pa.list_(passage))],
                ["score", "best", "total", "n_tokens", "passages"])

    return score


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a struct column of the score, its inputs and the toxic passages."""
    return docs.withColumn(into, evidence_udf(docs.sparkSession, model)(F.col(text)))
