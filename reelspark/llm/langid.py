"""Language identification by multilingual mixture inference.

A document is a mixture of languages: each of its letter trigrams comes from
one language drawn with the document's proportions. Trigram likelihoods per
language are learned from labelled rows; expectation-maximisation estimates a
document's proportions, and the set of languages is chosen by penalised
likelihood: starting from the best single language, the language with the
steepest likelihood gain joins while the gain exceeds ``penalty`` per language.

Trigrams are hashed to ``BUCKETS`` places, so the model has a fixed size of
``BUCKETS`` x languages. It is fitted on at most about ``TRAIN_DOCS`` whole
documents per language (documented bound; fewer rows are all used), drawn by
the hash of their id.

Defined results: a text that is null or has no letter is ``und`` with score
0; so is every text when no labelled row exists. Repeated rows are predicted
each; other columns pass through. Ties go to the language first by name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashed_share, row_fraction, slices

UNKNOWN = "und"
BUCKETS = 1 << 15
TRAIN_DOCS = 2_000
SMOOTHING = 0.5
PENALTY = 8.0        # log-likelihood units per extra language and log of trigrams
ROUNDS = 30
_WORDLIKE = re.compile(r"[^\W\d_]")
_SPACE = 0x20


def has_letter(text: str) -> bool:
    m = _WORDLIKE.search(text)
    return m is not None and (m[0].isalpha() or any(map(str.isalpha, text)))


def trigram_buckets(text: str) -> np.ndarray:
    """Hashed letter trigrams of a lower-cased text; runs of other characters
    count as one space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    letters = ((codes >= 0x61) & (codes <= 0x7A)) | ((codes >= 0xAA) & (codes != 0xD7) & (codes != 0xF7) &
                                                    ((codes < 0x2000) | (codes > 0x2BFF)))
    codes = np.where(letters, codes, _SPACE).astype(np.uint32)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE)
    c = np.concatenate(([_SPACE], codes[keep], [_SPACE])).astype(np.uint32)
    if len(c) < 3:
        return np.zeros(0, np.int64)
    h = (c[:-2] * np.uint32(0x9E3779B1)) ^ (c[1:-1] * np.uint32(0x85EBCA77)) ^ (c[2:] * np.uint32(0xC2B2AE3D))
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    return (h & np.uint32(BUCKETS - 1)).astype(np.int64)


class MixtureModel:
    """Languages in name order and their trigram log-likelihoods."""

    def __init__(self, languages: list[str], log_p: np.ndarray, penalty: float = PENALTY):
        self.languages, self.log_p, self.penalty = languages, log_p, penalty
        self.p = np.exp(log_p)

    def proportions(self, p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
        """EM estimate of the mixture over the columns of ``p``."""
        n = counts.sum()
        pi = np.full(p.shape[1], 1.0 / p.shape[1])
        last = -np.inf
        for _ in range(ROUNDS):
            mix = p @ pi
            like = float(counts @ np.log(mix))
            if like - last < 1e-6 * n:
                break
            last = like
            pi = pi * ((counts / mix) @ p) / n
        return pi, like

    def infer(self, text: str) -> tuple[list[int], np.ndarray, float]:
        """(languages, their proportions, score) of one text with letters."""
        ids, counts = np.unique(trigram_buckets(text), return_counts=True)
        counts = counts.astype(float)
        n = counts.sum()
        single = counts @ self.log_p[ids]
        best = int(single.argmax())
        # Trigrams overlap, so a third of them counts as evidence.
        z = np.exp((single - single[best]) / 3)
        chosen, pi, like = [best], np.ones(1), float(single[best])
        p = self.p[ids]
        while len(chosen) < len(self.languages):
            slope = (counts / (p[:, chosen] @ pi)) @ p / n
            slope[chosen] = 0
            add = int(slope.argmax())
            if slope[add] <= 1:
                break
            wider = [*chosen, add]
            pi2, like2 = self.proportions(p[:, wider], counts)
            if like2 - like < self.penalty * np.log1p(n):
                break
            chosen, pi, like = wider, pi2, like2
        if len(chosen) > 1:  # the largest share first
            order = sorted(range(len(chosen)), key=lambda k: (-pi[k], chosen[k]))
            chosen, pi = [chosen[k] for k in order], pi[order]
            return chosen, pi, float(pi[0])
        return chosen, pi, float(1 / z.sum())


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id",
          train_docs: int = TRAIN_DOCS) -> MixtureModel | None:
    """Fit the trigram likelihoods; None when there is no labelled text.

    Each task adds its documents to one table of counts; the tables meet in a
    sum over (language, bucket), whose size does not grow with the data.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[lang]: r["count"] for r in rows.groupBy(lang).count().collect()}
    if not counts:
        return None
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col(lang) == name, row_fraction(train_docs, n)).otherwise(share)
    sample = rows.where(hashed_share(id_col, share, "langid")).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    buckets = BUCKETS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict = {}
        for b in batches:
            for name, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if has_letter(t):
                    got = tables.setdefault(name, np.zeros(buckets, np.int64))
                    got += np.bincount(trigram_buckets(t), minlength=buckets)
        for name, got in tables.items():
            at = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(got[at])], ["lang", "bucket", "n"])

    total = (sample.mapInArrow(count, "lang string, bucket int, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    if total.empty:
        return None
    languages = sorted(total["lang"].unique())
    n = np.zeros((BUCKETS, len(languages)))
    n[total["bucket"].to_numpy(), [languages.index(x) for x in total["lang"]]] = total["n"]
    return MixtureModel(languages, np.log((n + SMOOTHING) / (n.sum(axis=0) + SMOOTHING * BUCKETS)))


def language_udf(spark, model: MixtureModel | None):
    """Arrow UDF text -> struct(lang_pred, score, languages, proportions)."""
    shared = spark.sparkContext.broadcast(model and (model.languages, model.log_p, model.penalty))

    @F.arrow_udf("struct<lang_pred string, score double, languages array<string>, proportions array<double>>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value and MixtureModel(*shared.value)
        for b in batches:
            pred, score, langs, shares = [], [], [], []
            for texts in slices(b.to_pylist()):
                for t in texts:
                    if m is None or t is None or not has_letter(t):
                        chosen, pi, s = [], [], 0.0
                    else:
                        chosen, pi, s = m.infer(t)
                    names = [m.languages[k] for k in chosen]
                    pred.append(names[0] if names else UNKNOWN)
                    score.append(min(1.0, max(0.0, s)))
                    langs.append(names)
                    shares.append([float(x) for x in pi])
            yield pa.StructArray.from_arrays(
                [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(langs, pa.list_(pa.string())),
                 pa.array(shares, pa.list_(pa.float64()))], ["lang_pred", "score", "languages", "proportions"])

    return predict


def identify(docs: DataFrame, model: MixtureModel | None, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct column of the inferred languages."""
    return docs.withColumn(into, language_udf(docs.sparkSession, model)(F.col(text)))

