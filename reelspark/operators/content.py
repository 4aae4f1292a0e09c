"""Content-based item similarity: TF-IDF over genre words, cosine pairs.

Pipeline (pyspark.ml): genres with ``|`` replaced by spaces -> ``Tokenizer``
(lower-case, split on whitespace) -> ``HashingTF`` (50 buckets, collisions are
part of the result) -> ``IDF`` fitted on the whole catalogue.

Scale: items with the same hashed term counts have the same TF-IDF vector,
and catalogues repeat genre combinations heavily (at sf0.01, 2,000 items share
a few hundred vectors). Pairs are computed once per pair of *distinct*
vectors, found by the places that they share (``sparse.py``), and then expanded
to items, so the compared pairs are some of the pairs of distinct vectors.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.operators.simsource import FactoredSims
from reelspark.operators.sparse import sparse_cosine_pairs

# Fixed values equal to the reference's.
TFIDF_FEATURES = 50          # hashed feature dimension
CONTENT_THRESHOLD = 0.8      # strict: sim > 0.8


def tfidf(movies: DataFrame, num_features: int = TFIDF_FEATURES) -> DataFrame:
    """``(mid, genres)`` -> ``(mid, tf, tfidf)`` as arrays of doubles.

    Movies with NULL or empty genres carry no document (no vector, no pair,
    no error) and do not count in the IDF.
    """
    docs = (movies.where(F.col("genres").isNotNull() & (F.col("genres") != ""))
            .select("mid", F.translate("genres", "|", " ").alias("text")))
    pipe = Pipeline(stages=[
        Tokenizer(inputCol="text", outputCol="words"),
        HashingTF(inputCol="words", outputCol="raw", numFeatures=num_features),
        IDF(inputCol="raw", outputCol="features"),
    ])
    model = pipe.fit(docs)
    out = model.transform(docs)
    return out.select("mid", vector_to_array("raw").alias("tf"),
                      vector_to_array("features").alias("tfidf"))


def tfidf_long(movies: DataFrame, num_features: int = TFIDF_FEATURES) -> DataFrame:
    """Non-zero TF-IDF weights in long form: ``(mid, bucket, weight)``."""
    vec = tfidf(movies, num_features)
    e = vec.select("mid", F.posexplode("tfidf").alias("bucket", "weight"))
    return e.where(F.col("weight") != 0.0)


def content_sim_source(movies: DataFrame, threshold: float = CONTENT_THRESHOLD,
                       num_features: int = TFIDF_FEATURES, block_size: int | None = None,
                       decimals: int | None = None) -> FactoredSims:
    """Content similarity in factored form: ``members(mid, vkey)`` and cosine
    pairs between distinct vectors (self-pairs included, so items sharing a
    vector are neighbours with sim 1)."""
    vec = tfidf(movies, num_features)
    # Exact key of a distinct vector: its non-zero hashed term counts as text,
    # ``bucket:count`` by bucket, so it stays short however wide the vectors are.
    counted = F.filter(F.transform("tf", lambda c, b: F.when(c != 0, F.concat_ws(":", b, c.cast("long")))), lambda t: t.isNotNull())
    keyed = vec.select("mid", F.concat_ws(",", counted).alias("vkey"), "tfidf")
    distinct = keyed.select("vkey", "tfidf").distinct()
    pairs = sparse_cosine_pairs(distinct, "vkey", "tfidf", threshold, block_size=block_size,
                                include_self=True, both_directions=True)
    return FactoredSims(keyed.select("mid", "vkey"), pairs, decimals)


def content_similarity(movies: DataFrame, threshold: float = CONTENT_THRESHOLD,
                       num_features: int = TFIDF_FEATURES, block_size: int | None = None,
                       decimals: int | None = 9) -> DataFrame:
    """Ordered item pairs ``(mid, sim_mid, sim)`` with cosine ``> threshold``.

    No self-pairs; two distinct items with the same non-zero vector pair with
    sim 1. ``decimals`` rounds the reported similarity (the filter uses the
    unrounded value). The expansion from vector pairs to item pairs is the
    output itself; its size is the answer's size.
    """
    return content_sim_source(movies, threshold, num_features, block_size, decimals).as_table()


def content_similarity_lists(movies: DataFrame, threshold: float = CONTENT_THRESHOLD,
                             num_features: int = TFIDF_FEATURES, block_size: int | None = None,
                             decimals: int | None = 9) -> DataFrame:
    """The rows of ``content_similarity`` with their ``rank`` in the item's list."""
    return content_sim_source(movies, threshold, num_features, block_size, decimals).ranked_table()


def content_classes(movies: DataFrame, threshold: float = CONTENT_THRESHOLD,
                    num_features: int = TFIDF_FEATURES, block_size: int | None = None,
                    decimals: int | None = 9) -> DataFrame:
    """Content similarity without expanding copies: ``(kind, mid, class_id,
    sim_class, sim, n_items)``.

    Items with the same non-zero vector form a class, named by its hashed term
    counts. A row of kind ``item`` puts an item in its class; one of kind
    ``link`` links two classes with cosine ``> threshold`` (both orders; a class
    also with itself), with the first one's smallest item and the number of
    items of ``sim_class``. The pairs of ``content_similarity`` are those of the
    members, without self-pairs.
    """
    return content_sim_source(movies, threshold, num_features, block_size, decimals).as_classes()
