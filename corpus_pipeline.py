"""Corpus pipeline: documents to token ids in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next stage's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.llm import bpe, decontam, langid, linededup, minhash
from reelspark.llm.common import hash_bucket, materialise, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents of unknown language: those without text or letters.

    Letters of no learned language are not told apart; they stay.
    """
    model = langid.train(docs.where(hash_bucket("doc_id", 5) != 0))
    into = f"language_{uuid.uuid4().hex}"  # a name that no column of the documents can have
    found = langid.identify(docs, model, into=into)
    return found.where(F.col(into)["lang_pred"] != langid.UNKNOWN).select(*[docs[c] for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated lines; ``n_chars`` follows the text."""
    # The other columns pass under names that the operator's own cannot have.
    aside = {c: f"column{k}_{uuid.uuid4().hex}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    out = linededup.dedup_lines(docs.withColumnsRenamed(aside))
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids`` and the text that the ids decode to."""
    out = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), lists=True)
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

# Language inference and BPE have no SQL form; tests hold every stage against
# a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
