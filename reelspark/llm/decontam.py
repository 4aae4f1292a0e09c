"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item is cut into windows of ``WINDOW`` consecutive words (a
shorter item is one window). The join must find all document places that
contain a whole window. A window is a set of shingles (``SHINGLE`` consecutive
words, hashed); as containment must be complete, a prefix of one shingle in
the global order is enough, and rarity in the documents makes it the rarest
one. So only the rarest shingle of each window is joined with the document
shingles. Each match gives the place where its window would start: the
positional bound asks that it starts and ends inside the document (which
implies the length bound), and the words there are compared one by one.

Rarity is counted over all documents, with partial sums before the shuffle.
Window tables are small in practice but not by proof, so they are broadcast
only under ``BROADCAST_ROWS`` counted rows; beyond, document places are shuffled
without their words, which the matches then meet again by document.

Only DataFrame operations are used. Defined results: null texts have no
words, an item without words has no window. Rows that repeat an id are each
reported; equal rows are scanned together and repeated at the end. Items that
share a window are all reported, and item rows that repeat an id are one item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .linededup import lower_ascii

WINDOW = 13
SHINGLE = 3
MIN_SHARE = 20           # contaminated from 1/20 of the words on
BROADCAST_ROWS = 100_000  # of at most WINDOW words each
# Fixed value: everything that is not part of a word, after lower-casing.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text; empty for null."""
    cut = F.split(lower_ascii(F.coalesce(text, F.lit(""))), _GAP)
    return F.array_remove(cut, "")


def shingle_at(ws: Column, at: Column, size: int = SHINGLE) -> Column:
    """Hash of up to ``size`` words from place ``at`` on."""
    return F.xxhash64(*[F.get(ws, at + k) for k in range(size)])


def bounded(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has few rows, else as it is."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def bring_words(places: DataFrame, prefix: DataFrame, source: DataFrame) -> DataFrame:
    """Prefix matches of ``places`` with their documents' words, and a row
    without a match for each document, at the place after its last word. Places
    are shuffled as (document, place, token), words once per document."""
    hits = places.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "at", "token").join(prefix, "token")
    hits = hits.where("at >= offset").dropDuplicates(["_doc", "_hash", "at", "window_id"])
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("text_hash").eqNullSafe(F.col("_hash"))
    found = source.join(hits, same).drop("_doc", "_hash")
    return found.unionByName(source.withColumn("at", F.size("ws")), allowMissingColumns=True)


def item_windows(benchmark: DataFrame, text: str, id_col: str, window: int, size: int) -> tuple[DataFrame, DataFrame]:
    """(distinct windows ``window_id, win, offset, token`` with a row for each
    of their shingles, ``window_id, item_id``)."""
    items = (benchmark.select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text)).alias("ws"))
             .where(F.size("ws") > 0))
    starts = F.sequence(F.lit(0), F.greatest(F.size("ws") - window, F.lit(0)))
    cut = items.select("item_id", "ws", F.explode(starts).alias("at"))
    cut = cut.select("item_id", F.slice("ws", F.col("at") + 1, window).alias("win"))
    cut = cut.select("item_id", "win", F.xxhash64("win").alias("h1"), F.xxhash64(F.lit(1), "win").alias("h2"))
    cut = materialise(cut.select("item_id", "win", F.struct("h1", "h2").alias("window_id")), "item-windows")
    distinct = cut.groupBy("window_id").agg(F.first("win").alias("win"))
    offsets = F.sequence(F.lit(0), F.greatest(F.size("win") - size, F.lit(0)))
    tokens = distinct.select("window_id", "win", F.explode(offsets).alias("offset"))
    tokens = tokens.withColumn("token", shingle_at(F.col("win"), F.col("offset"), size))
    return tokens, cut.select("window_id", "item_id").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id", window: int = WINDOW,
                  shingle: int = SHINGLE) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, items, contaminated, spans``.

    ``items`` are the sorted ids of the items with occurring windows and
    ``spans`` the (start, end) places of the occurrences in words.
    """
    tokens, owners = item_windows(benchmark, item_text, item_id, window, shingle)
    tokens = materialise(tokens, "window-shingles")
    # Items of fewer words than a shingle have shorter tokens; look for those lengths too.
    lengths = sorted({min(r["n"], shingle) for r in tokens.select(F.least(F.size("win"), F.lit(shingle)).alias("n")).distinct().collect()})
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), words(F.col(text)).alias("ws"))

    def places(with_end: bool) -> DataFrame:
        """A row per document place; with_end adds one place after the last word."""
        last = F.size("ws") if with_end else F.size("ws") - 1
        at = F.sequence(F.lit(0), last) if with_end else F.when(F.size("ws") > 0, F.sequence(F.lit(0), last))
        rows = source.select("doc_id", "text_hash", "ws", F.explode(at).alias("at"))
        tokens_at = [shingle_at(F.col("ws"), F.col("at"), n) for n in lengths] or [F.lit(0).cast("long")]
        if len(tokens_at) == 1:
            return rows.withColumn("token", tokens_at[0])
        return rows.withColumn("token", F.explode(F.array_distinct(F.array(*tokens_at))))

    wanted = bounded(tokens.select("token").distinct())
    rarity = places(False).select("token").join(wanted, "token").groupBy("token").count()
    rarity = materialise(rarity, "shingle-rarity")
    # The rarest shingle of each window; a window with an absent shingle occurs nowhere.
    best = (tokens.join(rarity, "token", "left")
            .groupBy("window_id").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "offset", "token")).alias("p"),
                                      F.first("win").alias("win"))
            .where(F.col("p.n") > 0)
            .select("window_id", "win", F.col("p.offset").alias("offset"), F.col("p.token").alias("token")))
    best = materialise(best, "window-prefixes")
    prefix = bounded(best)
    matches = bring_words(places(False), best, source) if prefix is best else places(True).join(prefix, "token", "left")

    at_end = F.col("at") == F.size("ws")
    start = F.col("at") - F.col("offset")
    size = F.size("win")
    verified = (F.col("win").isNotNull() & (start >= 0) & (start + size <= F.size("ws"))
                & (F.slice("ws", F.greatest(start, F.lit(0)) + 1, size) == F.col("win")))
    found = (matches.where(at_end | verified)
             .select("doc_id", "text_hash", F.when(at_end, F.size("ws")).alias("n_words"),
                     F.when(verified, F.struct(start.alias("start"), (start + size).alias("end"))).alias("span"),
                     F.when(verified, F.col("window_id")).alias("window_id")))
    per_doc = found.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").cast("long").alias("n_words"), F.count("n_words").alias("copies"),
        F.array_sort(F.collect_set("span")).alias("spans"), F.collect_set("window_id").alias("windows"))
    per_doc = materialise(per_doc, "window-hits")
    items = (per_doc.select("doc_id", "text_hash", F.explode("windows").alias("window_id"))
             .join(owners, "window_id").groupBy("doc_id", "text_hash")
             .agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
        lambda acc, s: F.struct(F.greatest(acc["upto"], s["end"]).alias("upto"),
                                (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"], acc["upto"]), F.lit(0))).alias("n")),
        lambda acc: acc["n"].cast("long"))
    out = per_doc.alias("d").join(
        items.alias("i"), F.col("d.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("d.text_hash") == F.col("i.text_hash")), "left")
    out = out.select("d.doc_id", "d.text_hash", "d.n_words", covered.alias("n_hit"),
                     F.coalesce("i.items", F.array().cast("array<string>")).alias("items"), "d.spans",
                     F.explode(F.sequence(F.lit(1).cast("long"), F.col("d.copies"))).alias("copy"))
    return out.select("doc_id", "text_hash", "n_words", "n_hit", "items",
                      ((F.col("n_hit") > 0) & (F.col("n_hit") * MIN_SHARE >= F.col("n_words"))).alias("contaminated"), "spans")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    bad = contamination(docs, benchmark, text, id_col).where("contaminated").select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct()
    same = docs[id_col].eqNullSafe(bad["_doc"]) & (F.xxhash64(docs[text]) == bad["_hash"])
    return docs.join(bad, same, "left_anti")
