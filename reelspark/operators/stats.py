"""Offline statistics: hot items, monthly hot items, mean scores, top-N per
genre, and the movie-with-tags view.

All are single aggregation plans: Spark's partial (map-side) aggregation runs
before the shuffle, so a hot item costs one pre-aggregated row per map task,
not one row per rating. Ties are always broken by ``mid`` so results are
deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.functions.lists import top_k
from reelspark.functions.text import split_genres
from reelspark.functions.time import epoch_to_yearmonth

# Fixed values equal to the reference's.
HOT_MIN_SCORE = 3.0     # history-hot keeps ratings with score >= 3.0
GENRE_TOP_N = 10        # list length per genre


def history_hot(ratings: DataFrame, min_score: float = HOT_MIN_SCORE,
                ordered: bool = True) -> DataFrame:
    """Ratings per movie among ratings with ``score >= min_score``."""
    out = (ratings.where(F.col("score") >= min_score)
           .groupBy("mid").agg(F.count("mid").alias("count")))
    return out.orderBy(F.desc("count"), "mid") if ordered else out


def recent_hot(ratings: DataFrame, ordered: bool = True) -> DataFrame:
    """Ratings per (UTC month, movie); newest month first."""
    out = (ratings.select("mid", epoch_to_yearmonth("timestamp").alias("yearmonth"))
           .groupBy("yearmonth", "mid").agg(F.count("mid").alias("count"))
           .select("mid", "yearmonth", "count"))
    return out.orderBy(F.desc("yearmonth"), F.desc("count"), "mid") if ordered else out


def average_score(ratings: DataFrame, ordered: bool = True) -> DataFrame:
    """Mean score per movie."""
    out = ratings.groupBy("mid").agg(F.avg("score").alias("score"))
    return out.orderBy(F.desc("score"), "mid") if ordered else out


def genre_vocabulary(movies: DataFrame) -> DataFrame:
    """Distinct trimmed, non-empty genre names over the whole catalogue."""
    return movies.select(F.explode(split_genres("genres")).alias("genre")).distinct()


def _substring_matches(genre_strings: DataFrame, vocab: DataFrame) -> DataFrame:
    """(string_key, genre) where genre is a substring of the keyed string.

    The reference tests ``genres.contains(genre)`` for every (genre, movie)
    pair. We turn that theta join into an equi-join: the substrings of each
    *distinct* genre string are generated for the lengths that occur among
    genre names only, and joined on equality with the vocabulary. A string of
    n characters gives at most n pieces per occurring length, rows carry the
    string's key instead of the string, and no pair of tables is enumerated.
    """
    lengths = sorted(r[0] for r in vocab.select(F.length("genre")).distinct().collect())
    keyed = genre_strings.select(string_key("genres").alias("string_key"), "genres")
    if not lengths:
        return keyed.select("string_key", F.lit(None).cast("string").alias("genre")).limit(0)
    # One row per (string, length, place), so no row holds a string's pieces.
    sized = (keyed.select("string_key", "genres", F.explode(F.array(*(F.lit(n) for n in lengths))).alias("n"))
             .where(F.length("genres") >= F.col("n")))
    places = sized.select("string_key", "genres", "n", F.explode(F.sequence(F.lit(1), F.length("genres") - F.col("n") + 1)).alias("at"))
    all_pieces = places.select("string_key", F.substring("genres", F.col("at"), F.col("n")).alias("genre"))
    return all_pieces.join(vocab, "genre").select("string_key", "genre").distinct()


def string_key(col: str):
    """A 256-bit key that stands for a genre string in joins."""
    return F.sha2(F.col(col).cast("binary"), 256)


def genre_topn(movies: DataFrame, avg_scores: DataFrame, n: int = GENRE_TOP_N,
               match: str = "substring") -> DataFrame:
    """Top ``n`` rated movies per genre by mean score, flat rows.

    Output ``(genres, rank, mid, score)``: ``genres`` is the genre name.
    ``match='substring'`` reproduces the reference (a genre matches when it
    is a case-sensitive substring of the movie's genre string, so ``old``
    matches ``cold``); ``match='token'`` matches whole genre entries only.
    Unrated movies are absent (inner join with the mean scores).
    """
    rated = (movies.where(F.col("genres").isNotNull()).select("mid", "genres")
             .join(avg_scores.select("mid", "score"), "mid"))
    if match == "token":
        pairs = rated.select(F.explode(split_genres("genres")).alias("genre"), "mid", "score")
    elif match == "substring":
        vocab = genre_vocabulary(movies)
        # The mapping (genre string -> matching genres) is built from the
        # catalogue alone, so the ratings are scanned once (for the means).
        strings = movies.where(F.col("genres").isNotNull()).select("genres").distinct()
        mapping = _substring_matches(strings, vocab)
        pairs = (rated.withColumn("string_key", string_key("genres")).join(mapping, "string_key")
                 .select("genre", "mid", "score"))
    else:
        raise ValueError(f"unknown match mode {match!r}")
    ranked = top_k(pairs, ["genre"], [F.desc("score"), F.asc("mid")], n)
    return ranked.select(F.col("genre").alias("genres"), "rank", "mid", "score")


def movie_tags(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """Movies left-joined with their distinct tags, sorted and joined by ``|``.

    ``collect_set`` is merged map-side, so a heavily tagged movie ships its
    distinct tags only. Distinctness is case-sensitive (``A|a``).
    """
    per_movie = (tags.where(F.col("tag").isNotNull())
                 .groupBy("mid")
                 .agg(F.concat_ws("|", F.array_sort(F.collect_set("tag"))).alias("tags")))
    return movies.join(per_movie, "mid", "left")


def movie_tag_pairs(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """The distinct tags of movies as flat ``(mid, tag)`` rows, for movies
    whose tags are too many for one text."""
    return (tags.where(F.col("tag").isNotNull()).select("mid", "tag").distinct()
            .join(movies.select("mid"), "mid", "left_semi"))
