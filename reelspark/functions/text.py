"""Text parsing: genre lists, rating messages, log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
# Marker in front of a rating message inside an application log line.
RATING_PREFIX = "MOVIE_RATING_PREFIX:"
# Separator of the fields of a rating message ``uid|mid|score|timestamp``
# and of the entries of a genre string ``Action|Adventure``.
FIELD_SEP = "|"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_genres(c: Column | str) -> Column:
    """``'A| B|A'`` -> ``['A', 'B']``: split on ``|``, trim, drop empty, distinct.

    NULL input gives an empty array, never an error.
    """
    parts = F.split(F.coalesce(_col(c), F.lit("")), r"\|")
    trimmed = F.transform(parts, lambda x: F.trim(x))
    return F.array_distinct(F.filter(trimmed, lambda x: x != F.lit("")))


def log_payload(c: Column | str, prefix: str = RATING_PREFIX) -> Column:
    """Text between the first and the second occurrence of ``prefix``, trimmed.

    NULL when the prefix is absent; ``''`` when it ends the line (callers
    treat both as a reject).
    """
    c = _col(c)
    parts = F.split(c, "\\Q" + prefix + "\\E", -1)
    return F.when(F.contains(c, F.lit(prefix)), F.trim(F.element_at(parts, 2)))


def parse_rating_message(c: Column | str) -> Column:
    """Parse ``uid|mid|score|timestamp`` into a struct of typed fields.

    Fields are trimmed and cast with ``try_cast``: a malformed field becomes
    NULL instead of failing the task. The fourth field is optional and, as in
    the reference, not needed for scoring; it is kept when it parses.
    """
    parts = F.split(_col(c), r"\|", -1)

    def field(i: int, typ: str) -> Column:
        return F.trim(F.get(parts, i)).try_cast(typ)

    return F.struct(
        field(0, "int").alias("uid"),
        field(1, "int").alias("mid"),
        field(2, "double").alias("score"),
        field(3, "int").alias("timestamp"),
    )


def rating_message_ok(parsed: Column) -> Column:
    """A parsed message is usable when uid, mid and score are all present."""
    return parsed["uid"].isNotNull() & parsed["mid"].isNotNull() & parsed["score"].isNotNull()


def format_rating_message(uid: Column, mid: Column, score: Column, ts: Column) -> Column:
    """Inverse of ``parse_rating_message`` (used to build log lines)."""
    return F.concat_ws(FIELD_SEP, uid.cast("string"), mid.cast("string"),
                       score.cast("string"), ts.cast("string"))


def parse_recent_entry(c: Column | str) -> Column:
    """``'mid:score'`` (an entry of an external recent-ratings list) ->
    struct ``(mid int, score double)``; malformed parts become NULL."""
    parts = F.split(_col(c), ":", -1)
    return F.struct(F.trim(F.get(parts, 0)).try_cast("int").alias("mid"),
                    F.trim(F.get(parts, 1)).try_cast("double").alias("score"))
