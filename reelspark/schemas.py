"""Canonical table schemas of the rating model.

Ids and epoch-second timestamps are ints (ALS needs int-range ids), scores
are doubles, all text is string. Recommendation lists are
``array<struct<mid:int, score:double>>`` inside the engine and are packed to
text only at the exchange boundary (see ``reelspark.functions.lists``).
"""

from pyspark.sql import types as T

MOVIE = T.StructType([
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("timeLong", T.StringType(), True),
    T.StructField("issue", T.StringType(), True),
    T.StructField("shoot", T.StringType(), True),
    T.StructField("language", T.StringType(), True),
    T.StructField("genres", T.StringType(), True),
    T.StructField("actors", T.StringType(), True),
    T.StructField("directors", T.StringType(), True),
])

RATING = T.StructType([
    T.StructField("uid", T.IntegerType(), False),
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("score", T.DoubleType(), False),
    T.StructField("timestamp", T.IntegerType(), False),
])

TAG = T.StructType([
    T.StructField("uid", T.IntegerType(), False),
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("tag", T.StringType(), False),
    T.StructField("timestamp", T.IntegerType(), False),
])

REC = T.StructType([
    T.StructField("mid", T.IntegerType(), True),
    T.StructField("score", T.DoubleType(), True),
])

REC_LIST = T.ArrayType(REC)

# Required (non-null) key columns per schema; the file source does not
# enforce nullable=false, so loaders can drop rows that miss them.
REQUIRED = {
    "movie": ["mid"],
    "rating": ["uid", "mid", "score", "timestamp"],
    "tag": ["uid", "mid", "tag", "timestamp"],
}
