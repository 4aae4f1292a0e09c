"""Similarity sources for lookups: the scorer asks only for what a batch needs.

Three questions are asked of a similarity table:

* ``neighbors(items)``: every ``(mid, sim_mid, sim)`` with ``mid`` in ``items``;
* ``top_neighbors(limits)``: for each ``(mid, lim)`` the first ``lim``
  neighbours, ``(mid, sim_mid, sim, nrank)``, most similar first, ties by id;
* ``pair_sims(pairs)``: the similarity of given ``(a, b)`` pairs (NULL when
  the pair is not in the table, and for ``a == b``).

``TableSims`` answers them from any pair table. Its stored form ``StoredSims``
is a table bucketed by item and sorted by item and rank, so a lookup joins its
buckets without a shuffle of the table and reads ranks instead of computing
them. ``FactoredSims`` keeps content similarity in its factored form - item ->
distinct vector, and similarity between distinct vectors - so a lookup expands
only the requested rows instead of the full item x item table (19.9M pairs at
sf0.1 for threshold 0.6, against ~1,000 neighbours per item actually read).
Its top neighbours are a rank join: members of a vector are ranked once, the
vector lists are taken by falling similarity until enough members are
certainly before the next vector, and of each vector only the first members.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelspark.functions.lists import top_k
from reelspark.operators.ranking import distributed_rank
from reelspark.operators.similarity import GROUPS_PER_SLOT
from reelspark.session import checkpoint_dir

BUCKET_COL = "a_bucket"
MEMBER_BLOCK = 4096      # ids, or ranks, of the members of a vector that one block holds
LIST_BLOCK = 1024        # places of a vector's list whose own items meet one copy of it
LITERALS = 1000          # items up to which a lookup names them in the scan's filter


def _bucket(col: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(col)), F.lit(buckets)).cast("int")


class TableSims:
    """Lookups against a materialised ``(mid, sim_mid, sim)`` table.

    ``dedupe=True`` keeps one row per ordered pair, as a lookup map would
    (the reference builds a map, so a repeated pair keeps a single value);
    it costs a shuffle of the table, so long-running streams should dedupe
    and persist the static table once rather than per batch.
    """

    def __init__(self, table: DataFrame, dedupe: bool = False):
        t = table.select("mid", "sim_mid", "sim")
        self.table = t.dropDuplicates(["mid", "sim_mid"]) if dedupe else t

    def materialize(self, path: str | None = None, buckets: int = 256) -> "StoredSims":
        """Rank the table once and store it for the lookups of every
        micro-batch: bucketed by ``mid``, sorted by ``mid`` and rank, under
        ``path`` (default: a new folder in the session's checkpoint dir)."""
        spark = self.table.sparkSession
        path = path or f"{checkpoint_dir(spark).rstrip('/')}/stored-sims-{uuid.uuid4().hex}"
        ranked = distributed_rank(self.table, ["mid"], [F.desc("sim"), F.asc("sim_mid")], "nrank")
        return StoredSims.store(ranked, path, buckets)

    def neighbors(self, items: DataFrame) -> DataFrame:
        return self.table.join(items.select("mid"), "mid", "left_semi")

    def with_key(self, df: DataFrame, item: str, side: str) -> DataFrame:
        """Pairs are looked up by the items themselves."""
        return df

    def top_neighbors(self, limits: DataFrame) -> DataFrame:
        """Ranks the neighbours of the given items; ``StoredSims`` has the ranks."""
        near = self.table.join(limits.select("mid", "lim"), "mid")
        return top_k(near, ["mid"], [F.desc("sim"), F.asc("sim_mid")], None, rank="nrank").where("nrank <= lim").drop("lim")

    def pair_sims(self, pairs: DataFrame, a: str, b: str, out: str = "sim") -> DataFrame:
        t = self.table.select(F.col("mid").alias(a), F.col("sim_mid").alias(b), F.col("sim").alias(out))
        return pairs.join(t, [a, b], "left")

    def as_table(self) -> DataFrame:
        return self.table


class StoredSims(TableSims):
    """Lookups against a stored ``(mid, sim_mid, sim, nrank)`` table that is
    bucketed by ``mid`` and sorted by ``mid, nrank``.

    Up to ``LITERALS`` different items become a filter of the scan, which then
    opens only their buckets and row groups; more items meet the table bucket
    by bucket. Neither way shuffles the table. Pair lookups join on two
    columns of which the table is bucketed by one:
    ``spark.sql.requireAllClusterKeysForCoPartition=false`` (the session
    defaults set it) lets Spark use that.
    """

    def __init__(self, table: DataFrame):
        self.table = table

    @classmethod
    def store(cls, ranked: DataFrame, path: str, buckets: int) -> "StoredSims":
        name = f"stored_sims_{uuid.uuid4().hex}"
        (ranked.select("mid", "sim_mid", "sim", "nrank").repartition(buckets, "mid")
         .write.mode("overwrite").bucketBy(buckets, "mid").sortBy("mid", "nrank").option("path", path).saveAsTable(name))
        return cls(ranked.sparkSession.table(name))

    def materialize(self, path: str | None = None, buckets: int = 256) -> "StoredSims":
        return self

    def _near(self, keys: DataFrame, key: str) -> DataFrame:
        ids = [r[0] for r in keys.select(key).distinct().limit(LITERALS + 1).collect()]
        return self.table if len(ids) > LITERALS else self.table.where(F.col("mid").isin([i for i in ids if i is not None]))

    def neighbors(self, items: DataFrame) -> DataFrame:
        return self._near(items, "mid").drop("nrank").join(items.select("mid"), "mid", "left_semi")

    def top_neighbors(self, limits: DataFrame) -> DataFrame:
        near = self._near(limits, "mid").join(limits.select("mid", "lim"), "mid")
        return near.where("nrank <= lim").select("mid", "sim_mid", "sim", "nrank")

    def pair_sims(self, pairs: DataFrame, a: str, b: str, out: str = "sim") -> DataFrame:
        t = self._near(pairs, a).select(F.col("mid").alias(a), F.col("sim_mid").alias(b), F.col("sim").alias(out))
        hits = t.join(pairs.select(a, b), [a, b], "left_semi")
        return pairs.join(hits, [a, b], "left")

    def as_table(self) -> DataFrame:
        return self.table.drop("nrank")


class FactoredSims:
    """``members(mid, vkey)`` + ``vpairs(id_a, id_b, sim)`` over distinct vectors.

    ``vpairs`` must include ``(v, v)`` for every non-zero vector so that two
    items with the same vector are neighbours.
    """

    def __init__(self, members: DataFrame, vpairs: DataFrame, decimals: int | None = None,
                 buckets: int | None = None):
        self.members = members.select("mid", "vkey")
        sim = F.round("sim", decimals) if decimals is not None else F.col("sim")
        extra = [BUCKET_COL] if buckets else []
        self.vpairs = vpairs.select("id_a", "id_b", sim.alias("sim"), *extra)
        self.buckets = buckets
        # (mid, vkey, place, block) and vector pairs with ``before``, once they are stored
        self.ranked = members if "place" in members.columns else None
        self.ordered = vpairs if "before" in vpairs.columns else None

    def materialize(self, path: str | None = None, buckets: int = 256) -> "FactoredSims":
        """Compute members and vector pairs once, so a stream does not redo the
        TF-IDF and block products per batch. Members get a reliable
        checkpoint; vector pairs are written to ``path`` (default: a folder in
        the session's checkpoint dir) partitioned by a hash bucket of
        ``id_a``, a join column of every later lookup."""
        spark = self.members.sparkSession
        root = checkpoint_dir(spark)
        path = path or f"{root.rstrip('/')}/factored-sims-{uuid.uuid4().hex}"
        (self._ordered_pairs().withColumn(BUCKET_COL, _bucket("id_a", buckets))
         .write.mode("overwrite").partitionBy(BUCKET_COL).parquet(path))
        return FactoredSims(self._ranked_members().checkpoint(eager=True), spark.read.parquet(path),
                            buckets=buckets)

    def _ranked_members(self) -> DataFrame:
        """``mid, vkey`` with ``place`` (0 = lowest id of the vector) and its
        ``block``. Ids are ranked inside runs of ``MEMBER_BLOCK`` ids and the
        runs' sizes added up, so no window holds a whole vector."""
        if self.ranked is not None:
            return self.ranked
        runs = self.members.withColumn("run", F.floor(F.col("mid") / MEMBER_BLOCK))
        inside = runs.withColumn("inside", F.row_number().over(Window.partitionBy("vkey", "run").orderBy("mid")))
        sizes = runs.groupBy("vkey", "run").agg(F.count(F.lit(1)).alias("size"))
        ahead = Window.partitionBy("vkey").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select("vkey", "run", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("start"))
        place = F.col("start") + F.col("inside") - 1
        return (inside.join(starts, ["vkey", "run"])
                .select("mid", "vkey", place.alias("place"), F.floor(place / MEMBER_BLOCK).alias("block")))

    def _ordered_pairs(self) -> DataFrame:
        """Vector pairs with ``before``: how many members the vectors have that
        are more similar to ``id_a``."""
        if self.ordered is not None:
            return self.ordered
        sizes = self.members.groupBy(F.col("vkey").alias("id_b")).agg(F.count(F.lit(1)).alias("size"))
        so_far = Window.partitionBy("id_a").orderBy(F.desc("sim")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        equal = Window.partitionBy("id_a", "sim")
        return (self.vpairs.join(sizes, "id_b")
                .withColumn("before", F.sum("size").over(so_far) - F.sum("size").over(equal)).drop("size"))

    def top_neighbors(self, limits: DataFrame) -> DataFrame:
        """Rank join. A vector with ``lim`` other members certainly before its
        own has none of the first ``lim`` neighbours, and a vector gives at
        most its first ``lim + 1`` members (the item itself may be one)."""
        members, pairs = self._ranked_members(), self._ordered_pairs()
        ask = limits.select("mid", "lim").join(members.select("mid", F.col("vkey").alias("id_a")), "mid")
        ask, on = self._with_bucket(ask)
        near = ask.join(pairs, [*on, "id_a"]).where(F.col("before") <= F.col("lim"))
        near = near.select("mid", "lim", "sim", F.col("id_b").alias("vkey"),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("lim") / MEMBER_BLOCK))).alias("block"))
        found = (near.join(members.select(F.col("mid").alias("sim_mid"), "vkey", "place", "block"), ["vkey", "block"])
                 .where((F.col("place") <= F.col("lim")) & (F.col("mid") != F.col("sim_mid"))))
        return (top_k(found, ["mid"], [F.desc("sim"), F.asc("sim_mid")], None, rank="nrank")
                .where("nrank <= lim").select("mid", "sim_mid", "sim", "nrank"))

    def _with_bucket(self, df: DataFrame, key: str = "id_a") -> tuple[DataFrame, list[str]]:
        """``df`` ready to join the vector pairs: with stored pairs the bucket
        of ``key`` is a join column too, so Spark can prune the scan to the
        buckets at hand when it runs; nothing is collected for it."""
        if not self.buckets:
            return df, []
        return df.withColumn(BUCKET_COL, _bucket(key, self.buckets)), [BUCKET_COL]

    def neighbors(self, items: DataFrame) -> DataFrame:
        src = self.members.join(items.select("mid"), "mid", "left_semi")
        a, on = self._with_bucket(src.select("mid", F.col("vkey").alias("id_a")))
        b = self.members.select(F.col("mid").alias("sim_mid"), F.col("vkey").alias("id_b"))
        return (a.join(self.vpairs, [*on, "id_a"]).join(b, "id_b")
                .where(F.col("mid") != F.col("sim_mid"))
                .select("mid", "sim_mid", "sim"))

    def with_key(self, df: DataFrame, item: str, side: str) -> DataFrame:
        """``df`` with the vector of ``item``, as the ``"a"`` or ``"b"`` side of
        ``pair_sims``: to be looked up before the two sides are multiplied."""
        return df.join(self.members.select(F.col("mid").alias(item), F.col("vkey").alias(f"id_{side}")), item, "left")

    def pair_sims(self, pairs: DataFrame, a: str, b: str, out: str = "sim") -> DataFrame:
        for item, side in ((a, "a"), (b, "b")):
            if f"id_{side}" not in pairs.columns:
                pairs = self.with_key(pairs, item, side)
        keyed, on = self._with_bucket(pairs)
        looked = keyed.join(self.vpairs, [*on, "id_a", "id_b"], "left")
        sim = F.when(F.col(a) != F.col(b), F.col("sim"))
        return looked.withColumn(out, sim).drop("id_a", "id_b", *on, *([] if out == "sim" else ["sim"]))

    def neighbor_counts(self) -> DataFrame:
        """``(mid, n_similar)`` of every member, from the factored form alone:
        vector pairs joined with the number of members per vector, so nothing
        is expanded to item pairs."""
        size = self.members.groupBy("vkey").agg(F.count(F.lit(1)).alias("size"))
        per_vector = (self.vpairs.join(size.select(F.col("vkey").alias("id_b"), "size"), "id_b")
                      .groupBy("id_a").agg(F.sum("size").alias("near")))
        return (self.members.join(per_vector.withColumnRenamed("id_a", "vkey"), "vkey")
                .select("mid", (F.col("near") - 1).alias("n_similar")))

    def as_table(self) -> DataFrame:
        """The full item x item table. Its size is the output's size, far
        above the inputs', so the catalogue side is first spread over every
        task slot (a catalogue-sized exchange that AQE does not coalesce):
        each slot then expands its share against the broadcast vector pairs."""
        par = self.members.sparkSession.sparkContext.defaultParallelism
        a = self.members.repartition(par).select("mid", F.col("vkey").alias("id_a"))
        b = self.members.select(F.col("mid").alias("sim_mid"), F.col("vkey").alias("id_b"))
        vp = self.vpairs.drop(BUCKET_COL)
        return (a.join(vp, "id_a").join(b, "id_b")
                .where(F.col("mid") != F.col("sim_mid"))
                .select("mid", "sim_mid", "sim"))

    def ranked_table(self) -> DataFrame:
        """``as_table`` with the ``rank`` of each row in its item's list (sim
        descending, then id).

        Items of one vector have the same list but for themselves, so lists are
        ranked once per vector, over its members' rows, and an item that stands
        once in ``members`` gets its vector's list without its own place. Items
        that come repeatedly have their rows ranked one by one. The item pairs
        of the others are made last and neither sorted nor written.
        """
        members = self.members.where("mid IS NOT NULL")
        order = [F.desc("sim"), F.asc("sim_mid")]
        per_item = members.groupBy("mid").agg(F.min("vkey").alias("id_a"), F.count(F.lit(1)).alias("n"))
        entries = (self.vpairs.select("id_a", "id_b", "sim")
                   .join(members.select(F.col("mid").alias("sim_mid"), F.col("vkey").alias("id_b")), "id_b")
                   .select("id_a", "sim_mid", "sim"))
        lists = distributed_rank(entries, ["id_a"], order, rank="place")
        own = (per_item.where("n = 1").select(F.col("mid").alias("sim_mid"), "id_a").join(lists, ["id_a", "sim_mid"])
               .select(F.col("sim_mid").alias("mid"), "id_a", F.col("place").alias("own"),
                       F.floor(F.col("place") / LIST_BLOCK).alias("block")))
        # Of fixed count, as the rows that a partition makes are many times those it reads.
        parts = GROUPS_PER_SLOT * max(1, members.sparkSession.sparkContext.defaultParallelism)
        asked = lists.join(own.select("id_a", "block").distinct(), "id_a")
        table = (own.repartition(parts, "id_a", "block").join(asked, ["id_a", "block"]).where(F.col("mid") != F.col("sim_mid"))
                 .select("mid", "sim_mid", "sim", (F.col("place") - (F.col("place") > F.col("own")).cast("long")).alias("rank")))
        repeated = per_item.where("n > 1").select("mid")
        if repeated.limit(1).count() == 0:
            return table
        return table.unionByName(distributed_rank(self.neighbors(repeated), ["mid"], order))

    def as_classes(self) -> DataFrame:
        """``(kind, mid, class_id, sim_class, sim, n_items)``: a row of kind
        ``item`` per member of a vector that pairs with itself, and one of kind
        ``link`` per vector pair, with its first vector's smallest member. It
        grows with members and vector pairs, not item pairs."""
        pairs = self.vpairs.select(F.col("id_a").alias("class_id"), F.col("id_b").alias("sim_class"), "sim")
        members = self.members.where("mid IS NOT NULL").select("mid", F.col("vkey").alias("class_id"))
        classes = members.groupBy("class_id").agg(F.min("mid").alias("mid"), F.count(F.lit(1)).alias("n_items"))
        linked = (pairs.join(classes.select("class_id", "mid"), "class_id")
                  .join(classes.select(F.col("class_id").alias("sim_class"), "n_items"), "sim_class")
                  .select(F.lit("link").alias("kind"), "mid", "class_id", "sim_class", "sim", "n_items"))
        own = linked.where("class_id = sim_class").select("class_id", "sim_class", "sim", "n_items")
        return (members.join(own, "class_id")
                .select(F.lit("item").alias("kind"), "mid", "class_id", "sim_class", "sim", "n_items").unionByName(linked))


def sims_from_packed(packed: DataFrame, key: str = "mid", recs: str = "recs") -> DataFrame:
    """A stored similarity table ``(mid, '(mid,sim)|(mid,sim)|...')`` back to
    flat ``(mid, sim_mid, sim)`` rows (malformed entries are dropped)."""
    from reelspark.functions.lists import explode_ranked, unpack_list
    lists = packed.select(F.col(key).alias("mid"), unpack_list(F.col(recs)).alias("recs"))
    return explode_ranked(lists, "mid", item="sim_mid", score="sim").select("mid", "sim_mid", "sim")


def as_source(sims) -> TableSims | FactoredSims:
    return sims if isinstance(sims, (TableSims, FactoredSims)) else TableSims(sims)
