"""MinHash near-dedup with SuperMinHash signatures.

A document is its set of distinct shingles of ``SHINGLE`` words. In
SuperMinHash each element ranks the signature's places by a random
permutation; place k keeps the smallest ``rank + fraction`` that any element
gives it. The ranks of one element differ between places, which lowers the
variance against independent hashes, and elements are taken rank by rank, all
at once, until no later rank can lower any place (early stop).

Documents with equal sets are one class, represented by its smallest (id, hash
of the text), found by a map-side combined aggregation; both together name the
class in all steps, as several texts may bear one id. Class signatures are cut into ``BANDS``
bands; a pair of similarity 0.75 misses all of them with probability
(1 - 0.75**4)**32 = 5e-6. Candidates are verified on the full shingle sets of
the whole texts, in two rounds:

1. every class against the smallest class name that it shares a band with;
2. in bands whose members lie in different components after that, all pairs
   across components whose signatures agree in ``MIN_AGREE`` of the places
   (a pair of similarity 0.75 has less with probability 1e-7), each in the
   first band that it shares. Members of large buckets are compared in blocks
   of ``BLOCK`` rows, each pair of blocks on its own. Texts travel with the
   members that have such a partner, once per block, and a task returns links
   that join components, so pairs are never rows.

Pairs inside a component need no look, so copies are not expanded into pairs
and no link between components is lost. Verified links go through distributed
union-find grouping (``components``).

Defined results: a document without words (or text) has an empty set and is
linked with nothing. Rows that repeat an id with one text share its result;
with different texts each text has its own. Rows without an id are linked with
nothing and kept. Other columns pass through in ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices
from .components import connected_components, keys_of

SHINGLE = 5
PERMUTED = 128           # places of a signature
BAND_ROWS = 4
BANDS = PERMUTED // BAND_ROWS
SIMILARITY = 75          # percent
MIN_AGREE = 0.55
BLOCK = 512
_MASK32 = np.uint64(0xFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15 | 1
_PIECE = 1 << 20
_LOWEST = -(1 << 63)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Word and shingle hashes of texts, by a rolling polynomial over bytes."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        self.power = np.zeros(0, np.uint64)
        self.inverse = np.zeros(0, np.uint64)
        self.salt = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)

    def _powers(self, n: int) -> None:
        if n > len(self.power):
            n = 1 << max(12, (n - 1).bit_length())
            steps = np.full(n, _BASE, np.uint64)
            back = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
            steps[0] = back[0] = 1
            self.power, self.inverse = np.cumprod(steps), np.cumprod(back)

    def words(self, data: bytes) -> np.ndarray:
        """Hashes of the words of lower-cased bytes, in order."""
        a = np.frombuffer(data, np.uint8)
        inside = ~self.space[a]
        edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
        first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self._powers(len(a) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * self.power[:len(a)])))
        h = (total[end] - total[first]) * self.inverse[first]
        return mix(h + (end - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingle hashes of a whole text."""
        data = (text or "").encode().lower()
        if len(data) <= _PIECE:
            w = self.words(data)
        else:  # bounded pieces, each cut at white space
            parts, at = [], 0
            while at < len(data):
                end = min(at + _PIECE, len(data))
                while end < len(data) and not self.space[data[end]]:
                    end += 1
                parts.append(self.words(data[at:end]))
                at = end
            w = np.concatenate(parts)
        k = min(self.size, len(w))
        if not k:
            return np.zeros(0, np.uint64)
        n = len(w) - k + 1
        h = np.full(n, k, np.uint64)
        for i in range(k):
            h = h + w[i:i + n] * self.salt[i]
        return np.unique(mix(h))


def super_minhash(elements: np.ndarray, places: int = PERMUTED) -> np.ndarray:
    """SuperMinHash signature: per place ``rank << 32 | fraction``."""
    sig = np.full(places, np.iinfo(np.uint64).max, np.uint64)
    n = len(elements)
    if not n:
        return sig
    order = None
    rows = np.arange(n)
    seed = elements
    for rank in range(places):
        x = mix(seed + np.uint64((rank + 1) * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
        pick = (((x & _MASK32) * np.uint64(places - rank)) >> np.uint64(32)).astype(np.int64) + rank
        if rank == 0:
            at = first = pick
        else:
            if order is None:  # few documents need more than the first rank for long
                order = np.broadcast_to(np.arange(places, dtype=np.uint16), (n, places)).copy()
                order[rows, first] = 0
                order[:, 0] = first
            at = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, rank]
        np.minimum.at(sig, at, (x >> np.uint64(32)) | np.uint64(rank << 32))
        if sig.max() < np.uint64((rank + 1) << 32):
            break
    return sig


def _signature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for b in batches:
        at = 0
        for texts in slices(b.column(1).to_pylist()):
            n, d1, d2, sigs = [], [], [], []
            for t in texts:
                s = shingler.shingles(t)
                n.append(len(s))
                d1.append(int(mix(s + np.uint64(1)).sum(dtype=np.uint64).astype(np.int64)))
                d2.append(int(mix(s + np.uint64(2)).sum(dtype=np.uint64).astype(np.int64)))
                sigs.append(mix(super_minhash(s)).astype("<u2").tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(at, len(texts)), b.column(2).slice(at, len(texts)), pa.array(n, pa.int64()),
                 pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sigs, pa.binary())],
                ["doc_id", "text_hash", "n_shingles", "d1", "d2", "sig"])
            at += len(texts)


def signatures(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, text_hash, n_shingles, d1, d2`` (the set's size and digest) and
    ``sig``, 16 bits of each place's value; null for an empty set."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    return rows.mapInArrow(_signature_batches,
                           "doc_id long, text_hash long, n_shingles long, d1 long, d2 long, sig binary")


def similar(s: np.ndarray, t: np.ndarray) -> bool:
    """Whether two sorted distinct sets have the similarity asked for."""
    both = len(s) + len(t)
    if min(len(s), len(t)) * 100 < max(len(s), len(t)) * SIMILARITY:
        return False
    common = both - len(np.unique(np.concatenate((s, t))))
    return bool(common and 100 * common >= SIMILARITY * (both - common))


def similar_udf():
    """Arrow UDF (text, text) -> whether their full shingle sets are similar enough."""
    @F.arrow_udf("boolean")
    def verdicts(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        shingler = Shingler()
        last_text, last = None, None
        for left, right in batches:
            out = []
            for i in range(len(left)):
                a, b = left[i].as_py(), right[i].as_py()
                if last is None or b != last_text:
                    last_text, last = b, shingler.shingles(b)
                out.append(similar(shingler.shingles(a), last))
            yield pa.array(out, pa.bool_())

    return verdicts


def row_name(doc_id: Column, text_hash: Column) -> Column:
    """Both numbers as 16 bytes that sort as the numbers do."""
    def part(c: Column) -> Column:
        return F.lpad(F.hex(c.bitwiseXOR(F.lit(_LOWEST))), 16, "0")

    return F.unhex(F.concat(part(doc_id), part(text_hash)))


def named_id(name: Column) -> Column:
    """The id of a ``row_name``."""
    return F.conv(F.substring(F.hex(name), 1, 16), 16, -10).cast("long").bitwiseXOR(F.lit(_LOWEST))


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose whole texts (``id, text``) are similar."""
    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.where(similar_udf()("text_a", "text_b")).select("a", "b")


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Rows of equal values in the first ``keys`` columns, from sorted batches."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        change = np.zeros(max(batch.num_rows - 1, 0), bool)
        for k in range(keys):
            values = batch.column(k).to_numpy()
            change |= values[1:] != values[:-1]
        at = 0
        for end in np.flatnonzero(change) + 1:
            yield batch.slice(at, end - at)
            at = int(end)
        held = batch.slice(at) if batch.num_rows else None
    if held is not None and held.num_rows:
        yield held


def _candidates(run: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, row, agreement) of a run's pairs that round 2 has to verify."""
    col = {name: run.column(k) for k, name in enumerate(run.schema.names)}
    sig = np.frombuffer(b"".join(col["sig"].to_pylist()), "<u2").reshape(run.num_rows, -1)
    bands = sig.view("<u8")
    ids, comp = (np.unique(keys_of(col[c]), return_inverse=True)[1] for c in ("id", "comp"))
    side = col["side"].to_numpy()
    band = int(col["band"][0].as_py())
    one, two = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    left, right, share = [], [], []
    step = max(1, (1 << 24) // (max(len(two), 1) * sig.shape[1]))
    for at in range(0, len(one), step):
        rows = one[at:at + step]
        far = (comp[rows][:, None] != comp[two][None, :]) & (ids[rows][:, None] != ids[two][None, :])
        if side[rows[0]] == 2:  # a block with itself: each pair once
            far &= rows[:, None] < two[None, :]
        i, j = np.nonzero(far)
        i, j = rows[i], two[j]
        for part in range(0, len(i), 1 << 16):
            x, y = i[part:part + (1 << 16)], j[part:part + (1 << 16)]
            agree = (sig[x] == sig[y]).mean(axis=1)
            ok = (agree >= MIN_AGREE) & ~(bands[x, :band] == bands[y, :band]).any(axis=1)
            left.append(x[ok])
            right.append(y[ok])
            share.append(agree[ok])
    if not left:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0)
    return np.concatenate(left), np.concatenate(right), np.concatenate(share)


def _with_partner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that have a pair to verify in their run."""
    out, held = [], 0
    for run in runs(batches, 3):
        i, j, _ = _candidates(run)
        if len(i):
            out.append(run.take(pa.array(np.unique(np.concatenate([i, j])))))
            held += out[-1].num_rows
            if held >= 4096:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
                out, held = [], 0
    if out:
        yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of runs of rows with texts that join components of the run, the
    most similar signatures first."""
    shingler = Shingler()
    sets: dict[bytes, np.ndarray] = {}
    found: list[tuple[bytes, bytes]] = []
    for run in runs(batches, 3):
        i, j, agree = _candidates(run)
        ids, comp = run.column("id").to_pylist(), run.column("comp").to_pylist()
        texts = run.column("text")
        up: dict[bytes, bytes] = {}

        def root(c: bytes) -> bytes:
            while up.get(c, c) != c:
                c = up[c]
            return c

        def shingles(k: int) -> np.ndarray:
            if ids[k] not in sets:
                if len(sets) >= 2 * BLOCK:
                    sets.clear()
                sets[ids[k]] = shingler.shingles(texts[k].as_py())
            return sets[ids[k]]

        for k in np.argsort(-agree, kind="stable"):
            x, y = int(i[k]), int(j[k])
            a, b = root(comp[x]), root(comp[y])
            if a != b and similar(shingles(x), shingles(y)):
                up[max(a, b)] = min(a, b)
                found.append((ids[x], ids[y]))
        if len(found) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], ["a", "b"])
            found = []
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], ["a", "b"])


def deal(placed: DataFrame, sigs: DataFrame, block: int) -> DataFrame:
    """Rows ``bucket, band, id, comp`` dealt to pairs of blocks ``lo, hi``, with the ids' signatures.

    Only buckets with several components are dealt. The members of a bucket's
    largest component are cut into blocks of their own, which meet the blocks
    of the others but not each other, so n such members beside m others cost
    about ``2 n m / block`` rows and never n squared.
    """
    mixed = materialise(placed.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
                  .where("c0 <> c1").select("bucket"), "mixed-buckets")
    left = materialise(placed.join(mixed, "bucket"), "mixed-members")
    largest = materialise(left.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
                    .groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("size")), "largest-components")
    few = largest.select("bucket", F.col("top.comp").alias("most"), F.ceil((F.col("size") - F.col("top.n")) / block).alias("others"),
                         F.ceil(F.col("top.n") / block).alias("blocks"))
    major = F.col("comp") == F.col("most")
    own = F.when(major, F.col("others") + F.pmod(F.xxhash64("id"), F.col("blocks"))).otherwise(F.pmod(F.xxhash64("id"), F.col("others")))
    last = F.when(major, F.col("others")).otherwise(F.col("others") + F.col("blocks")) - 1
    return (left.join(few, "bucket").join(sigs, "id")
            .select("bucket", "band", "id", "comp", "sig", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("other"))
            .select("bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "band", "id", "comp",
                    F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"), "sig"))


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: ``doc_id, text_hash, n_shingles, component_id, kept``."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = materialise(signatures(source), "signatures")
    named = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = named.groupBy("n_shingles", "d1", "d2").agg(F.min(F.struct("doc_id", "text_hash")).alias("low"), F.first("sig").alias("sig"))
    classes = materialise(classes.select("n_shingles", "d1", "d2", row_name(F.col("low.doc_id"), F.col("low.text_hash")).alias("id"), "sig"),
                          "set-classes")
    texts = source.where("doc_id IS NOT NULL").select(row_name(F.col("doc_id"), F.xxhash64("text")).alias("id"), "text")
    members = (classes.select("id", "sig", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
               .select("id", "band", F.xxhash64("band", F.expr(f"substring(sig, band * {2 * BAND_ROWS} + 1, {2 * BAND_ROWS})")).alias("bucket")))
    # Written out, so that the joins shuffle both sides anew and Spark may split a hot bucket.
    sizes = materialise(members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("id").alias("low")).where("size > 1"), "buckets")
    shared = materialise(members.join(sizes, "bucket"), "shared-buckets")

    stars = shared.groupBy(F.col("id").alias("a")).agg(F.min("low").alias("b")).where("b < a")
    links = materialise(verify(stars, texts), "links-1")
    comps = materialise(connected_components(links), "components-1")

    placed = shared.join(comps, "id", "left").select("bucket", "band", "id", F.coalesce("component_id", "id").alias("comp"))
    dealt = deal(placed, classes.select("id", "sig"), BLOCK)
    schema = "bucket long, lo long, hi long, band int, id binary, comp binary, side int, sig binary"
    keys = ["bucket", "lo", "hi"]
    partners = materialise(dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_with_partner, schema), "partners")
    more = (partners.join(texts, "id").repartition(*keys).sortWithinPartitions(*keys)
            .select(*partners.columns, "text").mapInArrow(_verified, "a binary, b binary"))
    more = materialise(more, "links-2")

    # Only components are left to join: one more grouping over their few links.
    part = comps.select(F.col("id"), F.col("component_id").alias("c"))
    across = (more.join(part.select(F.col("id").alias("a"), F.col("c").alias("ca")), "a", "left")
              .join(part.select(F.col("id").alias("b"), F.col("c").alias("cb")), "b", "left")
              .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    outer = connected_components(across).select(F.col("id").alias("c"), F.col("component_id").alias("outer"))
    comps = (classes.select("id").join(part, "id", "left").select("id", F.coalesce("c", "id").alias("c"))
             .join(outer, "c", "left").select("id", F.coalesce("outer", "c").alias("component_id")))

    found = classes.join(comps, "id", "left").select("n_shingles", "d1", "d2", named_id(F.coalesce("component_id", "id")).alias("comp"))
    out = rows.join(found, ["n_shingles", "d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(F.col("comp"))
    # Every row that bears its component's id is kept, whatever its text.
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are kept: one document of each group."""
    gone = near_duplicates(docs, text, id_col).where(~F.col("kept")).select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(gone, (docs[id_col] == gone["_doc"]) & (F.xxhash64(docs[text]) == gone["_hash"]), "left_anti")
