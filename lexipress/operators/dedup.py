"""Exact and near duplicates in the order of ids.

A post is a duplicate if an earlier kept post has the same hash, else if an earlier kept
post shares a band and enough shingles.  Duplicates are nobody's original, so the kept
posts are the first maximal independent set of the pair graph in id order, found in
rounds: what no earlier undecided or kept post blocks is kept, what has an earlier kept
neighbour is a duplicate.

Copies are folded before any pair is made.  A band of many posts makes no pairs of all
of them: its first ``LEADERS`` meet the others, what proves a duplicate leaves the band, and
only posts that nothing has decided lead the next round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import minhash
from ..functions import text as T
from ..plans.lineage import bounded_batches, cut, drop, spread

THRESHOLD = 0.7
#: Posts of a band that meet all others of it in the first round; each round takes four times as many.
LEADERS = 64
#: Stored bands and sets are dealt into so many folders.
BUCKETS = 64
#: Ids that are broadcast, so that texts are filtered where they are read.
SMALL = 500_000


def first_of_hash(rows: DataFrame, hash_column: str, key: str) -> DataFrame:
    """hash → smallest key; null hashes match nothing."""
    return rows.where(F.col(hash_column).isNotNull()).groupBy(hash_column).agg(F.min(key).alias("canonical"))


def exact_duplicates(rows: DataFrame, hash_column: str, key: str) -> DataFrame:
    """``rows`` with ``canonical``: the first row of the same hash, null for that row itself and for null hashes."""
    first = first_of_hash(rows, hash_column, key).withColumnRenamed(hash_column, "_hash")
    joined = rows.join(first, F.col(hash_column) == F.col("_hash"), "left").drop("_hash")
    return joined.withColumn("canonical", F.when(F.col("canonical") < F.col(key), F.col("canonical")))


_ENTRY = pa.schema([("id", pa.int64()), ("content_hash", pa.string()), ("n", pa.int32()), ("shingles", pa.binary()), ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])
_ENTRY_DDL = "id long, content_hash string, n int, shingles binary, bands array<long>, signature binary"


def _entry_rows(with_signature: bool, with_sets: bool = True):
    """Shingles, signature and bands of a whole batch; a post of too few words has no band."""

    def run(batches):
        for batch in batches:
            keys = [T.words_key_value(t) for t in batch.column("clean_content").to_pylist()]
            sets = [T.shingle_array(k).astype(np.uint32) for k in keys]
            usable = np.array([k.count(" ") + 1 >= minhash.MIN_TOKENS for k in keys])  # one blank between words
            bounds = np.cumsum([0, *map(len, sets)])
            sigs = minhash.signatures(np.concatenate(sets) if sets else np.zeros(0, np.uint32), bounds)
            codes = [list(c) if u else [] for c, u in zip(minhash.band_codes(sigs).tolist(), usable.tolist(), strict=True)]
            signed = [s.tobytes() if u else None for s, u in zip(sigs, usable.tolist(), strict=True)] if with_signature else [None] * len(sets)
            stored = [s.tobytes() for s in sets] if with_sets else [None] * len(sets)
            columns = (batch.column("id"), batch.column("content_hash"), [len(s) for s in sets], stored, codes, signed)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _ENTRY, strict=True)], schema=_ENTRY)

    return run


def entries(rows: DataFrame, with_signature: bool = False, with_sets: bool = True, without: DataFrame | None = None) -> DataFrame:
    """(id, content_hash, n, shingles, bands, signature) of rows (id, clean_content, content_hash or none).

    shingles: the sorted set of ``n`` unsigned 32-bit numbers, null unless ``with_sets``; one pass over the texts.
    ``without`` (id): rows of which none are made.
    """
    own = [c for c in ("id", "clean_content", "content_hash") if c in rows.columns]
    dealt = spread(rows.select(*own))
    return _made(dealt if without is None else dealt.join(_light(without), "id", "left_anti"), with_signature, with_sets)


def _light(ids: DataFrame) -> DataFrame:
    """A stored table of ids, marked for broadcast if it is small, so that texts stay where they are read."""
    return F.broadcast(ids) if ids.count() <= SMALL else ids


def _made(rows: DataFrame, with_signature: bool = False, with_sets: bool = True) -> DataFrame:
    """``entries`` of rows that are dealt already."""
    bounded_batches(rows.sparkSession, size=4 << 20)  # the sets of a batch are many times as large as its texts
    hashed = F.col("content_hash") if "content_hash" in rows.columns else F.lit(None).cast("string")
    source = rows.select(F.col("id").cast("long").alias("id"), "clean_content", hashed.alias("content_hash"))
    return source.mapInArrow(_entry_rows(with_signature, with_sets), _ENTRY_DDL)


def bands(sets: DataFrame) -> DataFrame:
    """(id, n, band) of every entry that has bands."""
    return sets.select("id", "n", F.explode("bands").alias("band"))


def _alike(a: str, b: str, threshold: float):
    """Sizes of sets that can share enough: the smaller is at least ``threshold`` of the larger."""
    return F.least(a, b) >= F.greatest(a, b) * threshold


#: About so many sets of each side meet in one cell, and bytes of them.
CELL, CELL_BYTES = 1024, 32 << 20


def _marked(numbers: np.ndarray) -> np.ndarray:
    """A set as a bitmap of 8 bits a number or more, a power of two."""
    size = 1 << max(9, (8 * len(numbers) - 1).bit_length())
    bits = np.zeros(size, dtype=np.uint8)
    bits[numbers & np.uint32(size - 1)] = 1
    return np.packbits(bits).view(np.uint64)


def _least_union(u: np.ndarray, v: np.ndarray) -> int:
    """What two sets hold together at least, by their bitmaps; the larger one is folded."""
    while len(u) > len(v):
        u = u[: len(u) // 2] | u[len(u) // 2 :]
    while len(v) > len(u):
        v = v[: len(v) // 2] | v[len(v) // 2 :]
    return int(np.bitwise_count(u | v).sum())


def _scored_cells(threshold: float, by: str):
    spec = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("score", pa.float64())])

    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        kind = np.uint32 if by == "shingles" else np.uint64
        held = {i: np.frombuffer(s, dtype=kind) for i, s in zip(sets["id"].to_pylist(), sets["s"].to_pylist(), strict=True)}
        ids, scores = [pairs[c].to_numpy() for c in ("a", "b")], np.full(pairs.num_rows, -1.0)
        marks = {i: _marked(s) for i, s in held.items()} if by == "shingles" else {}
        for k, (a, b) in enumerate(zip(*(x.tolist() for x in ids), strict=True)):
            x, y = held.get(a), held.get(b)
            if x is None or y is None:
                continue
            if by != "shingles":
                scores[k] = np.mean(x == y)
                continue
            # Most pairs of a shared band are far from alike: their bitmaps prove it.
            union = _least_union(marks[a], marks[b])
            if (len(x) + len(y) - union) / union < threshold:
                continue
            at = np.searchsorted(x, y)
            both = int(np.count_nonzero(x[np.minimum(at, len(x) - 1)] == y))
            scores[k] = both / (len(x) + len(y) - both)
        use = scores >= threshold
        return pa.Table.from_arrays([pa.array(ids[0][use]), pa.array(ids[1][use]), pa.array(scores[use])], schema=spec)

    return run


def _homes(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """(id, block) of all ids of pairs (a, b): ids that meet much the same others share a block of about ``CELL``, and of ``CELL_BYTES`` by sizes (id, bytes).

    An id's home is the first of its earlier neighbours, or that one's own first.
    """
    first = cut(pairs.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("home")))
    upper = first.select(F.col("id").alias("home"), F.col("home").alias("up"))
    later = first.join(upper, "home", "left").select("id", F.coalesce("up", "home").alias("home"))
    every = pairs.select(F.col("a").alias("id")).distinct().join(first.select("id"), "id", "left_anti").select("id", F.col("id").alias("home"))
    homes = cut(later.unionByName(every).join(sizes, "id"))
    drop(first)
    share = F.greatest(F.count("*") / CELL, F.sum("bytes") / CELL_BYTES)
    blocks = homes.agg(F.greatest(F.lit(1), F.coalesce(F.ceil(share), F.lit(1))).cast("long")).head()[0]
    # A small home lies in one block whole; a large one takes as many as it fills.
    parts = homes.groupBy("home").agg(F.ceil(share).alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    return homes.join(parts, "home").select("id", F.pmod(F.xxhash64("home", part), F.lit(blocks)).alias("block"))


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: float = THRESHOLD, by: str = "shingles") -> DataFrame:
    """Pairs (a, b) of sets with a ``score`` of at least the threshold: exact Jaccard of sets, or equal places of signatures.

    Pairs lie in cells, a block of one side by a block of the other, and a set is sent once to
    each cell that it has pairs in, however many these are.
    """
    pairs = cut(pairs.select("a", "b"))
    size = F.col("n").cast("long") * 4 if by == "shingles" else F.octet_length(by)
    homes = cut(_homes(pairs, sets.select("id", size.alias("bytes"))))
    of = lambda side: homes.select(F.col("id").alias(side), F.col("block").alias(f"block_{side}"))
    placed = cut(pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", F.concat_ws("-", "block_a", "block_b").alias("cell")))
    into = F.col("cell").alias("into")
    wanted = placed.select(into, F.col("a").alias("id")).unionByName(placed.select(into, F.col("b").alias("id"))).distinct()
    sent = wanted.join(sets.select("id", F.col(by).alias("s")), "id").select("into", "id", "s")
    both = placed.groupBy("cell").cogroup(sent.groupBy("into"))
    return both.applyInArrow(_scored_cells(threshold, by), "a long, b long, score double")


def _settle(pairs: DataFrame, blocked: DataFrame | None = None, most_rounds: int = 1000) -> DataFrame:
    """(id, kept) of every id with an earlier neighbour in pairs (a, b), a before b, and of every blocked id.

    A blocked id (id) may have more neighbours than are known, so it is never told kept; with
    such ids ``kept`` stays null where it hangs on them.
    """
    later = pairs.select(F.col("b").alias("id"))
    open_ = later if blocked is None else later.unionByName(blocked.select("id"))
    held = F.lit(False) if blocked is None else F.col("held")
    # Only ids with an earlier neighbour are ever in doubt.
    state = open_.distinct().withColumn("kept", F.lit(None).cast("boolean"))
    if blocked is not None:
        state = state.join(blocked.select("id", F.lit(True).alias("held")).distinct(), "id", "left").na.fill(False, ["held"])
    state, undecided = cut(state), None
    for _ in range(most_rounds):
        left = state.where("kept is null").count()
        if left == 0 or (blocked is not None and left == undecided):
            return state
        undecided = left
        known = pairs.select("a", "b").join(state.select(F.col("id").alias("a"), F.col("kept").alias("a_kept"), F.lit(True).alias("doubted")), "a", "left")
        known = known.withColumn("a_kept", F.when(F.col("doubted").isNull(), True).otherwise(F.col("a_kept")))
        told = known.groupBy(F.col("b").alias("id")).agg(F.bool_or(F.coalesce("a_kept", F.lit(False))).alias("beaten"), F.bool_or(F.col("a_kept").isNull()).alias("open"))
        free = ~F.coalesce("open", F.lit(False)) & ~held
        step = F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.col("beaten"), False).when(free, True)
        new = cut(state.join(told, "id", "left").select(*(c for c in state.columns if c != "kept"), step.alias("kept")))
        drop(state)
        state = new
    raise RuntimeError("duplicates did not settle")


def resolve(ids: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, kept, canonical, score) for ids under pairs (a, b, score), a before b.

    canonical: of the kept earlier neighbours that of the best score, then the smallest id.
    """
    pairs = cut(pairs.select("a", "b", "score"))
    state = _settle(pairs)
    out = state.where("not kept").select(F.col("id").alias("b"))
    kept_first = pairs.join(state.where("not kept").select(F.col("id").alias("a")), "a", "left_anti")
    best = kept_first.join(out, "b", "left_semi").groupBy("b").agg(F.max(F.struct("score", (-F.col("a")).alias("first"))).alias("m"))
    named = best.select(F.col("b").alias("id"), (-F.col("m.first")).alias("canonical"), F.col("m.score").alias("score"))
    return ids.select("id").join(named, "id", "left").withColumn("kept", F.col("canonical").isNull())


def alike_pairs(sets: DataFrame, threshold: float = THRESHOLD, leaders: int = LEADERS, by: str = "shingles", known: DataFrame | None = None, texts: DataFrame | None = None) -> DataFrame:
    """(a, b, score): pairs that decide which entries are kept, a before b; all pairs of a shared band but those of crowded bands.

    A crowded band gives the pairs of its leaders with all later members, so that rows grow with
    members times leaders.  A member beaten by a kept post leaves: nobody's original needs no
    pairs.  ``known``: pairs with entries of earlier runs, which are all kept.  ``texts`` (id,
    clean_content), for entries without sets: those of posts that share a band are made of them.
    """
    every = bands(sets)
    live = cut(every.join(every.groupBy("band").agg(F.count("*").alias("members")).where("members > 1"), "band").select("band", "id", "n"))
    if texts is not None:
        ids = _light(cut(live.select("id").distinct()))
        sets = cut(_made(spread(texts.select("id", "clean_content")).join(ids, "id", "left_semi")))
    found = known
    while True:
        order = W.partitionBy("band").orderBy("id")
        lead = live.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= leaders)
        first = lead.select("band", F.col("id").alias("a"), F.col("n").alias("na"))
        pairs = first.join(live.select("band", F.col("id").alias("b"), F.col("n").alias("nb")), "band").where(F.col("a") < F.col("b"))
        if by == "shingles":
            pairs = pairs.where(_alike("na", "nb", threshold))
        new = confirmed(pairs.select("a", "b").distinct(), sets, threshold, by)
        found = cut(new if found is None else found.unionByName(new).dropDuplicates(["a", "b"]))
        # Where a band has more members than have led, later ones may have unknown neighbours.
        front = cut(live.groupBy("band").agg(F.count("*").alias("members")).where(F.col("members") > leaders).join(first.groupBy("band").agg(F.max("a").alias("last")), "band"))
        if front.isEmpty():
            return found
        behind = live.join(front.select("band", "last"), "band").where("id > last")
        state = _settle(found, behind.select("id").distinct())
        rest = cut(behind.join(state.where("not kept").select("id"), "id", "left_anti").select("band", "id", "n"))
        drop(live)
        live, leaders = rest, leaders * 4


class NearIndex:
    """Hashes, bands and shingle sets of kept posts, stored once and never made again.

    Bands lie in folders by a bucket of the band, sets by a bucket of the id, each below the
    name of the run that wrote them; a run that is repeated overwrites its own.  New posts meet
    the folders that their own bands fall into.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets

    def add(self, sets: DataFrame, run: str) -> None:
        """Store the entries of kept posts."""
        for kind, rows, key in (("bands", bands(sets), "band"), ("sets", sets.select("id", "content_hash", "n", "shingles"), "id")):
            rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")).repartition("bucket").sortWithinPartitions("bucket", key).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{kind}/run={run}")

    def _read(self, kind: str, schema: str, key: str, touched: DataFrame | None, before: str | None) -> DataFrame:
        """Rows of the buckets that the keys of ``touched`` fall into; ``before``: without this run's own."""
        table = self.spark.read.schema(f"{schema}, run string, bucket int").option("basePath", f"{self.path}/{kind}").parquet(f"{self.path}/{kind}")
        if before is not None:
            table = table.where(F.col("run") != before)
        if touched is not None:
            wanted = touched.select(F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int").alias("b")).distinct().collect()  # at most ``buckets`` numbers
            table = table.where(F.col("bucket").isin([r["b"] for r in wanted]))
        return table.drop("run", "bucket")

    def exists(self) -> bool:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/sets")
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)

    def originals(self, hashes: DataFrame, before: str | None = None) -> DataFrame:
        """(content_hash, canonical) of stored posts; only ids and hashes are read."""
        stored = self._read("sets", "id long, content_hash string", "id", None, before)
        return first_of_hash(stored.join(hashes.select("content_hash").distinct(), "content_hash", "left_semi"), "content_hash", "id")

    def pairs(self, sets: DataFrame, threshold: float = THRESHOLD, before: str | None = None) -> DataFrame:
        """(a, b, score) of stored posts a and new entries b that share a band and enough shingles."""
        new = cut(bands(sets).select("band", F.col("id").alias("b"), F.col("n").alias("nb")))
        stored = self._read("bands", "id long, n int, band long", "band", new, before).select("band", F.col("id").alias("a"), F.col("n").alias("na"))
        met = cut(stored.join(new, "band").where(_alike("na", "nb", threshold)).select("a", "b").distinct())
        of = self._read("sets", "id long, n int, shingles binary", "id", met.select(F.col("a").alias("id")), before)
        return confirmed(met, of.unionByName(sets.select("id", "n", "shingles")), threshold)


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, index: NearIndex | None = None, run: str = "0", leaders: int = LEADERS) -> DataFrame:
    """(id, kept, canonical, score) of rows (id, clean_content, content_hash).

    ``index``: kept posts of earlier runs, which only can be originals; their ids come before all
    others.  This run's kept posts are added to it under the name ``run``.
    """
    # Copies are told by their hashes alone.  One pass over the other texts makes sizes and bands; sets, which are
    # larger than texts, only of posts that share a band, unless an index stores those of all kept posts.
    hashes = cut(rows.select(F.col("id").cast("long").alias("id"), "content_hash"))
    copies = cut(exact_duplicates(hashes, "content_hash", "id").where("canonical is not null").select("id", F.col("canonical").alias("first")))
    own = rows.select("id", "clean_content", *(["content_hash"] if index is not None else []))
    sets, told, known = cut(entries(own, with_sets=index is not None, without=copies.select("id"))), None, None
    there = index is not None and index.exists()
    if there:
        told = cut(sets.select("id", "content_hash").join(index.originals(sets, run), "content_hash").select("id", "canonical"))
        sets = sets.join(told, "id", "left_anti")
    if index is not None:
        sets = cut(sets)
    if there:
        known = index.pairs(sets, threshold, run)
    found = cut(resolve(sets, alike_pairs(sets, threshold, leaders, known=known, texts=rows if index is None else None)))
    if index is not None:
        index.add(sets.join(found.where("kept").select("id"), "id", "left_semi"), run)
    if told is not None:
        found = found.unionByName(told.select("id", "canonical", F.lit(1.0).alias("score"), F.lit(False).alias("kept")))
    of_first = found.select(F.col("id").alias("first"), F.col("canonical").alias("up"), F.col("score").alias("up_score"))
    # A copy of a kept post is its exact duplicate; of a duplicate, a duplicate of the same original.
    moved = copies.join(of_first, "first").select("id", F.coalesce("up", "first").alias("canonical"), F.coalesce("up_score", F.lit(1.0)).alias("score"), F.lit(False).alias("kept"))
    return found.select("id", "canonical", "score", "kept").unionByName(moved)


def by_signature(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The variant that scores pairs by equal signature positions instead of exact Jaccard; sets: entries with signatures."""
    signed = cut(sets)
    return resolve(signed, alike_pairs(signed, threshold, by="signature"))
