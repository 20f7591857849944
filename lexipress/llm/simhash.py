"""SimHash near-duplicates: pigeonhole blocks, bounded bucket joins, components.

A fingerprint is cut into five blocks.  Two that differ in at most two bits agree
in three blocks at least, so every pair shares one of the ten keys of three blocks.
Equal fingerprints are first folded into one.  Buckets of up to ``PAIRED`` different
fingerprints are compared pair by pair.  Fingerprints of any larger bucket are linked
without pairs: each stands with the 64 values one bit away and itself, and two
fingerprints share such a value exactly when they differ in at most two bits.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common, textkernel
from .components import components
from .substring_dedup import _bitmap

SHINGLE = 3
SEED = 42
#: Largest bucket whose members are compared pair by pair.
PAIRED = 24
#: First bit and width of each block.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Shingles whose bits are counted at once.
COUNTED = 255 * 128


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


#: Masks of each three blocks, as signed longs.
KEYS = tuple(_signed(sum(((1 << width) - 1) << first for first, width in three)) for three in combinations(BLOCKS, 3))


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint of the whole text; no words: zero."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.zeros_like(ends)
        starts[1:] = ends[:-1] + 1
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist())]  # noqa: B905
    h = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(h), COUNTED):
        bits = np.unpackbits(h[k : k + COUNTED].view(np.uint8), bitorder="little").reshape(-1, 64)
        full = len(bits) // 255 * 255
        if full:  # sums of 255 bits fit a byte
            ones += np.add.reduce(bits[:full].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[full:].sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * ones > len(h)).tolist())


_FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def _fingerprints(shingle: int, seed: int):
    def run(batches):
        for batch in batches:
            fps = [_signed(fingerprint(t, shingle, seed)) for t in common.text_values(batch.column("text"))]
            yield common.batch_of(_FINGERPRINTS, (batch.column("doc_id"), fps))

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""
    common.small_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(_fingerprints(shingle, seed), "doc_id long, fp long")


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) that join all fingerprints two or fewer bits apart; fps: distinct (fp).

    Every component over the links "at most two bits apart" is one component over
    these edges and the other way round.  A node may also be a value one bit away
    from its neighbours that is no fingerprint itself.
    """
    keyed = fps.select("fp", F.explode(F.array(*(F.struct(F.lit(k).cast("byte").alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(KEYS)))).alias("k"))
    keyed = keyed.select("fp", "k.c", "k.key")
    sizes = keyed.groupBy("c", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = common.materialise(keyed.join(sizes, ["c", "key"]), "buckets")
    listed = shared.where(F.col("n") <= PAIRED).groupBy("c", "key").agg(F.collect_list("fp").alias("all"))
    near = F.filter("all", lambda x: (x > F.col("a")) & (F.bit_count(x.bitwiseXOR(F.col("a"))) <= 2))
    pairs = listed.select("all", F.explode("all").alias("a")).select("a", F.explode(near).alias("b"))
    crowded = shared.where(F.col("n") > PAIRED).select("fp").distinct()
    flips = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k))))
    probes = crowded.select("fp", F.explode(flips).alias("probe"))
    met = probes.groupBy("probe").agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
    # A value that two fingerprints stand next to is a node; the fingerprints hang from it.
    met = met.where("least < most").select("probe")
    around = probes.join(met, "probe").select(F.col("fp").alias("a"), F.col("probe").alias("b"))
    return pairs.union(around)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of ``docs``.

    Texts without words, null ones among them, have fingerprint zero and link like
    any other.  Rows that share a doc_id are rows of their own; a null doc_id is
    never the smallest of its component unless all are null, when component_id is
    null.  Other columns are not read; an empty table gives no rows.
    """
    fps = common.materialise(fingerprints(docs, shingle, seed), "fingerprints")
    with common.passing():
        alone = common.materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "folded")
        found = common.materialise(components(links(alone.select("fp"))), "components").withColumnRenamed("node", "fp")
        named = alone.join(found, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
        named = common.materialise(named, "named")
        least = named.groupBy("component").agg(F.min("least").alias("component_id"))
        ids = common.materialise(named.join(least, "component").select("fp", "component_id"), "ids", stays=True)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(ids, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


# Groups by similarity: shingle sets, exactly compared

#: Largest bucket of a shingle whose members are paired off at once.
FEW = 8
#: Members of one part of a crowded bucket, and pairs of one document that a task compares.
PART = 1024
#: Hashes of the sets of one part, on the average.
HASHES = 1 << 21
#: Leaders that a crowded group is compared with first.
LEADERS = 4
#: One in so many documents has its shingles counted, to tell common ones: those in so many of
#: them.  The share is the same at every size, so the crowds that are left are, too.
SHARE = 8
OFTEN = 3
#: The commonest ones are ordered by their counts among each other.
COMMON = 1 << 16
_U = np.uint64
_SETS = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("name", pa.int64()), ("node", pa.int64()), ("fp", pa.int64()), ("size", pa.int32()), ("firsts", pa.list_(pa.int64()))])
_SETS_SPEC = "doc_id long, digest long, name long, node long, fp long, size int, firsts array<long>"
_WHOLE = pa.schema([("node", pa.int64()), ("hashes", pa.list_(pa.int64()))])
_KEYED = pa.schema([("node", pa.int64()), ("size", pa.int32()), ("pos", pa.int32()), ("key", pa.int64())])
#: Logarithm of the bits of each bitmap (4 MB): of the documents of candidate pairs, of the first
#: shingles that two documents share and of common shingles.  A fuller one changes no result.
BITS = 25


def _sets(column: pa.Array, shingle: int):
    """Different shingles of each text, as ascending hashes; fewer words are one shingle, no words none."""
    (h,), ends = textkernel.words(column, textkernel.SPACED_LOWER)
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        size = min(shingle, b - a)
        yield np.unique(textkernel.windows(h[a:b], size, size) if size else h[:0])


def _node(h: np.ndarray) -> int:
    return _signed(xxhash.xxh64_intdigest(h.tobytes(), SEED))


def _shingle_sets(shingle: int, similarity: float, order):
    """Fingerprint of each text; first shingles of its set, as many as it can lack in one as similar, and one, in one order over all documents.

    Shingles that are not known to be common come first, the commonest last.
    """

    def run(batches):
        common.leave_memory()
        known, often, crowd = order.value
        for batch in batches:
            fps = [_signed(fingerprint(t, shingle)) for t in common.text_values(batch.column("text"))]
            nodes, sizes, firsts = [], [], []
            for h in _sets(batch.column("text"), shingle):
                nodes.append(_node(h))
                sizes.append(len(h))
                few = len(h) - math.ceil(similarity * len(h) - 1e-9) + 1
                rank = _hits(crowd, h.view(np.int64)).astype(np.int64)
                if len(known) and rank.any():
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    rank += np.where(known[at] == h, often[at], 0)
                firsts.append(h[np.argsort(rank, kind="stable")][:few].view(np.int64))
            yield common.batch_of(_SETS, (batch.column("doc_id"), batch.column("digest"), batch.column("name"), nodes, fps, sizes, firsts))

    return run


def _hits(bitmap: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which names (int64) have their bit set."""
    bit = names & (len(bitmap) * 64 - 1)
    return (bitmap[bit >> 6] >> (bit & 63).astype(_U)) & _U(1) == 1


def _whole_sets(shingle: int, wanted):
    """Whole sets of the rows whose name is in the bitmap: those that stand for a candidate, and a few others."""

    def run(batches):
        common.leave_memory()
        for batch in batches:
            batch = batch.filter(pa.array(_hits(wanted.value, batch.column("name").to_numpy())))
            if batch.num_rows:
                rows = [(_node(h), h.view(np.int64)) for h in _sets(batch.column("text"), shingle)]
                yield common.batch_of(_WHOLE, zip(*rows, strict=True))

    return run


def _shared_firsts(shared):
    """node, size, pos, key of the first shingles whose bit is set."""

    def run(batches):
        for batch in batches:
            firsts, sizes = batch.column("firsts"), batch.column("size").to_numpy()
            counts = np.diff(firsts.offsets.to_numpy())
            keys = firsts.flatten().to_numpy()
            row = np.repeat(np.arange(len(counts)), counts)
            at = np.flatnonzero(_hits(shared.value, keys))
            pos = at - (np.cumsum(counts) - counts)[row[at]]
            yield common.batch_of(_KEYED, (batch.column("node").to_numpy()[row[at]], sizes[row[at]], pos.astype(np.int32), keys[at]))

    return run


def _common_shingles(source: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes (ascending) and counts of the commonest shingles, and a bitmap of all common ones.

    They set the order of the shingles alone, so they bear on the work and not on the result.
    """

    def run(batches):
        common.leave_memory()
        for batch in batches:
            for h in _sets(batch.column("text"), shingle):
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    drawn = source.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(SHARE)) == 0)
    with common.passing():
        often = common.materialise(drawn.mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= OFTEN), "common-shingles")
        found = often.orderBy(F.desc("n"), "h").limit(COMMON).toArrow()
        crowd = _bitmap(often.select(F.col("h").alias("name")), BITS)
    h = found.column("h").to_numpy().view(_U)
    order = np.argsort(h)
    return h[order], found.column("n").to_numpy()[order], crowd


def _may_be_similar(a_size, a_pos, b_size, b_pos, similarity: float):
    """If two sets that first meet in places a_pos and b_pos (from 0) can be as similar; columns or arrays.

    Before a first meeting nothing is shared, after it the shorter rest at most.
    """
    rest_a, rest_b = a_size - a_pos, b_size - b_pos
    least = F.least(rest_a, rest_b) if not isinstance(rest_a, np.ndarray) else np.minimum(rest_a, rest_b)
    return least * (1 + similarity) >= similarity * (a_size + b_size) - 1e-6


def _shared_counts(rows: np.ndarray, keys: np.ndarray, n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many keys each of ``left`` shares with each of ``right``; key k is one of member rows[k] of n."""
    found, at, often = np.unique(keys, return_inverse=True, return_counts=True)
    rows, at = rows[often[at] > 1], at[often[at] > 1]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for k in range(0, len(found), PART):  # a block of keys at a time
        here = (at >= k) & (at < k + PART)
        if here.any():
            has = np.zeros((n, PART), dtype=np.float32)
            has[rows[here], at[here] - k] = 1
            out += has[left] @ has[right].T
    return out


def _block(rows: pa.Table, lists: str):
    """Of one block: components, members of either part, the flat values of a list column and the member of each."""
    i, j, part = (rows.column(c).to_numpy() for c in ("i", "j", "part"))
    each = rows.column(lists).combine_chunks()
    of = np.repeat(np.arange(rows.num_rows), np.diff(each.offsets.to_numpy()))
    return rows.column("component").to_numpy(), np.flatnonzero(part == i[0]), np.flatnonzero(part == j[0]), each.flatten(), of


def _meeting(similarity: float):
    def run(rows: pa.Table) -> pa.Table:
        """Members that first meet one of another component in this bucket and, by their first shingles, can be similar to it.

        They meet first where no earlier first shingle is common, so a pair counts in one bucket.
        """
        comp, left, right, firsts, of = _block(rows, "firsts")
        size, pos = rows.column("size").to_numpy(), rows.column("pos").to_numpy()
        keys, early = firsts.field("key").to_numpy(), firsts.field("pos").to_numpy() < pos[of]
        shared = _shared_counts(of, keys, len(comp), left, right)
        ok = _shared_counts(of[early], keys[early], len(comp), left, right) == 0
        ok &= comp[left][:, None] != comp[right]
        a, b = size[left][:, None], size[right]
        ok &= _may_be_similar(a, pos[left][:, None], b, pos[right], similarity)
        ok &= (shared + np.ceil(similarity * np.maximum(a, b) - 1e-9) - 1) * (1 + similarity) >= similarity * (a + b) - 1e-6
        met = np.union1d(left[ok.any(axis=1)], right[ok.any(axis=0)])
        return rows.select(["key", "i", "j", "part", "node", "component"]).take(pa.array(met))

    return run


def _joined(similarity: float):
    def run(rows: pa.Table) -> pa.Table:
        """Pairs of members whose whole sets are as similar, as many as join what such pairs join and no more."""
        comp, left, right, hashes, of = _block(rows, "hashes")
        node, size = rows.column("node").to_numpy(), np.bincount(of, minlength=len(comp))
        shared = _shared_counts(of, hashes.to_numpy(), len(comp), left, right).astype(np.float64)
        ok = shared / (size[left][:, None] + size[right] - shared) >= similarity
        group, found = comp.copy(), []
        for k, row in zip(left, ok, strict=True):
            groups, at = np.unique(group[right[row]], return_index=True)
            new = groups != group[k]
            found += [(node[k], node[x]) for x in right[row][at[new]]]
            group[np.isin(group, groups[new])] = group[k]
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _attached(pairs: DataFrame, sets: DataFrame, side: str, other: str, name: str) -> DataFrame:
    """``pairs`` with the set of their ``side``; a document of many pairs is dealt over several tasks."""
    many = pairs.groupBy(side).agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64(other), F.coalesce("parts", F.lit(1))).cast("int")
    dealt = pairs.join(many, side, "left").withColumn("part", part).drop("parts")
    each = sets.withColumnRenamed("node", side).join(many, side, "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    return dealt.join(each.select(side, "part", F.col("hashes").alias(name)), [side, "part"]).drop("part")


def _likely(pairs: DataFrame, met: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) that can be as similar by what their first shingles share.

    Of the two last first shingles one comes before the other; what is shared up to it is
    among the first of both, and what is shared after it among the rest of its own set.
    """
    lists = met.groupBy("node").agg(F.first("size").alias("size"), F.collect_set("key").alias("keys"))
    lists = common.materialise(lists.select("node", F.struct("size", "keys").alias("hashes")), "first-lists")
    both = _attached(_attached(pairs, lists, "a", "b", "fa"), lists, "b", "a", "fb")
    shared = F.size(F.array_intersect("fa.keys", "fb.keys"))
    rest = lambda n: F.ceil(similarity * n - 1e-9) - 1
    a, b = F.col("fa.size"), F.col("fb.size")
    return both.where((shared + F.greatest(rest(a), rest(b))) * (1 + similarity) >= similarity * (a + b) - 1e-6).select("a", "b")


def _sets_of(nodes: DataFrame, names: DataFrame, source: DataFrame, shingle: int, what: str) -> DataFrame:
    """node, hashes: the whole sets of ``nodes``; names: the row (name) that stands for a node."""
    nodes = common.materialise(nodes.distinct().join(names, "node"), f"{what}-nodes")
    bitmap = source.sparkSession.sparkContext.broadcast(_bitmap(nodes.select("name"), BITS))
    whole = source.select("name", "text").mapInArrow(_whole_sets(shingle, bitmap), "node long, hashes array<long>")
    # Rows equal in doc_id and text have one name and one set; other sets of a bit but of no pair go.
    wanted = common.materialise(whole.join(nodes, "node", "left_semi").dropDuplicates(["node"]), f"{what}-sets")
    bitmap.destroy()
    return wanted


def _verified(pairs: DataFrame, met: DataFrame, names: DataFrame, source: DataFrame, shingle: int, similarity: float, what: str) -> DataFrame:
    """Those of the pairs (a, b) whose sets are as similar (Jaccard), compared whole; names: the row (name) that stands for a node."""
    with common.passing():
        pairs = common.materialise(_likely(common.materialise(pairs.distinct(), f"{what}-met"), met, similarity), f"{what}-pairs")
        wanted = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")), names, source, shingle, what)
        both = _attached(_attached(pairs, wanted, "a", "b", "fa"), wanted, "b", "a", "fb")
        shared = F.size(F.array_intersect("fa", "fb"))
        return common.materialise(both.where(shared / (F.size("fa") + F.size("fb") - shared) >= similarity).select("a", "b"), what, stays=True)


def similar_links(sets: DataFrame, source: DataFrame, shingle: int, similarity: float = 0.8) -> DataFrame:
    """Edges (a, b) that join all sets of at least the similarity; sets: node, name, size, firsts (different ones) of the texts of ``source``.

    Every component over the pairs at least as similar (Jaccard of the whole sets) is one
    over these edges and the other way round; every edge is such a pair.  Two such sets
    share a shingle among the first of each: as many as a set can lack in the other, and
    one.  Sets that share one are paired off in small buckets; pairs that share too few of
    their first ones go before any set is sent.  Members of a crowded bucket are compared
    with a leader first; then, in blocks, with those of other components, for only these can
    change one.  A block gives rows for members, never for pairs: first which of them may be
    similar to another, then, of their whole sets, the links that join components.
    """
    sets = sets.where("size > 0")
    names = sets.select("node", "name")
    shared = common.materialise(sets.select(F.explode("firsts").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared-firsts")
    # Most shingles are in one document: they end at the source, against a bitmap of fixed size.
    bitmap = source.sparkSession.sparkContext.broadcast(_bitmap(shared.select(F.col("key").alias("name")), BITS))
    keyed = sets.select("node", "size", "firsts").mapInArrow(_shared_firsts(bitmap), "node long, size int, pos int, key long")
    met = common.materialise(keyed.join(shared, "key"), "buckets")
    bitmap.destroy()
    fits = lambda x, y: _may_be_similar(x["size"], x["pos"], y["size"], y["pos"], similarity)
    one = F.col("one")
    few = met.where(F.col("n") <= FEW).groupBy("key").agg(F.collect_list(F.struct("node", "size", "pos")).alias("all"))
    near = F.filter("all", lambda x: (x["node"] > one["node"]) & fits(x, one))
    pairs = few.select("all", F.explode("all").alias("one")).select(one["node"].alias("a"), F.explode(near).alias("o")).select("a", F.col("o.node").alias("b"))
    crowd = met.where(F.col("n") > FEW)
    # Buckets of one group have few leaders between them, whatever their members.
    leads = crowd.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", F.pmod("key", F.lit(LEADERS))).alias("draw"), "node", "size", "pos")).alias("one"))
    star = crowd.join(leads, "key").where((F.col("node") != one["node"]) & _may_be_similar(F.col("size"), F.col("pos"), one["size"], one["pos"], similarity))
    star = star.select(F.least("node", one["node"]).alias("a"), F.greatest("node", one["node"]).alias("b"))
    first = _verified(pairs.union(star), met, names, source, shingle, similarity, "first-links")

    found = common.materialise(components(first), "first-components")
    with common.passing():
        placed = crowd.join(found, "node", "left").select("key", "node", "size", "pos", F.coalesce("component", "node").alias("component"))
        counts = placed.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("size").alias("hashes"))
        most = F.max(F.struct("n", "hashes", "component"))
        mixed = counts.groupBy("key").agg(F.count("*").alias("components"), F.sum("n").alias("n"), F.sum("hashes").alias("hashes"), most.alias("most")).where("components > 1")
        parts = lambda n, hashes: F.ceil(F.greatest(n / PART, hashes / HASHES)).cast("int")
        rest = parts(F.col("n") - F.col("most.n"), F.col("hashes") - F.col("most.hashes")).alias("rest")
        mixed = common.materialise(mixed.select("key", F.col("most.component").alias("largest"), rest, parts(F.col("most.n"), F.col("most.hashes")).alias("large")), "mixed")
        # A bucket's largest component is parts of its own, which meet the other parts but not each other.
        inside, draw = F.col("component") == F.col("largest"), F.xxhash64("node")
        part = F.when(inside, F.col("rest") + F.pmod(draw, F.col("large"))).otherwise(F.pmod(draw, F.col("rest"))).cast("int")
        others = F.sequence(F.lit(0), F.when(inside, F.col("rest")).otherwise(F.col("rest") + F.col("large")) - 1)
        member = placed.join(mixed, "key").select("key", "node", "size", "pos", "component", part.alias("part"), F.explode(others).alias("other"))
        lists = met.join(member.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.collect_list(F.struct("key", "pos")).alias("firsts"))
        blocks = member.join(lists, "node").select("*", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")).drop("other")
        meeting = blocks.groupBy("key", "i", "j").applyInArrow(_meeting(similarity), "key long, i int, j int, part int, node long, component long")
        meeting = common.materialise(meeting, "meeting")
        whole = meeting.join(_sets_of(meeting.select("node"), names, source, shingle, "meeting"), "node")
        rest = common.materialise(whole.groupBy("key", "i", "j").applyInArrow(_joined(similarity), "a long, b long"), "rest-links", stays=True)
    return first.union(rest)


def _fingerprint_links(sets: DataFrame) -> DataFrame:
    """Edges (a, b) that join all sets of which two texts have fingerprints at most two bits apart; sets: node, fps.

    A set has several fingerprints if texts repeat its shingles differently.  A fingerprint
    is a node only where it links with another one; sets of equal ones hang from the least set.
    """
    with common.passing():
        marked = common.materialise(sets.select("node", F.explode("fps").alias("fp")), "fingerprints", stays=True)
        alone = common.materialise(marked.groupBy("fp").agg(F.min("node").alias("least"), F.max("node").alias("most")), "fingerprints-folded", stays=True)
        near = common.materialise(links(alone.select("fp")), "fingerprint-links", stays=True)
    ends = near.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    equal = marked.join(alone.where("least < most"), "fp").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    return near.union(equal).union(alone.join(ends, "fp").select(F.col("least").alias("a"), F.col("fp").alias("b")))


def keep_one(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the smallest doc_id.

    Two documents are near duplicates if their SimHash fingerprints differ in at most two
    bits, as in ``near_duplicates`` but of shingles of ``shingle`` words, or if their sets of
    such shingles are at least as similar as ``similarity`` (Jaccard of the whole sets): 64
    bits can miss these, so an exact search adds them.  Groups are the components; a text of fewer
    words is one shingle, and texts without words are one group.  Null doc_ids come last; of rows that share a doc_id the
    one of the smallest text digest stays, and of rows equal in both one.  All columns are kept.
    An empty table stays empty; long texts are taken whole.
    """
    spark = docs.sparkSession
    common.small_batches(spark)
    key = lambda doc_id, digest: F.xxhash64(F.coalesce(doc_id, F.lit(0).cast("long")), doc_id.isNull(), digest)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    source = source.withColumn("digest", F.xxhash64("text")).withColumn("name", key(F.col("doc_id"), F.col("digest")))
    with common.passing():
        order = spark.sparkContext.broadcast(_common_shingles(source, shingle))
        ranked = source.mapInArrow(_shingle_sets(shingle, similarity, order), _SETS_SPEC)
        rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest", "name")
        alone = common.materialise(ranked.groupBy("node").agg(F.min(rank).alias("rank"), F.collect_set("fp").alias("fps"), F.first("size").alias("size"), F.first("firsts").alias("firsts")), "folded")
        order.destroy()
        alike = _fingerprint_links(alone.select("node", "fps"))
        similar = similar_links(alone.select("node", "rank.name", "size", "firsts"), source, shingle, similarity)
        found = common.materialise(components(alike.union(similar)), "components")
        first = alone.select("node", "rank").join(found, "node", "left").groupBy(F.coalesce("component", "node").alias("group")).agg(F.min("rank").alias("rank"))
        kept = common.materialise(first.select(F.col("rank.name").alias("_key"), F.col("rank.digest").alias("_digest")), "kept", stays=True)
    k, d, again, kd = common.free_names(docs, 4)
    keyed = docs.withColumn(d, F.xxhash64(F.col("text").cast("string"))).withColumn(k, key(F.col("doc_id").cast("long"), F.col(d)))
    # One shuffle of the texts, by key: the window below finds them dealt that way.
    chosen = keyed.join(kept.select(F.col("_key").alias(k), F.col("_digest").alias(kd)), k).where(F.col(d).bitwiseXOR(F.col(kd)) == 0)
    count = F.row_number().over(W.partitionBy(k, "doc_id", d).orderBy(F.lit(1)))
    return chosen.withColumn(again, count).where(F.col(again) == 1).select(*(F.col(f"`{c}`") for c in docs.columns))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: fingerprint and component of every document."""
    return near_duplicates(common.read_table(spark, sf_dir, "documents"))
