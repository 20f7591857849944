"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over neighbouring words: hashes are taken of the words at its
positions and the others are ignored.  Any ten aligned words of which eight or more
are equal leave one of the three seeds unhurt at some offset, so the join of seed
hashes of benchmark and documents misses none of them.  Hits are then verified: around
a hit, words are compared position by position along its diagonal.

Documents' seed hashes are tested against a bitmap of the benchmark's (fixed size,
whatever the benchmark's) before they leave the worker that made them, so what is
shuffled is little more than true hits.  A fuller bitmap lets more hashes through to
the join and changes no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, textkernel
from .substring_dedup import _bitmap
from .textkernel import mix

#: An overlap has a stretch of so many aligned words, of which so many are equal.
STRETCH = 10
EQUAL = 8
#: Word positions of the seeds; any two unequal words in ten miss one of them.
SEEDS = ((0, 1, 2, 4, 5), (0, 1, 3, 5, 6), (0, 1, 2, 5, 6))
#: Items of fewer words than STRETCH, and at least so many, must occur whole but for one word;
#: shorter ones, which any text may hold by chance, must be all the words of a document.
SHORTEST = 5
BITMAP_BITS = 26
_U = np.uint64
_ROWS = 64

_SEED_ROWS = pa.schema([("item_id", pa.int64()), ("at", pa.int32()), ("name", pa.int64()), ("words", pa.list_(pa.int64()))])
_HIT = pa.struct([("at", pa.int32()), ("name", pa.int64())])
_REGIONS = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("first", pa.int32()), ("words", pa.list_(pa.int64())), ("hits", pa.list_(_HIT))])
_OVERLAPS = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("item_id", pa.int64()), ("doc_start", pa.int64()), ("item_start", pa.int64()), ("n_words", pa.int64()), ("n_equal", pa.int64())])
_REGION_SPEC = "doc_id long, digest long, first int, words array<long>, hits array<struct<at: int, name: long>>"
_OVERLAP_SPEC = "doc_id long, digest long, item_id long, doc_start long, item_start long, n_words long, n_equal long"


def _item_masks(n: int) -> tuple[tuple[int, ...], ...]:
    """Seeds of an item of n words.  Of an item under STRETCH each ignores a third of the places: one unequal word misses one seed."""
    if n >= STRETCH:
        return SEEDS
    if n < SHORTEST:
        return (tuple(range(n)),)
    return tuple(tuple(p for p in range(n) if p % 3 != r) for r in range(3))


def _masks(short: list[int]) -> list[tuple[tuple[int, ...], int]]:
    """Seeds of documents, and how many words a document of a hit must have (0: any number)."""
    masks = dict.fromkeys((m, 0) for m in SEEDS)
    masks |= dict.fromkeys((m, n if n < SHORTEST else 0) for n in short for m in _item_masks(n))
    return list(masks)


def _seed_hashes(h: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    size = len(h) - mask[-1]
    if size <= 0:
        return np.zeros(0, dtype=_U)
    total, factor, base = np.full(size, sum(1 << p for p in mask), dtype=_U), 1, 0xD6E8FEB86659FD93
    for p in mask:
        factor = factor * base % (1 << 64)
        total += h[p : p + size] * _U(factor)
    return mix(total)


def _item_words(batches):
    for batch in batches:
        (h,), ends = textkernel.words(batch.column("text"), textkernel.ALNUM)
        h = h.view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array([h[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)], type=pa.list_(pa.int64()))], names=["item_id", "words"])


def _item_seeds(batches):
    for batch in batches:
        for item, words in zip(batch.column("item_id").to_pylist(), batch.column("words"), strict=True):
            h = words.values.to_numpy(zero_copy_only=False).view(_U)
            for mask in _item_masks(len(h)):
                names = _seed_hashes(h, mask).view(np.int64)
                if len(h) < STRETCH:
                    names = names[:1]  # the item as a whole
                if len(names):
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(names), pa.int64()), pa.array(np.arange(len(names), dtype=np.int32)), pa.array(names)], names=["item_id", "at", "name"])


def _regions(masks: list[tuple[tuple[int, ...], int]], shared):
    def run(batches):
        common.leave_memory()
        bitmap = shared.value
        bits = _U(len(bitmap) * 64 - 1)

        def known(names: np.ndarray) -> np.ndarray:
            bit = names & bits
            return (bitmap[(bit >> _U(6)).astype(np.int64)] >> (bit & _U(63))) & _U(1) == 1

        for whole in batches:
            for k in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(k, _ROWS)
                (h,), ends = textkernel.words(batch.column("text"), textkernel.ALNUM)
                ats, names = [], []
                sizes = np.diff(ends, prepend=0)
                for mask, only in masks:
                    made = _seed_hashes(h, mask)
                    at = np.flatnonzero(known(made))
                    row = np.searchsorted(ends, at, side="right")
                    inside = at + mask[-1] < ends[row]  # a seed lies in one document
                    at = at[inside & (sizes[row] == only)] if only else at[inside]
                    ats.append(at)
                    names.append(made[at].view(np.int64))
                at, name = np.concatenate(ats), np.concatenate(names)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, name = at[order], name[order]
                row = np.searchsorted(ends, at, side="right")
                cut = np.flatnonzero((row[1:] != row[:-1]) | (at[1:] - at[:-1] > 2 * STRETCH)) + 1
                rows = []
                for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(at)], strict=True):
                    r = int(row[a])
                    start = int(ends[r - 1]) if r else 0
                    lo, hi = max(start, int(at[a]) - STRETCH), min(int(ends[r]), int(at[b - 1]) + 2 * STRETCH)
                    hits = [{"at": x - start, "name": y} for x, y in zip(at[a:b].tolist(), name[a:b].tolist(), strict=True)]
                    rows.append((batch.column("doc_id")[r].as_py(), batch.column("digest")[r].as_py(), lo - start, h[lo:hi].view(np.int64), hits))
                yield common.batch_of(_REGIONS, zip(*rows, strict=True))

    return run


def best_stretch(equal: np.ndarray, stretch: int = STRETCH, least: int = EQUAL) -> tuple[int, int] | None:
    """First and last + 1 of the longest run of positions covered by stretches with enough equal words."""
    if len(equal) < stretch:
        return None
    total = np.concatenate(([0], np.cumsum(equal)))
    good = total[stretch:] - total[:-stretch] >= least
    if not good.any():
        return None
    covered = np.zeros(len(equal) + 1, dtype=np.int64)
    at = np.flatnonzero(good)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + stretch, -1)
    inside = np.concatenate(([False], np.cumsum(covered[:-1]) > 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    k = int(np.argmax(edges[1::2] - edges[::2]))
    a, b = int(edges[2 * k]), int(edges[2 * k + 1])
    on = np.flatnonzero(equal[a:b])  # trim unequal words at the ends
    return a + int(on[0]), a + int(on[-1]) + 1


def _verify(batches):
    for batch in batches:
        rows = []
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "digest", "item_id", "first", "diagonal")]
        for doc, digest, item, first, diagonal, words, own in zip(*columns, batch.column("words"), batch.column("item_words"), strict=True):
            w, v = words.values.to_numpy(zero_copy_only=False), own.values.to_numpy(zero_copy_only=False)
            # Word j of the item stands at diagonal + j of the document, first of the document at 0 of w.
            shift = diagonal - first
            lo, hi = max(0, -shift), min(len(v), len(w) - shift)
            if hi <= lo:
                continue
            equal = v[lo:hi] == w[lo + shift : hi + shift]
            if len(v) >= STRETCH:
                found = best_stretch(equal)
            else:
                found = (0, len(v)) if hi - lo == len(v) and equal.sum() >= len(v) - (len(v) >= SHORTEST) else None
            if found:
                a, b = found
                rows.append((doc, digest, item, diagonal + lo + a, lo + a, b - a, int(equal[a:b].sum())))
        if rows:
            yield common.batch_of(_OVERLAPS, zip(*rows, strict=True))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Overlaps of documents and benchmark items: doc_id, digest, item_id, doc_start, item_start, n_words, n_equal.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII,
    A-Z in lower case; starts count words from 0.  One row for each document, item and
    diagonal: its longest verified stretch.  ``digest`` (xxhash64 of the text) tells rows
    that share a doc_id apart; rows equal in both give one.  Items of equal words are
    compared once and each have their rows.  An item of SHORTEST to nine words must occur
    whole but for one word, a shorter one must be all the words of a document; null texts
    and items without words overlap with nothing.  Other columns are not read; an empty
    table gives no rows; long texts are taken whole.
    """
    items = _items(benchmark)
    alone = common.materialise(items.groupBy("words").agg(F.min("item_id").alias("item_id")).select("item_id", "words"), "items")
    again = items.join(alone.select("words", F.col("item_id").alias("first")), "words").select("item_id", "first").distinct()
    found = _overlaps(docs, alone).withColumnRenamed("item_id", "first")
    return found.join(again, "first").select("doc_id", "digest", "item_id", "doc_start", "item_start", "n_words", "n_equal")


def _items(benchmark: DataFrame) -> DataFrame:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    return items.mapInArrow(_item_words, "item_id long, words array<long>").where(F.size("words") > 0)


def _overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``overlaps`` with items (item_id, words) of different words."""
    spark: SparkSession = docs.sparkSession
    common.small_batches(spark)
    seeds = common.materialise(items.mapInArrow(_item_seeds, "item_id long, at int, name long").distinct(), "seeds")
    bitmap = spark.sparkContext.broadcast(_bitmap(seeds.select("name"), BITMAP_BITS))
    short = sorted(r[0] for r in items.where(F.size("words") < STRETCH).select(F.size("words")).distinct().collect())

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    source = source.select("doc_id", F.xxhash64("text").alias("digest"), "text")
    regions = common.materialise(source.mapInArrow(_regions(_masks(short), bitmap), _REGION_SPEC), "regions", "lz4")
    hits = regions.select("doc_id", "digest", "first", F.explode("hits").alias("hit")).select("doc_id", "digest", "first", F.col("hit.at").alias("doc_at"), "hit.name")
    met = hits.join(seeds, "name").select("doc_id", "digest", "first", "item_id", (F.col("doc_at") - F.col("at")).alias("diagonal")).distinct()
    own = items.select("item_id", F.col("words").alias("item_words"))
    key = [F.col("m.doc_id").eqNullSafe(F.col("r.doc_id")), F.col("m.digest") == F.col("r.digest"), F.col("m.first") == F.col("r.first")]
    both = met.alias("m").join(regions.select("doc_id", "digest", "first", "words").distinct().alias("r"), key).select("m.*", "r.words").join(own, "item_id")
    found = both.mapInArrow(_verify, _OVERLAP_SPEC)
    # Regions of one document may meet an item on one diagonal more than once.
    best = found.groupBy("doc_id", "digest", "item_id", (F.col("doc_start") - F.col("item_start")).alias("diagonal")).agg(F.max(F.struct("n_words", "n_equal", -F.col("doc_start"), "item_start")).alias("x"))
    return best.select("doc_id", "digest", "item_id", (F.col("diagonal") + F.col("x.item_start")).alias("doc_start"), "x.item_start", "x.n_words", "x.n_equal")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that overlap with a benchmark item; all columns are kept.

    Null texts stay; an empty benchmark leaves all rows, an empty table gives none.
    """
    one, two = common.free_names(docs, 2)
    items = common.materialise(_items(benchmark).groupBy("words").agg(F.min("item_id").alias("item_id")).select("item_id", "words"), "items")
    found = common.materialise(_overlaps(docs, items).select(F.col("doc_id").alias(one), F.col("digest").alias(two)).distinct(), "contaminated")
    return docs.join(found, (F.col("doc_id").cast("long").eqNullSafe(F.col(one))) & (F.xxhash64(F.col("text").cast("string")) == F.col(two)), "left_anti")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` against whole ``benchmark``: doc_id, item_id and place of every overlap."""
    return overlaps(common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "benchmark")).drop("digest")
