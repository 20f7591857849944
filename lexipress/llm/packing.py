"""Best-fit packing by hierarchical residual packing.

Tokenising cuts only documents over the capacity.  Every partition best-fits its
own pieces (longest first, into the fullest bin that still takes them).  Bins that
are nearly full are emitted; underfull ones become items, pieces and all, of the
next round, in which a quarter as many partitions best-fit them, up to one
partition.  A bin holds at most ``capacity`` pieces, so an item stays small, and
what a round passes on is the little that its bins left open.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .tokens import encoder, vocabulary

CAPACITY = 2048
#: A bin with at most this many free places is emitted before the last round.
NEARLY_FULL = 2
#: Items that a task holds at once in the first round, and that one partition of a later round gets at most on average.
LOCAL_ITEMS = 50_000
FAN_IN = 4
#: Rounds end when one leaves more than this share of its items underfull.
SHRINKS = 0.98

_PIECE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64())])
_BINS = pa.schema([("sequence_id", pa.int64()), ("used", pa.int64()), ("done", pa.bool_()), ("pieces", pa.list_(_PIECE))])
_BIN_SPEC = "sequence_id long, used long, done boolean, pieces array<struct<doc_id: long, piece: int, start: long, length: long, ids_crc32: long, offset: long>>"


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: items in descending size, each into the fullest open bin that takes it."""
    bins: list[list[int]] = []
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free places
    free: list[int] = []  # the values of free places that some bin has, sorted
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = bisect_left(free, sizes[i])
        if at < len(free):
            left = free[at]
            k = waiting[left].pop()
            if not waiting[left]:
                free.pop(at)
        else:
            left, k = capacity, len(bins)
            bins.append([])
        bins[k].append(i)
        left -= sizes[i]
        if left:
            if not waiting[left]:
                insort(free, left)
            waiting[left].append(k)
    return bins


def _emit(groups: list[list[dict]], base: int, capacity: int, last: bool, slack: int):
    used = []
    for g in groups:
        at = 0
        for p in g:
            p["offset"] = at
            at += p["length"]
        used.append(at)
    for k in range(0, len(groups), 2000):
        part = groups[k : k + 2000]
        yield common.batch_of(_BINS, ([base + k + i for i in range(len(part))], used[k : k + 2000], [last or u >= capacity - slack for u in used[k : k + 2000]], part))


def _first_id(round_no: int) -> int:
    """Sequence ids: round, then partition, then a count; a repeated task makes the same ones."""
    return (round_no << 58) | (TaskContext.get().partitionId() << 32)


def _cut_and_pack(path: str, capacity: int, slack: int):
    def run(batches):
        enc, base, held = encoder(path), _first_id(1), []
        for batch in batches:
            texts, ids = common.text_values(batch.column("text")), batch.column("doc_id").to_pylist()
            for k in range(0, len(texts), 1000):
                for doc, blob in zip(ids[k : k + 1000], enc.encode_bytes(texts[k : k + 1000]), strict=True):
                    values = np.frombuffer(blob, dtype=enc.dtype).astype("<u4")
                    for n, start in enumerate(range(0, len(values), capacity)):
                        cut = values[start : start + capacity]
                        held.append({"doc_id": doc, "piece": n, "start": start, "length": len(cut), "ids_crc32": zlib.crc32(cut.tobytes())})
            while len(held) >= LOCAL_ITEMS:
                groups = _packed([[p] for p in held[:LOCAL_ITEMS]], capacity)
                held = held[LOCAL_ITEMS:]
                yield from _emit(groups, base, capacity, False, slack)
                base += len(groups)
        yield from _emit(_packed([[p] for p in held], capacity), base, capacity, False, slack)

    return run


def _packed(items: list[list[dict]], capacity: int) -> list[list[dict]]:
    """Bins of pieces out of items that are lists of pieces."""
    items = sorted(items, key=lambda g: (-sum(p["length"] for p in g), [(p["doc_id"] is not None, p["doc_id"] or 0, p["piece"], p["ids_crc32"]) for p in g]))
    return [[p for i in group for p in items[i]] for group in best_fit([sum(p["length"] for p in g) for g in items], capacity)]


def _repack(round_no: int, capacity: int, last: bool, slack: int):
    def run(batches):
        items = [g for batch in batches for g in batch.column("pieces").to_pylist()]
        yield from _emit(_packed(items, capacity), _first_id(round_no), capacity, last, slack)

    return run


def pack(docs: DataFrame, vocab: str | None = None, capacity: int = CAPACITY, slack: int = NEARLY_FULL) -> DataFrame:
    """Pack all documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts give one piece with END_ID alone.  Rows that share a
    doc_id, or are equal, are packed each on their own; null doc_ids are kept.
    Other columns are not read.  An empty table gives no rows; only documents of
    more than ``capacity`` tokens are cut, whatever their length.
    """
    spark: SparkSession = docs.sparkSession
    common.small_batches(spark)
    path = vocab or vocabulary("word_bpe_49k.json")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bins = common.materialise(source.mapInArrow(_cut_and_pack(path, capacity, slack), _BIN_SPEC), "bins-1")
    done, n = [bins.where("done")], bins.rdd.getNumPartitions()
    round_no, before = 2, None
    while True:
        rest = bins.where("not done")
        left = rest.count()
        if not left:
            break
        if before is not None and left > before * SHRINKS:  # what is left does not go together
            done.append(rest)
            break
        before = left
        n = max(1, min(-(-n // FAN_IN), -(-left // 64)), -(-left // LOCAL_ITEMS))
        last = n == 1
        bins = common.materialise(rest.repartition(n, "sequence_id").mapInArrow(_repack(round_no, capacity, last, slack), _BIN_SPEC), f"bins-{round_no}")
        done.append(bins.where("done"))
        round_no += 1
        if last:
            break
    packed = done[0]
    for more in done[1:]:
        packed = packed.unionByName(more)
    placed = packed.select("sequence_id", F.explode("pieces").alias("p"))
    return placed.select("p.doc_id", "p.piece", "p.start", "p.length", "p.ids_crc32", "sequence_id", "p.offset")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``, sequences of 2048 tokens: one row a piece."""
    return pack(common.read_table(spark, sf_dir, "documents"))
