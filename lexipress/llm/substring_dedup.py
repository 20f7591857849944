"""Substring deduplication by recompression.

A document is a sequence of word names.  A round of recompression names runs (equal
neighbours become one symbol, whatever their number) and pairs (a symbol of the left
half of the alphabet and its right neighbour, if of the right half, become one symbol).
Names are hashes of what they stand for, so they are the same in every partition
without a look-up, and whether neighbours go together depends on their names alone:
equal substrings are parsed alike but for a symbol at either end of each round.

For every window of ``WINDOW`` words the inner symbols of a round are fixed by the
window's words; of each ``SYMBOLS`` of them in a row, in the highest round that has so
many, the least by hash is its anchor (for a window of fewer inner symbols, its own
hash).  Equal windows have equal anchors.  Spark
groups anchors over all documents, and only windows whose anchor two different texts
share are hashed, with 96 bits, and grouped in turn: a window is repeated when a smaller
doc_id has the same hash.  Whole copies are told by their digest, so that they make no
windows of their own.  What is broadcast is a bitmap of fixed size of shared anchors; a
fuller bitmap lets more windows through to the exact step and changes no result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, textkernel
from .textkernel import mix

WINDOW = 13
ROUNDS = 1
#: Neighbouring symbols of an anchor: enough words that few anchors are shared by chance.
SYMBOLS = 4
#: log2 of the bits of the broadcast bitmap (16 MB).
BITMAP_BITS = 27
_U = np.uint64
_LEVEL = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)


def _runs(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of runs, and of each symbol the number of its run."""
    first = np.ones(len(names), dtype=bool)
    first[1:] = names[1:] != names[:-1]
    return names[first], np.cumsum(first) - 1


def _pairs(names: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Names after pairing, and of each symbol the number of what it went into."""
    right = (mix(names ^ _U(_LEVEL[level % 4])) & _U(1)).astype(bool)
    starts = np.zeros(len(names), dtype=bool)
    starts[:-1] = ~right[:-1] & right[1:]
    second = np.zeros(len(names), dtype=bool)
    second[1:] = starts[:-1]
    made = names.copy()
    at = np.flatnonzero(starts)
    made[at] = mix(names[at] * _U(0x9FB21C651E98DF25) + mix(names[at + 1]) + _U(level + 1))
    return made[~second], np.cumsum(~second) - 1


def _least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least value of each range first..last, both included and last - first < WINDOW."""
    size = last - first + 1
    out = np.empty(len(first), dtype=values.dtype)
    table, span = values, 1
    while True:
        here = (size >= span) & (size < 2 * span)
        a, b = first[here], last[here] - span + 1
        out[here] = np.minimum(table[a], table[b])
        if not (size >= 2 * span).any():
            return out
        table = np.minimum(table[:-span], table[span:]) if len(table) > span else table
        span *= 2


def anchors(words: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS, symbols: int = SYMBOLS) -> np.ndarray:
    """Anchor of each window of a word sequence (windows across documents included: drop those)."""
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    out = np.zeros(n, dtype=_U)
    todo = np.ones(n, dtype=bool)
    names, first, last = words, np.arange(n), np.arange(window - 1, len(words))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    left = np.arange(n)
    for level in range(rounds):
        runs, run_of = _runs(names)
        names, at = _pairs(runs, level)
        first, last = at[run_of[first]] + 1, at[run_of[last]] - 1
        inner = first <= last
        left, first, last = left[inner], first[inner], last[inner]
        enough = last - first + 1 >= symbols
        rows = textkernel.windows(names ^ _U(_LEVEL[3 - level % 4]), symbols, level)
        found.append((rows, left[enough], first[enough], last[enough] - symbols + 1))
    for values, of, a, b in reversed(found):
        new = todo[of]
        out[of[new]] = _least(values, a[new], b[new])
        todo[of[new]] = False
    if todo.any():
        out[todo] = textkernel.windows(words, window, 7)[todo]
    return out


def _inside(row_ends: np.ndarray, n_words: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows that lie in one row, and their rows."""
    starts = np.concatenate(([0], row_ends[:-1]))
    sizes = np.maximum(row_ends - starts - window + 1, 0)
    rows = np.repeat(np.arange(len(row_ends)), sizes)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
    return at, rows


#: Rows of a batch whose words are handled at once.
_ROWS = 64
_ANCHORS = pa.schema([("name", pa.int64()), ("digest", pa.int64())])
_WINDOWS = pa.schema([("w1", pa.int64()), ("w2", pa.int32()), ("doc_id", pa.int64()), ("tag", pa.int32()), ("at", pa.int32())])
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def _parsed(batches, window: int, rounds: int, hashes: int):
    for whole in batches:
        for k in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(k, _ROWS)
            found, ends = textkernel.words(batch.column("text"), textkernel.SPACED, hashes=hashes)
            at, rows = _inside(ends, len(found[0]), window)
            if len(at):
                starts = np.concatenate(([0], ends[:-1]))
                yield batch, found, at, rows, starts, anchors(found[0], window, rounds)[at]


def _anchor_rows(window: int, rounds: int):
    def run(batches):
        for batch, _, _, rows, _, names in _parsed(batches, window, rounds, 1):
            new = np.ones(len(names), dtype=bool)
            new[1:] = (names[1:] != names[:-1]) | (rows[1:] != rows[:-1])
            digests = batch.column("digest").to_numpy(zero_copy_only=False)
            yield common.batch_of(_ANCHORS, (names[new].view(np.int64), digests[rows[new]]))

    return run


def _window_rows(window: int, rounds: int, shared):
    def run(batches):
        bitmap = shared.value
        mask = _U(len(bitmap) * 64 - 1)
        for batch, found, at, rows, starts, names in _parsed(batches, window, rounds, 2):
            bit = names & mask
            hit = (bitmap[(bit >> _U(6)).astype(np.int64)] >> (bit & _U(63))) & _U(1) == 1
            if not hit.any():
                continue
            at, rows = at[hit], rows[hit]
            w1 = textkernel.windows(found[0], window)[at].view(np.int64)
            w2 = (textkernel.windows(found[1], window, 3)[at] >> _U(32)).astype(np.uint32).view(np.int32)
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False)[rows] for c in ("doc_id", "tag"))
            yield common.batch_of(_WINDOWS, (w1, w2, ids, tags, (at - starts[rows]).astype(np.int32)))

    return run


def _keep(window: int, with_text: bool):
    def run(batches):
        for batch in batches:
            texts = common.text_values(batch.column("text"))
            ids, whole, starts = (batch.column(c) for c in ("doc_id", "whole", "starts"))
            rows = []
            for text, doc, copy, covered in zip(texts, ids.to_pylist(), whole.to_pylist(), starts, strict=True):
                words = text.encode().split()
                n, removed = len(words), 0
                if copy and n >= window:
                    removed, words = n, []
                elif covered.is_valid:
                    change = np.zeros(n + 1, dtype=np.int64)
                    at = covered.values.to_numpy(zero_copy_only=False)
                    np.add.at(change, at, 1)
                    np.add.at(change, at + window, -1)
                    gone = np.cumsum(change[:-1]) > 0
                    removed = int(gone.sum())
                    words = [words[i] for i in np.flatnonzero(~gone).tolist()]
                kept = b" ".join(words)
                rows.append((doc, n, removed, hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            if rows:
                yield common.batch_of(_KEPT, zip(*rows, strict=True))

    return run


def _bitmap(names: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of a column of longs; at most 2**(bits - 6) rows reach the driver, whatever the input."""
    at = F.col("name").bitwiseAND(F.lit((1 << bits) - 1))
    words = names.select(F.call_function("shiftright", at, F.lit(6)).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    with common.shuffles_dropped(names.sparkSession):
        table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(1 << (bits - 6), dtype=_U)
    bitmap[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(_U)
    return bitmap


def _shared_anchors(named: DataFrame, window: int, rounds: int, bits: int) -> np.ndarray:
    """Bitmap of the anchors that two different texts share."""
    names = named.select("text", "digest").mapInArrow(_anchor_rows(window, rounds), "name long, digest long")
    shared = names.groupBy("name").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b").select("name")
    return _bitmap(shared, bits)


def remove_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, with_text: bool = True, bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """Remove every word in a window of ``window`` words that a smaller doc_id has too.

    Returns doc_id, n_words, n_removed, kept_sha256 and the kept words, joined by one
    space (null unless ``with_text``), of every row.  Null texts have no words.  A row
    with a null doc_id is kept whole and is nobody's source.  Rows that share a doc_id
    do not remove from each other.  An empty table gives no rows; long texts are taken whole.  Other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    common.small_batches(spark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    source = source.withColumn("md5", F.md5(F.coalesce("text", F.lit(""))))
    source = source.withColumn("digest", F.xxhash64("md5"))

    # Tells rows that share a doc_id apart.
    source = source.withColumn("tag", F.hash("md5"))
    named = source.where("doc_id is not null and text is not null")
    bitmap = spark.sparkContext.broadcast(_shared_anchors(named, window, rounds, bitmap_bits))

    spec = "w1 long, w2 int, doc_id long, tag int, at int"
    found = named.select("doc_id", "text", "tag").mapInArrow(_window_rows(window, rounds, bitmap), spec)
    # Grouped by both hashes, joined by the first alone (the second is compared in a way that does
    # not make it a key), so that the join has a shuffle of its own and Spark can split a hot window.
    least = found.groupBy("w1", "w2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("w1", F.col("w2").alias("v2"), "least")
    covered = found.join(least, "w1").where("(w2 ^ v2) = 0 and doc_id > least").groupBy("doc_id", "tag").agg(F.collect_set("at").alias("starts"))

    # As above: grouped by digest and tag, joined by digest alone.
    originals = named.groupBy("md5", "tag").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("md5", "least")
    copies = named.select("doc_id", "md5", "tag").join(originals, "md5").where("doc_id > least").select("doc_id", "tag").distinct().withColumn("whole", F.lit(True))
    marks = common.materialise(covered.join(copies, ["doc_id", "tag"], "full"), "covered")
    joined = source.select("doc_id", "text", "tag").join(marks, ["doc_id", "tag"], "left").select("doc_id", "text", "whole", "starts")
    return joined.mapInArrow(_keep(window, with_text), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: doc_id, n_words, n_removed, kept_sha256."""
    return remove_repeats(common.read_table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
