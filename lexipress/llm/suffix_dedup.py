"""Suffix-array deduplication of bytes by deep-shallow sorting.

A byte goes if a string of ``WINDOW`` bytes that covers it starts at two places or more.
Equal strings are told by sorting suffixes and comparing neighbours, in three steps:

1. **Deal.** The name of a window is the least hash of the ``GRAM``-byte strings in it, so
   equal windows have equal names.  Neighbouring windows of one name are a run, about ninety
   starts long.  Spark counts names; only runs whose name occurs again keep their bytes (a
   *chunk*: the run's first window to its last).  Equal chunks are folded by their bytes.
2. **Sort.** The suffixes of all chunks of a name meet in one task and are sorted there:
   multikey quicksort by keys of eight bytes to a shallow depth, then blind tries for groups
   that share a longer prefix.  A suffix that equals its neighbour in ``WINDOW`` bytes is a
   repeat; every start of a chunk that occurs twice is one.
3. **Cover.** Repeats of a chunk return to all documents that have it, and their bytes go.

A name of more chunks than a task should hold is dealt anew, each window for itself, by its
bytes.  Nothing but the number of such names reaches the driver, nothing is broadcast.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, textkernel

WINDOW = 200
GRAM = 48
#: Bytes to which all suffixes are sorted by multikey quicksort; deeper ones go to blind tries.
SHALLOW = 16
#: Starts of a run at most, so that a row stays small; a longer run is several.
RUN = 2048
#: Bytes of chunks of one name that a task sorts; a name of more is dealt window by window.
CROWD = 4 << 20
#: Bytes of chunks that are sorted at once, names kept whole.
AT_ONCE = 2 << 20
_SLICE = 20
_U = np.uint64


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place on."""
    starts = np.arange(len(data) - size + 1)
    return textkernel.byte_hash(data, starts, starts + size)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    table, span = values, 1
    while 2 * span <= width:
        table = np.minimum(table[:-span], table[span:])
        span *= 2
    n = len(values) - width + 1
    return np.minimum(table[:n], table[width - span : width - span + n])


def runs(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """Runs of windows of one name within each row of a byte buffer.

    Returns names, first starts, numbers of starts, and whether a run may hold equal windows
    (then the place of its least hash moves).
    """
    parts: list[tuple[np.ndarray, ...]] = []
    at, end = int(offsets[0]), int(offsets[-1])
    while end - at >= window:
        to = min(at + (1 << _SLICE), end)
        part = data[at:to]
        hashes = _grams(part, gram)
        # The leftmost place of the least hash: equal windows have it at the same place within.
        low = _U((1 << _SLICE) - 1)
        place = (_sliding_least((hashes & ~low) | np.arange(len(hashes), dtype=_U), window - gram + 1) & low).astype(np.int64)
        starts = np.arange(at, at + len(place))
        row = np.searchsorted(offsets, starts, side="right") - 1
        whole = starts + window <= offsets[row + 1]
        names, place, starts, row = hashes[place[whole]], place[whole], starts[whole], row[whole]
        if len(names):
            new = np.ones(len(names), dtype=bool)
            new[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1])
            first = np.flatnonzero(new)
            # Long runs are cut.
            inner = np.arange(len(names)) - np.repeat(first, np.diff(np.append(first, len(names))))
            first = np.flatnonzero(inner % RUN == 0)
            last = np.append(first[1:], len(names)) - 1
            run_of = np.cumsum(new) - 1
            edge = np.append(np.flatnonzero(new)[1:], len(names)) - 1
            moves = place[np.flatnonzero(new)] != place[edge]
            parts.append((names[first], starts[first], last - first + 1, moves[run_of[first]]))
        at = to - window + 1
    if not parts:
        return np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


_RUNS = pa.schema([("name", pa.int64()), ("doc", pa.int64()), ("tag", pa.int32()), ("at", pa.int32()), ("size", pa.int32()), ("moves", pa.bool_())])


def _run_rows(window: int, gram: int):
    def run(batches):
        for batch in batches:
            data, offsets = textkernel.buffers(batch.column("text"))
            names, starts, sizes, moves = runs(data, offsets, window, gram)
            row = np.searchsorted(offsets, starts, side="right") - 1
            docs, tags = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("doc", "tag"))
            yield common.batch_of(_RUNS, (names.view(np.int64), docs, tags, starts - offsets[row], sizes, moves))

    return run


_CHUNKS = pa.schema([("name", pa.int64()), ("doc", pa.int64()), ("tag", pa.int32()), ("at", pa.int32()), ("size", pa.int32()), ("moves", pa.bool_()), ("chunk", pa.binary())])
#: Bytes of chunks in a batch that leaves Python.
_OUT = 8 << 20


def _chunk_rows(window: int):
    def run(batches):
        for batch in batches:
            data, offsets = textkernel.buffers(batch.column("text"))
            lists = batch.column("runs")
            bounds, fields = lists.offsets.to_numpy(), lists.values
            row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            name, at, size, moves = (fields.field(c).to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]] for c in ("name", "at", "size", "moves"))
            docs, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "tag"))
            start, length = offsets[row] + at, size.astype(np.int64) + window - 1
            view, filled = memoryview(data), np.cumsum(length)
            k = 0
            while k < len(row):
                to = max(k + 1, int(np.searchsorted(filled, (filled[k - 1] if k else 0) + _OUT)))
                own = slice(k, to)
                chunks = [bytes(view[a : a + n]) for a, n in zip(start[own].tolist(), length[own].tolist(), strict=True)]
                yield common.batch_of(_CHUNKS, (name[own], docs[row[own]], tags[row[own]], at[own], size[own], moves[own], chunks))
                k = to

    return run


def sort_suffixes(data: np.ndarray, starts: np.ndarray, groups: np.ndarray, window: int = WINDOW, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes within ascending ``groups`` by their first ``window`` bytes, and which equal the one before.

    ``data`` goes on for at least eight bytes after each suffix's window.
    """
    words = np.ndarray(shape=(max(len(data) - 7, 0),), strides=(1,), dtype=">u8", buffer=data)
    order = np.arange(len(starts))
    first = np.ones(len(starts) + 1, dtype=bool)
    first[1:-1] = groups[1:] != groups[:-1]
    shallow = min(shallow, window) // 8 * 8
    for depth in range(0, shallow, 8):  # multikey quicksort: one key of eight bytes, then only equal ones go on
        at = np.flatnonzero(~(first[:-1] & first[1:]))
        if not len(at):
            break
        group, key = np.cumsum(first[:-1])[at], words[starts[order[at]] + depth].astype(np.uint64)
        by = np.lexsort((key, group))
        order[at], key = order[at[by]], key[by]
        first[at[1:]] |= key[1:] != key[:-1]
    _blind_tries(words, data, starts, order, first, window, shallow)
    same = ~first[:-1]
    return order, same


def _blind_tries(words: np.ndarray, data: np.ndarray, starts: np.ndarray, order: np.ndarray, first: np.ndarray, window: int, shallow: int) -> None:
    """Order the groups that share ``shallow`` bytes, all at once, a path of each trie at a time.

    A group's first suffix is a path from the root of its trie.  Every other one leaves it where it
    first differs, and only that depth and that byte are kept: those that leave by the same edge are
    the next group, which begins below it.
    """
    depth = np.full(len(order), shallow, dtype=np.int64)
    open_ = np.ones(len(order), dtype=bool)
    while True:
        at = np.flatnonzero(~(first[:-1] & first[1:]) & open_)
        if not len(at):
            return
        heads = np.flatnonzero(first[:-1])
        group = np.cumsum(first[:-1])[at] - 1
        path, own, lcp = starts[order[heads[group]]], starts[order[at]], depth[at].copy()
        left = np.flatnonzero(lcp < window)
        while len(left):
            differ = words[path[left] + lcp[left]].astype(np.uint64) ^ words[own[left] + lcp[left]].astype(np.uint64)
            equal = differ == 0
            stop = left[~equal]
            lcp[stop] += (63 - _high_bit(differ[~equal])) // 8
            left = left[equal]
            lcp[left] += 8
            left = left[lcp[left] < window]
        lcp = np.minimum(lcp, window)
        ends = lcp == window
        edge, of_path = data[np.where(ends, 0, own + lcp)].astype(np.int64), data[np.where(ends, 0, path + lcp)].astype(np.int64)
        before = edge < of_path
        # Smaller ones first, the deeper the later; then the path itself; then larger ones, deepest first.
        key = np.where(ends, 1 << 40, np.where(before, (lcp << 8) + edge, (2 << 40) + ((window - lcp) << 8) + edge))
        by = np.lexsort((key, group))
        order[at], key, lcp = order[at[by]], key[by], lcp[by]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        first[at] |= new
        depth[at], open_[at] = lcp + 1, lcp < window


def _high_bit(x: np.ndarray) -> np.ndarray:
    """Place of the highest bit of numbers that are not zero."""
    high = np.zeros(len(x), dtype=np.int64)
    for step in (32, 16, 8):
        big = x >> _U(step) != 0
        x = np.where(big, x >> _U(step), x)
        high += step * big
    return high + 7  # only the byte counts


_SPANS = pa.schema([("digest", pa.binary()), ("spans", pa.list_(pa.int32()))])


def _sorted_rows(window: int, shallow: int):
    """Sorts whole names of a partition that comes in order of names; rows: chunks that occur once and their repeated bytes."""

    def decide(rows: list[tuple]):
        names, digests, counts, chunks = zip(*rows, strict=True)
        data = np.frombuffer(b"".join(chunks) + bytes(window + 8), dtype=np.uint8)
        sizes = np.array([len(c) for c in chunks])
        begins, n_starts = np.cumsum(sizes) - sizes, sizes - window + 1
        chunk_of = np.repeat(np.arange(len(chunks)), n_starts)
        inner = np.arange(n_starts.sum()) - np.repeat(np.cumsum(n_starts) - n_starts, n_starts)
        number = np.cumsum([True, *(a != b for a, b in zip(names, names[1:], strict=False))])
        order, same = sort_suffixes(data, begins[chunk_of] + inner, number[chunk_of], window, shallow)
        twice = same.copy()
        twice[:-1] |= same[1:]
        repeated = np.zeros(len(order), dtype=bool)
        repeated[order] = twice
        limits = np.append(np.cumsum(n_starts) - n_starts, len(order))
        found = [(d, _cover(np.flatnonzero(repeated[a:b]), window)) for d, n, a, b in zip(digests, counts, limits[:-1].tolist(), limits[1:].tolist(), strict=True) if n == 1]
        found = [x for x in found if len(x[1])]
        if found:
            yield common.batch_of(_SPANS, zip(*found, strict=True))

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("name", "digest", "n", "chunk")), strict=True):
                if size >= AT_ONCE and row[0] != held[-1][0]:
                    yield from decide(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield from decide(held)

    return run


def _cover(starts: np.ndarray, window: int) -> np.ndarray:
    """Begins and ends, in turn, of the bytes that windows at ascending starts cover."""
    if not len(starts):
        return starts
    new = np.append(True, starts[1:] > starts[:-1] + window)
    begins = starts[new]
    ends = starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)] + window
    return np.stack((begins, ends), axis=1).ravel()


_WINDOWS = pa.schema([("digest", pa.binary()), ("at", pa.int32()), ("n", pa.int64()), ("part", pa.binary())])


def _single_windows(window: int):
    def run(batches):
        for batch in batches:
            for digest, n, chunk in zip(*(batch.column(c).to_pylist() for c in ("digest", "n", "chunk")), strict=True):
                k = len(chunk) - window + 1
                yield common.batch_of(_WINDOWS, ([digest] * k, range(k), [n] * k, [chunk[i : i + window] for i in range(k)]))

    return run


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _keep(with_bytes: bool):
    def run(batches):
        for batch in batches:
            data, offsets = textkernel.buffers(batch.column("text"))
            lists = batch.column("spans")
            bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            rows = []
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                whole = data[offsets[k] : offsets[k + 1]]
                pairs = values[bounds[k] : bounds[k + 1]].reshape(-1, 2)
                change = np.zeros(len(whole) + 1, dtype=np.int64)
                np.add.at(change, pairs[:, 0], 1)
                np.add.at(change, pairs[:, 1], -1)
                gone = np.cumsum(change[:-1]) > 0
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
                kept = whole[~gone].tobytes()
                rows.append((doc, len(whole), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if with_bytes else None))
            if rows:
                yield common.batch_of(_KEPT, zip(*rows, strict=True))

    return run


def _decided(distinct: DataFrame, window: int, shallow: int, crowd: int) -> DataFrame:
    """(digest, spans): repeated bytes of every chunk that has some; distinct: (name, digest, chunk, n, moves)."""
    per_name = distinct.groupBy("name").agg(F.count("*").alias("kinds"), F.count(F.when(F.col("n") == 1, 1)).alias("once"), F.max(F.expr("n = 1 and moves")).alias("moves"), F.sum(F.length("chunk")).alias("bytes"))
    # A name of one chunk needs no sorting, unless the chunk can repeat within itself.
    open_ = common.materialise(per_name.where("once > 0 and (kinds > 1 or moves)").select("name", (F.col("bytes") > crowd).alias("crowded")), "open")
    with common.shuffles_dropped(distinct.sparkSession):
        any_crowded = bool(open_.where("crowded").limit(1).count())
    chunks = distinct.select("name", "digest", "n", "chunk")
    dealt = chunks.join(open_.where("not crowded").select("name"), "name").repartition("name").sortWithinPartitions("name")
    found = dealt.mapInArrow(_sorted_rows(window, shallow), "digest binary, spans array<int>")
    whole = distinct.where("n > 1").select("digest", F.array(F.lit(0), F.length("chunk").cast("int")).alias("spans"))
    found = found.unionByName(whole)
    if any_crowded:
        parts = chunks.join(open_.where("crowded").select("name"), "name").mapInArrow(_single_windows(window), "digest binary, at int, n long, part binary")
        parts = common.materialise(parts.withColumn("key", F.md5("part")), "windows", "zstd")
        again = parts.groupBy("key", "part").agg(F.sum("n").alias("total")).where("total > 1").select("key")
        found = found.unionByName(parts.join(again, "key").select("digest", F.array("at", F.col("at") + window).alias("spans")))
    return found


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shallow: int = SHALLOW, crowd: int = CROWD, with_bytes: bool = True) -> DataFrame:
    """Remove every byte that a repeated string of ``window`` bytes covers, in all places alike.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes (null unless
    ``with_bytes``; they need not be whole characters) of every row.  A null text is empty.  Rows
    with a null doc_id and rows that share one are texts like any other.  Texts shorter than a
    window stay whole; long ones are read in slices and take no more memory than their own length.
    An empty table gives no rows.  Other columns are not read.
    """
    if not 0 < gram <= window:
        raise ValueError("a gram is a part of a window")
    spark: SparkSession = docs.sparkSession
    common.small_batches(spark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Rows of one doc_id are told apart by their text; equal rows have equal repeats.
    source = source.withColumns({"doc": F.coalesce("doc_id", F.lit(0).cast("long")), "tag": F.hash(F.md5("text"), F.col("doc_id").isNull())})
    with common.passing():
        long_enough = source.where(F.octet_length("text") >= window).select("doc", "tag", "text")
        named = common.materialise(long_enough.mapInArrow(_run_rows(window, gram), "name long, doc long, tag int, at int, size int, moves boolean"), "runs", "zstd")
        shared = named.groupBy("name").agg(F.count("*").alias("n"), F.max("moves").alias("m")).where("n > 1 or m").select("name")
        wanted = named.join(shared, "name").groupBy("doc", "tag").agg(F.collect_set(F.struct("name", "at", "size", "moves")).alias("runs"))
        wanted = common.materialise(wanted, "wanted", "zstd")
        cut = long_enough.join(wanted, ["doc", "tag"]).mapInArrow(_chunk_rows(window), "name long, doc long, tag int, at int, size int, moves boolean, chunk binary")
        chunks = common.materialise(cut.withColumn("digest", F.unhex(F.md5("chunk"))), "chunks", "zstd")
        folded = chunks.groupBy("name", "digest", "chunk").agg(F.count("*").alias("n"), F.max("moves").alias("moves"))
        distinct = common.materialise(folded, "distinct", "zstd")
        spans = common.materialise(_decided(distinct, window, shallow, crowd), "spans", "zstd")
        placed = chunks.select("doc", "tag", "at", "digest").join(spans, "digest")
        moved = placed.select("doc", "tag", F.expr("transform(spans, x -> x + at)").alias("spans"))
        covered = moved.groupBy("doc", "tag").agg(F.flatten(F.collect_set("spans")).alias("spans"))
        covered = common.materialise(covered, "covered", "zstd", stays=True)
    rows = source.join(covered, ["doc", "tag"], "left").select("doc_id", "text", F.coalesce("spans", F.array().cast("array<int>")).alias("spans"))
    return rows.mapInArrow(_keep(with_bytes), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return remove_repeats(common.read_table(spark, sf_dir, "documents"), with_bytes=False).drop("kept")
