"""Token-id output: frequency-ranked ids in byte-aligned variable-length coding.

Ids are replaced by their rank in the corpus (0: the most frequent), so that most
of them fit one byte.  A block stores, apart from each other, the control bytes
(two bits a value: its bytes less one, four values a byte) and the data bytes.
Decoding looks lengths and masks up in numpy tables by control byte.

A shard file is ``MAGIC`` and blocks; a block is a header of seven little-endian
int64 (documents, values, control bytes, data bytes, crc32 of the rest, 0, 0), the
doc_ids (int64), flags (uint8, 1: the doc_id is null), values a document (int64),
control bytes and data bytes.  ``codebook.bin`` holds the ids in rank order.

The texts are read once: each partition is tokenised into compressed id blobs and the
counts of all its ids (written to the shared folder, since tokenising is the dearest
step); then the blobs are ordered by doc_id with a range shuffle and shards are written.
Every attempt of a task writes a file of its own name, and the manifest, which the driver
gets from the attempts that counted, says which files are shards: a repeated task leaves a
file that nobody reads.  A shard has about ``SHARD_TOKENS`` ids, however large the corpus.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .tokens import encoder, vocabulary

MAGIC = b"LXTOKENS"
#: Values after which a block is closed; a document is never split.
BLOCK_VALUES = 1 << 18
#: Ids of a shard, about; there are as many shards as shuffle partitions at least.
SHARD_TOKENS = 1 << 26
_HEAD = struct.Struct("<7q")

_SHIFTS = np.arange(4, dtype=np.uint8) * 2
#: Lengths of the four values of each control byte.
LENGTHS = ((np.arange(256, dtype=np.int64)[:, None] >> _SHIFTS) & 3) + 1
#: Bits to keep of four bytes read at a value's start, by its length.
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def pack_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of uint32 values."""
    values = np.ascontiguousarray(values, dtype="<u4")
    codes = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    padded[: len(values)] = codes
    control = np.bitwise_or.reduce(padded.reshape(-1, 4) << _SHIFTS, axis=1).astype(np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= codes[:, None]]
    return control.tobytes(), data.tobytes()


def unpack_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n uint32 values of control and data bytes."""
    lengths = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:n]
    at = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data + b"\0\0\0", dtype=np.uint8)
    words = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        words |= raw[at + k].astype(np.uint32) << np.uint32(8 * k)
    return words & MASKS[lengths]


def _write_block(out, ids: list[int | None], arrays: list[np.ndarray], rank_of: np.ndarray) -> int:
    values = rank_of[np.concatenate(arrays)]
    control, data = pack_values(values)
    body = b"".join(
        (
            np.array([x if x is not None else 0 for x in ids], dtype="<i8").tobytes(),
            np.array([x is None for x in ids], dtype=np.uint8).tobytes(),
            np.array([len(a) for a in arrays], dtype="<i8").tobytes(),
            control,
            data,
        )
    )
    out.write(_HEAD.pack(len(ids), len(values), len(control), len(data), zlib.crc32(body), 0, 0) + body)
    return len(values)


def read_blocks(stream, ids_of: np.ndarray) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of each document of a shard, block by block; ids_of: the id of each rank."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token shard")
    while head := stream.read(_HEAD.size):
        docs, n, n_control, n_data, crc, _, _ = _HEAD.unpack(head)
        body = stream.read(docs * 17 + n_control + n_data)
        if zlib.crc32(body) != crc:
            raise ValueError("damaged token block")
        ids = np.frombuffer(body, "<i8", docs).tolist()
        null = np.frombuffer(body, np.uint8, docs, docs * 8).tolist()
        sizes = np.frombuffer(body, "<i8", docs, docs * 9)
        at = docs * 17
        values = ids_of[unpack_values(body[at : at + n_control], body[at + n_control :], n)]
        ends = np.cumsum(sizes)
        for doc, is_null, start, end in zip(ids, null, (ends - sizes).tolist(), ends.tolist(), strict=True):
            yield (None if is_null else doc), values[start:end]


#: A document's ids; or, with is_count, the counts of all ids of a partition, as int64 by id.
_BLOBS = pa.schema([("is_count", pa.bool_()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
_COUNTS = pa.schema([("id", pa.int64()), ("n", pa.int64())])
_MANIFEST = pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
_DECODED = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _tokenise(path: str, size: int):
    def run(batches):
        enc, z = encoder(path), zstandard.ZstdCompressor(level=1)
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            texts = common.text_values(batch.column("text"))
            for k in range(0, len(texts), 1000):
                blobs = enc.encode_bytes(texts[k : k + 1000])
                ids = batch.column("doc_id").slice(k, len(blobs))
                total += np.bincount(np.frombuffer(b"".join(blobs), dtype=enc.dtype), minlength=size)
                yield common.batch_of(_BLOBS, ([False] * len(blobs), ids, [len(b) // enc.dtype.itemsize for b in blobs], [z.compress(b) for b in blobs]))
        yield common.batch_of(_BLOBS, ([True], [None], [0], [z.compress(total.tobytes())]))

    return run


def _add_counts(batches):
    total, z = 0, zstandard.ZstdDecompressor()
    for batch in batches:
        for blob in batch.column("ids"):
            total = total + np.frombuffer(z.decompress(blob.as_py()), dtype=np.int64)
    at = np.flatnonzero(total)
    yield common.batch_of(_COUNTS, (at, total[at] if len(at) else at))


def _write(uri: str, dtype: str, ranks):
    def run(batches):
        fs, folder = common.open_fs(uri)
        rank_of, z = ranks.value, zstandard.ZstdDecompressor()
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:07d}-{uuid.uuid4().hex}.tok"
        n_docs = n_tokens = held = 0
        docs: list[int | None] = []
        arrays: list[np.ndarray] = []
        with fs.open_output_stream(f"{folder}/{name}", compression=None) as out:
            out.write(MAGIC)
            for batch in batches:
                for doc, blob in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                    values = np.frombuffer(z.decompress(blob.as_py()), dtype=dtype)
                    docs.append(doc)
                    arrays.append(values)
                    n_docs, held = n_docs + 1, held + len(values)
                    if held >= BLOCK_VALUES:
                        n_tokens += _write_block(out, docs, arrays, rank_of)
                        docs, arrays, held = [], [], 0
            if docs:
                n_tokens += _write_block(out, docs, arrays, rank_of)
        if n_docs:
            yield common.batch_of(_MANIFEST, ([shard], [f"{uri}/{name}"], [n_docs], [n_tokens]))

    return run


def _read(codebook: str):
    def run(batches):
        ids_of = None
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                if ids_of is None:
                    fs, at = common.open_fs(codebook)
                    with fs.open_input_file(at) as f:
                        ids_of = np.frombuffer(f.read(), dtype="<u4")
                fs, at = common.open_fs(path)
                rows: list[tuple] = []
                with fs.open_input_stream(at, compression=None) as stream:
                    for doc, ids in read_blocks(stream, ids_of):
                        rows.append((doc, start, len(ids), zlib.crc32(ids)))
                        start += len(ids)
                        if len(rows) >= 4096:
                            yield common.batch_of(_DECODED, zip(*rows, strict=True))
                            rows = []
                if rows:
                    yield common.batch_of(_DECODED, zip(*rows, strict=True))

    return run


def write_token_shards(docs: DataFrame, vocab: str | None = None, shards: int | None = None) -> DataFrame:
    """Tokenise ``text`` of all documents and write shards in ascending doc_id order.

    Returns the manifest (shard, path, n_docs, n_tokens, start, codebook), one row a
    shard.  Null texts are empty and give END_ID alone; null doc_ids come first;
    rows that share a doc_id are all written, fewer ids first, and equal rows each; other
    columns are not read.  A long text is tokenised in stretches and stands in one block.
    An empty table gives an empty manifest.
    """
    spark: SparkSession = docs.sparkSession
    common.small_batches(spark)
    path = vocab or vocabulary()
    dtype, size = _vocabulary_shape(path)
    spec = "is_count boolean, doc_id long, n_tokens long, ids binary"
    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    uri = common.scratch(spark, "token-blobs")
    made.mapInArrow(_tokenise(path, size), spec).write.option("compression", "none").parquet(uri)
    written = spark.read.schema(spec).parquet(uri)
    blobs = written.where("not is_count").select("doc_id", "n_tokens", "ids")

    counted = written.where("is_count").select("ids").mapInArrow(_add_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # One row for each id of the vocabulary at most: bounded by the vocabulary, not by the corpus.
    rows = counted.orderBy(F.desc("n"), "id").collect()
    order = np.array([r["id"] for r in rows], dtype="<u4")
    rank_of = np.zeros(size, dtype="<u4")
    rank_of[order] = np.arange(len(order), dtype="<u4")

    shards = shards or max(common.shuffle_partitions(spark), -(-sum(r["n"] for r in rows) // SHARD_TOKENS))
    out = common.scratch(spark, "token-shards")
    fs, folder = common.open_fs(out)
    fs.create_dir(folder, recursive=True)
    codebook = f"{out}/codebook.bin"
    with fs.open_output_stream(f"{folder}/codebook.bin") as f:
        f.write(order.tobytes())
    ranks = spark.sparkContext.broadcast(rank_of)
    ordered = blobs.repartitionByRange(shards, "doc_id", "n_tokens", F.xxhash64("ids")).sortWithinPartitions("doc_id", "n_tokens", "ids")
    manifest = ordered.mapInArrow(_write(out, dtype, ranks), "shard long, path string, n_docs long, n_tokens long").collect()
    common.drop_scratch(uri)
    start, listed = 0, []
    for r in sorted(manifest, key=lambda r: r["shard"]):
        listed.append((r["shard"], r["path"], r["n_docs"], r["n_tokens"], start, codebook))
        start += r["n_tokens"]
    return spark.createDataFrame(listed, "shard long, path string, n_docs long, n_tokens long, start long, codebook string")


def read_token_shards(manifest: DataFrame) -> DataFrame:
    """Decode shards: doc_id, start, n_tokens, ids_crc32 of every document; an empty manifest gives no rows.

    Repeated rows are decoded each; a null doc_id is read back as null.
    """
    spec = "doc_id long, start long, n_tokens long, ids_crc32 long"
    first = manifest.select("codebook").head()
    if first is None:
        return manifest.sparkSession.createDataFrame([], spec)
    n = manifest.count()
    return manifest.select("path", "start").repartition(n).mapInArrow(_read(first[0]), spec)


def _vocabulary_shape(path: str) -> tuple[str, int]:
    enc = encoder(path)
    return enc.dtype.str, enc.tokenizer.get_vocab_size()


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` through shards and back: doc_id, start, n_tokens, ids_crc32."""
    return read_token_shards(write_token_shards(common.read_table(spark, sf_dir, "documents")))
