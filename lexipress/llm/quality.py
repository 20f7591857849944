"""Quality by nearest-neighbour voting over latent-semantic vectors.

A document's features are counts of hashed words and of hashed three-character
shapes (letters, capitals, digits and white space as classes, other ASCII as itself),
damped, weighted by inverse document frequency and brought to unit length.  The latent
space is the leading singular vectors of a bounded sample of labelled documents.  The
sample's vectors, labels and projection are broadcast; each document's cosine with
every one of them is computed exactly, block by block, and its nearest neighbours vote
with their labels, weighted by similarity and by how much of the labelled rows a
sampled row stands for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import common, textkernel

#: Labelled documents taken for each label: a bound on what is broadcast and collected.
SAMPLE_PER_LABEL = 1000
NEIGHBOURS = 15
DIMENSIONS = 48
THRESHOLD = 0.3
WORD_BITS = 11
SHAPE_BITS = 11
FEATURES = (1 << WORD_BITS) + (1 << SHAPE_BITS)
#: Documents whose features or cosines are held at once.
_ROWS = 64
#: Residual at which an eigenvector has settled, as a share of the largest eigenvalue.
SETTLED = 1e-12
#: Vectors that a Krylov space grows by at once.
BLOCK = 16


def _classes() -> np.ndarray:
    of = np.arange(256, dtype=np.uint64)
    of[0x30:0x3A] = 0x30
    of[0x41:0x5B] = 0x41
    of[0x61:0x7B] = 0x61
    of[0x80:] = 0x61  # letters beyond ASCII, byte by byte
    of[[0x09, 0x0B, 0x0C, 0x0D]] = 0x20
    return of


_CLASSES = _classes()


def features(column: pa.Array) -> np.ndarray:
    """Counts of each row's features, (rows, FEATURES) float32."""
    rows = len(column)
    data, offsets = textkernel.buffers(column)
    (h,), ends = textkernel.words(column, textkernel.ALNUM)
    out = np.zeros((rows, FEATURES), dtype=np.float32)
    flat = out.reshape(-1)
    of_word = np.repeat(np.arange(rows), np.diff(np.concatenate(([0], ends))))
    np.add(flat, np.bincount(of_word * FEATURES + (h >> np.uint64(64 - WORD_BITS)).astype(np.int64), minlength=len(flat)), out=flat)
    for row in range(rows):
        a, b = int(offsets[row]), int(offsets[row + 1])
        for k in range(a, b, textkernel.SLICE):
            c = _CLASSES[data[k : min(k + textkernel.SLICE + 2, b)]]
            if len(c) > 2:
                code = (c[:-2] * np.uint64(65536) + c[1:-1] * np.uint64(256) + c[2:]) * np.uint64(0x9E3779B97F4A7C15)
                at = (code >> np.uint64(64 - SHAPE_BITS)).astype(np.int64)
                out[row, 1 << WORD_BITS :] += np.bincount(at, minlength=1 << SHAPE_BITS)
    return out


def _weigh(counts: np.ndarray, idf: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """Damped and weighted counts (in ``out``, if given); words and shapes each of unit length, so that neither drowns the other."""
    x = np.log1p(counts, out=out)
    x *= idf
    for a, b in ((0, 1 << WORD_BITS), (1 << WORD_BITS, FEATURES)):
        norm = np.sqrt(np.einsum("ij,ij->i", x[:, a:b], x[:, a:b]))[:, None]
        x[:, a:b] /= np.maximum(norm, 1e-12)
    return x


def _leading(gram: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, ascending, and eigenvectors of a symmetric float32 matrix, in double precision.

    A block Krylov space grows until they have settled; if it grew beyond half of the whole
    space, the dense solver is called instead, which needs several copies of the matrix.
    """
    n = len(gram)
    q = np.linalg.qr(np.random.default_rng(0).standard_normal((n, min(n, BLOCK))))[0]
    basis, images = np.zeros((n, 0)), np.zeros((n, 0))
    while basis.shape[1] + BLOCK <= n // 2:
        image = np.concatenate([gram[i : i + _ROWS].astype(np.float64) @ q for i in range(0, n, _ROWS)])
        basis, images = np.hstack((basis, q)), np.hstack((images, image))
        if basis.shape[1] > k and basis.shape[1] % (4 * BLOCK) == 0:
            small = basis.T @ images
            values, y = np.linalg.eigh((small + small.T) / 2)
            values, y = values[-k:], y[:, -k:]
            vectors = basis @ y
            if np.linalg.norm(images @ y - vectors * values, axis=0).max() <= SETTLED * values[-1]:
                return values, vectors
        q = image
        for _ in range(2):
            q = np.linalg.qr(q - basis @ (basis.T @ q))[0]
    del basis, images
    values, vectors = np.linalg.eigh(gram.astype(np.float64))
    return values[-k:], vectors[:, -k:]


class Model:
    """Everything that scoring needs; its size is bounded by SAMPLE_PER_LABEL and DIMENSIONS."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, stands_for: np.ndarray, neighbours: int, dimensions: int):
        self.labels, self.stands_for, self.neighbours = labels.astype(np.float64), stands_for, min(neighbours, len(labels))
        if not len(labels):
            return
        # The sample is dense: it is weighed in its place, so ``counts`` is not the caller's any more.
        self.idf = (np.log((1 + len(counts)) / (1 + np.count_nonzero(counts, axis=0))) + 1).astype(np.float32)
        x = _weigh(counts, self.idf, out=counts)
        self.centre = x.mean(axis=0)
        x -= self.centre
        # Right singular vectors by way of the smaller of the two Gram matrices.
        if len(x) < FEATURES:
            values, left = _leading(x @ x.T, min(dimensions, len(x)))
            top = np.argsort(-values)
            top = top[values[top] > 1e-9]
            self.project = x.T @ (left[:, top] / np.sqrt(values[top])).astype(np.float32)
        else:
            values, right = _leading(x.T @ x, dimensions)
            self.project = right[:, np.argsort(-values)].astype(np.float32)
        self.vectors = self._unit(x @ self.project)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.sqrt((x**2).sum(axis=1, keepdims=True)), 1e-12)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        x = self._unit((_weigh(counts, self.idf) - self.centre) @ self.project)
        cosine = x @ self.vectors.T
        # All that are as near as the last neighbour vote, so ties are not broken at will.
        last = np.partition(cosine, len(self.labels) - self.neighbours, axis=1)[:, len(self.labels) - self.neighbours]
        near = np.where(cosine >= last[:, None], np.maximum(cosine.astype(np.float64), 1e-6) ** 4, 0.0) * self.stands_for
        return np.clip(near @ self.labels / near.sum(axis=1), 0.0, 1.0)


def held_out(doc_id: str = "doc_id"):
    """Column: a fifth of all ids, by crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


_COUNTS = pa.schema([("label", pa.int32()), ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.float32()))])
_SCORES = pa.schema([("score", pa.float64())])


def _sample_rows(batches):
    common.leave_memory()
    for whole in batches:
        for k in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(k, _ROWS)
            counts = features(batch.column("text"))
            at = [np.flatnonzero(row).astype(np.int32) for row in counts]
            yield common.batch_of(_COUNTS, (batch.column("label"), at, [row[i] for row, i in zip(counts, at, strict=True)]))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL, neighbours: int = NEIGHBOURS, dimensions: int = DIMENSIONS) -> Model:
    """Model of (doc_id, quality) labels, from rows that are not held out.

    At most ``per_label`` labelled documents of each label (0 and 1), those whose ids
    have the smallest hashes.  Several labels of one document count as the smallest;
    null labels and ids are no labels.  Of rows that share a doc_id one is taken, that of
    the least text digest, so rows are bounded as ids are.  Without labels or documents
    the model is empty and scores one half.
    """
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    known = known.where(~held_out()).groupBy("doc_id").agg(F.min("label").alias("label"))
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    picked = [r for label in sorted(totals) for r in known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label).collect()]
    chosen = spark.createDataFrame([(r["doc_id"], r["label"]) for r in picked], "doc_id long, label int")
    # ``chosen`` has at most 2 * per_label rows.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("digest"), "text")).alias("one"))
    table = texts.select("label", "one.text").mapInArrow(_sample_rows, "label int, at array<int>, n array<float>").toArrow()
    rows = [(at.values.to_numpy(zero_copy_only=False), n.values.to_numpy(zero_copy_only=False)) for at, n in zip(table.column("at"), table.column("n"), strict=True)]
    label = table.column("label").to_numpy()
    draw = np.random.default_rng(0).random(FEATURES)
    order = np.lexsort((np.array([draw[at] @ n for at, n in rows], dtype=np.float64), label))  # the same model however rows arrive
    counts, label = np.zeros((len(rows), FEATURES), dtype=np.float32), label[order]
    for to, row in enumerate(order.tolist()):
        counts[to, rows[row][0]] = rows[row][1]
    del rows, table
    share = np.array([totals[x] / max(1, (label == x).sum()) for x in label.tolist()], dtype=np.float64)
    return Model(counts, label, share, neighbours, dimensions)


def _score(model, name):
    def run(batches):
        common.leave_memory()
        m = model.value
        for batch in batches:
            texts = batch.column("text").cast(pa.string())
            scores = [m.scores(features(texts.slice(k, _ROWS))) for k in range(0, batch.num_rows, _ROWS)]
            if scores:
                rest = [batch.column(i) for i in range(batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(np.concatenate(scores))], names=[*batch.schema.names, name])

    return run


def score(docs: DataFrame, model: Model, name: str = "quality_score") -> DataFrame:
    """``docs`` with a column of scores (0 to 1) of every whole text; a null text scores as an empty one.

    All columns are kept, whatever their names (``name`` must be new); repeated rows are
    scored each, and an empty table gives no rows.  All labelled rows as near as the last
    of the neighbours vote; features of a long text are counted in slices.
    """
    common.small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    fields = [StructField(f.name, f.dataType, True) for f in docs.schema.fields]
    return docs.mapInArrow(_score(held, name), StructType([*fields, StructField(name, DoubleType(), True)]))


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` whose score reaches the threshold; all columns are kept.

    Null texts are judged as empty ones, repeated rows each; an empty table gives no rows.
    """
    (name,) = common.free_names(docs, 1)
    return score(docs, model, name).where(F.col(name) >= threshold).drop(name)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: doc_id, held_out, score, predicted."""
    docs = common.read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score(docs, fit(docs, common.read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))
