"""Quality classifier on random-indexing word vectors.

Words are hashed into ``BUCKETS`` buckets. Each bucket has a sparse random index vector (a few
+1 and -1, drawn by rule); a word's context vector is the sum of the index vectors of the
words within ``REACH`` places of it, over all documents. Partial sums per task are whole
numbers, so their total does not depend on the order of tasks. A document is the weighted
mean of its words' context and index vectors, with weights that fall with a bucket's share
of all words, the mean product of the two, the lengths of the two means and the logarithm of the number of words. A network of two layers in numpy is fitted on a sample of labelled rows; one
number, the temperature, is then fitted on a part of the sample that the network did not see,
and divides the logits, so that scores are probabilities.

The corpus statistics cover all rows. The only bound is ``SAMPLE_ROWS``, the labelled rows
that fit the network, drawn by hash; their pooled vectors and the table of bucket vectors
(of fixed size) are all that reaches the driver, and the table is what is broadcast.

Defined results: null and empty texts have a zero vector and a score; long texts are read
whole; rows that repeat score alike; labels that are null are not used; a document whose
labels differ is used with each of them; without labels of both kinds every score is the
share of label 1 (one half without any); an empty table gives an empty table; other columns
pass through in a struct.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm.common import Hashes, mixed, release, text_runs

TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
BUCKETS = 1 << 15
WIDTH = 64
SPIKES = 4
REACH = 2
SMOOTH = 1e-3
SAMPLE_ROWS = 20_000
CALIBRATION_SHARE = 0.2
HIDDEN = 32
STEPS = 2500
BATCH = 256
DECAY = 1e-3
SEED = 17
SLICE_BYTES = 1 << 19
COLUMNS = [f"c{i}" for i in range(WIDTH)]
POOLED = 2 * WIDTH + 4

_names = mixed(np.arange(BUCKETS * SPIKES, dtype=np.uint64) + np.uint64(1)).reshape(BUCKETS, SPIKES)
PLACE = (_names % np.uint64(WIDTH)).astype(np.int64)
SIGN = np.where((_names >> np.uint64(40)) & np.uint64(1), 1, -1).astype(np.int64)


def buckets(text: str, hashes: Hashes) -> np.ndarray:
    """Bucket of each token of a text."""
    tokens = TOKEN.findall(text)
    return (hashes.of(tokens, len(tokens)) % np.uint64(BUCKETS)).astype(np.int64)


def add_contexts(total: np.ndarray, seen: np.ndarray, lists: list[np.ndarray]) -> None:
    """Add the contexts of some documents to the sums per bucket."""
    gap = np.full(REACH, -1, np.int64)  # keeps documents apart
    flat = np.concatenate([part for each in lists for part in (each, gap)])
    seen += np.bincount(flat[flat >= 0], minlength=BUCKETS)
    cells = total.reshape(-1)
    for lag in range(1, REACH + 1):
        one, two = flat[:-lag], flat[lag:]
        both = (one >= 0) & (two >= 0)
        one, two = one[both], two[both]
        for word, other in ((one, two), (two, one)):
            for k in range(SPIKES):
                np.add.at(cells, word * WIDTH + PLACE[other, k], SIGN[other, k])


def context_sums(docs: DataFrame, text_col: str) -> DataFrame:
    """``bucket``, ``n`` and the components of its context vector over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        total = np.zeros((BUCKETS, WIDTH), np.int64)
        seen = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, texts in text_runs(batch.column(0), SLICE_BYTES):
                add_contexts(total, seen, [buckets(t, hashes) for t in texts])
        batch = texts = None  # the texts are gone before the sums go out
        hashes.clear()
        release()
        used = np.flatnonzero(seen)
        for low in range(0, len(used), 4096):
            part = used[low : low + 4096]
            arrays = [pa.array(part), pa.array(seen[part])]
            arrays += [pa.array(np.ascontiguousarray(total[part, i])) for i in range(WIDTH)]
            yield pa.RecordBatch.from_arrays(arrays, ["bucket", "n", *COLUMNS])
        del total, seen
        release()

    shape = ", ".join(f"{name} BIGINT" for name in ("bucket", "n", *COLUMNS))
    sums = docs.select(text_col).mapInArrow(run, shape)
    return sums.groupBy("bucket").agg(*[F.sum(name).alias(name) for name in ("n", *COLUMNS)])


def vector_table(sums: pa.Table) -> np.ndarray:
    """Weighted context and index vector of every bucket and their inner product (large for
    words that are their own neighbours); the last column is the weight."""
    table = np.zeros((BUCKETS, 2 * WIDTH + 2), np.float32)
    if not sums.num_rows:
        return table
    rows = sums.column("bucket").to_numpy()
    counts = sums.column("n").to_numpy().astype(np.float64)
    context = np.stack([sums.column(name).to_numpy() for name in COLUMNS], axis=1).astype(np.float64)
    # The common direction of all contexts says little about any word.
    context -= counts[:, None] * (context.sum(axis=0) / counts.sum())[None, :]
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)
    own = np.zeros((len(rows), WIDTH))
    for k in range(SPIKES):
        np.add.at(own, (np.arange(len(rows)), PLACE[rows, k]), SIGN[rows, k] / SPIKES**0.5)
    weight = SMOOTH / (SMOOTH + counts / counts.sum())
    table[rows, :WIDTH] = weight[:, None] * context
    table[rows, WIDTH : 2 * WIDTH] = weight[:, None] * own
    table[rows, -2] = weight * (context * own).sum(axis=1)
    table[rows, -1] = weight
    return table


def pooled(text: str, table: np.ndarray, hashes: Hashes) -> np.ndarray:
    """A document's vector: the means, the lengths of the vectors (near 1 where few words come again and
    again) and the logarithm of the number of words."""
    total = np.zeros(table.shape[1], np.float64)
    found = buckets(text, hashes)
    for low in range(0, len(found), 2048):
        total += table[found[low : low + 2048]].sum(axis=0)
    mean = total[:-1] / total[-1] if total[-1] else total[:-1]
    lengths = np.linalg.norm(mean[:-1].reshape(2, WIDTH), axis=1)
    return np.concatenate([mean, lengths, [np.log1p(len(found))]]).astype(np.float32)


class Network:
    """Two layers and a temperature."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, seed: int = SEED) -> None:
        labels = labels.astype(np.float64)
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.weights: list[np.ndarray] = []
        self.temperature = 1.0
        random = np.random.default_rng(seed)
        order = random.permutation(len(labels))
        held = int(len(labels) * CALIBRATION_SHARE)
        check, fit = order[:held], order[held:]
        if len(set(labels[fit].tolist())) < 2:
            return
        self.middle = vectors[fit].mean(axis=0)
        self.scale = vectors[fit].std(axis=0) + 1e-6
        self._fit((vectors[fit] - self.middle) / self.scale, labels[fit], random)
        if len(set(labels[check].tolist())) == 2:
            logits = self.logits(vectors[check])
            temperatures = np.geomspace(0.2, 20, 400)
            losses = [_loss(logits / t, labels[check]) for t in temperatures]
            self.temperature = float(temperatures[int(np.argmin(losses))])

    def _fit(self, rows: np.ndarray, labels: np.ndarray, random: np.random.Generator) -> None:
        wide = rows.shape[1]
        w = [
            random.normal(0, wide**-0.5, (wide, HIDDEN)), np.zeros(HIDDEN),
            random.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1),
        ]
        one, two = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
        order, low = random.permutation(len(labels)), 0
        for step in range(1, STEPS + 1):
            rate = 0.005 * 0.5 * (1 + np.cos(np.pi * step / STEPS))
            part = order[low : low + BATCH]
            low += BATCH
            if low >= len(order):
                order, low = random.permutation(len(labels)), 0
            x, y = rows[part], labels[part]
            hidden = np.tanh(x @ w[0] + w[1])
            error = (_sigmoid(hidden @ w[2] + w[3]) - y) / len(y)
            back = np.outer(error, w[2]) * (1 - hidden**2)
            slopes = [
                x.T @ back + DECAY * w[0], back.sum(axis=0),
                hidden.T @ error + DECAY * w[2], error.sum(keepdims=True),
            ]
            for i, slope in enumerate(slopes):
                one[i] = 0.9 * one[i] + 0.1 * slope
                two[i] = 0.999 * two[i] + 0.001 * slope**2
                fair = one[i] / (1 - 0.9**step)
                w[i] = w[i] - rate * fair / (np.sqrt(two[i] / (1 - 0.999**step)) + 1e-8)
        self.weights = w

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        """Network output before the temperature."""
        w = self.weights
        hidden = np.tanh(((vectors - self.middle) / self.scale) @ w[0] + w[1])
        return hidden @ w[2] + w[3]

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        if not self.weights:
            return np.full(len(vectors), self.prior)
        return _sigmoid(self.logits(vectors) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    p = np.clip(_sigmoid(logits), 1e-12, 1 - 1e-12)
    return float(-(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean())


def scored_slices(
    docs: pa.Array, texts: pa.Array, table: np.ndarray, network: Network, hashes: Hashes
) -> Iterator[pa.RecordBatch]:
    """``_doc`` and ``_score`` of a batch, some texts at a time: the JVM holds each batch that
    comes back beside the one it sends."""
    vectors, cuts = np.empty((len(docs), POOLED), np.float32), []
    for low, high, run in text_runs(texts, SLICE_BYTES):
        for i, text in enumerate(run, low):
            vectors[i] = pooled(text, table, hashes)
        cuts.append((low, high))
    values = network.scores(vectors)
    del vectors
    for low, high in cuts:
        yield pa.RecordBatch.from_arrays(
            [docs.slice(low, high - low), pa.array(values[low:high], pa.float64())], ["_doc", "_score"]
        )


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_documents(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """All columns as ``_doc`` and ``_score``, the probability of label 1."""
    sums = context_sums(docs, text_col).toArrow()
    table = spark.sparkContext.broadcast(vector_table(sums))

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            rows = [
                pooled(text, table.value, hashes).tobytes()
                for _, _, texts in text_runs(batch.column("_text"), SLICE_BYTES)
                for text in texts
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_label"), pa.array(rows, pa.binary())], ["_label", "_vector"]
            )
        batch = rows = None
        hashes.clear()
        release()

    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    known = known.where(F.col("_label").isNotNull() & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
    present = known.join(docs.select(F.col(id_col).alias("_id")).distinct(), "_id", "left_semi")
    drawn = present.orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample_rows)
    # The sample's size is the parameter, so it may be broadcast.
    fitted = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(drawn), "_id"
    )
    sample = fitted.select("_label", "_text").mapInArrow(pool, "_label INT, _vector BINARY").toArrow()
    vectors = np.frombuffer(b"".join(sample.column("_vector").to_pylist()), np.float32)
    found = sample.column("_label").to_numpy()
    vectors = vectors.reshape(len(found), POOLED)
    order = np.lexsort((*vectors.T[:4], found))  # the order of tasks must not matter
    network = spark.sparkContext.broadcast(Network(vectors[order], found[order]))

    # The struct has the text already: a second copy would double what Python and the JVM hold.
    within = docs.columns.index(text_col) if text_col in docs.columns and "." not in text_col else None

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()

        def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            rows = batch.column("_doc")
            texts = batch.column("_text") if within is None else rows.field(within)
            return scored_slices(rows, texts, table.value, network.value, hashes)

        yield from chain.from_iterable(map(slices, batches))
        hashes.clear()
        release()

    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_doc"),
        *([F.col(text_col).alias("_text")] if within is None else []),
    )
    kind = rows.schema["_doc"].dataType.simpleString()
    return rows.mapInArrow(score, f"_doc {kind}, _score DOUBLE")
