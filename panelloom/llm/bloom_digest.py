"""Document fingerprints from statistically improbable byte windows.

Every 64-byte window has an entropy level. A histogram of the levels over all documents
ranks them: the rarer a level, the lower its rank. Among each 64 neighbouring windows the
leftmost of the lowest rank scores; windows that score ``MIN_SCORE`` times are the
document's features. Features are hashed into a chain of 2048-bit Bloom filters, five bits
each, 160 different features a filter. Two fingerprints are compared filter by filter: the
common bits over those expected by chance, divided by the most there could be; each filter
of the shorter chain takes its best match, weighted by its bits.

Entropies of a whole Arrow slice come from 63 shifted comparisons of its bytes, so there is
no loop over windows or documents. Sums are integers: equal texts give equal fingerprints
wherever they stand.

Defined results: null is the empty text; an empty text has no features, an empty
fingerprint and likeness 1 to another empty one, 0 to all others; a text shorter than a
window is one window filled up with zero bytes; texts without a window of score
``MIN_SCORE`` use their leftmost of lowest rank; long texts are read whole; rows are ordered by
descending id (null last), then a hash of the text, then text, so repeated rows follow each
other; an id with more rows than a range holds is dealt over several ranges by that hash; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm.common import mixed, text_runs

WINDOW = 64
NEIGHBOURS = 64
MIN_SCORE = 16
BITS = 2048
PER_FILTER = 160
HASHES = 5
FULL = 6 * WINDOW << 16  # entropy of a window of 64 different bytes, scaled
LEVEL_SHIFT = 15
LEVELS = (FULL >> LEVEL_SHIFT) + 1
SLICE_BYTES = 1 << 19
HEAD = -(2**63)

_counts = np.arange(WINDOW + 1, dtype=np.float64)
_terms = np.round(_counts * np.log2(np.maximum(_counts, 1)) * 65536).astype(np.int64)
GAIN = np.diff(_terms).astype(np.int32)


def levels(raw: np.ndarray) -> np.ndarray:
    """Entropy level of the window that starts at each byte; fewer than 64 bytes: none."""
    count = len(raw)
    if count < WINDOW:
        return np.zeros(0, np.int32)
    before, after = np.zeros(count, np.uint8), np.zeros(count, np.uint8)
    for lag in range(1, WINDOW):
        same = (raw[lag:] == raw[:-lag]).view(np.uint8)
        before[lag:] += same
        after[:-lag] += same
    change = GAIN[before].astype(np.int64)
    change[WINDOW:] -= GAIN[after[:-WINDOW]]
    return ((FULL - np.cumsum(change)[WINDOW - 1 :]) >> LEVEL_SHIFT).astype(np.int32)


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes, short ones filled up to a window, and where each begins."""
    parts = [text.encode("utf-8") for text in texts]
    parts = [p.ljust(WINDOW, b"\0") if 0 < len(p) < WINDOW else p for p in parts]
    begins = np.cumsum([0, *map(len, parts)])
    return np.frombuffer(b"".join(parts), np.uint8), begins


def _inside(begins: np.ndarray, width: int, count: int) -> np.ndarray:
    """Marks the starts from which ``width`` bytes stay inside one text."""
    inside = np.zeros(count, bool)
    for low, high in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        if high - low >= width:
            inside[low : high - width + 1] = True
    return inside


def level_counts(texts: list[str]) -> np.ndarray:
    """Histogram of the levels of all windows of the texts."""
    raw, begins = _joined(texts)
    found = levels(raw)
    return np.bincount(found[_inside(begins, WINDOW, len(found))], minlength=LEVELS)


def ranks(histogram: np.ndarray) -> np.ndarray:
    """Rank of each level, rarest first; equally rare ones by level."""
    order = np.argsort(histogram, kind="stable")
    found = np.empty(LEVELS, np.int64)
    found[order] = np.arange(LEVELS)
    return found


def _features(texts: list[str], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of the features of all texts, in order of their place."""
    raw, begins = _joined(texts)
    found = levels(raw)
    if not len(found):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    keys = (rank[found] << np.int64(40)) | np.arange(len(found))
    single = _inside(begins, WINDOW, len(found))
    score = np.zeros(len(found), np.int64)
    if len(keys) >= NEIGHBOURS:
        lowest, step = keys, 1
        while step < NEIGHBOURS:
            lowest = np.minimum(lowest[:-step], lowest[step:])
            step *= 2
        whole = _inside(begins, WINDOW + NEIGHBOURS - 1, len(lowest))
        score = np.bincount(lowest[whole] & ((1 << 40) - 1), minlength=len(found))
    chosen = (score >= MIN_SCORE) & single
    places = np.flatnonzero(chosen)
    owners = np.searchsorted(begins, places, "right") - 1
    lacking = np.setdiff1d(np.flatnonzero(np.diff(begins)), owners)
    if len(lacking):
        extra = [
            int(keys[begins[i] : begins[i + 1] - WINDOW + 1].min() & ((1 << 40) - 1))
            for i in lacking
        ]
        places = np.sort(np.concatenate([places, extra])).astype(np.int64)
        owners = np.searchsorted(begins, places, "right") - 1
    words = np.lib.stride_tricks.sliding_window_view(raw, WINDOW)[places].view("<u8")
    hashes = np.zeros(len(places), np.uint64)
    for column in range(words.shape[1]):
        hashes = mixed((hashes ^ words[:, column]) + np.uint64(column + 1))
    # The same feature again adds nothing to a chain.
    order = np.lexsort((places, hashes, owners))
    first = np.ones(len(order), bool)
    first[1:] = (np.diff(owners[order]) != 0) | (hashes[order][1:] != hashes[order][:-1])
    stay = np.sort(order[first])
    return owners[stay], hashes[stay]


def fingerprints(texts: list[str], rank: np.ndarray) -> list[np.ndarray]:
    """Each text's chain of filters, one row of 256 bytes per filter."""
    owners, hashes = _features(texts, rank)
    counts = np.bincount(owners, minlength=len(texts))
    chains = -(-counts // PER_FILTER)
    bases = np.cumsum([0, *chains])
    ordinal = np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)
    row = bases[owners] + ordinal // PER_FILTER
    bits = np.zeros(int(bases[-1]) * BITS, np.uint8)
    for i in range(HASHES):
        bits[row * BITS + ((hashes >> np.uint64(11 * i)) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    packed = np.packbits(bits).reshape(-1, BITS // 8)
    return [packed[bases[i] : bases[i + 1]] for i in range(len(texts))]


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """Normalised bit overlap of two chains, 0 to 1."""
    if not len(one) or not len(two):
        return float(len(one) == len(two))
    if one.shape == two.shape and np.array_equal(one, two):
        return 1.0
    if len(one) > len(two):
        one, two = two, one
    total = _best(one, two)
    if len(one) == len(two):
        total = (total + _best(two, one)) / 2
    return total


def _best(few: np.ndarray, many: np.ndarray) -> float:
    other = np.unpackbits(many, axis=1).astype(np.float32)
    sizes = other.sum(axis=1)
    score = weight = 0.0
    for low in range(0, len(few), 64):
        bits = np.unpackbits(few[low : low + 64], axis=1).astype(np.float32)
        own = bits.sum(axis=1)
        chance = own[:, None] * sizes[None, :] / BITS
        most = np.minimum(own[:, None], sizes[None, :])
        over = (bits @ other.T - chance) / np.maximum(most - chance, 1e-9)
        score += float((np.clip(over, 0, 1).max(axis=1) * own).sum())
        weight += float(own.sum())
    return min(1.0, score / weight)


def histogram(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Histogram of window levels over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS, np.int64)
        for batch in batches:
            for _, _, texts in text_runs(batch.column(0), SLICE_BYTES):
                total += level_counts(texts)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["level", "n"])

    counted = docs.select(text_col).mapInArrow(count, "level BIGINT, n BIGINT")
    total = np.zeros(LEVELS, np.int64)
    for level, n in counted.groupBy("level").agg(F.sum("n")).collect():
        total[level] = n
    return total


def _cuts(keys: DataFrame, parts: int) -> tuple[list[int], dict[int, int]]:
    """Keys that end ranges of about equal numbers of rows, and how many ranges each key
    that fills more than one of them takes."""
    shares = [i / parts for i in range(1, parts)] or [0.5]
    found, total = keys.agg(
        F.percentile_approx("_key", shares, 20 * parts), F.count(F.lit(1))
    ).first()
    cuts, hot = [int(cut) for cut in found or []], {}
    if len(set(cuts)) < len(cuts):
        # At most as many keys as ranges can fill one.
        large = keys.groupBy("_key").count().where(F.col("count") * parts > total)
        hot = {key: -(-count * parts // total) for key, count in large.collect()}
    return sorted({*cuts, *hot}), hot


def _bucket(cuts: list[int], hot: dict[int, int]) -> tuple[Column, int]:
    """Number of a row's range, in the order of rows, and how many there are. The rows of a
    hot key are dealt over ranges of their own by ``_tie``; smaller keys follow them."""
    bounds = F.array(*map(_long, cuts)) if cuts else F.array().cast("array<bigint>")
    bucket = F.size(F.filter(bounds, lambda cut: cut >= F.col("_key")))
    for key, count in hot.items():
        own = F.least(F.floor(F.col("_tie") / 2.0**63 * count), _long(count - 1)).cast("int")
        bucket += F.when(F.col("_key") == _long(key), own).otherwise(
            F.when(F.col("_key") < _long(key), count).otherwise(0)
        )
    return bucket, len(cuts) + 1 + sum(hot.values())


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _with_next(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows dealt by ranges of ids, sorted by descending id, each range followed by the
    first row of the next one (``_own`` false), the last by the first of all."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(HEAD)).alias("_key"),
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    ).withColumn("_tie", F.shiftrightunsigned(F.xxhash64("_text"), 1))
    bucket, ranges = _bucket(*_cuts(rows.select("_key"), parts))
    rows = rows.withColumn("_bucket", bucket)
    # One row per range; their number is a small multiple of the shuffle partitions.
    tops = rows.groupBy("_bucket").agg(F.max("_key").alias("_key"))
    heads = (
        rows.select("_bucket", "_key", "_tie")
        .join(F.broadcast(tops), ["_bucket", "_key"])
        .groupBy("_bucket", "_key").agg(F.min("_tie").alias("_tie"))
        .orderBy("_bucket").collect()
    )
    following = [*heads[1:], *heads[:1]]
    pairs = [
        (after["_key"], after["_tie"], head["_bucket"])
        for head, after in zip(heads, following, strict=True)
    ]
    followers = spark.createDataFrame(pairs, "_key BIGINT, _tie BIGINT, _before INT")
    # Rows of one id and text are alike, so any of them will do.
    extra = (
        rows.select("_key", "_id", "_text", "_tie")
        .join(F.broadcast(followers), ["_key", "_tie"])
        .groupBy("_before").agg(F.min(F.struct("_text", "_key", "_id", "_tie")).alias("_row"))
        .select(F.col("_before").alias("_bucket"), "_row.*", F.lit(False).alias("_own"))
    )
    own = rows.withColumn("_own", F.lit(True))
    dealt = own.unionByName(extra).repartitionById(ranges, "_bucket").sortWithinPartitions(
        F.asc("_bucket"), F.desc("_own"), F.desc("_key"), F.asc("_tie"), F.asc("_text")
    )
    return dealt.drop("_key", "_tie")


RESULT = pa.schema(
    [
        ("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)
RESULT_DDL = (
    "id BIGINT, n_chars BIGINT, edited_sha256 STRING, fingerprint STRING, "
    "edited_fingerprint STRING, near_edited DOUBLE, near_next DOUBLE"
)


def compare_with_next(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each document's fingerprint, that of its text with the last half replaced by the
    start of the next document by descending id, and their likenesses."""
    rank = ranks(histogram(docs, text_col))

    def flush(rows: list[tuple]) -> tuple[pa.RecordBatch, list[tuple]]:
        """Results of all rows whose follower is known."""
        pairs = [
            (i, i + 1) for i in range(len(rows) - 1)
            if rows[i][3] and rows[i][0] == rows[i + 1][0]
        ]
        texts = [row[2] for row in rows]
        whole = fingerprints(texts, rank)
        edited = []
        for i, j in pairs:
            half = len(texts[i]) // 2
            edited.append(texts[i][: len(texts[i]) - half] + texts[j][:half])
        prints = fingerprints(edited, rank)
        out = [
            (
                rows[i][1], len(texts[i]), hashlib.sha256(text.encode("utf-8")).hexdigest(),
                base64.b64encode(whole[i].tobytes()).decode(),
                base64.b64encode(changed.tobytes()).decode(),
                likeness(whole[i], changed), likeness(whole[i], whole[j]),
            )
            for (i, j), text, changed in zip(pairs, edited, prints, strict=True)
        ]
        columns = list(zip(*out, strict=True)) if out else [[] for _ in RESULT]
        arrays = [pa.array(c, field.type) for c, field in zip(columns, RESULT, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=RESULT), rows[-1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for low, high, texts in text_runs(batch.column("_text"), SLICE_BYTES):
                part = batch.slice(low, high - low)
                columns = [part.column(name).to_pylist() for name in ("_bucket", "_id", "_own")]
                rows = list(zip(columns[0], columns[1], texts, columns[2], strict=True))
                result, held = flush(held + rows)
                yield result

    return _with_next(spark, docs, id_col, text_col).mapInArrow(run, RESULT_DDL)
