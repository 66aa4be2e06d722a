"""Substring dedup by content-defined chunks.

A gear rolling hash over 16 bytes (each byte's table value, shifted by its age) decides where
chunks begin: at the words whose first 16 bytes have the smallest hash of any ``HEAD_GAP`` words in
a row, ties included, so chunks depend on the text around them only and come back after an
insertion. What is compared are passages of ``MIN_WORDS`` whole words, from every word on. The 9
words from the first smallest hash in a passage are its head; whatever stands around it, a passage
has the same head, and one head serves 6 passages on average. So heads are compared first. Only
passages whose head is in more than one document are compared themselves, all of them. So every
passage of ``MIN_WORDS`` words that two documents share is found, and so is every longer one.
Shared passages are repeats: the smallest id keeps its copy, other documents lose the bytes of
theirs, at all places.

Heads and passages are named by 64-bit digests, a polynomial of their bytes' random numbers,
finalised: of 10^12 passages about 3 in 10^8 share a digest with another by chance.

Defined results: passages are equal byte for byte, with the white space between their words; null
and empty texts have no passages and stay; texts are read whole; a passage that comes back inside
one document only stays at all places; null ids count as larger than all others; rows that share
both id and text are one document, other rows that share an id (or have none) are ordered by a
hash of their texts; an empty table gives an empty table; other columns pass through in a struct.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm.common import keep, mixed, text_runs

MIN_WORDS = 20
MAX_WORDS = 16
HEAD_WORDS = 9  # words of one character and the white space between them fill 16 bytes
HEAD_GAP = MIN_WORDS - HEAD_WORDS + 1
GEAR_BYTES = 16
GEAR = np.random.default_rng(7).integers(0, 1 << 16, 256, dtype=np.uint16)
NUMBERS = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
LAST = 2**63 - 1
SLICE_BYTES = 1 << 20
BLOCK = 1 << 15
PAGE_BITS = 1 << 15  # of one bitmap; Spark's bitmap functions fix this number


def gear_hash(raw: np.ndarray) -> np.ndarray:
    """Rolling hash of the 16 bytes that end at each byte."""
    rolled = GEAR[raw]
    for step in (1, 2, 4, 8):
        shifted = rolled << np.uint16(step)
        rolled = rolled.copy()
        rolled[step:] += shifted[:-step] if step < len(raw) else shifted[:0]
    return rolled


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word in bytes."""
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    turns = np.diff(space, prepend=True, append=True)
    edges = np.flatnonzero(turns)
    return edges[::2], edges[1::2]


def _ranks(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Gear hash of the first 16 bytes from each word on."""
    return gear_hash(raw)[np.minimum(starts + GEAR_BYTES - 1, len(raw) - 1)]


def chunk_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the chunks in bytes, and the words that begin before each bound."""
    if not len(raw):
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    starts, _ = _words(raw)
    cuts = starts[_least(_ranks(raw, starts), HEAD_GAP)] if len(starts) else starts
    bounds = np.unique(np.concatenate([[0], cuts, [len(raw)]]))
    return bounds, np.searchsorted(starts, bounds, "left")


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Which values are the least of any ``width`` in a row."""
    width = min(width, len(values))
    views = np.lib.stride_tricks.sliding_window_view
    least = views(values.astype(np.int32), width).min(axis=1)
    least = np.pad(least, width - 1, constant_values=-1)
    return views(least, width).max(axis=1) == values


class _Powers:
    """Powers of ``BASE`` and of its inverse, as many as the longest text so far asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            size = 1 << (count - 1).bit_length()
            self.up, self.down = (
                np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)])
                for base in (BASE, pow(BASE, -1, 1 << 64))
            )
        return self.up[:count], self.down[:count]


_POWERS = _Powers()


def _digests(raw: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Digests of any stretches of a text, by their begins and ends."""
    up, down = _POWERS.upto(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(NUMBERS[raw] * up[:-1], out=sums[1:])

    def of(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((sums[ends] - sums[begins]) * down[begins]).view(np.int64)

    return of


def passages(text: bytes, min_words: int) -> tuple[np.ndarray, ...]:
    """Begin, end, digest and digest of the head of every passage of so many words."""
    raw = np.frombuffer(text, np.uint8)
    starts, stops = _words(raw)
    count = len(starts) - min_words + 1
    if count < 1:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    size = min(HEAD_WORDS, min_words)
    ranks = _ranks(raw, starts)[: len(starts) - size + 1]
    views = np.lib.stride_tricks.sliding_window_view(ranks, min_words - size + 1)
    heads = np.arange(count) + views.argmin(axis=1)
    begins, ends = starts[:count], stops[min_words - 1 :]
    digests, named = np.empty(count, np.int64), np.empty(count, np.int64)
    for low in range(0, count, BLOCK):  # so that a long text needs no numbers for all its bytes
        part = slice(low, min(low + BLOCK, count))
        base = begins[low]
        of = _digests(raw[base : ends[part.stop - 1]])
        digests[part] = of(begins[part] - base, ends[part] - base)
        named[part] = of(starts[heads[part]] - base, stops[heads[part] + size - 1] - base)
    return begins, ends, digests, named


def runs(text: bytes, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and digest of each passage of so many words."""
    return passages(text, min_words)[:3]


HEADS = pa.schema([("_head", pa.int64()), ("_id", pa.int64()), ("_hash", pa.int64())])
HEADS_DDL = "_head BIGINT, _id BIGINT, _hash BIGINT"
RUNS = pa.schema([*HEADS, ("_digest", pa.int64()), ("_span", pa.int64())])
RUNS_DDL = f"{HEADS_DDL}, _digest BIGINT, _span BIGINT"


def row_key(id_col: str, text_col: str) -> list[Column]:
    """``_id`` and ``_hash``: spans belong to a text, also where texts share an id."""
    return [
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_hash"),
    ]


class Filter:
    """A Bloom filter of digests in a column, with two probes, built by Spark in pages of 32,768
    bits. Its size is bounded: with too many digests it says "maybe" too often and is ``crowded``."""

    BITS_PER_KEY = 16
    LEAST_BITS_PER_KEY = 4
    MOST_BITS = 1 << 29

    def __init__(self, spark: SparkSession, keys: DataFrame, column: str) -> None:
        count = keys.count()
        wanted = 1 << max(PAGE_BITS - 1, self.BITS_PER_KEY * count - 1).bit_length()
        bits = min(wanted, self.MOST_BITS)
        self.mask, self.crowded = bits - 1, count * self.LEAST_BITS_PER_KEY > bits
        low = F.col(column).bitwiseAND(self.mask)
        high = F.shiftrightunsigned(F.col(column), 32).bitwiseAND(self.mask)
        at = keys.select(F.explode(F.array(low, high)).alias("at"))
        pages = at.select(
            F.shiftright("at", 15).alias("page"), F.col("at").bitwiseAND(PAGE_BITS - 1).alias("bit")
        )
        filled = pages.repartition("page").groupBy("page").agg(
            F.bitmap_construct_agg("bit").alias("bits")
        )
        whole = np.zeros(bits // 8, np.uint8)
        for row in filled.toLocalIterator():
            low = row["page"] * PAGE_BITS // 8
            whole[low : low + PAGE_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
        self.bits = spark.sparkContext.broadcast(whole)

    def maybe(self, digests: np.ndarray) -> np.ndarray:
        """Which digests may be in; all that are."""
        bits, values = self.bits.value, digests.view(np.uint64)
        found = np.ones(len(values), bool)
        for at in (values & np.uint64(self.mask), (values >> np.uint64(32)) & np.uint64(self.mask)):
            found &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found


def _mapped(
    docs: DataFrame, id_col: str, text_col: str, schema: pa.Schema, ddl: str,
    columns: Callable[[bytes], tuple[np.ndarray, ...]],
) -> DataFrame:
    """Rows of all texts: a first column, id and hash of the text, and further columns."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("_id").to_pylist()
            hashes = batch.column("_hash").to_pylist()
            held: list[list[np.ndarray]] = [[] for _ in schema]
            size = 0

            def block() -> pa.RecordBatch:
                arrays = [pa.array(np.concatenate(part)) for part in held]
                return pa.RecordBatch.from_arrays(arrays, schema=schema)

            texts = (t for *_, run in text_runs(batch.column("_text"), SLICE_BYTES) for t in run)
            for key, name, text in zip(ids, hashes, texts, strict=True):
                first, *others = columns(text.encode("utf-8"))
                count = len(first)
                if not count:
                    continue
                owner = [np.full(count, key, np.int64), np.full(count, name, np.int64)]
                for part, values in zip(held, [first, *owner, *others], strict=True):
                    part.append(values)
                size += count
                if size > 100_000:
                    yield block()
                    held, size = [[] for _ in schema], 0
            if size:
                yield block()

    rows = docs.select(*row_key(id_col, text_col), F.col(text_col).alias("_text"))
    return rows.mapInArrow(cut, ddl)


def document_heads(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """Heads of all passages: digest, id and hash of the text."""
    heads = lambda text: (np.unique(passages(text, min_words)[3]),)
    return _mapped(docs, id_col, text_col, HEADS, HEADS_DDL, heads)


def document_runs(
    docs: DataFrame, id_col: str, text_col: str, min_words: int, heads: Filter,
    digests: Filter | None = None,
) -> DataFrame:
    """Passages that the filters let through: head, id and hash of the text, digest, span (begin and
    end in one number)."""

    def wanted(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        begins, ends, named, head = passages(text, min_words)
        through = heads.maybe(head)
        if digests is not None:
            through &= digests.maybe(named)
        return head[through], named[through], (begins[through] << 32) | ends[through]

    return _mapped(docs, id_col, text_col, RUNS, RUNS_DDL, wanted)


def repeated_runs(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """Per ``_id`` and ``_hash`` (of the text) with repeats: ``_drops`` (merged spans that go), ``_firsts`` (ids that
    keep them) and ``_shared`` (merged spans that another document has, too).

    Passages are cut twice more, not stored: filters of the repeated heads and passages let
    next to none but repeats through. Where there are too many heads for the filter, a join decides.
    """
    owners = document_heads(docs, id_col, text_col, min_words).groupBy("_head").agg(
        F.min("_id").alias("_low"), F.max("_id").alias("_high"),
        F.min("_hash").alias("_least"), F.max("_hash").alias("_most"),
    )
    heads = keep(
        spark, owners.where("_low < _high or _least < _most").select("_head"), "heads"
    )
    head_filter = Filter(spark, heads, "_head")
    found = document_runs(docs, id_col, text_col, min_words, head_filter)
    if head_filter.crowded:
        found = found.join(heads, "_head")
    owner = F.struct("_id", "_hash")
    holders = found.groupBy("_digest").agg(F.min(owner).alias("_first"), F.max(owner).alias("_last"))
    repeats = keep(spark, holders.where("_first < _last").select("_digest", "_first"), "repeats")
    digest_filter = Filter(spark, repeats, "_digest")
    spans = document_runs(docs, id_col, text_col, min_words, head_filter, digest_filter).drop(
        "_head"
    ).join(repeats, "_digest")
    mine = F.col("_first") < owner
    grouped = spans.groupBy("_id", "_hash").agg(
        F.sort_array(F.collect_set("_span")).alias("_all"),
        F.sort_array(F.collect_set(F.when(mine, F.col("_span")))).alias("_mine"),
        F.collect_set(F.when(mine, F.col("_first._id"))).alias("_firsts"),
    )
    merged = F.pandas_udf(
        _merge, "ARRAY<STRUCT<begin: BIGINT, end: BIGINT>>"
    )
    return grouped.select(
        "_id", "_hash", merged("_mine").alias("_drops"), F.sort_array("_firsts").alias("_firsts"),
        merged("_all").alias("_shared"),
    )


def _merge(lists: pd.Series) -> pd.Series:
    """Overlapping and touching spans as one."""
    merged = []
    for spans in lists:
        begins, ends = spans >> 32, np.maximum.accumulate(spans & 0xFFFFFFFF)
        # Spans are sorted by begin; one begins anew behind the end of all before it.
        new = np.flatnonzero(begins[1:] > ends[:-1]) + 1
        first, last = [0, *new.tolist()], [*(new - 1).tolist(), len(spans) - 1]
        merged.append(
            [{"begin": int(begins[a]), "end": int(ends[b])} for a, b in zip(first, last, strict=True)]
            if len(spans) else []
        )
    return pd.Series(merged)


def _cut(texts: pd.Series, drops: pd.Series) -> pd.Series:
    """Texts without their spans."""
    kept = []
    for text, spans in zip(texts, drops, strict=True):
        raw, parts, at = text.encode("utf-8"), [], 0
        for span in spans if spans is not None else ():
            parts.append(raw[at : span["begin"]])
            at = span["end"]
        kept.append(b"".join([*parts, raw[at:]]).decode("utf-8"))
    return pd.Series(kept)


def strip_passages(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """All columns as ``_doc``, and ``_kept``, the text without repeats of smaller ids."""
    found = repeated_runs(spark, docs, id_col, text_col, min_words)
    found = found.select("_id", "_hash", "_drops")

    cut = F.pandas_udf(_cut, "STRING")
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_doc"),
        *row_key(id_col, text_col),
    ).join(found, ["_id", "_hash"], "left")
    text = F.coalesce(F.col("_doc").getField(text_col), F.lit(""))
    return rows.select("_doc", cut(text, F.col("_drops")).alias("_kept"))
