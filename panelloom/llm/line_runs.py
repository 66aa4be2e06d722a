"""Line dedup over levelled sorted runs of line hashes; DataFrame operations only.

Each batch of documents is reduced to its distinct line keys with their first
document. A merge join against all earlier runs tells new keys from known ones; both
become a sorted run of level 0, the known ones as marks that a key of an older run is
repeated. When a level holds ``fanout`` runs they are merged into one sorted run of the
next level, so a key is rewritten a logarithmic number of times. Runs are tables bucketed
and sorted by the key, as many buckets as the session has shuffle partitions: a run is
shuffled only while it is a batch, and merge joins read it in its order.

Texts meet only the keys of two or more documents, which are written for that: both sides
of that join are shuffled, so adaptive execution can split the rows of a frequent line.

A line's key is the line without white space at its ends and with A-Z lower-cased. Keys
are two 64-bit hashes. The first document of a key is the one with the smallest id in
the first batch that holds it: with batches in ascending order of ids, the smallest id
of all.

Defined results: a null or empty text is one empty line; a null id counts as larger than
all ids; rows that share an id are one document, so they never drop each other's lines;
a document that loses all lines has an empty text; an empty table gives an empty table.
Other columns pass through whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.session import scratch_path

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_KEY_CHARS = 10
FANOUT = 2
LAST = 2**63 - 1
KEY = ("_h1", "_h2")
RUN = "_h1 BIGINT, _h2 BIGINT, _first BIGINT, _new BOOLEAN, _again BOOLEAN"
# Spark may rely on the order of a bucket that is one file.
IN_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def line_key(line: Column) -> Column:
    """What two lines must share to count as the same."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line whose key is long enough."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("_id"),
        F.xxhash64(text).alias("_text"),
        F.posexplode(F.split(text, "\n", -1)).alias("_pos", "_line"),
    ).withColumn("_key", line_key("_line"))
    return lines.where(F.char_length("_key") >= min_chars).select(
        F.xxhash64("_key").alias("_h1"),
        F.xxhash64(F.lit("second"), "_key").alias("_h2"),
        "_id", "_text", "_pos",
    )


class Run(NamedTuple):
    """Files of a run, and the run as a table whose buckets Spark knows."""

    path: str
    keys: DataFrame


@contextmanager
def _sorted_buckets(spark: SparkSession) -> Iterator[None]:
    """Jobs inside take buckets as sorted."""
    before = spark.conf.get(IN_ORDER)
    spark.conf.set(IN_ORDER, "true")
    try:
        yield
    finally:
        spark.conf.set(IN_ORDER, before)


class LineRuns:
    """The runs of a corpus in the shared folder, by level.

    A run has one row per key: ``_first`` is the key's first document, ``_new`` says whether
    the key is this run's own, ``_again`` whether two documents are known to hold it. A key
    is new in one run only.
    """

    def __init__(
        self,
        spark: SparkSession,
        id_col: str = "doc_id",
        text_col: str = "text",
        min_chars: int = MIN_KEY_CHARS,
        fanout: int = FANOUT,
    ) -> None:
        self.spark, self.fanout = spark, fanout
        self.columns = (id_col, text_col, min_chars)
        self.root = scratch_path(spark, "line-runs")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[Run]] = []
        self._made = 0

    def _write(self, keys: DataFrame) -> Run:
        """A run as a bucketed table. Only its files stay: the catalogue names it no longer
        than it takes to read it back."""
        name = f"{self.root.rsplit('/', 1)[-1]}-{self._made:05d}".replace("-", "_")
        path = f"{self.root}/run-{self._made:05d}"
        self._made += 1
        with _sorted_buckets(self.spark):
            keys.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(
                name, format="parquet"
            )
        run = Run(path, self.spark.read.table(name))
        self.spark.sql(f"DROP TABLE {name}")
        return run

    def _merged(self, one: Run, two: Run) -> Run:
        """Two sorted runs as one. A full join keeps to the buckets; a union would not."""
        right = two.keys.select(*KEY, *[F.col(c).alias(f"{c}2") for c in ("_first", "_new", "_again")])
        both = one.keys.join(right.hint("merge"), [*KEY], "full")
        return self._write(both.select(
            *KEY,
            F.least("_first", "_first2").alias("_first"),
            F.greatest("_new", "_new2").alias("_new"),
            F.greatest("_again", "_again2").alias("_again"),
        ))

    def _all(self) -> list[Run]:
        return [run for level in self.levels for run in level]

    def _rows(self) -> DataFrame:
        """The rows of all runs, whatever their buckets."""
        paths = [run.path for run in self._all()]
        if not paths:
            return self.spark.createDataFrame([], RUN)
        return self.spark.read.schema(RUN).parquet(*paths)

    def runs(self) -> DataFrame:
        """All keys seen so far with their first document; the runs share no key."""
        return self._rows().where("_new").select(*KEY, "_first")

    def repeated(self) -> DataFrame:
        """Keys of two or more documents with their first document, written."""
        firsts = self._rows().where("_again").groupBy(*KEY).agg(F.min("_first").alias("_first"))
        path = f"{self.root}/repeated-{self._made:05d}"
        self._made += 1
        firsts.write.parquet(path)
        return self.spark.read.schema(firsts.schema).parquet(path)

    def add(self, batch: DataFrame) -> None:
        """Merge join a batch with the runs and add its keys as a run."""
        keys = _lines(batch, *self.columns).groupBy(*KEY).agg(
            F.min("_id").alias("_low"), F.max("_id").alias("_high")
        )
        known = []
        for i, run in enumerate(self._all()):
            own = run.keys.where("_new").select(*KEY, F.col("_first").alias(f"_known{i}"))
            keys = keys.join(own.hint("merge"), [*KEY], "left")
            known.append(F.col(f"_known{i}"))
        first = F.coalesce(F.lit(None).cast("bigint"), *known)
        run = self._write(keys.select(
            *KEY,
            F.coalesce(first, "_low").alias("_first"),
            first.isNull().alias("_new"),
            # Beside a known first document, any other one repeats the key.
            (F.greatest(first, "_high") > F.least(first, "_low")).alias("_again"),
        ))
        for depth in range(len(self.levels) + 1):
            if depth == len(self.levels):
                self.levels.append([])
            self.levels[depth].append(run)
            if len(self.levels[depth]) < self.fanout:
                break
            run, *others = self.levels[depth]
            for other in others:
                run = self._merged(run, other)
            self.levels[depth] = []

    def strip(self, docs: DataFrame) -> DataFrame:
        """Documents of added batches as ``_doc`` (all columns), with ``_n_lines``,
        ``_n_dropped`` and ``_kept``, the text without lines that an earlier document holds."""
        id_col, text_col, _ = self.columns
        drops = (
            _lines(docs, *self.columns)
            .join(self.repeated(), [*KEY])
            .where(F.col("_first") < F.col("_id"))
            .groupBy("_id", "_text")
            .agg(F.collect_set("_pos").alias("_drops"))
        )
        text = F.coalesce(F.col(text_col), F.lit(""))
        rows = docs.select(
            F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_doc"),
            F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("_id"),
            F.xxhash64(text).alias("_text"),
        ).join(drops, ["_id", "_text"], "left")
        text = F.coalesce(F.col("_doc").getField(text_col), F.lit(""))
        lines = F.split(text, "\n", -1)
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_drops"))
        kept = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
        return rows.select(
            "_doc",
            F.size(lines).cast("bigint").alias("_n_lines"),
            F.coalesce(F.size("_drops").cast("bigint"), F.lit(0)).alias("_n_dropped"),
            F.when(F.col("_drops").isNull(), text).otherwise(kept).alias("_kept"),
        )


def ascending_batches(docs: DataFrame, id_col: str, count: int) -> list[DataFrame]:
    """Cut a table in ``count`` batches by ranges of its ids, nulls in the last."""
    shares = [i / count for i in range(1, count)]
    cuts = docs.agg(F.percentile_approx(F.col(id_col), shares, 1000)).first()[0] if shares else []
    cuts = sorted(set(cuts or []))
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST))
    lows, highs = [None, *cuts], [*cuts, None]
    batches = []
    for low, high in zip(lows, highs, strict=True):
        batch = docs
        if low is not None:
            batch = batch.where(key > low)
        if high is not None:
            batch = batch.where(F.col(id_col) <= high)
        batches.append(batch)
    return batches


def dedupe_lines(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    batches: int | Iterable[DataFrame] = 4,
    min_chars: int = MIN_KEY_CHARS,
    fanout: int = FANOUT,
) -> DataFrame:
    """Feed a table through the runs, batch by batch, and strip its repeated lines."""
    store = LineRuns(spark, id_col, text_col, min_chars, fanout)
    parts = ascending_batches(docs, id_col, batches) if isinstance(batches, int) else batches
    for batch in parts:
        store.add(batch)
    return store.strip(docs)
