"""Corpus pipeline: from raw documents to encoded texts, in five stages.

Each stage takes all rows that its predecessor kept, written as Parquet and read again.
Rejected, repeated or unneeded rows are gone for the stages behind. All stages but the last
return the columns of ``documents``; the last adds what the encoder gives.

Nulls, empty and long texts, repeated rows and empty tables: as each operator states it. A
document keeps its id throughout, also where the mix takes it more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm import chosen_path, line_runs, mixing, pieces, quality
from panelloom.llm.common import keep, table
from panelloom.llm.queries import MODEL
from panelloom.llm.queries import QUERIES as OPERATORS


ENCODED = ("n_tokens", "ids", "begins", "ends", "decoded_sha256")


def _columns(docs: DataFrame, **changed) -> list:
    """The columns of ``_doc``, some of them replaced."""
    return [
        changed.get(name, F.col("_doc").getField(name)).alias(name) for name in docs.columns
    ]


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    scored = quality.score_documents(spark, docs, table(spark, sf_dir, "labels"))
    return scored.where("_score >= 0.5").select(*_columns(docs))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document holds."""
    stripped = line_runs.dedupe_lines(spark, docs)
    chars = F.char_length("_kept").cast(docs.schema["n_chars"].dataType)
    return stripped.select(*_columns(docs, text=F.col("_kept"), n_chars=chars))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return chosen_path.keep_one(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as the mix takes them, one row per copy, shard by shard and shuffled
    inside each shard."""
    mixed = mixing.in_shards(mixing.mix(spark, docs, whole=True))
    return mixed.select(*_columns(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and spans of every text."""
    coded = pieces.encode_texts(docs, MODEL)
    coded = coded.withColumn("decoded_sha256", F.sha2(F.encode("decoded", "UTF-8"), 256))
    given = [name for name in docs.columns if name != "text"]
    # A document's own column of such a name keeps its values under another one.
    taken = {*given, *ENCODED}
    names = {}
    for name in given:
        free = name
        while free in ENCODED or (free != name and free in taken):
            free = f"doc_{free}"
        names[name] = free
        taken.add(free)
    own = [F.col("_doc").getField(name).alias(free) for name, free in names.items()]
    return coded.select(*own, *ENCODED)


STAGES = [
    ("quality", reject_poor),
    ("line_dedup", drop_lines),
    ("near_duplicates", keep_one_of_each),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# The classifier, the drawn blocks and the encoder have no SQL form; the tests hold the
# stages against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {**OPERATORS, "pipeline": run}
