"""Stratified blind samples for labelling."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.functions import identifiers as ids
from panelloom.functions import text as tx
from panelloom.session import scratch_path

# Fixed values -------------------------------------------------------------
SAMPLE_SIZE = 250
SEED = 42
LABELING_COLUMNS = ("sample_id", "excerpt", "human_ai_mention")
SCORE_COLUMNS = (
    "sample_id",
    "document_id",
    "firm_id",
    "ticker",
    "fiscal_year",
    "form_type",
    "ai_mention_count",
    "density_bin",
    "keyword_predicted",
)
# --------------------------------------------------------------------------

_STRATUM = ("fiscal_year", "density_bin")


def score_pool(documents: DataFrame, keywords: Sequence[str] | None = None) -> DataFrame:
    """Per document: mention count, density bin, excerpt and keyword prediction.

    Ticker and form type are blank when the documents lack those columns.
    """
    words = list(keywords or tx.DEFAULT_KEYWORDS)
    for name in ("ticker", "form_type"):
        if name not in documents.columns:
            documents = documents.withColumn(name, F.lit(""))
    counted = documents.withColumn("ai_mention_count", tx.mention_count(F.col("text"), words))
    return tx.with_keyword_excerpt(counted, "text", words).select(
        "document_id",
        "firm_id",
        "ticker",
        F.col("fiscal_year").cast("int").alias("fiscal_year"),
        "form_type",
        "ai_mention_count",
        tx.density_bin(F.col("ai_mention_count")).alias("density_bin"),
        "excerpt",
        (F.col("ai_mention_count") > 0).cast("int").alias("keyword_predicted"),
    )


def _draw(seed: int, salt: str) -> Column:
    """A pseudo-random sort key: fixed by seed and document, equal on every run."""
    return F.sha2(F.concat(F.lit(f"{seed}|{salt}"), F.col("document_id").cast("string")), 256)


def _needed(most: int) -> float:
    """How many rows of a stratum to let through so that ``most`` are almost surely among them:
    the expected number is eight standard deviations above."""
    return most + 8 * most**0.5 + 16


def choose_ids(
    pool: DataFrame,
    sample_size: int = SAMPLE_SIZE,
    seed: int = SEED,
    needed: Callable[[int], float] = _needed,
) -> DataFrame:
    """Ids of up to ``sample_size`` documents, spread over (fiscal_year, density_bin) strata.

    Each stratum gives at most ``max(1, sample_size // bins present)`` documents, those with the
    smallest draws, and the union is cut down uniformly. The id, stratum and draw of every
    document are written once, as the pool may be dear to compute. Strata are counted map-side.
    A draw is uniform, so from a stratum's count follows a threshold that lets through a few
    more rows than its quota; the scan drops all others. What is shuffled depends on the
    number of strata and the sample's size, not on the pool's. A stratum that its threshold
    leaves short (about once in 10^15) is read again without one, so the result is exact.
    """
    spark = pool.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    # As one text, a stratum without a year or bin joins with itself.
    stratum = F.to_json(F.struct(*_STRATUM)).alias("_stratum")
    drawn = kept(
        pool.select("document_id", "density_bin", stratum, _draw(seed, "").alias("_draw")), "draws"
    )
    sizes = kept(
        drawn.groupBy("_stratum").agg(
            F.count("*").alias("_size"), F.max("density_bin").alias("_bin")
        ),
        "strata",
    )
    bins = sizes.agg(F.count_distinct("_bin")).first()[0]
    quota = max(1, sample_size // max(1, bins))
    # The leading 52 bits of a draw as a fraction, which a double holds exactly.
    share = F.conv(F.substring("_draw", 1, 13), 16, 10).cast("double") / F.lit(2.0**52)
    wanted = F.lit(float(needed(quota)))
    passed = kept(
        drawn.join(sizes, "_stratum").where(share * F.col("_size") <= wanted)
        .select("document_id", "_stratum", "_draw"),
        "passed",
    )
    have = passed.groupBy("_stratum").agg(F.count("*").alias("_have"))
    short = (
        sizes.join(have, "_stratum", "left")
        .where(F.coalesce("_have", F.lit(0)) < F.least(F.col("_size"), F.lit(quota)))
        .select("_stratum")
    )
    again = drawn.join(short, "_stratum", "left_semi").select("document_id", "_stratum", "_draw")
    rest = passed.join(short, "_stratum", "left_anti")
    by_stratum = Window.partitionBy("_stratum").orderBy("_draw", "document_id")
    return (
        rest.unionByName(again)
        .withColumn("_rank", F.row_number().over(by_stratum))
        .where(F.col("_rank") <= quota)
        .withColumn("_second", _draw(seed, "second|"))
        .orderBy("_second", "document_id")
        .limit(sample_size)
        .select("document_id")
    )


def stratified_sample(
    pool: DataFrame, sample_size: int = SAMPLE_SIZE, seed: int = SEED
) -> DataFrame:
    """The pool's rows of the chosen ids, with their blind id."""
    return _rows_of(choose_ids(pool, sample_size, seed), pool).withColumn(
        "sample_id", ids.sample_id(F.col("document_id"))
    )


def _rows_of(chosen: DataFrame, table: DataFrame) -> DataFrame:
    # At most sample_size ids: the caller's parameter bounds what is broadcast.
    return table.join(F.broadcast(chosen.distinct()), "document_id", "left_semi")


def sample_documents(
    documents: DataFrame,
    keywords: Sequence[str] | None = None,
    sample_size: int = SAMPLE_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """Sample straight from documents: all are counted, only the chosen ones get excerpts."""
    words = list(keywords or tx.DEFAULT_KEYWORDS)
    strata = documents.select(
        "document_id",
        F.col("fiscal_year").cast("int").alias("fiscal_year"),
        tx.density_bin(tx.mention_count(F.col("text"), words)).alias("density_bin"),
    )
    chosen = _rows_of(choose_ids(strata, sample_size, seed), documents)
    return score_pool(chosen, words).withColumn("sample_id", ids.sample_id(F.col("document_id")))


def generate_sample(
    documents: DataFrame,
    keywords: Sequence[str] | None = None,
    sample_size: int = SAMPLE_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """Sample a stored documents table for labelling; no documents at all is an error."""
    if documents.isEmpty():
        raise ValueError("there are no documents to sample from")
    return sample_documents(documents, keywords, sample_size, seed)


def blind_labeling(sample: DataFrame) -> DataFrame:
    """What the labeller sees: id, excerpt and a blank label."""
    return sample.withColumn("human_ai_mention", F.lit("")).select(*LABELING_COLUMNS)


def blind_scores(sample: DataFrame) -> DataFrame:
    """What stays hidden: metadata and prediction."""
    return sample.select(*SCORE_COLUMNS)
