"""The catalogue: every operator as a runnable query over the shared tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom import schemas
from panelloom.functions import identifiers as ids
from panelloom.functions import text as tx
from panelloom.operators import features, filings, metrics, panel, quality, sampling
from panelloom.operators import mapping as maps
from panelloom.operators.joins import HOT_ROWS
from panelloom.plans import inputs, stages
from panelloom.session import scratch_path
from panelloom.sources import listing, scans, sinks, views
from panelloom.sources.manifest_store import ManifestStore
from panelloom.sources.mapping_store import MappingStore
from panelloom.streaming import landing, rollup

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_LOW, _HIGH = inputs.PANEL_YEARS


def query(function: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[function.__name__] = function
    return function


# -- text and features ---------------------------------------------------------


@query
def firm_year_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions, tokens and share per firm-year."""
    return features.attention_firm_year(
        inputs.documents(spark, sf_dir), inputs.KEYWORDS, inputs.PANEL_SOURCE
    )


@query
def doc_keyword_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and matched keywords of every document."""
    counted = features.document_features(inputs.documents(spark, sf_dir), inputs.KEYWORDS)
    return counted.withColumn("matched_keywords", F.array_join("matched_keywords", "|"))


@query
def no_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Firm-years when no keyword is configured: all counts zero."""
    return features.attention_firm_year(inputs.documents(spark, sf_dir), (), inputs.PANEL_SOURCE)


@query
def placebo_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly trend of the firm-year features."""
    return features.placebo_trend(firm_year_attention(spark, sf_dir))


@query
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of HTML pages."""
    pages = inputs.texts(spark, sf_dir, "pages").select("page_id", "html")
    return tx.with_html_text(pages, "html").drop("html")


@query
def fast_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with tags stripped only."""
    pages = inputs.texts(spark, sf_dir, "pages").select("page_id", "html")
    return tx.with_stripped_text(pages, "html").drop("html")


@query
def filing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bytes of pages and documents, each by its own route, as text."""
    pages = inputs.texts(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), "page_id").alias("file"), F.col("html").alias("raw")
    )
    documents = inputs.texts(spark, sf_dir, "documents").select(
        F.concat(F.lit("document-"), "doc_id").alias("file"), F.col("text").alias("raw")
    )
    files = pages.unionByName(documents).select("file", F.encode("raw", "UTF-8").alias("content"))
    return tx.with_filing_text(files, "content").drop("content")


@query
def latin1_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latin-1 bytes of all pages, read back: UTF-8 first, else Latin-1."""
    pages = inputs.texts(spark, sf_dir, "pages")
    latin = F.regexp_replace("html", "[^\u0000-ÿ]", "?")
    content = F.encode(latin, "ISO-8859-1")
    return pages.select("page_id", tx.bytes_to_text(content).alias("text"))


@query
def preprocess_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NFKC and collapsed white space."""
    documents = inputs.texts(spark, sf_dir, "documents")
    return documents.select("doc_id", tx.preprocess(F.col("text")).alias("text"))


@query
def preprocess_wide_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NFKC where it changes every text: full-width letters and ligatures are planted."""
    documents = inputs.texts(spark, sf_dir, "documents")
    wide = F.translate(F.replace(F.col("text"), F.lit("fi"), F.lit("ﬁ")), "aeo", "ａｅｏ")
    return documents.select("doc_id", tx.preprocess(wide).alias("text"))


@query
def density_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per year and density bin."""
    pool = inputs.documents(spark, sf_dir).withColumn(
        "ai_mention_count", tx.mention_count(F.col("text"), inputs.KEYWORDS)
    )
    return (
        pool.groupBy("fiscal_year", tx.density_bin(F.col("ai_mention_count")).alias("density_bin"))
        .agg(F.count("*").alias("documents"), F.sum("ai_mention_count").alias("mentions"))
    )


@query
def head_excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First characters of every document."""
    documents = inputs.documents(spark, sf_dir)
    return documents.select("document_id", tx.head_excerpt(F.col("text")).alias("excerpt"))


@query
def keyword_excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window around the first keyword of every document."""
    documents = inputs.documents(spark, sf_dir).select("document_id", "text")
    return tx.with_keyword_excerpt(documents, "text", inputs.KEYWORDS).drop("text")


# -- identifiers -----------------------------------------------------------------


@query
def identifier_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised ids of all customers, in the strict and the file variant."""
    customer = inputs.table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    raw = F.when(F.col("c_mktsegment") != "FURNITURE", F.concat(F.lit("00"), key, F.lit(".0")))
    return customer.select(
        "c_custkey",
        ids.normalize_cik(key).alias("cik"),
        ids.normalize_file_cik(raw).alias("file_cik"),
        ids.normalize_ticker(F.concat(F.lit(" t"), key, F.lit("\t"))).alias("ticker"),
        ids.stable_hash(F.col("c_name")).alias("name_hash"),
    )


@query
def firm_id_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical ids of customers and suppliers from their strongest identifier."""
    records = maps.prepare_records(inputs.customer_records(spark, sf_dir))
    suppliers = inputs.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit(" "), "s_name").alias("company_name"),
        F.col("s_suppkey").alias("registered_seq"),
    )
    named = maps.prepare_records(suppliers)
    return records.unionByName(named).select("registered_seq", "firm_id", "cik", "ticker")


@query
def mapping_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers registered once, and customers in debt once more under a new ticker."""
    records = inputs.customer_records(spark, sf_dir)
    again = inputs.customers_again(spark, sf_dir, records)
    mapping = maps.upsert_mapping(schemas.empty(spark, schemas.MAPPING), records)
    return maps.upsert_mapping(mapping, again)


@query
def resolve_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First firm with a given ticker."""
    return maps.resolve(inputs.cik_mapping(spark, sf_dir), "ticker", " machinery ")


@query
def bulk_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Firm of every order's customer; null where the mapping lacks it."""
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    mapping = inputs.cik_mapping(spark, sf_dir)
    return maps.resolve_column(orders, mapping, "o_custkey", "cik")


@query
def bulk_resolve_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Firm of every customer's segment: a lookup with few, hot keys."""
    customers = inputs.table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("segment")
    )
    mapping = inputs.cik_mapping(spark, sf_dir)
    return maps.resolve_column(customers, mapping, "segment", "ticker", "leader").drop("segment")


@query
def resolve_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of orders with a known firm."""
    return maps.resolution_rate(bulk_resolve(spark, sf_dir))


@query
def ticker_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory parsed from JSON: one object per customer, tickers repeat, last wins."""
    entry = F.struct(
        F.col("c_custkey").alias("cik_str"),
        F.concat(F.lower("c_mktsegment"), F.lit("-"), "c_nationkey").alias("ticker"),
        F.col("c_name").alias("title"),
    )
    documents = inputs.table(spark, sf_dir, "customer").select(
        F.to_json(F.create_map(F.lit("0"), entry)).alias("value"), F.col("c_custkey").alias("seq")
    )
    return scans.parse_directory(documents)


@query
def bootstrap_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping of universe firms found in the directory."""
    return maps.bootstrap_mapping(
        inputs.universe(spark, sf_dir), inputs.directory(spark, sf_dir)
    )


@query
def bootstrap_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Universe firms missing from the directory."""
    return maps.bootstrap_unmatched(
        inputs.universe(spark, sf_dir), inputs.directory(spark, sf_dir)
    )


@query
def mapping_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bootstrapped mapping saved, replaced by itself and loaded."""
    path = sinks.save_mapping(bootstrap_mapping(spark, sf_dir), scratch_path(spark, "mapping"))
    sinks.save_mapping(sinks.load_mapping(spark, path), path)
    return sinks.load_mapping(spark, path)


# -- filings -----------------------------------------------------------------------


@query
def filing_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filing histories of all customers, landed as JSON files and read back."""
    path = scratch_path(spark, "submissions")
    inputs.submissions(spark, sf_dir).write.partitionBy("shelf").text(path)
    return scans.filings_as_columns(scans.read_filing_history(spark, path))


@query
def raw_file_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed file per supplier, read as bytes and decoded."""
    path = scratch_path(spark, "raw")
    listing.write_files(inputs.supplier_files(spark, sf_dir), path)
    files = scans.read_raw_files(spark, path)
    return files.select(
        F.regexp_extract("path", "s_suppkey=([0-9]+)", 1).cast("bigint").alias("s_suppkey"),
        tx.collapse_whitespace(tx.bytes_to_text(F.col("content"))).alias("text"),
    )


@query
def bundled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of all pages whose raw bytes lie in a table bucketed by path."""
    name = f"bundles_{uuid.uuid4().hex}"
    sinks.write_bundles(inputs.page_files(spark, sf_dir), name, buckets=8)
    return filings.standardize(
        inputs.page_manifest(spark, sf_dir), spark.table(name), inputs.LANDING
    )


@query
def filings_transpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Struct-of-arrays histories of documents and conversations, one row per filing."""
    recent = inputs.lines_as_batches(
        inputs.texts(spark, sf_dir, "documents"), ["doc_id"], "source"
    )
    older = inputs.lines_as_batches(
        inputs.table(spark, sf_dir, "conversations"), ["conv_id", "turn"], "role"
    )
    return scans.transpose_filings(recent, "batch", ("cik",)).unionByName(
        scans.transpose_filings(older, "batch", ("cik",)), allowMissingColumns=True
    )


@query
def filings_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows of the wanted filings of firms in the universe."""
    wanted = filings.select_filings(
        inputs.order_filings(spark, sf_dir), start_year=_LOW, end_year=_HIGH
    )
    mapping = maps.bootstrap_mapping(
        inputs.universe(spark, sf_dir), inputs.directory(spark, sf_dir)
    )
    firms = filings.attach_firms(wanted, inputs.universe(spark, sf_dir), mapping)
    return filings.manifest_rows(firms, inputs.LANDING)


@query
def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows of a batch of all line items, given those shipped before 1998."""
    batch = inputs.line_manifest(spark, sf_dir)
    manifest = batch.where("filing_date < '1998-01-01'")
    return filings.new_rows(batch, manifest)


@query
def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same append as a stream over the landed table, run until caught up."""
    manifest_path = scratch_path(spark, "manifest")
    lines = inputs.table(spark, sf_dir, "lineitem")
    # As a glob, the path may be one file as well as a folder of files.
    stream = spark.readStream.schema(lines.schema).parquet(f"{sf_dir}/lineitem.parque[t]")
    store = ManifestStore(spark, manifest_path, buckets=8, expected_keys=lines.count())
    landing.append_stream_to_store(
        stream, store, scratch_path(spark, "checkpoint"), inputs.lines_as_manifest
    ).awaitTermination()
    return store.read()


@query
def landing_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed in several files and appended in as many micro-batches."""
    landed, manifest_path = scratch_path(spark, "landed"), scratch_path(spark, "manifest")
    rows = inputs.orders_as_manifest(spark, sf_dir)
    rows.repartition(3, F.col("accession_number")).write.parquet(landed)
    stream = (
        spark.readStream.schema(schemas.MANIFEST).option("maxFilesPerTrigger", 1).parquet(landed)
    )
    landing.append_stream(
        stream, manifest_path, scratch_path(spark, "checkpoint")
    ).awaitTermination()
    return scans.read_stage(spark, manifest_path, schemas.MANIFEST)


@query
def filing_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path, document id and inferred year of every line's filing."""
    rows = inputs.line_manifest(spark, sf_dir)
    cik, accession, document = (
        F.col(name) for name in ("cik", "accession_number", "primary_document")
    )
    return rows.select(
        filings.filing_path(inputs.LANDING, cik, accession, document).alias("path"),
        ids.document_id(cik, accession, document).alias("document_id"),
        filings.year_from_accession(accession).alias("accession_year"),
    )


@query
def year_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fiscal year of every page's filing through the fallback chain."""
    rows = inputs.page_manifest(spark, sf_dir)
    return rows.select(
        "accession_number",
        filings.fiscal_year(
            F.col("fiscal_year"), F.col("filing_date"), F.col("accession_number")
        ).alias("fiscal_year"),
    )


@query
def manifest_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest from file paths alone."""
    paths = inputs.page_files(spark, sf_dir).select("path")
    return filings.rebuild_manifest(paths, inputs.cik_mapping(spark, sf_dir))


@query
def standardized_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document records of all pages whose file is found."""
    return filings.standardize(
        inputs.page_manifest(spark, sf_dir), inputs.page_files(spark, sf_dir), inputs.LANDING
    )


@query
def features_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Firm-years straight from the raw files of all pages."""
    measured = filings.features_from_files(
        inputs.page_manifest(spark, sf_dir), inputs.page_files(spark, sf_dir), inputs.LANDING,
        inputs.KEYWORDS,
    )
    return features.firm_year_features(measured, inputs.PANEL_SOURCE)


# -- panel -------------------------------------------------------------------------


@query
def to_firm_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year of every order."""
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return features.with_year(orders, "o_orderdate").select("o_orderkey", "year")


@query
def prefix_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature columns with a prefix."""
    return features.prefix_columns(inputs.order_firm_years(spark, sf_dir), "shop")


def _tables(spark: SparkSession, sf_dir: str, null_firms: bool) -> dict[str, DataFrame]:
    return {
        "shop/orders": inputs.order_firm_years(spark, sf_dir, null_firms),
        "ship/lines": inputs.line_firm_years(spark, sf_dir, null_firms),
    }


@query
def panel_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel of three feature tables with one row per firm-year each."""
    tables = _tables(spark, sf_dir, null_firms=False)
    tables["part/sold"] = inputs.part_firm_years(spark, sf_dir)
    return panel.assemble_panel(
        spark, tables, min_year=_LOW, max_year=_HIGH, unique_keys=True
    )


@query
def panel_outer_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel in which rows without a firm match each other by year."""
    tables = _tables(spark, sf_dir, null_firms=True)
    return panel.assemble_panel(
        spark, tables, min_year=_LOW, max_year=_HIGH, unique_keys=True
    )


def _repeated(spark: SparkSession, sf_dir: str, hot_rows: int) -> DataFrame:
    lines = inputs.table(spark, sf_dir, "lineitem").select(
        ids.firm_id(cik=F.col("l_suppkey")).alias("firm_id"),
        F.year("l_shipdate").alias("year"),
        "l_orderkey",
        "l_linenumber",
    )
    orders = inputs.order_firm_years(spark, sf_dir).select("firm_id", "year", "orders")
    return panel.assemble_panel(
        spark, {"orders": orders, "lines": lines}, min_year=_LOW, max_year=_HIGH,
        hot_rows=hot_rows, keep_inputs=True,
    )


@query
def panel_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel of yearly orders and single line items: firm-years repeat on one side."""
    return _repeated(spark, sf_dir, HOT_ROWS)


@query
def panel_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL form of the panel; rows without a firm match nothing."""
    return panel.panel_sql(
        spark, _tables(spark, sf_dir, null_firms=True), min_year=_LOW, max_year=_HIGH,
        unique_keys=True,
    )


@query
def panel_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel with financial controls of each firm-year."""
    raw = inputs.controls(spark, sf_dir)
    loaded = raw.withColumn("cik", ids.normalize_file_cik(F.col("cik"))).withColumnRenamed(
        "fyear", "year"
    )
    return panel.add_controls(
        inputs.order_firm_years(spark, sf_dir), loaded, inputs.cik_mapping(spark, sf_dir)
    )


@query
def qc_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of a panel with repeated firm-years and missing firms."""
    orders = inputs.table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return quality.quality_report(
        orders.select(
            F.when(~urgent, ids.firm_id(cik=F.col("o_custkey"))).alias("firm_id"),
            F.year("o_orderdate").alias("year"),
        )
    )


@query
def qc_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overall result of a report with failing checks."""
    return quality.report_passed(qc_report(spark, sf_dir))


@query
def qc_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of each declared rule."""
    return quality.rule_violations(
        inputs.unchecked_features(spark, sf_dir), quality.feature_rules()
    )


# -- validation ----------------------------------------------------------------------


@query
def score_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and excerpt of every document."""
    return sampling.score_pool(inputs.documents(spark, sf_dir), inputs.KEYWORDS)


@query
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelling sample with everything known about it."""
    return sampling.sample_documents(inputs.documents(spark, sf_dir), inputs.KEYWORDS)


@query
def blind_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both files of the blind sample, written and read back side by side."""
    labeling, scores = scratch_path(spark, "labeling"), scratch_path(spark, "scores")
    sinks.write_blind_sample(stratified_sample(spark, sf_dir), labeling, scores)
    seen = scans.read_text_csv(spark, labeling).select("sample_id", "excerpt")
    hidden = scans.read_text_csv(spark, scores)
    return hidden.join(seen, "sample_id").select(
        "sample_id",
        "document_id",
        "firm_id",
        F.col("fiscal_year").cast("int").alias("fiscal_year"),
        F.col("ai_mention_count").cast("bigint").alias("ai_mention_count"),
        "density_bin",
        F.col("keyword_predicted").cast("int").alias("keyword_predicted"),
        "excerpt",
    )


@query
def blind_labeling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What labellers see of the sample."""
    return sampling.blind_labeling(stratified_sample(spark, sf_dir))


@query
def blind_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays hidden of the sample."""
    return sampling.blind_scores(stratified_sample(spark, sf_dir))


@query
def confusion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword prediction of all documents against the quality labels."""
    counted = features.document_features(inputs.documents(spark, sf_dir), inputs.KEYWORDS)
    scores = counted.select(
        ids.sample_id(F.col("document_id")).alias("sample_id"),
        F.col("has_ai_mention").cast("int").alias("keyword_predicted"),
    )
    labels = inputs.table(spark, sf_dir, "labels").select(
        ids.sample_id(F.col("doc_id")).alias("sample_id"),
        F.concat(F.lit(" "), "quality").alias("human_ai_mention"),
    )
    return metrics.validation_metrics(labels, scores)


# -- files and views -------------------------------------------------------------------


@query
def stage_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written as a stage with metadata, and read back with the row count."""
    path = scratch_path(spark, "features")
    metadata = scratch_path(spark, "stage_metadata")
    sinks.write_stage(
        firm_year_attention(spark, sf_dir), path, "features", inputs.PANEL_SOURCE, "attention",
        metadata, partition_by=["year"],
    )
    counted = scans.read_stage(spark, metadata, schemas.STAGE_METADATA).select(
        "source", "stage", "signal_layer", "row_count", "config_hash",
        (F.col("path") == path).alias("path_kept"), F.col("created_at").isNotNull().alias("dated"),
    )
    stored = scans.read_stage(spark, path, schemas.ATTENTION_FIRM_YEAR)
    return stored.join(counted, "source").select(*stored.columns, *counted.columns[1:])


@query
def universe_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Universe CSV of all customers in order; those in debt are commented out."""
    customer = inputs.table(spark, sf_dir, "customer")
    mark = F.when(F.col("c_acctbal") < 0, "# ").otherwise("")
    path = scratch_path(spark, "universe")
    customer.orderBy("c_custkey").coalesce(1).select(
        F.concat(mark, F.lit("T"), "c_custkey").alias("ticker"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("sector"),
    ).write.option("header", True).option("comment", "~").csv(path)
    return scans.read_universe(spark, path)


@query
def controls_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Controls CSV of all customers, loaded and checked."""
    path = scratch_path(spark, "controls")
    inputs.controls(spark, sf_dir).write.option("header", True).csv(path)
    return scans.read_controls(spark, path)


@query
def panel_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel saved as Parquet and CSV; the CSV read back."""
    path = scratch_path(spark, "panel")
    sinks.save_panel(panel_outer_nullsafe(spark, sf_dir), path, ["parquet", "csv"])
    kinds = scans.read_stage(spark, path).dtypes
    text = scans.read_text_csv(spark, f"{path}.csv")
    return text.select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds])


@query
def panel_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel saved as a catalogue table and read by name."""
    path = scratch_path(spark, "panel")
    sinks.save_panel(panel_outer_nullsafe(spark, sf_dir), path, ["table"])
    return spark.table(sinks.PANEL_TABLE)


@query
def sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameterised SQL over a view of Parquet files and a view of a frame."""
    views.register_parquet(spark, f"{sf_dir}/line*.parquet", "panelloom_lines")
    views.register_frame(inputs.table(spark, sf_dir, "orders"), "panelloom_orders")
    return views.query(
        spark,
        """
        SELECT o_orderstatus, count(*) AS lines, sum(l_quantity) AS quantity
        FROM panelloom_lines JOIN panelloom_orders ON l_orderkey = o_orderkey
        WHERE l_quantity < ? AND l_returnflag <> ?
        GROUP BY o_orderstatus
        """,
        [25.0, "N"],
    )


# -- incremental tables ------------------------------------------------------------------


def _early_lines(spark: SparkSession, sf_dir: str) -> tuple[ManifestStore, DataFrame]:
    """A store of the line items shipped before 1998, and a batch of all line items."""
    batch = inputs.line_manifest(spark, sf_dir)
    lines = inputs.table(spark, sf_dir, "lineitem").count()
    path = scratch_path(spark, "manifest-store")
    store = ManifestStore(spark, path, buckets=16, expected_keys=lines)
    store.append(batch.where("filing_date < '1998-01-01'"))
    return store, batch


@query
def manifest_store_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows of a batch of all line items, given a store of those shipped before 1998."""
    store, batch = _early_lines(spark, sf_dir)
    return store.append(batch).fresh


@query
def manifest_store_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that all line items add to those shipped before 1998, that a replay adds, and of all."""
    store, batch = _early_lines(spark, sf_dir)
    counted = lambda df, step: df.agg(F.lit(step).alias("step"), F.count("*").alias("rows"))
    added = [counted(store.append(batch).fresh, step) for step in ("all", "replay")]
    return added[0].unionByName(added[1]).unionByName(counted(store.read(), "stored"))


@query
def mapping_store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``mapping_upsert``, in a store whose untouched buckets stay as they are."""
    records = inputs.customer_records(spark, sf_dir)
    store = MappingStore(spark, scratch_path(spark, "mapping-store"), buckets=8)
    store.upsert(records)
    store.upsert(inputs.customers_again(spark, sf_dir, records))
    return store.read()


@query
def firm_year_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Firm-years added up from a stream of document batches, one of them replayed."""
    landed = scratch_path(spark, "documents")
    documents = inputs.documents(spark, sf_dir)
    files = inputs.files_per_batch(spark, sf_dir, "documents", batches=3)
    documents.repartition(3 * files, "document_id").write.parquet(landed)
    stream = (
        spark.readStream.schema(documents.schema)
        .option("maxFilesPerTrigger", files)
        .parquet(landed)
    )
    store = rollup.FirmYearStore(spark, scratch_path(spark, "firm-years"), fold_after=1)
    checkpoint = scratch_path(spark, "checkpoint")
    rollup.roll_up_stream(stream, store, checkpoint, inputs.KEYWORDS).awaitTermination()
    replayed = features.document_features(spark.read.parquet(landed), inputs.KEYWORDS)
    store.add(replayed, 0)
    return store.read(inputs.PANEL_SOURCE)


@query
def listed_raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages landed as files, listed and read by the executors and bundled."""
    root = scratch_path(spark, "raw")
    listing.write_files(inputs.page_files(spark, sf_dir), root)
    files = listing.list_files(spark, root)
    bundles = f"bundles_{uuid.uuid4().hex}"
    for _ in range(2):  # the second time nothing is left to add
        stages.bundle_files(spark, root, bundles, buckets=8)
    tail = lambda path: F.regexp_extract(path, "/raw-[0-9a-f]{32}(/.*)$", 1)
    lengths = files.select(tail("path").alias("path"), "length")
    contents = spark.table(bundles).select(
        tail("path").alias("path"), F.sha2("content", 256).alias("content_sha256")
    )
    return contents.join(lengths, "path")


@query
def documents_from_landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed as files, bundled and standardised by a manifest kept in a store."""
    root, documents = scratch_path(spark, "raw"), scratch_path(spark, "documents")
    landed = F.regexp_extract("path", "^/landing(/.*)$", 1)
    files = inputs.page_files(spark, sf_dir).where(F.col("path").startswith(inputs.LANDING))
    listing.write_files(files.select(landed.alias("path"), "content"), root)
    bundles = f"bundles_{uuid.uuid4().hex}"
    stages.bundle_files(spark, root, bundles, buckets=8)
    store = ManifestStore(spark, scratch_path(spark, "manifest-store"), buckets=8)
    store.append(inputs.page_manifest(spark, sf_dir))
    stages.standardize_bundles(
        spark, store.read(), bundles, root, documents, scratch_path(spark, "metadata")
    )
    return scans.read_stage(spark, documents, schemas.DOCUMENTS).drop("raw_path")


@query
def filing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories whose filings before 1996 lie in shards, landed as JSON and read back."""
    recent, shards = scratch_path(spark, "recent"), scratch_path(spark, "shards")
    filed = inputs.order_filings(spark, sf_dir)
    older = F.col("filing_date") < "1996-01-01"
    inputs.histories(filed.where(~older)).write.partitionBy("shelf").text(recent)
    listing.write_files(inputs.shard_files(filed.where(older)), shards)
    history = scans.filings_as_columns(scans.read_filing_history(spark, recent, shards))
    return history.withColumn("cik", ids.unpadded_cik(F.col("cik")))


# -- absent and empty inputs, hot keys ---------------------------------------------------


@query
def features_of_missing_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of a documents stage that was never written, beside those of all documents."""
    missing = scans.read_stage_if_exists(
        spark, scratch_path(spark, "never-written"), schemas.DOCUMENTS
    )
    none = features.attention_firm_year(missing, inputs.KEYWORDS, inputs.PANEL_SOURCE)
    return none.unionByName(firm_year_attention(spark, sf_dir))


@query
def panel_without_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Firm-years of a panel without any table, beside those of all orders."""
    absent = scans.read_stage_if_filled(spark, scratch_path(spark, "never-written"))
    none = panel.assemble_panel(spark, {"shop/orders": absent})
    return none.unionByName(inputs.order_firm_years(spark, sf_dir).select("firm_id", "year"))


@query
def panel_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel built between paths: two stored feature tables and one that is missing."""
    paths = {name: scratch_path(spark, "stage") for name in ("shop/orders", "none", "ship/lines")}
    for name, table in _tables(spark, sf_dir, null_firms=True).items():
        table.write.parquet(paths[name])
    output = scratch_path(spark, "panel")
    stages.build_panel(spark, paths, output, min_year=_LOW, max_year=_HIGH)
    return scans.read_stage(spark, output)


@query
def panel_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``panel_repeated_keys``, with firm-years of 20 rows counted as hot and cut in slices."""
    return _repeated(spark, sf_dir, hot_rows=20)


@query
def panel_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel of eight feature tables in one shuffle: orders by status and priority."""
    orders = inputs.table(spark, sf_dir, "orders")
    tables = {}
    for i, column in enumerate(["o_orderstatus"] * 3 + ["o_orderpriority"] * 5):
        value = ("F", "O", "P", "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")[i]
        rows = orders.where(F.col(column) == value)
        tables[f"t{i}"] = inputs.firm_years_of(rows)
    return panel.assemble_panel(spark, tables, unique_keys=True)
