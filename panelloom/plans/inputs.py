"""Views of the shared tables in the shapes the operators expect.

The tables have no filings in them. Customers and suppliers play firms, orders and
line items play filings, documents and pages play their texts. Every view covers
its whole table.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.functions import identifiers as ids
from panelloom.operators import mapping as maps
from panelloom.session import scan_tasks

# The default keywords are absent from the shared documents.
KEYWORDS = ("that", "with", "the of", "in the")
PANEL_YEARS = (1996, 2000)
PANEL_SOURCE = "documents"
LANDING = "/landing"
FILE_BYTES = 64 << 20  # of a landed file of texts, as stored
FOLDER_FILES = 1000  # small files in one folder, so that few folders are listed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One shared table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One shared table of long texts. Each is one file with one row group, so one task; a
    caller that wants more of them sets ``spark.panelloom.scanTasks`` (the benchmark does)."""
    tasks = scan_tasks(spark)
    rows = table(spark, sf_dir, name)
    return rows.repartition(tasks) if tasks else rows


def files_per_batch(spark: SparkSession, sf_dir: str, name: str, batches: int) -> int:
    """Files that each of so many batches of a table should land in, by the table's bytes."""
    sizes = table(spark, sf_dir, name).select("_metadata.file_path", "_metadata.file_size")
    total = sizes.distinct().agg(F.sum("file_size")).first()[0] or 0
    return max(1, ceil(total / (batches * FILE_BYTES)))


def pad(number: Column | str, width: int) -> Column:
    """Zero-padded number that is never cut."""
    digits = (F.col(number) if isinstance(number, str) else number).cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: the firm is the source, years cycle with the id."""
    return texts(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("document_id"),
        ids.firm_id(ticker=F.col("source")).alias("firm_id"),
        F.upper("source").alias("ticker"),
        F.col("lang").alias("form_type"),
        (F.lit(2015) + F.col("doc_id") % 12).cast("int").alias("fiscal_year"),
        "text",
    )


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as identifier records; the strongest identifier differs by segment."""
    segment = F.col("c_mktsegment")

    def only(name: str, value: Column) -> Column:
        return F.when(segment == name, value)

    return table(spark, sf_dir, "customer").select(
        F.lit("").alias("firm_id"),
        only("MACHINERY", F.concat(F.lit(" G"), "c_nationkey")).alias("gvkey"),
        F.when(segment.isin("AUTOMOBILE", "BUILDING"), F.col("c_custkey").cast("string")).alias(
            "cik"
        ),
        F.when(segment != "FURNITURE", F.concat(F.lit(" t"), "c_custkey")).alias("ticker"),
        only("FURNITURE", F.concat(F.lit("C"), "c_custkey")).alias("cusip"),
        only("HOUSEHOLD", F.col("c_custkey").cast("int")).alias("permno"),
        F.col("c_name").alias("company_name"),
        F.lit("customer").alias("source"),
        F.col("c_custkey").alias("registered_seq"),
    )


def customers_again(spark: SparkSession, sf_dir: str, records: DataFrame) -> DataFrame:
    """The records of customers in debt once more, later and under a new ticker."""
    in_debt = table(spark, sf_dir, "customer").where("c_acctbal < 0")
    return records.join(
        in_debt.select(F.col("c_custkey").alias("registered_seq")), "registered_seq", "left_semi"
    ).withColumns(
        {
            "ticker": F.concat(F.lit("new"), "registered_seq"),
            "registered_seq": F.col("registered_seq") + 1_000_000_000_000,
        }
    )


def cik_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping of all customers in credit, keyed by cik; the segment is the ticker."""
    records = table(spark, sf_dir, "customer").where("c_acctbal >= 0").select(
        F.col("c_custkey").cast("string").alias("cik"),
        F.col("c_mktsegment").alias("ticker"),
        F.col("c_name").alias("company_name"),
        F.lit("customer").alias("source"),
        F.col("c_custkey").alias("registered_seq"),
    )
    return maps.latest_per_firm(maps.prepare_records(records))


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Universe of all customers."""
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("t"), "c_custkey").alias("ticker"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("sector"),
        F.col("c_custkey").alias("registered_seq"),
    )


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker directory of all suppliers."""
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("T"), "s_suppkey").alias("ticker"),
        ids.normalize_cik(F.col("s_suppkey")).alias("cik"),
        F.col("s_name").alias("title"),
    )


def order_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as filings of their customer; some lack a date or a document."""
    key = F.col("o_orderkey")
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    form = (
        F.when(F.col("o_orderstatus") == "F", "10-K")
        .when(F.col("o_orderstatus") == "O", "10-Q")
        .otherwise("10-K/A")
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("cik"),
        F.concat(
            pad("o_custkey", 10), F.lit("-"), F.date_format("o_orderdate", "yy"), F.lit("-"),
            pad(key, 6),
        ).alias("accession_number"),
        form.alias("form_type"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "").otherwise(date).alias(
            "filing_date"
        ),
        F.when(F.col("o_totalprice") < 50000, "")
        .otherwise(F.concat(F.lit("order-"), key, F.lit(".htm")))
        .alias("primary_document"),
    )


def orders_as_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as manifest rows, each under a key of its own."""
    rows = order_filings(spark, sf_dir)
    return rows.select(
        ids.firm_id(cik=F.col("cik")).alias("firm_id"),
        F.lit("T").alias("ticker"),
        ids.normalize_cik(F.col("cik")).alias("cik"),
        "accession_number",
        "form_type",
        "filing_date",
        F.lit(0).alias("fiscal_year"),
        "primary_document",
        F.concat(F.lit("order/"), "accession_number").alias("raw_path"),
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filing histories as JSON text, one array of 100 customers' objects per shelf."""
    return histories(order_filings(spark, sf_dir))


def _history_lists(filed: DataFrame) -> tuple[DataFrame, Column]:
    """Filings per cik (column ``rows``), and the struct of arrays made of them."""
    named = filed.withColumnsRenamed(
        {"accession_number": "accessionNumber", "form_type": "form",
         "filing_date": "filingDate", "primary_document": "primaryDocument"}
    )
    names = ("accessionNumber", "form", "filingDate", "primaryDocument")
    recent = named.groupBy("cik").agg(F.collect_list(F.struct(*names)).alias("rows"))
    return recent, F.struct(*[F.col(f"rows.{n}").alias(n) for n in names])


def histories(filed: DataFrame) -> DataFrame:
    """Filings as JSON text, one array of the objects of 100 ciks per shelf."""
    recent, lists = _history_lists(filed)
    objects = recent.select(
        F.floor(F.col("cik").cast("bigint") / 100).alias("shelf"),
        F.struct("cik", F.struct(lists.alias("recent")).alias("filings")).alias("one"),
    )
    packed = objects.groupBy("shelf").agg(F.collect_list("one").alias("all"))
    return packed.select(F.to_json("all").alias("value"), "shelf")


def shard_files(filed: DataFrame) -> DataFrame:
    """Older filings as one JSON file per cik, which is in the file's name only."""
    recent, lists = _history_lists(filed)
    folder = F.floor(F.col("cik").cast("bigint") / FOLDER_FILES).cast("string")
    name = F.concat(folder, F.lit("/CIK"), pad("cik", 10), F.lit("-submissions-001.json"))
    return recent.select(name.alias("path"), F.encode(F.to_json(lists), "UTF-8").alias("content"))


def supplier_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as one text file per key, which is in the file's name only; one name a line."""
    rows = table(spark, sf_dir, "supplier").select("s_name", "s_suppkey")
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    lines = F.concat(F.coalesce("s_name", F.lit("")), F.lit("\n"))
    packed = rows.groupBy("s_suppkey").agg(
        F.array_sort(F.collect_list(F.struct("_at", lines.alias("line")))).alias("_lines")
    )
    key = F.coalesce(F.col("s_suppkey").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    folder = F.coalesce(F.floor(F.col("s_suppkey") / FOLDER_FILES).cast("string"), F.lit("none"))
    return packed.select(
        F.concat(folder, F.lit("/s_suppkey="), key, F.lit(".txt")).alias("path"),
        F.encode(F.array_join("_lines.line", ""), "UTF-8").alias("content"),
    )


def lines_as_manifest(lines: DataFrame) -> DataFrame:
    """Line items as manifest rows; the lines of one order and supplier share a key."""
    cik = ids.normalize_cik(F.col("l_suppkey"))
    order = F.col("l_orderkey")
    accession = F.concat_ws("-", pad("l_suppkey", 10), pad(order % 100, 2), pad(order, 6))
    return lines.select(
        ids.firm_id(cik=F.col("l_suppkey")).alias("firm_id"),
        F.concat(F.lit("T"), cik).alias("ticker"),
        cik.alias("cik"),
        accession.alias("accession_number"),
        F.col("l_returnflag").alias("form_type"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("filing_date"),
        F.year("l_shipdate").alias("fiscal_year"),
        F.concat(F.lit("line-"), "l_linenumber", F.lit(".htm")).alias("primary_document"),
        F.concat(F.lit("part/"), "l_partkey").alias("raw_path"),
    )


def line_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items as manifest rows."""
    return lines_as_manifest(table(spark, sf_dir, "lineitem"))


def page_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as manifest rows; year and date are missing for some."""
    page = F.col("page_id")
    year = (F.lit(2015) + page % 7).cast("int")
    url = F.col("url")
    return texts(spark, sf_dir, "pages").select(
        ids.firm_id(cik=page).alias("firm_id"),
        F.concat(F.lit("P"), page).alias("ticker"),
        page.cast("string").alias("cik"),
        F.concat(pad(page, 10), F.lit("-"), pad(page % 97, 2), F.lit("-000001")).alias(
            "accession_number"
        ),
        F.lit("10-K").alias("form_type"),
        F.when(url.contains("www"), "")
        .when(url.contains("blog"), "n/a")
        .otherwise(F.concat(year.cast("string"), F.lit("-06-30")))
        .alias("filing_date"),
        F.when(url.startswith("https"), 0).when(url.contains("m."), year).alias("fiscal_year"),
        F.concat(F.lit("p"), page, F.when(url.endswith(".html"), ".html").otherwise(".txt")).alias(
            "primary_document"
        ),
        F.concat(F.lit("/archive/"), page).alias("raw_path"),
    )


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files of the pages: some at the computed path, some at the stored one, some gone."""
    page, url = F.col("page_id"), F.col("url")
    document = F.concat(
        F.lit("p"), page, F.when(url.endswith(".html"), ".html").otherwise(".txt")
    )
    folder = F.concat(pad(page, 10), pad(page % 97, 2), F.lit("000001"))
    landed = F.concat_ws("/", F.lit(LANDING), page.cast("string"), folder, document)
    stored = F.concat(F.lit("/archive/"), page)
    return texts(spark, sf_dir, "pages").select(
        F.when(url.contains("/en/"), landed)
        .when(url.contains("/es/"), F.concat(F.lit("/lost/"), page))
        .otherwise(stored)
        .alias("path"),
        F.encode("html", "UTF-8").alias("content"),
    )


def order_firm_years(
    spark: SparkSession, sf_dir: str, null_firms: bool = False
) -> DataFrame:
    """Feature table of orders per customer and year; one row per firm-year."""
    orders = table(spark, sf_dir, "orders")
    cik = F.col("o_custkey")
    if null_firms:
        cik = F.when(F.col("o_orderstatus") != "P", cik)
    return (
        orders.groupBy(cik.alias("_cik"), F.year("o_orderdate").alias("year"))
        .agg(
            F.count("*").alias("orders"),
            F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
        )
        .select(
            ids.firm_id(cik=F.col("_cik"), on_missing="null").alias("firm_id"),
            "year",
            F.lit("orders").alias("source"),
            "orders",
            "cents",
        )
    )


def firm_years_of(orders: DataFrame) -> DataFrame:
    """Number of orders per customer and year."""
    counted = orders.groupBy("o_custkey", F.year("o_orderdate").alias("year"))
    return counted.agg(F.count("*").alias("orders")).select(
        ids.firm_id(cik=F.col("o_custkey")).alias("firm_id"), "year", "orders"
    )


def line_firm_years(
    spark: SparkSession, sf_dir: str, null_firms: bool = False
) -> DataFrame:
    """Feature table of line items per supplier and year; one row per firm-year."""
    lines = table(spark, sf_dir, "lineitem")
    cik = F.col("l_suppkey")
    if null_firms:
        cik = F.when(F.col("l_returnflag") != "R", cik)
    return (
        lines.groupBy(cik.alias("_cik"), F.year("l_shipdate").alias("year"))
        .agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
        .select(
            ids.firm_id(cik=F.col("_cik"), on_missing="null").alias("firm_id"),
            "year",
            F.lit("lines").alias("source"),
            "lines",
            "quantity",
        )
    )


def part_firm_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table of line items per part and commit year, a third panel input."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("_cik"), F.year("l_shipdate").alias("year"))
        .agg(F.count("*").alias("sold"))
        .select(ids.firm_id(cik=F.col("_cik")).alias("firm_id"), "year", "sold")
    )


def controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly controls of all customers, as in the file before loading."""
    years = F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("fyear")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("00"), "c_custkey").alias("gvkey"),
        F.concat("c_custkey", F.lit(".0")).alias("cik"),
        years,
        F.col("c_acctbal").alias("at"),
        (F.col("c_acctbal") / 100).alias("roa"),
        F.col("c_nationkey").alias("sic"),
        F.col("c_custkey").cast("double").alias("emp"),
        F.col("c_name").alias("conm"),
        F.col("c_mktsegment").alias("tic"),
    )


def unchecked_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as attention features that break some of the declared rules."""
    low = F.col("o_orderpriority") == "5-LOW"
    return table(spark, sf_dir, "orders").select(
        F.when(low, F.concat(F.lit("X-"), "o_custkey"))
        .when(F.col("o_orderpriority") != "1-URGENT", F.concat(F.lit("OAA-"), "o_custkey"))
        .alias("firm_id"),
        (F.year("o_orderdate") - 10).alias("year"),
        F.when(F.col("o_orderstatus") != "P", "orders").alias("source"),
        (F.col("o_custkey") - 100).alias("document_count"),
        F.col("o_custkey").alias("ai_mention_count"),
        (F.col("o_totalprice") / 300000).alias("ai_mention_share"),
        F.when(low, F.col("o_orderkey") - 500).alias("total_tokens"),
        F.col("o_orderkey").alias("ai_token_count"),
    )


def lines_as_batches(df: DataFrame, key: Sequence[str], form: str) -> DataFrame:
    """Each text's lines as one struct of arrays, the layout of a filing history."""
    lines = F.split("text", "\n")
    prefix = F.concat_ws("-", *[F.col(name).cast("string") for name in key])
    numbers = F.transform(lines, lambda _, i: F.concat(prefix, F.lit("-"), i))
    return df.select(
        prefix.alias("cik"),
        F.struct(
            numbers.alias("accessionNumber"),
            F.transform(lines, lambda _: F.col(form)).alias("form"),
            lines.alias("primaryDocument"),
        ).alias("batch"),
    )
