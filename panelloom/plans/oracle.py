"""SQL twins of the catalogue, for DuckDB over the same Parquet tables.

They state each query's meaning independently of the Spark code: other regex
dialect, window functions instead of aggregates, one statement per query.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# -- fragments -----------------------------------------------------------------

_SPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
_KEYWORDS = ("that", "with", "the of", "in the")


def _collapse(text: str) -> str:
    return f"trim(regexp_replace({text}, '[{_SPACE}]+', ' ', 'g'))"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')"


def _unescape(text: str) -> str:
    # All of these names also count without their semicolon.
    entities = {
        "lt": "<", "gt": ">", "quot": '"', "copy": "©", "reg": "®", "middot": "·", "nbsp": " ",
        "amp": "&",
    }
    for entity, char in entities.items():
        text = f"regexp_replace({text}, '&{entity};?', '{char}', 'g')"
    return text


def _html(markup: str) -> str:
    elements = "".join(
        rf"|<{tag}\b[^>]*>.*?(?:</{tag}\s*>|\z)" for tag in ("script", "style", "noscript")
    )
    pattern = rf"(?is)<!--.*?(?:-->|\z){elements}|<[!?/a-z][^>]*>"
    return _collapse(_unescape(_unescape(f"regexp_replace({markup}, '{pattern}', ' ', 'g')")))


def _fast(markup: str) -> str:
    return _collapse(_unescape(f"regexp_replace({markup}, '<[^>]+>', ' ', 'g')"))


def _routed(raw: str) -> str:
    is_html = rf"regexp_matches({raw}, '(?i)<(?:html|body|div)')"
    return f"CASE WHEN {is_html} THEN {_html(raw)} ELSE {_fast(raw)} END"


# Whole words are fenced with U+0001, since \b knows ASCII words only.
_FENCED = r"regexp_replace(text, '([\p{L}\p{N}_]+)', chr(1) || '\1' || chr(1), 'g')"
_ALTERNATIVES = "|".join(kw.replace(" ", "\x01 \x01") for kw in _KEYWORDS)
_PATTERN = f"(?i)\x01(?:{_ALTERNATIVES})\x01".replace("\x01", r"\x01")
_HITS = f"regexp_extract_all({_FENCED}, '{_PATTERN}')"

_FIRM = "'OAA-' || substr(sha256({seed}), 1, 12)"


def _firm(kind: str, value: str) -> str:
    return _FIRM.format(seed=f"'{kind}:' || {value}")


def _pad(number: str, width: int = 10) -> str:
    return f"printf('%0{width}d', {number})"


def _cik_firm(number: str) -> str:
    return _firm("cik", _pad(number))


_DOCS = f"""docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS document_id,
         {_firm('ticker', 'upper(source)')} AS firm_id,
         upper(source) AS ticker, lang AS form_type,
         CAST(2015 + doc_id % 12 AS INTEGER) AS fiscal_year, text
  FROM documents),
counted AS (
  SELECT *, len(hits) AS ai_mention_count, len(hits) AS ai_token_count,
         len(regexp_extract_all(text, '[^{_SPACE}]+')) AS total_tokens
  FROM (SELECT *, {_HITS} AS hits FROM docs))"""

_FIRM_YEARS = """firm_years AS (
  SELECT firm_id, fiscal_year AS year, count(document_id) AS document_count,
         CAST(sum(ai_mention_count) AS BIGINT) AS ai_mention_count,
         CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
         CAST(sum(ai_token_count) AS BIGINT) AS ai_token_count,
         count(*) FILTER (ai_mention_count > 0) / greatest(count(document_id), 1)
           AS ai_mention_share,
         'documents' AS source
  FROM counted GROUP BY ALL)"""

_BIN = """CASE WHEN ai_mention_count = 0 THEN 'zero' WHEN ai_mention_count <= 5 THEN 'low'
  WHEN ai_mention_count <= 20 THEN 'medium' ELSE 'high' END"""

# -- text and features ---------------------------------------------------------

ORACLE["firm_year_attention"] = f"WITH {_DOCS}, {_FIRM_YEARS} SELECT * FROM firm_years"

ORACLE["doc_keyword_features"] = f"""WITH {_DOCS}
SELECT document_id, firm_id, fiscal_year AS year, ai_mention_count, total_tokens, ai_token_count,
       ai_mention_count > 0 AS has_ai_mention,
       array_to_string(list_sort(list_distinct(list_transform(
         hits, lambda hit: lower(replace(hit, chr(1), ''))))), '|') AS matched_keywords
FROM counted"""

ORACLE["no_keywords"] = f"""WITH {_DOCS}
SELECT firm_id, fiscal_year AS year, count(*) AS document_count,
       CAST(0 AS BIGINT) AS ai_mention_count, CAST(0 AS BIGINT) AS total_tokens,
       CAST(0 AS BIGINT) AS ai_token_count, CAST(0 AS DOUBLE) AS ai_mention_share,
       'documents' AS source
FROM docs GROUP BY ALL"""

ORACLE["placebo_by_year"] = f"""WITH {_DOCS}, {_FIRM_YEARS}
SELECT year, CAST(sum(ai_mention_count) AS BIGINT) AS total_mentions,
       avg(ai_mention_count) AS mean_mentions,
       avg(CASE WHEN ai_mention_count > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
         AS share_with_mention
FROM firm_years GROUP BY year"""

ORACLE["html_to_text"] = f"SELECT page_id, {_html('html')} AS text FROM pages"

ORACLE["fast_strip"] = f"SELECT page_id, {_fast('html')} AS text FROM pages"

ORACLE["filing_text"] = f"""WITH files AS (
  SELECT 'page-' || page_id AS file, html AS raw FROM pages
  UNION ALL SELECT 'document-' || doc_id, text FROM documents)
SELECT file, {_routed('raw')} AS text FROM files"""

ORACLE["latin1_text"] = r"""
SELECT page_id, regexp_replace(html, '[^\x{0}-\x{ff}]', '?', 'g') AS text FROM pages"""

# NFKC leaves these documents as they are and DuckDB has no NFKC function.
ORACLE["preprocess_wide_text"] = (
    f"SELECT doc_id, {_collapse('text')} AS text FROM documents"
)

ORACLE["preprocess_text"] = f"SELECT doc_id, {_collapse('text')} AS text FROM documents"

ORACLE["density_bins"] = f"""WITH {_DOCS}
SELECT fiscal_year, {_BIN} AS density_bin, count(*) AS documents,
       CAST(sum(ai_mention_count) AS BIGINT) AS mentions
FROM counted GROUP BY ALL"""

ORACLE["head_excerpts"] = f"""WITH {_DOCS}
SELECT document_id,
       CASE WHEN length(t) <= 500 THEN t ELSE substr(t, 1, 500) || '...' END AS excerpt
FROM (SELECT document_id, {_strip('text')} AS t FROM docs)"""

_ANYWHERE = "(?i)" + "|".join(_KEYWORDS)
_EXCERPTS = f"""bodies AS (
  SELECT document_id, t, length(string_split_regex(t, '{_ANYWHERE}')[1]) AS before,
         length(regexp_extract(t, '{_ANYWHERE}')) AS hit
  FROM (SELECT document_id, {_strip('text')} AS t FROM docs)),
windows AS (
  SELECT *, greatest(before + hit // 2 - 250, 0) AS start FROM bodies),
excerpts AS (
  SELECT document_id,
         CASE WHEN length(t) <= 500 THEN t
              WHEN hit = 0 THEN substr(t, 1, 500) || '...'
              ELSE (CASE WHEN start > 0 THEN '...' ELSE '' END)
                || substr(t, start + 1, least(start + 500, length(t)) - start)
                || (CASE WHEN start + 500 < length(t) THEN '...' ELSE '' END) END AS excerpt
  FROM windows)"""

ORACLE["keyword_excerpts"] = f"WITH {_DOCS}, {_EXCERPTS} SELECT * FROM excerpts"

# -- identifiers -----------------------------------------------------------------

ORACLE["identifier_forms"] = f"""
SELECT c_custkey, {_pad('c_custkey')} AS cik,
       CASE WHEN c_mktsegment <> 'FURNITURE' THEN {_pad('c_custkey')} ELSE '' END AS file_cik,
       'T' || c_custkey AS ticker, substr(sha256(c_name), 1, 16) AS name_hash
FROM customer"""

_RECORDS = f"""records AS (
  SELECT c_custkey AS registered_seq, c_mktsegment AS segment, c_acctbal,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN ' G' || c_nationkey END AS gvkey,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN {_pad('c_custkey')} END AS cik,
         CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'T' || c_custkey END AS ticker,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN 'C' || c_custkey END AS cusip,
         CAST(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_custkey END AS INTEGER) AS permno,
         c_name AS company_name, 'customer' AS source
  FROM customer),
identified AS (
  SELECT *, {_FIRM.format(seed='''coalesce('gvkey:' || trim(gvkey), 'cik:' || cik,
    'cusip:' || cusip, 'permno:' || permno, 'ticker:' || ticker)''')} AS firm_id
  FROM records)"""

ORACLE["firm_id_assignment"] = f"""WITH {_RECORDS}
SELECT registered_seq, firm_id, cik, ticker FROM identified
UNION ALL
SELECT s_suppkey, {_firm('name', 'upper(trim(s_name))')}, NULL, NULL FROM supplier"""

ORACLE["mapping_upsert"] = f"""WITH {_RECORDS}, both_times AS (
  SELECT * FROM identified
  UNION ALL BY NAME
  SELECT * REPLACE (registered_seq + 1000000000000 AS registered_seq,
                    'NEW' || registered_seq AS ticker,
                    CASE WHEN gvkey IS NULL AND cik IS NULL AND cusip IS NULL AND permno IS NULL
                         THEN {_firm('ticker', "'NEW' || registered_seq")}
                         ELSE firm_id END AS firm_id)
  FROM identified WHERE c_acctbal < 0)
SELECT firm_id, gvkey, cik, ticker, cusip, permno, company_name, source, registered_seq
FROM both_times
QUALIFY row_number() OVER (PARTITION BY firm_id ORDER BY registered_seq DESC) = 1"""

_MAPPING = f"""mapping AS (
  SELECT {_cik_firm('c_custkey')} AS firm_id, {_pad('c_custkey')} AS cik,
         c_mktsegment AS ticker, c_custkey AS seq
  FROM customer WHERE c_acctbal >= 0)"""

ORACLE["resolve_one"] = f"""WITH {_MAPPING}
SELECT arg_min(firm_id, seq) AS firm_id FROM mapping WHERE ticker = 'MACHINERY'"""

_RESOLVED = f"""resolved AS (
  SELECT o_orderkey, o_custkey, firm_id
  FROM orders LEFT JOIN mapping ON mapping.cik = {_pad('o_custkey')})"""

ORACLE["bulk_resolve"] = f"WITH {_MAPPING}, {_RESOLVED} SELECT * FROM resolved"

ORACLE["bulk_resolve_ticker"] = f"""WITH {_MAPPING}, leaders AS (
  SELECT ticker, arg_min(firm_id, seq) AS leader FROM mapping GROUP BY ticker)
SELECT c_custkey, leader FROM customer LEFT JOIN leaders ON ticker = c_mktsegment"""

ORACLE["resolve_rate"] = f"""WITH {_MAPPING}, {_RESOLVED}
SELECT count(firm_id) AS resolved, count(*) AS total, count(firm_id) / count(*) AS rate
FROM resolved"""

ORACLE["ticker_directory"] = f"""
SELECT c_mktsegment || '-' || c_nationkey AS ticker, {_pad('c_custkey')} AS cik, c_name AS title
FROM customer
QUALIFY row_number() OVER (
  PARTITION BY c_mktsegment, c_nationkey ORDER BY c_custkey DESC) = 1"""

_BOOT = f"""boot AS (
  SELECT {_cik_firm('s_suppkey')} AS firm_id, CAST(NULL AS VARCHAR) AS gvkey,
         {_pad('s_suppkey')} AS cik, 'T' || c_custkey AS ticker, CAST(NULL AS VARCHAR) AS cusip,
         CAST(NULL AS INTEGER) AS permno, c_name AS company_name,
         'sec_company_tickers' AS source, c_custkey AS registered_seq
  FROM customer JOIN supplier ON 'T' || s_suppkey = 'T' || c_custkey)"""

ORACLE["bootstrap_mapping"] = f"WITH {_BOOT} SELECT * FROM boot"

ORACLE["mapping_saved"] = ORACLE["bootstrap_mapping"]

ORACLE["bootstrap_unmatched"] = """
SELECT 't' || c_custkey AS ticker, c_name AS company_name, c_mktsegment AS sector,
       c_custkey AS registered_seq
FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)"""

# -- filings -----------------------------------------------------------------------

ORACLE["filings_transpose"] = """WITH batches AS (
  SELECT CAST(doc_id AS VARCHAR) AS cik, source AS form, string_split(text, chr(10)) AS parts
  FROM documents
  UNION ALL
  SELECT conv_id || '-' || turn, role, string_split(text, chr(10)) FROM conversations)
SELECT cik, cik || '-' || i AS "accessionNumber", form, parts[i + 1] AS "primaryDocument"
FROM batches, unnest(range(len(parts))) AS positions(i)"""

ORACLE["filings_filter"] = f"""WITH {_BOOT}, filings AS (
  SELECT {_pad('o_custkey')} AS cik,
         {_pad('o_custkey')} || '-' || strftime(o_orderdate, '%y') || '-'
           || {_pad('o_orderkey', 6)} AS accession_number,
         CASE o_orderstatus WHEN 'F' THEN '10-K' WHEN 'O' THEN '10-Q' ELSE '10-K/A' END
           AS form_type,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ''
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS filing_date,
         CAST(year(o_orderdate) AS INTEGER) AS fiscal_year,
         CASE WHEN o_totalprice < 50000 THEN '' ELSE 'order-' || o_orderkey || '.htm' END
           AS primary_document,
         '/landing/' || o_custkey || '/' || {_pad('o_custkey')} || strftime(o_orderdate, '%y')
           || {_pad('o_orderkey', 6)} || '/order-' || o_orderkey || '.htm' AS raw_path
  FROM orders)
SELECT firm_id, ticker, cik, accession_number, form_type, filing_date, fiscal_year,
       primary_document, raw_path
FROM filings JOIN boot USING (cik)
WHERE form_type IN ('10-K', '10-Q') AND filing_date <> '' AND primary_document <> ''
  AND fiscal_year BETWEEN 1996 AND 2000"""

_ORDERS_FILED = f"""
SELECT CAST(o_custkey AS VARCHAR) AS cik,
       {_pad('o_custkey')} || '-' || strftime(o_orderdate, '%y') || '-'
         || {_pad('o_orderkey', 6)} AS accession_number,
       CASE o_orderstatus WHEN 'F' THEN '10-K' WHEN 'O' THEN '10-Q' ELSE '10-K/A' END
         AS form_type,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ''
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS filing_date,
       CASE WHEN o_totalprice < 50000 THEN '' ELSE 'order-' || o_orderkey || '.htm' END
         AS primary_document
FROM orders"""

ORACLE["filing_history"] = _ORDERS_FILED

ORACLE["landing_batches"] = f"""
SELECT {_cik_firm('CAST(cik AS BIGINT)')} AS firm_id, 'T' AS ticker,
       {_pad('CAST(cik AS BIGINT)')} AS cik, accession_number,
       form_type, filing_date, 0 AS fiscal_year, primary_document,
       'order/' || accession_number AS raw_path
FROM ({_ORDERS_FILED})"""

ORACLE["raw_file_texts"] = "SELECT s_suppkey, s_name AS text FROM supplier"

_LINES = f"""lines AS (
  SELECT {_cik_firm('l_suppkey')} AS firm_id, 'T' || {_pad('l_suppkey')} AS ticker,
         {_pad('l_suppkey')} AS cik,
         {_pad('l_suppkey')} || '-' || {_pad('l_orderkey % 100', 2)} || '-'
           || {_pad('l_orderkey', 6)} AS accession_number,
         l_returnflag AS form_type, strftime(l_shipdate, '%Y-%m-%d') AS filing_date,
         CAST(year(l_shipdate) AS INTEGER) AS fiscal_year,
         'line-' || l_linenumber || '.htm' AS primary_document, 'part/' || l_partkey AS raw_path,
         l_suppkey, l_orderkey
  FROM lineitem),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY cik, accession_number
    ORDER BY filing_date, primary_document, firm_id, ticker, form_type, fiscal_year, raw_path
  ) AS position FROM lines)"""
_MANIFEST_COLUMNS = """firm_id, ticker, cik, accession_number, form_type, filing_date, fiscal_year,
  primary_document, raw_path"""

ORACLE["incremental_append"] = f"""WITH {_LINES}
SELECT {_MANIFEST_COLUMNS} FROM ranked
WHERE position = 1 AND (cik, accession_number) NOT IN (
  SELECT (cik, accession_number) FROM lines WHERE filing_date < '1998-01-01')"""

ORACLE["landing_stream"] = f"""WITH {_LINES}
SELECT {_MANIFEST_COLUMNS} FROM ranked WHERE position = 1"""

ORACLE["filing_paths"] = f"""WITH {_LINES}
SELECT '/landing/' || l_suppkey || '/' || replace(accession_number, '-', '') || '/'
         || primary_document AS path,
       cik || '_' || accession_number || '_' || primary_document AS document_id,
       CAST(CASE WHEN l_orderkey % 100 < 70 THEN 2000 ELSE 1900 END + l_orderkey % 100
         AS INTEGER) AS accession_year
FROM lines"""

_PAGES = f"""page_rows AS (
  SELECT page_id, url, html, {_cik_firm('page_id')} AS firm_id, 'P' || page_id AS ticker,
         {_pad('page_id')} AS cik,
         {_pad('page_id')} || '-' || {_pad('page_id % 97', 2)} || '-000001' AS accession_number,
         'p' || page_id || CASE WHEN url LIKE '%.html' THEN '.html' ELSE '.txt' END AS document,
         CASE WHEN contains(url, 'www') THEN '' WHEN contains(url, 'blog') THEN 'n/a'
              ELSE (2015 + page_id % 7) || '-06-30' END AS filing_date,
         CASE WHEN NOT starts_with(url, 'https') AND contains(url, 'm.')
              THEN 2015 + page_id % 7 END AS stored_year
  FROM pages),
page_docs AS (
  SELECT *, CAST(coalesce(stored_year, TRY_CAST(substr(filing_date, 1, 4) AS INTEGER),
              CASE WHEN page_id % 97 < 70 THEN 2000 ELSE 1900 END + page_id % 97) AS INTEGER)
           AS fiscal_year,
         '/landing/' || page_id || '/' || replace(accession_number, '-', '') || '/' || document
           AS landed_path
  FROM page_rows)"""

ORACLE["year_fallback"] = f"WITH {_PAGES} SELECT accession_number, fiscal_year FROM page_docs"

ORACLE["manifest_rebuild"] = f"""WITH {_PAGES}, {_MAPPING}
SELECT m.firm_id, m.ticker, cik, accession_number, '' AS form_type, '' AS filing_date,
       CAST(0 AS INTEGER) AS fiscal_year, document AS primary_document, landed_path AS raw_path
FROM page_docs JOIN mapping AS m USING (cik) WHERE contains(url, '/en/')"""

ORACLE["standardized_documents"] = f"""WITH {_PAGES}
SELECT cik || '_' || accession_number || '_' || document AS document_id, firm_id, cik, ticker,
       '10-K' AS form_type, filing_date, fiscal_year, {_routed('html')} AS text,
       CASE WHEN contains(url, '/en/') THEN landed_path ELSE '/archive/' || page_id END AS raw_path
FROM page_docs WHERE contains(url, '/en/') OR NOT contains(url, '/es/')"""

ORACLE["bundled_documents"] = ORACLE["standardized_documents"]

ORACLE["features_from_files"] = f"""WITH {_PAGES}, counted AS (
  SELECT firm_id, fiscal_year, document_id, len(hits) AS ai_mention_count,
         len(hits) AS ai_token_count,
         len(regexp_extract_all(text, '[^{_SPACE}]+')) AS total_tokens
  FROM (SELECT firm_id, fiscal_year, page_id AS document_id, text, {_HITS} AS hits
        FROM (SELECT *, {_routed('html')} AS text FROM page_docs
              WHERE contains(url, '/en/') OR NOT contains(url, '/es/')))),
{_FIRM_YEARS} SELECT * FROM firm_years"""

# -- panel -------------------------------------------------------------------------

ORACLE["to_firm_year"] = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders"""


def _orders(cik: str = "o_custkey") -> str:
    return f"""
  SELECT {_cik_firm(cik)} AS firm_id, CAST(year(o_orderdate) AS INTEGER) AS year,
         'orders' AS source, count(*) AS orders,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM orders GROUP BY ALL"""


def _lines(cik: str = "l_suppkey") -> str:
    return f"""
  SELECT {_cik_firm(cik)} AS firm_id, CAST(year(l_shipdate) AS INTEGER) AS year,
         'lines' AS source, count(*) AS lines, sum(l_quantity) AS quantity
  FROM lineitem GROUP BY ALL"""


_KNOWN = ("CASE WHEN o_orderstatus <> 'P' THEN o_custkey END",
          "CASE WHEN l_returnflag <> 'R' THEN l_suppkey END")
_IN_YEARS = "WHERE year BETWEEN 1996 AND 2000"

ORACLE["prefix_columns"] = f"""
SELECT firm_id, year, source AS shop_source, orders AS shop_orders, cents AS shop_cents
FROM ({_orders()})"""

ORACLE["panel_outer"] = f"""
SELECT firm_id, year, a.source, orders, cents, b.source AS source_ship_lines,
       lines AS ship_lines_lines, quantity AS ship_lines_quantity, sold AS part_sold_sold
FROM (SELECT * FROM ({_orders()}) {_IN_YEARS}) a
FULL OUTER JOIN (SELECT * FROM ({_lines()}) {_IN_YEARS}) b USING (firm_id, year)
FULL OUTER JOIN (
  SELECT {_cik_firm('l_partkey')} AS firm_id, CAST(year(l_shipdate) AS INTEGER) AS year,
         count(*) AS sold
  FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 2000 GROUP BY ALL) c USING (firm_id, year)"""

_NULLSAFE = f"""
SELECT coalesce(a.firm_id, b.firm_id) AS firm_id, coalesce(a.year, b.year) AS year, a.source,
       orders, cents, b.source AS source_ship_lines, lines AS ship_lines_lines,
       quantity AS ship_lines_quantity
FROM (SELECT * FROM ({_orders(_KNOWN[0])}) {_IN_YEARS}) a
FULL OUTER JOIN (SELECT * FROM ({_lines(_KNOWN[1])}) {_IN_YEARS}) b
  ON a.firm_id IS NOT DISTINCT FROM b.firm_id AND a.year = b.year"""

ORACLE["panel_outer_nullsafe"] = _NULLSAFE

ORACLE["panel_repeated_keys"] = f"""
SELECT firm_id, year, orders, l_orderkey AS lines_l_orderkey,
       l_linenumber AS lines_l_linenumber
FROM (SELECT * FROM ({_orders()}) {_IN_YEARS}) a
FULL OUTER JOIN (
  SELECT {_cik_firm('l_suppkey')} AS firm_id, CAST(year(l_shipdate) AS INTEGER) AS year,
         l_orderkey, l_linenumber FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 2000) b
USING (firm_id, year)"""

ORACLE["panel_table"] = _NULLSAFE

ORACLE["panel_sql"] = f"""
SELECT firm_id, year, a.source, orders, cents, b.source AS source_ship_lines, lines, quantity
FROM ({_orders(_KNOWN[0])}) a FULL OUTER JOIN ({_lines(_KNOWN[1])}) b USING (firm_id, year)
{_IN_YEARS}"""

ORACLE["panel_controls"] = f"""WITH {_MAPPING}, controls AS (
  SELECT '00' || c_custkey AS compustat_gvkey, {_pad('c_custkey')} AS cik,
         CAST(y AS INTEGER) AS year, c_acctbal AS compustat_at,
         c_acctbal / 100 AS compustat_roa, c_nationkey AS compustat_sic,
         CAST(c_custkey AS DOUBLE) AS compustat_emp, c_name AS conm, c_mktsegment AS tic
  FROM customer, unnest(range(1995, 2002)) AS years(y))
SELECT p.*, m.cik, compustat_gvkey, compustat_at, compustat_roa, compustat_sic, compustat_emp,
       conm, tic
FROM ({_orders()}) p
LEFT JOIN mapping m ON m.firm_id = p.firm_id
LEFT JOIN controls c ON c.cik = m.cik AND c.year = p.year"""

ORACLE["qc_report"] = """WITH panel AS (
  SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS firm, year(o_orderdate) AS y
  FROM orders),
groups AS (SELECT firm, y, count(*) AS n FROM panel GROUP BY ALL),
totals AS (
  SELECT CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS dup, min(y) AS low, max(y) AS high,
         CAST(coalesce(sum(n) FILTER (firm IS NULL), 0) AS BIGINT) AS nulls
  FROM groups)
SELECT 'required_columns' AS name, true AS passed, 'All required columns present' AS message,
       '{"missing_columns":[]}' AS details
UNION ALL SELECT 'duplicate_keys', dup = 0, 'Found ' || dup || ' duplicate firm_id-year rows',
       '{"duplicate_count":' || dup || '}' FROM totals
UNION ALL SELECT 'year_range', true, 'Year range: ' || low || '-' || high,
       '{"min_year":' || low || ',"max_year":' || high || '}' FROM totals
UNION ALL SELECT 'null_firm_ids', nulls = 0, 'Found ' || nulls || ' null firm_id values',
       '{"null_count":' || nulls || '}' FROM totals"""

_RULES = {
    "firm_id_required": "o_orderpriority = '1-URGENT'",
    "year_required": "o_orderdate IS NULL",
    "source_required": "o_orderstatus = 'P'",
    "firm_id_format": "o_orderpriority = '5-LOW'",
    "year_minimum": "year(o_orderdate) - 10 < 1990",
    "document_count_minimum": "o_custkey - 100 < 0",
    "ai_mention_count_minimum": "o_custkey < 0",
    "total_tokens_minimum": "o_orderpriority = '5-LOW' AND o_orderkey - 500 < 0",
    "ai_token_count_minimum": "o_orderkey < 0",
    "ai_mention_share_range": "o_totalprice / 300000 > 1 OR o_totalprice < 0",
}
ORACLE["qc_overall"] = f"SELECT bool_and(passed) AS passed FROM ({ORACLE['qc_report']})"

ORACLE["qc_constraints"] = " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, count(*) FILTER ({broken}) AS violations FROM orders"
    for rule, broken in _RULES.items()
)

# -- validation ----------------------------------------------------------------------

_POOL = f"""{_DOCS}, {_EXCERPTS}, pool AS (
  SELECT document_id, firm_id, ticker, fiscal_year, form_type, ai_mention_count,
         {_BIN} AS density_bin, excerpt,
         CAST(ai_mention_count > 0 AS INTEGER) AS keyword_predicted
  FROM counted JOIN excerpts USING (document_id))"""

_SAMPLE = f"""{_POOL}, strata AS (
  SELECT *, row_number() OVER (
           PARTITION BY fiscal_year, density_bin
           ORDER BY sha256('42|' || document_id), document_id) AS rank,
         (SELECT greatest(1, 250 // count(DISTINCT density_bin)) FROM pool) AS quota
  FROM pool),
sample AS (
  SELECT * EXCLUDE (rank, quota), substr(sha256(document_id), 1, 12) AS sample_id
  FROM strata WHERE rank <= quota
  ORDER BY sha256('42|second|' || document_id), document_id LIMIT 250)"""

ORACLE["score_pool"] = f"WITH {_POOL} SELECT * FROM pool"

ORACLE["stratified_sample"] = f"WITH {_SAMPLE} SELECT * FROM sample"

ORACLE["blind_labeling"] = f"""WITH {_SAMPLE}
SELECT sample_id, excerpt, '' AS human_ai_mention FROM sample"""

ORACLE["blind_scores"] = f"WITH {_SAMPLE} SELECT * EXCLUDE (excerpt) FROM sample"

ORACLE["blind_files"] = f"""WITH {_SAMPLE}
SELECT sample_id, document_id, firm_id, fiscal_year, ai_mention_count, density_bin,
       keyword_predicted, excerpt FROM sample"""

ORACLE["confusion_metrics"] = f"""WITH {_DOCS}, counts AS (
  SELECT count(*) AS n_labeled,
         count(*) FILTER (quality = 1 AND ai_mention_count > 0) AS tp,
         count(*) FILTER (quality = 0 AND ai_mention_count > 0) AS fp,
         count(*) FILTER (quality = 1 AND ai_mention_count = 0) AS fn,
         count(*) FILTER (quality = 0 AND ai_mention_count = 0) AS tn
  FROM labels JOIN counted ON document_id = CAST(doc_id AS VARCHAR)),
rates AS (
  SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
         coalesce(tp / nullif(tp + fn, 0), 0) AS recall
  FROM counts)
SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1,
       coalesce(fp / nullif(fp + tn, 0), 0) AS false_positive_rate,
       coalesce(fn / nullif(fn + tp, 0), 0) AS false_negative_rate
FROM rates"""

# -- files and views -------------------------------------------------------------------

ORACLE["stage_round_trip"] = f"""WITH {_DOCS}, {_FIRM_YEARS}
SELECT *, 'features' AS stage, 'attention' AS signal_layer, CAST(NULL AS VARCHAR) AS config_hash,
       true AS path_kept, true AS dated,
       (SELECT count(*) FROM firm_years) AS row_count FROM firm_years"""

# One file with one block: positions count from 2^40.
ORACLE["universe_scan"] = """
SELECT 'T' || c_custkey AS ticker, c_name AS company_name, c_mktsegment AS sector,
       1099511627775 + row_number() OVER (ORDER BY c_custkey) AS registered_seq
FROM customer WHERE c_acctbal >= 0"""

ORACLE["controls_scan"] = f"""
SELECT '00' || c_custkey AS gvkey, {_pad('c_custkey')} AS cik, CAST(y AS INTEGER) AS year,
       c_acctbal AS at, c_acctbal / 100 AS roa, c_nationkey AS sic,
       CAST(c_custkey AS DOUBLE) AS emp, c_name AS conm, c_mktsegment AS tic
FROM customer, unnest(range(1995, 2002)) AS years(y)"""

ORACLE["panel_export"] = _NULLSAFE

ORACLE["sql_view"] = """
SELECT o_orderstatus, count(*) AS lines, sum(l_quantity) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_quantity < 25 AND l_returnflag <> 'N' GROUP BY o_orderstatus"""

# -- incremental tables ------------------------------------------------------------

ORACLE["manifest_store_append"] = ORACLE["incremental_append"]

ORACLE["manifest_store_replay"] = f"""WITH {_LINES}, firsts AS (
  SELECT (cik, accession_number) IN (
    SELECT (cik, accession_number) FROM lines WHERE filing_date < '1998-01-01') AS early
  FROM ranked WHERE position = 1)
SELECT 'all' AS step, count(*) FILTER (NOT early) AS rows FROM firsts
UNION ALL SELECT 'replay', 0 UNION ALL SELECT 'stored', count(*) FROM firsts"""

ORACLE["mapping_store_upsert"] = ORACLE["mapping_upsert"]

ORACLE["firm_year_rollup"] = ORACLE["firm_year_attention"]

ORACLE["filing_shards"] = _ORDERS_FILED

ORACLE["listed_raw_files"] = f"""WITH {_PAGES}
SELECT CASE WHEN contains(url, '/en/')
            THEN '/landing/' || page_id || '/' || replace(accession_number, '-', '') || '/' || document
            WHEN contains(url, '/es/') THEN '/lost/' || page_id
            ELSE '/archive/' || page_id END AS path,
       CAST(strlen(html) AS BIGINT) AS length, sha256(html) AS content_sha256
FROM page_rows"""

ORACLE["documents_from_landed_files"] = f"""WITH {_PAGES}
SELECT cik || '_' || accession_number || '_' || document AS document_id, firm_id, cik, ticker,
       '10-K' AS form_type, filing_date, fiscal_year, {_routed('html')} AS text
FROM page_docs WHERE contains(url, '/en/')"""

# -- absent and empty inputs, hot keys ---------------------------------------------

ORACLE["features_of_missing_stage"] = ORACLE["firm_year_attention"]

ORACLE["panel_without_inputs"] = f"SELECT firm_id, year FROM ({_orders()})"

ORACLE["panel_built"] = ORACLE["panel_outer_nullsafe"]

ORACLE["panel_hot_keys"] = ORACLE["panel_repeated_keys"]

_MANY = "F O P 1-URGENT 2-HIGH 3-MEDIUM 4-NOT|SPECIFIED 5-LOW".split()
ORACLE["panel_many"] = f"""
SELECT {_cik_firm('o_custkey')} AS firm_id, CAST(year(o_orderdate) AS INTEGER) AS year, {", ".join(
    f"nullif(count(*) FILTER (o_order{'status' if i < 3 else 'priority'} = "
    f"'{value.replace('|', ' ')}'), 0) AS {f't{i}_' if i else ''}orders"
    for i, value in enumerate(_MANY))}
FROM orders GROUP BY ALL"""
