"""Readers, writers, views and whole stage runs on temporary files."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from panelloom import schemas
from panelloom.operators import quality
from panelloom.plans import inputs, stages
from panelloom.sources import scans, sinks, views


def test_universe(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text("# one\n# two\nticker,company_name,sector\nNA,\"Na, Inc\",x\n\n# mid\nbb,B,y\n")
    rows = scans.read_universe(spark, str(path)).orderBy("registered_seq").collect()
    assert [(r.ticker, r.company_name, r.sector) for r in rows] == [("NA", "Na, Inc", "x"), ("bb", "B", "y")]


def test_directory(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({
        "0": {"cik_str": 5, "ticker": "aa", "title": "first"},
        "1": {"cik_str": 6, "ticker": "AA", "title": "last"},
        "2": {"cik_str": 7, "ticker": "bb", "title": "B"}}, indent=1))
    rows = scans.read_directory(spark, str(tmp_path / "a.json")).collect()
    assert {tuple(r) for r in rows} == {("AA", "0000000006", "last"), ("BB", "0000000007", "B")}


def history_files(folder):
    def lists(n, form):
        return {"accessionNumber": [f"0000000001-23-{form}{i}" for i in range(n)], "form": [form] * n,
                "filingDate": ["2023-02-03"] * n, "primaryDocument": [f"{form}{i}.htm" for i in range(n)]}

    (folder / "subs").mkdir()
    (folder / "shards").mkdir()
    main = {"cik": "1", "filings": {"recent": lists(2, "10-K"), "files": [{"name": "x"}]}}
    (folder / "subs" / "CIK0000000001.json").write_text(json.dumps(main, indent=2))
    bare = {"cik": "2", "filings": {"recent": {}, "files": []}}
    (folder / "subs" / "CIK0000000002.json").write_text(json.dumps(bare))
    (folder / "shards" / "CIK0000000001-submissions-001.json").write_text(json.dumps(lists(3, "10-Q")))
    return str(folder / "subs"), str(folder / "shards")


def test_filing_history(spark, tmp_path):
    subs, shards = history_files(tmp_path)
    recent = scans.read_filing_history(spark, subs)
    assert recent.count() == 2 and {r.form for r in recent.collect()} == {"10-K"}
    everything = scans.filings_as_columns(scans.read_filing_history(spark, subs, shards))
    assert everything.groupBy("form_type").count().where("form_type = '10-Q'").first()["count"] == 3
    assert everything.where("cast(cik AS int) = 1").count() == 5


def test_missing_stage(spark, tmp_path):
    path = str(tmp_path / "none")
    assert scans.read_stage_if_exists(spark, path) is None
    assert scans.read_stage_if_exists(spark, path, schemas.MAPPING).schema.names == schemas.MAPPING.names
    assert sinks.load_mapping(spark, path).count() == 0


def test_raw_files(spark, tmp_path):
    (tmp_path / "1" / "acc").mkdir(parents=True)
    (tmp_path / "1" / "acc" / "a.htm").write_bytes(b"\xff\x00x")
    (tmp_path / "m.parquet").write_bytes(b"skip")
    files = scans.read_raw_files(spark, str(tmp_path))
    rows = files.collect()
    assert [(r.path, bytes(r.content)) for r in rows] == [(f"{tmp_path}/1/acc/a.htm", b"\xff\x00x")]
    plan = files.select("path")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan, "listing reads no content"


def test_controls(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("gvkey,cik,fyear,at,roa,sic,emp,tic\n001690,5.0,2023,10.5,0.12,3571,7,TT\n002,,2022,,,,,\n")
    rows = {r.gvkey: r for r in scans.read_controls(spark, str(path)).collect()}
    assert (rows["001690"].cik, rows["001690"].year, rows["001690"].roa, rows["001690"].tic) == (
        "0000000005", 2023, 0.12, "TT")
    assert rows["002"].cik == "" and rows["002"].at is None
    path.write_text("gvkey,cik\n1,2\n")
    with pytest.raises(ValueError, match="controls lack"):
        scans.read_controls(spark, str(path))
    with pytest.raises(FileNotFoundError):
        scans.read_controls(spark, str(tmp_path / "absent.csv"))


def test_publish_replaces_a_table_that_is_also_the_input(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.publish_parquet(spark.range(3), path)
    grown = spark.read.parquet(path).union(spark.range(10, 12))
    sinks.publish_parquet(grown, path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 10, 11]
    assert [p.name for p in tmp_path.iterdir()] == ["t"], "no copies are left behind"


def test_failed_publish_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.publish_parquet(spark.range(3), path)
    bad = spark.range(5).select(F.raise_error(F.lit("boom")).cast("string").alias("id"))
    with pytest.raises(Exception, match="boom"):
        sinks.publish_parquet(bad, path)
    assert spark.read.parquet(path).count() == 3


def test_missing_and_empty_stages_are_left_out(spark, tmp_path):
    path = str(tmp_path / "empty")
    schemas.empty(spark, schemas.PANEL_KEYS).write.parquet(path)
    assert scans.read_stage_if_filled(spark, path) is None
    assert scans.read_stage_if_filled(spark, str(tmp_path / "none")) is None
    spark.range(3).write.parquet(str(tmp_path / "three"))
    assert scans.read_stage_if_filled(spark, str(tmp_path / "three")).count() == 3


def test_damaged_json_raises(spark, tmp_path):
    good = '{"0": {"cik_str": 1, "ticker": "A", "title": "a"}}'
    folder = tmp_path / "directory"
    folder.mkdir()
    (folder / "1.json").write_text(good)
    (folder / "2.json").write_text(good[:-9])
    with pytest.raises(Exception, match="(?i)malformed"):
        scans.read_directory(spark, str(folder)).collect()
    history = tmp_path / "history"
    history.mkdir()
    (history / "1.json").write_text('{"cik": "1", "filings": {"recent": {"accessionNumber": ["x"')
    with pytest.raises(Exception, match="(?i)malformed"):
        scans.read_filing_history(spark, str(history)).collect()


def test_universe_order_follows_paths_not_sizes(spark, tmp_path):
    (tmp_path / "1.csv").write_text("ticker,company_name,sector\nA,a,s\nB,b,s\n")
    rows = "".join(f"T{i},name {i},sector\n" for i in range(5000))
    (tmp_path / "2.csv").write_text("ticker,company_name,sector\n# note\n" + rows)
    universe = scans.read_universe(spark, str(tmp_path / "*.csv"))
    tickers = [r.ticker for r in universe.orderBy("registered_seq").collect()]
    assert tickers == ["A", "B", *[f"T{i}" for i in range(5000)]]


def test_bundles_keep_contents_in_place(spark, settings):
    files = spark.range(50).selectExpr("concat('/p/', id) AS path", "cast(cast(id AS string) AS binary) AS content")
    sinks.write_bundles(files, "bundles_test", 4)
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    wanted = spark.range(30).selectExpr("concat('/p/', id) AS path")
    joined = spark.table("bundles_test").join(wanted, "path")
    assert joined.count() == 30
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    spark.sql("DROP TABLE bundles_test")


def test_views(spark, tmp_path):
    for i in range(2):
        spark.range(i * 5, i * 5 + 5).write.parquet(str(tmp_path / f"p{i}"))
    views.register_parquet(spark, str(tmp_path / "p*"), "numbers")
    views.register_frame(spark.createDataFrame([(3, "three")], "id int, name string"), "names")
    sql = "SELECT name FROM numbers JOIN names USING (id) WHERE id > ? AND name <> ?"
    assert [r.name for r in views.query(spark, sql, [1, "x"]).collect()] == ["three"]
    assert views.query(spark, "SELECT count(*) AS n FROM numbers").first().n == 10


def test_panel_export_formats(spark, tmp_path):
    panel = spark.createDataFrame([("f", 2020, 1.5)], "firm_id string, year int, v double")
    path = str(tmp_path / "panel")
    sinks.save_panel(panel, path, ["parquet", "csv", "table"])
    assert spark.read.parquet(path).count() == 1
    assert scans.read_text_csv(spark, path + ".csv").first().v == "1.5"
    assert spark.table(sinks.PANEL_TABLE).first().year == 2020
    spark.sql(f"DROP TABLE {sinks.PANEL_TABLE}")
    with pytest.raises(ValueError, match="unknown export formats"):
        sinks.save_panel(panel, path, ["duckdb"])


def test_all_stages(spark, tmp_path):
    """Universe to metrics; ingest runs twice and adds nothing the second time."""
    def at(name):
        return str(tmp_path / name)

    (tmp_path / "universe.csv").write_text("ticker,company_name,sector\naa,A Corp,x\nzz,Z Corp,y\n")
    (tmp_path / "tickers.json").write_text(json.dumps(
        {"0": {"cik_str": 1, "ticker": "AA", "title": "a"}, "1": {"cik_str": 9, "ticker": "QQ", "title": "q"}}))
    subs, shards = history_files(tmp_path)
    raw = tmp_path / "raw"
    for name, text in (("10-K0", "<html>Deep learning</html>"), ("10-K1", "<html>none</html>"),
                       ("10-Q0", "machine learning, computer vision")):
        folder = raw / "1" / f"000000000123{name}".replace("-", "")
        folder.mkdir(parents=True)
        (folder / f"{name}.htm").write_text(text)

    stages.bootstrap(spark, at("universe.csv"), at("tickers.json"), at("mapping"))
    history = scans.read_filing_history(spark, subs, shards)
    for _ in range(2):
        stages.ingest(spark, history, at("universe.csv"), at("mapping"), at("manifest"), str(raw))
        assert spark.read.parquet(at("manifest")).count() == 5
    stages.standardize(spark, at("manifest"), str(raw), at("documents"), at("meta"))
    stages.extract_features(spark, at("documents"), at("features"), at("meta"))
    meta = {r.stage: r for r in spark.read.parquet(at("meta")).collect()}
    assert meta["intermediate"].row_count == 3 and meta["features"].row_count == 1
    assert meta["features"].created_at is not None and meta["features"].config_hash is None

    stages.extract_features_from_files(
        spark, at("manifest"), str(raw), at("direct"), at("meta2"))
    direct, stored = (spark.read.parquet(at(n)).collect() for n in ("direct", "features"))
    assert direct == stored

    stages.build_panel(spark, {"attention/sec": at("features"), "none": at("absent")}, at("panel"))
    panel = spark.read.parquet(at("panel"))
    row = panel.first()
    assert (row.year, row.document_count, row.ai_mention_count) == (2023, 3, 3)
    assert row.ai_mention_share == pytest.approx(2 / 3)
    assert quality.report_passed(quality.quality_report(panel)).first().passed

    stages.draw_sample(spark, at("documents"), at("labeling"), at("scores"))
    filled = scans.read_text_csv(spark, at("labeling")).withColumn(
        "human_ai_mention", F.when(F.lower("excerpt").contains("learning"), "1").otherwise("0"))
    filled.write.option("header", True).csv(at("filled"))
    result = stages.validate(spark, at("filled"), at("scores")).first()
    assert (result.n_labeled, result.tp, result.tn, result.f1) == (3, 2, 1, 1.0)


def test_stages_without_inputs(spark, tmp_path):
    def at(name):
        return str(tmp_path / name)

    stages.standardize(spark, at("none"), at("raw"), at("documents"), at("meta"))
    stages.extract_features(spark, at("documents"), at("features"), at("meta"))
    stages.build_panel(spark, {"a": at("features")}, at("panel"))
    assert spark.read.parquet(at("panel")).columns == ["firm_id", "year"]


def test_shards_are_found_in_folders_and_read_without_a_listing_by_the_driver(spark, tmp_path):
    subs, shards = history_files(tmp_path)
    everything = scans.filings_as_columns(scans.read_filing_history(spark, subs, shards))
    before = sorted(map(str, everything.collect()))
    folder = tmp_path / "shards" / "0"
    folder.mkdir()
    for file in list((tmp_path / "shards").glob("*.json")):
        (folder / file.name).write_bytes(file.read_bytes())
    history = scans.read_filing_history(spark, subs, str(folder.parent / "0"))
    assert sorted(map(str, scans.filings_as_columns(history).collect())) == before
    nested = tmp_path / "nested" / "7"
    nested.mkdir(parents=True)
    for file in folder.glob("*.json"):
        (nested / file.name).write_bytes(file.read_bytes())
    history = scans.read_filing_history(spark, subs, str(nested.parent))
    assert sorted(map(str, scans.filings_as_columns(history).collect())) == before


def test_supplier_files_lie_in_few_folders(spark, tmp_path):
    rows = [(i, f"name {i}") for i in range(2500)] + [(7, "again")]
    frame = spark.createDataFrame(rows, "s_suppkey bigint, s_name string").coalesce(1)
    frame.write.parquet(str(tmp_path / "supplier.parquet"))
    files = inputs.supplier_files(spark, str(tmp_path)).collect()
    assert len(files) == 2500 and len({f.path.split("/")[0] for f in files}) == 3
    assert {f.path: bytes(f.content) for f in files}["0/s_suppkey=7.txt"] == b"name 7\nagain\n"


def test_a_batch_of_texts_lands_in_more_files_as_it_grows(spark, tmp_path, monkeypatch):
    rows = [(i, "text " * 50 + str(i)) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    assert inputs.files_per_batch(spark, str(tmp_path), "documents", 3) == 1
    monkeypatch.setattr(inputs, "FILE_BYTES", 1000)
    assert inputs.files_per_batch(spark, str(tmp_path), "documents", 3) > 1
