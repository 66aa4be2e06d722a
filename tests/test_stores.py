"""Tables that take batches: what they hold, what they read, and what a replay does."""

from __future__ import annotations

import hashlib
import pathlib
import random
import threading

import pytest
from pyspark.sql import functions as F

from panelloom import schemas, session
from panelloom.operators import features, sampling
from panelloom.operators import mapping as maps
from panelloom.plans import stages
from panelloom.sources import listing, sinks
from panelloom.sources import manifest_store as stores
from panelloom.sources.mapping_store import MappingStore
from panelloom.streaming import rollup
from panelloom.streaming.rollup import FirmYearStore, roll_up_stream


def filing(cik, accession, date="2020-01-01", document="d"):
    return ("f", "T", f"{cik:010d}", accession, "10-K", date, 2020, document, "p")


def batch_of(spark, rows):
    return spark.createDataFrame(rows, schemas.MANIFEST).repartition(3)


def keys_of(df):
    return sorted((r.cik, r.accession_number) for r in df.collect())


@pytest.fixture
def store(spark, tmp_path):
    return stores.ManifestStore(spark, str(tmp_path / "store"), buckets=32, expected_keys=4_000)


# -- manifest --------------------------------------------------------------------------


def test_batches_against_brute_force(spark, store):
    rng = random.Random(3)
    held = {}
    for _ in range(4):
        rows = [
            filing(rng.randrange(5), f"a{rng.randrange(60)}", f"20{rng.randrange(10, 20)}-01-01",
                   str(rng.randrange(9)))
            for _ in range(150)
        ]
        new = {}
        for r in sorted(rows, key=lambda r: (r[5], r[7])):
            if (r[2], r[3]) not in held:
                new.setdefault((r[2], r[3]), r)
        fresh = store.append(batch_of(spark, rows)).fresh
        assert {(r.cik, r.accession_number): (r.filing_date, r.primary_document)
                for r in fresh.collect()} == {k: (r[5], r[7]) for k, r in new.items()}
        held |= new
        assert keys_of(store.read()) == sorted(held)
    assert store.append(batch_of(spark, rows)).fresh.count() == 0
    assert store.read().count() == len(held)


def test_new_keys_open_next_to_nothing(spark, store):
    """A batch of 1% new keys reads filters; its replay opens only the buckets of its keys."""
    old = [filing(i % 50, f"old{i}") for i in range(4_000)]
    assert store.append(batch_of(spark, old)).opened == ()
    new = [filing(i % 50, f"new{i}") for i in range(40)]
    added = store.append(batch_of(spark, new))
    assert added.fresh.count() == 40
    assert len(added.opened) <= 2  # of 32: chance hits in the filters
    replay = store.append(batch_of(spark, new[:3]))
    assert replay.fresh.count() == 0 and 1 <= len(replay.opened) <= 3
    known = store.known_keys(replay.opened)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket", "bucket")
    assert "raw_path" not in plan  # keys alone are read
    known.collect()
    leaf = known._jdf.queryExecution().executedPlan().executedPlan().collectLeaves().head()
    while not leaf.nodeName().startswith("Scan"):
        leaf = leaf.plan().collectLeaves().head()  # inside a shuffle's stage
    read = leaf.metrics().apply("numPartitions").value()
    assert read == len(replay.opened)


def test_an_append_that_died_between_filters_and_rows(spark, store, monkeypatch):
    rows = [filing(1, f"a{i}") for i in range(20)]
    store.append(batch_of(spark, rows[:5]))
    done = store._write_filters

    def dies(fresh):
        done(fresh)
        raise RuntimeError("lost")

    monkeypatch.setattr(store, "_write_filters", dies)
    with pytest.raises(RuntimeError):
        store.append(batch_of(spark, rows))
    monkeypatch.undo()
    again = stores.ManifestStore(spark, store.rows_path.removesuffix("/rows"))
    assert (again.buckets, again.segments) == (store.buckets, store.segments)
    assert again.append(batch_of(spark, rows)).fresh.count() == 15
    assert keys_of(again.read()) == keys_of(batch_of(spark, rows))


def test_filters_are_merged_after_many_appends(spark, store, monkeypatch):
    monkeypatch.setattr(stores, "COMPACT_AFTER", 3)
    rows = [filing(1, f"a{i}") for i in range(8)]
    for row in rows:
        store.append(batch_of(spark, [row]))
    assert store._generation() >= 1
    assert store.append(batch_of(spark, rows)).fresh.count() == 0
    assert store.read().count() == 8


def test_rows_go_to_no_filter_of_an_empty_store(spark, store, monkeypatch):
    def asked(*_):
        raise AssertionError("an empty store has no filters")

    monkeypatch.setattr(stores, "_all_set", asked)
    rows = [filing(1, "a"), filing(1, "b"), filing(1, "a", "2019-01-01")]
    assert keys_of(store.append(batch_of(spark, rows)).fresh) == keys_of(batch_of(spark, rows[:2]))
    monkeypatch.undo()
    added = store.append(batch_of(spark, [*rows, filing(2, "c")])).fresh
    assert keys_of(added) == keys_of(batch_of(spark, [filing(2, "c")]))


def wide_batch(spark, numbers):
    """Rows with a path of 4,000 random characters each."""
    path = lambda i: "".join(random.Random(i).choices("0123456789abcdefghijklmnopqrstuv", k=4_000))
    rows = [(*filing(i % 7, f"a{i}")[:8], path(i)) for i in numbers]
    return spark.createDataFrame(rows, schemas.MANIFEST)


def row_shuffles(df):
    """Shuffles in a frame's plan whose rows have more than keys in them."""

    def of(node):
        children = node.children()
        below = sum(of(children.apply(i)) for i in range(children.size()))
        return below + (node.nodeName() == "Exchange" and node.output().size() > 3)

    plan = df._jdf.queryExecution().executedPlan()
    return of(plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)


def test_whole_rows_are_shuffled_once(spark, store, monkeypatch, settings):
    """Once by bucket, whatever the filters' size, and not again when they are stored."""
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    frames, kept, write = [], store._kept, type(spark.range(1).write).parquet
    monkeypatch.setattr(store, "_kept", lambda df, name: frames.append(df) or kept(df, name))

    def seen(writer, path, *args, **options):
        if path == store.rows_path:
            frames.append(writer._df)
        return write(writer, path, *args, **options)

    monkeypatch.setattr(type(spark.range(1).write), "parquet", seen)
    for numbers in (range(60), range(30, 150)):
        frames.clear()
        store.append(wide_batch(spark, numbers))
        assert [row_shuffles(df) for df in frames] == [1, 0]
    assert store.read().count() == 150


def test_a_replay_moves_keys_alone(spark, store):
    """No row of a known batch is shuffled or lands in the scratch folder."""
    root = pathlib.Path(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    size = lambda: sum(f.stat().st_size for f in root.rglob("*") if f.is_file())
    batch = wide_batch(spark, range(200))
    assert store.append(batch).fresh.count() == 200
    before = size()
    assert store.append(batch).fresh.count() == 0
    assert size() - before < 100_000  # of some 500,000 bytes
    late = wide_batch(spark, range(203))
    added = store.append(late).fresh.collect()
    wanted = late.where("accession_number in ('a200', 'a201', 'a202')").collect()
    assert sorted(added) == sorted(wanted)
    assert sorted(store.read().collect()) == sorted(late.collect())


@pytest.mark.parametrize("known_share", [-1.0, 0.9, 2.0])  # keys first, as it is, rows first
def test_large_batches_against_brute_force(spark, store, monkeypatch, known_share):
    """With keys asked in two rounds, and with keys that come too often for one task."""
    limits = {"EARLY_ROWS": 0, "EARLY": 3, "HOT_ROWS": 40, "KNOWN_SHARE": known_share, "SLICE_SEGMENTS": 1}
    for name, value in limits.items():
        monkeypatch.setattr(stores, name, value)
    store.segments = 4 * store.buckets
    hot, counted = [], store._counted
    monkeypatch.setattr(store, "_counted", lambda rows: hot.append(counted(rows)) or hot[-1])
    rng = random.Random(5)
    held, nulls = {}, 0
    for step in range(3):
        rows = [
            filing(rng.randrange(5), f"a{rng.randrange(40 * (step + 1))}",
                   f"20{rng.randrange(10, 20)}-01-01", str(rng.randrange(9)))
            for _ in range(200)
        ]
        rows += [filing(1, "often", f"2010-01-{i % 28 + 1:02d}", str(i)) for i in range(100)]
        rows += [(*r[:2], None, *r[3:]) for r in rows[:2]]
        new = {}
        for r in sorted(rows, key=lambda r: (r[5], r[7])):
            if (r[2], r[3]) not in held or r[2] is None:
                new.setdefault((r[2], r[3]), r)
        fresh = store.append(batch_of(spark, rows)).fresh.collect()
        assert {(r.cik, r.accession_number): (r.filing_date, r.primary_document) for r in fresh} == {
            k: (r[5], r[7]) for k, r in new.items()}
        assert len(fresh) == len(new)
        held |= new
        nulls += sum(k[0] is None for k in new)  # a null key is never known
        assert store.read().count() == sum(k[0] is not None for k in held) + nulls
    assert all(number == 302 and len(segments) >= 1 for number, segments in hot)


def test_an_append_leaves_the_session_as_it_was(spark, store, settings):
    least = "spark.sql.files.minPartitionNum"
    settings({least: "3"})
    seen = []
    with session.settings(spark, {least: "5", "panelloom.test": "x"}):
        seen += [spark.conf.get(least), spark.conf.get("panelloom.test")]
    store.append(batch_of(spark, [filing(1, "a")]))
    assert seen == ["5", "x"] and spark.conf.get("panelloom.test", None) is None
    assert spark.conf.get(least) == "3"
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_null_keys_and_empty_batches(spark, store):
    assert store.read().count() == 0
    assert store.append(batch_of(spark, [])).fresh.count() == 0
    rows = [("f", "T", None, None, "10-K", "2020-01-01", 2020, "d", "p"), filing(1, "a")]
    assert store.append(batch_of(spark, rows)).fresh.count() == 2


def test_bitmap_probes_find_what_was_set(spark):
    df = spark.range(3000).select((F.col("id") * 7 % stores.BITS).alias("p"))
    bits = df.agg(F.bitmap_construct_agg("p").alias("bits"))
    probes = lambda at: F.array(*[F.lit(at).cast("bigint")] * stores.PROBES).alias("_probes")
    for at in (0, 7, 8, 693, 20_993, 1, 6, 9, 20_994):
        found = bits.select("bits", probes(at))
        assert found.select(stores._all_set("bits", "_probes")).first()[0] == (at % 7 == 0 and at < 21_000)


# -- mapping ---------------------------------------------------------------------------


def test_upsert_leaves_untouched_buckets_alone(spark, tmp_path):
    shape = "ticker string, company_name string, registered_seq long"
    first = [(f"t{i}", f"c{i}", i) for i in range(300)]
    again = [("t5", "renamed", 1_000), ("fresh", "new", 1_001), ("t5", "older", 900)]
    store = MappingStore(spark, str(tmp_path / "mapping"), buckets=16)
    assert store.read().count() == 0 and store.upsert(spark.createDataFrame([], shape)) == []
    assert store.upsert(spark.createDataFrame(first, shape)) == list(range(16))
    files = lambda: {str(p.relative_to(tmp_path)) for p in tmp_path.glob("mapping/rows/*/*/*.parquet")}
    bucket = lambda f: int(f.split("bucket=")[1].split("/")[0])
    before = files()
    touched = store.upsert(spark.createDataFrame(again, shape))
    assert 1 <= len(touched) <= 2
    assert before < files() and {bucket(f) for f in files() - before} == set(touched)
    plain = maps.upsert_mapping(schemas.empty(spark, schemas.MAPPING), spark.createDataFrame(first + again, shape))
    expected = sorted(tuple(map(str, r)) for r in plain.collect())
    held = lambda: sorted(tuple(map(str, r)) for r in store.read().collect())
    assert held() == expected
    store.upsert(spark.createDataFrame(again, shape))  # a replay
    assert held() == expected
    # Replaced files are gone after the next upsert, those of other buckets are still there.
    assert {f for f in before if f in files()} == {f for f in before if bucket(f) not in touched}


def test_an_upsert_that_dies_leaves_the_state_before(spark, tmp_path, monkeypatch):
    shape = "ticker string, registered_seq long"
    store = MappingStore(spark, str(tmp_path / "mapping"), buckets=4)
    store.upsert(spark.createDataFrame([("a", 1), ("b", 2)], shape))
    held = lambda: sorted((r.ticker, r.registered_seq) for r in store.read().collect())

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(store, "_publish", dies)
    again = spark.createDataFrame([("a", 5), ("c", 6)], shape)
    with pytest.raises(RuntimeError):
        store.upsert(again)
    assert held() == [("A", 1), ("B", 2)]
    monkeypatch.undo()
    store.upsert(again)
    assert held() == [("A", 5), ("B", 2), ("C", 6)]


# -- roll-up ---------------------------------------------------------------------------

DOCUMENT = "document_id string, firm_id string, fiscal_year int, text string"
TEXTS = ["ai and machine learning", "nothing here", "", None, "artificial intelligence ai"]


def document_batches():
    rng = random.Random(6)
    return [
        [(f"{b}-{i}", rng.choice(["f", "g", None]), rng.choice([2020, 2021, None]), rng.choice(TEXTS))
         for i in range(30)]
        for b in range(5)
    ]


@pytest.mark.parametrize("fold_after", [0, 2, 32])
def test_sums_of_batches_equal_the_whole(spark, tmp_path, fold_after):
    store = FirmYearStore(spark, str(tmp_path / "years"), fold_after)
    assert store.read().count() == 0
    batches = [spark.createDataFrame(rows, DOCUMENT) for rows in document_batches()]
    for number, batch in enumerate(batches):
        store.add(features.document_features(batch), number)
        store.add(features.document_features(batch), number)  # a replay
    whole = batches[0]
    for batch in batches[1:]:
        whole = whole.unionByName(batch)
    store.add(features.document_features(batches[1]), 1)
    expected = features.attention_firm_year(whole)
    assert store.read().schema.simpleString() == expected.schema.simpleString()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, store.read().collect())) == sorted(map(key, expected.collect()))


def test_parts_that_a_base_holds_count_once(spark, tmp_path, monkeypatch):
    """A death after the base was written and before its parts were deleted."""
    store = FirmYearStore(spark, str(tmp_path / "years"), 1)
    batches = [spark.createDataFrame(rows, DOCUMENT) for rows in document_batches()[:2]]
    store.add(features.document_features(batches[0]), 0)
    monkeypatch.setattr(rollup, "remove_folder", lambda *_: None)
    store.add(features.document_features(batches[1]), 1)
    expected = features.attention_firm_year(batches[0].unionByName(batches[1]))
    key = lambda r: tuple(map(str, r))
    assert store._folded() == 1
    assert sorted(map(key, store.read().collect())) == sorted(map(key, expected.collect()))


def test_roll_up_stream(spark, tmp_path):
    for number, rows in enumerate(document_batches()):
        spark.createDataFrame(rows, DOCUMENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(DOCUMENT).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    store = FirmYearStore(spark, str(tmp_path / "years"), 1)
    for _ in range(2):  # the second start finds nothing new
        roll_up_stream(stream, store, str(tmp_path / "checkpoint")).awaitTermination()
    expected = features.attention_firm_year(spark.read.parquet(str(tmp_path / "in")))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, store.read().collect())) == sorted(map(key, expected.collect()))


# -- publication -----------------------------------------------------------------------


def test_a_published_table_is_never_absent(spark, tmp_path):
    name, root = "published_panel", str(tmp_path / "table")
    publish = lambda n: sinks.publish_table(spark.range(n * 1000, n * 1000 + 50), name, root)
    publish(0)
    seen, failed, stop = set(), [], threading.Event()

    def reads():
        while not stop.is_set():
            try:
                rows = [r.id for r in spark.table(name).collect()]
                assert len(rows) == 50 and len({i // 1000 for i in rows}) == 1
                seen.add(rows[0] // 1000)
            except Exception as error:  # noqa: BLE001
                failed.append(str(error)[:300])

    reader = threading.Thread(target=reads)
    reader.start()
    for n in range(1, 6):
        publish(n)
    stop.set()
    reader.join()
    assert not failed and seen
    assert {r.id for r in spark.table(name).collect()} == set(range(5000, 5050))
    # The new rows may be made of the old ones, and the columns may change.
    sinks.publish_table(spark.table(name).where("id < 5010"), name, root)
    assert spark.table(name).count() == 10
    sinks.publish_table(spark.range(3).withColumn("more", F.lit("x")), name, root)
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 3
    assert len(list((tmp_path / "table").iterdir())) <= 2


# -- raw files -------------------------------------------------------------------------


def test_files_are_listed_and_read_by_executors(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"{i % 4}/{i % 7:03d}/f{i}.htm", rng.randbytes(rng.randrange(0, 500))) for i in range(60)]
    rows += [("top.txt", b"top"), ("a b/ü%20.htm", b"odd"), ("empty.htm", b"")]
    root = str(tmp_path / "raw")
    listing.write_files(spark.createDataFrame(rows, "path string, content binary").repartition(5), root)
    (tmp_path / "raw" / "_hidden").mkdir()
    (tmp_path / "raw" / "_hidden" / "x").write_bytes(b"no")
    (tmp_path / "raw" / ".part").write_bytes(b"no")
    files = listing.list_files(spark, root)
    assert files.columns == ["path", "length", "modified"]
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "BinaryFile" not in plan
    found = {r.path: bytes(r.content) for r in listing.read_listed(files, task_bytes=3_000).collect()}
    assert found == {f"{root}/{path}": content for path, content in rows}
    lengths = {r.path.removeprefix("file:"): r.length for r in files.collect()}
    assert lengths == {f"{root}/{path}": len(content) for path, content in rows}


def test_an_empty_tree(spark, tmp_path):
    (tmp_path / "none" / "deeper").mkdir(parents=True)
    files = listing.list_files(spark, str(tmp_path / "none"))
    assert files.count() == 0 and listing.read_listed(files).count() == 0


# -- sampling --------------------------------------------------------------------------


def chosen_by_hand(rows, size, seed=42):
    draw = lambda salt, i: hashlib.sha256(f"{seed}|{salt}{i}".encode()).hexdigest()
    bins = len({r[2] for r in rows if r[2] is not None})
    quota = max(1, size // max(1, bins))
    strata = {}
    for r in rows:
        strata.setdefault(r[1:], []).append(r[0])
    kept = [i for ids in strata.values() for i in sorted(ids, key=lambda i: (draw("", i), i))[:quota]]
    return sorted(sorted(kept, key=lambda i: (draw("second|", i), i))[:size])


@pytest.mark.parametrize("needed", [sampling._needed, lambda quota: 0.0, lambda quota: quota / 2])
@pytest.mark.parametrize("size", [7, 40, 1_000])
def test_sample_by_brute_force(spark, needed, size):
    """Also where the threshold lets too few or no rows through."""
    rng = random.Random(12)
    rows = [
        (f"d{i}", rng.choice([2020, 2020, 2020, 2021, None]), rng.choice(["zero", "zero", "low", None]))
        for i in range(600)
    ]
    pool = spark.createDataFrame(rows, "document_id string, fiscal_year int, density_bin string")
    out = sampling.choose_ids(pool.repartition(4), size, needed=needed)
    assert sorted(r.document_id for r in out.collect()) == chosen_by_hand(rows, size)


def test_threshold_lets_few_rows_through(spark):
    """What passes follows the quota, not the pool."""
    pool = spark.range(200_000).selectExpr(
        "cast(id AS string) AS document_id", "2020 AS fiscal_year", "'zero' AS density_bin"
    )
    chosen = sampling.choose_ids(pool, 50)
    assert chosen.count() == 50
    stages = chosen._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in stages
    assert sampling._needed(50) < 150


def test_bundles_take_each_file_once(spark, tmp_path):
    root, table = str(tmp_path / "raw"), "bundles_of_test"
    land = lambda rows: listing.write_files(
        spark.createDataFrame(rows, "path string, content binary"), root
    )
    land([("1/a.htm", b"a"), ("2/b.htm", b"b"), ("2/part.parquet", b"no")])
    assert stages.bundle_files(spark, root, table, 4) == 2
    assert stages.bundle_files(spark, root, table, 4) == 0
    land([("1/c.htm", b"c")])
    assert stages.bundle_files(spark, root, table, 4) == 1
    rows = {r.path: bytes(r.content) for r in spark.table(table).collect()}
    assert rows == {f"{root}/{p}.htm": p[-1].encode() for p in ("1/a", "2/b", "1/c")}
    assert spark.table(table).count() == 3
    spark.sql(f"DROP TABLE {table}")
