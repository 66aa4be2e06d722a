"""Hard negatives, WARC archives and clustering against plain Python."""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from panelloom.llm import hard_negatives, simplex_centroids, warc_ranges
from panelloom.llm.common import save_bytes

SHAPE = "vec_id bigint, embedding array<float>, label int"
CLASHES = ("_id", "_vec", "_q", "_label", "rank", "cluster", "anchor_id", "payload", "_payload", "path")


def with_clashes(df):
    return df.select("*", *[F.lit("own").alias(name) for name in CLASHES])


def random_rows(seed, count, dim, spread=1.0, labels=3):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(6, dim))
    rows = []
    for i in range(count):
        vector = centres[i % 6] + spread * random.normal(size=dim)
        rows.append((i, [float(np.float32(x)) for x in vector / np.linalg.norm(vector)],
                     int(random.integers(labels))))
    return rows


def usable(rows, dim):
    out = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or len(vector) != dim:
            continue
        if any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole = tuple(int(np.floor(256 * float(np.float32(x)))) for x in vector)
        out.append((vec_id, whole, label))
    return sorted(set(out))


def mined_by_hand(rows, dim, is_anchor, positives=5, negatives=10):
    plain = usable(rows, dim)
    found = []
    for anchor in (row for row in plain if is_anchor(row[0])):
        score = {row: sum(a * b for a, b in zip(anchor[1], row[1], strict=True)) for row in plain}
        ranked = sorted((row for row in plain if row != anchor), key=lambda r: (-score[r], r[0]))
        best = [row for row in ranked if row[2] == anchor[2]][:positives]
        for positive in best:
            p = score[positive]
            hard = [r for r in ranked if r[2] != anchor[2] and 30 * p <= 100 * score[r] <= 90 * p]
            found += [
                (anchor[0], positive[0], n, r[0], p, score[r])
                for n, r in enumerate(hard[:negatives], 1)
            ]
    return sorted(found)


def spoilt(rows, dim):
    """Rows that take no part, repeated rows, ties and ids shared by different rows."""
    extra = [
        (None, rows[1][1], 1), (7_000, None, 1), (7_001, rows[2][1], None), (7_002, [], 1),
        (7_003, [0.1] * (dim - 1), 1), (7_004, [float("nan"), *rows[0][1][1:]], 1),
        (7_005, [float("inf"), *rows[0][1][1:]], 1), (7_006, [None, *rows[0][1][1:]], 1),
        rows[0], rows[0], rows[3], (8_000, rows[3][1], rows[3][2]), (8_001, rows[3][1], 9),
        (rows[5][0], rows[6][1], 2), (8_002, [0.0] * dim, 1),
    ]
    return rows + extra


@pytest.mark.parametrize(("spread", "block"), [(1.0, 2_048), (0.05, 2_048), (0.3, 4)])
def test_hard_negatives_by_brute_force(spark, monkeypatch, spread, block):
    """Also with several anchor blocks and chunks, and for tight clusters."""
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", block)
    monkeypatch.setattr(hard_negatives, "CHUNK", 64)
    rows = spoilt(random_rows(3, 260, 8, spread), 8)
    df = with_clashes(spark.createDataFrame(rows, SHAPE)).repartition(4)
    out = hard_negatives.mine(spark, df, F.col("vec_id") % 10 == 0)
    assert out.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    expected = mined_by_hand(rows, 8, lambda i: i % 10 == 0)
    assert sorted(map(tuple, out.collect())) == expected and expected


def test_hard_negatives_of_large_numbers_are_exact(spark):
    """Beyond 2^53 a double would round."""
    rows = [(i, [3e5 + i * 7.1, 2e5 - i * 1.3, 1e5 + i], i % 2) for i in range(40)]
    out = hard_negatives.mine(
        spark, spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"),
        F.col("vec_id") % 10 == 0, low=30, high=100,
    ).collect()
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v, _ in rows}
    assert out
    for r in out:
        dot = sum(a * b for a, b in zip(whole[r.anchor_id], whole[r.negative_id], strict=True))
        assert dot == r.negative_score > 2**52


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame(random_rows(1, 5, 4), SHAPE)
    for none in (df.where("false"), df.withColumn("label", F.lit(None).cast("int"))):
        assert hard_negatives.mine(spark, none, F.col("vec_id") >= 0).count() == 0
    assert hard_negatives.mine(spark, df, F.col("vec_id") > 99).count() == 0
    assert hard_negatives.mine(spark, df, F.lit(None).cast("boolean")).count() == 0


def test_spanning_tree_is_minimal():
    random = np.random.default_rng(5)
    points = random.integers(-50, 50, (60, 5))
    order, parent, edge = hard_negatives.spanning_tree(points)
    assert sorted(order) == list(range(60)) and parent[0] == -1
    assert all(p < i for i, p in enumerate(parent))
    moved = points[order]
    assert np.allclose(edge[1:], np.linalg.norm(moved[1:] - moved[parent[1:]], axis=1))
    links = sorted(
        (float(np.linalg.norm(points[i] - points[j])), i, j) for i in range(60) for j in range(i)
    )
    group = list(range(60))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    least = 0.0
    for length, i, j in links:
        if root(i) != root(j):
            group[root(i)] = root(j)
            least += length
    assert np.isclose(edge.sum(), least)


def test_tree_bounds_spare_scores():
    """In tight clusters most candidates never meet most anchors' vectors."""
    rows = random_rows(9, 4_000, 16, 0.02, labels=2)
    vectors = np.array([[int(np.floor(256 * x)) for x in v] for _, v, _ in rows])
    order, parent, edge = hard_negatives.spanning_tree(vectors[:200])
    tree = pa.table({
        "_node": list(range(200)), "_parent": parent.tolist(), "_edge": edge.tolist(),
        "_id": [int(i) for i in order], "_label": [rows[i][2] for i in order],
        "_vec": vectors[:200][order].tolist(),
    })
    table = pa.table({
        "_id": pa.array(range(4_000), pa.int64()), "_vec": vectors.tolist(),
        "_label": pa.array([r[2] for r in rows], pa.int64()),
    })
    anchors = hard_negatives.Anchors(tree, 16)
    goals = [hard_negatives.Windows([(-np.inf, np.inf)], 5) for _ in anchors.nodes]
    scored = hard_negatives.walk(table, anchors, goals, 16, True)
    assert scored < 0.3 * 200 * 2_000


# -- clustering ------------------------------------------------------------------------


def clustered_by_hand(rows, k, rounds, dim):
    kept = [
        (i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, v in rows
        if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)
    ]
    order = sorted(
        kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    )
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min(
            (sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)
        )

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, members in groups.items():
            centroids[n] = tuple(sum(x) // len(members) for x in zip(*members, strict=True))
    placed = [(i, *nearest(v)) for i, v in kept]
    inertia = {}
    for _, d, n in placed:
        inertia[n] = inertia.get(n, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i, n, d, inertia[n], sum(inertia.values()), digest[n]) for i, d, n in placed), key=repr
    )


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_clusters_by_brute_force(spark, spread):
    rows = [(i, v) for i, v, _ in spoilt(random_rows(4, 150, 6, spread), 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    out = simplex_centroids.cluster(spark, with_clashes(df).repartition(3), k=9, rounds=3, dim=6)
    found = sorted(map(tuple, out.collect()), key=repr)
    assert found == clustered_by_hand(rows, 9, 3, 6)


def test_clusters_of_few_equal_and_no_vectors(spark):
    shape = "vec_id bigint, embedding array<float>"
    same = [(i, [0.5, -0.25]) for i in range(7)]
    out = simplex_centroids.cluster(spark, spark.createDataFrame(same, shape), k=3, rounds=2, dim=2)
    assert {(r.cluster, r.distance, r.inertia) for r in out.collect()} == {(0, 0, 0)}
    assert out.count() == 7
    few = spark.createDataFrame(same[:1], shape)
    assert simplex_centroids.cluster(spark, few, k=40, rounds=1, dim=2).count() == 1
    for none in (few.where("false"), few.withColumn("embedding", F.lit(None).cast("array<float>"))):
        assert simplex_centroids.cluster(spark, none, dim=2).count() == 0


def test_apex_bounds_hold_and_filter():
    random = np.random.default_rng(2)
    points = random.integers(-128, 128, (500, 24)) // np.arange(1, 25)
    simplex = simplex_centroids.Simplex(points[:200])
    apexes = simplex.apexes(points)
    gap = points[:, None, :] - points[None, :40, :]
    true = (gap**2).sum(axis=2).astype(float)
    low = ((apexes[:, None, :] - apexes[None, :40, :]) ** 2).sum(axis=2)
    high = low + 4 * apexes[:, None, -1] * apexes[None, :40, -1]
    room = simplex_centroids.ROOM * (true + 1e4)
    assert (low <= true + room).all() and (true <= high + room).all()
    centroids = simplex_centroids.Centroids(points[:40], simplex)
    number, distance, compared = centroids.nearest(points, apexes)
    assert (distance == true.min(axis=1)).all() and (number == true.argmin(axis=1)).all()
    assert compared < 0.5 * 500 * 40


def test_simplex_of_flat_samples():
    """Points on a line, and equal points, span fewer pivots."""
    line = np.outer(np.arange(50), np.array([3, -4, 0]))
    assert len(simplex_centroids.Simplex(line).pivots) == 2
    assert len(simplex_centroids.Simplex(np.ones((5, 3), np.int64)).pivots) == 1


# -- archives --------------------------------------------------------------------------


LONG = "".join(f"<p>{i * 7919 % 99_991}</p>" for i in range(200_000))
PAGES = [
    (1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, None), (4, "http://b/ é\r\nX: y", ""),
    (5, "http://b/5", LONG), (None, "http://b/6", "same"), (7, "u", "WARC/1.1\r\n\r\nnot a record"),
    (8, "u", "\r\n\r\nHTTP/1.1 200 OK"), (2, "http://again", "same"), (9, "x", "漢字 \x00"),
    (1, "http://a/1", "same"), (None, None, "alone"), (None, None, "alone"),
]


def archive_rows(spark, pages, tmp, **options):
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    archives = warc_ranges.write_archives(spark, with_clashes(df).repartition(3), **options)
    return archives


@pytest.mark.parametrize(("range_bytes", "archive_bytes"), [(1 << 20, 1 << 30), (97, 300), (1000, 1 << 30)])
def test_archives_round_trip(spark, tmp_path, range_bytes, archive_bytes):
    archives = archive_rows(spark, PAGES, tmp_path, archive_bytes=archive_bytes)
    rows = warc_ranges.read_archives(spark, archives, range_bytes).collect()
    pages = [r for r in rows if r.record_type != "warcinfo"]
    least = {}
    for i, _, html in PAGES:
        if i is not None:
            least[html or ""] = min(i, least.get(html or "", i))
    expected = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        again = html and html in least and i != least[html] or (not html and i != least[""])
        expected.append((
            None if i is None else str(i), len(data), warc_ranges.digest(data),
            "revisit" if again else "response", str(least[html or ""]) if again else None,
            None if again else data,
        ))
    found = [
        (r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
         None if r.payload is None else bytes(r.payload)) for r in pages
    ]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert {r.url for r in pages if r.id == "4"} == {"http://b/%20%C3%A9%0D%0AX:%20y"}
    if archive_bytes == 300:
        assert archives.count() > 3


def test_archives_are_plain_gzip_members(spark, tmp_path):
    archives = archive_rows(spark, PAGES[:3], tmp_path).collect()
    for row in archives:
        with open(row.path.removeprefix("file:"), "rb") as file:
            raw = file.read()
        assert len(raw) == row.size
        text = gzip.decompress(raw)
        assert text.count(b"WARC/1.1\r\n") == row.n_records + 1
        assert zlib.decompressobj(31).decompress(raw).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_threshold_of_revisits(spark, tmp_path):
    archives = archive_rows(spark, PAGES, tmp_path, least_revisit=1)
    rows = warc_ranges.read_archives(spark, archives, payloads=False)
    kinds = {(r.id, r.record_type) for r in rows.collect() if r.payload_bytes == 0}
    assert kinds == {("3", "response"), ("4", "response"), (None, "warcinfo")} or kinds == {
        ("3", "response"), ("4", "response")}
    assert rows.where("payload is not null").count() == 0


def test_no_pages(spark, tmp_path):
    archives = archive_rows(spark, PAGES[:1], tmp_path).where("false")
    assert warc_ranges.read_archives(spark, archives).count() == 0
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc_ranges.write_archives(spark, none).count() == 0


@pytest.mark.parametrize("range_bytes", [50, 333, 5_000, 1 << 20])
def test_members_inside_a_payload_and_junk_between(spark, range_bytes):
    """An archive stored as it is inside a record, broken members, and bytes that are none."""
    inner = [warc_ranges.record(f"inner{i}", "u", bytes([i]) * 40, None) for i in range(8)]
    blob = b"".join(inner) + warc_ranges.MAGIC * 20
    head = b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:outer>\r\n"
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)  # level 0 stores the bytes unchanged
    outer = packer.compress(head + f"Content-Length: {len(blob)}\r\n\r\n".encode() + blob + b"\r\n\r\n")
    outer += packer.flush()
    assert inner[3] in outer
    plain = [warc_ranges.record(f"r{i}", "u", b"x" * (i * 50), None) for i in range(6)]
    cut = plain[0][: len(plain[0]) // 2]
    data = b"".join([
        plain[0], outer, plain[1], b"\x00" * 70, plain[2], warc_ranges.MAGIC + b"junk", plain[3],
        cut, plain[4], gzip.compress(b"no record"), outer, plain[5],
    ])
    path = save_bytes(spark, data, "odd.warc.gz")
    if not path.startswith("file:"):
        path = f"file:{path}"
    files = spark.createDataFrame([(path, len(data))], "path string, size bigint")
    rows = warc_ranges.read_archives(spark, files, range_bytes).collect()
    assert sorted(r.id for r in rows) == sorted([f"r{i}" for i in range(6)]
                                                + ["urn:x:outer"] * 2)
    assert all(bytes(r.payload) == blob for r in rows if r.id == "urn:x:outer")


def test_wrong_digest_raises(spark):
    good = gzip.decompress(warc_ranges.record("1", "u", b"payload", None))
    bad = io.BytesIO()
    with gzip.GzipFile(fileobj=bad, mode="wb") as file:
        file.write(good.replace(b"payload\r\n", b"paylaod\r\n"))
    path = save_bytes(spark, bad.getvalue(), "bad.warc.gz")
    path = path if path.startswith("file:") else f"file:{path}"
    files = spark.createDataFrame([(path, len(bad.getvalue()))], "path string, size bigint")
    with pytest.raises(Exception, match="does not fit its digest"):
        warc_ranges.read_archives(spark, files).collect()


def test_op12_reads_what_pages_hold(spark):
    from panelloom.llm.queries import QUERIES

    pages = pq.read_table("/root/testdata/sf0.001/pages.parquet").to_pylist()
    rows = {r.page_id: r for r in QUERIES["op12_warc"](spark, "/root/testdata/sf0.001").collect()}
    assert set(rows) == {p["page_id"] for p in pages}
    for page in pages:
        data = (page["html"] or "").encode()
        assert rows[page["page_id"]].payload_digest == warc_ranges.digest(data)
        assert rows[page["page_id"]].payload_bytes == len(data)
