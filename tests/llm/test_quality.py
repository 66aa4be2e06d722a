"""The classifier's sums and pooling against plain Python, and its bounded vocabulary."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from panelloom.llm import quality

TEXTS = ["one two three two", "", None, "three", "a b c d e f g h one two", "same " * 9, "two, Three! é漢 9"]


def sums_by_hand(texts):
    hashes = quality.Hashes()
    total, seen = {}, {}
    for text in texts:
        names = quality.buckets(text or "", hashes).tolist()
        for i, name in enumerate(names):
            seen[name] = seen.get(name, 0) + 1
            row = total.setdefault(name, [0] * quality.WIDTH)
            for j in range(max(0, i - quality.REACH), min(len(names), i + quality.REACH + 1)):
                if j != i:
                    for k in range(quality.SPIKES):
                        row[quality.PLACE[names[j], k]] += int(quality.SIGN[names[j], k])
    return {name: (seen[name], *total[name]) for name in seen}


def test_context_sums_by_hand(spark):
    """Over several tasks; contexts never reach from one document into the next."""
    texts = TEXTS * 3
    frame = spark.createDataFrame([(t, "own") for t in texts], "text string, bucket string")
    rows = quality.context_sums(frame.repartition(4), "text").collect()
    assert {r.bucket: tuple(r)[1:] for r in rows} == sums_by_hand(texts)


def test_pooling_by_hand():
    found = sums_by_hand(TEXTS)
    names = sorted(found)
    sums = pa.table({
        "bucket": names, "n": [found[b][0] for b in names],
        **{c: [found[b][1 + i] for b in names] for i, c in enumerate(quality.COLUMNS)},
    })
    table = quality.vector_table(sums)
    width, everything = quality.WIDTH, sum(found[b][0] for b in names)
    common = [sum(found[b][1 + i] for b in names) / everything for i in range(width)]
    hashes = quality.Hashes()
    for text in TEXTS:
        tokens = quality.buckets(text or "", hashes).tolist()
        plain, weights = np.zeros(2 * width + 1), 0.0
        for name in tokens:
            count = found[name][0]
            context = [found[name][1 + i] - count * common[i] for i in range(width)]
            size = max(sum(x * x for x in context) ** 0.5, 1e-9)
            context = [x / size for x in context]
            own = [0.0] * width
            for k in range(quality.SPIKES):
                own[quality.PLACE[name, k]] += quality.SIGN[name, k] / quality.SPIKES**0.5
            weight = quality.SMOOTH / (quality.SMOOTH + count / everything)
            inner = sum(a * b for a, b in zip(context, own, strict=True))
            plain += weight * np.array([*context, *own, inner])
            weights += weight
        mean = plain / weights if weights else plain
        lengths = [np.linalg.norm(mean[:width]), np.linalg.norm(mean[width : 2 * width])]
        expected = [*mean, *lengths, np.log1p(len(tokens))]
        assert np.allclose(quality.pooled(text or "", table, hashes), expected, atol=1e-4)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="shared tables are absent")
def test_accuracy_with_many_words_a_bucket(monkeypatch):
    """A vocabulary hundreds of times the buckets costs little: words of a bucket share a vector."""
    small = 64
    monkeypatch.setattr(quality, "BUCKETS", small)
    docs = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    labels = pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pylist()
    label = {r["doc_id"]: r["quality"] for r in labels}
    hashes = quality.Hashes()
    texts = [d["text"] or "" for d in docs]
    vocabulary = {token for text in texts for token in quality.TOKEN.findall(text)}
    assert len(vocabulary) > 200 * small
    total = np.zeros((small, quality.WIDTH), np.int64)
    seen = np.zeros(small, np.int64)
    quality.add_contexts(total, seen, [quality.buckets(t, hashes) for t in texts])
    used = np.flatnonzero(seen)
    table = quality.vector_table(pa.table({
        "bucket": used, "n": seen[used],
        **{c: total[used, i] for i, c in enumerate(quality.COLUMNS)},
    }))
    rows = [d for d in docs if d["doc_id"] in label]
    vectors = np.stack([quality.pooled(d["text"] or "", table, hashes) for d in rows])
    known = np.array([label[d["doc_id"]] for d in rows])
    held = np.array([zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1 for d in rows])
    network = quality.Network(vectors[~held], known[~held])
    right = (network.scores(vectors[held]) >= 0.5) == known[held]
    assert right.mean() >= 0.9


def test_scored_texts_are_held_once(spark):
    """The text goes to Python within its document only."""
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1), (5, 0), (6, 1)], "doc_id bigint, quality int")
    scored = quality.score_documents(spark, docs, labels)
    sent = scored._jdf.queryExecution().optimizedPlan().children().apply(0).output()
    assert [sent.apply(i).name() for i in range(sent.size())] == ["_doc"]
    found = {r["_doc"].doc_id: (r["_doc"].text, r["_score"]) for r in scored.collect()}
    assert {i: text for i, (text, _) in found.items()} == dict(rows)
    # A text that is no column of its own is sent beside the document.
    inner = docs.selectExpr("doc_id", "struct(text) AS body")
    beside = quality.score_documents(spark, inner, labels, text_col="body.text").collect()
    assert {r["_doc"].doc_id: r["_score"] for r in beside} == {i: s for i, (_, s) in found.items()}


def test_scored_texts_come_back_in_slices():
    """A batch comes back some texts at a time, with the scores it has as a whole."""
    random = np.random.default_rng(3)
    names = [f"word{i}" for i in range(500)]
    texts = [None, "", *(" ".join(random.choice(names, n)) for n in random.integers(1, 8000, 120))]
    table = random.normal(size=(quality.BUCKETS, 2 * quality.WIDTH + 2)).astype(np.float32) ** 2
    hashes = quality.Hashes()
    vectors = np.stack([quality.pooled(t or "", table, hashes) for t in texts])
    network = quality.Network(vectors, np.arange(len(texts)) % 2)
    docs = pa.array([{"doc_id": i, "text": t} for i, t in enumerate(texts)])
    parts = list(quality.scored_slices(docs, docs.field(1), table, network, hashes))
    longest = max(len(t or "") for t in texts)
    assert sum(p.column("_doc").nbytes for p in parts) > 4 * quality.SLICE_BYTES
    assert all(p.column("_doc").nbytes < quality.SLICE_BYTES + longest + 16 * p.num_rows + 64 for p in parts)
    whole = pa.Table.from_batches(parts)
    assert whole.column("_doc").to_pylist() == docs.to_pylist()
    assert whole.column("_score").to_pylist() == network.scores(vectors).tolist()
