"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from panelloom.llm import (
    bloom_digest,
    chat_tree,
    chosen_path,
    line_runs,
    mixing,
    passage_chunks,
    pieces,
    posting_lists,
    quality,
    url_rules,
)
from panelloom.llm.graph import components
from panelloom.llm.queries import MODEL, QUERIES, URL_RULES

WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(f"long{i * 7919 % 50_021}" for i in range(60_000))
PROSE = " ".join(WORDS[:120])
NEAR = " ".join([*WORDS[:119], "changed"])
ROWS = [
    (1, PROSE, "a", 5),
    (1, PROSE, "a", 5),
    (2, None, None, None),
    (None, PROSE, None, None),
    (3, "", "a", 0),
    (4, LONG, "b", 1),
    (5, NEAR, "b", 1),
    (6, "one line here ok\n\nONE line here ok \nx", "b", 1),
    (7, " one LINE here ok\nother words", "a", 1),
    (8, " \t\n ", None, 1),
    (9, "é▁ü 漢字 \x00 <s> |> \U0001f600", "b", 1),
    (10, None, "b", None),
]
# Columns that operators use inside have the same names here.
CLASHES = ("_id", "_text", "_doc", "_class", "_kept", "_size", "_score", "ids", "label", "rank")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, source string, n_chars bigint")
    return df.select("*", *[F.lit("own").alias(name) for name in CLASHES]).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id = -5")


def own_columns_survive(rows, docs):
    assert len(rows) == len(ROWS)
    for row in rows:
        assert {row[name] for name in CLASHES} == {"own"}


def test_pieces(docs, none):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    coded = pieces.encode_texts(docs, MODEL)
    rows = coded.select("_doc.doc_id", "_doc.*", "ids", "begins", "ends", "decoded", "span_bytes")
    texts = {(r[0], hashlib.md5((r[1] or "").encode()).hexdigest()): r[1] or "" for r in ROWS}
    found = coded.select("_doc.*", F.struct("ids", "begins", "ends", "decoded", "span_bytes").alias("out"))
    collected = found.collect()
    assert len(collected) == len(ROWS)
    for row in collected:
        out = row.out
        ids = np.frombuffer(out["ids"], "<u4").tolist()
        text = next(t for (k, _), t in texts.items() if k == row.doc_id)
        assert ids == model.encode(text, add_bos=True, add_eos=True)
        assert out["decoded"] == model.decode(ids)
        raw = text.encode()
        spans = zip(np.frombuffer(out["begins"], "<u4"), np.frombuffer(out["ends"], "<u4"), strict=True)
        assert b"".join(raw[a:b] for a, b in spans) == raw
        assert out["span_bytes"] == len(raw)
    assert rows.count() == len(ROWS)
    assert pieces.encode_texts(none, MODEL).count() == 0
    assert pieces.encode_texts(docs.select("text"), MODEL).count() == len(ROWS)


def test_character_map():
    """The map of a published rule set, against the library's own normaliser."""
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = pieces.model_format.ModelProto()
    spec.ParseFromString(normalizer.serialized_model_proto())
    charmap = pieces.CharacterMap(spec.normalizer_spec.precompiled_charsmap)
    coder = pieces.Codec(MODEL)
    coder.map, coder.squeeze, coder.prefix, coder.space = charmap, False, False, b" "
    for text in ["ｆｕｌｌ ﬁne ①②", "e\u0301\u00a0x", "ﷺ", "㌔ か\u3099", "plain", "tab\tline\n", "", "Ω≈ç√"]:
        raw, align = coder.normalise(text)
        assert raw.decode() == normalizer.normalize(text).replace("▁", " ") or raw.decode().split() == (
            normalizer.normalize(text).replace("▁", " ").split()
        )
        assert len(align) == len(raw) + 1 and (np.diff(align) >= 0).all()
        assert align[-1] == len(text.encode())


def test_decode_matches_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    coder = pieces.Codec(MODEL)
    random = np.random.default_rng(1)
    special = [0, 1, 2, 3, 35, 130, 229, 233, 259, 28705]
    for _ in range(2000):
        ids = [
            int(random.choice(special) if random.random() < 0.5 else random.integers(32_000))
            for _ in range(random.integers(0, 7))
        ]
        assert coder.decode(ids) == model.decode(ids), ids


def test_chat_tree(spark):
    text = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 1, "assistant", "yo"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "other"), (2, None, "system", None),
        (3, 0, None, text), (3, 1, "assistant", "\\<| <\\| \\\\ " + text), (4, 0, "ro\nle<|", ""),
        (None, 0, "user", "hi"), (None, 1, "assistant", LONG),
    ]
    schema = "conv_id bigint, turn bigint, role string, text string"
    frame = spark.createDataFrame(rows, schema).withColumn("_conv", F.lit("own"))
    tree, conversations = chat_tree.format_tree(spark, frame)
    back = {r.conv: r for r in chat_tree.read_back(tree, conversations).collect()}
    groups = {}
    for conv, turn, role, body in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", body or ""))
    assert set(back) == set(groups)
    for conv, turns in groups.items():
        turns.sort()
        assert [(t["role"], t["text"]) for t in back[conv].turns] == [t[2:] for t in turns]
        assert back[conv].loss_text == "".join(t[3] for t in turns if t[2] == "assistant")
    nodes = tree.orderBy("start").collect()
    # 'hi' is shared by conversations 1 and null; 2 begins with its system turn.
    assert len(nodes) == len(rows) - 1
    at = 0
    places = {}
    for node in nodes:
        assert node.start == at and node.length == len(node.segment)
        at += node.length
        places[node.start] = node
        assert node.attends[-1]["to"] == node.start + node.length
        assert all(a["to"] < b["from"] for a, b in zip(node.attends, node.attends[1:], strict=False))
        assert node.position == sum(r["to"] - r["from"] for r in node.attends) - node.length
        for r in node.attends[:-1]:  # ancestors come before and are attended to by their path
            assert r["from"] in places
    tree, conversations = chat_tree.format_tree(spark, frame.where("conv_id = -9"))
    assert tree.count() == conversations.count() == 0


def test_near_duplicates(spark, docs, none):
    rows = chosen_path.join_documents(spark, docs).collect()
    assert len(rows) == len(ROWS)
    by_id = {r._id: r for r in rows}
    assert by_id[1].class_id == by_id[5].class_id == by_id[chosen_path.LAST].class_id == 1
    assert by_id[1].n_copies == 3 and by_id[1].n_links == 3 and by_id[5].n_links == 3
    # Texts without words are copies of each other.
    assert {by_id[i].class_id for i in (2, 3, 8, 10)} == {2}
    assert by_id[4].n_links == by_id[9].n_links == 0
    kept = chosen_path.keep_one(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 6, 7, 9]
    assert chosen_path.join_documents(spark, none).count() == 0
    assert chosen_path.keep_one(spark, none).count() == 0


def test_tokens_of_long_unrelated_texts_differ():
    random = np.random.default_rng(9)
    one, two = (chosen_path.minwise(random.integers(0, 1 << 63, 100_000, np.uint64) * np.uint64(2))
                for _ in range(2))
    assert (one == two).mean() < 0.05


def test_links_count_once_beside_empty_blocks(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "BLOCK_GRAMS", 20)
    rows = [(i * 2 + j, " ".join([*(f"t{i}x{w}" for w in range(119)), f"end{j}"]))
            for i in range(12) for j in range(2)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    joined = chosen_path.join_documents(spark, frame).collect()
    assert [r.n_links for r in joined] == [1] * len(rows)


def test_unrelated_texts_under_one_id_stay(spark):
    other, third = " ".join(WORDS[150:260]), " ".join(WORDS[280:390])
    rows = [(None, PROSE), (None, other), (None, other), (None, NEAR), (7, third), (7, other[:300]),
            (7, third), (9, third)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = chosen_path.keep_one(spark, frame).collect()
    assert len(kept) == 4
    texts = {(r.doc_id, r.text) for r in kept}
    assert (None, other) in texts and {(7, third), (7, other[:300])} <= texts
    assert len(texts & {(None, PROSE), (None, NEAR)}) == 1
    joined = chosen_path.join_documents(spark, frame).collect()
    assert len(joined) == len(rows) and len({r._label for r in joined}) == 4
    assert {(r.class_id, r.n_copies, r.n_links) for r in joined} == {
        (chosen_path.LAST, 1, 1), (chosen_path.LAST, 2, 1), (7, 3, 2), (7, 1, 0)
    }


def test_pairs_in_large_nodes_are_candidates(spark, monkeypatch):
    """Pairs at the threshold among thousands that are made of shared passages: every token
    has one of two values, so all nodes are large, and unrelated sets agree in half."""
    monkeypatch.setattr(chosen_path, "MARGIN", 0.1)  # keeps unrelated sets apart here
    random = np.random.default_rng(6)
    pairs = 2000
    tokens = random.integers(0, 2, (pairs, chosen_path.SLOTS)).astype(np.uint16)
    twins = tokens.copy()
    for twin in twins:
        twin[random.permutation(chosen_path.SLOTS)[:26]] ^= 1
    rows = [(i, r.tobytes()) for i, r in enumerate(np.concatenate([tokens, twins]))]
    frame = spark.createDataFrame(rows, "_class bigint, _tokens binary").repartition(4)
    edges = chosen_path._candidates(spark, frame, chosen_path.THRESHOLD, chosen_path.RUNS)
    groups = {r.node: r.label for r in components(spark, edges, "_a", "_b").collect()}
    missed = sum(groups.get(i, -1) != groups.get(i + pairs, -2) for i in range(pairs))
    print(f"missed {missed} of {pairs}")
    assert missed <= 0.002 * pairs
    assert len(set(groups.values())) > pairs / 2


def test_large_nodes_in_blocks(spark, monkeypatch):
    """Groups that fill blocks, small groups and single classes of one node in blocks of 8."""
    monkeypatch.setattr(chosen_path, "BLOCK_NODES", 8)
    random = np.random.default_rng(8)
    template = random.integers(0, 1 << 16, chosen_path.SLOTS).astype(np.uint16)
    tokens = []
    for size in [60, 30, *[2] * 20, *[1] * 20]:
        base = template.copy()
        base[random.permutation(chosen_path.SLOTS)[:64]] = random.integers(0, 1 << 16, 64)
        for _ in range(size):
            tokens.append(base.copy())
            tokens[-1][random.integers(chosen_path.SLOTS)] = random.integers(1 << 16)
    tokens = np.array(tokens)
    alike = (tokens[:, None] == tokens[None]).mean(axis=2) >= 0.65
    frame = spark.createDataFrame(
        [(i, r.tobytes()) for i, r in enumerate(tokens)], "_class bigint, _tokens binary"
    )
    edges = chosen_path._candidates(spark, frame, chosen_path.THRESHOLD, chosen_path.RUNS)
    found = {r.node: r.label for r in components(spark, edges, "_a", "_b").collect()}
    label = chosen_path._rooted(len(tokens), *np.nonzero(alike))
    for i, one in enumerate(label):
        for j in range(i):
            assert (label[j] == one) == (found.get(i, -i - 1) == found.get(j, -j - 1))


def test_url_rules(spark):
    urls = [
        None, "", "no scheme", "http://", "http://net", "http://net/", "https://A.B.NET/x?y",
        "http://example.net/en/1", "http://x.example.net/enx", "ftp://example.com/de/",
        "http://org/fr/", "http://notnet/x", "http://net#/", "a://b://net/x", "http://net/\n?q",
        "http://" + "a." * 2000 + "net/" + "p" * 20_000,
    ]
    frame = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)] * 2,
                                  "page_id int, url string, host string")
    rows = url_rules.judge_urls(spark, frame, URL_RULES).collect()
    assert len(rows) == 2 * len(urls) and {r.host for r in rows} == {"own"}
    found = {r.page_id: r._url for r in rows}
    assert [found[i]["rule"] for i in range(len(urls) - 1)] == [
        None, None, None, None, None, "net/", "net/", "example.net/en/", "net/", "example.com/de/",
        "org/fr/", None, None, None, "net/",
    ]
    assert found[15]["rule"] == "net/" and found[7]["verdict"] == "allow"
    assert found[13]["host"] == "b:" and found[14]["path"] == "/\n"
    assert url_rules.judge_urls(spark, frame.where("page_id < 0"), URL_RULES).count() == 0
    assert url_rules.judge_urls(spark, frame, []).where("_url.rule is not null").count() == 0


def test_urls_keep_columns_of_any_name(spark):
    frame = spark.createDataFrame(
        [("http://example.com/de/x", 1, 2, 3, 4, 5)],
        "url string, _host int, _path int, _verdict int, `a.b` int, host int",
    )
    row = url_rules.judge_urls(spark, frame, URL_RULES).first()
    assert [row[name] for name in ("_host", "_path", "_verdict", "a.b", "host")] == [1, 2, 3, 4, 5]
    assert tuple(row._url) == ("example.com", "/de/x", "example.com/de/", "block")
    named = frame.withColumn("_url", F.lit("own"))
    with pytest.raises(ValueError):
        url_rules.judge_urls(spark, named, URL_RULES)
    row = url_rules.judge_urls(spark, named, URL_RULES, into="judged").first()
    assert row._url == "own" and row.judged.verdict == "block"


def test_url_digest_collisions(tmp_path, monkeypatch):
    """Equal digests never decide: the stored string does."""
    monkeypatch.setattr(url_rules, "_digest", lambda text: len(text) % 2)
    path = tmp_path / "index"
    path.write_bytes(url_rules.build_index([("a.b", "/x", "block"), ("c.d", "/", "allow")]))
    index = url_rules.DigestIndex(str(path))
    assert index.judge(["a.b", "z.z", "q.c.d"], ["/xy", "/xy", "/"]) == [
        ("a.b/x", "block"), None, ("c.d/", "allow")
    ]


def test_line_runs(spark, docs, none):
    rows = line_runs.dedupe_lines(spark, docs, batches=3).collect()
    own_columns_survive([r._doc for r in rows], docs)
    kept = {r._doc.doc_id: r for r in rows}
    assert kept[1]._kept == PROSE and kept[None]._kept == "" and kept[None]._n_dropped == 1
    assert kept[6]._kept == ROWS[7][1] and kept[6]._n_lines == 4
    assert kept[7]._kept == "other words" and kept[7]._n_dropped == 1
    assert kept[2]._kept == kept[3]._kept == "" and kept[2]._n_lines == 1
    assert kept[4]._kept == LONG
    assert line_runs.dedupe_lines(spark, none).count() == 0


def test_levels_are_compacted(spark):
    store = line_runs.LineRuns(spark, fanout=2)
    for i in range(5):
        store.add(spark.createDataFrame([(i, f"a line of number {i}\nshared by all of them")],
                                        "doc_id bigint, text string"))
    assert [len(level) for level in store.levels] == [1, 0, 1]
    runs = store.runs()
    assert runs.count() == runs.select("_h1", "_h2").distinct().count() == 6
    assert runs.where("_first = 0").count() == 2


def _line_batches(spark, count):
    return [
        spark.createDataFrame(
            [(10 * i + j, f"line {j % 4} of batch {i}\nthe line of everyone\nseen from {i // 2} on")
             for j in range(6)],
            "doc_id bigint, text string",
        )
        for i in range(count)
    ]


@pytest.mark.parametrize("fanout", [2, 3])
def test_runs_against_plain_python(spark, fanout):
    """First documents, marks of repeated keys and stripped texts, over several levels."""
    store, batches = line_runs.LineRuns(spark, fanout=fanout), _line_batches(spark, 7)
    for batch in batches:
        store.add(batch)
    rows = [row for batch in batches for row in batch.collect()]
    holders = {}
    for row in rows:
        for line in row.text.split("\n"):
            holders.setdefault(line, []).append(row.doc_id)
    assert sorted(r._first for r in store.runs().collect()) == sorted(map(min, holders.values()))
    assert sorted(r._first for r in store.repeated().collect()) == sorted(
        min(ids) for ids in holders.values() if len(set(ids)) > 1
    )
    docs = functools.reduce(type(batches[0]).unionByName, batches)
    kept = {r._doc.doc_id: r._kept for r in store.strip(docs).collect()}
    assert kept == {
        row.doc_id: "\n".join(
            line for line in row.text.split("\n") if min(holders[line]) == row.doc_id
        )
        for row in rows
    }


def test_runs_stay_where_they_are(spark, monkeypatch):
    """Only a batch is shuffled and sorted; runs are read and merged in their order."""
    plans, write = [], line_runs.LineRuns._write

    def spy(self, keys):
        with line_runs._sorted_buckets(self.spark):
            plans.append(keys._jdf.queryExecution().executedPlan().toString())
        return write(self, keys)

    monkeypatch.setattr(line_runs.LineRuns, "_write", spy)
    store = line_runs.LineRuns(spark)
    for batch in _line_batches(spark, 4):
        store.add(batch)
    shape = [(p.count("Exchange "), p.count("Sort ["), p.count("SortMergeJoin ")) for p in plans]
    batch, merge = (1, 1, 1), (0, 0, 1)
    assert shape == [(1, 0, 0), batch, merge, batch, (1, 1, 2), merge, merge]
    assert spark.conf.get(line_runs.IN_ORDER) == "false"


def test_mixing(spark, docs, none):
    drawn = mixing.draw_words(spark, docs).collect()
    assert len(drawn) == len(ROWS)
    again = mixing.draw_words(spark, docs.repartition(2)).collect()
    assert sorted(map(str, drawn)) == sorted(map(str, again))
    taken = {}
    for row in drawn:
        words = sum(d["words"] for d in row._draws)
        assert words <= 3 * row._size
        taken[row._source] = taken.get(row._source, 0) + words
        assert row._source in ("a", "b", None)
    targets = {r._source: r._target for r in drawn}
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 1
    mixed = mixing.mix(spark, docs, whole=True)
    assert {r._doc["_id"] for r in mixed.collect()} == {"own"}
    assert mixing.draw_words(spark, none).count() == mixing.mix(spark, none).count() == 0


@pytest.mark.parametrize("size", [1, 7, 100])
def test_splitting_tree_is_exact(size):
    tree = mixing.SplittingTree([40, 0, 300, 7], size, 3)
    shards = np.zeros((size, 4), int)
    for sid, quota in enumerate([40, 0, 300, 7]):
        for j in range(quota):
            shards[tree.shard(sid, j), sid] += 1
    assert shards.sum(axis=0).tolist() == [40, 0, 300, 7]
    assert shards.sum(axis=1).tolist() == [tree.held(i, i + 1) for i in range(size)]


def test_shards_against_a_plain_walk(spark):
    """Quotas of every shard, disjoint draws, and the order inside shards."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = mixing.draw_words(spark, docs).collect()
    blocks = {}
    for row in rows:
        for draw in row._draws:
            key = (row._source, draw["block"])
            # A drawn block is in one shard only, whoever of its documents is asked.
            assert blocks.setdefault(key, draw["shard"]) == draw["shard"]
    words = sum(r._size for r in rows)
    sizes = {}
    for row in rows:
        sizes[row._source] = sizes.get(row._source, 0) + row._size
    plan = mixing._plan(sizes, mixing.WEIGHTS, 3, mixing._block_words(words), mixing.SEED)
    quotas = []
    for name, sid, size, target, full, rest, count, steps, shifts in plan:
        # Blocks whose number is drawn but that hold no document leave no trace in the rows.
        seen = [b for s, b in blocks if s == name]
        assert max(seen) < full * count + count
        partial = [0] * count
        held = {}
        for row in (r for r in rows if r._source == name):
            held.setdefault(row._id, row)
        last = full * count - 1
        units = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(
            F.col("source").eqNullSafe(F.lit(name))
        ).select("doc_id", F.xxhash64(F.lit(mixing.SEED), "doc_id", F.coalesce("text", F.lit(""))).alias("h"))
        for r in units.collect():
            block = int(((r.h % (1 << 64)) >> 11) / float(1 << 53) * count)
            partial[(block * steps[full] + shifts[full]) % count] += held[r.doc_id]._size
        left = rest
        for place, size_of in enumerate(partial):
            if left <= 0:
                break
            left -= size_of
            last = full * count + place
        quotas.append(last + 1)
    total = max(mixing.SHARDS, -(-sum(quotas) // mixing.MOST_BLOCKS))
    assert total >= 8
    plain = {}
    random_tree = mixing.SplittingTree(quotas, total, mixing.SEED)

    def walk(low, high, counts):
        if high - low == 1:
            return {low: counts}
        middle = (low + high) // 2
        draw = np.random.default_rng([mixing.SEED, low, high])
        left = draw.multivariate_hypergeometric(
            np.array(counts), random_tree.held(low, middle), method="marginals"
        )
        return walk(low, middle, left.tolist()) | walk(
            middle, high, (np.array(counts) - left).tolist()
        )

    shares = walk(0, total, quotas)
    assert len(shares) == total and [sum(c) for c in zip(*shares.values(), strict=True)] == quotas
    assert max(map(sum, shares.values())) - min(map(sum, shares.values())) <= 1
    for sid, row in enumerate(plan):
        number = 0
        for shard in range(total):
            for _ in range(shares[shard][sid]):
                plain[(row[0], number)] = shard
                number += 1
    assert all(plain[key] == shard for key, shard in blocks.items())
    assert len(set(blocks.values())) >= 8


def test_written_shards_are_shuffled_inside(spark, docs, tmp_path):
    mixed = mixing.mix(spark, docs, whole=True, shards=4)
    path = str(tmp_path / "shards")
    mixing.write_shards(mixed, path)
    back = spark.read.parquet(path)
    key = lambda r: (str(r._doc["doc_id"]), r._pass, r._shard, r._order)
    assert sorted(map(key, back.collect())) == sorted(map(key, mixed.collect()))
    for folder in sorted(tmp_path.glob("shards/_shard=*")):
        for file in folder.glob("*.parquet"):
            orders = [r._order for r in spark.read.parquet(str(file)).collect()]
            assert orders == sorted(orders)


def test_targets_by_brute_force():
    random = np.random.default_rng(2)
    for _ in range(200):
        sizes = {f"s{i}": int(random.integers(0, 50)) ** 2 for i in range(random.integers(1, 9))}
        sizes[None] = 5
        found = mixing.source_targets(sizes)
        assert sum(found.values()) == pytest.approx(sum(sizes.values()))
        assert all(found[k] <= 3 * sizes[k] + 1e-6 for k in sizes)
        free = {k: v for k, v in found.items() if v < 3 * sizes[k] - 1e-6}
        order = sorted(sizes, key=lambda k: (k is None, k or ""))
        rates = {round(v / (5, 2, 1)[order.index(k) % 3], 6) for k, v in free.items()}
        assert len(rates) <= 1


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (5, None, 0), (6, 0, 1), (None, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    rows = quality.score_documents(spark, docs, labels).collect()
    own_columns_survive([r._doc for r in rows], docs)
    assert all(0 <= r._score <= 1 for r in rows)
    same = {}
    for r in rows:
        assert same.setdefault(r._doc.text or "", r._score) == r._score
    unlabelled = quality.score_documents(spark, docs, labels.where("doc_id = 99")).collect()
    assert {r._score for r in unlabelled} == {0.5}
    assert quality.score_documents(spark, none, labels).count() == 0


def test_passages(spark, docs, none):
    rows = passage_chunks.strip_passages(spark, docs).collect()
    own_columns_survive([r._doc for r in rows], docs)
    kept = {r._doc.doc_id: r._kept for r in rows}
    assert kept[1] == PROSE and kept[4] == LONG and kept[9] == ROWS[10][1]
    assert len(kept[None].split()) < 20 and len(kept[5].split()) < 20
    assert kept[2] == kept[3] == ""
    assert passage_chunks.strip_passages(spark, none).count() == 0


def test_chunks_come_back_after_an_insertion():
    text = " ".join(f"word{i * 37 % 1000}" for i in range(500)).encode()
    changed = text[:40] + b"inserted words " + text[40:]
    one = {text[a:b] for a, b in zip(*_bounds(text), strict=True)}
    two = {changed[a:b] for a, b in zip(*_bounds(changed), strict=True)}
    assert len(one & two) > 0.95 * len(one)


def test_passages_of_texts_that_share_an_id(spark, tmp_path):
    own = ["é" * 40 + " " + " ".join(f"own{i}x{j}" for j in range(60)) for i in range(3)]
    rows = [(1, PROSE), (None, f"{own[0]} {PROSE}"), (None, own[1]), (5, own[2]),
            (5, f"{own[2][:60]} {PROSE}")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r._doc.text: r._kept for r in passage_chunks.strip_passages(spark, frame).collect()}
    assert kept[PROSE] == PROSE and kept[own[1]] == own[1] and kept[own[2]] == own[2]
    for text in (rows[1][1], rows[4][1]):
        assert len(kept[text]) < len(text) - len(PROSE) / 2
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    found = [r for r in QUERIES["op7_passage_chunks"](spark, str(tmp_path)).collect()]
    assert sorted(r.doc_id or 0 for r in found if r.n_shared) == [0, 1, 5]
    assert len(found) == len(rows) and [r.first_doc_ids for r in found if r.n_dropped] == [[1], [1]]


@pytest.mark.parametrize("size", range(2, 9))
def test_repeated_phrases_are_found_after_any_beginning(size):
    random = np.random.default_rng(size)
    word = lambda: "".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), random.integers(2, 9)))
    missed = 0
    for _ in range(200):
        passage = " ".join([word() for _ in range(size)] * 60).split()[:60]
        texts = [
            " ".join([*(word() for _ in range(random.integers(1, 40))), *passage,
                      *(word() for _ in range(random.integers(1, 40)))]).encode()
            for _ in range(2)
        ]
        one, two = (passage_chunks.runs(text, passage_chunks.MIN_WORDS)[2] for text in texts)
        missed += not len(np.intersect1d(one, two))
    assert missed == 0


@pytest.mark.parametrize("least_bits", [4, 1 << 20])
def test_every_shared_passage_of_twenty_words_is_found(spark, monkeypatch, least_bits):
    """Also where it stands between other words, twice in a document, or in rows that share an id,
    and where the filters are crowded."""
    monkeypatch.setattr(passage_chunks.Filter, "LEAST_BITS_PER_KEY", least_bits)
    random = np.random.default_rng(23)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    words = lambda n: ["".join(random.choice(letters, random.integers(1, 8))) + str(random.integers(10**6))
                       for _ in range(n)]
    rows, expected = [], {}
    for i in range(150):
        passage, pads = " ".join(words(20)), [" ".join(words(int(random.integers(1, 15)))) for _ in range(5)]
        rows.append((2 * i, f"{pads[0]} {passage} {pads[1]}"))
        rows.append((2 * i + 1, f"{pads[2]} {passage} {pads[3]} {passage} {pads[4]}"))
        expected[2 * i + 1] = f"{pads[2]}  {pads[3]}  {pads[4]}"
    passage = " ".join(words(20))
    rows += [(None, f"{word} {passage}") for word in words(2)] + [(999, f"{word} {passage}") for word in words(2)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    kept = [(r._doc.doc_id, r._kept) for r in passage_chunks.strip_passages(spark, frame).collect()]
    held = {key: text for key, text in kept if key in expected}
    assert held == expected
    assert all(text == dict(rows)[key] for key, text in kept if key is not None and key % 2 == 0)
    assert sorted(passage in text for key, text in kept if key in (None, 999)) == [False] * 3 + [True]


def test_forced_cuts_bound_chunks():
    for text in ("same " * 300, "two words " * 150, " ".join(WORDS)):
        raw = np.frombuffer(text.encode(), np.uint8)
        _, words = passage_chunks.chunk_bounds(raw)
        assert np.diff(words).max() <= passage_chunks.MAX_WORDS


def _bounds(text):
    bounds, _ = passage_chunks.chunk_bounds(np.frombuffer(text, np.uint8))
    assert bounds[0] == 0 and bounds[-1] == len(text) and (np.diff(bounds) > 0).all()
    return bounds[:-1], bounds[1:]


def test_gear_hash_is_the_rolling_one():
    raw = np.random.default_rng(3).integers(0, 256, 300).astype(np.uint8)
    rolled, slow = passage_chunks.gear_hash(raw), 0
    for i, byte in enumerate(raw.tolist()):
        slow = ((slow << 1) + int(passage_chunks.GEAR[byte])) & 0xFFFF
        assert rolled[i] == slow


def test_fingerprints(spark, docs, none):
    rows = bloom_digest.compare_with_next(spark, docs).collect()
    assert len(rows) == len(ROWS)
    order = sorted(ROWS, key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), r[1] or ""))
    following = {}
    for one, two in zip(order, order[1:] + order[:1], strict=True):
        text, after = one[1] or "", two[1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        following.setdefault((one[0], len(text)), []).append(hashlib.sha256(edited.encode()).hexdigest())
    for row in rows:
        assert row.edited_sha256 in following[(row.id, row.n_chars)]
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        assert (row.fingerprint == "") == (row.n_chars == 0)
    prints = {r.fingerprint for r in rows if r.id in (1, None)}
    assert len(prints) == 1
    assert bloom_digest.compare_with_next(spark, none).count() == 0


@pytest.mark.parametrize("hot", [7, None])
def test_a_hot_id_is_dealt_over_ranges(spark, hot):
    """Half of the rows share an id; rows follow each other as in one sorted list."""
    rows = [(i, f"text number {i} " * 9) for i in range(60)]
    rows += [(hot, f"other text {i} " * 9) for i in range(60)] + [(hot, "the same text " * 9)] * 5
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(F.coalesce("doc_id", F.lit(bloom_digest.HEAD)).alias("_key"))
    cuts, found = bloom_digest._cuts(keyed, parts)
    assert list(found.values()) == [-(-parts * (65 + (hot is not None)) // len(rows))]
    assert set(found) <= set(cuts)
    dealt = bloom_digest._with_next(spark, docs, "doc_id", "text")
    places = dealt.select("_bucket", F.spark_partition_id().alias("at")).distinct().collect()
    assert all(row._bucket == row.at for row in places)  # a task has one range
    ranges = {}
    for row in dealt.collect():
        ranges.setdefault(row._bucket, []).append(row)
    assert len([r for r in ranges.values() if sum(x._id == hot for x in r if x._own) > 1]) > 1
    ties = {
        r.text: r.tie for r in docs.select(
            "text", F.shiftrightunsigned(F.xxhash64("text"), 1).alias("tie")
        ).collect()
    }
    order = sorted(
        rows, key=lambda r: (-(bloom_digest.HEAD if r[0] is None else r[0]), ties[r[1]], r[1])
    )
    after = dict(zip(order, [*order[1:], order[0]], strict=True))
    assert sum(row._own for part in ranges.values() for row in part) == len(rows)
    for part in ranges.values():
        assert [row._own for row in part] == [True] * (len(part) - 1) + [False]
        for one, two in zip(part, part[1:], strict=False):
            same = (one._id, one._text) == (two._id, two._text)
            assert same or after[one._id, one._text] == (two._id, two._text)


def test_levels_by_brute_force():
    raw = np.random.default_rng(4).integers(0, 30, 400).astype(np.uint8)
    found = bloom_digest.levels(raw)
    assert len(found) == 400 - 63
    for i in range(0, len(found), 17):
        counts = np.bincount(raw[i : i + 64])
        counts = counts[counts > 0]
        entropy = 6 - (counts * np.log2(counts)).sum() / 64
        assert abs(found[i] - entropy / 6 * (bloom_digest.LEVELS - 1)) < 1.5


def test_neighbours(spark):
    random = np.random.default_rng(5)
    vectors = random.normal(size=(300, 8)).astype(np.float32)
    vectors[40:120] = vectors[40]
    rows = [(i, v.tolist(), "own") for i, v in enumerate(vectors)]
    rows += [(500, None, "own"), (505, [0.0] * 8, "own"), (510, [1.0] * 3, "own"), (512, [], "own"),
             (515, [float("nan")] + [1.0] * 7, "own"), (520, [float("inf")] * 8, "own"),
             (525, [None] + [1.0] * 7, "own"), (0, vectors[0].tolist(), "own")]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, _vec string")
    found = posting_lists.search(spark, frame, F.col("vec_id") % 5 == 0, k=20).collect()
    best = {}
    for r in found:
        best.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    exact = vectors.astype(np.float64)
    assert set(best) == set(range(0, 300, 5))
    hits = 0
    for query, answers in best.items():
        answers.sort()
        assert [a[0] for a in answers] == list(range(1, 21))
        scores = exact @ exact[query]
        order = [j for j in np.lexsort((np.arange(300), -np.round(scores, 9))) if j != query][:20]
        hits += len({a[1] for a in answers} & set(order))
        for _, vec, score in answers:
            assert score == np.cumsum(exact[query] * exact[vec])[-1]
        assert [a[1:] for a in answers] == sorted([a[1:] for a in answers], key=lambda a: (-a[1], a[0]))
    assert hits >= 0.95 * 20 * len(best)
    few = posting_lists.search(spark, frame.where("vec_id < 4"), F.col("vec_id") == 0).collect()
    assert [r.rank for r in few] == [1, 2, 3]
    assert posting_lists.search(spark, frame.where("vec_id < 0"), F.col("vec_id") == 0).count() == 0
    assert posting_lists.search(spark, frame.where("vec_id >= 500"), F.col("vec_id") == 0).count() == 0


def _clustered(count, dim=64, clusters=400, seed=3):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(clusters, dim))
    rows = centres[random.integers(clusters, size=count)] + 0.8 * random.normal(size=(count, dim))
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def test_recall_where_graph_and_sample_matter(spark, tmp_path):
    """More lists than the beam is wide, and a sample of a fifth of the rows."""
    count = 100_000
    vectors = _clustered(count).astype(np.float32)
    columns = {"vec_id": pa.array(range(count)), "embedding": pa.array(vectors.tolist(), pa.list_(pa.float32()))}
    pq.write_table(pa.table(columns), tmp_path / "vectors.parquet")
    frame = spark.read.parquet(str(tmp_path)).repartition(8)
    found = posting_lists.search(spark, frame, F.col("vec_id") % 1000 == 0, k=20).collect()
    assert posting_lists.SAMPLE_ROWS < count
    answers = {}
    for r in found:
        answers.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for query in range(0, count, 1000):
        scores = vectors.astype(np.float64) @ vectors[query].astype(np.float64)
        scores[query] = -np.inf
        hits += len(answers[query] & set(np.argsort(-scores)[:20].tolist()))
    assert hits / (20 * 100) >= 0.9


def test_share_of_lists_read_falls_with_the_rows():
    shares = []
    for count in (2_500, 40_000):
        vectors = _clustered(count)
        lists = int(np.ceil(count**0.5))
        index = posting_lists.Index(vectors[:20_000], 1.0, lists, 20)
        assert index.recall >= posting_lists.TARGET
        read = index.read(vectors[:200])
        shares.append(sum(map(len, read)) / (200 * len(index.centres)))
    assert shares[1] < shares[0]


def test_a_missed_target_widens_the_search(monkeypatch):
    monkeypatch.setattr(posting_lists, "RATIOS", (1.0,))
    monkeypatch.setattr(posting_lists, "BEAM", 2)
    random = np.random.default_rng(1)
    index = posting_lists.Index(random.normal(size=(900, 32)), 9.0, 30, 20)
    assert index.recall >= posting_lists.TARGET and index.beam > 2


def test_pipeline_stages_on_odd_rows(spark, docs, none, tmp_path):
    """Nulls, empty and long texts, repeated rows, clashing names and no rows in every stage."""
    sf_dir = "/root/testdata/sf0.001"
    typed = docs.withColumn("n_chars", F.col("n_chars").cast("bigint"))
    for name, stage in corpus_pipeline.STAGES:
        for rows in (typed, none):
            out = stage(spark, rows, sf_dir)
            path = str(tmp_path / f"{name}-{rows is none}")
            out.write.parquet(path)  # fails on two columns of one name
            back = spark.read.parquet(path)
            if name != "encoding":
                assert back.columns == rows.columns
            if rows is none:
                assert back.count() == 0
            elif name == "line_dedup":
                assert back.count() == len(ROWS)
            elif name == "near_duplicates":
                again = stage(spark, rows.repartition(2), sf_dir)
                assert sorted(map(str, again.collect())) == sorted(map(str, back.collect()))
            elif name == "encoding":
                assert back.count() == len(ROWS)
                assert {r.doc_ids for r in back.collect()} == {"own"}
            if rows is typed:
                own = [c for c in CLASHES if c != "ids"]
                assert all(r[c] == "own" for r in back.collect() for c in own)
