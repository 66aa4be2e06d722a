"""Text measures against plain Python on the same strings."""

from __future__ import annotations

import random
import re
import time
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelloom.functions import text as tx
from panelloom.operators import features

PIECES = [
    "that", "That", "THAT", "with", "within", "with_", "the of", "in the", "c++", "naïve",
    "été", "ſun", "K", "k", "İ", "ı", "²", "½", "é", "中文", "😀", "_", "-", ".", ",",
    " ", "  ", "\t", "\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", "ﬁ", "①",
]
KEYWORDS = ["That ", "with", "the of", "in the", "naïve", "k", "", "  "]


def random_texts(count: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return [
        "".join(rng.choice(PIECES) for _ in range(rng.choice((0, 1, 3, 10, 60, 400))))
        for _ in range(count)
    ]


TEXTS = [
    "", " ", "that", "\t that\n", "x" * 501, "x" * 500, " " + "y" * 500 + " ",
    "z" * 900 + " that " + "w" * 900, "that " + "w" * 900, "w" * 900 + " with",
    "😀" * 300 + " in the " + "é" * 400,
    *random_texts(600, 7),
]


@pytest.fixture(scope="module")
def frame(spark):
    rows = list(enumerate(TEXTS))
    return spark.createDataFrame([*rows, (-1, None)], "id int, text string")


def by_id(df, column):
    return {row["id"]: row[column] for row in df.select("id", column).collect()}


def whole_words(keywords):
    cleaned = [kw.strip().lower() for kw in keywords if kw.strip()]
    return re.compile("|".join(rf"\b{re.escape(kw)}\b" for kw in cleaned), re.IGNORECASE)


def expected_excerpt(text, keywords, length):
    text = text.strip()
    if len(text) <= length:
        return text
    found = re.search("|".join(map(re.escape, keywords)), text, re.IGNORECASE)
    if found is None:
        return text[:length] + "..."
    start = max(0, (found.start() + found.end()) // 2 - length // 2)
    stop = min(len(text), start + length)
    return "..." * (start > 0) + text[start:stop] + "..." * (stop < len(text))


def test_whitespace_and_tokens(frame):
    collapsed = by_id(frame.withColumn("o", tx.collapse_whitespace(F.col("text"))), "o")
    tokens = by_id(frame.withColumn("o", tx.token_count(F.col("text"))), "o")
    stripped = by_id(frame.withColumn("o", tx.strip(F.col("text"))), "o")
    for i, text in enumerate(TEXTS):
        assert collapsed[i] == re.sub(r"\s+", " ", text).strip()
        assert tokens[i] == len(text.split())
        assert stripped[i] == text.strip()
    assert collapsed[-1] is None and tokens[-1] == 0


def test_unicode_normalisation(frame):
    composed = by_id(frame.withColumn("o", tx.normalize_unicode(F.col("text"))), "o")
    cleaned = by_id(frame.withColumn("o", tx.preprocess(F.col("text"))), "o")
    for i, text in enumerate(TEXTS):
        normal = unicodedata.normalize("NFKC", text)
        assert composed[i] == normal
        assert cleaned[i] == re.sub(r"\s+", " ", normal).strip()
    assert composed[-1] is None


@pytest.mark.parametrize(
    "keywords", [KEYWORDS, ["c++"], ["-", "that"], [".", "\\E+", "_"], ["in", "in the"]]
)
def test_keyword_counts(frame, keywords):
    text = F.col("text")
    counts = by_id(frame.withColumn("o", tx.mention_count(text, keywords)), "o")
    measured = features.with_measures(frame, keywords)
    tokens, matched = by_id(measured, "ai_token_count"), by_id(measured, "matched_keywords")
    pattern = whole_words(keywords)
    for i, value in enumerate(TEXTS):
        found = pattern.findall(value)
        assert counts[i] == (tokens[i] or 0) == len(found), value
        assert matched[i] == sorted({hit.lower() for hit in found})
    assert counts[-1] == 0 and matched[-1] == []


def test_no_keywords_count_nothing(frame):
    text = F.col("text")
    for keywords in ([], ["", " "]):
        counted = frame.select(
            F.sum(tx.mention_count(text, keywords)).alias("m"),
            F.sum(tx.total_tokens(text, keywords)).alias("t"),
        ).first()
        assert (counted.m, counted.t) == (0, 0)


def test_plurals_and_parts_do_not_match(spark):
    texts = ["neural networks", "a neural network", "deep-learning", "Deep Learning!", "xdeep learning"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = [r.o for r in df.select(tx.mention_count(F.col("text"), tx.DEFAULT_KEYWORDS).alias("o")).collect()]
    assert counts == [0, 1, 0, 1, 0]


@pytest.mark.parametrize("length", [500, 20, 7])
def test_excerpts(frame, length):
    keywords = ["that", "with", "in the", "ſun", "c++"]
    around = by_id(tx.with_keyword_excerpt(frame, "text", keywords, "o", length), "o")
    heads = by_id(frame.withColumn("o", tx.head_excerpt(F.col("text"), length)), "o")
    for i, text in enumerate(TEXTS):
        assert around[i] == expected_excerpt(text, keywords, length)
        body = text.strip()
        assert heads[i] == (body if len(body) <= length else body[:length] + "...")
    assert around[-1] is None


def test_density_bins(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 5, 6, 20, 21, 999)], "n int")
    bins = [row.o for row in df.select(tx.density_bin(F.col("n")).alias("o")).collect()]
    assert bins == ["zero", "low", "low", "medium", "medium", "high", "high"]


def plain_pattern(keywords):
    """The alternation word by word, for Python's engine on ASCII text."""
    word = r"[A-Za-z0-9_]"
    sides = lambda c, yes, no: yes if c == "_" or c.isalnum() else no
    parts = [
        sides(kw[0], f"(?<!{word})", f"(?<={word})") + re.escape(kw)
        + sides(kw[-1], f"(?!{word})", f"(?={word})")
        for kw in tx.clean_keywords(keywords)
    ]
    return re.compile("|".join(parts), re.IGNORECASE | re.ASCII)


@pytest.mark.parametrize("seed", range(6))
def test_keyword_trie_keeps_list_order(spark, seed):
    """Keywords that begin alike, continue each other, repeat and carry punctuation."""
    rng = random.Random(seed)
    pieces = ["a", "ab", "abc", "b", "+", " ", "a b", ".", "\\E", "-", "c"]
    keywords = ["".join(rng.choices(pieces, k=rng.randrange(1, 4))) for _ in range(25)]
    texts = ["".join(rng.choices([*pieces, "A", "B ", "_"], k=rng.randrange(0, 30))) for _ in range(300)]
    expected = [plain_pattern(keywords).findall(t) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = df.select("i", tx.keyword_hits(F.col("t"), keywords).alias("h")).collect()
    assert [r.h for r in sorted(found)] == expected and any(expected)


def test_a_thousand_keywords_cost_little_more(spark):
    rng = random.Random(0)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(1_000)]
    body = " ".join(rng.choices(words + ["filler"] * 3_000, k=3_000))
    df = spark.range(400).select(F.concat(F.lit(body), F.col("id").cast("string")).alias("t")).persist()
    df.count()

    def seconds(keywords):
        best = 1e9
        for _ in range(3):
            start = time.perf_counter()
            df.select(tx.mention_count(F.col("t"), keywords).alias("n")).agg(F.sum("n")).collect()
            best = min(best, time.perf_counter() - start)
        return best

    assert seconds(words) < 3 * seconds(words[:8]) + 0.5
    assert df.select(tx.mention_count(F.col("t"), words)).first()[0] == len(
        plain_pattern(words).findall(body + "0")
    )
    df.unpersist()


def test_settled_characters_never_change():
    """Over all code points: alone, and as any part of a composition."""
    settled = {c for a, b in tx.settled_ranges() for c in range(a, b + 1)}
    assert {ord(c) for c in "aZ09 éñüßĀЖжλ漢字かカ가"} <= settled
    for code in settled:
        char = chr(code)
        assert unicodedata.normalize("NFKC", char) == char and not unicodedata.combining(char)
    for code in range(0x110000):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            assert int(parts[1], 16) not in settled
    rng = random.Random(1)
    pool = sorted(settled)
    for _ in range(300):
        text = "".join(map(chr, rng.choices(pool, k=40)))
        assert unicodedata.normalize("NFKC", text) == text


def test_only_texts_that_can_change_reach_python(spark):
    rows = ["plain", "café Übung", "漢字かな", "é", "ﬁ", "１２", "각", "가", None, ""]
    df = spark.createDataFrame([(t,) for t in rows], "t string")
    out = [r[0] for r in df.select(tx.normalize_unicode(F.col("t"))).collect()]
    assert out == [None if t is None else unicodedata.normalize("NFKC", t) for t in rows]
    ranges = "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in tx.settled_ranges())
    sent = df.where(F.col("t").rlike(f"[^{ranges}]")).count()
    assert sent == 4


def test_nfkc_of_a_batch_holds_some_texts_at_a_time():
    texts = [None, "", *[f"{i} ｗｉｄｅ ﬁ " * 1_000 for i in range(600)]]
    batch = pa.array(texts, pa.string())
    tracemalloc.start()
    out = tx._nfkc_batch.func(batch)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 8 << 20 < batch.nbytes
    assert out.to_pylist() == [t and unicodedata.normalize("NFKC", t) for t in texts]
    assert tx._nfkc_batch.func(batch.slice(0, 0)).to_pylist() == []
