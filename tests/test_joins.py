"""Skew-aware joins against pandas merges on small frames with low hot limits."""

from __future__ import annotations

import random
from collections import Counter
from functools import reduce

import pandas as pd
import pytest

from conftest import SKEW_SETTINGS
from panelloom.operators import joins

KEYS = ["firm_id", "year"]


def table(spark, path, name, rows):
    """A stored table with keys and one value column."""
    df = spark.createDataFrame(rows, f"firm_id string, year int, {name} int")
    df.repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def random_rows(rng, count, hot):
    rows = []
    for i in range(count):
        firm = rng.choice(["a", "b", "c", "d", "e", None])
        year = rng.choice([2000, 2001, None])
        rows.append((*rng.choice([hot, (firm, year), (firm, year)]), i))
    return rows


def as_counter(rows):
    return Counter(tuple(None if pd.isna(v) else v for v in row) for row in rows)


def merged(frames, how="outer"):
    frames = [pd.DataFrame(rows, columns=[*KEYS, name]) for name, rows in frames]
    out = reduce(lambda a, b: a.merge(b, on=KEYS, how=how), frames)
    return as_counter(out.itertuples(index=False))


def sql_outer(frames):
    """Outer join in which null keys match nothing."""
    plain, lone = [], []
    for i, (name, rows) in enumerate(frames):
        plain.append((name, [r for r in rows if None not in r[:2]]))
        for r in rows:
            if None in r[:2]:
                lone.append((*r[:2], *[r[2] if j == i else None for j in range(len(frames))]))
    return merged(plain) + as_counter(lone)


@pytest.mark.parametrize("hot_rows", [3, 25, 1_000_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_outer_join_matches_pandas(spark, tmp_path, hot_rows, seed):
    rng = random.Random(seed)
    hots = [("a", 2000), (None, None), ("only-here", 2001)]
    frames = [(n, random_rows(rng, 40 - 12 * i, hots[i])) for i, n in enumerate("xyz")]
    tables = [table(spark, str(tmp_path / n), n, rows) for n, rows in frames]
    out = joins.outer_join(tables, KEYS, hot_rows=hot_rows)
    assert out.columns == [*KEYS, "x", "y", "z"]
    assert as_counter(map(tuple, out.collect())) == merged(frames)
    out = joins.outer_join(tables, KEYS, null_safe=False, hot_rows=hot_rows)
    assert as_counter(map(tuple, out.collect())) == sql_outer(frames)


def test_unique_tables_need_no_count(spark, tmp_path):
    frames = [("x", [("a", 1, 1), (None, 1, 2)]), ("y", [(None, 1, 3), ("b", 2, 4)])]
    tables = [table(spark, str(tmp_path / n), n, rows) for n, rows in frames]
    out = joins.outer_join(tables, KEYS, unique_keys=True)
    assert as_counter(map(tuple, out.collect())) == merged(frames)


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
@pytest.mark.parametrize("null_safe", [True, False])
def test_left_join_matches_pandas(spark, tmp_path, hot_rows, null_safe):
    rng = random.Random(5)
    frames = [("x", random_rows(rng, 40, ("a", 2000))), ("y", random_rows(rng, 30, ("b", None)))]
    left, right = (table(spark, str(tmp_path / n), n, rows) for n, rows in frames)
    out = joins.left_join(left, right, KEYS, null_safe=null_safe, hot_rows=hot_rows)
    if not null_safe:
        frames[1] = ("y", [row for row in frames[1][1] if None not in row[:2]])
    assert as_counter(map(tuple, out.collect())) == merged(frames, "left")


def test_hot_keys_are_few_and_name_the_largest_table(spark, tmp_path):
    frames = [
        ("x", [("a", 1, i) for i in range(10)] + [("b", 1, 0), (None, None, 1)]),
        ("y", [("a", 1, i) for i in range(4)] + [(None, None, i) for i in range(5)]),
    ]
    tables = [table(spark, str(tmp_path / n), n, rows) for n, rows in frames]
    found = {tuple(row) for row in joins.hot_keys(tables, KEYS, hot_rows=4).collect()}
    assert found == {("a", 1, 0, 10), (None, None, 1, 5)}


def test_hot_rows_are_spread_over_slices(spark, tmp_path, settings):
    """A key with most rows of a table ends up in many tasks of the outer join."""
    settings(SKEW_SETTINGS)
    settings({"spark.sql.shuffle.partitions": "16"})
    rows = [("hot", 2000, i) for i in range(20_000)] + [(f"f{i}", 2000, i) for i in range(100)]
    x = table(spark, str(tmp_path / "x"), "x", rows)
    y = table(spark, str(tmp_path / "y"), "y", [("hot", 2000, 1), ("g", 2001, 2)])
    out = joins.outer_join([x, y], KEYS, hot_rows=500)
    assert out.count() == 20_101
    sizes = (
        out.where("firm_id = 'hot'").rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    )
    assert sum(sizes) == 20_000 and max(sizes) < 10_000


def test_hot_right_side_of_left_join_is_split(spark, tmp_path, settings):
    settings(SKEW_SETTINGS)
    right = spark.range(0, 100_000, 1, 16).selectExpr(
        "if(id % 10 > 0, 'hot', concat('k', id)) AS firm_id", "2000 AS year", "id AS y"
    )
    left = spark.createDataFrame([("hot", 2000, 1), ("k10", 2000, 2), ("none", 2000, 3)],
                                 "firm_id string, year int, x int")
    out = joins.left_join(left, right, KEYS, hot_rows=1_000)
    assert out.count() == 90_002
    out.collect()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_slices_do_not_depend_on_row_order(spark, tmp_path):
    """Equal rows and rows in another order give the same panel."""
    rows = [("hot", 2000, i % 50) for i in range(3_000)]
    y = table(spark, str(tmp_path / "y"), "y", [("hot", 2000, 1), ("hot", 2000, 2)])
    x = spark.createDataFrame(rows, "firm_id string, year int, x int")
    one = joins.outer_join([x.repartition(7), y], KEYS, hot_rows=100)
    two = joins.outer_join([x.orderBy("x").repartition(3, "x"), y], KEYS, hot_rows=100)
    assert one.count() == 6_000
    assert as_counter(map(tuple, one.collect())) == as_counter(map(tuple, two.collect()))


def _eight(spark):
    rng = random.Random(8)
    frames = []
    for i in range(8):
        keys = {(rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, None])) for _ in range(6)}
        rows = [(k, y, rng.choice([None, rng.randrange(9)])) for k, y in keys]
        frames.append((rows, spark.createDataFrame(rows, f"k string, y int, v{i} int")))
    return frames


def test_many_tables_meet_in_one_shuffle(spark):
    """Against a plain dictionary; null keys are equal, and null values stay null."""
    frames = _eight(spark)
    expected = {}
    for i, (rows, _) in enumerate(frames):
        for k, y, v in rows:
            expected.setdefault((k, y), [None] * 8)[i] = v
    merged = joins.outer_join([df for _, df in frames], ["k", "y"], True, unique_keys=True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert {(r.k, r.y): list(r)[2:] for r in merged.collect()} == expected
    assert merged.count() == len(expected)
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_a_broken_promise_of_unique_keys_raises(spark):
    rows = spark.createDataFrame([("a", 1, 1), ("a", 1, 2)], "k string, y int, v int")
    others = [spark.createDataFrame([("a", 1, 3)], f"k string, y int, w{i} int") for i in range(2)]
    with pytest.raises(Exception, match="repeats a key"):
        joins.outer_join([rows, *others], ["k", "y"], True, unique_keys=True).collect()


def test_null_keys_are_dealt_out(spark):
    df = spark.range(1000).selectExpr("cast(null AS string) AS k", "1 AS y", "id AS v")
    salted = joins.null_salt(df, ["k", "y"], "_s")
    assert salted.select("_s").distinct().count() == 1000
    full = joins.null_salt(df.fillna({"k": "a"}), ["k", "y"], "_s")
    assert [r[0] for r in full.select("_s").distinct().collect()] == [0]


@pytest.mark.parametrize("hot_rows", [3, 1_000])
def test_kept_inputs_are_computed_once(spark, tmp_path, hot_rows):
    rng = random.Random(7)
    frames = [(n, random_rows(rng, 30, ("a", 2000))) for n in "xy"]
    tables = [table(spark, str(tmp_path / n), n, rows) for n, rows in frames]
    out = joins.outer_join(tables, KEYS, hot_rows=hot_rows, keep_inputs=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert str(tmp_path) not in "".join(out.inputFiles()) and plan
    assert as_counter(map(tuple, out.collect())) == merged(frames)


def test_union_of_bucketed_tables_groups_each_key_once(spark):
    """The session keeps Spark from trusting the buckets of a union."""
    names = ["union_one", "union_two"]
    for name in names:
        rows = spark.range(100).selectExpr("id", "1 AS n")
        rows.write.bucketBy(4, "id").sortBy("id").mode("overwrite").saveAsTable(name)
    both = reduce(lambda a, b: a.unionByName(b), map(spark.table, names))
    grouped = both.groupBy("id").sum("n").toDF("id", "n").collect()
    assert len(grouped) == 100 and {row.n for row in grouped} == {2}
    for name in names:
        spark.sql(f"DROP TABLE {name}")
