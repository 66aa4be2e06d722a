"""Joins that stay balanced when a few keys hold most of the rows.

With adaptive execution Spark splits a hot partition of an inner join, and one on
the left of a left join, and reads the other side's partition once per split; it
broadcasts a side when its measured size allows. Three cases it cannot split are
treated here: a side that is an aggregate's own shuffle, the right side of a left
join, and a full outer join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.session import scratch_path

# A key is hot when one table holds this many of its rows. The list of hot keys grows with
# the data, so it is never broadcast by request: Spark does so when its size allows.
HOT_ROWS = 1_000_000


def _same(left: str, right: str, keys: Sequence[str], null_safe: bool) -> Column:
    def one(key: str) -> Column:
        a, b = F.col(f"{left}.{key}"), F.col(f"{right}.{key}")
        return a.eqNullSafe(b) if null_safe else a == b

    return reduce(lambda x, y: x & y, [one(key) for key in keys])


def _others(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [name for name in df.columns if name not in keys]


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join facts to a lookup with one row per ``key``.

    There is no broadcast hint: Spark broadcasts the lookup when its size allows. A
    lookup usually comes from an aggregate on the key, and a join that reads the
    aggregate's shuffle cannot be split. The hash as a second key gives the lookup a
    shuffle of its own, so a hot key among the facts can be.
    """

    def hashed(df: DataFrame) -> DataFrame:
        return df.withColumn("_hash", F.xxhash64(key))

    return hashed(facts).join(hashed(lookup), [key, "_hash"], how).drop("_hash")


def hot_keys(
    tables: Sequence[DataFrame], keys: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Keys with at least ``hot_rows`` rows in one table: keys, ``_main``, ``_rows``.

    ``_main`` is the position of the table with the most rows of that key. Rows are
    counted map-side first, so the shuffle carries one row per key and task.
    """
    counts = reduce(
        DataFrame.unionByName,
        [
            table.groupBy(*keys)
            .agg(F.count("*").alias("_rows"))
            .where(F.col("_rows") >= hot_rows)
            .withColumn("_main", F.lit(i))
            for i, table in enumerate(tables)
        ],
    )
    top = counts.groupBy(*keys).agg(F.max(F.struct("_rows", "_main")).alias("_top"))
    return top.select(*keys, F.col("_top._main").alias("_main"), F.col("_top._rows").alias("_rows"))


def _full_outer(
    left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool
) -> DataFrame:
    on = _same("l", "r", keys, null_safe)
    return left.alias("l").join(right.alias("r"), on, "full_outer").select(
        *[F.coalesce(F.col(f"l.{key}"), F.col(f"r.{key}")).alias(key) for key in keys],
        *[F.col(f"l.{name}") for name in _others(left, keys)],
        *[F.col(f"r.{name}") for name in _others(right, keys)],
    )


def _sliced(
    tables: Sequence[DataFrame], keys: Sequence[str], hot: DataFrame, hot_rows: int
) -> DataFrame:
    """Outer join of the hot keys only, every key cut into slices of ``hot_rows`` rows.

    The table with the most rows of a key spreads them over its slices; the other
    tables repeat their (fewer) rows in each slice. A row's slice is a hash of its
    values, so it is the same when a task runs again in another order. Rows that are
    equal throughout travel as one with a count and are repeated behind the join.
    """
    hot = hot.withColumn("_slices", F.ceil(F.col("_rows") / hot_rows).cast("int"))
    every = F.sequence(F.lit(0), F.col("_slices") - 1)
    joined = hot.select(*keys, "_main", F.explode(every).alias("_slice")).withColumn(
        "_copies", F.lit(1).cast("bigint")
    )
    for i, table in enumerate(tables):
        rows = table.alias("t").join(hot.alias("h"), _same("t", "h", keys, True)).select(
            "t.*", "h._main", "h._slices"
        )
        own = (
            rows.where(F.col("_main") == i)
            .groupBy(*rows.columns)
            .agg(F.count("*").alias("_times"))
            .withColumn("_slice", F.pmod(F.xxhash64(*table.columns), "_slices").cast("int"))
        )
        repeated = (
            rows.where(F.col("_main") != i)
            .withColumn("_times", F.lit(1).cast("bigint"))
            .withColumn("_slice", F.explode(every))
        )
        part = own.unionByName(repeated).withColumn("_present", F.lit(True))
        on = _same("l", "r", [*keys, "_slice"], True)
        joined = (
            joined.alias("l")
            .join(part.alias("r"), on, "left")
            # A slice without rows of the main table would only repeat the others.
            .where((F.col("l._main") != i) | F.col("r._present"))
            .select(
                *[F.col(f"l.{name}") for name in joined.columns if name != "_copies"],
                *[F.col(f"r.{name}") for name in _others(table, keys)],
                (F.col("l._copies") * F.coalesce("r._times", F.lit(1))).alias("_copies"),
            )
        )
    repeats = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))
    return joined.withColumn("_copy", repeats).drop("_main", "_slice", "_copies", "_copy")


def _by_hot(
    df: DataFrame, hot: DataFrame, keys: Sequence[str], null_safe: bool, how: str
) -> DataFrame:
    """Rows with or without a hot key. Where the list is too large to be broadcast, a hash as
    one more key keeps this join's shuffle apart from the next one's, so it can be split."""
    name = F.xxhash64(F.lit("hot"), *keys)
    marked = df.withColumn("_name", name).alias("t")
    listed = hot.select(*keys).withColumn("_name", name).alias("h")
    on = _same("t", "h", keys, null_safe) & (F.col("t._name") == F.col("h._name"))
    return marked.join(listed, on, how).select(*[F.col(f"t.{c}") for c in df.columns])


def _counted_hot_keys(
    tables: Sequence[DataFrame], keys: Sequence[str], hot_rows: int
) -> DataFrame | None:
    """The hot keys, counted once and kept in the shared folder; None when there are none."""
    kept = _written(hot_keys(tables, keys, hot_rows), "hot-keys")
    return None if kept.isEmpty() else kept


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merged_by_key(
    tables: Sequence[DataFrame], keys: Sequence[str], names: Sequence[str] | None = None
) -> DataFrame:
    """Full outer join of any number of tables with one row per key; null keys are equal.

    Every table's other columns travel as one struct at the table's place. All rows meet in one
    union, which is shuffled once on the keys and then grouped: the growing result of a chain
    of joins, whose coalesced keys Spark would shuffle again at every step, never exists. Rows
    are not combined ahead of the shuffle, since no key repeats within a table. A table that does
    repeat a key breaks its promise and raises; no row is lost in silence.
    """
    names = names or [f"table {i}" for i in range(len(tables))]

    def placed(i: int) -> DataFrame:
        here = F.struct(F.lit(True).alias("_in"), *[F.col(f"`{c}`") for c in _others(tables[i], keys)])
        kinds = [
            T.StructType([
                T.StructField("_in", T.BooleanType()),
                *[table.schema[c] for c in _others(table, keys)],
            ])
            for table in tables
        ]
        return tables[i].select(
            *keys,
            *[
                (here if j == i else F.lit(None)).cast(_nullable(kind)).alias(f"_t{j}")
                for j, kind in enumerate(kinds)
            ],
        )

    union = reduce(DataFrame.unionByName, [placed(i) for i in range(len(tables))])
    count = lambda i: F.count(F.col(f"_t{i}._in"))
    grouped = union.repartition(*keys).groupBy(*keys).agg(
        *[F.first(f"_t{i}", ignorenulls=True).alias(f"_t{i}") for i in range(len(tables))],
        *[count(i).alias(f"_n{i}") for i in range(len(tables))],
    )
    # The check is part of the rows' keys, so no optimizer drops it.
    broken = [
        F.when(
            F.col(f"_n{i}") > 1,
            F.raise_error(F.lit(f"{name} repeats a key; unique_keys does not hold")).cast("boolean"),
        )
        for i, name in enumerate(names)
    ]
    checked = grouped.where(F.coalesce(*broken, F.lit(True)))
    return checked.select(
        *keys,
        *[
            F.col(f"_t{i}").getField(c).alias(c)
            for i, table in enumerate(tables) for c in _others(table, keys)
        ],
    )


def _nullable(kind: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in kind.fields])


def null_salt(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """A further join key that deals rows with a null key to all tasks and leaves the others.

    Null keys match nothing, yet all of them hash alike and would meet in one task. The salt is
    a hash of the row's values, so a task that runs again deals alike.
    """
    keyless = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    return df.withColumn(
        name, F.when(keyless, F.xxhash64(*df.columns)).otherwise(F.lit(0).cast("bigint"))
    )


def outer_join(
    tables: Sequence[DataFrame],
    keys: Sequence[str],
    null_safe: bool = True,
    unique_keys: bool = False,
    hot_rows: int = HOT_ROWS,
    keep_inputs: bool = False,
) -> DataFrame:
    """Full outer equi-join of all tables, keys coalesced, other columns side by side.

    ``null_safe`` makes null keys match each other; otherwise rows with a null key
    match nothing and are appended without a join. Tables known to have one row per
    key (``unique_keys``) cannot be skewed: from three on they meet in one shuffle
    (``merged_by_key``). For others the keys are counted once, by a job of its own, and
    hot ones are joined apart in slices. That reads the inputs' keys twice: stored tables may
    well be, but inputs that are dear to compute are written once first (``keep_inputs``).
    """
    if len(tables) == 1:
        return tables[0]
    if unique_keys and null_safe and len(tables) > 2:
        return merged_by_key(tables, keys)
    if not null_safe:
        keyless = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
        loners = [table.where(keyless) for table in tables]
        tables = [table.where(~keyless) for table in tables]

    def fold(parts: Sequence[DataFrame]) -> DataFrame:
        return reduce(lambda a, b: _full_outer(a, b, keys, null_safe), parts)

    if keep_inputs and not unique_keys:
        tables = [_written(table, "join-input") for table in tables]
    hot = None if unique_keys else _counted_hot_keys(tables, keys, hot_rows)
    if hot is None:
        merged = fold(tables)
    else:
        cold = [_by_hot(table, hot, keys, True, "left_anti") for table in tables]
        merged = fold(cold).unionByName(_sliced(tables, keys, hot, hot_rows))
    if not null_safe:
        for rows in loners:
            merged = merged.unionByName(rows, allowMissingColumns=True)
    return merged


def left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    unique_keys: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join whose right side may repeat keys, some of them very often.

    A left row with a hot right key always finds a match. Those keys therefore go
    through an inner join, which adaptive execution can split on both sides. A right
    side known to have one row per key (``unique_keys``) needs no such care.
    """

    def join(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
        on = _same("l", "r", keys, null_safe)
        return a.alias("l").join(b.alias("r"), on, how).select(
            "l.*", *[F.col(f"r.{name}") for name in _others(right, keys)]
        )

    matchable = right
    if not null_safe:
        matchable = right.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    hot = None if unique_keys else _counted_hot_keys([matchable], keys, hot_rows)
    if hot is None:
        return join(left, matchable, "left")
    cold = [_by_hot(df, hot, keys, null_safe, "left_anti") for df in (left, matchable)]
    warm = [_by_hot(left, hot, keys, null_safe, "left_semi"), matchable]
    # The hash as one more key gives the inner join shuffles of its own, which can be split.
    warm = [df.withColumn("_hash", F.xxhash64(*keys)) for df in warm]
    on_hash = F.col("l._hash") == F.col("r._hash")
    joined = warm[0].alias("l").join(
        warm[1].alias("r"), _same("l", "r", keys, null_safe) & on_hash, "inner"
    )
    matched = joined.select(
        *[F.col(f"l.{name}") for name in left.columns],
        *[F.col(f"r.{name}") for name in _others(right, keys)],
    )
    return join(*cold, "left").unionByName(matched)
