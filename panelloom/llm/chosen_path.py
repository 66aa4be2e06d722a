"""N-gram Jaccard join by chosen paths.

A document is its set of word 5-grams. Documents with equal sets are one class; classes are
joined. A set is represented by 128 minwise tokens. In each run a tree of random choices is
walked: at a node every token slot is sampled with probability 1 / (threshold x slots), and
each sampled token opens a child for all sets that share it. A set finds its own nodes of
the first ``DEPTH`` levels without meeting another set. Nodes with one class are dropped
after counting; all others are compared by brute force at this depth, whatever their size, so
``RUNS`` runs leave a pair at the very threshold apart with probability 0.69^20 < 0.001, more
similar ones less, in large nodes, too. Nodes of more than ``BLOCK_NODES`` classes are first
compared inside random blocks; then pairs of blocks are compared, but for the classes that
are connected already: only connected groups are asked for.

The nodes' comparisons use the minwise tokens with a margin of more than four standard
errors and only give connected groups of candidates. An exact check of the whole sets
follows inside each group, in blocks of a bounded number of n-grams: it counts links and
keeps the groups that true links connect. So links between members of a candidate group are
all found, copies are never expanded, and no pair is ever a row.

Classes are named by 64-bit digests of their sets.

Defined results: texts without words (null, empty) have the empty set, so they are copies of
each other and link to nothing else; texts of fewer than five words are one n-gram; long texts are read whole; null ids count as larger than all
others; rows that repeat are members like others; an empty table gives an empty table;
other columns pass through in a struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm.common import Hashes, keep, mixed, release, text_runs
from panelloom.llm.graph import components

WORDS = 5
THRESHOLD = 0.8
SLOTS = 128
RUNS = 20
DEPTH = 4
MARGIN = 0.15
BLOCK_NODES = 1024
BLOCK_SETS = 256
BLOCK_GRAMS = 1 << 20
BROADCAST_ROWS = 500_000
LAST = 2**63 - 1
SLICE_BYTES = 1 << 20

_draw = np.random.default_rng(5)
MULTIPLY = _draw.integers(0, 1 << 63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _draw.integers(0, 1 << 63, SLOTS, dtype=np.uint64)
SALT = _draw.integers(0, 1 << 63, SLOTS, dtype=np.uint64)
PRIME = np.uint64(0x9E3779B97F4A7C15)


def gram_set(text: str, hashes: Hashes, words: int = WORDS) -> np.ndarray:
    """Ascending hashes of the different word n-grams of a text."""
    tokens = text.split()
    if not tokens:
        return np.zeros(0, np.uint64)
    codes = hashes.of(tokens, len(tokens))
    size = min(words, len(codes))
    grams = np.zeros(len(codes) - size + 1, np.uint64)
    for i in range(size):
        grams = grams * PRIME + codes[i : len(codes) - size + 1 + i]
    return np.unique(mixed(grams + np.uint64(size)))


def minwise(grams: np.ndarray) -> np.ndarray:
    """The set's token in each slot: 16 bits of the mixed minimum (the top bits of a minimum
    of many n-grams are all zero)."""
    least = np.full(SLOTS, 2**64 - 1, np.uint64)
    for low in range(0, len(grams), 1024):
        part = grams[low : low + 1024, None] * MULTIPLY + ADD
        np.minimum(least, part.min(axis=0), out=least)
    return (mixed(least) >> np.uint64(48)).astype(np.uint16)


def split(tokens: np.ndarray, owner: np.ndarray, path: np.ndarray, threshold: float):
    """One level of the tree: owner and path of every child."""
    bar = np.uint64(min(2**64 - 1, int(2**64 / (threshold * SLOTS))))
    owners, paths = [owner[:0]], [path[:0]]
    for low in range(0, len(owner), 4096):
        drawn = mixed(path[low : low + 4096, None] ^ SALT)
        row, slot = np.nonzero(drawn < bar)
        shared = tokens[owner[low + row], slot].astype(np.uint64)
        owners.append(owner[low + row])
        paths.append(mixed(drawn[row, slot] ^ (shared * PRIME)))
    return np.concatenate(owners), np.concatenate(paths)


def _tokens(column: pa.Array) -> np.ndarray:
    """A binary column of minwise tokens as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SLOTS)


def document_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id``, ``_text`` (hash), ``_class``, ``_size`` and ``_tokens`` of every text."""
    shape = "_id BIGINT, _text BIGINT, _class BIGINT, _size BIGINT, _tokens BINARY"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            names, sizes, tokens = [], [], []
            for _, _, texts in text_runs(batch.column("_body"), SLICE_BYTES):
                for text in texts:
                    grams = gram_set(text, hashes)
                    names.append(xxhash.xxh3_64_intdigest(grams.tobytes()))
                    sizes.append(len(grams))
                    tokens.append(minwise(grams).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"), batch.column("_text"),
                    pa.array(np.array(names, np.uint64).view(np.int64)),
                    pa.array(sizes, pa.int64()), pa.array(tokens, pa.binary()),
                ],
                ["_id", "_text", "_class", "_size", "_tokens"],
            )
        release()

    return _keyed(docs, id_col, text_col).mapInArrow(run, shape)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"),
        F.col(text_col).alias("_body"),
    )


def _walk(rows: DataFrame, levels: int, threshold: float, runs: int) -> DataFrame:
    """Paths after some levels from each of ``runs`` roots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = _tokens(batch.column("_tokens"))
            names = batch.column("_class").to_numpy()
            everyone = np.arange(len(names))
            for r in range(runs):
                owner = everyone
                path = np.full(len(names), mixed(np.array([r + 1], np.uint64))[0])
                for _ in range(levels):
                    owner, path = split(tokens, owner, path, threshold)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(path.view(np.int64)), pa.array(names[owner])], ["_path", "_class"]
                )

    return rows.mapInArrow(run, "_path BIGINT, _class BIGINT")


def _streamed(rows: DataFrame, key: str, work, shape: str) -> DataFrame:
    """Feed whole groups of ``key``, many at a time, to ``work(table)``; rows come sorted and
    groups are small, so what is held between batches is small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            keys = table.column(key).to_numpy()
            if not len(keys):
                continue
            cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
            held = table.slice(cut)
            if cut:
                yield from work(table.slice(0, cut)).to_batches()
        if held is not None and held.num_rows:
            yield from work(held).to_batches()

    return rows.repartition(key).sortWithinPartitions(key).mapInArrow(run, shape)


def _rooted(count: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Least connected row of each row."""
    label = np.arange(count)
    while len(one):
        least = np.minimum(label[one], label[two])
        before = label.copy()
        np.minimum.at(label, one, least)
        np.minimum.at(label, two, least)
        label = label[label]
        if (label == before).all():
            break
    return label


def _alike(table: pa.Table, bar: float) -> pa.Table:
    """Edges from each group to another one it is connected to inside its node.

    Rows of one ``_group`` are connected before. Pairs that are connected already are not
    compared, nor, where ``_cross``, are pairs inside one of two blocks."""
    table = table.sort_by([("_path", "ascending"), ("_group", "ascending")])
    keys = table.column("_path").to_numpy()
    groups = table.column("_group").to_numpy()
    sides = table.column("_side").to_numpy()
    cross = table.column("_cross").to_numpy()
    tokens = _tokens(table.column("_tokens").combine_chunks())
    fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (groups[1:] != groups[:-1])])
    label = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    ones, twos, found = [], [], 0
    rows, step = np.arange(len(keys)), 1
    while True:
        rows = rows[rows + step < len(keys)]
        rows = rows[keys[rows] == keys[rows + step]]
        if not len(rows):
            break
        asked = rows[label[rows] != label[rows + step]]
        asked = asked[~cross[asked] | (sides[asked] != sides[asked + step])]
        for low in range(0, len(asked), 8192):
            part = asked[low : low + 8192]
            part = part[(tokens[part] == tokens[part + step]).sum(axis=1) >= bar * SLOTS]
            ones.append(part)
            twos.append(part + step)
            found += len(part)
        if found and (step & (step - 1) == 0 or 8 * found > len(keys)):
            label = _joined(label, ones, twos)
            ones, twos, found = [], [], 0
        step += 1
    label = _joined(label, ones, twos)
    moved = np.flatnonzero(fresh & (groups[label] != groups))
    return pa.table({"_a": groups[moved], "_b": groups[label[moved]]})


def _joined(label: np.ndarray, ones: list[np.ndarray], twos: list[np.ndarray]) -> np.ndarray:
    """Labels after more connections."""
    if not ones:
        return label
    one, two = label[np.concatenate(ones)], label[np.concatenate(twos)]
    return _rooted(len(label), one, two)[label]


def _candidates(spark: SparkSession, classes: DataFrame, threshold: float, runs: int) -> DataFrame:
    """Edges that connect each group of candidates."""
    tokens = classes.select("_class", "_tokens")
    bar = threshold - MARGIN
    shape = "_a BIGINT, _b BIGINT"
    paths = keep(spark, _walk(tokens, DEPTH, threshold, runs), "paths")
    sizes = paths.groupBy("_path").agg(F.count("*").alias("_n")).where("_n > 1")
    sizes = keep(spark, sizes, "nodes")
    shared = keep(spark, paths.join(sizes, "_path"), "shared")
    block = _block("_n")
    rows = shared.join(tokens, "_class").select(
        F.xxhash64("_path", block).alias("_path"), F.col("_class").alias("_group"),
        F.lit(0).cast("bigint").alias("_side"), F.lit(False).alias("_cross"), "_tokens",
    )
    edges = keep(spark, _streamed(rows, "_path", lambda t: _alike(t, bar), shape), "inside")
    large = shared.where(F.col("_n") > BLOCK_NODES)
    if large.isEmpty():
        return edges

    # What large nodes have not connected yet, in all pairs of blocks. A group that fills
    # blocks has its own, which are not compared with each other.
    groups = components(spark, edges, "_a", "_b")
    large = large.join(groups.withColumnRenamed("node", "_class"), "_class", "left").select(
        "_path", "_class", F.coalesce("label", "_class").alias("_group")
    )
    large = keep(spark, large, "large")
    parts = large.groupBy("_path", "_group").agg(F.count("*").alias("_m"))
    full = F.col("_m") > BLOCK_NODES
    parts = parts.groupBy("_path", F.when(full, F.col("_group")).alias("_own")).agg(
        F.sum("_m").alias("_m"), F.count("*").alias("_groups")
    )
    parts = keep(spark, parts, "parts")
    open_nodes = parts.groupBy("_path").agg(F.sum("_groups").alias("_groups")).where("_groups > 1")
    parts = parts.join(open_nodes.select("_path"), "_path")
    blocks = parts.withColumn("_i", F.explode(F.sequence(F.lit(0), _blocks("_m") - 1)))
    blocks = blocks.groupBy("_path").agg(
        F.collect_list(F.struct("_own", F.xxhash64("_own", "_i").alias("_side"))).alias("_others")
    )
    own = parts.where(F.col("_own").isNotNull()).select("_path", F.col("_own").alias("_group"), "_m")
    rest = parts.where(F.col("_own").isNull()).select("_path", F.col("_m").alias("_rest"))
    placed = large.join(blocks, "_path").join(rest, "_path", "left")
    placed = placed.join(own, ["_path", "_group"], "left")
    kind = F.when(F.col("_m").isNotNull(), F.col("_group"))
    placed = placed.withColumn("_own", kind).withColumn(
        "_side", F.xxhash64("_own", _block(F.coalesce("_m", "_rest")))
    )
    placed = placed.withColumn("_other", F.explode("_others")).where(
        F.col("_own").isNull() | ~F.col("_own").eqNullSafe(F.col("_other._own"))
    )
    low, high = F.least("_side", "_other._side"), F.greatest("_side", "_other._side")
    rows = placed.join(tokens, "_class").select(
        F.xxhash64("_path", low, high).alias("_path"), "_group", "_side",
        (low != high).alias("_cross"), "_tokens",
    )
    across = _streamed(rows, "_path", lambda t: _alike(t, bar), shape)
    return groups.select(F.col("node").alias("_a"), F.col("label").alias("_b")).unionByName(across)


def _blocks(count: Column | str) -> Column:
    """How many blocks so many classes of a node take."""
    return F.ceil((F.col(count) if isinstance(count, str) else count) / BLOCK_NODES).cast("int")


def _block(count: Column | str) -> Column:
    """The class's block among them."""
    return F.pmod(F.xxhash64("_class", "_path"), _blocks(count)).cast("int")


def _checked(table: pa.Table, threshold: float) -> pa.Table:
    """Exact links inside each block pair: per class its links, their documents and the
    least class it is connected to."""
    keys = table.column("_key").to_numpy()
    names = table.column("_class").to_numpy()
    weights = table.column("_weight").to_numpy()
    sides = table.column("_side").to_numpy()
    cross = table.column("_cross").to_numpy()
    sets = table.column("_grams").to_pylist()
    out: list[list[np.ndarray]] = [[], [], [], []]
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        grams = [np.frombuffer(s, np.uint64) for s in sets[low:high]]
        common = _common(grams)
        sizes = np.array([len(g) for g in grams])
        union = sizes[:, None] + sizes[None, :] - common
        linked = common / np.maximum(union, 1) >= threshold
        np.fill_diagonal(linked, False)
        side = sides[low:high]
        if cross[low]:  # pairs inside one block belong to that block's own pair
            linked &= side[:, None] != side[None, :]
        one, two = np.nonzero(linked)
        order = np.argsort(names[low:high], kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        label = order[_rooted(high - low, place[one], place[two])[place]]
        out[0].append(names[low:high])
        out[1].append(linked.sum(axis=1))
        out[2].append(linked @ weights[low:high])
        out[3].append(names[low:high][label])
    parts = [np.concatenate(o).astype(np.int64) for o in out]
    return pa.table(dict(zip(("_class", "_links", "_linked", "_root"), parts, strict=True)))


def _common(grams: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    values = np.concatenate(grams)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.concatenate([[True], values[1:] != values[:-1]])
    code = np.cumsum(fresh) - 1
    shared = np.bincount(code)[code] > 1
    code, owner = code[shared], owner[shared]
    code = np.unique(code, return_inverse=True)[1]
    common = np.diag([float(len(g)) for g in grams])
    total = np.zeros_like(common)
    count = int(code.max()) + 1 if len(code) else 0
    starts = np.searchsorted(code, np.arange(0, count + 4096, 4096))
    for i in range(len(starts) - 1):
        part = slice(starts[i], starts[i + 1])
        inside = np.zeros((len(grams), 4096), np.float32)
        inside[owner[part], code[part] - i * 4096] = 1
        total += inside @ inside.T
    np.fill_diagonal(total, common.diagonal())
    return total


def _grams(rows: DataFrame) -> DataFrame:
    """Texts to their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for low, high, texts in text_runs(batch.column("_body"), SLICE_BYTES):
                grams = [gram_set(text, hashes).tobytes() for text in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_class").slice(low, high - low), pa.array(grams, pa.binary())],
                    ["_class", "_grams"],
                )

    return rows.select("_class", "_body").mapInArrow(run, "_class BIGINT, _grams BINARY")


def join_documents(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    runs: int = RUNS,
) -> DataFrame:
    """Per row ``_id``, ``_text`` (hash), ``_label`` (name of its group of linked documents),
    ``class_id`` (the group's smallest id; groups share it where ids are null or come more
    than once), ``copy_id`` (smallest id with an equal set), ``n_copies`` (rows with an equal
    set) and ``n_links`` (other rows at least as similar as the threshold)."""
    sets = keep(spark, document_sets(docs, id_col, text_col), "sets")
    sizes = sets.groupBy("_class").agg(
        F.min("_id").alias("_rep"), F.count("*").alias("_weight"), F.max("_size").alias("_size")
    )
    sizes = keep(spark, sizes, "classes")
    lead = sets.join(sizes.withColumnRenamed("_rep", "_id").select("_class", "_id"), ["_class", "_id"])
    classes = lead.select("_class", "_id", "_text", "_tokens").dropDuplicates(["_class", "_id"])
    classes = keep(spark, classes, "leads")
    edges = _candidates(spark, classes, threshold, runs)
    groups = components(spark, edges, "_a", "_b")

    # Blocks of each group of candidates, by number of sets and of n-grams.
    members = groups.select(F.col("node").alias("_class"), "label").join(
        sizes.select("_class", "_weight", "_size"), "_class"
    )
    members = keep(spark, members, "members")
    totals = members.groupBy("label").agg(F.count("*").alias("_n"), F.sum("_size").alias("_grams_n"))
    blocks = F.greatest(F.ceil(F.col("_n") / BLOCK_SETS), F.ceil(F.col("_grams_n") / BLOCK_GRAMS))
    totals = totals.select("label", blocks.cast("int").alias("_blocks"))
    placed = members.join(totals, "label").withColumn(
        "_own", F.pmod(F.xxhash64("_class", F.lit(1)), "_blocks").cast("int")
    )
    text = _keyed(docs, id_col, text_col)
    asked = classes.join(members.select("_class"), "_class").select("_class", "_id", "_text")
    asked = keep(spark, asked, "asked")
    if asked.count() <= BROADCAST_ROWS:  # 24 bytes each; beyond, texts are shuffled to them
        asked = F.broadcast(asked)
    bodies = text.join(asked, ["_id", "_text"]).dropDuplicates(["_class"]).select("_class", "_body")
    grams = _grams(bodies)
    paired = placed.join(grams, "_class").withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    )
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    paired = paired.select(
        F.xxhash64("label", low, high).alias("_key"), "_class", "_weight",
        F.col("_own").alias("_side"), (low != high).alias("_cross"), "_grams",
    )
    shape = "_class BIGINT, _links BIGINT, _linked BIGINT, _root BIGINT"
    checked = keep(
        spark, _streamed(paired, "_key", lambda t: _checked(t, threshold), shape), "checked"
    )
    links = checked.groupBy("_class").agg(F.sum("_linked").alias("_linked"))
    final = components(spark, checked.where("_class <> _root"), "_class", "_root")
    named = sizes.join(final.withColumnRenamed("node", "_class"), "_class", "left").join(
        links, "_class", "left"
    )
    named = named.withColumn("_label", F.coalesce("label", "_class"))
    named = keep(spark, named.select("_class", "_rep", "_weight", "_linked", "_label"), "named")
    least = named.groupBy("_label").agg(F.min("_rep").alias("class_id"))
    info = named.join(least, "_label").select(
        "_class", "_label", "class_id", F.col("_rep").alias("copy_id"), F.col("_weight").alias("n_copies"),
        (F.col("_weight") - 1 + F.coalesce("_linked", F.lit(0))).alias("n_links"),
    )
    info = keep(spark, info, "info")
    own = sets.select("_id", "_text", "_class")
    return own.join(info, "_class").drop("_class")


def keep_one(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The table with one row of each group, one of the smallest id; among rows of one id and
    text the one with the least hash of all columns, so a rerun keeps the same."""
    joined = join_documents(spark, docs, id_col, text_col, **options)
    first = joined.where(F.col("_id") == F.col("class_id"))
    first = first.groupBy("_label", "_id").agg(F.min("_text").alias("_text"))
    first = keep(spark, first, "firsts")
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_doc"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"),
    ).join(first, ["_id", "_text"])
    # One text of each group is left; its repeated rows are combined before they are dealt out.
    least = rows.groupBy("_label").agg(F.min_by("_doc", F.xxhash64("_doc")).alias("_doc"))
    return least.select("_doc.*")
