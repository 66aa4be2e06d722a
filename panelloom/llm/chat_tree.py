"""Chat formatting as a prefix tree of turns.

Conversations that start with the same turns share those nodes. A node is a turn after a
given row of turns, named by two 64-bit hashes over all turns up to it. Each node is
written once, in depth-first order, as one segment of template text with its start in the
whole sequence, its position ids (counted along the conversation, so alternatives after the
same turns get the same positions) and its attention intervals: the ranges of its ancestors
and its own, which are all that its characters may attend to. A token is one code point;
segments end at turn borders, so a tokeniser can be applied to each segment alone.

Conversations are ranked by the arrays of their hashes. The first conversation in that order
that has a node owns it, and nodes in order of (owner, turn) are in depth-first order. Nodes
are range partitioned by it and starts are partial sums per partition plus a base per
partition, so no task sees more than its share, whatever shares a first turn or a whole
conversation. Ranges of ancestors that follow each other are one range, so a long chain of
turns costs one range a node, not one per ancestor.

Template: ``<|im_start|>`` role NEWLINE text ``<|im_end|>`` NEWLINE. In texts and roles a
backslash is doubled and ``<|`` becomes ``<\\|`` (and a line break in a role ``<\\/``), so
no control string can appear in them and each escape reverses.

Defined results: null texts and roles are empty; turns of a conversation are ordered by turn
(null first), role, text, so ties have one order and repeated rows are turns of their own;
null conversation ids are one conversation; an empty table gives empty tables; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.llm.common import keep

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
STRETCH = 4096


def escape(text: Column) -> Column:
    """Make control strings impossible in a text."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Reverse of ``escape``."""
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """A role as one line."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\/"))


def unescape_role(role: Column) -> Column:
    """Reverse of ``escape_role``."""
    return unescape(F.replace(role, F.lit("<\\/"), F.lit("\n")))


def _turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns in order, each with the hashes of its row of turns."""
    plain = rows.select(
        F.col(conv).alias("_conv"), F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit("")).alias("_role"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    order = Window.partitionBy("_conv").orderBy("_turn", "_role", "_text")
    numbered = plain.withColumn("_depth", F.row_number().over(order))
    upto = Window.partitionBy("_conv").orderBy("_depth")
    one = F.bit_xor(F.xxhash64("_depth", "_role", "_text")).over(upto)
    two = F.bit_xor(F.xxhash64(F.lit("second"), "_depth", "_role", "_text")).over(upto)
    return numbered.withColumns({"_k1": one, "_k2": two})


def _ranked(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """An ordered number for each conversation: ``_conv``, ``_rank``."""
    steps = F.sort_array(F.collect_list(F.struct("_depth", "_k1", "_k2")))
    paths = turns.groupBy("_conv").agg(steps.alias("_steps")).select(
        "_conv", F.transform("_steps", lambda s: F.struct(s["_k1"], s["_k2"])).alias("_path")
    )
    # The conversation itself as the last key deals out equal paths.
    dealt = keep(
        spark,
        paths.repartitionByRange("_path", "_conv").withColumn("_part", F.spark_partition_id()),
        "paths",
    )
    order = Window.partitionBy("_part").orderBy("_path", "_conv")
    rank = F.shiftleft(F.col("_part").cast("bigint"), 40) + F.row_number().over(order)
    return dealt.select("_conv", rank.alias("_rank"))


def format_tree(
    spark: SparkSession,
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = LOSS_ROLE,
) -> tuple[DataFrame, DataFrame]:
    """The tree's nodes in written order, and each conversation's last node.

    Nodes: ``part``, ``start``, ``length``, ``segment``, ``position`` (of its first character;
    the others follow), ``attends`` (array of ranges), ``loss_from``, ``loss_length`` (range of
    the segment under the loss mask). Conversations: ``conv``, ``start`` of the last node,
    ``n_turns``."""
    turns = keep(spark, _turns(rows, conv, turn, role, text), "turns")
    ranks = keep(spark, _ranked(spark, turns), "ranks")
    turns = turns.join(ranks, turns["_conv"].eqNullSafe(ranks["_conv"])).drop(ranks["_conv"])
    turns = keep(spark, turns, "ranked-turns")
    owners = turns.groupBy("_k1", "_k2").agg(F.min("_rank").alias("_owner"))
    owners = keep(spark, owners, "owners")
    owned = turns.join(owners, ["_k1", "_k2"]).where("_rank = _owner")
    head = F.concat(F.lit(START), escape_role(F.col("_role")), F.lit("\n"))
    body = escape(F.col("_text"))
    nodes = owned.select(
        "_k1", "_k2", "_rank", "_depth",
        F.concat(head, body, F.lit(END + "\n")).alias("segment"),
        F.char_length(head).alias("_head"),
        F.when(F.col("_role") == loss_role, F.char_length(body)).otherwise(0).alias("loss_length"),
    ).withColumn("length", F.char_length("segment").cast("bigint"))
    # Written once: the partition numbers and sums below see one fixed division.
    nodes = keep(
        spark,
        nodes.repartitionByRange("_rank", "_depth").withColumn("part", F.spark_partition_id()),
        "tree-nodes",
    )
    sums = nodes.groupBy("part").agg(F.sum("length").alias("_sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("part").orderBy("_rank", "_depth").rowsBetween(
        Window.unboundedPreceding, -1
    )
    slim = nodes.select("part", "_k1", "_k2", "_rank", "_depth", "length")
    starts = keep(
        spark,
        slim.withColumn("_in", F.coalesce(F.sum("length").over(inner), F.lit(0)))
        .join(bases, "part")
        .select("_k1", "_k2", F.col("_rank").alias("_owner"), "length",
                (F.col("_base") + F.col("_in")).alias("start")),
        "tree-starts",
    )
    placed = turns.select("_conv", "_rank", "_depth", "_k1", "_k2").join(starts, ["_k1", "_k2"])
    placed = keep(spark, _with_ranges(placed), "ranges")
    own = placed.where("_rank = _owner").select("_k1", "_k2", "start", "position", "attends")
    tree = nodes.join(own, ["_k1", "_k2"]).select(
        "part", "start", "length", "segment", "position", "attends",
        F.col("_head").alias("loss_from"), "loss_length",
    )
    conversations = placed.where("_depth = _last").select(
        F.col("_conv").alias("conv"), "start", F.col("_depth").cast("bigint").alias("n_turns")
    )
    # The tree is the output: it is written once and read from there.
    return keep(spark, tree, "tree"), keep(spark, conversations, "conversations")


def _with_ranges(placed: DataFrame) -> DataFrame:
    """Turns of each conversation with ``attends``, ``position`` and ``_last`` (its depth)."""
    order = Window.partitionBy("_rank").orderBy("_depth")
    ended = F.lag(F.col("start") + F.col("length")).over(order)
    cut = placed.withColumn("_ended", ended).withColumn(
        "_cut", F.when(~F.col("start").eqNullSafe(F.col("_ended")), F.struct("start", "_ended"))
    )
    # A range begins at each cut and ends where the turn before the next cut ended.
    cuts = F.collect_list("_cut").over(order)
    last = F.max("_depth").over(Window.partitionBy("_rank"))
    cut = cut.withColumn("_cuts", cuts).withColumn("_last", last)
    until = F.col("start") + F.col("length")
    ranges = F.transform(
        "_cuts",
        lambda c, i: F.struct(
            c["start"].alias("from"),
            F.coalesce(F.get("_cuts", i + 1)["_ended"], until).alias("to"),
        ),
    )
    held = F.aggregate("attends", F.lit(0).cast("bigint"), lambda n, r: n + r["to"] - r["from"])
    return cut.withColumn("attends", ranges).withColumn("position", held - F.col("length")).drop(
        "_cut", "_cuts", "_ended"
    )


def read_back(tree: DataFrame, conversations: DataFrame) -> DataFrame:
    """Each conversation's formatted text, turns and text under the loss mask, from the
    written segments in the ranges that its last node attends to."""
    ends = tree.select("start", "attends")
    asked = conversations.join(ends, "start").select(
        "conv", "n_turns", F.explode("attends").alias("_range")
    )
    # Ranges meet segments through the stretches of the sequence that they cover.
    low, high = F.col("_range")["from"], F.col("_range")["to"]
    stretch = F.sequence(F.floor(low / STRETCH), F.floor((high - 1) / STRETCH))
    asked = asked.select(
        "conv", "n_turns", low.alias("_from"), high.alias("_to"),
        F.explode(stretch).alias("_stretch"),
    )
    segments = tree.select(
        "start", "segment", "loss_from", "loss_length",
        F.floor(F.col("start") / STRETCH).alias("_stretch"),
    )
    parts = asked.join(segments, "_stretch").where(
        (F.col("start") >= F.col("_from")) & (F.col("start") < F.col("_to"))
    ).select(
        "conv", "n_turns", F.col("start").alias("_i"), "segment",
        F.substring(F.col("segment"), F.col("loss_from") + 1, F.col("loss_length")).alias("_loss"),
    )
    joined = parts.groupBy("conv", "n_turns").agg(
        F.sort_array(F.collect_list(F.struct("_i", "segment", "_loss"))).alias("_parts")
    )
    formatted = F.array_join(F.transform("_parts", lambda p: p["segment"]), "")
    loss = F.array_join(F.transform("_parts", lambda p: unescape(p["_loss"])), "")
    pieces = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, 1 << 30)
    body = lambda p: F.left(p, F.char_length(p) - len(END) - 1)
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substr(body(p), F.locate("\n", p) + 1)).alias("text"),
        ),
    )
    return joined.select(
        "conv", "n_turns", formatted.alias("formatted"), loss.alias("loss_text")
    ).withColumn("turns", turns)
