"""Conversation prefix trie by bursting.

A conversation is a sequence of turns (role, text); a node is a distinct
sequence of first turns.  Sequences fall into containers of suffixes that hang
under a trie head; a container starts at one turn below its head.  A container
with more than ``CONTAINER_TURNS`` turns bursts: the turns that all its
sequences share become a chain of head nodes, and what follows is dealt into
new containers by the next turn's id.  The others are sorted by their turn ids
in a shard's task and swept once into nodes; the heads then add up what hangs
below them, last round first.

* A turn id is the first 16 bytes of the SHA-256 of role and text, so texts
  are read once and never shuffled.
* Equal conversations are one sequence with a number of members.  Sequences
  are compared by their length and two 64-bit sums over (place, turn id),
  which are partial aggregates, so no conversation and no group of copies has
  to be gathered to be compared.
* Bursting follows a shared path in one round whatever its length, so the
  rounds follow the branchings of large groups, not the turns.  Turns stay
  rows until a container is small: at most ``CONTAINER_TURNS`` turns.
* The members that end at a node are joined into one text for its hash in
  pieces: ranges of (sequence, id) make pieces, and a sequence's pieces are
  hashed in order as they stream by.

Defined results: null roles and texts are empty; null turn numbers come first,
equal ones are ordered by turn id; repeated rows are turns of their own; rows
with a null conv_id belong to no conversation; an empty table has no nodes;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealsieve.llm.common import materialise, ship_by_value, small_batches

CONTAINER_TURNS = 2048
CELL = 256                  # places of a chain, or of a conversation's rows, that are numbered together
PIECE_IDS = 1 << 14         # ids in a piece of the joined members
ID_BYTES = 16

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string")
NODE_COLUMNS = [c.split()[0] for c in NODE.split(", ")]
NOTHING = hashlib.sha256(b"").hexdigest()


def turn_rows(turns: DataFrame) -> DataFrame:
    """conv_id, turn, turn_id and size (code points of the text) of every row with a conv_id."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    # The role's length keeps (role, text) apart from other cuts of the same characters.
    whole = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(whole, 1, 2 * ID_BYTES)).alias("turn_id"), F.length(text).cast("long").alias("size"))


def number_turns(rows: DataFrame) -> DataFrame:
    """Adds place, from 1, to rows of (conv_id, turn, turn_id, size) by turn (null first), then turn id.

    Rows are range-partitioned and numbered as each range's sorted rows stream
    by, so a conversation with any number of turns is numbered in many tasks.
    Only the first conversation of a range can have rows in an earlier one:
    the rows of these conversations are counted per range, which gives at most
    two counts a range, whatever the input.
    """
    def count_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before = None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            new = np.concatenate([[conv[0] != last], conv[1:] != conv[:-1]])
            begin = np.maximum.accumulate(np.where(new, np.arange(len(conv)), -before))
            place = np.arange(1, len(conv) + 1) - begin
            last, before = conv[-1], int(place[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(place), batch.column(1), batch.column(2)],
                                             ["conv_id", "k", "turn_id", "size"])

    order = ["conv_id", F.asc_nulls_first("turn"), "turn_id", "nth"]
    ranged = materialise(
        rows.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv_id", "turn_id", "size").mapInArrow(count_on, "conv_id long, k long, turn_id binary, size long")
        .withColumn("range", F.spark_partition_id()), "turns")
    first = ranged.groupBy("range").agg(F.min("conv_id").alias("conv_id")).select("conv_id").distinct()
    counts = ranged.join(first, "conv_id").groupBy("conv_id", "range").agg(F.max("k").alias("n")) \
        .orderBy("conv_id", "range").collect()
    offsets, before = [], {}
    for r in counts:
        offsets.append((r.conv_id, r.range, before.get(r.conv_id, 0)))
        before[r.conv_id] = before.get(r.conv_id, 0) + r.n
    table = rows.sparkSession.createDataFrame(offsets, "conv_id long, range int, first long")
    return ranged.join(F.broadcast(table), ["conv_id", "range"], "left") \
        .select("conv_id", (F.col("k") + F.coalesce("first", F.lit(0))).alias("place"), "turn_id", "size")


def sequences(placed: DataFrame, members: DataFrame) -> DataFrame:
    """One row a distinct sequence: seq (its smallest conv_id), n members, n_turns, and ends, the SHA-256 of the
    members' conv_ids in ascending order and joined by commas.

    Ranges of (sequence, conv_id) join their ids in pieces; a sequence's
    pieces are hashed in order as they stream by.
    """
    def total(seed):
        # A sum of 64-bit hashes in a decimal: no order, no overflow; null places (members) add nothing.
        return F.coalesce(F.sum(F.when(F.col("place").isNotNull(), F.xxhash64("place", "turn_id", F.lit(seed)))
                                .cast("decimal(38,0)")), F.lit(0)).cast("string")

    rows = placed.select("conv_id", "place", "turn_id").unionByName(
        members.select("conv_id", F.lit(None).cast("long").alias("place"), F.lit(None).cast("binary").alias("turn_id")))
    keyed = rows.groupBy("conv_id").agg(F.count("place").alias("n_turns"), total(1).alias("a"), total(2).alias("b")) \
        .select("conv_id", "n_turns", F.xxhash64("a", "n_turns").alias("a"), F.xxhash64("b").alias("b"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, out = None, [], []
        for batch in batches:
            for *k, i in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (k != key or len(ids) == PIECE_IDS):
                    out.append((*key, ids[0], len(ids), ",".join(map(str, ids))))
                    ids = []
                key = k
                ids.append(i)
            if out:
                yield _batch(out, pieces)
                out = []
        if ids:
            yield _batch([(*key, ids[0], len(ids), ",".join(map(str, ids)))], pieces)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, state, out = None, None, None, []
        for batch in batches:
            for *k, first, n, text in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key:
                    if state:
                        out.append((*own, state.hexdigest()))
                    key, own, state = k, [first, n, k[0]], hashlib.sha256(text.encode())
                else:
                    own[1] += n
                    state.update(b"," + text.encode())
            if out:
                yield _batch(out, kinds)
                out = []
        if state:
            yield _batch([(*own, state.hexdigest())], kinds)

    pieces = [("n_turns", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("n", pa.int64()),
              ("ids", pa.string())]
    kinds = [("seq", pa.int64()), ("n", pa.int64()), ("n_turns", pa.int64()), ("ends", pa.string())]
    key, order = ["n_turns", "a", "b"], ["n_turns", "a", "b", "conv_id"]
    cut = materialise(keyed, "members").repartitionByRange(*order).sortWithinPartitions(*order).select(*order) \
        .mapInArrow(joined, "n_turns long, a long, b long, first long, n long, ids string")
    return cut.repartition(*key).sortWithinPartitions(*key, "first") \
        .mapInArrow(hashed, "seq long, n long, n_turns long, ends string")


def _batch(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], schema=pa.schema(kinds))


def _following(turns: DataFrame, heads: DataFrame) -> DataFrame:
    """The turns of the sequences in ``heads`` (seq, box, depth, ...) below their head."""
    return turns.join(heads, "seq").where("place > depth")


def _boxes(turns: DataFrame, held: DataFrame, low: int, high: int) -> DataFrame:
    """Sequences (seq, n, n_turns, ends, depth, above, over) dealt into boxes by the turn below their head.

    ``above`` is the box of the head, ``over`` its smallest conv_id; depths
    lie between ``low`` and ``high``.
    """
    following = turns.where(F.col("place").between(low + 1, high + 1)) \
        .select("seq", (F.col("place") - 1).alias("depth"), "turn_id")
    return held.where("n_turns > depth").join(following, ["seq", "depth"]) \
        .withColumn("box", F.sha2(F.concat(F.col("above").cast("binary"), "turn_id"), 256)).drop("turn_id")


def _large(boxed: DataFrame) -> DataFrame:
    """One row a box to burst: its head, smallest conv_id (top), members and number of sequences."""
    return boxed.groupBy("box").agg(
        F.first("above").alias("above"), F.first("over").alias("over"), F.first("depth").alias("depth"), F.min("seq").alias("top"),
        F.sum("n").alias("members"), F.count(F.lit(1)).alias("n_seqs"), F.sum(F.col("n_turns") - F.col("depth")).alias("n_left")) \
        .where(F.col("n_left") > CONTAINER_TURNS).drop("n_left")


def _paths(turns: DataFrame, held: DataFrame) -> DataFrame:
    """(box, place, size, same): whether all sequences of a box to burst have one turn, the same one, at a place.

    Where they do at a place, they do at every place above it.
    """
    return _following(turns, held.select("seq", "box", "depth", "n_seqs")).groupBy("box", "place").agg(
        F.min("size").alias("size"),
        ((F.min("turn_id") == F.max("turn_id")) & (F.count(F.lit(1)) == F.first("n_seqs"))).alias("same"))


def sweep(rows: list[tuple[bytes, list[int], int, int, str]], depth: int, over: int | None) -> list[tuple]:
    """Nodes of one container: rows are (turn ids joined, sizes, smallest conv_id, members, hash of the ends).

    Sorted rows share their longest prefixes with their neighbours, so a stack
    of open nodes is enough: a node is closed when a row leaves its path.
    """
    nodes: list[list] = []      # parent, depth, smallest id, members, children, leaves, saved, size, ends
    path: list[int] = []
    before = b""

    def close(keep: int) -> None:
        while len(path) > keep:
            own = nodes[path.pop()]
            own[5] = own[5] or 1
            own[6] += (own[3] - 1) * own[7]
            if path:
                up = nodes[path[-1]]
                up[2] = min(up[2], own[2])
                up[3] += own[3]
                up[4] += 1
                up[5] += own[5]
                up[6] += own[6]

    for ids, sizes, seq, n, ends in sorted(rows, key=lambda r: r[0]):
        common = 0
        while common < len(path) and before[common * ID_BYTES:(common + 1) * ID_BYTES] == ids[common * ID_BYTES:(common + 1) * ID_BYTES]:
            common += 1
        close(common)
        for k in range(common, len(sizes)):
            nodes.append([path[-1] if path else None, depth + k + 1, seq, 0, 0, 0, 0, sizes[k], NOTHING])
            path.append(len(nodes) - 1)
        own = nodes[path[-1]]
        own[2], own[3], own[8] = min(own[2], seq), own[3] + n, ends
        before = ids
    close(0)
    return [(x[2], x[1], over if x[0] is None else nodes[x[0]][2], *x[3:7], x[8]) for x in nodes]


def _swept(turns: DataFrame, small: DataFrame) -> DataFrame:
    """Nodes of all small boxes: one bounded list a sequence, sorted and swept box by box.

    ``above`` is the head's box in a box's top node, else null.
    """
    carried = ["box", "above", "depth", "over", "n", "ends"]
    rows = _following(turns, small.select("seq", *carried)).groupBy("seq").agg(
        *[F.first(c).alias(c) for c in carried], F.sort_array(F.collect_list(F.struct("place", "turn_id", "size"))).alias("t")) \
        .select(*carried, "seq", F.col("t.turn_id").alias("ids"), F.col("t.size").alias("sizes"))
    kinds = [("above", pa.string()), *[(c, pa.string() if c == "ends_sha256" else pa.int64()) for c in NODE_COLUMNS]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box, held, out = None, [], []

        def done() -> None:
            # A box's first node is its top.
            for k, node in enumerate(sweep(held, box["depth"], box["over"])):
                out.append((None if k else box["above"], *node))

        for batch in batches:
            for row in batch.to_pylist():
                if box and row["box"] != box["box"]:
                    done()
                    held = []
                box = row
                held.append((b"".join(row["ids"]), row["sizes"], row["seq"], row["n"], row["ends"]))
            if out:
                yield _batch(out, kinds)
                out = []
        if held:
            done()
            yield _batch(out, kinds)

    return small_batches(rows).repartition("box").sortWithinPartitions("box").mapInArrow(run, "above string, " + NODE)


def _from_below(chain: DataFrame) -> DataFrame:
    """Adds below: the sum of (members - 1) * size from a chain's place to its end, in cells of ``CELL`` places."""
    cost = (F.col("members") - 1) * F.col("size")
    cells = chain.withColumn("cell", F.floor(F.col("place") / CELL)).withColumn("cost", cost)
    lower = Window.partitionBy("box").orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    rest = cells.groupBy("box", "cell").agg(F.sum("cost").alias("s")) \
        .select("box", "cell", F.coalesce(F.sum("s").over(lower), F.lit(0)).alias("rest"))
    inside = Window.partitionBy("box", "cell").orderBy(F.desc("place"))
    return cells.withColumn("own", F.sum("cost").over(inside)).join(rest, ["box", "cell"]) \
        .withColumn("below", F.col("own") + F.col("rest")).drop("cell", "cost", "own", "rest")


def build_trie(placed: DataFrame, members: DataFrame) -> DataFrame:
    """All nodes of the trie of ``placed`` (conv_id, place, turn_id, size) over ``members`` (conv_id, turnless ones too).

    A node is named by its smallest member and its depth; the root has depth 0.
    """
    placed = materialise(placed, "placed")
    seqs = materialise(sequences(placed, members), "sequences")
    turns = materialise(placed.withColumnRenamed("conv_id", "seq").join(seqs.select("seq"), "seq", "left_semi"), "seq-turns")
    # The root is a head of its own, with all members: one row of totals.
    whole = seqs.agg(F.min("seq").alias("seq"), F.sum("n").alias("n"),
                     F.max(F.when(F.col("n_turns") == 0, F.col("ends"))).alias("ends")).first()
    if whole.n is None:
        return placed.sparkSession.createDataFrame([], NODE)
    held = seqs.withColumn("depth", F.lit(0).cast("long")).withColumn("above", F.lit("")).withColumn("over", F.lit(whole.seq))
    low = high = 0
    rounds, small = [], None
    while True:
        boxed = materialise(_boxes(turns, held, low, high), "boxes")
        large = materialise(_large(boxed), "large")
        part = boxed.join(large.select("box"), "box", "left_anti")
        small = part if small is None else small.unionByName(part)
        if not large.take(1):
            break
        held = boxed.join(large.select("box", "top", "n_seqs"), "box")
        path = materialise(_paths(turns, held), "paths")
        last = materialise(path.groupBy("box").agg(
            F.coalesce(F.min(F.when(~F.col("same"), F.col("place") - 1)), F.max("place")).alias("last")), "last")
        low, high = last.agg(F.min("last"), F.max("last")).first()
        held = held.join(last, "box")
        ends = held.where("n_turns = last").select("box", "ends")
        rounds.append((large.join(last, "box").join(ends, "box", "left"), path.join(last, "box").where("place <= last").drop("last")))
        held = held.select("seq", "n", "n_turns", "ends", F.col("last").alias("depth"), F.col("box").alias("above"),
                           F.col("top").alias("over"))
    nodes = materialise(_swept(turns, small), "swept")
    tops = nodes.where("above IS NOT NULL").select("above", "n_leaves", "saved_tokens")
    parts = [nodes.select(*NODE_COLUMNS)]
    for heads, chain in reversed(rounds):
        sums = tops.groupBy("above").agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
                                         F.sum("saved_tokens").alias("saved")).withColumnRenamed("above", "box")
        tall = materialise(heads.join(sums, "box", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
                           .withColumn("n_leaves", F.coalesce("n_leaves", F.lit(1)))
                           .withColumn("saved", F.coalesce("saved", F.lit(0))), "heads")
        line = _from_below(chain.join(tall.select("box", "members"), "box")).drop("members")
        is_top, is_last = F.col("place") == F.col("depth") + 1, F.col("place") == F.col("last")
        made = materialise(line.join(tall, "box").select(
            F.when(is_top, F.col("above")).alias("above"), F.col("top").alias("conv_id"), F.col("place").alias("depth"),
            F.when(is_top, F.col("over")).otherwise(F.col("top")).alias("parent_conv_id"), F.col("members").alias("n_convs"),
            F.when(is_last, F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"), "n_leaves",
            (F.col("saved") + F.col("below")).alias("saved_tokens"),
            F.coalesce(F.when(is_last, F.col("ends")), F.lit(NOTHING)).alias("ends_sha256")), "head-nodes")
        parts.append(made.select(*NODE_COLUMNS))
        # What this round's boxes hold counts for the heads above them, beside the small boxes there.
        tops = tops.unionByName(made.where("above IS NOT NULL").select("above", "n_leaves", "saved_tokens"))
    below = tops.where("above = ''").agg(F.count(F.lit(1)).alias("k"), F.sum("n_leaves").alias("leaves"),
                                         F.sum("saved_tokens").alias("saved")).first()
    root = placed.sparkSession.createDataFrame(
        [(whole.seq, 0, None, whole.n, below.k, below.leaves or 1, below.saved or 0, whole.ends or NOTHING)], NODE)
    for part in parts:
        root = root.unionByName(part)
    return root


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of a table of conversations (conv_id, turn, role, text)."""
    placed = number_turns(turn_rows(turns))
    return build_trie(placed, placed.select("conv_id"))


def with_texts(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes with the role and text of their last turn (null for the root), from a table of placed turns
    (conv_id, place, role, text): the smallest member's turn at the node's depth is the node's."""
    own = turns.select("conv_id", F.col("place").alias("depth"), "role", "text")
    return nodes.join(own, ["conv_id", "depth"], "left")


ship_by_value(__name__)
