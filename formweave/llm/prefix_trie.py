"""The prefix trie of conversations as minimal-perfect-hash node tables.

A node is a distinct sequence of first turns, named by a 127-bit polynomial
digest, so the digest of any prefix follows from digests of parts.  Spark
counts the conversations of each digest and deals the nodes to shards.  In a
shard the digests get collision-verified slots, counts are scattered into flat
numpy arrays, and sums go up through the array of parent slots, deepest nodes
first.

Shards.  The weight of a node is the number of turns its conversations have
from it on: it bounds the nodes below it and falls with every step down.  With
``level = weight div shard_nodes``, a fragment is a connected part of the trie
of one level.  At level 0 fragments are whole subtrees; above, they are mere
paths, since two children of a node cannot both have its level.  Every fragment
has at most ``shard_nodes`` nodes, whatever the number of conversations through
a node or of turns in one.  Subtrees hand their sums to the path above
them; the few paths (at most R/n * log(R/n) for R turns) form a small tree that
is summed in one task.

No window runs over a conversation: turns are sorted in ranges, and only one
row per range carries over to the next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from formweave.llm.arrays import text_column
from formweave.llm.slot_table import SlotTable
from formweave.session import work_dir

HEAD_TURNS = 6
HEAD_EVERY = 100
SHARD_NODES = 1 << 17
RANGE_ROWS = 500_000
BLOCK_TURNS = 4096
CHUNK_BYTES = 1 << 18
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix trie").digest()[:15], "big") | 1
ROOT = bytes(16)


def turn_value(role: str, text: str) -> int:
    """A turn as a number from 1 to ``PRIME - 1``."""
    role = role.encode()
    return int.from_bytes(hashlib.sha256(b"%d:%s%s" % (len(role), role, text.encode())).digest()[:16],
                          "big") % (PRIME - 1) + 1


def _bytes(value: int) -> bytes:
    return value.to_bytes(16, "big")


def _int(value: bytes | None) -> int:
    return int.from_bytes(value, "big") if value else 0


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns of one range to ``part, conv_id, j, before, mark, chars``:
    place and digests count from the conversation's first turn in the range."""
    conv, j, digest = None, 0, 0
    for batch in batches:
        ids = batch.column(batch.schema.names.index("conv_id")).to_pylist()
        role, text = text_column(batch, "role"), text_column(batch)
        places, before, after = [], [], []
        for i, r, t in zip(ids, role, text):
            if i != conv:
                conv, j, digest = i, 0, 0
            j += 1
            places.append(j)
            before.append(_bytes(digest))
            digest = (digest * BASE + turn_value(r.as_py(), t.as_py())) % PRIME
            after.append(_bytes(digest))
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.names.index("part")), pa.array(ids, pa.int64()), pa.array(places, pa.int64()),
             pa.array(before, pa.binary()), pa.array(after, pa.binary()),
             pc.utf8_length(text).cast(pa.int64())], ["part", "conv_id", "j", "before", "mark", "chars"])


def _carry(carried: dict[int, tuple[int, int, int]]):
    """Places and digests of whole conversations, from those of ranges."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, conv, j, before, mark, chars = (c.to_pylist() for c in batch.columns)
            for i in range(len(part)):
                at = carried.get(part[i])
                if at and at[0] == conv[i]:
                    low = pow(BASE, j[i] - 1, PRIME)
                    before[i] = _bytes((at[2] * low + _int(before[i])) % PRIME)
                    mark[i] = _bytes((at[2] * low * BASE + _int(mark[i])) % PRIME)
                    j[i] += at[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv, pa.int64()), pa.array(j, pa.int64()), pa.array(before, pa.binary()),
                 pa.array(mark, pa.binary()), pa.array(chars, pa.int64())], ["conv_id", "j", "before", "mark", "chars"])
    return rows


def placed_turns(conversations: DataFrame, folder: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``conv_id, j, before, mark, chars`` of every turn: its place from 1, the
    digests of the turns before it and with it, and its code points.

    Turns are sorted in ranges; a range's first conversation takes place and
    digest over from the ranges before it (one row per range on the driver)."""
    spark = conversations.sparkSession
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turn = F.col("turn").asc_nulls_first()
    # the head of role and text orders as they do, and keeps the samples small
    head = [F.substring("role", 1, 32), F.when(F.length("role") <= 32, F.substring("text", 1, 32))]
    (rows.repartitionByRange(1 + rows.count() // range_rows, F.col("conv_id"), turn, *head)
     .sortWithinPartitions("conv_id", turn, "role", "text")
     .select(F.spark_partition_id().alias("part"), "conv_id", "role", "text")
     .mapInArrow(_chain, "part int, conv_id bigint, j bigint, before binary, mark binary, chars bigint")
     .write.parquet(f"{folder}/ranges"))
    ranges = spark.read.parquet(f"{folder}/ranges")
    ends = (ranges.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "j", "mark")).alias("last"))
            .orderBy("part").collect())
    carried, held = {}, None
    for e in ends:
        conv, j, digest = e["last"]["conv_id"], e["last"]["j"], _int(bytes(e["last"]["mark"]))
        if held and held[0] == e["first"]:
            carried[e["part"]] = held
            if conv == held[0]:
                digest = (held[2] * pow(BASE, j, PRIME) + digest) % PRIME
                j += held[1]
        held = (conv, j, digest)
    (ranges.select("part", "conv_id", "j", "before", "mark", "chars")
     .mapInArrow(_carry(carried), "conv_id bigint, j bigint, before binary, mark binary, chars bigint")
     .write.parquet(f"{folder}/turns"))
    return spark.read.parquet(f"{folder}/turns")


def _shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of own turns behind a head: the digest of the own first turns
    is exchanged for that of the head."""
    power: dict[int, int] = {}
    for batch in batches:
        conv, d, m, before, mark, cut, head, chars, length = (c.to_pylist() for c in batch.columns)
        for i in range(len(conv)):
            moved = _int(head[i]) - _int(cut[i])
            if moved:
                low = power.get(m[i])
                if low is None:
                    if len(power) > 100_000:
                        power.clear()
                    low = power[m[i]] = pow(BASE, m[i] - 1, PRIME)
                before[i] = _bytes((moved * low + _int(before[i])) % PRIME)
                mark[i] = _bytes((moved * low * BASE + _int(mark[i])) % PRIME)
        yield pa.RecordBatch.from_arrays(
            [pa.array(conv, pa.int64()), pa.array(d, pa.int64()), pa.array(mark, pa.binary()),
             pa.array(before, pa.binary()), pa.array(chars, pa.int64()), pa.array(length, pa.int64())],
            ["conv_id", "d", "mark", "parent", "chars", "len"])


def rebuilt_prefixes(turns: DataFrame, head_turns: int = HEAD_TURNS, head_every: int = HEAD_EVERY,
                     block_turns: int = BLOCK_TURNS) -> DataFrame:
    """``conv_id, d, mark, parent, chars, len`` of every prefix (from the empty
    one) of every rebuilt conversation.

    Conversation c begins with the first h turns of c - c % ``head_every``,
    h = crc32(c) % ``head_turns``, and goes on with its own after its first h."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(head_turns))
    convs = turns.withColumn("h", h).groupBy("conv_id", "h").agg(
        F.count("*").alias("n"), F.max(F.when(F.col("j") == F.col("h"), F.col("mark"))).alias("cut"))
    heads = (turns.where((F.col("conv_id") % head_every == 0) & (F.col("j") < head_turns))
             .groupBy(F.col("conv_id").alias("head_id"))
             .agg(F.sort_array(F.collect_list(F.struct("j", "mark", "before", "chars"))).alias("head")))
    shared = F.slice(F.coalesce("head", F.array().cast("array<struct<j:bigint,mark:binary,before:binary,chars:bigint>>")),
                     F.lit(1), F.col("h").cast("int"))
    convs = (convs.join(heads, F.col("conv_id") - F.col("conv_id") % head_every == F.col("head_id"), "left")
             .withColumn("shared", shared)
             .withColumn("k", F.size("shared"))
             .withColumn("len", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
             .select("conv_id", "h", "n", "cut", "shared", "k", "len"))
    root = convs.select("conv_id", F.lit(0).cast("bigint").alias("d"), F.lit(ROOT).alias("mark"),
                        F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("chars"), "len")
    first = convs.select("conv_id", "len", F.explode("shared").alias("t")).select(
        "conv_id", F.col("t.j").alias("d"), "t.mark", F.col("t.before").alias("parent"), "t.chars", "len")
    # own turns meet their conversation in blocks, so a long one is many keys
    facts = convs.where("n > h").select(
        "conv_id", "h", "k", "cut", F.try_element_at("shared", F.lit(-1))["mark"].alias("head"), "len",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"n div {block_turns}"))).alias("block"))
    own = (turns.withColumn("block", F.expr(f"j div {block_turns}")).join(facts, ["conv_id", "block"])
           .where("j > h")
           .select("conv_id", (F.col("k") + F.col("j") - F.col("h")).alias("d"), (F.col("j") - F.col("h")).alias("m"),
                   "before", "mark", "cut", "head", "chars", "len")
           .mapInArrow(_shift, "conv_id bigint, d bigint, mark binary, parent binary, chars bigint, len bigint"))
    return root.unionByName(first).unionByName(own)


def fragments(prefixes: DataFrame, folder: str, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The distinct nodes, each with the fragment it lies in: ``mark, parent,
    depth, conv_id, chars, n_convs, level, frag`` (the mark of the fragment's
    top), written below ``folder``."""
    spark = prefixes.sparkSession
    heavy = prefixes.groupBy("mark").agg(F.sum(F.col("len") - F.col("d") + 1).alias("w"))
    heavy.where(F.col("w") >= shard_nodes).select("mark", F.expr(f"w div {shard_nodes}").alias("level")).write.parquet(
        f"{folder}/heavy")
    rows = prefixes.join(spark.read.parquet(f"{folder}/heavy"), "mark", "left").withColumn(
        "level", F.coalesce("level", F.lit(0)))
    # along a conversation a level spans fewer than shard_nodes turns
    along = Window.partitionBy("conv_id", "level").orderBy("d")
    (rows.withColumn("frag", F.first("mark").over(along)).groupBy("mark")
     .agg(F.max("parent").alias("parent"), F.max("d").alias("depth"), F.min("conv_id").alias("conv_id"),
          F.max("chars").alias("chars"), F.count("*").alias("n_convs"), F.max("level").alias("level"),
          F.min("frag").alias("frag"))
     .write.parquet(f"{folder}/nodes"))
    return spark.read.parquet(f"{folder}/nodes")


def _keys(column: pa.ChunkedArray) -> np.ndarray:
    flat = b"".join(v or bytes(16) for v in column.to_pylist())
    return np.frombuffer(flat, np.uint64).reshape(-1, 2)


def _accumulate(table: pa.Table) -> pa.Table:
    """Sums of one shard's subtrees through parent slots, in order of depth.

    ``own_children``, ``own_leaves`` and ``own_saved`` are what a node brings
    in, besides the nodes of the shard."""
    marks = _keys(table.column("mark"))
    slot_of = SlotTable(marks)
    slot = slot_of.slots(marks)
    has_parent = table.column("parent").is_valid().to_numpy()
    up = np.full(len(slot), -1, np.int64)
    parent_slot = slot_of.slots(_keys(table.column("parent")))
    up[slot] = np.where(has_parent, parent_slot, -1)

    def scattered(name: str) -> np.ndarray:
        out = np.zeros(len(slot), np.int64)
        out[slot] = table.column(name).to_numpy()
        return out

    depth, conv, children, leaves, saved = (
        scattered(c) for c in ("depth", "conv_id", "own_children", "own_leaves", "own_saved"))
    inside = up >= 0
    children += np.bincount(up[inside], minlength=len(up))
    leaves += children == 0
    order = np.argsort(-depth, kind="stable")
    starts = np.flatnonzero(np.diff(depth[order], prepend=-1))
    for at, end in zip(starts, [*starts[1:], len(order)]):
        nodes = order[at:end][inside[order[at:end]]]
        np.add.at(leaves, up[nodes], leaves[nodes])
        np.add.at(saved, up[nodes], saved[nodes])
    above = np.where(inside, conv[up], 0)
    parent_conv = pa.array(above[slot], mask=~inside[slot])
    return pa.table({
        "mark": table.column("mark").combine_chunks(), "parent": table.column("parent").combine_chunks(),
        "top": pa.array(~inside[slot]), "conv_id": table.column("conv_id").combine_chunks(),
        "depth": table.column("depth").combine_chunks(),
        "parent_conv_id": pc.coalesce(parent_conv, table.column("outer_conv").combine_chunks()),
        "n_convs": table.column("n_convs").combine_chunks(), "n_children": pa.array(children[slot]),
        "n_leaves": pa.array(leaves[slot]), "saved_tokens": pa.array(saved[slot])})


_SUMS = ("mark binary, parent binary, top boolean, conv_id bigint, depth bigint, parent_conv_id bigint, "
         "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint")


def _path_totals(table: pa.Table) -> pa.Table:
    """Sums over the tree of path fragments, by the same arrays."""
    out = _accumulate(table)
    return pa.table({"mark": out["mark"], "n_leaves": out["n_leaves"], "saved_tokens": out["saved_tokens"]})


def _sharded(nodes: DataFrame, shards: int) -> DataFrame:
    return nodes.groupBy(F.pmod(F.xxhash64("frag"), F.lit(shards))).applyInArrow(_accumulate, _SUMS)


def subtree_sums(nodes: DataFrame, folder: str, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """Children, leaves and saved tokens of every node, from :func:`fragments`."""
    spark = nodes.sparkSession
    shards = 1 + nodes.count() // shard_nodes
    zero = F.lit(0).cast("bigint")
    paths = nodes.where("level > 0")
    owners = paths.select(F.col("mark").alias("_mark"), F.col("conv_id").alias("outer_conv"))
    rows = (nodes.join(owners, (F.col("parent") == F.col("_mark")) & (F.col("mark") == F.col("frag")), "left").drop("_mark")
            .withColumn("own_saved", (F.col("n_convs") - 1) * F.col("chars")))
    light = rows.where("level = 0").withColumn("own_children", zero).withColumn("own_leaves", zero)
    _sharded(light, shards).write.parquet(f"{folder}/light")
    light = spark.read.parquet(f"{folder}/light")

    # what whole subtrees hand to the paths above them
    inflow = light.where("top and parent is not null").groupBy(F.col("parent").alias("mark")).agg(
        F.count("*").alias("in_children"), F.sum("n_leaves").alias("in_leaves"), F.sum("saved_tokens").alias("in_saved"))
    on_path = paths.where("parent is not null").groupBy(F.col("parent").alias("mark")).agg(F.count("*").alias("path_children"))
    n = {c: F.coalesce(c, zero) for c in ("in_children", "in_leaves", "in_saved", "path_children")}
    (rows.where("level > 0").join(inflow, "mark", "left").join(on_path, "mark", "left")
     .select("mark", "parent", "depth", "conv_id", "outer_conv", "n_convs", "frag", n["in_children"].alias("own_children"),
             n["in_leaves"].alias("own_leaves"), (F.col("own_saved") + n["in_saved"]).alias("own_saved"),
             ((n["in_children"] + n["path_children"]) == 0).cast("bigint").alias("leaf"))
     .write.parquet(f"{folder}/paths"))
    paths = spark.read.parquet(f"{folder}/paths")

    # the tree of the paths themselves
    whole = paths.groupBy("frag").agg(
        F.sum(F.col("own_leaves") + F.col("leaf")).alias("own_leaves"), F.sum("own_saved").alias("own_saved"))
    tops = paths.where("mark = frag").select("mark", F.col("parent").alias("hangs_at"), "depth", "conv_id")
    over = paths.select(F.col("mark").alias("hangs_at"), F.col("frag").alias("parent"))
    # one own child keeps a path without paths below from counting as a leaf
    tree = tops.join(over, "hangs_at", "left").join(whole.withColumnRenamed("frag", "mark"), "mark").select(
        "mark", "parent", "depth", "conv_id", F.lit(None).cast("bigint").alias("outer_conv"),
        F.lit(1).cast("bigint").alias("n_convs"), F.lit(1).cast("bigint").alias("own_children"), "own_leaves", "own_saved")
    totals = tree.groupBy("n_convs").applyInArrow(_path_totals, "mark binary, n_leaves bigint, saved_tokens bigint")
    below = (totals.join(tops.where("hangs_at is not null").select("mark", "hangs_at"), "mark").groupBy(F.col("hangs_at").alias("mark"))
             .agg(F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")))
    # paths that share a shard are not linked there: their sums have come in already
    filled = paths.join(below, "mark", "left").select(
        "mark", F.when(F.col("mark") != F.col("frag"), F.col("parent")).alias("parent"), "depth", "conv_id", "outer_conv", "n_convs", "frag",
        *[(F.col(a) + F.coalesce(b, zero)).alias(a) for a, b in (("own_children", "c"), ("own_leaves", "l"), ("own_saved", "s"))])
    return light.unionByName(_sharded(filled, shards))


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``mark, conv_id`` of one range to comma-joined ids: whole lists
    of a node as pieces of at most about ``CHUNK_BYTES``."""
    mark, ids, first, held = None, [], None, 0
    marks, firsts, joined = [], [], []
    size = 0
    for batch in batches:
        for m, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if m != mark or held > CHUNK_BYTES:
                if ids:
                    marks.append(mark), firsts.append(first), joined.append(",".join(ids))
                    size += held
                mark, ids, first, held = m, [], c, 0
                if size > 4 * CHUNK_BYTES or len(marks) > 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(marks, pa.binary()), pa.array(firsts, pa.int64()),
                                                      pa.array(joined, pa.string())], ["mark", "first", "ids"])
                    marks, firsts, joined, size = [], [], [], 0
            ids.append(str(c))
            held += len(ids[-1]) + 1
    if ids:
        marks.append(mark), firsts.append(first), joined.append(",".join(ids))
    if marks:
        yield pa.RecordBatch.from_arrays([pa.array(marks, pa.binary()), pa.array(firsts, pa.int64()),
                                          pa.array(joined, pa.string())], ["mark", "first", "ids"])


def _digest_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of ``mark, first`` to one digest per mark."""
    mark, digest = None, None
    for batch in batches:
        marks, digests = [], []
        for m, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if m != mark:
                if digest is not None:
                    marks.append(mark), digests.append(digest.hexdigest())
                mark, digest = m, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(marks, pa.binary()), pa.array(digests, pa.string())], ["mark", "ends_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([mark], pa.binary()), pa.array([digest.hexdigest()], pa.string())],
                                         ["mark", "ends_sha256"])


def ends_digests(prefixes: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``mark, ends_sha256`` for every node at which conversations end.

    The ids are sorted in ranges and joined to pieces there, so a node at which
    very many conversations end is a few long rows when its digest, which has
    to run through all ids, is computed."""
    ends = prefixes.where("d = len").select("mark", "conv_id")
    return (ends.repartitionByRange(1 + ends.count() // range_rows, "mark", "conv_id").sortWithinPartitions("mark", "conv_id")
            .mapInArrow(_join_ids, "mark binary, first bigint, ids string")
            .repartition("mark").sortWithinPartitions("mark", "first")
            .mapInArrow(_digest_lists, "mark binary, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, head_turns: int = HEAD_TURNS, head_every: int = HEAD_EVERY,
                shard_nodes: int = SHARD_NODES, range_rows: int = RANGE_ROWS,
                block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``; ``(conv_id, depth)`` names the node.

    ``conversations`` has ``conv_id, turn, role, text``.  Turns are in order
    of ``turn`` (null first), then role and text; null roles and texts are
    empty; equal rows are turns of their own.  Rows without ``conv_id`` belong
    to no conversation.  A conversation without turns after rebuilding is a
    member of the root alone.  Other columns are ignored; an empty table has
    no nodes."""
    spark: SparkSession = conversations.sparkSession
    folder = work_dir(spark, "trie")
    turns = placed_turns(conversations, folder, range_rows)
    rebuilt_prefixes(turns, head_turns, head_every, block_turns).write.parquet(f"{folder}/prefixes")
    prefixes = spark.read.parquet(f"{folder}/prefixes")
    nodes = fragments(prefixes, folder, shard_nodes)
    sums = subtree_sums(nodes, folder, shard_nodes)
    return sums.join(ends_digests(prefixes, range_rows), "mark", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
