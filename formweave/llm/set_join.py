"""Near-duplicate removal by a chosen-path set similarity join.

Documents are sets of word shingles.  Independent random trees branch the
documents recursively: at every level a node is split by the minwise
token of a chosen hash function, so similar sets follow the same path
with a probability equal to their similarity.  Nodes small enough are
compared exhaustively on signatures.  What they propose only joins
documents into candidate clusters; within these, links are decided on the
full sets, so no false link survives and no link inside a cluster is lost.

Scale.  Equal sets are one class from the start (a map-side combined
aggregate).  Nodes travel as ``(tree, node, id)``; a node that stays large
to the last level is not compared but taken as one cluster, by an
aggregate.  Sets are shipped once, only for documents in clusters, and
clusters beyond ``block_rows`` are cut into blocks (see ``_link_large``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.llm.arrays import LOWER, mix, shingle_sets, slices, word_hashes, words, with_id
from formweave.llm.components import connected_components, cut
from formweave.llm.minwise import permutations, signatures

HASHES = 64          # coordinates of a signature
SURE = 0.5           # signature agreement below which a pair at 0.8 is ruled out (six deviations, see Recall)


def _sets(k: int, with_set: bool):
    """Arrow mapper: shingle set of every text, as a digest and signature or
    in full."""
    a, b = permutations(HASHES, 20)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, max_bytes=2 << 20):
            data = LOWER[data]
            starts, ends, first = words(data, offsets)
            hashes = word_hashes(data, starts, ends)
            items, at = shingle_sets(hashes, first, k)
            if with_set:
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("cluster"), rows.column("block"),
                     pa.array([items[lo:hi].tobytes() for lo, hi in zip(at, at[1:])], pa.binary())],
                    ["doc_id", "cluster", "block", "items"])
                continue
            sizes, digest = np.diff(at), np.zeros((2, rows.num_rows), np.uint64)
            full = np.flatnonzero(sizes)
            if len(full):
                digest[:, full] = [np.add.reduceat(x, at[full]) for x in (items, mix(items))]
            digest = digest.view(np.int64)
            marks = signatures(items, at, a, b).view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(sizes), pa.array(digest[0]), pa.array(digest[1]),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(marks) + 1) * HASHES, pa.int32()),
                                          pa.array(marks.ravel()))],
                ["doc_id", "n_shingles", "h1", "h2", "marks"])

    return run


def _compare_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node: within each node, compare all signatures and
    give the edges of a spanning forest of the pairs that agree enough."""
    left = None

    def edges(ids: np.ndarray, marks: np.ndarray) -> list[tuple[int, int]]:
        out, todo = [], np.arange(len(ids))
        while len(todo):             # breadth first over the pairs that agree
            front, todo = todo[:1], todo[1:]
            while len(front) and len(todo):
                alike = (marks[todo] == marks[front[0]]).mean(axis=1) >= SURE
                out += [(int(ids[front[0]]), int(ids[t])) for t in todo[alike]]
                front, todo = np.concatenate((front[1:], todo[alike])), todo[~alike]
        return out

    def flush(group: pa.Table) -> list[tuple[int, int]]:
        node = group.column("node").to_numpy()
        ids = group.column("rep").to_numpy()
        marks = group.column("marks").combine_chunks().flatten().to_numpy().reshape(-1, HASHES)
        cuts = np.flatnonzero(np.diff(node)) + 1
        return [e for lo, hi in zip([0, *cuts], [*cuts, len(node)]) for e in edges(ids[lo:hi], marks[lo:hi])]

    def batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                           pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    for rows in batches:
        table = pa.Table.from_batches([rows])
        if left is not None:
            table = pa.concat_tables([left, table])
        node = table.column("node").to_numpy()
        cut = int(np.searchsorted(node, node[-1])) if len(node) else 0   # the last node may go on
        if cut:
            yield batch(flush(table.slice(0, cut)))
        left = table.slice(cut)
    if left is not None and left.num_rows:
        yield batch(flush(left))


def link_sets(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges that connect exactly the sets linked by
    ``100 * intersection >= percent * union``, directly or through others.

    One set at a time is compared with all others through an inverted
    index.  Sets with common items go first; once a component is the
    largest, only sets outside it still need their turn, because a pair
    that is left out then has both ends in that component."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(place, kind="stable")
    holders = owner[order]
    first = np.concatenate(([0], np.cumsum(np.bincount(place))))
    begin = np.concatenate(([0], np.cumsum(size)))
    common = np.add.reduceat((first[place + 1] - first[place]).astype(float), begin[:-1]) / size
    label, turn, out = np.arange(m), np.argsort(-common, kind="stable"), []
    waiting = np.ones(m, bool)
    while True:
        largest = np.bincount(label).argmax()
        open_ = turn[waiting[turn] & (label[turn] != largest)]
        if largest == label[turn[0]] and waiting[turn[0]] and (label == largest).sum() == 1:
            open_ = turn[waiting[turn]]          # nothing is linked yet: the first set may go too
        if not len(open_):
            return out
        i = open_[0]
        waiting[i] = False
        items = place[begin[i]:begin[i + 1]]
        spans = [holders[first[x]:first[x + 1]] for x in items]
        both = np.bincount(np.concatenate(spans), minlength=m)
        for j in np.flatnonzero(100 * both >= percent * (size + size[i] - both)):
            if label[j] != label[i]:
                out.append((int(ids[i]), int(ids[j])))
                label[label == label[j]] = label[i]


def _link_blocks(percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("items").to_pylist()]
        found = link_sets(ids, sets, percent)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()),
                         "b": pa.array([y for _, y in found], pa.int64())})

    return run


def links_in_clusters(documents: DataFrame, placed: DataFrame, k: int, percent: int) -> DataFrame:
    """Links inside each ``(cluster, block)`` of ``placed`` (doc_id, cluster,
    block), decided on the full sets."""
    return (with_id(documents, "text").join(placed, "doc_id")
            .mapInArrow(_sets(k, True), "doc_id bigint, cluster bigint, block bigint, items binary")
            .groupBy("cluster", "block").applyInArrow(_link_blocks(percent), "a bigint, b bigint"))


def _link_large(documents: DataFrame, members: DataFrame, k: int, percent: int, block_rows: int,
                rounds: int = 2) -> DataFrame:
    """Links of clusters beyond ``block_rows`` (``members``: id, cluster, n).

    Every round deals a cluster into blocks by another hash and adds the
    same few pivots to each block; near copies of one text link to a pivot
    and so become one component without comparing all pairs.  A last round
    compares every document outside its cluster's largest component with
    every block.  Then no pair is left whose ends are in different
    components, so the result is that of comparing all pairs."""
    blocks = F.ceil(F.col("n") / F.lit(block_rows)).cast("bigint")
    found = None

    def spread(some: DataFrame) -> DataFrame:
        return some.select("id", "cluster", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("block"))

    def dealt(seed: int) -> DataFrame:
        return members.select("id", "cluster", F.pmod(F.xxhash64("id", F.lit(seed)), blocks).alias("block"))

    for seed in range(rounds):
        pivots = spread(members.where(F.pmod(F.xxhash64("id", F.lit(100 + seed)),
                                             F.ceil(F.col("n") / 16).cast("bigint")) == 0))
        placed = dealt(seed).union(pivots).distinct().withColumnRenamed("id", "doc_id")
        edges, _ = cut(links_in_clusters(documents, placed, k, percent), "links")
        found = edges if found is None else found.union(edges)
    labels = connected_components(found)
    labelled = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    main = (labelled.groupBy("cluster", "component").count()
            .groupBy("cluster").agg(F.max_by("component", F.struct("count", "component")).alias("main")))
    rest = labelled.join(main, "cluster").where("component <> main").select("id", "cluster", "n")
    placed = dealt(0).union(spread(rest)).distinct().withColumnRenamed("id", "doc_id")
    return found.union(links_in_clusters(documents, placed, k, percent))


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80, trees: int = 10, levels: int = 3,
                    leaf_rows: int = 2048, block_rows: int = 4096) -> DataFrame:
    """One row per row of ``documents`` (columns ``doc_id``, ``text``):
    ``doc_id, n_shingles, component_id, kept``.

    The set of a document is its distinct ``k``-word shingles after lowering
    A-Z (a shorter text is one shingle as a whole).  Documents with
    ``100 * intersection >= percent * union`` are linked; ``component_id``
    is the smallest doc_id reachable and ``kept`` marks that document.

    Recall: a pair at similarity s meets in one tree with probability of at
    least ``s * (1 - (1 - s)**2) ** (levels - 1)``: 0.74 at 0.8, so ten
    trees miss it with probability 2e-6.  Where it meets, its signatures
    agree in less than ``SURE`` with probability 2e-08.

    Null and blank texts have no shingles: they are linked with nothing.
    Rows that share a doc_id are one document (linked with each other when
    they have shingles).  Rows without doc_id are linked with nothing, have
    no component and are kept.  Very long texts are one array of hashes.
    Other columns are ignored; an empty table gives no rows.
    """
    sets, _ = cut(with_id(documents, "text").mapInArrow(
        _sets(k, False), "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint, marks array<int>"), "sets")
    full = sets.where("n_shingles > 0 and doc_id is not null")
    classes, _ = cut(full.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("marks").alias("marks")), "classes")

    def coordinate(tree, level: int, branch: int):
        """The chosen hash function of a node; it differs by tree, level and branch."""
        return F.element_at("marks", (tree * 6 + max(0, level * 2 + branch - 1)) % HASHES + 1)

    rows = (classes.select("rep", "marks", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
            .select("rep", "tree", F.xxhash64("tree", coordinate(F.col("tree"), 0, 0)).alias("node")))
    leaves = None
    for level in range(1, levels + 1):
        counted = rows.groupBy("tree", "node").count()
        small = counted.where(F.col("count").between(2, leaf_rows))
        part = rows.join(small, ["tree", "node"]).select("node", "rep")
        leaves = part if leaves is None else leaves.union(part)
        rows, _ = cut(rows.join(counted.where(F.col("count") > leaf_rows), ["tree", "node"]).drop("count"), "nodes")
        if level < levels:
            rows = (rows.join(classes.select("rep", "marks"), "rep")
                    .select("rep", "tree", F.explode(F.array(*[
                        F.xxhash64("node", F.lit(branch), coordinate(F.col("tree"), level, branch))
                        for branch in (0, 1)])).alias("node")))
    large = rows.groupBy("tree", "node").agg(F.min("rep").alias("b"))
    edges = rows.join(large, ["tree", "node"]).select(F.col("rep").alias("a"), "b")
    compared = (leaves.join(classes.select("rep", "marks"), "rep")
                .repartition("node").sortWithinPartitions("node")
                .mapInArrow(_compare_nodes, "a bigint, b bigint"))
    # rows with one doc_id in several classes tie these classes together
    homes = full.join(classes.select("h1", "h2", "rep"), ["h1", "h2"]).select("doc_id", "rep").distinct()
    least = homes.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("most")).where("b <> most")
    same_id = homes.join(least, "doc_id").select(F.col("rep").alias("a"), "b")
    clusters, _ = cut(connected_components(compared.union(edges)), "clusters")
    members = clusters.join(clusters.groupBy("component").agg(F.count("*").alias("n")), "component") \
        .select("id", F.col("component").alias("cluster"), "n")
    one = members.where(F.col("n") <= block_rows)
    links = links_in_clusters(documents, one.select(F.col("id").alias("doc_id"), "cluster", F.lit(0).cast("bigint").alias("block")),
                   k, percent)
    several, _ = cut(members.where(F.col("n") > block_rows), "several")
    if several.take(1):
        links = links.union(_link_large(documents, several, k, percent, block_rows))
    component = connected_components(links.union(same_id))
    reps = (classes.select("h1", "h2", "rep").join(component, F.col("rep") == F.col("id"), "left")
            .select("h1", "h2", F.coalesce("component", "rep").alias("component_id")))
    return (sets.select("doc_id", "n_shingles", "h1", "h2")
            .withColumn("known", F.expr("n_shingles > 0 and doc_id is not null"))
            .join(reps.withColumn("known", F.lit(True)), ["known", "h1", "h2"], "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
