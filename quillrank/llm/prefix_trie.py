"""Prefix trie of conversations by the Euler-tour technique.

Turns are sorted once over all conversations, and running sums of turn fingerprints name every prefix: equal prefixes get
equal names, and a name is a node. The tour of the tree enters a node, tours its children in the order of their smallest
members and leaves the node; every node gives one enter and one exit arc, linked to the next. The list of arcs is ranked
distributedly, arcs are sorted by their rank, and prefix sums over the sorted arcs give, as differences between exit and
enter, what a subtree holds.

Ranking: stretches of the list that lie side by side in a sort order are one element afterwards, first along the
conversations, then along siblings; the elements left are ranked by pointer jumping. Sums that cross the border between two
tasks go on from one row per task, so no conversation, node or family of siblings has to fit into a task.

Prefixes are named by fingerprints of 64 bits: among n of them a pair meets with a chance of n * n / 2^65.

Defined cases: a null role or text is empty; turns are in the order of ``turn``, null first, ties in that of a fingerprint of
role and text; repeated rows are turns of their own; rows without a ``conv_id`` belong to no conversation; a table without
conversations gives no nodes, not even a root. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from quillrank.llm.words import mix
from quillrank.workspace import Workspace

SHARED = 6  # h is below that
GROUP = 100  # conversations with one base
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PART_BITS = 33
_IDS = 1 << 16  # of ids in one piece of a list


def power(exponents: np.ndarray) -> np.ndarray:
    """``_BASE`` to whole powers, modulo 2^64; negative ones too."""
    out = np.ones(len(exponents), np.uint64)
    left, square = np.abs(exponents).astype(np.uint64), np.where(exponents < 0, _INVERSE, _BASE)
    while left.any():
        out = np.where(left & np.uint64(1), out * square, out)
        square, left = square * square, left >> np.uint64(1)
    return out


def named(sums: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The name of the prefix of ``depth`` turns whose fingerprints add up to ``sums``."""
    return mix(sums + mix(depth.astype(np.uint64), 41), 42)


def batch_of(**columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


# Turns of a conversation, and the sums over them


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns in order, with their place in their conversation and the sum up to them, as far as this task has it."""
    part, conv, place, total = TaskContext.get().partitionId(), None, 0, np.uint64(0)
    for batch in batches:
        convs, prints = _column(batch, "conv_id"), _column(batch, "print").view(np.uint64)
        if not len(convs):
            continue
        first = np.concatenate([[True], convs[1:] != convs[:-1]])
        first[0] = convs[0] != conv
        begin = np.flatnonzero(first)
        of = np.cumsum(first) - 1  # -1 where the conversation goes on
        shift = np.where(of < 0, -place, begin[of] if len(begin) else 0)
        places = np.arange(len(convs)) - shift + 1
        terms = prints * power(places)
        sums = np.cumsum(terms)
        before = np.where(of < 0, np.uint64(0) - total, (sums - terms)[begin[of]] if len(begin) else np.uint64(0))
        sums = sums - before
        conv, place, total = convs[-1], int(places[-1]), sums[-1]
        yield batch_of(
            part=np.full(len(convs), part, np.int32),
            conv_id=convs,
            place=places,
            sums=sums.view(np.int64),
            prior=(sums - terms).view(np.int64),
            size=batch.column("size"),
        )


def _going_on(turns: DataFrame) -> dict[int, tuple[int, int, int]]:
    """For each task whose first conversation began in an earlier one: that conversation, its turns and their sum so far.

    From one row per task.
    """
    last = F.max(F.struct("conv_id", "place", "sums")).alias("last")
    rows = turns.groupBy("part").agg(F.min("conv_id").alias("first"), last).orderBy("part").collect()
    out, before = {}, None
    for row in rows:
        carry = before if before and before[0] == row["first"] else None
        if carry:
            out[row["part"]] = carry
        conv, place, sums = row["last"]["conv_id"], row["last"]["place"], row["last"]["sums"] % (1 << 64)
        if carry and conv == row["first"]:
            place, sums = carry[1] + place, (carry[2] + sums * int(power(np.array([carry[1]]))[0])) % (1 << 64)
        before = (conv, place, sums)
    return out


def _continued(carried: dict[int, tuple[int, int, int]]):
    """Places and sums as over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, convs = _column(batch, "part"), _column(batch, "conv_id")
            places = _column(batch, "place").copy()
            sums, prior = (_column(batch, name).view(np.uint64).copy() for name in ("sums", "prior"))
            for part in np.unique(parts).tolist():
                if part in carried:
                    conv, place, total = carried[part]
                    more = (parts == part) & (convs == conv)
                    factor = power(np.array([place]))
                    for values in (sums, prior):
                        values[more] = values[more] * factor + np.uint64(total)
                    places[more] += place
            yield batch_of(conv_id=convs, place=places, sums=sums.view(np.int64), prior=prior.view(np.int64), size=batch.column("size"))

    return run


def ordered_turns(conversations: DataFrame, workspace: Workspace) -> DataFrame:
    """``(conv_id, place, sums, prior, size)``: each turn with its place from 1 on, the sum of the fingerprints up to and
    before it, and the code points of its text."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(role, text).alias("print"), F.char_length(text).cast("long").alias("size")
    ).where(F.col("conv_id").isNotNull())
    turns = workspace.save(turns, "light")  # read twice: the bounds of the ranges come first
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("print"), F.asc("size")]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "print", "size")
    schema = "part int, conv_id long, place long, sums long, prior long, size long"
    running = workspace.save(ranged.mapInArrow(_running, schema), "running")
    schema = "conv_id long, place long, sums long, prior long, size long"
    return running.mapInArrow(_continued(_going_on(running)), schema)


# Members of nodes


def n_shared(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % SHARED).cast("long")


def rebuilt(conversations: DataFrame, workspace: Workspace) -> DataFrame:
    """``(conv_id, depth, node, parent, size, is_end)``: every prefix of every rebuilt conversation, the empty one included."""
    turns = workspace.save(ordered_turns(conversations, workspace), "turns")
    head = F.when(F.col("place") < SHARED, F.struct("place", "sums", "prior", "size"))
    heads = turns.groupBy("conv_id").agg(F.max("place").alias("n"), F.array_sort(F.collect_list(head)).alias("head"))
    heads = workspace.save(heads, "heads")
    own, conv = heads.withColumn("h", n_shared(F.col("conv_id"))), F.col("conv_id")
    base = heads.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    both = own.withColumn("base", conv - conv % GROUP).join(base, "base", "left")
    started = F.coalesce(F.slice("base_head", 1, F.col("h").cast("int")), F.array().cast(heads.schema["head"].dataType))
    last = lambda array: F.coalesce(F.try_element_at(array, F.lit(-1))["sums"], F.lit(0).cast("long"))
    convs = both.select("conv_id", "n", "h", started.alias("start"), last(F.slice("head", 1, F.col("h").cast("int"))).alias("left_out"))
    convs = convs.select("*", F.size("start").cast("long").alias("k"), last(F.col("start")).alias("taken"))
    convs = convs.withColumn("depths", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = workspace.save(convs, "convs")

    shared = convs.select("conv_id", "depths", F.explode("start").alias("turn")).select(
        "conv_id", F.col("turn.place").alias("depth"), "turn.sums", "turn.prior", "turn.size", "depths"
    )
    zero = F.lit(0).cast("long")
    root = convs.select("conv_id", zero.alias("depth"), zero.alias("sums"), zero.alias("prior"), zero.alias("size"), "depths")
    # A conversation may have any number of turns; both sides are written, so the join may be split there.
    rest = turns.join(convs.drop("start"), "conv_id").where(F.col("place") > F.col("h"))
    schema = "conv_id long, depth long, node long, parent long, size long, is_end boolean"
    moved = rest.select("conv_id", "place", "sums", "prior", "size", "h", "k", "left_out", "taken", "depths").mapInArrow(_moved, schema)
    return shared.union(root).mapInArrow(_plain, schema).union(moved)


def _node_batch(batch: pa.RecordBatch, depth: np.ndarray, sums: np.ndarray, prior: np.ndarray) -> pa.RecordBatch:
    return batch_of(
        conv_id=batch.column("conv_id"),
        depth=depth,
        node=named(sums, depth).view(np.int64),
        parent=pa.array(named(prior, depth - 1).view(np.int64), mask=depth == 0),
        size=batch.column("size"),
        is_end=depth == _column(batch, "depths"),
    )


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _node_batch(batch, *(_column(batch, "depth"), *(_column(batch, name).view(np.uint64) for name in ("sums", "prior"))))


def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's own turns, moved behind those taken from its base."""
    for batch in batches:
        moves = _column(batch, "k") - _column(batch, "h")
        left_out, taken = (_column(batch, name).view(np.uint64) for name in ("left_out", "taken"))
        sums, prior = ((_column(batch, name).view(np.uint64) - left_out) * power(moves) + taken for name in ("sums", "prior"))
        yield _node_batch(batch, _column(batch, "place") + moves, sums, prior)


# The tour


def _siblings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes in order of parent and smallest member, numbered; ``next`` is the sibling that follows, -1 where the task ends."""
    number = TaskContext.get().partitionId() << _PART_BITS
    held = None

    def finished(batch: pa.RecordBatch, start: int, follows: int | None) -> pa.RecordBatch:
        parent = pc.fill_null(batch.column("parent"), 0).to_numpy()
        ids = start + np.arange(len(batch))
        goes_on = np.append(parent[1:] == parent[:-1], follows is not None and follows == parent[-1])
        following = np.where(goes_on, ids + 1, 0)
        unknown = np.zeros(len(batch), bool)
        unknown[-1] = follows is None
        return batch_of(
            id=ids,
            **{name: batch.column(name) for name in ("node", "parent", "conv_id", "depth", "n_convs", "size")},
            next=pa.array(following, mask=~goes_on & ~unknown),
            is_open=unknown,
        )

    for batch in batches:
        if not len(batch):
            continue
        if held is not None:
            yield finished(held, number - len(held), int(pc.fill_null(batch.column("parent"), 0)[0].as_py()))
        held, number = batch, number + len(batch)
    if held is not None:
        yield finished(held, number - len(held), None)


def numbered_nodes(nodes: DataFrame, workspace: Workspace) -> DataFrame:
    """``nodes`` with ``id``, in order of parent and smallest member, and ``next``, the id of the next sibling."""
    order = [F.asc_nulls_first("parent"), F.asc("conv_id")]
    columns = ["node", "parent", "conv_id", "depth", "n_convs", "size"]
    ranged = nodes.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns)
    schema = "id long, node long, parent long, conv_id long, depth long, n_convs long, size long, next long, is_open boolean"
    saved = workspace.save(ranged.mapInArrow(_siblings, schema), "siblings")
    # The last node of a task may be followed by the first of the next: one row per task.
    ends = saved.groupBy(F.shiftright("id", _PART_BITS).alias("part")).agg(
        F.min_by(F.struct("id", "parent"), "id").alias("first"), F.max_by(F.struct("id", "parent"), "id").alias("last")
    )
    rows = ends.orderBy("part").collect()
    follows = [(a["last"]["id"], b["first"]["id"]) for a, b in zip(rows[:-1], rows[1:]) if a["last"]["parent"] == b["first"]["parent"]]
    known = saved.sparkSession.createDataFrame(follows, "id long, found long")
    joined = saved.join(F.broadcast(known), "id", "left")
    return joined.withColumn("next", F.when(F.col("is_open"), F.col("found")).otherwise(F.col("next"))).drop("found", "is_open")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements in some order, each with the first of its run, of which each is followed by the next, and its offset there."""
    head, before, wanted = None, 0, None
    for batch in batches:
        ids, length = _column(batch, "id"), _column(batch, "length")
        follows = pc.fill_null(batch.column("next"), -1).to_numpy()
        if not len(ids):
            continue
        starts = np.concatenate([[wanted != ids[0]], ids[1:] != follows[:-1]])
        begin = np.flatnonzero(starts)
        of = np.cumsum(starts) - 1
        heads = np.where(of < 0, head if head is not None else 0, ids[begin[of]] if len(begin) else 0)
        sums = np.cumsum(length) - length
        offset = np.where(of < 0, sums + before, sums - (sums[begin[of]] if len(begin) else 0))
        head, before, wanted = heads[-1], int(offset[-1] + length[-1]), int(follows[-1])
        yield batch_of(id=ids, head=heads, offset=offset, length=length, next=batch.column("next"))


def contracted(elements: DataFrame, order: list[Column], workspace: Workspace, name: str) -> tuple[DataFrame, DataFrame]:
    """``elements`` ``(id, next, length)`` of a linked list, runs of neighbours in ``order`` as one: where each element is,
    ``(id, head, offset)``, and the shorter list. A run ends with its task at the latest."""
    ranged = elements.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "next", "length")
    placed = workspace.save(ranged.mapInArrow(_runs, "id long, head long, offset long, length long, next long"), name)
    end = F.max_by(F.struct(F.col("next").alias("next"), (F.col("offset") + F.col("length")).alias("length")), "offset")
    shorter = placed.groupBy(F.col("head").alias("id")).agg(end.alias("end")).select("id", "end.next", "end.length")
    return placed.select("id", "head", "offset"), workspace.save(shorter, f"{name}-list")


def list_ranks(elements: DataFrame, workspace: Workspace) -> DataFrame:
    """``(id, rank)`` of a linked list ``(id, next, length)``: the length from each element to the end, itself included.

    Pointer jumping: every element adds what its next one has summed and takes over that one's next. A round halves the
    way to the end, so there are as many as the logarithm of the list's length.
    """
    state = workspace.save_measured(elements.select("id", "next", F.col("length").alias("rank")), "ranks", n_open=F.count_if(F.col("next").isNotNull()))
    while state.observed["n_open"]:
        open_ = state.frame.where(F.col("next").isNotNull())
        ahead = state.frame.select(F.col("id").alias("next"), F.col("next").alias("beyond"), F.col("rank").alias("more"))
        jumped = open_.join(ahead, "next").select("id", F.col("beyond").alias("next"), (F.col("rank") + F.col("more")).alias("rank"))
        jumped = state.frame.where(F.col("next").isNull()).union(jumped)
        state = workspace.save_measured(jumped, "ranks", n_open=F.count_if(F.col("next").isNotNull()))
    return state.frame.select("id", "rank")


def tour_ranks(arcs: DataFrame, workspace: Workspace) -> DataFrame:
    """``(id, rank)`` of the arcs ``(id, next, conv_id, along)``: along a conversation down and up again, then by number."""
    elements = arcs.withColumn("length", F.lit(1).cast("long"))
    first, shorter = contracted(elements, [F.asc("conv_id"), F.asc("along")], workspace, "down")
    second, shortest = contracted(shorter, [F.asc("id")], workspace, "across")
    ranks = list_ranks(shortest, workspace)
    for placed in (second, first):
        found = placed.join(ranks.select(F.col("id").alias("head"), "rank"), "head")
        ranks = workspace.save(found.select("id", (F.col("rank") - F.col("offset")).alias("rank")), "ranked")
    return ranks


def _prefix_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arcs in order of the tour with the sums up to them, as far as this task has them."""
    part, leaves, saved = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        if not len(batch):
            continue
        sums = [before + np.cumsum(_column(batch, name)) for before, name in ((leaves, "leaf"), (saved, "saved"))]
        leaves, saved = int(sums[0][-1]), int(sums[1][-1])
        yield batch_of(part=np.full(len(batch), part, np.int32), id=batch.column("id"), leaves=sums[0], saved=sums[1])


def subtree_sums(arcs: DataFrame, ranks: DataFrame, workspace: Workspace) -> DataFrame:
    """``(id, n_leaves, saved_tokens)`` of nodes, from prefix sums over the arcs ``(id, leaf, saved)`` in order of the tour.

    What a node's enter arc brings counts for the node.
    """
    weighted = workspace.save(arcs.select("id", "leaf", "saved").join(ranks, "id").select("id", "rank", "leaf", "saved"), "weighted")
    ranged = weighted.repartitionByRange(F.desc("rank")).sortWithinPartitions(F.desc("rank"))
    sums = workspace.save(ranged.mapInArrow(_prefix_sums, "part int, id long, leaves long, saved long"), "sums")
    parts = sums.groupBy("part").agg(F.max("leaves").alias("leaves"), F.max("saved").alias("saved")).orderBy("part").collect()
    below, rows = (0, 0), []
    for part in parts:  # one row per task
        rows.append((part["part"], *below))
        below = below[0] + part["leaves"], below[1] + part["saved"]
    before = F.broadcast(sums.sparkSession.createDataFrame(rows, "part int, leaves_before long, saved_before long"))
    placed = sums.join(before, "part").select("id", (F.col("leaves") + F.col("leaves_before")).alias("leaves"), (F.col("saved") + F.col("saved_before")).alias("saved"))
    is_exit = F.col("id").bitwiseAND(F.lit(1)) == 1
    sign = F.when(is_exit, F.lit(1)).otherwise(F.lit(-1)).cast("long")
    return placed.groupBy(F.shiftright("id", 1).alias("id")).agg(F.sum(sign * F.col("leaves")).alias("n_leaves"), F.sum(sign * F.col("saved")).alias("saved_tokens"))


# Lists of ids


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(node, first, ids)``: ids of conversations, in order of node and id, joined by commas, a piece at a time."""
    for batch in batches:
        nodes, convs = _column(batch, "node"), batch.column("conv_id")
        border = np.flatnonzero(nodes[1:] != nodes[:-1]) + 1
        starts = np.unique(np.concatenate([[0], border, np.arange(0, len(nodes), _IDS)])).astype(np.int64)
        starts = starts[starts < len(nodes)]
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(nodes)), pa.int32()), convs.cast(pa.string()))
        at = pa.array(starts)
        yield batch_of(node=batch.column("node").take(at), first=convs.take(at), ids=pc.binary_join(lists, ","))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(node, digest)`` from pieces in order; a task holds one piece and the state of the hash."""
    node, state = None, None
    for batch in batches:
        nodes, digests = [], []
        for at, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if at != node:
                if state is not None:
                    nodes.append(node)
                    digests.append(state.hexdigest())
                node, state = at, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield batch_of(node=pa.array(nodes, pa.int64()), digest=pa.array(digests, pa.string()))
    if state is not None:
        yield batch_of(node=pa.array([node], pa.int64()), digest=pa.array([state.hexdigest()], pa.string()))


def end_digests(members: DataFrame) -> DataFrame:
    """``(node, digest)``: SHA-256 of the ids, in order and joined by commas, of the conversations that end at a node.

    A hash is sequential, so a node's list goes through one task, but as pieces that many tasks have joined.
    """
    order = [F.asc("node"), F.asc("conv_id")]
    ends = members.where("is_end").select("node", "conv_id")
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pieces, "node long, first long, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_digests, "node long, digest string")


def prefix_trie(conversations: DataFrame, workspace: Workspace) -> DataFrame:
    """A row per distinct prefix of the rebuilt conversations: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)``.

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``. A conversation is rebuilt from the first h turns of
    the first one of its hundred and its own turns after the first h, where h follows from its id (``n_shared``).
    """
    members = workspace.save(rebuilt(conversations, workspace), "members")
    nodes = members.groupBy("node").agg(
        *[F.min(name).alias(name) for name in ("conv_id", "depth", "parent", "size")], F.count(F.lit(1)).alias("n_convs")
    )
    nodes = workspace.save(numbered_nodes(workspace.save(nodes, "nodes"), workspace), "numbered")
    families = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"), F.min("id").alias("child"))
    families = workspace.save(families, "families")
    above = nodes.join(families.select("node"), "node").select(F.col("node").alias("parent"), F.col("id").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    above = workspace.save(above, "above")
    tree = nodes.join(families, "node", "left").join(above, "parent", "left")
    tree = workspace.save(tree, "tree")

    enter, leave = F.col("id") * 2, F.col("id") * 2 + 1
    into = F.coalesce(F.col("child") * 2, leave)
    out = F.coalesce(F.col("next") * 2, F.col("up") * 2 + 1)
    leaf = F.col("child").isNull().cast("long")
    gain = (F.col("n_convs") - 1) * F.col("size")
    none = F.lit(0).cast("long")
    arcs = tree.select("conv_id", F.explode(F.array(
        F.struct(enter.alias("id"), into.alias("next"), F.col("depth").alias("along"), leaf.alias("leaf"), gain.alias("saved")),
        F.struct(leave.alias("id"), out.alias("next"), (F.lit(1 << 62) - F.col("depth")).alias("along"), none.alias("leaf"), none.alias("saved")),
    )).alias("arc")).select("conv_id", "arc.*")
    arcs = workspace.save(arcs, "arcs")
    sums = subtree_sums(arcs, tour_ranks(arcs, workspace), workspace)
    # The sums up to an enter arc hold the node's own part, which is added again.
    full = tree.withColumn("leaf", leaf).withColumn("gain", gain).join(sums, "id").join(end_digests(members), "node", "left")
    return full.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", none).alias("n_children"),
        (F.col("n_leaves") + F.col("leaf")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("gain")).alias("saved_tokens"),
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
