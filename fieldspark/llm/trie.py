"""The prefix trie of conversations, with totals of every subtree.

A node is a different sequence of first turns; its members are the conversations that start with it.
Turns are told apart by two 64-bit hashes of role and text. Sorted by conversation and place over
ranges, a running sum of hashes that take in the depth gives each prefix its name and that of its
parent, so a node costs one row whatever its depth, and a conversation may be longer than a task.

A node belongs to its smallest member. The nodes of one owner form a path that ends where the owner
does and hangs off a path of a smaller owner. Subtree totals come by time-forward processing of these
paths: a shard is a range of owners whose paths are sorted in reverse level order, by the depth of
their first node, and each passes its total to the path it hangs off through a priority queue ordered
as the rows are, which spills to disk. What is still addressed when its receiver should have come
leaves the shard, one message a receiver. Receivers in other shards make a smaller tree, in which each
hangs off the next receiver beyond its own shard; the same passes go over that tree, and then the
shards run again with what they receive from outside. The totals of single nodes on a path are
running sums again.

Null roles and texts are taken as empty; a null turn comes first; equal turns of one conversation
are ordered by the hashes of what they say, and repeated rows are turns of their own. Rows without a
conversation are passed over. Texts are only hashed and measured, where they are read, so long ones
cost nothing later. Other columns aren't read. No conversations give no nodes.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import U64, checkpointed
from fieldspark.operators.lookup import lookup

#: Paths of a shard, and how many times more those of the next smaller tree hold.
SHARD_PATHS, SHARD_GROWTH = 200_000, 8
#: Messages that a queue holds before it spills, and those that it reads back at a time.
QUEUE_MESSAGES, QUEUE_READ = 200_000, 4_096
#: Characters of a list of members that go through at a time.
PIECE_CHARS = 1 << 15

_NODE = ("depth", "x", "y")


def _ranged(df: DataFrame, order: Sequence[Column], parts: int | None = None, inside: Sequence[Column] | None = None) -> DataFrame:
    """The rows in order over ranges, with the number of their range, written."""
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return checkpointed(ranged.sortWithinPartitions(*(inside or order)).withColumn("part", F.spark_partition_id()))


def _runs(groups: np.ndarray) -> np.ndarray:
    """Where each run of equal groups starts."""
    return np.concatenate([[0], np.flatnonzero(groups[1:] != groups[:-1]) + 1])


def _columns(batch: pa.RecordBatch, names: Sequence[str]) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in names]


def _tails(batches: Iterator[pa.RecordBatch], group: str, values: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """One row a range: its first and last group, and the sums of the last."""
    part = first = last = None
    sums = [0] * len(values)
    for batch in batches:
        if not batch.num_rows:
            continue
        groups, *numbers = _columns(batch, [group, *values])
        if part is None:
            part, first = batch.column("part")[0].as_py(), int(groups[0])
        at = _runs(groups)[-1]
        if at or int(groups[0]) != last:
            sums = [0] * len(values)
        sums = [s + int(v[at:].astype(U64).sum(dtype=U64)) for s, v in zip(sums, numbers)]
        last = int(groups[-1])
    if part is not None:
        row = [part, first, last, *[np.array(s % (1 << 64), U64).view(np.int64).item() for s in sums]]
        kinds = [pa.int32()] + [pa.int64()] * (len(row) - 1)
        names = ["part", "first", "last", *[f"s{i}" for i in range(len(values))]]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)


def _summed(batches: Iterator[pa.RecordBatch], group: str, values: Sequence[str], before: dict) -> Iterator[pa.RecordBatch]:
    current, sums = None, np.zeros(len(values), dtype=U64)
    started = False
    for batch in batches:
        if not batch.num_rows:
            continue
        groups, *numbers = _columns(batch, [group, *values])
        if not started:
            started = True
            if carried := before.get(batch.column("part")[0].as_py()):
                current, sums = carried[0], np.array(carried[1:], dtype=np.int64).view(U64)
        starts = _runs(groups)
        sizes = np.diff(np.append(starts, len(groups)))
        for i, v in enumerate(numbers):
            v = v.astype(np.int64).view(U64)
            upto = np.cumsum(v, dtype=U64)
            base = upto[starts] - v[starts]
            if groups[0] == current:
                base[0] -= sums[i]
            upto -= np.repeat(base, sizes)
            batch = batch.append_column(f"{values[i]}_upto", pa.array(upto.view(np.int64)))
            batch = batch.append_column(f"{values[i]}_before", pa.array((upto - v).view(np.int64)))
            numbers[i] = upto
        current, sums = groups[-1], np.array([u[-1] for u in numbers], dtype=U64)
        yield batch


def running(ranged: DataFrame, group: str, values: Sequence[str]) -> DataFrame:
    """Running sums of 64-bit numbers within groups, modulo 2 ** 64, of rows in order over ranges:
    ``<value>_upto`` with the row, ``<value>_before`` without. The driver gets a row for each range."""
    numbers = ", ".join(f"s{i} bigint" for i in range(len(values)))
    narrow = ranged.select("part", group, *values)
    found = narrow.mapInArrow(partial(_tails, group=group, values=values), f"part int, first bigint, last bigint, {numbers}")
    before, carried = {}, None
    for part, first, last, *sums in sorted(map(tuple, found.collect())):
        before[part] = carried
        if carried and first == last == carried[0]:
            sums = [np.array((a + b) % (1 << 64), U64).view(np.int64).item() for a, b in zip(sums, carried[1:])]
        carried = (last, *sums)
    added = ", ".join(f"{v}_upto bigint, {v}_before bigint" for v in values)
    kinds = ", ".join(f"`{c}` {k}" for c, k in ranged.dtypes)
    return ranged.mapInArrow(partial(_summed, group=group, values=values, before=before), f"{kinds}, {added}")


def numbered(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, place, a, b, bytes) of every turn: its place in its conversation from 1 on, two hashes
    of what it says, and the UTF-8 bytes of its text."""
    said = [F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col)]
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"),
        F.xxhash64(*said).alias("a"), F.xxhash64(F.lit(1), *said).alias("b"),
        F.octet_length(said[1]).cast("bigint").alias("bytes"), F.lit(1).cast("bigint").alias("one"),
    )
    # a number for each row spreads copies of one turn over ranges; their order among themselves is no matter
    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("a"), F.col("b"), F.rand(11)]
    ranged = _ranged(turns, order, inside=order[:-1])
    placed = running(ranged, "conv", ["one"])
    return checkpointed(placed.select("conv", F.col("one_upto").alias("place"), "a", "b", "bytes"))


class Queue:
    """A priority queue of (key, receiver, sums…) tuples of integers that keeps no more than a number
    of them in memory: beyond it they are sorted, added up by receiver and written to a file."""

    def __init__(self, width: int, limit: int = QUEUE_MESSAGES) -> None:
        self._width, self._limit = width, limit
        self._heap: list[tuple] = []
        self._runs: list[tuple[tuple, int, Iterator[tuple]]] = []  # the head of each file, its number, the rest
        self.spills = 0

    def push(self, message: tuple) -> None:
        if len(self._heap) >= self._limit:
            self._spill()
        heapq.heappush(self._heap, message)

    def _spill(self) -> None:
        rows = np.array(self._heap, dtype=np.int64)
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(rows[:, :2], axis=0) != 0).any(axis=1)]))
        rows = np.concatenate([rows[new, :2], np.add.reduceat(rows[:, 2:], new)], axis=1)
        file = tempfile.TemporaryFile()  # scratch of this task alone
        rows.tofile(file)
        file.seek(0)
        self._heap.clear()
        self.spills += 1
        self._open(self._read(file), self.spills)

    def _read(self, file) -> Iterator[tuple]:
        with file:
            while data := file.read(8 * self._width * QUEUE_READ):
                yield from map(tuple, np.frombuffer(data, dtype=np.int64).reshape(-1, self._width).tolist())

    def _open(self, rest: Iterator[tuple], number: int) -> None:
        head = next(rest, None)
        if head is not None:
            heapq.heappush(self._runs, (head, number, rest))

    def peek(self) -> tuple | None:
        heads = [q[0] for q in (self._heap, [r[0] for r in self._runs[:1]]) if q]
        return min(heads) if heads else None

    def pop(self) -> tuple:
        if self._runs and (not self._heap or self._runs[0][0] < self._heap[0]):
            head, number, rest = heapq.heappop(self._runs)
            self._open(rest, number)
            return head
        return heapq.heappop(self._heap)


_PATH = ("owner", "top", "up", "up_top")
_CLIMBED = "inner boolean, owner bigint, top bigint, up bigint, up_top bigint, leaves bigint, saved bigint"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.bool_()] + [pa.int64()] * 6
    names = ["inner", *_PATH, "leaves", "saved"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _climb(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Paths of a shard in reverse level order with the totals of what hangs off them inside the
    shard, and the messages that leave it (``inner`` false: owner and top are the receiver's)."""
    queue, out = Queue(4, limit), []

    def leave(message: tuple) -> None:
        if out and not out[-1][0] and out[-1][1] == message[1] and out[-1][2] == -message[0]:
            *head, leaves, saved = out.pop()
            out.append((*head, leaves + message[2], saved + message[3]))
        else:
            out.append((False, message[1], -message[0], None, None, message[2], message[3]))

    for batch in batches:
        for owner, top, up, up_top, leaves, saved in zip(*(batch.column(c).to_pylist() for c in (*_PATH, "leaves", "saved"))):
            key = (-top, owner)
            while (head := queue.peek()) is not None and head[:2] <= key:
                message = queue.pop()
                if message[:2] == key:
                    leaves, saved = leaves + message[2], saved + message[3]
                else:
                    leave(message)
            out.append((True, owner, top, up, up_top, leaves, saved))
            if up is not None:
                queue.push((-up_top, up, leaves, saved))
        if len(out) >= 10_000:
            yield _batch(out[:-1])
            del out[:-1]
    while queue.peek() is not None:
        leave(queue.pop())
    if out:
        yield _batch(out)


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every path of a shard, the first path outside of the shard that it hangs off, if any."""
    held = [b for b in batches if b.num_rows]  # as many rows as a shard has
    beyond: dict[int, tuple] = {}
    for batch in reversed(held):
        rows = list(zip(*(batch.column(c).to_pylist() for c in _PATH)))
        for owner, _, up, up_top in reversed(rows):
            beyond[owner] = beyond.get(up, (up, up_top))
        found = [(owner, *beyond[owner]) for owner, *_ in rows]
        kinds = [pa.int64()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=["owner", "up", "up_top"])


def path_totals(paths: DataFrame, shard_paths: int | None = None) -> DataFrame:
    """The paths (owner, top, up, up_top, leaves, saved) with the sums over all that hang off them."""
    shard_paths = shard_paths or SHARD_PATHS
    paths = checkpointed(paths.select(*_PATH, "leaves", "saved"))
    shards = -(-paths.count() // shard_paths) or 1
    order = [F.desc("top"), F.col("owner")]

    def climbed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        ranged = _ranged(df, [F.col("owner")], shards, order)
        return ranged, checkpointed(ranged.mapInArrow(partial(_climb, limit=QUEUE_MESSAGES), _CLIMBED))

    ranged, local = climbed(paths)
    leaving = local.where(~F.col("inner")).groupBy("owner", "top").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    if shards > 1 and not leaving.isEmpty():
        exits = ranged.mapInArrow(_exits, "owner bigint, up bigint, up_top bigint")
        smaller = leaving.join(exits, "owner")
        received = path_totals(smaller, shard_paths * SHARD_GROWTH).select(
            "owner", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved")
        )
        whole = paths.join(received, "owner", "left").fillna(0, ["more_leaves", "more_saved"])
        whole = whole.withColumns({c: F.col(c) + F.col(f"more_{c}") for c in ("leaves", "saved")}).drop("more_leaves", "more_saved")
        _, local = climbed(whole)
    return local.where("inner").drop("inner")


def _members(batches: Iterator[pa.RecordBatch], piece_chars: int) -> Iterator[pa.RecordBatch]:
    """Digests of the lists of members of nodes within a range; pieces of the lists of the first and
    the last node, which may go on in other ranges, and of very long lists."""
    names = [*_NODE, "first_end", "ends_sha256", "part", "seq", "piece"]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.int32(), pa.int64(), pa.string()]
    out: list[tuple] = []
    node = part = None
    first_end = seq = chars = 0
    held: list[str] = []
    open_ended = True  # whether the list of the node began before this range, or has left in pieces

    def pieces() -> None:
        nonlocal seq, chars
        if held:
            out.append((*node, first_end, None, part, seq, ",".join(held)))
            seq, chars = seq + 1, 0
            held.clear()

    def close() -> None:
        if open_ended:
            pieces()
        else:
            out.append((*node, first_end, hashlib.sha256(",".join(held).encode()).hexdigest(), part, 0, None))
            held.clear()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("part")[0].as_py()
        for *here, conv in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "conv"))):
            if here != node:
                if node is not None:
                    close()
                    open_ended = False
                node, first_end, seq, chars = here, conv, 0, 0
            held.append(str(conv))
            chars += len(held[-1]) + 1
            if chars >= piece_chars:
                open_ended = True
                pieces()
        if out:
            yield batch_of(out)
            out.clear()
    if node is not None:
        open_ended = True
        close()
    if out:
        yield batch_of(out)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of lists from their pieces in order."""
    node, first_end, digest, out = None, 0, None, []

    def close() -> None:
        if node is not None:
            out.append((*node, first_end, digest.hexdigest()))

    for batch in batches:
        for *here, first, piece in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "first_end", "piece"))):
            if here != node:
                close()
                node, first_end, digest = here, first, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
    close()
    if out:
        kinds = [pa.int64()] * 4 + [pa.string()]
        names = [*_NODE, "first_end", "ends_sha256"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def _ends(prefixes: DataFrame) -> DataFrame:
    """(node, first_end, ends_sha256) of the nodes at which conversations end. A digest takes its list
    in order, so the pieces of a hot node meet in one task; they are spelled and sorted before."""
    last = prefixes.groupBy("conv").agg(F.max(F.struct(*_NODE)).alias("node")).select("conv", "node.*")
    ranged = _ranged(last, [F.col(c) for c in (*_NODE, "conv")])
    node = "depth bigint, x bigint, y bigint, first_end bigint, ends_sha256 string"
    found = checkpointed(ranged.mapInArrow(partial(_members, piece_chars=PIECE_CHARS), f"{node}, part int, seq bigint, piece string"))
    pieces = found.where("piece IS NOT NULL").repartition(*_NODE).sortWithinPartitions(*_NODE, "part", "seq")
    whole = found.where("piece IS NULL").select(*_NODE, "first_end", "ends_sha256")
    return whole.unionByName(pieces.mapInArrow(_joined, node)).select(F.struct(*_NODE).alias("end_node"), "first_end", "ends_sha256")


def nodes_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of conversations in the form of ``numbered`` (``place`` may have gaps); ``convs`` holds
    every ``conv`` once, also those without turns.

    A row per node: conv_id (its smallest member, which with the depth names it), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over its subtree, for each node
    the members beyond the first times the bytes of its last text) and ends_sha256 (of the members that
    end there, in order, joined by commas).
    """
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("place", "a", "b", "bytes")]
    rows = turns.select("conv", "place", "a", "b", "bytes").unionByName(convs.select("conv", *zero))
    ranged = _ranged(rows.withColumn("one", F.lit(1).cast("bigint")), [F.col("conv"), F.col("place")])
    deep = running(ranged, "conv", ["one"]).withColumn("depth", F.col("one_before")).drop("one", "one_upto", "one_before")
    hashed = deep.withColumn("x", F.xxhash64("depth", "a", "b")).withColumn("y", F.xxhash64("b", "depth", "a"))
    named = running(hashed, "conv", ["x", "y"])
    prefixes = checkpointed(named.select(
        "conv", "depth", "bytes", F.col("x_upto").alias("x"), F.col("y_upto").alias("y"),
        F.col("x_before").alias("px"), F.col("y_before").alias("py"),
    ))

    grouped = prefixes.groupBy(*_NODE).agg(
        F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n_convs"),
        F.max("bytes").alias("bytes"), F.max("px").alias("px"), F.max("py").alias("py"),
    )
    parent = F.when(F.col("depth") > 0, F.struct((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")))
    nodes = checkpointed(grouped.select(
        F.struct(*_NODE).alias("node"), parent.alias("parent"), "depth", "owner", "n_convs",
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("own_saved"),
    ))
    owners = nodes.select(F.col("node").alias("parent_node"), F.col("owner").alias("up"))
    nodes = checkpointed(
        lookup(nodes, owners, "parent", "parent_node", hot_from=nodes, spread_by=["owner", "depth"]).drop("parent")
    )

    paths = checkpointed(nodes.groupBy("owner").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.sum("own_saved").alias("saved"),
        F.max(F.when(F.col("up") != F.col("owner"), F.col("up"))).alias("up"),
    ))
    tops = paths.select(F.col("owner").alias("up_owner"), F.col("top").alias("up_top"))
    placed = lookup(paths, tops, "up", "up_owner", hot_from=paths, spread_by=["owner"])
    held = paths.where("up IS NOT NULL").select(F.col("up").alias("owner"), (F.col("top") - 1).alias("bottom"), F.lit(0).alias("leaves")).distinct()
    leafy = placed.join(held, ["owner", "bottom"], "left").fillna(1, ["leaves"])
    totals = path_totals(leafy.withColumn("leaves", F.col("leaves").cast("bigint")))

    received = totals.where("up IS NOT NULL").groupBy(F.col("up").alias("owner"), (F.col("top") - 1).alias("depth")).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.count(F.lit(1)).alias("paths")
    )
    ends = _ends(prefixes)
    full = nodes.join(received, ["owner", "depth"], "left").fillna(0, ["leaves", "saved", "paths"])
    full = full.join(ends, F.col("node") == F.col("end_node"), "left").drop("node", "end_node")
    is_bottom = F.coalesce(F.col("first_end") == F.col("owner"), F.lit(False))
    full = full.withColumns({
        "bottom": is_bottom,
        "leaves": F.col("leaves") + (is_bottom & (F.col("paths") == 0)).cast("bigint"),
        "saved": F.col("saved") + F.col("own_saved"),
    })
    summed = running(_ranged(full, [F.col("owner"), F.desc("depth")]), "owner", ["leaves", "saved"])
    return summed.select(
        F.col("owner").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), "n_convs",
        (F.col("paths") + (~F.col("bottom")).cast("bigint")).alias("n_children"),
        F.col("leaves_upto").alias("n_leaves"), F.col("saved_upto").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def prefix_trie(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The trie of a table of turns, see ``nodes_of``."""
    turns = numbered(conversations, conv_col, turn_col, role_col, text_col)
    return nodes_of(turns, turns.select("conv").distinct())
