"""SimHash near duplicates, linked exactly within a Hamming distance by vantage-point trees.

Every distinct fingerprint is handled once, so exact copies cost nothing further. A top tree of
vantage points, fitted to a bounded sample, splits the space into shards; each fingerprint belongs
to one shard, and also visits the shards on the other side of a boundary that lies within the
link distance (the triangle inequality rules out all others). A shard finds its links with a tree
of its own and sends back one edge per fingerprint that has any, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import U64, checkpointed, components, slices, text_bytes

_SEED = 42
_BITS_AT_ONCE = 1 << 15


def fingerprint(text: bytes, words: int = 3) -> int:
    """The SimHash of a text: bit b is set if more than half of its shingles' hashes have it.

    Shingles are ``words`` consecutive words (``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower
    case), repeats included; a shorter text is one shingle, one without words gives zero.
    """
    split = text.lower().split()
    if not split:
        return 0
    joined = b" ".join(split)
    digest = xxhash.xxh64_digest
    if len(split) <= words:
        return int.from_bytes(digest(joined, _SEED), "big")
    gaps = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 0x20)
    starts = np.concatenate([[0], gaps + 1])[: 1 - words].tolist()
    ends = np.concatenate([gaps, [len(joined)]])[words - 1 :].tolist()
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), _BITS_AT_ONCE):
        parts = zip(starts[at : at + _BITS_AT_ONCE], ends[at : at + _BITS_AT_ONCE])
        hashes = np.frombuffer(b"".join([digest(joined[a:b], _SEED) for a, b in parts]), dtype=np.uint8)
        counts += np.add.reduce(np.unpackbits(hashes).reshape(-1, 64), axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """For each row (id, text) the id, ``body`` (the ``xxhash64`` of the text) and ``print``, the
    fingerprint as a signed long; a null text has no words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t for part in slices(batch.column(1)) for t in text_bytes(part))
            prints = np.fromiter((fingerprint(t, words) for t in texts), dtype=U64, count=batch.num_rows)
            yield pa.record_batch({"id": batch.column(0), "body": batch.column(2), "print": pa.array(prints.view(np.int64))})

    kind = dict(docs.dtypes)["id"]
    return docs.select("id", "text", F.xxhash64("text").alias("body")).mapInArrow(rows, f"id {kind}, body bigint, print bigint")


def _distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.bitwise_count(points ^ to)


@dataclass(frozen=True)
class _Split:
    """Fingerprints nearer than ``limit + 1`` to the vantage point lie inside."""

    vantage: np.uint64
    limit: int


def _split(points: np.ndarray) -> _Split | None:
    """The vantage point, out of a few, whose distances vary most, with their median."""
    seen = points[:: max(1, len(points) // 256)]
    tried = seen[:: max(1, len(seen) // 12)]
    distances = _distances(seen[None, :], tried[:, None]).astype(np.float32)
    vantage = tried[int(np.argmax(distances.var(axis=1)))]
    ordered = np.sort(_distances(seen, vantage))
    limit = int(ordered[(len(ordered) - 1) // 2])
    if limit == ordered[-1]:
        limit -= 1
    return _Split(vantage, limit) if limit >= 0 and ordered[0] <= limit else None


def _divided(split: _Split, members: np.ndarray, visitors: np.ndarray, reach: int, points: np.ndarray):
    """Members and visitors (indexes into ``points``) of both sides of a split.

    Of two members on either side, the one inside visits the outside. A visitor has to meet the
    members of every side within its reach.
    """
    near, far = split.limit - reach + 1, split.limit + reach
    d = _distances(points[members], split.vantage)
    v = _distances(points[visitors], split.vantage)
    inside = d <= split.limit
    across = members[inside & (d >= near)]
    return (
        (members[inside], visitors[v <= far]),
        (members[~inside], np.concatenate([across, visitors[v >= near]])),
    )


class _Groups:
    """Disjoint groups of 0 … n - 1, each named by its smallest member."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.parent[a], self.parent[b]
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
            while (again := self.parent[self.parent]) is not None and (again != self.parent).any():
                self.parent = again


def linked(points: np.ndarray, members: np.ndarray, visitors: np.ndarray, reach: int, leaf_pairs: int = 1 << 18) -> np.ndarray:
    """Groups of the points within ``reach`` bits, member to member and visitor to member: for each
    point the index of the smallest in its group. Visitors are not compared with one another."""
    groups = _Groups(len(points))
    todo = [(members, visitors)]
    while todo:
        members, visitors = todo.pop()
        n, m = len(members), len(members) + len(visitors)
        if m < 2 or not n:
            continue
        split = _split(points[members]) if n > 32 and n * m > leaf_pairs else None
        if split:
            todo += _divided(split, members, visitors, reach, points)
            continue
        every = np.concatenate([members, visitors])
        step = max(1, leaf_pairs // n)
        for at in range(0, m, step):
            some = every[at : at + step]
            if len(np.unique(groups.parent[np.concatenate([some, members])])) == 1:
                continue
            a, b = np.nonzero(_distances(points[some][:, None], points[members][None, :]) <= reach)
            groups.join(some[a], members[b])
    return groups.parent


def _top_tree(sample: np.ndarray, share: float, least: float) -> list:
    """Splits as nested (split, inside, outside); a leaf is the number of a shard."""
    count = 0

    def grown(points: np.ndarray, share: float):
        nonlocal count
        split = _split(points) if share > least and len(points) >= 8 else None
        if split is None:
            count += 1
            return count - 1
        inside = _distances(points, split.vantage) <= split.limit
        part = inside.mean() * share
        return split, grown(points[inside], part), grown(points[~inside], share - part)

    tree = grown(sample, share)
    return [tree, count]


def _routed(tree, points: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each shard that any of the points is sent to: members and visitors among them."""
    todo = [(tree, np.arange(len(points)), np.arange(0))]
    while todo:
        node, members, visitors = todo.pop()
        if not len(members) and not len(visitors):
            continue
        if isinstance(node, int):
            yield node, members, visitors
            continue
        split, inside, outside = node
        first, second = _divided(split, members, visitors, reach, points)
        todo += [(inside, *first), (outside, *second)]


def similar_edges(prints: DataFrame, reach: int, *, shard_size: int = 20_000, sample_size: int = 8_192) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints within ``reach`` bits of one another;
    ``prints`` has them in column ``print``, each once.

    The top tree is fitted to the ``sample_size`` fingerprints with the smallest hashes; every
    fingerprint is routed through it.
    """
    total = prints.count()
    sample = prints.orderBy(F.xxhash64("print"), "print").limit(sample_size).toArrow()["print"].to_numpy()
    if not len(sample):
        return prints.select(F.col("print").alias("a"), F.col("print").alias("b"))
    tree, shards = _top_tree(sample.view(U64), float(total), float(shard_size))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column(0).to_numpy()
            for shard, members, visitors in _routed(tree, signed.view(U64), reach):
                both = np.concatenate([members, visitors])
                yield pa.record_batch({
                    "shard": pa.array(np.full(len(both), shard, dtype=np.int32)),
                    "print": pa.array(signed[both]),
                    "member": pa.array(np.arange(len(both)) < len(members)),
                })

    def joined(key, rows):
        signed, member = rows["print"].to_numpy(), rows["member"].to_numpy()
        roots = linked(signed.view(U64), np.flatnonzero(member), np.flatnonzero(~member), reach)
        moved = roots != np.arange(len(roots))
        return pa.table({"a": pa.array(signed[moved]), "b": pa.array(signed[roots[moved]])})

    dealt = prints.select("print").mapInArrow(routed, "shard int, print bigint, member boolean")
    return dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(joined, "a bigint, b bigint")


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, max_bits: int, shard_size: int):
    """Rows (id, body, print), and (print, root) of every distinct fingerprint."""
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = checkpointed(fingerprints(named, words))
    distinct = checkpointed(prints.select("print").distinct())
    roots = components(checkpointed(similar_edges(distinct, max_bits, shard_size=shard_size)))
    return prints, distinct.join(roots, distinct["print"] == roots["node"], "left").select(
        "print", F.coalesce("root", "print").alias("root")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    words: int = 3,
    max_bits: int = 3,
    shard_size: int = 20_000,
) -> DataFrame:
    """SimHash fingerprints and their components: (id, ``fingerprint``, ``component_id``).

    Texts whose fingerprints differ in at most ``max_bits`` bits are linked; ``component_id`` is
    the smallest id that links reach, the own one included. One row per input row. A null, empty
    or blank text has fingerprint zero and is linked like any other. Null ids get the component of
    their text; it is null only if no id in it is known. Repeated rows give repeated results, an
    empty table an empty one. Other columns are not read.
    """
    prints, groups = _grouped(docs, id_col, text_col, words, max_bits, shard_size)
    least = prints.groupBy("print").agg(F.min("id").alias("id"))
    grouped = checkpointed(least.join(groups, "print"))
    first = grouped.groupBy("root").agg(F.min("id").alias("component_id"))
    named = checkpointed(grouped.select("print", "root").join(first, "root").select("print", "component_id"))
    return prints.join(named, "print").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    words: int = 3,
    max_bits: int = 3,
    shard_size: int = 20_000,
) -> DataFrame:
    """One row, whole, of each component of ``near_duplicates``: that with the smallest id; nulls
    come last, equal ids go by the ``xxhash64`` of the text, equal rows are one."""
    prints, groups = _grouped(docs, id_col, text_col, words, max_bits, shard_size)
    row = F.struct(F.col("id").isNull().alias("unnamed"), "id", "body").alias("row")
    least = checkpointed(prints.groupBy("print").agg(F.min(row).alias("row")).join(groups, "print"))
    first = least.groupBy("root").agg(F.min("row").alias("row"))

    def keyed(name, body) -> list:
        return [F.coalesce(name.cast("string"), F.lit("")).alias("_name"), name.isNull().alias("_unnamed"), body.alias("_body")]

    kept = first.select(*keyed(F.col("row.id"), F.col("row.body")))
    keys = ["_name", "_unnamed", "_body"]
    rows = docs.select("*", *keyed(F.col(id_col), F.xxhash64(text_col)))
    return rows.join(kept, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)
