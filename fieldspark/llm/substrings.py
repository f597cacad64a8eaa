"""Exact repeats of word windows across a corpus, found by fixed-block anchors.

A window of ``window`` words that occurs twice holds, wherever its first copy lies, a whole
aligned block of ``block = (window + 1) // 2`` words of its own document. So it is enough to
index the blocks that start at multiples of ``block`` and to probe that index with every rolling
window of ``block`` words: each repeat gives an anchor in both copies. Windows that hold an anchor
are then compared as a whole, which extends the anchors: adjoining repeated windows make up the
maximal exact repeats.

Documents are dealt into chunks by a hash. A chunk sends each different key once per bucket of
keys, however often it holds it, and hears back which of its keys are repeated; it then finds
their places by reading its own text again. No place, pair or group of copies is ever shipped, so
a passage shared by a third of all documents costs one key per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import U64, hashed_words, text_bytes, window_hashes

_ASKED = "bucket int, chunk int, n int, keys binary, blocks binary, repeats binary"
_HEARD = "chunk int, keys binary"
_FLAG_BLOCK, _FLAG_MANY = 1, 2


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane, which compresses well."""
    gaps = np.diff(keys, prepend=keys.dtype.type(0))
    return gaps.view(np.uint8).reshape(len(keys), -1).T.tobytes()


def _unpacked(data: bytes, n: int, kind: type) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(-1, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)


def _in_window(flags: np.ndarray, size: int) -> np.ndarray:
    """Whether any of flags[i:i + size] holds, for every i that leaves a whole window."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[size:] > sums[:-size]


def _is_in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


class _Chunk:
    """The words of a chunk, and which windows of a size lie inside one document."""

    def __init__(self, texts: list[bytes]):
        self.words, self.starts = hashed_words(texts)

    def inside(self, size: int) -> np.ndarray:
        """For each window of the chunk, whether it lies inside one document."""
        ok = np.ones(max(0, len(self.words) - size + 1), dtype=bool)
        for back in range(1, size):
            at = self.starts[1:-1] - back
            ok[at[(at >= 0) & (at < len(ok))]] = False
        return ok

    def names(self, block: int, buckets: int) -> np.ndarray:
        """Names of all rolling blocks: the bucket above, 32 bits within the bucket below."""
        hashes = window_hashes(self.words, block)
        return ((hashes >> U64(20)) * U64(buckets)) >> U64(12)

    def aligned(self, n: int, block: int) -> np.ndarray:
        at = np.arange(n)
        first = self.starts[np.searchsorted(self.starts, at, side="right") - 1]
        return (at - first) % block == 0


def _asked(chunk: int, buckets_of: np.ndarray, keys: np.ndarray, flags: np.ndarray) -> pa.Table:
    """Rows for sorted keys: one for each bucket that has any."""
    ids, first = np.unique(buckets_of, return_index=True)
    limits = [*first, len(keys)]
    parts = [slice(a, b) for a, b in zip(limits, limits[1:])]
    return pa.table({
        "bucket": pa.array(ids, pa.int32()),
        "chunk": pa.array(np.full(len(ids), chunk), pa.int32()),
        "n": pa.array([p.stop - p.start for p in parts], pa.int32()),
        "keys": pa.array([_packed(keys[p]) for p in parts], pa.binary()),
        "blocks": pa.array([np.packbits(flags[p] & _FLAG_BLOCK > 0).tobytes() for p in parts], pa.binary()),
        "repeats": pa.array([np.packbits(flags[p] & _FLAG_MANY > 0).tobytes() for p in parts], pa.binary()),
    })


def _combined(keys: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys with the union of their flags; a key that comes twice is repeated."""
    order = np.argsort(keys, kind="stable")
    keys, flags = keys[order], flags[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ U64(1)))
    counts = np.diff(np.append(first, len(keys)))
    joined = np.bitwise_or.reduceat(flags, first) if len(first) else flags[:0]
    return keys[first], joined | np.where(counts > 1, _FLAG_MANY, 0).astype(np.uint8)


def _ask_blocks(key, rows: pa.Table, window: int, block: int, buckets: int) -> pa.Table:
    chunk = _Chunk(text_bytes(rows["text"]))
    names = chunk.names(block, buckets)
    flags = chunk.aligned(len(names), block).astype(np.uint8) * np.uint8(_FLAG_BLOCK)
    ok = chunk.inside(block)
    names, flags = _combined(names[ok], flags[ok])
    return _asked(key[0].as_py(), names >> U64(32), names.astype(np.uint32), flags)


def _ask_windows(key, rows: pa.Table, heard: pa.Table, window: int, block: int, buckets: int) -> pa.Table:
    """Keys of the windows that hold an anchor."""
    if not rows.num_rows or not heard.num_rows:
        return _asked(0, np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.uint8))
    chunk = _Chunk(text_bytes(rows["text"]))
    known = np.sort(np.concatenate([np.frombuffer(b, dtype=U64) for b in heard["keys"].to_pylist()]))
    anchors = _is_in(chunk.names(block, buckets), known)
    held = _in_window(anchors, window - block + 1) & chunk.inside(window)
    keys = window_hashes(chunk.words, window)[held]
    keys, flags = _combined(keys, np.zeros(len(keys), dtype=np.uint8))
    return _asked(key[0].as_py(), ((keys >> U64(40)) * U64(buckets)) >> U64(24), keys, flags)


def _answer(key, rows: pa.Table, kind: type, need_block: bool) -> pa.Table:
    """For one bucket, the repeated keys of each chunk that sent them."""
    chunks, keys, flags = [], [], []
    for chunk, n, packed, blocks, repeats in zip(*(rows[c].to_pylist() for c in ("chunk", "n", "keys", "blocks", "repeats"))):
        chunks.append(np.full(n, chunk, dtype=np.int32))
        keys.append(_unpacked(packed, n, kind))
        flags.append(
            np.unpackbits(np.frombuffer(blocks, np.uint8), count=n) * np.uint8(_FLAG_BLOCK)
            | np.unpackbits(np.frombuffer(repeats, np.uint8), count=n) * np.uint8(_FLAG_MANY)
        )
    chunk, keys, flags = np.concatenate(chunks), np.concatenate(keys), np.concatenate(flags)
    names, joined = _combined(keys.astype(U64), flags)
    found = (joined & _FLAG_MANY) > 0
    if need_block:
        found &= (joined & _FLAG_BLOCK) > 0
    hit = _is_in(keys.astype(U64), names[found])
    chunk, keys = chunk[hit], keys[hit].astype(U64)
    if need_block:
        keys |= U64(key[0].as_py()) << U64(32)
    order = np.argsort(chunk, kind="stable")
    ids, first = np.unique(chunk[order], return_index=True)
    parts = np.split(keys[order], first[1:]) if len(ids) else []
    return pa.table({
        "chunk": pa.array(ids, pa.int32()),
        "keys": pa.array([p.tobytes() for p in parts], pa.binary()),
    })


def _kept(rows: pa.Table, heard: pa.Table, window: int) -> Iterator[tuple]:
    """For each row: words, words removed, spans of removed words, kept words."""
    texts = text_bytes(rows["text"])
    covered = starts = None
    if heard.num_rows:
        chunk = _Chunk(texts)
        known = np.sort(np.concatenate([np.frombuffer(b, dtype=U64) for b in heard["keys"].to_pylist()]))
        hits = np.flatnonzero(_is_in(window_hashes(chunk.words, window), known) & chunk.inside(window))
        change = np.zeros(len(chunk.words) + 1, dtype=np.int32)
        np.add.at(change, hits, 1)
        np.add.at(change, hits + window, -1)
        covered, starts = np.cumsum(change[:-1]) > 0, chunk.starts
    for i, text in enumerate(texts):
        words = text.split()
        gone = covered[starts[i] : starts[i + 1]] if covered is not None else None
        if gone is None or not gone.any():
            yield len(words), 0, [], b" ".join(words)
            continue
        edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
        left = b" ".join(words[j] for j in np.flatnonzero(~gone))
        yield len(words), int(gone.sum()), edges.tolist(), left


def _results(key, rows: pa.Table, heard: pa.Table, window: int) -> pa.Table:
    found = list(_kept(rows, heard, window))
    return pa.table({
        "id": rows["id"],
        "n_words": pa.array([f[0] for f in found], pa.int64()),
        "n_removed": pa.array([f[1] for f in found], pa.int64()),
        "repeats": pa.array([f[2] for f in found], pa.list_(pa.list_(pa.int32()))),
        "kept": pa.array([f[3].decode("utf-8") for f in found], pa.string()),
    })


def _digests(key, rows: pa.Table, heard: pa.Table, window: int) -> pa.Table:
    found = list(_kept(rows, heard, window))
    return pa.table({
        "id": rows["id"],
        "n_words": pa.array([f[0] for f in found], pa.int64()),
        "n_removed": pa.array([f[1] for f in found], pa.int64()),
        "kept_sha256": pa.array([hashlib.sha256(f[3]).hexdigest() for f in found], pa.string()),
    })


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    window: int = 35,
    digest: bool = False,
    chunk_bytes: int = 6 << 20,
    bucket_keys: int = 2_000_000,
) -> DataFrame:
    """Remove every word covered by a window of ``window`` words that also starts elsewhere.

    Words are ``[^\\x20\\x09-\\x0D]+``. Gives one row per input row: the id, ``n_words``,
    ``n_removed``, ``repeats`` (maximal spans [first, end) of removed words) and ``kept`` (the
    other words joined by one space); with ``digest`` the SHA-256 of ``kept`` instead of the last
    two. A null or empty text has no words. Texts shorter than a window keep all words. Repeated
    rows are copies of one another, whatever their ids, and so lose all words in windows; null ids
    are kept. An empty table gives an empty result. Other columns are not read.

    ``chunk_bytes`` and ``bucket_keys`` bound what one task holds; their numbers follow the input.
    """
    block = (window + 1) // 2
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_chunks = size // chunk_bytes + 1
    buckets = size // (6 * bucket_keys) + 1
    place: Column = F.pmod(F.xxhash64("id", "text"), F.lit(n_chunks)).cast("int")
    dealt = source.withColumn("chunk", place).repartition(n_chunks, "chunk")

    def answers(asked: DataFrame, kind: type, need_block: bool) -> DataFrame:
        return asked.groupBy("bucket").applyInArrow(
            lambda key, rows: _answer(key, rows, kind, need_block), _HEARD
        )

    def with_text(heard: DataFrame, function, schema: str) -> DataFrame:
        return dealt.groupBy("chunk").cogroup(heard.groupBy("chunk")).applyInArrow(function, schema)

    asked = dealt.groupBy("chunk").applyInArrow(
        lambda key, rows: _ask_blocks(key, rows, window, block, buckets), _ASKED
    )
    anchors = answers(asked, np.uint32, True)
    asked = with_text(anchors, lambda key, rows, heard: _ask_windows(key, rows, heard, window, block, buckets), _ASKED)
    repeated = answers(asked, np.uint64, False)
    kind = dict(docs.dtypes)[id_col]
    columns = "kept_sha256 string" if digest else "repeats array<array<int>>, kept string"
    function = _digests if digest else _results
    result = with_text(
        repeated, lambda key, rows, heard: function(key, rows, heard, window),
        f"id {kind}, n_words bigint, n_removed bigint, {columns}",
    )
    return result.withColumnRenamed("id", id_col)
