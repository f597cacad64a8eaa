"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are token sequences. An index of the items' seeds, runs of
``min_match`` tokens, is probed with every run of a document. Where they share seeds, the longest
common run of unmarked tokens is marked again and again until none of ``min_match`` tokens is left;
the marked share of the item is its coverage. The tiles may lie in any order, so a passage whose
sentences were moved is still covered.

An item of fewer tokens is one seed: it is found whole or not at all. In scripts without spaces every
character is a token.

Seeds are compared by Karp-Rabin hashes of token hashes, and every seed that agrees token by token.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import U64, passes, range_hashes, slices, text_bytes, window_hashes

_ASCII_TOKEN = np.zeros(256, dtype=bool)
_ASCII_TOKEN[[*b"0123456789abcdefghijklmnopqrstuvwxyz_", *range(0x80, 0x100)]] = True
_FILTER_BITS = 20
# Code points of scripts written without spaces between words, from and up to (Thai, Lao, Tibetan, Myanmar, Khmer,
# Tai and Javanese scripts, kana, Han and its extensions).
_UNSPACED = (
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x19E0, 0x1AAF), (0x2E80, 0x2FDF), (0x3040, 0x312F), (0x31A0, 0x31FF),
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA980, 0xA9DF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF),
)


def token_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to tokens: ASCII letters, digits, the underscore, and code
    points from U+00C0 on, but for General Punctuation (U+2000-206F) and U+3000-303F."""
    token = _ASCII_TOKEN[data]
    for lead, seconds, length in ((0xC2, range(0x80, 0xC0), 2), (0xE2, (0x80, 0x81), 3), (0xE3, (0x80,), 3)):
        at = np.flatnonzero(data[:-1] == lead)
        at = at[np.isin(data[at + 1], list(seconds))]
        for i in range(length):
            token[at[at + i < len(data)] + i] = False
    return token


def single_characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the characters of UTF-8 text that are tokens by themselves."""
    starts, ends = [], []
    for low, high, length, kept in ((0xE0, 0xEF, 3, 0x0F), (0xF0, 0xF4, 4, 0x07)):
        at = np.flatnonzero((data >= low) & (data <= high))
        at = at[at + length <= len(data)]
        code = (data[at] & kept).astype(np.uint32)
        for i in range(1, length):
            code = code << 6 | data[at + i] & 0x3F
        single = np.zeros(len(at), dtype=bool)
        for first, last in _UNSPACED:
            single |= (code >= first) & (code <= last)
        starts.append(at[single])
        ends.append(at[single] + length)
    return np.concatenate(starts), np.concatenate(ends)


def token_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the tokens of lower-case UTF-8 text, in order."""
    token = np.concatenate([[False], token_bytes(data), [False]])
    cut = np.zeros(len(token) - 1, dtype=bool)  # before which bytes one token ends and another may start
    for edges in single_characters(data):
        cut[edges] = True
    before, after = token[:-1], token[1:]
    return np.flatnonzero(after & (cut | ~before)), np.flatnonzero(before & (cut | ~after))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of lower-case texts, and the index of each text's first token, with the
    number of tokens at the end."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    starts, ends = token_spans(data)
    limits = np.cumsum([len(t) + 1 for t in texts])
    return range_hashes(data, starts, ends), np.concatenate([[0], np.searchsorted(starts, limits)])


def tiles(item: np.ndarray, doc: np.ndarray, seeds: list[tuple[int, int]], min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: (place in item, place in doc, tokens) of the tiles, longest first.

    ``seeds`` has all places where a run of ``min_match`` tokens is the same in both. Ties go to the
    first place in the item, then in the document.
    """
    diagonals: dict[int, list[int]] = defaultdict(list)
    for i, j in seeds:
        diagonals[j - i].append(i)
    heap: list[tuple[int, int, int]] = []

    def offer(i: int, j: int, size: int) -> None:
        if size >= min_match:
            heapq.heappush(heap, (-size, i, j))

    for shift, places in diagonals.items():
        at = np.unique(places)
        for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
            offer(int(run[0]), int(run[0]) + shift, int(run[-1] - run[0]) + min_match)
    in_item, in_doc = np.zeros(len(item), dtype=bool), set()
    found = []
    while heap:
        size, i, j = heapq.heappop(heap)
        free = [not in_item[i + t] and j + t not in in_doc for t in range(-size)]
        if all(free):
            found.append((i, j, -size))
            in_item[i : i - size] = True
            in_doc.update(range(j, j - size))
            continue
        start = None
        for t, ok in enumerate([*free, False]):  # offer what is left between marked tokens
            if ok and start is None:
                start = t
            elif not ok and start is not None:
                offer(i + start, j + start, t - start)
                start = None
    return found


class _Seeds:
    """Places of the seeds of one size, with a bit table that rules most runs of a text out."""

    def __init__(self, size: int, places: list[tuple[int, int, int]]):
        self.size = size
        places.sort()
        self.hashes = np.array([p[0] for p in places], dtype=U64)
        self.places = [p[1:] for p in places]
        self.table = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.table[self.hashes >> U64(64 - _FILTER_BITS)] = True

    def met(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where runs of the tokens have a seed's hash, and which seeds: the first and the one past the last."""
        windows = window_hashes(hashes, self.size)
        maybe = np.flatnonzero(self.table[windows >> U64(64 - _FILTER_BITS)])
        first = np.searchsorted(self.hashes, windows[maybe], side="left")
        last = np.searchsorted(self.hashes, windows[maybe], side="right")
        real = last > first
        return maybe[real], first[real], last[real]


class Index:
    """Seeds of benchmark items: runs of ``min_match`` tokens, and whole items that are shorter."""

    def __init__(self, ids: list, texts: list[bytes], min_match: int):
        self.ids, self.min_match = ids, min_match
        hashes, starts = tokens(texts)
        self.items = [hashes[a:b] for a, b in zip(starts, starts[1:])]
        places: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for item, words in enumerate(self.items):
            if size := min(min_match, len(words)):
                places[size] += [(h, item, at) for at, h in enumerate(window_hashes(words, size).tolist())]
        self.seeds = [_Seeds(size, places[size]) for size in sorted(places)]

    def coverage(self, texts: list[bytes]) -> Iterator[dict[int, float]]:
        """For each text, the marked share of every item that shares a seed with it."""
        hashes, starts = tokens(texts)
        met = []
        for of_size in self.seeds:
            at, first, last = of_size.met(hashes)
            met.append((of_size, at, first, last, np.searchsorted(at, starts)))
        for text, (start, stop) in enumerate(zip(starts, starts[1:])):
            seeds: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for of_size, places, first, last, limits in met:
                size, (lo, hi) = of_size.size, limits[text : text + 2]
                for at, a, b in zip(places[lo:hi].tolist(), first[lo:hi].tolist(), last[lo:hi].tolist()):
                    if at + size <= stop:
                        for item, place in of_size.places[a:b]:
                            if (self.items[item][place : place + size] == hashes[at : at + size]).all():
                                seeds[item].append((place, at - int(start)))
            yield {
                item: sum(t[2] for t in tiles(self.items[item], hashes[start:stop], found, min(self.min_match, len(self.items[item])))) / len(self.items[item])
                for item, found in seeds.items()
            }


def _lower(column: pa.Array) -> list[bytes]:
    return text_bytes(pc.utf8_lower(column))


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[pa.Table]:
    """The benchmark (id, text) in blocks of about ``block_bytes`` of text, by id and text. Null texts and repeated
    texts of an id are left out. Only one block at a time is on the driver."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // block_bytes + 1
    for block in range(n):
        of_block = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block) if n > 1 else items
        found = of_block.orderBy("id", "text").toArrow()
        if found.num_rows:
            yield found


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "item_id",
    text_col: str = "text",
    *,
    doc_text: str = "text",
    min_match: int = 5,
    threshold: float = 0.5,
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """All columns of ``docs`` with ``max_coverage`` (the largest share of an item that tiles of
    ``min_match`` tokens or more cover), ``item_ids`` (the sorted ids of the items covered to
    ``threshold`` or more) and ``contaminated`` (whether there is one).

    Tokens are lower-case runs as in ``token_bytes``, or single characters of scripts without spaces. A
    null, empty or token-less text shares nothing. An item shorter than ``min_match`` tokens is covered
    by its whole token sequence; null items and ids are passed over.
    Ties between tiles go to the first place. Repeated rows get equal results. An empty benchmark
    contaminates nothing. Every block of ``block_bytes`` of the benchmark is sent to all tasks and
    meets all documents, so a benchmark of any size is held against them whole.
    """
    names = [c for c in docs.columns if c not in ("max_coverage", "item_ids", "contaminated")]
    blocks = [F.struct(F.lit(0.0).alias("most"), F.array().cast("array<bigint>").alias("items"))]
    for block in item_blocks(benchmark.where(F.col(id_col).isNotNull()), id_col, text_col, block_bytes):
        index = Index(block["id"].to_pylist(), _lower(block["text"]), min_match)
        blocks.append(_cover(docs.sparkSession.sparkContext.broadcast(index), threshold)(F.col(doc_text)))
    found = docs.select(*names, F.array(*blocks).alias("_found"))
    return found.select(
        *names,
        F.array_max(F.transform("_found", lambda b: b["most"])).alias("max_coverage"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("_found", lambda b: b["items"])))).alias("item_ids"),
    ).withColumn("contaminated", F.size("item_ids") > 0)


def _cover(shared, threshold: float):
    """A column function from a text to the largest coverage of an item and the items covered."""

    def covered(column: pa.Array) -> pa.Array:
        index, most, items = shared.value, [], []
        for texts in map(_lower, slices(column)):
            for a, b in passes([len(t) + 1 for t in texts]):
                for shares in index.coverage(texts[a:b]):
                    most.append(max(shares.values(), default=0.0))
                    items.append(sorted({index.ids[k] for k, s in shares.items() if s >= threshold}))
        return pa.StructArray.from_arrays([pa.array(most, pa.float64()), pa.array(items, pa.list_(pa.int64()))], names=["most", "items"])

    return F.arrow_udf(covered, "most double, items array<bigint>")
