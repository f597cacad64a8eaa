"""Document fingerprints by content-defined chunking.

A gear hash over the last bytes decides where a text is cut, so the cuts move with the content and
an insertion changes only the chunks around it. Cutting is normalised: up to ``NORMAL`` bytes a
stricter mask must match, beyond it a looser one, which narrows the range of sizes. A fingerprint
is the set of the chunks' digests with their lengths; the share of that length that another
fingerprint also has measures how much of the text it contains.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import PASS_BYTES, mixed, range_hashes

LEAST, NORMAL, MOST = 16, 32, 256
_WINDOW = 16
#: The upper bits, which depend on the whole window: one byte in 64, and one in 16.
_STRICT, _LOOSE = np.uint16(0xFC00), np.uint16(0xF000)
_GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)
_CHUNK = np.dtype([("digest", "u8"), ("length", "u2")])
_WRITTEN = np.dtype([("digest", ">u8"), ("length", ">u2")])


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: the sum of the gears of the last 16 bytes, each shifted by its
    distance. Doubling the span gives it in four steps."""
    h = _GEAR[data]
    span = 1
    while span < _WINDOW:
        older = h[:-span] << np.uint16(span)
        h = h.copy()
        h[span:] += older
        span *= 2
    return h


def cut(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of all chunks of texts that end at ``limits``, in order of text and place.

    Every text takes its next cut in the same step, so steps are as many as the longest text has
    chunks. No chunk is shorter than the hash's window but for a text's last one, so no other text
    or chunk counts.
    """
    h = gear_hashes(data)
    strict, loose = np.flatnonzero((h & _STRICT) == 0) + 1, np.flatnonzero((h & _LOOSE) == 0) + 1
    strict, loose = np.append(strict, len(data) + MOST + 1), np.append(loose, len(data) + MOST + 1)
    at = np.concatenate([[0], limits[:-1]]).astype(np.int64)
    text = np.arange(len(limits))
    found = []
    while True:
        more = at < limits[text]
        text, at = text[more], at[more]
        if not len(text):
            break
        early = strict[np.searchsorted(strict, at + LEAST)]
        late = loose[np.searchsorted(loose, at + NORMAL)]
        end = np.minimum(np.where(early < at + NORMAL, early, np.minimum(late, at + MOST)), limits[text])
        found.append((text, at, end))
        at = end
    if not found:
        return (np.zeros(0, np.int64),) * 3
    text, start, end = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((start, text))
    return text[order], start[order], end[order]


def fingerprints(texts: list[bytes]) -> list[np.ndarray]:
    """For each text its different chunks (digest, length), by digest."""
    if not texts:
        return []
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    limits = np.cumsum([len(t) for t in texts])
    text, start, end = cut(data, limits)
    chunks = np.zeros(len(text), dtype=_CHUNK)
    if len(text):
        chunks["digest"], chunks["length"] = range_hashes(data, start, end), end - start
    at = np.searchsorted(text, np.arange(1, len(texts)))
    return [part[np.unique(part["digest"], return_index=True)[1]] for part in np.split(chunks, at)]


def containment(of: np.ndarray, within: np.ndarray) -> float:
    """The share of the chunk length of one fingerprint that the other one also has. An empty one
    is wholly contained in an empty one and not at all in others."""
    if not len(of):
        return float(not len(within))
    if not len(within):
        return 0.0
    at = np.minimum(np.searchsorted(within["digest"], of["digest"]), len(within) - 1)
    lengths = of["length"].astype(np.int64)
    return float(lengths[within["digest"][at] == of["digest"]].sum() / lengths.sum())


def edited(text: str, other: str) -> str:
    """The text with its last half replaced by as many code points of the other one's start."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def with_next(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """Rows (block, tail, id, text) such that, in order of block, tail, descending id (nulls last) and text, each
    row but the tails is followed by its successor in the whole table; and the number of blocks.

    Blocks are ranges of ids with about equal numbers of rows. Each also gets the first row of the
    next block, and the last one that of the first, marked as tails. Only the blocks' bounds and
    largest ids reach the driver.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, size // block_bytes)
    bounds = sorted({*named.select(F.col("id").cast("double").alias("x")).approxQuantile("x", [i / n for i in range(1, n)], 0.25 / n)}) if n > 1 else []
    # Blocks count up as ids go down; nulls come last.
    place = F.when(F.col("id").isNull(), F.lit(len(bounds) + 1)).otherwise(
        F.lit(len(bounds)) - _position(bounds)(F.col("id").cast("double"))
    )
    placed = named.withColumn("block", place.cast("int"))
    heads = placed.groupBy("block").agg(F.max("id").alias("head")).orderBy("block").collect()
    before = [(heads[i - 1]["block"], h["block"], h["head"]) for i, h in enumerate(heads)]
    kind = dict(named.dtypes)["id"]
    links = docs.sparkSession.createDataFrame(before, f"to_block int, of_block int, head {kind}")
    tails = placed.join(F.broadcast(links), (F.col("block") == F.col("of_block")) & F.col("id").eqNullSafe(F.col("head")))
    rows = placed.select("block", F.lit(False).alias("tail"), "id", "text")
    return rows.union(tails.select(F.col("to_block"), F.lit(True), "id", "text")), len(heads)


def _position(bounds: list[float]):
    """A column function: how many of the sorted bounds a value reaches."""

    def reached(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(bounds), values.to_numpy(dtype=float), side="right"))

    return F.pandas_udf(reached, "long")


def neighbour_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, block_bytes: int = 8 << 20) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how like they are.

    The next document is the one with the next smaller id, after the last the first; the edited text
    has its last half replaced by the start of the next one. Gives the id, ``n_chars``,
    ``edited_sha256``, ``fingerprint`` and ``edited_fingerprint`` (20 hexadecimal digits a chunk: digest
    and length), ``near_edited`` and ``near_next`` (the share of the text that the edited text, and the
    next document, contain). One row per input row. A null text counts as empty; a lone row is its
    own neighbour. Equal ids go in order of their texts; null ids come last. An empty table gives
    an empty result. Other columns are not read.
    """
    rows, blocks = with_next(docs, id_col, text_col, block_bytes)
    dealt = rows.repartition(max(1, blocks), "block").sortWithinPartitions("block", "tail", F.col("id").desc_nulls_last(), "text")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, held, size = None, [], 0
        for batch in batches:
            kind = batch.schema.field("id").type
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                size += len(row[3] or "")
                if size >= PASS_BYTES // 2 and len(held) > 1:
                    yield _judged(held, kind)
                    held, size = held[-1:], len(held[-1][3] or "")
        if len(held) > 1:
            yield _judged(held, kind)

    kind = dict(docs.dtypes)[id_col]
    schema = (
        f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return dealt.mapInArrow(judged, schema).withColumnRenamed("id", id_col)


def _judged(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    """Results for all rows but the last and the tails; each row's successor follows it."""
    texts = [r[3] or "" for r in rows]
    own = fingerprints([t.encode() for t in texts])
    at = [i for i, row in enumerate(rows[:-1]) if not row[1]]
    changed = [edited(texts[i], texts[i + 1]).encode() for i in at]
    theirs = fingerprints(changed)
    return pa.record_batch({
        "id": pa.array([rows[i][2] for i in at], kind),
        "n_chars": pa.array([len(texts[i]) for i in at], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
        "fingerprint": pa.array([own[i].astype(_WRITTEN).tobytes().hex() for i in at], pa.string()),
        "edited_fingerprint": pa.array([t.astype(_WRITTEN).tobytes().hex() for t in theirs], pa.string()),
        "near_edited": pa.array([containment(own[i], t) for i, t in zip(at, theirs)], pa.float64()),
        "near_next": pa.array([containment(own[i], own[i + 1]) for i in at], pa.float64()),
    })
