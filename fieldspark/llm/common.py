"""What the corpus operators share: cut lineage, word positions and hashes, components of a graph.

Positions and hashes are found on whole byte buffers with numpy. Hashes are 64 bits wide and
the same in every process, so a task that runs again gives the same values.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Text that one numpy pass looks at; bounds the memory of a task whatever its batch holds.
PASS_BYTES = 1 << 18
#: Rows of a batch whose texts are Python values at a time.
SLICE_ROWS = 512
#: Rows that Spark sends to a Python worker at a time, where texts are sent whole.
BATCH_ROWS = 2_000

_BYTE_FACTOR, _WORD_FACTOR = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows, written under ``spark.checkpoint.dir``, so that a lost executor repeats
    no earlier stage. A local session without that setting gets a folder of its own."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(shared)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of its own for a local session without it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="shared-")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lower the rows of an Arrow batch to ``BATCH_ROWS`` for this session, as both the JVM and the
    Python worker of a task hold whole batches; a lower setting stays. Results don't depend on it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each value; null gives an empty value."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [v or b"" for v in column.cast(kind).to_pylist()]


def slices(column: pa.Array) -> Iterator[pa.Array]:
    """A column in parts of ``SLICE_ROWS`` rows, so that few texts are Python values at a time."""
    for at in range(0, len(column), SLICE_ROWS):
        yield column.slice(at, SLICE_ROWS)


def passes(sizes: list[int], limit: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive values of about ``limit`` bytes together, one value at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_POWERS: dict[int, np.ndarray] = {}


def _powers(factor: int, n: int) -> np.ndarray:
    """factor ** 0 … factor ** n, modulo 2 ** 64."""
    have = _POWERS.get(factor)
    if have is None or len(have) <= n:
        size = max(n + 1, 1 << 16)
        have = np.full(size, factor, dtype=U64)
        have[0] = 1
        np.cumprod(have, out=have)
        if size <= 4 * PASS_BYTES:  # longer ones, for a very long text, are not kept
            _POWERS[factor] = have
    return have[: n + 1]


def _range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, factor: int) -> np.ndarray:
    """A polynomial hash of values[start:end] for each range, from prefix sums."""
    n = len(values)
    powers = _powers(factor, n)
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(values * powers[:n], out=sums[1:])
    undone = _powers(pow(factor, -1, 1 << 64), n)  # so that the place of a range doesn't count
    return mixed((sums[ends] - sums[starts]) * undone[starts])


def word_spans(data: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs where ``in_word`` holds."""
    edges = np.flatnonzero(np.diff(in_word.view(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; equal bytes give equal hashes."""
    return _range_hashes(data.astype(U64) + U64(1), starts, ends, _BYTE_FACTOR)


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts, and the index of each text's
    first word, with the number of words at the end."""
    hashes, counts = [], []
    for a, b in passes([len(t) + 1 for t in texts]):
        part = texts[a:b]
        data = np.frombuffer(b" ".join(part) + b" ", dtype=np.uint8)
        starts, ends = word_spans(data, ~_SPACES[data])
        hashes.append(range_hashes(data, starts, ends))
        limits = np.cumsum([len(t) + 1 for t in part])
        counts.append(np.diff(np.searchsorted(starts, limits), prepend=0))
    if not hashes:
        return np.zeros(0, dtype=U64), np.zeros(1, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of words[i:i + size] for every i that leaves a whole window."""
    if len(words) < size:
        return np.zeros(0, dtype=U64)
    starts = np.arange(len(words) - size + 1)
    return _range_hashes(words, starts, starts + size, _WORD_FACTOR)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of a graph: edges (a, b) in, (node, root) out, where root is the
    smallest node reachable; nodes without an edge are absent.

    Alternates two rounds until nothing changes: every node links its larger neighbours to its
    smallest one, then its smaller neighbours to its smallest one. Both replace an edge by one
    edge, so a hub adds no rows, and the number of rounds grows as a logarithm. Sides of a join
    are written first, so that Spark can split a hub's partition. Only the number of edges and a
    checksum reach the driver.
    """
    edges = edges.where(F.col("a") != F.col("b")).select("a", "b")
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = checkpointed(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least")))
        larger = both.where(F.col("b") > F.col("a")).join(least, "a")
        linked = checkpointed(larger.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())
        # Here a > b in every row; a node and its smaller neighbours go to the smallest of them.
        least = checkpointed(linked.groupBy("a").agg(F.min("b").alias("least")))
        smaller = linked.join(least, "a").where(F.col("b") != F.col("least"))
        edges = (
            least.select("a", F.col("least").alias("b"))
            .union(smaller.select(F.col("b").alias("a"), F.col("least").alias("b")))
            .distinct()
        )
        edges = checkpointed(edges)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(now)
