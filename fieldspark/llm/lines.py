"""Repeated line runs, found on a suffix array over line ids that prefix doubling refines.

All documents, in order of id, make one sequence of line ids with a gap after each document.
``doubled`` ranks its suffixes by their first 1, 2, 4, … lines: a rank at the next level orders the
pair (rank here, rank half a block on). Suffixes that are already alone are dropped at once, as
they share no further line with any other. Suffixes that agree on their first d lines are one
interval of the suffix array whose longest common prefix is d or more; two overlapping ranks name
it exactly. The first place of an interval stays, the later ones are copies; the lines of adjoining
copies make up the maximal repeated runs.

A run counts however short it is, if it holds a line with more than white space: blank lines alone
are no text. A caller may ask for runs of ``min_chars`` characters or more instead. A line belongs to
a run that counts if and only if the shortest block that counts from some line on, or up to some
line, covers it and is a copy: any longer run is made of such blocks. So two blocks a line decide,
and the doubling goes on up to the longest of them that the documents have; more lines cannot change
what is deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import checkpointed

_LINES = "array<struct<k:bigint,c:int,n:int>>"
_REMOVED = "_removed_lines"


def _numbered(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """Different (id, text) with hashes and weights of their lines and ``start``, the place of the
    first line in the sequence of all documents. A line weighs its characters and its line end; without
    ``min_chars``, 1 if it is not blank."""
    kind = dict(docs.dtypes)[id_col]
    lines = F.transform(
        F.split(F.col(text_col), "\n"),
        lambda x: F.struct(F.xxhash64(x).alias("k"), F.hash(x).alias("c"), (F.char_length(x) + 1 if min_chars else x.rlike(r"\S").cast("int")).alias("n")),
    )
    base = (
        docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("body"), F.coalesce(lines, F.array().cast(_LINES)).alias("lines"))
        .dropDuplicates(["id", "body"])
        .repartitionByRange("id", "body")
        .sortWithinPartitions("id", "body")
        .withColumn("part", F.spark_partition_id())
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            sizes = batch.column("lines").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) + 1
            starts = total + np.cumsum(sizes) - sizes
            total += int(sizes.sum())
            yield batch.append_column("start", pa.array(starts))

    schema = f"id {kind}, body bigint, lines {_LINES}, part int, start bigint"
    local = checkpointed(base.mapInArrow(placed, schema))
    sizes = local.groupBy("part").agg(F.max(F.col("start") + F.size("lines") + 1).alias("n")).orderBy("part").collect()
    offsets, total = [], 0  # one number for each partition
    for row in sizes:
        offsets.append((row["part"], total))
        total += row["n"]
    if not offsets:
        return local.drop("part")
    before = local.sparkSession.createDataFrame(offsets, "part int, before bigint")
    return local.join(F.broadcast(before), "part").select("id", "body", "lines", (F.col("start") + F.col("before")).alias("start"))


def _blocks_of(weights: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(first line, lines) of the shortest blocks that weigh ``least`` from each line on and up to
    each line."""
    sums = np.concatenate([[0], np.cumsum(weights)])
    n = len(weights)
    ends = np.searchsorted(sums, sums[:-1] + least)
    firsts = np.searchsorted(sums, sums[1:] - least, side="right") - 1
    forward = [(i, int(e) - i) for i, e in enumerate(ends) if e <= n]
    backward = [(int(f), i + 1 - int(f)) for i, f in enumerate(firsts) if f >= 0]
    return sorted({*forward, *backward})


def _blocks(base: DataFrame, least: int) -> DataFrame:
    """(place, start, size) of every block that can decide on a line."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, weights = batch.column(0).to_pylist(), batch.column(1)
            limits, values = weights.offsets.to_numpy(), weights.values.to_numpy()
            for i, start in enumerate(starts):
                blocks = _blocks_of(values[limits[i] : limits[i + 1]].astype(np.int64), least)
                if blocks:
                    first, size = np.array(blocks, dtype=np.int64).T
                    yield pa.record_batch({
                        "place": pa.array(first + start), "start": pa.array(np.full(len(first), start)), "size": pa.array(size.astype(np.int32)),
                    })

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in found(batches):
            held.append(batch)
            rows += batch.num_rows
            if rows >= 50_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return base.select("start", F.transform("lines", lambda x: x["n"]).alias("n")).mapInArrow(
        packed, "place bigint, start bigint, size int"
    )


def _ranked(keyed: DataFrame) -> DataFrame:
    """(place, rank) for the places whose pair (a, b) occurs more than once; ranks order the pairs.

    Equal pairs are counted before they are sorted, so the range partitions are even however
    frequent a pair is. An id that rises within and across range partitions is the rank.
    """
    pairs = keyed.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b")
    ordered = pairs.repartitionByRange("a", "b").sortWithinPartitions("a", "b")
    ranks = checkpointed(ordered.withColumn("rank", F.monotonically_increasing_id()))
    return checkpointed(keyed.join(ranks, ["a", "b"]).select("place", "rank"))


def doubled(lines: DataFrame, depth: int) -> Iterator[tuple[int, DataFrame]]:
    """Prefix doubling over ``lines`` (place, a, b), where (a, b) identifies a line: yields d and
    (place, rank) of the suffixes that share their first d lines with another, for d = 1, 2, 4, …
    up to ``depth`` or until all suffixes are told apart."""
    d, ranks = 1, _ranked(lines)
    while not ranks.isEmpty():
        yield d, ranks
        d *= 2
        if d > depth:
            return
        later = ranks.select((F.col("place") - d // 2).alias("place"), F.col("rank").alias("b"))
        ranks = _ranked(ranks.withColumnRenamed("rank", "a").join(later, "place"))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = 0) -> DataFrame:
    """(id, body, ``removed``) of each document that loses lines: their sorted indexes.

    ``body`` is the ``xxhash64`` of the text, as ids may repeat.
    """
    base = checkpointed(_numbered(docs, id_col, text_col, min_chars))
    lines = base.select("start", F.posexplode("lines").alias("i", "line")).select(
        (F.col("start") + F.col("i")).alias("place"), F.col("line.k").alias("a"), F.col("line.c").cast("bigint").alias("b")
    )
    blocks = checkpointed(_blocks(base, max(1, min_chars)))
    longest = blocks.agg(F.max("size")).first()[0] or 0
    named = None
    for d, ranks in doubled(lines, longest):
        of_size = blocks.where(F.col("size").between(d, 2 * d - 1)).withColumn("last", F.col("place") + F.col("size") - d)
        heads = of_size.join(ranks.withColumnRenamed("rank", "a"), "place")
        if d == 1:
            level = heads.withColumn("b", F.col("a"))
        else:
            level = heads.join(ranks.select(F.col("place").alias("last"), F.col("rank").alias("b")), "last")
        level = level.select("place", "start", "size", "a", "b")
        named = level if named is None else named.union(level)
    if named is None:
        return base.select("id", "body", F.array().cast("array<int>").alias("removed")).limit(0)
    named = checkpointed(named)
    firsts = checkpointed(  # so that both sides of the join are plain, and Spark can split a hot block
        named.groupBy("size", "a", "b").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    copies = checkpointed(named.join(firsts, ["size", "a", "b"]).where("place > first").select("place", "start", "size"))
    # Blocks over a gap of blank lines are nested: one from each first line and one up to each last are enough.
    spans = copies.select("start", (F.col("place") - F.col("start")).alias("i"), (F.col("place") - F.col("start") + F.col("size") - 1).alias("j"))
    spans = spans.groupBy("start", "i").agg(F.max("j").alias("j")).groupBy("start", "j").agg(F.min("i").alias("i"))
    gone = spans.select("start", F.explode(F.sequence("i", "j")).alias("i"))
    per_doc = gone.groupBy("start").agg(F.array_sort(F.collect_set(F.col("i").cast("int"))).alias("removed"))
    return base.select("id", "body", "start").join(per_doc, "start").select("id", "body", "removed")


def _without(text: pd.Series, removed: pd.Series) -> pd.Series:
    def one(value, gone):
        if value is None or gone is None:
            return value
        lines, gone = value.split("\n"), set(gone)
        return "\n".join(line for i, line in enumerate(lines) if i not in gone)

    return pd.Series([one(*pair) for pair in zip(text, removed)], dtype=object)


def remove_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = 0
) -> DataFrame:
    """Delete later copies of repeated line runs, of any length: a single short line is one.

    Lines are the parts between line feeds. Runs of blank lines alone stay; within a longer run blank
    lines go with it. With ``min_chars``, only runs of that many characters go, where each line counts
    its line feed as a character, and blank lines are as any other. Of equal
    runs the first stays, in order of id (nulls first), ``xxhash64`` of the text, and line; a run
    may overlap its own copy. Gives all columns with the text without the deleted lines, and two
    more: ``n_lines`` and ``n_removed``. A null text has no lines and stays null, an empty one has one
    empty line. Rows equal in id and text are one document: they share its result. Ties need no
    rule beyond the order. An empty table gives an empty result. Other columns pass through.
    """
    gone = repeated_lines(docs, id_col, text_col, min_chars=min_chars).select(
        F.col("id").alias("_id"), F.col("body").alias("_body"), F.col("removed").alias(_REMOVED)
    )
    text, removed = F.col(text_col), F.col(_REMOVED)
    joined = docs.join(gone, docs[id_col].eqNullSafe(gone["_id"]) & (F.xxhash64(docs[text_col]) == gone["_body"]), "left")
    cut = F.pandas_udf(_without, "string")(F.when(removed.isNotNull(), text), removed)
    counted = joined.withColumns({
        "n_lines": F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("bigint"),
        "n_removed": F.coalesce(F.size(removed), F.lit(0)).cast("bigint"),
    })
    whole = counted.withColumn(text_col, F.when(removed.isNull(), text).otherwise(cut))
    return whole.select(*docs.columns, "n_lines", "n_removed")
