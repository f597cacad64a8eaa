"""Collocations from exact phrase counts, kept in counting quotient filters.

A word id is a hash of language and word, 64 bits wide; that no two words of the corpus share one is
checked on the word counts, and another hash is taken if they do, so ids are as good as the words.
(Within the pass of a task, a second hash of 64 bits tells words of one id apart.)
A phrase is the ids of its words side by side. An invertible permutation of these bits makes phrases
even in number over any range of their first 64 bits, whatever words are common. A filter keeps
phrases in that order: the high bits (the quotient) are not stored but follow from a bit vector of
the slots' runs, the remaining bits (the remainder) are stored whole, beside a counter of variable
width. So nothing is lost, phrases are read back by undoing the permutation, and two filters merge by
merging their sorted entries. Tasks fill filters with what they read, cut them at the borders of
shards, and one filter of each shard comes out of the merge. The number of shards follows the words
counted, so that a shard stays small however many there are.

A phrase that occurs ``least`` times is made of words that do. A Bloom filter of these words, of 32 MB
at most, goes to the tasks; a phrase with a word outside of it can't be a candidate and isn't counted.
Words the filter wrongly lets through cost room, no result. As few bytes of a word id are packed
as tell the words it lets through apart, which is checked on these words.

Null and empty texts have no words; a null language is ``und``; repeated rows count as often as they
come. Texts are read whole, a pass at a time, so a very long text needs memory for its word ids only.
Other columns aren't read. No rows, or no candidates, give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.llm.common import PASS_BYTES, U64, _range_hashes, checkpointed, mixed, slices, text_bytes, word_spans
from fieldspark.operators.lookup import lookup

UNKNOWN = "und"
#: Phrases that a task counts at a time.
BUFFER = 1 << 20
#: Words counted for each shard; a shard holds at most twice as many phrases.
SHARD_WORDS = 1 << 20
#: Parts of a language's phrases that are ranked apart before the best of each meet.
HANDS = 32
#: Slices of the Bloom filter, and the most bits of one.
_SLICES, _SLICE_BITS = 256, 1 << 20
_PROBES = 4

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN = _BREAKS.copy()
_BETWEEN[[0x20, 0x09]] = True


def _parts(data: bytes) -> Iterator[tuple[int, int]]:
    """Ranges of about a pass that end between words."""
    at = 0
    while at < len(data):
        end = at + PASS_BYTES
        if end >= len(data):
            end = len(data)
        else:
            space, line = data.find(b" ", end), data.find(b"\n", end)
            end = min(p for p in (space, line, len(data)) if p >= 0)
            end += end < len(data)
        yield at, end
        at = end


def _word_ids(texts: list[bytes], langs: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the words of all texts, whether each goes on in the piece of the one before it, the text
    of each, and where each starts and ends in the texts, joined by line ends."""
    joined = b"\n".join(texts) + b"\n"
    limits = np.cumsum([len(t) + 1 for t in texts])
    factor = 0x9E3779B97F4A7C15 + 2 * seed
    ids, goes_on, rows, starts, ends, breaks = [], [], [], [], [], 0
    last = -1
    for a, b in _parts(joined):
        data = _LOWER[np.frombuffer(joined, dtype=np.uint8, count=b - a, offset=a)]
        first, end = word_spans(data, ~_BETWEEN[data])
        row = np.searchsorted(limits, first + a, side="right")
        hashes = _range_hashes(data.astype(U64) + U64(1), first, end, factor)
        ids.append(mixed(hashes ^ langs[row]))
        pieces = breaks + np.cumsum(_BREAKS[data])
        of_word = pieces[first]
        goes_on.append(np.diff(of_word, prepend=last) == 0)
        breaks, last = int(pieces[-1]), int(of_word[-1]) if len(of_word) else last
        rows.append(row)
        starts.append(first + a)
        ends.append(end + a)
    return tuple(np.concatenate(x) for x in (ids, goes_on, rows, starts, ends))


def _language_keys(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    """A number for the language of each row, and the languages."""
    names = column.to_pylist()
    keys = {n: xxhash.xxh64_intdigest(n.encode(), seed=1) for n in set(names)}
    return np.array([keys[n] for n in names], dtype=U64), names


def _different(ids: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs of two hashes: the first hash, a place of the pair, and how often it comes."""
    order = np.argsort(ids, kind="stable")
    if np.any((np.diff(ids[order]) == 0) & (np.diff(others[order]) != 0)):
        order = np.lexsort([others, ids])
    new = np.flatnonzero(np.concatenate([[True], (np.diff(ids[order]) != 0) | (np.diff(others[order]) != 0)]))
    return ids[order][new], order[new], np.diff(np.append(new, len(ids)))


def _count_words(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for column in slices(batch.column("text")):
            part, at = batch.slice(at, len(column)), at + len(column)
            texts = text_bytes(column)
            keys, names = _language_keys(part.column("lang"))
            ids, _, rows, starts, ends = _word_ids(texts, keys, seed)
            if not len(ids):
                continue
            ids, first, n = _different(ids, _word_ids(texts, keys, ~seed)[0])
            joined = b"\n".join(texts)
            words = [joined[a:b].lower().decode() for a, b in zip(starts[first].tolist(), ends[first].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids.view(np.int64)), pa.array([names[r] for r in rows[first].tolist()], pa.string()),
                 pa.array(words, pa.string()), pa.array(n.astype(np.int64))],
                names=["id", "lang", "word", "f"],
            )


def _permuted(words: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """The columns of a phrase, ids of as many bits, after an invertible permutation: each in turn takes
    in a hash of all others."""
    out = list(words)
    for turn in range(2 * len(out)):
        i = turn % len(out)
        out[i] = out[i] ^ (_others(out, i, turn) >> U64(64 - bits))
    return out


def _restored(columns: list[np.ndarray], bits: int) -> list[np.ndarray]:
    out = list(columns)
    for turn in reversed(range(2 * len(out))):
        i = turn % len(out)
        out[i] = out[i] ^ (_others(out, i, turn) >> U64(64 - bits))
    return out


def _others(columns: list[np.ndarray], i: int, turn: int) -> np.ndarray:
    others = [c for j, c in enumerate(columns) if j != i]
    return reduce(lambda h, c: mixed(h + c + U64(0x9E3779B97F4A7C15)), others, np.full_like(columns[0], turn + 1))


def _summed(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Different phrases in order, with the sums of their counts."""
    if not len(counts):
        return columns, counts
    order = np.argsort(columns[0], kind="stable")
    ordered = [c[order] for c in columns]
    same = [np.diff(c) == 0 for c in ordered]
    if np.any(same[0] & ~np.logical_and.reduce(same)):  # phrases that share their first column
        order = np.lexsort(columns[::-1])
        ordered = [c[order] for c in columns]
        same = [np.diff(c) == 0 for c in ordered]
    first = np.concatenate([[0], np.flatnonzero(~np.logical_and.reduce(same)) + 1])
    return [c[first] for c in ordered], np.add.reduceat(counts[order], first)


def _low_bytes(column: np.ndarray, size: int) -> np.ndarray:
    return column.astype("<u8").view(np.uint8).reshape(len(column), 8)[:, :size]


def filter_bytes(columns: list[np.ndarray], counts: np.ndarray, bits: int = 64) -> bytes:
    """A counting quotient filter of sorted, permuted phrases.

    Bits of the first column under a multiple of eight are remainder, chosen so that there are at most
    four slots an entry. Of the quotients from the first on, the bit vector has a one for each
    entry and a zero at the end of each slot. Remainders follow whole; counts under 255 take a byte.
    """
    head, n = columns[0], len(counts)
    if not n:
        return b""
    spread = int(head[-1] - head[0])
    kept = next(r for r in range(0, 72, 8) if (spread >> r) <= 4 * n)
    quotients = (head >> U64(kept)) - (head[0] >> U64(kept)) if kept < 64 else np.zeros(n, dtype=U64)
    places = np.arange(n) + quotients.astype(np.int64)
    runs = np.zeros(int(places[-1]) + 1, dtype=bool)
    runs[places] = True
    small = np.minimum(counts, 255).astype(np.uint8)
    large = counts[counts >= 255].astype("<i8")
    start = (int(head[0]) >> kept << kept) if kept < 64 else 0
    header = np.array([n, len(runs), len(large), kept, start, bits], dtype="<u8")
    others = [_low_bytes(c, bits // 8) for c in columns[1:]]
    parts = [header, np.packbits(runs), _low_bytes(head, kept // 8), *others, small, large]
    return b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


def filter_entries(packed: bytes, words: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The permuted phrases of a filter and their counts."""
    if not packed:
        return [np.zeros(0, dtype=U64)] * words, np.zeros(0, dtype=np.int64)
    n, n_runs, n_large, kept, start, bits = (int(v) for v in np.frombuffer(packed, "<u8", 6))
    at = 48

    def take(kind: str, items: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(packed, kind, items, at)
        at += found.nbytes
        return found

    def numbers(size: int) -> np.ndarray:
        low = np.zeros((n, 8), dtype=np.uint8)
        low[:, :size] = take("u1", n * size).reshape(n, size)
        return low.view("<u8").reshape(n).astype(U64)

    places = np.flatnonzero(np.unpackbits(take("u1", -(-n_runs // 8)), count=n_runs))
    quotients = (places - np.arange(n)).astype(U64)
    head = numbers(kept // 8) + U64(start)
    if kept < 64:
        head += quotients << U64(kept)
    others = [numbers(bits // 8) for _ in range(words - 1)]
    counts = take("u1", n).astype(np.int64)
    counts[counts == 255] = take("<i8", n_large)
    return [head, *others], counts


def _probes(ids: np.ndarray, slice_bits: int) -> Iterator[np.ndarray]:
    """Places in its slice at which the Bloom filter has a bit for each id; the slice is the top byte."""
    for i in range(_PROBES):
        yield (mixed(ids + U64(0xD1B54A32D192ED03 + i)) & U64(slice_bits - 1)).astype(np.int64)


def _bloom_slice(key, rows: pa.Table, slice_bits: int) -> pa.Table:
    ids, held = rows["id"].to_numpy().view(U64), np.zeros(slice_bits, dtype=bool)
    for places in _probes(ids, slice_bits):
        held[places] = True
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "held": pa.array([np.packbits(held).tobytes()], pa.binary())})


def _may_be_frequent(ids: np.ndarray, held: np.ndarray) -> np.ndarray:
    slice_bits = 8 * len(held) // _SLICES
    base, found = (ids >> U64(56)).astype(np.int64) * slice_bits, np.ones(len(ids), dtype=bool)
    for places in _probes(ids, slice_bits):
        at = base + places
        found &= (held[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
    return found


def _let_through(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    held = np.frombuffer(sent.value, dtype=np.uint8)
    for batch in batches:
        yield batch.filter(pa.array(_may_be_frequent(batch.column("id").to_numpy().view(U64), held)))


def _cut(n: int, columns: list[np.ndarray], counts: np.ndarray, shards: int, bits: int) -> Iterator[tuple[int, int, bytes]]:
    """(words, shard, filter) of sorted phrases."""
    # the range of the first column is cut evenly; its first 32 bits decide, as there are far fewer shards
    of = ((columns[0] >> U64(bits - 32)) * U64(shards)) >> U64(32)
    ids, first = np.unique(of, return_index=True)
    for shard, a, b in zip(ids.tolist(), first, [*first[1:], len(of)]):
        yield n, shard, filter_bytes([c[a:b] for c in columns], counts[a:b], bits)


def _filled(batches: Iterator[pa.RecordBatch], seed: int, longest: int, shards: int, bits: int, sent, limit: int) -> Iterator[pa.RecordBatch]:
    held = np.frombuffer(sent.value, dtype=np.uint8)
    buffer: dict[int, list[list[np.ndarray]]] = {n: [] for n in range(2, longest + 1)}
    size = 0

    def filters() -> pa.RecordBatch:
        rows = []
        for n, some in buffer.items():
            if some:
                columns = _permuted([np.concatenate(c) for c in zip(*some)], bits)
                rows += _cut(n, *_summed(columns, np.ones(len(columns[0]), dtype=np.int64)), shards, bits)
            some.clear()
        kinds = (pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["words", "shard", "filter"])

    for batch in batches:
        at = 0
        for column in slices(batch.column("text")):
            part, at = batch.slice(at, len(column)), at + len(column)
            ids, goes_on, *_ = _word_ids(text_bytes(column), _language_keys(part.column("lang"))[0], seed)
            ok = _may_be_frequent(ids, held)
            ids &= U64((1 << bits) - 1)
            for a in range(0, len(ids), limit):  # phrases are told by their first word
                b = min(a + limit, len(ids))
                whole = ok[a:b]
                for n in range(2, longest + 1):
                    last = min(b, len(ids) - n + 1)
                    if last <= a:
                        break
                    ends = slice(a + n - 1, last + n - 1)
                    whole = whole[: last - a] & ok[ends] & goes_on[ends]
                    starts = np.flatnonzero(whole) + a
                    if len(starts):
                        buffer[n].append([ids[starts + i] for i in range(n)])
                        size += len(starts)
                if size >= limit:
                    yield filters()
                    size = 0
    if size:
        yield filters()


def _merged(key, rows: pa.Table, longest: int, least: int, bits: int) -> pa.Table:
    """The phrases of a shard that occur ``least`` times, from its filters."""
    found: dict[str, list] = {"words": [], "f": [], **{f"w{i}": [] for i in range(1, longest + 1)}}
    for n in range(2, longest + 1):
        packed = [p for w, p in zip(rows["words"].to_pylist(), rows["filter"].to_pylist()) if w == n]
        read = [filter_entries(p, n) for p in packed]
        if not read:
            continue
        columns = [np.concatenate(c) for c in zip(*(r[0] for r in read))]
        columns, counts = _summed(columns, np.concatenate([r[1] for r in read]))
        often = counts >= least
        words = _restored([c[often] for c in columns], bits)
        found["words"].append(np.full(len(words[0]), n, dtype=np.int32))
        found["f"].append(counts[often])
        for i in range(longest):
            found[f"w{i + 1}"].append(words[i] if i < n else np.zeros(len(words[0]), dtype=U64))
    kinds = {"words": pa.int32()}
    return pa.table({
        c: pa.array(np.concatenate(v).astype(np.int32 if c == "words" else np.uint64).view(np.int32 if c == "words" else np.int64)
                    if v else [], kinds.get(c, pa.int64()))
        for c, v in found.items()
    })


def word_counts(docs: DataFrame) -> tuple[DataFrame, int]:
    """(id, lang, word, f) of every word of ``docs`` (lang, text), and the seed with which ids are unique."""
    for seed in count():
        found = docs.mapInArrow(partial(_count_words, seed=seed), "id bigint, lang string, word string, f bigint")
        words = checkpointed(found.groupBy("id", "lang", "word").agg(F.sum("f").alias("f")))
        if words.groupBy("id").count().where("count > 1").isEmpty():
            return words, seed


def _narrow(words: DataFrame, sent) -> int:
    """The least number of bits of an id, in whole bytes, that tells the words that the filter lets through apart."""
    through = checkpointed(words.select("id").mapInArrow(partial(_let_through, sent=sent), "id bigint"))
    bits = max(32, -(-2 * through.count().bit_length() // 8) * 8)
    while bits < 64:
        narrow = F.col("id").bitwiseAND(F.lit((1 << bits) - 1))
        if through.groupBy(narrow.alias("narrow")).count().where("count > 1").isEmpty():
            return bits
        bits += 8
    return 64


def phrase_counts(docs: DataFrame, words: DataFrame, seed: int, least: int, longest: int) -> tuple[DataFrame, int]:
    """(words, w1, w2, …, f) of the phrases of 2 to ``longest`` words that occur ``least`` times, and the
    bits of the ids they are made of."""
    spark = docs.sparkSession
    often = words.where(F.col("f") >= least).select("id")
    total, frequent = words.agg(F.coalesce(F.sum("f"), F.lit(0)), F.count_if(F.col("f") >= least)).first()
    slice_bits = 1 << min(_SLICE_BITS.bit_length() - 1, max(10, (12 * frequent // _SLICES).bit_length()))
    top = F.shiftrightunsigned("id", 56).cast("int").alias("slice")
    made = often.select(top, "id").groupBy("slice").applyInArrow(
        lambda key, rows: _bloom_slice(key, rows, slice_bits), "slice int, held binary"
    )
    size = slice_bits // 8
    held = bytearray(_SLICES * size)
    for row in made.toLocalIterator():  # as many rows as slices, 32 MB together at most
        held[row.slice * size : (row.slice + 1) * size] = row.held
    sent = spark.sparkContext.broadcast(bytes(held))
    bits = _narrow(words, sent)
    shards = total // SHARD_WORDS + 1
    filled = docs.mapInArrow(
        partial(_filled, seed=seed, longest=longest, shards=shards, bits=bits, sent=sent, limit=BUFFER), "words int, shard int, filter binary"
    )
    columns = ", ".join(f"w{i} bigint" for i in range(1, longest + 1))
    merged = filled.groupBy("shard").applyInArrow(
        lambda key, rows: _merged(key, rows, longest, least, bits), f"words int, f bigint, {columns}"
    )
    return checkpointed(merged), bits


def _of(first: int, last: int) -> Column:
    """The key of the part of a phrase from word ``first`` to ``last``: as many ids."""
    return F.struct(*[F.col(f"w{i}").alias(f"k{i - first}") for i in range(first, last + 1)])


def _with_parts(phrases: DataFrame, counted: DataFrame, often: DataFrame, longest: int) -> DataFrame:
    """Phrases with ``f_i_j``, the count of their words i to j where a cut needs it, with their words
    and the language. Each part is looked up for phrases of all lengths at once."""
    spread = ["words", *[f"w{i}" for i in range(1, longest + 1)]]
    for size in range(1, longest):
        for i in range(1, longest - size + 2):
            j = i + size - 1
            if size == 1:
                needed, lang = F.col("words") >= j, ["lang"] if i == 1 else []
                part = often.select(F.struct(F.col("id").alias("k0")).alias("whole"), F.col("f").alias(f"f_{i}_{j}"), F.col("word").alias(f"word{i}"), *lang)
            else:
                at_end = F.lit(True) if i == 1 else F.col("words") == j
                needed = (F.col("words") > size) & (F.col("words") >= j) & at_end
                part = counted.where(F.col("words") == size).select(_of(1, size).alias("whole"), F.col("f").alias(f"f_{i}_{j}"))
            key = F.when(needed, _of(i, j)).alias("part")
            phrases = lookup(
                phrases.select("*", key), part, "part", "whole", hot_from=counted.select(key).where("part IS NOT NULL"), spread_by=spread
            ).drop("part")
        phrases = checkpointed(phrases)
    return phrases


def _lowest_cut(longest: int) -> Column:
    """(score, k, l, r) of the lowest-scoring cut of a phrase, ties to the first."""
    wide = "decimal(18,0)"
    cuts = []
    for k in range(1, longest):
        right = f"CASE words {' '.join(f'WHEN {n} THEN f_{k + 1}_{n}' for n in range(k + 1, longest + 1))} END"
        score = (
            f"CAST(1000000 AS decimal(7,0)) * CAST(a AS {wide}) * CAST(a AS {wide}) "
            f"DIV (CAST(f_1_{k} AS {wide}) * CAST({right} AS {wide}))"
        )
        cut = F.struct(F.expr(score).alias("score"), F.lit(k).alias("k"), F.col(f"f_1_{k}").alias("l"), F.expr(right).alias("r"))
        cuts.append(F.when(F.col("words") > k, cut))
    return F.array_min(F.array(*cuts))


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    *,
    least: int = 10,
    longest: int = 3,
    absorbed_percent: int = 50,
    per_language: int = 2_000,
) -> DataFrame:
    """The best phrases of 2 to ``longest`` words of each language.

    Texts are lower-cased (A to Z), cut at ``. , ; : ! ?`` and line ends, and words are what white
    space parts. Candidates occur ``least`` times. The score of a cut in two is a million times the
    squared count of the phrase over the product of the parts' counts, rounded down; the lowest counts.
    A candidate inside a longer one that occurs ``absorbed_percent`` of its times or more is dropped.
    Gives lang, rank, phrase, a (its count), l, r (the parts' counts), n (words of the language), score.
    """
    source = docs.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text"))
    words, seed = word_counts(source)
    counted, bits = phrase_counts(source, words, seed, least, longest)
    often = words.where(F.col("f") >= least)
    if bits < 64:
        often = often.withColumn("id", F.col("id").bitwiseAND(F.lit((1 << bits) - 1)))
    candidates = [counted.where(F.col("words") == n).withColumnRenamed("f", "a") for n in range(2, longest + 1)]
    for n in range(2, longest):
        longer = reduce(DataFrame.unionByName, [
            counted.where(F.col("words") == m).select(_of(i, i + n - 1).alias("inner"), "f")
            for m in range(n + 1, longest + 1) for i in range(1, m - n + 2)
        ]).groupBy("inner").agg(F.max("f").alias("longer"))
        found = candidates[n - 2].join(longer, _of(1, n) == F.col("inner"), "left")
        alone = F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * absorbed_percent)
        candidates[n - 2] = found.where(alone).drop("inner", "longer")
    phrases = checkpointed(reduce(DataFrame.unionByName, candidates))
    phrases = _with_parts(phrases, counted, often, longest).withColumn("best", _lowest_cut(longest))
    phrase = F.concat_ws(" ", *[f"word{i}" for i in range(1, longest + 1)])
    scored = phrases.select("lang", phrase.alias("phrase"), "a", "best.l", "best.r", "best.score")
    best_first = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = scored.withColumn("hand", F.pmod(F.xxhash64("phrase"), F.lit(HANDS)))
    for groups in (["lang", "hand"], ["lang"]):  # so a language never sends more than its hands' best to one task
        place = F.row_number().over(Window.partitionBy(*groups).orderBy(*best_first))
        dealt = dealt.withColumn("rank", place).where(F.col("rank") <= per_language)
    ranked = dealt.drop("hand")
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
