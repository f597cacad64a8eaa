"""Language identification by words first, with back-off to shorter and shorter character n-grams.

A known word adds the logarithm of its frequency in each language. A word that was not seen in
training is judged by its n-grams of ``LONGEST`` characters; if none of those is known, by shorter
ones, down to single letters. The model is fitted to a bounded sample of labelled rows, and so is
small enough for every task to hold.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.llm.common import slices

UNKNOWN = "und"
LONGEST = 4
_WORD = re.compile(r"[^\W\d_]+")
_REMEMBERED = 100_000


def _grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its edges marked; single letters have no marks."""
    marked = f"^{word}$" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters; empty if the text has no letter."""
    found = _WORD.findall((text or "").lower())
    return found if any(c.isalpha() for w in found for c in w) else []


class Model:
    """Log frequencies of words and of n-grams, a row for each and a column for each language."""

    def __init__(self, languages: list[str], words: dict[str, int], grams: list[dict[str, int]], weights: np.ndarray):
        self.languages, self.words, self.grams, self.weights = languages, words, grams, weights
        self._rows: list[list[float]] | None = None
        self._seen: dict[str, int] = {}

    def __getstate__(self) -> tuple:
        return self.languages, self.words, self.grams, self.weights

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def weight(self, word: str) -> list[float]:
        """The evidence of one word for each language."""
        if self._rows is None:
            self._rows = self.weights.tolist()
        rows = self._rows
        at = self.words.get(word)
        if at is not None:
            return rows[at]
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            of_size = self.grams[n]
            known = [rows[of_size[g]] for g in _grams(word, n) if g in of_size]
            if known:
                return [sum(column) / len(known) for column in zip(*known)]
        return [0.0] * len(self.languages)

    def judged(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The most likely language of each text and its probability; ties go to the first by name.
        Weights of words are remembered from text to text, and forgotten when they are too many."""
        languages, scores = [], []
        for text in texts:
            words = words_of(text)
            if not words or not self.languages:
                languages.append(UNKNOWN)
                scores.append(0.0)
                continue
            counts = Counter(words)
            if not self._seen or len(self._seen) + len(counts) > _REMEMBERED:
                self._seen = {}
                self._kept = np.empty((max(_REMEMBERED, len(counts)), len(self.languages)))
            seen = self._seen
            for word in [w for w in counts if w not in seen]:
                self._kept[len(seen)] = self.weight(word)
                seen[word] = len(seen)
            at = np.fromiter((seen[w] for w in counts), dtype=np.int64, count=len(counts))
            total = np.fromiter(counts.values(), dtype=float, count=len(counts)) @ self._kept[at]
            best = int(np.argmax(total))
            languages.append(self.languages[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return languages, scores


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, _n, _part, _count): words under n = 0, n-grams of the words under their n."""
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for word, c in Counter(words_of(text)).items():
                counts[lang, 0, word] += c
                for n in range(1, LONGEST + 1):
                    for gram in _grams(word, n):
                        counts[lang, n, gram] += c
        if counts:
            langs, sizes, parts = zip(*counts)
            yield pa.record_batch({
                "lang": pa.array(langs, pa.string()), "_n": pa.array(sizes, pa.int32()),
                "_part": pa.array(parts, pa.string()), "_count": pa.array(list(counts.values()), pa.int64()),
            })


def sample_of(labelled: DataFrame, per_language: int) -> DataFrame:
    """The rows (id, lang, text) of each language with the smallest hashes of id and text, up to
    ``per_language``. Only hashes are shuffled to find the limits, not texts."""
    hashed = labelled.withColumn("h", F.xxhash64("id", "text"))
    least = hashed.select("lang", "h").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # Hashes are even: the limit that leaves twice the rows wanted bounds what is ranked.
    limits = least.select(
        F.col("lang").alias("_lang"),
        F.when(F.col("n") <= 2 * per_language, F.lit(2**63 - 1))
        .otherwise((F.lit(-(2.0**63)) + F.lit(2.0**64) * (2.0 * per_language) / F.col("n")).cast("bigint")).alias("_limit"),
    )
    near = hashed.join(F.broadcast(limits), F.col("lang") == F.col("_lang")).where(F.col("h") <= F.col("_limit"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= per_language).select("id", "lang", "text")


def fit(labelled: DataFrame, *, per_language: int = 300, least_count: int = 3) -> Model:
    """Learn from (id, lang, text): at most ``per_language`` rows of a language, parts that occur at
    least ``least_count`` times in them."""
    languages = [row[0] for row in labelled.select("lang").distinct().orderBy("lang").collect()]
    if not languages:
        return Model([], {}, [{} for _ in range(LONGEST + 1)], np.zeros((0, 0)))
    counted = (
        sample_of(labelled, per_language).select("lang", "text").mapInArrow(_counts, "lang string, _n int, _part string, _count bigint")
        .groupBy("_n", "_part").pivot("lang", languages).agg(F.sum("_count"))
    )
    total = sum((F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in languages), F.lit(0))
    rows = counted.where(total >= least_count).orderBy("_n", "_part").toArrow()
    sizes = rows["_n"].to_numpy()
    values = np.stack([rows[c].fill_null(0).to_numpy() for c in languages], axis=1).astype(float)
    parts: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    for at, (n, part) in enumerate(zip(sizes.tolist(), rows["_part"].to_pylist())):
        parts[n][part] = at
    weights = np.zeros_like(values)
    for n in range(LONGEST + 1):
        of_size = sizes == n
        share = (values[of_size] + 0.5) / (values[of_size].sum(axis=0) + 0.5 * max(1, of_size.sum()))
        weights[of_size] = np.log(share) - math.log(1 / max(1, of_size.sum()))
    return Model(languages, parts[0], parts, weights)


def predictor(labelled: DataFrame, *, per_language: int = 300) -> Callable[[Column], Column]:
    """A column function from a text to (``lang_pred``, ``score``), learnt from (id, lang, text)."""
    model = fit(labelled.where("lang IS NOT NULL AND text IS NOT NULL"), per_language=per_language)
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def predicted(texts: pa.Array) -> pa.Array:
        languages, scores = [], []
        for part in slices(texts):
            found = shared.value.judged(part.to_pylist())
            languages += found[0]
            scores += found[1]
        return pa.StructArray.from_arrays([pa.array(languages, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return F.arrow_udf(predicted, "lang_pred string, score double")


def identify(
    docs: DataFrame,
    labelled: DataFrame,
    text_col: str = "text",
    *,
    per_language: int = 300,
) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score`` (its probability, 0 to 1); columns of
    those names are replaced.

    ``labelled`` has (id, lang, text); rows without a language or text are not learnt from. A text
    that is null, empty or without a letter gets ``und`` and 0, and so does every text if nothing
    was learnt. Texts without a known part are ties: the first language by name, equal scores.
    Repeated rows get equal results; predictions read the text alone.
    """
    predict = predictor(labelled, per_language=per_language)
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    found = docs.select(*names, predict(F.col(text_col)).alias("_predicted"))
    return found.select(*names, "_predicted.lang_pred", "_predicted.score")
