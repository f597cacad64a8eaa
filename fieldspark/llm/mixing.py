"""Mixing a corpus to target weights by soft membership.

A classifier learnt from labelled documents gives every document a probability for each domain.
Projected-gradient least squares then finds a nonnegative rate for every document, so that the
expected tokens of each domain (rate x tokens x probability, summed) come to the target. Among
rates that do, a small ridge prefers those near 1.

With tokens as the metric a step changes the rate of a document by an amount that follows from its
probabilities and the domains' residuals alone. So the state of an iteration is one residual per
domain: every pass replays the earlier residuals for its rows and sums a few numbers.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm.common import U64, checkpointed, passes, range_hashes, slices, text_bytes, word_spans
from fieldspark.llm.tiling import token_bytes

_SYMBOL, _SHAPE = U64(0x5BD1E995A3C59AC3), U64(0xC2B2AE3D27D4EB4F)
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_FILTER_BITS = 20
_EVEN = "_even_share"
_TENTHS = 10


def _per_text(flags: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """How many of the flags hold in each text, whose bytes end at ``limits``."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    return np.diff(sums[limits], prepend=0)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, feature hash) pairs and the number of words of each text.

    Features are lower-case words, runs of symbols, and in tenths the shares of upper-case letters,
    of words that repeat the one before, and of symbols.
    """
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    upper = (raw >= 0x41) & (raw <= 0x5A)
    data = raw | (upper.view(np.uint8) << 5)
    limits = np.cumsum([len(t) + 1 for t in texts])
    token, space = token_bytes(data), _SPACES[data]
    words, word_ends = word_spans(data, token)
    hashes = range_hashes(data, words, word_ends)
    marks, mark_ends = word_spans(data, ~token & ~space)
    symbols = range_hashes(data, marks, mark_ends) ^ _SYMBOL
    of_word = np.searchsorted(limits, words, side="right")
    of_mark = np.searchsorted(limits, marks, side="right")
    again = np.zeros(len(hashes), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    n = np.maximum(1, np.bincount(of_word, minlength=len(texts)))
    letters = np.maximum(1, _per_text((data >= 0x61) & (data <= 0x7A), limits))
    shares = (
        _per_text(upper, limits) / letters,
        np.bincount(of_word, weights=again, minlength=len(texts)) / n,
        np.bincount(of_mark, minlength=len(texts)) / n,
    )
    tenths = [np.minimum(s * _TENTHS, _TENTHS).astype(U64) + U64(100 * i + 1) for i, s in enumerate(shares)]
    every = np.arange(len(texts))
    starts, _ = word_spans(data, ~space)
    counts = np.diff(np.searchsorted(starts, limits), prepend=0)
    return (
        np.concatenate([of_word, of_mark, *[every] * len(tenths)]),
        np.concatenate([hashes, symbols, *[t * _SHAPE for t in tenths]]),
        counts,
    )


@dataclass
class Classifier:
    """Softmax regression on the presence of known features."""

    domains: list[str]
    known: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def __post_init__(self) -> None:
        self.table = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.table[self.known >> U64(64 - _FILTER_BITS)] = True

    def pairs(self, texts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Different (text, index of a known feature)."""
        maybe = self.table[hashes >> U64(64 - _FILTER_BITS)]
        texts, hashes = texts[maybe], hashes[maybe]
        at = np.minimum(np.searchsorted(self.known, hashes), max(0, len(self.known) - 1))
        ok = self.known[at] == hashes if len(self.known) else np.zeros(0, dtype=bool)
        both = np.unique(texts[ok] * np.int64(len(self.known) + 1) + at[ok])
        return np.divmod(both, len(self.known) + 1)

    def logits(self, texts: np.ndarray, known: np.ndarray, n: int) -> np.ndarray:
        return self.bias + np.stack(
            [np.bincount(texts, weights=self.weights[known, k], minlength=n) for k in range(len(self.domains))], axis=1
        )

    def probabilities(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        owner, hashes, counts = features(texts)
        return _softmax(self.logits(*self.pairs(owner, hashes), len(texts))), counts


def _softmax(logits: np.ndarray) -> np.ndarray:
    grown = np.exp(logits - logits.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


def fit_classifier(
    labelled: DataFrame, domains: list[str], *, sample_size: int = 4_000, least_texts: int = 10, steps: int = 200, ridge: float = 1.0
) -> Classifier:
    """Learn from (text, domain). Fitted to the ``sample_size`` labelled rows with the smallest
    hashes, on features that ``least_texts`` of them have; rows without a text, or whose domain is not
    among ``domains``, are not learnt from. Only the sample's features reach the driver."""
    usable = labelled.where(F.col("text").isNotNull() & F.col("domain").isin(domains)).withColumn("h", F.xxhash64("text", "domain"))
    total = usable.count()
    limit = int(-(2**63) + 2**64 * min(1.0, 2 * sample_size / max(1, total))) - 1

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in map(text_bytes, slices(batch.column("text"))):
                for a, b in passes([len(t) + 1 for t in texts]):
                    owner, hashes, _ = features(texts[a:b])
                    order = np.argsort(owner, kind="stable")
                    limits = np.searchsorted(owner[order], np.arange(1, b - a))
                    sets = [np.unique(part).view(np.int64) for part in np.split(hashes[order], limits)]
                    yield pa.record_batch({
                        "h": batch.column("h").slice(at, b - a), "domain": batch.column("domain").slice(at, b - a),
                        "features": pa.array(sets, pa.list_(pa.int64())),
                    })
                    at += b - a

    near = usable.where(F.col("h") <= limit).select("h", "domain", "text")
    sample = (
        near.mapInArrow(featured, "h bigint, domain string, features array<bigint>")
        .orderBy("h", "domain").limit(sample_size).select("domain", "features").toArrow()
    )
    labels = np.array([domains.index(d) for d in sample["domain"].to_pylist()], dtype=np.int64)
    n = len(labels)
    features_of = sample["features"].combine_chunks()
    hashes = pc.list_flatten(features_of).to_numpy(zero_copy_only=False).astype(np.int64).view(U64)
    every, counts = np.unique(hashes, return_counts=True)
    known = every[counts >= least_texts]
    shape = (len(known), len(domains))
    model = Classifier(domains, known, np.zeros(shape), np.zeros(len(domains)))
    if not n:
        return model
    owner, at = model.pairs(np.repeat(np.arange(n), pc.list_value_length(features_of).to_numpy(zero_copy_only=False)), hashes)
    truth = np.eye(len(domains))[labels]
    moved = [np.zeros(shape), np.zeros(len(domains))]
    scale = [np.zeros(shape), np.zeros(len(domains))]
    for step in range(1, steps + 1):  # Adam
        error = _softmax(model.logits(owner, at, n)) - truth
        slopes = [
            np.stack([np.bincount(at, weights=error[owner, k], minlength=len(known)) for k in range(len(domains))], axis=1) + ridge * model.weights,
            error.sum(axis=0),
        ]
        for i, (slope, value) in enumerate(zip(slopes, (model.weights, model.bias))):
            moved[i] = 0.9 * moved[i] + 0.1 * slope
            scale[i] = 0.999 * scale[i] + 0.001 * slope**2
            value -= 0.05 * (moved[i] / (1 - 0.9**step)) / (np.sqrt(scale[i] / (1 - 0.999**step)) + 1e-8)
    return model


@dataclass
class Rates:
    """Rates as a function of probabilities: the residuals of all steps, replayed. ``distance`` bounds how
    far they are from the solution (root of the token-weighted mean square), ``converged`` says whether that is
    within the tolerance asked for, and ``reached`` are the tokens of each domain, as shares of the corpus."""

    weights: np.ndarray
    ridge: float
    residuals: list[np.ndarray]
    distance: float = 0.0
    converged: bool = True
    reached: np.ndarray | None = None

    def of(self, share: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rates of rows of probabilities after all steps, the point the next step starts from (with
        Nesterov's momentum, as it is best for a problem this convex), and by how much the last step moved."""
        rate = ahead = np.ones(len(share))
        moved = np.zeros(len(share))
        root = np.sqrt(self.ridge / (1 + self.ridge))
        for t, residual in enumerate(self.residuals):
            slope = share @ (self.weights * residual) + self.ridge * (ahead - 1)
            step = np.maximum(0, ahead - slope / (1 + self.ridge))
            moved = step - ahead
            ahead = np.maximum(0, step + min(t / (t + 3), (1 - root) / (1 + root)) * (step - rate))
            rate = step
        return rate, ahead, moved


def posteriors(docs: DataFrame, classifier: Classifier, text_col: str = "text", rates: Rates | None = None) -> DataFrame:
    """All columns of ``docs`` with ``n_tokens`` (words between white space) and ``posterior``, an array with the
    probability of each domain; with ``rates`` also ``rate``, from the same pass over the texts. A null text has
    no words and gets the probabilities of an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast((classifier, rates))
    width = len(classifier.domains)

    def judged(column: pa.Array) -> pa.Array:
        model, held = shared.value
        parts = []
        for texts in map(text_bytes, slices(column)):
            parts += [model.probabilities(texts[a:b]) for a, b in passes([len(t) + 1 for t in texts])]
        share = np.concatenate([p[0] for p in parts]) if parts else np.zeros((0, width))
        counts = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0)
        limits = pa.array(np.arange(len(column) + 1, dtype=np.int32) * width)
        found = {"n": pa.array(counts, pa.int64()), "p": pa.ListArray.from_arrays(limits, pa.array(share.ravel()))}
        if held is not None:
            found["r"] = pa.array(held.of(share)[0])
        return pa.StructArray.from_arrays(list(found.values()), names=list(found))

    made = {"n_tokens": "n", "posterior": "p"} | ({} if rates is None else {"rate": "r"})
    kind = "n bigint, p array<double>" + ("" if rates is None else ", r double")
    names = [c for c in docs.columns if c not in made]
    found = docs.select(*names, F.arrow_udf(judged, kind)(F.col(text_col)).alias("_judged"))
    return found.select(*names, *(F.col(f"_judged.{field}").alias(name) for name, field in made.items()))


def _shares(column: pa.Array, width: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(-1, width)


def fit_rates(
    judged: DataFrame, targets: list[float], *, ridge: float = 0.01, steps: int = 1_000, tolerance: float = 1e-3, rows_per_task: int = 500_000
) -> Rates:
    """Projected-gradient least squares for (``n_tokens``, ``posterior``).

    Minimises half the sum over domains of (tokens - target)^2 / present tokens, with ``ridge``
    times the token-weighted (rate - 1)^2, all relative to the corpus, over rates of at least 0.
    ``targets`` are the wanted tokens of each domain as shares of the corpus. Ends when the projected
    gradient proves the rates to be within ``tolerance`` of the solution (``Rates.distance``). Should ``steps`` passes
    not do, a warning says so and the rates are marked. A pass brings one row of numbers to the driver.
    """
    width = len(targets)
    kept = checkpointed(judged.where("n_tokens > 0").select(F.col("n_tokens").cast("double").alias("n"), "posterior"))
    count = kept.count()
    kept = kept.coalesce(max(kept.sparkSession.sparkContext.defaultParallelism, count // rows_per_task))
    rates = Rates(np.zeros(width), ridge, [])

    def total() -> tuple[np.ndarray, float]:
        held = rates

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    n, share = batch.column(0).to_numpy(), _shares(batch.column(1), width)
                    _, ahead, moved = held.of(share)
                    found = [*((n * ahead) @ share), n @ moved**2]
                    yield pa.record_batch({"k": pa.array(range(width + 1), pa.int32()), "s": pa.array(found)})

        rows = kept.mapInArrow(sums, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
        found = np.zeros(width + 1)
        for row in rows:
            found[row["k"]] = row["s"]
        return found[:width], found[width]

    present, _ = total()
    corpus = present.sum()
    if corpus <= 0:
        return rates
    rates.weights = np.divide(corpus, present, out=np.zeros(width), where=present > 0)
    wanted = np.array(targets)
    now, rates.converged = present, False
    for _ in range(steps):
        rates.residuals.append(now / corpus - wanted)
        now, moved = total()
        # a step of length s from a point is no further than s * (steepest / flattest slope) from the solution
        rates.distance = float(np.sqrt(moved / corpus)) * (1 + ridge) / max(ridge, 1e-9)
        if rates.distance <= tolerance:
            rates.converged = True
            break
    rates.reached = now / corpus
    if not rates.converged:
        warnings.warn(f"rates may be {rates.distance:.2g} off the solution after {steps} steps", stacklevel=2)
    return rates


def _rated(spark: SparkSession, rates: Rates) -> Callable[[Column], Column]:
    """A function from probabilities to their rate."""
    shared, width = spark.sparkContext.broadcast(rates), len(rates.weights)

    @F.arrow_udf("double")
    def rated(column: pa.Array) -> pa.Array:
        return pa.array(shared.value.of(_shares(column, width))[0])

    return lambda posterior: rated(posterior)


def reached_totals(mixed: DataFrame, targets: dict[str, float]) -> DataFrame:
    """(domain, wanted, reached) of a mixture: the expected tokens of each domain as shares of the corpus. What the
    documents can't reach, or what ``ridge`` holds back, shows as a difference."""
    shares = [
        F.struct(
            F.lit(d).alias("domain"), F.lit(float(targets[d])).alias("wanted"),
            (F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")) / F.sum("n_tokens")).alias("reached"),
        )
        for d in sorted(targets)
    ]
    return mixed.agg(F.array(*shares).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_text: bool = True,
    **fitting: float,
) -> DataFrame:
    """All columns of ``docs`` with ``n_tokens``, ``p_<domain>`` for each domain, ``rate`` (how often the document
    is to be used on average) and ``copies`` (the rate rounded up or down by a hash of id and text,
    with the right mean).

    ``labelled`` has (text, domain); ``targets`` gives each domain's tokens as a share of the corpus's.
    A domain that no document can belong to cannot be reached and is passed over. A null or empty
    text has no tokens; its rate follows from the probabilities of an empty text and weighs nothing.
    Without ``keep_text`` the text is left out of the result, and read once: probabilities are written. With
    it they are found again from the text when rates are given, as writing texts would take more room.
    Repeated rows get equal rates. An empty table gives an empty result; without labels all domains
    are equally likely.
    """
    domains = sorted(targets)
    classifier = fit_classifier(labelled, domains)
    wanted = [targets[d] for d in domains]
    docs = docs.withColumn(_EVEN, F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 30)) / (1 << 30))
    if keep_text:
        judged = posteriors(docs.select(text_col), classifier, text_col)
        rates = fit_rates(judged.select("n_tokens", "posterior"), wanted, **fitting)
        found = posteriors(docs, classifier, text_col, rates)
    else:
        judged = checkpointed(posteriors(docs, classifier, text_col).drop(text_col, "rate"))
        rates = fit_rates(judged.select("n_tokens", "posterior"), wanted, **fitting)
        found = judged.withColumn("rate", _rated(docs.sparkSession, rates)(F.col("posterior")))
    made = {"n_tokens", "posterior", "rate", "copies", _EVEN, *(f"p_{d}" for d in domains)}
    own = [c for c in found.columns if c not in made]
    return found.select(
        *own, "n_tokens", *(F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(domains)), "rate",
        F.floor(F.col("rate") + F.col(_EVEN)).alias("copies"),
    )
