"""Collocations and their counting quotient filters against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from fieldspark.llm import phrases
from tests.llm.corpus import texts

U64 = np.uint64


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(rows, least, longest=3, percent=50, limit=2_000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = tuple(w for w in re.split(r"[\x20\x09]+", piece) if w)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(words[i : i + n] for i in range(len(words) - n + 1))
    found = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {
            p[i : i + m]
            for p, a in candidates.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
            if 100 * a >= percent * candidates.get(p[i : i + m], 1 << 60)
        }
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:limit], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def corpus():
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), t) for _, t in texts()]
    rows += [("und", "New York, new york. NEW YORK! New York City; É è É è É è"), ("a", "new york\tnew york  new york")] * 3
    return rows + [("c", "x " * 3_000), ("c", None), (None, ""), ("d", "one two three")]


@pytest.mark.parametrize("least, longest, percent, limit", [(2, 3, 50, 2_000), (3, 3, 100, 7), (2, 4, 30, 50)])
def test_collocations_equal_brute_force(spark, monkeypatch, least, longest, percent, limit):
    monkeypatch.setattr(phrases, "BUFFER", 1_000)
    monkeypatch.setattr(phrases, "SHARD_WORDS", 500)
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "lang string, text string, word string, f bigint, words int").repartition(3)
    found = phrases.collocations(docs, least=least, longest=longest, absorbed_percent=percent, per_language=limit)
    assert sorted(map(tuple, found.collect())) == brute(rows, least, longest, percent, limit)


def test_nothing_to_count(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(empty).collect() == []
    assert phrases.collocations(spark.createDataFrame([("a", None), (None, " \n")], "lang string, text string")).collect() == []
    assert phrases.collocations(spark.createDataFrame([("a", "b c d")], "lang string, text string")).collect() == []


def test_other_hash_when_two_words_share_an_id(spark, monkeypatch):
    real = phrases._count_words

    def narrow(batches, seed):
        for batch in real(batches, seed):
            ids = batch.column("id").to_numpy() & (7 if seed < 2 else -1)
            yield batch.set_column(0, "id", pa.array(ids))

    monkeypatch.setattr(phrases, "_count_words", narrow)
    docs = spark.createDataFrame(corpus(), "lang string, text string")
    assert phrases.word_counts(docs.fillna("und", ["lang"]))[1] == 2


def test_words_of_one_id_in_one_pass_stay_apart():
    ids, at, n = phrases._different(np.array([3, 1, 3, 3, 1], dtype=U64), np.array([8, 5, 9, 8, 5], dtype=U64))
    assert list(zip(ids.tolist(), at.tolist(), n.tolist())) == [(1, 1, 2), (3, 0, 2), (3, 2, 1)]


def test_passes_don_t_change_words(monkeypatch):
    some = [(t or "").encode() for _, t in corpus()] + [b"", b"a" * 5_000, b"a b. c"]
    langs = np.arange(len(some)).astype(U64)
    whole = phrases._word_ids(some, langs, 3)
    for size in (1, 10, 700):
        monkeypatch.setattr(phrases, "PASS_BYTES", size)
        assert all((a == b).all() for a, b in zip(whole, phrases._word_ids(some, langs, 3)))


@pytest.mark.parametrize("words, bits", [(2, 64), (3, 40), (5, 48)])
def test_permutation_is_undone(words, bits):
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, 1 << 63, 1000).astype(U64) >> U64(64 - bits) for _ in range(words)]
    permuted = phrases._permuted(columns, bits)
    assert all((c >> U64(bits - 1) <= U64(1)).all() for c in permuted)
    assert all((a == b).all() for a, b in zip(phrases._restored(permuted, bits), columns))
    same_head = phrases._permuted([columns[0][:1].repeat(1000), *columns[1:]], bits)
    assert len(np.unique(same_head[0] >> U64(bits - 16))) > 900  # a common first word doesn't crowd a shard


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1 << 63), (2, 3), (1000, 1 << 63), (1000, 1 << 20), (700, 1 << 11), (5, (1 << 64) - 1)])
def test_filters_are_lossless(n, top):
    rng = np.random.default_rng(n)
    bits = 40 if top <= 1 << 40 else 64
    head = np.sort(rng.integers(0, top, n, dtype=U64, endpoint=True))
    others = [rng.integers(0, 1 << 63, n).astype(U64) >> U64(64 - bits) for _ in range(2)]
    counts = rng.choice([1, 2, 254, 255, 256, 1 << 40], n).astype(np.int64)
    columns, back = phrases.filter_entries(phrases.filter_bytes([head, *others], counts, bits), 3)
    assert all((a == b).all() for a, b in zip(columns, [head, *others]))
    assert (back == counts).all()


def test_filters_take_less_than_their_phrases():
    head = np.sort(np.random.default_rng(2).integers(0, 1 << 63, 20_000).astype(U64)) >> U64(24)
    packed = phrases.filter_bytes([head, head], np.ones(20_000, dtype=np.int64), 40)
    assert len(packed) < 20_000 * 9.5  # two ids of 5 bytes and a counter of 8 each otherwise


def test_ids_are_as_wide_as_they_must_be(spark):
    class Sent:
        value = b"\xff" * 256

    ids = [5, 5 + (1 << 32), 5 + (1 << 40), 9]
    for some, bits in (([5, 9], 32), (ids[:2] + ids[3:], 40), (ids, 48), ([5, 5 + (1 << 60)], 64)):
        words = spark.createDataFrame([(i,) for i in some], "id bigint")
        assert phrases._narrow(words, spark.sparkContext.broadcast(Sent.value)) == bits


def test_phrases_that_share_64_bits_stay_apart():
    a = [np.array([5, 5, 5, 1], dtype=U64), np.array([2, 1, 2, 9], dtype=U64)]
    columns, counts = phrases._summed(a, np.array([1, 10, 100, 7]))
    assert [c.tolist() for c in columns] == [[1, 5, 5], [9, 1, 2]]
    assert counts.tolist() == [7, 10, 101]
