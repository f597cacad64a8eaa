"""Byte-level BPE against the library whose files it reads."""

import hashlib
import json
import random
import struct

import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from fieldspark.llm import bpe
from fieldspark.llm.queries import op12_bpe_tokens
from tests.llm.corpus import documents, texts

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "a", " ", "  ", "\n", "'s", "é", "語", "̀", "1", "!", "<|endoftext|>", "<|", " A", "th", "he", "in", "ก", "😀", "\U0001f9ff",
    "ᲊ", "‍", "_", "\t", "\r\n", "aaaaaaaa", "========", "\x85", "\x1c", "�", "͸", "\x00",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def vocabulary():
    with open(FILE, encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


def packed(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids)


def test_random_texts(library, vocabulary):
    rng = random.Random(3)
    some = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    some += ["".join(rng.choice("abcdeiotn sr") for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    for text in some:
        ids = packed(library, text)
        assert vocabulary.encode(text) == ids, text
        whole = library.decode(list(struct.unpack(f"<{len(ids) // 4}I", ids)), skip_special_tokens=False)
        assert vocabulary.decode(ids) == whole == text


@pytest.mark.parametrize("text", ["a" * 200_001, "ab" * 60_000, "語" * 50_000, " " * 50_000 + "x", "\U0001f9ff a" * 40_000])
def test_long_texts_without_word_ends(library, vocabulary, monkeypatch, text):
    monkeypatch.setattr(bpe, "_CUT_CHARS", 1_000)
    assert vocabulary.encode(text) == packed(library, text)


def test_settled_code_points_are_cut_alike(library):
    settled, pattern = regex.compile(f"[{bpe._SETTLED}]"), regex.compile(bpe.PATTERN)
    for c in filter(settled.match, map(chr, [*range(0xD800), *range(0xE000, 0x10000)])):
        text = f"a{c}1{c}!{c} {c}"
        assert [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)] == pattern.findall(text)


def test_pairs_are_those_that_the_library_leaves_alone(library, vocabulary):
    rng = random.Random(4)
    whole = [i for i, b in vocabulary.bytes_of.items() if b.isalpha()]
    for _ in range(2000):
        a, b = rng.choice(whole), rng.choice(whole)
        text = (vocabulary.bytes_of[a] + vocabulary.bytes_of[b]).decode()
        alone = library.encode(text, add_special_tokens=False).ids == [a, b]
        assert (not vocabulary._crossed(a, b, bpe._NEVER)) == alone


def test_other_vocabularies_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        bpe.Vocabulary(f.read())


def test_caches_may_be_emptied(library, monkeypatch):
    monkeypatch.setattr(bpe, "_REMEMBERED", 5)
    with open(FILE, encoding="utf-8") as f:
        tiny = bpe.Vocabulary(f.read())
    text = " ".join(json.dumps(t) for _, t in texts()[:20])
    assert tiny.encode(text) == packed(library, text)


def test_documents(spark, library):
    docs = documents(spark).withColumnRenamed("chunk", "ids").withColumnRenamed("score", "n_tokens")
    for found in (bpe.decode(bpe.encode(docs, FILE), FILE), bpe.round_trip(docs, FILE)):
        assert sorted(found.columns) == sorted([*docs.columns, "decoded"])
        rows = found.select("doc_id", "text", "ids", "n_tokens", "decoded").collect()
        assert len(rows) == docs.count()
        for row in rows:
            ids = packed(library, row.text or "")
            assert (bytes(row.ids), row.n_tokens, row.decoded) == (ids, len(ids) // 4, row.text or "")
    assert bpe.round_trip(docs.limit(0), FILE).count() == 0


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in op12_bpe_tokens(spark, sf).collect()}
    for doc_id, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = packed(library, text or "")
        row = found[doc_id]
        assert row.n_tokens == len(ids) // 4
        assert row.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
