"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

The file of a byte-level BPE vocabulary (JSON of the ``tokenizers`` library) gives tokens and ranked
merges. A text is cut at the strings of special tokens, then into pieces by the pattern of such
vocabularies; merges never cross pieces. For a prefix of a piece, the last token of its encoding is
unique: of the tokens that are suffixes of the prefix, which an automaton over all tokens reports for
every place, it is the one that may follow the last token of the prefix before it. Two tokens may
stand side by side if no merge across their border would come before the merges that made them. So
one token is kept for each prefix, and following the tokens back from the end gives the ids.

Tasks remember pieces and pairs in tables of bounded size. A piece is as long as the text makes it,
and costs time and memory in proportion. The vocabulary is broadcast; its size is that of its file,
which doesn't depend on the data.

Null texts are taken as empty and give no ids; rows that repeat give equal ids. A column of the
documents with the name of a result is replaced by the result. No rows give no rows.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm.common import SLICE_ROWS

# Fixed value: the published pattern that cuts a text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Code points whose classes don't depend on the version of Unicode; texts with others are cut by the library.
_SETTLED = r"\u0000-՗ -⁯₠-₿←-⏿─-⛿、-ヾ一-龥가-힣"
#: Pieces that a task remembers, once as new and once as older ones; and half the pairs of tokens.
_REMEMBERED = 1 << 17
#: Code points of a text that the library cuts at a time.
_CUT_CHARS = 1 << 18
_NEVER = 1 << 60


def _byte_letters() -> dict[str, int]:
    """The letter by which vocabularies of this kind write each byte: itself if it can be printed,
    else one from U+0100 on, in order."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printed]
    return {**{chr(b): b for b in printed}, **{chr(0x100 + i): b for i, b in enumerate(others)}}


class Vocabulary:
    """Tokens, ranked merges, and which tokens may stand side by side."""

    def __init__(self, text: str) -> None:
        import ahocorasick

        self._text = text
        read = json.loads(text)
        model, before = read["model"], read["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or read["normalizer"] or odd or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        letters = _byte_letters()
        ids = {name: i for name, i in model["vocab"].items()}
        self.bytes_of: dict[int, bytes] = {i: bytes(letters[c] for c in name) for name, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in read["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in read["added_tokens"]):
            raise ValueError("special tokens that take neighbouring text are not supported")
        self.bytes_of |= {i: content.encode() for content, i in self.special.items()}
        self._merges: dict[tuple[int, int], int] = {}
        self._made: dict[int, tuple[int, int, int]] = {}  # token: its halves and the rank of their merge
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, whole = ids[left], ids[right], ids[left + right]
            ready = all(len(self.bytes_of[t]) == 1 or t in self._made for t in (a, b))
            if whole in self._made or not ready:
                raise ValueError(f"merge {rank} repeats a token or comes before its parts")
            self._merges[a, b] = rank
            self._made[whole] = (a, b, rank)
        singles = {i for i in ids.values() if len(self.bytes_of[i]) == 1}
        if {self.bytes_of[i] for i in singles} != {bytes([b]) for b in range(256)}:
            raise ValueError("the vocabulary lacks bytes")
        self._spines: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self._tokens = ahocorasick.Automaton()
        self._reachable = {i: True for i in singles}
        for i in sorted(self._made, key=lambda t: self._made[t][2]):
            a, b, rank = self._made[i]
            self._reachable[i] = self._reachable[a] and self._reachable[b] and not self._crossed(a, b, rank)
        for i, ok in self._reachable.items():
            if ok:
                token = self.bytes_of[i]
                self._tokens.add_word(token.decode("latin-1"), (len(token), i))
        self._tokens.make_automaton()
        self._spines.clear()
        self._pairs: dict[tuple[int, int], bool] = {}
        self._pieces: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._pattern = regex.compile(PATTERN)
        self._unsettled = regex.compile(f"[^{_SETTLED}]")
        self._border = regex.compile(r"(?<=\S)(?= \S)")
        self._cut_specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._library = None

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at one end (0 left, 1 right) of a token while it is made, each with the rank of
        the merge that uses it up."""
        found = self._spines.get((token, side))
        if found is None:
            found, used, part = [(token, _NEVER)], _NEVER, token
            while part in self._made:
                used = self._made[part][2]
                part = self._made[part][side]
                found.append((part, used))
            if len(self._spines) >= _REMEMBERED:
                self._spines.clear()
            self._spines[token, side] = found
        return found

    def _crossed(self, a: int, b: int, before: int) -> bool:
        """Whether a merge across the border of a and b, of a rank under ``before``, takes place while
        they are made. Of equal ranks the left one is first: it uses up its part in a, not that in b."""
        for x, x_used in self._spine(a, 1):
            for y, y_used in self._spine(b, 0):
                rank = self._merges.get((x, y))
                if rank is not None and rank < x_used and rank <= y_used and rank < before:
                    return True
        return False

    def _may_follow(self, a: int, b: int) -> bool:
        if len(self._pairs) >= 2 * _REMEMBERED:
            self._pairs.clear()
        found = self._pairs[a, b] = not self._crossed(a, b, _NEVER)
        return found

    def piece_ids(self, piece: bytes) -> array:
        """The ids of one piece."""
        last = array("i", [-1]) * len(piece)  # the last token of the prefix that ends at each place
        pairs = self._pairs
        for end, (size, token) in self._tokens.iter(piece.decode("latin-1")):
            if last[end] < 0:
                if size > end:
                    last[end] = token
                elif (before := last[end - size]) >= 0:
                    fits = pairs.get((before, token))
                    if self._may_follow(before, token) if fits is None else fits:
                        last[end] = token
        ids, at = array("I"), len(piece)
        while at:
            ids.append(last[at - 1])
            at -= len(self.bytes_of[last[at - 1]])
        ids.reverse()
        return ids

    def _remembered(self, piece: str) -> bytes:
        found = self._pieces.get(piece) or self._older.get(piece)
        if found is None:
            found = _little_endian(self.piece_ids(piece.encode("utf-8", "surrogatepass")))
        if len(piece) <= 64:  # longer ones seldom come again
            if len(self._pieces) >= _REMEMBERED:
                self._older, self._pieces = self._pieces, {}
            self._pieces[piece] = found
        return found

    def _pieces_of(self, text: str) -> list[str]:
        if not self._unsettled.search(text):
            return self._pattern.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self._text).pre_tokenizer
        return [text[start:stop] for _, (start, stop) in self._library.pre_tokenize_str(text)]

    def _ordinary(self, text: str) -> Iterator[bytes]:
        """The ids of a text without special tokens, in parts."""
        known, at = self._pieces, 0
        while at < len(text):  # a border before a single space is one whatever stands around it
            border = self._border.search(text, at + _CUT_CHARS) if len(text) - at > _CUT_CHARS else None
            end = border.start() if border else len(text)
            pieces = self._pieces_of(text[at:end] if at or border else text)
            yield b"".join([known.get(p) or self._remembered(p) for p in pieces])
            at = end

    def encode(self, text: str) -> bytes:
        """The ids of a text, each as four bytes, the lowest first."""
        found, at = [], 0
        for match in self._cut_specials.finditer(text) if self._cut_specials else ():
            found += self._ordinary(text[at : match.start()])
            found.append(self.special[match.group()].to_bytes(4, "little"))
            at = match.end()
        found += self._ordinary(text[at:] if at else text)
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; ids outside the vocabulary give nothing, broken UTF-8 gives U+FFFD."""
        known = self.bytes_of
        values = memoryview(ids).cast("I") if _LITTLE else [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)]
        return b"".join([known.get(i, b"") for i in values]).decode("utf-8", "replace")


_LITTLE = array("H", [1]).tobytes() == b"\x01\x00"


def _little_endian(ids: array) -> bytes:
    if not _LITTLE:
        ids.byteswap()
    return ids.tobytes()


_LOADED: dict[int, Vocabulary] = {}


def _loaded(sent: Broadcast) -> Vocabulary:
    """The vocabulary of a broadcast, built once in a Python worker."""
    key = hash(sent.value)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(sent.value)
    return _LOADED[key]


def _sent(spark: SparkSession, vocabulary: str) -> Broadcast:
    return spark.sparkContext.broadcast(Path(vocabulary).read_text("utf-8"))


def encoder(spark: SparkSession, vocabulary: str) -> Callable[[Column], Column]:
    """A function from a text column to its packed ids. ``vocabulary`` is a file the driver can read."""
    sent = _sent(spark, vocabulary)

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        known, parts = _loaded(sent), []
        for at in range(0, len(texts), SLICE_ROWS):
            parts.append(pa.array([known.encode(t or "") for t in texts.slice(at, SLICE_ROWS).to_pylist()], pa.binary()))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    return lambda text: encode(text)


def decoder(spark: SparkSession, vocabulary: str) -> Callable[[Column], Column]:
    """A function from packed ids to their text."""
    sent = _sent(spark, vocabulary)

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        known, parts = _loaded(sent), []
        for at in range(0, len(ids), SLICE_ROWS):
            parts.append(pa.array([known.decode(i or b"") for i in ids.slice(at, SLICE_ROWS).to_pylist()], pa.string()))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return lambda ids: decode(ids)


def round_trip(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """The documents with ``ids``, ``n_tokens`` and ``decoded``, the text of these ids, in one pass."""
    sent = _sent(docs.sparkSession, vocabulary)

    @F.arrow_udf("ids binary, decoded string")
    def both(texts: pa.Array) -> pa.Array:
        known, ids, decoded = _loaded(sent), [], []
        for at in range(0, len(texts), SLICE_ROWS):
            some = [known.encode(t or "") for t in texts.slice(at, SLICE_ROWS).to_pylist()]
            ids.append(pa.array(some, pa.binary()))
            decoded.append(pa.array(map(known.decode, some), pa.string()))
        columns = [pa.concat_arrays(ids), pa.concat_arrays(decoded)] if ids else [pa.array([], pa.binary()), pa.array([], pa.string())]
        return pa.StructArray.from_arrays(columns, ["ids", "decoded"])

    found = both(F.col(text_col))
    return docs.withColumns({
        "ids": found["ids"], "n_tokens": (F.octet_length(found["ids"]) / 4).cast("bigint"), "decoded": found["decoded"],
    })


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """The documents with ``ids`` (packed, four bytes each, the lowest first) and ``n_tokens``."""
    ids = encoder(docs.sparkSession, vocabulary)(F.col(text_col))
    return docs.withColumn("ids", ids).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("bigint"))


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """The rows with the text of their packed ids."""
    return encoded.withColumn(into, decoder(encoded.sparkSession, vocabulary)(F.col(ids_col)))
