"""BPE with word ends: encoding and decoding.

A text is cut at special tokens; the rest is composed (NFC) and lower-cased letter by
letter; pre-tokens are contractions, runs of letters, single digits and runs of other
signs. A pre-token's bytes become symbols, the last one with a word end.

A pre-token of up to ``SHORT`` symbols is merged on a contiguous rank array: the part
boundaries and the rank of each adjacent pair stand in two lists; the least rank,
leftmost first, is looked up again and again, its boundary deleted and the two
neighbouring ranks refreshed. Longer ones would take quadratic time that way; they go
through a heap over a linked list, with the same result.

Python and the tokenizer know different versions of Unicode. Which code points they
compose, order or lower-case differently is found by comparison when a file is read;
a text that holds one is normalised by the tokenizer's own normaliser.

Defined results: a null text counts as empty and has no tokens; white space has none.
Special tokens written out in a text become their ids. Decoding joins the tokens'
strings with single spaces. Repeated rows get equal results. Other columns are
dropped unless named.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType
from tokenizers import Tokenizer
from tokenizers.normalizers import Normalizer

from .common import boxed, quoted, unboxed

SHORT = 64
# Characters of words and of what is kept for them.
CACHE = 64 << 20
_WS = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_NO_RANK = 1 << 60
# The normaliser treats a code point otherwise than Python; the pattern does.
UNLIKE, OTHER_KIND = 1, 2

# Code points that the installed regular expressions count as letters or
# numbers and the tokenizer, of an older Unicode version, as other signs.
NEWER = (
    "\\u0558 \\u058b-\\u058c \\u088f \\u0c5c \\u0cdc \\u1c89 \\u208f \\u209d-\\u209f \\ua7cb-\\ua7cc \\ua7ce-\\ua7cf "
    "\\ua7d2 \\ua7d4 \\ua7da \\ua7dc-\\ua7dd \\ua7e2 \\ua7f1 \\uab6c-\\uab6d \\U000107bb-\\U000107bf "
    "\\U00010940-\\U00010959 \\U00010d50-\\U00010d65 \\U00010ec5-\\U00010ec7 \\U00010ed9-\\U00010eee \\U00011b0a "
    "\\U00011db0-\\U00011ddb \\U00011de0-\\U00011de9 \\U00011df1 \\U0001246f \\U00012475-\\U0001247f "
    "\\U00012550-\\U00012686 \\U00016ea0-\\U00016eb8 \\U00016ebb-\\U00016ed3 \\U00016ff2-\\U00016ff6 "
    "\\U000187f8-\\U000187ff \\U00018cd6-\\U00018cda \\U00018d09-\\U00018d20 \\U00018d80-\\U00018df2 "
    "\\U00018e00-\\U00019191 \\U000191a0-\\U000191d2 \\U0001b123-\\U0001b128 \\U0001b168 \\U0001d6a6 "
    "\\U0001df1f-\\U0001df24 \\U0001df2b-\\U0001df81 \\U0001df90-\\U0001df96 \\U0001dfcd-\\U0001dfff "
    "\\U0001e6c0-\\U0001e6de \\U0001e6e0-\\U0001e6e2 \\U0001e6e4-\\U0001e6e5 \\U0001e6e7-\\U0001e6ed "
    "\\U0001e6f0-\\U0001e6f4 \\U0001e6fe-\\U0001e6ff \\U0002b73a-\\U0002b73f \\U0002b81e \\U0002cea2-\\U0002cead "
    "\\U000323b0-\\U00033479 \\U0003d000-\\U0003fc3f"
).replace(" ", "")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(256 + len(symbols) - len(printable))
    return [symbols[b] for b in range(256)]


@dataclass
class Vocabulary:
    """Tables of one tokenizer file; small, of a fixed size, and sent to every task."""

    tokens: list[str]
    inner: list[int]  # id of each byte
    final: list[int]  # id of each byte at a word's end
    ranks: dict[int, int]  # pair of ids -> rank
    made: list[int]  # rank -> id of the merged pair
    special: dict[str, int]
    pattern: str
    normalizer: Normalizer
    rare: np.ndarray  # for each code point: UNLIKE, OTHER_KIND, both or 0


def load(path: str) -> Vocabulary:
    """Read a tokenizer file on the driver."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    ids, end = model["vocab"], model["end_of_word_suffix"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (max([*ids.values(), *special.values()]) + 1)
    for token, i in [*ids.items(), *special.items()]:
        tokens[i] = token
    ranks, made = {}, []
    for rank, (a, b) in enumerate(model["merges"]):
        ranks[ids[a] << 32 | ids[b]] = rank
        made.append(ids[a + b])
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    pattern = split["pattern"]["Regex"].replace(r"[^\s\p{L}\p{N}]", rf"[^{_WS}\p{{L}}\p{{N}}]")
    symbols = byte_symbols()
    inner, final = [ids[s] for s in symbols], [ids[s + end] for s in symbols]
    return Vocabulary(tokens, inner, final, ranks, made, special, pattern, *_normalizer(path))


def _merge_short(parts: list[int], v: Vocabulary) -> list[int]:
    get = v.ranks.get
    ranks = [get(a << 32 | b, _NO_RANK) for a, b in zip(parts, parts[1:])]
    while ranks:
        least = min(ranks)
        if least == _NO_RANK:
            break
        i = ranks.index(least)
        parts[i] = v.made[least]
        del parts[i + 1], ranks[i]
        if i < len(ranks):
            ranks[i] = get(parts[i] << 32 | parts[i + 1], _NO_RANK)
        if i:
            ranks[i - 1] = get(parts[i - 1] << 32 | parts[i], _NO_RANK)
    return parts


def _merge_long(parts: list[int], v: Vocabulary) -> list[int]:
    n = len(parts)
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    get = v.ranks.get
    heap = [(r, i) for i in range(n - 1) if (r := get(parts[i] << 32 | parts[i + 1], -1)) >= 0]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i] if parts[i] >= 0 else -1
        if j < 0 or get(parts[i] << 32 | parts[j], -1) != rank:
            continue
        parts[i], parts[j] = v.made[rank], -1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] >= 0 and (r := get(parts[a] << 32 | parts[after[a]], -1)) >= 0:
                heapq.heappush(heap, (r, a))
    return [p for p in parts if p >= 0]


def encode_word(word: str, v: Vocabulary) -> list[int]:
    """Ids of one pre-token."""
    data = word.encode("utf-8", "surrogatepass")
    parts = [v.inner[b] for b in data[:-1]] + [v.final[data[-1]]]
    return _merge_short(parts, v) if len(parts) <= SHORT else _merge_long(parts, v)


@lru_cache
def _normalizer(path: str) -> tuple[Normalizer, np.ndarray]:
    """The file's normaliser, and where it or the pattern differs from Python's data."""
    normalizer = Tokenizer.from_file(path).normalizer
    every = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000]
    every = [c for c in every if not c.isspace()]
    # A mark whose class only one side knows moves on that side: before a mark of class 1
    # or, being of class 1 itself, before one of class 220.
    marks = [c for c in every if unicodedata.combining(c)]
    pairs = [p.split() for c in every if len(p := unicodedata.decomposition(c)) and p[0] != "<"]
    pairs = [(chr(int(p[0], 16)), chr(int(p[1], 16))) for p in pairs if len(p) == 2]
    probes = [(c, c) for c in every]
    probes += [(c, c + "\u0335") for c in marks] + [(c, "\u0324" + c) for c in marks]
    probes += [(b, a + b) for a, b in pairs]
    # Nothing composes with a zero.
    text = "0".join(p for _, p in probes)
    own, theirs = _normal(text).split("0"), normalizer.normalize_str(text).split("0")
    rare = np.zeros(0x110000, dtype=np.uint8)
    rare[[ord(c) for (c, _), a, b in zip(probes, own, theirs, strict=True) if a != b]] |= UNLIKE
    rare[[ord(c) for c in re.findall(f"[{NEWER}]", "".join(every))]] |= OTHER_KIND
    return normalizer, rare


def _normal(text: str) -> str:
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    # Letter by letter: a capital sigma has no final form.
    return text.replace("Σ", "σ").lower()


class Encoder:
    """Encodes whole texts; remembers short words it has met, up to ``CACHE`` characters with their results."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self._plain = regex.compile(vocabulary.pattern).findall
        exact = vocabulary.pattern.replace(rf"[^{_WS}\p{{L}}\p{{N}}]", rf"(?:[^{_WS}\p{{L}}\p{{N}}]|[{NEWER}])")
        exact = exact.replace(r"[\p{L}]+", rf"(?:(?![{NEWER}])\p{{L}})+").replace(r"[\p{N}]", rf"(?:(?![{NEWER}])\p{{N}})")
        self._exact = regex.compile(exact).findall
        names = sorted(vocabulary.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self._known: dict[str, tuple[int, str, str]] = {}
        self._held = 0

    def _rare(self, text: str) -> int:
        """Which of UNLIKE and OTHER_KIND some character of ``text`` has."""
        found = 0
        if not text.isascii():
            for start in range(0, len(text), 1 << 20):
                points = np.frombuffer(text[start : start + (1 << 20)].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                found |= int(np.bitwise_or.reduce(self.v.rare[points]))
        return found

    def _words(self, text: str) -> list[str]:
        rare = self._rare(text)
        if not rare:
            return self._plain(_normal(text))
        return self._exact(self.v.normalizer.normalize_str(text) if rare & UNLIKE else _normal(text))

    def _segments(self, text: str) -> Iterator[tuple[str, bool]]:
        if self._special is None or not any(s in text for s in self.v.special):
            yield text, False
            return
        for part in self._special.split(text):
            yield part, part in self.v.special

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        for part, special in self._segments(text or ""):
            if special:
                ids.append(self.v.special[part])
            else:
                for word in self._words(part):
                    ids.extend(encode_word(word, self.v))
        return ids

    def _word(self, word: str) -> tuple[int, str, str]:
        ids = encode_word(word, self.v)
        return len(ids), " ".join(map(str, ids)), decode(ids, self.v)

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of tokens, and SHA-256 of the ids in decimal and of the decoded text.

        Both strings are made word by word, as both are joined by single spaces.
        """
        n, ids, decoded = 0, [], []
        known = self._known
        for part, special in self._segments(text or ""):
            if special:
                found = [(1, str(self.v.special[part]), part)]
            else:
                found = []
                for word in self._words(part):
                    item = known.get(word)
                    if item is None:
                        item = self._word(word)
                        if len(word) <= SHORT:
                            # What Python needs for an entry besides its characters counts as 400.
                            self._held += 400 + 2 * len(word) + len(item[1]) + len(item[2])
                            if self._held > CACHE:
                                known.clear()
                                self._held = 0
                            known[word] = item
                    found.append(item)
            n += sum(x[0] for x in found)
            ids.extend(x[1] for x in found)
            decoded.extend(x[2] for x in found)
        sha = lambda parts: hashlib.sha256(" ".join(parts).encode("utf-8", "surrogatepass")).hexdigest()
        return n, sha(ids), sha(decoded)


def decode(ids: list[int], v: Vocabulary) -> str:
    """The tokens' strings, special ones included, joined by spaces."""
    return " ".join(v.tokens[i] for i in ids)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with ``ids``, array<int>; a column of this name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = boxed(docs, keep, text=quoted(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            ids = pa.array([encoder.encode(t) for t in batch.column("text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), ids], names=["row", "ids"])

    made = rows.mapInArrow(run, rows.select("row").schema.add("ids", ArrayType(IntegerType())))
    return unboxed(made, keep, ("ids",))


def decode_rows(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``rows`` with the array column ``ids`` and, added, ``decoded``."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    boxes = boxed(rows, ids=quoted(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            texts = pa.array([decode(x or [], v) for x in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), texts], names=["row", "decoded"])

    made = boxes.mapInArrow(run, boxes.select("row").schema.add("decoded", "string"))
    return unboxed(made, rows.columns, ("decoded",))


def digests(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with n_tokens, ids_sha256 and decoded_sha256 of the whole text; columns of these names are replaced."""
    made = ("n_tokens", "ids_sha256", "decoded_sha256")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = boxed(docs, keep, text=quoted(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            found = [encoder.digests(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([x[k] for x in found], pa.int64() if k == 0 else pa.string()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], names=["row", *made])

    schema = rows.select("row").schema
    for name, kind in zip(made, ("long", "string", "string")):
        schema = schema.add(name, kind)
    return unboxed(rows.mapInArrow(run, schema), keep, made)
