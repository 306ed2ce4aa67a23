"""Fill-in-middle transformation with a Fenwick tree over text blocks.

A text is a sequence of units, runs of A-Z and a-z or single other code points. It is
cut into fixed blocks of its UTF-8 bytes; a Fenwick tree holds how many units begin
and how many code points stand in each block. A cut after a number of units descends
the tree by binary lifting to the block in which the next unit begins and is then
found within that block alone. Two cuts give prefix, middle and suffix, which are
joined in one of two orders with markers between them; some texts stay plain.

Cuts and form are drawn from a hash of seed and id, so that reruns agree. Marks are
made for a stretch of a text at a time; tree and marks are small beside the text.

Defined results: a null text counts as empty; an empty text stays plain, as does one
that holds a marker, which therefore can always be undone. A null id is hashed as an
empty one. Rows equal in id and text get equal results. Columns that carry a name made
here are replaced, all others kept, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, quoted, slices, unboxed

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
JOINED, SUFFIX_FIRST = 90, 20  # per cent of texts that are joined, and of these with the suffix first
BLOCK = 512
STRETCH = BLOCK << 11

MADE = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True


def _marks(data: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the bytes from ``low`` to ``high`` begin a code point, and which a unit."""
    part = data[low:high]
    points = (part & 0xC0) != 0x80
    letters = _LETTER[part]
    after = np.empty_like(letters)
    after[:1] = low > 0 and _LETTER[data[low - 1]]
    after[1:] = letters[:-1]
    return points, points & ~(letters & after)


class UnitTree:
    """Unit and code point counts of a text's blocks, in a Fenwick tree."""

    def __init__(self, text: bytes, block: int = BLOCK) -> None:
        self._data, self._block = np.frombuffer(text, dtype=np.uint8), block
        sums = [np.zeros((2, 1), dtype=np.int64)]
        step = max(STRETCH // block, 1) * block
        for low in range(0, len(text), step):
            points, units = _marks(self._data, low, min(low + step, len(text)))
            starts = np.arange(0, len(points), block)
            sums.append(np.stack([np.add.reduceat(x, starts, dtype=np.int64) for x in (units, points)]))
        before = np.concatenate(sums, axis=1).cumsum(axis=1)
        self.units, self.points = (int(x) for x in before[:, -1])
        # A node holds the blocks from the one after its parent up to its own.
        at = np.arange(before.shape[1])
        self._tree = (before - before[:, at & (at - 1)]).T.tolist()

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the text's first ``units`` units."""
        blocks, at, points, left = len(self._tree) - 1, 0, 0, units
        step = 1 << blocks.bit_length()
        while step := step >> 1:
            if at + step <= blocks and self._tree[at + step][0] <= left:
                at += step
                left -= self._tree[at][0]
                points += self._tree[at][1]
        if at == blocks:
            return len(self._data), points
        low = at * self._block
        point, unit = _marks(self._data, low, min(low + self._block, len(self._data)))
        inside = int(np.flatnonzero(unit)[left])
        return low + inside, points + int(np.count_nonzero(point[:inside]))


def draws(seed: str, doc: int | str | None) -> list[int]:
    """Four numbers of 32 bits for a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def rearrange(text: bytes, doc: int | str | None, seed: str, joined: int = JOINED, suffix_first: int = SUFFIX_FIRST) -> tuple:
    """n, form, code points of prefix and middle (None if plain) and output of one UTF-8 text."""
    tree = UnitTree(text)
    a, b, keep, order = draws(seed, doc)
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    if not text or keep % 100 >= joined or p in text or s in text or m in text:
        return tree.units, PLAIN, None, None, text
    first, second = sorted((a % (tree.units + 1), b % (tree.units + 1)))
    (low, before), (high, until) = tree.cut(first), tree.cut(second)
    spm = order % 100 < suffix_first
    parts = (s, text[high:], p, text[:low], m, text[low:high]) if spm else (p, text[:low], s, text[high:], m, text[low:high])
    return tree.units, SPM if spm else PSM, before, until - before, b"".join(parts)


def transform(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", seed: str = "1", joined: int = JOINED, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """``docs`` with n (units), form, prefix_chars, middle_chars and output."""
    rows = boxed(docs, without=[text], id=quoted(doc).cast("string"), text=quoted(text))
    schema = rows.select("row", "text").schema
    for name, kind in MADE.items():
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()
            for start, stop in slices(texts):
                found = [rearrange(t or b"", i, seed, joined, suffix_first) for i, t in zip(ids[start:stop], texts[start:stop])]
                n, form, before, middle, output = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(start, stop - start) for c in ("row", "text")),
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(before, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.array(output, pa.binary()).view(pa.string()),
                    ],
                    names=["row", "text", *MADE],
                )

    return unboxed(rows.mapInArrow(run, schema), docs.columns, list(MADE), {text: F.col("text")})


def restore(output: Column | str, form: Column | str) -> Column:
    """The text that ``transform`` was given. A joined one holds each marker once."""
    output, form = (F.col(x) if isinstance(x, str) else x for x in (output, form))
    after = lambda mark: F.split_part(output, F.lit(mark), F.lit(2))
    until = lambda part, mark: F.split_part(part, F.lit(mark), F.lit(1))
    middle = after(MIDDLE)
    psm = F.concat(until(after(PREFIX), SUFFIX), middle, until(after(SUFFIX), MIDDLE))
    spm = F.concat(until(after(PREFIX), MIDDLE), middle, until(after(SUFFIX), PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
