"""Encoding a corpus with a public byte-level BPE vocabulary (problem 8).

For every prefix of a piece there is exactly one token that can end its
encoding: the one that forms a valid pair with the last token of the prefix
before it. Storing that token for each prefix (``last``) makes encoding a
linear walk, lets text be appended without encoding it again, and lets an edit
be encoded again from the piece it touches only.
"""

from __future__ import annotations

import base64
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from ..session import ship

FOLDER = os.environ.get("TIDEMARK_TOKENIZERS", "/opt/tokenizers")
#: Pieces and pairs whose results a worker remembers; past that it forgets them all and computes them again.
MEMO_PIECES, MEMO_PAIRS = 300_000, 1_000_000


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=1)
def pieces_pattern() -> re.Pattern:
    """The vocabulary's splitting rule, with the letter and number classes spelt out from Unicode's categories."""

    def cls(kind: str) -> str:
        out, start, prev = [], None, None
        for i in range(sys.maxunicode + 2):
            on = i <= sys.maxunicode and unicodedata.category(chr(i))[0] == kind
            if on and start is None:
                start = i
            elif not on and start is not None:
                out.append(f"{re.escape(chr(start))}-{re.escape(chr(prev))}")
                start = None
            prev = i
        return "".join(out)

    letter, number = cls("L"), cls("N")
    # white space as Unicode's White_Space property has it: unlike \s of this library, without the separators U+001C-1F
    space = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
    return re.compile(rf"'(?:[sdmt]|ll|ve|re)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


class PrefixEncoder:
    """Byte-pair encoding of one piece by prefix dynamic programming."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.longest = ranks, max(map(len, ranks))
        self.words = {v: k for k, v in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}

    def _merge(self, data: bytes) -> list[int]:
        """Plain merging, for strings of two tokens only."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i))
            if (both := parts[best] + parts[best + 1]) not in self.ranks:
                break
            parts[best : best + 2] = [both]
        return [self.ranks[p] for p in parts]

    def valid(self, a: int, b: int) -> bool:
        """Whether the two tokens, put together, are encoded as these two."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._merge(self.words[a] + self.words[b]) == [a, b]
        return known

    def extend(self, data: bytes, last: array, start: int) -> array:
        """Fill `last` for the prefixes that end past `start`; last[i] belongs to data[: i + 1]."""
        ranks, longest = self.ranks, self.longest
        for end in range(start + 1, len(data) + 1):
            for at in range(max(0, end - longest), end):
                token = ranks.get(data[at:end])
                if token is not None and (at == 0 or self.valid(last[at - 1], token)):
                    last.append(token)
                    break
        return last

    def walk(self, last: array) -> list[int]:
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.words[out[-1]])
        return out[::-1]

    def encode(self, data: bytes) -> list[int]:
        token = self.ranks.get(data)
        return [token] if token is not None else self.walk(self.extend(data, array("i"), 0))


class _Memo(dict):
    """piece -> its ids as 32-bit numbers in bytes."""

    def __init__(self, encoder: PrefixEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMO_PIECES:
            self.clear()
        value = array("i", self.encoder.encode(piece.encode("utf-8", "replace"))).tobytes()
        if len(piece) <= 64:
            self[piece] = value
        return value


@lru_cache(maxsize=2)
def _memo(path: str) -> _Memo:
    return _Memo(PrefixEncoder(load_ranks(path)))


def encode_text(text: str | None, path: str) -> bytes:
    """Ids of a text as 32-bit numbers in bytes; null and empty texts have none."""
    return b"".join(map(_memo(path).__getitem__, pieces_pattern().findall(text))) if text else b""


class EncodedText:
    """A text with its ids, to which more can be appended or in which a span can be replaced.

    Only the pieces an edit can touch are encoded again. A piece looks at most
    one character ahead, so pieces that end two before an edit stay. Of the
    final piece the last token of every prefix is kept: as long as an append
    only makes it longer, its encoding goes on where it stopped.
    """

    def __init__(self, text: str, path: str):
        self.path, self.text = path, ""
        self.cuts: list[tuple[int, int]] = []  # (start in the text, number of ids before) of each piece
        self.ids: list[int] = []
        self.open: tuple[bytes, array] | None = None  # bytes of the final piece and its last tokens, once it has been appended to
        self.extended = 0  # bytes of prefixes that appends have not had to encode again
        self._encode_from(0, text)

    def _encode_from(self, at: int, tail: str) -> None:
        """Keep what is before `at` (a piece's start) and encode `tail` after it."""
        while self.cuts and self.cuts[-1][0] >= at:
            del self.ids[self.cuts.pop()[1] :]
        self.text, self.open = self.text[:at] + tail, None
        for m in pieces_pattern().finditer(self.text, at):
            self.cuts.append((m.start(), len(self.ids)))
            self.ids.extend(array("i", _memo(self.path)[m.group()]))

    def append(self, more: str) -> EncodedText:
        if not self.cuts or not more:
            return self.replace(len(self.text), len(self.text), more)
        start, before = self.cuts[-1]
        whole = self.text + more
        # the pieces before may look as far as into the final one ('ll, say), so their split is looked at again
        at, m = self.cuts[-3:][0][0], None
        for want, _ in self.cuts[-3:]:
            m = pieces_pattern().match(whole, at)
            if m is None or m.start() != want:
                break
            at = m.end()
        if m is None or m.start() != start or m.end() < len(self.text):  # another split, or the final piece ends sooner now
            return self.replace(len(self.text), len(self.text), more)
        encoder, data = _memo(self.path).encoder, m.group().encode("utf-8", "replace")
        old, last = self.open or (self.text[start:].encode("utf-8", "replace"), array("i"))
        if not data.startswith(old):
            return self.replace(len(self.text), len(self.text), more)
        self.extended += len(last)
        last = encoder.extend(data, last, len(last))
        del self.ids[before:]
        token = encoder.ranks.get(data)
        self.ids.extend([token] if token is not None else encoder.walk(last))
        self.text, self.open = whole[: m.end()], (data, last)
        if m.end() < len(whole):
            self._encode_from(m.end(), whole[m.end() :])
        return self

    def replace(self, start: int, end: int, by: str) -> EncodedText:
        """Replace text[start:end]; pieces from two before the edit on are split again, as a piece looks at most one character ahead."""
        rest = by + self.text[end:]
        before = [c for c, _ in self.cuts if c < start][-2:]
        at = before[0] if before else 0
        self._encode_from(at, self.text[at:start] + rest)
        return self


def _send(spark: SparkSession, vocabulary: str) -> str:
    """Give the vocabulary to the executors, from the driver's folder or any file system; workers need no folder of their own. Returns its name there."""
    spark.sparkContext.addFile(f"{FOLDER.rstrip('/')}/{vocabulary}")
    return vocabulary.rpartition("/")[2]


def _batches(name: str, key: str, text: str, counts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = SparkFiles.get(name)
        for batch in batches:
            coded = [encode_text(t, path) for t in batch.column(text).to_pylist()]
            sizes = np.fromiter((len(c) >> 2 for c in coded), np.int64, len(coded))
            if counts:
                yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(sizes.astype(np.int32))], [key, "n_tokens"])
            else:
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(key), ids], [key, "ids"])

    return run


def encode_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(key, ids) of every row. Null and empty texts have an empty list; blank ones are encoded like any other. Repeated rows stay."""
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(_batches(_send(docs.sparkSession, vocabulary), key, text, False), f"`{key}` {kind}, ids array<int>")


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(key, n_tokens) of every row."""
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(_batches(_send(docs.sparkSession, vocabulary), key, text, True), f"`{key}` {kind}, n_tokens int")
