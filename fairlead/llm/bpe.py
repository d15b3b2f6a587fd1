"""Byte-pair encoding and decoding with a word-end vocabulary file.

A word's symbols form a doubly linked list. A priority queue holds the merges
of neighbours by rank and place; entries whose symbols have changed since are
skipped when popped. Decoding joins the vocabulary strings of the ids.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- Fixed values: how the vocabulary's texts are cut into pieces ---
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
PRINTABLE_BYTES = ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))
# --- End of fixed values ---

#: Words whose ids one worker remembers.
CACHED_WORDS = 200_000
#: Text characters per batch handed back to Spark.
BATCH_CHARS = 1 << 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else one from U+0100 on."""
    printable = {b for low, high in PRINTABLE_BYTES for b in range(low, high + 1)}
    letters, spare = [], 0x100
    for b in range(256):
        if b in printable:
            letters.append(chr(b))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


class Encoder:
    """Encodes and decodes with the vocabulary, merges and special tokens of one file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.merges = {
            (self.ids[a], self.ids[b]): (rank, self.ids[a + b])
            for rank, (a, b) in enumerate(
                m if isinstance(m, list) else m.split(" ") for m in model["merges"]
            )
        }
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.strings = [""] * size
        for string, i in (self.ids | self.special).items():
            self.strings[i] = string
        self.letters = byte_letters()
        self.pieces = regex.compile(PIECES)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile(
            "(" + "|".join(map(regex.escape, longest_first)) + ")"
        ) if self.special else None
        self.known: dict[str, bytes] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Applies merges by rank, leftmost first among equal ranks."""
        n = len(symbols)
        before = list(range(-1, n - 1))
        after = [*range(1, n), -1]
        queue = []

        def offer(left: int) -> None:
            right = after[left] if left >= 0 else -1
            if right >= 0 and (found := self.merges.get((symbols[left], symbols[right]))):
                heapq.heappush(queue, (found[0], left, symbols[left], symbols[right], found[1]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, left, a, b, merged = heapq.heappop(queue)
            right = after[left]
            if right < 0 or symbols[left] != a or symbols[right] != b:
                continue  # stale: one of the two has been merged since
            symbols[left], symbols[right] = merged, -1
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left])
            offer(left)
        return [s for s in symbols if s >= 0]

    def piece_ids(self, piece: str) -> bytes:
        """Packed ids of one piece; remembered."""
        packed = self.known.get(piece)
        if packed is None:
            letters = [self.letters[b] for b in piece.encode("utf-8")]
            letters[-1] += WORD_END
            symbols = self.merge([self.ids[x] for x in letters])
            packed = np.array(symbols, "<u4").tobytes()
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[piece] = packed
        return packed

    def plain(self, text: str) -> bytes:
        # Every letter is lowered on its own: no final sigma.
        lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return b"".join(map(self.piece_ids, self.pieces.findall(lowered)))

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if self.special_pattern is None or "<" not in text:
            return self.plain(text)
        return b"".join(
            np.array([self.special[part]], "<u4").tobytes() if part in self.special else self.plain(part)
            for part in self.special_pattern.split(text)
            if part
        )

    def decode(self, packed: bytes) -> str:
        """Vocabulary strings of the ids with a space between each two."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def slices(batch: pa.RecordBatch, texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text, at least one row each."""
    sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0))])
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(sizes, sizes[start] + most, side="right")) - 1)
        yield start, end
        start = end


def encode_documents(
    docs: DataFrame, path: str, decode: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Ids of every row: doc_id, n_tokens, ids (binary) and, with ``decode``, decoded.

    ``ids`` packs little-endian unsigned 32-bit integers. A null text counts as
    empty and has no ids. ``path`` is a vocabulary file that every executor
    can open. Rows are independent, whole texts are encoded, and output
    batches stay small however long the texts are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            texts = batch.column(1)
            for start, end in slices(batch, texts, BATCH_CHARS):
                packed = [coder.encode(t or "") for t in texts.slice(start, end - start).to_pylist()]
                columns = {
                    "doc_id": batch.column(0).slice(start, end - start),
                    "n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64()),
                    "ids": pa.array(packed, pa.binary()),
                }
                if decode:
                    columns["decoded"] = pa.array(map(coder.decode, packed), pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id bigint, n_tokens bigint, ids binary"
    return slim.mapInArrow(run, schema + ", decoded string" * decode)
