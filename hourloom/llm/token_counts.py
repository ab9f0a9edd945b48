"""Token counts by heap-and-linked-list byte-pair merging.

Each pre-token starts as a list of byte symbols linked left and right. A heap holds the adjacent
pairs that have a merge, lowest rank first and leftmost among equals; popping one joins its two
symbols and pushes the pairs with the new neighbours. The count is the initial symbols minus the
merges made. No identifiers are produced.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import portions, text_of

#: Split pattern of the byte-level pre-tokenizer (fixed value of the vocabulary format); white
#: space is the Unicode property.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

#: Counted pre-tokens that one Python worker remembers before it starts anew.
REMEMBERED = 300_000
#: Longer pre-tokens are counted each time: they seldom come again and would fill the memory.
REMEMBER_CHARS = 64


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def merge_ranks(path: str) -> tuple[dict[tuple[int, int], tuple[int, int]], list[int], list[str]]:
    """(left id, right id) -> (rank, joined id); id of each byte; the special strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab = spec["model"]["vocab"]
    ranks = {}
    for rank, pair in enumerate(spec["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        ranks.setdefault((vocab[left], vocab[right]), (rank, vocab[left + right]))
    symbols = byte_symbols()
    specials = [t["content"] for t in spec["added_tokens"]]
    return ranks, [vocab[symbols[b]] for b in range(256)], specials


def count_merged(piece: bytes, ranks: dict, byte_ids: list[int]) -> int:
    """Symbols left of ``piece`` after all merges."""
    symbols = [byte_ids[b] for b in piece]
    n = len(symbols)
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        found = ranks.get((symbols[i], symbols[i + 1]))
        if found:
            heap.append((found[0], i, found[1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = right[i]
        if symbols[i] is None or j >= n:
            continue
        found = ranks.get((symbols[i], symbols[j]))
        if not found or found[1] != joined:
            continue  # one of the two was merged with another neighbour meanwhile
        symbols[i], symbols[j] = joined, None
        k = right[i] = right[j]
        merges += 1
        if k < n:
            left[k] = i
            found = ranks.get((joined, symbols[k]))
            if found:
                heapq.heappush(heap, (found[0], i, found[1]))
        h = left[i]
        if h >= 0:
            found = ranks.get((symbols[h], joined))
            if found:
                heapq.heappush(heap, (found[0], h, found[1]))
    return n - merges


class PieceCounts(dict):
    """Pre-token -> number of tokens, counted at first sight."""

    def __init__(self, path: str):
        super().__init__()
        self.ranks, self.byte_ids, specials = merge_ranks(path)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.find = regex.compile(SPLIT).findall

    def __missing__(self, piece: str) -> int:
        n = count_merged(piece.encode(), self.ranks, self.byte_ids)
        if len(piece) <= REMEMBER_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.find(p))) for p in parts)


_LOADED: dict[str, PieceCounts] = {}


def counter(path: str) -> PieceCounts:
    """The worker's counter for a vocabulary file; it outlives a task."""
    if path not in _LOADED:
        _LOADED[path] = PieceCounts(path)
    return _LOADED[path]


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``vocabulary`` is the path of a byte-level BPE file in JSON form, present on every executor.
    Its special strings inside texts count one token each; no begin or end token is added.
    A null text is empty (0 bytes, 0 tokens); a null id stays null; repeated rows give repeated
    results; other columns, whatever their names, are left out; an empty table gives no rows.
    The work is row-local: no shuffle, and a lost task only recounts its own split.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary).count
        for batch in portions(batches, 1):
            texts = batch.column(1).to_pylist()
            n = pa.array([count(t) for t in texts], pa.int64())
            size = pc.cast(pc.binary_length(batch.column(1)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, n], ["id", "n_bytes", "n_tokens"])

    out = rows.mapInArrow(run, "id long, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
