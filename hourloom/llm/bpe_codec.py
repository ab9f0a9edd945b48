"""Byte-level BPE encoding and decoding by monoid tree reduction.

The encodings of byte strings form a monoid under "encode the concatenation". A piece is encoded
by encoding its halves and joining the two results. A join re-encodes a window around the border
and grows it until the tokens outside provably stay: an encoding is the right one exactly if each
pair of adjacent tokens, taken alone, encodes to that pair, so a join is done as soon as the pairs
at both rims of the window pass that test (pairs inside come from a real encoding, pairs outside
held before). Decoding concatenates byte strings up a tree in the same way.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import portions, text_of

#: Pieces that one Python worker remembers before it starts anew, and the longest one remembered.
REMEMBERED = 150_000
REMEMBER_CHARS = 64
#: Bytes up to which a string is merged directly, as a leaf of the tree.
LEAF = 24
#: Tokens joined at once at a leaf of the decoding tree.
DECODE_LEAF = 4096


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec:
    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.token_bytes = {rank: token for token, rank in self.ranks.items()}
        # \s of the pattern is the Unicode white-space property
        self.find = regex.compile(unicode_space(pattern)).findall
        self.packed: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def leaf(self, data: bytes) -> list[int]:
        """Merge the adjacent pair of lowest rank, leftmost first, until none has a rank."""
        rank = self.ranks.get(data)
        if rank is not None:
            return [rank]
        ranks = self.ranks
        parts = [data[i:i + 1] for i in range(len(data))]
        found = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, r in enumerate(found):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return [ranks[p] for p in parts]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            if at:
                found[at - 1] = ranks.get(parts[at - 1] + parts[at])
            if at < len(found):
                found[at] = ranks.get(parts[at] + parts[at + 1])

    def stays(self, a: int, b: int) -> bool:
        """Whether two tokens side by side encode to themselves."""
        key = (a, b)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            known = self.leaf(self.token_bytes[a] + self.token_bytes[b]) == [a, b]
            self.pairs[key] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the concatenation of two encoded strings."""
        if not left or not right:
            return left + right
        if self.stays(left[-1], right[0]):
            return left + right
        back = ahead = 1
        while True:
            inner = b"".join(map(self.token_bytes.__getitem__, left[len(left) - back:] + right[:ahead]))
            window = self.leaf(inner)
            grow_left = back < len(left) and not self.stays(left[-back - 1], window[0])
            grow_right = ahead < len(right) and not self.stays(window[-1], right[ahead])
            if not grow_left and not grow_right:
                return left[:len(left) - back] + window + right[ahead:]
            if grow_left:
                back = min(len(left), 2 * back)
            if grow_right:
                ahead = min(len(right), 2 * ahead)

    def encode_piece(self, data: bytes) -> list[int]:
        """Tokens of one match of the pattern, halves first."""
        if len(data) <= LEAF:
            return self.leaf(data)
        middle = len(data) // 2
        return self.join(self.encode_piece(data[:middle]), self.encode_piece(data[middle:]))

    def pack(self, piece: str) -> bytes:
        ids = np.array(self.encode_piece(piece.encode()), "<u4").tobytes()
        if len(piece) <= REMEMBER_CHARS:
            if len(self.packed) >= REMEMBERED:
                self.packed.clear()
            self.packed[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        known, pack = self.packed.get, self.pack
        return b"".join([known(p) or pack(p) for p in self.find(text)])

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of an id array: halves decoded and concatenated."""
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.token_bytes.__getitem__, ids.tolist()))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def unicode_space(pattern: str) -> str:
    r"""``\s`` and ``\S`` written as the Unicode white-space property."""
    return pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(
        r"\S", r"\P{White_Space}")


_LOADED: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec for a rank file; it outlives a task."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Codec(path, pattern)
    return _LOADED[path, pattern]


def encode_documents(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_tokens, ids (little-endian uint32 as binary).

    ``ranks`` is the path of a rank file present on every executor; each match of ``pattern`` is
    encoded separately and no special token is added. A null text is empty (no ids); a null id
    stays null; repeated rows give repeated results; other columns are left out; an empty table
    gives no rows. Row-local: no shuffle, a lost task only encodes its own split again.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for batch in portions(batches, 1):
            packed = [c.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary())],
                ["id", "n_tokens", "ids"])

    out = rows.mapInArrow(run, "id long, n_tokens long, ids binary")
    return out.select(F.col("id").alias(id_col), "n_tokens", "ids")


def decode_documents(encoded: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """``encoded`` with the column ``decoded`` (bytes) added; null ids arrays decode to nothing."""
    rows = encoded.select(F.col(id_col).alias("id"), "n_tokens", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for batch in portions(batches, 2):
            out = [c.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             ["id", "n_tokens", "ids", "decoded"])

    out = rows.mapInArrow(run, "id long, n_tokens long, ids binary, decoded binary")
    return out.withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_tokens, ids and decoded of every row: :func:`encode_documents` and then
    :func:`decode_documents`, in the same Python worker."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for batch in portions(batches, 1):
            packed = [c.encode(t) for t in batch.column(1).to_pylist()]
            decoded = [c.decode(np.frombuffer(x, "<u4")) for x in packed]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary()),
                 pa.array(decoded, pa.binary())], ["id", "n_tokens", "ids", "decoded"])

    out = rows.mapInArrow(run, "id long, n_tokens long, ids binary, decoded binary")
    return out.withColumnRenamed("id", id_col)


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, n_tokens, ids_sha256, decoded_sha256 of a decoded table."""
    return decoded.select(id_col, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
