"""Benchmark decontamination by spaced-seed hashing.

A mask is a fixed pattern of word positions, some of them ignored. Each position of a test item and
of a training document gives one hash per mask of the words at the mask's kept positions, so two
texts that differ by a substituted word still share hashes under masks that ignore its place.
Test and training hashes are joined; each hit fixes an alignment of item and document, and along
it the words are compared: each longest stretch with ``PENALTY`` matches or more per substitution
is an overlap.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import mix64, portions, release, staged, text_of, utf8_buffer, word_hashes, word_spans

#: Kept (1) and ignored (0) word positions. The masks of eleven words each keep their first and last
#: word, and each word between is ignored by at least one. The short ones fit between changes that lie
#: closer together: with any one of eleven words changed, or any two of fifteen, some mask fits.
MASKS = ("11101100111", "11011011011", "10111110101", "11110011101", "1101011", "111111")
#: An overlap has at least so many words, or four fifths of its item's.
LEAST_WORDS = 10
#: A substitution costs as much as so many matches: at least four of five words agree.
PENALTY = 4
#: A document with so many agreeing words in one overlap is contaminated, whatever the item's length.
LONG_WORDS = 25
#: Beside a hit's alignment, those up to so many words away are read too: inserted or left out words
#: move the rest of an item, which may be too short for a hit of its own.
SHIFT = 5
#: Shorter stretches are not counted toward an item's words.
RUN = 3
#: Slots (as powers of two) of the filter that test hashes are entered in: eight a hash, from 1 MB to 16 MB
#: for both halves. Beyond that more documents are candidates and the join finds the same.
FILTER_BITS = (22, 26)
#: Rows that the items of one document are dealt to; each has the document's text.
ITEM_ROWS = 16
#: Words compared at once in a block of alignments.
BLOCK_WORDS = 1 << 22

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_FOLD[[b for b in range(0x80) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)]] = 0x20


def folded(column: pa.Array):
    """Word hashes, spans and bytes of a text column: A-Z lower-cased, ASCII punctuation as space."""
    raw, offsets = utf8_buffer(column)
    raw = _FOLD[raw]
    starts, ends, first = word_spans(raw, offsets)
    return raw, starts, ends, first, word_hashes(raw, starts, ends)


def seeds(h: np.ndarray, first: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Start words and hashes of all places where ``mask`` fits into one row."""
    span = len(mask)
    n = len(h) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    rolled = np.full(n, zlib.crc32(mask.encode()), np.uint64)
    for j, kept in enumerate(mask):
        if kept == "1":
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n]
    left = np.repeat(first[1:], np.diff(first))[:n] - np.arange(n)  # words to the end of the row
    at = np.flatnonzero(left >= span)
    return at, mix64(rolled[at])


def own_masks(n: int) -> tuple[str, ...]:
    """Masks of items of ``n`` words: all words, and from five words on, when one of them may differ,
    some that together ignore each word: one word each of five, up to two of more."""
    step = n if n < 6 else (n + 1) // 2
    spaced = ["".join("0" if j % step == i else "1" for j in range(n)) for i in range(step)] if n > 4 else []
    return ("1" * n, *spaced)


def item_seeds(items: DataFrame, masks: tuple[str, ...], own: tuple[str, ...]) -> DataFrame:
    """(h, item, tpos) of every test item under every mask, those of ``own`` only over whole items;
    ``items`` has (item, t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, _, first, h = folded(batch.column(1))
            item = batch.column(0).to_numpy(zero_copy_only=False)
            words = np.diff(first)
            for mask in dict.fromkeys((*masks, *own)):
                at, hashed = seeds(h, first, mask)
                row = np.searchsorted(first, at, side="right") - 1
                if mask not in masks:
                    short = words[row] == len(mask)
                    at, hashed, row = at[short], hashed[short], row[short]
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashed.view(np.int64)), pa.array(item[row]),
                         pa.array((at - first[row]).astype(np.int32))], ["h", "item", "tpos"])

    return items.mapInArrow(run, "h long, item long, tpos int")


def short_masks(items: DataFrame, masks: tuple[str, ...]) -> tuple[str, ...]:
    """The own masks of each word count below the masks' longest span that an item has."""
    span = max(map(len, masks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, _, first, _ = folded(batch.column(1))
            n = np.unique(np.diff(first))
            yield pa.RecordBatch.from_arrays([pa.array(n[n < span].astype(np.int32))], ["n"])

    found = items.mapInArrow(run, "n int").where("n > 0").distinct().collect()  # fewer rows than the span
    return tuple(m for r in sorted(found) for m in own_masks(r["n"]))


def candidates(docs: DataFrame, masks: tuple[str, ...], test: DataFrame) -> DataFrame:
    """(k, id, t, hits): the documents with a hash whose slots test hashes have, and those hashes, each
    once. ``docs`` has (k, id, t)."""
    sc = docs.sparkSession.sparkContext
    bits = min(max(FILTER_BITS[0], (8 * max(test.count(), 1) - 1).bit_length()), FILTER_BITS[1])
    marks = []
    for expr in (F.shiftrightunsigned("h", 64 - bits), F.col("h").bitwiseAND(F.lit((1 << bits) - 1))):
        filled = np.zeros(1 << bits, bool)
        got = test.select(expr.cast("int").alias("s")).distinct().toPandas()["s"]  # at most 2 ** bits
        filled[got.to_numpy(np.int64)] = True
        marks.append(np.packbits(filled).tobytes())
    sent = sc.broadcast(zlib.compress(b"".join(marks), 1))  # at most 16 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.unpackbits(np.frombuffer(zlib.decompress(sent.value), np.uint8)).reshape(2, -1).astype(bool)
        for batch in portions(batches, 2):
            _, _, _, first, h = folded(batch.column(2))
            rows, hashes = [], []
            for mask in masks:
                at, hashed = seeds(h, first, mask)
                near = both[0][(hashed >> np.uint64(64 - bits)).astype(np.int64)]
                at, hashed = at[near], hashed[near]
                near = both[1][(hashed & np.uint64((1 << bits) - 1)).astype(np.int64)]
                rows.append(np.searchsorted(first, at[near], side="right") - 1)
                hashes.append(hashed[near])
            row, hashed = np.concatenate(rows), np.concatenate(hashes)
            if not len(row):
                continue
            order = np.lexsort((hashed, row))
            row, hashed = row[order], hashed[order]
            new = np.concatenate([[True], (row[1:] != row[:-1]) | (hashed[1:] != hashed[:-1])])
            row, hashed = row[new], hashed[new]
            which, begin = np.unique(row, return_index=True)
            hits = pa.ListArray.from_arrays(pa.array(np.append(begin, len(row)).astype(np.int32)), pa.array(hashed.view(np.int64)))
            part = batch.take(pa.array(which))
            yield pa.RecordBatch.from_arrays([*part.columns, hits], ["k", "id", "t", "hits"])

    return docs.mapInArrow(run, "k long, id long, t string, hits array<long>")


def best_overlap(same: np.ndarray, penalty: int = PENALTY) -> tuple[int, int, int]:
    """(from, to, matches) of the stretch of ``same`` whose matches less ``penalty`` per mismatch
    are most; of equal ones the longest, of these the earliest."""
    gain = np.concatenate([[0], np.cumsum(np.where(same, 1, -penalty))])
    low = np.minimum.accumulate(gain)
    most = (gain - low).max()
    if most <= 0:
        return 0, 0, 0
    ends = np.flatnonzero(gain - low == most)
    starts = np.searchsorted(-low, -low[ends])
    longest = int(np.argmax(ends - starts))
    start, end = int(starts[longest]), int(ends[longest])
    return start, end, int(same[start:end].sum())


def stretches(same: np.ndarray, penalty: int = PENALTY) -> list[tuple[int, int, int]]:
    """(from, to, matches) of every stretch of ``same`` that begins and ends with a match, has at
    least ``penalty`` matches per mismatch and is no part of a longer such stretch. They may overlap."""
    starts = np.flatnonzero(same)
    if not len(starts):
        return []
    gain = np.concatenate([[0], np.cumsum(np.where(same, 1, -penalty))])
    ends = starts + 1
    at = gain[starts]
    # whatever an earlier start with no larger sum before it reaches is longer
    new = np.concatenate([[True], at[1:] < np.minimum.accumulate(at)[:-1]])
    starts, at = starts[new], at[new]
    most_left = np.maximum.accumulate(gain[ends][::-1])  # from the last end on
    stops = ends[len(ends) - np.searchsorted(most_left, at) - 1]
    further = np.concatenate([[True], stops[1:] > stops[:-1]])
    matches = np.concatenate([[0], np.cumsum(same)])
    return [(a, b, int(matches[b] - matches[a])) for a, b in zip(starts[further].tolist(), stops[further].tolist())]


class Words:
    """Folded words of one text: as numbers that are equal where the words are, and as hashes."""

    def __init__(self, text: str, numbers: dict[bytes, int]):
        words = text.encode().translate(bytes(_FOLD)).split()
        self.ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
        _, _, _, self.first, self.hashes = folded(pa.array([text]))
        self.by_mask: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def seeds(self, mask: str) -> tuple[np.ndarray, np.ndarray]:
        """Start words and hashes under ``mask``, ordered by hash."""
        if mask not in self.by_mask:
            at, hashed = seeds(self.hashes, self.first, mask)
            order = np.argsort(hashed, kind="stable")
            self.by_mask[mask] = at[order], hashed[order]
        return self.by_mask[mask]


def diagonals(doc: Words, item: Words, masks: tuple[str, ...], own: tuple[str, ...]) -> np.ndarray:
    """The alignments (first word of the item in the document, also below 0) that a shared hash fixes."""
    n = len(item.ids)
    met = np.zeros(len(doc.ids) + n + 1, bool)
    for mask in dict.fromkeys((*masks, *(m for m in own if len(m) == n))):
        at, hashed = doc.seeds(mask)
        places, wanted = item.seeds(mask)
        low, high = np.searchsorted(hashed, wanted, "left"), np.searchsorted(hashed, wanted, "right")
        for i in np.flatnonzero(high > low).tolist():
            met[at[low[i]:high[i]] - places[i] + n] = True
    return np.flatnonzero(met) - n


def agreements(doc: Words, item: Words, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(which words of the item agree, the alignments of ``at`` where just these do), each pattern once."""
    n = len(item.ids)
    if not n or not len(at):
        return []
    padded = np.concatenate([np.full(n, -1), doc.ids, np.full(n, -1)])
    found: dict[bytes, list[np.ndarray]] = {}
    step = max(1, BLOCK_WORDS // n)
    for a in range(0, len(at), step):
        some = at[a:a + step]
        same = np.lib.stride_tricks.sliding_window_view(padded, n)[some + n] == item.ids
        packed = np.packbits(same, axis=1)
        as_one = np.ascontiguousarray(packed).view(f"V{packed.shape[1]}").ravel()
        kinds, which = np.unique(as_one, return_inverse=True)
        order = np.argsort(which, kind="stable")
        for kind, mine in zip(kinds, np.split(some[order], np.cumsum(np.bincount(which))[:-1])):
            found.setdefault(kind.tobytes(), []).append(mine)
    return [(np.unpackbits(np.frombuffer(k, np.uint8), count=n).astype(bool), np.concatenate(v)) for k, v in found.items()]


def runs(at: np.ndarray) -> list[tuple[int, int]]:
    """(first, length) of each run of neighbouring numbers."""
    at = np.sort(at)
    begin = np.flatnonzero(np.concatenate([[True], np.diff(at) != 1]))
    return list(zip(at[begin].tolist(), np.diff(np.append(begin, len(at))).tolist()))


def holds_item(doc: Words, item: Words, at: np.ndarray, share: float, long_words: int) -> bool:
    """Whether agreeing words on the alignments and those up to ``SHIFT`` words beside them make up
    ``share`` of the item's words, each counted once, or ``long_words`` in one stretch. Stretches of less
    than ``RUN`` words do not count."""
    n = len(item.ids)
    held = np.zeros(n, bool)
    near = np.unique((at[:, None] + np.arange(-SHIFT, SHIFT + 1)).ravel())
    near = near[(near > -n) & (near < len(doc.ids))]
    for some in (at, np.setdiff1d(near, at)):
        for same, _ in agreements(doc, item, some):
            for a, b, matched in stretches(same):
                if matched >= long_words:
                    return True
                if b - a >= min(RUN, n):
                    held[a:b] |= same[a:b]
        if held.sum() >= share * n - 1e-9:
            return n > 0
    return False


def aligned(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...], id_col: str, text_col: str, item_col: str,
            item_text_col: str) -> tuple[DataFrame, tuple[str, ...]]:
    """(k, id, t, found) of the documents that share a hash with an item, and the items' own masks; ``found``
    has item_id and t of each item, whose alignments :func:`diagonals` gives. The items of a document are
    dealt to at most ``ITEM_ROWS`` rows, each with its text."""
    spark = docs.sparkSession
    items = staged(benchmark.select(F.xxhash64(F.col(item_col).cast("long"), text_of(item_text_col)).alias("item"),
                                    text_of(item_text_col).alias("t"), F.col(item_col).cast("long").alias("item_id"))
                   .dropDuplicates(["item"]), "items")
    own = short_masks(items.select("item", "t"), masks)
    all_masks = tuple(dict.fromkeys((*masks, *own)))
    test = staged(item_seeds(items.select("item", "t"), masks, own), "seeds")
    text = text_of(text_col)
    rows = docs.select(F.xxhash64(F.col(id_col).cast("long"), text).alias("k"), F.col(id_col).cast("long").alias("id"),
                       text.alias("t"))
    held = staged(candidates(rows, all_masks, test), "candidates")
    release(spark)
    by_hash = test.select("h", "item").distinct()
    met = held.select("k", F.explode("hits").alias("h")).join(by_hash, "h").select("k", "item").distinct()
    found = (met.join(items, "item").groupBy("k", F.pmod("item", F.lit(ITEM_ROWS)).alias("row"))
             .agg(F.collect_list(F.struct("item_id", "t")).alias("found")))
    return held.select("k", "id", "t").dropDuplicates(["k"]).join(found, "k").select("k", "id", "t", "found"), own


def overlaps(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, least_words: int = LEAST_WORDS,
             id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
             item_text_col: str = "text") -> DataFrame:
    """One row per verified overlap of a document and an item: ``id_col``, k (hash of the row's id and
    text), ``item_col``, first_word, last_word (of the document, from 0), n_matched, item_words, n_places.

    An overlap begins and ends with an agreeing word, at least four of five of its words agree, it has
    ``least_words`` words or holds four fifths of the item's, and it is no part of a longer one on its
    alignment. Each alignment gives all of its overlaps; two of them may share words. Where the same words of
    an item agree on ``n_places`` neighbouring alignments (a word that repeats), the row stands for all of
    them: the first, and each next one word further on.

    Words are runs of a-z, 0-9 and non-ASCII bytes after lower-casing A-Z. Null texts have no words
    and never overlap, nor do empty items; items shorter than the masks are also sought by masks of
    their own length, below five words exactly. Null ids stay null. Rows that repeat id and text count once; equal items of different
    id are all reported. Other columns are left out; an empty table on either side gives no rows.
    """
    both, own = aligned(docs, benchmark, masks, id_col, text_col, item_col, item_text_col)
    names = ["id", "k", "item_id", "first_word", "last_word", "n_matched", "item_words", "n_places"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, i, t, found in zip(*(batch.column(c) for c in range(4))):
                numbers: dict[bytes, int] = {}
                doc = Words(t.as_py(), numbers)
                out = []
                for f in found.as_py():
                    item = Words(f["t"], numbers)
                    n = len(item.ids)
                    spans: dict[tuple[int, int, int], list[np.ndarray]] = {}
                    for same, at in agreements(doc, item, diagonals(doc, item, masks, own)):
                        for a, b, matched in stretches(same):
                            # an item's own length counts as long where only its rim disagrees
                            if b - a >= least_words or matched * (PENALTY + 1) >= PENALTY * n:
                                spans.setdefault((a, b, matched), []).append(at)
                    for (a, b, matched), at in spans.items():
                        out += [(i.as_py(), k.as_py(), f["item_id"], d + a, d + b - 1, matched, n, times)
                                for d, times in runs(np.concatenate(at))]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

    done = both.mapInArrow(verify, ", ".join(f"{n} long" for n in names))
    return done.select(F.col("id").alias(id_col), "k", F.col("item_id").alias(item_col), *names[3:])


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = 0.8, masks: tuple[str, ...] = MASKS,
                 long_words: int = LONG_WORDS, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, k) of documents that hold at least ``share`` of an item's words, or ``long_words`` of them
    in one overlap. Words that agree with an item are added up over all its alignments with the
    document, so substituted, inserted and left out words only cost themselves. Texts and words
    are as in :func:`overlaps`."""
    both, own = aligned(docs, benchmark, masks, id_col, text_col, item_col, item_text_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaked = []
            for t, found in zip(batch.column(2), batch.column(3)):
                numbers: dict[bytes, int] = {}
                doc = Words(t.as_py(), numbers)
                items = (Words(x, numbers) for x in sorted({f["t"] for f in found.as_py()}))
                leaked.append(any(holds_item(doc, i, diagonals(doc, i, masks, own), share, long_words) for i in items))
            part = batch.filter(pa.array(leaked, pa.bool_()))
            yield pa.RecordBatch.from_arrays([part.column(1), part.column(0)], ["id", "k"])

    return both.mapInArrow(judge, "id long, k long").select(F.col("id").alias(id_col), "k").distinct()
