"""Substring dedup by repeated-phrase automata.

A window is ``window`` consecutive words of one document. Every word covered by a window whose
word sequence also starts earlier (smaller id, or same id and earlier start) is removed.

1. Anchors. Each window names its least-hashed run of ``gram`` words; equal windows name the same
   one, so only windows whose anchor recurs can recur. Anchor hashes are dealt by hash, after a
   task has reduced its own recurring ones to one row each.
2. Stretches. Documents join their recurring anchors; around each, the windows that name it form a
   stretch of at most ``2 * window - gram`` words. Stretches go to the shard of their anchor. Of
   equal stretches in one task only the earliest goes: the others are repeats already.
3. Automata. A shard confirms which windows recur, compiles them into Aho-Corasick automata over
   words (each word of a chunk is one symbol) and streams all of its stretches through them to
   locate every occurrence; all but the earliest are reported.
4. Documents join the reported spans and leave those words out.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import (fan_out, mix64, portions, release, staged, text_of, utf8_buffer, word_hashes, word_spans)

#: Anchors that occur more often are split: each of their windows goes to a shard of its own.
HOT_ANCHOR = 2_000
#: Stretches that one automaton is compiled from (whole anchors, so up to HOT_ANCHOR more).
CHUNK = 6_000
#: Stretches per shard task.
SHARD_ROWS = 40_000
#: Bytes of text that a task holds at once.
PORTION = 2 << 20
#: Windows whose grams are compared at once.
WINDOWS = 1 << 16
#: Stands for a null id in comparisons: such documents come last.
LAST = (1 << 63) - 1


def anchors(raw: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """Word spans, first word of each row, start words of all windows, and for each window the
    word at which its anchor starts with the anchor's hash."""
    starts, ends, first = word_spans(raw, offsets)
    n = len(starts)
    none = np.zeros(0, np.int64)
    if n < window:
        return starts, ends, first, none, none, none.view(np.uint64)
    h = word_hashes(raw, starts, ends)
    rolled = np.zeros(n - gram + 1, np.uint64)
    for j in range(gram):
        rolled = rolled * np.uint64(0x100000001B3) + h[j:n - gram + 1 + j]
    rolled = mix64(rolled)
    span = window - gram + 1
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(row[:n - window + 1] == row[window - 1:])
    if not len(at):
        return starts, ends, first, none, none, none.view(np.uint64)
    view = np.lib.stride_tricks.sliding_window_view(rolled, span)
    anchor = np.concatenate([at[i:i + WINDOWS] + view[at[i:i + WINDOWS]].argmin(axis=1)
                             for i in range(0, len(at), WINDOWS)])
    return starts, ends, first, at, anchor, rolled[anchor]


def recurring_anchors(rows: DataFrame, window: int, gram: int, tasks: int) -> DataFrame:
    """(k, pos, h): where anchors that occur at least twice start; and (null, n, h) for each anchor
    with more than HOT_ANCHOR occurrences."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 2, PORTION):
            raw, offsets = utf8_buffer(batch.column(2))
            _, _, first, at, anchor, h = anchors(raw, offsets, window, gram)
            if not len(at):
                continue
            new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
            anchor, h = anchor[new], h[new]
            order = np.argsort(h, kind="stable")
            anchor, h = anchor[order], h[order]
            lead = np.concatenate([[True], h[1:] != h[:-1]])
            n = np.diff(np.append(np.flatnonzero(lead), len(h)))
            count = np.zeros(len(h), np.int32)
            count[lead] = n  # 0: a further occurrence of an anchor that this task knows to recur
            row = np.searchsorted(first, anchor, side="right") - 1
            k = batch.column(0).to_numpy(zero_copy_only=False)[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(k), pa.array((anchor - first[row]).astype(np.int32)), pa.array(h.view(np.int64)),
                 pa.array(count)], ["k", "pos", "h", "n"])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows sorted by anchor: those of anchors seen at least twice. One row is carried over."""
        def out(k, pos, h):
            return pa.RecordBatch.from_arrays(
                [pa.array(k, pa.int64()), pa.array(pos, pa.int32()), pa.array(h, pa.int64())], ["k", "pos", "h"])

        held = None  # (k, pos, h, occurrences so far, whether it was given out)
        for batch in batches:
            k, pos, h, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            known = n == 0
            if known.any():
                yield out(k[known], pos[known], h[known])
                k, pos, h, n = k[~known], pos[~known], h[~known], n[~known]
            if not len(h):
                continue
            edge = np.flatnonzero(h[1:] != h[:-1]) + 1
            begin = np.concatenate([[0], edge])
            total = np.add.reduceat(n.astype(np.int64), begin)
            rows_of = np.diff(np.append(begin, len(h)))
            if held is not None and held[2] == h[0]:
                total[0] += held[3]
                if not held[4]:
                    yield out([held[0]], [held[1]], [held[2]])
            elif held is not None and held[3] > HOT_ANCHOR:
                yield out([None], [min(held[3], 1 << 30)], [held[2]])
            take = np.repeat(total >= 2, rows_of)
            if take.any():
                yield out(k[take], pos[take], h[take])
            hot = np.flatnonzero(total[:-1] > HOT_ANCHOR)
            if len(hot):
                yield out([None] * len(hot), np.minimum(total[hot], 1 << 30), h[begin[hot]])
            held = (k[-1], pos[-1], h[-1], total[-1], bool(take[-1]))
        if held is not None and held[3] > HOT_ANCHOR:
            yield out([None], [min(held[3], 1 << 30)], [held[2]])

    seen = rows.mapInArrow(scan, "k long, pos int, h long, n int")
    # further occurrences need no meeting: they are spread evenly
    route = F.when(F.col("n") > 0, F.col("h")).otherwise(F.xxhash64("k", "pos"))
    dealt = seen.repartition(tasks, route).sortWithinPartitions("h")
    return dealt.mapInArrow(pick, "k long, pos int, h long")


def stretches(joined: DataFrame, window: int, gram: int) -> DataFrame:
    """(route, k, id, pos, words): stretches for the shards, and (null route, k, null, pos, null, end)
    for spans that repeat an earlier stretch of the same task."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 2, PORTION):
            raw, offsets = utf8_buffer(batch.column(2))
            starts, ends, first, at, anchor, h = anchors(raw, offsets, window, gram)
            if not len(at):
                continue
            marks = batch.column(3).combine_chunks() if isinstance(batch.column(3), pa.ChunkedArray) else batch.column(3)
            sizes = np.diff(marks.offsets.to_numpy())
            row_of = np.repeat(np.arange(len(sizes)), sizes)
            flat = marks.flatten()
            where = first[row_of] + flat.field("pos").to_numpy(zero_copy_only=False)
            is_hot = flat.field("hot").to_numpy(zero_copy_only=False).astype(bool)
            flag = np.zeros(len(starts) + 1, np.int8)
            flag[where] = 1
            flag[where[is_hot]] = 2
            kind = flag[anchor]
            use = kind > 0
            at, anchor, h, kind = at[use], anchor[use], h[use], kind[use]
            if not len(at):
                continue
            # runs of windows with one anchor; a hot anchor's windows each stand alone
            new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1) | (kind[1:] == 2)])
            lo = at[new]
            hi = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1]
            h, hot = h[new].view(np.int64), kind[new] == 2
            row = np.searchsorted(first, lo, side="right") - 1
            ids = batch.column(1).fill_null(LAST).to_numpy(zero_copy_only=False)[row]
            ks = batch.column(0).to_numpy(zero_copy_only=False)[row]
            pos = lo - first[row]
            data = raw.tobytes()
            earliest: dict[bytes, tuple[int, int]] = {}
            texts = [b" ".join(data[a:b].split()) for a, b in
                     zip(starts[lo].tolist(), ends[hi + window - 1].tolist())]
            order = np.lexsort((pos, ids)).tolist()
            id_list, pos_list = ids.tolist(), pos.tolist()
            send, again = [], []
            for i in order:
                was = earliest.setdefault(texts[i], (id_list[i], pos_list[i]))
                (send if was == (id_list[i], pos_list[i]) else again).append(i)
            send, again = np.array(send, np.int64), np.array(again, np.int64)
            route = h.copy()
            if hot.any():  # one window each: dealt by its words
                alone = np.flatnonzero(hot)
                h20 = np.zeros(len(alone), np.uint64)
                wh = word_hashes(raw, starts, ends)
                for j in range(window):
                    h20 = h20 * np.uint64(0x100000001B3) + wh[lo[alone] + j]
                route[alone] = mix64(h20).view(np.int64)
            names = ["route", "k", "id", "pos", "words", "stop"]
            if len(send):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(route[send]), pa.array(ks[send]), pa.array(ids[send]), pa.array(pos[send].astype(np.int32)),
                     pa.array([texts[i] for i in send.tolist()], pa.binary()), pa.nulls(len(send), pa.int32())], names)
            if len(again):
                n = len(again)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(n, pa.int64()), pa.array(ks[again]), pa.nulls(n, pa.int64()),
                     pa.array(pos[again].astype(np.int32)), pa.nulls(n, pa.binary()),
                     pa.array((hi - lo + pos + window)[again].astype(np.int32))], names)

    return joined.mapInArrow(cut, "route long, k long, id long, pos int, words binary, stop int")


class Symbols(dict):
    """Words of a chunk -> one character each."""

    def __missing__(self, word: bytes) -> str:
        n = len(self) + 1
        c = self[word] = chr(n if n < 0xD800 else n + 0x800)  # no surrogates
        return c


def repeats(routes: list[int], ids: list[int], positions: list[int], texts: list[bytes],
            window: int) -> list[tuple[int, int, int]]:
    """(stretch, from word, to word) of windows that also start earlier.

    Confirmed phrases are compiled into one automaton: where all stretches of an anchor read alike
    that text as a whole, else each window that two places share. Then every stretch that shares
    its anchor is streamed through; a phrase's occurrences other than its earliest are reported.
    """
    groups: dict[int, dict[bytes, tuple[int, int]]] = {}
    times: dict[int, int] = {}
    for r, i, p, t in zip(routes, ids, positions, texts):
        g = groups.setdefault(r, {})
        was = g.get(t)
        if was is None or (i, p) < was:
            g[t] = (i, p)
        times[r] = times.get(r, 0) + 1
    symbols = Symbols()
    lines: dict[bytes, str] = {}
    phrases: dict[str, tuple[int, int, int]] = {}
    for r, g in groups.items():
        if times[r] < 2:  # its windows occur once
            continue
        for t in g:
            lines[t] = "".join(map(symbols.__getitem__, t.split(b" ")))
        if len(g) == 1:
            (t, (i, p)), = g.items()
            phrases[lines[t]] = (i, p, len(lines[t]))
            continue
        alike = times[r] > len(g)
        earliest: dict[str, tuple[int, int, int]] = {}
        shared = set()
        for t, (i, p) in g.items():
            line = lines[t]
            for j in range(len(line) - window + 1):
                w = line[j:j + window]
                was = earliest.get(w)
                if was is None:
                    earliest[w] = (i, p + j, window)
                    continue
                shared.add(w)
                if (i, p + j) < was[:2]:
                    earliest[w] = (i, p + j, window)
        # with equal stretches among them every window may occur twice
        phrases.update(earliest if alike else {w: earliest[w] for w in shared})
    if not phrases:
        return []
    automaton = ahocorasick.Automaton()
    for w, first in phrases.items():
        automaton.add_word(w, first)
    phrases.clear()
    automaton.make_automaton()
    found = []
    for s, (r, i, p, t) in enumerate(zip(routes, ids, positions, texts)):
        if times[r] < 2:
            continue
        lo = hi = None
        for end, (first, start, size) in automaton.iter(lines[t]):
            j = end + 1 - size
            if first == i and start == p + j:
                continue
            if lo is not None and j <= hi:
                hi = end + 1
                continue
            if lo is not None:
                found.append((s, lo, hi))
            lo, hi = j, end + 1
        if lo is not None:
            found.append((s, lo, hi))
    return found


def repeated_spans(rows: DataFrame, window: int, tasks: int) -> DataFrame:
    """(k, pos, stop): word spans covered by windows that also start earlier."""
    route = F.coalesce(F.col("route"), F.xxhash64("k", "pos"))
    dealt = rows.repartition(tasks, route).sortWithinPartitions("route")

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(k, pos, stop):
            return pa.RecordBatch.from_arrays(
                [pa.array(k, pa.int64()), pa.array(pos, pa.int32()), pa.array(stop, pa.int32())], ["k", "pos", "stop"])

        def run(held):
            routes, ks, ids, pos, words = ([x for part in held for x in part[c]] for c in range(5))
            spans = repeats(routes, ids, pos, words, window)
            if spans:
                yield out([ks[s] for s, _, _ in spans], [pos[s] + a for s, a, _ in spans],
                          [pos[s] + b for s, _, b in spans])

        held, size, last = [], 0, None
        for batch in batches:
            route = batch.column(0)
            done = route.is_null().to_numpy(zero_copy_only=False)
            if done.any():
                part = batch.filter(pa.array(done))
                yield out(part.column(1), part.column(3), part.column(5))
                batch = batch.filter(pa.array(~done))
                if not batch.num_rows:
                    continue
            r = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.flatnonzero(r[1:] != r[:-1]) + 1, [len(r)]])
            a = 0
            for c, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                # [a, c) waits; a chunk is closed where a new anchor starts
                if size + c - a >= CHUNK and r[c] != (r[c - 1] if c else last):
                    if c > a:
                        held.append([batch.column(i).slice(a, c - a).to_pylist() for i in range(5)])
                    yield from run(held)
                    held, size, a = [], 0, c
            held.append([batch.column(i).slice(a).to_pylist() for i in range(5)])
            size += len(r) - a
            last = r[-1]
        if held:
            yield from run(held)

    return dealt.mapInArrow(locate, "k long, pos int, stop int")


def without_spans(text: str | None, spans: list[dict] | None, verbatim: bool) -> tuple[str | None, int, int]:
    """The text without the words of ``spans``, its number of words, and how many of them went."""
    raw = (text or "").encode()
    if verbatim and not spans:
        return text, len(raw.split()), 0
    words = raw.split()
    stays = np.ones(len(words), bool)
    if spans:
        change = np.zeros(len(words) + 1, np.int32)
        np.add.at(change, [s["pos"] for s in spans], 1)
        np.add.at(change, [s["stop"] for s in spans], -1)
        stays = np.cumsum(change[:-1]) == 0
    gone = len(words) - int(stays.sum())
    if not verbatim:
        return b" ".join([w for w, s in zip(words, stays.tolist()) if s]).decode(), len(words), gone
    starts, ends, _ = word_spans(*utf8_buffer(pa.array([text])))
    begin = np.flatnonzero(~stays & np.concatenate([[True], stays[:-1]]))
    until = np.flatnonzero(~stays & np.concatenate([stays[1:], [True]])) + 1
    parts, at = [], 0
    for a, b in zip(begin.tolist(), until.tolist()):  # a run of words goes with the space that follows it
        parts.append(raw[at:starts[a]])
        at = starts[b] if b < len(starts) else ends[-1]
    return b"".join([*parts, raw[at:]]).decode(), len(words), gone


def remove_repeats(docs: DataFrame, window: int = 20, gram: int = 8, id_col: str = "doc_id",
                   text_col: str = "text", verbatim: bool = False) -> DataFrame:
    """``docs`` with all its columns, the text replaced by its kept words (joined by one space), and
    n_words, n_removed (they take the place of columns so named).

    With ``verbatim`` what is kept stays byte for byte: only removed words go, with the space after
    them, and a null text stays null.

    Words are runs of anything but space and 0x09-0x0D, unchanged. Windows are judged on the input.
    A null text has no words and becomes empty; a null id comes after all others; rows that repeat
    an id are compared by (id, start) alone, so exact copies of a row leave each other untouched;
    texts shorter than a window are kept whole; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text = text_of(text_col)
    key = F.xxhash64(F.col(id_col).cast("long"), text)
    rows = docs.select(key.alias("k"), F.col(id_col).cast("long").alias("id"), text.alias("t"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = staged(recurring_anchors(rows, window, gram, tasks), "anchors")
    release(spark)
    hot = found.where("k is null").select("h", F.lit(True).alias("is_hot"))
    places = found.where("k is not null")
    n = places.count()
    marks = (places.join(hot, "h", "left")
             .select("k", F.struct("pos", F.coalesce("is_hot", F.lit(False)).alias("hot")).alias("m"))
             .groupBy("k").agg(F.collect_list("m").alias("marks")))  # at most one document's anchors
    cut = stretches(rows.join(marks, "k").select("k", "id", "t", "marks"), window, gram)
    spans = staged(repeated_spans(cut, window, fan_out(docs, n, SHARD_ROWS)), "spans")
    release(spark)
    gone = spans.groupBy("k").agg(F.collect_list(F.struct("pos", "stop")).alias("gone"))
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in docs.columns}
    names = {c: f"c{i}" for i, c in enumerate(docs.columns) if c != text_col}
    rest = docs.select(*[quoted[c].alias(n) for c, n in names.items()], key.alias("k"), quoted[text_col].cast("string").alias("t"))
    out = rest.join(gone, "k", "left").drop("k")
    plain = out.drop("t", "gone").schema
    at_text = len(names)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, at_text, PORTION):
            found = [without_spans(t, spans_of, verbatim)
                     for t, spans_of in zip(batch.column(at_text).to_pylist(), batch.column(at_text + 1).to_pylist())]
            kept, n_words, n_removed = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at_text], pa.array(kept, pa.string()), pa.array(n_words, pa.int64()),
                 pa.array(n_removed, pa.int64())], [*names.values(), "kept", "n_words", "n_removed"])

    schema = plain.add("kept", "string").add("n_words", "long").add("n_removed", "long")
    done = out.select(*names.values(), "t", "gone").mapInArrow(keep, schema)
    own = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    return done.select(*[F.col("kept" if c == text_col else names[c]).alias(c) for c in own], "n_words", "n_removed")
