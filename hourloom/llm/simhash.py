"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint is cut into m blocks. Two that differ in at most d bits agree in at least m - d
whole blocks, so each choice of m - d blocks is a key and close pairs meet under some key. Within
a key the Hamming distance is verified; of the close pairs only a spanning forest is emitted, so
output stays linear in the size of a group. m follows the number of distinct fingerprints, which
keeps chance meetings rare at any size; every m finds every pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import portions, staged, text_of
from hourloom.llm.components import components

#: Fingerprints under one key that a task compares at once; larger keys are cut into finer ones.
KEY_ROWS = 50_000
#: Blocks that the free bits of an over-full key are cut into.
FINER_BLOCKS = 10


def fingerprint(text: str, shingle: int = 4) -> int:
    """The 64-bit SimHash of a text (A-Z lower-cased, words parted by white space)."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        joined = b" ".join(words)
        starts, at = [], 0
        for w in words:
            starts.append(at)
            at += len(w) + 1
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b - 1], 42) for a, b in zip(starts, starts[shingle:])]
        hashes.append(digest(joined[starts[-shingle]:], 42))
    ones = np.zeros(64, np.int64)
    h = np.array(hashes, "<u8")
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, k, fp): the id, a hash of the row's id and text, and the fingerprint as a signed long."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), row_key(id_col, text_col).alias("k"), text.alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 2):
            fp = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], ["id", "k", "fp"])

    return rows.mapInArrow(run, "id long, k long, fp long")


def row_key(id_col: str = "doc_id", text_col: str = "text"):
    """A hash of a row's id and text; rows that agree in both have the same."""
    return F.xxhash64(F.col(id_col).cast("long"), text_of(text_col))


def split_bits(bits: list[int], blocks: int) -> list[list[int]]:
    cuts = [round(i * len(bits) / blocks) for i in range(blocks + 1)]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:])]


def key_masks(bits: list[int], blocks: int, distance: int, held: int = 0) -> list[int]:
    """For each choice of ``blocks - distance`` blocks of ``bits``: a mask of their bits and ``held``'s."""
    parts = [sum(1 << b for b in part) for part in split_bits(bits, blocks)]
    return [held | sum(c) for c in combinations(parts, blocks - distance)]


def blocks_for(n: int, distance: int) -> int:
    """The least number of blocks whose keys have about as many values as there are fingerprints."""
    need = math.log2(max(n, 2))
    for m in range(distance + 1, 24):
        if 64 * (m - distance) / m >= min(need, 44):
            return m
    return 24


def forest(fps: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that span each set of fingerprints connected at ``distance``: from a fingerprint to
    all unvisited ones that are near it."""
    rest = fps
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            x = frontier.pop()
            near = np.bitwise_count(rest ^ x) <= distance
            if near.any():
                found = rest[near]
                yield np.full(len(found), x, fps.dtype), found
                frontier.extend(found)
                rest = rest[~near]


def keyed(fps: DataFrame, masks: list[int], ids: str) -> DataFrame:
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
                      for i, m in enumerate(signed)])
    return fps.select("fp", F.inline(pairs)).select(F.col("c").alias(ids), "key", "fp")


def links_by_key(rows: DataFrame, distance: int, key_rows: int | None) -> DataFrame:
    """Spanning links (a, b) under each key of ``rows`` (c, key, fp); with ``key_rows``, the
    fingerprints of larger keys come back as (a = fp, b = null, c) to be cut finer.

    Rows are dealt by key and sorted; a task holds one key's fingerprints at a time, and of a key
    beyond ``key_rows`` only that many.
    """
    dealt = rows.repartition("c", "key").sortWithinPartitions("c", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, b, c, over):
            n = len(a)
            b = pa.nulls(n, pa.int64()) if over else pa.array(b.view("<i8"))
            return pa.RecordBatch.from_arrays([pa.array(a.view("<i8")), b, pa.array(np.full(n, c, np.int32))],
                                              ["a", "b", "c"])

        def close(now, parts):
            """A key is complete: its links, unless its rows were passed on."""
            if now is not None and parts is not None:
                fps = np.concatenate(parts)
                if len(fps) > 1:
                    for a, b in forest(fps, distance):
                        yield out(a, b, now[0], False)

        now, parts, held = None, None, 0
        for batch in batches:
            c = batch.column(0).to_numpy(zero_copy_only=False)
            key = batch.column(1).to_numpy(zero_copy_only=False)
            fp = batch.column(2).to_numpy(zero_copy_only=False).view("<u8")
            if not len(c):
                continue
            edge = np.flatnonzero((c[1:] != c[:-1]) | (key[1:] != key[:-1])) + 1
            starts = np.concatenate([[0], edge])
            ends = np.concatenate([edge, [len(c)]])
            # whole keys of two inside the batch, all at once
            twos = np.flatnonzero(ends - starts == 2)
            twos = twos[(twos > 0) & (twos < len(starts) - 1)]
            i = starts[twos]
            i = i[np.bitwise_count(fp[i] ^ fp[i + 1]) <= distance]
            if len(i):
                yield out(fp[i], fp[i + 1], 0, False)
            size = ends - starts
            todo = np.flatnonzero((size > 2) | (np.arange(len(size)) == 0) | (np.arange(len(size)) == len(size) - 1))
            for g in todo:
                a, b = starts[g], ends[g]
                if now != (c[a], key[a]):
                    yield from close(now, parts)
                    now, parts, held = (c[a], key[a]), [], 0
                held += b - a
                if key_rows is not None and held > key_rows:
                    for part in [*(parts or []), fp[a:b]]:
                        yield out(part, None, c[a], True)
                    parts = None
                else:
                    parts.append(fp[a:b])
        yield from close(now, parts)

    return dealt.mapInArrow(run, "a long, b long, c int")


def links(distinct: DataFrame, n: int, distance: int = 4, key_rows: int = KEY_ROWS) -> DataFrame:
    """Links (a, b) whose connected sets are those of all pairs within ``distance`` bits.

    ``distinct`` holds each fingerprint once (column fp), ``n`` their number.
    """
    bits = list(range(64))
    blocks = blocks_for(n, distance)
    masks = key_masks(bits, blocks, distance)
    first = staged(links_by_key(keyed(distinct, masks, "c"), distance, key_rows), "links")
    found = first.where("b is not null").select("a", "b")
    over = first.where("b is null").select("c", F.col("a").alias("fp"))
    # over-full keys: their free bits in finer blocks, until at most 17 bits or so are free
    finer = [(c, m) for c, mask in enumerate(masks)
             for m in key_masks([b for b in bits if not mask >> b & 1], FINER_BLOCKS, distance, mask)]
    table = distinct.sparkSession.createDataFrame(
        [(c, i, m - (1 << 64) if m >> 63 else m) for i, (c, m) in enumerate(finer)], "c int, f int, mask long")
    if over.isEmpty():
        return found
    cut = over.join(F.broadcast(table), "c").select(  # the masks: a few thousand rows at most
        F.col("f").alias("c"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    return found.unionByName(links_by_key(cut, distance, None).select("a", "b"))


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id",
                    text_col: str = "text", key_rows: int = KEY_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, k (hash of the row's id and text), fingerprint
    (16 hex digits), component_id (least id reachable over links of at most ``distance`` bits),
    group_key (the component's least fingerprint, as a long).

    A null text is empty; texts without words have fingerprint zero and link like any other. A null
    id is never the least one: component_id is null only where no id in the component is known.
    Repeated rows give repeated results; other columns are left out; no rows give no rows.
    """
    fps = staged(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = staged(fps.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    n = distinct.count()
    edges = links(distinct.select("fp"), n, distance, key_rows)
    roots = components(edges)
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("group_key"))
    leasts = rooted.groupBy("group_key").agg(F.min("least").alias("component_id"))
    classes = staged(rooted.join(leasts, "group_key").select("fp", "group_key", "component_id"), "classes")
    return fps.join(classes, "fp").select(
        F.col("id").alias(id_col), "k", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        "group_key")
