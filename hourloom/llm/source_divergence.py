"""How the sources of a language differ in their words: hash-consed segment trees over term ids.

Counts: each task sums its texts' terms by (lang, source, term) before anything is shuffled; terms in at
least three documents of their language are kept. The ids of a language's terms are (shard, place in the
shard), the shard from the term's hash; a shard holds some ``WIDTH`` terms of every source, the most
frequent first, so no task holds a whole vocabulary, and the common counts of rare terms stand together.

Over a shard each source has a segment tree of its counts. Nodes are hash-consed: leaves of the same
count, and then pairs of the same children, are one node for all sources. A pair of sources is priced by
walking both trees at once from the root; equal pairs of nodes of a level are memoized, so each is
followed down, and priced on the way up, once, for all sums. Both directions of a pair share the walk.
Prices of the shards add up to the pair's.

Shares are p = 1 + floor(10^9 (count + 1) / (N + V)); a price is floor((p - q)^2 / q) in 64-bit integers
(at most 10^18 a term, and as the shares of a group sum to 10^9 + V, about that for all terms together).
Products that may not fit are worked out in Python integers.

Null text, lang and source are empty strings; each row is a document, also a repeated one; an empty
table gives an empty result; a language without kept terms has pairs of value 0. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourloom.llm.common import portions, staged, text_of

#: What stands between terms.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
ONE = 1_000_000_000
#: Terms of a language need this many documents.
LEAST_DOCUMENTS = 3
#: Terms a shard is meant to hold.
WIDTH = 4096
#: Rows of sums a task keeps (some 50 bytes each) before it hands them on.
HELD = 1_000_000
TOP = 200


def _summed(tables: list[pa.Table]) -> pa.Table:
    return (pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False)
            .aggregate([("n", "sum"), ("docs", "sum")]).rename_columns(["lang", "source", "term", "n", "docs"]))


def _terms_of(part: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of one batch of (lang, source, text)."""
    words = pc.split_pattern_regex(pc.ascii_lower(part.column(2)), pattern=BETWEEN)
    flat, row = words.flatten(), np.asarray(pc.list_parent_indices(words)).astype(np.int64)
    there = np.asarray(pc.not_equal(flat, ""))
    coded = flat.dictionary_encode()
    most = max(1, len(coded.dictionary))
    each, n = np.unique(row[there] * most + np.asarray(coded.indices)[there], return_counts=True)
    langs, sources = part.column(0).dictionary_encode(), part.column(1).dictionary_encode()
    group = np.asarray(langs.indices).astype(np.int64) * len(sources.dictionary) + np.asarray(sources.indices)
    keys = group[each // most] * most + each % most
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    total = np.add.reduceat(n[order], first) if len(first) else n
    docs, keys = np.diff(np.append(first, len(keys))), keys[first]
    group = keys // most
    return pa.table({"lang": langs.dictionary.take(pa.array(group // len(sources.dictionary))),
                     "source": sources.dictionary.take(pa.array(group % len(sources.dictionary))),
                     "term": coded.dictionary.take(pa.array(keys % most)),
                     "n": pa.array(total, pa.int64()), "docs": pa.array(docs, pa.int64())})


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs), summed within the task while they are at most ``HELD`` rows."""
    held, rows = [], 0
    for part in portions(batches, 2):
        held.append(_terms_of(part))
        rows += held[-1].num_rows
        if rows > 2 * HELD:
            held = [_summed(held)]
            rows = held[0].num_rows
            if rows > HELD:
                yield from held[0].to_batches(max_chunksize=50_000)
                held, rows = [], 0
    if held:
        yield from _summed(held).to_batches(max_chunksize=50_000)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) over all rows; one shuffle, by (lang, term), that later steps keep."""
    given = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source"), text_of("text").alias("text"))
    partial = given.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return (partial.repartition("lang", "term").groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(count: int, total: int) -> int:
    """p of a term with ``count`` of the group's occurrences; ``total`` is N + V."""
    return 1 + ONE * (count + 1) // total


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """``share`` of each count, worked out once for each that occurs."""
    values, at = np.unique(counts, return_inverse=True)
    return np.array([share(int(c), total) for c in values], np.int64)[at]


def prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Forest:
    """Segment trees of several count rows over the same term ids, with shared nodes.

    ``counts`` has a row a group and a column a term; the columns are filled up to a power of two by
    terms that no group has, which cost nothing. ``levels[0]`` gives each place's leaf and ``values`` the
    leaves' counts; ``children[h]`` gives the two nodes below each node of level h.
    """

    ABSENT = -1

    def __init__(self, counts: np.ndarray) -> None:
        groups, n = counts.shape
        width = 1 << max(0, (n - 1).bit_length())
        padded = np.full((groups, width), self.ABSENT, np.int64)
        padded[:, :n] = counts
        self.values, ids = np.unique(padded, return_inverse=True)
        nodes = ids.reshape(groups, width)
        self.children: list[np.ndarray | None] = [None]
        while nodes.shape[1] > 1:
            left, right = nodes[:, 0::2].astype(np.int64), nodes[:, 1::2].astype(np.int64)
            most = int(nodes.max()) + 1
            keys, ids = np.unique(left * most + right, return_inverse=True)
            self.children.append(np.stack([keys // most, keys % most], axis=1))
            nodes = ids.reshape(groups, -1)
        self.roots = nodes[:, 0]

    def price(self, a: int, b: int, total_a: int, total_b: int) -> tuple[int, int]:
        """Sums over all terms of the prices of group a against b, and of b against a."""
        pairs = np.array([[self.roots[a], self.roots[b]]], np.int64)
        uses = []
        for level in range(len(self.children) - 1, 0, -1):
            below = self.children[level]
            both = np.concatenate([np.stack([below[pairs[:, 0], side], below[pairs[:, 1], side]], axis=1)
                                   for side in (0, 1)])
            most = int(both.max()) + 1
            keys, at = np.unique(both[:, 0] * most + both[:, 1], return_inverse=True)
            uses.append(at.reshape(2, -1))
            pairs = np.stack([keys // most, keys % most], axis=1)
        left, right = self.values[pairs[:, 0]], self.values[pairs[:, 1]]
        there = left != self.ABSENT
        p, q = np.ones(len(pairs), np.int64), np.ones(len(pairs), np.int64)
        p[there], q[there] = shares(left[there], total_a), shares(right[there], total_b)
        out = []
        for sums in (prices(p, q), prices(q, p)):
            for at in reversed(uses):
                sums = sums[at[0]] + sums[at[1]]
            out.append(int(sums[0]))
        return out[0], out[1]


_AUDIT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()),
                    ("value", pa.int64())])


def _audit(key: tuple, counts: pa.Table, groups: pa.Table) -> pa.Table:
    """One shard of one language: prices of all pairs of sources, and each source's own leading terms."""
    lang, shard = key[0].as_py(), key[1].as_py()
    groups = groups.sort_by("source")
    sources = groups["source"].to_pylist()
    vocabulary = groups["vocabulary"].to_pylist()
    totals = [n + v for n, v in zip(groups["total"].to_pylist(), vocabulary)]
    lang_total = groups["lang_total"][0].as_py() + vocabulary[0]
    rows = []
    if not counts.num_rows:
        if shard == 0:
            rows = [(a, "pair", b, 0) for a in sources for b in sources if a != b]
        return _rows(lang, rows)
    coded = counts["term"].combine_chunks().dictionary_encode()
    at = np.asarray(coded.indices)
    n = counts["n"].to_numpy()
    whole = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(whole, at, n)
    # most frequent first, ties by the term's bytes
    by_term = np.asarray(pc.sort_indices(coded.dictionary.cast(pa.binary()))).astype(np.int64)
    order = by_term[np.argsort(-whole[by_term], kind="stable")]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    table = np.zeros((len(sources), len(order)), np.int64)
    group = np.asarray(pc.index_in(counts["source"].combine_chunks(), groups["source"].combine_chunks()))
    table[group, place[at]] = n
    forest = Forest(table)
    for a in range(len(sources)):
        for b in range(a + 1, len(sources)):
            there, back = forest.price(a, b, totals[a], totals[b])
            rows += [(sources[a], "pair", sources[b], there), (sources[b], "pair", sources[a], back)]
    rank = np.empty(len(order), np.int64)
    rank[by_term] = np.arange(len(order))
    terms, rank = coded.dictionary.take(pa.array(order)), rank[order]
    q = shares(whole[order], lang_total)
    for i, source in enumerate(sources):
        mine = np.flatnonzero(table[i] > 0)
        p = shares(table[i][mine], totals[i])
        more = p > q[mine]
        mine, values = mine[more], prices(p[more], q[mine[more]])
        best = np.lexsort([rank[mine], -values])[:TOP]
        rows += [(source, "term", t, v) for t, v in zip(terms.take(pa.array(mine[best])).to_pylist(), values[best].tolist())]
    return _rows(lang, rows)


def _rows(lang: str, rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * 4
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip([[lang] * len(rows), *columns], _AUDIT.types)],
                                schema=_AUDIT)


def divergences(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: the other sources of the language by their divergence from the group; part ``term``:
    the ``TOP`` terms that the group has more of than its language.
    """
    counts = staged(term_counts(docs), "terms")
    spread = counts.groupBy("lang", "term").agg(F.sum("docs").alias("d"), F.sum("n").alias("whole")).where(
        F.col("d") >= LEAST_DOCUMENTS)
    kept = staged(counts.select("lang", "source", "term", "n")
                  .join(spread.select("lang", "term"), ["lang", "term"]), "kept")
    per_lang = spread.groupBy("lang").agg(F.count("*").alias("vocabulary"), F.sum("whole").alias("lang_total"))
    found = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source")).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    none = F.lit(0).cast("long")
    groups = staged(found.join(totals, ["lang", "source"], "left").join(per_lang, "lang", "left")
                    .select("lang", "source", *[F.coalesce(c, none).alias(c)
                                                for c in ("total", "vocabulary", "lang_total")]), "groups")
    largest = groups.agg(F.max("vocabulary")).first()[0] or 0
    shards = 1 << max(0, (-(-largest // WIDTH) - 1).bit_length())
    dealt = kept.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int"))
    everywhere = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    priced = (dealt.groupBy("lang", "shard").cogroup(everywhere.groupBy("lang", "shard"))
              .applyInArrow(_audit, "lang string, source string, part string, item string, value long"))
    summed = priced.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    return summed.withColumn("rank", F.row_number().over(order)).where(
        f"part = 'pair' OR rank <= {TOP}").select("lang", "source", "part", "item", "value", "rank")
