"""Language-model scoring by deleted interpolation.

An n-gram model mixes the maximum-likelihood estimates of all orders with a uniform one. The
mixture weights depend on how often the context was seen (one bucket per power of two) and are
learned by expectation-maximisation: a part of the training documents is deleted, the estimates are
taken from the rest, and the weights are fitted to the deleted part's counts.

Counting is an exchange. Documents are cut into blocks of tokens; each block sends its distinct
n-grams with their counts to shards (ranges of n-gram hashes), a shard adds up what all blocks
sent, and each block gets the totals of its own n-grams back. So a frequent n-gram is one entry per
block, every token's counts are exact over the whole corpus, and no table is collected anywhere.
N-grams are told apart by 64-bit hashes of their words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import lower_ascii, mix64, portions, release, staged, text_of, utf8_buffer, word_hashes, word_spans

#: Tokens of a block (a longer document is a block of its own).
BLOCK_TOKENS = 1 << 20
#: Tokens whose n-grams a shard is sized for.
SHARD_TOKENS = 1 << 20
#: Hashes of the end token and of what stands before the first word.
END, BEFORE = np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7)
#: The uniform estimate keeps at least this weight, so every text has a probability.
FLOOR = 1e-6
#: Parts of the documents.
KEPT, DELETED, UNSEEN = 0, 1, 2


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers as byte planes, as many as the largest needs."""
    v = values.astype("<u8")
    planes = max(1, -(-int(v.max()).bit_length() // 8)) if len(v) else 1
    return bytes([planes]) + np.ascontiguousarray(v.view(np.uint8).reshape(-1, 8)[:, :planes].T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = data[0]
    body = np.frombuffer(data, np.uint8, offset=1).reshape(planes, -1)
    out = np.zeros((body.shape[1], 8), np.uint8)
    out[:, :planes] = body.T
    return out.view("<u8").ravel()


def to_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of (id, part, t): ids, parts and token counts of their documents; the words' hashes,
    most frequent first; the tokens as places in that list. Deleted documents have blocks of their
    own, with odd numbers, so that fitting the weights moves no others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24

        def by_kind():
            for batch in portions(batches, 2, 2 * BLOCK_TOKENS * 4):
                deleted = pc.equal(batch.column(1), DELETED)
                for odd, some in ((0, batch.filter(pc.invert(deleted))), (1, batch.filter(deleted))):
                    if some.num_rows:
                        yield odd, some

        for odd, batch in by_kind():
            raw, offsets = utf8_buffer(batch.column(2))
            raw = lower_ascii(raw)
            starts, ends, first = word_spans(raw, offsets)
            words = word_hashes(raw, starts, ends)
            sizes = np.diff(first) + 1
            total = np.cumsum(sizes)
            a = 0
            while a < len(sizes):
                done = total[a - 1] if a else 0
                b = max(a + 1, int(np.searchsorted(total, done + BLOCK_TOKENS, side="right")))
                tokens = np.insert(words[first[a]:first[b]], first[a + 1:b + 1] - first[a], END)
                known, local, times = np.unique(tokens, return_inverse=True, return_counts=True)
                order = np.argsort(-times, kind="stable")
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number + odd], pa.int64()), pa.array([int(sizes[a:b].sum())], pa.int64()),
                     pa.array([batch.column(0).slice(a, b - a).to_pylist()], pa.list_(pa.int64())),
                     pa.array([batch.column(1).slice(a, b - a).to_pylist()], pa.list_(pa.int8())),
                     pa.array([sizes[a:b].tolist()], pa.list_(pa.int32())),
                     pa.array([known[order].tobytes()], pa.binary()), pa.array([pack(place[local])], pa.binary())],
                    ["block", "n", "ids", "parts", "sizes", "words", "tokens"])
                number += 2
                a = b

    return docs.mapInArrow(run, "block long, n long, ids array<long>, parts array<tinyint>, sizes array<int>, "
                                "words binary, tokens binary")


def keys_of(words: bytes, tokens: bytes, sizes: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order from 1: the key of the n-gram that ends at each token of a block."""
    h = np.frombuffer(words, "<u8")[unpack(tokens).astype(np.int64)]
    begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = [h]
    at = np.arange(len(h))
    key = h
    for back in range(1, order):
        before = np.where(at - back >= begin, h[np.maximum(at - back, 0)], BEFORE)
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + before + np.uint64(back))
        out.append(key)
    return out


def send(blocks: DataFrame, order: int, bits: int) -> DataFrame:
    """(order, shard, block, keys, seen, gone): each block's distinct n-grams by shard, with their
    counts in all training documents and in the deleted ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, parts, sizes, words, tokens in zip(*(batch.column(c).to_pylist() for c in range(5))):
                sizes = np.array(sizes, np.int64)
                part = np.repeat(np.array(parts, np.int8), sizes)
                for n, keys in enumerate(keys_of(words, tokens, sizes, order), 1):
                    distinct, place = np.unique(keys, return_inverse=True)
                    seen = np.bincount(place[part != UNSEEN], minlength=len(distinct))
                    gone = np.bincount(place[part == DELETED], minlength=len(distinct))
                    cuts = np.searchsorted(distinct >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
                    rows = []
                    for shard in np.flatnonzero(np.diff(cuts)).tolist():
                        a, b = cuts[shard], cuts[shard + 1]
                        delta = np.diff(distinct[a:b], prepend=np.uint64(shard << (64 - bits)))
                        rows.append((n, shard, block, pack(delta), pack(seen[a:b]), pack(gone[a:b])))
                    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), types)], ["n", "shard", "block", "keys", "seen", "gone"])

    return blocks.select("block", "parts", "sizes", "words", "tokens").mapInArrow(
        run, "n int, shard int, block long, keys binary, seen binary, gone binary")


def add_up(sent: DataFrame, bits: int) -> DataFrame:
    """(n, shard, block, seen, gone, types, kept_types): for each block the totals of its n-grams in
    the order it sent them. The shard's first row also has the number of n-grams seen in training
    and in its kept part."""

    def run(group: pa.Table) -> pa.Table:
        shard = np.uint64(group.column(1)[0].as_py())
        keys = [np.cumsum(unpack(x)) + (shard << np.uint64(64 - bits)) for x in group.column(3).to_pylist()]
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = []
        for c in (4, 5):
            counts = np.concatenate([unpack(x) for x in group.column(c).to_pylist()])
            totals.append(np.bincount(place, weights=counts).astype(np.int64))
        cuts = np.cumsum([0] + [len(k) for k in keys])
        seen, gone = totals
        rest = [0] * (len(keys) - 1)
        return pa.table({
            "n": group.column(0), "shard": group.column(1), "block": group.column(2),
            "seen": pa.array([pack(seen[place[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
            "gone": pa.array([pack(gone[place[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
            "types": pa.array([int((seen > 0).sum()), *rest], pa.int64()),
            "kept_types": pa.array([int((seen > gone).sum()), *rest], pa.int64())})

    return sent.groupBy("n", "shard").applyInArrow(
        run, "n int, shard int, block long, seen binary, gone binary, types long, kept_types long")


def counts_of(block: pa.Table, back: pa.Table, order: int):
    """Of one block: (sizes, parts, ids, seen, gone); seen[n], gone[n] hold for each token the
    counts of the (n + 1)-gram that ends there."""
    ids, parts, sizes, words, tokens = (block.column(c)[0].as_py() for c in ("ids", "parts", "sizes", "words", "tokens"))
    sizes = np.array(sizes, np.int64)
    n_of = back.column("n").to_numpy()
    shard = back.column("shard").to_numpy()
    seen, gone = [], []
    for n, keys in enumerate(keys_of(words, tokens, sizes, order), 1):
        _, place = np.unique(keys, return_inverse=True)
        mine = np.flatnonzero(n_of == n)
        mine = mine[np.argsort(shard[mine])].tolist()
        for to, name in ((seen, "seen"), (gone, "gone")):
            column = back.column(name)
            to.append(np.concatenate([unpack(column[i].as_py()) for i in mine]).astype(np.int64)[place])
    return sizes, np.array(parts, np.int8), ids, seen, gone


def context_counts(counts: list[np.ndarray], sizes: np.ndarray, documents: int) -> list[np.ndarray]:
    """For each order from 2: the count of each token's context. Before a first word stands what
    stands before each document, so its count is the number of documents."""
    first = np.cumsum(sizes) - sizes
    out = []
    for c in counts[:-1]:
        context = np.empty_like(c)
        context[1:] = c[:-1]
        context[first] = documents
        out.append(context)
    return out


def bucket_of(count: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else 1 + the whole binary logarithm."""
    return np.where(count > 0, np.log2(np.maximum(count, 1)).astype(np.int64) + 1, 0)


def buckets_of(contexts: list[np.ndarray]) -> np.ndarray:
    """One number per combination of the context buckets of all orders, highest order first."""
    out = np.zeros(len(contexts[0]), np.int64) if contexts else np.zeros(0, np.int64)
    for c in reversed(contexts):
        out = out * 64 + bucket_of(c)
    return out


def estimates(counts: list[np.ndarray], contexts: list[np.ndarray], tokens: int, types: int) -> np.ndarray:
    """Maximum-likelihood estimates of each token: uniform, order 1, order 2, ..."""
    n = len(counts[0])
    out = np.empty((len(counts) + 1, n))
    out[0] = 1.0 / (types + 1)
    out[1] = counts[0] / max(tokens, 1)
    for k, context in enumerate(contexts):
        out[k + 2] = counts[k + 1] / np.maximum(context, 1)
    return out


class Mixture:
    """Weights of the estimates for each context bucket."""

    def __init__(self, order: int):
        self.order = order
        self.weights: dict[int, np.ndarray] = {}
        self.default = np.full(order + 1, 1.0 / (order + 1))

    def of(self, buckets: np.ndarray) -> np.ndarray:
        """Weights per token: a bucket without held-out counts takes those of all buckets together."""
        known, place = np.unique(buckets, return_inverse=True)
        table = np.array([self.weights.get(int(b), self.default) for b in known])
        return table[place].T


def fit(events: DataFrame, order: int, tokens: int, types: int, steps: int = 30, change: float = 1e-3) -> Mixture:
    """Expectation-maximisation over ``events`` (bucket, c1.., x1.., n): held-out tokens with their
    counts and context counts in the kept part. Each step is one aggregation over all events and
    brings one row per bucket to the driver."""
    mix = Mixture(order)
    estimate = [F.lit(1.0 / (types + 1)), F.col("c0") / F.lit(float(max(tokens, 1)))]
    estimate += [F.col(f"c{k + 1}") / F.greatest(F.col(f"x{k}"), F.lit(1)) for k in range(order - 1)]
    base = events.select("bucket", "n", *[e.alias(f"p{k}") for k, e in enumerate(estimate)])
    buckets = [r["bucket"] for r in base.select("bucket").distinct().collect()]  # at most 64 per order
    weights = {b: mix.default.copy() for b in buckets}
    spark = events.sparkSession
    for _ in range(steps if buckets else 0):
        table = spark.createDataFrame([(b, *map(float, w)) for b, w in weights.items()],
                                      "bucket long, " + ", ".join(f"w{k} double" for k in range(order + 1)))
        joined = base.join(F.broadcast(table), "bucket")  # one row per bucket
        total = sum((F.col(f"w{k}") * F.col(f"p{k}") for k in range(1, order + 1)), F.col("w0") * F.col("p0"))
        shares = joined.groupBy("bucket").agg(*[
            F.sum(F.col("n") * F.col(f"w{k}") * F.col(f"p{k}") / total).alias(f"s{k}") for k in range(order + 1)])
        most = 0.0
        for r in shares.collect():
            new = np.array([r[f"s{k}"] for k in range(order + 1)])
            new = new / new.sum()
            most = max(most, float(np.abs(new - weights[r["bucket"]]).max()))
            weights[r["bucket"]] = new
        if most < change:
            break
    for b, w in weights.items():
        w = np.maximum(w, 0.0)
        w[0] = max(w[0], FLOOR)
        mix.weights[b] = w / w.sum()
    if mix.weights:
        mix.default = np.mean(list(mix.weights.values()), axis=0)
    return mix


def score(docs: DataFrame, learn: Column, deleted: Column, order: int = 2, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the lower-cased (A-Z) words and one end. The model learns from rows for which
    ``learn`` holds; those for which ``deleted`` also holds are its deleted part. base_score adds
    log10((c + 1) / (N + V + 1)) over tokens, score the log10 of the mixture. Both columns are over
    ``docs``; null counts as false. A null text is empty: its only token is the end. A null id stays
    null; repeated rows are learned from and scored each; other columns are left out; an empty table
    gives no rows. Without training rows every token has the uniform estimate.
    """
    spark = docs.sparkSession
    yes = F.coalesce(learn, F.lit(False))
    part = F.when(~yes, UNSEEN).when(F.coalesce(deleted, F.lit(False)), DELETED).otherwise(KEPT).cast("tinyint")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), part.alias("part"), text_of(text_col).alias("t"))
    blocks = staged(to_blocks(rows), "blocks")
    total = blocks.agg(F.sum("n")).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, math.ceil(math.log2(max(least, total / SHARD_TOKENS, 2))))
    back = staged(add_up(send(blocks, order, bits), bits), "counts")
    release(spark)
    sums = back.where("n = 1").agg(F.sum("types").alias("types"), F.sum("kept_types").alias("kept")).first()
    per_doc = blocks.select(F.inline(F.arrays_zip("parts", "sizes")))
    by_part = {r["parts"]: (r["n"], r["docs"]) for r in per_doc.groupBy("parts").agg(
        F.sum("sizes").alias("n"), F.count("*").alias("docs")).collect()}
    kept_tokens, kept_docs = by_part.get(KEPT, (0, 0))
    gone_tokens, gone_docs = by_part.get(DELETED, (0, 0))
    n_train, n_docs = kept_tokens + gone_tokens, kept_docs + gone_docs
    n_types, kept_types = (sums["types"] or 0), (sums["kept"] or 0)

    names = [f"c{k}" for k in range(order)] + [f"x{k}" for k in range(order - 1)]

    def held_out(block: pa.Table, totals: pa.Table) -> pa.Table:
        """Tokens of a block's deleted documents with their counts in the kept part."""
        sizes, parts, _, seen, gone = counts_of(block, totals, order)
        kept = [s - g for s, g in zip(seen, gone)]
        contexts = context_counts(kept, sizes, kept_docs)
        mine = np.flatnonzero(np.repeat(parts, sizes) == DELETED)
        table = np.stack([c[mine] for c in (buckets_of(contexts) if contexts else np.zeros_like(kept[0]), *kept, *contexts)])
        order_of = np.lexsort(table[::-1])
        table = table[:, order_of]
        new = np.ones(table.shape[1], bool)
        new[1:] = (table[:, 1:] != table[:, :-1]).any(axis=0)
        times = np.diff(np.append(np.flatnonzero(new), table.shape[1]))
        return pa.table([pa.array(c[new]) for c in table] + [pa.array(times)], names=["bucket", *names, "n"])

    columns = ("block", "ids", "parts", "sizes", "words", "tokens")

    def meet(which: Column):
        return blocks.where(which).select(*columns).groupBy("block").cogroup(
            back.where(which).select("block", "n", "shard", "seen", "gone").groupBy("block"))

    events = staged(meet(F.col("block") % 2 == 1).applyInArrow(
        lambda _, a, b: held_out(a, b), ", ".join(f"{c} long" for c in ("bucket", *names, "n"))), "events")
    release(spark)
    mix = fit(events, order, kept_tokens, kept_types)

    def scored(block: pa.Table, totals: pa.Table) -> pa.Table:
        sizes, parts, ids, seen, _ = counts_of(block, totals, order)
        contexts = context_counts(seen, sizes, n_docs)
        p = estimates(seen, contexts, n_train, n_types)
        buckets = buckets_of(contexts) if contexts else np.zeros(len(seen[0]), np.int64)
        begin = np.cumsum(sizes) - sizes
        text = np.add.reduceat(np.log10((mix.of(buckets) * p).sum(axis=0)), begin)
        base = np.add.reduceat(np.log10((seen[0] + 1.0) / (n_train + n_types + 1.0)), begin)
        known = np.add.reduceat((seen[0] > 0).astype(np.int64), begin)
        return pa.table({"id": pa.array(ids, pa.int64()), "n_tokens": pa.array(sizes), "n_known": pa.array(known),
                         "train_tokens": pa.array(np.full(len(sizes), n_train, np.int64)),
                         "base_score": pa.array(base), "score": pa.array(text)})

    out_schema = "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return meet(F.lit(True)).applyInArrow(lambda _, a, b: scored(a, b), out_schema).withColumnRenamed("id", id_col)
