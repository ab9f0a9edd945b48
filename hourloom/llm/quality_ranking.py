"""Quality classifier: Bradley-Terry pairwise ranking with a score-quantile threshold.

Texts are measured by native expressions: ratios of the whole text, and the shares of its words that fall
into hashed buckets, by the lower-cased word and by its last three bytes. Weights come from preference
pairs (a document labelled good before one labelled bad) by logistic loss on feature differences; the
threshold is the score quantile that splits the training rows as their labels do. Only the fit, over a
bounded sample of labelled rows, sees the driver; ratios are native expressions, the words' weights are
looked up in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import SPACE_CLASS, lower_ascii, pinned, portions, text_of, utf8_buffer, word_hashes, word_spans

#: Labelled rows that the fit reads at most (documented bound of the sample).
FIT_ROWS = 12_000
#: Partners of the other label that each row of the rarer label is paired with.
PARTNERS = 20

FEATURES = ("symbols", "pipes", "exclamations", "digits", "capitals", "all_capital_words", "distinct_words",
            "repeated_lines", "mean_word", "log_words", "word_line", "same_pairs")
#: Buckets of words and of word ends.
WORD_BUCKETS, END_BUCKETS = 512, 128
SIZE = len(FEATURES) + WORD_BUCKETS + END_BUCKETS
#: Ridge of the ratios and of the buckets, which are many for a small sample: the strengths from 0.03 to
#: 0.3 are alike best in four-fold cross-validation over training rows.
RIDGES = np.array([1e-3] * len(FEATURES) + [0.1] * (WORD_BUCKETS + END_BUCKETS))


_FOLD = lower_ascii(np.arange(256, dtype=np.uint8))
_FOLD[0x31:0x3A] = 0x30


def buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row the number of its first word (one entry more than rows); for each word its bucket and that
    of its last three bytes, behind the words'. A-Z is lower-cased, digits all count as 0."""
    raw, offsets = utf8_buffer(texts)
    raw = _FOLD[raw]
    starts, ends, first = word_spans(raw, offsets)
    whole = word_hashes(raw, starts, ends) % np.uint64(WORD_BUCKETS)
    end = word_hashes(raw, np.maximum(starts, ends - 3), ends) % np.uint64(END_BUCKETS)
    return first, whole.astype(np.int64), end.astype(np.int64) + WORD_BUCKETS


def features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col``, the text ``t`` and the array ``f`` of FEATURES: ratios of the whole text, zeros for an empty one."""
    base = docs.select(F.col(id_col), text_of(text_col).alias("t")).select(
        id_col, "t", F.array_remove(F.split("t", SPACE_CLASS + "+"), "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x != "").alias("l"))
    n = F.greatest(F.size("w"), F.lit(1)).cast("double")
    chars = F.greatest(F.length("t"), F.lit(1)).cast("double")
    lines = F.greatest(F.size("l"), F.lit(1)).cast("double")

    def per_word(pattern: str) -> Column:
        return F.regexp_count("t", F.lit(pattern)) / n

    values = {
        "symbols": F.least(per_word(r"[#*$%&<>]"), F.lit(2.0)),
        "pipes": F.least(per_word(r"\|"), F.lit(1.0)),
        "exclamations": F.least(per_word("!"), F.lit(2.0)),
        "digits": F.regexp_count("t", F.lit(r"[0-9]")) / chars,
        "capitals": F.regexp_count("t", F.lit(r"\p{Lu}")) / chars,
        "all_capital_words": per_word(r"\b\p{Lu}{2,}\b"),
        "distinct_words": F.size(F.array_distinct("w")) / n,
        "repeated_lines": 1.0 - F.size(F.array_distinct("l")) / lines,
        "mean_word": F.least(chars / n, F.lit(30.0)) / 10.0,
        "log_words": F.log1p(n) / 10.0,
        "word_line": F.least(n / lines, F.lit(200.0)) / 100.0,
        "same_pairs": per_word(r"(?<![^\s])(\S+)\s(?=\1(?:\s|$))"),
    }
    return pinned(base, [id_col, "t"], [F.array(*[values[k].cast("double") for k in FEATURES]).alias("f")])


@dataclass(frozen=True)
class Ranking:
    """score = sigmoid(weights . f - threshold): at least 0.5 means good."""

    weights: tuple[float, ...]
    threshold: float

    def of_words(self, text: str) -> Column:
        """The mean weight of the text's words by their buckets, 0 without words."""
        table = np.array(self.weights[len(FEATURES):])

        def mean(texts: pa.Array) -> pa.Array:
            out = []
            for batch in portions(iter([pa.RecordBatch.from_arrays([texts], ["t"])]), 0):
                first, whole, end = buckets(batch.column(0))
                row = np.repeat(np.arange(batch.num_rows), np.diff(first))
                total = np.bincount(row, table[whole] + table[end], batch.num_rows)
                out.append(total / np.maximum(np.diff(first), 1))
            return pa.array(np.concatenate(out) if out else np.zeros(0))

        return F.arrow_udf(mean, "double")(F.col(text))

    def score(self, f: str, x: str) -> Column:
        z = F.col(x)
        for i, w in enumerate(self.weights[:len(FEATURES)]):
            z = z + F.get(F.col(f), F.lit(i)) * F.lit(w)
        z = z - F.lit(self.threshold)
        return 1.0 / (1.0 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))


def fit_pairs(x: np.ndarray, y: np.ndarray, partners: int = PARTNERS, ridge: float | np.ndarray = 1e-3, steps: int = 25,
              inner: int = 60) -> Ranking:
    """Bradley-Terry weights by Newton steps on the logistic loss of feature differences, each step solved
    by conjugate gradients, so that no difference of two rows is kept. Columns are scaled to deviation 1
    for the ridge.

    Without rows of both labels there are no pairs: every score is then 0.5, so all count as good.
    """
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranking(tuple([0.0] * x.shape[1]) if x.ndim == 2 else (), 0.0)
    rng = np.random.default_rng(0)
    rare, other = (bad, good) if len(bad) <= len(good) else (good, bad)
    mine, theirs = np.repeat(rare, partners), other[rng.integers(0, len(other), len(rare) * partners)]
    first, second = (theirs, mine) if rare is bad else (mine, theirs)
    scale = x.std(axis=0, dtype=float)
    scale = np.where(scale > 1e-12, scale, np.inf)  # a constant column has no weight
    x = x / scale  # as double

    def back(pairs: np.ndarray) -> np.ndarray:
        """Sum over pairs of the difference of their rows, times what is given for the pair."""
        rows = np.bincount(first, pairs, len(x)) - np.bincount(second, pairs, len(x))
        return x.T @ rows / len(first)

    w = np.zeros(x.shape[1])
    for _ in range(steps):
        s = x @ w
        p = 1.0 / (1.0 + np.exp(-np.clip(s[first] - s[second], -30, 30)))
        residual = -(back(p - 1.0) + ridge * w)
        step, move = np.zeros_like(w), residual.copy()
        size = start = residual @ residual
        for _ in range(inner):
            if size <= 1e-16 * start or size == 0.0:
                break
            u = x @ move
            bent = back(p * (1 - p) * (u[first] - u[second])) + ridge * move
            far = size / (move @ bent)
            step += far * move
            residual -= far * bent
            size, before = residual @ residual, size
            move = residual + size / before * move
        w += step
        if np.abs(step).max() < 1e-6:
            break
    order = np.sort(x @ w)
    k = int(np.sum(y == 0))  # the quantile: as many rows below as are labelled bad
    return Ranking(tuple(float(v) for v in w / scale), float((order[k - 1] + order[k]) / 2 if k < len(order) else order[-1]))


def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, y, f, v) of (id, y, f, t): v has the share of each bucket among the words of t."""
    for batch in portions(batches, 3):
        first, whole, end = buckets(batch.column(3))
        held = []
        for a, b in zip(first[:-1], first[1:]):
            n = np.bincount(np.concatenate([whole[a:b], end[a:b]]), minlength=WORD_BUCKETS + END_BUCKETS) / max(b - a, 1)
            held.append(n.astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(held, pa.binary())], ["id", "y", "f", "v"])


def fit(docs: DataFrame, labels: DataFrame, training: Column, label_col: str = "quality", rows: int = FIT_ROWS,
        id_col: str = "doc_id", text_col: str = "text") -> Ranking:
    """Learn from the labelled rows for which ``training`` (over ``id_col``) holds.

    At most ``rows`` label rows are read, those of smallest id hash, so that the sample is bounded
    and the same in each run. Rows with a null id or label are not learned from; an id with several
    labels counts with their minimum, and rows alike in id and text count once.
    """
    picked = (labels.select(F.col(id_col).cast("long").alias(id_col), F.col(label_col).cast("int").alias("y"))
              .where(F.col(id_col).isNotNull() & F.col("y").isin(0, 1) & training)
              .groupBy(id_col).agg(F.min("y").alias("y"))
              .orderBy(F.xxhash64(id_col), id_col).limit(rows))
    # at most `rows` ids and labels: a bounded broadcast
    chosen = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("t")).join(
        F.broadcast(picked), id_col)
    measured = features(chosen, id_col, "t").join(F.broadcast(picked), id_col)
    rows_of = measured.select(id_col, "y", "f", "t").mapInArrow(shares, "id long, y int, f array<double>, v binary")
    # at most `rows` rows of SIZE shares, 30 MB: the bound of the sample
    sample = rows_of.orderBy(F.xxhash64("id"), "id", F.xxhash64("f", "v")).limit(rows).collect()
    seen = {(r["id"], tuple(r["f"]), bytes(r["v"])): r["y"] for r in sample}
    del sample
    x = np.zeros((len(seen), SIZE), np.float32)
    for row, (_, f, v) in zip(x, seen):
        row[:len(FEATURES)], row[len(FEATURES):] = f, np.frombuffer(v, np.float32)
    y = np.array(list(seen.values()), int)
    seen.clear()
    return fit_pairs(x, y, ridge=RIDGES)


def classify(docs: DataFrame, model: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, score (0 to 1) and predicted (1 if score >= 0.5) per row.

    A null text is scored as an empty one; a null id stays null; repeated rows give repeated
    results; other columns are left out; an empty table gives no rows. Row-local.
    """
    measured = features(docs, id_col, text_col).select(id_col, "f", model.of_words("t").alias("x"))
    scored = measured.select(id_col, model.score("f", "x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
