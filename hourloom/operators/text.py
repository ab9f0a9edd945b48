"""Text vectors of task descriptions: TF-IDF (X3) and truncated SVD.

Results are in long form ``(doc, term, weight)``: tokenising is a JVM regex, tasks count words and
bigrams of Arrow batches in numpy, document frequencies and the vocabulary are grouped aggregates of
these counts plus a top-k. The SVD is a randomised range finder over scans of the documents, with a tree
of small QR factorisations; the driver holds a basis bounded by the vocabulary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

# Fixed values (vectorizer settings of the reference): word tokens of ≥ 2 word characters after
# lower-casing, uni- and bigrams (NGRAM_MAX), min document frequency 2, 500 features, NULL text → "onbekend",
# 10 SVD components named oms_vec_0..9.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
NGRAM_MAX = 2
MIN_DF = 2
MAX_FEATURES = 500
NULL_TEXT = "onbekend"
N_COMPONENTS = 10
VEC_PREFIX = "oms_vec_"

#: Columns of a random block beyond the components asked for, and how often it is multiplied on.
OVERSAMPLE, KRYLOV_STEPS = 10, 7
#: Bytes of the largest basis, and values of one slice of products within a task.
BASIS_BYTES, SLICE_VALUES = 512 << 20, 4 << 20
#: Bytes of tokens that a task counts at a time, and second words of bigrams sent to the tasks.
PIECE_BYTES, SECOND_WORDS = 16 << 20, 100_000
#: Nodes of the upper level of the tree of QR factorisations.
TREE_WIDTH = 64


def spread(df: DataFrame, key: str) -> DataFrame:
    """Tokenising and counting are CPU-heavy per document. When the scan yields fewer partitions
    than the cluster has task slots (a few large files), hash-spread the documents over 4× the
    slots first; with a normal split count (large inputs) nothing is shuffled."""
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        few = df.rdd.getNumPartitions() < slots
    except Exception:  # noqa: BLE001 - no RDD access (e.g. Spark Connect): keep the scan layout
        return df
    return df.repartition(4 * slots, key) if few else df


def tokens(df: DataFrame, doc: str, text: str, null_text: str = NULL_TEXT) -> DataFrame:
    """Per document its lower-case word tokens in order, joined by one space (no token holds one)."""
    toks = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(null_text))),
                                F.lit(TOKEN_PATTERN), F.lit(0))
    return df.select(doc, F.array_join(toks, " ").alias("tokens"))


def _pieces(batch: pa.RecordBatch):
    """Slices of a batch (doc, tokens) with about ``PIECE_BYTES`` of tokens: (slice, row of each token,
    code of each token, words of the codes). Rows without a token have none."""
    size = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size.astype(np.int64))
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PIECE_BYTES, side="right")))
        part = batch.slice(a, b - a)
        lists = pc.split_pattern(part.column(1), " ")
        row = np.repeat(np.arange(b - a), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        coded = lists.flatten().dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        real = size[a:b][row] > 0                   # an empty text splits into one empty string
        yield part, row[real], code[real], coded.dictionary
        a = b


def _counts(row: np.ndarray, code: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of the codes 0..n-1 and in how many rows each is."""
    return np.bincount(code, minlength=n), np.bincount(np.unique(row * n + code) % n, minlength=n)


def _count_batch(term: pa.Array, tf: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(tf)
    return pa.RecordBatch.from_arrays([term.take(pa.array(some)), pa.array(tf[some]), pa.array(df[some])], ["term", "tf", "df"])


def _word_counts(batches):
    for batch in batches:
        for _, row, code, words in _pieces(batch):
            yield _count_batch(words, *_counts(row, code, len(words)))


def _pair_counts(batches, first: list[str], second: list[str] | None):
    """Counts of the bigrams whose first word is in ``first`` and whose second is in ``second`` (None: any)."""
    firsts, seconds = pa.array(first, pa.string()), None if second is None else pa.array(second, pa.string())
    for batch in batches:
        for _, row, code, words in _pieces(batch):
            is_first = pc.is_in(words, value_set=firsts).to_numpy(zero_copy_only=False)
            met = (row[1:] == row[:-1]) & is_first[code[:-1]]
            if seconds is not None:
                met &= pc.is_in(words, value_set=seconds).to_numpy(zero_copy_only=False)[code[1:]]
            pair, place = np.unique(code[:-1][met] * len(words) + code[1:][met], return_inverse=True)
            term = pc.binary_join_element_wise(words.take(pa.array(pair // max(1, len(words)))),
                                               words.take(pa.array(pair % max(1, len(words)))), " ")
            yield _count_batch(term, *_counts(row[1:][met], place, len(pair)))


def corpus_stats(t: DataFrame, min_df: int = MIN_DF, max_features: int = MAX_FEATURES) -> DataFrame:
    """(term, total_tf, df) of all words and of every bigram that can be among the ``max_features`` terms
    of the vocabulary, from the documents' tokens; a task counts by piece, Spark adds up by term.

    A bigram is in no more documents and no more often than either of its words, and comes after its first
    word among equals. So its first word is one of the ``max_features`` first words of the vocabulary's
    order, and its second is as frequent as the last of these; other bigrams are not counted."""
    from hourloom.session import materialize

    def added(run):
        return t.mapInArrow(run, "term string, tf long, df long").groupBy("term").agg(
            F.sum("tf").alias("total_tf"), F.sum("df").alias("df"))

    words = materialize(added(_word_counts))
    able = words.where(F.col("df") >= min_df)
    top = able.orderBy(F.col("total_tf").desc(), F.col("term")).limit(max_features).collect()
    first = [r["term"] for r in top]
    least = top[-1]["total_tf"] if len(top) == max_features and top else 0
    second = [r["term"] for r in able.where(F.col("total_tf") >= least).select("term").limit(SECOND_WORDS + 1).collect()]
    second = second if len(second) <= SECOND_WORDS else None    # many equals: any second word is counted
    return words.unionByName(added(lambda batches: _pair_counts(batches, first, second)))


def vocabulary(st: DataFrame, n_docs: int, min_df: int = MIN_DF,
               max_features: int = MAX_FEATURES) -> DataFrame:
    """Terms with df ≥ ``min_df``, the ``max_features`` most frequent over the corpus (ties by
    term), with their column index (alphabetical, as the vectorizer orders features) and the
    smoothed idf ``ln((1+n)/(1+df)) + 1``."""
    top = st.where(F.col("df") >= min_df).orderBy(F.col("total_tf").desc(), F.col("term"))\
        .limit(max_features)
    from pyspark.sql import Window
    w = Window.orderBy("term")   # ≤ max_features rows: a single small partition by design
    return top.withColumn("idx", (F.row_number().over(w) - 1).cast("int")).withColumn(
        "idf", F.log((F.lit(1.0) + F.lit(float(n_docs))) / (F.lit(1.0) + F.col("df")))
        + F.lit(1.0))


def _hits(batches, terms: list[str], doc: str):
    """Per document and piece the vocabulary's terms in it, as ``idx << 32 | occurrences``."""
    parts = [x.split(" ") for x in terms]
    known = sorted({w for x in parts for w in x})
    place = {w: i for i, w in enumerate(known)}
    alone = np.full(len(known) + 1, -1)             # the last stands for words of no term
    pairs = []
    for i, x in enumerate(parts):
        if len(x) == 1:
            alone[place[x[0]]] = i
        else:
            pairs.append((place[x[0]] * len(known) + place[x[1]], i))
    pair_key, pair_idx = np.array(sorted(pairs), np.int64).reshape(-1, 2).T
    n, values = len(terms), pa.array(known, pa.string())
    for batch in batches:
        for part, row, code, words in _pieces(batch):
            ids = part.column(0).dictionary_encode(null_encoding="encode")     # an id may repeat
            row_id = ids.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            at = pc.fill_null(pc.index_in(words, value_set=values), len(known)).to_numpy(zero_copy_only=False)[code]
            found = alone[at]
            keys = [row_id[row[found >= 0]] * n + found[found >= 0]]
            if len(pair_key):
                met = (row[1:] == row[:-1]) & (at[:-1] < len(known)) & (at[1:] < len(known))
                key = at[:-1][met].astype(np.int64) * len(known) + at[1:][met]
                near = np.minimum(np.searchsorted(pair_key, key), len(pair_key) - 1)
                same = pair_key[near] == key
                keys.append(row_id[row[1:][met][same]] * n + pair_idx[near[same]])
            key, tf = np.unique(np.concatenate(keys), return_counts=True)
            some, begin = np.unique(key // n, return_index=True)
            lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(key)), pa.int32()), pa.array((key % n) << 32 | tf))
            yield pa.RecordBatch.from_arrays([ids.dictionary.take(pa.array(some)), lists], [doc, "hits"])


def _weighted(batches, terms: list[str], idf: np.ndarray, doc: str):
    """The long form (doc, term, idx, tfidf) of documents' hits."""
    names, n = pa.array(terms, pa.string()), len(terms)
    for batch in batches:
        for a in range(0, batch.num_rows, 1000):
            part = batch.slice(a, 1000)
            hits = part.column(1)
            row = np.repeat(np.arange(len(hits)), pc.list_value_length(hits).to_numpy(zero_copy_only=False))
            hit = hits.flatten().to_numpy(zero_copy_only=False)
            key, place = np.unique(row * n + (hit >> 32), return_inverse=True)
            w = np.bincount(place, weights=hit & 0xFFFFFFFF, minlength=len(key)) * idf[key % n]
            norm = np.sqrt(np.bincount(key // n, weights=w * w, minlength=len(hits)))
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(key // n)), names.take(pa.array(key % n)),
                                              pa.array((key % n).astype(np.int32)), pa.array(w / norm[key // n])],
                                             [doc, "term", "idx", "tfidf"])


def tfidf(df: DataFrame, doc: str, text: str, min_df: int = MIN_DF,
          max_features: int = MAX_FEATURES) -> tuple[DataFrame, DataFrame]:
    """L2-normalised TF-IDF in long form ``(doc, term, idx, tfidf)`` plus the vocabulary.

    Tasks look up words and neighbours in the vocabulary (≤ ``max_features`` rows) and send one
    array of counts a document; rows that share an id are one document, whose norm is its own."""
    from hourloom.session import materialize
    t = materialize(tokens(spread(df, doc), doc, text))   # texts are read and tokenised once
    n_docs = t.count()
    voc = materialize(vocabulary(corpus_stats(t, min_df, max_features), n_docs, min_df, max_features))
    top = voc.orderBy("idx").collect()                     # at most ``max_features`` rows
    names, idf = [r["term"] for r in top], np.array([r["idf"] for r in top])
    id_type = t.schema[doc].dataType
    hits = (t.mapInArrow(lambda batches: _hits(batches, names, doc),
                         StructType().add(doc, id_type).add("hits", ArrayType(LongType())))
            .groupBy(doc).agg(F.flatten(F.collect_list("hits")).alias("hits")))
    out = hits.mapInArrow(lambda batches: _weighted(batches, names, idf, doc),
                          StructType().add(doc, id_type).add("term", "string").add("idx", "integer").add("tfidf", "double"))
    return out, voc


def _products(batch: pa.RecordBatch, basis: np.ndarray):
    """(first row, columns, weights, offsets, X·basis) of slices of a batch (idx list, w list) whose
    products take a few tens of megabytes."""
    idx, w = batch.column(0), batch.column(1)
    ends = np.cumsum(pc.list_value_length(idx).to_numpy(zero_copy_only=False).astype(np.int64))
    most = max(1, SLICE_VALUES // basis.shape[1])
    a = 0
    while a < len(ends):
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + most, side="right")))
        cols = idx.slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
        vals = w.slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
        begin = np.concatenate([[0], ends[a:b - 1] - done])
        yield a, cols, vals, begin, np.add.reduceat(vals[:, None] * basis[cols], begin, axis=0)
        a = b


def _times_gram(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """XᵀX·basis: one scan of the documents; a task adds up its share for the terms it meets, Spark the
    tasks' shares by term. What comes to the driver is as large as ``basis``."""
    sent = rows.sparkSession.sparkContext.broadcast(basis)  # at most BASIS_BYTES
    p = basis.shape[1]
    names = [f"z{c}" for c in range(p)]

    def run(batches):
        q = sent.value
        total = np.zeros_like(q)
        for batch in batches:
            for _, cols, vals, begin, y in _products(batch, q):
                row = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(cols))))
                met, place = np.unique(cols, return_inverse=True)
                for c in range(p):
                    total[met, c] += np.bincount(place, weights=vals * y[row, c], minlength=len(met))
        met = np.flatnonzero(total.any(axis=1))
        for a in range(0, len(met), 10_000):
            part = met[a:a + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *[pa.array(total[part, c]) for c in range(p)]],
                                             ["idx", *names])

    shares = rows.select("idx", "w").mapInArrow(run, "idx int, " + ", ".join(f"{n} double" for n in names))
    summed = shares.groupBy("idx").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    out = np.zeros_like(basis)
    out[summed["idx"].to_numpy(np.int64)] = summed[names].to_numpy()
    sent.unpersist()
    return out


def _triangle(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """The triangular factor of X·basis by a tree of small QR factorisations: of the slices within a
    task one after another, of the tasks in at most ``TREE_WIDTH`` groups, of the groups at the end."""
    sent = rows.sparkSession.sparkContext.broadcast(basis)  # at most BASIS_BYTES
    p = basis.shape[1]

    def leaves(batches):
        r = np.zeros((0, p))
        for batch in batches:
            for *_, y in _products(batch, sent.value):
                r = np.linalg.qr(np.vstack([r, y]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() % TREE_WIDTH], pa.int32()),
                 pa.array([r.ravel()], pa.list_(pa.float64()))], ["node", "r"])

    def inner(group: pa.Table) -> pa.Table:
        r = np.zeros((0, p))
        for x in group.column("r"):
            r = np.linalg.qr(np.vstack([r, np.array(x.as_py()).reshape(-1, p)]), mode="r")
        return pa.table({"node": group.column("node").slice(0, 1), "r": pa.array([r.ravel()], pa.list_(pa.float64()))})

    schema = "node int, r array<double>"
    tops = rows.select("idx", "w").mapInArrow(leaves, schema).groupBy("node").applyInArrow(inner, schema).collect()
    sent.unpersist()
    if not tops:
        return np.zeros((0, p))
    return np.linalg.qr(np.vstack([np.array(t["r"]).reshape(-1, p) for t in sorted(tops)]), mode="r")


def svd_components(vectors: DataFrame, doc: str, dim: int, k: int = N_COMPONENTS, oversample: int = OVERSAMPLE,
                   steps: int = KRYLOV_STEPS) -> tuple[DataFrame, np.ndarray]:
    """Truncated SVD (uncentred, like the reference's) of the TF-IDF matrix X to ``k`` components;
    returns per-document ``oms_vec_0..k-1`` and the singular values.

    Randomised block Krylov range finder: a seeded random block of ``k + oversample`` columns is multiplied
    by XᵀX up to ``steps`` times, each product (one scan, no shuffle of documents) made orthogonal to the
    blocks before it. The triangular factor of X times that basis comes from a tree of small QR
    factorisations; its SVD gives the singular values and the loadings. The driver holds the basis,
    dim x (steps + 1) x (k + oversample) numbers and bounded by ``BASIS_BYTES`` (ValueError above), never a
    Gram matrix of terms and nothing per document. When the basis spans all terms the result is exact.

    Signs: the loading of largest magnitude of each component is positive. Components beyond the rank of X
    are 0. Documents without a vector have no row; an empty table gives no rows.
    """
    from hourloom.session import materialize
    spark = vectors.sparkSession
    names = [f"{VEC_PREFIX}{c}" for c in range(k)]
    pairs = F.sort_array(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), F.col("tfidf").cast("double").alias("w"))))
    rows = materialize(vectors.groupBy(F.col(doc).alias("doc")).agg(pairs.alias("x"))    # at most ``dim`` pairs a document
                       .select("doc", F.col("x.idx").alias("idx"), F.col("x.w").alias("w")))
    block = min(k + oversample, dim)
    if dim * min(dim, (steps + 1) * block) * 8 > BASIS_BYTES:
        raise ValueError(f"a basis of {dim} terms takes more than {BASIS_BYTES} bytes: fewer terms or steps")
    basis = np.linalg.qr(np.random.default_rng(0).standard_normal((dim, block)))[0]
    last = basis
    for _ in range(steps):
        if basis.shape[1] >= dim or not last.shape[1]:
            break
        z = _times_gram(rows, last)
        size = np.linalg.norm(z)
        for _ in range(2):                       # twice is enough for orthogonality to rounding
            z -= basis @ (basis.T @ z)
        u, s, _ = np.linalg.svd(z, full_matrices=False)
        last = u[:, s > 1e-10 * max(size, 1e-300)][:, :dim - basis.shape[1]]
        last = np.linalg.qr(last - basis @ (basis.T @ last))[0]
        basis = np.hstack([basis, last])
    r = _triangle(rows, basis)
    _, s, wt = np.linalg.svd(r, full_matrices=False) if r.size else (None, np.zeros(0), np.zeros((0, basis.shape[1])))
    kept = int(np.sum(s[:k] > 1e-12 * s[0])) if len(s) else 0
    v, sing = np.zeros((dim, k)), np.zeros(k)
    v[:, :kept], sing[:kept] = basis @ wt[:kept].T, s[:kept]
    for c in range(kept):
        if v[np.argmax(np.abs(v[:, c])), c] < 0:
            v[:, c] = -v[:, c]
    loadings = spark.sparkContext.broadcast(v)

    def score(batches):
        for batch in batches:
            part = pa.RecordBatch.from_arrays([batch.column(1), batch.column(2)], ["idx", "w"])
            for a, _, _, begin, y in _products(part, loadings.value):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, len(begin)), *[pa.array(y[:, c]) for c in range(k)]],
                                                 [batch.schema.names[0], *names])

    kind = rows.schema["doc"].dataType.simpleString()
    scored = rows.mapInArrow(score, f"doc {kind}, " + ", ".join(f"{n} double" for n in names))
    return scored.withColumnRenamed("doc", doc), sing
