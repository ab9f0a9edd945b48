"""J13 cascade, J14 point-in-polygon edge cases, X3 TF-IDF and X4 SVD against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourloom.functions.columns import matches, squeeze_upper
from hourloom.operators import text as X
from hourloom.operators.geo import LookupLevel, lookup_cascade, point_in_polygon


def test_point_in_polygon_edges(spark):
    sq = [{"x": 0.0, "y": 0.0}, {"x": 10.0, "y": 0.0}, {"x": 10.0, "y": 10.0}, {"x": 0.0, "y": 10.0}]
    other = [{"x": 5.0, "y": 6.0}, {"x": 15.0, "y": 6.0}, {"x": 15.0, "y": 15.0},
             {"x": 5.0, "y": 15.0}]
    polys = spark.createDataFrame([(1, sq), (2, other)],
                                  "pid int, ring array<struct<x: double, y: double>>")
    pts = spark.createDataFrame(
        [(1, 2.0, 2.0), (2, 20.0, 20.0), (3, 0.0, 5.0), (4, 10.0, 5.0), (5, 0.0, 0.0),
         (6, 7.0, 7.0), (7, None, 1.0)], "id int, x double, y double")
    for cell in (4.0, None):                  # explicit and automatic grid
        out = point_in_polygon(pts, "x", "y", polys, "ring", cell=cell)
        got = {}
        for r in out.collect():
            got.setdefault(r.id, set()).add(r.pid)
        _check_pip(got)


def _check_pip(got):
    assert got[1] == {1}               # inside
    assert got[2] == {None}            # outside → kept with NULL
    assert got[3] == {1}               # on the left edge: in (half-open rule)
    assert got[4] == {None}            # on the right edge: out
    assert got[5] == {1}               # bottom-left vertex: in
    assert got[6] == {1, 2}            # in two polygons → fan-out
    assert got[7] == {None}            # NULL coordinate


def test_lookup_cascade_first_hit_wins(spark):
    rel = spark.createDataFrame([
        ("t", 1, "1234AB", "MAINSTREET"),     # postcode hit
        ("t", 2, "9999ZZ", "MAINSTREET"),     # valid postcode, miss → street hit
        ("t", 3, "12 3x", "NOWHERE"),         # malformed, no street, pc4 "123X" → no hit
        ("t", 4, "5678 cd", "NOWHERE"),       # spaces + lower case: normalised → pc4 hit
        ("t", 1, "1234AB", "MAINSTREET"),     # duplicate client → one row
    ], "con string, rid int, pc string, street string")
    rel = rel.withColumn("pc", squeeze_upper("pc"))
    bag = spark.createDataFrame([("1234AB", "MAIN STREET", 1.0, 2.0), ("1234AB", "X", 9.0, 9.0),
                                 ("5678EF", "OTHER", 5.0, 6.0)],
                                "pc string, straat string, lat double, lon double")
    bag = bag.withColumn("row", F.monotonically_increasing_id())
    streets = bag.withColumn("straat", squeeze_upper("straat"))
    pc4 = bag.withColumn("pc4", F.substring("pc", 1, 4))
    levels = [
        LookupLevel("pc", F.col("pc"), bag, "pc", ["lat", "lon"], ["row"],
                    eligible=matches("pc", r"^\d{4}[A-Z]{2}$")),
        LookupLevel("street", F.col("street"), streets, "straat", ["lat", "lon"], ["row"]),
        LookupLevel("pc4", F.substring("pc", 1, 4), pc4, "pc4", ["lat", "lon"], ["row"]),
    ]
    out = {r.rid: (r.match_level, r.lat) for r in
           lookup_cascade(rel, levels, ["con", "rid"], ["pc"], ["lat", "lon"]).collect()}
    assert out == {1: (1, 1.0), 2: (2, 1.0), 4: (3, 5.0)}


DOCS = ["The cat sat on the mat.", "The dog sat.", "A cat, a dog, the END.", None,
        "Été été café CAFÉ x", "café sat mat mat"]


def _brute_tfidf(docs, min_df=2, max_features=500):
    toks = [re.findall(r"(?u)\b\w\w+\b", (d if d is not None else "onbekend").lower())
            for d in docs]
    grams = [t + [f"{a} {b}" for a, b in zip(t, t[1:])] for t in toks]
    counts = [Counter(g) for g in grams]
    df = Counter(term for c in counts for term in c)
    tf_tot = Counter()
    for c in counts:
        tf_tot.update(c)
    keep = sorted((t for t in df if df[t] >= min_df), key=lambda t: (-tf_tot[t], t))[:max_features]
    vocab = sorted(keep)
    n = len(docs)
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in vocab}
    out = {}
    for i, c in enumerate(counts):
        w = {t: c[t] * idf[t] for t in vocab if c[t]}
        norm = math.sqrt(sum(v * v for v in w.values()))
        for t, v in w.items():
            out[(i, t)] = v / norm
    return out, vocab


def test_tfidf_matches_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(DOCS)), "doc_id long, text string")
    v, voc = X.tfidf(df, "doc_id", "text")
    got = {(r.doc_id, r.term): r.tfidf for r in v.collect()}
    exp, vocab = _brute_tfidf(DOCS)
    assert sorted(r.term for r in voc.collect()) == vocab
    assert got.keys() == exp.keys()
    for k, val in exp.items():
        assert got[k] == pytest.approx(val, abs=1e-12)
    idx = {r.term: r.idx for r in voc.collect()}
    assert [idx[t] for t in vocab] == list(range(len(vocab)))


def test_tfidf_top_k_tie_break(spark):
    docs = ["aa bb cc", "aa bb cc", "dd dd"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    _, voc = X.tfidf(df, "doc_id", "text", max_features=2)
    # all of aa, bb, cc, aa bb, bb cc have total 2 and df 2 → alphabetical wins: "aa", "aa bb"
    assert sorted(r.term for r in voc.collect()) == ["aa", "aa bb"]


def test_tfidf_of_many_ties_matches_brute_force(spark):
    rnd = np.random.default_rng(11)
    for size, most in ((4, 5), (12, 9), (40, 25), (40, 1000)):
        words = [f"w{i}" for i in range(size)]
        docs = [" ".join(rnd.choice(words, int(rnd.integers(0, 9)))) for _ in range(30)] + [None, "", "w1"]
        v, voc = X.tfidf(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), "doc_id", "text", max_features=most)
        exp, vocab = _brute_tfidf(docs, max_features=most)
        assert [r.term for r in voc.orderBy("idx").collect()] == vocab
        got = {(r.doc_id, r.term): r.tfidf for r in v.collect()}
        assert got.keys() == exp.keys() and all(got[k] == pytest.approx(x, abs=1e-12) for k, x in exp.items())


def test_tfidf_of_repeated_and_null_ids_is_one_document_each(spark):
    rows = [(1, "aa bb"), (1, "aa cc"), (None, "aa bb"), (None, "bb"), (2, "cc")]
    v, voc = X.tfidf(spark.createDataFrame(rows, "id long, text string").repartition(4), "id", "text")
    idf = {r.term: r.idf for r in voc.collect()}
    assert idf.keys() == {"aa", "bb", "cc", "aa bb"}
    tf = {1: {"aa": 2, "bb": 1, "cc": 1, "aa bb": 1}, None: {"aa": 1, "bb": 2, "aa bb": 1}, 2: {"cc": 1}}
    exp = {(d, t): n * idf[t] / math.sqrt(sum((m * idf[u]) ** 2 for u, m in c.items())) for d, c in tf.items() for t, n in c.items()}
    got = {(r.id, r.term): r.tfidf for r in v.collect()}
    assert got.keys() == exp.keys() and all(got[k] == pytest.approx(x) for k, x in exp.items())


def test_only_bigrams_that_can_be_terms_are_counted(spark, monkeypatch):
    docs = ["often rare1 often rare2", "often often rare3 rare4", "rare5 often again", "again often again"]
    t = X.tokens(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), "doc_id", "text")
    st = {r.term: (r.total_tf, r.df) for r in X.corpus_stats(t, 2, 2).collect()}
    assert {x for x in st if " " in x} == {"often often", "often again", "again often"}    # all eight before
    assert st["often"] == (6, 4) and st["often again"] == (2, 2) and st["rare1"] == (1, 1)
    monkeypatch.setattr(X, "SECOND_WORDS", 1)       # second words too many to send: any is counted
    st = {r.term: (r.total_tf, r.df) for r in X.corpus_stats(t, 2, 2).collect()}
    assert st["often again"] == (2, 2) and "often rare1" in st and "rare5 often" not in st


def test_svd_matches_numpy(spark):
    rnd = np.random.default_rng(3)
    dense = rnd.random((30, 6)) * (rnd.random((30, 6)) > 0.4)
    rows = [(i, j, float(dense[i, j])) for i in range(30) for j in range(6) if dense[i, j] > 0]
    v = spark.createDataFrame(rows, "doc long, idx int, tfidf double")
    s, sing = X.svd_components(v, "doc", 6, k=3)
    u, sv, vt = np.linalg.svd(dense, full_matrices=False)
    assert np.allclose(sing, sv[:3])
    got = {r.doc: [r[f"oms_vec_{c}"] for c in range(3)] for r in s.collect()}
    exp = dense @ vt[:3].T
    for c in range(3):   # compare up to sign
        col = np.array([got[i][c] if i in got else 0.0 for i in range(30)])
        assert min(np.abs(col - exp[:, c]).max(), np.abs(col + exp[:, c]).max()) < 1e-9


def _long_form(spark, dense):
    rows = [(i, int(j), float(dense[i, j])) for i in range(len(dense)) for j in np.flatnonzero(dense[i])]
    return spark.createDataFrame(rows, "doc long, idx int, tfidf double")


def test_svd_of_a_thousand_documents_matches_numpy(spark):
    rnd = np.random.default_rng(5)
    dense = (rnd.random((1000, 12)) * 2.0 ** -np.arange(12)) @ (rnd.random((12, 300)) - 0.3)
    dense = (dense + 0.02 * rnd.standard_normal(dense.shape)) * (rnd.random(dense.shape) < 0.3)
    s, sing = X.svd_components(_long_form(spark, dense), "doc", 300)
    _, sv, vt = np.linalg.svd(dense, full_matrices=False)
    assert np.allclose(sing, sv[:10], rtol=1e-6)
    got = {r.doc: [r[f"oms_vec_{c}"] for c in range(10)] for r in s.collect()}
    got = np.array([got[i] for i in range(1000)])
    for c in range(10):
        v = vt[c] * np.sign(vt[c][np.argmax(np.abs(vt[c]))])
        assert np.abs(got[:, c] - dense @ v).max() < 1e-3 * sv[c]
    again, _ = X.svd_components(_long_form(spark, dense).repartition(3), "doc", 300)
    again = {r.doc: [r[f"oms_vec_{c}"] for c in range(10)] for r in again.collect()}
    assert np.allclose(np.array([again[i] for i in range(1000)]), got, atol=1e-9)


def test_svd_of_a_large_vocabulary_and_of_low_rank(spark):
    rnd = np.random.default_rng(6)
    rows = [(d, int(t), 1.0) for d in range(200) for t in {*rnd.integers(0, 100_000, 5).tolist(), d % 3}]
    s, sing = X.svd_components(spark.createDataFrame(rows, "doc long, idx int, tfidf double"), "doc", 100_000, k=3, steps=4)
    dense = np.zeros((200, 100_000))
    for d, t, w in rows:
        dense[d, t] = w
    assert np.allclose(sing, np.sqrt(np.linalg.eigvalsh(dense @ dense.T)[::-1][:3]), rtol=1e-6)
    s, sing = X.svd_components(spark.createDataFrame([(1, 0, 3.0), (2, 0, 4.0)], "doc long, idx int, tfidf double"), "doc", 2, k=2)
    assert np.allclose(sing, [5, 0]) and sorted((r.doc, round(r.oms_vec_0, 9), r.oms_vec_1) for r in s.collect()) == [(1, 3, 0), (2, 4, 0)]


def test_svd_of_nothing_and_beyond_the_bound(spark):
    none = spark.createDataFrame([], "doc long, idx int, tfidf double")
    for dim in (0, 4):
        s, sing = X.svd_components(none, "doc", dim, k=2)
        assert s.collect() == [] and s.columns == ["doc", "oms_vec_0", "oms_vec_1"] and not sing.any()
    with pytest.raises(ValueError):
        X.svd_components(none, "doc", 10 ** 8)
