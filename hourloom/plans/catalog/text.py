"""X3 TF-IDF and X4 SVD over the documents table (whole texts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.operators import text as X
from hourloom.plans.registry import register
from hourloom.sources.tables import read_table

_TERMS_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, 'onbekend')),
                                             '[\\p{L}\\p{N}_]{2,}') AS t FROM documents),
g AS (SELECT doc_id, list_concat(t, CASE WHEN len(t) >= 2 THEN
        list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) ELSE [] END) AS terms
      FROM d),
tc AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM g)
       GROUP BY doc_id, term),
st AS (SELECT term, count(*) AS df, sum(tf) AS total_tf FROM tc GROUP BY term),
voc AS (SELECT term, df, total_tf,
          ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0 AS idf FROM (
          SELECT * FROM st WHERE df >= 2 ORDER BY total_tf DESC, term LIMIT 500)),
vi AS (SELECT *, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx FROM voc),
w AS (SELECT tc.doc_id, tc.term, vi.idx, tc.tf * vi.idf AS w FROM tc JOIN vi ON tc.term = vi.term),
n AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id)
"""


@register("x3_tfidf", _TERMS_SQL + """
SELECT w.doc_id, w.term, w.idx, round(w.w / n.norm, 6) AS tfidf FROM w JOIN n ON w.doc_id = n.doc_id
""")
def x3_tfidf(spark, sf):
    """TF-IDF (1-2 grams, min_df 2, top-500 terms, smoothed idf, L2) of every document."""
    v, _ = X.tfidf(read_table(spark, sf, "documents"), "doc_id", "text")
    return v.select("doc_id", "term", "idx", F.round("tfidf", 6).alias("tfidf"))


@register("x3_tfidf_vocabulary", _TERMS_SQL + """
SELECT term, idx, CAST(df AS BIGINT) AS df, CAST(total_tf AS BIGINT) AS total_tf,
       round(idf, 6) AS idf FROM vi
""")
def x3_tfidf_vocabulary(spark, sf):
    """The vocabulary with document frequency, corpus frequency, column index and idf."""
    _, voc = X.tfidf(read_table(spark, sf, "documents"), "doc_id", "text")
    return voc.select("term", "idx", F.col("df").cast("long"), F.col("total_tf").cast("long"),
                      F.round("idf", 6).alias("idf"))


@register("x4_svd_components")
def x4_svd_components(spark, sf):
    """10-component truncated SVD of the TF-IDF matrix → oms_vec_0..9 per document."""
    docs = read_table(spark, sf, "documents")
    v, voc = X.tfidf(docs, "doc_id", "text")
    dim = voc.count()
    s, _ = X.svd_components(v, "doc_id", dim)
    # documents without any vocabulary term have an all-zero row in the matrix → zero vector
    out = docs.select("doc_id").join(s, "doc_id", "left")
    return out.select("doc_id", *[F.round(F.coalesce(F.col(f"{X.VEC_PREFIX}{c}"), F.lit(0.0)), 6)
                                  .alias(f"{X.VEC_PREFIX}{c}") for c in range(X.N_COMPONENTS)])


@register("x4_svd_two_terms", _TERMS_SQL.replace("LIMIT 500", "LIMIT 2") + """,
m AS (SELECT d.doc_id, coalesce(sum(CASE WHEN w.idx = 0 THEN w.w / n.norm END), 0) AS x,
        coalesce(sum(CASE WHEN w.idx = 1 THEN w.w / n.norm END), 0) AS y
      FROM d LEFT JOIN w ON w.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id),
gm AS (SELECT sum(x * x) AS a, sum(x * y) AS b, sum(y * y) AS c FROM m),
e AS (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l1,
        (a + c) / 2 - sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l2 FROM gm),
v AS (SELECT *, b / sqrt(b * b + (l1 - a) * (l1 - a)) AS p, (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS q FROM e)
SELECT m.doc_id, round(m.x * v.p + m.y * v.q, 6) + 0.0 AS oms_vec_0,
       round(CASE WHEN v.q >= v.p THEN m.x * v.q - m.y * v.p ELSE m.y * v.p - m.x * v.q END, 6) + 0.0 AS oms_vec_1,
       round(sqrt(v.l1), 6) AS singular_0, round(sqrt(v.l2), 6) AS singular_1
FROM m, v
""")
def x4_svd_two_terms(spark, sf):
    """X4 on the two most frequent terms, where SQL can solve the eigenvalue problem: components of every
    document and the singular values."""
    docs = read_table(spark, sf, "documents")
    v, voc = X.tfidf(docs, "doc_id", "text", max_features=2)
    s, sing = X.svd_components(v, "doc_id", voc.count(), k=2)
    out = docs.select("doc_id").join(s, "doc_id", "left")
    return out.select("doc_id", *[(F.round(F.coalesce(F.col(f"{X.VEC_PREFIX}{c}"), F.lit(0.0)), 6) + F.lit(0.0))
                                  .alias(f"{X.VEC_PREFIX}{c}") for c in range(2)],
                      *[F.round(F.lit(float(sing[c])), 6).alias(f"singular_{c}") for c in range(2)])
