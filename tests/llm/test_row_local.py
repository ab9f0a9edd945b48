"""Token counts, the BPE codec, quality rules and the ranking classifier."""

import hashlib
import math
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hourloom.llm import bpe_codec, quality_ranking, quality_rules, token_counts
from tests.llm.helpers import no_documents, odd_documents, words

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
TRICKY = ["you're <|endoftext|> it's<|endoftext|>", "a\x1cb \x85 \xa0x  \n\n y", "ab" * 3000, "1234567 89,000",
          "日本語 \U0001F600\U0001F600", "x" * 500 + " " * 300 + "y", "é" * 999]


def random_texts(n):
    rng = random.Random(3)
    alphabets = ["ab", "theing on", "0123456789", "éèaeiou", "!#$%&=-", "日本語的 ", "etaoinshrdlu"]
    return ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.choice([5, 40, 300]))) for _ in range(n)]


def test_token_counts_match_the_library(spark, documents):
    texts = [r.text for r in documents.collect()] + TRICKY + random_texts(200)
    docs = odd_documents(spark, texts)
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, JSON).collect())
    library = Tokenizer.from_file(JSON)
    want = Counter()
    for r in docs.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want[r.doc_id, len((r.text or "").encode()), n, n > 512] += 1
    assert got == want


def test_heap_counts_initial_symbols_less_merges():
    ranks = {(0, 1): (0, 10), (10, 2): (1, 11)}
    ids = {ord("a"): 0, ord("b"): 1, ord("c"): 2}
    table = [ids.get(b, 3) for b in range(256)]
    assert token_counts.count_merged(b"abc", ranks, table) == 1
    assert token_counts.count_merged(b"acb", ranks, table) == 3
    assert token_counts.count_merged(b"", ranks, table) == 0


def test_codec_matches_the_library_and_round_trips(spark, documents):
    texts = [r.text for r in documents.collect()] + TRICKY + random_texts(400)
    docs = odd_documents(spark, texts)
    encoded = bpe_codec.encode_documents(docs, RANKS, P.PATTERN)
    rows = bpe_codec.digests(bpe_codec.decode_documents(encoded, RANKS, P.PATTERN)).collect()
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_codec.load_ranks(RANKS), special_tokens={})
    want = Counter()
    for r in docs.collect():
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4").tobytes()
        want[r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(),
             hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want


def test_joins_stabilise_on_single_long_matches():
    codec = bpe_codec.Codec(RANKS, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rng = random.Random(5)
    for _ in range(300):
        piece = "".join(rng.choice("etaoinshrdlu" if rng.random() < .9 else "éßñ") for _ in range(rng.randrange(25, 400)))
        assert codec.encode_piece(piece.encode()) == library.encode_ordinary(piece)


@pytest.mark.parametrize("run", [
    lambda d: token_counts.token_counts(d, JSON),
    lambda d: bpe_codec.decode_documents(bpe_codec.encode_documents(d, RANKS, P.PATTERN), RANKS, P.PATTERN),
    lambda d: quality_rules.apply_rules(d),
    lambda d: quality_ranking.classify(d, quality_ranking.Ranking(tuple([0.1] * quality_ranking.SIZE), 0.0)),
])
def test_empty_tables_give_no_rows(spark, run):
    assert run(no_documents(spark)).collect() == []


def brute_rules(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    times = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if times[x] > 1 for j in range(3)}
    n_symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), n_symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_rules_match_brute_force(spark, documents):
    extra = ["a b c a b c a b c", "x y z\n\nx y z\n x y z", "the and of " * 40, "aa bb " * 2 + "ccc",
             "tab\tword tab\tword tab\tword", "a b c d a b c", "#" * 40 + " the word"]
    docs = odd_documents(spark, [r.text for r in documents.collect()] + extra)
    got = quality_rules.apply_rules(docs).collect()
    want = Counter((r.doc_id, *brute_rules(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in got) == want
    assert all(r.kept == (not r.base_failed and r.failed_rules == "") for r in got)


def test_quality_rules_keep_clean_documents_and_run_natively(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rules = quality_rules.apply_rules(docs)
    plan = rules._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    clean = rules.join(labels.where("quality = 1"), "doc_id").where("not base_failed")
    assert clean.where("not kept").count() == 0
    assert rules.join(labels.where("quality = 0"), "doc_id").where("kept").count() == 0


def test_ranking_holds_out_and_separates(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = quality_ranking.fit(docs, labels, ~held)
    rows = quality_ranking.classify(docs, model).join(labels, "doc_id").where(held).collect()
    right = np.mean([r.predicted == r.quality for r in rows])
    assert right > 0.98
    assert all(0 <= r.score <= 1 and (r.predicted == 1) == (r.score >= 0.5) for r in rows)
    again = quality_ranking.fit(docs, labels.where(~held), ~held)
    assert again == model  # the held-out labels play no part


def test_ranking_scores_equal_plain_python(spark):
    """Features and scores recomputed word by word; buckets follow the folded word and its end only."""
    docs = odd_documents(spark, ["Hello WORLD hello\nhello", "a | b # 12 12\n\na | b # 12 12", "été OK! ok! ok ok", "x" * 5000])
    rng = np.random.default_rng(3)
    model = quality_ranking.Ranking(tuple(rng.normal(size=quality_ranking.SIZE).tolist()), 0.3)
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    split = [[w for w in re.split(r"[\x20\x09-\x0D]+", t) if w] for _, t in texts]
    every = sorted({w for ws in split for w in ws})
    _, whole, end = quality_ranking.buckets(pa.array(every))
    place = dict(zip(every, zip(whole.tolist(), end.tolist())))
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")
    for a in place:
        for b in place:
            if a.translate(low) == b.translate(low):
                assert place[a] == place[b]
            if a.translate(low).encode()[-3:] == b.translate(low).encode()[-3:]:
                assert place[a][1] == place[b][1]
    want = []
    for (doc, t), w in zip(texts, split):
        lines = [x for x in t.split("\n") if x]
        n, chars, m = max(len(w), 1), max(len(t), 1), max(len(lines), 1)
        caps = [c for c in t if unicodedata.category(c) == "Lu"]
        f = [min(sum(t.count(c) for c in "#*$%&<>") / n, 2), min(t.count("|") / n, 1), min(t.count("!") / n, 2),
             sum("0" <= c <= "9" for c in t) / chars, len(caps) / chars,
             len(regex.findall(r"(?a:\b)\p{Lu}{2,}(?a:\b)", t)) / n, len(set(w)) / n, 1 - len(set(lines)) / m,
             min(chars / n, 30) / 10, math.log1p(n) / 10, min(n / m, 200) / 100,
             len(regex.findall(r"(?<![^\s])(\S+)\s(?=\1(?:\s|$))", t)) / n]
        z = sum(a * b for a, b in zip(f, model.weights))
        z += sum(model.weights[len(f) + b] for x in w for b in place[x]) / n - model.threshold
        want.append((doc, round(1 / (1 + math.exp(-min(max(z, -30), 30))), 9)))
    got = [(r.doc_id, round(r.score, 9)) for r in quality_ranking.classify(docs, model).collect()]
    assert Counter(got) == Counter(want)


def test_ranking_learns_from_the_words(spark):
    """Texts of the same shape: only what they say tells them apart."""
    rng = np.random.default_rng(4)
    fine, poor = [f"fine{c}x" for c in "abcdefgh"], [f"poor{c}y" for c in "abcdefgh"]
    rows = [(i, " ".join(rng.choice(fine if i % 2 else poor, 12)), i % 2) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    model = quality_ranking.fit(docs, labels, F.col("doc_id") < 200)
    got = {r.doc_id: r.predicted for r in quality_ranking.classify(docs, model).collect()}
    assert np.mean([got[i] == y for i, _, y in rows if i >= 200]) > 0.95


def test_ranking_without_pairs_calls_everything_good(spark):
    labels = spark.createDataFrame([(5, 1), (9, 1), (None, 0), (4, None)], "doc_id long, quality int")
    docs = odd_documents(spark)
    model = quality_ranking.fit(docs, labels, F.lit(True))
    got = quality_ranking.classify(docs, model).collect()
    assert len(got) == docs.count() and all(r.score == 0.5 and r.predicted == 1 for r in got)


def test_pairs_follow_logistic_loss():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] - 0.5 * x[:, 1] > 0.3).astype(int)
    model = quality_ranking.fit_pairs(x, y)
    scores = x @ np.array(model.weights) - model.threshold
    assert np.mean((scores >= 0) == (y == 1)) > 0.97
    assert model.weights[0] > 0 > model.weights[1]


def test_held_out_is_never_null(spark, tmp_path):
    from hourloom.llm.queries import QUERIES
    docs = odd_documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (4, 0), (5, 1), (6, 0), (7, 1), (8, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = QUERIES["op8_quality_classifier"](spark, str(tmp_path)).collect()
    assert len(rows) == docs.count() and all(r.held_out in (True, False) for r in rows)
