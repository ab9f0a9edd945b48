"""Operators that compare documents with each other or with a list, held to brute-force versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hourloom.llm import decontamination, licenses, lm_scoring, simhash, substring_dedup
from hourloom.llm.components import components
from tests.llm.helpers import lower_ascii, no_documents, odd_documents, words

MASK = (1 << 64) - 1


def prose(n, seed, size=60, vocabulary=400):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(size // 2, size))) for _ in range(n)]


# --- language model -------------------------------------------------------------------------------

def brute_model(rows, weights, order):
    """Counts as nested dictionaries of token tuples; weights by bucket tuple."""
    seen, n, docs = Counter(), 0, 0
    for _, text, part in rows:
        if part == 2:
            continue
        tokens = ["<"] * (order - 1) + words(lower_ascii(text)) + [">"]
        docs += 1
        for i in range(order - 1, len(tokens)):
            n += 1
            for k in range(1, order + 1):
                seen[tuple(tokens[i - k + 1:i + 1])] += 1
    types = len([g for g in seen if len(g) == 1])
    out = []
    for i, text, _ in rows:
        tokens = ["<"] * (order - 1) + words(lower_ascii(text)) + [">"]
        base = score = known = 0
        for j in range(order - 1, len(tokens)):
            c = [seen[tuple(tokens[j - k + 1:j + 1])] for k in range(1, order + 1)]
            x = [docs if all(t == "<" for t in tokens[j - k:j]) else seen[tuple(tokens[j - k:j])] for k in range(1, order)]
            bucket = 0
            for v in reversed(x):
                bucket = bucket * 64 + (int(math.log2(v)) + 1 if v else 0)
            w = weights(bucket)
            p = [1 / (types + 1), c[0] / n] + [c[k + 1] / max(x[k], 1) for k in range(order - 1)]
            score += math.log10(sum(a * b for a, b in zip(w, p)))
            base += math.log10((c[0] + 1) / (n + types + 1))
            known += c[0] > 0
        out.append((i, len(tokens) - order + 1, known, n, round(base, 6), round(score, 6)))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores_match_nested_counts(spark, documents, order, monkeypatch):
    docs = odd_documents(spark, [r.text for r in documents.limit(80).collect()])
    made = []
    fit = lm_scoring.fit
    monkeypatch.setattr(lm_scoring, "fit", lambda *a, **b: made.append(fit(*a, **b)) or made[-1])
    rest = F.col("doc_id") % 7
    got = lm_scoring.score(docs, F.coalesce(rest != 2, F.lit(True)), rest == 5, order=order).collect()
    rows = [(r.doc_id, r.text, 0 if r.doc_id is None else {2: 2, 5: 1}.get(r.doc_id % 7, 0)) for r in docs.collect()]
    want = brute_model(rows, lambda b: made[0].weights.get(b, made[0].default), order)
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                   for r in got) == Counter(want)


def test_lm_blocks_and_shards_do_not_matter(spark, documents, monkeypatch):
    rest = F.col("doc_id") % 7
    whole = lm_scoring.score(documents, rest != 2, rest == 5).orderBy("doc_id").collect()
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", 500)
    cut = lm_scoring.score(documents.repartition(5), rest != 2, rest == 5).orderBy("doc_id").collect()
    assert len(whole) == len(cut)
    for a, b in zip(whole, cut):
        assert a[:4] == b[:4]
        assert (a.base_score, a.score) == pytest.approx((b.base_score, b.score), rel=1e-6)


def test_lm_learns_from_training_rows_only_and_beats_unigrams(spark, documents):
    rest = F.col("doc_id") % 7
    plain = lm_scoring.score(documents, rest != 2, rest == 5).where(rest == 2).orderBy("doc_id").collect()
    changed = documents.withColumn("text", F.when(rest == 2, F.lit("quite another text")).otherwise(F.col("text")))
    other = lm_scoring.score(changed, rest != 2, rest == 5).where(rest == 2).collect()
    assert len({(r.n_tokens, r.train_tokens, round(r.score, 9)) for r in other}) == 1
    assert other[0].train_tokens == plain[0].train_tokens
    assert sum(r.score for r in plain) > sum(r.base_score for r in plain)


def test_em_raises_held_out_likelihood(spark):
    events = spark.createDataFrame([(1, 5, 4, 10, 30), (1, 1, 0, 10, 5), (0, 2, 0, 0, 9)],
                                   "bucket long, c0 long, c1 long, x0 long, n long")
    mix = lm_scoring.fit(events, 2, 100, 50)

    def likelihood(of):
        total = 0
        for b, c0, c1, x0, n in events.collect():
            p = np.array([1 / 51, c0 / 100, c1 / max(x0, 1)])
            total += n * math.log(of(b) @ p)
        return total

    assert likelihood(lambda b: mix.weights[b]) > likelihood(lambda b: np.full(3, 1 / 3))
    assert mix.weights[1][2] > 0.5 and mix.weights[0][2] < 1e-3


def test_pack_round_trip():
    for values in ([], [0], [1, 255, 256], [2 ** 63, 5, 0]):
        v = np.array(values, np.uint64)
        assert lm_scoring.unpack(lm_scoring.pack(v)).tolist() == v.tolist()


# --- decontamination ------------------------------------------------------------------------------

def test_decontamination_finds_every_item_with_substitutions(spark):
    rng = random.Random(2)
    items = prose(30, 7, size=50, vocabulary=5000) + ["one two three four", "", None]
    texts, want = prose(40, 8, vocabulary=5000), set()
    for n, item in enumerate(items[:31]):
        w = item.split()
        for _ in range(0 if len(w) < 11 else len(w) // 12):
            w[rng.randrange(len(w))] = "other"
        host = prose(1, 100 + n, vocabulary=5000)[0].split()
        at = rng.randrange(len(host))
        texts.append(" ".join(host[:at]) + "\n" + " ".join(w).upper() + "!!! " + " ".join(host[at:]))
        want.add((100 + 40 + n, n))
    docs = odd_documents(spark, texts)
    benchmark = spark.createDataFrame(list(enumerate(items)) + [(None, items[0])], "item_id long, text string")
    got = decontamination.overlaps(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.item_id is not None and r.n_matched >= 0.6 * r.item_words} == want
    assert {r.doc_id for r in got if r.item_id is None} == {140}
    assert {r.doc_id for r in decontamination.contaminated(docs, benchmark).collect()} >= {
        d for d, n in want if len(items[n].split()) < 11}


def test_decontamination_matches_exact_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")

    def fold(text):
        return re.findall(r"[a-z0-9\x80-\U0010ffff]+", lower_ascii(text))

    items = {r.item_id: " " + " ".join(fold(r.text)) + " " for r in benchmark.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if t in " " + " ".join(fold(r.text)) + " "}
    got = {(r.doc_id, r.item_id) for r in decontamination.overlaps(docs, benchmark).collect()
           if r.n_matched == r.item_words}
    assert got == want and want


def test_best_overlap():
    same = np.array([1, 1, 0, 1, 1, 1, 1, 1, 1, 0, 0, 0, 1], bool)
    assert decontamination.best_overlap(same) == (3, 9, 6)
    assert decontamination.best_overlap(np.zeros(4, bool)) == (0, 0, 0)
    assert decontamination.best_overlap(np.zeros(0, bool)) == (0, 0, 0)


def changed(text, places):
    return " ".join("other" if i in places else w for i, w in enumerate(text.split()))


def numbered(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def test_stretches_match_brute_force():
    rng = np.random.default_rng(5)
    for n in range(40):
        for p in (0.3, 0.7, 0.85, 1.0):
            same = rng.random(n) < p
            ok = {(a, b) for a in range(n) for b in range(a + 1, n + 1)
                  if same[a] and same[b - 1] and 5 * same[a:b].sum() >= 4 * (b - a)}
            want = [(a, b, int(same[a:b].sum())) for a, b in sorted(ok)
                    if not any((c, d) != (a, b) and c <= a and b <= d for c, d in ok)]
            assert decontamination.stretches(same) == want


def test_contaminated_by_substituted_inserted_and_partial_items(spark):
    items = {1: numbered("a", 30), 2: numbered("b", 15), 3: numbered("c", 40), 4: numbered("d", 59), 5: numbered("e", 15)}
    c, d, e = items[3].split(), items[4].split(), items[5].split()
    leaks = [changed(items[1], {3, 26}), changed(items[2], {3}), changed(items[2], {3, 11}), changed(items[1], {3, 9, 15, 20, 26}),
             " ".join([*c[:20], "new", *c[20:]]), " ".join([*c[:13], "x", "y", *c[13:26], "z", *c[26:]]),
             " ".join(c[:20] + ["pad"] * 60 + c[20:]), " ".join(c[:19] + c[21:]), " ".join([*e[:4], "x", *e[4:]]),
             " ".join(d[10:40])]
    clean = [changed(items[1], set(range(0, 30, 4))), changed(items[2], {3, 7, 11, 14}), " ".join(c[:24]), " ".join(d[:24]),
             " ".join(c[:12] + ["pad"] * 30 + c[:12] + ["pad"] * 30 + c[:12])]
    rows = [(i, f"before it {t} after it") for i, t in enumerate(leaks + clean)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(list(items.items()) + [(6, ""), (7, None)], "item_id long, text string")
    got = decontamination.contaminated(docs, benchmark).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(leaks)))


def test_best_overlap_takes_the_longest_of_equal_ones():
    same = np.ones(20, bool)
    same[[4, 15]] = False
    assert decontamination.best_overlap(same) == (0, 20, 18)
    assert decontamination.best_overlap(np.array([1, 1, 0, 1, 1, 0, 0, 1, 1], bool)) == (0, 2, 2)


def test_overlaps_are_whole_and_all_reported(spark):
    items = {1: numbered("a", 15), 2: numbered("b", 38), 3: numbered("c", 34), 4: numbered("d", 20), 5: numbered("e", 40)}
    texts = {1: changed(items[1], {3, 11}), 2: changed(items[2], range(15, 23)), 3: changed(items[3], range(15, 19)),
             4: changed(items[4], {4, 15}), 5: changed(items[5], {0, 1, 2, *range(15, 40)})}
    docs = spark.createDataFrame([(i, f"x y {t} z") for i, t in texts.items()], "doc_id long, text string")
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.first_word, r.last_word, r.n_matched, r.item_words)
                 for r in decontamination.overlaps(docs, benchmark).collect())
    assert got == [(1, 1, 2, 16, 13, 15), (2, 2, 2, 16, 15, 38), (2, 2, 25, 39, 15, 38), (3, 3, 2, 35, 30, 34),
                   (4, 4, 2, 21, 18, 20), (5, 5, 5, 16, 12, 40)]


def test_overlaps_equal_a_search_of_all_alignments(spark):
    """Every alignment of every document and item is compared; those that share a hash under some mask count."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(6)]
    items = [" ".join(rng.choice(words) for _ in range(rng.choice([3, 6, 12, 16, 25]))) for _ in range(12)] + [" ".join(["w1"] * 14)]
    texts = []
    for n in range(25):
        w = [rng.choice(words) for _ in range(rng.randrange(60))]
        for item in rng.sample(items, 2):
            some = item.split()
            for _ in range(rng.randrange(4)):
                some[rng.randrange(len(some))] = "other"
            at = rng.randrange(len(w) + 1)
            w[at:at] = some
        texts.append(" ".join(w))
    texts.append(" ".join(["w1"] * 90))
    want = Counter()
    for d, t in enumerate(texts):
        w = t.split()
        for i, item in enumerate(items):
            v = item.split()
            masks = [*decontamination.MASKS, *(decontamination.own_masks(len(v)) if len(v) < 11 else ())]
            for diagonal in range(1 - len(v), len(w)):
                same = np.array([0 <= diagonal + j < len(w) and w[diagonal + j] == v[j] for j in range(len(v))])
                seen = any(0 <= diagonal + a and diagonal + a + len(m) <= len(w)
                           and all(same[a + x] or m[x] == "0" for x in range(len(m)))
                           for m in masks for a in range(len(v) - len(m) + 1))
                whole = [(a, b) for a in range(len(v)) for b in range(a + 1, len(v) + 1) if same[a] and same[b - 1]
                         and same[a:b].sum() >= 4 * (b - a - same[a:b].sum())]
                for a, b in whole if seen else ():
                    n = int(same[a:b].sum())
                    if not any((x, y) != (a, b) and x <= a and b <= y for x, y in whole) and (b - a >= 10 or 5 * n >= 4 * len(v)):
                        want[d, i, diagonal + a, diagonal + b - 1, n, len(v)] += 1
    got = Counter()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = decontamination.overlaps(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    for r in rows:
        for j in range(r.n_places):
            got[r.doc_id, r.item_id, r.first_word + j, r.last_word + j, r.n_matched, r.item_words] += 1
    assert got == want and len(rows) < sum(want.values())


def test_one_word_repeated_gives_classes_of_overlaps(spark):
    docs = spark.createDataFrame([(1, "same " * 200_000)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, "same " * 40)], "item_id long, text string")
    rows = decontamination.overlaps(docs, benchmark).collect()
    assert len(rows) < 100 and sum(r.n_places for r in rows) > 199_961
    assert [(r.first_word, r.last_word, r.n_places) for r in rows if r.n_matched == 40] == [(0, 39, 199_961)]
    assert [r.doc_id for r in decontamination.contaminated(docs, benchmark).collect()] == [1]


def test_masks_ignore_what_short_items_may_change(spark):
    def fits(mask, n, places):
        return any(all(mask[j] == "0" or a + j not in places for j in range(len(mask))) for a in range(n - len(mask) + 1))

    for n in range(5, 31):
        masks = decontamination.MASKS + (decontamination.own_masks(n) if n < 11 else ())
        assert all(any(fits(m, n, {i}) for m in masks) for i in range(n))
        if n >= 15:
            assert all(any(fits(m, n, {i, j}) for m in masks) for i in range(n) for j in range(i))
    items = [numbered(f"s{n}x", n) for n in range(3, 13)]
    texts = [(n, i, changed(t, {i})) for n, t in enumerate(items) for i in range(len(t.split()))]
    halves = [" ".join([*t.split()[:7], "new", *t.split()[7:]]) for t in (numbered("h", 15),)]
    docs = spark.createDataFrame([(r, f"x {t} y") for r, (_, _, t) in enumerate(texts)] + [(900, halves[0])],
                                 "doc_id long, text string")
    benchmark = spark.createDataFrame([*enumerate(items), (50, numbered("h", 15))], "item_id long, text string")
    want = {(r, n) for r, (n, _, _) in enumerate(texts) if len(items[n].split()) > 4}
    got = decontamination.overlaps(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and all(r.n_matched == r.item_words - 1 for r in got)
    got = {r.doc_id for r in decontamination.contaminated(docs, benchmark).collect()}
    assert got == {r for r, _ in want} | {900}


def test_decontamination_of_empty_tables(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.overlaps(odd_documents(spark), benchmark).collect() == []
    full = spark.createDataFrame([(1, "alpha beta gamma delta epsilon")], "item_id long, text string")
    assert decontamination.overlaps(no_documents(spark), full).collect() == []
    hits = decontamination.overlaps(odd_documents(spark), full).collect()
    assert Counter((r.doc_id, r.first_word, r.last_word) for r in hits) == Counter(
        [(5, 0, 4), (None, 0, 4), (9, 1, 5)])


# --- licenses -------------------------------------------------------------------------------------

def brute_licenses(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))
    places, labels = [], set()
    for label, phrase in licenses.PHRASES:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_places_match_brute_force(spark, documents):
    extra = ["Under the MIT License, under the mit license", "cc by nc cc by nc cc-by-nc x cc by", "CC BY\nNC",
             "apache license version 20", "apache license, version 2.0", "under the mit licenKe", "the mit license",
             "a under the mit license" * 50]
    docs = odd_documents(spark, [r.text for r in documents.collect()] + extra)
    got = licenses.scan(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter(
        (r.doc_id, *brute_licenses(r.text)) for r in docs.collect())
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_license_spans_survive_insertions_across_diagonals(spark):
    w = licenses.TEMPLATES[0][1].split()
    w.insert(20, "really")
    del w[45]
    texts = [" ".join(w).title(), " ".join(w[:25]), "all rights  RESERVED."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs).collect()}
    assert got[0][0] == "mit" and 0.8 < got[0][1] < 1
    assert got[1][0] == "" and 0 < got[1][1] < 0.7
    assert got[2] == ("all-rights-reserved", 1.0)
    assert licenses.scan(no_documents(spark)).collect() == []


def test_license_scan_is_native(spark, documents):
    plan = licenses.scan(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)


# --- substring dedup ------------------------------------------------------------------------------

def brute_repeats(rows, window):
    last = 1 << 63
    first = {}
    for i, text in rows:
        w = words(text)
        for p in range(len(w) - window + 1):
            g = tuple(w[p:p + window])
            here = (last if i is None else i, p)
            first[g] = min(first.get(g, here), here)
    out = []
    for i, text in rows:
        w = words(text)
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < (last if i is None else i, p):
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone)))
    return Counter(out)


@pytest.mark.parametrize("window,gram,hot,chunk", [(20, 8, 2000, 6000), (20, 8, 2, 3), (5, 3, 2, 4), (3, 1, 4, 2)])
def test_substring_dedup_matches_brute_force(spark, documents, monkeypatch, window, gram, hot, chunk):
    monkeypatch.setattr(substring_dedup, "HOT_ANCHOR", hot)
    monkeypatch.setattr(substring_dedup, "CHUNK", chunk)
    passage = " ".join(f"p{i}" for i in range(60))
    extra = [f"{x} {passage} {x}" for x in prose(15, 4)] + [passage, passage + " " + passage, "a b c d e " * 30]
    docs = odd_documents(spark, [r.text for r in documents.collect()] + extra).where("length(text) < 100000 or text is null")
    got = substring_dedup.remove_repeats(docs, window, gram).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in got) == brute_repeats(
        [(r.doc_id, r.text) for r in docs.collect()], window)
    assert all(r.kept == "kept" and r.score == 0.5 and r.id == "id" for r in got)
    assert substring_dedup.remove_repeats(no_documents(spark)).collect() == []


# --- simhash --------------------------------------------------------------------------------------

def brute_fingerprint(text):
    w = words(lower_ascii(text))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, distance):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_simhash_matches_brute_force(spark, documents):
    base = prose(6, 11, size=300)
    near = [x.replace("w7 ", "v7 ", 1) for x in base] + [x + " tail" for x in base]
    docs = odd_documents(spark, [r.text for r in documents.limit(100).collect()] + base + near)
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    roots = brute_components(fps, 4)
    least = {g: min((r.doc_id for r, x in zip(rows, roots) if x == g and r.doc_id is not None), default=None)
             for g in set(roots)}
    want = Counter((r.doc_id, f"{f:016x}", least[g]) for r, f, g in zip(rows, fps, roots))
    assert len(set(roots)) < len(set(fps))  # some different fingerprints do link
    for key_rows in (simhash.KEY_ROWS, 2):  # the second sends every key of three through finer ones
        got = simhash.near_duplicates(docs, key_rows=key_rows).collect()
        assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert simhash.near_duplicates(no_documents(spark)).collect() == []


@pytest.mark.parametrize("n", [10, 1 << 20, 1 << 30, 1 << 40])
def test_every_close_pair_shares_a_key(n):
    rng = random.Random(n)
    masks = simhash.key_masks(list(range(64)), simhash.blocks_for(n, 4), 4)
    for _ in range(200):
        flips = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not flips & m for m in masks)


def test_dense_group_links_stay_linear(spark):
    """All within a few bits of a centre: the forest has one link less than members per key."""
    centre = 0x0123456789ABCDEF
    fps = sorted({centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)})
    links = list(simhash.forest(np.array(fps, np.uint64), 4))
    assert sum(len(a) for a, _ in links) == len(fps) - 1


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 180)] + [(7, i) for i in range(1000, 1200)] + [(3, 3), (1000, 5)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[i] for i in range(100, 181)} == {100}
    assert {got[i] for i in [7, 5, *range(1000, 1200)]} == {5}
    assert 3 not in got


def test_lm_of_empty_and_untrained_tables(spark):
    rest = F.col("doc_id") % 7
    assert lm_scoring.score(no_documents(spark), rest != 2, rest == 5).collect() == []
    docs = odd_documents(spark, ["a b"]).where("doc_id in (2, 4, 100)")
    rows = {r.doc_id: r for r in lm_scoring.score(docs, F.lit(False), F.lit(False)).collect()}
    assert {i: (r.n_tokens, r.n_known, r.train_tokens) for i, r in rows.items()} == {
        2: (1, 0, 0), 4: (2, 0, 0), 100: (3, 0, 0)}
    assert all(math.isfinite(r.score) and r.base_score == 0.0 for r in rows.values())
