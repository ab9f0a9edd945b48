"""Archives, the pipeline, and the registered queries."""

import gzip
import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hourloom.llm import queries, substring_dedup, warc
from hourloom.llm.common import shared_path
from tests.llm.helpers import SCHEMA, odd_documents, words
from tests.llm.test_corpus_wide import brute_repeats

PAGES = "page_id long, url string, html string, id string, payload binary"


def odd_pages(spark):
    big = "<p>" + "page " * 400 + "</p>"
    trap = "\x1f\x00 " + "x" * 2000  # no gzip magic in text survives packing, see the stored block below
    rows = [(1, "http://a", big), (2, "http://b\r\nWARC-Type: bad", big), (3, None, big), (3, "http://c", big),
            (4, "http://d", "small"), (5, "http://d", "small"), (6, "u", None), (7, "u", ""), (None, "n", big),
            (8, "u", "é" * 500), (9, "u", "é" * 500), (10, "u", "é" * 499), (11, "u", trap), (12, "u", "y" * 3_000_000)]
    return spark.createDataFrame([(i, u, h, "id", None) for i, u, h in rows], PAGES)


def brute_archive(rows):
    last = defaultdict(lambda: -1)
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            last[b] = max(last[b], i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = last[b] if len(b) >= 1000 and i is not None and i < last[b] else None
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "response" if to is None else "revisit", to))
    return Counter(out)


@pytest.mark.parametrize("range_bytes", [97, 1000, 1 << 20])
def test_archives_round_trip_at_any_range(spark, range_bytes):
    pages = odd_pages(spark).where("page_id is null or page_id != 12") if range_bytes < 1000 else odd_pages(spark)
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    listed = warc.write_archives(pages, shared_path(spark, "t"))
    got = warc.read_archives(listed, range_bytes, payloads=True).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == brute_archive(rows)
    full = {r.page_id: r.payload for r in got if r.record_type == "response" and r.page_id is not None}
    assert all(bytes(full[i]) == (h or "").encode() for i, _, h in rows if i in full)
    assert listed.agg(F.sum("records")).first()[0] == len(rows)


def test_one_id_over_several_payloads(spark):
    a, b, c, d = (x * 600 for x in ("aa", "bb", "cc", "dd"))
    rows = [(1, a), (5, a), (5, b), (7, b), (5, "small"), (5, None), (5, c), (3, c), (2, d), (5, d), (8, d), (None, b)]
    pages = spark.createDataFrame([(i, "u", h, "id", None) for i, h in rows], PAGES)
    got = warc.read_archives(warc.write_archives(pages, shared_path(spark, "t")), payloads=True).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in got) == brute_archive([(i, "u", h) for i, h in rows])
    held = {(r.page_id, r.payload_digest): bytes(r.payload) for r in got if r.record_type == "response"}
    assert set(held.values()) == {(h or "").encode() for _, h in rows}
    assert all((r.refers_to, r.payload_digest) in held for r in got if r.record_type == "revisit")


def test_reader_rejects_false_members():
    """The magic inside stored data, and whole gzip members that hold no WARC header."""
    good = warc.record(1, "u", b"one", hashlib.sha1(b"one").hexdigest(), 3, None)
    inner = warc.record(2, "u", b"two", hashlib.sha1(b"two").hexdigest(), 3, None)
    body = warc.MAGIC * 5 + b"WARC/1.1 " + inner[:20]
    head = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:3>\r\nContent-Length: {len(body)}\r\n\r\n").encode()
    stored = gzip.compress(head + body + b"\r\n\r\n", compresslevel=0)
    data = good + gzip.compress(b"not a record") + stored + b"junk" + warc.MAGIC + good
    for step in (1, 7, 50, len(data)):
        found = []
        for at in range(0, len(data), step):
            found += [(h["warc-record-id"], b) for h, b in warc.records_in(
                lambda a, n: data[a:a + n], at, min(len(data), at + step), len(data))]
        assert [x for x in found if x[0] == "<urn:page:1>"] == [("<urn:page:1>", b"one")] * 2
        assert [x[1] for x in found if x[0] == "<urn:page:3>"] == [body]


def test_no_pages(spark):
    empty = spark.createDataFrame([], PAGES)
    assert warc.archive_and_read(empty).collect() == []


def test_pipeline_stages_take_effect(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs, sizes = documents, [documents.count()]
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.01")
        assert out.columns == documents.columns and [f.dataType for f in out.schema] == [f.dataType for f in documents.schema]
        docs = spark.createDataFrame(out.collect(), documents.schema)
        kept.append({r.doc_id: r for r in docs.collect()})
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4] > 0.7 * sizes[0]
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    was = {r.doc_id for r in documents.collect()}
    assert {i for i in was - set(kept[0]) if labels.get(i) == 1} == set()
    assert len({i for i in kept[0] if labels.get(i) == 0}) <= 2
    assert len({r.text for r in kept[1].values()}) == len(kept[1])
    want = {i: text for i, _, _, text in brute_repeats([(i, r.text) for i, r in kept[1].items()], 20)}
    assert {i: " ".join(words(r.text)) for i, r in kept[2].items()} == want
    for i, r in kept[1].items():  # what stays is as it was
        assert kept[2][i].text == r.text if len(words(want[i])) == len(words(r.text)) else len(kept[2][i].text) < len(r.text)
    assert any("\n" in r.text for r in kept[2].values())
    assert any(len(words(want[i])) < len(words(r.text)) for i, r in kept[1].items())
    items = [" ".join(words(r.text)) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    leaking = {i for i, r in kept[2].items() if any(f" {t} " in f" {' '.join(words(r.text))} " for t in items)}
    assert leaking and not leaking & set(kept[3])
    assert all(r.n_chars == len(r.text) for r in kept[2].values())
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: r.decoded_sha256 for r in encoded} == {
        i: hashlib.sha256(r.text.encode()).hexdigest() for i, r in kept[3].items()}


def test_pipeline_stages_take_odd_rows(spark, tmp_path):
    sf = str(tmp_path)
    docs = odd_documents(spark)
    spark.createDataFrame([(1, 1, 0), (4, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "tail alpha beta gamma delta epsilon"), (None, None)], "item_id long, text string").write.parquet(
        f"{sf}/benchmark.parquet")
    for given in (docs, spark.createDataFrame([], SCHEMA)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, given, sf)
            assert out.columns == given.columns, name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, given, sf).collect()
    one = {r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, sf).collect()}
    assert 5 in one and not {2, 3} & one and 1 in one  # empty texts form one group
    assert corpus_pipeline.one_of_each_group(spark, docs, sf).where("doc_id = 5").count() == 1
    left = corpus_pipeline.drop_contaminated(spark, docs, sf)
    assert left.count() == docs.count() - 1 and left.where("doc_id = 9").count() == 0


def test_pipeline_keeps_columns_of_any_name(spark, tmp_path):
    sf = str(tmp_path)
    rows = [(i, f"Good text number {i} with several words, and some more of them.\n\tIndented line {i}.", i, "a", 2.5, i) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __k long, `a``b.c` string, k double, `row` long")
    spark.createDataFrame([(i, 1, 0) for i in range(6)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "none of these words")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        got = {tuple(r) for r in out.collect()}
        assert got and got <= set(rows), name
    assert corpus_pipeline.STAGES[0][1](spark, docs, sf).columns == docs.columns


def test_cut_texts_keep_the_rest_byte_for_byte():
    text = "  one two\n\tthree  four five\r\nsix \n"
    cut = substring_dedup.without_spans
    assert cut(text, None, True) == (text, 6, 0) and cut(None, None, True) == (None, 0, 0)
    assert cut(text, [{"pos": 1, "stop": 3}], True) == ("  one four five\r\nsix \n", 6, 2)
    assert cut(text, [{"pos": 0, "stop": 1}, {"pos": 4, "stop": 6}], True) == ("  two\n\tthree  four  \n", 6, 3)
    assert cut(text, [{"pos": 1, "stop": 3}], False) == ("one four five six", 6, 2)
    assert cut("é ü", [{"pos": 0, "stop": 1}], True) == ("ü", 2, 1)


def test_registered_queries_run_over_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    n = {t: spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("documents", "pages")}
    conversations = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().count()
    for name, query in queries.QUERIES.items():
        rows = query(spark, sf)
        if name.startswith(("op2_", "op13_")):
            assert rows.count() > 0
        elif name.startswith("op11_"):
            assert rows.count() == conversations
        else:
            assert rows.count() == n["pages" if name.startswith("op10_") else "documents"], name
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
