"""A training corpus out of raw documents: five stages, each one operator over all the last one kept.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``docs``; the last returns the encoded documents. Every stage takes null ids and texts,
empty texts, repeated rows, empty tables and further columns of any name, as its operator states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.llm import bpe_codec, decontamination, quality_ranking, simhash, substring_dedup
from hourloom.llm.common import release, staged, table
from hourloom.llm.queries import remainder


def plain(docs: DataFrame) -> tuple[DataFrame, list]:
    """The rows with columns c0, c1, ... and the way back, so that no name is in an operator's way."""
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    return docs.select(*[F.col("`" + c.replace("`", "``") + "`").alias(f"c{i}") for i, c in enumerate(docs.columns)]), back


def keyed(docs: DataFrame) -> tuple[DataFrame, list]:
    """:func:`plain` rows with k, a hash of the row's id and text."""
    rows, back = plain(docs)
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return rows.withColumn("k", simhash.row_key(at["doc_id"], at["text"])), back


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Bradley-Terry classifier predicts to be good."""
    model = quality_ranking.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    rows, back = plain(docs)
    whole = rows.select(F.struct("*").alias("row"), F.col(f"c{docs.columns.index('text')}").alias("t"))
    return quality_ranking.classify(whole, model, "row", "t").where("predicted = 1").select("row.*").select(*back)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash the one with the least id; of rows alike in id and text one."""
    found = simhash.near_duplicates(docs.select("doc_id", "text"), shingle=4, distance=4)
    chosen = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("group_key").agg(
        F.min("k").alias("k")).select("k")
    rows, back = keyed(docs)
    return rows.join(chosen, "k").dropDuplicates(["k"]).select(*back)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 20-word windows that also start earlier, the rest of each text byte for
    byte as it was; n_chars follows."""
    rows, back = plain(docs)
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    cut = substring_dedup.remove_repeats(rows, id_col=names["doc_id"], text_col=names["text"], verbatim=True)
    if "n_chars" in names:
        cut = cut.withColumn(names["n_chars"], F.length(names["text"]).cast(docs.schema["n_chars"].dataType))
    return cut.select(*back)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold neither four fifths of a benchmark item's words nor a long part of one."""
    leaked = decontamination.contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    rows, back = keyed(docs)
    return rows.join(leaked.select("k"), "k", "left_anti").select(*back)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document (little-endian uint32) with digests of the ids and of what they decode to."""
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe_codec.round_trip(docs, ranks, pattern).select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", reject_low_quality),
    ("simhash_near_dedup", one_of_each_group),
    ("substring_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: SQL can express neither the fitted classifier nor the encoder; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each stage's rows are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        release(spark)
    return docs
