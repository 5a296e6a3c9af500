"""From documents to packed training sequences: five stages, each written as Parquet and reread as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontaminate, neardup, packing, quality, substrings
from lodestone.llm.common import discard, materialise, scratch, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
OTHERS = COLUMNS[1:]


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    net = quality.train(docs, table(spark, sf_dir, "labels"), label_col="quality")
    return quality.score(docs, net, threshold=0.7, carry=OTHERS).filter("predicted = 1").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one of the least id. Rows without an id stay."""
    gone = neardup.near_duplicates(docs, k=5, percent=75).filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that occur earlier go; a text that loses none stays as it is."""
    found = substrings.remove_repeats(docs, window=20, verbatim=True, carry=("lang", "source", "n_chars"))
    chars = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("n_chars"))
    return found.select("doc_id", F.col("kept").alias("text"), "lang", "source", chars.cast(docs.schema["n_chars"].dataType).alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more stands in benchmark items go."""
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), window=13, share=20, carry=OTHERS)
    return found.filter("not contaminated").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of what is left."""
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)
    return packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity=2048)


STAGES = [
    ("quality_classifier", drop_low_quality),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: SQL can express neither the classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other. What a stage wrote for itself, and the documents it read, are deleted when its own result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark):
            after = materialise(stage(spark, docs, sf_dir), name, stays=True)
        discard(docs)
        docs = after
    return docs
