"""A training corpus from raw documents: five operators, each on what the one before kept."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.mixing import mixed_rows
from newsloom.llm.near_dedup import near_duplicates
from newsloom.llm.packing import pack
from newsloom.llm.scratch import Scratch
from newsloom.llm.substring_dedup import remove_repeats
from newsloom.llm.toxicity import fit_toxicity, held_out, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. It learns from the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(docs, labels.where(~held_out(F.col("doc_id"))))
    scored = toxicity(docs, model, carry=True, score_col="_score", predicted_col="_predicted")
    return scored.where("_predicted = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity 0.8 or more) the smallest doc_id stays."""
    found = near_duplicates(docs, share=(8, 10))
    gone = found.where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of windows that also start earlier go from the texts; every document stays, maybe with an empty text.

    Rows of one id with different texts are left as they are.
    """
    found = remove_repeats(docs).groupBy("doc_id").agg(F.min("kept_sha256").alias("_low"), F.max("kept_sha256").alias("_high"), F.max("n_removed").alias("_n"), F.max("kept").alias("_kept"))
    changed = found.where("_kept IS NOT NULL AND _n > 0 AND _low = _high").select("doc_id", "_kept")
    joined = docs.join(changed, "doc_id", "left")
    text = F.coalesce("_kept", "text")
    new = {"text": text, "n_chars": F.when(F.col("_kept").isNotNull(), F.length("_kept").cast("long")).otherwise(F.col("n_chars"))}
    return joined.select(*(new.get(c, F.col(c)).alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, put in the order of a schedule whose every prefix has the sources' target weights."""
    return mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 1024 tokens, which are numbered in the mixed order.

    That order is the one of files and rows. Documents that come from no files
    have none and are taken by a hash of their ids.
    """
    try:
        placed = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return pack(docs)
    return pack(placed, order=("_file", "_row"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A language model's fit and a packing plan are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over documents; each stage is written before the next one reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.write(docs, name)
    return docs
