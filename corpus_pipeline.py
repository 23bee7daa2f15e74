"""Corpus pipeline: five stages over `documents`, each written as Parquet and read by the next.

1. quality_classifier: the positive-unlabelled classifier; rejected documents go.
2. quality_rules: base rules and the voting rules; rejected documents go.
3. near_duplicates: one document of each group stays (the one with the smallest id; documents without an id
   come last, ordered by a hash of their text). Five-word shingles, similarity of 0.8 or more. Texts without
   words are duplicates of nothing, but equal rows (same id and text) are one document.
4. decontamination: documents that hold a passage of `benchmark` go.
5. packing: the ids of what is left, packed into sequences of at most 2048.

All stages but the last return the columns of `documents`, whatever they are. NULL texts are texts without
words and fail the base rules of stage 2. Empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontamination, quality_pu, quality_rules, staging
from tickloom.llm.jaccard_groups import jaccard_components
from tickloom.llm.packing import packed_documents
from tickloom.llm.workers import ship


_LEFT: list[str] = []


def _stage(function: Callable) -> Callable:
    """A stage that first deletes the intermediate tables of the stage before.

    That one's result has been written by then, as each stage reads what the one before wrote; only
    the tables that a stage itself has made are touched.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        staging.delete(_LEFT)
        others = staging.made()
        out = function(spark, docs, sf_dir)
        _LEFT[:] = [path for path in staging.made() if path not in others]
        return out

    return run_stage


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = quality_pu.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_pu.keep_good(docs, model)


@_stage
def weighted_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    key = F.coalesce(F.col("doc_id").cast("long"), text_hash.bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(1 << 62))
    keyed = docs.select(key.alias("key"), text_hash.alias("tag"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = jaccard_components(keyed.withColumn("text", F.col("row.text")), size=5, num=80, den=100, id_col="key", carry=("tag",))
    # The two columns of a kept document name its row; equal rows are one. Groups go by label, as two of
    # them have the same least id where one id has unlike texts.
    least = found.where("node is not null").groupBy("label").agg(F.min(F.struct(F.col("id").alias("key"), "tag")).alias("least"))
    kept = least.select("least.*").union(found.where("node is null").select("id", "tag").distinct())
    one = keyed.join(kept, ["key", "tag"]).dropDuplicates(["key", "tag"])
    return one.select(*[F.col(f"row.`{c}`") for c in docs.columns])


@_stage
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", weighted_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("packing", packing),
]

#: The classifier, the tokenizer and the packing have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the result is the last stage's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = staging.new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
