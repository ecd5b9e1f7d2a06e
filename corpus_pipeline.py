"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before it
kept, and returns a DataFrame that is written as Parquet and read again. All but
the last return the columns of ``docs``, whatever further ones are called.

A null text counts as empty in every stage: an empty text is neither toxic nor holds a
line or passage to remove, is no duplicate of another, and stays. Null ids are the
smallest, rows that repeat an id are documents of their own, and no rows give none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagweave.llm import decontaminate, linededup, neardup, queries, toxicity
from tagweave.llm.common import staged


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance does not call toxic.

    The model is fitted on the labelled documents of the stage's own input. All stay
    if those show nothing to tell toxic documents by.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, queries.training_fold("doc_id"))
    if not model.weights:
        return docs
    scored = toxicity.score(docs.select(F.struct("*").alias("row"), F.col("text")), model)
    return scored.filter(F.col("score") < queries.TOXIC).select("row.*")


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many documents repeat; ``n_chars`` follows the text."""
    rows = docs.select("doc_id", "text", F.struct("*").alias("row"))
    kept = linededup.drop_repeated_lines(rows)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return kept.select(*[new.get(c.lower(), F.col("row").getField(c)).alias(c)
                         for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest doc_id.

    Of rows with that id, or without one, the smallest hash of the text decides, then any
    stays. Shingles have five words. Rows without words are no duplicates of each other.
    """
    rows = staged(docs.select(F.struct("*").alias("row")).withColumn(
        "number", F.monotonically_increasing_id()), "numbered")
    found = neardup.near_duplicates(rows.select("number", "row.text"), id_column="number")
    text = F.coalesce(F.col("row.text"), F.lit(""))
    order = rows.select("number", F.struct("row.doc_id", F.xxhash64(text), "number").alias("o"))
    kept = (found.select(F.col("doc_id").alias("number"), "component_id").join(order, "number")
            .groupBy("component_id").agg(F.min("o").alias("o"))
            .select(F.col("o.number").alias("number")))
    return rows.join(kept, "number", "left_semi").select("row.*")


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; without items all stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = docs.select(F.struct("*").alias("row"), F.col("text"))
    found = decontaminate.find_benchmark(rows, benchmark)
    return found.filter(F.col("found.n_hit") == 0).select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, as the query of the packing operator returns them."""
    return queries.packed_pieces(docs)


STAGES = [("toxicity", toxic), ("line dedup", repeated_lines),
          ("near duplicates", near_duplicates), ("decontamination", benchmark_passages),
          ("packing", packed)]

#: SQL cannot express compression distances or tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
