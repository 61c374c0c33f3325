"""A training corpus from raw documents: five stages, each over all that the one before kept.

The first four return the columns of the documents they got, whatever further ones
there are and whatever these are called; the last has a row for each document of
the fourth. Empty tables give empty ones. Texts are taken whole, however long.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.llm import bpe, decontaminate, jaccard_join, line_dedup, toxicity
from rostrum.llm.runtime import materialise


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below one half; null and empty texts have the score of the bias alone."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many sources carry; ``n_chars``, where it is there, follows the text.

    Null texts and their ``n_chars`` are null, rows of null source count for no line.
    """
    cleaned = line_dedup.dedup_lines(docs, counts=False)
    if "n_chars" not in docs.columns:
        return cleaned
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumn("n_chars", length).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity of 0.8 and more) the document of the smallest id.

    Of equal rows one stays; null and wordless texts all stay.
    """
    return jaccard_join.drop_near_duplicates(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark; null and wordless texts hold none."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, digested after a round trip; a null text counts as empty."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", tokenize),
]

#: No SQL says what the classifier and the encoder do: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is a written table in the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
