"""A token table: where each word of a table of texts stands, so that searches read postings instead of texts.

Texts are folded as the search language folds them (lower case, no marks, other
signs as spaces). The table has ``token``, ``id`` and ``pos`` and is laid out in
folders by a hash of the token; files within a folder are sorted by token, so that
a look-up reads one folder and, by the statistics of its row groups, little of it.
Frequent words are dealt to several files by a hash of the id. A phrase is a join
of its words on the text and the place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.plans import lang

BUCKETS, FILES = 256, 4


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def postings(df: DataFrame, key: str, text: str) -> DataFrame:
    """``token``, ``id``, ``pos``: a row for each word of each text; null and empty texts have none."""
    words = F.split(F.trim(lang.folded(F.col(text))), " ")
    return df.select(F.col(key).alias("id"), F.posexplode(words).alias("pos", "token")).where("token <> ''").select("token", "id", "pos")


def build(df: DataFrame, key: str, text: str, path: str, buckets: int = BUCKETS) -> str:
    """Write the token table of ``df``; returns its path."""
    rows = postings(df, key, text).withColumn("bucket", _bucket(F.col("token"), buckets))
    dealt = rows.repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(FILES))).sortWithinPartitions("bucket", "token", "id", "pos")
    dealt.write.partitionBy("bucket").option("maxRecordsPerFile", 50_000_000).parquet(path)
    return path


class Tokens:
    """Look-ups in a token table."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.rows, self.buckets = spark.read.parquet(path), buckets

    def word(self, token: str) -> DataFrame:
        """``id`` and ``pos`` of a folded word; the folder is known before the plan runs."""
        return self.rows.where((F.col("bucket") == _bucket(F.lit(token), self.buckets)) & (F.col("token") == token)).select("id", "pos")

    def term(self, text: str) -> DataFrame:
        """Distinct ``id`` of the texts that have a word, or adjacent words."""
        folded = self.rows.sparkSession.range(1).select(F.trim(lang.folded(F.lit(text))).alias("t")).first().t
        if not folded:
            return self.rows.where("false").select("id")
        first, *others = folded.split(" ")
        out = self.word(first)
        for i, w in enumerate(others, 1):
            out = out.join(self.word(w).select("id", (F.col("pos") - i).cast("int").alias("pos")), ["id", "pos"], "left_semi")
        return out.select("id").distinct()

    def ids(self, tree: lang.Term | lang.Pair) -> DataFrame:
        """Distinct ``id`` of the texts that an expression holds for."""
        if isinstance(tree, lang.Term):
            return self.term(tree.text)
        left, right = self.ids(tree.left), self.ids(tree.right)
        return left.join(right, "id", "left_semi") if tree.op == "AND" else left.union(right).distinct()
