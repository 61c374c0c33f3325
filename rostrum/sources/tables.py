"""Tables in and out: Parquet, CSV and JSON lines, versions instead of overwriting, manifests."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.functions.scalars import bar, capped


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``); on a local session without one, a temporary folder."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="rostrum-")
    return f"{at.rstrip('/')}/rostrum/{name}-{uuid.uuid4().hex}"


def read_days(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """All daily files of a folder as one table; the date of a file that has none comes from its name.

    With a ``schema`` no footer is read beforehand; without one those of all files are merged.
    """
    df = spark.read.schema(schema).parquet(path) if schema else spark.read.option("mergeSchema", "true").parquet(path)
    named = F.to_date(F.regexp_extract(F.col("_metadata.file_name"), r"(\d{4}-\d{2}-\d{2})", 1))
    return df.withColumn("date", F.coalesce(F.col("date").cast("date"), named) if "date" in df.columns else named)


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The columns of a schema in its order: missing ones are NULL, others go, values that don't fit become NULL."""
    target = df.sparkSession.createDataFrame([], schema).schema
    return df.select(*((F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in target))


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A CSV lookup, all texts, in the order of the file as ``ordinal``."""
    df = spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    #: splits of a file have ascending blocks; of several files the name decides
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row"))
    return df.withColumn("ordinal", place)


def write_both(df: DataFrame, path: str) -> None:
    """Parquet by chamber (if there is one) and CSV."""
    w = df.write.mode("overwrite")
    (w.partitionBy("chamber") if "chamber" in df.columns else w).parquet(f"{path}/parquet")
    df.write.mode("overwrite").option("header", "true").csv(f"{path}/csv")


def replace_days(df: DataFrame, path: str, by: tuple[str, ...] = ("chamber", "date")) -> None:
    """Days that ``df`` has are replaced as a whole, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def new_version(df: DataFrame, root: str) -> str:
    """Write to a new version of a table, never over what is being read; returns its path."""
    path = f"{root}/v-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def _replace(spark: SparkSession, path: str, text: str) -> None:
    """A small file that readers see as it was or as it will be: written beside and renamed over."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    new, old = hadoop.Path(f"{path}.{uuid.uuid4().hex}"), hadoop.Path(path)
    out = new.getFileSystem(conf).create(new)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(new.getFileSystem(conf).getUri(), conf).rename(new, old, options)


def _content(spark: SparkSession, path: str) -> str | None:
    """A small file as text, None if there is none."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, root: str, version: str) -> None:
    """Make a version of :func:`new_version` the current one; who reads the one before goes on undisturbed."""
    _replace(spark, f"{root}/_current", version)


def current(spark: SparkSession, root: str) -> DataFrame:
    """The current version of a table."""
    return spark.read.parquet(_content(spark, f"{root}/_current"))


def rewrite(spark: SparkSession, root: str, change: Callable[[DataFrame], DataFrame]) -> str:
    """Read the current version, change it, write the next one and make it current."""
    path = new_version(change(current(spark, root)), root)
    publish(spark, root, path)
    return path


def manifest(spark: SparkSession, path: str) -> dict:
    """The entries of a manifest, none if there is no file."""
    return json.loads(_content(spark, path) or "{}")


def update_manifest(spark: SparkSession, path: str, entries: dict) -> dict:
    """Set entries of a manifest by one rename."""
    now = manifest(spark, path) | entries
    _replace(spark, path, json.dumps(now, sort_keys=True))
    return now


def write_results(df: DataFrame, path: str, source: str = "match_source") -> None:
    """Matches and the turns that exchanges pulled in, as two CSV tables."""
    hit = F.col(source) == "search"
    for name, cond in (("matches", hit), ("exchanges", ~hit)):
        df.where(cond).write.mode("overwrite").option("header", "true").csv(f"{path}/{name}")


def export(df: DataFrame, columns: list[str], order: list[str], rows: int = 100) -> DataFrame:
    """The first rows of a download; long texts are capped."""
    have = [c for c in columns if c in df.columns]
    texts = {c for c, t in df.dtypes if t == "string"}
    return df.orderBy(*order).limit(rows).select(*(capped(F.col(c)).alias(c) if c in texts else F.col(c) for c in have))


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Links within the site, in the order of the page."""
    found = F.regexp_extract_all(html, F.lit('href="(/[^"]*)"'), F.lit(1))
    return pages.select(key, F.posexplode(found).alias("pos", "link")).select(key, (F.col("pos") + 1).alias("pos"), "link")


def bars(counts: DataFrame, label: str, n: str) -> DataFrame:
    """Lines of a text summary: label, count and a bar."""
    most = counts.agg(F.max(n).alias("_m"))
    return counts.join(F.broadcast(most)).select(label, n, bar(F.col(n), F.col("_m")).alias("bar"))


def sitting_days(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Weekdays of a range."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date"))
    return days.where(F.weekday("date") < 5)
