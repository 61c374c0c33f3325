"""Shared folder, written tables and Arrow helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


#: Bytes of an Arrow batch between Spark and a Python worker; Spark's own default is 64 MB, of which a task holds several.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as a URI: ``spark.checkpoint.dir``, or else the context's checkpoint folder.

    A path without a scheme is one of the default file system, as Spark reads it.
    Where neither is set, a local session gets a temporary folder as its
    checkpoint folder; on a cluster that folder would be another on each machine,
    so the call raises.
    """
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not at:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="rostrum-"))
        at = context.getCheckpointDir()
    path = context._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/rostrum/{name}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to :data:`BATCH_BYTES`, unless it asks for less."""
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_CONF)) > BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts lineage, survives executors."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = fresh_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what :func:`materialise` wrote; only where nothing lazy reads it any more."""
    for df in frames:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spare_names(taken: list[str], *names: str) -> list[str]:
    """Names for an operator's own columns that no column of the caller has, whatever its case."""
    used = {x.lower() for x in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def chunks(batches: Iterator[pa.RecordBatch], column: str | int, limit: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` (text or binary, by name or place) holds about ``limit`` bytes in each; at least one row."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ends = offsets(batch.column(column))
        start = 0
        while start < n:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def offsets(array: pa.Array) -> np.ndarray:
    """Byte offsets of a text or binary array, one more than its rows, as they stand in its buffer."""
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    kind = np.int64 if wide else np.int32
    if array.buffers()[1] is None:
        return np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(array.buffers()[1], kind, len(array) + 1, array.offset * np.dtype(kind).itemsize).astype(np.int64)


def raw_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in one array, and offsets from 0; null rows are empty."""
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    at = offsets(array)
    data = array.buffers()[2]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8, int(at[-1] - at[0]), int(at[0])), at - at[0]


def text_list(array: pa.Array) -> list[str]:
    """Texts of a column, null as the empty text."""
    return ["" if x is None else x for x in array.to_pylist()]


def filesystem(uri: str):
    """The file system and path of a URI in the shared folder, for Python code on executors."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri.removeprefix("file:"))


class Output:
    """A file that appears under ``uri`` as a whole when the block ends well, and not at all otherwise.

    Each attempt of a task asks for a name of its own, so that a lost or doubled
    attempt never touches the file of another; only names that a finished task
    reported are read.
    """

    def __init__(self, uri: str):
        self.fs, self.path = filesystem(uri)

    def __enter__(self):
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.stream = self.fs.open_output_stream(self.path + ".part", compression=None)
        return self.stream

    def __exit__(self, kind, value, trace):
        self.stream.close()
        if kind is None:
            self.fs.move(self.path + ".part", self.path)
        else:
            self.fs.delete_file(self.path + ".part")


def open_input(uri: str):
    """A seekable stream over a file of the shared folder."""
    fs, path = filesystem(uri)
    return fs.open_input_file(path)


def bit_table(rows: DataFrame, bit, size: int) -> tuple[bytes, float]:
    """A table of ``size`` bits (a power of two) with those of the column ``bit`` set, and the share that is set.

    The driver gets at most ``size / 64`` rows, however many there are.
    """
    from pyspark.sql import functions as F

    words = np.zeros(size // 64, np.uint64)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    for word, bits in rows.groupBy(F.floor(bit / 64).cast("long").alias("word")).agg(F.bit_or(one)).collect():
        words[word] = bits & (1 << 64) - 1
    return words.tobytes(), float(np.bitwise_count(words).sum()) / size


def has_bit(table: bytes, bit: np.ndarray) -> np.ndarray:
    """Whether each of the bits is set."""
    words = np.frombuffer(table, np.uint64)
    return (words[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
