"""What the operators share: the folder all executors see, word rules, Arrow helpers."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

#: A word is a run of anything but ASCII white space; bytes.split() cuts UTF-8 the same way.
WORD = r"[^\x20\x09-\x0D]+"
#: With this, Spark deletes a finished query's shuffle files at once, not when the driver collects garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: UTF-8 bytes that a numpy pass holds at once.
SLICE_BYTES = 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """df; its session, where it has Spark's own bound of 64 MB, sends no more than 4 MB at a time to Python: texts are large."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_BYTES).lower() in ("67108864b", "67108864", "64m", "64mb"):
        conf.set(BATCH_BYTES, "4m")
    return df


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where none is set, a local folder for a local master (tests) alone."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if spark.sparkContext.getCheckpointDir():
            return spark.sparkContext.getCheckpointDir()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        where = "file://" + tempfile.mkdtemp(prefix="ionloom-")
        spark.sparkContext.setCheckpointDir(where)
    return where


@contextlib.contextmanager
def swept(spark: SparkSession):
    """Queries that are made in here delete what they have shuffled as soon as they end."""
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def kept(df: DataFrame, what: str) -> DataFrame:
    """df written to the shared folder and read again: the lineage ends there, in files that survive lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    with swept(df.sparkSession):  # what this write has shuffled, no later step reads
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bytes_of(frame: DataFrame) -> int:
    """Bytes of the files that kept() wrote."""
    jvm = frame.sparkSession._jvm
    conf = frame.sparkSession._jsc.hadoopConfiguration()
    total = 0
    for f in frame.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(f)
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total


def crc_mod(column, n: int):
    """crc32 of an id as text, modulo n; null for a null id."""
    return F.crc32(column.cast("string").cast("binary")) % n


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(binary).to_pylist()]


def slices(sizes: list[int], limit: int = SLICE_BYTES):
    """(from, to) over rows, each of about limit bytes and one row at least."""
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > limit:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES):
    """(from, to, UTF-8 bytes of each text) over a string column, about limit bytes at a time; no more is copied."""
    sizes = [x or 0 for x in pc.binary_length(column).to_pylist()]
    for lo, hi in slices(sizes, limit):
        yield lo, hi, texts(column.slice(lo, hi - lo))


def flat(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all items in one array, and where each starts (one more than items)."""
    starts = np.zeros(len(items) + 1, np.int64)
    np.cumsum([len(x) for x in items], out=starts[1:])
    return np.frombuffer(b"".join(items), np.uint8), starts


def record_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
