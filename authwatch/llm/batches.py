"""Arrow batches between Spark and NumPy, and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that are handled at once; a longer text forms a batch alone.
BATCH_BYTES = 4 << 20


def map_batches(df: DataFrame, run: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """``run`` on batches of bounded size; it yields batches of ``schema``."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in split_by_size(batch):
                yield from run(piece)
    return df.mapInArrow(over, schema)


def split_by_size(batch: pa.RecordBatch, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Halves of a batch until each is small or a single row."""
    if batch.num_rows > 1 and batch.get_total_buffer_size() and batch.nbytes > limit:
        middle = batch.num_rows // 2
        yield from split_by_size(batch.slice(0, middle), limit)
        yield from split_by_size(batch.slice(middle), limit)
    elif batch.num_rows:
        yield batch


def encoded(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null counts as empty."""
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def texts(column: pa.Array) -> list[str]:
    """Texts; null counts as empty."""
    return column.fill_null("").to_pylist()


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def shared_folder(spark: SparkSession) -> str:
    """URI of ``spark.checkpoint.dir``, the folder that all executors share.

    Only where it is unset and the master is local, a temporary folder is used.
    """
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="llm-"))
    return context._jsc.sc().getCheckpointDir().get()


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a new folder below the shared one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    uri = path.toString()
    return uri if "://" in uri else "file://" + uri.removeprefix("file:")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def write_table(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet to a new folder that all executors share, and reread.

    The shuffle files of the job are removed when it ends. ``batch_rows`` bounds the rows
    that go to Python at once, where rows are wide and the task holds much beside them.
    """
    spark, path = df.sparkSession, f"{new_folder(df.sparkSession, name)}/rows"
    before = {CLEANUP: spark.conf.get(CLEANUP, "false"), BATCH_ROWS: spark.conf.get(BATCH_ROWS)}
    spark.conf.set(CLEANUP, "true")
    if batch_rows is not None:
        spark.conf.set(BATCH_ROWS, str(batch_rows))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def keep_table(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the folder that all executors share."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
