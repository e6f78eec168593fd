"""Shared pieces of the text operators: reading tables, mapping a function over texts, written intermediates."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_shared_path

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, passing: list[str] | None = None) -> DataFrame:
    """The rows of ``df`` as files of the shared folder, read back: lineage ends here and a lost executor loses
    nothing. The path is added to ``passing``, for :func:`delete_steps`.

    Shuffles below this step are not read again. Their files go with the end of the write; left to Spark's cleaner they
    would stay on the executors' disks until the driver collects garbage."""
    spark = df.sparkSession
    path = new_shared_path(spark, label)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    if passing is not None:
        passing.append(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_steps(spark: SparkSession, passing: list[str]) -> None:
    """Delete written steps. Only for steps whose every reader has been written itself."""
    context = spark.sparkContext
    for path in passing:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
    passing.clear()


def map_texts(
    df: DataFrame,
    keep: tuple[str, ...],
    text: str,
    make: Callable[[], Callable[[list[str | None]], dict[str, list]]],
    fields: dict[str, pa.DataType],
    rows: int = 512,
    size: int = 4 << 20,
) -> DataFrame:
    """The columns ``keep`` and the result columns ``fields`` for every row of ``df``.

    ``make`` is called once per task and returns a function from a list of texts to lists of results. It gets at most ``rows``
    texts at a time, and not more than ``size`` bytes of them unless a single text is longer. Rows are neither moved nor
    gathered. Only ``keep`` and ``text`` are read, so other columns may have any name.
    """
    clash = set(keep) & set(fields)
    if clash:
        raise ValueError(f"kept columns {sorted(clash)} have names of results; rename them first")
    spark = df.sparkSession
    slots = [f"kept_{i}" for i in range(len(keep))]
    inner = df.select(*[F.col(f"`{k}`").alias(s) for k, s in zip(keep, slots)], F.col(f"`{text}`").alias("text_in"))
    out = pa.schema(
        [pa.field(s, pa.null()) for s in slots] + [pa.field(k, v) for k, v in fields.items()]
    )
    types = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.float64(): "double",
             pa.bool_(): "boolean", pa.list_(pa.string()): "array<string>", pa.list_(pa.int32()): "array<int>"}
    kinds = dict(inner.dtypes)
    schema = ", ".join([f"{s} {kinds[s]}" for s in slots] + [f"`{k}` {types[v]}" for k, v in fields.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for batch in batches:
            for part in text_slices(batch, len(slots), rows, size):
                found = score(part.column(len(slots)).to_pylist())
                columns = [part.column(i) for i in range(len(slots))]
                columns += [pa.array(found[k], type=v) for k, v in fields.items()]
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    result = inner.mapInArrow(run, schema)
    return result.select(*[F.col(s).alias(k) for k, s in zip(keep, slots)], *[F.col(f"`{k}`") for k in fields])


def text_slices(batch: pa.RecordBatch, column: int, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``rows`` rows and ``size`` bytes in its text column; a longer text stands alone."""
    values = batch.column(column)
    if pa.types.is_list(values.type):
        lengths = pc.multiply(pc.list_value_length(values), values.type.value_type.bit_width // 8)
    else:
        lengths = pc.binary_length(values)
    filled = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at, before = 0, 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(filled, before + size, side="right"))
        stop = max(at + 1, min(at + rows, stop))
        yield batch.slice(at, stop - at)
        at, before = stop, int(filled[stop - 1])


def shingle_partitions(spark: SparkSession) -> int:
    """As many parts as the session's shuffles have; a cluster sets it by its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
