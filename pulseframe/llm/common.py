"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.session import scratch_path, ship_package

#: One white space character and one word, as byte or character classes.
SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"


#: Bytes of an Arrow batch, about: Python tasks hold a few of them, as lists, besides their own state.
BATCH_BYTES = "8m"


def prepared(spark: SparkSession) -> SparkSession:
    """Ships the package to the workers and bounds the batches that they get."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def by_batch(
    df: DataFrame, make: Callable[[], Callable[..., dict[str, list] | None]], schema: str
) -> DataFrame:
    """Each Arrow batch as lists of its columns to a dict of output columns.

    ``make`` runs once per task and returns the function for the batches.
    """
    arrow = pa_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                out = step(*(c.to_pylist() for c in batch.columns))
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return df.mapInArrow(run, schema)


def pa_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def table_of(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    """A batch of the schema's names and types."""
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def vector_matrix(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length of vector in a batch: those without null or non-finite entries."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    for dims in np.unique(lengths[lengths >= 0]):
        rows = np.nonzero(lengths == dims)[0]
        # A null entry becomes NaN, so it counts as not finite.
        values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        values = np.asarray(values, np.float64).reshape(len(rows), dims)
        usable = np.isfinite(values).all(axis=1)
        if usable.any():
            yield rows[usable], values[usable]
