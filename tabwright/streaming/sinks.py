"""Running streams into tables.

Every micro-batch writes its own ``batch=<id>`` folder with overwrite, so a batch
that is repeated after a failure replaces itself. Results of update-mode
aggregations are read back as the newest row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tabwright.lineage import is_folder
from tabwright.sources.tables import read_rows

BATCH = "batch"


def read_stream(spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A file table as a stream; without a schema that of the files present is taken.

    File streams watch folders, so a path that names one file is watched through its parent.
    """
    schema = schema or read_rows(spark, path, fmt=fmt).schema
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if not is_folder(spark, path):
        parent, name = path.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).load(parent)
    return reader.load(path)


def _trigger(every: str | None) -> Mapping:
    return {"processingTime": every} if every else {"availableNow": True}


def run_into(
    stream: DataFrame, outputs: Mapping[str, Callable[[DataFrame], DataFrame]], checkpoint: str, mode: str = "append", every: str | None = None,
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> StreamingQuery:
    """Start a query that writes each micro-batch, transformed, to one or more table paths, in that order.

    Without ``every`` the query takes what is there and ends; wait with ``awaitTermination``.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        if len(outputs) > 1:
            rows.persist()
        try:
            for path, transform in outputs.items():
                columns = list((partition_by or {}).get(path, ()))
                transform(rows).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}", partitionBy=columns)
        finally:
            if len(outputs) > 1:
                rows.unpersist()

    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**_trigger(every)).foreachBatch(write).start()


def append_to(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start an append-only query with the exactly-once file sink."""
    return (
        stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start(path)
    )


def table_of(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of all micro-batches, with their ``batch`` number."""
    kept = [f for f in schema.fields if f.name != BATCH]
    return spark.read.schema(StructType([*kept, StructField(BATCH, LongType())])).parquet(path)


def latest_of(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], only: Column | None = None) -> DataFrame:
    """Newest row per key of an update-mode result; ``only`` picks folders or keys before."""
    values = [f.name for f in schema.fields if f.name not in (*keys, BATCH)]
    newest = F.max_by(F.struct(*values), BATCH).alias("v")
    rows = table_of(spark, path, schema)
    return (rows if only is None else rows.filter(only)).groupBy(*keys).agg(newest).select(*keys, "v.*")


