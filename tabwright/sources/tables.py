"""Reading and writing row tables: CSV, Parquet, JSON rows, snapshots and metric tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

METRICS_SCHEMA = StructType(
    [StructField("scope", StringType()), StructField("metric", StringType()), StructField("value", DoubleType())]
)


def read_rows(
    spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str | None = None, require_rows: bool = False
) -> DataFrame:
    """Read a CSV (with header), Parquet or JSON table.

    Without a schema a CSV is inferred, which costs one more pass over the file.
    A missing path raises ``FileNotFoundError``; ``require_rows`` also refuses an
    empty table.
    """
    fmt = fmt or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if fmt not in ("csv", "parquet", "json"):
        raise ValueError(f"Unknown format: {fmt}")
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
        if schema is None:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise
    if require_rows and df.isEmpty():
        raise ValueError(f"No rows in {path}")
    return df


def write_rows(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").partitionBy(*(partition_by or []))
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    """Keep a reference copy with its types, for later drift checks."""
    df.write.mode("overwrite").parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return read_rows(spark, path, fmt="parquet")


def parse_json_rows(df: DataFrame, column: str, schema: StructType | str, into: str = "record") -> DataFrame:
    """Parse a JSON text column; text that does not parse is kept in ``corrupt_record``."""
    schema = schema if isinstance(schema, str) else schema.simpleString()[len("struct<") : -1].replace(":", " ")
    parsed = F.from_json(F.col(column), f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE"})
    return (
        df.withColumn(into, parsed)
        .withColumn("corrupt_record", F.col(f"{into}._corrupt_record"))
        .withColumn(into, F.col(into).dropFields("_corrupt_record"))
    )


def json_array_rows(df: DataFrame, column: str, schema: str, into: str = "record") -> DataFrame:
    """One row per record of a JSON text holding either one object or a list of objects."""
    text = F.trim(F.col(column))
    as_list = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    return df.withColumn(into, F.explode(F.from_json(as_list, f"array<struct<{schema}>>")))


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    metrics.select(*METRICS_SCHEMA.names).write.mode(mode).json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).json(path)


def merge_metrics(**scopes: DataFrame) -> DataFrame:
    """Union of (metric, value) tables, each labelled with its scope."""
    merged = None
    for scope, metrics in scopes.items():
        part = metrics.select(F.lit(scope).alias("scope"), "metric", "value")
        merged = part if merged is None else merged.unionByName(part)
    return merged


def as_json(df: DataFrame, *columns: str, name: str = "report") -> DataFrame:
    """Each row as one JSON text."""
    picked: list[str | Column] = list(columns or df.columns)
    return df.select(F.to_json(F.struct(*picked)).alias(name))


def write_report(df: DataFrame, path: str) -> None:
    """Any result table as JSON lines; nulls are written, so that every row has the same keys."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
