"""Schema checks, missing values, range constraints and the projections around them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tabwright.functions.columns import is_missing
from tabwright.operators.ranking import ordered_rank
from tabwright.roles import Roles

FINDINGS = "check string, column string, severity string, n bigint"


def _dtypes(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def _is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, NumericType)


def missing_flag(df: DataFrame, column: str) -> Column:
    return is_missing(column, _dtypes(df)[column])


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, all in one pass."""
    columns = list(columns or df.columns)
    flags = [F.count_if(missing_flag(df, c)).alias(c) for c in columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_null")) for c in columns])
    return df.agg(*flags).select(F.inline(pairs))


def schema_diff(df: DataFrame, expected: Sequence[str]) -> list[tuple[str, str, str]]:
    """(issue, column, severity): expected but absent is an error, unexpected a warning."""
    have = df.columns
    missing = [("missing", c, "error") for c in expected if c not in have]
    return missing + [("extra", c, "warning") for c in have if c not in set(expected)]


def schema_findings(spark: SparkSession, df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """The schema difference as a table; computed as set differences of two name lists."""
    have = spark.createDataFrame([(c,) for c in df.columns], "column string")
    want = spark.createDataFrame([(c,) for c in expected], "column string")
    return want.subtract(have).select(F.lit("missing").alias("issue"), "column", F.lit("error").alias("severity")).unionByName(
        have.subtract(want).select(F.lit("extra").alias("issue"), "column", F.lit("warning").alias("severity"))
    )


def _findings(df: DataFrame, required: Sequence[str], numeric: Sequence[str], labels: Sequence[str], empty: bool) -> DataFrame:
    static = [("missing_column", c, "error", 1) for c in required if c not in df.columns]
    static += [("not_numeric", c, "error", 1) for c in numeric if c in df.columns and not _is_numeric(df, c)]
    static += [("numeric_categorical", c, "warning", 1) for c in labels if c in df.columns and _is_numeric(df, c)]
    present = [c for c in required if c in df.columns]
    flags = [F.count_if(missing_flag(df, c)).alias(f"n{i}") for i, c in enumerate(present)]
    measured = [("null_values", c, "warning", F.col(f"n{i}")) for i, c in enumerate(present)]
    if empty:
        measured.append(("empty", "*", "error", F.when(F.col("rows") == 0, 1).otherwise(0)))
    rows = F.array(
        *[
            F.struct(
                F.lit(check).alias("check"),
                F.lit(column).alias("column"),
                F.lit(severity).alias("severity"),
                (n if isinstance(n, Column) else F.lit(n)).cast("bigint").alias("n"),
            )
            for check, column, severity, n in static + measured
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("rows"), *flags).select(F.inline(rows)).filter("n > 0")


def findings(df: DataFrame, roles: Roles) -> DataFrame:
    """Everything wrong or odd with a training table, as (check, column, severity, n) rows, in one pass."""
    return _findings(df, roles.required, roles.numerical, roles.categorical, empty=True)


def model_input_findings(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """What a model would trip over: absent features, non-numeric features, missing values."""
    return _findings(df, expected, expected, (), empty=False)


def validate(df: DataFrame, roles: Roles) -> DataFrame:
    """Raise on an empty table, missing columns or non-numeric numericals; return the warnings.

    The findings are one row per column at most, so they fit the driver.
    """
    found = findings(df, roles).collect()
    errors = {check: [r["column"] for r in found if r["check"] == check] for check in ("empty", "missing_column", "not_numeric")}
    if errors["empty"]:
        raise ValueError("Input DataFrame is empty")
    if errors["missing_column"]:
        raise ValueError(f"Missing required columns: {errors['missing_column']}")
    if errors["not_numeric"]:
        raise ValueError(f"Column {errors['not_numeric'][0]} should be numeric")
    return df.sparkSession.createDataFrame([tuple(r) for r in found], FINDINGS)


def has_schema(df: DataFrame, expected: Sequence[str]) -> bool:
    return not any(issue == "missing" for issue, _, _ in schema_diff(df, expected))


def is_model_input(df: DataFrame, expected: Sequence[str]) -> bool:
    """True if every expected feature is there and numeric; missing values are only a warning."""
    return all(c in df.columns and _is_numeric(df, c) for c in expected)


def violations(ranges: Mapping[str, tuple[float, float]], required: Sequence[str] = ()) -> Column:
    """Names of the constraints a row breaks: a missing field, or a value outside [lo, hi]."""
    broken = [F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in dict.fromkeys([*required, *ranges])]
    broken += [
        F.when(~F.col(c).between(F.lit(lo), F.lit(hi)) | F.isnan(F.col(c).cast("double")), F.lit(f"{c} out of range"))
        for c, (lo, hi) in ranges.items()
    ]
    return F.array_compact(F.array(*broken))


def split_by_ranges(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]], required: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their violations); a field that is no column counts as missing."""
    for c in dict.fromkeys([*required, *ranges]):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("double"))
    checked = df.withColumn("violations", violations(ranges, required))
    ok = F.size("violations") == 0
    return checked.filter(ok).drop("violations"), checked.filter(~ok)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows without null or NaN."""
    return df.na.drop("any", subset=list(columns or df.columns))


def feature_list(df: DataFrame, roles: Roles, features: str = "declared") -> list[str]:
    """``declared`` uses the roles; ``all`` takes every column but target and key, leaks included."""
    if features == "declared":
        return [c for c in [*roles.passthrough, *roles.features] if c in df.columns]
    if features == "all":
        return [c for c in df.columns if c not in (roles.target, roles.key)]
    raise ValueError(f"Unknown feature selection: {features}")


def complete_columns(
    df: DataFrame, ordered: Sequence[str], key: str | None = None, counter: str = "instant", fill: float = 0
) -> DataFrame:
    """Add absent columns with ``fill``, number the rows 1..n in key order, keep ``ordered`` only.

    The numbering is a bucketed rank, so no single task sees the whole batch;
    without a key (a single request) the counter is 1.
    """
    if counter in ordered and counter not in df.columns:
        df = ordered_rank(df, key, name=counter) if key else df.withColumn(counter, F.lit(1).cast("bigint"))
    keep = [key] if key and key not in ordered else []
    return df.select(*keep, *[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in ordered])


def filter_tagged(df: DataFrame, status: str | None = None, tags: Mapping[str, str] | None = None) -> DataFrame:
    """Rows with the status (if given) and with every given tag."""
    conditions = [F.col("status") == status] if status is not None else []
    conditions += [F.col("tags")[k] == v for k, v in (tags or {}).items()]
    return df.filter(reduce(lambda a, b: a & b, conditions)) if conditions else df
