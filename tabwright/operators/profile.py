"""Descriptive statistics, duplicate and missing rates, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tabwright.lineage import cut
from tabwright.operators.checks import missing_flag
from tabwright.operators.joins import spread_join
from tabwright.operators.quantiles import quantiles
from tabwright.operators.ranking import running_totals


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, stat, value): count, mean, sample std, min, quartiles, max and missing values."""
    columns = list(columns or numeric_columns(df))
    exprs, rows = [], []
    for i, c in enumerate(columns):
        x = F.when(~missing_flag(df, c), F.col(c).cast("double"))
        stats = {
            "count": F.count(x).cast("double"),
            "mean": F.avg(x),
            "std": F.stddev_samp(x),
            "min": F.min(x),
            "max": F.max(x),
            "null_count": F.count_if(missing_flag(df, c)).cast("double"),
        }
        for stat, expr in stats.items():
            exprs.append(expr.alias(f"{stat}{i}"))
            rows.append(F.struct(F.lit(c).alias("column"), F.lit(stat).alias("stat"), F.col(f"{stat}{i}").alias("value")))
    moments = df.agg(*exprs).select(F.inline(F.array(*rows)))
    names = {0.25: "25%", 0.5: "50%", 0.75: "75%"}
    stat = F.when(F.col("prob") == 0.25, names[0.25]).when(F.col("prob") == 0.5, names[0.5]).otherwise(names[0.75])
    return moments.unionByName(quantiles(df, columns, list(names)).select("column", stat.alias("stat"), "value"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def column_types(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")


def duplicate_rate(df: DataFrame) -> DataFrame:
    """Rows beyond the first copy, over all rows.

    Grouping by all columns combines copies on the map side, so a row repeated
    a billion times costs no more than any other; nulls compare equal.
    """
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("n_rows"),
        (F.coalesce(F.sum("_copies"), F.lit(0)) - F.count(F.lit(1))).cast("bigint").alias("n_duplicates"),
    ).withColumn("duplicate_rate", F.coalesce(F.try_divide(F.col("n_duplicates").cast("double"), F.col("n_rows")), F.lit(0.0)))


def missing_rate(df: DataFrame) -> DataFrame:
    """Missing cells per row (may exceed 1) and per cell."""
    cells = sum((missing_flag(df, c).cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(cells), F.lit(0)).cast("bigint").alias("n_missing")
    )
    missing = F.col("n_missing").cast("double")
    return counted.withColumns(
        {
            "missing_per_row": F.coalesce(F.try_divide(missing, F.col("n_rows")), F.lit(0.0)),
            "missing_per_cell": F.coalesce(F.try_divide(missing, F.col("n_rows") * len(df.columns)), F.lit(0.0)),
        }
    )


def correlations(df: DataFrame, columns: Sequence[str] | None = None, method: str = "pearson") -> DataFrame:
    """(a, b, correlation) for every pair of numeric columns.

    Pearson is one aggregation; Spearman is the Pearson correlation of average
    ranks, over rows that have a number in every column.
    """
    columns = list(columns or numeric_columns(df))
    if method == "spearman":
        return _spearman(df, columns)
    if method != "pearson":
        raise ValueError(f"Unknown correlation method: {method}")
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[_correlation(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("correlation")) for i, (a, b) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*rows)))


def _correlation(a: str, b: str) -> Column:
    """Pearson's correlation over rows that have both; null where one does not vary (``corr`` divides by zero there)."""
    x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def mid_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``_r<i>``: the tie-averaged rank of column i, over rows that have a number in every column.

    Ranks come from value counts and their running totals, and go back to the rows by
    joins that spread frequent values.
    """
    number = [F.col(c).cast("double") for c in columns]
    rows = df.select(*((x + F.lit(0.0)).alias(f"_x{i}") for i, x in enumerate(number)))
    for i in range(len(columns)):
        rows = rows.filter(f"_x{i} is not null and not isnan(_x{i})")
    pairs = F.array(*[F.struct(F.lit(i).alias("column"), F.col(f"_x{i}").alias("_v")) for i in range(len(columns))])
    counts = cut(rows.select(F.inline(pairs)).groupBy("column", "_v").agg(F.count(F.lit(1)).alias("n")))
    ranked = cut(running_totals(counts, ["column"], "_v", ["n"]))
    middle = F.col("upto_n") - (F.col("n") - 1) / 2
    for i in range(len(columns)):
        mine = ranked.filter(F.col("column") == i).select(F.col("_v").alias(f"_x{i}"), "n", middle.alias(f"_r{i}"))
        rows = spread_join(rows, mine, f"_x{i}", "n").drop(f"_x{i}", "n")
    return rows


def _spearman(df: DataFrame, columns: list[str]) -> DataFrame:
    pairs = list(combinations(range(len(columns)), 2))
    found = [F.coalesce(_correlation(f"_r{i}", f"_r{j}"), F.lit(float("nan"))).alias(f"c{k}") for k, (i, j) in enumerate(pairs)]
    wide = mid_ranks(df, columns).agg(*found)
    rows = [F.struct(F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"), F.col(f"c{k}").alias("correlation")) for k, (i, j) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*rows)))
