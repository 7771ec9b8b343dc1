"""Distribution drift between a reference and a current table.

Numbers are compared by histograms on the reference's bins (``histograms``), with the
error of each distance. With ``exact=True`` rows shrink to counts per (column, value)
instead, so a value held by a third of all rows is one row before anything is sorted;
all distinct values are shuffled then. Labels are counted by value in both modes.

Distances are taken over the values that are there; missing ones (null, NaN) are counted
per side. A column that has values on one side only counts as drifted: its distances are
1. Without values on both sides they are 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.lineage import cut
from tabwright.operators.histograms import FLOOR, MIN_STD, Bins, binned_drift
from tabwright.operators.quantiles import MAX_COUNTERS, quantile_literals
from tabwright.operators.ranking import running_totals

ROUNDING = 1e-12  # sums of the same values in another order differ by less


def value_counts(ref: DataFrame, cur: DataFrame, columns: Sequence[str], dtype: str) -> DataFrame:
    """(column, value, n_ref, n_cur) over both tables; the missing are one value, null."""

    def side(df: DataFrame, is_ref: int) -> DataFrame:
        cells = {c: F.col(c).cast(dtype) for c in columns}
        if dtype == "double":
            cells = {c: F.nanvl(v, F.lit(None)) for c, v in cells.items()}
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in cells.items()])
        return df.select(F.inline(pairs), F.lit(is_ref).alias("_ref"))

    both = side(ref, 1).unionByName(side(cur, 0))
    return both.groupBy("column", "value").agg(F.sum("_ref").alias("n_ref"), F.sum(1 - F.col("_ref")).alias("n_cur"))


def missing_shares(counts: DataFrame) -> DataFrame:
    """(column, missing_ref, missing_cur, sides) from value counts; ``sides`` is how many sides have any value."""
    def side(n: str) -> tuple[Column, Column]:
        gone = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col(n))), F.lit(0))
        share = F.coalesce(F.try_divide(gone.cast("double"), F.sum(n)), F.lit(1.0))
        return share, (F.sum(n) > gone).cast("int")

    (ref, has_ref), (cur, has_cur) = side("n_ref"), side("n_cur")
    return counts.groupBy("column").agg(ref.alias("missing_ref"), cur.alias("missing_cur"), (has_ref + has_cur).alias("sides"))


def _of_all(missing: DataFrame, found: DataFrame, names: Sequence[str]) -> DataFrame:
    """``found`` for every column, with the named distances settled where a side is empty."""
    settled = [F.when(F.col("sides") == 2, F.col(n)).otherwise(F.col("sides").cast("double")).alias(n) for n in names]
    return missing.join(found, "column", "left").select("column", *settled)


def _safe_log_ratio(p: Column, m: Column) -> Column:
    return F.when((p > 0) & (m > 0), p * F.log2(F.try_divide(p, m))).otherwise(F.lit(0.0))


def jensen_shannon(counts: DataFrame) -> DataFrame:
    """Distance (base 2) per column from (column, value, n_ref, n_cur)."""
    shares = _shares(counts, ["column", "value"])
    p, q = F.col("p"), F.col("q")
    m = (p + q) / 2
    divergence = F.sum(_safe_log_ratio(p, m)) / 2 + F.sum(_safe_log_ratio(q, m)) / 2
    return shares.groupBy("column").agg(F.sqrt(F.greatest(divergence, F.lit(0.0))).alias("jensen_shannon"))


def _shares(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Shares of each side per key; the totals are one row per column."""
    totals = counts.groupBy("column").agg(F.sum("n_ref").alias("_ref"), F.sum("n_cur").alias("_cur"))
    joined = counts.join(F.broadcast(totals), "column")
    p = F.coalesce(F.try_divide(F.col("n_ref").cast("double"), F.col("_ref")), F.lit(0.0))
    q = F.coalesce(F.try_divide(F.col("n_cur").cast("double"), F.col("_cur")), F.lit(0.0))
    return joined.select(*keys, p.alias("p"), q.alias("q"))


def stability_index(binned: DataFrame) -> DataFrame:
    """PSI per column from (column, bin, n_ref, n_cur); empty bins count as FLOOR."""
    shares = _shares(binned, ["column", "bin"])
    p, q = F.greatest("p", F.lit(FLOOR)), F.greatest("q", F.lit(FLOOR))
    return shares.groupBy("column").agg(F.sum((q - p) * F.log(q / p)).alias("psi"))


def quantile_edges(ref: DataFrame, columns: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Inner bin edges at the reference quantiles, without repeats."""
    raw = quantile_literals(ref, columns, [i / bins for i in range(1, bins)])
    return {c: sorted({e for e in edges if e == e}) for c, edges in raw.items()}


def bin_of(value: Column, edges: Sequence[float]) -> Column:
    """0-based bin; a value on an edge belongs to the bin below it."""
    return sum(((value > F.lit(e)).cast("int") for e in edges), F.lit(0))


def binned_counts(counts: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    bin_ = F.lit(None).cast("int")
    for c, inner in edges.items():
        bin_ = F.when(F.col("column") == c, bin_of(F.col("value"), inner)).otherwise(bin_)
    return counts.groupBy("column", bin_.alias("bin")).agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def distances(counts: DataFrame) -> DataFrame:
    """Exact Kolmogorov-Smirnov and normalised Wasserstein distance per column.

    Row totals and the reference's std come from the value counts too, one row
    per column, so the tables themselves are not read again.
    """
    n, v = F.col("n_ref").cast("double"), F.col("value")
    totals = counts.groupBy("column").agg(
        F.sum("n_ref").alias("n_ref_all"), F.sum("n_cur").alias("n_cur_all"), F.try_divide(F.sum(n * v), F.sum(n)).alias("_mean")
    )
    squares = counts.join(F.broadcast(totals), "column").groupBy("column").agg(F.sum(n * (v - F.col("_mean")) * (v - F.col("_mean"))).alias("_ss"))
    std = F.sqrt(F.try_divide(F.col("_ss"), F.col("n_ref_all")))
    spread = totals.join(squares, "column").select("column", "n_ref_all", "n_cur_all", std.alias("std_ref"))
    upto = running_totals(counts, ["column"], "value", ["n_ref", "n_cur"]).join(F.broadcast(spread), "column")
    f = F.try_divide(F.col("upto_n_ref").cast("double"), F.col("n_ref_all"))
    g = F.try_divide(F.col("upto_n_cur").cast("double"), F.col("n_cur_all"))
    gap = F.abs(f - g)
    width = F.coalesce(F.col("next") - F.col("value"), F.lit(0.0))
    return upto.groupBy("column").agg(
        F.max(gap).alias("ks"), (F.sum(gap * width) / F.max(F.greatest("std_ref", F.lit(MIN_STD)))).alias("wasserstein")
    )


def counted_edges(counts: DataFrame, ref: DataFrame, columns: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """``quantile_edges`` from value counts; the table is only read where a column has too many values."""
    sizes = counts.groupBy("column").count().collect()
    if max((r["count"] for r in sizes), default=0) > MAX_COUNTERS:
        return quantile_edges(ref, columns, bins)
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = counts.groupBy("column").agg(F.percentile("value", probs, F.col("n_ref")).alias("edges")).collect()
    return {r["column"]: sorted(set(r["edges"] or [])) for r in found}


def numeric_drift(ref: DataFrame, cur: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """(column, ks, wasserstein, psi) of numeric columns, exact, from one pass over each table."""
    counts = cut(value_counts(ref, cur, columns, "double"))
    return _numeric(counts, ref, columns, bins)


def _numeric(counts: DataFrame, ref: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    present = counts.filter("value is not null")
    psi = stability_index(binned_counts(present, counted_edges(present, ref, columns, bins)))
    found = distances(present).join(psi, "column", "left")
    return _of_all(missing_shares(counts), found, ["ks", "wasserstein", "psi"])


def categorical_drift(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, jensen_shannon, psi) of categorical columns; each value is a bin."""
    return _categorical(cut(value_counts(ref, cur, columns, "string")))


def _categorical(counts: DataFrame) -> DataFrame:
    present = counts.filter("value is not null")
    psi = stability_index(present.withColumnRenamed("value", "bin"))
    return _of_all(missing_shares(counts), jensen_shannon(present).join(psi, "column"), ["jensen_shannon", "psi"])


def drift_report(
    ref: DataFrame, cur: DataFrame, numerical: Sequence[str], categorical: Sequence[str], threshold: float = 0.1,
    exact: bool = False, bins: Bins | None = None,
) -> DataFrame:
    """(column, kind, method, score, error, drifted): Wasserstein for numbers, Jensen-Shannon for labels.

    Numbers are compared on ``bins``, fitted on the reference unless given: the exact distance lies
    in [score, score + error], and numbers whose interval holds the threshold are judged by all
    their values, so ``drifted`` is that of the exact distances. ``exact=True`` does so for all.

    A column also counts as drifted if the share of its missing values changed by the threshold;
    its score is then that change, if it is the larger.
    """
    parts, limit = [], threshold - abs(threshold) * ROUNDING
    if numerical and not exact:
        found = cut(_with_missing(binned_drift(ref, cur, numerical, bins), "numerical", "wasserstein", F.col("wasserstein_error"), threshold))
        undecided = (F.col("score") < limit) & (F.col("score") + F.col("error") >= limit)
        unclear = [r["column"] for r in found.filter(undecided).select("column").collect()]
        parts.append(found.filter(~F.col("column").isin(unclear)) if unclear else found)
    else:
        unclear = list(numerical)
    if unclear:
        counts = cut(value_counts(ref, cur, unclear, "double"))
        found = _numeric(counts, ref, unclear, 10).join(missing_shares(counts), "column")
        parts.append(_with_missing(found, "numerical", "wasserstein", F.lit(0.0), threshold))
    if categorical:
        counts = cut(value_counts(ref, cur, categorical, "string"))
        found = _categorical(counts).join(missing_shares(counts), "column")
        parts.append(_with_missing(found, "categorical", "jensen_shannon", F.lit(0.0), threshold))
    return reduce(DataFrame.unionByName, parts).withColumn("drifted", F.col("score") >= limit)


def _with_missing(found: DataFrame, kind: str, method: str, error: Column, threshold: float) -> DataFrame:
    """Distance, or the change of the missing share where that is beyond the threshold and larger."""
    change = F.abs(F.col("missing_ref") - F.col("missing_cur"))
    score = F.when(change >= threshold, F.greatest(F.col(method), change)).otherwise(F.col(method))
    return found.select(
        "column", F.lit(kind).alias("kind"), F.lit(method).alias("method"), score.alias("score"), error.alias("error")
    )


def overall(report: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Mean score of the drifted columns, their names, and whether the alarm goes off."""
    scored = report.agg(
        F.coalesce(F.avg(F.when(F.col("drifted"), F.col("score"))), F.lit(0.0)).alias("drift_score"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("column")))).alias("drifted_columns"),
    )
    return scored.withColumn("threshold", F.lit(threshold)).withColumn("alarm", F.col("drift_score") > threshold)
