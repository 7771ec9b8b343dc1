"""Fitted feature state: label codes, standard scaling and derived columns.

Fitting takes two passes over the table, whatever the number of columns; what is
kept is a handful of numbers per column. Applying the state is a projection.
Vocabularies too long for an expression stay tables and are joined instead.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import cut_right, day_parts, interaction, parse_day
from tabwright.lineage import cut, exists
from tabwright.operators.ranking import running_totals
from tabwright.roles import Roles

MAX_INLINE_LABELS = 256
MAX_BROADCAST_ROWS = 500_000

# Wind classes, right-closed bounds and the code of an unknown class.
WIND_BOUNDS = (0.1, 0.3)
WIND_LABELS = ("calm", "light", "windy")
WIND_DEFAULT_CODE = 1


@dataclass
class Labels:
    """Codes 0..k-1 of a column's values in their own (typed) order."""

    dtype: str
    inline: dict | None = None
    table: DataFrame | None = None


def _labels(df: DataFrame, columns: list[str], estimates: dict[str, int], max_inline: int) -> dict[str, Labels]:
    dtypes = dict(df.dtypes)
    # The estimate can be off by a few percent, so the short columns are read with twice the room.
    short = [c for c in columns if estimates[c] <= max_inline]
    fitted: dict[str, Labels] = {}
    if short:
        # Sorted by Spark in the column's own type, as the long vocabularies are.
        room = 2 * max_inline
        seen = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in short]).first()
        for c in short:
            if len(seen[c]) <= room:
                fitted[c] = Labels(dtypes[c], inline={v: i for i, v in enumerate(seen[c])})
    for c in columns:
        if c not in fitted:
            distinct = df.select(F.lit(0).alias("_all"), F.col(c).alias("value")).filter("value is not null").distinct()
            ranked = running_totals(distinct.withColumn("n", F.lit(1)), ["_all"], "value", ["n"])
            fitted[c] = Labels(dtypes[c], table=cut(ranked.select("value", (F.col("upto_n") - 1).alias("code"))))
    return fitted


def _code(column: str, labels: Labels, unseen: str, default: int | None = None) -> Column:
    value = F.col(column)
    if not labels.inline:
        code = F.lit(None).cast("int")
    else:
        pairs = [x for v, c in labels.inline.items() for x in (F.lit(v).cast(labels.dtype), F.lit(c))]
        code = F.element_at(F.create_map(*pairs), value.cast(labels.dtype))
    return _with_policy(value, code, column, unseen, default)


def _with_policy(value: Column, code: Column, column: str, unseen: str, default: int | None = None) -> Column:
    if default is not None:
        return F.coalesce(code, F.lit(default)).cast("int")
    if unseen == "error":
        problem = F.raise_error(F.concat(F.lit(f"{column} contains a previously unseen label: "), value.cast("string")))
        return F.when(value.isNull() | code.isNotNull(), code).otherwise(problem.cast("int")).cast("int")
    if unseen == "keep":
        return F.coalesce(code, F.lit(-1)).cast("int")
    return code.cast("int")


@dataclass
class FeatureState:
    """What was learned from a training table; see ``fit`` and ``apply``."""

    roles: Roles
    scaler: dict[str, tuple[float, float]] = field(default_factory=dict)
    labels: dict[str, Labels] = field(default_factory=dict)
    group_mean: DataFrame | None = None
    feature_names: list[str] = field(default_factory=list)

    @property
    def is_fitted(self) -> bool:
        return bool(self.scaler or self.labels)

    # -- fitting -----------------------------------------------------------

    @classmethod
    def fit(cls, df: DataFrame, roles: Roles, max_inline: int = MAX_INLINE_LABELS) -> FeatureState:
        """Scaling moments and cardinalities in one pass, label values in a second."""
        exprs = []
        for i, c in enumerate(roles.numerical):
            x = F.nanvl(F.col(c).cast("double"), F.lit(None))
            exprs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
        exprs += [F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(roles.categorical)]
        row = df.agg(*exprs).first() if exprs else {}
        state = cls(roles)
        for i, c in enumerate(roles.numerical):
            if row[f"m{i}"] is None:
                raise ValueError(f"Column {c} has no values to fit")
            state.scaler[c] = (row[f"m{i}"], row[f"s{i}"] or 1.0)
        estimates = {c: row[f"d{i}"] for i, c in enumerate(roles.categorical)}
        state.labels = _labels(df, list(roles.categorical), estimates, max_inline)
        state.feature_names = [c for c in state.apply(df).columns if c != roles.target]
        return state

    def fit_derived(self, df: DataFrame) -> FeatureState:
        """Learn the wind classes and the group means from an already preprocessed table."""
        if "windspeed" in df.columns:
            present = df.select(wind_class().alias("w")).filter("w is not null").distinct().collect()
            self.labels["wind_category"] = Labels("string", inline={v: i for i, v in enumerate(sorted(r["w"] for r in present))})
        if {"temp", "season"} <= set(df.columns):
            self.group_mean = cut(df.groupBy("season").agg(F.avg("temp").alias("mean_temp")))
        return self

    # -- applying ----------------------------------------------------------

    def apply(self, df: DataFrame, unseen: str = "error", only_present: bool = False) -> DataFrame:
        """Date parts, label codes and scaled numericals.

        ``unseen`` says what happens to a label that was not fitted: ``error``,
        ``keep`` (code -1) or ``drop`` the row. ``only_present`` skips columns
        that the table lacks.
        """
        if unseen not in ("error", "keep", "drop"):
            raise ValueError(f"Unknown policy for unseen labels: {unseen}")
        df = add_day_parts(df, self.roles.date)
        for c in self.roles.categorical:
            if c not in self.labels:
                raise ValueError(f"Encoder for column {c} not fitted")
        for c in self.roles.numerical:
            if c not in self.scaler:
                raise ValueError(f"Scaler for column {c} not fitted")
        codes = [c for c in self.roles.categorical if c in df.columns or not only_present]
        scaled = [c for c in self.roles.numerical if c in df.columns or not only_present]
        if unseen == "drop":
            df = self._drop_unseen(df, codes)
        for c in codes:
            if self.labels[c].table is not None:
                df = self._join_codes(df, c, unseen)
        out = {c: _code(c, self.labels[c], unseen) for c in codes if self.labels[c].table is None}
        out |= {c: (F.col(c) - F.lit(self.scaler[c][0])) / F.lit(self.scaler[c][1]) for c in scaled}
        return df.withColumns(out)

    def _drop_unseen(self, df: DataFrame, codes: list[str]) -> DataFrame:
        for c in codes:
            labels = self.labels[c]
            if labels.table is None:
                df = df.filter(F.col(c).isNull() | F.col(c).isin(list(labels.inline)))
        return df

    def _join_codes(self, df: DataFrame, column: str, unseen: str) -> DataFrame:
        codes = self.labels[column].table.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        joined = df.join(small(codes), F.col(column) == F.col("_value"), "left")
        if unseen == "drop":
            joined = joined.filter(F.col(column).isNull() | F.col("_code").isNotNull())
        return joined.withColumn(column, _with_policy(F.col(column), F.col("_code"), column, unseen)).drop("_value", "_code")

    def derive(self, df: DataFrame, group_mean: str = "fitted") -> DataFrame:
        """Interaction, wind class and season-adjusted temperature, where their inputs exist.

        ``group_mean='batch'`` takes the season means of the table at hand instead
        of the fitted ones.
        """
        if {"temp", "hum"} <= set(df.columns):
            df = df.withColumn("temp_hum_interaction", interaction("temp", "hum"))
        if "windspeed" in df.columns:
            labels = self.labels.get("wind_category", Labels("string", inline={}))
            df = df.withColumn("wind_category", wind_class())
            df = df.withColumn("wind_category", _code("wind_category", labels, "keep", default=WIND_DEFAULT_CODE))
        if {"temp", "season"} <= set(df.columns):
            if group_mean == "batch" or self.group_mean is None:
                means = small_once(df.groupBy("season").agg(F.avg("temp").alias("mean_temp")))
            else:
                means = small(self.group_mean)
            df = centred(df, "temp", "season", means, "temp_season_adjusted")
        return df

    # -- keeping -----------------------------------------------------------

    def scaler_table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, m, s) for c, (m, s) in self.scaler.items()]
        return spark.createDataFrame(rows, "column string, mean double, scale double")

    def label_table(self, spark: SparkSession) -> DataFrame:
        """(column, dtype, value, code) of all encoders."""
        rows = [(c, x.dtype, _text(v), code) for c, x in self.labels.items() if x.table is None for v, code in x.inline.items()]
        out = spark.createDataFrame(rows, "column string, dtype string, value string, code bigint")
        for c, x in self.labels.items():
            if x.table is not None:
                coded = (F.lit(c).alias("column"), F.lit(x.dtype).alias("dtype"), F.col("value").cast("string"), F.col("code").cast("bigint"))
                out = out.unionByName(x.table.select(*coded))
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        """All state, wind classes included, as Parquet tables."""
        self.scaler_table(spark).write.mode("overwrite").parquet(f"{path}/scaler")
        self.label_table(spark).write.mode("overwrite").parquet(f"{path}/labels")
        spark.createDataFrame([(self.feature_names,)], "names array<string>").write.mode("overwrite").parquet(f"{path}/features")
        if self.group_mean is not None:
            self.group_mean.write.mode("overwrite").parquet(f"{path}/group_mean")

    @classmethod
    def load(cls, spark: SparkSession, path: str, roles: Roles, max_inline: int = MAX_INLINE_LABELS) -> FeatureState:
        state = cls(roles)
        state.scaler = {r["column"]: (r["mean"], r["scale"]) for r in spark.read.parquet(f"{path}/scaler").collect()}
        labels = spark.read.parquet(f"{path}/labels")
        sizes = labels.groupBy("column", "dtype").count().collect()
        for r in sizes:
            c, dtype = r["column"], r["dtype"]
            mine = labels.filter(F.col("column") == c).select(F.col("value").cast(dtype), "code")
            if r["count"] <= 2 * max_inline:
                state.labels[c] = Labels(dtype, inline={k["value"]: k["code"] for k in mine.orderBy("code").collect()})
            else:
                state.labels[c] = Labels(dtype, table=mine)
        state.feature_names = list(spark.read.parquet(f"{path}/features").first()["names"])
        if exists(spark, f"{path}/group_mean"):
            state.group_mean = spark.read.parquet(f"{path}/group_mean")
        return state


def _text(value) -> str:
    """A label as text that Spark casts back to the same value."""
    return str(value).lower() if isinstance(value, bool) else str(value)


def small(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast a state table if a count says it is small; otherwise let Spark choose the join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def small_once(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``small`` for a table that is costly to derive: it is computed once, then counted and joined."""
    return small(cut(df), limit)


def centred(df: DataFrame, value: str, group: str, means: DataFrame, name: str) -> DataFrame:
    """``value`` minus the mean of its group; the means join in, so a huge group is never one task."""
    joined = df.join(means.withColumnRenamed(group, "_group"), F.col(group) == F.col("_group"), "left")
    return joined.withColumn(name, F.col(value) - F.col("mean_temp")).drop("_group", "mean_temp")


def wind_class() -> Column:
    return cut_right(F.col("windspeed"), WIND_BOUNDS, WIND_LABELS)


def add_day_parts(df: DataFrame, date: str | None) -> DataFrame:
    """Replace the date column by its calendar parts; text dates are dd-MM-yyyy."""
    if date is None or date not in df.columns:
        return df
    day = parse_day(F.col(date)) if dict(df.dtypes)[date] == "string" else F.to_date(date)
    return df.withColumns(day_parts(day)).drop(date)
