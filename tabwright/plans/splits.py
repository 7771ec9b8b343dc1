"""Queries over splits, folds and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import rounded
from tabwright.operators import split
from tabwright.plans import bindings as b
from tabwright.plans.catalog import query

KEY = "o_orderkey"


@query("split_rows", f"with {b.DEMAND} select o_orderkey, {b.SPLIT_SQL} as split from demand")
def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_rows(b.demand(spark, sf_dir), KEY, portable=True).select(KEY, "split")


@query(
    "split_rows_exactly",
    f"""with {b.DEMAND}, r as (select o_orderkey, row_number() over (order by {b.unit_sql()}, o_orderkey) as k, count(*) over () as n from demand),
c as (select *, cast(ceil(round(n * 0.2, 6)) as bigint) as held from r)
select o_orderkey, case when k <= n - held then 'train' when k <= n - ceil(held * 0.5) then 'val' else 'test' end as split from c""",
)
def split_rows_exactly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_rows(b.demand(spark, sf_dir), KEY, portable=True, exact=True).select(KEY, "split")


@query("sampled_rows", f"with {b.DEMAND} select o_orderkey, cnt from demand order by {b.unit_sql()}, o_orderkey limit 100")
def sampled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reproducible sample of 100 rows."""
    return split.sample_rows(b.demand(spark, sf_dir), KEY, 100, portable=True).select(KEY, "cnt")


@query("first_rows", f"with {b.DEMAND} select o_orderkey, dteday, cnt from demand order by o_orderkey limit 10")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten rows by key."""
    return b.demand(spark, sf_dir).select(KEY, "dteday", "cnt").orderBy(KEY).limit(10)


@query("kfold", f"with {b.DEMAND} select o_orderkey, cast(floor({b.unit_sql()} * 5) as int) as fold from demand")
def kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.kfold(b.demand(spark, sf_dir), KEY, portable=True).select(KEY, "fold")


@query(
    "repeated_kfold",
    f"with {b.DEMAND} select o_orderkey, {', '.join(f'cast(floor({b.unit_sql(42 + r)} * 5) as int) as fold_{r}' for r in range(3))} from demand",
)
def repeated_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.repeated_kfold(b.demand(spark, sf_dir), KEY, portable=True).select(KEY, "fold_0", "fold_1", "fold_2")


@query(
    "stratified_kfold",
    f"""select doc_id, quality, cast((row_number() over (partition by quality order by {b.unit_sql(42, 'doc_id')}, doc_id) - 1) % 5 as int) as fold from labels""",
)
def stratified_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = b.table(spark, sf_dir, "labels")
    return split.stratified_kfold(labels, "doc_id", "quality", portable=True).select("doc_id", "quality", "fold")


_DECILES = ", ".join(f"{i / 10}" for i in range(1, 10))


@query(
    "kfold_stratified_by_binned_target",
    f"""with {b.DEMAND}, e as (select quantile_cont(cnt, [{_DECILES}]) as edges from demand),
s as (select o_orderkey, cast(len(list_filter(edges, lambda x: cnt > x)) as int) as stratum from demand, e)
select o_orderkey, stratum, cast((row_number() over (partition by stratum order by {b.unit_sql()}, o_orderkey) - 1) % 5 as int) as fold from s""",
)
def kfold_stratified_by_binned_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    binned = split.binned_target(b.demand(spark, sf_dir), "cnt")
    return split.stratified_kfold(binned, KEY, "stratum", portable=True).select(KEY, "stratum", "fold")


_EDGES = ", ".join(repr(i / 6) for i in range(1, 6))


@query(
    "time_series_blocks",
    f"""with {b.DEMAND}, t as (select o_orderkey, epoch(o_orderdate) as t from demand), e as (select quantile_cont(t, [{_EDGES}]) as edges from t)
select o_orderkey, cast(len(list_filter(edges, lambda x: t > x)) as int) as block from t, e""",
)
def time_series_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.time_blocks(b.demand(spark, sf_dir), "o_orderdate").select(KEY, "block")


@query(
    "group_kfold",
    f"select event_id, user_id, cast(floor({b.unit_sql(42, 'user_id')} * 5) as int) as fold from events",
)
def group_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.group_kfold(b.table(spark, sf_dir, "events"), "user_id", portable=True).select("event_id", "user_id", "fold")


@query(
    "learning_subset_sizes",
    f"with {b.DEMAND} " + " union all ".join(
        f"select {(i + 1) / 10!r}::double as fraction, cast(count(*) filter ({b.unit_sql(43)} < {(i + 1) / 10!r}) as bigint) as n from demand" for i in range(10)
    ),
)
def learning_subset_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.subset_sizes(b.demand(spark, sf_dir), KEY, [(i + 1) / 10 for i in range(10)], 43, portable=True)


@query(
    "fold_balance",
    f"""with {b.DEMAND}, f as (select *, cast(floor({b.unit_sql()} * 5) as int) as fold from demand)
select fold, count(*) as n, round(avg(cnt), 4) + 0.0 as mean_cnt from f group by fold""",
)
def fold_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = split.with_folds(b.demand(spark, sf_dir), "kfold", KEY, portable=True)
    return folds.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("cnt"), 4).alias("mean_cnt"))
