"""The test tables seen as the inputs of the operators.

Every view exists twice, as a DataFrame and as a SQL fragment for a ``with``
clause, and holds the same values in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.columns import unit_hash
from tabwright.roles import Roles

NUMERICAL = ("temp", "atemp", "hum", "windspeed")
CATEGORICAL = ("season", "yr", "mnth", "holiday", "weekday", "workingday", "weathersit")
DEMAND_ROLES = Roles(
    numerical=NUMERICAL, categorical=CATEGORICAL, target="cnt", key="o_orderkey", date="dteday", passthrough=("instant",)
)
REFERENCE_UNTIL = "1998-04-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand_of(table(spark, sf_dir, "orders"))


def demand_of(orders: DataFrame) -> DataFrame:
    """Daily rental demand derived from orders."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    weekday = F.dayofweek(day) - 1
    base = orders.select(
        key,
        day,
        (key + 1).alias("instant"),
        F.date_format(day, "dd-MM-yyyy").alias("dteday"),
        F.quarter(day).alias("season"),
        (F.year(day) % 2).alias("yr"),
        F.month(day).alias("mnth"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("holiday"),
        weekday.alias("weekday"),
        F.when(weekday.between(1, 5), 1).otherwise(0).alias("workingday"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3).alias("weathersit"),
        ((F.col("o_custkey") % 41).cast("double") / 40).alias("temp"),
        ((F.col("o_custkey") * 7 % 50).cast("double") / 49).alias("atemp"),
        ((key * 37 % 101).cast("double") / 100).alias("hum"),
        ((key * 53 % 97).cast("double") / 160).alias("windspeed"),
        ((key * 7919 % 601).cast("double") - 300).alias("_noise"),
    )
    c = F.col
    count = (
        F.lit(3000) + c("temp") * 2000 + c("atemp") * 1000 - c("hum") * 1500 - c("windspeed") * 1000 + c("season") * 200
        + c("yr") * 500 - c("holiday") * 800 + c("workingday") * 300 - c("weathersit") * 400 + c("_noise")
    )
    return base.withColumn("cnt", F.round(F.greatest(F.lit(0.0), count), 4)).drop("_noise")


DEMAND = """demand as (
  select b.* exclude (noise), round(greatest(cast(0 as double),
      3000 + temp*2000 + atemp*1000 - hum*1500 - windspeed*1000 + season*200
      + yr*500 - holiday*800 + workingday*300 - weathersit*400 + noise), 4) as cnt
  from (
    select o_orderkey, o_orderdate, o_orderkey + 1 as instant, strftime(o_orderdate,'%d-%m-%Y') as dteday,
      cast(quarter(o_orderdate) as int) as season,
      cast(year(o_orderdate) % 2 as int) as yr,
      cast(month(o_orderdate) as int) as mnth,
      case when o_orderpriority = '1-URGENT' then 1 else 0 end as holiday,
      cast(dayofweek(o_orderdate) as int) as weekday,
      case when dayofweek(o_orderdate) between 1 and 5 then 1 else 0 end as workingday,
      case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as weathersit,
      cast(o_custkey % 41 as double) / 40 as temp,
      cast((o_custkey * 7) % 50 as double) / 49 as atemp,
      cast((o_orderkey * 37) % 101 as double) / 100 as hum,
      cast((o_orderkey * 53) % 97 as double) / 160 as windspeed,
      cast((o_orderkey * 7919) % 601 as double) - 300 as noise
    from orders) b)"""


def demand_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand with missing temperatures and some rows delivered twice."""
    key = F.col("o_orderkey")
    copies = F.explode(F.when(key % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return (
        demand(spark, sf_dir)
        .withColumn("temp", F.when(key % 17 != 0, F.col("temp")))
        .select("*", copies.alias("_copy"))
        .drop("_copy")
    )


DEMAND_DIRTY = DEMAND + """, demand_dirty as (
  select * from (select * replace (case when o_orderkey % 17 <> 0 then temp end as temp) from demand)
  union all
  select * from (select * replace (case when o_orderkey % 17 <> 0 then temp end as temp) from demand
                 where o_orderkey % 50 = 0))"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_of(demand(spark, sf_dir))


def requests_of(days: DataFrame) -> DataFrame:
    """Scoring requests: raw features, some with values out of range."""
    key = F.col("o_orderkey")
    return (
        days.select("o_orderkey", *CATEGORICAL, *NUMERICAL)
        .withColumn("season", F.when(key % 23 == 0, 9).otherwise(F.col("season")))
        .withColumn("hum", F.when(key % 29 == 0, 1.5).otherwise(F.col("hum")))
    )


REQUESTS = DEMAND + """, requests as (
  select o_orderkey, case when o_orderkey % 23 = 0 then 9 else season end as season, yr, mnth, holiday, weekday,
    workingday, weathersit, temp, atemp, case when o_orderkey % 29 = 0 then 1.5 else hum end as hum, windspeed
  from demand)"""


def portable_unit(seed: int = 42, key: str = "o_orderkey") -> Column:
    return unit_hash(F.col(key), seed, portable=True)


def unit_sql(seed: int = 42, key: str = "o_orderkey") -> str:
    """The portable hash in SQL; nested once per mixing round."""
    first = f"((({key} % 2147483648) * 2654435761 + {seed}) % 4294967296)"
    second = f"(xor({first}, {first} >> 16) * 73244475 % 4294967296)"
    third = f"(xor({second}, {second} >> 16) * 73244475 % 4294967296)"
    return f"(cast({third} as double)/4294967296.0)"


SPLIT_SQL = f"case when {unit_sql()} < 0.8 then 'train' when {unit_sql()} < 0.9 then 'val' else 'test' end"


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand with the predictions of a fixed linear scorer."""
    return demand(spark, sf_dir).withColumn("pred", F.lit(3000) + F.col("temp") * 2000 - F.col("hum") * 1500)


PREDS = DEMAND + """, preds as (select *, 3000 + temp*2000 - hum*1500 as pred from demand)"""


def reference_and_current(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Demand before and from the cut-over day; humidity is shifted in the current part."""
    rows = demand(spark, sf_dir)
    day = F.to_date("o_orderdate")
    cutover = F.lit(REFERENCE_UNTIL).cast("date")
    return rows.filter(day < cutover), rows.filter(day >= cutover).withColumn("hum", F.col("hum") * 0.8 + 0.1)


SIDES = DEMAND + f""", ref as (select * from demand where o_orderdate < date '{REFERENCE_UNTIL}'),
cur as (select * replace (hum*0.8+0.1 as hum) from demand where o_orderdate >= date '{REFERENCE_UNTIL}')"""


def arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arms_of(table(spark, sf_dir, "events"))


def arms_of(events: DataFrame) -> DataFrame:
    """Logged outcomes of a two-arm test."""
    return events.select(
        "event_id",
        "ts",
        "user_id",
        F.when(F.col("user_id") % 2 == 0, "control").otherwise("treatment").alias("arm"),
        F.col("event_type").alias("segment"),
        F.col("value"),
        F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0).alias("conversion"),
        F.to_date("ts").alias("look"),
    )


ARMS = """arms as (
  select event_id, user_id, case when user_id % 2 = 0 then 'control' else 'treatment' end as arm,
    event_type as segment, value, case when event_type = 'purchase' then 1.0::double else 0.0::double end as conversion,
    cast(ts as date) as look
  from events)"""


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric history of experiment runs."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("experiment_id"),
        F.concat_ws("-", "event_type", "user_id").alias("run_id"),
        F.lit("value").alias("metric"),
        F.col("value"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per experiment run."""
    user = F.col("user_id") % 10
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("experiment_id"), "user_id")
        .agg(F.min("ts").alias("started_at"), F.max("ts").alias("ended_at"))
        .select(
            "experiment_id",
            F.concat_ws("-", "experiment_id", "user_id").alias("run_id"),
            F.when(user == 0, "failed").when(user == 1, "running").otherwise("finished").alias("status"),
            F.col("user_id").alias("owner"),
            "started_at",
            "ended_at",
        )
    )


RUNS = """run_metrics as (
  select event_type as experiment_id, event_type || '-' || user_id as run_id, 'value' as metric, value, ts,
    event_id as seq from events),
runs as (
  select event_type as experiment_id, event_type || '-' || user_id as run_id,
    case user_id % 10 when 0 then 'failed' when 1 then 'running' else 'finished' end as status,
    user_id as owner, min(ts) as started_at, max(ts) as ended_at
  from events group by event_type, user_id)"""


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered model versions with one metric each."""
    stage = F.col("c_nationkey") % 4
    return table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("model_name"),
        F.col("c_custkey").alias("version"),
        F.col("c_custkey").alias("run_id"),
        F.when(stage == 0, "None").when(stage == 1, "Staging").when(stage == 2, "Production").otherwise("Archived").alias("stage"),
        F.col("c_acctbal").alias("score"),
    )


VERSIONS = """versions as (
  select c_mktsegment as model_name, c_custkey as version, c_custkey as run_id,
    case c_nationkey % 4 when 0 then 'None' when 1 then 'Staging' when 2 then 'Production' else 'Archived' end as stage,
    c_acctbal as score
  from customer)"""
