import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import quantiles as q

PROBS = [0.0, 0.001, 0.25, 0.5, 0.505, 0.99, 1.0]


def frame(spark, values, groups):
    rows = [(g, None if v is None else float(v), float(i % 7)) for i, (g, v) in enumerate(zip(groups, values))]
    return spark.createDataFrame(rows, "g string, v double, w double").repartition(5)


def check(df, rows, probs=PROBS, **options):
    found = {(r.g, r.column, r.prob): r.value for r in q.quantiles(df, ["v", "w"], probs, ["g"], **options).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        for k, c in ((1, "v"), (2, "w")):
            known = [r[k] for r in rows if r[0] == g and r[k] is not None and not math.isnan(r[k])]
            want.update({(g, c, p): float(np.quantile(known, p)) for p in probs if known})
    assert set(found) == set(want)
    for key, value in want.items():
        assert found[key] == pytest.approx(value, rel=1e-12, abs=1e-12), key


@pytest.mark.parametrize("counters", [0, 1_000_000])
def test_groups_of_all_sizes_with_ties_nulls_and_nan(spark, counters):
    rng = np.random.default_rng(1)
    groups = ["hot"] * 30_000 + ["ties"] * 6_000 + ["small"] * 50 + [None] * 3_000 + ["one"] + ["none"] * 3
    values = [*rng.lognormal(0, 3, 30_000), *rng.integers(0, 3, 6_000), *rng.normal(size=50), *rng.normal(size=3_000), 5.0, None, math.nan, None]
    df = frame(spark, values, groups)
    check(df, df.collect(), max_counters=counters)


@pytest.mark.parametrize("shape", ["sorted", "constant", "spike", "infinite"])
def test_shapes(spark, shape):
    n = 9_000
    values = {
        "sorted": np.arange(n), "constant": np.full(n, 2.5), "spike": np.where(np.arange(n) % 2 == 0, 1.0, np.arange(n)),
        "infinite": np.where(np.arange(n) % 50 == 0, np.inf, np.arange(n)),
    }[shape]
    df = frame(spark, values.tolist(), ["a"] * n)
    check(df, df.collect(), [0.25, 0.5, 0.75])


def test_whole_table_keeps_few_values(spark):
    df = spark.range(200_000).select((F.hash("id") % 1_000_003).cast("double").alias("v"))
    want = np.quantile([r.v for r in df.collect()], [0.25, 0.5])
    assert q.quantile_literals(df, ["v"], [0.25, 0.5])["v"] == pytest.approx(want.tolist())
    kept = q._bracketed_counts(df, ["v"], [0.25, 0.5], [])
    assert kept.count() < 200_000 * 2 * 10 / q.ACCURACY and kept.agg(F.sum("n")).first()[0] == 200_000


def test_a_sketch_that_misses_is_noticed(spark, monkeypatch):
    df = spark.range(20_000).select(F.col("id").cast("double").alias("v"))
    monkeypatch.setattr(q, "_brackets", lambda *_: spark.createDataFrame([(20_000, 3.0, 9.0)], "_n0 long, _low0_0 double, _high0_0 double"))
    assert q._bracketed_counts(df, ["v"], [0.5], []) is None
    assert q.quantile_literals(df, ["v"], [0.5]) == {"v": [9999.5]}


def test_empty_table_and_other_types(spark):
    empty = spark.createDataFrame([], "g string, v double, w double")
    assert q.quantiles(empty, ["v"], [0.5]).collect() == [] and q.quantiles(empty, ["v"], [0.5], ["g"]).collect() == []
    whole = spark.createDataFrame([(1, "a"), (4, "b")], "v int, _n0 string")
    assert [r.value for r in q.quantiles(whole, ["v"], [0.5]).collect()] == [2.5]


def test_counting_code_stays_small_enough_to_be_compiled(spark, monkeypatch, capsys):
    """The JVM leaves methods of more than 8,000 bytes uncompiled; six columns must not add up to that."""
    sizes, keep = [], q.cut

    def seen(df):
        df.explain("codegen")
        sizes.extend(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out))
        return keep(df)

    monkeypatch.setattr(q, "cut", seen)
    df = spark.range(3_000).select(*[((F.col("id") * 37 % (101 + i)).cast("double") / 100).alias(f"c{i}") for i in range(6)])
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # its plans show no code before they run
    try:
        q.quantile_literals(df, df.columns, [0.25, 0.5, 0.75])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) < 8_000
