from pyspark.sql import functions as F

from tabwright.operators import abtest
from tabwright.operators.histograms import Bins, histogram
from tabwright.plans import bindings as b
from tabwright.streaming import operators, sinks


def _in_files(spark, sf_dir, tmp_path, n=4):
    """Events in several files, so that a stream takes several micro-batches."""
    path = str(tmp_path / "events")
    b.table(spark, sf_dir, "events").repartitionByRange(n, "ts").write.parquet(path)
    return path


def test_windows_over_many_batches_equal_one_batch(spark, sf_dir, tmp_path):
    path = _in_files(spark, sf_dir, tmp_path)
    live = sinks.read_stream(spark, path, files_per_batch=1)
    windows = operators.windowed_quality(live, "ts", ["value"], watermark="60 days")
    out = str(tmp_path / "out")
    sinks.run_into(windows, {out: lambda rows: rows}, str(tmp_path / "progress"), "update").awaitTermination()
    got = sinks.latest_of(spark, out, windows.schema, ["window_start"])
    want = operators.windowed_quality(spark.read.parquet(path), "ts", ["value"])
    cols = ["window_start", "n_rows", F.round("mean_value", 9)]
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0 and got.count() == want.count()


def test_looks_over_many_batches_equal_the_batch_test(spark, sf_dir, tmp_path):
    path = _in_files(spark, sf_dir, tmp_path)
    live = b.arms_of(sinks.read_stream(spark, path, files_per_batch=2))
    moments = operators.look_moments(live, "ts", "value", ["segment"], watermark="60 days")
    out = str(tmp_path / "out")
    sinks.run_into(moments, {out: lambda rows: rows}, str(tmp_path / "progress"), "update").awaitTermination()
    state = operators.sequential_state(sinks.latest_of(spark, out, moments.schema, ["window_start", "segment"]), ["segment"])
    batch = abtest.sequential(b.arms_of(spark.read.parquet(path)), "value", ["segment"])
    got = state.select("segment", F.to_date("window_start").alias("look"), F.round("p_value", 6).alias("p"))
    want = batch.select("segment", "look", F.round("p_value", 6).alias("p"))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_redeliveries_are_logged_once(spark, sf_dir, tmp_path):
    path = _in_files(spark, sf_dir, tmp_path)
    spark.read.parquet(path).filter("event_id % 10 = 0").write.mode("append").parquet(path)
    live = operators.metric_log(sinks.read_stream(spark, path, files_per_batch=2), "ts", ["event_id"], "60 days")
    out = str(tmp_path / "log")
    sinks.append_to(live, out, str(tmp_path / "progress")).awaitTermination()
    assert spark.read.parquet(out).count() == b.table(spark, sf_dir, "events").count()


def test_an_alert_clears_when_its_window_recovers(spark, tmp_path):
    rows = spark.range(400).select((F.timestamp_seconds(F.col("id") % 100 + 86400)).alias("ts"), (F.col("id") % 10).cast("double").alias("value"))
    bins = Bins.on_edges(rows, {"value": [2.0, 5.0, 8.0]})
    reference = histogram(rows, bins)
    source = str(tmp_path / "source")
    counts, verdicts, progress = (str(tmp_path / n) for n in ("counts", "verdicts", "progress"))

    def run(batch):
        batch.coalesce(1).write.mode("append").parquet(source)
        live = operators.windowed_bins(sinks.read_stream(spark, source), "ts", bins, watermark="60 days")
        operators.run_drift_alerts(live, reference, bins, counts, verdicts, progress).awaitTermination()
        return operators.current_alerts(spark, verdicts).collect()

    raised = run(rows.filter("value > 8"))
    assert [r.metric for r in raised] == ["value"] and raised[0].value > 0.1
    assert run(rows.filter("value <= 8")) == []
    later = rows.filter("value > 8").withColumn("ts", F.col("ts") + F.expr("interval 3 days"))
    assert [str(r.ts)[:10] for r in run(later)] == ["1970-01-05"]
