"""Fits on dealt rows: more partitions for more rows, and one shuffle for all folds."""

import pytest

from tabwright.operators import split, training
from tabwright.plans import bindings as b
from tabwright.plans import models

FEATURES = ["season", "temp", "hum"]


def test_more_rows_are_dealt_to_more_partitions(spark, sf_dir, monkeypatch):
    rows = b.demand(spark, sf_dir)
    seen = []
    deal_out = training.dealt
    monkeypatch.setattr(training, "dealt", lambda df, n, *by: seen.append(n) or deal_out(df, n, *by))
    training.fit(rows, "dt", FEATURES, "cnt", max_depth=2, partitions=8)
    monkeypatch.setattr(training, "PART_ROWS", 100, raising=False)
    training.fit(rows, "dt", FEATURES, "cnt", max_depth=2, partitions=8)
    assert seen == [8, 15]  # 1,500 rows


@pytest.mark.parametrize("model", ["rf", "gb"])
def test_rows_dealt_once_give_the_models_of_folds_dealt_alone(spark, sf_dir, model):
    rows = split.kfold(b.demand(spark, sf_dir), "o_orderkey", 3)
    once = training.deal(rows.select(*FEATURES, "cnt", "fold"), [*FEATURES, "cnt"], 5).cache()
    for (alone, _), (part, test) in zip(split.fold_frames(rows, 3), split.fold_frames(once, 3)):
        want = training.fit(alone, model, FEATURES, "cnt", n_estimators=3, max_depth=3, partitions=5)
        got = training.fit(part, model, FEATURES, "cnt", n_estimators=3, max_depth=3)
        assert got.stages[-1].toDebugString.splitlines()[1:] == want.stages[-1].toDebugString.splitlines()[1:]
    once.unpersist()


def test_model_comparison_deals_once_and_scores_held_out_rows_only(spark, sf_dir, monkeypatch):
    seen = []
    deal_out, score = training.dealt, training.predict
    monkeypatch.setattr(training, "dealt", lambda df, n, *by: seen.append("deal") or deal_out(df, n, *by))
    monkeypatch.setattr(training, "predict", lambda model, df: seen.append("score") or score(model, df))
    found = models.model_comparison(spark, sf_dir).collect()
    assert len(found) == 6 * 6 and {r["n"] for r in found} == {5}
    assert seen.count("deal") == 1 and seen.count("score") == 6 * 5
