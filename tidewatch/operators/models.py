"""Ranking models on Spark ML: preparation, training, choice, calibration and comparison."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property, reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.distributed import join_same, positions
from ..functions.graphs import stored
from ..functions.isotonic import interpolated, isotonic_knots
from ..functions.metrics import areas, average_precision, roc_auc, top_k
from .features import balanced_sample, one_hot, sample_weights
from .search import best_of, successive_halving

CATEGORICAL = ("payment_format", "currency_pair", "max_rule_severity")


@dataclass
class ModelOptions:
    negatives_per_positive: int = 10
    max_train_rows: int = 200_000
    seed: int = 42
    feature_count: int = 25
    forced_prefixes: Sequence[str] = ()
    models: Sequence[str] = ("logistic_regression", "random_forest", "gbt")
    trees: int = 50
    depth: int = 6
    trials: int = 18
    metric: str = "precision_at_k"
    k: int = 1000


@dataclass
class Ranker:
    """A fitted model, or a constant where training rows had one class."""

    name: str
    columns: list[str]
    model: PipelineModel | None = None
    constant: float = 0.0
    options: dict = field(default_factory=dict)

    def score(self, df: DataFrame, out: str = "model_score") -> DataFrame:
        if self.model is None:
            return df.withColumn(out, F.lit(float(self.constant)))
        d = self.model.transform(df)
        return d.select(*df.columns, vector_to_array("probability")[1].alias(out))

    def importance(self, spark) -> DataFrame:
        """(feature_name, importance, model_name) by falling importance: tree importances or sizes of coefficients."""
        values = [0.0] * len(self.columns)
        if self.model is not None:
            last = self.model.stages[-1]
            values = [abs(float(x)) for x in (last.coefficients.toArray() if hasattr(last, "coefficients") else last.featureImportances.toArray())]
        rows = sorted(zip(self.columns, values, strict=True), key=lambda r: (-r[1], r[0]))
        return spark.createDataFrame([(n, v, self.name) for n, v in rows], "feature_name string, importance double, model_name string")

    def save(self, path: str) -> None:
        """Writes the model, if it isn't a constant, and what else describes the ranker."""
        spark = SparkSession.getActiveSession()
        about = json.dumps({"name": self.name, "columns": self.columns, "constant": self.constant, "options": self.options, "fitted": self.model is not None})
        spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
        if self.model is not None:
            self.model.write().overwrite().save(f"{path}/model")

    @classmethod
    def load(cls, path: str) -> Ranker:
        about = json.loads(SparkSession.getActiveSession().read.text(f"{path}/about", wholetext=True).first()["value"])
        model = PipelineModel.load(f"{path}/model") if about.pop("fitted") else None
        return cls(model=model, **about)


def categories(features: DataFrame, columns: Sequence[str] = CATEGORICAL) -> dict[str, list[str]]:
    """All values of each categorical column, from one aggregate. Each becomes a column of the model."""
    row = features.agg(*(F.array_sort(F.collect_set(c)).alias(c) for c in columns)).first()
    return {c: list(row[c]) for c in columns}


def prepare(features: DataFrame, values: dict[str, Sequence[str]] | None = None) -> tuple[DataFrame, list[str]]:
    """Numbers only: null as 0 and one column per category and for null; with the names of the model's columns."""
    d = one_hot(features, categories(features) if values is None else values)
    return d, [c for c in d.columns if c not in ("alert_id", "split", "target")]


def _pipeline(estimator, columns: Sequence[str], scale: bool = False) -> Pipeline:
    stages = [VectorAssembler(inputCols=list(columns), outputCol="raw", handleInvalid="keep")]
    stages.append(StandardScaler(inputCol="raw", outputCol="features", withMean=False) if scale else VectorAssembler(inputCols=["raw"], outputCol="features"))
    return Pipeline(stages=[*stages, estimator])


def select_features(train: DataFrame, columns: Sequence[str], options: ModelOptions) -> DataFrame:
    """(feature_name, selection_rank, selection_importance, forced_include, selected) by forest importance, then name."""
    spark = train.sparkSession
    if len(columns) <= options.feature_count or train.select("target").distinct().count() < 2:
        ranked = [(c, 0.0) for c in columns]
    else:
        forest = RandomForestClassifier(labelCol="target", weightCol="sample_weight", numTrees=20, maxDepth=options.depth, seed=options.seed)
        d = _weighted(train)
        importance = _pipeline(forest, columns).fit(d).stages[-1].featureImportances.toArray()
        d.unpersist()
        ranked = sorted(zip(columns, map(float, importance), strict=True), key=lambda r: (-r[1], r[0]))
    every = len(columns) <= options.feature_count
    rows = [(c, i, v, any(c.startswith(p) for p in options.forced_prefixes)) for i, (c, v) in enumerate(ranked, 1)]
    rows = [(*r, every or r[1] <= options.feature_count or r[3]) for r in rows]
    return spark.createDataFrame(rows, "feature_name string, selection_rank long, selection_importance double, forced_include boolean, selected boolean")


def _selected(selection: DataFrame) -> list[str]:
    return [r["feature_name"] for r in selection.where("selected").orderBy("selection_rank").collect()]


#: Parts in which training rows are held while models are fitted, and how many rows a part has where there are more.
_PARTS, _PART_ROWS = 8, 25_000


def _weighted(train: DataFrame) -> DataFrame:
    """Training rows with weights, dealt by their id, so that fits don't depend on how the rows were stored."""
    parts = max(_PARTS, -(-train.count() // _PART_ROWS))
    return sample_weights(train).repartition(parts, "alert_id").sortWithinPartitions("alert_id").cache()


def _constant(train: DataFrame) -> float | None:
    classes = [r["target"] for r in train.select("target").distinct().collect()]
    return None if len(classes) > 1 else float(bool(classes and classes[0] == 1))


#: What boosted trees are searched over: rounds, depth, rate, rows, columns and leaf size.
GBT_SPACE = {"maxIter": (10, 40, "int"), "maxDepth": (3, 6, "int"), "stepSize": (0.01, 0.2, "log"), "subsamplingRate": (0.7, 1.0, "float"), "columns": (0.7, 1.0, "float"), "minInstancesPerNode": (10, 100, "int")}


def _gbt(params: dict, budget: float, seed: int, **common) -> GBTClassifier:
    own = {k: v for k, v in params.items() if k not in ("maxIter", "columns")}
    return GBTClassifier(**common, **own, maxIter=max(1, round(params["maxIter"] * budget)), featureSubsetStrategy=f"{params['columns']:.3f}", seed=seed)


def fit_models(train: DataFrame, columns: Sequence[str], options: ModelOptions, selection: DataFrame | None = None) -> tuple[list[Ranker], DataFrame]:
    """Fitted candidates, and the trials of boosted trees (model_name, trial, parameters, budget, value, state). One class
    gives constants."""
    spark, columns, trials = train.sparkSession, list(columns), []
    schema = "model_name string, trial long, parameters string, budget double, value double, state string"
    constant = _constant(train)
    if constant is not None:
        return [Ranker(m, columns, None, constant) for m in options.models], spark.createDataFrame([], schema)
    d = _weighted(train)
    common = {"labelCol": "target", "weightCol": "sample_weight"}
    out = []
    for name in options.models:
        if name == "logistic_regression":
            out.append(Ranker(name, columns, _pipeline(LogisticRegression(**common, maxIter=100, regParam=1e-3), columns, scale=True).fit(d)))
        elif name == "random_forest":
            out.append(Ranker(name, columns, _pipeline(RandomForestClassifier(**common, numTrees=options.trees, maxDepth=options.depth, minInstancesPerNode=5, seed=options.seed), columns).fit(d)))
        elif name == "gbt":
            made: dict[tuple, Ranker] = {}

            def value(params: dict, budget: float, made=made) -> float:
                r = Ranker("gbt", columns, _pipeline(_gbt(params, budget, options.seed, **common), columns).fit(d), options=params)
                if budget == 1:
                    made[tuple(sorted(params.items()))] = r
                return selection_value(r.score(train if selection is None else selection), options)

            found = successive_halving(value, GBT_SPACE, options.trials, options.seed)
            trials += [(name, t.number, json.dumps(t.params, sort_keys=True), t.budget, t.value, t.state) for t in found]
            best = best_of(found)
            if best is None:
                raise RuntimeError("no setting of the boosted trees could be fitted")
            out.append(made[tuple(sorted(best.params.items()))])
    d.unpersist()
    return out, spark.createDataFrame(trials, schema)


def selection_value(scored: DataFrame, options: ModelOptions, score: str = "model_score") -> float:
    if options.metric == "pr_auc":
        return float(average_precision(scored, "target", score).first()["pr_auc"])
    if options.metric == "roc_auc":
        return float(roc_auc(scored, "target", score).first()["roc_auc"])
    return float(top_k(scored, "target", score, [options.k], "alert_id").first()[options.metric])


def selection_frame(frame: DataFrame) -> DataFrame:
    """Rows of the validation split, else of train, else all."""
    has = {r["split"] for r in frame.select("split").distinct().collect()}
    split = next((s for s in ("validation", "train") if s in has), None)
    return frame if split is None else frame.where(F.col("split") == split)


def champion_model(rankers: Sequence[Ranker], frame: DataFrame, options: ModelOptions) -> tuple[Ranker, DataFrame]:
    """The candidate of best selection metric, then average precision, then name; and the table of both metrics."""
    rows = []
    for r in rankers:
        s = r.score(frame)
        rows.append((r.name, selection_value(s, options), float(average_precision(s, "target", "model_score").first()["pr_auc"])))
    rows.sort(key=lambda x: (-x[1], -x[2], x[0]))
    table = frame.sparkSession.createDataFrame([(*r, i == 0) for i, r in enumerate(rows)], "model_name string, selection_value double, pr_auc double, champion boolean")
    return next(r for r in rankers if r.name == rows[0][0]), table


class Trained:
    """What training gives; each part is made when it is first asked for, so what needs one model fits no other."""

    def __init__(self, features: DataFrame, options: ModelOptions) -> None:
        self.features, self.options = features, options
        self._fitted: dict[str, tuple[Ranker, DataFrame]] = {}

    @cached_property
    def _prepared(self) -> tuple[DataFrame, list[str]]:
        return prepare(self.features)

    @property
    def frame(self) -> DataFrame:
        return self._prepared[0]

    @cached_property
    def _train(self) -> DataFrame:
        train = self.frame.where("split = 'train'")
        return self.frame if train.isEmpty() else train

    @cached_property
    def rows(self) -> DataFrame:
        """All training rows, stored; their weights alone balance the classes."""
        return stored(balanced_sample(self._train, None, None, self.options.seed), "training-rows")

    @cached_property
    def sample(self) -> DataFrame:
        """The balanced training rows by which the candidates are fitted, stored."""
        return stored(balanced_sample(self._train, self.options.negatives_per_positive, self.options.max_train_rows, self.options.seed), "training-sample")

    @cached_property
    def selection(self) -> DataFrame:
        return select_features(self.sample, self._prepared[1], self.options)

    @cached_property
    def columns(self) -> list[str]:
        return _selected(self.selection)

    @cached_property
    def valid(self) -> DataFrame:
        """The rows by which models are chosen, with the chosen columns, stored as they are scored many times."""
        return stored(selection_frame(self.frame).select("alert_id", "split", "target", *(f"`{c}`" for c in self.columns)), "selection-rows")

    def fitted(self, name: str) -> tuple[Ranker, DataFrame]:
        """The model of that name, and its trials."""
        if name not in self._fitted:
            (ranker,), trials = fit_models(self.sample, self.columns, replace(self.options, models=(name,)), self.valid if name == "gbt" else None)
            self._fitted[name] = ranker, trials
        return self._fitted[name]

    @cached_property
    def whole(self) -> Ranker:
        """The logistic regression of all training rows, which also choose its columns."""
        columns = _selected(select_features(self.rows, self._prepared[1], self.options))
        return fit_models(self.rows, columns, replace(self.options, models=("logistic_regression",)))[0][0]

    @property
    def rankers(self) -> list[Ranker]:
        return [self.fitted(m)[0] for m in self.options.models]

    @property
    def trials(self) -> DataFrame:
        """Those of the models that are searched; others have none."""
        searched = [m for m in self.options.models if m == "gbt"] or self.options.models[:1]
        return reduce(DataFrame.unionByName, (self.fitted(m)[1] for m in searched))

    @cached_property
    def _chosen(self) -> tuple[Ranker, DataFrame]:
        return champion_model(self.rankers, self.valid, self.options)

    @property
    def champion(self) -> Ranker:
        return self._chosen[0]

    @property
    def champions(self) -> DataFrame:
        return self._chosen[1]

    def scores(self, name: str | None = None) -> DataFrame:
        """(alert_id, split, target, score) of all alerts: score_<name> of that model, else the champion's model_score. The
        logistic regression is that of all training rows."""
        if name is None:
            ranker, out = self.champion, "model_score"
        else:
            ranker, out = self.whole if name == "logistic_regression" else self.fitted(name)[0], f"score_{name}"
        return ranker.score(self.frame, out).select("alert_id", "split", "target", out)

    @property
    def scored(self) -> DataFrame:
        rankers, champion = self.rankers, self.champion
        scored = reduce(lambda d, r: r.score(d, f"score_{r.name}"), rankers, self.frame).select("alert_id", *(f"score_{r.name}" for r in rankers), F.col(f"score_{champion.name}").alias("model_score"))
        return self.features.join(scored, "alert_id")


def train_and_score(features: DataFrame, options: ModelOptions | None = None) -> Trained:
    """Prepares, balances, selects, fits, chooses and scores all alerts: score_<model> and the champion's model_score."""
    return Trained(features, options or ModelOptions())


#: Rankings of alerts and the columns that they go by.
RANKINGS = {"rule_priority": "feature_rule_priority_score", "amount_rank": "feature_amount", "model_score": "model_score"}


def evaluate_rankings(scored: DataFrame, ks: Sequence[int] = (100, 500, 1000, 5000), rankings: dict[str, str] | None = None) -> DataFrame:
    """(split, ranking, metric, k, value): average precision and ROC area, and top-k metrics, of model, rule and amount
    rankings (or those given) on the test split, else validation, else all. The areas of all rankings are one pass."""
    rankings = rankings or RANKINGS
    level = F.when(F.col("split") == "test", 2).when(F.col("split") == "validation", 1).otherwise(0)
    has = scored.agg(F.max(level).alias("_best"))
    d = scored.join(F.broadcast(has), how="cross").where((F.col("_best") == 0) | (level == F.col("_best")))
    name = has.select(F.when(F.col("_best") == 2, "test").when(F.col("_best") == 1, "validation").otherwise("all").alias("split"))
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("ranking"), F.col(c).cast("double").alias("s")) for r, c in rankings.items())))
    both = areas(d.select("target", each.alias("_x")).select("target", "_x.*"), "target", "s", ["ranking"])
    # a ranking without rows has areas too
    names = scored.sparkSession.createDataFrame([(r,) for r in rankings], "ranking string")
    both = F.broadcast(names).join(both, "ranking", "left").na.fill(0.0, ["pr_auc", "roc_auc"])
    rows = [both.unpivot(["ranking"], ["pr_auc", "roc_auc"], "metric", "value").select("ranking", "metric", F.lit(None).cast("long").alias("k"), "value")]
    for r, c in rankings.items():
        at = top_k(d, "target", c, ks, "alert_id")
        rows.append(at.select("k", "precision_at_k", "recall_at_k", "lift_at_k").unpivot(["k"], ["precision_at_k", "recall_at_k", "lift_at_k"], "metric", "value").select(F.lit(r).alias("ranking"), "metric", "k", "value"))
    return reduce(DataFrame.unionByName, rows).join(F.broadcast(name), how="cross")


def compare_models(first: DataFrame, second: DataFrame) -> DataFrame:
    """(metric, k, split, mvp_value, extended_value, delta, winner) from two tables of (split, ranking, metric, k, value).

    Areas of the model ranking are matched by metric with 0 for a missing one, top-k metrics by split and k."""
    model = F.col("ranking") == "model_score"
    areas = [t.where(model & F.col("k").isNull()).select("metric", F.col("value").alias(v)) for t, v in ((first, "mvp_value"), (second, "extended_value"))]
    a = areas[0].join(areas[1], "metric", "full").select("metric", F.lit(None).cast("long").alias("k"), F.lit(None).cast("string").alias("split"), F.coalesce("mvp_value", F.lit(0.0)).alias("mvp_value"), F.coalesce("extended_value", F.lit(0.0)).alias("extended_value"))
    tops = [t.where(model & F.col("k").isNotNull()).select("metric", "k", "split", F.col("value").alias(v)) for t, v in ((first, "mvp_value"), (second, "extended_value"))]
    d = a.unionByName(tops[0].join(tops[1], ["metric", "k", "split"]))
    return d.withColumns({"delta": F.col("extended_value") - F.col("mvp_value"), "winner": F.when(F.col("extended_value") > F.col("mvp_value"), "extended").when(F.col("mvp_value") > F.col("extended_value"), "mvp").otherwise("tie")})


def select_champion(comparison: DataFrame, metric: str = "precision_at_k", k: int = 1000, min_delta: float = 0.0) -> DataFrame:
    """One row: the extended model if its delta on the primary metric (else on pr_auc) exceeds the minimum."""
    main = (F.col("metric") == metric) & (F.coalesce("k", F.lit(k)) == k)
    spare = F.col("metric") == "pr_auc"
    d = comparison.where(main | spare).orderBy(F.when(main, 0).otherwise(1), "split").limit(1)
    none = comparison.agg(F.lit(1).alias("_one"))
    d = F.broadcast(none).join(d, how="left").withColumn("delta", F.coalesce("delta", F.lit(0.0)))
    up = F.col("delta") > min_delta
    return d.select(F.when(up, "extended").otherwise("mvp").alias("selected_model"), F.when(up, "promote_extended").otherwise("keep_mvp").alias("decision"), F.coalesce("metric", F.lit(metric)).alias("primary_metric"), F.when(F.col("metric").isNull(), k).otherwise(F.col("k")).cast("long").alias("primary_k"), "mvp_value", "extended_value", "delta", F.lit(min_delta).alias("min_delta"))


def calibrate(scored: DataFrame, method: str = "isotonic", score: str = "model_score", out: str = "calibrated_score", split: str = "validation", least_rows: int = 10) -> DataFrame:
    """Adds calibrated_score and calibration_method: isotonic (2 positives at least), sigmoid, or the score itself where
    the calibration rows don't allow a fit."""
    rows = scored.where(F.col("split") == split).select(F.coalesce(F.col(score), F.lit(0.0)).alias("_x"), F.col("target").cast("double").alias("label"))
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("y")).first()
    can = n["n"] >= least_rows and 0 < n["y"] < n["n"]
    d = scored.withColumn("_x", F.coalesce(F.col(score), F.lit(0.0)))
    assemble = VectorAssembler(inputCols=["_x"], outputCol="_v")
    if can and method == "isotonic" and n["y"] >= 2:
        d = interpolated(d, "_x", isotonic_knots(rows, "_x", "label"), "_p").withColumn(out, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_p"))))
        used = "isotonic"
    elif can and method in ("isotonic", "sigmoid"):
        model = LogisticRegression(featuresCol="_v", labelCol="label", predictionCol="_p", probabilityCol="_q", rawPredictionCol="_r").fit(assemble.transform(rows))
        d = model.transform(assemble.transform(d)).withColumn(out, vector_to_array("_q")[1])
        used = "sigmoid"
    else:
        d, used = d.withColumn(out, F.col("_x")), "identity"
    return d.select(*scored.columns, out, F.lit(used).alias("calibration_method"))


def permutation_importance(ranker: Ranker, frame: DataFrame, repeats: int = 3, seed: int = 42) -> DataFrame:
    """(feature_name, importance): the mean drop in accuracy when a column is shuffled among rows.

    Where no column's drop counts, the model's own importances stand in, and 1 where these are nothing either. In each
    repeat a row exchanges its values with another, told by the rank of a hash; each row is then scored once with every
    column exchanged whose value is another one, all columns and repeats in one job. Where the value stays the same, as in
    most rows of a column of few values, so does the score.
    """
    columns = list(ranker.columns)
    hit = F.when((F.col("model_score") >= 0.5).cast("int") == F.col("target"), 1).otherwise(0)
    d = stored(ranker.score(frame.select("alert_id", "target", *columns)).select("alert_id", "target", *columns, hit.alias("_hit")), "permutation-rows")
    shuffles = F.explode(F.array(*(F.lit(r) for r in range(repeats + 1)))).alias("r")
    ranks = d.select("alert_id", shuffles).withColumn("_h", F.xxhash64(F.lit(seed) + F.col("r"), "alert_id"))
    ranks = stored(positions(ranks, "_h", ["alert_id"], ["r"]).select("alert_id", "r", "position"), "permutation-ranks")
    own, other = ranks.where("r = 0").select(F.col("alert_id"), "position"), ranks.where("r > 0").select(F.col("alert_id").alias("_id"), "r", "position")
    values = d.select(F.col("alert_id").alias("_id"), F.struct(*columns).alias("_new"))
    pairs = own.join(other, "position").drop("position").join(values, "_id").join(d, "alert_id")
    other_value = (F.when(~F.col(f"`{c}`").eqNullSafe(F.col(f"_new.`{c}`")), F.lit(i)) for i, c in enumerate(columns))
    mixed = pairs.withColumn("_c", F.explode(F.array_compact(F.array(*other_value))))
    mixed = mixed.withColumns({c: F.when(F.col("_c") == i, F.col(f"_new.`{c}`")).otherwise(F.col(f"`{c}`")) for i, c in enumerate(columns)})
    n = max(1, d.count() * repeats)
    lost = ranker.score(mixed.select("_c", "target", "_hit", *columns)).groupBy("_c").agg(F.sum(F.col("_hit") - hit).alias("lost"))
    drops = {r["_c"]: r["lost"] / n for r in lost.collect()}
    rows = [(c, float(drops.get(i, 0.0))) for i, c in enumerate(columns)]
    if not any(v for _, v in rows):
        rows = [(r["feature_name"], r["importance"]) for r in ranker.importance(frame.sparkSession).collect()]
    if not any(v for _, v in rows):
        rows = [(c, 1.0) for c, _ in rows]
    return frame.sparkSession.createDataFrame(rows, "feature_name string, importance double")


def explanation_weights(ranker: Ranker, frame: DataFrame, repeats: int = 3, seed: int = 42) -> dict[str, float]:
    """The weight of each of the model's columns for `explain.contributions`."""
    return {r["feature_name"]: r["importance"] for r in permutation_importance(ranker, frame, repeats, seed).collect()}


def with_constant_score(features: DataFrame, train: DataFrame) -> DataFrame:
    """model_score of a training set with one class: 1 if that is the positive one, else 0; null with two classes."""
    one = train.agg(F.when(F.min("target") == F.max("target"), F.max("target").cast("double")).alias("model_score"))
    return join_same(features, one, [])
