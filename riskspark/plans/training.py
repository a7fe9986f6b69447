"""Preprocess, train and evaluate: split, bin, encode, fit, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.labels import training_gate
from ..functions.text import class_at
from ..operators.binning import QuantileBinner, QuantileBinnerModel
from ..operators.boosting import LEAST_GAIN, NewtonTrees, NewtonTreesModel
from ..operators.encode import collapse, drop_helpers, fit_encoder
from ..operators.metrics import classification_report, roc_auc
from ..operators.split import stratified_split
from ..schema import BIN_COLUMNS, BIN_LABELS, FEATURES, FILL_UNKNOWN
from ..session import materialize
from ..sources.files import write_predictions


@dataclass(frozen=True)
class Layout:
    """Which columns are binned, how bins are called, and the order of the encoded blocks."""

    bins: Mapping[str, str]
    bin_labels: Mapping[str, Sequence[str]]
    features: Sequence[str]
    fill: Mapping[str, str]


APPLICANT_LAYOUT = Layout(BIN_COLUMNS, BIN_LABELS, FEATURES, FILL_UNKNOWN)


def class_weights(df: DataFrame, label: str, weight: str | None = None) -> DataFrame:
    """(label, n, weight) with weight = total / (classes * n): every class weighs the same in sum."""
    rows = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
    counts = df.groupBy(label).agg(rows.alias("n"))
    totals = counts.agg(F.sum("n").cast("double").alias("n"), F.count(F.lit(1)).cast("double").alias("k"))
    total, classes = totals.select("n").scalar(), totals.select("k").scalar()
    return counts.select(label, "n", (total / (classes * F.col("n"))).alias("weight"))


def prepare(
    df: DataFrame, key: str, layout: Layout = APPLICANT_LAYOUT, target: str = "target", test_size: float = 0.2,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with numeric ``label``; nulls filled and error rows set aside.

    Only the needed columns are written. The split is written once as well, by side, so that a later pass over a side
    is a plain scan of its files.
    """
    source = [c for c in layout.features if c not in layout.bins.values()]
    clean, _ = training_gate(df.select(key, *source, *layout.bins, target), target)
    clean = materialize(clean.fillna(dict(layout.fill)).drop(target), "clean")
    rows = materialize(stratified_split(clean, key, "label", test_size, seed), "split", partition_by="is_test")
    return rows.where("not is_test").drop("is_test"), rows.where("is_test").drop("is_test")


def fit_binner(train: DataFrame, layout: Layout = APPLICANT_LAYOUT) -> QuantileBinnerModel:
    return QuantileBinner(
        inputCols=list(layout.bins),
        outputCols=list(layout.bins.values()),
        labels=[list(layout.bin_labels[c]) for c in layout.bins],
    ).fit(train)


def fit_features(train: DataFrame, layout: Layout = APPLICANT_LAYOUT) -> tuple[PipelineModel, DataFrame]:
    """Frozen bin edges and categories of the training rows as one model, and the merged training rows.

    Rows are merged to distinct combinations right after binning; categories and vectors are made from those.
    """
    binner = fit_binner(train, layout)
    counted = materialize(collapse(binner.transform(train), [*layout.features, "label"]), "combinations")
    encoder = fit_encoder(counted, layout.features)
    return PipelineModel([binner, *encoder.stages]), _encoded(counted, encoder)


def merged_rows(df: DataFrame, features: PipelineModel, layout: Layout = APPLICANT_LAYOUT) -> DataFrame:
    """Encoded rows merged by (features, label): (label, n, features)."""
    binner, encoder = features.stages[0], PipelineModel(features.stages[1:])
    return _encoded(collapse(binner.transform(df), [*layout.features, "label"]), encoder)


def _encoded(counted: DataFrame, encoder: PipelineModel) -> DataFrame:
    return drop_helpers(encoder.transform(counted)).select("label", "n", "features")


def balanced(merged: DataFrame) -> tuple[DataFrame, float]:
    """Merged rows with ``weight`` = class weight times row count, and the sum of the weights."""
    counts = {r.label: r.n for r in merged.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    total = sum(counts.values())
    per_row = F.when(F.lit(False), F.lit(0.0))
    for label, n in counts.items():
        per_row = per_row.when(F.col("label") == label, F.lit(total / (len(counts) * n)))
    return merged.withColumn("weight", per_row * F.col("n")), float(total)


def fit_logistic(merged: DataFrame, max_iter: int = 1000, c: float = 1.0, balance: bool = True):
    """L2 logistic regression with inverse strength ``c`` on summed loss; the intercept is not penalised."""
    if balance:
        rows, total = balanced(merged)
    else:
        rows = merged.withColumn("weight", F.col("n").cast("double"))
        total = float(merged.agg(F.sum("n")).first()[0])
    return LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="weight", regParam=1.0 / (c * total), elasticNetParam=0.0,
        standardization=False, maxIter=max_iter, tol=1e-10,
    ).fit(rows)


def fit_trees(merged: DataFrame, rounds: int = 20, depth: int = 3, eta: float = 0.1, seed: int = 42):
    """Boosted trees on the logistic loss."""
    return GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="n", maxIter=rounds, maxDepth=depth, stepSize=eta,
        seed=seed, minInstancesPerNode=1,
    ).fit(merged)


def fit_newton(merged: DataFrame, rounds: int = 20, depth: int = 3, eta: float = 0.1, l2: float = 1.0, least_cover: float = 1.0,
               least_gain: float = LEAST_GAIN, max_bins: int = 256) -> NewtonTreesModel:
    """Second-order boosted trees on the logistic loss, with L2 on the leaves."""
    return NewtonTrees(
        featuresCol="features", labelCol="label", weightCol="n", rounds=rounds, depth=depth, eta=eta, l2=l2,
        leastCover=least_cover, leastGain=least_gain, maxBins=max_bins,
    ).fit(merged)


def predictions(scored: DataFrame, *keep: str) -> DataFrame:
    """(keep..., y_prob, y_pred) from the output of a classifier."""
    prob = F.get(vector_to_array("probability"), F.lit(1))
    return scored.select(*keep, prob.alias("y_prob")).withColumn("y_pred", class_at(F.col("y_prob")))


def evaluate(merged_test: DataFrame, classifier) -> DataFrame:
    """(label, metric, value): the classification report and the AUC of a classifier on merged rows."""
    scored = predictions(classifier.transform(merged_test), "label", "n")
    scored = materialize(scored.withColumnRenamed("label", "y_true"), "scored")
    report = classification_report(scored, weight="n")
    auc = roc_auc(scored, weight="n").select(
        F.lit("roc_auc").alias("label"), F.lit("roc_auc").alias("metric"), F.col("auc").alias("value")
    )
    return report.unionByName(auc)


def round_aucs(merged: DataFrame, model: GBTClassificationModel | NewtonTreesModel) -> DataFrame:
    """(round, auc): the AUC on merged rows after each boosting round."""
    rows = merged.select("label", "n", "features")
    if isinstance(model, NewtonTreesModel):
        return _aucs_by_round(model.round_margins(rows, "label", "n"))
    margins = []
    for i, tree in enumerate(model.trees):
        rows = tree.setPredictionCol(f"_tree_{i}").transform(rows)
        step = F.col(f"_tree_{i}") * float(model.treeWeights[i])
        margins.append(margins[-1] + step if margins else step)
    cells = F.array(*[F.struct(F.lit(i).alias("round"), m.alias("score")) for i, m in enumerate(margins, 1)])
    return _aucs_by_round(rows.select("label", "n", F.inline(cells)))


def _aucs_by_round(scored: DataFrame) -> DataFrame:
    """(round, auc) from rows (label, n, round, score)."""
    by_score = scored.groupBy("round", "score").agg(
        F.sum(F.col("n") * F.col("label")).alias("pos"), F.sum(F.col("n") * (1 - F.col("label"))).alias("neg"))
    # One window per round over its distinct scores, of which a round has at most 2 ** (depth * round).
    upto = Window.partitionBy("round").orderBy("score").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pairs = by_score.withColumn("twice", F.col("pos").cast("double") * (2 * F.sum("neg").over(upto) - F.col("neg")))
    total = pairs.groupBy("round").agg(*[F.sum(c).cast("double").alias(c) for c in ("twice", "pos", "neg")])
    return total.select("round", F.try_divide("twice", F.lit(2.0) * F.col("pos") * F.col("neg")).alias("auc"))


def gradient(merged: DataFrame, classifier, names: DataFrame, c: float = 1.0) -> DataFrame:
    """(feature, category, gradient) of the penalised balanced loss at the fitted coefficients: zero at the optimum.

    ``names`` has (position, feature, category).
    """
    rows, _ = balanced(merged)
    residual = (F.get(vector_to_array("probability"), F.lit(1)) - F.col("label")) * F.col("weight")
    cells = F.transform(vector_to_array("features"), lambda v, i: F.struct(i.alias("position"), v.alias("value")))
    scored = classifier.transform(rows).select(residual.alias("residual"), F.inline(F.filter(cells, lambda x: x["value"] != 0)))
    sums = scored.groupBy("position").agg(F.sum(F.col("residual") * F.col("value")).alias("loss"))
    coefficients = F.lit([float(x) for x in classifier.coefficients])
    penalty = F.get(coefficients, F.col("position")) / c
    return names.join(sums, "position", "left").select(
        "feature", "category", (F.coalesce("loss", F.lit(0.0)) + penalty).alias("gradient"))


@dataclass(frozen=True)
class Fitted:
    """A model with the rows it was fitted on and those held out; ``model`` scores raw rows."""

    model: PipelineModel
    merged: DataFrame
    train: DataFrame
    test: DataFrame

    @property
    def features(self) -> PipelineModel:
        return PipelineModel(self.model.stages[:-1])

    @property
    def classifier(self):
        return self.model.stages[-1]


@dataclass(frozen=True)
class TrainingRun(Fitted):
    report: DataFrame


def fit(
    df: DataFrame, key: str, layout: Layout = APPLICANT_LAYOUT, algorithm: str = "logistic", seed: int = 42,
    test_size: float = 0.2, **options: object,
) -> Fitted:
    """Prepare and fit, without evaluating."""
    train, test = prepare(df, key, layout, test_size=test_size, seed=seed)
    features, merged = fit_features(train, layout)
    classifier = {"logistic": fit_logistic, "trees": fit_trees, "newton": fit_newton}[algorithm](merged, **options)
    return Fitted(PipelineModel([*features.stages, classifier]), merged, train, test)


def train_and_evaluate(
    df: DataFrame, key: str, layout: Layout = APPLICANT_LAYOUT, algorithm: str = "logistic", seed: int = 42,
    test_size: float = 0.2, **options: object,
) -> TrainingRun:
    """The whole flow; ``model`` scores raw rows and can be saved and loaded as one pipeline."""
    done = fit(df, key, layout, algorithm, seed, test_size, **options)
    report = evaluate(merged_rows(done.test, done.features, layout), done.classifier)
    return TrainingRun(done.model, done.merged, done.train, done.test, report)


def held_out_predictions(run: TrainingRun, key: str) -> DataFrame:
    """(key, y_true, y_prob, y_pred) of the held-out rows."""
    return predictions(run.model.transform(run.test.withColumnRenamed("label", "y_true")), key, "y_true")


def save_run(run: TrainingRun, key: str, folder: str, mode: str = "overwrite") -> None:
    """Model, metrics (figures and four-decimal text) and held-out predictions under one folder."""
    run.model.write().overwrite().save(f"{folder}/model")
    run.report.withColumn("text", F.format_string("%.4f", "value")).write.mode(mode).parquet(f"{folder}/metrics")
    write_predictions(held_out_predictions(run, key), f"{folder}/predictions", key, mode=mode)


def report_text(report: DataFrame) -> DataFrame:
    """(label, metric, text): figures with four decimals."""
    return report.select("label", "metric", F.format_string("%.4f", "value").alias("text"))
