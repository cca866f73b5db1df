"""Classifiers, grid search and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.models.features import hash_number
from tabloom.plans.blocks import running_total
from tabloom.plans.written import written


def tree_classifier(depth: int = 5, label: str = "label", seed: int = 42) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, featuresCol="features", maxDepth=depth, seed=seed)


def logistic(label: str = "label", penalty: float = 0.0) -> LogisticRegression:
    return LogisticRegression(labelCol=label, featuresCol="features", regParam=penalty)


def linear_svm(label: str = "label", penalty: float = 0.01, iterations: int = 100) -> LinearSVC:
    """Linear support vectors, ranked by raw margin."""
    return LinearSVC(labelCol=label, featuresCol="features", regParam=penalty, maxIter=iterations, tol=1e-4)


def auc_evaluator(label: str = "label") -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC")


def grid_search(
    df: DataFrame,
    candidates: Sequence[Pipeline],
    key: str,
    folds: int = 5,
    label: str = "label",
    seed: int = 42,
    parallelism: int = 4,
) -> tuple[CrossValidatorModel, DataFrame]:
    """Best candidate by mean ROC-AUC over the folds, refitted on all rows, and the table of scores.

    A row's fold comes from its key, so folds do not depend on partitioning. The
    fits of a fold run side by side, each of them distributed.
    """
    pipe = Pipeline(stages=[])
    grid = [{pipe.stages: c.getStages()} for c in candidates]
    data = df.withColumn("_fold", (hash_number(F.col(key), seed) % folds).cast("int"))
    search = CrossValidator(
        estimator=pipe, estimatorParamMaps=grid, evaluator=auc_evaluator(label), numFolds=folds,
        foldCol="_fold", parallelism=parallelism,
    )
    fitted = search.fit(data)
    scores = [(i, describe_model(c), float(m)) for i, (c, m) in enumerate(zip(candidates, fitted.avgMetrics))]
    return fitted, df.sparkSession.createDataFrame(scores, "candidate int, model string, auc double")


def describe_model(pipe: Pipeline) -> str:
    """Classifier name with the parameters that were set on it."""
    model = pipe.getStages()[-1]
    shown = {p.name: v for p, v in model._paramMap.items() if not p.name.endswith("Col") and p.name != "seed"}
    return f"{type(model).__name__}({', '.join(f'{k}={v}' for k, v in sorted(shown.items()))})"


def score(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Kept columns with ``prediction`` and ``score``: probability of class 1, or the margin if there is none."""
    out = model.transform(df)
    raw = "probability" if "probability" in out.columns else "rawPrediction"
    return out.select(*keep, "prediction", vector_to_array(F.col(raw))[1].alias("score"))


def auc_rank(df: DataFrame, label: str, score_col: str) -> DataFrame:
    """Exact ROC-AUC as the Mann–Whitney share of ordered pairs, ties counted half."""
    pos, neg = F.sum((F.col(label) == 1).cast("long")), F.sum((F.col(label) == 0).cast("long"))
    per = df.filter(F.col(score_col).isNotNull()).groupBy(F.col(score_col).alias("_s")).agg(pos.alias("_p"), neg.alias("_q"))
    run = running_total(per, F.col("_s"), F.col("_s"), {"_below": F.col("_q")})
    wins = F.col("_p") * (F.col("_below") - F.col("_q") / 2)
    sums = run.agg(F.sum(wins).alias("w"), F.sum("_p").alias("p"), F.sum("_q").alias("q"))
    return sums.select(F.try_divide(F.col("w"), F.col("p").cast("double") * F.col("q")).alias("auc"))


def grouped_auc(df: DataFrame, group: str, label: str, score_col: str) -> DataFrame:
    """Exact ROC-AUC of every group (a whole number): group, ``auc``; null where a class is missing.

    One order over all groups, cut into blocks, so a group may be of any size:
    what lies before a group is taken off its running counts.
    """
    pos, neg = F.sum((F.col(label) == 1).cast("long")), F.sum((F.col(label) == 0).cast("long"))
    per = df.filter(F.col(score_col).isNotNull()).groupBy(group, F.col(score_col).alias("_s")).agg(pos.alias("_p"), neg.alias("_q"))
    # a row per different score, read several times to find and run through the order
    run = running_total(written(per, "auc-scores"), F.col(group), F.col("_s"), {"_upto": F.col("_q")})
    before = F.min(F.col("_upto") - F.col("_q"))
    wins = F.sum(F.col("_p").cast("double") * (F.col("_upto") - F.col("_q") / 2))
    sums = run.groupBy(group).agg(wins.alias("_w"), before.alias("_before"), F.sum("_p").alias("_p"), F.sum("_q").alias("_q"))
    won = F.col("_w") - F.col("_before") * F.col("_p").cast("double")
    return sums.select(group, F.try_divide(won, F.col("_p").cast("double") * F.col("_q")).alias("auc"))


def risk_segment(
    pred: DataFrame, profit: DataFrame, key: str, value: str, limit: float = 0.8, wanted: float = 1.0
) -> DataFrame:
    """Rows of one predicted class among the rows that carry the leading share of profit."""
    from tabloom.operators.ranking import pareto_segment

    joined = pred.join(profit.select(key, value), key)
    return pareto_segment(joined, value, key, limit).filter(F.col("prediction") == wanted)


def confusion(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Counts and the usual rates of a 0/1 prediction."""
    a, p = F.col(label) == 1, F.col(prediction) == 1
    c = df.agg(
        F.count_if(a & p).alias("tp"), F.count_if(~a & p).alias("fp"),
        F.count_if(a & ~p).alias("fn"), F.count_if(~a & ~p).alias("tn"),
    )
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    rate = lambda x, y: F.try_divide(x.cast("double"), y.cast("double"))
    return c.select(
        "tp", "fp", "fn", "tn",
        rate(F.col("tp") + F.col("tn"), total).alias("accuracy"),
        rate(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        rate(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )


