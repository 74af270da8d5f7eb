"""Registered queries that fit or apply models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeline.operators import models, sampling
from gradeline.operators.knn import knn_classify as classify
from gradeline.operators.relate import scaler_stats
from gradeline.plans.inputs import LEARN_SPEC, learnable, table
from gradeline.plans.table_queries import rounded
from gradeline.sources.stage import new_dir

KEY = ["rec_id"]
#: Full model sizes; the network and the trees are fitted on at most this many training rows.
FIT_ROWS = 10_000
OPTIONS = models.ModelOptions(fit_rows=FIT_ROWS)


#: Models whose fitted values are determined, so that SQL can find them too; the first is the floor of the others.
EXACT = ("naive_bayes", "logistic_regression", "knn")
FLOOR = EXACT[0]


def _prepared(spark, sf_dir):
    return models.prepare(learnable(spark, sf_dir), LEARN_SPEC, KEY)


def _tested(spark, sf_dir, name):
    """Test rows of the learnable table with the predictions of one model."""
    return models.train_model(name, _prepared(spark, sf_dir), LEARN_SPEC, new_dir(spark, "models"), options=OPTIONS)


def _predictions(spark, sf_dir, name):
    return _tested(spark, sf_dir, name).select("rec_id", "quality", "prediction")


def _above_floor(spark, sf_dir, name):
    """Right test rows of a model whose values depend on draws, counted up to those of naive Bayes on the same split.

    ``counted_hits`` is the lesser of the two: it falls short of ``floor_hits`` where the model is worse.
    """
    prepared, store = _prepared(spark, sf_dir), new_dir(spark, "models")
    # Both models scale alike: take the means and deviations of the training rows once.
    stats = scaler_stats(prepared.where("NOT is_test"), LEARN_SPEC.feature_cols)
    tested = reduce(DataFrame.unionByName, [
        models.train_model(m, prepared, LEARN_SPEC, store, options=OPTIONS, stats=stats) for m in (name, FLOOR)
    ])
    right = F.col("prediction") == F.col("quality")
    own = F.col("model") == name
    return tested.groupBy("quality").agg(
        F.count_if(own).alias("n_test"), F.count_if(right & own).alias("hits"), F.count_if(right & ~own).alias("floor_hits")
    ).groupBy(F.lit(name).alias("model")).agg(
        F.sum("n_test").alias("n_test"), F.sum("floor_hits").alias("floor_hits"),
        F.least(F.sum("hits"), F.sum("floor_hits")).alias("counted_hits"),
    )


def gaussian_nb(spark, sf_dir):
    return _predictions(spark, sf_dir, "naive_bayes")


def logistic_regression(spark, sf_dir):
    return _predictions(spark, sf_dir, "logistic_regression")


def mlp(spark, sf_dir):
    return _above_floor(spark, sf_dir, "neural_network")


def random_forest(spark, sf_dir):
    return _above_floor(spark, sf_dir, "random_forest")


def bagging(spark, sf_dir):
    return _above_floor(spark, sf_dir, "bagging")


def knn_classify(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("features")
    )
    split = sampling.stratified_split(rows, "label", ["vec_id"])
    tested = split.where("is_test")
    voted = classify(
        tested, split.where("NOT is_test").withColumnRenamed("vec_id", "train_id"),
        "vec_id", "train_id", "label",
    )
    shown = tested.select("vec_id", "label").join(voted, "vec_id")
    return rounded(shown)


def model_ranking(spark, sf_dir):
    """All six models on one split, by falling accuracy.

    The accuracy of the exact models is shown in full, that of the others up to naive Bayes, as far as SQL can
    determine it; ``place`` is the rank by what is shown, equal ones sharing a place.
    """
    counts = models.train_compare(learnable(spark, sf_dir), LEARN_SPEC, new_dir(spark, "models"), KEY, options=OPTIONS)
    ranked = models.model_ranking(counts)
    # One row per model.
    together = Window.partitionBy("n")
    floor = F.max(F.when(F.col("model") == FLOOR, F.col("accuracy"))).over(together)
    exact = F.col("model").isin(*EXACT)
    shown = ranked.withColumn("shown", F.when(exact, F.col("accuracy")).otherwise(F.least("accuracy", floor)))
    return shown.select(
        "model", "n", F.round("shown", 6).alias("accuracy_shown"), F.rank().over(together.orderBy(F.desc("shown"))).alias("place")
    )


def score(spark, sf_dir):
    rows, store = learnable(spark, sf_dir), new_dir(spark, "models")
    models.train_model("naive_bayes", _prepared(spark, sf_dir), LEARN_SPEC, store)
    return models.score(rows.drop("quality"), store, "naive_bayes")


QUERIES = {
    f.__name__: f
    for f in (
        gaussian_nb, knn_classify, logistic_regression, mlp, random_forest, bagging,
        model_ranking, score,
    )
}
