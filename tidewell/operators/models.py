"""Churn score and customer segments with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import scratch_path, settle


def _features(columns: Sequence[str]) -> list:
    return [
        VectorAssembler(inputCols=list(columns), outputCol="__raw", handleInvalid="keep"),
        StandardScaler(inputCol="__raw", outputCol="__features", withMean=True),
    ]


def fit_churn(customers: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    """Logistic regression of a 0/1 label on numeric features."""
    classifier = LogisticRegression(
        featuresCol="__features", labelCol=label, probabilityCol="__probability", maxIter=25
    )
    fitted = Pipeline(stages=[*_features(features), classifier]).fit(customers)
    # a fitted classifier holds on to its training frame and would send it with every task;
    # one that was stored and read again holds its weights alone
    place = scratch_path(customers.sparkSession, "churn-model")
    fitted.write().save(place)
    return PipelineModel.load(place)


def churn_scores(model: PipelineModel, customers: DataFrame) -> DataFrame:
    scored = model.transform(customers)
    score = vector_to_array("__probability")[1]
    return scored.select(*customers.columns, score.alias("churn_score"), F.col("prediction"))


def held_out(key: str, share: int = 5) -> Column:
    """One in ``share`` customers, by a hash of the key: the same ones in every run."""
    digits = F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8)
    return F.coalesce(F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(share)) == 0, F.lit(False))


# Scores are counted in this many even bins; two scores in one bin count as a tie.
SCORE_BINS = 1_000_000


def classification_quality(scored: DataFrame, label: str, score: str = "churn_score", cut: float = 0.5) -> DataFrame:
    """One row: the confusion matrix at ``cut``, precision, recall, F1 and the area under the curve.

    The area is the share of (positive, negative) pairs that the score puts in order, ties
    counting half.  Scores are counted per bin first, so only bins meet in one task.
    """
    yes, high = F.col(label) == 1, F.col(score) >= cut
    place = F.floor(F.col(score) * SCORE_BINS)
    bins = scored.groupBy(place.alias("bin")).agg(
        F.count_if(yes).alias("p"),
        F.count_if(~yes).alias("n"),
        *[F.count_if(which).alias(name) for name, which in (("tp", yes & high), ("fp", ~yes & high), ("fn", yes & ~high), ("tn", ~yes & ~high))],
    )
    below = F.coalesce(F.sum("n").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = bins.withColumn("won", F.col("p") * (below + F.col("n") / 2)).agg(*[F.sum(c).alias(c) for c in ("p", "n", "won", "tp", "fp", "fn", "tn")])
    precision, recall = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    return whole.select(
        "tp", "fp", "fn", "tn",
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
        F.try_divide("won", F.col("p") * F.col("n")).alias("auc"),
    )


def evaluate_churn(customers: DataFrame, key: str, features: Sequence[str], label: str) -> tuple[DataFrame, DataFrame]:
    """Train on four fifths of the customers; the others scored, and the quality of their scores."""
    model = fit_churn(customers.filter(~held_out(key)), features, label)
    scored = churn_scores(model, customers.filter(held_out(key)))
    return scored, classification_quality(scored, label)


def evaluate_segments(customers: DataFrame, key: str, features: Sequence[str], counts: Sequence[int], seed: int = 1) -> DataFrame:
    """segments, customers, used, silhouette: how well each number of clusters fits held-out customers."""
    spark = customers.sparkSession
    # every fit and score reads the features several times; what makes them is run once
    customers = settle(customers.select(key, *features), "segment-features")
    train, test = customers.filter(~held_out(key)), customers.filter(held_out(key))
    told = []
    for count in counts:
        cluster = KMeans(k=count, seed=seed, featuresCol="__features", predictionCol="segment")
        found = Pipeline(stages=[*_features(features), cluster]).fit(train).transform(test)
        sizes = found.agg(F.count("*").alias("n"), F.countDistinct("segment").alias("used")).first()
        silhouette = None
        if sizes["used"] > 1:
            silhouette = ClusteringEvaluator(featuresCol="__features", predictionCol="segment").evaluate(found)
        told.append((count, sizes["n"], sizes["used"], silhouette))
    return spark.createDataFrame(told, "segments int, customers long, used long, silhouette double")


def segments(
    customers: DataFrame, features: Sequence[str], count: int, seed: int = 1
) -> DataFrame:
    """Customers with the number of the cluster they belong to."""
    cluster = KMeans(k=count, seed=seed, featuresCol="__features", predictionCol="segment")
    model = Pipeline(stages=[*_features(features), cluster]).fit(customers)
    return model.transform(customers).select(*customers.columns, "segment")
