"""Behavioural segments: scaled features, k-means and names by overdue rate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Cluster count, seed, and names from the worst to the best mean overdue rate.
CLUSTERS, SEED = 4, 42
PROFILES = ("High risk", "Medium risk", "Low risk", "Premium")
SEGMENT_FEATURES = ("billed_90d", "n_invoices", "pay_rate", "overdue_rate", "recency_days", "recency_score")


def impute_recency(df: DataFrame) -> DataFrame:
    """A customer without invoices is as far away as the least recent one, not the most recent."""
    oldest = df.agg(F.max("recency_days")).scalar()
    return df.withColumn("recency_days", F.coalesce("recency_days", oldest, F.lit(0)))


def scale(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Adds ``raw`` and ``scaled`` vectors (mean 0, deviation 1); NULL counts as 0."""
    filled = df.fillna(0, subset=list(features))
    assembled = VectorAssembler(inputCols=list(features), outputCol="raw").transform(filled)
    scaler = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True)
    return scaler.fit(assembled).transform(assembled)


def fit(scaled: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> tuple[KMeansModel, DataFrame]:
    model = KMeans(k=k, seed=seed, featuresCol="scaled", predictionCol="cluster").fit(scaled)
    return model, model.transform(scaled)


def silhouette(clustered: DataFrame) -> float:
    return ClusteringEvaluator(featuresCol="scaled", predictionCol="cluster", metricName="silhouette").evaluate(clustered)


def name_clusters(clustered: DataFrame) -> DataFrame:
    """Cluster numbers are arbitrary, so profiles follow the order of the clusters' mean overdue rate.

    With more clusters than names the best ones are "Premium", "Premium 2" and so on.
    """
    means = clustered.groupBy("cluster").agg(F.avg("overdue_rate").alias("mean_overdue"))
    # one row per cluster
    place = F.row_number().over(Window.orderBy(F.desc("mean_overdue"), "cluster"))
    names = F.array(*[F.lit(p) for p in PROFILES])
    last = len(PROFILES)
    further = F.concat(F.lit(f"{PROFILES[-1]} "), place - last + 1)
    named = means.withColumn("profile", F.when(place > last, further).otherwise(F.get(names, place - 1)))
    return clustered.join(F.broadcast(named.select("cluster", "profile")), "cluster")
