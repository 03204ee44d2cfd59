"""Fitting of the centroid models that micro-segments are scored with: standardisation, then k-means."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.operators.centroids import MODEL_SCHEMA, MicroPlan, planned_vectors, renamed_columns
from cartwright.session import written


def fit_model(vectors: DataFrame, key: str, features: Sequence[str], clusters: int, seed: int, rounds: int) -> tuple:
    """One row of the model table from a frame with an array column ``vector``.

    The scale is the sample standard deviation, 0 for a constant feature, which scoring takes as 1. There
    are fewer centers than ``clusters`` where there are fewer distinct vectors.
    """
    rows = vectors.select(array_to_vector("vector").alias("raw"))
    scaler = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True)
    means = KMeans(featuresCol="scaled", k=clusters, seed=seed, maxIter=rounds)
    scaled, fitted = Pipeline(stages=[scaler, means]).fit(rows).stages
    centers = [[float(x) for x in c] for c in fitted.clusterCenters()]
    return key, list(features), [float(x) for x in scaled.mean], [float(x) for x in scaled.std], centers


def unfitted(spark, wanted: Mapping[str, Sequence[str]]) -> DataFrame:
    """A model table that has features only, to build the vectors that scoring will see."""
    rows = [(k, list(f), [0.0] * len(f), [1.0] * len(f), [[0.0] * len(f)]) for k, f in wanted.items()]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def fit_models(segmented: DataFrame, plans: Sequence[MicroPlan], wanted: Mapping[str, Sequence[str]], renames: Mapping[str, str],
               clusters: int = 4, seed: int = 1, rounds: int = 20) -> DataFrame:
    """A model table (``MODEL_SCHEMA``) with a row for every model key whose plans have customers.

    Each model is fitted on the customers of its plans, filled and capped as for scoring. The vectors are
    written once, by model key; the fits are distributed and run one after the other, as many as there are models.
    """
    spark = segmented.sparkSession
    plans = [p for p in plans if p.enabled]
    absent = sorted({p.model_key for p in plans} - set(wanted))
    if absent:
        raise KeyError(f"no features given for models: {absent}")
    source = renamed_columns([c for c in segmented.columns if c != "Segment"], renames)
    keys = {p.model_key for p in plans}
    rows, vector = planned_vectors(segmented, plans, unfitted(spark, {k: wanted[k] for k in keys}), source)
    vectors = written(rows.select("_key", F.expr(vector).alias("vector")), "model-vectors")
    held = {r["_key"] for r in vectors.select("_key").distinct().collect()}  # as many as there are models
    fitted = [fit_model(vectors.where(F.col("_key") == k), k, wanted[k], clusters, seed, rounds) for k in sorted(held)]
    return spark.createDataFrame(fitted, MODEL_SCHEMA)
