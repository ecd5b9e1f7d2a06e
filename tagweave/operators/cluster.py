"""Clustering users into ordered groups: k-means on score bands or on one score.

Equal points are counted first and k-means runs on the counted points. Score
triples have at most 125 different values, so training them costs the same for
a thousand users and for ten billion, and the user table is read once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import prod

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import Bucketizer, MinMaxScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from tagweave.functions.columns import Band, band_score
from tagweave.operators.match import lookup
from tagweave.operators.staging import stage

# Cluster counts, iteration limits tried, seed.
RFM_CLUSTERS, RFE_CLUSTERS, PSM_CLUSTERS = 5, 4, 5
MAX_ITERATIONS = (5, 10, 20)
SEED = 31

# Cells of a coreset by count and by width.
QUANTILES, WIDTHS = 2_000, 20_000

# Different scores one task holds while k-means runs.
VALUES_PER_TASK = 200_000

# Score bands (low, high, score) of recency in days, number of
# orders and money spent.
RFM_BANDS: dict[str, list[Band]] = {
    "r_score": [(1, 3, 5), (4, 6, 4), (7, 9, 3), (10, 15, 2), (16, None, 1)],
    "f_score": [(1, 49, 1), (50, 99, 2), (100, 149, 3), (150, 199, 4), (200, None, 5)],
    "m_score": [(None, 9999.99, 1), (10000, 49999, 2), (50000, 99999, 3),
                (100000, 199999, 4), (200000, None, 5)],
}
# The same of recency, page views and different pages.
RFE_BANDS: dict[str, list[Band]] = {
    "r_score": [(1, 15, 5), (16, 30, 4), (31, 45, 3), (46, 60, 2), (61, None, 1)],
    "f_score": [(None, 99, 1), (100, 199, 2), (200, 299, 3), (300, 399, 4),
                (400, None, 5)],
    "e_score": [(None, 49, 1), (50, 149, 2), (150, 199, 3), (200, 249, 4),
                (250, None, 5)],
}
RFM_METRICS = ("consumerDays", "orderCount", "monetary")
RFE_METRICS = ("visitDays", "viewCount", "pageCount")


def scores(metrics: DataFrame, columns: Sequence[str],
           bands: dict[str, list[Band]]) -> DataFrame:
    """Add one score column per band list. A value in a hole between two bands
    scores NULL."""
    return metrics.select("*", *[
        band_score(F.col(column), rows).alias(name)
        for column, (name, rows) in zip(columns, bands.items())])


def fit_clusters(points: DataFrame, columns: Sequence[str], k: int,
                 max_iterations: Sequence[int] = MAX_ITERATIONS,
                 try_all: bool = True) -> PipelineModel:
    """Assembler, min-max scaler and k-means as one model.

    ``points`` has the feature columns and a ``weight``. The scaler is kept with
    the clusters, so later data is scaled the way the centres were. Every limit is
    fitted and the model with the lowest cost kept; without ``try_all`` only the
    longest limit is, which retraces the shorter ones with the same seed.
    """
    features = Pipeline(stages=[
        VectorAssembler(inputCols=list(columns), outputCol="raw_features"),
        MinMaxScaler(inputCol="raw_features", outputCol="features"),
    ]).fit(points)
    ready = features.transform(points).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        limits = list(max_iterations) if try_all else [max(max_iterations)]
        fitted = [KMeans(k=k, maxIter=limit, seed=SEED, weightCol="weight").fit(ready)
                  for limit in limits]
        best = min(fitted, key=lambda model: model.summary.trainingCost)
    finally:
        ready.unpersist()
    return PipelineModel(stages=[*features.stages, best])


def fit_score_clusters(scored: DataFrame, columns: Sequence[str], k: int,
                       skip_nulls: bool = False, **options) -> PipelineModel:
    """Clusters of banded scores. A NULL score is an error, or left out."""
    if skip_nulls:
        scored = scored.dropna(subset=list(columns))
    counted = scored.groupBy(*columns).agg(F.count("*").cast("double").alias("weight"))
    # At most one row per combination of scores, hence one sorted partition: the
    # start of k-means depends on row order and must not depend on the cluster.
    points = stage(counted.repartition(1).sortWithinPartitions(*columns), "score-points")
    return fit_clusters(points, columns, k, **options)


def fit_value_clusters(scored: DataFrame, column: str, k: int, partitions: int | None = None,
                       condensed: bool = False, **options) -> PipelineModel:
    """Clusters of one continuous score, counted by value.

    The layout follows from the values alone, since k-means starts differ by it. With
    ``condensed`` they are fitted on a ``coreset``, whose size is bounded.
    """
    counted = stage(coreset(scored, column) if condensed else scored.groupBy(column).agg(
        F.count("*").cast("double").alias("weight")), "value-counts")
    partitions = partitions or 1 + counted.count() // VALUES_PER_TASK
    points = counted.repartition(partitions, column).sortWithinPartitions(column)
    return fit_clusters(points, [column], k, **options)


def coreset(scored: DataFrame, column: str) -> DataFrame:
    """Weighted points in place of all scores, for fitting clusters of one score.

    Scores are cut at QUANTILES quantiles and, independently, into WIDTHS cells of equal
    width; scores of one cell become their mean with their number as ``weight``. What a
    clustering's cost loses is the spread within cells, which is narrow where scores are
    dense by the one cut and where they are far apart by the other. At most the sum of both
    numbers of points, however many users there are. Means are sums of decimals, so
    the points don't depend on the partitioning.
    """
    held = scored.select(F.col(column).cast("double").alias("x")).filter("x IS NOT NULL")
    cuts = sorted(set(held.approxQuantile(
        "x", [i / QUANTILES for i in range(QUANTILES + 1)], 0.25 / QUANTILES)))
    if not cuts:
        return scored.select(column, F.lit(1.0).alias("weight")).limit(0)
    low, high = held.agg(F.min("x"), F.max("x")).first()
    width = (high - low) / WIDTHS or 1.0
    placed = held.withColumns({
        "run": F.floor((F.col("x") - F.lit(low)) / F.lit(width)), "quantile": F.lit(0)})
    if len(cuts) > 2:
        placed = Bucketizer(splits=[-float("inf"), *cuts[1:-1], float("inf")], inputCol="x",
                            outputCol="cell").transform(placed).withColumn("quantile", F.col("cell"))
    exact = F.sum(F.col("x").cast("decimal(28,14)")) / F.count("*")
    return placed.groupBy("run", "quantile").agg(
        exact.cast("double").alias(column), F.count("*").cast("double").alias("weight")).select(
            column, "weight")


def ordinals(model: PipelineModel) -> dict[int, int]:
    """Cluster index -> rank by the sum of its centre, 0 for the largest.

    Equal sums keep the order of their indexes. There may be fewer centres than
    clusters asked for."""
    sums = [float(centre.sum()) for centre in model.stages[-1].clusterCenters()]
    ranked = sorted(range(len(sums)), key=lambda index: -sums[index])
    return {index: rank for rank, index in enumerate(ranked)}


def ordinal(model: PipelineModel, prediction: Column) -> Column:
    pairs = [F.lit(v) for pair in ordinals(model).items() for v in pair]
    return F.create_map(*pairs)[prediction]


def assign_values(model: PipelineModel, users: DataFrame, out: str) -> DataFrame:
    """Add ``out``, the ordered cluster of each row, by running the model on it."""
    kept = users.columns
    return model.transform(users).select(
        *kept, ordinal(model, F.col("prediction")).alias(out))


def assign_scores(model: PipelineModel, scored: DataFrame,
                  bands: dict[str, list[Band]], out: str) -> DataFrame:
    """Add ``out`` by looking up each row's scores.

    All combinations of scores are predicted beforehand: as many rows as the
    product of the band counts, 125 for three of five. A NULL score leaves a
    NULL cluster.
    """
    grid = assign_values(model, score_grid(scored.sparkSession, bands), out)
    combinations = prod(len(rows) for rows in bands.values())
    return lookup(scored, grid, list(bands), "left", rows=combinations).select(
        *scored.columns, out)


def score_grid(spark: SparkSession, bands: dict[str, list[Band]]) -> DataFrame:
    def spread(df: DataFrame, name: str) -> DataFrame:
        points = sorted({float(score) for _, _, score in bands[name]})
        return df.withColumn(name, F.explode(F.array(*[F.lit(p) for p in points])))

    return reduce(spread, bands, spark.range(1, numPartitions=1)).drop("id")


def silhouette(model: PipelineModel, points: DataFrame) -> float:
    """How well the counted points separate, from -1 to 1."""
    return ClusteringEvaluator(weightCol="weight").evaluate(model.transform(points))
