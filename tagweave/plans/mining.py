"""The model tags: clusters of value, engagement and price sensitivity, the
shopping gender vote, and recommendations.

The ``add_`` functions take user metrics that are already staged: they pass
over them once to fit and once to predict.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tagweave.operators import cluster, metrics, recommend, shopping
from tagweave.operators.staging import stage
from tagweave.plans.settings import Settings
from tagweave.sources.models import exists, keep, load_or_fit, refuse_other


def _model(spark, settings: Settings, name: str, kind: type, fit, **about):
    return load_or_fit(spark, settings.model_path(name), kind, fit, settings.retrain, about)


def must_fit(spark, settings: Settings, name: str) -> bool:
    path = settings.model_path(name)
    return settings.retrain or not path or not exists(spark, path)


def rfm_scores(order_values: DataFrame, settings: Settings) -> DataFrame:
    return cluster.scores(order_values, cluster.RFM_METRICS, settings.rfm_bands)


def rfe_scores(log_values: DataFrame, settings: Settings) -> DataFrame:
    lagged = log_values.withColumn(
        "visitDays", F.col("visitDays") - settings.visit_lag_days)
    return cluster.scores(lagged, cluster.RFE_METRICS, settings.rfe_bands)


def add_rfm(order_values: DataFrame, settings: Settings) -> DataFrame:
    """Add rfmCluster: 0 is the most valuable of five groups."""
    return _add_score_clusters(rfm_scores(order_values, settings), settings, "rfm",
                               settings.rfm_bands, cluster.RFM_CLUSTERS)


def add_rfe(log_values: DataFrame, settings: Settings) -> DataFrame:
    """Add rfeCluster: 0 is the most engaged of four groups."""
    return _add_score_clusters(rfe_scores(log_values, settings), settings, "rfe",
                               settings.rfe_bands, cluster.RFE_CLUSTERS)


def _add_score_clusters(scored: DataFrame, settings: Settings, name: str, bands,
                        k: int) -> DataFrame:
    bare = scored.filter(" OR ".join(f"`{c}` IS NULL" for c in bands))
    if settings.skip_unscored:
        scored = scored.dropna(subset=list(bands))
    elif not bare.isEmpty():
        raise ValueError(f"{name}: some users' metrics lie in no score band; skip_unscored "
                         "leaves them out")
    model = _model(scored.sparkSession, settings, name, PipelineModel,
                   lambda: cluster.fit_score_clusters(
                       scored, list(bands), k, try_all=settings.try_all_iterations),
                   columns=list(bands), bands=bands, k=k)
    return cluster.assign_scores(model, scored, bands, f"{name}Cluster").drop(*bands)


def add_psm(order_values: DataFrame, settings: Settings) -> DataFrame:
    """Add psmCluster: 0 is the most price-sensitive of five groups."""
    model = _model(order_values.sparkSession, settings, "psm", PipelineModel,
                   lambda: cluster.fit_value_clusters(
                       order_values, "psmScore", cluster.PSM_CLUSTERS,
                       condensed=settings.condensed_scores,
                       try_all=settings.try_all_iterations),
                   columns=["psmScore"], k=cluster.PSM_CLUSTERS)
    return cluster.assign_values(model, order_values, "psmCluster")


def usg_votes(store, settings: Settings) -> DataFrame:
    """(userId, usgVote). Goods and orders are joined once, also when the tree
    has to be trained."""
    items = shopping.user_goods(store.read(settings.goods), store.read(settings.orders),
                                settings.coding)
    spark = items.sparkSession
    if must_fit(spark, settings, "usg"):
        items = stage(items, "user-goods")
    model = _model(spark, settings, "usg", PipelineModel,
                   lambda: shopping.fit_tree(shopping.training_rows(items)),
                   coding=vars(settings.coding))
    predictions = shopping.predicted_codes(model, spark, settings.coding)
    return shopping.shopping_vote(items, predictions).withColumnRenamed("usg", "usgVote")


def preferences(store, settings: Settings) -> DataFrame:
    """(userId, top1..top5): the products recommended to each user.

    Users and products that came after a stored model was fitted get factors from its.
    """
    logs = store.read(settings.logs)
    spark, path = logs.sparkSession, settings.model_path("bp")
    about = {"rank": recommend.RANK, "alpha": recommend.ALPHA,
             "regularisation": settings.regularisation}
    ratings = stage(metrics.product_ratings(logs), "ratings")
    if must_fit(spark, settings, "bp"):
        fitted = recommend.fit_factors(ratings, settings.recommender_blocks,
                                       settings.regularisation)
        if path:
            keep(spark, path, lambda: fitted.save(path), about)
    else:
        refuse_other(spark, path, about)
        fitted = recommend.with_new_rows(
            recommend.Recommender.load(spark, path, settings.regularisation), ratings)
    return recommend.recommend(fitted)


def mined(name: str, store, settings: Settings) -> DataFrame:
    """The metric frame of one model tag, straight from the inputs."""
    if name == "usg":
        return usg_votes(store, settings)
    add, build, table, columns, as_of = {
        "rfm": (add_rfm, metrics.order_metrics, settings.orders, cluster.RFM_METRICS,
                settings.orders_as_of),
        "psm": (add_psm, metrics.order_metrics, settings.orders, ["psmScore"],
                settings.orders_as_of),
        "rfe": (add_rfe, metrics.log_metrics, settings.logs, cluster.RFE_METRICS,
                settings.logs_as_of),
    }[name]
    valued = build(store.read(table), as_of, columns)
    if must_fit(valued.sparkSession, settings, name):
        valued = stage(valued, f"{name}-metrics")
    return add(valued, settings)
