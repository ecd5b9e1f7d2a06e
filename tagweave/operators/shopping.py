"""Shopping gender: a decision tree over goods, then a vote over each user's goods.

The tree sees two small codes per item, so it is trained on counted
combinations, at most a few thousand weighted rows, not on the items.
Cross-validation folds are drawn per order before counting.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tagweave.functions.columns import share_vote, vocabulary_code
from tagweave.operators.match import lookup
from tagweave.operators.metrics import sold_goods
from tagweave.operators.staging import stage

# Goods colours and product types in the order of their codes,
# from 1, and those the operators count as bought by women.
COLOURS = (
    "香槟色", "樱花粉", "月光银", "灰色", "金属灰", "金色", "布朗灰", "蓝色", "金属银",
    "香槟金", "乐享金", "粉色", "玫瑰金", "浅金棕", "银色", "布鲁钢", "卡其金", "白色", "黑色",
)
PRODUCT_TYPES = (
    "Haier/海尔冰箱", "波轮洗衣机", "燃气灶", "净水机", "取暖电器", "智能电视", "烤箱",
    "挂烫机", "嵌入式厨电", "吸尘器/除螨仪", "烟灶套系", "微波炉", "LED电视",
    "电水壶/热水瓶", "电饭煲", "冷柜", "Leader/统帅冰箱", "前置过滤器", "冰吧", "电风扇",
    "4K电视", "电热水器", "破壁机", "燃气热水器", "料理机", "滤芯", "电磁炉", "空气净化器",
    "其他",
)
FEMALE_COLOURS = ("樱花粉", "粉色", "白色", "玫瑰金", "香槟色", "香槟金")
FEMALE_TYPES = ("料理机", "烤箱", "电饭煲", "挂烫机", "破壁机", "微波炉", "波轮洗衣机",
                "取暖电器", "吸尘器/除螨仪")

# The tree search.
IMPURITIES = ("gini", "entropy")
MAX_DEPTHS = (5, 10)
MAX_BINS = (32, 64)
MAX_CATEGORIES = 30
FOLDS = 3


@dataclass(frozen=True)
class GoodsCoding:
    """The vocabularies that turn goods into codes, and the labelling rule."""

    colours: Sequence[str] = COLOURS
    types: Sequence[str] = PRODUCT_TYPES
    female_colours: Sequence[str] = FEMALE_COLOURS
    female_types: Sequence[str] = FEMALE_TYPES

    def features(self) -> dict[str, Column]:
        colour, kind = F.col("ogColor"), F.col("productType")
        female = colour.isin(*self.female_colours) | kind.isin(*self.female_types)
        return {"color": vocabulary_code(colour, self.colours),
                "product": vocabulary_code(kind, self.types),
                "label": F.when(female, 1).otherwise(0)}


def user_goods(goods: DataFrame, orders: DataFrame,
               coding: GoodsCoding = GoodsCoding(), folds: int = FOLDS) -> DataFrame:
    """(userId, color, product, label, fold) for each item sold. The training
    fold goes by order and is the same on every run."""
    fold = F.pmod(F.xxhash64("cOrderSn"), F.lit(folds)).cast("int")
    return sold_goods(goods, orders, {**coding.features(), "fold": fold})


def training_rows(items: DataFrame) -> DataFrame:
    """(color, product, label, fold, weight), one row per combination met."""
    return items.groupBy("color", "product", "label", "fold").agg(
        F.count("*").cast("double").alias("weight"))


def fit_tree(rows: DataFrame, folds: int = FOLDS, seed: int = 31,
             parallelism: int = 8) -> PipelineModel:
    """The best of eight trees by cross-validated accuracy.

    The features are categorical while a tree takes them as such, up to
    ``MAX_CATEGORIES`` values, and ordinary numbers beyond that.
    """
    order = ["fold", "color", "product", "label"]
    rows = stage(rows.repartition(1).sortWithinPartitions(*order), "tree-rows")
    features = Pipeline(stages=[
        VectorAssembler(inputCols=["color", "product"], outputCol="raw_features"),
        VectorIndexer(inputCol="raw_features", outputCol="features",
                      maxCategories=MAX_CATEGORIES, handleInvalid="keep"),
    ]).fit(rows)
    tree = DecisionTreeClassifier(featuresCol="features", labelCol="label",
                                  weightCol="weight", seed=seed)
    grid = (ParamGridBuilder().addGrid(tree.impurity, list(IMPURITIES))
            .addGrid(tree.maxDepth, list(MAX_DEPTHS))
            .addGrid(tree.maxBins, list(MAX_BINS)).build())
    search = CrossValidator(estimator=tree, estimatorParamMaps=grid,
                            evaluator=accuracy_evaluator(), numFolds=folds,
                            foldCol="fold", parallelism=parallelism, seed=seed)
    ready = features.transform(rows).persist()
    try:
        best = search.fit(ready).bestModel
    finally:
        ready.unpersist()
    return PipelineModel(stages=[*features.stages, best])


def accuracy_evaluator() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol="label", weightCol="weight",
                                             metricName="accuracy")


def predicted_codes(model: PipelineModel, spark: SparkSession,
                    coding: GoodsCoding = GoodsCoding()) -> DataFrame:
    """(color, product, prediction) for every pair of codes there can be."""
    def codes(words: Sequence[str]) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(len(words))))

    pairs = (spark.range(1, numPartitions=1)
             .select(codes(coding.colours).alias("color"))
             .select("color", codes(coding.types).alias("product")))
    return model.transform(pairs).select("color", "product", "prediction")


def shopping_vote(items: DataFrame, predictions: DataFrame) -> DataFrame:
    """(userId, usg): '0' or '1', the prediction at least half of the items have.

    ``predictions`` has one row per pair of codes, a number fixed by the
    vocabularies: 600 for the standard ones.
    """
    return (lookup(items, predictions, ["color", "product"])
            .groupBy("userId")
            .agg(F.count("*").alias("total"),
                 F.count_if(F.col("prediction") == 0).alias("male"),
                 F.count_if(F.col("prediction") == 1).alias("female"))
            .select("userId", share_vote(F.col("total"), F.col("male"),
                                         F.col("female")).alias("usg")))
