"""Product recommendations: implicit matrix factorisation of page visits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tagweave.functions.columns import slots
from tagweave.operators.match import BROADCAST_CODES, lookup
from tagweave.operators.staging import find_package, shared_folder, stage

# The factorisation, and the number of products recommended.
RANK, ITERATIONS, ALPHA, REGULARISATION = 10, 10, 1.0, 1.0
TOP = ("top1", "top2", "top3", "top4", "top5")


# Products of a band, which one task holds, and users compared with them at a time.
BAND, BLOCK = 16_384, 256
# Parts that a band's users are dealt to.
SPREAD = 32


@dataclass(frozen=True)
class Recommender:
    """Factors of users and products, with the ids of the tables."""

    users: DataFrame
    items: DataFrame
    regularisation: float = REGULARISATION

    def save(self, path: str) -> None:
        self.users.write.mode("overwrite").parquet(f"{path}/users")
        self.items.write.mode("overwrite").parquet(f"{path}/items")

    @classmethod
    def load(cls, spark: SparkSession, path: str,
             regularisation: float = REGULARISATION) -> Recommender:
        return cls(spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/items"),
                   regularisation)


def dense_ids(values: DataFrame, column: str, out: str) -> DataFrame:
    """Distinct values with integers from 0 without gaps; the factorisation needs 32 bits.

    The first number of each partition follows from the partitions' row counts.
    """
    held = stage(values.select(column).distinct().withColumn("_part", F.spark_partition_id()),
                 "ids")
    counts = sorted(tuple(r) for r in held.groupBy("_part").count().collect())
    begins = dict(zip((p for p, _ in counts), accumulate([0, *(n for _, n in counts)])))
    first = F.create_map(*[F.lit(v) for pair in begins.items() for v in pair]) if begins else (
        F.lit(None))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    return held.select(column, (F.get(first, F.col("_part")) if not begins else
                                first[F.col("_part")] + place - 1).cast("int").alias(out))


def fit_recommender(ratings: DataFrame, blocks: int = 10,
                    regularisation: float = REGULARISATION, seed: int = 31) -> ALSModel:
    """Factors of users and products from (userId, productId, rating).

    Raise ``blocks`` with the number of cores. The training checkpoints its
    factors, hence the shared folder. Ids must fit 32 bits; ``fit_factors`` has no
    such bound.
    """
    shared_folder(ratings.sparkSession)
    als = ALS(userCol="userId", itemCol="productId", ratingCol="rating",
              implicitPrefs=True, rank=RANK, maxIter=ITERATIONS, alpha=ALPHA,
              regParam=regularisation, coldStartStrategy="drop", seed=seed,
              numUserBlocks=blocks, numItemBlocks=blocks)
    return als.fit(ratings)


def fit_factors(ratings: DataFrame, blocks: int = 10,
                regularisation: float = REGULARISATION, seed: int = 31) -> Recommender:
    """The factorisation over ids of any size; ``ratings`` should be staged."""
    users = stage(dense_ids(ratings, "userId", "_user"), "user-ids")
    items = stage(dense_ids(ratings, "productId", "_item"), "product-ids")
    dense = stage(ratings.join(users, "userId").join(items, "productId").select(
        F.col("_user").alias("userId"), F.col("_item").alias("productId"), "rating"), "ratings")
    model = fit_recommender(dense, blocks, regularisation, seed)
    return Recommender(
        model.userFactors.join(users, F.col("id") == F.col("_user")).select(
            F.col("userId").cast("bigint").alias("userId"), "features"),
        model.itemFactors.join(items, F.col("id") == F.col("_item")).select(
            F.col("productId").cast("bigint").alias("productId"), "features"), regularisation)


def factors_of(model: ALSModel, regularisation: float = REGULARISATION) -> Recommender:
    """A fitted model's factors as tables."""
    named = lambda df, name: df.select(
        F.col("id").cast("bigint").alias(name), "features")
    return Recommender(named(model.userFactors, "userId"), named(model.itemFactors, "productId"),
                       regularisation)


def with_new_rows(fitted: Recommender, ratings: DataFrame, rounds: int = 10,
                  settled: float = 1e-3) -> Recommender:
    """Factors also of users and products that came after the fit.

    New products are solved from the users' factors and new users from the products',
    in turn, until no new user's factors move by more than ``settled`` of their length or
    for ``rounds`` at most; factors of the fit stay. Each is the linear system that a step
    of the factorisation solves, its sums are aggregates. Rows that are joined to no
    known row by any chain of ratings have no factors.
    """
    find_package(ratings.sparkSession)
    ratings = ratings.withColumns({c: F.col(c).cast("bigint") for c in ("userId", "productId")})
    by_user = ratings.join(fitted.users.select("userId"), "userId", "left_anti")
    by_item = ratings.join(fitted.items.select("productId"), "productId", "left_anti")
    no_users, no_items = by_user.isEmpty(), by_item.isEmpty()
    users, items = fitted.users, fitted.items
    if no_users and no_items:
        return fitted
    if not no_users and not no_items:
        by_user, by_item = stage(by_user, "of-new-users"), stage(by_item, "of-new-products")
    before = None
    for _ in range(rounds):
        if not no_users:
            new = stage(_solved(by_user, items, "userId", "productId", fitted.regularisation),
                        "new-users")
            users = fitted.users.unionByName(new)
        if not no_items:
            items = fitted.items.unionByName(stage(_solved(
                by_item, users, "productId", "userId", fitted.regularisation), "new-products"))
        if no_users or no_items:
            break
        if before is not None and _still(before, new, settled):
            # Users last, so that they answer to the products as they are now.
            users = fitted.users.unionByName(stage(_solved(
                by_user, items, "userId", "productId", fitted.regularisation), "new-users"))
            break
        before = new
    return Recommender(users, items, fitted.regularisation)


def _still(before: DataFrame, after: DataFrame, settled: float) -> bool:
    """Whether all rows were there before and hardly moved."""
    size = lambda c: F.sqrt(F.aggregate(
        c, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    old = before.select("userId", F.col("features").alias("old"))
    moved = size(F.zip_with("features", "old", lambda x, y: x - y))
    return after.join(old, "userId", "left").filter(
        F.col("old").isNull() | (moved > settled * size(F.col("features")))).isEmpty()


def _solved(ratings: DataFrame, fixed: DataFrame, key: str, other: str,
            regularisation: float) -> DataFrame:
    """(key, features) for each key of ``ratings`` by the factors of ``other``."""
    at = lambda i: F.col("features")[i].cast("double")
    upper = [(i, j) for i in range(RANK) for j in range(i, RANK)]
    whole = fixed.groupBy().agg(*[F.sum(at(i) * at(j)) for i, j in upper]).first()
    pull = ALPHA * F.col("rating")
    sums = ratings.join(fixed, other).groupBy(key).agg(
        F.count("*").cast("double").alias("n"),
        F.array(*[F.sum(pull * at(i) * at(j)) for i, j in upper]).alias("left"),
        F.array(*[F.sum((1 + pull) * at(i)) for i in range(RANK)]).alias("right"))
    base = np.array([v or 0.0 for v in whole])

    def solve(batches):
        for batch in batches:
            n = batch.column("n").to_numpy()
            left = batch.column("left").flatten().to_numpy().reshape(-1, len(upper))
            right = batch.column("right").flatten().to_numpy().reshape(-1, RANK)
            square = np.zeros((len(n), RANK, RANK))
            for k, (i, j) in enumerate(upper):
                square[:, i, j] = square[:, j, i] = left[:, k] + base[k]
            square += np.eye(RANK) * (regularisation * n)[:, None, None]
            found = np.linalg.solve(square, right[:, :, None])[:, :, 0].astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(list(found), pa.list_(pa.float32()))],
                names=[key, "features"])

    return sums.mapInArrow(solve, f"{key} bigint, features array<float>")


def best_products(fitted: Recommender, count: int) -> DataFrame:
    """(userId, productIds, ratings): the products with the largest inner products.

    Exact without comparing all pairs. Products are sorted once, by the length of their
    factors, and cut into bands of about BAND; no product of a band is worth more to a
    user than the band's largest length times the user's own. Users go to the first
    band, then to the next 2, 4, 8, as long as that bound reaches their last place; each
    round they meet the bands in tasks and take their best so far along. Equal
    ratings are in order of the product id.
    """
    spark = fitted.items.sparkSession
    find_package(spark)
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    size = fitted.items.count()
    sorted_items = (fitted.items.select("productId", "features", length.alias("length"))
                    .repartitionByRange(max(1, -(-size // BAND)), F.desc("length"), "productId"))
    items = stage(sorted_items.withColumn("band", F.spark_partition_id()), "bands")
    # Sampled bounds may leave a partition empty: bands are numbered by what they hold.
    tops = items.groupBy("band").agg(F.max("length").alias("length")).orderBy("band").collect()
    state = fitted.users.select("userId", "features", length.alias("length"),
                                F.array().cast(_BEST).alias("best"))
    ended, done, step = [], 0, 1
    while done < len(tops):
        bands = tops[done:done + step]
        state = stage(_round(state, items, bands, count), "best-products")
        done, step = done + step, 2 * step
        if done < len(tops):
            open_ = _reaches(F.lit(float(tops[done]["length"])), count)
            ended.append(state.filter(~open_))
            state = state.filter(open_)
            if state.isEmpty():
                break
    found = F.col("best")
    return reduce(DataFrame.unionAll, [state, *ended]).select(
        "userId", F.transform(found, lambda x: x["productId"]).alias("productIds"),
        F.transform(found, lambda x: -x["less"]).alias("ratings"))


# A user's best so far; the natural order of its entries is theirs.
_BEST = "array<struct<less:float,productId:bigint>>"
_MET = "userId bigint, features array<float>, band int, part int, kind int, id bigint"


def _reaches(top: Column, count: int) -> Column:
    """Whether products as long as ``top`` may have a place among the user's best; with
    some room for the rounding of ratings."""
    last = -F.get(F.col("best"), F.lit(count - 1))["less"].cast("double")
    return (F.size("best") < count) | (F.col("length") * top * (1 + 1e-5) >= last)


def _round(state: DataFrame, items: DataFrame, bands: list, count: int) -> DataFrame:
    """The users' best after they have met ``bands``, the longest products first."""
    names = [r["band"] for r in bands]
    offered = F.arrays_zip(_numbers([r["length"] for r in bands]).alias("top"),
                           _numbers(names).cast("array<int>").alias("band"))
    reached = F.transform(F.filter(offered, lambda x: _reaches(x["top"], count)),
                          lambda x: x["band"])
    asked = state.select("userId", "features", F.explode(reached).alias("band"),
                         F.pmod(F.xxhash64("userId"), F.lit(SPREAD)).cast("int").alias("part"),
                         F.lit(1).alias("kind"), F.col("userId").alias("id"))
    held = items.filter(F.col("band").between(names[0], names[-1])).select(
        F.col("productId").alias("userId"), "features", "band",
        F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"), F.lit(0).alias("kind"),
        F.col("productId").alias("id"))
    met = (held.unionByName(asked).repartition("band", "part")
           .sortWithinPartitions("band", "part", "kind", "id")
           .mapInArrow(_compare(count), f"userId bigint, best {_BEST}"))
    # What a user had and what the bands gave: a list for each band at most.
    lists = state.select("userId", "features", "length", "best").unionByName(
        met, allowMissingColumns=True)
    return lists.groupBy("userId").agg(
        F.max("features").alias("features"), F.max("length").alias("length"),
        F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, count).alias("best"))


def _numbers(values: list) -> Column:
    """A long list of numbers as one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<double>")


def _compare(count: int):
    """Bands of products and then the users that meet them, batch by batch."""

    def matrix(batch):
        return batch.column("features").flatten().to_numpy().reshape(batch.num_rows, -1)

    def passes(batches):
        at, parts, held = None, [], None
        for batch in batches:
            place = batch.column("band").to_numpy() * SPREAD + batch.column("part").to_numpy()
            kind = batch.column("kind").to_numpy()
            edges = (np.flatnonzero((np.diff(place) != 0) | (np.diff(kind) != 0)) + 1).tolist()
            for a, b in zip([0, *edges], [*edges, len(place)]):
                if a == b:
                    continue
                rows = batch.slice(a, b - a)
                if at != place[a]:
                    at, parts, held = place[a], [], None
                if kind[a] == 0:
                    parts.append(rows)
                    continue
                if held is None:
                    held = (np.concatenate([r.column("id").to_numpy() for r in parts]),
                            np.concatenate([matrix(r) for r in parts]).T)
                    parts = []
                for k in range(0, rows.num_rows, BLOCK):
                    yield _best_of(rows.slice(k, BLOCK), *held, count)

    def _best_of(users, ids, factors, count):
        scores = matrix(users) @ factors
        take = min(count, len(ids))
        least = np.partition(scores, len(ids) - take, axis=1)[:, len(ids) - take]
        row, column = np.nonzero(scores >= least[:, None])
        # Products come by id, so of equal scores the first ones stay.
        score = scores[row, column]
        order = np.lexsort((column, -score, row))
        row, column, score = row[order], column[order], score[order]
        first = np.arange(len(row)) - np.searchsorted(row, row) < take
        entries = pa.StructArray.from_arrays(
            [pa.array(-score[first], pa.float32()), pa.array(ids[column[first]])],
            names=["less", "productId"])
        bounds = np.searchsorted(row[first], np.arange(users.num_rows + 1)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [users.column("userId"), pa.ListArray.from_arrays(pa.array(bounds), entries)],
            names=["userId", "best"])

    return passes


def recommend(fitted: Recommender | ALSModel, names: Sequence[str] = TOP) -> DataFrame:
    """userId and one product id column per name, best first."""
    best = best_products(_tables(fitted), len(names))
    return best.select("userId", *slots(F.col("productIds"), names))


def recommendation_lists(fitted: Recommender | ALSModel, count: int = len(TOP)) -> DataFrame:
    """userId with the products and their strengths as comma-separated lists."""
    best = best_products(_tables(fitted), count)
    return best.select(
        "userId", F.concat_ws(",", F.col("productIds").cast("array<string>")).alias("productIds"),
        F.concat_ws(",", F.col("ratings").cast("array<string>")).alias("ratings"))


def _tables(fitted: Recommender | ALSModel) -> Recommender:
    return fitted if isinstance(fitted, Recommender) else factors_of(fitted)


def name_products(recommended: DataFrame, products: DataFrame,
                  names: Sequence[str] = TOP, how: str = "inner") -> DataFrame:
    """Replace product ids by product names.

    ``products`` is (productId, productName), a row per sale allowed as long as
    an id has one name. ``inner`` drops a user with an unnamed product, ``left``
    leaves NULL. Users tend to share their top products, so the lookup is cut
    down to the recommended ids before it is joined.
    """
    recommended = stage(recommended, "recommended")
    slot = F.posexplode(F.array(*[F.col(n) for n in names])).alias("_slot", "productId")
    long = recommended.select("userId", slot)
    wanted = long.select("productId").distinct()
    # As many names as different ids at most, so the names need not be counted or kept.
    rows = wanted.limit(BROADCAST_CODES + 1).count()
    catalogue = products.groupBy("productId").agg(
        F.min("productName").alias("productName")).join(wanted, "productId", "left_semi")
    named = lookup(long, catalogue, ["productId"], "left", rows=rows)
    wide = named.groupBy("userId").agg(
        *[F.max(F.when(F.col("_slot") == i, F.col("productName"))).alias(name)
          for i, name in enumerate(names)])
    return wide.dropna(subset=list(names)) if how == "inner" else wide


def ratings_error(model: ALSModel, ratings: DataFrame) -> float:
    """Root mean square error of the predicted against the given ratings."""
    return RegressionEvaluator(metricName="rmse", labelCol="rating",
                               predictionCol="prediction").evaluate(
                                   model.transform(ratings))
