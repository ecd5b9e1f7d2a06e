import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from tagweave.operators import cluster, recommend, shopping
from tagweave.operators.shopping import GoodsCoding
from tagweave.plans import checks
from tagweave.sources.models import exists, load_or_fit

BANDS = {"r_score": [(None, 1, 1), (2, 2, 2), (3, None, 3)],
         "f_score": [(None, 9, 1), (10, 19, 2), (20, None, 3)]}


def users(spark, partitions=3):
    return spark.range(600).select(
        F.col("id").alias("userId"), (F.col("id") % 4).alias("r"),
        (F.col("id") % 31).alias("f")).repartition(partitions)


def scored(spark, partitions=3):
    return cluster.scores(users(spark, partitions), ["r", "f"], BANDS)


def score_model(spark, partitions=3, **options):
    return cluster.fit_score_clusters(scored(spark, partitions), list(BANDS), 4, **options)


def test_score_clusters_are_ordered_and_whole(spark):
    model = score_model(spark)
    found = cluster.assign_scores(model, scored(spark), BANDS, "group")
    assert found.count() == 600 and found.filter("group IS NULL").count() == 0
    means = [r[1] for r in found.groupBy("group").agg(
        F.avg(F.col("r_score") + F.col("f_score"))).orderBy("group").collect()]
    assert len(means) == 4 and means == sorted(means, reverse=True)
    sums = [c.sum() for c in model.stages[-1].clusterCenters()]
    ranks = cluster.ordinals(model)
    assert [ranks[i] for i in sorted(range(4), key=lambda i: -sums[i])] == [0, 1, 2, 3]


def test_score_clusters_do_not_depend_on_partitions(spark, rows):
    answers = [rows(cluster.assign_scores(score_model(spark, n), scored(spark, n), BANDS, "g"))
               for n in (1, 7)]
    assert answers[0] == answers[1]


def test_the_lookup_equals_running_the_model(spark, rows):
    model = score_model(spark)
    looked_up = cluster.assign_scores(model, scored(spark), BANDS, "group")
    assert rows(looked_up) == rows(cluster.assign_values(model, scored(spark), "group"))


def test_the_longest_run_has_the_lowest_error(spark):
    longest, best, short = (
        score_model(spark, **options).stages[-1].summary.trainingCost for options in
        ({}, {"try_all": True}, {"max_iterations": [2]}))
    assert longest == pytest.approx(best) and longest <= short


def test_fewer_points_than_clusters(spark):
    points = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "x double, weight double")
    model = cluster.fit_clusters(points, ["x"], 5)
    assert cluster.ordinals(model) in ({0: 0, 1: 1}, {0: 1, 1: 0})
    found = cluster.assign_values(model, points, "g").orderBy("x").collect()
    assert [r.g for r in found] == [1, 0]


def test_equal_centre_sums_keep_their_order():
    class Centres:
        stages = [type("M", (), {"clusterCenters": staticmethod(
            lambda: [__import__("numpy").array(c) for c in ([0, 1], [2, 0], [1, 0])])})()]
    assert cluster.ordinals(Centres) == {1: 0, 0: 1, 2: 2}


def test_a_null_score_is_an_error_or_skipped(spark):
    holes = scored(spark).withColumn("r_score", F.expr("IF(userId = 5, NULL, r_score)"))
    with pytest.raises(Exception, match="(?i)null"):
        cluster.fit_score_clusters(holes, list(BANDS), 3)
    model = cluster.fit_score_clusters(holes, list(BANDS), 3, skip_nulls=True)
    found = cluster.assign_scores(model, holes, BANDS, "g")
    assert [r.userId for r in found.filter("g IS NULL").collect()] == [5]


def test_value_clusters(spark, rows):
    def values(partitions):
        return spark.range(500).select("id", F.when(F.col("id") % 3 == 0, 1e-8).otherwise(
            F.col("id") % 50 / 10.0).alias("score")).repartition(partitions)
    answers = []
    for partitions in (1, 5):
        model = cluster.fit_value_clusters(values(partitions), "score", 5)
        answers.append(rows(cluster.assign_values(model, values(partitions), "g")))
    assert answers[0] == answers[1] and len(answers[0]) == 500
    bounds = {}
    for _, score, g in answers[0]:
        low, high = bounds.get(g, (score, score))
        bounds[g] = (min(low, score), max(high, score))
    ordered = [bounds[g] for g in sorted(bounds)]
    assert all(a[0] > b[1] for a, b in zip(ordered, ordered[1:]))


def test_silhouette(spark):
    points = spark.createDataFrame([(0.0, 3.0), (0.1, 2.0), (9.0, 3.0), (9.1, 1.0)],
                                   "x double, weight double")
    model = cluster.fit_clusters(points, ["x"], 2)
    assert cluster.silhouette(model, points) > 0.9


CODING = GoodsCoding(colours=("red", "blue", "pink"), types=("oven", "drill"),
                     female_colours=("pink",), female_types=("oven",))


@pytest.fixture(scope="module")
def items(spark):
    goods = spark.range(900).select(
        (F.col("id") % 300).cast("string").alias("cOrderSn"),
        F.element_at(F.array(*map(F.lit, ["red", "blue", "pink", "grey"])),
                     (F.col("id") % 4 + 1).cast("int")).alias("ogColor"),
        F.element_at(F.array(*map(F.lit, ["oven", "drill", "saw"])),
                     (F.col("id") % 7 % 3 + 1).cast("int")).alias("productType"))
    orders = spark.range(300).select((F.col("id") % 40).alias("memberId"),
                                     F.col("id").cast("string").alias("orderSn"))
    return shopping.user_goods(goods, orders, CODING).cache()


def test_training_rows_are_whole(items):
    assert items.count() == 900
    found = shopping.training_rows(items)
    assert found.agg(F.sum("weight")).head()[0] == 900.0
    assert {r.fold for r in found.collect()} == {0, 1, 2}


def test_the_tree_learns_the_labels(spark, items):
    model = shopping.fit_tree(shopping.training_rows(items))
    predictions = shopping.predicted_codes(model, spark, CODING)
    assert predictions.count() == 4 * 3
    wrong = items.join(predictions, ["color", "product"]).filter("label != prediction")
    assert wrong.count() == 0
    votes = shopping.shopping_vote(items, predictions)
    expected = items.groupBy("userId").agg(
        F.when(F.avg("label") <= 0.5, "0").otherwise("1").alias("usg"))
    assert sorted(votes.collect()) == sorted(expected.collect())
    assert votes.count() == 40


def test_standard_vocabularies():
    assert len(shopping.COLOURS) == len(set(shopping.COLOURS)) == 19
    assert len(shopping.PRODUCT_TYPES) == len(set(shopping.PRODUCT_TYPES)) == 29
    assert set(shopping.FEMALE_COLOURS) <= set(shopping.COLOURS)
    assert set(shopping.FEMALE_TYPES) <= set(shopping.PRODUCT_TYPES)


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.range(400).select(
        (F.col("id") % 20).cast("int").alias("userId"),
        (F.col("id") * 7 % 13).cast("int").alias("productId"),
        (F.col("id") % 5 + 1).cast("int").alias("rating")).dropDuplicates(
            ["userId", "productId"])


def test_recommendations(spark, ratings, rows):
    model = recommend.fit_recommender(ratings, blocks=2)
    best = recommend.recommend(model)
    assert best.columns == ["userId", "top1", "top2", "top3", "top4", "top5"]
    assert best.count() == 20 and dict(best.dtypes)["userId"] == "bigint"
    assert all(len(set(r[1:])) == 5 for r in best.collect())
    lists = {r.userId: r for r in recommend.recommendation_lists(model).collect()}
    for row in best.collect():
        assert lists[row.userId].productIds == ",".join(map(str, row[1:]))
    assert 0 <= recommend.ratings_error(model, ratings) < 5


def test_recommendations_of_a_short_catalogue_are_padded(spark):
    ratings = spark.createDataFrame([(1, 1, 3), (1, 2, 1), (2, 1, 1)],
                                    "userId int, productId int, rating int")
    best = recommend.recommend(recommend.fit_recommender(ratings, blocks=1))
    assert all(r.top3 is None and r.top2 is not None for r in best.collect())


def test_product_names(spark, rows):
    names = recommend.TOP
    ids = spark.createDataFrame([(1, 1, 2, 3, 4, 5), (2, 1, 2, 3, 4, 99)],
                                "userId bigint, " + ", ".join(f"{n} int" for n in names))
    products = spark.createDataFrame([(i, f"p{i}") for i in range(1, 6)] * 2,
                                     "productId int, productName string")
    full = (1, "p1", "p2", "p3", "p4", "p5")
    assert rows(recommend.name_products(ids, products)) == [full]
    assert rows(recommend.name_products(ids, products, how="left")) == [
        full, (2, "p1", "p2", "p3", "p4", None)]


def test_models_are_kept_and_retrained_on_request(spark, tmp_path):
    path = str(tmp_path / "models" / "score")
    fits = []

    def fit():
        fits.append(1)
        return score_model(spark)

    first = load_or_fit(spark, path, PipelineModel, fit)
    assert exists(spark, path)
    again = load_or_fit(spark, path, PipelineModel, fit)
    assert len(fits) == 1 and cluster.ordinals(first) == cluster.ordinals(again)
    load_or_fit(spark, path, PipelineModel, fit, retrain=True)
    assert len(fits) == 2


def test_recommender_round_trip(spark, ratings, tmp_path, rows):
    path = str(tmp_path / "bp")
    model = load_or_fit(spark, path, ALSModel, lambda: recommend.fit_recommender(ratings, 2))
    loaded = load_or_fit(spark, path, ALSModel, None)
    assert rows(recommend.recommend(model)) == rows(recommend.recommend(loaded))


def exact(model, count):
    best = model.recommendForAllUsers(count).collect()
    return {r.userId: [(x.productId, round(x.rating, 5)) for x in r.recommendations] for r in best}


def found(best):
    return {r.userId: [(i, round(v, 5)) for i, v in zip(r.productIds, r.ratings)]
            for r in best.collect()}


@pytest.mark.parametrize("band,block", [(16_384, 256), (5, 2)])
def test_best_products_equal_all_pairs(spark, monkeypatch, band, block):
    monkeypatch.setattr(recommend, "BAND", band)
    monkeypatch.setattr(recommend, "BLOCK", block)
    ratings = spark.range(3000).select(
        (F.col("id") % 37).cast("int").alias("userId"),
        (F.xxhash64("id") % 53 + 60).cast("int").alias("productId"),
        (F.col("id") % 5 + 1).cast("int").alias("rating")).dropDuplicates(["userId", "productId"])
    model = recommend.fit_recommender(ratings, blocks=2)
    best = recommend.best_products(recommend.factors_of(model), 4)
    assert found(best) == exact(model, 4)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_ids_beyond_32_bits(spark, ratings, rows):
    wide = ratings.select((F.col("userId") + 3_000_000_000).alias("userId"),
                          (F.col("productId") + 5_000_000_000).alias("productId"), "rating")
    best = rows(recommend.recommend(recommend.fit_factors(wide, 2)))
    assert [r[0] for r in best] == [3_000_000_000 + i for i in range(20)]
    assert all(i >= 5_000_000_000 for r in best for i in r[1:])


def test_equal_ratings_are_in_order_of_the_product(spark, monkeypatch):
    monkeypatch.setattr(recommend, "BAND", 4)
    one = [0.5] * recommend.RANK
    items = spark.createDataFrame([(i, [x * (1 + i % 2) for x in one]) for i in range(30, 0, -1)],
                                  "productId bigint, features array<float>")
    users = spark.createDataFrame([(1, one), (2, [0.0] * recommend.RANK),
                                   (3, [-x for x in one])], "userId bigint, features array<float>")
    best = recommend.best_products(recommend.Recommender(users, items), 5)
    assert {r.userId: r.productIds for r in best.collect()} == {
        1: [1, 3, 5, 7, 9], 2: [1, 2, 3, 4, 5], 3: [2, 4, 6, 8, 10]}
    assert recommend.best_products(recommend.Recommender(users, items.limit(0)), 5).select(
        "productIds").distinct().collect() == [([],)]


def test_bands_that_no_user_reaches_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(recommend, "BAND", 4)
    rounds = []
    plain = recommend._round
    monkeypatch.setattr(recommend, "_round", lambda s, i, bands, c: rounds.append(len(bands))
                        or plain(s, i, bands, c))
    items = spark.createDataFrame(
        [(i, [1.0 / (i + 1) ** 2] + [0.0] * (recommend.RANK - 1)) for i in range(64)],
        "productId bigint, features array<float>")
    users = spark.createDataFrame([(1, [1.0] * recommend.RANK)], "userId bigint, features array<float>")
    best = recommend.best_products(recommend.Recommender(users, items), 3)
    assert best.first()["productIds"] == [0, 1, 2]
    assert sum(rounds) < 8


def same_factors(ours, theirs, key):
    ours = {r[key]: r.features for r in ours.collect()}
    theirs = {r[key]: r.features for r in theirs.collect()}
    assert ours.keys() == theirs.keys()
    for name, factors in theirs.items():
        assert ours[name] == pytest.approx(factors, abs=2e-3)


def test_users_after_the_fit_get_factors(spark, ratings):
    fitted = recommend.fit_factors(ratings, 2)
    early = recommend.Recommender(fitted.users.filter("userId < 10"), fitted.items)
    late = recommend.with_new_rows(early, ratings)
    same_factors(late.users, fitted.users, "userId")
    assert late.items is early.items


def test_products_after_the_fit_get_factors(spark, ratings):
    fitted = recommend.fit_factors(ratings, 2)
    early = recommend.Recommender(fitted.users, fitted.items.filter("productId < 9"))
    late = recommend.with_new_rows(early, ratings)
    assert late.users is early.users and late.items.count() == 13
    both = recommend.Recommender(fitted.users.filter("userId < 15"),
                                 fitted.items.filter("productId < 9"))
    late = recommend.with_new_rows(both, ratings)
    assert (late.users.count(), late.items.count()) == (20, 13)
    # Users are solved last and so answer to the products as they are.
    found = checks._unsolved(ratings, late.users.filter("userId >= 15"), late.items, "userId",
                             "productId", 1e-4).first()
    assert (found["rows"], found["unsolved"]) == (5, 0)


def test_ratings_that_reach_no_known_row_give_no_factors(spark, ratings):
    fitted = recommend.fit_factors(ratings, 2)
    apart = spark.createDataFrame([(901, 801, 2)], "userId int, productId int, rating int")
    late = recommend.with_new_rows(fitted, ratings.union(apart))
    assert (late.users.count(), late.items.count()) == (20, 13)
    assert recommend.with_new_rows(fitted, ratings) is fitted


def test_a_model_without_a_note_is_refused(spark, tmp_path):
    path = str(tmp_path / "model")
    score_model(spark).write().save(path)
    with pytest.raises(ValueError, match="no note"):
        load_or_fit(spark, path, PipelineModel, None)
    load_or_fit(spark, path, PipelineModel, lambda: score_model(spark), retrain=True)
    assert load_or_fit(spark, path, PipelineModel, None)


def test_a_model_fitted_otherwise_is_refused(spark, tmp_path):
    path = str(tmp_path / "kept")
    load_or_fit(spark, path, PipelineModel, lambda: score_model(spark), about={"k": 5, "bands": {
        "a": [(1, None, 2)]}})
    assert load_or_fit(spark, path, PipelineModel, None, about={"k": 5, "bands": {
        "a": [(1, None, 2)]}})
    with pytest.raises(ValueError, match="other k"):
        load_or_fit(spark, path, PipelineModel, None, about={"k": 4, "bands": {
            "a": [(1, None, 2)]}})


@pytest.mark.parametrize("stored", [False, True])
def test_users_without_a_score_are_refused_or_left_out(spark, tmp_path, stored):
    import dataclasses

    from tagweave.plans import mining
    from tagweave.plans.settings import Settings

    names = "userId bigint, consumerDays int, orderCount int, monetary double"
    whole = spark.createDataFrame([(i, i % 20 + 1, i * 5 + 1, i * 9000.0) for i in range(60)],
                                  names)
    holes = whole.union(spark.createDataFrame([(99, 5, 5, 9999.995)], names))
    settings = Settings(model_root=str(tmp_path / "m") if stored else None)
    if stored:
        mining.add_rfm(whole, settings)
    with pytest.raises(ValueError, match="no score band"):
        mining.add_rfm(holes, settings)
    left = mining.add_rfm(holes, dataclasses.replace(settings, skip_unscored=True))
    assert left.count() == 60 and left.filter("rfmCluster IS NULL").count() == 0


def test_all_iteration_limits_are_tried(spark, monkeypatch):
    seen = []
    plain = cluster.KMeans

    def spy(**options):
        seen.append(options["maxIter"])
        return plain(**options)

    monkeypatch.setattr(cluster, "KMeans", spy)
    score_model(spark)
    assert seen == [5, 10, 20]


def test_a_coreset_costs_little(spark):
    values = spark.range(20_000).select(
        (F.pow(F.rand(3), 4) * 3 + F.col("id") % 3).alias("s")).union(
            spark.sql("SELECT 40.0D UNION ALL SELECT NULL"))
    points = cluster.coreset(values, "s")
    kept = points.agg(F.sum("weight"), F.sum(F.col("weight") * F.col("s")), F.count("*")).first()
    assert kept[0] == 20_001 and kept[2] <= cluster.QUANTILES + cluster.WIDTHS
    assert kept[1] == pytest.approx(values.agg(F.sum("s")).first()[0])
    again = cluster.coreset(values.repartition(7), "s")
    assert points.select("weight").exceptAll(again.select("weight")).count() < 0.2 * kept[2]

    def cost(condensed):
        model = cluster.fit_value_clusters(values.na.drop(), "s", 5, condensed=condensed)
        low, high = (float(model.stages[1].originalMin[0]), float(model.stages[1].originalMax[0]))
        at = [low + float(c[0]) * (high - low) for c in model.stages[-1].clusterCenters()]
        return values.agg(F.sum(F.array_min(F.array(*[F.pow(F.col("s") - c, 2) for c in at])))
                          ).first()[0]

    assert cost(True) <= 1.01 * cost(False)
    one = cluster.coreset(spark.range(5).select(F.lit(2.5).alias("s")), "s")
    assert [tuple(r) for r in one.collect()] == [(2.5, 5.0)]
    assert cluster.coreset(values.limit(0), "s").count() == 0
