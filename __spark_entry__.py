"""

Each query takes (spark, sf_dir) and reads the whole tables of that folder
through the star schema views.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

import retail_sql
from tagweave.functions import sql
from tagweave.operators import cluster, metrics, recommend, shopping, states
from tagweave.operators.match import code_match, range_match
from tagweave.operators.staging import stage, stage_path, staged_database
from tagweave.plans import checks, jobs, mining, profile, repair, retail
from tagweave.plans.tags import BY_NAME, MODEL, TAGS, run_catalog_tag, run_tag
from tagweave.sources.starschema import LOGS_AS_OF, ORDERS_AS_OF, StarSchema
from tagweave.sources.tables import Buckets, CatalogTables, FileTables
from tagweave.sources.versions import VersionedFiles

# The text operators may be absent; if they are there, an import error is one.
corpus_pipeline = text_queries = None
HERE = os.path.dirname(os.path.abspath(__file__))
if os.path.exists(f"{HERE}/corpus_pipeline.py") and os.path.exists(f"{HERE}/tagweave/llm/queries.py"):
    import corpus_pipeline
    from tagweave.llm import queries as text_queries

Query = Callable[[SparkSession, str], DataFrame]
SMOKE = "/root/testdata/sf0.001"


def _store(spark: SparkSession, folder: str) -> StarSchema:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return StarSchema(spark, folder)


def _tag(name: str) -> Query:
    """One tag, a rule tag by way of its taxonomy row."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        tagged = jobs.tag(name, _store(spark, folder), retail.taxonomy(spark),
                          retail.settings())
        if name == "maxOrder":
            tagged = tagged.withColumn("max_orderAmount",
                                       F.col("max_orderAmount").cast("double"))
        return tagged

    return query


def rfm_scores(spark, folder):
    valued = metrics.order_metrics(_store(spark, folder).orders(), ORDERS_AS_OF,
                                   cluster.RFM_METRICS)
    return mining.rfm_scores(valued, retail.settings()).select(
        "userId", *retail.RFM_BANDS)


def rfe_scores(spark, folder):
    valued = metrics.log_metrics(_store(spark, folder).logs(), LOGS_AS_OF,
                                 cluster.RFE_METRICS)
    return mining.rfe_scores(valued, retail.settings()).select(
        "userId", *retail.RFE_BANDS)


def psm_scores(spark, folder):
    return metrics.order_metrics(_store(spark, folder).orders(), ORDERS_AS_OF, ["psmScore"])


def user_goods(spark, folder):
    store = _store(spark, folder)
    return (shopping.user_goods(store.goods(), store.orders(), retail.CODING)
            .groupBy("userId", "color", "product", "label")
            .agg(F.count("*").alias("goods")))


def click_ratings(spark, folder):
    return metrics.product_ratings(_store(spark, folder).logs())


def product_name_lookup(spark, folder):
    """Names of the five products a user visited most."""
    store = _store(spark, folder)
    by_visits = Window.partitionBy("userId").orderBy(F.desc("rating"), "productId")
    best = (metrics.product_ratings(store.logs())
            .withColumn("place", F.row_number().over(by_visits)).filter("place <= 5"))
    wide = best.groupBy("userId").agg(*[
        F.max(F.when(F.col("place") == i, F.col("productId"))).alias(name)
        for i, name in enumerate(recommend.TOP, 1)])
    return recommend.name_products(wide, store.products())


def order_metrics(spark, folder):
    valued = metrics.order_metrics(_store(spark, folder).orders(), ORDERS_AS_OF)
    return valued.select(*[F.col(c).cast("double").alias(c)
                           if c in ("maxOrder", "monetary") else c
                           for c in valued.columns])


def log_metrics(spark, folder):
    return metrics.log_metrics(_store(spark, folder).logs(), LOGS_AS_OF)


def profile_sql(spark, folder):
    return profile.rule_profile(_store(spark, folder), retail.taxonomy(spark, True),
                                retail.settings())


def profile_left(spark, folder):
    """The same profile, keeping users that lack some tags."""
    return profile.rule_profile(_store(spark, folder), retail.taxonomy(spark),
                                retail.settings(), how="left")


def profile_joined(spark, folder):
    """The same profile from one table per tag."""
    store, rules = _store(spark, folder), retail.taxonomy(spark, True)
    return profile.assemble(profile.profile_parts(
        {tag.name: run_tag(tag, store, rules, retail.settings().as_of(tag.entity))
         for tag in TAGS if tag.entity != MODEL}))


def profile_full(spark, folder):
    values = profile.full_values(_store(spark, folder), retail.settings())
    return profile.full_profile(values, retail.taxonomy(spark, True))


def range_gap_drop(spark, folder):
    """Bands with a hole, and values on, between and beyond their ends."""
    valued = metrics.order_metrics(_store(spark, folder).orders(), ORDERS_AS_OF,
                                   ["orderCount"])
    return range_match(valued, retail_sql.frame(spark, retail_sql.GAP_BANDS), "orderCount", "band")


def half_open_bands(spark, folder):
    """Integer bands stretched to the next integer, so no price falls between."""
    valued = metrics.order_metrics(_store(spark, folder).orders(), ORDERS_AS_OF,
                                   ["unitPrice"])
    return range_match(valued, retail_sql.frame(spark, retail_sql.PRICE_BANDS), "unitPrice",
                       "band", half_open=True)


def many_bands(spark, folder):
    """More bands than are compared one by one: 500 of unequal width."""
    valued = metrics.order_metrics(_store(spark, folder).orders(), ORDERS_AS_OF,
                                   ["unitPrice"])
    bands = spark.range(500).select(
        F.concat(F.lit("band "), F.col("id")).alias("name"),
        (F.col("id") * F.col("id") * 2).alias("start"),
        ((F.col("id") + 1) * (F.col("id") + 1) * 2 - 1).alias("end"))
    return range_match(valued, bands, "unitPrice", "band")


def code_unmatched_drop(spark, folder):
    """Codes without a rule, integers against text rules."""
    users = _store(spark, folder).base("customer").select(
        F.col("c_custkey").alias("userId"), F.col("c_nationkey").alias("nation"))
    return code_match(users, retail_sql.frame(spark, retail_sql.SOME_CODES), "nation", "region")


def nation_names(spark, folder):
    """Rules from a table, joined the way a table too large to broadcast is."""
    store = _store(spark, folder)
    users = metrics.user_metrics(store.users(), ORDERS_AS_OF, ["nationality"])
    rules = store.base("nation").select(F.col("n_name").alias("name"),
                                        F.col("n_nationkey").alias("rule"))
    return code_match(users, rules, "nationality", "nationality", limit=10)


def metadata_scan(spark, folder):
    """All user code tags, each directed by its taxonomy row, side by side."""
    store, rules = _store(spark, folder), retail.taxonomy(spark)
    return profile.assemble([run_tag(BY_NAME[name], store, rules) for name in
                             ("gender", "job", "politicalFace", "marriage")])


def gender_from_catalog(spark, folder):
    """Taxonomy, users and the tag as tables of a catalog database."""
    tables = CatalogTables(spark, staged_database(spark, "shop"))
    tables.write(retail.taxonomy_rows(spark), "tbl_basic_tags")
    tables.write(_store(spark, folder).users(), "tbl_users")
    tables.write(run_catalog_tag(spark, BY_NAME["gender"], tables.database), "tbl_gender_tag")
    return tables.read("tbl_gender_tag")


def profile_from_buckets(spark, folder):
    """The profile joined from catalog tables that are bucketed by user."""
    tables = CatalogTables(spark, staged_database(spark, "tags"), buckets=Buckets("userId", 8))
    for name, tagged in profile.rule_tag_tables(
            _store(spark, folder), retail.taxonomy(spark, True), retail.settings()).items():
        tables.write(tagged, name)
    return profile.profile_from_tables(tables, models=False)


def tag_sinks(spark, folder):
    """One tag through every kind of table: overwritten, appended to and read again."""
    tagged = _tag("consumeCycle")(spark, folder)
    odd, even = (tagged.filter(F.col("userId") % 2 == rest) for rest in (1, 0))
    root, catalog = stage_path(spark, "sinks"), staged_database(spark, "sinks")
    stores = {"parquet": FileTables(spark, f"{root}/parquet"),
              "json": FileTables(spark, f"{root}/json", "json"),
              "csv": FileTables(spark, f"{root}/csv", "csv", options={"header": "true"}),
              "versions": VersionedFiles(spark, f"{root}/versions"),
              "catalog": CatalogTables(spark, catalog),
              "views": CatalogTables(spark, catalog, versioned=True)}
    found = []
    for kind, store in stores.items():
        table = f"tbl_{kind}"
        store.write(tagged, table)
        store.write(odd, table, sort_by="userId")
        store.write(even, table, mode="append")
        again = store.read(table) if isinstance(store, CatalogTables) else store.read(
            table, tagged.schema)
        found.append(again.select(F.lit(kind).alias("sink"), *tagged.columns))
    return reduce(DataFrame.unionByName, found)


def sql_functions(spark, folder):
    """The SQL functions over all visits."""
    sql.register(spark)
    return spark.sql("""
        SELECT userId, coalesce(productId, '') AS productId, hours.start AS hour_start,
               hours.end AS hour_end, places.top1, coalesce(places.top2, -1) AS top2,
               coalesce(places.top3, -1) AS top3, coalesce(places.top4, -1) AS top4,
               coalesce(places.top5, -1) AS top5
        FROM (SELECT global_user_id AS userId, url_to_product(loc_url) AS productId,
                     rule_to_tuple(concat(hour(log_time), '-', hour(log_time) + 1)) AS hours,
                     string_to_product(concat_ws(',', global_user_id,
                                                 url_to_product(loc_url))) AS places
              FROM {logs})""", logs=_store(spark, folder).logs())


def _by_day(spark, facts, batches, kept, as_of):
    """Metrics from a state that takes one batch of facts after the other."""
    store = VersionedFiles(spark, stage_path(spark, "states"))
    for name, condition in batches.items():
        state = states.add_day(store, "state", facts.filter(condition), name, kept)
    return states.metrics_of(state, kept, as_of)


ORDER_BATCHES = {"1": "finishTime < 800000000", "2": "finishTime BETWEEN 800000000 AND 899999999",
                 "3": "finishTime >= 900000000"}
LOG_BATCHES = {"1": "log_time < DATE'2024-01-20'", "2": "log_time >= DATE'2024-01-20'"}


def order_metrics_by_day(spark, folder):
    """Order metrics merged from three spans of days."""
    valued = _by_day(spark, _store(spark, folder).orders(), ORDER_BATCHES, states.ORDERS_KEPT,
                     ORDERS_AS_OF)
    return valued.select(*[F.col(c).cast("double").alias(c) if c in ("maxOrder", "monetary") else c
                           for c in valued.columns])


def log_metrics_by_day(spark, folder):
    """Log metrics merged from two spans of days."""
    return _by_day(spark, _store(spark, folder).logs(), LOG_BATCHES, states.LOGS_KEPT, LOGS_AS_OF)


def page_sketch_check(spark, folder):
    """Users, and those whose sketched number of pages is off by over 8 % and one."""
    logs = _store(spark, folder).logs()
    sketched = _by_day(spark, logs, LOG_BATCHES, states.LOGS_SKETCHED, LOGS_AS_OF)
    exact = metrics.log_metrics(logs, LOGS_AS_OF, ["pageCount"]).withColumnRenamed(
        "pageCount", "exact")
    far = F.abs(F.col("pageCount") - F.col("exact")) > 1 + 0.08 * F.col("exact")
    return sketched.join(exact, "userId").groupBy().agg(
        F.count("*").alias("users"), F.sum(far.cast("long")).alias("far"))


def returned_goods(spark, folder):
    """Goods of returned orders: a key filter before the join, large orders split."""
    store = _store(spark, folder)
    returned = store.orders().filter(F.col("orderStatus") == metrics.RETURNED)
    return (metrics.sold_goods(store.goods(), returned, retail.CODING.features(), True, 7)
            .groupBy("userId", "color", "product", "label").agg(F.count("*").alias("goods")))


def rfm_silhouette(spark, folder):
    """How well the customer value clusters separate."""
    settings, store = retail.settings(), _store(spark, folder)
    scored = stage(mining.rfm_scores(metrics.order_metrics(
        store.orders(), ORDERS_AS_OF, cluster.RFM_METRICS), settings), "rfm-scores")
    model = cluster.fit_score_clusters(scored, list(retail.RFM_BANDS), cluster.RFM_CLUSTERS)
    counted = scored.groupBy(*retail.RFM_BANDS).agg(
        F.count("*").cast("double").alias("weight"))
    return counted.groupBy().agg(F.sum("weight").alias("users")).withColumn(
        "silhouette", F.lit(cluster.silhouette(model, counted)))


def bp_error(spark, folder):
    """How far the recommender's predictions are from the visits."""
    ratings = stage(metrics.product_ratings(_store(spark, folder).logs()), "ratings")
    model = recommend.fit_recommender(ratings)
    return ratings.groupBy().agg(F.count("*").alias("ratings")).withColumn(
        "rmse", F.lit(recommend.ratings_error(model, ratings)))


def repair_orders(spark, folder):
    orders = _store(spark, folder).orders().select(
        "orderSn", "memberId", "paymentCode", "finishTime")
    return repair.repair_orders(orders, payments=retail.PAYMENTS)


def repair_orders_midnight(spark, folder):
    orders = _store(spark, folder).orders().select(
        "orderSn", "memberId", "paymentCode",
        (F.col("finishTime") + 3661).alias("finishTime"))
    return repair.repair_orders(orders, payments=retail.PAYMENTS, to_midnight=True)


def shift_logs(spark, folder):
    return repair.shift_logs(_store(spark, folder).logs())


def shift_logs_midnight(spark, folder):
    return repair.shift_logs(_store(spark, folder).logs(), to_midnight=True)


def shift_users(spark, folder):
    return repair.shift_users(_store(spark, folder).users().select("id", "lastLoginTime"))


def shift_users_midnight(spark, folder):
    return repair.shift_users(_store(spark, folder).users().select("id", "lastLoginTime"),
                              to_midnight=True)


def many_bands_signed(spark, folder):
    """Bands on both sides of zero, more than are compared one by one."""
    valued = metrics.order_metrics(_store(spark, folder).orders(), ORDERS_AS_OF,
                                   ["unitPrice"])
    centred = valued.withColumn("offset", F.col("unitPrice") - 250000)
    bands = spark.range(-200, 200).select(
        F.concat(F.lit("band "), F.col("id")).alias("name"),
        (F.col("id") * 1500).alias("start"), (F.col("id") * 1500 + 1299).alias("end"))
    return range_match(centred, bands, "offset", "band").select("userId", "offset", "band")


def unit_price_half_open(spark, folder):
    """The tag with bands stretched to the next integer."""
    return run_tag(BY_NAME["unitPrice"], _store(spark, folder), retail.taxonomy(spark),
                   ORDERS_AS_OF, half_open=True)


def rfe_scores_lagged(spark, folder):
    """Engagement of logs that lag behind the day counted to."""
    store = _store(spark, folder)
    logs = store.logs().withColumn("log_time", F.col("log_time") - F.expr("INTERVAL 1640 DAYS"))
    valued = metrics.log_metrics(logs, LOGS_AS_OF, cluster.RFE_METRICS)
    return mining.rfe_scores(valued, retail.settings(visit_lag_days=1640)).select(
        "userId", *retail.RFE_BANDS)


def rfm_tag_check(spark, folder):
    return checks.score_clusters(_store(spark, folder), retail.settings(), "rfm")


def rfe_tag_check(spark, folder):
    return checks.score_clusters(_store(spark, folder), retail.settings(), "rfe")


def psm_tag_check(spark, folder):
    return checks.value_clusters(_store(spark, folder), retail.settings())


def psm_coreset_check(spark, folder):
    return checks.coreset_fault(_store(spark, folder), retail.settings())


def silhouette_check(spark, folder):
    settings, store = retail.settings(), _store(spark, folder)
    scored = stage(mining.rfe_scores(metrics.log_metrics(
        store.logs(), LOGS_AS_OF, cluster.RFE_METRICS), settings), "rfe-scores")
    return checks.silhouette_fault(scored, retail.RFE_BANDS, cluster.RFE_CLUSTERS)


def _ratings(spark, folder):
    return stage(metrics.product_ratings(_store(spark, folder).logs()), "ratings")


def rmse_check(spark, folder):
    ratings = _ratings(spark, folder)
    return checks.error_fault(ratings, recommend.fit_recommender(ratings))


def bp_check(spark, folder):
    ratings = _ratings(spark, folder)
    return checks.recommender_faults(ratings, recommend.fit_factors(ratings))


def bp_lists_check(spark, folder):
    return checks.list_faults(recommend.fit_factors(_ratings(spark, folder)))


def bp_best_check(spark, folder):
    return checks.best_faults(recommend.fit_factors(_ratings(spark, folder)))


def bp_fold_in_check(spark, folder):
    return checks.fold_in_faults(_ratings(spark, folder))


def profile_full_check(spark, folder):
    return checks.profile_faults(_store(spark, folder), retail.settings(),
                                 retail.taxonomy(spark, True))


RULE_TAGS = {
    "tag_gender": "gender", "tag_job": "job", "tag_marriage": "marriage",
    "tag_nationality": "nationality", "tag_political": "politicalFace",
    "tag_blacklist": "isBlackList", "tag_age_range": "ageRange",
    "tag_consume_cycle": "consumeCycle", "tag_unit_price": "unitPrice",
    "tag_pay_type": "payType", "tag_max_order": "maxOrder",
    "tag_buy_frequency": "buyFrequency", "tag_return_count": "returnRate",
    "tag_exchange_count": "exchangeRate", "tag_last_login": "lastLogin",
    "tag_log_frequency": "logFrequency", "tag_log_time_slot": "logTimeSlot",
}
MODEL_TAGS = {"usg_vote": "usg", "rfm_tag": "rfm", "rfe_tag": "rfe", "psm_tag": "psm",
              "bp_top5": "bp"}


def entry(spark: SparkSession) -> DataFrame:
    """The profile over all rule tags, on the smallest tables."""
    return profile_sql(spark, SMOKE)


def queries() -> dict[str, Query]:
    named = [rfm_scores, rfe_scores, psm_scores, user_goods, click_ratings,
             order_metrics, log_metrics, product_name_lookup, profile_sql,
             profile_left, profile_joined, range_gap_drop, half_open_bands, many_bands,
             code_unmatched_drop, nation_names, metadata_scan, gender_from_catalog, profile_from_buckets, tag_sinks,
             order_metrics_by_day, log_metrics_by_day, page_sketch_check, returned_goods,
             sql_functions, repair_orders, repair_orders_midnight, shift_logs,
             shift_logs_midnight, shift_users, rfm_silhouette, bp_error, profile_full,
             shift_users_midnight, many_bands_signed, unit_price_half_open,
             rfe_scores_lagged, rfm_tag_check, rfe_tag_check, psm_tag_check, psm_coreset_check,
             silhouette_check, rmse_check, bp_check, bp_lists_check, profile_full_check,
             bp_best_check, bp_fold_in_check]
    text = {} if text_queries is None else {
        **text_queries.queries(), "pipeline": corpus_pipeline.run}
    return {**{key: _tag(tag) for key, tag in {**RULE_TAGS, **MODEL_TAGS}.items()},
            **{query.__name__: query for query in named}, **text}


def oracle_sql() -> dict[str, str]:
    text = {} if text_queries is None else text_queries.oracle_sql()
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL:
        text["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**retail_sql.sql(RULE_TAGS), **text}
