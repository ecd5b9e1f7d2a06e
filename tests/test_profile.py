import os

import pytest
from pyspark.sql import functions as F

from tagweave.__main__ import main, place
from tagweave.plans import jobs, mining, profile, retail
from tagweave.plans.settings import Settings
from tagweave.plans.tags import (BY_NAME, CODE, PREFERENCE_TABLE, PROFILE_TABLE, TAGS,
                                 run_catalog_tag, run_tag)
from tagweave.sources.starschema import StarSchema
from tagweave.sources.tables import Buckets, CatalogTables, FileTables, FrameTables
from tagweave.sources.taxonomy import Taxonomy, taxonomy_frame

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

# The columns of the profile.
COLUMNS = """userId gender job nationality marriage politicalFace is_blackList rfm rfe psm
usg ageRange buyFrequency consumptionCycle exchangeRate loginCycle logFrequency logTimeSlot
maxOrderRange payType returnRate unitPriceRange BpTop1 BpTop2 BpTop3 BpTop4
BpTop5""".split()


def test_the_declared_tags():
    assert len(TAGS) == 21 and len({t.id for t in TAGS}) == 21
    assert len({t.table for t in TAGS}) == 21
    assert sum(t.match == CODE for t in TAGS) == 11


def test_inner_assembly_drops_and_left_keeps(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "userId bigint, a string")
    b = spark.createDataFrame([(2, "z")], "userId bigint, b string")
    assert rows(profile.assemble([a, b])) == [(2, "y", "z")]
    assert rows(profile.assemble([a, b], "left")) == [(1, "x", None), (2, "y", "z")]


def test_a_second_row_of_a_user_is_refused(spark):
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "userId bigint, a string")
    with pytest.raises(ValueError, match=r"users has several rows for user\(s\) \[1\]"):
        profile.check_unique(twice, "users")
    assert profile.check_unique(twice.limit(1), "users").count() == 1


def test_a_tag_reads_what_its_taxonomy_row_names(spark, rows):
    taxonomy = Taxonomy(taxonomy_frame(spark, [
        (106, "gender", "selectTable=people;selectField=id|gender",
         [("male", "1"), ("female", "2")])]))
    people = spark.createDataFrame([("3", 1, "?"), ("4", 2, "?"), ("5", 9, "?")],
                                   "id string, gender int, extra string")
    found = run_tag(BY_NAME["gender"], FrameTables({"people": people}), taxonomy)
    assert found.columns == ["userId", "gender"]
    assert rows(found) == [(3, "male"), (4, "female")]


def test_tag_columns(spark):
    taxonomy = Taxonomy(taxonomy_frame(spark, [
        (236, "buyFrequency", "selectTable=o;selectField=memberId|orderSn", [("often", "1-9")]),
        (230, "maxOrder", "selectTable=o;selectField=memberId|orderAmount", [("big", "0-99")]),
    ]))
    orders = spark.createDataFrame([("3", str(i), "12.50") for i in range(9)],
                                   "memberId string, orderSn string, orderAmount string")
    store = FrameTables({"o": orders})
    assert run_tag(BY_NAME["buyFrequency"], store, taxonomy).head().asDict() == {
        "userId": 3, "value": "often", "frequency": 2.0}
    row = run_tag(BY_NAME["maxOrder"], store, taxonomy).head().asDict()
    assert (str(row["max_orderAmount"]), row["maxOrderRange"]) == ("12.50", "big")


def test_a_tag_in_the_catalog(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS tag_tests")
    store = CatalogTables(spark, "tag_tests")
    store.write(taxonomy_frame(spark, [(106, "gender", "selectTable=people;"
                                        "selectField=id|gender", [("male", "1")])]),
                "tbl_basic_tags")
    store.write(spark.createDataFrame([(3, 1), (4, 2)], "id bigint, gender int"), "people")
    found = run_catalog_tag(spark, BY_NAME["gender"], "tag_tests")
    store.write(found, "tbl_gender_tag")
    assert rows(store.read("tbl_gender_tag")) == [(3, "male")]
    assert store.read("tbl_gender_tag").columns == ["user_id", "gender"]


def test_engagement_counts_to_a_day_that_lags(spark):
    valued = spark.createDataFrame([(1, 1650, 5, 5)],
                                   "userId bigint, visitDays int, viewCount int, pageCount int")
    assert mining.rfe_scores(valued, Settings()).head().r_score == 1.0
    assert mining.rfe_scores(valued, Settings(visit_lag_days=1640)).head().r_score == 5.0


@needs_data
def test_run_all(spark, tmp_path, rows):
    store, taxonomy = StarSchema(spark, FOLDER), retail.taxonomy(spark, covering=True)
    settings = retail.settings(model_root=str(tmp_path / "models"), recommender_blocks=2)
    out = FileTables(spark, str(tmp_path / "out"))
    first = profile.run_all(store, out, taxonomy, settings)
    assert first.columns == COLUMNS
    kept = rows(first)
    assert 10 <= len(kept) <= 15
    assert all(value is not None for row in kept for value in row)
    for tag in TAGS:
        table = out.read(tag.table)
        assert {"userId", tag.label} <= set(table.columns)
        assert table.select("userId").distinct().count() == table.count() > 0
    assert out.read(PREFERENCE_TABLE).columns == ["userId", "top1", "top2", "top3",
                                                  "top4", "top5"]
    # Joined again from the written tables, and computed again with kept models.
    assert rows(profile.profile_from_tables(out)) == kept
    assert not list((tmp_path.parent).glob("**/run-*"))
    # The same from catalog tables bucketed by user, which no join or check moves.
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed_tags")
    bucketed = CatalogTables(spark, "bucketed_tags", buckets=Buckets("userId", 4))
    for tag in TAGS:
        bucketed.write(out.read(tag.table), tag.table)
    bucketed.write(out.read(PREFERENCE_TABLE), PREFERENCE_TABLE)
    joined = profile.profile_from_tables(bucketed)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 21
    assert rows(joined) == kept
    bucketed.write(out.read(TAGS[0].table).limit(1), TAGS[0].table, mode="append")
    with pytest.raises(ValueError, match=f"several rows .* in the table of {TAGS[0].label}"):
        profile.profile_from_tables(bucketed)
    again = profile.full_profile(profile.full_values(store, settings), taxonomy)
    assert rows(again) == kept


@needs_data
@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_users_table_with_repeated_ids_is_refused(spark, how):
    class Repeated(StarSchema):
        def users(self):
            return super().users().unionAll(super().users().filter("id < 4"))

        def read(self, name):
            return self.users() if name == "tbl_users" else super().read(name)

    with pytest.raises(ValueError, match="tbl_users has several rows"):
        profile.rule_profile(Repeated(spark, FOLDER), retail.taxonomy(spark, True),
                             retail.settings(), how)


@needs_data
def test_the_profile_aggregates_orders_once(spark):
    plan = profile.rule_profile(
        StarSchema(spark, FOLDER), retail.taxonomy(spark, True), retail.settings()
    )._jdf.queryExecution().executedPlan().toString()
    # The order metrics, the payment codes, and the users' last login.
    assert plan.count("FileScan parquet [o_") == 3
    # No order tag of the rule profile needs coupons, so lines are not read.
    assert "l_orderkey" not in plan


def test_the_command_line(spark, tmp_path, rows):
    source = FileTables(spark, str(tmp_path / "in"))
    source.write(taxonomy_frame(spark, [
        (106, "gender", "selectTable=people;selectField=id|gender", [("male", "1")]),
        (240, "returnRate", "selectTable=buys;selectField=memberId|orderStatus",
         [("none", "0-0"), ("some", "1-9")])]), "tbl_basic_tags")
    source.write(spark.createDataFrame([(3, 1), (4, 2)], "id bigint, gender int"), "people")
    source.write(spark.createDataFrame([(3, 0), (3, 0), (4, 1)],
                                       "memberId bigint, orderStatus int"), "buys")
    main([f"--in=parquet:{tmp_path}/in", f"--out=json:{tmp_path}/out", "--sort",
          "gender", "returnRate"])
    out = FileTables(spark, str(tmp_path / "out"), "json")
    assert rows(out.read("tbl_gender_tag").select("userId", "gender")) == [(3, "male")]
    assert rows(out.read("tbl_returnRate_tag").select("userId", "value", "returnRate")) == [
        (3, "some", 2), (4, "none", 0)]


def test_repairs_from_the_command_line(spark, tmp_path, rows):
    source = FileTables(spark, str(tmp_path / "in"))
    source.write(spark.createDataFrame([(1, 86400), (2, None)],
                                       "id bigint, lastLoginTime bigint"), "tbl_users")
    out = FileTables(spark, str(tmp_path / "out"))
    main([f"--in=parquet:{tmp_path}/in", f"--out=parquet:{tmp_path}/out", "shift-users"])
    assert rows(out.read("tbl_users_new")) == [(1, 86400 * 3068), (2, None)]


def test_a_profile_that_keeps_users_without_some_tags(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(profile, "profile_from_tables", lambda out, how: asked.append(how)
                        or spark.range(1))
    source = FileTables(spark, str(tmp_path / "in"))
    source.write(taxonomy_frame(spark, [(106, "gender", "selectTable=a;selectField=b",
                                         [("x", "1")])]), "tbl_basic_tags")
    for flags in ([], ["--left"]):
        main([f"--in=parquet:{tmp_path}/in", f"--out=parquet:{tmp_path}/out", *flags, "profile"])
    assert asked == ["inner", "left"]


def test_a_user_twice_in_a_tag_table_is_refused(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b")], "userId bigint, gender string")
    two = spark.createDataFrame([(1, "c"), (1, "d")], "userId bigint, job string")
    assert profile.check_all_unique([one, one]) == [one, one]
    with pytest.raises(ValueError, match="1 in the table of job"):
        profile.check_all_unique([one, two])


def test_a_half_open_tag(spark, rows):
    from tagweave.plans.tags import BY_NAME, tag_table
    from tagweave.sources.taxonomy import Taxonomy

    rules = Taxonomy(taxonomy_frame(spark, [(217, "unitPrice", "selectTable=a;selectField=b",
                                             [("low", "0-999"), ("high", "1000-1999")])]))
    valued = spark.createDataFrame([(1, 999.5), (2, 1000.0)], "userId bigint, unitPrice double")
    assert rows(tag_table(BY_NAME["unitPrice"], valued, rules)) == [(2, "high", 1000.0)]
    assert rows(tag_table(BY_NAME["unitPrice"], valued, rules, half_open=True)) == [
        (1, "low", 999.5), (2, "high", 1000.0)]


def test_places(spark):
    jdbc = place(spark, "jdbc:mysql://h/db", {"user": "u", "splits": {"t": ["id", 1, 9, 3]}})
    assert jdbc.read_options("t") == {
        "user": "u", "url": "jdbc:mysql://h/db", "dbtable": "t", "fetchsize": "10000",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "3"}
    assert place(spark, "catalog:shop_tags", {}).qualified("t") == "`shop_tags`.`t`"
    assert place(spark, "orc:hdfs://h/x", {}).path("t") == "hdfs://h/x/t"


def test_every_job_has_its_table():
    assert len(jobs.TABLES) == len(set(jobs.TABLES.values())) == 23
    with pytest.raises(ValueError, match="no job 'x'"):
        jobs.run("x", None, None, None, None)
