import pytest

from tagweave.functions import sql


@pytest.fixture(scope="module")
def session(spark):
    sql.register(spark)
    sql.register(spark)
    return spark


def one(session, expression):
    return session.sql(f"SELECT {expression} AS v").head().v


def test_rule_to_tuple(session):
    assert tuple(one(session, "rule_to_tuple('100-199')")) == (100, 199)
    assert tuple(one(session, "rule_to_tuple('x')")) == (None, None)
    assert tuple(one(session, "rule_to_tuple(NULL)")) == (None, None)


def test_url_to_product(session):
    assert one(session, "url_to_product('http://s/product/77.html?a=1')") == "77"
    assert one(session, "url_to_product('http://s/product/77.html')") is None
    assert one(session, "url_to_product(NULL)") is None


def test_string_to_product(session):
    assert tuple(one(session, "string_to_product('5,4,3,2,1')")) == (5, 4, 3, 2, 1)
    assert tuple(one(session, "string_to_product('5,4')")) == (5, 4, None, None, None)


def test_over_a_table(session, rows):
    session.createDataFrame([("1-2",), ("3-4",)], "r string").createOrReplaceTempView("rr")
    found = session.sql("SELECT rule_to_tuple(r).start AS a, rule_to_tuple(r).end AS b FROM rr")
    assert rows(found) == [(1, 2), (3, 4)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
