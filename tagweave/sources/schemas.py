"""Column contracts of the logical input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

TAXONOMY = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("pid", T.IntegerType()),
    T.StructField("level", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("rule", T.StringType()),
])

USERS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("gender", T.StringType()),
    T.StructField("job", T.StringType()),
    T.StructField("politicalFace", T.StringType()),
    T.StructField("marriage", T.StringType()),
    T.StructField("nationality", T.StringType()),
    T.StructField("is_blackList", T.StringType()),
    T.StructField("birthday", T.StringType()),
    T.StructField("lastLoginTime", T.LongType()),
])

ORDERS = T.StructType([
    T.StructField("memberId", T.LongType()),
    T.StructField("orderSn", T.StringType()),
    T.StructField("orderAmount", MONEY),
    T.StructField("couponCodeValue", MONEY),
    T.StructField("orderStatus", T.IntegerType()),
    T.StructField("paymentCode", T.StringType()),
    T.StructField("finishTime", T.LongType()),
])

LOGS = T.StructType([
    T.StructField("global_user_id", T.LongType()),
    T.StructField("loc_url", T.StringType()),
    T.StructField("log_time", T.TimestampNTZType()),
])

GOODS = T.StructType([
    T.StructField("cOrderSn", T.StringType()),
    T.StructField("ogColor", T.StringType()),
    T.StructField("productType", T.StringType()),
])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns ``df`` shares with ``schema`` to the declared types.

    A tag reads only the fields its rule names, so columns of the contract may
    be absent; columns outside the contract pass through. Values that do not
    fit a type fail under ANSI mode rather than turn into NULL.
    """
    declared = {field.name: field.dataType.simpleString() for field in schema}
    other = {name for name, dtype in df.dtypes if declared.get(name, dtype) != dtype}
    if not other:
        return df
    return df.selectExpr(*[
        f"CAST(`{name}` AS {declared[name]}) AS `{name}`" if name in other else f"`{name}`"
        for name in df.columns])


def require(df: DataFrame, columns: list[str], what: str) -> DataFrame:
    """Fail early, naming the missing columns, instead of deep in a plan."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s) {missing}; it has {df.columns}")
    return df
