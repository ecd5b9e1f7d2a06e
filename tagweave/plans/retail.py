"""Rules for the star schema views: a taxonomy, score bands and vocabularies.

The bands follow the value ranges measured on those tables. ``buyFrequency`` and
``ageRange`` leave some users out, as real rules do; the profile needs rules
that cover everyone, which ``COVERING`` adds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagweave.operators.shopping import GoodsCoding
from tagweave.plans.settings import Settings
from tagweave.plans.tags import BY_NAME
from tagweave.sources.starschema import LOGS_AS_OF, ORDERS_AS_OF
from tagweave.sources.taxonomy import Taxonomy, taxonomy_frame

RULES: dict[str, list[tuple[str, str]]] = {
    "gender": [("male", "0"), ("female", "1"), ("undisclosed", "2")],
    "job": [("driver", "AUTOMOBILE"), ("builder", "BUILDING"), ("joiner", "FURNITURE"),
            ("homemaker", "HOUSEHOLD"), ("mechanic", "MACHINERY")],
    "nationality": [(f"country {code}", str(code)) for code in range(25)],
    "marriage": [("single", "0"), ("married", "1"), ("divorced", "2"), ("widowed", "3"),
                 ("separated", "4")],
    "politicalFace": [("none", "0"), ("member", "1"), ("youth", "2"), ("other", "3")],
    "isBlackList": [("no", "0"), ("yes", "1")],
    "ageRange": [("50s and 60s", "19500101-19691231"), ("70s and 80s", "19700101-19891231"),
                 ("90s and 00s", "19900101-20091231")],
    "buyFrequency": [("monthly", "1-1"), ("twice monthly", "2-2"), ("often", "3-9")],
    "consumeCycle": [("this month", "0-30"), ("this quarter", "31-90"),
                     ("this year", "91-365"), ("long ago", "366-9999")],
    "exchangeRate": [("never", "0-0"), ("seldom", "1-2"), ("sometimes", "3-4"),
                     ("often", "5-99")],
    "returnRate": [("never", "0-0"), ("seldom", "1-2"), ("sometimes", "3-4"),
                   ("often", "5-99")],
    "lastLogin": [("this month", "0-30"), ("this quarter", "31-90"),
                  ("this year", "91-365"), ("long ago", "366-9999")],
    "logFrequency": [("low", "0-54"), ("medium", "55-64"), ("high", "65-74"),
                     ("very high", "75-999")],
    "logTimeSlot": [("night", "0-5"), ("morning", "6-11"), ("afternoon", "12-17"),
                    ("evening", "18-23")],
    "maxOrder": [("small", "0-399999"), ("medium", "400000-449999"),
                 ("large", "450000-479999"), ("top", "480000-500000")],
    "payType": [("urgent", "1-URGENT"), ("high", "2-HIGH"), ("medium", "3-MEDIUM"),
                ("unspecified", "4-NOT SPECIFIED"), ("low", "5-LOW")],
    "unitPrice": [("low", "0-199999"), ("middle", "200000-249999"),
                  ("high", "250000-299999"), ("top", "300000-499999")],
    "rfm": [("top value", "0"), ("high value", "1"), ("medium value", "2"),
            ("low value", "3"), ("lowest value", "4")],
    "rfe": [("very active", "0"), ("active", "1"), ("quiet", "2"), ("dormant", "3")],
    "psm": [("extremely sensitive", "0"), ("sensitive", "1"), ("neutral", "2"),
            ("insensitive", "3"), ("extremely insensitive", "4")],
    "usg": [("male", "0"), ("female", "1"), ("undecided", "-1")],
}
COVERING = {
    "ageRange": [*RULES["ageRange"], ("10s and later", "20100101-20991231")],
    "buyFrequency": [("rarely", "0-0"), *RULES["buyFrequency"]],
}

SOURCES = {
    "users": ("tbl_users", "id"),
    "orders": ("tbl_orders", "memberId"),
    "logs": ("tbl_logs", "global_user_id"),
    "model": ("tbl_orders", "memberId"),
}
# Fields beside the key, where they are not named like the metric.
FIELDS = {
    "ageRange": "birthday", "lastLogin": "lastLoginTime", "consumeCycle": "finishTime",
    "unitPrice": "orderAmount", "maxOrder": "orderAmount", "payType": "paymentCode",
    "buyFrequency": "orderSn", "returnRate": "orderStatus",
    "exchangeRate": "orderStatus", "logFrequency": "log_time",
    "logTimeSlot": "log_time", "rfm": "orderSn|orderAmount|finishTime",
    "psm": "orderAmount|couponCodeValue", "usg": "orderSn",
    "rfe": "loc_url|log_time",
}

RFM_BANDS = {
    "r_score": [(1, 60, 5), (61, 120, 4), (121, 240, 3), (241, 400, 2), (401, None, 1)],
    "f_score": [(1, 6, 1), (7, 9, 2), (10, 12, 3), (13, 15, 4), (16, None, 5)],
    "m_score": [(None, 999999.99, 1), (1000000, 1999999.99, 2), (2000000, 2999999.99, 3),
                (3000000, 3999999.99, 4), (4000000, None, 5)],
}
RFE_BANDS = {
    "r_score": [(1, 1, 5), (2, 2, 4), (3, 3, 3), (4, 7, 2), (8, None, 1)],
    "f_score": [(None, 55, 1), (56, 62, 2), (63, 69, 3), (70, 77, 4), (78, None, 5)],
    "e_score": [(None, 33, 1), (34, 37, 2), (38, 41, 3), (42, 46, 4), (47, None, 5)],
}

CODING = GoodsCoding(
    colours=tuple(f"Brand#{i}" for i in range(1, 26)),
    types=("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"),
    female_colours=("Brand#3", "Brand#8", "Brand#13", "Brand#18", "Brand#23"),
    female_types=("PROMO", "SMALL"))

PAYMENTS = {"1-URGENT": "urgent order", "2-HIGH": "high order", "3-MEDIUM": "medium order"}


def taxonomy_rows(spark: SparkSession, covering: bool = False) -> DataFrame:
    rules = {**RULES, **COVERING} if covering else RULES
    tags = []
    for name, values in rules.items():
        tag = BY_NAME[name]
        table, key = SOURCES[tag.entity]
        fields = FIELDS.get(name, tag.metric)
        tags.append((tag.id, name, f"selectTable={table};selectField={key}|{fields}",
                     values))
    return taxonomy_frame(spark, tags)


def taxonomy(spark: SparkSession, covering: bool = False) -> Taxonomy:
    return Taxonomy(taxonomy_rows(spark, covering))


def settings(**changes) -> Settings:
    return Settings(**{"orders_as_of": ORDERS_AS_OF, "logs_as_of": LOGS_AS_OF,
                       "rfm_bands": RFM_BANDS, "rfe_bands": RFE_BANDS,
                       "coding": CODING, **changes})
