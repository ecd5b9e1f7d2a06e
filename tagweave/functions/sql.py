"""The rule and product functions for use in SQL text.

They are SQL functions, so Catalyst puts their bodies into the query.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tagweave.functions.columns import PRODUCT_URL

_SLOTS = ", ".join(f"'top{i + 1}', try_cast(get(split(items, ','), {i}) AS INT)"
                   for i in range(5))
_BOUND = "CASE WHEN size(split(rule, '-')) = 2 " \
         "THEN try_cast(trim(split_part(rule, '-', {0})) AS INT) END"

# name -> (parameter, result type, body)
FUNCTIONS = {
    "rule_to_tuple": (
        "rule STRING", "STRUCT<start: INT, end: INT>",
        f"named_struct('start', {_BOUND.format(1)}, 'end', {_BOUND.format(2)})"),
    "url_to_product": (
        "url STRING", "STRING", f"nullif(regexp_extract(url, r'{PRODUCT_URL}', 1), '')"),
    "string_to_product": (
        "items STRING",
        "STRUCT<top1: INT, top2: INT, top3: INT, top4: INT, top5: INT>",
        f"named_struct({_SLOTS})"),
}


def register(spark: SparkSession) -> None:
    """Make the functions known to this session. Malformed text gives NULLs."""
    for name, (parameter, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameter}) "
                  f"RETURNS {result} RETURN {body}")
