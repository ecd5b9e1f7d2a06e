"""The checked queries again, as SQL over the base tables for DuckDB."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tagweave.operators import cluster
from tagweave.plans import retail, repair
from tagweave.plans.tags import BY_NAME, CODE, LOGS, MODEL, ORDERS, TAGS, USERS
from tagweave.sources.starschema import LOGS_AS_OF, ORDERS_AS_OF

GAP_BANDS = [("few", 1, 5), ("some", 8, 12), ("overlapping", 12, 14), ("many", 18, 40)]
PRICE_BANDS = [("low", 0, 199999), ("middle", 200000, 249999), ("high", 250000, 499999)]
SOME_CODES = [("first", "0"), ("first", "1"), ("second", "7"), ("unused", "n/a")]


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The rows above as (name, start, end) or (name, rule)."""
    names = ["name", "rule"] if len(rows[0]) == 2 else ["name", "start", "end"]
    columns = [pa.array(list(column), pa.string() if isinstance(column[0], str)
                        else pa.int32()) for column in zip(*rows)]
    return spark.createDataFrame(pa.table(columns, names=names))


def _text(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(_text(v) if isinstance(v, str) else str(v)
                                     for v in row) + ")" for row in rows)


def _bands(rules: list[tuple[str, str]]) -> list[tuple]:
    return [(name, *map(int, rule.split("-"))) for name, rule in rules]


SHOP_USERS = f"""
shop_users AS (
  SELECT c_custkey AS id,
         CAST(c_custkey % 3 AS VARCHAR) AS gender,
         c_mktsegment AS job,
         CAST(c_custkey % 4 AS VARCHAR) AS politicalFace,
         CAST(c_custkey % 5 AS VARCHAR) AS marriage,
         CAST(c_nationkey AS VARCHAR) AS nationality,
         CASE WHEN c_acctbal < 0 THEN '1' ELSE '0' END AS is_blackList,
         CAST(strftime(DATE '1950-01-01' + CAST(c_custkey * 7919 % 25000 AS INTEGER),
                       '%Y%m%d') AS INTEGER) AS bornDate,
         last_order,
         CAST(date_diff('day', last_order, DATE '{ORDERS_AS_OF}') AS INTEGER) AS loginDays
  FROM customer LEFT JOIN (
    SELECT o_custkey, MAX(o_orderdate) AS last_order FROM orders GROUP BY o_custkey
  ) ON o_custkey = c_custkey)"""

SHOP_ORDERS = """
shop_orders AS (
  SELECT o_custkey AS member, CAST(o_orderkey AS VARCHAR) AS sn,
         CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
         COALESCE(CAST(coupon AS DECIMAL(12,2)), 0) AS coupon,
         CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS status,
         o_orderpriority AS pay, o_orderdate AS finished
  FROM orders LEFT JOIN (
    SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(12,2))
                           * CAST(l_discount AS DECIMAL(4,2))) AS coupon
    FROM lineitem WHERE l_discount >= 0.10 GROUP BY l_orderkey
  ) ON l_orderkey = o_orderkey)"""

SHOP_LOGS = r"""
shop_logs AS (
  SELECT user_id, ts,
         CASE WHEN event_type IN ('click', 'view', 'purchase')
              THEN 'https://shop.example/product/'
                   || regexp_extract(props, '"k": *([0-9]+)', 1)
                   || '.html?t=' || event_type
              ELSE 'https://shop.example/' || event_type END AS url
  FROM events)"""

ORDER_METRICS = f"""
order_sums AS (
  SELECT member, COUNT(*) AS n, SUM(amount) AS amount, MAX(amount) AS top_amount,
         MAX(finished) AS finished,
         CAST(SUM(CASE WHEN status = 0 THEN 1 ELSE 0 END) AS BIGINT) AS returned,
         CAST(SUM(CASE WHEN status = 1 THEN 1 ELSE 0 END) AS BIGINT) AS exchanged,
         CAST(SUM(CASE WHEN coupon = 0 THEN 0 ELSE 1 END) AS DOUBLE) AS discounted,
         CAST(SUM(coupon) AS DOUBLE) AS discount,
         CAST(SUM(amount + coupon) AS DOUBLE) AS receivable
  FROM shop_orders GROUP BY member),
pay_counts AS (SELECT member, pay, COUNT(*) AS n FROM shop_orders GROUP BY member, pay),
pay_first AS (
  SELECT member, pay FROM pay_counts
  QUALIFY ROW_NUMBER() OVER (PARTITION BY member ORDER BY n DESC, pay) = 1),
order_metrics AS (
  SELECT s.member AS "userId",
         CAST(date_diff('day', finished, DATE '{ORDERS_AS_OF}') AS INTEGER)
           AS "consumerDays",
         CAST((2 * CAST(amount * 100 AS BIGINT) + n) // (2 * n) AS DOUBLE) / 100
           AS "unitPrice",
         CAST(top_amount AS DOUBLE) AS "maxOrder",
         ROUND(n / 6, 0) AS "buyFrequency",
         returned AS "returnCount", exchanged AS "exchangeCount", n AS "orderCount",
         CAST(amount AS DOUBLE) AS "monetary",
         COALESCE(discounted / n + discount / NULLIF(receivable, 0)
                  + (discount / NULLIF(discounted, 0)) / NULLIF(receivable / n, 0),
                  1e-8) AS "psmScore",
         pay AS payment
  FROM order_sums s JOIN pay_first f ON f.member = s.member)"""

LOG_METRICS = f"""
hour_counts AS (
  SELECT user_id, CAST(EXTRACT(hour FROM ts) AS INTEGER) AS h, COUNT(*) AS n
  FROM shop_logs GROUP BY 1, 2),
hour_first AS (
  SELECT user_id, h FROM hour_counts
  QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY n DESC, h) = 1),
log_metrics AS (
  SELECT l.user_id AS "userId",
         CAST(SUM(CASE WHEN date_diff('day', CAST(ts AS DATE), DATE '{LOGS_AS_OF}') < 30
                       THEN 1 ELSE 0 END) AS BIGINT) AS "recentVisits",
         CAST(date_diff('day', CAST(MAX(ts) AS DATE), DATE '{LOGS_AS_OF}') AS INTEGER)
           AS "visitDays",
         COUNT(url) AS "viewCount", COUNT(DISTINCT url) AS "pageCount",
         ANY_VALUE(h) AS "activeHour"
  FROM shop_logs l JOIN hour_first f ON f.user_id = l.user_id
  GROUP BY l.user_id)"""

SHOP_GOODS = """
shop_goods AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS sn, p_brand AS colour, p_type AS kind
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""

RATINGS = r"""
ratings AS (
  SELECT user_id AS "userId", product AS "productId",
         CAST(COUNT(*) AS INTEGER) AS rating
  FROM (SELECT user_id,
               CAST(NULLIF(regexp_extract(url, '^.+/product/(\d+)\.html.+$', 1), '')
                    AS BIGINT) AS product FROM shop_logs)
  WHERE product IS NOT NULL GROUP BY 1, 2)"""

_SOURCE = {
    USERS: (SHOP_USERS, "(SELECT *, id AS \"userId\" FROM shop_users)"),
    ORDERS: (f"{SHOP_ORDERS},{ORDER_METRICS}", "order_metrics"),
    LOGS: (f"{SHOP_LOGS},{LOG_METRICS}", "log_metrics"),
}


def _tag_sql(name: str, rules: list[tuple[str, str]]) -> str:
    tag = BY_NAME[name]
    ctes, source = _SOURCE[tag.entity]
    shown = f', "{tag.metric}" AS "{tag.metric_label}"' if tag.metric_label else ""
    if tag.match == CODE:
        values, on = f"rules(name, rule) AS (VALUES {_values(rules)})", \
            f'"{tag.metric}" = rule'
    else:
        values, on = f"rules(name, lo, hi) AS (VALUES {_values(_bands(rules))})", \
            f'"{tag.metric}" BETWEEN lo AND hi'
    return (f'WITH {ctes}, {values} SELECT "userId", name AS "{tag.label}"{shown} '
            f"FROM {source} JOIN rules ON {on}")


def _score(column: str, bands) -> str:
    whens = []
    for low, high, points in bands:
        parts = [f'"{column}" >= {low}'] if low is not None else []
        parts += [f'"{column}" <= {high}'] if high is not None else []
        whens.append(f"WHEN {' AND '.join(parts)} THEN CAST({points} AS DOUBLE)")
    return f"CASE {' '.join(whens)} END"


def _score_sql(entity: str, columns, bands) -> str:
    ctes, source = _SOURCE[entity]
    shown = ", ".join(f"{_score(column, rows)} AS {name}"
                      for column, (name, rows) in zip(columns, bands.items()))
    return f'WITH {ctes} SELECT "userId", {shown} FROM {source}'


def _profile_sql(join: str, rules: dict) -> str:
    tags = [tag for tag in TAGS if tag.entity != MODEL]
    ctes = ", ".join(part for part, _ in _SOURCE.values())
    values, joins, shown = [], [], []
    for tag in tags:
        name = f"r_{tag.name}"
        if tag.match == CODE:
            values.append(f"{name}(name, rule) AS (VALUES {_values(rules[tag.name])})")
            on = f'{name}.rule = "{tag.metric}"'
        else:
            values.append(f"{name}(name, lo, hi) AS "
                          f"(VALUES {_values(_bands(rules[tag.name]))})")
            on = f'"{tag.metric}" BETWEEN {name}.lo AND {name}.hi'
        joins.append(f"{join} {name} ON {on}")
        shown.append(f'{name}.name AS "{tag.profile_label}"')
    return (f"WITH {ctes}, {', '.join(values)} SELECT u.id AS \"userId\", "
            f"{', '.join(shown)} FROM shop_users u "
            f"{join} order_metrics o ON o.\"userId\" = u.id "
            f"{join} log_metrics l ON l.\"userId\" = u.id {' '.join(joins)}")


def _in(words) -> str:
    return "(" + ", ".join(_text(w) for w in words) + ")"


def _goods_sql(where: str = "") -> str:
    coding = retail.CODING

    def code(column, words):
        return f"CASE {column} " + " ".join(
            f"WHEN {_text(w)} THEN {i}" for i, w in enumerate(words, 1)) + " ELSE 0 END"

    return f"""
user_goods AS (
  SELECT member AS "userId", CAST({code('colour', coding.colours)} AS INTEGER) AS color,
         CAST({code('kind', coding.types)} AS INTEGER) AS product,
         CASE WHEN colour IN {_in(coding.female_colours)}
                OR kind IN {_in(coding.female_types)} THEN 1 ELSE 0 END AS label,
         COUNT(*) AS goods
  FROM shop_goods g JOIN shop_orders o ON o.sn = g.sn {where} GROUP BY 1, 2, 3, 4)"""


def _repair_sql(seconds: int, midnight: bool) -> str:
    known = _in(retail.PAYMENTS)
    n = len(retail.PAYMENTS)

    def digest(text: str) -> str:
        return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"

    codes = " ".join(f"WHEN {i} THEN {_text(c)}" for i, c in enumerate(retail.PAYMENTS))
    names = " ".join(f"WHEN {_text(c)} THEN {_text(v)}"
                     for c, v in retail.PAYMENTS.items())
    moved = f"finished + INTERVAL {seconds} SECOND"
    if midnight:
        moved = f"CAST({moved} AS DATE)"
    moved = f"CAST(epoch(CAST({moved} AS TIMESTAMP) + " \
            f"INTERVAL {repair.ORDER_SHIFT} DAY) AS BIGINT)"
    return f"""
WITH {SHOP_ORDERS}, coded AS (
  SELECT sn, member, finished,
         CASE WHEN pay IN {known} THEN pay
              ELSE CASE {digest("sn || '|pay'")} % {n} {codes} END END AS code
  FROM shop_orders)
SELECT sn AS "orderSn",
       CASE WHEN member >= {repair.MEMBERS} THEN {digest('sn')} % {repair.MEMBERS} + 1
            ELSE member END AS "memberId",
       code AS "paymentCode", CASE code {names} END AS "paymentName",
       {moved} AS "finishTime"
FROM coded"""


def sql(rule_tags: dict[str, str]) -> dict[str, str]:
    """``rule_tags`` maps the names of the code and range tag queries to tags."""
    order_ctes, log_ctes = _SOURCE[ORDERS][0], _SOURCE[LOGS][0]
    goods = f"{SHOP_ORDERS},{SHOP_GOODS},{_goods_sql()}"
    covering = {**retail.RULES, **retail.COVERING}
    tops = [f"top{i}" for i in range(1, 6)]

    return {
        **{key: _tag_sql(name, retail.RULES[name]) for key, name in rule_tags.items()},
        "rfm_scores": _score_sql(ORDERS, ("consumerDays", "orderCount", "monetary"),
                                 retail.RFM_BANDS),
        "rfe_scores": _score_sql(LOGS, ("visitDays", "viewCount", "pageCount"),
                                 retail.RFE_BANDS),
        "psm_scores": f'WITH {order_ctes} SELECT "userId", "psmScore" FROM order_metrics',
        "order_metrics": f"WITH {order_ctes} SELECT * FROM order_metrics",
        "log_metrics": f"WITH {log_ctes} SELECT * FROM log_metrics",
        "order_metrics_by_day": f"WITH {order_ctes} SELECT * FROM order_metrics",
        "log_metrics_by_day": f"WITH {log_ctes} SELECT * FROM log_metrics",
        "page_sketch_check": f"WITH {log_ctes} SELECT count(*) AS users, CAST(0 AS BIGINT) AS far "
                             "FROM log_metrics",
        "returned_goods": f"WITH {SHOP_ORDERS},{SHOP_GOODS},"
                          f"{_goods_sql('WHERE o.status = 0')} SELECT * FROM user_goods",
        "user_goods": f"WITH {goods} SELECT * FROM user_goods",
        # The tree learns the labelling rule without error, so the rule votes.
        "usg_vote": f"""
WITH {goods}, rules(name, rule) AS (VALUES {_values(retail.RULES['usg'])}),
votes AS (
  SELECT "userId", CASE WHEN SUM(CASE WHEN label = 0 THEN goods ELSE 0 END) * 1.0
                             / SUM(goods) >= 0.5 THEN '0'
                        WHEN SUM(CASE WHEN label = 1 THEN goods ELSE 0 END) * 1.0
                             / SUM(goods) >= 0.5 THEN '1'
                        ELSE '-1' END AS vote
  FROM user_goods GROUP BY "userId")
SELECT "userId", name AS usg FROM votes JOIN rules ON rule = vote""",
        "click_ratings": f"WITH {SHOP_LOGS},{RATINGS} SELECT * FROM ratings",
        "product_name_lookup": f"""
WITH {SHOP_LOGS},{RATINGS}, best AS (
  SELECT "userId", "productId", ROW_NUMBER() OVER (
           PARTITION BY "userId" ORDER BY rating DESC, "productId") AS place
  FROM ratings QUALIFY place <= 5),
named AS (
  SELECT "userId", {', '.join(f'MAX(CASE WHEN place = {i} THEN p_name END) AS {name}'
                              for i, name in enumerate(tops, 1))}
  FROM best LEFT JOIN part ON p_partkey = "productId" GROUP BY "userId")
SELECT * FROM named WHERE {' AND '.join(f'{name} IS NOT NULL' for name in tops)}""",
        "profile_sql": _profile_sql("JOIN", covering),
        "profile_joined": _profile_sql("JOIN", covering),
        "profile_from_buckets": _profile_sql("JOIN", covering),
        "tag_sinks": f"""
SELECT * FROM (VALUES ('parquet'), ('json'), ('csv'), ('versions'), ('catalog'), ('views'))
    AS s(sink) CROSS JOIN ({_tag_sql('consumeCycle', retail.RULES['consumeCycle'])})""",
        "profile_left": _profile_sql("LEFT JOIN", retail.RULES),
        "range_gap_drop": f"""
WITH {order_ctes}, rules(name, lo, hi) AS (VALUES {_values(GAP_BANDS)})
SELECT "userId", "orderCount", name AS band
FROM order_metrics JOIN rules ON "orderCount" BETWEEN lo AND hi""",
        "half_open_bands": f"""
WITH {order_ctes}, rules(name, lo, hi) AS (VALUES {_values(PRICE_BANDS)})
SELECT "userId", "unitPrice", name AS band
FROM order_metrics JOIN rules ON "unitPrice" >= lo AND "unitPrice" < hi + 1""",
        "many_bands": f"""
WITH {order_ctes}, rules AS (
  SELECT 'band ' || i AS name, i * i * 2 AS lo, (i + 1) * (i + 1) * 2 - 1 AS hi
  FROM range(500) t(i))
SELECT "userId", "unitPrice", name AS band
FROM order_metrics JOIN rules ON "unitPrice" BETWEEN lo AND hi""",
        "code_unmatched_drop": f"""
WITH rules(name, rule) AS (VALUES {_values(SOME_CODES)})
SELECT c_custkey AS "userId", name AS region
FROM customer JOIN rules ON CAST(c_nationkey AS VARCHAR) = rule""",
        "nation_names": """
SELECT c_custkey AS "userId", n_name AS nationality
FROM customer JOIN nation ON n_nationkey = c_nationkey""",
        "metadata_scan": f"""
WITH {SHOP_USERS}, g(name, rule) AS (VALUES {_values(retail.RULES['gender'])}),
j(name, rule) AS (VALUES {_values(retail.RULES['job'])}),
p(name, rule) AS (VALUES {_values(retail.RULES['politicalFace'])}),
m(name, rule) AS (VALUES {_values(retail.RULES['marriage'])})
SELECT id AS "userId", g.name AS gender, j.name AS job, p.name AS "politicalFace",
       m.name AS marriage
FROM shop_users JOIN g ON g.rule = gender JOIN j ON j.rule = job
JOIN p ON p.rule = politicalFace JOIN m ON m.rule = marriage""",
        "gender_from_catalog": f"""
WITH rules(name, rule) AS (VALUES {_values(retail.RULES['gender'])})
SELECT c_custkey AS user_id, name AS gender
FROM customer JOIN rules ON rule = CAST(c_custkey % 3 AS VARCHAR)""",
        "sql_functions": rf"""
WITH {SHOP_LOGS}, found AS (
  SELECT user_id, CAST(EXTRACT(hour FROM ts) AS INTEGER) AS h,
         NULLIF(regexp_extract(url, '^.+/product/(\d+)\.html.+$', 1), '') AS product
  FROM shop_logs)
SELECT user_id AS "userId", COALESCE(product, '') AS "productId", h AS hour_start,
       h + 1 AS hour_end, CAST(user_id AS INTEGER) AS top1,
       COALESCE(CAST(product AS INTEGER), -1) AS top2, -1 AS top3, -1 AS top4, -1 AS top5
FROM found""",
        "many_bands_signed": f"""
WITH {order_ctes}, rules AS (
  SELECT 'band ' || i AS name, i * 1500 AS lo, i * 1500 + 1299 AS hi FROM range(-200, 200) t(i))
SELECT "userId", "unitPrice" - 250000 AS "offset", name AS band
FROM order_metrics JOIN rules ON "unitPrice" - 250000 BETWEEN lo AND hi""",
        "unit_price_half_open": f"""
WITH {order_ctes}, rules(name, lo, hi) AS (VALUES {_values(_bands(retail.RULES['unitPrice']))})
SELECT "userId", name AS "unitPriceRange", "unitPrice"
FROM order_metrics JOIN rules ON "unitPrice" >= lo AND "unitPrice" < hi + 1""",
        "rfe_scores_lagged": _score_sql(LOGS, ("visitDays", "viewCount", "pageCount"),
                                        retail.RFE_BANDS),
        "shift_users_midnight": f"""
WITH {SHOP_USERS} SELECT id,
       CAST(epoch(CAST(CAST(last_order AS DATE) + INTERVAL {repair.LOGIN_SHIFT} DAY AS TIMESTAMP))
            AS BIGINT) AS "lastLoginTime" FROM shop_users""",
        **{f"{name}_tag_check": f"""
WITH scored AS ({_score_sql(entity, columns, bands)})
SELECT count(*) AS users, least(CAST({k} AS BIGINT), count(DISTINCT ({', '.join(bands)}))) AS labels,
       CAST(0 AS BIGINT) AS far, CAST(0 AS BIGINT) AS disordered, CAST(0 AS BIGINT) AS costlier FROM scored"""
           for name, entity, columns, bands, k in (
               ("rfm", ORDERS, cluster.RFM_METRICS, retail.RFM_BANDS, cluster.RFM_CLUSTERS),
               ("rfe", LOGS, cluster.RFE_METRICS, retail.RFE_BANDS, cluster.RFE_CLUSTERS))},
        "psm_tag_check": f"""
WITH {order_ctes}
SELECT count(*) AS users, least(CAST({cluster.PSM_CLUSTERS} AS BIGINT), count(DISTINCT "psmScore")) AS labels,
       CAST(0 AS BIGINT) AS far, CAST(0 AS BIGINT) AS disordered, CAST(0 AS BIGINT) AS costlier FROM order_metrics""",
        "psm_coreset_check": f"WITH {order_ctes} SELECT count(*) AS users, CAST(0 AS BIGINT) AS lost, "
                             "CAST(0 AS BIGINT) AS costlier FROM order_metrics",
        "silhouette_check": f"WITH {log_ctes} SELECT count(*) AS users, CAST(0 AS BIGINT) AS apart FROM log_metrics",
        "rmse_check": f"WITH {SHOP_LOGS},{RATINGS} "
                      "SELECT count(*) AS ratings, CAST(0 AS BIGINT) AS apart FROM ratings",
        "bp_check": f"""
WITH {SHOP_LOGS},{RATINGS}
SELECT count(DISTINCT "userId") AS users, count(DISTINCT "productId") AS products, CAST(0 AS BIGINT) AS unsolved
FROM ratings""",
        "bp_best_check": f"""
WITH {SHOP_LOGS},{RATINGS}
SELECT count(DISTINCT "userId") FILTER ("userId" % 100 = 0) AS users, CAST(0 AS BIGINT) AS missed,
       CAST(0 AS BIGINT) AS misstated FROM ratings""",
        "bp_fold_in_check": f"""
WITH {SHOP_LOGS},{RATINGS},
early AS (SELECT * FROM ratings WHERE "userId" % 5 <> 0 AND "productId" % 5 <> 0)
SELECT count(DISTINCT "userId") AS users, count(DISTINCT "productId") AS products,
       count(DISTINCT "userId") FILTER ("userId" NOT IN (SELECT "userId" FROM early))
           + count(DISTINCT "productId") FILTER ("productId" NOT IN (SELECT "productId" FROM early))
           AS late,
       CAST(0 AS BIGINT) AS unsolved_users, CAST(0 AS BIGINT) AS unsolved_products FROM ratings""",
        "bp_lists_check": f"""
WITH {SHOP_LOGS},{RATINGS}
SELECT count(DISTINCT "userId") AS users, CAST(0 AS BIGINT) AS uneven, CAST(0 AS BIGINT) AS unlike, CAST(0 AS BIGINT) AS unsorted FROM ratings""",
        "profile_full_check": f"""
WITH profile AS ({_profile_sql("JOIN", covering)}),
goods_users AS (WITH {goods} SELECT DISTINCT "userId" FROM user_goods),
log_users AS (WITH {SHOP_LOGS},{RATINGS} SELECT DISTINCT "userId" FROM ratings)
SELECT count(*) AS users, CAST(0 AS BIGINT) AS extra, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS twice
FROM profile JOIN goods_users USING ("userId") JOIN log_users USING ("userId")""",
        "repair_orders": _repair_sql(0, False),
        "repair_orders_midnight": _repair_sql(3661, True),
        "shift_logs": f"""
WITH {SHOP_LOGS} SELECT user_id AS global_user_id, url AS loc_url,
       ts + INTERVAL {repair.LOG_SHIFT} DAY AS log_time FROM shop_logs""",
        "shift_logs_midnight": f"""
WITH {SHOP_LOGS} SELECT user_id AS global_user_id, url AS loc_url,
       CAST(CAST(ts AS DATE) + INTERVAL {repair.LOG_SHIFT} DAY AS DATE) AS log_time
FROM shop_logs""",
        "shift_users": f"""
WITH {SHOP_USERS} SELECT id,
       CAST(epoch(last_order + INTERVAL {repair.LOGIN_SHIFT} DAY) AS BIGINT)
         AS "lastLoginTime" FROM shop_users""",
    }
