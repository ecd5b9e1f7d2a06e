"""The tags, declared: where a tag's metric comes from and how it gets its name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tagweave.operators import metrics
from tagweave.operators.match import (EXPRESSED, attach_band, attach_code, band_name,
                                      code_name)
from tagweave.operators.metrics import AsOf
from tagweave.sources.tables import CatalogTables
from tagweave.sources.taxonomy import Taxonomy

USERS, ORDERS, LOGS, MODEL = "users", "orders", "logs", "model"
CODE, RANGE = "code", "range"


@dataclass(frozen=True)
class Tag:
    """One tag.

    ``metric`` is a column of the metrics of ``entity`` and ``match`` says how
    its value finds a name. The tag table has userId, the name under ``label``
    and, if ``metric_label`` is set, the metric. The profile shows the name as
    ``profile_label``.
    """

    id: int | None
    name: str
    table: str
    entity: str
    metric: str
    match: str
    label: str
    profile_label: str
    metric_label: str | None = None


def _tag(id, name, table, entity, metric, match, label, profile_label=None,
         metric_label=None) -> Tag:
    return Tag(id, name, table, entity, metric, match, label,
               profile_label or label, metric_label)


# Taxonomy ids, result tables and their columns.
TAGS: tuple[Tag, ...] = (
    _tag(106, "gender", "tbl_gender_tag", USERS, "gender", CODE, "gender"),
    _tag(113, "job", "tbl_job_tag", USERS, "job", CODE, "job"),
    _tag(124, "nationality", "tbl_nationality_tag", USERS, "nationality", CODE,
         "nationality"),
    _tag(120, "marriage", "tbl_marriage_tag", USERS, "marriage", CODE, "marriage"),
    _tag(109, "politicalFace", "tbl_politicalface_tag", USERS, "politicalFace", CODE,
         "politicalFace"),
    _tag(130, "isBlackList", "tbl_isblacklist_tag", USERS, "is_blackList", CODE,
         "is_blackList"),
    _tag(301, "rfm", "tbl_rfm_tag", MODEL, "rfmCluster", CODE, "rfm"),
    _tag(307, "rfe", "tbl_rfe_tag", MODEL, "rfeCluster", CODE, "rfe"),
    _tag(312, "psm", "tbl_psm_tag", MODEL, "psmCluster", CODE, "psm"),
    _tag(318, "usg", "tbl_usg_tag", MODEL, "usgVote", CODE, "usg"),
    _tag(201, "ageRange", "tbl_ageRange_tag", USERS, "bornDate", RANGE, "ageRange"),
    _tag(236, "buyFrequency", "tbl_buyFrequency_tag", ORDERS, "buyFrequency", RANGE,
         "value", "buyFrequency", "frequency"),
    _tag(208, "consumeCycle", "tbl_consumeCycle_tag", ORDERS, "consumerDays", RANGE,
         "consumptionCycle"),
    _tag(244, "exchangeRate", "tbl_exchangeRate_tag", ORDERS, "exchangeCount", RANGE,
         "value", "exchangeRate", "exchangeRate"),
    _tag(248, "lastLogin", "tbl_lastLogin_tag", USERS, "loginDays", RANGE, "loginCycle"),
    _tag(254, "logFrequency", "tbl_logFrequency_tag", LOGS, "recentVisits", RANGE,
         "value", "logFrequency", "frequency"),
    _tag(259, "logTimeSlot", "tbl_logTimeSlot_tag", LOGS, "activeHour", RANGE,
         "timeSlot", "logTimeSlot"),
    _tag(230, "maxOrder", "tbl_maxOrder_tag", ORDERS, "maxOrder", RANGE,
         "maxOrderRange", metric_label="max_orderAmount"),
    _tag(223, "payType", "tbl_payType_tag", ORDERS, "payment", CODE, "payment",
         "payType"),
    _tag(240, "returnRate", "tbl_returnRate_tag", ORDERS, "returnCount", RANGE,
         "value", "returnRate", "returnRate"),
    _tag(217, "unitPrice", "tbl_unitPrice_tag", ORDERS, "unitPrice", RANGE,
         "unitPriceRange", metric_label="unitPrice"),
)
BY_NAME = {tag.name: tag for tag in TAGS}
# Recommendations carry product ids and need no taxonomy.
PREFERENCE_TABLE = "tbl_bp_tag"
PROFILE_TABLE = "tbl_user_profile"
PREFERENCE_COLUMNS = {f"top{i}": f"BpTop{i}" for i in range(1, 6)}

_METRICS = {USERS: metrics.user_metrics, ORDERS: metrics.order_metrics,
            LOGS: metrics.log_metrics}


def tag_metric(tag: Tag, source: DataFrame, as_of: AsOf = None) -> DataFrame:
    """(userId, metric) from the fact table or users table of the tag."""
    return _METRICS[tag.entity](source, as_of, [tag.metric])


def attach_name(tag: Tag, valued: DataFrame, taxonomy: Taxonomy, metric: str,
                out: str, how: str = "inner", half_open: bool = False) -> DataFrame:
    """``valued`` with the tag's name of its ``metric`` as one more column.

    ``half_open`` stretches the bands of a range tag to the next integer.
    """
    rules = taxonomy.code_rules(tag.id) if tag.match == CODE else taxonomy.band_rules(tag.id)
    few = rules.values is not None and len(rules.values) <= EXPRESSED
    if few and all(value[0] is not None for value in rules.values):
        # Few checked rules are an expression: no join and no broadcast job.
        name = (code_name(F.col(metric), rules.values) if tag.match == CODE
                else band_name(F.col(metric), rules.values, half_open))
        named = valued.withColumn(out, name)
        return named.filter(F.col(out).isNotNull()) if how == "inner" else named
    if tag.match == CODE:
        return attach_code(valued, rules.frame, metric, out, how, rows=rules.rows)
    return attach_band(valued, rules.frame, metric, out, how, half_open, rows=rules.rows)


def tag_table(tag: Tag, valued: DataFrame, taxonomy: Taxonomy,
              half_open: bool = False) -> DataFrame:
    """The tag's result table from a frame with userId and its metric."""
    named = attach_name(tag, valued.select("userId", tag.metric), taxonomy,
                        tag.metric, "_name", half_open=half_open)
    columns = {"userId": "userId", "_name": tag.label}
    if tag.metric_label:
        columns[tag.metric] = tag.metric_label
    return named.select(*[F.col(c).alias(out) for c, out in columns.items()])


def run_tag(tag: Tag, store, taxonomy: Taxonomy, as_of: AsOf = None,
            half_open: bool = False) -> DataFrame:
    """The tag as its taxonomy row directs: only the named fields of the named
    table are read."""
    rule = taxonomy.source_rule(tag.id)
    source = store.read(rule.table).select(*rule.fields)
    return tag_table(tag, tag_metric(tag, source, as_of), taxonomy, half_open)


def run_catalog_tag(spark, tag: Tag, database: str | None = None,
                    taxonomy_table: str = "tbl_basic_tags", as_of: AsOf = None) -> DataFrame:
    """The tag with taxonomy and source read from the session catalog; the user
    column is called user_id there."""
    store = CatalogTables(spark, database)
    return run_tag(tag, store, Taxonomy(store.read(taxonomy_table)),
                   as_of).withColumnRenamed("userId", "user_id")
