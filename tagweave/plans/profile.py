"""The user profile: all tags of a user in one row."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tagweave.operators import cluster, metrics
from tagweave.operators.staging import stage, staged_run
from tagweave.plans import mining
from tagweave.plans.settings import Settings
from tagweave.plans.tags import (LOGS, MODEL, ORDERS, PREFERENCE_COLUMNS,
                                 PREFERENCE_TABLE, PROFILE_TABLE, TAGS, USERS, Tag,
                                 attach_name, tag_table)
from tagweave.sources.taxonomy import Taxonomy


def assemble(tables: Iterable[DataFrame], how: str = "inner") -> DataFrame:
    """Join finished tag tables on userId, in the given order.

    ``inner`` keeps users that have every tag; ``left`` keeps those of the first
    table. All joins share one key, so each table is shuffled once.
    """
    return reduce(lambda done, table: done.join(table, "userId", how), tables)


def profile_parts(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Tag tables by name, cut down to the columns the profile shows."""
    parts = [tables[tag.name].select("userId", F.col(tag.label).alias(tag.profile_label))
             for tag in TAGS if tag.name in tables]
    if "bp" in tables:
        parts.append(tables["bp"].select("userId", *[
            F.col(c).alias(out) for c, out in PREFERENCE_COLUMNS.items()]))
    return parts


def check_unique(table: DataFrame, what: str) -> DataFrame:
    """Raise if a user has two rows: a join would multiply them."""
    twice = table.groupBy("userId").count().filter("count > 1").take(3)
    if twice:
        raise ValueError(f"{what} has several rows for user(s) "
                         f"{[row['userId'] for row in twice]}")
    return table


def check_all_unique(tables: list[DataFrame], bucketed: bool = False) -> list[DataFrame]:
    """``check_unique`` for all tables in one pass; the columns they show name them.

    Tables bucketed by user are counted one by one, where they lie.
    """
    named = [t.select("userId", F.lit(i).alias("_of")) for i, t in enumerate(tables)]
    if bucketed:
        counted = reduce(DataFrame.unionAll, [
            t.groupBy("userId").agg(F.count("*").alias("count"), F.first("_of").alias("_of"))
            for t in named])
    else:
        counted = reduce(DataFrame.unionAll, named).groupBy("userId", "_of").count()
    twice = counted.filter("count > 1").take(3)
    if twice:
        raise ValueError("several rows for user(s) " + "; ".join(
            f"{r['userId']} in the table of {', '.join(tables[r['_of']].columns[1:])}"
            for r in twice))
    return tables


def entity_metrics(store, settings: Settings, entity: str,
                   names: Iterable[str]) -> DataFrame:
    """Metrics of the users, the orders or the logs table."""
    build, table = {USERS: (metrics.user_metrics, settings.users),
                    ORDERS: (metrics.order_metrics, settings.orders),
                    LOGS: (metrics.log_metrics, settings.logs)}[entity]
    return build(store.read(table), settings.as_of(entity), names)


def name_all(valued: DataFrame, taxonomy: Taxonomy, tags: Iterable[Tag],
             how: str = "inner", carry: Iterable[str] = (),
             half_open: Collection[str] = ()) -> DataFrame:
    """Replace the metrics of ``tags`` by their names, row by row: the rules come
    to the users, whose rows stay where they are."""
    tags = list(tags)
    named = valued
    for tag in tags:
        named = attach_name(tag, named, taxonomy, tag.metric, f"_{tag.name}", how,
                            tag.name in half_open)
    return named.select("userId", *[F.col(f"_{tag.name}").alias(tag.profile_label)
                                    for tag in tags], *carry)


def rule_profile(store, taxonomy: Taxonomy, settings: Settings,
                 how: str = "inner") -> DataFrame:
    """The profile without the model tags, as one lazy query over the inputs.

    Users, orders and logs are each reduced to user rows before they meet; the
    aggregates leave them partitioned by user, so the joins move no facts. A users
    table with a repeated id is refused, for which its ids are counted.
    """
    tags = [tag for tag in TAGS if tag.entity != MODEL]
    valued = {entity: entity_metrics(store, settings, entity, [
        tag.metric for tag in tags if tag.entity == entity]) for entity in (USERS, ORDERS, LOGS)}
    check_unique(valued[USERS], settings.users)
    wide = assemble(valued.values(), how)
    return name_all(wide, taxonomy, tags, how, half_open=settings.half_open)


def full_values(store, settings: Settings) -> dict[str, DataFrame]:
    """Every metric and model result, by entity, one row per user in each.

    All tags of the orders and of the logs share one staged table of metrics; the
    models are fitted on the staged rows and add their cluster as a column. A users
    table with a repeated id is refused: it would multiply rows.
    """
    wanted = {entity: [tag.metric for tag in TAGS if tag.entity == entity]
              for entity in (USERS, ORDERS, LOGS)}
    wanted[ORDERS] += [m for m in (*cluster.RFM_METRICS, "psmScore")
                       if m not in wanted[ORDERS]]
    wanted[LOGS] += [m for m in cluster.RFE_METRICS if m not in wanted[LOGS]]

    def staged(entity: str) -> DataFrame:
        return stage(entity_metrics(store, settings, entity, wanted[entity]),
                     f"{entity}-metrics")

    steps = {
        "goods": lambda: stage(mining.usg_votes(store, settings), "usg-votes"),
        "preferences": lambda: stage(mining.preferences(store, settings), "preferences"),
        ORDERS: lambda: mining.add_psm(mining.add_rfm(staged(ORDERS), settings), settings),
        LOGS: lambda: mining.add_rfe(staged(LOGS), settings),
        USERS: lambda: check_unique(staged(USERS), settings.users),
    }
    # The steps share nothing, and small training jobs leave a cluster idle.
    with ThreadPoolExecutor(len(steps)) as threads:
        running = {name: threads.submit(step) for name, step in steps.items()}
        return {name: running[name].result()
                for name in (USERS, ORDERS, LOGS, "goods", "preferences")}


def full_profile(values: Mapping[str, DataFrame], taxonomy: Taxonomy,
                 how: str = "inner", half_open: Collection[str] = ()) -> DataFrame:
    """The profile with all 22 tags from ``full_values``."""
    wide = assemble(values.values(), how)
    named = name_all(wide, taxonomy, TAGS, how, PREFERENCE_COLUMNS, half_open)
    return named.withColumnsRenamed(PREFERENCE_COLUMNS)


def all_tag_tables(values: Mapping[str, DataFrame], taxonomy: Taxonomy,
                   half_open: Collection[str] = ()) -> dict[str, DataFrame]:
    """The 22 tag tables by table name."""
    holder = {column: frame for frame in values.values() for column in frame.columns
              if column != "userId"}
    tables = {tag.table: tag_table(tag, holder[tag.metric], taxonomy, tag.name in half_open)
              for tag in TAGS}
    tables[PREFERENCE_TABLE] = values["preferences"]
    return tables


def run_all(store, out, taxonomy: Taxonomy, settings: Settings,
            how: str = "inner", sort_by: str | None = None) -> DataFrame:
    """Compute and write all tag tables, then the profile; return the profile as written.

    What is staged on the way is removed at the end.
    """
    with staged_run(taxonomy.spark, not getattr(out, "lazy", False)):
        values = full_values(store, settings)
        for table, tagged in all_tag_tables(values, taxonomy, settings.half_open).items():
            out.write(tagged, table, sort_by=sort_by)
        out.write(full_profile(values, taxonomy, how, settings.half_open), PROFILE_TABLE,
                  sort_by=sort_by)
    return out.read(PROFILE_TABLE)


def rule_tag_tables(store, taxonomy: Taxonomy, settings: Settings) -> dict[str, DataFrame]:
    """The tag tables that need no model, by table name, from shared staged metrics."""
    tags = [tag for tag in TAGS if tag.entity != MODEL]
    valued = {entity: stage(entity_metrics(store, settings, entity, [
        tag.metric for tag in tags if tag.entity == entity]), f"{entity}-metrics")
        for entity in (USERS, ORDERS, LOGS)}
    return {tag.table: tag_table(tag, valued[tag.entity], taxonomy,
                                 tag.name in settings.half_open) for tag in tags}


def profile_from_tables(out, how: str = "inner", models: bool = True) -> DataFrame:
    """The profile again, joined from tag tables written earlier.

    Tables that ``out`` has bucketed by user are checked and joined without a shuffle.
    Without ``models`` the tags that need one are left out.
    """
    tables = {tag.name: out.read(tag.table) for tag in TAGS if models or tag.entity != MODEL}
    if models:
        tables["bp"] = out.read(PREFERENCE_TABLE)
    held = getattr(out, "buckets", None)
    bucketed = held is not None and held.column == "userId"
    parts = check_all_unique(profile_parts(tables), bucketed)
    # Merged where they lie: a broadcast would ship whole tables.
    return assemble([parts[0], *[p.hint("merge") for p in parts[1:]]] if bucketed else parts, how)
